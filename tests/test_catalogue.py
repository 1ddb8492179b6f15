"""Every query with SQL against DuckDB on the smallest tables; the library without its optional subpackage."""

import datetime
import glob
import os
import subprocess
import sys

import pandas as pd
import pytest

from corpusloom.plans import catalogue

duckdb = pytest.importorskip("duckdb")


def plain(v):
    if v is None or v is pd.NA or v is pd.NaT or v != v:
        return None
    if hasattr(v, "item"):
        return plain(v.item())
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (pd.Timestamp, datetime.datetime)):
        t = pd.Timestamp(v)
        return (t.tz_convert("UTC").tz_localize(None) if t.tzinfo else t).value
    return v


def rows(pdf):
    return sorted((tuple(plain(x) for x in r) for r in pdf[sorted(pdf.columns)].itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def duck(data):
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for f in glob.glob(f"{data}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_equals_sql(spark, data, duck, name):
    got = catalogue.queries()[name](spark, data).toPandas()
    want = duck.execute(catalogue.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_other_queries_run(spark, data):
    for name in set(catalogue.queries()) - set(catalogue.oracle_sql()):
        assert catalogue.queries()[name](spark, data).count() > 0


def test_entry_without_the_subpackage():
    code = "import sys; sys.modules['corpusloom.llm'] = None; import __spark_entry__ as e; assert 'prune_all' in e.queries() and not any(k.startswith('p8_') for k in e.queries())"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(os.path.dirname(__file__)))


def test_sql_functions(spark):
    from corpusloom.plans.workflows import register_sql_functions

    register_sql_functions(spark)
    row = spark.sql("SELECT clean_email('x a@b.cc y') e, letter_count('a1b') n, human_size(1152) h, clean_html('<p>a</p>') t").head()
    assert tuple(row) == ("x  y", 2, "1.12 KB", "a")
