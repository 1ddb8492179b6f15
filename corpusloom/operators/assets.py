"""Files: routing by suffix, matching to originals, re-homing, copy plans."""

from __future__ import annotations

import os
import shutil
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import text as T

# Suffixes by class.
FILE_CLASSES = {
    "video": ".mp4 .avi .mov .wmv .flv .mkv .webm .mpeg .mpg .3gp .m4v".split(),
    "audio": ".mp3 .wav .aac .flac .ogg .m4a .wma .alac .ape .opus".split(),
    "image": ".jpg .jpeg .png .bmp .tiff .webp .svg .gif .heic .raw".split(),
    "pdf": [".pdf"],
    "docx": [".docx"],
}
# Archives, by the end of the name.
ARCHIVE_ENDS = ("zip", "rar", "7z")


def file_class(name: Column) -> Column:
    """Class of a file by its suffix, whatever its case; null for others."""
    suffix = T.extension(name)
    out = None
    for label, suffixes in FILE_CLASSES.items():
        hit = suffix.isin(*suffixes)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out


def route(df: DataFrame, path_column: str, targets: dict[str, str], root: str = "", *, overwrite: bool = False) -> DataFrame:
    """A copy plan (src, dst, file_class): each file of a known class below its class's target, relative path kept."""
    src = df[path_column]
    relative = F.regexp_replace(src, F.lit("^" + root.rstrip("/") + "/"), F.lit("")) if root else F.ltrim(F.lit("/"), src)
    kind = file_class(src)
    base = F.create_map(*(F.lit(x) for pair in targets.items() for x in pair))
    plan = df.select(src.alias("src"), kind.alias("file_class"), relative.alias("__rel")).where(F.col("file_class").isNotNull())
    return plan.select("src", F.concat_ws("/", F.try_element_at(base, F.col("file_class")), "__rel").alias("dst"), "file_class", F.lit(overwrite).alias("overwrite")).where(F.col("dst").isNotNull())


def is_archive_name(name: Column) -> Column:
    """Names that count as archives; temporary ones (``._``) do not."""
    base = T.base_name(name)
    ends = F.lit(False)
    for end in ARCHIVE_ENDS:
        ends = ends | base.endswith(end)
    return ends & ~base.startswith("._")


def match_originals(records: DataFrame, originals: DataFrame, record_dir: str, record_stem: str, original_dir: str, original_stem: str, order_by: str) -> DataFrame:
    """Each record with the first original in the same folder with the same stem (left outer)."""
    order = Window.partitionBy(original_dir, original_stem).orderBy(order_by)
    first = originals.withColumn("__n", F.row_number().over(order)).where(F.col("__n") == 1).drop("__n")
    first = first.withColumnsRenamed({original_dir: "__dir", original_stem: "__stem"})
    joined = records.join(first, (records[record_dir] == F.col("__dir")) & (records[record_stem] == F.col("__stem")), "left")
    return joined.drop("__dir", "__stem")


def rehome_by_stem(records: DataFrame, sources: DataFrame, record_stem: str, source_stem: str, source_dir: str, order_by: str) -> tuple[DataFrame, DataFrame]:
    """Records that move to the folder of the last source with their stem, and the unmatched ones."""
    last = sources.groupBy(F.col(source_stem).alias("__stem")).agg(F.max_by(source_dir, order_by).alias("target_dir"))
    moved = records.join(last, records[record_stem] == last["__stem"]).drop("__stem")
    unmatched = records.join(last, records[record_stem] == last["__stem"], "left_anti")
    return moved, unmatched


def flat_copy_plan(df: DataFrame, path_column: str, target: str) -> DataFrame:
    """(src, dst) into one folder by base name; of files with one name the greatest path is copied."""
    name = T.base_name(df[path_column])
    return df.where(df[path_column].isNotNull()).groupBy(name.alias("__name")).agg(F.max(path_column).alias("src")).select("src", F.concat(F.lit(target.rstrip("/") + "/"), "__name").alias("dst"))


def execute_copies(plan: DataFrame, *, overwrite: bool = False) -> DataFrame:
    """Copy files of a plan on the executors; one status row each: copied, exists or missing."""

    def copy(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            status = []
            for src, dst in zip(pdf["src"], pdf["dst"]):
                if not os.path.isfile(src):
                    status.append("missing")
                elif os.path.exists(dst) and not overwrite:
                    status.append("exists")
                else:
                    os.makedirs(os.path.dirname(dst), exist_ok=True)
                    shutil.copy2(src, dst)
                    status.append("copied")
            yield pd.DataFrame({"src": pdf["src"], "dst": pdf["dst"], "status": status})

    return plan.select("src", "dst").mapInPandas(copy, "src string, dst string, status string")


def status_counts(df: DataFrame, column: str = "status") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
