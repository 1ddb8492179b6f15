"""Sources: JSONL folders and trees, markdown trees, file listings, archives, docx, vocabularies."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.operators.assets import is_archive_name


def local_path(uri: Column) -> Column:
    """A file URI as a plain path."""
    return F.url_decode(F.regexp_replace(F.regexp_replace(uri, r"^file:/+", "/"), r"\+", "%2B"))


def read_jsonl(spark: SparkSession, folder: str, schema: str | None = None, *, recursive: bool = False) -> DataFrame:
    """Records of a folder's JSONL files with ``src_file`` and the raw ``line``; bad and blank lines are dropped."""
    raw = spark.read.option("pathGlobFilter", "*.jsonl").option("recursiveFileLookup", str(recursive).lower()).text(folder)
    raw = raw.select(F.col("value").alias("line"), F.col("_metadata.file_name").alias("src_file"), local_path(F.col("_metadata.file_path")).alias("src_path"))
    raw = raw.where(T.strip(F.col("line")) != "")
    if schema is None:
        inferred = spark.read.option("pathGlobFilter", "*.jsonl").option("recursiveFileLookup", str(recursive).lower()).option("mode", "DROPMALFORMED").json(folder).schema
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in inferred)
    parsed = raw.withColumn("__r", F.from_json("line", schema, {"mode": "PERMISSIVE"})).where(F.try_parse_json("line").isNotNull() & F.col("__r").isNotNull())
    return parsed.select("__r.*", "line", "src_file", "src_path")


def read_markdown(spark: SparkSession, root: str) -> DataFrame:
    """Markdown files below a folder: id, md_path, text; stripped, empty ones dropped."""
    raw = spark.read.option("pathGlobFilter", "*.md").option("recursiveFileLookup", "true").text(root, wholetext=True)
    path = local_path(F.col("_metadata.file_path"))
    return raw.select(T.path_id(path).alias("id"), path.alias("md_path"), T.strip(F.col("value")).alias("text")).where(F.length("text") > 0)


def list_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Files below a folder: path, size_bytes, extension; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    path = local_path(F.col("path"))
    return files.select(path.alias("path"), F.col("length").alias("size_bytes"), T.extension(path).alias("extension"))


def list_pdfs(spark: SparkSession, root: str) -> DataFrame:
    """PDF files with ``valid``: they begin with the magic bytes."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.pdf").load(root)
    return files.select(local_path(F.col("path")).alias("path"), F.col("length").alias("size_bytes"), (F.substring("content", 1, 5) == F.lit(b"%PDF-")).alias("valid"))


def list_images(spark: SparkSession, root: str) -> DataFrame:
    return list_files(spark, root, "*.{png,jpeg,jpg}")


def list_audio(spark: SparkSession, root: str) -> DataFrame:
    """Audio files directly in a folder, by name, with their record ids."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{wav,mp3,m4a,flac,aac}").load(root)
    path = local_path(F.col("path"))
    return files.select(T.path_id(path).alias("id"), path.alias("audio_path"), T.stem(path).alias("audio_id")).orderBy("audio_path")


def convert_files(spark: SparkSession, root: str, glob: str, make: Callable[[], Callable[[bytes], str]]) -> DataFrame:
    """Files through a provider (recognition of scans or speech): path, text or error; one failure costs one row."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root).select("path", "content")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        convert = make()
        for pdf in frames:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"]):
                try:
                    rows.append((path, convert(content), None))
                except Exception as e:
                    rows.append((path, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["path", "text", "error"])

    return files.mapInPandas(run, "path string, text string, error string").withColumn("path", local_path(F.col("path")))


def docx_text(content: bytes) -> str:
    """Paragraphs, headings and table rows of a docx file as markdown."""
    space = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        body = ElementTree.fromstring(z.read("word/document.xml")).find(f"{space}body")
    words = lambda e: "".join(t.text or "" for t in e.iter(f"{space}t"))
    out = []
    for e in body:
        if e.tag == f"{space}p":
            style = e.find(f"{space}pPr/{space}pStyle")
            level = re.search(r"eading\s?(\d)", style.get(f"{space}val", "")) if style is not None else None
            out.append(("#" * int(level.group(1)) + " " if level else "") + words(e))
        elif e.tag == f"{space}tbl":
            out += ["| " + " | ".join(words(c) for c in row.iter(f"{space}tc")) + " |" for row in e.iter(f"{space}tr")]
    return "\n\n".join(x for x in out if x.strip())


def read_docx(spark: SparkSession, root: str) -> DataFrame:
    return convert_files(spark, root, "*.[dD][oO][cC][xX]", lambda: docx_text)


# Encodings that names in archives are tried in.
NAME_ENCODINGS = ("utf-8", "gbk", "cp437")


def decode_name(info: zipfile.ZipInfo) -> str:
    """A member's name; names not marked as UTF-8 are read again in the usual encodings."""
    if info.flag_bits & 0x800:
        return info.filename
    raw = info.filename.encode("cp437", "replace")
    for encoding in NAME_ENCODINGS:
        try:
            return raw.decode(encoding)
        except UnicodeDecodeError:
            continue
    return info.filename


def expand_archives(spark: SparkSession, root: str) -> DataFrame:
    """Members of the archives below a folder: archive, status (success, password, failed), member, size, content.

    Zip files are read with the standard library; other kinds need a provider and are reported as failed.
    An archive without members gives one row without a member. One level is expanded.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).where(is_archive_name(F.col("path"))).select("path", "content")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"]):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        infos = [i for i in z.infolist() if not i.is_dir()]
                        if any(i.flag_bits & 1 for i in infos):
                            rows.append((path, "password", None, None, None))
                            continue
                        rows += [(path, "success", decode_name(i), i.file_size, z.read(i)) for i in infos] or [(path, "success", None, None, None)]
                except Exception:
                    rows.append((path, "failed", None, None, None))
            yield pd.DataFrame(rows, columns=["archive", "status", "member", "size", "content"])

    return files.mapInPandas(run, "archive string, status string, member string, size bigint, content binary").withColumn("archive", local_path(F.col("archive")))


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """Distinct stripped lines of a file that are not blank."""
    return spark.read.text(path).select(T.strip(F.col("value")).alias("term")).where(F.length("term") > 0).distinct()
