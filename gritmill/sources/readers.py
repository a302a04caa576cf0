"""Scans: files of any of the known formats as DataFrames of rows, documents or archive members."""

from __future__ import annotations

import io
import os
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gritmill.operators.nested import as_list, member, parse_document, text_of

#: Preferred first, where a folder holds the same table in several formats.
FORMATS = (".parquet", ".csv.gz", ".jsonl", ".csv")
_NO_DATA = ("manifest", "metadata", "_dedup", "report", "summary")


@dataclass(frozen=True)
class SilverFile:
    path: str
    source_id: str
    source_name: str


def discover(root: str | Path, all_formats: bool = False) -> list[SilverFile]:
    """Silver tables below a folder, sorted by folder: the best format of each subfolder, then the files at the top.

    Folders that start with ``_`` and files named as manifests, metadata or reports are no tables. With ``all_formats`` every
    format counts, so that twins of a table are both there.
    """
    root = Path(root)

    def pick(folder: Path) -> list[Path]:
        files = [p for p in sorted(folder.iterdir()) if p.name.endswith(FORMATS) and not any(w in p.name for w in _NO_DATA)]
        if all_formats:
            return files
        for suffix in FORMATS:
            own = [p for p in files if p.name.endswith(suffix)]
            if own:
                return own[:1]
        return []

    out = []
    for folder in sorted(p for p in root.iterdir() if p.is_dir() and not p.name.startswith("_")):
        out += [SilverFile(str(p), _slug(folder.name), folder.name) for p in pick(folder)]
    top = [p for p in sorted(root.iterdir()) if p.is_file() and p.name.endswith(FORMATS) and not any(w in p.name for w in _NO_DATA)]
    return out + [SilverFile(str(p), _slug(p.name.split(".")[0]), p.name.split(".")[0]) for p in top]


def table_files(root: str | Path, patterns: tuple[str, ...] = ("*", "*/*"), manifest: str = "silver_manifest.csv") -> list[str]:
    """Tables below a folder: those that its manifest lists and that exist, else all files of known formats by patterns, sorted.

    Manifests, metadata and what lies in ``_dedup`` are no tables. A table in several formats is there once, in the preferred one.
    """
    root = Path(root)
    listed = root / manifest
    if listed.exists():
        names = pd.read_csv(listed).get("output_path_parquet", pd.Series(dtype=str)).dropna()
        # paths are relative to the manifest's folder or as they stand
        found = sorted({str(p) for n in names if n for p in (root / str(n), Path(str(n))) if p.exists()})
        if found:
            return found
    files = {p for pattern in patterns for p in root.glob(pattern) if (p.is_file() or p.name.endswith(".parquet")) and p.name.endswith(FORMATS) and "metadata" not in p.name and p.name != manifest and "_dedup" not in p.parts}
    best: dict[str, Path] = {}
    for p in sorted(files, key=lambda p: (next(i for i, f in enumerate(FORMATS) if p.name.endswith(f)), str(p))):
        stem = next(p.name.removesuffix(f) for f in FORMATS if p.name.endswith(f))
        best.setdefault(str(p.parent / stem), p)
    return sorted(str(p) for p in best.values())


def sidecar(folder: str | Path) -> dict:
    """The first metadata file of a folder that can be read as JSON; empty if there is none."""
    import json

    for path in sorted(Path(folder).glob("*metadata.json")):
        try:
            return json.loads(path.read_text(encoding="utf-8"))
        except (ValueError, OSError):
            continue
    return {}


def cheap_count(path: str) -> int | None:
    """Rows of a local file without parsing it: lines (less the header of CSV), or Parquet's own number; null for others."""
    import pyarrow.parquet as pq

    try:
        if path.endswith(".parquet"):
            return pq.read_metadata(path).num_rows
        if path.endswith((".csv", ".jsonl")):
            with open(path, "rb") as file:
                lines, last = 0, b"\n"
                while block := file.read(1 << 20):
                    lines, last = lines + block.count(b"\n"), block[-1:]
            return max(0, lines + (last != b"\n") - path.endswith(".csv"))
    except (OSError, ValueError):
        pass
    return None


def _slug(name: str) -> str:
    return "_".join("".join(c if c.isascii() and c.isalnum() else " " for c in name.lower()).split()) or "unknown_source"


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Parquet, JSON lines, JSON or CSV by the name's end; CSV has a header, quotes doubled and line ends within quotes."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    if path.endswith(".parquet"):
        return reader.parquet(path)
    if path.endswith((".jsonl", ".ndjson", ".jsonl.gz")):
        return reader.json(path)
    if path.endswith(".json"):
        return reader.option("multiLine", True).json(path)
    if path.endswith((".csv", ".csv.gz")):
        return csv(spark, path, schema)
    raise ValueError(f"no reader for {path}")


def broken_rows(spark: SparkSession, path: str, columns: list[str]) -> int:
    """Rows of a CSV that the reader drops since they don't fit its columns."""
    schema = ", ".join(f"`{c}` string" for c in (*columns, "_corrupt"))
    rows = spark.read.options(header=True, multiLine=True, escape='"', mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt", encoding=encoding_of(path)).schema(schema).csv(path)
    return rows.agg(F.count_if(F.col("_corrupt").isNotNull()).alias("n"), F.count(f"`{columns[0]}`")).first().n


def csv(spark: SparkSession, path: str, schema=None, names: list[str] | None = None, comment: str | None = None) -> DataFrame:
    """CSV as strings unless a schema is given; rows that don't fit are dropped, and counted by ``broken_rows``. ``names`` are those of a file without header."""
    options = {"header": names is None, "multiLine": True, "escape": '"', "mode": "DROPMALFORMED", "encoding": encoding_of(path)}
    if comment:
        options["comment"] = comment
    reader = spark.read.options(**options)
    if names is not None:
        schema = schema or ", ".join(f"`{n}` string" for n in names)
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def encoding_of(path: str, sample: int = 1 << 16) -> str:
    """UTF-8 if the first bytes of a local file are, else ISO-8859-1; gzip is looked into, whatever the name says."""
    import gzip

    if not os.path.isfile(path):
        return "UTF-8"
    with open(path, "rb") as file:
        head = file.read(2)
    opener = gzip.open if head == b"\x1f\x8b" else open
    with opener(path, "rb") as file:
        data = file.read(sample)
    try:
        data[: len(data) - 4 if len(data) == sample else None].decode("utf-8")
    except UnicodeDecodeError:
        return "ISO-8859-1"
    return "UTF-8"


def files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(file, content, size) of all files below a folder that match."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    return reader.load(path).select(F.col("path").alias("file"), "content", F.col("length").alias("size"))


def texts(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(file, text) of whole text files; bytes that are no UTF-8 are replaced."""
    return files(spark, path, pattern).select("file", F.decode("content", "UTF-8").alias("text"))


def documents(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """(file, v) of each item of JSON files: of a list, or of the first of the known lists in an object, else the object.

    Files of JSON lines have a document per line.
    """
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.jsonl").text(path) if "jsonl" in pattern else None
    if lines is not None:
        return lines.select(F.col("_metadata.file_path").alias("file"), parse_document(F.col("value")).alias("v")).where("v is not null")
    whole = texts(spark, path, pattern).select("file", parse_document(F.col("text")).alias("d")).where("d is not null")
    nested = [F.when(member(F.col("d"), k).isNotNull(), member(F.col("d"), k)) for k in ("vulnerabilities", "CVE_Items", "objects", "data")]
    items = F.coalesce(*nested, F.col("d"))
    return whole.select("file", F.explode(as_list(items)).alias("v"))


def yaml_documents(spark: SparkSession, path: str) -> DataFrame:
    """(file, v) of YAML files whose document is a mapping; version-control and cache folders are passed over."""

    def load(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import json

        import yaml

        for batch in batches:
            rows = []
            for file, content in zip(batch["file"], batch["content"]):
                try:
                    value = yaml.safe_load(content)
                except yaml.YAMLError:
                    continue
                if isinstance(value, dict):
                    rows.append((file, json.dumps(value, default=str)))
            yield pd.DataFrame(rows, columns=["file", "text"])

    found = files(spark, path, "*.{yml,yaml}").where(~F.col("file").rlike(r"/(\.git|__pycache__|\.cache)/"))
    return found.select("file", "content").mapInPandas(load, "file string, text string").select("file", parse_document(F.col("text")).alias("v"))


def zip_members(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """(file, name, text) of the members of ZIP files whose name matches a regular expression, sorted; nothing is extracted."""
    import re

    wanted = re.compile(pattern)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, content in zip(batch["file"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for name in sorted(n for n in archive.namelist() if wanted.search(n)):
                        yield pd.DataFrame([(file, name, archive.read(name).decode("utf-8", "replace"))], columns=["file", "name", "text"])

    return files(spark, path, "*.zip").select("file", "content").mapInPandas(read, "file string, name string, text string")


def xml(spark: SparkSession, path: str, row: str, schema: str) -> DataFrame:
    """Elements of one name, whatever their namespace prefix; attributes have ``_`` before their name."""
    return spark.read.format("xml").option("rowTag", row).option("ignoreNamespace", True).schema(schema).load(path)


def with_sources(files_: DataFrame, rows: DataFrame, key: str, kept: bool = True) -> DataFrame:
    """Rows with the text of the file whose path ends in ``key``; of several the one with the shortest path, then the first.

    Left join, or inner if rows without a file are not ``kept``; rows are never repeated. The base name is the join's key, whole path
    ends decide.
    """
    base = lambda path: F.regexp_extract(path, r"([^/]+)$", 1)
    wanted = rows.select(F.col(key).alias("__gm_key")).where("__gm_key is not null").distinct()
    found = wanted.withColumn("__gm_name", base(F.col("__gm_key"))).join(files_.select(base(files_["file"]).alias("__gm_name"), F.col("file").alias("__gm_file"), F.col("text").alias("__gm_text")), "__gm_name")
    found = found.where(F.concat(F.lit("/"), "__gm_file").endswith(F.concat(F.lit("/"), F.ltrim("__gm_key", F.lit("/")))))
    best = found.groupBy("__gm_key").agg(F.min_by("__gm_text", F.struct(F.length("__gm_file"), "__gm_file")).alias("source_text"))
    return rows.join(best, F.col(key) == F.col("__gm_key"), "left" if kept else "inner").drop("__gm_key")


def load_tables(spark: SparkSession, paths: list[str], most: int | None = None) -> DataFrame:
    """Union by name of several tables with the file in ``__source_file``; if given, the first ``most`` rows in all, in the order of the files and by content."""
    out = None
    for path in paths:
        rows = read_table(spark, path).withColumn("__source_file", F.lit(os.path.basename(path)))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    if out is None:
        return spark.createDataFrame([], "__source_file string")
    if most is None:
        return out
    places = F.create_map(*[F.lit(x) for i, p in reversed(list(enumerate(paths))) for x in (os.path.basename(p), i)]) if len({os.path.basename(p) for p in paths}) == len(paths) else None
    first = [places[F.col("__source_file")]] if places is not None else ["__source_file"]
    return out.orderBy(*first, *[F.col(f"`{c}`") for c, kind in out.dtypes if not kind.startswith(("map", "variant"))]).limit(most)


def kind_of(columns: list[str]) -> str:
    """What a table is by its columns: sft, gold, silver, manifest or unknown."""
    have = set(columns)
    for name, needed in (("sft", {"messages_json"}), ("sft", {"messages"}), ("gold", {"evaluation_head", "input_text"}), ("unified", {"dedup_hash", "normalized_text"}), ("silver", {"raw_text", "main_category"}), ("manifest", {"output_path_parquet"})):
        if needed <= have:
            return name
    return "unknown"


def scalar(v, *path: str):
    """Text of a member of a document by its keys."""
    for key in path:
        v = member(v, key)
    return text_of(v)
