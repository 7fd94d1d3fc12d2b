"""Files around the store: Markdown, chunk JSON, JSON lines of records, and settings."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt"
RECORD = T.StructType([T.StructField("id", T.StringType()), T.StructField("text", T.StringType()), T.StructField("metadata", T.StringType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField(CORRUPT, T.StringType())])


def read_markdown(spark: SparkSession, path: str) -> DataFrame:
    """doc (the file's name without its last part), md: each file as one row."""
    files = spark.read.text(path, wholetext=True)
    return files.select(F.regexp_replace(F.element_at(F.split(F.input_file_name(), "/"), -1), r"\.[^.]*$", "").alias("doc"), F.col("value").alias("md"))


def read_chunks(spark: SparkSession, paths: list[str]) -> DataFrame:
    """id, text, metadata (JSON text) of JSON files that each hold an array, one after the other."""
    kind = T.StructType([T.StructField("id", T.StringType()), T.StructField("text", T.StringType()), T.StructField("metadata", T.StringType())])
    out = None
    for path in paths:
        one = spark.read.schema(kind).json(path, multiLine=True)
        out = one if out is None else out.unionByName(one)
    return spark.createDataFrame([], kind) if out is None else out


def read_records(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(records, errors): the lines that are JSON objects with an id, with pos in order of file and line, and those that are not.

    Blank lines are neither. metadata is kept as JSON text. Lines are read as text, so that pos is known: they stay in the order of their
    file within a split, and splits in that of the file.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    lines = lines.select("value", F.struct(F.input_file_name().alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")).alias("pos"))
    parsed = lines.withColumn("r", F.from_json("value", RECORD, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))
    ok = F.col(f"r.{CORRUPT}").isNull() & F.col("r.id").isNotNull()
    return parsed.where(ok).select("r.id", "r.text", "r.metadata", "r.embedding", "pos"), parsed.where(~ok).select("value", "pos")


def done_ids(spark: SparkSession, path: str) -> DataFrame:
    """The ids in a folder or file of records, each once; none if there is no such file. Lines that are not JSON do not count."""
    empty = spark.createDataFrame([], "id string")
    try:
        return spark.read.schema("id string").json(path, mode="DROPMALFORMED").where("id IS NOT NULL").distinct()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return empty
        raise


def line_count(spark: SparkSession, path: str) -> int:
    """How many lines are not blank."""
    return spark.read.text(path).where(F.trim("value") != "").count()


def write_chunks(chunks: DataFrame, path: str) -> None:
    """Chunks as JSON lines; an empty table gives an empty folder."""
    chunks.write.mode("overwrite").json(path)


def append_records(records: DataFrame, path: str, force: bool = False) -> None:
    """Records appended as JSON lines, or instead of what was there with `force`."""
    records.write.mode("overwrite" if force else "append").json(path)


def read_settings(path: str, into: dict[str, str] | None = None) -> dict[str, str]:
    """NAME=value lines of a settings file; blank lines, # lines and lines without = are passed over, one pair of equal quotes around a
    value is taken off. Names that are set already (in `into`, or the environment) keep their value."""
    target = os.environ if into is None else into
    file = Path(path)
    for raw in file.read_text(encoding="utf-8").splitlines() if file.exists() else []:
        line = raw.strip()
        if not line or line.startswith("#") or "=" not in line:
            continue
        name, value = (x.strip() for x in line.split("=", 1))
        if len(value) > 1 and value[0] == value[-1] and value[0] in "'\"":
            value = value[1:-1]
        target.setdefault(name, value)
    return dict(target)


def as_bool(value: str | None, default: bool = False) -> bool:
    """1, true, yes and on are true; None is the default."""
    return default if value is None else value.strip().lower() in ("1", "true", "yes", "on")
