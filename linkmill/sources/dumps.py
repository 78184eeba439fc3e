"""Dump files: posts, inventory by month, checksums."""

from __future__ import annotations

import datetime
import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmill.functions.scalars import base_name
from linkmill.schemas import RAW_POST
from linkmill.sources.files import find_files, read_lines
from linkmill.sources.packed import open_stream

# Dump names, and the order in which formats are preferred for months from 2011 on.
OLD_DUMP_NAME = "'RS_v2_'yyyy-MM'.xz'"
NEW_DUMP_NAME = "'RS_'yyyy-MM"
NEW_NAMES_FROM = "2011-01-01"
FORMAT_PREFERENCE = ["zst", "xz", "bz2"]

_RAW_DDL = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RAW_POST.fields)


def parse_posts(lines: DataFrame, line: str = "value") -> DataFrame:
    """Raw post columns plus ``_corrupt_record`` (the line itself if it is not a JSON object of posts). Empty lines are
    no posts."""
    lines = lines.where(F.col(line) != "")
    parsed = F.from_json(
        F.col(line),
        f"{_RAW_DDL}, _corrupt_record string",
        {"columnNameOfCorruptRecord": "_corrupt_record", "mode": "PERMISSIVE"},
    )
    is_object = F.ltrim(F.col(line)).startswith("{")
    others = [F.col(c) for c in lines.columns if c != line]
    # Through a generator, so that filters on the fields cannot be moved below it and parse the line again.
    rows = lines.select(line, *others, F.inline(F.array(F.when(is_object, parsed))))
    corrupt = F.when(is_object, F.col("_corrupt_record")).otherwise(F.col(line))
    return rows.select(*RAW_POST.fieldNames(), corrupt.alias("_corrupt_record"), *others)


def read_dumps(spark: SparkSession, paths: str | list[str], pattern: str = "*", split: bool = False) -> DataFrame:
    """Posts of all dumps below ``paths`` (.zst, .bz2, .xz, .gz or plain lines), with their ``source_file``."""
    return parse_posts(read_lines(spark, paths, pattern, split))


def dump_inventory(
    spark: SparkSession, available: DataFrame, start: datetime.date, end: datetime.date
) -> DataFrame:
    """(month, file_name): the dump to load for each month of the range that has one.

    ``available`` has one column ``file_name``. Before 2011 the one old name is expected; from 2011 the first
    available format counts. Months without a file are left out.
    """
    months = spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 month"))).alias("month")
    )
    is_old = F.col("month") < F.lit(NEW_NAMES_FROM).cast("date")
    old = months.where(is_old).select(
        "month", F.lit(0).alias("rank"), F.date_format("month", OLD_DUMP_NAME).alias("file_name")
    )
    new = months.where(~is_old).select(
        "month",
        F.posexplode(F.array(*[F.lit(f) for f in FORMAT_PREFERENCE])).alias("rank", "format"),
    )
    new = new.select(
        "month", "rank", F.concat_ws(".", F.date_format("month", NEW_DUMP_NAME), "format").alias("file_name")
    )
    wanted = old.unionByName(new)
    return (
        wanted.join(available.select("file_name").distinct(), "file_name")
        .groupBy("month")
        .agg(F.min_by("file_name", "rank").alias("file_name"))
    )


def parse_manifest(lines: DataFrame, line: str = "value") -> DataFrame:
    """(file_name, expected) from ``sha256``, two spaces, name."""
    parts = F.split(F.trim(F.col(line)), "  ", 2)
    return (
        lines.where(F.trim(F.col(line)) != "")
        .select(F.get(parts, F.lit(1)).alias("file_name"), F.get(parts, F.lit(0)).alias("expected"))
        .where(F.col("file_name").isNotNull())
    )


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return parse_manifest(spark.read.text(path))


def _hash_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for path in batch["path"]:
            digest = hashlib.sha256()
            with open_stream(path) as stream:
                while chunk := stream.read(1 << 20):
                    digest.update(chunk)
            rows.append((path, digest.hexdigest()))
        yield pd.DataFrame(rows, columns=["path", "actual"])


def hash_files(files: DataFrame) -> DataFrame:
    """(path, actual): sha256 of each file in ``path``, read in chunks in the task, so no file has to fit a row."""
    return files.select("path").repartition(F.col("path")).mapInPandas(_hash_files, "path string, actual string")


def file_checksums(spark: SparkSession, paths: str | list[str], pattern: str = "*") -> DataFrame:
    """(file_name, actual): sha256 of each file."""
    return hash_files(find_files(spark, paths, pattern)).select(base_name(F.col("path")).alias("file_name"), "actual")


def verify_files(checksums: DataFrame, manifest: DataFrame) -> DataFrame:
    """(file_name, status): ok, mismatch, or unlisted for a file without a manifest line."""
    return checksums.join(manifest, "file_name", "left").select(
        "file_name",
        F.when(F.col("expected").isNull(), "unlisted")
        .when(F.lower("expected") == F.col("actual"), "ok")
        .otherwise("mismatch")
        .alias("status"),
    )
