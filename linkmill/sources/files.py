"""Finding files, reading their lines, and outputs that stay aligned with their input files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkmill.functions.scalars import base_name
from linkmill.session import scratch_path, written_with
from linkmill.sources.packed import PACKED_EXTENSIONS, read_packed, read_split

# Extensions that Spark's own line reader understands.
PLAIN_EXTENSIONS = ["json", "jsonl", "ndjson", "txt"]
SPARK_CODEC_EXTENSIONS = ["zst", "bz2", "gz"]
# Those of which parts can be unpacked on their own.
SPLIT_EXTENSIONS = ["xz", "zst"]


def find_files(spark: SparkSession, paths: str | list[str], pattern: str = "*") -> DataFrame:
    """(path, length): files below ``paths`` whose name fits ``pattern``, at any depth. Contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(paths)
        .select("path", "length")
    )


def _extension(path: Column) -> Column:
    return F.lower(F.substring_index(base_name(path), ".", -1))


def read_lines(spark: SparkSession, paths: str | list[str], pattern: str = "*", split: bool = False) -> DataFrame:
    """(value, source_file): the lines of every file below ``paths``, decompressed by extension, empty lines too.

    A last line without newline counts. An unknown extension is refused, because reading it as text would
    silently give garbage. Spark lists and opens the files itself, whatever their names hold; packed files are read
    by a task each, and their names don't pass through the driver. With ``split`` the parts of ``.xz`` and ``.zst`` files
    are found first, and a large file is read by several tasks.
    """
    found = find_files(spark, paths, pattern).select("path", _extension(F.col("path")).alias("extension"))
    known = [*PLAIN_EXTENSIONS, *SPARK_CODEC_EXTENSIONS, *PACKED_EXTENSIONS]
    unknown = [r.path for r in found.where(~F.col("extension").isin(known)).limit(5).collect()]
    if unknown:
        raise ValueError(f"unknown dump format: {unknown}")
    text = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(paths, lineSep="\n")
    # A condition on the file's name alone: Spark opens no other file.
    name = F.col("_metadata.file_name")
    apart = [*PACKED_EXTENSIONS, *SPLIT_EXTENSIONS] if split else PACKED_EXTENSIONS
    direct = text.where(~_extension(name).isin(apart)).select(
        "value", plain_path(F.col("_metadata.file_path")).alias("source_file")
    )
    if split:
        parted = found.where(F.col("extension").isin(SPLIT_EXTENSIONS)).select("path")
        n = parted.count()
        direct = direct.unionByName(read_split(parted, n)) if n else direct
    whole = [e for e in PACKED_EXTENSIONS if not split or e not in SPLIT_EXTENSIONS]
    packed = found.where(F.col("extension").isin(whole)).select("path")
    n = packed.count()
    return direct.unionByName(read_packed(packed, n)) if n else direct


def plain_path(uri: Column) -> Column:
    """A path as it is named, from the URI-encoded form that file metadata has."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def lines_per_file(spark: SparkSession, paths: str | list[str], pattern: str = "*") -> DataFrame:
    """(path, source_file, n_lines), packed files without lines included; ``source_file`` is the name alone. Files of no bytes
    are not listed, as Spark passes over them."""
    local = lambda c: F.regexp_replace(c, "^file:/+", "/").alias("path")  # noqa: E731  # written in several ways
    listed = find_files(spark, paths, pattern).select(local(F.col("path")))
    counted = read_lines(spark, paths, pattern).groupBy(local(F.col("source_file"))).agg(F.count(F.lit(1)).alias("n_lines"))
    return listed.join(counted, "path", "left").select(
        "path", base_name(F.col("path")).alias("source_file"), F.coalesce("n_lines", F.lit(0)).alias("n_lines")
    )


def total_size(spark: SparkSession, paths: str | list[str], pattern: str = "*") -> DataFrame:
    """(n_files, total_bytes, total_mb) from the file listing alone."""
    return find_files(spark, paths, pattern).agg(
        F.count(F.lit(1)).alias("n_files"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes"),
        F.round(F.coalesce(F.sum("length"), F.lit(0)) / F.lit(1e6), 2).alias("total_mb"),
    )


def write_aligned(df: DataFrame, path: str, source: str = "source_file") -> None:
    """One output folder per input file, so that a stage can be traced, redone or packed file by file.

    ``source`` should already carry the output name (see ``replace_in_name`` and ``append_suffix``). The rebalance
    hint brings rows of one file together, and splits a file that is far larger than the others over several tasks.
    """
    df.hint("rebalance", source).write.mode("overwrite").partitionBy(source).parquet(path)


#: Splits whose offsets are broadcast; with more of them lines are joined to their offsets by shuffle.
SPLITS_AT_ONCE = 1_000_000


def numbered_lines(spark: SparkSession, paths: str | list[str], splits_at_once: int = SPLITS_AT_ONCE) -> DataFrame:
    """(source_file, line, value): every line with its 0-based number in its file, whatever splits the file is read in.

    Lines of a split come in order, so a line's number is its place in the split plus the lines of the file's earlier
    splits. Those are counted in a first pass; nothing is sorted, and lines aren't shuffled. Files must not change
    between the passes. A missing last line feed, empty lines and empty files count as in any line reader.
    """
    text = spark.read.option("lineSep", "\n").text(paths)
    meta = text.metadataColumn("_metadata")
    lines = text.select(
        "value",
        meta["file_path"].alias("source_file"),
        meta["file_block_start"].alias("_start"),
        F.monotonically_increasing_id().alias("_at"),
    )
    sizes = lines.groupBy("source_file", "_start").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy("source_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "source_file", "_start", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_offset")
    )
    offsets, n = written_with(offsets, scratch_path(spark, "split-offsets"), F.count(F.lit(1)))
    told = F.broadcast(offsets) if n <= splits_at_once else offsets
    numbered = lines.join(told, ["source_file", "_start"])
    return numbered.select("source_file", (F.col("_at") + F.col("_offset")).cast("bigint").alias("line"), "value")
