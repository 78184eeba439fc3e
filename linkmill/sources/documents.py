"""Documents as JSON lines: one ``{"text": ..., "meta": {...}}`` object, or a bare JSON string, per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkmill.sources.files import read_lines
from linkmill.sources.zstd import write_zst_lines

# Fixed value: joiner of texts stored as a list of paragraphs.
PARAGRAPH_JOINER = "\n\n"


def parse_documents(
    lines: DataFrame,
    get_meta: bool = True,
    autojoin_paragraphs: bool = True,
    para_joiner: str = PARAGRAPH_JOINER,
    meta_schema: T.StructType | None = None,
    line: str = "value",
) -> DataFrame:
    """``text`` and, with ``get_meta``, ``meta``: JSON text by default, a struct if ``meta_schema`` is given.

    Text given as a list is joined, or kept as a list if ``autojoin_paragraphs`` is off (a plain text is then a
    list of one). Missing meta is an empty object. A bare string has no meta, so asking for it is an error, as
    is a line that is no document at all. Empty lines are skipped.
    """
    lines = lines.where(F.col(line) != "")
    value = F.col(line)
    is_bare = F.ltrim(value).startswith('"')
    meta_type = "string" if meta_schema is None else meta_schema.simpleString()
    document = F.from_json(value, f"text string, meta {meta_type}")
    as_list = F.from_json(value, "text array<string>")["text"]
    # An object around the bare value lets the same JSON reader unquote it.
    bare = F.from_json(F.concat(F.lit('{"text":'), value, F.lit("}")), "text string")["text"]
    read = F.struct(
        F.when(is_bare, bare).alias("_bare"),
        F.when(~is_bare, document).alias("_doc"),
        F.when(~is_bare, as_list).alias("_list"),
    )
    # Through a generator, so that every line is parsed once, however often its parts are used.
    shaped = lines.select("*", F.inline(F.array(read)))
    single = F.coalesce("_bare", F.col("_doc.text"))
    bad = F.raise_error(F.concat(F.lit("not a document: "), F.left(value, F.lit(200))))
    if autojoin_paragraphs:
        text = F.coalesce(F.array_join("_list", para_joiner), single, bad.cast("string"))
    else:
        text = F.coalesce("_list", F.when(single.isNotNull(), F.array(single)), bad.cast("array<string>"))
    others = [c for c in lines.columns if c != line]
    if not get_meta:
        return shaped.select(text.alias("text"), *others)
    empty = F.lit("{}") if meta_schema is None else F.from_json(F.lit("{}"), meta_schema)
    no_meta = F.raise_error(F.lit("a bare string has no meta")).cast(meta_type)
    meta = F.when(is_bare, no_meta).otherwise(F.coalesce(F.col("_doc.meta"), empty))
    return shaped.select(text.alias("text"), meta.alias("meta"), *others)


def read_documents(spark: SparkSession, paths: str | list[str], pattern: str = "*", **options) -> DataFrame:
    """Documents of all files below ``paths`` with their ``source_file``; options as in ``parse_documents``."""
    return parse_documents(read_lines(spark, paths, pattern), **options)


def document_lines(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One JSON object per row in ``value``; nulls stay visible, times are ISO-8601 in whole seconds, as the
    dumps give them."""
    meta = F.col("meta")
    options = {"ignoreNullFields": "false", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss"}
    if isinstance(df.schema["meta"].dataType, T.StringType):
        # Open metadata is JSON already and is spliced in as it is.
        text = F.to_json(F.struct("text"), options)
        opened = F.left(text, F.length(text) - 1)
        return df.select(
            F.concat(opened, F.lit(',"meta":'), F.coalesce(meta, F.lit("{}")), F.lit("}")).alias("value"),
            *(keep or []),
        )
    return df.select(F.to_json(F.struct("text", "meta"), options).alias("value"), *(keep or []))


def write_documents(
    df: DataFrame,
    path: str,
    compression: str = "zstd",
    prefix: str = "part-",
    max_records_per_file: int = 0,
    mode: str = "overwrite",
) -> None:
    """Write (text, meta) as ``.jsonl.zst`` files, or with one of Spark's own codecs (gzip, bzip2, none)."""
    lines = document_lines(df)
    if compression == "zstd":
        write_zst_lines(lines, path, prefix, max_records_per_file, mode)
        return
    lines.write.mode(mode).option("maxRecordsPerFile", max_records_per_file).text(path, compression=compression)


def write_named_documents(df: DataFrame, path: str, file_name: str = "file_name") -> None:
    """Write (text, meta) as exactly one ``.jsonl.zst`` file per value of ``file_name``.

    One task writes a whole file, so this is for files of bounded size, such as URL batches.
    """
    lines = document_lines(df.withColumn("file_name", F.col(file_name)), keep=["file_name"])
    grouped = lines.repartition("file_name").sortWithinPartitions("file_name")
    write_zst_lines(grouped, path)
