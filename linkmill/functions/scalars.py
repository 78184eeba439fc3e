"""Scalar expressions: ids, times, word counts, paths, sizes."""

from __future__ import annotations

import datetime
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

BASE36_ID = r"^[0-9A-Za-z]+\z"

#: The characters of Unicode's White_Space property, which ``(?U)\s`` stands for. Fixed values.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def base36_to_long(col: Column) -> Column:
    """Base36 text to BIGINT; null for anything that is not a plain base36 number or lies beyond the BIGINT range.

    Leading zeros don't count. What is left is converted in two halves of which none can overflow.
    """
    digits = F.ltrim(col, F.lit("0"))
    low = F.conv(F.concat(F.lit("0"), F.right(digits, F.lit(6))), 36, 10).cast("decimal(38,0)")
    high = F.conv(F.concat(F.lit("0"), F.left(digits, F.greatest(F.length(digits) - 6, F.lit(0)))), 36, 10)
    value = high.cast("decimal(20,0)") * F.lit(36**6).cast("decimal(10,0)") + low
    return F.when(col.rlike(BASE36_ID) & (F.length(digits) <= 13), value.try_cast("bigint"))


def long_to_base36(col: Column) -> Column:
    """BIGINT to lower-case base36 text."""
    return F.lower(F.conv(col.cast("string"), 10, 36))


def epoch_to_ntz(col: Column) -> Column:
    """Epoch seconds (number or numeric text, fraction dropped) to a zone-free UTC timestamp; null if not a number."""
    seconds = F.floor(F.abs(number := col.try_cast("decimal(20,6)"))) * F.signum(number).cast("int")
    in_range = seconds.between(-62135596800, 253402300799)
    epoch = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    zero = F.lit(0)
    return epoch + F.make_dt_interval(zero, zero, zero, F.when(in_range, seconds).cast("decimal(18,6)"))


def iso_timestamp(col: Column) -> Column:
    """ISO-8601 text with whole seconds."""
    return F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss")


def word_count(text: Column) -> Column:
    """Number of whitespace-separated words."""
    return F.size(F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")).cast("bigint")


def space_words(text: Column) -> Column:
    """Number of pieces between single spaces; empty pieces count, as in a plain split on one space."""
    return F.size(F.split(text, " ", -1)).cast("bigint")


def strip(text: Column) -> Column:
    """Remove leading and trailing Unicode whitespace, in one pass from each end."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def has_text(text: Column) -> Column:
    """There is a character that is no Unicode whitespace; false for null."""
    return F.coalesce(text.rlike(r"(?U)\S"), F.lit(False))


def join_paragraphs(paragraphs: Column, joiner: str = "\n\n") -> Column:
    return F.array_join(paragraphs, joiner)


@F.pandas_udf(T.StringType())
def nfkd_udf(text: pd.Series) -> pd.Series:
    """Unicode NFKD; Spark has no built-in for it."""
    return text.map(lambda t: unicodedata.normalize("NFKD", t), na_action="ignore")


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def replace_in_name(path: Column, old: str, new: str) -> Column:
    """Rewrite the last path component only."""
    name = base_name(path)
    folder = F.left(path, F.length(path) - F.length(name))
    return F.concat(folder, F.replace(name, F.lit(old), F.lit(new)))


def append_suffix(path: Column, suffix: str) -> Column:
    return F.concat(path, F.lit(suffix))


def parse_month(period: str) -> datetime.datetime:
    """``"m,yyyy"`` to the first instant of that month."""
    month, year = (int(part) for part in period.split(","))
    return datetime.datetime(year, month, 1)


def month_column(period: Column) -> Column:
    """``"m,yyyy"`` text to the first day of that month."""
    parts = F.split(period, ",")
    return F.make_date(
        F.trim(F.get(parts, F.lit(1))).cast("int"), F.trim(F.get(parts, F.lit(0))).cast("int"), F.lit(1)
    )


def next_month(day: datetime.datetime) -> datetime.datetime:
    return datetime.datetime(day.year + day.month // 12, day.month % 12 + 1, 1)


def scaled(col: Column, unit: float) -> Column:
    """A size in units of ``unit`` (1e6 for MB, 1e9 for GB), two decimals."""
    return F.round(col / F.lit(float(unit)), 2)


def percent(part: Column, whole: Column) -> Column:
    """``part / whole`` in percent, two decimals; null if there is nothing to divide by."""
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")) * 100, 2)
