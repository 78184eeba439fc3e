"""Excluding URLs before any page work."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkmill.functions.urls import base_domain, exclude_reason, host


def with_exclude_reason(df: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``exclude_reason``: invalid_url, blocked_domain, blocked_extension or null."""
    return df.withColumn("exclude_reason", exclude_reason(F.col(url)))


def usable_urls(df: DataFrame, url: str = "url") -> DataFrame:
    return df.where(exclude_reason(F.col(url)).isNull())


def split_by_domains(df: DataFrame, domains: DataFrame, url: str = "url") -> tuple[DataFrame, DataFrame]:
    """(rows on the domain list, rows off it), by base domain or whole host, for a list kept as a table.

    ``domains`` has one column ``domain``. Whether it is broadcast is left to its measured size.
    """
    names = domains.select("domain").distinct()
    h = host(F.col(url))
    keyed = df.withColumn("_host", h).withColumn("_base", base_domain(F.col("_host")))
    by_host = names.withColumnRenamed("domain", "_host").withColumn("_host_hit", F.lit(True))
    by_base = names.withColumnRenamed("domain", "_base").withColumn("_base_hit", F.lit(True))
    marked = keyed.join(by_host, "_host", "left").join(by_base, "_base", "left")
    hit = F.coalesce("_host_hit", "_base_hit", F.lit(False))
    return marked.where(hit).select(*df.columns), marked.where(~hit).select(*df.columns)
