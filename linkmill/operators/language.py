"""Language by text, for documents that declare none: profiles of the letters with which words begin and end."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkmill.session import written

#: N-grams of a language's profile, and languages with most words that get one. Profiles are broadcast, at most
#: PROFILE * LANGUAGES rows.
PROFILE, LANGUAGES = 1_000, 64
#: Weights are whole thousandths of a natural logarithm, so that sums are exact.
SCALE = 1_000


def edge_grams(text: Column) -> Column:
    """For each word its first and its last two letters, marked by where they stand; two for each word."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0))
    return F.flatten(
        F.transform(words, lambda w: F.array(F.concat(F.lit("_"), F.left(w, F.lit(2))), F.concat(F.right(w, F.lit(2)), F.lit("_"))))
    )


@dataclass
class Profiles:
    """``rows``: (gram, gains), what each language gains by an n-gram over one that it doesn't know; ``base``: what it has
    for those; ``langs``: the languages in this order."""

    rows: DataFrame
    langs: list[str]
    base: list[int]


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Profiles:
    """Profiles from documents that declare their language; counts combine map-side, and rows without one don't count."""
    known = labelled.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.explode(edge_grams(F.col(text))).alias("gram"))
    counts = written(known.groupBy("lang", "gram").agg(F.count(F.lit(1)).alias("n")), "grams")
    sizes = counts.groupBy("lang").agg(F.sum("n").alias("total")).orderBy(F.desc("total"), "lang").limit(LANGUAGES)
    totals = {r.lang: r.total for r in sizes.collect()}
    langs = sorted(totals)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = counts.where(F.col("lang").isin(*langs)).withColumn("_place", place).where(F.col("_place") <= PROFILE)
    log = lambda x: F.floor(F.log(x) * SCALE).cast("bigint")
    base = labelled.sparkSession.createDataFrame([(x, totals[x]) for x in langs], "lang string, total bigint")
    base = base.withColumn("base", log(1 / (F.col("total") + PROFILE)))
    gain = log((F.col("n") + 1) / (F.col("total") + PROFILE)) - F.col("base")
    gained = top.join(F.broadcast(base), "lang").groupBy("gram")
    names = [F.coalesce(F.max(F.when(F.col("lang") == x, gain)), F.lit(0)).alias(f"_g{i}") for i, x in enumerate(langs)]
    rows = gained.agg(*names) if langs else gained.agg(F.lit(0).alias("_g"))
    bases = {r.lang: r.base for r in base.collect()}
    return Profiles(written(rows, "profiles"), langs, [bases[x] for x in langs])


def detect(docs: DataFrame, profiles: Profiles, key: str, text: str = "text") -> DataFrame:
    """(key, detected): the language with the highest likelihood, the first by name of equal ones; null without letters.

    ``key`` tells documents apart. Whole texts are read; the n-grams of a document are summed where they are made, and
    only one row a document is shuffled.
    """
    if not profiles.langs:
        return docs.select(key, F.lit(None).cast("string").alias("detected"))
    grams = docs.select(key, F.explode_outer(edge_grams(F.col(text))).alias("gram"))
    met = grams.join(F.broadcast(profiles.rows), "gram", "left")
    sums = [F.sum(F.coalesce(f"_g{i}", F.lit(0))).alias(f"_s{i}") for i in range(len(profiles.langs))]
    scored = met.groupBy(key).agg(F.count("gram").alias("_n"), *sums)
    scores = [
        F.struct((F.col("_n") * b + F.col(f"_s{i}")).alias("score"), F.lit(-i).alias("order"), F.lit(x).alias("lang"))
        for i, (x, b) in enumerate(zip(profiles.langs, profiles.base))
    ]
    best = F.array_max(F.array(*scores))["lang"]
    return scored.select(key, F.when(F.col("_n") > 0, best).alias("detected"))


def with_language(docs: DataFrame, profiles: Profiles, key: str, text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` with ``lang`` filled in where it is null; only those documents are looked at."""
    found = detect(docs.where(F.col(lang).isNull()), profiles, key, text)
    filled = F.coalesce(F.col(lang), F.col("detected"))
    return docs.join(found, key, "left").select(*[filled.alias(c) if c == lang else F.col(f"`{c}`") for c in docs.columns])
