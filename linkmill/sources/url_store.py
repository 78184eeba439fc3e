"""URL records kept up to date period by period, copy on write.

Records lie in folders by a hash of their URL. A new period writes new folders only for the hash buckets it touches, and
a manifest that says for every bucket which version holds it; all other files stay as they are, and older versions can
still be read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from linkmill.operators.url_records import MAX_META_PER_ROW, MIN_SCORE, merge_url_records
from linkmill.schemas import URL_META
from linkmill.session import written

_RECORD = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("total_score", T.LongType()),
        T.StructField("first_created", T.TimestampNTZType()),
        T.StructField("meta", URL_META),
    ]
)


@dataclass(frozen=True)
class UrlStore:
    """A store at ``path``. ``buckets`` can't change later; the manifest has as many rows, so it is always small."""

    path: str
    buckets: int = 256
    max_meta_per_row: int = MAX_META_PER_ROW

    def _bucket(self, url: Column) -> Column:
        return F.pmod(F.xxhash64(url), F.lit(self.buckets)).cast("int")

    def _read(self, spark: SparkSession, what: str, schema: str | T.StructType) -> DataFrame:
        try:
            return spark.read.schema(schema).parquet(f"{self.path}/{what}")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return spark.createDataFrame([], schema)

    def versions(self, spark: SparkSession) -> list[int]:
        """Finished versions, oldest first."""
        rows = self._read(spark, "manifest", "bucket int, held_by int, version int").select("version").distinct().collect()
        return sorted(r.version for r in rows)

    def manifest(self, spark: SparkSession, version: int) -> DataFrame:
        """(bucket, held_by): the version whose folder holds each bucket."""
        rows = self._read(spark, "manifest", "bucket int, held_by int, version int")
        return rows.where(F.col("version") == version).select("bucket", "held_by")

    def _records(self, spark: SparkSession, held: DataFrame) -> DataFrame:
        """Records of (bucket, held_by) pairs; only their folders are read. There is a pair a bucket at most."""
        schema = T.StructType([*_RECORD.fields, T.StructField("version", T.IntegerType()), T.StructField("bucket", T.IntegerType())])
        rows = self._read(spark, "records", schema)
        pairs = F.broadcast(held.withColumnRenamed("held_by", "version"))
        return rows.join(pairs, ["version", "bucket"], "left_semi").select(*_RECORD.fieldNames())

    def read(self, spark: SparkSession, version: int | None = None, min_score: int | None = MIN_SCORE) -> DataFrame:
        """The records of a version, the latest by default, with the score test."""
        known = self.versions(spark)
        if version is None and known:
            version = known[-1]
        rows = self._records(spark, self.manifest(spark, -1 if version is None else version))
        return rows if min_score is None else rows.where(F.col("total_score") >= min_score)

    def merge(self, run: DataFrame, version: int) -> None:
        """Add the records of one period as a new version.

        ``run`` comes from ``build_url_records`` with ``min_score=None``. The result is that of ``merge_url_records``
        over all periods: an id that an earlier period gave another URL is pooled as well, which is why ids are kept
        beside with their buckets. Writing the same version again, after a failure, replaces it; a version counts once
        its manifest, which goes last, is there.
        """
        spark = run.sparkSession
        known = [v for v in self.versions(spark) if v < version]
        before = written(self.manifest(spark, known[-1] if known else -1), "manifest")
        run = written(run.select(*_RECORD.fieldNames()), "run")
        ids = run.select(F.explode("meta.id").alias("id"), self._bucket(F.col("url")).alias("bucket"))
        seen = self._read(spark, "ids", "id bigint, bucket int, version int").where(F.col("version") < version)
        elsewhere = seen.select("id", "bucket").join(ids.select("id"), "id", "left_semi").select("bucket")
        touched = written(ids.select("bucket").union(elsewhere).distinct(), "touched")

        old = self._records(spark, before.join(F.broadcast(touched), "bucket", "left_semi"))
        merged = merge_url_records(old, run, min_score=None, max_meta_per_row=self.max_meta_per_row)
        placed = merged.select(*_RECORD.fieldNames(), self._bucket(F.col("url")).alias("bucket"))
        placed.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/records/version={version}")
        ids.write.mode("overwrite").parquet(f"{self.path}/ids/version={version}")
        kept = before.join(F.broadcast(touched), "bucket", "left_anti")
        now = kept.unionByName(touched.withColumn("held_by", F.lit(version)))
        now.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/version={version}")
