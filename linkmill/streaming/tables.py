"""Tables that grow by one folder per micro-batch, so that a replayed batch overwrites what it wrote before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_batches(
    spark: SparkSession, path: str, schema: T.StructType, without_batch: int | None = None
) -> DataFrame:
    """All batches written so far, or none if there is no table yet."""
    with_batch = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    try:
        table = spark.read.schema(with_batch).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)
    if without_batch is not None:
        table = table.where(F.col("batch_id") != without_batch)
    return table.select(*schema.fieldNames())
