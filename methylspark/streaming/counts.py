"""Running counts while files arrive. The batch operators give the same numbers once all are there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def arriving(spark: SparkSession, path: str, schema: str, files_at_once: int = 16) -> DataFrame:
    """Parquet files of records that are put into a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(path)


def reads_per_spot(records: DataFrame, spots: DataFrame) -> DataFrame:
    """(spot_id, reads) so far; state is one row a spot."""
    known = records.where("cb is not null").select(F.upper("cb").alias("cb")).join(spots, "cb")
    return known.groupBy("spot_id").agg(F.count("*").alias("reads"))


def keep(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes the whole of the counts after each batch of files, then ends when all that is there was read."""

    def put(table: DataFrame, batch: int) -> None:
        table.write.mode("overwrite").parquet(path)

    return counts.writeStream.outputMode("complete").foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
