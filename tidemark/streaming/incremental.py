"""Incremental intake: idempotent appends, retention, late and revised rows, and windows over streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def new_rows(batch: DataFrame, stored: DataFrame | None, keys: list[str]) -> DataFrame:
    """The batch's rows, once a key, that the store lacks: appending them twice adds nothing."""
    once = batch.dropDuplicates(keys)
    return once if stored is None else once.join(stored.select(*keys).distinct(), keys, "left_anti")


def retained(rows: DataFrame, date: str, n: int) -> DataFrame:
    """Rows of the last n distinct dates."""
    kept = rows.select(date).distinct().orderBy(F.col(date).desc()).limit(n)
    return rows.join(F.broadcast(kept), date, "left_semi")


def missing_dates(stored: DataFrame, expected: DataFrame, date: str) -> DataFrame:
    return expected.select(date).distinct().join(stored.select(date).distinct(), date, "left_anti")


def check_gap(last, target, most_days: int = 45) -> None:
    """Refuse to go back, and to catch up over more days than a run may."""
    if target < last:
        raise ValueError(f"{target} is before the stored {last}")
    if (target - last).days > most_days:
        raise ValueError(f"{(target - last).days} days to catch up; at most {most_days}")


def upsert(stored: DataFrame | None, batch: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The newest answer of each key wins."""
    both = batch if stored is None else stored.unionByName(batch, allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc_nulls_last())
    return both.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def append_stream(source: DataFrame, path: str, checkpoint: str, keys: list[str]):
    """A query that appends each micro-batch's new rows to a Parquet table; replays add nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        try:
            stored = spark.read.parquet(path)
        except Exception as e:  # the table starts with its first batch
            if "PATH_NOT_FOUND" not in str(e):
                raise
            stored = None
        new_rows(batch, stored, keys).write.mode("append").parquet(path)

    return source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True)


def timed(events: DataFrame, column: str = "ts", delay: str | None = None) -> DataFrame:
    """Events with a timestamp that may carry a watermark."""
    t = events.withColumn(column, F.col(column).cast("timestamp"))
    return t.withWatermark(column, delay) if delay else t


def tumbling(events: DataFrame, width: str = "1 day") -> DataFrame:
    """Counts and sums of fixed windows by type; works on batches and streams."""
    return _windowed(events, F.window("ts", width))


def sliding(events: DataFrame, width: str = "1 day", step: str = "6 hours") -> DataFrame:
    return _windowed(events, F.window("ts", width, step))


def _windowed(events: DataFrame, w) -> DataFrame:
    per = events.groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return per.select(F.col("w.start").alias("w_start"), F.col("w.end").alias("w_end"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    per = events.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n"))
    return per.select("user_id", F.col("w.start").alias("w_start"), F.col("w.end").alias("w_end"), "n")


def drop_repeats(events: DataFrame, keys: list[str], delay: str) -> DataFrame:
    """Of a stream, the first row of each key within the watermark."""
    return timed(events, delay=delay).dropDuplicatesWithinWatermark(keys)


def on_time(events: DataFrame, delay_days: int = 7) -> DataFrame:
    """What a watermark would keep of a batch read in arrival order (event_id): rows not older than the newest before them less the delay."""
    past = Window.partitionBy(F.lit(0)).orderBy("event_id").rowsBetween(Window.unboundedPreceding, -1)
    newest = F.max("ts").over(past)
    return events.withColumn("is_late", F.coalesce(F.col("ts") < newest - F.make_dt_interval(F.lit(delay_days)), F.lit(False)))


def stream_of(spark: SparkSession, folder: str, schema, per_batch: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(folder)
