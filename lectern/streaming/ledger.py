"""The current view of a ledger kept up to date from a stream: an extension of the batch operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.ledger import current


def current_stream(events: DataFrame, *key: str, order: str = "seq") -> DataFrame:
    """The latest row of each key over a stream; state grows with the keys. Write in update or complete mode."""
    rest = [c for c in events.columns if c not in key]
    return events.groupBy(*key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_r")).select(*key, *[F.col(f"_r.`{c}`").alias(c) for c in rest])


def windowed(events: DataFrame, time: str = "ts", width: str = "1 hour", late: str = "10 minutes", by: str = "event_type") -> DataFrame:
    """Events and values by window of time and type; late ones within the watermark count."""
    return events.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), by).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value")).select(F.col("w.start").alias("start"), by, "n", "value")


def upsert(path: str, *key: str, order: str = "seq"):
    """For foreachBatch: folds a micro-batch into the current view in a folder, one version a batch.

    A batch that is run again writes the same version, so the view is exact after failures."""

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = f"{path}/v{number - 1}"
        p = spark._jvm.org.apache.hadoop.fs.Path(before)
        old = spark.read.parquet(before) if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p) else None
        new = batch if old is None else old.unionByName(batch)
        current(new, *key, order=order).write.mode("overwrite").parquet(f"{path}/v{number}")

    return run
