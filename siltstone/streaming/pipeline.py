"""Structured Streaming: stateless cleaning, exact and near deduplication, and event windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions.text import simhash, text_digest
from siltstone.operators.dedup import near_pairs, near_repeats


def digests(stream: DataFrame, text: str = "text") -> DataFrame:
    return stream.withColumn("digest", text_digest(F.col(text)))


def first_seen(stream: DataFrame, text: str = "text", event_time: str | None = None, delay: str = "1 day") -> DataFrame:
    """The first arrival of each text. Without an event time the state of all digests is kept; with one, digests are forgotten after ``delay``."""
    keyed = digests(stream, text)
    if event_time is None:
        return keyed.dropDuplicates(["digest"])
    return keyed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["digest"])


def near_dedup_batch(table: str, text: str = "text", seq: str = "seq", threshold: int = 3, bands: int = 4):
    """A ``foreachBatch`` function: rows that no earlier row is near to, batch by batch, are appended to ``table``/rows; all fingerprints to ``table``/prints.

    A batch meets the different fingerprints of earlier batches in the tables of
    blocks; pairs within the history are never formed again.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        prints = batch.select(seq, simhash(F.col(text)).alias("fingerprint")).withColumn("epoch", F.lit(epoch))
        prints.write.mode("overwrite").parquet(f"{table}/prints/epoch={epoch}")
        known = spark.read.parquet(f"{table}/prints")
        own, old = known.where(F.col("epoch") == epoch), known.where(F.col("epoch") < epoch)
        repeats = near_repeats(own.select(seq, "fingerprint"), threshold, bands, seq)
        met = near_pairs(own, threshold, bands, old).select(F.col("a").alias("fingerprint")).unionByName(own.select("fingerprint").join(old.select("fingerprint").distinct(), "fingerprint", "left_semi"))
        repeats = repeats.unionByName(own.join(met.distinct(), "fingerprint", "left_semi").select(seq)).distinct()
        batch.join(repeats, seq, "left_anti").write.mode("overwrite").parquet(f"{table}/rows/epoch={epoch}")

    return write


def clean_batch(folder: str, stage: str | None, category: str, profile: str | None = None, config: dict | None = None, keep_dropped: bool = False):
    """A ``foreachBatch`` function that cleans records (see ``plans.record``) as they arrive.

    What is kept of each batch goes to ``folder``/rows, in the released form, and the digests of
    all texts that reached deduplication to ``folder``/digests; texts of earlier batches count
    as seen. A batch that runs again replaces what it wrote.
    """
    from siltstone.plans.pipeline import clean
    from siltstone.session import staged
    from siltstone.sources.jsonl import released

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        earlier = spark.read.schema("digest string, epoch long").parquet(f"{folder}/digests").where(F.col("epoch") < epoch) if epoch else None
        cleaned = staged(clean(batch, stage, category, profile, dict(config or {}, prior_digests=earlier)), "cleaned")
        kept = cleaned if keep_dropped else cleaned.where("decision <> 'drop'")
        released(kept).write.mode("overwrite").parquet(f"{folder}/rows/epoch={epoch}")
        reached = cleaned.where("text_sha256 is not null").select(text_digest(F.col("text")).alias("digest")).distinct()
        reached.write.mode("overwrite").parquet(f"{folder}/digests/epoch={epoch}")

    return write


def tumbling(events: DataFrame, size: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    return (
        events.withWatermark("ts", delay).groupBy(F.window("ts", size).alias("w"), "event_type")
        .agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")
    )


def sessions(events: DataFrame, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    return (
        events.withWatermark("ts", delay).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n"))
        .select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")
    )
