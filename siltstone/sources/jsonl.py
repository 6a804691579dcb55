"""JSON lines: reading plain, gzip and zstd files, releasing records, manifests and checks."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.functions.text import canonical_json, changed_json
from siltstone.session import write_text

REQUIRED = ("dataset", "source_id", "stage", "category", "decision", "data")
DECISIONS = ("keep", "review", "drop")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, position, line)`` of the lines of the files under ``path``; ``.gz`` by Spark's codec, ``.zst`` in Arrow batches.

    ``position`` is the line's number in its file, from 0. A compressed file is one task's
    work. Of other files the lines of each block are counted first, so that large files stay divided.
    """
    if path.endswith(".zst"):
        return _zstd_lines(spark, path)
    meta = F.col("_metadata")
    block = F.struct(meta["file_path"].alias("file"), meta["file_block_start"].alias("block"))
    rows = spark.read.text(path).select(block.alias("b"), F.monotonically_increasing_id().alias("_id"), F.col("value").alias("line")).select("b.*", "_id", "line")
    counts = rows.groupBy("file", "block").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    before = counts.select("file", "block", (F.sum("_n").over(Window.partitionBy("file").orderBy("block")) - F.col("_n") - F.col("_first")).alias("_shift"))
    return rows.join(before, ["file", "block"]).select("file", (F.col("_id") + F.col("_shift")).alias("position"), "line")


def _zstd_lines(spark: SparkSession, path: str) -> DataFrame:
    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import io

        import zstandard

        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(content), encoding="utf-8", newline="\n")
                held: list[str] = []
                begin = 0
                for line in text:
                    held.append(line.rstrip("\n"))
                    if len(held) == 5000:
                        yield pa.record_batch([pa.array([name] * len(held)), pa.array(range(begin, begin + len(held)), pa.int64()), pa.array(held)], ["file", "position", "line"])
                        begin, held = begin + len(held), []
                if held:
                    yield pa.record_batch([pa.array([name] * len(held)), pa.array(range(begin, begin + len(held)), pa.int64()), pa.array(held)], ["file", "position", "line"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(lines, "file string, position long, line string")


def objects(lines: DataFrame, strict: bool = True) -> DataFrame:
    """``(file, position, payload)`` of the non-blank lines. A line that is no JSON object raises; leniently it comes with ``bad`` set."""
    kept = lines.where(F.length(F.trim("line")) > 0)
    good = F.coalesce(F.schema_of_variant(F.try_parse_json("line")).startswith("OBJECT"), F.lit(False))
    if strict:
        error = F.raise_error(F.concat(F.lit("not a JSON object: "), F.col("file"), F.lit(" line "), F.col("position").cast("string")))
        return kept.select("file", "position", F.when(good, F.col("line")).otherwise(error.cast("string")).alias("payload"))
    return kept.select("file", "position", F.col("line").alias("payload"), (~good).alias("bad"))


def with_positions(df: DataFrame, order: list[str], name: str = "seq") -> DataFrame:
    """Dense positions from 0 in the order of the columns, without gathering the rows in one task."""
    from siltstone.operators.prep import positioned

    return positioned(df, order, name)


def record_hash(data: Column) -> Column:
    """SHA-256 of the canonical JSON of a record's data."""
    return F.sha2(canonical_json(data), 256)


def released(cleaned: DataFrame) -> DataFrame:
    """Records as they are written: the ten fields and the hash of the data, which is given as JSON.

    The data are the payload with what the steps made of it: normalised and mapped
    text fields, messages, metadata and the digest of the text.
    """
    parts = [F.to_json("data"), F.to_json(F.col("changes")["fields"]), F.to_json(F.col("changes")["writes"]), F.col("changes")["messages"], F.col("text_sha256")]
    return cleaned.withColumn("data", changed_json(*parts)).withColumn("record_sha256", F.sha2("data", 256)).select(
        "dataset", "source_id", "seq", "stage", "category", "data", "decision", "reasons", "flags", "buckets", "metrics", "record_sha256"
    )


def write_jsonl(records: DataFrame, path: str) -> int:
    """One JSON object a line with sorted keys; the number of lines, counted while they are written."""
    names = sorted(c for c in records.columns if c != "data")
    whole = F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    line = canonical_json(F.concat(F.substring(whole, 1, 1), F.lit('"data":'), F.coalesce("data", F.lit("null")), F.lit(","), F.expr("substring(w, 2)"))) if "data" in records.columns else canonical_json(whole)
    rows = records.withColumn("w", whole) if "data" in records.columns else records
    seen = Observation()
    rows.select(line.alias("value")).observe(seen, F.count(F.lit(1)).alias("lines")).write.text(path)
    return seen.get["lines"]


def decision_counts(records: DataFrame) -> DataFrame:
    """Rows by decision, without one as ``unknown``."""
    return records.groupBy(F.coalesce("decision", F.lit("unknown")).alias("decision")).agg(F.count("*").alias("n"))


def manifest(records: DataFrame, stage: str, output: str) -> dict:
    """Total and counts by decision of what was written; keep, review and drop are always there."""
    counts = dict.fromkeys(DECISIONS, 0) | {r.decision: r.n for r in decision_counts(records).collect()}
    return {"stage": stage, "output": output, "total": sum(counts.values()), "decisions": counts}


def manifest_text(content: dict) -> str:
    return json.dumps(content, indent=2, sort_keys=True, ensure_ascii=False) + "\n"


def write_manifest(path: str, content: dict, spark: SparkSession | None = None) -> None:
    """The manifest as a file, by the session's file systems if one is given."""
    if spark is not None:
        write_text(spark, path, manifest_text(content))
        return
    with open(path, "w", encoding="utf-8") as out:
        out.write(manifest_text(content))


def file_checksums(spark: SparkSession, path: str) -> DataFrame:
    """``(path, length, sha256)`` of each file."""
    return spark.read.format("binaryFile").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))


def release_errors(records: DataFrame) -> DataFrame:
    """Rows that may not be released, with what is wrong."""
    wrong = F
    for name in REQUIRED:
        wrong = wrong.when(F.col(name).isNull() if name in records.columns else F.lit(True), F.lit(f"missing {name}"))
    wrong = wrong.when(~F.col("decision").isin(*DECISIONS), F.lit("unknown decision"))
    return records.withColumn("error", wrong.otherwise(F.lit(None).cast("string"))).where("error is not null")


def missing_blocks(planned: DataFrame, finished: DataFrame, keys: list[str]) -> DataFrame:
    """Blocks that aren't done yet."""
    return planned.join(finished.select(*keys).distinct(), keys, "left_anti")


def blocks(total: int, size: int) -> list[tuple[int, int]]:
    """Half-open ranges of at most ``size``."""
    return [(a, min(a + size, total)) for a in range(0, total, size)]


def sequence_counts(corpora: DataFrame) -> DataFrame:
    """Sequences and documents of each prefix."""
    return corpora.groupBy("prefix").agg(F.count("*").alias("sequences"), F.countDistinct("doc_id").alias("documents"))


def merged(parts: list[DataFrame]) -> DataFrame:
    """Corpora one after the other, each row with its part."""
    out = parts[0].withColumn("part", F.lit(0))
    for i, part in enumerate(parts[1:], 1):
        out = out.unionByName(part.withColumn("part", F.lit(i)))
    return out
