"""Tokenised corpora: files of ids with an index, sample indices over epochs, batches of a trainer, and conversations as they are read."""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator, Mapping
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.functions.text import order_key
from siltstone.operators.prep import before_ranges, in_ranges, token_windows
from siltstone.session import is_mounted, local_path

#: The head of an index file, its version, and the codes of the kinds of ids.
MAGIC, VERSION = b"MMIDIDX\x00\x00", 1
KINDS = {1: np.uint8, 2: np.int8, 3: np.int16, 4: np.int32, 5: np.int64, 6: np.float64, 7: np.float32, 8: np.uint16}
CODES = {np.dtype(v): k for k, v in KINDS.items()}
ROLES = {"human": "user", "user": "user", "gpt": "assistant", "assistant": "assistant", "system": "system", "tool": "tool", "function": "tool"}


def index_bytes(sizes: np.ndarray, ends: np.ndarray, kind: np.dtype) -> bytes:
    """The index of sequences of these sizes; ``ends`` are the sequences before each document's end."""
    kind = np.dtype(kind)
    places = (np.cumsum(sizes, dtype=np.int64) - sizes) * kind.itemsize
    documents = np.concatenate([[0], ends]).astype(np.int64)
    head = MAGIC + struct.pack("<QBQQ", VERSION, CODES[kind], len(sizes), len(documents))
    return head + sizes.astype(np.int32).tobytes() + places.astype(np.int64).tobytes() + documents.tobytes()


def read_index(path: str) -> tuple[np.dtype, np.ndarray, np.ndarray, np.ndarray]:
    """Kind, sizes, byte places and document bounds of an index file."""
    data = Path(path).read_bytes()
    if data[:9] != MAGIC:
        raise ValueError(f"{path} is no index")
    version, code, count, documents = struct.unpack_from("<QBQQ", data, 9)
    if version != VERSION:
        raise ValueError(f"{path} has version {version}")
    at = 9 + struct.calcsize("<QBQQ")
    sizes = np.frombuffer(data, np.int32, count, at)
    places = np.frombuffer(data, np.int64, count, at + 4 * count)
    return np.dtype(KINDS[code]), sizes, places, np.frombuffer(data, np.int64, documents, at + 12 * count)


def write_indexed(tokens: DataFrame, folder: str, ids: str = "ids", order: str = "doc_id", kind: type = np.int32) -> DataFrame:
    """Writes the ids of each row as a document of one sequence; ``(part, sequences, tokens)`` of the files written.

    Each range of the order gives ``part-<n>.bin`` and ``part-<n>.idx`` in the folder, which
    must be mounted. A part is written under another name first and then renamed, so
    a task that is run again leaves whole files.
    """
    if not is_mounted(folder):
        raise ValueError(f"{folder} is not on a mounted file system")
    place = local_path(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        os.makedirs(place, exist_ok=True)
        name, draft = os.path.join(place, f"part-{part:06d}"), os.path.join(place, f".part-{part:06d}-{attempt}")
        sizes: list[np.ndarray] = []
        with open(f"{draft}.bin", "wb") as out:
            for batch in batches:
                column = batch.column(0)
                sizes.append(pa.compute.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64))
                out.write(column.flatten().to_numpy(zero_copy_only=False).astype(kind).tobytes())
        own = np.concatenate([*sizes, np.empty(0, np.int64)])
        Path(f"{draft}.idx").write_bytes(index_bytes(own, np.arange(1, len(own) + 1), np.dtype(kind)))
        for end in ("bin", "idx"):
            os.replace(f"{draft}.{end}", f"{name}.{end}")
        yield pa.record_batch([pa.array([part], pa.int32()), pa.array([len(own)], pa.int64()), pa.array([int(own.sum())], pa.int64())], ["part", "sequences", "tokens"])

    ordered = tokens.where(F.col(ids).isNotNull()).repartitionByRange(order).sortWithinPartitions(order).select(ids)
    return ordered.mapInArrow(write, "part int, sequences long, tokens long")


def read_indexed(spark: SparkSession, folder: str) -> DataFrame:
    """``(part, document, sequence, ids)`` of all parts in a folder; a part without both of its files raises."""
    place = local_path(folder)
    names = sorted({p.stem for p in Path(place).glob("part-*.*")})
    lone = [n for n in names if not all(Path(place, f"{n}.{end}").exists() for end in ("bin", "idx"))]
    if lone:
        raise ValueError(f"incomplete parts: {', '.join(lone)}")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                kind, sizes, places, documents = read_index(os.path.join(place, f"{name}.idx"))
                if not len(sizes):
                    continue
                data = np.memmap(os.path.join(place, f"{name}.bin"), kind, "r") if sizes.any() else np.empty(0, kind)
                owner = np.searchsorted(documents, np.arange(len(sizes)), "right") - 1
                for a in range(0, len(sizes), 5_000):
                    b = min(a + 5_000, len(sizes))
                    begin = int(places[a]) // kind.itemsize
                    offsets = np.concatenate([[0], np.cumsum(sizes[a:b], dtype=np.int64)])
                    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.asarray(data[begin : begin + int(offsets[-1])]).astype(np.int32)))
                    yield pa.record_batch([pa.array([name] * (b - a)), pa.array(owner[a:b]), pa.array(np.arange(a, b)), lists], ["part", "document", "sequence", "ids"])

    parts = spark.createDataFrame([(n,) for n in names], "part string")
    return parts.repartition(max(1, len(names))).mapInArrow(read, "part string, document long, sequence long, ids array<int>")


# --- samples over epochs


def sample_index(docs: DataFrame, sequence: int, epochs: int = 1, seed: int | str = 0, key: str = "doc_id", size: str = "n") -> DataFrame:
    """``(sample, place, key, epoch, begin, end)``: pieces of documents that samples of ``sequence`` tokens are made of, and the place of each sample in the shuffled order.

    Documents stand in a seeded order of their own in each epoch; samples run across
    documents and epochs, and are shuffled by a seeded hash. A last sample may be short.
    """
    repeated = docs.select(F.col(key).alias("_key"), F.col(size).cast("long").alias("n"), F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch")).where("n > 0")
    placed = repeated.withColumn("_order", F.concat(F.lpad(F.hex("epoch"), 8, "0"), F.hex(order_key(F.concat(F.lit(f"{seed}:"), F.col("epoch").cast("string")), F.col("_key").cast("string")))))
    windows = token_windows(placed, sequence, "_order", "n")
    names = placed.select("_order", F.col("_key").alias(key), "epoch")
    pieces = windows.join(names, "_order")
    samples = in_ranges(pieces.select("sample").distinct().withColumn("_k", order_key(F.lit(f"{seed}:samples"), F.col("sample").cast("string"))), ["_k", "sample"])
    row = F.row_number().over(Window.partitionBy("_part").orderBy("_k", "sample"))
    places = samples.withColumn("_row", row).join(before_ranges(samples, F.lit(1)), "_part").select("sample", (F.col("_before") + F.col("_row") - 1).alias("place"))
    return pieces.join(places, "sample").select("sample", "place", key, "epoch", "begin", "end")


def batches(position: Column, micro: int, ranks: int, consumed: int = 0, total: int | None = None) -> Column:
    """Step, rank and slot of the sample at a dense position: steps take ``micro`` samples for each of ``ranks``, in order.

    What was consumed before is null, and so is the last, incomplete step if ``total`` is given.
    """
    at, whole = position - consumed, micro * ranks
    place = F.struct(F.floor(at / whole).cast("long").alias("step"), F.floor(F.pmod(at, F.lit(whole)) / micro).cast("int").alias("rank"), F.pmod(at, F.lit(micro)).cast("int").alias("slot"))
    last = F.lit(True) if total is None else at < (total - consumed) // whole * whole
    return F.when((at >= 0) & last, place)


def rank_slice(position: Column, total: int, ranks: int) -> Column:
    """The rank of each of the first ``total`` rows in contiguous runs of equal size, the last one shorter."""
    return F.when(position < total, F.floor(position / -(-total // ranks)).cast("int"))


def blended(order: DataFrame, samples: DataFrame) -> DataFrame:
    """The samples of several datasets in the blended order ``(step, dataset, sample)``; one that a dataset hasn't raises."""
    found = order.join(samples.withColumn("_held", F.lit(True)), ["dataset", "sample"], "left")
    missing = F.raise_error(F.concat(F.lit("no sample "), F.col("sample").cast("string"), F.lit(" in dataset "), F.col("dataset").cast("string")))
    return found.withColumn("step", F.when(F.col("_held"), F.col("step")).otherwise(missing.cast("long"))).drop("_held")


def iterations(tokens: int, records: int, batch: int) -> dict[str, int]:
    """Whole steps of an epoch of so many records, and the tokens a step has on average."""
    if batch <= 0 or records < 0 or tokens < 0:
        raise ValueError("a batch must be positive, records and tokens not negative")
    return {"iterations": records // batch, "tokens_per_iteration": tokens * batch // records if records else 0, "left_over": records % batch}


def require_tokens(totals: Mapping[str, object], expected: int, paths: tuple[str, ...]) -> int:
    """The first number found at one of the dotted paths of a nested object; raises unless it is ``expected``."""
    for path in paths:
        value: object = totals
        for name in path.split("."):
            value = value.get(name) if isinstance(value, Mapping) else None
        if isinstance(value, (int, float)) and not isinstance(value, bool):
            if int(value) != expected:
                raise ValueError(f"{path} is {int(value)}, not {expected}")
            return int(value)
    raise ValueError("no total at any of the paths")


# --- conversations as they are read


def shared_conversation(turns: Column) -> Column:
    """Messages with role and content of turns with ``from`` and ``value``; an unknown speaker raises."""
    roles = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    unknown = lambda t: F.raise_error(F.concat(F.lit("unknown speaker "), F.coalesce(t["from"], F.lit("null")))).cast("string")
    return F.transform(turns, lambda t: F.struct(F.coalesce(F.try_element_at(roles, F.lower(t["from"])), unknown(t)).alias("role"), t["value"].alias("content")))


def question_conversation(question: Column, answer: Column) -> Column:
    """Two messages of a question and its answer."""
    said = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    return F.array(said("user", question), said("assistant", answer))


#: Fixed value: the format that prepacked samples name.
PREPACKED = "megatron_sft_prepacked_v1"
SAMPLE = "format string, tokens array<int>, targets array<int>, cu_seqlens array<int>, messages array<struct<role:string,content:string>>, conversations array<struct<`from`:string,value:string>>"


def sft_format(spark: SparkSession, path: str) -> str:
    """``prepacked``, ``messages``, ``shared`` or ``unknown``: the first line that isn't blank decides."""
    first = spark.read.text(path).where(F.length(F.trim("value")) > 0).select(F.from_json("value", SAMPLE).alias("s")).select("s.*").head()
    if first is None:
        return "unknown"
    return "prepacked" if first.format == PREPACKED else "messages" if first.messages is not None else "shared" if first.conversations is not None else "unknown"


def read_sft(spark: SparkSession, path: str) -> DataFrame:
    """Conversations ``(messages)``, or prepacked samples ``(tokens, targets, cu_seqlens)``, of JSON lines in one of the known formats.

    Prepacked samples whose streams differ in length raise.
    """
    kind = sft_format(spark, path)
    rows = spark.read.schema(SAMPLE).json(path)
    if kind == "prepacked":
        even = F.size("tokens") == F.size("targets")
        return rows.select(F.when(even, F.col("tokens")).otherwise(F.raise_error(F.lit("tokens and targets differ in length")).cast("array<int>")).alias("tokens"), "targets", "cu_seqlens")
    if kind == "shared":
        return rows.select(shared_conversation(F.col("conversations")).alias("messages"))
    if kind == "messages":
        return rows.select("messages")
    raise ValueError(f"{path} holds no known kind of conversation")
