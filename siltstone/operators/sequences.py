"""Training samples from tokens: infilling, masking, span corruption, conversations and windows."""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

IGNORE = -100


def seeded(seed: int, key: object) -> np.random.Generator:
    """A generator that depends on the seed and the row's key alone, however rows are spread."""
    return np.random.default_rng(int.from_bytes(hashlib.blake2b(f"{seed}\0{key}".encode(), digest_size=8).digest(), "big"))


def byte_tokens(text: str) -> list[int]:
    return list(text.encode("utf-8", "surrogatepass"))


def byte_lists(texts: pa.Array) -> pa.Array:
    """``byte_tokens`` of each text, taken from the column as it stands: no value becomes a Python object. Null where there is no text or an empty one."""
    _, places, data = (whole := texts.cast(pa.large_string())).buffers()
    ends = np.frombuffer(places, np.int64)[whole.offset : whole.offset + len(whole) + 1] if len(whole) else np.zeros(1, np.int64)
    values = np.frombuffer(data or b"", np.uint8)[ends[0] : ends[-1]].astype(np.int32)
    none = np.diff(ends) == 0
    return pa.ListArray.from_arrays(pa.array((ends - ends[0]).astype(np.int32)), pa.array(values), mask=pa.array(none | whole.is_null().to_numpy(zero_copy_only=False)))


def encode(docs: DataFrame, fields: Sequence[str], tokenize: Callable[[str], list[int]] = byte_tokens, eod: int | None = None, key: str = "doc_id") -> DataFrame:
    """``(key, field, ids)``: each field of each document, with an end-of-document id if one is given; empty texts give no row."""
    kind = T.ArrayType(T.IntegerType())

    @F.pandas_udf(kind)
    def one(values: pd.Series) -> pd.Series:
        return pd.Series([None if not v else tokenize(v) + ([] if eod is None else [eod]) for v in values], dtype=object)

    @F.arrow_udf(kind)
    def as_bytes(values: pa.Array) -> pa.Array:
        return byte_lists(values)

    made = as_bytes if tokenize is byte_tokens and eod is None else one
    long = docs.select(key, F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in fields])).alias("f")).select(key, "f.*")
    return long.where("text is not null and text <> ''").select(key, "field", made("text").alias("ids"))


def sentences(text: Column) -> Column:
    """Sentences, cut after closing punctuation and white space or after CJK full stops."""
    return F.filter(F.split(text, r"(?<=[.!?])\s+|(?<=[。！？])\s*"), lambda x: F.length(F.trim(x)) > 0)


def infilled(ids: Sequence[int], rng: np.random.Generator, rate: float, spm_rate: float, prefix: int, middle: int, suffix: int, pad: int, eod: int | None = None) -> list[int]:
    """Each document of the ids rearranged with a chance of ``rate`` as prefix, suffix and middle; cut or padded to the length it had."""
    out: list[int] = []
    cut = ([] if eod is None else [i for i, t in enumerate(ids) if t == eod]) + [len(ids)]
    begin = 0
    for end in cut:
        part = list(ids[begin:end])
        if len(part) > 2 and rng.random() < rate:
            a, b = sorted(rng.integers(0, len(part) + 1, 2).tolist())
            first, mid, last = part[:a], part[a:b], part[b:]
            part = [prefix, suffix, *last, middle, *first, *mid] if rng.random() < spm_rate else [prefix, *first, suffix, *last, middle, *mid]
        out += part + ([eod] if end < len(ids) else [])
        begin = end + 1
    return (out + [pad] * len(ids))[: len(ids)]


def masked(ids: Sequence[int], rng: np.random.Generator, rate: float, mask: int, vocabulary: int, longest: int = 3) -> tuple[list[int], list[int]]:
    """Tokens with about ``rate`` of them hidden in n-grams, short ones likelier, 80 % as the mask, 10 % as another, 10 % as they are; and the targets."""
    count, draw = len(ids), rng.random
    out, targets = list(ids), [IGNORE] * count
    want = max(1, round(rate * count)) if ids else 0
    sums = (1 / np.arange(1, longest + 1)).cumsum()
    sums = (sums / sums[-1]).tolist()
    for start in rng.permutation(count).tolist():
        if want <= 0:
            break
        size = min(bisect_right(sums, draw()) + 1, want, count - start)
        span = targets[start : start + size]
        if span.count(IGNORE) < size:
            continue
        for i in range(start, start + size):
            token = targets[i] = ids[i]
            chance = draw()
            out[i] = mask if chance < 0.8 else int(rng.integers(vocabulary)) if chance < 0.9 else token
        want -= size
    return out, targets


def span_corrupted(ids: Sequence[int], rng: np.random.Generator, rate: float, sentinels: Sequence[int], bos: int, eos: int, mean: int = 3) -> tuple[list[int], list[int], list[int]]:
    """Encoder input with sentinels for hidden spans, decoder input and decoder output."""
    count = min(len(sentinels), max(1, round(len(ids) * rate / mean))) if ids else 0
    hidden = min(len(ids), max(count, round(len(ids) * rate)))
    sizes = np.diff(np.concatenate([[0], np.sort(rng.choice(np.arange(1, hidden), count - 1, replace=False)) if count > 1 else [], [hidden]])).astype(int) if count else []
    gaps = np.sort(rng.integers(0, len(ids) - hidden + 1, count)) if count else []
    encoder, decoder, at, seen = [], [], 0, 0
    for sentinel, size, gap in zip(sentinels, map(int, sizes), map(int, gaps)):
        encoder += [*ids[at : at + gap - seen], sentinel]
        at += gap - seen
        seen = gap
        decoder += [sentinel, *ids[at : at + size]]
        at += size
    encoder += ids[at:]
    return encoder, [bos, *decoder], [*decoder, eos]


def conversation_tokens(turns: Sequence[dict], tokenize: Callable[[str], list[int]], prefixes: dict[str, str], end: str) -> tuple[list[int], list[int]]:
    """Ids of a conversation and their targets: only what assistants say, up to the end of their turn, is a target.

    An empty assistant turn, one that follows neither user nor tool, or an unknown role raises.
    """
    ids: list[int] = []
    targets: list[int] = []
    before = None
    for turn in turns:
        role, content = turn["role"], turn.get("content") or ""
        if role not in prefixes:
            raise ValueError(f"unknown role {role}")
        head, body = tokenize(prefixes[role]), tokenize(content + end)
        if role == "assistant" and (not content.strip() or before not in ("user", "tool")):
            raise ValueError("an assistant turn is empty or follows neither user nor tool")
        ids += head + body
        targets += [IGNORE] * len(head) + (body if role == "assistant" else [IGNORE] * len(body))
        before = role
    return ids, targets


def sft_sample(ids: Column, targets: Column, length: int, pad: int) -> Column:
    """Tokens, labels, loss mask and positions of one sample of ``length``: cut or padded to one more, labels one ahead, no loss on padding."""
    room = lambda x, fill: F.slice(F.concat(x, F.array_repeat(F.lit(fill), F.greatest(F.lit(length + 1) - F.size(x), F.lit(0)).cast("int"))), 1, length + 1)
    t, y = room(ids, pad), room(targets, IGNORE)
    labels = F.slice(y, 2, length)
    return F.struct(
        F.slice(t, 1, length).alias("tokens"), F.transform(labels, lambda v: F.when(v == IGNORE, pad).otherwise(v)).alias("labels"),
        F.transform(labels, lambda v: F.when(v == IGNORE, 0).otherwise(1)).alias("loss_mask"), F.sequence(F.lit(0), F.lit(length - 1)).alias("position_ids"),
    )


def packed_positions(cu_seqlens: Column) -> Column:
    """Positions that begin again at 0 with each segment."""
    return F.flatten(F.transform(F.sequence(F.lit(1), F.size(cu_seqlens) - 1), lambda i: F.sequence(F.lit(0), F.element_at(cu_seqlens, i + 1) - F.element_at(cu_seqlens, i) - 1)))


def unpacked(df: DataFrame, tokens: str, cu_seqlens: str) -> DataFrame:
    """One row for each segment of packed sequences."""
    ends = F.slice(cu_seqlens, 2, F.size(cu_seqlens))
    rows = df.select("*", F.posexplode(ends).alias("segment", "_end"))
    begin = F.element_at(F.col(cu_seqlens), F.col("segment") + 1)
    return rows.withColumn("piece", F.slice(F.col(tokens), begin + 1, F.col("_end") - begin)).drop("_end")


def packed_errors(tokens: Column, targets: Column, cu_seqlens: Column, length: int) -> Column:
    """What is wrong with a prepacked sample; null if nothing is."""
    steps = F.transform(F.sequence(F.lit(1), F.size(cu_seqlens) - 1), lambda i: F.element_at(cu_seqlens, i + 1) >= F.element_at(cu_seqlens, i))
    return (
        F.when(F.size(tokens) != F.size(targets), "lengths differ").when(F.size(tokens) > length + 1, "too long").when(F.element_at(cu_seqlens, 1) != 0, "does not begin at 0")
        .when(F.element_at(cu_seqlens, -1) != F.size(tokens), "does not end at the length").when(F.exists(steps, lambda x: ~x), "not in order")
    )


# --- the same over frames


#: Rows of a batch that are held as Python objects at once.
HELD = 1000


def cells(column: pa.Array) -> list:
    """The column's values in Python; lists of whole numbers are taken out as such, which takes an eighth of the time of one value after the other."""
    kind = column.type
    if not (pa.types.is_list(kind) and pa.types.is_integer(kind.value_type)) or column.flatten().null_count:
        return column.to_pylist()
    ends = column.offsets.to_numpy().tolist()
    numbers = column.values.to_numpy(zero_copy_only=False)
    found = [numbers[a:b].tolist() for a, b in zip(ends, ends[1:])]
    return [x if there else None for x, there in zip(found, column.is_valid().to_pylist())] if column.null_count else found


def by_row(df: DataFrame, columns: Sequence[str], key: str, made: Callable[..., tuple], schema: str, keep: Mapping[str, str] | None = None) -> DataFrame:
    """``(key, ..., keep)`` of ``schema``: what ``made`` gives for the key and the columns of each row, in Arrow batches.

    ``keep`` names columns that stay beside it, so that nothing has to be joined to the rows again.
    """
    typed = lambda name, source: f"`{name}` {df.schema[source].dataType.simpleString()}"
    kept = keep or {}
    sent = list(dict.fromkeys([key, *columns, *kept.values()]))
    taken, left = [sent.index(c) for c in (key, *columns)], [sent.index(c) for c in kept.values()]
    whole = ", ".join([typed(key, key), schema, *(typed(n, c) for n, c in kept.items())])
    names = T.StructType.fromDDL(whole).names
    arrow = to_arrow_schema(T.StructType.fromDDL(whole))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for first in range(0, whole_batch.num_rows, HELD):
                batch = whole_batch.slice(first, HELD)
                rows = [made(*values) for values in zip(*(cells(batch.column(i)) for i in taken))]
                yield pa.record_batch([batch.column(0), *[pa.array(list(c), arrow.field(i + 1).type) for i, c in enumerate(zip(*rows))], *[batch.column(i) for i in left]], names)

    return df.select(*sent).mapInArrow(run, whole)


def infill(df: DataFrame, rate: float, spm_rate: float, prefix: int, middle: int, suffix: int, pad: int, eod: int | None = None, seed: int = 0, key: str = "doc_id", ids: str = "ids", keep: Mapping[str, str] | None = None) -> DataFrame:
    """``(key, ids, keep)``: the ids of each row rearranged for infilling, as long as they were; a null stays null."""
    return by_row(df, [ids], key, lambda k, x: (None if x is None else infilled(x, seeded(seed, k), rate, spm_rate, prefix, middle, suffix, pad, eod),), "ids array<int>", keep)


def mask_tokens(df: DataFrame, rate: float, mask: int, vocabulary: int, longest: int = 3, seed: int = 0, key: str = "doc_id", ids: str = "ids", keep: Mapping[str, str] | None = None) -> DataFrame:
    """``(key, ids, targets, keep)``: the ids of each row with n-grams hidden, and what was hidden."""
    return by_row(df, [ids], key, lambda k, x: (None, None) if x is None else masked(x, seeded(seed, k), rate, mask, vocabulary, longest), "ids array<int>, targets array<int>", keep)


def corrupt_spans(df: DataFrame, rate: float, sentinels: Sequence[int], bos: int, eos: int, mean: int = 3, seed: int = 0, key: str = "doc_id", ids: str = "ids", keep: Mapping[str, str] | None = None) -> DataFrame:
    """``(key, encoder, decoder, output, keep)``: the ids of each row with sentinels for spans, and the spans after their sentinels."""
    return by_row(df, [ids], key, lambda k, x: (None,) * 3 if x is None else span_corrupted(x, seeded(seed, k), rate, sentinels, bos, eos, mean), "encoder array<int>, decoder array<int>, output array<int>", keep)


def conversation_samples(df: DataFrame, prefixes: dict[str, str], end: str, tokenize: Callable[[str], list[int]] = byte_tokens, key: str = "doc_id", messages: str = "messages") -> DataFrame:
    """``(key, ids, targets, error)``: tokens of each conversation; of one that cannot be used only what is wrong with it."""

    def one(_: object, turns: list[dict] | None) -> tuple:
        try:
            return *conversation_tokens(turns or [], tokenize, prefixes, end), None
        except ValueError as wrong:
            return None, None, str(wrong)

    return by_row(df, [messages], key, one, "ids array<int>, targets array<int>, error string")


def sentence_pair(parts: Sequence[Sequence[int]], rng: np.random.Generator, room: int, cls: int, sep: int) -> tuple[list[int], list[int], bool] | None:
    """Two runs of sentences as ``cls A sep B sep`` with their kinds, and whether they were swapped; None for fewer than two sentences.

    They part at a random sentence, are swapped with a chance of a half, and lose
    tokens of the longer one at a random end until they fit.
    """
    if len(parts) < 2:
        return None
    pivot = int(rng.integers(1, len(parts)))
    pair = [[t for p in parts[:pivot] for t in p], [t for p in parts[pivot:] for t in p]]
    swapped = bool(rng.random() < 0.5)
    if swapped:
        pair.reverse()
    while (over := len(pair[0]) + len(pair[1]) - room) > 0:
        longer = pair[0] if len(pair[0]) > len(pair[1]) else pair[1]
        many = min(over, max(1, abs(len(pair[0]) - len(pair[1]))))
        head = int(rng.binomial(many, 0.5))
        longer[:] = longer[head : len(longer) - (many - head)]
    a, b = pair
    return [cls, *a, sep, *b, sep], [0] * (len(a) + 2) + [1] * (len(b) + 1), swapped


def sentence_pairs(df: DataFrame, room: int, cls: int, sep: int, mask: int, vocabulary: int, rate: float = 0.15, seed: int = 0, key: str = "doc_id", parts: str = "parts") -> DataFrame:
    """``(key, ids, kinds, swapped, targets)``: a pair of runs of sentences of each row, tokens hidden by ``masked``; rows of fewer than two sentences have nulls."""

    def one(k: object, given: list[list[int]] | None) -> tuple:
        rng = seeded(seed, k)
        made = sentence_pair(given or [], rng, room, cls, sep)
        if made is None:
            return None, None, None, None
        ids, kinds, swapped = made
        hidden, targets = masked(ids, rng, rate, mask, vocabulary)
        special = [t in (cls, sep) for t in ids]
        return [a if s else h for a, h, s in zip(ids, hidden, special)], kinds, swapped, [IGNORE if s else t for t, s in zip(targets, special)]

    return by_row(df, [parts], key, one, "ids array<int>, kinds array<int>, swapped boolean, targets array<int>")


def classified_pair(a: Column, b: Column | None, length: int, cls: int, sep: int, pad: int) -> Column:
    """``cls A sep`` or ``cls A sep B sep``, cut to ``length`` with a ``sep`` last and padded; kinds, and 1 where there is no padding."""
    first = F.concat(F.array(F.lit(cls)), a, F.array(F.lit(sep)))
    whole = first if b is None else F.concat(first, b, F.array(F.lit(sep)))
    cut = F.when(F.size(whole) > length, F.array_append(F.slice(whole, 1, length - 1), F.lit(sep))).otherwise(whole)
    fill = lambda x, what: F.slice(F.concat(x, F.array_repeat(F.lit(what), length)), 1, length)
    kinds = F.transform(cut, lambda _, i: F.when(i < F.size(first), 0).otherwise(1))
    return F.struct(fill(cut, pad).alias("ids"), fill(kinds, 0).alias("kinds"), fill(F.transform(cut, lambda _: F.lit(1)), 0).alias("seen"))


def stripped(ids: Column, pad: int) -> Column:
    """The ids without padding at their end."""
    last = F.array_max(F.transform(ids, lambda x, i: F.when(x != pad, i + 1).otherwise(0)))
    return F.slice(ids, F.lit(1), F.coalesce(last, F.lit(0)))


def streamed(df: DataFrame, length: int, key: str = "doc_id", ids: str = "ids", shards: int | None = None) -> DataFrame:
    """``(shard, sample, ids, keys)``: rows joined in order of the key until they have ``length`` + 1 ids, which then are cut there; a shorter rest gives no sample.

    Each of ``shards`` (by default as many as there are shuffle partitions) joins its own rows.
    """
    count = shards or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, keys, shard, sample = [], [], None, 0
        for batch in batches:
            out: list[tuple] = []
            for part, k, x in zip(*(c.to_pylist() for c in batch.columns)):
                if part != shard:
                    held, keys, shard, sample = [], [], part, 0
                held += x
                keys.append(k)
                if len(held) > length:
                    out.append((shard, sample, held[: length + 1], keys))
                    held, keys, sample = [], [], sample + 1
            names = ["shard", "sample", "ids", "keys"]
            kinds = [pa.int32(), pa.int64(), pa.list_(pa.int32()), pa.list_(batch.column(1).type)]
            yield pa.record_batch([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], names)

    rows = df.where(F.size(ids) > 0).select(F.pmod(F.xxhash64(key), F.lit(count)).cast("int").alias("shard"), key, ids)
    return rows.repartition("shard").sortWithinPartitions("shard", key).mapInArrow(run, f"shard int, sample long, ids array<int>, keys array<{kind}>")


def usable_turns(messages: Column) -> Column:
    """Whether a conversation has two turns and doesn't begin with the assistant."""
    return F.coalesce((F.size(messages) >= 2) & (F.element_at(messages, 1)["role"] != "assistant"), F.lit(False))
