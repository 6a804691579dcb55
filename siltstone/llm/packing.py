"""Harmonic packing of documents into sequences of fixed capacity."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Documents a worker packs at a time; parts of the first reciprocal class, class k has a k-th of them.
SHARD_DOCS, PARTS = 20_000, 128


def length_classes(sizes: np.ndarray, capacity: int, parts: int = PARTS) -> tuple[np.ndarray, np.ndarray]:
    """The reciprocal class k of each size, above capacity / (k + 1) and up to capacity / k, and the largest size of its part of the class."""
    k = capacity // np.maximum(sizes, 1)
    count = np.maximum(1, -(-parts // k))
    top, low = capacity // k, capacity // (k + 1)
    step = np.maximum(1, -(-(top - low) // count))
    return k, top - (top - sizes) // step * step


def harmonic_bins(sizes: np.ndarray, capacity: int, parts: int = PARTS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin of each item of 1 to ``capacity`` tokens; of each bin the space left over and the reciprocal class that opened it.

    Lengths are partitioned into reciprocal classes, these into parts. A bin of a part
    of class k gets k of its items, a fixed number, and, where the largest items of
    the part would leave space, a fixed number of items of the largest parts that surely
    fit into it, in turn. So how a bin is filled depends on how many items the parts
    have, never on the sizes of single items. What a part has less than its number goes
    into one bin of its own, which is filled up likewise. Parts come in order of falling size.
    """
    kind, bound = length_classes(sizes, capacity, parts)
    order = np.lexsort((np.arange(len(sizes)), -bound))
    bounds, begin, counts = np.unique(-bound[order], return_index=True, return_counts=True)
    bounds = -bounds
    have, at = counts.copy(), begin.copy()
    bins, opened = np.empty(len(sizes), np.int64), []
    for c, u in enumerate(bounds.tolist()):
        k = capacity // u
        while have[c]:
            fill = [(c, min(k, int(have[c])))]
            left, j = capacity - fill[0][1] * u, c
            while left and (j := max(j + 1, int(np.searchsorted(-bounds, -left)))) < len(bounds):
                some = np.flatnonzero(have[j:])
                if not len(some):
                    break
                j += int(some[0])
                take = min(left // int(bounds[j]), int(have[j]))
                fill.append((j, take))
                left -= take * int(bounds[j])
            again = min(int(have[x]) // n for x, n in fill)
            for x, n in fill:
                bins[order[at[x] : at[x] + again * n]] = len(opened) + np.repeat(np.arange(again), n)
                at[x] += again * n
                have[x] -= again * n
            opened += [k] * again
    used = np.bincount(bins, sizes, minlength=len(opened)).astype(np.int64) if len(sizes) else np.zeros(0, np.int64)
    return bins, capacity - used, np.array(opened, np.int64)


def pack(sizes: DataFrame, capacities: dict[str, int], key: str = "doc_id", size: str = "n_tokens", shard_docs: int = SHARD_DOCS) -> DataFrame:
    """``(bucket, key, piece, tokens, sequence, class, unused)``: where each document goes in each bucket.

    A document longer than the capacity gives full pieces, each a sequence of its
    own, and the rest as its last piece; no other is split. ``class`` is the reciprocal
    class that opened the sequence, ``unused`` the space left over in it. Documents without tokens take no sequence: piece 0,
    0 tokens, null ``sequence``, ``class`` and ``unused``. A repeated key is packed once, with
    its largest size; a null size counts as 0, rows without a key are left out.
    Workers pack shards of about ``shard_docs`` documents on their own.
    """
    kind = sizes.schema[key].dataType.simpleString()
    docs = sizes.where(F.col(key).isNotNull()).groupBy(key).agg(F.coalesce(F.max(size), F.lit(0)).cast("long").alias("n"))
    shards = max(1, -(-sizes.count() // shard_docs))
    buckets = F.array(*[F.struct(F.lit(b).alias("bucket"), F.lit(int(c)).cast("long").alias("capacity")) for b, c in sorted(capacities.items())])
    work = docs.select(key, "n", F.pmod(F.xxhash64(key), F.lit(shards)).alias("shard"), F.explode(buckets).alias("b")).select(key, "n", "shard", "b.*")

    def one(table: pa.Table) -> pa.Table:
        n = table.column("n").to_numpy()
        capacity, shard = table.column("capacity")[0].as_py(), table.column("shard")[0].as_py()
        # in order of the key: the result doesn't depend on how the rows arrive
        order = np.asarray(pa.compute.sort_indices(table.column(key)))
        n = n[order]
        full, rest = n // capacity, n % capacity
        parts = np.where(n > 0, full + (rest > 0), 1)
        row = np.repeat(np.arange(len(n)), parts)
        piece = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
        tokens = np.where(piece < full[row], capacity, rest[row])
        packed = (tokens > 0) & (tokens < capacity)
        sequence, unused, kind = np.zeros(len(row), np.int64), np.zeros(len(row), np.int64), np.ones(len(row), np.int64)
        bins, left, opened = harmonic_bins(tokens[packed], capacity)
        sequence[packed], unused[packed], kind[packed] = bins, left[bins], opened[bins]
        whole = np.flatnonzero(tokens == capacity)
        sequence[whole] = len(left) + np.arange(len(whole))
        none = tokens == 0
        keys = table.column(key).take(pa.array(order[row]))
        return pa.table(
            [pa.array([table.column("bucket")[0].as_py()] * len(row)), keys, pa.array(piece, pa.int64()), pa.array(tokens, pa.int64()), pa.array(sequence + (shard << 32), pa.int64(), mask=none), pa.array(kind, pa.int64(), mask=none), pa.array(unused, pa.int64(), mask=none)],
            ["bucket", key, "piece", "tokens", "sequence", "class", "unused"],
        )

    return work.groupBy("bucket", "shard").applyInArrow(one, f"bucket string, `{key}` {kind}, piece long, tokens long, sequence long, class long, unused long")


def packing_report(packed: DataFrame, capacities: dict[str, int], by_class: bool = False) -> DataFrame:
    """Per bucket: sequences, tokens, unused space and its share, and the fewest sequences that could hold the tokens; ``by_class``: per class that opened them, too."""
    by = ["bucket", *["class"] * by_class]
    sequences = packed.where("sequence is not null").groupBy("bucket", "sequence").agg(F.sum("tokens").alias("tokens"), F.first("class").alias("class"), F.first("unused").alias("unused"))
    size = F.create_map(*[F.lit(x) for b, c in sorted(capacities.items()) for x in (b, int(c))])
    return (
        sequences.groupBy(*by)
        .agg(F.count("*").alias("sequences"), F.sum("tokens").alias("tokens"), F.sum("unused").alias("unused"))
        .select(*by, "sequences", "tokens", "unused", (F.col("unused") / (F.col("tokens") + F.col("unused"))).alias("unused_share"), F.ceil(F.col("tokens") / size[F.col("bucket")]).alias("least_sequences"))
    )


def packing_faults(packed: DataFrame, sizes: DataFrame, capacities: dict[str, int], key: str = "doc_id", size: str = "n_tokens") -> DataFrame:
    """``(bucket, documents, overfull, split, lost)``: documents placed, sequences above their capacity, documents split without need, documents whose tokens aren't all placed; the last three must be 0."""
    capacity = F.create_map(*[F.lit(x) for b, c in sorted(capacities.items()) for x in (b, int(c))])[F.col("bucket")]
    docs = packed.groupBy("bucket", key).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("pieces")).join(sizes.groupBy(key).agg(F.coalesce(F.max(size), F.lit(0)).alias("n")), key)
    placed = docs.groupBy("bucket").agg(F.count("*").alias("documents"), F.count_if((F.col("pieces") > 1) & (F.col("n") <= capacity)).alias("split"), F.count_if(F.col("tokens") != F.col("n")).alias("lost"))
    full = packed.where("sequence is not null").groupBy("bucket", "sequence").agg(F.sum("tokens").alias("tokens"), F.max("unused").alias("unused")).groupBy("bucket").agg(F.count_if(F.col("tokens") + F.col("unused") != capacity).alias("overfull"))
    return placed.join(full, "bucket", "left").select("bucket", "documents", F.coalesce("overfull", F.lit(0)).alias("overfull"), "split", "lost")
