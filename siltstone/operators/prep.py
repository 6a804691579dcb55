"""Quotas, deterministic selection, mixes, shards, balancing, packing, splits and blends."""

from __future__ import annotations

import heapq
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator, Mapping, Sequence
from fractions import Fraction
from math import ceil, floor

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.functions.text import order_key
from siltstone.session import staged

#: Rows of a group that one task takes when it selects the first few of it.
SELECT_SALTS = 32


def quotas(weights: Mapping[str, float], total: int) -> dict[str, int]:
    """Whole shares of ``total``: the floors, then one more for the largest remainders, ties by name. Weights of 0 or less are left out."""
    used = {k: Fraction(w) for k, w in weights.items() if w > 0}
    if not used or total < 0:
        raise ValueError("a quota needs a positive weight and a total of at least 0")
    exact = {k: w * total / sum(used.values()) for k, w in used.items()}
    out = {k: floor(x) for k, x in exact.items()}
    for k in sorted(exact, key=lambda k: (out[k] - exact[k], k))[: total - sum(out.values())]:
        out[k] += 1
    return out


def first_of_groups(df: DataFrame, group: str, order: Sequence[str], limit: Column) -> DataFrame:
    """The first ``limit`` rows of each group; groups are cut down in salted parts first, so no task sorts a large one whole."""
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(SELECT_SALTS)))
    for keys in ([group, "_salt"], [group]):
        salted = salted.withColumn("_row", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_row") <= limit)
    return salted.drop("_salt", "_row")


def select_mix(ids: DataFrame, wanted: Mapping[str, int], seed: str | int, source: str = "source", key: str = "id") -> DataFrame:
    """``(position, source, key)``: the first ids of each source by a seeded hash, then all of them in one seeded order. Raises if a source is short."""
    limits = F.create_map(*[F.lit(x) for k, n in sorted(wanted.items()) for x in (k, int(n))])
    own = ids.where(F.col(source).isin(*wanted)).select(source, F.col(key).cast("string").alias(key))
    short = {r[0]: r[1] for r in own.groupBy(source).count().collect()}
    lacking = [k for k, n in wanted.items() if short.get(k, 0) < n]
    if lacking:
        raise ValueError(f"too few ids of {', '.join(sorted(lacking))}")
    keyed = own.withColumn("_k", order_key(F.concat_ws(":", F.lit(str(seed)), source), F.col(key)))
    chosen = first_of_groups(keyed, source, ["_k", key], limits[F.col(source)])
    keyed = chosen.select(source, key, order_key(F.lit(f"{seed}:mix"), F.col(key)).alias("_m"))
    return positioned(keyed, ["_m", key, source]).drop("_m")


def in_ranges(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df`` written in ranges of the order, each row with the number ``_part`` of its range."""
    return staged(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranges")


def before_ranges(ranges: DataFrame, size: Column) -> DataFrame:
    """``(_part, _before)``: what the ranges before each have together. One row a range."""
    parts = ranges.groupBy("_part").agg(F.sum(size).alias("_sum"))
    return parts.select("_part", (F.sum("_sum").over(Window.orderBy("_part")) - F.col("_sum")).alias("_before"))


def positioned(df: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """A dense position from 0 in the order of the columns: a place within a range, and the rows of the ranges before it."""
    ranges = in_ranges(df, order)
    placed = ranges.withColumn("_row", F.row_number().over(Window.partitionBy("_part").orderBy(*order))).join(before_ranges(ranges, F.lit(1)), "_part")
    return placed.withColumn(name, F.col("_before") + F.col("_row") - 1).drop("_part", "_row", "_before")


def prefix_mixes(candidates: DataFrame, targets: Mapping[str, int], seed: str | int, order: Sequence[str] = ("mix16", "mix64", "mix256"), mix: str = "mix", key: str = "id") -> DataFrame:
    """``(mix, key)`` of disjoint mixes: in a fixed order, others by name, each takes its first ids by a seeded hash that no earlier mix has."""
    names = [m for m in order if m in targets] + sorted(set(targets) - set(order))
    pool = candidates.select(mix, F.col(key).cast("string").alias(key)).distinct().withColumn("_k", order_key(F.lit(str(seed)), F.col(key)))
    pool = staged(pool, "pool")
    taken: DataFrame | None = None
    for name in names:
        own = pool.where(F.col(mix) == name)
        if taken is not None:
            own = own.join(taken.select(key), key, "left_anti").select(mix, key, "_k")
        own = staged(own.orderBy("_k", key).limit(int(targets[name])).select(mix, key), "mix")
        if own.count() < targets[name]:
            raise ValueError(f"too few ids for {name}")
        taken = own if taken is None else taken.unionByName(own)
    return taken if taken is not None else pool.select(mix, key).limit(0)


def microshards(rows: DataFrame, target: int, source: str = "source", row: str = "row", tokens: str = "tokens") -> DataFrame:
    """``(source, row_start, row_end, tokens)``: runs of rows, closed before the row that would exceed ``target``. Negative sizes count as 0.

    A run depends on the one before it, so two numbers a row of a source pass through
    one task, in order; there the sums are taken a batch at a time and searched once for each run.
    """
    if target <= 0:
        raise ValueError("the target must be positive")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, begin, held, end = None, 0, 0, 0
        for batch in batches:
            out: list[tuple] = []
            names = np.array(batch.column(0).to_pylist(), object)
            rows, sizes = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            edges = [*np.flatnonzero(names[1:] != names[:-1]) + 1, len(names)]
            for a, b in zip([0, *edges], edges):
                if a == b:
                    continue
                if current is None or names[a] != current[0]:
                    if current is not None:
                        out.append((current[0], begin, end, held))
                    current, begin, held = (names[a],), int(rows[a]), 0
                total = np.concatenate([[0], np.cumsum(sizes[a:b])])
                at = 0  # rows of this stretch before the open run's next one
                while at < b - a:
                    fits = max(at, int(np.searchsorted(total, total[at] + target - held, "right")) - 1)
                    if fits < b - a and held + total[fits] == total[at]:  # a run without tokens takes any row
                        fits += 1
                    if fits > at:
                        held, end = held + int(total[fits] - total[at]), int(rows[a + fits - 1]) + 1
                    at = fits
                    if at < b - a:
                        out.append((current[0], begin, end, held))
                        begin, held = int(rows[a + at]), 0
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(map(list, zip(*out)), (pa.string(), pa.int64(), pa.int64(), pa.int64()))], ["source", "row_start", "row_end", "tokens"])
        if current is not None:
            yield pa.record_batch([pa.array([current[0]], pa.string()), *[pa.array([x], pa.int64()) for x in (begin, end, held)]], ["source", "row_start", "row_end", "tokens"])

    own = rows.select(F.col(source).alias("source"), F.col(row).cast("long").alias("row"), F.greatest(F.coalesce(tokens, F.lit(0)), F.lit(0)).cast("long").alias("tokens"))
    return own.repartition("source").sortWithinPartitions("source", "row").mapInArrow(cut, "source string, row_start long, row_end long, tokens long")


def balance(units: Iterable[tuple[str, float]], workers: int) -> list[list[str]]:
    """Heaviest unit first onto the lightest worker; ties by key, then by worker."""
    if workers <= 0:
        raise ValueError("workers must be positive")
    loads = [(0.0, w) for w in range(workers)]
    out: list[list[str]] = [[] for _ in range(workers)]
    for key, weight in sorted(units, key=lambda u: (-u[1], u[0])):
        load, worker = heapq.heappop(loads)
        out[worker].append(key)
        heapq.heappush(loads, (load + weight, worker))
    return out


def best_fit(lengths: Sequence[int], capacity: int) -> list[int]:
    """Bin of each length, longest first, into the fullest bin it fits, of equally full ones the oldest. All must fit a bin."""
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    free: list[tuple[int, int]] = []
    out = [0] * len(lengths)
    bins = 0
    for i in order:
        at = bisect_left(free, (lengths[i], -1))
        if at < len(free):
            space, where = free.pop(at)
        else:
            space, where, bins = capacity, bins, bins + 1
        out[i] = where
        insort(free, (space - lengths[i], where))
    return out


def pack_samples(samples: DataFrame, capacity: int, shards: int = 1, allow_overlength: bool = False, key: str = "source_id", tokens: str = "tokens", targets: str | None = None) -> DataFrame:
    """``(shard, bin, tokens, targets, cu_seqlens, source_ids)``: samples put into sequences of ``capacity``, longest first, best fit.

    The bins are planned per shard on keys and lengths alone; tokens are joined to the
    plan afterwards. A sample that is longer than the capacity is left to ``unpacked_samples``,
    or takes a sequence of its own. Without targets the tokens are their own.
    """
    sized = samples.select(F.col(key).cast("string").alias("k"), F.size(tokens).alias("n")).withColumn("shard", F.pmod(F.xxhash64("k"), F.lit(shards)).cast("int"))
    fitting = sized.where("n > 0") if allow_overlength else sized.where(F.col("n").between(1, capacity))

    def plan(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["n", "k"], ascending=[False, True]).reset_index(drop=True)
        long = part["n"] > capacity
        own = part[~long]
        bins = best_fit(own["n"].tolist(), capacity)
        part.loc[~long, "bin"] = bins
        part.loc[long, "bin"] = range(max(bins, default=-1) + 1, max(bins, default=-1) + 1 + int(long.sum()))
        part["at"] = range(len(part))
        return part.astype({"bin": "int64", "at": "int64"})[["k", "shard", "bin", "at"]]

    planned = fitting.groupBy("shard").applyInPandas(plan, "k string, shard int, bin long, at long")
    content = samples.select(F.col(key).cast("string").alias("k"), F.col(tokens).alias("t"), F.col(targets or tokens).alias("y"))
    bins = planned.join(content, "k").groupBy("shard", "bin").agg(F.array_sort(F.collect_list(F.struct("at", "k", "t", "y"))).alias("s"))
    ends = F.aggregate("s", F.array(F.lit(0)), lambda a, x: F.array_append(a, F.element_at(a, -1) + F.size(x["t"])))
    return bins.select("shard", "bin", F.flatten(F.transform("s", lambda x: x["t"])).alias("tokens"), F.flatten(F.transform("s", lambda x: x["y"])).alias("targets"), ends.alias("cu_seqlens"), F.transform("s", lambda x: x["k"]).alias("source_ids"))


def unpacked_samples(samples: DataFrame, capacity: int, key: str = "source_id", tokens: str = "tokens") -> DataFrame:
    """``(key, length)`` of the samples that ``pack_samples`` puts into no sequence: longer than the capacity, or without tokens."""
    sized = samples.select(key, F.when(F.col(tokens).isNull(), 0).otherwise(F.size(tokens)).alias("length"))
    return sized.where(~F.col("length").between(1, capacity))


def sample_errors(tokens: Column, targets: Column | None = None, ignore: int = -100) -> Column:
    """What is wrong with a tokenised sample; null if nothing is."""
    wrong = F.when(F.coalesce(F.size(tokens), F.lit(0)) < 1, "empty")
    if targets is not None:
        wrong = wrong.when(F.size(tokens) != F.size(targets), "lengths differ").when(~F.exists(targets, lambda t: t != ignore), "no trainable target")
    return wrong


def loss_mask(targets: Column, ignore: int = -100) -> Column:
    return F.transform(targets, lambda t: F.when(t == ignore, 0).otherwise(1))


def base_bucket(tokens: Column, limits: Sequence[int] = (16_384, 65_536, 262_144)) -> Column:
    """B16, B64, ... by the first limit that isn't exceeded, else gt_<last>, in units of 1,024."""
    if not limits or min(limits) <= 0:
        raise ValueError("limits must be positive")
    label = F
    for limit in limits:
        label = label.when(tokens <= limit, F.lit(f"B{limit // 1024}"))
    return label.otherwise(F.lit(f"gt_{limits[-1] // 1024}"))


def split_bounds(text: str) -> list[tuple[float, float]]:
    """``"99,1,0"`` as normalised bounds of training, validation and test; missing ones are 0."""
    parts = [float(x) for x in text.replace("/", ",").split(",") if x.strip()]
    parts = (parts + [0.0] * 3)[:3]
    if sum(parts) <= 0 or min(parts) < 0:
        raise ValueError("a split needs parts of 0 or more and a positive sum")
    ends = [sum(parts[: i + 1]) / sum(parts) for i in range(3)]
    return list(zip([0.0, *ends[:-1]], ends))


def split_of(position: Column, total: int, text: str) -> Column:
    """Training, validation or test by dense position: bounds times total, rounded half to even."""
    label = F
    for name, (begin, end) in zip(("train", "valid", "test"), split_bounds(text)):
        label = label.when((position >= round(begin * total)) & (position < round(end * total)), F.lit(name))
    return label.otherwise(F.lit(None).cast("string"))


def blend_sizes(weights: Sequence[float], target: int, surplus: float = 0.005) -> list[int]:
    """Samples to build of each dataset, with a surplus for rounding."""
    total = sum(weights)
    return [ceil(ceil(target * w / total) * (1 + surplus)) for w in weights]


def blend_size(share: Column, target: int, surplus: float = 0.005) -> Column:
    """``blend_sizes`` of a column of shares that sum to 1."""
    return F.ceil(F.ceil(F.round(share * target, 9)) * (1 + surplus)).cast("long")


def blend_order(weights: Sequence[float], size: int) -> list[tuple[int, int]]:
    """``(dataset, sample)`` of each step: the dataset furthest behind its share comes next, of equal ones the first."""
    total = sum(weights)
    drawn = [0] * len(weights)
    out = []
    for step in range(size):
        late = [w / total * max(step, 1) - n for w, n in zip(weights, drawn)]
        dataset = max(range(len(weights)), key=lambda i: (late[i], -i))
        out.append((dataset, drawn[dataset]))
        drawn[dataset] += 1
    return out


def parse_blend(items: Sequence[str]) -> tuple[list[str], list[float] | None]:
    """Prefixes, or weights and prefixes in turn; an even list whose weights aren't numbers is a list of prefixes."""
    if len(items) % 2 == 0:
        try:
            return list(items[1::2]), [float(x) for x in items[::2]]
        except ValueError:
            pass
    return list(items), None


def token_windows(docs: DataFrame, sequence: int, key: str = "doc_id", size: Column | str | None = None) -> DataFrame:
    """``(sample, doc key, begin, end)``: which piece of which document each sample of ``sequence`` tokens is made of, in key order.

    ``size`` is the number of tokens, by default of the array ``ids``. Positions are sums
    over ranges of the key: within a range by a window, before it by a sum over the few ranges.
    """
    size = F.size("ids") if size is None else F.col(size) if isinstance(size, str) else size
    ranges = in_ranges(docs.select(F.col(key), size.cast("long").alias("n")).where("n > 0"), [key])
    upto = F.sum("n").over(Window.partitionBy("_part").orderBy(key))
    placed = ranges.withColumn("_end", upto).join(before_ranges(ranges, F.col("n")), "_part").select(key, (F.col("_before") + F.col("_end") - F.col("n")).alias("a"), (F.col("_before") + F.col("_end")).alias("b"))
    samples = placed.select(key, "a", "b", F.explode(F.sequence(F.floor(F.col("a") / sequence), F.floor((F.col("b") - 1) / sequence))).alias("sample"))
    return samples.select("sample", key, (F.greatest("a", F.col("sample") * sequence) - F.col("a")).alias("begin"), (F.least("b", (F.col("sample") + 1) * sequence) - F.col("a")).alias("end"))


def weighted_tasks(weights: Mapping[str, float], total: int) -> dict[str, int]:
    """Tasks per agent by weight; ties by position."""
    names = list(weights)
    numbered = quotas({f"{i:09d}": weights[n] for i, n in enumerate(names)}, total)
    return {n: numbered.get(f"{i:09d}", 0) for i, n in enumerate(names)}
