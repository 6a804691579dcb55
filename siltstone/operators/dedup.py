"""First-seen-wins deduplication by digest and by SimHash, as shuffles of keys only."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from itertools import combinations
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.functions.text import simhash, text_digest
from siltstone.session import staged


#: Parts of the rows of one key; rows that are marked by a broadcast at most.
SALTS, MOST_SENT = 64, 1_000_000


def firsts(keys: DataFrame, key: str, seq: str = "seq") -> tuple[DataFrame, DataFrame]:
    """``keys`` with a salt, and ``(key, _salt, _first)`` of keys that occur again.

    Rows of a key are reduced by salted parts, and joined to their first by the same
    salt: a key that holds a third of all rows is spread over ``SALTS`` tasks.
    """
    salted = keys.withColumn("_salt", F.pmod(F.xxhash64(seq), F.lit(SALTS)))
    parts = salted.groupBy(key, "_salt").agg(F.min(seq).alias("_least"), F.count("*").alias("_n"))
    again = parts.groupBy(key).agg(F.min("_least").alias("_first"), F.sum("_n").alias("_n")).where("_n > 1").select(key, "_first")
    return salted, parts.select(key, "_salt").join(again, key)


def later_copies(keys: DataFrame, key: str, seq: str = "seq") -> DataFrame:
    """``seq`` of the rows that aren't the first with their key. Only keys and positions are shuffled."""
    salted, first = firsts(keys, key, seq)
    return salted.join(first, [key, "_salt"]).where(F.col(seq) > F.col("_first")).select(seq)


def marked_rows(df: DataFrame, rows: DataFrame, name: str, seq: str = "seq") -> DataFrame:
    """``df`` with the column ``name``, true for the listed ``seq``. Few of them are sent to every task, so that ``df`` stays where it is."""
    rows = staged(rows.select(seq).distinct().withColumn(name, F.lit(True)), name.strip("_"))
    listed = F.broadcast(rows) if rows.count() <= MOST_SENT else rows
    return df.join(listed, seq, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def repeats(df: DataFrame, text: Column, seq: str = "seq", prior: DataFrame | None = None) -> DataFrame:
    """``(seq, digest, duplicate)`` of all rows; with ``prior`` digests of earlier runs these count as seen."""
    keyed = staged(df.select(seq, text_digest(text).alias("digest")), "digests")
    return marked_rows(keyed, repeated(keyed, seq, prior), "duplicate", seq).select(seq, "digest", "duplicate")


def repeated(keyed: DataFrame, seq: str = "seq", prior: DataFrame | None = None) -> DataFrame:
    """``seq`` of the rows of ``(seq, digest)`` whose digest came earlier, in them or in ``prior``."""
    later = later_copies(keyed, "digest", seq)
    if prior is None:
        return later
    return later.unionByName(keyed.join(prior.select("digest").distinct(), "digest", "left_semi").select(seq))


def block_masks(blocks: int) -> list[int]:
    """The 64 bits dealt out to blocks in turn; the sizes differ by one at most, and so do their shares of any run of bits, if only that run differs from value to value."""
    return [sum(1 << b for b in range(i, 64, blocks)) for i in range(blocks)]


def near_pairs(prints: DataFrame, threshold: int = 3, bands: int = 4, others: DataFrame | None = None) -> DataFrame:
    """Pairs ``(a, b, distance)``, a < b, of different fingerprints within ``threshold`` bits; with ``others`` a is of ``prints`` and b of them.

    The bits are dealt out to three blocks more than ``threshold`` (or to ``bands`` if
    these are more), so fingerprints that near agree in three blocks at least. They meet
    in one table for each choice of three, under about half of their bits as the key
    (16 of 64 with four single bands); a pair is kept for its first three common blocks only.
    """
    if not 0 <= threshold < bands or 64 % bands:
        raise ValueError("the threshold must be below the number of bands, which must divide 64")
    masks = block_masks(max(threshold + 3, bands))
    bits = lambda mask: F.lit(mask - (mask >> 63 << 64)).cast("long")
    choices = list(combinations(range(len(masks)), 3))
    keys = [F.struct(F.lit(sum(1 << i for i in c)).alias("choice"), F.col("fingerprint").bitwiseAND(bits(sum(masks[i] for i in c))).alias("value")) for c in choices]
    left, right = (x.select("fingerprint").distinct().select(F.col("fingerprint").alias(n), F.explode(F.array(*keys)).alias("k")).select(n, "k.*") for x, n in ((prints, "a"), (prints if others is None else others, "b")))
    apart = F.col("a").bitwiseXOR(F.col("b"))
    # sizes are estimated without the choices: a broadcast would send many times what it seems to
    met = left.join(right.hint("merge"), ["choice", "value"]).where((F.col("a") < F.col("b") if others is None else F.col("a") != F.col("b")) & (F.bit_count(apart) <= threshold))
    # of a pair's choices the first: the three common blocks with the lowest numbers
    common = [apart.bitwiseAND(bits(m)) == 0 for m in masks]
    upto = {sum(1 << i for i in c): (2 << c[-1]) - 1 for c in choices}
    shared = reduce(lambda x, y: x + y, [F.when(c, 1 << i).otherwise(0) for i, c in enumerate(common)])
    first = F.create_map(*[F.lit(x) for pair in upto.items() for x in pair])
    pairs = met.where(shared.bitwiseAND(first[F.col("choice")]) == F.col("choice"))
    return pairs.select("a", "b", F.bit_count(apart).alias("distance"))


def near_repeats(prints: DataFrame, threshold: int = 3, bands: int = 4, seq: str = "seq") -> DataFrame:
    """``seq`` of rows of ``(seq, fingerprint)`` to which an earlier row, a duplicate or not, is within ``threshold`` bits.

    Equal fingerprints are one before the join: a row repeats if its own fingerprint
    came earlier, or a near one did; hot fingerprints never meet themselves.
    """
    first = prints.groupBy("fingerprint").agg(F.min(seq).alias("_first"))
    pairs = near_pairs(first, threshold, bands)
    both = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both.join(first.select(F.col("fingerprint").alias("b"), F.col("_first").alias("_near")), "b").groupBy("a").agg(F.min("_near").alias("_near"))
    least = first.join(near.withColumnRenamed("a", "fingerprint"), "fingerprint", "left").select("fingerprint", F.least("_first", "_near").alias("_least"))
    salted = prints.withColumn("_salt", F.pmod(F.xxhash64(seq), F.lit(SALTS)))
    marks = salted.select("fingerprint", "_salt").distinct().join(least, "fingerprint")
    return salted.join(marks, ["fingerprint", "_salt"]).where(F.col(seq) > F.col("_least")).select(seq)


def exact_step(df: DataFrame, config: Mapping[str, Any], step: Any, position: int) -> DataFrame:
    """Rows are written once, with their digests; of these only digests and positions are shuffled."""
    from siltstone.plans.record import DROP, State, marked

    alive = F.col("rank") < DROP
    df = staged(df.withColumn("_digest", F.when(alive, text_digest(F.when(alive, State(config, config["_category"]).text())))), "exact")
    found = repeated(df.where("_digest is not null").select("seq", F.col("_digest").alias("digest")), prior=config.get("prior_digests"))
    joined = marked_rows(df, found, "_again")
    sets = {"text_sha256": F.coalesce("text_sha256", "_digest")}
    return marked(joined, position, [(F.col("_again"), DROP, "exact_duplicate")], [], sets).drop("_digest", "_again")


def near_step(df: DataFrame, config: Mapping[str, Any], step: Any, position: int) -> DataFrame:
    """Reads the rows that the exact step wrote; only fingerprints and positions are written and shuffled."""
    from siltstone.plans.record import DROP, State, marked

    if not config.get("near_dedup"):
        return df
    text = State(config, config["_category"]).text()
    prints = staged(df.where(F.col("rank") < DROP).select("seq", simhash(text, int(config.get("near_dedup_ngram", 5))).alias("fingerprint")), "prints")
    found = near_repeats(prints, int(config.get("near_dedup_threshold", 3)), int(config.get("near_dedup_bands", 4)))
    return marked(marked_rows(df, found, "_near"), position, [(F.col("_near"), DROP, "near_duplicate")], [], {}).drop("_near")


def first_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key."""
    rows = F.row_number().over(Window.partitionBy(key).orderBy(order))
    return df.withColumn("_row", rows).where("_row = 1").drop("_row")


def shingled(df: DataFrame, key: str, text: Column, n: int) -> DataFrame:
    """``(key, shingle)``: hashes of the different word n-grams of each text."""
    from siltstone.functions.text import ngrams

    words = F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+)"), 1)
    return df.select(key, F.explode(F.array_distinct(F.transform(ngrams(words, n), lambda g: F.xxhash64(g)))).alias("shingle"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_text: str = "text", n: int = 13) -> DataFrame:
    """``(key, shingles, shared, overlap)`` of documents that share a word n-gram with the benchmark."""
    tests = shingled(benchmark.withColumn("_item", F.monotonically_increasing_id()), "_item", F.col(item_text), n).select("shingle").distinct().withColumn("_hit", F.lit(1))
    own = shingled(docs, key, F.col(text), n).join(tests, "shingle", "left")
    counts = own.groupBy(key).agg(F.count("*").alias("shingles"), F.count("_hit").alias("shared"))
    return counts.where("shared > 0").select(key, "shingles", "shared", (F.col("shared") / F.col("shingles")).alias("overlap"))


def outside(df: DataFrame, earlier: DataFrame, digest: str = "digest") -> DataFrame:
    """Rows whose digest an earlier stage doesn't hold."""
    return df.join(earlier.select(digest).distinct(), digest, "left_anti")
