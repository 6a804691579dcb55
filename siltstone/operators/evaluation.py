"""Metrics and filters on evaluation and rollout data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def pass_at_k(attempts: Column, correct: Column, k: int) -> Column:
    """Chance that one of k attempts drawn without return is correct; raises where there are fewer than k."""
    product = F.aggregate(F.sequence(F.greatest(attempts - correct + 1, F.lit(1)), F.greatest(attempts, F.lit(1))), F.lit(1.0), lambda p, i: p * (1 - F.lit(float(k)) / i))
    return F.when(attempts < k, F.raise_error(F.lit("k exceeds the attempts")).cast("double")).when(attempts - correct < k, 1.0).when(correct == 0, 0.0).otherwise(1 - product)


def pass_rates(rollouts: DataFrame, k: int, group: str = "problem_id", reward: str = "reward") -> DataFrame:
    counts = rollouts.groupBy(group).agg(F.count("*").cast("int").alias("attempts"), F.count(F.when(F.col(reward) == 1.0, 1)).cast("int").alias("correct"))
    return counts.select(group, "attempts", "correct", pass_at_k(F.col("attempts"), F.col("correct"), k).alias("pass_at_k"))


def varied_groups(rollouts: DataFrame, group: str, reward: str, least: float = 1e-6) -> DataFrame:
    """Groups whose rewards aren't all alike, with their mean and spread."""
    stats = rollouts.groupBy(group).agg(F.count("*").alias("n"), F.avg(reward).alias("mean"), F.stddev_pop(reward).alias("spread"))
    return stats.where(F.col("spread") > least)


def accuracy(df: DataFrame, by: list[str], correct: Column) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("total"), F.sum(correct.cast("int")).alias("correct"), F.avg(correct.cast("double")).alias("accuracy"))


def anls(answer: Column, truths: Column, limit: float = 0.5) -> Column:
    """Best normalised Levenshtein similarity to one of the truths; 0 where it is below ``limit``."""
    plain = lambda x: F.lower(F.trim(x))
    one = lambda t: 1 - F.levenshtein(plain(answer), plain(t)) / F.greatest(F.length(plain(answer)), F.length(plain(t)), F.lit(1))
    best = F.array_max(F.transform(truths, one))
    return F.when(best >= limit, best).otherwise(0.0)


def relaxed_match(answer: Column, truth: Column, tolerance: float = 0.05) -> Column:
    """Numbers within a share of the truth, else equal texts."""
    a, t = answer.try_cast("double"), truth.try_cast("double")
    close = F.when(t == 0, a == 0).otherwise(F.abs(a - t) / F.abs(t) <= tolerance)
    return F.when(a.isNotNull() & t.isNotNull(), close).otherwise(F.lower(F.trim(answer)) == F.lower(F.trim(truth)))


def soft_vote(answer: Column, answers: Column) -> Column:
    """Share of annotators that agree, three of them enough: the mean over leaving each one out."""
    n = F.size(answers)
    agree = F.size(F.filter(answers, lambda x: x == answer))
    return (agree * F.least(F.lit(1.0), (agree - 1) / 3) + (n - agree) * F.least(F.lit(1.0), agree / 3)) / n


def last_answer(text: Column) -> Column:
    """What follows the last ``#### ``; the whole text if there is none."""
    return F.element_at(F.split(text, "#### "), -1)


def least_toxic(df: DataFrame, score: str, order: Column) -> DataFrame:
    """The less toxic half of all rows, unscored rows counted but never kept, in a hashed order."""
    half = df.count() // 2
    return df.where(F.col(score).isNotNull()).orderBy(F.col(score), order).limit(half).orderBy(order)


def toxicity_report(df: DataFrame, attributes: list[str], seq: str = "seq", size: int = 25) -> DataFrame:
    """Mean of each attribute; per run of ``size`` rows the mean maximum and the share of runs with one above 0.5."""
    runs = df.withColumn("_run", F.floor(F.col(seq) / size)).groupBy("_run").agg(*[f(a).alias(f"{a}_{n}") for a in attributes for n, f in (("sum", F.sum), ("n", F.count), ("max", F.max))])
    rows = [F.struct(F.lit(a).alias("attribute"), (F.sum(f"{a}_sum") / F.sum(f"{a}_n")).alias("mean"), F.avg(f"{a}_max").alias("mean_max"), F.avg((F.col(f"{a}_max") > 0.5).cast("double")).alias("p_any")) for a in attributes]
    return runs.agg(*[r.alias(f"r{i}") for i, r in enumerate(rows)]).select(F.explode(F.array(*[f"r{i}" for i in range(len(rows))])).alias("r")).select("r.*")


def turn_pairs(turns: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """State and action of each assistant turn: all turns before it, and what it says."""
    before = Window.partitionBy(conversation).orderBy(turn).rowsBetween(Window.unboundedPreceding, -1)
    state = F.array_join(F.collect_list(F.concat_ws(": ", role, text)).over(before), "\n")
    return turns.select(conversation, turn, state.alias("state"), F.col(text).alias("action"), F.col(role).alias("_role")).where("_role = 'assistant'").drop("_role")


def lexical_complexity(text: Column) -> Column:
    """Mean word length times the share of different words."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+)"), 1)
    n = F.size(words)
    return F.when(n > 0, F.length(F.array_join(words, "")) / n * F.size(F.array_distinct(words)) / n)


def curriculum(df: DataFrame, text: str, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """``df`` with ``complexity``, without what lies outside of two quantiles; easy texts come first once it is ordered by it."""
    scored = df.withColumn("complexity", lexical_complexity(F.col(text))).where("complexity is not null")
    bounds = scored.agg(F.percentile_approx("complexity", [low, high], 10_000).alias("p")).first().p
    return scored.where(F.col("complexity").between(*bounds)) if bounds else scored
