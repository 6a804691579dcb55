"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.session import staged

#: Records of one cell of the order within a source, about.
CELL_ROWS = 100_000
#: Targets up to which the plan is sent to every task; a larger plan is joined by salted sources.
MOST_TARGETS, SALTS = 100_000, 64
#: Fixed value: blanks that trimming removes.
BLANKS = " \t\n\r\f\x0b\x85\xa0    ​　﻿"


def label(column: str) -> Column:
    return F.lower(F.btrim(F.col(column), F.lit(BLANKS)))


@dataclass
class Mix:
    """What was drawn: ``plan`` of all targets, ``chosen`` records with their copies, ``report`` of the shares."""

    plan: DataFrame
    chosen: DataFrame
    report: DataFrame


def usable_candidates(candidates: DataFrame, profiles: DataFrame) -> DataFrame:
    """``(candidate_id, source, n_tokens)`` of records with a known profile and tokens; of a record delivered again the first counts."""
    first = candidates.where("candidate_id is not null").groupBy("candidate_id").agg(F.min(F.struct(F.coalesce("counted_at", F.lit("9999-01-01").cast("timestamp")).alias("at"), "n_tokens", label("profile").alias("profile"))).alias("c"))
    names = profiles.select(label("profile").alias("profile"), label("source").alias("source")).where("profile is not null and source is not null").groupBy("profile").agg(F.min("source").alias("source"))
    return first.select("candidate_id", "c.n_tokens", "c.profile").where("n_tokens > 0").join(names, "profile").select("candidate_id", "source", "n_tokens")


def target_plan(usable: DataFrame, plans: DataFrame, targets: DataFrame, seed: int = 0) -> DataFrame:
    """Per (mix, source): share, tokens wanted and available, the expected copies of each record, one random offset.

    Targets count with a weight above 0 only, a repeated (mix, source) once (its
    largest weight, then its largest cap); the shares of a mix sum to 1, sources
    without a record included. A cap that is null or below 0 counts as 0.
    """
    sizes = usable.groupBy("source").agg(F.sum("n_tokens").alias("available"), F.count("*").alias("records"))
    total = usable.agg(F.sum("n_tokens")).first()[0] or 0
    weight = F.col("weight").cast("decimal(28,12)")
    wanted = (
        targets.select("mix_id", label("source").alias("source"), weight.alias("weight"), F.greatest(F.coalesce("max_epochs", F.lit(0)), F.lit(0)).alias("max_epochs"))
        .where("weight > 0 and not isnan(cast(weight as double)) and mix_id is not null and source is not null")
        .groupBy("mix_id", "source")
        .agg(F.max(F.struct("weight", "max_epochs")).alias("t"))
        .select("mix_id", "source", "t.*")
    )
    whole = Window.partitionBy("mix_id")
    share = F.col("weight").cast("double") / F.sum("weight").over(whole).cast("double")
    factors = plans.where("mix_id is not null and size_factor > 0").groupBy("mix_id").agg(F.max("size_factor").alias("size_factor"))
    offset = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), "mix_id", "source")), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)
    tokens = F.col("share") * F.col("size_factor") * F.lit(total).cast("long")
    capacity = F.col("max_epochs") * F.col("available")
    return (
        wanted.withColumn("share", share)
        .join(factors, "mix_id")
        .join(sizes, "source", "left")
        .select("mix_id", "source", "share", "max_epochs", F.coalesce("available", F.lit(0)).alias("available"), F.coalesce("records", F.lit(0)).alias("records"), tokens.alias("wanted"), offset.alias("offset"))
        .withColumn("copies", F.when(F.col("wanted") >= capacity, F.col("max_epochs").cast("double")).otherwise(F.col("wanted") / F.col("available")))
    )


def ordered(usable: DataFrame, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``usable`` with ``position``, the place of each record within its source, from 1.

    The order is by bits of the size, then by a hash, so that a systematic sample
    takes its share of each size. It is counted in cells of about ``cell_rows``
    records: places within the cells, and a running sum over the few cells' counts;
    a source of any size is spread over many tasks.
    """
    keyed = usable.withColumn("_bits", F.length(F.bin("n_tokens"))).withColumn("_hash", F.md5(F.col("candidate_id").cast("string")))
    largest = keyed.groupBy("source", "_bits").count().agg(F.max("count")).first()[0] or 0
    digits = 0
    while largest > cell_rows * 16**digits:
        digits += 1
    keyed = keyed.withColumn("_cell", F.substring("_hash", 1, digits))
    cell = ["source", "_bits", "_cell"]
    counts = keyed.groupBy(*cell).agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.sum("_n").over(Window.partitionBy("source").orderBy("_bits", "_cell")) - F.col("_n"))
    within = keyed.withColumn("_row", F.row_number().over(Window.partitionBy(*cell).orderBy("_hash", "candidate_id")))
    return within.join(before, cell).select("candidate_id", "source", "n_tokens", (F.col("_before") + F.col("_row")).alias("position"))


def mix(candidates: DataFrame, profiles: DataFrame, plans: DataFrame, targets: DataFrame, seed: int = 0, cell_rows: int = CELL_ROWS) -> Mix:
    """Chooses records of each source of each mix so that its tokens follow the target weights.

    Every record of a source is expected equally often, at most ``max_epochs`` times.
    The expectations are summed up along the source's order from one random offset;
    a record is emitted once for each whole number the sum passes at it, so no record
    is used more than ``max_epochs`` times and the tokens drawn differ from those
    expected by little. A source that cannot be filled gives what it has; its lack is
    reported, not spread over the others. Empty tables give empty results.
    """
    usable = staged(usable_candidates(candidates, profiles), "usable")
    plan = staged(target_plan(usable, plans, targets, seed), "plan")
    rows = staged(ordered(usable, cell_rows), "ordered")
    sums = F.col("position") * F.col("copies") + F.col("offset")
    earlier = (F.col("position") - 1) * F.col("copies") + F.col("offset")
    active = plan.where("copies > 0").select("mix_id", "source", "copies", "offset")
    if active.count() <= MOST_TARGETS:
        drawn = rows.join(F.broadcast(active), "source")
    else:
        salted = active.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        drawn = rows.withColumn("_salt", F.pmod(F.xxhash64("candidate_id"), F.lit(SALTS)).cast("int")).join(salted, ["source", "_salt"])
    chosen = drawn.select("mix_id", "source", "candidate_id", "n_tokens", (F.floor(sums) - F.floor(earlier)).alias("n")).where("n > 0")
    got = chosen.groupBy("mix_id", "source").agg(F.sum("n").alias("emitted"), F.count("*").alias("used"), F.sum(F.col("n") * F.col("n_tokens")).alias("tokens"))
    filled = plan.join(got, ["mix_id", "source"], "left").na.fill(0, ["emitted", "used", "tokens"])
    actual = F.col("tokens") / F.sum("tokens").over(Window.partitionBy("mix_id"))
    report = filled.select("mix_id", "source", "share", "wanted", "available", "max_epochs", "emitted", "used", "tokens", F.coalesce(F.when(F.col("tokens") > 0, actual), F.lit(0.0)).alias("actual_share"))
    return Mix(plan, chosen.select("mix_id", "source", "candidate_id", F.col("n").alias("copies"), "n_tokens"), report)


def unfilled(report: DataFrame) -> DataFrame:
    """Targets whose every record was drawn as often as allowed, and that wanted still more."""
    spent = F.col("tokens") == F.col("max_epochs") * F.col("available")
    return report.where(spent & (F.col("wanted") > F.col("max_epochs") * F.col("available"))).select("mix_id", "source")
