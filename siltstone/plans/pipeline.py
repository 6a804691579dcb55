"""Cleaning pipelines: which steps a stage, a category and a profile give, and running them."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.operators.profiles import FORMAT, PROFILES
from siltstone.operators.steps import BY_CATEGORY, PREFIX, SUFFIX, filter_pdf_ocr_quality, normalize_general_text, normalize_pdf_ocr, step
from siltstone.plans.record import CATEGORIES, DROP, STAGES, Step, apply_step, finished

PRETRAIN = {
    "code": BY_CATEGORY["code"],
    "pdf_ocr": [step(normalize_pdf_ocr), step(filter_pdf_ocr_quality)],
    "general_text": [step(normalize_general_text)],
}


def category_steps(category: str) -> list[Step]:
    own = BY_CATEGORY[category]
    return own[:1] + PREFIX + own[1:] + SUFFIX


def steps_of(stage: str | None, category: str, profile: str | None = None) -> list[Step]:
    """The steps in order. Without a stage a category's own pipeline; unknown or ill-matched names raise."""
    if category not in CATEGORIES:
        raise ValueError(f"unknown category {category}")
    if stage is not None and stage not in STAGES:
        raise ValueError(f"unknown stage {stage}")
    before: list[Step] = []
    if profile is not None:
        if profile not in PROFILES:
            raise ValueError(f"unknown profile {profile}")
        own_stage, own_category, before = PROFILES[profile]
        if (own_stage, own_category) != (stage, category):
            raise ValueError(f"profile {profile} belongs to {own_stage} {own_category}")
    if stage == "pretrain":
        if category not in PRETRAIN:
            raise ValueError(f"pretraining has no category {category}")
        return before + PRETRAIN[category] + PREFIX + SUFFIX
    if stage in ("midtrain", "posttrain") and category in ("pdf_ocr", "general_text"):
        raise ValueError(f"{stage} has no category {category}")
    return before + (FORMAT if stage == "posttrain" else []) + category_steps(category)


def clean(records: DataFrame, stage: str | None, category: str, profile: str | None = None, config: Mapping[str, Any] | None = None, keep_dropped: bool = True) -> DataFrame:
    """Records (see ``plans.record``) with their decisions, reasons, flags, buckets and metrics.

    Dropped rows pass no later step. A ``prior_digests`` frame in the configuration
    makes texts of earlier runs count as seen.
    """
    config = dict(config or {}, _category=category)
    for position, one in enumerate(steps_of(stage, category, profile)):
        records = apply_step(records, one, position, category, config)
    if not keep_dropped:
        records = records.where(F.col("rank") < DROP)
    return finished(records, stage or "", category)


def step_counts(cleaned: DataFrame, steps: list[Step]) -> DataFrame:
    """``(step, seen, review, dropped)``: rows that reached each step, and decisions that changed there. One pass over the rows."""
    end = len(steps) - 1
    last = F.coalesce(F.array_max(F.transform("transitions", lambda t: F.when(t["rank"] == DROP, t["step"]))), F.lit(end))
    rows = cleaned.select(
        F.explode(F.concat(
            F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(i.alias("position"), F.lit("seen").alias("what"))),
            F.transform("transitions", lambda t: F.struct(t["step"].alias("position"), F.when(t["rank"] == DROP, "dropped").otherwise("review").alias("what"))),
        )).alias("e")
    ).select("e.*")
    names = F.create_map(*[F.lit(x) for i, s in enumerate(steps) for x in (i, s.name)])
    n = lambda what: F.count(F.when(F.col("what") == what, True)).alias(what)
    return rows.groupBy("position").agg(n("seen"), n("review"), n("dropped")).select("position", names[F.col("position")].alias("step"), "seen", "review", "dropped")
