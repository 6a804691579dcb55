"""A stage from JSON lines to cleaned JSON lines, a manifest and a summary; also as a command."""

from __future__ import annotations

import argparse
import json
from collections.abc import Callable, Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from siltstone.operators.prep import positioned
from siltstone.plans.pipeline import clean, step_counts, steps_of
from siltstone.plans.record import CATEGORIES, STAGES, adapted
from siltstone.session import session, staged, write_text
from siltstone.sources import jsonl

Hook = Callable[[DataFrame], DataFrame]


def run_stage(
    spark: SparkSession, source: str, output: str, stage: str | None, category: str, profile: str | None = None, config: Mapping[str, Any] | None = None,
    dataset: str = "dataset", id_field: str = "id", field_map: Mapping[str, str] | None = None, hooks: Iterable[Hook] = (), keep_dropped: bool = False, strict: bool = True,
) -> dict:
    """Cleans the JSON objects of the files under ``source`` and writes ``output`` (a folder of JSON lines), ``output``.manifest.json and ``output``.summary.json.

    ``hooks`` change the adapted frame before the first step. Dropped rows are counted,
    but written only with ``keep_dropped``. Without ``strict`` lines that are no objects are
    counted and left out. Returns the summary: what ran, rows read, bad and written, and
    at each step the rows seen and the decisions changed.
    """
    steps = steps_of(stage, category, profile)  # unknown names raise before anything is read
    lines = jsonl.objects(jsonl.read_lines(spark, source), strict)
    bad = 0
    if not strict:
        lines = staged(lines, "lines")
        bad = lines.where("bad").count()
        lines = lines.where("not bad").drop("bad")
    rows = positioned(lines, ["file", "position"], "seq")
    records = adapted(rows, "payload", F.lit(dataset), F.col("seq"), id_field, field_map)
    for hook in hooks:
        records = hook(records)
    cleaned = staged(clean(records, stage, category, profile, config), "cleaned")
    kept = cleaned if keep_dropped else cleaned.where("decision <> 'drop'")
    seen = Observation()
    jsonl.write_jsonl(jsonl.released(kept).observe(seen, F.count(F.lit(1)).alias("rows")), output)
    counters = {r.step: {"seen": r.seen, "review": r.review, "drop": r.dropped} for r in step_counts(cleaned, steps).orderBy("position").collect()}
    summary = {
        "stage": stage, "category": category, "profile": profile, "source": source, "output": output, "input": cleaned.count(), "bad_lines": bad, "written": seen.get["rows"], "steps": [s.name for s in steps], "counters": counters,
    }
    written = spark.read.schema("decision string").json(output)
    write_text(spark, f"{output.rstrip('/')}.manifest.json", jsonl.manifest_text(jsonl.manifest(written, stage or "", output)))
    write_text(spark, f"{output.rstrip('/')}.summary.json", json.dumps(summary, indent=2, sort_keys=True, ensure_ascii=False) + "\n")
    return summary


def main(arguments: list[str] | None = None) -> dict:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("source")
    parser.add_argument("output")
    parser.add_argument("--stage", choices=STAGES)
    parser.add_argument("--category", choices=CATEGORIES, required=True)
    parser.add_argument("--profile")
    parser.add_argument("--config", help="a JSON object, or @ and the name of a file that holds one")
    parser.add_argument("--dataset", default="dataset")
    parser.add_argument("--id-field", default="id")
    parser.add_argument("--require-license", action="store_true")
    parser.add_argument("--keep-dropped", action="store_true")
    parser.add_argument("--lenient", action="store_true")
    given = parser.parse_args(arguments)
    text = given.config or "{}"
    if text.startswith("@"):
        with open(text[1:], encoding="utf-8") as held:
            text = held.read()
    config = json.loads(text)
    if not isinstance(config, dict):
        parser.error("the configuration must be one JSON object")
    if given.require_license:
        config["require_license"] = True
    summary = run_stage(session(), given.source, given.output, given.stage, given.category, given.profile, config, given.dataset, given.id_field, keep_dropped=given.keep_dropped, strict=not given.lenient)
    print(json.dumps(summary, ensure_ascii=False))
    return summary


if __name__ == "__main__":
    main()
