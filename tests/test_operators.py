"""Deduplication, preparation, sequences, evaluation and sources on small fixtures."""

import gzip
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.functions import text as tx
from siltstone.operators import dedup, evaluation, prep, sequences
from siltstone.sources import jsonl


def test_normal_form():
    assert tx.normal_form("a\r\nb\tc  d \x00\rｅ f\n\n\n\ng ") == "a\nb c d\ne\nf\n\ng"
    assert tx.fingerprint("") == 0 and tx.fingerprint("one") == tx.fingerprint("ONE")


def test_near_join_equals_brute_force(spark):
    rng = np.random.default_rng(0)
    base = rng.integers(-(2**63), 2**63, 30)
    prints = [(i, int(base[i % 30]) ^ (1 << int(rng.integers(0, 63))) ^ (1 << int(rng.integers(0, 63)))) for i in range(200)] + [(200 + i, 0) for i in range(5)]
    near = lambda a, b: bin((a ^ b) & (2**64 - 1)).count("1") <= 3
    expected = {i for i, p in prints if any(j < i and near(p, q) for j, q in prints)}
    df = spark.createDataFrame(prints, "seq long, fingerprint long")
    assert {r.seq for r in dedup.near_repeats(df).collect()} == expected and len(expected) > 20
    values = sorted({p for _, p in prints})
    pairs = {(a, b) for i, a in enumerate(values) for b in values[i + 1 :] if near(a, b)}
    assert {(r.a, r.b) for r in dedup.near_pairs(df).collect()} == pairs
    with pytest.raises(ValueError):
        dedup.near_pairs(df, 4, 4)


def test_prior_digests(spark):
    df = spark.createDataFrame([(0, "Some text"), (1, "some  text"), (2, "other")], "seq long, text string")
    prior = dedup.repeats(df.where("seq = 2"), F.col("text")).select("digest")
    assert {r.seq for r in dedup.repeats(df, F.col("text"), prior=prior).where("duplicate").collect()} == {1, 2}


def test_plans_on_the_driver():
    assert prep.quotas({"code": 0.5, "web": 0.3, "math": 0.2, "no": 0}, 11) == {"code": 6, "web": 3, "math": 2}
    assert prep.balance([("a", 10), ("b", 7), ("c", 3)], 2) == [["a"], ["b", "c"]]
    assert prep.best_fit([3, 2, 5], 5) == [1, 1, 0]
    assert prep.split_bounds("99,1,0") == [(0.0, 0.99), (0.99, 1.0), (1.0, 1.0)]
    assert prep.parse_blend(["1", "a", "2", "b"]) == (["a", "b"], [1.0, 2.0]) and prep.parse_blend(["a", "b"]) == (["a", "b"], None)
    assert prep.blend_sizes([1, 1], 11, 0.0) == [6, 6]
    order = prep.blend_order([2, 1], 9)
    assert [d for d, _ in order].count(0) == 6 and order[0] == (0, 0)
    assert prep.weighted_tasks({"b": 1, "a": 1}, 3) == {"b": 2, "a": 1}
    assert jsonl.blocks(5, 2) == [(0, 2), (2, 4), (4, 5)]


def test_selection_and_mixes(spark):
    ids = spark.createDataFrame([("ab"[i % 2], str(i)) for i in range(40)], "source string, id string")
    first = [tuple(r) for r in prep.select_mix(ids, {"a": 2, "b": 1}, "s").orderBy("position").collect()]
    again = [tuple(r) for r in prep.select_mix(ids.repartition(5), {"a": 2, "b": 1}, "s").orderBy("position").collect()]
    assert first == again and sorted(s for s, _, _ in first) == ["a", "a", "b"] and [p for _, _, p in first] == [0, 1, 2]
    with pytest.raises(ValueError):
        prep.select_mix(ids, {"a": 99}, "s")
    pool = spark.createDataFrame([(m, str(i)) for m in ("mix16", "mix64", "z") for i in range(6)], "mix string, id string")
    mixes = prep.prefix_mixes(pool, {"z": 1, "mix64": 2, "mix16": 2}, 1).collect()
    assert len({r.id for r in mixes}) == 5 and sorted(r.mix for r in mixes) == ["mix16", "mix16", "mix64", "mix64", "z"]


def test_shards_packs_windows(spark):
    rows = spark.createDataFrame([("s", i, n) for i, n in enumerate([4, 4, 4, 4, -1, None])], "source string, row long, tokens long")
    assert sorted(tuple(r)[1:] for r in prep.microshards(rows, 10).collect()) == [(0, 2, 8), (2, 6, 8)]
    samples = spark.createDataFrame([("a", [1, 2, 3], [-100, 2, 3]), ("b", [4, 5], [-100, 5]), ("long", [0] * 9, [0] * 9)], "source_id string, tokens array<int>, targets array<int>")
    (pack,) = prep.pack_samples(samples, 5, targets="targets").withColumn("mask", prep.loss_mask(F.col("targets"))).collect()
    assert (pack.cu_seqlens, pack.mask, pack.source_ids) == ([0, 3, 5], [0, 1, 1, 0, 1], ["a", "b"])
    assert prep.pack_samples(samples, 5, targets="targets", allow_overlength=True).count() == 2
    docs = spark.createDataFrame([(1, [0] * 5), (2, [0] * 2), (3, []), (4, [0] * 4)], "doc_id long, ids array<int>")
    assert sorted(map(tuple, prep.token_windows(docs, 4).collect())) == [(0, 1, 0, 4), (1, 1, 4, 5), (1, 2, 0, 2), (1, 4, 0, 1), (2, 4, 1, 4)]


def test_sequences(spark):
    rng = lambda k: sequences.seeded(1, k)
    ids = list(range(10, 60))
    out = sequences.infilled(ids, rng("a"), 1.0, 0.0, 1, 2, 3, 0)
    assert len(out) == 50 and out[0] == 1 and out == sequences.infilled(ids, rng("a"), 1.0, 0.0, 1, 2, 3, 0)
    hidden, targets = sequences.masked(ids, rng("b"), 0.2, 5, 100)
    assert sum(t != -100 for t in targets) == 10 and all(h == i for h, i, t in zip(hidden, ids, targets) if t == -100)
    encoder, given, wanted = sequences.span_corrupted(ids, rng("c"), 0.2, [901, 902, 903, 904, 905], 7, 8)
    assert sorted(t for t in encoder + wanted if t < 900 and t != 8) == ids and given[1:] == wanted[:-1]
    tokens, y = sequences.conversation_tokens([{"role": "user", "content": "a"}, {"role": "assistant", "content": "bc"}], sequences.byte_tokens, {"user": "U", "assistant": "A"}, ".")
    assert bytes(tokens) == b"Ua.Abc." and y == [-100] * 4 + list(b"bc.")
    with pytest.raises(ValueError):
        sequences.conversation_tokens([{"role": "assistant", "content": "x"}], sequences.byte_tokens, {"assistant": ""}, "")
    df = spark.createDataFrame([([1, 2, 3], [-100, 2, 3], [0, 2, 3])], "t array<int>, y array<int>, c array<int>")
    row = df.select(sequences.sft_sample(F.col("t"), F.col("y"), 4, 0).alias("s"), sequences.packed_positions(F.col("c")).alias("p"), sequences.packed_errors(F.col("t"), F.col("y"), F.col("c"), 3).alias("e")).first()
    assert (row.s.tokens, row.s.labels, row.s.loss_mask, row.p, row.e) == ([1, 2, 3, 0], [2, 3, 0, 0], [1, 1, 0, 0], [0, 1, 0], None)
    assert [r.piece for r in sequences.unpacked(df, "t", "c").orderBy("segment").collect()] == [[1, 2], [3]]


def test_evaluation(spark):
    df = spark.createDataFrame([(5, 2, "Paris", ["paris", "rome"], "104", "100", "x #### 4")], "n int, c int, a string, t array<string>, x string, y string, s string")
    row = df.select(evaluation.pass_at_k(F.col("n"), F.col("c"), 2).alias("p"), evaluation.anls(F.col("a"), F.col("t")).alias("l"), evaluation.relaxed_match(F.col("x"), F.col("y")).alias("r"), evaluation.last_answer(F.col("s")).alias("e")).first()
    assert row.p == pytest.approx(1 - (3 / 5) * (2 / 4)) and (row.l, row.r, row.e) == (1.0, True, "4")
    turns = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "yo")], "c int, t int, role string, text string")
    assert [tuple(r) for r in evaluation.turn_pairs(turns, "c", "t", "role", "text").collect()] == [(1, 1, "user: hi", "yo")]


def test_sources(spark, tmp_path):
    import zstandard

    lines = '{"a": 1}\n\n{"b": "ü"}\n'
    (tmp_path / "x.jsonl").write_text(lines)
    (tmp_path / "x.jsonl.gz").write_bytes(gzip.compress(lines.encode()))
    (tmp_path / "x.jsonl.zst").write_bytes(zstandard.compress(lines.encode()))
    for name in ("x.jsonl", "x.jsonl.gz", "x.jsonl.zst"):
        found = jsonl.objects(jsonl.read_lines(spark, str(tmp_path / name))).orderBy("position").collect()
        assert [json.loads(r.payload) for r in found] == [{"a": 1}, {"b": "ü"}]
    (tmp_path / "bad.jsonl").write_text('{"a": 1}\n[1]\n')
    with pytest.raises(Exception, match="not a JSON object"):
        jsonl.objects(jsonl.read_lines(spark, str(tmp_path / "bad.jsonl"))).collect()
    assert [r.bad for r in jsonl.objects(jsonl.read_lines(spark, str(tmp_path / "bad.jsonl")), strict=False).orderBy("position").collect()] == [False, True]
    df = spark.createDataFrame([("d", "1", "s", "web", "keep", '{"z":1,"a":"ü"}')], "dataset string, source_id string, stage string, category string, decision string, data string")
    assert jsonl.write_jsonl(df, str(tmp_path / "out")) == 1
    (line,) = [r.value for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert line == '{"category": "web", "data": {"a": "ü", "z": 1}, "dataset": "d", "decision": "keep", "source_id": "1", "stage": "s"}'
    assert jsonl.manifest(df, "s", "o")["decisions"] == {"keep": 1, "review": 0, "drop": 0}
    assert jsonl.release_errors(df).count() == 0 and jsonl.release_errors(df.withColumn("decision", F.lit("x"))).first().error == "unknown decision"
    assert jsonl.file_checksums(spark, str(tmp_path / "x.jsonl")).first().sha256 == __import__("hashlib").sha256(lines.encode()).hexdigest()


def test_stream(spark, tmp_path):
    from siltstone.streaming.pipeline import first_seen

    spark.createDataFrame([("Same text",), ("same  TEXT",), ("other",)], "text string").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = first_seen(spark.readStream.schema("text string").parquet(str(tmp_path / "in")))
    running = stream.writeStream.format("memory").queryName("seen").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).start()
    running.processAllAvailable()
    running.stop()
    assert spark.table("seen").count() == 2


def test_samples_that_are_not_packed(spark, tmp_path):
    from siltstone.plans import registry

    samples = spark.createDataFrame([("a", [1, 2]), ("long", [0] * 9), ("none", []), ("null", None)], "source_id string, tokens array<int>")
    assert sorted(map(tuple, prep.unpacked_samples(samples, 5).collect())) == [("long", 9), ("none", 0), ("null", 0)]
    rows = [(1, "a" * 8_192), (2, "a" * 8_193), (2, "a" * 8_193), (3, ""), (4, None), (5, "\u00e9" * 5_000)]
    spark.createDataFrame(rows, "sample_id long, text string").write.parquet(f"{tmp_path}/samples.parquet")
    assert sorted(map(tuple, registry.QUERIES["packing_unpacked"](spark, str(tmp_path)).collect())) == [(2, 8_193), (3, 0), (4, 0), (5, 10_000)]
    assert [r.samples for r in registry.QUERIES["packing"](spark, str(tmp_path)).collect()] == [1]


def test_near_join_of_dense_numbers(spark, tmp_path):
    """Numbers that differ in their low bits only: each block has its share of these, so no key holds all numbers, and no side is sent to the driver."""
    from siltstone.plans import registry

    for blocks in (6, 8, 16):
        masks = dedup.block_masks(blocks)
        assert sum(masks) == 2**64 - 1 and sum(bin(m).count("1") for m in masks) == 64
        for low, high in ((0, 20), (0, 26), (10, 30), (0, 64)):
            shares = [bin(m >> low & (1 << high - low) - 1).count("1") for m in masks]
            assert max(shares) - min(shares) <= 1
    spark.range(1, 401).select(F.col("id").alias("p_partkey")).unionByName(spark.createDataFrame([(None,), (None,), (5,)], "p_partkey long")).write.parquet(f"{tmp_path}/part.parquet")
    found = registry.QUERIES["near_bits"](spark, str(tmp_path))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan
    values = [37 * i for i in range(1, 401)]
    expected = sorted((a, b, bin(a ^ b).count("1")) for i, a in enumerate(values) for b in values[i + 1 :] if bin(a ^ b).count("1") <= 3)
    assert sorted(map(tuple, found.collect())) == expected and len(expected) > 100
