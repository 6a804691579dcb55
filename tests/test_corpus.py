"""The stage as a whole, token files, samples over epochs, sequence operators and conversations."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.functions import text as tx
from siltstone.operators import corpus, prep, sequences
from siltstone.sources import jsonl


def test_stage_from_file_to_file(spark, tmp_path):
    from siltstone.plans import stage

    rows = [{"content": "a page of text that was read by a scanner", "id": "x"}, {"text": ""}, {"text": "another page of text that was read", "source": "s"}, {"text": "Another  page of text that was read", "source": "s"}]
    (tmp_path / "in.jsonl").write_text("\n".join([*map(json.dumps, rows), "", "[1]"]) + "\n")
    out = str(tmp_path / "out")
    with pytest.raises(Exception, match="not a JSON object"):
        stage.run_stage(spark, str(tmp_path / "in.jsonl"), str(tmp_path / "no"), "pretrain", "pdf_ocr")
    with pytest.raises(ValueError):
        stage.run_stage(spark, "nowhere", out, "pretrain", "web")
    hook = lambda df: df.withColumn("f_source", F.coalesce("f_source", F.lit("hook")))
    summary = stage.run_stage(spark, str(tmp_path / "in.jsonl"), out, "pretrain", "pdf_ocr", strict=False, hooks=[hook])
    assert (summary["input"], summary["bad_lines"], summary["written"]) == (4, 1, 2) and summary["counters"]["exact_deduplicate"] == {"seen": 3, "review": 0, "drop": 1}
    written = {r["source_id"]: r for p in sorted((tmp_path / "out").glob("part-*")) for r in map(json.loads, p.read_text().splitlines())}
    assert set(written) == {"x", "dataset:2"} and written["x"]["data"]["text"] == rows[0]["content"] and written["x"]["decision"] == "keep"
    assert json.loads((tmp_path / "out.manifest.json").read_text())["decisions"] == {"keep": 2, "review": 0, "drop": 0}
    assert json.loads((tmp_path / "out.summary.json").read_text()) == summary


def test_line_numbers(spark, tmp_path):
    for name, n in (("a.txt", 3), ("b.txt", 5)):
        (tmp_path / name).write_text("".join(f"{i}\n" for i in range(n)))
    rows = jsonl.read_lines(spark, str(tmp_path)).collect()
    assert all(str(r.position) == r.line for r in rows) and len(rows) == 8


def test_token_files(spark, tmp_path):
    rng = np.random.default_rng(3)
    docs = {i: rng.integers(0, 50_000, int(rng.integers(0, 40))).tolist() for i in range(50)}
    df = spark.createDataFrame([(i, x) for i, x in docs.items()] + [(99, None)], "doc_id long, ids array<int>").repartition(3)
    parts = corpus.write_indexed(df, str(tmp_path / "c"), kind=np.uint16).collect()
    assert sum(r.sequences for r in parts) == 50 and sum(r.tokens for r in parts) == sum(map(len, docs.values()))
    back = [list(r.ids) for r in corpus.read_indexed(spark, str(tmp_path / "c")).orderBy("part", "sequence").collect()]
    assert back == [docs[i] for i in sorted(docs)]
    kind, sizes, places, bounds = corpus.read_index(str(tmp_path / "c" / "part-000000.idx"))
    assert kind == np.uint16 and (np.diff(places) == 2 * sizes[:-1]).all() and bounds.tolist() == list(range(len(sizes) + 1))
    next((tmp_path / "c").glob("*.bin")).unlink()
    with pytest.raises(ValueError):
        corpus.read_indexed(spark, str(tmp_path / "c"))


def test_samples_over_epochs(spark):
    docs = spark.createDataFrame([(i, i % 7) for i in range(40)], "doc_id long, n long")
    pieces = corpus.sample_index(docs, 8, 2, 1).collect()
    total = 2 * sum(i % 7 for i in range(40))
    assert sum(r.end - r.begin for r in pieces) == total
    assert sorted({r.place for r in pieces}) == list(range(-(-total // 8))) == sorted({r.sample for r in pieces})
    each = {}
    for r in pieces:
        each.setdefault((r.epoch, r.doc_id), []).append((r.begin, r.end))
    assert len(each) == 2 * sum(i % 7 > 0 for i in range(40))
    for (_, i), spans in each.items():
        spans.sort()
        assert spans[0][0] == 0 and spans[-1][1] == i % 7 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    again = corpus.sample_index(docs.repartition(5), 8, 2, 1).collect()
    assert sorted(map(tuple, pieces)) == sorted(map(tuple, again)) != sorted(map(tuple, corpus.sample_index(docs, 8, 2, 2).collect()))


def test_samplers_and_totals(spark):
    rows = spark.range(10).select("id", corpus.batches(F.col("id"), 2, 2, 1, 10).alias("b"), corpus.rank_slice(F.col("id"), 7, 3).alias("r")).orderBy("id").collect()
    assert [r.b and tuple(r.b) for r in rows] == [None, (0, 0, 0), (0, 0, 1), (0, 1, 0), (0, 1, 1), (1, 0, 0), (1, 0, 1), (1, 1, 0), (1, 1, 1), None]
    assert [r.r for r in rows] == [0, 0, 0, 1, 1, 1, 2, None, None, None]
    order = spark.createDataFrame([(i, d, s) for i, (d, s) in enumerate(prep.blend_order([2, 1], 6))], "step long, dataset int, sample int")
    have = spark.createDataFrame([(d, s, f"{d}-{s}") for d in range(2) for s in range(4)], "dataset int, sample int, text string")
    assert [r.text for r in corpus.blended(order, have).orderBy("step").collect()] == [f"{d}-{s}" for d, s in prep.blend_order([2, 1], 6)]
    with pytest.raises(Exception, match="no sample"):
        corpus.blended(order, have.where("sample < 1")).collect()
    assert corpus.iterations(1000, 10, 4) == {"iterations": 2, "tokens_per_iteration": 400, "left_over": 2}
    assert corpus.require_tokens({"a": {"b": 5}}, 5, ("x.y", "a.b")) == 5
    for bad in ({"a": {"b": 6}}, {}):
        with pytest.raises(ValueError):
            corpus.require_tokens(bad, 5, ("a.b",))


def test_sequence_operators(spark):
    docs = spark.createDataFrame([(i, list(range(i))) for i in range(0, 60, 7)] + [(100, None)], "doc_id long, ids array<int>")
    for r in sequences.infill(docs, 1.0, 0.5, 900, 901, 902, 903).collect():
        assert r.ids is None if r.doc_id == 100 else len(r.ids) == r.doc_id
    for r in sequences.mask_tokens(docs, 0.3, 900, 50).collect():
        assert r.ids is None or [t if t != -100 else x for x, t in zip(r.ids, r.targets)] == list(range(r.doc_id))
    for r in sequences.corrupt_spans(docs, 0.3, range(900, 990), 1000, 1001).collect():
        assert r.encoder is None or sorted(x for x in [*r.encoder, *r.output] if x < 900) == list(range(r.doc_id))
    again = sequences.mask_tokens(docs.repartition(4), 0.3, 900, 50).collect()
    assert sorted(again) == sorted(sequences.mask_tokens(docs, 0.3, 900, 50).collect())


def test_pairs_of_sentences(spark):
    df = spark.createDataFrame([(1, [[1, 2, 3], [4], [5, 6, 7, 8]]), (2, [[1]]), (3, None)], "doc_id long, parts array<array<int>>")
    found = {r.doc_id: r for r in sequences.sentence_pairs(df, 6, 101, 102, 103, 90).collect()}
    assert found[2].ids is None and found[3].ids is None
    one = found[1]
    whole = [x if t == -100 else t for x, t in zip(one.ids, one.targets)]
    assert whole[0] == 101 and whole.count(102) == 2 and len(whole) == len(one.kinds) <= 9 and sum(one.kinds) == len(whole) - whole.index(102) - 1
    pair = sequences.classified_pair(F.array(F.lit(1), F.lit(2)), F.array(F.lit(3), F.lit(4)), 6, 8, 9, 0)
    short = sequences.classified_pair(F.array(F.lit(1)), None, 5, 8, 9, 0)
    r = spark.range(1).select(pair.alias("p"), short.alias("s"), sequences.stripped(F.array(*map(F.lit, [1, 0, 2, 0, 0])), 0).alias("t"), sequences.stripped(F.array(F.lit(0)), 0).alias("u")).first()
    assert (r.p.ids, r.p.kinds, r.p.seen) == ([8, 1, 2, 9, 3, 9], [0, 0, 0, 0, 1, 1], [1] * 6)
    assert (r.s.ids, r.s.kinds, r.s.seen) == ([8, 1, 9, 0, 0], [0] * 5, [1, 1, 1, 0, 0]) and (r.t, r.u) == ([1, 0, 2], [])


def test_streams_of_samples(spark):
    df = spark.createDataFrame([(i, [i] * 3) for i in range(10)], "doc_id long, ids array<int>")
    rows = sequences.streamed(df, 4, shards=1).orderBy("sample").collect()
    assert [(r.ids, r.keys) for r in rows] == [([2 * i] * 3 + [2 * i + 1] * 2, [2 * i, 2 * i + 1]) for i in range(5)]


def test_conversations(spark, tmp_path):
    shared = {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}
    native = {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}
    packed = {"format": corpus.PREPACKED, "tokens": [1, 2], "targets": [-100, 2], "cu_seqlens": [0, 2]}
    for name, row in (("shared", shared), ("messages", native), ("prepacked", packed), ("unknown", {"x": 1})):
        (tmp_path / name).write_text("\n \n" + json.dumps(row) + "\n")
        assert corpus.sft_format(spark, str(tmp_path / name)) == name
    said = [("user", "q"), ("assistant", "a")]
    for name in ("shared", "messages"):
        assert [tuple(m) for m in corpus.read_sft(spark, str(tmp_path / name)).first().messages] == said
    assert corpus.read_sft(spark, str(tmp_path / "prepacked")).first().tokens == [1, 2]
    (tmp_path / "bad").write_text(json.dumps(packed | {"targets": [1]}) + "\n")
    (tmp_path / "odd").write_text(json.dumps({"conversations": [{"from": "bot", "value": "q"}]}) + "\n")
    for name in ("unknown", "bad", "odd"):
        with pytest.raises(Exception):
            corpus.read_sft(spark, str(tmp_path / name)).collect()
    df = spark.createDataFrame([(1, said), (2, said[1:]), (3, [("user", "q"), ("x", "a")])], "doc_id long, messages array<struct<role:string,content:string>>")
    found = {r.doc_id: r for r in sequences.conversation_samples(df, {"user": "U", "assistant": "A"}, "|").collect()}
    assert bytes(found[1].ids) == b"Uq|Aa|" and found[1].targets == [-100] * 4 + list(b"a|") and found[1].error is None
    assert "follows neither" in found[2].error and "unknown role" in found[3].error and found[3].ids is None
    assert [r.ok for r in df.select(sequences.usable_turns(F.col("messages")).alias("ok")).collect()] == [True, False, True]
    assert [tuple(m) for m in spark.range(1).select(corpus.question_conversation(F.lit("q"), F.lit("a")).alias("m")).first().m] == said


def test_text_functions(spark):
    text = "write to a.b@c.example.org, 10.0.0.255 or +49 30 1234 5678; sk_abcdefghij0123456789"
    r = spark.range(1).select(
        tx.private_counts(F.lit(text)).alias("c"), tx.redacted(F.lit(text)).alias("r"), tx.cut_bytes(F.lit("aé€"), 4).alias("cut"), tx.one_line(F.lit("a\nb  c . d . e")).alias("one"),
        tx.without_repeated_lines(F.lit("a\n\nb\n a\n\nb")).alias("lines"), tx.thought_and_answer(F.lit("x </think> y")).alias("t"), tx.thought_and_answer(F.lit("<think>x</think>y</think>")).alias("u"), tx.thought_and_answer(F.lit("y")).alias("v"),
        tx.main_text(F.lit("<p>one</p><script>no</script><div>two<br>three</div>")).alias("m"),
    ).first()
    assert tuple(r.c) == (1, 1, 1, 1) and r.r == "write to [EMAIL], [IP] or [PHONE]; [KEY]"
    assert r.cut == "aé" and r.one == "a b c. d. e" and r.lines == "a\n\nb\n" and tuple(r.t) == ("x", "y") and tuple(r.u) == ("x", "y</think>") and tuple(r.v) == (None, "y") and r.m == "one\n\ntwo\nthree"


def test_microshards_equal_a_loop(spark):
    rng = np.random.default_rng(1)
    rows = [(s, i, int(rng.choice([0, 0, 1, 5, 9, 30]))) for s in "ab" for i in range(200)]
    expected = []
    for s in "ab":
        begin, held, last = 0, 0, 0
        for _, i, n in (r for r in rows if r[0] == s):
            if held > 0 and held + n > 20:
                expected.append((s, begin, i, held))
                begin, held = i, 0
            held, last = held + n, i + 1
        expected.append((s, begin, last, held))
    df = spark.createDataFrame(rows, "source string, row long, tokens long").repartition(4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 37)
    try:
        assert sorted(map(tuple, prep.microshards(df, 20).collect())) == expected
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_cleaning_of_a_stream(spark, tmp_path):
    from siltstone.plans.record import adapted
    from siltstone.streaming.pipeline import clean_batch

    write = clean_batch(str(tmp_path), "pretrain", "general_text")
    for epoch, texts in enumerate((["a first text of some length", "a second text of some length"], ["A  first text of some length", "a third text of some length", ""])):
        df = spark.createDataFrame([(10 * epoch + i, json.dumps({"text": t, "source": "s"})) for i, t in enumerate(texts)], "seq long, payload string")
        for _ in range(2):  # a batch that is run again changes nothing
            write(adapted(df, "payload", F.lit("d"), F.col("seq")), epoch)
    assert sorted(r.seq for r in spark.read.parquet(str(tmp_path / "rows")).collect()) == [0, 1, 11]


def test_near_duplicates_of_a_stream(spark, tmp_path):
    from siltstone.streaming.pipeline import near_dedup_batch

    base = " ".join(f"word{i}" for i in range(60))
    write = near_dedup_batch(str(tmp_path))
    for epoch, rows in enumerate(([(0, base), (1, "quite another text"), (2, base)], [(3, base), (4, "a third text then"), (5, "a third text then")])):
        write(spark.createDataFrame(rows, "seq long, text string"), epoch)
    assert sorted(r.seq for r in spark.read.parquet(str(tmp_path / "rows")).collect()) == [0, 1, 4]


def _sample_query(spark, folder, name):
    """Rows of a query over samples, some with an id of several texts, none or a null one; its plan must join nothing, since a join may send all tokens to the driver."""
    from siltstone.plans import registry

    rows = [(1, "ab c" * 50), (1, "ab c" * 50), (1, "xy"), (2, "é"), (3, ""), (4, None), (None, "no id")]
    spark.createDataFrame(rows, "sample_id long, text string").write.parquet(f"{folder}/samples.parquet")
    found = registry.QUERIES[name](spark, str(folder))
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, found.collect()), key=str) == [(1, 2, True), (1, 200, True), (2, 2, True), (None, 5, True)]


def test_corrupted_samples_join_nothing(spark, tmp_path):
    _sample_query(spark, tmp_path, "corrupted_samples")


def test_infilled_samples_join_nothing(spark, tmp_path):
    _sample_query(spark, tmp_path, "infilled_samples")


def test_masked_samples_join_nothing(spark, tmp_path):
    _sample_query(spark, tmp_path, "masked_samples")


def test_byte_lists():
    import pyarrow as pa

    texts = ["ab", None, "", "é€😀", "c\0d"]
    for kind in (pa.string(), pa.large_string()):
        column = pa.array(texts, kind)
        whole = [sequences.byte_tokens(t) if t else None for t in texts]
        assert sequences.byte_lists(column).to_pylist() == whole and sequences.byte_lists(column.slice(1, 3)).to_pylist() == whole[1:4]
        assert sequences.byte_lists(column.slice(1, 2)).to_pylist() == [None, None] and sequences.byte_lists(column.slice(0, 0)).to_pylist() == []
    assert sequences.byte_lists(pa.array([None, ""], pa.string())).to_pylist() == [None, None]


def test_cells_of_lists():
    import pyarrow as pa

    column = pa.array([[1, 2], None, [], [3], [4, 5]], pa.list_(pa.int32()))
    assert sequences.cells(column) == column.to_pylist() and sequences.cells(column.slice(1, 3)) == [None, [], [3]]
    assert sequences.cells(pa.array([[1, None], [2]])) == [[1, None], [2]] and sequences.cells(pa.array(["a", None])) == ["a", None]
