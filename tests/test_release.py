"""The released object holds what cleaning made of the payload."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from siltstone.functions import text as tx
from siltstone.operators.profiles import calls_in
from siltstone.sources import jsonl


@pytest.fixture(scope="module")
def release(spark):
    from siltstone.plans.pipeline import clean
    from siltstone.plans.record import adapted

    def go(rows, stage, category, profile=None, **config):
        df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(rows)], "seq long, payload string")
        out = jsonl.released(clean(adapted(df, "payload", F.lit("d"), F.col("seq"), field_map=config.pop("field_map", None)), stage, category, profile, config)).orderBy("seq").collect()
        for r in out:
            assert r.record_sha256 == hashlib.sha256(r.data.encode()).hexdigest()
            assert r.data == json.dumps(json.loads(r.data), ensure_ascii=False, sort_keys=True)
        return [json.loads(r.data) for r in out]

    return go


def digest(text):
    return hashlib.sha256(tx.normal_form(text).casefold().encode()).hexdigest()


def test_text_is_released_as_cleaned(release):
    first, second, third = release([{"text": "Ｗide\tletters  and\r\nline ends", "n": 1.50, "x": {"b": [None, True]}}, {"body": "under another name, of some length", "source": "s", "text_sha256": "kept"}, {"text": None, "source": "s"}], "pretrain", "general_text")
    assert first == {"text": "Wide letters and\nline ends", "n": 1.5, "x": {"b": [None, True]}, "text_sha256": digest("wide letters and\nline ends")}
    assert second["text"] == second["body"] == "under another name, of some length" and second["text_sha256"] == "kept"
    assert third == {"text": None, "source": "s"}


def test_fields_that_steps_add(release):
    (row,) = release([{"prompt": "Why is the sky of this planet blue?", "response": "First, because of scattering. " * 4, "source_row_hash": 77, "source": "s"}], "midtrain", "reasoning")
    assert row["lineage_hash"] == "77" and row["problem"] == row["prompt"] and row["reasoning"].startswith("First, because of scattering. First")
    kept, dropped = release([{"text": "def f():\r\n    return 1\n", "path": "lib/mod.py", "meta": {"source": "zip", "blob_id": "own"}}, {"text": "x = 1\n", "path": "vendor/mod.py"}], "pretrain", "code", "gharchive")
    assert kept["text"] == "def f():\nreturn 1" and kept["language"] == "Python" and kept["source"] == "zip"
    assert kept["metadata"] == {"source": "zip", "blob_id": "own", "path": "lib/mod.py", "language": "Python"} and "metadata" not in dropped
    (page,) = release([{"text": "a page of some length that was read", "url": "u", "lid_score": 0.99, "minhash_count": 0, "primary_score": 0.9, "source": "s"}], "pretrain", "pdf_ocr", "finepdfs")
    assert page["finepdfs_dedup_key"] == "provenance:u\x1f\x1f\x1f"
    (web,) = release([{"text": "a page of some length that was read", "quality_mean": "3.5", "source": "s"}], "midtrain", "web", "web_knowledge")
    assert (web["quality_mean"], web["quality_band"], web["quality_missing"]) == (3.5, "ge3", False)
    (math,) = release([{"question": "What is 1 + 1 then?", "solution": "Therefore the final answer is 2, as is known.", "meta": {"source_rel": "f", "row_index": 3}}], "midtrain", "math", "nemotron_math")
    assert math["nemotron_math_drop_key"] == ["f", 3]


def test_traces(release):
    long = "".join(f"step {i} of the trace\n" for i in range(4000))
    plain, packed = release([{"text": "user: do it\r\nassistant: done and submitted", "metadata": {"source_id": "b", "source_ids": ["a", "b"]}}, {"text": long, "sample_type": "agent_coding_same_repo_multiissue_pack", "completion_status": "passed"}], "midtrain", "agentic", "agent_coding")
    text = "user: do it\nassistant: done and submitted"
    assert plain["source_trace_keys"] == ["a", "b"] and plain["dedup_priority"] == 1 and plain["text_chars"] == len(text) and plain["completion_status"] == "completed_success"
    assert plain["dedup_text_sha256"] == plain["near_dedup_sample_sha256"] == hashlib.sha256(text.encode()).hexdigest() and plain["pre_rendered_agent_trace"] is True
    text = long.strip()
    middle = len(text) // 2 - 6000
    sampled = "\n".join([text[:12000], text[middle : middle + 12000], text[-12000:]])
    assert packed["dedup_priority"] == 0 and packed["near_dedup_sample_sha256"] == hashlib.sha256(sampled.encode()).hexdigest() and packed["completion_status"] == "passed"


def test_conversations(release):
    (row,) = release([{"messages": [{"role": "Human", "content": "a question of some length"}, {"role": "gpt", "content": "<think>so</think> an answer"}], "source": "s"}], "posttrain", "instruction")
    assert row["messages"] == [{"role": "user", "content": "a question of some length"}, {"role": "assistant", "content": "an answer", "reasoning_content": "so"}]
    source = "saumyamalik/OpenThoughts3-full-filtered-science-decontam-v2"
    (row,) = release([{"dataset_source": source, "messages": [{"role": "user", "content": "why then"}, {"role": "assistant", "content": "<think>a b</think>c"}]}], "posttrain", "instruction", "dolci_think")
    assert (row["ability"], row["think_mode"], row["source_key"]) == ("science_reasoning", "think", "openthoughts_science")
    assert row["metadata"] == {"rough_render_tokens": 9, "source_label": "openthoughts_science"} and row["messages"][1] == {"role": "assistant", "content": "c", "reasoning_content": "a b"}
    tool = {"name": "weather", "parameters": {}}
    (row,) = release([{"messages": [{"role": "system", "functions": json.dumps([tool])}, {"role": "user", "content": "rain?"}, {"role": "assistant", "function_calls": 'weather(place="B)", days=2)'}, {"role": "environment", "content": "no"}, {"role": "assistant", "content": "No rain."}]}], "posttrain", "agentic", "dolci_tooluse")
    assert row["tools"] == [{"type": "function", "function": tool}] and row["tool_schema_format"] == "native_tools_v1"
    assert json.loads(json.dumps(row["messages"][1]["tool_calls"]))[0]["name"] == "weather" and row["messages"][2]["role"] == "tool"


def test_calls_in_text():
    assert calls_in("f(a=\"x)(\", b='y\\'')\ng(1, h(2))k(3)\n plain ) z(4)") == ["f(a=\"x)(\", b='y\\'')", "g(1, h(2))", "k(3)", "plain ) z(4)"]
    assert calls_in("f(\n1)\n\ng('open") == ["f(\n1)", "g('open"] and calls_in("") == []


def test_partition_depends_on_the_seed(spark):
    rows = spark.range(50).select("id", tx.stable_partition(F.col("id"), 7).alias("a"), tx.stable_partition(F.col("id"), 7, "other").alias("b")).collect()
    expected = lambda seed, i: int.from_bytes(hashlib.blake2b(f"{seed}\0{i}".encode(), digest_size=8).digest(), "big") % 7
    assert all(r.a == expected("siltstone", r.id) and r.b == expected("other", r.id) for r in rows)
