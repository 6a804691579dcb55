"""The nine dataset profiles, hand-computed."""

import json

from siltstone.operators import profiles

CODE = "def add(a, b):\n    return a + b\n"


def reasons(rows):
    return [(r["decision"], r["reasons"]) for r in rows]


def test_source_files(clean):
    book = json.dumps({"cells": [{"cell_type": "code", "source": ["import os\n", "x = 1"]}, {"cell_type": "markdown", "source": "text; more (x)"}, {"source": " "}]})
    rows = [
        {"text": CODE, "path": "src/a.py", "source": "s"},
        {"text": CODE, "path": "vendor/a.py", "source": "s"},
        {"text": CODE, "path": "src/build", "source": "s"},
        {"text": CODE, "path": "x/yarn.lock"},
        {"text": CODE, "path": "x/a.png"},
        {"text": CODE, "path": "x/fixtures/a.py"},
        {"text": CODE, "path": "x/.hidden"},
        {"text": "// Code generated by tool\n" + CODE, "path": "x/a.go"},
        {"text": "x" * 12_000, "path": "x/a.js"},
        {"text": book, "path": "n/a.ipynb"},
        {"path": "x/a.py"},
        {"text": CODE + "#", "path": "a/Dockerfile", "source": "s"},
        {"text": CODE + "##", "path": "a/lib.min.js"},
    ]
    out = clean(rows, "pretrain", "code", "gharchive")
    assert out[0]["decision"] == "keep" and out[0]["buckets"]["language"] == "Python"
    names = [r["reasons"][0].removeprefix("gharchive_") if r["reasons"] else "" for r in out]
    assert names[1:9] == ["vendor_or_build_path", "vendor_or_build_path", "lockfile", "binary_extension", "fixture_or_snapshot", "unsupported_file_type", "generated_file", "minified_or_long_line"]
    assert out[9]["text"] == "# code cell\nimport os\nx = 1\n\n<!-- markdown cell -->\ntext; more (x)" and out[9]["buckets"]["language"] == "Notebook"
    assert names[10] == "missing_text" and out[11]["buckets"]["language"] == "Dockerfile" and names[12] == "minified_asset"


def test_scored_pages(clean):
    text = "a page of text that is long enough for the checks "
    rows = [
        {"id": 1, "source": "s", "text": text + "1", "lid_score": 0.97, "minhash_count": 2, "primary_score": 0.81},
        {"id": 2, "source": "s", "text": text + "2", "lid_score": 0.5, "minhash_count": 3, "primary_score": 0.1},
        {"id": 3, "source": "s", "text": text + "3", "lid_score": None, "metadata": {"lid_score": 0.9}, "minhash_count": "1", "primary_score": True},
    ]
    out = clean(rows, "pretrain", "pdf_ocr", "finepdfs")
    assert reasons(out)[0] == ("keep", []) and out[0]["buckets"]["finepdfs_policy"] == "relaxed_lid085_mh2_p08"
    assert out[1]["reasons"] == ["finepdfs_low_language_score", "finepdfs_excessive_minhash_overlap", "finepdfs_low_primary_score"]
    assert out[2]["decision"] == "review" and out[2]["flags"] == ["finepdfs_missing_quality_metric"] and out[2]["metrics"]["finepdfs_primary_score"] == 1.0


def test_compressible_pages(clean):
    out = clean([{"source": "s", "text": "one line again\n" * 700, "edu_score": 0.66}, {"source": "s", "text": "Some words that differ from each other quite well.", "edu_score": "x"}, {"text": " "}], "pretrain", "pdf_ocr", "olmocr")
    assert out[0]["reasons"] == ["olmocr_low_compression_ratio"] and out[1]["reasons"] == ["olmocr_invalid_edu_score"] and out[2]["reasons"] == ["olmocr_missing_text"]


def test_scored_web(clean):
    rows = [{"source": "s", "text": "a web page with enough text", "quality_mean": 4.6, "token_count": 31_000}, {"source": "s", "text": "another web page with text", "metadata": {"quality_mean": "1.7"}, "token_count": 0}]
    out = clean(rows, "midtrain", "web", "web_knowledge", web_knowledge_min_quality_band="ge3")
    assert out[0]["decision"] == "keep" and out[0]["buckets"]["classifier_quality"] == "ge4" and out[0]["buckets"]["source_length"] == "gt_16k_le_64k"
    assert out[1]["reasons"] == ["web_knowledge_missing_token_count", "web_knowledge_below_quality_band"]


def test_math_errors(clean):
    base = {"source": "s", "question": "What is one and one?", "solution": "It is two. Therefore the final answer: 2"}
    rows = [base | {"hard_error_score": 4}, base | {"metadata": {"source_rel": "f", "row_index": 7}}, base, base | {"error_risk_score": "1", "question": "And two and two?"}, base | {"hard_error_score": "nan", "question": "And three?"}]
    out = clean(rows, "midtrain", "math", "nemotron_math", nemotron_math_drop_keys=["f:7", "bad", ["x", None], {"source_file": "g", "row_index": "1"}])
    assert [r["decision"] for r in out] == ["drop", "drop", "review", "keep", "keep"]
    assert out[0]["buckets"]["hard_error_risk"] == "high" and out[2]["reasons"] == ["nemotron_math_missing_hard_error_signal"]
    assert profiles.drop_keys(["a\t1", ("b", "2"), {"source_rel": "c", "file_row_index": 3}, 5, "d:x"]) == {("a", 1), ("b", 2), ("c", 3)}


def test_coding_trace(clean):
    rows = [{"source": "s", "sample_type": "t", "text": "assistant: all done with the work", "metadata": {"source_ids": ["b"]}}, {"source": "s", "text": " "}, {"source": "s", "text": "assistant: nearly done with work", "completion_status": "failed"}]
    out = clean(rows, "midtrain", "agentic", "agent_coding")
    assert out[0]["decision"] == "keep" and out[0]["buckets"]["source_length"] == "le16k" and out[0]["buckets"]["subtype"] == "t"
    assert out[1]["reasons"] == ["agent_coding_missing_trace_text"] and out[2]["reasons"][0] == "agent_coding_unverified_completion"


def test_thinking(clean):
    source = "saumyamalik/OpenThoughts3-full-filtered-math-decontam-v2"
    user = {"role": "user", "content": "please solve this"}
    told = lambda text: {"dataset_source": source, "messages": [user, {"role": "assistant", "content": text}]}
    rows = [told("<think>first I think</think>The answer is 4"), told("no thought at all here"), told("<think> </think>x"), told("<think>a</think> "), told("<think>a</think>b<think>c</think>d"), told("<think>a <|im_end|></think>fine"), {"dataset_source": "x"}, told("<think>" + "one two three four five " * 40 + "</think>fine")]
    out = clean(rows, "posttrain", "instruction", "dolci_think")
    assert out[0]["decision"] == "keep" and out[0]["messages"][1]["reasoning_content"] == "first I think" and out[0]["messages"][1]["content"] == "The answer is 4"
    assert out[0]["metrics"]["dolci_think_rough_tokens"] == 3 + 3 + 4 + 4
    expected = ["missing_complete_think", "empty_think", "empty_visible_answer", "multiple_think_blocks", "template_token", "not_target_source", "repetition"]
    assert [r["reasons"] for r in out[1:]] == [[f"dolci_think_{e}"] for e in expected]


def test_tool_conversations(clean):
    system = {"role": "system", "content": "You are a helpful function-calling AI assistant.", "functions": json.dumps([{"name": "weather", "parameters": {}}])}
    rows = [
        {"source": "s", "messages": [system, {"role": "user", "content": "how is the weather in Rome?"}, {"role": "assistant", "function_calls": "weather(city='Rome (old)', days=[1, 2])\n"}, {"role": "environment", "content": "sunny"}, {"role": "assistant", "content": "It is sunny."}]},
        {"source": "s", "messages": [system, {"role": "user", "content": "what is it then?"}, {"role": "assistant", "function_calls": "weather city"}]},
        {"source": "s", "messages": [{"role": "user", "content": "hello, a question"}, {"role": "system", "content": "late"}, {"role": "assistant", "content": ""}]},
        {"source": "s", "messages": []},
    ]
    out = clean(rows, "posttrain", "agentic", "dolci_tooluse")
    assert out[0]["decision"] == "keep", out[0]["reasons"]
    assert [m["role"] for m in out[0]["messages"]] == ["system", "user", "assistant", "tool", "assistant"]
    call = json.loads(out[0]["messages"][2]["tool_calls"])[0]
    assert call["name"] == "weather" and call["arguments"] == str({"city": "Rome (old)", "days": [1, 2]})
    assert out[1]["reasons"] == ["dolci_tooluse_conversion_failed"]
    assert out[2]["reasons"][:4] == ["dolci_tooluse_missing_tools", "dolci_tooluse_empty_assistant", "dolci_tooluse_system_not_first", "dolci_tooluse_invalid_assistant_order"]
    assert out[3]["reasons"] == ["dolci_tooluse_empty_messages"]


def test_calls():
    assert [c["function"]["name"] for c in profiles.parsed_calls("f(x)\ng(y=h(1))")] == ["f", "g"]
    assert profiles.parsed_calls("f(x, y={'a': (1, 2)}, *z)")[0]["function"]["arguments"]["y"] == {"a": [1, 2]}
    assert profiles.parsed_calls(" None ") == []


def test_leaked_thoughts(clean):
    rows = [
        {"source": "s", "messages": [{"role": "system", "content": " "}, {"role": "human", "content": "a question of some length"}, {"role": "assistant", "content": "so I think</think>The visible answer", "reasoning_content": "<think>x"}]},
        {"source": "s", "messages": [{"role": "user", "content": "a <|im_start|> question"}, {"role": "assistant", "content": "b"}]},
        {"source": "s", "messages": [{"role": "user", "content": "a question"}, {"role": "assistant", "content": "<think></think>"}]},
        {"source": "s", "messages": "none"},
    ]
    out = clean(rows, "posttrain", "instruction", "ultradata")
    assert out[0]["decision"] == "keep", out[0]["reasons"]
    assert [(m["role"], m["content"]) for m in out[0]["messages"]] == [("user", "a question of some length"), ("assistant", "The visible answer")]
    assert out[0]["flags"] == ["ultradata_removed_empty_system", "ultradata_repaired_visible_think_leak", "ultradata_stripped_reasoning_content_tag"]
    assert [r["reasons"][0] for r in out[1:]] == ["ultradata_foreign_chat_template_token", "ultradata_empty_after_think_repair", "ultradata_bad_messages"]


def test_messages_and_calls(clean):
    rows = [{"source": "s", "messages": [{"role": "Human", "content": 5}, {"role": "gpt", "content": "<think>one</think>two<THINK>x</think>", "tool_calls": [{"function": {"name": "f", "arguments": {"a": 1}}}]}, 7, {"content": "x"}]}]
    (out,) = clean(rows, "posttrain", "instruction")
    assert [(m["role"], m["content"]) for m in out["messages"]] == [("user", "5"), ("assistant", "two"), ("unknown", "x")]
    assert out["messages"][1]["reasoning_content"] == "one" and json.loads(out["messages"][1]["tool_calls"])[0]["arguments"] == "{'a': 1}"
    assert out["metrics"]["turns"] == 3.0
