"""One record through each category, hand-computed."""

CODE = "def add(a, b):\n    return a + b\n\nclass Thing:\n    pass\n"


def one(clean, row, *args, **config):
    return clean([row], *args, **config)[0]


def test_code_text_and_content(clean):
    kept, moved = clean([{"text": CODE, "language": "python", "source": "s"}, {"content": CODE + "x = 1", "source": "s"}], None, "code")
    assert kept["decision"] == "keep" and kept["buckets"]["language"] == "python" and kept["buckets"]["length"] == "1_2048"
    assert moved["decision"] == "keep" and moved["text"].startswith("def add") and moved["buckets"]["subtype"] == "code"


def test_code_vendor_generated_fim(clean):
    rows = [
        {"text": CODE, "source": "s", "path": "Vendor/x.py"},
        {"text": CODE + "1", "source": "s", "path": "lib/x.mapper.py"},
        {"text": "# DO NOT EDIT\n" + CODE, "source": "s"},
        {"text": CODE + "2", "source": "s", "prefix": "a", "middle": None, "suffix": "b"},
        {"text": CODE + "3", "source": "s", "prefix": "a", "middle": "m", "suffix": "b", "tests_passed": 1},
        {"text": "plain words without any signal", "source": "s", "patch": "x"},
    ]
    vendor, mapper, generated, broken, fim, weak = clean(rows, None, "code")
    assert vendor["reasons"] == ["non_core_or_vendored_file"] and vendor["decision"] == "drop" and "quality" not in vendor["buckets"]
    assert mapper["decision"] == "drop"
    assert generated["decision"] == "review" and generated["reasons"] == ["possibly_generated_code"]
    assert broken["reasons"] == ["incomplete_fim_triplet"]
    assert fim["decision"] == "keep" and fim["buckets"]["subtype"] == "fim" and fim["buckets"]["verified"] == "verified"
    assert weak["reasons"] == ["weak_code_signal"] and weak["buckets"]["subtype"] == "patch"


def test_web(clean):
    rows = [
        {"question": "What is it that it does?", "answer": "Unknown", "source": "s"},
        {"question": "What is it that it does?", "answer": "It counts the rows.", "source": "s", "grounded": False, "quality_score": 0.8},
        {"text": "same line here\n" * 10, "source": "s"},
        {"text": "sign in now, sign in here, subscribe now, cookie policy and more", "source": "s", "quality_score": True},
        {"question": "abc", "answer": "a long enough answer", "source": "s"},
    ]
    unknown, ungrounded, same, boiler, short = clean(rows, None, "web")
    assert unknown["decision"] == "drop" and unknown["reasons"] == ["unknown_answer"]
    assert ungrounded["decision"] == "review" and ungrounded["reasons"] == ["ungrounded_answer"] and ungrounded["buckets"]["model_quality"] == "high"
    assert same["reasons"] == ["repetitive_web_text"]
    assert boiler["reasons"] == ["web_boilerplate"] and boiler["buckets"]["model_quality"] == "high" and boiler["buckets"]["subtype"] == "web_text"
    assert short["reasons"] == ["incomplete_qa_pair"]


def test_agentic(clean):
    rows = [
        {"text": "user: run it\nassistant: the tests passed", "messages": [{"role": "user", "content": "run"}, {"role": "assistant", "content": "", "tool_calls": [{"name": "t"}]}, {"role": "tool", "content": "ok"}], "source": "s"},
        {"messages": [{"role": "assistant", "content": "hello there, I start"}, {"role": "", "content": "x"}], "source": "s"},
        {"text": "an agent trace as plain text only", "source": "s"},
        {"messages": [{"role": "user", "content": "please do run the tool"}, {"role": "tool", "content": "too early"}, {"role": "assistant", "content": "call", "tool_calls": [1]}], "source": "s", "tool_names": ["b", "a", "b"]},
    ]
    good, bad, bare, open_ = clean(rows, None, "agentic")
    assert good["decision"] == "keep" and good["buckets"]["outcome"] == "verified" and good["metrics"]["tool_calls"] == 1.0
    assert bad["decision"] == "drop" and bad["reasons"] == ["invalid_first_role", "missing_message_role"] and bad["text"].startswith("assistant: hello")
    assert bare["reasons"] == ["unstructured_agent_trace", "no_tool_call"]
    assert open_["reasons"] == ["unpaired_tool_call"] and open_["buckets"]["tool_family"] == "a,b"


def test_instruction(clean):
    rows = [
        {"instruction": "Say something long enough", "output": "", "source": "s"},
        {"instruction": "The very same STRASSE", "output": "the very same straße", "source": "s"},
        {"prompt": "Tell me all of it now", "response": "As an AI language model, I would", "source": "s"},
        {"messages": [{"role": "user", "content": "a longer question"}, {"role": "system", "content": "x"}], "source": "s"},
    ]
    empty, same, template, roles = clean(rows, None, "instruction")
    assert empty["reasons"] == ["incomplete_instruction_pair"]
    assert same["reasons"] == ["prompt_response_identical"]
    assert template["reasons"] == ["generic_model_template"] and template["buckets"]["turns"] == "single"
    assert roles["reasons"] == ["incomplete_instruction_messages"]


def test_math_and_reasoning(clean):
    figure, failed = clean(
        [{"problem": "Look: see the figure and solve", "response": "It is easy. Therefore the answer is 4, as shown above.", "source": "s"}, {"question": "What is two and two?", "solution": "4 is what comes out here, and more words", "verified": False, "source": "s"}],
        None, "math",
    )
    assert figure["decision"] == "review" and figure["reasons"] == ["missing_multimodal_context"]
    assert failed["reasons"] == ["missing_final_answer_signal", "verifier_failed"] and failed["buckets"]["verified"] == "failed"
    ok, weak = clean(
        [{"prompt": "Why?", "response": "Because of many reasons, first, we need to look at all of them with care.", "final_answer": "so", "source_row_hash": "h", "source": "s"}, {"problem": "Why is it so then", "reasoning": "no", "source": "s"}],
        None, "reasoning",
    )
    assert ok["decision"] == "keep" and ok["text"].endswith("\nso")
    assert weak["reasons"] == ["weak_reasoning_signal", "missing_final_answer"]


def test_shared_steps(clean):
    rows = [
        {"text": "A line that is\tlong   enough for it ", "source": "one"},
        {"text": "a LINE that is long enough for it", "source": "two"},
        {"text": "short", "source": "s"},
        {"text": "", "source": "s"},
        {"text": "api_key = 'abcdefghijklmnop' in the text", "source": "s"},
        {"text": "no source but long enough text"},
        {"text": "this one talks of Straße 9 as a term", "source": "s", "id": 0},
        {"text": 5, "content": "content is used only without text", "source": "s"},
    ]
    out = clean(rows, "pretrain", "general_text", sensitive_terms=["STRASSE"])
    assert out[0]["text"] == "A line that is long enough for it" and out[0]["decision"] == "keep" and out[0]["buckets"]["quality"] == "main"
    assert out[1]["decision"] == "drop" and out[1]["reasons"] == ["exact_duplicate"] and out[1]["text_sha256"] == out[0]["text_sha256"]
    assert out[2]["reasons"] == ["too_short"] and out[3]["reasons"] == ["missing_text"]
    assert out[4]["flags"] == ["possible_secret"] and out[4]["decision"] == "review"
    assert out[5]["reasons"] == ["missing_source"]
    assert out[6]["source_id"] == "d:6"
    assert out[7]["reasons"] == ["missing_text"]


def test_long_folding_term(clean):
    out = clean([{"text": "this one talks of Straße 9 as a term", "source": "s"}], "pretrain", "general_text", sensitive_terms=["straße"])
    assert out[0]["flags"] == ["sensitive_term"]


def test_quality_policy(clean):
    rows = [{"text": "a text that is long enough, number %d" % i, "source": "s", "quality_mean": q} for i, q in enumerate([2.5, 3.5, 4.5, "3_0", True, None])]
    rows.append({"text": "a text that is long enough, but other", "source": "t", "quality_score": 0.1})
    policy = {"s": {"score_field": "quality_mean", "keep_min": 4, "review_min": 3, "require_score": True}, "default": {"keep_min": 0.5}}
    out = [r["decision"] + ":" + ",".join(r["reasons"]) for r in clean(rows, "pretrain", "general_text", quality_policies=policy)]
    low, keep = "quality_score_below_drop_threshold", "quality_score_below_keep_threshold"
    assert out == [f"drop:{low}", f"review:{keep}", "keep:", "keep:", "review:missing_quality_score", "review:missing_quality_score", f"review:{keep}"]


def test_near_duplicates_count_even_if_dropped(clean):
    base = "word " * 3 + " ".join(f"token{i}" for i in range(200))
    rows = [{"text": base, "source": "s"}, {"text": base.replace("token150", "other"), "source": "s"}, {"text": "something entirely different from that " * 2, "source": "s"}]
    out = clean(rows, "pretrain", "general_text", near_dedup=True, near_dedup_threshold=15, near_dedup_bands=16)
    assert [r["decision"] for r in out] == ["keep", "drop", "keep"] and out[1]["reasons"] == ["near_duplicate"]
