"""The shared and the category steps."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltstone.functions.text import casefold, line_repetition, lines, normalize_text
from siltstone.operators.dedup import exact_step, near_step
from siltstone.plans.record import DROP, KEEP, REVIEW, TEXT_OF, State, Step, above, below, no, not_empty, number, present, shown, strict_string, truthy, variant, yes

# Patterns and word lists that decide results.
SECRET = r"(?i)(?:api[_-]?key|secret|password|access[_-]?token)\s*[:=]\s*[\"']?[A-Za-z0-9_\-/.]{12,}"
GENERATED = r"(?i)(?:generated file|do not edit|auto[- ]generated)"
CODE_SIGNAL = r"[{}();]|\b(?:def|class|function|import|package|SELECT|FROM)\b"
DENIED_PARTS = ("node_modules/", "vendor/", ".min.js", ".map")
BOILERPLATE = r"(?i)(cookie policy|accept all cookies|privacy policy|sign in|subscribe now)"
UNKNOWN = r"(?imU)\A\s*(?:unknown|n/?a|i don'?t know|无法回答|不知道)\s*[.!。！]?$"
TEMPLATE = r"(?i)(?:as an ai language model|i cannot assist with|here is the requested response)"
IMAGE = r"(?i)(?:<img|\.(?:png|jpg|jpeg|gif|svg)\b|\\includegraphics|see (?:the )?figure)"
ANSWER_SIGNAL = r"(?i)(?:final answer|answer\s*:|therefore|thus|\\boxed\{|答案|所以)"
CONTROL = r"(?is)<\|(?:system|assistant|user|endoftext)[^>]*\|>|\[system prompt\]|api[_ ]error"
REASONING_SIGNAL = r"(?i)(?:because|therefore|first,|step \d+|we need to|由于|因此|首先|步骤)"
FAILURE_MARKS = ("exit due to", "permission denied", "tool error", "timed out")
SUCCESS_MARKS = ("submitted", "tests passed", "task completed", "success")
LENGTHS = (2048, 8192, 32768, 65536)


def like(text: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_like(text, F.lit(pattern)), no())


# --- shared steps


def normalize_schema_text(s: State) -> None:
    for name in TEXT_OF.get(s.category, ("text",)):
        s.put(f"f_{name}", normalize_text(s.string(name)), F.array_contains(s.get("text_fields"), name))


def validate_basic_integrity(s: State) -> None:
    size = F.length(s.text())
    least, most = int(s.config.get("min_chars", 16)), int(s.config.get("max_chars", 2_000_000))
    s.mark(size == 0, DROP, "empty_training_text")
    s.mark((size > 0) & (size < least), DROP, "too_short")
    s.mark(size.between(max(least, 1), 2**31 - 1) & (size > most), REVIEW, "too_long")


def validate_provenance(s: State) -> None:
    if s.config.get("require_license"):
        none = ~(truthy("$.license") | truthy("$.metadata.license"))
        s.flag(none, "missing_license")
        s.mark(none, REVIEW, "missing_license")
    none = ~(not_empty(s.string("source")) | truthy("$.source") | truthy("$.metadata.source"))
    s.flag(none, "missing_source")
    s.mark(none, REVIEW, "missing_source")


def scan_sensitive_content(s: State) -> None:
    text = s.text()
    secret = like(text, SECRET)
    s.flag(secret, "possible_secret")
    s.mark(secret, REVIEW, "possible_secret")
    terms = [t for t in s.config.get("sensitive_terms", ()) if t]
    if terms:
        folded = F.lower(text) if all(t.isascii() for t in terms) else casefold(text)
        hit = reduce(or_, [F.contains(folded, F.lit(t.casefold())) for t in terms])
        s.flag(hit, "sensitive_term")
        s.mark(hit, REVIEW, "sensitive_term")


def apply_quality_policy(s: State) -> None:
    """Scores against the policy of the row's source, else of its category, else the default."""
    policies = s.config.get("quality_policies") or {}
    key = F.coalesce(shown("$.source_key"), F.when(not_empty(s.string("source")), s.string("source")), shown("$.source"), F.when(F.col("dataset") != "", F.col("dataset")), F.lit(s.category))
    fallback = policies.get(s.category) or policies.get("default")
    cases = [(key == k, p) for k, p in policies.items() if p] + ([(yes(), fallback)] if fallback else [])
    before = no()
    for when, policy in cases:
        own, before = when & ~before, before | when
        score = F.coalesce(F.col("score"), number(f"$.{policy.get('score_field') or 'quality_score'}")) if s.config.get("_has_score") else number(f"$.{policy.get('score_field') or 'quality_score'}")
        if policy.get("require_score"):
            s.flag(own & score.isNull(), "missing_quality_score")
            s.mark(own & score.isNull(), REVIEW, "missing_quality_score")
        s.metric("quality_score", score, own)
        low = below(score, float(policy["review_min"])) if policy.get("review_min") is not None else no()
        s.mark(own & low, DROP, "quality_score_below_drop_threshold")
        if policy.get("keep_min") is not None:
            s.mark(own & ~low & below(score, float(policy["keep_min"])), REVIEW, "quality_score_below_keep_threshold")
        if policy.get("hard_error_field") and policy.get("hard_error_max") is not None:
            error = number(f"$.{policy['hard_error_field']}")
            s.metric("hard_error_score", error, own)
            s.mark(own & above(error, float(policy["hard_error_max"])), DROP, "hard_error_score_exceeded")


def boundaries(values: object) -> tuple[int, ...]:
    """Positive, different and in order; the defaults where nothing usable is given."""
    try:
        return tuple(sorted({int(v) for v in values if int(v) > 0})) or LENGTHS  # type: ignore[union-attr]
    except (TypeError, ValueError):
        return LENGTHS


def length_label(tokens: Column, limits: tuple[int, ...]) -> Column:
    label, lower = F, 0
    for upper in limits:
        label = label.when(tokens <= upper, F.lit(f"{lower + 1}_{upper}"))
        lower = upper
    return label.otherwise(F.lit(f"gt_{lower}"))


def token_estimate(text: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(F.length(text) / 4)).cast("long")


def estimate_tokens_and_length_bucket(s: State) -> None:
    estimator = s.config.get("token_estimator")
    tokens = F.greatest(F.lit(1), (estimator or token_estimate)(s.text()).cast("long"))
    s.metric("estimated_tokens", tokens)
    s.bucket("length", length_label(tokens, boundaries(s.config.get("length_buckets", LENGTHS))))


def finalize_quality_bucket(s: State) -> None:
    s.bucket("quality", F.when(F.col("rank") == KEEP, "main").otherwise("review"), default=True)


# --- code


def normalize_code_schema(s: State) -> None:
    move = present("$.content") & ~present("$.text") | s.string("text").isNull() & s.string("content").isNotNull()
    s.put("f_text", s.string("content"), move)
    s.put("text_fields", F.transform("text_fields", lambda x: F.when(x == "content", "text").otherwise(x)), move)
    s.bucket("subtype", F.coalesce(shown("$.subtype"), F.lit("code")), default=True)


def classify_code_language(s: State) -> None:
    s.bucket("language", F.coalesce(F.when(not_empty(s.string("language")), s.string("language")), shown("$.language"), shown("$.metadata.language"), F.lit("unknown")))


def filter_non_source_assets(s: State) -> None:
    path = F.lower(F.coalesce(F.when(not_empty(s.string("path")), s.string("path")), shown("$.path"), shown("$.file_path"), F.lit("")))
    parts = [str(p).casefold() for p in s.config.get("code_denied_path_parts", DENIED_PARTS)]
    denied = (path != "") & F.exists(F.array(*map(F.lit, parts)), lambda p: F.contains(path, p)) if parts else no()
    s.mark(denied, DROP, "non_core_or_vendored_file")
    s.mark(~denied & like(F.substring(s.text(), 1, 4096), GENERATED), REVIEW, "possibly_generated_code")


def line_count(text: Column) -> Column:
    """Lines of a text, of which a last empty one doesn't count; 0 for an empty text."""
    return F.when(F.length(text) == 0, 0).otherwise(F.size(lines(F.regexp_replace(text, r"(\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}])", "\n"))) - F.when(F.regexp_like(text, F.lit(r"[\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]\z")), 1).otherwise(0))


def validate_code_signal(s: State) -> None:
    text = s.text()
    s.mark(~like(text, CODE_SIGNAL) & (line_count(text) < 3), REVIEW, "weak_code_signal")
    fim = present("$.prefix") | present("$.middle") | present("$.suffix")
    whole = not_empty(strict_string("$.prefix")) & not_empty(strict_string("$.middle")) & not_empty(strict_string("$.suffix"))
    s.mark(fim & ~whole, DROP, "incomplete_fim_triplet")
    s.bucket("subtype", F.lit("fim"), F.coalesce(fim, no()))


def bucket_code_task(s: State) -> None:
    patch = truthy("$.patch") | truthy("$.diff")
    asked = (not_empty(s.string("prompt")) | truthy("$.prompt")) & truthy("$.completion")
    s.bucket("subtype", F.when(patch, "patch").otherwise("code_qa"), patch | asked)
    s.bucket("verified", F.when(truthy("$.verified") | truthy("$.tests_passed"), "verified").otherwise("unverified"))


# --- web


def normalize_web_schema(s: State) -> None:
    both = s.string("question").isNotNull() & s.string("answer").isNotNull()
    s.text_fields("question", "answer", when=both)
    s.bucket("subtype", F.when(both, "web_qa").otherwise(F.coalesce(s.get("b_subtype"), F.lit("web_text"))))


def filter_web_boilerplate(s: State) -> None:
    text = s.text()
    s.mark(F.regexp_count(text, F.lit(BOILERPLATE)) >= int(s.config.get("web_boilerplate_limit", 4)), REVIEW, "web_boilerplate")
    s.mark(below(line_repetition(text), 0.45), DROP, "repetitive_web_text")


def validate_web_qa(s: State) -> None:
    qa = F.col("b_subtype") == "web_qa"
    question, answer = F.coalesce(s.string("question"), F.lit("")), F.coalesce(s.string("answer"), F.lit(""))
    incomplete = (F.length(question) < 4) | (answer == "")
    s.mark(qa & incomplete, DROP, "incomplete_qa_pair")
    s.mark(qa & ~incomplete & like(answer, UNKNOWN), DROP, "unknown_answer")
    s.mark(qa & is_bool("$.grounded", False), REVIEW, "ungrounded_answer")


def is_bool(path: str, value: bool) -> Column:
    return F.coalesce((F.schema_of_variant(variant(path, "variant")) == "BOOLEAN") & (variant(path, "boolean") == value), no())


def bucket_web(s: State) -> None:
    s.bucket("topic", F.coalesce(shown("$.topic_top1"), shown("$.topic"), F.lit("unknown")))
    kind = F.schema_of_variant(variant("$.quality_score", "variant"))
    score = F.when(kind != "STRING", number("$.quality_score", booleans=True))
    s.bucket("model_quality", F.when(above(score, 0.8, True), "high").when(above(score, 0.5, True), "medium").otherwise("low"), score.isNotNull())


# --- agentic


def flattened(messages: Column) -> Column:
    """Messages with text as lines of role and content; null if there are none."""
    told = F.filter(messages, lambda m: m["is_text"] & (m["content"] != ""))
    line = lambda m: F.concat(F.when(not_empty(m["role"]), m["role"]).otherwise("unknown"), F.lit(": "), m["content"])
    return F.when(F.size(told) > 0, F.array_join(F.transform(told, line), "\n"))


def all_messages(s: State) -> Column:
    return F.coalesce(s.get("messages"), F.array().cast(s_type()))


def s_type() -> str:
    from siltstone.plans.record import MESSAGE

    return f"array<{MESSAGE}>"


def normalize_agentic_schema(s: State) -> None:
    messages = all_messages(s)
    had_text = s.string("text").isNotNull()
    rendered = flattened(messages)
    s.put("f_text", rendered, ~had_text & rendered.isNotNull())
    s.text_fields("text", when=~had_text & rendered.isNotNull())
    s.mark((F.size(messages) == 0) & had_text & ~s.get("rendered"), REVIEW, "unstructured_agent_trace")
    s.metric("turns", F.size(messages))
    s.bucket("subtype", F.coalesce(shown("$.sample_type"), F.lit("trajectory")))


def role_of(m: Column) -> Column:
    return F.coalesce(m["role"], F.lit(""))


def validate_role_order(s: State) -> None:
    roles = F.transform(all_messages(s), role_of)
    some = F.size(roles) > 0
    s.mark(some & ~F.try_element_at(roles, F.lit(1)).isin("system", "user"), REVIEW, "invalid_first_role")
    s.mark(some & F.array_contains(roles, ""), DROP, "missing_message_role")


def validate_tool_call_pairs(s: State) -> None:
    messages = all_messages(s)
    s.stop(s.get("rendered"))
    called = lambda m: F.coalesce(m["tool_calls"].isNotNull() | role_of(m).isin("assistant_tool", "tool_call"), no())
    seen = lambda m: role_of(m).isin("tool", "tool_response", "observation")
    step = lambda open_, m: F.when(seen(m), F.greatest(F.lit(0), open_ + called(m).cast("int") - 1)).otherwise(open_ + called(m).cast("int"))
    calls = F.size(F.filter(messages, called))
    s.metric("tool_calls", calls)
    s.metric("tool_observations", F.size(F.filter(messages, seen)))
    s.mark(calls == 0, REVIEW, "no_tool_call")
    s.mark((calls > 0) & (F.aggregate(messages, F.lit(0), step) > 0), REVIEW, "unpaired_tool_call")


def detect_trajectory_outcome(s: State) -> None:
    text = F.lower(s.text())
    failed = reduce(or_, [F.contains(text, F.lit(m)) for m in FAILURE_MARKS])
    verified = truthy("$.verified") | truthy("$.tests_passed") | reduce(or_, [F.contains(text, F.lit(m)) for m in SUCCESS_MARKS])
    s.bucket("outcome", F.when(verified, "verified").when(failed, "failed").otherwise("weak"))
    s.mark(failed & ~verified, REVIEW, "failed_or_environment_trajectory")


def bucket_agentic(s: State) -> None:
    names = F.coalesce(F.when(truthy("$.tool_names"), variant("$.tool_names", "array<string>")), F.when(~truthy("$.tool_names"), variant("$.target_tools", "array<string>")))
    some = F.coalesce(F.size(names) > 0, no())
    s.bucket("tool_family", F.when(some, F.array_join(F.array_sort(F.array_distinct(names)), ",")).otherwise(F.coalesce(s.get("b_tool_family"), F.lit("unknown"))))


# --- instruction


def normalize_instruction_schema(s: State) -> None:
    for old, new in (("instruction", "prompt"), ("output", "response")):
        s.put(f"f_{new}", s.string(old), s.string(new).isNull() & ~present(f"$.{new}"))
    pair = s.string("prompt").isNotNull() & s.string("response").isNotNull()
    s.text_fields("prompt", "response", when=pair)
    rendered = flattened(all_messages(s))
    s.put("f_text", rendered, ~pair & rendered.isNotNull())
    s.text_fields("text", when=~pair & rendered.isNotNull())


def validate_instruction_pair(s: State) -> None:
    listed = F.size(all_messages(s)) > 0
    roles = F.transform(all_messages(s), role_of)
    s.mark(listed & ~(F.array_contains(roles, "user") & F.array_contains(roles, "assistant")), DROP, "incomplete_instruction_messages")
    s.stop(listed)
    prompt, response = F.coalesce(s.string("prompt"), F.lit("")), F.coalesce(s.string("response"), F.lit(""))
    missing = (prompt == "") | (response == "")
    s.mark(missing, DROP, "incomplete_instruction_pair")
    s.mark(~missing & (casefold(prompt) == casefold(response)), DROP, "prompt_response_identical")


def filter_instruction_templates(s: State) -> None:
    s.mark(like(s.string("response"), TEMPLATE), REVIEW, "generic_model_template")


def bucket_instruction(s: State) -> None:
    s.bucket("task", F.coalesce(shown("$.task"), shown("$.category"), F.lit("general")))
    s.bucket("risk", F.coalesce(shown("$.risk_category"), F.lit("normal")))
    s.bucket("turns", F.when(F.size(all_messages(s)) > 2, "multi").otherwise("single"))


# --- math


def normalize_math_schema(s: State) -> None:
    for old, new in (("problem", "question"), ("response", "solution")):
        s.put(f"f_{new}", s.string(old), s.string(new).isNull() & ~present(f"$.{new}"))
    s.text_fields("question", "solution", when=s.string("question").isNotNull() & s.string("solution").isNotNull())


def validate_problem_solution(s: State) -> None:
    question, solution = F.coalesce(s.string("question"), F.lit("")), F.coalesce(s.string("solution"), F.lit(""))
    missing = (question == "") | (solution == "")
    s.mark(missing, DROP, "missing_problem_or_solution")
    s.mark(~missing & like(F.concat(question, F.lit("\n"), solution), IMAGE) & ~truthy("$.image_text"), REVIEW, "missing_multimodal_context")


def validate_math_answer_signal(s: State) -> None:
    solution = F.coalesce(s.string("solution"), F.lit(""))
    s.mark(F.length(solution) < 32, REVIEW, "solution_too_short")
    s.mark(~like(solution, ANSWER_SIGNAL) & ~truthy("$.answer"), REVIEW, "missing_final_answer_signal")
    failed = is_bool("$.verified", False)
    s.bucket("verified", F.when(is_bool("$.verified", True), "verified").when(failed, "failed").otherwise("unknown"))
    s.mark(failed, REVIEW, "verifier_failed")


def bucket_math(s: State) -> None:
    s.bucket("form", F.coalesce(shown("$.form"), F.when(truthy("$.chapter"), "textbook").otherwise("qa")))
    s.bucket("difficulty", F.coalesce(shown("$.difficulty"), F.lit("unknown")))
    s.bucket("domain", F.coalesce(shown("$.domain"), shown("$.subject"), F.lit("math")))


# --- reasoning


def normalize_reasoning_schema(s: State) -> None:
    for old, new in (("prompt", "problem"), ("response", "reasoning")):
        s.put(f"f_{new}", s.string(old), s.string(new).isNull() & ~present(f"$.{new}"))
    both = s.string("problem").isNotNull() & s.string("reasoning").isNotNull()
    final = s.string("final_answer").isNotNull()
    s.text_fields("problem", "reasoning", when=both & ~final)
    s.text_fields("problem", "reasoning", "final_answer", when=both & final)


def detect_control_artifacts(s: State) -> None:
    s.mark(like(s.text(), CONTROL), REVIEW, "control_or_prompt_artifact")


def validate_reasoning_signal(s: State) -> None:
    reasoning = F.coalesce(s.string("reasoning"), F.lit(""))
    s.mark(reasoning == "", DROP, "missing_reasoning")
    s.mark((reasoning != "") & ((F.length(reasoning) < 64) | ~like(reasoning, REASONING_SIGNAL)), REVIEW, "weak_reasoning_signal")
    s.mark(~truthy("$.final_answer") & ~truthy("$.answer"), REVIEW, "missing_final_answer")


def bucket_reasoning(s: State) -> None:
    s.bucket("origin", F.when(truthy("$.teacher_model"), "teacher_rewrite").otherwise(F.coalesce(shown("$.origin"), F.lit("raw"))))
    s.bucket("domain", F.coalesce(shown("$.domain"), shown("$.source_group"), F.lit("general")))
    s.bucket("verified", F.when(truthy("$.verified"), "verified").otherwise("unverified"))
    s.write("lineage_hash", shown("$.source_row_hash"), how="default")


# --- scanned pages and general text


def _first_text(s: State, names: tuple[str, ...], family: str, reason: str) -> None:
    s.put("f_text", F.coalesce(*[s.string(n) for n in names]), s.string("text").isNull() & ~present("$.text"))
    s.text_fields("text")
    s.bucket("source_family", F.lit(family))
    s.mark(~not_empty(s.string("text")), DROP, reason)


def normalize_pdf_ocr(s: State) -> None:
    _first_text(s, ("content", "ocr_text", "document"), "pdf_ocr", "missing_extracted_text")


def filter_pdf_ocr_quality(s: State) -> None:
    s.mark(F.length(s.text()) < int(s.config.get("pdf_min_chars", 32)), REVIEW, "short_ocr_text")
    s.mark(below(number("$.ocr_quality", booleans=True), float(s.config.get("pdf_min_ocr_quality", 0.0))), REVIEW, "low_ocr_quality")


def normalize_general_text(s: State) -> None:
    _first_text(s, ("content", "document", "body", "raw_text"), "general_text", "missing_text")


def step(describe, *before) -> Step:
    return Step(describe.__name__, describe, None, before)


PREFIX = [step(f) for f in (normalize_schema_text, validate_basic_integrity, validate_provenance, scan_sensitive_content)]
SUFFIX = [
    step(apply_quality_policy),
    Step("exact_deduplicate", lambda s: None, exact_step),
    Step("near_deduplicate", lambda s: None, near_step),
    step(estimate_tokens_and_length_bucket),
    step(finalize_quality_bucket),
]
BY_CATEGORY = {
    "code": [step(f) for f in (normalize_code_schema, classify_code_language, filter_non_source_assets, validate_code_signal, bucket_code_task)],
    "web": [step(f) for f in (normalize_web_schema, filter_web_boilerplate, validate_web_qa, bucket_web)],
    "instruction": [step(f) for f in (normalize_instruction_schema, validate_instruction_pair, filter_instruction_templates, bucket_instruction)],
    "agentic": [step(f) for f in (normalize_agentic_schema, validate_role_order, validate_tool_call_pairs, detect_trajectory_outcome, bucket_agentic)],
    "math": [step(f) for f in (normalize_math_schema, validate_problem_solution, validate_math_answer_signal, bucket_math)],
    "reasoning": [step(f) for f in (normalize_reasoning_schema, detect_control_artifacts, validate_reasoning_signal, bucket_reasoning)],
    "pdf_ocr": [],
    "general_text": [],
}
