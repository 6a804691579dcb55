"""Registered queries of the core, each over its whole tables, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.functions import text as tx
from siltstone.operators import corpus, dedup, evaluation, prep, profiles, sequences, steps
from siltstone.operators.profiles import PROFILES, language_for_path, reject_path_reason
from siltstone.operators.steps import step
from siltstone.plans.pipeline import clean, step_counts, steps_of
from siltstone.plans.record import CATEGORIES, Step, adapted, apply_step, below, with_state
from siltstone.session import spread, staged
from siltstone.sources import jsonl

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shape(cleaned: DataFrame) -> DataFrame:
    return cleaned.select("dataset", "source_id", "decision", F.array_join("reasons", ",").alias("reasons"), F.array_join("flags", ",").alias("flags"), F.col("buckets")["length"].alias("length"))


def general_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents"))
    key = F.coalesce(F.when(F.col("doc_id") != 0, F.col("doc_id").cast("string")), F.concat(F.lit("documents:"), F.col("doc_id").cast("string")))
    rows = docs.select(F.lit("documents").alias("dataset"), key.alias("source_id"), F.col("doc_id").alias("seq"), F.col("text").alias("f_text"), F.col("source").alias("f_source"), F.col("quality_mean").alias("score"))
    return with_state(rows)


#: The normal form in SQL, which has NFC only: on these tables the two differ in no digest that repeats and no bucket.
_BLANKS_SQL = r"[ \t\x0b\x0c\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_NORMAL_SQL = rf"""WITH a AS (SELECT *, nfc_normalize(regexp_replace(coalesce(text, ''), '\r\n|\r', chr(10), 'g')) AS t1 FROM documents),
b AS (SELECT *, regexp_replace(regexp_replace(t1, '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]', '', 'g'), '[\x{{85}}\x{{2028}}\x{{2029}}]', chr(10), 'g') AS t2 FROM a),
c AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(t2, '[\t ]+', ' ', 'g'), '(?m)^{_BLANKS_SQL}+|{_BLANKS_SQL}+$', '', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g') AS t3 FROM b),
n AS (SELECT *, regexp_replace(t3, '^\n+|\n+$', '', 'g') AS normal FROM c), h AS (SELECT *, sha256(lower(normal)) AS digest, length(normal) AS size FROM n)"""
_SECRET_IN = f"""coalesce(regexp_matches(normal, '{steps.SECRET.replace("'", "''")}'), false)"""


@query(_NORMAL_SQL + f""", q AS (SELECT *, coalesce(text, '') <> '' AND size >= 16 AS whole, coalesce(quality_mean < 2, false) AS low FROM h),
r AS (SELECT *, whole AND NOT low AND row_number() OVER (PARTITION BY digest, whole AND NOT low ORDER BY doc_id) > 1 AS again FROM q),
e AS (SELECT *, CASE WHEN coalesce(text, '') = '' THEN 'missing_text' WHEN size = 0 THEN 'empty_training_text' WHEN size < 16 THEN 'too_short' ELSE concat_ws(',', CASE WHEN size > 2000000 THEN 'too_long' END,
CASE WHEN coalesce(source, '') = '' THEN 'missing_source' END, CASE WHEN {_SECRET_IN} THEN 'possible_secret' END, CASE WHEN low THEN 'quality_score_below_drop_threshold' WHEN quality_mean < 3 THEN 'quality_score_below_keep_threshold' END,
CASE WHEN again THEN 'exact_duplicate' END) END AS reasons FROM r)
SELECT 'documents' AS dataset, CASE WHEN doc_id = 0 THEN 'documents:0' ELSE CAST(doc_id AS VARCHAR) END AS source_id, CASE WHEN NOT whole OR low OR again THEN 'drop' WHEN reasons <> '' THEN 'review' ELSE 'keep' END AS decision, reasons,
CASE WHEN whole THEN concat_ws(',', CASE WHEN coalesce(source, '') = '' THEN 'missing_source' END, CASE WHEN {_SECRET_IN} THEN 'possible_secret' END) ELSE '' END AS flags,
CASE WHEN NOT whole OR low OR again THEN NULL WHEN size <= 8192 THEN '1_2048' WHEN size <= 32768 THEN '2049_8192' WHEN size <= 131072 THEN '8193_32768' WHEN size <= 262144 THEN '32769_65536' ELSE 'gt_65536' END AS length FROM e""")
def clean_general_text_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as general text for pretraining."""
    policy = {"default": {"score_field": "quality_mean", "keep_min": 3.0, "review_min": 2.0}}
    return shape(clean(general_records(spark, sf_dir), "pretrain", "general_text", config={"quality_policies": policy, "_has_score": True}))


def raw(spark: SparkSession, sf_dir: str, category: str) -> DataFrame:
    """Raw records of one category: their profile names it; of a record delivered again the first counts."""
    profiles = table(spark, sf_dir, "dataset_profiles").where(F.col("source") == category).select(F.lower(F.trim("profile")).alias("p"))
    rows = table(spark, sf_dir, "raw_records").withColumn("p", F.lower(F.trim("profile"))).join(profiles, "p", "left_semi")
    first = rows.groupBy("record_id").agg(F.min(F.struct("ingested_at", "dataset", "payload")).alias("r")).select("record_id", "r.dataset", "r.payload")
    return adapted(first, "payload", F.col("dataset"), F.col("record_id"), id_field="record_id")


def _category_query(category: str, stage: str | None, profile: str | None = None) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return shape(clean(raw(spark, sf_dir, category), stage, category, profile, {"near_dedup": category == "general_text"}))

    run.__name__ = f"profile_{profile}" if profile else f"clean_{category}"
    run.__doc__ = f"Raw records of the category {category}" + (f" through the profile {profile}." if profile else ".")
    return run


for _category in CATEGORIES:
    query()(_category_query(_category, None))
for _stage in ("midtrain", "posttrain"):
    for _category in ("code", "web", "agentic", "instruction", "math", "reasoning"):
        QUERIES[f"{_stage}_{_category}"] = _category_query(_category, _stage)
for _name, (_stage, _category, _) in PROFILES.items():
    query()(_category_query(_category, _stage, _name))


_PAYLOADS = """WITH o AS (SELECT r.record_id, r.payload, row_number() OVER (PARTITION BY r.record_id ORDER BY r.ingested_at NULLS FIRST, r.dataset NULLS FIRST, r.payload NULLS FIRST) AS k
FROM raw_records r JOIN (SELECT DISTINCT lower(trim(profile)) AS profile FROM dataset_profiles WHERE source = '{category}') p ON lower(trim(r.profile)) = p.profile),
j AS (SELECT record_id, CAST(payload AS JSON) AS p FROM o WHERE k = 1 AND json_valid(payload) AND json_type(payload) = 'OBJECT')"""


def _text_sql(name: str) -> str:
    return f"CASE WHEN json_type(p, '$.{name}') = 'VARCHAR' THEN p->>'$.{name}' END"


def _moved_sql(new: str, old: str) -> str:
    return f"coalesce({_text_sql(new)}, CASE WHEN json_type(p, '$.{new}') IS NULL THEN {_text_sql(old)} END)"


def _shown_sql(*names: str, default: str = "unknown") -> str:
    return "coalesce(" + ", ".join(f"CASE WHEN p->>'$.{n}' NOT IN ('', 'false', '0', '[]', '{{}}') THEN p->>'$.{n}' END" for n in names) + f", '{default}')"


def _rules(category: str, before: list[Step] = (), config: dict | None = None, buckets: tuple[str, ...] = (), metrics: tuple[str, ...] = ()) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        checked = through(raw(spark, sf_dir, category), list(before) or steps.BY_CATEGORY[category], category, **(config or {}))
        return checked.select(F.col("seq").alias("record_id"), joined("reasons"), *[F.col(f"b_{b}").alias(b) for b in buckets], *[F.col(f"m_{m}").alias(m) for m in metrics])

    return run


def _quoted(pattern: str) -> str:
    return pattern.replace("'", "''")


def _register(name: str, doc: str, run: Query, sql: str) -> None:
    run.__name__, run.__doc__ = name, doc
    query(sql)(run)


_register(
    "rules_math", "The own steps of mathematics on its raw records.", _rules("math", buckets=("form", "difficulty", "domain", "verified")),
    _PAYLOADS.format(category="math") + f""", f AS (SELECT *, coalesce({_moved_sql("question", "problem")}, '') AS q, coalesce({_moved_sql("solution", "response")}, '') AS s FROM j)
SELECT record_id, CASE WHEN q = '' OR s = '' THEN 'missing_problem_or_solution' ELSE concat_ws(',', CASE WHEN regexp_matches(q || chr(10) || s, '{_quoted(steps.IMAGE)}') AND {_shown_sql("image_text", default="")} = '' THEN 'missing_multimodal_context' END,
CASE WHEN length(s) < 32 THEN 'solution_too_short' END, CASE WHEN NOT regexp_matches(s, '{_quoted(steps.ANSWER_SIGNAL)}') AND {_shown_sql("answer", default="")} = '' THEN 'missing_final_answer_signal' END) END AS reasons,
CASE WHEN q <> '' AND s <> '' THEN {_shown_sql("form", default="qa")} END AS form, CASE WHEN q <> '' AND s <> '' THEN {_shown_sql("difficulty")} END AS difficulty,
CASE WHEN q <> '' AND s <> '' THEN {_shown_sql("domain", "subject", default="math")} END AS domain, CASE WHEN q <> '' AND s <> '' THEN 'unknown' END AS verified FROM f""",
)
_register(
    "rules_instruction", "The own steps of instructions on their raw records.", _rules("instruction", buckets=("task", "risk", "turns")),
    _PAYLOADS.format(category="instruction") + f""", f AS (SELECT *, coalesce({_moved_sql("prompt", "instruction")}, '') AS q, coalesce({_moved_sql("response", "output")}, '') AS s FROM j),
d AS (SELECT *, CASE WHEN q = '' OR s = '' THEN 'incomplete_instruction_pair' WHEN lower(q) = lower(s) THEN 'prompt_response_identical' END AS gone FROM f)
SELECT record_id, coalesce(gone, CASE WHEN regexp_matches(s, '{_quoted(steps.TEMPLATE)}') THEN 'generic_model_template' ELSE '' END) AS reasons,
CASE WHEN gone IS NULL THEN {_shown_sql("task", "category", default="general")} END AS task, CASE WHEN gone IS NULL THEN {_shown_sql("risk_category", default="normal")} END AS risk, CASE WHEN gone IS NULL THEN 'single' END AS turns FROM d""",
)
_register(
    "rules_reasoning", "The own steps of reasoning on its raw records.", _rules("reasoning", buckets=("origin", "domain", "verified")),
    _PAYLOADS.format(category="reasoning") + f""", f AS (SELECT *, {_moved_sql("problem", "prompt")} AS q, {_moved_sql("reasoning", "response")} AS s, {_text_sql("final_answer")} AS a FROM j),
t AS (SELECT *, CASE WHEN q IS NULL OR s IS NULL THEN {_text_sql("text")} ELSE concat_ws(chr(10), nullif(q, ''), nullif(s, ''), nullif(a, '')) END AS t FROM f)
SELECT record_id, concat_ws(',', CASE WHEN regexp_matches(coalesce(t, ''), '{_quoted(steps.CONTROL)}') THEN 'control_or_prompt_artifact' END,
CASE WHEN coalesce(s, '') = '' THEN 'missing_reasoning' WHEN length(s) < 64 OR NOT regexp_matches(s, '{_quoted(steps.REASONING_SIGNAL)}') THEN 'weak_reasoning_signal' END,
CASE WHEN {_shown_sql("final_answer", "answer", default="")} = '' THEN 'missing_final_answer' END) AS reasons,
CASE WHEN coalesce(s, '') <> '' THEN {_shown_sql("origin", default="raw")} END AS origin, CASE WHEN coalesce(s, '') <> '' THEN {_shown_sql("domain", "source_group", default="general")} END AS domain,
CASE WHEN coalesce(s, '') <> '' THEN 'unverified' END AS verified FROM t""",
)
_register(
    "rules_web", "The own steps of web pages on their raw records.", _rules("web", buckets=("subtype", "topic")),
    _PAYLOADS.format(category="web") + f""", f AS (SELECT *, {_text_sql("question")} AS q, {_text_sql("answer")} AS a FROM j),
t AS (SELECT *, q IS NOT NULL AND a IS NOT NULL AS qa, CASE WHEN q IS NOT NULL AND a IS NOT NULL THEN concat_ws(chr(10), nullif(q, ''), nullif(a, '')) ELSE coalesce({_text_sql("text")}, '') END AS t FROM f),
l AS (SELECT *, list_filter(string_split(t, chr(10)), lambda x: length(trim(x, ' ' || chr(9) || chr(13))) > 0) AS x FROM t),
b AS (SELECT *, coalesce(len(list_distinct(x)) / nullif(len(x), 0) < 0.45, false) AS again, len(regexp_extract_all(t, '{_quoted(steps.BOILERPLATE)}')) >= 4 AS plate FROM l),
r AS (SELECT *, concat_ws(',', CASE WHEN plate THEN 'web_boilerplate' END, CASE WHEN again THEN 'repetitive_web_text' END, CASE WHEN again OR NOT qa THEN NULL WHEN length(q) < 4 OR a = '' THEN 'incomplete_qa_pair'
WHEN regexp_matches(a, '(?im)\\A\\s*(?:unknown|n/?a|i don''?t know|无法回答|不知道)\\s*[.!。！]?$') THEN 'unknown_answer' END) AS reasons FROM b)
SELECT record_id, reasons, CASE WHEN qa THEN 'web_qa' ELSE 'web_text' END AS subtype, CASE WHEN again OR reasons LIKE '%incomplete_qa_pair' OR reasons LIKE '%unknown_answer' THEN NULL ELSE {_shown_sql("topic_top1", "topic")} END AS topic FROM r""",
)
_register(
    "rules_code", "The own steps of source code on its raw records.", _rules("code", buckets=("language", "subtype", "verified")),
    _PAYLOADS.format(category="code") + f""", f AS (SELECT *, CASE WHEN json_type(p, '$.content') IS NOT NULL AND json_type(p, '$.text') IS NULL THEN {_text_sql("content")} ELSE coalesce({_text_sql("text")}, {_text_sql("content")}) END AS t FROM j),
c AS (SELECT *, coalesce(t, '') AS x, regexp_replace(coalesce(t, ''), '\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x{{85}}\\x{{2028}}\\x{{2029}}]', chr(10), 'g') AS e, lower({_shown_sql("path", "file_path", default="")}) AS path FROM f),
n AS (SELECT *, CASE WHEN e = '' THEN 0 ELSE length(e) - length(replace(e, chr(10), '')) + 1 - CASE WHEN e LIKE '%' || chr(10) THEN 1 ELSE 0 END END AS lines,
{" OR ".join(f"contains(path, '{d}')" for d in steps.DENIED_PARTS)} AS denied FROM c)
SELECT record_id, CASE WHEN denied THEN 'non_core_or_vendored_file' ELSE concat_ws(',', CASE WHEN regexp_matches(x[1:4096], '{_quoted(steps.GENERATED)}') THEN 'possibly_generated_code' END,
CASE WHEN NOT regexp_matches(x, '{_quoted(steps.CODE_SIGNAL)}') AND lines < 3 THEN 'weak_code_signal' END) END AS reasons,
{_shown_sql("language", "metadata.language")} AS language, {_shown_sql("subtype", default="code")} AS subtype, CASE WHEN NOT denied THEN 'unverified' END AS verified FROM n""",
)
_register(
    "rules_scored_pages", "The rules of the profile finepdfs on the raw records of scanned pages.", _rules("pdf_ocr", PROFILES["finepdfs"][2], buckets=("finepdfs_policy",), metrics=("finepdfs_lid_score", "finepdfs_minhash_count", "finepdfs_primary_score")),
    _PAYLOADS.format(category="pdf_ocr") + """, f AS (SELECT record_id, CAST(p->>'$.lid_score' AS DOUBLE) AS lid, CAST(p->>'$.minhash_count' AS DOUBLE) AS copies, CAST(p->>'$.primary_score' AS DOUBLE) AS score FROM j)
SELECT record_id, concat_ws(',', CASE WHEN lid < 0.85 THEN 'finepdfs_low_language_score' END, CASE WHEN copies > 2 THEN 'finepdfs_excessive_minhash_overlap' END, CASE WHEN score < 0.8 THEN 'finepdfs_low_primary_score' END,
CASE WHEN lid IS NULL OR copies IS NULL OR score IS NULL THEN 'finepdfs_missing_quality_metric' END) AS reasons, 'relaxed_lid085_mh2_p08' AS finepdfs_policy, lid AS finepdfs_lid_score, copies AS finepdfs_minhash_count, score AS finepdfs_primary_score FROM f""",
)
_register(
    "rules_scored_web", "The rules of the profile web_knowledge on the raw records of web pages.", _rules("web", PROFILES["web_knowledge"][2], {"web_knowledge_min_quality_band": "ge3"}, buckets=("classifier_quality",), metrics=("web_knowledge_quality_mean",)),
    _PAYLOADS.format(category="web") + """, f AS (SELECT record_id, CAST(p->>'$.quality_mean' AS DOUBLE) AS q FROM j)
SELECT record_id, concat_ws(',', CASE WHEN q IS NULL THEN 'web_knowledge_missing_quality_score' END, 'web_knowledge_missing_token_count', CASE WHEN coalesce(q, -1) < 3 THEN 'web_knowledge_below_quality_band' END) AS reasons,
CASE WHEN q >= 4 THEN 'ge4' WHEN q >= 3 THEN 'ge3' ELSE 'lt3' END AS classifier_quality, coalesce(q, -1) AS web_knowledge_quality_mean FROM f""",
)
_register(
    "rules_math_errors", "The rules of the profile nemotron_math on the raw records of mathematics.", _rules("math", PROFILES["nemotron_math"][2], buckets=("hard_error_risk",), metrics=("nemotron_math_hard_error_score",)),
    _PAYLOADS.format(category="math") + """, f AS (SELECT record_id, CAST(p->>'$.hard_error_score' AS DOUBLE) AS e FROM j)
SELECT record_id, concat_ws(',', CASE WHEN e >= 4 THEN 'nemotron_math_strict_hard_error' END, CASE WHEN e IS NULL THEN 'nemotron_math_missing_hard_error_signal' END) AS reasons,
CASE WHEN e >= 4 THEN 'high' WHEN e IS NOT NULL THEN 'accepted' END AS hard_error_risk, e AS nemotron_math_hard_error_score FROM f""",
)


@query(_PAYLOADS.format(category="agentic") + """, m AS (SELECT record_id, unnest(json_extract(p, '$.messages[*]')) AS m, generate_subscripts(json_extract(p, '$.messages[*]'), 1) AS i FROM j),
t AS (SELECT record_id, CAST(i - 1 AS INT) AS turn, m->>'$.role' AS role, m->>'$.content' AS content FROM m),
s AS (SELECT *, string_agg(concat_ws(': ', role, content), chr(10)) OVER (PARTITION BY record_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS state FROM t)
SELECT record_id, turn, coalesce(state, '') AS state, content AS action FROM s WHERE role = 'assistant'""")
def assistant_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is said before each assistant turn of the traces, and the turn."""
    turns = raw(spark, sf_dir, "agentic").select(F.col("seq").alias("record_id"), F.posexplode("messages").alias("turn", "m")).select("record_id", "turn", "m.role", "m.content")
    return evaluation.turn_pairs(turns, "record_id", "turn", "role", "content")


@query(_NORMAL_SQL + f""", q AS (SELECT *, coalesce(text, '') = '' AS missing, coalesce(text, '') <> '' AND size >= 16 AS whole, coalesce(source, '') = '' AS lone, {_SECRET_IN} AS secret FROM h),
r AS (SELECT *, whole AND row_number() OVER (PARTITION BY digest, whole ORDER BY doc_id) > 1 AS again FROM q),
t AS (SELECT count(*) AS a, count(*) FILTER (missing) AS m, count(*) FILTER (whole) AS w, count(*) FILTER (whole AND size > 2000000) AS l, count(*) FILTER (whole AND lone AND size <= 2000000) AS s,
count(*) FILTER (whole AND NOT lone AND secret AND size <= 2000000) AS k, count(*) FILTER (again) AS d FROM r)
SELECT unnest([{", ".join(str(i) for i in range(10))}]) AS position, unnest([{", ".join(f"'{x.name}'" for x in steps_of("pretrain", "general_text"))}]) AS step,
unnest([a, a - m, a - m, w, w, w, w, w - d, w - d, w - d]) AS seen, unnest([0, 0, l, s, k, 0, 0, 0, 0, 0]) AS review, unnest([m, 0, a - m - w, 0, 0, 0, d, 0, 0, 0]) AS dropped FROM t""")
def step_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows seen and decisions changed at each step for general text."""
    return step_counts(clean(general_records(spark, sf_dir), "pretrain", "general_text"), steps_of("pretrain", "general_text"))


def through(records: DataFrame, own: list[Step], category: str, **config) -> DataFrame:
    """Records after these steps, still with their state."""
    for position, one in enumerate(own):
        records = apply_step(records, one, position, category, dict(config, _category=category))
    return records


def joined(name: str) -> Column:
    return F.array_join(name, ",").alias(name)


@query("""SELECT doc_id, CASE WHEN text IS NULL OR length(text) = 0 THEN 'empty_training_text' WHEN length(text) < 16 THEN 'too_short'
WHEN length(text) > 2000000 THEN 'too_long' ELSE '' END AS reasons FROM documents""")
def integrity_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return through(general_records(spark, sf_dir), [step(steps.validate_basic_integrity)], "general_text").select(F.col("seq").alias("doc_id"), joined("reasons"))


@query("""SELECT doc_id, CASE WHEN coalesce(source, '') = '' THEN 'missing_license,missing_source' ELSE 'missing_license' END AS reasons,
CASE WHEN coalesce(source, '') = '' THEN 'missing_license,missing_source' ELSE 'missing_license' END AS flags FROM documents""")
def provenance_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents carry no licence, so each is flagged for it where one is required."""
    checked = through(general_records(spark, sf_dir), [step(steps.validate_provenance)], "general_text", require_license=True)
    return checked.select(F.col("seq").alias("doc_id"), joined("reasons"), joined("flags"))


_SECRET_SQL = f"""coalesce(regexp_matches(text, '{steps.SECRET.replace("'", "''")}'), false)"""


@query(f"SELECT doc_id, {_SECRET_SQL} AS possible_secret FROM documents")
def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = through(general_records(spark, sf_dir), [step(steps.scan_sensitive_content)], "general_text")
    return checked.select(F.col("seq").alias("doc_id"), F.array_contains("flags", "possible_secret").alias("possible_secret"))


@query(f"""SELECT doc_id, concat_ws(',', CASE WHEN {_SECRET_SQL} THEN 'possible_secret' END,
CASE WHEN contains(lower(text), 'railway timetable') OR contains(lower(text), 'clinic record') THEN 'sensitive_term' END) AS flags FROM documents""")
def sensitive_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = through(general_records(spark, sf_dir), [step(steps.scan_sensitive_content)], "general_text", sensitive_terms=["Railway Timetable", "clinic record", ""])
    return checked.select(F.col("seq").alias("doc_id"), joined("flags"))


@query("""SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS r FROM documents WHERE text <> '') WHERE r > 1""")
def exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = table(spark, sf_dir, "documents").where("text <> ''").select("doc_id", F.sha2("text", 256).alias("digest"))
    return dedup.later_copies(keyed, "digest", "doc_id")


@query(_NORMAL_SQL + " SELECT doc_id FROM (SELECT *, row_number() OVER (PARTITION BY digest ORDER BY doc_id) AS r FROM h WHERE text <> '') WHERE r > 1")
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that repeat an earlier one but for case and spacing."""
    docs = spread(table(spark, sf_dir, "documents")).where("text <> ''")
    return dedup.repeats(docs, F.col("text"), "doc_id").where("duplicate").select("doc_id")


@query()
def near_dedup_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = spread(table(spark, sf_dir, "documents")).where("text <> ''").select(F.col("doc_id").alias("seq"), tx.simhash(F.col("text")).alias("fingerprint"))
    return dedup.near_repeats(staged(prints, "prints")).select(F.col("seq").alias("doc_id"))


@query()
def near_dedup_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = table(spark, sf_dir, "documents").where("text <> ''").select(tx.simhash(F.col("text")).alias("fingerprint"))
    return dedup.near_pairs(staged(prints, "prints"))


@query("SELECT doc_id, greatest(1, CAST(ceil(length(text) / 4.0) AS BIGINT)) AS tokens FROM documents WHERE text IS NOT NULL")
def token_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").where("text is not null").select("doc_id", steps.token_estimate(F.col("text")).alias("tokens"))


@query("""SELECT candidate_id, CASE WHEN n_tokens <= 2048 THEN '1_2048' WHEN n_tokens <= 8192 THEN '2049_8192' WHEN n_tokens <= 32768 THEN '8193_32768'
WHEN n_tokens <= 65536 THEN '32769_65536' ELSE 'gt_65536' END AS length,
CASE WHEN n_tokens <= 16384 THEN 'B16' WHEN n_tokens <= 65536 THEN 'B64' WHEN n_tokens <= 262144 THEN 'B256' ELSE 'gt_256' END AS base FROM mix_candidates WHERE n_tokens IS NOT NULL""")
def length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "mix_candidates").where("n_tokens is not null")
    return rows.select("candidate_id", steps.length_label(F.col("n_tokens"), steps.LENGTHS).alias("length"), prep.base_bucket(F.col("n_tokens")).alias("base"))


@query("""WITH q AS (SELECT doc_id, quality_mean AS q, coalesce(source, '') = (SELECT max(source) FROM documents) AS own FROM documents)
SELECT doc_id, CASE WHEN q IS NULL THEN CASE WHEN own THEN '' ELSE 'missing_quality_score' END WHEN q < CASE WHEN own THEN 1.5 ELSE 2 END THEN 'quality_score_below_drop_threshold'
WHEN q < CASE WHEN own THEN 2.5 ELSE 3 END THEN 'quality_score_below_keep_threshold' ELSE '' END AS reasons, q AS quality_score FROM q""")
def quality_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last feed by name has a policy of its own, all others the default."""
    own = table(spark, sf_dir, "documents").agg(F.max("source")).first()[0]
    policies = {"default": {"score_field": "quality_mean", "keep_min": 3.0, "review_min": 2.0, "require_score": True}, own: {"keep_min": 2.5, "review_min": 1.5}}
    checked = through(general_records(spark, sf_dir), [step(steps.apply_quality_policy)], "general_text", quality_policies=policies, _has_score=True)
    return checked.select(F.col("seq").alias("doc_id"), joined("reasons"), F.col("m_quality_score").alias("quality_score"))


@query("""WITH d AS (SELECT doc_id, coalesce(length(text), 0) AS n, coalesce(source, '') = '' AS m FROM documents),
a AS (SELECT count(*) AS seen, count(*) FILTER (n < 16) AS dropped, count(*) FILTER (n > 2000000) AS review FROM d),
b AS (SELECT count(*) AS seen, count(*) FILTER (m AND n <= 2000000) AS review FROM d WHERE n >= 16)
SELECT 0 AS position, 'validate_basic_integrity' AS step, seen, review, dropped FROM a UNION ALL SELECT 1, 'validate_provenance', seen, review, 0 FROM b""")
def check_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows seen and decisions changed by two steps."""
    own = [step(steps.validate_basic_integrity), step(steps.validate_provenance)]
    return step_counts(through(general_records(spark, sf_dir), own, "general_text"), own)


_BLANK = r"[\s\x0b\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


@query(rf"""WITH l AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: length(regexp_replace(x, '{_BLANK}', '', 'g')) > 0) AS x FROM documents WHERE text IS NOT NULL)
SELECT doc_id, round(CASE WHEN len(x) > 0 THEN len(list_distinct(x)) / len(x) END, 9) AS share, coalesce(len(list_distinct(x)) / nullif(len(x), 0) < 0.45, false) AS repetitive FROM l""")
def line_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    share = tx.line_repetition(F.col("text"))
    return table(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.round(share, 9).alias("share"), below(share, 0.45).alias("repetitive"))


@query("""WITH l AS (SELECT doc_id, regexp_extract_all(lower(text), '[A-Za-z0-9_]+|[\\x{4e00}-\\x{9fff}]') AS l FROM documents WHERE text IS NOT NULL),
w AS (SELECT doc_id, unnest(l) AS w, generate_subscripts(l, 1) AS i FROM l),
g AS (SELECT doc_id, concat_ws(' ', w, lead(w, 1) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o, lead(w, 4) OVER o) AS g, lead(w, 4) OVER o AS last FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
s AS (SELECT doc_id, count(*) >= 120 AND 1 - count(DISTINCT g) FILTER (last IS NOT NULL) / greatest(count(last), 1) > 0.2 AS repeats FROM g GROUP BY 1)
SELECT doc_id, coalesce(repeats, false) AS repeats FROM l LEFT JOIN s USING (doc_id)""")
def ngram_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").where("text is not null").select("doc_id", tx.repeats_itself(F.col("text")).alias("repeats"))


@query()
def compression_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").where("text is not null").select("doc_id", tx.compression_ratio("text").alias("ratio"))


_NAME = "regexp_extract(lower(regexp_replace(replace(path, chr(92), '/'), '(/|/\\.)+$', '')), '([^/]*)$', 1)"
_WHOLE = "('/' || lower(regexp_replace(replace(path, chr(92), '/'), '^/+', '')))"


def _listed(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _any_of(marks) -> str:
    return " OR ".join(f"contains(whole, '{m}')" for m in marks)


@query(f"""WITH n AS (SELECT doc_id, {_NAME} AS name, {_WHOLE} AS whole FROM documents WHERE path IS NOT NULL),
s AS (SELECT *, regexp_extract(name, '(?s)[^.].*?(\\.[^.]+)$', 1) AS suffix FROM n),
l AS (SELECT *, CASE {" ".join(f"WHEN name = '{k}' THEN '{v}'" for k, v in profiles.LANGUAGE_BY_NAME.items())} {" ".join(f"WHEN suffix = '{k}' THEN '{v}'" for k, v in profiles.LANGUAGE_BY_SUFFIX.items())} END AS language FROM s)
SELECT doc_id, language, CASE WHEN regexp_matches(name, '\\.min\\.(js|css|html)$') THEN 'minified_asset' WHEN list_has_any(string_split(whole, '/'), [{_listed(profiles.REJECTED_DIRECTORIES)[1:-1]}]) THEN 'vendor_or_build_path'
WHEN name IN {_listed(profiles.LOCK_FILES)} THEN 'lockfile' WHEN suffix IN {_listed(profiles.BINARY_SUFFIXES)} THEN 'binary_extension' WHEN {_any_of(profiles.SNAPSHOT_MARKS)} THEN 'fixture_or_snapshot'
WHEN {_any_of(profiles.REPORT_MARKS)} THEN 'machine_report' WHEN language IS NULL THEN 'unsupported_file_type' END AS reason FROM l""")
def source_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each source file, and why it is rejected, if it is."""
    docs = table(spark, sf_dir, "documents").where("path is not null")
    return docs.select("doc_id", language_for_path(F.col("path")).alias("language"), reject_path_reason(F.col("path"), F.octet_length("text").cast("long")).alias("reason"))


@query("SELECT coalesce(decision, 'unknown') AS decision, count(*) AS n FROM samples GROUP BY 1")
def decision_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jsonl.decision_counts(table(spark, sf_dir, "samples"))


@query("SELECT reason, count(*) AS n FROM (SELECT unnest(reasons) AS reason FROM samples) GROUP BY 1")
def reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "samples").select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


@query()
def release_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Released general text with the hash of each record."""
    return jsonl.released(clean(general_records(spark, sf_dir), "pretrain", "general_text")).select("source_id", "decision", "record_sha256")


@query()
def stable_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.groupBy(tx.stable_partition(F.col("doc_id"), 16).alias("part")).agg(F.count("*").alias("n"))


def _usable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each candidate with tokens and a clean profile."""
    return table(spark, sf_dir, "mix_candidates").where("n_tokens > 0").groupBy("candidate_id").agg(F.min(F.lower(F.trim("profile"))).alias("source"), F.min("n_tokens").alias("n_tokens")).where("source is not null")


@query()
def mix_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of each profile's candidates by a seeded hash, in one seeded order."""
    rows = staged(_usable(spark, sf_dir), "usable")
    wanted = {r.source: r["count"] // 10 for r in rows.groupBy("source").count().collect() if r["count"] >= 10}
    return prep.select_mix(rows.select("source", F.col("candidate_id").alias("id")), wanted, 7)


@query("""WITH t AS (SELECT mix_id, lower(trim(source)) AS source, max(weight) AS w FROM mix_targets WHERE weight > 0 GROUP BY 1, 2), s AS (SELECT *, sum(w) OVER (PARTITION BY mix_id) AS total FROM t)
SELECT mix_id, source, CAST(ceil(ceil(round(100003 * w / total, 9)) * 1.005) AS BIGINT) AS samples FROM s""")
def blend_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples to build of each source for blends of 100,003, with a surplus; the targets are one small table."""
    rows = table(spark, sf_dir, "mix_targets").where("weight > 0").groupBy("mix_id", F.lower(F.trim("source")).alias("source")).agg(F.max("weight").alias("w"))
    whole = F.sum("w").over(Window.partitionBy("mix_id"))
    return rows.select("mix_id", "source", prep.blend_size(F.col("w") / whole, 100_003).alias("samples"))


@query()
def prefix_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("n_tokens") <= 512, "mix16").when(F.col("n_tokens") <= 2048, "mix64").otherwise("mix256")
    rows = staged(_usable(spark, sf_dir).select(label.alias("mix"), F.col("candidate_id").alias("id")), "candidates")
    targets = {r.mix: r["count"] // 2 for r in rows.groupBy("mix").count().collect()}
    return prep.prefix_mixes(rows, targets, 7)


@query("""WITH RECURSIVE u AS (SELECT candidate_id, min(lower(trim(profile))) AS source, min(n_tokens) AS n FROM mix_candidates WHERE n_tokens > 0 GROUP BY 1),
o AS (SELECT source, n, row_number() OVER (PARTITION BY source ORDER BY candidate_id) - 1 AS r FROM u WHERE source IS NOT NULL),
w AS (SELECT source, r, n, CAST(0 AS BIGINT) AS s, CAST(n AS BIGINT) AS held FROM o WHERE r = 0 UNION ALL
SELECT o.source, o.r, o.n, CASE WHEN w.held + o.n > 100000 THEN o.r ELSE w.s END, CAST(CASE WHEN w.held + o.n > 100000 THEN o.n ELSE w.held + o.n END AS BIGINT) FROM w JOIN o ON o.source = w.source AND o.r = w.r + 1)
SELECT source, s AS row_start, max(r) + 1 AS row_end, max(held) AS tokens FROM w GROUP BY source, s""")
def microshards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of about 100,000 tokens of each profile's candidates, numbered within the profile."""
    placed = prep.positioned(_usable(spark, sf_dir), ["source", "candidate_id"])
    first = placed.groupBy("source").agg(F.min("position").alias("_first"))
    rows = placed.join(first, "source").select("source", (F.col("position") - F.col("_first")).alias("row"), "n_tokens")
    return prep.microshards(rows, 100_000, tokens="n_tokens")


@query("""WITH c AS (SELECT source, count(*) AS n FROM (SELECT candidate_id, min(lower(trim(profile))) AS source FROM mix_candidates WHERE n_tokens > 0 GROUP BY 1) WHERE source IS NOT NULL GROUP BY 1),
t AS (SELECT source, CAST(n AS HUGEINT) * 9973 AS x, CAST(sum(n) OVER () AS HUGEINT) AS t FROM c),
f AS (SELECT source, x // t AS q, x % t AS rest, 9973 - sum(x // t) OVER () AS more FROM t)
SELECT source, CAST(q + CASE WHEN row_number() OVER (ORDER BY rest DESC, source) <= more THEN 1 ELSE 0 END AS BIGINT) AS quota FROM f""")
def mix_quotas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """9,973 places shared among the profiles by their numbers of candidates; one row a profile."""
    weights = {r.source: r["count"] for r in _usable(spark, sf_dir).groupBy("source").count().collect()}
    return spark.createDataFrame(sorted(prep.quotas(weights, 9973).items()), "source string, quota long")


PACKED = 8192


def _sample_bytes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Each sample once, and the bytes of those that have a text."""
    samples = table(spark, sf_dir, "samples").dropDuplicates(["sample_id"])
    return samples, sequences.encode(samples, ["text"], key="sample_id").select("sample_id", "ids")


@query()
def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples as bytes packed into sequences of 8,192, on eight shards."""
    packed = prep.pack_samples(_sample_bytes(spark, sf_dir)[1], PACKED, 8, key="sample_id", tokens="ids")
    return packed.select("shard", "bin", F.size("tokens").alias("tokens"), F.size("source_ids").alias("samples"))


@query("""WITH s AS (SELECT DISTINCT sample_id, strlen(text) AS n FROM samples WHERE text <> '')
SELECT count(*) AS samples, CAST(sum(n) AS BIGINT) AS tokens, 0 AS overfull FROM s WHERE n <= 8192""")
def packing_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples and tokens that ``packing`` placed, and sequences above their capacity."""
    return packing(spark, sf_dir).agg(F.sum("samples").alias("samples"), F.sum("tokens").alias("tokens"), F.count_if(F.col("tokens") > PACKED).cast("int").alias("overfull"))


@query("""SELECT DISTINCT sample_id, CAST(strlen(coalesce(text, '')) AS INT) AS length FROM samples WHERE strlen(coalesce(text, '')) NOT BETWEEN 1 AND 8192""")
def packing_unpacked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples that ``packing`` puts into no sequence, with their length: longer than 8,192 bytes, or empty."""
    samples, ids = _sample_bytes(spark, sf_dir)
    empty = samples.where("coalesce(text, '') = ''").select("sample_id", F.lit(0).alias("length"))
    return prep.unpacked_samples(ids, PACKED, "sample_id", "ids").unionByName(empty)


@query("""WITH p AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS position, count(*) OVER () AS n FROM documents)
SELECT doc_id, CASE WHEN position < round_even(0.9 * n, 0) THEN 'train' WHEN position < round_even(0.95 * n, 0) THEN 'valid' ELSE 'test' END AS split FROM p""")
def split_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = jsonl.with_positions(table(spark, sf_dir, "documents").select("doc_id"), ["doc_id"], "position")
    return ids.select("doc_id", prep.split_of(F.col("position"), ids.count(), "90,5,5").alias("split"))


@query("""WITH d AS (SELECT doc_id, strlen(text) + 1 AS n FROM documents WHERE text <> ''),
p AS (SELECT doc_id, CAST(sum(n) OVER (ORDER BY doc_id) AS BIGINT) AS b, CAST(n AS BIGINT) AS n FROM d),
s AS (SELECT doc_id, b - n AS a, b, unnest(range((b - n) // 2048, (b - 1) // 2048 + 1)) AS sample FROM p)
SELECT sample, doc_id, greatest(a, sample * 2048) - a AS "begin", least(b, (sample + 1) * 2048) - a AS "end" FROM s""")
def sample_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 2,048 byte tokens over all documents in order."""
    return prep.token_windows(table(spark, sf_dir, "documents").where("text <> ''"), 2048, size=F.octet_length("text") + 1)


def _few_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bytes of each sample's text; an id that has texts of several lengths gives one row for each."""
    samples = table(spark, sf_dir, "samples").where("text <> ''").select("sample_id", "text", F.octet_length("text").alias("n")).dropDuplicates(["sample_id", "n"])
    return sequences.encode(samples, ["text"], key="sample_id").select("sample_id", "ids")


_BYTES_SQL = "SELECT DISTINCT sample_id, CAST(strlen(text) AS INT) AS n, TRUE AS intact FROM samples WHERE text <> ''"


@query(_BYTES_SQL)
def infilled_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples rearranged for infilling: as long as before, and no byte more often than before."""
    made = sequences.infill(_few_bytes(spark, sf_dir), 0.5, 0.5, 300, 301, 302, 303, key="sample_id", keep={"original": "ids"})
    return made.select("sample_id", F.size("ids").alias("n"), (F.size(F.array_except("ids", "original")) <= 4).alias("intact"))


@query(_BYTES_SQL)
def masked_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples with hidden tokens, which their targets restore."""
    made = sequences.mask_tokens(_few_bytes(spark, sf_dir), 0.15, 300, 256, key="sample_id", keep={"original": "ids"})
    restored = F.zip_with("ids", "targets", lambda x, y: F.when(y == sequences.IGNORE, x).otherwise(y))
    return made.select("sample_id", F.size("ids").alias("n"), (restored == F.col("original")).alias("intact"))


@query(_BYTES_SQL)
def corrupted_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples whose spans stand behind sentinels; input and output together have each byte once."""
    made = sequences.corrupt_spans(_few_bytes(spark, sf_dir), 0.15, range(1000, 1100), 300, 301, key="sample_id", keep={"original": "ids"})
    # in order all bytes stand before the end of the output, 301, and the sentinels
    whole = F.sort_array(F.concat("encoder", "output"))
    bytes_in = (F.array_position(whole, 301) - 1).cast("int")
    return made.select("sample_id", bytes_in.alias("n"), (F.slice(whole, 1, bytes_in) == F.sort_array("original")).alias("intact"))


@query("""WITH s AS (SELECT DISTINCT sample_id FROM samples WHERE sample_id IS NOT NULL), p AS (SELECT sample_id, row_number() OVER (ORDER BY sample_id) - 1 - 37 AS a, (SELECT count(*) FROM s) AS n FROM s)
SELECT sample_id, a // 12 AS step, CAST(a % 12 // 4 AS INT) AS rank, CAST(a % 4 AS INT) AS slot FROM p WHERE a >= 0 AND a < (n - 37) // 12 * 12""")
def trainer_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps of four samples for each of three ranks, after 37 that were consumed before."""
    placed = prep.positioned(table(spark, sf_dir, "samples").where("sample_id is not null").select("sample_id").distinct(), ["sample_id"])
    taken = corpus.batches(F.col("position"), 4, 3, 37, placed.count())
    return placed.select("sample_id", taken.alias("b")).where("b is not null").select("sample_id", "b.*")


@query("""WITH d AS (SELECT sum(strlen(text)) * 2 AS n FROM documents WHERE text <> '') SELECT CAST(ceil(n / 4096.0) AS BIGINT) AS samples, CAST(ceil(n / 4096.0) AS BIGINT) - 1 AS last_place, CAST(n AS BIGINT) AS tokens FROM d""")
def epoch_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of 4,096 byte tokens over two shuffled epochs: their number, the last place in the shuffled order, and all tokens."""
    docs = table(spark, sf_dir, "documents").where("text <> ''").select("doc_id", F.octet_length("text").alias("n"))
    pieces = corpus.sample_index(docs, 4096, 2, 7)
    return pieces.agg(F.countDistinct("sample").alias("samples"), F.max("place").alias("last_place"), F.sum(F.col("end") - F.col("begin")).alias("tokens"))


@query("SELECT doc_id, " + ", ".join(f"CAST(len(regexp_extract_all(coalesce(text, ''), '{p}')) AS INT) AS {n}" for n, p in tx.PRIVATE.items()) + " FROM documents")
def private_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", tx.private_counts(F.col("text")).alias("c")).select("doc_id", "c.*")


@query("""WITH c AS (SELECT dataset, count(*) AS n, count(*) FILTER (decision = 'keep') AS c FROM samples GROUP BY 1)
SELECT dataset, CAST(n AS INT) AS attempts, CAST(c AS INT) AS correct, round(CASE WHEN n - c < 4 THEN 1.0 WHEN c = 0 THEN 0.0
ELSE 1 - list_aggregate(list_transform(range(n - c + 1, n + 1), lambda i: 1 - 4.0::DOUBLE / i), 'product') END, 9) AS pass_at_4 FROM c WHERE n >= 4""")
def pass_at_4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chance that one of four samples of a dataset is kept."""
    counts = table(spark, sf_dir, "samples").groupBy("dataset").agg(F.count("*").cast("int").alias("attempts"), F.count(F.when(F.col("decision") == "keep", 1)).cast("int").alias("correct")).where("attempts >= 4")
    return counts.withColumn("pass_at_4", F.round(evaluation.pass_at_k(F.col("attempts"), F.col("correct"), 4), 9))


@query("""SELECT dataset, count(*) AS n, round(avg(metrics['quality_mean']), 9) AS mean, round(stddev_pop(metrics['quality_mean']), 9) AS spread
FROM samples WHERE metrics['quality_mean'] IS NOT NULL GROUP BY 1 HAVING stddev_pop(metrics['quality_mean']) > 1e-6""")
def varied_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "samples").select("dataset", F.col("metrics")["quality_mean"].alias("q")).where("q is not null")
    return evaluation.varied_groups(rows, "dataset", "q").select("dataset", "n", F.round("mean", 9).alias("mean"), F.round("spread", 9).alias("spread"))


@query()
def lexical_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.curriculum(table(spark, sf_dir, "documents"), "text").select("doc_id", "complexity")


@query("""SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY quality_mean, doc_id) AS r FROM documents WHERE quality_mean IS NOT NULL)
WHERE r <= (SELECT count(*) // 2 FROM documents)""")
def lowest_half(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The half of all documents with the lowest score, as if it were one of toxicity."""
    return evaluation.least_toxic(table(spark, sf_dir, "documents").select("doc_id", "quality_mean"), "quality_mean", F.col("doc_id")).select("doc_id")


@query("""WITH f AS (SELECT p_partkey * 37 AS f FROM part)
SELECT a.f AS a, b.f AS b, CAST(bit_count(xor(a.f, b.f)) AS INT) AS distance FROM f a JOIN f b ON a.f < b.f AND bit_count(xor(a.f, b.f)) <= 3""")
def near_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers within three bits of each other: the join of near fingerprints on values that have such pairs."""
    return dedup.near_pairs(table(spark, sf_dir, "part").select((F.col("p_partkey").cast("long") * 37).alias("fingerprint")))


def _grams_sql(name: str, key: str, source: str) -> str:
    leads = ", ".join(f"lead(w, {i}) OVER o" for i in range(1, 13))
    return f"""{name}l AS (SELECT {key} AS id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS l FROM {source}),
{name}w AS (SELECT id, unnest(l) AS w, generate_subscripts(l, 1) AS i FROM {name}l), {name}g AS (SELECT id, concat_ws(' ', w, {leads}) AS g, lead(w, 12) OVER o AS last FROM {name}w WINDOW o AS (PARTITION BY id ORDER BY i)),
{name} AS (SELECT DISTINCT id, g FROM {name}g WHERE last IS NOT NULL)"""


@query(_PAYLOADS.format(category="instruction") + f""", b AS (SELECT record_id, coalesce({_text_sql("instruction")}, {_text_sql("prompt")}) AS text FROM j),
{_grams_sql("tests", "record_id", "b")}, {_grams_sql("own", "doc_id", "documents")}, c AS (SELECT id AS doc_id, count(*) AS shingles, count(*) FILTER (g IN (SELECT g FROM tests)) AS shared FROM own GROUP BY 1)
SELECT doc_id, shingles, shared, shared / shingles AS overlap FROM c WHERE shared > 0""")
def decontaminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that share 13-grams with the question records of the instruction category, as if these were a benchmark."""
    tests = raw(spark, sf_dir, "instruction").select(F.coalesce("f_instruction", "f_prompt").alias("text")).where("text is not null")
    return dedup.decontaminate(table(spark, sf_dir, "documents").where("text is not null"), tests)


@query("""SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY 1, 2""")
def events_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.streaming.pipeline import tumbling

    return tumbling(table(spark, sf_dir, "events")).select("start", "event_type", "n", F.round("total", 6).alias("total"))


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER w + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS "end", count(*) AS n FROM s GROUP BY user_id, k""")
def events_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.streaming.pipeline import sessions

    return sessions(table(spark, sf_dir, "events"))


@query("""SELECT l_returnflag, l_linestatus, sum(l_quantity) AS quantity, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n FROM lineitem GROUP BY 1, 2""")
def revenue_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus")
    return own.agg(F.sum("l_quantity").alias("quantity"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count("*").alias("n"))
