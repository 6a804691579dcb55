"""The canonical record as columns, and the compiler from steps to projections.

A record is a row: its string fields are columns ``f_<name>`` (null unless the
payload holds a string there), everything else of the payload stays in ``data``, a
VARIANT that is read where a step needs it. A step is a Python function that
describes, once per plan, which columns change and which marks are set under which
conditions; it becomes one projection, guarded by "not dropped yet".
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEEP, REVIEW, DROP = 0, 1, 2
DECISIONS = ("keep", "review", "drop")
STAGES = ("pretrain", "midtrain", "posttrain", "sft")
CATEGORIES = ("code", "web", "agentic", "instruction", "math", "reasoning", "pdf_ocr", "general_text")

#: String fields that steps read or write.
FIELDS = (
    "text", "content", "document", "body", "raw_text", "ocr_text", "instruction", "output", "prompt", "response", "completion",
    "question", "answer", "problem", "solution", "reasoning", "final_answer", "path", "language", "source",
)
#: Fields that the text of a category may be made of.
TEXT_OF = {
    "code": ("text", "content"),
    "web": ("text", "question", "answer"),
    "instruction": ("text", "prompt", "response"),
    "math": ("text", "question", "solution"),
    "reasoning": ("text", "problem", "reasoning", "final_answer"),
}
#: Messages as steps see them; ``truthy`` tool calls are those that aren't empty.
MESSAGE = "struct<role:string,content:string,is_text:boolean,reasoning_content:string,tool_calls:string>"
BUCKETS = (
    "subtype", "language", "verified", "topic", "model_quality", "outcome", "tool_family", "task", "risk", "turns", "form", "difficulty", "domain",
    "origin", "source_family", "gharchive_bucket", "finepdfs_policy", "olmocr_policy", "classifier_quality", "source_length", "hard_error_risk",
    "dolci_source", "format_profile", "tool_schema", "length", "quality",
)
METRICS = (
    "turns", "tool_calls", "tool_observations", "quality_score", "hard_error_score", "finepdfs_lid_score", "finepdfs_minhash_count", "finepdfs_primary_score",
    "olmocr_zlib_ratio", "olmocr_edu_score", "web_knowledge_quality_mean", "training_token_count", "nemotron_math_hard_error_score", "dolci_think_rough_tokens", "estimated_tokens",
)


def yes() -> Column:
    return F.lit(True)


def no() -> Column:
    return F.lit(False)


def variant(path: str, kind: str) -> Column:
    return F.try_variant_get("data", path, kind)


def present(path: str) -> Column:
    """Whether the payload has the field, a JSON null included."""
    return variant(path, "variant").isNotNull()


def json_type(path: str) -> Column:
    return F.schema_of_variant(variant(path, "variant"))


def strict_string(path: str) -> Column:
    return F.when(json_type(path) == "STRING", variant(path, "string"))


def shown(path: str) -> Column:
    """The value as text, null where it is missing, null, false, zero or empty."""
    value = variant(path, "string")
    return F.when(truthy(path), value)


def truthy(path: str) -> Column:
    """Whether the field holds what counts as true: neither missing, null, false, zero nor empty."""
    kind, value = json_type(path), variant(path, "string")
    return F.coalesce(
        F.when(kind == "BOOLEAN", value == "true")
        .when(kind == "STRING", value != "")
        .when(kind.startswith("ARRAY"), value != "[]")
        .when(kind.startswith("OBJECT"), value != "{}")
        .when(kind == "VOID", no())
        .when(kind.isNotNull(), F.try_to_number(value, F.lit("999999999999999.999999")).cast("double") != 0),
        F.when(kind.isNotNull() & (kind != "VOID"), variant(path, "double") != 0),
        no(),
    )


_FLOAT = r"\A\s*[+-]?(\d+(_\d+)*)?(\.(\d+(_\d+)*)?)?([eE][+-]?\d+(_\d+)*)?\s*\z"


def as_float(text: Column) -> Column:
    """A number as loosely written as 4_2 or inf; null if it is none."""
    plain = F.regexp_replace(F.trim(text), "_", "")
    word = F.lower(plain)
    return F.when(F.regexp_like(text, F.lit(_FLOAT)), plain.try_cast("double")).when(word.isin("nan", "+nan", "-nan"), F.lit(float("nan"))).when(
        word.isin("inf", "+inf", "infinity", "+infinity"), F.lit(float("inf"))
    ).when(word.isin("-inf", "-infinity"), F.lit(float("-inf")))


def number(path: str, booleans: bool = False) -> Column:
    """The field as a number: JSON numbers, strings that show one, and booleans if asked for."""
    kind = json_type(path)
    value = F.when(kind == "STRING", as_float(variant(path, "string"))).when(kind.isin("VOID") | kind.startswith("ARRAY") | kind.startswith("OBJECT"), F.lit(None).cast("double"))
    flag = F.when(variant(path, "boolean"), 1.0).otherwise(0.0) if booleans else F.lit(None).cast("double")
    return value.when(kind == "BOOLEAN", flag).otherwise(variant(path, "double"))


def first_number(names: Iterable[str], booleans: bool = True, parents: tuple[str, ...] = ("metadata",)) -> Column:
    """The first name that shows a number; a field at the top hides the one of the same name in the metadata."""
    return F.coalesce(*[F.when(present(f"$.{n}"), number(f"$.{n}", booleans)).otherwise(F.coalesce(*[number(f"$.{p}.{n}", booleans) for p in parents])) for n in names])


def below(value: Column, limit: float) -> Column:
    """value < limit; never for NaN."""
    return F.coalesce((value < limit) & ~F.isnan(value), no())


def above(value: Column, limit: float, equal: bool = False) -> Column:
    return F.coalesce(((value >= limit) if equal else (value > limit)) & ~F.isnan(value), no())


def as_json(value: Column) -> Column:
    return F.to_json(value.cast("variant"))


def not_empty(value: Column) -> Column:
    return F.coalesce(value != "", no())


@dataclass
class State:
    """One step's changes, as expressions over the columns before it."""

    config: Mapping[str, Any]
    category: str
    guard: Column = field(default_factory=yes)
    sets: dict[str, Column] = field(default_factory=dict)
    marks: list[tuple[Column, int, str]] = field(default_factory=list)
    flags: list[tuple[Column, str]] = field(default_factory=list)
    writes: list[tuple[Column, str, str, Column]] = field(default_factory=list)

    def get(self, name: str) -> Column:
        return self.sets.get(name, F.col(name))

    def string(self, name: str) -> Column:
        return self.get(f"f_{name}")

    def put(self, name: str, value: Column, when: Column | None = None) -> None:
        self.sets[name] = F.when(self.guard if when is None else self.guard & when, value).otherwise(self.get(name))

    def text_fields(self, *names: str, when: Column | None = None) -> None:
        self.put("text_fields", F.array(*map(F.lit, names)), when)

    def text(self) -> Column:
        """The non-empty string fields of the record's text, one after the other."""
        names = TEXT_OF.get(self.category, ("text",))
        if len(names) == 1:
            return F.coalesce(F.when(F.array_contains(self.get("text_fields"), names[0]), self.string(names[0])), F.lit(""))
        parts = F.array(*[F.when(F.array_contains(self.get("text_fields"), n), self.string(n)) for n in names])
        return F.array_join(F.filter(parts, lambda x: x.isNotNull() & (x != "")), "\n")

    def mark(self, when: Column, decision: int, reason: str | Column) -> None:
        self.marks.append((F.coalesce(self.guard & when, no()), decision, reason))

    def flag(self, when: Column, name: str) -> None:
        self.flags.append((F.coalesce(self.guard & when, no()), name))

    def bucket(self, name: str, value: Column, when: Column | None = None, default: bool = False) -> None:
        """Sets a bucket; as a default only where it is unset."""
        self.put(f"b_{name}", F.coalesce(self.get(f"b_{name}"), value) if default else value, when)

    def metric(self, name: str, value: Column, when: Column | None = None) -> None:
        self.put(f"m_{name}", value.cast("double"), value.isNotNull() if when is None else when & value.isNotNull())

    def write(self, name: str, value: Column, when: Column | None = None, how: str = "set") -> None:
        """Notes a value for the released object: ``set`` or, where the field is missing, ``default``; with ``meta_`` before it a field of its metadata."""
        self.writes.append((F.coalesce(self.guard if when is None else self.guard & when, no()) & value.isNotNull(), name, how, as_json(value)))

    def put_messages(self, value: Column, when: Column | None = None) -> None:
        self.put("messages", value, when)
        self.put("wrote_messages", yes(), when)

    def stop(self, when: Column) -> None:
        """Nothing after this happens in this step where ``when`` holds."""
        self.guard = self.guard & ~F.coalesce(when, no())


@dataclass(frozen=True)
class Step:
    name: str
    describe: Callable[[State], None]
    #: Replaces the projection: a function of the frame, for steps that compare rows.
    across: Callable[[DataFrame, Mapping[str, Any], Step, int], DataFrame] | None = None
    #: Columns that the step's rules share, in projections of their own before it; dropped after it.
    before: tuple[Callable[[State], dict[str, Column]], ...] = ()


def marked(df: DataFrame, position: int, marks: list[tuple[Column, int, Any]], flags: list[tuple[Column, str]], sets: Mapping[str, Column], writes: list[tuple[Column, str, str, Column]] = ()) -> DataFrame:
    """One projection: changes, marks, flags and values to write of a step where the row is alive, and its entry in the transitions."""
    alive = F.col("rank") < DROP
    out = {name: F.when(alive, value).otherwise(F.col(name)) for name, value in sets.items()}
    if marks:
        rank = F.greatest(F.col("rank"), *[F.when(c, d).otherwise(KEEP) for c, d, _ in marks])
        reasons = F.filter(F.array(*[F.when(c, r if isinstance(r, Column) else F.lit(r)) for c, _, r in marks]), lambda x: x.isNotNull())
        out["reasons"] = F.when(alive, F.array_distinct(F.concat("reasons", reasons))).otherwise(F.col("reasons"))
        out["transitions"] = F.when(alive & (rank != F.col("rank")), F.array_append("transitions", F.struct(F.lit(position).alias("step"), rank.alias("rank")))).otherwise(F.col("transitions"))
        out["rank"] = F.when(alive, rank).otherwise(F.col("rank"))
    if flags:
        new = F.filter(F.array(*[F.when(c, F.lit(n)) for c, n in flags]), lambda x: x.isNotNull())
        out["flags"] = F.when(alive, F.array_sort(F.array_distinct(F.concat("flags", new)))).otherwise(F.col("flags"))
    if writes:
        new = F.array(*[F.when(c, F.struct(F.lit(n).alias("name"), F.lit(how).alias("how"), v.alias("value"))) for c, n, how, v in writes])
        out["writes"] = F.when(alive, F.concat("writes", F.filter(new, lambda x: x.isNotNull()))).otherwise(F.col("writes"))
    return df.withColumns(out) if out else df


def apply_step(df: DataFrame, step: Step, position: int, category: str, config: Mapping[str, Any]) -> DataFrame:
    if step.across is not None:
        return step.across(df, config, step, position)
    shared: set[str] = set()
    for columns in step.before:
        new = columns(State(config, category))
        shared |= set(new)
        df = fenced(df.withColumns(new))
    state = State(config, category)
    step.describe(state)
    df = marked(df, position, state.marks, state.flags, state.sets, state.writes)
    return fenced(df.drop(*shared) if shared else df)


def fenced(df: DataFrame) -> DataFrame:
    """The frame behind a metrics node, into which the optimizer doesn't merge projections.

    Without it the steps of a pipeline become one projection in which shared
    expressions are repeated until planning takes longer than running.
    """
    return df.observe(f"rows-{uuid.uuid4().hex[:12]}", F.count(F.lit(1)).alias("rows"))


def with_state(df: DataFrame) -> DataFrame:
    """Adds empty decisions, buckets and metrics, and whatever field the frame lacks."""
    have = set(df.columns)
    new: dict[str, Column] = {}
    if "data" not in have:
        new["data"] = F.lit(None).cast("variant")
    for name in FIELDS:
        if f"f_{name}" not in have:
            new[f"f_{name}"] = F.lit(None).cast("string")
    if "messages" not in have:
        new["messages"] = F.lit(None).cast(f"array<{MESSAGE}>")
    if "rendered" not in have:
        new["rendered"] = no()
    new |= {f"b_{n}": F.lit(None).cast("string") for n in BUCKETS} | {f"m_{n}": F.lit(None).cast("double") for n in METRICS}
    new |= {
        "text_fields": F.array(F.lit("text")),
        "rank": F.lit(KEEP),
        "reasons": F.array().cast("array<string>"),
        "flags": F.array().cast("array<string>"),
        "transitions": F.array().cast("array<struct<step:int,rank:int>>"),
        "text_sha256": F.lit(None).cast("string"),
        "writes": F.array().cast("array<struct<name:string,how:string,value:string>>"),
        "wrote_messages": no(),
    }
    return df.withColumns(new)


def messages_of(path: str) -> Column:
    """The objects of a list of messages; null if the field is no list."""
    items = variant(path, "array<variant>")
    one = lambda m: F.struct(
        F.when(F.schema_of_variant(F.try_variant_get(m, "$.role", "variant")) != "VOID", F.try_variant_get(m, "$.role", "string")).alias("role"),
        F.when(F.schema_of_variant(F.try_variant_get(m, "$.content", "variant")) != "VOID", F.try_variant_get(m, "$.content", "string")).alias("content"),
        F.coalesce(F.schema_of_variant(F.try_variant_get(m, "$.content", "variant")) == "STRING", no()).alias("is_text"),
        F.when(F.schema_of_variant(F.try_variant_get(m, "$.reasoning_content", "variant")) == "STRING", F.try_variant_get(m, "$.reasoning_content", "string")).alias("reasoning_content"),
        F.when(F.to_json(F.try_variant_get(m, "$.tool_calls", "variant")).isin("[]", "null", "{}", '""', "false", "0"), None).otherwise(F.to_json(F.try_variant_get(m, "$.tool_calls", "variant"))).alias("tool_calls"),
    )
    return F.transform(F.filter(items, lambda m: F.schema_of_variant(m).startswith("OBJECT")), one)


def adapted(df: DataFrame, payload: str, dataset: Column, position: Column, id_field: str = "id", field_map: Mapping[str, str] | None = None) -> DataFrame:
    """Records of a column of JSON objects; rows whose payload is no JSON object are left out (see ``sources``).

    ``field_map`` copies a field to another name where that one is missing. An id that
    is missing, null, empty, zero or false gives ``<dataset>:<position>``.
    """
    parsed = df.select(dataset.alias("dataset"), position.cast("long").alias("seq"), F.try_parse_json(payload).alias("data")).where(F.schema_of_variant("data").startswith("OBJECT"))
    mapped = {new: old for old, new in (field_map or {}).items()}
    fields = {f"f_{n}": F.coalesce(strict_string(f"$.{n}"), F.when(~present(f"$.{n}"), strict_string(f"$.{mapped[n]}"))) if n in mapped else strict_string(f"$.{n}") for n in FIELDS}
    identity = F.coalesce(shown(f"$.{id_field}"), F.concat_ws(":", "dataset", F.col("seq").cast("string")))
    rows = parsed.withColumns({"source_id": identity, **fields, "messages": F.coalesce(messages_of("$.messages"), F.when(~truthy("$.messages"), messages_of("$.trajectory")))})
    return with_state(rows.withColumn("rendered", truthy("$.pre_rendered_agent_trace")))


def finished(df: DataFrame, stage: str, category: str) -> DataFrame:
    """The released shape: decision, reasons, flags, and maps of what is set among buckets and metrics."""

    def packed(prefix: str, names: Iterable[str]) -> Column:
        pairs = [x for n in names for x in (F.lit(n), F.col(f"{prefix}{n}"))]
        return F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())

    decision = F.element_at(F.array(*map(F.lit, DECISIONS)), F.col("rank") + 1)
    text = State({}, category).text()
    changed = [F.when(~F.col(f"f_{n}").eqNullSafe(strict_string(f"$.{n}")), F.struct(F.lit(n).alias("key"), F.col(f"f_{n}").alias("value"))) for n in FIELDS]
    fields = F.map_from_entries(F.filter(F.array(*changed), lambda x: x["value"].isNotNull()))
    spoken = F.transform("messages", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"), m["reasoning_content"].alias("reasoning_content"), F.try_parse_json(m["tool_calls"]).alias("tool_calls")))
    changes = F.struct(fields.alias("fields"), F.col("writes"), F.when(F.col("wrote_messages"), F.to_json(spoken)).alias("messages"))
    return df.select(
        "dataset", "source_id", "seq", F.lit(stage).alias("stage"), F.lit(category).alias("category"), decision.alias("decision"), "reasons", "flags",
        packed("b_", BUCKETS).alias("buckets"), packed("m_", METRICS).alias("metrics"), text.alias("text"), "messages", "data", "transitions", "text_sha256", changes.alias("changes"),
    )
