"""Registered queries of this subpackage, over whole tables and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import forms, mixing, neardup, packing, quality, tokens
from siltstone.session import spread, staged

#: Rows of the capacity table that are held on the driver at most.
MOST_CAPACITIES = 1_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose texts Python works on; a small one is dealt out to all cores."""
    return spread(table(spark, sf_dir, name))


def _mix(spark: SparkSession, sf_dir: str) -> mixing.Mix:
    return mixing.mix(*(table(spark, sf_dir, t) for t in ("mix_candidates", "dataset_profiles", "mix_plans", "mix_targets")))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources that a mix cannot fill."""
    return mixing.unfilled(_mix(spark, sf_dir).report)


def p1_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wanted and actual tokens and shares of each source of each mix."""
    return _mix(spark, sf_dir).report


def p1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of each mix and how often each is used."""
    return _mix(spark, sf_dir).chosen


def p2_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and tokens by source, language and domain, over all documents."""
    ledger = tokens.TokenLedger(spark)
    ledger.update(texts(spark, sf_dir, "documents"), table(spark, sf_dir, "dataset_profiles"))
    return ledger.cube


def p2_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tokens of each document and the slice it counts for."""
    ledger = tokens.TokenLedger(spark)
    ledger.update(texts(spark, sf_dir, "documents"), table(spark, sf_dir, "dataset_profiles"))
    return ledger.state.select("doc_id", "source", "lang", "domain", "n_tokens")


def _two_days(spark: SparkSession, sf_dir: str) -> tuple[tokens.TokenLedger, DataFrame]:
    """A ledger of punctual documents, opened again and brought to the corpus of all documents that have a feed; the deltas of the second update."""
    docs, profiles = texts(spark, sf_dir, "documents"), table(spark, sf_dir, "dataset_profiles")
    first = tokens.TokenLedger(spark)
    first.update(docs.where("ingested_at <= collected_at + interval 1 day"), profiles)
    again = tokens.TokenLedger(spark, path=first.path)
    deltas = again.update(docs.where("source is not null"), profiles)
    return again, deltas


def p2_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signed deltas of the second day: late rows come in, documents without a feed are withdrawn, no text is encoded twice."""
    return _two_days(spark, sf_dir)[1]


def p2_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cube after both days against the state it must agree with: documents of each slice, and tokens the two differ by."""
    ledger, _ = _two_days(spark, sf_dir)
    state = ledger.state.groupBy(*tokens.SLICE).agg(F.count("*").alias("_docs"), F.sum("n_tokens").alias("_tokens"))
    both = ledger.cube.join(state, list(tokens.SLICE), "full")
    return both.select(*tokens.SLICE, "docs", (F.col("docs") - F.col("_docs")).alias("docs_apart"), (F.col("tokens") - F.col("_tokens")).alias("tokens_apart"))


def p5_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each document the bytes that its ids stand for, which are those of its text, and whether it has any ids."""
    docs = texts(spark, sf_dir, "documents")
    return tokens.ids_bytes(tokens.encode_corpus(docs, lexicon=tokens.build_lexicon(docs)))


def _near(spark: SparkSession, sf_dir: str) -> neardup.NearDuplicates:
    return neardup.near_duplicates(texts(spark, sf_dir, "samples"), width=3, threshold=0.6, least_words=20)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of samples with nearly the same text."""
    return _near(spark, sf_dir).pairs()


def p3_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of each sample of enough words, with its copies and links."""
    return _near(spark, sf_dir).groups()


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that repeat an earlier one in another form."""
    return forms.form_groups(texts(spark, sf_dir, "raw_records"))[1]


def p4_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each different record once, by its smallest id, with the number of its copies."""
    return forms.form_groups(texts(spark, sf_dir, "raw_records"))[0]


def p5_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document by byte_bpe_50k."""
    docs = texts(spark, sf_dir, "documents")
    return tokens.encode_corpus(docs, lexicon=tokens.build_lexicon(docs))


def capacities(spark: SparkSession, sf_dir: str) -> dict[str, int]:
    rows = table(spark, sf_dir, "pack_capacities").select("bucket", "sequence_length").where("sequence_length > 0").distinct().limit(MOST_CAPACITIES + 1).collect()
    if len(rows) > MOST_CAPACITIES:
        raise ValueError(f"more than {MOST_CAPACITIES} capacities")
    return {r.bucket: r.sequence_length for r in rows}


def _packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = staged(tokens.content_counts(texts(spark, sf_dir, "documents")).select("doc_id", "n_tokens"), "sizes")
    return packing.pack(sizes, capacities(spark, sf_dir))


def p6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's sequence for each capacity."""
    return _packed(spark, sf_dir)


def p6_unused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences and unused space of each capacity."""
    return packing.packing_report(staged(_packed(spark, sf_dir), "packed"), capacities(spark, sf_dir))


def p6_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences and unused space of each capacity and class."""
    return packing.packing_report(staged(_packed(spark, sf_dir), "packed"), capacities(spark, sf_dir), by_class=True)


def p6_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each capacity the documents placed, and what must not occur: overfull sequences, needless splits, lost tokens."""
    sizes = staged(tokens.content_counts(texts(spark, sf_dir, "documents")).select("doc_id", "n_tokens"), "sizes")
    room = capacities(spark, sf_dir)
    return packing.packing_faults(staged(packing.pack(sizes, room), "packed"), sizes, room)


def p7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text statistics of every document, its distance from prose, and what each statistic adds."""
    return quality.quality(texts(spark, sf_dir, "documents"), table(spark, sf_dir, "common_words"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of 200 characters or more and without a path that are not natural prose."""
    docs = texts(spark, sf_dir, "documents").withColumn("_asked", F.expr("path is null and length(text) >= 200"))
    far = quality.measured(docs, table(spark, sf_dir, "common_words"), keep=("_asked",))
    return quality.not_prose(far.where("_asked")).distinct()


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p1_shares": p1_shares,
    "p1_mix": p1_mix,
    "p2_budget": p2_budget,
    "p2_tokens": p2_tokens,
    "p2_delta": p2_delta,
    "p2_ledger": p2_ledger,
    "p3_found": p3_found,
    "p3_groups": p3_groups,
    "p4_found": p4_found,
    "p4_records": p4_records,
    "p5_ids": p5_ids,
    "p5_bytes": p5_bytes,
    "p6_pack": p6_pack,
    "p6_unused": p6_unused,
    "p6_classes": p6_classes,
    "p6_faults": p6_faults,
    "p7_found": p7_found,
    "p7_quality": p7_quality,
}

_MIX_SQL = """
WITH first_seen AS (
  SELECT candidate_id, n_tokens, lower(trim(profile)) AS profile,
         row_number() OVER (PARTITION BY candidate_id ORDER BY counted_at) AS delivery
  FROM mix_candidates),
usable AS (
  SELECT candidate_id, lower(trim(p.source)) AS source, n_tokens
  FROM first_seen f JOIN dataset_profiles p ON f.profile = lower(trim(p.profile))
  WHERE delivery = 1 AND n_tokens > 0),
sizes AS (SELECT source, sum(n_tokens) AS available FROM usable GROUP BY source),
targets AS (
  SELECT mix_id, lower(trim(source)) AS source, max(CAST(weight AS DECIMAL(28,12))) AS weight, max(max_epochs) AS max_epochs
  FROM mix_targets WHERE weight > 0 GROUP BY 1, 2),
shares AS (
  SELECT t.*, CAST(weight AS DOUBLE) / CAST(sum(weight) OVER (PARTITION BY mix_id) AS DOUBLE) AS share FROM targets t),
wants AS (
  SELECT s.mix_id, s.source, s.share, s.max_epochs, coalesce(z.available, 0) AS available,
         s.share * p.size_factor * CAST((SELECT sum(n_tokens) FROM usable) AS DOUBLE) AS wanted,
         CAST(('0x' || substr(md5('0|' || s.mix_id || '|' || s.source), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE AS shift
  FROM shares s JOIN mix_plans p ON s.mix_id = p.mix_id LEFT JOIN sizes z ON s.source = z.source),
plan AS (
  SELECT *, CASE WHEN wanted >= max_epochs * available THEN CAST(max_epochs AS DOUBLE) ELSE wanted / available END AS rate FROM wants),
places AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY length(bin(n_tokens)), md5(CAST(candidate_id AS VARCHAR))) AS place FROM usable),
chosen AS (
  SELECT mix_id, source, candidate_id, CAST(floor(place * rate + shift) - floor((place - 1) * rate + shift) AS BIGINT) AS copies, n_tokens
  FROM places JOIN (SELECT mix_id, source, rate, shift FROM plan WHERE rate > 0) USING (source)
  WHERE floor(place * rate + shift) > floor((place - 1) * rate + shift)),
got AS (
  SELECT mix_id, source, sum(copies) AS emitted, count(*) AS used, sum(copies * n_tokens) AS tokens FROM chosen GROUP BY 1, 2)
"""

#: Texts in NFC, since SQL has no NFKC: the two give the same words on these tables.
_WORDS_SQL = r"""
WITH RECURSIVE s AS (SELECT sample_id, min(text) AS text FROM samples WHERE text IS NOT NULL AND sample_id IS NOT NULL GROUP BY 1),
w AS (SELECT sample_id, regexp_extract_all(regexp_replace(lower(nfc_normalize(text)), '(\p{Han})', ' \1 ', 'g'), '[\p{L}\p{N}]+') AS w FROM s),
g AS (SELECT sample_id, w, list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS g FROM w WHERE len(w) >= 20),
e AS (SELECT sample_id, len(g) AS n, hash(unnest(g)) AS h FROM g),
c AS (SELECT a.sample_id AS sample_id_a, b.sample_id AS sample_id_b, a.n AS x, b.n AS y, count(*) AS c FROM e a JOIN e b ON a.h = b.h AND a.sample_id < b.sample_id GROUP BY ALL),
pairs AS (SELECT sample_id_a, sample_id_b FROM c WHERE c >= 0.6 * (x + y - c))
"""
_BLANK = "('', 'none', 'null', 'tbd', 'und', 'unknown', 'n/a')"
_SLICES_SQL = f"""
WITH names AS (SELECT DISTINCT lower(trim(profile)) AS profile, CASE WHEN lower(trim(source)) IN {_BLANK} THEN 'unknown' ELSE lower(trim(source)) END AS source FROM dataset_profiles),
spelled AS (SELECT *, split_part(replace(lower(trim(lang)), '_', '-'), '-', 1) AS base FROM documents),
sliced AS (
  SELECT d.*, coalesce(n.source, 'unknown') AS slice_source,
         CASE {" ".join(f"WHEN base = '{a}' THEN '{b}'" for a, b in tokens.LANGUAGES.items())} WHEN base IS NULL THEN 'unknown' ELSE base END AS slice_lang,
         CASE WHEN domain IS NULL OR lower(trim(domain)) IN {_BLANK} THEN 'unknown' ELSE lower(trim(domain)) END AS slice_domain
  FROM spelled d LEFT JOIN names n ON n.profile = lower(trim(d.profile)))
"""

ORACLES: dict[str, str] = {
    "p1_found": _MIX_SQL + "SELECT mix_id, source FROM plan WHERE wanted > max_epochs * available",
    "p1_shares": _MIX_SQL
    + """
SELECT mix_id, source, share, wanted, CAST(available AS BIGINT) AS available, max_epochs,
       CAST(coalesce(emitted, 0) AS BIGINT) AS emitted, coalesce(used, 0) AS used, CAST(coalesce(tokens, 0) AS BIGINT) AS tokens,
       coalesce(tokens, 0)::DOUBLE / CAST(sum(coalesce(tokens, 0)) OVER (PARTITION BY mix_id) AS DOUBLE) AS actual_share
FROM plan LEFT JOIN got USING (mix_id, source)""",
    "p1_mix": _MIX_SQL + "SELECT mix_id, source, candidate_id, copies, n_tokens FROM chosen",
    "p6_faults": """
SELECT DISTINCT bucket, (SELECT count(DISTINCT doc_id) FROM documents) AS documents, CAST(0 AS BIGINT) AS overfull, CAST(0 AS BIGINT) AS split, CAST(0 AS BIGINT) AS lost
FROM pack_capacities WHERE sequence_length > 0""",
    "p2_ledger": _SLICES_SQL
    + """
SELECT slice_source AS source, slice_lang AS lang, slice_domain AS domain, count(*) AS docs, CAST(0 AS BIGINT) AS docs_apart, CAST(0 AS BIGINT) AS tokens_apart
FROM sliced WHERE source IS NOT NULL GROUP BY 1, 2, 3""",
    "p5_bytes": "SELECT doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS bytes, coalesce(text, '') <> '' AS has_ids FROM documents",
    "p3_found": _WORDS_SQL + "SELECT sample_id_a, sample_id_b FROM pairs",
    "p3_groups": _WORDS_SQL
    + """,
k AS (SELECT sample_id, min(sample_id) OVER (PARTITION BY w) AS class, count(*) OVER (PARTITION BY w) AS copies FROM g),
d AS (SELECT DISTINCT a.class AS a, b.class AS b FROM (SELECT sample_id_a AS x, sample_id_b AS y FROM pairs UNION ALL SELECT sample_id_b, sample_id_a FROM pairs) JOIN k a ON a.sample_id = x JOIN k b ON b.sample_id = y WHERE a.class <> b.class),
r AS (SELECT DISTINCT class AS a, class AS b FROM k UNION SELECT r.a, d.b FROM r JOIN d ON r.b = d.a),
m AS (SELECT a, min(b) AS group_id FROM r GROUP BY 1), l AS (SELECT a, count(*) AS links FROM d GROUP BY 1)
SELECT sample_id, group_id, copies, coalesce(links, 0) AS links FROM k JOIN m ON m.a = class LEFT JOIN l ON l.a = class""",
}
