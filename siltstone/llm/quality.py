"""Text statistics per document, and their robust distance from the prose of its language."""

from __future__ import annotations

import re
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.llm.tokens import one_language
from siltstone.session import staged

#: The statistics of a passage, and the least spread each is given in the distance. Ratios enter by their roots, lengths by their logarithms.
STATISTICS = {
    "word_length": 0.1,
    "symbols": 0.08,
    "digits": 0.12,
    "common_words": 0.03,
    "sentence_stops": 0.25,
    "distinct_words": 0.05,
    "token_length": 0.3,
    "commas": 0.15,
    "punctuated_lines": 0.4,
    "common_kinds": 0.1,
}
NAMES = list(STATISTICS)
D = len(NAMES)
#: What is counted in each passage; sums of these over a document are its counts.
COUNTS = ("visible", "words", "letters", "digits", "common", "distinct", "kinds", "stops", "commas", "lines", "punctuated", "tokens")
#: Characters of a passage, about.
PASSAGE = 400
#: Words of the table of common words that are held at most.
MOST_COMMON = 100_000
#: Rounds of re-estimation; the chi-square quantiles up to which a passage counts as prose in them, and beyond which it is an outlier.
ROUNDS, CORE, FAR = 4, 0.975, 0.998
#: Standard deviations of a normal distribution in its median absolute deviation; the width of a bin of the statistics, and the bins.
NORMAL, BIN, BINS = 1.4826, 0.01, 2_000

#: Characters that end a line, characters that aren't seen, East Asian characters, marker strings and wrongly decoded pairs.
LINE_END = re.compile("\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]")
_INVISIBLE = re.compile("[\\s\x00-\x1f\x7f-\x9f­​-‏‪-‮⁠-⁤﻿]+")
_CJK = re.compile("[㐀-䶿一-鿿぀-ヿ가-힯]")
_MARKER = re.compile(r"<\|[^|<>]{1,30}\|>|</?[a-zA-Z]{1,12}>|\[[A-Z]{3,5}\]")
_DOUBLE = re.compile("[\xc2-\xf4][\x80-\xbf]|[\xc3\xc2\xe2][\u0080-\u2122]")

_WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")
_DIGITS = re.compile(r"\d+")
#: A sentence stop follows a word, so that dots of numbered entries and leaders are none.
_STOP = re.compile(r"[.!?…](?:(?<=[^\W_]{2}.)|(?<=[^\W_][\"'”’»)\]*_].))[.!?…]*[\"'”’»)\]*_]{0,3}(?=\s|$)|[。！？]")
_LINE_STOP = re.compile("[.!?。！？…]")
_COMMAS = ",;:，；：、"
_PIECES = re.compile(rf".{{1,{PASSAGE}}}(?!\S)|.{{1,{PASSAGE}}}", re.S)
_ASCII_HIDDEN = bytes([*range(33), 127])


def mended(text: str) -> str:
    """The text without literal marker strings; where it was decoded wrongly all over, decoded again."""
    text = _MARKER.sub("", text)
    if not text.isascii() and len(_DOUBLE.findall(text)) * 6 > len(text):
        again = text.encode("cp1252", "ignore").decode("utf-8", "ignore") if not re.search("[\x80-\x9f]", text) else text.encode("latin-1", "ignore").decode("utf-8", "ignore")
        if len(again) * 5 > len(text):
            return again
    return text


def shown(text: str) -> str:
    """The text without blanks, control and invisible characters."""
    return text.encode().translate(None, _ASCII_HIDDEN).decode() if text.isascii() else _INVISIBLE.sub("", text)


def passages(text: str) -> list[list[str]]:
    """Runs of lines of about PASSAGE characters that end with paragraphs where they can; longer lines are divided at blanks."""
    out: list[list[str]] = []
    run: list[str] = []
    size = 0
    for line in LINE_END.split(mended(text)):
        if not line.strip():
            if size >= PASSAGE // 2:
                out.append(run)
                run, size = [], 0
            continue
        for part in _PIECES.findall(line) if len(line) > 2 * PASSAGE else (line,):
            run.append(part)
            size += len(part)
            if size >= PASSAGE:
                out.append(run)
                run, size = [], 0
    if run and out and size < PASSAGE // 3:
        out[-1] = out[-1] + run
    elif run:
        out.append(run)
    return out


def passage_counts(lines: list[str], common: frozenset[str]) -> tuple[bool, list[int]]:
    """Whether a passage is Chinese, and COUNTS of it."""
    text = "\n".join(lines)
    seen = shown(text)
    words = _WORD.findall(text)
    cjk = [] if seen.isascii() else _CJK.findall(seen)
    if chinese := len(cjk) * 4 > len(seen):
        words = cjk
    lower = list(map(str.lower, words))
    kinds = set(lower)
    return chinese, [
        len(seen),
        len(words),
        len("".join(words)),
        len(seen) - len(_DIGITS.sub("", seen)),
        sum(map(common.__contains__, lower)),
        len(kinds),
        sum(map(common.__contains__, kinds)),
        len(_STOP.findall(text)),
        sum(map(text.count, _COMMAS)),
        len(lines),
        sum(1 for x in lines if _LINE_STOP.search(x.rstrip()[-4:])),
        len(text.split()),
    ]


def statistics(counts: np.ndarray) -> np.ndarray:
    """The statistics of passages, in the order of NAMES, from their counts."""
    visible, words, letters, digits, common, distinct, kinds, stops, commas, lines, punctuated, tokens = np.asarray(counts, float).reshape(-1, len(COUNTS)).T
    size, n = np.maximum(visible, 1), np.maximum(words, 1)
    return np.stack(
        [
            np.log((letters + 1) / n),
            np.sqrt(np.maximum(0, size - letters - digits) / size),
            np.sqrt(digits / size),
            np.sqrt(common / n),
            np.sqrt(100 * stops / size),
            np.log(distinct + 1) / np.log(n + 2),
            np.log(size / np.maximum(1, tokens)),
            np.sqrt(commas / n),
            punctuated / np.maximum(1, lines),
            kinds / np.sqrt(n),
        ],
        axis=1,
    )


def text_statistics(docs: DataFrame, common: frozenset[str], key: str = "doc_id", text: str = "text", lang: str = "lang", keep: tuple[str, ...] = ()) -> DataFrame:
    """``(key, *keep, language, counts binary)`` of every row: COUNTS of each passage in a row; null and empty texts have none.

    Texts are read whole. ``language`` is the label under one spelling where it is a
    code of two or three letters, else ``other``; a text that is mostly Chinese characters is ``zh``
    and one with none is not, whatever its label says.
    """

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, languages = [], []
            for value, language in zip(batch.column("_text").to_pylist(), batch.column("_lang").to_pylist()):
                found = [passage_counts(x, common) for x in passages(value)] if value else []
                cells.append(np.array([c for _, c in found], np.float32).tobytes())
                chinese = sum(c[0] for z, c in found if z) * 2 > sum(c[0] for _, c in found)
                languages.append("zh" if chinese else language if language != "zh" else "other")
            yield pa.record_batch([*batch.columns[:-2], pa.array(languages, pa.string()), pa.array(cells, pa.binary())], [key, *keep, "language", "counts"])

    label = one_language(F.col(lang))
    rows = docs.select(key, *keep, F.col(text).alias("_text"), F.when(label.rlike("^[a-z]{2,3}$"), label).otherwise("other").alias("_lang"))
    fields = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in (key, *keep))
    return rows.mapInArrow(measure, f"{fields}language string, counts binary")


def quantile(p: float, k: int = D) -> float:
    """Chi-square quantile of k degrees of freedom, by the cube root of a normal variable."""
    return k * (1 - 2 / (9 * k) + NormalDist().inv_cdf(p) * (2 / (9 * k)) ** 0.5) ** 3


Models = dict[str, tuple[np.ndarray, np.ndarray]]


def squares(x: np.ndarray, model: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """What each statistic adds to the squared distance."""
    mean, inverse = model
    off = x - mean
    return off * (off @ inverse)


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray]]:
    languages = np.array(batch.column("language").to_pylist(), object)
    cells = batch.column("counts").to_pylist()
    for name in sorted(set(languages)):
        if data := b"".join(cells[k] for k in np.flatnonzero(languages == name)):
            yield name, statistics(np.frombuffer(data, np.float32))


def _middles(bins: DataFrame) -> DataFrame:
    """``(language, i, middle)``: the median bin of ``(language, i, bin, n)``."""
    one = Window.partitionBy("language", "i")
    upto = bins.select("language", "i", "bin", F.sum("n").over(one.orderBy("bin")).alias("c"), F.sum("n").over(one).alias("t"))
    return upto.where("2 * c >= t").groupBy("language", "i").agg(F.min("bin").alias("middle"))


def starts(stats: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Median and absolute deviation of each statistic of each language's passages, and of all passages under the empty name."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, x in _by_language(batch):
                at = np.clip((x / BIN).astype(np.int64), 0, BINS - 1) + np.arange(D) * BINS
                held[name] = held.get(name, 0) + np.bincount(at.ravel(), minlength=D * BINS)
        for name, n in held.items():
            some = np.flatnonzero(n)
            yield pa.record_batch([pa.array([name] * len(some)), pa.array((some // BINS).astype(np.int32)), pa.array((some % BINS).astype(np.int32)), pa.array(n[some])], ["language", "i", "bin", "n"])

    bins = stats.select("language", "counts").mapInArrow(count, "language string, i int, bin int, n long").groupBy("language", "i", "bin").agg(F.sum("n").alias("n"))
    bins = staged(bins, "bins")
    bins = bins.unionByName(bins.groupBy("i", "bin").agg(F.sum("n").alias("n")).withColumn("language", F.lit("")))
    middle = _middles(bins)
    away = bins.join(middle, ["language", "i"]).groupBy("language", "i", F.abs(F.col("bin") - F.col("middle")).alias("bin")).agg(F.sum("n").alias("n"))
    out: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for r in middle.join(_middles(away).withColumnRenamed("middle", "away"), ["language", "i"]).collect():
        m, s = out.setdefault(r.language, (np.zeros(D), np.zeros(D)))
        m[r.i], s[r.i] = (r.middle + 0.5) * BIN, r.away * BIN
    return out


def prose_models(stats: DataFrame, rounds: int = ROUNDS) -> Models:
    """Mean and inverse covariance of the prose passages of each language, over all documents.

    Medians and absolute deviations of all passages give a first distance; then mean
    and covariance are taken over the passages within the chi-square quantile ``CORE``,
    again and again (concentration steps). In each step the start counts as much as
    ``D`` passages do, and in a language's start those of all languages together
    count as much again: few passages stay near it and many leave it, without a size
    at which that changes. What reaches the driver are the moments of at most as many
    languages as there are codes of two or three letters. Each statistic keeps a least spread.
    """
    floor = np.diag(np.array(list(STATISTICS.values())) ** 2)
    first = starts(stats)
    if not first:
        return {}
    pooled = first.pop("")
    models: Models = {k: (m, np.linalg.inv(np.diag((NORMAL * s) ** 2) + floor)) for k, (m, s) in first.items()}
    most = quantile(CORE)

    def moments(batches: Iterator[pa.RecordBatch], models: Models) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, x in _by_language(batch):
                own = x[squares(x, models[name]).sum(1) <= most]
                one = np.concatenate([np.ones((len(own), 1)), own], axis=1)
                held[name] = held.get(name, 0) + (one.T @ one).ravel()
        for name, m in held.items():
            yield pa.record_batch([pa.array([name] * len(m)), pa.array(np.arange(len(m)), pa.int32()), pa.array(m)], ["language", "i", "m"])

    for _ in range(rounds):
        held = models
        sums: dict[str, np.ndarray] = {}
        found = stats.select("language", "counts").mapInArrow(lambda it: moments(it, held), "language string, i int, m double")
        for r in found.groupBy("language", "i").agg(F.sum("m").alias("m")).where("m <> 0").collect():
            sums.setdefault(r.language, np.zeros((D + 1) ** 2))[r.i] = r.m
        models = {}
        for name, (centre, spread) in first.items():
            m = sums.get(name, np.zeros((D + 1) ** 2)).reshape(D + 1, D + 1)
            n = m[0, 0]
            own, second = (m[0, 1:] / n, m[1:, 1:] / n) if n else (centre, np.outer(centre, centre))
            model = own, second - np.outer(own, own) + floor
            for weight, (other, wide) in ((n / (n + D), (centre, spread)), ((n + D) / (n + 2 * D), pooled)):
                off = model[0] - other
                model = weight * model[0] + (1 - weight) * other, weight * model[1] + (1 - weight) * (np.diag((NORMAL * wide) ** 2) + floor) + weight * (1 - weight) * np.outer(off, off)
            models[name] = model[0], np.linalg.inv(model[1])
    return models


def distances(stats: DataFrame, models: Models) -> DataFrame:
    """``stats`` with what the passages add up to.

    ``totals`` are the sums of COUNTS; ``distance`` is the mean squared Mahalanobis distance of
    the visible characters' passages from the prose of the language, ``parts`` what each
    statistic adds to it, and ``outlying`` the share of visible characters in passages
    beyond the chi-square quantile ``FAR``. Rows without a passage have zeros.
    """
    least = quantile(FAR)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [np.frombuffer(x, np.float32).reshape(-1, len(COUNTS)) for x in batch.column("counts").to_pylist()]
            row = np.repeat(np.arange(len(cells)), list(map(len, cells)))
            counts = np.concatenate([*cells, np.empty((0, len(COUNTS)), np.float32)]).astype(float)
            languages = np.array(batch.column("language").to_pylist(), object)[row]
            x = statistics(counts)
            far = np.zeros_like(x)
            for name in set(languages):
                own = np.flatnonzero(languages == name)
                far[own] = squares(x[own], models[name])
            whole = np.bincount(row, counts[:, 0], len(cells))

            def mean(values: np.ndarray) -> np.ndarray:
                return np.bincount(row, values * counts[:, 0], len(cells)) / np.maximum(whole, 1)

            added = np.stack([mean(far[:, i]) for i in range(D)], axis=1)
            totals = np.stack([np.bincount(row, counts[:, i], len(cells)) for i in range(len(COUNTS))], axis=1)
            outlying = mean((far.sum(1) > least).astype(float))
            lists = [pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1) * v.shape[1], pa.int32()), pa.array(v.ravel())) for v in (totals, added)]
            keep = [k for k, n in enumerate(batch.schema.names) if n != "counts"]
            yield pa.record_batch([*[batch.column(k) for k in keep], lists[0], pa.array(added.sum(1)), lists[1], pa.array(outlying)], [*[batch.schema.names[k] for k in keep], "totals", "distance", "parts", "outlying"])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in stats.schema if f.name != "counts")
    return stats.mapInArrow(measure, f"{fields}totals array<double>, distance double, parts array<double>, outlying double")


def common_set(common_words: DataFrame) -> frozenset[str]:
    """The words of the table of common words, held whole."""
    listed = common_words.select(F.lower("word").alias("word")).where("word is not null").distinct().limit(MOST_COMMON + 1).collect()
    if len(listed) > MOST_COMMON:
        raise ValueError(f"more than {MOST_COMMON} common words")
    return frozenset(r.word for r in listed)


def measured(docs: DataFrame, common_words: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", keep: tuple[str, ...] = ()) -> DataFrame:
    """``distances`` of every document from models of all documents."""
    stats = staged(text_statistics(docs, common_set(common_words), key, text, lang, keep), "statistics")
    return distances(stats, prose_models(stats))


def quality(docs: DataFrame, common_words: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Each document's statistics, its distance from prose, and what each statistic adds to it.

    ``(key, language, words, mean_word_length, symbol_ratio, digit_ratio, common_words,
    punctuated_lines, stops_per_100, distance, outlying, <statistic>_part, ...)``. Ratios of nothing are 0.
    """
    n = {c: F.col("totals")[i] for i, c in enumerate(COUNTS)}

    def share(part: Column, whole: str) -> Column:
        return F.coalesce(F.try_divide(part, n[whole]), F.lit(0.0))

    figures = [
        n["words"].cast("long").alias("words"),
        share(n["letters"], "words").alias("mean_word_length"),
        share(n["visible"] - n["letters"] - n["digits"], "visible").alias("symbol_ratio"),
        share(n["digits"], "visible").alias("digit_ratio"),
        share(n["common"], "words").alias("common_words"),
        share(n["punctuated"], "lines").alias("punctuated_lines"),
        share(100 * n["stops"], "visible").alias("stops_per_100"),
    ]
    return measured(docs, common_words, key, text, lang).select(key, "language", *figures, "distance", "outlying", *[F.col("parts")[i].alias(f"{c}_part") for i, c in enumerate(NAMES)])


def not_prose(measured: DataFrame, key: str = "doc_id") -> DataFrame:
    """Keys of rows with more than half of their visible characters in passages that are outliers to the prose of their language."""
    return measured.where(F.col("outlying") > 0.5).select(key)
