import numpy as np

from siltstone.llm import quality

COMMON = frozenset("the of and to a in is that it was for on by with le la les de des et un une der die das und in 的 了 在 和 是 que se del".split())
PROSE = "The report was read by the committee in the north, and it is clear that the answer of the team was right. "
SUBJECTS = ["the report", "the team of Morven", "an answer", "the old index", "a committee", "the plan for the city", "one reader", "the sample"]
ACTS = ["was read by", "is older than", "differs from", "was sent to", "depends on", "improves", "counted 12 rows of", "cannot replace"]
ENDS = ["in the north", "after the review", "with a small margin", "on the first day", "and it was clear to all", "by the end of the year"]


def sentences(seed, n, stop=". "):
    rng = np.random.default_rng(seed)
    pick = lambda x: x[int(rng.integers(len(x)))]
    return "".join(f"{pick(SUBJECTS)} {pick(ACTS)} {pick(SUBJECTS)} {pick(ENDS)}, and {pick(SUBJECTS)} {pick(ACTS)} {pick(SUBJECTS)}{stop}".capitalize() for _ in range(n))


def wrap(text, width):
    out, line = [], ""
    for word in text.split():
        if len(line) + 1 + len(word) > width:
            out.append(line)
            line = word
        else:
            line = f"{line} {word}".strip()
    return "\n".join([*out, line])


ENTRIES = {
    "en": "the report of Morven|old index (1327)|sampling plan|the answer of the team|Tanford ledger",
    "de": "der Bericht aus Morven|das alte Register (1327)|Prüfplan|die Antwort aus Tanford|Quelltext",
    "fr": "le rapport de Morven|ancien registre (1327)|l'exemple de Tanford|carnet|la réponse des villes",
    "es": "el informe de Morven|registro antiguo (1327)|la respuesta de Tanford|cuaderno|muestra",
    "zh": "旧的索引|早期的分词器|手写的清单|公开的地图册|答案",
}

def not_prose_of(spark, texts, lang="en"):
    """Numbers of the texts found beside a corpus of prose in several layouts."""
    layouts = (str, str.upper, str.lower, lambda t: wrap(t, 40), lambda t: wrap(t, 72), lambda t: t.replace(". ", ".\n"), lambda t: t.replace(". ", " ").replace(",", ""), lambda t: "> " + wrap(t, 60).replace("\n", "\n> "))
    rows = [(k, t, lang, 1.0) for k, t in enumerate(texts)] + [(10_000 + i, layouts[i % len(layouts)](sentences(i, 4 + i % 30)), lang, 1.0) for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, distance double").repartition(3)
    common = spark.createDataFrame([(w, "en") for w in sorted(COMMON)] + [(None, "en")], "word string, lang string")
    far = quality.measured(docs.drop("distance"), common)
    return {r.doc_id for r in quality.not_prose(far).collect()}, docs, common


def test_outliers_are_what_is_not_prose(spark):
    cells = "\n".join(f"{i}\tname{i}\t{i * 7}.5" for i in range(60))
    wanted = [
        "\n".join(f"- item {'abcdef'[i % 6]} of Morven {i}" for i in range(40)), cells, cells.replace("\t", " | "), cells.replace("\t", ","), cells.replace("\t", " & ").replace("\n", " \\\\\n"),
        "\n".join(f"Chapter {i} ........ {i * 9}" for i in range(40)), "\n".join(f"https://a.example/{i}" for i in range(30)), "\n".join("qW3" * 24 for _ in range(9)), "%{·'s^not [l·\\r:,h<ther ::il%^_r1fi,d^da\\=sl[¤c{rd r<f" * 9,
        "Home » News » Here\n" * 30, " · ".join(["old index", "sampling plan", "Tanford ledger", "notebook (1327)"] * 60), "corpus shard ledger atlas tokenizer archive lemma footnote proof header\n" * 20,
        sentences(1, 4) + "\n" + cells * 3, cells * 3 + "\n" + sentences(2, 4), "7 19 2283 1 90\n" * 40,
    ]
    prose = [PROSE * 5, wrap(sentences(3, 9), 50), sentences(4, 9).upper(), sentences(5, 12, " ").replace(",", ""), "\n\n".join(sentences(k, 2) for k in range(9)), sentences(6, 400), sentences(7, 9).replace(" ", "  "), sentences(8, 40) + "\n" + cells[:300], "", None, " \n\t"]
    found, _, _ = not_prose_of(spark, wanted + prose)
    assert found & set(range(10_000)) == set(range(len(wanted)))
    assert len(found) == len(wanted)


def test_lists_in_every_language(spark):
    rows, wanted = [], set()
    rng = np.random.default_rng(5)
    for at, (language, entries) in enumerate(ENTRIES.items()):
        own = entries.split("|")
        for k in range(60):
            stop = "。" if language == "zh" else ". "
            glue = "" if language == "zh" else " "
            rows.append((1000 * at + k, "".join(glue.join(own[int(x)].split(" (")[0] for x in rng.integers(0, len(own), 4)) + ("，" if language == "zh" else " de la ") + own[0] + stop for _ in range(20)), language))
        rows.append((1000 * at + 500, "\n".join(f"{k}) {own[k % len(own)]}" for k in range(60)), language))
        wanted.add(1000 * at + 500)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    common = spark.createDataFrame([(w, "en") for w in sorted(COMMON)], "word string, lang string")
    assert {r.doc_id for r in quality.not_prose(quality.measured(docs, common)).collect()} == wanted


def test_quality_query(spark):
    cells = "\n".join(f"{i}\tname{i}\t{i * 7}.5" for i in range(60))
    texts = [cells, None, "", "word", PROSE * 3000, "\x00\u200b " * 40]
    found, docs, common = not_prose_of(spark, texts)
    out = {r.doc_id: r for r in quality.quality(docs, common).collect()}
    assert len(out) == docs.count() and found & {0, 1, 2, 4, 5} == {0}
    for r in out.values():
        assert abs(sum(r[f"{n}_part"] for n in quality.NAMES) - r.distance) <= 1e-6 * max(1, abs(r.distance)) and np.isfinite(r.distance)
    assert out[0].distance > 10 * out[4].distance and out[0].outlying == 1.0
    assert out[1].words == 0 and out[4].words == 22 * 3000 and 0.9 < out[4].mean_word_length / (sum(map(len, PROSE.replace(",", "").replace(".", "").split())) / 22) < 1.1
    assert quality.quality(docs.limit(0), common).count() == 0


def test_counts_of_a_passage():
    chinese, counts = quality.passage_counts(["1. The Old ledger, Morven", "is read. Is it?"], COMMON)
    assert not chinese and dict(zip(quality.COUNTS, counts)) == {"visible": 33, "words": 8, "letters": 28, "digits": 1, "common": 4, "distinct": 7, "kinds": 3, "stops": 2, "commas": 1, "lines": 2, "punctuated": 1, "tokens": 9}
    assert quality.passage_counts(["旧的索引，在北方。"], COMMON)[0]
    long = sentences(9, 300)
    assert "".join("".join(p) for p in quality.passages(long)).replace(" ", "") == long.replace(" ", "")
    assert quality.passages(" \n\n") == [] and abs(quality.quantile(0.99, 10) - 23.209) < 0.05


def test_models_have_no_size_at_which_they_change_in_kind(spark):
    seed = np.random.default_rng(7)
    n = len(quality.COUNTS)
    base = np.array([200, 40, 160, 10, 15, 30, 8, 2, 3, 4, 2, 40]) + seed.integers(0, 6, (4_000, n))
    base[:, 8] = base[:, 7] * 2  # two statistics that go together
    rows = [("few" if i < 12 else "some" if i < 150 else "many", bytearray(x.astype(np.float32).tobytes())) for i, x in enumerate(base)]
    stats = spark.createDataFrame(rows, "language string, counts binary")
    at = [quality.NAMES.index(x) for x in ("sentence_stops", "commas")]
    covariance = {k: np.linalg.inv(inverse) for k, (_, inverse) in quality.prose_models(stats).items()}
    shared = [covariance[k][at[0], at[1]] for k in ("few", "some", "many")]
    assert 0 < shared[0] < shared[1] < shared[2] * 1.2
    start = quality.starts(stats)
    assert set(start) == {"", "few", "some", "many"}
    x = quality.statistics(base[150:])
    assert np.allclose(start["many"][0], np.median(x, 0), atol=0.011) and np.allclose(start["many"][1], np.median(abs(x - np.median(x, 0)), 0), atol=0.021)
