"""Encoding, lexicon and token ledger against the tokenizer itself."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

pytestmark = pytest.mark.skipif(not os.path.exists("/opt/tokenizers/byte_bpe_50k.tiktoken"), reason="no tokenizer files")

TEXTS = [
    None, "", " ", "\n\n", "a", "Hello world, hello  world", "  lead and trail \n", "it's we'll\tdon't", "<|endoftext|> is text", "漢字とかな、テキスト。 空白", "🙂🙃 é́ ​ x",
    "x" * 5000, "def f(x):\n    return x\n\n\n\tend", "a\x1cb \x1d c", "\r\nline\r\n\r\nline  ", "word " * 300, "end with space ", "　full width",
]


@pytest.fixture(scope="module")
def own():
    from siltstone.llm.codec import codec

    return codec()


def ids_of(codec, texts):
    ids, offsets = codec.encode(texts)
    return [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]


def test_codec_is_exact(own):
    expected = [own.bpe.encode_ordinary(t or "") for t in TEXTS]
    assert ids_of(own, TEXTS) == expected
    assert ids_of(own, TEXTS[::-1]) == expected[::-1]  # now all words are known
    assert own.count(TEXTS).tolist() == [len(e) for e in expected]
    own.reset()
    assert [ids_of(own, [t])[0] for t in TEXTS] == expected
    assert ids_of(own, []) == []


def test_codec_forgets(own):
    from siltstone.llm.codec import TOKENIZERS, WordCodec

    small = WordCodec(f"{TOKENIZERS}/byte_bpe_50k.tiktoken", keep=5, short=3)
    for _ in range(3):
        assert ids_of(small, TEXTS) == [own.bpe.encode_ordinary(t or "") for t in TEXTS]


def test_lexicon_round_trip():
    from siltstone.llm.lexicon import Lexicon, compile_lexicon

    rng = np.random.default_rng(3)
    words = {bytes(rng.integers(97, 101, rng.integers(0, 7)).tolist()) for _ in range(400)}
    outputs = {w: [len(w), *w] for w in words}
    lexicon = Lexicon(arrays=compile_lexicon(outputs.items()))
    others = [b"zzz", b"abcdabcdabcd", b"\xff"]
    numbers = lexicon.find([*words, *others])
    assert sorted(numbers[: len(words)].tolist()) == list(range(len(words))) and set(numbers[len(words) :].tolist()) == {-1}
    ids, lengths = lexicon.outputs(numbers[: len(words)])
    cut = np.split(ids, np.cumsum(lengths)[:-1])
    assert [c.tolist() for c in cut] == [outputs[w] for w in words]
    assert len(lexicon.edge_key) < sum(map(len, words))  # prefixes and suffixes are shared
    empty = Lexicon(arrays=compile_lexicon([]))
    assert empty.find([b"a", b""]).tolist() == [-1, -1]


def test_corpus_with_lexicon(spark, own):
    from siltstone.llm import tokens
    from siltstone.llm.lexicon import ARRAYS

    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS * 12)], "doc_id long, text string, ids string")
    lexicon = tokens.build_lexicon(docs, least=2)
    found = {r.doc_id: list(r.ids) for r in tokens.encode_corpus(docs, lexicon=lexicon).collect()}
    assert found == {i: own.bpe.encode_ordinary(t or "") for i, t in enumerate(TEXTS * 12)}
    sent = tokens.Lexicon(lexicon)
    held = tokens.Lexicon(arrays={n: np.array(getattr(sent, n)) for n in ARRAYS} | {"root": np.array([sent.root])})
    assert {r.doc_id: list(r.ids) for r in tokens.encode_corpus(docs, lexicon=held).collect()} == found
    sizes = {r.doc_id: (r.bytes, r.has_ids) for r in tokens.ids_bytes(tokens.encode_corpus(docs)).collect()}
    assert sizes == {i: (len((t or "").encode()), bool(t)) for i, t in enumerate(TEXTS * 12)}
    counts = {r.word: r.n for r in tokens.word_counts(docs).collect()}
    few = tokens.Lexicon(tokens.build_lexicon(docs, least=1, words=len(counts) // 2))
    kept = [w for w, n in zip(counts, few.find([w.encode() for w in counts])) if n >= 0]
    assert len(kept) <= len(counts) // 2 and min(counts[w] for w in kept) > max(counts[w] for w in set(counts) - set(kept)) - 1
    none = docs.limit(0)
    assert tokens.encode_corpus(none, lexicon=tokens.build_lexicon(none)).count() == 0


def test_ledger(spark, own, monkeypatch):
    from siltstone.llm import tokens

    schema = "doc_id long, text string, lang string, profile string, domain string, extra string"
    profiles = spark.createDataFrame([("p", "web"), ("q", "code")], "profile string, source string")
    first = [(1, "one two", "EN", " P ", "Law", "a"), (2, None, None, None, None, "a"), (3, "three", "eng", "q", "law ", "a"), (3, "three", "eng", "q", "law ", "a"), (4, "one two", "en_GB", "zzz", "tbd", "a")]
    ledger = tokens.TokenLedger(spark)
    ledger.update(spark.createDataFrame(first, schema), profiles)
    n = lambda t: len(own.bpe.encode_ordinary(t))
    rows = lambda df: {tuple(r[k] for k in tokens.SLICE): (r.docs, r.tokens) for r in df.collect()}
    assert rows(ledger.cube) == {("web", "en", "law"): (1, n("one two")), ("unknown", "unknown", "unknown"): (1, 0), ("code", "en", "law"): (1, n("three")), ("unknown", "en", "unknown"): (1, n("one two"))}
    second = [(1, "one two", "en", "p", "law", "b"), (3, "three", "en", "p", "law", "b"), (4, "changed text here", "en", "zzz", None, "b"), (5, "one two", "fr-CA", "q", "x", "b")]
    seen = spark.sparkContext.accumulator(0)
    real = tokens.content_counts

    def counted(docs, *a, **k):
        if k.get("count", True):
            seen.add(docs.count())
        return real(docs, *a, **k)

    monkeypatch.setattr(tokens, "content_counts", counted)
    ledger = tokens.TokenLedger(spark, path=ledger.path)  # opened again, as the next run would
    deltas = rows(ledger.update(spark.createDataFrame(second, schema), profiles))
    assert seen.value == 1  # only the changed text
    assert deltas == {("unknown", "unknown", "unknown"): (-1, 0), ("code", "en", "law"): (-1, -n("three")), ("web", "en", "law"): (1, n("three")), ("unknown", "en", "unknown"): (0, n("changed text here") - n("one two")), ("code", "fr", "x"): (1, n("one two"))}
    assert rows(ledger.cube) == {("web", "en", "law"): (2, n("one two") + n("three")), ("unknown", "en", "unknown"): (1, n("changed text here")), ("code", "fr", "x"): (1, n("one two"))}
    assert ledger.counts.where(F.col("n_tokens") == n("one two")).count() >= 1
    contents = ledger.counts.count()
    last = tokens.TokenLedger(spark, path=ledger.path)
    assert rows(last.update(spark.createDataFrame([], schema), profiles)) == {k: (-d, -t) for k, (d, t) in rows(ledger.cube).items()}
    assert last.cube.count() == 0 and last.state.count() == 0 and last.counts.count() == contents
    last.settle()
    assert tokens.TokenLedger(spark, path=ledger.path).head == 3 and last.cube.count() == 0


def test_ledger_of_nothing(spark):
    from siltstone.llm import tokens

    ledger = tokens.TokenLedger(spark)
    none = spark.createDataFrame([], "doc_id long, text string, lang string, profile string, domain string")
    ledger.update(none, spark.createDataFrame([], "profile string, source string"))
    assert ledger.cube.count() == 0
