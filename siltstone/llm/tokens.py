"""Encoding of the whole corpus, and token counts by slice kept up to date by deltas."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.codec import TOKENIZERS, codec
from siltstone.llm.lexicon import Lexicon, compile_lexicon, save_lexicon
from siltstone.session import is_mounted, local_path, scratch_path, staged

#: Bounds of the word lexicon: most words, most characters of a word, least occurrences.
LEXICON_WORDS, LEXICON_CHARS, LEXICON_LEAST = 60_000, 24, 8
#: Texts of a batch together have about this many characters.
BATCH_CHARS = 1_500_000


def text_runs(texts: list[str | None], most: int = BATCH_CHARS) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts with about ``most`` characters each."""
    begin, held = 0, 0
    for k, text in enumerate(texts):
        held += len(text) if text else 0
        if held >= most:
            yield begin, k + 1
            begin, held = k + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def word_counts(docs: DataFrame, text: str = "text", tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """``(word, n)``: how often each white-space-led word of up to LEXICON_CHARS characters occurs in all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = codec(tokenizer, folder).cut
        held: tuple[Counter, Counter] = Counter(), Counter()

        def out() -> pa.RecordBatch:
            rows = [(w, n) for w, n in held[0].items() if len(w) <= LEXICON_CHARS] + [(f" {w}", n) for w, n in held[1].items() if len(w) < LEXICON_CHARS]
            for x in held:
                x.clear()
            return pa.record_batch([pa.array([w for w, _ in rows], pa.string()), pa.array([n for _, n in rows], pa.int64())], ["word", "n"])

        for batch in batches:
            for value in batch.column(0).to_pylist():
                if value:
                    for counter, words in zip(held, cut(value)):
                        counter.update(words)
            if len(held[0]) + len(held[1]) > 400_000:
                yield out()
        yield out()

    return docs.select(text).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(docs: DataFrame, text: str = "text", tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS, words: int = LEXICON_WORDS, least: int = LEXICON_LEAST) -> str | Lexicon:
    """Compiles the most frequent words of all texts into an automaton; its place in the shared folder, or itself where that folder isn't mounted.

    How frequent a word must be follows from a histogram of the counts by steps of
    a 32nd of a doubling, so that only the words to keep, at most ``words``, reach the driver.
    """
    counts = staged(word_counts(docs, text, tokenizer, folder).where(F.col("n") >= least), "words")
    step = F.floor(F.log2("n") * 32).cast("int")
    steps = counts.groupBy(step.alias("step")).agg(F.count("*").alias("words")).orderBy(F.desc("step")).collect()
    lowest, held = None, 0
    for r in steps:
        if (held := held + r.words) > words:
            break
        lowest = r.step
    kept = [] if lowest is None else [r.word for r in counts.where(step >= lowest).select("word").collect()]
    own = codec(tokenizer, folder)
    lexicon = compile_lexicon((w.encode(), own.bpe.encode_ordinary(w)) for w in kept)
    path = scratch_path(docs.sparkSession, "lexicon")
    return save_lexicon(lexicon, local_path(path)) if is_mounted(path) else Lexicon(arrays=lexicon)


def encode_corpus(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS, lexicon: str | Lexicon | None = None) -> DataFrame:
    """``(key, ids array<int>)`` of each row of ``docs``, without special tokens.

    Null and empty texts give an empty array; literal marker strings are ordinary
    text; texts of any length are encoded whole. Other columns are not read. A lexicon
    that isn't mounted is broadcast; it has at most LEXICON_WORDS words of LEXICON_CHARS.
    """
    sent = docs.sparkSession.sparkContext.broadcast(lexicon) if isinstance(lexicon, Lexicon) else None
    place = None if sent else lexicon

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(tokenizer, folder, sent.value if sent else place)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in text_runs(texts):
                ids, offsets = own.encode(texts[a:b])
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.record_batch([batch.column(0).slice(a, b - a), lists], [key, "ids"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(encode, f"`{key}` {kind}, ids array<int>")


def ids_bytes(encoded: DataFrame, key: str = "doc_id", tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """``(key, bytes, has_ids)``: how many bytes the tokens of each row of ``(key, ids)`` have together."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = codec(tokenizer, folder).token_bytes
        for batch in batches:
            ids = batch.column(1)
            counts = pa.compute.list_value_length(ids).to_numpy(zero_copy_only=False)
            total = np.concatenate([[0], np.cumsum(size[ids.flatten().to_numpy()])])
            ends = np.cumsum(counts)
            yield pa.record_batch([batch.column(0), pa.array(total[ends] - total[ends - counts]), pa.array(counts > 0)], [key, "bytes", "has_ids"])

    kind = encoded.schema[key].dataType.simpleString()
    return encoded.select(key, "ids").mapInArrow(measure, f"`{key}` {kind}, bytes long, has_ids boolean")


def content_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS, count: bool = True) -> DataFrame:
    """``(key, content, n_tokens)``: a 128-bit hash of each text and its tokens; a text repeated within a batch is encoded once.

    Null and empty texts have 0 tokens. With ``count`` off ``n_tokens`` is null and nothing is encoded.
    """

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = codec(tokenizer, folder).bpe.encode_ordinary if count else None
        for batch in batches:
            texts = batch.column(1).to_pylist()
            hashes = [xxhash.xxh3_128_digest(t or "") for t in texts]
            sizes: dict[bytes, int | None] = {}
            for h, t in zip(hashes, texts):
                if h not in sizes:
                    sizes[h] = len(encode(t or "")) if encode else None
            yield pa.record_batch([batch.column(0), pa.array(hashes, pa.binary()), pa.array([sizes[h] for h in hashes], pa.int64())], [key, "content", "n_tokens"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(measure, f"`{key}` {kind}, content binary, n_tokens long")


def tokenizer_hash(tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> str:
    """Hash of the vocabulary file: counts of another vocabulary are never reused."""
    digest = xxhash.xxh3_64()
    with open(f"{folder}/{tokenizer}.tiktoken", "rb") as data:
        while part := data.read(1 << 20):
            digest.update(part)
    return digest.hexdigest()


#: Spellings of languages and the label each stands for; of other
#: tags the part before "-" or "_" counts.
LANGUAGES = {
    "eng": "en", "english": "en", "deu": "de", "ger": "de", "fra": "fr", "fre": "fr", "spa": "es", "cmn": "zh", "zho": "zh", "chi": "zh",
    "py": "python", "golang": "go", "js": "javascript", "bash": "shell", "sh": "shell",
    "und": "unknown", "none": "unknown", "null": "unknown", "tbd": "unknown", "n/a": "unknown", "": "unknown",
}


def one_language(lang: Column) -> Column:
    """A language label under one spelling; null and undetermined ones are ``unknown``."""
    base = F.split_part(F.regexp_replace(F.lower(F.trim(lang)), "_", "-"), F.lit("-"), F.lit(1))
    names = F.create_map(*[F.lit(x) for pair in LANGUAGES.items() for x in pair])
    return F.coalesce(F.try_element_at(names, base), base, F.lit("unknown"))


def one_label(label: Column) -> Column:
    """A label trimmed and in lower case; null, empty and placeholder ones are ``unknown``."""
    plain = F.lower(F.trim(label))
    return F.when(plain.isNull() | plain.isin("", "none", "null", "tbd", "und", "unknown", "n/a"), "unknown").otherwise(plain)


def sliced(docs: DataFrame, profiles: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(key, source, lang, domain)``: each row's slice. Unknown profiles have the source ``unknown``."""
    names = profiles.select(F.lower(F.trim("profile")).alias("_profile"), one_label(F.col("source")).alias("_source")).dropDuplicates(["_profile"])
    rows = docs.select(F.col(key), F.lower(F.trim(F.col("profile"))).alias("_profile"), one_language(F.col("lang")).alias("lang"), one_label(F.col("domain")).alias("domain"))
    return rows.join(names, "_profile", "left").select(key, F.coalesce("_source", F.lit("unknown")).alias("source"), "lang", "domain")


SLICE = ("source", "lang", "domain")


class TokenLedger:
    """Counts by content and tokenizer, and a cube of totals that signed deltas keep; all of it lasts in a folder.

    ``state`` holds ``(key, content, source, lang, domain, n_tokens)`` of the corpus as
    it was, ``counts`` ``(content, tokenizer, n_tokens)`` of all texts ever encoded,
    ``cube`` the totals. An update appends the new counts, writes the next state and
    cube beside the last and then names them in ``heads``: a ledger opened on the folder
    goes on from the last update that was finished, and a run that broke off leaves
    nothing but counts, which stay true. ``settle`` removes what older updates left.
    """

    def __init__(self, spark: SparkSession, key: str = "doc_id", tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS, path: str | None = None):
        self.spark, self.key, self.tokenizer, self.folder = spark, key, tokenizer, folder
        self.version = tokenizer_hash(tokenizer, folder)
        self.path = (path or scratch_path(spark, "ledger")).rstrip("/")
        self.head = self._last_head()

    def _hadoop(self, name: str):
        """The file system of the folder, and a path in it."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def _read(self, name: str) -> DataFrame | None:
        fs, path = self._hadoop(name)
        return self.spark.read.parquet(f"{self.path}/{name}") if fs.exists(path) else None

    def _last_head(self) -> int:
        heads = self._read("heads")
        return 0 if heads is None else heads.agg(F.max("head")).first()[0] or 0

    @property
    def state(self) -> DataFrame | None:
        return self._read(f"state-{self.head}") if self.head else None

    @property
    def cube(self) -> DataFrame | None:
        return self._read(f"cube-{self.head}") if self.head else None

    @property
    def counts(self) -> DataFrame | None:
        return self._read("counts")

    def measured(self, docs: DataFrame) -> DataFrame:
        """``(key, content, n_tokens, fresh)`` of the corpus; only contents that ``counts`` hasn't are encoded.

        Texts never leave their partition at the first load, when all are unseen.
        Later only hashes are joined, and texts only of the documents to encode. Null and
        empty texts, which many documents may share, are joined to nothing.
        """
        key = self.key
        known = self.counts
        if known is not None:
            known = known.where(F.col("tokenizer") == self.version).groupBy("content").agg(F.min("n_tokens").alias("_n"))
        if known is None or known.isEmpty():
            return content_counts(docs, key, tokenizer=self.tokenizer, folder=self.folder).withColumn("fresh", F.lit(True))
        hashed = staged(content_counts(docs, key, tokenizer=self.tokenizer, folder=self.folder, count=False).drop("n_tokens"), "hashes")
        empty = F.col("content") == F.lit(bytearray(xxhash.xxh3_128_digest("")))
        some = hashed.where(~empty)
        unseen = some.join(known, "content", "left_anti").groupBy("content").agg(F.min(key).alias(key))
        fresh = content_counts(docs.join(unseen.select(key), key, "left_semi"), key, tokenizer=self.tokenizer, folder=self.folder)
        fresh = staged(fresh.select("content", F.col("n_tokens").alias("_n")), "fresh").dropDuplicates(["content"])
        both = known.withColumn("fresh", F.lit(False)).unionByName(fresh.join(known, "content", "left_anti").withColumn("fresh", F.lit(True)))
        found = some.join(both, "content").select(key, "content", F.col("_n").alias("n_tokens"), "fresh")
        return found.unionByName(hashed.where(empty).select(key, "content", F.lit(0).cast("long").alias("n_tokens"), F.lit(False).alias("fresh")))

    def update(self, docs: DataFrame, profiles: DataFrame) -> DataFrame:
        """Takes ``docs`` as the corpus as it is now; the signed deltas ``(source, lang, domain, docs, tokens)``.

        A document that is new, changed, moved to another slice or gone gives a row
        of +1 where it is, of -1 where it was. Rows that agree with the state give none.
        A key repeated in ``docs`` counts once (the least of its contents and slices);
        rows with a null key are left out.
        """
        key = self.key
        docs = docs.where(F.col(key).isNotNull())
        measured = self.measured(docs).groupBy(key).agg(F.min(F.struct("content", "n_tokens", "fresh")).alias("m"))
        slices = sliced(docs, profiles, key).groupBy(key).agg(F.min(F.struct(*SLICE)).alias("s"))
        now = staged(measured.join(slices, key).select(key, "m.*", "s.*"), "ledger")
        changes = now.select(*SLICE, F.lit(1).alias("docs"), F.col("n_tokens").alias("tokens"))
        before, cube = self.state, self.cube
        if before is not None:
            same = [key, "content", *SLICE]
            added = now.join(before.select(same), same, "left_anti")
            gone = before.join(now.select(same), same, "left_anti")
            changes = added.select(*SLICE, F.lit(1).alias("docs"), F.col("n_tokens").alias("tokens")).unionByName(
                gone.select(*SLICE, F.lit(-1).alias("docs"), (-F.col("n_tokens")).alias("tokens"))
            )
        totals = [F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")]
        deltas = staged(changes.groupBy(*SLICE).agg(*totals), "deltas")
        fresh = now.where("fresh").select("content", F.lit(self.version).alias("tokenizer"), "n_tokens").dropDuplicates(["content"])
        fresh.write.mode("append").parquet(f"{self.path}/counts")
        head = self.head + 1
        now.drop("fresh").write.mode("overwrite").parquet(f"{self.path}/state-{head}")
        added = deltas if cube is None else cube.unionByName(deltas).groupBy(*SLICE).agg(*totals).where(F.col("docs") != 0)
        added.write.mode("overwrite").parquet(f"{self.path}/cube-{head}")
        self.spark.range(head, head + 1).select(F.col("id").alias("head")).write.mode("append").parquet(f"{self.path}/heads")
        self.head = head
        return deltas

    def settle(self) -> None:
        """Removes the states and cubes of earlier updates."""
        for head in range(1, self.head):
            for name in ("state", "cube"):
                fs, path = self._hadoop(f"{name}-{head}")
                fs.delete(path, True)
