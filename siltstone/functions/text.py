"""Column functions on texts. What Catalyst has no expression for runs in Arrow batches."""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
import zlib
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Control characters, blanks and gaps that the normal form removes.
_CONTROL = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")
_BLANKS = re.compile(r"[\t\f\v ]+")
_GAP = re.compile(r"\n{3,}")


def normal_form(text: str) -> str:
    """Line ends as LF, NFKC, no control characters, single blanks, no blank at line ends, at most one empty line in a row."""
    text = text.replace("\r\n", "\n").replace("\r", "\n")
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    lines = _CONTROL.sub("", text).splitlines()
    return _GAP.sub("\n\n", "\n".join(_BLANKS.sub(" ", line).strip() for line in lines)).strip()


def _each(values: pd.Series, one) -> pd.Series:
    return pd.Series([None if v is None or v is pd.NA else one(v) for v in values], dtype=object)


@F.pandas_udf(T.StringType())
def normalize_text(values: pd.Series) -> pd.Series:
    return _each(values, normal_form)


@F.pandas_udf(T.StringType())
def casefold(values: pd.Series) -> pd.Series:
    return _each(values, str.casefold)


@F.pandas_udf(T.StringType())
def text_digest(values: pd.Series) -> pd.Series:
    """SHA-256 of the case-folded normal form: equal for texts that differ in case and spacing only."""
    return _each(values, lambda v: hashlib.sha256(normal_form(v).casefold().encode("utf-8", "surrogatepass")).hexdigest())


@F.pandas_udf(T.DoubleType())
def compression_ratio(values: pd.Series) -> pd.Series:
    """Compressed by uncompressed bytes, 0 for an empty text."""

    def one(text: str) -> float:
        raw = text.encode("utf-8", "ignore")
        return len(zlib.compress(raw, 6)) / len(raw) if raw else 0.0

    return pd.Series([None if v is None else one(v) for v in values], dtype="float64")


@F.pandas_udf(T.StringType())
def canonical_json(values: pd.Series) -> pd.Series:
    """JSON with sorted keys, ", " and ": " between, other scripts as they are. Not valid JSON: null."""

    def one(text: str) -> str | None:
        try:
            return json.dumps(json.loads(text), ensure_ascii=False, sort_keys=True)
        except ValueError:
            return None

    return _each(values, one)


@F.pandas_udf(T.StringType())
def changed_json(data: pd.Series, fields: pd.Series, writes: pd.Series, messages: pd.Series, digest: pd.Series) -> pd.Series:
    """The object ``data`` with what cleaning changed, as canonical JSON: text fields, noted values in order, messages, and the digest of the text where it has none.

    An absent object counts as an empty one. Values noted as ``default`` never replace a field.
    """

    def one(data: str | None, fields: str | None, writes: str | None, messages: str | None, digest: str | None) -> str:
        whole = json.loads(data) if data else {}
        whole.update(json.loads(fields) if fields else {})
        for w in json.loads(writes) if writes else ():
            into = whole.setdefault("metadata", {}) if w["how"].startswith("meta_") else whole
            if isinstance(into, dict) and (w["how"].endswith("set") or w["name"] not in into):
                into[w["name"]] = json.loads(w["value"])
        if messages is not None:
            whole["messages"] = json.loads(messages)
        if digest is not None:
            whole.setdefault("text_sha256", digest)
        return json.dumps(whole, ensure_ascii=False, sort_keys=True)

    return pd.Series([one(*(None if v is pd.NA else v for v in row)) for row in zip(data, fields, writes, messages, digest)], dtype=object)


def keyed_hash(size: int):
    """An Arrow function: BLAKE2b of ``seed``, a zero byte and the key, ``size`` bytes."""

    @F.pandas_udf(T.BinaryType())
    def digest(seed: pd.Series, key: pd.Series) -> pd.Series:
        return pd.Series([None if k is None else hashlib.blake2b(f"{s}\0{k}".encode(), digest_size=size).digest() for s, k in zip(seed, key)], dtype=object)

    return digest


order_key = keyed_hash(16)


def stable_partition(key: Column, partitions: int, seed: str = "siltstone") -> Column:
    """A partition that depends on the seed and the key alone: BLAKE2b-64 of the seed, a zero byte and the key, unsigned, modulo ``partitions``."""
    if partitions <= 0:
        raise ValueError("partitions must be positive")

    @F.pandas_udf(T.IntegerType())
    def part(values: pd.Series) -> pd.Series:
        return pd.Series([None if v is None else int.from_bytes(hashlib.blake2b(f"{seed}\0{v}".encode(), digest_size=8).digest(), "big") % partitions for v in values], dtype="Int32")

    return part(key.cast("string"))


#: Fixed value: a word of the SimHash.
_TOKEN = re.compile(r"\w+")


def fingerprint(text: str, ngram: int = 5) -> int:
    """64-bit SimHash of word n-grams as a signed number; 0 where there is no word."""
    words = _TOKEN.findall(text.casefold())
    if not words:
        return 0
    grams = [" ".join(words[i : i + ngram]) for i in range(max(1, len(words) - ngram + 1))]
    raw = b"".join(hashlib.blake2b(g.encode(), digest_size=8).digest() for g in grams)
    bits = np.unpackbits(np.frombuffer(raw, np.uint8)).reshape(-1, 64)
    set_bits = 2 * bits.sum(0, dtype=np.int64) >= len(grams)  # votes that cancel out set the bit
    return int(np.packbits(set_bits).view(">i8")[0])


def simhash(text: Column, ngram: int = 5) -> Column:
    @F.pandas_udf(T.LongType())
    def one(values: pd.Series) -> pd.Series:
        return pd.Series([None if v is None else fingerprint(v, ngram) for v in values], dtype="Int64")

    return one(text)


class _MainText(HTMLParser):
    #: Elements without main text, and elements that end a line.
    SKIP = {"script", "style", "nav", "header", "footer", "aside", "noscript", "template", "svg", "form"}
    BLOCK = {"p", "div", "br", "li", "ul", "ol", "tr", "table", "h1", "h2", "h3", "h4", "h5", "h6", "section", "article", "blockquote", "pre"}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.depth, self.out = 0, []

    def handle_starttag(self, tag, attrs):
        self.depth += tag in self.SKIP
        if tag in self.BLOCK:
            self.out.append("\n")

    def handle_endtag(self, tag):
        if tag in self.SKIP:
            self.depth = max(0, self.depth - 1)
        if tag in self.BLOCK:
            self.out.append("\n")

    def handle_data(self, data):
        if not self.depth:
            self.out.append(data)


@F.pandas_udf(T.StringType())
def main_text(values: pd.Series) -> pd.Series:
    """The main text of HTML pages."""

    def one(page: str) -> str:
        parser = _MainText()
        parser.feed(page)
        parser.close()
        return normal_form("".join(parser.out))

    return _each(values, one)


@F.pandas_udf(T.StringType())
def notebook_source(values: pd.Series) -> pd.Series:
    """Source cells of a notebook, each under a marker; a text that is no JSON object stays as it is."""

    def one(text: str) -> str:
        try:
            book = json.loads(text)
        except ValueError:
            return text
        cells = book.get("cells") if isinstance(book, dict) else None
        if not isinstance(cells, list):
            return "" if isinstance(book, dict) else text
        kept = []
        for cell in cells:
            source = cell.get("source", "") if isinstance(cell, dict) else None
            source = "".join(map(str, source)) if isinstance(source, list) else source
            if isinstance(source, str) and source.strip():
                mark = "<!-- markdown cell -->" if cell.get("cell_type") == "markdown" else "# code cell"
                kept.append(f"{mark}\n{source.strip()}")
        return "\n\n".join(kept).strip()

    return _each(values, one)


#: Fixed value: white space that Unicode-aware stripping removes.
SPACE = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"\A{SPACE}+|{SPACE}+\z", "")


def lines(text: Column) -> Column:
    """Lines of a text whose line ends are LF already."""
    return F.split(text, "\n")


def line_repetition(text: Column) -> Column:
    """Different by all non-blank lines; null without such a line."""
    kept = F.filter(lines(text), lambda x: F.length(strip(x)) > 0)
    return F.when(F.size(kept) > 0, F.size(F.array_distinct(kept)) / F.size(kept))


def word_units(text: Column) -> Column:
    """ASCII words and single CJK ideographs."""
    return F.regexp_extract_all(text, F.lit(r"([A-Za-z0-9_]+|[\x{4e00}-\x{9fff}])"), 1)


def let(value: Column, body) -> Column:
    """``body`` of the value, which is computed once; inside of a lambda a plain expression would be computed for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ngrams(words: Column, n: int) -> Column:
    def grams(w: Column) -> Column:
        count = F.size(w) - n + 1
        joined = F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda i: F.array_join(F.slice(w, i, n), " "))
        return F.when(count > 0, joined).otherwise(F.array().cast("array<string>"))

    return let(words, grams)


def repeats_itself(text: Column, least: int = 120, n: int = 5, share: float = 0.2) -> Column:
    """Whether more than ``share`` of the word n-grams of a text of ``least`` words occurred before in it."""
    again = lambda g: 1 - F.size(F.array_distinct(g)) / F.greatest(F.size(g), F.lit(1)) > share
    return let(word_units(F.lower(text)), lambda w: (F.size(w) >= least) & let(ngrams(w, n), again))


@F.pandas_udf(T.StringType())
def without_repeated_lines(values: pd.Series) -> pd.Series:
    """A text without lines that occurred in it before; blank lines stay."""

    def one(text: str) -> str:
        seen: set[str] = set()
        kept = []
        for line in text.split("\n"):
            bare = line.strip()
            if not bare or bare not in seen:
                kept.append(line)
                seen.add(bare)
        return "\n".join(kept)

    return _each(values, one)


def cut_bytes(text: Column, most: int = 20_480) -> Column:
    """The longest beginning of a text of at most so many bytes of UTF-8."""

    @F.pandas_udf(T.StringType())
    def cut(values: pd.Series) -> pd.Series:
        return _each(values, lambda v: v.encode("utf-8", "surrogatepass")[:most].decode("utf-8", "ignore"))

    return F.when(F.octet_length(text) > most, cut(text)).otherwise(text)


def one_line(text: Column) -> Column:
    """A text with single blanks for white space, and without the blank that stands before a full stop in tokenised text."""
    flat = F.regexp_replace(F.replace(text, F.lit("\n"), F.lit(" ")), r"\s+", " ")
    for _ in range(3):
        flat = F.replace(flat, F.lit(" . "), F.lit(". "))
    return flat


#: What identifies persons or machines, and the label that takes its place.
PRIVATE = {
    "email": r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)+",
    "ip": r"\b(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\b",
    "phone": r"\+[0-9]{1,3}[ \-]?(?:\([0-9]{1,4}\)[ \-]?)?[0-9]{2,4}(?:[ \-]?[0-9]{2,4}){2,4}",
    "key": r"\b(?:sk|pk|ghp|xox[abp])[_\-][A-Za-z0-9_\-]{16,}",
}


def private_counts(text: Column) -> Column:
    """How often a text holds each kind of PRIVATE."""
    return F.struct(*[F.regexp_count(F.coalesce(text, F.lit("")), F.lit(p)).alias(n) for n, p in PRIVATE.items()])


def redacted(text: Column) -> Column:
    """The text with ``[EMAIL]``, ``[IP]``, ``[PHONE]`` or ``[KEY]`` in place of what PRIVATE finds, in that order."""
    for name, pattern in PRIVATE.items():
        text = F.regexp_replace(text, pattern, f"[{name.upper()}]")
    return text


def thought_and_answer(text: Column) -> Column:
    """What a model thought and what it answered: the thought ends at the first closing tag, and begins at the text's start if no tag opens it. Without a closing tag all is the answer."""
    end = F.instr(text, "</think>")
    before = F.substring(text, F.lit(1), end - 1)
    opened = F.instr(before, "<think>")
    thought = F.when(opened > 0, F.substring(before, opened + 7, F.length(before))).otherwise(before)
    return F.struct(F.when(end > 0, strip(thought)).alias("thought"), F.when(end > 0, strip(F.substring(text, end + 8, F.length(text)))).otherwise(text).alias("answer"))
