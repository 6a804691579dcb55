"""Records that differ in form only: bottom-up hashing of nested JSON values."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from hashlib import blake2b
from json.decoder import scanstring

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.session import staged

_NOT_KEPT = regex.compile(r"[^\p{L}\p{N}]+")
_ASCII_DROPPED = bytes(i for i in range(128) if not chr(i).isalnum())
_BLANKS = re.compile(r"[ \t\n\r]*")
_LITERAL = re.compile("null|true|false")
_JSON_NUMBER = re.compile(r"-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][-+]?[0-9]+)?")
_END = object()
_NUMBER = re.compile(r"(-?)(\d+)(?:\.(\d+))?(?:[eE]([+-]?\d+))?")
#: Rows of one group are spread over so many keys.
SALTS = 64


class _Number(bytes):
    """A number in one form: sign, digits without outer zeros, exponent."""


def _number(text: str) -> _Number:
    sign, whole, part, exponent = _NUMBER.fullmatch(text).groups()
    digits = (whole + (part or "")).lstrip("0")
    short = digits.rstrip("0")
    if not short:
        return _Number(b"0e0")
    at = len(digits) - len(short) - len(part or "")
    if exponent:
        # exponents of any length: added as whole numbers where short, else kept beside
        at = at + int(exponent) if len(exponent) < 4000 else f"{at}+{exponent}"
    return _Number(f"{sign}{short}e{at}".encode())


def _refuse(text: str) -> None:
    raise ValueError(text)


_DECODE = json.JSONDecoder(parse_int=_number, parse_float=_number, parse_constant=_refuse).decode


def reduced(text: str) -> bytes:
    """A string leaf in lower case, letters and digits only."""
    if text.isascii():
        return text.lower().encode().translate(None, _ASCII_DROPPED)
    return _NOT_KEPT.sub("", text.lower()).encode("utf-8", "surrogatepass")


def digest_and_form(value: object) -> tuple[bytes, bytes]:
    """The node's 16-byte digest, and the whole of it in one form.

    A leaf is hashed with its kind. An array hashes its children's digests in order,
    an object the sorted digests of its fields, each of name and value. The form
    lists the fields by name; equal forms are equal structures. Open nodes stand on
    a stack of their own, so depth is bounded by memory only.
    """
    forms: list[bytes] = []
    open_nodes: list[tuple[object, Iterator, list[bytes]]] = []
    labels: list[bytes] = []
    while True:
        kind, digest = type(value), None
        if kind is dict:
            forms.append(b"o%d:" % len(value))
            open_nodes.append((value, iter(sorted(value)), []))
        elif kind is list:
            forms.append(b"a%d:" % len(value))
            open_nodes.append((None, iter(value), []))
        else:
            if kind is str:
                form = reduced(value)
                form = b"s%d:%b" % (len(form), form)
            elif kind is _Number:
                form = b"n%d:%b" % (len(value), value)
            else:
                form = b"z" if value is None else b"t" if value else b"u"
            forms.append(form)
            digest = blake2b(form, digest_size=16).digest()
        while open_nodes:
            fields, rest, digests = open_nodes[-1]
            if digest is not None:
                digests.append(digest if fields is None else blake2b(b"f%b" % labels.pop() + digest, digest_size=16).digest())
            child = next(rest, _END)
            if child is not _END:
                if fields is not None:
                    name = child.encode("utf-8", "surrogatepass")
                    labels.append(b"%d:%b" % (len(name), name))
                    forms.append(labels[-1])
                    child = fields[child]
                value = child
                break
            open_nodes.pop()
            if fields is not None:
                digests.sort()
            digest = blake2b((b"a" if fields is None else b"o") + b"".join(digests), digest_size=16).digest()
        else:
            return digest, b"".join(forms)


def parse_deep(text: str) -> object:
    """What ``_DECODE`` gives, at any depth: the open values stand on a stack."""

    def name_at(at: int) -> tuple[str, int]:
        if text[at : at + 1] != '"':
            raise ValueError(at)
        name, at = scanstring(text, at + 1, True)
        at = _BLANKS.match(text, at).end()
        if text[at : at + 1] != ":":
            raise ValueError(at)
        return name, _BLANKS.match(text, at + 1).end()

    open_values: list[tuple[dict | list, str | None]] = []
    at = _BLANKS.match(text).end()
    while True:
        first = text[at : at + 1]
        if first == "{" or first == "[":
            value = {} if first == "{" else []
            at = _BLANKS.match(text, at + 1).end()
            if text[at : at + 1] != ("}" if first == "{" else "]"):
                name, at = name_at(at) if first == "{" else (None, at)
                open_values.append((value, name))
                continue
            at += 1
        elif first == '"':
            value, at = scanstring(text, at + 1, True)
        elif found := _LITERAL.match(text, at):
            value, at = {"null": None, "true": True, "false": False}[found[0]], found.end()
        elif found := _JSON_NUMBER.match(text, at):
            value, at = _number(found[0]), found.end()
        else:
            raise ValueError(at)
        while open_values:
            holder, name = open_values[-1]
            if name is None:
                holder.append(value)
            else:
                holder[name] = value
            at = _BLANKS.match(text, at).end()
            after = text[at : at + 1]
            if after == ",":
                at = _BLANKS.match(text, at + 1).end()
                if name is not None:
                    name, at = name_at(at)
                    open_values[-1] = holder, name
                break
            if after != ("]" if name is None else "}"):
                raise ValueError(at)
            value, _ = open_values.pop()
            at += 1
        else:
            if _BLANKS.match(text, at).end() != len(text):
                raise ValueError(at)
            return value


def parse_object(payload: str | None) -> dict | None:
    """The payload as an object; None if it is null, no valid JSON, or another kind of value.

    Of a field named twice the last counts. NaN and infinities are not valid. What is
    nested deeper than the decoder follows is parsed with a stack.
    """
    if not payload or "{" not in payload:
        return None
    try:
        try:
            value = _DECODE(payload)
        except RecursionError:
            value = parse_deep(payload)
    except ValueError:
        return None
    return value if type(value) is dict else None


def record_forms(records: DataFrame, key: str = "record_id", payload: str = "payload") -> DataFrame:
    """``(key, digest, form)`` of each row whose payload is a JSON object; other rows give none."""

    def forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, digests, whole = [], [], []
            for k, text in enumerate(batch.column(1).to_pylist()):
                if (value := parse_object(text)) is not None:
                    digest, form = digest_and_form(value)
                    at.append(k)
                    digests.append(digest)
                    whole.append(form)
            yield pa.record_batch([batch.column(0).take(pa.array(at, pa.int64())), pa.array(digests, pa.binary()), pa.array(whole, pa.binary())], [key, "digest", "form"])

    kind = records.schema[key].dataType.simpleString()
    return records.where(F.col(key).isNotNull()).select(key, payload).mapInArrow(forms, f"`{key}` {kind}, digest binary, form binary")


def form_groups(records: DataFrame, key: str = "record_id", payload: str = "payload") -> tuple[DataFrame, DataFrame]:
    """Groups of records that differ in form at most: ``(first_id, copies)``, and members ``(first_id, key)``.

    ``first_id`` is the smallest key of the group, ``copies`` the number of different
    keys in it; members are all other keys. A key delivered twice counts once. Rows
    of one digest are gathered as the set of their different forms, which each
    partition reduces before the shuffle: more than one form under a digest is a
    collision, and such digests are grouped by the forms themselves. Members join
    their group by a salted key, so that no task holds a large group whole.
    """
    forms = staged(record_forms(records, key, payload), "forms")
    sets = [F.min(key).alias("first_id"), F.max(key).alias("_last")]
    roots = staged(forms.groupBy("digest").agg(*sets, F.size(F.collect_set("form")).alias("_forms")), "roots")
    collided = roots.where("_forms > 1").select("digest", F.lit(True).alias("_split"))
    if not collided.isEmpty():
        exact = F.when(F.col("_split"), F.concat("digest", "form")).otherwise(F.col("digest"))
        forms = staged(forms.join(collided, "digest", "left").withColumn("digest", exact), "forms")
        roots = staged(forms.groupBy("digest").agg(*sets), "roots")
    salted = forms.select("digest", key, F.pmod(F.xxhash64(key), F.lit(SALTS)).alias("_salt")).distinct()
    parts = salted.groupBy("digest", "_salt").agg(F.count("*").alias("_n"))
    copies = parts.groupBy("digest").agg(F.sum("_n").alias("copies"))
    groups = roots.join(copies, "digest").select("first_id", "copies")
    many = roots.where(F.col("first_id") < F.col("_last")).select("digest", "first_id")
    members = salted.join(parts.join(many, "digest").select("digest", "_salt", "first_id"), ["digest", "_salt"])
    return groups, members.where(F.col(key) != F.col("first_id")).select("first_id", key)
