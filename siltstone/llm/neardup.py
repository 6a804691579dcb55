"""Near-duplicate texts by set similarity joins under several token orders."""

from __future__ import annotations

import re
import unicodedata
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.session import scratch_path, staged

#: The ranges of the script Han.
HAN = (
    r"⺀-⺙⺛-⻳⼀-⿕々〇〡-〩〸-〻㐀-䶿一-鿿豈-舘並-龎"
    r"\U00016fe2\U00016fe3\U00016ff0-\U00016ff6\U00020000-\U0002a6df\U0002a700-\U0002ebe0\U0002ebf0-\U0002ee5d\U0002f800-\U0002fa1d\U00030000-\U0003347f"
)
_WORDS = re.compile(f"[{HAN}]|[^\\W_{HAN}]+").findall
_PLAIN_WORDS = re.compile(r"[^\W_]+").findall
#: ASCII letters in lower case and digits as they are, everything else a blank.
_ASCII_WORDS = bytes(ord(chr(i).lower()) if chr(i).isalnum() else 32 for i in range(128)) + b" " * 128
#: Shingles are 40-bit hashes, five bytes each.
BITS, WIDTH = 40, 5
MASK = np.uint64((1 << BITS) - 1)
#: Shingles of a chunk of sets, about; a chunk has at most 65,536 sets.
CHUNK_SHINGLES, CHUNK_SETS = 500_000, 1 << 16
#: Prefix entries of a block, and shingle occurrences of a range that are counted together, about.
BLOCK_ENTRIES, RANGE_SHINGLES = 700_000, 2_000_000
#: The sets of a shingle meet in parts of about so many. It spreads the work only; what is found is the same at any value.
HOT = 20_000
#: The orders: bits by which the level of frequency is coarsened, and the odd factors of the hash that breaks ties.
ORDERS = ((0, 0x9E3779B97F, 0xC2B2AE3D27), (2, 0xD6E8FEB865, 0xA0761D6479), (4, 0xFF51AFD7ED, 0xE7037ED1A1))


def words_of(text: str) -> list[str]:
    """Runs of letters and digits of the text in NFKC and lower case; each Han character is a word."""
    if text.isascii():
        return text.encode().translate(_ASCII_WORDS).decode().split()
    text = unicodedata.normalize("NFKC", text).lower()
    return (_WORDS if max(text) >= "\u2e80" else _PLAIN_WORDS)(text)


class _Numbers(dict):
    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


def shingle_hashes(texts: list[str | None], width: int, least: int) -> tuple[list[bytes | None], np.ndarray, np.ndarray]:
    """Of each text a digest of its words (None below ``least`` words) and the number of its different shingles; all their hashes in a row, each text's sorted."""
    code = _Numbers()
    split = [words_of(t) if t else [] for t in texts]
    size = np.fromiter(map(len, split), np.int64, len(split))
    flat = np.fromiter(map(code.__getitem__, chain.from_iterable(split)), np.int64, int(size.sum()))
    v = np.fromiter(map(xxhash.xxh3_64_intdigest, code), np.uint64, len(code))[flat]
    begin = np.cumsum(size) - size
    windows = np.where(size >= max(least, width), size - width + 1, 0)
    row = np.repeat(np.arange(len(texts)), windows)
    at = np.arange(len(row)) + np.repeat(begin - np.cumsum(windows) + windows, windows)
    h = v[at]
    for k in range(1, width):
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + v[at + k]
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - BITS)
    h |= row.astype(np.uint64) << np.uint64(BITS)
    h.sort()
    h = h[np.flatnonzero(np.diff(h, prepend=~h[:1]))]
    counts = np.bincount((h >> np.uint64(BITS)).astype(np.int64), minlength=len(texts))
    digests = [xxhash.xxh3_128_digest(v[a : a + n].tobytes()) if w else None for a, n, w in zip(begin.tolist(), size.tolist(), windows.tolist())]
    return digests, counts, h & MASK


def packed(h: np.ndarray) -> bytes:
    return np.ascontiguousarray(h, "<u8").view(np.uint8).reshape(-1, 8)[:, :WIDTH].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // WIDTH, 8), np.uint8)
    out[:, :WIDTH] = np.frombuffer(data, np.uint8).reshape(-1, WIDTH)
    return out.view("<u8").ravel()


def mixed(h: np.ndarray, first: int, second: int) -> np.ndarray:
    """A permutation of the 40-bit hashes."""
    x = h * np.uint64(first) & MASK
    return (x ^ (x >> np.uint64(BITS // 2))) * np.uint64(second) & MASK


def unmixed(x: np.ndarray, first: int, second: int) -> np.ndarray:
    x = x * np.uint64(pow(second, -1, 1 << BITS)) & MASK
    return (x ^ (x >> np.uint64(BITS // 2))) * np.uint64(pow(first, -1, 1 << BITS)) & MASK


def prefix_length(n, threshold: float):
    """Sets of n and at least threshold x n shingles that are similar share one of the first so many, in any order."""
    return n - np.ceil(threshold * n - 1e-9).astype(np.int64) + 1


def least_overlap(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    return np.ceil(threshold / (1 + threshold) * (a + b) - 1e-9)


def prefixes(h: np.ndarray, level: np.ndarray, sizes: np.ndarray, threshold: float, order: int) -> tuple[np.ndarray, ...]:
    """``(set, shingle, level, place)`` of the prefixes of all sets (given in a row, at most 65,536) under an order from rare to frequent."""
    coarse, *factors = ORDERS[order]
    row = np.repeat(np.arange(len(sizes), dtype=np.uint64), sizes)
    s = (row << np.uint64(48)) | ((level >> np.uint8(coarse)).astype(np.uint64) << np.uint64(BITS)) | mixed(h, *factors)
    s.sort()
    place = np.arange(len(s)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    keep = place < np.repeat(prefix_length(sizes, threshold), sizes)
    s, place = s[keep], place[keep]
    return (s >> np.uint64(48)).astype(np.int64), unmixed(s & MASK, *factors), ((s >> np.uint64(BITS)) & np.uint64(255)).astype(np.int64) << coarse, place


def sketch_bytes(n: np.ndarray) -> np.ndarray:
    """Bytes of the parity sketches of sets of n shingles: a power of two, at least 16."""
    return (1 << np.ceil(np.log2(np.maximum(128, 2 * n))).astype(np.int64)) >> 3


def parity_sketches(h: np.ndarray, sizes: np.ndarray) -> bytes:
    """A sketch of each set: bit i tells whether an odd number of its shingles hash to it."""
    width = sketch_bytes(sizes) * 8
    begin = np.cumsum(width) - width
    bit = (mixed(h, 0xA24BAED495, 0x9FB21C651F) >> np.uint64(8)).astype(np.int64) & np.repeat(width - 1, sizes)
    odd = np.bincount(bit + np.repeat(begin, sizes), minlength=int(width.sum())) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def folded(sketch: np.ndarray, size: int) -> np.ndarray:
    """Sketches, one a row, as they would be with fewer bits."""
    while sketch.shape[1] > size:
        half = sketch.shape[1] // 2
        sketch = sketch[:, :half] ^ sketch[:, half:]
    return sketch


def shingle_chunks(docs: DataFrame, key: str, text: str, width: int, least: int) -> DataFrame:
    """``(chunk, keys, at, digests, n, sizes, hashes)``: the sets of runs of texts of at least ``least`` words.

    Texts with the same words in a chunk have one set, ``at`` is its place for each
    key; ``n`` shingles in all.
    """

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 20
        keys, at, digests, sizes, hashes = [], [], {}, [], []

        def out() -> pa.RecordBatch:
            nonlocal chunk
            own = pa.concat_arrays(keys)
            whole = [pa.array([chunk], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own), pa.array([at], pa.list_(pa.int32())), pa.array([list(digests)], pa.list_(pa.binary())), pa.array([sum(sizes)], pa.int64()), pa.array([np.array(sizes, np.int32).tobytes()], pa.binary()), pa.array([b"".join(hashes)], pa.binary())]
            chunk += 1
            for x in (keys, at, digests, sizes, hashes):
                x.clear()
            return pa.record_batch(whole, ["chunk", "keys", "at", "digests", "n", "sizes", "hashes"])

        for batch in batches:
            for a in range(0, batch.num_rows, 2_000):
                part = batch.slice(a, 2_000)
                found, counts, h = shingle_hashes(part.column(1).to_pylist(), width, least)
                data, ends = packed(h), np.cumsum(counts) * WIDTH
                rows = [k for k, d in enumerate(found) if d is not None]
                for k in rows:
                    if (place := digests.setdefault(found[k], len(digests))) == len(sizes):
                        sizes.append(int(counts[k]))
                        hashes.append(data[ends[k] - sizes[-1] * WIDTH : ends[k]])
                    at.append(place)
                keys.append(part.column(0).take(pa.array(rows, pa.int64())))
                if sum(sizes) >= CHUNK_SHINGLES or len(at) + 2_000 > CHUNK_SETS:
                    yield out()
        if at:
            yield out()

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(key, text)
    return rows.mapInArrow(shingles, f"chunk long, keys array<{kind}>, at array<int>, digests array<binary>, n long, sizes binary, hashes binary")


def _chunk(row: dict, which: str = "kept") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, sizes and shingles of the listed sets of a chunk."""
    sizes = np.frombuffer(row["sizes"], np.int32).astype(np.int64)
    take = np.zeros(len(sizes), bool)
    take[row[which]] = True
    return np.flatnonzero(take), sizes[take], unpacked(row["hashes"])[np.repeat(take, sizes)]


def frequency_levels(kept: DataFrame, ranges: int) -> DataFrame:
    """``(chunk, levels)``: 4 x log2 of the number of sets with each different shingle of the chunk's kept sets, in order of the shingles.

    Shingles are counted by ranges of their hashes, exactly; each range sends back
    to a chunk what it asked for. Nothing passes through the driver.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                h, n = np.unique(_chunk(row)[2], return_counts=True)
                cut = np.searchsorted(h * np.uint64(ranges) >> np.uint64(BITS), np.arange(ranges + 1))
                rows = [(k, row["chunk"], packed(h[a:b]), n[a:b].astype(np.int32).tobytes()) for k, (a, b) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist())) if b > a]
                yield pa.record_batch([pa.array(x, t) for x, t in zip(map(list, zip(*rows)), (pa.int32(), pa.int64(), pa.binary(), pa.binary()))], ["range", "chunk", "hashes", "counts"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in batch.to_pylist()]
        if not rows:
            return
        pieces = [unpacked(row["hashes"]) for row in rows]
        _, which = np.unique(np.concatenate(pieces), return_inverse=True)
        sets = np.bincount(which, np.concatenate([np.frombuffer(row["counts"], np.int32) for row in rows]))
        levels = np.floor(4 * np.log2(sets)).astype(np.uint8)[which]
        ends = np.cumsum(list(map(len, pieces))).tolist()
        yield pa.record_batch([pa.array([row["chunk"] for row in rows], pa.int64()), pa.array([row["range"] for row in rows], pa.int32()), pa.array([levels[b - len(x) : b].tobytes() for x, b in zip(pieces, ends)], pa.binary())], ["chunk", "range", "levels"])

    asked = kept.mapInArrow(ask, "range int, chunk long, hashes binary, counts binary")
    answered = asked.repartitionById(ranges, "range").mapInArrow(answer, "chunk long, range int, levels binary")
    return answered.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("range", "levels"))).alias("l")).select("chunk", F.col("l.levels").alias("levels"))


def _levels(row: dict, h: np.ndarray) -> np.ndarray:
    known, which = np.unique(h, return_inverse=True)
    return np.frombuffer(b"".join(row["levels"]), np.uint8)[which]


def prefix_keys(h: np.ndarray, level: np.ndarray, sizes: np.ndarray, ids: np.ndarray, threshold: float, hot: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(set, key, place)``: the shingles of the first order's prefixes that another set may have, as keys.

    The sets of a shingle that more than ``hot`` of them have are divided into parts,
    and each part meets every part under a key of its own: no task gets them all.
    """
    row, key, rank, place = prefixes(h, level, sizes, threshold, 0)
    some = rank > 0
    row, key, rank, place = row[some], key[some], rank[some], place[some]
    parts = np.ceil(2.0 ** ((rank + 1) / 4) / max(hot, 1)).astype(np.int64)
    parts[rank <= 4 * np.log2(max(hot, 1))] = 1
    if parts.max(initial=1) == 1:
        return row, key, place
    again = np.repeat(np.arange(len(key)), parts)
    other = np.arange(len(again)) - np.repeat(np.cumsum(parts) - parts, parts)
    own = (mixed(ids.astype(np.uint64) & MASK, 0x8EBC6AF09D, 0x589965CC75) >> np.uint64(8)).astype(np.int64)[row[again]] % parts[again]
    tile = np.minimum(own, other) * parts[again] + np.maximum(own, other)
    return row[again], key[again] ^ mixed(tile.astype(np.uint64), 0x1D8E4E27C5, 0xEB44ACCAB5), place[again]


def block_rows(kept: DataFrame, blocks: int, threshold: float, hot: int) -> DataFrame:
    """``(block, ids, n, counts, keys, places, sketches)``: what the sets of a chunk send to a block of keys, each set once."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in batch.to_pylist():
                at, sizes, h = _chunk(chunk)
                width = sketch_bytes(sizes)
                begin = np.cumsum(width) - width
                sketches = np.frombuffer(parity_sketches(h, sizes), np.uint8)
                ids = at + (chunk["chunk"] << 16)
                row, key, place = prefix_keys(h, _levels(chunk, h), sizes, ids, threshold, hot)
                block = (mixed(key, 0xB5026F5AA9, 0xBF58476D1D) * np.uint64(blocks) >> np.uint64(BITS)).astype(np.int64)
                order = np.argsort((block << 16) | row, kind="stable")
                block, row, key, place = block[order], row[order], key[order], place[order]
                cut = np.flatnonzero(np.diff(block, prepend=-1)).tolist()
                out: list[tuple] = []
                for a, b in zip(cut, [*cut[1:], len(block)]):
                    first = np.flatnonzero(np.diff(row[a:b], prepend=-1))
                    r = row[a:b][first]
                    take = np.arange(width[r].sum()) + np.repeat(begin[r] - np.cumsum(width[r]) + width[r], width[r])
                    p = place[a:b]
                    out.append((int(block[a]), ids[r].tobytes(), sizes[r].astype(np.int32).tobytes(), np.diff(first, append=b - a).astype(np.int32).tobytes(), packed(key[a:b]), p.astype(np.uint16 if p.max() < 65536 else np.uint32).tobytes(), sketches[take].tobytes()))
                if out:
                    yield pa.record_batch([pa.array(x, t) for x, t in zip(map(list, zip(*out)), (pa.int32(), *[pa.binary()] * 6))], ["block", "ids", "n", "counts", "keys", "places", "sketches"])

    return kept.mapInArrow(rows, "block int, ids binary, n binary, counts binary, keys binary, places binary, sketches binary")


def pairs_of_block(parts: list[dict], threshold: float, at_once: int = 1_000_000) -> tuple[np.ndarray, np.ndarray]:
    """Ids of sets of a block that may be similar, the smaller first.

    Pairs share a key; their sizes, the places of the key and their parity sketches
    must allow the overlap that is needed. Each test only removes pairs that cannot
    be similar. Pairs are made and tested ``at_once`` at a time.
    """

    def whole(name: str, kind: type) -> np.ndarray:
        return np.concatenate([np.frombuffer(x[name], kind) for x in parts])

    ids, n, counts = whole("ids", np.int64), whole("n", np.int32).astype(np.int64), whole("counts", np.int32)
    row = np.repeat(np.arange(len(n)), counts)
    key = np.concatenate([unpacked(x["keys"]) for x in parts])
    place = np.concatenate([np.frombuffer(x["places"], np.uint16 if len(x["places"]) * WIDTH == 2 * len(x["keys"]) else np.uint32) for x in parts]).astype(np.int64)
    _, key = np.unique(key, return_inverse=True)
    most = int(n.max()) + 1
    s = key * most + n[row]
    order = np.argsort(s)
    s, row, place = s[order], row[order], place[order]
    size = n[row]
    left = size - place  # what a set can share from the key on
    # partners that follow: as many shingles or more, but not too many; the smaller set's key must stand early enough
    ends = np.searchsorted(s, s + np.minimum(np.floor(size / threshold + 1e-9).astype(np.int64), most - 1) - size, "right")
    after = np.where(left >= least_overlap(size, size, threshold), ends - np.arange(len(s)) - 1, 0)
    begin = np.concatenate([[0], np.cumsum(after)])
    width = sketch_bytes(n)
    data, where = whole("sketches", np.uint8), np.cumsum(width) - width
    narrow: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for w in np.unique(width).tolist():  # sketches of one width, and of all wider ones folded to it
        have = np.flatnonzero(width >= w)
        place_of = np.full(len(n), -1)
        place_of[have] = np.arange(len(have))
        rows = np.empty((len(have), w), np.uint8)
        for x in np.unique(width[have]).tolist():
            own = np.flatnonzero(width[have] == x)
            rows[own] = folded(data[(where[have[own]][:, None] + np.arange(x)[None, :])], w)
        narrow[w] = rows.view(np.uint64), place_of
    found: list[np.ndarray] = []
    a = 0
    while a < len(s):
        b = max(a + 1, int(np.searchsorted(begin, begin[a] + at_once, "right")) - 1)
        x = np.repeat(np.arange(a, b), after[a:b])
        y = x + 1 + np.arange(len(x)) - (begin[x] - begin[a])
        need = least_overlap(size[x], size[y], threshold)
        ok = np.minimum(left[x], left[y]) >= need
        i, j = row[x[ok]], row[y[ok]]
        pair = np.unique(np.minimum(i, j) * len(n) + np.maximum(i, j))
        i, j = pair // len(n), pair % len(n)
        least = np.minimum(width[i], width[j])
        for w in np.unique(least).tolist():
            sketches, place_of = narrow[w]
            own = np.flatnonzero(least == w)
            apart = np.bitwise_count(sketches[place_of[i[own]]] ^ sketches[place_of[j[own]]]).sum(1, dtype=np.int64)
            total = n[i[own]] + n[j[own]]
            found.append(pair[own[(total - apart) / 2 >= least_overlap(total, 0, threshold)]])
        if len(found) > 64:
            found = [np.unique(np.concatenate(found))]
        a = b
    pair = np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)
    i, j = ids[pair // len(n)], ids[pair % len(n)]
    return np.minimum(i, j), np.maximum(i, j)


def candidate_pairs(rows: DataFrame, blocks: int, threshold: float) -> DataFrame:
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [row for batch in batches for row in batch.to_pylist()]
        if parts:
            i, j = pairs_of_block(parts, threshold)
            for a in range(0, len(i), 50_000):
                yield pa.record_batch([pa.array(i[a : a + 50_000]), pa.array(j[a : a + 50_000])], ["a", "b"])

    return rows.repartitionById(blocks, "block").mapInArrow(pairs, "a long, b long").distinct()


def contents(wanted: DataFrame, threshold: float) -> DataFrame:
    """``(id, second, third, shingles)`` of the wanted sets: 16-bit hashes of the prefixes under the further orders, and the whole set."""

    def content(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in batch.to_pylist():
                at, sizes, h = _chunk(chunk)
                level = _levels(chunk, h)
                own = np.isin(at, chunk["wanted"])
                take = np.repeat(own, sizes)
                at, sizes, h, level = at[own], sizes[own], h[take], level[take]
                cells: list[list[bytes]] = []
                for k in (1, 2):
                    row, u, _, _ = prefixes(h, level, sizes, threshold, k)
                    cut = np.searchsorted(row, np.arange(len(sizes) + 1)).tolist()
                    short = (mixed(u, 0xC3A5C85C97, 0xB492B66FBF) >> np.uint64(24)).astype(np.uint16)
                    cells.append([short[a:b].tobytes() for a, b in zip(cut, cut[1:])])
                data, ends = packed(h), np.cumsum(sizes * WIDTH).tolist()
                cells.append([data[a:b] for a, b in zip([0, *ends], ends)])
                yield pa.record_batch([pa.array(at + (chunk["chunk"] << 16)), *[pa.array(c, pa.binary()) for c in cells]], ["id", "second", "third", "shingles"])

    return wanted.mapInArrow(content, "id long, second binary, third binary, shingles binary")


def shared(x: list[np.ndarray], y: list[np.ndarray], bits: int) -> np.ndarray:
    """How many of the elements of y[k] are in x[k], for each k."""
    sizes = [np.fromiter(map(len, z), np.int64, len(z)) for z in (x, y)]
    u, v = (np.concatenate(z).astype(np.uint64) | (np.repeat(np.arange(len(z), dtype=np.uint64), n) << np.uint64(bits)) for z, n in zip((x, y), sizes))
    return np.bincount(np.repeat(np.arange(len(y)), sizes[1])[np.isin(v, u, kind="sort")], minlength=len(y))


def meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of ``(a, b, second_a, third_a, second_b, third_b)`` the pairs whose prefixes meet under both further orders."""
    for batch in batches:
        if batch.num_rows:
            second, third, other, last = ([np.frombuffer(x, np.uint16) for x in batch.column(k).to_pylist()] for k in range(2, 6))
            keep = pa.array(np.flatnonzero((shared(second, other, 16) > 0) & (shared(third, last, 16) > 0)))
            yield pa.record_batch([batch.column(0).take(keep), batch.column(1).take(keep)], ["a", "b"])


def verified(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Of ``(a, b, x, y)`` the pairs whose sets are similar, with their Jaccard similarity."""
    for batch in batches:
        size = np.array([len(u) + len(v) for u, v in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())], np.int64)
        cut = np.flatnonzero(np.diff(np.cumsum(size) // 20_000_000, prepend=-1)).tolist()  # pairs of about 20 MB together
        for at, end in zip(cut, [*cut[1:], batch.num_rows]):
            part = batch.slice(at, end - at)
            x, y = ([unpacked(v) for v in part.column(k).to_pylist()] for k in (2, 3))
            common = shared(x, y, BITS)
            share = common / (np.fromiter(map(len, x), np.int64, len(x)) + np.fromiter(map(len, y), np.int64, len(y)) - common)
            keep = np.flatnonzero(share >= threshold - 1e-9)
            yield pa.record_batch([part.column(0).take(pa.array(keep)), part.column(1).take(pa.array(keep)), pa.array(share[keep])], ["a", "b", "similarity"])


def least_labels(edges: DataFrame) -> DataFrame:
    """``(node, label)``: of each node of the edges ``(a, b)`` the least node of its component.

    Stars are contracted in turn towards larger and towards smaller neighbours until
    every edge points at the least node; each round is written to the shared folder.
    """
    edges = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "stars")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        new = staged(small, "stars")
        if new.count() == edges.count() and new.join(edges, ["a", "b"], "left_anti").isEmpty():
            break
        edges = new
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("label"))).distinct()


@dataclass
class NearDuplicates:
    """``members``: (_key, id) of all texts long enough, one id for the same words; ``links``: (a, b, similarity) of ids."""

    members: DataFrame
    links: DataFrame
    key: str
    copies_at_once: int = 1_000

    def pairs(self) -> DataFrame:
        """``(key_a, key_b)``, the smaller first: all pairs of keys with nearly the same text, equal texts included."""
        k, m = self.key, self.members
        both = self.links.select("a", "b").unionByName(self.links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        left, right = m.select(F.col("_key").alias(f"{k}_a"), F.col("id").alias("a")), m.select(F.col("_key").alias(f"{k}_b"), F.col("id").alias("b"))
        different = left.join(both, "a").join(right, "b").where(F.col(f"{k}_a") < F.col(f"{k}_b")).select(f"{k}_a", f"{k}_b")
        # only texts that occur again are joined to themselves, a part of their copies at a time
        again = m.groupBy("id").agg(F.ceil(F.count("*") / self.copies_at_once).cast("int").alias("_parts"), F.count("*").alias("_n")).where("_n > 1").select(F.col("id").alias("a"), "_parts")
        ones = left.join(again, "a").select(f"{k}_a", "a", F.pmod(F.xxhash64(f"{k}_a"), "_parts").cast("int").alias("_part"))
        others = right.withColumnRenamed("b", "a").join(again, "a").select(f"{k}_b", "a", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part"))
        copies = ones.join(others, ["a", "_part"]).where(F.col(f"{k}_a") < F.col(f"{k}_b"))
        return different.unionByName(copies.select(f"{k}_a", f"{k}_b"))

    def groups(self) -> DataFrame:
        """``(key, group_id, copies, links)`` of each text long enough.

        ``group_id`` is the smallest key of all texts that links and copies join,
        ``copies`` the number of keys with the same words, ``links`` the number of
        other different texts that this one is linked to.
        """
        k, m = self.key, self.members
        labels = least_labels(self.links)
        degree = self.links.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("links"))
        classes = m.groupBy("id").agg(F.min("_key").alias("_first"), F.count("*").alias("copies"))
        named = classes.join(labels.withColumnRenamed("node", "id"), "id", "left").join(degree, "id", "left").withColumn("label", F.coalesce("label", "id"))
        named = staged(named, "classes")
        group = named.groupBy("label").agg(F.min("_first").alias("group_id"))
        full = named.join(group, "label").select("id", "group_id", "copies", F.coalesce("links", F.lit(0)).alias("links"))
        return m.join(full, "id").select(F.col("_key").alias(k), "group_id", "copies", "links")


def bucketed(df: DataFrame, column: str, buckets: int) -> tuple[DataFrame, str]:
    """``df`` in the shared folder, bucketed so that joins by the column don't move it, and the name under which the session knows it."""
    name = f"chunks_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, column).option("path", scratch_path(df.sparkSession, "chunks")).saveAsTable(name)
    return df.sparkSession.table(name), name


def near_duplicates(docs: DataFrame, key: str = "sample_id", text: str = "text", width: int = 5, threshold: float = 0.8, least_words: int = 5, block_entries: int = BLOCK_ENTRIES, hot: int = HOT) -> NearDuplicates:
    """All pairs of texts whose shingles of ``width`` words have a Jaccard similarity of ``threshold`` or more.

    Texts with the same words are one class, which takes part once. Shingles are
    counted exactly. A candidate shares a shingle of its prefixes under an order from
    rare to frequent, and passes bounds on sizes, places and parity sketches; then its
    prefixes under two more orders, coarser in frequency and with ties broken
    otherwise, must meet. No test loses a pair. Only for pairs that all orders agree on
    are whole sets moved and counted (on 40-bit hashes of shingles).
    Rows without a key or text, and texts of fewer than ``least_words`` words, take no
    part; a key repeated with the same text counts once.
    """
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    chunks, name = bucketed(shingle_chunks(texts, "_key", "_text", width, least_words), "chunk", buckets)
    sets = chunks.select("chunk", F.posexplode("digests").alias("at", "digest")).select("digest", (F.col("chunk") * CHUNK_SETS + F.col("at")).alias("own"))
    first = sets.groupBy("digest").agg(F.min("own").alias("id"))
    ids = staged(sets.join(first, "digest").select("own", "id"), "ids")
    members = chunks.select("chunk", F.explode(F.arrays_zip("keys", "at")).alias("m")).select(F.col("m.keys").alias("_key"), (F.col("chunk") * CHUNK_SETS + F.col("m.at")).alias("own"))
    members = staged(members.join(ids, "own").select("_key", "id").distinct(), "members")
    by_chunk = [F.shiftright("id", 16).alias("chunk"), (F.col("id") % CHUNK_SETS).cast("int").alias("at")]
    kept = staged(ids.where("own = id").select(*by_chunk).groupBy("chunk").agg(F.collect_list("at").alias("kept")), "kept")
    live = chunks.select("chunk", "sizes", "hashes").join(kept, "chunk")
    shingles = chunks.agg(F.sum("n")).first()[0] or 0
    levels = staged(frequency_levels(live, max(buckets, shingles // RANGE_SHINGLES + 1)), "levels")
    live = live.join(levels, "chunk")
    blocks = int(shingles * (1 - threshold) // block_entries) + 1
    candidates = staged(candidate_pairs(block_rows(live, blocks, threshold, hot), blocks, threshold), "candidates")
    need = candidates.select(F.col("a").alias("id")).union(candidates.select(F.col("b").alias("id"))).distinct()
    wanted = live.join(need.select(*by_chunk).groupBy("chunk").agg(F.collect_list("at").alias("wanted")), "chunk")
    content = staged(contents(wanted, threshold), "content")

    def with_both(pairs: DataFrame, *columns: str) -> DataFrame:
        for end in ("a", "b"):
            pairs = pairs.join(content.select(F.col("id").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in columns]), end)
        return pairs.select("a", "b", *[f"{c}_{end}" for end in ("a", "b") for c in columns])

    agreed = with_both(candidates, "second", "third").mapInArrow(meeting, "a long, b long")
    links = with_both(agreed, "shingles").mapInArrow(lambda it: verified(it, threshold), "a long, b long, similarity double")
    links = staged(links, "links")
    spark.sql(f"DROP TABLE {name}")
    return NearDuplicates(members, links, key)
