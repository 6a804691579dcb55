import datetime as dt
from collections import defaultdict

import numpy as np
import pytest

CAND = "candidate_id long, profile string, n_tokens long, counted_at timestamp, source string"


def frames(spark, candidates, plans, targets):
    profiles = spark.createDataFrame([("a", "web"), ("b", " Code "), ("c", "math")], "profile string, source string")
    day = dt.datetime(2025, 1, 1)
    rows = [(i, p, n, None if d is None else day + dt.timedelta(days=d), "clash") for i, p, n, d in candidates]
    return spark.createDataFrame(rows, CAND), profiles, spark.createDataFrame(plans, "mix_id string, size_factor double"), spark.createDataFrame(targets, "mix_id string, source string, weight double, max_epochs int")


def test_mix(spark):
    from siltstone.llm import mixing

    rng = np.random.default_rng(1)
    candidates = [(i, ["a", " A", "b", "b ", "zz", None][i % 6], int(rng.integers(1, 900)), 1) for i in range(900)]
    candidates += [(i, "a", 10**6, 2) for i in (0, 1)] + [(5000, "a", None, 1), (5001, "a", 0, 1), (None, "a", 9, 1), (5002, "a", 50, None)]
    plans = [("m1", 0.5), ("m2", 6.0), ("m2", 6.0), ("m3", None)]
    targets = [("m1", "WEB ", 3.0, 2), ("m1", "web", 3.0, 2), ("m1", "code", 1.0, 1), ("m1", "none", 4.0, 9), ("m1", "math", -1.0, 1), ("m1", "x", None, 1), ("m2", "web", 1.0, 3), ("m2", "code", 1.0, 40), ("m3", "web", 1.0, 1), ("m1", "x", float("nan"), 1)]
    mix = mixing.mix(*frames(spark, candidates, plans, targets), cell_rows=40)
    size = {i: n for i, p, n, d in candidates[:900]} | {5002: 50}
    kind = {i: {"a": "web", "b": "code"}.get((p or "").strip().lower()) for i, p, n, d in candidates[:900]} | {5002: "web"}
    have = defaultdict(int)
    for i, s in kind.items():
        have[s] += size[i] if s else 0
    total = have["web"] + have["code"]
    report = {(r.mix_id, r.source): r for r in mix.report.collect()}
    assert set(report) == {("m1", "web"), ("m1", "code"), ("m1", "none"), ("m2", "web"), ("m2", "code")}
    assert report["m1", "web"].share == pytest.approx(3 / 8) and report["m1", "none"].available == 0
    drawn = defaultdict(lambda: defaultdict(int))
    for r in mix.chosen.collect():
        assert (r.mix_id, r.candidate_id) and r.n_tokens == size[r.candidate_id] and kind[r.candidate_id] == r.source
        drawn[r.mix_id, r.source][r.candidate_id] += r.copies
    for key, r in report.items():
        copies = drawn[key]
        assert max(copies.values(), default=0) <= r.max_epochs
        want = min(r.share * (0.5 if key[0] == "m1" else 6.0) * total, r.max_epochs * have.get(key[1], 0))
        got = sum(n * size[i] for i, n in copies.items())
        assert got == r.tokens and abs(got - want) <= 0.05 * want + 900
        if copies:
            assert max(copies.values()) - min([*copies.values(), *([0] if len(copies) < r.used else [])]) <= 1
    assert {(r.mix_id, r.source) for r in mixing.unfilled(mix.report).collect()} == {("m1", "none"), ("m2", "web")}
    again = mixing.mix(*frames(spark, candidates[::-1], plans, targets), cell_rows=7)
    assert sorted(map(tuple, again.chosen.collect())) == sorted(map(tuple, mix.chosen.collect()))


def test_mix_of_nothing(spark):
    from siltstone.llm import mixing

    mix = mixing.mix(*frames(spark, [], [("m", 1.0)], [("m", "web", 1.0, 1)]))
    assert mix.chosen.count() == 0
    (row,) = mix.report.collect()
    assert (row.available, row.tokens, row.actual_share) == (0, 0, 0.0)


def test_harmonic_bins():
    from siltstone.llm.packing import harmonic_bins, length_classes

    rng = np.random.default_rng(2)
    for capacity, n in ((10, 0), (10, 50), (1024, 3000), (16384, 20_000)):
        sizes = np.minimum(capacity, rng.geometric(3 / capacity, n))
        bins, left, opened = harmonic_bins(sizes, capacity)
        used = np.bincount(bins, sizes, minlength=len(left)) if n else np.zeros(0)
        assert (used + left == capacity).all() and (left >= 0).all()
        if n:
            kind, bound = length_classes(sizes, capacity)
            assert (bound >= sizes).all() and (capacity // bound == kind).all()
            # bins are opened by a fixed number of items of a part; of each part at most one by fewer
            first = [(bound[bins == b].max(), int((bound[bins == b] == bound[bins == b].max()).sum()), k) for b, k in enumerate(opened.tolist())] if n <= 3000 else []
            short = [u for u, m, k in first if m != k]
            assert len(short) == len(set(short)) and all(m <= k for _, m, k in first)
        if n > 100:
            assert left.sum() <= 0.03 * sizes.sum()
    bins, left, _ = harmonic_bins(np.full(1000, 300), 1000)
    assert np.bincount(bins).tolist() == [3] * 333 + [1]


def test_pack(spark):
    from siltstone.llm.packing import pack, packing_faults, packing_report

    sizes = [(i, int(n), "x") for i, n in enumerate(np.random.default_rng(5).integers(0, 300, 400))] + [(1000, 2500, "x"), (1001, None, "x"), (1002, 200, "x"), (1002, 10, "x"), (None, 5, "x")]
    packed = pack(spark.createDataFrame(sizes, "doc_id long, n_tokens long, sequence string"), {"s": 100, "l": 1000}, shard_docs=90)
    rows = packed.collect()
    expected = {i: n or 0 for i, n, _ in sizes if i is not None} | {1002: 200}
    for bucket, capacity in (("s", 100), ("l", 1000)):
        own = [r for r in rows if r.bucket == bucket]
        docs, bins = defaultdict(list), defaultdict(list)
        for r in own:
            docs[r.doc_id].append(r)
            if r.sequence is not None:
                bins[r.sequence].append(r)
        assert {i: sum(r.tokens for r in d) for i, d in docs.items()} == expected
        for i, d in docs.items():
            assert sorted(r.piece for r in d) == list(range(len(d))) and (len(d) == 1 or expected[i] > capacity)
            assert len(d) == max(1, -(-expected[i] // capacity))
        for b in bins.values():
            assert sum(r.tokens for r in b) + b[0].unused == capacity and len({r.unused for r in b}) == 1
    (long,) = [r for r in packing_report(packed, {"s": 100, "l": 1000}).collect() if r.bucket == "l"]
    assert long.sequences <= 1.1 * long.least_sequences
    assert sorted(map(tuple, packing_faults(packed, spark.createDataFrame(sizes, "doc_id long, n_tokens long, x string"), {"s": 100, "l": 1000}).collect())) == [(b, 403, 0, 0, 0) for b in "ls"]
    assert pack(spark.createDataFrame([], "doc_id long, n_tokens long"), {"s": 10}).count() == 0
