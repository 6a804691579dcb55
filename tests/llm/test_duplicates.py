import itertools
import json

import numpy as np
import regex


def shingles(text, width):
    words = regex.findall(r"\p{Han}|[\p{L}\p{N}--\p{Han}]+", __import__("unicodedata").normalize("NFKC", text).lower(), regex.V1)
    return len(words), {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute(rows, width, threshold, least):
    sets = {i: shingles(t, width) for i, t in rows if i is not None and t}
    ok = {i: s for i, (n, s) in sets.items() if n >= max(least, width)}
    return {(a, b) for a, b in itertools.combinations(sorted(ok), 2) if len(ok[a] & ok[b]) >= threshold * len(ok[a] | ok[b]) - 1e-9}


def corpus(seed, n=160):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(60)] + list("的了在和是不有对")
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.6:
            base = rows[int(rng.integers(len(rows)))][1].split(" ")
            for _ in range(int(rng.integers(0, 5))):
                base[int(rng.integers(len(base)))] = str(rng.choice(words))
        else:
            base = rng.choice(words, int(rng.integers(5, 70))).tolist()
        rows.append((i, " ".join(base)))
    rows += [(900, None), (901, ""), (902, "Ｆｕｌｌ " * 3), (rows[3][0], rows[3][1]), (903, rows[3][1].upper() + " !"), (None, rows[3][1])]
    return rows


def test_near_duplicates(spark):
    from siltstone.llm.neardup import near_duplicates

    for width, threshold, least, hot, blocks in ((3, 0.6, 20, 20_000, 10**6), (2, 0.5, 4, 4, 400)):
        rows = corpus(width)
        df = spark.createDataFrame([(i, t, 1) for i, t in rows], "sample_id long, text string, n int").repartition(3)
        near = near_duplicates(df, width=width, threshold=threshold, least_words=least, hot=hot, block_entries=blocks)
        found = [tuple(r) for r in near.pairs().collect()]
        expected = brute(rows, width, threshold, least)
        assert len(found) == len(set(found)) and set(found) == expected and len(expected) > 30
    groups = {r.sample_id: r.group_id for r in near.groups().collect()}
    label = {i: i for i in groups}
    for _ in range(len(label)):
        for a, b in sorted(expected):
            label[a] = label[b] = min(label[a], label[b])
    assert groups == label


def test_long_and_hot(spark):
    from siltstone.llm.neardup import near_duplicates

    long = " ".join(f"t{i}" for i in range(30_000))
    rows = [(1, long), (2, long.replace("t77 ", "x ")), (3, "one two three four five six")] + [(10 + i, "the same copied text of eight words here") for i in range(200)]
    near = near_duplicates(spark.createDataFrame(rows, "sample_id long, text string"))
    assert [(r.sample_id_a, r.sample_id_b) for r in near.pairs().collect() if r.sample_id_a < 10] == [(1, 2)]
    own = [r for r in near.groups().collect() if r.sample_id >= 10]
    assert {(r.group_id, r.copies, r.links) for r in own} == {(10, 200, 0)}
    clash = spark.createDataFrame([(i, t, 1, "x") for i, t in rows[:2]], "id long, chunk string, n int, digest string")
    assert [tuple(r) for r in near_duplicates(clash, "id", "chunk").pairs().collect()] == [(1, 2)]
    none = near_duplicates(spark.createDataFrame([], "sample_id long, text string"))
    assert none.pairs().count() == 0 and none.groups().count() == 0


def test_filters_keep_similar_pairs():
    from siltstone.llm import neardup

    rng = np.random.default_rng(0)
    value = np.unique(rng.integers(0, 1 << 40, 2000).astype(np.uint64))
    level_of = rng.integers(0, 80, len(value)).astype(np.uint8)
    for _ in range(300):
        n = int(rng.integers(5, 400))
        a = np.sort(rng.choice(len(value), n, replace=False))
        b = np.unique(np.concatenate([a[rng.random(n) > 0.15], rng.choice(len(value), 1 + n // 9)]))
        common = len(np.intersect1d(a, b))
        sizes, h, level = np.array([len(a), len(b)]), value[np.concatenate([a, b])], level_of[np.concatenate([a, b])]
        assert neardup.shared([value[a]], [value[b]], 40).tolist() == [common]
        if common >= 0.6 * len(np.union1d(a, b)):
            for k in range(3):
                row, u, rank, place = neardup.prefixes(h, level, sizes, 0.6, k)
                assert np.intersect1d(u[row == 0], u[row == 1]).size
                assert (rank >> neardup.ORDERS[k][0] == level_of[np.searchsorted(value, u)] >> neardup.ORDERS[k][0]).all()
            for hot in (20_000, 3):
                row, u, _ = neardup.prefix_keys(h, level, sizes, np.array([7, 99]), 0.6, hot)
                assert np.intersect1d(u[row == 0], u[row == 1]).size or (level_of[np.intersect1d(a, b)] == 0).any()
            width = neardup.sketch_bytes(sizes)
            data = np.frombuffer(neardup.parity_sketches(h, sizes), np.uint8)
            p, q = (neardup.folded(x[None], width.min()) for x in (data[: width[0]], data[width[0] :]))
            assert (len(a) + len(b) - np.bitwise_count(p ^ q).sum()) / 2 >= common


def test_shingles_are_packed_whole():
    from siltstone.llm import neardup

    h = np.random.default_rng(1).integers(0, 1 << 40, 1000).astype(np.uint64)
    assert (neardup.unpacked(neardup.packed(h)) == h).all()
    for _, *factors in neardup.ORDERS:
        assert (neardup.unmixed(neardup.mixed(h, *factors), *factors) == h).all()
    digests, counts, whole = neardup.shingle_hashes(["a b c a b c", None, "", "x", "A, B; C a-b_c"], 2, 3)
    assert [d is not None for d in digests] == [True, False, False, False, True] and digests[0] == digests[4]
    assert counts.tolist() == [3, 0, 0, 0, 3] and (whole[:3] == whole[3:]).all()


FORMS = [
    '{"a": "Hello, World", "b": [1, 2.0], "c": null}',
    '{ "c":null,"b":[1.0,2e0], "a":"hello world!" }',
    '{"a": "Hello World", "b": [2, 1], "c": null}',
    '{"a": "Hello World", "b": [1, 2]}',
    '{"a": "Hello World", "b": [1, 2], "c": false}',
    '{"a": "Hello World", "b": [1, 2], "c": 0}',
    '{"A": "Hello World", "b": [1, 2], "c": null}',
    '{"a": 12, "b": {"x": "é", "y": []}}', '{"b": {"y": [], "x": "É."}, "a": 1.2e1}', '{"a": "12", "b": {"x": "é", "y": []}}',
    '{"a": 100000000000000000000001}', '{"a": 100000000000000000000002}', '{"a": -0.0}', '{"a": 0}', '{"a": 1e-3}', '{"a": 0.001}', '{"a":1e400}', '{"a":1e401}',
    "[1]", '"x"', "", None, '{"a": NaN}', "{'a': 1}", '{"a": 1}}', '{"a": "\\ud800"}', "{}", " {} ",
]


def reference_form(value):
    if isinstance(value, dict):
        return ("o", tuple(sorted((k, reference_form(v)) for k, v in value.items())))
    if isinstance(value, list):
        return ("a", tuple(map(reference_form, value)))
    if isinstance(value, str):
        return ("s", regex.sub(r"[^\p{L}\p{N}]", "", value.lower()))
    if value is None or isinstance(value, bool):
        return ("c", str(value))
    return ("n", __import__("decimal").Decimal(value).normalize() + 0)


def expected_groups(rows):
    from decimal import Decimal

    def refuse(_):
        raise ValueError

    groups = {}
    for i, text in rows:
        try:
            value = json.loads(text or "", parse_float=Decimal, parse_int=Decimal, parse_constant=refuse)
        except ValueError:
            continue
        if isinstance(value, dict) and i is not None:
            groups.setdefault(repr(reference_form(value)), set()).add(i)
    return sorted(sorted(g) for g in groups.values())


def test_forms(spark, monkeypatch):
    from siltstone.llm import forms

    rows = [(i, t) for i, t in enumerate(FORMS)] + [(100 + i, t) for i, t in enumerate(FORMS[:3])] + [(0, FORMS[0]), (None, FORMS[0])]
    df = spark.createDataFrame([(i, t, b"x") for i, t in rows], "record_id long, payload string, digest binary").repartition(3)

    def check():
        groups, members = forms.form_groups(df)
        by = {r.first_id: r.copies for r in groups.collect()}
        own = {i: {i} for i in by}
        for r in members.collect():
            own[r.first_id].add(r.record_id)
        assert {i: len(x) for i, x in own.items()} == by
        assert sorted(sorted(x) for x in own.values()) == expected_groups(rows)

    check()
    none = forms.form_groups(df.limit(0))
    assert none[0].count() == 0 and none[1].count() == 0


def test_collisions_are_told_apart(spark):
    from siltstone.llm import forms

    df = spark.createDataFrame([(1, '{"a": 1}'), (2, '{"a": 2}'), (3, '{"a": 1.0}')], "record_id long, payload string")
    real = forms.record_forms

    def colliding(records, key="record_id", payload="payload"):
        from pyspark.sql import functions as F

        return real(records, key, payload).withColumn("digest", F.lit(b"same"))

    forms.record_forms = colliding
    try:
        groups, members = forms.form_groups(df)
        assert sorted(map(tuple, groups.collect())) == [(1, 2), (2, 1)] and [tuple(r) for r in members.collect()] == [(1, 3)]
    finally:
        forms.record_forms = real


def test_records_nested_to_any_depth(spark):
    from siltstone.llm import forms

    def nested(depth, leaf, blank=""):
        return ('{"a":' + blank + "[1,") * depth + leaf + "]}" * depth

    rows = []
    for n, depth in enumerate((3, 900, 3_000, 60_000)):
        rows += [(10 * n + 1, nested(depth, '"X y"')), (10 * n + 2, nested(depth, '"xY!"', " ")), (10 * n + 3, nested(depth, '"z"')), (10 * n + 4, nested(depth, '"z"')[:-1])]
    groups, members = forms.form_groups(spark.createDataFrame(rows, "record_id long, payload string"))
    assert sorted(map(tuple, members.collect())) == [(10 * n + 1, 10 * n + 2) for n in range(4)]
    assert sorted(map(tuple, groups.collect())) == sorted([(10 * n + 1, 2) for n in range(4)] + [(10 * n + 3, 1) for n in range(4)])


def test_both_parsers_agree():
    from siltstone.llm import forms

    good = ['{"a": [1, -0.50, 2e3, null, true, false, "\\u00e9\\n"], "b": {}, "c": [], "a": {"x": [[]]}}', ' \n{ "q" : "w" , "e" : [ ] } ', '{"a":1E+2}']
    bad = ["{", "{}x", '{"a":}', '{"a":[1,]}', '{"a":1,}', "{'a':1}", '{"a":01}', '{"a":NaN}', '{"a":-Infinity}', '{"a" 1}', '{"a":[1 2]}', '{"a":"\n"}', '{"a":-}', "{]", '{"a":[}']
    for text in good:
        assert forms.parse_deep(text) == forms._DECODE(text), text
    for text in bad:
        for parse in (forms.parse_deep, forms._DECODE):
            try:
                parse(text)
            except ValueError:
                continue
            raise AssertionError(text)
