"""Operators over a whole corpus against brute force: repeated passages, set join, decontamination, nearest vectors."""

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import components, decontaminate, nearest, set_join, suffixes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def split(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def shingle_set(text, k):
    w = split(text)
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def slow_components(rows, rule):
    sets = {i: shingle_set(t, rule.k) for i, t in rows if i is not None}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if y >= x:
                break
            if sets[x] and sets[y] and rule.den * len(sets[x] & sets[y]) >= rule.num * len(sets[x] | sets[y]):
                a, b = find(x), find(y)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def corpus(n=260):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)]
    families = [[rng.choice(vocabulary) for _ in range(rng.randint(1, 90))] for _ in range(25)]
    rows = []
    for i in range(n):
        text = list(rng.choice(families[:3] if i % 2 else families))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
            text[rng.randrange(len(text))] = rng.choice(vocabulary)
        rows.append((i * 7 + 3, " ".join(text)))
    long = [rng.choice(vocabulary) for _ in range(2600)]
    for i in range(4):
        text = list(long)
        for _ in range(i * 25):
            text[rng.randrange(len(text))] = rng.choice(vocabulary)
        rows.append((9000 + i, " ".join(text)))
    return rows + [(5000, None), (5001, ""), (5002, " \n "), (5003, "one"), (5004, "ONE"), (5005, "a b c d"), (5006, "A B C D"), (None, "one"), (3, rows[0][1])]


@pytest.mark.parametrize("rule", [set_join.Rule(4, 85, 100), set_join.Rule(5, 80, 100)])
def test_set_join(spark, rule):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("clash"))
    got = set_join.jaccard_components(df, rule).collect()
    assert len(got) == len(rows)
    expected = slow_components(rows, rule)
    for r in got:
        assert (r.n_shingles, r.component_id) == ((1, None) if r.doc_id is None else expected[r.doc_id])


def test_long_lists_are_cut_and_stay_whole(spark, monkeypatch):
    # a passage in texts that are not alike stands deep in their sets; no rough groups, short chunks
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(30)]
    rows = []
    for i in range(40):
        own = [f"o{i}x{j}" for j in range(rng.randint(3, 90))]
        rows += [(10 * i + c, " ".join(passage + own[: len(own) - c])) for c in range(3)]
    monkeypatch.setattr(set_join, "LIST_CHUNK", 8)
    monkeypatch.setattr(set_join, "rough_edges", lambda reps, rule: reps.select(F.col("doc_id").alias("u"), F.col("doc_id").alias("v")).limit(0))
    rule = set_join.Rule(4, 85, 100)
    got = set_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), rule).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == slow_components(rows, rule)


def test_rows_of_one_doc_id_are_one_vertex(spark):
    a, b, c = ("alpha beta gamma delta epsilon zeta", "one two three four five six", "red green blue white black grey")
    rows = [(2, a), (5, a), (5, b), (3, b), (9, c), (9, ""), (4, c), (9, None), (7, None), (7, ""), (8, c + " x"), (8, b), (None, a)]
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in set_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), set_join.Rule(4, 85, 100)).collect())
    assert got == sorted([(2, 3, 2), (5, 3, 2), (5, 3, 2), (3, 3, 2), (9, 3, 4), (9, 0, 4), (4, 3, 4), (9, 0, 4), (7, 0, 7), (7, 0, 7), (8, 4, 2), (8, 3, 2), (0, 3, None)])


def test_set_join_of_an_empty_table(spark):
    assert set_join.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_bitmaps_never_overstate_the_difference():
    rng = np.random.default_rng(2)
    for n in (50, 3000):
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[: n // 2], rng.integers(0, 1 << 63, n // 3).astype(np.uint64)]))
        small, wide, large = set_join.bitmaps([set_join.bitmap(a), set_join.bitmap(b)])
        difference = len(a) + len(b) - 2 * set_join.common(a, b)
        assert np.bitwise_count(small[0] ^ small[1]).sum() <= difference
        if large.all():
            assert np.bitwise_count(wide[0] ^ wide[1]).sum() <= difference


def test_prefix_and_difference_are_safe():
    rule = set_join.Rule(4, 85, 100)
    for a in range(1, 60):
        for b in range(1, 60):
            for n in range(min(a, b) + 1):
                if rule.links(n, a, b):
                    assert a - n < rule.prefix(a) and b - n < rule.prefix(b) and a + b - 2 * n <= rule.difference(a, b)


def test_list_pairs_equal_all_pairs(spark):
    rule, rng = set_join.Rule(4, 85, 100), random.Random(6)
    mixed = [rng.choice([7, 19, 20, 26, 27, 40, 46, 90]) for _ in range(1500)]
    lists = [
        [(20, 2)] * 64 + [(7, 1)] * 64 + [(20, 3)] * 64,
        [(40, 2)] * 64 + [(20, 3)] * 64 + [(46, 4)] * 64,  # a block of small sets before one of large sets
        [(20, 1)] * 64 + [(19, 2), (20, 2)] * 32,  # 20 and 19 may differ in more shingles than 20 and 20
        [(n, rng.randrange(rule.prefix(n))) for n in mixed[:500]],
        [(n, rng.randrange(rule.prefix(n))) for n in mixed],
    ]
    bits = bytearray(set_join.SMALL_BITS // 8)
    data = [(token, pos, token * 10_000 + i, n, token * 10_000 + i // 2, bits, len(rows)) for token, rows in enumerate(lists) for i, (n, pos) in enumerate(rows)]
    df = spark.createDataFrame(data, "token long, pos int, doc_id long, n int, label long, bits binary, rows long")
    got = {(r.u, r.v) for r in set_join.list_pairs(df, rule).collect()}
    expected = set()
    for token, rows in enumerate(lists):
        n, pos = (np.array(c) for c in zip(*rows, strict=True))
        label = np.arange(len(n)) // 2
        ok = (label[:, None] != label[None]) & (100 * np.minimum(n[:, None], n[None]) >= 85 * np.maximum(n[:, None], n[None]))
        ok &= pos[:, None] + pos[None] <= rule.difference(n[:, None], n[None])
        expected |= {(token * 10_000 + int(a), token * 10_000 + int(b)) for a, b in zip(*np.nonzero(np.tril(ok)), strict=True)}
    assert len(expected) > 10_000 and got == expected


def test_components(spark):
    rng = random.Random(8)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)]
    got = {r.id: r.component for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    label = {x: x for e in edges for x in e}
    for _ in range(400):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    touched = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: label[x] for x in touched}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def slow_repeats(rows, least):
    counts, seen = collections.Counter(), []
    for i, text in rows:
        w = split(text)
        for s in range(len(w) - least + 1):
            counts[tuple(w[s : s + least])] += 1
            seen.append((i, s, tuple(w[s : s + least])))
    out = collections.defaultdict(set)
    for i, s, window in seen:
        if counts[window] > 1:
            out[i].update(range(s, s + least))
    return {i: sorted(v) for i, v in out.items()}


@pytest.mark.parametrize(("least", "run_rows"), [(50, 20_000), (11, 20_000), (11, 3), (12, 1)])
def test_repeated_passages(spark, least, run_rows):
    rng = random.Random(3)
    bases = [[str(rng.randrange(50)) for _ in range(rng.randint(5, 200))] for _ in range(20)]
    passage, rows = [str(rng.randrange(3)) for _ in range(70)], []
    for i in range(200):
        w = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            w[rng.randrange(len(w))] = str(rng.randrange(50, 99))
        if i % 3 == 0:
            j = rng.randrange(len(w))
            w = w[:j] + passage[: rng.randint(40, 70)] + w[j:]
        rows.append((i, " ".join(w)))
    rows += [(1000, None), (1001, ""), (1002, "a " * 300), (1003, "b " * 49), (1004, "B " * 49)]
    got = {r.doc_id: [k for s in r.spans for k in range(s.start, s.end)] for r in suffixes.repeated_passages(spark.createDataFrame([*rows, (None, "a " * 300)], "doc_id long, text string").withColumn("key", F.lit(1)), least, run_rows).collect()}
    assert got == slow_repeats(rows, least)
    assert suffixes.repeated_passages(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def slow_matches(rows, items, threshold):
    shingles = lambda w: collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else collections.Counter([tuple(w)] if w else [])
    out = {}
    for item, text in items:
        w = split(text)
        if not w:
            continue
        mine = shingles(w)
        for doc, document in rows:
            d, best = split(document), 0.0
            for at in range(max(1, len(d) - len(w) + 1)):
                other = shingles(d[at : at + len(w)])
                both = sum((mine & other).values())
                if other:
                    best = max(best, both / (sum(mine.values()) + sum(other.values()) - both))
            if best >= threshold:
                out[doc, item] = round(best, 9)
    return out


@pytest.mark.parametrize("pass_chars", [1 << 20, 300])
def test_decontamination(spark, pass_chars):
    rng = random.Random(6)
    vocabulary = [f"v{i}" for i in range(500)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([3, 5, 12, 30, 55])))) for i in range(30)] + [(90, None), (91, "")]
    rows = []
    for i in range(150):
        w = [rng.choice(vocabulary) for _ in range(rng.randint(0, 150))]
        if i % 2:
            passage = split(items[i % 30][1])
            if i % 3 == 0 and len(passage) > 10:
                passage[rng.randrange(len(passage))] = "changed"
            w[len(w) // 2 : len(w) // 2] = passage
        rows.append((i, " ".join(w)))
    rows += [(1000, None), (1001, ""), (1002, " ".join(split(items[4][1])[:-1]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in decontaminate.contaminated(docs, bench, pass_chars=pass_chars).collect()}
    expected = slow_matches(rows, items, 0.8)
    assert expected and got == expected
    left = {r.doc_id for r in decontaminate.clean(docs, bench, pass_chars=pass_chars).collect()}
    assert left == {i for i, _ in rows} - {d for d, _ in expected}
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0


def prints_of(rows):
    return decontaminate.fingerprints(np.stack([decontaminate.signs(r).astype(np.int32).sum(0) for r in rows]))


def test_blocks_find_everything_within_the_radius():
    rng = np.random.default_rng(0)
    shingles = [rng.integers(0, 1 << 63, 30).astype(np.uint64) for _ in range(400)]
    bench = decontaminate.Benchmark(list(range(400)), shingles, np.full(400, 34), 0.8)
    flips = [np.bitwise_or.reduce(np.uint64(1) << rng.choice(64, decontaminate.RADIUS, replace=False).astype(np.uint64)) for _ in range(400)]
    prints = np.concatenate([bench.prints ^ np.array(flips), rng.integers(0, 1 << 63, 600).astype(np.uint64)])
    w, i = bench.candidates(prints, np.full(len(prints), 34))
    expected = {(a, b) for a in range(len(prints)) for b in range(400) if int(prints[a] ^ bench.prints[b]).bit_count() <= decontaminate.RADIUS}
    assert set(zip(w.tolist(), i.tolist(), strict=True)) == expected >= {(a, a) for a in range(400)}
    assert len(bench.near(prints[400:], 34)[0]) < 0.2 * 600 * 400  # the index leaves most pairs out


def test_blocks_of_many_items_are_looked_up():
    rng = np.random.default_rng(3)
    n = 6000
    bench = decontaminate.Benchmark(list(range(n)), list(rng.integers(0, 1 << 63, (n, 3)).astype(np.uint64)), np.full(n, 7), 0.8)
    values, _, _, at = bench.index[7, 0]
    assert len(decontaminate.NEAR) < len(values) and at is not None
    prints = np.concatenate([bench.prints[:50] ^ np.uint64((1 << 19) - 1), bench.prints[50:60], rng.integers(0, 1 << 63, 100).astype(np.uint64)])
    w, i = bench.candidates(prints, np.full(len(prints), 7))
    expected = np.nonzero(np.bitwise_count(prints[:, None] ^ bench.prints[None]) <= decontaminate.RADIUS)
    assert set(zip(w.tolist(), i.tolist(), strict=True)) == set(zip(*(x.tolist() for x in expected), strict=True)) >= {(a, a) for a in range(60)}
    assert len(w) == len(expected[0])
    of = decontaminate.blocks(prints)
    for b in range(decontaminate.BLOCKS):
        w, v = bench.near_values(of[:, b], 7, b)
        slow = np.nonzero(np.bitwise_count(of[:, b, None] ^ bench.index[7, b][0][None]) <= decontaminate.BLOCK_RADIUS)
        assert sorted(zip(w.tolist(), v.tolist(), strict=True)) == sorted(zip(*(x.tolist() for x in slow), strict=True))


def test_similar_windows_have_near_fingerprints():
    rng = np.random.default_rng(1)
    distances = []
    for _ in range(4000):
        m = int(rng.integers(20, 120))
        d = int((m - 1) * 0.111)  # most shingles that may differ at a similarity of 0.8
        a = rng.integers(0, 1 << 63, m + d).astype(np.uint64)
        assert decontaminate.similarity(a[:m], a[d:]) >= 0.8
        x, y = prints_of([a[:m], a[d:]])
        distances.append(int(x ^ y).bit_count())
    assert np.mean(np.array(distances) <= decontaminate.RADIUS) > 0.998


def test_items_and_documents_that_repeat_or_lack_ids(spark):
    item = " ".join(f"i{i}" for i in range(20))
    bench = spark.createDataFrame([(1, item), (2, item), (None, item), (3, None), (1, item)], "item_id long, text string")
    docs = spark.createDataFrame([(None, f"x {item} y"), (7, item), (7, item), (8, "other words " * 60_000 + item), (9, None), (10, "")], "doc_id long, text string")
    got = collections.Counter((r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect())
    assert got == collections.Counter({(d, i): (2 if d == 7 else 1) * (2 if i == 1 else 1) for d in (None, 7, 8) for i in (1, 2, None)})
    assert {r.doc_id for r in decontaminate.clean(docs, bench).collect()} == {9, 10}


@pytest.mark.parametrize("sent", [1 << 24, 400])
def test_nearest(spark, sent):
    rng = np.random.default_rng(1)
    vectors = [(i, rng.normal(size=12).astype(np.float32).tolist()) for i in range(900)]
    vectors += [(1000 + i, [0.5] * 12) for i in range(40)]
    odd = [(2000, None), (2100, [0.0] * 12), (2200, [float("nan")] * 12), (2300, [None] * 12), (2400, [float("inf")] + [1.0] * 11), (None, [1.0] * 12), (2500, [1.0] * 3), (2600, [])]
    df = spark.createDataFrame(vectors + odd, "vec_id long, embedding array<float>").withColumn("rank", F.lit(1))
    got = collections.defaultdict(list)
    for r in nearest.nearest(df, df.filter("vec_id % 100 = 0"), sent_bytes=sent).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.score, r.vec_id))
        assert r.rank == len(got[r.query_id])
    x = {i: np.array(v, np.float64) for i, v in vectors}
    for q in [i for i, _ in vectors if i % 100 == 0]:
        total = {i: 0.0 for i in x if i != q}
        for i in total:
            for d in range(12):
                total[i] += (x[q][d] - x[i][d]) ** 2
        assert got[q] == sorted((float(np.sqrt(t)), i) for i, t in total.items())[:10]
    assert set(got) == {i for i, _ in vectors if i % 100 == 0}
    assert nearest.nearest(df.limit(0), df.limit(0)).count() == 0


def test_nearest_over_the_whole_range_of_doubles(spark):
    rng = np.random.default_rng(2)
    scales = [1e200, 1.0, 1e-200, 1e-300, 1e307]
    vectors = [(i, (np.clip(rng.normal(size=6), -1.7, 1.7) * scales[i % 5]).tolist()) for i in range(300)]
    vectors[7] = (7, [5e-324] * 6)
    df = spark.createDataFrame([*vectors, vectors[0]], "vec_id long, embedding array<double>")
    asked = spark.createDataFrame([*vectors[:10], vectors[0], (1, vectors[50][1])], df.schema)
    got = collections.defaultdict(list)
    for r in nearest.nearest(df, asked).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    from fractions import Fraction

    exact = {i: [Fraction(x) for x in v] for i, v in vectors}
    for q in range(10):
        d = {i: sum((a - b) ** 2 for a, b in zip(exact[q], v, strict=True)) for i, v in exact.items() if i != q}
        if q != 1:
            found = sorted(got[q])
            assert [r[0] for r in found] == list(range(1, 11))
            for rank, i, score in found:
                # as near as it says, to the precision of doubles, and no nearer one is left out
                smaller = sum(d[j] * (1 + Fraction(1, 10**12)) < d[i] for j in d)
                assert smaller < rank or i == 0
                assert score == pytest.approx(float(np.sqrt(float(d[i] / (Fraction(10) ** 616)))) * 1e308 if d[i] > 10**300 else score, rel=1e-9)
    assert sorted(r[0] for r in got[1]) == sorted([*range(1, 11), *range(1, 11)])  # two vectors of one id are two queries


def test_repeated_passages_in_very_long_texts(spark):
    rng = random.Random(21)
    vocabulary = [f"w{i}" for i in range(5000)]
    long = [rng.choice(vocabulary) for _ in range(120_000)]
    passage = [rng.choice(vocabulary) for _ in range(70)]
    long[1000:1070] = long[90_000:90_070] = passage
    other = [*(rng.choice(vocabulary) for _ in range(40)), *passage[5:65]]
    rows = [(1, " ".join(long)), (2, " ".join(other)), (3, " ".join(other)), (3, "unlike " * 10)]
    got = {r.doc_id: [(s.start, s.end) for s in r.spans] for r in suffixes.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: [(1000, 1070), (90_000, 90_070)], 2: [(0, 100)], 3: [(0, 100)]}
