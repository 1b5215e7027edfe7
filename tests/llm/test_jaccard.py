"""Jaccard classes against brute force."""

import random
import re

import numpy as np
import pytest

from matchlab.llm import jaccard


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def shingles(text):
    w = words_of(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[root(i)] = min(low.get(root(i), d), d)
    return sorted(((d, len(s), low.get(root(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def corpus(seed, n=220):
    rnd = random.Random(seed)
    word = lambda: "w" + str(int(rnd.paretovariate(0.7)) % 3000)
    passage = [word() for _ in range(40)]
    rows, base = [], [[word() for _ in range(rnd.choice([6, 30, 120, 400]))] for _ in range(12)]
    hub = [word() for _ in range(150)]
    for i in range(n):
        kind = rnd.random()
        w = list(rnd.choice(base) if kind < 0.4 else hub)
        if kind > 0.75:
            w = [word() for _ in range(rnd.randint(0, 80))] + (passage if kind > 0.85 else [])
        for _ in range(rnd.choice([0, 1, 1, 2, 4])):
            if w:
                w[rnd.randrange(len(w))] = rnd.choice(["Edit", "EDIT", "x"]) + str(rnd.randrange(3000))
        if rnd.random() < 0.2:
            w = w[: max(1, int(len(w) * 0.9))]
        rows.append((i, rnd.choice([" ", "\n", "\t "]).join(w)))
    rows += [(900, None), (901, ""), (902, " \n"), (903, "one two"), (904, "ONE  two"), (None, "one two"), (None, "alone here"), (5, rows[5][1]), (7, "other text with this id in it"), (905, "a b c d e " * 3000)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,small,tile", [(1, 16, 2048), (2, 2, 8), (3, 1, 3)])
def test_classes_equal_brute_force(spark, monkeypatch, seed, small, tile):
    monkeypatch.setattr(jaccard, "SMALL", small)
    monkeypatch.setattr(jaccard, "TILE", tile)
    monkeypatch.setattr(jaccard, "BUCKET", 2000)
    rows = corpus(seed)
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, key int").repartition(3)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_classes(df).collect()), key=str)
    want = brute(rows)
    assert len({x[2] for x in want}) < len(want) - 40
    assert got == want


def test_empty_table(spark):
    assert jaccard.jaccard_classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert [tuple(r) for r in jaccard.jaccard_classes(spark.createDataFrame([(1, None)], "doc_id long, text string")).collect()] == [(1, 0, 1, 0)]


def test_one_of_each(spark):
    rows = corpus(7, 120) + [(5000 + i, None) for i in range(3)] + [(None, "alone again")]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, n_shingles int, comp int").repartition(3)
    kept = jaccard.one_of_each(df)
    assert kept.columns == df.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    want = brute(rows)
    bare = [r for r in rows if not shingles(r[1])]
    assert sorted(r for r in got if not shingles(r[1])) == sorted(bare) if None not in [r[1] for r in bare] else len([r for r in got if not shingles(r[1])]) == len(bare)
    classes = {x[2] for x in want if x[1]} - {None}
    full = [r for r in got if shingles(r[1])]
    assert len(full) == len(set(full)) and {r[0] for r in full if r[0] is not None} == classes
    assert {r[1] for r in full if r[0] is None} == {"alone here", "alone again"}


def test_bound_is_never_below_the_overlap():
    rnd = np.random.default_rng(5)
    for _ in range(300):
        a, b = (np.unique(rnd.integers(0, 4000, rnd.integers(1, 900)).astype(np.uint64) << np.uint64(20)) for _ in range(2))
        if rnd.random() < 0.5:
            b = np.unique(np.concatenate([a[: len(a) * 9 // 10], b[:20]]))
        x, y = (np.frombuffer(jaccard.signature(s), np.uint64)[None, :] for s in (a, b))
        n, m = np.array([len(a)]), np.array([len(b)])
        assert jaccard.overlap_bound(n, x, m, y)[0] >= len(np.intersect1d(a, b))


def test_chains_end_in_one_class(spark):
    nodes = spark.range(300).withColumnRenamed("id", "key")
    links = spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long")
    got = dict(map(tuple, jaccard.classes(nodes, links).collect()))
    assert got == {i: 0 if i <= 200 else i for i in range(300)}
