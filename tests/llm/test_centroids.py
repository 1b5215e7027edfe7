"""Centroid clustering against plain whole-number Python: rounding, ties, repeats, odd vectors."""

import hashlib
import math
import random

import pytest

from matchlab.llm import centroids


def brute(rows, k, rounds, dimension, scale=256, seed="2:"):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dimension and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(max(-centroids.LARGEST, min(centroids.LARGEST, scale * x))) for x in v]))
    name = lambda i: (1, "") if i is None else (0, hashlib.sha256(f"{seed}{i}".encode()).hexdigest())
    middle = [v for i, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]
    place = lambda: [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(middle)) for _, v in kept]
    for _ in range(rounds):
        at = place()
        for j in range(len(middle)):
            own = [v for (_, v), (_, c) in zip(kept, at) if c == j]
            if own:
                middle[j] = [sum(x) // len(own) for x in zip(*own)]
    at = place()
    per = {j: sum(d for d, c in at if c == j) for _, j in at}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle]
    fits = lambda n: n if n < 1 << 63 else None
    return [(i, c, d, fits(per[c]), fits(sum(per.values())), sha[c]) for (i, _), (d, c) in zip(kept, at)]


def run(spark, rows, kind="float", **kw):
    df = spark.createDataFrame([(i, v, 1, "c") for i, v in rows], f"vec_id long, embedding array<{kind}>, cluster int, distance string").repartition(3)
    return sorted(map(tuple, centroids.clusters(df, **kw).collect()), key=str)


def test_equals_brute_force_on_embeddings(spark, sf):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert run(spark, rows, k=11, rounds=3) == sorted(brute(rows, 11, 3, 64), key=str)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_odd_vectors(spark, kind):
    rnd = random.Random(3)
    rows = [(i, [rnd.choice([0.0, 0.25, -0.25, -1 / 512, 3.0, 1e-3]) for _ in range(3)]) for i in range(120)]
    rows = [(i, [float(__import__("numpy").float32(x)) for x in v]) for i, v in rows]
    rows += [(5, [1.0, 1.0, 1.0])] * 60 + [(None, [2.0, 2.0, 2.0]), (None, [9.0, 0.0, 0.0])]
    rows += [(200, None), (201, []), (202, [1.0, 2.0]), (203, [1.0, None, 2.0]), (204, [1.0, math.nan, 2.0]), (205, [math.inf, 1.0, 1.0]), (206, [1.0] * 4), (207, [1e30, -1e30, 0.0])]
    for k, rounds in ((1, 2), (7, 4), (500, 1)):
        assert run(spark, rows, kind, k=k, rounds=rounds, dimension=3) == sorted(brute(rows, k, rounds, 3), key=str)


def test_empty_cluster_stays(spark):
    """A second copy of a starting vector never wins a tie, so its cluster stays where it was."""
    rows = [(1, [1.0]), (1, [1.0]), (2, [5.0]), (3, [6.0])]
    assert run(spark, rows, k=4, rounds=2, dimension=1) == sorted(brute(rows, 4, 2, 1), key=str)


def test_nothing_kept(spark):
    assert run(spark, [(1, [1.0])], k=3, rounds=1, dimension=2) == [] == run(spark, [], k=3, rounds=1, dimension=2)
