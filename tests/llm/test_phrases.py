"""Phrase collocations against plain counting: scores, dropped phrases, ties at the last place, early ends of growth."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from matchlab.llm import phrases, textkit

A_TO_Z = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(A_TO_Z)):
        yield re.findall(r"[^\x20\x09]+", piece)


def brute(rows, top, least, factor=1000):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            n[lang] += len(w)
            for m in range(1, 6):
                f[lang].update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) >= 2 and a >= least}
        inner = defaultdict(int)
        for p, a in cand.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    inner[p[i : i + m]] = max(inner[p[i : i + m]], a)
        rows = []
        for p, a in cand.items():
            if 100 * inner[p] >= 100 * a:
                continue
            score, _, left, right = min((factor * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, x, 1, "r") for i, (t, x) in enumerate(rows)], "doc_id long, text string, lang string, n int, phrase string").repartition(4)
    return sorted(map(tuple, phrases.collocations(df, **kw).collect()))


@pytest.fixture(scope="module")
def corpus(spark, sf):
    return [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("text", "lang").collect()]


@pytest.mark.parametrize("top,least", [(2000, 20), (3, 8)])
def test_corpus(spark, corpus, top, least):
    assert run(spark, corpus, top=top, least=least) == brute(corpus, top, least)


def skewed(seed, n=400):
    """Words by a steep law with planted runs, odd white space, every kind of piece end, nulls and repeated rows."""
    rnd = random.Random(seed)
    words = [f"w{k}" for k in range(60)] + ["É", "ZA", "a\xa0b", "日本", "\x00", "x\x1c"]
    weight = [1 / (k + 1) for k in range(len(words))]
    planted = [["q1", "q2", "q3", "q4", "q5", "q6", "q7"], ["p1", "P2"], ["w0", "w1", "z9"]]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rnd.randrange(12)):
            run_ = rnd.choices(words, weight, k=rnd.randrange(1, 9)) if rnd.random() < 0.8 else rnd.choice(planted)
            parts.append(rnd.choice([" ", "  ", "\t", " \t "]).join(run_) + rnd.choice([".", ", ", "; ", ":", "!", "?", "\n", "\x0b", "\x0c", "\r", " "]))
        rows.append(("".join(parts), rnd.choice(["en", "en", "en", "de", None, "", "EN"])))
    return rows + [(None, "en"), ("", None), (" .,; ", "en"), ("only", "xx")] + [("same old words here", "en")] * 30


@pytest.mark.parametrize("seed", range(2))
def test_skewed_texts(spark, seed):
    rows = skewed(seed)
    for top, least in ((2000, 5), (6, 5)):
        assert run(spark, rows, top=top, least=least) == brute(rows, top, least)


def test_growth_ends_early(spark):
    """Words whose bound falls short of the last place are never expanded, and ties with it are."""
    rows = [(f"r{k} s{k}.", "en") for k in range(40) for _ in range(5)] + [("the cat. the dog. a cat. the the a dog.", "en")] * 3000
    waves = []
    assert run(spark, rows, top=10, least=5, waves=waves) == brute(rows, 10, 5)
    assert sum(waves) == 80  # not the four common words
    tied = [(f"r{k:02d} s{k:02d}.", "en") for k in reversed(range(30)) for _ in range(8)]
    assert run(spark, tied, top=7, least=8) == brute(tied, 7, 8)



def test_scores_are_exact(spark):
    a, n, left, right = 3_000_000_007, 10_000_000_019, 3_000_000_011, 3_000_000_019
    known = spark.createDataFrame([("en", "x y", 2, a, True)], "lang string, phrase string, m long, a long, alone boolean")
    words = spark.createDataFrame([("en", "x", left), ("en", "y", right)], "lang string, word string, f long")
    total = spark.createDataFrame([("en", n)], "lang string, n long")
    (r,) = phrases.scored(known, words, total, 1000).collect()
    assert (r.score, r.l, r.r) == (1000 * a * n // (left * right), left, right)


def test_a_text_over_many_slices(spark, monkeypatch):
    """A long text stands alone in a slice; others are cut between rows, never inside one."""
    rows = [("one two three " * 5000, "en"), ("one two " * 10, "en")]
    monkeypatch.setattr(phrases, "SLICE", 50)
    column = pa.array([t for t, _ in rows])
    parts = [phrases._Slice(d, o, ["en"] * (j - i)) for i, j, d, o in textkit.slices(column, phrases.SLICE)]
    assert [len(p.name) for p in parts] == [15000, 20] and len(np.unique(parts[0].name)) == 3
    assert run(spark, rows, top=50, least=5) == brute(rows, 50, 5)


def test_empty(spark):
    assert run(spark, [], top=5, least=1) == [] == run(spark, [("a. b. c", "en")], top=5, least=1) == run(spark, [("a b", "en")], top=5, least=2)
