"""Quality rules, temperature mixing and language-model scores against brute force."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from matchlab.llm import lm, mixing, quality
from matchlab.llm.queries import QUERIES

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [None, "", " \n\x0b", "a", "one two one two one two", "a b c a b c x a b c", "#*$%&|<>" * 30 + " $", "é\n\né\n é\nb\nb\n\x1c\n", "w " * 6000, "x y z\nx y z\nq", "no\xa0break a\x1cb"]


@pytest.fixture(scope="module")
def documents(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source").orderBy("doc_id").collect()]
    odd = [(10_000 + i, t, None if i % 2 else "en", None if i % 3 else "src0") for i, t in enumerate(ODD)]
    return rows + odd + [(rows[5][0], *rows[5][1:]), (None, *rows[7][1:])]


@pytest.fixture(scope="module")
def frame(spark, documents):
    clash = [(*d, 1, 2, 3) for d in documents]
    return spark.createDataFrame(clash, "doc_id long, text string, lang string, source string, n_words int, pool int, tokens int").repartition(5).cache()


# --- quality -----------------------------------------------------------------


def statistics(text):
    w = WORD.findall(text or "")
    grams = Counter(zip(w, w[1:], w[2:]))
    held = {j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(held), len(lines)


def test_statistics(frame, documents):
    got = quality.text_statistics(frame, keep=["doc_id"]).collect()
    want = [(d[0], *statistics(d[1])) for d in documents]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def brute_distances(points, floors, share=0.75):
    """Squared distances by minimum covariance determinant with the operator's rules, in numpy."""
    p = len(floors)
    q = quality.chi2_quantile(share, p)
    scale = share / quality.chi2_cdf(q, p + 2)
    low = lambda x: np.sort(x, axis=0)[math.ceil(len(x) / 2) - 1]
    m = low(points)
    c = np.diag((low(np.abs(points - m)) * 1.4826) ** 2 + np.square(floors))
    last = None
    for _ in range(12):
        d = np.einsum("ij,jk,ik->i", points - m, np.linalg.inv(c), points - m)
        bins = np.floor(np.log(np.maximum(d, 1e-12)) * 64)
        cut = min(b for b in np.unique(bins) if (bins <= b).sum() >= share * len(points))
        near = points[bins <= cut]
        m, c = near.mean(0), np.cov(near.T, bias=True) * scale + np.diag(np.square(floors))
        if last == (cut, len(near)):
            break
        last = (cut, len(near))
    return np.einsum("ij,jk,ik->i", points - m, np.linalg.inv(c), points - m)


def test_outliers_equal_brute_force(frame, documents):
    got = {}
    for r in quality.judged(frame, least=20).collect():
        got.setdefault(r.doc_id, []).append((r.base_failed, r.kept, r.distance))
    rows = [(d, statistics(d[1])) for d in documents]
    use = [(d, s) for d, s in rows if not (s[0] < 50 or 100 * s[4] > 50 * s[0])]
    groups = defaultdict(list)
    n = Counter((d[2], d[3]) for d, _ in use)
    by_lang = Counter(d[2] for d, _ in use if n[d[2], d[3]] < 20)
    for d, s in use:
        pool = (d[2], d[3]) if n[d[2], d[3]] >= 20 else d[2] if by_lang[d[2]] >= 20 else "*"
        w, c, sym, dup, rep, lines = s
        groups[pool].append((d[0], (math.log(c / w), math.sqrt(sym / c), math.sqrt(dup / lines), math.sqrt(rep / w))))
    assert len(groups) > 1
    far, checked = quality.chi2_quantile(0.999, 4), 0
    for pool, members in groups.items():
        known = pool != "*" or len(members) >= 20
        d2 = brute_distances(np.array([x for _, x in members]), [f for _, f in quality.VECTOR]) if known else np.zeros(len(members))
        for (doc, _), d in zip(members, d2):
            for failed, kept, distance in got[doc]:
                assert not failed and kept == (d <= far) and (not known or abs(distance - d) <= 1e-6 * max(1, d))
                checked += 1
    assert checked >= len(use)
    assert sum(k for v in got.values() for _, k, _ in v) > 0.8 * len(use)
    assert all(not kept for v in got.values() for failed, kept, _ in v if failed)


def test_chi_square():
    assert abs(quality.chi2_quantile(0.999, 4) - 18.4668) < 1e-3 and abs(quality.chi2_quantile(0.95, 2) - 5.9915) < 1e-3


def test_accepted_keeps_columns_and_empty_tables(frame):
    kept = quality.accepted(frame, least=20)
    assert kept.columns == frame.columns and dict(kept.dtypes) == dict(frame.dtypes)
    assert kept.count() == quality.judged(frame, least=20).where("kept").count()
    assert quality.judged(frame.limit(0)).count() == 0


# --- mixing ------------------------------------------------------------------


def brute_mixture(tokens, ratio=1.0, entropy=None, repeats=None, cover=False):
    p = np.array([t for t in tokens.values() if t]) / sum(tokens.values())
    weights = lambda a: p**a / (p**a).sum()
    used = lambda a: p ** (a - 1) / (p ** (a - 1)).min() if cover else weights(a) * ratio / p
    lo, hi = (0.0, 16.0) if entropy is not None else (0.0, 1.0)
    goal = (lambda a: -(weights(a) * np.log(weights(a))).sum() < entropy) if entropy is not None else (lambda a: used(a).max() <= repeats)
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (lo, mid) if goal(mid) else (mid, hi)
    return dict(zip([k for k, t in tokens.items() if t], zip(weights(hi), used(hi))))


@pytest.mark.parametrize("target", [{"entropy": 0.9}, {"entropy": 1.2}, {"repeats": 1.5}, {"repeats": 3.0}, {"repeats": 2.0, "cover": True}, {"repeats": 4.0, "ratio": 2.0}])
def test_mixtures(spark, target):
    rnd = random.Random(2)
    tokens = {"a": 600_000, "b": 250_000, "c": 100_000, "d": 50_000, "": 0}
    blocks = []
    for s, t in tokens.items():
        cut = sorted(rnd.randrange(t + 1) for _ in range(19)) if t else [0] * 19
        blocks += [(s, k, b - a) for k, (a, b) in enumerate(zip([0, *cut], [*cut, t]))]
    want = brute_mixture(tokens, **target)
    total = sum(tokens.values())
    df = spark.createDataFrame(blocks, "src string, block long, tokens long")
    cover = target.get("cover", False)
    mix = mixing.mixture(df, target_entropy=target.get("entropy"), max_repeats=target.get("repeats"), budget_tokens=int(total * target.get("ratio", 1)), cover=cover)
    got = {r.src: r for r in mix.collect()}
    for s, (w, e) in want.items():
        assert abs(got[s].weight - w) < 1e-9 and abs(got[s].epochs - e) < 1e-8
    assert got[""].weight == 0
    if "entropy" in target:
        assert abs(-sum(r.weight * math.log(r.weight) for r in got.values() if r.weight) - target["entropy"]) < 1e-6
    plan = mixing.schedule(df, mix, 3).collect()
    size = {(s, k): t for s, k, t in blocks}
    for s in want:
        mine = [r for r in plan if r.src == s]
        largest = max(t for (x, _), t in size.items() if x == s)
        assert abs(sum(size[s, r.block] for r in mine) - got[s].epochs * tokens[s]) <= largest / 2 + 1
        for e in {r.epoch for r in mine}:
            ranks = sorted(r.rank for r in mine if r.epoch == e)
            assert ranks == list(range(len(ranks)))
    first = [[r.block for r in sorted(plan, key=lambda r: r.rank) if r.src == "d" and r.epoch == e] for e in (0, 1)]
    assert not first[1] or first[0] != first[1]


def test_realised_rows(frame, documents):
    used = {(r.doc_id, r.source, r.n_tokens): r.copies for r in mixing.copies(frame, max_repeats=1.5).collect()}
    assert len(used) >= len({d[0] for d in documents}) - 1
    out = mixing.realised(frame, max_repeats=1.5)
    assert out.columns == frame.columns
    got = Counter((r.doc_id, r.source, len(WORD.findall(r.text or ""))) for r in out.collect())
    twice = Counter((d[0], d[3], len(WORD.findall(d[1] or ""))) for d in documents)
    assert got == Counter({k: n * twice[k] for k, n in used.items() if n})
    cover = mixing.realised(frame, max_repeats=2.0, cover=True)
    assert {r.doc_id for r in cover.select("doc_id").collect()} == {d[0] for d in documents}
    assert mixing.realised(frame.limit(0), max_repeats=2.0).count() == 0 and mixing.copies(frame.limit(0)).count() == 0


# --- language model ----------------------------------------------------------


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def test_scores(frame, documents, monkeypatch):
    monkeypatch.setattr(lm, "HEAD", 50)  # so that most words are joined
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    got = lm.lm_scores(frame, VOCABULARY, 49407, out).collect()
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    words = {id(d): WORD.findall(lower(d[1])) for d in documents}
    count = Counter(w for d in documents if not held(d[0]) for w in words[id(d)] + ["\n"])
    n, v = sum(count.values()), len(count)
    want = sorted(((d[0], held(d[0]), len(words[id(d)]) + 1, sum(count[w] > 0 for w in words[id(d)] + ["\n"]), n, round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in words[id(d)] + ["\n"]), 4)) for d in documents), key=str)
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got), key=str) == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    # on held-out texts the model is better than shares of ids alone
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(VOCABULARY)
    ids = {id(d): library.encode(d[1] or "", add_special_tokens=False).ids + [49407] for d in documents}
    share = Counter(i for d in documents if not held(d[0]) for i in ids[id(d)])
    total = sum(share.values()) + 0.5 * 49408
    plain = sum(math.log10((share[i] + 0.5) / total) for d in documents if held(d[0]) for i in ids[id(d)])
    assert sum(r.score for r in got if r.held_out) > 0.95 * plain
    assert lm.lm_scores(frame.limit(0), VOCABULARY, 49407, out).count() == 0


def test_neighbours(spark):
    rnd = np.random.default_rng(5)
    texts = [rnd.integers(0, 90, n).astype("<u2") for n in (0, 1, 2, 700, 0, 40)]
    rows = spark.createDataFrame([(bytearray(x.tobytes()),) for x in texts], "ids binary").repartition(2)
    counts, cls = np.arange(90)[::-1].copy(), rnd.integers(0, lm.CLASSES, 90).astype(np.uint8)
    near, after = np.zeros((90, 2 * lm.MARKS + 2)), np.zeros((90, lm.CLASSES))
    for x in texts:
        for a, b in zip(x[:-1].tolist(), x[1:].tolist()):  # the most frequent ids are the smallest
            near[b, min(a, lm.MARKS)] += 1
            near[a, lm.MARKS + 1 + min(b, lm.MARKS)] += 1
            after[b, cls[a]] += 1
    assert (lm.neighbour_counts(rows, counts) == near).all() and (lm.class_neighbours(rows, cls) == after).all()
    assert (lm.id_counts(rows, 90) == np.bincount(np.concatenate(texts), minlength=90)).all()


def test_windows_score_each_token_once():
    rnd = np.random.default_rng(0)
    for sizes in ([1], [16, 17, 0, 5], [100, 0, 0, 33], [0]):
        first = np.concatenate([[0], np.cumsum(sizes)])
        c = rnd.integers(0, lm.CLASSES, first[-1]).astype(np.uint8)
        w, target, token = lm.make_windows(c, first)
        assert sorted(token[token >= 0]) == list(range(len(c)))
        assert (target[token >= 0] == c[token[token >= 0]]).all()
        text = np.repeat(np.arange(len(sizes)), sizes)
        for k, t in enumerate(token):
            if t >= 0:  # the query and the keys before it are the tokens before the target
                row, j = w[k // lm.SPAN], k % lm.SPAN
                before = c[max(first[text[t]], t - lm.CONTEXT) : t].tolist()
                seen = row[j : j + lm.CONTEXT].tolist()
                lead = [lm.BEGIN] if t - first[text[t]] < lm.CONTEXT else []
                assert seen == [lm.PAD] * (lm.CONTEXT - len(before) - len(lead)) + lead + before


def test_batched_attention_equals_a_plain_loop():
    rnd = np.random.default_rng(1)
    c = rnd.integers(0, lm.CLASSES, 90).astype(np.uint8)
    m = lm.Model.fresh(np.log(rnd.dirichlet(np.ones(lm.CLASSES))), seed=4)
    w, target, token = lm.make_windows(c, np.array([0, 50, 90]))
    logp = m.forward(w, m.tables())
    for k, t in enumerate(token):
        if t < 0:
            continue
        begin = 0 if t < 50 else 50
        seq = [lm.BEGIN, *c[begin:t].tolist()][-lm.CONTEXT :]
        q = m.embed[seq[-1]] @ m.query
        a = np.array([math.exp(q @ (m.embed[x] @ m.key) / math.sqrt(lm.WIDTH) + m.distance[len(seq) - 1 - i]) for i, x in enumerate(seq)])
        h = m.embed[seq[-1]] + (a[:, None] * (m.embed[seq] @ m.value)).sum(0) / a.sum()
        z = h @ m.out + m.bias
        assert abs(z[c[t]] - np.log(np.exp(z).sum()) - logp[k, target[k]]) < 1e-3


def test_gradient():
    rnd = np.random.default_rng(0)
    c = rnd.integers(0, lm.CLASSES, 100).astype(np.uint8)
    w, target, token = lm.make_windows(c, np.array([0, 30, 30, 47, 100]))
    like = lm.Model.fresh(np.log(np.full(lm.CLASSES, 1 / lm.CLASSES)))
    shapes = [getattr(like, n).shape for n in like.names]
    cuts = np.cumsum([int(np.prod(s)) for s in shapes])[:-1]
    wide = lambda f: lm.Model(*(x.reshape(s) for x, s in zip(np.split(f, cuts), shapes)))
    real, goal = token >= 0, np.where(token >= 0, target, 0)
    flat = like.flat().astype(float)
    grad = wide(flat).gradient(w, goal, real, lm.Work(float))[1].flat()
    for i in rnd.integers(0, len(flat), 80):
        step = np.zeros_like(flat)
        step[i] = 3e-3
        slope = (wide(flat + step).gradient(w, goal, real, lm.Work(float))[0] - wide(flat - step).gradient(w, goal, real, lm.Work(float))[0]) / 6e-3
        assert abs(slope - grad[i]) < 2e-4 + 0.03 * abs(slope)


@pytest.mark.parametrize("name", ["op5_robust_outliers", "op6_attention_scores", "op10_temperature_mix"])
def test_queries_run(spark, sf, name):
    assert QUERIES[name](spark, sf).count() == spark.read.parquet(f"{sf}/documents.parquet").count()
