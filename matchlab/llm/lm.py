"""Language-model scores: a causal self-attention model over subword ids, and a word model with add-one counts."""

from __future__ import annotations

import math
import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlab.llm import textkit, tokenfile
from matchlab.llm.storage import store

#: The model's sizes: output classes, width, tokens scored per window and tokens of context before each.
CLASSES, WIDTH, SPAN, CONTEXT = 64, 16, 16, 16
#: The most frequent ids, which stand apart when neighbours are counted.
MARKS = 48
#: Windows per gradient step, per task and round.
BATCH = 512
#: Rounds of training; every training text belongs to one of them.
ROUNDS = 2
#: Words whose counts every task holds; counts of all others are joined.
HEAD = 200_000
#: Stands for the end of a text among word hashes.
END_WORD = np.uint64(1)


# --- classes -----------------------------------------------------------------


def class_table(counts: np.ndarray, near: np.ndarray, rounds: int = 10) -> tuple[np.ndarray, np.ndarray]:
    """Class of each id and ln P(class), from the corpus counts of the ids and of their neighbours.

    Ids with like neighbours share a class: k-means, weighted by count, on the square roots of each id's smoothed neighbour
    shares, started from frequent ids. Half a count is added to each id. The work is bounded by the vocabulary.
    """
    order = np.argsort(-counts, kind="stable")
    shares = np.sqrt((near + 2 * near.sum(0) / max(1, near.sum())) / (near.sum(1, keepdims=True) + 2))
    centre = shares[order[: 6 * CLASSES : 6]].copy()
    cls = np.zeros(len(counts), np.int64)
    for _ in range(rounds):
        cls = ((centre * centre).sum(1) - 2 * shares @ centre.T).argmin(1)
        mass = np.bincount(cls, weights=counts, minlength=CLASSES)
        for f in range(shares.shape[1]):
            total = np.bincount(cls, weights=counts * shares[:, f], minlength=CLASSES)
            centre[:, f] = np.where(mass > 0, total / np.maximum(mass, 1), centre[:, f])
    mass = np.maximum(np.bincount(cls, weights=counts + 0.5, minlength=CLASSES), 1e-9)
    return cls.astype(np.uint8), np.log(mass / mass.sum())


def member_table(counts: np.ndarray, cls: np.ndarray, after: np.ndarray, back_off: float = 5.0) -> np.ndarray:
    """ln P(id | its class, class of the token before), ids by classes; the last column is for the start of a text.

    after: how often each id follows each class. Shares of an id in its class, whatever stands before, weigh back_off counts.
    """
    plain = (counts + 0.5) / np.maximum(np.bincount(cls, weights=counts + 0.5, minlength=CLASSES), 1e-9)[cls]
    total = np.zeros((CLASSES, CLASSES))
    np.add.at(total, cls, after)
    return np.log(np.hstack([(after + back_off * plain[:, None]) / (total[cls] + back_off), plain[:, None]])).astype(np.float32)


# --- model -------------------------------------------------------------------

BEGIN, PAD = CLASSES, CLASSES + 1
KEYS = SPAN + CONTEXT - 1


def _seen(x: np.ndarray) -> np.ndarray:
    """View of what the causal mask lets through of (windows, SPAN, KEYS): query i sees keys i to i + CONTEXT - 1, the last its own place."""
    a, b, c = x.strides
    return np.lib.stride_tricks.as_strided(x, (len(x), SPAN, CONTEXT), (a, b + c, c))


@dataclass
class Model:
    """One head of causal attention over the last CONTEXT tokens with learned distances, a residual, and a softmax over classes."""

    embed: np.ndarray
    query: np.ndarray
    key: np.ndarray
    value: np.ndarray
    distance: np.ndarray
    out: np.ndarray
    bias: np.ndarray
    names: tuple = field(default=("embed", "query", "key", "value", "distance", "out", "bias"), repr=False)

    @staticmethod
    def fresh(log_class: np.ndarray, seed: int = 1) -> "Model":
        r = np.random.default_rng(seed)
        n = lambda *s, k=1.0: (r.standard_normal(s) * k).astype(np.float32)
        d = WIDTH
        return Model(n(CLASSES + 2, d, k=0.3), n(d, d, k=d**-0.5), n(d, d, k=d**-0.5), n(d, d, k=d**-0.5), np.linspace(0, -2, CONTEXT).astype(np.float32), n(d, CLASSES, k=0.1), log_class.astype(np.float32))

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.names])

    @staticmethod
    def of(flat: np.ndarray, like: "Model") -> "Model":
        parts, at = [], 0
        for n in like.names:
            shape = getattr(like, n).shape
            size = int(np.prod(shape))
            parts.append(flat[at : at + size].reshape(shape).astype(np.float32))
            at += size
        return Model(*parts)

    def tables(self):
        """Attention weight of each (query class, key class) before distances, and the value of each class with a 1 to sum weights."""
        q, k = self.embed @ self.query, self.embed @ self.key
        g = np.clip(q @ k.T * np.float32(WIDTH**-0.5), -15, 15)
        e = np.exp(g)
        e[:, PAD] = 0  # padding is never seen
        e[PAD, :] = 1
        v = np.hstack([self.embed @ self.value, np.ones((CLASSES + 2, 1), np.float32)]).astype(np.float32)
        near = np.exp(self.distance)[::-1].astype(np.float32)
        return q, k, g, np.ascontiguousarray(e, np.float32), v, near

    def _logits(self, windows: np.ndarray, tables, work: "Work"):
        """Class logits (rows of windows times SPAN) and what the gradient needs, all in arrays of `work`. windows: classes of KEYS tokens each."""
        _, _, _, e, v, near = tables
        n = len(windows)
        cls = work.array("cls", (n, KEYS), np.intp)
        cls[:] = windows
        cq = cls[:, CONTEXT - 1 :]
        pair = work.array("pair", (n, SPAN, CONTEXT), np.intp)
        base = np.multiply(cq, CLASSES + 2, out=work.array("base", (n, SPAN), np.intp))
        row, step = cls.strides
        np.add(base[:, :, None], np.lib.stride_tricks.as_strided(cls, (n, SPAN, CONTEXT), (row, step, step)), out=pair)
        weight = e.ravel().take(pair, mode="clip", out=work.array("weight", pair.shape, e.dtype))
        a = work.array("a", (n, SPAN, KEYS))  # zero where the mask lets nothing through: only _seen(a) is ever written
        np.multiply(weight, near, out=_seen(a))
        vk = v.take(cls, axis=0, mode="clip", out=work.array("vk", (n, KEYS, WIDTH + 1), v.dtype))
        summed = np.matmul(a, vk, out=work.array("summed", (n, SPAN, WIDTH + 1)))
        den = summed[:, :, -1:]
        den += np.float32(1e-20)
        att = np.divide(summed[:, :, :-1], den, out=work.array("att", (n, SPAN, WIDTH)))
        h = work.array("h", (n * SPAN, WIDTH + 1))  # the last column is 1, for the bias
        np.add(self.embed.take(cq, axis=0, mode="clip", out=work.array("own", att.shape)), att, out=h.reshape(n, SPAN, -1)[:, :, :-1])
        h[:, -1] = 1
        last = np.vstack([self.out, self.bias])
        z = np.matmul(h, last, out=work.array("z", (n * SPAN, CLASSES)))
        if n and max(h.max(), -h.min()) * np.abs(last).sum(0).max() > 80:
            np.minimum(z, 80, out=z)  # so that no sum of exponentials overflows
        return z, (cls, cq, pair, a, vk, den, att, h)

    def forward(self, windows: np.ndarray, tables):
        """Log probabilities of all classes."""
        z, _ = self._logits(windows, tables, Work())
        return z - np.log(np.exp(z).sum(1, keepdims=True))

    def target_logp(self, windows: np.ndarray, target: np.ndarray, tables, work: "Work") -> np.ndarray:
        """Log probability of one class per row of forward()."""
        z, _ = self._logits(windows, tables, work)
        own = z.ravel().take(np.arange(len(target)) * CLASSES + target)
        return own - np.log(np.exp(z, out=z) @ np.ones(CLASSES, np.float32))

    def gradient(self, windows: np.ndarray, target: np.ndarray, real: np.ndarray, work: "Work") -> tuple[float, "Model"]:
        """Mean negative log likelihood of the real targets and its gradient."""
        tables = q, k, g, _, _, _ = self.tables()
        z, (cls, cq, pair, a, vk, den, att, h) = self._logits(windows, tables, work)
        n = max(1, int(real.sum()))
        place = np.arange(len(target)) * CLASSES + target
        own = z.ravel().take(place)
        dz = np.exp(z, out=z)
        total = dz @ np.ones(CLASSES, z.dtype)
        loss = -float((own - np.log(total))[real].sum()) / n
        share = (real / np.float32(n)).astype(z.dtype)
        dz *= (share / total)[:, None]
        dz.ravel()[place] -= share
        d_last = h.T @ dz
        dh = np.matmul(dz, self.out.T, out=work.array("dh", (len(dz), WIDTH))).reshape(att.shape)
        d_embed = _scatter(windows[:, CONTEXT - 1 :], dh)
        ds = work.array("ds", vk.shape[:1] + (SPAN, WIDTH + 1))
        np.divide(dh, den, out=ds[:, :, :-1])
        np.einsum("nsd,nsd->ns", ds[:, :, :-1], att, out=ds[:, :, -1])
        np.negative(ds[:, :, -1], out=ds[:, :, -1])
        da = np.matmul(ds, vk.transpose(0, 2, 1), out=work.array("da", a.shape))
        dv = _scatter(windows, np.matmul(a.transpose(0, 2, 1), ds, out=work.array("dvk", vk.shape)))[:, :-1]
        da = np.multiply(_seen(da), _seen(a), out=work.array("weight", pair.shape))
        d_distance = (np.ones(len(windows) * SPAN, z.dtype) @ da.reshape(-1, CONTEXT))[::-1].astype(np.float32)
        dg = np.bincount(pair.ravel(), weights=da.ravel(), minlength=(CLASSES + 2) ** 2).reshape(CLASSES + 2, -1).astype(np.float32)
        dg[np.abs(g) >= 15] = 0
        dg *= np.float32(WIDTH**-0.5)
        dq, dk = dg @ k, dg.T @ q
        d_embed += dq @ self.query.T + dk @ self.key.T + dv @ self.value.T
        return loss, Model(d_embed, self.embed.T @ dq, self.embed.T @ dk, self.embed.T @ dv, d_distance, d_last[:-1], d_last[-1])


class Work:
    """Arrays that are used again from batch to batch; a fresh one of megabytes costs more than the sums in it."""

    def __init__(self, dtype=np.float32):
        self.dtype, self.held = dtype, {}

    def array(self, name: str, shape: tuple, dtype=None) -> np.ndarray:
        """The first places of a held array in this shape; zeros when it is new."""
        size = math.prod(shape)
        if name not in self.held or len(self.held[name]) < size:
            self.held[name] = np.zeros(size, dtype or self.dtype)
        return self.held[name][:size].reshape(shape)


def _scatter(cls: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sum of the rows of each class (8 bits): sorted by class, one product with ones for each."""
    cls = cls.ravel()
    rows = rows.reshape(len(cls), -1).take(np.argsort(cls, kind="stable"), axis=0)  # a radix sort
    count = np.bincount(cls, minlength=CLASSES + 2)
    stop, one = np.cumsum(count), np.ones(int(count.max()), rows.dtype)
    out = np.zeros((CLASSES + 2, rows.shape[1]), rows.dtype)
    for c in np.flatnonzero(count):
        out[c] = one[: count[c]] @ rows[stop[c] - count[c] : stop[c]]
    return out


def make_windows(cls: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of a run of texts (classes end to end, index of each text's first): windows, targets, and the token that each target is (-1: none).

    A window scores SPAN tokens and sees CONTEXT tokens before each; windows overlap so that every token is scored once.
    """
    size = np.diff(first)
    count = -(-size // SPAN)
    # layout of a text: CONTEXT - 1 times padding, the begin mark, its tokens, padding to whole windows
    room = CONTEXT + count * SPAN
    base = np.cumsum(room) - room
    line = np.full(int(room.sum()), PAD, np.uint8)
    line[base + CONTEXT - 1] = BEGIN
    place = np.arange(len(cls)) + np.repeat(base - first[:-1] + CONTEXT, size)
    line[place] = cls
    token = np.full(len(line), -1, np.int64)
    token[place] = np.arange(len(cls))
    owner = np.repeat(np.arange(len(size)), count)
    at = base[owner] + SPAN * (np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count))
    if not len(at):
        return np.zeros((0, KEYS), np.uint8), np.zeros(0, np.uint8), np.zeros(0, np.int64)
    rows = lambda x, width, at: np.lib.stride_tricks.sliding_window_view(x, width)[at]
    return rows(line, KEYS, at), rows(line, SPAN, at + CONTEXT).ravel(), rows(token, SPAN, at + CONTEXT).ravel()


class Adam:
    def __init__(self, rate: float):
        self.rate, self.m, self.v, self.t = rate, 0.0, 0.0, 0

    def step(self, flat: np.ndarray, grad: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m = 0.9 * self.m + 0.1 * grad
        self.v = 0.99 * self.v + 0.01 * grad * grad
        return flat - self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.99**self.t)) + 1e-8)


def _runs(blobs: list, cls: np.ndarray, limit: int = 200_000):
    """Texts in runs of about `limit` tokens: (first row, row after the last, ids, classes, index of each text's first)."""
    i = 0
    while i < len(blobs):
        j, held = i, 0
        while j < len(blobs) and (j == i or held + len(blobs[j]) <= 2 * limit):
            held += len(blobs[j])
            j += 1
        size = [len(x) // 2 for x in blobs[i:j]]
        ids = np.frombuffer(b"".join(blobs[i:j]), np.uint16)
        yield i, j, ids, None if cls is None else cls[ids], np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        i = j


def train(texts: DataFrame, cls: np.ndarray, log_class: np.ndarray, rounds: int = ROUNDS, rate: float = 0.02) -> Model:
    """Fit the model on all rows of texts (round, ids: little-endian 16-bit). In each round every task goes on from the shared
    parameters over its rows of that round, step by step, and the tasks' results are averaged by their tokens.

    The average is a sum by parameter place; the driver gets as many numbers as the model has.
    """
    spark = texts.sparkSession
    model = Model.fresh(log_class)
    for r in range(rounds):
        start = spark.sparkContext.broadcast((model.flat(), cls, log_class))
        learned = rate / (1 + r)

        def fit(batches, start=start, learned=learned):
            flat, cls, log_class = start.value
            like = Model.fresh(log_class)
            adam, tokens, work = Adam(learned), 0, Work()
            for b in batches:
                for _, _, _, c, first in _runs(b.column(0).to_pylist(), cls):
                    w, target, token = make_windows(c, first)
                    order = np.random.default_rng(len(w)).permutation(len(w))
                    target, told = target.reshape(-1, SPAN), token.reshape(-1, SPAN) >= 0
                    for k in range(0, len(w), BATCH):
                        pick = order[k : k + BATCH]
                        real = told[pick].ravel()
                        goal = np.where(real, target[pick].ravel(), 0)
                        _, grad = Model.of(flat, like).gradient(w[pick], goal, real, work)
                        flat = adam.step(flat, grad.flat()).astype(np.float32)
                    tokens += len(c)
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat)), pa.int32()), pa.array(flat.astype(np.float64) * tokens), pa.array(np.full(len(flat), tokens, np.int64))], names=["place", "total", "tokens"])

        sums = texts.where(F.col("round") == r).select("ids").mapInArrow(fit, "place int, total double, tokens long").groupBy("place").agg((F.sum("total") / F.sum("tokens")).alias("x"))
        rows = sums.toPandas()  # one row per parameter
        if len(rows):
            flat = np.zeros(len(model.flat()))
            flat[rows["place"].to_numpy()] = rows["x"].to_numpy()
            model = Model.of(flat, model)
    return model


def log_likelihoods(model: Model, cls: np.ndarray, members: np.ndarray, blobs: list) -> np.ndarray:
    """log10 probability of each text of ids; windows go through the attention in batches."""
    out, tables, work = np.zeros(len(blobs)), model.tables(), Work()
    for i, j, ids, c, first in _runs(blobs, cls):
        w, target, token = make_windows(c, first)
        before = np.concatenate([[CLASSES], c[:-1]]).astype(np.int64)
        before[first[:-1][first[:-1] < len(c)]] = CLASSES
        each = members[ids, before].astype(np.float64)
        for k in range(0, len(w), BATCH):
            t = token[k * SPAN : (k + BATCH) * SPAN]
            real = t >= 0
            logp = model.target_logp(w[k : k + BATCH], np.where(real, target[k * SPAN : (k + BATCH) * SPAN], 0), tables, work)
            each[t[real]] += logp[real]
        text = np.repeat(np.arange(j - i), np.diff(first))
        out[i:j] = np.bincount(text, weights=each, minlength=j - i)
    return out / np.log(10)


# --- words -------------------------------------------------------------------


def word_counts(docs: DataFrame) -> DataFrame:
    """h, c: how often each word (and the end mark) is in the training rows. docs: text, held_out. Summed within tasks first."""

    def read(batches):
        keys, count = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        held, size = [], 0
        for b in batches:
            learn = ~b.column(1).to_numpy(zero_copy_only=False)
            for i, j, data, offsets in textkit.slices(b.column(0)):
                *_, first, code, hashes, _ = textkit.distinct_words(data, offsets)
                c = np.bincount(code[np.repeat(learn[i:j], np.diff(first))], minlength=len(hashes))
                held.append((np.append(hashes, END_WORD), np.append(c, learn[i:j].sum())))
                size += len(hashes)
                if size > 2_000_000:
                    keys, count = merge(keys, count, held)
                    held, size = [], 0
                    if len(keys) > 3_000_000:
                        yield rows(keys, count)
                        keys, count = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        keys, count = merge(keys, count, held)
        if len(keys):
            yield rows(keys, count)

    def merge(keys, count, held):
        all_keys, all_counts = (np.concatenate(x) for x in zip((keys, count), *held))
        both, back = np.unique(all_keys[all_counts > 0], return_inverse=True)
        return both, np.bincount(back, weights=all_counts[all_counts > 0], minlength=len(both)).astype(np.int64)

    def rows(keys, count):
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(count)], names=["h", "c"])

    return docs.select("text", "held_out").mapInArrow(read, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


def _encoded(docs: DataFrame, head: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """Per row: id, held_out, n_tokens, the part of the base score that common words give, all other words, and subword ids."""
    rows = head.toPandas()  # HEAD rows at most
    order = np.argsort(rows["h"].to_numpy(np.int64).view(np.uint64))
    common = docs.sparkSession.sparkContext.broadcast((rows["h"].to_numpy(np.int64).view(np.uint64)[order], rows["c"].to_numpy(np.int64)[order]))
    tail = pa.list_(pa.struct([("h", pa.int64()), ("n", pa.int64())]))

    def read(batches):
        keys, count = common.value
        logs = np.log10(count + 1.0)
        for b in batches:
            for i, j, data, offsets in textkit.slices(b.column(2)):
                found = textkit.distinct_words(data, offsets)
                *_, first, code, h, _ = found
                size = np.diff(first)
                row = np.concatenate([np.repeat(np.arange(j - i), size), np.arange(j - i)])
                code, h = np.concatenate([code, np.full(j - i, len(h))]), np.append(h, END_WORD)
                at = np.minimum(np.searchsorted(keys, h), max(0, len(keys) - 1))
                common_word = keys[at] == h if len(keys) else np.zeros(len(h), bool)
                known = common_word[code]
                score = np.bincount(row[known], weights=(logs[at] if len(keys) else np.zeros(len(h)))[code[known]], minlength=j - i)
                n_known = np.bincount(row[known], minlength=j - i)
                rare, times = np.unique(row[~known] * len(h) + code[~known], return_counts=True)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(rare, np.arange(j - i + 1) * len(h)), pa.int32()),
                    pa.StructArray.from_arrays([pa.array(h[rare % len(h)].view(np.int64)), pa.array(times, pa.int64())], fields=list(tail.value_type)),
                )
                ids, at = tokenfile.tokenizer(vocabulary).encode_words(data, offsets, found)
                ids = np.insert(ids, at[1:], end_id).astype("<u2")
                at = at + np.arange(len(at))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), b.column(1).slice(i, j - i), pa.array(size + 1), pa.array(score), pa.array(n_known), lists, pa.array([ids[s:e].tobytes() for s, e in zip(at[:-1], at[1:])], pa.binary())],
                    names=["id", "held_out", "n_tokens", "head_score", "head_known", "tail", "ids"],
                )

    found = docs.select("id", "held_out", "text").mapInArrow(read, "id long, held_out boolean, n_tokens long, head_score double, head_known long, tail array<struct<h:long,n:long>>, ids binary")
    return store(found.withColumn("row", F.monotonically_increasing_id()).withColumn("round", F.pmod(F.xxhash64("row"), F.lit(ROUNDS)).cast("int")), "encoded")


def _summed(texts: DataFrame, size: int, codes) -> np.ndarray:
    """How often each code (below size) is in the rows; summed within tasks, and the driver gets a row per code."""

    def read(batches):
        total = np.zeros(size, np.int64)
        for b in batches:
            for _, _, ids, _, first in _runs(b.column(0).to_pylist(), None, 1 << 17):
                np.add.at(total, codes(ids.astype(np.int64), first), 1)  # the table is larger than a run
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], names=["i", "c"])

    rows = texts.select("ids").mapInArrow(read, "i long, c long").groupBy("i").agg(F.sum("c").alias("c")).toPandas()
    out = np.zeros(size, np.int64)
    out[rows["i"].to_numpy(np.int64)] = rows["c"].to_numpy(np.int64)
    return out


def id_counts(texts: DataFrame, size: int) -> np.ndarray:
    """How often each subword id is in the rows."""
    return _summed(texts, size, lambda ids, first: ids)


def _inner(ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Whether each id but the run's first is of the same text as the one before."""
    inner = np.ones(len(ids), bool)
    inner[first[:-1][first[:-1] < len(ids)]] = False
    return inner[1:]


def neighbour_counts(texts: DataFrame, counts: np.ndarray) -> np.ndarray:
    """For each id how often each of the MARKS most frequent ids, or any other, stands before and after it in a text."""
    size, width = len(counts), MARKS + 1
    mark = np.full(size, MARKS)
    top = np.argsort(-counts, kind="stable")[:MARKS]
    mark[top] = np.arange(len(top))

    def pairs(ids, first):
        m, own, inner = mark[ids], ids * (2 * width), _inner(ids, first)
        return np.concatenate([(own[1:] + m[:-1])[inner], (own[:-1] + m[1:] + width)[inner]])

    return _summed(texts, size * 2 * width, pairs).reshape(size, -1).astype(float)


def class_neighbours(texts: DataFrame, cls: np.ndarray) -> np.ndarray:
    """How often each id follows each class in a text."""

    def pairs(ids, first):
        return (ids[1:] * CLASSES + cls[ids[:-1]])[_inner(ids, first)]

    return _summed(texts, len(cls) * CLASSES, pairs).reshape(-1, CLASSES).astype(float)


def lm_scores(docs: DataFrame, vocabulary: str, end_id: int, held_out: F.col, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10 probabilities of the text).

    Both models learn from every row that is not held out. base_score is the word model: words (A-Z lower-cased) and one end,
    each with (c + 1) / (N + V + 1). score is the attention model's over the subword ids of the whole text and an end id: the
    class of each token given the CONTEXT tokens before it, times the token's share of its class after the class before it. Every token is scored once.

    Counts of the HEAD most frequent words are broadcast (a fixed bound) and those of all other words joined, so any
    vocabulary size gives the same scores. Null and empty texts are one end. Null held_out counts as not held out. Null ids are kept, repeated rows
    are learned from and scored each. Extra columns are ignored. An empty table gives no rows.
    """
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    counts = store(word_counts(own), "words")
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    rows = _encoded(own, counts.orderBy(F.desc("c"), "h").limit(HEAD), vocabulary, end_id)
    places = rows.select("row", F.explode("tail").alias("t")).select("row", "t.*")
    rest = places.join(counts, "h").groupBy("row").agg(F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("tail_score"), F.sum("n").alias("tail_known"))
    learn = rows.where("NOT held_out")
    size = tokenfile.tokenizer(vocabulary).library.get_vocab_size()
    counted = id_counts(learn, size)
    cls, log_class = class_table(counted, neighbour_counts(learn, counted))
    members = member_table(counted, cls, class_neighbours(learn, cls))
    model = train(learn, cls, log_class)
    fitted = docs.sparkSession.sparkContext.broadcast((model, cls, members))

    def score(batches):
        m, c, inside = fitted.value
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:6], pa.array(log_likelihoods(m, c, inside, b.column(6).to_pylist()))], names=["row", "id", "held_out", "n_tokens", "head_score", "head_known", "score"])

    scored = rows.select("row", "id", "held_out", "n_tokens", "head_score", "head_known", "ids").mapInArrow(score, "row long, id long, held_out boolean, n_tokens long, head_score double, head_known long, score double")
    base = F.col("head_score") + F.coalesce("tail_score", F.lit(0.0)) - F.col("n_tokens") * F.log10(F.lit(float(n + v + 1)))
    return scored.join(rest, "row", "left").select(
        F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("head_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"), F.lit(int(n)).cast("long").alias("train_tokens"), base.alias("base_score"), "score"
    )
