"""Phrase collocation mining: best-first branch-and-bound growth of word sequences.

The frontier holds first words. Whatever grows from a first word w scores at most factor * n / f(w), since the part after
w occurs at least as often as the phrase; so rare words come first, and growth ends when no word left could still reach
the last place of its language. A wave expands the best words of the frontier level by level: a phrase grows
only from a frequent prefix and by a frequent word.

Words are named by 64 bits and stored as such; passes over the names count those of word sequences. Names only choose what is worth a look: two sequences
that share a name can bring in a phrase too many, never lose one. All counts that reach a score are taken of the
texts of the phrases. What tasks must know travels as bitmaps of a fixed size, in which a shared bit only means more work.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchlab.llm import textkit
from matchlab.llm.storage import small_batches, store
from matchlab.session import bounded_broadcast

LONGEST = 5
SLICE = 4 << 20
#: log2 of the places of a bitmap: 4 MB each, however many names are set.
BITS = 25
#: The first wave expands the rarest words, up to this share of all occurrences; the next ones all that the bound demands.
FIRST_SHARE = 1 / 8
#: Languages whose totals and last scores may be broadcast; beyond that they are joined.
MAX_LANGS = 100_000

_PIECE_END = np.zeros(256, bool)
_PIECE_END[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_BETWEEN = _PIECE_END.copy()
_BETWEEN[[0x20, 0x09]] = True
_LANG = np.uint64(0xA24BAED4963EE407)


def _lang_name(lang: str) -> np.uint64:
    raw = np.frombuffer(b"lang " + lang.encode(), np.uint8)
    return textkit.hash_spans(raw, np.array([0]), np.array([len(raw)]))[0]


class _Slice:
    """The words of some rows: names within their language, runs (pieces), and the bytes they stand for."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: list[str]):
        self.data = textkit.LOWER[data]
        self.starts, self.ends, self.first = textkit.words(self.data, offsets, _BETWEEN)
        self.langs = langs
        self.row = np.repeat(np.arange(len(langs)), np.diff(self.first))
        ends = np.searchsorted(np.flatnonzero(_PIECE_END[self.data]), self.starts)
        self.new = np.ones(len(self.row), bool)
        self.new[1:] = (np.diff(self.row) != 0) | (np.diff(ends) != 0)
        self.run = np.cumsum(self.new)
        known = {x: _lang_name(x) for x in set(langs)}
        lang = np.array([known[x] for x in langs], np.uint64) if langs else np.zeros(0, np.uint64)
        name = textkit.mix(textkit.hash_spans(self.data, self.starts, self.ends) + lang[self.row] * _LANG)
        self.name = np.maximum(name, np.uint64(1))  # 0 means no word

    def sequences(self, m: int) -> np.ndarray:
        """Names of the m words from each word on; to be used only where `room` holds."""
        return self.name if m == 1 else textkit.windows(self.name, tuple(range(m)))

    def room(self, m: int) -> np.ndarray:
        n = max(0, len(self.run) - m + 1)
        return self.run[:n] == self.run[m - 1 :]

    def text(self, word: int, m: int, raw: bytes) -> str:
        return b" ".join(raw[self.starts[word] : self.ends[word + m - 1]].split()).decode("utf-8", "replace")


def _slices(batches) -> Iterator[_Slice]:
    for b in batches:
        for i, j, data, offsets in textkit.slices(b.column(1), SLICE):
            yield _Slice(data, offsets, b.column(0).slice(i, j - i).to_pylist())


def _place(names: np.ndarray) -> np.ndarray:
    return (names >> np.uint64(64 - BITS)).astype(np.int64)


def _marked(bitmap, names: np.ndarray) -> np.ndarray:
    at = _place(names)
    return (bitmap.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _bitmap(names: DataFrame):
    """Broadcast bitmap of the names (one long column): at most 2**BITS / 64 rows of 64 places reach the driver."""
    place = F.shiftrightunsigned(F.col(names.columns[0]), 64 - BITS)
    words = names.select(F.shiftright(place, 6).alias("i"), F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(`{names.columns[0]}`, {64 - BITS}) & 63 AS INT))").alias("w"))
    rows = words.groupBy("i").agg(F.bit_or("w").alias("w")).toArrow()
    bits = np.zeros(1 << (BITS - 6), "<i8")
    bits[rows.column("i").to_numpy()] = rows.column("w").to_numpy()
    return names.sparkSession.sparkContext.broadcast(bits.view(np.uint8))


def _signed(names: np.ndarray) -> pa.Array:
    return pa.array(names.view(np.int64))


def word_counts(texts: DataFrame, least: int) -> DataFrame:
    """lang, word, name and f of the words that occur `least` times; the row without a word holds all occurrences of the language."""

    def count(batches):
        for s in _slices(batches):
            raw = s.data.tobytes()
            names, at, n = np.unique(s.name, return_index=True, return_counts=True)
            words = [raw[a:e].decode("utf-8", "replace") for a, e in zip(s.starts[at].tolist(), s.ends[at].tolist())]
            langs = [s.langs[r] for r in s.row[at].tolist()]
            total = np.bincount(s.row, minlength=len(s.langs))
            every: dict[str, int] = {}
            for x, t in zip(s.langs, total.tolist()):
                every[x] = every.get(x, 0) + t
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs + list(every), pa.string()), pa.array(words + [None] * len(every), pa.string()), pa.concat_arrays([_signed(names), pa.nulls(len(every), pa.int64())]), pa.array(n.tolist() + list(every.values()), pa.int64())],
                names=["lang", "word", "name", "f"],
            )

    counts = texts.mapInArrow(count, "lang string, word string, name long, f long").groupBy("lang", "word", "name").agg(F.sum("f").alias("f"))
    return counts.where((F.col("f") >= least) | F.col("word").isNull())


def _named(texts: DataFrame, frequent) -> DataFrame:
    """Each text as names of 8 bytes, one a word: 0 stands for a word that is not marked as frequent and before every piece."""

    def name(batches):
        for s in _slices(batches):
            names = np.where(_marked(frequent, s.name), s.name, np.uint64(0))
            out = np.insert(names, np.flatnonzero(s.new), np.uint64(0))
            ahead = np.concatenate([[0], np.cumsum(s.new)])
            places = 8 * (s.first + ahead[s.first])
            yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.large_binary(), len(s.langs), [None, pa.py_buffer(places), pa.py_buffer(out)]).cast(pa.binary())], names=["names"])

    return texts.mapInArrow(name, "names binary")


def _stream(column: pa.Array) -> np.ndarray:
    """The names of all rows end to end."""
    column = textkit.large_binary(column)
    places = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(bytes(memoryview(column.buffers()[2] or b"")[places[0] : places[-1]]), "<u8")


def _grown(named: DataFrame, m: int, prefixes, least: int) -> DataFrame:
    """Names of m frequent words with a marked prefix that occur `least` times by name, with those of their inner ends (s2 to s4)."""

    def count(batches):
        for b in batches:
            names = _stream(b.column(0))
            n = len(names) - m + 1
            if n <= 0:
                continue
            ok = names[m - 1 :] != 0
            for k in range(m - 1):
                ok &= names[k : k + n] != 0
            at = np.flatnonzero(ok)
            at = at[_marked(prefixes, (names if m == 2 else textkit.windows(names, tuple(range(m - 1))))[at])]
            if not len(at):
                continue
            whole, k, times = np.unique(textkit.windows(names, tuple(range(m)))[at], return_index=True, return_counts=True)
            at = at[k]
            ends = [_signed(textkit.windows(names, tuple(range(j)))[at + m - j]) if j < m else pa.nulls(len(at), pa.int64()) for j in (2, 3, 4)]
            yield pa.RecordBatch.from_arrays([_signed(whole), *ends, pa.array(times)], names=["name", "s2", "s3", "s4", "f"])

    counts = named.mapInArrow(count, "name long, s2 long, s3 long, s4 long, f long")
    return counts.groupBy("name", "s2", "s3", "s4").agg(F.sum("f").alias("f")).where(F.col("f") >= least).drop("f")


def _described(texts: DataFrame, wanted, least: int) -> DataFrame:
    """lang, phrase, m, a (exact, from `least` on) and alone, false where one word always stands before it, or always after it."""

    def describe(batches):
        for s in _slices(batches):
            raw = s.data.tobytes()
            for m in range(2, LONGEST + 1):
                ok = s.room(m)
                if not len(ok):
                    continue
                at = np.flatnonzero(ok & _marked(wanted, s.sequences(m)))
                if not len(at):
                    continue
                names = s.sequences(m)[at]
                order = np.argsort(names, kind="stable")
                at, names = at[order], names[order]
                head = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
                before = np.where((at > 0) & (s.run[at - 1] == s.run[at]), s.name[at - 1], np.uint64(0)).view(np.int64)
                after = np.minimum(at + m, len(s.run) - 1)
                behind = np.where((at + m < len(s.run)) & (s.run[after] == s.run[at]), s.name[after], np.uint64(0)).view(np.int64)
                one = at[head].tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([s.langs[r] for r in s.row[at[head]].tolist()], pa.string()),
                        pa.array([s.text(i, m, raw) for i in one], pa.string()),
                        pa.array(np.full(len(one), m)),
                        pa.array(np.diff(np.append(head, len(at)))),
                        *(pa.array(f.reduceat(x, head)) for x in (before, behind) for f in (np.minimum, np.maximum)),
                    ],
                    names=["lang", "phrase", "m", "a", "b0", "b1", "e0", "e1"],
                )

    rows = texts.mapInArrow(describe, "lang string, phrase string, m long, a long, b0 long, b1 long, e0 long, e1 long")
    whole = rows.groupBy("lang", "phrase", "m").agg(F.sum("a").alias("a"), *[g(c).alias(c) for c, g in (("b0", F.min), ("b1", F.max), ("e0", F.min), ("e1", F.max))])
    held = ((F.col("b0") == F.col("b1")) & (F.col("b0") != 0)) | ((F.col("e0") == F.col("e1")) & (F.col("e0") != 0))
    return whole.where(F.col("a") >= least).select("lang", "phrase", "m", "a", ((F.col("m") == LONGEST) | ~held).alias("alone"))


def _exact(c: str) -> str:
    return f"CAST({c} AS DECIMAL(18,0))"


def scored(known: DataFrame, words: DataFrame, totals: DataFrame, factor: int) -> DataFrame:
    """lang, phrase, a, l, r, n, score and alone of all phrases whose parts are known.

    floor(factor * a * n / (l * r)) is taken of products of up to 37 digits; the cut with the lowest score counts, then the shorter first part.
    """
    count = known.select("lang", "phrase", F.col("a").alias("f")).unionByName(words.select("lang", F.col("word").alias("phrase"), "f"))
    cuts = known.select("*", F.split("phrase", " ").alias("w")).select("*", F.explode(F.expr("sequence(1, CAST(m AS INT) - 1)")).alias("k"))
    parts = cuts.select(
        "lang", "phrase", "m", "a", "alone", "k",
        F.expr("array_join(slice(w, 1, k), ' ')").alias("left"),
        F.expr("array_join(slice(w, k + 1, size(w)), ' ')").alias("right"),
    )
    parts = parts.join(count.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    parts = parts.join(count.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    value = F.expr(f"({_exact(f'{int(factor)}L * a')} * {_exact('n')}) div ({_exact('l')} * {_exact('r')})")
    parts = parts.join(totals, "lang").withColumn("cut", F.struct(value.alias("score"), "k", "l", "r"))
    best = parts.groupBy("lang", "phrase", "m", "a", "n", "alone").agg(F.min("cut").alias("cut"), F.count(F.lit(1)).alias("cuts"))
    return best.where("cuts = m - 1").select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score", "alone")


def collocations(docs: DataFrame, top: int = 2000, least: int = 100, factor: int = 1000, text_col: str = "text", lang_col: str = "lang", waves: list | None = None) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the `top` phrases of 2 to 5 words of each language.

    Texts are lower-cased (A-Z) and split at .,;:!? and line ends into pieces, those at spaces and tabs into words. n
    counts the words of the language, f the places of a phrase within pieces. Phrases with a = f(phrase) >= `least` are scored
    floor(factor * a * n / (f(first part) * f(rest))) at their lowest cut. A phrase that always stands inside one longer phrase of up to
    5 words is dropped: then one word always precedes or always follows it. Order: score and a descending, phrase ascending in UTF-8.

    A null text has no words; a null language is `und`. Repeated rows count each. A very long text is worked
    through whole, by one task. An empty table, or one without frequent phrases, gives no rows. Other columns
    are ignored. `waves` collects the number of words expanded in each wave.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    counted = store(word_counts(texts, least), "words")
    totals = bounded_broadcast(counted.where("word IS NULL").select("lang", F.col("f").alias("n")), MAX_LANGS)
    words = counted.where("word IS NOT NULL").withColumn("class", F.floor(F.log2("f")).cast("int"))
    frequent = _bitmap(words.select("name"))
    named = store(_named(texts, frequent), "names")
    frequent.unpersist()

    # The rarest words, by powers of two: one row per language and power.
    mass = words.groupBy("lang", "class").agg(F.sum("f").alias("mass"))
    upto = F.coalesce(F.sum("mass").over(Window.partitionBy("lang").orderBy("class").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rare = mass.withColumn("upto", upto).join(totals, "lang").where((F.col("upto") == 0) | (F.col("upto") + F.col("mass") <= F.col("n") * FIRST_SHARE)).select("lang", "class")
    rare = bounded_broadcast(store(rare, "rare"), 64 * MAX_LANGS)
    pending, left = (words.join(rare, ["lang", "class"], how) for how in ("left_semi", "left_anti"))
    known = best = None
    while True:
        pending = store(pending.select("lang", "word", "name", "f"), "expanded")
        size = pending.count()
        if waves is not None:
            waves.append(size)
        if size:
            found = _wave(texts, named, pending, least)
            known = found if known is None else store(known.unionByName(found).dropDuplicates(["lang", "phrase"]), "phrases")
            ranked = scored(known, words, totals, factor).where("alone")
            place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
            best = store(ranked.drop("alone").withColumn("rank", place.cast("long")).where(F.col("rank") <= top), "best")
        if left is None:
            break
        pending, left = left.join(totals, "lang"), None
        if best is not None:
            # Last scores only rise, so what falls short of one now is settled for good.
            last = store(best.groupBy("lang").agg(F.count(F.lit(1)).alias("held"), F.min("score").alias("last")).where(F.col("held") >= top), "last")
            bound = F.expr(f"({_exact(f'{int(factor)}L')} * {_exact('n')}) div {_exact('f')}")
            pending = pending.join(bounded_broadcast(last, MAX_LANGS), "lang", "left").where(F.col("last").isNull() | (bound >= F.col("last")))
    columns = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return best.select(*columns) if best is not None else spark.createDataFrame([], "lang string, rank long, phrase string, a long, l long, r long, n long, score long")


def _wave(texts: DataFrame, named: DataFrame, expanded: DataFrame, least: int) -> DataFrame:
    """All frequent phrases that begin with an expanded word, and the ends they are cut into, described."""
    prefixes, levels = expanded, []
    for m in range(2, LONGEST + 1):
        bitmap = _bitmap(prefixes.select("name"))
        prefixes = store(_grown(named, m, bitmap, least), f"level{m}")
        bitmap.unpersist()
        levels.append(prefixes.select(F.explode(F.array("name", *[f"s{j}" for j in range(2, m)])).alias("name")))
    wanted = _bitmap(reduce(DataFrame.unionByName, levels))
    found = store(_described(texts, wanted, least), "phrases")
    wanted.unpersist()
    return found
