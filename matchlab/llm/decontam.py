"""Benchmark decontamination by spaced seeds."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlab.llm import textkit
from matchlab.llm.storage import store
from matchlab.session import bounded_broadcast


@dataclass(frozen=True)
class Law:
    """Items of `least` to `most` words: an aligned run of `window` words (0: the whole item) with at most `misses` substituted words is an overlap.

    Each mask lists the word places that a seed keeps. Together they are lossless: however the misses fall, one
    mask has a place in the window where it keeps none of them (a test tries all).
    """

    least: int
    most: int
    window: int
    misses: int
    masks: tuple[tuple[int, ...], ...]


#: Shorter items than the last law's `least` are not searched: a few common words would match everywhere.
LAWS = (
    Law(13, 1 << 60, 13, 2, ((0, 3, 5, 6, 9, 10), (0, 1, 2, 5, 7, 8))),
    Law(8, 12, 0, 1, ((0, 1, 2, 3),)),
    Law(5, 7, 0, 0, ((0, 1, 2, 3, 4),)),
)


def tokens(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, word hashes, index of each row's first word); words are lower-cased runs of letters and digits."""
    for i, j, data, offsets in textkit.slices(column):
        text = pa.LargeStringArray.from_buffers(j - i, pa.py_buffer(np.ascontiguousarray(offsets)), pa.py_buffer(np.ascontiguousarray(data)))
        for _, _, low, at in textkit.slices(pc.utf8_lower(text), limit=1 << 62):
            hashes, first = textkit.word_hashes(low, at, textkit.NOT_ALNUM, lower=False)
            yield i, j, hashes, first


class SeedIndex:
    """The seeds of a block of benchmark items."""

    def __init__(self, ids: list, texts: list):
        self.ids, self.words, self.seeds = [], [], {}
        seen: dict[bytes, int] = {}
        for i, t in sorted(zip(ids, texts), key=lambda x: (x[0] is None, x[0])):
            _, _, w, _ = next(tokens(pa.array([t], pa.large_string())))
            if w.tobytes() not in seen:  # equal items stand for one class, named by the smallest id
                seen[w.tobytes()] = len(self.ids)
                self.ids.append(i)
                self.words.append(w)
        for law in LAWS:
            own = [k for k, w in enumerate(self.words) if law.least <= len(w) <= law.most]
            for mask in law.masks if own else ():
                rows = [(textkit.windows(self.words[k], mask), k) for k in own]
                h = np.concatenate([x for x, _ in rows])
                item = np.concatenate([np.full(len(x), k) for x, k in rows])
                pos = np.concatenate([np.arange(len(x)) for x, _ in rows])
                order = np.argsort(h, kind="stable")
                bits = max(16, int(16 * len(h)).bit_length())
                filled = np.zeros(1 << bits, bool)
                filled[h & np.uint64((1 << bits) - 1)] = True
                self.seeds[law, mask] = (h[order], item[order], pos[order], filled, np.uint64((1 << bits) - 1))

    def hits(self, hashes: np.ndarray, first: np.ndarray) -> Iterator[tuple[Law, np.ndarray]]:
        """Per law, distinct (row, item, diagonal) at which a seed of the text meets one of an item."""
        found: dict[Law, list] = {}
        for (law, mask), (keys, item, pos, filled, low) in self.seeds.items():
            h = textkit.windows(hashes, mask)
            at = np.flatnonzero(filled[h & low])
            row = np.searchsorted(first, at, "right") - 1
            at, row = (x[at + mask[-1] < first[row + 1]] for x in (at, row))
            left = np.searchsorted(keys, h[at], "left")
            n = np.searchsorted(keys, h[at], "right") - left
            total = int(n.sum())
            if total:
                k = np.arange(total) - np.repeat(np.cumsum(n) - n, n) + np.repeat(left, n)
                place = np.repeat(at - first[row], n) - pos[k]
                found.setdefault(law, []).append(np.column_stack([np.repeat(row, n), item[k], place]))
        for law, rows in found.items():
            yield law, np.unique(np.concatenate(rows), axis=0)

    def overlaps(self, law: Law, item: int, diagonal: int, text: np.ndarray) -> tuple[int, int, int, int] | None:
        """First and last text word, number of windows and fewest substitutions of the overlaps on one diagonal."""
        w = self.words[item]
        size = law.window or len(w)
        begin, end = max(0, diagonal), min(len(text), diagonal + len(w))
        if end - begin < size:
            return None
        missed = np.concatenate([[0], np.cumsum(text[begin:end] != w[begin - diagonal : end - diagonal])])
        per_window = missed[size:] - missed[:-size]
        good = np.flatnonzero(per_window <= law.misses)
        if not len(good):
            return None
        return begin + int(good[0]), begin + int(good[-1]) + size - 1, len(good), int(per_window[good].min())


def overlaps(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", block_bytes: int = 16 << 20) -> DataFrame:
    """Pairs of a text and a benchmark item that share an aligned run of words, see LAWS.

    Returns id, item_id (the smallest id of items with equal words), first_word and last_word of the text
    (from 0, over all overlaps with that item), n_windows and fewest substitutions. The items go out to the texts in
    blocks of about block_bytes of item text: a block's seeds are an index that each task joins with the
    seeds of its texts, so neither shuffles and no passage, however common, gathers rows; more items mean more passes.

    Null and empty texts and items overlap with nothing. Null ids are kept as null. Repeated rows of texts are
    searched each; their pairs come once for every row. Extra columns are ignored. Empty tables give no pairs.
    """
    spark = docs.sparkSession
    own = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).alias("text")).where("text IS NOT NULL")
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = -(-size // block_bytes)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    parts = []
    for k in range(n_blocks):
        # equal word runs meet in one block
        plain = F.trim(F.regexp_replace(F.lower("text"), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))
        block = own.where(F.pmod(F.xxhash64(plain), F.lit(n_blocks)) == k).collect()
        index = spark.sparkContext.broadcast(SeedIndex([r.item_id for r in block], [r.text for r in block]))
        parts.append(texts.mapInArrow(_searcher(index), "doc_id long, item_id long, first_word long, last_word long, n_windows long, substitutions long"))
    if not parts:
        return spark.createDataFrame([], f"{id_col} long, item_id long, first_word long, last_word long, n_windows long, substitutions long")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumnRenamed("doc_id", id_col)


def _searcher(index):
    def search(batches):
        seeds: SeedIndex = index.value
        for b in batches:
            names = b.column(0)
            for i, _, hashes, first in tokens(b.column(1)):
                best: dict[tuple[int, int], tuple] = {}
                for law, rows in seeds.hits(hashes, first):
                    for row, item, diagonal in rows.tolist():
                        found = seeds.overlaps(law, item, diagonal, hashes[first[row] : first[row + 1]])
                        if found:
                            a = best.get((row, item), (found[0], found[1], 0, found[3]))
                            best[row, item] = (min(a[0], found[0]), max(a[1], found[1]), a[2] + found[2], min(a[3], found[3]))
                if best:
                    keys = sorted(best)
                    yield pa.RecordBatch.from_arrays(
                        [names.take(pa.array([i + r for r, _ in keys])).cast(pa.int64()), pa.array([seeds.ids[k] for _, k in keys], pa.int64()), *(pa.array(c, pa.int64()) for c in zip(*(best[k] for k in keys)))],
                        names=["doc_id", "item_id", "first_word", "last_word", "n_windows", "substitutions"],
                    )

    return search


def clean_of(docs: DataFrame, items: DataFrame, **names) -> DataFrame:
    """The rows of docs whose text overlaps with no item; all columns stay. Equal texts share one verdict, so null and repeated ids are safe."""
    row = "__text_hash"
    numbered = docs.withColumn(row, F.xxhash64(F.col(names.get("text_col", "text"))))
    hit = store(overlaps(numbered, items, **{**names, "id_col": row}).select(row).distinct(), "hits")
    return numbered.join(bounded_broadcast(hit, 1_000_000), row, "left_anti").drop(row)
