"""Jaccard join of word-shingle sets, and the classes of linked documents."""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlab.llm import textkit
from matchlab.llm.storage import store
from matchlab.session import bounded_broadcast

WORDS = 5
#: Two sets link from this similarity on.
LEAST = Fraction(4, 5)
#: Rows of one tile; larger groups are split into tiles, and tiles are compared pair by pair.
TILE = 2048
#: Groups of one prefix shingle with at most so many rows give their pairs at once.
SMALL = 16
#: Two linked sets share at least so many prefix shingles (or nearly all, if they are smaller); prefixes are longer by as much.
SHARED = 8
#: Prefix entries that one task sorts.
BUCKET = 400_000
#: Broadcast names of documents up to this count, else join by shuffle.
BROADCAST_IDS = 1_000_000
#: So many of the most shared shingles are moved to the end of the prefix order (a bound on the broadcast).
COMMON = 500_000


def shingle_sets(column: pa.Array, words: int = WORDS):
    """Per row the sorted distinct hashes of its word windows; shorter rows are one window of all their words."""
    for _, _, data, offsets in textkit.slices(column):
        hashes, first = textkit.word_hashes(data, offsets)
        window = textkit.windows(hashes, tuple(range(words)))
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= words:
                yield np.unique(window[a : b - words + 1])
            elif b > a:
                yield textkit.windows(hashes[a:b], tuple(range(b - a)))
            else:
                yield np.zeros(0, np.uint64)


def band(n: int) -> int:
    """Sets of 2**(band - 1) to 2**band - 1 shingles; linked sets lie in one band or in neighbours."""
    return int(n).bit_length()


def width(n: int) -> int:
    """Bits of a signature: eight to sixteen for each shingle, a power of two."""
    return max(64, 1 << (band(n) + 3))


def signature(s: np.ndarray) -> bytes:
    bits = np.zeros(width(len(s)), np.uint8)
    bits[(s >> np.uint64(20)) & np.uint64(len(bits) - 1)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def fold(bits: np.ndarray, to: int) -> np.ndarray:
    """Signatures of half the width, again and again: bit positions modulo the smaller width."""
    while bits.shape[1] > to:
        half = bits.shape[1] // 2
        bits = bits[:, :half] | bits[:, half:]
    return bits


def least_overlap(a, b):
    """The smallest intersection at which sets of these sizes link."""
    p, q = LEAST.numerator, LEAST.denominator
    return -(-p * (a + b) // (p + q))


def overlap_bound(na: np.ndarray, a: np.ndarray, nb: np.ndarray, b: np.ndarray) -> np.ndarray:
    """No pair's intersection is larger: each bit that only one side has stands for a shingle that only it has."""
    m = min(a.shape[1], b.shape[1])
    a, b = fold(a, m), fold(b, m)
    return np.minimum(na - np.bitwise_count(a & ~b).sum(1, dtype=np.int64), nb - np.bitwise_count(b & ~a).sum(1, dtype=np.int64))


def _lines(blobs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), np.uint64).reshape(len(blobs), -1)


def prefix_length(n):
    """Two sets that link share SHARED of their first so many shingles in any common order.

    They have t >= 4/5 of the larger set's n in common, so at most n - t of a set's shingles are not shared; with SHARED > t
    the prefix is the whole set.
    """
    return np.minimum(n, n - -(-LEAST.numerator * n // LEAST.denominator) + SHARED)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """key, doc, text. The key names a row by its id and text, so repeated ids do not mix."""
    own = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    return own.select(F.xxhash64("doc", "text").alias("key"), "doc", "text")


def _survey(docs: DataFrame) -> DataFrame:
    """Rows of two kinds: a document (key, doc, n, fingerprint and signature of its set), or a shingle that several
    rows of one slice share (key holds its hash, n the number of rows). Fingerprint and signature of an empty set are null."""

    def read(batches):
        for b in batches:
            n, fp, bits, sets, held = [], [], [], [], 0
            for s in shingle_sets(b.column(2)):
                n.append(len(s))
                fp.append(np.array([s.sum(), textkit.mix(s).sum()], np.uint64).tobytes() if len(s) else None)
                bits.append(signature(s) if len(s) else None)
                sets.append(s)
                held += len(s)
                if held > 2_000_000:
                    yield shared(sets)
                    sets, held = [], 0
            if sets:
                yield shared(sets)
            yield table(b.column(0), b.column(1), n, fp, bits, True)

    def shared(sets):
        keys, count = np.unique(np.concatenate(sets), return_counts=True)
        many = count > 1
        none = [None] * int(many.sum())
        return table(keys[many].view(np.int64), none, count[many], none, none, False)

    def table(key, doc, n, fp, bits, is_doc):
        size = len(n)
        return pa.RecordBatch.from_arrays(
            [pa.array(key, pa.int64()), pa.array(doc, pa.int64()), pa.array(n, pa.int64()), pa.array(fp, pa.binary()), pa.array(bits, pa.binary()), pa.array([is_doc] * size, pa.bool_())],
            names=["key", "doc", "n", "fp", "bits", "is_doc"],
        )

    return store(docs.mapInArrow(read, "key long, doc long, n long, fp binary, bits binary, is_doc boolean"), "survey")


def _common(survey: DataFrame) -> np.ndarray:
    """The most shared shingles, most shared last; at most COMMON of them.

    They come last in the order of prefixes, so passages that many texts share rarely lead to candidates. Links do not
    depend on the order, so what the slices miss costs time only.
    """
    counted = survey.where("NOT is_doc").groupBy("key").agg(F.sum("n").alias("c")).where("c > 2")
    rows = counted.orderBy(F.desc("c"), "key").limit(COMMON).select("key").toPandas()
    return rows["key"].to_numpy(np.int64)[::-1].copy().view(np.uint64)


def _runs(docs: DataFrame, entries: int, common: np.ndarray) -> DataFrame:
    """Rows that share prefix shingles: pairs (a, b) of small groups with their number c, and (h, a) of the rows of large ones (b null).

    Prefix entries travel in packed blocks, one for each bucket of hashes. Entries of the common shingles need no
    grouping to be known as large; they are dealt by row, so no task holds such a group.
    """
    buckets = max(1, -(-entries // BUCKET))
    spread = docs.sparkSession.sparkContext.broadcast((np.sort(common), np.argsort(common)))

    def read(batches):
        by_hash, rank = spread.value
        for b in batches:
            keys, hs, size, hot, held = [], [], [], [], 0
            for key, s in zip(b.column(0).to_pylist(), shingle_sets(b.column(1))):
                if not len(s):
                    continue
                place = np.full(len(s), -1)
                if len(by_hash):
                    at = np.minimum(np.searchsorted(by_hash, s), len(by_hash) - 1)
                    place = np.where(by_hash[at] == s, rank[at], -1)
                first = np.argsort(place, kind="stable")[: prefix_length(len(s))]
                keys.append(key)
                hs.append(s[first])
                hot.append(place[first] >= 0)
                size.append(len(first))
                held += len(first)
                if held > 1_000_000:
                    yield pack(keys, hs, size, hot)
                    keys, hs, size, hot, held = [], [], [], [], 0
            if keys:
                yield pack(keys, hs, size, hot)

    def pack(keys, hs, size, hot):
        k, h, hot = np.repeat(np.array(keys, np.int64), size), np.concatenate(hs), np.concatenate(hot)
        bucket = np.where(hot, -1 - (k.view(np.uint64) % np.uint64(buckets)).astype(np.int64), ((h >> np.uint64(8)) % np.uint64(buckets)).astype(np.int64))
        order = np.argsort(bucket, kind="stable")
        k, h, bucket = k[order], h[order], bucket[order]
        cut = np.flatnonzero(np.diff(bucket)) + 1
        return pa.RecordBatch.from_arrays(
            [
                pa.array(bucket[np.concatenate([[0], cut])]),
                pa.array([x.tobytes() for x in np.split(h, cut)], pa.binary()),
                pa.array([x.tobytes() for x in np.split(k, cut)], pa.binary()),
            ],
            names=["bucket", "hs", "ks"],
        )

    def group(key, t):
        h = np.frombuffer(b"".join(t.column("hs").to_pylist()), np.uint64)
        k = np.frombuffer(b"".join(t.column("ks").to_pylist()), np.int64)
        if key[0].as_py() < 0:
            return rows([], [], [], h, k)
        order = np.lexsort((k, h))
        h, k = h[order], k[order]
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (k[1:] != k[:-1])])  # repeated rows have one key
        h, k = h[new], k[new]
        start = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        count = np.diff(np.append(start, len(h)))
        pairs = []
        for n in range(2, SMALL + 1):
            at = start[count == n]
            if len(at):
                i, j = np.triu_indices(n, 1)
                pairs.append(np.column_stack([k[at[:, None] + i].ravel(), k[at[:, None] + j].ravel()]))
        pairs, times = np.unique(np.concatenate(pairs), axis=0, return_counts=True) if pairs else (np.zeros((0, 2), np.int64), np.zeros(0, np.int64))
        large = np.repeat(count > SMALL, count)
        return rows(pairs[:, 0], pairs[:, 1], times, h[large], k[large])

    def rows(a, b, c, h, k):
        n, m = len(a), len(h)
        return pa.table(
            {
                "h": pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(h.view(np.int64))]),
                "a": pa.concat_arrays([pa.array(a, pa.int64()), pa.array(k)]),
                "b": pa.concat_arrays([pa.array(b, pa.int64()), pa.nulls(m, pa.int64())]),
                "c": pa.concat_arrays([pa.array(c, pa.int64()), pa.nulls(m, pa.int64())]),
            }
        )

    packed = docs.select("key", "text").mapInArrow(read, "bucket long, hs binary, ks binary")
    return store(packed.groupBy("bucket").applyInArrow(group, "h long, a long, b long, c long"), "runs")


def _sharing(runs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of the small groups that share enough prefix shingles. A linked pair that shares one with a large group is found there;
    any other has all its shared ones in small groups, where they are counted."""
    pairs = runs.where("b IS NOT NULL").groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("c").alias("c"))
    size = lambda x: sets.select(F.col("key").alias(x), F.col("n").alias(f"n{x}"))
    p, q = LEAST.numerator, LEAST.denominator
    enough = F.expr(f"c >= least({SHARED}, ({p} * greatest(na, nb) + {q - 1}) div {q})")
    return pairs.join(size("a"), "a").join(size("b"), "b").where(enough & _sizes_allow("na", "nb")).select("a", "b")


def _likely(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs of sets that sizes and signatures let through."""
    side = lambda x: sets.select(F.col("key").alias(x), F.col("n").alias(f"n{x}"), F.col("bits").alias(f"bits{x}"))
    both = pairs.distinct().join(side("a"), "a").join(side("b"), "b").where(_sizes_allow("na", "nb")).select("a", "b", "na", "nb", "bitsa", "bitsb")

    def bound(batches):
        for t in batches:
            wa, wb = (np.array([len(x) for x in t.column(c).to_pylist()], np.int64) for c in (4, 5))
            keep = np.zeros(t.num_rows, bool)
            for u, v in set(zip(wa.tolist(), wb.tolist())):
                k = np.flatnonzero((wa == u) & (wb == v))
                a, b = (_lines(t.column(c).take(pa.array(k)).to_pylist()) for c in (4, 5))
                na, nb = (t.column(c).to_numpy()[k] for c in (2, 3))
                keep[k] = overlap_bound(na, a, nb, b) >= least_overlap(na, nb)
            yield t.filter(pa.array(keep)).select(["a", "b"])

    return store(both.mapInArrow(bound, "a long, b long"), "likely")


def _sizes_allow(na: str, nb: str):
    p, q = LEAST.numerator, LEAST.denominator
    return (F.col(na) * q >= F.col(nb) * p) & (F.col(nb) * q >= F.col(na) * p)


def _links(docs: DataFrame, likely: DataFrame) -> DataFrame:
    """Of the likely pairs those whose sorted arrays intersect enough; texts are read again for their rows only."""
    names = store(likely.select(F.col("a").alias("key")).union(likely.select("b")).distinct(), "names")

    def read(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([s.tobytes() for s in shingle_sets(b.column(1))], pa.binary())], names=["key", "data"])

    wanted = docs.select("key", "text").join(bounded_broadcast(names, BROADCAST_IDS), "key", "left_semi")
    arrays = store(wanted.mapInArrow(read, "key long, data binary").dropDuplicates(["key"]), "arrays")
    side = lambda x: arrays.select(F.col("key").alias(x), F.col("data").alias(f"data{x}"))
    both = likely.join(side("b"), "b").join(side("a"), "a").select("a", "b", "dataa", "datab")

    def exact(batches):
        for t in batches:
            keep = []
            for x, y in zip(t.column(2).to_pylist(), t.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                keep.append(len(np.intersect1d(x, y, assume_unique=True)) >= least_overlap(len(x), len(y)))
            yield t.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return store(both.mapInArrow(exact, "a long, b long"), "links")


def classes(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """key, comp: for every node the smallest key that links reach. nodes: key; links: a, b.

    Each round a node takes the smallest class of its neighbours and then that class's own class, so long chains settle in
    few rounds; rounds go on until nothing changes.
    """
    if links.isEmpty():
        return nodes.select("key", F.col("key").alias("comp"))
    edges = store(links.select("a", "b").union(links.select("b", "a")).distinct(), "edges")
    label = store(edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("key"), F.least("a", "m").alias("comp")), "classes")
    while True:
        near = edges.join(label, edges.b == label.key).groupBy("a").agg(F.min("comp").alias("near"))
        hop = label.join(near, label.key == near.a).select("key", "comp", F.least("comp", "near").alias("to"))
        jump = label.select(F.col("key").alias("to"), F.col("comp").alias("beyond"))
        new = store(hop.join(jump, "to", "left").select("key", F.least("to", F.coalesce("beyond", "to")).alias("comp"), (F.col("comp") != F.least("to", F.coalesce("beyond", "to"))).alias("moved")), "classes")
        label = new.select("key", "comp")
        if new.where("moved").isEmpty():
            return nodes.select("key").join(label, "key", "left").select("key", F.coalesce("comp", "key").alias("comp"))


def _star_pairs(groups: DataFrame) -> DataFrame:
    """For each prefix shingle of a large group, pairs of its most typical row with the others. groups: h, key, n.

    Typical is the row whose prefix shingles are the most shared on average: in a group of edited copies, the text that
    they were made from. Copies link to it directly, not pair by pair.
    """
    held = groups.join(groups.groupBy("h").agg(F.count("*").alias("rows")), "h")
    p, q = LEAST.numerator, LEAST.denominator
    length = F.expr(f"least(n, n - (({p} * n + {q - 1}) div {q}) + {SHARED})")
    share = held.groupBy("key").agg((F.sum("rows") / F.first(length)).alias("share"))
    ranked = groups.join(share, "key")
    top = ranked.groupBy("h").agg(F.max(F.struct("share", "key")).getField("key").alias("top"))
    return ranked.join(top, "h").where("key <> top").select(F.least("key", "top").alias("a"), F.greatest("key", "top").alias("b")).distinct()


def _tile_pairs(groups: DataFrame, sets: DataFrame, label: DataFrame) -> DataFrame:
    """All pairs of one large group and of different classes that sizes and signatures let through.

    A group's rows are cut by size band and, beyond TILE rows, by a hash into tiles. A tile meets the tiles of its own
    band and of the next; each such pair of tiles is compared in one task on signatures. Groups that are one class by now are done.
    """
    p, q = LEAST.numerator, LEAST.denominator
    run = groups.join(label, "key").withColumn("band", F.length(F.bin("n")))
    mixed = run.groupBy("h").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("h")
    run = store(run.join(mixed, "h"), "open-groups")
    bands = run.groupBy("h", "band").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    lower = bands.select("h", (F.col("band") + 1).alias("band"), F.col("tiles").alias("below"))
    upper = bands.select("h", (F.col("band") - 1).alias("band"), F.col("tiles").alias("above"))
    bands = bands.join(lower, ["h", "band"], "left").join(upper, ["h", "band"], "left")
    low = F.expr("CAST(shiftleft(1L, band - 1) AS LONG)")
    rows = run.join(bands, ["h", "band"]).withColumn("tile", F.expr("CAST(pmod(xxhash64(key), tiles) AS INT)"))
    up = F.when(F.col("n") * q >= low * 2 * p, F.col("above"))  # can link with the smallest set of the next band
    down = F.when((low - 1) * q >= F.col("n") * p, F.col("below"))
    upto = lambda c: F.when(c.isNotNull(), F.sequence(F.lit(0), c - 1)).otherwise(F.array().cast("array<int>"))
    place = lambda b1, b2, t1, t2, side: F.struct(b1.alias("b1"), b2.alias("b2"), t1.alias("t1"), t2.alias("t2"), F.lit(side).alias("side"))
    b, t = F.col("band"), F.col("tile")
    own = F.transform(upto(F.col("tiles")), lambda k: F.when(k > t, place(b, b, t, k, 0)).when(k < t, place(b, b, k, t, 1)).otherwise(place(b, b, t, t, 2)))
    places = F.concat(own, F.transform(upto(up), lambda k: place(b, b + 1, t, k, 0)), F.transform(upto(down), lambda k: place(b - 1, b, k, t, 1)))
    placed = rows.select("h", "key", "n", "comp", F.explode(places).alias("p")).select("h", "key", "n", "comp", "p.*")
    placed = placed.join(sets.select("key", "bits"), "key")
    # several small groups share a task; the segments of one (h, b1, b2, t1, t2) stay together
    bucket = F.pmod(F.xxhash64("h", "b1", "b2", "t1", "t2"), F.lit(max(1, run.count() // (4 * TILE))))

    def compare(t):
        t = t.combine_chunks().sort_by([(c, "ascending") for c in ("h", "b1", "b2", "t1", "t2", "side")])
        at = np.column_stack([t.column(c).to_numpy() for c in ("h", "b1", "b2", "t1", "t2")])
        cuts = np.concatenate([[0], np.flatnonzero((at[1:] != at[:-1]).any(1)) + 1, [len(at)]])
        out = []
        for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            out += segment(t.slice(s, e - s))
        out = np.unique(np.array(out, np.int64).reshape(-1, 2), axis=0)
        return pa.table({"a": pa.array(out[:, 0]), "b": pa.array(out[:, 1])})

    def segment(t):
        key, n, comp, side = (t.column(c).to_numpy() for c in ("key", "n", "comp", "side"))
        blobs = t.column("bits").to_pylist()
        wide = np.array([len(x) for x in blobs], np.int64)
        lines, place = {}, np.zeros(len(key), np.int64)
        for w in np.unique(wide).tolist():
            k = np.flatnonzero(wide == w)
            lines[w], place[k] = _lines([blobs[i] for i in k]), np.arange(len(k))
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        out = []
        for i in left:
            j = right[(n[right] * q >= n[i] * p) & (n[i] * q >= n[right] * p) & (comp[right] != comp[i])]
            if side[i] == 2:
                j = j[j > i]
            for w in np.unique(wide[j]).tolist():
                k = j[wide[j] == w]
                ok = overlap_bound(n[i], lines[int(wide[i])][place[i]][None, :], n[k], lines[w][place[k]]) >= least_overlap(n[i], n[k])
                out += [(min(x, y), max(x, y)) for x, y in ((int(key[i]), int(key[m])) for m in k[ok])]
        return out

    return store(placed.withColumn("bucket", bucket).groupBy("bucket").applyInArrow(compare, "a long, b long").distinct(), "tile-pairs")


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_shingles, component_id (the smallest id that links reach, its own included) and n_links.

    A row's set is its distinct 5-word shingles (white-space words, A-Z lower-cased); a shorter text is one shingle of all its
    words. Two rows link when intersection / union is at least 4/5. Equal sets are one class from the start and are
    compared once. Of the others every pair that could join two classes is tested, so no link between different texts is lost:

    1. linked sets share prefix shingles, so rows are grouped by those (`_runs`);
    2. small groups give their pairs, of which those that share enough stay, large ones first only pairs with their most typical row;
    3. sizes and signatures bound a pair's overlap, then its sorted arrays are intersected (`_likely`, `_links`);
    4. in large groups that are not one class by then, all pairs of different classes are compared tile by tile.

    n_links is the number of tested links of the row's set with other sets (links inside a class that the tests did not
    need are not counted). Null and empty texts have no shingles and are their own component. Null ids take part and have a
    component if a row with an id is reached, else null. Equal ids with different texts are judged apart; repeated rows are
    equal sets. Extra columns are ignored. An empty table gives no rows.
    """
    own = _keyed(docs, id_col, text_col)
    survey = _survey(own)
    rows = survey.where("is_doc").select("key", "doc", "n", "fp", "bits")
    sets = store(rows.where("fp IS NOT NULL").groupBy("fp").agg(F.min("key").alias("key"), F.first("n").alias("n"), F.first("bits").alias("bits")), "sets")
    p, q = LEAST.numerator, LEAST.denominator
    entries = rows.agg(F.sum(F.expr(f"n - (({p} * n + {q - 1}) div {q}) + {SHARED}"))).first()[0] or 0
    runs = _runs(own, entries, _common(survey))
    groups = store(runs.where("b IS NULL").select("h", F.col("a").alias("key")).distinct().join(sets.select("key", "n"), "key"), "groups")
    links = _links(own, _likely(_sharing(runs, sets).union(_star_pairs(groups)), sets))
    label = classes(sets, links)
    if not groups.isEmpty():
        likely = _tile_pairs(groups, sets, label)
        more = links.limit(0) if likely.isEmpty() else _links(own, likely)
        if not more.isEmpty():
            links = links.union(more)
            label = classes(sets, links)
    degree = links.select(F.col("a").alias("key")).union(links.select("b")).groupBy("key").agg(F.count("*").alias("n_links"))
    of_set = sets.select("fp", "key").join(label, "key").join(degree, "key", "left").select("fp", "comp", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    member = rows.select("doc", "n", "fp").join(of_set, "fp", "left")
    smallest = member.where("comp IS NOT NULL").groupBy("comp").agg(F.min("doc").alias("smallest"))
    return member.join(smallest, "comp", "left").select(
        F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("comp").isNull(), F.col("doc")).otherwise(F.col("smallest")).alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class of jaccard_classes, that of the smallest id (null ids last); all columns stay.

    Rows without shingles all stay. Of rows with equal id and text one stays. Verdicts are joined by a key of id and text.
    """
    key = "__row_key"
    named = docs.withColumn(key, F.xxhash64(F.col(id_col).cast("long"), F.col(text_col)))
    found = jaccard_classes(named, key, text_col).select(F.col(key), F.col("component_id").alias("__class"), "n_shingles")
    rows = store(named.select(key, F.col(id_col).cast("long").alias("__id")).join(found.distinct(), key), "verdicts")
    order = F.struct(F.col("__id").isNull(), "__id", key)
    full = rows.where("n_shingles > 0")
    first = full.groupBy("__class").agg(F.min(order).getField(key).alias(key)).select(key)
    others = store(full.select(key).distinct().join(first, key, "left_anti"), "others")
    kept = named.join(bounded_broadcast(others, BROADCAST_IDS), key, "left_anti")
    if not full.groupBy(key).count().where("count > 1").isEmpty():
        again = F.when(F.length(F.btrim(F.coalesce(F.col(text_col), F.lit("")), F.lit(" \t\n\x0b\x0c\r"))) == 0, F.monotonically_increasing_id())
        kept = kept.withColumn("__again", again).dropDuplicates([key, "__again"]).drop("__again")
    return kept.drop(key)
