"""Packing against a plain greedy over the library's ids: ids, costs, capacities, odd rows."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from matchlab.llm import packing, textkit
from matchlab.llm.queries import QUERIES

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", None, " ", "  ", " a", "a ", "a b", "a  b", "a \n b", "x\xa0 y", "x \xa0y", "x　 　 y z", "it's 's we'll 'll I 'm", "1 2  3 ,.; !", "<|endoftext|> a<|endoftext|> b", "\x1c a\x1d b \x85 c", "日本 語  x", "é ́ b", "w " * 3000, "tie", "tie", "\x00 \x00 q\x0b r"]


@pytest.fixture(scope="module")
def texts(spark, sf):
    return ODD + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]


def library_ids(texts):
    return [x.ids for x in Tokenizer.from_file(VOCABULARY).encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("remember", [1_500_000, 10])
def test_pieces_equal_the_library(texts, remember):
    rnd = random.Random(4)
    mixed = texts + ["".join(rnd.choice(" \n\t\xa0 aé'.1\x1f") for _ in range(rnd.randrange(30))) for _ in range(3000)]
    own, got = packing.ByteTokenizer(VOCABULARY, remember), []
    for _, _, data, offsets in textkit.slices(pa.array(mixed, pa.string()), limit=50_000):
        ids, first = own.encode(data, offsets)
        got += [ids[s:e].tolist() for s, e in zip(first[:-1], first[1:])]
    assert got == library_ids(mixed)


def greedy(sizes, length):
    """The same law, sequence by sequence in plain Python."""
    total = sum(s % length for s in sizes)
    full = sum(s // length for s in sizes)
    room = [length] * (total // length) + [1 << b for b in range(length.bit_length() - 1, -1, -1) if total % length >> b & 1]
    sizes_of = [length] * full + list(room)
    spent, used, out, seq = [0] * len(room), [0] * len(room), [], 0
    for d, s in enumerate(sizes):
        for k in range(s // length):
            out.append((d, k * length, length, seq, 0))
            seq += 1
    for d in sorted(range(len(sizes)), key=lambda d: -(sizes[d] % length)):
        n, at = sizes[d] % length, sizes[d] // length * length
        while n:
            able = [j for j in range(len(room)) if room[j] >= n] or [j for j in range(len(room)) if room[j]]
            j = min(able, key=lambda j: (spent[j], j))
            take = min(n, room[j])
            out.append((d, at, take, full + j, used[j]))
            room[j] -= take
            used[j] += take
            spent[j] += 6 * packing.WIDTH * take + take * take
            n, at = n - take, at + take
    return out, sizes_of


@pytest.mark.parametrize("length", [8, 64, 1024])
def test_packed_equals_plain_greedy(length):
    rnd = random.Random(length)
    for n in (0, 1, 2, 50, 400):
        sizes = [rnd.choice([1, 1, 3, length, 2 * length, rnd.randrange(1, 3 * length)]) for _ in range(n)]
        rows, room = packing.packed(np.array(sizes, np.int64), length)
        want, want_room = greedy(sizes, length)
        assert [tuple(r) for r in rows.tolist()] == want and room.tolist() == want_room


def check_whole(rows, texts_by_id, length):
    """Every id once, offsets gapless, no padding, costs as stated."""
    ids = {k: i + [0] for k, i in zip(texts_by_id, library_ids(texts_by_id.values()))}
    of_doc, of_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        of_doc[r.doc_id].append(r)
        of_seq[r.sequence_id].append(r)
    assert set(of_doc) == set(ids)
    for k, rs in of_doc.items():
        at = 0
        for r in sorted(rs, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids[k]) and 0 < r.length <= length
            assert r.ids_crc32 == zlib.crc32(np.array(ids[k][at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids[k])
    for rs in of_seq.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == rs[0].capacity <= length and at & (at - 1) == 0
        assert {r.sequence_cost for r in rs} == {sum(6 * packing.WIDTH * r.length + r.length**2 for r in rs)}
    return of_seq


@pytest.mark.parametrize("window", [500, 1 << 21])
def test_pack(spark, texts, window):
    docs = spark.createDataFrame([(i, t, 1, "x", 5) for i, t in enumerate(texts)], "doc_id long, text string, length int, ids string, start int").repartition(3)
    rows = packing.pack(docs, VOCABULARY, 0, window=window)
    assert rows.where(F.crc32("ids") != F.col("ids_crc32")).count() == 0 == rows.where(F.length("ids") != 4 * F.col("length")).count()
    check_whole(rows.collect(), dict(enumerate(texts)), 1024)


def test_null_and_repeated_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "a b c"), (7, "same"), (7, "same"), (7, None)], "doc_id long, text string").coalesce(1)
    got = sorted((r.doc_id or 0, r.length, r.doc_tokens) for r in packing.pack(docs, VOCABULARY, 0).collect() if r.start == 0)
    assert len(got) == 4 and [g[0] for g in got] == [0, 7, 7, 7] and sum(r.length for r in packing.pack(docs, VOCABULARY, 0).collect()) == sum(g[2] for g in got)
    assert packing.pack(docs.limit(0), VOCABULARY, 0).count() == 0


def test_query(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    of_seq = check_whole(QUERIES["op11_balanced_packing"](spark, sf).collect(), texts, 1024)
    full = [rs for rs in of_seq.values() if rs[0].capacity == 1024 and len(rs) > 1]
    costs = [rs[0].sequence_cost for rs in full]
    assert np.std(costs) / np.mean(costs) < 0.05
