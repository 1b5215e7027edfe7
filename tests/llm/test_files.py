"""Token files, WARC archives and shards: round trips, damage, nulls, ties, empty tables."""

import os
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from matchlab.llm import sharding, tokenfile, warc

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
ODD = ["A.B:c;1,2?!x é.e a\u0301.b .5 ..a", "<|ENDOFTEXT|>.A <|endoftext|>!b", "Don'T it'S. 's,'ll", "a\x01b \x01 c", "\x01", "a.", ".b", "", None, "a", "Don't STOP!! naïve café́  x y\x1cz <|endoftext|> <|startoftext|>a", "﻿ÀÉ İstanbul ΣΑΣ ͅ", "x" * 5000 + " tail", "tie", "tie", "日本語 テスト\r\n\t\x0b\x0c end", "à ́b"]


def docs(spark, rows, extra="start long, part int"):
    return spark.createDataFrame([(*r, 7, 8) for r in rows], f"doc_id long, text string, {extra}")


@pytest.fixture(scope="module")
def texts(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()
    return ODD + [r.text for r in rows]


def test_pieces_equal_the_library(texts):
    want = [x.ids for x in Tokenizer.from_file(VOCABULARY).encode_batch([t or "" for t in texts], add_special_tokens=False)]
    for remember in (1_500_000, 10):
        own = tokenfile.PieceTokenizer(VOCABULARY, remember)
        from matchlab.llm import textkit

        got = []
        for _, _, data, offsets in textkit.slices(pa.array(texts, pa.string()), limit=20_000):
            ids, first = own.encode(data, offsets)
            got += [ids[s:e].tolist() for s, e in zip(first[:-1], first[1:])]
        assert got == want


LATIN = ["Straße, ÉTÉ.été ß$$$ é&É%x", "naïve#café ×é÷ ªº µm é\u0301.a", "'s&'re don't&x 's#t 50%é", "é<|ENDOFTEXT|>É", "<\u0338a é", "a\xadb ÿÞ", "ß" * 70_000 + " b"]


def test_distinct_words_equal_the_library(texts):
    from matchlab.llm import textkit

    texts = LATIN + texts
    want = [x.ids for x in Tokenizer.from_file(VOCABULARY).encode_batch([t or "" for t in texts], add_special_tokens=False)]
    for remember in (1_500_000, 10):
        own = tokenfile.PieceTokenizer(VOCABULARY, remember)
        assert own.plain and own.cuts
        for _ in range(2):
            got = []
            for _, _, data, offsets in textkit.slices(pa.array(texts, pa.string()), limit=20_000):
                ids, first = own.encode_words(data, offsets, textkit.distinct_words(data, offsets))
                got += [ids[s:e].tolist() for s, e in zip(first[:-1], first[1:])]
            assert got == want
    assert tokenfile.PieceTokenizer(public_tokenizers.path("byte_bpe_50k.json")).plain is None


def test_known_words_are_not_encoded_again(monkeypatch):
    from matchlab.llm import textkit

    own, seen = tokenfile.PieceTokenizer(VOCABULARY), []
    encode = tokenfile.PieceTokenizer.encode
    monkeypatch.setattr(tokenfile.PieceTokenizer, "encode", lambda self, data, offsets: seen.append(len(offsets) - 1) or encode(self, data, offsets))
    monkeypatch.setattr(own, "library", None)  # words of letters need no normaliser and no splitting
    for text in ("Tea tea café tea.", "tea. CAFé Tea", "tea milk"):
        data = np.frombuffer(text.replace(".", "").encode(), np.uint8)
        offsets = np.array([0, len(data)])
        own.encode_words(data, offsets, textkit.distinct_words(data, offsets))
    assert seen == [2, 1]


@pytest.mark.parametrize("length", [8, 1024])
def test_token_files_round_trip(spark, texts, length):
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, "no id")]
    random.Random(1).shuffle(rows)
    got = tokenfile.token_table(docs(spark, rows), VOCABULARY, 1, length=length, partitions=3).collect()
    library = Tokenizer.from_file(VOCABULARY)
    want, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library.encode(t or "", add_special_tokens=False).ids + [1]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_token_file_layout(spark, texts):
    files = tokenfile.write_token_files(docs(spark, list(enumerate(texts))), VOCABULARY, 1, length=64, partitions=1).collect()
    reader = tokenfile.open_tokens(files[0].path)
    last = reader.get_batch(reader.num_record_batches - 1)
    assert last.schema.field("ids").type == pa.list_(pa.uint16(), 64)
    assert last.schema.field("mask").type == pa.list_(pa.bool_(), 64)
    batches = [reader.get_batch(k) for k in range(reader.num_record_batches)]
    masks = np.concatenate([b.column("mask").flatten().to_numpy(zero_copy_only=False) for b in batches])
    assert sum(len(b.column("starts").flatten()) for b in batches) == len(texts)
    assert files[0].tokens == masks.sum() and len(masks) - files[0].tokens < 64


def test_empty_tables(spark):
    none = docs(spark, []).limit(0)
    assert tokenfile.token_table(none, VOCABULARY, 1).count() == 0
    assert sharding.byte_shards(none, 4).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.page_rows(warc.read_archives(warc.write_archives(pages))).count() == 0


def test_shards_are_contiguous_and_near_equal(spark):
    rows = [(i, None if i % 11 == 0 else "ü" * (i * 37 % 400)) for i in range(500)] + [(None, "x"), (5, "again")]
    got = sharding.byte_shards(docs(spark, rows, "size long, shard int"), 7).orderBy("start", "doc_id").collect()
    assert len(got) == 502 and [r.shard for r in got] == sorted(r.shard for r in got)
    sizes, largest = np.zeros(7), max(r.size for r in got)
    start = 0
    for r in got:
        assert r.start == start
        start += r.size
        sizes[r.shard] += r.size
    assert abs(sizes - sizes.mean()).max() <= largest
    for s in range(7):
        assert [r.slot for r in got if r.shard == s] == list(range(sum(r.shard == s for r in got)))
    assert {r.text_crc32 for r in got if r.size == 16} == {0}


def test_warc_round_trip(spark):
    rows = [(1, "http://a", "same", 1), (2, None, "same", 1), (3, "http://b\r\nX: y", "ü" * 70000, 1), (4, "", None, 1), (5, "u", "", 1), (None, "n", "same", 1), (2, "u", "same", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest int")
    got = sorted(map(tuple, warc.page_rows(warc.read_archives(warc.write_archives(pages))).collect()), key=str)
    d = warc.base32_sha1
    same, none, long = d(b"same"), d(b""), d(("ü" * 70000).encode())
    want = [(1, 4, same, "revisit", 2), (2, 4, same, "response", None), (2, 4, same, "response", None), (3, 140000, long, "response", None), (4, 0, none, "revisit", 5), (5, 0, none, "response", None), (None, 4, same, "response", None)]
    assert got == sorted(want, key=str)
    apart = warc.page_rows(warc.read_archives(warc.write_archives(pages, min_bytes=5))).collect()
    assert {r.record_type for r in apart} == {"response"}


def damaged(raw: list[bytes], how) -> tuple[list, list]:
    data = how(raw)
    f = pa.BufferReader(data)
    found = list(warc.salvage(f, len(data)))
    at = 0
    for _, start, end, _, _ in found:  # no byte is lost or read twice
        assert start == at
        at = end
    assert at == len(data)
    return [r[4] for r in found if r[0] == "record"], [r for r in found if r[0] == "gap"]


@pytest.mark.parametrize("pack", [warc.member, lambda raw: raw])
def test_salvage(pack):
    blocks = [os.urandom(50 + 3000 * k) + b"WARC/1.0 \x1f\x8b\x08" for k in range(6)]
    raw = [pack(warc.record(k, "u", b, warc.base32_sha1(b), None)) for k, b in enumerate(blocks)]
    assert damaged(raw, b"".join) == (blocks, [])

    def flip(r):
        bad = bytearray(r[2])
        bad[len(bad) // 2] ^= 255
        return b"".join([*r[:2], bytes(bad), *r[3:]])

    got, gaps = damaged(raw, flip)
    assert got == blocks[:2] + blocks[3:] and len(gaps) == 1 and gaps[0][3]["reason"]
    got, gaps = damaged(raw, lambda r: b"junk" + b"".join(r)[: -len(r[-1]) // 2])
    assert got == blocks[:5] and len(gaps) == 2
    got, gaps = damaged(raw, lambda r: b"".join([*r[:3], r[3][:40], *r[4:]]))
    assert got == blocks[:3] + blocks[4:] and len(gaps) == 1
    assert damaged([], lambda r: b"\0" * 3_000_000)[0] == []


def test_members_with_several_records():
    blocks = [os.urandom(40 + k) for k in range(6)]
    raw = [warc.record(k, "u", b, warc.base32_sha1(b), None) for k, b in enumerate(blocks)]
    one = warc.member(raw[0] + raw[1])
    got, gaps = damaged([one, warc.member(raw[2])], b"".join)
    assert got == blocks[:3] and gaps == []
    wrong = raw[3].replace(blocks[3], os.urandom(len(blocks[3])))  # the gzip check passes, the block digest does not
    got, gaps = damaged([warc.member(raw[2] + wrong + raw[4]), warc.member(raw[5] + wrong)], b"".join)
    assert got == [blocks[2], blocks[4], blocks[5]]
    assert [(g[3]["reason"], g[3]["member-start"], g[3]["member-end"]) for g in gaps] == [
        ("block digest", str(len(raw[2])), str(len(raw[2]) + len(wrong))),
        ("block digest", str(len(raw[5])), str(len(raw[5]) + len(wrong))),
    ]
    got, gaps = damaged([warc.member(wrong), warc.member(b""), warc.member(raw[0])], b"".join)
    assert got == blocks[:1] and len(gaps) == 1


def test_a_member_that_inflates_beyond_the_limit_is_a_gap():
    small, large = b"x" * 100, b"y" * 100_000
    raw = [warc.member(warc.record(k, "u", b, warc.base32_sha1(b), None)) for k, b in enumerate((small, large, small))]
    data = b"".join(raw)
    found = list(warc.salvage(pa.BufferReader(data), len(data), limit=5000))
    assert [(r[0], r[4]) for r in found] == [("record", small), ("gap", b""), ("record", small)]
    assert found[1][1:3] == (len(raw[0]), len(raw[0]) + len(raw[1])) and "limit" in found[1][3]["reason"]


@pytest.mark.parametrize("pack", [warc.member, lambda raw: raw])
def test_damage_costs_no_more_than_reading(pack):
    """Bytes read from a file half of whose records are damaged grow with the file, not with its square."""

    class Counted:
        def __init__(self, data):
            self.data, self.read = data, 0

        def read_at(self, n, at):
            self.read += n
            return self.data[at : at + n]

    for n in (200, 1600):
        parts = []
        for k in range(n):
            block = os.urandom(6000)
            r = bytearray(pack(warc.record(k, "u", block, warc.base32_sha1(block), None)))
            if k % 2:
                r[len(r) // 2] ^= 255
            parts.append(bytes(r))
        data = b"".join(parts)
        f = Counted(data)
        kinds = [r[0] for r in warc.salvage(f, len(data))]
        assert kinds.count("record") == n // 2
        assert f.read < 4 * max(len(data), warc.CHUNK)


def test_damaged_archives_through_spark(spark):
    """Files are damaged between writing and reading: the rest comes back, and the log names every lost byte."""
    pages = spark.createDataFrame([(i, f"http://{i}", f"page {i} " * 50) for i in range(60)], "page_id long, url string, html string").coalesce(2)
    files = warc.write_archives(pages)
    lost, junk = 0, b"\x1f\x8b\x08 no member WARC/1.1 no record"
    for r in files.collect():
        local = r.path.removeprefix("file:")
        with open(local, "rb") as f:
            data = f.read()
        cut = len(data) // 2
        with open(local, "wb") as f:
            f.write(data[:cut] + junk + data[cut + 10 :])
        lost += 1
    records = warc.read_archives(files, blocks=False).cache()
    ids = [r.page_id for r in warc.page_rows(records).collect()]
    assert len(ids) == len(set(ids)) == 60 - lost
    log = warc.quarantine(records).collect()
    assert len(log) == lost and all(g.end - g.start > len(junk) and g.reason for g in log)
    whole = warc.page_rows(warc.read_archives(files)).collect()
    assert sorted(map(str, whole)) == sorted(map(str, warc.page_rows(records).collect()))
