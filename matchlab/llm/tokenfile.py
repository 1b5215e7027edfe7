"""Token ids in Arrow files of equal-length sequences with masks, for random access without copies."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchlab.llm import textkit
from matchlab.llm.storage import filesystem, put, shared_folder, store

#: A character with an id of its own that stands after each piece of a line, and pieces of a line; a call of the library costs more than a short piece.
MARK, LINE = "\x01", 64

#: Pieces are also cut between letters (ASCII, Latin-1) or ASCII digits and these, where the tokenizer does so itself.
STOPS = ".,;:!?#*$%&"
_KIND = np.zeros(256, np.uint8)
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123)]] = 1
_KIND[list(STOPS.encode())] = 2
#: Second bytes after 0xC3 that make a letter.
_LATIN = np.zeros(256, bool)
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False
#: Letters that lower-casing and composing leave apart from each other, so that a piece of them is one run of letters.
LETTERS = "".join(c for c in map(chr, range(0x41, 0x100)) if c.isalpha() and c not in "ªµº")
_LOW = np.zeros(256, bool)
_LOW[97:123] = True

_tokenizers: dict[str, "PieceTokenizer"] = {}


def _letters(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to a letter of Latin-1 beyond ASCII."""
    lead = np.flatnonzero(data[:-1] == 0xC3)
    lead = lead[_LATIN[data[lead + 1]]]
    out = np.zeros(len(data), bool)
    out[lead] = out[lead + 1] = True
    return out


def spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, tail: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the spans end to end, `tail` after each, and where each ends."""
    size = ends - starts + len(tail)
    stop = np.cumsum(size)
    out = data[np.minimum(np.arange(stop[-1]) + np.repeat(starts - (stop - size), size), len(data) - 1)]
    for k, x in enumerate(tail):
        out[stop - len(tail) + k] = x
    return out, stop


class PieceTokenizer:
    """Ids of texts by a tokenizer that drops white space between pieces, each distinct piece encoded once.

    Texts are cut at bytes of white space, and between letters and stops where the tokenizer always splits there; a piece
    then gets what the library gives for it, so the ids of a text are those of the library for the whole text. That holds
    for tokenizers whose normaliser and splitting never look across white space and drop it (a test compares both). Where
    the normaliser lower-cases, pieces are lower-cased first. Pieces of LETTERS alone, which normaliser and splitting leave
    whole, go to the library's model without them. The memory of pieces is bounded and only saves time.
    """

    def __init__(self, path: str, remember: int = 1_500_000):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.library = Tokenizer.from_file(path)
        self.remember = remember
        ids = lambda x: self.library.encode(x, add_special_tokens=False).ids
        mark, a = ids(MARK), ids("a")
        self.mark = mark[0] if len(mark) == 1 and ids(f"a {MARK} a") == a + mark + a else None
        self.added = [x.content.lower().encode() for x in self.library.get_added_tokens_decoder().values()]
        self.lowers = self.library.normalizer is not None and self.library.normalizer.normalize_str("AMZ") == "amz"
        self.cuts = not any(c in x.decode() for x in self.added for c in STOPS) and all(ids(f"ab{c}1{c}é{c}b") == ids("ab") + ids(c) + ids("1") + ids(c) + ids("é") + ids(c) + ids("b") for c in STOPS)
        self.plain = self._plain(Tokenizer.from_file(path))
        self.forget()
        self.words = self.no_words()

    def _plain(self, library):
        """The library without its normaliser and splitting, and how LETTERS and MARK are spelled for it; None where that is not the same."""
        from tokenizers import pre_tokenizers

        if self.mark is None or not self.lowers or self.library.pre_tokenizer is None or any(set(x.decode()) <= set(LETTERS) for x in self.added):
            return None
        spelled = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        spell = {ord(c): spelled(c.lower())[0][0] for c in LETTERS + MARK}
        library.normalizer, library.pre_tokenizer = None, pre_tokenizers.WhitespaceSplit()
        low = self.library.normalizer.normalize_str(LETTERS)
        whole = [x for x, _ in self.library.pre_tokenizer.pre_tokenize_str(low)] == [LETTERS.translate(spell)]
        same = library.encode(f"{LETTERS} {MARK} a".translate(spell), add_special_tokens=False).ids == self.library.encode(f"{LETTERS} {MARK} a", add_special_tokens=False).ids
        return (library, spell) if low == LETTERS.lower() and whole and same else None

    def forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.place = np.zeros(0, np.int64)
        self.first = np.zeros(1, np.int64)
        self.flat = np.zeros(0, np.uint16 if self.library.get_vocab_size() <= 1 << 16 else np.uint32)

    def _learn(self, data: np.ndarray, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        inside = lambda x: (lambda t: t[ends] - t[starts])(np.concatenate([[0], np.cumsum(x, dtype=np.int32)]))
        way = np.full(len(keys), 2 if self.mark is not None else 3, np.int8)  # plain as it is, plain but spelled otherwise, between marks, alone
        if self.plain:
            high = _letters(data)
            way[inside(~(high | _LOW[data])) == 0] = 1
            way[inside(~_LOW[data]) == 0] = 0
        way[inside(data == ord(MARK)) > 0] = 3
        order, stops = np.argsort(way, kind="stable"), np.cumsum(np.bincount(way, minlength=4))
        library, spell = self.plain or (None, {ord(MARK): MARK})
        flat, counts = [self.flat], []
        for at, to, library, spelled in ((0, stops[0], library, lambda x: x.replace(MARK, spell[ord(MARK)])), (stops[0], stops[1], library, lambda x: x.translate(spell)), (stops[1], stops[2], self.library, str)):
            for k in range(at, to, LINE * LINE):
                part = order[k : min(to, k + LINE * LINE)]
                text, stop = spans(data, starts[part], ends[part], f" {MARK} ".encode())
                text[stop[LINE - 1 : -1 : LINE] - 1] = 0x0A
                lines = [spelled(x) for x in text.tobytes().decode("utf-8", "replace").split("\n")]
                ids = np.concatenate([np.array(x.ids, np.int64) for x in library.encode_batch_fast(lines, add_special_tokens=False)])
                stop = np.flatnonzero(ids == self.mark)
                counts.append(np.diff(stop, prepend=-1) - 1)
                flat.append(np.delete(ids, stop).astype(self.flat.dtype))
        raw = data.tobytes() if stops[2] < len(keys) else b""
        for k in range(stops[2], len(keys), LINE * LINE):
            part = order[k : k + LINE * LINE]
            pieces = [raw[s:e].decode("utf-8", "replace") for s, e in zip(starts[part].tolist(), ends[part].tolist())]
            ids = [x.ids for x in self.library.encode_batch_fast(pieces, add_special_tokens=False)]
            counts.append(np.fromiter(map(len, ids), np.int64, len(ids)))
            flat.append(np.fromiter((i for x in ids for i in x), self.flat.dtype, int(counts[-1].sum())))
        count, place = np.concatenate(counts), np.empty(len(keys), np.int64)
        place[order] = np.arange(len(self.first) - 1, len(self.first) - 1 + len(keys))
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(count)])
        self.flat = np.concatenate(flat)
        at = np.searchsorted(self.keys, keys)
        self.keys, self.place = np.insert(self.keys, at, keys), np.insert(self.place, at, place)

    def _pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the pieces, and the index of each row's first."""
        starts, ends, first = textkit.words(data, offsets)
        if not self.cuts or not len(starts):
            return starts, ends, first
        kind = _KIND[data]
        kind[_letters(data)] = 1
        new = np.flatnonzero(kind[1:] ^ kind[:-1] == 3) + 1
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        new = new[~edge[new]]
        starts, ends = np.sort(np.concatenate([starts, new])), np.sort(np.concatenate([ends, new]))
        return starts, ends, np.searchsorted(starts, offsets)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, and the index of each row's first id."""
        if self.lowers:
            low = textkit.LOWER[data]
            raw = low.tobytes()
            data = data if any(x in raw for x in self.added) else low  # an added token is matched as it is written
        starts, ends, first = self._pieces(data, offsets)
        hashes = textkit.hash_spans(data, starts, ends)
        keys, where, back = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, keys)
        known = (at < len(self.keys)) & (self.keys[np.minimum(at, max(0, len(self.keys) - 1))] == keys) if len(self.keys) else np.zeros(len(keys), bool)
        if not known.all():
            if len(self.keys) > self.remember:
                self.forget()
                known[:] = False
            new = ~known
            self._learn(data, keys[new], starts[where[new]], ends[where[new]])
            at = np.searchsorted(self.keys, keys)
        place = self.place[at][back] if len(keys) else np.zeros(0, np.int64)
        count = self.first[place + 1] - self.first[place]
        stop = np.cumsum(count)
        total = int(stop[-1]) if len(stop) else 0
        index = np.arange(total) + np.repeat(self.first[place] - (stop - count), count)
        return self.flat[index], np.concatenate([[0], stop])[first]

    def encode_words(self, data: np.ndarray, offsets: np.ndarray, found: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
        """What encode gives, from textkit.distinct_words: each distinct word is cut into pieces once, and remembered like a piece."""
        low, starts, ends, first, code, hashes, where = found
        raw = low.tobytes()
        if not self.lowers or not len(where) or any(x in raw for x in self.added):
            return self.encode(data, offsets)
        order = np.argsort(hashes)
        keys = hashes[order]
        held, place, begin, flat = self.words
        at = np.minimum(np.searchsorted(held, keys), max(0, len(held) - 1))
        known = held[at] == keys if len(held) else np.zeros(len(keys), bool)
        if not known.all():
            if len(held) > self.remember:
                held, place, begin, flat = self.no_words()
                known[:] = False
            new = where[order[~known]]
            text, stop = spans(low, starts[new], ends[new], b" ")
            ids, to = self.encode(text, np.concatenate([[0], stop]))
            at = np.searchsorted(held, keys[~known])
            held, place = np.insert(held, at, keys[~known]), np.insert(place, at, np.arange(len(begin) - 1, len(begin) - 1 + len(new)))
            begin, flat = np.concatenate([begin, begin[-1] + to[1:]]), np.concatenate([flat, ids])
            self.words = held, place, begin, flat
            at = np.searchsorted(held, keys)
        of = np.empty(len(keys), np.int64)
        of[order] = place[at]
        size = (begin[of + 1] - begin[of])[code]
        stop = np.cumsum(size)
        return flat[np.arange(stop[-1]) + np.repeat(begin[of][code] - (stop - size), size)], np.concatenate([[0], stop])[first]

    def no_words(self) -> tuple[np.ndarray, ...]:
        """No words yet: hashes in order, the place of each, where the ids of each place begin, and the ids."""
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(0, self.flat.dtype)


def tokenizer(path: str) -> PieceTokenizer:
    """One per Python worker and file."""
    if path not in _tokenizers:
        _tokenizers[path] = PieceTokenizer(path)
    return _tokenizers[path]


def encode_batch(column: pa.Array, path: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, ids, index of each row's first id) slice by slice."""
    for i, j, data, offsets in textkit.slices(column):
        yield i, j, *tokenizer(path).encode(data, offsets)


def file_schema(length: int, ids: pa.DataType) -> pa.Schema:
    """ids and mask (true for tokens, false for padding) are of one length; doc_ids and starts list the documents that begin in a sequence and where."""
    return pa.schema([("ids", pa.list_(ids, length)), ("mask", pa.list_(pa.bool_(), length)), ("doc_ids", pa.list_(pa.int64())), ("starts", pa.list_(pa.int32()))])


class _Packer:
    """Collects documents and gives record batches of full sequences."""

    def __init__(self, length: int, ids: pa.DataType, rows: int = 512):
        self.length, self.schema, self.block = length, file_schema(length, ids), length * rows
        self.ids, self.docs, self.at, self.held = [], [], [], 0

    def add(self, ids: np.ndarray, first: np.ndarray, docs: list) -> Iterator[pa.RecordBatch]:
        self.ids.append(ids)
        self.docs += docs
        self.at.append(first[:-1] + self.held)
        self.held += len(ids)
        if self.held >= self.block:
            yield self.take(self.held // self.length * self.length)

    def take(self, n: int) -> pa.RecordBatch:
        """The first n held tokens as a batch; beyond what is held, padding."""
        ids, at = np.concatenate(self.ids), np.concatenate(self.at)
        mask = np.arange(n) < len(ids)
        if n > len(ids):
            ids = np.pad(ids, (0, n - len(ids)))
        starts = pa.array(np.searchsorted(at, np.arange(0, n + 1, self.length)), pa.int32())
        k = starts[-1].as_py()
        batch = pa.RecordBatch.from_arrays(
            [
                pa.FixedSizeListArray.from_arrays(pa.array(ids[:n]), self.length),
                pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length),
                pa.ListArray.from_arrays(starts, pa.array(self.docs[:k], pa.int64())),
                pa.ListArray.from_arrays(starts, pa.array(at[:k] % self.length, pa.int32())),
            ],
            schema=self.schema,
        )
        self.ids, self.docs, self.at, self.held = [ids[n:]], self.docs[k:], [at[k:] - n], max(0, self.held - n)
        return batch


def write_token_files(docs: DataFrame, vocabulary: str, end_id: int, length: int = 1024, id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None) -> DataFrame:
    """Encode every text, append end_id, and write the ids in ascending id order; returns the files (a stored table).

    Rows are dealt to range partitions by id and sorted there; each partition becomes one Arrow file, so `part`
    orders the files. A file holds batches of fixed-size lists: ids (the smallest unsigned type for the
    vocabulary) and their mask, with the ids and places of the documents that begin in each sequence
    (file_schema). Only the last sequence of a file is padded. Documents do not span files.

    A null text is an empty one and is written as its end id. A null id is written as null and sorts first.
    Equal ids are ordered by text; repeated rows are all written. An empty table gives no files. Extra columns are ignored.
    """
    folder = shared_folder(docs.sparkSession, "tokens")
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    key = [F.col("id"), F.crc32(F.col("text").cast("binary"))]
    dealt = own.repartitionByRange(partitions, *key) if partitions else own.repartitionByRange(*key)

    def write(batches):
        packer = sink = out = None
        name, n_docs, n_tokens = f"{uuid.uuid4().hex}.arrow", 0, 0
        for b in batches:
            column = b.column(0).to_pylist()
            for i, j, ids, first in encode_batch(b.column(1), vocabulary):
                if packer is None:
                    packer = _Packer(length, pa.from_numpy_dtype(ids.dtype))
                    sink = put(folder, name)
                    out = pa.ipc.new_file(sink, packer.schema)
                ids = np.insert(ids, first[1:], end_id)
                first = first + np.arange(len(first))
                n_docs, n_tokens = n_docs + j - i, n_tokens + len(ids)
                for batch in packer.add(ids, first, column[i:j]):
                    out.write_batch(batch)
        if packer:
            if packer.held:
                out.write_batch(packer.take(-(-packer.held // length) * length))
            out.close()
            sink.close()
            yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()], "path": [f"{folder}/{name}"], "docs": [n_docs], "tokens": [n_tokens]}, pa.schema([("part", pa.int32()), ("path", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64())]))

    return store(dealt.sortWithinPartitions("id", "text").mapInArrow(write, "part int, path string, docs long, tokens long"), "token-files")


def open_tokens(uri: str):
    """A reader of one file: get_batch(k) maps batch k without reading the ones before; local files are memory-mapped."""
    fs, path = filesystem(uri)
    source = pa.memory_map(path) if fs.type_name == "local" else fs.open_input_file(path)
    return pa.ipc.open_file(source)


def documents_in(reader) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(document ids, their token ids end to end, index of each one's first token), batch by batch; a document cut by a batch's end comes with the next."""
    names, rest = [], np.zeros(0, np.uint32)
    for k in range(reader.num_record_batches):
        b = reader.get_batch(k)
        ids, mask = (b.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("ids", "mask"))
        names += b.column("doc_ids").flatten().to_pylist()
        row = np.repeat(np.arange(b.num_rows), np.diff(b.column("starts").offsets.to_numpy()))
        at = row * (len(ids) // max(1, b.num_rows)) + b.column("starts").flatten().to_numpy() + len(rest)
        if len(rest):
            at = np.concatenate([[0], at])
        ids = np.concatenate([rest.astype(ids.dtype), ids[mask]])
        last = k == reader.num_record_batches - 1
        cut = len(ids) if last else int(at[-1])
        whole = len(at) if last else len(at) - 1
        yield names[:whole], ids[:cut], np.append(at[:whole], cut)
        names, rest = names[whole:], ids[cut:]


def read_token_files(files: DataFrame, digest: Callable[[np.ndarray], int]) -> DataFrame:
    """Per document of the files: part, place in the file, doc_id, n_tokens, ids_crc32 (of the ids as little-endian unsigned 32-bit integers) and local_start."""

    def read(batches):
        for b in batches:
            for part, uri in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                base = place = 0
                for names, ids, first in documents_in(open_tokens(uri)):
                    wide = ids.astype("<u4")
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([part] * len(names), pa.int32()),
                            pa.array(np.arange(place, place + len(names))),
                            pa.array(names, pa.int64()),
                            pa.array(np.diff(first)),
                            pa.array([digest(wide[s:e]) for s, e in zip(first[:-1].tolist(), first[1:].tolist())], pa.int64()),
                            pa.array(first[:-1] + base),
                        ],
                        names=["part", "place", "doc_id", "n_tokens", "ids_crc32", "local_start"],
                    )
                    base, place = base + len(ids), place + len(names)

    spread = files.select("part", "path").repartition(max(1, files.count()))  # a fixed number is not merged into fewer tasks
    return spread.mapInArrow(read, "part int, place long, doc_id long, n_tokens long, ids_crc32 long, local_start long")


def token_table(docs: DataFrame, vocabulary: str, end_id: int, **options) -> DataFrame:
    """Write the files, read them back: doc_id, start (ids of all documents before it), n_tokens with the end id, ids_crc32."""
    import zlib

    files = write_token_files(docs, vocabulary, end_id, **options)
    offsets = files.select("part", F.coalesce(F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    rows = read_token_files(files, lambda ids: zlib.crc32(ids.tobytes()))
    return rows.join(F.broadcast(offsets), "part").select(  # one row per file
        "doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"
    )
