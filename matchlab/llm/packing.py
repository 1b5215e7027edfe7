"""Documents packed into sequences of equal length and like attention cost.

Every map task packs its own documents, window by window, so nothing is shuffled, no group can grow with the data, and
a lost task is simply done again with the same result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlab.llm import textkit
from matchlab.llm.tokenfile import PieceTokenizer

#: Tokens that a task packs together; its memory is a few dozen bytes a token.
WINDOW = 1 << 20
#: Distinct pieces that a tokenizer remembers, and how many it encodes at a time; both only bound memory.
REMEMBER, AT_ONCE = 400_000, 4096
#: Bytes of text that are encoded together.
SLICE = 1 << 20
#: Model width of the cost estimate: a document of n tokens costs 6 * WIDTH * n for the layers and n * n for attention.
WIDTH = 768

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20)]] = True
_tokenizers: dict[str, "ByteTokenizer"] = {}


class ByteTokenizer(PieceTokenizer):
    """Ids of texts by a byte-level tokenizer that keeps white space, each distinct piece encoded once.

    A piece begins at a single space between two bytes that are not ASCII white space. The splitting of byte-level
    tokenizers always starts a new token there, and what comes before looks no further, so the ids of a text are those
    of its pieces end to end (a test compares both).
    """

    def __init__(self, path: str, remember: int = REMEMBER):
        super().__init__(path, remember)

    def forget(self) -> None:
        super().forget()
        self.hits = np.zeros(0, np.int64)

    def _thin(self) -> None:
        """Keep the half of the pieces that was met in most batches."""
        rank = np.argsort(-self.hits[self.place], kind="stable")[: self.remember // 2]
        kept = np.sort(rank)
        self.keys, old = self.keys[kept], self.place[kept]
        count = self.first[old + 1] - self.first[old]
        stop = np.cumsum(count)
        total = int(stop[-1]) if len(stop) else 0
        self.flat = self.flat[np.arange(total) + np.repeat(self.first[old] - (stop - count), count)]
        self.first, self.place, self.hits = np.concatenate([[0], stop]), np.arange(len(kept)), self.hits[old]

    def _learn(self, data: np.ndarray, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        raw, flat, counts = data.tobytes(), [self.flat], []
        for k in range(0, len(keys), AT_ONCE):
            pieces = [raw[s:e].decode("utf-8", "replace") for s, e in zip(starts[k : k + AT_ONCE].tolist(), ends[k : k + AT_ONCE].tolist())]
            ids = [x.ids for x in self.library.encode_batch_fast(pieces, add_special_tokens=False)]
            counts.append(np.fromiter(map(len, ids), np.int64, len(ids)))
            flat.append(np.fromiter((i for x in ids for i in x), self.flat.dtype, int(counts[-1].sum())))
        count = np.concatenate(counts)
        place = np.arange(len(self.first) - 1, len(self.first) - 1 + len(count))
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(count)])
        self.flat = np.concatenate(flat)
        self.hits = np.concatenate([self.hits, np.zeros(len(count), np.int64)])
        at = np.searchsorted(self.keys, keys)
        self.keys, self.place = np.insert(self.keys, at, keys), np.insert(self.place, at, place)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, and the index of each row's first id."""
        edge = np.zeros(len(data) + 1, bool)
        if len(data) > 2:
            blank = _SPACE[data]
            edge[1:-2] = (data[1:-1] == 0x20) & ~blank[:-2] & ~blank[2:]
        edge[offsets] = True
        cuts = np.flatnonzero(edge)
        starts, ends = cuts[:-1], cuts[1:]
        first = np.searchsorted(starts, offsets)
        hashes = textkit.hash_spans(data, starts, ends)
        keys, where, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) > self.remember:
            self._thin()
        at = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        inside = at < len(self.keys)
        new[inside] = self.keys[at[inside]] != keys[inside]
        if new.any():
            self._learn(data, keys[new], starts[where[new]], ends[where[new]])
            at = np.searchsorted(self.keys, keys)
        place = self.place[at]
        self.hits[place] += 1
        place = place[back]
        count = self.first[place + 1] - self.first[place]
        stop = np.cumsum(count)
        index = np.arange(int(stop[-1]) if len(stop) else 0) + np.repeat(self.first[place] - (stop - count), count)
        return self.flat[index], np.concatenate([[0], stop])[first]


def _tokenizer(path: str) -> ByteTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = ByteTokenizer(path)
    return _tokenizers[path]


def cost(tokens, width: int = WIDTH):
    """Estimated cost of attending over a run of tokens: linear in the layers, quadratic in attention. Whole numbers."""
    return 6 * width * tokens + tokens * tokens


def capacities(total: int, length: int) -> np.ndarray:
    """Lengths of the sequences that hold `total` tokens without padding: full ones, then powers of two for the rest."""
    rest = total % length
    tail = [1 << b for b in reversed(range(length.bit_length())) if rest >> b & 1]
    return np.array([length] * (total // length) + tail, np.int64)


def packed(sizes: np.ndarray, length: int, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(pieces, capacities): rows of document, start, length, sequence, offset, in the order in which they were placed.

    Runs of `length` tokens fill a sequence each; what remains of the documents is placed by descending size, each into
    the sequence of lowest cost that has room for it. Where none has, it is cut: the sequence of lowest cost that is not
    full takes what it holds, and the rest goes on in the same way. Ties go to the document that comes first and the smaller sequence.
    """
    whole = sizes // length
    full = int(whole.sum())
    doc = np.repeat(np.arange(len(sizes)), whole)
    start = (np.arange(full) - np.repeat(np.cumsum(whole) - whole, whole)) * length
    blocks = np.column_stack([doc, start, np.full(full, length), np.arange(full), np.zeros(full, np.int64)]).astype(np.int64)
    left = sizes - whole * length
    room = capacities(int(left.sum()), length)
    size, spent, used = room.copy(), np.zeros(len(room), np.int64), np.zeros(len(room), np.int64)
    never = np.iinfo(np.int64).max
    pieces = []
    for d in np.argsort(-left, kind="stable").tolist():
        n, at = int(left[d]), int(whole[d]) * length
        while n:
            fits = room >= n
            j = int(np.argmin(np.where(fits if fits.any() else room > 0, spent, never)))
            take = min(n, int(room[j]))
            pieces.append((d, at, take, full + j, int(used[j])))
            room[j] -= take
            used[j] += take
            spent[j] += cost(take, width)
            n, at = n - take, at + take
    rows = np.array(pieces, np.int64).reshape(-1, 5)
    return np.concatenate([blocks, rows]), np.concatenate([np.full(full, length), size])


def pack(docs: DataFrame, vocabulary: str, end_id: int, length: int = 1024, width: int = WIDTH, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", payload: bool = True) -> DataFrame:
    """One row per piece: id, start (the document's ids before it), length, ids_crc32, doc_tokens, sequence_id, offset, capacity, sequence_cost, ids.

    A document is its text's ids by the byte-level tokenizer and end_id. A task gathers documents up to `window` tokens,
    packs them (see packed) and goes on; sequences hold `length` tokens and, once a window, powers of two below it, all
    without padding. capacity is the length of the sequence, sequence_cost the estimated cost of its pieces, and
    ids the piece's ids as little-endian unsigned 32-bit integers (left out without `payload`), of which ids_crc32 is the crc32. sequence_id is unique: task number * 2**32 and a count.

    A null or empty text is its end_id alone. Ids are carried as they are, nulls and repeats included; every row is a
    document of its own. A very long text is held whole by its task. Equal sizes go by row order. An empty table gives
    no rows; other columns are ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "capacity", "sequence_cost"]

    def write(batches):
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        n = 0
        base = TaskContext.get().partitionId() << 32
        for b in batches:
            for i, j, data, offsets in textkit.slices(b.column(1), SLICE):
                ids, first = _tokenizer(vocabulary).encode(data, offsets)
                ids = np.insert(ids, first[1:], end_id)
                first = first + np.arange(len(first))
                held.append((b.column(0).slice(i, j - i), ids, first))
                n += len(ids)
                if n >= window:
                    base, out = flush(held, base)
                    yield from out
                    held, n = [], 0
        if held:
            yield from flush(held, base)[1]

    def flush(held, base: int) -> tuple[int, Iterator[pa.RecordBatch]]:
        ids = np.concatenate([x for _, x, _ in held]).astype("<u4")
        sizes = np.concatenate([np.diff(f) for _, _, f in held])
        begin = np.cumsum(sizes) - sizes
        rows, room = packed(sizes, length, width)
        doc, start, size, sequence, offset = rows.T
        spent = np.zeros(len(room), np.int64)
        np.add.at(spent, sequence, cost(size, width))
        id_column = pa.concat_arrays([x for x, _, _ in held])
        raw = memoryview(ids.tobytes())

        def batches(step: int = 512):
            for s in range(0, len(rows), step):
                k = slice(s, s + step)
                at = 4 * (begin[doc[k]] + start[k])
                pieces = [raw[a:e] for a, e in zip(at.tolist(), (at + 4 * size[k]).tolist())]
                columns = [start[k], size[k], [zlib.crc32(p) for p in pieces], sizes[doc[k]], base + sequence[k], offset[k], room[sequence[k]], spent[sequence[k]]]
                arrays = [id_column.take(pa.array(doc[k])), *(pa.array(c, pa.int64()) for c in columns)]
                yield pa.RecordBatch.from_arrays(arrays + [pa.array(pieces, pa.binary())], names=[*names, "ids"]) if payload else pa.RecordBatch.from_arrays(arrays, names=names)

        return base + len(room), batches()

    rows = own.mapInArrow(write, f"id {kind}, " + ", ".join(f"{c} long" for c in names[1:]) + (", ids binary" if payload else ""))
    return rows.withColumnRenamed("id", id_col)
