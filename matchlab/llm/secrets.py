"""Secrets in texts, judged by how many owners share a value."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlab.llm import textkit
from matchlab.llm.storage import store

#: Fixed patterns of the three base kinds, in their order; and the least length of what must be long.
KINDS = ("assign", "access", "hex", "live")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
#: A value outside any base match: a long run that holds a digit and a letter.
BARE = re.compile(r"[A-Za-z0-9_+=-]{20,}")
#: Words that mark a value as a stand-in.
PLACEHOLDERS = ("example", "sample", "dummy", "changeme", "placeholder", "your", "xxxx", "test", "1234")

_IS_HEX = np.zeros(256, bool)
_IS_HEX[[*range(0x30, 0x3A), *range(0x61, 0x67)]] = True
_IS_BARE = np.zeros(256, bool)
_IS_BARE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *b"_+=-"]] = True
#: A plain filter for texts that may hold an assignment; the pattern itself decides.
_MAYBE = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]"""


def looks_live(value: str) -> bool:
    """Long enough, varied enough (3 bits a character) and no stand-in word."""
    if len(value) < 16 or any(p in value.lower() for p in PLACEHOLDERS):
        return False
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) >= 3.0


def find(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, str]]]:
    """Base spans (start, kind, end) in order, and candidate values (start, end, value), each place once."""
    spans, values = [], {}
    for kind, pattern, group in ((0, ASSIGN, 2), (1, ACCESS, 0), (2, HEX, 0)):
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= LEAST[KINDS[kind]]:
                spans.append((m.start(), kind, m.end()))
                values[m.span(group)] = m.group(group)
    taken = sorted(values)
    ends = 0
    merged = []
    for s, e in taken:  # union of the base values, to keep bare runs apart
        if s < ends:
            merged[-1] = (merged[-1][0], max(ends, e))
        else:
            merged.append((s, e))
        ends = merged[-1][1]
    k = 0
    for m in BARE.finditer(text):
        while k < len(merged) and merged[k][1] <= m.start():
            k += 1
        if (k == len(merged) or merged[k][0] >= m.end()) and re.search("[0-9]", m.group()) and re.search("[A-Za-z]", m.group()):
            values[m.span()] = m.group()
    return sorted(spans), [(s, e, values[s, e]) for s, e in sorted(values)]


def _runs(data: np.ndarray, offsets: np.ndarray, members: np.ndarray, least: int) -> np.ndarray:
    """Rows that hold a run of at least so many of these bytes."""
    starts, ends, first = textkit.words(data, offsets, ~members)
    long = np.flatnonzero(ends - starts >= least)
    return np.searchsorted(first, long, "right") - 1


def _rows_to_read(column: pa.Array) -> np.ndarray:
    """Rows that may hold a span: a superset, found on the bytes."""
    maybe = np.zeros(len(column), bool)
    for i, j, data, offsets in textkit.slices(column):
        maybe[i + _runs(data, offsets, _IS_HEX, LEAST["hex"])] = True
        maybe[i + _runs(data, offsets, _IS_BARE, 20)] = True
    maybe |= pc.fill_null(pc.match_substring_regex(column, _MAYBE), False).to_numpy(zero_copy_only=False)
    return np.flatnonzero(maybe)


def scan(docs: DataFrame, id_col: str, text_col: str, owner: F.col, repo: F.col) -> DataFrame:
    """Per row: id, owner, repo, base spans and candidate values (hash only); a stored table with a row number."""
    own = docs.select(F.col(id_col).cast("long").alias("id"), owner.cast("string").alias("owner"), repo.cast("string").alias("repo"), F.col(text_col).alias("text"))
    span = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
    value = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("digest", pa.string()), ("live_looking", pa.bool_())])

    def read(batches):
        for b in batches:
            spans, values = [[]] * b.num_rows, [[]] * b.num_rows
            text = b.column(3)
            for k in _rows_to_read(text).tolist():
                found, held = find(text[k].as_py())
                spans[k] = [dict(start=s, kind=kind, end=e) for s, kind, e in found]
                values[k] = [dict(start=s, end=e, digest=hashlib.sha256(v.encode()).hexdigest(), live_looking=looks_live(v)) for s, e, v in held]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(spans, pa.list_(span)), pa.array(values, pa.list_(value))], names=["id", "owner", "repo", "spans", "vals"])

    s = "array<struct<start:long,kind:int,end:long>>"
    v = "array<struct<start:long,end:long,digest:string,live_looking:boolean>>"
    found = own.mapInArrow(read, f"id long, owner string, repo string, spans {s}, vals {v}")
    return store(found.withColumn("row", F.monotonically_increasing_id()), "secrets")


def ownership(found: DataFrame) -> DataFrame:
    """Per candidate value: digest, n_owners, n_repos, n_places over the whole corpus.

    Copies within one owner and repository are counted together before the shuffle, so a value that a third of all
    rows hold is a few rows per task. A null owner or repository is one of its own.
    """
    known = found.select(F.explode("vals").alias("v"), F.coalesce("owner", F.lit("\0")).alias("owner"), F.coalesce("repo", F.lit("\0")).alias("repo"))
    per_repo = known.groupBy(F.col("v.digest").alias("digest"), "owner", "repo").agg(F.count("*").alias("n"))
    per_owner = per_repo.groupBy("digest", "owner").agg(F.sum("n").alias("n"), F.count("*").alias("repos"))
    return per_owner.groupBy("digest").agg(F.count("*").alias("n_owners"), F.sum("repos").alias("n_repos"), F.sum("n").alias("n_places"))


def secret_spans(docs: DataFrame, owner: F.col, repo: F.col, id_col: str = "doc_id", text_col: str = "text", max_owners: int = 1, max_repos: int = 2) -> DataFrame:
    """Per row: id, spans (start, kind, end in code points, ordered by start and kind), n_live and n_copied.

    Kinds 0 to 2 are the base patterns. Kind 3, "live", is added for each candidate value (the value part of a base
    match, or a bare long run) that looks live and that at most max_owners owners and max_repos of their
    repositories share; values that more hold are examples that were copied and count in n_copied.

    Null and empty texts have no spans. Null ids, owners and repositories are kept and count as one value each. Repeated rows are
    reported each and count as one repository. Extra columns are ignored. An empty table gives no rows.
    """
    found = scan(docs, id_col, text_col, owner, repo)
    places = found.select("row", F.explode("vals").alias("v")).select("row", "v.*")
    judged = places.join(ownership(found), "digest").withColumn(
        "live", F.col("live_looking") & (F.col("n_owners") <= max_owners) & (F.col("n_repos") <= max_repos)
    )
    added = judged.groupBy("row").agg(
        F.collect_list(F.when(F.col("live"), F.struct("start", F.lit(3).alias("kind"), "end"))).alias("added"),
        F.sum(F.col("live").cast("long")).alias("n_live"),
        F.sum(((F.col("n_owners") > max_owners) | (F.col("n_repos") > max_repos)).cast("long")).alias("n_copied"),
    )
    none = F.array().cast("array<struct<start:long,kind:int,end:long>>")
    return found.join(added, "row", "left").select(
        F.col("id").alias(id_col),
        F.array_sort(F.concat("spans", F.coalesce("added", none))).alias("spans"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"),
        F.coalesce("n_copied", F.lit(0)).alias("n_copied"),
    )


def joined(spans: F.col) -> F.col:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")
