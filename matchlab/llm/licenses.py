"""License notices in texts: exact phrases, and short notices with a bounded number of edits."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlab.llm import textkit

#: Fixed phrases and their labels.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

#: Short notices, in lower case, and their labels.
NOTICES = (
    ("released under the mit license", "mit"),
    ("permission is hereby granted, free of charge, to any person obtaining a copy", "mit"),
    ("licensed under the apache license, version 2.0", "apache-2"),
    ("licensed under cc by-nc 4.0", "cc-by-nc"),
    ("creative commons attribution-noncommercial", "cc-by-nc"),
    ("licensed under the gnu general public license, version 3", "gpl-3"),
    ("the terms of the gnu general public license", "gpl"),
    ("the terms of the gnu lesser general public license", "lgpl"),
    ("redistribution and use in source and binary forms, with or without modification", "bsd"),
    ("subject to the terms of the mozilla public license", "mpl"),
    ("all rights reserved", "all-rights-reserved"),
)

#: Length of text that is searched at once, in lengths of the notice.
WINDOW = 8

_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


@dataclass(frozen=True)
class Notice:
    """A notice and the edits it may have: one for every `per_edit` characters."""

    text: str
    label: str
    per_edit: int = 12

    @cached_property
    def edits(self) -> int:
        return len(self.text) // self.per_edit

    @cached_property
    def seeds(self) -> tuple[tuple[int, str], ...]:
        """edits + 1 pieces of nearly equal length: by the pigeonhole one of them is exact in every match."""
        n = self.edits + 1
        cuts = [len(self.text) * k // n for k in range(n + 1)]
        return tuple((a, self.text[a:b]) for a, b in zip(cuts, cuts[1:]))

    @cached_property
    def pattern(self):
        return regex.compile(f"(?b)(?:{regex.escape(self.text)}){{e<={self.edits}}}")

    def matches(self, text: str) -> list[tuple[int, int, int]]:
        """(start, end, edits) of the notice in a lower-cased text, without overlap, in order.

        Candidates that overlap are searched together up to WINDOW times the notice's length, so the work is linear in the text;
        the next window begins where its own first candidate does, so none is cut. In a window the match with the fewest edits
        comes first, then what is left of it and what is right.
        """
        size, near = len(self.text), []
        for at, seed in self.seeds:
            p = text.find(seed)
            while p >= 0:
                near.append((max(0, p - at - self.edits), min(len(text), p - at + size + self.edits)))
                p = text.find(seed, p + 1)
        found, stop, limit = [], 0, WINDOW * size
        near.sort()
        k = 0
        while k < len(near):
            begin, end = near[k]
            while k + 1 < len(near) and near[k + 1][0] < end and max(end, near[k + 1][1]) - begin <= limit:
                k += 1
                end = max(end, near[k][1])
            k += 1
            here = self._within(text, max(begin, stop), end)
            found += here
            stop = max([stop, *(e for _, e, _ in here)])
        return found

    def _within(self, text: str, begin: int, end: int) -> list[tuple[int, int, int]]:
        if end - begin < len(self.text) - self.edits or not (m := self.pattern.search(text, begin, end)):
            return []
        here = (m.start(), m.end(), sum(m.fuzzy_counts))
        return [*self._within(text, begin, m.start()), here, *self._within(text, m.end(), end)]


def _filter_pattern(notices: tuple[Notice, ...]) -> str:
    """Any seed of any notice, either case; a filter only."""
    return "(?i)" + "|".join(regex.escape(seed, literal_spaces=True) for seed in dict.fromkeys(s for n in notices for _, s in n.seeds))


def _phrase_places(hashes: np.ndarray, first: np.ndarray, phrases: list[np.ndarray]) -> list[np.ndarray]:
    """For each phrase the positions of the words that begin it within a row."""
    out = []
    for p in phrases:
        at = np.flatnonzero(hashes[: max(0, len(hashes) - len(p) + 1)] == p[0])
        for k in range(1, len(p)):
            at = at[hashes[at + k] == p[k]]
        row = np.searchsorted(first, at, "right") - 1
        out.append(at[at + len(p) <= first[row + 1]])
    return out


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=PHRASES, notices=NOTICES, per_edit: int = 12) -> DataFrame:
    """Per row: id, n_words, n_base, first_word, last_word, base_labels, labels, score and notice_spans.

    Phrases are runs of words (lower-cased runs of letters, digits and bytes beyond ASCII). Notices are searched in
    the text with A-Z lower-cased: edits + 1 exact seeds locate candidates and the regex library verifies the
    number of edits (insertions, deletions, substitutions) in each. notice_spans is label:start:end:edits in code
    points of the text, comma-joined. score is 1 for a phrase, 1 - edits / length for the best notice, else 0.

    Null and empty texts have no words, no labels and score 0. Null ids are kept. Repeated rows are reported each. Extra columns are
    ignored. An empty table gives no rows. Texts of any length are searched whole.
    """
    wanted = tuple(Notice(t, label, per_edit) for t, label in notices)
    maybe = _filter_pattern(wanted)
    named = [label for _, label in phrases]
    phrase_hashes = [textkit.hash_words(t, textkit.NOT_ALNUM) for t, _ in phrases]

    def read(batches):
        for b in batches:
            column = textkit.large_binary(b.column(1))
            n = b.num_rows
            n_words, n_base = np.zeros(n, np.int64), np.zeros(n, np.int64)
            low, high = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
            base: dict[int, set] = {}
            for i, j, data, offsets in textkit.slices(column):
                hashes, first = textkit.word_hashes(data, offsets, textkit.NOT_ALNUM)
                n_words[i:j] = np.diff(first)
                for label, at in zip(named, _phrase_places(hashes, first, phrase_hashes)):
                    row = np.searchsorted(first, at, "right") - 1
                    np.add.at(n_base, i + row, 1)
                    np.minimum.at(low, i + row, at - first[row])
                    np.maximum.at(high, i + row, at - first[row])
                    for k in set(row.tolist()):
                        base.setdefault(i + k, set()).add(label)
            flagged = np.flatnonzero(pc.fill_null(pc.match_substring_regex(b.column(1), maybe), False).to_numpy(zero_copy_only=False)).tolist()
            spans = {}
            for k in flagged:
                text = b.column(1)[k].as_py().translate(_LOWER)
                if found := sorted((s, e, x.label, d, len(x.text)) for x in wanted for s, e, d in x.matches(text)):
                    spans[k] = found
            labels, score, told = [""] * n, np.zeros(n), [""] * n
            for k in base.keys() | spans.keys():
                own = spans.get(k, [])
                labels[k] = ",".join(sorted(base.get(k, set()) | {x[2] for x in own}))
                score[k] = 1.0 if k in base else max(1 - x[3] / x[4] for x in own)
                told[k] = ",".join(f"{x[2]}:{x[0]}:{x[1]}:{x[3]}" for x in own)
            hit = n_base == 0
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    pa.array(n_words),
                    pa.array(n_base),
                    pa.array(low, mask=hit),
                    pa.array(high, mask=hit),
                    pa.array([",".join(sorted(base.get(k, ()))) for k in range(n)]),
                    pa.array(labels),
                    pa.array(score),
                    pa.array(told),
                ],
                names=["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "notice_spans"],
            )

    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = own.mapInArrow(read, "id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, notice_spans string")
    return rows.withColumnRenamed("id", id_col)
