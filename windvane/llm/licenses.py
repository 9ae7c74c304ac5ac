"""License notices in texts: exact phrases of words, and short notices with a bounded number of edits.

A notice with at most k edits holds one of its k + 1 pieces unchanged. All pieces of all notices are seeds of one
Aho-Corasick automaton; around every seed that occurs, bounded-error matching decides whether the notice is there, how many edits
it took and where it lies. Offsets are code points; ends are exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windvane.llm.common import text_slices, tidy, utf8

# Phrases of whole words and their labels.
PHRASES = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")]
# Label, notice in lower case, edits that are allowed.
NOTICES = [
    ("agpl", "gnu affero general public license", 2),
    ("apache", "licensed under the apache license", 3),
    ("bsd", "redistribution and use in source and binary forms", 4),
    ("bsd", "bsd 3-clause license", 1),
    ("cc-by", "licensed under cc by", 1),
    ("cc-by", "creative commons attribution", 2),
    ("cc-by-nc", "licensed under cc by-nc", 1),
    ("cc-by-sa", "licensed under cc by-sa", 1),
    ("cc0", "cc0 1.0 universal", 1),
    ("epl", "eclipse public license", 2),
    ("gpl", "gnu general public license", 2),
    ("isc", "permission to use, copy, modify, and/or distribute this software", 5),
    ("lgpl", "gnu lesser general public license", 2),
    ("mit", "released under the mit license", 2),
    ("mit", "permission is hereby granted, free of charge", 4),
    ("mpl", "mozilla public license", 2),
    ("unlicense", "free and unencumbered software released into the public domain", 5),
]
_WORD_BYTE = np.array([48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])
_GAP = rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def pieces(notice: str, edits: int) -> list[tuple[int, str]]:
    """The notice cut into ``edits`` + 1 pieces of almost equal length, each with its place."""
    cuts = [len(notice) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]  # noqa: B905


class NoticeFinder:
    """Seeds and patterns of a list of notices."""

    def __init__(self, notices: list[tuple[str, str, int]] | None = None):
        self.notices = NOTICES if notices is None else notices
        seeds: dict[str, list[tuple[int, int]]] = {}
        for n, (_, notice, edits) in enumerate(self.notices):
            for at, piece in pieces(notice, edits):
                seeds.setdefault(piece, []).append((n, at))
        self.automaton = ahocorasick.Automaton()
        for seed, places in seeds.items():
            self.automaton.add_word(seed, (len(seed), places))
        self.automaton.make_automaton()
        self.patterns = [regex.compile(f"(?b)(?:{regex.escape(notice)}){{e<={edits}}}") for _, notice, edits in self.notices]

    def rows(self, data: bytes) -> np.ndarray:
        """Ends of all seeds in lower-case bytes."""
        return np.fromiter((end for end, _ in self.automaton.iter(data.decode("latin-1"))), np.int64)

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(start, end, notice, edits) of the notices in a lower-case text, without overlaps of one notice, fewest edits first."""
        windows, checked = set(), {}
        for end, (size, places) in self.automaton.iter(text):
            for n, at in places:
                windows.add((n, max(0, end + 1 - size - at - self.notices[n][2])))
        found = set()
        for n, start in windows:
            _, notice, edits = self.notices[n]
            part = text[start : start + len(notice) + 2 * edits]
            if (n, part) not in checked:
                match = self.patterns[n].search(part)
                checked[n, part] = match and (match.start(), match.end(), sum(match.fuzzy_counts))
            if hit := checked[n, part]:
                found.add((hit[2], start + hit[0], start + hit[1], n))
        kept: list[tuple[int, int, int, int]] = []
        taken: dict[int, list[tuple[int, int]]] = {}
        for edits, start, end, n in sorted(found):
            mine = taken.setdefault(n, [])
            if all(end <= a or b <= start for a, b in mine):
                mine.append((start, end))
                kept.append((start, end, n, edits))
        return sorted(kept)


def license_scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", notices: list[tuple[str, str, int]] | None = None) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans) for every row.

    ``n_base`` counts the places of the phrases as consecutive words; ``labels`` adds those of the notices found
    in ``spans`` (label, start, end, edits). The score is 1 with a phrase, else the share of the best notice that is unedited, else 0.
    Null and empty texts have no words, places or labels; repeated rows are scanned alike; an empty table gives an
    empty result; other columns are not read.
    """
    phrases = [(re.compile(_GAP.join(p.encode().split())), label) for p, label in PHRASES]

    def scanned(part: pa.RecordBatch, finder: NoticeFinder) -> pa.RecordBatch:
        rows = part.num_rows
        data, offsets = utf8(part.column("text"))
        low = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data).astype(np.uint8).tobytes()
        word = _WORD_BYTE[data]
        fresh = np.zeros(len(data) + 1, bool)
        fresh[offsets[:-1]] = True
        starts = np.flatnonzero(word & (fresh[:-1] | ~np.concatenate([[False], word[:-1]]))) if len(data) else np.zeros(0, np.int64)
        first = np.searchsorted(starts, offsets)
        places: list[list[int]] = [[] for _ in range(rows)]
        base: list[set[str]] = [set() for _ in range(rows)]
        for pattern, label in phrases:
            for match in pattern.finditer(low):
                a, b = match.span()
                row = int(np.searchsorted(offsets, a, side="right")) - 1
                if (a > offsets[row] and word[a - 1]) or b > offsets[row + 1] or (b < offsets[row + 1] and word[b]):
                    continue
                places[row].append(int(np.searchsorted(starts, a) - first[row]))
                base[row].add(label)
        spans: list[list[dict]] = [[] for _ in range(rows)]
        score = np.array([1.0 if p else 0.0 for p in places])
        for row in np.unique(np.searchsorted(offsets, finder.rows(low), side="right") - 1).tolist():
            text = low[offsets[row] : offsets[row + 1]].decode()
            for a, b, n, edits in finder.find(text):
                label, notice, _ = finder.notices[n]
                spans[row].append({"label": label, "start": a, "end": b, "edits": edits})
                score[row] = max(score[row], 1 - edits / len(notice))
        labels = [sorted(b | {s["label"] for s in x}) for b, x in zip(base, spans, strict=True)]
        return pa.RecordBatch.from_arrays(
            [part.column("id"), pa.array(np.diff(first)), pa.array([len(p) for p in places], pa.int64()),
             pa.array([min(p, default=None) for p in places], pa.int64()), pa.array([max(p, default=None) for p in places], pa.int64()),
             pa.array([sorted(b) for b in base], pa.list_(pa.string())), pa.array(labels, pa.list_(pa.string())), pa.array(score),
             pa.array(spans, pa.list_(pa.struct([("label", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("edits", pa.int32())])))],
            ["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = NoticeFinder(notices)
        for part in text_slices(batches, "text"):
            yield scanned(part, finder)

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = (
        f"id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, labels array<string>, "
        "score double, spans array<struct<label: string, start: int, end: int, edits: int>>"
    )
    return rows.mapInArrow(tidy(run), out).withColumnRenamed("id", id_column)
