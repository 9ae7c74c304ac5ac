"""Words of texts as rows of a table that a task fills once per distinct word."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windvane.llm.common import text_slices, tidy

TABLE_WORDS = 300_000  # distinct words a task remembers; beyond that it keeps those it meets again
COUNTED_WORDS = 200_000  # distinct words a task counts before it sends them on


class _Rows(dict):
    """word -> row number; an unknown word gets the next one and is noted."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = row = len(self)
        self.new.append(word)
        return row


class WordTable:
    """Lists of numbers per word, resolved in bulk when a word is first seen.

    ``resolve`` takes new words and returns the sizes of their lists and the lists one after another. A full table
    keeps the words it has met in more than one call since it was last full.
    """

    def __init__(self, resolve: Callable[[list[str]], tuple[list[int], list[int]]], limit: int = TABLE_WORDS):
        self.resolve, self.limit = resolve, limit
        self.clear()

    def clear(self) -> None:
        self.index = _Rows()
        self.start, self.size, self.flat, self.met = (np.zeros(0, k) for k in (np.int64, np.int64, np.int32, np.int32))

    def _thin(self) -> None:
        kept = self.met > 1
        if kept.sum() > self.limit // 2:
            self.clear()
            return
        words = [w for w, k in zip(self.index, kept.tolist(), strict=True) if k]
        self.flat, self.size = self.numbers(np.flatnonzero(kept)), self.size[kept]
        self.start, self.met = np.cumsum(self.size) - self.size, np.zeros(len(words), np.int32)
        self.index = _Rows()
        self.index.update(zip(words, range(len(words)), strict=True))

    def rows(self, words: list[str]) -> np.ndarray:
        """Row of each word; rows stay valid until the next call."""
        if len(self.index) > self.limit:
            self._thin()
        rows = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        if self.index.new:
            sizes, numbers = self.resolve(self.index.new)
            self.index.new = []
            size = np.array(sizes, np.int64)
            self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(size) - size])
            self.size = np.concatenate([self.size, size])
            self.flat = np.concatenate([self.flat, np.array(numbers, np.int32)])
            self.met = np.concatenate([self.met, np.zeros(len(size), np.int32)])
        self.met[rows] += 1
        return rows

    def rows_of(self, words: pa.Array) -> np.ndarray:
        """Row of each word of a column; each different word of the column is looked up once."""
        coded = words.dictionary_encode()
        return self.rows(coded.dictionary.to_pylist())[coded.indices.to_numpy()]

    def numbers(self, rows: np.ndarray) -> np.ndarray:
        """The lists of some rows, one after another."""
        return self.flat[spread(self.start[rows], self.size[rows])]


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Positions start[0].., start[1].., ... of runs of the given sizes."""
    ends = np.cumsum(size)
    return np.repeat(start - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive groups of the given sizes (0 for an empty group)."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


# Where words end for all tokenizers here: a Latin letter before a mark or a line end, and a line end after a
# mark (or a cut) and before a letter (RE2).
LETTER = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
BEFORE_MARK, AFTER_LINE = f"([{LETTER}])([.,;:!?\\n])", f"([\\x00.,;:!?])\\n([{LETTER}])"


def split_keys(column: pa.Array, odd: str, slow: Callable[[str], list[str]], spaced: bool) -> tuple[pa.Array, np.ndarray]:
    """The chunks of all texts of a column as keys, and their number per row.

    A text is cut before every space, between a letter and a mark or line end, and between a line end after these and a letter. A key is a chunk without
    the space in front; a chunk that has none (also the first one, unless the texts are ``spaced``) has NUL there instead. ``slow`` cuts
    the texts that hold NUL or match the RE2 pattern ``odd``; see :func:`chunk_of` for the way back.
    """
    column = (column.fill_null("") if column.null_count else column).cast(pa.large_string())
    if not len(column):
        return pa.array([], pa.large_string()), np.zeros(0, np.int64)
    special = np.flatnonzero(pc.match_substring_regex(column, f"\\x00|{odd}").to_numpy(zero_copy_only=False))
    whole = column if spaced else pc.binary_join_element_wise(pa.scalar("\x00", pa.large_string()), column, pa.scalar("", pa.large_string()))
    whole = pc.replace_substring_regex(pc.replace_substring_regex(whole, BEFORE_MARK, "\\1 \x00\\2"), AFTER_LINE, "\\1\n \x00\\2")
    lists = pc.split_pattern(whole, " ")
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    if not len(special):
        return lists.flatten(), counts
    parts, at = [], 0
    for row in special.tolist():
        parts.append(lists.slice(at, row - at).flatten())
        keys = [c[1:] if c[0] == " " and c[1:2] != "\x00" else "\x00" + c for c in slow(column[row].as_py()) if c]
        parts.append(pa.array(keys, pa.large_string()))
        counts[row], at = len(keys), row + 1
    return pa.concat_arrays([*parts, lists.slice(at).flatten()]), counts


def chunk_of(key: str) -> str:
    return key[1:] if key[:1] == "\x00" else " " + key


def word_counts(
    docs: DataFrame, text_column: str, split: Callable[[pa.Array], tuple[pa.Array, np.ndarray]], words: Callable[[str], list[str]],
    limit: int = COUNTED_WORDS,
) -> DataFrame:
    """(word, n) over all texts: a text is split into keys of chunks, each distinct chunk of a task into words.

    A task holds at most about ``limit`` different chunks; what it has counted is sent on and added up by word.
    """

    def send(counted: dict[str, int]) -> Iterator[pa.RecordBatch]:
        total: dict[str, int] = defaultdict(int)
        for key, n in counted.items():
            for word in words(chunk_of(key)):
                total[word] += n
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.string()), pa.array(np.fromiter(total.values(), np.int64, len(total)))], ["word", "n"]
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted: dict[str, int] = defaultdict(int)
        for part in text_slices(batches, "text"):
            found = split(part.column("text"))[0].value_counts()
            for key, n in zip(found.field("values").to_pylist(), found.field("counts").to_pylist(), strict=True):
                counted[key] += n
            if len(counted) > limit:
                yield from send(counted)
                counted = defaultdict(int)
        yield from send(counted)

    rows = docs.select(F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(tidy(run), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def most_frequent(counted: DataFrame, words: int) -> DataFrame:
    """Rows of a stored (word, n, ...) table from a count on that at most ``words`` words reach; the counts are taken in steps of an eighth of a doubling.

    Only the histogram of the steps reaches the driver, so that the cost does not grow with the number of partitions as a sorted limit would.
    """
    step = F.floor(F.log2("n") * 8)
    left, least = words, None
    for row in sorted(counted.groupBy(step.alias("step")).agg(F.count("*").alias("words")).collect(), key=lambda r: -r["step"]):
        left -= row["words"]
        if left < 0:
            break
        least = row["step"]
    return counted.where(step >= least) if least is not None else counted.limit(0)
