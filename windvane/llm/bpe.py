"""Byte-level BPE with a lexicon of frequent words as a minimal acyclic transducer.

Words of the texts are counted over the whole corpus. The most frequent ones, with the ids that the merges give
them, become an automaton in which equal suffixes are shared: its arcs carry numbers whose sum along a word is the
word's place in the list of id sequences. The file is sent to every executor and mapped into memory there.
Words it does not hold are merged exactly (by the library's merges), so the ids never depend on what the lexicon holds.
"""

from __future__ import annotations

import mmap
import os
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windvane.llm.common import text_slices, tidy, worker_cache, write_shared
from windvane.llm.words import WordTable, chunk_of, most_frequent, split_keys, spread, word_counts
from windvane.session import cut_lineage

LEXICON_WORDS = 1 << 16
LEXICON_BYTES = 48  # longer words are not put into the lexicon
# White space after a space, or a space at the end: such texts are not cut at their spaces alone (RE2).
_ODD = r" [\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]| $"
_CHUNK = regex.compile(r" ?\S+|\s+(?!\S)|\s+")
_WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte: itself where it is printable Latin-1, else the next one from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


class ByteBpe:
    """A tokenizer file: its pre-tokens, merges and the bytes of its ids."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.chars = byte_characters()
        self.special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        back = {c: b for b, c in self.chars.items()}
        vocab = self.library.get_vocab(with_added_tokens=False)
        every = {i: bytes(back[c] for c in token) for token, i in vocab.items()} | {i: c.encode() for c, i in self.special.items()}
        sizes = [len(every.get(i, b"")) for i in range(max(every) + 1)]
        self.token_size = np.array(sizes, np.int64)
        self.token_start = np.cumsum(self.token_size) - self.token_size
        self.token_bytes = np.frombuffer(b"".join(every.get(i, b"") for i in range(len(sizes))), np.uint8)
        self.border = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def words(self, chunk: str) -> list[str]:
        """Pre-tokens of a chunk. Beyond U+0500 the classes of characters are the library's own."""
        if chunk.isascii() or max(chunk) < "Ԁ":
            body = chunk[1:] if chunk[:1] == " " else chunk
            return [chunk] if body.isalpha() else _WORD.findall(chunk)
        return [chunk[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(chunk)]

    def merge(self, word: str) -> list[int]:
        """Ids of one pre-token by the library's merges."""
        if word.isascii() and word.isprintable():
            plain = word.replace(" ", self.chars[32])
        else:
            plain = "".join([self.chars[b] for b in word.encode()])
        return [t.id for t in self.library.model.tokenize(plain)]

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        return self.token_bytes[spread(self.token_start[ids], self.token_size[ids])]

    def chunks(self, text: str) -> list[str]:
        """A text cut at special tokens and before spaces that belong to the next word, which never cuts a pre-token."""
        pieces = self.border.split(text) if self.border else [text]
        return [c for piece in pieces for c in ([piece] if piece in self.special else _CHUNK.findall(piece))]

    def split(self, column: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Keys of chunks, see :func:`split_keys`."""
        odd = "|".join([_ODD, *map(regex.escape, self.special)])
        return split_keys(column, odd, self.chunks, spaced=False)


class Transducer:
    """Minimal acyclic automaton over bytes; the outputs on the arcs of a word add up to its place in the sorted list."""

    HEADER = "<6q"

    def __init__(self, file: bytes | mmap.mmap):
        arcs, states, words, ids, self.root, self.longest = struct.unpack_from(self.HEADER, file)
        at = struct.calcsize(self.HEADER)

        def take(kind: type, n: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(file, kind, n, at)
            at += found.nbytes
            return found

        self.arc, self.output, self.start = take(np.int64, arcs), take(np.int64, arcs), take(np.int64, words + 1)
        self.target, self.ids, self.final = take(np.int32, arcs), take(np.int32, ids), take(np.bool_, states)

    @classmethod
    def compiled(cls, entries: dict[bytes, list[int]]) -> bytes:
        """The file for words and their ids, built word by word in sorted order; a state is stored once per right language."""
        words = sorted(entries)
        known: dict[tuple, int] = {}
        path: list[list] = [[False, []]]
        labels: list[int] = []

        def freeze(depth: int) -> None:
            while len(labels) > depth:
                final, arcs = path.pop()
                state = known.setdefault((final, tuple(arcs)), len(known))
                path[-1][1].append((labels.pop(), state))

        last = b""
        for word in words:
            same = len(os.path.commonprefix([last, word]))
            freeze(same)
            for label in word[same:]:
                path.append([False, []])
                labels.append(label)
            path[-1][0], last = True, word
        freeze(0)
        root = known.setdefault((path[0][0], tuple(path[0][1])), len(known))
        below, rows = [0] * len(known), []  # words that end in or below a state; targets come before their sources
        for state, (final, arcs) in enumerate(known):
            n = int(final)
            for label, target in arcs:
                rows.append((state << 8 | label, target, n))
                n += below[target]
            below[state] = n
        arc, target, output = (np.array([r[k] for r in rows], np.int64) for k in range(3))
        order = np.argsort(arc)
        lists = [entries[w] for w in words]
        start = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
        ids = np.array([i for x in lists for i in x], np.int32)
        header = struct.pack(cls.HEADER, len(arc), len(known), len(words), len(ids), root, max(map(len, words), default=0))
        parts = [arc[order], output[order], start, target[order].astype(np.int32), ids, np.array([f for f, _ in known], np.bool_)]
        return header + b"".join(p.tobytes() for p in parts)

    def places(self, words: list[bytes]) -> np.ndarray:
        """Place of each word, -1 if it is not in the list; all words walk the automaton together, a byte at a time."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        at = np.cumsum(size) - size
        state, place = np.full(len(words), self.root, np.int64), np.zeros(len(words), np.int64)
        alive = np.flatnonzero(size <= self.longest) if len(self.arc) else np.zeros(0, np.int64)
        place[size > self.longest if len(self.arc) else slice(None)] = -1
        for step in range(self.longest):
            alive = alive[size[alive] > step]
            if not len(alive):
                break
            key = state[alive] << 8 | data[at[alive] + step]
            arc = np.minimum(np.searchsorted(self.arc, key), len(self.arc) - 1)
            hit = self.arc[arc] == key
            place[alive[~hit]] = -1
            alive, arc = alive[hit], arc[hit]
            state[alive] = self.target[arc]
            place[alive] += self.output[arc]
        ended = np.flatnonzero(place >= 0)
        place[ended[~self.final[state[ended]]]] = -1
        return place


def _word_list(model: ByteBpe, chunk: str) -> list[str]:
    return [chunk] if chunk in model.special else model.words(chunk)


def _model(path: str) -> ByteBpe:
    models = worker_cache("byte_bpe")
    if path not in models:
        models[path] = ByteBpe(path)
    return models[path]


def _lexicon(name: str) -> Transducer:
    """The lexicon that was sent to this executor, mapped into memory; a worker keeps the last one open."""
    held = worker_cache("lexicon")
    if name not in held:
        held.clear()
        with open(SparkFiles.get(name), "rb") as file:
            held[name] = Transducer(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))
    return held[name]


def build_lexicon(docs: DataFrame, path: str, text_column: str = "text", words: int = LEXICON_WORDS) -> str:
    """Counts the words of all texts, compiles the most frequent ones (that occur twice or more) and sends the file to the executors.

    Returns the file's name; the file lies in the shared folder, from which also later executors get it. At most ``words`` words of ``LEXICON_BYTES`` bytes reach the driver.
    """
    spark, model = docs.sparkSession, _model(path)
    # the functions travel to the tasks, the model is read there
    counted = word_counts(docs, text_column, lambda column: _model(path).split(column), lambda chunk: _word_list(_model(path), chunk))
    counted = cut_lineage(counted.where((F.col("n") > 1) & (F.octet_length("word") <= LEXICON_BYTES)))
    common = most_frequent(counted, words).select("word").toPandas()["word"]
    file = Transducer.compiled({w.encode(): model.merge(w) for w in common if w not in model.special})
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    spark.sparkContext.addFile(write_shared(spark, name, file))
    return name


def encode(docs: DataFrame, path: str, lexicon: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, ids): the ids of every whole text; special tokens inside a text become their ids, as the library's default is.

    Null and empty texts have no ids; repeated rows are encoded alike; an empty table gives an empty result.
    """

    def resolve(keys: list[str]) -> tuple[list[int], list[int]]:
        model, found = _model(path), _lexicon(lexicon)
        lists = [_word_list(model, chunk_of(k)) for k in keys]
        distinct = list(dict.fromkeys(w for words in lists for w in words))
        places = found.places([w.encode() for w in distinct])
        start, listed = found.start.tolist(), found.ids.tolist()
        ids: dict[str, list[int]] = {}
        for word, place in zip(distinct, places.tolist(), strict=True):
            if place >= 0:
                ids[word] = listed[start[place] : start[place + 1]]
            else:
                ids[word] = [model.special[word]] if word in model.special else model.merge(word)
        every = [ids[words[0]] if len(words) == 1 else [i for w in words for i in ids[w]] for words in lists]
        return list(map(len, every)), [i for x in every for i in x]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, table = _model(path), WordTable(resolve)
        for part in text_slices(batches, "text"):
            words, counts = model.split(part.column("text"))
            rows = table.rows_of(words)
            ends = np.concatenate([[0], np.cumsum(table.size[rows])])[np.concatenate([[0], np.cumsum(counts)])]
            ids = pa.array(table.numbers(rows))
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), ids)], ["id", "ids"])

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(tidy(run), f"id {kind}, ids array<int>").withColumnRenamed("id", id_column)


def decode(encoded: DataFrame, path: str, ids_column: str = "ids", text_column: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids; bytes that are no UTF-8 become U+FFFD, null ids an empty text."""
    kept = encoded.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(path)
        for batch in batches:
            step = max(1, (1 << 20) * batch.num_rows // max(1, len(batch.column(ids_column).flatten())))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                lists = part.column(ids_column)
                lists = lists.fill_null([]) if lists.null_count else lists
                ids, sizes = lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy(zero_copy_only=False)
                data = model.bytes_of(ids).tobytes()
                ends = np.concatenate([[0], np.cumsum(model.token_size[ids])])[np.concatenate([[0], np.cumsum(sizes)])].tolist()
                out = [data[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:])]  # noqa: B905
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.string())], [*part.schema.names, text_column])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(tidy(run), f"{fields}, `{text_column}` string")
