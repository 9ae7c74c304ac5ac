"""Packing of documents into sequences by lexical retrieval.

Documents are tokenized once and stored. Their words are counted over the whole table, and each document goes to a shard named by its
rarest word among the frequent ones, so that documents that share it meet wherever they were read; the documents of a word that more than a
shard of them hold are spread over several shards. A shard holds an inverted index of its words with BM25 weights, whose document frequencies and mean length
are those of all documents. Words are named by a hash of 32 bits of their ids; words with one name count as one. A sequence begins with a seed document (or the rest of one that was cut); the index returns the unused documents of the shard that share
most weight with it, and they fill the sequence in that order. When none is left, the next unused document is the
new seed. A document that does not fit is cut and goes on in the next sequence, so every sequence of a shard is
full, but for its last tokens: these form sequences whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windvane.llm.bpe import byte_characters
from windvane.llm.common import text_slices, tidy, worker_cache
from windvane.llm.words import BEFORE_MARK, WordTable, most_frequent, spread
from windvane.session import cut_lineage, scratch_path

SHARD_DOCS = 4096
SHARD_TOKENS = 1 << 23  # a shard ends with the document that passes this
KEY_WORDS = 262_144  # most frequent words of all documents, from which a shard is named
SLICE_IDS = 1 << 19  # stored ids that a task turns into arrays at a time; one longer document is a slice of its own
COUNTED_WORDS = 2_000_000  # words a task counts before it sends them on
TASK_WORDS = 150_000  # distinct words a task remembers
SENT_TOKENS = 1 << 19  # ids that leave a task at a time
DENSE = 16  # a word that more than one in so many documents of a shard hold is common
FIRST = 64  # neighbours of a seed that are put in order at first
K1, B = 1.2, 0.75
_BYTES = byte_characters()
_WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")


def _tokenizer(path: str):
    held = worker_cache("tokenizers")
    if path not in held:
        from tokenizers import Tokenizer

        held[path] = Tokenizer.from_file(path)
        held[path].no_truncation()
        held[path].no_padding()
    return held[path]


def word_ids(path: str, words: list[str]) -> Iterator[list[int]]:
    """Ids of words without ASCII white space, as the library gives them.

    Up to U+012F the library's normalisation is lower case alone and its classes of characters are those of ``regex``, so a word is cut into its
    parts here and the library's model merges each part. Other words, and words that may hold a special token, go through the whole library.
    """
    tokenizer = _tokenizer(path)
    tokenize = tokenizer.model.tokenize
    known: dict[str, list[int]] = {}
    for word in words:
        plain = word.isascii()
        if plain and word.isalpha():
            yield [t.id for t in tokenize(word.lower())]
        elif "<|" in word or not (plain or max(word) < "İ"):
            yield tokenizer.encode(word, add_special_tokens=False).ids
        else:
            ids = []
            for part in _WORD.findall(word.lower()):
                if part not in known:
                    same = part.isascii() and part.isprintable()
                    known[part] = [t.id for t in tokenize(part if same else "".join([_BYTES[b] for b in part.encode()]))]
                ids += known[part]
            yield ids


def _looked_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The value of each wanted key in sorted keys, 0 where there is none."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Numbers of 63 bits that look random, by splitmix64."""
    x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(1)).astype(np.int64)


def shard_names(words: np.ndarray, counts: np.ndarray, held: np.ndarray, shards: int, shard_docs: int, place: np.ndarray) -> np.ndarray:
    """The shard of each document by its rarest word; ``held`` documents have each word, 0 for one that names no shard.

    Documents of a word that more than ``shard_docs`` hold, and those without such a word, are dealt out by their ``place``.
    """
    rarest = np.where(held > 0, held << 32 | (words.astype(np.int64) + (1 << 31)), np.iinfo(np.int64).max)
    best = np.full(len(counts), np.iinfo(np.int64).max)
    some = np.flatnonzero(counts)
    if len(some):
        best[some] = np.minimum.reduceat(rarest, (np.cumsum(counts) - counts)[some])
    known = best < np.iinfo(np.int64).max
    parts = -(-(best >> 32) // shard_docs)
    term = _mixed(best & 0xFFFFFFFF)
    return np.where(known, _mixed(term + np.where(known, place % np.maximum(parts, 1), 0)), _mixed(place)) % shards


class Index:
    """BM25 over one shard: postings by word, and the words that every document shares with others.

    A seed is scored by all of these words, or by the ``query_words`` heaviest ones.
    ``of_all`` has what is known of all documents: their number, their mean length, and sorted words with the number of documents that
    hold each; without it the shard is all there is. A word that it lacks is held by one document.
    """

    def __init__(
        self, words: np.ndarray, counts: np.ndarray, query_words: int | None = None, of_all: tuple[int, float, np.ndarray, np.ndarray] | None = None
    ):
        docs = len(counts)
        doc = np.repeat(np.arange(docs), counts)
        key, tf = np.unique(words.astype(np.int64) << 32 | doc, return_counts=True)
        doc, fresh = key & 0xFFFFFFFF, np.diff(key >> 32, prepend=-(1 << 40)) != 0
        word = np.cumsum(fresh) - 1
        df = np.bincount(word)
        shared = df[word] > 1  # a word of one document finds no neighbour
        if of_all:
            number, mean, held, n = of_all
            total = np.maximum(_looked_up(held, n, key[fresh] >> 32), 1)
        else:
            number, mean, total = docs, counts.mean(), df
        idf = np.log1p((number - total + 0.5) / (total + 0.5))
        length = counts / max(1.0, mean)
        weight = idf[word] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[doc]))
        self.start, self.size = np.flatnonzero(fresh), df
        self.doc, self.weight = doc, weight
        rows = np.flatnonzero(shared)
        if query_words is None:
            rows = rows[np.argsort(doc[rows], kind="stable")]
        else:  # heaviest first; ties by the hash that names the word
            rows = rows[np.lexsort((key[rows], -weight[rows], doc[rows]))]
            begin = np.searchsorted(doc[rows], np.arange(docs + 1))
            rows = rows[np.arange(len(rows)) - np.repeat(begin[:-1], np.diff(begin)) < query_words]
        self.query = word[rows]
        self.query_start = np.searchsorted(doc[rows], np.arange(docs + 1))
        self.docs = docs
        # words that many documents hold as rows over all documents, which add up faster than postings
        self.place = np.full(len(df), -1)
        common = np.flatnonzero(df > docs // DENSE)
        self.place[common] = np.arange(len(common))
        at = self.place[word]
        self.dense = np.zeros((len(common), docs))
        self.dense[at[at >= 0], doc[at >= 0]] = weight[at >= 0]

    def ranked(self, seed: int, used: np.ndarray) -> Iterator[int]:
        """Unused documents that share a word of the seed's query, best first."""
        words = self.query[self.query_start[seed] : self.query_start[seed + 1]]
        if not len(words):
            return
        place = self.place[words]
        few = words[place < 0]
        at = spread(self.start[few], self.size[few])
        score = np.bincount(self.doc[at], self.weight[at], self.docs).astype(float)
        for row in place[place >= 0].tolist():
            score += self.dense[row]
        score[used] = 0
        found = np.flatnonzero(score)
        if len(found) > 2 * FIRST:  # a window seldom needs more than the first
            least = np.partition(score[found], len(found) - FIRST)[len(found) - FIRST]
            best = found[score[found] >= least]
            yield from best[np.argsort(-score[best], kind="stable")].tolist()
            found = found[score[found] < least]
        yield from found[np.argsort(-score[found], kind="stable")].tolist()

    def neighbours(self, seed: int, used: np.ndarray) -> list[int]:
        return list(self.ranked(seed, used))


def fill(sizes: np.ndarray, index: Index, window: int) -> tuple[np.ndarray, int]:
    """Rows (document, start, length, sequence, offset) for documents of the given sizes, and the number of sequences."""
    used, rows = np.zeros(len(sizes), bool), []
    sequence, offset, following, waiting, next_ = 0, 0, iter(()), False, 0
    sizes = sizes.tolist()
    while True:
        doc = next((d for d in following if not used[d]), None)
        if doc is None:
            while next_ < len(sizes) and used[next_]:
                next_ += 1
            if next_ == len(sizes):
                break
            doc, waiting = next_, True
        used[doc], start, before = True, 0, sequence
        while start < sizes[doc]:
            n = min(window - offset, sizes[doc] - start)
            rows.append((doc, start, n, sequence, offset))
            start, offset = start + n, offset + n
            if offset == window:
                sequence, offset = sequence + 1, 0
        if offset and (waiting or sequence != before):  # a new seed, or one that goes on in a new sequence
            following = index.ranked(doc, used.copy())
        elif not offset:
            following = iter(())
        waiting = False
    table = np.array(rows, np.int64).reshape(-1, 5)
    if offset:
        last = table[:, 3] == sequence
        table, sequence = np.concatenate([table[~last], _powers(table[last], offset, sequence)]), sequence + offset.bit_count()
    return table, sequence


def _powers(rows: np.ndarray, tokens: int, sequence: int) -> np.ndarray:
    """The pieces of an unfinished sequence dealt into sequences of descending powers of two."""
    out, room, offset = [], 1 << (tokens.bit_length() - 1), 0
    for doc, start, n, _, _ in rows.tolist():
        while n:
            take = min(n, room - offset)
            out.append((doc, start, take, sequence, offset))
            start, n, offset, tokens = start + take, n - take, offset + take, tokens - take
            if offset == room:
                sequence, offset, room = sequence + 1, 0, 1 << (tokens.bit_length() - 1) if tokens else 0
    return np.array(out, np.int64).reshape(-1, 5)


def _binary(numbers: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Runs of numbers as binary values, one per row."""
    offsets = np.concatenate([[0], np.cumsum(counts)]) * numbers.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(numbers)]).cast(pa.binary())


def _numbers(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all rows of a binary column, and how many each row has."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    return np.frombuffer(data.tobytes(), kind), np.diff(offsets) // np.dtype(kind).itemsize


def _lengths(sizes: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Sizes of the words of every document as bytes: 255 means that the next byte is added."""
    more = sizes // 255
    if more.any():
        ends = np.cumsum(more + 1)
        data = np.full(ends[-1], 255, np.uint8)
        data[ends - 1] = sizes % 255
        counts = np.diff(np.concatenate([[0], np.cumsum(more + 1)])[np.cumsum(counts)], prepend=0)
        return _binary(data, counts)
    return _binary(sizes.astype(np.uint8), counts)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches cut by rows so that a slice holds about SLICE_IDS ids, or one row; a row without a size has none."""
    for batch in batches:
        ends = np.cumsum(batch.column("size").fill_null(0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + SLICE_IDS, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def _read(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of stored documents, names of their words, and the number of words of each."""
    sizes = batch.column("size").to_numpy().astype(np.int64)
    width = pc.binary_length(batch.column("ids")).to_numpy().astype(np.int64) // sizes  # bytes an id
    if (width == width[0]).all():
        ids = _numbers(batch.column("ids"), f"<u{width[0]}")[0].astype(np.int32)
    else:
        ids = np.concatenate([np.frombuffer(v, f"<u{w}") for v, w in zip(batch.column("ids").to_pylist(), width.tolist(), strict=True)]).astype(np.int32)
    parts, counts = _numbers(batch.column("lengths"), "u1")
    last = parts != 255
    ends = np.concatenate([[0], np.cumsum(parts, dtype=np.int64)])[1:][last]
    counts = np.diff(np.concatenate([[0], np.cumsum(last)])[np.cumsum(counts)], prepend=0)
    size = np.diff(ends, prepend=0)
    inner = np.ones(len(ids), bool)
    inner[np.cumsum(sizes) - 1] = False  # the id that ends a document belongs to no word
    place = np.arange(len(ids) - len(sizes)) - np.repeat(ends - size, size)
    mixed = _mixed(ids[inner].astype(np.int64) << 32 | place).astype(np.uint64)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
    return ids, (_mixed(total[ends] - total[ends - size]) >> 31).astype(np.uint32).view(np.int32), counts


def pack(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", window: int = 2048, end: int = 1,
    shard_docs: int = SHARD_DOCS, shard_tokens: int = SHARD_TOKENS, with_ids: bool = True,
) -> DataFrame:
    """(id, start, length, doc_tokens, sequence_id, offset, ids_crc32, ids) per piece of every document.

    A document is its ids and the id ``end``; a null text has no other ids. Sequences hold at most ``window`` tokens, a
    power of two. Repeated rows are documents of their own; an empty table gives an empty result; other columns are not read.
    A task that runs again gives the same pieces. ``ids`` is null without ``with_ids``.
    """
    if window & (window - 1):
        raise ValueError("the window must be a power of two")

    def resolve(new: list[str]) -> tuple[list[int], list[int]]:
        sizes, numbers = [], []
        for ids in word_ids(path, new):
            sizes.append(len(ids))
            numbers += ids
        return sizes, numbers

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Ids of every document, and how many each of its words has."""
        table, place = WordTable(resolve, TASK_WORDS), TaskContext.get().partitionId() << 32
        for part in text_slices(batches, "text"):
            column = part.column("text")
            column = column.fill_null("") if column.null_count else column
            lowered = pc.replace_substring_regex(pc.ascii_lower(column), BEFORE_MARK, "\\1 \\2")  # less different words
            special = pc.match_substring(column, "<|")  # there capitals may tell a special token from other text
            column = pc.if_else(special, column, lowered) if pc.any(special).as_py() else lowered
            words = pc.ascii_split_whitespace(column)
            counts = words.value_lengths().to_numpy().astype(np.int64)
            rows = table.rows_of(words.flatten())
            ids, size = table.numbers(rows), table.size[rows]
            ends = np.concatenate([[0], np.cumsum(size)])[np.cumsum(counts)]
            ids = np.insert(ids, ends, end)
            sizes = np.diff(ends, prepend=0) + 1
            width = np.dtype("<u2") if ids.max(initial=0) < 1 << 16 else np.dtype("<u4")
            columns = [part.column("id"), _binary(ids.astype(width), sizes), pa.array(sizes), _lengths(size, counts), pa.array(counts)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(place + np.arange(len(counts)))], ["id", "ids", "size", "lengths", "words", "place"])
            place += len(counts)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(word, n) of the documents of a task, in parts."""
        held, size = [], 0

        def send() -> pa.RecordBatch:
            word, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(word), pa.array(n)], ["word", "n"])

        for batch in _slices(batches):
            _, words, counts = _read(batch)
            key = np.sort(np.repeat(np.arange(len(counts)), counts) << 32 | (words.astype(np.int64) + (1 << 31)))
            key = key[np.diff(key, prepend=-1) != 0] & 0xFFFFFFFF  # once per document
            held.append((key - (1 << 31)).astype(np.int32))
            size += len(held[-1])
            if size > COUNTED_WORDS:
                yield send()
                held, size = [], 0
        if held:
            yield send()

    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    kind = rows.schema["id"].dataType
    stored = T.StructType().add("id", kind).add("ids", "binary").add("size", "long").add("lengths", "binary").add("words", "long").add("place", "long")
    folder = scratch_path(spark, "tokens")
    rows.mapInArrow(tidy(tokenize), stored).write.parquet(folder, compression="zstd")
    tokens = spark.read.schema(stored).parquet(folder)
    number, all_tokens, mean = tokens.agg(F.count("*"), F.sum("size"), F.avg("words")).first()
    shards = max(1, -(-4 * number // (3 * shard_docs)), -(-4 * (all_tokens or 0) // (3 * shard_tokens)))
    counted = cut_lineage(
        tokens.select("ids", "size", "lengths").mapInArrow(tidy(count), "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).where("n > 1")
    )
    frequent = most_frequent(counted, KEY_WORDS).orderBy("word").toPandas()
    key_words, key_n = frequent["word"].to_numpy(np.int32), frequent["n"].to_numpy(np.int64)
    shared = spark.sparkContext.broadcast((key_words, key_n))

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The documents with their shards."""
        for batch in _slices(batches):
            _, words, counts = _read(batch)
            shard = shard_names(words, counts, _looked_up(*shared.value, words), shards, shard_docs, batch.column("place").to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(shard), *batch.columns], ["shard", *batch.schema.names])

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(shard, word, n) of the words that are not among the frequent ones, of the documents of a batch."""
        for batch in _slices(batches):
            _, words, counts = _read(batch)
            n = _looked_up(*shared.value, words)
            shard, other = shard_names(words, counts, n, shards, shard_docs, batch.column("place").to_numpy()), n == 0
            key = np.sort(np.repeat(np.arange(len(counts)), counts)[other] << 32 | (words[other].astype(np.int64) + (1 << 31)))
            key = key[np.diff(key, prepend=-1) != 0]  # once per document
            key, n = np.unique(shard[key >> 32] << 32 | (key & 0xFFFFFFFF), return_counts=True)
            columns = [pa.array(key >> 32), pa.array(((key & 0xFFFFFFFF) - (1 << 31)).astype(np.int32)), pa.array(n)]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "word", "here"])

    dealt = tokens.mapInArrow(tidy(named), T.StructType([T.StructField("shard", T.LongType()), *stored.fields]))
    rows = dealt.select("shard", F.lit(1).alias("part"), "id", "ids", "size", "lengths")
    if counted.count() > len(key_words):  # a word that one document of a shard holds finds no neighbour there
        others = tokens.select("ids", "size", "lengths", "place").mapInArrow(tidy(rare), "shard long, word int, here long").groupBy("shard", "word").agg(F.sum("here").alias("here"))
        pairs = others.where("here > 1").join(counted, "word").groupBy("shard").agg(F.collect_list(F.struct("word", "n")).alias("pairs"))
        rows = rows.withColumn("pairs", F.lit(None).cast(pairs.schema["pairs"].dataType)).unionByName(pairs.withColumn("part", F.lit(0)), allowMissingColumns=True)
    else:
        rows = rows.withColumn("pairs", F.lit(None).cast("array<struct<word: int, n: bigint>>"))
    rows = rows.repartition(shards, "shard").sortWithinPartitions("shard", "part", "id", "ids")

    def packed(ids: np.ndarray, sizes: np.ndarray, table: np.ndarray, keys: pa.Array, number: int) -> Iterator[pa.RecordBatch]:
        """The pieces of one shard, in batches of bounded size."""
        begin = np.cumsum(sizes) - sizes
        data = memoryview(ids.astype("<u4", copy=False)).cast("B")
        cuts = np.flatnonzero(np.diff(np.cumsum(table[:, 2]) // SENT_TOKENS, prepend=0))
        for rows in np.split(table, cuts):
            if not len(rows):
                continue
            doc, start, n, sequence, offset = rows.T
            at = begin[doc] + start
            crc = [zlib.crc32(data[a:b]) for a, b in zip((4 * at).tolist(), (4 * (at + n)).tolist(), strict=True)]
            if with_ids:
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(ids[spread(at, n)]))
            else:
                lists = pa.nulls(len(n), pa.list_(pa.int32()))
            columns = [keys.take(pa.array(doc)), *map(pa.array, (start, n, sizes[doc], sequence + number, offset)), pa.array(crc, pa.int64()), lists]
            names = ["id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, held, keys, at, other = TaskContext.get().partitionId() << 32, [], [], None, None

        def shard() -> Iterator[pa.RecordBatch]:
            nonlocal first, held, keys
            ids, sizes, words, counts = (np.concatenate(x) for x in zip(*held, strict=True))
            held = []
            key, n = shared.value
            if other is not None:
                key, n = np.concatenate([key, other[0]]), np.concatenate([n, other[1]])
                order = np.argsort(key)
                key, n = key[order], n[order]
            rows, sequences = fill(sizes, Index(words, counts, of_all=(number, mean, key, n)), window)
            yield from packed(ids, sizes, rows, pa.chunked_array(keys).combine_chunks(), first)
            first, keys = first + sequences, []

        for whole in _slices(batches):
            shard_of = whole.column("shard").to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(shard_of)) + 1, [len(shard_of)]])
            for begin, stop in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if at != shard_of[begin]:
                    if held:
                        yield from shard()
                    at, other = shard_of[begin], None
                if whole.column("part")[begin].as_py() == 0:
                    pairs = whole.column("pairs").slice(begin, 1).flatten()
                    other = pairs.field("word").to_numpy(), pairs.field("n").to_numpy()
                    begin += 1
                sizes = whole.column("size").slice(begin, stop - begin).to_numpy().astype(np.int64)
                # a shard ends with the document that reaches one of its bounds
                while begin < stop:
                    docs_left, tokens_left = shard_docs - sum(len(h[1]) for h in held), shard_tokens - sum(len(h[0]) for h in held)
                    many = min(docs_left, int(np.searchsorted(np.cumsum(sizes), tokens_left)) + 1, len(sizes))
                    part = whole.slice(begin, many)
                    ids, *names = _read(part)
                    held.append((ids, sizes[:many], *names))
                    keys.append(part.column("id"))
                    begin, sizes = begin + many, sizes[many:]
                    if sum(len(h[1]) for h in held) >= shard_docs or sum(len(h[0]) for h in held) >= shard_tokens:
                        yield from shard()
        if held:
            yield from shard()

    out = f"id {kind.simpleString()}, start long, length long, doc_tokens long, sequence_id long, offset long, ids_crc32 long, ids array<int>"
    return rows.mapInArrow(tidy(run), out).withColumnRenamed("id", id_column)
