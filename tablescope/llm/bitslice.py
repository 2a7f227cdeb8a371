"""Ranked lexical search over bit-sliced Bloom signatures.

Each task writes its documents in blocks.  A block is a bit matrix with one
row per slice and one column per document; a document sets ``HASHES`` bits of
its column for each of its terms, and again for a term that it has at least 2,
3, 5, 9, ... times.  The documents of a block have about the same number of
bits to set, so one number of slices suits them all, short or long.  Beside the
matrix a block keeps the terms and frequencies themselves.

The slices of a term, joined by AND, mark every document that has it and a few
that do not.  Weighted sums of these marks, level by level, are upper bounds of
the scores.  Documents are scored exactly, from their own frequencies, only if
their bound reaches the k-th best exact score that the task has seen.  A bound
that equals it is scored too, as the tie may go to a smaller id.  The best k of
the tasks' best k are the best k of all; all statistics are global.

Terms are runs of ASCII letters, ASCII digits and non-ASCII characters; only
A to Z are lower-cased; they are held as 64-bit hashes.  Weights and scores are
whole numbers, see :func:`weights` and :class:`Searcher`.

Queries are taken in blocks of about ``BLOCK_TERMS`` terms, so what is
broadcast has a fixed bound; each block reads the index twice, for document
frequencies and for scores.

Defined cases: a null or termless text is no document and a null or termless
query has no rows; fewer than k matches give fewer rows; ties go to the smaller
id, null ids last; repeated documents are documents of their own; repeated
queries are answered each; other columns are ignored.  Keys of documents are
whole numbers; keys of queries are of any type.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from .common import Scratch

HASHES = 3
SLICES_PER_BIT = 8  # slices per term of the largest document of a block: every 40th mark is false
BLOCK_DOCS = 1024
BLOCK_ENTRIES = 400_000  # terms held by one block, beyond a single document
POOL_ENTRIES = 1_500_000  # terms held by a task before its fullest block is written
BLOCK_TERMS = 500_000  # query terms answered by one pass
K = 10
MERGE_TASKS = 64
NO_ID = np.iinfo(np.int64).max
FOLD = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()
INDEX = "docs bigint, words bigint, n int, slices int, ids binary, lengths binary, signature binary, vocab binary, bounds binary, entries binary, tf binary"


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, in order."""
    return text.translate(FOLD).split()


class _Hashes(dict):
    """64-bit hashes of terms, remembered up to a bound."""

    def __missing__(self, term: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        self[term] = h = xxhash.xxh3_64_intdigest(term) - (1 << 63)
        return h


def counts_of(text: bytes, known: _Hashes) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of terms of a text, hashes of the distinct ones in order, and their frequencies."""
    found = Counter(terms_of(text))
    terms = np.fromiter(map(known.__getitem__, found), np.int64, len(found))
    tf = np.fromiter(found.values(), np.int64, len(found))
    order = np.argsort(terms)
    return int(tf.sum()), terms[order], tf[order]


def levels(most: int) -> list[int]:
    """Frequencies that have bits of their own: 1, 2, 3, 5, 9, ... up to ``most``."""
    return [1, *[(1 << i) + 1 for i in range((most - 1).bit_length())]]


def slices_of(terms: np.ndarray, level: int, m: int) -> np.ndarray:
    """The ``HASHES`` slices of each term at a level; ``m`` is a power of two."""
    h = (terms.view(np.uint64) + np.uint64(level + 1)) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    step = (h >> np.uint64(32)) | np.uint64(1)
    return ((h[:, None] + step[:, None] * np.arange(HASHES, dtype=np.uint64)) & np.uint64(m - 1)).astype(np.int64)


def _small(values: np.ndarray) -> bytes:
    """Numbers in the smallest unsigned type that holds them, its size first."""
    size = np.min_scalar_type(int(values.max(initial=0)))
    return bytes([size.itemsize]) + values.astype(size).tobytes()


def _read(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"u{raw[0]}", offset=1).astype(np.int64)


def pack(docs: list[tuple[int, int, np.ndarray, np.ndarray]], bits: int) -> tuple:
    """One row of the index from ``(id, number of terms, terms, frequencies)`` and the most bits a document sets."""
    n, m = len(docs), 1 << max(6, math.ceil(math.log2(max(1, bits) * SLICES_PER_BIT)))
    size = np.array([len(d[2]) for d in docs])
    vocab, entry = np.unique(np.concatenate([d[2] for d in docs]), return_inverse=True)
    tf, owner = np.concatenate([d[3] for d in docs]), np.repeat(np.arange(n), size)
    marks = np.zeros((m, -(-n // 8) * 8), bool)
    for j, least in enumerate(levels(int(tf.max()))):
        at = np.flatnonzero(tf >= least)
        used, local = np.unique(entry[at], return_inverse=True)
        marks[slices_of(vocab[used], j, m)[local].ravel(), np.repeat(owner[at], HASHES)] = True
    length = np.array([d[1] for d in docs], np.int64)
    ids = np.array([d[0] for d in docs], np.int64)
    return (
        n, int(length.sum()), n, m, ids.tobytes(), length.tobytes(), np.packbits(marks, axis=1).tobytes(), vocab.tobytes(),
        np.concatenate([[0], np.cumsum(size)]).astype(np.int64).tobytes(), _small(entry), _small(tf),
    )


def index(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The blocks of all documents (columns ``INDEX``), written to the shared folder."""
    names = [c.split()[0] for c in INDEX.split(", ")]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, pools, held = _Hashes(), {}, 0

        def row(size: int) -> pa.RecordBatch:
            made = pack(pools.pop(size)[0], 1 << size)
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()] + [pa.binary()] * 7
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(made, kinds)], names=names)

        for batch in batches:
            ids = batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False).tolist()
            for i, raw in zip(ids, batch.column(1)):
                n, terms, tf = counts_of(raw.as_py() or b"", known)
                if not n:
                    continue
                bits = sum(int((tf >= least).sum()) for least in levels(int(tf.max())))
                size = max(3, (bits - 1).bit_length())
                pool = pools.setdefault(size, [[], 0])
                pool[0].append((i, n, terms, tf))
                pool[1] += len(terms)
                held += len(terms)
                full = size if len(pool[0]) >= BLOCK_DOCS or pool[1] >= BLOCK_ENTRIES else max(pools, key=lambda s: pools[s][1]) if held > POOL_ENTRIES else None
                if full is not None:
                    held -= pools[full][1]
                    yield row(full)
        for size in sorted(pools):
            yield row(size)

    rows = docs.select(F.col(key).cast("bigint").alias("k"), F.col(text).cast("binary").alias("t")).where(F.col("t").isNotNull())
    return Scratch(docs.sparkSession).keep(rows.mapInArrow(build, INDEX))


def totals(blocks: DataFrame) -> tuple[int, int]:
    """Number of documents that have a term, and of all their terms."""
    row = blocks.agg(F.sum("docs"), F.sum("words")).first()
    return row[0] or 0, row[1] or 0


def weights(n: int, df: np.ndarray) -> np.ndarray:
    """floor(1000 ln((2 n + 2) / (2 df + 1))) of each document frequency."""
    return np.floor(1000 * np.log((2 * n + 2) / (2 * df + 1))).astype(np.int64)


class Queries:
    """A block of queries: their terms, sorted, and per query the positions and frequencies of its own."""

    def __init__(self, rows: list[tuple[int, list[int], list[int]]]):
        self.numbers = [r[0] for r in rows]
        self.terms = np.unique(np.concatenate([np.array(r[1], np.int64) for r in rows]))
        self.at = [np.searchsorted(self.terms, np.array(r[1], np.int64)) for r in rows]
        self.times = [np.array(r[2], np.int64) for r in rows]


class Searcher:
    """Best ``k`` documents of each query among the blocks shown to it.

    A document of n terms has m = 25 + 75 n N div L; a term of weight w and
    frequency f adds w * (10^9 f div (1000 f + 8 m)) for each time it is asked.
    """

    def __init__(self, queries: Queries, weight: np.ndarray, n_docs: int, n_words: int, k: int = K):
        self.q, self.n_docs, self.n_words, self.k = queries, n_docs, n_words, k
        self.weight = [weight[at] * times for at, times in zip(queries.at, queries.times)]
        self.best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in queries.at]
        self.seen = self.rescored = 0

    def _share(self, f: np.ndarray, m: np.ndarray) -> np.ndarray:
        return 1_000_000_000 * f // (1000 * f + 8 * m)

    def show(self, row: dict) -> None:
        """Take one block of the index into account."""
        n, slices = row["n"], row["slices"]
        length = np.frombuffer(row["lengths"], np.int64)
        if 75 * int(length.max()) * self.n_docs < 1 << 63:
            m = 25 + 75 * length * self.n_docs // self.n_words
        else:
            m = np.array([25 + 75 * x * self.n_docs // self.n_words for x in length.tolist()], np.int64)
        signature = np.frombuffer(row["signature"], np.uint8).reshape(slices, -1)
        exact = _Exact(row, self.q.terms)
        most = int(exact.tf.max())
        # marks[j][t]: documents that may have term t at least levels[j] times
        marks, steps, before = [], [], np.zeros(n, np.int64)
        alive = np.arange(len(self.q.terms))
        starts = levels(most)
        for j, _ in enumerate(starts):
            found = np.bitwise_and.reduce(signature[slices_of(self.q.terms[alive], j, slices)], axis=1)
            if j:
                found &= packed[np.searchsorted(kept, alive)]
            some = found.any(axis=1)
            alive, found = alive[some], found[some]
            if not len(alive):
                break
            packed, kept = found, alive
            place = np.full(len(self.q.terms), -1)
            place[alive] = np.arange(len(alive))
            marks.append((place, np.unpackbits(found, axis=1)[:, :n]))
            upto = starts[j + 1] - 1 if j + 1 < len(starts) else most
            share = self._share(np.full(n, min(upto, most)), m)
            steps.append(share - before)
            before = share
        if not marks:
            return
        ids = np.frombuffer(row["ids"], np.int64)
        for i, (at, w) in enumerate(zip(self.q.at, self.weight)):
            bound = np.zeros(n)
            for (place, bits), step in zip(marks, steps):
                mine = place[at]
                use = mine >= 0
                if not use.any():
                    break
                bound += step * (w[use].astype(float) @ bits[mine[use]])
            bound *= 1 + 1e-9  # rounding never lowers a bound below its score
            self.seen += n
            left = np.flatnonzero((bound > 0) & (bound >= self._bar(i)))
            if len(left) > 2 * self.k:
                first = np.argpartition(bound[left], -self.k)[-self.k :]
                self._score(i, left[first], exact, at, w, m, ids)
                left = np.delete(left, first)
                left = left[bound[left] >= self._bar(i)]
            if len(left):
                self._score(i, left, exact, at, w, m, ids)

    def _bar(self, i: int) -> int:
        scores = self.best[i][0]
        return int(scores[-1]) if len(scores) == self.k else 1

    def _score(self, i: int, docs: np.ndarray, exact: "_Exact", at: np.ndarray, w: np.ndarray, m: np.ndarray, ids: np.ndarray) -> None:
        self.rescored += len(docs)
        step = max(1, 2_000_000 // len(at))
        score = np.concatenate([self._sums(docs[s : s + step], exact, at, w, m) for s in range(0, len(docs), step)])
        old = self.best[i]
        score, ids = np.concatenate([old[0], score]), np.concatenate([old[1], ids[docs]])
        order = np.lexsort((ids, -score))
        order = order[score[order] > 0][: self.k]
        self.best[i] = score[order], ids[order]

    def _sums(self, docs: np.ndarray, exact: "_Exact", at: np.ndarray, w: np.ndarray, m: np.ndarray) -> np.ndarray:
        tf = exact.frequencies(docs, at)
        return (w * self._share(tf, m[docs][:, None])).sum(axis=1)


class _Exact:
    """The terms and frequencies that a block keeps, by document and query term."""

    def __init__(self, row: dict, terms: np.ndarray):
        vocab, bounds = np.frombuffer(row["vocab"], np.int64), np.frombuffer(row["bounds"], np.int64)
        self.tf, self.width = _read(row["tf"]), len(vocab)
        self.keys = np.repeat(np.arange(len(bounds) - 1) * self.width, np.diff(bounds)) + _read(row["entries"])
        place = np.minimum(np.searchsorted(vocab, terms), len(vocab) - 1)
        self.place = np.where(vocab[place] == terms, place, -1)

    def frequencies(self, docs: np.ndarray, at: np.ndarray) -> np.ndarray:
        place = self.place[at]
        keys = docs[:, None] * self.width + place
        found = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((place >= 0) & (self.keys[found] == keys), self.tf[found], 0)


def asked(queries: DataFrame, text: str, key: str) -> DataFrame:
    """``(q, key, terms, times)`` of every query that has a term, written to the shared folder."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        for batch in batches:
            found = [counts_of(raw.as_py(), known) for raw in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[1] for f in found], pa.list_(pa.int64())), pa.array([f[2] for f in found], pa.list_(pa.int64()))], names=["q", "terms", "times"]
            )

    scratch = Scratch(queries.sparkSession)
    rows = scratch.keep(queries.where(F.col(text).isNotNull()).select(F.monotonically_increasing_id().alias("q"), F.col(key).alias("key"), F.col(text).cast("binary").alias("t")))
    found = rows.select("q", "t").mapInArrow(count, "q bigint, terms array<bigint>, times array<bigint>").where(F.size("terms") > 0)
    return scratch.keep(rows.select("q", "key").join(found, "q"))


def _frequencies(blocks: DataFrame, terms) -> DataFrame:
    """``(t, df)``: in how many documents each term of the broadcast list occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(terms.value), np.int64)
        for batch in batches:
            for raw, entries in zip(batch.column(0), batch.column(1)):
                vocab = np.frombuffer(raw.as_py(), np.int64)
                place = np.minimum(np.searchsorted(vocab, terms.value), len(vocab) - 1)
                here = np.flatnonzero(vocab[place] == terms.value)
                total[here] += np.bincount(_read(entries.as_py()), minlength=len(vocab))[place[here]]
        t = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(t), pa.array(total[t])], names=["t", "df"])

    return blocks.select("vocab", "entries").mapInArrow(count, "t bigint, df bigint").groupBy("t").agg(F.sum("df").alias("df"))


def _pass(spark: SparkSession, blocks: DataFrame, queries: Queries, n_docs: int, n_words: int, k: int) -> DataFrame:
    """``(q, part, doc_id, score)``: per task the best ``k`` documents of each query of one block."""
    context = spark.sparkContext
    df = np.zeros(len(queries.terms), np.int64)
    for t, found in _frequencies(blocks, context.broadcast(queries.terms)).collect():  # at most one row per term of the block
        df[t] = found
    shared = context.broadcast((queries, weights(n_docs, df)))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(*shared.value, n_docs, n_words, k)
        for batch in batches:
            for i in range(batch.num_rows):
                searcher.show({name: column[i].as_py() for name, column in zip(batch.schema.names, batch.columns)})
        count = [len(b[0]) for b in searcher.best]
        scores, ids = (np.concatenate([b[i] for b in searcher.best]) for i in range(2))
        ids = pa.array(ids, mask=ids == NO_ID)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(shared.value[0].numbers), count)), ids, pa.array(scores)], names=["q", "doc_id", "score"])

    return blocks.drop("docs", "words").mapInArrow(best, "q bigint, doc_id bigint, score bigint").withColumn("part", F.spark_partition_id() % MERGE_TASKS)


def search(blocks: DataFrame, queries: DataFrame, k: int = K, text: str = "text", key: str = "item_id", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``(<key>, rank, doc_id, score)``: the best ``k`` documents of each row of ``queries`` with a score above 0."""
    spark = blocks.sparkSession
    n_docs, n_words = totals(blocks)
    rows = asked(queries, text, key)
    size = rows.agg(F.sum(F.size("terms"))).first()[0] or 0
    if not n_docs or not size:
        return rows.select(F.col("key").alias(key), F.lit(1).alias("rank"), F.lit(0).cast("bigint").alias("doc_id"), F.lit(0).cast("bigint").alias("score")).limit(0)
    n_blocks = math.ceil(size / block_terms)
    found = None
    for b in range(n_blocks):
        block = rows.where(F.pmod(F.xxhash64("q"), F.lit(n_blocks)) == b).select("q", "terms", "times").collect()  # about BLOCK_TERMS terms
        if block:
            part = _pass(spark, blocks, Queries([tuple(r) for r in block]), n_docs, n_words, k)
            found = part if found is None else found.unionByName(part)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    for by in (["q", "part"], ["q"]):  # no group has more than k rows of a task or of a part
        found = found.withColumn("rank", F.row_number().over(W.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)
    return found.join(rows.select("q", "key"), "q").select(F.col("key").alias(key), "rank", "doc_id", "score")
