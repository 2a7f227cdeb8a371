"""Benchmark decontamination by size-partitioned MinHash containment search.

A text contains an item if it has a share of at least ``threshold`` of the
item's distinct five-word shingles, wherever they stand in the text.

Items are partitioned by the number of their shingles: class u = 1, 2, 4, ..
holds items of more than u/2 and at most u.  A text is read through windows of
2u shingles that start every u, so what stands in a stretch of u shingles lies
inside one window, and containment becomes a Jaccard similarity with the window
that has a lower bound for each class, whatever the length of the text.  From
that bound and ``recall`` follows how many bands of one minimum a class has; a
window is a candidate if it shares any with an item.  All classes share the
functions: minima over u shingles give those over 2u.

What the bands can miss, by chance or because the shingles of an item stand
further apart than its window is long, is found exactly: an item of s shingles
misses at most s - ceil(threshold s) of them, so among any
s - ceil(threshold s) + 1 of its shingles one is in the text.  Those that are
rarest among the items are looked up for each item.

Candidates of both ways are verified by exact containment in the whole text.

Items are taken in blocks of ``block_items``, so what is broadcast has a fixed
bound; each block is one pass over the texts, and the rows are never paired.

Words are runs of letters and digits in lower case.  Defined cases: null and empty texts contain nothing;
null or wordless items are contained nowhere; an item of fewer than five words
is one shingle of its whole sequence, looked up among the shingles of that
many words; repeated rows are reported each; repeated items each.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import text_groups

WIDTH = 5
THRESHOLD = 0.8
RECALL = 0.999  # of the bands, for items that stand in one window
BLOCK_ITEMS = 10_000
FILTER_BITS = 20  # of a hash, to pass over shingles of no item


def words_of(text: str) -> list[str]:
    """Runs of letters and digits in lower case."""
    return WORD.findall(text.lower())


WORD = re.compile(r"[^\W_]+")
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, and where those of each text begin (one bound more than texts).

    The hash is a polynomial in the code points, so the difference of two
    prefix sums, moved back to power zero, is the hash of the word between.
    """
    parts = [t.lower() for t in texts]
    begins = np.cumsum([1] + [len(p) + 1 for p in parts])
    codes = np.frombuffer((" " + " ".join(parts) + "  ").encode("utf-32-le", "surrogatepass"), np.uint32)
    present = np.flatnonzero(np.bincount(codes))
    value = np.zeros(int(present[-1]) + 1, np.uint64)
    for c in present:
        if chr(c).isalnum():
            value[c] = c + 1
    codes = value[codes]
    inside = codes != 0
    edge = inside[1:] != inside[:-1]
    turns = np.flatnonzero(edge) + 1
    first, last = turns[::2], turns[1::2]
    sums = np.cumsum(codes * _powers(BASE, len(codes)))
    h = (sums[last - 1] - sums[first - 1]) * _powers(INVERSE, len(codes))[first]
    return _mix(h), np.searchsorted(first, begins)


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of each text, and where those of each text begin."""
    count = np.maximum(np.diff(bounds) - width + 1, 0)
    n = max(0, len(words) - width + 1)
    out = np.full(n, width, np.uint64)
    for i in range(width):
        out = out * np.uint64(BASE) + words[i : i + n]
    ends = np.concatenate([[0], np.cumsum(count)])
    at = np.arange(ends[-1]) + np.repeat(bounds[:-1] - ends[:-1], count)
    return _mix(out[at]), ends


def _spot(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def bands_needed(size: int, threshold: float, recall: float) -> int:
    """Bands of one minimum by which a contained item of class ``size`` meets its window with probability ``recall``."""
    lowest = size // 2 + 1
    needed = max(1, math.ceil(threshold * lowest - 1e-9))
    similarity = needed / (2 * size + lowest - needed)
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity))


def _coefficients(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Those of the first ``count`` functions, the same for every count."""
    a, b = (np.random.default_rng(seed).integers(0, 2**63, count, dtype=np.uint64) for seed in (10, 11))
    return a * np.uint64(2) + np.uint64(1), b


def _minimum_spot(low: np.ndarray) -> np.ndarray:
    return ((low >> np.uint64(20)) & np.uint64(0xFFFF)).astype(np.int64)


class Partition:
    """The items of one class, with a sorted list of minima for every band."""

    def __init__(self, size: int, members: list[tuple[int, np.ndarray]], threshold: float, recall: float):
        self.bands = bands_needed(size, threshold, recall)
        self.owners = np.array([i for i, _ in members])
        a, b = _coefficients(self.bands)
        table = np.stack([(h[:, None] * a + b).min(axis=0) for _, h in members])
        self.order = np.argsort(table, axis=0, kind="stable")
        self.minima = np.take_along_axis(table, self.order, 0)
        self.bits = np.zeros((self.bands, 1 << 16), bool)
        for band in range(self.bands):
            self.bits[band, _minimum_spot(table[:, band])] = True

    def sharing(self, band: int, windows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """``(window, items)`` that share the minimum of a band."""
        at = np.flatnonzero(self.bits[band][_minimum_spot(windows)])
        column = self.minima[:, band]
        left, right = np.searchsorted(column, windows[at], "left"), np.searchsorted(column, windows[at], "right")
        for i in np.flatnonzero(left < right):
            yield at[i], self.owners[self.order[left[i] : right[i], band]]


def _blocks_of(counts: np.ndarray, sizes: list[int]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per class size, doubling: where blocks begin among the blocks of half the size, the text of each, and which end a text."""
    out, size, step = {}, sizes[0], sizes[0]
    while size <= sizes[-1]:
        blocks = -(-counts // step)
        ends = np.cumsum(blocks)
        below = np.cumsum(counts) - counts
        owner = np.repeat(np.arange(len(counts)), blocks)
        starts = (np.arange(ends[-1]) - np.repeat(ends - blocks, blocks)) * step + below[owner]
        last = np.zeros(int(ends[-1]), bool)
        last[ends[blocks > 0] - 1] = True
        out[size] = starts, owner, last
        counts, size, step = blocks, size * 2, 2
    return out


class Index:
    """Items of one block: by class for the bands, and with a sorted list of the shingles looked up for them."""

    def __init__(self, items: list[tuple], width: int, threshold: float, recall: float = RECALL):
        self.threshold, self.items, hashed = threshold, [], {}
        for key, text in items:
            words = words_of(text or "")
            if not words:
                continue
            n = min(width, len(words))
            hashed.setdefault(n, []).append((len(self.items), np.unique(shingle_hashes(*word_hashes([text]), n)[0])))
            self.items.append((key, n, {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}))
        self.sought, self.classes = {}, {}
        for n, members in hashed.items():
            sizes: dict[int, list] = {}
            for i, h in members:
                sizes.setdefault(1 << (len(h) - 1).bit_length(), []).append((i, h))
            self.classes[n] = {size: Partition(size, some, threshold, recall) for size, some in sorted(sizes.items())}
            known, count = np.unique(np.concatenate([h for _, h in members]), return_counts=True)
            keys, owners = [], []
            for i, h in members:
                spare = len(h) - math.ceil(threshold * len(h) - 1e-9)
                rarest = h[np.argsort(count[np.searchsorted(known, h)], kind="stable")][: spare + 1]
                keys.append(rarest)
                owners.append(np.full(len(rarest), i))
            keys, owners = np.concatenate(keys), np.concatenate(owners)
            order = np.argsort(keys, kind="stable")
            bits = np.zeros(1 << FILTER_BITS, bool)
            bits[_spot(keys)] = True
            self.sought[n] = keys[order], owners[order], bits

    def by_bands(self, h: np.ndarray, ends: np.ndarray, n: int, found: dict[int, set[int]]) -> None:
        """Items that share a minimum with a window of a text, from the shingles of ``n`` words of all texts."""
        partitions = self.classes[n]
        if not len(h):
            return
        blocks = _blocks_of(np.diff(ends), list(partitions))
        a, b = _coefficients(max(p.bands for p in partitions.values()))
        for band in range(len(a)):
            low = h * a[band] + b[band]
            for size, (starts, owner, last) in blocks.items():
                low = np.minimum.reduceat(low, starts)
                if size in partitions and band < partitions[size].bands:
                    windows = low.copy()
                    np.minimum(low[:-1], low[1:], out=windows[:-1], where=~last[:-1])
                    for w, owners in partitions[size].sharing(band, windows):
                        found.setdefault(int(owner[w]), set()).update(owners.tolist())

    def by_shingles(self, h: np.ndarray, ends: np.ndarray, n: int, found: dict[int, set[int]]) -> None:
        """Items of which a text has a shingle that is looked up."""
        keys, owners, bits = self.sought[n]
        at = np.flatnonzero(bits[_spot(h)])
        left, right = np.searchsorted(keys, h[at], "left"), np.searchsorted(keys, h[at], "right")
        hit = np.flatnonzero(left < right)
        text = np.searchsorted(ends, at[hit], "right") - 1
        # A shingle counts once per text.
        for d, x, y in sorted(set(zip(text.tolist(), left[hit].tolist(), right[hit].tolist()))):
            found.setdefault(d, set()).update(owners[x:y].tolist())

    def candidates(self, texts: list[str]) -> dict[int, set[int]]:
        """Per text the items of either way."""
        found: dict[int, set[int]] = {}
        words, bounds = word_hashes(texts)
        for n in self.sought:
            h, ends = shingle_hashes(words, bounds, n)
            self.by_bands(h, ends, n, found)
            self.by_shingles(h, ends, n, found)
        return found

    def contained(self, texts: list[str]) -> Iterator[tuple]:
        """``(text, item key, containment, first word)`` for the items contained in the texts."""
        for d, items in sorted(self.candidates(texts).items()):
            words = words_of(texts[d])
            for i in sorted(items):
                key, n, shingles = self.items[i]
                where: dict[tuple, int] = {}
                for j in range(len(words) - n + 1):
                    s = tuple(words[j : j + n])
                    if s in shingles and s not in where:
                        where[s] = j
                share = len(where) / len(shingles)
                if share >= self.threshold:
                    yield d, key, share, min(where.values())


def _blocks(items: DataFrame, item_text: str, item_key: str, block_items: int) -> Iterator[list[tuple]]:
    """The items with a text, dealt by a hash into blocks of about ``block_items``."""
    listed = items.select(F.col(item_key).alias("k"), F.col(item_text).alias("t")).where("t IS NOT NULL")
    blocks = max(1, -(-listed.count() // block_items))
    for block in range(blocks):
        yield [tuple(r) for r in listed.where(F.pmod(F.xxhash64("k", "t"), F.lit(blocks)) == block).collect()]


def search(
    docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", item_text: str = "text", item_key: str = "item_id",
    width: int = WIDTH, threshold: float = THRESHOLD, block_items: int = BLOCK_ITEMS, recall: float = RECALL,
) -> DataFrame:
    """``(key, item_key, containment, first_word)`` of every text that contains an item."""
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).where("t IS NOT NULL")
    out = T.StructType(
        [T.StructField(key, rows.schema["k"].dataType), T.StructField(item_key, items.schema[item_key].dataType), T.StructField("containment", T.DoubleType()), T.StructField("first_word", T.LongType())]
    )
    kinds = [to_arrow_type(f.dataType) for f in out[1:]]
    found = None
    for taken in _blocks(items, item_text, item_key, block_items):
        sent = docs.sparkSession.sparkContext.broadcast(taken)

        def look(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = Index(sent.value, width, threshold, recall)
            for batch in batches:
                texts, at, hits = batch.column(1).to_pylist(), [], []
                for a, b in text_groups(texts):
                    for d, *hit in index.contained(texts[a:b]):
                        at.append(a + d)
                        hits.append(hit)
                columns = [batch.column(0).take(pa.array(at, pa.int64())), *(pa.array([h[j] for h in hits], kind) for j, kind in enumerate(kinds))]
                yield pa.RecordBatch.from_arrays(columns, names=out.names)

        one = rows.mapInArrow(look, out)
        found = one if found is None else found.unionByName(one)
    return found


def clean(
    docs: DataFrame, items: DataFrame, text: str = "text", item_text: str = "text", item_key: str = "item_id",
    width: int = WIDTH, threshold: float = THRESHOLD, block_items: int = BLOCK_ITEMS, recall: float = RECALL,
) -> DataFrame:
    """The rows of ``docs`` that contain no item, without a shuffle; a row with a null text stays."""
    for taken in _blocks(items, item_text, item_key, block_items):
        free = _free_of(docs.sparkSession.sparkContext.broadcast(taken), width, threshold, recall)
        docs = docs.where(free.asNondeterministic()(F.col(text)))
    return docs


def _free_of(sent, width: int, threshold: float, recall: float):
    """A function that tells whether a text contains none of the items sent."""

    @F.pandas_udf("boolean")
    def free(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = Index(sent.value, width, threshold, recall)
        for batch in batches:
            texts = [t if t is not None else "" for t in batch]
            out = np.ones(len(texts), bool)
            for a, b in text_groups(texts):
                out[[a + d for d, *_ in index.contained(texts[a:b])]] = False
            yield pd.Series(out)

    return free
