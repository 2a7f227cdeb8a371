"""Repeated passages: MinHash banding over paragraphs, exact verification, components.

A paragraph is a sentence or line of at least ``WIDTH`` words: words in a row
with no line break and no sentence mark before white space between them.
Shorter ones are passed over and do not interrupt a run.

1. One pass over the texts gives the distinct paragraphs with a 64-bit content
   hash, their number and one minimum per band (the fewest bands of one row
   that reach ``recall`` at ``threshold``).
2. Paragraphs that share a band are joined.  A bucket of up to ``bucket``
   distinct paragraphs is verified in its row and gives a spanning forest of
   the links; the members of fuller ones are banded anew by more minima first.
3. A second pass gives the places, and the shingles where needed, of the
   paragraphs that occur twice or collide.  A Bloom filter of fixed size goes
   with it; an exact join follows.
4. Links of Jaccard similarity ``threshold`` or more over five-word shingles
   are closed to components.  A paragraph whose component occurs twice or more
   is repeated; runs of repeated paragraphs with ``run_words`` words or more
   are reported, and whether the run is the first to show all its paragraphs.
   Its parts tell the same of each paragraph: removing the parts that are not
   first takes no class's first copy, removing whole runs can.

Defined cases: null and empty texts have no paragraphs; equal paragraphs inside
one document count as repeated; repeated rows repeat all their paragraphs; the
first occurrence is that of the smallest id, null ids last, then the first
row; a table without repetition gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from .common import Scratch, text_groups
from .components import components
from .containment import BASE, INVERSE, _mix, _powers

WIDTH = 5
THRESHOLD = 0.8
RECALL = 0.99
BUCKET = 512
RUN_WORDS = 20
BLOOM_BITS = 1 << 25
MARKS = ".!?…。！？"
FULLER_ROWS = (8, 16)  # minima per band for the members of buckets that are too full


def bands_needed(threshold: float, recall: float) -> int:
    """Bands of one minimum each so that similarity ``threshold`` collides with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold) - 1e-9)


class Paragraphs:
    """The paragraphs of some texts: text number, number within the text, start, end, words, content hash, and the word hashes."""

    def __init__(self, texts: list[str], width: int = WIDTH):
        begins = np.cumsum([1] + [len(t) + 1 for t in texts])
        codes = np.frombuffer((" " + "\n".join(texts) + "\n ").encode("utf-32-le", "surrogatepass"), np.uint32)
        present = np.flatnonzero(np.bincount(codes))
        kind, value = np.zeros(int(present[-1]) + 1, np.uint8), np.zeros(int(present[-1]) + 1, np.uint64)
        for c in present:
            s = chr(c)
            if s.isalnum():
                low = s.lower()
                value[c] = ord(low) if len(low) == 1 else c
            kind[c] = 3 if s == "\n" else 2 if s in MARKS else 1 if s.isspace() else 0
        kinds, codes = kind[codes], value[codes]
        inside = codes != 0
        turns = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        first, last = turns[::2], turns[1::2]
        stop = kinds == 3
        stop[:-1] |= (kinds[:-1] == 2) & (kinds[1:] & 1 == 1)
        stops = np.cumsum(stop)
        sums = np.cumsum(codes * _powers(BASE, len(codes)))
        self.words = _mix((sums[last - 1] - sums[first - 1]) * _powers(INVERSE, len(codes))[first])
        unit = stops[first]
        head = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]])) if len(first) else np.zeros(0, np.int64)
        size = np.diff(np.append(head, len(first)))
        head, size = head[size >= width], size[size >= width]
        self.head, self.size, self.width = head, size, width
        self.text = np.searchsorted(begins, first[head], "right") - 1 if len(head) else np.zeros(0, np.int64)
        fresh = np.concatenate([[True], self.text[1:] != self.text[:-1]]) if len(head) else np.zeros(0, bool)
        self.number = np.arange(len(head)) - np.repeat(np.flatnonzero(fresh), np.diff(np.append(np.flatnonzero(fresh), len(head)))) if len(head) else head
        self.start = first[head] - begins[self.text]
        self.end = last[head + size - 1] - begins[self.text]
        # The content: a polynomial in the word hashes, mixed with the length.
        whole = np.concatenate([[np.uint64(0)], np.cumsum(self.words * _powers(BASE, len(self.words)))])
        self.hash = _mix((whole[head + size] - whole[head]) * _powers(INVERSE, len(self.words) + 1)[head] + size.astype(np.uint64) * np.uint64(BASE)).view(np.int64)

    def shingles(self, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the shingles of some paragraphs, and where those of each begin."""
        n = max(0, len(self.words) - self.width + 1)
        h = np.full(n, self.width, np.uint64)
        for i in range(self.width):
            h = h * np.uint64(BASE) + self.words[i : i + n]
        count = self.size[of] - self.width + 1
        ends = np.concatenate([[0], np.cumsum(count)])
        return _mix(h[np.arange(ends[-1]) + np.repeat(self.head[of] - ends[:-1], count)]), ends[:-1]

    def minima(self, of: np.ndarray, count: int) -> np.ndarray:
        """``count`` minima of each paragraph, one per hash function."""
        if not len(of):
            return np.zeros((0, count), np.int64)
        h, begins = self.shingles(of)
        return np.stack([np.minimum.reduceat(_mix(h + np.uint64((i + 1) * BASE % 2**64)), begins).view(np.int64) for i in range(count)], axis=1)


def _distinct(docs: DataFrame, bands: int) -> DataFrame:
    """``(h, n, m0, m1, ...)``: each distinct paragraph, its number and its minima; combined per batch before the shuffle."""
    names = [f"m{i}" for i in range(bands)]
    schema = "h bigint, n bigint, " + ", ".join(f"{m} bigint" for m in names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = [t or "" for t in batch.column(0).to_pylist()], []
            for a, b in text_groups(texts):
                p = Paragraphs(texts[a:b])
                found.append(np.column_stack([p.hash, p.minima(np.arange(len(p.hash)), bands)]))
            rows = np.concatenate(found) if found else np.zeros((0, bands + 1), np.int64)
            order = np.argsort(rows[:, 0])
            rows = rows[order]
            head = np.flatnonzero(np.concatenate([[True], rows[1:, 0] != rows[:-1, 0]])) if len(rows) else np.zeros(0, np.int64)
            n = np.diff(np.append(head, len(rows)))
            yield pa.RecordBatch.from_arrays([pa.array(rows[head, 0]), pa.array(n.astype(np.int64)), *(pa.array(rows[head, i + 1]) for i in range(bands))], names=["h", "n", *names])

    return docs.select("text").mapInArrow(read, schema).groupBy("h").agg(F.sum("n").alias("n"), *[F.first(m).alias(m) for m in names])


def _bloom(hashes: DataFrame, bits: int) -> np.ndarray:
    """A Bloom filter of fixed size over a column ``h``, as words of 64 bits."""
    spots = F.explode(F.array(F.col("h").bitwiseAND(bits - 1), F.shiftrightunsigned("h", 64 - bits.bit_length() + 1).bitwiseAND(bits - 1)))
    spot = hashes.select(spots.alias("p"))
    words = spot.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("p").bitwiseAND(63).cast("int"))).alias("v")).toPandas()
    out = np.zeros(bits // 64, np.uint64)
    out[words["w"].to_numpy(np.int64)] = words["v"].to_numpy(np.int64).view(np.uint64)
    return out


def _maybe(bloom: np.ndarray, h: np.ndarray) -> np.ndarray:
    bits, u = 64 * len(bloom), h.view(np.uint64)
    one, two = u & np.uint64(bits - 1), (u >> np.uint64(64 - bits.bit_length() + 1)) & np.uint64(bits - 1)
    has = lambda p: bloom[p >> np.uint64(6)] >> (p & np.uint64(63)) & np.uint64(1)
    return (has(one) & has(two)).astype(bool)


def _places(docs: DataFrame, wanted: DataFrame, collided: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Places of the paragraphs in ``wanted``, and the shingles of those in ``collided``; both are columns ``h``."""
    context, scratch = docs.sparkSession.sparkContext, Scratch(docs.sparkSession)
    sent = context.broadcast((_bloom(wanted, BLOOM_BITS), _bloom(collided, BLOOM_BITS)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated, near = sent.value
        for batch in batches:
            texts, out, shingles = [t or "" for t in batch.column(2).to_pylist()], [], []
            for a, b in text_groups(texts):
                p = Paragraphs(texts[a:b])
                seen = np.flatnonzero(_maybe(repeated, p.hash))
                close = _maybe(near, p.hash[seen])
                h, begins = p.shingles(seen[close])
                parts = iter(np.split(h.view(np.int64), begins[1:]))
                shingles += [np.unique(next(parts)) if c else None for c in close.tolist()]
                out.append(np.column_stack([p.text[seen] + a, p.number[seen], p.start[seen], p.end[seen], p.size[seen], p.hash[seen]]))
            rows = np.concatenate(out) if out else np.zeros((0, 6), np.int64)
            at = pa.array(rows[:, 0])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), *(pa.array(rows[:, i]) for i in range(1, 6)), pa.array(shingles, pa.list_(pa.int64()))], names=out_type.names)

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "id", "text")
    out_type = T.StructType([T.StructField("row", T.LongType()), T.StructField("id", rows.schema["id"].dataType), *(T.StructField(n, T.LongType()) for n in ("number", "start", "end", "words", "h")), T.StructField("shingles", T.ArrayType(T.LongType()))])
    found = scratch.keep(rows.mapInArrow(read, out_type))
    sets = found.where("shingles IS NOT NULL").groupBy("h").agg(F.first("shingles").alias("shingles")).join(collided, "h", "left_semi")
    return found.drop("shingles"), sets


def _verify(batches: Iterator[pd.DataFrame], threshold: float) -> Iterator[pd.DataFrame]:
    """For each bucket the links of a spanning forest over its pairs of enough Jaccard similarity."""
    for batch in batches:
        a, b = [], []
        for members in batch["members"]:
            sets = [(m["h"], frozenset(m["shingles"])) for m in members]
            sets.sort(key=lambda s: len(s[1]))
            root = list(range(len(sets)))

            def top(i):
                while root[i] != i:
                    root[i] = root[root[i]]
                    i = root[i]
                return i

            for i, (h, s) in enumerate(sets):
                for j in range(i + 1, len(sets)):
                    g, t = sets[j]
                    if len(s) < threshold * len(t) - 1e-9:
                        break
                    if top(i) != top(j):
                        common = len(s & t)
                        if common >= threshold * (len(s) + len(t) - common) - 1e-9:
                            root[top(j)] = top(i)
                            a.append(h)
                            b.append(g)
        yield pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})


def _again(members: DataFrame, rows: int, bands: int) -> DataFrame:
    """``(key, h)``: bands of ``rows`` minima over the shingles of ``members`` (``h``, ``shingles``)."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        salt = [np.uint64((i + 1) * INVERSE % 2**64) for i in range(rows * bands)]
        for batch in batches:
            keys = []
            for shingles in batch["shingles"]:
                x = np.asarray(shingles, np.int64).view(np.uint64)
                low = np.array([_mix(x ^ f).min() for f in salt]).reshape(bands, rows)
                key = np.arange(bands, dtype=np.uint64) + np.uint64(rows << 32)
                for r in range(rows):
                    key = _mix(key * np.uint64(BASE) + low[:, r])
                keys.append(key)
            yield pd.DataFrame({"key": np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64), "h": np.repeat(batch["h"].to_numpy(), bands)})

    return members.mapInPandas(read, "key bigint, h bigint")


def _links(keyed: DataFrame, sets: DataFrame, threshold: float, recall: float, bucket: int) -> DataFrame:
    """Verified links ``(a, b)`` of the buckets in ``keyed`` (``key``, ``h``, both whole numbers).

    Buckets of up to ``bucket`` members are verified at once.  The members of
    fuller ones are banded anew with more rows to a band (and as many bands as
    ``recall`` asks), which parts those that only share a shingle or two.  What
    stays too full after that is compared exactly, block of members against
    block of members.
    """
    scratch, found = Scratch(keyed.sparkSession), []

    def verified(groups: DataFrame, *keys: str) -> None:
        lists = groups.groupBy(*keys).agg(F.collect_list(F.struct("h", "shingles")).alias("members")).select("members")  # at most two blocks
        found.append(scratch.keep(lists.mapInPandas(lambda batches: _verify(batches, threshold), "a bigint, b bigint")))

    for rows in (*FULLER_ROWS, None):
        sizes = scratch.keep(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
        verified(keyed.join(sizes.where(F.col("n") <= bucket).select("key"), "key").join(sets, "h"), "key")
        full = sizes.where(F.col("n") > bucket)
        if full.isEmpty():
            break
        if rows:
            crowded = keyed.join(full.select("key"), "key", "left_semi").select("h").distinct().join(sets, "h")
            keyed = scratch.keep(_again(crowded, rows, bands_needed(threshold**rows, recall)))
            continue
        half = max(1, bucket // 2)
        blocked = keyed.join(full, "key").withColumn("blocks", F.ceil(F.col("n") / half)).withColumn("mine", F.pmod(F.xxhash64("h"), F.col("blocks")))
        other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
        met = blocked.select("key", "h", "mine", other.alias("other")).select("key", "h", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))
        verified(met.join(sets, "h"), "key", "i", "j")
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.distinct()


def repeated(docs: DataFrame, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD, recall: float = RECALL, bucket: int = BUCKET, run_words: int = RUN_WORDS) -> DataFrame:
    """``(key, start, end, words, paragraphs, class_id, first, parts)`` per run of repeated paragraphs, ``parts`` being ``(start, end, words, class_id, first)`` of each; ``class_id`` is the smallest of them."""
    scratch, bands = Scratch(docs.sparkSession), bands_needed(threshold, recall)
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    distinct = scratch.keep(_distinct(rows, bands))
    keys = F.array(*[F.xxhash64(F.lit(i), F.col(f"m{i}")) for i in range(bands)])
    # The count comes with the rows, so the keys, nearly all of one paragraph, are shuffled once.
    sharing = F.count(F.lit(1)).over(W.partitionBy("key"))
    keyed = scratch.keep(distinct.select("h", F.explode(keys).alias("key")).withColumn("sharing", sharing).where("sharing > 1").select("key", "h"))
    collided = scratch.keep(keyed.select("h").distinct())
    wanted = distinct.where("n > 1").select("h").union(collided).distinct()
    places, sets = _places(rows, wanted, collided)
    roots = components(_links(keyed, scratch.keep(sets), threshold, recall, bucket), "a", "b").withColumnRenamed("node", "h")
    roots = scratch.keep(roots)
    scratch.drop(keyed)
    named = distinct.where("n > 1").select("h").union(roots.select("h")).distinct().join(roots, "h", "left").select("h", F.coalesce("root", "h").alias("class_id"))
    members = scratch.keep(places.join(scratch.keep(named), "h"))  # two plain shuffles, so a frequent paragraph can be split
    scratch.drop(distinct)
    order = F.struct(F.col("id").isNull().alias("late"), F.col("id").alias("id"), F.col("row").alias("row"), F.col("number").alias("number"))
    firsts = scratch.keep(members.groupBy("class_id").agg(F.min(order).alias("least")))
    shown = members.join(firsts, "class_id").withColumn("own", (F.col("least.row") == F.col("row")) & (F.col("least.number") == F.col("number")))
    # Neighbours in a run have consecutive numbers; a window holds one document.
    run = F.col("number") - F.row_number().over(W.partitionBy("row").orderBy("number"))
    part = F.struct("start", "end", "words", "class_id", F.col("own").alias("first"))
    runs = shown.withColumn("run", run).groupBy("row", "id", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.sum("words").alias("words"), F.count(F.lit(1)).alias("paragraphs"), F.min("class_id").alias("class_id"), F.min("own").alias("first"), F.sort_array(F.collect_list(part)).alias("parts")
    )
    return runs.where(F.col("words") >= run_words).select(F.col("id").alias(key), "start", "end", "words", "paragraphs", "class_id", "first", "parts")
