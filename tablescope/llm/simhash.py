"""SimHash near-duplicates with a pigeonring filter.

The fingerprint of a text has a bit set if more than half of the XXH64 values
(seed 42) of its 3-word shingles have it.  Two fingerprints link at
``distance`` or fewer differing bits, and a group is a connected component.

Candidates come from the pigeonring principle: cut the 64 bits into a ring of
m segments.  If two fingerprints differ in at most d bits, there is a segment
from which every chain of l consecutive segments differs in at most l*d/m
bits.  With m > d the first segments of that chain, as long as the quota is
below one, are equal, so they are the join key; the longer chains are tested
before the whole distance is.

Only distinct fingerprints take part.  A key shared by up to ``bucket``
fingerprints is compared inside its row, in blocks, and gives a spanning
forest of its links, not all pairs.  Fingerprints of fuller keys are linked
exactly and without pairs: both are within one bit of a common value exactly
if they differ in at most two, so each is joined with its 65 neighbours.  That
way needs ``distance`` = 2.

Defined cases: a text without words (null, empty, white space) has fingerprint
zero and links like any other; fewer than three words are one shingle;
repeated rows link; a null id never names a group (a group of null ids only
has a null name).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import Scratch, fresh
from .components import components

WIDTH = 3
SEED = 42
DISTANCE = 2
SEGMENTS = 8
BUCKET = 512
BLOCK = 50_000  # shingles counted at once


def fingerprint_of(text: str, width: int = WIDTH, seed: int = SEED) -> int:
    """The fingerprint of one text, unsigned."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").translate(LOWER).split()  # bytes split at 0x20 and 0x09-0x0D
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - width + 1)
    first, last = begins[:n].tolist(), (ends[width - 1 :] if len(words) >= width else ends[-1:]).tolist()
    ones = np.zeros(64, np.int64)
    for s in range(0, n, BLOCK):
        h = [xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in zip(first[s : s + BLOCK], last[s : s + BLOCK])]
        bits = np.unpackbits(np.array(h, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def with_fingerprint(docs: DataFrame, text: str = "text", column: str = "fingerprint", width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """``docs`` with the fingerprint of each text as a signed 64-bit number."""

    @F.pandas_udf("bigint")
    def made(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint_of(t, width, seed) if t else 0 for t in texts], np.uint64).view(np.int64))

    return docs.withColumn(column, made.asNondeterministic()(F.col(text)))


def _cuts(segments: int) -> list[int]:
    return [64 * i // segments for i in range(segments + 1)]


def _chain(segments: int, distance: int) -> int:
    """Segments at the head of a chain that have to be equal: those whose quota is below one."""
    return max(1, -(-segments // distance) - 1)


def ring_keys(prints: DataFrame, segments: int = SEGMENTS, distance: int = DISTANCE) -> DataFrame:
    """``(start, key, fp)``: for each segment of the ring the bits of the chain that begins there."""
    cuts, length, keys = _cuts(segments), _chain(segments, distance), []
    for s in range(segments):
        mask = sum(((1 << cuts[(s + i) % segments + 1]) - (1 << cuts[(s + i) % segments])) for i in range(length))
        signed = mask - (1 << 64) if mask >= 1 << 63 else mask
        keys.append(F.struct(F.lit(s).alias("start"), F.col("fp").bitwiseAND(F.lit(signed)).alias("key")))
    return prints.select("fp", F.explode(F.array(*keys)).alias("k")).select("k.start", "k.key", "fp")


def _forest(batches: Iterator[pd.DataFrame], segments: int, distance: int) -> Iterator[pd.DataFrame]:
    """For each bucket the links of a spanning forest over the pairs that pass the chain test and the full test."""
    cuts, length = _cuts(segments), _chain(segments, distance)
    for batch in batches:
        out_a, out_b = [], []
        for start, prints in zip(batch["start"].tolist(), batch["prints"]):
            p = np.sort(np.asarray(prints, np.int64))
            u, root = p.view(np.uint64), np.arange(len(p))
            for i in range(len(p) - 1):
                x = u[i + 1 :] ^ u[i]
                seen, ok = np.zeros(len(x), np.uint8), np.ones(len(x), bool)
                for step in range(segments):
                    at = (start + step) % segments
                    mask = np.uint64((1 << cuts[at + 1]) - (1 << cuts[at]))
                    if step >= length:
                        seen += np.bitwise_count(x & mask)
                        ok &= seen * segments <= (step + 1) * distance
                near = np.flatnonzero(ok & (np.bitwise_count(x) <= distance)) + i + 1
                for j in near.tolist():
                    if root[i] != root[j]:
                        out_a.append(int(p[i]))
                        out_b.append(int(p[j]))
                        root[root == root[j]] = root[i]
        yield pd.DataFrame({"a": np.array(out_a, np.int64), "b": np.array(out_b, np.int64)})


def links(prints: DataFrame, segments: int = SEGMENTS, distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """Pairs ``(a, b)`` of distinct fingerprints (column ``fp``) whose components are those of all links."""
    if distance != 2:
        raise ValueError("fuller buckets are linked by common neighbours, which needs distance 2")
    scratch = Scratch(prints.sparkSession)
    keys = ring_keys(prints, segments, distance)
    # Keys of one fingerprint need no comparison; counts are combined before the shuffle.
    shared = scratch.keep(keys.groupBy("start", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    small, full = shared.where(F.col("n") <= bucket), shared.where(F.col("n") > bucket)
    members = keys.join(small.select("start", "key"), ["start", "key"])
    lists = members.groupBy("start", "key").agg(F.collect_list("fp").alias("prints")).select("start", "prints")  # at most ``bucket`` each
    found = lists.mapInPandas(lambda batches: _forest(batches, segments, distance), "a bigint, b bigint")
    crowded = keys.join(full.select("start", "key"), ["start", "key"], "left_semi").select("fp").distinct()
    flips = F.array(F.lit(0), *[F.lit((1 << i) - (1 << 64) if i == 63 else 1 << i) for i in range(64)])
    near = crowded.select("fp", F.explode(flips).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("middle"))
    least = near.groupBy("middle").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1").select("middle", "a")
    hubs = near.join(least, "middle").where("fp != a").select("a", F.col("fp").alias("b"))
    return found.unionByName(hubs).distinct()


def groups(prints: DataFrame, **options) -> DataFrame:
    """``(fp, root)`` for every distinct fingerprint (column ``fp``): the smallest fingerprint of its component."""
    roots = Scratch(prints.sparkSession).keep(components(links(prints, **options), "a", "b"))
    return prints.select("fp").join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def classes(docs: DataFrame, key: str = "doc_id", fingerprint: str = "fingerprint") -> DataFrame:
    """``(fp, component_id)`` for every distinct fingerprint: the smallest id of a row reachable from it."""
    prints = Scratch(docs.sparkSession).keep(docs.groupBy(F.col(fingerprint).alias("fp")).agg(F.min(key).alias("least")))
    rooted = groups(prints).join(prints, "fp")
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.select("fp", "root").join(names, "root").select("fp", "component_id")


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each group: that of the smallest id, null ids last, the first row among equal ids."""
    scratch = Scratch(docs.sparkSession)
    row, fp = fresh(docs, "_row", "_fp")
    rows = scratch.keep(with_fingerprint(docs, text, fp).withColumn(row, F.monotonically_increasing_id()))
    order = F.struct(F.col(key).isNull().alias("late"), F.col(key).alias("id"), F.col(row).alias("row"))
    prints = scratch.keep(rows.groupBy(F.col(fp).alias("fp")).agg(F.min(order).alias("first")))
    kept = groups(prints).join(prints, "fp").groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias(row))
    return rows.join(kept, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
