"""Secrets in texts, and weak candidates confirmed by the parts around them.

Strong patterns (an assignment, an access key, a long hexadecimal run) are
always reported.  Weak ones (a user or client name, a base64-like run, an
endpoint) are reported only if the complementary parts start within ``scope``
code points: a name needs a secret, a run needs a name or an endpoint, an
endpoint needs a name and a secret.  This is an interval join: parts are
summed up per row and bin of ``scope`` code points (first and last start of
each role), and each weak part meets its own and the two neighbouring bins.
A weak part that overlaps a strong one is the strong one.

Everything is DataFrame work.  Positions come from the lengths between and in
the matches: splitting at a pattern and listing its matches alternate.

Defined cases: a null or empty text has no parts; every row stands for itself,
also when ids repeat or are null; equal starts are ordered by kind.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import Scratch, fresh

SCOPE = 200
# The base patterns, then the weak ones.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
NAME = r"""(?i:access_?key_?id|client_?id|user_?name|user|login|account)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}"""
RUN = r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{32,}={0,2}"
ENDPOINT = r"""https?://[^\x00-\x20"'<>]+|(?<![A-Za-z0-9.-])[a-z0-9][a-z0-9.-]{1,200}\.[a-z]{2,10}:[0-9]{2,5}"""
# Kind, pattern, role; the order is that of the report.
KINDS = [("assign", ASSIGN, "secret"), ("access", ACCESS, "name"), ("hex", HEX, "secret"), ("name", NAME, "name"), ("run", RUN, "secret"), ("endpoint", ENDPOINT, "endpoint")]
BASE = 3
ROLES = ("name", "secret", "endpoint")
VALUE_LENGTH = 6  # of the assigned value


def _lengths(text: Column, pattern: str, value: int) -> Column:
    """Per match the code points before it since the last one, in it, and in its value; null without a match."""
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    hits = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length)
    values = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(value)), F.length) if value else hits
    return F.when(text.rlike(pattern), F.slice(F.arrays_zip(gaps.alias("gap"), hits.alias("hit"), values.alias("value")), F.lit(1), F.size(hits)))


def matches(text: Column) -> list[Column]:
    """Per kind the array of match lengths of a text, null without a match."""
    return [_lengths(text, p, 2 if k == "assign" else 0).alias(k) for k, p, _ in KINDS]


def parts(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: ``_row``, the key and an array of match lengths per kind, written to the shared folder."""
    return Scratch(docs.sparkSession).keep(docs.select(F.monotonically_increasing_id().alias("_row"), F.col(key).alias("_key"), *matches(F.col(text))))


def spans(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``(_row, kind, start, end)``: all strong parts and the confirmed weak ones of :func:`parts`, ``kind`` as its number."""
    one = [found.where(F.col(k).isNotNull()).select("_row", F.lit(i).alias("kind"), F.posexplode(k).alias("i", "m")).select("_row", "kind", "i", "m.*") for i, (k, _, _) in enumerate(KINDS)]
    each = reduce(lambda a, b: a.unionByName(b), one)
    before = W.partitionBy("_row", "kind").orderBy("i").rowsBetween(W.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("hit")).over(before)
    placed = each.withColumn("end", end).withColumn("start", F.col("end") - F.col("hit")).where((F.col("kind") != 0) | (F.col("value") >= VALUE_LENGTH))
    in_order = W.partitionBy("_row").orderBy("start", "kind")
    strong = F.col("kind") < BASE
    ended = F.max(F.when(strong, F.col("end"))).over(in_order.rowsBetween(W.unboundedPreceding, -1))
    begun = F.min(F.when(strong, F.col("start"))).over(in_order.rowsBetween(1, W.unboundedFollowing))
    apart = F.coalesce(ended <= F.col("start"), F.lit(True)) & F.coalesce(begun >= F.col("end"), F.lit(True))
    placed = placed.withColumn("apart", apart).where(strong | F.col("apart")).select("_row", "kind", "start", "end")
    placed = Scratch(found.sparkSession).keep(placed)
    weak = placed.where(~strong)
    role = reduce(lambda a, i: F.when(F.col("kind") == i, KINDS[i][2]).otherwise(a), range(len(KINDS)), F.lit(None).cast("string"))
    binned = placed.withColumns({"role": role, "bin": F.floor(F.col("start") / scope)})
    ends = [f(F.when(F.col("role") == r, F.col("start"))).alias(f"{n}_{r}") for r in ROLES for f, n in ((F.min, "first"), (F.max, "last"))]
    bins = binned.groupBy("_row", "bin").agg(*ends)
    around = weak.withColumn("bin", F.explode(F.array(*[F.floor(F.col("start") / scope) + d for d in (-1, 0, 1)])))
    met = around.join(bins, ["_row", "bin"])
    near = {r: F.max(F.coalesce((F.col(f"first_{r}") <= F.col("start") + scope) & (F.col(f"last_{r}") >= F.col("start") - scope), F.lit(False))).alias(r) for r in ROLES}
    seen = met.groupBy("_row", "kind", "start", "end").agg(*near.values())
    name, secret, endpoint = (F.col(r) for r in ROLES)
    confirmed = seen.where(((F.col("kind") == 3) & secret) | ((F.col("kind") == 4) & (name | endpoint)) | ((F.col("kind") == 5) & name & secret))
    return placed.where(strong).unionByName(confirmed.select("_row", "kind", "start", "end"))


def _equals(value: int):
    return lambda x: x == value


def report(found: DataFrame, all_spans: DataFrame) -> DataFrame:
    """One row per document: the key, counts of the strong kinds, the digest of the strong spans and all spans as text."""
    kind = F.element_at(F.array(*[F.lit(k) for k, _, _ in KINDS]), F.col("kind") + 1)
    entry = F.struct("start", "kind", F.concat_ws(":", kind, F.col("start"), F.col("end")).alias("said"), (F.col("kind") < BASE).alias("strong"))
    per_row = all_spans.groupBy("_row").agg(F.array_sort(F.collect_list(entry)).alias("all"))
    joined = found.where(F.coalesce(*[F.col(k) for k, _, _ in KINDS]).isNotNull()).select("_row", "_key").join(per_row, "_row", "left")
    empty = found.where(F.coalesce(*[F.col(k) for k, _, _ in KINDS]).isNull()).select("_key", F.expr("cast(array() as array<struct<start:bigint,kind:int,said:string,strong:boolean>>)").alias("all"))
    both = joined.select("_key", "all").unionByName(empty).withColumn("all", F.coalesce("all", F.expr("cast(array() as array<struct<start:bigint,kind:int,said:string,strong:boolean>>)")))
    said = lambda a: F.array_join(F.transform(a, lambda x: x["said"]), ",")
    of_kind = F.transform("all", lambda x: x["kind"])
    counts = [F.size(F.filter(of_kind, _equals(i))).cast("bigint").alias(f"n_{KINDS[i][0]}") for i in range(BASE)]
    base = F.sha2(said(F.filter("all", lambda x: x["strong"])).cast("binary"), 256)
    return both.select(F.col("_key").alias("doc_id"), *counts, base.alias("base_sha256"), said(F.col("all")).alias("spans"))


def redacted(docs: DataFrame, text: str = "text", mark: str = "[SECRET]", scope: int = SCOPE) -> DataFrame:
    """``docs`` with every reported span of the text replaced by ``mark``; overlapping spans give one mark.

    Rows without any match pass through; only the others are numbered and joined.
    """
    scratch, (row, cuts) = Scratch(docs.sparkSession), fresh(docs, "_row", "_cuts")
    t = F.col(text)
    some = F.coalesce(reduce(lambda a, b: a | b, [t.rlike(p) for _, p, _ in KINDS]), F.lit(False))
    marked = scratch.keep(docs.where(some).withColumn(row, F.monotonically_increasing_id()))
    lengths = scratch.keep(marked.select(F.col(row).alias("_row"), *matches(t)))
    in_order = W.partitionBy("_row").orderBy("start", "end")
    reached = F.max("end").over(in_order.rowsBetween(W.unboundedPreceding, -1))
    islands = spans(lengths, scope).withColumn("new", F.coalesce((F.col("start") >= reached).cast("int"), F.lit(1)))
    islands = islands.withColumn("island", F.sum("new").over(in_order.rowsBetween(W.unboundedPreceding, 0))).groupBy("_row", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    sorted_cuts = F.array_sort(F.collect_list(F.struct("start", "end")))
    per_row = islands.groupBy(F.col("_row").alias(row)).agg(sorted_cuts.alias(cuts))
    begins = F.concat(F.array(F.lit(0).cast("bigint")), F.transform(cuts, lambda c: c["end"]))
    stops = F.concat(F.transform(cuts, lambda c: c["start"]), F.array(F.length(t).cast("bigint")))
    kept = F.zip_with(begins, stops, lambda a, b: F.substring(t, (a + 1).cast("int"), (b - a).cast("int")))
    changed = marked.join(per_row, row, "left").withColumn(text, F.when(F.col(cuts).isNull(), t).otherwise(F.array_join(kept, mark)))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return docs.where(~some).select(*columns).unionByName(changed.select(*columns))
