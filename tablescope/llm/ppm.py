"""Text scoring by prediction by partial matching over bytes, pretrained on the corpus.

The model is a trie of byte contexts up to ``ORDER``: how often each symbol
followed each context in the training texts.  A symbol is predicted from the
longest known context; if it never followed, the text escapes to the next
shorter one, where symbols already offered are excluded.  Escapes are
estimated by the number of distinct symbols (method C): with counts c, their
sum T and their number q after exclusion, a symbol has c / (T + q), the escape
q / (T + q).  Below order 0 all symbols not yet offered are alike.  Texts
begin after ``ORDER`` boundary symbols and end with one, so a score is the
log10 probability of the whole text; 0xFF, no byte of UTF-8, is the boundary.

Nothing of the model is sent whole to a task.  The rows are written once with
the number of their chunk, some rows of one input partition with a bounded
size of text; both passes read that number, however they are split.  One pass
lists the distinct windows (context and symbol) and words of a chunk with
their training counts.  These are summed over all chunks, the trie
is computed by joins on contexts, and each chunk gets back the log probability
of its own windows and the counts of its own words, so a task holds what one
chunk of text needs, however large the corpus.

Defined cases: null and empty texts are the end alone; rows with a null id are
scored but teach nothing; repeated rows teach as often as they occur; without
training rows all 256 symbols are alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import Scratch
from .containment import INVERSE, BASE, _mix, _powers

ORDER = 5
PIECE = 300_000  # bytes worked on at once
CHUNK = 32_000_000  # bytes of text of a chunk
PENDING = 1_500_000  # counts a task holds before it adds them up
EDGE = 0xFF
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E), EDGE])
END_WORD = 1  # key of the end token
WINDOW, WORD = 0, 1


def _pieces(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes of some texts with their boundaries, the text of each byte, and which bytes are to be scored.

    A long text is cut at white space; its next piece repeats ``ORDER`` bytes as context.
    """
    held, owners, size = [], [], 0

    def made():
        raw = np.frombuffer(b"".join(held), np.uint8)
        lengths = np.array([len(h) for h in held])
        at = np.arange(len(raw)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        return raw, np.repeat(np.array(owners), lengths), at >= ORDER

    for i, t in enumerate(texts):
        whole = bytes([EDGE]) * ORDER + t.translate(LOWER) + bytes([EDGE])
        start = ORDER
        while start < len(whole):
            end = min(len(whole), start + PIECE)
            if end < len(whole):
                cut = whole.rfind(b" ", start, end)
                end = cut + 1 if cut > start else len(whole)
            if size and size + end - start > PIECE:
                yield made()
                held, owners, size = [], [], 0
            held.append(whole[start - ORDER : end])
            owners.append(i)
            size += end - start
            start = end
    if held:
        yield made()


def _windows(raw: np.ndarray, scored: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the windows that end at scored bytes, and their positions."""
    n = len(raw) - ORDER
    key = np.zeros(n, np.int64)
    for i in range(ORDER + 1):
        key = (key << 8) | raw[i : i + n]
    at = np.flatnonzero(scored[ORDER:])
    return key[at], at + ORDER


def _words(raw: np.ndarray, scored: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words among the scored bytes, and their positions."""
    inside = ~BLANK[raw] & scored
    turns = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    first, last = turns[::2], turns[1::2]
    sums = np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _powers(BASE, len(raw)))
    h = _mix((sums[last - 1] - sums[first - 1]) * _powers(INVERSE, len(raw))[first] + np.uint64(3))
    return h.view(np.int64), first


def _tally(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    head = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[head], np.diff(np.append(head, len(keys)))


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, n = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    head = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[head], np.add.reduceat(n, head) if len(head) else n


def _texts(column: pa.Array) -> list[bytes]:
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def _local(texts: list[bytes], taught: np.ndarray) -> tuple[list, list]:
    """Windows and words of some texts as ``(key, training count)``; those of other texts count nothing."""
    windows, words = [], []
    for raw, owner, scored in _pieces(texts):
        learn = taught[owner]
        for out, (keys, at) in ((windows, _windows(raw, scored)), (words, _words(raw, scored))):
            teaching = learn[at]
            keys_of, n = _tally(keys[teaching])
            out.append((keys_of, n))
            others, _ = _tally(keys[~teaching])
            out.append((others, np.zeros(len(others), np.int64)))
    return windows, words


def chunked(rows: DataFrame, most: int = CHUNK) -> DataFrame:
    """``rows`` (the text in column ``t``) with their ``chunk``, to be written: at most ``most`` bytes of text, or one longer text, of one partition."""
    out = T.StructType([T.StructField("chunk", T.LongType()), *rows.schema.fields])
    at = rows.columns.index("t")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, size = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            chunks = []
            for n in pa.compute.binary_length(batch.column(at).cast(pa.binary())).fill_null(0).to_pylist():
                if size and size + n > most:
                    part, size = part + 1, 0
                size += n + 1
                chunks.append(part)
            yield pa.RecordBatch.from_arrays([pa.array(chunks, pa.int64()), *batch.columns], names=out.names)

    return rows.mapInArrow(read, out)


def chunk_counts(rows: DataFrame, pending: int = PENDING) -> DataFrame:
    """``(chunk, kind, key, n)`` of ``rows`` (``chunk``, ``taught``, ``text``): what occurs in each chunk, and how often in training texts.

    A task holds counts of about ``pending`` keys and passes them on when there are more, so a key may have several rows.
    """
    names = ["chunk", "kind", "key", "n"]

    def told(chunk: int, kind: int, parts: list) -> Iterator[pa.RecordBatch]:
        if not parts:
            return
        keys, n = _added(parts)
        for s in range(0, len(keys), 50_000):
            k = keys[s : s + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), chunk, np.int64)), pa.array(np.full(len(k), kind, np.int8)), pa.array(k), pa.array(n[s : s + 50_000].astype(np.int64))], names=names)

    def by_chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunks = batch.column(0).to_numpy()
            heads = np.flatnonzero(np.concatenate([[True], chunks[1:] != chunks[:-1]])).tolist() if len(chunks) else []
            for a, b in zip(heads, [*heads[1:], len(chunks)]):
                yield batch.slice(a, b - a)

    def ended(chunk: int, windows: list, words: list, ends: int) -> Iterator[pa.RecordBatch]:
        words.append((np.array([END_WORD]), np.array([ends])))
        yield from told(chunk, WINDOW, windows)
        yield from told(chunk, WORD, words)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, words, chunk, ends = [], [], None, 0
        for batch in by_chunk(batches):
            if chunk != (now := batch.column(0)[0].as_py()):
                if chunk is not None:
                    yield from ended(chunk, windows, words, ends)
                windows, words, chunk, ends = [], [], now, 0
            taught = batch.column(1).to_numpy(zero_copy_only=False)
            ends += int(taught.sum())
            texts = _texts(batch.column(2))
            for s in range(0, len(texts), 500):
                for out, more in zip((windows, words), _local(texts[s : s + 500], taught[s : s + 500])):
                    out.extend(more)
                    if sum(len(k) for k, _ in out) > pending + 2 * len(out[0][0]):
                        out[:] = [_added(out)]
                        if len(out[0][0]) > pending:  # the rest of the chunk is counted anew; all its counts are summed later
                            yield from told(chunk, WINDOW if out is windows else WORD, out)
                            out.clear()
        if chunk is not None:
            yield from ended(chunk, windows, words, ends)

    return rows.mapInArrow(read, "chunk bigint, kind tinyint, key bigint, n bigint")


def _context(key: Column, order: int) -> Column:
    """The last ``order`` bytes of a context."""
    return key.bitwiseAND(F.lit((1 << 8 * order) - 1))


def window_values(windows: DataFrame) -> DataFrame:
    """``(key, value)``: the log10 probability of the symbol of each window after its context, from ``(key, n)``."""
    scratch = Scratch(windows.sparkSession)
    split = windows.select("key", F.shiftright("key", 8).alias("x"), F.col("key").bitwiseAND(255).alias("s"), F.col("n").alias("c"))
    entries, nodes = {}, {}
    entries[ORDER] = scratch.keep(split.where("c > 0").select("x", "s", "c"))
    for k in range(ORDER, -1, -1):
        if k < ORDER:
            entries[k] = scratch.keep(entries[k + 1].groupBy(_context(F.col("x"), k).alias("x"), "s").agg(F.sum("c").alias("c")))
        nodes[k] = entries[k].groupBy("x").agg(F.sum("c").alias("t"), F.count(F.lit(1)).alias("q"))
    for k in range(ORDER, 0, -1):
        # What the shorter context has left once the symbols of this one are excluded.
        shorter = entries[k - 1].select(F.col("x").alias("y"), "s", F.col("c").alias("below"))
        offered = entries[k].withColumn("y", _context(F.col("x"), k - 1)).join(shorter, ["y", "s"]).groupBy("x", "y").agg(F.sum("below").alias("gone"))
        left = offered.join(nodes[k - 1].select(F.col("x").alias("y"), F.col("t").alias("t1"), F.col("q").alias("q1")), "y")
        nodes[k] = scratch.keep(nodes[k].join(left, "x").select("x", "t", "q", (F.col("t1") - F.col("gone")).alias("t_left"), (F.col("q1") - F.col("q")).alias("q_left")))
    nodes[0] = scratch.keep(nodes[0])
    known = split.where("c > 0").join(nodes[ORDER].select("x", "t", "q"), "x").select("key", F.log10(F.col("c") / (F.col("t") + F.col("q"))).alias("value"))
    offered_all = nodes[0].agg(F.max("q")).first()[0] or 0
    rest = split.where("c = 0").select("key", "x", "s", F.lit(0.0).alias("sum"), F.lit(None).cast("double").alias("value"), F.lit(None).cast("bigint").alias("t_left"), F.lit(None).cast("bigint").alias("q_left"))
    for k in range(ORDER, -1, -1):
        own = nodes[k].select(F.col("x").alias("y"), F.col("t").alias("t0"), F.col("q").alias("q0"), *([F.col("t_left").alias("t1"), F.col("q_left").alias("q1")] if k else [F.lit(None).cast("bigint").alias("t1"), F.lit(None).cast("bigint").alias("q1")]))
        seen = entries[k].select(F.col("x").alias("y"), "s", "c")
        here = rest.withColumn("y", _context(F.col("x"), k)).join(own, "y", "left").join(seen, ["y", "s"], "left")
        t, q = F.coalesce("t_left", "t0"), F.coalesce("q_left", "q0")
        value = F.coalesce("value", F.when(F.col("c").isNotNull(), F.col("sum") + F.log10(F.col("c") / (t + q))))
        escaped = F.col("sum") + F.when(F.col("t0").isNotNull() & (q > 0), F.log10(q / (t + q))).otherwise(0.0)
        before, rest = rest, scratch.keep(here.select("key", "x", "s", escaped.alias("sum"), value.alias("value"), F.col("t1").alias("t_left"), F.col("q1").alias("q_left")))
        for done in [entries[k], *([before] if k < ORDER else []), *([nodes[k]] if k < ORDER else [])]:
            scratch.drop(done)
    last = F.coalesce("value", F.col("sum") - F.log10(F.lit(float(max(1, 256 - offered_all)))))
    return known.unionByName(rest.select("key", last.alias("value")))


def score(docs: DataFrame, taught: Column, text: str = "text", keep: list[str] = ["doc_id"], pending: int = PENDING, most: int = CHUNK) -> DataFrame:
    """``keep`` columns with n_tokens, n_known, train_tokens, base_score and score of every text, learning from the rows where ``taught`` is true."""
    scratch = Scratch(docs.sparkSession)
    rows = docs.select(F.coalesce(taught, F.lit(False)).alias("taught"), F.col(text).alias("t"), *[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)])
    rows = scratch.keep(chunked(rows, most))
    at = F.collect_list(F.struct("chunk", "n"))  # a key has one entry per chunk, a few if the chunk was counted in parts
    # Dealt by key first: a chunk has one row per key, so there is nothing to combine before the shuffle.
    counts = chunk_counts(rows.select("chunk", "taught", "t"), pending).repartition("kind", "key")
    counted = scratch.keep(counts.groupBy("kind", "key").agg(F.sum("n").alias("total"), at.alias("at")))
    words = counted.where(F.col("kind") == WORD)
    size = words.agg(F.sum("total").alias("n"), F.sum((F.col("total") > 0).cast("bigint")).alias("v")).first()
    total, distinct = size["n"] or 0, size["v"] or 0
    windows = counted.where(F.col("kind") == WINDOW)
    values = window_values(windows.select("key", F.col("total").alias("n")))
    sent_windows = windows.select("key", F.explode(F.array_distinct("at.chunk")).alias("chunk")).join(values, "key").select("chunk", F.lit(WINDOW).cast("tinyint").alias("kind"), "key", "value")
    # A chunk knows the counts of words that no other chunk has.
    unsure = F.array_distinct(F.transform(F.filter("at", lambda a: a["n"] != F.col("total")), lambda a: a["chunk"]))
    spread = words.where((F.size("at") > 1) & (F.col("total") > 0)).select("key", F.explode(unsure).alias("chunk"), "total")
    sent_words = spread.select("chunk", F.lit(WORD).cast("tinyint").alias("kind"), "key", F.col("total").cast("double").alias("value"))
    answers = sent_windows.unionByName(sent_words)
    fields = [rows.schema[f"k{i}"].dataType.simpleString() for i in range(len(keep))]
    names = [*[f"k{i}" for i in range(len(keep))], "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    schema = ", ".join([*[f"k{i} {t}" for i, t in enumerate(fields)], "n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"])

    def per_chunk(texts: pa.Table, told: pa.Table) -> pa.Table:
        kinds, keys, values_ = (told.column(c).to_numpy() for c in ("kind", "key", "value"))
        is_window = kinds == WINDOW
        order = np.argsort(keys[is_window])
        window_keys, window_logs = keys[is_window][order], values_[is_window][order]
        raw_texts, learn = [], texts.column("taught").to_numpy(zero_copy_only=False)
        for part in texts.column("t").chunks:
            raw_texts += _texts(part)
        words_here, ends = [(np.array([END_WORD]), np.array([int(learn.sum())]))], 0
        for raw, owner, scored in _pieces(raw_texts):
            h, at = _words(raw, scored)
            words_here.append(_tally(h[learn[owner[at]]]))
        word_keys, word_counts = _added(words_here)
        other_keys, other_counts = keys[~is_window], values_[~is_window].astype(np.int64)
        both = np.concatenate([other_keys, word_keys])
        first = np.unique(both, return_index=True)  # a count that was sent comes first
        word_keys, word_counts = first[0], np.concatenate([other_counts, word_counts])[first[1]]
        n = len(raw_texts)
        tokens, known, base, model = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
        scale = np.log10(total + distinct + 1)

        def count_of(h):
            i = np.minimum(np.searchsorted(word_keys, h), len(word_keys) - 1)
            return np.where(word_keys[i] == h, word_counts[i], 0)

        def log_of(w):
            i = np.searchsorted(window_keys, w)
            if len(w) and (not len(window_keys) or (window_keys[np.minimum(i, len(window_keys) - 1)] != w).any()):
                raise ValueError("a window of the text was not counted with its chunk")
            return window_logs[i]

        for raw, owner, scored in _pieces(raw_texts):
            h, at = _words(raw, scored)
            c = count_of(h)
            tokens += np.bincount(owner[at], minlength=n)
            known += np.bincount(owner[at], c > 0, n).astype(np.int64)
            base += np.bincount(owner[at], np.log10(c + 1) - scale, n)
            w, at = _windows(raw, scored)
            model += np.bincount(owner[at], log_of(w), n)
        end = count_of(np.array([END_WORD]))[0]
        columns = [texts.column(f"k{i}").combine_chunks() for i in range(len(keep))]
        numbers = [tokens + 1, known + int(end > 0), np.full(n, total, np.int64), base + np.log10(end + 1) - scale, model]
        return pa.Table.from_arrays([*columns, *map(pa.array, numbers)], names=names)

    scored_rows = rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(per_chunk, schema)
    return scored_rows.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *names[len(keep) :])
