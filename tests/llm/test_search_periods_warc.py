"""Bit-sliced search, periodic runs and WARC archives against plain Python, with their edge cases."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
import zstandard
from pyspark.sql import functions as F

from tablescope.llm import bitslice, periods, warc
from tablescope.llm import queries as corpus
from tablescope.llm.common import Scratch

SMALL = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ------------------------------------------------------------ bit-sliced search
def plain_search(docs, queries, k):
    """``[(query position, rank, doc_id, score)]`` by scoring every document."""
    counted = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    n_docs, n_words = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for q, text in enumerate(queries):
        asked, scored = Counter(TERM.findall((text or "").translate(LOWER))), []
        for i, c, n in counted:
            m = 25 + (75 * n * n_docs) // n_words
            score = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t, times in asked.items() if c[t])
            if score > 0:
                scored.append((-score, math.inf if i is None else i, i))
        out += [(q, r, i, -s) for r, (s, _, i) in enumerate(sorted(scored, key=lambda x: x[:2])[:k], 1)]
    return out


def prose(rng, n):
    return " ".join(f"w{x}" for x in np.minimum(rng.zipf(1.3, n), 3000))


@pytest.fixture(scope="module")
def library():
    rng = np.random.default_rng(5)
    docs = [(i, prose(rng, int(rng.integers(1, 200)))) for i in range(600)] + [(600, prose(rng, 20_000)), (601, "W1, w2; StraßeßÄ w2"), (602, "É é e")]
    docs += [(5, docs[7][1]), (5, docs[7][1]), (None, docs[7][1]), (603, None), (604, ""), (605, "--- ..."), (-9, docs[8][1])]
    asked = [docs[7][1], docs[8][1], "w1 w1 w1 w2 unknown", "nothing here known", None, "", "?!", "straßeßÄ", "É", prose(rng, 300), docs[7][1]]
    return docs, asked


def test_search_equals_brute_force(spark, library):
    docs, asked = library
    table = spark.createDataFrame(docs, "doc_id bigint, text string").withColumns({c: F.lit("clash") for c in ("q", "key", "part", "score", "rank", "docs")}).repartition(5)
    blocks = bitslice.index(table)
    asks = spark.createDataFrame(list(enumerate(asked)), "item_id bigint, text string")
    for block_terms in (bitslice.BLOCK_TERMS, 40):
        for k in (3, 10):
            got = sorted((r.item_id, r["rank"], r.doc_id, r.score) for r in bitslice.search(blocks, asks, k=k, block_terms=block_terms).collect())
            assert [g[:2] + g[3:] for g in got] == [p[:2] + p[3:] for p in plain_search(docs, asked, k)]
            assert got == sorted(plain_search(docs, asked, k)) or k == 3
    text_key = asks.withColumn("item_id", F.concat(F.lit("q"), "item_id"))
    assert bitslice.search(blocks, text_key).where("item_id = 'q0'").count() == 10


def test_search_excludes_most_documents_and_bounds_hold():
    rng = np.random.default_rng(1)
    known = bitslice._Hashes()
    docs = [(i, *bitslice.counts_of(prose(rng, 80).encode(), known)) for i in range(4000)]
    queries = bitslice.Queries([(0, *[x.tolist() for x in docs[17][2:]]), (1, *[x.tolist() for x in docs[99][2:]])])
    df = Counter(t for d in docs for t in d[2].tolist())
    weight = bitslice.weights(len(docs), np.array([df[t] for t in queries.terms.tolist()]))
    names = [c.split()[0] for c in bitslice.INDEX.split(", ")]
    one = bitslice.Searcher(queries, weight, len(docs), sum(d[1] for d in docs), 10)
    every = bitslice.Searcher(queries, weight, len(docs), sum(d[1] for d in docs), len(docs))
    for s in range(0, len(docs), 1000):
        row = dict(zip(names, bitslice.pack(docs[s : s + 1000], 128)))
        one.show(row)
        every.show(row)
    for i, own in ((0, 17), (1, 99)):
        assert one.best[i][1][0] == own and one.best[i][0].tolist() == every.best[i][0][:10].tolist() and one.best[i][1].tolist() == every.best[i][1][:10].tolist()
    assert one.rescored < one.seen / 4 < every.rescored


def test_levels_and_slices():
    assert [bitslice.levels(m) for m in (1, 2, 3, 4, 5, 9, 10)] == [[1], [1, 2], [1, 2, 3], [1, 2, 3], [1, 2, 3, 5], [1, 2, 3, 5, 9], [1, 2, 3, 5, 9]]
    terms = np.arange(1000)
    assert bitslice.slices_of(terms, 0, 64).max() < 64 and (bitslice.slices_of(terms, 0, 1 << 20) != bitslice.slices_of(terms, 1, 1 << 20)).any()


def test_terms_fold_ascii_only():
    for text in ("A-b_c É9\x00\x7fx y", "ÀÉÎ straße ǅ", "", "\U0001f600 a", "".join(map(chr, range(0x300)))):
        assert [t.decode() for t in bitslice.terms_of(text.encode())] == TERM.findall(text.translate(LOWER))


def test_search_of_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    asks = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert bitslice.search(bitslice.index(docs), asks).count() == 0
    some = bitslice.index(spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string"))
    assert bitslice.search(some, asks.limit(0)).count() == 0 and bitslice.search(some, asks.withColumn("text", F.lit(None).cast("string"))).count() == 0
    assert [tuple(r) for r in bitslice.search(some, asks).select("item_id", "rank", "doc_id").collect()] == [(1, 1, 1)]


# ---------------------------------------------------------------- periodic runs
def plain_runs(words):
    """``[(start, length, period)]`` by trying every period at every place."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(12, 2 * q):
                found.setdefault((i, j + q - i), q)
            i = max(i + 1, j + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_collapse(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def odd_word_lists(seed, count):
    rng = np.random.default_rng(seed)
    for _ in range(count):
        letters, n = int(rng.integers(1, 5)), int(rng.integers(1, 130))
        kind = rng.integers(0, 5)
        if kind == 0:
            made = rng.integers(0, letters, n)
        elif kind == 1:
            made = rng.integers(0, letters, n)[np.arange(n) % rng.integers(1, n + 1)]
        elif kind == 2:
            made = np.concatenate([np.tile(rng.integers(0, letters, rng.integers(1, 9)), rng.integers(1, 9)) for _ in range(4)])
        elif kind == 3:
            part = np.concatenate([np.tile(rng.integers(0, letters, rng.integers(1, 4)), rng.integers(1, 6)), rng.integers(0, letters, rng.integers(0, 3))])
            made = np.tile(part, rng.integers(1, 5))
        else:
            a, b = [0], [0, 1]
            while len(b) < n:
                a, b = b, b + a
            made = np.array(b[:n])
        yield [b"%d" % x for x in made]


def test_runs_equal_brute_force():
    lists = list(odd_word_lists(3, 1200))
    for s in range(0, len(lists), 5):
        for words, got in zip(lists[s : s + 5], periods.analyse(lists[s : s + 5])):
            expected = plain_runs(words)
            assert [tuple(r) for r in got.tolist()] == expected
            assert periods.collapse(words, got) == b" ".join(plain_collapse(words, expected))


def test_range_successor_and_extensions():
    rng = np.random.default_rng(0)
    values = rng.permutation(777)
    low = rng.integers(0, 777, 500)
    high, least = np.minimum(777, low + rng.integers(0, 90, 500)), rng.integers(0, 800, 500)
    expected = [min([v for v in values[a:b].tolist() if v >= x], default=777) for a, b, x in zip(low, high, least)]
    assert periods.Successor(values)(low, high, least).tolist() == expected
    symbols = rng.integers(0, 2, 300)
    text = periods.Suffixes(symbols)
    assert text.array.tolist() == sorted(range(300), key=lambda i: symbols[i:].tolist())
    i, j = np.array([3, 10, 7, 0]), np.array([50, 11, 299, 299])
    common = lambda a, b: next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    assert text.right(i, j).tolist() == [common(symbols[a:], symbols[b:]) for a, b in zip(i, j)]
    assert text.left(i, j).tolist() == [common(symbols[:a][::-1], symbols[:b][::-1]) for a, b in zip(i, j)]


def test_long_periodic_texts():
    assert periods.analyse([[b"a"] * 100_000])[0].tolist() == [[0, 100_000, 1]]
    block = [b"%d" % x for x in range(9_000)]
    assert periods.analyse([block * 3 + [b"end"], block])[0].tolist() == [[0, 27_000, 9_000]]


def test_periods_query_equals_brute_force(spark):
    got = {r.doc_id: r for r in corpus.QUERIES["op12_periods"](spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    assert len(got) == len(docs)
    checked = 0
    for d in docs:
        words, h = (d.text or "").encode().split(), zlib.crc32(str(d.doc_id).encode())
        n, g = len(words), h // 10
        if n > 1200:
            continue
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs, row = plain_runs(words), got[d.doc_id]
        sha = lambda b: hashlib.sha256(b).hexdigest()
        assert (row.n_runs, row.runs_sha256) == (len(runs), sha("".join("%d,%d,%d\n" % r for r in runs).encode()))
        assert row.collapsed_sha256 == sha(b" ".join(plain_collapse(words, runs)))
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        assert (row.start, row.length, row.period) == best and row.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        checked += 1
    assert checked > 150


def test_runs_keep_rows_and_columns(spark):
    rows = [(1, "a b " * 20, "x"), (1, "a b " * 20, "x"), (None, None, None), (2, "", "y"), (3, "\t \n", "z"), (4, "no run in this text at all", "w"), (5, "é ü " * 12, "v")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, `_found` string").withColumn("odd.name", F.lit(1))
    out = periods.with_runs(docs, runs="r", collapsed="c").toPandas()
    assert out.columns.tolist() == ["doc_id", "text", "_found", "odd.name", "r", "c"] and len(out) == 7
    assert sorted(out.c) == sorted(["a b", "a b", "", "", "", "no run in this text at all", "é ü"])
    assert [tuple(x) for x in out[out.doc_id == 5].r.iloc[0]] == [(0, 12, 1)] and len(out[out.doc_id == 2].r.iloc[0]) == 0
    assert periods.with_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periods.with_runs(docs, least=5)


# ------------------------------------------------------------------------- WARC
def sha32(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"http://h/{i}", f"<html><body>page number {i} {'text ' * (i % 7)}</body></html>") for i in range(200)]
    rows += [(300 + i, f"http://copy/{i}", rows[3][2]) for i in range(400)]
    rows += [(2, "http://h/2", rows[2][2]), (None, None, None), (900, None, ""), (901, "a\r\nWARC-Type: x", None), (None, "n", rows[3][2]), (902, "ü", "ä\U0001f600 " * 50_000), (None, "m", "alone")]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns({c: F.lit("clash") for c in ("key", "digest", "first", "hot", "payload", "archive")})


def test_archives_round_trip(spark, pages):
    scratch = Scratch(spark)
    for name, least in (("all", 0), ("long", 10**6)):
        warc.write(pages.repartition(3), f"{scratch.root}/{name}", revisit_bytes=least)
        back = warc.read(spark, f"{scratch.root}/{name}").toPandas()
        source = pages.toPandas()
        assert len(back) == len(source) and back.error.isna().all()
        payloads = [(h or "").encode() for h in source.html]
        smallest = {}
        for key, data in zip(source.page_id, payloads):
            if not pd.isna(key):
                smallest[data] = min(smallest.get(data, math.inf), key)
        expected = []
        for key, data in zip(source.page_id, payloads):
            first = smallest.get(data) if payloads.count(data) > 1 and len(data) >= least else None
            revisit = first is not None and not key == first
            expected.append((None if pd.isna(key) else str(int(key)), len(data), sha32(data), "revisit" if revisit else "response", str(int(first)) if revisit else None, None if revisit else data))
        none = lambda x: None if x is None or isinstance(x, float) else x
        got = [(none(r.key), r.payload_bytes, r.payload_digest, r.record_type, none(r.refers_to), none(r.payload)) for r in back.itertuples()]
        assert sorted(got, key=repr) == sorted(expected, key=repr)
        assert back[back.key == "901"].url.iloc[0] == "a%0D%0AWARC-Type: x"


def test_spark_digest_is_sha1_in_base32(spark):
    texts = ["", "a", "ü" * 1000, "\x00\n", *[str(i) for i in range(50)]]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(warc.base32_sha1(F.col("t").cast("binary"))).collect()
    assert [r[0] for r in got] == [sha32(t.encode()) for t in texts]


def sample(n=40):
    return [warc._record("response", f"{i:032x}", str(i), f"http://h/{i}", b"<p>payload %d</p>" % i * 9, sha32(b"<p>payload %d</p>" % i * 9), None, warc.DATE) for i in range(n)]


def rows_of(data):
    return [dict(zip([c.split()[0] for c in warc.RECORD.split(", ")], r)) for r in warc.records(memoryview(data), "f")]


def test_dictionary_frame_leads_and_is_needed():
    frames = list(warc.compressed(iter(sample())))
    assert frames[0][:4] == warc.DICTIONARY_MAGIC and len(frames) == 41
    rows = rows_of(b"".join(frames))
    assert [r["key"] for r in rows] == [str(i) for i in range(40)] and not any(r["error"] for r in rows)
    again = zstandard.ZstdCompressor().compress(frames[0][8:])  # a compressed dictionary is read as well
    packed = warc.DICTIONARY_MAGIC + len(again).to_bytes(4, "little") + again
    assert rows_of(packed + b"".join(frames[1:])) == [r | {"offset": r["offset"] - len(frames[0]) + len(packed)} for r in rows]
    assert all("dictionary" in r["error"] for r in rows_of(b"".join(frames[1:])))
    bad = warc.DICTIONARY_MAGIC + (4).to_bytes(4, "little") + b"none"
    assert "no dictionary" in rows_of(bad + b"".join(frames[1:]))[0]["error"]
    assert [f[:4] for f in warc.compressed(iter(sample(3)))] == [warc.ZSTD_MAGIC] * 3 and list(warc.compressed(iter([]))) == []


def test_one_damaged_record_costs_no_other():
    frames = list(warc.compressed(iter(sample())))
    hurt = bytearray(frames[5])
    hurt[-1] ^= 1
    rows = rows_of(b"".join([*frames[:5], bytes(hurt), *frames[6:]]))
    assert len(rows) == 40 and [bool(r["error"]) for r in rows] == [i == 4 for i in range(40)]
    whole = b"".join(frames)
    cut = rows_of(whole[: -len(frames[-1]) // 2])
    assert len(cut) == 40 and "ends inside" in cut[-1]["error"] and not any(r["error"] for r in cut[:-1])
    junk = rows_of(whole + b"junk at the end")
    assert len(junk) == 41 and "no frame" in junk[-1]["error"] and rows_of(b"") == []


@pytest.mark.parametrize(
    "old, new, fault",
    [
        (b"WARC/1.1", b"HTTP/1.1", "version"), (b"WARC-Date", b"X-Date", "warc-date is missing"), (b"\r\n\r\nHTTP", b"\r\nHTTP", "length"),
        (b"WARC-Type: response\r\n", b"WARC-Type response\r\n", "no field"), (b"payload 0", b"PAYLOAD 0", "block-digest differs"), (b"</p>\r\n\r\n", b"</p>\r\n", "content-length"),
        (b"msgtype=response\r\nContent-Length: ", b"msgtype=response\r\nContent-Length: x", "no number"),
    ],
)
def test_faults_are_told(old, new, fault):
    record = sample(1)[0]
    assert old in record
    row = rows_of(zstandard.ZstdCompressor().compress(record.replace(old, new)))[0]
    assert fault in row["error"]


def test_foreign_records_are_read():
    text = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nwarc-record-id: <urn:x>\r\nWARC-Date: 2020-01-01T00:00:00Z\r\nX-Long: a\r\n  b\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    for size in (True, False):
        row = rows_of(b"\x5a\x2a\x4d\x18\x02\x00\x00\x00xx" + zstandard.ZstdCompressor(write_content_size=size).compress(text))[0]
        assert (row["record_type"], row["payload"], row["payload_bytes"], row["error"], row["key"]) == ("warcinfo", b"abc", 3, None, None)


def test_archives_of_empty_tables(spark, pages):
    root = Scratch(spark).root
    warc.write(pages.limit(0), f"{root}/none")
    assert warc.read(spark, f"{root}/none").count() == 0
