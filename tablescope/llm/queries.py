"""The registered queries of the corpus operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bitslice, bm25, containment, credentials, kdshard, langid, packing, paragraphs, periods, ppm, quality, simhash, warc
from .common import Scratch, id_crc, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_language_id(spark, folder):
    """Language of every document; a quarter of the ids is held out of the learning."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", (id_crc() % 4).alias("remainder"))
    model = langid.fit(docs.where(langid.taught(F.col("remainder"))))
    return langid.predict(docs, model).select("doc_id", F.coalesce(F.col("remainder") == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query
def op2_quality(spark, folder):
    """Quality of every document; a quarter of the ids is held out of the learning."""
    docs = table(spark, folder, "documents").select("doc_id", "text", (id_crc() % 4).alias("remainder"))
    rows = Scratch(spark).keep(quality.with_statistics(docs).drop("text"))
    model = quality.fit(quality.labelled(rows.where(langid.taught(F.col("remainder"))), table(spark, folder, "labels")))
    scored = quality.score(rows, model)
    return scored.select("doc_id", F.coalesce(F.col("remainder") == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op3_kd_shards(spark, folder):
    """Documents in 24 shards of nearly equal bytes, near in size, script and content hash; equal texts together."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")
    crc = F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0))
    dims = [F.log2(F.col("size").cast("double")), (F.col("size") - kdshard.ROW_OVERHEAD) / F.greatest(F.col("chars"), F.lit(1)), F.col("text_crc32")]
    docs = docs.select("doc_id", (size + kdshard.ROW_OVERHEAD).alias("size"), F.coalesce(F.length("text"), F.lit(0)).alias("chars"), crc.alias("text_crc32"))
    out = kdshard.shard(docs, F.col("size"), dims, F.col("text_crc32"), F.col("doc_id"), 24, [F.col("doc_id"), F.col("size"), F.col("text_crc32")])
    return out.select(
        F.col("c0").alias("doc_id"), F.col("c1").alias("size"), F.col("c2").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op4_packing(spark, folder):
    """All documents in sequences of 2048 tokens, first-fit decreasing."""
    from public_tokenizers import path

    parts = packing.pieces(table(spark, folder, "documents"), path("word_bpe_49k.json"))
    return packing.pack(parts).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query
def op8_credentials(spark, folder):
    """Secrets of every document: the strong spans, and weak ones next to their complement."""
    found = credentials.parts(table(spark, folder, "documents"))
    return credentials.report(found, credentials.spans(found))


@query
def op9_simhash(spark, folder):
    """Fingerprint of every document and the smallest id of its near-duplicates."""
    docs = Scratch(spark).keep(simhash.with_fingerprint(table(spark, folder, "documents")).select("doc_id", "fingerprint"))
    named = simhash.classes(docs).withColumnRenamed("fp", "fingerprint")
    return docs.join(named, "fingerprint").select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op10_decontamination(spark, folder):
    """Benchmark items inside documents, with their exact shingle containment."""
    return containment.search(table(spark, folder, "documents"), table(spark, folder, "benchmark")).select("doc_id", "item_id", "containment", "first_word")


@query
def op7_paragraphs(spark, folder):
    """Runs of repeated paragraphs of every document, exact or near copies elsewhere."""
    return paragraphs.repeated(table(spark, folder, "documents"))


@query
def op6_bm25(spark, folder):
    """Ten best documents for every document whose id is divisible by 20, asked by all terms of its text."""
    docs = table(spark, folder, "documents")
    postings = bm25.index(docs)
    n, mean_length = bm25.statistics(postings)
    asked = bm25.queries_from(docs.where("doc_id % 20 = 0"), bm25.frequencies(postings), n, terms=None)
    return bm25.search(postings, Scratch(spark).keep(asked), n, mean_length)


@query
def op5_ppm(spark, folder):
    """Log10 probability of every document under byte contexts and under words; a seventh of the ids is held out."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    remainder = id_crc() % 7
    scored = ppm.score(docs, remainder.isNotNull() & (remainder != 2))
    return scored.select("doc_id", F.coalesce(remainder == 2, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op11_bitsliced_search(spark, folder):
    """Ten best documents of every benchmark item, by exact whole-number scores."""
    blocks = bitslice.index(table(spark, folder, "documents"))
    return bitslice.search(blocks, table(spark, folder, "benchmark"))


def _repeated_tail(text: str = "text", key: str = "doc_id"):
    """The text of one id in ten, by its checksum, from one of its words on replaced by copies of the stretch that begins there."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, h = F.size(words), id_crc(key)
    g = F.floor(h / 10)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    copies = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    return F.when((h % 10 == 0) & (n > 0), F.array_join(F.slice(F.concat(F.slice(words, F.lit(1), a), copies), F.lit(1), n), " ")).otherwise(F.col(text))


@query
def op12_periods(spark, folder):
    """Periodic runs of every document, and digests of all of them and of the text without its repetitions."""
    docs = table(spark, folder, "documents").select("doc_id", _repeated_tail().alias("text"))
    found = periods.with_runs(docs)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    length, period = F.col("best.length"), -F.col("best.period")
    return found.select(
        "doc_id", "n_runs", (-F.col("best.start")).alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).cast("bigint").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )


@query
def op13_warc_zstd(spark, folder):
    """Every page written to archives of one Zstandard frame per record, and read back from them."""
    scratch = Scratch(spark)
    warc.write(table(spark, folder, "pages"), f"{scratch.root}/warc")
    back = warc.read(spark, f"{scratch.root}/warc")
    sound = F.when(F.col("error").isNull(), F.col("key")).otherwise(F.raise_error(F.concat(F.lit("Record of "), "archive", F.lit(": "), "error")))
    return back.select(sound.cast("bigint").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("bigint").alias("refers_to"))
