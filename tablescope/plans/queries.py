"""Registered queries: every operator over whole tables of the test data."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..config import AnalysisConfig
from ..functions import text
from ..operators import anomaly, clean, cluster, dbscan, describe, features, iforest, insights, profile, relate, segments
from ..errors import EmptyDatasetError
from ..session import cut_lineage, shared_folder
from ..sources import files
from ..sources.files import load_dataset
from .report import Analyzer, basic_statistics

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def comparable(x: Column) -> Column:
    """Nine significant digits, nine decimals below one; no negative zero."""
    digits = 8 - F.greatest(F.floor(F.log10(F.abs(x))).cast("double"), F.lit(-1.0))
    scale = F.pow(F.lit(10.0), digits)
    return F.when(x == 0, 0.0).otherwise(F.round(x * scale, 0) / scale + 0.0)


def tidy(df: DataFrame) -> DataFrame:
    """Doubles rounded for comparison, integers as bigint."""
    def shown(f: T.StructField) -> Column:
        c = F.col("`" + f.name + "`")
        if isinstance(f.dataType, T.DoubleType):
            return comparable(c).alias(f.name)
        return c.cast("bigint").alias(f.name) if isinstance(f.dataType, (T.IntegerType, T.ShortType)) else c

    return df.select(*[shown(f) for f in df.schema])


# --------------------------------------------------------------- derived inputs
PRICES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
RELATED = ["l_quantity", "l_extendedprice", "importe", "cubo"]


def priced(spark, folder) -> DataFrame:
    """lineitem with a product and a steep monotone column."""
    q = F.col("l_quantity")
    return table(spark, folder, "lineitem").withColumns({"importe": q * F.col("l_extendedprice"), "cubo": F.exp(q / 3)})


def gappy_events(spark, folder) -> DataFrame:
    """events with gaps in ``value``, an empty and a constant column."""
    return table(spark, folder, "events").select(
        "event_id", "user_id", "event_type",
        F.when(F.col("event_id") % 10 != 0, F.col("value")).alias("value"),
        F.when(F.col("event_id") % 3 != 0, F.col("value") * 2 + F.col("user_id")).alias("doble"),
        F.lit(None).cast("double").alias("vacia"),
        F.lit(7.0).alias("constante"),
    )


def signals(spark, folder) -> DataFrame:
    """Two numeric columns of events without gaps."""
    return table(spark, folder, "events").select("event_id", F.col("value"), (F.col("user_id") % 50).cast("double").alias("grupo_usuario"))


def banded(spark, folder) -> DataFrame:
    """lineitem with a band of the quantity as a category."""
    q = F.col("l_quantity")
    return table(spark, folder, "lineitem").withColumn("banda", F.when(q <= 10, "baja").when(q <= 35, "media").otherwise("alta"))


def labelled_parts(spark, folder) -> DataFrame:
    """part with a given segment per size range, -1 for the largest sizes."""
    size = F.col("p_size")
    return table(spark, folder, "part").withColumns(
        {
            "label": F.when(size <= 10, 0).when(size <= 25, 1).when(size <= 45, 2).otherwise(-1),
            "es_caro": F.col("p_retailprice") > 1000,
        }
    )


def standard(spark, folder, name: str, key: str, cols: list[str]) -> DataFrame:
    return features.feature_frame(table(spark, folder, name), cols, [key])


PART_FEATURES = ["p_size", "p_retailprice"]


# ------------------------------------------------------------------ sources (S)
def _as_file(spark, folder, name: str, suffix: str, sep: str | None = None) -> str:
    """Path of a table written as delimited text below the shared folder."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}.{suffix}"
    sep = sep or {"csv": ",", "tsv": "\t", "txt": ","}[suffix]
    table(spark, folder, name).write.option("header", True).option("sep", sep).option("escape", '"').csv(path)
    return path


def _through_file(spark, folder, name: str, suffix: str, **options) -> DataFrame:
    """A table written as delimited text and read back with inferred types."""
    return load_dataset(spark, _as_file(spark, folder, name, suffix, options.get("sep")), **options)


def _typed(df: DataFrame, keys: list[str]) -> DataFrame:
    """Columns next to their inferred types."""
    kinds = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in df.schema)
    return tidy(df.select(*keys).withColumn("types", F.lit(kinds)))


@query
def csv_scan(spark, folder):
    return _typed(_through_file(spark, folder, "customer", "csv"), ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])


@query
def tsv_scan(spark, folder):
    return _typed(_through_file(spark, folder, "part", "tsv"), ["p_partkey", "p_name", "p_size", "p_retailprice"])


@query
def txt_scan(spark, folder):
    return _typed(_through_file(spark, folder, "supplier", "txt"), ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"])


@query
def csv_reader_options(spark, folder):
    df = _through_file(spark, folder, "supplier", "csv", sep=";", schema="s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double")
    return _typed(df, ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"])


@query
def csv_multiline_texts(spark, folder):
    """Texts with line breaks and quotes survive the round trip."""
    df = _through_file(spark, folder, "conversations", "csv")
    return tidy(df.select("conv_id", "turn", "role", F.length("text").alias("length"), F.md5("text").alias("digest")))


@query
def csv_mixed_headers(spark, folder):
    """Files with their columns in two orders, some texts over several lines, read by one pattern."""
    base = f"{shared_folder(spark)}/mixed-{uuid.uuid4().hex}"
    source = table(spark, folder, "conversations")
    for i, order in enumerate((["conv_id", "turn", "role", "text"], ["text", "role", "conv_id", "turn"])):
        part = source.where(F.col("turn") % 2 == i).select(*order)
        part.write.option("header", True).option("escape", '"').csv(f"{base}-{i}.csv")
    df = load_dataset(spark, f"{base}-*.csv")
    return tidy(df.select("conv_id", "turn", "role", F.length("text").alias("length"), F.md5("text").alias("digest")))


@query
def missing_tokens(spark, folder):
    """Spellings of missing values become NULL before the types are inferred."""
    source = table(spark, folder, "customer")
    nation = F.col("c_nationkey")
    spelled = source.select(
        "c_custkey",
        F.when(nation == 3, "NA").when(nation == 4, "#N/A").when(nation == 5, "null").when(nation == 6, "none").otherwise(F.col("c_mktsegment")).alias("segmento"),
        F.when(nation == 7, "NaN").when(nation == 8, "-nan").otherwise(nation.cast("string")).alias("nacion"),
    )
    cleaned = files.missing_to_null(spelled)
    return _typed(files.cast_inferred(cleaned, files.examine(cleaned)[0]), ["c_custkey", "segmento", "nacion"])


@query
def run_metadata(spark, folder):
    """Size recorded for a run; the time stamps are not comparable."""
    config = AnalysisConfig(correlation_methods=["pearson"], anomaly_methods=["zscore"], clustering_algorithm="none")
    report = Analyzer(spark, config).analyze(table(spark, folder, "supplier"), "s_suppkey")
    return tidy(report.metadata.select(F.lit("supplier").alias("source"), "n_rows", "n_cols"))


@query
def display_times(spark, folder):
    """Times of several spellings as a report shows them."""
    key, date = F.col("o_orderkey"), F.col("o_orderdate")
    spelled = (
        F.when(key % 5 == 0, None).when(key % 5 == 1, F.concat(F.lit("pedido "), key)).when(key % 5 == 2, F.date_format(date, "yyyy-MM-dd"))
        .when(key % 5 == 3, F.concat(F.date_format(date, "yyyy-MM-dd"), F.lit("T23:05:09.25+02:00"))).otherwise(F.concat(F.date_format(date, "yyyy-MM-dd"), F.lit(" 07:45")))
    )
    return table(spark, folder, "orders").select("o_orderkey", text.shown_time(spelled).alias("generado"))


@query
def many_datasets(spark, folder):
    """Two files and a missing one: the runs that succeed, with their sizes."""
    config = AnalysisConfig(correlation_methods=["pearson"], anomaly_methods=["zscore"], clustering_algorithm="none")
    paths = {_as_file(spark, folder, n, "csv"): n for n in ("supplier", "nation")}
    reports = Analyzer(spark, config).analyze_many([*paths, f"{shared_folder(spark)}/absent.csv"])
    frames = [r.metadata.select(F.lit(paths[p]).alias("source"), "n_rows", "n_cols") for p, r in reports.items()]
    return tidy(reduce(DataFrame.unionByName, frames))


# ----------------------------------------------------------------- cleaning (P)
def _padded_customers(spark, folder) -> DataFrame:
    key = F.col("c_custkey")
    name = F.when(key % 4 == 0, F.concat(F.lit("  "), F.col("c_name"), F.lit("\t "))).when(key % 4 == 1, F.concat(F.lit(" "), F.col("c_name"))).otherwise(F.col("c_name"))
    segment = F.when(key % 5 == 0, "   ").otherwise(F.col("c_mktsegment"))
    return table(spark, folder, "customer").select("c_custkey", name.alias("c_name"), segment.alias("c_mktsegment"), "c_acctbal")


@query
def clean_text(spark, folder):
    return clean.trim_text(_padded_customers(spark, folder))


def _sparse_customers(spark, folder) -> DataFrame:
    gone = F.col("c_custkey") % 7 == 0
    kept = lambda c: F.when(~gone, F.col(c)).alias(c)
    return table(spark, folder, "customer").select(
        "c_custkey", kept("c_name"), kept("c_acctbal"), kept("c_mktsegment"), F.lit(None).cast("string").alias("vacia")
    )


@query
def drop_all_null(spark, folder):
    df = clean.drop_empty_columns(_sparse_customers(spark, folder), "c_custkey")
    return clean.drop_empty_rows(df, "c_custkey")


@query
def dedup_rows(spark, folder):
    df = table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber")
    return tidy(clean.drop_duplicate_rows(df))


@query
def dedup_first_row(spark, folder):
    df = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return clean.drop_duplicate_rows(df, "o_orderkey")


def _dirty_orders(spark, folder) -> DataFrame:
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.concat(F.lit(" "), F.col("o_orderstatus")).alias("estado"),
        F.when(F.col("o_orderpriority").startswith("5"), "").otherwise(F.col("o_orderpriority")).alias("prioridad"),
        F.lit("  ").alias("nota"),
        (F.col("o_custkey") % 100).alias("grupo"),
    )


@query
def basic_clean(spark, folder):
    return clean.basic_clean(_dirty_orders(spark, folder), "o_orderkey").select("o_orderkey", "estado", "prioridad", "grupo")


@query
def cleaning_summary(spark, folder):
    before = _dirty_orders(spark, folder)
    return clean.cleaning_summary(before, clean.basic_clean(before, "o_orderkey"), "o_orderkey")


@query
def numeric_projection(spark, folder):
    return tidy(features.numeric_projection(gappy_events(spark, folder), ["value", "doble"], ["event_id"]))


@query
def complete_pairs(spark, folder):
    return tidy(clean.complete_pairs(gappy_events(spark, folder), "value", "doble"))


@query
def coerced_numbers(spark, folder):
    source = table(spark, folder, "customer")
    spelled = F.when(F.col("c_nationkey") == 7, "n/d").when(F.col("c_nationkey") == 8, " 8.50 ").otherwise(F.col("c_nationkey").cast("string"))
    return tidy(clean.coerce_numbers(source.select("c_custkey", spelled.alias("nacion")), ["nacion"]))


# ---------------------------------------------------------------- profiling (T)
def _flat(prof: DataFrame) -> DataFrame:
    return tidy(prof.drop("physical_type").withColumn("sample_values", F.array_join("sample_values", "|")))


@query
def profile_orders(spark, folder):
    df = table(spark, folder, "orders")
    return _flat(profile.column_profile(df, df.columns, "o_orderkey"))


@query
def profile_events(spark, folder):
    df = gappy_events(spark, folder).drop("doble")
    return _flat(profile.column_profile(df, df.columns, "event_id"))


@query
def profile_documents(spark, folder):
    df = table(spark, folder, "documents")
    return _flat(profile.column_profile(df, ["doc_id", "text", "lang", "source", "n_chars"], "doc_id").withColumn("sample_values", F.transform("sample_values", F.md5)))


def _typed_texts(spark, folder) -> DataFrame:
    """orders with booleans, dates and near misses spelled as text."""
    status, key = F.col("o_orderstatus"), F.col("o_orderkey")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(status == "O", " Sí ").otherwise("no").alias("abierto"),
        F.when(status == "O", "yes").when(status == "F", "no").otherwise("t").alias("tres_valores"),
        F.when(status == "O", "yes").otherwise("maybe").alias("casi_logico"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("fecha"),
        F.date_format("o_orderdate", "dd/MM/yyyy HH:mm").alias("fecha_hora"),
        F.when(key % 5 == 0, "a-b").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("casi_fecha"),
        F.concat(F.lit("id"), key.cast("string")).alias("codigo"),
        (F.col("o_totalprice") > 250000).alias("caro"),
    )


@query
def profile_text_types(spark, folder):
    df = _typed_texts(spark, folder)
    return tidy(profile.column_profile(df, df.columns[1:], "o_orderkey").select("ord", "name", "logical_type", "unique_count"))


@query
def date_text_values(spark, folder):
    df = _typed_texts(spark, folder)
    parsed = lambda c: F.date_format(profile.date_from_text(F.col(c)), "yyyy-MM-dd HH:mm").alias(c)
    return df.select("o_orderkey", parsed("fecha"), parsed("fecha_hora"), parsed("casi_fecha"))


@query
def dataset_profile(spark, folder):
    df = gappy_events(spark, folder)
    return tidy(profile.dataset_profile(profile.column_profile(df, df.columns, "event_id")))


@query
def columns_by_type(spark, folder):
    df = _typed_texts(spark, folder)
    grouped = profile.columns_by_type(profile.column_profile(df, df.columns, "o_orderkey"))
    return grouped.select("logical_type", F.array_join("names", "|").alias("names"))


@query
def type_composition(spark, folder):
    df = _typed_texts(spark, folder)
    return profile.type_composition(profile.column_profile(df, df.columns, "o_orderkey"))


@query
def missing_total(spark, folder):
    return profile.missing_total(profile.gap_counts(gappy_events(spark, folder), ["event_id", "value", "doble", "vacia", "constante"]))


@query
def gap_counts(spark, folder):
    return tidy(profile.gap_counts(gappy_events(spark, folder), ["event_id", "value", "doble", "vacia", "constante"]))


@query
def profile_view(spark, folder):
    df = gappy_events(spark, folder).drop("doble")
    return profile.profile_view(profile.column_profile(df, df.columns, "event_id"))


# -------------------------------------------------------------- descriptive (A)
@query
def describe_lineitem(spark, folder):
    return tidy(describe.describe(table(spark, folder, "lineitem"), PRICES))


@query
def describe_nulls(spark, folder):
    return tidy(describe.describe(gappy_events(spark, folder), ["value", "vacia", "constante", "ausente"]))


@query
def describe_rounded_view(spark, folder):
    return describe.rounded_view(describe.describe(table(spark, folder, "orders"), ["o_totalprice", "o_custkey"]))


@query
def group_describe(spark, folder):
    return tidy(describe.group_moments(table(spark, folder, "events"), "event_type", ["value"]))


@query
def mode_smallest(spark, folder):
    return tidy(describe.mode_smallest(table(spark, folder, "part"), ["p_size", "p_retailprice"]))


@query
def categorical_summary(spark, folder):
    df = table(spark, folder, "orders").withColumn("nada", F.lit(None).cast("string"))
    return tidy(describe.categorical_summary(df, ["o_orderstatus", "o_orderpriority", "nada"]))


@query
def categorical_view(spark, folder):
    df = table(spark, folder, "orders").withColumns({"caro": F.col("o_totalprice") > 250000, "nada": F.lit(None).cast("string")})
    return describe.categorical_view(describe.categorical_summary(df, ["o_orderpriority", "nada", "caro"]), ["caro"])


# ----------------------------------------------------- correlation and eta² (R)
@query
def pearson_long(spark, folder):
    return tidy(relate.pearson(priced(spark, folder), RELATED))


@query
def pearson_gaps(spark, folder):
    return tidy(relate.pearson(gappy_events(spark, folder), ["value", "doble", "vacia", "constante"]))


@query
def spearman_long(spark, folder):
    return tidy(relate.spearman(priced(spark, folder), RELATED))


@query
def spearman_gaps(spark, folder):
    return tidy(relate.spearman(gappy_events(spark, folder), ["value", "doble", "user_id"]))


@query
def kendall_long(spark, folder):
    return tidy(relate.kendall(table(spark, folder, "part"), PART_FEATURES))


@query
def strong_pairs(spark, folder):
    return tidy(relate.strong_pairs(relate.pearson(priced(spark, folder), RELATED), 0.4))


@query
def distinct_pairs(spark, folder):
    found = relate.strong_pairs(relate.correlations(priced(spark, folder), RELATED))
    return tidy(relate.distinct_pairs(found))


@query
def spearman_only(spark, folder):
    found = relate.strong_pairs(relate.correlations(priced(spark, folder), ["l_quantity", "l_extendedprice", "cubo"]))
    return tidy(relate.spearman_only(found).select("var_a", "var_b", "coefficient"))


@query
def strongest_value(spark, folder):
    return tidy(relate.strongest_value(relate.correlations(priced(spark, folder), RELATED)))


@query
def heatmap_matrix(spark, folder):
    return tidy(relate.full_matrix(relate.pearson(priced(spark, folder), RELATED, diagonal=True)))


@query
def wide_matrix(spark, folder):
    return tidy(relate.wide_matrix(relate.pearson(priced(spark, folder), RELATED, diagonal=True), RELATED))


@query
def relationship_sentences(spark, folder):
    found = relate.strong_pairs(relate.pearson(priced(spark, folder), RELATED), 0.4)
    return relate.relationship_sentences(found).select("var_a", "var_b", "sentence")


@query
def eta_squared(spark, folder):
    return tidy(relate.eta_squared(banded(spark, folder), ["l_returnflag", "l_linestatus", "banda"], PRICES))


@query
def dependencies(spark, folder):
    return tidy(relate.dependencies(banded(spark, folder), ["l_returnflag", "banda"], PRICES))


@query
def dependency_feed(spark, folder):
    return tidy(relate.dependency_feed(relate.dependencies(banded(spark, folder), ["l_returnflag", "banda"], PRICES)))


# ----------------------------------------------------------------- features (M)
@query
def impute_median(spark, folder):
    return tidy(features.impute_median(gappy_events(spark, folder), ["value", "doble", "constante"], ["event_id"]))


@query
def impute_scale(spark, folder):
    scaled = features.feature_frame(gappy_events(spark, folder), ["value", "doble", "constante"], ["event_id"])
    return scaled.select("event_id", *[(F.round(c, 6) + 0.0).alias(c) for c in ("value", "doble", "constante")])


@query
def pca_2d(spark, folder):
    df = priced(spark, folder).select("l_orderkey", "l_linenumber", "l_quantity", "importe")
    scaled = features.feature_frame(df, ["l_quantity", "importe"], ["l_orderkey", "l_linenumber"])
    view = features.project_2d(scaled, ["l_quantity", "importe"])
    return tidy(view.select("l_orderkey", "l_linenumber", (F.round("pc1", 6) + 0.0).alias("pc1"), (F.round("pc2", 6) + 0.0).alias("pc2")))


# --------------------------------------------------- clustering and segments (C)
@query
def kmeans_segments(spark, folder):
    scaled = standard(spark, folder, "part", "p_partkey", PART_FEATURES)
    return cluster.kmeans(scaled, PART_FEATURES, "p_partkey", 3).select("p_partkey", "label")


@query
def auto_k(spark, folder):
    scaled = standard(spark, folder, "supplier", "s_suppkey", ["s_nationkey", "s_acctbal"])
    best, scores = cluster.choose_k(scaled, ["s_nationkey", "s_acctbal"], "s_suppkey", (2, 4), restarts=2)
    return spark.createDataFrame([(k, s, k == best) for k, s in scores.items()], "k int, silhouette double, chosen boolean")


def planted_parts(spark, folder) -> DataFrame:
    """part with two coordinates in which the bands of the size lie far apart."""
    size = F.col("p_size")
    band = F.when(size <= 10, 0).when(size <= 25, 1).otherwise(2)
    return table(spark, folder, "part").select("p_partkey", (band * 100 + size * 0.01).alias("este"), (band * band * 40 - size * 0.02).alias("norte.sur"))


PLANTED = ["este", "norte.sur"]


@query
def kmeans_planted(spark, folder):
    """Three far groups: the optimum is unique; segments are numbered by size."""
    return tidy(cluster.kmeans(planted_parts(spark, folder), PLANTED, "p_partkey", 3).select("p_partkey", "label"))


@query
def auto_k_planted(spark, folder):
    """The number of far groups and the silhouette of all rows for it."""
    best, scores = cluster.choose_k(planted_parts(spark, folder), PLANTED, "p_partkey", (2, 4), restarts=3)
    return spark.createDataFrame([(best, round(scores[best], 6))], "k bigint, silhouette double")


@query
def analysis_guards(spark, folder):
    """Which stages run on whole and on reduced tables, and which errors are told apart."""
    parts, said = planted_parts(spark, folder), []
    run = lambda df, **options: Analyzer(spark, AnalysisConfig(anomaly_methods=["zscore"], kmeans_k=3, **options)).analyze(df, "p_partkey")
    whole, single = run(parts), run(parts.select("p_partkey", "este"))
    for case, report in (("whole", whole), ("one_column", single), ("one_row", run(parts.where("p_partkey = 1")))):
        n = report.clustering.n_clusters if report.clustering else 0
        said.append((case, report.profile.n_rows, report.correlations.count(), n, len(report.anomaly_methods), report.insights.count() > 0))
    try:
        run(parts.where("p_partkey < 0"))
    except EmptyDatasetError:
        said.append(("empty", 0, 0, 0, 0, False))
    said.append(("registry", len(cluster.ALGORITHMS), 0, 0, len(anomaly.DETECTORS), False))
    return spark.createDataFrame(said, "caso string, filas bigint, pares bigint, segmentos bigint, metodos bigint, hallazgos boolean")


@query
def silhouette_score(spark, folder):
    """Euclidean silhouette of the given labels of the embeddings."""
    df = table(spark, folder, "embeddings")
    width = len(df.select("embedding").first()[0])
    cols = [f"e{i}" for i in range(width)]
    wide = df.select("vec_id", "label", *[F.get("embedding", F.lit(i)).cast("double").alias(c) for i, c in enumerate(cols)])
    score, used = cluster.silhouettes(wide, cols, "vec_id", ["label"])["label"]
    one = spark.createDataFrame([(score, used)], "silhouette double, n bigint")
    return one.select(F.round("silhouette", 6).alias("silhouette"), "n", text.quality_label(F.col("silhouette")).alias("calidad"))


@query
def dbscan_labels(spark, folder):
    scaled = standard(spark, folder, "part", "p_partkey", PART_FEATURES)
    return tidy(dbscan.dbscan(scaled, PART_FEATURES, "p_partkey", 0.08, 5))


@query
def dbscan_dense(spark, folder):
    """Wide radius: most rows fall into cells that count as one node."""
    scaled = standard(spark, folder, "customer", "c_custkey", ["c_nationkey", "c_acctbal"])
    return tidy(dbscan.dbscan(scaled, ["c_nationkey", "c_acctbal"], "c_custkey", 0.5, 5))


@query
def k_distance_curve(spark, folder):
    scaled = standard(spark, folder, "part", "p_partkey", PART_FEATURES)
    return dbscan.k_distances(scaled, PART_FEATURES, "p_partkey", 5).select("p_partkey", F.round("k_distance", 6).alias("k_distance"))


@query
def knee_eps(spark, folder):
    scaled = standard(spark, folder, "part", "p_partkey", PART_FEATURES)
    return spark.createDataFrame([(round(dbscan.estimate_eps(scaled, PART_FEATURES, "p_partkey"), 6),)], "eps double")


@query
def cluster_sizes(spark, folder):
    return tidy(cluster.cluster_sizes(labelled_parts(spark, folder)))


@query
def segment_ranking(spark, folder):
    return tidy(cluster.segment_ranking(cluster.cluster_sizes(labelled_parts(spark, folder))))


@query
def segment_overview(spark, folder):
    return tidy(cluster.segment_overview(cluster.cluster_sizes(labelled_parts(spark, folder))))


@query
def segment_traits(spark, folder):
    return tidy(segments.segment_traits(labelled_parts(spark, folder), PART_FEATURES))


@query
def segment_categories(spark, folder):
    return tidy(segments.segment_categories(labelled_parts(spark, folder), ["p_type", "p_brand", "es_caro"]))


@query
def segment_profiles(spark, folder):
    found = segments.segment_profiles(labelled_parts(spark, folder), PART_FEATURES, ["p_type", "es_caro"])
    return tidy(found.select("segmento", "nombre", "tamano", "porcentaje", "descripcion"))


@query
def segment_general_row(spark, folder):
    return segments.segment_table(labelled_parts(spark, folder), PART_FEATURES, ["p_type", "es_caro"])


@query
def scatter_feed(spark, folder):
    rows = labelled_parts(spark, folder)
    scaled = features.feature_frame(rows, PART_FEATURES, ["p_partkey", "label"])
    feed = segments.scatter_feed(features.project_2d(scaled, PART_FEATURES), "p_partkey")
    return tidy(feed.withColumns({"pc1": F.round("pc1", 6) + 0.0, "pc2": F.round("pc2", 6) + 0.0}))


# ---------------------------------------------------------------- anomalies (N)
SIGNALS = ["value", "grupo_usuario"]
TWO_METHODS = AnalysisConfig(anomaly_methods=["zscore", "IQR", "desconocido"])


def _flagged(spark, folder) -> tuple[DataFrame, list[str]]:
    return anomaly.detect_anomalies(signals(spark, folder), SIGNALS, "event_id", TWO_METHODS)


@query
def zscore_flags(spark, folder):
    return anomaly.zscore_flags(signals(spark, folder), SIGNALS).select("event_id", F.col("is_zscore").cast("bigint").alias("is_zscore"))


@query
def zscore_counts(spark, folder):
    df = features.impute_median(gappy_events(spark, folder), ["value", "doble", "constante"], ["event_id"])
    return anomaly.zscore_counts(df, ["value", "doble", "constante"])


@query
def iqr_bounds(spark, folder):
    df = features.impute_median(gappy_events(spark, folder), ["value", "doble", "constante"], ["event_id"])
    return tidy(anomaly.iqr_bounds(df, ["value", "doble", "constante"]))


@query
def iqr_flags(spark, folder):
    return anomaly.iqr_flags(signals(spark, folder), SIGNALS).select("event_id", F.col("is_iqr").cast("bigint").alias("is_iqr"))


@query
def anomaly_summary(spark, folder):
    return tidy(anomaly.anomaly_summary(*_flagged(spark, folder)))


@query
def anomaly_consensus(spark, folder):
    return anomaly.agreement_counts(*_flagged(spark, folder))


@query
def review_queue(spark, folder):
    flagged, methods = _flagged(spark, folder)
    return tidy(anomaly.review_queue(flagged, methods, "event_id"))


@query
def anomaly_scatter(spark, folder):
    flagged, methods = _flagged(spark, folder)
    return anomaly.scatter_classes(flagged, "iqr", methods).select("event_id", "clase")


@query
def method_comparison(spark, folder):
    shown = anomaly.method_comparison(anomaly.anomaly_summary(*_flagged(spark, folder)))
    return tidy(shown.withColumn("mas_amplio", F.col("mas_amplio").cast("bigint")))


@query
def iforest_flags(spark, folder):
    found = iforest.isolation_forest_flags(signals(spark, folder), SIGNALS, "event_id")
    return found.select("event_id", "iforest_score", "is_isolation_forest")


@query
def iforest_fraction(spark, folder):
    found = iforest.isolation_forest_flags(signals(spark, folder), SIGNALS, "event_id", 0.05)
    return found.select("event_id", "is_isolation_forest")


def planted_signals(spark, folder) -> DataFrame:
    """signals with every hundredth row far outside."""
    out = F.col("event_id") % 100 == 0
    rows = signals(spark, folder)
    return rows.select("event_id", F.when(out, 1e7 + F.col("event_id")).otherwise(F.col("value")).alias("value"), F.when(out, -1e7).otherwise(F.col("grupo_usuario")).alias("grupo.usuario"))


@query
def iforest_planted(spark, folder):
    """The rows planted far outside, as flagged by the automatic limit, and whether they score above all others."""
    found = iforest.isolation_forest_flags(planted_signals(spark, folder), ["value", "grupo.usuario"], "event_id")
    planted = F.col("event_id") % 100 == 0
    ends = found.agg(F.max(F.when(~planted, F.col("iforest_score"))).alias("highest_other"))
    return found.where(planted).crossJoin(F.broadcast(ends)).select("event_id", "is_isolation_forest", (F.col("iforest_score") > F.col("highest_other")).alias("above_others"))


@query
def iforest_planted_fraction(spark, folder):
    """One row in a hundred is flagged: the planted ones."""
    rows = planted_signals(spark, folder)
    share = rows.agg(F.avg((F.col("event_id") % 100 == 0).cast("double"))).first()[0]
    found = iforest.isolation_forest_flags(rows, ["value", "grupo.usuario"], "event_id", share)
    return found.where("is_isolation_forest").select("event_id")


# ----------------------------------------------------------------- insights (I)
def _order_profile(spark, folder) -> DataFrame:
    df = _dirty_orders(spark, folder).withColumns({"estado": F.trim("estado"), "prioridad": F.nullif("prioridad", F.lit("")), "nota": F.nullif(F.trim("nota"), F.lit(""))})
    return profile.column_profile(df, df.columns, "o_orderkey")


@query
def dataset_insight(spark, folder):
    return insights.dataset_insight(_order_profile(spark, folder)).select("category", "severity", "message")


@query
def missing_insights(spark, folder):
    return insights.missing_insights(_order_profile(spark, folder)).select("category", "severity", "message")


@query
def correlation_insights(spark, folder):
    pairs = relate.distinct_pairs(relate.strong_pairs(relate.correlations(priced(spark, folder), RELATED)))
    return tidy(insights.correlation_insights(pairs).select("row_ord", "category", "message"))


@query
def dependency_insights(spark, folder):
    found = relate.dependencies(banded(spark, folder), ["l_returnflag", "banda"], PRICES)
    return tidy(insights.dependency_insights(found).select("row_ord", "category", "message"))


@query
def anomaly_insights(spark, folder):
    return tidy(insights.anomaly_insights(anomaly.anomaly_summary(*_flagged(spark, folder))).select("row_ord", "category", "severity", "message"))


@query
def clustering_insights(spark, folder):
    """Sentences for given labels with their silhouette."""
    rows = labelled_parts(spark, folder)
    scaled = features.feature_frame(rows, PART_FEATURES, ["p_partkey", "label"])
    score, used = cluster.silhouettes(scaled, PART_FEATURES, "p_partkey", ["label"])["label"]
    summary = spark.createDataFrame([("dbscan", PART_FEATURES, score, used)], "algorithm string, features array<string>, silhouette double, silhouette_rows bigint")
    overview = cluster.segment_overview(cluster.cluster_sizes(rows)).select("n_clusters")
    n = overview.first()["n_clusters"]
    summary = summary.withColumns({"n_clusters": F.lit(n), "calidad": text.quality_label(F.col("silhouette"))})
    return tidy(insights.clustering_insights(summary).select("row_ord", "category", "severity", "message"))


@query
def insights_table(spark, folder):
    pairs = relate.distinct_pairs(relate.strong_pairs(relate.pearson(priced(spark, folder), RELATED).withColumn("method_ord", F.lit(0))))
    found = relate.dependencies(banded(spark, folder), ["banda"], PRICES)
    prof = cut_lineage(_order_profile(spark, folder))
    parts = [
        insights.dataset_insight(prof), insights.missing_insights(prof),
        insights.correlation_insights(pairs), insights.dependency_insights(found),
        insights.anomaly_insights(anomaly.anomaly_summary(*_flagged(spark, folder))),
    ]
    return tidy(insights.assemble(parts))


def _summary_inputs(spark, folder):
    prof = _order_profile(spark, folder)
    pairs = relate.distinct_pairs(relate.strong_pairs(relate.pearson(priced(spark, folder), RELATED).withColumn("method_ord", F.lit(0))))
    found = relate.dependencies(banded(spark, folder), ["banda"], PRICES)
    rows = labelled_parts(spark, folder)
    score, _ = cluster.silhouettes(features.feature_frame(rows, PART_FEATURES, ["p_partkey", "label"]), PART_FEATURES, "p_partkey", ["label"])["label"]
    sizes = cluster.segment_overview(cluster.cluster_sizes(rows))
    clustering = sizes.select(F.lit("kmeans").alias("algorithm"), "n_clusters", text.quality_label(F.lit(score).cast("double")).alias("calidad"))
    return prof, pairs, found, clustering, anomaly.agreement_counts(*_flagged(spark, folder))


@query
def executive_summary(spark, folder):
    prof, pairs, _, clustering, agreement = _summary_inputs(spark, folder)
    return insights.executive_summary(prof, pairs, clustering, agreement)


@query
def recommendations(spark, folder):
    _, pairs, found, clustering, agreement = _summary_inputs(spark, folder)
    return tidy(insights.recommendations(pairs, found, clustering, agreement))


@query
def custom_provider(spark, folder):
    """A user's statistics provider called with the cleaned table and its profile."""
    df = table(spark, folder, "supplier")
    prof = profile.load_profile(profile.column_profile(df, ["s_nationkey", "s_acctbal", "s_name"], "s_suppkey"))
    return tidy(basic_statistics(df, prof).select("variable", "media", "conteo"))


@query
def full_report(spark, folder):
    """Findings of the complete analysis with a given number of segments."""
    config = AnalysisConfig(kmeans_k=3)
    return tidy(Analyzer(spark, config).analyze(table(spark, folder, "supplier"), "s_suppkey").insights)


@query
def full_report_planted(spark, folder):
    """Every figure of a complete analysis of three far groups whose optimum is unique."""
    parts = planted_parts(spark, folder).withColumnRenamed("norte.sur", "norte").withColumn("este", F.col("este") + F.col("p_partkey") * 3e-7)
    parts = parts.withColumn("banda", F.concat(F.lit("b"), F.floor(F.col("este") / 100)))
    config = AnalysisConfig(correlation_methods=["pearson", "spearman"], anomaly_methods=["zscore", "iqr"], kmeans_k=3)
    report = Analyzer(spark, config, basic_statistics).analyze(parts, "p_partkey")
    said = lambda df, part, item, value: df.select(F.lit(part).alias("part"), item.cast("string").alias("item"), F.round(F.col(value).cast("double"), 6).alias("value"))
    both = F.concat_ws("|", "var_a", "var_b")
    rows = [
        said(report.metadata, "rows", F.lit(""), "n_rows"), said(report.metadata, "columns", F.lit(""), "n_cols"),
        said(report.descriptive, "mean", F.col("variable"), "media"), said(report.descriptive, "median", F.col("variable"), "mediana"),
        said(report.correlations.where("method = 'pearson'"), "pearson", both, "coefficient"),
        said(report.correlations.where("method = 'spearman'"), "spearman", both, "coefficient"),
        said(report.dependencies, "eta", F.concat_ws("|", "categorical", "numeric"), "eta_squared"),
        said(report.clustering.sizes, "segment", F.col("label"), "size"),
        said(report.clustering_summary(), "silhouette", F.lit(""), "silhouette"),
        said(report.anomaly_summary, "anomalies", F.col("method"), "outlier_count"),
        said(report.agreement(), "any_signal", F.lit(""), "any_signal"),
    ]
    return reduce(DataFrame.unionByName, rows)
