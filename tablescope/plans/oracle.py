"""SQL that computes the same results as the registered queries, for checking."""

from __future__ import annotations

SQL: dict[str, str] = {}


def sig(c: str) -> str:
    """Nine significant digits, nine decimals below one."""
    scale = f"pow(10.0::DOUBLE, 8 - greatest(floor(log10(abs({c}))), -1.0))"
    return f"CASE WHEN {c} = 0 THEN 0.0::DOUBLE ELSE round({c} * {scale}, 0) / {scale} + 0.0::DOUBLE END"


def tidy(inner: str, doubles: list[str], others: list[str]) -> str:
    shown = [f'"{o}"' for o in others] + [f'{sig(chr(34) + d + chr(34))} AS "{d}"' for d in doubles]
    return f"SELECT {', '.join(shown)} FROM ({inner}) AS result_rows"


def union(parts: list[str]) -> str:
    return " UNION ALL ".join(f"({p})" for p in parts)


# --------------------------------------------------------------- derived inputs
PRICES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
RELATED = ["l_quantity", "l_extendedprice", "importe", "cubo"]
PRICED = "(SELECT *, l_quantity * l_extendedprice AS importe, exp(l_quantity / 3) AS cubo FROM lineitem)"
GAPPY = """(SELECT event_id, user_id, event_type, CASE WHEN event_id % 10 <> 0 THEN value END AS value,
    CASE WHEN event_id % 3 <> 0 THEN value * 2 + user_id END AS doble,
    NULL::DOUBLE AS vacia, 7.0::DOUBLE AS constante FROM events)"""
SIGNALS = "(SELECT event_id, value, (user_id % 50)::DOUBLE AS grupo_usuario FROM events)"
BANDED = "(SELECT *, CASE WHEN l_quantity <= 10 THEN 'baja' WHEN l_quantity <= 35 THEN 'media' ELSE 'alta' END AS banda FROM lineitem)"
PARTS = """(SELECT *, CASE WHEN p_size <= 10 THEN 0 WHEN p_size <= 25 THEN 1 WHEN p_size <= 45 THEN 2 ELSE -1 END AS label,
    p_retailprice > 1000 AS es_caro FROM part)"""
TYPED_TEXTS = """(SELECT o_orderkey,
    CASE WHEN o_orderstatus = 'O' THEN ' Sí ' ELSE 'no' END AS abierto,
    CASE WHEN o_orderstatus = 'O' THEN 'yes' WHEN o_orderstatus = 'F' THEN 'no' ELSE 't' END AS tres_valores,
    CASE WHEN o_orderstatus = 'O' THEN 'yes' ELSE 'maybe' END AS casi_logico,
    strftime(o_orderdate, '%Y-%m-%d') AS fecha, strftime(o_orderdate, '%d/%m/%Y %H:%M') AS fecha_hora,
    CASE WHEN o_orderkey % 5 = 0 THEN 'a-b' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS casi_fecha,
    'id' || o_orderkey AS codigo, o_totalprice > 250000 AS caro FROM orders)"""
DIRTY_ORDERS = """(SELECT o_orderkey, ' ' || o_orderstatus AS estado,
    CASE WHEN starts_with(o_orderpriority, '5') THEN '' ELSE o_orderpriority END AS prioridad, '  ' AS nota, o_custkey % 100 AS grupo FROM orders)"""
CLEAN_ORDERS = f"""(SELECT min(o_orderkey) AS o_orderkey, estado, prioridad, grupo FROM
    (SELECT o_orderkey, trim(estado) AS estado, nullif(prioridad, '') AS prioridad, grupo FROM {DIRTY_ORDERS}) GROUP BY estado, prioridad, grupo)"""


def standard(source: str, key: str, cols: list[str]) -> str:
    """Scaled columns v0, v1, ... next to the key (no gaps expected)."""
    scaled = ", ".join(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS v{i}" for i, c in enumerate(cols))
    return f"(SELECT {key}, {scaled} FROM {source})"


PART_POINTS = standard("part", "p_partkey", ["p_size", "p_retailprice"])

# ------------------------------------------------------------------ sources (S)
SQL["csv_scan"] = tidy(
    """SELECT c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey, c_acctbal, c_mktsegment,
    'c_custkey:bigint,c_name:string,c_nationkey:bigint,c_acctbal:double,c_mktsegment:string' AS types FROM customer""",
    ["c_acctbal"], ["c_custkey", "c_name", "c_nationkey", "c_mktsegment", "types"],
)
SQL["tsv_scan"] = tidy(
    """SELECT p_partkey, p_name, p_size::BIGINT AS p_size, p_retailprice,
    'p_partkey:bigint,p_name:string,p_brand:string,p_type:string,p_size:bigint,p_retailprice:double' AS types FROM part""",
    ["p_retailprice"], ["p_partkey", "p_name", "p_size", "types"],
)
SQL["txt_scan"] = tidy(
    """SELECT s_suppkey, s_name, s_nationkey::BIGINT AS s_nationkey, s_acctbal,
    's_suppkey:bigint,s_name:string,s_nationkey:bigint,s_acctbal:double' AS types FROM supplier""",
    ["s_acctbal"], ["s_suppkey", "s_name", "s_nationkey", "types"],
)
SQL["csv_reader_options"] = SQL["txt_scan"].replace("s_nationkey:bigint", "s_nationkey:int")
SQL["csv_multiline_texts"] = "SELECT conv_id, turn, role, length(text)::BIGINT AS length, md5(text) AS digest FROM conversations"
SQL["csv_mixed_headers"] = SQL["csv_multiline_texts"]
SQL["missing_tokens"] = """SELECT c_custkey,
    CASE WHEN c_nationkey IN (3, 4, 5) THEN NULL WHEN c_nationkey = 6 THEN 'none' ELSE c_mktsegment END AS segmento,
    CASE WHEN c_nationkey IN (7, 8) THEN NULL ELSE c_nationkey::DOUBLE END AS nacion,
    'c_custkey:bigint,segmento:string,nacion:double' AS types FROM customer"""
SQL["run_metadata"] = "SELECT 'supplier' AS source, count(*)::BIGINT AS n_rows, 3::BIGINT AS n_cols FROM supplier"

SQL["display_times"] = """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'Fecha no disponible' WHEN 1 THEN 'pedido ' || o_orderkey
    WHEN 2 THEN strftime(o_orderdate, '%d/%m/%Y 00:00') WHEN 3 THEN strftime(o_orderdate, '%d/%m/%Y 23:05') ELSE strftime(o_orderdate, '%d/%m/%Y 07:45') END AS generado FROM orders"""
SQL["many_datasets"] = """SELECT 'supplier' AS source, count(*) AS n_rows, 4::BIGINT AS n_cols FROM supplier
    UNION ALL SELECT 'nation', count(*), 3::BIGINT FROM nation"""

# ----------------------------------------------------------------- cleaning (P)
SQL["clean_text"] = """SELECT c_custkey, c_name, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment, c_acctbal FROM customer"""
SQL["drop_all_null"] = "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 7 <> 0"
SQL["dedup_rows"] = "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber::BIGINT AS l_linenumber FROM lineitem"
SQL["dedup_first_row"] = "SELECT min(o_orderkey) AS o_orderkey, o_custkey, o_orderstatus FROM orders GROUP BY o_custkey, o_orderstatus"
SQL["basic_clean"] = f"SELECT o_orderkey, estado, prioridad, grupo FROM {CLEAN_ORDERS}"
SQL["cleaning_summary"] = f"""SELECT (SELECT count(*) FROM orders) AS rows_before, count(*) AS rows_after,
    (SELECT count(*) FROM orders) - count(*) AS removed_rows, 1::BIGINT AS removed_columns FROM {CLEAN_ORDERS}"""
SQL["numeric_projection"] = tidy(f"SELECT event_id, value, doble FROM {GAPPY}", ["value", "doble"], ["event_id"])
SQL["complete_pairs"] = tidy(f"SELECT value, doble FROM {GAPPY} WHERE value IS NOT NULL AND doble IS NOT NULL", ["value", "doble"], [])
SQL["coerced_numbers"] = """SELECT c_custkey,
    CASE WHEN c_nationkey = 7 THEN NULL WHEN c_nationkey = 8 THEN 8.5::DOUBLE ELSE c_nationkey::DOUBLE END AS nacion FROM customer"""


# ---------------------------------------------------------------- profiling (T)
# fixed values: as in the results
TOKENS = "('true', 'false', 'yes', 'no', 'si', 'sí', '1', '0', 't', 'f')"


def column_profile(source: str, key: str, cols: list[tuple[str, str]], shown: str = "string_agg(v, '|' ORDER BY first_id, v)") -> str:
    """One row per column; ``cols`` are (name, family), text being refined by value."""
    parts = []
    for i, (c, family) in enumerate(cols):
        text_type = f"""CASE WHEN bool_and(lower(trim(v)) IN {TOKENS}) AND count(DISTINCT lower(trim(v))) <= 2 THEN 'boolean'
            WHEN (SELECT bool_or(regexp_matches(x, '[-/:]')) AND avg(CASE WHEN coalesce(try_strptime(x, '%Y-%m-%d'), try_strptime(x, '%d/%m/%Y %H:%M')) IS NOT NULL THEN 1 ELSE 0 END) >= 0.9
                  FROM (SELECT {c}::VARCHAR AS x FROM {source} WHERE {c} IS NOT NULL ORDER BY {key} LIMIT 50)) THEN 'datetime'
            WHEN count(*) / sum(n) <= 0.5 THEN 'categorical' ELSE 'text' END"""
        kind = text_type if family == "text" else f"'{family}'"
        parts.append(
            f"""SELECT {i}::BIGINT AS ord, '{c}' AS name, CASE WHEN count(v) = 0 THEN 'unknown' ELSE {kind} END AS logical_type,
            (SELECT count(*) FROM {source}) AS n_rows, (SELECT count(*) - count({c}) FROM {source}) AS missing_count,
            (SELECT (count(*) - count({c})) / count(*) FROM {source}) AS missing_ratio, count(v) AS unique_count,
            coalesce((SELECT {shown} FROM (SELECT {c}::VARCHAR AS v, min({key}) AS first_id FROM {source} WHERE {c} IS NOT NULL
                GROUP BY 1 ORDER BY first_id, v LIMIT 5)), '') AS sample_values
            FROM (SELECT {c}::VARCHAR AS v, count(*) AS n FROM {source} WHERE {c} IS NOT NULL GROUP BY 1)"""
        )
    return union(parts)


PROFILE_COLUMNS = ["ord", "name", "logical_type", "n_rows", "missing_count", "unique_count", "sample_values"]
ORDERS_PROFILE = column_profile(
    "orders", "o_orderkey",
    [("o_orderkey", "numeric"), ("o_custkey", "numeric"), ("o_orderstatus", "text"), ("o_totalprice", "numeric"), ("o_orderdate", "datetime"), ("o_orderpriority", "text")],
)
EVENTS_PROFILE = column_profile(
    GAPPY, "event_id",
    [("event_id", "numeric"), ("user_id", "numeric"), ("event_type", "text"), ("value", "numeric"), ("vacia", "numeric"), ("constante", "numeric")],
)
ALL_EVENTS_PROFILE = column_profile(
    GAPPY, "event_id",
    [("event_id", "numeric"), ("user_id", "numeric"), ("event_type", "text"), ("value", "numeric"), ("doble", "numeric"), ("vacia", "numeric"), ("constante", "numeric")],
)
TEXTS = [("abierto", "text"), ("tres_valores", "text"), ("casi_logico", "text"), ("fecha", "text"), ("fecha_hora", "text"), ("casi_fecha", "text"), ("codigo", "text"), ("caro", "boolean")]
TEXTS_PROFILE = column_profile(TYPED_TEXTS, "o_orderkey", TEXTS)
KEYED_TEXTS_PROFILE = column_profile(TYPED_TEXTS, "o_orderkey", [("o_orderkey", "numeric"), *TEXTS])
SQL["profile_orders"] = tidy(ORDERS_PROFILE, ["missing_ratio"], PROFILE_COLUMNS)
SQL["profile_events"] = tidy(EVENTS_PROFILE, ["missing_ratio"], PROFILE_COLUMNS)
SQL["profile_documents"] = tidy(
    column_profile(
        "documents", "doc_id", [("doc_id", "numeric"), ("text", "text"), ("lang", "text"), ("source", "text"), ("n_chars", "numeric")],
        "string_agg(md5(v), '|' ORDER BY first_id, v)",
    ),
    ["missing_ratio"], PROFILE_COLUMNS,
)
SQL["profile_text_types"] = f"SELECT ord, name, logical_type, unique_count FROM ({TEXTS_PROFILE})"
PARSED = "strftime(coalesce(try_strptime({0}, '%Y-%m-%d'), try_strptime({0}, '%d/%m/%Y %H:%M')), '%Y-%m-%d %H:%M') AS {0}"
SQL["date_text_values"] = f"SELECT o_orderkey, {', '.join(PARSED.format(c) for c in ['fecha', 'fecha_hora', 'casi_fecha'])} FROM {TYPED_TEXTS}"


def of_type(kind: str) -> str:
    return f"count(*) FILTER (logical_type = '{kind}')"


TYPES = ["numeric", "categorical", "datetime", "boolean", "text", "unknown"]
SQL["dataset_profile"] = f"""SELECT max(n_rows) AS n_rows, count(*) AS n_cols, {", ".join(f"{of_type(k)} AS n_{k}" for k in TYPES)},
    sum(missing_count)::BIGINT AS missing_total FROM ({ALL_EVENTS_PROFILE})"""
SQL["columns_by_type"] = f"""SELECT logical_type, string_agg(name, '|' ORDER BY ord) AS names FROM ({KEYED_TEXTS_PROFILE})
    WHERE logical_type <> 'unknown' GROUP BY logical_type"""
SQL["type_composition"] = f"""SELECT CASE logical_type WHEN 'numeric' THEN 'Numéricas' WHEN 'categorical' THEN 'Categorías' WHEN 'datetime' THEN 'Fechas'
    WHEN 'boolean' THEN 'Sí / No' ELSE 'Texto' END AS tipo, count(*) AS variables FROM ({KEYED_TEXTS_PROFILE})
    WHERE logical_type <> 'unknown' GROUP BY logical_type"""
SQL["missing_total"] = f"SELECT (4 * count(*) - count(value) - count(doble) - count(constante) - count(vacia))::BIGINT AS missing_total FROM {GAPPY}"
SQL["gap_counts"] = tidy(
    union(
        f"SELECT {i}::BIGINT AS ord, '{c}' AS name, count(*) AS n_rows, count(*) - count({c}) AS missing_count, (count(*) - count({c})) / count(*) AS missing_ratio FROM {GAPPY}"
        for i, c in enumerate(["event_id", "value", "doble", "vacia", "constante"])
    ),
    ["missing_ratio"], ["ord", "name", "n_rows", "missing_count"],
)
SQL["profile_view"] = f"""SELECT name AS "Variable", CASE logical_type WHEN 'numeric' THEN 'Numérica' WHEN 'categorical' THEN 'Categoría'
    WHEN 'datetime' THEN 'Fecha' WHEN 'boolean' THEN 'Sí / No' WHEN 'text' THEN 'Texto' ELSE 'No identificado' END AS "Tipo detectado",
    missing_count AS "Faltantes", format('{{:.1f}}%', missing_ratio * 100) AS "% faltante", unique_count AS "Valores únicos",
    CASE WHEN sample_values = '' THEN '—' ELSE replace(sample_values, '|', ', ') END AS "Ejemplos" FROM ({EVENTS_PROFILE})"""


# -------------------------------------------------------------- descriptive (A)
STATISTICS = ["media", "mediana", "moda", "desviacion_estandar", "varianza", "minimo", "maximo", "rango", "q1", "q3", "iqr", "asimetria", "curtosis"]


def describe(source: str, cols: list[str]) -> str:
    parts = []
    for c in cols:
        parts.append(
            f"""SELECT '{c}' AS variable, avg(x) AS media, quantile_cont(x, 0.5) AS mediana,
            (SELECT {c}::DOUBLE FROM {source} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS moda,
            stddev_samp(x) AS desviacion_estandar, var_samp(x) AS varianza, min(x) AS minimo, max(x) AS maximo, max(x) - min(x) AS rango,
            quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3, quantile_cont(x, 0.75) - quantile_cont(x, 0.25) AS iqr,
            count(x) AS conteo, count(*) - count(x) AS faltantes,
            CASE WHEN count(x) < 3 THEN NULL WHEN min(x) = max(x) THEN 0.0 ELSE skewness(x) END AS asimetria,
            CASE WHEN count(x) < 4 THEN NULL WHEN min(x) = max(x) THEN 0.0 ELSE kurtosis(x) END AS curtosis
            FROM (SELECT {c}::DOUBLE AS x FROM {source})"""
        )
    return union(parts)


SQL["describe_lineitem"] = tidy(describe("lineitem", PRICES), STATISTICS, ["variable", "conteo", "faltantes"])
SQL["describe_nulls"] = tidy(describe(GAPPY, ["value", "vacia", "constante"]), STATISTICS, ["variable", "conteo", "faltantes"])
# fixed values: as in the results
HEADINGS = {
    "conteo": "Datos", "faltantes": "Faltantes", "media": "Media", "mediana": "Mediana", "moda": "Moda", "desviacion_estandar": "Desviación",
    "varianza": "Varianza", "minimo": "Mínimo", "q1": "Q1", "q3": "Q3", "maximo": "Máximo", "rango": "Rango", "iqr": "IQR", "asimetria": "Asimetría", "curtosis": "Curtosis",
}
SQL["describe_rounded_view"] = f"""SELECT variable AS "Variable", {", ".join(f'round_even({k}::DOUBLE * 100, 0) / 100 AS "{v}"' for k, v in HEADINGS.items())}
    FROM ({describe("orders", ["o_totalprice", "o_custkey"])})"""
SQL["group_describe"] = tidy(
    """SELECT event_type, count(*) AS tamano, count(value) AS conteo_value, avg(value) AS media_value, stddev_samp(value) AS desviacion_value,
    min(value) AS minimo_value, max(value) AS maximo_value FROM events GROUP BY event_type""",
    ["media_value", "desviacion_value", "minimo_value", "maximo_value"], ["event_type", "tamano", "conteo_value"],
)
SQL["mode_smallest"] = tidy(
    union(
        f"SELECT '{c}' AS variable, (SELECT {c}::DOUBLE FROM part GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS moda" for c in ["p_size", "p_retailprice"]
    ),
    ["moda"], ["variable"],
)


def category_summary(source: str, cols: list[str]) -> str:
    parts = []
    for i, c in enumerate(cols):
        top = f"FROM {source} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c}::VARCHAR LIMIT 1"
        parts.append(
            f"""SELECT {i}::BIGINT AS ord, '{c}' AS variable, count(DISTINCT {c}) AS categorias_unicas, (SELECT {c}::VARCHAR {top}) AS categoria_mas_frecuente,
            coalesce((SELECT count(*) {top}), 0) AS frecuencia, coalesce((SELECT count(*) {top}) / nullif(count({c}), 0) * 100, 0.0) AS porcentaje FROM {source}"""
        )
    return union(parts)


ORDERS_PLUS = "(SELECT *, o_totalprice > 250000 AS caro, NULL::VARCHAR AS nada FROM orders)"
SQL["categorical_summary"] = tidy(
    category_summary(ORDERS_PLUS, ["o_orderstatus", "o_orderpriority", "nada"]),
    ["porcentaje"], ["ord", "variable", "categorias_unicas", "categoria_mas_frecuente", "frecuencia"],
)
SQL["categorical_view"] = f"""SELECT variable AS "Variable", categorias_unicas AS "Categorías",
    CASE WHEN categoria_mas_frecuente IS NULL THEN '—' WHEN variable = 'caro' THEN CASE categoria_mas_frecuente WHEN 'true' THEN 'Sí' ELSE 'No' END
    ELSE categoria_mas_frecuente END AS "Más frecuente", frecuencia AS "Repeticiones", format('{{:.1f}}%', porcentaje) AS "% del total"
    FROM ({category_summary(ORDERS_PLUS, ["o_orderpriority", "nada", "caro"])})"""


# ----------------------------------------------------- correlation and eta² (R)
def pairs(cols: list[str], diagonal: bool = False) -> list[tuple[int, str, str]]:
    return [(i * len(cols) + j, cols[i], cols[j]) for i in range(len(cols)) for j in range(i if diagonal else i + 1, len(cols))]


def correlation(source: str, cols: list[str], method: str = "pearson", diagonal: bool = False) -> str:
    parts = []
    for order, a, b in pairs(cols, diagonal):
        x = f"(SELECT {a} AS x, {b} AS y FROM {source} WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"
        if method == "spearman":
            ranked = ", ".join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2 AS {c}" for c in "xy")
            x = f"(SELECT {ranked} FROM {x})"
        parts.append(
            f"""SELECT '{method}' AS method, {order}::BIGINT AS ord, '{a}' AS var_a, '{b}' AS var_b,
            CASE WHEN count(*) = 0 OR min(x) = max(x) OR min(y) = max(y) THEN NULL ELSE corr(y, x) END AS coefficient, count(*) AS n FROM {x}"""
        )
    return union(parts)


LONG = ["method", "ord", "var_a", "var_b", "n"]
STRENGTH = "CASE WHEN abs(coefficient) >= 0.7 THEN 'fuerte' WHEN abs(coefficient) >= 0.4 THEN 'moderada' ELSE 'débil' END"
DIRECTION = "CASE WHEN coefficient > 0 THEN 'positiva' ELSE 'negativa' END"
BOTH = union([f"SELECT *, 0::BIGINT AS method_ord FROM ({correlation(PRICED, RELATED)})", f"SELECT *, 1::BIGINT AS method_ord FROM ({correlation(PRICED, RELATED, 'spearman')})"])
DISTINCT = f"""SELECT *, {STRENGTH} AS strength, {DIRECTION} AS direction FROM ({BOTH}) WHERE abs(coefficient) >= 0.7
    QUALIFY row_number() OVER (PARTITION BY least(var_a, var_b), greatest(var_a, var_b) ORDER BY method_ord, ord) = 1"""
SQL["pearson_long"] = tidy(correlation(PRICED, RELATED), ["coefficient"], LONG)
SQL["pearson_gaps"] = tidy(correlation(GAPPY, ["value", "doble", "vacia", "constante"]), ["coefficient"], LONG)
SQL["spearman_long"] = tidy(correlation(PRICED, RELATED, "spearman"), ["coefficient"], LONG)
SQL["spearman_gaps"] = tidy(correlation(GAPPY, ["value", "doble", "user_id"], "spearman"), ["coefficient"], LONG)
SQL["kendall_long"] = tidy(
    """SELECT 'kendall' AS method, 1::BIGINT AS ord, 'p_size' AS var_a, 'p_retailprice' AS var_b, (SELECT count(*) FROM part) AS n,
    sum(sign(a.p_size - b.p_size) * sign(a.p_retailprice - b.p_retailprice))
      / (sqrt(sum(CASE WHEN a.p_size <> b.p_size THEN 1.0 ELSE 0.0 END)) * sqrt(sum(CASE WHEN a.p_retailprice <> b.p_retailprice THEN 1.0 ELSE 0.0 END))) AS coefficient
    FROM part a JOIN part b ON a.p_partkey <> b.p_partkey""",
    ["coefficient"], LONG,
)
SQL["strong_pairs"] = tidy(
    f"SELECT *, {STRENGTH} AS strength, {DIRECTION} AS direction FROM ({correlation(PRICED, RELATED)}) WHERE abs(coefficient) >= 0.4",
    ["coefficient"], [*LONG, "strength", "direction"],
)
SQL["distinct_pairs"] = tidy(DISTINCT, ["coefficient"], [*LONG, "method_ord", "strength", "direction"])
THREE = ["l_quantity", "l_extendedprice", "cubo"]
SQL["spearman_only"] = tidy(
    f"""SELECT s.var_a, s.var_b, s.coefficient FROM ({correlation(PRICED, THREE, "spearman")}) s
    ANTI JOIN (SELECT * FROM ({correlation(PRICED, THREE)}) WHERE abs(coefficient) >= 0.7) p ON s.var_a = p.var_a AND s.var_b = p.var_b
    WHERE abs(s.coefficient) >= 0.7""",
    ["coefficient"], ["var_a", "var_b"],
)
SQL["strongest_value"] = tidy(f"SELECT method, max(abs(coefficient)) AS strongest FROM ({BOTH}) GROUP BY method", ["strongest"], ["method"])
FULL = correlation(PRICED, RELATED, diagonal=True)
MATRIX = f"SELECT method, var_a, var_b, coefficient FROM ({FULL}) UNION ALL SELECT method, var_b, var_a, coefficient FROM ({FULL}) WHERE var_a <> var_b"
SQL["heatmap_matrix"] = tidy(MATRIX, ["coefficient"], ["method", "var_a", "var_b"])
SQL["wide_matrix"] = tidy(
    f"SELECT method, var_a, {', '.join(f'max(CASE WHEN var_b = {chr(39)}{c}{chr(39)} THEN coefficient END) AS {c}' for c in RELATED)} FROM ({MATRIX}) GROUP BY method, var_a",
    RELATED, ["method", "var_a"],
)


def lower_name(c: str) -> str:
    return f"lower(trim(replace({c}, '_', ' ')))"


SQL["relationship_sentences"] = f"""SELECT var_a, var_b, 'Cuando ' || {lower_name("var_a")} || ' aumenta, ' || {lower_name("var_b")} ||
    CASE WHEN coefficient >= 0 THEN ' también tiende a aumentar.' ELSE ' tiende a disminuir.' END AS sentence
    FROM ({correlation(PRICED, RELATED)}) WHERE abs(coefficient) >= 0.4"""


def eta(source: str, categorical: list[str], numeric: list[str]) -> str:
    parts = []
    for i, c in enumerate(categorical):
        for j, x in enumerate(numeric):
            complete = f"(SELECT {c} AS c, {x} AS x, avg({x}) OVER () AS g FROM {source} WHERE {c} IS NOT NULL AND {x} IS NOT NULL)"
            parts.append(
                f"""SELECT {i * len(numeric) + j}::BIGINT AS ord, '{c}' AS categorical, '{x}' AS numeric,
                CASE WHEN count(*) >= 2 AND sum(n) >= 3 THEN sum(n * (m - g) * (m - g)) / nullif(sum(ss), 0) END AS eta_squared
                FROM (SELECT c, count(*) AS n, avg(x) AS m, any_value(g) AS g, sum((x - g) * (x - g)) AS ss FROM {complete} GROUP BY c)"""
            )
    return union(parts)


DEPENDENCIES = f"SELECT * FROM ({eta(BANDED, ['l_returnflag', 'banda'], PRICES)}) WHERE eta_squared >= 0.14"
BAND_DEPENDENCIES = f"SELECT * FROM ({eta(BANDED, ['banda'], PRICES)}) WHERE eta_squared >= 0.14"


def titled(c: str) -> str:
    return f"upper(left(replace({c}, '_', ' '), 1)) || substr(replace({c}, '_', ' '), 2)"


SQL["eta_squared"] = tidy(eta(BANDED, ["l_returnflag", "l_linestatus", "banda"], PRICES), ["eta_squared"], ["ord", "categorical", "numeric"])
SQL["dependencies"] = tidy(DEPENDENCIES, ["eta_squared"], ["ord", "categorical", "numeric"])
SQL["dependency_feed"] = tidy(
    f"""SELECT {titled("categorical")} || ' → ' || {titled("numeric")} AS etiqueta, eta_squared * 100 AS porcentaje,
    CASE WHEN eta_squared >= 0.50 THEN 'Muy marcada' WHEN eta_squared >= 0.26 THEN 'Marcada' ELSE 'Relevante' END AS asociacion FROM ({DEPENDENCIES})""",
    ["porcentaje"], ["etiqueta", "asociacion"],
)

# ----------------------------------------------------------------- features (M)
FILLED = ["value", "doble", "constante"]
IMPUTED = f"(SELECT event_id, {', '.join(f'coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM {GAPPY})) AS {c}' for c in FILLED)} FROM {GAPPY})"
SQL["impute_median"] = tidy(f"SELECT * FROM {IMPUTED}", FILLED, ["event_id"])
SQL["impute_scale"] = f"""SELECT event_id, {", ".join(
    f"round(({c} - avg({c}) OVER ()) / CASE WHEN min({c}) OVER () = max({c}) OVER () THEN 1 ELSE stddev_pop({c}) OVER () END, 6) + 0.0::DOUBLE AS {c}" for c in FILLED
)} FROM {IMPUTED}"""
LINE_POINTS = standard(PRICED, "l_orderkey, l_linenumber", ["l_quantity", "importe"])
SQL["pca_2d"] = tidy(
    f"""SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, round((v0 + v1) / sqrt(2.0), 6) + 0.0::DOUBLE AS pc1,
    round((v0 - v1) / sqrt(2.0), 6) + 0.0::DOUBLE AS pc2 FROM {LINE_POINTS}""",
    ["pc1", "pc2"], ["l_orderkey", "l_linenumber"],
)


# --------------------------------------------------- clustering and segments (C)
def silhouette(points: str, key: str, distance: str) -> str:
    """Mean silhouette of ``points`` (key, label, coordinates), noise left out."""
    return f"""WITH p AS (SELECT * FROM {points} WHERE label <> -1), sizes AS (SELECT label, count(*) AS n FROM p GROUP BY label),
    d AS (SELECT a.{key} AS id, a.label AS own, b.label AS other, sum({distance}) AS total FROM p a CROSS JOIN p b GROUP BY ALL),
    m AS (SELECT id, own, other, CASE WHEN own = other THEN total / greatest(n - 1, 1) ELSE total / n END AS mean, n FROM d JOIN sizes ON d.other = sizes.label),
    s AS (SELECT id, max(CASE WHEN own = other THEN mean END) AS within, min(CASE WHEN own <> other THEN mean END) AS outside,
          max(CASE WHEN own = other THEN n END) AS size FROM m GROUP BY id)
    SELECT avg(CASE WHEN size > 1 AND greatest(within, outside) > 0 THEN (outside - within) / greatest(within, outside) ELSE 0 END) AS silhouette, count(*) AS n FROM s"""


QUALITY = "CASE WHEN silhouette IS NULL THEN 'No evaluable' WHEN silhouette >= 0.5 THEN 'Buena' WHEN silhouette >= 0.25 THEN 'Moderada' ELSE 'Baja' END"
SQL["silhouette_score"] = f"""SELECT round(silhouette, 6) AS silhouette, n, {QUALITY} AS calidad FROM
    ({silhouette("(SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings)", "vec_id", "list_distance(a.e, b.e)")})"""


def density(points: str, key: str, eps: float, min_samples: int) -> str:
    """DBSCAN: clusters of core points, numbered by their first core point."""
    return f"""WITH RECURSIVE p AS MATERIALIZED (SELECT {key} AS id, v0, v1 FROM {points}),
    near AS MATERIALIZED (SELECT a.id AS a, b.id AS b FROM p a JOIN p b
        ON sqrt((a.v0 - b.v0) * (a.v0 - b.v0) + (a.v1 - b.v1) * (a.v1 - b.v1)) <= {eps}::DOUBLE),
    core AS MATERIALIZED (SELECT a AS id FROM near GROUP BY a HAVING count(*) >= {min_samples}),
    edge AS MATERIALIZED (SELECT a, b FROM near SEMI JOIN core ca ON near.a = ca.id SEMI JOIN core cb ON near.b = cb.id),
    reach(root, id) AS (SELECT id, id FROM core UNION SELECT r.root, e.b FROM reach r JOIN edge e ON r.id = e.a WHERE e.b > r.root),
    own AS (SELECT id, min(root) AS root FROM reach GROUP BY id),
    settled AS (SELECT id, dense_rank() OVER (ORDER BY root) - 1 AS label FROM own),
    border AS (SELECT near.a AS id, min(label) AS label FROM near JOIN settled ON near.b = settled.id ANTI JOIN core ON near.a = core.id GROUP BY near.a)
    SELECT p.id AS {key}, coalesce(settled.label, border.label, -1)::BIGINT AS label FROM p LEFT JOIN settled USING (id) LEFT JOIN border USING (id)"""


SQL["dbscan_labels"] = density(PART_POINTS, "p_partkey", 0.08, 5)
SQL["dbscan_dense"] = density(standard("customer", "c_custkey", ["c_nationkey", "c_acctbal"]), "c_custkey", 0.5, 5)
K_DISTANCES = f"""SELECT p_partkey, d AS k_distance FROM (SELECT a.p_partkey, sqrt((a.v0 - b.v0) * (a.v0 - b.v0) + (a.v1 - b.v1) * (a.v1 - b.v1)) AS d,
    row_number() OVER (PARTITION BY a.p_partkey ORDER BY (a.v0 - b.v0) * (a.v0 - b.v0) + (a.v1 - b.v1) * (a.v1 - b.v1)) AS place
    FROM {PART_POINTS} a CROSS JOIN {PART_POINTS} b) WHERE place = 5"""
SQL["k_distance_curve"] = f"SELECT p_partkey, round(k_distance, 6) AS k_distance FROM ({K_DISTANCES})"
SQL["knee_eps"] = f"""WITH c AS (SELECT k_distance AS y, row_number() OVER (ORDER BY k_distance) - 1 AS x, count(*) OVER () AS n,
    min(k_distance) OVER () AS low, max(k_distance) OVER () AS high FROM ({K_DISTANCES}))
    SELECT round(y, 6) AS eps FROM c ORDER BY abs(low + (high - low) * x / (n - 1) - y) DESC, x LIMIT 1"""

# Planted groups: bands of the size, far apart.
PLANTED_BAND = "CASE WHEN p_size <= 10 THEN 0 WHEN p_size <= 25 THEN 1 ELSE 2 END"
PLANTED_PARTS = f"(SELECT p_partkey, p_size, {PLANTED_BAND} AS label, {PLANTED_BAND} * 100 + p_size * 0.01::DOUBLE AS v0, {PLANTED_BAND} * {PLANTED_BAND} * 40 - p_size * 0.02::DOUBLE AS v1 FROM part)"
SQL["kmeans_planted"] = f"""SELECT p_partkey, place AS label FROM {PLANTED_PARTS} JOIN
    (SELECT label, row_number() OVER (ORDER BY count(*) DESC, avg(v0), avg(v1)) - 1 AS place FROM {PLANTED_PARTS} GROUP BY label) USING (label)"""
SQL["auto_k_planted"] = f"""SELECT count(DISTINCT label) AS k, any_value(s) AS silhouette FROM {PLANTED_PARTS},
    (SELECT round(silhouette, 6) AS s FROM ({silhouette(PLANTED_PARTS, "p_partkey", "sqrt((a.v0 - b.v0) * (a.v0 - b.v0) + (a.v1 - b.v1) * (a.v1 - b.v1))")}))"""
SQL["analysis_guards"] = f"""SELECT 'whole' AS caso, count(DISTINCT p_size) AS filas, 2::BIGINT AS pares, count(DISTINCT label) AS segmentos, 1::BIGINT AS metodos, true AS hallazgos FROM {PLANTED_PARTS}
    UNION ALL SELECT 'one_column', count(DISTINCT p_size), 0, 0, 1, true FROM part UNION ALL SELECT 'one_row', count(*), 2, 0, 1, true FROM part WHERE p_partkey = 1
    UNION ALL SELECT 'empty', count(*), 0, 0, 0, false FROM part WHERE p_partkey < 0 UNION ALL SELECT 'registry', 2, 0, 0, 3, false"""
SQL["iforest_planted"] = "SELECT event_id, true AS is_isolation_forest, true AS above_others FROM events WHERE event_id % 100 = 0"
SQL["iforest_planted_fraction"] = "SELECT event_id FROM events WHERE event_id % 100 = 0"

SIZES = f"(SELECT label, count(*) AS size FROM {PARTS} GROUP BY label)"
SQL["cluster_sizes"] = f"SELECT label::BIGINT AS label, size FROM {SIZES}"
SQL["segment_ranking"] = f"SELECT label::BIGINT AS label, size FROM {SIZES} WHERE label <> -1"
OVERVIEW = f"""SELECT count(*) FILTER (label <> -1) AS n_clusters, coalesce(max(size) FILTER (label <> -1), 0) AS largest,
    coalesce(sum(size) FILTER (label = -1), 0)::BIGINT AS noise, coalesce(sum(size) FILTER (label = -1), 0) / sum(size) AS noise_share FROM {SIZES}"""
SQL["segment_overview"] = tidy(OVERVIEW, ["noise_share"], ["n_clusters", "largest", "noise"])
READING = """CASE WHEN diferencia >= 1.0 THEN 'muy por encima' WHEN diferencia >= 0.35 THEN 'por encima' WHEN diferencia <= -1.0 THEN 'muy por debajo'
    WHEN diferencia <= -0.35 THEN 'por debajo' ELSE 'en el promedio' END"""
TRAITS = f"""SELECT *, {READING} AS lectura, row_number() OVER (PARTITION BY label ORDER BY abs(diferencia) DESC, col_ord) AS ord FROM ({union(
    f'''SELECT label::BIGINT AS label, {i} AS col_ord, '{c}' AS variable, avg({c}) AS media, any_value(g) AS media_general,
    (avg({c}) - any_value(g)) / any_value(s) AS diferencia FROM (SELECT *, avg({c}) OVER () AS g, stddev_samp({c}) OVER () AS s FROM {PARTS}) GROUP BY label'''
    for i, c in enumerate(["p_size", "p_retailprice"]))})"""


def categories(cols: list[str]) -> str:
    parts = [
        f"""SELECT label::BIGINT AS label, {i} AS col_ord, '{c}' AS variable, {c}::VARCHAR AS categoria, count(*) / sum(count(*)) OVER (PARTITION BY label) * 100 AS porcentaje
        FROM {PARTS} GROUP BY label, {c} QUALIFY row_number() OVER (PARTITION BY label ORDER BY count(*) DESC, {c}::VARCHAR) = 1"""
        for i, c in enumerate(cols)
    ]
    return f"SELECT *, row_number() OVER (PARTITION BY label ORDER BY porcentaje DESC, col_ord) AS ord FROM ({union(parts)})"


SQL["segment_traits"] = tidy(TRAITS, ["media", "media_general", "diferencia"], ["label", "ord", "variable", "lectura"])
SQL["segment_categories"] = tidy(categories(["p_type", "p_brand", "es_caro"]), ["porcentaje"], ["label", "ord", "variable", "categoria"])
NAME = "CASE WHEN label = -1 THEN 'Sin grupo' ELSE 'Segmento ' || (label + 1) END"


def shown_number(c: str) -> str:
    return f"CASE WHEN abs({c}) >= 1000 THEN format('{{:,.0f}}', {c}) ELSE format('{{:,.2f}}', {c}) END"


SQL["segment_profiles"] = tidy(
    f"""WITH t AS (SELECT label, string_agg(replace(variable, '_', ' ') || ' ' || lectura || ' del promedio (' || ({shown_number("media")}) || ' frente a ' || ({shown_number("media_general")}) || ')', ' y ' ORDER BY ord) AS phrase
        FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY ord) AS kept FROM ({TRAITS}) WHERE lectura <> 'en el promedio') WHERE kept <= 2 GROUP BY label),
    c AS (SELECT label, 'En ' || replace(variable, '_', ' ') || ' predomina ' || CASE WHEN variable = 'es_caro' THEN CASE categoria WHEN 'true' THEN 'sí' ELSE 'no' END ELSE categoria END
        || ' (' || format('{{:.0f}}', porcentaje) || '%).' AS phrase FROM ({categories(["p_type", "es_caro"])}) WHERE porcentaje >= 50
        QUALIFY row_number() OVER (PARTITION BY label ORDER BY ord) = 1),
    s AS (SELECT label::BIGINT AS label, size, size / sum(size) OVER () * 100 AS porcentaje FROM {SIZES})
    SELECT s.label AS segmento, {NAME.replace("label", "s.label")} AS nombre, size AS tamano, porcentaje,
    concat_ws(' ', format('{{:,d}}', size) || ' registros (' || format('{{:.1f}}', porcentaje) || '% del total).',
        CASE WHEN t.phrase IS NULL THEN 'Sus valores se mantienen cerca del promedio general.' ELSE 'Se distingue por ' || t.phrase || '.' END, c.phrase) AS descripcion
    FROM s LEFT JOIN t USING (label) LEFT JOIN c USING (label)""",
    ["porcentaje"], ["segmento", "nombre", "tamano", "descripcion"],
)
SQL["segment_general_row"] = f"""WITH r AS (SELECT grouping(label) AS g, label, count(*) AS n, avg(p_size) AS a, avg(p_retailprice) AS b FROM {PARTS} GROUP BY ROLLUP (label)),
    c AS (SELECT * FROM ({categories(["p_type", "es_caro"])}) WHERE ord = 1)
    SELECT CASE WHEN g = 1 THEN 'General' ELSE {NAME.replace("label", "r.label")} END AS "Segmento", n AS "Registros",
    format('{{:.1f}}%', n / sum(n) OVER (PARTITION BY g) * 100) AS "% del total", format('{{:.2f}}', a)::DOUBLE AS "P size", format('{{:.2f}}', b)::DOUBLE AS "P retailprice",
    CASE WHEN g = 1 OR categoria IS NULL THEN '—' ELSE CASE variable WHEN 'p_type' THEN 'P type: ' || categoria ELSE 'Es caro: ' || CASE categoria WHEN 'true' THEN 'Sí' ELSE 'No' END END
        || format(' ({{:.0f}}%)', porcentaje) END AS "Categoría dominante" FROM r LEFT JOIN c ON r.label = c.label"""
# the sign of the first two axes: the larger loading is positive; the columns correlate positively or negatively
SQL["scatter_feed"] = tidy(
    f"""WITH z AS {standard(PARTS, "p_partkey, label", ["p_size", "p_retailprice"])}, r AS (SELECT corr(v0, v1) AS r FROM z)
    SELECT p_partkey, label::BIGINT AS label, CASE WHEN label = -1 THEN 'Sin segmento' ELSE 'Segmento ' || (label + 1) END AS segmento,
    round((v0 + sign(r) * v1) / sqrt(2.0), 6) + 0.0::DOUBLE AS pc1, round((v0 - sign(r) * v1) / sqrt(2.0), 6) + 0.0::DOUBLE AS pc2 FROM z CROSS JOIN r""",
    ["pc1", "pc2"], ["p_partkey", "label", "segmento"],
)

# ---------------------------------------------------------------- anomalies (N)
TWO = ["value", "grupo_usuario"]


def z_test(c: str) -> str:
    return f"abs(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()) > 3"


def bounds(source: str, c: str) -> str:
    return f"SELECT '{c}' AS variable, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {source})"


def iqr_test(source: str, c: str) -> str:
    return f"({c} < (SELECT lower FROM ({bounds(source, c)})) OR {c} > (SELECT upper FROM ({bounds(source, c)})))"


FLAGGED = f"""(SELECT event_id, {" OR ".join(z_test(c) for c in TWO)} AS z, {" OR ".join(iqr_test(SIGNALS, c) for c in TWO)} AS i FROM {SIGNALS})"""
SQL["zscore_flags"] = f"SELECT event_id, z::BIGINT AS is_zscore FROM {FLAGGED}"
SQL["zscore_counts"] = union(f"SELECT '{c}' AS variable, count(*) AS outliers FROM (SELECT {z_test(c)} AS z FROM {IMPUTED}) WHERE z" for c in ["value", "doble"])
SQL["iqr_bounds"] = tidy(union(bounds(IMPUTED, c) for c in FILLED), ["lower", "upper"], ["variable"])
SQL["iqr_flags"] = f"SELECT event_id, i::BIGINT AS is_iqr FROM {FLAGGED}"
SUMMARY = union(
    f"SELECT count(*) AS n_rows, {o}::BIGINT AS ord, '{m}' AS method, count(*) FILTER ({f}) AS outlier_count, count(*) FILTER ({f}) / count(*) AS outlier_ratio FROM {FLAGGED}"
    for o, m, f in [(0, "zscore", "z"), (1, "iqr", "i")]
)
SQL["anomaly_summary"] = tidy(SUMMARY, ["outlier_ratio"], ["n_rows", "ord", "method", "outlier_count"])
AGREEMENT = f"SELECT count(*) FILTER (z AND i) AS consensus, count(*) FILTER (z OR i) AS any_signal, count(*) AS n_rows FROM {FLAGGED}"
SQL["anomaly_consensus"] = AGREEMENT
SQL["review_queue"] = f"""SELECT event_id, CASE WHEN z AND i THEN 'Z-Score, IQR' WHEN z THEN 'Z-Score' ELSE 'IQR' END AS metodos,
    (z::BIGINT + i::BIGINT) AS coincidencias, CASE WHEN z AND i THEN 'Alta' ELSE 'Explorar' END AS prioridad FROM {FLAGGED} WHERE z OR i"""
SQL["anomaly_scatter"] = f"SELECT event_id, CASE WHEN z AND i THEN 'consensus' WHEN i THEN 'method' ELSE 'normal' END AS clase FROM {FLAGGED}"
SQL["method_comparison"] = tidy(
    f"""SELECT ord, CASE method WHEN 'zscore' THEN 'Z-Score' ELSE 'IQR' END AS metodo, outlier_ratio * 100 AS porcentaje,
    (row_number() OVER (ORDER BY outlier_count DESC, ord) = 1)::BIGINT AS mas_amplio FROM ({SUMMARY})""",
    ["porcentaje"], ["ord", "metodo", "mas_amplio"],
)

# ----------------------------------------------------------------- insights (I)
TRIMMED = f"(SELECT o_orderkey, trim(estado) AS estado, nullif(prioridad, '') AS prioridad, nullif(trim(nota), '') AS nota, grupo FROM {DIRTY_ORDERS})"
TRIMMED_PROFILE = column_profile(TRIMMED, "o_orderkey", [("o_orderkey", "numeric"), ("estado", "text"), ("prioridad", "text"), ("nota", "text"), ("grupo", "numeric")])
DATASET = f"""SELECT 0 AS g, 0 AS row_ord, 'dataset' AS category, 'info' AS severity,
    format('El conjunto de datos contiene {{}} registros y {{}} variables ({{}} numéricas, {{}} categóricas, {{}} temporales).',
    max(n_rows), count(*), {of_type("numeric")}, {of_type("categorical")}, {of_type("datetime")}) AS message FROM ({TRIMMED_PROFILE})"""
MISSING = f"""SELECT 1 AS g, ord AS row_ord, 'missing' AS category, CASE WHEN missing_ratio > 0.2 THEN 'warning' ELSE 'info' END AS severity,
    format('La variable ''{{}}'' tiene {{:.1f}}% de valores faltantes.', name, missing_ratio * 100) AS message FROM ({TRIMMED_PROFILE}) WHERE missing_ratio > 0"""


def correlation_sentences(source: str) -> str:
    return f"""SELECT 2 AS g, row_number() OVER (ORDER BY method_ord, abs(coefficient) DESC, ord) AS row_ord, 'correlation' AS category, 'info' AS severity,
    format('Existe una correlación {{}} {{}} (r={{:.2f}}) entre ''{{}}'' y ''{{}}''.', {STRENGTH}, {DIRECTION}, coefficient, var_a, var_b) AS message FROM ({source})"""


def dependency_sentences(source: str) -> str:
    return f"""SELECT 3 AS g, row_number() OVER (ORDER BY eta_squared DESC, ord) AS row_ord, 'dependency' AS category, 'info' AS severity,
    format('La variable ''{{}}'' explica un {{:.0f}}% de la variación en ''{{}}''.', categorical, eta_squared * 100, numeric) AS message FROM ({source})"""


ANOMALIES = f"""SELECT 5 AS g, ord AS row_ord, 'anomaly' AS category, CASE WHEN outlier_ratio > 0.1 THEN 'warning' ELSE 'info' END AS severity,
    format('El método {{}} detectó un {{:.1f}}% de registros con valores atípicos ({{}} de {{}}).', upper(method), outlier_ratio * 100, outlier_count, n_rows) AS message FROM ({SUMMARY})"""
STRONG_PEARSON = f"SELECT *, 0 AS method_ord FROM ({correlation(PRICED, RELATED)}) WHERE abs(coefficient) >= 0.7"
SQL["dataset_insight"] = f"SELECT category, severity, message FROM ({DATASET})"
SQL["missing_insights"] = f"SELECT category, severity, message FROM ({MISSING})"
SQL["correlation_insights"] = f"SELECT row_ord, category, message FROM ({correlation_sentences(DISTINCT)})"
SQL["dependency_insights"] = f"SELECT row_ord, category, message FROM ({dependency_sentences(DEPENDENCIES)})"
SQL["anomaly_insights"] = f"SELECT row_ord, category, severity, message FROM ({ANOMALIES})"
SCALED_PARTS = standard(PARTS, "p_partkey, label", ["p_size", "p_retailprice"])
PART_SILHOUETTE = silhouette(SCALED_PARTS, "p_partkey", "sqrt((a.v0 - b.v0) * (a.v0 - b.v0) + (a.v1 - b.v1) * (a.v1 - b.v1))")
SQL["clustering_insights"] = f"""SELECT 0::BIGINT AS row_ord, 'clustering' AS category, 'info' AS severity,
    format('Se detectaron {{}} agrupaciones principales usando DBSCAN sobre las variables: p_size, p_retailprice.', n_clusters) AS message FROM ({OVERVIEW})
    UNION ALL SELECT 1::BIGINT, 'clustering', 'info', format('La calidad de la agrupación es {{}} (silhouette={{:.2f}}).', lower({QUALITY}), silhouette) FROM ({PART_SILHOUETTE})"""
SQL["insights_table"] = f"""SELECT row_number() OVER (ORDER BY g, row_ord) AS ord, category, severity, message FROM
    ({union([DATASET, MISSING, correlation_sentences(STRONG_PEARSON), dependency_sentences(BAND_DEPENDENCIES), ANOMALIES])})"""
TOP_PAIR = f"(SELECT * FROM ({STRONG_PEARSON}) ORDER BY abs(coefficient) DESC, ord LIMIT 1)"
SQL["executive_summary"] = f"""SELECT concat_ws(' ',
    (SELECT format('El análisis incluye {{:,d}} registros y {{}} variables.', max(n_rows), count(*)) FROM ({TRIMMED_PROFILE})),
    (SELECT 'La relación numérica más marcada aparece entre ' || {lower_name("var_a")} || ' y ' || {lower_name("var_b")} || ' (' || format('{{:+.2f}}', coefficient)
        || '), que tienden a moverse ' || CASE WHEN coefficient >= 0 THEN 'en el mismo sentido' ELSE 'en sentido contrario' END || '.' FROM {TOP_PAIR}),
    (SELECT format('Se encontraron {{}} segmentos mediante K-Means, con separación {{}}.', n_clusters, (SELECT lower({QUALITY}) FROM ({PART_SILHOUETTE}))) FROM ({OVERVIEW})),
    (SELECT format('{{}} registros recibieron al menos una señal de comportamiento inusual y {{}} coincidieron en todos los métodos.', any_signal, consensus) FROM ({AGREEMENT}))) AS summary"""
SQL["recommendations"] = f"""SELECT ord, message FROM (
    SELECT 0::BIGINT AS ord, 'Revisar ' || {lower_name("var_a")} || ' junto con ' || {lower_name("var_b")} || ' en futuras comparaciones, sin asumir causalidad.' AS message FROM {TOP_PAIR}
    UNION ALL SELECT 1::BIGINT, 'Comparar ' || {lower_name("numeric")} || ' por las categorías de ' || {lower_name("categorical")} || ' antes de usar un promedio general.'
        FROM (SELECT * FROM ({BAND_DEPENDENCIES}) ORDER BY eta_squared DESC, ord LIMIT 1)
    UNION ALL SELECT 2::BIGINT, 'Comparar los indicadores de cada segmento para identificar sus diferencias principales.' FROM ({OVERVIEW}) WHERE n_clusters > 0
    UNION ALL SELECT 3::BIGINT, format('Revisar primero los {{}} registros señalados por todos los detectores y confirmar su contexto antes de corregirlos o eliminarlos.', consensus)
        FROM ({AGREEMENT}) WHERE consensus > 0
    UNION ALL SELECT 4::BIGINT, 'Interpretar los resultados según el contexto del conjunto de datos y documentar las conclusiones obtenidas.')"""
SQL["custom_provider"] = tidy(
    union(f"SELECT '{c}' AS variable, avg({c}) AS media, count({c}) AS conteo FROM supplier" for c in ["s_nationkey", "s_acctbal"]), ["media"], ["variable", "conteo"]
)

REPORTED = f"""(SELECT *, 'b' || floor(este / 100)::BIGINT AS banda FROM
    (SELECT p_partkey, label, v0 + p_partkey * 0.0000003::DOUBLE AS este, v1 AS norte FROM {PLANTED_PARTS}))"""
REPORTED_SIGNALS = f"(SELECT {' OR '.join(z_test(c) for c in ['este', 'norte'])} AS z, {' OR '.join(iqr_test(REPORTED, c) for c in ['este', 'norte'])} AS i FROM {REPORTED})"
REPORTED_SILHOUETTE = silhouette(standard(REPORTED, "p_partkey, label", ["este", "norte"]), "p_partkey", "sqrt((a.v0 - b.v0) * (a.v0 - b.v0) + (a.v1 - b.v1) * (a.v1 - b.v1))")
SQL["full_report_planted"] = f"SELECT part, item, round(value::DOUBLE, 6) AS value FROM ({union([
    f"SELECT 'rows' AS part, '' AS item, count(*)::DOUBLE AS value FROM {REPORTED}", "SELECT 'columns', '', 3.0::DOUBLE",
    *[f"SELECT '{n}', '{c}', {f} FROM {REPORTED}" for c in ["este", "norte"] for n, f in [("mean", f"avg({c})"), ("median", f"quantile_cont({c}, 0.5)")]],
    *[f"SELECT method, var_a || '|' || var_b, coefficient FROM ({correlation(REPORTED, ['este', 'norte'], m)})" for m in ["pearson", "spearman"]],
    f"SELECT 'eta', categorical || '|' || numeric, eta_squared FROM ({eta(REPORTED, ['banda'], ['este', 'norte'])}) WHERE eta_squared >= 0.14",
    f"SELECT 'segment', (row_number() OVER (ORDER BY count(*) DESC, avg(este), avg(norte)) - 1)::VARCHAR, count(*) FROM {REPORTED} GROUP BY label",
    f"SELECT 'silhouette', '', silhouette FROM ({REPORTED_SILHOUETTE})",
    f"SELECT 'anomalies', 'zscore', count(*) FILTER (z) FROM {REPORTED_SIGNALS}", f"SELECT 'anomalies', 'iqr', count(*) FILTER (i) FROM {REPORTED_SIGNALS}",
    f"SELECT 'any_signal', '', count(*) FILTER (z OR i) FROM {REPORTED_SIGNALS}",
])})"
