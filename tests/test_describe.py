import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablescope.functions import text
from tablescope.operators import describe

from conftest import frame


def stats(df, cols):
    return {r["variable"]: r.asDict() for r in describe.describe(df, cols).collect()}


def test_hand_computed_moments(spark):
    s = stats(frame(spark, "valor bigint", [1, 2, 3, 4, 5]), ["valor"])["valor"]
    assert (s["media"], s["mediana"], s["varianza"]) == (3, 3, 2.5)
    assert s["desviacion_estandar"] == pytest.approx(math.sqrt(2.5))


def test_quartiles_mode_and_order(spark):
    df = frame(spark, "valor bigint", [2, 4, 4, 4, 5, 6, 7, 8, 9])
    s = stats(df, ["valor"])["valor"]
    assert [s[k] for k in ("minimo", "maximo", "rango", "moda", "q1", "q3", "iqr")] == [2, 9, 7, 4, 4, 7, 3]
    assert describe.describe(df, ["valor"]).columns == ["variable", *describe.STATISTICS]


def test_skewness_and_kurtosis_match_pandas(spark):
    values = [1.0, 2.0, 2.5, 9.0, 4.0, 4.5, 30.0]
    s = stats(frame(spark, "v double", values), ["v"])["v"]
    series = pd.Series(values)
    assert s["asimetria"] == pytest.approx(series.skew(), rel=1e-12)
    assert s["curtosis"] == pytest.approx(series.kurt(), rel=1e-12)


def test_constant_single_and_empty_columns(spark):
    rows = [(7.0, None), (7.0, None), (7.0, None), (7.0, None)]
    s = stats(spark.createDataFrame(rows, "c double, e double"), ["c", "e", "absent"])
    assert [s["c"][k] for k in ("desviacion_estandar", "varianza", "rango", "iqr", "asimetria", "curtosis")] == [0] * 6
    assert s["e"]["conteo"] == 0 and s["e"]["faltantes"] == 4
    assert all(s["e"][k] is None for k in describe.STATISTICS if k not in ("conteo", "faltantes"))
    one = stats(frame(spark, "v double", [42.0]), ["v"])["v"]
    assert one["conteo"] == 1 and one["desviacion_estandar"] is None and one["asimetria"] is None
    assert set(s) == {"c", "e"}
    nothing = describe.describe(frame(spark, "t string", ["a"]), [])
    assert nothing.columns == ["variable", *describe.STATISTICS] and nothing.count() == 0


def test_text_is_coerced(spark):
    s = stats(frame(spark, "t string", ["1", " 2.5 ", "x", "3d", "1e2"]), ["t"])["t"]
    assert s["conteo"] == 3 and s["faltantes"] == 2 and s["maximo"] == 100


def test_categorical_summary(spark, mixed):
    got = describe.categorical_summary(mixed, ["region"]).collect()[0]
    assert (got["categorias_unicas"], got["categoria_mas_frecuente"], got["frecuencia"], got["porcentaje"]) == (3, "Norte", 3, 50.0)
    empty = spark.createDataFrame([(None,)] * 3, "c string")
    got = describe.categorical_summary(empty, ["c"]).collect()[0]
    assert (got["categorias_unicas"], got["categoria_mas_frecuente"], got["frecuencia"], got["porcentaje"]) == (0, None, 0, 0.0)


def test_number_formats_round_like_printf(spark):
    values = [0.15, 0.25, 0.35, 2.5, 1234.5, -0.04, 12.35, 99.95, 1e15 + 0.5, 1000000.125, -1234.565]
    df = frame(spark, "x double", values)
    x = F.col("x")
    got = df.select(text.fixed(x, 1).alias("a"), text.fixed(x, 0, grouped=True).alias("b"), text.fixed(x, 2, signed=True).alias("c")).collect()
    for v, r in zip(values, got):
        assert r["a"] == f"{v:.1f}" and r["b"] == f"{v:,.0f}" and r["c"] == f"{v:+.2f}"
    rounded = [r[0] for r in df.select(text.exact_round(x, 2)).collect()]
    assert rounded == [round(v, 2) for v in values]
