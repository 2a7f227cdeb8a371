"""What sets each segment apart: traits, categories and a written description.

Every function takes rows that carry a ``label`` column (-1 for noise).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions import text
from ..functions.values import as_double, col
from .describe import category_counts, dominant_category, yes_no


# ---------------------------------------------------------------- fixed values
SEGMENT = "Segmento {number}"
NO_GROUP = "Sin grupo"  # in profiles
NO_SEGMENT = "Sin segmento"  # in charts
GENERAL = "General"
NOTHING = "—"
SIZE = "{rows} registros ({percent}% del total)."
DISTINCT = "Se distingue por {traits}."
TRAIT = "{variable} {reading} del promedio ({mean} frente a {overall})"
AND = " y "
ORDINARY = "Sus valores se mantienen cerca del promedio general."
DOMINANT = "En {variable} predomina {category} ({percent}%)."
# -----------------------------------------------------------------------------


def segment_name(label: Column) -> Column:
    return F.when(label == -1, NO_GROUP).otherwise(text.filled(SEGMENT, number=label + 1))


def segment_means(rows: DataFrame, cols: list[str]) -> DataFrame:
    """``(label, variable, media, media_general, desviacion)`` in one pass.

    The overall mean and sample deviation come as the grand total of the same
    aggregate, so the table is read once.
    """
    numbers = rows.select("label", *[as_double(rows, c).alias(c) for c in cols])
    cells = [F.struct(F.lit(i).alias("col_ord"), F.lit(c).alias("variable"), F.avg(col(c)).alias("media"), F.stddev_samp(col(c)).alias("s")).alias(f"_{i}") for i, c in enumerate(cols)]
    table = numbers.rollup("label").agg(F.grouping_id().alias("g"), *cells)
    table = table.select("label", "g", F.inline(F.array(*[F.col(f"_{i}") for i in range(len(cols))])))
    total = table.filter(F.col("g") == 1).select("variable", F.col("media").alias("media_general"), F.col("s").alias("desviacion"))
    # the grand total has one row per column
    return table.filter(F.col("g") == 0).drop("g", "s").join(F.broadcast(total), "variable")


def segment_traits(rows: DataFrame, cols: list[str]) -> DataFrame:
    """``(label, ord, variable, media, media_general, diferencia, lectura)``.

    The difference is in overall sample deviations; ``ord`` counts from the
    most marked trait.
    """
    spread = F.col("desviacion")
    difference = F.when(spread.isNull() | (spread == 0), 0.0).otherwise((F.col("media") - F.col("media_general")) / F.nullif(spread, F.lit(0.0)))
    traits = segment_means(rows, cols).filter(F.col("media").isNotNull() & F.col("media_general").isNotNull()).withColumn("diferencia", difference)
    # one row per segment and column
    marked = Window.partitionBy("label").orderBy(F.abs("diferencia").desc(), "col_ord")
    return traits.select(
        "label", F.row_number().over(marked).alias("ord"), "variable", "media", "media_general", "diferencia", text.trait_reading(F.col("diferencia")).alias("lectura")
    )


def segment_categories(rows: DataFrame, cols: list[str]) -> DataFrame:
    """``(label, ord, variable, categoria, porcentaje)``: the top value per column."""
    if not cols:
        return rows.sparkSession.createDataFrame([], "label int, ord int, variable string, categoria string, porcentaje double")
    place = F.element_at(F.map_from_arrays(F.array(*[F.lit(c) for c in cols]), F.array(*[F.lit(i) for i in range(len(cols))])), F.col("variable"))
    top = dominant_category(category_counts(rows, cols, ["label"]), ["label", "variable"])
    purest = Window.partitionBy("label").orderBy(F.col("porcentaje").desc(), place)
    return top.select(
        "label", F.row_number().over(purest).alias("ord"), "variable", F.col("categoria_mas_frecuente").alias("categoria"), "porcentaje"
    )


def _description(size: Column, share: Column, boolean_cols: list[str]) -> Column:
    head = text.filled(SIZE, rows=F.format_number(size, 0), percent=text.fixed(share, 1))
    distinct = F.slice(F.filter("rasgos", lambda r: r["lectura"] != "en el promedio"), 1, 2)
    phrases = F.transform(
        distinct,
        lambda r: text.filled(
            TRAIT, variable=text.spaced(r["variable"]), reading=r["lectura"], mean=text.readable_number(r["media"]), overall=text.readable_number(r["media_general"])
        ),
    )
    traits = F.when(F.size(distinct) > 0, text.filled(DISTINCT, traits=F.array_join(phrases, AND))).otherwise(ORDINARY)
    main = F.get(F.filter("categorias", lambda c: c["porcentaje"] >= text.DOMINANT_CATEGORY), F.lit(0))
    is_boolean = main["variable"].isin(boolean_cols) if boolean_cols else F.lit(False)
    category = F.when(
        main.isNotNull(),
        text.filled(
            DOMINANT, variable=text.spaced(main["variable"]), category=yes_no(main["categoria"], is_boolean, upper=False), percent=text.fixed(main["porcentaje"], 0)
        ),
    )
    return F.concat_ws(" ", head, traits, category)


def segment_profiles(rows: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """One row per segment, noise last: size, share, name, traits, categories, description.

    Without any segment (all noise or no rows) the table is empty.
    """
    booleans = [c for c in categorical if isinstance(rows.schema[c].dataType, T.BooleanType)]
    sizes = rows.groupBy("label").agg(F.count(F.lit(1)).alias("tamano"))
    # scalar subqueries: one number each, computed once
    total = rows.agg(F.count(F.lit(1))).scalar()
    highest = rows.agg(F.max("label")).scalar()
    sizes = sizes.filter(highest != -1).select("label", "tamano", (F.col("tamano") / total * 100).alias("porcentaje"))
    ordered = lambda df, names: F.array_sort(F.collect_list(F.struct("ord", *names)))
    traits = segment_traits(rows, numeric)
    traits = traits.groupBy("label").agg(ordered(traits, ["variable", "media", "media_general", "diferencia", "lectura"]).alias("rasgos"))
    categories = segment_categories(rows, categorical)
    categories = categories.groupBy("label").agg(ordered(categories, ["variable", "categoria", "porcentaje"]).alias("categorias"))
    table = sizes.join(traits, "label", "left").join(categories, "label", "left").select(
        F.col("label").alias("segmento"),
        segment_name(F.col("label")).alias("nombre"),
        "tamano",
        "porcentaje",
        F.coalesce("rasgos", F.array().cast(traits.schema["rasgos"].dataType)).alias("rasgos"),
        F.coalesce("categorias", F.array().cast(categories.schema["categorias"].dataType)).alias("categorias"),
    )
    described = table.withColumn("descripcion", _description(F.col("tamano"), F.col("porcentaje"), booleans))
    return described.orderBy((F.col("segmento") == -1).cast("int"), "segmento")


def segment_table(rows: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """Means per segment with a closing "General" row and the dominant category."""
    booleans = [c for c in categorical if isinstance(rows.schema[c].dataType, T.BooleanType)]
    numbers = rows.select("label", *[as_double(rows, c).alias(c) for c in numeric])
    wide = numbers.rollup("label").agg(
        F.grouping_id().alias("g"), F.count(F.lit(1)).alias("n"), *[text.exact_round(F.avg(col(c)), 2).alias(f"_m{i}") for i, c in enumerate(numeric)]
    )
    first = segment_categories(rows, categorical).filter(F.col("ord") == 1).drop("ord")
    total = rows.agg(F.count(F.lit(1))).scalar()
    joined = wide.withColumn("share", F.col("n") / total * 100).join(first, "label", "left")
    is_boolean = F.col("variable").isin(booleans) if booleans else F.lit(False)
    dominant = F.concat(
        text.capitalised(F.col("variable")), F.lit(": "), yes_no(F.col("categoria"), is_boolean), F.lit(" ("), text.fixed(F.col("porcentaje"), 0), F.lit("%)")
    )
    general = F.col("g") == 1
    headings = [(c.replace("_", " ").strip()).capitalize() for c in numeric]
    return joined.orderBy("g", (F.col("label") == -1).cast("int"), "label").select(
        F.when(general, GENERAL).otherwise(segment_name(F.col("label"))).alias("Segmento"),
        F.col("n").alias("Registros"),
        F.concat(text.fixed(F.col("share"), 1), F.lit("%")).alias("% del total"),
        *[F.col(f"_m{i}").alias(h) for i, h in enumerate(headings)],
        F.when(general | F.col("categoria").isNull(), NOTHING).otherwise(dominant).alias("Categoría dominante"),
    )


def scatter_feed(rows: DataFrame, key: str) -> DataFrame:
    """Points of the 2-D view with the name of their segment."""
    name = F.when(F.col("label") == -1, NO_SEGMENT).otherwise(segment_name(F.col("label")))
    return rows.select(col(key), "pc1", "pc2", "label", name.alias("segmento"))
