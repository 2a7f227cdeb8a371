"""Text expressions: number formatting, labels and names."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column, functions as F

# ---------------------------------------------------------------- fixed values
# Labels, thresholds and names that results must carry literally.
NO_TIME = "Fecha no disponible"
TYPE_LABELS = {
    "numeric": "Numérica",
    "categorical": "Categoría",
    "datetime": "Fecha",
    "boolean": "Sí / No",
    "text": "Texto",
    "unknown": "No identificado",
}
COMPOSITION_LABELS = {
    "numeric": "Numéricas",
    "categorical": "Categorías",
    "datetime": "Fechas",
    "boolean": "Sí / No",
    "text": "Texto",
}
METHOD_NAMES = {"zscore": "Z-Score", "iqr": "IQR", "isolation_forest": "Isolation Forest"}
STRENGTH_LEVELS = ((0.7, "fuerte"), (0.4, "moderada"))
ASSOCIATION_LEVELS = ((0.50, "Muy marcada"), (0.26, "Marcada"))
QUALITY_LEVELS = ((0.5, "Buena"), (0.25, "Moderada"))
STRONG_TRAIT = 1.0
MILD_TRAIT = 0.35
DOMINANT_CATEGORY = 50.0
# -----------------------------------------------------------------------------

_SPLITTER = 134217729.0  # 2**27 + 1, splits a double into two exact halves


def _halves(x: Column) -> tuple[Column, Column]:
    scaled = x * F.lit(_SPLITTER)
    high = scaled - (scaled - x)
    return high, x - high


def exact_round(x: Column, digits: int) -> Column:
    """Correctly rounded double (half to even on the exact binary value).

    The built-in ``round`` works on the shortest decimal text of the double,
    so 0.15 would become 0.2; here the error of ``x * 10**digits`` is computed
    exactly and decides such cases.
    """
    power = float(10**digits)
    size = F.abs(x)
    product = size * F.lit(power)
    high, low = _halves(size)
    p_high = float((power * _SPLITTER) - ((power * _SPLITTER) - power))
    p_low = power - p_high
    error = ((high * F.lit(p_high) - product) + high * F.lit(p_low) + low * F.lit(p_high)) + low * F.lit(p_low)
    whole = F.floor(product).cast("double")
    part = product - whole
    odd = (whole % 2) == 1
    up = (part > 0.5) | ((part == 0.5) & ((error > 0) | ((error == 0) & odd)))
    rounded = (whole + F.when(up, 1.0).otherwise(0.0)) / F.lit(power)
    # beyond 2**52 the scaled value has no fraction left to round
    rounded = F.when(product < float(2**52), rounded).otherwise(size)
    return F.when(x < 0, -rounded).otherwise(rounded)


def fixed(x: Column, digits: int, grouped: bool = False, signed: bool = False) -> Column:
    """Number as text with a fixed count of decimals."""
    size = F.abs(exact_round(x, digits))
    text = F.format_number(size, digits)
    if not grouped:
        text = F.replace(text, F.lit(","), F.lit(""))
    sign = F.when(x < 0, "-").otherwise("+" if signed else "")
    return F.concat(sign, text)


def readable_number(x: Column) -> Column:
    """No decimals from one thousand on, two below; thousands separated."""
    return F.when(F.abs(x) >= 1000, fixed(x, 0, grouped=True)).otherwise(fixed(x, 2, grouped=True))


def filled(template: str, **values: Column) -> Column:
    """A sentence template with its {places} filled by columns."""
    parts = []
    for literal, place, _, _ in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if place is not None:
            parts.append(values[place].cast("string"))
    return F.concat(*parts)


def spaced(name: Column) -> Column:
    return F.replace(name, F.lit("_"), F.lit(" "))


def capitalised(name: Column) -> Column:
    """Underscores to spaces, first letter upper, the rest lower."""
    text = F.trim(spaced(name))
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substr(text, F.lit(2))))


def titled(name: Column) -> Column:
    """Underscores to spaces, first letter upper, the rest untouched."""
    text = F.trim(spaced(name))
    full = F.concat(F.upper(F.substring(text, 1, 1)), F.substr(text, F.lit(2)))
    return F.when(text == "", "Variable").otherwise(full)


def mapped(key: Column, table: dict[str, str], default: Column) -> Column:
    result = F
    for value, label in table.items():
        result = result.when(key == value, label)
    return result.otherwise(default)


def levelled(x: Column, levels: tuple, default: str) -> Column:
    result = F
    for threshold, label in levels:
        result = result.when(x >= threshold, label)
    return result.otherwise(default)


def strength_label(coefficient: Column) -> Column:
    return levelled(F.abs(coefficient), STRENGTH_LEVELS, "débil")


def direction_label(coefficient: Column) -> Column:
    return F.when(coefficient > 0, "positiva").otherwise("negativa")


def association_label(eta_squared: Column) -> Column:
    return levelled(eta_squared, ASSOCIATION_LEVELS, "Relevante")


def quality_label(silhouette: Column) -> Column:
    return F.when(silhouette.isNull(), "No evaluable").otherwise(levelled(silhouette, QUALITY_LEVELS, "Baja"))


def trait_reading(difference: Column) -> Column:
    return (
        F.when(difference >= STRONG_TRAIT, "muy por encima")
        .when(difference >= MILD_TRAIT, "por encima")
        .when(difference <= -STRONG_TRAIT, "muy por debajo")
        .when(difference <= -MILD_TRAIT, "por debajo")
        .otherwise("en el promedio")
    )


def method_name(method: Column) -> Column:
    return mapped(method, METHOD_NAMES, capitalised(method))


def shown_time(moment: Column) -> Column:
    """ISO date or time text as day/month/year hour:minute of its own clock; other text as it is."""
    raw = F.coalesce(moment, F.lit(""))
    clock = F.replace(F.substring(raw, 1, 19), F.lit("T"), F.lit(" ")).try_cast("timestamp_ntz")
    iso = raw.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}([.,]\d+)?)?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$")
    return F.when(raw == "", F.lit(NO_TIME)).otherwise(F.coalesce(F.when(iso, F.date_format(clock, "dd/MM/yyyy HH:mm")), raw))
