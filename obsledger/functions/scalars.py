"""Scalar rules: label coding, lenient parsing, dates, seasons, grades."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def _c(col: ColumnLike) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ---- label coding and numbers ------------------------------------------------

def yesno_to_int(col: ColumnLike) -> Column:
    """Yes -> 1, No -> 0, anything else missing."""
    c = _c(col)
    return F.when(c == "Yes", F.lit(1)).when(c == "No", F.lit(0))


def int_to_yesno(col: ColumnLike) -> Column:
    """1 -> Yes, everything else -> No; a missing code stays missing."""
    c = _c(col)
    return F.when(c == 1, F.lit("Yes")).when(c.isNotNull(), F.lit("No"))


def lenient_double(col: ColumnLike, default: float | None = 0.0) -> Column:
    """Text to double; blank, nan, null, none and unreadable text give ``default``."""
    text = F.trim(_c(col).cast("string"))
    number = F.when(~F.lower(text).isin("", "nan", "null", "none"), text.try_cast("double"))
    return F.coalesce(F.when(~F.isnan(number), number), F.lit(default).cast("double"))


def truthy(col: ColumnLike) -> Column:
    """Text yes / 1 / true in any case is true, missing is false."""
    return F.coalesce(F.lower(_c(col).cast("string")).isin("yes", "1", "true"), F.lit(False))


def value_range(high: ColumnLike, low: ColumnLike) -> Column:
    return _c(high) - _c(low)


def publish_round(col: ColumnLike, digits: int = 1, default: float = 0.0) -> Column:
    """Rounded value for publishing, ``default`` when absent."""
    return F.round(F.coalesce(_c(col).cast("double"), F.lit(default)), digits)


def deviation_pct(value: ColumnLike, reference: ColumnLike) -> Column:
    """Percent by which ``value`` is off ``reference``; missing when the reference is 0."""
    return F.try_divide(F.abs(_c(value) - _c(reference)), _c(reference)) * 100


# ---- dates and text ------------------------------------------------------------

def parse_date(col: ColumnLike, lenient: bool = False, fmt: str = "yyyy-MM-dd") -> Column:
    """Text to date. Strict raises on bad text, lenient gives a missing date."""
    if lenient:
        return F.try_to_timestamp(_c(col).cast("string"), F.lit(fmt)).cast("date")
    return F.to_date(_c(col), fmt)


def calendar_part(date: ColumnLike, part: str) -> Column:
    """One calendar part as int; day_of_week counts from Monday = 0."""
    d = _c(date)
    parts = {
        "year": F.year, "month": F.month, "day": F.dayofmonth, "day_of_week": F.weekday,
        "quarter": F.quarter, "day_of_year": F.dayofyear,
    }
    return parts[part](d)


# Season names by month, southern hemisphere.
SEASONS = {
    "en": {"Autumn": (3, 4, 5), "Winter": (6, 7, 8), "Spring": (9, 10, 11), "Summer": (12, 1, 2)},
    "es": {"Verano": (12, 1, 2), "Otoño": (3, 4, 5), "Invierno": (6, 7, 8), "Primavera": (9, 10, 11)},
}
SEASON_OF_MISSING = {"en": "Unknown", "es": "Primavera"}


def season(month: ColumnLike, labels: str = "en") -> Column:
    """Southern-hemisphere season; a missing month takes the label set's own default."""
    m = _c(month)
    out = None
    for name, months in SEASONS[labels].items():
        out = F.when(m.isin(*months), name) if out is None else out.when(m.isin(*months), name)
    return out.otherwise(F.lit(SEASON_OF_MISSING[labels]))


def date_text(date: ColumnLike, days: int = 0) -> Column:
    """Date shifted by ``days`` as yyyy-MM-dd text."""
    return F.date_format(F.date_add(_c(date).cast("date"), days), "yyyy-MM-dd")


def entity_date_key(entity: ColumnLike, date: ColumnLike) -> Column:
    return F.concat_ws("_", _c(entity).cast("string"), date_text(date))


def strip_prefix(col: ColumnLike, prefix: str) -> Column:
    """Remove ``prefix`` from the start of the text where it is there."""
    c = _c(col)
    return F.when(c.startswith(prefix), F.substring(c, len(prefix) + 1, 2147483647)).otherwise(c)


def same_text(a: ColumnLike, b: ColumnLike) -> Column:
    """Case-insensitive equality."""
    return F.lower(_c(a)) == F.lower(_c(b))


# ---- forecast wording ----------------------------------------------------------

def rain_label(probability: ColumnLike, threshold: float = 0.5) -> Column:
    """Yes when the probability is strictly above the threshold."""
    p = _c(probability)
    return F.when(p > threshold, F.lit("Yes")).when(p.isNotNull(), F.lit("No"))


def weather_condition(rain_today: ColumnLike, sunshine: ColumnLike) -> Column:
    """Rainy on a rain day, Sunny above 7 hours of sun (8 assumed when missing), else Partly Cloudy."""
    sun = F.coalesce(_c(sunshine).cast("double"), F.lit(8.0))
    return F.when(truthy(rain_today), "Rainy").when(sun > 7, "Sunny").otherwise("Partly Cloudy")


def precipitation_score(rainfall: ColumnLike, default: float = 30.0, cap: float | None = None) -> Column:
    """Three times the rainfall in mm: a score, not a probability; ``cap`` bounds it."""
    score = F.coalesce(_c(rainfall).cast("double"), F.lit(default)) * 3
    return score if cap is None else F.least(score, F.lit(float(cap)))


# ---- grades --------------------------------------------------------------------

# Lower bounds and the words for them.
R2_GRADES = ((0.8, "excelente"), (0.6, "bueno"), (0.4, "moderado"), (0.2, "débil"))
R2_LOWEST = "muy limitado"
ACCURACY_GRADES = ((0.9, "excelente"), (0.8, "buena"), (0.7, "aceptable"))
ACCURACY_LOWEST = "limitada"


def _graded(col: Column, bounds, lowest: str, strict: bool) -> Column:
    out = F
    for bound, word in bounds:
        out = out.when(col > bound if strict else col >= bound, F.lit(word))
    return out.otherwise(F.lit(lowest))


def grade_r2(col: ColumnLike) -> Column:
    return _graded(_c(col), R2_GRADES, R2_LOWEST, strict=False)


def grade_accuracy(col: ColumnLike) -> Column:
    return _graded(_c(col), ACCURACY_GRADES, ACCURACY_LOWEST, strict=True)


def precision_recall_balance(precision: ColumnLike, recall: ColumnLike, gap: float = 0.1) -> Column:
    """conservative / sensitive when precision and recall differ by more than ``gap``, else balanced."""
    p, r = _c(precision), _c(recall)
    return (F.when(F.abs(p - r) <= gap, "balanced")
             .when(p > r, "conservative")
             .otherwise("sensitive"))


def default_run_id(run_id: ColumnLike, model: str) -> Column:
    """The given run id, or ``<model>_<timestamp>`` when it is missing or empty."""
    stamp = F.date_format(F.current_timestamp(), "yyyyMMddHHmmss")
    return F.coalesce(F.nullif(_c(run_id), F.lit("")), F.concat(F.lit(model + "_"), stamp))


# ---- stable randomness -----------------------------------------------------------

def uniform(*parts) -> Column:
    """Uniform number in (0, 1) from the hash of ``parts``; the same on any partition layout."""
    cols = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    return (F.pmod(F.xxhash64(*cols), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)


def normal(*parts) -> Column:
    """Standard normal number from two hashed uniforms (Box-Muller)."""
    u, v = uniform(*parts, "u"), uniform(*parts, "v")
    return F.sqrt(-2 * F.log(u)) * F.cos(2 * F.pi() * v)
