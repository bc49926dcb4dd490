"""Column expressions. All are built-in Spark functions (JVM-side, inside
whole-stage codegen); no Python UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.schema import BAND_EDGES, BAND_LABELS, KEY_MODULUS


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def dbl(x) -> Column:
    """A double literal (a bare ``0.0`` in Spark SQL is a decimal)."""
    return F.lit(float(x)).cast("double")


# ── rounding ──────────────────────────────────────────────────────────────────
# Beyond this a double has no digits after the point, and decimal(28,8) no room.
_WHOLE = 1e19


def round_half_up(col, scale: int) -> Column:
    """Round half away from zero on the decimal text of the number: the double is read
    as decimal(28,8) and rounded to ``scale`` places (so 1.005 gives 1.01). Numbers of
    1e19 and more have no fraction and pass unchanged, as do null, NaN and infinity."""
    x = _c(col).cast("double")
    rounded = F.round(x.try_cast("decimal(28,8)"), scale).cast("double")
    return F.when(F.abs(x) < _WHOLE, rounded).otherwise(x)


def round_agg(col, scale: int) -> Column:
    """Round an aggregated value (average, ratio of sums). The eight decimal places of
    ``round_half_up`` drop summation-order noise (engines and partitionings add doubles
    in different orders) before the half is looked at."""
    return round_half_up(col, scale)


def exact_sum(col) -> Column:
    """Sum over decimal(28,8): the same in whatever order rows are added, so a total that
    ends in exactly one half rounds the same way everywhere. Numbers of 1e20 and more do
    not fit and raise."""
    return F.sum(_c(col).cast("decimal(28,8)"))


def exact_total(col, scale: int) -> Column:
    return F.round(exact_sum(col), scale).cast("double")


def nullif_zero(col) -> Column:
    return F.when(_c(col) == 0, F.lit(None)).otherwise(_c(col))


def ratio(num, den, scale: int | None = None) -> Column:
    """num / nullif(den, 0), optionally rounded half-up to ``scale`` places."""
    r = F.try_divide(_c(num).cast("double"), nullif_zero(den).cast("double"))
    return r if scale is None else round_half_up(r, scale)


# ── strings ───────────────────────────────────────────────────────────────────
# Whitespace as Python's str.strip() sees it (ASCII and Unicode spaces).
_WS_CHARS = "\t\n\x0b\x0c\r \x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B)) \
    + "\u2028\u2029\u202f\u205f\u3000"


def py_strip(col) -> Column:
    """Strip leading/trailing whitespace of every kind (Spark ``trim`` strips only
    spaces); ``btrim`` with an explicit character set, no regular expression."""
    return F.btrim(_c(col), F.lit(_WS_CHARS))


_PLAIN_WORDS = r"^[A-Za-z ]*+[ -@\[-`{-~]*+\z"


def py_title(col) -> Column:
    """Title case as Python's ``str.title``: the first letter of every run of letters
    upper-case, the rest lower-case; anything that is not a letter starts a new word
    (``initcap`` alone only splits on spaces).

    A space is inserted after every non-letter so ``initcap`` sees a word start
    there, then exactly those inserted spaces are removed again — three codegen'd
    string functions instead of a per-row lambda. ASCII letters and spaces with nothing
    but printable non-letters behind them need neither: ``initcap`` sees all their words."""
    x = _c(col)
    spaced = F.regexp_replace(x, r"([^\p{L}])", "$1 ")
    full = F.regexp_replace(F.initcap(spaced), r"([^\p{L}]) ", "$1")
    return F.when(x.rlike(_PLAIN_WORDS), F.initcap(x)).otherwise(full)


def standardise(col) -> Column:
    return py_title(py_strip(col))


def sql_initcap_trim(col) -> Column:
    """``initcap(trim(x))`` — the SQL layer's casing (space-delimited words)."""
    return F.initcap(F.trim(_c(col)))


# ── hash keys ─────────────────────────────────────────────────────────────────
def md5_mod(col, modulus: int = KEY_MODULUS) -> Column:
    """``int(md5(x).hexdigest(), 16) % modulus`` without a UDF (see ``hex_mod``)."""
    return hex_mod(F.md5(_c(col).cast("string")), modulus)


def hex_mod(h: Column, modulus: int = KEY_MODULUS) -> Column:
    """A 32-digit hex digest read as a 128-bit integer, modulo ``modulus``.

    The digest is read as words of 15, 15 and 2 digits (15 are the most that a bigint
    surely holds), each weighted with the power of 16 of its place; the powers are reduced
    modulo ``modulus`` once, in Python, and the sum stays far inside a bigint. Null in, null out."""
    total, at = None, 0
    for digits in (15, 15, 2):
        word = F.conv(F.substring(h, 1 + at, digits), 16, 10).cast("bigint")
        at += digits
        term = (word % F.lit(modulus)) * F.lit(pow(16, 32 - at, modulus))
        total = term if total is None else total + term
    return (total % F.lit(modulus)).cast("bigint")


# ── bands / flags ─────────────────────────────────────────────────────────────
def value_band_left_closed(col) -> Column:
    """``<500K`` for v < 500000, ... ``>5M`` otherwise (also for null)."""
    v = _c(col)
    expr = None
    for edge, label in zip(BAND_EDGES, BAND_LABELS):
        expr = F.when(v < edge, label) if expr is None else expr.when(v < edge, label)
    return expr.otherwise(BAND_LABELS[-1])


def value_band_right_closed(col) -> Column:
    """Bins (0, 500K], (500K, 1M], ..., (5M, inf]; v <= 0 or null gives null."""
    v = _c(col)
    expr = F.when(v.isNull() | (v <= 0), F.lit(None).cast("string"))
    for edge, label in zip(BAND_EDGES, BAND_LABELS):
        expr = expr.when(v <= edge, label)
    return expr.otherwise(BAND_LABELS[-1])


def flag(cond: Column) -> Column:
    """Boolean condition as 0/1 int; null counts as 0."""
    return F.when(cond, 1).otherwise(0).cast("int")


# ── time ──────────────────────────────────────────────────────────────────────
def parse_date(col) -> Column:
    """Lenient date parse: anything unparseable becomes null (ANSI-safe)."""
    return _c(col).try_cast("date")


def time_features(date_col) -> dict[str, Column]:
    d = _c(date_col)
    return {
        "year": F.year(d).cast("int"),
        "month": F.month(d).cast("int"),
        "quarter": F.quarter(d).cast("int"),
        "day_of_week": F.weekday(d).cast("int"),          # Monday = 0
        "year_month": F.date_format(d, "yyyy-MM"),
    }


# ── scores ────────────────────────────────────────────────────────────────────
def risk_score(rate, vacancy, demand, distance) -> Column:
    """rate*100 + vacancy*50 - demand*5 + distance*0.1, rounded to 2 places."""
    return round_half_up(_c(rate) * 100.0 + _c(vacancy) * 50.0 - _c(demand) * 5.0 + _c(distance) * dbl(0.1), 2)


def investment_score(demand, vacancy, rate, ratio_col) -> Column:
    """demand*15 + (1-vacancy)*10 - rate*50 + ratio*5, rounded; null when ratio is null."""
    return round_half_up(_c(demand) * 15.0 + (1.0 - _c(vacancy)) * 10.0 - _c(rate) * 50.0 + _c(ratio_col) * 5.0, 2)


def investment_score_basic(demand, vacancy, rate) -> Column:
    """Three-term variant without the demand/supply ratio."""
    return round_half_up(_c(demand) * 15.0 + (1.0 - _c(vacancy)) * 10.0 - _c(rate) * 50.0, 2)


# ── formatting (for report strings) ───────────────────────────────────────────
def thousands(col) -> Column:
    """Integer with thousands separators: 1234567 -> '1,234,567'."""
    return F.format_number(_c(col).cast("bigint"), 0)


def fixed(col, scale: int) -> Column:
    """Fixed-point text with ``scale`` decimals, half-up: 3.14159 -> '3.14'; null -> 'nan'."""
    txt = F.round(_c(col).try_cast("decimal(38,10)"), scale).cast(f"decimal(38,{scale})").cast("string")
    return F.coalesce(txt, F.lit("nan"))


def short_float(col, scale: int) -> Column:
    """Text of a value rounded to ``scale`` places in shortest form, as a float prints:
    12.50 -> '12.5', 3 -> '3.0'; null -> 'nan'."""
    txt = fixed(col, scale)
    if scale == 0:
        return F.when(txt == "nan", txt).otherwise(F.concat(txt, F.lit(".0")))
    trimmed = F.regexp_replace(txt, r"0+$", "")
    return F.when(txt == "nan", txt).otherwise(
        F.when(trimmed.endswith("."), F.concat(trimmed, F.lit("0"))).otherwise(trimmed))
