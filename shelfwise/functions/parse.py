"""Column expressions that parse the crawled text fields.

All are built-in Catalyst expressions (codegen, no Python per row). ANSI
mode is on in Spark 4, so every string→number step is a ``try_cast`` and a
separate *strict* check can turn parse failures into an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values that must equal the reference's -----------------------
# Duration shapes, tested in this order (first match wins):
#   '%hr. %min.%'    hours before 'hr.' * 60 + minutes between 'hr. ' and 'min.'
#   '%min. per ep.%' integer before ' min.'
#   '%min%'          integer before ' min'
#   '%hr%'           integer before ' hr' * 60
#   '%sec%'          round(number before ' sec' / 60.0, 2)
#   'unknown'        NULL; anything else NULL
# Rating codes kept when the text has a '-' comment, in this order:
#   'G', 'PG-13', 'R+', 'PG', 'None'; any other value with '-' becomes 'R-17+'
RATING_PREFIXES = ("G", "PG-13", "R+", "PG", "None")
RATING_FALLBACK = "R-17+"
# Missing-value marks of the crawl.
PREMIERED_MISSING = ("?",)
STUDIO_MISSING = ("None found, add some",)
NOT_AVAILABLE = "N/A"
# -------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _int(s: Column) -> Column:
    return s.try_cast("int")


def duration_minutes(c) -> Column:
    """Free-text duration → minutes (double); NULL when no shape matches.

    Each shape is a pattern and the parts of the text around its unit words."""
    d = _c(c)

    def lead(unit: str) -> Column:
        return F.split_part(d, F.lit(unit), F.lit(1))

    after_hours = F.split_part(F.split_part(d, F.lit("hr. "), F.lit(2)), F.lit("min."), F.lit(1))
    shapes = [
        (r"(?s)hr\. .*min\.", _int(lead("hr. ")) * 60 + _int(after_hours)),
        (r"min\. per ep\.", _int(lead(" min."))),
        ("min", _int(lead(" min"))),
        ("hr", _int(lead(" hr")) * 60),
        ("sec", F.round(lead(" sec").try_cast("double") / 60, 2)),
    ]
    return _first_shape(d, shapes)


def _first_shape(d: Column, shapes: list) -> Column:
    out = F.lit(None).cast("double")
    for pattern, minutes in reversed(shapes):
        out = F.when(d.rlike(pattern), minutes.cast("double")).otherwise(out)
    return out


def duration_shape_matched(c) -> Column:
    """True when the text has one of the numeric shapes (a parse is expected)."""
    d = _c(c)
    return d.like("%hr%") | d.like("%min%") | d.like("%sec%")


def collapse_rating(c) -> Column:
    """Drop the comment after a rating code (only where the text has '-')."""
    r = _c(c)
    codes = sorted(RATING_PREFIXES, key=len, reverse=True)   # a longer code before one that it begins with
    code = F.regexp_extract(r, "^(" + "|".join(p.replace("+", r"\+") for p in codes) + ")", 1)
    short = F.coalesce(F.nullif(code, F.lit("")), F.lit(RATING_FALLBACK))
    return F.when(F.contains(r, F.lit("-")), short).otherwise(r)


def int_with_commas(c) -> Column:
    """'1,234' → 1234; NULL, 'Unknown' or non-digits → NULL (bigint)."""
    s = F.regexp_replace(_c(c), ",", "")
    return F.when(s.rlike(r"^[0-9]+\z"), s.try_cast("bigint"))


def int_digits(c) -> Column:
    """Digits only → int, else NULL."""
    s = _c(c)
    return F.when(s.rlike(r"^[0-9]+\z"), s.try_cast("int"))


def float_guarded(c) -> Column:
    """Digits with at most one '.' → double ('8.' and '.5' included), else NULL."""
    s = _c(c)
    return F.when(s.rlike(r"^([0-9]+\.?[0-9]*|\.[0-9]+)\z"), s.try_cast("double"))


def digits_only(c) -> Column:
    """Remove every non-digit character."""
    return F.regexp_replace(_c(c), "[^0-9]", "")


def drop_first_char(c) -> Column:
    """``value[1:]`` (drops the '#' of 'Ranked: #12')."""
    s = _c(c)
    return s.substr(F.lit(2), F.length(s))
