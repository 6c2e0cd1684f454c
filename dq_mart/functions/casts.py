"""Safe casts from raw text, with the reference's coercion rules.

Every cast is a ``try_*`` form: under ANSI mode a plain cast of a bad value
fails the whole job, whereas the reference coerces bad values (to null,
False or 0).  All are JVM-side expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_of, strip_ws

# --- fixed values -----------------------------------------------------------
# Lower-cased, trimmed text that the ETL reads as True; anything else
# (including a missing value) is False.
TRUE_WORDS = ("yes", "true", "1")
# The two spellings the profiling audit accepts for a yes/no column.
YES_NO_DOMAIN = ("yes", "no")
# Default date layout of the raw files.
DEFAULT_DATE_FORMATS = ("yyyy-MM-dd",)
# ---------------------------------------------------------------------------

LIST_SCHEMA = "array<string>"
# Text shapes that Spark's integral / decimal casts can accept.  Checking the
# shape first keeps junk text away from the cast's exception path (a thrown
# and caught parse error per bad value costs far more than a regex match).
_INT_TEXT = r"^\s*[+-]?\d+\s*$"
_NUM_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
# Plain decimals: the sign and the digits before the point.
_WHOLE_PART = r"^\s*([+-]?)(\d*)(\.\d*)?\s*$"
_QUOTED = r"""^\(\s*(?:'(?:\\.|[^'\\])*'|"(?:\\.|[^"\\])*")\s*\)$"""
_INTEGRAL = ("tinyint", "smallint", "int", "bigint", "byte", "short", "integer", "long")


def safe_cast(c: Column | str, type_: str) -> Column:
    """``try_cast`` from text, null when the value does not fit; integral
    and decimal targets are shape-checked first (same results, no
    exception per bad value).  Worth it where junk is common (P7); on
    mostly clean columns the plain ``try_cast`` is cheaper."""
    c = col_of(c)
    t = type_.lower()
    if t in _INTEGRAL:
        return F.when(c.rlike(_INT_TEXT), c.try_cast(type_))
    if t.startswith("decimal"):
        return F.when(c.rlike(_NUM_TEXT), c.try_cast(type_))
    return c.try_cast(type_)
_JSON_OPTS = {"allowSingleQuotes": "true",
              "allowBackslashEscapingAnyCharacter": "true"}


def number_or_null(c: Column | str) -> Column:
    """Text -> DOUBLE for plain decimal numbers (with an exponent or not);
    null for anything else, also for forms that only Java reads (``12d``,
    ``0x1p3``, ``Infinity``)."""
    c = col_of(c)
    return F.when(c.rlike(_NUM_TEXT), c.try_cast("double"))


def declared_cast(c: Column, type_: str, from_text: bool) -> Column:
    """A value as its declared type, null when it does not fit.  An integer
    column takes any number and rounds it half away from zero, as the store
    does on assignment (``5.0`` is 5, ``12.7`` is 13); text that is no plain
    number does not fit."""
    if type_.lower() not in _INTEGRAL:
        return c.try_cast(type_)
    exact = c.try_cast("decimal(38,10)")
    if not from_text:
        return F.round(exact, 0).try_cast(type_)
    return F.coalesce(c.try_cast(type_),
                      F.when(c.rlike(_NUM_TEXT), F.round(exact, 0).try_cast(type_)))


def yes_no(c: Column | str) -> Column:
    """Text -> boolean: strip, lower, membership; null becomes False."""
    norm = F.lower(strip_ws(col_of(c).cast("string")))
    return F.coalesce(norm.isin(*TRUE_WORDS), F.lit(False))


ISO_DATE = "yyyy-MM-dd"


def to_date_safe(c: Column | str,
                 formats: Sequence[str] = DEFAULT_DATE_FORMATS) -> Column:
    """Text -> date; the first format that parses wins, else null.

    The ISO layout is parsed by ``try_cast`` (Spark's date parser: no
    formatter and no exception per bad value, so it stays cheap on dirty
    columns); other layouts use ``try_to_date`` with the given pattern."""
    c = col_of(c).cast("string")
    parsed = [c.try_cast("date") if f == ISO_DATE else F.try_to_date(c, f) for f in formats]
    return parsed[0] if len(parsed) == 1 else F.coalesce(*parsed)


def bigint_from_text(c: Column | str) -> Column:
    """Text -> BIGINT: exact for integers (also above 2^53), fractions are
    truncated toward zero, null for anything that is no number or out of
    range (never the nearest id that fits)."""
    c = col_of(c).cast("string")
    # numbers only, not literals such as 12d or 0x1p3; a fraction's whole part is
    # cut from the text, so that no digit of it is rounded away
    whole = F.concat(F.regexp_extract(c, _WHOLE_PART, 1), F.lit("0"), F.regexp_extract(c, _WHOLE_PART, 2))
    return F.coalesce(safe_cast(c, "bigint"), F.when(c.rlike(_NUM_TEXT), F.when(
        c.rlike("[eE]"), c.try_cast("decimal(38,10)").try_cast("bigint")).otherwise(whole.try_cast("bigint"))))


def bigint_or_zero(c: Column | str) -> Column:
    """Text -> BIGINT with 0 for anything unparseable or missing."""
    return F.coalesce(bigint_from_text(c), F.lit(0).cast("bigint"))


def parse_list_string(c: Column | str) -> Column:
    """A Python-style list literal in text -> ``array<string>``; null when it
    does not parse.

    Accepted: ``['A', 'B']``, ``["A"]``, ``[]``, escaped quotes, a trailing
    comma, and a tuple or set bracket pair.  A bare string (also in
    parentheses, where only a comma makes a tuple), unquoted items or empty
    text are parse errors.
    """
    s = strip_ws(col_of(c))
    # only a comma makes a tuple: ('AB') is the string itself
    s = F.when(~s.rlike(_QUOTED), s)
    s = F.regexp_replace(s, r"^\((.*)\)$", "[$1]")
    s = F.regexp_replace(s, r"^\{(.*)\}$", "[$1]")
    s = F.regexp_replace(s, r",\s*\]$", "]")
    # only bracketed text can be an array: skip the parser (and its
    # per-record parse error) for anything else
    return F.when(s.startswith("[") & s.endswith("]"), F.from_json(s, LIST_SCHEMA, _JSON_OPTS))
