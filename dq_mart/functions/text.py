"""String column functions: whitespace, null tokens, header names.

All of them are built-in Spark expressions, so they stay inside
whole-stage codegen; nothing here runs Python per row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Text fields that the reference's CSV reader (pandas 2.x default) turns into
# a missing value when the whole field equals one of them exactly.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
# Characters that a raw header turns into a single underscore, as a regex.
HEADER_NOISE = r"[.\s()\-]+"
# ---------------------------------------------------------------------------

# Every character Python's ``str.strip()`` removes (derived by rule, not listed).
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def quoted(name: str) -> str:
    """A column name as a literal identifier (dots, spaces are part of it)."""
    return "`" + name.replace("`", "``") + "`"


def col_of(c: Column | str) -> Column:
    """A Column from a Column or a plain column *name* (never a nested path)."""
    return F.col(quoted(c)) if isinstance(c, str) else c


def strip_ws(c: Column | str) -> Column:
    """Remove leading and trailing whitespace of every kind (tab, CR, LF,
    no-break space ...), like Python's ``str.strip()``.

    Spark's one-argument ``trim`` removes spaces only; ``btrim`` with the
    explicit set is exact and stays in generated code (no regex per value).
    """
    return F.btrim(col_of(c), F.lit(WHITESPACE))


def null_tokens(c: Column | str) -> Column:
    """Null out the fields the reference's reader treats as missing."""
    c = col_of(c)
    return F.when(c.isin(*NA_TOKENS), F.lit(None).cast("string")).otherwise(c)


def is_blank(c: Column | str) -> Column:
    """Null or whitespace-only text."""
    c = col_of(c)
    return c.isNull() | (strip_ws(c) == F.lit(""))


def normalize_header(name: str) -> str:
    """One raw column name -> its clean form; case is kept."""
    return re.sub(HEADER_NOISE, "_", name).strip("_")
