"""Column -> Column building blocks (all built-in Spark expressions)."""

from .casts import (bigint_or_zero, parse_list_string, to_date_safe, yes_no,
                    TRUE_WORDS, YES_NO_DOMAIN, DEFAULT_DATE_FORMATS)
from .numeric import (avg_money_from, idiv, money, pct_half_up, report_number,
                      sum_money)
from .text import (NA_TOKENS, is_blank, normalize_header, null_tokens,
                   strip_ws)

__all__ = [
    "bigint_or_zero", "parse_list_string", "to_date_safe", "yes_no",
    "TRUE_WORDS", "YES_NO_DOMAIN", "DEFAULT_DATE_FORMATS",
    "avg_money_from", "idiv", "money", "pct_half_up", "report_number",
    "sum_money", "NA_TOKENS", "is_blank", "normalize_header", "null_tokens",
    "strip_ws",
]
