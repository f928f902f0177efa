"""String helpers for policy text and model replies."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# A token is a run of letters, numbers or underscores; blanks are
# the Unicode white space characters and the four ASCII separators.
TOKEN_PATTERN = r"[\p{L}\p{N}_]+"
BLANKS = r"\x09-\x0d\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
BLANK_PATTERN = rf"[{BLANKS}]+"
FENCE_PATTERN = r"(?s)```(?:json)?\s*(.*?)\s*```"


def words(text: Column) -> Column:
    """Blank-separated words, without empty ones."""
    return F.filter(F.split(text, BLANK_PATTERN), lambda w: w != "")


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), 0)


def strip_blank(text: Column) -> Column:
    """Drop leading and trailing white space, line ends included."""
    return F.regexp_replace(text, rf"^[{BLANKS}]+|[{BLANKS}]+\z", "")


def snippet(text: Column, max_chars: int = 200) -> Column:
    """The text itself, or its right-trimmed beginning with an ellipsis for display."""
    cut = F.regexp_replace(F.substring(text, 1, max_chars), rf"[{BLANKS}]+\z", "")
    return F.when(F.length(text) <= max_chars, text).otherwise(F.concat(cut, F.lit("...")))


def strip_fences(reply: Column) -> Column:
    """Content of the first fenced block, or the whole reply without one."""
    return F.when(reply.rlike(FENCE_PATTERN), F.regexp_extract(reply, FENCE_PATTERN, 1)).otherwise(reply)


def float_text(value: Column) -> Column:
    """Decimal text of a double: plain digits down to 0.0001, then d.dde-NN."""
    text = value.cast("string")
    sign = F.when(value < 0, F.lit("-")).otherwise(F.lit(""))
    mantissa = F.regexp_replace(F.regexp_extract(text, r"^-?([0-9.]+)E", 1), r"\.0$", "")
    exponent = F.regexp_extract(text, r"E-([0-9]+)$", 1)
    return (
        F.when(~text.contains("E-"), text)
        .when(exponent == "4", F.concat(sign, F.lit("0.000"), F.replace(mantissa, F.lit("."), F.lit(""))))
        .otherwise(F.concat(sign, mantissa, F.lit("e-"), F.lpad(exponent, 2, "0")))
    )
