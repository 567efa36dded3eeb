"""Text clean-up: terminal addresses, account names, truncation and coercion."""

from pyspark.sql import Column, functions as F

from accesslens.constants import UNMATCHED_USER

_EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def strip(c: Column) -> Column:
    """Remove surrounding white space of any kind (``trim`` only knows blanks)."""
    return F.regexp_replace(c, _EDGE_SPACE, "")


def compact_mac(c: Column) -> Column:
    """Hex digits only, lower case."""
    return F.lower(F.regexp_replace(c, "[^0-9a-fA-F]", ""))


def normalize_mac(c: Column) -> Column:
    """``xx:xx:xx:xx:xx:xx`` when the text holds 12 hex digits, else trimmed lower case."""
    digits = compact_mac(c)
    return F.when(
        F.length(digits) == 12, F.regexp_replace(digits, "(..)(?!$)", "$1:")
    ).otherwise(F.lower(strip(c)))


def normalize_username(c: Column) -> Column:
    """The last account token in the text, else an all-digit name, else the unmatched marker.

    NULL and the empty string stay as they are.
    """
    tokens = F.regexp_extract_all(c, F.lit(r"(?i)(GD[FC]\p{Nd}{4,})"), F.lit(1))
    cleaned = strip(F.regexp_replace(c, r"[\x00-\x1f\x7f]", ""))
    return (
        F.when(c.isNull() | (c == ""), c)
        .when(F.size(tokens) > 0, F.upper(F.try_element_at(tokens, F.lit(-1))))
        .when(cleaned.rlike(r"\A\p{Nd}{4,}\z"), cleaned)
        .otherwise(F.lit(UNMATCHED_USER))
    )


def is_business_account(c: Column) -> Column:
    """Whole-text match of an account token or a number, with any count of digits."""
    return F.coalesce(c.rlike(r"(?i)\A(?:GD[FC][0-9]+|[0-9]+)\z"), F.lit(False))


def clip(c: Column, n: int) -> Column:
    """First ``n`` characters."""
    return F.substring(c, 1, n)


def clip_or_null(c: Column, n: int) -> Column:
    """First ``n`` characters; the empty string becomes NULL."""
    return F.nullif(clip(c, n), F.lit(""))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def or_else(first: Column, *rest: Column) -> Column:
    """First value that is neither NULL nor empty (NULL when there is none)."""
    return F.coalesce(*[blank_to_null(c) for c in (first, *rest)])


def text(c: Column) -> Column:
    """NULL becomes the empty string."""
    return F.coalesce(c.cast("string"), F.lit(""))


def uint(c: Column) -> Column:
    """Non-negative integer; anything unreadable or negative becomes 0."""
    return F.greatest(F.coalesce(c.try_cast("bigint"), F.lit(0)), F.lit(0)).cast("bigint")
