"""Scalar expressions shared by the transforms and the reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Addresses of the public portrait and badge images.
PORTRAIT_PREFIX = "https://resources.premierleague.com/premierleague/photos/players/110x140/p"
PORTRAIT_SUFFIX = ".png"
BADGE_PREFIX = "https://resources.premierleague.com/premierleague/badges/50/t"
BADGE_SUFFIX = ".png"
PHOTO_EXTENSION = ".jpg"

# The difficulty scale runs from 1 (easy) to 5 (hard), 3 is neutral.
HARDEST = 5
EASIEST = 1
NEUTRAL = 3


def decode_codes(code: Column, labels: Mapping[int, str]) -> Column:
    """Label of a code; unknown and NULL codes give NULL."""
    entries = [F.lit(part) for pair in labels.items() for part in pair]
    return F.create_map(*entries)[code]


def safe_ratio(numerator: Column, denominator: Column, fallback: float = 0.0) -> Column:
    """``numerator / denominator``, or ``fallback`` where the denominator is not positive."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(fallback))


def pick_side(is_first: Column, first: Column, second: Column) -> Column:
    """``first`` where the flag is true; ``second`` where it is false or NULL."""
    return F.when(is_first, first).otherwise(second)


def favourability(difficulty: Column) -> Column:
    """1 for the easiest calendar, 0 for the hardest; an unknown calendar is neutral."""
    known = F.coalesce(difficulty, F.lit(NEUTRAL))
    return (F.lit(HARDEST) - known) / F.lit(HARDEST - EASIEST)


def weighted_score(weights: Mapping[str, float]) -> Column:
    """Weighted sum of columns; a NULL part contributes nothing."""
    total: Column | None = None
    for name, weight in weights.items():
        part = F.coalesce(F.col(name), F.lit(0.0)) * F.lit(weight)
        total = part if total is None else total + part
    if total is None:
        raise ValueError("weighted_score needs at least one column")
    return total


def full_name(first: Column, second: Column) -> Column:
    """First and last name; NULL if either is missing."""
    return F.concat(first, F.lit(" "), second)


def portrait_url(photo: Column) -> Column:
    bare = F.replace(photo, F.lit(PHOTO_EXTENSION), F.lit(""))
    return F.concat(F.lit(PORTRAIT_PREFIX), bare, F.lit(PORTRAIT_SUFFIX))


def badge_url(team_code: Column) -> Column:
    return F.concat(F.lit(BADGE_PREFIX), team_code.cast("string"), F.lit(BADGE_SUFFIX))


def fixed(value: Column, digits: int, suffix: str = "") -> Column:
    """Text with a fixed number of decimals, the exact double rounded half to even; NULL stays NULL.

    The product with the power of ten is split into its double and the exact error of it, which decides near halves."""
    x, ten = F.abs(value.cast("double")), 10.0**digits
    splitter = 134217729.0
    product = x * F.lit(ten)

    def halves(v: Column) -> tuple[Column, Column]:
        high = v * splitter - (v * splitter - v)
        return high, v - high

    (xh, xl), (th, tl) = halves(x), halves(F.lit(ten))
    error = xl * tl - (((product - xh * th) - xl * th) - xh * tl)
    whole = F.floor(product)
    over = (product - whole - F.lit(0.5)) + error
    up = (over > 0) | ((over == 0) & (whole % 2 == 1))
    units = (whole + F.when(up, F.lit(1)).otherwise(F.lit(0))).cast("decimal(20,0)")
    text = F.concat(
        F.when(value.cast("double").cast("string").startswith("-"), F.lit("-")).otherwise(F.lit("")),
        (units / F.lit(10**digits).cast("decimal(10,0)")).cast(f"decimal(30,{digits})").cast("string"), F.lit(suffix))
    plain = F.format_string(f"%.{digits}f{suffix}", value.cast("double"))  # whole numbers, and what is no number
    return F.when(value.isNull(), F.lit(None)).when(product < 2.0**53, text).otherwise(plain)


def to_payload(*columns: Column | str) -> Column:
    """JSON text of a record, NULL fields included."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
