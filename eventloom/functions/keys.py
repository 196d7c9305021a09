"""Region numbers, missing-value markers and source fallbacks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_OFFSET = 10_000
REJECTED_KEY = -1


def normalize_key_number(col: Column) -> Column:
    """0 becomes NULL; numbers up to 10000 gain 10000."""
    return F.when(col == 0, None).when(col <= KEY_OFFSET, col + KEY_OFFSET).otherwise(col)


def normalize_key_number_offset(col: Column) -> Column:
    """Every number gains 10000; what was 0 becomes NULL."""
    return F.nullif(col + KEY_OFFSET, F.lit(KEY_OFFSET))


def coalesce_sources(*cols: Column, invalid: tuple = ()) -> Column:
    """First value that is neither NULL nor one of the invalid markers."""
    kept = []
    for col in cols:
        for marker in invalid:
            col = F.nullif(col, F.lit(marker))
        kept.append(col)
    return F.coalesce(*kept)


def numeric_coerce(col: Column, to: str = "double") -> Column:
    """Text to number; anything else, also NaN in any spelling, becomes NULL."""
    number = F.trim(col).try_cast(to)
    return F.when(~F.isnan(number), number) if to in ("double", "float") else number


def row_min(*cols: Column) -> Column:
    """Least value of a row, ignoring missing ones."""
    return F.least(*cols) if len(cols) > 1 else cols[0]


def has_key(col: Column) -> Column:
    """Region number is given and not 0."""
    return F.coalesce(col != 0, F.lit(False))


def pick_key_source(first: Column, second: Column, third: Column, keys: Column) -> tuple[Column, Column]:
    """Region number and its source by hierarchy.

    The highest source that has a number decides alone: when its number is not among the
    series' numbers the event is rejected (-1, NULL) and lower sources are not asked.
    """
    tags = ((first, "GOES"), (second, "XRT"), (third, "SSW"))
    number, source = F.lit(REJECTED_KEY).cast("long"), F.lit(None).cast("string")
    for col, tag in reversed(tags):
        member = F.coalesce(F.array_contains(keys, col), F.lit(False))
        number = F.when(col.isNotNull(), F.when(member, col.cast("long")).otherwise(REJECTED_KEY)).otherwise(number)
        source = F.when(col.isNotNull(), F.when(member, F.lit(tag))).otherwise(source)
    return number, source
