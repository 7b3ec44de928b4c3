"""Ranges for sensitive numbers."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from .masking import ColumnLike, as_col

Range = tuple[float, float | None, str]

UNKNOWN = "desconocido"

# Fixed values: (from, below, label); None is unbounded.
AGE: list[Range] = [
    (0, 17, "menor_18"),
    (18, 25, "18-25"),
    (26, 35, "26-35"),
    (36, 45, "36-45"),
    (46, 55, "46-55"),
    (56, 65, "56-65"),
    (66, 999, "66+"),
]
BALANCE: list[Range] = [
    (0, 500_000, "0-500K"),
    (500_000, 1_000_000, "500K-1M"),
    (1_000_000, 5_000_000, "1M-5M"),
    (5_000_000, 10_000_000, "5M-10M"),
    (10_000_000, 50_000_000, "10M-50M"),
    (50_000_000, None, "50M+"),
]
INCOME: list[Range] = [
    (0, 400_000, "0-400K"),
    (400_000, 800_000, "400K-800K"),
    (800_000, 1_500_000, "800K-1.5M"),
    (1_500_000, 3_000_000, "1.5M-3M"),
    (3_000_000, 6_000_000, "3M-6M"),
    (6_000_000, None, "6M+"),
]
DEBT: list[Range] = [
    (0, 0, "sin_deuda"),
    (1, 500_000, "0-500K"),
    (500_000, 2_000_000, "500K-2M"),
    (2_000_000, 5_000_000, "2M-5M"),
    (5_000_000, 10_000_000, "5M-10M"),
    (10_000_000, None, "10M+"),
]


def bucketize(value: ColumnLike, ranges: Sequence[Range], contiguous: bool = False) -> Column:
    """Label of the half-open range that holds the value.

    Values in no range get the last label, which is the published behaviour: a
    gap between two ranges, or a negative amount, ends up in the top range.
    With `contiguous=True` a range reaches up to the next one and anything below
    the first is unknown.
    """
    col = as_col(value)
    out = F.when(col.isNull(), UNKNOWN)
    if contiguous:
        out = out.when(col < ranges[0][0], UNKNOWN)
        for (_, _, label), (upper, _, _) in zip(ranges, ranges[1:]):
            out = out.when(col < upper, label)
        return out.otherwise(ranges[-1][2])
    for low, high, label in ranges:
        inside = col >= low if high is None else (col >= low) & (col < high)
        out = out.when(inside, label)
    return out.otherwise(ranges[-1][2])


def age_bucket(value: ColumnLike, as_of: date | str, contiguous: bool = False) -> Column:
    """Age range from an ISO birth date; anything else is unknown."""
    col = as_col(value)
    born = F.when(col.rlike(r"^\d{4}-\d{2}-\d{2}$"), col).try_cast("date")
    age = F.floor(F.datediff(F.lit(str(as_of)).cast("date"), born) / 365)
    return bucketize(age, AGE, contiguous)
