"""Small business rules shared by several tables."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from .masking import ColumnLike, as_col


def instant(as_of: datetime | date | str | Column) -> Column:
    """The caller's notion of "now" as a timestamp column."""
    return as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("timestamp")


def day(as_of: date | str | Column) -> Column:
    """The caller's "today" as a date column."""
    return as_of if isinstance(as_of, Column) else F.lit(str(as_of)[:10]).cast("date")


def is_true(condition: Column) -> Column:
    """Two-valued flag: an unknown condition does not raise it."""
    return F.coalesce(condition, F.lit(False))


def money(value: ColumnLike) -> Column:
    """Amount as an exact number, so sums do not depend on row order."""
    return as_col(value).cast("decimal(18,2)")


def ratio(part: ColumnLike, whole: ColumnLike) -> Column:
    """part / whole, null when whole is 0."""
    return F.try_divide(as_col(part).cast("double"), as_col(whole).cast("double"))


def quality_score(valid: ColumnLike, total: ColumnLike) -> Column:
    return F.round(ratio(valid, total) * 100, 2)


def traffic_light(share: ColumnLike, green: float = 0.98, amber: float = 0.95) -> Column:
    col = as_col(share)
    return F.when(col >= green, "VERDE").when(col >= amber, "AMARILLO").otherwise("ROJO")


def risk_level(score: ColumnLike) -> Column:
    col = as_col(score)
    return F.when(col >= 0.8, "ALTO").when(col >= 0.5, "MEDIO").otherwise("BAJO")


def is_midmonth(day: ColumnLike) -> Column:
    """Pay-day peaks: the middle and the end of a month."""
    return F.dayofmonth(as_col(day)).isin(15, 16, 28, 29, 30, 31)


def is_business_day(day: ColumnLike, holidays: Iterable[date | str]) -> Column:
    col = as_col(day)
    dates = [F.lit(str(h)).cast("date") for h in holidays]
    return (F.weekday(col) < 5) & (~col.isin(*dates) if dates else F.lit(True))


def check_digit(body: ColumnLike) -> Column:
    """Modulo-11 check digit of a digit string (weights 2 to 7 from the right)."""
    digits = F.split(F.reverse(as_col(body).cast("string")), "")
    weighted = F.transform(digits, lambda d, i: d.try_cast("int") * (F.lit(2) + i % 6))
    total = F.aggregate(weighted, F.lit(0), lambda acc, x: acc + x)
    left = F.lit(11) - total % 11
    return F.when(left == 10, "K").when(left == 11, "0").otherwise(left.cast("string"))


def rut_is_valid(rut: ColumnLike) -> Column:
    """Format and check digit of `12.345.678-5` or `12345678-5`."""
    plain = F.upper(F.replace(as_col(rut), F.lit("."), F.lit("")))
    shaped = plain.rlike("^[0-9]{7,8}-[0-9K]$")
    return is_true(shaped & (check_digit(F.substring_index(plain, "-", 1)) == F.right(plain, F.lit(1))))


def format_rut(number: ColumnLike) -> Column:
    """`12345678` to `12.345.678-5`."""
    col = as_col(number)
    dotted = F.replace(F.format_number(col, 0), F.lit(","), F.lit("."))
    return F.concat(dotted, F.lit("-"), check_digit(col))


def luhn_is_valid(number: ColumnLike) -> Column:
    """Luhn test over the digits of a text."""
    digits = F.split(F.reverse(F.regexp_replace(as_col(number), "[^0-9]", "")), "")

    def term(d: Column, i: Column) -> Column:
        n = d.try_cast("int")
        doubled = n * 2
        return F.when(i % 2 == 0, n).when(doubled > 9, doubled - 9).otherwise(doubled)

    total = F.aggregate(F.transform(digits, term), F.lit(0), lambda acc, x: acc + x)
    return is_true(total % 10 == 0)
