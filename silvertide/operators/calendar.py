"""Business days and request deadlines."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, timedelta
from functools import lru_cache
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silvertide.functions.masking import ColumnLike, as_col
from silvertide.functions.rules import day

# Public holidays of 2026.
HOLIDAYS_2026 = (
    "2026-01-01", "2026-04-03", "2026-04-04", "2026-05-01", "2026-05-21", "2026-06-29",
    "2026-07-16", "2026-08-15", "2026-09-18", "2026-09-19", "2026-10-12", "2026-10-31",
    "2026-11-01", "2026-12-08", "2026-12-25",
)

LEGAL_LIMIT_DAYS = 15


LAST_YEAR = 9999
# Dates and weekdays repeat after so many years.
CYCLE = 400


def is_workday(value: ColumnLike, pattern: Iterable[str] = HOLIDAYS_2026) -> Column:
    """Monday to Friday and not a holiday; the month and day of each holiday recur every year."""
    col = as_col(value)
    return (F.weekday(col) < 5) & ~F.date_format(col, "MM-dd").isin(*[h[5:] for h in pattern])


@dataclass(frozen=True)
class _Index:
    """Business days of every kind of year, and of the years of a cycle before each year.

    kind: of each year of the cycle, by its length and first weekday; up_to: business days up to each day of the 14
    kinds, 366 a kind; day: day of the year of each business day, 366 a kind; before: business days of the cycle before each
    year, and of the whole.
    """

    kind: tuple[int, ...]
    up_to: tuple[int, ...]
    day: tuple[int, ...]
    before: tuple[int, ...]


@lru_cache(maxsize=32)
def _index(month_days: tuple[tuple[int, int], ...]) -> _Index:
    kinds: dict[tuple[int, int], int] = {}
    up_to, days, kind, before = [], [], [], [0]
    for year in range(2000, 2000 + CYCLE):
        first = date(year, 1, 1)
        length = (date(year + 1, 1, 1) - first).days
        key = (length, first.weekday())
        if key not in kinds:
            kinds[key] = len(kinds)
            all_days = [first + timedelta(days=i) for i in range(length)]
            work = [d.weekday() < 5 and (d.month, d.day) not in month_days for d in all_days]
            counts = list(accumulate(map(int, work)))
            up_to += counts + [counts[-1]] * (366 - length)
            own = [i for i, w in enumerate(work) if w]
            days += own + [-1] * (366 - len(own))
        kind.append(kinds[key])
        before.append(before[-1] + up_to[kinds[key] * 366 + 365])
    return _Index(tuple(kind), tuple(up_to), tuple(days), tuple(before))


def _listed(values: Iterable[int]) -> Column:
    """A constant array, folded to a literal once per plan."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<int>")


def _month_days(pattern: Iterable[str]) -> tuple[tuple[int, int], ...]:
    return tuple(sorted({(int(h[5:7]), int(h[8:10])) for h in pattern}))


def business_ordinal(value: ColumnLike, pattern: Iterable[str] = HOLIDAYS_2026) -> Column:
    """How many business days there are from the year 0 up to a date, itself included."""
    index, col = _index(_month_days(pattern)), F.to_date(as_col(value))
    year = F.pmod(F.year(col), F.lit(CYCLE))
    own = F.get(_listed(index.up_to), F.get(_listed(index.kind), year) * 366 + F.dayofyear(col) - 1)
    cycles = F.floor(F.year(col) / CYCLE)
    return cycles * F.lit(index.before[-1]) + F.get(_listed(index.before), year) + own


def business_days_after(start: ColumnLike, days: ColumnLike, pattern: Iterable[str] = HOLIDAYS_2026) -> Column:
    """The date `days` business days after a date: the business day with the ordinal that many further on.

    The holidays recur by month and day, so 14 kinds of year and the 400 years of a cycle are all that is looked up, by
    position. Zero days give the date itself. Null for null input, negative counts, results after year 9999, and
    where no day is a business day.
    """
    pattern = tuple(pattern)
    index, first, n = _index(_month_days(pattern)), F.to_date(as_col(start)), as_col(days).cast("long")
    whole = index.before[-1]
    if not whole:
        return F.when(n == 0, first)
    place = business_ordinal(first, pattern) + n - 1
    rest = F.pmod(place, F.lit(whole))
    # Years differ by a few business days, so the mean leads to the right one or its neighbour.
    guess = F.floor(rest * CYCLE / whole).cast("int")
    before = _listed(index.before)
    year = guess + F.when(F.get(before, guess + 1) <= rest, 1).when(F.get(before, guess) > rest, -1).otherwise(0)
    day_of_year = F.get(_listed(index.day), F.get(_listed(index.kind), year) * 366 + (rest - F.get(before, year)).cast("int"))
    full_year = (F.floor(place / whole) * CYCLE + year).cast("int")
    found = F.date_add(F.make_date(F.when(full_year <= LAST_YEAR, full_year), F.lit(1), F.lit(1)), day_of_year)
    return F.when(n == 0, first).when(n > 0, found)


def business_calendar(
    spark: SparkSession, start: date | str, end: date | str, pattern: Iterable[str] = HOLIDAYS_2026
) -> DataFrame:
    """One row per day: dia, habil, festivo, ordinal (business days from `start` up to the day) and siguiente_habil."""
    first, last = (date.fromisoformat(str(d)[:10]) for d in (start, end))
    pattern, epoch = tuple(pattern), date(1970, 1, 1)
    days = spark.range((first - epoch).days, (last - epoch).days + 1).select(F.date_from_unix_date(F.col("id").cast("int")).alias("dia"))
    before = business_ordinal(F.lit(str(first - timedelta(days=1))), pattern)
    return days.select(
        "dia", is_workday("dia", pattern).alias("habil"), F.date_format("dia", "MM-dd").isin(*[h[5:] for h in pattern]).alias("festivo"),
        (business_ordinal("dia", pattern) - before).cast("int").alias("ordinal"), business_days_after("dia", F.lit(1), pattern).alias("siguiente_habil"),
    )


def add_business_days(
    df: DataFrame, column: str, days: int | Column, out: str, pattern: Iterable[str] = HOLIDAYS_2026
) -> DataFrame:
    """A column with the date that lies `days` business days after a date column."""
    return df.withColumn(out, business_days_after(column, days if isinstance(days, Column) else F.lit(days), pattern))


def request_state(
    asked: ColumnLike, resolution_days: ColumnLike, resolved: ColumnLike, limit: ColumnLike, as_of: date | str | Column
) -> Column:
    """Life-cycle state of a request at a day."""
    age = F.datediff(day(as_of), as_col(asked))
    done = F.when(as_col(resolved) > as_col(limit), "VENCIDO").otherwise("COMPLETADO")
    return (
        F.when(age == 0, "PENDIENTE")
        .when(age <= 2, "EN_PROCESO")
        .when(age >= as_col(resolution_days), done)
        .otherwise("EN_PROCESO")
    )


def age_requests(
    df: DataFrame,
    as_of: date | str,
    asked: str = "fecha_solicitud",
    resolution_days: str = "dias_resolucion_estimados",
    pattern: Iterable[str] = HOLIDAYS_2026,
) -> DataFrame:
    """Deadline, resolution day and state of requests from their age."""
    today = day(as_of)
    dated = add_business_days(df, asked, LEGAL_LIMIT_DAYS, "limite", pattern)
    dated = add_business_days(dated, asked, F.col(resolution_days), "resolucion", pattern)
    state = request_state(F.to_date(asked), resolution_days, "resolucion", "limite", as_of)
    return (
        dated.withColumn("estado_calculado", state)
        .withColumn("resolucion", F.when(F.col("estado_calculado") == "COMPLETADO", F.col("resolucion")))
        .withColumn("dias_restantes", F.greatest(F.lit(0), F.datediff("limite", today)))
    )
