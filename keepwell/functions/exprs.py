"""Column expressions with the null, rounding and time rules used everywhere."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, functions as F

MICROS_PER_DAY = 86_400_000_000


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- numbers -----------------------------------------------------------------

def rounded(c: str | Column, digits: int) -> Column:
    """Half-up rounding, done once and returned as double.

    Exact decimals are rounded as they are.  A double is moved up by a few units in its last
    place first, so that ties such as 0.145 stay ties whatever their binary form, while
    12.499999998 stays below 12.5.
    """
    c = as_column(c)
    exact = F.round(c, digits).cast("double")
    near = F.round(c.cast("double") * F.lit(1 + 1e-14), digits)
    # the type is known when the plan is made, so only one of the two remains
    return F.when(F.startswith(F.typeof(c), F.lit("decimal")), exact).otherwise(near)


def ratio(num: str | Column, den: str | Column) -> Column:
    """num / den as double, NULL when the denominator is zero or missing."""
    return F.try_divide(as_column(num).cast("double"), as_column(den).cast("double"))


def at_least(c: str | Column, floor: float) -> Column:
    """max(c, floor) that stays NULL for NULL input (``greatest`` would not)."""
    c = as_column(c).cast("double")
    return F.when(c.isNotNull(), F.greatest(c, F.lit(float(floor))))


def linspace(start: float, stop: float, count: int) -> list[float]:
    """Evenly spaced values, both ends included."""
    step = (stop - start) / (count - 1)
    return [start + i * step for i in range(count - 1)] + [stop]


def grid_position(score: str | Column, grid: Sequence[float]) -> Column:
    """How many values of an evenly spaced ascending grid are <= score.

    Arithmetic gives the cell to within one; three comparisons against the
    exact grid values settle it, so the cost does not grow with the grid.
    """
    score = as_column(score)
    n = len(grid)
    step = (grid[-1] - grid[0]) / (n - 1)
    cell = F.floor((score - F.lit(grid[0])) / F.lit(step)).cast("int")
    sure = F.greatest(F.lit(0), F.least(F.lit(n), cell - 1))
    values = F.array(*[F.lit(float(g)) for g in grid], *[F.lit(float("inf"))] * 3)
    above = sum(
        (F.element_at(values, sure + k) <= score).cast("int") for k in (1, 2, 3)
    )
    return sure + above


# -- statuses ----------------------------------------------------------------

def counts_as_sale(status: str | Column, excluded: Iterable[str]) -> Column:
    """SQL rule: an unknown (NULL) status is dropped."""
    return ~as_column(status).isin(*excluded)


def not_excluded(status: str | Column, excluded: Iterable[str]) -> Column:
    """Panel and RFM rule: an unknown (NULL) status is kept."""
    return F.coalesce(~as_column(status).isin(*excluded), F.lit(True))


# -- time --------------------------------------------------------------------

def instant(text: str) -> Column:
    """A zone-less timestamp literal (folded to a constant, so it is pushed down)."""
    return F.lit(text).cast("timestamp_ntz")


def plus_days(c: str | Column, days: int | Column) -> Column:
    days = F.lit(days) if isinstance(days, int) else days
    return as_column(c) + F.make_dt_interval(days)


def micros_between(start: str | Column, end: str | Column) -> Column:
    """Whole microseconds from start to end, on zone-less wall clocks.

    Taken from the interval's parts: ``timestampdiff`` would read both ends in
    the session time zone and lose or gain an hour across a clock change.
    """
    gap = as_column(end) - as_column(start)
    parts = {"DAY": MICROS_PER_DAY, "HOUR": 3_600_000_000, "MINUTE": 60_000_000, "SECOND": 1_000_000}
    return sum(
        (F.extract(F.lit(unit), gap) * F.lit(micros).cast("bigint")).cast("bigint")
        for unit, micros in parts.items()
    )


def days_between(start: str | Column, end: str | Column) -> Column:
    """Fractional days from start to end."""
    return micros_between(start, end) / F.lit(float(MICROS_PER_DAY))


def rounded_days(start: str | Column, end: str | Column, digits: int) -> Column:
    """Days from start to end, rounded half up on whole microseconds, as double."""
    unit = MICROS_PER_DAY // 10**digits
    return F.floor((micros_between(start, end) + unit // 2) / F.lit(unit)).cast("double") / F.lit(float(10**digits))


def hour_number(ts: str | Column) -> Column:
    """Hours since 1970 on the wall clock."""
    ts = as_column(ts)
    return F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")) * 24 + F.hour(ts)


def month_text(ts: str | Column) -> Column:
    return F.substring(as_column(ts).cast("string"), 1, 7)


def month_number(ts: str | Column) -> Column:
    """Months since year 0, so that differences are whole calendar months."""
    return F.year(as_column(ts)) * 12 + F.month(as_column(ts))


def parse_instant(c: str | Column) -> Column:
    """Text to zone-less timestamp; anything unreadable becomes NULL."""
    return as_column(c).try_cast("timestamp_ntz")


def strict_number(column: str, kind: str, required: bool = False) -> Column:
    """Text or number cast to ``kind``; other text, and digits the type cannot hold, are errors.

    NULL and blank text stay NULL, or are errors too if the value is ``required``.
    """
    text = F.trim(F.col(column).cast("string"))
    present = F.when(text != "", text)
    value = present.try_cast(kind)
    bad = value.isNull()
    if kind != "double":
        value = present.try_cast("decimal(38,18)").try_cast(kind)
        bad = value.isNull() | (value.cast("decimal(38,18)") != present.try_cast("decimal(38,18)"))
    message = F.coalesce(F.concat(F.lit(f"{column} is not a {kind}: "), text), F.lit(f"{column} is NULL"))
    checked = F.when(F.coalesce(bad, F.lit(True)), F.raise_error(message)).otherwise(value)
    return checked if required else F.when(present.isNotNull(), checked)


# -- text --------------------------------------------------------------------

def strip(c: str | Column) -> Column:
    r"""Remove every kind of leading and trailing white space (``trim`` only knows blanks)."""
    return F.regexp_replace(as_column(c), r"^\s+|\s+$", "")


def title_case(c: str | Column) -> Column:
    """Capital after every non-letter: ``sao joao d'oeste`` -> ``Sao Joao D'Oeste``."""
    runs = F.regexp_extract_all(as_column(c), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    capital = F.transform(
        runs,
        lambda w: F.concat(
            F.upper(w.substr(F.lit(1), F.lit(1))), F.lower(w.substr(F.lit(2), F.length(w)))
        ),
    )
    return F.array_join(capital, "")


def city_name(c: str | Column) -> Column:
    return title_case(strip(c))


def state_code(c: str | Column) -> Column:
    return F.upper(strip(c))


def shuffle_key(id_col: str | Column, seed: int) -> Column:
    """A repeatable pseudo-random sort key for sampling and fold assignment."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), as_column(id_col).cast("string")))
