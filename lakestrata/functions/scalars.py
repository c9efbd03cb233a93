"""Scalar column functions.

All are thin compositions of built-in ``pyspark.sql.functions`` so they stay
inside whole-stage codegen. Casts use the ``try_`` family: a malformed value
becomes NULL instead of failing the job under ANSI mode.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lit_or_col(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


# F1
def parse_date(c: ColumnOrName, fmt: str = "yyyy-MM-dd") -> Column:
    """Text to date with a pattern; empty or invalid text gives NULL."""
    return F.try_to_date(_c(c), fmt)


# F2
def to_date(c: ColumnOrName) -> Column:
    return F.to_date(_c(c))


# F3
def try_int(c: ColumnOrName) -> Column:
    return _c(c).try_cast("int")


# F4
def try_double(c: ColumnOrName) -> Column:
    return _c(c).try_cast("double")


# F5
def numeric_if(c: ColumnOrName, tag: ColumnOrName, numeric_tag: str = "numeric") -> Column:
    """Cast to double only where the type tag says numeric, else NULL."""
    return F.when(_c(tag) == numeric_tag, _c(c).try_cast("double"))


# F6
def trunc_bigint(c: ColumnOrName) -> Column:
    """Truncating cast to bigint (Spark's cast semantics)."""
    return _c(c).cast("bigint")


# F7
def age_years(birth: ColumnOrName, at: ColumnOrName) -> Column:
    """Completed years between two dates: floor(months_between / 12)."""
    return F.floor(F.months_between(_c(at), _c(birth)) / 12)


# F8
def days_between(end: ColumnOrName, start: ColumnOrName) -> Column:
    return F.datediff(_c(end), _c(start))


# F9
def hours_between(later: ColumnOrName, earlier: ColumnOrName, scale: int | None = 2) -> Column:
    """Fractional hours from ``earlier`` to ``later``; rounded when ``scale``."""
    h = (F.unix_timestamp(_c(later)) - F.unix_timestamp(_c(earlier))) / 3600
    return F.round(h, scale) if scale is not None else h


# F10
def hours_whole(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole hours between two timestamps (truncated toward zero)."""
    return F.timestamp_diff("HOUR", _c(start), _c(end))


# F11
def year(c: ColumnOrName) -> Column:
    return F.year(_c(c))


# F12
def stamps(df, as_of: str | None = None, ts_col: str = "processing_timestamp", date_col: str = "processing_date"):
    """Add processing timestamp/date: ``as_of`` when given, else the clock."""
    if as_of is None:
        ts = F.current_timestamp()
        d = F.current_date()
    else:
        ts = F.lit(as_of).cast("timestamp_ntz")
        d = F.lit(as_of).cast("timestamp_ntz").cast("date")
    return df.withColumns({ts_col: ts, date_col: d})


def today(as_of: str | None = None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of).cast("timestamp_ntz").cast("date")


def now(as_of: str | None = None) -> Column:
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp_ntz")


# F13
def upper(c: ColumnOrName) -> Column:
    return F.upper(_c(c))


def lower(c: ColumnOrName) -> Column:
    return F.lower(_c(c))


# F14
def digits_only(c: ColumnOrName) -> Column:
    return F.regexp_replace(_c(c), "[^0-9]", "")


# F15
def full_name(*parts: ColumnOrName) -> Column:
    """Join name parts with single spaces, skipping NULL parts."""
    return F.concat_ws(" ", *[_c(p) for p in parts])


# F16
def contains(c: ColumnOrName, text: str) -> Column:
    return _c(c).contains(text)


# F17
def not_blank(c: ColumnOrName) -> Column:
    return _c(c).isNotNull() & (F.length(F.trim(_c(c))) > 0)


# F18
def round_to(c: ColumnOrName, n: int) -> Column:
    return F.round(_c(c), n)


# F19
def floor(c: ColumnOrName) -> Column:
    return F.floor(_c(c))


# F20
def is_null(c: ColumnOrName) -> Column:
    return _c(c).isNull()


def not_null(c: ColumnOrName) -> Column:
    return _c(c).isNotNull()


# F21
def all_of(conds: Iterable[Column]) -> Column:
    conds = list(conds)
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def any_of(conds: Iterable[Column]) -> Column:
    conds = list(conds)
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out


# F22
def date_in_range(c: ColumnOrName, low, high) -> Column:
    """``low <= c <= high``; bounds are literals or columns."""
    return (_c(c) >= _lit_or_col(low)) & (_c(c) <= _lit_or_col(high))


# F23
def flag(cond: Column, as_int: bool = True) -> Column:
    """0/1 (or false/true) flag; a NULL condition gives 0 / false."""
    return F.when(cond, F.lit(1 if as_int else True)).otherwise(F.lit(0 if as_int else False))


# P8
def case_when(branches: Sequence[tuple[Column, object]], default=None) -> Column:
    """First-match multi-branch classification with a default."""
    out = None
    for cond, value in branches:
        v = _lit_or_col(value)
        out = F.when(cond, v) if out is None else out.when(cond, v)
    if default is not None:
        out = out.otherwise(_lit_or_col(default))
    return out


def ratio(num: ColumnOrName, den: ColumnOrName, scale: int | None = None, factor: float | None = None) -> Column:
    """``round(num / den * factor, scale)``; zero or NULL denominator gives NULL."""
    r = F.try_divide(_c(num).cast("double"), _c(den).cast("double"))
    if factor is not None:
        r = r * F.lit(float(factor))
    return F.round(r, scale) if scale is not None else r


EXACT = "decimal(38,9)"


def exact_mean(c: ColumnOrName) -> Column:
    """Mean of the values taken to 9 decimals, summed exactly (decimal)."""
    return F.avg(_c(c).cast(EXACT))


def exact_avg(c: ColumnOrName, scale: int | None = None) -> Column:
    """Mean summed in decimal(38,9): exact and independent of partition order.

    A double sum depends on the order rows are added, so a rounded mean at a
    .5 tie can flip between runs; the decimal sum cannot. Returns a double.
    """
    m = exact_mean(c)
    if scale is not None:
        m = F.round(m, scale)
    return m.cast("double")


def exact_sum(c: ColumnOrName) -> Column:
    """Sum in decimal(38,9) (order independent), returned as double."""
    return F.sum(_c(c).cast(EXACT)).cast("double")
