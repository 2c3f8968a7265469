"""Scalar calculations shared by the layers. All of them are built-in Spark expressions."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

def col(c: str | Column) -> Column:
    """A column from a name, or the column itself."""
    return F.col(c) if isinstance(c, str) else c


def units(c: str | Column, digits: int = 2) -> Column:
    """A double that holds ``digits`` decimals, as a whole number of its smallest units.

    Arithmetic on whole numbers is exact, and the conversion is much cheaper than that of a double
    to a decimal, which goes through text.
    """
    return F.floor(col(c) * 10**digits + F.lit(0.5))


def sum_units(c: Column) -> Column:
    """Exact sum of whole numbers in any order of the rows, also where it exceeds 64 bits.

    High and low bits are summed as 64-bit numbers and put together as a decimal once per group,
    which spares a decimal addition per row.
    """
    high = F.sum(F.shiftright(c, 24)).cast("decimal(38,0)")
    low = F.sum(c.bitwiseAND(F.lit(2**24 - 1)))
    return high * F.lit(Decimal(2**24)) + low


def from_units(c: str | Column, digits: int) -> Column:
    """Exact decimal amount from a sum of smallest units."""
    step = F.lit(Decimal(1).scaleb(-digits))
    return (col(c).cast("decimal(38,0)") * step).cast(f"decimal({26 + digits},{digits})")


def flag(condition: Column) -> Column:
    """``CASE WHEN condition THEN true ELSE false END``: an unknown condition is false."""
    return F.coalesce(condition, F.lit(False))


def categorize(c: str | Column, mapping: Mapping[str, str], default: str | None = None) -> Column:
    """Searched CASE from a small mapping of literals."""
    value = col(c)
    out = None
    for key, label in mapping.items():
        out = F.when(value == key, label) if out is None else out.when(value == key, label)
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)


def age_years(at: str | Column, born: str | Column) -> Column:
    """Whole years between two dates, at 365.25 days a year, truncated."""
    return (F.datediff(col(at), col(born)) / F.lit(Decimal("365.25"))).cast("int")


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """Quotient as double, NULL where the denominator is zero (ANSI mode raises otherwise)."""
    return F.try_divide(col(numerator).cast("double"), col(denominator).cast("double"))


def guarded_rate(part: str | Column, whole: str | Column, digits: int = 3) -> Column:
    """``ROUND(part / NULLIF(whole, 0), digits)``."""
    return F.round(col(part).cast("double") / F.nullif(col(whole), F.lit(0)), digits)


def quarter_num(c: str | Column) -> Column:
    return F.quarter(col(c))


def year_num(c: str | Column) -> Column:
    return F.year(col(c))


def month_start(c: str | Column) -> Column:
    return F.trunc(col(c), "MM").cast("date")


def month_offset(c: str | Column, anchor: str | Column) -> Column:
    """Calendar months from the anchor's month to the date's month."""
    return (
        F.month(col(c)) - F.month(col(anchor))
        + 12 * (F.year(col(c)) - F.year(col(anchor)))
    )


def growth_pct(value: str | Column, previous: str | Column, digits: int = 2) -> Column:
    """Percent growth over the predecessor; 0 where there is none or it is not positive.

    The difference is taken in the type of the amounts, the quotient in double: a quotient of
    wide decimals would be cut to a few digits.
    """
    value, previous = col(value), col(previous)
    quotient = (value - previous).cast("double") / previous.cast("double")
    return F.when(previous > 0, F.round(quotient * 100, digits)).otherwise(F.lit(0.0))


def lifecycle_status(
    milestone: str | Column, as_of: date | str | Column, months: int = 12
) -> Column:
    """``active`` when the milestone lies within ``months`` of ``as_of``, else ``lapsed``.

    An entity without the milestone is ``lapsed``. ``as_of`` is explicit so that a rerun gives
    the same answer.
    """
    day = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")
    recent = col(milestone) >= F.add_months(day, -months)
    return F.when(recent, F.lit("active")).otherwise(F.lit("lapsed"))
