"""Exact money arithmetic.

Many revenues end exactly in half a cent, so binary floats would decide their rounding by noise; wide
decimals are exact but cost an object per row. A line with two-decimal price and discount percentage, the
usual case, is a whole number of millionths in a bigint. Up to six decimals of the price and four of
the percentage take the way through a decimal; more raise an error, as does a line of nine trillion
units or more. To be summed, a line is split into whole units, millionths and the rest in units
of 1e-12, and a sum of units that leaves a bigint raises, with ANSI mode on or off. Totals are
decimals, and only the rounded result is a double.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AMOUNTS = ["units", "millionths", "rest"]

_PRICE, _DISCOUNT = "CAST(unit_price AS DOUBLE)", "CAST(discount_percent AS DOUBLE)"
# Two-decimal numbers up to 10^13 keep their hundredths exactly through a double.
_PLAIN = f"({_PRICE} = rint({_PRICE} * 100) / 100 AND {_DISCOUNT} = rint({_DISCOUNT} * 100) / 100)"
_MILLIONTHS = (
    f"(quantity * CAST(rint({_PRICE} * 100) AS BIGINT) * (10000 - CAST(rint({_DISCOUNT} * 100) AS BIGINT)))"
)
_FINE_PRICE, _FINE_DISCOUNT = "CAST(unit_price AS DECIMAL(16,6))", "CAST(discount_percent AS DECIMAL(9,4))"
# A hundred times the line.
_FINE = f"(CAST(quantity AS DECIMAL(10,0)) * {_FINE_PRICE} * (CAST(100 AS DECIMAL(3,0)) - {_FINE_DISCOUNT}))"
_KEPT = f"(CAST({_FINE_PRICE} AS DOUBLE) = {_PRICE} AND CAST({_FINE_DISCOUNT} AS DOUBLE) = {_DISCOUNT})"


def _raised(message: str) -> str:
    return f"CAST(raise_error('{message}') AS BIGINT)"


def _part(plain: str, fine: str) -> str:
    # The check of the size does not leave an overflow to ANSI mode.
    return (
        f"CASE WHEN abs(CAST(quantity AS DOUBLE) * {_PRICE} * (100 - {_DISCOUNT})) >= 9e14"
        f" THEN {_raised('overflow in the revenue of a line')}"
        f" WHEN {_PLAIN} THEN {plain}"
        f" WHEN NOT {_KEPT} THEN {_raised('more decimals in a price or discount than are kept')}"
        f" ELSE {fine} END"
    )


# Through the decimal: 10^-10 of a hundredth is 10^-12 of a unit.
PARTS = {
    "units": _part(f"{_MILLIONTHS} div 1000000", f"{_FINE} div 100"),
    "millionths": _part(f"{_MILLIONTHS} % 1000000", f"CAST(({_FINE} % 100) * 10000 AS BIGINT)"),
    "rest": _part("0L", f"CAST(((({_FINE} % 100) * 10000) % 1) * 1000000 AS BIGINT)"),
}


_TOO_LARGE = (
    f"abs(CAST(quantity AS DOUBLE) * {_PRICE} * (100 - {_DISCOUNT})) >= 9e14"
    f" THEN {_raised('overflow in the revenue of a line')}"
)
# A line as one number: of millionths if it is plain, else the hundredfold decimal.
_LINE = {
    "__plain": f"CASE WHEN {_TOO_LARGE} WHEN {_PLAIN} THEN {_MILLIONTHS} END",
    "__fine": f"CASE WHEN {_PLAIN} THEN NULL"
    f" WHEN NOT {_KEPT} THEN raise_error('more decimals in a price or discount than are kept')"
    f" ELSE {_FINE} END",
}
_OF_LINE = {
    "units": ("__plain div 1000000", "__fine div 100"),
    "millionths": ("__plain % 1000000", "CAST((__fine % 100) * 10000 AS BIGINT)"),
    "rest": ("__plain - __plain", "CAST((((__fine % 100) * 10000) % 1) * 1000000 AS BIGINT)"),
}


def with_amounts(items: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep``, and ``quantity * unit_price * (1 - discount_percent / 100)`` as
    ``units``, ``millionths`` and ``rest``; all are NULL if a factor is, and sums skip them. The line is
    computed once, its parts from it."""
    lines = items.select(*keep, *(F.expr(line).alias(name) for name, line in _LINE.items()))
    parts = ((n, f"CASE WHEN __fine IS NULL THEN {plain} ELSE {fine} END") for n, (plain, fine) in _OF_LINE.items())
    return lines.select(*keep, *(F.expr(part).alias(name) for name, part in parts))


def amounts_sql(table: str, *keep: str) -> str:
    """``with_amounts`` of a table as a query."""
    lines = ", ".join([*keep, *(f"{line} AS {name}" for name, line in _LINE.items())])
    parts = [f"CASE WHEN __fine IS NULL THEN {plain} ELSE {fine} END AS {n}" for n, (plain, fine) in _OF_LINE.items()]
    return f"SELECT {', '.join([*keep, *parts])} FROM (SELECT {lines} FROM {table})"


def _joined(units: Column, millionths: Column, rest: Column) -> Column:
    whole = units.cast("decimal(20,0)") + millionths.cast("decimal(20,0)") * F.expr("0.000001")
    return (whole + rest.cast("decimal(20,0)") * F.expr("0.000000000001")).cast("decimal(38,12)")


def line_revenue() -> Column:
    """Revenue of one item as an exact decimal."""
    return _joined(*(F.expr(PARTS[name]) for name in AMOUNTS))


def whole_sum(name: str) -> Column:
    """The sum of a bigint column; one that does not fit raises, whatever ANSI mode says."""
    lost = (F.count(name) > 0) & F.try_sum(name).isNull()
    return F.when(lost, F.expr(_raised("overflow in a sum"))).otherwise(F.try_sum(name))


def total_revenue() -> Column:
    """Aggregate of the three amounts: their exact total."""
    return _joined(*map(whole_sum, AMOUNTS))


def money(amount: Column) -> Column:
    """Round an exact amount to cents, half away from zero."""
    return F.round(amount, 2).cast("double")


def ratio2(x: Column) -> Column:
    """Round a double ratio or percentage to two decimals, half away from zero."""
    return F.round(x.cast("decimal(28,8)"), 2).cast("double")


def percent_of(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` rounded; NULL when ``whole`` is zero or NULL."""
    whole = whole.cast("double")
    return ratio2(part.cast("double") / F.nullif(whole, F.lit(0.0)) * 100)


def percent_change(current: Column, previous: Column) -> Column:
    """Change against ``previous``; from zero it is 100 if anything came in, else 0."""
    current, previous = current.cast("double"), previous.cast("double")
    growth = ratio2((current - previous) / F.nullif(previous, F.lit(0.0)) * 100)
    from_zero = F.when(current > 0, 100.0).otherwise(0.0)
    return F.when(previous == 0, from_zero).otherwise(growth)
