"""Money, averages and percentages in whole numbers.

Sums of doubles depend on the order in which tasks finish, and on billions of rows the error reaches
the cents.  So amounts are counted in 1/10,000 (digits beyond are rounded off each amount), added up as
decimals, the same on every run, and rounded half away from zero by integer division.  The readers reject
records with an amount of ``OVERSIZE`` or more; totals may reach 9.2e16.
"""

from __future__ import annotations

UNITS = 10_000
OVERSIZE = 100_000_000_000_000  # 1e14


def units(amount: str) -> str:
    """Amount as whole ten-thousandths; NULL and NaN give NULL."""
    return f"CAST(rint(nanvl({amount}, CAST(NULL AS DOUBLE)) * {UNITS}D) AS BIGINT)"


def sum_units(amount: str) -> str:
    """Total of an amount in units."""
    return total(units(amount))


def total(whole: str) -> str:
    """Sum of whole numbers, with room for any number of rows."""
    return f"sum(CAST({whole} AS DECIMAL(20, 0)))"


def round_div(num: str, den: str | int) -> str:
    """``num / den`` to the nearest whole number, halves away from zero; NULL when ``den`` is 0."""
    return (
        f"(CASE WHEN {num} < 0 THEN -1L ELSE 1L END"
        f" * ((abs({num}) * 2 + {den}) div nullif({den} * 2, 0)))"
    )


def money(total_units: str) -> str:
    """Total in units → amount with two decimals."""
    return f"({round_div(total_units, UNITS // 100)} / 100D)"


def mean_money(total_units: str, n: str) -> str:
    """Total in units over ``n`` → mean amount with two decimals."""
    return f"({round_div(total_units, f'({n} * {UNITS // 100}L)')} / 100D)"


def mean_2dp(total: str, n: str) -> str:
    """Mean of whole numbers with two decimals."""
    return f"({round_div(f'({total} * 100L)', n)} / 100D)"


def mean_1dp(total: str, n: str) -> str:
    """Mean of whole numbers with one decimal."""
    return f"({round_div(f'({total} * 10L)', n)} / 10D)"


def percent(part: str, whole: str) -> str:
    """``part`` as a percentage of ``whole`` with one decimal; NULL when ``whole`` is 0."""
    return f"({round_div(f'({part} * 1000L)', whole)} / 10D)"
