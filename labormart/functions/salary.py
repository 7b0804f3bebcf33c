"""Salary arithmetic in exact decimals.

Per vacancy: each bound in the home currency, rounded to cents, then the
midpoint ``(low + high) * 0.5`` rounded to cents. ``* 0.5`` keeps the
expression in DECIMAL (a ``/ 2`` would be exact too in Spark, but the oracle
engine turns ``/`` into DOUBLE). Averages widen to scale 12 first so that a
single final rounding gives the correct half-up cent.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from labormart.semantics import Semantics


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def money(col: Column | str, precision: int = 18) -> Column:
    return _c(col).cast(f"decimal({precision},2)")


def _convert(amount: Column, rate: Column, nominal: Column, sem: Semantics) -> Column:
    product = amount * rate
    if sem.use_nominal:
        product = product / nominal
    return product


def salary_midpoint(
    currency: Column | str,
    salary_from: Column | str,
    salary_to: Column | str,
    rate: Column | str,
    nominal: Column | str,
    sem: Semantics,
) -> Column:
    """Midpoint of the salary band in the home currency, or NULL.

    Home currency: ``coalesce(from, to)`` / ``coalesce(to, from)``. Other
    currency: both bounds multiplied by the rate (and divided by the nominal
    when ``sem.use_nominal``). Unknown rate or NULL currency gives NULL.
    """
    cur, lo, hi = _c(currency), _c(salary_from), _c(salary_to)
    r, nom = _c(rate), _c(nominal)
    t = sem.money_type
    is_home = cur.isin(*sem.home_codes)
    low = F.when(is_home, F.coalesce(lo, hi)).when(
        ~is_home, F.coalesce(_convert(lo, r, nom, sem), _convert(hi, r, nom, sem))
    )
    high = F.when(is_home, F.coalesce(hi, lo)).when(
        ~is_home, F.coalesce(_convert(hi, r, nom, sem), _convert(lo, r, nom, sem))
    )
    return ((low.cast(t) + high.cast(t)) * F.lit(0.5).cast("decimal(1,1)")).cast(t)


def exact_avg(col: Column | str, precision: int = 10) -> Column:
    """``avg(x)::numeric(p,2)``: widen, average, round once (half away from zero)."""
    return F.avg(_c(col).cast("decimal(28,12)")).cast(f"decimal({precision},2)")
