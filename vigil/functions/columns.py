"""Column expressions shared by the operators (all JVM-side, codegen'd)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigil.config import FLAG_THRESHOLD, PSI_MODERATE, PSI_SIGNIFICANT


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def micros(ts) -> Column:
    """Epoch microseconds; all time arithmetic is done on these longs."""
    return F.unix_micros(_c(ts).cast("timestamp"))


def safe_div(num, den, default=0.0) -> Column:
    """num/den, ``default`` when den is 0 (ANSI mode raises on /0)."""
    return F.coalesce(F.try_divide(_c(num), _c(den)), F.lit(default))


def psi_band(psi, moderate: float = PSI_MODERATE, significant: float = PSI_SIGNIFICANT) -> Column:
    p = _c(psi)
    return (F.when(p < moderate, "stable")
             .when(p < significant, "moderate_shift")
             .otherwise("significant_shift"))


def flag(score, threshold: float = FLAG_THRESHOLD) -> Column:
    """Score >= threshold, unrounded."""
    return (_c(score) >= F.lit(threshold)).cast("int")


def round_half_even(x, scale: int) -> Column:
    return F.bround(_c(x), scale)
