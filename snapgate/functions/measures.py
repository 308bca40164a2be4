"""Percentage changes and severity levels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def pct_change(current: Column, previous: Column) -> Column:
    """``|current - previous| / previous * 100``; NULL without a non-zero previous value."""
    return F.when(previous != 0, F.abs(current - previous) / previous * 100)


def pct_drift(current: Column, baseline: Column, zero_baseline: str = "ignore",
              denominator: str = "signed") -> Column:
    """Drift of ``current`` against ``baseline`` in percent.

    A zero baseline gives 0 (``ignore``) or, with ``critical``, infinity when the current
    value differs. The signed denominator makes drift against a negative baseline negative,
    hence never flagged; ``abs`` measures its size instead.
    """
    current, baseline = F.nanvl(current, F.lit(None)), F.nanvl(baseline, F.lit(None))
    base = F.abs(baseline) if denominator == "abs" else baseline
    on_zero = F.lit(0.0)
    if zero_baseline == "critical":
        on_zero = F.when(current != 0, F.lit(float("inf"))).otherwise(on_zero)
    return F.when(baseline == 0, on_zero).otherwise(F.abs(current - baseline) / base * 100)


def severity(pct: Column, warn_at: float, critical_at: float) -> Column:
    """Inclusive limits; an unknown (NULL) percentage is INFO."""
    return (F.when(pct >= critical_at, "CRITICAL")
            .when(pct >= warn_at, "WARN")
            .otherwise("INFO"))


def two_places(value: Column) -> Column:
    """Two decimal places, halves to even, as metric records state percentages."""
    return F.bround(value, 2)
