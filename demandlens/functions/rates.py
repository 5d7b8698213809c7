"""Shares, changes and the labels put on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from demandlens import rules


def round1(c: Column) -> Column:
    """One decimal, ties to the even digit."""
    return F.bround(c, 1)


def share_pct(part: Column, total: Column) -> Column:
    """``100 * part / total``, 0 where there is nothing to divide by."""
    return F.when(total > 0, F.lit(100.0) * part / total).otherwise(F.lit(0.0))


def change_pct(current: Column, prior: Column) -> Column:
    """Rounded percent change, NULL without a non-zero prior value."""
    return F.when(prior != 0, round1(F.lit(100.0) * (current - prior) / prior))


def trend_label(delta_pp: Column) -> Column:
    return (
        F.when(delta_pp >= rules.TRENDING_FROM_PP, "trending")
        .when(delta_pp <= rules.DECLINING_TO_PP, "declining")
        .otherwise("stable")
    )


def demand_badge(pct: Column) -> Column:
    return (
        F.when(pct >= rules.HIGH_DEMAND_PCT, "High")
        .when(pct >= rules.MEDIUM_DEMAND_PCT, "Medium")
        .otherwise("Low")
    )
