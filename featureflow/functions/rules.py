"""Threshold and ratio rules over metric rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Decision thresholds and the number of steps of the class bar.
BALANCED_RATIO = 0.8
VARIANCE_REACHED = 0.8
SUCCESS_VARIANCE = 0.8
SUCCESS_RATIO = 0.7
BAR_STEPS = 25


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives null instead of raising on an empty or zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def reduction_factor(d: Column, k: Column) -> Column:
    return ratio(d, k)


def percent_reduction(initial: Column, final: Column) -> Column:
    return ratio((initial - final) * F.lit(100.0), initial)


def balance_verdict(balance: Column) -> Column:
    return F.when(balance > BALANCED_RATIO, "balanced").otherwise("unbalanced")


def variance_verdict(variance: Column) -> Column:
    return F.when(variance > VARIANCE_REACHED, "reached").otherwise("not reached")


def overall_verdict(variance: Column, balance: Column) -> Column:
    success = (variance > SUCCESS_VARIANCE) & (balance > SUCCESS_RATIO)
    return F.when(success, "success").otherwise("partial success")


def bar_steps(n: Column, largest: Column) -> Column:
    """Length 0 .. 25 of the class bar: share of the largest class in 25 steps, rounded down."""
    return F.floor(ratio(n, largest) * BAR_STEPS).cast("int")
