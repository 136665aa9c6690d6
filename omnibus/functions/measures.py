"""Aggregate expressions shared by the gold views."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from omnibus import params


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole in decimal arithmetic; NULL when whole is 0."""
    return F.lit(Decimal("100.0")) * part / F.nullif(whole, F.lit(0))


def is_stopped(speed: Column) -> Column:
    return speed < params.MOVING_SPEED_KMH


def moving_speed(speed: Column) -> Column:
    """The speed when it is in the moving band, else NULL."""
    return F.when((speed > params.MOVING_SPEED_KMH) & (speed <= params.MAX_SPEED_KMH), speed)


def weather_label(code: Column, table=params.WEATHER_LABELS) -> Column:
    (lo, hi, label), *rest = table
    named = F.when(code.between(lo, hi), label)
    for lo, hi, label in rest:
        named = named.when(code.between(lo, hi), label)
    return named


def code_title(code: Column) -> Column:
    """BUS_DELAY -> Bus Delay, for pick lists."""
    return F.initcap(F.replace(code, F.lit("_"), F.lit(" ")))
