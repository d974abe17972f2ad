"""Salary steps."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterline.schemas import STEP_RATE


def step_price(salary: Column, step: int) -> Column:
    """Salary after `step` strikes, rounded to two decimals.

    Computed in DECIMAL and widened back to DOUBLE, so a half cent rounds the same
    way everywhere and an unchanged step compares equal to its stored value.
    """
    rate = F.lit(Decimal(STEP_RATE) ** step)
    return F.round(salary.try_cast("decimal(22,6)") * rate, 2).cast("double")
