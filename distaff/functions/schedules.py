"""Learning-rate schedules as expressions of the step column."""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _progress(step: Column, warmup: int, total: int) -> Column:
    return (step - F.lit(warmup)) / F.lit(float(max(1, total - warmup)))


def linear_rate(step: Column, peak: float, warmup: int, total: int) -> Column:
    """Rise to ``peak`` over ``warmup`` steps, then fall linearly to 0."""
    rising = step / F.lit(float(max(1, warmup)))
    falling = F.greatest(F.lit(0.0), F.lit(1.0) - _progress(step, warmup, total))
    return F.lit(peak) * F.when(step < warmup, rising).otherwise(falling)


def cosine_rate(step: Column, peak: float, warmup: int, total: int) -> Column:
    """Rise to ``peak`` over ``warmup`` steps, then a half cosine."""
    rising = step / F.lit(float(max(1, warmup)))
    falling = (F.cos(F.lit(math.pi) * _progress(step, warmup, total)) + 1.0) * 0.5
    return F.lit(peak) * F.when(step < warmup, rising).otherwise(falling)


SCHEDULES = {"linear": linear_rate, "cosine": cosine_rate}
