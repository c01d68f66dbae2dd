"""Column expressions used by the statistics jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Quartile cut points of the frequency class, high to low.
FREQUENCY_QUANTILES = [0.75, 0.5, 0.25]


def frequency_class_expr(ct: Column, cuts: Column) -> Column:
    """Class 4..1 by strict ``>`` against the 0.75 / 0.5 / 0.25 cut points (an array)."""
    return (F.when(ct > cuts[0], 4).when(ct > cuts[1], 3).when(ct > cuts[2], 2)
            .otherwise(1))
