"""Risk bands over scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper limits of the low and the medium band.
RANK_BANDS = (1 / 3, 2 / 3)
REDUCTION_BANDS = {2030: (1 / 9, 1 / 3), 2050: (2 / 9, 2 / 3)}


def risk_band(score: Column, limits: tuple[float, float], null_band: str | None = None) -> Column:
    """``low``, ``medium`` or ``high``; a null score gets ``null_band``."""
    low, medium = limits
    return (
        F.when(score.isNull(), F.lit(null_band).cast("string"))
        .when(score <= low, F.lit("low"))
        .when(score <= medium, F.lit("medium"))
        .otherwise(F.lit("high"))
    )


def clamp_unit(score: Column) -> Column:
    """Limit a score to [0, 1]; null stays null."""
    return F.when(score.isNotNull(), F.greatest(F.least(score, F.lit(1.0)), F.lit(0.0)))
