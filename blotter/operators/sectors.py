"""Sectors: distinct positions, centroids and the forecast grid."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, functions as F

from blotter.functions.clock import day_slots
from blotter.operators.filters import nonzero_position, require

POSITION = ["latitude", "longitude", "addr_pct_cd", "boro_nm"]


def distinct_positions(df: DataFrame) -> DataFrame:
    """Distinct positions that have coordinates and a precinct."""
    return require(df, ["latitude", "longitude", "addr_pct_cd"]).select(*POSITION).distinct()


def sector_centroids(positions: DataFrame) -> DataFrame:
    """Mean position per precinct and borough; rows without a borough belong to none."""
    usable = nonzero_position(require(positions, POSITION))
    return usable.groupBy("addr_pct_cd", "boro_nm").agg(
        F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude")
    )


def forecast_grid(sectors: DataFrame, day: datetime.date | Column | None = None) -> DataFrame:
    """Every sector with every slot of ``day`` (today by default).

    The slots are a constant array unfolded next to each sector, so no join is needed.
    """
    if not isinstance(day, Column):
        day = F.current_date() if day is None else F.lit(day)
    return sectors.select(
        F.col("addr_pct_cd").cast("string").alias("addr_pct_cd"),
        "boro_nm",
        day.cast("date").alias("cmplnt_fr_dt"),
        F.explode(day_slots()).alias("cmplnt_fr_tm"),
        "latitude",
        "longitude",
    )
