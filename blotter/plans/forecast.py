"""The daily forecast: every sector and slot of a day, scored in one plan."""

from __future__ import annotations

import datetime
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, functions as F

from blotter import schemas
from blotter.operators.keys import already_done
from blotter.operators.sectors import distinct_positions, forecast_grid, sector_centroids
from blotter.plans.model import Classifier, score_batch
from blotter.sources.tables import Table, append, ensure_table, read_table


def daily_forecast(
    incidents: DataFrame, classifier: Classifier, day: datetime.date | None = None
) -> DataFrame:
    """Forecast rows of one day in the columns of the forecast table."""
    sectors = sector_centroids(distinct_positions(incidents))
    # Few sectors give many rows: spread the unfolded grid before it is scored.
    grid = forecast_grid(sectors, day).repartition("addr_pct_cd", "boro_nm", "cmplnt_fr_tm")
    scored = score_batch(classifier, grid)
    place = F.concat_ws("|", "addr_pct_cd", "boro_nm", "cmplnt_fr_dt", "cmplnt_fr_tm")
    return scored.select(
        F.sha2(place, 256).alias("id"),
        "latitude",
        "longitude",
        "addr_pct_cd",
        "boro_nm",
        F.col("cmplnt_fr_dt").alias("prediction_date"),
        F.col("cmplnt_fr_tm").alias("prediction_time"),
        "prediction",
        "probability",
    )


def write_forecasts(df: DataFrame, table: Table) -> None:
    """Append forecast rows, all or none; a missing or overlong value fails the write."""
    complete = (F.col(c).isNotNull() for c in schemas.FORECASTS.names)
    fitting = (F.length(c) <= n for c, n in schemas.FORECAST_WIDTHS.items())
    valid = reduce(and_, [*complete, *fitting])
    checked = df.select(schemas.FORECASTS.names).where(
        F.assert_true(F.coalesce(valid, F.lit(False)), "forecast row breaks the table's rules").isNull()
    )
    append(checked, table)


def forecast_and_store(
    spark: SparkSession,
    incidents: Table,
    classifier: Classifier,
    forecasts: Table,
    day: datetime.date,
) -> bool:
    """Fill the forecast table for ``day`` unless it already has rows for it."""
    ensure_table(spark, forecasts, schemas.FORECASTS)
    if already_done(read_table(spark, forecasts), "prediction_date", day):
        return False
    write_forecasts(daily_forecast(read_table(spark, incidents), classifier, day), forecasts)
    return True
