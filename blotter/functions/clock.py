"""Dates, times of day, cyclic encodings and day slots."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from blotter import schemas

DAY_MINUTES = 24 * 60


def parse_date(column: Column) -> Column:
    """Date of a text or timestamp; null when it is none."""
    return column.try_cast("date")


def hour_of(column: Column) -> Column:
    """Hour of a time of day written H:M:S; null when it is none."""
    return F.hour(F.try_to_timestamp(column, F.lit("H:m:s")))


def day_slots(minutes: int = schemas.SLOT_MINUTES) -> Column:
    """The starts of the slots of a day, as an array of HH:mm:ss texts."""
    starts = F.sequence(F.lit(0), F.lit(DAY_MINUTES - minutes), F.lit(minutes))

    def clock(minute: Column) -> Column:
        return F.format_string("%02d:%02d:00", (minute / 60).cast("int"), minute % 60)

    return F.transform(starts, clock)


def time_features(df: DataFrame, date: str = "cmplnt_fr_dt", time: str = "cmplnt_fr_tm") -> DataFrame:
    """Add ``hour``, ``month`` and ``wday`` (Monday is 0); null where unparsable."""
    day = parse_date(F.col(date))
    return df.withColumns(
        {"hour": hour_of(F.col(time)), "month": F.month(day), "wday": F.weekday(day)}
    )


def cyclic_features(df: DataFrame) -> DataFrame:
    """Add sine and cosine of the hour over 24 and of the weekday over 7."""
    def angle(name: str, period: int) -> Column:
        return F.col(name) * F.lit(2 * math.pi) / F.lit(period)

    return df.withColumns(
        {
            "h_sin": F.sin(angle("hour", 24)),
            "h_cos": F.cos(angle("hour", 24)),
            "w_sin": F.sin(angle("wday", 7)),
            "w_cos": F.cos(angle("wday", 7)),
        }
    )
