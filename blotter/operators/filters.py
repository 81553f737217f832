"""Row filters, the map view, search and scoring requests."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from blotter import schemas


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with a value in every given column."""
    return df.dropna(subset=list(columns))


def nonzero_position(df: DataFrame) -> DataFrame:
    """Rows whose latitude, longitude and precinct are all non-zero."""
    return df.where(
        (F.col("latitude") != 0) & (F.col("longitude") != 0) & (F.col("addr_pct_cd") != 0)
    )


def plottable(df: DataFrame) -> DataFrame:
    """Rows whose coordinates are set, numbers and not zero."""
    def usable(name: str) -> Column:
        return F.col(name).isNotNull() & ~F.isnan(name) & (F.col(name) != 0)

    return df.where(usable("latitude") & usable("longitude"))


def map_records(df: DataFrame) -> DataFrame:
    """The seven map columns, coordinates as numbers and the date as a date."""
    kinds = {"latitude": "double", "longitude": "double", "cmplnt_fr_dt": "date"}
    return df.select(
        *(
            F.col(c).try_cast(kinds[c]).alias(c) if c in kinds else F.col(c)
            for c in schemas.MAP_COLUMNS
        )
    )


def search(
    df: DataFrame, column: str, term: str, min_length: int = schemas.SEARCH_MIN
) -> DataFrame:
    """Rows whose column contains the upper-cased term; ``All`` looks into every one.

    A term shorter than ``min_length`` leaves the data as it is. ``%`` and ``_`` in the
    term keep their LIKE meaning; a backslash is a plain character.
    """
    if len(term) < min_length:
        return df
    if column != "All" and column not in schemas.SEARCH_COLUMNS:
        raise ValueError(f"cannot search {column!r}")
    names = schemas.SEARCH_COLUMNS if column == "All" else [column]
    pattern = "%{}%".format(term.upper().replace("\\", "\\\\"))
    hits = (F.coalesce(F.col(c).cast("string").like(pattern), F.lit(False)) for c in names)
    return df.where(reduce(or_, hits))


def check_request(df: DataFrame) -> DataFrame:
    """Add ``reason``: the first required field a scoring request lacks, else null."""
    for name in schemas.REQUEST_FIELDS:
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast("string"))
    lacking = [
        F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in schemas.REQUEST_FIELDS
    ]
    return df.withColumn("reason", F.coalesce(*lacking))


def split_requests(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Scoring requests as accepted rows and rejected rows with a reason."""
    checked = check_request(df)
    accepted = checked.where(F.col("reason").isNull()).drop("reason")
    return accepted, checked.where(F.col("reason").isNotNull())


def normalise_request(df: DataFrame) -> DataFrame:
    """Scoring requests from (boro_nm, asked_at, latitude, longitude[, addr_pct_cd]).

    The borough is upper-cased, the moment split into date and minute, and a missing
    precinct replaced by the default one.
    """
    precinct = (
        F.col("addr_pct_cd").cast("string")
        if "addr_pct_cd" in df.columns
        else F.lit(None).cast("string")
    )
    return df.select(
        *(c for c in df.columns if c not in {*schemas.REQUEST_FIELDS, "asked_at"}),
        F.coalesce(precinct, F.lit(schemas.DEFAULT_PRECINCT)).alias("addr_pct_cd"),
        F.upper("boro_nm").alias("boro_nm"),
        F.date_format("asked_at", "yyyy-MM-dd").alias("cmplnt_fr_dt"),
        F.date_format("asked_at", "HH:mm:00").alias("cmplnt_fr_tm"),
        F.col("latitude"),
        F.col("longitude"),
    )
