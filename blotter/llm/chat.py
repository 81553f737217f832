"""Dialogues rendered once from the view of every participant."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from blotter.operators.joins import lookup
from blotter.session import materialise

TURNS_PER_PART = 64
#: Characters of a text that the ranges of crowded turns are cut by.
RANGE_CHARS = 64


def _sliced(turns: DataFrame, slice_turns: int) -> DataFrame:
    """``turns`` (conv_id, part, turn, role, text) with ``slice``: the place of a turn among
    the different ones of its part, by turn, role and text, in steps of ``slice_turns``.

    Only parts with more rows than that are looked into. Their different turns are sorted in
    ranges; a turn's place is its place in its range plus the turns in the ranges before it,
    less those before its part, so a part of any size is spread over the tasks.
    """
    key = F.to_json(F.struct("conv_id", "part")).alias("_key")  # parts without number are equal
    crowded = materialise(
        turns.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > slice_turns).select("_key", F.lit(True).alias("_crowded"))
    )
    whole = turns.withColumn("slice", F.lit(0).cast("bigint"))
    if crowded.isEmpty():
        return whole
    marked = lookup(turns.select("*", key), crowded, ["_key"])
    few = marked.where("_crowded is null").drop("_crowded", "_key")
    order = ["conv_id", "part", "turn", "role"]
    placed = materialise(
        marked.where("_crowded").drop("_crowded").distinct()
        .repartitionByRange(*order, F.left("text", F.lit(RANGE_CHARS)))
        .sortWithinPartitions(*order, "text")
        .withColumn("_range", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range: bounded by the number of shuffle partitions.
    starts = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows")).select(
        "_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    placed = placed.join(F.broadcast(starts), "_range").withColumn(
        "_at", F.col("_start") + F.col("_place")
    )
    firsts = materialise(placed.groupBy("_key").agg(F.min("_at").alias("_first")))
    many = lookup(placed, firsts, ["_key"]).withColumn(
        "slice", F.floor((F.col("_at") - F.col("_first")) / slice_turns)
    )
    return few.withColumn("slice", F.lit(0).cast("bigint")).unionByName(many.select(*whole.columns))


def rotate_perspectives(turns: DataFrame, part_turns: int = TURNS_PER_PART) -> DataFrame:
    """Render ``turns`` (conv_id, turn, role, text) for every participant of a dialogue.

    The participant speaks as ``assistant``, everyone else as a named user. ``mask`` lists
    the character spans ``start-end`` of the rendered text, comma-joined, that the
    participant wrote (end marker included): the spans to learn from.

    A dialogue is rendered in parts of ``part_turns`` turn numbers (64: 0 to 63 and so
    on). A part with more turns than that, as many have one number or none, comes in slices
    of ``part_turns`` turns, so one with any number of turns meets no task as a whole; the
    slices of the parts of a perspective, in order, are its text. Most dialogues have one
    part with one slice.

    Returns conv_id, participant, part, slice (from 0), n_turns, n_own (turns of the
    participant), rendered, mask. Turns come by number, then role and text; a null turn is
    in part null, before the others. Equal rows (all four columns) are one turn. A null role
    is ``unknown``, a null text is empty, a null conv_id is a dialogue like any other.
    ``<|`` in a text or name becomes ``< |``, a line break in a name a blank. Other
    columns are ignored; no rows in, no rows out.
    """
    clean = lambda c: F.replace(c, F.lit("<|"), F.lit("< |"))
    turns = turns.select(
        "conv_id",
        F.floor(F.col("turn") / part_turns).alias("part"),
        "turn",
        F.coalesce("role", F.lit("unknown")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    parts = (
        _sliced(turns, part_turns)
        .groupBy("conv_id", "part", "slice")
        .agg(F.array_sort(F.collect_set(F.struct("turn", "role", "text"))).alias("_turns"))
    )
    participants = turns.select(
        F.col("conv_id").alias("_conv"), F.col("role").alias("participant")
    ).distinct()
    views = parts.join(participants, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    head = lambda m: F.when(
        m["role"] == F.col("participant"), F.lit("<|im_start|>assistant\n")
    ).otherwise(
        F.concat(
            F.lit("<|im_start|>user name="),
            clean(F.translate(m["role"], "\r\n", "  ")),
            F.lit("\n"),
        )
    )
    pieces = F.transform(
        "_turns",
        lambda m: F.struct(
            head(m).alias("head"),
            F.concat(clean(m["text"]), F.lit("<|im_end|>\n")).alias("body"),
            (m["role"] == F.col("participant")).alias("own"),
        ),
    )
    span = lambda at, p: F.concat_ws(
        "-",
        (at + F.length(p["head"])).cast("string"),
        (at + F.length(p["head"]) + F.length(p["body"])).cast("string"),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))
    step = lambda acc, p: F.struct(
        (acc["at"] + F.length(p["head"]) + F.length(p["body"])).alias("at"),
        F.when(p["own"], F.array_append(acc["spans"], span(acc["at"], p)))
        .otherwise(acc["spans"]).alias("spans"),
    )
    return views.withColumn("_pieces", pieces).select(
        "conv_id",
        "participant",
        "part",
        "slice",
        F.size("_pieces").cast("bigint").alias("n_turns"),
        F.size(F.filter("_pieces", lambda p: p["own"])).cast("bigint").alias("n_own"),
        F.array_join(
            F.transform("_pieces", lambda p: F.concat(p["head"], p["body"])), ""
        ).alias("rendered"),
        F.array_join(
            F.aggregate("_pieces", start, step, lambda acc: acc["spans"]), ","
        ).alias("mask"),
    )
