"""JSON messages to rows with a reject reason, and rows back to JSON.

A message carries one object or a list of objects. Each object is an element, placed by
(part, off, pos); whatever cannot become a row keeps a reason instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from blotter.functions.conform import typed

ARRIVAL = ["part", "off", "pos"]
#: The order in which records count as having arrived: by the time their message was sent, if
#: it carries one, then by place. Messages without a time come before all that have one.
SENT = "sent"
CLOCK = [SENT, *ARRIVAL]


def decode_value(df: DataFrame) -> DataFrame:
    """The message body as text, in ``raw``."""
    return df.withColumn("raw", F.col("value").cast("string")).drop("value")


def to_json_value(df: DataFrame) -> DataFrame:
    """Each row as one JSON object in ``value``; null fields are left out."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def _elements(key: str) -> Column:
    """The elements of ``_doc`` with their key, or one entry with a ``fault`` and the text.

    Only a fault carries the text of the message: beside every element it would grow with
    the square of a list's length.
    """
    def entry(element: Column, fault: str | None = None) -> Column:
        text = F.lit(None).cast("string") if fault is None else F.col("raw")
        return F.struct(
            element.alias("e"), F.lit(fault).cast("string").alias("fault"), text.alias("text")
        )

    none = F.lit(None).cast("variant")
    # In valid JSON the first character already tells the type of the whole.
    first = F.substring(F.ltrim(F.col("raw"), F.lit(" \t\r\n")), 1, 1)
    listed = F.transform(F.expr("cast(_doc as array<variant>)"), lambda x: entry(x))
    entries = (
        F.when(F.col("_doc").isNull(), F.array(entry(none, "parse_error")))
        .when(first == "{", F.array(entry(F.col("_doc"))))
        .when(first == "[", listed)
        .otherwise(F.array(entry(none, "unsupported_top_level")))
    )
    keyed = F.transform(
        entries,
        lambda x: F.struct(
            x["e"], x["fault"], x["text"],
            F.try_variant_get(x["e"], f"$.{key}", "variant").alias("key"),
        ),
    )
    return F.transform(
        keyed,
        lambda x: F.struct(
            x["e"], x["fault"], x["text"], x["key"], F.schema_of_variant(x["key"]).alias("kind")
        ),
    )


def _reason(key_type: T.DataType) -> Column:
    """Why an element is no usable row; null when it is one."""
    element, fault, key, kind = (F.col(f"_item.{name}") for name in ("e", "fault", "key", "kind"))
    # Only an object can have a key, so the type of an element matters only without one.
    keyless = F.when(F.schema_of_variant(element).startswith("OBJECT"), "missing_key").otherwise(
        "element_not_object"
    )
    # The text '0' counts as a key; the number 0, false, '' and null do not.
    falsy = (
        F.when(kind == "STRING", F.try_variant_get(key, "$", "string") == "")
        .when(kind == "BOOLEAN", ~F.try_variant_get(key, "$", "boolean"))
        .otherwise(F.try_variant_get(key, "$", "double") == 0)
    )
    nested = kind.startswith("OBJECT") | kind.startswith("ARRAY")
    untyped = typed(F.try_variant_get(key, "$", "string"), key_type).isNull()
    return (
        F.when(fault.isNotNull(), fault)
        .when(kind.isNull() | (kind == "VOID"), keyless)
        .when(nested, "bad_key")
        .when(falsy, "missing_key")
        .when(untyped, "bad_key")
    )


def flatten(messages: DataFrame, schema: T.StructType, key: str) -> DataFrame:
    """Elements of decoded messages (part, off, raw): place, ``reason``, declared fields.

    Where messages carry the time they were ``sent``, their elements do so too. ``reason``
    is null for a usable row, else parse_error, unsupported_top_level,
    element_not_object, missing_key or bad_key. A field an element lacks is null, and an
    empty list gives no row at all.
    """
    parsed = messages.withColumn("_doc", F.try_parse_json("raw"))
    place = [c for c in (SENT, "part", "off") if c in messages.columns]
    elements = parsed.select(*place, F.posexplode(_elements(key)).alias("pos", "_item"))
    reason = _reason(schema[key].dataType)
    # All fields leave the variant in one pass, as text, and are typed afterwards.
    texts = ", ".join(f"`{name}` string" for name in schema.names)
    fields = F.try_variant_get("_item.e", "$", f"struct<{texts}>")
    return elements.withColumn("_fields", fields).select(
        *place,
        "pos",
        reason.alias("reason"),
        # A rejected element keeps its own text, not that of the list around it.
        F.when(reason.isNotNull(), F.coalesce(F.to_json("_item.e"), F.col("_item.text"))).alias("raw"),
        *(typed(F.col("_fields")[f.name], f.dataType).alias(f.name) for f in schema.fields),
    )


def clock_of(df: DataFrame) -> list[str]:
    """The columns that order the records of ``flatten``."""
    return [c for c in CLOCK if c in df.columns]


def valid_records(flat: DataFrame) -> DataFrame:
    """Usable rows of ``flatten``: place and declared fields."""
    return flat.where(F.col("reason").isNull()).drop("reason", "raw")


def rejects(flat: DataFrame) -> DataFrame:
    """What ``flatten`` could not use: place, reason and the text of message or element."""
    return flat.where(F.col("reason").isNotNull()).select(*ARRIVAL, "reason", "raw")
