"""Parsing of text payloads: JSON into typed structs, text into times.

Text-to-time conversions use the ``try_`` variants: under ANSI mode a single
malformed value would otherwise fail the task and stop a streaming query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def parse_json(value: Column | str, schema: T.StructType) -> Column:
    """``from_json`` in PERMISSIVE mode.

    A mistyped field becomes NULL while the others are kept; malformed text,
    ``{}``, ``null`` or a top-level array give a struct of NULLs; a NULL input
    gives a NULL struct.
    """
    return F.from_json(value, schema, {"mode": "PERMISSIVE"})


def loose_fields(value: Column | str) -> Column:
    """The top-level fields of a JSON object as text."""
    raw = F.col(value) if isinstance(value, str) else value
    return F.from_json(raw, T.MapType(T.StringType(), T.StringType()), {"mode": "PERMISSIVE"})


def _lost(value: Column, typed: Column, loose: Column, schema: T.StructType) -> Column:
    names = F.array(*[F.lit(f.name) for f in schema.fields])
    mistyped = F.array_compact(F.array(*[
        F.when(typed[f.name].isNull() & loose[f.name].isNotNull(), F.lit(f.name)) for f in schema.fields]))
    kept = F.map_filter(loose, lambda k, v: ~F.array_contains(names, k) | F.array_contains(mistyped, k))
    return (F.when(value.isNull(), F.lit(None).cast("string")).when(loose.isNull(), value)
            .otherwise(F.nullif(F.to_json(kept), F.lit("{}"))))


def rescued_data(value: Column | str, schema: T.StructType) -> Column:
    """JSON text of whatever the typed parse of ``value`` could not keep.

    * unreadable text -> the whole text;
    * keys that are not in ``schema`` -> kept;
    * keys whose typed value came out NULL although the raw value was not
      (a mistyped value) -> kept;
    * nothing lost -> NULL.

    The text is parsed twice: once typed, once into a map.  No Python involved.
    """
    raw = F.col(value) if isinstance(value, str) else value
    parsed = F.struct(raw.alias("v"), parse_json(raw, schema).alias("t"), loose_fields(raw).alias("m"))
    # a lambda over one element: its variable stands for the parsed text
    return F.transform(F.array(parsed), lambda p: _lost(p["v"], p["t"], p["m"], schema))[0]


def with_rescued(df: DataFrame, value: str, schema: T.StructType, data: str = "data",
                 rescued: str = "_rescued_data") -> DataFrame:
    """Adds ``data`` (the typed struct of ``value``) and ``rescued`` (see
    ``rescued_data``) from the same two parses."""
    parsed = F.struct(parse_json(F.col(value), schema).alias("t"), loose_fields(value).alias("m"))
    both = F.transform(F.array(parsed), lambda p: F.struct(
        p["t"].alias(data), _lost(F.col(value), p["t"], p["m"], schema).alias(rescued)))[0]
    return df.withColumn("_parsed", both).select("*", f"_parsed.{data}", f"_parsed.{rescued}").drop("_parsed")


def parse_timestamp(text: Column | str, fmt: str) -> Column:
    """Text -> TIMESTAMP; NULL when the text does not match ``fmt``."""
    return F.try_to_timestamp(F.col(text) if isinstance(text, str) else text, F.lit(fmt))


def parse_date(text: Column | str, fmt: str) -> Column:
    """Text -> DATE; NULL when the text does not match ``fmt``."""
    col = F.col(text) if isinstance(text, str) else text
    return F.to_date(F.try_to_timestamp(col, F.lit(fmt)))
