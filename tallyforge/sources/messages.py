"""JSON message lines with a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

_TEXT_FIELDS = [
    T.StructField("id_str", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField(
        "user",
        T.StructType([T.StructField(n, T.StringType()) for n in ("id_str", "name", "screen_name")]),
    ),
    T.StructField(
        "entities",
        T.StructType(
            [
                T.StructField(
                    "hashtags", T.ArrayType(T.StructType([T.StructField("text", T.StringType())]))
                ),
                T.StructField(
                    "urls", T.ArrayType(T.StructType([T.StructField("url", T.StringType())]))
                ),
            ]
        ),
    ),
]
MESSAGE = T.StructType(
    _TEXT_FIELDS + [T.StructField("retweeted_status", T.StructType(list(_TEXT_FIELDS)))]
)
# What the message jobs use; parsing only these fields skips the rest of every document.
POST = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("user", T.StructType([T.StructField("id_str", T.StringType())])),
    ]
)


def parse_messages(lines: DataFrame, raw: str = "value", schema: T.StructType = POST) -> DataFrame:
    """Adds ``message``: the parsed document, null when the line is not exactly one JSON object.

    The line is parsed as the first element of an array with a known second element, so that a
    valid document followed by anything else counts as broken, as in a strict parser.
    """
    marked = T.StructType(schema.fields + [T.StructField("_last", T.BooleanType())])
    wrapped = F.concat(F.lit("["), F.col(raw), F.lit(',{"_last":true}]'))
    parsed = F.from_json(wrapped, T.ArrayType(marked))
    # Exploding a one-element array fixes the parsed value as a column of its own; a plain column
    # would be substituted into every later filter and projection and parsed again in each.
    fixed = lines.select("*", F.explode_outer(F.array(parsed)).alias("_parsed"))
    whole = (F.size("_parsed") == 2) & F.try_element_at("_parsed", F.lit(2)).getField("_last")
    first = F.try_element_at("_parsed", F.lit(1))
    message = F.struct(*[first.getField(f.name).alias(f.name) for f in schema.fields])
    return fixed.withColumn("message", F.when(whole, message)).drop("_parsed")


def posts(lines: DataFrame, raw: str = "value") -> DataFrame:
    """``user_id, text`` of every line that is a message with a text and a user."""
    message = parse_messages(lines, raw)
    return message.select(
        F.col("message.user.id_str").alias("user_id"), F.col("message.text").alias("text")
    ).where(F.col("user_id").isNotNull() & F.col("text").isNotNull())
