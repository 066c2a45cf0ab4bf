"""Inputs of the registered queries, derived from the given tables by rules both engines share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyforge.session import materialise
from tallyforge.sources.tables import spread

STATIONS = 40
USERS = 97


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str, passes: int = 1) -> DataFrame:
    """Table whose rows are long to process, spread over the cores if it is a small one."""
    return spread(table(spark, sf_dir, name), passes)


def message_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw JSON lines from the conversations: one in twenty cut short, one in twenty a notice."""
    turns = table(spark, sf_dir, "conversations")
    kind = F.pmod(F.col("conv_id") * 31 + F.col("turn"), F.lit(20))
    user = F.struct(F.concat(F.lit("u"), F.col("conv_id") % USERS).alias("id_str"))
    document = F.to_json(
        F.struct(
            F.concat_ws("-", "conv_id", "turn").alias("id_str"),
            F.col("text"),
            user.alias("user"),
        )
    )
    notice = F.to_json(F.struct(F.struct(F.col("turn").alias("track")).alias("limit")))
    line = (
        F.when(kind == 0, F.substring(document, F.lit(1), F.length(document) - 2))
        .when(kind == 1, notice)
        .otherwise(document)
    )
    return turns.select(line.alias("value"))


# Endings with the token classes that the conversations themselves lack.
ENDINGS = (
    "See HTTP://Host.Example.COM/Path?A=b&C=d now",
    "#Topic ##two-words #x it's O'Neill-like",
    "wait... . . really .. no.",
    "call +1 (555) 123-4567, 555.123.4567 or 123-4567; not 2024-2025",
    ":-D =P (: XD <:o) 8*)",
    "caf&#233; &#8364;5 &amp;c &eacute;t&#201; &#38;lt;",
    "1/2 3.14 10:30 -5,2 1,234.56 192.0.2.1",
    "<B CLASS='Big'>Bold</B> @User_1 &lt;I&gt;",
)


def rich_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations, each turn with an ending chosen by its numbers."""
    chosen = F.pmod(F.col("conv_id") * 31 + F.col("turn"), F.lit(len(ENDINGS)))
    ending = F.element_at(F.array(*[F.lit(e) for e in ENDINGS]), (chosen + 1).cast("int"))
    text = F.concat(F.coalesce("text", F.lit("")), F.lit(" "), ending)
    return table(spark, sf_dir, "conversations").select("conv_id", text.alias("text"))


def document_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as posts of 97 users."""
    documents = texts(spark, sf_dir, "documents")
    return documents.select((F.col("doc_id") % USERS).cast("string").alias("user_id"), "text")


def event_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select(F.col("user_id").cast("string").alias("user_id"), F.col("event_type").alias("text"))


def user_groups(posts: DataFrame) -> DataFrame:
    """Lookup by the last digit of the user: 0-6 a group, 7 and 8 an invalid one, 9 no entry."""
    digit = F.right("user_id", F.lit(1)).cast("int")
    group = F.when(digit <= 6, digit).when(digit == 7, -1).cast("int")
    users = posts.select("user_id").distinct()
    return materialise(users.where(digit < 9).select("user_id", group.alias("group_id")))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("values"), "label"
    )


def station_years(spark: SparkSession, sf_dir: str, gaps: bool = True) -> DataFrame:
    """Embeddings as yearly vectors of two measures per station; with ``gaps``, entries whose
    (7 * id + position) is divisible by 23 are missing."""
    half = F.floor(F.col("vec_id") / 2)
    values = F.col("values")
    if gaps:
        values = F.transform(
            "values",
            lambda x, i: F.when((F.col("vec_id") * 7 + i) % 23 == 0, F.lit(float("nan"))).otherwise(x),
        )
    return vectors(spark, sf_dir).select(
        F.concat(F.lit("S"), half % STATIONS).alias("station"),
        F.when(F.col("vec_id") % 2 == 0, "TMAX").otherwise("TMIN").alias("measurement"),
        (F.lit(1900) + F.floor(half / STATIONS)).cast("int").alias("year"),
        values.alias("values"),
    )


def line_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as vectors of two entries per return flag, whose components have a closed form."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(
        F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey").alias("station"),
        F.col("l_returnflag").alias("measurement"),
        F.col("l_linenumber").alias("year"),
        F.array(F.col("l_quantity"), F.col("l_extendedprice") / 1000).alias("values"),
    )


def line_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as lines of cells; by their numbers, one in a hundred each has a word for a number, an
    empty cell, or one cell less."""
    cells = [F.col(c).cast("string") for c in ("l_extendedprice", "l_discount", "l_tax")]
    kind = (F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 100
    first = F.when(kind == 0, "many").when(kind == 1, "").otherwise(F.col("l_quantity").cast("string"))
    line = F.concat_ws(" , ", first, *cells[:2], F.when(kind != 2, cells[2]))
    return table(spark, sf_dir, "lineitem").select(line.alias("value"))


def station_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same vectors with the supplier as station: three measures, many vectors each."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(
        F.concat(F.lit("S"), "l_suppkey").alias("station"), F.col("l_returnflag").alias("measurement"),
        F.col("l_linenumber").alias("year"), F.array(F.col("l_quantity"), F.col("l_extendedprice") / 1000).alias("values"),
    )


def station_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is known of a station beside its vectors."""
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("S"), "s_suppkey").alias("station"), F.col("s_acctbal").cast("double").alias("balance"),
        F.col("s_nationkey").cast("double").alias("nation"),
    )


def ragged_station_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station years of which one in fifty lost its last entry and one in seventy its vector."""
    rows = vectors(spark, sf_dir)
    values = F.when(F.col("vec_id") % 50 == 3, F.slice("values", 1, 63)).when(F.col("vec_id") % 70 != 5, F.col("values"))
    return rows.select(
        F.concat(F.lit("S"), F.col("vec_id") % STATIONS).alias("station"),
        F.when(F.col("vec_id") % 3 == 0, "TMAX").when(F.col("vec_id") % 3 == 1, "TMIN").alias("measurement"),
        F.col("label").alias("year"), values.alias("values"),
    )


def nested_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as nested records: the two halves of a vector as two measurements."""
    half = lambda name, start: F.struct(
        F.lit(name).alias("measurement"),
        F.col("label").alias("year"),
        F.slice("values", start, 32).alias("values"),
    )
    return vectors(spark, sf_dir).select(
        F.concat(F.lit("V"), "vec_id").alias("station"),
        F.array(half("TMAX", 1), half("TMIN", 33)).alias("measurements"),
    )


def event_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select(F.col("event_type").alias("measurement"), "value")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors(spark, sf_dir).select(F.col("vec_id").cast("string").alias("id"), F.col("values").alias("v"))


def projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as a regression table: dimensions 1-4 as features, all others as targets."""
    cols = [F.col("values")[i].alias(f"x{i + 1}") for i in range(4)]
    cols += [F.col("values")[i + 4].alias(f"y{i + 1}") for i in range(60)]
    return vectors(spark, sf_dir).select("vec_id", *cols)


def labelled_vectors(spark: SparkSession, sf_dir: str, chosen: int = 2) -> DataFrame:
    """``vec_id, label (1.0 for the chosen class), features``."""
    from pyspark.ml.functions import array_to_vector

    from tallyforge.operators.sampling import one_vs_rest

    return vectors(spark, sf_dir).select(
        "vec_id", one_vs_rest(F.col("label"), chosen).alias("label"), array_to_vector("values").alias("features")
    )
