"""What several operators of this subpackage share: stored tables and ranks without a global sort."""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Callable, Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallyforge.session import ensure_checkpoint_dir

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the checkpoint folder that driver and executors share.

    It stays until the application's checkpoint folder is cleared: results are lazy and may read it.
    """
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once into a Parquet table in the shared folder, and read from there."""
    path = f"{shared_folder(df.sparkSession)}/table"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sent(spark: SparkSession, thing: object) -> Callable[[], object]:
    """``thing`` broadcast together with its classes; the function given back finds it in a task.

    A plain broadcast names the classes of what it holds, so executors would need this package.  What is sent
    must be of bounded size; it is unpacked once per task.
    """
    packed = spark.sparkContext.broadcast(cloudpickle.dumps(thing))
    unpacked: list[object] = []

    def get() -> object:
        if not unpacked:
            unpacked.append(pickle.loads(packed.value))
        return unpacked[0]

    return get


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hex_number(digest: Column, start: int, digits: int) -> Column:
    """``digits`` (at most 15) hexadecimal characters of ``digest`` from ``start`` (from 1) as a long."""
    return F.conv(F.substring(digest, start, digits), 16, 10).cast("long")


def digest_block(key: Column, blocks: int) -> Column:
    """Block of a row in the order of the md5 of its key: equal shares of the digests' range."""
    return F.floor(hex_number(F.md5(key), 1, 8) * blocks / F.lit(2**32)).cast("int")


def ranked(
    rows: DataFrame, group: Sequence[str], block: str, order: Sequence[str | Column], rank: str, blocks: int
) -> DataFrame:
    """``rows`` with ``rank``: 0, 1, ... within ``group``, by ``block`` and then ``order``.

    ``block`` must rise with the intended order.  No task holds a group: rows are numbered inside
    (group, block), and what comes before a block is a running sum over the blocks' counts.  Those
    are at most ``blocks`` times the number of groups, whatever the number of rows.
    """
    keys = [*group, block]
    inside = Window.partitionBy(*keys).orderBy(*order)
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*group).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.coalesce(1).withColumn("_first", F.coalesce(F.sum("_rows").over(before), F.lit(0))).drop("_rows")
    numbered = rows.withColumn("_inside", F.row_number().over(inside) - 1)
    # The keys may be null (an unknown source): null-safe equality.
    same = None
    for key in keys:
        pair = numbered[key].eqNullSafe(firsts[key])
        same = pair if same is None else same & pair
    joined = numbered.join(firsts, same, "inner")
    for key in keys:
        joined = joined.drop(firsts[key])
    return joined.withColumn(rank, F.col("_first") + F.col("_inside")).drop("_first", "_inside")
