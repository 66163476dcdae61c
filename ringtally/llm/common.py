"""What several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ringtally.session import scratch_path

# Words are runs of anything but ASCII white space, whatever the language.
SPACE = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words of a text; NULL has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def staged(frame: DataFrame, name: str) -> DataFrame:
    """Write ``frame`` once into the shared scratch folder and read it back: later passes do
    not compute it again, and a lost executor takes nothing with it."""
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def literal_case(key: Column, values: dict[int, object], kind: str) -> Column:
    """A lookup in a small table the driver holds, as an expression."""
    found = F.lit(None).cast(kind)
    for k, v in values.items():
        found = F.when(key == k, F.lit(v).cast(kind)).otherwise(found)
    return found


def small_batches(spark: SparkSession) -> None:
    """Python workers get a thousand rows at a time, since texts can be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def checkpointed(frame: DataFrame) -> DataFrame:
    """A reliable checkpoint, which keeps the order and layout of partitions. It goes to the
    session's checkpoint folder; one is set below the scratch folder where there is none."""
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_path(frame.sparkSession, "checkpoints"))
    return frame.checkpoint()


def byte_bound(spark: SparkSession, most: int = 16 << 20) -> None:
    """Python workers get batches of about ``most`` bytes, however long single texts are."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(most))


def ranged(frame: DataFrame, order: list[Column], name: str) -> DataFrame:
    """The rows in order over partitions of even size, written once, with the columns ``part``
    and ``at`` (from 0 within the part)."""
    at = F.monotonically_increasing_id()
    sorted_rows = frame.repartitionByRange(*order).sortWithinPartitions(*order)
    return staged(
        sorted_rows.withColumn("part", F.spark_partition_id()).withColumn(
            "at", at - F.shiftleft(F.spark_partition_id().cast("long"), 33)
        ),
        name,
    )
