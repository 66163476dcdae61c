"""Loads into a relational database over JDBC (the driver jar comes with the job)."""

from __future__ import annotations

from pyspark.sql import DataFrame

POSTGRES_DRIVER = "org.postgresql.Driver"


def jdbc_options(
    url: str,
    table: str,
    user: str,
    password: str,
    driver: str = POSTGRES_DRIVER,
    connections: int = 8,
    batch_rows: int = 10_000,
) -> dict[str, str]:
    """``connections`` bounds how many tasks write at once, whatever the size of the batch."""
    return {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "driver": driver,
        "numPartitions": str(connections),
        "batchsize": str(batch_rows),
    }


def append(frame: DataFrame, options: dict[str, str], mode: str = "append") -> None:
    frame.write.format("jdbc").options(**options).mode(mode).save()


def read(spark, options: dict[str, str], column: str, lower: str, upper: str) -> DataFrame:
    """A table in ``numPartitions`` slices of ``column``; filters are sent to the database."""
    slices = {"partitionColumn": column, "lowerBound": lower, "upperBound": upper}
    return spark.read.format("jdbc").options(**options, **slices).load()
