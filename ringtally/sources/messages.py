"""Message streams: the broker, or files holding the same frames.

The broker's connector is a separate package (``spark-sql-kafka-0-10``); the option maps here
are plain dictionaries, and everything after the source works on any frame with a ``value``
column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TOPIC = "usage_events"


def kafka_source_options(
    servers: str,
    topic: str = TOPIC,
    starting: str = "latest",
    fail_on_data_loss: bool = False,
    max_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """``min_partitions`` splits large broker partitions over more tasks, which also breaks up
    one that holds a hot subscriber."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def kafka_messages(spark: SparkSession, servers: str, **options) -> DataFrame:
    return spark.readStream.format("kafka").options(**kafka_source_options(servers, **options)).load()


def kafka_sink_options(servers: str, topic: str = TOPIC) -> dict[str, str]:
    """All replicas confirm a message, and one request at a time keeps a key's order."""
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.retries": "3",
        "kafka.max.in.flight.requests.per.connection": "1",
    }


def publish(messages: DataFrame, servers: str, checkpoint: str, topic: str = TOPIC):
    """Write key/value frames (see ``events.encode``) to the broker, batch or stream."""
    options = kafka_sink_options(servers, topic)
    if not messages.isStreaming:
        messages.write.format("kafka").options(**options).save()
        return None
    return (
        messages.writeStream.format("kafka")
        .options(**options)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def file_stream(
    spark: SparkSession, path: str, schema: str, fmt: str = "parquet", max_files: int | None = None
) -> DataFrame:
    """A stream over the files of a folder, or over one file given as a glob."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.load(path)


def text_messages(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Lines of JSON as messages."""
    return file_stream(spark, path, "value string", "text", max_files)
