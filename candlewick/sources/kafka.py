"""Kafka topics in batch and as streams. Addresses and credentials come from the caller."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from candlewick.schemas import ENVELOPE_COLUMNS


def connection(servers: str, user: str | None = None, password: str | None = None) -> dict[str, str]:
    """Options for a broker, with plain SASL login when a user is given."""
    options = {"kafka.bootstrap.servers": servers}
    if user is not None:
        login = f'org.apache.kafka.common.security.plain.PlainLoginModule required username="{user}" password="{password}";'
        options |= {
            "kafka.security.protocol": "SASL_PLAINTEXT",
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config": login,
        }
    return options


def stream_options(topics: Sequence[str], starting: str = "latest") -> dict[str, str]:
    return {"subscribe": ",".join(topics), "startingOffsets": starting}


def batch_options(topic: str, partitions: Sequence[int]) -> dict[str, str]:
    return {
        "assign": json.dumps({topic: list(partitions)}),
        "startingOffsets": "earliest",
        "endingOffsets": "latest",
    }


def kafka_source(
    spark: SparkSession, topics: Sequence[str], options: Mapping[str, str], starting: str = "latest"
) -> DataFrame:
    """Stream of the topics' messages."""
    return spark.readStream.format("kafka").options(**options, **stream_options(topics, starting)).load()


def read_topic(spark: SparkSession, topic: str, partitions: Sequence[int], options: Mapping[str, str]) -> DataFrame:
    """The messages that the given partitions hold now."""
    return topic_envelope(spark.read.format("kafka").options(**options, **batch_options(topic, partitions)).load())


def topic_envelope(messages: DataFrame) -> DataFrame:
    """Where and when each message arrived, with key and value as text; empty ones stay null."""
    text = {name: F.col(name).cast("string") for name in ("key", "value")}
    return messages.select(*[text[name].alias(name) if name in text else name for name in ENVELOPE_COLUMNS])


def tail_topic(stream: DataFrame, checkpoint: str, path: str | None = None) -> DataStreamWriter:
    """Follow a topic: to the console, or to Parquet files below ``path``."""
    writer = topic_envelope(stream).writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return writer.format("parquet").option("path", path) if path else writer.format("console")


def to_messages(df: DataFrame, key: Column | str, topic: str | None = None) -> DataFrame:
    """Key and JSON value of each row, ready for a Kafka sink. Null fields are left out of the JSON."""
    columns = [
        (F.col(key) if isinstance(key, str) else key).cast("string").alias("key"),
        F.to_json(F.struct(*[F.col(f"`{name}`") for name in df.columns])).alias("value"),
    ]
    return df.select(*([F.lit(topic).alias("topic")] if topic else []), *columns)


def write_topic(df: DataFrame, key: Column | str, topic: str, options: Mapping[str, str]) -> None:
    """Send the rows as keyed JSON messages."""
    to_messages(df, key, topic).write.format("kafka").options(**options).save()


def kafka_sink(
    messages: DataFrame, topic: str, options: Mapping[str, str], checkpoint: str, every: str = "1 minute"
) -> DataStreamWriter:
    """Append a stream of key/value messages to a topic."""
    return (
        messages.writeStream.format("kafka")
        .options(**options)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(processingTime=every)
    )
