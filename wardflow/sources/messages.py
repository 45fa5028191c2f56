"""Raw message sources and sinks in the Kafka record layout.

Kafka itself needs the ``spark-sql-kafka`` package on the cluster; where it is absent lines of
files are read in the same layout, so every later step is identical.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wardflow.functions.text import strip_column
from wardflow.schemas import MESSAGE
from wardflow.sources.files import Files
from wardflow.sources.line_log import NAME as LINES
from wardflow.sources.line_log import SPLIT_BYTES, LineLog

PRODUCER_MARK = "_corruption"


def nonblank_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines stripped of surrounding whitespace, blank ones dropped."""
    return lines.withColumn(column, strip_column(F.col(column))).filter(F.col(column) != "")


def without_mark(value: Column) -> Column:
    """The message without the fault-injection mark; other messages keep their exact text.

    A key is spelt as it is or with an escape, so most messages need not be parsed to see.
    """
    doc = F.try_parse_json(value)
    possible = value.contains(PRODUCER_MARK) | value.contains("\\")
    marked = possible & F.array_contains(F.json_object_keys(value), PRODUCER_MARK)
    fields = F.try_variant_get(doc, "$", "map<string,variant>")
    kept = F.to_json(F.map_filter(fields, lambda k, v: k != PRODUCER_MARK))
    return F.when(marked, kept).otherwise(value)


def keyed_records(lines: DataFrame) -> DataFrame:
    """``(key, value)`` to publish, beside what else there is; the key is the patient."""
    return lines.select(
        *[c for c in lines.columns if c not in ("key", "value")],
        F.expr("try_variant_get(try_parse_json(value), '$.patient_id', 'string')").alias("key"),
        without_mark(F.col("value")).alias("value"),
    )


def append_lines(records: DataFrame, path: str) -> int:
    """Append the values of keyed records to a log of lines; returns how many.

    They keep the order of the DataFrame: its partitions become files in their order, in a new folder
    behind the earlier ones.  A value with a line break, which would come back as two, fails the write.
    One writer at a time.
    """
    counted = Observation()
    broken = F.raise_error(F.lit("a record of a line log must not hold a line break"))
    lines = records.select(F.when(F.col("value").rlike("[\\r\\n]"), broken).otherwise(F.col("value")).alias("value"))
    earlier = Files(records.sparkSession, path).names(path)
    # a folder left by a failed write stays, without lines, and is not used again
    numbers = [int(n.split("-")[1]) for n in earlier if n.startswith("append-")]
    folder = f"{path}/append-{max(numbers, default=0) + 1:09d}"
    lines.observe(counted, F.count(F.lit(1)).alias("records")).write.text(folder)
    return counted.get["records"]


def read_lines(spark: SparkSession, path: str, topic: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The lines of a file or folder as messages, with their byte position in it as offset."""
    spark.dataSource.register(LineLog)
    return _as_messages(spark.read.format(LINES).option("splitBytes", split_bytes).load(path), topic)


def stream_lines(spark: SparkSession, path: str, topic: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The same as a stream of the files that come; see ``line_log`` for what is asked of them."""
    spark.dataSource.register(LineLog)
    reader = spark.readStream.format(LINES).option("splitBytes", split_bytes)
    return _as_messages(reader.load(path), topic)


def _as_messages(lines: DataFrame, topic: str) -> DataFrame:
    placed = nonblank_lines(lines).withColumns({"topic": F.lit(topic), "partition": F.lit(0)})
    return keyed_records(placed).select(*MESSAGE.fieldNames())


def publish_kafka(records: DataFrame, servers: str, topic: str) -> None:
    """Publish to Kafka (needs the connector package; not testable without a broker)."""
    (
        records.selectExpr("CAST(key AS BINARY) AS key", "CAST(value AS BINARY) AS value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("topic", topic)
        .save()
    )


def _text_layout(df: DataFrame) -> DataFrame:
    return df.selectExpr(
        "CAST(key AS STRING) AS key",
        "CAST(value AS STRING) AS value",
        "topic",
        "CAST(partition AS INT) AS partition",
        "CAST(offset AS BIGINT) AS offset",
        "timestamp",
    )


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MESSAGE).json(path)


def stream_messages(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """File-backed topic as a stream; ``max_files`` bounds one micro-batch."""
    reader = spark.readStream.schema(MESSAGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def stream_kafka(
    spark: SparkSession, servers: str, topic: str, max_offsets: int | None = None
) -> DataFrame:
    """Kafka topic from its earliest offset (needs the connector package)."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return _text_layout(reader.load())
