"""Readings, messages, chunks and questions derived from the shared test tables.

The tables hold no vital signs, so they are derived from ``events`` by the SQL below, which
Spark and DuckDB both run as it is.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.operators.chunking import chunk_documents
from wardflow.schemas import BRONZE
from wardflow.session import spread

AS_OF = "2024-02-01T00:00:00+00:00"

# Every tenth event (9, 19, ...) corrects the reading five before it.
VITALS_SQL = """
SELECT concat('r', base_id) AS reading_id,
       concat('P', 100000 + base_id % 20) AS patient_id,
       TIMESTAMP '2024-01-01 00:00:00'
         + (base_id * 8 % 86400) * INTERVAL '1' SECOND AS recorded_at,
       CAST(CASE WHEN base_id % 20 < 12 THEN 60 + (event_id * 7 + k) % 31
                 ELSE 35 + (event_id * 7 + k) % 110 END AS INT) AS heart_rate,
       CAST(CASE WHEN base_id % 20 < 12 THEN 12 + (event_id * 3 + k) % 9
                 ELSE 6 + (event_id * 3 + k) % 24 END AS INT) AS resp_rate,
       CAST(CASE WHEN base_id % 20 < 12 THEN 111 + (event_id * 11 + k) % 60
                 ELSE 80 + (event_id * 11 + k) % 150 END AS INT) AS systolic_bp,
       CAST(CASE WHEN base_id % 20 < 6 THEN 96 + (event_id * 5 + k) % 5
                 WHEN base_id % 20 < 12 THEN 91 + (event_id * 5 + k) % 10
                 ELSE 88 + (event_id * 5 + k) % 13 END AS INT) AS spo2,
       CAST(CASE WHEN base_id % 20 < 12 THEN 361 + (event_id * 13 + k) % 20
                 ELSE 345 + (event_id * 13 + k) % 60 END AS DOUBLE) / 10 AS temperature_c,
       CASE WHEN base_id % 20 < 12 THEN 'A' WHEN event_type = 'error' THEN 'P'
            WHEN event_type = 'signup' THEN 'V' ELSE 'A' END AS consciousness,
       (base_id % 20 >= 12 AND k % 4 = 0) AS on_supplemental_o2,
       concat('dev-', user_id % 4) AS source_device,
       ts AS ingested_at,
       CAST(event_id % 3 AS INT) AS kafka_partition,
       event_id AS kafka_offset
FROM (SELECT event_id, user_id, event_type, ts, CAST(floor(value) AS BIGINT) AS k,
             event_id - CASE WHEN event_id % 10 = 9 THEN 5 ELSE 0 END AS base_id
      FROM {events}) e
"""

# The same readings as JSON texts.  The last two digits of the event number choose a fault
# (0 to 19) or none.
MESSAGES_SQL = (
    """
SELECT patient_id AS msg_key, kafka_partition AS part_no, kafka_offset AS off_no, stamp,
       CASE fault
         WHEN 3 THEN concat('{"broken":["', reading_id, '"]}')
         WHEN 8 THEN concat('["', reading_id, '", 1]')
         WHEN 14 THEN concat('{"reading_id":"', reading_id)
         ELSE concat(
           '{"reading_id":"', CASE fault WHEN 1 THEN ' ' ELSE reading_id END,
           '","patient_id":"', CASE fault WHEN 17 THEN 'Q100001' ELSE patient_id END,
           '","recorded_at":"', CASE fault WHEN 11 THEN '2024-02-09T' ELSE '2024-01-01T' END,
           lpad(CAST(CAST(floor(secs / 3600) AS INT) AS STRING), 2, '0'), ':',
           lpad(CAST(CAST(floor(secs / 60) AS INT) % 60 AS STRING), 2, '0'), ':',
           lpad(CAST(secs % 60 AS STRING), 2, '0'), '+00:00","heart_rate":',
           CASE fault WHEN 0 THEN '19' WHEN 9 THEN concat('"', heart_rate, '"')
                      WHEN 16 THEN '90.75' WHEN 19 THEN '"high"' ELSE CAST(heart_rate AS STRING) END,
           CASE fault WHEN 4 THEN '' ELSE concat(',"resp_rate":', resp_rate) END,
           ',"systolic_bp":', CASE fault WHEN 6 THEN '261' WHEN 0 THEN '999'
                                         ELSE CAST(systolic_bp AS STRING) END,
           ',"spo2":', CASE fault WHEN 12 THEN 'null' ELSE CAST(spo2 AS STRING) END,
           ',"temperature_c":', CASE fault WHEN 2 THEN '29.4'
             ELSE concat(CAST(floor(tenths / 10) AS INT), '.', tenths % 10) END,
           ',"consciousness":"', CASE fault WHEN 7 THEN 'asleep' ELSE consciousness END,
           '","on_supplemental_o2":', CASE fault WHEN 5 THEN '"mask"' WHEN 13 THEN '"on"'
             ELSE CASE WHEN on_supplemental_o2 THEN 'true' ELSE 'false' END END,
           ',"source_device":"', CASE fault WHEN 15 THEN '' ELSE source_device END, '"',
           CASE fault WHEN 10 THEN ',"ward":"B2"' WHEN 18 THEN ',"bed":4,"aisle":"x"'
                      ELSE '' END, '}') END AS msg
FROM (SELECT *, CAST(kafka_offset % 100 AS INT) AS fault, ingested_at AS stamp,
             CAST(round(temperature_c * 10) AS INT) AS tenths,
             CAST((kafka_offset - CASE WHEN kafka_offset % 10 = 9 THEN 5 ELSE 0 END) * 8 % 86400
                  AS INT) AS secs
      FROM ("""
    + VITALS_SQL
    + """) v) f
"""
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _over(events: DataFrame, sql: str) -> DataFrame:
    """``sql`` with its placeholder bound to the given DataFrame."""
    view = f"events_{uuid.uuid4().hex}"
    events.createOrReplaceTempView(view)
    try:
        return events.sparkSession.sql(sql.replace("{events}", view))
    finally:
        events.sparkSession.catalog.dropTempView(view)


def bronze_of(events: DataFrame) -> DataFrame:
    """Bronze rows from an ``events`` DataFrame, batch or streaming."""
    rows = _over(events, VITALS_SQL)
    for name in ("recorded_at", "ingested_at"):
        rows = rows.withColumn(name, F.col(name).cast("timestamp"))
    return rows.select(*BRONZE.fieldNames())


def messages_of(events: DataFrame) -> DataFrame:
    """Raw messages from an ``events`` DataFrame, batch or streaming."""
    rows = _over(events, MESSAGES_SQL)
    return rows.select(
        F.col("msg_key").alias("key"),
        F.col("msg").alias("value"),
        F.lit("vitals.raw").alias("topic"),
        F.col("part_no").alias("partition"),
        F.col("off_no").alias("offset"),
        F.col("stamp").cast("timestamp").alias("timestamp"),
    )


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_of(table(spark, sf_dir, "events"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages_of(table(spark, sf_dir, "events"))


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``documents`` table, over all cores."""
    return spread(table(spark, sf_dir, "documents"), "doc_id")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``documents`` table in the corpus layout."""
    doc_id = F.col("doc_id").cast("string")
    return texts(spark, sf_dir).select(
        doc_id.alias("doc_id"),
        F.concat(F.lit("Document "), doc_id).alias("title"),
        "source",
        F.col("lang").alias("topic"),
        F.col("text").alias("body"),
    )


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_documents(documents(spark, sf_dir))


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ``benchmark`` passage as a question."""
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query")
    )


def pages_as_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` with ``<h1>`` to ``<h6>`` turned into Markdown headings."""
    body = F.col("html")
    for level in range(1, 7):
        body = F.regexp_replace(body, f"<h{level}[^>]*>", "\n" + "#" * level + " ")
        body = F.regexp_replace(body, f"</h{level}>", "\n")
    page = F.col("page_id").cast("string")
    return spread(table(spark, sf_dir, "pages"), "page_id").select(
        page.alias("doc_id"), F.col("url").alias("title"), F.lit("web").alias("source"),
        F.lit("").alias("topic"), body.alias("body"),
    )


def label_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean vector of each label as a query: ``query_id, embedding``.

    Components are averaged in place by position; only (label, position) pairs are shuffled.
    """
    component = table(spark, sf_dir, "embeddings").select(
        "label", F.posexplode("embedding").alias("pos", "x")
    )
    means = component.groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("mean"))
    # One entry per vector dimension in each list.
    ordered = F.sort_array(F.collect_list(F.struct("pos", "mean")))
    return means.groupBy(F.col("label").alias("query_id")).agg(
        F.transform(ordered, lambda s: s["mean"]).alias("embedding")
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``embeddings`` table in the index layout; ids are padded so text order is id order."""
    vec = F.lpad(F.col("vec_id").cast("string"), 12, "0")
    return table(spark, sf_dir, "embeddings").select(
        vec.alias("chunk_id"), vec.alias("doc_id"), F.lit(0).alias("ordinal"), "embedding", "label"
    )


def lineage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as lineage: each is a stage run that ends ``value`` ms later, or has failed."""
    at = F.col("ts").cast("timestamp")
    end = F.timestamp_micros(F.unix_micros(at) + F.floor(F.col("value") * 1000).cast("bigint"))
    failed = F.col("event_type") == "error"

    def event(state, when, error):
        iso = F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        parent = F.struct(F.struct(F.concat(F.lit("user-"), "user_id").alias("runId")).alias("run"))
        facets = F.struct(parent.alias("parent"), F.struct(error.alias("message")).alias("errorMessage"))
        run = F.struct(F.concat(F.lit("run-"), "event_id").alias("runId"), facets.alias("facets"))
        job = F.struct(F.col("event_type").alias("name"))
        return F.struct(
            iso.alias("eventTime"), state.alias("eventType"), run.alias("run"), job.alias("job")
        )

    nothing = F.lit(None).cast("string")
    start = event(F.lit("START"), at, nothing)
    done = event(
        F.when(failed, "FAIL").otherwise("COMPLETE"), end, F.when(failed, F.lit("event error"))
    )
    return table(spark, sf_dir, "events").select(F.inline(F.array(start, done)))
