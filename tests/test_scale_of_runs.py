"""Work that is done once, and over all cores."""

from pyspark.sql import functions as F

from wardflow.config import Settings
from wardflow.functions.embedding import HashedWords
from wardflow.operators.chunking import chunk_documents
from wardflow.operators.lineage import Lineage
from wardflow.plans import run
from wardflow.streaming import ingest


def test_an_upsert_that_prunes_reads_its_chunks_once(spark, tmp_path):
    settings = Settings(root=str(tmp_path / "root"), index_buckets=4)
    table = run.index_table(spark, settings)
    documents = spark.createDataFrame(
        [(f"d{i}", "T", "s", "t", " ".join(["word"] * 200)) for i in range(6)],
        "doc_id string, title string, source string, topic string, body string",
    )
    chunks = chunk_documents(documents)
    assert run.build_index(chunks, table) == 12
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    first = chunks.filter("ordinal = 0").mapInArrow(counted, chunks.schema)
    assert run.build_index(first, table, recreate=False, prune=True, load=HashedWords) == 6
    assert read.value == 6
    assert [r["ordinal"] for r in table.read().select("ordinal").collect()] == [0] * 6


def test_a_run_spreads_messages_of_one_file(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "in")
    rows = spark.range(40).select(
        F.lit(None).cast("string").alias("key"), F.lit("{}").alias("value"), F.lit("vitals.raw").alias("topic"),
        F.lit(0).alias("partition"), F.col("id").alias("offset"), F.current_timestamp().alias("timestamp"),
    )
    rows.coalesce(1).write.parquet(folder)
    stream = spark.readStream.schema(rows.schema).parquet(folder)
    parts, validate = [], ingest.contract.validate

    def seen(messages, as_of):
        parts.append(messages.select(F.spark_partition_id().alias("p")).distinct().count())
        return validate(messages, as_of)

    monkeypatch.setattr(ingest.contract, "validate", seen)
    steps = Lineage(spark, Settings(root=str(tmp_path / "root")), "r")
    assert run.stage_ingest(steps, stream, None, tasks=4)["rejected"] == 40
    assert parts and parts[0] > 1
