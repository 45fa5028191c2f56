"""Index lookups that do not shuffle keys only to tell them apart."""

from pyspark.sql import types as T

from wardflow.sources.key_index import KeyIndex


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_places_are_looked_up_without_telling_keys_apart(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path / "i"), [T.StructField("k", T.IntegerType())], "_part")
    pairs = "k int, _part string"
    index.add(spark.createDataFrame([(k, p) for k in range(9) for p in "ab"] + [(None, "n")], pairs))
    index.add(spark.createDataFrame([(4, "b")], pairs))
    wanted = spark.createDataFrame([(4, "b"), (4, "c"), (50, "a"), (50, "a"), (None, "n")], pairs)
    missing = index.missing(wanted)
    found = sorted((str(r["k"]), r["_part"]) for r in missing.collect())
    assert found == [("4", "c"), ("50", "a"), ("50", "a"), ("None", "n")]
    assert "Aggregate" not in plan_of(missing)
    assert sorted(index.parts_of(wanted)) == ["a", "b"]
    assert index.parts_of(wanted.filter("k = 50")) == []
