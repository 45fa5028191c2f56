"""Work per message that a stream does once, or only for the messages that need it."""

import re

import pytest
from helpers import AS_OF, messages, reading
from pyspark.sql import functions as F

from wardflow.functions.text import strip, strip_column
from wardflow.operators import contract
from wardflow.sources import messages as msg

TEXTS = ["", " ", "a", " a", "a\n", " a ", "a b", "a\u0085", "a \r\n", "　", "\U0001f600 ", None]
MARK = msg.PRODUCER_MARK
ESCAPED = MARK.replace("_", "\\u005f", 1)


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_only_texts_with_whitespace_at_an_end_are_searched(spark):
    rows = spark.createDataFrame([(t,) for t in TEXTS], "value string")
    both = rows.select(strip("value").alias("a"), strip_column(F.col("value")).alias("b")).collect()
    assert [r["a"] for r in both] == [r["b"] for r in both]
    assert "CASE WHEN" in plan_of(msg.nonblank_lines(rows))


@pytest.mark.parametrize(
    ("value", "kept"),
    [
        (f'{{"{MARK}":1,"b":2}}', '{"b":2}'),
        (f'{{"{ESCAPED}":1,"b":2}}', '{"b":2}'),
        (f'{{"a": "{MARK}"}}', f'{{"a": "{MARK}"}}'),
        ('{"a": 1}', '{"a": 1}'),
        ("{broken \\", "{broken \\"),
        (None, None),
    ],
)
def test_a_mark_is_found_however_its_key_is_spelt(spark, value, kept):
    row = spark.createDataFrame([(value,)], "value string")
    without = row.select(msg.without_mark(F.col("value")).alias("v"))
    assert without.first()["v"] == kept
    assert "contains" in plan_of(without).lower()


def test_a_message_is_searched_for_its_fields_once(spark):
    validated = contract.validate(messages(spark, [reading(), "[1]", "null", '{"heart_rate": null}']), AS_OF)
    assert not re.search(r"\$\.(heart_rate|reading_id)", plan_of(validated))
    assert [len(r["errors"]) for r in validated.orderBy("offset").collect()] == [0, 1, 1, len(contract.FIELDS)]
