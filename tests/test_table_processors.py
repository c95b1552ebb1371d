"""Processors that users write as Arrow table functions."""

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from tideline.operators.messages import processor
from tideline.operators.table_processors import completed, convert_batch, register_table_processor
from tideline.sinks.events import dead_letters, valid_events


@pytest.fixture
def upper():
    def convert(batch):  # not a function of a module, as workers don't have the tests
        if pc.any(pc.match_substring(batch.column("Body"), "bad")).as_py():
            raise RuntimeError("bad body")
        return pa.table({"id": batch.column("MessageId"), "type": pa.repeat("t.upper", len(batch)), "data": pc.utf8_upper(batch.column("Body"))})

    return convert


def messages(spark, bodies):
    return spark.createDataFrame([(str(i), b) for i, b in enumerate(bodies)], "MessageId string, Body string")


def test_failing_messages_are_dead_letters(spark, upper):
    register_table_processor("upper", upper)
    bodies = [f"m{i}" if i % 7 else "bad" for i in range(60)]
    events = processor("upper")(messages(spark, bodies).repartition(3), "arn:q")
    good, dead = valid_events(events), dead_letters(events)
    assert {(r.id, r.data, r.type, r.source) for r in good.collect()} == {(str(i), b.upper(), "t.upper", "arn:q") for i, b in enumerate(bodies) if b != "bad"}
    assert {(r.id, r.error) for r in dead.collect()} == {(str(i), "RuntimeError: bad body") for i, b in enumerate(bodies) if b == "bad"}
    assert processor("upper")(messages(spark, []), "arn:q").count() == 0
    with pytest.raises(TypeError):
        processor("upper")(messages(spark, ["x"]), F.col("Body"))


def test_events_without_a_type(spark):
    register_table_processor("untyped", lambda batch: pa.table({"id": batch.column("MessageId")}))
    assert [r.error for r in dead_letters(processor("untyped")(messages(spark, ["a"]), "q")).collect()] == ["missing type"]


def test_batches_are_halved_until_they_work(upper):
    seen = []

    def picky(batch):
        seen.append(batch.num_rows)
        return upper(batch)

    batch = pa.RecordBatch.from_pydict({"MessageId": [str(i) for i in range(8)], "Body": ["ok"] * 5 + ["bad"] + ["ok"] * 2})
    out = pa.concat_tables(convert_batch(picky, batch))
    assert out.num_rows == 8 and out.column("error").null_count == 7 and len(seen) < 8
    with pytest.raises(ValueError, match="undeclared"):
        completed(pa.table({"id": ["1"], "colour": ["red"]}))
