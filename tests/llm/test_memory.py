"""What a Python worker keeps between its tasks."""

import re
from pathlib import Path

import pyarrow as pa
from samples import prose

from tideline.llm.packing import token_pieces
from tideline.llm.queries import vocabulary


class Caught:
    """In place of a DataFrame: gives the function that an operator runs on Arrow batches."""

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):  # noqa: N802
        return run


def resident() -> float:
    return int(re.search(r"\nAnonymous:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) / 1024


def test_a_task_gives_back_what_arrow_holds_free(spark):
    text = prose(1, 20_000)
    run = token_pieces(Caught(), vocabulary("word_bpe_49k.json"), 1, 4096)
    batch = pa.RecordBatch.from_arrays([pa.array(range(250)), pa.array([text] * 250)], ["doc_id", "text"])
    assert sum(len(b) for b in run(iter([batch]))) >= 250
    before = resident()
    pa.default_memory_pool().release_unused()
    assert before - resident() < 20
