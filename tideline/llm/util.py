"""Working tables, row locators and text access shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import new_dir


def stored(df: DataFrame, name: str, partitions: int | None = None) -> DataFrame:
    """``df`` written below the shared folder and read again: work done once, lineage cut."""
    path = new_dir(df.sparkSession, name)
    (df.coalesce(partitions) if partitions else df).write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    """The whole text, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def located(df: DataFrame) -> DataFrame:
    """``df`` as file rows, so that ``locator()`` names a row; anything but a file scan is written first."""
    try:
        df.select(*locator())
        return df
    except AnalysisException:
        return stored(df, "rows")


def locator() -> list[Column]:
    """Where a row's bytes are: its file, and its number in that file."""
    return [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]


def free_names(df: DataFrame, *names: str) -> Iterator[str]:
    """Names like ``names`` that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        yield name


def rows_at(docs: DataFrame, places: DataFrame, how: str = "left_semi") -> DataFrame:
    """The file rows ``docs`` whose place is (``left_semi``) or is not (``left_anti``) among ``places`` (file, row)."""
    names = list(free_names(docs, "file", "row"))
    places = places.select(*[F.col(c).alias(n) for c, n in zip(("file", "row"), names)])
    marked = docs.select("*", *[c.alias(n) for c, n in zip(locator(), names)])
    return marked.join(places, names, how).select(*[F.col(f"`{c}`") for c in docs.columns])


def words(column: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``."""
    return F.regexp_count(column, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``run``, a mapInArrow function, that gives back at the end of its task what Arrow holds free.

    A Python worker outlives its tasks, and its pool keeps the pages of freed batches.
    """
    @wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
    return task


def share(*parts: Column | str) -> Column:
    """A repeatable number in [0, 1) made from ``parts``."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))
