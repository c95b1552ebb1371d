"""A streaming source over sharded folders that keeps one offset per shard.

A table has a folder per shard, ``shard_id=...``, whose files are named in the order of their records. A shard that
came out of another names it in ``_parent`` (one shard a line) and a shard that gets no more files holds ``_sealed``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from ..schemas import LANDED, STR

PREFIX = "shard_id="


@dataclass
class Lineage(InputPartition):
    """Files of shards that descend from one another, parents first: one task reads them in this order."""

    files: list[tuple[str, str]]


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = path[len("file:"):]
    return fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")


class Shards:
    """What a sharded folder holds now."""

    def __init__(self, path: str):
        self.fs, root = filesystem(path)
        self.files: dict[str, list[str]] = {}
        self.parents: dict[str, list[str]] = {}
        self.sealed: set[str] = set()
        for folder in self.fs.get_file_info(fs.FileSelector(root, allow_not_found=True)):
            if folder.type != fs.FileType.Directory or not folder.base_name.startswith(PREFIX):
                continue
            shard = folder.base_name[len(PREFIX):]
            names = {i.base_name: i.path for i in self.fs.get_file_info(fs.FileSelector(folder.path))}
            self.files[shard] = [names[n] for n in sorted(names) if n.endswith(".parquet")]
            if "_sealed" in names:
                self.sealed.add(shard)
            if "_parent" in names:
                with self.fs.open_input_file(names["_parent"]) as f:
                    self.parents[shard] = f.read().decode().split()

    def open(self) -> list[str]:
        """Shards that may be read, parents first: all whose parents, as far as they are still there, are sealed and open too."""
        order: list[str] = []
        left = sorted(self.files)
        while True:
            ready = [s for s in left if all(p not in self.files or (p in self.sealed and p in order) for p in self.parents.get(s, ()))]
            if not ready:
                return order
            order += ready
            left = [s for s in left if s not in ready]


class ShardReader(DataSourceStreamReader):
    """Offsets are the last file taken of every shard; a shard whose folder is gone leaves the offset."""

    def __init__(self, path: str, schema: StructType):
        self.path, self.schema = path, schema

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        shards = Shards(self.path)
        return {s: shards.files[s][-1].rsplit("/", 1)[1] for s in shards.open() if shards.files[s]}

    def partitions(self, start: dict, end: dict) -> list[Lineage]:
        shards = Shards(self.path)
        groups: dict[str, list[tuple[str, str]]] = {}
        head: dict[str, str] = {}
        for shard in (s for s in shards.open() if s in end):
            # shards with a parent in this micro-batch are read behind it, those of several parents behind the first's group
            parents = [head[p] for p in shards.parents.get(shard, ()) if p in head]
            first = min(parents, default=shard)
            for other in set(parents) - {first}:
                groups[first] += groups.pop(other)
                head.update({s: first for s, h in head.items() if h == other})
            named = [(f.rsplit("/", 1)[1], f) for f in shards.files[shard]]
            fresh = [(shard, f) for name, f in named if start.get(shard, "") < name <= end[shard]]
            if fresh or parents:
                head[shard] = first
                groups.setdefault(first, []).extend(fresh)
        return [Lineage(files) for files in groups.values() if files] or [Lineage([])]

    def read(self, partition: Lineage) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(self.schema)
        names = [n for n in target.names if n != "shard_id"]
        store, _ = filesystem(self.path)
        for shard, path in partition.files:
            with store.open_input_file(path) as f:
                source = pq.ParquetFile(f)
                for batch in source.iter_batches(columns=[n for n in names if n in source.schema_arrow.names]):
                    columns = [
                        pa.array([shard] * len(batch)) if n == "shard_id" else
                        batch.column(n).cast(target.field(n).type) if n in batch.schema.names else pa.nulls(len(batch), target.field(n).type)
                        for n in target.names]
                    yield pa.RecordBatch.from_arrays(columns, schema=target)

    def commit(self, end: dict) -> None:
        pass


class ShardSource(DataSource):
    """Format ``shards``: options ``path``, and ``kind``, a kind of landed rows without variant columns."""

    @classmethod
    def name(cls) -> str:
        return "shards"

    def schema(self) -> StructType:
        return StructType([StructField("shard_id", STR), *(f for f in LANDED[self.options["kind"]] if f.name != "shard_id")])

    def streamReader(self, schema: StructType) -> ShardReader:
        return ShardReader(self.options["path"], schema)


def read_shards(spark: SparkSession, kind: str, path: str):
    """A stream of the rows of all shards below ``path``.

    New shards are found with every micro-batch. A shard with parents is read once they are sealed, and after them. A sealed
    shard's offset stays until its folder is removed, so none of its rows come twice.
    """
    spark.dataSource.register(ShardSource)
    return spark.readStream.format("shards").option("kind", kind).option("path", path).load()
