"""Identities, their datasets and the records inside."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..schemas import SYNC_RECORD

# records one event carries; more become further parts
PART_RECORDS = 1024
_SPREAD = 64
# records of a dataset that are put in order as one list; the records of larger ones are shared by tasks
TOGETHER = 16_384


def sync_datasets(
    identities: DataFrame, datasets: DataFrame, records: DataFrame,
    part_records: int = PART_RECORDS, spread: int = _SPREAD, together: int = TOGETHER,
) -> DataFrame:
    """Datasets of known identities with their records nested in ``DatasetRecords``.

    A dataset of n records comes as ``parts`` = ceil(n / ``part_records``) rows (one if it
    has none), numbered by ``part`` from 0; every part but the last holds exactly
    ``part_records`` records, so no list grows without bound. Records are ordered by key
    inside a part. Which part holds a key follows from a hash of the keys: to number the
    records of a dataset of more than ``together``, ``spread`` tasks share them; the records of
    all others are shuffled once. An identity without datasets gives nothing.
    """
    # names of a pool begin alike: rows are counted, sorted and joined by a hash of them first
    key = ["_h", "IdentityId", "DatasetName"]
    hashed = F.xxhash64("IdentityId", "DatasetName")
    fields = [f.name for f in SYNC_RECORD]
    record = F.struct("Key", *[f for f in fields if f != "Key"])
    # a record without identity or dataset belongs to none
    records = records.where("IdentityId IS NOT NULL AND DatasetName IS NOT NULL").withColumn("_h", hashed)
    rows = records.select(
        *key, F.pmod(F.xxhash64("Key"), F.lit(spread)).cast("int").alias("_spread"), record.alias("_r"))
    # datasets that one task should not order alone; either way gives a dataset the same parts, so a hash shared by two does no harm
    counts = records.groupBy("_h").agg(F.count("*").alias("_all"))
    most = max(together, part_records)
    # of n records at most n / most such hashes; without any, adaptive execution drops what is for them
    large = F.broadcast(counts.where(F.col("_all") > most).select("_h"))
    few, many = rows.join(large, "_h", "left_anti"), rows.join(large, "_h", "left_semi")
    nested = _listed(few, key, part_records).unionByName(_numbered(many, key, part_records))
    known = datasets.join(identities.select("IdentityId").distinct(), "IdentityId", "left_semi")
    lists = F.transform("_r", lambda r: F.struct(*[r[f].alias(f) for f in fields]))
    # every dataset has a first part, with or without records; a dataset without a name has no records to meet
    named = known.where("DatasetName IS NOT NULL").withColumn("_h", hashed)
    found = named.join(nested.withColumn("DatasetRecords", lists).drop("_r"), key, "left").drop("_h")
    empty = F.array().cast(found.schema["DatasetRecords"].dataType)
    return found.withColumns({
        "part": F.coalesce("part", F.lit(0).cast("bigint")), "parts": F.coalesce("parts", F.lit(1).cast("bigint")),
        "DatasetRecords": F.coalesce("DatasetRecords", empty)})


def _listed(rows: DataFrame, key: list[str], part_records: int) -> DataFrame:
    """Parts of datasets that are small enough to be a list each: (key, part, parts, _r). Their rows are shuffled once."""
    every = F.collect_list(F.struct("_spread", "_r"))
    # the order by spread tells the parts; a single part has its own below
    lists = rows.groupBy(*key).agg(F.when(F.count("*") > part_records, F.sort_array(every)).otherwise(every).alias("_l"))
    count = F.ceil(F.size("_l") / part_records).cast("bigint")
    cut = F.transform(F.sequence(F.lit(0).cast("bigint"), count - 1), lambda p: F.struct(
        p.alias("part"), F.slice("_l", (p * part_records + 1).cast("int"), part_records)["_r"].alias("_r")))
    parts = lists.select(*key, count.alias("parts"), F.explode(cut).alias("_p"))
    return parts.select(*key, "_p.part", "parts", F.sort_array("_p._r").alias("_r"))


def _numbered(placed: DataFrame, key: list[str], part_records: int) -> DataFrame:
    """Parts of large datasets, as ``_listed`` gives them. Their records are numbered spread by spread."""
    # a record's place in its dataset: those of lower spreads, and the lower keys of its own
    dataset = Window.partitionBy(*key)
    before = dataset.orderBy("_spread").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = (
        placed.groupBy(*key, "_spread").agg(F.count("*").alias("_n"))
        .withColumns({"_before": F.sum("_n").over(before) - F.col("_n"), "_all": F.sum("_n").over(dataset)})
        .select(*key, "_spread", "_before", "_all"))
    inside = Window.partitionBy(*key, "_spread").orderBy("_r")
    # every row has its count; an inner join would test for nulls below the shuffle, which it could then not share
    numbered = placed.withColumn("_i", F.row_number().over(inside) - 1).join(counts, [*key, "_spread"], "left")
    listed = numbered.select(
        *key, F.floor((F.col("_before") + F.col("_i")) / part_records).cast("bigint").alias("part"),
        F.ceil(F.col("_all") / part_records).cast("bigint").alias("parts"), "_r")
    return listed.groupBy(*key, "part").agg(F.max("parts").alias("parts"), F.sort_array(F.collect_list("_r")).alias("_r"))
