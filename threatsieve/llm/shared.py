"""What several operators need: tables cut from their lineage, sorted groups, links, components."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder all machines share: ``spark.checkpoint.dir``; on one machine also one in the warehouse, where it is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    return folder.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again: later work does not depend on how it came about."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of each text, a null as an empty text."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def pieces_of(texts: Iterable[bytes], most: int, gap: re.Pattern[bytes]) -> Iterator[tuple[int, bytes]]:
    """``number, piece`` of every text, in order: pieces of about ``most`` bytes, cut only where ``gap`` matches."""
    for number, text in enumerate(texts):
        at = 0
        while len(text) - at > most:
            found = gap.search(text, at + most)
            if not found:
                break
            yield number, text[at : found.start()]
            at = found.start()
        yield number, text[at:]


def batch_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """A batch with the columns in the order of ``schema``."""
    return pa.record_batch([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def starts_of(table: pa.Table, keys: Iterable[str]) -> np.ndarray:
    """First row of each run of equal, non-null integer keys."""
    rows = table.num_rows
    new = np.zeros(rows, bool)
    new[:1] = True
    for key in keys:
        values = table[key].to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Cuts rows that are sorted by ``keys`` into one table per group; holds one group and one batch."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        starts = starts_of(pa.Table.from_batches([batch]), keys)
        if held and any(held[0][k][0].as_py() != batch[k][0].as_py() for k in keys):
            yield pa.Table.from_batches(held)
            held = []
        for start, end in zip(starts[:-1], starts[1:], strict=True):
            yield pa.Table.from_batches([*held, batch.slice(start, end - start)])
            held = []
        held.append(batch.slice(starts[-1]))
    if held:
        yield pa.Table.from_batches(held)


def unite(parents: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Joins the trees of each ``left`` and ``right`` node; every parent ends as its tree's smallest node."""
    while len(left):
        a, b = parents[left], parents[right]
        apart = a != b
        if not apart.any():
            return
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        np.minimum.at(parents, np.maximum(a, b), np.minimum(a, b))
        while True:
            above = parents[parents]
            if np.array_equal(above, parents):
                break
            parents[:] = above


def blocked(rows: DataFrame, keys: list[str], item: str, block_rows: int) -> DataFrame:
    """Rows for comparing all pairs within each key in pieces of at most about twice ``block_rows`` rows.

    Keys with one row go. A key's rows are dealt over blocks by a hash of ``item``; each row is given
    once for every pair of blocks that its own is part of, as ``block_a <= block_b`` with ``block``
    its own. Pairs within a block meet in ``(block, block)``, others in their pair of blocks.
    """
    counts = rows.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1")
    dealt = rows.join(counts, keys).withColumn("_blocks", F.ceil(F.col("_n") / block_rows).cast("int"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64(item), F.col("_blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    dealt = dealt.withColumn("_other", other)
    pair = [F.least("block", "_other").alias("block_a"), F.greatest("block", "_other").alias("block_b")]
    return dealt.select(*rows.columns, "block", *pair)


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` of every node on ``edges`` (``a, b``): the smallest node it is connected to.

    Alternates large-star and small-star steps. Each step needs only a minimum per node, which is
    aggregated before it is shuffled, so a node with very many edges does not gather in one task.
    Both columns are longs; nulls and edges from a node to itself are ignored.
    """
    current = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    before = None
    while True:
        state = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return current.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = state
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        current = stored(hung.union(least.select("u", F.col("m").alias("v"))).distinct())
