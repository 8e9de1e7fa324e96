"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked by a generalised pigeonhole search.

The 64 bits are dealt into partitions so that correlated bits share one. A pair that differs in at most
``distance`` bits must, for any thresholds with ``sum(threshold + 1) = distance + 1``, differ in at most
its threshold in some partition. The thresholds come from a dynamic programme on the number of rows
that would meet, counted over all fingerprints. Rows meet by partition value and are verified in full.

Defined results: a null or wordless text has fingerprint 0 and is linked like any other; texts with
fewer words than a shingle hash their whole word sequence; a null ``doc_id`` takes part but is no
component id unless nothing else is in its component; repeated rows give repeated rows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threatsieve.llm.shared import batch_of, blocked, components, stored, texts_of, unite, whole_groups

BITS = 64
PARTITIONS = 4
SLICE = 1 << 15
BLOCK_ROWS = 4096
TILE = 1024


def fingerprint(text: bytes, words_per_shingle: int = 3) -> int:
    """The fingerprint of one UTF-8 text as an unsigned integer."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda a, b: a + b + 1))
    last = max(0, len(words) - words_per_shingle)
    starts = [0, *(e + 1 for e in ends[:last])]
    ends = ends[-len(starts):] if last else [len(joined)]
    digest = xxhash.xxh64_intdigest
    total = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), SLICE):
        part = zip(starts[at : at + SLICE], ends[at : at + SLICE], strict=True)
        hashes = np.array([digest(joined[a:b], 42) for a, b in part], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > len(starts), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words_per_shingle: int = 3) -> DataFrame:
    """``doc_id, text_hash, fp`` of every row; ``fp`` holds the 64 bits as a signed long."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t, words_per_shingle) for t in texts_of(batch["text"])]
            signed = np.array(found, np.uint64).view(np.int64)
            columns = [batch["doc_id"], batch["text_hash"], pa.array(signed)]
            yield pa.record_batch(columns, ["doc_id", "text_hash", "fp"])

    text = F.col("text").cast("string")
    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    return columns.mapInArrow(run, "doc_id long, text_hash long, fp long")


def bits_of(values: np.ndarray) -> np.ndarray:
    """One row of 64 zeros and ones per value, lowest bit first."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8)
    return np.unpackbits(raw, axis=1, bitorder="little")


def part_values(values: np.ndarray, bits: list[int]) -> np.ndarray:
    """The chosen bits of each value as a small number."""
    values = values.view(np.uint64)
    out = np.zeros(len(values), np.int64)
    for place, bit in enumerate(bits):
        out |= ((values >> np.uint64(bit)) & np.uint64(1)).astype(np.int64) << place
    return out


def correlated_partitions(distinct: DataFrame, partitions: int) -> list[list[int]]:
    """Deals the bits out so that those which vary together, over all fingerprints, share a partition."""
    schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("n", pa.int64())])
    rows, columns = np.divmod(np.arange((BITS + 1) ** 2, dtype=np.int32), BITS + 1)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.zeros((BITS + 1, BITS + 1), np.int64)
        for batch in batches:
            values = batch["fp"].to_numpy()
            for at in range(0, len(values), SLICE):
                bits = bits_of(values[at : at + SLICE]).astype(np.float32)
                bits = np.hstack([bits, np.ones((len(bits), 1), np.float32)])
                both += (bits.T @ bits).astype(np.int64)
        yield batch_of(schema, i=rows, j=columns, n=both.ravel())

    sums = distinct.select("fp").mapInArrow(count, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n"))
    both = np.zeros((BITS + 1, BITS + 1))
    for i, j, n in sums.collect():  # 65 x 65 numbers at any size
        both[i, j] = n
    total = max(both[BITS, BITS], 1.0)
    mean = both[BITS, :BITS] / total
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    tie = np.abs((both[:BITS, :BITS] / total - np.outer(mean, mean)) / np.outer(spread, spread))
    left, out = list(range(BITS)), []
    width = -(-BITS // partitions)
    while left:
        seed = max(left, key=lambda b: (tie[b, left].sum(), -b))
        chosen = [seed]
        left.remove(seed)
        while left and len(chosen) < width:
            bit = max(left, key=lambda b: (tie[b, chosen].sum(), -b))
            chosen.append(bit)
            left.remove(bit)
        out.append(sorted(chosen))
    return out


def masks_within(width: int, distance: int) -> list[int]:
    """Every pattern of at most ``distance`` flipped bits out of ``width``."""
    found = [0]
    for _ in range(distance):
        found = sorted({m for m in found} | {m ^ (1 << b) for m in found for b in range(width)})
    return found


def thresholds(distinct: DataFrame, parts: list[list[int]], distance: int) -> list[int]:
    """The cheapest thresholds, one per partition; -1 leaves a partition out.

    A partition's cost at a threshold is the rows sent plus the pairs that meet, from the counts of its
    values over all fingerprints (at most ``2 ** width`` numbers per partition).
    """
    schema = pa.schema([("part", pa.int32()), ("value", pa.int64())])

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch["fp"].to_numpy()
            for part, bits in enumerate(parts):
                yield batch_of(schema, part=np.full(len(values), part), value=part_values(values, bits))

    counts = distinct.select("fp").mapInArrow(split, "part int, value long").groupBy("part", "value").count()
    tables = [np.zeros(1 << len(bits)) for bits in parts]
    for part, value, n in counts.collect():
        tables[part][value] = n
    cost = []
    for bits, table in zip(parts, tables, strict=True):
        places = np.arange(len(table))
        row, meeting, before = [0.0], 0.0, set()
        for limit in range(distance + 1):
            masks = set(masks_within(len(bits), limit))
            meeting += sum(float(table @ table[places ^ m]) for m in masks - before) if len(masks) < 200 else 1e18
            before = masks
            row.append(table.sum() * len(masks) * 20 + meeting / 2)
        cost.append(row)
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in cost:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (so_far, chosen) in best.items():
            for units in range(distance + 2 - used):
                option = (so_far + row[units], [*chosen, units - 1])
                if used + units not in step or option < step[used + units]:
                    step[used + units] = option
        best = step
    return best[distance + 1][1]


def linked_within(left: np.ndarray, right: np.ndarray | None, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """``node, root`` rows that connect what is linked; within ``left``, or between it and ``right``."""
    nodes = left if right is None else np.concatenate([left, right])
    parents = np.arange(len(nodes))
    shift = 0 if right is None else len(left)
    across = left if right is None else right
    for a in range(0, len(left), TILE):
        for b in range(a if right is None else 0, len(across), TILE):
            far = np.bitwise_count(left[a : a + TILE, None] ^ across[None, b : b + TILE])
            i, j = np.nonzero(far <= distance)
            unite(parents, i + a, j + b + shift)
    moved = np.flatnonzero(parents != np.arange(len(nodes)))
    return nodes[moved].view(np.int64), nodes[parents[moved]].view(np.int64)


def links(distinct: DataFrame, distance: int = 3, partitions: int = PARTITIONS) -> DataFrame:
    """Edges ``a, b`` between fingerprints that connect all pairs within ``distance``, and no others.

    Not every pair is an edge: within a piece of a group each linked fingerprint points to one other.
    """
    parts = correlated_partitions(distinct, partitions)
    limits = thresholds(distinct, parts, distance)
    schema = pa.schema([("part", pa.int32()), ("value", pa.int64()), ("fp", pa.int64())])

    def probes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch["fp"].to_numpy()
            for part, (bits, limit) in enumerate(zip(parts, limits, strict=True)):
                own = part_values(values, bits)
                for mask in masks_within(len(bits), limit) if limit >= 0 else ():
                    yield batch_of(schema, part=np.full(len(own), part), value=own ^ mask, fp=values)

    edge = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    keys = ["part", "value", "block_a", "block_b"]

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in whole_groups(batches, keys):
            if group.num_rows < 2:
                continue
            values = group["fp"].to_numpy().view(np.uint64)
            a, b = group["block_a"][0].as_py(), group["block_b"][0].as_py()
            if a == b:
                node, root = linked_within(values, None, distance)
            else:
                first = group["block"].to_numpy() == a
                node, root = linked_within(values[first], values[~first], distance)
            if len(node):
                yield batch_of(edge, a=node, b=root)

    rows = distinct.select("fp").mapInArrow(probes, "part int, value long, fp long")
    met = blocked(rows, ["part", "value"], "fp", BLOCK_ROWS)
    return met.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(verify, "a long, b long")


def _grouped(
    docs: DataFrame, distance: int, words_per_shingle: int, partitions: int
) -> tuple[DataFrame, DataFrame]:
    """The fingerprint of every row, and ``fp, component`` of every fingerprint."""
    marked = stored(fingerprints(docs, words_per_shingle))
    distinct = stored(marked.select("fp").distinct())
    of_fp = components(links(distinct, distance, partitions)).withColumnRenamed("node", "fp")
    member = distinct.join(of_fp, "fp", "left")
    return marked, stored(member.select("fp", F.coalesce("component", "fp").alias("component")))


def near_duplicates(
    docs: DataFrame, distance: int = 3, words_per_shingle: int = 3, partitions: int = PARTITIONS
) -> DataFrame:
    """``doc_id, fp, component_id`` of every row of ``docs``."""
    marked, member = _grouped(docs, distance, words_per_shingle, partitions)
    first = marked.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    ids = first.join(member, "fp").groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = member.join(ids, "component").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def one_per_group(
    docs: DataFrame, distance: int = 3, words_per_shingle: int = 3, partitions: int = PARTITIONS
) -> DataFrame:
    """One row of each group of near copies, with all its columns: the smallest id's, null last; equal rows are one."""
    marked, member = _grouped(docs, distance, words_per_shingle, partitions)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first")
    chosen = marked.groupBy("fp").agg(first).join(member, "fp").groupBy("component").agg(F.min("first").alias("first"))
    chosen = chosen.select(F.col("first.doc_id").alias("chosen_id"), F.col("first.text_hash").alias("chosen_hash"))
    text_hash = F.xxhash64(F.col("text").cast("string")).alias("text_hash")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text_hash)
    same = F.col("doc_id").eqNullSafe(F.col("chosen_id")) & (F.col("text_hash") == F.col("chosen_hash"))
    return rows.join(chosen, same).dropDuplicates(["chosen_id", "chosen_hash"]).select("row.*")


def op5_simhash(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return near_duplicates(docs).select("doc_id", digits.alias("fingerprint"), "component_id")
