"""Embedding near-duplicates: quantised tile products with error bounds, exact where they leave a doubt.

Each vector is scaled to length one and quantised to signed bytes with a step of its own. For unit
vectors ``x = sx * qx + dx`` the product ``x . y`` differs from ``sx * sy * (qx . qy)`` by at most
``|dx| + (1 + |dx|) * |dy|``, which is worked out per vector, so a tile product of small integers rules
out every pair that cannot reach the threshold. The rest is computed again in double precision.

Equal vectors are compared once. Distinct vectors are dealt into blocks of bounded size around pivots
(one vector in ``BLOCK_ROWS``, ``MAX_PIVOTS`` at most, chosen by a hash); a vector is sent to the blocks that a pair of it can be
in by the triangle inequality on angles, and pairs of blocks are compared tile by tile. Tasks return
counts per vector and a spanning forest, not the pairs.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with
nothing (``n_links`` 0, component their own id); vectors of different length link with nothing of another
length; rows that repeat a ``vec_id`` each give a row, and count as one node of the links; a null
``vec_id`` takes part, gets its links counted, and its component is the smallest id of its component or null; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threatsieve.llm.shared import batch_of, components, stored, unite, whole_groups

BLOCK_ROWS = 8192
# What every task holds of them is bounded; cells around fewer pivots are cut into more blocks.
MAX_PIVOTS = 512
TILE = 1024
EXACT_PAIRS = 1 << 15
# Whole numbers below 2 ** 24 are exact in single precision: 127 * 127 * 1024 is.
EXACT_WIDTH = 1024
SLACK = 1e-9


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signed bytes, step and error length of each unit vector."""
    step = np.abs(unit).max(axis=1) / 127.0
    small = np.rint(unit / step[:, None]).astype(np.int8)
    error = np.linalg.norm(unit - small * step[:, None], axis=1)
    return small, step, error


def integer_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """All products of two sets of byte vectors, exact."""
    out = np.zeros((len(left), len(right)), np.float64)
    for at in range(0, left.shape[1], EXACT_WIDTH):
        a, b = left[:, at : at + EXACT_WIDTH], right[:, at : at + EXACT_WIDTH]
        out += a.astype(np.float32) @ b.astype(np.float32).T
    return out


class Block:
    """The vectors of one block: raw in double precision, and quantised."""

    def __init__(self, raw: np.ndarray, copies: np.ndarray) -> None:
        self.raw, self.copies = raw, copies
        self.norm = np.sqrt(np.einsum("ij,ij->i", raw, raw))
        self.small, self.step, self.error = quantised(raw / self.norm[:, None])


def possible(left: Block, a: slice, right: Block, b: slice, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of the tile that may reach the threshold by the error bounds."""
    about = integer_products(left.small[a], right.small[b]) * left.step[a, None] * right.step[None, b]
    dx, dy = left.error[a, None], right.error[None, b]
    return np.nonzero(about + (dx + (1 + dx) * dy) >= threshold - SLACK)


def tile_links(left: Block, right: Block, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs with a cosine of at least ``threshold``, a piece at a time; each pair once."""
    for at in range(0, len(left.raw), TILE):
        for bt in range(at if same else 0, len(right.raw), TILE):
            i, j = possible(left, slice(at, at + TILE), right, slice(bt, bt + TILE), threshold)
            i, j = i + at, j + bt
            if same:
                i, j = i[i < j], j[i < j]
            for p in range(0, len(i), EXACT_PAIRS):
                x, y = i[p : p + EXACT_PAIRS], j[p : p + EXACT_PAIRS]
                cosine = np.einsum("ij,ij->i", left.raw[x], right.raw[y]) / (left.norm[x] * right.norm[y])
                sure = cosine >= threshold
                yield x[sure], y[sure]


def block_links(left: Block, right: Block | None, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Linked copies per vector, and each vector's root, over ``left`` then ``right``."""
    same, other = right is None, left if right is None else right
    shift = 0 if same else len(left.raw)
    copies = left.copies if same else np.concatenate([left.copies, other.copies])
    count, parents = np.zeros(len(copies), np.int64), np.arange(len(copies))
    for i, j in tile_links(left, other, threshold, same):
        j = j + shift
        np.add.at(count, i, copies[j])
        np.add.at(count, j, copies[i])
        unite(parents, i, j)
    return count, parents


def _angles(unit: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(unit @ pivots.T, -1.0, 1.0))


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """``k1, k2, node, copies, embedding``: each usable vector once, with its smallest id and its rows."""
    usable = "size(embedding) > 0 AND exists(embedding, x -> x <> 0) AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
    keyed = rows.where(usable).groupBy("k1", "k2").agg(
        F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"), F.first("embedding").alias("embedding")
    )
    # A vector without an id needs a name of its own in the links; ids are never that far below zero.
    unnamed = F.lit(-(1 << 62)) + F.shiftrightunsigned("k1", 3)
    return keyed.withColumn("node", F.coalesce("vec_id", unnamed))


def _placed(vectors: DataFrame, threshold: float, block_rows: int) -> DataFrame:
    """Each vector once for every pair of blocks in which it can have a link."""
    wide = isinstance(vectors.schema["embedding"].dataType.elementType, T.DoubleType)
    kind = np.float64 if wide else np.float32
    n = vectors.count()
    wanted = min(-(-n // block_rows), MAX_PIVOTS)
    chosen = vectors.orderBy(F.xxhash64("node")).limit(wanted).select("embedding").collect() if wanted > 1 else []
    by_width: dict[int, np.ndarray] = {}
    for row in chosen:  # one vector in BLOCK_ROWS, MAX_PIVOTS at most
        unit = np.array(row[0], np.float64)
        unit /= np.sqrt(unit @ unit)
        by_width[len(unit)] = np.vstack([by_width.get(len(unit), np.empty((0, len(unit)))), unit])

    def units(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Row numbers and raw vectors of each length."""
        column = batch["embedding"]
        lengths = column.value_lengths().to_numpy(zero_copy_only=False)
        for width in np.unique(lengths):
            at = np.flatnonzero(lengths == width)
            flat = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
            yield at, flat.astype(kind).reshape(len(at), width)

    def unit(raw: np.ndarray) -> np.ndarray:
        raw = raw.astype(np.float64)
        return raw / np.sqrt(np.einsum("ij,ij->i", raw, raw))[:, None]

    celled = pa.schema([
        ("node", pa.int64()), ("copies", pa.int64()), ("width", pa.int32()), ("cell", pa.int32()), ("angle", pa.float64()), ("raw", pa.binary()),
    ])

    def cells(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, copies = batch["node"].to_numpy(), batch["copies"].to_numpy()
            for at, raw in units(batch):
                pivots = by_width.get(raw.shape[1])
                cell, angle = np.zeros(len(at), np.int32), np.full(len(at), np.pi)
                if pivots is not None:
                    angles = _angles(unit(raw), pivots)
                    cell = angles.argmin(axis=1)
                    angle = angles[np.arange(len(at)), cell]
                yield batch_of(
                    celled, node=node[at], copies=copies[at], width=np.full(len(at), raw.shape[1]), cell=cell,
                    angle=angle, raw=[r.tobytes() for r in raw],
                )

    shape = "node long, copies long, width int, cell int, angle double, raw binary"
    placed = stored(vectors.select("node", "copies", "embedding").mapInArrow(cells, shape))
    sizes = placed.groupBy("width", "cell").agg(F.count("*").alias("n"), F.max("angle").alias("reach")).collect()
    first, blocks_of, reach, offset = {}, {}, {}, 0
    for width, cell, rows, far in sorted(sizes):  # one row per pivot
        first[width, cell], blocks_of[width, cell], reach[width, cell] = offset, -(-rows // block_rows), far
        offset += blocks_of[width, cell]
    widths = {w: sorted(c for v, c in first if v == w) for w, _ in first}
    near = float(np.arccos(np.clip(threshold, -1, 1))) + 1e-6
    paired = pa.schema([
        ("block_a", pa.int64()), ("block_b", pa.int64()), ("block", pa.int64()), ("node", pa.int64()), ("copies", pa.int64()), ("width", pa.int32()), ("raw", pa.binary()),
    ])

    def pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = {k: batch[k].to_numpy(zero_copy_only=False) for k in ("node", "copies", "width", "cell", "salt")}
            for width in np.unique(table["width"]):
                at = np.flatnonzero(table["width"] == width)
                taken = batch["raw"].take(pa.array(at))
                raw = np.frombuffer(b"".join(taken.to_pylist()), kind).reshape(len(at), width)
                pivots = by_width.get(width)
                angles = None if pivots is None else _angles(unit(raw), pivots)
                own = np.array([first[width, c] + s % blocks_of[width, c] for c, s in zip(table["cell"][at], table["salt"][at], strict=True)])
                for cell in widths[width]:
                    meets = table["cell"][at] == cell
                    if angles is not None:
                        meets |= angles[:, cell] <= reach[width, cell] + near
                    rows = np.flatnonzero(meets)
                    for other in range(first[width, cell], first[width, cell] + blocks_of[width, cell]):
                        yield batch_of(
                            paired, block_a=np.minimum(own[rows], other), block_b=np.maximum(own[rows], other),
                            block=own[rows], node=table["node"][at][rows], copies=table["copies"][at][rows],
                            width=np.full(len(rows), width), raw=taken.take(pa.array(rows)),
                        )

    salted = placed.withColumn("salt", F.pmod(F.xxhash64("node", F.lit(1)), F.lit(1 << 30)))
    shape = "block_a long, block_b long, block long, node long, copies long, width int, raw binary"
    return salted.mapInArrow(pairs, shape)


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row (columns ``vec_id``, ``embedding``)."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    rows = rows.withColumn("k1", F.xxhash64("embedding")).withColumn("k2", F.xxhash64(F.lit(7), "embedding"))
    distinct = stored(distinct_vectors(rows))
    wide = isinstance(distinct.schema["embedding"].dataType.elementType, T.DoubleType)
    found = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])
    keys = ["block_a", "block_b"]

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in whole_groups(batches, keys):
            a, b, width = (group[k][0].as_py() for k in ("block_a", "block_b", "width"))
            side = group["block"].to_numpy() == a
            order = np.concatenate([np.flatnonzero(side), np.flatnonzero(~side)])
            group = group.take(pa.array(order))
            raw = np.frombuffer(b"".join(group["raw"].to_pylist()), np.float64 if wide else np.float32)
            raw = raw.reshape(-1, width).astype(np.float64)
            copies, node, split = group["copies"].to_numpy(), group["node"].to_numpy(), int(side.sum())
            left = Block(raw[:split], copies[:split])
            if a != b and split in (0, len(raw)):
                continue
            count, parents = block_links(left, None if a == b else Block(raw[split:], copies[split:]), threshold)
            linked = np.flatnonzero(count)
            if len(linked):
                yield batch_of(found, a=node[linked], b=node[parents[linked]], n=count[linked])

    met = _placed(distinct, threshold, block_rows).repartition(*keys).sortWithinPartitions(*keys)
    links = stored(met.mapInArrow(compare, "a long, b long, n long"))
    counts = links.groupBy("a").agg(F.sum("n").alias("n")).withColumnRenamed("a", "node")
    parts = components(links.select("a", "b"))
    member = distinct.select("k1", "k2", "node", "vec_id", "copies").join(counts, "node", "left").join(parts, "node", "left")
    member = stored(member.withColumn("component", F.coalesce("component", "node")))
    names = member.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    n_links = (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("links")
    member = member.join(names, "component").select("k1", "k2", n_links, "component_id")
    out = rows.select("vec_id", "k1", "k2").join(member, ["k1", "k2"], "left")
    return out.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        (F.col("vec_id") == F.coalesce("component_id", "vec_id")).alias("kept"),
    )


def op1_embeddings(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE_SQL = """
WITH RECURSIVE v AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
), ok AS (
    SELECT * FROM v WHERE len(list_filter(x, lambda e: e IS NULL OR isnan(e) OR isinf(e))) = 0
        AND len(list_filter(x, lambda e: e <> 0)) > 0
), link AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b
        ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.9
), reach AS (
    SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), part AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
counted AS (SELECT a AS vec_id, count(*) AS n FROM link GROUP BY a)
SELECT v.vec_id, coalesce(n, 0) AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN part USING (vec_id) LEFT JOIN counted USING (vec_id)
"""
