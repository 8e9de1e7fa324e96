"""Target-distribution importance resampling: documents are drawn by how much their n-grams look like a target's.

Features are all runs of 1 to ``max_words`` consecutive words, each in one of ``buckets`` by the CRC-32 of its UTF-8 bytes. The corpus and the
target are counted per bucket; a bucket's gain is the scaled, rounded-down logarithm of the ratio of its smoothed shares. A document's weight
is the sum of its features' gains. A keyed Gumbel draw is added to it, and the highest scores are taken: sampling without replacement
in proportion to the exponential weights, the same in every run.

Within a task an open-addressed table interns the n-grams of a batch: keys are XXH64, a slot that is taken is accepted only if length and bytes agree
too, otherwise the next one is tried. A slot holds its n-gram's bucket and count; occurrences keep their slot, through which they gather gains.
Batches are cut into pieces of ``PIECE`` bytes, also within a text, so the table is bounded.

What reaches the driver: one number per bucket and side, and one row per partition. Ranks come from a range-partitioned sort.

Defined results: a null, empty or wordless text has no features and weight 0; a null ``doc_id`` draws like the empty text and comes last among
ties; repeated rows count and are drawn each for itself; an empty target gives gains by the corpus alone; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threatsieve.llm.shared import batch_of, pieces_of, stored, texts_of

MAX_WORDS = 1
BUCKETS = 10_000
SCALE = 1000
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
PIECE = 1 << 20
# Words are ASCII digits and letters and all that is not ASCII; texts are lower-cased (A-Z) before.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_GAP = re.compile(rb"[^0-9a-z\x80-\xff]")


class NgramTable:
    """Open-addressed table of the distinct byte strings among the spans ``start, start + length`` of ``data``.

    ``slots`` has the slot of every span; ``owner`` the span that a slot was taken by, or -1. ``bucket`` and ``count`` belong to slots.
    ``keys`` are spread over the slots by their low bits; equal keys of different strings do no harm.
    """

    def __init__(self, data: bytes, start: np.ndarray, length: np.ndarray, keys: np.ndarray, buckets: int) -> None:
        self.flat, self.start, self.length = np.frombuffer(data, np.uint8), start, length
        size = 1 << max(4, int(2 * len(keys) - 1).bit_length()) if len(keys) else 16
        self.owner = np.full(size, -1, np.int64)
        self.slots = (keys & np.uint64(size - 1)).astype(np.int64)
        left = np.arange(len(keys))
        while len(left):
            slot = self.slots[left]
            free = self.owner[slot] < 0
            self.owner[slot[free]] = left[free]  # where several spans want a slot, the last one has it
            holder = self.owner[slot]
            same = (keys[holder] == keys[left]) & (length[holder] == length[left])
            same[same] = self._same_bytes(left[same], holder[same])
            left = left[~same]
            self.slots[left] = (self.slots[left] + 1) & (size - 1)
        self.count = np.bincount(self.slots, minlength=size)
        self.bucket = np.zeros(size, np.int64)
        for slot in np.flatnonzero(self.owner >= 0):
            at = start[self.owner[slot]]
            self.bucket[slot] = zlib.crc32(data[at : at + length[self.owner[slot]]]) % buckets

    def _same_bytes(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether spans of equal lengths hold equal bytes."""
        same = left == right
        other = np.flatnonzero(~same)
        size = self.length[left[other]]
        first = np.cumsum(size) - size
        within = np.arange(size.sum()) - np.repeat(first, size)
        equal = self.flat[np.repeat(self.start[left[other]], size) + within] == self.flat[np.repeat(self.start[right[other]], size) + within]
        if len(other):
            same[other] = np.logical_and.reduceat(equal, first)  # no span is empty
        return same


def spans_of(pieces: list[tuple[int, list[bytes], int]], max_words: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``data, start, length, words, number`` of every n-gram: spans of ``data``, with how many words and in which text.

    A piece is a text's number, some of its words, and how many of these, at the start, were in the piece before it too: n-grams
    that end in them are not given again.
    """
    data = [w for _, words, _ in pieces for w in words]
    sizes = [len(words) for _, words, _ in pieces]
    piece = np.repeat(np.arange(len(pieces)), sizes)
    number = np.repeat(np.array([n for n, _, _ in pieces], np.int64), sizes)
    new = np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes) >= np.repeat([again for _, _, again in pieces], sizes)
    size = np.fromiter(map(len, data), np.int64, len(data))
    end = np.cumsum(size + 1) - 1
    begin = end - size
    out = []
    for n in range(1, max_words + 1):
        last = np.arange(n - 1, len(data))
        last = last[new[last] & (piece[last - n + 1] == piece[last])]
        first = last - n + 1
        out.append((begin[first], end[last] - begin[first], np.full(len(first), n), number[first]))
    return b" ".join(data), *[np.concatenate(x) for x in zip(*out, strict=True)]


def _lots(texts: list[bytes], max_words: int) -> Iterator[list[tuple[int, list[bytes], int]]]:
    """The pieces of texts, for ``spans_of``, in lists of about ``PIECE`` bytes."""
    held: list[tuple[int, list[bytes], int]] = []
    size, of, tail = 0, -1, []
    for number, piece in pieces_of((t.lower() for t in texts), PIECE, _GAP):
        again = tail if number == of else []
        words = again + _WORD.findall(piece)
        held.append((number, words, len(again)))
        of, tail = number, words[max(0, len(words) - max_words + 1) :]
        size += len(piece)
        if size >= PIECE:
            yield held
            held, size = [], 0
    if held:
        yield held


def _tables(texts: list[bytes], max_words: int, buckets: int) -> Iterator[tuple[NgramTable, np.ndarray, np.ndarray]]:
    """A table per lot of texts, with the words and the text of each of its spans."""
    digest = xxhash.xxh64_intdigest
    for lot in _lots(texts, max_words):
        data, start, length, words, number = spans_of(lot, max_words)
        ends = (start + length).tolist()
        keys = np.fromiter((digest(data[a:b]) for a, b in zip(start.tolist(), ends, strict=True)), np.uint64, len(ends))
        yield NgramTable(data, start, length, keys, buckets), words, number


def bucket_counts(texts: DataFrame, max_words: int = MAX_WORDS, buckets: int = BUCKETS) -> list[int]:
    """How many features of all texts fall into each bucket."""
    schema = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for table, _, _ in _tables(texts_of(batch["text"]), max_words, buckets):
                np.add.at(total, table.bucket, table.count)
        held = np.flatnonzero(total)
        yield batch_of(schema, bucket=held, n=total[held])

    found = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "bucket int, n long")
    out = [0] * buckets
    for bucket, n in found.groupBy("bucket").agg(F.sum("n")).collect():  # as many as there are buckets
        out[bucket] = n
    return out


def gains_of(corpus: list[int], target: list[int], scale: int = SCALE) -> np.ndarray:
    """The gain of every bucket."""
    source, wanted, n = float(sum(corpus)), float(sum(target)), len(corpus)
    pairs = zip(map(float, corpus), map(float, target), strict=True)
    return np.array([math.floor(scale * math.log((t + 1) * (source + n) / ((s + 1) * (wanted + n)))) for s, t in pairs], np.int64)


def draw_of(doc_id: int | None, seed: int = SEED, scale: int = SCALE) -> int:
    """The keyed Gumbel draw of a document, scaled and rounded down."""
    text = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(text.encode()).hexdigest()[:8], 16)
    return math.floor(-scale * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gains: np.ndarray, max_words: int = MAX_WORDS, seed: int = SEED, scale: int = SCALE) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` of every row."""
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "n_words", "n_features", "weight", "score")])

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            words, features, weight = (np.zeros(n, np.int64) for _ in range(3))
            for table, size, number in _tables(texts_of(batch["text"]), max_words, len(gains)):
                words += np.bincount(number[size == 1], minlength=n)
                features += np.bincount(number, minlength=n)
                np.add.at(weight, number, gains[table.bucket[table.slots]])
            ids = batch["doc_id"].to_pylist()
            draws = np.fromiter((draw_of(i, seed, scale) for i in ids), np.int64, n)
            yield batch_of(schema, doc_id=ids, n_words=words, n_features=features, weight=weight, score=weight + draws)

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return columns.mapInArrow(score, ", ".join(f"{f.name} long" for f in schema))


def resampled(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, max_words: int = MAX_WORDS,
    buckets: int = BUCKETS, seed: int = SEED,
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every row; ``rank`` of the drawn ``percent`` of those with ``least_words``."""
    gains = gains_of(bucket_counts(docs, max_words, buckets), bucket_counts(target, max_words, buckets))
    rows = stored(scored(docs, gains, max_words, seed).withColumn("fits", F.col("n_words") >= least_words))
    draw = rows.where("fits").count() * percent // 100
    order = [F.col("fits").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    # The id counts rows within each partition, in their order, and partitions follow the order too.
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    dealt = stored(dealt.withColumn("part", F.shiftright("place", 33)).withColumn("place", F.col("place").bitwiseAND((1 << 33) - 1)))
    before, starts = 0, []
    for part, n in sorted(dealt.groupBy("part").count().collect()):  # a row per partition
        starts.append((part, before))
        before += n
    starts = docs.sparkSession.createDataFrame(starts, "part long, before long")
    place = F.col("before") + F.col("place") + 1
    rank = F.when(F.col("fits") & (place <= draw), place).alias("rank")
    return dealt.join(F.broadcast(starts), "part").select("doc_id", "n_words", "n_features", "weight", "score", rank)


def op12_resampling(spark, sf_dir: str) -> DataFrame:
    docs, target = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return resampled(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


ORACLE_SQL = r"""
WITH entries AS (
    SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS entry
), words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), item_words AS (
    SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark
), feature AS (
    SELECT doc_id, unnest(words) AS word FROM words
), counted AS (
    SELECT word, sum(s) AS s, sum(t) AS t FROM (
        SELECT word, count(*) AS s, 0 AS t FROM feature GROUP BY word UNION ALL SELECT word, 0, count(*) FROM item_words GROUP BY word
    ) GROUP BY word
), hexed AS (
    SELECT word, s, t, hex(encode(word)) AS h FROM counted
), hashed AS (
    SELECT word, s, t, xor(list_reduce(list_prepend(4294967295, list_transform(range(length(h) // 2), lambda i: CAST('0x' || substr(h, CAST(2 * i + 1 AS INTEGER), 2) AS BIGINT))),
        lambda c, b: xor(c >> 8, entry[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket FROM hexed, entries
), bucketed AS (
    SELECT bucket, sum(s) AS s, sum(t) AS t FROM hashed GROUP BY bucket
), totals AS (
    SELECT CAST(sum(s) AS DOUBLE) AS s_all, CAST(sum(t) AS DOUBLE) AS t_all FROM bucketed
), gain AS (
    SELECT bucket, CAST(floor(1000 * ln((CAST(t AS DOUBLE) + 1) * (s_all + 10000) / ((CAST(s AS DOUBLE) + 1) * (t_all + 10000)))) AS BIGINT) AS gain
    FROM bucketed, totals
), weighed AS (
    SELECT doc_id, CAST(sum(gain) AS BIGINT) AS weight FROM feature JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY doc_id
), score AS (
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
    FROM words LEFT JOIN weighed USING (doc_id)
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
        count(*) FILTER (n_features >= 20) OVER () AS n FROM score
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank FROM placed
"""
