"""Benchmark decontamination by spaced seeds: joins hashes that skip some words, verifies around the hits.

A document is contaminated by an item if, laid against it at some offset, a run of ``window`` words of
the item (the whole item, if shorter) has at least ``similarity`` of its words equal. Each mask hashes
the words at its ones; the three masks below together hit every such run of 10 or more words (a test
walks all patterns). Items of five to nine words must match whole; shorter ones mark nothing.

Words are runs of letters and digits of the lower-cased text. Everything is DataFrame expressions; words
are carried as 64-bit hashes.

Defined results: null and empty texts match nothing; rows that share a ``doc_id`` (null included) share
their verdict, likewise ``item_id``; repeated items give the same matches; a row per document and item however often it matches;
empty tables give an empty result (and ``drop_contaminated`` the documents as they are); other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MASKS = ("111011", "11111", "11010011")
# Items shorter than this must match whole.
SHORT = 10
LEAST = 5
# The first two masks do where all items have this many words; the third is for items of 10 to 14.
BRIEF = 15
LONG_MASKS = (0, 1)
# The benchmark's side is sent to all tasks up to this many seeds, and shuffled beyond.
BROADCAST_SEEDS = 1_000_000


def words_of(text: Column) -> Column:
    """The words of a text, each as a hash."""
    words = F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def seeds_at(words: Column, at: Column, masks: Sequence[int]) -> list[Column]:
    """One hash per mask of the words from place ``at`` on; null where a mask runs over the end."""
    found = []
    for number in masks:
        picked = [F.get(words, at + F.lit(k)) for k, bit in enumerate(MASKS[number]) if bit == "1"]
        found.append(F.when(picked[-1].isNotNull(), F.xxhash64(F.lit(number), *picked)))
    return found


def _seeded(table: DataFrame, words: str, at: str, masks: Sequence[int], *carried: str) -> DataFrame:
    """A row per place and mask of ``table``'s word lists, with its seed."""
    # The outer form keeps Spark from testing the list's size below, which would make the list twice.
    places = table.select(*carried, words, F.posexplode_outer(words).alias(at, "_word"))
    seeds = F.explode(F.array(*seeds_at(F.col(words), F.col(at), masks))).alias("seed")
    return places.select(*carried, words, at, seeds).where("seed IS NOT NULL")


def _most_equal(run: Column, needed: Column) -> Column:
    """Most equal words in ``run`` consecutive places of ``near_item``; worked out where all together suffice."""
    equal = F.transform(
        F.col("near_item"),
        lambda word, i: F.when(F.get(F.col("near_doc"), i - F.col("lead")) == word, 1).otherwise(0),
    )
    total = F.aggregate(equal, F.lit(0), lambda a, x: a + x)
    starts = F.sequence(F.lit(1), F.greatest(F.size("near_item") - run + 1, F.lit(1)))
    sums = F.transform(starts, lambda s: F.aggregate(F.slice(equal, s, run), F.lit(0), lambda a, x: a + x))
    return F.when(total >= needed, F.array_max(sums))


def _met(rows: DataFrame, seeds: DataFrame, texts: DataFrame, items: DataFrame) -> DataFrame:
    """Rows and seeds that are equal, with both word lists.

    While the benchmark's seeds are few they are broadcast, and rows keep their lists. Beyond that only places are shuffled by seed, and
    those that met fetch the lists of their texts and items, each of which moves once.
    """
    if seeds.limit(BROADCAST_SEEDS + 1).count() <= BROADCAST_SEEDS:
        return rows.join(F.broadcast(seeds), "seed")
    places = rows.drop("doc").join(seeds.drop("item"), "seed").drop("seed").distinct()
    once = texts.groupBy("doc_id", "doc_key").agg(F.first("doc").alias("doc")).withColumnsRenamed({"doc_id": "_id", "doc_key": "_key"})
    found = places.join(once, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("doc_key") == F.col("_key"))).drop("_id", "_key")
    lists = items.withColumnsRenamed({"item_id": "_id", "item_key": "_key"})
    return found.join(lists, F.col("item_id").eqNullSafe(F.col("_id")) & (F.col("item_key") == F.col("_key"))).drop("_id", "_key")


def matches(docs: DataFrame, benchmark: DataFrame, window: int = 20, similarity: float = 0.8) -> DataFrame:
    """``doc_id, item_id, matched`` of every contaminated document: most equal words in a run."""
    words = words_of(F.col("text").cast("string"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), words.alias("item")).where(F.size("item") >= LEAST)
    items = items.withColumn("item_key", F.xxhash64("item")).distinct()
    masks = LONG_MASKS if items.where(F.size("item") < BRIEF).isEmpty() else range(len(MASKS))
    seeds = _seeded(items, "item", "item_at", masks, "item_id", "item_key")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), words.alias("doc")).withColumn("doc_key", F.xxhash64("doc"))
    rows = _seeded(texts, "doc", "doc_at", masks, "doc_id", "doc_key")
    met = _met(rows, seeds, texts, items)
    # Hits on one diagonal are one up to a piece of the item. What surrounds them is cut out of the lists as
    # soon as they meet, so that a row holds few words however long its text is.
    shift, piece = F.col("doc_at") - F.col("item_at"), F.floor(F.col("item_at") / window).cast("int")
    low = F.greatest((piece - 1) * window, F.lit(0))
    size = window * 3 + max(map(len, MASKS))
    begin = F.greatest(low + shift, F.lit(0))
    hits = met.select(
        "doc_id", "doc_key", "item_id", "item_key", shift.alias("shift"), piece.alias("piece"),
        F.size("item").alias("n"), F.slice("item", low + 1, F.lit(size)).alias("near_item"),
        F.slice("doc", begin + 1, F.lit(size)).alias("near_doc"), (begin - low - shift).alias("lead"),
    )
    same = ["doc_id", "doc_key", "item_id", "item_key", "shift", "piece"]
    hits = hits.groupBy(*same).agg(*[F.first(c).alias(c) for c in ("n", "near_item", "near_doc", "lead")])
    run = F.least("n", F.lit(window))
    allowed = F.when(F.col("n") < SHORT, 0).otherwise(F.floor(run * F.lit(1 - similarity) + F.lit(1e-9)))
    checked = hits.withColumn("needed", (run - allowed).cast("int"))
    checked = checked.select("doc_id", "item_id", "needed", _most_equal(run, F.col("needed")).alias("matched"))
    return checked.where("matched >= needed").groupBy("doc_id", "item_id").agg(F.max("matched").alias("matched"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 20, similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that match no benchmark item, with all their columns."""
    found = matches(docs, benchmark, window, similarity).select(F.col("doc_id").alias("_contaminated")).distinct()
    return docs.join(found, docs["doc_id"].cast("long").eqNullSafe(found["_contaminated"]), "left_anti")


def op2_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLE_SQL = r"""
WITH d AS (
    SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS words FROM documents
), b AS (
    SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS words FROM benchmark
), dw AS (
    SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM d
), bw AS (
    SELECT item_id, len(words) AS n, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM b WHERE len(words) >= 5
), met AS (
    SELECT doc_id, item_id, n, dw.place - bw.place AS shift, bw.place AS place FROM dw JOIN bw USING (word)
), run AS (
    SELECT doc_id, item_id, n, count(*) OVER (
        PARTITION BY doc_id, item_id, shift ORDER BY place RANGE BETWEEN CURRENT ROW AND 19 FOLLOWING
    ) AS equal FROM met
)
SELECT doc_id, item_id, CAST(max(equal) AS INTEGER) AS matched FROM run
WHERE equal >= least(n, 20) - CASE WHEN n < 10 THEN 0 ELSE CAST(floor(least(n, 20) * 0.2 + 1e-9) AS BIGINT) END
GROUP BY doc_id, item_id
"""
