"""Line dedup: drops the lines whose normalised key occurs in many documents.

Every text is split at line feeds; a line's key is the line without ASCII white space at both ends and with A-Z lower-cased.
Keys are hashed (128 bits), distinct documents are counted per hash, and the places of lines over the
threshold are joined back to their texts, which are put together again by position. Everything is DataFrame expressions.

What a line loses depends on its key alone, so equal texts lose the same places: places are gathered per text, by its hash.
A key or a text that makes up a third of all rows shrinks to one row per task before it is shuffled,
or stands in a plain join, which Spark splits by size.

Defined results: a null or empty text is one empty line and stays empty; a key shorter than ``least_chars`` code points is never
dropped; rows that share a ``doc_id`` (null included) count as one document, each with a result of its own; repeats within a document count once;
a text all of whose lines go is empty; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threatsieve.llm.shared import stored

LEAST_DOCS = 10
LEAST_CHARS = 1
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    """The lines of a text; a null is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def key_of(line: Column) -> Column:
    """What equal lines have in common. ``lower`` is the same for plain ASCII, and faster."""
    bare = F.btrim(line, F.lit(SPACE))
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def hashes(value: Column, first: str, second: str) -> list[Column]:
    """Two independent 64-bit hashes of a text."""
    return [F.xxhash64(value).alias(first), F.xxhash64(F.lit(1), value).alias(second)]


def without_common_lines(docs: DataFrame, least_docs: int = LEAST_DOCS, least_chars: int = LEAST_CHARS) -> DataFrame:
    """``doc_id, text, n_lines, n_dropped`` of every row; ``text`` without lines that ``least_docs`` documents share."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), lines_of(F.col("text").cast("string")).alias("lines"))
    rows = rows.select("*", *hashes(F.concat_ws("\n", "lines"), "t1", "t2"))
    single = rows.select("doc_id", "t1", "t2", F.posexplode("lines").alias("place", "line"))
    single = single.withColumn("key", key_of(F.col("line"))).where(F.length("key") >= least_chars)
    lines = stored(single.select("doc_id", "t1", "t2", "place", *hashes(F.col("key"), "h1", "h2")))

    seen = lines.select("h1", "h2", "doc_id").distinct()
    common = seen.groupBy("h1", "h2").agg(F.count("*").alias("n_docs")).where(F.col("n_docs") >= least_docs)
    places = F.sort_array(F.collect_set("place")).alias("places")  # as many as the text has lines
    # Written, so that the join is a plain one: Spark splits the places of a very common line.
    dropped = lines.join(stored(common.select("h1", "h2")), ["h1", "h2"]).groupBy("t1", "t2").agg(places)

    # What stands between two dropped places is cut out as a whole, so the work is in proportion to the text.
    joined = rows.join(stored(dropped), ["t1", "t2"], "left")  # likewise for a text with very many copies
    n_lines, n_dropped = F.size("lines"), F.coalesce(F.size("places"), F.lit(0))
    ends = F.concat(F.array(F.lit(-1)), F.col("places"), F.array(n_lines))
    joined = joined.select("doc_id", "lines", n_lines.alias("n_lines"), n_dropped.alias("n_dropped"), ends.alias("ends"))
    begin = lambda k: F.get("ends", k) + F.lit(2)
    parts = F.transform(F.sequence(F.lit(0), F.col("n_dropped")), lambda k: F.slice("lines", begin(k), F.get("ends", k + 1) - begin(k) + 1))
    kept = F.when(F.col("n_dropped") == 0, F.col("lines")).otherwise(F.flatten(parts))
    return joined.select(
        "doc_id", F.concat_ws("\n", kept).alias("text"), F.col("n_lines").cast("long").alias("n_lines"),
        F.col("n_dropped").cast("long").alias("n_dropped"),
    )


def op11_lines(spark, sf_dir: str) -> DataFrame:
    found = without_common_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "utf-8"), 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH rows AS (
    SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), line AS (
    SELECT row, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM rows
), keyed AS (
    SELECT row, doc_id, line, place, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM line
), common AS (
    SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT coalesce(CAST(doc_id AS VARCHAR), '')) >= 10
), marked AS (
    SELECT row, doc_id, line, place, key IN (SELECT key FROM common) AS gone FROM keyed
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY row, doc_id
"""
