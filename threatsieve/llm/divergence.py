"""Source divergence audit: how far the term shares of a language's sources lie from each other and from the whole language.

Terms are counted per (language, source). A language keeps the terms of at least ``least_docs`` of its documents. With ``n`` occurrences
in a group of ``total`` (over the ``V`` kept terms), a term's scaled, smoothed share there is ``p = 1 + floor(SHARES * (n + 1) / (total + V))``;
a group's ``p`` against another's ``q`` counts ``f = floor((p - q)^2 / q)``.

Pairs are summed through count-level bitmaps. Kept terms stand on pages of 64, most frequent first, so terms of like counts share
a page. A group has a 64-bit set per page and count; its terms with count zero are the complement of the others. Two groups' sets of a page ANDed,
their bits counted, give the joint cells: so many terms have this count here and that count there, each worth the same ``f``.
Where a page has sets of very many groups, these are dealt over pairs of blocks.

All arithmetic is exact: shares and ``f`` are integers below 2^63, the products that shares come from are decimals.

Defined results: a null text, language or source is an empty one; every row is a document, repeated ones too; a group without terms and a
language without kept terms still have their pairs (value 0 where no term is kept), but no terms; a language with one source has no
pairs; ties go in the order of the items' UTF-8; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threatsieve.llm.shared import batch_of, blocked, pieces_of, stored, texts_of, whole_groups

LEAST_DOCS = 3
TOP_TERMS = 200
SHARES = 1_000_000_000
PIECE = 1 << 20
# Entries that a task gathers before it hands them on.
HELD = 600_000
ROWS = 10_000
WORD_BITS = 64
BLOCK_ROWS = 1024
TERM_COLUMNS = ["lang", "term", "docs", "sources", "ns"]
TERM_ROWS = "lang string, term string, docs long, sources array<string>, ns array<long>"
# Terms are ASCII letters and all that is not ASCII; texts are lower-cased (A-Z) before.
_TERM = re.compile(rb"[a-z\x80-\xff]+")
_GAP = re.compile(rb"[^a-z\x80-\xff]")


def _plain(*columns: str) -> list[Column]:
    return [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns]


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, term, docs, sources, ns`` of terms, more than once each: documents, and occurrences by source.

    A task adds up what it reads and hands on a row per term and language, so frequent terms and large groups shrink before they are shuffled.
    """

    def rows(held: dict[tuple[str, str], dict[bytes, int]]) -> Iterator[pa.RecordBatch]:
        terms = pa.array([t for found in held.values() for t in found], pa.binary()).cast(pa.string())
        counts = np.array([(x >> 32, x & 0xFFFFFFFF) for found in held.values() for x in found.values()], np.int64).reshape(-1, 2)
        sizes = [len(found) for found in held.values()]
        of = np.repeat(np.arange(len(sizes)), sizes)
        lang, source = (pa.array([group[k] for group in held], pa.string()).take(pa.array(of)) for k in range(2))
        table = pa.table([lang, terms, source, counts[:, 0], counts[:, 1]], ["lang", "term", "source", "n", "docs"])
        found = table.group_by(["lang", "term"], use_threads=False).aggregate([("docs", "sum"), ("source", "list"), ("n", "list")])
        yield from found.select(["lang", "term", "docs_sum", "source_list", "n_list"]).rename_columns(TERM_COLUMNS).to_batches(ROWS)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], dict[bytes, int]] = {}  # occurrences above 32 bits, documents below
        size = 0
        for batch in batches:
            groups = list(zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), strict=True))
            of, own = -1, Counter()  # the text at hand, which may come in pieces
            for number, piece in [*_pieces(batch), (-1, b"")]:
                if number != of and of >= 0:
                    found = held.setdefault(groups[of], {})
                    known, size = found.get, size - len(found)
                    for term, n in own.items():
                        found[term] = known(term, 0) + (n << 32) + 1
                    size += len(found)
                    own = Counter()
                    if size > HELD:
                        yield from rows(held)
                        held, size = {}, 0
                of = number
                own.update(_TERM.findall(piece))
        yield from rows(held)

    return docs.select(*_plain("lang", "source", "text")).mapInArrow(count, TERM_ROWS)


def merged(table: pa.Table, least_docs: int = 0) -> pa.Table:
    """One row per term of ``term_counts`` rows in the order of ``lang, term``, of those with enough documents."""
    new = np.ones(table.num_rows, bool)
    if table.num_rows > 1:
        same = (pc.equal(table[c].slice(1), table[c].slice(0, table.num_rows - 1)).to_numpy() for c in ("lang", "term"))
        new[1:] = ~np.logical_and(*same)
    run = np.cumsum(new) - 1
    sizes = pc.list_value_length(table["sources"]).to_numpy()
    single = pa.table([np.repeat(run, sizes), pc.list_flatten(table["sources"]), pc.list_flatten(table["ns"])], ["run", "source", "n"])
    summed = single.group_by(["run", "source"], use_threads=False).aggregate([("n", "sum")])
    lists = summed.group_by("run", use_threads=False).aggregate([("source", "list"), ("n_sum", "list")]).sort_by("run")
    docs = np.add.reduceat(table["docs"].to_numpy(), np.flatnonzero(new)) if table.num_rows else np.zeros(0, np.int64)
    first = table.take(pa.array(np.flatnonzero(new)))
    found = pa.table([first["lang"], first["term"], docs, lists["source_list"], lists["n_sum_list"]], TERM_COLUMNS)
    return found.filter(pa.array(docs >= least_docs))


def kept_terms(counts: DataFrame, least_docs: int) -> DataFrame:
    """``term_counts`` with one row per kept term; a task holds a batch of rows and the sums of one term."""

    def add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held else table
            last = [pc.equal(table[c], table[c][-1]) for c in ("lang", "term")] if table.num_rows else []
            whole = table.num_rows - (pc.sum(pc.and_(*last)).as_py() if last else 0)
            yield from merged(table.slice(0, whole), least_docs).to_batches()
            held = merged(table.slice(whole))  # may go on in the next batch
        if held:
            yield from merged(held, least_docs).to_batches()

    keys = ["lang", "term"]
    return counts.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(add_up, TERM_ROWS)


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[int, bytes]]:
    return pieces_of((t.lower() for t in texts_of(batch["text"])), PIECE, _GAP)


def share(n: str, total: str, terms: str) -> Column:
    """The scaled, smoothed share of ``n`` occurrences; the product is a decimal, as it may leave the long range."""
    return F.expr(f"1 + CAST({SHARES} AS DECIMAL(10,0)) * CAST({n} + 1 AS DECIMAL(20,0)) div CAST({total} + {terms} AS DECIMAL(20,0))")


def numbered(terms: DataFrame) -> DataFrame:
    """Adds ``lang_n, page, bit`` to kept terms: a place on a page of one language, most frequent first."""

    def number(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        page, last, n = TaskContext.get().partitionId() << 40, None, 0
        for batch in batches:
            places = []
            for lang in batch["lang"].to_pylist():
                if lang != last or n == WORD_BITS:
                    page, last, n = page + 1, lang, 0
                places.append((page, n))
                n += 1
            pages, bits = (pa.array([x[k] for x in places], kind) for k, kind in ((0, pa.int64()), (1, pa.int32())))
            yield pa.record_batch([*batch.columns, pages, bits], [*batch.schema.names, "page", "bit"])

    lang_n = F.aggregate("ns", F.lit(0).cast("long"), lambda a, b: a + b).alias("lang_n")
    order = [F.col("lang"), F.col("lang_n").desc(), F.col("term")]
    rows = terms.select("lang", "term", lang_n, "sources", "ns").repartitionByRange(*order).sortWithinPartitions(*order)
    return rows.mapInArrow(number, "lang string, term string, lang_n long, sources array<string>, ns array<long>, page long, bit int")


def pair_sums(rows: DataFrame) -> DataFrame:
    """``a, b, value``: sums of ``f`` over the pages' terms, from ``page, gid, n, p, word`` rows.

    A group's row with ``n`` = 0 has all of the page's bits and the share of a term that it lacks.
    """
    keys = ["page", "block_a", "block_b"]
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("value", pa.int64())])

    def summed(held: list[pa.Table]) -> pa.Table:
        found = pa.concat_tables(held).group_by(["a", "b"]).aggregate([("value", "sum")])
        return found.select(["a", "b", "value_sum"]).rename_columns(schema.names)

    def cells(words: np.ndarray, p: np.ndarray, gid: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> pa.Table:
        """The sums of the groups of ``rows`` against those of ``columns``."""
        left, of = np.unique(gid[rows], return_inverse=True)
        right, to = np.unique(gid[columns], return_inverse=True)
        out = np.zeros((len(left), len(right)), np.int64)
        for at in range(0, len(rows), 256):
            some = rows[at : at + 256]
            n = np.bitwise_count(words[some, None] & words[None, columns])
            i, j = np.nonzero(n)  # a term is in one cell of each pair
            q = p[columns[j]]
            f = (p[some[i]] - q) ** 2 // q
            np.add.at(out, (of[i + at], to[j]), n[i, j] * f)
        a, b = np.repeat(left, len(right)), np.tile(right, len(left))
        apart = a != b
        return pa.table([a[apart], b[apart], out.ravel()[apart]], schema=schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for group in whole_groups(batches, keys):
            words, n, gid = (group[c].to_numpy().copy() for c in ("word", "n", "gid"))  # sorted by gid and n
            p, block = group["p"].to_numpy(), group["block"].to_numpy()
            words = words.view(np.uint64)
            starts = np.flatnonzero(n == 0)
            sizes = np.diff(starts, append=len(n))
            some = sizes > 1
            if some.any():
                full = words[starts].copy()
                words[starts] = 0
                words[starts] = full & ~np.bitwise_or.reduceat(words, starts)
            first, second = group["block_a"][0].as_py(), group["block_b"][0].as_py()
            rows = np.flatnonzero((block == first) & (words != 0))
            if first == second:
                held.append(cells(words, p, gid, rows, rows))
            else:
                columns = np.flatnonzero((block == second) & (words != 0))
                held += [cells(words, p, gid, rows, columns), cells(words, p, gid, columns, rows)]
            size += sum(t.num_rows for t in held[-2:])
            if size > HELD:
                held = [summed(held)]
                size = held[0].num_rows
                if size > HELD // 2:
                    yield from held[0].to_batches()
                    held, size = [], 0
        if held:
            yield from summed(held).to_batches()

    met = blocked(rows, ["page"], "gid", BLOCK_ROWS).repartition(*keys).sortWithinPartitions(*keys, "gid", "n")
    found = met.mapInArrow(run, "a long, b long, value long")
    return found.groupBy("a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank``: every other source of a group's language, and its most outstanding terms."""
    names = stored(docs.select(*_plain("lang", "source")).distinct().withColumn("gid", F.monotonically_increasing_id()))
    terms = stored(numbered(stored(kept_terms(term_counts(docs), least_docs))))
    of_source = F.explode(F.arrays_zip("sources", "ns")).alias("of")
    members = terms.select("lang", "term", "lang_n", "page", "bit", of_source).select("*", "of.*").drop("of").withColumnsRenamed({"sources": "source", "ns": "n"})

    totals = members.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = terms.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    groups = names.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0)
    groups = stored(groups.withColumn("p0", F.when(F.col("terms") > 0, share("0", "total", "terms"))))
    p, q = share("n", "total", "terms").alias("p"), share("lang_n", "lang_total", "terms").alias("q")
    known = stored(members.join(groups, ["lang", "source"]).select("gid", "term", "page", "bit", "n", p, q))

    f = F.expr("(p - q) * (p - q) div q").alias("value")
    order = Window.partitionBy("gid").orderBy(F.col("value").desc(), "item")
    top = known.where("p > q").select("gid", F.col("term").alias("item"), f)
    top = top.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_terms)
    top = top.join(groups.select("gid", "lang", "source"), "gid").withColumn("part", F.lit("term"))

    bit = F.expr("shiftleft(1L, bit)")
    sets = known.groupBy("page", "gid", "n").agg(F.first("p").alias("p"), F.bit_or(bit).alias("word"))
    pages = terms.groupBy("lang", "page").agg(F.bit_or(bit).alias("word"))
    lacking = groups.join(pages, "lang").select("page", "gid", F.lit(0).cast("long").alias("n"), F.col("p0").alias("p"), "word")
    sums = pair_sums(sets.unionByName(lacking))
    ours = groups.select(F.col("gid").alias("a"), "lang", "source")
    others = groups.select(F.col("gid").alias("b"), "lang", F.col("source").alias("item"))
    # Every pair of sources of a language is a row of the result.
    pairs = ours.join(others, "lang").where("a <> b").join(sums, ["a", "b"], "left").fillna(0, ["value"])
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    pairs = pairs.withColumn("rank", rank).withColumn("part", F.lit("pair"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(*columns).unionByName(top.select(*columns))


def op13_divergence(spark, sf_dir: str) -> DataFrame:
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), found AS (
    SELECT row, lang, source, unnest(terms) AS term FROM docs
), kept AS (
    SELECT lang, term, count(*) AS lang_n FROM found GROUP BY lang, term HAVING count(DISTINCT row) >= 3
), langs AS (
    SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang
), counts AS (
    SELECT lang, source, term, count(*) AS n FROM found JOIN kept USING (lang, term) GROUP BY lang, source, term
), totals AS (
    SELECT lang, source, sum(n) AS total FROM counts GROUP BY lang, source
), groups AS (
    SELECT lang, source, coalesce(total, 0) AS total, coalesce(v, 0) AS v, coalesce(lang_total, 0) AS lang_total
    FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN totals USING (lang, source) LEFT JOIN langs USING (lang)
), shares AS (
    SELECT lang, source, term, coalesce(n, 0) AS n,
        1 + (1000000000::HUGEINT * (coalesce(n, 0) + 1)) // (total + v)::HUGEINT AS p,
        1 + (1000000000::HUGEINT * (lang_n + 1)) // (lang_total + v)::HUGEINT AS q
    FROM groups JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)
), summed AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pair AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), outstanding AS (
    SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // q AS BIGINT) AS value FROM shares WHERE n > 0 AND p > q
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
    FROM (SELECT * FROM pair UNION ALL SELECT * FROM outstanding)
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
