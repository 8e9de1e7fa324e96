"""Substring dedup by sliding sentence spans.

A text is cut into units: sentences (ended by a mark and white space, or by a line's end), cut also before one
word in ``PIECE`` chosen by its hash (so equal passages are cut alike wherever their first sentence began), and those of
fewer than ``SHORT`` words joined to what follows. What is longer than ``LONG`` words after that is cut before words whose hash is the least among
``AROUND`` words on either side, so that three whole units fit into nearly any 50 words. Every run of ``span`` consecutive units is hashed over its lower-cased words. Hashes are joined over all documents; units that
any occurrence of a repeated run covers, but its first, are removed. First is the smallest document id, then the place.

Defined results: a null text stays null, an empty one empty; texts with fewer units than a run stay as they are; the first occurrence
of a run counts on the input, also where other runs remove it in part; rows that share a ``doc_id`` count as one document's
text at the same places (equal rows keep or lose the same units), null being the smallest id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threatsieve.llm.shared import batch_of, stored, texts_of

SPAN = 3
PIECE = 8
SHORT = 4
LONG = 12
AROUND = 3
CACHED = 200_000
NO_ID = -(1 << 63)
_END = re.compile(r"[.!?…]+[\"'”’»)\]]*\s+|\n\s*")
_WORD = re.compile(r"\S+")


class _Hashes(dict):
    """The hash of a word, by which a unit may begin there. Kept up to ``CACHED`` words."""

    def __missing__(self, word: str) -> int:
        value = xxhash.xxh64_intdigest(word) & 0x3FFFFFFF
        if len(self) < CACHED:
            self[word] = value
        return value


_hash_of = _Hashes().__getitem__


def _least(hashes: list[int], begin: int, end: int) -> list[int]:
    """Places of a stretch whose hash is the only least one among those around it."""
    found, at = [], begin + AROUND
    while at < end - AROUND:
        own = hashes[at]
        if own < hashes[at + 1] and own < hashes[at - 1] and own < min(hashes[at - AROUND : at]) and own < min(hashes[at + 1 : at + AROUND + 1]):
            found.append(at)
            at += AROUND
        at += 1
    return found


def units(text: str) -> list[tuple[int, int, str]]:
    """``start, end, words`` of every unit; together they cover the whole text."""
    out: list[tuple[int, int, str]] = []
    start = at = 0
    held: list[str] = []  # words of the unit that is not closed yet
    for end in [*(m.end() for m in _END.finditer(text)), len(text)]:
        if end == at:
            continue
        words = text[at:end].lower().split()
        if len(words) >= 2 * SHORT:
            hashes = list(map(_hash_of, words))
            marks, last, before = [], 0, len(held)
            for k in [k for k, value in enumerate(hashes) if not value % PIECE]:
                if before + k - last >= SHORT and len(words) - k >= SHORT:
                    marks.append(k)
                    last, before = k, 0
            for a, b in zip([0, *marks], [*marks, len(words)], strict=True):
                if b - a > LONG:
                    marks += _least(hashes, a, b)
            places = [m.start() for m in _WORD.finditer(text, at, end)] if marks else []
            last = 0
            for k in sorted(marks):
                out.append((start, places[k], " ".join([*held, *words[last:k]])))
                start, last, held = places[k], k, []
            words = words[last:]
        at = end
        held += words
        if len(held) >= SHORT:
            out.append((start, end, " ".join(held)))
            start, held = end, []
    if start < len(text):
        out.append((start, len(text), " ".join(held)))
    return out


def _hashed(found: list[tuple[int, int, str]], span: int) -> list[int]:
    words = [w for _, _, w in found]
    return [xxhash.xxh3_128_intdigest(" ".join(words[i : i + span])) for i in range(len(words) - span + 1)]


def runs(docs: DataFrame, span: int) -> DataFrame:
    """``h1, h2, doc_id, place`` of every run of ``span`` units; 96 bits of hash."""
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int32()), ("doc_id", pa.int64()), ("place", pa.int32())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["doc_id"].to_pylist()
            h1, h2, doc, place = [], [], [], []
            for doc_id, text in zip(ids, texts_of(batch["text"]), strict=True):
                hashes = _hashed(units(text.decode("utf-8", "replace")), span)
                h1 += [h & 0xFFFFFFFFFFFFFFFF for h in hashes]
                h2 += [h >> 96 for h in hashes]
                doc += [doc_id] * len(hashes)
                place += range(len(hashes))
            yield batch_of(schema, h1=np.array(h1, np.uint64).view(np.int64), h2=np.array(h2, np.uint32).view(np.int32), doc_id=doc, place=place)

    return docs.mapInArrow(run, "h1 long, h2 int, doc_id long, place int")


def without_repeats(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """``doc_id, text, n_units, n_removed`` of every row; ``text`` without what repeats."""
    rows = docs.select(F.col("doc_id").cast("long").alias("row_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("doc_id", F.coalesce("row_id", F.lit(NO_ID)))
    found = stored(runs(rows.select("doc_id", "text"), span))  # used twice
    first = found.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "place")).alias("first")).where("n > 1")
    # Written, so that the join is a plain one: Spark splits the places of a very common run.
    repeats = found.join(stored(first), ["h1", "h2"]).where("struct(doc_id, place) <> first")
    covered = repeats.groupBy("doc_id").agg(F.collect_set("place").alias("places"))  # as many as the document has units

    shape = "doc_id long, text string, n_units int, n_removed int"
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("n_units", pa.int32()), ("n_removed", pa.int32())])

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, sizes, removed = [], [], []
            for text, places in zip(batch["text"].to_pylist(), batch["places"].to_pylist(), strict=True):
                own = units(text or "")
                gone = {p + k for p in places or () for k in range(span)}
                kept = text if not gone else "".join(text[a:b] for i, (a, b, _) in enumerate(own) if i not in gone)
                texts.append(kept)
                sizes.append(len(own))
                removed.append(len(gone))
            yield batch_of(schema, doc_id=batch["row_id"], text=texts, n_units=sizes, n_removed=removed)

    joined = rows.join(covered, "doc_id", "left").select("row_id", "text", "places")
    return joined.mapInArrow(cut, shape)


def op4_spans(spark, sf_dir: str) -> DataFrame:
    return without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
