"""Suffix-array dedup of bytes: what a repeated string of ``length`` bytes covers is removed.

1. Anchors. Every window of ``length`` bytes names as its anchor the place of the smallest hash among its strings of
   ``GRAM`` bytes (the first of equals). Equal windows have their anchor at the same offset, so a window whose anchor's
   hash occurs once in all texts is unique. Anchors are one place in about ``(length - GRAM) / 2``; only they are counted.
2. Contexts. For anchors that occur again, the bytes of their windows are hashed. Contexts that are equal settle each
   other; one of each kind is sent to its anchor's group. Very large groups are dealt over pairs of blocks.
3. Difference cover. Each task sorts the suffixes of its contexts: ranks the triples at places 1 and 2 modulo 3, names
   them, recurses on the names, sorts the rest by their first byte and the next rank, and merges. Windows that
   are neighbours in that order and equal in ``length`` bytes are repeated.
4. What they cover is joined per text and cut out.

Equal texts are handled once: all of a text of at least ``length`` bytes that occurs again is repeated. Texts are keyed by
two 64-bit hashes. Matches never cross texts; all strings are judged on the input, and overlaps count.

The whole order of suffixes is not kept: the order within a group is all that a window's neighbours need.

Defined results: a null text counts as empty (0 bytes, nothing removed); equal rows repeat each other; a null ``doc_id`` is kept as
it is; texts shorter than ``length`` lose nothing; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threatsieve.llm.shared import batch_of, stored, texts_of, whole_groups

LENGTH = 400
GRAM = 100
PIECE = 1 << 18
SHARD = 1 << 20
BLOCK_ROWS = 2048
_PLACE = np.uint64((1 << 24) - 1)
_RANDOM = np.random.default_rng(9)
_BYTES = _RANDOM.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of each string of ``gram`` bytes."""
    power, size, bits = _BASE, 1, gram
    current, out, done = _BYTES[data], None, 0
    while bits:
        if bits & 1:
            if out is None:
                out = current
            else:
                n = len(current) - done
                out = out[:n] * np.uint64(power) + current[done : done + n]
            done += size
        bits >>= 1
        if bits:
            current = current[:-size] * np.uint64(power) + current[size:]
            power, size = power * power & 0xFFFFFFFFFFFFFFFF, size * 2
    out = out ^ (out >> np.uint64(29))
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def window_anchors(texts: list[bytes], length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """``text, hash, place, first, last``: anchors and the windows (by first byte) that name them, a piece at a time."""
    held: list[tuple[int, int, int]] = []  # text, first window, windows

    def found() -> tuple[np.ndarray, ...]:
        data = np.frombuffer(b"".join([texts[t][a : a + n + length - 1] for t, a, n in held]), np.uint8)
        hashes = gram_hashes(data, gram)
        packed = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
        sizes = np.array([n for _, _, n in held])
        begins = np.concatenate([[0], np.cumsum(sizes + length - 1)[:-1]])
        windows = np.repeat(begins - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
        anchor = (smallest(packed, length - gram + 1)[windows] & _PLACE).astype(np.int64)
        starts = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        ends = np.concatenate([starts[1:], [len(anchor)]]) - 1
        lot = np.searchsorted(begins, anchor[starts], side="right") - 1
        shift = np.array([a for _, a, _ in held])[lot] - begins[lot]
        text = np.array([t for t, _, _ in held])[lot]
        at = anchor[starts]
        return text, hashes[at].view(np.int64), at + shift, windows[starts] + shift, windows[ends] + shift

    size = 0
    for t, text in enumerate(texts):
        for a in range(0, len(text) - length + 1, PIECE):
            held.append((t, a, min(PIECE, len(text) - length + 1 - a)))
            size += held[-1][2]
            if size >= PIECE:
                yield found()
                held, size = [], 0
    if held:
        yield found()


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Places of ``text`` (whole numbers from 1) in the order of their suffixes, by a difference cover modulo 3."""
    n = len(text)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: text[i:].tolist()), np.int64)
    s = np.concatenate([text, [0, 0, 0]]).astype(np.int64)
    ones, twos = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)  # one sample more where the cover needs it
    sample = np.concatenate([ones, twos])
    bits = int(s.max()).bit_length()
    if bits <= 21:
        key = (s[sample] << (2 * bits)) | (s[sample + 1] << bits) | s[sample + 2]
        order = np.argsort(key, kind="stable")
        new = key[order[1:]] != key[order[:-1]]
    else:
        order = np.lexsort([s[sample + 2], s[sample + 1], s[sample]])
        new = np.zeros(len(order) - 1, bool)
        for k in range(3):
            new |= s[sample[order[1:]] + k] != s[sample[order[:-1]] + k]
    distinct = bool(new.all())
    names = np.empty(len(sample), np.int64)
    names[order] = np.concatenate([[1], 1 + np.cumsum(new)])
    del new
    if not distinct:
        key = None
        order = suffix_array(names)
    del names
    rank = np.zeros(n + 3, np.int64)
    rank[sample[order]] = np.arange(1, len(order) + 1)
    sampled = sample[order]
    sampled = sampled[sampled < n]
    zeros = np.arange(0, n, 3)
    wide = int(rank.max()).bit_length()
    zeros = zeros[np.argsort((s[zeros] << wide) | rank[zeros + 1], kind="stable")]
    first, second = sampled[sampled % 3 == 1], sampled[sampled % 3 == 2]
    before = np.searchsorted((s[first] << wide) | rank[first + 1], (s[zeros] << wide) | rank[zeros + 1])
    # Two symbols and a rank may not fit one number: the second symbol and the rank become one rank of their own.
    tails = np.concatenate([(s[second + 1] << wide) | rank[second + 2], (s[zeros + 1] << wide) | rank[zeros + 2]])
    tails = np.unique(tails, return_inverse=True)[1]
    before += np.searchsorted((s[second] << wide + 1) | tails[: len(second)], (s[zeros] << wide + 1) | tails[len(second) :])
    out = np.empty(n, np.int64)
    at = np.arange(len(zeros)) + before
    out[at] = zeros
    rest = np.ones(n, bool)
    rest[at] = False
    out[rest] = sampled
    return out


def repeated_windows(contexts: list[bytes], length: int) -> list[np.ndarray]:
    """Per context, whether each of its windows of ``length`` bytes is equal to another window of any of them."""
    sizes = np.array([len(c) for c in contexts])
    begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    data = b"\0".join(contexts) + b"\0"
    # Bytes from 2 on, and 1 where a context ends: a window holds no end, so neighbours show all its equals.
    symbols = np.frombuffer(data, np.uint8).astype(np.int64) + 2
    symbols[begins + sizes] = 1
    order = suffix_array(symbols)
    is_window = np.zeros(len(symbols), bool)
    for begin, size in zip(begins.tolist(), sizes.tolist(), strict=True):
        is_window[begin : begin + size - length + 1] = True
    order = order[is_window[order]]
    words = np.lib.stride_tricks.sliding_window_view(np.frombuffer(data + b"\0" * 8, np.uint8), 8)
    words = np.ascontiguousarray(words).view("<u8").ravel()
    alive = np.arange(len(order) - 1)
    for k in range(0, length, 8):
        k = min(k, max(length - 8, 0))
        a, b = words[order[alive] + k], words[order[alive + 1] + k]
        alive = alive[a == b] if length >= 8 else alive[(a ^ b) & np.uint64((1 << 8 * length) - 1) == 0]
    found = np.zeros(len(symbols), bool)
    found[order[alive]] = found[order[alive + 1]] = True
    return [found[b : b + n - length + 1] for b, n in zip(begins.tolist(), sizes.tolist(), strict=True)]


def runs_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of each run of true flags."""
    edges = np.diff(np.concatenate([[0], flags.view(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) - 1


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    return rows.withColumn("k1", F.xxhash64("text")).withColumn("k2", F.xxhash64(F.lit(1), "text"))


def _anchors(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """``h, k1, k2, place, first, last`` of every anchor."""
    names = ("h", "k1", "k2", "place", "first", "last")
    schema = pa.schema([(c, pa.int64()) for c in names])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = batch["k1"].to_numpy(), batch["k2"].to_numpy()
            for text, h, place, first, last in window_anchors(texts_of(batch["text"]), length, gram):
                yield batch_of(schema, h=h, k1=k1[text], k2=k2[text], place=place, first=first, last=last)

    shape = ", ".join(f"{c} long" for c in names)
    return rows.select("k1", "k2", "text").mapInArrow(run, shape)


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of places, ``first, last``, that touch or overlap as one."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(runs):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def _contexts(texts: DataFrame, length: int) -> DataFrame:
    """Per text a row for each kind of context: its anchor, offset, a hash of its bytes (``c1, c2``), once per batch the bytes.

    Kinds that a text has more than once are settled at once: their windows are further rows, as runs with ``sure`` set.
    """
    schema = pa.schema([
        *((c, pa.int64()) for c in ("h", "c1", "c2", "k1", "k2", "first", "last")), ("offset", pa.int32()), ("sure", pa.bool_()), ("bytes", pa.binary()),
    ])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[tuple] = set()
            for k1, k2, raw, listed in zip(*(batch[c].to_pylist() for c in ("k1", "k2")), texts_of(batch["text"]), batch["listed"].to_pylist(), strict=True):
                kinds: dict[tuple, list[tuple[int, int]]] = {}
                for x in listed:
                    c1, c2 = struct.unpack("<qq", xxhash.xxh3_128_digest(raw[x["first"] : x["last"] + length]))
                    kinds.setdefault((x["h"], c1, c2, x["place"] - x["first"]), []).append((x["first"], x["last"]))
                rows = []
                for key, places in kinds.items():
                    first, last = min(places)
                    rows.append((*key[:3], k1, k2, first, last, key[3], False, None if key in seen else raw[first : last + length]))
                    seen.add(key)
                for first, last in merged([p for places in kinds.values() if len(places) > 1 for p in places]):
                    rows.append((None, None, None, k1, k2, first, last, None, True, None))
                yield batch_of(schema, **dict(zip(schema.names, zip(*rows, strict=True), strict=True)))

    shape = "h long, c1 long, c2 long, k1 long, k2 long, first long, last long, offset int, sure boolean, bytes binary"
    return texts.mapInArrow(run, shape)


def _shards(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Whole groups, together up to about ``SHARD`` bytes."""
    held, size = [], 0
    for group in whole_groups(batches, keys):
        held.append(group)
        size += group["bytes"].nbytes
        if size >= SHARD:
            yield pa.concat_tables(held)
            held, size = [], 0
    if held:
        yield pa.concat_tables(held)


def repeated_in(shard: pa.Table, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``row, first, last`` of the runs of repeated windows (by first byte) of the contexts of whole groups.

    A context that is in several of the groups counts once.
    """
    texts = list(zip(*(shard[c].to_pylist() for c in ("k1", "k2", "first")), strict=True))
    rows = list({text: row for row, text in enumerate(texts)}.values())
    flags = repeated_windows(shard["bytes"].take(pa.array(rows)).to_pylist(), length)
    at, firsts, lasts = [], [], []
    for row, flag in zip(rows, flags, strict=True):
        a, b = runs_of(flag)
        at += [row] * len(a)
        firsts += (a + texts[row][2]).tolist()
        lasts += (b + texts[row][2]).tolist()
    return np.array(at, np.int64), np.array(firsts, np.int64), np.array(lasts, np.int64)


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans`` of every row; ``spans``: what is removed, as ``start, end``."""
    rows = _keyed(docs)
    light = stored(rows.select("doc_id", "k1", "k2", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")))
    texts = light.groupBy("k1", "k2").agg(F.count("*").alias("copies"), F.min("doc_id").alias("chosen"))
    anchors = stored(_anchors(rows, length, gram))
    mark = F.xxhash64("k1", "k2", "first")
    again = anchors.groupBy("h").agg(F.min(mark).alias("low"), F.max(mark).alias("high")).where("low <> high").select("h")
    item = F.struct("h", "place", "first", "last")
    met = anchors.join(again, "h").groupBy("k1", "k2").agg(F.collect_set(item).alias("listed"))  # as many as the text has anchors
    chosen = stored(met.join(texts, ["k1", "k2"]).select("k1", "k2", "chosen", "listed"))
    same = (F.col("r.k1") == F.col("c.k1")) & (F.col("r.k2") == F.col("c.k2")) & F.col("r.doc_id").eqNullSafe(F.col("c.chosen"))
    bodies = rows.alias("r").join(chosen.alias("c"), same).select("r.k1", "r.k2", "r.text", "c.listed")
    found = stored(_contexts(bodies, length))
    contexts, sure = found.where("NOT sure"), found.where("sure").select("k1", "k2", "first", "last")

    # Equal contexts settle each other; of each kind one goes on, to be compared with the other kinds of its anchor.
    kind = ["h", "offset", "c1", "c2"]
    settled = contexts.groupBy(*kind).agg(F.min(mark).alias("low"), F.max(mark).alias("high")).where("low <> high").select(*kind)
    whole = contexts.select(*kind, "k1", "k2", "first", "last").join(settled, kind).select("k1", "k2", "first", "last")
    kinds = contexts.groupBy("h").agg(F.countDistinct("offset", "c1", "c2").alias("n")).where("n > 1")
    member = F.first(F.struct("k1", "k2", "first", "bytes")).alias("one")
    ones = contexts.where("bytes IS NOT NULL").groupBy(*kind).agg(member)
    ones = ones.join(kinds.select("h", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks")), "h").select("h", "c1", "blocks", "one.*")
    ones = ones.withColumn("block", F.pmod("c1", "blocks").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pair = [F.least("block", "other").alias("block_a"), F.greatest("block", "other").alias("block_b")]
    keys = ["h", "block_a", "block_b"]
    cover = pa.schema([(c, pa.int64()) for c in ("k1", "k2", "first", "last")])

    def sort(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches, keys):
            at, first, last = repeated_in(shard, length)
            if len(at):
                yield batch_of(cover, k1=shard["k1"].to_numpy()[at], k2=shard["k2"].to_numpy()[at], first=first, last=last)

    grouped = ones.select("h", *pair, "k1", "k2", "first", "bytes").repartition(*keys).sortWithinPartitions(*keys)
    found = grouped.mapInArrow(sort, "k1 long, k2 long, first long, last long").union(whole).union(sure)
    covered = stored(found.groupBy("k1", "k2").agg(F.collect_list("first").alias("firsts"), F.collect_list("last").alias("lasts")))
    once = covered.join(texts.where("copies = 1"), ["k1", "k2"]).select("k1", "k2", "chosen", "firsts", "lasts")

    spans_type = "array<struct<start:long,end:long>>"
    result = pa.schema([
        ("k1", pa.int64()), ("k2", pa.int64()), ("removed", pa.int64()), ("kept_sha", pa.string()),
        ("cut", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ])

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, shas, spans = [], [], []
            for raw, firsts, lasts in zip(texts_of(batch["text"]), batch["firsts"].to_pylist(), batch["lasts"].to_pylist(), strict=True):
                windows = [(a, b + length - 1) for a, b in zip(firsts, lasts, strict=True)]
                found = [(a, b + 1) for a, b in merged(windows)]
                kept, at = hashlib.sha256(), 0
                for a, b in found:
                    kept.update(raw[at:a])
                    at = b
                kept.update(raw[at:])
                removed.append(sum(b - a for a, b in found))
                shas.append(kept.hexdigest())
                spans.append([{"start": a, "end": b} for a, b in found])
            yield batch_of(result, k1=batch["k1"], k2=batch["k2"], removed=removed, kept_sha=shas, cut=spans)

    bodies = rows.alias("r").join(once.alias("c"), same).select("r.k1", "r.k2", "r.text", "c.firsts", "c.lasts")
    done = bodies.mapInArrow(cut, f"k1 long, k2 long, removed long, kept_sha string, cut {spans_type}").dropDuplicates(["k1", "k2"])
    out = light.join(texts.select("k1", "k2", "copies"), ["k1", "k2"]).join(done, ["k1", "k2"], "left")
    gone = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    everything = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    return out.select(
        "doc_id",
        "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(gone, 1).otherwise(F.coalesce(F.size("cut"), F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256"),
        F.when(gone, everything).otherwise(F.coalesce("cut", F.array().cast(spans_type))).alias("spans"),
    )


def op9_suffixes(spark, sf_dir: str) -> DataFrame:
    found = without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
