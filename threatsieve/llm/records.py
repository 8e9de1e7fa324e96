"""Token ids in length-delimited binary records, with a separate offset index.

Record: ``length`` (8 bytes), masked checksum of those 8 bytes (4), ``length`` bytes of payload, masked checksum
of the payload (4); all little-endian. The checksum is CRC-32 (that of zlib), turned right by 15 bits plus
``MASK``, so that a checksum of data that holds checksums stays sound. The payload holds a document's ids as
unsigned integers, two bytes each where the vocabulary allows and four otherwise.

Each file has an index of 32-byte entries: document id, offset of the record, its payload's bytes, ids in the file
before it. Records can be read in any order through it. Documents are range-partitioned by id, so files and the
records in them follow ascending ids; each file's place among all ids follows from the files' totals.

A task writes under a name of its own and renames when done, so that a task that runs again or twice leaves the same file.

Defined results: a null or empty text has the end id only; null ids come first and are written as the smallest long; repeated
ids are in a fixed order, each with a record; an empty table gives no record and an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import json
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from threatsieve.llm.shared import batch_of, shared_dir, texts_of

MASK = 0xA282EAD8
END_ID = 2
NO_ID = -(1 << 63)
CACHED = 800_000
CACHED_LENGTH = 48
MISSES = 4096
JOINED = 512
FLUSH = 4 << 20
LOT = 256
INDEX = np.dtype([("doc_id", "<i8"), ("offset", "<i8"), ("size", "<i8"), ("before", "<i8")])


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def framed(payload: bytes) -> bytes:
    """One record."""
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload))))


def payload_of(record: bytes) -> bytes:
    """The payload of one record; raises where lengths or checksums do not fit."""
    length, crc = struct.unpack_from("<QI", record)
    payload = record[12 : 12 + length]
    if crc != masked(record[:8]) or len(record) != length + 16 or struct.unpack_from("<I", record, 12 + length)[0] != masked(payload):
        raise ValueError("damaged record")
    return payload


class Encoder:
    """Ids of whole texts, as bytes. Words are encoded once per task and kept, up to ``CACHED``.

    The tokenizer's patterns never reach from a non-space over a following space, so a text may be cut
    before each space that follows a word; where spaces stand together the runs are kept whole. For the same reason new words are
    encoded many at once, as one text, and without their punctuation, where the library works byte by byte. Tokens that were added to the
    vocabulary (such as an end mark) are looked for first, as the library does, and what stands between them is a text of its own.
    """

    _PIECES = re.compile(r"\s*\S+|\s+")
    _TAILED = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]+)")  # the library cuts between the two

    def __init__(self, tokenizer_file: str) -> None:
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        added = self.tokenizer.get_added_tokens_decoder()
        self.added = {t.content: np.array([i], self.kind).tobytes() for i, t in added.items()}
        # Marks that take white space along, or stand for whole words or normalised text only, are left to the library.
        self.plain = not any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added.values())
        longest_first = sorted(self.added, key=len, reverse=True)
        self.marks = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if added else None
        spec = json.loads(self.tokenizer.to_str())
        cut = spec["pre_tokenizer"] or {}
        # Only then do the ids' bytes add up to the text's, and no token crosses the space between two words.
        whole = spec["normalizer"] is None and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
        self.joins = bool(whole) and spec["post_processor"] is None and not any(" " in mark for mark in self.added)
        self.sizes = np.zeros(max(self.tokenizer.get_vocab().values(), default=0) + 1, np.int64)  # bytes of each id: a letter each
        for name, i in self.tokenizer.get_vocab().items():
            self.sizes[i] = len(name)
        self.kept: dict[str, bytes] = {}  # by word, with the space before it
        self.heads: dict[str, bytes] = {}  # by piece, as it is

    def pieces(self, text: str) -> tuple[list[str], list[str]]:
        """The pieces as they are, then the words that follow with one space before each."""
        if "  " in text:
            return self._PIECES.findall(text), []
        words = text.split(" ")
        return words[:1], words[1:]

    def look_up(self, kept: dict[str, bytes], wanted: list[list[str]], before: str) -> dict[str, bytes]:
        """The ids of the pieces that are not kept; some of them are from now on."""
        missing = list(set().union(*wanted).difference(kept))
        fresh: dict[str, bytes] = {}
        if before == " " and self.joins:
            tailed = {word: found.groups() for word in missing if (found := self._TAILED.fullmatch(word))}
            stems = {stem for stem, _ in tailed.values()}.difference(kept)
            joined = [word for word in stems.union(missing).difference(tailed) if word and word == word.strip()]
            for at in range(0, len(joined), JOINED):
                lot = joined[at : at + JOINED]
                fresh.update(zip(lot, self.words(lot), strict=False))
            tails = [tail for _, tail in tailed.values()]
            new_tails = self.look_up(self.heads, [tails], "")
            for word, (stem, tail) in tailed.items():
                ids = kept.get(stem) or fresh.get(stem)
                if ids:
                    fresh[word] = ids + (self.heads.get(tail) or new_tails[tail])
            missing = [word for word in missing if word not in fresh]
        kind = "H" if self.kind.itemsize == 2 else "I"
        for at in range(0, len(missing), MISSES):
            lot = missing[at : at + MISSES]
            found = self.tokenizer.encode_batch_fast([before + piece for piece in lot], add_special_tokens=False)
            fresh.update(zip(lot, [array(kind, x.ids).tobytes() for x in found], strict=True))
        room = CACHED - len(self.kept) - len(self.heads)
        if room > 0:
            kept.update([x for x in fresh.items() if len(x[0]) <= CACHED_LENGTH][:room])
        return fresh

    def words(self, lot: list[str]) -> list[bytes]:
        """The ids of words with a space before each, encoded as one text and cut by their bytes; none if they do not fit."""
        text = " " + " ".join(lot)
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind)
        ends = np.cumsum(self.sizes[ids])
        wanted = np.cumsum([len(word) + 1 for word in (lot if text.isascii() else map(str.encode, lot))])
        last = np.searchsorted(ends, wanted)
        if len(ends) == 0 or ends[-1] != wanted[-1] or (ends[last] != wanted).any():
            return []
        raw, cuts = ids.tobytes(), ((last + 1) * self.kind.itemsize).tolist()
        return [raw[a:b] for a, b in zip([0, *cuts], cuts, strict=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; new words of all of them are looked up together."""
        marked = {k: self.marks.split(text) for k, text in enumerate(texts) if self.marks and self.marks.search(text)}
        if not marked:
            return self.encode_unmarked(texts)
        out = self.encode_unmarked(["" if k in marked else text for k, text in enumerate(texts)])
        for k, parts in marked.items():
            if self.plain:
                between = self.encode_unmarked(parts[::2])
                out[k] = b"".join(x for pair in zip(between, [*map(self.added.__getitem__, parts[1::2]), b""], strict=True) for x in pair)
            else:
                out[k] = np.array(self.tokenizer.encode(texts[k], add_special_tokens=False).ids, self.kind).tobytes()
        return out

    def encode_unmarked(self, texts: list[str]) -> list[bytes]:
        """The ids of texts without added tokens."""
        rows = [self.pieces(text) for text in texts]
        new_heads = self.look_up(self.heads, [heads for heads, _ in rows], "")
        new_words = self.look_up(self.kept, [words for _, words in rows], " ")
        return [_ids(self.heads, new_heads, heads) + _ids(self.kept, new_words, words) for heads, words in rows]


def _ids(kept: dict[str, bytes], fresh: dict[str, bytes], pieces: list[str]) -> bytes:
    """The ids of all pieces; mostly all of them are kept."""
    try:
        return b"".join(map(kept.__getitem__, pieces))
    except KeyError:
        return b"".join([kept[p] if p in kept else fresh[p] for p in pieces])


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@functools.lru_cache(maxsize=2)
def encoder(tokenizer_file: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    return Encoder(tokenizer_file)


def _files(folder: str) -> tuple[fs.FileSystem, str]:
    """The folder's file system (local, HDFS or an object store) and the path in it."""
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def _slices(texts: list[bytes], most: int) -> Iterator[slice]:
    """Consecutive runs of texts of about ``most`` bytes."""
    start = size = 0
    for at, text in enumerate(texts):
        size += len(text)
        if size >= most:
            yield slice(start, at + 1)
            start, size = at + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def write(docs: DataFrame, folder: str, tokenizer_file: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Writes records and indexes below ``folder``; a row per file: ``part, records, index, n_docs, n_tokens``."""
    path = tokenizer_file or default_tokenizer()
    schema = pa.schema([("part", pa.int32()), ("records", pa.string()), ("index", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, task = encoder(path), TaskContext.get()
        end, width = np.array([end_id], coder.kind).tobytes(), coder.kind.itemsize
        files, root = _files(folder)
        files.create_dir(root, recursive=True)
        name = f"{root}/part-{task.partitionId():05d}"
        own = f"{name}.{task.taskAttemptId()}"
        docs_written = tokens = offset = 0
        with files.open_output_stream(f"{own}.rec") as records, files.open_output_stream(f"{own}.idx") as index:
            for batch in batches:
                ids, raw = batch["doc_id"].to_pylist(), texts_of(batch["text"])
                for part in _slices(raw, FLUSH):
                    entries = np.zeros(part.stop - part.start, INDEX)
                    chunk = []
                    coded = coder.encode([t.decode("utf-8", "replace") for t in raw[part]])
                    for k, (doc_id, payload) in enumerate(zip(ids[part], coded, strict=True)):
                        record = framed(payload + end)
                        size = len(payload) + width
                        entries[k] = (NO_ID if doc_id is None else doc_id, offset, size, tokens)
                        offset += len(record)
                        tokens += size // width
                        chunk.append(record)
                    records.write(b"".join(chunk))
                    index.write(entries.tobytes())
                    docs_written += len(entries)
        for kind in ("rec", "idx"):
            files.move(f"{own}.{kind}", f"{name}.{kind}")
        if docs_written:
            yield batch_of(schema, part=[task.partitionId()], records=[f"{name}.rec"], index=[f"{name}.idx"], n_docs=[docs_written], n_tokens=[tokens])

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # The hash only splits rows that repeat an id over files.
    order = ["doc_id", F.xxhash64("text"), "text"]
    dealt = columns.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    return dealt.mapInArrow(run, "part int, records string, index string, n_docs long, n_tokens long")


def read_index(files: fs.FileSystem, index: str) -> np.ndarray:
    with files.open_input_stream(index) as source:
        return np.frombuffer(source.readall(), INDEX)


def read_record(source, offset: int, size: int) -> bytes:
    """The checked payload at a place that the index names; for reading in any order."""
    source.seek(offset)
    return payload_of(source.read(size + 16))


def read(spark: SparkSession, written: list, folder: str, width: int) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32, ids`` of every record; ``written``: the rows of ``write``, few per file system block."""
    starts, before = [], 0
    for row in sorted(written, key=lambda r: r["part"]):
        starts.append((row["records"], row["index"], before))
        before += row["n_tokens"]
    kind = np.dtype("<u2" if width == 2 else "<u4")
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = _files(folder)
        for batch in batches:
            for records, index, start in zip(*(batch[k].to_pylist() for k in ("records", "index", "start")), strict=True):
                entries = read_index(files, index)
                with files.open_input_file(records) as source:
                    for at in range(0, len(entries), LOT):
                        rows = entries[at : at + LOT]
                        payloads = [read_record(source, int(e["offset"]), int(e["size"])) for e in rows]
                        ids = [None if i == NO_ID else i for i in rows["doc_id"].tolist()]
                        yield batch_of(
                            schema, doc_id=ids, start=rows["before"] + start,
                            ids=[np.frombuffer(p, kind).astype("<u4").tobytes() for p in payloads],
                        )

    listed = spark.createDataFrame(starts, "records string, index string, start long").repartition(max(1, len(starts)))
    found = listed.mapInArrow(run, "doc_id long, start long, ids binary")
    n_tokens = (F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    return found.select("doc_id", "start", n_tokens, F.crc32("ids").alias("ids_crc32"), "ids")


def op6_records(spark, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/records-{uuid.uuid4().hex}"
    written = write(spark.read.parquet(f"{sf_dir}/documents.parquet"), folder).collect()  # a row per file
    width = encoder(default_tokenizer()).kind.itemsize
    return read(spark, written, folder, width).select("doc_id", "start", "n_tokens", "ids_crc32")
