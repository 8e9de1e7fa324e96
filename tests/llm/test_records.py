from __future__ import annotations

import random
import struct
import zlib

import numpy as np
import pytest
from pyarrow import fs
from tokenizers import Tokenizer

from threatsieve.llm import records

ODD = [
    "", " ", "  ", " a", "a ", "a  b", "a   b \n c", "\n\n a", "a\n\n b", "a \n\nb", "\t a\t\tb", "it's  I'll", " <|endoftext|> x", "a <|endoftext|> b", "<|endoftext|>",
    "<|endoftext|><|endoftext|>  a<|endoftext|>\n", "<|endoftext|", "a <|endoftext|>\u00e9",
    "é  ß\xa0x y", "a b c", " \n ", None,
]


@pytest.fixture(scope="module")
def coder():
    return records.Encoder(records.default_tokenizer())


def test_encoder_equals_the_library(coder):
    rng = random.Random(5)
    texts = [t or "" for t in ODD] + ["".join(rng.choice(" \n\ta'sé1.") for _ in range(rng.randint(0, 14))) for _ in range(2000)]
    texts += [rng.choice(texts) + "<|endoftext|>" + rng.choice(texts) for _ in range(200)]
    found = Tokenizer.from_file(records.default_tokenizer()).encode_batch(texts, add_special_tokens=False)
    for _ in range(2):  # the second time from what is kept
        assert coder.encode(texts) == [np.array(x.ids, coder.kind).tobytes() for x in found]


def test_frames_and_damage():
    payload = bytes(range(200))
    record = records.framed(payload)
    assert struct.unpack_from("<Q", record)[0] == 200 and len(record) == 216
    assert records.payload_of(record) == payload and records.payload_of(records.framed(b"")) == b""
    for place in (0, 9, 15, 215):
        broken = bytearray(record)
        broken[place] ^= 1
        with pytest.raises((ValueError, struct.error)):
            records.payload_of(bytes(broken))


def test_round_trip_and_any_order(spark, tmp_path):
    rng = random.Random(3)
    rows = [(rng.randrange(-50, 10_000), " ".join(rng.choice(["the", "of", "ing", "日本"]) for _ in range(rng.randint(0, 60))), "x") for _ in range(400)]
    rows = list({r[0]: r for r in rows}.values()) + [(20_000 + i, t, "y") for i, t in enumerate(ODD)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(5)
    folder = f"file://{tmp_path}/out"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several files for little data
    try:
        written = records.write(frame, folder).collect()
        written = records.write(frame, folder).collect()  # a second run leaves the same files
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(written) > 1 and sum(w.n_docs for w in written) == len(rows)
    tokenizer = Tokenizer.from_file(records.default_tokenizer())
    start, expected = 0, []
    for doc_id, text, _ in sorted(rows, key=lambda r: r[0]):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        expected.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    found = records.read(spark, written, folder, 2)
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in found.collect()) == expected
    by_id = dict((r[0], r[2]) for r in expected)
    files = fs.LocalFileSystem()
    some = written[-1]
    entries = records.read_index(files, some["index"])
    with files.open_input_file(some["records"]) as source:
        for entry in rng.sample(list(entries), min(20, len(entries))):
            payload = records.read_record(source, int(entry["offset"]), int(entry["size"]))
            assert len(payload) == 2 * by_id[int(entry["doc_id"])]
    assert not [p for p in (tmp_path / "out").iterdir() if p.name.count(".") != 1]


def test_odd_rows(spark, tmp_path):
    frame = spark.createDataFrame([(None, None), (None, "b"), (1, "a"), (1, "a")], "doc_id long, text string")
    folder = str(tmp_path / "odd")
    found = records.read(spark, records.write(frame, folder).collect(), folder, 2).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in found) == [(0, 1), (0, 2), (1, 2), (1, 2)]
    assert sorted(r.start for r in found) == [0, *sorted(r.start for r in found)[1:]] and max(r.start for r in found) == 5
    empty = str(tmp_path / "empty")
    assert records.read(spark, records.write(frame.limit(0), empty).collect(), empty, 2).count() == 0


def test_new_words_are_encoded_together():
    """Words joined to one text, and apart from their punctuation, have the ids that the untouched library gives."""
    rng = random.Random(8)
    plain = Tokenizer.from_file(records.default_tokenizer())
    coder = records.Encoder(records.default_tokenizer())
    pool = ["don't", "don'", "it's'", "été,", "naïve...", "a\nb", "\nx", "x\n", "日本。", "😀!", "x_y", "12.", "ab12!?", "", "\x1c", " z", "'s", "word", "word.", "word,!", "ß)", "é."]
    texts = [" ".join(rng.choices(pool, k=rng.randint(1, 30))) for _ in range(300)]
    for text, ids in zip(texts, coder.encode(texts), strict=True):
        assert np.frombuffer(ids, coder.kind).tolist() == plain.encode(text, add_special_tokens=False).ids, text
    lot = ["word", "été", "日本。", "don't"]
    assert coder.joins and [np.frombuffer(x, coder.kind).tolist() for x in coder.words(lot)] == [plain.encode(" " + w, add_special_tokens=False).ids for w in lot]
