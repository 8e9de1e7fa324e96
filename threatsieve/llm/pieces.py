"""SentencePiece encoding and decoding with N-best segmentations.

The pieces and scores come from a model file; a segmentation's score is the sum of its pieces' scores.
A forward Viterbi pass over the lattice of pieces gives the best score up to every place. Those are exact
heuristics for an A-star search that runs backward from the end, so paths leave its queue best first.

Where no piece of the model crosses a place (before a word, around a character that no piece holds), the
lattice falls apart into independent pieces of text. The best of each and the
exact loss of its next best are kept, up to ``CACHED`` parts; the N best of a whole text combine the N best of its parts exactly.

Defined results: a null or empty text has one segmentation, without pieces, of score 0; a character that no
piece holds becomes its bytes' pieces at ``unknown_penalty`` below the lowest score; fewer than N segmentations may exist;
equal scores are ordered by the search, the same in every run, and take no longer than others; repeated rows give repeated rows; an empty table gives an
empty result; a text that itself holds the model's space mark does not decode to itself, and says so; other columns are ignored.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threatsieve.llm.shared import batch_of, texts_of

SPACE = "▁"
CACHED = 500_000
CACHED_LENGTH = 64
_NEVER = -1e300
_NONE = (0, (0.0, ()))
Option = tuple[float, tuple[int, ...]]


class Lattice:
    """N-best segmentation of texts with the pieces of one model."""

    def __init__(self, model_file: str, n_best: int = 3, unknown_penalty: float = 10.0) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = model.get_piece_size()
        self.n_best = n_best
        self.names = [model.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        scores = {self.names[i]: (model.get_score(i), (i,)) for i in plain}
        self.tree: dict[str, tuple[dict, tuple | None]] = {}  # by letter: what may follow, and the piece that ends here
        for name in sorted(scores):
            below = self.tree
            for letter in name[:-1]:
                below = below.setdefault(letter, ({}, None))[0]
            below[name[-1]] = ({}, scores[name])
        self.longest = max(map(len, scores), default=0)
        self.single = {name for name in scores if len(name) == 1}
        self.bytes = {int(self.names[i][3:5], 16): i for i in range(size) if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.no_piece = model.unk_id()
        self.unknown = min((x[0] for x in scores.values()), default=0.0) - unknown_penalty
        crossing = any(re.search(f"[^{SPACE}]{SPACE}", p) for p in scores)
        newline = any("\n" in p for p in scores)
        parts = rf"{SPACE}*[^{SPACE}]+|{SPACE}+" if newline else rf"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n"
        self.split = (lambda text: [text]) if crossing else re.compile(parts).findall
        self.kept: dict[str, tuple[bytes, float, float]] = {}

    def forward(self, part: str, edges: list[list] | None = None) -> tuple[list[float], list[tuple], list[float]]:
        """Viterbi: per place the best score up to it, the last piece of it, and the best score with another last piece.

        ``edges``, if given, gets every piece that ends at each place.
        """
        size = len(part)
        best, second, last = [_NEVER] * (size + 1), [_NEVER] * (size + 1), [_NONE] * (size + 1)
        best[0] = 0.0
        for start in range(size):
            before, end, below = best[start], start, self.tree
            if part[start] not in self.single:
                raw = part[start].encode("utf-8", "surrogatepass")
                piece = (self.unknown, tuple(self.bytes.get(b, self.no_piece) for b in raw))
                score = before + self.unknown
                if score > best[start + 1]:
                    second[start + 1], best[start + 1], last[start + 1] = best[start + 1], score, (start, piece)
                elif score > second[start + 1]:
                    second[start + 1] = score
                if edges is not None:
                    edges[start + 1].append((start, piece))
            for letter in part[start : start + self.longest]:
                node = below.get(letter)
                if node is None:
                    break
                end += 1
                below, piece = node
                if piece is None:
                    continue
                score = before + piece[0]
                if score > best[end]:
                    second[end], best[end], last[end] = best[end], score, (start, piece)
                elif score > second[end]:
                    second[end] = score
                if edges is not None:
                    edges[end].append((start, piece))
        return best, last, second

    def search(self, part: str) -> list[Option]:
        """The N best segmentations of one part, best first, by A-star from its end.

        Of equal scores the path that has come furthest goes on first, so ties are not all walked side by side.
        """
        into: list[list] = [[] for _ in range(len(part) + 1)]
        best, _, _ = self.forward(part, into)
        found: list[Option] = []
        tick = itertools.count()
        queue = [(-best[-1], len(part), next(tick), 0.0, None)]
        while queue:
            _, end, _, behind, chain = heapq.heappop(queue)
            if not end:
                ids: list[int] = []
                while chain:
                    ids.extend(chain[0])
                    chain = chain[1]
                found.append((behind, tuple(ids)))
                if len(found) == self.n_best:
                    break
                continue
            for start, (score, ids) in into[end]:
                g = behind + score
                heapq.heappush(queue, (-(g + best[start]), start, next(tick), g, (ids, chain)))
        return found

    def part(self, part: str) -> tuple[bytes, float, float]:
        """Ids and score of the best segmentation, and exactly how much the next best loses.

        The next best shares the end of the best one up to some place and has another last piece there.
        """
        best, last, second = self.forward(part)
        end, loss, chain = len(part), np.inf, []
        while end:
            loss = min(loss, best[end] - second[end])
            end, piece = last[end]
            chain.append(piece[1])
        ids = [i for x in reversed(chain) for i in x]
        entry = (struct.pack(f"<{len(ids)}i", *ids), best[-1], loss)
        if len(self.kept) < CACHED and len(part) <= CACHED_LENGTH:
            self.kept[part] = entry
        return entry

    def encode(self, text: str) -> list[tuple[float, np.ndarray]]:
        """``score, ids`` of the N best segmentations of a whole text, best first."""
        if not text:
            return [(0.0, np.empty(0, np.int32))]
        known, part = self.kept.get, self.part
        names = self.split(SPACE + text.replace(" ", SPACE))
        parts = [known(p) or part(p) for p in names]
        total = sum([p[1] for p in parts])
        losses = np.array([p[2] for p in parts])
        # Only the parts with the smallest losses can differ from their best among the N best of the text.
        free = np.argsort(losses, kind="stable")[: self.n_best - 1]
        free = sorted(int(i) for i in free if losses[i] < 1e200)
        options = [self.search(names[i]) for i in free]
        ranked = sorted(
            (sum(found[0][0] - found[c][0] for found, c in zip(options, choice, strict=True)), choice)
            for choice in itertools.product(*(range(len(found)) for found in options))
        )
        out = []
        for loss, choice in ranked[: self.n_best]:
            ids = [p[0] for p in parts]
            for i, found, c in zip(free, options, choice, strict=True):
                ids[i] = np.array(found[c][1], "<i4").tobytes()
            out.append((total - loss, np.frombuffer(b"".join(ids), "<i4")))
        return out

    @functools.cached_property
    def _raw(self) -> list[bytes]:
        return [bytes([self.byte_of[i]]) if i in self.byte_of else n.encode() for i, n in enumerate(self.names)]

    def decode(self, ids: Iterable[int]) -> str:
        """The text of a segmentation; bytes that are no UTF-8 are replaced."""
        raw = self._raw
        text = b"".join(map(raw.__getitem__, ids)).decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@functools.lru_cache(maxsize=2)
def lattice(model_file: str, n_best: int) -> Lattice:
    """One lattice per worker process and model."""
    return Lattice(model_file, n_best)


def segmentations(docs: DataFrame, model_file: str | None = None, n_best: int = 3) -> DataFrame:
    """``doc_id, rank, score, ids`` of the N best segmentations of every row; rank 1 is the best."""
    path = model_file or default_model()
    schema = pa.schema([("doc_id", pa.int64()), ("rank", pa.int32()), ("score", pa.float64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = lattice(path, n_best)
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), texts_of(batch["text"]), strict=True):
                found = coder.encode(text.decode("utf-8", "replace"))
                yield batch_of(
                    schema, doc_id=[doc_id] * len(found), rank=range(1, len(found) + 1),
                    score=[s for s, _ in found], ids=[i for _, i in found],
                )

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return columns.mapInArrow(run, "doc_id long, rank int, score double, ids array<int>")


def decoded(encoded: DataFrame, model_file: str | None = None) -> DataFrame:
    """Adds ``text`` to rows with ``ids``; null ids give a null text."""
    path = model_file or default_model()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = lattice(path, 1)
        for batch in batches:
            texts = [None if ids is None else coder.decode(ids) for ids in batch["ids"].to_pylist()]
            yield pa.record_batch([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "text"])

    kept = encoded.drop("text")
    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField("text", T.StringType())]))


def summary(docs: DataFrame, model_file: str | None = None, n_best: int = 3, with_ids: bool = False) -> DataFrame:
    """Per row: size and checksum of the best segmentation, the N best scores, and whether all N decode to the text.

    ``with_ids`` adds the best one's ``ids``.
    """
    path = model_file or default_model()
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("scores", pa.list_(pa.float64())), ("decodes", pa.bool_()),
        *([("ids", pa.list_(pa.int32()))] if with_ids else []),
    ])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = lattice(path, n_best)
        for batch in batches:
            rows = []
            for raw in texts_of(batch["text"]):
                text = raw.decode("utf-8", "replace")
                found = coder.encode(text)
                best = found[0][1]
                same = all(coder.decode(ids.tolist()) == text for _, ids in found)
                rows.append((len(best), zlib.crc32(best.astype("<u4").tobytes()), [s for s, _ in found], same, best))
            sizes, sums, scores, same, ids = zip(*rows, strict=True) if rows else ((), (), (), (), ())
            yield batch_of(schema, doc_id=batch["doc_id"], n_tokens=sizes, ids_crc32=sums, scores=scores, decodes=same, ids=ids)

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shape = "doc_id long, n_tokens long, ids_crc32 long, scores array<double>, decodes boolean"
    return columns.mapInArrow(run, shape + ", ids array<int>" * with_ids)


def op3_sentencepiece(spark, sf_dir: str) -> DataFrame:
    found = summary(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    ranks = [F.get("scores", F.lit(k)).alias(f"score_{k + 1}") for k in range(3)]
    return found.select("doc_id", "n_tokens", "ids_crc32", *ranks, "decodes")
