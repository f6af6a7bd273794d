"""SentencePiece encoding and decoding as a weighted finite-state transducer.

Three machines are compiled from a model file. The normaliser writes the dummy prefix and a marker for each space. The
piece machine is a trie whose accepting arcs write a piece and return to its root; characters that are no piece pass
through byte-fallback arcs, one for each byte. A neighbour machine remembers the last piece written and weighs the next:
in a unigram model every step weighs minus the piece's score; in a byte-pair model a step weighs one, and two pieces that
the merges would not leave side by side weigh infinity. (A sequence of pieces is the result of the merges exactly if all
its neighbouring pairs are.) The composition with an input is walked from left to right and the tropical-semiring
shortest path is kept for each state, which in a byte-pair model is one piece for each position.

No piece goes on across a marker, so a text's shortest path is that of its segments, each a run of markers and what
follows; equal segments are composed once and then looked up. Decoding writes each piece's bytes and drops the prefix.

Defined cases: null and empty texts have no pieces; a text may be of any length; repeated rows encode alike; an empty
table gives an empty result; extra columns pass through, clashing ones are replaced. Models with a character map, with
whitespace removal or with whitespace as a suffix are refused."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice
from math import inf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import id_text_batches

MARK = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Entries of a worker's tables; beyond that neighbours start anew, and of
#: the segments the first quarter stays, as common ones are met early. They bound memory, never results.
CACHE_SEGMENTS, CACHE_NEIGHBOURS = 300_000, 600_000
START = -1


class Transducer:
    """The compiled machines of one model file."""

    def __init__(self, model_file: str) -> None:
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(model_file, "rb") as f:
            proto.ParseFromString(f.read())
        spec, trainer = proto.normalizer_spec, proto.trainer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces or trainer.treat_whitespace_as_suffix:
            raise ValueError("this model's normaliser is not supported")
        if trainer.model_type not in (UNIGRAM, BPE):
            raise ValueError("this kind of model is not supported")
        self.merges = trainer.model_type == BPE
        self.prefix = MARK if spec.add_dummy_prefix else ""
        self.texts = [p.piece for p in proto.pieces]
        self.scores = [p.score for p in proto.pieces]
        kinds = [p.type for p in proto.pieces]
        self.ids = {p: i for i, p in enumerate(self.texts) if kinds[i] in (NORMAL, USER_DEFINED)}
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece goes on across a space")
        self.bytes = {int(self.texts[i].strip("<>"), 16): i for i, k in enumerate(kinds) if k == BYTE}
        self.unknown = kinds.index(UNKNOWN)
        self.written = [bytes([int(t.strip("<>"), 16)]) if k == BYTE else b"" if k == CONTROL else t.replace(MARK, " ").encode() for t, k in zip(self.texts, kinds, strict=True)]
        self.trie: dict = {}
        for piece, i in self.ids.items():
            node = self.trie
            for c in piece:
                node = node.setdefault(c, {})
            node[""] = i
        alone = "\n" if not any("\n" in p for p in self.ids if len(p) > 1) else ""
        # a newline that no longer piece contains is always a segment of its own
        self.segments = re.compile(f"\n|{MARK}+[^{MARK}\n]*|[^{MARK}\n]+" if alone else f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        self.neighbours: dict[int, bool] = {}  # by (last + 1) << 20 | piece
        self.found: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """What the byte-pair merges make of a text: the best-scored adjacent pair first, the leftmost of equals."""
        parts = list(text)
        while True:
            best, at = -inf, -1
            for i in range(len(parts) - 1):
                found = self.ids.get(parts[i] + parts[i + 1])
                if found is not None and self.scores[found] > best:
                    best, at = self.scores[found], i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def step_weight(self, last: int, piece: int) -> float:
        """The neighbour machine's weight of writing `piece` after `last` (START at first)."""
        if not self.merges:
            return -self.scores[piece]
        key = (last + 1) << 20 | piece
        allowed = self.neighbours.get(key)
        if allowed is None:
            if len(self.neighbours) > CACHE_NEIGHBOURS:
                self.neighbours.clear()
            b = self.texts[piece]
            pair = [self.texts[last], b] if last != START else [b]
            allowed = self.neighbours[key] = self.merged("".join(pair)) == pair
        return 1.0 if allowed else inf

    def shortest_path(self, segment: str) -> list[int]:
        """The pieces of the best path through the composition with one normalised segment."""
        return self._only_path(segment) if self.merges else self._best_path(segment)

    def _fallback(self, char: str) -> tuple[int, ...]:
        return tuple(self.bytes[b] for b in char.encode("utf-8", "replace")) if self.bytes else (self.unknown,)

    def _only_path(self, segment: str) -> list[int]:
        """In a byte-pair model every position is reached by one path of finite weight, so states are composed only as
        they are reached, longest arcs first, and the first path to the end is the shortest."""
        n = len(segment)
        came: list[tuple[int, tuple[int, ...] | int] | None] = [None] * (n + 1)
        allowed, weight, root = self.neighbours, self.step_weight, self.trie
        at, last = 0, START
        arcs: list[tuple[int, int, int, int]] = []  # from, last piece before, to, piece
        while at < n:
            node, j = root, at
            while j < n:
                node = node.get(segment[j])
                if node is None:
                    break
                j += 1
                piece = node.get("")
                if piece is not None:
                    arcs.append((at, last, j, piece))
            if segment[at] not in self.ids:
                arcs.append((at, last, at + 1, START))
            while True:
                i, before, j, piece = arcs.pop()
                if came[j] is not None:
                    continue
                if piece == START:
                    came[j] = (i, self._fallback(segment[i]))
                    break
                fits = allowed.get((before + 1) << 20 | piece)
                if fits or fits is None and weight(before, piece) < inf:
                    came[j] = (i, piece)
                    break
            at, last = j, piece
        path: list[int] = []
        while n:
            n, out = came[n]
            path += (out,) if isinstance(out, int) else out[::-1]
        return path[::-1]

    def _best_path(self, segment: str) -> list[int]:
        n = len(segment)
        cost = [inf] * (n + 1)
        came: list[tuple[int, tuple[int, ...]]] = [(0, ())] * (n + 1)
        cost[0] = 0.0
        for i in range(n):
            node = self.trie
            for j in range(i, n):
                node = node.get(segment[j])
                if node is None:
                    break
                piece = node.get("")
                if piece is not None and cost[i] + self.step_weight(START, piece) < cost[j + 1]:
                    cost[j + 1], came[j + 1] = cost[i] + self.step_weight(START, piece), (i, (piece,))
            if segment[i] not in self.ids and cost[i] + 10.0 - min(self.scores) < cost[i + 1]:
                cost[i + 1], came[i + 1] = cost[i] + 10.0 - min(self.scores), (i, self._fallback(segment[i]))
        path: list[int] = []
        while n:
            n, out = came[n]
            path[:0] = out
        return path

    def packed(self, text: str) -> bytes:
        """The ids of a whole text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        found = self.segments.findall(self.prefix + text.replace(" ", MARK))
        for segment in set(found).difference(self.found):
            if len(self.found) > CACHE_SEGMENTS + len(found):
                first = dict(islice(self.found.items(), CACHE_SEGMENTS // 4))
                self.found = first | {s: self.found[s] for s in set(found) if s in self.found}
            self.found[segment] = np.array(self.shortest_path(segment), "<u4").tobytes()
        return b"".join(map(self.found.__getitem__, found))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), "<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        out = b"".join(map(self.written.__getitem__, ids)).decode("utf-8", "replace")
        return out.removeprefix(" ") if self.prefix else out


@lru_cache(maxsize=2)
def transducer(model_file: str) -> Transducer:
    """One for each worker process and model file."""
    return Transducer(model_file)


def encode(docs: DataFrame, model_file: str, column: str = "piece_ids") -> DataFrame:
    """`docs` with the piece ids of each whole text as an array<int>."""
    kept = docs.select(*[c for c in docs.columns if c != column])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(model_file)
        for batch, texts in id_text_batches(batches):
            for at in range(0, len(texts), 1000):
                packed = [machine.packed(t) for t in texts[at : at + 1000]]
                offsets = np.concatenate(([0], np.cumsum([len(p) // 4 for p in packed]))).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), "<i4")))
                part = batch.slice(at, len(packed))
                yield pa.RecordBatch.from_arrays([*part.columns, ids], names=[*part.schema.names, column])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(column, T.ArrayType(T.IntegerType()))]))


def decode(encoded: DataFrame, model_file: str, column: str = "piece_ids", into: str = "decoded") -> DataFrame:
    """`encoded` with the text that the piece ids stand for; a null list decodes to null."""
    kept = encoded.select(*[c for c in encoded.columns if c != into])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(model_file)
        for batch in batches:
            texts = [None if x is None else machine.decode(x) for x in batch.column(column).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, into])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(into, T.StringType())]))


def digest(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id, n_pieces, ids_crc32 and whether decoding gives the text back, for every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(model_file)
        for batch, texts in id_text_batches(batches):
            rows = []
            for text in texts:
                packed = machine.packed(text)
                ids = np.frombuffer(packed, "<u4")
                rows.append((len(ids), zlib.crc32(packed), machine.decode(ids.tolist()) == text))
            n, crc, same = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(same, pa.bool_())], names=["doc_id", "n_pieces", "ids_crc32", "round_trip"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_pieces long, ids_crc32 long, round_trip boolean")
