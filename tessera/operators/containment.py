"""Which keys lie in which others: substrings of a whole are looked up by hashes of a part's own length, so no pair is formed that is not one."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

U64 = np.uint64
#: Bits of each filter (4 MB, whatever the input), probes in it, and characters that are hashed at once.
BITS, PROBES, PIECE = 25, 3, 1 << 19
BASE = 0x9E3779B97F4A7C15


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Grams:
    """Hashes of all substrings of a given length of several keys, from one pass over their characters."""

    def __init__(self, keys: list[str]):
        codes = np.frombuffer("".join(keys).encode("utf-32-le", "surrogatepass"), np.uint32).astype(U64)
        self.sizes = np.array([len(k) for k in keys], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.left = np.repeat(self.starts + self.sizes, self.sizes) - np.arange(len(codes))  # characters from here to the key's end
        self.back = _powers(pow(BASE, -1, 1 << 64), len(codes) + 1)
        self.sums = np.concatenate((np.zeros(1, U64), np.cumsum(_mix(codes + U64(BASE)) * _powers(BASE, len(codes)), dtype=U64)))

    def at(self, places: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        """The hashes of the substrings of `size` characters at `places`, which must lie inside a key."""
        return _mix((self.sums[places + size] - self.sums[places]) * self.back[places] + np.asarray(size).astype(U64) * U64(BASE))


def _pieces(keys: list[str]) -> Iterator[list[str]]:
    some, held = [], 0
    for k in keys:
        some.append(k)
        held += len(k)
        if held >= PIECE:
            yield some
            some, held = [], 0
    if some:
        yield some


def _steps(least: int, longest: int) -> np.ndarray:
    """Lengths of heads: a part has the longest of them that fits."""
    out = [least]
    while out[-1] < longest:
        out.append(out[-1] * 3 // 2 + 1)
    return np.array(out, np.int64)


def _probes(h: np.ndarray) -> list[np.ndarray]:
    return [((h >> U64(20 * k)) & U64((1 << BITS) - 1)).astype(np.int64) for k in range(PROBES)]


def _known(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Where all probes of a hash are set; later probes only for those that are left."""
    found = np.arange(len(h))
    for k in range(PROBES):
        p = (h[found] >> U64(20 * k)) & U64((1 << BITS) - 1)
        found = found[(bits[(p >> U64(6)).astype(np.int64)] >> (p & U64(63))) & U64(1) == 1]
    return found


def _filters(parts: DataFrame, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bits of the parts' heads, bits of the parts, their distinct lengths): what reaches the driver is bounded by BITS and the longest part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys in _pieces(batch.column(0).to_pylist()):
                grams = Grams(keys)
                steps = _steps(least, int(grams.sizes.max()))
                head = steps[np.searchsorted(steps, grams.sizes, "right") - 1]
                kinds, places = [np.full(len(keys), 2)], [grams.sizes]
                for kind, size in enumerate((head, grams.sizes)):
                    for p in _probes(grams.at(grams.starts, size)):
                        kinds.append(np.full(len(keys), kind))
                        places.append(p)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(kinds).astype(np.int32)), pa.array(np.concatenate(places))], names=["kind", "place"])

    told = parts.mapInArrow(run, "kind int, place long")
    word = F.when(F.col("kind") < 2, F.shiftright("place", 6)).otherwise(F.col("place")).cast("int")
    bit = F.expr("shiftleft(1L, cast(place & 63 as int))")
    found = told.groupBy("kind", word.alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    kind, word, bits = (found.column(c).to_numpy() for c in ("kind", "word", "bits"))
    out = []
    for k in (0, 1):
        table = np.zeros(1 << (BITS - 6), U64)
        table[word[kind == k]] = bits[kind == k].view(U64)
        out.append(table)
    return out[0], out[1], np.sort(word[kind == 2]).astype(np.int64)


def contained(parts: DataFrame, wholes: DataFrame, least: int, ratio: float = 0.0) -> DataFrame:
    """(part, whole): distinct keys (column `key`, `least` characters or more) of `parts` inside those of `wholes`, with at least `ratio` of their length.

    A whole is read once: where the head of a part may begin (a filter tells), the substrings of the lengths that parts have are
    looked up in a filter of whole parts, and those found there meet the parts in an equi-join on their text. A filter lets
    through more than it should, never less, so the join decides. Work grows with the wholes' characters and the pairs that are right."""
    some = parts.filter(F.length("key") >= least).select("key").distinct()
    heads, full, sizes = _filters(some, least)
    sent = parts.sparkSession.sparkContext.broadcast((heads, full, sizes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads, full, sizes = sent.value
        for batch in batches:
            for keys in _pieces(batch.column(0).to_pylist()):
                found = _found(keys, heads, full, sizes, least, ratio)
                for i in range(0, len(found), 10_000):
                    part, whole = zip(*found[i : i + 10_000], strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array(whole, pa.string())], names=["part", "whole"])

    distinct = wholes.filter(F.length("key") >= least).select("key").distinct()
    return distinct.mapInArrow(run, "part string, whole string").join(some.withColumnRenamed("key", "part"), "part", "left_semi")


def _found(keys: list[str], heads: np.ndarray, full: np.ndarray, sizes: np.ndarray, least: int, ratio: float) -> list[tuple[str, str]]:
    """The (substring, key) that the filters let through, each once."""
    grams = Grams(keys)
    steps = _steps(least, int(sizes.max())) if len(sizes) else []
    owner = np.repeat(np.arange(len(keys)), grams.sizes)
    out = set()
    for k, head in enumerate(steps):
        mine = sizes[(sizes >= head) & ((sizes < steps[k + 1]) if k + 1 < len(steps) else True)]
        if not len(mine):
            continue
        places = np.flatnonzero(grams.left >= head)
        places = places[_known(heads, grams.at(places, head))]
        for size in mine.tolist():
            here = places[(grams.left[places] >= size) & (size >= ratio * grams.sizes[owner[places]])]
            for p in here[_known(full, grams.at(here, size))].tolist():
                i = owner[p]
                at = p - grams.starts[i]
                out.add((keys[i][at : at + size], keys[i]))
    return list(out)
