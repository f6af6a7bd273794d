"""Quality rules: base counts, and repetition inside a document found with a suffix array over its words.

The words of many documents are numbered and laid out in one array, each document ending in a symbol of its own, so that
no repeat crosses documents. Prefix doubling sorts the suffixes; only suffixes that still share a prefix are sorted again.
The longest common prefix of neighbours in the suffix array gives for each suffix the depth of its deepest LCP interval,
which is the longest substring starting there that occurs again. Spans of that length, where at least `min_repeat` words,
are united; a document fails if they cover too large a part of its words or the longest repeat is too long.

Words are maximal runs of bytes other than ASCII white space. Defined cases: null and empty texts have no words, fail the
base rule (under 20 words) and have no repeats; overlapping occurrences count as repeats; texts are never cut (a document
longer than a batch forms a batch of its own); repeated rows get equal results; an empty table gives an empty result;
columns of the input that clash with result names are replaced.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import id_text_batches

SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
#: Words sorted together; bounds the memory of a batch of ordinary documents.
BATCH_WORDS = 150_000

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat"]
RESULT = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS] + [T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType())])


@dataclass(frozen=True)
class Limits:
    """A repeat counts from `min_repeat` words; at most `max_percent` % of the words may lie in repeats, and none may be longer than `longest` words."""

    min_repeat: int = 10
    max_percent: int = 20
    longest: int = 100


@dataclass
class Repeats:
    """Of a batch: for each document the words in repeated 8-word windows, the words in repeats, the longest repeat, and the united spans."""

    in_windows: np.ndarray
    covered: np.ndarray
    longest: np.ndarray
    spans: list[list[tuple[int, int]]]


def line_counts(text: str) -> tuple[int, int, int]:
    """(code points in words, symbols, lines with a word that equal an earlier line)."""
    blank = sum(map(text.count, SPACES))
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return len(text) - blank, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines))


def suffix_ranks(symbols: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(suffix array, ranks by the first 2**k symbols for each k). Equal rank: equal prefix of that length."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    ranks = [_group_starts(symbols[order], order, np.arange(n))]
    width = 1
    slots = np.arange(n)
    while True:
        last = ranks[-1]
        held = last[order[slots]]
        same = np.zeros(len(slots) + 1, bool)
        same[1:-1] = (held[1:] == held[:-1]) & (slots[1:] == slots[:-1] + 1)
        slots = slots[same[:-1] | same[1:]]  # groups of one are settled
        if not len(slots):
            return order, ranks
        at = order[slots]
        # a suffix that still shares its prefix lies `width` symbols before its document's end symbol, or further
        keys = last[at].astype(np.int64) * n + last[at + width]
        again = np.argsort(keys, kind="stable")
        order[slots] = at[again]
        rank = last.copy()
        rank[order[slots]] = _group_starts(keys[again], None, slots)
        ranks.append(rank)
        width *= 2


def _group_starts(sorted_keys: np.ndarray, order: np.ndarray | None, slots: np.ndarray) -> np.ndarray:
    first = np.ones(len(sorted_keys), bool)
    first[1:] = sorted_keys[1:] != sorted_keys[:-1]
    starts = slots[np.flatnonzero(first)[np.cumsum(first) - 1]].astype(np.int32)
    if order is None:
        return starts
    out = np.empty(len(order), np.int32)
    out[order] = starts
    return out


def neighbour_lcp(order: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
    """lcp[i] = longest common prefix of the suffixes at i - 1 and i of the suffix array; lcp[0] = 0."""
    lcp = np.zeros(len(order), np.int32)
    pairs = np.flatnonzero(ranks[0][order[1:]] == ranks[0][order[:-1]]) + 1
    left, right = order[pairs - 1].astype(np.int64), order[pairs].astype(np.int64)
    end = len(order) - 1
    found = np.zeros(len(pairs), np.int32)
    for k in range(len(ranks) - 1, -1, -1):
        equal = ranks[k][np.minimum(left, end)] == ranks[k][np.minimum(right, end)]
        step = equal.astype(np.int32) << k
        found += step
        left += step
        right += step
    lcp[pairs] = found
    return lcp


def repeats(documents: list[np.ndarray], limits: Limits, with_spans: bool = False) -> Repeats:
    """The repeats inside each document, given as arrays of word numbers."""
    n_docs = len(documents)
    sizes = np.array([len(d) for d in documents], np.int64)
    ends = np.cumsum(sizes + 1)
    starts = ends - sizes - 1
    doc_of = np.repeat(np.arange(n_docs, dtype=np.int64), sizes + 1)
    symbols = np.empty(int(ends[-1]) if n_docs else 0, np.int64)
    words = np.ones(len(symbols), bool)
    words[ends - 1] = False
    symbols[words] = np.concatenate(documents) if n_docs else []
    symbols[~words] = -1
    symbols += doc_of << 33  # words of different documents differ, and so do the end symbols
    order, ranks = suffix_ranks(symbols)

    depth = int(WINDOW).bit_length() - 1
    windowed = np.zeros(len(symbols), np.int32)
    if len(ranks) > depth:
        rank = ranks[depth]
        windowed[np.bincount(rank, minlength=len(rank))[rank] > 1] = WINDOW
    lcp = neighbour_lcp(order, ranks)
    deepest = np.zeros(len(symbols), np.int32)
    deepest[order] = np.maximum(lcp, np.append(lcp[1:], 0))
    long = np.where(deepest >= limits.min_repeat, deepest, 0)
    united = _cover(long)
    spans: list[list[tuple[int, int]]] = [[] for _ in documents]
    if with_spans:
        edges = np.flatnonzero(np.diff(np.concatenate(([0], united.view(np.int8), [0]))))
        for a, b in edges.reshape(-1, 2):
            d = int(doc_of[a])
            spans[d].append((int(a - starts[d]), int(b - starts[d])))
    per_doc = lambda x: np.add.reduceat(x.astype(np.int64), starts) if n_docs else np.zeros(0, np.int64)
    return Repeats(per_doc(_cover(windowed)), per_doc(united), np.maximum.reduceat(deepest, starts) if n_docs else np.zeros(0, np.int32), spans)


def _cover(lengths: np.ndarray) -> np.ndarray:
    """True where a span [p, p + lengths[p]) lies."""
    at = np.flatnonzero(lengths)
    turn = np.zeros(len(lengths) + 1, np.int32)
    np.add.at(turn, at, 1)
    np.add.at(turn, at + lengths[at], -1)
    return np.cumsum(turn[:-1]) > 0


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def number_words(text: str, numbers: dict[bytes, int]) -> np.ndarray:
    words = text.encode("utf-8", "surrogatepass").split()  # bytes.split() splits at ASCII white space, no other
    return np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))


def judged(texts: list[str], limits: Limits) -> Iterator[tuple]:
    """The RESULT row of each text, in order."""
    at = 0
    while at < len(texts):
        numbers, group, held = _Numbers(), [], 0
        while at < len(texts) and (not group or held < BATCH_WORDS):
            group.append(number_words(texts[at], numbers))
            held += len(group[-1])
            at += 1
        found = repeats(group, limits)
        for i, text in enumerate(texts[at - len(group) : at]):
            n = len(group[i])
            window_words, covered, longest = int(found.in_windows[i]), int(found.covered[i]), int(found.longest[i])
            failed = n < MIN_WORDS or 100 * window_words > MAX_REPEAT_PERCENT * n
            kept = not failed and 100 * covered <= limits.max_percent * n and longest <= limits.longest
            yield (n, *line_counts(text), window_words, covered, longest, failed, kept)


def judge(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """`docs` with the columns of RESULT appended."""
    keep = [c for c in docs.columns if c not in RESULT.names]
    kept = docs.select(*keep)

    def run(batches):
        for batch, texts in id_text_batches(batches):
            rows = list(itertools.zip_longest(*judged(texts, limits))) or [()] * len(RESULT)
            arrays = [pa.array(x, pa.bool_() if f.dataType == T.BooleanType() else pa.int64()) for x, f in zip(rows, RESULT, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=[*batch.schema.names, *RESULT.names])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *RESULT.fields]))


def spans(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """doc_id, start, end of each united span of repeats, in words; what a cleaner would cut out."""

    def run(batches):
        for batch, texts in id_text_batches(batches):
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                out += [(doc_id, a, b) for a, b in repeats([number_words(text, _Numbers())], limits, True).spans[0]]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)] or [pa.array([], pa.int64())] * 3, names=["doc_id", "start", "end"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, start long, end long")


def rules(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """doc_id, the base counts, base_failed and kept for every whole document."""
    return judge(docs.select("doc_id", "text"), limits).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "covered_words", "longest_repeat"
    )
