"""Edit-aware token counts.

A document's pre-tokens (what the tokenizer's pattern splits the text into) lie in order in the slots of a segment tree,
whose nodes hold the sums of characters and tokens below. An edit replaces a range of characters: the tree finds the slots
it touches, the text from two pre-tokens before the edit is split again until a new boundary falls on an old one behind
the edit, only the pre-tokens in between are encoded, and the sums of their slots' ancestors are updated. Two pre-tokens
are context enough: the pattern looks no further than the end of a run of white space, or two characters past a match.

Counts of pre-tokens are looked up once they are known to a worker. Defined cases: null and empty texts have no tokens and
no edits; an edit may insert (empty range), delete (empty text) or do nothing; edits apply one after another, each to the
text that the ones before it left, and ranges are clipped to that text; repeated rows count alike; an empty table gives an
empty result; other columns pass through untouched in `edited` and are not read by `count`."""

from __future__ import annotations

import base64
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import id_text_batches

SLOT = 16
CACHE_PIECES = 700_000
Edit = tuple[int, int, str]


class PieceCounts(dict):
    """Pre-token to its number of tokens."""

    def __init__(self, ranks_file: str, pattern: str) -> None:
        import tiktoken

        with open(ranks_file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.encoded = 0

    def __missing__(self, piece: str) -> int:
        self.encoded += 1
        found = len(self.encoding.encode_ordinary(piece))
        if len(self) >= CACHE_PIECES:
            self.clear()
        self[piece] = found
        return found


@lru_cache(maxsize=2)
def piece_counts(ranks_file: str, pattern: str) -> PieceCounts:
    """One for each worker process and vocabulary."""
    return PieceCounts(ranks_file, pattern)


class TokenTree:
    """The pre-tokens of one text, with sums."""

    def __init__(self, text: str, counts: PieceCounts) -> None:
        self.counts = counts
        self.reencoded = 0
        self._build(counts.pattern.findall(text))

    def _build(self, pieces: list[str]) -> None:
        self.slots = [pieces[i : i + SLOT] for i in range(0, len(pieces), SLOT)] or [[]]
        self.size = 1 << (len(self.slots) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.size), [0] * (2 * self.size)
        for i, slot in enumerate(self.slots):
            self.chars[self.size + i] = sum(map(len, slot))
            self.tokens[self.size + i] = sum(map(self.counts.__getitem__, slot))
        for i in range(self.size - 1, 0, -1):
            self._sum(i)

    def _sum(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    def text(self) -> str:
        return "".join(p for slot in self.slots for p in slot)

    def tokens_before(self, offset: int) -> int:
        """Tokens of the pre-tokens that end at or before a character offset."""
        slot, start, tokens = self._slot(offset)
        for piece in self.slots[slot]:
            start += len(piece)
            if start > offset:
                break
            tokens += self.counts[piece]
        return tokens

    def _slot(self, offset: int) -> tuple[int, int, int]:
        """(slot that holds a character, characters before the slot, tokens before it); the last slot for the end."""
        offset = min(offset, max(self.n_chars - 1, 0))
        i, chars, tokens = 1, 0, 0
        while i < self.size:
            i *= 2
            if offset >= chars + self.chars[i]:
                chars += self.chars[i]
                tokens += self.tokens[i]
                i += 1
        return min(i - self.size, len(self.slots) - 1), chars, tokens

    def edit(self, start: int, end: int, text: str) -> None:
        """Replace the characters [start, end) by `text`."""
        start = max(0, min(start, self.n_chars))
        end = max(start, min(end, self.n_chars))
        first, at, _ = self._slot(start)
        # two pre-tokens of context before the one that the edit touches: at most the slots that hold them
        inside = bisect_right(list(accumulate(map(len, self.slots[first]))), max(start - at - 1, 0))
        before = inside
        while before < 2 and first:
            first -= 1
            at -= self.chars[self.size + first]
            before += len(self.slots[first])
        last, last_at, _ = self._slot(end)
        stop = last_at + self.chars[self.size + last]
        old = [p for slot in self.slots[first : last + 1] for p in slot]
        held = "".join(old)
        shift = len(text) - (end - start)
        kept = self._untouched(old, start - at)
        pieces, position = old[:kept], at + sum(map(len, old[:kept]))
        old_ends = {at + n for n in accumulate(map(len, old), initial=0)}
        new = held[: start - at] + text + held[end - at :]
        scan = position - at
        while True:
            # old boundaries behind the edit, in new coordinates; the end of the region needs what follows it
            found = None
            for found in self.counts.pattern.finditer(new, scan):
                # a match that reaches the end of what is at hand may go on: take in the next slot first
                if len(new) - found.end() < 2 and last + 1 < len(self.slots):
                    break
                pieces.append(found.group())
                scan = found.end()
                self.reencoded += 1
                position = at + scan - shift
                if scan >= start - at + len(text) and position >= end and position in old_ends:
                    pieces += self._old_tail(old, at, position)
                    return self._put(first, last, pieces)
            else:
                if last + 1 >= len(self.slots):
                    return self._put(first, last, pieces)
            last += 1
            more = self.slots[last]
            new += "".join(more)
            old += more
            base = stop
            for p in more:
                base += len(p)
                old_ends.add(base)
            stop = base

    @staticmethod
    def _untouched(old: list[str], offset: int) -> int:
        """How many leading pre-tokens stay as they are: all but the two before the one that ends at `offset` or later."""
        n = end = 0
        for n, p in enumerate(old):  # noqa: B007
            end += len(p)
            if end >= offset:
                break
        return max(0, n - 2)

    @staticmethod
    def _old_tail(old: list[str], at: int, position: int) -> list[str]:
        for i, p in enumerate(old):
            if at >= position:
                return old[i:]
            at += len(p)
        return []

    def _put(self, first: int, last: int, pieces: list[str]) -> None:
        if len(pieces) > 4 * SLOT * (last - first + 1):
            return self._build([p for slot in (*self.slots[:first], pieces, *self.slots[last + 1 :]) for p in slot])
        share = -(-len(pieces) // (last - first + 1)) or 1
        for i in range(first, last + 1):
            slot = self.slots[i] = pieces[(i - first) * share : (i - first + 1) * share]
            self.chars[self.size + i] = sum(map(len, slot))
            self.tokens[self.size + i] = sum(map(self.counts.__getitem__, slot))
        low, high = (self.size + first) // 2, (self.size + last) // 2
        while low:
            for i in range(low, high + 1):
                self._sum(i)
            low, high = low // 2, high // 2
        return None


#: What the registered query edits: personal data is masked (fixed patterns), lines that repeat an earlier line go.
MASKS = (
    (regex.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"), "<EMAIL>"),
    (regex.compile(r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d.])"), "<IP>"),
    (regex.compile(r"\+?\(?\d[\d() -]{6,}\d"), "<PHONE>"),
)


def cleaning_edits(text: str) -> list[Edit]:
    """Masks and removals of a whole text, from its end to its start so that offsets hold; ranges do not overlap."""
    found: list[Edit] = []
    at, seen = 0, set()
    for line in text.split("\n"):
        if line.strip():
            if line in seen:
                found.append((max(at - 1, 0), at + len(line), ""))
            seen.add(line)
        at += len(line) + 1
    taken = sorted((a, b) for a, b, _ in found)
    starts = [a for a, _ in taken]
    for pattern, mask in MASKS:
        for m in pattern.finditer(text):
            i = bisect_right(starts, m.end() - 1)
            if not any(a < m.end() and m.start() < b for a, b in taken[max(0, i - 1) : i + 1]):
                found.append((m.start(), m.end(), mask))
        taken = sorted((a, b) for a, b, _ in found)
        starts = [a for a, _ in taken]
    return sorted(found, reverse=True)


def count(docs: DataFrame, ranks_file: str, pattern: str, edits: Callable[[str], list[Edit]] = cleaning_edits) -> DataFrame:
    """doc_id, n_pieces, tokens_before, n_edits, reencoded (pre-tokens split again), tokens_after of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = piece_counts(ranks_file, pattern)
        names = ["n_pieces", "tokens_before", "n_edits", "reencoded", "tokens_after"]
        for batch, texts in id_text_batches(batches):
            rows = []
            for text in texts:
                todo = edits(text)
                if not todo:
                    pieces = counts.pattern.findall(text)
                    n = sum(map(counts.__getitem__, pieces))
                    rows.append((len(pieces), n, 0, 0, n))
                    continue
                tree = TokenTree(text, counts)
                pieces, n = sum(map(len, tree.slots)), tree.n_tokens
                for edit in todo:
                    tree.edit(*edit)
                rows.append((pieces, n, len(todo), tree.reencoded, tree.n_tokens))
            columns = zip(*rows, strict=True) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns)], names=["doc_id", *names])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_pieces long, tokens_before long, n_edits long, reencoded long, tokens_after long")


def edited(docs: DataFrame, edits: DataFrame, ranks_file: str, pattern: str) -> DataFrame:
    """doc_id, tokens_before, tokens_after, text (edited) of each document that `edits` (doc_id, seq, start, stop, replacement) changes.

    The edits of one document are applied in order of seq by one task, which holds that document and its own edits."""
    listed = edits.dropna(subset=["doc_id", "start", "stop"]).groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("seq", "start", "stop", F.coalesce("replacement", F.lit("")).alias("replacement")))).alias("todo")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = piece_counts(ranks_file, pattern)
        for batch, texts in id_text_batches(batches):
            rows = []
            for text, todo in zip(texts, batch.column("todo").to_pylist(), strict=True):
                tree = TokenTree(text, counts)
                n = tree.n_tokens
                for e in todo:
                    tree.edit(e["start"], e["stop"], e["replacement"])
                rows.append((n, tree.n_tokens, tree.text()))
            before, after, out = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(before, pa.int64()), pa.array(after, pa.int64()), pa.array(out, pa.string())], names=["doc_id", "tokens_before", "tokens_after", "text"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(listed, "doc_id").mapInArrow(run, "doc_id long, tokens_before long, tokens_after long, text string")
