"""Whole texts as token ids, through a cache of what a public tokenizer makes of each run of characters.

A tokenizer file whose normaliser and pre-tokenizer are those of `SEPARABLE` never joins characters across ASCII white
space, folds letter case and never joins letters to punctuation. The ids of a text are then those of its runs of other
characters, one after another: runs are looked up in lower case, and new ones that are words are encoded many at a time, as
one text that is cut again where a token ends a word. With any other file the library encodes whole texts.

Where a step would not be the library's own, it is left out: a text with the beginning of a special token, or with a
combining mark (lower-case letters compose with more of them than upper-case ones), keeps its case; a word counts as one
only if it is letters alone, in its lower case too, and composed."""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache
from itertools import islice
from unicodedata import is_normalized

import numpy as np

#: Runs held in a worker's cache; beyond that the first quarter stays, as common runs are met early. Bounds memory, never results.
CACHE_RUNS = 1_200_000
#: New words encoded as one text.
JOINED_WORDS = 1_000
PUNCTUATION = b".,;:!?"

#: The parts of a tokenizer file that allow its texts to be encoded in runs.
SEPARABLE = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}


#: Between a letter and a punctuation mark a pre-token ends: a space there changes nothing, and saves runs.
_before_marks = re.compile(rb"([a-z])([.,;:!?])").sub


def _is_word(run: str) -> bool:
    return run.isalpha() and run.lower().isalpha() and is_normalized("NFC", run)


class RunEncoder:
    """Encodes with a tokenizer file, in units of runs between ASCII white space where the file allows it."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.runs: dict[bytes, bytes] = {}
        with open(path, encoding="utf-8") as file:
            form = json.load(file)
        suffix = form["model"].get("end_of_word_suffix")
        plain_specials = all(t["content"].startswith("<|") and not t["content"].split()[1:] for t in form["added_tokens"])
        self.separable = form["normalizer"] == SEPARABLE["normalizer"] and form["pre_tokenizer"] == SEPARABLE["pre_tokenizer"] and form.get("post_processor") is None and bool(suffix) and plain_specials
        if self.separable:
            vocabulary = self.tokenizer.get_vocab()
            self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends_word[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(f.ids, "<u4") for f in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: list[bytes]) -> None:
        """Of words of one pre-token each."""
        for at in range(0, len(words), JOINED_WORDS):
            some = words[at : at + JOINED_WORDS]
            ids = self._ids([b" ".join(some).decode()])[0]
            cuts = (np.flatnonzero(self.ends_word[ids]) + 1) * 4
            if len(cuts) != len(some) or (len(cuts) and cuts[-1] != 4 * len(ids)):
                self._encode(some)
                continue
            data, cuts = ids.tobytes(), cuts.tolist()
            self.runs.update(zip(some, map(data.__getitem__, map(slice, [0, *cuts], cuts)), strict=True))

    def _encode(self, runs: list[bytes]) -> None:
        self.runs.update(zip(runs, (x.tobytes() for x in self._ids([r.decode("utf-8", "replace") for r in runs])), strict=True))

    def _learn(self, missing: set[bytes]) -> None:
        words = {run for run in missing if run.isalpha()}  # bytes: of ASCII letters
        others: set[bytes] = set()
        apart: list[tuple[bytes, bytes, bytes]] = []
        for run in missing - words:
            word = run.rstrip(PUNCTUATION)
            if not word.isascii() and _is_word(word.decode("utf-8", "replace")):
                words.add(word)
                if len(word) < len(run):
                    apart.append((run, word, run[len(word) :]))
                    others.add(run[len(word) :])
            else:
                others.add(run)
        self._encode_words([w for w in words if w not in self.runs])
        self._encode([r for r in others if r not in self.runs])
        runs = self.runs
        for run, word, marks in apart:
            runs[run] = runs[word] + runs[marks]

    def packed(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each whole text (UTF-8) as little-endian unsigned 32-bit integers."""
        if not self.separable:
            return [x.tobytes() for x in self._ids([t.decode("utf-8", "replace") for t in texts])]
        split = [(t if b"<|" in t or b"\xcc" in t or b"\xcd" in t else _before_marks(rb"\1 \2", t.lower())).split() for t in texts]
        if len(self.runs) > CACHE_RUNS:
            self.runs = dict(islice(self.runs.items(), CACHE_RUNS // 4))
        if missing := set().union(*split).difference(self.runs):
            self._learn(missing)
        runs = self.runs
        return [b"".join(map(runs.__getitem__, words)) for words in split]


@lru_cache(maxsize=4)
def run_encoder(path: str) -> RunEncoder:
    """One for each worker process and tokenizer file."""
    return RunEncoder(path)
