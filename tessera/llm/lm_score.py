"""LM scoring by cross-entropy difference.

Two bigram models with one vocabulary, one order and one smoothing: the target's from labelled documents of good quality,
the background's from every document. A document's score is the mean over its tokens of background loss minus target
loss, in nats: above zero it reads more like the target.

`score_corpus` counts every word and every pair of words of the corpus. Chunks of documents send their distinct pairs and
words to buckets by the hash of the context or word; buckets sum them for both models and send the sums back, so the
models lie on the executors and grow with the corpus. Words are told apart by 64 bits of their hash, the words after one
context by 48.

`train` and `score` are the small form for a bounded vocabulary: a model is a square table of it, which is broadcast, and
words outside fall into four classes by their characters.

Defined cases: null and empty texts have no tokens and score 0.0 with both losses 0.0; ties in vocabulary frequency go to
the smaller word; an empty target or corpus leaves uniform models; repeated rows are counted as often as they occur and
score alike; other columns are not read."""

from __future__ import annotations

import hashlib
import io
import struct
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import free_shuffles, held_out, id_text_batches, materialise

#: Rows and columns of the models: START, four classes of other words, then words.
VOCABULARY = 2048
START, DIGITS, SIGNS, CAPITALS, OTHER = range(5)
DISCOUNT = 0.75
HELD_WORDS = 400_000
HELD_CELLS = 3_000_000


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()


class Vocabulary(dict):
    """Word to number; a word outside gets its class, which is held for a while to save work."""

    def __missing__(self, word: bytes) -> int:
        text = word.decode("utf-8", "replace")
        if any(c.isdigit() for c in text):
            found = DIGITS
        elif any(not c.isalnum() for c in text[:-1]):
            found = SIGNS
        elif text.isupper():
            found = CAPITALS
        else:
            found = OTHER
        self[word] = found
        return found


def vocabulary(docs: DataFrame, size: int = VOCABULARY) -> list[bytes]:
    """The most frequent words of the whole table."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held.keys()), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for _, texts in id_text_batches(batches):
            for text in texts:
                held.update(words_of(text))
                if len(held) > HELD_WORDS:
                    yield out()
                    held.clear()
        yield out()

    counts = docs.select("text").mapInArrow(counted, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return [bytes(r["word"]) for r in counts.orderBy(F.desc("n"), "word").limit(size - OTHER - 1).collect()]


def numbered(texts: list[str], numbers: Vocabulary, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(context * VOCABULARY-size cell of every token of the texts, tokens of each text)."""
    if len(numbers) > limit + HELD_WORDS:
        for word in [w for w, n in numbers.items() if n <= OTHER]:
            del numbers[word]
    size = limit + OTHER + 1
    split = [words_of(t) for t in texts]
    lengths = np.array([len(s) for s in split], np.int64)
    ids = np.fromiter((n for s in split for n in map(numbers.__getitem__, s)), np.int64, int(lengths.sum()))
    context = np.empty_like(ids)
    context[1:] = ids[:-1]
    context[(np.cumsum(lengths) - lengths)[lengths > 0]] = START
    return context * size + ids, lengths


def pair_counts(docs: DataFrame, targets: DataFrame, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(target, background) counts of every cell, over all documents; `targets` has the doc_ids of the target."""
    size = len(words) + OTHER + 1
    sent = docs.sparkSession.sparkContext.broadcast(words)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = Vocabulary((w, i + OTHER + 1) for i, w in enumerate(sent.value))
        sums = np.zeros((2, size * size), np.int64)
        held: tuple[list, list] = [], []
        n_held = 0

        def flush() -> None:
            for side, cells in enumerate(held):
                if cells:
                    sums[side] += np.bincount(np.concatenate(cells), minlength=size * size)
                    cells.clear()

        for batch, texts in id_text_batches(batches):
            is_target = batch.column("is_target").to_numpy(zero_copy_only=False)
            for at in range(0, len(texts), 512):
                cells, lengths = numbered(texts[at : at + 512], numbers, len(sent.value))
                held[1].append(cells)
                held[0].append(cells[np.repeat(is_target[at : at + 512], lengths)])
                n_held += len(cells)
                if n_held > HELD_CELLS:
                    flush()
                    n_held = 0
        flush()
        found = np.flatnonzero(sums[1])
        for part in np.array_split(found, max(1, len(found) // 100_000)):
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(sums[0][part]), pa.array(sums[1][part])], names=["cell", "target", "background"])

    # a merge join at every size: the labels grow with the documents, so they are never broadcast
    chosen = targets.select("doc_id").distinct().withColumn("is_target", F.lit(True)).hint("merge")
    marked = docs.join(chosen, "doc_id", "left")
    marked = marked.select("text", F.coalesce("is_target", F.lit(False)).alias("is_target"))
    counts = marked.mapInArrow(counted, "cell long, target long, background long").groupBy("cell").agg(F.sum("target").alias("target"), F.sum("background").alias("background"))
    got = counts.toArrow()  # size * size rows at most
    out = np.zeros((2, size * size), np.int64)
    for side, name in enumerate(("target", "background")):
        out[side][got.column("cell").to_numpy()] = got.column(name).to_numpy()
    return out[0].reshape(size, size), out[1].reshape(size, size)


def losses(counts: np.ndarray) -> np.ndarray:
    """-log p(word | context): absolute discounting, backed off to words, and these to the uniform distribution."""
    size = len(counts)
    words = counts.sum(axis=0).astype(np.float64)
    total = words.sum()
    lower = (words + 1) / (total + size)
    seen = counts.sum(axis=1, keepdims=True).astype(np.float64)
    kinds = (counts > 0).sum(axis=1, keepdims=True)
    rest = np.where(seen > 0, DISCOUNT * kinds / np.maximum(seen, 1), 1.0)
    return -np.log(np.maximum(counts - DISCOUNT, 0) / np.maximum(seen, 1) + rest * lower).astype(np.float64)


@dataclass(frozen=True)
class Models:
    words: list[bytes]
    target: np.ndarray  # losses, float32
    background: np.ndarray


def good(labels: DataFrame) -> DataFrame:
    """doc_id of what labels mark as of good quality and not toxic, held-out rows apart."""
    return labels.filter((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0) & ~held_out()).select("doc_id")


def train(docs: DataFrame, labels: DataFrame, size: int = VOCABULARY) -> Models:
    """Both models over a bounded vocabulary."""
    docs = docs.select("doc_id", "text")
    targets = good(labels)
    words = vocabulary(docs, size)
    return Models(words, *(losses(c).astype(np.float32) for c in pair_counts(docs, targets, words)))


def score(docs: DataFrame, models: Models) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss (nats a token) and score = background_loss - target_loss."""
    sent = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        numbers = Vocabulary((w, i + OTHER + 1) for i, w in enumerate(m.words))
        for batch, texts in id_text_batches(batches):
            rows = []
            for at in range(0, len(texts), 512):
                cells, lengths = numbered(texts[at : at + 512], numbers, len(m.words))
                bounds = np.concatenate(([0], np.cumsum(lengths)))
                means = []
                for table in (m.target, m.background):
                    sums = np.concatenate(([0.0], np.cumsum(table.ravel()[cells].astype(np.float64))))
                    means.append((sums[bounds[1:]] - sums[bounds[:-1]]) / np.maximum(lengths, 1))
                rows.append((lengths, *means))
            n, target, background = (np.concatenate(x) for x in zip(*rows, strict=True)) if rows else (np.zeros(0, np.int64), np.zeros(0), np.zeros(0))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n), pa.array(target), pa.array(background), pa.array(background - target)],
                names=["doc_id", "n_tokens", "target_loss", "background_loss", "score"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_tokens long, target_loss double, background_loss double, score double")


# ------------------------------------------------------------------ every word of the corpus
#: Tokens that a task holds at once; a chunk sends each of its distinct pairs and words once.
CHUNK_TOKENS = 3_000_000
LOW_48 = np.uint64((1 << 48) - 1)


class Numbered(dict):
    """Word to number in order of appearance; 0 is the start of a text."""

    def __missing__(self, word: bytes) -> int:
        self[word] = found = len(self) + 1
        return found


def hashed(words: list[bytes]) -> np.ndarray:
    """64 bits of each word, the same on every machine; 0 is kept for the start of a text."""
    found = np.frombuffer(b"".join(hashlib.blake2b(w, digest_size=8).digest() for w in words), "<u8")
    return np.concatenate((np.zeros(1, np.uint64), np.maximum(found, np.uint64(1))))


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value: whole numbers by their first, second, ... bytes, which repeat."""
    out = io.BytesIO()
    for a in arrays:
        a = np.ascontiguousarray(a)
        wide = a.view(np.uint8).reshape(len(a), a.itemsize).T
        body = np.ascontiguousarray(wide[wide.any(axis=1)] if len(a) else wide[:0]).tobytes()
        used = sum(1 << i for i, row in enumerate(wide) if len(a) and row.any())
        held = pa.compress(body, "zstd", asbytes=True)
        out.write(struct.pack("<cBBqqq", a.dtype.kind.encode(), a.itemsize, used, len(a), len(body), len(held)) + held)
    return out.getvalue()


def unpacked(value: bytes) -> list[np.ndarray]:
    at, out, head = 0, [], struct.calcsize("<cBBqqq")
    while at < len(value):
        kind, width, used, n, size, held = struct.unpack_from("<cBBqqq", value, at)
        at += head
        rows = np.zeros((width, n), np.uint8)
        rows[[i for i in range(width) if used >> i & 1]] = np.frombuffer(pa.decompress(value[at : at + held], size, "zstd"), np.uint8).reshape(used.bit_count(), n)
        out.append(np.ascontiguousarray(rows.T).reshape(-1).view(f"{kind.decode()}{width}"))
        at += held
    return out


def chunks(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """Chunks of documents as numbers: ids, nulls, target marks and lengths of documents, then each token's word in the
    chunk and the words' hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, docs, tokens = Numbered(), [], []
        n_held = 0

        def out() -> pa.RecordBatch:
            told = packed(*(np.concatenate(x) for x in zip(*docs, strict=True)))
            return batch_of(chunk=[uuid.uuid4().hex], docs=[told], tokens=[packed(np.concatenate(tokens), hashed(list(numbers)))])

        for batch, texts in id_text_batches(batches):
            for at in range(0, len(texts), 512):
                split = [words_of(t) for t in texts[at : at + 512]]
                ids, marks = batch.column("doc_id").slice(at, 512), batch.column("is_target").slice(at, 512)
                n = np.array([len(s) for s in split], np.int64)
                tokens.append(np.fromiter((numbers[w] for s in split for w in s), np.uint32, int(n.sum())))
                docs.append((ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), marks.to_numpy(zero_copy_only=False), n))
                n_held += len(tokens[-1])
                if n_held >= CHUNK_TOKENS:
                    yield out()
                    numbers.clear(), docs.clear(), tokens.clear()
                    n_held = 0
        if docs:
            yield out()

    # a merge join at every size: the labels grow with the documents, so they are never broadcast
    chosen = targets.select("doc_id").distinct().withColumn("is_target", F.lit(True)).hint("merge")
    marked = docs.join(chosen, "doc_id", "left").select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce("is_target", F.lit(False)).alias("is_target"))
    return marked.mapInArrow(run, "chunk string, docs binary, tokens binary")


def batch_of(**columns: list) -> pa.RecordBatch:
    kinds = {str: pa.string(), bytes: pa.binary(), int: pa.int32()}
    return pa.RecordBatch.from_arrays([pa.array(v, kinds[type(v[0])]) for v in columns.values()], names=list(columns))


@dataclass(frozen=True)
class Layout:
    """A chunk's distinct pairs and words in the order in which buckets get them and answer."""

    n: np.ndarray
    pair: np.ndarray  # of each token
    first: np.ndarray  # of each pair
    second: np.ndarray
    words: np.ndarray
    place: np.ndarray  # bucket of each word of the chunk
    background: np.ndarray  # of each pair
    target: np.ndarray


def laid(n: np.ndarray, marks: np.ndarray, token: np.ndarray, hashes: np.ndarray, buckets: int) -> Layout:
    token = token.astype(np.int64)
    context = np.empty_like(token)
    context[1:] = token[:-1]
    context[(np.cumsum(n) - n)[n > 0]] = 0
    pairs, at, background = np.unique(context * len(hashes) + token, return_inverse=True, return_counts=True)
    target = np.bincount(at[marks], minlength=len(pairs))
    first, second = np.divmod(pairs, len(hashes))
    place = (hashes % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(place[first], kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    return Layout(n, rank[at], first[order], second[order], np.argsort(place, kind="stable"), place, background[order], target[order])


def asked(made: DataFrame, buckets: int) -> DataFrame:
    """What each chunk sends to each bucket: words whose hash falls there and the pairs they begin, with both counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, docs, tokens in zip(*(batch.column(c).to_pylist() for c in ("chunk", "docs", "tokens")), strict=True):
                (_, _, target, n), (token, hashes) = unpacked(docs), unpacked(tokens)
                marks = np.repeat(target, n)
                x = laid(n, marks, token, hashes, buckets)
                runs, of_words = (np.bincount(i, minlength=len(hashes))[x.words] for i in (x.first, token))
                of_target = np.bincount(token[marks], minlength=len(hashes))[x.words]
                ends = np.arange(buckets + 1)
                pair_ends, word_ends = np.searchsorted(x.place[x.first], ends), np.searchsorted(x.place[x.words], ends)
                for b in range(buckets):
                    p, w = slice(*pair_ends[b : b + 2]), slice(*word_ends[b : b + 2])
                    if w.start < w.stop:
                        ids = packed(hashes[x.words[w]], runs[w], hashes[x.second[p]] & LOW_48)
                        yield batch_of(chunk=[chunk], bucket=[b], ids=[ids], numbers=[packed(x.target[p], x.background[p], of_target[w], of_words[w])])

    return made.mapInArrow(run, "chunk string, bucket int, ids binary, numbers binary")


def summed(keys: tuple[np.ndarray, ...], counts: tuple[np.ndarray, ...]) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
    """(number of each row's distinct key, sums of each distinct key), keys in ascending order."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    of = np.empty(len(order), np.int64)
    of[order] = np.cumsum(new) - 1
    return of, tuple(np.bincount(of, c, int(new.sum())).astype(np.int64) for c in counts)


def counted(table: pa.Table) -> pa.Table:
    """A bucket's counts over all chunks, sent back to each chunk in the order of what it asked for: pairs, what follows
    their contexts (tokens and kinds), words, pairs of each context; both models. n_words and the sums are of the bucket."""
    if not table.num_rows:
        return pa.table({"chunk": pa.array([], pa.string()), "bucket": pa.array([], pa.int32()), "numbers": pa.array([], pa.binary()), **{k: pa.array([], pa.int64()) for k in ("n_words", "target", "background")}})
    ids = [unpacked(x) for x in table.column("ids").to_pylist()]
    told = [unpacked(x) for x in table.column("numbers").to_pylist()]
    join = lambda rows, i: np.concatenate([r[i] for r in rows])
    contexts = np.concatenate([np.repeat(w, runs) for w, runs, _ in ids])
    pair, both = summed((contexts, join(ids, 2)), (join(told, 0), join(told, 1)))
    owner = np.zeros(len(both[0]), np.uint64)
    owner[pair] = contexts
    kinds, start = np.unique(owner, return_inverse=True)
    # what follows a context, for each of its pairs
    after = [np.bincount(start, x, len(kinds)).astype(np.int64) for c in both for x in (c, c > 0)]
    word, words = summed((join(ids, 0),), (join(told, 2), join(told, 3)))
    out, at_pair, at_word = [], 0, 0
    for own, runs, pairs in ids:
        p, w = pair[at_pair : at_pair + len(pairs)], word[at_word : at_word + len(own)]
        k = np.searchsorted(kinds, own[runs > 0])
        out.append(packed(both[0][p], both[1][p], *(a[k] for a in after), words[0][w], words[1][w], runs[runs > 0]))
        at_pair, at_word = at_pair + len(pairs), at_word + len(own)
    sums = [[int((words[1] > 0).sum()), int(words[0].sum()), int(words[1].sum())]] + [[0, 0, 0]] * (len(out) - 1)
    n = list(zip(*sums, strict=True))
    return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"), "numbers": pa.array(out, pa.binary()), **{k: pa.array(v, pa.int64()) for k, v in zip(("n_words", "target", "background"), n, strict=True)}})


def score_corpus(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The columns of `score` for every document, by models of every word and pair of words of the corpus.

    Nothing grows on the driver: chunks of documents ask buckets, by the hash of a context or word, for their counts."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    made = materialise(chunks(docs, good(labels)), "lm-chunks")
    free_shuffles(spark)
    answers = "chunk string, bucket int, numbers binary, n_words long, target long, background long"
    told = materialise(asked(made, buckets).groupBy("bucket").applyInArrow(counted, answers), "lm-counts")
    free_shuffles(spark)
    n_words, *totals = (x or 0 for x in told.agg(F.sum("n_words"), F.sum("target"), F.sum("background")).first())

    def scored(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("bucket", "numbers", "docs", "tokens")), strict=True), key=lambda r: r[0])
        (doc_ids, nulls, target, n), (token, hashes) = unpacked(rows[0][2]), unpacked(rows[0][3])
        x = laid(n, np.repeat(target, n), token, hashes, buckets)
        word = np.empty(len(hashes), np.int64)
        word[x.words] = np.arange(len(hashes))
        got = [unpacked(r[1]) for r in rows[1:]]
        join = lambda i: np.concatenate([g[i] for g in got])
        bounds, means = np.concatenate(([0], np.cumsum(n))), []
        for side in (0, 1):
            seen, kinds = (np.repeat(join(2 + 2 * side + i), join(8)) for i in (0, 1))
            lower = (join(6 + side)[word[x.second]] + 1) / (totals[side] + n_words)
            rest = np.where(seen > 0, DISCOUNT * kinds / np.maximum(seen, 1), 1.0)
            loss = -np.log(np.maximum(join(side) - DISCOUNT, 0) / np.maximum(seen, 1) + rest * lower)
            sums = np.concatenate(([0.0], np.cumsum(loss[x.pair])))
            means.append((sums[bounds[1:]] - sums[bounds[:-1]]) / np.maximum(n, 1))
        return pa.table({"doc_id": pa.array(doc_ids, mask=nulls), "n_tokens": n, "target_loss": means[0], "background_loss": means[1], "score": means[1] - means[0]})

    none = F.lit(None).cast("binary")
    own = made.select("chunk", F.lit(-1).alias("bucket"), none.alias("numbers"), "docs", "tokens")
    rows = own.unionByName(told.select("chunk", "bucket", "numbers", none.alias("docs"), none.alias("tokens")))
    return rows.groupBy("chunk").applyInArrow(scored, "doc_id long, n_tokens long, target_loss double, background_loss double, score double")
