"""Mixing sources to target weights with soft membership.

A classifier learned from a labelled table gives every document posteriors over domains. Document rates (expected copies)
are then fitted so that the expected tokens of each domain, sum of rate * tokens * posterior, match targets: projected
gradient descent on the least squares of domain totals, rates kept nonnegative. The totals' residuals are weighted by the inverse
of the token-weighted Gram matrix of the posteriors whose rates are positive, so a handful of rounds suffice. A round is
one pass that updates every rate on the executors and sums a few numbers for each pair of domains.

Defined cases: null and empty texts have no tokens and weigh nothing, their rate follows their posteriors; repeated rows
each have their own rate; labels without a document, null labels and held-out rows are not learned from; a domain that no
label has gets posterior 0; without labels all domains are equally likely; an empty table gives an empty result; columns
of the input that clash with result names are replaced."""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import behind_plain_names, discard, id_text_batches, labelled_sample, materialise
from tessera.llm.shingles import PIECE, U64, mix, word_hashes

#: Labelled rows the classifier is fitted on, at most; hashed features, and those kept by the fit.
SAMPLE = 3000
BUCKETS, FEATURES = 1 << 18, 3000
ROUNDS, CLOSE = 40, 1e-4


def bucket_counts(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a bucket of each word, a bucket of each word's last two bytes, offsets of the words)."""
    hashes, starts = word_hashes(data)
    codes = np.frombuffer(data + b"\0\0", np.uint8).astype(U64)
    ends = starts.copy()
    blank = np.ones(len(data) + 1, bool)
    blank[:-1] = np.isin(np.frombuffer(data, np.uint8), (9, 10, 11, 12, 13, 32))
    stops = np.flatnonzero(blank)
    ends = stops[np.searchsorted(stops, starts)]
    tail = codes[ends - 1] * U64(257) + np.where(ends - starts > 1, codes[ends - 2], U64(0)) + U64(1 << 20)
    return (hashes % U64(BUCKETS)).astype(np.int64), (mix(tail) % U64(BUCKETS)).astype(np.int64), starts


@dataclass(frozen=True)
class Classifier:
    """Multinomial logistic regression on log counts of hashed words and word endings."""

    domains: tuple[str, ...]
    slot: np.ndarray  # bucket -> feature number, or FEATURES for none
    weights: np.ndarray  # (FEATURES + 1, domains); the last row is zero
    bias: np.ndarray

    def posteriors(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(n_words, posteriors) of whole texts."""
        words, scores = np.zeros(len(texts), np.int64), np.zeros((len(texts), len(self.domains)))
        at = 0
        while at < len(texts):
            first, group, held = at, [], 0
            while at < len(texts) and (not group or held + len(texts[at]) <= PIECE):
                group.append(texts[at].encode("utf-8", "surrogatepass"))
                held += len(group[-1])
                at += 1
            doc, slots, counts, words[first:at] = features(group, self.slot, len(self.weights) - 1)
            part = np.log1p(counts)[:, None] * self.weights[slots]
            for k in range(len(self.domains)):
                scores[first:at, k] = np.bincount(doc, part[:, k], minlength=at - first)
        scores += self.bias
        scores = np.exp(scores - scores.max(axis=1, keepdims=True)) if len(texts) else scores
        return words, scores / scores.sum(axis=1, keepdims=True) if len(texts) else scores


def features(group: list[bytes], slot: np.ndarray, none: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, feature, count) of the kept features, and the number of words of each document."""
    a, b, starts = bucket_counts(b"\n".join(group))
    bounds = np.searchsorted(starts, np.cumsum([0] + [len(g) + 1 for g in group]))
    doc = np.repeat(np.arange(len(group)), np.diff(bounds))
    slots = np.concatenate((slot[a], slot[b]))
    pairs = np.concatenate((doc, doc)) * (none + 1) + slots
    found, counts = np.unique(pairs[slots < none], return_counts=True)
    return found // (none + 1), found % (none + 1), counts, np.diff(bounds)


def fit(rows: list[tuple[str, int]], domains: tuple[str, ...], steps: int = 300) -> Classifier:
    """Features by chi-square over presence, then full-batch Adam with a little decay; deterministic."""
    k = len(domains)
    y = np.array([d for _, d in rows], np.int64)
    none = Classifier(domains, np.zeros(BUCKETS, np.int64), np.zeros((1, k)), np.zeros(k))
    if not len(rows):
        return none
    present: list[np.ndarray] = []
    for text, _ in rows:
        a, b, _ = bucket_counts(text.encode("utf-8", "surrogatepass"))
        present.append(np.unique(np.concatenate((a, b))))
    table = np.zeros((k, BUCKETS))
    for d, buckets in zip(y, present, strict=True):
        table[d, buckets] += 1
    share = np.bincount(y, minlength=k) / len(y)
    expected = share[:, None] * table.sum(axis=0)
    chi = np.where(expected > 0, (table - expected) ** 2 / np.maximum(expected, 1e-9), 0).sum(axis=0) * (table.sum(axis=0) >= 3)
    chosen = np.sort(np.argsort(-chi, kind="stable")[:FEATURES])
    slot = np.full(BUCKETS, FEATURES, np.int64)
    slot[chosen] = np.arange(len(chosen))
    x = np.zeros((len(rows), FEATURES), np.float32)
    for i, (text, _) in enumerate(rows):
        _, f, n, _ = features([text.encode("utf-8", "surrogatepass")], slot, FEATURES)
        x[i, f] = np.log1p(n)
    w, bias = np.zeros((FEATURES, k), np.float32), np.log(np.maximum(share, 1e-6))
    target = np.eye(k)[y]
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        z = x @ w + bias
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        error = ((p - target) / len(rows)).astype(np.float32)
        grad = x.T @ error + 2e-5 * w
        mean += 0.1 * (grad - mean)
        square += 0.01 * (grad * grad - square)
        w -= (0.02 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
        bias -= 0.5 * error.sum(axis=0)
    return Classifier(domains, slot, np.vstack((w, np.zeros((1, k)))), bias)


def train(docs: DataFrame, labelled: DataFrame, domains: tuple[str, ...], sample: int = SAMPLE) -> Classifier:
    """`labelled` has doc_id and domain; at most `sample` of its documents that are not held out are learned from."""
    number = F.array_position(F.array(*map(F.lit, domains)), F.col("domain")) - 1
    numbered = labelled.withColumn("number", F.when(number >= 0, number))
    rows = labelled_sample(docs, numbered, "number", sample)
    return fit([(text, d) for _, text, d in rows], domains)


def posteriors(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """`docs` with n_tokens (words) and one column p_<domain> for each domain."""
    names = ["n_tokens", *(f"p_{d}" for d in classifier.domains)]
    kept = docs.select(*[c for c in docs.columns if c not in names])
    sent = docs.sparkSession.sparkContext.broadcast(classifier)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in id_text_batches(batches):
            n, p = sent.value.posteriors(texts)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n), *(pa.array(np.ascontiguousarray(x)) for x in p.T)], names=[*batch.schema.names, *names])

    fields = [T.StructField(names[0], T.LongType()), *(T.StructField(c, T.DoubleType()) for c in names[1:])]
    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *fields]))


def fit_rates(weighted: DataFrame, domains: tuple[str, ...], targets: dict[str, float], budget: float = 1.0, rounds: int = ROUNDS) -> DataFrame:
    """`weighted` (n_tokens and p_<domain> columns) with columns rate and residual: how far the domain that
    is farthest from its target is from it, as a share of all tokens. Beyond CLOSE the targets can not be met (or not in
    `rounds` rounds), and the caller should know.

    Targets are shares; together they take `budget` times the tokens of the table. Rates start from 1."""
    steps, residual = fit_steps(weighted, domains, targets, budget, rounds)
    return weighted.withColumns({"rate": rate_column([F.col(f"p_{d}") for d in domains], steps), "residual": F.lit(residual)})


def rate_column(ps: list[Column], steps: list[list[float]], most: float | None = None) -> Column:
    """The rate, `most` at most, that a row with posteriors `ps` has after the given steps: every step is the same for all rows."""
    bound = (lambda x: F.least(F.lit(most), x)) if most is not None else (lambda x: x)
    table = F.array(*[F.array(*map(F.lit, s)) for s in steps]) if steps else F.array().cast("array<array<double>>")
    return F.aggregate(table, F.lit(1.0), lambda rate, s: bound(F.greatest(F.lit(0.0), rate - reduce(add, [p * s[i] for i, p in enumerate(ps)]))))


def fit_steps(weighted: DataFrame, domains: tuple[str, ...], targets: dict[str, float], budget: float = 1.0, rounds: int = ROUNDS) -> tuple[list[list[float]], float]:
    """The residual (see fit_rates), and the gradient steps, as many numbers each as there are domains: a row's rate moves by their product with its posteriors."""
    ps = [F.col(f"p_{d}") for d in domains]
    tokens = F.col("n_tokens").cast("double")
    k = len(domains)
    total = weighted.agg(F.sum(tokens)).first()[0] or 0.0
    shares = np.array([targets.get(d, 0.0) for d in domains])
    wanted = shares / max(shares.sum(), 1e-12) * total * budget
    steps: list[list[float]] = []
    off = 0.0
    while total:
        rated = weighted.select(tokens.alias("n"), rate_column(ps, steps).alias("rate"), *ps)
        free = F.col("n") * (F.col("rate") > 0).cast("double")
        got = rated.agg(
            *[F.sum(F.col("n") * F.col("rate") * p).alias(f"s{i}") for i, p in enumerate(ps)],
            *[F.sum(free * ps[i] * ps[j]).alias(f"g{i}_{j}") for i in range(k) for j in range(i, k)],
        ).first()
        residual = np.array([got[f"s{i}"] or 0.0 for i in range(k)]) - wanted
        off = float(np.abs(residual).max() / total)
        if off <= CLOSE or len(steps) == rounds:
            break
        gram = np.array([[got[f"g{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(k)] for i in range(k)])
        weight = np.linalg.inv(gram + np.eye(k) * max(1e-9 * np.trace(gram), 1e-12))
        steps.append([float(x) for x in weight @ residual])
    return steps, off


def rates(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], budget: float = 1.0) -> DataFrame:
    """The columns of `docs` but its text, with n_tokens, p_<domain> and rate."""
    domains = tuple(sorted(targets))
    weighted = posteriors(docs, train(docs, labelled, domains))
    return fit_rates(materialise(weighted.drop("text"), "posteriors"), domains, targets, budget)


def mixed(docs: DataFrame, classifier: Classifier, targets: dict[str, float], anchor: str, seed: int = 11) -> DataFrame:
    """`docs` thinned out to the target shares of expected tokens: no row comes out twice.

    Every row whose most probable domain is the anchor stays, once. Every other row has a rate of its own between 0 and 1, which its posteriors
    decide (see bounded_steps) and by which its own hash keeps it. How far the shares are from the targets is told as a warning,
    where they can not be met. Texts are classified twice rather than written; the posteriors are, while rates are fitted."""

    def thin(rows: DataFrame) -> DataFrame:
        weighted = posteriors(rows, classifier)
        narrow = materialise(weighted.select("n_tokens", *(f"p_{d}" for d in classifier.domains)), "posteriors")
        steps, residual = bounded_steps(narrow, classifier.domains, targets, anchor)
        discard(narrow)
        if residual > CLOSE:
            warnings.warn(f"mixing: a domain's tokens are {residual:.4f} of all tokens away from their target", stacklevel=2)
        chance = F.pmod(F.xxhash64(*[F.col(c) for c in ("doc_id", "text") if c in rows.columns], F.lit(seed)), F.lit(1_000_003)) / 1_000_003
        return weighted.filter(chance < bounded_rate(classifier.domains, targets, anchor, steps))

    return behind_plain_names(docs, thin, ["n_tokens", *(f"p_{d}" for d in classifier.domains)])


def beyond(domains: tuple[str, ...], targets: dict[str, float], anchor: str) -> list[Column]:
    """How far a token of a row brings each other domain beyond its share, measured by the anchor's tokens."""
    ratio = {d: targets.get(d, 0.0) / max(targets[anchor], 1e-12) for d in domains if d != anchor}
    return [F.col(f"p_{d}") - r * F.col(f"p_{anchor}") for d, r in ratio.items()]


def is_anchor(domains: tuple[str, ...], anchor: str) -> Column:
    return F.col(f"p_{anchor}") >= F.greatest(*[F.col(f"p_{d}") for d in domains], F.lit(0.0))


def bounded_rate(domains: tuple[str, ...], targets: dict[str, float], anchor: str, steps: list[list[float]]) -> Column:
    """The rate of a row after the given steps, each projected onto 0 to 1; rows of the anchor have 1."""
    return F.when(is_anchor(domains, anchor), F.lit(1.0)).otherwise(rate_column(beyond(domains, targets, anchor), steps, most=1.0))


def bounded_steps(weighted: DataFrame, domains: tuple[str, ...], targets: dict[str, float], anchor: str, rounds: int = ROUNDS) -> tuple[list[list[float]], float]:
    """Projected gradient steps on the tokens of each other domain beyond its share, and what is left of them at worst, as a share of all tokens.

    As in fit_steps a round is one pass, and residuals are weighted by an inverse Gram matrix: that of the rows within their bounds,
    as long as such steps bring the weighted residuals down, then that of all rows but the anchor's, which does for a step of length 1; longer
    ones are tried while they do. Rates start from 1. Targets that can not be met may not be met as nearly as possible after `rounds` rounds."""
    vs, rate = beyond(domains, targets, anchor), F.col("rate")
    k = len(vs)
    tokens = F.col("n_tokens").cast("double")
    kept: list[list[float]] = []
    tried, best, all_rows, quick, length = kept, None, None, True, 4.0
    for _ in range(rounds + 1):
        rated = weighted.select(tokens.alias("n"), bounded_rate(domains, targets, anchor, tried).alias("rate"), (~is_anchor(domains, anchor)).alias("moves"), *[v.alias(f"v{i}") for i, v in enumerate(vs)])
        free = F.col("n") * (F.col("moves") & ((rate > 0) & (rate < 1) if tried else F.lit(True))).cast("double")
        got = rated.agg(
            F.sum(F.col("n") * rate).alias("kept"),
            *[F.sum(F.col("n") * rate * F.col(f"v{i}")).alias(f"s{i}") for i in range(k)],
            *[F.sum(free * F.col(f"v{i}") * F.col(f"v{j}")).alias(f"g{i}_{j}") for i in range(k) for j in range(i, k)],
        ).first()
        residual = np.array([got[f"s{i}"] or 0.0 for i in range(k)])
        gram = np.array([[got[f"g{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(k)] for i in range(k)])
        inverse = np.linalg.inv(gram + np.eye(k) * max(1e-9 * np.trace(gram), 1e-12))
        all_rows = inverse if all_rows is None else all_rows
        far = float(residual @ all_rows @ residual)
        better = best is None or far < best[0] * (1 - 1e-6)
        if better:
            kept, best = tried, (far, residual, float(np.abs(residual).max(initial=0.0) / (got["kept"] or 1.0)))
            length = length if quick else length * 4
            quick = quick and bool(np.trace(gram) > 0)
        elif quick:
            quick = False
        elif length > 1:
            length = max(length / 8, 1.0)
        else:
            break
        if best[2] <= CLOSE:
            break
        tried = [*kept, [float(x) for x in (inverse if quick else all_rows * length) @ best[1]]]
    return kept, best[2]
