"""Quality classifier: a byte-level convolutional network in numpy.

Every byte is embedded, learned filters of two blocks (16 bytes) slide over the whole document in steps of one block
(8 bytes), so neighbouring chunks overlap by half; each filter's largest response over the document is kept, and one
logistic unit combines the pooled responses into a probability.

Defined cases: a null or empty text is a document of padding and gets a score like any other; texts are never cut, a very
long one is scored in pieces whose responses are max-pooled; repeated rows get equal scores; an empty table gives an
empty result; extra columns pass through untouched and never reach the score. With no usable labels (none, or of one
class) the score of every document is that class's share, 0.5 if there are none.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import held_out, id_text_batches, labelled_sample

BLOCK, WIDTH, FILTERS = 8, 8, 24
#: Bytes convolved at once; bounds memory whatever the length of a document.
PIECE = 1 << 17
#: Labelled rows that a model is fitted on, at most.
SAMPLE = 3000
THRESHOLD = 0.3


@dataclass(frozen=True)
class ByteCNN:
    embedding: np.ndarray  # (256, WIDTH)
    kernel: np.ndarray  # (BLOCK * WIDTH, 2 * FILTERS): left half-filters, then right ones
    bias: np.ndarray  # (FILTERS,)
    out: np.ndarray  # (FILTERS,)
    offset: float
    constant: float | None = None

    def responses(self, data: bytes) -> np.ndarray:
        """(chunks, FILTERS) responses of padded bytes: chunk i covers blocks i and i + 1."""
        codes = np.frombuffer(data, np.uint8)
        halves = self.embedding[codes].reshape(-1, BLOCK * WIDTH) @ self.kernel
        return halves[:-1, :FILTERS] + halves[1:, FILTERS:]

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """(documents, FILTERS): the largest response of each filter over each whole document."""
        out = np.full((len(texts), FILTERS), -np.inf, np.float32)
        group: list[int] = []
        held = 0
        for i, text in enumerate(texts):
            if len(text) > PIECE:
                for at in range(0, len(text) - BLOCK, PIECE):  # a last block alone is in the chunk before it
                    piece = padded(text[at : at + PIECE + BLOCK])  # one block more, so that no chunk is missed
                    out[i] = np.maximum(out[i], self.responses(piece).max(axis=0))
                continue
            if group and held + len(text) > PIECE:
                self._pool(texts, group, out)
                group, held = [], 0
            group.append(i)
            held += len(text) + 2 * BLOCK
        if group:
            self._pool(texts, group, out)
        return out

    def _pool(self, texts: list[bytes], group: list[int], out: np.ndarray) -> None:
        parts = [padded(texts[i]) for i in group]
        ends = np.cumsum([len(p) // BLOCK for p in parts])
        starts = np.concatenate(([0], ends[:-1]))
        z = self.responses(b"".join(parts))
        # the chunk that starts in a document's last block belongs to no document
        edges = np.column_stack((starts, ends - 1)).ravel()[:-1]
        out[group] = np.maximum.reduceat(z, edges, axis=0)[::2]

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        hidden = np.maximum(self.pooled(texts) + self.bias, 0)
        return sigmoid((hidden @ self.out).astype(np.float64) + self.offset)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def padded(text: bytes) -> bytes:
    """Whole blocks, two at least; padding is the zero byte."""
    return text.ljust(max(2 * BLOCK, -(-len(text) // BLOCK) * BLOCK), b"\0")


def fit(rows: list[tuple[str, int]], epochs: int = 8, batch: int = 24, rate: float = 0.01, seed: int = 7) -> ByteCNN:
    """Adam on the log loss; the gradient of a max-pooled filter reaches only the chunk that won."""
    y_all = np.array([label for _, label in rows], np.float32)
    rng = np.random.default_rng(seed)
    model = ByteCNN(
        rng.normal(0, 0.5, (256, WIDTH)).astype(np.float32),
        rng.normal(0, 0.1, (BLOCK * WIDTH, 2 * FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32),
        rng.normal(0, 0.3, FILTERS).astype(np.float32),
        0.0,
        None if 0 < y_all.sum() < len(rows) else float(y_all.mean()) if len(rows) else 0.5,
    )
    if model.constant is not None:
        return model
    texts = [text.encode() for text, _ in rows]
    weights = {"embedding": model.embedding, "kernel": model.kernel, "bias": model.bias, "out": model.out, "offset": np.zeros(1, np.float32)}
    mean = {k: np.zeros_like(v) for k, v in weights.items()}
    square = {k: np.zeros_like(v) for k, v in weights.items()}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), batch):
            some = order[at : at + batch]
            grads = _gradients(weights, [texts[i] for i in some], y_all[some])
            step += 1
            pace = rate * (1 - epoch / epochs)
            for k, g in grads.items():
                mean[k] += 0.1 * (g - mean[k])
                square[k] += 0.01 * (g * g - square[k])
                weights[k] -= (pace * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return ByteCNN(weights["embedding"], weights["kernel"], weights["bias"], weights["out"], float(weights["offset"][0]))


def _gradients(w: dict[str, np.ndarray], texts: list[bytes], y: np.ndarray) -> dict[str, np.ndarray]:
    net = ByteCNN(w["embedding"], w["kernel"], w["bias"], w["out"], float(w["offset"][0]))
    top = np.empty((len(texts), FILTERS), np.float32)
    codes = np.empty((len(texts), FILTERS, 2 * BLOCK), np.uint8)  # the bytes of the winning chunks
    for i, text in enumerate(texts):
        data = padded(text)
        z = net.responses(data)
        won = z.argmax(axis=0)
        top[i] = z[won, np.arange(FILTERS)]
        codes[i] = np.frombuffer(data, np.uint8)[won[:, None] * BLOCK + np.arange(2 * BLOCK)]
    hidden = top + w["bias"]
    active = hidden > 0
    hidden = np.where(active, hidden, 0)
    error = (sigmoid(hidden @ w["out"] + w["offset"][0]) - y).astype(np.float32) / len(texts)
    back = error[:, None] * w["out"] * active  # (documents, FILTERS)
    inputs = w["embedding"][codes].reshape(len(texts), FILTERS, 2, BLOCK * WIDTH)
    kernel = np.einsum("df,dfhx->xhf", back, inputs).reshape(BLOCK * WIDTH, 2 * FILTERS)
    filters = w["kernel"].reshape(BLOCK * WIDTH, 2, FILTERS)
    spread = np.einsum("df,xhf->dfhx", back, filters).reshape(-1, WIDTH)
    embedding = np.zeros_like(w["embedding"])
    np.add.at(embedding, codes.ravel(), spread)
    return {"embedding": embedding, "kernel": kernel, "bias": back.sum(axis=0), "out": hidden.T @ error, "offset": error.sum(keepdims=True)}


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> ByteCNN:
    """Fit on at most `sample` labelled documents that are not held out; only their text and label are seen."""
    return fit([(text, int(label > 0)) for _, text, label in labelled_sample(docs, labels, "quality", sample)])


def score(docs: DataFrame, model: ByteCNN, threshold: float = THRESHOLD) -> DataFrame:
    """`docs` with quality_score (double) and quality_ok (score >= threshold) appended; clashing names are replaced."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in docs.columns if c not in ("quality_score", "quality_ok")]
    schema = docs.select(*keep).withColumns({"quality_score": F.lit(0.0), "quality_ok": F.lit(True)}).schema

    def run(batches):
        for batch, texts in id_text_batches(batches):
            found = sent.value.scores([t.encode("utf-8", "surrogatepass") for t in texts])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.float64()), pa.array(found >= threshold)],
                names=[*batch.schema.names, "quality_score", "quality_ok"],
            )

    return docs.select(*keep).mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every whole document."""
    scored = score(docs.select("doc_id", "text"), train(docs, labels, sample), threshold)
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("quality_score").alias("score"),
        F.col("quality_ok").cast("int").alias("predicted"),
    )
