"""Quality scores from a byte-level convolutional network in numpy.

Bytes are embedded, cut into overlapping chunks of ``CHUNK`` bytes every
``STEP`` bytes over the whole text (zero-padded at its end), and each learned
filter gives one number per chunk. The largest value of every filter over all
chunks, and the mean of its positive part, make the document's vector; a
logistic layer turns it into the probability that the label is 1.

Filters, embeddings and the logistic layer are learned together by Adam on a
bounded, class-balanced sample of the training rows, weighted back to the true
class shares. Long texts are scored in parts that overlap by a chunk less a
step, so every chunk is seen once and memory stays bounded.

Null and empty texts are one chunk of padding and get that chunk's score; with
no labelled rows the score is the constant 0.5. Rows are scored one by one;
extra columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from matchlake.llm.batches import slices
from matchlake.llm.labelled import labelled_sample

CHUNK, STEP, EMBED, FILTERS = 16, 8, 8, 48
EPOCHS, BATCH_DOCS, RATE, DECAY, SEED = 7, 32, 4e-3, 1e-5, 7
PER_CLASS = 2000
PARTS = CHUNK // STEP


@dataclass
class ConvModel:
    embed: np.ndarray    # (257, EMBED); row 256 is padding
    filters: np.ndarray  # (CHUNK * EMBED, FILTERS)
    shift: np.ndarray    # (FILTERS,)
    dense: np.ndarray    # (2 * FILTERS,)
    bias: float

    @staticmethod
    def start(rng: np.random.Generator) -> ConvModel:
        return ConvModel(rng.normal(0, 0.5, (257, EMBED)).astype(np.float32),
                         rng.normal(0, (CHUNK * EMBED) ** -0.5, (CHUNK * EMBED, FILTERS)).astype(np.float32),
                         np.zeros(FILTERS, np.float32), np.zeros(2 * FILTERS, np.float32), 0.0)


def grid(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols in rows of STEP, each text from a row of its own and padded to a
    whole number of chunks: (rows, first chunk of each text, chunks of each
    text). Chunk i of a text is its rows i .. i + PARTS - 1."""
    sizes = np.diff(offsets)
    chunks = np.maximum(1, -(-(sizes - CHUNK + STEP) // STEP))
    rows = chunks + PARTS - 1
    begin = np.cumsum(rows) - rows
    out = np.full(int(rows.sum()) * STEP, 256, np.int16)
    out[np.arange(len(raw)) + np.repeat(begin * STEP - offsets[:-1], sizes)] = raw
    return out.reshape(-1, STEP), begin, chunks


def responses(model: ConvModel, rows: np.ndarray) -> np.ndarray:
    """Filter responses of the chunk that starts at each row (the last PARTS - 1
    rows of a text start none; their values are not used)."""
    x = model.embed[rows].reshape(len(rows), STEP * EMBED)
    width = STEP * EMBED
    out = x @ model.filters[:width]
    for p in range(1, PARTS):
        out[:-p] += x[p:] @ model.filters[p * width:(p + 1) * width]
    out += model.shift
    return out


def pooled(z: np.ndarray, begin: np.ndarray, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(largest, sum of positive parts) of each text's chunks."""
    edges = np.stack([begin, begin + chunks], 1).ravel()
    guard = np.concatenate([z, np.zeros((1, z.shape[1]), z.dtype)])
    top = np.maximum.reduceat(guard, edges)[::2]
    np.maximum(guard, 0, out=guard)
    return top, np.add.reduceat(guard, edges)[::2]


def squash(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit(texts: pa.Array, target: np.ndarray, weight: np.ndarray, epochs: int = EPOCHS) -> ConvModel | None:
    """The network, or None without rows of both classes."""
    if not len(target) or not 0 < target.sum() < len(target):
        return None
    rng = np.random.default_rng(SEED)
    model = ConvModel.start(rng)
    share = (weight * target).sum() / weight.sum()
    model.bias = float(np.log(share / (1 - share)))
    scale = (weight * len(weight) / weight.sum()).astype(np.float32)
    raw, offsets = next(((r, o) for _, _, r, o in slices(texts, 1 << 60)))
    names = ("embed", "filters", "shift", "dense", "bias")
    first = {k: np.zeros_like(np.asarray(getattr(model, k), np.float32)) for k in names}
    second = {k: v.copy() for k, v in first.items()}
    step, total = 0, epochs * -(-len(target) // BATCH_DOCS)
    for _ in range(epochs):
        order = rng.permutation(len(target))
        for i in range(0, len(order), BATCH_DOCS):
            docs = order[i:i + BATCH_DOCS]
            size = offsets[docs + 1] - offsets[docs]
            offs = np.append(0, np.cumsum(size))
            part = raw[np.arange(offs[-1]) + np.repeat(offsets[docs] - offs[:-1], size)]
            step += 1
            grads = gradients(model, part, offs, target[docs], scale[docs])
            rate = RATE * (1 - step / (total + 1))
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                move = rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
                setattr(model, k, getattr(model, k) - (move if k != "bias" else float(move)))
    return model


def gradients(model: ConvModel, raw: np.ndarray, offsets: np.ndarray, target: np.ndarray,
              scale: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the weighted log loss of a batch. The largest value passes
    its gradient to one chunk per text and filter; the mean to all."""
    rows, begin, chunks = grid(raw, offsets)
    z = responses(model, rows)
    n, width = len(target), STEP * EMBED
    top, mass = pooled(z, begin, chunks)
    mean = mass / chunks[:, None]
    vector = np.concatenate([np.tanh(top), np.tanh(mean)], 1)
    slope = ((squash(vector @ model.dense + model.bias) - target) * scale / n).astype(np.float32)
    back = slope[:, None] * model.dense * (1 - vector * vector)
    to_top, to_mean = back[:, :FILTERS], back[:, FILTERS:] / chunks[:, None]
    text = np.repeat(np.arange(n), chunks + PARTS - 1)
    used = np.arange(len(rows)) - begin[text] < chunks[text]
    dz = np.where((z > 0) & used[:, None], to_mean[text], 0).astype(np.float32)
    hit = (z == top[text]) & used[:, None]
    ties = np.add.reduceat(hit, begin, dtype=np.float32)
    dz += np.where(hit, (to_top / ties)[text], 0)
    x = model.embed[rows].reshape(len(rows), width)
    d_filters, dx = np.empty_like(model.filters), np.zeros_like(x)
    for p in range(PARTS):
        own = slice(p * width, (p + 1) * width)
        z_part = dz[:len(rows) - p]
        d_filters[own] = x[p:].T @ z_part
        dx[p:] += z_part @ model.filters[own].T
    flat, symbols = dx.reshape(-1, EMBED), rows.ravel().astype(np.int64)
    d_embed = np.stack([np.bincount(symbols, flat[:, e], 257) for e in range(EMBED)], 1).astype(np.float32)
    return {"embed": d_embed + DECAY * model.embed, "filters": d_filters + DECAY * model.filters,
            "shift": dz.sum(0), "dense": vector.T @ slope + DECAY * model.dense,
            "bias": np.float32(slope.sum())}


def score_texts(texts: pa.Array, model: ConvModel | None, limit: int = 1 << 20) -> np.ndarray:
    out = np.full(len(texts), 0.5)
    if model is None:
        return out
    for a, b, raw, offsets in slices(texts, limit):
        if len(raw) <= 2 * limit:
            rows, begin, chunks = grid(raw, offsets)
            top, mass = pooled(responses(model, rows), begin, chunks)
        else:  # one long text: parts start at multiples of the step and share no chunk
            size = limit // STEP * STEP
            top, mass, chunks = np.full((1, FILTERS), -np.inf, np.float32), 0.0, 0
            for at in range(0, max(1, len(raw) - CHUNK + STEP), size):
                part = raw[at:at + size + CHUNK - STEP]
                rows, begin, n = grid(part, np.array([0, len(part)]))
                high, more = pooled(responses(model, rows), begin, n)
                top, mass, chunks = np.maximum(top, high), mass + more, chunks + n[0]
            chunks = np.array([chunks])
        vector = np.concatenate([np.tanh(top), np.tanh(mass / chunks[:, None])], 1)
        out[a:b] = squash((vector @ model.dense + model.bias).astype(np.float64))
    return out


def quality(text: Column | str, model: ConvModel | None) -> Column:
    """Probability that the text's quality label is 1."""
    @arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(score_texts(texts, model))

    return scored(F.col(text) if isinstance(text, str) else text)


def fitted(docs: DataFrame, labels: DataFrame, folds: int = 5) -> ConvModel | None:
    """The network of a bounded sample of the labelled training rows."""
    sample = labelled_sample(docs, labels, "quality", folds, PER_CLASS)
    return fit(sample["text"].combine_chunks(), sample["target"].to_numpy(), sample["weight"].to_numpy())
