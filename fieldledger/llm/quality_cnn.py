"""Quality classifier: a byte-level convolutional network in numpy over overlapping chunks of a whole text."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import as_strided
from pyspark.sql import Column, DataFrame, functions as F

from fieldledger.llm.samples import labelled_sample
from fieldledger.llm.store import give_back, is_training
from fieldledger.llm.words import buffers, row_blocks

# Bytes a filter sees, step between its places, and bytes of half a chunk. Chunks overlap by half.
WIDTH, STEP, HALF = 8, 2, 128
PLACES = HALF // STEP
TAIL = WIDTH - STEP
DEPTH, FILTERS = 6, 32
SCAN_BYTES = 1 << 17


@dataclass
class QualityModel:
    """Byte embeddings, filters and their offsets, and the weights of both poolings."""

    embed: np.ndarray
    filters: np.ndarray
    offset: np.ndarray
    top: np.ndarray
    mean: np.ndarray
    bias: np.ndarray

    def arrays(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.offset, self.top, self.mean, self.bias]


def new_model(seed: int = 11) -> QualityModel:
    random = np.random.default_rng(seed)

    def drawn(*shape: int, scale: float) -> np.ndarray:
        return (random.standard_normal(shape) * scale).astype(np.float32)

    return QualityModel(
        drawn(256, DEPTH, scale=0.5),
        drawn(WIDTH * DEPTH, FILTERS, scale=(2.0 / (WIDTH * DEPTH)) ** 0.5),
        np.zeros(FILTERS, np.float32),
        drawn(FILTERS, scale=0.1),
        drawn(FILTERS, scale=0.1),
        np.zeros(1, np.float32),
    )


def half_chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The half chunks of texts as rows of bytes, each with the first bytes of the next one, and each text's first row.

    The last half chunk of a text is filled with zeros; an empty text has one of zeros only.
    """
    lengths = np.diff(offsets)
    rows = np.maximum(1, -(-lengths // HALF))
    first = np.concatenate([[0], np.cumsum(rows)])
    flat = np.zeros(int(first[-1]) * HALF, dtype=np.uint8)
    shift = np.repeat(first[:-1] * HALF - (offsets[:-1] - offsets[0]), lengths)
    flat[np.arange(len(shift)) + shift] = data[offsets[0] : offsets[-1]]
    out = np.zeros((int(first[-1]), HALF + TAIL), dtype=np.uint8)
    out[:, :HALF] = flat.reshape(-1, HALF)
    out[:-1, HALF:] = out[1:, :TAIL]
    out[first[1:] - 1, HALF:] = 0
    return out, first


def places(model: QualityModel, rows: np.ndarray) -> np.ndarray:
    """What the filters see at each place of each half chunk."""
    seen = np.ascontiguousarray(model.embed[rows])
    a, b, c = seen.strides
    return as_strided(seen, (len(rows), PLACES, WIDTH, DEPTH), (a, b * STEP, b, c)).reshape(
        len(rows), PLACES, WIDTH * DEPTH
    )


def responses(model: QualityModel, rows: np.ndarray) -> np.ndarray:
    """The filters' largest response in each half chunk."""
    out = np.empty((len(rows), FILTERS), np.float32)
    for low in range(0, len(rows), 512):
        seen = places(model, rows[low : low + 512])
        shape = seen.shape[:2]
        hit = (seen.reshape(-1, WIDTH * DEPTH) @ model.filters).reshape(*shape, FILTERS)
        out[low : low + 512] = hit.max(axis=1)
    return np.maximum(out + model.offset, 0)


def pooled(halves: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's largest response and the mean of its chunks' largest responses.

    A chunk is two neighbouring halves of one text, or its only half.
    """
    chunk = np.maximum(halves, np.concatenate([halves[1:], halves[-1:]]))
    last = first[1:] - 1
    single = np.diff(first) == 1
    chunk[last] = 0  # no chunk begins with the last half of a longer text
    chunk[last[single]] = halves[last[single]]
    counts = np.maximum(1, np.diff(first) - 1)
    return np.maximum.reduceat(halves, first[:-1], axis=0), np.add.reduceat(chunk, first[:-1], axis=0) / counts[:, None]


def long_responses(model: QualityModel, data: np.ndarray) -> np.ndarray:
    """``responses`` of one long text, piece by piece."""
    parts = []
    for low in range(0, len(data), SCAN_BYTES):
        piece = data[low : low + SCAN_BYTES + TAIL]
        rows, _ = half_chunks(piece[:SCAN_BYTES], np.array([0, min(len(piece), SCAN_BYTES)]))
        more = piece[SCAN_BYTES:]
        rows[-1, HALF : HALF + len(more)] = more
        parts.append(responses(model, rows))
    return np.concatenate(parts)


def logits(model: QualityModel, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The network's output for texts, before the logistic function."""
    if len(offsets) == 2 and offsets[1] - offsets[0] > SCAN_BYTES:
        halves = long_responses(model, data[offsets[0] : offsets[1]])
        first = np.array([0, len(halves)])
    else:
        rows, first = half_chunks(data, offsets)
        halves = responses(model, rows)
    top, mean = pooled(halves, first)
    return top @ model.top + mean @ model.mean + model.bias


def gradients(model: QualityModel, rows: np.ndarray, first: np.ndarray, label: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean log loss. Only the place with the largest response passes one on."""
    seen = places(model, rows)
    hit = (seen.reshape(-1, WIDTH * DEPTH) @ model.filters).reshape(len(rows), PLACES, FILTERS)
    best = hit.argmax(axis=1)
    raw = np.take_along_axis(hit, best[:, None, :], axis=1)[:, 0] + model.offset
    halves = np.maximum(raw, 0)
    top, mean = pooled(halves, first)
    p = 1 / (1 + np.exp(-np.clip(top @ model.top + mean @ model.mean + model.bias, -30, 30)))
    error = ((p - label) / len(label)).astype(np.float32)

    text = np.repeat(np.arange(len(label)), np.diff(first))
    counts = np.maximum(1, np.diff(first) - 1)
    # The largest half of the text; where several are as large, they share the gradient.
    leads = (halves == top[text]) & (raw > 0)
    ties = np.maximum(1, np.add.reduceat(leads, first[:-1], axis=0, dtype=np.int64))
    back = leads * (error[:, None] * model.top / ties)[text]
    share = (error / counts)[text][:, None] * model.mean
    after = np.concatenate([halves[1:], halves[-1:]])
    is_last = np.zeros(len(rows), bool)
    is_last[first[1:] - 1] = True
    single = (np.diff(first) == 1)[text]
    chunk = (~is_last)[:, None] & True
    back += share * (chunk & (halves >= after)) + share * single[:, None]
    back[1:] += (share * (chunk & (halves < after)))[:-1]
    back *= raw > 0

    at = np.take_along_axis(seen, best[:, :, None], axis=1)  # what was seen at the largest response
    d_filters = np.einsum("bf,bfk->kf", back, at)
    spread = (back[:, :, None] * model.filters.T).reshape(-1, DEPTH)
    byte = rows[np.arange(len(rows))[:, None, None], best[:, :, None] * STEP + np.arange(WIDTH)].ravel()
    d_embed = np.column_stack([np.bincount(byte, weights=spread[:, k], minlength=256) for k in range(DEPTH)])
    return [d_embed, d_filters, back.sum(axis=0), error @ top, error @ mean, np.array([error.sum()])]


def fit(
    sample: list[tuple[str, int]], epochs: int = 10, batch: int = 48, most_halves: int = 24, least_steps: int = 300
) -> QualityModel:
    """Train with Adam, a small sample for more epochs. In each epoch a text gives one stretch of at most ``most_halves`` half chunks.

    Without both labels, the model gives every text the share of label 1 in the sample, or 0.5 without a sample.
    """
    model = new_model()
    label = np.array([y for _, y in sample], dtype=np.float32)
    if not len(sample) or label.min() == label.max():
        model.top[:], model.mean[:] = 0, 0
        model.bias[:] = 0 if not len(sample) else (4.0 if label[0] else -4.0)
        return model
    model.bias[:] = np.log(label.mean() / (1 - label.mean()))
    raw = [np.frombuffer(text.encode(), dtype=np.uint8) for text, _ in sample]
    random = np.random.default_rng(5)
    first_moment = [np.zeros_like(a, dtype=np.float64) for a in model.arrays()]
    second_moment = [np.zeros_like(a, dtype=np.float64) for a in model.arrays()]
    batches = -(-len(raw) // batch)
    epochs = max(epochs, -(-least_steps // batches))
    step, steps = 0, epochs * batches
    for _ in range(epochs):
        order = random.permutation(len(raw))
        for low in range(0, len(raw), batch):
            chosen = order[low : low + batch]
            parts = []
            for k in chosen:
                spare = max(0, len(raw[k]) - most_halves * HALF)
                begin = int(random.integers(0, spare + 1)) if spare else 0
                parts.append(raw[k][begin : begin + most_halves * HALF])
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in parts])])
            rows, first = half_chunks(np.concatenate(parts), offsets)
            step += 1
            rate = 0.01 * min(1.0, step / 20) * (1 - 0.95 * step / steps)
            for value, grad, m, v in zip(
                model.arrays(), gradients(model, rows, first, label[chosen]), first_moment, second_moment, strict=True
            ):
                m += 0.1 * (grad - m)
                v += 0.01 * (grad * grad - v)
                value -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model


def train(docs: DataFrame, labels: DataFrame, rows: int = 3_000, parts: int = 3, held_out: int = 1) -> QualityModel:
    """``fit`` on at most ``rows`` labelled texts that may be learned from; the rest of the labels is never read."""
    return fit(labelled_sample(docs, labels, "quality", rows, parts, held_out))


def quality_score(text: Column, model: QualityModel) -> Column:
    """The probability that a text is good. Never null: a null text is scored like an empty one."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        data, offsets = buffers(texts)
        out = np.zeros(len(texts))
        for low, high in row_blocks(offsets, SCAN_BYTES):
            z = logits(model, data, offsets[low : high + 1]).astype(np.float64)
            out[low:high] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        give_back()
        return pa.array(out)

    return score(text)


def score_quality(
    docs: DataFrame,
    model: QualityModel,
    threshold: float = 0.5,
    parts: int = 3,
    held_out: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (1: good) and ``predicted`` of each row.

    Filters slide over the bytes of the whole text. Their largest responses per chunk of 256 bytes, chunks overlapping by
    half, are averaged over the text and beside the largest one of all give the probability.

    The model has a fixed size. There is no shuffle; memory holds a block of text or one long text. A null or empty text
    is one chunk of zeros and is scored like others. Null ids are not held out. Rows that repeat are scored alike.
    An empty table gives no rows. Other columns are not carried.
    """
    _, out = is_training(docs[doc_id], parts, held_out)
    scored = docs.select(
        docs[doc_id].cast("long").alias("doc_id"), out.alias("held_out"), quality_score(docs[text], model).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, model: QualityModel, threshold: float = 0.5, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not rejected, as they are."""
    return docs.where(quality_score(docs[text], model) >= threshold)
