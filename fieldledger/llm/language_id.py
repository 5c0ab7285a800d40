"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from fieldledger.llm.store import arrow_schema, is_training
from fieldledger.llm.words import buffers, row_blocks

SIZES = (1, 2, 3, 4)
BITS = 17
# No more bytes than this belong to the letters that an n-gram has behind its first one.
BEHIND = 4 * (max(SIZES) - 1)
SCAN_BYTES = 1 << 19
# Half a megabyte of weights each; while they are fitted, two more.
MOST_LANGUAGES = 1_000
ROWS = "doc_id long, held_out boolean, lang_pred string, score double"
has_letter = regex.compile(r"\p{L}").search
# ASCII as features see it: capital letters are small, and digits, marks and white space are one sign each.
FOLDED = np.arange(128, dtype=np.uint32)
FOLDED[65:91] += 32
FOLDED[48:58] = 48
FOLDED[[b for b in range(128) if not chr(b).isalnum()]] = 32


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of whole UTF-8 letters, folded, and where each begins."""
    if not len(data) or data.max() < 128:
        return FOLDED[data], np.arange(len(data))
    begin = np.flatnonzero((data & 0xC0) != 0x80)
    lead = data[begin].astype(np.uint32)
    more = (lead >= 0xC0).astype(np.int64) + (lead >= 0xE0) + (lead >= 0xF0)
    code = lead & np.array([0x7F, 0x1F, 0x0F, 0x07], np.uint32)[more]
    for k in (1, 2, 3):
        longer = np.flatnonzero(more >= k)
        code[longer] = (code[longer] << np.uint32(6)) | (data[begin[longer] + k] & 0x3F)
    ascii_ = more == 0
    code[ascii_] = FOLDED[code[ascii_]]
    return code, begin


def features(letters: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """For each n-gram size the feature at every position of ``letters``, which are code points."""
    out = []
    code = np.zeros(len(letters), dtype=np.uint64)
    wide = letters.astype(np.uint64)
    for size in range(1, max(SIZES) + 1):
        kept = max(0, len(letters) - size + 1)
        code = code[:kept] * np.uint64(0x9E3779B97F4A7C15) + wide[size - 1 :] + np.uint64(1)
        if size in SIZES:
            mixed = (code ^ (code >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            out.append((size, (mixed >> np.uint64(64 - BITS)).astype(np.int64)))
    return out


def vector(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features of a text and their relative frequencies."""
    letters, _ = code_points(np.frombuffer(text.encode(), dtype=np.uint8))
    flat = np.concatenate([f for _, f in features(letters)])
    at, counts = np.unique(flat, return_counts=True)
    return at, counts / max(1, len(flat))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass
class LanguageModel:
    """Languages, weights per feature (times its IDF) and language, intercepts, and the temperature."""

    languages: list[str]
    weights: np.ndarray
    intercepts: np.ndarray
    temperature: float


def ftrl(
    rows: list[tuple[np.ndarray, np.ndarray]],
    label: np.ndarray,
    classes: int,
    epochs: int = 3,
    alpha: float = 0.5,
    beta: float = 1.0,
    l1: float = 0.02,
    l2: float = 0.5,
) -> tuple[np.ndarray, np.ndarray]:
    """Follow the regularised leader, proximal form, with an elastic net: weights and intercepts.

    Each coordinate has its own rate, and is exactly zero while its gradients do not outweigh ``l1``.
    """
    z, n = np.zeros((1 << BITS, classes), np.float32), np.zeros((1 << BITS, classes), np.float32)
    bias_z, bias_n = np.zeros(classes), np.zeros(classes)

    def solved(z, n, l1, l2):
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))

    def moved(z, n, w, g):
        step = (np.sqrt(n + g * g) - np.sqrt(n)) / alpha
        return z + g - step * w, n + g * g

    random = np.random.default_rng(7)
    for _ in range(epochs):
        for k in random.permutation(len(rows)):
            at, value = rows[k]
            w, bias = solved(z[at], n[at], l1, l2), solved(bias_z, bias_n, 0.0, 0.0)
            error = softmax(value @ w + bias)
            error[label[k]] -= 1
            z[at], n[at] = moved(z[at], n[at], w, value[:, None] * error)
            bias_z, bias_n = moved(bias_z, bias_n, bias, error)
    for low in range(0, len(z), 1 << 10):
        z[low : low + (1 << 10)] = solved(z[low : low + (1 << 10)], n[low : low + (1 << 10)], l1, l2)
    return z, solved(bias_z, bias_n, 0.0, 0.0)


def fit(sample: list[tuple[str, str]]) -> LanguageModel:
    """Learn from texts and languages; every fifth text, but no language's first, sets the temperature only.

    IDF is the logarithm of sample texts per text with the feature. Values are scaled to unit length.
    """
    languages = sorted({lang for _, lang in sample})
    if len(languages) < 2:
        return LanguageModel(languages, np.zeros((1 << BITS, len(languages)), np.float32), np.zeros(len(languages)), 1.0)
    label = np.array([languages.index(lang) for _, lang in sample])
    raw = [vector(text) for text, _ in sample]
    held = np.arange(len(raw)) % 5 == 4
    held[np.unique(label, return_index=True)[1]] = False
    found_in = np.zeros(1 << BITS)
    for k in np.flatnonzero(~held):
        found_in[raw[k][0]] += 1
    idf = np.log((1 + (~held).sum()) / (1 + found_in)) + 0.1
    scale = 30.0
    rows = [(at, scale * share * idf[at]) for at, share in raw]
    train = np.flatnonzero(~held)
    weights, bias = ftrl([rows[k] for k in train], label[train], len(languages))
    rest = np.flatnonzero(held)
    logits = np.array([rows[k][1] @ weights[rows[k][0]] + bias for k in rest]).reshape(len(rest), len(languages))

    def loss(t: float) -> float:
        return float(-np.log(softmax(logits / t)[np.arange(len(rest)), label[rest]] + 1e-12).mean())

    grid = np.exp(np.linspace(-3, 3, 121))
    temperature = float(min(grid, key=loss)) if len(rest) else 1.0
    return LanguageModel(languages, np.multiply(weights, (scale * idf[:, None]).astype(np.float32), out=weights), bias, temperature)


def train(
    docs: DataFrame,
    per_language: int = 800,
    most_bytes: int = 16 << 20,
    parts: int = 3,
    held_out: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> LanguageModel:
    """``fit`` on about ``per_language`` texts of each language, drawn by a hash of the id.

    Every language with a row that may be learned from is learned; more than ``MOST_LANGUAGES`` of them raise. Counts cover
    all rows that may be learned from; of the texts, only the drawn ones leave their tasks, never more than twice the
    number asked for. Each language has its part of ``most_bytes``; a text that goes beyond it is cut there.
    """
    may, _ = is_training(docs[doc_id], parts, held_out)
    rows = docs.select(docs[doc_id].alias("i"), docs[text].alias("t"), docs[lang].alias("l")).where(may)
    rows = rows.where("t IS NOT NULL AND l IS NOT NULL")
    counts = rows.groupBy("l").agg(F.count(F.lit(1)).alias("n")).limit(MOST_LANGUAGES + 1)
    found = counts.collect()
    if not found:
        return fit([])
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    part = most_bytes // len(found)
    grain = 1 << 30
    shares = [(r["l"], int(grain * min(1.0, per_language / r["n"])), r["n"]) for r in found]
    wanted = docs.sparkSession.createDataFrame(shares, "_l string, share long, n long")
    # One row a language, so at most MOST_LANGUAGES.
    joined = rows.join(F.broadcast(wanted), rows["l"] == wanted["_l"])
    draw = F.pmod(F.xxhash64("i"), F.lit(grain))
    # So many of the first rows by hash that a language is never left without any.
    drawn = joined.where((draw < F.col("share")) | (F.col("n") * draw < 32 * grain))
    drawn = drawn.select("l", draw.alias("draw"), F.substring("t", 1, part).alias("t")).orderBy("l", "draw", "t")
    sample: list[tuple[str, str]] = []
    left: dict[str, tuple[int, int]] = {}
    for r in drawn.toLocalIterator():
        texts, size = left.get(r["l"], (2 * per_language, part))
        data = r["t"].encode()[:size]
        if texts and size:
            sample.append((data.decode(errors="ignore"), r["l"]))
            left[r["l"]] = (texts - 1, size - len(data))
    return fit(sorted(sample))


def identify(
    docs: DataFrame, model: LanguageModel, parts: int = 3, held_out: int = 1, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` (its calibrated probability) of each row.

    A text's features are the 1- to 4-grams of its letters (code points), hashed, by relative frequency and IDF. Their weights are summed
    over all positions of the whole text. The language is ``und`` with score 0 where the text is null or has no
    letter, or where no language was learned; ties go to the first language in order.

    The model's size is bounded by its languages, of which there are ``MOST_LANGUAGES`` at most. There is no shuffle; memory holds half a megabyte or one text. Null
    ids are not held out. Rows that repeat get the same answer. An empty table gives no rows. Other columns are not
    carried.
    """
    schema = arrow_schema(ROWS)
    width = len(model.languages)

    def sums(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Per text, the mean weights of its features."""
        total, count = np.zeros((len(offsets) - 1, width)), np.zeros(len(offsets) - 1)
        base = int(offsets[0])
        end = int(offsets[-1])

        def whole(at: int) -> int:
            """The beginning of the letter that holds byte ``at``."""
            while base < at < end and data[at] & 0xC0 == 0x80:
                at -= 1
            return at

        # A long text is summed in pieces; each piece sees the letters of the n-grams that begin in it.
        at = base
        while at < end:
            stop = whole(min(at + SCAN_BYTES, end))
            letters, begin = code_points(data[at : whole(min(stop + BEHIND, end))])
            here = np.searchsorted(begin, stop - at)
            edge = np.searchsorted(begin, np.clip(offsets - at, 0, None))
            for size, feature in features(letters):
                # n-grams begin in text k at edge[k] up to edge[k + 1] - size + 1
                feature = feature[:here]
                low = np.clip(edge[:-1], 0, len(feature))
                high = np.clip(edge[1:] - size + 1, 0, len(feature))
                own = np.flatnonzero(high > low)
                if not len(own):
                    continue
                weight = np.concatenate([model.weights[feature], np.zeros((1, width), np.float32)])
                edges = np.column_stack([low[own], high[own]]).ravel()
                total[own] += np.add.reduceat(weight, edges, axis=0)[::2]
                count[own] += (high - low)[own]
            at = stop
        return total / np.maximum(count, 1)[:, None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2)
            data, offsets = buffers(texts)
            names, scores = [], np.zeros(batch.num_rows)
            for low, high in row_blocks(offsets, SCAN_BYTES):
                letters = [t is not None and has_letter(t) is not None for t in texts[low:high].to_pylist()]
                if not width:
                    names += ["und"] * (high - low)
                    continue
                shares = softmax((sums(data, offsets[low : high + 1]) + model.intercepts) / model.temperature)
                best = shares.argmax(axis=1)
                names += [model.languages[b] if ok else "und" for b, ok in zip(best, letters, strict=True)]
                scores[low:high] = np.where(letters, shares[np.arange(len(best)), best], 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores)], schema=schema)

    _, out = is_training(docs[doc_id], parts, held_out)
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), out.alias("held_out"), docs[text].alias("text"))
    return rows.mapInArrow(run, ROWS)
