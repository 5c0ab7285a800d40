"""Toxicity by maximum-scoring segments of token log-odds, with extreme-value statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fieldledger.llm.samples import labelled_sample, logistic_fit
from fieldledger.llm.store import arrow_schema, is_training
from fieldledger.llm.words import buffers, row_blocks, words_of

SEPARATORS = bytes(b for b in range(128) if not chr(b).isalnum())
SCAN_BYTES = 1 << 20
# Bytes of the beginnings that count as features of a word beside the word itself: stems of inflected words.
PREFIXES = (5, 6, 7)
# Minus the logarithm of the E-value of a text without a listed word; evidence is cut at the opposite.
FAINTEST = -8.0
ROWS = "doc_id long, held_out boolean, score double, predicted int, max_segment double, segments array<struct<first:int,last:int,score:double,e_value:double>>"


@dataclass
class ToxicityModel:
    """Codes of the words and stems that speak for toxicity, with log-odds, and the calibration.

    A word scores its own log-odds if it is listed, or else those of its longest listed stem; any other word scores
    ``gap``. ``decay`` and ``scale`` are the extreme-value parameters of clean text: a text of n words has
    ``scale * n * exp(-decay * s)`` chance segments of score ``s`` or more. ``coefficients`` are those of the logistic
    calibration of the two aggregated features.
    """

    tokens: np.ndarray
    odds: np.ndarray
    gap: float
    decay: float = 1.0
    scale: float = 1.0
    coefficients: np.ndarray = field(default_factory=lambda: np.array([0.0, 0.0, -4.0]))


def word_features(data: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Codes of the words, then of their stems of each length, and where each text's words begin."""
    words = words_of(data, offsets, separators=SEPARATORS, prefixes=PREFIXES)
    return [words.code, *words.prefix], words.first


def log_odds(
    codes: list[np.ndarray],
    first: np.ndarray,
    label: np.ndarray,
    prior: float = 200.0,
    least_docs: int = 3,
    least_z: float = 3.0,
) -> tuple[np.ndarray, np.ndarray]:
    """Features whose log-odds between toxic and other texts are surely positive, under a Dirichlet prior.

    A feature counts once per text. The prior gives each one ``prior`` pseudo-texts in proportion to its share of all
    texts, so that rare ones stay near zero; the variance of the log-odds gives the z-value.
    """
    text = np.tile(np.repeat(np.arange(len(label), dtype=np.int32), np.diff(first)), len(codes))
    code = np.concatenate(codes)
    text, code = text[code != 0], code[code != 0]
    order = np.lexsort((text, code))
    code, text = code[order], text[order]
    fresh = np.ones(len(code), bool)
    fresh[1:] = (code[1:] != code[:-1]) | (text[1:] != text[:-1])
    code, text = code[fresh], text[fresh]
    tokens, at = np.unique(code, return_inverse=True)
    toxic = np.bincount(at, weights=label[text], minlength=len(tokens))
    clean = np.bincount(at, weights=1 - label[text], minlength=len(tokens))
    n_toxic, n_clean = label.sum(), (1 - label).sum()
    pseudo = prior * (toxic + clean) / max(1, len(label)) + 0.01
    a, b = toxic + pseudo, clean + pseudo
    delta = np.log(a / (n_toxic + prior - a).clip(0.5)) - np.log(b / (n_clean + prior - b).clip(0.5))
    z = delta / np.sqrt(1 / a + 1 / b)
    good = (toxic >= least_docs) & (z >= least_z)
    return tokens[good], delta[good].clip(0, 8)


def listed(codes: list[np.ndarray], model: ToxicityModel) -> tuple[np.ndarray, np.ndarray]:
    """Positions of words with a listed feature, and the place of the most specific one in the model."""
    none = np.zeros(0, np.int64)
    if not len(model.tokens):
        return none, none
    # Few words are in the lexicon: sixteen bits of the code tell most others apart.
    maybe = np.zeros(1 << 16, dtype=bool)
    maybe[(model.tokens & np.uint64(0xFFFF)).astype(np.int64)] = True
    words, places = [], []
    for code in codes[:1] + codes[:0:-1]:  # the word itself, then its stems from the longest on
        hits = np.flatnonzero(maybe[(code & np.uint64(0xFFFF)).astype(np.int64)])
        at = np.minimum(np.searchsorted(model.tokens, code[hits]), len(model.tokens) - 1)
        same = model.tokens[at] == code[hits]
        words.append(hits[same])
        places.append(at[same])
    word, place = np.concatenate(words), np.concatenate(places)
    order = np.argsort(word, kind="stable")
    word, place = word[order], place[order]
    best = np.ones(len(word), bool)
    best[1:] = word[1:] != word[:-1]
    return word[best], place[best]


def extreme_values(share: np.ndarray, odds: np.ndarray, gap: float) -> tuple[float, float]:
    """Decay and scale of chance segments, where tokens occur with ``share`` in clean text.

    The decay solves ``sum(p * exp(decay * score)) = 1``; the scale is the usual bound from below by the drift.
    """
    rest = 1 - share.sum()

    def excess(x: float) -> float:
        return float((share * np.exp(x * odds)).sum() + rest * np.exp(x * gap) - 1)

    low, high = 1e-6, 1e-3
    while excess(high) < 0 and high < 50:
        low, high = high, high * 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return high, float(np.clip(-(share @ odds + rest * gap) * high, 1e-4, 1.0))


def segments(scores: np.ndarray, place: np.ndarray, gap: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments of one text, in linear time.

    ``scores`` are the positive scores at the positions ``place``; every position between scores ``gap``. Kept are
    segments with the sums before and after them; a new one takes in earlier ones while that raises its score.
    """
    # First and last position, sum before and after, and the nearest earlier segment with a smaller sum before it.
    open_: list[tuple[int, int, float, float, int]] = []
    total, at = 0.0, -1
    for p, s in zip(place.tolist(), scores.tolist(), strict=True):
        total += gap * (p - at - 1)
        first, before, after = p, total, total + s
        total, at = after, p
        while True:
            k = len(open_) - 1
            while k >= 0 and open_[k][2] >= before:
                k = open_[k][4]
            if k < 0 or open_[k][3] >= after:
                break
            first, before = open_[k][0], open_[k][2]
            del open_[k:]
        open_.append((first, p, before, after, k))
    return [(begin, end, high - low) for begin, end, low, high, _ in open_]


def features(found: list[tuple[int, int, float]], n: int, model: ToxicityModel, most_e: float = 0.1) -> tuple[tuple, list]:
    """Evidence of the significant segments and of the strongest one; the segments with their E-values."""
    kept, evidence, strongest = [], 0.0, FAINTEST
    for first, last, score in found:
        against = model.decay * score - float(np.log(model.scale * n))  # minus the logarithm of the E-value
        strongest = max(strongest, against)
        if against >= -np.log(most_e):
            kept.append((first, last, score, float(np.exp(-against))))
            evidence += against
    return (float(np.log1p(evidence)), float(min(strongest, -FAINTEST))), kept


def scan(codes: list[np.ndarray], first: np.ndarray, model: ToxicityModel) -> Iterator[tuple[int, int, list]]:
    """Texts with a listed word: text number, number of words, maximal segments."""
    hits, place = listed(codes, model)
    if not len(hits):
        return
    odds = model.odds[place]
    text = np.searchsorted(first, hits, side="right") - 1
    edges = np.flatnonzero(np.diff(text)) + 1
    for low, high in zip([0, *edges.tolist()], [*edges.tolist(), len(hits)], strict=True):
        t = int(text[low])
        yield t, int(first[t + 1] - first[t]), segments(odds[low:high], hits[low:high] - first[t], model.gap)


def fit(sample: list[tuple[str, int]], gap: float = -0.35) -> ToxicityModel:
    """Learn the log-odds, the extreme-value parameters and the calibration from texts and labels.

    The calibration uses scores of texts whose log-odds come from the other half of the sample, so that it sees the
    noise of new texts. Without both labels the model says the same of every text.
    """
    label = np.array([y for _, y in sample], dtype=float)
    if len(sample) < 4 or label.min() == label.max():
        none = np.zeros(0)
        sure = 4.0 if len(sample) and label.mean() > 0.5 else -4.0
        return ToxicityModel(np.zeros(0, np.uint64), none, gap, coefficients=np.array([0.0, 0.0, sure]))
    data, offsets = buffers(pa.array([t for t, _ in sample], pa.string()), fold=True)
    codes, first = word_features(data, offsets)

    def chosen(rows: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        at = np.concatenate([np.zeros(0, np.int64), *(np.arange(first[r], first[r + 1]) for r in rows)])
        return [c[at] for c in codes], np.concatenate([[0], np.cumsum(first[rows + 1] - first[rows])])

    def learned(rows: np.ndarray) -> ToxicityModel:
        model = ToxicityModel(*log_odds(*chosen(rows), label[rows]), gap)
        clean, _ = chosen(rows[label[rows] == 0])
        _, place = listed(clean, model)
        share = (np.bincount(place, minlength=len(model.tokens)) + 0.5) / (len(clean[0]) + 0.5 * len(model.tokens) + 1)
        model.decay, model.scale = extreme_values(share, model.odds, gap)
        return model

    every = np.arange(len(sample))
    half_of = np.zeros(len(sample), dtype=int)
    for value in (0, 1):  # each half has its share of both labels
        half_of[label == value] = np.arange(int((label == value).sum())) % 2
    x = np.tile([0.0, FAINTEST], (len(sample), 1))
    for half in (0, 1):
        model = learned(every[half_of != half])
        for t, n, found in scan(codes, first, model):
            if half_of[t] == half:
                x[t], _ = features(found, n, model)
    model = learned(every)
    model.coefficients = logistic_fit(x, label)
    return model


def train(
    docs: DataFrame, labels: DataFrame, rows: int = 4_000, parts: int = 4, held_out: int = 2
) -> ToxicityModel:
    """``fit`` on at most ``rows`` labelled texts that may be learned from; the rest of the labels is never read."""
    return fit(labelled_sample(docs, labels, "toxic", rows, parts, held_out))


def score_toxicity(
    docs: DataFrame,
    model: ToxicityModel,
    threshold: float = 0.3,
    parts: int = 4,
    held_out: int = 2,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted``, ``max_segment`` and the significant ``segments`` of each row.

    Words are runs of letters and digits in lower case. One scan over a text's log-odds finds all its maximal scoring
    segments; each has an E-value, the number of chance segments as good in a clean text as long. The evidence
    of the significant ones and of the best one is calibrated to a probability. Segments give first and last word.

    The model has a bounded size. Documents are not shuffled; memory holds a megabyte of text or one long text at a time.
    Null or empty text, and text without listed tokens, gets the score of no evidence and no segments. Null ids are not
    held out. Rows that repeat are scored alike. An empty table gives no rows. Other columns are not carried.
    """
    schema = arrow_schema(ROWS)

    def probability(x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ model.coefficients[:-1] + model.coefficients[-1], -30, 30)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(2), fold=True)
            x = np.tile([0.0, FAINTEST], (batch.num_rows, 1))
            best = np.zeros(batch.num_rows)
            passages: list[list] = [[] for _ in range(batch.num_rows)]
            for low, high in row_blocks(offsets, SCAN_BYTES):
                for t, n, found in scan(*word_features(data, offsets[low : high + 1]), model):
                    x[low + t], kept = features(found, n, model)
                    best[low + t] = max(s for _, _, s in found)
                    passages[low + t] = [
                        {"first": f, "last": l, "score": s, "e_value": e} for f, l, s, e in kept
                    ]
            score = probability(x)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(score),
                    pa.array((score >= threshold).astype(np.int32)),
                    pa.array(best),
                    pa.array(passages, schema.field(5).type),
                ],
                schema=schema,
            )

    _, out = is_training(docs[doc_id], parts, held_out)
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), out.alias("held_out"), docs[text].alias("text"))
    return rows.mapInArrow(run, ROWS)
