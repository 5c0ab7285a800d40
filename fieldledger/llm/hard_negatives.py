"""Hard negatives: pairs in the order of (anchor, falling score, id), read once by an iterator with open windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fieldledger.llm.store import arrow_schema, keep
from fieldledger.llm.vectors import ABSENT, best, dealt, first_ranks, inner_products, matrix, per_cell, plan_grid, whole_rows

ARRAY_CELLS = 1 << 20


class _Positives:
    """The anchors of one cell and label, and the best other rows of that label."""

    def __init__(self, anchors: pa.Table, width: int, k: int):
        self.k, self.width = k, width
        self.ids, self.tags = anchors["id"].to_numpy(), anchors["tag"].to_numpy()
        self.vectors = matrix(anchors["vec"].combine_chunks(), width)
        self.found = []

    def add(self, batch: pa.RecordBatch) -> None:
        ids, rows = batch.column("id").to_numpy(), matrix(batch.column("vec"), self.width)
        step = max(1, ARRAY_CELLS // len(ids))
        for at in range(0, len(self.ids), step):
            scores = inner_products(self.vectors[at : at + step], rows)
            scores[self.ids[at : at + step, None] == ids] = ABSENT
            anchor, row = best(scores, ids, self.k)
            self.found.append((self.ids[anchor + at], self.tags[anchor + at], ids[row], scores[anchor, row]))

    def finish(self, schema: pa.Schema) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*self.found, strict=True)], schema=schema)


def window(score, low: int, high: int):
    """The least and greatest whole score of ``low * score <= 100 * s <= high * score``, without products beyond a long."""
    whole, rest = score // 100, score % 100
    return low * whole - (-low * rest) // 100, high * whole + (high * rest) // 100


class _Negatives:
    """The anchors of one cell with the scores of their positives, and the rows that may be negatives of them."""

    def __init__(self, anchors: pa.Table, width: int, per_positive: int, low: int, high: int):
        self.width, self.n = width, per_positive
        self.ids, self.tags = anchors["id"].to_numpy(), anchors["tag"].to_numpy()
        self.labels = anchors["label"].to_numpy()
        self.vectors = matrix(anchors["vec"].combine_chunks(), width)
        scores = anchors["positive_scores"].combine_chunks()
        given = scores.value_lengths().to_numpy(zero_copy_only=False)
        self.given = np.arange(given.max())[None, :] < given[:, None]
        self.low, self.high = window(matrix(scores, given.max()), low, high)
        self.found = []

    def add(self, batch: pa.RecordBatch) -> None:
        ids, rows = batch.column("id").to_numpy(), matrix(batch.column("vec"), self.width)
        labels = batch.column("label").to_numpy()
        step = max(1, ARRAY_CELLS // len(ids))
        for at in range(0, len(self.ids), step):
            part = slice(at, at + step)
            scores = inner_products(self.vectors[part], rows)
            scores[(self.ids[part, None] == ids) | (self.labels[part, None] == labels)] = ABSENT
            pairs = []
            for p in range(self.given.shape[1]):
                low, high = self.low[part, p, None], self.high[part, p, None]
                open_ = self.given[part, p, None] & (scores >= low) & (scores <= high)
                pairs.append(best(np.where(open_, scores, ABSENT), ids, self.n))
            anchor, row = np.unique(np.concatenate([np.stack(p) for p in pairs], axis=1), axis=1)
            self.found.append((self.ids[anchor + at], self.tags[anchor + at], ids[row], scores[anchor, row]))

    def finish(self, schema: pa.Schema) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*self.found, strict=True)], schema=schema)


def sorted_pairs(positives: DataFrame, negatives: DataFrame) -> DataFrame:
    """All pairs under the key (anchor, falling score, id), dealt by anchor and sorted in each partition by the whole key.

    This is ``repartitionAndSortWithinPartitions`` in its DataFrame form: rows are sorted by Spark, which spills, and
    never gathered by anchor. At equal scores positives come first: they open windows that may hold their own score.
    """
    both = positives.withColumn("is_positive", F.lit(True)).unionByName(negatives.withColumn("is_positive", F.lit(False)))
    keyed = both.select("anchor_id", "tag", (-F.col("score")).alias("falling"), (~F.col("is_positive")).alias("after"), "vec_id")
    return keyed.repartition("anchor_id", "tag").sortWithinPartitions("anchor_id", "tag", "falling", "after", "vec_id")


MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine_sorted(pairs: DataFrame, per_positive: int, low: int, high: int) -> DataFrame:
    """Negatives out of sorted pairs in one pass that holds the open windows of one anchor: at most one per positive."""
    schema = arrow_schema(MINED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, windows = None, []
        for batch in batches:
            out = []
            for anchor, tag, falling, after, vec_id in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if (anchor, tag) != now:
                    now, windows = (anchor, tag), []
                score = -falling
                if not after:
                    windows.append([vec_id, score, *window(score, low, high), 0])
                    continue
                for w in windows:
                    positive, positive_score, least, most, taken = w
                    if least <= score <= most and taken < per_positive:
                        w[-1] = taken + 1
                        out.append((anchor, positive, taken + 1, vec_id, positive_score, score))
                windows = [w for w in windows if w[2] <= score and w[-1] < per_positive]
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out], schema=schema)

    return pairs.mapInArrow(run, MINED)


def hard_negatives(
    rows: DataFrame,
    every: int = 50,
    positives: int = 5,
    per_positive: int = 3,
    low: int = 50,
    high: int = 95,
    scale: int = 256,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """Rows of another label that score nearly as high as a positive: one row per anchor, positive and negative.

    Vectors become whole numbers, ``floor(scale * x)``; a score is the exact inner product with the anchor, a row whose id is
    divisible by ``every``. Its positives are the first ``positives`` other rows of its label by falling score, then id. Of
    each positive come the first ``per_positive`` rows of another label whose score is between ``low`` and ``high`` per
    cent of the positive's score (both bounds included).

    Anchors and rows meet in blocks, twice: by label for the positives, and over all labels for the negatives. A cell sends
    on only pairs that can count: the best of a label, and the first of each window. These pairs go through a secondary sort
    by (anchor, falling score, id), and an iterator opens a window at each positive and emits the negatives that
    fall into it. Rows are dealt by id, so a label with a third of all rows is spread over all blocks. The driver sees counts.

    Rows with a null id, label or vector, or a null or non-finite component, take no part. A shorter vector counts as zero
    beyond its end. A positive with a negative score has no negatives, as its window is empty; one of score 0 has those of
    score 0. Rows that repeat an id count each, but never for an anchor of that id; an anchor row that repeats exactly is
    answered once. An empty table, or one without anchors, gives no rows. Other columns are not carried.
    """
    return mine(whole_rows(rows, scale, vec_id, vector, label), every, positives, per_positive, low, high)


def mine(whole: DataFrame, every: int, positives: int, per_positive: int, low: int, high: int) -> DataFrame:
    """``hard_negatives`` of rows that take part: ``id``, ``label``, ``vec``."""
    anchors = whole.where(F.col("id") % every == 0).distinct().withColumn("tag", F.xxhash64("label", "vec"))
    grid = plan_grid(anchors, whole)
    scored = "anchor_id long, tag long, vec_id long, score long"
    same_label = dealt(anchors, whole, grid, ["label"])
    near = per_cell(same_label, ["cell", "label"], lambda asked: _Positives(asked, grid.width, positives), scored)
    # Written first: read by the second meeting and by the sort.
    first = keep(first_ranks(near, ["anchor_id", "tag"], positives).drop("rank"), "positives")
    windows = first.groupBy(F.col("anchor_id").alias("_id"), F.col("tag").alias("_tag")).agg(
        F.collect_list("score").alias("positive_scores")
    )
    asking = anchors.join(windows, (F.col("id") == F.col("_id")) & (F.col("tag") == F.col("_tag"))).drop("_id", "_tag")
    far = per_cell(
        dealt(asking, whole, grid),
        ["cell"],
        lambda asked: _Negatives(asked, grid.width, per_positive, low, high),
        scored,
    )
    return mine_sorted(sorted_pairs(first, far), per_positive, low, high)
