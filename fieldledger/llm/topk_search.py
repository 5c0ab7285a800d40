"""Exact top-k search: queries scatter weighted postings into dense score arrays, a term at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fieldledger.llm.vectors import ABSENT, best, check_products, dealt, first_ranks, matrix, per_cell, plan_grid, whole_rows

# Scores that are accumulated at a time: they stay in the processor's cache.
ARRAY_CELLS = 1 << 18


def accumulate(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Scores of all pairs. Each term (dimension) in turn: the queries that hold it add their weight times the weights of
    its posting list, at the positions of that list."""
    scores = np.zeros((len(queries), len(rows)), dtype=np.int64)
    for term in range(rows.shape[1]):
        asked, posted = np.flatnonzero(queries[:, term]), np.flatnonzero(rows[:, term])
        if len(asked) and len(posted):
            weights = np.multiply.outer(queries[asked, term], rows[posted, term])
            if len(posted) == len(rows):
                scores[asked] += weights
            else:
                scores[np.ix_(asked, posted)] += weights
    return scores


class _Search:
    """The queries of one cell and the best rows that each has met."""

    def __init__(self, queries: pa.Table, width: int, k: int):
        self.k, self.width = k, width
        self.ids = queries["id"].to_numpy()
        self.tags = queries["tag"].to_numpy()
        self.vectors = matrix(queries["vec"].combine_chunks(), width)
        self.found = []

    def add(self, batch: pa.RecordBatch) -> None:
        ids, rows = batch.column("id").to_numpy(), matrix(batch.column("vec"), self.width)
        check_products(self.vectors, rows)
        step = max(1, ARRAY_CELLS // len(ids))
        for at in range(0, len(self.ids), step):
            scores = accumulate(self.vectors[at : at + step], rows)
            scores[self.ids[at : at + step, None] == ids] = ABSENT
            query, row = best(scores, ids, self.k)
            self.found.append((query + at, ids[row], scores[query, row]))

    def finish(self, schema: pa.Schema) -> pa.RecordBatch:
        query, ids, scores = (np.concatenate(x) for x in zip(*self.found, strict=True))
        order = np.lexsort((ids, -scores, query))
        query, ids, scores = query[order], ids[order], scores[order]
        kept = np.arange(len(query)) - np.searchsorted(query, query) < self.k
        query, ids, scores = query[kept], ids[kept], scores[kept]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (self.ids[query], self.tags[query], ids, scores)], schema=schema)


def top_k(
    rows: DataFrame, every: int = 50, k: int = 5, scale: int = 256, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """The ``k`` rows with the largest inner product with each query: ``query_id``, ``rank``, ``vec_id``, ``score``.

    Vectors become whole numbers, ``floor(scale * x)``, and scores are exact. Queries are the rows whose id is divisible by
    ``every``; candidates are all rows of another id. Ties go to the smaller id. Nothing is approximated or left out: every
    query meets every row, in blocks. A cell holds one block of queries, takes its rows batch by batch, accumulates
    them term by term, and keeps ``k`` rows of each query; a rank per query merges the cells, cut to ``k`` before its
    shuffle. Rows are dealt by id, so a value that many rows share is spread like any other.

    Rows with a null id, a null vector or a null or non-finite component take no part. A vector that is shorter than others
    counts as zero beyond its end, an empty one scores 0. Rows that repeat an id are candidates each; a query row that
    repeats exactly is answered once, and queries of one id with different vectors are answered each. An empty table, or
    one without queries, gives no rows. Other columns are not carried. Scores beyond a long stop the job.
    """
    whole = whole_rows(rows, scale, vec_id, vector)
    queries = whole.where(F.col("id") % every == 0).distinct().withColumn("tag", F.xxhash64("vec"))
    grid = plan_grid(queries, whole)
    schema = "query_id long, tag long, vec_id long, score long"
    found = per_cell(dealt(queries, whole, grid), ["cell"], lambda asked: _Search(asked, grid.width, k), schema)
    return first_ranks(found, ["query_id", "tag"], k).select("query_id", "rank", "vec_id", "score")
