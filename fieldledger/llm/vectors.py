"""Vectors as whole numbers, and blocks of stated queries against blocks of all rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from fieldledger.llm.store import arrow_schema, keep
from fieldledger.operators.columns import quoted

MOST = float(1 << 40)
QUERY, ROW = 0, 1


def is_usable(vector: Column) -> Column:
    """Whether a vector is given and all its components are finite numbers."""
    infinite = float("inf")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != infinite))
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def whole_vector(vector: Column, scale: int, offset: int = 0) -> Column:
    """``floor(scale * x) + offset`` of each component, as longs; a scaled component of 2**40 or more stops the job."""

    def whole(x: Column) -> Column:
        scaled = scale * x.cast("double")
        fits = F.abs(scaled) < MOST
        return F.when(fits, F.floor(scaled) + offset).otherwise(F.raise_error(F.lit("A component is too large")).cast("long"))

    return F.transform(vector, whole)


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """List values as rows of a matrix of longs; shorter lists end in zeros."""
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), dtype=np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def largest_product(a: np.ndarray, b: np.ndarray) -> int:
    """A bound of the inner products of the rows of two matrices and of the sums on the way to them."""
    if not a.size or not b.size:
        return 0
    return a.shape[1] * int(np.abs(a).max()) * int(np.abs(b).max())


def check_products(a: np.ndarray, b: np.ndarray) -> int:
    """The same bound; raises where a score might not fit in a long."""
    bound = largest_product(a, b)
    if bound >= 1 << 62:
        raise OverflowError("inner products of these vectors do not fit in a long")
    return bound


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles where every sum on the way is a whole number that doubles hold, else in longs."""
    if check_products(a, b) < 1 << 53:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    return a @ b.T


ABSENT = np.iinfo(np.int64).min


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``k`` best scores of each row, ties to the smaller id; ``ABSENT`` scores take no part.

    A partition finds the k-th score; only scores from there on, ties included, are sorted.
    """
    n_rows, n = scores.shape
    if not n_rows or not n:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    least = np.partition(scores, n - k, axis=1)[:, n - k] if n > k else np.full(n_rows, ABSENT)
    at, col = np.nonzero((scores >= least[:, None]) & (scores != ABSENT))
    order = np.lexsort((ids[col], -scores[at, col], at))
    at, col = at[order], col[order]
    first = np.searchsorted(at, np.arange(n_rows))
    kept = np.arange(len(at)) - first[at] < k
    return at[kept], col[kept]


@dataclass(frozen=True)
class Grid:
    """How many blocks queries and rows are dealt into, and the length of the longest vector."""

    query_blocks: int
    row_blocks: int
    width: int


def plan_grid(queries: DataFrame, rows: DataFrame, query_values: int = 1 << 20, row_values: int = 1 << 18) -> Grid:
    """Blocks of about ``query_values`` and ``row_values`` components, whatever the number of rows.

    Each query meets each block of rows, and each row each block of queries, so what is shuffled for one pair of a query
    and a row is one over the rows of a block: little beside their inner product.
    """
    n_queries = queries.count()
    n_rows, width = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("vec")), F.lit(0))).first()
    per_query, per_row = max(1, query_values // max(1, width)), max(1, row_values // max(1, width))
    return Grid(-(-n_queries // per_query) or 1, -(-n_rows // per_row) or 1, width)


def dealt(queries: DataFrame, rows: DataFrame, grid: Grid, within: Sequence[str] = ()) -> DataFrame:
    """Queries and rows (``id``, ``tag``, ``vec``, ...) with ``kind`` and ``cell``: one partition per pair of blocks.

    A row's block follows from its id, so a recomputed partition holds the same rows. In a partition, rows are ordered by
    ``within``, and the queries of a cell come before its rows.
    """

    def block(count: int) -> Column:
        return F.pmod(F.xxhash64("id"), F.lit(count)).cast("int")

    def others(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    asked = queries.select(
        "*", F.lit(QUERY).alias("kind"), block(grid.query_blocks).alias("_q"), others(grid.row_blocks).alias("_r")
    )
    given = rows.select(
        "*", F.lit(ROW).alias("kind"), others(grid.query_blocks).alias("_q"), block(grid.row_blocks).alias("_r")
    )
    both = asked.unionByName(given, allowMissingColumns=True)
    cells = grid.query_blocks * grid.row_blocks
    celled = both.withColumn("cell", F.col("_q") * grid.row_blocks + F.col("_r")).drop("_q", "_r")
    spread = celled.repartitionById(min(cells, 100_000), "cell")
    return spread.sortWithinPartitions("cell", *within, "kind")


Blocks = Iterator[tuple[pa.RecordBatch, Iterator[pa.RecordBatch]]]


def per_cell(
    frame: DataFrame, keys: Sequence[str], start: Callable[[pa.Table], object], schema: str
) -> DataFrame:
    """One pass over ``dealt`` rows: ``start`` takes the queries of a cell, ``add`` each batch of its rows, ``finish`` gives
    the result as a RecordBatch. Held are the queries of one cell and one batch of rows."""
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, queries, state = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            marks = [batch.column(name).to_numpy(zero_copy_only=False) for name in (*keys, "kind")]
            changed = np.zeros(batch.num_rows, dtype=bool)
            changed[0] = True
            for mark in marks:
                changed[1:] |= mark[1:] != mark[:-1]
            starts = np.flatnonzero(changed)
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), batch.num_rows], strict=True):
                cell, kind = tuple(mark[a].item() for mark in marks[:-1]), marks[-1][a]
                part = batch.slice(a, b - a)
                if cell != now:
                    if state is not None:
                        yield state.finish(arrow)
                    now, queries, state = cell, [], None
                if kind == QUERY:
                    queries.append(part)
                elif queries:
                    state = state or start(pa.Table.from_batches(queries))
                    state.add(part)
        if state is not None:
            yield state.finish(arrow)

    return frame.mapInArrow(run, schema)


def first_ranks(scored: DataFrame, by: Sequence[str], k: int, score: str = "score", at: str = "vec_id") -> DataFrame:
    """The ``k`` best rows of each group with their ``rank``; Spark cuts each task's rows to ``k`` before the shuffle too."""
    order = W.partitionBy(*by).orderBy(F.col(score).desc(), F.col(at))
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def whole_rows(
    df: DataFrame, scale: int, vec_id: str = "vec_id", vector: str = "embedding", label: str | None = None
) -> DataFrame:
    """``id`` and ``vec`` (and ``label``) of the rows that take part, written once: all have an id and a usable vector."""
    named = df.select(
        quoted(vec_id).cast("long").alias("id"),
        quoted(vector).alias("_vector"),
        *([quoted(label).cast("long").alias("label")] if label else []),
    )
    usable = named.where(F.col("id").isNotNull() & is_usable(F.col("_vector")))
    if label:
        usable = usable.where(F.col("label").isNotNull())
    names = ["id", *(["label"] if label else [])]
    return keep(usable.select(*names, whole_vector(F.col("_vector"), scale).alias("vec")), "whole-vectors")
