"""Points in numbered batches of bounded size, and their payloads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from fieldledger.operators.columns import check_choice, quoted
from fieldledger.operators.points import classify_points, point_struct
from fieldledger.schemas import IMPORT_STRATEGIES
from fieldledger.session import kept

GROUPS = ("period", "point_class")
# Rows that one task numbers, as far as they differ.
BUCKET_ROWS = 100_000
# A bucket that holds so many times its share of rows has copies of one row.
HOT = 4
_PREFIX_BITS = 32


def content_digest(columns: Sequence[str]) -> Column:
    """MD5 of a row as hex text; the same on every run and on every engine. A null differs from any text."""
    parts = [F.coalesce(quoted(c).cast("string"), F.lit("\x02")) for c in columns]
    return F.md5(F.concat_ws("\x01", *parts))


def _bucket(digest: Column, bits: int) -> Column:
    """The first ``bits`` bits of a digest: buckets that follow each other in the order of digests."""
    prefix = F.conv(F.substring(digest, 1, _PREFIX_BITS // 4), 16, 10).cast("bigint")
    return F.shiftright(prefix, _PREFIX_BITS - bits).cast("bigint") if bits else F.lit(0).cast("bigint")


def _bits(rows: int, bucket_rows: int) -> int:
    """Bits that split ``rows`` differing rows into buckets of about ``bucket_rows``."""
    return min(_PREFIX_BITS, max(0, -(-rows // bucket_rows) - 1).bit_length())


def number_batches(
    points: DataFrame, size: int = 500, groups: Sequence[str] = GROUPS, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """Add ``batch_no`` and ``batch_pos``: consecutive batches of ``size`` points in each group.

    Only the last batch of a group is shorter, however large the group is. A group's rows are in the order of their
    digest, and a bucket is a range of digests, so the numbering is the same for any number of buckets. Rows are counted
    first: the largest group tells how many buckets it takes for a task to number about ``bucket_rows`` rows, and a
    histogram of the buckets gives each the number of rows before it. Rows themselves are shuffled once, by bucket.
    The histogram is written first, so that the planner knows its size: a small one is broadcast, a large one is not.

    Many copies of one row share a digest and would meet in one bucket. The histogram shows it, and then equal rows are
    counted on the map side before they are ordered, and written out again batch by batch.
    """
    if size < 1 or bucket_rows < 1:
        raise ValueError("size and bucket_rows must be at least 1")
    group = [quoted(g) for g in groups]
    # One struct for the group, so that groups with null fields match.
    keyed = points.withColumn("_group", F.struct(*group)).withColumn("_digest", content_digest(points.columns))
    largest = points.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    bits = _bits(largest, bucket_rows)
    bucketed = keyed.withColumn("_bucket", _bucket(F.col("_digest"), bits))
    if not bits:
        return _placed(_numbered(bucketed, points.columns, None), points.columns, size)
    sizes = bucketed.groupBy("_group", "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    before = W.partitionBy("_group").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_size").over(before), F.lit(0))
    shifts = kept(sizes.select(F.col("_group").alias("_g"), F.col("_bucket").alias("_b"), "_size", shift.alias("_shift")), "batch-shifts")
    if shifts.agg(F.max("_size")).first()[0] <= HOT * bucket_rows:
        return _placed(_numbered(bucketed, points.columns, shifts), points.columns, size)
    names = [quoted(c) for c in points.columns]
    counted = bucketed.groupBy("_group", "_bucket", "_digest", *names).agg(F.count(F.lit(1)).alias("_copies"))
    return _placed_copies(_numbered(counted, points.columns, shifts), points.columns, size, group)


def _numbered(rows: DataFrame, names: Sequence[str], shifts: DataFrame | None) -> DataFrame:
    """Add ``_to``, the number of rows of the group up to each row (to its last copy, where copies are counted)."""
    inside = W.partitionBy("_group", "_bucket").orderBy("_digest", *[quoted(c) for c in names])
    if "_copies" in rows.columns:
        ended = rows.withColumn("_to", F.sum("_copies").over(inside.rowsBetween(W.unboundedPreceding, 0)))
    else:
        ended = rows.withColumn("_to", F.row_number().over(inside).cast("bigint"))
    if shifts is None:
        return ended
    # Rows are dealt by these keys already, so a shift table too large to be broadcast is shuffled alone.
    same = (ended["_group"] == shifts["_g"]) & (ended["_bucket"] == shifts["_b"])
    return ended.join(shifts, same).withColumn("_to", F.col("_to") + F.col("_shift"))


def _placed(numbered: DataFrame, names: Sequence[str], size: int) -> DataFrame:
    return numbered.select(
        *[quoted(c) for c in names],
        F.expr(f"(_to - 1) div {size}").alias("batch_no"),
        ((F.col("_to") - 1) % size).cast("int").alias("batch_pos"),
    )


def _placed_copies(numbered: DataFrame, names: Sequence[str], size: int, group: Sequence[Column]) -> DataFrame:
    """Copies of a row fill batches in many tasks: first one row per batch, dealt by batch, then one per position."""
    ranged = numbered.withColumn("_from", F.col("_to") - F.col("_copies"))
    batches = F.sequence(F.expr(f"_from div {size}"), F.expr(f"(_to - 1) div {size}"))
    parts = ranged.withColumn("batch_no", F.explode(batches)).repartition(*group, "batch_no")
    start = F.col("batch_no") * size
    low = F.greatest(F.col("_from") - start, F.lit(0))
    high = F.least(F.col("_to") - start, F.lit(size)) - 1
    positions = F.explode(F.sequence(low, high).cast("array<int>"))
    return parts.select(*[quoted(c) for c in names], "batch_no", positions.alias("batch_pos"))


def batch_id(groups: Sequence[str] = GROUPS) -> Column:
    """Identifier of a batch from its group and number."""
    parts = [F.coalesce(quoted(g).cast("string"), F.lit("")) for g in groups]
    return F.concat_ws("-", *parts, F.col("batch_no").cast("string"))


def batch_points(points: DataFrame, size: int = 500, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Points to send (valid ones, and those to delete) with ``batch_id`` and position."""
    sent = classify_points(points).where(F.col("point_class") != "ignored")
    return number_batches(sent, size, GROUPS, bucket_rows).withColumn("batch_id", batch_id())


def batch_payloads(
    batched: DataFrame, import_strategy: str = "CREATE_AND_UPDATE", dry_run: bool = True
) -> DataFrame:
    """One row per batch: its JSON payload and the import options that go with it.

    A batch holds at most the chosen number of points, so collecting one is bounded.
    """
    check_choice(import_strategy, IMPORT_STRATEGIES, "import strategy")
    point = F.struct("batch_pos", point_struct().alias("point"))
    grouped = batched.groupBy("period", "point_class", "batch_no").agg(
        F.count(F.lit(1)).alias("n_points"),
        F.sort_array(F.collect_list(point)).alias("_points"),
    )
    values = F.transform("_points", lambda p: p["point"]).alias("dataValues")
    return grouped.select(
        batch_id().alias("batch_id"),
        "period",
        "point_class",
        "batch_no",
        "n_points",
        F.to_json(F.struct(values)).alias("payload"),
        F.lit(import_strategy).alias("importStrategy"),
        F.lit(dry_run).alias("dryRun"),
        F.lit(True).alias("preheatCache"),
        F.lit(True).alias("skipAudit"),
    )
