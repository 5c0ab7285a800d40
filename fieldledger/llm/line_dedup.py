"""Line dedup: lines that many documents hold stay in one of them only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fieldledger.llm.store import keep, packed, unpacked
from fieldledger.operators.columns import quoted

SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    """The lines of a text; a null or empty text has one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without white space at its ends and with A-Z in lower case.

    ``lower`` is right for ASCII and much faster than ``translate``, which leaves other letters as they are.
    """
    bare = F.trim(line, F.lit(SPACE))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def dedup_lines(
    docs: DataFrame, min_docs: int = 5, min_chars: int = 40, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """All rows and columns of ``docs``, with ``kept_text``, ``n_lines`` and ``n_dropped`` added.

    A line's key is the line trimmed and in ASCII lower case. Keys of at least ``min_chars`` code points that
    occur in at least ``min_docs`` documents lose all their lines, except in the document with the largest id
    that holds them. The other lines stay as they were, in their order, joined by a line feed.

    Exploded are only the keys that are long enough, as 128 bits of hash and a position, never the lines.
    Documents are counted per key in two steps, each reduced before its shuffle, so that a line in a third of
    all documents is spread by document first and then summed from one row per task. The positions to drop come
    back as one short list per document, and the text is cut in place: a document's lines are never regrouped.

    Null or empty text: one empty line, which stays (``kept_text`` is the empty text). Rows that repeat an id
    count as one document and are cut alike. A null id counts as no document and is never the largest one: its
    lines go where others reach ``min_docs``. An empty table gives no rows. Other columns pass through, whatever their
    names; columns named like one of those added are replaced.
    """
    cut = cut_lines(docs, min_docs, min_chars, doc_id, text)
    return cut.select(*unpacked(docs.columns, {name: F.col(name) for name in ("kept_text", "n_lines", "n_dropped")}))


def cut_lines(
    docs: DataFrame, min_docs: int = 5, min_chars: int = 40, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``dedup_lines`` with the columns of ``docs`` as one struct, ``row``."""
    rows = docs.select(quoted(doc_id).alias("_id"), quoted(text).alias("_text"))
    long_enough = F.char_length(F.col("_key")) >= min_chars
    lines = (
        rows.where(F.octet_length("_text") >= min_chars)
        .select("_id", F.xxhash64("_text").alias("_row"), F.posexplode(lines_of(F.col("_text"))).alias("_at", "_line"))
        .where(F.octet_length("_line") >= min_chars)
        .select("_id", "_row", "_at", line_key(F.col("_line")).alias("_key"))
        .where(long_enough)
        .select("_id", "_row", "_at", F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit(1), F.col("_key")).alias("_h2"))
    )
    holders = lines.where("_id IS NOT NULL").groupBy("_h1", "_h2", "_id").agg(F.lit(1).alias("_one"))
    common = (
        holders.groupBy("_h1", "_h2")
        .agg(F.count(F.lit(1)).alias("_docs"), F.max("_id").alias("_last"))
        .where(F.col("_docs") >= min_docs)
        .select(F.col("_h1").alias("_k1"), F.col("_h2").alias("_k2"), "_last")
    )
    # Written first: a join straight on an aggregate of the same key could not split a line that most documents hold.
    common = keep(common, "common-lines")
    gone = (
        lines.join(common, (lines["_h1"] == common["_k1"]) & (lines["_h2"] == common["_k2"]))
        .where(~F.col("_id").eqNullSafe(F.col("_last")))
        .groupBy(F.col("_id").alias("_gid"), F.col("_row").alias("_grow"))
        .agg(F.collect_set("_at").alias("_drop"))
    )
    whole_rows = packed(docs, id=quoted(doc_id), code=F.xxhash64(quoted(text)))
    same = F.col("id").eqNullSafe(F.col("_gid")) & (F.col("code") == F.col("_grow"))
    joined = whole_rows.join(gone, same, "left")
    whole = F.coalesce(F.col("row").getField(text), F.lit(""))
    lines_now = lines_of(whole)
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines_now) - 1), F.col("_drop"))
    cut = F.transform(F.array(F.struct(lines_now.alias("l"), stay.alias("s"))), _joined_lines)[0]
    return joined.select(
        "row",
        F.when(F.col("_drop").isNull(), whole).otherwise(cut).alias("kept_text"),
        (1 + F.octet_length(whole) - F.octet_length(F.replace(whole, F.lit("\n"), F.lit("")))).cast("long").alias("n_lines"),
        F.when(F.col("_drop").isNull(), 0).otherwise(F.size("_drop")).cast("long").alias("n_dropped"),
    )


def _joined_lines(x: Column) -> Column:
    """The lines ``x.l`` at the positions ``x.s``; both are bound once, not evaluated per line."""
    return F.array_join(F.transform(x["s"], lambda i: F.get(x["l"], i)), "\n")
