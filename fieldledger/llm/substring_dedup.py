"""Substring dedup: difference-cover anchors find every long run of words that occurs twice."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from fieldledger.llm.store import arrow_schema, keep, row_key
from fieldledger.llm.words import buffers, columns, lists_of, row_blocks, signed, windows, words_of

# Every difference modulo 21 is one of two elements of the cover, so that any two positions have an offset below 21
# at which both stand on the cover.
PERIOD, COVER = 21, (0, 1, 4, 14, 16)
SCAN_BYTES = 1 << 20
# Codes, and bytes of text, held by a task before equal codes are joined and handed on.
FLUSH_CODES, FLUSH_BYTES = 2_000_000, 16 << 20

ANCHORS = "id long, doc_id long, row long, n_words long, sha string, code array<long>, at array<int>, known array<int>"
WINDOWS = "id long, doc_id long, text string, code array<long>, more array<int>, at array<int>, known array<int>"
RESULT = "doc_id long, n_words long, n_removed long, kept_text string"


def cover_positions(n: int) -> np.ndarray:
    """Positions below ``n`` that stand on the cover."""
    full = (np.arange(-(-n // PERIOD))[:, None] * PERIOD + np.array(COVER)).ravel()
    return full[full < n]


def repeats(codes: np.ndarray, more: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For codes of one task: which occur more than once, and which stand for their value (its first place)."""
    if not len(codes):
        return np.zeros(0, bool), np.zeros(0, bool)
    order = np.argsort(codes, kind="stable") if more is None else np.lexsort((more, codes))
    own = codes[order]
    fresh = np.concatenate([[True], own[1:] != own[:-1]])
    if more is not None:
        also = more[order]
        fresh[1:] |= also[1:] != also[:-1]
    group = np.cumsum(fresh) - 1
    often = np.bincount(group)[group] > 1
    repeated, stands = np.empty(len(codes), bool), np.empty(len(codes), bool)
    repeated[order], stands[order] = often, fresh
    return repeated, stands


def ranges(first: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Row offsets after only the values under ``mask`` are kept."""
    return np.concatenate([[0], np.cumsum(mask)])[first]


class Numbers:
    """Ids of the rows a task writes, the same when the task is run again; neighbours differ in the last bits only."""

    def __init__(self) -> None:
        self.next = TaskContext.get().partitionId() << 33

    def take(self, count: int) -> np.ndarray:
        self.next += count
        return np.arange(self.next - count, self.next)


def find_anchors(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Anchors of each text. Those a task sees twice are known to be repeated, and one of them is handed on."""
    schema, size = arrow_schema(ANCHORS), window - PERIOD + 1
    held: list[tuple] = []
    count, ids = 0, Numbers()

    def flush() -> pa.RecordBatch:
        lengths = np.concatenate([x[4] for x in held])
        first = np.concatenate([[0], np.cumsum(lengths)])
        code, at = np.concatenate([x[5] for x in held]), np.concatenate([x[6] for x in held])
        repeated, stands = repeats(code)
        known = lists_of(at[repeated].astype(np.int32), ranges(first, repeated))
        # The sign of a position tells a code that is already known to be repeated.
        marked = np.where(repeated, -at - 1, at).astype(np.int32)
        sent = ranges(first, stands)
        return columns(
            {
                "id": ids.take(len(lengths)),
                "doc_id": pa.concat_arrays([x[0] for x in held]),
                "row": pa.concat_arrays([x[1] for x in held]),
                "n_words": np.concatenate([x[2] for x in held]),
                "sha": [s for x in held for s in x[3]],
                "code": lists_of(signed(code[stands]), sent),
                "at": lists_of(marked[stands], sent),
                "known": known,
            },
            schema,
        )

    for batch in batches:
        data, offsets = buffers(batch.column(2))
        for low, high in row_blocks(offsets, SCAN_BYTES):
            words = words_of(data, offsets[low : high + 1])
            codes = windows(words.code, size)
            shas, lengths, places = [], [], []
            n_words = np.diff(words.first)
            for k in range(high - low):
                text = data[offsets[low + k] : offsets[low + k + 1]].tobytes()
                shas.append(hashlib.sha256(b" ".join(text.split())).hexdigest())
                # A text shorter than a window has no run to find.
                own = cover_positions(n_words[k] - size + 1) if n_words[k] >= window else np.zeros(0, np.int64)
                lengths.append(len(own))
                places.append(own)
            at = np.concatenate(places)
            where = at + np.repeat(words.first[:-1], lengths)
            rows = slice(low, high)
            held.append((batch.column(0)[rows], batch.column(1)[rows], n_words, shas, np.array(lengths), codes[where], at))
            count += len(at)
            if count >= FLUSH_CODES:
                yield flush()
                held, count = [], 0
    if held:
        yield flush()


def find_windows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Codes of the windows around repeated anchors, of 96 bits; handed on like anchors."""
    schema = arrow_schema(WINDOWS)
    held: list[tuple] = []
    count, size, ids = 0, 0, Numbers()

    def flush() -> pa.RecordBatch:
        lengths = np.concatenate([x[2] for x in held])
        first = np.concatenate([[0], np.cumsum(lengths)])
        code, more, at = (np.concatenate([x[k] for x in held]) for k in (3, 4, 5))
        repeated, stands = repeats(code, more)
        marked = np.where(repeated, -at - 1, at).astype(np.int32)
        sent = ranges(first, stands)
        return columns(
            {
                "id": ids.take(len(lengths)),
                "doc_id": pa.concat_arrays([x[0] for x in held]),
                "text": pa.concat_arrays([x[1] for x in held]),
                "code": lists_of(signed(code[stands]), sent),
                "more": lists_of(more[stands].view(np.int32), sent),
                "at": lists_of(marked[stands], sent),
                "known": lists_of(at[repeated].astype(np.int32), ranges(first, repeated)),
            },
            schema,
        )

    for batch in batches:
        data, offsets = buffers(batch.column(1))
        for low, high in row_blocks(offsets, SCAN_BYTES):
            block = offsets[low : high + 1]
            words = words_of(data, block)
            codes = windows(words.code, window)
            also = (windows(words_of(data, block, seed=1).code, window, seed=1) >> np.uint64(32)).astype(np.uint32)
            lengths, places = [], []
            for k in range(high - low):
                n = int(words.first[k + 1] - words.first[k])
                anchors = batch.column(2)[low + k].values.to_numpy()
                edge = np.zeros(max(1, n - window + 2), dtype=np.int32)
                np.add.at(edge, np.clip(anchors - PERIOD + 1, 0, n - window + 1), 1)
                np.add.at(edge, np.clip(anchors + 1, 0, n - window + 1), -1)
                own = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
                lengths.append(len(own))
                places.append(own)
            at = np.concatenate(places)
            where = at + np.repeat(words.first[:-1], lengths)
            rows = slice(low, high)
            own = [batch.column(k)[rows] for k in range(2)]
            held.append((*own, np.array(lengths), codes[where], also[where], at))
            count += len(at)
            size += int(block[-1] - block[0])
            if count >= FLUSH_CODES or size >= FLUSH_BYTES:
                yield flush()
                held, count, size = [], 0, 0
    if held:
        yield flush()


def cut_words(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Texts without the words that the repeated windows cover."""
    schema = arrow_schema(RESULT)
    for batch in batches:
        totals, counts, kept = [], [], []
        for text, known, found in zip(*batch.columns[1:], strict=True):
            words = text.as_py().encode().split()
            edge = np.zeros(len(words) + 1, dtype=np.int32)
            for part in (known, found):
                if part.is_valid:
                    at = part.values.to_numpy()
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + window, -1)
            gone = np.cumsum(edge[:-1]) > 0
            totals.append(len(words))
            counts.append(int(gone.sum()))
            kept.append(b" ".join([words[k] for k in np.flatnonzero(~gone)]).decode())
        yield columns({"doc_id": batch.column(0), "n_words": totals, "n_removed": counts, "kept_text": kept}, schema)


def seen_elsewhere(sent: DataFrame, codes: list[str]) -> DataFrame:
    """Positions of codes that another task has handed on as well, as one list per row (``id``).

    A task hands each value on once, so a value has at most one row per task, however often it occurs.
    """
    rows = W.partitionBy(*codes)
    shared = sent.withColumn("n", F.count(F.lit(1)).over(rows)).where("n > 1 AND at >= 0")
    return shared.groupBy("id").agg(F.collect_set("at").alias("found"))


def dedup_substrings(docs: DataFrame, window: int = 35, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row's ``doc_id``, ``n_words``, ``n_removed``, ``kept_text`` (null: no part was looked at, so nothing is removed) and ``kept_sha256``.

    Words are separated by ASCII white space. Removed is every word in a run of ``window`` words whose sequence also begins
    elsewhere, in this text or another, judged on the input. ``kept_sha256`` is that of the kept words joined by spaces.

    1. At positions on a difference cover modulo 21, the code of the next ``window - 20`` words is an anchor. Two equal
       windows hold equal anchors at the same offset, so a quarter of the positions is enough.
    2. Anchors that occur twice send their position back to their text, where they are extended to all windows that hold
       them. Those windows, few where texts are not copies, are compared by 96 bits.
    3. Texts with repeated windows lose the words under them.

    Equal codes are joined inside each task before a shuffle, so a passage in a third of all texts, or a third of all texts
    being copies, gives a row per task and value. Texts are shuffled once, and those with a repeated anchor once more. All
    intermediate tables are in the shared folder.

    Null or empty text has no words and keeps nothing: ``n_words`` 0 and the SHA-256 of the empty text. A text of fewer
    words than ``window`` keeps all. Rows that repeat are copies of each other, of whatever id; null ids stay null. An empty
    table gives no rows. Other columns are not carried.
    """
    if window < PERIOD + 4:
        raise ValueError(f"window must be at least {PERIOD + 4} words")
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    keyed = rows.select("doc_id", row_key().alias("row"), "text")
    anchors = keep(keyed.mapInArrow(lambda x: find_anchors(x, window), ANCHORS), "anchors")

    sent = anchors.select("id", F.explode(F.arrays_zip("code", "at")).alias("x")).select("id", "x.code", "x.at")
    elsewhere = seen_elsewhere(sent, ["code"]).withColumnRenamed("id", "_id")
    known = anchors.select("id", "row", "known")
    marked_rows = (
        known.join(elsewhere, known["id"] == elsewhere["_id"], "left")
        .where("size(known) > 0 OR found IS NOT NULL")
        .select("row", F.concat("known", F.coalesce("found", F.array().cast("array<int>"))).alias("both"))
        .groupBy(F.col("row").alias("_row"))
        .agg(F.array_distinct(F.flatten(F.collect_list("both"))).alias("anchors"))
    )
    marks = keep(marked_rows, "marks")
    marked = keyed.join(marks, keyed["row"] == marks["_row"]).select("doc_id", "text", "anchors")
    candidates = keep(marked.mapInArrow(lambda x: find_windows(x, window), WINDOWS), "windows")

    sent = candidates.select("id", F.explode(F.arrays_zip("code", "more", "at")).alias("x"))
    elsewhere = seen_elsewhere(sent.select("id", "x.code", "x.more", "x.at"), ["code", "more"])
    found = elsewhere.withColumnRenamed("id", "_id")
    repeated = candidates.join(found, candidates["id"] == found["_id"], "left").select("doc_id", "text", "known", "found")
    cut = repeated.mapInArrow(lambda x: cut_words(x, window), RESULT)

    whole = anchors.join(marks.select("_row"), anchors["row"] == marks["_row"], "left_anti")
    none = F.lit(None).cast("string").alias("kept_text")
    nothing = F.lit(0).cast("long").alias("n_removed")
    return whole.select("doc_id", "n_words", nothing, none, F.col("sha").alias("kept_sha256")).unionByName(
        cut.select("doc_id", "n_words", "n_removed", "kept_text", F.sha2("kept_text", 256).alias("kept_sha256"))
    )
