"""Benchmark decontamination: every passage queries a BM25 index of test items, and matches are verified."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, functions as F

from fieldledger.llm.store import arrow_schema, give_back, keep, packed, unpacked
from fieldledger.llm.words import buffers, row_blocks, windows, words_of
from fieldledger.operators.columns import quoted

K1, B = 1.2, 0.75
# Words are runs of letters and digits; everything else separates them. In scripts without spaces, every sign is a word.
UNSPACED = "".join(rf"\p{{{x}}}" for x in ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar", "Tibetan"))
MARKS = r"[^\x00-\x7F\p{L}\p{N}\p{M}]+"
SEPARATORS = bytes(b for b in range(128) if not chr(b).isalnum())
# Items of fewer words say too little: a document that holds them need not have them from the benchmark.
MIN_WORDS = 4
# Items per index; a larger benchmark is indexed in several blocks, each of which queries all documents.
ITEMS_PER_INDEX = 5_000
# Bytes of the items of one index, about.
BYTES_PER_INDEX = 16 << 20
# An index has at most about so many blocks of items; a block has 16 items at least.
BLOCKS, LEAST_BLOCK = 64, 16
GRAM = 4
SCAN_BYTES = 1 << 20
ROWS = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"


def split_item(text: str) -> tuple[str, str]:
    """Question and answer of an item: the answer is the last sentence or line of three or more words.

    Shorter last sentences are joined to the ones before them. An item of one sentence is both.
    """
    parts = [p for p in regex.split(r"(?<=[.?!…؟۔।])\s+|(?<=[。！？｡])|\n+", text) if p.strip()]
    answer: list[str] = []
    while parts and len(regex.sub(f"[{UNSPACED}]", r" \g<0> ", " ".join(answer)).split()) < 3:
        answer.insert(0, parts.pop())
    return (" ".join(parts), " ".join(answer)) if parts else (text, text)


def plain(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of texts in lower case, in which words stand between ASCII separators."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.utf8_lower(pc.fill_null(texts, "").cast(pa.large_string()))
    other = pc.invert(pc.string_is_ascii(texts))
    if pc.any(other).as_py():
        some = pc.replace_substring_regex(texts.filter(other), MARKS, " ")
        some = pc.replace_substring_regex(some, f"([{UNSPACED}])", r" \1 ")
        texts = pc.replace_with_mask(texts, other, some)
    return buffers(texts)


def codes(text: str) -> np.ndarray:
    data, offsets = plain(pa.array([text]))
    return words_of(data, offsets, separators=SEPARATORS).code


def grams(code: np.ndarray) -> np.ndarray:
    """Codes of the runs of ``GRAM`` words; a shorter text is one run."""
    if not len(code):
        return np.zeros(0, np.uint64)
    return np.unique(windows(code, min(GRAM, len(code))))


@dataclass
class Index:
    """Postings of items by term, with impacts as shares of an item's full score, and block maxima.

    Terms are sorted by code. Postings of term ``t`` are ``first[t]`` up to ``first[t + 1]``, in item order.
    ``peak[t]`` is the largest impact per block of ``block`` items.
    """

    ids: np.ndarray
    length: int  # words of the longest item of all
    block: int
    terms: np.ndarray
    first: np.ndarray
    item: np.ndarray
    impact: np.ndarray
    peak: np.ndarray
    question: list[np.ndarray]
    answer: list[np.ndarray]


@dataclass(frozen=True)
class Statistics:
    """What BM25 weighs terms by, over all items: their number, lengths, and in how many of them each term stands."""

    items: int
    mean_length: float
    longest: int
    terms: np.ndarray
    found_in: np.ndarray

    def of(self, terms: np.ndarray) -> np.ndarray:
        return self.found_in[np.searchsorted(self.terms, terms)]


def build_index(
    items: list[tuple[int, str]], statistics: Statistics | None = None, min_words: int = MIN_WORDS
) -> Index | None:
    """BM25 index of the items that have ``min_words`` or more; None if there are none.

    ``statistics`` are those of all items where these are a part of them; without, those of ``items``.
    """
    rows = [(i, code, *map(codes, split_item(t))) for i, t in items if t and len(code := codes(t)) >= min_words]
    if not rows:
        return None
    # A side without words is the whole item.
    rows = [(i, code, *(side if len(side) else code for side in sides)) for i, code, *sides in rows]
    lengths = np.array([len(r[1]) for r in rows])
    owner = np.repeat(np.arange(len(rows)), lengths)
    terms, term = np.unique(np.concatenate([r[1] for r in rows]), return_inverse=True)
    pairs, counts = np.unique(term * len(rows) + owner, return_counts=True)
    term, item = pairs // len(rows), pairs % len(rows)
    if statistics is None:
        statistics = Statistics(len(rows), float(lengths.mean()), int(lengths.max()), terms, np.bincount(term, minlength=len(terms)))
    found_in = statistics.of(terms)
    idf = np.log1p((statistics.items - found_in + 0.5) / (found_in + 0.5))
    weight = idf[term] * counts * (K1 + 1) / (counts + K1 * (1 - B + B * lengths[item] / statistics.mean_length))
    impact = (weight / np.bincount(item, weights=weight, minlength=len(rows))[item]).astype(np.float32)
    block = max(LEAST_BLOCK, -(-len(rows) // BLOCKS))
    peak = np.zeros((len(terms), -(-len(rows) // block)), dtype=np.float32)
    np.maximum.at(peak, (term, item // block), impact)
    return Index(
        np.array([r[0] for r in rows], dtype=np.int64),
        statistics.longest,
        block,
        terms,
        np.searchsorted(term, np.arange(len(terms) + 1)),
        item,
        impact,
        peak,
        [grams(r[2]) for r in rows],
        [grams(r[3]) for r in rows],
    )


def search(index: Index, code: np.ndarray, first: np.ndarray, threshold: float) -> tuple[np.ndarray, ...]:
    """Passages with items above ``threshold``: begin and end in ``code``, text, item and score of each pair.

    A passage is twice as long as the longest item and begins every such length, so that a whole item always lies
    inside one. Scores only fall when words are left out of the sums, never by pruning: a passage goes on only if the
    sum of its terms' block maxima reaches the threshold for some block, and only postings of such blocks are scored.
    """
    at = np.searchsorted(index.terms, code)
    at[at == len(index.terms)] = 0
    known = index.terms[at] == code
    counts = np.diff(first)
    n_passages = np.maximum(-(-counts // index.length) - 1, counts > 0)
    text = np.repeat(np.arange(len(counts)), n_passages)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(n_passages) - n_passages, n_passages)
    begin = first[:-1][text] + nth * index.length
    end = np.minimum(begin + 2 * index.length, first[1:][text])
    none = tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0),)
    if not len(begin):
        return none
    # Known words before each word lead from word positions to positions among the known words.
    before = np.concatenate([[0], np.cumsum(known)])
    term = at[known]
    low, high = before[begin], before[end]

    # First bound: for every passage the largest impact of each term, whatever the item.
    best = np.concatenate([[0.0], np.cumsum(index.peak.max(axis=1)[term], dtype=np.float64)])
    live = np.flatnonzero(best[high] - best[low] >= threshold - 1e-6)
    found = []
    for part in np.array_split(live, max(1, len(live) // 512)):
        if not len(part):
            continue
        sizes = high[part] - low[part]
        passage = np.repeat(np.arange(len(part)), sizes)
        where = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(low[part], sizes)
        distinct = np.unique(passage * len(index.terms) + term[where])
        passage, own = distinct // len(index.terms), distinct % len(index.terms)
        # Second bound: the sum of block maxima, for each block of items.
        bound = np.zeros((len(part), index.peak.shape[1]), dtype=np.float32)
        edges = np.searchsorted(passage, np.arange(len(part)))
        filled = np.diff(np.append(edges, len(passage))) > 0
        if len(own):
            bound[filled] = np.add.reduceat(index.peak[own], edges[filled], axis=0)
        open_block = bound >= threshold - 1e-4
        keep = open_block[passage].any(axis=1)
        passage, own = passage[keep], own[keep]
        posts = index.first[own + 1] - index.first[own]
        slot = np.arange(posts.sum()) - np.repeat(np.cumsum(posts) - posts, posts) + np.repeat(index.first[own], posts)
        passage = np.repeat(passage, posts)
        inside = open_block[passage, index.item[slot] // index.block]
        pair, place = np.unique(passage[inside] * len(index.ids) + index.item[slot[inside]], return_inverse=True)
        score = np.bincount(place, weights=index.impact[slot[inside]], minlength=len(pair))
        good = score >= threshold - 1e-6
        which, item = part[pair[good] // len(index.ids)], pair[good] % len(index.ids)
        found.append((begin[which], end[which], text[which], item, score[good]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else none


def share(wanted: np.ndarray, have: np.ndarray) -> float:
    return float(np.isin(wanted, have).mean()) if len(wanted) else 0.0


MATCH = "array<struct<item_id:long,score:double,question_overlap:double,answer_overlap:double>>"


def n_indexes(benchmark: DataFrame, item_text: str = "text") -> int:
    size = F.octet_length(benchmark[item_text])
    items = benchmark.where(size.isNotNull()).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("size")).first()
    return max(1, -(-items["n"] * 5 // (ITEMS_PER_INDEX * 4)), -(-items["size"] * 5 // (BYTES_PER_INDEX * 4)))


def item_terms(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    """Number of words and distinct terms of each item of ``min_words`` or more, with its block."""
    schema = arrow_schema(TERMS)
    for batch in batches:
        own = [(block, codes(t)) for block, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
        rows = [{"block": b, "n": len(c), "code": np.unique(c).view(np.int64).tolist()} for b, c in own if len(c) >= min_words]
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


TERMS = "block long, n long, code array<long>"


def indexes(
    benchmark: DataFrame, blocks: int, item_id: str = "item_id", item_text: str = "text", min_words: int = MIN_WORDS
) -> Iterator[Index]:
    """Indexes of ``blocks`` parts of the items; each is built when it is asked for.

    All of them weigh terms by the statistics of the whole benchmark, which Spark counts, so that a match has the same
    score whatever the number of parts. The driver holds the items of one part and the counts of its terms.
    """
    block = F.pmod(F.xxhash64("i"), F.lit(blocks)).alias("block")
    items = benchmark.select(benchmark[item_id].cast("long").alias("i"), benchmark[item_text].alias("t")).where("t IS NOT NULL")
    items = items.select(block, "i", "t")
    if blocks > 1:
        terms = keep(items.select("block", "t").mapInArrow(lambda x: item_terms(x, min_words), TERMS), "item-terms")
        total = terms.agg(F.count(F.lit(1)).alias("items"), F.avg("n").alias("mean_length"), F.max("n").alias("longest")).first()
        placed = terms.select("block", F.explode("code").alias("code"))
        found_in = keep(placed.groupBy(F.col("code").alias("_code")).agg(F.count(F.lit(1)).alias("n")), "term-counts")
        counts_of = keep(placed.distinct().join(found_in, placed["code"] == found_in["_code"]).select("block", "code", "n"), "block-counts")
    for k in range(blocks):
        rows = [(r["i"], r["t"]) for r in items.where(F.col("block") == k).orderBy("i", "t").toLocalIterator()]
        statistics = None
        if blocks > 1:
            counts = counts_of.where(F.col("block") == k).select("code", "n").toPandas()
            # Terms are in the order of unsigned numbers.
            code = counts["code"].to_numpy(dtype=np.int64).view(np.uint64)
            order = np.argsort(code)
            statistics = Statistics(*total, code[order], counts["n"].to_numpy()[order])
        index = build_index(rows, statistics, min_words)
        if index is not None:
            yield index


def short_items(benchmark: DataFrame, min_words: int = MIN_WORDS, item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The items that are too short to be searched, with their number of words: a report beside the matches."""

    @F.arrow_udf("long")
    def n_words(texts: pa.Array) -> pa.Array:
        return pa.array([len(codes(t or "")) for t in texts.to_pylist()], pa.int64())

    counted = benchmark.select(benchmark[item_id].cast("long").alias("item_id"), n_words(benchmark[item_text]).alias("n_words"))
    return counted.where(F.col("n_words") < min_words)


def matches(
    text: Column, index: Index, threshold: float = 0.6, min_question: float = 0.6, min_answer: float = 0.5
) -> Column:
    """The verified matches of a text with the items of one index, each item once, in item order; never null."""
    kind = arrow_schema(f"x {MATCH}").field(0).type

    def best(data: np.ndarray, offsets: np.ndarray) -> dict[tuple[int, int], tuple[float, float, float]]:
        words = words_of(data, offsets, separators=SEPARATORS)
        out: dict[tuple[int, int], tuple[float, float, float]] = {}
        for begin, end, row, item, score in zip(*search(index, words.code, words.first, threshold), strict=True):
            inside = words.code[begin:end]
            have = np.concatenate([windows(inside, n) for n in range(1, GRAM + 1)])
            question, answer = share(index.question[item], have), share(index.answer[item], have)
            if question >= min_question and answer >= min_answer:
                key = (int(row), int(index.ids[item]))
                out[key] = max(out.get(key, (0.0, 0.0, 0.0)), (float(score), question, answer))
        return out

    @F.arrow_udf(MATCH)
    def find(texts: pa.Array) -> pa.Array:
        data, offsets = plain(texts)
        out: list[list[dict]] = [[] for _ in range(len(texts))]
        names = [f.name for f in kind.value_type]
        for low, high in row_blocks(offsets, SCAN_BYTES):
            for (row, item), values in sorted(best(data, offsets[low : high + 1]).items()):
                out[low + row].append(dict(zip(names, (item, *values), strict=True)))
        give_back()
        return pa.array(out, kind)

    return find(text)


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = 0.6,
    min_question: float = 0.6,
    min_answer: float = 0.5,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """One row per document and item found in it: ``doc_id``, ``item_id``, ``score`` and both overlaps.

    Test items are indexed for BM25, with impacts divided by the score an item gives itself, so that ``threshold`` is a
    share of a full match. Every passage of every document is a query; block maxima prune as in block-max WAND, and all
    items at or above the threshold come back. A match is verified by the runs of four words of the item's question
    and of its answer that stand in the passage; a side without words is the whole item. Words are compared in lower case,
    without punctuation; in scripts without spaces, single characters are words.

    An index holds at most about ``ITEMS_PER_INDEX`` items and ``BYTES_PER_INDEX`` of text, or one longer item; a larger
    benchmark is taken in blocks, one after the other, each of which queries all documents and writes what it finds. Terms
    are weighed over the whole benchmark, so the matches are the same for any number of blocks. Documents are not shuffled;
    memory holds a megabyte of text or one text.

    Null or empty texts match nothing, nor do items of fewer than ``min_words`` words, which ``short_items`` lists. An item id
    that repeats gives its best match. Rows that repeat an id or have a null id give a row for each copy. Empty tables give no rows. Other columns are
    not carried.
    """
    blocks = n_indexes(benchmark, item_text)
    result = None
    for index in indexes(benchmark, blocks, item_id, item_text, min_words):
        found = matches(docs[text], index, threshold, min_question, min_answer)
        part = docs.select(docs[doc_id].cast("long").alias("doc_id"), F.explode(found).alias("m")).select("doc_id", "m.*")
        if blocks > 1:  # so that the driver and the tasks hold one index at a time
            part = keep(part, "leaks")
        result = part if result is None else result.unionByName(part)
    return result if result is not None else docs.sparkSession.createDataFrame([], ROWS)


def drop_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = 0.6,
    min_question: float = 0.6,
    min_answer: float = 0.5,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """The rows of ``docs`` without a verified match, as they are and, for a benchmark of one index, without a shuffle.

    With more indexes, texts with a match are written for one after the other, as 128 bits of hash, and the rows that have
    such a text are left out at last.
    """
    blocks = n_indexes(benchmark, item_text)
    code = {"code": F.xxhash64(quoted(text)), "more": F.xxhash64(F.lit(1), quoted(text))}
    leaking = None
    for index in indexes(benchmark, blocks, item_id, item_text, min_words):
        leaks = F.size(matches(quoted(text), index, threshold, min_question, min_answer)) > 0
        if blocks == 1:
            return docs.where(~leaks)
        part = keep(docs.where(leaks).select(*[c.alias(f"leak_{name}") for name, c in code.items()]).distinct(), "leaks")
        leaking = part if leaking is None else leaking.unionByName(part)
    if leaking is None:
        return docs
    same = (F.col("code") == F.col("leak_code")) & (F.col("more") == F.col("leak_more"))
    stay = packed(docs, **code).join(leaking.distinct(), same, "left_anti")
    return stay.select(*unpacked(docs.columns, {}))
