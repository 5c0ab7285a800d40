"""Byte-level BPE by merge replay: every merge is applied, in rank order, to all distinct words at once."""

from __future__ import annotations

import base64
import hashlib
import heapq
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from fieldledger.llm.store import arrow_schema, give_back
from fieldledger.llm.words import buffers, row_blocks

# Distinct words replayed at once, as bytes, and words whose tokens are remembered between replays.
REPLAY_BYTES = 4 << 20
TEXT_BYTES = 4 << 20
REMEMBERED = 100_000
# A word with more positions of one merge takes them in turn where the merge may bring up one of lower rank.
IN_TURN = 64
DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


class Vocabulary:
    """Token bytes by rank, and which pairs of tokens merge into which token."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.size = max(ranks.values()) + 1
        self.ranks = ranks
        self.of_byte = np.full(256, -1, dtype=np.int64)
        for token, rank in ranks.items():
            if len(token) == 1:
                self.of_byte[token[0]] = rank
        if (self.of_byte < 0).any():
            raise ValueError("a byte-level vocabulary has a token for each of the 256 bytes")
        pairs: dict[int, int] = {}
        # A token is steady if no merge of it with a neighbour has a lower rank than its own.
        self.steady = np.ones(self.size, dtype=bool)
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = rank
                    self.steady[[x for x in (left, right) if x > rank]] = False
        self.pairs = np.array(sorted(pairs), dtype=np.int64)
        self.merged = np.array([pairs[p] for p in self.pairs.tolist()], dtype=np.int64)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair's merge; -1 where there is none."""
        if not len(self.pairs):
            return np.full(len(left), -1)
        pair = left * self.size + right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pair, self.merged[at], -1)


def read_ranks(path: str) -> dict[bytes, int]:
    """A vocabulary file: a line per token, its bytes in base 64 and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def read_vocabulary(path: str) -> Vocabulary:
    return Vocabulary(read_ranks(path))


@lru_cache(maxsize=2)
def read_tokens(path: str) -> list[bytes]:
    """Token bytes by rank, which is all that decoding needs."""
    ranks = read_ranks(path)
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return tokens


def merge_in_turn(
    at: np.ndarray, r: int, vocabulary: Vocabulary, token: np.ndarray, left: np.ndarray, right: np.ndarray, rank: np.ndarray
) -> np.ndarray:
    """Apply a merge at its positions in one word, from the left, and each time first what it brings up of lower rank.

    All pairs of lower rank are gone before, so what comes up stands around the merge just made and is taken from a small
    heap. Returns the positions whose pairs, of higher rank, have changed.
    """
    size, pairs, merged = vocabulary.size, memoryview(vocabulary.pairs), memoryview(vocabulary.merged)

    def rank_of(one: int, other: int) -> int:
        pair = one * size + other
        k = bisect_left(pairs, pair)
        return merged[k] if k < len(pairs) and pairs[k] == pair else -1

    tokens, lefts, rights, ranks = (memoryview(x) for x in (token, left, right, rank))
    changed = set()
    for begin in at.tolist():
        heap = [(r, begin)]
        while heap:
            now, here = heapq.heappop(heap)
            if ranks[here] != now:
                continue
            gone = rights[here]
            after, before = rights[gone], lefts[here]
            tokens[here], tokens[gone] = now, -1
            rights[here], ranks[gone] = after, -1
            if after >= 0:
                lefts[after] = here
            ranks[here] = rank_of(now, tokens[after]) if after >= 0 else -1
            if before >= 0:
                ranks[before] = rank_of(tokens[before], now)
            for place in (before, here):
                if place >= 0 and ranks[place] >= 0:
                    if ranks[place] <= r:
                        heapq.heappush(heap, (ranks[place], place))
                    else:
                        changed.add(place)
    return np.array(sorted(changed), dtype=np.int64)


def replay(words: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all words, one after the other, and where each word's begin (one entry more than words).

    An inverted index leads from a merge to the positions where its pair stands. Merges are taken in rank order;
    one is applied at all its positions, and only the two pairs around each of them are looked up anew and put in the
    index. A merge may bring up a pair of lower rank; it is then taken next. Where that can happen, only the first
    position of a word is merged at a time, which is what merging word by word does; a word with very many positions of
    such a merge takes them one after the other instead (``merge_in_turn``), so that a turn never goes over all of them.
    """
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    first = np.concatenate([[0], np.cumsum(lengths)])
    count = int(first[-1])
    if not count:
        return np.zeros(0, np.int64), first
    token = vocabulary.of_byte[np.frombuffer(b"".join(words), dtype=np.uint8)]
    word = np.repeat(np.arange(len(words)), lengths)
    right = np.arange(1, count + 1)
    left = np.arange(-1, count - 1)
    starts = first[:-1][lengths > 0]
    left[starts] = -1
    ends = first[1:][lengths > 0] - 1
    right[ends] = -1
    rank = np.full(count, -1, dtype=np.int64)  # of the pair that begins at a position
    inner = np.flatnonzero(right >= 0)
    rank[inner] = vocabulary.rank_of(token[inner], token[inner + 1])

    index: dict[int, list[np.ndarray]] = {}
    queue: list[int] = []

    def post(at: np.ndarray, ranks: np.ndarray) -> None:
        at, ranks = at[ranks >= 0], ranks[ranks >= 0]
        if not len(at):
            return
        order = np.argsort(ranks, kind="stable")
        at, ranks = at[order], ranks[order]
        edges = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        bounds = [0, *edges.tolist(), len(at)]
        for low, high in zip(bounds, bounds[1:]):
            r = int(ranks[low])
            if r in index:
                index[r].append(at[low:high])
            else:
                index[r] = [at[low:high]]
                heapq.heappush(queue, r)

    post(inner, rank[inner])
    while queue:
        r = heapq.heappop(queue)
        posted = index.pop(r)
        at = posted[0] if len(posted) == 1 else np.concatenate(posted)
        at = at[rank[at] == r]
        if not len(at):
            continue
        if len(posted) > 1:
            at = np.unique(at)
        elif len(at) > 1 and (at[1:] < at[:-1]).any():
            at = np.sort(at)
        later = None
        if vocabulary.steady[r]:
            if len(at) > 1:  # pairs that share a token: every other one, from the left
                touching = right[at[:-1]] == at[1:]
                if touching.any():
                    run = np.arange(len(at))
                    head = np.concatenate([[True], ~touching])
                    odd = (run - np.maximum.accumulate(np.where(head, run, 0))) % 2 == 1
                    at = at[~odd]
        else:
            leads = np.concatenate([[True], word[at[1:]] != word[at[:-1]]])
            edges = np.append(np.flatnonzero(leads), len(at))
            many = np.flatnonzero(np.diff(edges) > IN_TURN)
            if len(many):
                parts = [at[edges[k] : edges[k + 1]] for k in many]
                for part in parts:
                    touched = merge_in_turn(part, r, vocabulary, token, left, right, rank)
                    post(touched, rank[touched])
                at = np.setdiff1d(at, np.concatenate(parts), assume_unique=True)
                if not len(at):
                    continue
                leads = np.concatenate([[True], word[at[1:]] != word[at[:-1]]])
            at, later = at[leads], at[~leads]
        gone = right[at]
        after = right[gone]
        token[at] = r
        right[at] = after
        rank[gone] = -1
        token[gone] = -1
        has_after = after >= 0
        left[after[has_after]] = at[has_after]
        rank[at] = -1
        joined = at[has_after]
        rank[joined] = vocabulary.rank_of(token[joined], token[after[has_after]])
        before = left[at]
        has_before = before >= 0
        # Of two merges side by side, the right one's left neighbour is the left one, looked up twice alike.
        behind = before[has_before]
        rank[behind] = vocabulary.rank_of(token[behind], token[at[has_before]])
        if later is not None and len(later):
            later = later[rank[later] == r]
            post(later, rank[later])
        post(joined, rank[joined])
        post(behind, rank[behind])
    alive = token >= 0
    sizes = np.concatenate([[0], np.cumsum(alive)])
    return token[alive], sizes[first]


class Encoder:
    """Tokens of texts: words are cut by ``pattern``, and each distinct word is replayed once."""

    def __init__(self, vocabulary: Vocabulary, pattern: str) -> None:
        self.vocabulary = vocabulary
        self.cut = regex.compile(pattern).findall
        self.forget()

    def forget(self) -> None:
        """Words are numbered; the tokens of word ``k`` are ``tokens[first[k]]`` up to ``tokens[first[k + 1]]``."""
        self.known: dict[str, int] = {}
        self.tokens, self.first = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def learn(self, words: Iterable[str]) -> None:
        """Remember the tokens of ``words``; a word that is itself a token needs no merges."""
        ranks, whole, new = self.vocabulary.ranks, [], []
        for w in words:
            if w not in self.known:
                token = ranks.get(w.encode())
                if token is None:
                    new.append(w)
                else:
                    self.known[w] = len(self.first) - 1 + len(whole)
                    whole.append(token)
        self._add(np.array(whole, np.int32), np.arange(1, len(whole) + 1))
        low = 0
        while low < len(new):
            high, size = low, 0
            while high < len(new) and size < REPLAY_BYTES:
                size += len(new[high])
                high += 1
            tokens, first = replay([w.encode() for w in new[low:high]], self.vocabulary)
            self.known.update(zip(new[low:high], range(len(self.first) - 1, len(self.first) - 1 + high - low)))
            self._add(tokens.astype(np.int32), first[1:])
            low = high

    def _add(self, tokens: np.ndarray, ends: np.ndarray) -> None:
        self.first = np.concatenate([self.first, len(self.tokens) + ends])
        self.tokens = np.concatenate([self.tokens, tokens])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of the texts, one after the other, and where each text's begin.

        Words are kept for the next call while there are few enough.
        """
        if len(self.known) > REMEMBERED:
            self.forget()
        cuts = [self.cut(t) for t in texts]
        self.learn({w for words in cuts for w in words})
        counts = np.array([len(words) for words in cuts], dtype=np.int64)
        word = np.fromiter((self.known[w] for words in cuts for w in words), np.int64, int(counts.sum()))
        sizes = self.first[word + 1] - self.first[word]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(ends[-1]) + np.repeat(self.first[word] - ends[:-1], sizes)
        return self.tokens[at], ends[np.concatenate([[0], np.cumsum(counts)])]


def encode_documents(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row's ``doc_id`` and ``token_ids`` (an array of integers), in the order of the rows.

    Every match of ``pattern`` is encoded by itself by the ranks in the file at ``path`` and without special tokens, and
    the distinct matches of some megabytes of text are replayed together. There is no shuffle; memory is bounded by
    those megabytes or by the longest text. Executors open ``path`` themselves: it belongs to an installed package.

    Null or empty text: an empty array. Rows that repeat give rows that repeat; a null id stays null. An empty table
    gives no rows. Other columns are not carried.
    """
    schema = arrow_schema("doc_id long, token_ids array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, flat, first in _encoded(batches, path, pattern):
            yield pa.RecordBatch.from_arrays([ids, _lists(flat, first)], schema=schema)

    return _texts(docs, doc_id, text).mapInArrow(run, "doc_id long, token_ids array<int>")


def encode_and_digest(
    docs: DataFrame, path: str, pattern: str, with_ids: bool = True, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of ``encode_documents`` with the columns of ``digest_tokens``; without ``with_ids``, no ``token_ids``.

    Both run in one task, so token ids are not sent to a second Python worker and back. Null or empty text has no
    tokens, and its digests are those of the empty text; other cases are those of ``encode_documents``.
    """
    columns = f"doc_id long, token_ids array<int>, {DIGESTS}" if with_ids else f"doc_id long, {DIGESTS}"
    schema = arrow_schema(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = read_tokens(path)
        for ids, flat, first in _encoded(batches, path, pattern):
            lists = [_lists(flat, first)] if with_ids else []
            own = (flat[a:b].tolist() for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True))
            yield pa.RecordBatch.from_arrays([ids, *lists, *_digests(own, tokens)], schema=schema)

    return _texts(docs, doc_id, text).mapInArrow(run, columns)


def digest_tokens(tokens: DataFrame, path: str) -> DataFrame:
    """The rows of ``encode_documents`` with ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``; ids are decoded again."""
    names = [f.name for f in arrow_schema(DIGESTS)]

    @F.arrow_udf(f"struct<{DIGESTS}>")
    def digest(lists: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays(
            _digests((ids.values.to_numpy().tolist() for ids in lists), read_tokens(path)), names=names
        )

    return tokens.withColumn("_d", digest("token_ids")).select(*tokens.columns, "_d.*")


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))


def _encoded(
    batches: Iterator[pa.RecordBatch], path: str, pattern: str
) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Ids of some rows, the tokens of their texts one after the other, and where each text's begin."""
    encoder = Encoder(read_vocabulary(path), pattern)
    for batch in batches:
        texts = batch.column(1)
        for low, high in row_blocks(buffers(texts)[1], TEXT_BYTES):
            flat, first = encoder.encode([t or "" for t in texts[low:high].to_pylist()])
            yield batch.column(0)[low:high], flat, first
    encoder.forget()
    give_back()


def _lists(flat: np.ndarray, first: np.ndarray) -> pa.Array:
    lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(flat, pa.int32()))
    return lists.cast(arrow_schema("x array<int>").field(0).type)


def _digests(rows: Iterable[list[int]], tokens: list[bytes]) -> list[pa.Array]:
    """Columns of ``DIGESTS``, each row being a list of token ids."""
    names = _decimal(len(tokens))
    counts, ids_sha, text_sha = [], [], []
    for own in rows:
        counts.append(len(own))
        ids_sha.append(hashlib.sha256(",".join(map(names.__getitem__, own)).encode()).hexdigest())
        text_sha.append(hashlib.sha256(b"".join(map(tokens.__getitem__, own))).hexdigest())
    return [pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]


@lru_cache(maxsize=2)
def _decimal(count: int) -> list[str]:
    return [str(k) for k in range(count)]
