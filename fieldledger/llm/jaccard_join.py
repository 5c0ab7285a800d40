"""N-gram Jaccard join: documents whose sets of word shingles are similar, by a prefix-tree join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from fieldledger.llm.components import components
from fieldledger.llm.store import arrow_schema, give_back, keep, packed, row_key, short_lived, unpacked
from fieldledger.llm.words import buffers, columns, lists_of, mix, numbers, row_blocks, signed, windows, words_of
from fieldledger.operators.columns import quoted

SHINGLE = 5
SCAN_BYTES = 1 << 20
FLUSH_CODES = 2_000_000
# Members of a probe that are walked together.
WALK = 256
HEADS = "doc_id long, row long, n long, key long, check long, known long, code array<long>, fresh int"
SETS = "key long, n long, code array<long>"
LINKS = "a long, b long, shared long"
# Elements of a block of sets that is compared with another one at once; a set counts as LEAST_SET at least.
BLOCK_CODES, LEAST_SET = 1 << 18, 64
# A component of more elements than this has several blocks, so that it is spread over tasks.
SPREAD_CODES, SPREAD_BLOCKS = 1 << 14, 8
# Overlaps that are held at once.
TILE = 1 << 21
DEGREES = "key long, n_links long"
# Shingles are shuffled in so many turns, one part of the codes or sets each, so that a turn's shuffles are small.
HEAD_TURNS, SET_TURNS = 2, 4
# Bits of a mark for each chosen row, of one row of marks, and of all of them (8 MB, whatever the number of rows).
BITS_A_ROW, MARK_BITS, MOST_BITS = 16, 1 << 15, 1 << 26


class Bounds:
    """Set sizes and overlaps for a similarity of ``per_cent``, in whole numbers."""

    def __init__(self, per_cent: int) -> None:
        if not 50 <= per_cent <= 100:
            raise ValueError("per_cent must be between 50 and 100")
        self.per_cent = per_cent

    def common(self, n):
        """Least overlap of a set of ``n`` with a similar one."""
        return -(-n * self.per_cent // 100)

    def prefix(self, n):
        """So many first elements hold one that a similar set shares, whatever the order."""
        return n - self.common(n) + 1

    def head(self, n):
        """A longer prefix, which holds ``1 + n // 16`` shared elements."""
        return self.prefix(n) + n // 16

    def overlap(self, n, m):
        """Least overlap of similar sets of ``n`` and ``m``."""
        return -(-(n + m) * self.per_cent // (100 + self.per_cent))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted codes of the distinct shingles of each text; one of fewer words is one shingle of all of them."""
    words = words_of(data, offsets, lower=True)
    codes = windows(words.code, size)
    out = []
    for first, last in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        n = last - first
        if n >= size:
            out.append(np.unique(codes[first : last - size + 1]))
        else:
            # Another factor than that of full shingles, so that they never meet.
            short = windows(words.code[first:last], n, seed=n + 1) if n else np.zeros(0, np.uint64)
            out.append(short)
    return out


SALT, CHECK_SALT = numbers(2, 77)


def set_key(codes: np.ndarray, salt: np.uint64 = SALT) -> int:
    """One number for a set, from its elements and their count."""
    total = np.array([mix(codes ^ salt).sum(dtype=np.uint64) + np.uint64(len(codes))], dtype=np.uint64)
    return int(signed(mix(total))[0])


def find_heads(batches: Iterator[pa.RecordBatch], bounds: Bounds) -> Iterator[pa.RecordBatch]:
    """Size, key and first shingles of each text's set; sets and shingles that a task sees twice are joined.

    Only one text of each set hands on shingles, and each shingle is handed on once. Those in two sets are known to
    be shared: ``known`` counts them, and the one handed on stands behind the ``fresh`` ones, for other tasks.
    """
    schema = arrow_schema(HEADS)
    held: list[tuple] = []
    heads: list[np.ndarray] = []
    seen: set[int] = set()
    count = 0

    def flush() -> pa.RecordBatch:
        lengths = np.array([len(h) for h in heads])
        code = np.concatenate(heads) if heads else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(heads)), lengths)
        order = np.argsort(code, kind="stable")
        own = code[order]
        stands = np.concatenate([[True], own[1:] != own[:-1]]) if len(own) else np.zeros(0, bool)
        group = np.cumsum(stands) - 1
        often = np.bincount(group)[group] > 1 if len(own) else np.zeros(0, bool)
        known = np.bincount(owner[order][often], minlength=len(heads))
        # Fresh codes come first in each list.
        sent_owner, sent_often, sent_code = owner[order][stands], often[stands], own[stands]
        again = np.lexsort((sent_often, sent_owner))
        first = np.concatenate([[0], np.cumsum(np.bincount(sent_owner, minlength=len(heads)))])
        fresh = np.bincount(sent_owner[~sent_often], minlength=len(heads))
        return columns(
            {
                "doc_id": pa.concat_arrays([x[0] for x in held]),
                "row": pa.concat_arrays([x[1] for x in held]),
                "n": [n for x in held for n in x[2]],
                "key": [k for x in held for k in x[3]],
                "check": [k for x in held for k in x[4]],
                "known": known,
                "code": lists_of(signed(sent_code[again]), first),
                "fresh": fresh.astype(np.int32),
            },
            schema,
        )

    for batch in batches:
        data, offsets = buffers(batch.column(2))
        for low, high in row_blocks(offsets, SCAN_BYTES):
            sizes, keys, checks = [], [], []
            for codes in shingle_sets(data, offsets[low : high + 1]):
                key = set_key(codes)
                sizes.append(len(codes))
                keys.append(key if len(codes) else None)
                checks.append(set_key(codes, CHECK_SALT) if len(codes) else None)
                new = len(codes) > 0 and key not in seen
                seen.add(key)
                heads.append(codes[: bounds.head(len(codes))] if new else codes[:0])
                count += len(heads[-1])
            held.append((batch.column(0)[low:high], batch.column(1)[low:high], sizes, keys, checks))
            if count >= FLUSH_CODES:
                yield flush()
                held, heads, seen, count = [], [], set(), 0
    if held:
        yield flush()
    del held, heads, seen
    give_back()


def whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Key, size and all shingles of each text."""
    schema = arrow_schema(SETS)
    for batch in batches:
        data, offsets = buffers(batch.column(0))
        for low, high in row_blocks(offsets, SCAN_BYTES):
            sets = shingle_sets(data, offsets[low : high + 1])
            first = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
            yield columns(
                {
                    "key": [set_key(s) for s in sets],
                    "n": [len(s) for s in sets],
                    "code": lists_of(signed(np.concatenate(sets)), first),
                },
                schema,
            )


def walk_trie(batches: Iterator[pa.RecordBatch], bounds: Bounds, step: int = 64) -> Iterator[pa.RecordBatch]:
    """Overlaps of a probe with its members, which come in the order of a trie's leaves.

    Rows are sorted by probe and by the members' ordered sets, so the path from the root to the last member is all of the
    trie that is ever needed: a member keeps the partial overlaps of the path it shares with the one before and goes on
    from there. A subtree is left as soon as its overlap and what remains of the member cannot reach the bound.
    """
    schema = arrow_schema(LINKS)
    probe, probe_n, probe_set = None, 0, np.zeros(0, np.int64)
    path, sums = np.zeros(0, np.int64), np.zeros(1, np.int64)  # sums[d]: overlap of the first d elements of the path
    for batch in batches:
        out: list[tuple[int, int, int]] = []
        for a, role, key, n, codes in zip(*[batch.column(k) for k in range(5)], strict=True):
            values = codes.values.to_numpy()
            if role.as_py() == 0:
                probe, probe_n, probe_set = a.as_py(), n.as_py(), np.sort(values)
                path, sums = values[:0], np.zeros(1, np.int64)
                continue
            n = n.as_py()
            need = bounds.overlap(probe_n, n)
            both = min(len(path), len(values))
            other = np.flatnonzero(path[:both] != values[:both])
            depth = min(int(other[0]) if len(other) else both, len(sums) - 1)
            known = [sums[: depth + 1]]
            total = int(sums[depth])
            while depth < len(values) and total + len(values) - depth >= need:
                part = values[depth : depth + step]
                at = np.minimum(np.searchsorted(probe_set, part), max(0, len(probe_set) - 1))
                hits = total + np.cumsum(probe_set[at] == part) if len(probe_set) else np.full(len(part), total)
                known.append(hits)
                total, depth = int(hits[-1]), depth + len(part)
            path, sums = values, np.concatenate(known)
            if depth == len(values) and total >= need:
                out.append((probe, key.as_py(), total))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in zip(*out, strict=True)], schema=schema
            )


def verified(pairs: DataFrame, sets: DataFrame, bounds: Bounds) -> DataFrame:
    """The pairs ``a``, ``b`` that are similar enough, with their overlap.

    Members of a probe are walked in blocks of about ``WALK``, so a probe with very many is spread over many tasks. Sets
    are fetched by joins that adaptive execution splits; a probe's set goes once to each of its blocks.
    """
    sized = keep(pairs.groupBy(F.col("a").alias("_a")).agg(F.ceil(F.count(F.lit(1)) / WALK).alias("_blocks")), "sizes")
    blocked = pairs.join(sized, pairs["a"] == sized["_a"]).select(
        "a", "b", F.pmod(F.xxhash64("b"), F.col("_blocks")).alias("block")
    )
    codes = sets.select(F.col("key").alias("_key"), "n", "codes")
    members = blocked.join(codes, blocked["b"] == codes["_key"]).select(
        "a", "block", F.lit(1).alias("role"), F.col("b").alias("key"), "n", "codes"
    )
    probes = blocked.select("a", "block").distinct()
    probes = probes.join(codes, probes["a"] == codes["_key"]).select(
        "a", "block", F.lit(0).alias("role"), F.col("a").alias("key"), "n", "codes"
    )
    ordered = members.unionByName(probes).repartition("a", "block").sortWithinPartitions("a", "block", "role", "codes")
    return ordered.select("a", "role", "key", "n", "codes").mapInArrow(lambda x: walk_trie(x, bounds), LINKS)


def in_turns(df: DataFrame, column: str, turns: int) -> list[DataFrame]:
    """The rows of ``df`` in parts, by a column of hashes."""
    return [df.where(F.pmod(column, F.lit(turns)) == turn) for turn in range(turns)]


def shared_heads(sent: DataFrame) -> DataFrame:
    """``key`` and ``n_shared``: how many of a set's fresh shingles another set, or a task, has handed on as well."""
    # A task hands a shingle on once, so one in a third of all texts has a row per task here.
    same = W.partitionBy("code")
    seen = sent.select(
        "key",
        "is_fresh",
        (F.min("key").over(same) != F.max("key").over(same)).alias("others"),
        F.max(~F.col("is_fresh")).over(same).alias("twice"),
    )
    return seen.where("is_fresh AND (others OR twice)").groupBy("key").agg(F.count(F.lit(1)).alias("n_shared"))


def chosen_rows(heads: DataFrame, bounds: Bounds) -> DataFrame:
    """``_row``, written: one row of each set that may have a similar one.

    Two similar sets share at least ``1 + n // 16`` shingles of their heads, n being that of the set whose head ends first.
    Most sets do not share so many with any other and go.
    """
    sent = heads.select("key", "fresh", F.posexplode("code").alias("at", "code"))
    sent = sent.select("key", "code", (F.col("at") < F.col("fresh")).alias("is_fresh"))
    with short_lived(heads.sparkSession) as keep_meanwhile:
        parts = [shared_heads(part) for part in in_turns(sent, "code", HEAD_TURNS)]
        shared = keep_meanwhile(parts[0], "shared", *parts[1:])
        shared = shared.groupBy("key").agg(F.sum("n_shared").alias("n_shared"))
        classes = heads.where("n > 0").groupBy(F.col("key").alias("_key")).agg(
            F.max("n").alias("n"), F.sum("known").alias("n_known"), F.min("row").alias("row")
        )
        needed = F.lit(1) + F.floor(F.ceil(F.col("n") * bounds.per_cent / 100) / 16)
        return keep(
            classes.join(shared, classes["_key"] == shared["key"], "left")
            .where(F.col("n_known") + F.coalesce("n_shared", F.lit(0)) >= needed)
            .select(F.col("row").alias("_row")),
            "chosen",
        )


def chosen_texts(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """``row`` and ``text`` of the chosen rows, each once.

    A bit for each chosen row goes to all tasks, so that few other texts are shuffled. The bits have a fixed limit; rows that
    share one are told apart by the join that follows, which is exact at any number of rows.
    """
    wanted = BITS_A_ROW * chosen.count()
    bits = min(max(MARK_BITS, 1 << wanted.bit_length()), MOST_BITS)
    place = F.pmod("_row", F.lit(bits))
    marks = chosen.groupBy(F.floor(place / MARK_BITS).alias("_mark")).agg(
        F.bitmap_construct_agg(place % MARK_BITS).alias("_bits")
    )
    texts = docs.select(row_key().alias("row"), "text")
    place = F.pmod("row", F.lit(bits))
    byte = F.substring("_bits", (F.floor(place % MARK_BITS / 8) + 1).cast("int"), F.lit(1))
    marked = F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), (place % 8).cast("int")) == 1
    texts = texts.join(F.broadcast(marks), F.floor(place / MARK_BITS) == marks["_mark"]).where(marked).select("row", "text")
    # An inner join: Spark would move a semi join below the one before. Of rows that repeat, one is enough; the join has
    # already brought them together.
    return texts.join(chosen, texts["row"] == chosen["_row"]).groupBy("row").agg(F.first("text").alias("text"))


def candidate_sets(docs: DataFrame, chosen: DataFrame, bounds: Bounds) -> DataFrame:
    """Sets that may have a similar one, written: ``key``, ``n``, ``codes`` (shared shingles, rare ones first).

    The whole sets of the chosen rows are fetched and shingles that no other has are dropped, which do not count for an
    overlap; where too few are left, the set goes as well.
    """
    texts = chosen_texts(docs, chosen)
    whole = texts.select("text").mapInArrow(whole_sets, SETS).select("key", "n", F.explode("code").alias("code"))
    with short_lived(docs.sparkSession) as keep_meanwhile:
        # Written first: a join straight on an aggregate of the same key could not split a frequent shingle.
        whole = keep_meanwhile(whole, "survivors")
        counts = whole.groupBy(F.col("code").alias("_code")).agg(F.count(F.lit(1)).alias("df")).where("df > 1")
        counts = keep_meanwhile(counts, "counts")

        def ordered(some: DataFrame) -> DataFrame:
            ranked = some.join(counts, some["code"] == counts["_code"]).select("key", "n", "df", "code")
            sets = ranked.groupBy("key").agg(
                F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("df", "code"))).alias("ranked")
            )
            enough = F.size("ranked") >= F.ceil(F.col("n") * bounds.per_cent / 100)
            return sets.where(enough).select("key", "n", F.transform("ranked", lambda x: x["code"]).alias("codes"))

        parts = [ordered(part) for part in in_turns(whole, "key", SET_TURNS)]
        return keep(parts[0], "sets", *parts[1:])


def prefix_rows(sets: DataFrame, bounds: Bounds) -> DataFrame:
    """``code``, ``key``, ``n``, ``alone`` (shingles no other set has) and ``at`` of the shared shingles in each prefix.

    The order of a set is: shingles that no other set has, then the others from rare to frequent. The first kind takes up its
    part of the prefix and needs no row.
    """
    n, alone = F.col("n"), F.col("n") - F.size("codes")
    length = n - F.ceil(n * bounds.per_cent / 100) + 1 - alone
    first = F.slice("codes", F.lit(1), F.greatest(length, F.lit(0)).cast("int"))
    rows = sets.select("key", "n", alone.alias("alone"), F.posexplode(first).alias("at", "code"))
    return rows.select("code", "key", "n", "alone", (F.col("at") + F.col("alone")).alias("at"))


def find_links(sets: DataFrame, bounds: Bounds, rounds: int = 2) -> DataFrame:
    """Links (``a``, ``b``, ``shared``) that connect exactly the sets that chains of similar pairs connect.

    Star rounds: each shingle of the prefixes has a leader, and every set is compared with the one it meets most often, so
    a group of copies costs one comparison each. Then every pair of sets that share a prefix shingle but are not connected yet is compared, if sizes
    and what remains behind the shingle allow the overlap. Similar sets always share a prefix shingle, so no
    connection is missed; pairs that are already connected need no comparison.
    """
    rows = keep(prefix_rows(sets, bounds), "prefixes")
    least = F.ceil((F.col("n") + F.col("m")) * bounds.per_cent / (100 + bounds.per_cent))
    fits = F.least("n", "m") >= F.ceil(F.greatest("n", "m") * bounds.per_cent / 100)
    links = None
    for turn in range(rounds):
        # First the set with the smallest share of shingles of its own, which is nearest to what a group was copied
        # from; then one drawn by hash.
        share = F.col("alone") / F.col("n") if turn == 0 else F.lit(0.0)
        mark = F.struct(share.alias("s"), F.xxhash64(F.lit(turn), "key").alias("h"), F.col("key").alias("key"), F.col("n").alias("n"))
        leaders = rows.groupBy(F.col("code").alias("_code")).agg(F.min(mark).alias("leader"), F.max("key").alias("last"), F.min("key").alias("first"))
        leaders = leaders.where("first <> last").select("_code", F.col("leader.key").alias("a"), F.col("leader.n").alias("m"))
        leaders = keep(leaders, "leaders")
        # Each set is compared with the leader that stands under most of its shingles.
        best = F.max(F.struct("n_codes", "a"))
        pairs = (
            rows.join(leaders, rows["code"] == leaders["_code"])
            .where((F.col("a") != F.col("key")) & fits)
            .groupBy("a", "key")
            .agg(F.count(F.lit(1)).alias("n_codes"))
            .groupBy("key")
            .agg(best.alias("best"))
            .select(F.col("best.a").alias("a"), F.col("key").alias("b"))
        )
        if links is not None:
            pairs = pairs.join(links.select("a", "b"), ["a", "b"], "left_anti")
        found = verified(keep(pairs, "pairs"), sets, bounds)
        links = keep(found if links is None else links.unionByName(found), "star-links")
    joined = components(links)
    labelled = rows.join(joined.withColumnRenamed("key", "_key"), rows["key"] == F.col("_key"), "left").select(
        "code", "key", "n", "at", F.coalesce("component", "key").alias("component")
    )
    several = (
        labelled.groupBy(F.col("code").alias("_code"))
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low <> high")
        .select("_code")
    )
    several = keep(several, "several")
    rest = keep(labelled.join(several, labelled["code"] == several["_code"], "left_semi"), "open-prefixes")
    other = rest.select(
        F.col("code").alias("_code"),
        F.col("key").alias("b"),
        F.col("n").alias("m"),
        F.col("at").alias("at_b"),
        F.col("component").alias("_component"),
    )
    remain = 1 + F.least(F.col("n") - F.col("at"), F.col("m") - F.col("at_b")) - 1
    pairs = (
        rest.join(other, rest["code"] == other["_code"])
        .where((F.col("key") < F.col("b")) & (F.col("component") != F.col("_component")) & fits & (remain >= least))
        .select(F.col("key").alias("a"), "b")
        .distinct()
    )
    links = links.unionByName(verified(keep(pairs, "pairs"), sets, bounds))
    return links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "shared").distinct()


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> Iterator[tuple[int, int, np.ndarray]]:
    """Number of common elements of each set on the left with each on the right, for ranges of the left ones."""
    lengths = np.array([len(x) for x in right])
    code = np.concatenate(right)
    order = np.argsort(code, kind="stable")
    code, owner = code[order], np.repeat(np.arange(len(right)), lengths)[order]
    wanted = np.concatenate(left)
    low, high = np.searchsorted(code, wanted), np.searchsorted(code, wanted, side="right")
    first = np.concatenate([[0], np.cumsum([len(x) for x in left])])
    found = np.concatenate([[0], np.cumsum(high - low)])[first]
    begin = 0
    while begin < len(left):
        end = int(np.searchsorted(found, found[begin] + TILE, side="right")) - 1
        end = min(max(end, begin + 1), begin + max(1, TILE // len(right)), len(left))
        span = slice(first[begin], first[end])
        sizes = high[span] - low[span]
        place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(low[span], sizes)
        row = np.repeat(np.repeat(np.arange(end - begin), np.diff(first[begin : end + 1])), sizes)
        cells = np.bincount(row * len(right) + owner[place], minlength=(end - begin) * len(right))
        yield begin, end, cells.reshape(end - begin, len(right))
        begin = end


def count_block_links(table: pa.Table, bounds: Bounds) -> pa.Table:
    """For the sets of two blocks of a component, or of one, the copies of all similar sets on the other side."""
    schema = arrow_schema(DEGREES)
    one = table.column("i")[0].as_py() == table.column("j")[0].as_py()
    codes = table.column("codes").combine_chunks()
    flat = codes.flatten().to_numpy(zero_copy_only=False)
    edges = np.concatenate([[0], np.cumsum(codes.value_lengths().to_numpy(zero_copy_only=False))])
    key, n, copies, block = (table.column(c).to_numpy() for c in ("key", "n", "copies", "block"))
    own = np.flatnonzero(block == table.column("i")[0].as_py())
    other = np.flatnonzero(block == table.column("j")[0].as_py())
    degree = np.zeros(len(key), np.int64)
    if len(own) and len(other):
        sets = [flat[edges[k] : edges[k + 1]] for k in range(len(key))]
        for begin, end, both in overlaps([sets[k] for k in own], [sets[k] for k in other]):
            part = own[begin:end]
            similar = both >= bounds.overlap(n[part][:, None], n[other][None, :])
            if one:
                similar &= part[:, None] != other[None, :]
            degree[part] += similar @ copies[other]
            if not one:
                degree[other] += copies[part] @ similar
    at = np.flatnonzero(degree)
    give_back()
    return pa.table([pa.array(key[at], pa.int64()), pa.array(degree[at])], schema=schema)


def link_counts(links: DataFrame, groups: DataFrame, sets: DataFrame, copies: DataFrame, bounds: Bounds) -> DataFrame:
    """``key`` and ``n_links``: for each set, the rows whose sets are similar, but not equal.

    ``links`` connect each component; where they are all its pairs, they are counted as they are. The sets of other
    components are dealt into blocks by hash, and each pair of blocks is compared as a whole in one task: no pair of a
    component is left out, and no row is made for a pair. ``copies`` has the rows of each set.
    """
    sized = copies.select(F.col("key").alias("_key"), "copies")
    member = groups.select(F.col("key").alias("_member"), "component")
    own = keep(groups.groupBy("component").agg(F.count(F.lit(1)).alias("n_sets")), "components")
    held = links.join(member, links["a"] == member["_member"]).groupBy("component").agg(F.count(F.lit(1)).alias("n_found"))
    pairs = F.col("n_sets") * (F.col("n_sets") - 1) / 2
    state = keep(
        own.join(held, "component").select(F.col("component").alias("_component"), (F.col("n_found") == pairs).alias("whole")),
        "states",
    )
    known = keep(
        groups.join(state, groups["component"] == state["_component"]).select(F.col("key").alias("_member"), "component", "whole"),
        "members",
    )
    whole = known.where("whole").select(F.col("_member").alias("_whole"))
    closed = links.join(whole, links["a"] == whole["_whole"])
    ends = closed.select(F.col("a").alias("k"), F.col("b").alias("o")).unionByName(closed.select(F.col("b").alias("k"), F.col("a").alias("o")))
    direct = ends.join(sized, ends["o"] == sized["_key"]).select(F.col("k").alias("key"), F.col("copies").alias("n_links"))

    some = known.where("NOT whole").select("_member", "component")
    dealt = sets.join(some, sets["key"] == some["_member"]).join(sized, sets["key"] == sized["_key"])
    dealt = keep(dealt.select("component", "key", "n", "codes", "copies"), "open-sets")
    total = F.sum(F.greatest(F.size("codes"), F.lit(LEAST_SET)))
    blocks = F.greatest(F.ceil(total / BLOCK_CODES), F.least(F.ceil(total / SPREAD_CODES), F.lit(SPREAD_BLOCKS)))
    sizes = keep(dealt.groupBy(F.col("component").alias("_component")).agg(blocks.cast("int").alias("blocks")), "blocks")
    placed = dealt.join(sizes, dealt["component"] == sizes["_component"]).withColumn(
        "block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    )
    against = placed.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    both = against.select(
        "component", F.least("block", "_other").alias("i"), F.greatest("block", "_other").alias("j"), "block", "key", "n", "copies", "codes"
    )
    counted = both.groupBy("component", "i", "j").applyInArrow(lambda table: count_block_links(table, bounds), DEGREES)
    return direct.unionByName(counted).groupBy("key").agg(F.sum("n_links").alias("n_links"))


def classes_of(docs: DataFrame, per_cent: int, doc_id: str, text: str, count_links: bool = False) -> DataFrame:
    """Per row: ``doc_id``, ``row`` (its key), ``n``, the ``first`` row of its component and, if asked for, ``n_links``."""
    bounds = Bounds(per_cent)
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    keyed = rows.select("doc_id", row_key().alias("row"), "text")
    with short_lived(docs.sparkSession) as keep_meanwhile:
        heads = keep_meanwhile(keyed.mapInArrow(lambda x: find_heads(x, bounds), HEADS), "heads")
        # Written by itself, so that the shingles' shuffle has gone before the texts' begins.
        chosen = chosen_rows(heads, bounds)
        own = keep(heads.select("doc_id", "row", "n", "key", "check"), "keys")
    sets = candidate_sets(rows, chosen, bounds)
    links = keep(find_links(sets, bounds), "links")
    groups = components(links.select("a", "b"))
    # The first row of a class: the one with the smallest id; rows without an id come last.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
    # A key is 64 bits of a set; rows that share it but have another check are other sets, which stay by themselves.
    sized = own.where("n > 0").groupBy("key", "check").agg(first.alias("first"), F.count(F.lit(1)).alias("copies"))
    least = F.min(F.struct("check", "first", "copies")).alias("own")
    sized = sized.groupBy("key").agg(least).select("key", "own.check", "own.first", "own.copies")
    if count_links:
        groups, sized = keep(groups, "groups"), keep(sized, "sizes")
        degree = keep(link_counts(links, groups, sets, sized.select("key", "copies"), bounds), "degrees")
    classes = sized.join(groups.withColumnRenamed("key", "_key"), F.col("key") == F.col("_key"), "left").select(
        "key", "check", "first", "copies", F.coalesce("component", "key").alias("component")
    )
    smallest = classes.groupBy(F.col("component").alias("_component")).agg(F.min("first").alias("first_of_all"))
    named = classes.join(smallest, classes["component"] == smallest["_component"])
    linked = F.lit(None).cast("long")
    if count_links:
        degree = degree.withColumnRenamed("key", "_k")
        named = named.join(degree, named["key"] == degree["_k"], "left")
        # Equal sets are similar as well.
        linked = F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1
    named = named.select(F.col("key").alias("_key"), F.col("check").alias("_check"), "first_of_all", linked.alias("n_links"))
    named = keep(named, "classes")
    same = (own["key"] == named["_key"]) & (own["check"] == named["_check"])
    return own.join(named, same, "left").select(
        "doc_id",
        "row",
        "n",
        F.col("first_of_all").alias("first"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def jaccard_classes(docs: DataFrame, per_cent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row's ``doc_id``, ``n_shingles``, ``component_id`` and ``n_links`` (the other rows it is linked with).

    A document's set holds its distinct shingles of five words, in ASCII lower case; fewer words are one shingle. Two
    documents are linked when their sets have a Jaccard similarity of ``per_cent`` or more, and ``component_id`` is the
    smallest id that links reach. Documents with equal sets are one class, so only classes are compared.

    Sets are ordered globally, rare shingles first. Candidates share a shingle of their prefixes, and overlaps are computed
    by walking tries of ordered sets, which share partial overlaps and are pruned by what remains. All steps are joins and
    aggregates over shingles; shingles and copies that a task sees twice are joined before the first shuffle. No group is
    collected: a shingle or a group of copies with a third of all rows is compared with leaders, in blocks. Components are
    known then, and all pairs inside each are compared, block by block, to count links.

    Null, empty or blank text: no shingles, linked with nothing, its own component. Rows that repeat an id, and rows
    with a null id, are linked by their texts; a component of null ids only has a null id. An empty table gives no rows.
    Other columns are not carried.
    """
    return classes_of(docs, per_cent, doc_id, text, count_links=True).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("first.doc_id", "doc_id").alias("component_id"),
        "n_links",
    )


def drop_near_duplicates(docs: DataFrame, per_cent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without those linked to a row with a smaller id; of rows that repeat, one stays.

    Rows without words are linked with nothing, so all of them stay, apart from repeats. Columns stay as they are.
    """
    stay = classes_of(docs, per_cent, doc_id, text).where("first IS NULL OR row = first.row")
    stay = stay.select(F.col("row").alias("stay")).distinct()
    # Rows are dealt by their key once, for the join and for the repeats. Of rows that share a key, those of another id stay.
    keyed = packed(docs, own_id=quoted(doc_id), own=F.xxhash64(quoted(doc_id).cast("long"), quoted(text)))
    kept = keyed.join(stay, F.col("own") == F.col("stay"), "left_semi").dropDuplicates(["own", "own_id"])
    return kept.select(*unpacked(docs.columns, {}))
