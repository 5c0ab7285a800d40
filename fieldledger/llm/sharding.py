"""Balanced label propagation: linked documents move into the same shards, whose row counts stay even."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from fieldledger.llm.store import keep

BLOCK_ROWS = 20_000
LARGE_GROUP = 1_000
NODE = ("node", "doc_id", "size", "text_crc32", "hub", "own")


def node_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One small row per document: node, id, size, CRC and the hub (equal texts have the same hub).

    The node number only tells rows apart that repeat both id and text, so it need not be the same in every run.
    """
    body = F.coalesce(docs[text], F.lit(""))
    return docs.select(
        F.monotonically_increasing_id().alias("node"),
        docs[doc_id].alias("doc_id"),
        (F.octet_length(body) + 16).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.struct(F.xxhash64(body).alias("a"), F.xxhash64(F.lit(1), body).alias("b")).alias("hub"),
    )


def hub_votes(nodes: DataFrame, shards: int, quota: int) -> DataFrame:
    """Each hub of two or more: its ``members`` and the ``shards`` it wants, those that hold most of it.

    A hub wants as many shards as its members fill. Members are counted per shard before hubs meet in one row, so
    a hub has at most as many partial rows per task as there are shards, however many members it has.
    """
    per_shard = nodes.groupBy("hub", "shard").agg(F.count(F.lit(1)).alias("n"))
    # Ties go to a shard drawn by the hub, or else the first shards would be wanted by all.
    order = F.struct(-F.col("n"), F.xxhash64("hub", "shard"), F.col("shard").alias("shard"))
    votes = per_shard.groupBy("hub").agg(F.sum("n").alias("members"), F.array_sort(F.collect_list(order)).alias("by"))
    wanted = F.ceil(F.col("members") / quota).cast("int")
    return votes.where("members > 1").select(
        F.col("hub").alias("_hub"),
        "members",
        F.transform(F.slice("by", F.lit(1), F.least(wanted, F.lit(shards))), lambda x: x["shard"]).alias("wants"),
    )


def place(nodes: DataFrame, rows: int, shards: int, blocks: int) -> DataFrame:
    """Give every node a shard and a slot: the one it wants, as far as the shards' quotas go.

    ``nodes`` has ``want``, ``rank`` (lower goes first) and ``mass`` (what stays together). Shard ``s`` takes
    ``rows // shards`` nodes, and the first ``rows % shards`` shards one more. Nodes are numbered inside small blocks of
    (shard, rank, hash) and blocks are shifted by the counts before them, so no task orders a whole shard. Nodes
    numbered beyond the quota fill the slots left over, in the order of the shards. The driver sees one count a shard.
    """
    wanted = {r["want"]: r["n"] for r in nodes.groupBy("want").agg(F.count(F.lit(1)).alias("n")).collect()}
    quotas, over_before, room = [], [], []
    over = free = 0
    for s in range(shards):
        quota, n = rows // shards + (s < rows % shards), wanted.get(s, 0)
        quotas.append(quota)
        over_before.append(over)
        over += max(0, n - quota)
        if n < quota:
            room.append((free, free + quota - n, s, n))
            free += quota - n
    spaces = F.array(
        *[
            F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(s).alias("shard"), F.lit(n).alias("used"))
            for a, b, s, n in room or [(0, 0, 0, 0)]
        ]
    )
    blocked = nodes.withColumn("block", F.pmod("mass", F.lit(blocks)))
    within = W.partitionBy("want").orderBy("rank", "block").rowsBetween(W.unboundedPreceding, -1)
    shifts = (
        blocked.groupBy("want", "rank", "block")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            F.col("want").alias("_w"),
            F.col("rank").alias("_r"),
            F.col("block").alias("_b"),
            F.coalesce(F.sum("n").over(within), F.lit(0)).alias("shift"),
        )
    )
    inside = W.partitionBy("want", "rank", "block").orderBy("mass", "doc_id", "size", "node")
    numbered = blocked.withColumn("no", F.row_number().over(inside) - 1)
    same = (F.col("want") == F.col("_w")) & (F.col("rank") == F.col("_r")) & (F.col("block") == F.col("_b"))
    at = numbered.join(shifts, same).select(
        *[numbered[c] for c in (*NODE, "want")],
        (F.col("shift") + F.col("no")).alias("at"),
        F.get(F.array(*[F.lit(q) for q in quotas]), F.col("want")).alias("quota"),
        F.get(F.array(*[F.lit(o) for o in over_before]), F.col("want")).alias("over_before"),
    )
    stays = F.col("at") < F.col("quota")
    beyond = at.withColumn("beyond", F.when(~stays, F.col("over_before") + F.col("at") - F.col("quota")))
    home = F.get(F.filter(spaces, lambda x: (F.col("beyond") >= x["a"]) & (F.col("beyond") < x["b"])), F.lit(0))
    homes = beyond.withColumn("home", F.when(~stays, home))
    return homes.select(
        *NODE,
        F.when(stays, F.col("want")).otherwise(F.col("home.shard")).cast("int").alias("shard"),
        F.when(stays, F.col("at"))
        .otherwise(F.col("home.used") + F.col("beyond") - F.col("home.a"))
        .cast("long")
        .alias("slot"),
    )


def first_shards(nodes: DataFrame, shards: int) -> DataFrame:
    return nodes.withColumn("shard", F.pmod("own", F.lit(shards)).cast("int"))


def many_repeats(nodes: DataFrame) -> DataFrame:
    """Ids and hubs that very many rows repeat."""
    counted = nodes.groupBy("doc_id", "hub").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > LARGE_GROUP)
    return counted.select(F.col("doc_id").alias("_id"), F.col("hub").alias("_repeated"))


def with_own(nodes: DataFrame, repeats: DataFrame) -> DataFrame:
    """Add ``own``, a number by which rows of the same wish are drawn and ordered.

    It follows from id and text, so the same documents go to the same shards and slots however they are partitioned. Only
    where more than ``LARGE_GROUP`` rows repeat both, which nothing tells apart, the node spreads them over tasks.
    """
    same = nodes["doc_id"].eqNullSafe(repeats["_id"]) & (nodes["hub"] == repeats["_repeated"])
    own = F.when(F.col("_repeated").isNull(), F.xxhash64("doc_id", "hub")).otherwise(F.xxhash64("doc_id", "hub", "node"))
    return nodes.join(repeats, same, "left").withColumn("own", own).drop("_id", "_repeated")


def wishes(nodes: DataFrame, votes: DataFrame, shards: int) -> DataFrame:
    """What every node wants: its hub's shards if it is linked, else to stay where it is, last in the queue."""
    linked = F.col("members").isNotNull()
    large = F.col("members") > LARGE_GROUP
    own = F.col("own")
    pick = F.get("wants", F.pmod(own, F.size("wants")).cast("int"))
    want = F.when(linked, F.when(F.array_contains("wants", F.col("shard")), F.col("shard")).otherwise(pick))
    return (
        nodes.join(votes, nodes["hub"] == votes["_hub"], "left")
        .withColumn("want", F.coalesce(want, F.col("shard")).cast("int"))
        .withColumn("rank", F.when(linked, 0).otherwise(1))
        # Members of a small hub stay together in a block; a large one is spread over the blocks.
        .withColumn("mass", F.when(linked & ~large, F.xxhash64("hub")).otherwise(own))
        .select(*NODE, "want", "rank", "mass")
    )


def shard_documents(
    docs: DataFrame, shards: int = 40, rounds: int = 2, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Each row's ``doc_id``, ``size``, ``text_crc32``, ``hub``, ``shard`` and ``slot``.

    Law ``rows``: shards have ``rows // shards`` rows or one more, and slots run from 0 without a gap. Documents with
    equal texts are linked through one hub, never in pairs. They begin in shards drawn by hash. In each round a hub
    counts its members per shard and votes for the shards that hold most, members ask to move there, and quotas decide:
    linked rows go first, unlinked ones make room. A hub larger than a shard asks for several.

    Only ids, sizes and hashes are shuffled, never texts. A hub with a third of all rows is counted per shard
    before it is gathered; the join that brings its vote back is one that adaptive execution splits. Each round is
    written to the shared folder, so a lost executor repeats a round at most.

    The same documents get the same shards and slots however the table is partitioned; of more than ``LARGE_GROUP`` rows
    that repeat both id and text, only how many lie in which shard may differ.

    Null text: size 16 and the CRC of nothing, linked with the empty text. Null ids and rows that repeat are placed like
    others. An empty table gives no rows. Other columns are not carried.
    """
    nodes = keep(node_rows(docs, doc_id, text), "shard-rows")
    # Written first: a join straight on an aggregate of the same keys could not split what very many rows repeat.
    repeats = keep(many_repeats(nodes), "shard-repeats")
    nodes = keep(first_shards(with_own(nodes, repeats), shards), "shard-nodes")
    rows = nodes.count()
    blocks = rows // (shards * BLOCK_ROWS) + 4
    quota = max(1, rows // shards)
    for turn in range(max(1, rounds)):
        # Written first: a join straight on an aggregate of the same key could not split a large hub.
        votes = keep(hub_votes(nodes, shards, quota), "hub-votes")
        nodes = keep(place(wishes(nodes, votes, shards), rows, shards, blocks), f"shard-{turn}")
    return nodes.drop("own")
