"""What operators leave on disk: shuffles of written tables and short-lived tables go as soon as nothing reads them."""

import os
import random
import time

import pytest
from pyspark.sql import functions as F

from fieldledger.llm import jaccard_join, store
from fieldledger.session import scratch_dir, settings


def shuffles(spark):
    """Files of shuffles that are on disk."""
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    names = (blocks.apply(k).name() for k in range(blocks.size()))
    return {name for name in names if name.startswith("shuffle_")}


def gone(spark, before, wait=10.0):
    """Whether all shuffles but those of ``before`` have gone soon; they are removed in the background."""
    end = time.time() + wait
    while shuffles(spark) - before:
        if time.time() > end:
            return False
        time.sleep(0.1)
    return True


def names(spark):
    """Tables in the shared folder."""
    return set(os.listdir(os.path.dirname(scratch_dir(spark, "any")).removeprefix("file:")))


def summed(spark, rows=20_000):
    numbers = spark.range(rows).withColumn("k", F.col("id") % 1009)
    return numbers.groupBy("k").agg(F.sum("id").alias("s"))


def test_a_written_table_leaves_no_shuffle(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    set_before, before = spark.conf.get(name, None), shuffles(spark)
    df = summed(spark)
    kept = store.keep(df, "sums")
    assert gone(spark, before)
    assert spark.conf.get(name, None) == set_before
    # The same frame can be written and read again.
    again = store.keep(df, "sums")
    assert kept.exceptAll(again).isEmpty() and kept.count() == again.count() == df.count() == 1009


def test_a_frame_that_is_cached_can_be_kept(spark):
    held = summed(spark).persist()
    try:
        both = held.join(held.withColumnRenamed("s", "t"), "k")
        assert store.keep(both, "both").where("s = t").count() == 1009
        assert held.agg(F.sum("s")).first()[0] == sum(range(20_000))
    finally:
        held.unpersist()


def test_short_lived_tables_go_with_their_block(spark):
    before = names(spark)
    with store.short_lived(spark) as keep_meanwhile:
        numbers = keep_meanwhile(spark.range(100), "numbers")
        evens = store.keep(numbers.where("id % 2 = 0"), "evens")
        assert len(names(spark) - before) == 2
    assert evens.count() == 50
    assert [x.startswith("evens-") for x in names(spark) - before] == [True]
    before = names(spark)
    with pytest.raises(ZeroDivisionError), store.short_lived(spark) as keep_meanwhile:
        keep_meanwhile(spark.range(100), "numbers")
        raise ZeroDivisionError
    assert names(spark) == before


def test_parts_of_a_table_are_written_in_turn(spark, monkeypatch):
    """The shuffles of one part have gone when the next begins, so disk follows the largest part."""
    before, add, clean = shuffles(spark), store._add, []
    monkeypatch.setattr(store, "_add", lambda df, path: (clean.append(gone(spark, before)), add(df, path))[1])
    df = summed(spark)
    parts = [df.where(F.col("k") % 3 == k) for k in range(3)]
    kept = store.keep(parts[0], "sums", *parts[1:])
    assert clean == [True] * 3 and gone(spark, before)
    assert kept.count() == 1009 and kept.exceptAll(df).isEmpty() and df.exceptAll(kept).isEmpty()


@pytest.fixture
def shuffles_stay(spark, monkeypatch):
    """No small table is broadcast by itself, and files of shuffles stay; gives the MB that have come since."""
    monkeypatch.setattr(store, "SHUFFLES_GO", {})
    before = shuffles(spark)
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    with settings(spark, spark_sql_autoBroadcastJoinThreshold="-1", spark_sql_adaptive_autoBroadcastJoinThreshold="-1"):
        yield lambda: sum(manager.getFile(name).length() for name in shuffles(spark) - before) / 1e6


def test_only_texts_of_chosen_rows_are_shuffled(spark, shuffles_stay):
    rng = random.Random(5)
    texts = [" ".join(f"{rng.getrandbits(64):x}" for _ in range(120)) for _ in range(2_000)]
    near = [" ".join([*texts[k].split()[:-2], "other", "end"]) for k in range(20)]
    rows = [(k, text) for k, text in enumerate(texts + near)] + [(0, texts[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    docs = store.keep(docs, "docs")
    chosen = docs.where("doc_id < 20 OR doc_id >= 2000").select(store.row_key().alias("_row")).distinct()
    chosen, before = store.keep(chosen, "chosen"), shuffles_stay()
    got = store.keep(jaccard_join.chosen_texts(docs, chosen), "texts")
    # All texts have 4 MB, which a semi join of them shuffles; those of chosen rows have 0.1 MB.
    assert shuffles_stay() - before < 1
    wanted = {text for k, text in rows if k < 20 or k >= 2_000}
    assert got.count() == 40 and {r["text"] for r in got.collect()} == wanted
    sets = jaccard_join.candidate_sets(docs, chosen, jaccard_join.Bounds(80))
    assert sorted(r["n"] for r in sets.collect()) == [116] * 40


def test_bits_that_rows_share_lose_and_add_no_text(spark, monkeypatch):
    rows = [(k, f"text {k}") for k in range(3_000)] + [(7, "text 7"), (None, "no id"), (None, None), (5_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    wanted = docs.where("doc_id IS NULL OR doc_id % 10 = 7 OR doc_id = 5000")
    chosen = store.keep(wanted.select(store.row_key().alias("_row")).distinct(), "chosen")
    none = chosen.limit(0)
    expected = sorted({("" if t is None else t) for k, t in rows if k is None or k % 10 == 7 or k == 5_000})
    for most in (jaccard_join.MOST_BITS, 64):  # 64: each bit stands for several rows
        monkeypatch.setattr(jaccard_join, "MARK_BITS", min(jaccard_join.MARK_BITS, most))
        monkeypatch.setattr(jaccard_join, "MOST_BITS", most)
        got = jaccard_join.chosen_texts(docs, chosen).collect()
        # The texts of two rows without one: (null, null) and (5000, null).
        assert sorted({r["text"] or "" for r in got}) == expected and len(got) == len(expected) + 1
        assert jaccard_join.chosen_texts(docs, none).count() == 0


def test_the_join_leaves_no_shingles_of_all_texts(spark, docs, no_docs):
    for rows in (docs, no_docs):
        tables = names(spark)
        left = jaccard_join.drop_near_duplicates(rows)
        made = {x.rsplit("-", 1)[0] for x in names(spark) - tables}
        assert "sets" in made and not made & {"heads", "survivors", "counts"}
        # What it returns reads none of the tables that went.
        assert left.count() == left.select("doc_id", "text").distinct().count()
