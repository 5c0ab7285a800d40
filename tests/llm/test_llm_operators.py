"""Each operator against plain Python on a small table with nulls, empty and long texts, ties and repeated rows."""

import base64
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from llm_cases import sha
from pyspark.sql import functions as F

import corpus_pipeline

from fieldledger.llm import (
    bpe_replay,
    decontamination,
    jaccard_join,
    language_id,
    line_dedup,
    quality_cnn,
    quality_rules,
    sharding,
    substring_dedup,
    toxicity,
)
from fieldledger.llm.components import components
from fieldledger.llm.samples import labelled_sample
from fieldledger.llm.store import keep
from fieldledger.llm.words import buffers, words_of


def result(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def test_words_agree_with_split(rows):
    texts = [t for _, t in rows]
    data, offsets = buffers(pa.array(texts))
    for limit in (1 << 20, 64):
        words = words_of(data, offsets, lower=True, limit=limit)
        code = {}
        for k, text in enumerate(texts):
            own = (text or "").encode().lower().split()
            span = slice(words.first[k], words.first[k + 1])
            got = [bytes(data[a:b]).lower() for a, b in zip(words.start[span], words.end[span], strict=True)]
            assert got == own
            for w, c in zip(own, words.code[span].tolist(), strict=True):
                assert code.setdefault(w, c) == c
        assert len(set(code.values())) == len(code)


def test_line_dedup(docs, rows):
    keys = defaultdict(set)

    def key(line):
        return "".join(c.lower() if c.isascii() else c for c in line.strip(" \t\n\x0b\x0c\r"))

    for i, text in rows:
        for line in (text or "").split("\n"):
            if i is not None and len(key(line)) >= 40:
                keys[key(line)].add(i)
    common = {k: max(ids) for k, ids in keys.items() if len(ids) >= 5}
    assert common
    want = Counter()
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (key(x) in common and common[key(x)] != i)]
        want[i, len(lines), len(lines) - len(kept), "\n".join(kept)] += 1
    got = line_dedup.dedup_lines(docs)
    assert got.columns[: len(docs.columns)] == docs.columns
    assert result(got, "doc_id", "n_lines", "n_dropped", "kept_text") == want


def test_substring_dedup(docs, rows):
    starts = Counter()
    for _, text in rows:
        words = (text or "").encode().split()
        starts.update(tuple(words[k : k + 35]) for k in range(len(words) - 34))
    want = Counter()
    for i, text in rows:
        words = (text or "").encode().split()
        gone = set()
        for k in range(len(words) - 34):
            if starts[tuple(words[k : k + 35])] > 1:
                gone.update(range(k, k + 35))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        want[i, len(words), len(gone), sha(kept)] += 1
    got = result(substring_dedup.dedup_substrings(docs), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == want
    assert any(0 < n[2] < n[1] for n in want)


def similar(rows):
    """Set sizes and the rows reached by links, by comparing all pairs."""
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        if len(words) < 5:
            sets.append({tuple(words)} if words else set())
        else:
            sets.append({tuple(words[k : k + 5]) for k in range(len(words) - 4)})
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= 80 * len(sets[a] | sets[b]):
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    return sets, group


def test_jaccard_join(docs, rows):
    sets, group = similar(rows)
    want = Counter()
    for k, (i, _) in enumerate(rows):
        ids = [rows[x][0] for x in range(len(rows)) if group[x] == group[k] and rows[x][0] is not None]
        want[i, len(sets[k]), min(ids) if ids else None] += 1
    got = result(jaccard_join.jaccard_classes(docs), "doc_id", "n_shingles", "component_id")
    assert got == want


def test_jaccard_links_are_all_pairs(spark, monkeypatch):
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in range(300)]
    texts = [" ".join(base)] * 2
    for _ in range(40):  # similar to each other, but not to all
        words = list(base)
        for k in rng.choice(300, rng.integers(1, 9), replace=False):
            words[k] = f"x{rng.integers(5)}"
        texts.append(" ".join(words))
    texts += ["a b c d e f", "A b c d e f", "a  b c d e f", "alone in here without any link", "", None]
    rows = list(enumerate(texts))
    sets, _ = similar(rows)
    want = {}
    for a in range(len(rows)):
        linked = [b for b in range(len(rows)) if b != a and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
        want[a] = len(linked)
    assert len(set(want.values())) > 5 and max(want.values()) > 10 and want[42] == 2
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for spread in (1 << 14, 1 << 10):
        monkeypatch.setattr(jaccard_join, "SPREAD_CODES", spread)
        monkeypatch.setattr(jaccard_join, "TILE", spread)
        got = {r["doc_id"]: r["n_links"] for r in jaccard_join.jaccard_classes(docs).collect()}
        assert got == want


def test_near_duplicates_leave_one_of_each_group(docs, rows):
    sets, group = similar(rows)
    kept = jaccard_join.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    got = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    want = set()
    for k, (i, text) in enumerate(rows):
        members = [rows[x] for x in range(len(rows)) if group[x] == group[k]]
        first = min(members, key=lambda m: (m[0] is None, m[0] if m[0] is not None else 0))
        if not sets[k] or (i, text) == first:
            want.add((i, text))
    assert got == Counter(want)


def test_long_chains_are_one_component(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r["key"]: r["component"] for r in components(links).collect()}
    assert got == {**{k: 0 for k in range(61)}, 100: 100, 101: 100}


def test_trie_walk_counts_overlaps():
    rng = np.random.default_rng(0)
    bounds = jaccard_join.Bounds(80)
    probe = np.sort(rng.choice(1000, 100, replace=False))
    members = [np.sort(np.unique(np.concatenate([probe[: 100 - k], rng.choice(1000, k)]))) for k in (0, 5, 9, 12, 40) for _ in range(6)]
    members.sort(key=lambda m: m.tolist())
    values = [probe, *members]
    batch = pa.RecordBatch.from_arrays(
        [
            pa.array([1] * len(values)),
            pa.array([0] + [1] * len(members)),
            pa.array(range(len(values))),
            pa.array([len(v) for v in values]),
            pa.array([v.tolist() for v in values], pa.list_(pa.int64())),
        ],
        names=["a", "role", "key", "n", "codes"],
    )
    got = {(r["b"], r["shared"]) for out in jaccard_join.walk_trie(iter([batch]), bounds, step=7) for r in out.to_pylist()}
    want = set()
    for k, m in enumerate(members, start=1):
        both = len(np.intersect1d(probe, m))
        if 100 * both >= 80 * (len(probe) + len(m) - both):
            want.add((k, both))
    assert got == want and 0 < len(want) < len(members)


def test_bpe_is_that_of_tiktoken_and_decodes(docs, rows):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    tokens = bpe_replay.encode_documents(docs, path, public_tokenizers.PATTERN)
    got = result(bpe_replay.digest_tokens(tokens, path), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    want = Counter()
    for i, text in rows:
        ids = known.encode_ordinary(text or "")
        want[i, len(ids), sha(",".join(map(str, ids))), sha(text or "")] += 1
    assert got == want
    at_once = bpe_replay.encode_and_digest(docs, path, public_tokenizers.PATTERN)
    assert at_once.columns == ["doc_id", "token_ids", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert result(at_once, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want
    assert all(sha(",".join(map(str, r["token_ids"]))) == r["ids_sha256"] for r in at_once.collect())
    without = bpe_replay.encode_and_digest(docs, path, public_tokenizers.PATTERN, with_ids=False)
    assert result(without, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want


def test_merges_of_lower_rank_that_come_up_late():
    ranks = {bytes([b]): b for b in range(256)} | {b"bc": 256, b"abcd": 257, b"abc": 258, b"aa": 259, b"aaa": 260, b"cd": 261}
    vocabulary = bpe_replay.Vocabulary(ranks)
    known = tiktoken.Encoding("t", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abcd"), rng.integers(1, 30))) for _ in range(300)]
    encoder = bpe_replay.Encoder(vocabulary, r"[\s\S]+")
    for part in (words[:200], words):
        ids, first = encoder.encode(part)
        got = [ids[a:b].tolist() for a, b in zip(first, first[1:])]
        assert got == [known.encode_ordinary(w) for w in part]


def test_sharding_law(docs, rows):
    got = sharding.shard_documents(docs, shards=7).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in rows)
    counts = Counter(r["shard"] for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1 and len(counts) == 7
    for shard, n in counts.items():
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(n))
    by_text = {(i, t): ((len((t or "").encode()) + 16), zlib.crc32((t or "").encode())) for i, t in rows}
    assert {(r["doc_id"], r["size"], r["text_crc32"]) for r in got} == {(i, *v) for (i, _), v in by_text.items()}


def test_sharding_keeps_copies_together(spark):
    rows = [(k, f"t{k % 30}" if k < 300 else f"own {k}") for k in range(1000)] + [(k, "large") for k in range(1000, 1500)]
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), shards=10).collect()
    homes, largest = defaultdict(Counter), Counter()
    for r in got:
        text = rows[r["doc_id"]][1]
        (largest if text == "large" else homes[text])[r["shard"]] += 1
    cut = sum(sum(c.values()) - max(c.values()) for t, c in homes.items() if not t.startswith("own"))
    assert cut <= 20  # 270 in expectation where shards are drawn
    assert len(largest) <= 7


def test_quality_rules(docs, rows):
    got = {(r["doc_id"], r["text"]): r for r in quality_rules.apply_rules(docs).collect()}
    for i, text in rows:
        words = (text or "").encode().split()
        seen = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
        repeat = {k + j for k in range(len(words) - 7) if seen[tuple(words[k : k + 8])] > 1 for j in range(8)}
        lines = [x for x in (text or "").split("\n") if x.encode().split()]
        r = got[i, text]
        want = (len(words), sum(len(w.decode()) for w in words), len(lines) - len(set(lines)), len(repeat))
        assert (r["n_words"], r["word_chars"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (len(words) < 20 or 100 * len(repeat) > 30 * len(words))
        assert not (r["base_failed"] and r["kept"])


def test_quality_rules_judge_lines(spark):
    prose = "A plain sentence of many words that nobody would want to lose from a text, and then a second one about rivers."
    more = "Quite another line follows here, with its own words on boats, bridges and the people who cross them daily."
    poor = ["home | news | sport | about | contact", "#### $$$$ &&&& words", "BUY!! NOW!! CHEAP!! OFFER!!", "We use cookies here", "....."]
    texts = [prose + "\n" + more, "\n".join([prose, *poor]), "\n".join(poor * 8 + [prose[:30]])]
    got = quality_rules.apply_rules(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    first, second, third = got.orderBy("doc_id").collect()
    assert first["kept"] and first["cleaned_text"] == texts[0]
    assert second["cleaned_text"] == prose
    assert not third["kept"]


@pytest.fixture(scope="module")
def items(spark):
    texts = ["What is the name of the river that runs through the old town? It is the silver river of the north.",
             "First line of a test item with several words\nand its answer in seven plain words", "", None, "..."]
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def test_decontamination(spark, items):
    whole = [r["text"] for r in items.orderBy("item_id").collect()]
    filler = "unrelated words about weather and stones " * 40
    texts = [whole[0], filler + whole[0].upper() + filler, filler, whole[0].split("?")[0], None, "",
             filler + whole[1].replace("\n", " ") + " " + whole[0], "It is the silver river of the north."]
    docs = spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)], "doc_id long, text string, score int")
    found = {(r["doc_id"], r["item_id"]) for r in decontamination.find_leaks(docs, items).collect()}
    assert found == {(0, 0), (1, 0), (6, 0), (6, 1)}
    kept = decontamination.drop_leaks(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 4, 5, 7]


def test_one_index_at_a_time(spark, monkeypatch):
    texts = [f"Which town lies at the river {k}? It is the town number {k * 7} of the land {k * 3}." for k in range(40)]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    docs = spark.createDataFrame([*enumerate(texts[::2]), (100, "other words"), (101, None)], "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(decontamination, "BYTES_PER_INDEX", 1000)
    kept = []
    monkeypatch.setattr(decontamination, "keep", lambda df, label: kept.append(label) or keep(df, label))
    assert decontamination.n_indexes(items) > 2
    found = decontamination.find_leaks(docs, items)
    assert {(k, 2 * k) for k in range(20)} <= {(r["doc_id"], r["item_id"]) for r in found.collect()}
    assert len(kept) > 2
    assert sorted(r["doc_id"] for r in decontamination.drop_leaks(docs, items).collect()) == [100, 101]


def test_matches_are_the_same_for_any_number_of_indexes(spark, monkeypatch):
    """Edited copies, whose scores lie about the threshold, of items of different lengths; one id in several parts."""
    rng = np.random.default_rng(8)
    words = [f"w{k}" for k in range(150)]
    texts = [" ".join(rng.choice(words, rng.integers(6, 60))) + "? " + " ".join(rng.choice(words, 8)) + "." for _ in range(60)]
    items = spark.createDataFrame([(k // 2 if k > 50 else k, t) for k, t in enumerate(texts)], "item_id long, text string")
    copies = []
    for k in range(150):
        own = texts[k % 60].split()
        for at in rng.choice(len(own), int(len(own) * rng.uniform(0, 0.6)), replace=False):
            own[at] = str(rng.choice(words))
        copies.append((k, " ".join(rng.choice(words, 30)) + " " + " ".join(own)))
    docs = spark.createDataFrame(copies, "doc_id long, text string").coalesce(2)
    found, left = [], []
    for parts in (1, 3, 10):
        monkeypatch.setattr(decontamination, "n_indexes", lambda *a, n=parts: n)
        found.append(Counter(tuple(r) for r in decontamination.find_leaks(docs, items, min_question=0, min_answer=0).collect()))
        left.append(Counter(r["doc_id"] for r in decontamination.drop_leaks(docs, items).collect()))
    assert 60 < len(found[0]) and found[0] == found[1] == found[2]
    assert 0 < len(left[0]) < 150 and left[0] == left[1] == left[2]


def test_items_of_few_words_match_nothing(spark):
    items = spark.createDataFrame([(0, "Paris"), (1, "Who knows?"), (2, "Which river flows through Paris in France?"), (3, None)], "item_id long, text string")
    docs = spark.createDataFrame([(0, "I saw Paris, who knows"), (1, "Which river flows through Paris in France?")], "doc_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontamination.find_leaks(docs, items).collect()} == {(1, 2)}
    assert [r["doc_id"] for r in decontamination.drop_leaks(docs, items).collect()] == [0]
    assert sorted(tuple(r) for r in decontamination.short_items(items).collect()) == [(0, 1), (1, 2), (3, 0)]


def test_samples_do_not_depend_on_the_layout(spark):
    rows = [(k, f"text {k} " * (1 + k % 7)) for k in range(900)] + [(5, "another text"), (5, "a third text"), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(0, 900, 2)] + [(4, 1), (6, None)], "doc_id long, quality int")
    samples, jobs = [], []
    for n in (1, 10, 60):
        group = f"sample-{n}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            samples.append(labelled_sample(docs.repartition(n), labels.repartition(3), "quality", 200, 3, 1, most_bytes=4000))
        finally:
            spark.sparkContext.setJobGroup("", "")
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
    assert samples[0] == samples[1] == samples[2] and 20 < len(samples[0]) <= 200
    assert sum(len(t.encode()) for t, _ in samples[0]) <= 4000
    assert max(jobs) - min(jobs) <= 1 and max(jobs) < 15


def test_shards_do_not_depend_on_the_layout(spark):
    rng = np.random.default_rng(4)
    rows = [(k if k % 11 else None, f"text {rng.integers(0, 300)}" if k % 3 else "one text") for k in range(2500)]
    rows += [(9, "repeated")] * 20
    got = []
    for n in (1, 4, 9):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(n)
        placed = sharding.shard_documents(docs, shards=8)
        got.append(Counter(tuple(r) for r in placed.select("doc_id", "size", "text_crc32", "shard", "slot").collect()))
    assert got[0] == got[1] == got[2]


def test_many_exact_repeats_are_spread(spark, monkeypatch):
    monkeypatch.setattr(sharding, "LARGE_GROUP", 50)
    rows = [(1, "same")] * 700 + [(k, f"text {k}") for k in range(300)]
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), shards=10).collect()
    assert set(Counter(r["shard"] for r in got).values()) == {100} and "own" not in got[0]
    for shard in range(10):
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(100))


@pytest.fixture(scope="module")
def known():
    """The tokenizer whose results ours must equal."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_long_words(known):
    """A word of a megabyte, also where a merge can bring up one of lower rank, in time that grows with its length."""
    vocabulary = bpe_replay.Vocabulary(known._mergeable_ranks)
    rng = np.random.default_rng(6)
    words = ["ab" * 500_000, "".join(rng.choice(list("etaoin"), 200_000)), "the" * 100_000, "é" * 100_000]
    for word in words:
        began = time.perf_counter()
        got, _ = bpe_replay.replay([word.encode()], vocabulary)
        assert time.perf_counter() - began < 5
        assert got.tolist() == known.encode_ordinary(word)


def test_merges_in_turn(known, monkeypatch):
    monkeypatch.setattr(bpe_replay, "IN_TURN", 2)
    rng = np.random.default_rng(7)
    words = ["".join(rng.choice(list("abcdeth"), rng.integers(50, 1500))) for _ in range(150)]
    got, first = bpe_replay.replay([w.encode() for w in words], bpe_replay.Vocabulary(known._mergeable_ranks))
    assert all(got[first[k] : first[k + 1]].tolist() == known.encode_ordinary(w) for k, w in enumerate(words))


def test_column_names_never_clash(spark):
    """Every operator that keeps columns, with its own inner and output names, and a dotted one, as columns of the table."""
    names = ["_drop", "_row", "kept_text", "n_lines", "n_dropped", "_w", "_lines", "_judged", "n_words", "word_chars", "lost_chars", "base_failed",
             "kept", "cleaned_text", "row", "code", "lines", "words", "id", "_id", "_text", "key", "first", "stay_row", "a.b", "n_chars", "item_id", "m"]
    line = "This very common line is longer than forty characters."
    texts = [f"{line}\nown text {k} of this document with some more words" for k in range(6)] + [None, "", line]
    rows = [(k, t, *[f"{name}-{k}" for name in names]) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", *names]).withColumn("n_chars", F.length("text").cast("long"))
    items = spark.createDataFrame([(0, "own text 3 of this document with some more words")], "item_id long, text string")
    model = quality_cnn.fit([])
    kept = [jaccard_join.drop_near_duplicates(docs), decontamination.drop_leaks(docs, items), quality_cnn.keep_good(docs, model),
            corpus_pipeline.without_common_lines(spark, docs, "")]
    for df in kept:
        assert df.columns == docs.columns
        for r in df.collect():
            assert all(r[n] == f"{n}-{r['doc_id']}" for n in names if n != "n_chars")
    added = {line_dedup.dedup_lines: {"kept_text", "n_lines", "n_dropped"},
             quality_rules.apply_rules: {*quality_rules.COUNTS, "base_failed", "lost_chars", "cleaned_text", "kept"}}
    for operator, own in added.items():
        df = operator(docs)
        assert len(set(df.columns)) == len(df.columns) and set(df.columns) == {*docs.columns, *own}
        for r in df.collect():
            assert all(r[n] == f"{n}-{r['doc_id']}" for n in names if n not in own and n != "n_chars")
            assert all(r[n] != f"{n}-{r['doc_id']}" for n in own)
    for df in (jaccard_join.jaccard_classes(docs), decontamination.find_leaks(docs, items), sharding.shard_documents(docs, 3),
               substring_dedup.dedup_substrings(docs), quality_cnn.score_quality(docs, model), toxicity.score_toxicity(docs, toxicity.fit([])),
               language_id.identify(docs.withColumn("lang", F.lit("en")), language_id.train(docs.withColumn("lang", F.lit("en"))))):
        df.collect()


def test_sets_of_one_key_are_told_apart(spark, monkeypatch):
    """Two documents whose sets share the 64-bit key but not its check are not taken for copies, and neither is dropped."""
    texts = ["one two three four five six seven", "some other words that have nothing in common", "ONE two three four five six seven"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)

    def clash(codes, salt=jaccard_join.SALT):
        return 7 if salt == jaccard_join.SALT else int(codes.sum() % np.uint64(1000003))

    heads = {}
    rows = docs.select("doc_id", F.lit(1).cast("long").alias("row"), "text").toArrow().to_batches()
    monkeypatch.setattr(jaccard_join, "set_key", clash)
    for batch in jaccard_join.find_heads(iter(rows), jaccard_join.Bounds(80)):
        heads |= {r["doc_id"]: (r["key"], r["check"]) for r in batch.to_pylist()}
    assert heads[0] == heads[2] and heads[0][0] == heads[1][0] and heads[0][1] != heads[1][1]


def test_decontamination_of_other_scripts_and_empty_sides(spark):
    texts = ["... The answer to this one follows here.", "____. Which word fits here the best?", "这条河叫什么名字？它是北方的银色之河，流过古老的城市。",
             "แม่น้ำสายนี้ชื่ออะไรและไหลผ่านเมืองใด", "川の名前は何ですか。それは北の銀の川です。", "Qui a écrit « Les Misérables » … c’est Victor Hugo lui-même."]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    around = ["some words before, ", "前面还有别的文字", "mots d’avant—"]
    rows = [a + t + a for t in texts for a in around] + ["unrelated words about weather", "完全不同的句子，没有共同之处。", None]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").coalesce(1)
    found = {(r["doc_id"], r["item_id"]) for r in decontamination.find_leaks(docs, items).collect()}
    assert found == {(k, k // 3) for k in range(18)}


def test_search_finds_every_item_above_the_threshold():
    rng = np.random.default_rng(2)
    words = [f"w{k}" for k in range(400)]
    items = [(k, " ".join(rng.choice(words, rng.integers(5, 40)))) for k in range(90)]
    index = decontamination.build_index(items)
    texts = [" ".join(rng.choice(words, 150)) + " " + items[k][1] for k in range(60)]
    data, offsets = buffers(pa.array(texts))
    got_words = words_of(data, offsets, separators=decontamination.SEPARATORS)
    begin, end, _, item, score = decontamination.search(index, got_words.code, got_words.first, 0.4)
    got = {(int(b), int(i)): s for b, i, s in zip(begin, item, score, strict=True)}
    step, want = index.length, {}
    for k in range(len(texts)):
        low, high = got_words.first[k], got_words.first[k + 1]
        for at in range(max(1, -(-(high - low) // step) - 1)):
            a = low + at * step
            terms = set(got_words.code[a : min(a + 2 * step, high)].tolist())
            for i in range(len(items)):
                mine = [p for t in range(len(index.terms)) if int(index.terms[t]) in terms for p in range(index.first[t], index.first[t + 1]) if index.item[p] == i]
                total = float(index.impact[mine].sum())
                if total >= 0.4:
                    want[int(a), i] = total
    assert set(got) == set(want)
    assert all(abs(got[k] - want[k]) < 1e-4 for k in want)


def test_segments_are_the_maximal_ones():
    def slow(values):
        if not values:
            return []
        best = max(((sum(values[a:b]), -(b - a), -a) for a in range(len(values)) for b in range(a + 1, len(values) + 1)))
        if best[0] <= 0:
            return []
        a = -best[2]
        b = a - best[1]
        after = [(x + b, y + b, s) for x, y, s in slow(values[b:])]
        return slow(values[:a]) + [(a, b - 1, best[0])] + after

    rng = np.random.default_rng(4)
    for _ in range(60):
        place = np.flatnonzero(rng.random(25) < 0.35)
        scores = rng.integers(1, 9, len(place)).astype(float) + rng.random(len(place)) / 100
        values = [-0.7] * 25
        for p, s in zip(place, scores, strict=True):
            values[p] = s
        got = [(f, l, round(s, 6)) for f, l, s in toxicity.segments(scores, place, -0.7)]
        assert got == [(f, l, round(s, 6)) for f, l, s in slow(values)]


def test_classifiers_take_every_row(docs, rows):
    texts = [(t, k % 2) for k, (_, t) in enumerate(rows) if t]
    scored = [
        quality_cnn.score_quality(docs, quality_cnn.fit(texts[:20], epochs=1, least_steps=1)),
        quality_cnn.score_quality(docs, quality_cnn.fit([])),
        toxicity.score_toxicity(docs, toxicity.fit(texts)),
        toxicity.score_toxicity(docs, toxicity.fit([])),
    ]
    for df in scored:
        got = df.collect()
        assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in rows)
        assert all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in got)
        assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % (3 if df is scored[0] or df is scored[1] else 4) == (1 if df is scored[0] or df is scored[1] else 2)) for r in got)


def test_languages(docs, rows):
    model = language_id.fit([("the house of the man " * 5, "en"), ("das haus und der mann " * 5, "de")] * 20)
    got = {(r["doc_id"]): r for r in language_id.identify(docs, model).collect()}
    und = {i for i, t in rows if not any(c.isalpha() for c in t or "")}
    assert {i for i, r in got.items() if r["lang_pred"] == "und"} >= und - {None}
    alone = language_id.identify(docs, language_id.fit([])).collect()
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in alone)


def test_languages_of_one_script(spark, monkeypatch):
    rng = np.random.default_rng(8)
    for script in ("कखगघचछजझटठडढतथदध", "กขคงจฉชซดตถทนบปผ", "абвгдежзиклмнопр"):
        words = ["".join(rng.choice(list(script), 5)) for _ in range(30)]
        # The same letters as often, each word the other way round.
        texts = [(" ".join(w[::turn] for w in rng.choice(words, 12)), lang) for _ in range(150) for turn, lang in ((1, "aa"), (-1, "bb"))]
        model = language_id.fit(texts[:200])
        docs = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(texts)] + [(-1, texts[0][0] * 50)], "doc_id long, text string").coalesce(1)
        got = {r["doc_id"]: r for r in language_id.identify(docs, model).collect()}
        assert all(got[k]["lang_pred"] == texts[k][1] for k in range(200, 300))
        # Pieces cut anywhere give the sums of whole texts.
        text = texts[0][0] * 50
        at, share = language_id.vector(text)
        logits = (share @ model.weights[at] + model.intercepts) / model.temperature
        assert abs(got[-1]["score"] - language_id.softmax(logits).max()) < 1e-4
        monkeypatch.setattr(language_id, "SCAN_BYTES", 101)
        letters, _ = language_id.code_points(np.frombuffer("Aé1 ก😀".encode(), np.uint8))
        assert letters.tolist() == [97, 233, 48, 32, ord("ก"), ord("😀")]
        data, offsets = buffers(pa.array([text]))
        assert len(language_id.code_points(data)[0]) == len(text)


def test_every_language_is_learned(spark, monkeypatch):
    rng = np.random.default_rng(9)
    letters = "abcdefghijklmnopqrstuvwxyz"
    own = {f"l{k:03}": ["".join(rng.choice(list(letters), 6)) for _ in range(8)] for k in range(210)}
    rows = [(lang, " ".join(rng.choice(words, 10))) for lang, words in own.items() for _ in range(6 if lang < "l205" else 4)]
    docs = spark.createDataFrame([(k, t, lang) for k, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string")
    model = language_id.train(docs)
    learned = {r["lang"] for r in docs.where("crc32(cast(cast(doc_id as string) as binary)) % 3 <> 1").select("lang").distinct().collect()}
    assert len(learned) > 200 and set(model.languages) == learned
    small = language_id.train(docs, most_bytes=210 * 20)
    assert set(small.languages) == learned
    monkeypatch.setattr(language_id, "MOST_LANGUAGES", 200)
    with pytest.raises(ValueError, match="200 languages"):
        language_id.train(docs)


def test_network_sees_long_texts_whole():
    model = quality_cnn.new_model()
    text = np.random.default_rng(6).integers(32, 120, 5 * quality_cnn.SCAN_BYTES + 77).astype(np.uint8)
    offsets = np.array([0, len(text)])
    rows, first = quality_cnn.half_chunks(text, offsets)
    top, mean = quality_cnn.pooled(quality_cnn.responses(model, rows), first)
    whole = top @ model.top + mean @ model.mean + model.bias
    assert np.allclose(whole, quality_cnn.logits(model, text, offsets), atol=1e-4)


def test_network_gradients():
    model = quality_cnn.new_model()
    rng = np.random.default_rng(8)
    texts = [rng.integers(32, 120, n).astype(np.uint8) for n in (5, 130, 700)]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    rows, first = quality_cnn.half_chunks(np.concatenate(texts), offsets)
    label = np.array([1.0, 0.0, 1.0], dtype=np.float32)

    def loss():
        top, mean = quality_cnn.pooled(quality_cnn.responses(model, rows), first)
        p = 1 / (1 + np.exp(-(top @ model.top + mean @ model.mean + model.bias).astype(np.float64)))
        return float(-(label * np.log(p) + (1 - label) * np.log(1 - p)).mean())

    grads = quality_cnn.gradients(model, rows, first, label)
    for value, grad in zip(model.arrays(), grads, strict=True):
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        old, step = value[at], 1e-3
        value[at] = old + step
        more = loss()
        value[at] = old - step
        less = loss()
        value[at] = old
        assert abs((more - less) / (2 * step) - grad[at]) < 0.1 * abs(grad[at]) + 1e-4


def test_empty_tables(spark, no_docs, items):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    tokens = bpe_replay.encode_documents(no_docs, path, public_tokenizers.PATTERN)
    for df in (
        line_dedup.dedup_lines(no_docs),
        substring_dedup.dedup_substrings(no_docs),
        jaccard_join.jaccard_classes(no_docs),
        jaccard_join.drop_near_duplicates(no_docs),
        sharding.shard_documents(no_docs),
        quality_rules.apply_rules(no_docs),
        decontamination.find_leaks(no_docs, items),
        decontamination.find_leaks(no_docs, items.limit(0)),
        bpe_replay.digest_tokens(tokens, path),
        bpe_replay.encode_and_digest(no_docs, path, public_tokenizers.PATTERN),
        language_id.identify(no_docs, language_id.train(no_docs)),
        quality_cnn.score_quality(no_docs, quality_cnn.fit([])),
        toxicity.score_toxicity(no_docs, toxicity.fit([])),
    ):
        assert df.collect() == []
