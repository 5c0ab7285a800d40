"""The registered queries against their SQL, and the pipeline's stages against plain Python."""

import base64
import os
import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import tiktoken
from compare import connect, differences
from llm_cases import sha

import __spark_entry__ as entry_point
import corpus_pipeline
from fieldledger.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("FIELDLEDGER_SF_DIR", "/root/testdata/sf0.001")
LARGER = "/root/testdata/sf0.1"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLES[name]) is None


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= set(entry_point.queries())
    assert set(ORACLES) <= set(entry_point.oracle_sql())


def test_held_out_quality_and_language(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    got = QUERIES["op1_quality_classifier"](spark, SF_DIR).collect()
    held = [r for r in got if r["held_out"] and r["doc_id"] in labels]
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in held) >= 0.95 * len(held)
    got = [r for r in QUERIES["op4_language_id"](spark, SF_DIR).collect() if r["held_out"]]
    assert sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in got) >= 0.95 * len(got)


@pytest.mark.skipif(not os.path.exists(LARGER), reason="the smallest tables have two toxic labels held out and five to learn from")
def test_held_out_toxicity(spark):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{LARGER}/labels.parquet").collect()}
    got = QUERIES["op6_toxicity"](spark, LARGER).collect()
    held = [(r["score"], r["predicted"], labels[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in labels]
    toxic, clean = ([s for s, _, y in held if y == value] for value in (1, 0))
    assert toxic and clean
    above = sum((a > b) + 0.5 * (a == b) for a in toxic for b in clean) / (len(toxic) * len(clean))
    assert above >= 0.9
    assert sum(p == y for _, p, y in held) >= 0.9 * len(held)


def lower(text):
    return "".join(c.lower() if c.isascii() else c for c in text)


def without_lines(rows):
    holders = defaultdict(set)
    for i, text in rows:
        for line in text.split("\n"):
            if len(key := lower(line.strip(" \t\n\x0b\x0c\r"))) >= 40:
                holders[key].add(i)
    last = {k: max(ids) for k, ids in holders.items() if len(ids) >= 5}
    return [
        (i, "\n".join(x for x in t.split("\n") if last.get(lower(x.strip(" \t\n\x0b\x0c\r")), i) == i)) for i, t in rows
    ]


def without_copies(rows):
    from test_llm_operators import similar

    sets, group = similar(rows)
    first = {}
    for k, (i, _) in enumerate(rows):
        first[group[k]] = min(i, first.get(group[k], i))
    return [r for k, r in enumerate(rows) if not sets[k] or first[group[k]] == r[0]]


def without_items(rows, items):
    def words(text):
        return re.findall(r"[^\W_]+", text.lower())

    wanted = [words(t) for t in items if t]
    out = []
    for i, text in rows:
        own = words(text)
        grams = {tuple(own[k : k + 4]) for k in range(len(own) - 3)}
        shares = [sum(tuple(w[k : k + 4]) in grams for k in range(len(w) - 3)) / max(1, len(w) - 3) for w in wanted]
        if max(shares) < 0.7:
            out.append((i, text))
    return out


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    items = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    seen = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        seen.append(sorted((r["doc_id"], r["text"]) for r in docs.collect()))
        after = stage(spark, docs, SF_DIR)
        assert k == len(corpus_pipeline.STAGES) - 1 or after.columns == docs.columns
        after.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
    rows, good, cut, own, clean = seen
    kept = {i for i, _ in good}
    assert set(good) <= set(rows) and {i for i, q in labels.items() if q == 1} <= kept
    assert any(labels.get(i) == 0 and i not in kept for i, _ in rows)
    assert cut == sorted(without_lines(good))
    assert own == sorted(without_copies(cut))
    assert clean == sorted(without_items(own, items))
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = Counter((r["doc_id"], tuple(r["token_ids"]), r["n_tokens"], r["decoded_sha256"]) for r in docs.collect())
    want = Counter()
    for i, text in clean:
        ids = known.encode_ordinary(text)
        want[i, tuple(ids), len(ids), sha(text)] += 1
    assert got == want
