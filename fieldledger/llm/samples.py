"""Bounded samples of labelled documents, for fitting classifiers on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fieldledger.llm.store import is_training, keep


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, rows: int, parts: int, held_out: int, doc_id: str = "doc_id", most_bytes: int = 16 << 20
) -> list[tuple[str, int]]:
    """At most ``rows`` texts with their label, drawn by a hash of the id among the rows that may be learned from.

    In the order of that hash, a text that would take the sample over ``most_bytes`` is left out of it; scoring knows no
    such bound. The sample is the same for any partitioning of the tables, and takes the same number of jobs.

    Labels are cut to that number before they meet the texts, so the broadcast side has a proven bound. Of an id that
    repeats one text takes part, found on the map side, so at most ``rows`` texts are shuffled and written. Null texts and
    labels other than 0 and 1 are left out. An id with both labels is left out.
    """
    train, _ = is_training(labels[doc_id], parts, held_out)
    drawn = (
        labels.where(train & labels[label].isin(0, 1))
        .groupBy(labels[doc_id].alias("_id"))
        .agg(F.min(label).cast("int").alias("_label"), F.max(label).alias("_most"))
        .where("_label = _most")
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(rows)
        .select("_id", "_label")
    )
    found = docs.select(docs[doc_id].alias("_doc"), docs["text"].alias("_text")).where("_text IS NOT NULL")
    joined = found.join(F.broadcast(drawn), F.col("_doc") == F.col("_id"))
    one = F.min(F.struct(F.xxhash64("_text").alias("h"), F.col("_text").alias("t")))["t"]
    texts = keep(joined.groupBy("_id", "_label").agg(one.alias("_text")), "sample")
    sized = texts.select("_id", F.xxhash64("_id").alias("_at"), F.octet_length("_text").alias("_size")).collect()
    chosen, size = [], 0
    for r in sorted(sized, key=lambda r: (r["_at"], r["_id"])):
        if size + r["_size"] <= most_bytes:
            chosen.append(r["_id"])
            size += r["_size"]
    wanted = texts.join(F.broadcast(texts.sparkSession.createDataFrame([(i,) for i in chosen], texts.select("_id").schema)), "_id")
    return [(r["_text"], r["_label"]) for r in sorted(wanted.collect(), key=lambda r: r["_id"])]


def logistic_fit(features, labels, weights=None, steps: int = 60, penalty: float = 1e-3):
    """Logistic regression by Newton steps; the last coefficient is the intercept."""
    import numpy as np

    x = np.column_stack([features, np.ones(len(features))])
    y = np.asarray(labels, dtype=float)
    w = np.ones(len(y)) if weights is None else np.asarray(weights, dtype=float)
    beta = np.zeros(x.shape[1])
    ridge = penalty * np.eye(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (w * (p - y)) + ridge @ beta
        hess = (x * (w * p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(hess, grad)
        step *= min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
        beta = beta - step
        if np.abs(step).max() < 1e-7:
            break
    return beta
