"""Stupid-backoff scores of all documents under n-gram counts of all documents.

Documents are dealt to batches by a hash.  A batch sends its distinct n-grams with their counts, one row for each hash
bucket; a bucket adds them up to its part of the count table and answers each batch with the totals of the n-grams it
asked for; the batch joins them to its documents' n-grams and sums each document.  So an n-gram, however common, takes
one entry for each batch.  A document is scored by the counts of the others: its own are taken off, which makes
backing off meaningful on the text that was counted.

Score of a word after its history: count(history + word) / count(history) for the longest history with a count, times
ALPHA for each word the history was shortened by; without history count(word) / words, and 1 / (words + 1) for a word
that no other document has.  The first words of a document have shorter histories at no charge.

Cases: a null or empty text, or one of blanks, has no words and a null mean.  Rows that repeat are separate documents.
Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaxmart.llm.common import cut, parts, prepare, total_bytes, whole
from vaxmart.llm.shingles import WordHashes, mix, words

ORDER, ALPHA = 2, 0.4
BATCH_BYTES, BUCKET_BYTES = 8 << 20, 12 << 20


def ngrams(found: list[bytes], memory: WordHashes) -> list[np.ndarray]:
    """Hashes of the n-grams of each order; the one that ends at word i of order k is at i - k + 1."""
    w = np.fromiter(map(memory.__getitem__, found), dtype=np.uint64, count=len(found))
    grams, h = [mix(w + np.uint64(1))], w
    for k in range(2, ORDER + 1):
        h = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + w[k - 1:] if len(h) else h
        grams.append(mix(h + np.uint64(k)))
    return grams


def _types(texts: list[str], buckets: int):
    """N-grams of each text, and the distinct ones of the batch by bucket and hash with their counts."""
    memory = WordHashes()
    grams = [ngrams(words(t), memory) for t in texts]
    every = [g for found in grams for g in found]
    types, counts = np.unique(np.concatenate(every) if every else np.array([], np.uint64), return_counts=True)
    order = np.argsort(types % np.uint64(buckets), kind="stable")
    bounds = np.searchsorted((types % np.uint64(buckets))[order], np.arange(buckets + 1, dtype=np.uint64))
    return grams, types, counts, order, bounds


def score(grams: list[np.ndarray], total, n_words: int) -> tuple[float, int, int]:
    """Sum of the logarithms, words that backed off, words unseen elsewhere. ``total`` gives counts over all documents."""
    n = len(grams[0])
    rest = []
    for g in grams:
        own, at, times = np.unique(g, return_inverse=True, return_counts=True)
        rest.append((total(own) - times)[at])
    others = n_words - n
    value = np.where(rest[0] > 0, rest[0] / max(others, 1), 1 / (others + 1))
    shorter = np.zeros(n, dtype=bool)
    for k in range(1, len(grams)):
        if n > k:
            with_history, history = rest[k], rest[k - 1][:n - k]
            hit = with_history > 0
            value[k:] = np.where(hit, with_history / np.maximum(history, 1), ALPHA * value[k:])
            shorter[k:] = ~hit
    return float(np.log(value).sum()), int(shorter.sum()), int((rest[0] <= 0).sum())


def score_documents(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, log_score, mean_log_score, n_backoff, n_unseen."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole(F.col("text")).alias("text"))
    size = total_bytes(rows)
    batches, buckets = parts(size, BATCH_BYTES), parts(size, BUCKET_BYTES)
    rows = rows.withColumn("batch", F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches)).cast("int"))

    def ask(group: pa.Table) -> pa.Table:
        grams, types, counts, order, bounds = _types(group["text"].to_pylist(), buckets)
        types, counts = types[order], counts[order].astype(np.uint32)
        some = [b for b in range(buckets) if bounds[b] < bounds[b + 1]]
        n = sum(len(g[0]) for g in grams)
        return pa.table({
            "bucket": pa.array(some, pa.int32()),
            "batch": pa.array([group["batch"][0].as_py()] * len(some), pa.int32()),
            "types": pa.array([types[bounds[b]:bounds[b + 1]].tobytes() for b in some], pa.binary()),
            "counts": pa.array([counts[bounds[b]:bounds[b + 1]].tobytes() for b in some], pa.binary()),
            "n": pa.array([n if b == some[0] else 0 for b in some], pa.int64()),
        })

    def add_up(group: pa.Table) -> pa.Table:
        asked = [np.frombuffer(x, np.uint64) for x in group["types"].to_pylist()]
        counts = np.concatenate([np.frombuffer(x, np.uint32) for x in group["counts"].to_pylist()])
        _, at = np.unique(np.concatenate(asked), return_inverse=True)
        total = np.bincount(at, weights=counts).astype(np.uint64)[at]
        ends = np.cumsum([len(a) for a in asked])
        return pa.table({"batch": group["batch"], "bucket": group["bucket"], "n": group["n"],
                         "totals": pa.array([x.tobytes() for x in np.split(total, ends[:-1])], pa.binary())})

    def judge(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, texts = left["doc_id"], left["text"].to_pylist()
        grams, types, _, order, _ = _types(texts, buckets)
        totals = np.zeros(len(types), dtype=np.int64)
        answers = sorted(zip(right["bucket"].to_pylist(), right["totals"].to_pylist()))
        if answers:
            totals[order] = np.frombuffer(b"".join(t for _, t in answers), np.uint64).astype(np.int64)
        n_words = right["words"][0].as_py() if right.num_rows else 0
        out = [score(g, lambda own: totals[np.searchsorted(types, own)], n_words) if len(g[0]) else (None, 0, 0) for g in grams]
        n = [len(g[0]) for g in grams]
        return pa.table({
            "doc_id": ids, "n_words": pa.array(n, pa.int64()), "log_score": pa.array([o[0] for o in out], pa.float64()),
            "mean_log_score": pa.array([o[0] / m if m else None for o, m in zip(out, n)], pa.float64()),
            "n_backoff": pa.array([o[1] for o in out], pa.int64()), "n_unseen": pa.array([o[2] for o in out], pa.int64())})

    asked = rows.groupBy("batch").applyInArrow(ask, "bucket int, batch int, types binary, counts binary, n long")
    answers = cut(asked.groupBy("bucket").applyInArrow(add_up, "batch int, bucket int, n long, totals binary"), "counts")
    n_words = answers.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    answers = answers.drop("n").withColumn("words", F.lit(n_words).cast("long"))
    return rows.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(
        judge, "doc_id long, n_words long, log_score double, mean_log_score double, n_backoff long, n_unseen long")

