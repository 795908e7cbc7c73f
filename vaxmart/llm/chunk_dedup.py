"""Substring deduplication by content-defined chunks.

A gear rolling hash over the last WINDOW bytes makes an end wherever it falls below a bound (about every BETWEEN bytes);
ends that follow another by less than SMALLEST bytes are left out.  So boundaries depend on nearby bytes alone and an
insertion moves none of the others.  Chunks are compared by a 128-bit
digest.  The document with the smallest ``doc_id`` that holds a chunk owns it; a chunk is repeated in every other
document, and again inside a document that holds it twice.  Runs of repeated chunks that cover MIN_RUN bytes are cut.

Cases: a null or empty text has no chunk.  Rows that share a ``doc_id`` are one document to each other.  A chunk of
rows without ``doc_id`` is repeated if any row with one holds it.  Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaxmart.llm.common import prepare, whole

WINDOW, BETWEEN, SMALLEST, LONGEST, MIN_RUN = 16, 24, 16, 1024, 100
_GEAR = np.random.default_rng(9).integers(0, 1 << 32, 256, dtype=np.uint32)


def boundaries(data: bytes) -> np.ndarray:
    """Ends of the chunks."""
    h = _GEAR[np.frombuffer(data, dtype=np.uint8)]
    size = 1
    while size < WINDOW:
        h[size:] += h[:-size] << np.uint32(32 // WINDOW * size)
        size *= 2
    ends = np.flatnonzero(h < (1 << 32) // BETWEEN) + 1
    ends = ends[np.diff(np.append(-SMALLEST, ends)) >= SMALLEST]
    ends = np.unique(np.append(ends, len(data)))
    long = np.diff(np.append(0, ends))
    if long.max(initial=0) > LONGEST:
        more = [np.arange(e - n + LONGEST, e, LONGEST) for e, n in zip(ends[long > LONGEST], long[long > LONGEST])]
        ends = np.unique(np.concatenate([ends, *more]))
    return ends[ends > 0]


def chunks(data: bytes) -> tuple[list[int], list[bytes]]:
    ends = boundaries(data).tolist()
    return ends, [xxhash.xxh3_128_digest(data[a:b]) for a, b in zip([0, *ends], ends)]


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, found = [], []
        for i, text in enumerate(batch.column(1).to_pylist()):
            distinct = list(dict.fromkeys(chunks(text.encode("utf-8"))[1]))
            found += distinct
            ids += [i] * len(distinct)
        if found:
            halves = np.frombuffer(b"".join(found), dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(pa.array(ids)) for c in (0, 2)), pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy())],
                names=["doc_id", "th", "d1", "d2"])


def repeated_runs(ends: list[int], digests: list[bytes], elsewhere: set[bytes]) -> tuple[int, list[tuple[int, int]]]:
    """Number of repeated chunks, and the runs of them that are long enough."""
    seen: set[bytes] = set()
    runs: list[tuple[int, int]] = []
    n, begin, at = 0, None, 0
    for end, d in zip([*ends, None], [*digests, None]):
        if d is not None and (d in elsewhere or d in seen):
            n += 1
            begin = at if begin is None else begin
        elif begin is not None:
            if at - begin >= MIN_RUN:
                runs.append((begin, at))
            begin = None
        seen.add(d)
        at = end
    return n, runs


def dedup_chunks(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_chunks, n_repeated, n_removed, n_spans, kept_sha256."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole(F.col("text")).alias("text"))
    # A document is known by its id and its text's hash, so rows without an id are not gathered.
    rows = rows.withColumn("th", F.xxhash64("text"))
    held = rows.mapInArrow(_digests, "doc_id long, th long, d1 long, d2 long")
    owners = held.groupBy("d1", "d2").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"),
                                          (F.count(F.lit(1)) - F.count("doc_id")).alias("no_id"))
    owners = owners.where("owner < last OR (no_id > 0 AND owner IS NOT NULL)").select("d1", "d2", "owner")
    elsewhere = held.join(owners, ["d1", "d2"]).where(~F.col("doc_id").eqNullSafe(F.col("owner")))
    elsewhere = elsewhere.groupBy("doc_id", "th").agg(F.collect_set(F.struct("d1", "d2")).alias("found")).toDF("__id", "__th", "__found")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data = text.encode("utf-8")
                other = {np.array([f["d1"], f["d2"]]).tobytes() for f in found or []}
                ends, digests = chunks(data)
                n, runs = repeated_runs(ends, digests, other)
                edges = [0, *(x for r in runs for x in r), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                out.append((len(data), len(ends), n, len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest()))
            kinds = [pa.int64()] * 5 + [pa.string()]
            columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[
                "doc_id", "n_bytes", "n_chunks", "n_repeated", "n_removed", "n_spans", "kept_sha256"])

    joined = rows.join(elsewhere, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("th") == F.col("__th")), "left").select("doc_id", "text", "__found")
    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_chunks long, n_repeated long, n_removed long, "
                                  "n_spans long, kept_sha256 string")
