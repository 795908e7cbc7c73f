"""Removal of repeated byte strings by suffix arrays over shards.

Every string of LEAST bytes belongs to the smallest hash among the GRAM-byte strings inside it (its anchor), so equal
strings meet under one anchor wherever they stand.  A document falls into segments: runs of starts with one anchor and
the bytes they cover.  Segments that occur twice are repeated whole; anchors with several different segments, and
segments whose anchor recurs inside, go to shards of bounded size, each a suffix array built by induced sorting with
its permuted common prefixes.  A start whose longest common prefix reaches LEAST bytes is repeated.  The starts go back
to the documents, where the covered bytes are cut.  Anchors with more than HOT different segments are not gathered in a
shard: their strings are counted one by one by a 128-bit hash, spread over all tasks.

Cases: a null text is empty; texts under LEAST bytes keep everything.  Rows are told apart by ``doc_id`` and text, so a
null or repeated ``doc_id`` is fine; rows that repeat both are one document that stands twice, and its strings repeat.
Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaxmart.llm.common import cut, parts, prepare, whole
from vaxmart.llm.shingles import mix
from vaxmart.llm.suffix_array import repeated

LEAST = 200
GRAM = 32  # bytes, a power of two; LEAST - GRAM + 1 of them start in a string
RUN = 512  # starts of a segment at most; longer runs are cut
HOT = 2048  # different segments of an anchor that one shard takes
SHARD_BYTES = 1 << 20


def _grams(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes from each position, by doubling."""
    h = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    size, factor = 1, 0xD6E8FEB86659FD93
    while size < GRAM:
        h = h[:-size] * np.uint64(factor) + h[size:]
        size, factor = 2 * size, factor * factor % (1 << 64)
    return mix(h)


def _smallest(h: np.ndarray, width: int) -> np.ndarray:
    """The smallest value of each window."""
    size, low = 1, h
    while 2 * size <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    return np.minimum(low[:len(h) - width + 1], low[width - size:]) if size < width else low


def segments(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first start, number of starts, and whether the anchor recurs inside, of each segment."""
    width = LEAST - GRAM + 1
    h = _grams(np.frombuffer(data, dtype=np.uint8))
    low = _smallest(h, width)
    n = len(low)
    fresh = np.append(True, low[1:] != low[:-1])
    at = np.flatnonzero(fresh)
    length = np.diff(np.append(at, n))
    if length.max() > RUN:
        first = np.repeat(at, length)
        at = np.flatnonzero(fresh | ((np.arange(n) - first) % RUN == 0))
        length = np.diff(np.append(at, n))
    anchor = low[at]
    region = length + width - 1
    begin = np.cumsum(region) - region
    inside = np.arange(region.sum()) - np.repeat(begin, region) + np.repeat(at, region)
    times = np.add.reduceat((h[inside] == np.repeat(anchor, region)).astype(np.int32), begin)
    return anchor.view(np.int64), at, length, times > 1


_CUT = pa.schema([("anchor", pa.int64()), ("digest", pa.int64()), ("doc_id", pa.int64()), ("th", pa.int64()),
                  ("start", pa.int32()), ("n", pa.int32()), ("own", pa.bool_())])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest = xxhash.xxh3_64_intdigest
    for batch in batches:
        found = []
        for doc_id, text, th in zip(*(batch.column(i).to_pylist() for i in range(3))):
            data = text.encode("utf-8")
            if len(data) < LEAST:
                continue
            anchor, at, length, own = segments(data)
            ends = (at + length + (LEAST - 1)).tolist()
            digests = np.fromiter((digest(data[a:b]) for a, b in zip(at.tolist(), ends)), np.uint64, len(at)).view(np.int64)
            found.append((anchor, digests, doc_id, th, at.astype(np.int32), length.astype(np.int32), own))
        if found:
            sizes = [len(f[0]) for f in found]
            ids = pa.array([f[2] for f in found], pa.int64()).take(pa.array(np.repeat(np.arange(len(found)), sizes)))
            ths = np.repeat(np.array([f[3] for f in found], dtype=np.int64), sizes)
            join = [np.concatenate([f[i] for f in found]) for i in (0, 1, 4, 5, 6)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(join[0]), pa.array(join[1]), ids, pa.array(ths), *map(pa.array, join[2:])], schema=_CUT)


def _bytes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The segments asked for (anchor, digest, start, n) of each document, as bytes."""
    for batch in batches:
        out = []
        for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            data = text.encode("utf-8")
            out += [(w["anchor"], w["digest"], data[w["start"]:w["start"] + w["n"] + LEAST - 1], w["hot"]) for w in wanted]
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.bool_())
        columns = [pa.array(c, kind) for c, kind in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds]
        yield pa.RecordBatch.from_arrays(columns, names=["anchor", "digest", "piece", "hot"])


def _ranges(hit: np.ndarray) -> list[dict]:
    """Maximal runs of repeated starts: first, and one past the last."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return [{"s": int(a), "e": int(b)} for a, b in zip(edge[::2], edge[1::2])]


_RANGES = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))


def _sort_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated starts of each segment; rows come sorted by anchor, and a shard holds whole anchors."""
    def rows():
        for batch in batches:
            yield from zip(*(batch.column(i).to_pylist() for i in range(3)))

    def shards():
        shard, size = [], 0
        for _, group in groupby(rows(), key=lambda r: r[0]):
            group = list(group)
            more = sum(len(r[2]) for r in group)
            if shard and size + more > SHARD_BYTES:
                yield shard
                shard, size = [], 0
            shard, size = shard + group, size + more
        if shard:
            yield shard

    for shard in shards():
        hits = [_ranges(h) for h in repeated([r[2] for r in shard], LEAST)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in shard]), pa.array([r[1] for r in shard]), pa.array(hits, _RANGES)],
            names=["anchor", "digest", "ranges"])


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A 128-bit hash of each string of LEAST bytes of a segment."""
    for batch in batches:
        out = []
        for anchor, digest, piece in zip(*(batch.column(i).to_pylist() for i in range(3))):
            out += [(anchor, digest, i, xxhash.xxh3_128_digest(piece[i:i + LEAST])) for i in range(len(piece) - LEAST + 1)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(
                zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.binary()))], names=["anchor", "digest", "at", "string"])


def spans(docs: DataFrame) -> DataFrame:
    """Repeated starts: (doc_id, th, ranges) with one row for each document that has some; ``th`` hashes the text."""
    prepare(docs.sparkSession)
    rows = docs.select("doc_id", "text", "th").where(F.octet_length("text") >= LEAST)
    found = cut(rows.mapInArrow(
        _cut, "anchor long, digest long, doc_id long, th long, start int, n int, own boolean"), "segments")
    seen = found.groupBy("anchor", "digest").agg(
        F.count(F.lit(1)).alias("times"), F.max("own").alias("own"), F.min("th").alias("one"))
    per_anchor = seen.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"), F.max("own").alias("any_own"),
                                            F.max("times").alias("most"))
    per_anchor = per_anchor.where("kinds > 1 OR most > 1 OR any_own")
    status = cut(
        seen.join(per_anchor.select("anchor", "kinds"), "anchor")
        .select("anchor", "digest", "times", "one", "kinds", ((F.col("kinds") > 1) | F.col("own")).alias("sort"))
        .where("times > 1 OR sort"), "status")
    hits = cut(found.join(status, ["anchor", "digest"])
               .select("anchor", "digest", "doc_id", "th", "start", "n", "times", "sort", (F.col("th") == F.col("one")).alias("first"),
                       (F.col("kinds") > HOT).alias("hot")), "hits")

    # The bytes of one occurrence of each segment that has to be sorted.
    wanted = hits.where("sort AND first").groupBy("th").agg(
        F.collect_set(F.struct("anchor", "digest", "start", "n", "hot")).alias("wanted"), F.min("doc_id").alias("rep"))
    by_text = rows.join(wanted, "th").where(F.col("doc_id").eqNullSafe(F.col("rep")))
    pieces = by_text.select("text", "wanted").mapInArrow(_bytes_of, "anchor long, digest long, piece binary, hot boolean")
    pieces = cut(pieces.dropDuplicates(["anchor", "digest"]), "pieces")
    size = pieces.agg(F.sum(F.octet_length("piece")).alias("n")).first()["n"] or 0
    shards = parts(size, SHARD_BYTES, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranges_ddl = "anchor long, digest long, ranges array<struct<s:int,e:int>>"
    cold = pieces.where("NOT hot").select("anchor", "digest", "piece").repartition(shards, "anchor").sortWithinPartitions("anchor")
    result = cold.mapInArrow(_sort_shards, ranges_ddl)
    if not pieces.where("hot").isEmpty():
        strings = cut(pieces.where("hot").select("anchor", "digest", "piece").repartition(shards).mapInArrow(
            _strings, "anchor long, digest long, at int, string binary"), "strings")
        again = strings.groupBy("string").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("string")
        counted = strings.join(again, "string").groupBy("anchor", "digest").agg(
            F.collect_list(F.struct(F.col("at").alias("s"), (F.col("at") + 1).alias("e"))).alias("ranges"))
        result = result.union(counted)
    sorted_ = cut(result.where(F.size("ranges") > 0), "ranges")

    once = F.explode("ranges").alias("r")
    some = hits.where("times = 1").join(sorted_, ["anchor", "digest"]).select("doc_id", "th", "start", once).select(
        "doc_id", "th", (F.col("start") + F.col("r.s")).alias("s"), (F.col("start") + F.col("r.e")).alias("e"))
    every = hits.where("times > 1").select("doc_id", "th", F.col("start").alias("s"), (F.col("start") + F.col("n")).alias("e"))
    return some.union(every).groupBy("doc_id", "th").agg(F.collect_set(F.struct("s", "e")).alias("ranges"))


def removed(ranges: list[dict] | None, size: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by repeated strings, from ranges of their starts."""
    runs: list[tuple[int, int]] = []
    for s, e in sorted((r["s"], r["e"]) for r in ranges or []):
        stop = min(size, e + LEAST - 1)
        if runs and s <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(runs[-1][1], stop))
        else:
            runs.append((s, stop))
    return runs


def kept_bytes(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for run in runs for x in run), len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))


def _with_spans(docs: DataFrame) -> DataFrame:
    keyed = docs.withColumn("text", whole(F.col("text"))).withColumn("th", F.xxhash64("text"))
    keys = spans(keyed).toDF("__id", "__th", "__ranges")
    return keyed.join(keys, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("th") == F.col("__th")), "left")


def dedup_report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, ranges in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data = text.encode("utf-8")
                runs = removed(ranges, len(data))
                out.append((len(data), sum(b - a for a, b in runs), len(runs), hashlib.sha256(kept_bytes(data, runs)).hexdigest()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            columns = [pa.array(c, kind) for c, kind in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return _with_spans(rows).select("doc_id", "text", "__ranges").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def dedup_texts(docs: DataFrame) -> DataFrame:
    """The documents with repeated bytes cut from ``text``; a character that loses a byte goes whole, and a null text
    becomes empty.  All other columns stay as they are."""
    @F.pandas_udf("string")
    def cut_text(text, ranges):
        import pandas as pd

        out = []
        for t, r in zip(text, ranges):
            data = t.encode("utf-8")
            found = [] if r is None else removed([x if isinstance(x, dict) else x.asDict() for x in r], len(data))
            out.append(kept_bytes(data, found).decode("utf-8", "ignore") if found else t)
        return pd.Series(out)

    names = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])
    lower = [n.lower() for n in names]
    text, doc = f"c{lower.index('text')}", f"c{lower.index('doc_id')}"
    keyed = inner.withColumn("text", F.col(text)).withColumn("doc_id", F.col(doc).cast("long"))
    done = _with_spans(keyed).withColumn(text, F.when(F.col("__ranges").isNull(), F.col(text)).otherwise(cut_text("text", "__ranges")))
    return done.select(*[F.col(f"c{i}") for i in range(len(names))]).toDF(*names)


ORACLE = None
