"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over seven bytes cuts a text wherever it hits a trigger value for a block size; each piece gives one
base-64 character.  A fingerprint ``size:a:b`` holds the signature at the chosen block size and at twice that size.
Two fingerprints are compared at equal block sizes only (size and doubled size), by the insertions and deletions that
turn one signature into the other: ``1 - distance / (len(x) + len(y))``, best over the compatible pairs.  As public
piecewise hashes do, a comparison counts only if both signatures share a run of seven characters (or the whole of the
shorter one).  The work is linear in a text and uses no other document's data.

Cases: a null text is empty; an empty text has the fingerprint ``3::``; equal fingerprints have likeness 1, two empty
texts included.  Incompatible block sizes give 0.  Equal texts have equal fingerprints.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaxmart.llm.common import cut, parts, prepare, total_bytes, whole

WINDOW, LEAST, LENGTH, RUN = 7, 3, 64, 7
_ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", dtype=np.uint8)


def rolling(data: bytes) -> np.ndarray:
    """A hash of the seven bytes that end at each position (fewer at the start)."""
    x = np.frombuffer(data, dtype=np.uint8).astype(np.uint32) + np.uint32(1)
    x *= np.uint32(0x9E3779B1)
    x ^= x >> np.uint32(15)
    h = x.copy()
    for back in range(1, min(WINDOW, len(x))):
        h[back:] += x[:-back] * np.uint32(pow(0x01000193, back, 1 << 32))
    h ^= h >> np.uint32(16)
    return h * np.uint32(0x85EBCA6B) >> np.uint32(4)


def _signature(data: bytes, ends: np.ndarray) -> str:
    """One character for each piece; the last one also takes what follows LENGTH - 1 cuts."""
    cuts = [0, *(ends[:LENGTH - 1] + 1).tolist()]
    if cuts[-1] < len(data):
        cuts.append(len(data))
    digest = xxhash.xxh32_intdigest
    marks = [digest(data[a:b]) & 63 for a, b in zip(cuts, cuts[1:])]
    return _ALPHABET[marks].tobytes().decode("ascii") if marks else ""


def fingerprint(data: bytes) -> str:
    h = rolling(data)
    size = LEAST
    while size * LENGTH < len(data):
        size *= 2
    while True:
        ends = np.flatnonzero(h % np.uint32(size) == size - 1)
        if len(ends) >= LENGTH // 2 or size == LEAST:
            break
        size //= 2
    twice = ends[h[ends] % np.uint32(2 * size) == 2 * size - 1]
    return f"{size}:{_signature(data, ends)}:{_signature(data, twice)}"


def indel(x: str, y: str) -> int:
    """Insertions and deletions between two strings, by the bit-parallel longest common subsequence."""
    where: dict[str, int] = {}
    for i, c in enumerate(x):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(x)) - 1
    row = full
    for c in y:
        hit = row & where.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(x) + len(y) - 2 * (len(x) - row.bit_count())


def _share_run(x: str, y: str) -> bool:
    n = min(RUN, len(x), len(y))
    runs = {x[i:i + n] for i in range(len(x) - n + 1)}
    return n > 0 and any(y[i:i + n] in runs for i in range(len(y) - n + 1))


def likeness(p: str, q: str) -> float:
    if p == q:
        return 1.0
    found = []
    for one in (p, q):
        size, a, b = one.split(":")
        found.append({int(size): a, 2 * int(size): b})
    best = 0.0
    for size in found[0].keys() & found[1].keys():
        x, y = found[0][size], found[1][size]
        if _share_run(x, y):
            best = max(best, 1.0 - indel(x, y) / (len(x) + len(y)))
    return best


def edit(text: str, following: str) -> str:
    """The last half of the code points replaced by as many from the start of the following text."""
    n = len(text) // 2
    return text[:len(text) - n] + following[:n]


_OUT = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ("part", pa.int32()), ("role", pa.string()), ("text", pa.string()),
])
_DDL = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, part int, role string, text string")


def _row(doc_id, text: str, own: str, following: str, other: str) -> tuple:
    changed = edit(text, following).encode("utf-8")
    after = fingerprint(changed)
    return (doc_id, len(text), hashlib.sha256(changed).hexdigest(), own, after, likeness(own, after), likeness(own, other))


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs each row with the next one of its sorted partition; the partition's first and last rows also go out raw."""
    held, part = None, None
    for batch in batches:
        out = []
        ids, texts, numbers = (batch.column(i).to_pylist() for i in range(3))
        for doc_id, text, part in zip(ids, texts, numbers):
            own = fingerprint(text.encode("utf-8"))
            if held is None:
                out.append((doc_id, None, None, own, None, None, None, part, "head", text))
            else:
                out.append((*_row(*held, text, own), part, "row", None))
            held = (doc_id, text, own)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _OUT)], schema=_OUT)
    if held is not None:
        last = [(held[0], None, None, held[2], None, None, None, part, "tail", held[1])]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*last), _OUT)], schema=_OUT)


def fingerprints(docs: DataFrame, part_bytes: int = 32 << 20) -> DataFrame:
    """One row per document, with the fingerprints of its text and of its edited text.

    The rows are dealt by ranges of ``doc_id`` and sorted within them (ties by text, null ids first), so that the next
    document is the next row; only the first and last row of each range meet across partitions, by a join.
    """
    spark: SparkSession = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole(F.col("text")).alias("text"))
    n = parts(total_bytes(rows), part_bytes, spark.sparkContext.defaultParallelism)
    ordered = rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    made = cut(ordered.withColumn("part", F.spark_partition_id()).mapInArrow(_in_order, _DDL), "ctph")
    tails, heads = (made.where(F.col("role") == r).select("part", "doc_id", "text", "fingerprint") for r in ("tail", "head"))
    # One short row for each partition: the parts that have rows, each with the one after it (the last: the first).
    present = sorted(r["part"] for r in heads.select("part").collect())
    if not present:
        return made.drop("part", "role", "text")
    following = spark.createDataFrame(list(zip(present, present[1:] + present[:1])), "part int, next_part int")
    edges = tails.join(following, "part").join(
        heads.select(F.col("part").alias("next_part"), F.col("text").alias("next_text"),
                     F.col("fingerprint").alias("next_fingerprint")), "next_part")
    columns = made.columns[:7]

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(list(_OUT)[:7])
        for batch in batches:
            out = [_row(i, t, own, nt, nf) for i, t, own, nt, nf in zip(*(batch.column(i).to_pylist() for i in range(5)))]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    crossed = edges.select("doc_id", "text", "fingerprint", "next_text", "next_fingerprint").mapInArrow(
        across, _DDL.split(", part")[0])
    return made.where(F.col("role") == "row").select(*columns).unionByName(crossed)
