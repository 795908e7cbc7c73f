"""Near-duplicate classes by a chosen-path set similarity join.

A document's set holds its distinct word shingles.  Minwise values of the set are tokens; a tree starts with all
documents and branches them by a few selected coordinates, so that documents which agree there share a node.  Nodes
that hold few documents are compared exhaustively, larger ones branch again by further coordinates chosen by the node,
and several independent trees run side by side.  With ROOTS = 8 coordinates, a pair of similarity 0.75 misses every
root node with probability 0.25 ** 8, and a pair in a large node survives a level with probability 1 - 0.25 ** 2 below
each of its roots, so recall stays above 0.999 for any depth used here.

Only links between different components matter for the classes, so each node is first compared with its smallest
document (linear), and only nodes that still hold several components are compared exhaustively or branched.  Rows with
equal sets are one vertex from the start.  What is still large after DEPTH levels is compared in pairs of blocks of
bounded size.  A pair that shares several nodes is tried in one of them.  Candidates pass a sketch of one byte a coordinate (up to four standard deviations below the threshold)
and are confirmed on the full sets, so links have no false positives.

Cases: a null or empty text, or one of blanks, has no shingle, links with nothing and is its own component.  Rows that
share a ``doc_id`` share their links.  A null ``doc_id`` takes the component of rows with the same set, else null; its
row is kept only if no row with an id has its set.  Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaxmart.llm.common import cut, prepare
from vaxmart.llm.graph import components
from vaxmart.llm.shingles import WordHashes, hashed, shingle_set, words

SHINGLE, SIMILARITY = 5, 75  # words; per cent of the union
ROOTS, BRANCHES, COORDINATES = 8, 2, 256
LEAF, DEPTH = 4096, 3  # documents of a node that is compared whole, and of a pair of blocks; levels
_SEEDS = np.random.default_rng(20).integers(0, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _minwise(h: np.ndarray) -> np.ndarray:
    """The smallest value of each of COORDINATES hash functions over a set of hashes."""
    low = np.full(COORDINATES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(h), 256):
        np.minimum(low, (h[at:at + 256, None] * _SEEDS).min(axis=0), out=low)
    return low


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memory = WordHashes()
    for batch in batches:
        out = []
        for text in batch.column(1).to_pylist():
            h = hashed(words(text), SHINGLE, memory)
            if len(h):
                low = _minwise(h)
                sketch = (low >> np.uint64(40)).astype(np.uint8).tobytes()
                out.append((len(h), xxhash.xxh3_128_digest(h.tobytes()), low[:ROOTS].view(np.int64).tolist(), sketch))
            else:
                out.append((0, None, None, None))
        kinds = (pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary())
        columns = [pa.array(c, kind) for c, kind in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n_shingles", "set_key", "roots", "sketch"])


def _alike(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether two sketches agree often enough: up to four standard deviations below the threshold."""
    s = SIMILARITY / 100
    return (x == y).sum(axis=-1) >= COORDINATES * s - 4 * (COORDINATES * s * (1 - s)) ** 0.5


def _sketches(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, COORDINATES)


def _filter_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            yield batch.select(["a", "b"]).filter(pa.array(_alike(_sketches(batch.column(2)), _sketches(batch.column(3)))))


def _by_node(batches: Iterator[pa.RecordBatch]):
    """Lists of the rows of one node after the other; rows come sorted by node, in the first column."""
    def rows():
        for batch in batches:
            yield from zip(*(column.to_pylist() for column in batch.columns))

    for node, group in groupby(rows(), key=lambda r: r[0]):
        yield node, list(group)


def _in_batches(pairs, names: list[str]) -> Iterator[pa.RecordBatch]:
    while out := list(islice(pairs, 10_000)):
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=names)


def _compare_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For a node, the documents that have a partner with another label and an alike sketch, and those pairs.

    ``homes`` holds a document's root nodes that are compared whole, by tree; a pair is left to the smallest node
    among those it shares (nodes below the roots take only pairs that share none)."""
    for node, group in _by_node(batches):
        _, below, ids, labels, homes, sketches = zip(*group)
        order = np.argsort(np.array(ids), kind="stable")
        id_of, label = np.array(ids)[order], np.array(labels)[order]
        home = np.array(homes, dtype=np.int64)[order]
        x = np.frombuffer(b"".join(sketches), dtype=np.uint8).reshape(-1, COORDINATES)[order]
        limit = np.iinfo(np.int64).max if below[0] else node
        found = []
        for i in range(len(id_of) - 1):
            j = np.flatnonzero(label[i + 1:] != label[i]) + i + 1
            j = j[_alike(x[i], x[j])]
            j = j[~((home[j] == home[i]) & (home[i] != 0) & (home[i] < limit)).any(axis=1)]
            if len(j):
                found.append(np.stack([np.full(len(j), i), j], axis=1))
        if found:
            pairs = np.concatenate(found)
            used, at = np.unique(pairs, return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([node]), pa.array([id_of[used].tolist()], pa.list_(pa.int64())),
                 pa.array([at.astype(np.int32).tobytes()], pa.binary())], names=["node", "ids", "pairs"])


def _similar(a: set[bytes], b: set[bytes]) -> bool:
    both = len(a & b)
    return both > 0 and 100 * both >= SIMILARITY * (len(a) + len(b) - both)


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    @lru_cache(maxsize=64)
    def made(text):
        return shingle_set(words(text), SHINGLE)

    for batch in batches:
        good = [_similar(made(a), made(b)) for a, b in zip(*(batch.column(i).to_pylist() for i in (2, 3)))]
        yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))


def _confirm_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a node from its texts (rows with an id) and its pairs; what is linked already is not tried."""
    memory = WordHashes()

    def links():
        for _, group in _by_node(batches):
            texts: dict[int, list[str]] = {}
            for _, doc, text, _, _ in group:
                if doc is not None:
                    texts.setdefault(doc, []).append(text)
            hashes = {doc: [hashed(words(t), SHINGLE, memory) for t in found] for doc, found in texts.items()}
            parent: dict[int, int] = {}

            def root(x):
                while parent.get(x, x) != x:
                    parent[x] = x = parent.get(parent[x], parent[x])
                return x

            for _, doc, _, ids, pairs in group:
                if doc is None:
                    for i, j in np.frombuffer(pairs, dtype=np.int32).reshape(-1, 2).tolist():
                        a, b = ids[i], ids[j]
                        if root(a) != root(b) and _linked(texts[a], texts[b], hashes[a], hashes[b]):
                            parent[root(b)] = root(a)
                            yield a, b

    links = links()
    while out := list(islice(links, 10_000)):
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["a", "b"])


def _linked(a_texts, b_texts, a_hashes, b_hashes) -> bool:
    """Whether a text of each side is similar enough: by hashes first, then by the shingles themselves."""
    for s, x in zip(a_texts, a_hashes):
        for t, y in zip(b_texts, b_hashes):
            short, long = (x, y) if len(x) < len(y) else (y, x)
            if 100 * len(short) >= SIMILARITY * len(long):
                at = np.searchsorted(long, short)
                both = int((long[np.minimum(at, len(long) - 1)] == short).sum())
                if 100 * both >= SIMILARITY * (len(x) + len(y) - both) and _similar(
                        shingle_set(words(s), SHINGLE), shingle_set(words(t), SHINGLE)):
                    return True
    return False


def confirm_in_nodes(found: DataFrame, texts: DataFrame) -> DataFrame:
    """Links among the pairs of nodes (node, ids, pairs): each text goes to its node once."""
    ids = found.select("node", F.explode("ids").alias("id"))
    none = F.lit(None)
    needed = ids.join(texts, "id").select("node", "id", "text", none.cast("array<long>").alias("ids"), none.cast("binary").alias("pairs"))
    both = needed.union(found.select("node", none.cast("long"), none.cast("string"), "ids", "pairs"))
    return both.repartition("node").sortWithinPartitions("node").mapInArrow(_confirm_nodes, "a long, b long")


def confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    needed = texts.join(ids, "id", "left_semi")
    joined = (
        pairs.join(needed.toDF("a", "a_text"), "a").join(needed.toDF("b", "b_text"), "b")
        .select("a", "b", "a_text", "b_text")
    )
    return joined.mapInArrow(_confirm, "a long, b long")


_COLUMNS = ("node", "below", "id", "label", "homes", "sketch")


def _children(frontier: DataFrame, level: int) -> DataFrame:
    """Each node's members dealt by the coordinates that the node chooses."""
    choice = [F.pmod(F.xxhash64("node", F.lit(level), F.lit(r)), F.lit(COORDINATES)).cast("int") + 1 for r in range(BRANCHES)]
    nodes = F.array(*[F.xxhash64("node", F.lit(r), F.substring("sketch", i, 1)) for r, i in enumerate(choice)])
    return frontier.withColumn("node", F.explode(nodes)).withColumn("below", F.lit(True)).select(*_COLUMNS)


def _mixed(frontier: DataFrame) -> DataFrame:
    """Nodes that hold more than one component, with their sizes."""
    return (
        frontier.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi"))
        .where(F.col("lo") < F.col("hi")).select("node", "n")
    )


def _in_blocks(frontier: DataFrame, sizes: DataFrame) -> DataFrame:
    """Every pair of blocks of a node that is still large: each row goes to as many nodes as its node has blocks."""
    rows = frontier.join(sizes, "node").withColumn("blocks", F.ceil(F.col("n") / F.lit(LEAF // 2)).cast("int")).withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.withColumn("node", F.xxhash64("node", F.least("block", "other"), F.greatest("block", "other"))).withColumn(
        "below", F.lit(True)).select(*_COLUMNS)


def _compare(frontier: DataFrame) -> DataFrame:
    ordered = frontier.select(*_COLUMNS).repartition("node").sortWithinPartitions("node")
    return ordered.mapInArrow(_compare_nodes, "node long, ids array<long>, pairs binary")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = rows.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("id"), "text")
    sets = cut(rows.mapInArrow(
        _sets, "doc_id long, n_shingles long, set_key binary, roots array<long>, sketch binary"), "sets")
    classes = cut(sets.where("set_key IS NOT NULL").groupBy("set_key").agg(F.min("doc_id").alias("id")), "classes")
    vertices = sets.join(classes, ["set_key"]).where(F.col("doc_id") == F.col("id")).select("id", "roots", "sketch")

    # Root nodes of all trees; only those with several documents go on.
    roots = vertices.select("id", F.posexplode("roots").alias("tree", "value")).select(
        "id", "tree", F.xxhash64("tree", "value").alias("node"))
    shared = roots.groupBy("node").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi")
    members = cut(roots.join(shared.select("node", "lo"), "node"), "members")
    sketches = vertices.select("id", "sketch")

    # Every member against its node's smallest document.
    stars = members.where("id > lo").select(F.col("lo").alias("a"), F.col("id").alias("b")).distinct()
    stars = stars.join(sketches.toDF("a", "a_sketch"), "a").join(sketches.toDF("b", "b_sketch"), "b")
    links = cut(confirm(cut(
        stars.select("a", "b", "a_sketch", "b_sketch").mapInArrow(_filter_pairs, "a long, b long"), "stars"), texts), "links")
    labels = components(links)

    # Nodes with several components: compared if small, branched if large.
    tagged = members.join(labels, "id", "left").select("node", "tree", "id", F.coalesce("label", "id").alias("label"))
    sizes = cut(_mixed(tagged), "sizes")
    mixed = cut(tagged.join(sizes, "node"), "mixed")
    small = F.col("n") <= LEAF
    by_tree = F.array(*[F.coalesce(F.max(F.when(small & (F.col("tree") == t), F.col("node"))), F.lit(0)) for t in range(ROOTS)])
    homes = mixed.groupBy("id").agg(by_tree.alias("homes"))
    frontier = cut(mixed.join(homes.join(sketches, "id"), "id").withColumn("below", F.lit(False)).select(*_COLUMNS), "frontier")
    nodes = []
    for level in range(DEPTH):
        nodes.append(cut(_compare(frontier.join(sizes.where(small), "node", "left_semi")), "nodes"))
        if sizes.where(~small).isEmpty():
            break
        frontier = cut(_children(frontier.join(sizes.where(~small), "node", "left_semi"), level), "frontier")
        sizes = cut(_mixed(frontier), "sizes")
    else:
        nodes.append(cut(_compare(_in_blocks(frontier, sizes)), "nodes"))
    more = cut(confirm_in_nodes(reduce(DataFrame.union, nodes), texts), "links")
    if not more.isEmpty():
        labels = components(links.union(more))

    final = cut(classes.join(labels, "id", "left").select("set_key", F.coalesce("label", "id").alias("label")), "final")
    own = sets.select("doc_id", "n_shingles", "set_key").join(final, "set_key", "left")
    component = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("label"))
    return own.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
         ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS s
  FROM w
), sized AS (SELECT doc_id, len(s) AS n FROM sets),
item AS (SELECT doc_id, unnest(s) AS x FROM sets),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_common FROM item a JOIN item b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2
), link AS (
  SELECT a, b FROM common JOIN sized p ON p.doc_id = a JOIN sized q ON q.doc_id = b
  WHERE 100 * n_common >= 75 * (p.n + q.n - n_common)
), edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach(id, r) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT reach.id, edge.b FROM reach JOIN edge ON edge.a = reach.r
)
SELECT id AS doc_id, n AS n_shingles, min(r) AS component_id, id = min(r) AS kept
FROM reach JOIN sized ON doc_id = id GROUP BY id, n
"""
