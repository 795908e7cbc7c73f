"""Alignment of two tokenizers' tokens by sparse incidence matrices.

A blank and the text are encoded by a byte-level vocabulary (side A) and by a SentencePiece model (side B).  Each side
is a token x byte incidence matrix in compressed rows (CSR).  A row product in Gustavson's manner, row i of A * B^T
adding up the rows of B^T that row i of A names, gives the overlap links: token pairs with the number of bytes they
share.  Overlap links whose tokens end together are the end links; their ends cut the text into groups.  The token x
group incidence matrices of both sides give, by the same product, the shared-group links.  A group of m and n tokens
stands for m * n of those, so whole tables hold the two factors (each token's group) and the number of links, and
``shared_group_links`` multiplies them out in blocks of rows where the pairs themselves are wanted.

Tokens of both sides end before a blank that follows a word, so a text's alignment is that of its units, one behind the
other; a task aligns all its distinct new units at once and puts texts together from them.

The count of an id pair is the number of end links of the whole corpus that hold it.  Documents pass on their distinct
pairs with multiplicities, which are added up by pair, and the sums are joined back: as a broadcast while there are at
most BROADCAST_PAIRS pairs (24 bytes each), else by a shuffle in which the pairs with more than one in HOT_SHARE of all
links (hence fewer than HOT_SHARE of them) are joined apart, so that no pair gathers many rows in a task.

Cases: a null or empty text, or one that either side does not give back byte for byte (it holds U+2581, or the model
normalises it), has no tokens: zeros and ''.  Rows that repeat, and null ids, are documents of their own, and count.
Special tokens' strings in texts are plain text.  Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaxmart.llm import sentencepiece as pieces
from vaxmart.llm.common import cut, prepare, whole

BYTE_LEVEL_FILE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_FILE = pieces.MODEL_FILE
BROADCAST_PAIRS, HOT_SHARE = 1_000_000, 1024
BLOCK = 1 << 20  # products made at once
_LOW = 0xFFFFFFFF


class Csr(NamedTuple):
    """Compressed rows of a 0/1 matrix: row i holds the columns idx[ptr[i]:ptr[i + 1]]."""

    ptr: np.ndarray
    idx: np.ndarray
    n_cols: int

    def transpose(self) -> Csr:
        rows = np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr))
        order = np.argsort(self.idx, kind="stable") if np.any(self.idx[1:] < self.idx[:-1]) else slice(None)
        ptr = np.concatenate([[0], np.cumsum(np.bincount(self.idx, minlength=self.n_cols))])
        return Csr(ptr, rows[order], len(self.ptr) - 1)


def token_bytes(ends: np.ndarray) -> Csr:
    """Tokens x bytes, from the tokens' end offsets."""
    n = int(ends[-1]) if len(ends) else 0
    return Csr(np.concatenate([[0], ends]), np.arange(n), n)


def token_groups(group: np.ndarray, n_groups: int) -> Csr:
    """Tokens x groups, from each token's group."""
    return Csr(np.arange(len(group) + 1), group, n_groups)


def product(left: Csr, right: Csr) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, column, value) of left * right, some rows at a time, in order."""
    brings = np.diff(right.ptr)
    done = np.concatenate([[0], np.cumsum(brings[left.idx])])[left.ptr]  # products before each row
    begin, n_rows = 0, len(left.ptr) - 1
    while begin < n_rows:
        end = max(begin + 1, int(np.searchsorted(done, done[begin] + BLOCK, side="right")) - 1)
        names = left.idx[left.ptr[begin]:left.ptr[end]]
        sizes = brings[names]
        total = int(sizes.sum())
        if total:
            rows = np.repeat(np.repeat(np.arange(begin, end), np.diff(left.ptr[begin:end + 1])), sizes)
            within = np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            key = rows * right.n_cols + right.idx[np.repeat(right.ptr[names], sizes) + within]
            if np.any(key[1:] < key[:-1]):
                key = np.sort(key)
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            key, value = key[first], np.diff(np.append(first, total))
            yield key // right.n_cols, key % right.n_cols, value
        begin = end


def gather(parts: Iterator[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    found = list(parts)
    return tuple(np.concatenate(c) for c in zip(*found)) if found else (np.array([], np.int64),) * 3


class Alignment(NamedTuple):
    """Overlap links (token of A, token of B, shared bytes), the end links among them, and each token's group."""

    a: np.ndarray
    b: np.ndarray
    shared: np.ndarray
    ends: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    n_groups: int


def align(ends_a: np.ndarray, ends_b: np.ndarray) -> Alignment:
    a, b, shared = gather(product(token_bytes(ends_a), token_bytes(ends_b).transpose()))
    ends = np.flatnonzero(ends_a[a] == ends_b[b])
    cuts = ends_a[a[ends]]
    return Alignment(a, b, shared, ends, np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b), len(cuts))


def shared_group_links(found: Alignment) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(token of A, token of B, 1) for all tokens of one group, in blocks."""
    return product(token_groups(found.group_a, found.n_groups), token_groups(found.group_b, found.n_groups).transpose())


def n_shared_group_links(found: Alignment) -> int:
    return int(np.bincount(found.group_a, minlength=found.n_groups) @ np.bincount(found.group_b, minlength=found.n_groups))


def byte_alphabet() -> dict[str, int]:
    """Characters of a byte-level vocabulary: visible Latin-1 characters are their own bytes, the other bytes follow from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def byte_level_tokens(vocabulary: dict) -> list[bytes]:
    """Bytes of each id of a tokenizer file; special tokens, which texts never give, have none."""
    alphabet = byte_alphabet()
    special = {t["id"] for t in vocabulary.get("added_tokens", [])}
    out = [b""] * (1 + max([*vocabulary["model"]["vocab"].values(), *special]))
    for token, i in vocabulary["model"]["vocab"].items():
        out[i] = b"" if i in special else bytes(alphabet[c] for c in token)
    return out


# A blank and what follows, up to a blank behind a character that is neither white space nor a marker.
_UNIT = re.compile(rf" (?:[^ ]+|(?<=[\s{pieces.MARK}]) )*(?: +\Z)?")
_BLANK_INSIDE = re.compile(rf"[\s{pieces.MARK}] ")
_SEPARATORS = re.compile("[\x1c-\x1f]")  # white space to Python alone


def units_of(text: str) -> list[str]:
    """Parts of a blank and the text at whose ends tokens of both sides end: neither side has tokens that reach from a
    character over a blank behind it (see ``sentencepiece.splits_at_blanks``; side A is cut there by its pattern)."""
    if _SEPARATORS.search(text):
        return [" " + text]
    if text[:1] == " " or text[-1:] == " " or _BLANK_INSIDE.search(text):
        return _UNIT.findall(" " + text)
    return [" " + w for w in text.split(" ")]


#: What is kept of a unit: its numbers and its linked id pairs as 64-bit integers, and its ids by group.
Unit = tuple[bytes, str, bytes]
_COUNTED = ("n_a", "n_b", "n_groups", "n_links", "n_overlaps", "n_shared")


class Prepared(NamedTuple):
    """What the tasks need of both tokenizers, made once: their files, the bytes of their tokens, whether units may be cut."""

    byte_level: str
    piece_model: bytes
    bytes: tuple[list[bytes], list[bytes]]
    by_unit: bool


def prepared(files: tuple[str, str]) -> Prepared:
    byte_level, piece_model = map(_read, files)
    vocabulary, model = json.loads(byte_level), pieces.parse(piece_model)
    cut_at_blanks = (vocabulary.get("pre_tokenizer") or {}).get("type") == "ByteLevel" and pieces.splits_at_blanks(model)
    return Prepared(byte_level.decode("utf-8"), piece_model, (byte_level_tokens(vocabulary), pieces.piece_bytes(model)), cut_at_blanks)


class Coder:
    """Both tokenizers in a Python worker."""

    def __init__(self, sent: Prepared) -> None:
        os.environ.setdefault("RAYON_NUM_THREADS", str(pieces.THREADS))
        import sentencepiece
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_str(sent.byte_level)
        self.first.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_proto=sent.piece_model)
        self.bytes, self.by_unit = sent.bytes, sent.by_unit
        self.memory = pieces.WordMemory(self.measure, units_of if self.by_unit else lambda text: [" " + text])
        self.sizes = tuple(np.array([len(t) for t in side], dtype=np.int64) for side in self.bytes)
        self.width = max(map(len, self.bytes))
        self.names = [f"{i}{mark}" for mark in ",|;" for i in range(self.width)]

    def _sides(self, texts: list[str]) -> list[tuple[list[int], list[int]] | None]:
        """Ids of both sides for texts that begin with a blank; None where they are not given back."""
        ids_a = [e.ids for e in self.first.encode_batch_fast(texts, add_special_tokens=False)]
        ids_b = self.second.encode([t[1:] for t in texts], num_threads=1)
        return [(a, b) if all(b"".join(map(side.__getitem__, ids)) == t.encode("utf-8") for side, ids in zip(self.bytes, (a, b))) else None
                for t, a, b in zip(texts, ids_a, ids_b)]

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of both sides for each text, or none; each text is encoded by itself."""
        return [c and tuple(np.array(ids, dtype=np.int64) for ids in c) for c in self._sides([" " + t for t in texts])]

    def _parts(self, lines: list[list[str]]) -> Iterator[tuple[list[str], list[np.ndarray], list[np.ndarray]]]:
        """(units, ids of both sides, where each unit's ids end) of the lines; units that are not given back are left out."""
        again: list[list[str]] = []
        for line, coded in zip(lines, self._sides(["".join(line) for line in lines])):
            ids = coded and [np.array(c, dtype=np.int64) for c in coded]
            ends = ids and [pieces.stops(c, size, line) for c, size in zip(ids, self.sizes)]
            if ids and all(e is not None for e in ends):
                yield line, ids, ends
            elif len(line) > 1:
                again += [[u] for u in line]
        if again:
            yield from self._parts(again)

    def align(self, a: np.ndarray, b: np.ndarray) -> Alignment:
        return align(*(np.cumsum(size[ids]) for size, ids in zip(self.sizes, (a, b))))

    def measure(self, units: list[str]) -> list[Unit | None]:
        """One alignment of all units, one behind the other; what each unit has of it."""
        parts = list(self._parts(list(pieces.lines_of(units)) if self.by_unit else [[u] for u in units]))
        if not parts:
            return [None] * len(units)
        a, b = (np.concatenate([ids[side] for _, ids, _ in parts]) for side in (0, 1))
        before = [np.cumsum([0, *(len(ids[side]) for _, ids, _ in parts[:-1])]) for side in (0, 1)]
        last_a, last_b = (np.concatenate([ends[side] + n for (_, _, ends), n in zip(parts, before[side])]) for side in (0, 1))
        x = self.align(a, b)
        # A unit's last token ends a group; links are in the order of the groups, one for each.
        groups = np.concatenate([[0], x.group_a[last_a - 1] + 1])
        overlaps = np.searchsorted(x.a, np.concatenate([[0], last_a]))
        in_a, in_b = (np.bincount(g, minlength=x.n_groups) for g in (x.group_a, x.group_b))
        shared = np.concatenate([[0], np.cumsum(in_a * in_b)])[groups]
        first_a, first_b = np.concatenate([[0], last_a]), np.concatenate([[0], last_b])
        pairs = ((a[x.a[x.ends]] << 32) | b[x.b[x.ends]]).tobytes()
        place = np.concatenate([2 * x.group_a, 2 * x.group_b + 1])
        order = np.argsort(place, kind="stable")
        place, ids = place[order], np.concatenate([a, b])[order]
        mark = np.where(np.append(place[1:] != place[:-1], True), 1 + place % 2, 0)
        names = list(map(self.names.__getitem__, (mark * self.width + ids).tolist()))
        n_groups = np.diff(groups)
        numbers = np.stack([np.diff(first_a), np.diff(first_b), n_groups, n_groups, np.diff(overlaps), np.diff(shared)], axis=1).tobytes()
        at, g, wide = (first_a + first_b).tolist(), (8 * groups).tolist(), 8 * len(_COUNTED)
        out = {u: (numbers[k:k + wide], "".join(names[i:j])[:-1], pairs[m:n]) for u, k, i, j, m, n in zip(
            chain.from_iterable(line for line, _, _ in parts), range(0, len(numbers), wide), at, at[1:], g, g[1:])}
        return [out.get(u) for u in units]

    def digest(self, texts: list[str]) -> Iterator[tuple[list[int], str, np.ndarray, np.ndarray]]:
        """Numbers, digest of the groups, distinct linked id pairs (a << 32 | b) and how often each occurs."""
        known, split = self.memory(texts)
        for text, units in zip(texts, split):
            found = list(map(known.__getitem__, units)) if text else []
            if not found or None in found:
                yield [0] * len(_COUNTED), "", np.array([], np.int64), np.array([], np.int64)
                continue
            numbers, groups, pairs = zip(*found)
            distinct, times = np.unique(np.frombuffer(b"".join(pairs), np.int64), return_counts=True)
            total = np.frombuffer(b"".join(numbers), np.int64).reshape(-1, len(_COUNTED)).sum(axis=0).tolist()
            yield total, hashlib.sha256(";".join(groups).encode()).hexdigest(), distinct, times


def _read(path: str) -> bytes:
    with open(path, "rb") as f:  # a resource of the driver, sent to the executors
        data = f.read(pieces.MODEL_LIMIT + 1)
    if len(data) > pieces.MODEL_LIMIT:
        raise ValueError("the tokenizer file is too large to send")
    return data


def _send(spark: SparkSession, files: tuple[str, str]):
    return spark.sparkContext.broadcast(tuple(prepared(files)))


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole(F.col("text")).alias("text"))


def token_links(docs: DataFrame, files: tuple[str, str] = (BYTE_LEVEL_FILE, PIECE_FILE)) -> DataFrame:
    """One row per document: doc_id, a_ids, b_ids, overlaps (array of a, b, n_bytes, ends_together; a and b are token
    numbers), and the factors of the shared-group links, a_groups and b_groups."""
    prepare(docs.sparkSession)
    sent = _send(docs.sparkSession, files)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(Prepared(*sent.value))
        for batch in batches:
            out = []
            for texts in pieces._chunks(batch.column(1).to_pylist()):
                for text, ids in zip(texts, coder.encode(texts)):
                    a, b = ids if text and ids else (np.array([], np.int64),) * 2
                    x = coder.align(a, b)
                    together = np.isin(np.arange(len(x.a)), x.ends)
                    overlaps = [{"a": int(i), "b": int(j), "n_bytes": int(n), "ends_together": bool(t)}
                                for i, j, n, t in zip(x.a, x.b, x.shared, together)]
                    out.append((a.tolist(), b.tolist(), overlaps, x.group_a.tolist(), x.group_b.tolist()))
            ints = pa.list_(pa.int32())
            link = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("n_bytes", pa.int32()), ("ends_together", pa.bool_())]))
            kinds = (ints, ints, link, ints, ints)
            columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "a_ids", "b_ids", "overlaps", "a_groups", "b_groups"])

    ints = "array<int>"
    return _rows(docs).mapInArrow(run, f"doc_id long, a_ids {ints}, b_ids {ints}, overlaps array<struct<a:int, b:int, n_bytes:int, "
                                       f"ends_together:boolean>>, a_groups {ints}, b_groups {ints}")


def _digest(docs: DataFrame, files: tuple[str, str]) -> DataFrame:
    """One row per document: sizes, the digest of the groups, distinct linked id pairs (a << 32 | b) and how often each occurs."""
    sent = _send(docs.sparkSession, files)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(Prepared(*sent.value))
        for batch in batches:
            out, pairs, times = [], [], []
            for texts in pieces._chunks(batch.column(1).to_pylist()):
                for numbers, groups, distinct, n in coder.digest(texts):
                    out.append((*numbers, groups))
                    pairs.append(distinct)
                    times.append(n)
            kinds = [pa.int64()] * len(_COUNTED) + [pa.string()]
            columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds]
            ends = pa.array(np.concatenate([[0], np.cumsum([len(p) for p in pairs])]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(v) if v else np.array([], np.int64))) for v in (pairs, times)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, *lists],
                                             names=["doc_id", *_COUNTED, "groups_sha256", "pairs", "times"])

    numbers = ", ".join(f"{c} long" for c in _COUNTED)
    return _rows(docs).mapInArrow(run, f"doc_id long, {numbers}, groups_sha256 string, pairs array<long>, times array<long>")


def pair_counts(links: DataFrame) -> DataFrame:
    """(pair, count, best) of ``links`` (pair, times): end links of the corpus, and whether no pair of that B id has more."""
    counts = links.groupBy("pair").agg(F.sum("times").alias("count")).withColumn("b", F.col("pair").bitwiseAND(F.lit(_LOW)))
    counts = cut(counts, "pair-counts")
    highest = counts.groupBy("b").agg(F.max("count").alias("highest"))
    return cut(counts.join(highest, "b").select("pair", "count", (F.col("count") == F.col("highest")).alias("best")), "pairs")


def align_documents(docs: DataFrame, files: tuple[str, str] = (BYTE_LEVEL_FILE, PIECE_FILE)) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, and the numbers
    of overlap links and shared-group links, n_overlaps and n_shared."""
    prepare(docs.sparkSession)
    found = cut(_digest(docs, files).withColumn("row", F.monotonically_increasing_id()), "alignment")
    links = found.select("row", F.inline(F.arrays_zip("pairs", "times"))).toDF("row", "pair", "times")
    counts = pair_counts(links)
    size = counts.agg(F.count(F.lit(1)).alias("n"), F.sum("count").alias("total")).first()
    if size["n"] <= BROADCAST_PAIRS:
        joined = links.join(F.broadcast(counts), "pair")
    else:
        hot = F.col("count") > F.lit(size["total"] // HOT_SHARE)
        frequent = F.broadcast(counts.where(hot))  # fewer than HOT_SHARE rows
        joined = links.join(frequent, "pair").unionByName(
            links.join(frequent.select("pair"), "pair", "left_anti").join(counts.where(~hot), "pair"))
    sums = joined.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                                     F.sum(F.col("times") * F.col("count")).alias("count_sum"))
    zero = F.lit(0).cast("long")
    return found.join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256", "n_overlaps", "n_shared")
