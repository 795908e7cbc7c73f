"""Encoding and decoding with a SentencePiece model on the tokenizers library.

The model file is read as protobuf fields; from its pieces, scores and normaliser settings an equal tokenizer is built:
the metaspace marker for blanks and the dummy prefix as normaliser, a unigram model from the scores or a byte-pair
model whose merges are ranked by them, and bytes as fallback.  Batches are encoded by the library's threads.  Parity
with the sentencepiece library is verified on every document.

Where no piece has the marker behind another character, no merge and no piece reaches over the blank in front of a
word, so a text's ids are those of its words one after the other.  Then each distinct word of a task is encoded, decoded
and verified once, many new ones as one text, and texts are put together from them.  Models with such pieces, or whose
normaliser squeezes blanks or maps characters, are run on whole texts.

Cases: a null text is empty; an empty text has no tokens and decodes to itself.  A text that holds the metaspace
character itself decodes to blanks there (round_trip is false).  Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaxmart.llm.common import prepare, whole

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
MODEL_LIMIT = 64 << 20  # bytes of a model file sent to all executors
CHUNK_CHARS = 1 << 19  # characters handed to the library's threads at once
THREADS = 2  # of the library in one Python worker, unless RAYON_NUM_THREADS is set
MARK = "▁"
# Fixed values of the format: kinds of pieces, and model types.
_NORMAL, _UNKNOWN, _CONTROL, _USER, _BYTE = 1, 2, 3, 4, 6
_UNIGRAM, _BPE = 1, 2


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protobuf message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            size, at = _varint(data, at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = data[at:at + size], at + size
        yield key >> 3, value


def parse(data: bytes) -> dict:
    """Pieces (text, score, kind), model type, and the normaliser's settings."""
    model = {"pieces": [], "type": _UNIGRAM, "prefix": True, "squeeze": True, "charsmap": b""}
    for number, value in fields(data):
        if number == 1:
            piece = dict(fields(value))
            score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
            model["pieces"].append((piece[1].decode("utf-8"), score, piece.get(3, _NORMAL)))
        elif number == 2:
            model["type"] = dict(fields(value)).get(3, _UNIGRAM)
        elif number == 3:
            spec = dict(fields(value))
            model |= {"charsmap": spec.get(2, b""), "prefix": bool(spec.get(3, 1)), "squeeze": bool(spec.get(4, 1))}
    return model


def build(data: bytes):
    """A tokenizers.Tokenizer that encodes as the model does."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    model = parse(data)
    pieces = model["pieces"]
    unknown = next((i for i, p in enumerate(pieces) if p[2] == _UNKNOWN), None)
    has_bytes = any(kind == _BYTE for _, _, kind in pieces)
    if model["type"] == _UNIGRAM:
        core = models.Unigram([(text, score) for text, score, _ in pieces], unk_id=unknown, byte_fallback=has_bytes)
    elif model["type"] == _BPE:
        vocab = {text: i for i, (text, _, _) in enumerate(pieces)}
        plain = {text: score for text, score, kind in pieces if kind in (_NORMAL, _USER)}
        # Any two pieces whose concatenation is a piece may merge; the better score goes first.
        merges = [(-score, i, text[:k], text[k:]) for i, (text, score) in enumerate(plain.items())
                  for k in range(1, len(text)) if text[:k] in plain and text[k:] in plain]
        core = models.BPE(vocab, [(a, b) for _, _, a, b in sorted(merges)], unk_token=pieces[unknown][0] if unknown is not None else None,
                          fuse_unk=True, byte_fallback=has_bytes)
    else:
        raise ValueError(f"model type {model['type']} is not supported")
    out = Tokenizer(core)
    steps = [normalizers.Precompiled(model["charsmap"])] if model["charsmap"] else []
    if model["squeeze"]:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Replace(Regex("^ | $"), "")]
    steps += [normalizers.Prepend(MARK)] if model["prefix"] else []
    out.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARK)])
    strip = [decoders.Strip(" ", 1, 0)] if model["prefix"] else []
    out.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *strip])
    return out


def _chunks(texts: list[str]) -> Iterator[list[str]]:
    held, size = [], 0
    for t in texts:
        if held and size + len(t) > CHUNK_CHARS:
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t)
    if held:
        yield held


# A word with the blanks and markers in front of it, the last one with those behind it too.
_WORD = re.compile(rf"[ {MARK}]+[^ {MARK}]*(?:[ {MARK}]+\Z)?")
WORDS_KEPT, WORD_CHARS = 1 << 17, 48  # words remembered by a task, and the longest of them
LINE_CHARS = 1 << 14  # new words encoded as one text


def splits_at_blanks(model: dict) -> bool:
    """Whether texts may be encoded word by word."""
    inner = re.compile(f"[^{MARK}]{MARK}")
    return (model["prefix"] and not model["squeeze"] and not model["charsmap"]
            and not any(kind in (_NORMAL, _USER) and inner.search(text) for text, _, kind in model["pieces"]))


def piece_bytes(model: dict) -> list[bytes]:
    """Bytes of each piece: the marker is a blank, <0xHH> the byte HH."""
    return [bytes([int(text[3:5], 16)]) if kind == _BYTE else text.replace(MARK, " ").encode("utf-8") for text, _, kind in model["pieces"]]


def words_of(text: str) -> list[str]:
    """The words, each with the blanks in front of it; the text has one blank more in front."""
    if "  " in text or MARK in text or text[:1] == " " or text[-1:] == " ":
        return _WORD.findall(" " + text)
    return [" " + w for w in text.split(" ")]


def lines_of(words: list[str]) -> Iterator[list[str]]:
    """Words whose ids are those of their concatenation, some at a time; the others (blanks at the end, markers) one by one."""
    line, size = [], 0
    for w in words:
        if MARK in w or w[-1:] == " ":
            yield [w]
            continue
        if size + len(w) > LINE_CHARS and line:
            yield line
            line, size = [], 0
        line.append(w)
        size += len(w)
    if line:
        yield line


def stops(ids: list[int], sizes: np.ndarray, words: list[str]) -> np.ndarray | None:
    """Where each word's ids end in those of their concatenation; None if an id reaches over an end."""
    ends = np.cumsum(sizes[np.array(ids, dtype=np.int64)])
    want = np.cumsum([len(w.encode("utf-8")) for w in words])
    at = np.searchsorted(ends, want)
    return at + 1 if len(ends) and ends[-1] == want[-1] and (ends[at] == want).all() else None


class WordMemory:
    """Results of a function of lists of words, made once for each distinct word while it is remembered."""

    def __init__(self, make, split=words_of) -> None:
        self.make, self.split, self.known = make, split, {}
        self.long: list[str] = []

    def __call__(self, texts: list[str]) -> tuple[dict, list[list[str]]]:
        """The results by word, and the words of each text."""
        for w in self.long:  # used once, not remembered
            del self.known[w]
        split = [self.split(t) for t in texts]
        new = set().union(*split).difference(self.known)
        if len(self.known) + len(new) > WORDS_KEPT:
            self.known, new = {}, set().union(*split)
        words = list(new)
        if words:
            self.known.update(zip(words, self.make(words)))
        self.long = [w for w in words if len(w) > WORD_CHARS]
        return self.known, split


def encode(docs: DataFrame, model_file: str = MODEL_FILE) -> DataFrame:
    """One row per row of ``docs``: doc_id, token_ids, n_tokens, ids_sha256 (of little-endian 32-bit ids),
    decoded_sha256, round_trip (the decoded text is the text), parity (sentencepiece gives the same ids)."""
    spark = docs.sparkSession
    prepare(spark)
    with open(model_file, "rb") as f:  # a resource of the driver, sent to the executors
        data = f.read(MODEL_LIMIT + 1)
    if len(data) > MODEL_LIMIT:
        raise ValueError("the model file is too large to send")
    model = parse(data)
    # What the tasks need, made once: the tokenizer in the library's own form, the model, and the bytes of each piece.
    sent = spark.sparkContext.broadcast(
        (build(data).to_str(), data, [len(p) for p in piece_bytes(model)], splits_at_blanks(model)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
        import sentencepiece
        from tokenizers import Tokenizer

        written, data, lengths, by_word = sent.value
        tokenizer = Tokenizer.from_str(written)
        other = sentencepiece.SentencePieceProcessor(model_proto=data)
        sizes = np.array(lengths, dtype=np.int64)
        odd: dict[str, tuple[str, bool]] = {}  # decoded text and parity of the words that are not given back or differ

        def both(texts: list[str]) -> list[tuple[list[int], str, bool]]:
            """Ids, decoded text and parity."""
            encoded = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            decoded = tokenizer.decode_batch(encoded, skip_special_tokens=False)
            expected = other.encode(texts, num_threads=1)
            return [(own, plain, own == want) for own, want, plain in zip(encoded, expected, decoded)]

        def ids_of_words(words: list[str]) -> list[bytes]:
            lines = list(lines_of(words))
            found: dict[str, bytes] = {}
            for line, (own, plain, same) in zip(lines, both(["".join(line)[1:] for line in lines])):
                at = stops(own, sizes, line) if same and plain == "".join(line)[1:] else None
                if at is not None:
                    flat = np.array(own, dtype=np.int32).tobytes()
                    found.update((w, flat[4 * i:4 * j]) for w, i, j in zip(line, [0, *at.tolist()], at.tolist()))
                    continue
                for w, (ids, text, equal) in zip(line, both([w[1:] for w in line])):
                    found[w] = np.array(ids, dtype=np.int32).tobytes()
                    if " " + text != w or not equal:
                        odd[w] = text, equal
            return [found[w] for w in words]

        memory = WordMemory(ids_of_words) if by_word else None

        def texts_encoded(texts: list[str]) -> Iterator[tuple[bytes, str, bool]]:
            """Ids as 32-bit numbers, decoded text and parity."""
            if memory is None:
                for own, plain, same in both(texts):
                    yield np.array(own, dtype=np.int32).tobytes(), plain, same
                return
            known, split = memory(texts)
            for text, words in zip(texts, split):
                if not text:
                    yield b"", "", True
                elif odd and not odd.keys().isdisjoint(words):
                    seen = [odd.get(w, (w[1:], True)) for w in words]
                    yield b"".join(map(known.__getitem__, words)), " ".join([x for x, _ in seen]), all([x for _, x in seen])
                else:
                    yield b"".join(map(known.__getitem__, words)), text, True

        for batch in batches:
            ids, out = [], []
            for texts in _chunks(batch.column(1).to_pylist()):
                for text, (own, plain, same) in zip(texts, texts_encoded(texts)):
                    ids.append(np.frombuffer(own, dtype=np.int32))
                    out.append((len(own) // 4, hashlib.sha256(own).hexdigest(),
                                hashlib.sha256(plain.encode("utf-8")).hexdigest(), plain == text, same))
            kinds = (pa.int32(), pa.string(), pa.string(), pa.bool_(), pa.bool_())
            columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32())), *columns],
                names=["doc_id", "token_ids", "n_tokens", "ids_sha256", "decoded_sha256", "round_trip", "parity"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole(F.col("text")).alias("text")).mapInArrow(
        run, "doc_id long, token_ids array<int>, n_tokens int, ids_sha256 string, decoded_sha256 string, round_trip boolean, parity boolean")
