"""Language identification by compression.

One raw-content zstandard dictionary per language is cut from a bounded sample of labelled texts.  A text is
normalised (lower case, runs of anything but letters become one blank), cut into blocks, and each block is
compressed with every dictionary; the language whose dictionary gives the fewest bytes over all blocks wins.
The score is the relative margin to the runner-up, ``1 - best / second``.  A text with a narrow margin is encoded
again at a finer compression level, and rejected when the margin is still below ``min_margin``.

Cases: a null text, an empty one, or one without a letter gives ``und`` with score 0, rejected.  Equal sizes go to
the language that sorts first (score 0).  A null ``doc_id`` is hashed as the empty text for the hold-out split.
Without any labelled training row every text gives ``und``.  Repeated rows get repeated results; columns other than
``doc_id``, ``text`` and ``lang`` are never read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaxmart.llm.common import prepare

#: Bounds of the training sample: texts of a language, characters of each, languages, bytes of a dictionary.
SAMPLE_TEXTS, SAMPLE_CHARS, MAX_LANGUAGES, DICTIONARY_BYTES = 300, 2000, 512, 1 << 16
BLOCK_BYTES, LEVEL, MIN_MARGIN = 4096, 6, 0.01
#: Texts with a margin below this are encoded again at the finer level, and judged by that.
NARROW, FINE_LEVEL = 0.03, 13

_NOT_LETTERS = re.compile(r"[\W\d_]+")


def letters(text: str | None) -> bytes:
    """The text's words in lower case, one blank between them; empty if it has no letter."""
    kept = _NOT_LETTERS.sub(" ", (text or "").lower()).strip()
    return kept.encode("utf-8", "replace") if any(map(str.isalpha, kept)) else b""


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def train(docs: DataFrame) -> dict[str, bytes]:
    """Dictionaries by language, from rows outside the hold-out split with text and label.

    At most SAMPLE_TEXTS texts of a language, those with the smallest hash of ``doc_id``, and SAMPLE_CHARS
    characters of each are brought to the driver; more than MAX_LANGUAGES labels are refused.
    """
    rows = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    langs = [r["lang"] for r in rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect()]
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    by_hash = Window.partitionBy("lang").orderBy("h", "doc_id", "part")
    sample = (
        rows.select("lang", "doc_id", F.xxhash64("doc_id").alias("h"), F.substring("text", 1, SAMPLE_CHARS).alias("part"))
        .withColumn("rank", F.row_number().over(by_hash))
        .where(F.col("rank") <= SAMPLE_TEXTS)
        .select("lang", "rank", "part")
        .collect()
    )
    texts: dict[str, list[bytes]] = {}
    for r in sorted(sample, key=lambda r: (r["lang"], r["rank"])):
        kept = letters(r["part"])
        if kept and kept not in texts.setdefault(r["lang"], []):
            texts[r["lang"]].append(kept)
    return {lang: b" ".join(found)[:DICTIONARY_BYTES] for lang, found in texts.items() if found}


class Classifier:
    """Holds the compressors of one Python worker."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.langs = sorted(dictionaries)
        self.dictionaries = dictionaries
        self.compressors = {LEVEL: self._compressors(LEVEL)}

    def _compressors(self, level: int) -> list[zstandard.ZstdCompressor]:
        found = []
        for lang in self.langs:
            data = zstandard.ZstdCompressionDict(self.dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=level)
            found.append(zstandard.ZstdCompressor(
                level=level, dict_data=data, write_checksum=False, write_content_size=False, write_dict_id=False))
        return found

    def _judge(self, kept: bytes, level: int) -> tuple[str, float]:
        if level not in self.compressors:
            self.compressors[level] = self._compressors(level)
        blocks = [kept[i:i + BLOCK_BYTES] for i in range(0, len(kept), BLOCK_BYTES)]
        sizes = [sum(len(c.compress(b)) for b in blocks) for c in self.compressors[level]]
        order = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))
        return self.langs[order[0]], 1.0 - sizes[order[0]] / sizes[order[1]] if len(order) > 1 else 1.0

    def __call__(self, text: str | None) -> tuple[str, float]:
        kept = letters(text)
        if not kept or not self.langs:
            return "und", 0.0
        lang, score = self._judge(kept, LEVEL)
        return (lang, score) if score >= NARROW else self._judge(kept, FINE_LEVEL)


def predict(docs: DataFrame, dictionaries: dict[str, bytes], min_margin: float = MIN_MARGIN) -> DataFrame:
    """All columns of ``docs`` plus ``lang_pred``, ``score`` and ``accepted`` (which replace columns of these names)."""
    spark = docs.sparkSession
    prepare(spark)
    model = spark.sparkContext.broadcast(dictionaries)  # at most MAX_LANGUAGES * DICTIONARY_BYTES
    kept = docs.drop("lang_pred", "score", "accepted")
    at = [c.lower() for c in kept.columns].index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = Classifier(model.value)
        for batch in batches:
            found = [classify(x) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64()),
                 pa.array([x != "und" and s >= min_margin for x, s in found], pa.bool_())],
                names=[f"c{i}" for i in range(batch.num_columns)] + ["lang_pred", "score", "accepted"])

    # Positions instead of names inside the tasks: names may clash or differ in case only.
    renamed = kept.toDF(*[f"c{i}" for i in range(len(kept.columns))])
    fields = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(kept.schema.fields))
    out = renamed.mapInArrow(run, f"{fields}, lang_pred string, score double, accepted boolean")
    return out.toDF(*kept.columns, "lang_pred", "score", "accepted")
