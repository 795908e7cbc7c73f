import importlib

import pytest

from ..conftest import SF_SMALL
from .conftest import LONG

pipeline = importlib.import_module("corpus_pipeline")

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, accepted string, lang_pred int, "
          "`key` string, id int, label string, node string, `__gone` int")
WORDS = "the of and to in is that for it was on are with as his they be at one have this".split()


def prose(seed, n=120):
    return " ".join(WORDS[(seed * 31 + k * k * 7 + k * seed) % len(WORDS)] + ("" if k % 3 else str(seed * n + k)) for k in range(n))


@pytest.fixture(scope="module")
def made(spark):
    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), 77.0, "yes", 5, "k", 1, "l", "n", 3) for i, t in rows], SCHEMA)
    return make


def pairs(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


def test_one_row_of_every_repeated_document(spark, made):
    one, two = prose(1), prose(2)
    docs = made([(1, one), (1, one), (2, two), (None, two), (None, two)])
    kept = pipeline.keep_one_of_each_group(spark, docs, SF_SMALL)
    assert kept.columns == docs.columns and pairs(kept) == sorted([(1, one), (2, two)], key=str)
    assert pairs(pipeline.cut_repeated_strings(spark, kept, SF_SMALL)) == pairs(kept)


def test_ids_that_are_null_or_shared(spark, made):
    a, b, c = prose(3), prose(4), prose(5)
    got = pairs(pipeline.keep_one_of_each_group(spark, made([(None, a), (None, a + " tail"), (7, b), (7, c), (7, c), (9, b), (None, None), (8, "")]), SF_SMALL))
    assert len([1 for _, t in got if t in (a, a + " tail")]) == 1
    assert (9, b) in got and (7, c) in got and (7, b) not in got and (8, "") in got and (None, None) in got and len(got) == 5
    top = (1 << 63) - 1  # no room for further ids behind it
    got = pairs(pipeline.keep_one_of_each_group(spark, made([(top, a), (None, a), (None, b)]), SF_SMALL))
    assert sorted(t for _, t in got) == sorted([a, b])


@pytest.mark.parametrize("name,stage", pipeline.STAGES[:-1])
def test_columns_of_any_name_stay(spark, made, name, stage):
    docs = made([(1, prose(6)), (2, None), (3, ""), (4, prose(7)), (None, prose(8)), (5, LONG), (5, "é" * 300)])
    out = stage(spark, docs, SF_SMALL)
    assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    rows = out.collect()
    assert rows and all((r["score"], r["accepted"], r["lang_pred"], r["key"], r["id"], r["label"], r["__gone"]) == (77.0, "yes", 5, "k", 1, "l", 3)
                        for r in rows)
    empty = stage(spark, docs.where("false"), SF_SMALL)
    assert empty.columns == docs.columns and empty.count() == 0
    fewer = docs.select("doc_id", "text", "lang")
    assert stage(spark, fewer, SF_SMALL).columns == fewer.columns


def test_encoding_of_odd_rows(spark, made):
    rows = pipeline.encode_texts(spark, made([(None, None), (1, ""), (1, "a"), (1, "a")]), SF_SMALL).collect()
    assert sorted(len(r["token_ids"]) for r in rows) == [0, 0, 1, 1]
    assert pipeline.encode_texts(spark, made([]), SF_SMALL).count() == 0
