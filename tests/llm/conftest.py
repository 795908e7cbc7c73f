import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, lang_pred int, `key` string"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with two extra columns whose names clash with the operators' own."""
    def made(texts, ids=None, langs=None):
        ids = range(len(texts)) if ids is None else ids
        langs = [None] * len(texts) if langs is None else langs
        return spark.createDataFrame(
            [(i, t, lang, None, None if t is None else len(t), 7, "k") for i, t, lang in zip(ids, texts, langs)], SCHEMA)
    return made


LONG = " ".join(f"word{i} of a long text" for i in range(6000))
PASSAGE = " ".join(f"passage{i * 7919 % 10007}" for i in range(60))
#: Nulls, empty and blank texts, ties, repeated texts, a very long text, characters of several bytes.
ODD = [None, "", " \t\n", "a", "a", "A a A a A a", "é" * 150 + "日本語 " * 90, "x" * 5000, LONG, LONG + " tail",
       f"one {PASSAGE} two", f"three {PASSAGE} four", "12 345 !!", "Ti Ti Ti " * 100]
