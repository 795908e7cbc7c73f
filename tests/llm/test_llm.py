import hashlib
import math
import random
import textwrap
from collections import Counter

import duckdb
import numpy as np
import pytest

from ..conftest import SF_SMALL
from .conftest import LONG, ODD, PASSAGE
from tools.compare import duck, normalise
from vaxmart.llm import (chunk_dedup, ctph, decontaminate, language_id, license_scan, lm_score, near_dup, registry, sentencepiece,
                         shingles, suffix_array, suffix_dedup, url_filter, whitening)


def documents(sf=SF_SMALL):
    return duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet' ORDER BY doc_id").fetchall()


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_oracle(spark, name):
    got = registry.QUERIES[name](spark, SF_SMALL).toArrow()
    want = duck(SF_SMALL).sql(registry.ORACLE[name]).to_arrow_table()
    assert {f.name: str(f.type) for f in got.schema} == {f.name: str(f.type) for f in want.schema}
    assert normalise(got.to_pandas()) == normalise(want.to_pandas())


@pytest.mark.parametrize("name", [f for f in sorted(registry.QUERIES)])
def test_whole_table_or_pairs(spark, name):
    rows = registry.QUERIES[name](spark, SF_SMALL)
    if name == "op2_decontaminate":
        assert rows.count() > 0
        return
    pages = ("page_id", "pages")
    key, table = {"op6_url_filter": pages, "op13_html_extraction": pages, "op11_whitening": ("vec_id", "embeddings")}.get(
        name, ("doc_id", "documents"))
    n = duckdb.sql(f"SELECT count(*) FROM '{SF_SMALL}/{table}.parquet'").fetchall()[0][0]
    each = whitening.COMPONENTS if name == "op11_whitening" else 1
    assert rows.count() == each * n and rows.select(key).distinct().count() == n


# --- 1: language identification ---------------------------------------------


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = registry.QUERIES["op1_language_id"](spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 150 and sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_odd(spark, make_docs):
    langs = ["en", "en", None, "en", "de", "en", "fr", None, "en", "de", "fr", "de", "fr", "fr"]
    docs = make_docs(ODD, langs=langs)
    model = language_id.train(docs)
    out = {r["doc_id"]: r for r in language_id.predict(docs, model).collect()}
    assert len(out) == len(ODD)
    for i in (0, 1, 2, 12):
        assert (out[i]["lang_pred"], out[i]["score"], out[i]["accepted"]) == ("und", 0.0, False)
    assert out[3]["lang_pred"] == out[4]["lang_pred"] in model
    empty = docs.where("false")
    assert language_id.predict(empty, language_id.train(empty)).count() == 0
    assert {r["lang_pred"] for r in language_id.predict(docs, {}).collect()} == {"und"}


# --- 2: decontamination -----------------------------------------------------


def test_templates_and_slots(spark, make_docs):
    item = "The train from Boston leaves at 9 and covers 300 km before it meets Alice near the old stone bridge with 9 bags"
    other = item.replace("Boston", "Denver").replace("9", "7").replace("300 km", "450 miles").replace("Alice", "Robert")
    mixed = item.replace("at 9", "at 8")  # the item's own 9 stands at its end: only the windows over the 8 are dropped
    moved = item.replace("near the old stone bridge", "beside a new iron gate")
    docs = make_docs([f"intro. {item}. end", f"word, {other} and so on", f"So {mixed}", "nothing of the kind " * 9, None, "", item[:40], moved])
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "!!"), (5, "short item text")], "item_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate.contaminated(docs, bench).collect()}
    assert set(got) == {0, 1, 2}
    assert got[0]["n_changed"] == 0 and got[1]["n_changed"] == 5 and got[2]["n_windows"] < got[2]["n_item_windows"]
    left = decontaminate.clean(docs, bench)
    assert left.columns == docs.columns and {r["doc_id"] for r in left.collect()} == {3, 4, 5, 6, 7}
    assert decontaminate.contaminated(docs, bench.where("false")).count() == 0
    assert decontaminate.contaminated(docs.where("false"), bench).count() == 0


def test_short_items_and_repeated_rows(spark, make_docs):
    bench = spark.createDataFrame([(5, "quite short item"), (5, "quite short item")], "item_id long, text string")
    docs = make_docs(["a quite short item b", "a quite short item b", "quite a short item", "quite short item"], ids=[1, 1, 2, None])
    assert sorted((r["doc_id"] or -1, r["coverage"]) for r in decontaminate.contaminated(docs, bench).collect()) == [(-1, 1.0), (1, 1.0)]


def found_items(spark, make_docs, texts, items):
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(make_docs(texts), bench).collect()}


def test_one_clashing_slot_drops_only_its_windows(spark, make_docs):
    item = "The train from Boston leaves at 9 and covers 300 km before it meets Alice near the old stone bridge with 9 bags"
    sums = "A shop near the river sells 3 green apples to every child and later it also sells 5 yellow pears to them again"
    texts = [f"so. {item.replace('at 9', 'at 8')}", f"so. {item.replace('at 9', 'at 7').replace('9 bags', '6 bags')}",
             sums.replace("3", "4").replace("5", "4"), sums.replace("3", "5").replace("5", "3")]
    assert found_items(spark, make_docs, texts, [item, sums]) == {(0, 0), (1, 0), (2, 1), (3, 1)}


def test_short_items_inside_documents(spark, make_docs):
    items = ["What is the largest ocean?", "What is the capital of France?", "What is 12 + 34?", "Compute 12 + 34."]
    other = ["What is 12 + 35?", "He said Pacific is the largest ocean", "Please Compute 34 + 12."]
    texts = [f"Question: {x} And more" for x in items] + [f"so {x}" for x in items] + other
    assert found_items(spark, make_docs, texts, items) == {(i + k, i) for i in range(4) for k in (0, 4)}


def test_values_of_another_width(spark, make_docs):
    item = "A baker sells 40 loaves at 3 dollars each and pays Alice 25 dollars for help in the shop of New York every single day"
    other = item.replace("40", "1,200").replace("at 3", "at 3.50").replace("Alice", "Mary Ann").replace("New York", "Boston")
    assert found_items(spark, make_docs, [f"so. {other}", f"so. {item}"], [item]) == {(0, 0), (1, 0)}


PROBLEMS = [
    ("Tom has 3 boxes of red pens. Tom gives 2 pens to Ann. Tom then buys 5 more boxes. How many pens does Tom have now?",
     {"Tom": "Bob", "Ann": "Sue", " 3 ": " 4 ", " 2 ": " 7 ", " 5 ": " 9 "}),
    ("Janet sells 16 fresh duck eggs every day at the market. Janet eats 3 for breakfast. How much does Janet make each week?",
     {"Janet": "Maria", "16": "24", " 3 ": " 5 "}),
    ("A tank holds 12kg of salt and 30kg of sand. How many kg of salt must be added to reach 1/2 of the total mass?",
     {"12kg": "14kg", "30kg": "50kg", "1/2": "1/3"}),
    ("John is nine years old and his sister is three times older than him. How old will John be in five years from now?",
     {"John": "Peter", "nine": "seven", "three": "four", "five": "six"}),
]


def test_word_problems_with_other_names_and_values(spark, make_docs):
    def changed(text, changes):
        for a, b in changes.items():
            text = text.replace(a, b)
        return text

    items = [t for t, _ in PROBLEMS]
    n = len(items)
    texts = [f"so it goes. {changed(*p)}" for p in PROBLEMS] + [f"so it goes. {t} the end" for t in items] + [
        " ".join(reversed(t.split())) for t in items] + ["What is now the total mass of the salt in a tank that holds so many kg of sand?"]
    assert found_items(spark, make_docs, texts, items) == {(i, i % n) for i in range(2 * n)}


def test_fixed_words_and_shared_beginnings(spark, make_docs):
    items = [f"Which of the following statements about the {x} is true for every member of the group of {y}?" for x, y in
             (("whale", "mammals"), ("shark", "fishes"), ("eagle", "birds"))] + ["What is the largest ocean?"]
    texts = [f"a. {t}" for t in items] + ["Pacific is the largest ocean", "what is the largest ocean", "Paris: What is the largest ocean"]
    got = found_items(spark, make_docs, texts, items)
    assert {(i, i) for i in range(4)} | {(5, 3), (6, 3)} <= got and not any(i == 4 for i, _ in got)


# --- 3: near duplicates -----------------------------------------------------


def brute_components(rows):
    sets = [(i, shingles.shingle_set(shingles.words(t), 5)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, s) in enumerate(sets):
        for j, t in sets[k + 1:]:
            both = len(s & t)
            if both and 100 * both >= 75 * len(s | t):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(s), root(i)) for i, s in sets}


def near_copies(n, seed=5):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(160)]
    texts = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(0, 9)):
            w[rng.randrange(len(w))] = f"v{rng.randrange(10 ** 9)}"
        texts.append(" ".join(w))
    return texts


@pytest.mark.parametrize("leaf", [near_dup.LEAF, 24])
def test_near_duplicates_brute_force(spark, make_docs, monkeypatch, leaf):
    monkeypatch.setattr(near_dup, "LEAF", leaf)
    texts = ODD + near_copies(90) + [t.upper() for t in near_copies(3)]
    want = brute_components(list(enumerate(texts)))
    got = {r["doc_id"]: r for r in near_dup.near_duplicates(make_docs(texts)).collect()}
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_near_duplicates_ids(spark, make_docs):
    docs = make_docs(["a b c d e f", "a b c d e f", "a b c d e f", "", "zz"], ids=[4, None, 4, None, 9])
    got = sorted(str(tuple(r)) for r in near_dup.near_duplicates(docs).select("doc_id", "component_id", "kept").collect())
    assert got == sorted(["(4, 4, True)", "(4, 4, True)", "(None, 4, False)", "(None, None, True)", "(9, 9, True)"])
    assert near_dup.near_duplicates(docs.where("false")).count() == 0


# --- 4: suffix arrays -------------------------------------------------------


def test_suffix_array_and_common_prefixes():
    rng = random.Random(3)
    for _ in range(150):
        s = [rng.randint(1, rng.choice([1, 2, 8])) for _ in range(rng.randint(1, 60))] + [0]
        x = np.array(s, dtype=np.uint16)
        sa = suffix_array.suffix_array(x)
        assert sa.tolist() == sorted(range(len(s)), key=lambda i: s[i:])
        before, lcp = suffix_array.permuted_lcp(x, sa)
        for r in range(1, len(s)):
            i, j = int(sa[r]), int(sa[r - 1])
            n = next(k for k in range(len(s) + 1) if max(i, j) + k == len(s) or s[i + k] != s[j + k])
            assert before[i] == j and lcp[i] == n


def brute_spans(texts):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + 200] for d in data for i in range(len(d) - 199))
    out = []
    for d in data:
        runs = suffix_dedup.removed([{"s": i, "e": i + 1} for i in range(len(d) - 199) if seen[d[i:i + 200]] > 1], len(d))
        out.append((len(d), sum(b - a for a, b in runs), len(runs), hashlib.sha256(suffix_dedup.kept_bytes(d, runs)).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 1])
def test_suffix_dedup_brute_force(spark, make_docs, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rng = random.Random(8)
    common = "".join(rng.choice("abcd ") for _ in range(260))
    texts = ODD + near_copies(12) + [f"{rng.random()}{common[k:k + 205]}{rng.random()}" for k in range(20)]
    got = sorted((r["doc_id"], *r[1:]) for r in suffix_dedup.dedup_report(make_docs(texts)).collect())
    assert [g[1:] for g in got] == brute_spans(texts)


def test_suffix_dedup_small_table_and_texts(spark, make_docs):
    rows = [t for _, t in documents()]
    got = sorted(tuple(r) for r in registry.QUERIES["op4_suffix_dedup"](spark, SF_SMALL).collect())
    assert [g[1:] for g in got] == brute_spans(rows)
    docs = make_docs(["é" * 120 + "x", "y" + "é" * 120, None, "é" * 120 + "x"], ids=[1, 2, None, 1])
    out = suffix_dedup.dedup_texts(docs)
    assert out.columns == docs.columns and out.count() == 4
    assert {(r["doc_id"], r["text"]) for r in out.collect()} == {(1, ""), (2, "y"), (None, None)}
    assert suffix_dedup.dedup_texts(docs.where("false")).count() == 0


# --- 5: sentencepiece -------------------------------------------------------


def test_sentencepiece_parity_and_round_trip(spark, make_docs):
    extra = ["  two  blanks ", " lead", "tab\tand\nline", "emoji 😀 \u0301 \x00 end", "<s> </s> <unk>", "a" * 3000, " " * 40 + "x"]
    rows = sentencepiece.encode(make_docs(ODD + extra)).collect()
    assert len(rows) == len(ODD + extra) and all(r["parity"] and r["round_trip"] for r in rows)
    assert rows[0]["n_tokens"] == rows[1]["n_tokens"] == 0
    import sentencepiece as library
    whole = library.SentencePieceProcessor(model_file=sentencepiece.MODEL_FILE)
    ends = ["a ", "a  ", " ", "  ", "a \n", "▁ ▁a ", "a ▁", "\n \n"]
    for texts in (ODD + extra, ends):
        found = sorted(sentencepiece.encode(make_docs(texts)).collect(), key=lambda r: r["doc_id"])
        assert [list(r["token_ids"]) for r in found] == [whole.encode(t or "") for t in texts]
    assert all(r["parity"] for r in sentencepiece.encode(spark.read.parquet(f"{SF_SMALL}/documents.parquet")).collect())
    assert sentencepiece.encode(make_docs([])).count() == 0 and not sentencepiece.encode(make_docs(["a▁b"])).first()["round_trip"]


def test_words_only_where_no_piece_crosses_a_blank():
    model = {"pieces": [("▁a", -1.0, 1), ("▁▁", -1.0, 1)], "prefix": True, "squeeze": False, "charsmap": b""}
    assert sentencepiece.splits_at_blanks(model)
    assert not sentencepiece.splits_at_blanks(model | {"pieces": [("a▁b", -1.0, 1)]})
    assert not any(sentencepiece.splits_at_blanks(model | change) for change in ({"prefix": False}, {"squeeze": True}, {"charsmap": b"x"}))
    made = []
    memory = sentencepiece.WordMemory(lambda words: made.extend(words) or [w.upper() for w in words])
    for _ in range(2):
        known, split = memory(["ab cd ab", "x" * 60])
        assert [[known[w] for w in ws] for ws in split] == [[" AB", " CD", " AB"], [" " + "X" * 60]]
    assert sorted(made) == sorted([" ab", " cd", " " + "x" * 60, " " + "x" * 60])


def test_unigram_model_is_rebuilt():
    def message(number, data):
        return bytes([number << 3 | 2, len(data)]) + data

    import struct
    pieces = [("<unk>", 0.0, 2), ("▁ab", -1.0, 1), ("▁", -3.0, 1), ("a", -2.0, 1), ("b", -2.5, 1), ("abb", -9.0, 1)]
    data = b"".join(message(1, message(1, t.encode()) + b"\x15" + struct.pack("<f", s) + bytes([0x18, k])) for t, s, k in pieces)
    data += message(2, b"\x18\x01") + message(3, b"\x18\x01\x20\x00\x28\x01")
    import sentencepiece as library
    other = library.SentencePieceProcessor(model_proto=data)
    mine = sentencepiece.build(data)
    for text in ("ab", "abb ab", "a b", "bab", ""):
        assert mine.encode(text, add_special_tokens=False).ids == other.encode(text)


# --- 6: URL filter ----------------------------------------------------------


def test_urls(spark):
    urls = {"http://A.Net/x": ("a.net", "/x", "net/", "block"), "http://net": ("net", "", None, "allow"),
            "https://w.EXAMPLE.net/en/1?q#f": ("w.example.net", "/en/1", "example.net/en/", "allow"),
            "http://example.com/de/": ("example.com", "/de/", "example.com/de/", "block"),
            "http://badexample.com/de/": ("badexample.com", "/de/", None, "allow"),
            "http://x.org/fr/a": ("x.org", "/fr/a", "org/fr/", "allow"), "http://x.org/FR/a": ("x.org", "/FR/a", None, "allow"),
            "no scheme.net/": ("", "", None, "allow"), "": ("", "", None, "allow"), None: ("", "", None, "allow"),
            "a://b.net?x=/": ("b.net", "", None, "allow"), "a://b.net\n/": ("b.net\n", "/", None, "allow"),
            "http:///only": ("", "/only", None, "allow"), "http://u@b.net:80/": ("u@b.net:80", "/", None, "allow")}
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate([*urls, *urls])], "page_id long, url string, rule string")
    got = {r["page_id"]: tuple(r)[1:5] for r in url_filter.judge(pages, url_filter.RULES).collect()}
    assert [got[i] for i in sorted(got)] == [*urls.values()] * 2
    assert url_filter.judge(pages.where("false"), url_filter.RULES).count() == 0


def test_only_fetched_rules_run(spark):
    rules = [*url_filter.RULES, url_filter.Rule("any", "block", "zzz", ()), url_filter.host_rule("block", "rare.net", "/pre")]
    pages = spark.createDataFrame([(1, "http://a.net/q"), (2, "http://rare.net/prefix"), (3, "http://b.io/zzz")], "page_id long, url string")
    got = {r["page_id"]: (r["rule"], r["n_tried"]) for r in url_filter.judge(pages, rules).collect()}
    assert got == {1: ("net/", 2), 2: ("rare.net/pre", 3), 3: ("any", 1)}


# --- 7: licences ------------------------------------------------------------


def test_licences(spark):
    mit, gpl = license_scan.TEMPLATES["MIT"], license_scan.TEMPLATES["GPL-3.0"]
    files = [("a/LICENSE", mit), ("a/b/x.py", "plain text"), ("a/b/c/y.py", "more text"), ("a/b/c/z.py", f"first\n{gpl}\nlast line"),
             ("other/q.py", "text"), ("a/b/c/LICENSE", "Licensed under CC BY 4.0"), (None, "text"), ("n.py", None), ("e.py", ""), ("ab/x", "text")]
    rows = spark.createDataFrame([(i, p, t) for i, (p, t) in enumerate(files)] * 2, "doc_id long, path string, text string")
    got = {r["path"]: (r["licence"], r["how"]) for r in license_scan.scan(rows).collect()}
    assert got == {"a/LICENSE": ("MIT", "file"), "a/b/x.py": ("MIT", "inherited"), "a/b/c/y.py": ("CC-BY-4.0", "inherited"),
                   "a/b/c/z.py": ("GPL-3.0", "header"), "other/q.py": (None, None), "a/b/c/LICENSE": ("CC-BY-4.0", "file"),
                   None: (None, None), "n.py": (None, None), "e.py": (None, None), "ab/x": (None, None)}
    assert license_scan.scan(rows.where("false")).count() == 0


def test_licence_lines_are_found(spark):
    want = {i for i, t in documents("/root/testdata/sf0.01") if any(x in license_scan.TEMPLATES.values() for x in t.splitlines())}
    rows = registry.QUERIES["op7_license_scan"](spark, "/root/testdata/sf0.01").where("how <> 'inherited'").collect()
    assert want and want <= {r["doc_id"] for r in rows} and all(r["cosine"] >= license_scan.THRESHOLD for r in rows)


def test_real_headers_and_licence_files(spark):
    text = {}
    for name, t in license_scan.TEXTS:
        text.setdefault(name, []).append(t)
    prose = "\n".join(f"word{i} other{i} more{i}" for i in range(200))
    wrapped = {n: textwrap.fill(license_scan.TEMPLATES[n], 40, initial_indent="# ", subsequent_indent="# ") for n in ("MPL-2.0", "BSD-3-Clause")}
    header = "\n".join(" * " + x for x in next(t for t in text["GPL-3.0"] if len(t) < 2000).splitlines())
    files = [("a", f"{prose}\n{wrapped['MPL-2.0']}\n{prose}", "MPL-2.0", "header"),
             ("b", f"{wrapped['BSD-3-Clause']}\n{prose}", "BSD-3-Clause", "header"),
             ("c", f"/* tool\n{header}\n */\n{prose}", "GPL-3.0", "header"),
             ("d/LICENSE", "MIT License\n\nCopyright (c) 2024 Some Body\n\n" + text["MIT"][0], "MIT", "file"), ("d/x.py", prose, "MIT", "inherited"),
             *((f"{n}/COPYING", max(t, key=len), n, "file") for n, t in text.items()), ("z/x.py", prose, None, None)]
    rows = spark.createDataFrame([(i, p, t) for i, (p, t, _, _) in enumerate(files)], "doc_id long, path string, text string")
    got = {r["path"]: (r["licence"], r["how"]) for r in license_scan.scan(rows).collect()}
    assert got == {p: (n, how) for p, _, n, how in files}


# --- 8: stupid backoff ------------------------------------------------------


def brute_scores(texts, order=2):
    docs = [shingles.words(t) for t in texts]
    grams = [[Counter(zip(*(w[i:] for i in range(k)))) for k in range(1, order + 1)] for w in docs]
    total = [sum((g[k] for g in grams), Counter()) for k in range(order)]
    n = sum(map(len, docs))
    out = []
    for w, own in zip(docs, grams):
        rest = lambda gram: total[len(gram) - 1][gram] - own[len(gram) - 1][gram]
        score = 0.0
        for i, x in enumerate(w):
            c = rest((x,))
            p = c / (n - len(w)) if c else 1 / (n - len(w) + 1)
            for k in range(2, min(order, i + 1) + 1):
                gram = tuple(w[i - k + 1:i + 1])
                c = rest(gram)
                p = c / rest(gram[:-1]) if c else lm_score.ALPHA * p
            score += math.log(p)
        out.append((len(w), score if w else None))
    return out


@pytest.mark.parametrize("order", [2, 3])
def test_scores_brute_force(spark, make_docs, monkeypatch, order):
    monkeypatch.setattr(lm_score, "ORDER", order)
    monkeypatch.setattr(lm_score, "BATCH_BYTES", 100_000)
    monkeypatch.setattr(lm_score, "BUCKET_BYTES", 50_000)
    texts = ODD + [t for _, t in documents()]
    got = [(r["n_words"], r["log_score"]) for r in sorted(lm_score.score_documents(make_docs(texts)).collect(), key=lambda r: r["doc_id"])]
    for (n, s), (m, t) in zip(got, brute_scores(texts, order), strict=True):
        assert n == m and (s is None) == (t is None) and (s is None or math.isclose(s, t, rel_tol=1e-9))
    assert lm_score.score_documents(make_docs([])).count() == 0


# --- 9: content-defined chunks ----------------------------------------------


def test_chunks_resist_insertions_and_cover():
    data = "".join(random.Random(1).choice("abcdefgh ") for _ in range(20000)).encode()
    a, b = (set(chunk_dedup.chunks(x)[1]) for x in (data, data[:7000] + b"inserted" + data[7000:]))
    assert len(a - b) <= 3 and chunk_dedup.chunks(data)[0][-1] == len(data) and chunk_dedup.chunks(b"") == ([], [])
    ends = chunk_dedup.chunks(b"z" * 9000)[0]
    assert max(np.diff([0, *ends])) <= chunk_dedup.LONGEST


def test_chunk_dedup_brute_force(spark, make_docs):
    texts = ODD + [t for _, t in documents()]
    owner = {}
    parts = [chunk_dedup.chunks((t or "").encode()) for t in texts]
    for i, (_, ds) in enumerate(parts):
        for d in ds:
            owner.setdefault(d, i)
    got = {r["doc_id"]: r for r in chunk_dedup.dedup_chunks(make_docs(texts)).collect()}
    for i, (t, (ends, ds)) in enumerate(zip(texts, parts)):
        data = (t or "").encode()
        n, runs = chunk_dedup.repeated_runs(ends, ds, {d for d in ds if owner[d] < i})
        edges = [0, *(x for r in runs for x in r), len(data)]
        kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
        assert (got[i]["n_bytes"], got[i]["n_repeated"], got[i]["n_removed"], got[i]["kept_sha256"]) == (
            len(data), n, len(data) - len(kept), hashlib.sha256(kept).hexdigest())
    assert got[ODD.index(f"three {PASSAGE} four")]["n_removed"] > 300 and got[9]["n_removed"] > len(LONG) - 200
    null_ids = chunk_dedup.dedup_chunks(make_docs([LONG, LONG, None], ids=[None, 3, None])).collect()
    assert sorted(r["n_removed"] > 0 for r in null_ids) == [False, False, True]


def test_passages_of_51_words_are_cut(spark, make_docs):
    """Passages of running text of sf0.1, each put into two other documents."""
    texts = [t for _, t in documents("/root/testdata/sf0.1") if len(t.split()) > 300][:600]
    rng = random.Random(4)
    pairs, passages = [], []
    for _ in range(200):
        a, b, c = (t.split() for t in rng.sample(texts, 3))
        at = rng.randrange(len(c) - 51)
        passages.append(" ".join(c[at:at + 51]).encode())
        pairs.append([" ".join([*t[:k], *c[at:at + 51], *t[k:]]).encode() for t, k in ((a, rng.randrange(300)), (b, rng.randrange(300)))])
    caught = cut = 0
    for (x, y), p in zip(pairs, passages):
        begin, end = y.find(p), y.find(p) + len(p)
        _, runs = chunk_dedup.repeated_runs(*chunk_dedup.chunks(y), set(chunk_dedup.chunks(x)[1]))
        n = sum(max(0, min(b, end) - max(a, begin)) for a, b in runs)
        caught, cut = caught + (n > 0), cut + n
    print("51 words: caught", caught / len(pairs), "bytes cut", cut / sum(map(len, passages)))
    assert caught >= 0.98 * len(pairs) and cut >= 0.7 * sum(map(len, passages))


# --- 10: piecewise hashes ---------------------------------------------------


def test_fingerprints_brute_force(spark, make_docs):
    texts = ODD + [t for _, t in documents()]
    got = {r["doc_id"]: r for r in ctph.fingerprints(make_docs(texts), part_bytes=200_000).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        t, after = t or "", texts[(i + 1) % len(texts)] or ""
        edited = ctph.edit(t, after)
        f, g, h = (ctph.fingerprint(x.encode()) for x in (t, edited, after))
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (f, g)
        assert (r["near_edited"], r["near_next"]) == (ctph.likeness(f, g), ctph.likeness(f, h))


def test_likeness():
    rng = random.Random(2)
    for _ in range(200):
        x, y = ("".join(rng.choice("abc") for _ in range(rng.randrange(20))) for _ in range(2))
        assert ctph.indel(x, y) == len(x) + len(y) - 2 * _lcs(x, y)
    data = "".join(rng.choice("abcdefghij ") for _ in range(6000))
    f, g = (ctph.fingerprint(t.encode()) for t in (data, data[:3000] + "new words" + data[3000:]))
    assert ctph.likeness(f, f) == 1.0 and ctph.likeness(f, g) > 0.9
    assert ctph.likeness(ctph.fingerprint(b""), ctph.fingerprint(b"")) == 1.0


def _lcs(x, y):
    table = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i, a in enumerate(x):
        for j, b in enumerate(y):
            table[i + 1][j + 1] = table[i][j] + 1 if a == b else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_fingerprints_of_one_and_no_document(spark, make_docs):
    assert ctph.fingerprints(make_docs([])).count() == 0
    one = ctph.fingerprints(make_docs(["abcd"])).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and one["near_next"] == 1.0
    assert ctph.fingerprints(make_docs(["x", "x", "y"], ids=[1, 1, None])).count() == 3


# --- pipeline ---------------------------------------------------------------


def test_pipeline_brute_force(spark, make_docs):
    """Each stage against a plain version of itself on the rows that its predecessor kept."""
    import corpus_pipeline as p

    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = docs.columns
    held = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in p.STAGES:
        out = stage(spark, docs, sf)
        if name == "sentencepiece":
            import sentencepiece as library
            encode = library.SentencePieceProcessor(model_file=sentencepiece.MODEL_FILE).encode
            assert {r["doc_id"]: list(r["token_ids"]) for r in out.collect()} == {i: encode(t) for i, t in held.items()}
            break
        assert out.columns == names
        docs = out.cache()
        got = {r["doc_id"]: r["text"] for r in docs.collect()}
        if name == "language_id":
            assert set(got) < set(held) and len(got) > 0.95 * len(held)
        elif name == "near_dup":
            want = brute_components(sorted(held.items()))
            assert set(got) == {i for i, (_, c) in want.items() if i == c}
        elif name == "suffix_dedup":
            keys = sorted(held)
            want = brute_spans([held[i] for i in keys])
            assert set(got) == set(held)
            assert all((got[i] == held[i]) == (w[1] == 0) and len(got[i].encode()) <= w[0] - w[1] for i, w in zip(keys, want))
        elif name == "decontaminate":
            bench = [t for _, t in duckdb.sql(f"SELECT item_id, text FROM '{sf}/benchmark.parquet'").fetchall()]
            assert not any(b in t for t in got.values() for b in bench) and len(got) > 0.9 * len(held)
        held = got
