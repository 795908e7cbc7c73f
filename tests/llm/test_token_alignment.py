import hashlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import sentencepiece as library
from tokenizers import Tokenizer

from ..conftest import SF_SMALL
from .conftest import ODD
from vaxmart.llm import registry, token_alignment

EXTRA = ["a▁b", "<|endoftext|> <s> </s>", "  two  blanks ", "emoji 😀́ \x00 end", "tab\tand\nline", "a a a", "a a a", " "]


def side_tokens():
    """Encoders that give (id, bytes) lists, built apart from the operator."""
    first = Tokenizer.from_file(token_alignment.BYTE_LEVEL_FILE)
    first.encode_special_tokens = True
    second = library.SentencePieceProcessor(model_file=token_alignment.PIECE_FILE)
    alphabet, free = {}, 256
    for b in range(256):
        if chr(b).isprintable() and chr(b) not in " \xa0\xad" and not 127 <= b <= 160:
            alphabet[chr(b)] = b
        else:
            alphabet[chr(free)] = b
            free += 1

    def a(text):
        e = first.encode(" " + text, add_special_tokens=False)
        return [(i, bytes(alphabet[c] for c in t)) for i, t in zip(e.ids, e.tokens)]

    def b(text):
        ids = second.encode(text)
        return [(i, bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode()) for i, p in zip(ids, map(second.id_to_piece, ids))]

    return a, b


def ends(tokens):
    out, at = [], 0
    for _, t in tokens:
        at += len(t)
        out.append(at)
    return out


def brute(texts):
    a, b = side_tokens()
    docs, counts = [], Counter()
    for text in texts:
        x, y = (a(text), b(text)) if text else ([], [])
        if any(b"".join(t for _, t in side) != (" " + text).encode() for side in (x, y) if text):
            x = y = []
        ex, ey = ends(x), ends(y)
        at = {e: k for k, e in enumerate(ey)}
        links = [(x[i][0], y[at[e]][0]) for i, e in enumerate(ex) if e in at]
        cuts = sorted(set(ex) & set(ey))
        groups, i, j = [], 0, 0
        for c in cuts:
            m, n = ex.index(c, i) + 1, ey.index(c, j) + 1
            groups.append("|".join(",".join(str(t) for t, _ in side) for side in (x[i:m], y[j:n])))
            i, j = m, n
        docs.append((x, y, cuts, links, ";".join(groups)))
        counts.update(links)
    best = {}
    for (_, j), n in counts.items():
        best[j] = max(best.get(j, 0), n)
    return [(len(x), len(y), len(cuts), len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links),
             hashlib.sha256(text.encode()).hexdigest() if x else "") for x, y, cuts, links, text in docs]


@pytest.mark.parametrize("limit", [token_alignment.BROADCAST_PAIRS, 0])
def test_brute_force(spark, make_docs, monkeypatch, limit):
    monkeypatch.setattr(token_alignment, "BROADCAST_PAIRS", limit)
    monkeypatch.setattr(token_alignment, "BLOCK", 997)
    texts = ODD + EXTRA
    rows = sorted(token_alignment.align_documents(make_docs(texts)).collect(), key=lambda r: r["doc_id"])
    want = brute(texts)
    assert len(rows) == len(texts)
    for r, w in zip(rows, want):
        got = (r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"])
        assert got == w
    assert rows[0]["groups_sha256"] == rows[texts.index("a▁b")]["groups_sha256"] == ""
    assert token_alignment.align_documents(make_docs([])).count() == 0
    assert token_alignment.align_documents(make_docs([None, ""], ids=[None, None])).count() == 2


def test_small_table(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF_SMALL}/documents.parquet' ORDER BY doc_id").fetchall()
    rows = {r["doc_id"]: r for r in registry.QUERIES["op12_token_alignment"](spark, SF_SMALL).collect()}
    for (i, _), w in zip(docs, brute([t for _, t in docs])):
        r = rows[i]
        assert (r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"]) == w


def test_products_against_dense_matrices():
    rng = np.random.default_rng(2)
    for _ in range(60):
        n = int(rng.integers(1, 40))
        x, y = (np.append(np.unique(rng.integers(1, n + 1, 9)), n) for _ in range(2))
        x, y = np.unique(x), np.unique(y)
        found = token_alignment.align(x, y)
        dense = [np.array([[b <= k < e for k in range(n)] for b, e in zip([0, *s], s)], dtype=int) for s in (x, y)]
        overlap = dense[0] @ dense[1].T
        got = np.zeros_like(overlap)
        got[found.a, found.b] = found.shared
        assert (got == overlap).all()
        a, b, one = token_alignment.gather(token_alignment.shared_group_links(found))
        same = found.group_a[:, None] == found.group_b[None, :]
        assert set(zip(a, b)) == set(zip(*np.nonzero(same))) and (one == 1).all()
        assert token_alignment.n_shared_group_links(found) == same.sum() and found.n_groups == len(set(x) & set(y))
    left = token_alignment.Csr(np.array([0, 3, 3, 5]), np.array([2, 0, 1, 1, 1]), 3)
    right = token_alignment.Csr(np.array([0, 2, 3, 5]), np.array([1, 0, 1, 1, 0]), 2)
    assert [c.tolist() for c in token_alignment.gather(token_alignment.product(left, right))] == [[0, 0, 2], [0, 1, 1], [2, 3, 2]]


def test_links_of_documents(spark, make_docs):
    a, b = side_tokens()
    text = "Überlappung naïve 日本"
    r = token_alignment.token_links(make_docs([text, None])).where("doc_id = 0").first()
    x, y = a(text), b(text)
    assert list(r["a_ids"]) == [i for i, _ in x] and list(r["b_ids"]) == [i for i, _ in y]
    spans = [[set(range(e - len(t), e)) for (_, t), e in zip(side, ends(side))] for side in (x, y)]
    want = {(i, j, len(p & q), max(p) == max(q)) for i, p in enumerate(spans[0]) for j, q in enumerate(spans[1]) if p & q}
    assert {tuple(o) for o in r["overlaps"]} == want
