import random

import pytest

from .conftest import LONG, ODD
from vaxmart.llm import chunk_dedup as cd


def plain_ends(data):
    """Boundaries byte by byte: a 32-bit gear hash that forgets a byte after WINDOW steps."""
    h, ends, last, start = 0, [], None, 0
    for i, b in enumerate(data, 1):
        h = ((h << 32 // cd.WINDOW) + int(cd._GEAR[b])) & 0xFFFFFFFF
        if h < (1 << 32) // cd.BETWEEN:
            if last is None and i >= 0 or last is not None and i - last >= cd.SMALLEST:
                ends.append(i)
            last = i
    ends = sorted({*ends, len(data)} - {0})
    out = []
    for e in ends:
        while e - start > cd.LONGEST:
            start += cd.LONGEST
            out.append(start)
        out.append(e)
        start = e
    return out


@pytest.mark.parametrize("seed", range(6))
def test_boundaries_byte_by_byte(seed):
    rng = random.Random(seed)
    data = bytes(rng.choice(b"abcdefgh \n" if seed % 2 else range(256)) for _ in range(5000)) + b"z" * 3000 * (seed // 4)
    assert cd.chunks(data)[0] == pytest.approx(plain_ends(data)) and len(plain_ends(data)) > 40


def test_boundaries_of_odd_texts():
    for t in ODD:
        data = (t or "").encode()
        ends = cd.chunks(data)[0]
        assert (ends[-1] if ends else 0) == len(data) and ends == sorted(set(ends))


def test_rows_without_or_with_shared_ids(spark, make_docs):
    texts = [LONG, LONG, "other words " * 30, LONG, None, "", LONG]
    rows = cd.dedup_chunks(make_docs(texts, ids=[5, 5, 5, None, None, 2, 9])).collect()
    assert len(rows) == len(texts)
    cut = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_bytes"], r["n_removed"] > 0) for r in rows)
    size = len(LONG.encode())
    assert [c for c in cut if c[1] == size] == [(-1, size, True), (5, size, False), (5, size, False), (9, size, True)]
