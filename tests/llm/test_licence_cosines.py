import math
import random
from collections import Counter

import pytest

from .conftest import ODD
from vaxmart.llm import license_scan as ls

N = 5000


def frequencies(seed=2):
    rng = random.Random(seed)
    words = sorted({t for text in [*ls.TEMPLATES.values(), *(t for _, t in ls.TEXTS)] for t in ls.terms(text)})
    return {w: rng.choice([0, 1, 3, 40, 900, N]) for w in words}


def cosine(a, b, weight):
    x, y = (Counter(ls.terms(t)) for t in (a, b))
    dot = sum(n * y[t] * weight(t) ** 2 for t, n in x.items())
    norm = [math.sqrt(sum((n * weight(t)) ** 2 for t, n in c.items())) for c in (x, y)]
    return dot / (norm[0] * norm[1]) if all(norm) else 0.0


def weights(df, known=None):
    def weight(t):
        count = df.get(t, 0) if known is None or t in known else 0
        return math.log((1 + N) / (1 + count)) + 1
    return weight


def units():
    rng = random.Random(8)
    notices = list(ls.TEMPLATES.values())
    out = [*notices, *(t or "" for t in ODD[:9])]
    for _ in range(200):
        words = rng.choice(notices).split()
        for _ in range(rng.randrange(4)):
            words.insert(rng.randrange(len(words) + 1), rng.choice(["the", "software", "zzz", "License", "2024", "version"]))
        out.append(" ".join(words[rng.randrange(2):]))
    return out


def test_notices():
    df = frequencies()
    matcher = ls.Matcher(ls.TEMPLATES, df, N, ls.TEXTS)
    weight = weights(df, {t for text in ls.TEMPLATES.values() for t in ls.terms(text)})
    for unit in units():
        want = {name: cosine(unit, text, weight) for name, text in ls.TEMPLATES.items()}
        name, value = matcher.best(unit)
        assert value == pytest.approx(max(want.values()), abs=1e-9)
        assert name is None and value == 0 or want[name] == pytest.approx(value, abs=1e-9)


def test_whole_files_and_windows():
    df = frequencies(5)
    matcher = ls.Matcher(ls.TEMPLATES, df, N, ls.TEXTS)
    weight = weights(df)
    rng = random.Random(3)
    for name, text in ls.TEXTS:
        assert matcher.file(text)[2:] == (name, pytest.approx(1.0))
        lines = text.splitlines()
        changed = "\n".join(x for x in lines if rng.random() > 0.02)
        best = max(cosine(changed, t, weight) for _, t in ls.TEXTS)
        _, _, found, value = matcher.file(changed)
        assert value >= best - 1e-9 and (found is not None) == (value >= ls.THRESHOLD)
        around = [f"{w} other prose {w}" for w in ("alpha", "beta", "gamma")]
        header, value, _, _ = matcher.file("\n".join([*around, *lines, *around]))
        # Some run of lines has just the text's words: no window can be better than the text itself, none is worse.
        assert header == name and value == pytest.approx(1.0, abs=0.02)
