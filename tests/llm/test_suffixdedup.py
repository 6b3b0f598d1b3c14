"""Operator 11: suffix sorting against plain comparison, the whole operator against a table of all strings."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from flowlens.llm import suffixdedup as sd

N = sd.LENGTH


def brute(texts):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + N] for d in data for i in range(len(d) - N + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), dtype=bool)
        for i in range(len(d) - N + 1):
            if seen[d[i : i + N]] > 1:
                gone[i : i + N] = True
        kept = bytes(np.frombuffer(d, dtype=np.uint8)[~gone])
        spans = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(d) else 0
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


def words(rng, n, kinds=400):
    return " ".join(f"w{rng.randrange(kinds)}é" if rng.random() < 0.1 else f"x{rng.randrange(kinds)}" for _ in range(n))


def edited(rng, text, n):
    for _ in range(n):
        i = rng.randrange(len(text))
        text = text[:i] + rng.choice(["", "Q", "zz"]) + text[i + 1 :]
    return text


def test_cover():
    assert (sd.SHIFT >= 0).all() and sd.SHIFT.max() < sd.PERIOD and len(sd.COVER) == 9


def test_equal_suffixes():
    rng = random.Random(1)
    base = words(rng, 300)
    parts = [base, edited(rng, base, 3), "ab" * 700, "a" * 900, edited(rng, base, 1)[5:], "ab" * 650]
    data = "".join(parts).encode()
    starts = np.arange(len(data) - N + 1)
    got = sd.equal_suffixes(np.frombuffer(data, dtype=np.uint8), starts)
    groups, want = {}, {}
    for s, c in zip(starts, got):
        groups.setdefault(c, set()).add(int(s))
        want.setdefault(data[s : s + N], set()).add(int(s))
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


@pytest.mark.parametrize("limit", [1 << 18, 1000])
def test_runs_cover_every_suffix(monkeypatch, limit):
    """Each suffix lies in one run, and equal suffixes have equal anchors at equal distances."""
    monkeypatch.setattr(sd, "SCAN_BYTES", limit)
    rng = random.Random(2)
    base = words(rng, 500)
    texts = [base, edited(rng, base, 4), "short", None, "", "abc" * 600, base[100:], "a" * 400, "a" * 399]
    seen, anchors = Counter(), {}
    for rows, at0, data, offs in sd._pieces(pa.array(texts)):
        row, at, lo, hi, name, _, _ = sd.runs(data, offs)
        for r, p, x, y, n in zip(row, at, lo, hi, name):
            for i in range(x, y + 1):
                seen[rows[r], i - offs[r] + at0[r]] += 1
                assert anchors.setdefault(bytes(data[i : i + N]), (n, p - i)) == (n, p - i)
    want = Counter((k, i) for k, t in enumerate(texts) for i in range(len((t or "").encode()) - N + 1))
    assert seen == want


def table(spark, texts, ids=None):
    rows = [(ids[k] if ids else k, t, "x", "y", 1) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, tid string, name string, spans int")


def check(spark, texts, ids=None):
    got = sd.strip_repeats(table(spark, texts, ids)).collect()
    ids = ids or list(range(len(texts)))
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted((tuple(r)[:5] + (bytes(r.kept),) for r in got), key=key) == sorted(((i, *b) for i, b in zip(ids, brute(texts))), key=key)


@pytest.mark.parametrize("most", [4096, 2])
def test_whole(spark, monkeypatch, most):
    """Exact and near copies, shared passages, periodic and long texts; with most = 2 every tie goes through all levels."""
    monkeypatch.setattr(sd, "BUCKET_RUNS", most)
    rng = random.Random(7)
    base, passage = words(rng, 600), words(rng, 120)
    texts = [words(rng, 200) + " " + passage + " " + words(rng, 100) for _ in range(4)]
    texts += [base, base, *(edited(rng, base, k) for k in (1, 1, 2, 5, 20))]
    texts += ["lorem " * 300, "a" * 1500, "ab" * 400 + "c", None, "", "tiny", "é" * 210, passage[:N], passage[:399]]
    texts += [words(rng, 100) + base[300:300 + N + 1] + "!" + words(rng, 100) + base[900:900 + N - 1]]
    check(spark, texts)


def test_nulls_and_repeated_rows(spark):
    rng = random.Random(9)
    a, b = words(rng, 150), words(rng, 150)
    check(spark, [a, a, b, "", None, a[50:] + b], [None, 3, 3, 3, None, 4])
    check(spark, [a, a, b + a, "z" * 500], [1, 1, 1, None])
    assert sd.strip_repeats(table(spark, [a]).limit(0)).count() == 0
    check(spark, [a])


def test_text_longer_than_a_scan(spark):
    rng = random.Random(11)
    long_ = words(rng, 70_000, 10**6)
    data = sd.strip_repeats(table(spark, [long_, words(rng, 100) + long_[262_100:262_600] + "#", "q" + long_[:1000]])).orderBy("doc_id").collect()
    assert len(long_.encode()) > sd.SCAN_BYTES
    assert [r.n_spans for r in data] == [2, 1, 1]
    assert data[2].n_removed == len(long_[:1000].encode()) and data[0].n_removed == sum(r.n_removed for r in data[1:])
