"""Operator 12: transducer and hash table against plain Python, the audit against a document-by-document replay."""

import re
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest

from flowlens.llm import filteraudit as fa
from flowlens.llm import textbytes as tb

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [
    "", " \t\n", "one", "One two two TWO # Ω 😀 é", "a b " * 150, "x" * 70000 + " " + "x" * 69999 + "y", "word\x0bword\x0cword",
    " ".join(f"w{i}" for i in range(250)), "AB CD | e", " ".join(f"w{i}" for i in range(250)), "ééé éé ééé", "12345678 123456789 12345678",
    "\x85\xa0  x", None,
]


def plain(text):
    text = text or ""
    w = WORD.findall(text)
    return [len(w), len(set(w)), len(re.findall("[A-Z]", text)), len(text), len(re.findall(r"[#$%&*|]", text))]


def letters(text):
    w, d, c, p, s = plain(text)
    return {x for x, bad in zip("ABCD", (w < 200, 100 * d < 50 * w, 100 * c > 3 * p, s > 0)) if bad}


@pytest.mark.parametrize("limit", [1, 64, 1 << 20])
def test_transducer(limit):
    got = []
    for _, _, data, offs in tb.blocks(pa.array(TEXTS), limit):
        got += np.array(fa._measure(data, offs)).T.tolist()
    assert got == [plain(t) for t in TEXTS]


def test_hash_collisions_are_verified():
    """With one hash for every span the table still tells the words apart."""
    data = np.frombuffer(b"aa bb aa ab bb ba aa abcdefghi abcdefghj", dtype=np.uint8)
    offs = np.array([0, len(data)])
    _, starts, ends = fa.transduce(data, offs)
    row = np.zeros(len(starts), dtype=np.int64)
    first = fa.first_occurrences(data, starts, ends, row, np.zeros(len(starts), dtype=np.uint64))
    assert first.tolist() == [True, True, False, True, False, True, False, True, True]


def replay(docs, labels):
    lowest = {}
    for i, t, _ in docs:
        if i is not None:
            lowest[t or ""] = min(i, lowest.get(t or "", i))
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    fails = [(p or "", i, letters(t) | ({"E"} if i is not None and i > lowest[t or ""] else set())) for i, t, p in docs]
    out, share = {}, Counter()
    for order in map("".join, permutations("ABCDE")):
        for part in {p for p, _, _ in fails}:
            left = [(i, f) for p, i, f in fails if p == part]
            mine = list(left)
            for step, x in enumerate(order, 1):
                gone = [(i, f) for i, f in left if x in f]
                kept = [(i, f) for i, f in left if x not in f]
                out[part, order, step] = [
                    len(kept), len(gone), sum(x in f for _, f in mine) - len(gone), sum(f == {x} for _, f in mine),
                    sum(i in good and i is not None for i, _ in gone), sum(i in toxic and i is not None for i, _ in gone)]
                share[part, x] += len(gone)
                left = kept
    return {k: v + [share[k[0], k[1][k[2] - 1]]] for k, v in out.items()}


def test_audit(spark):
    base = [(i, t, p) for i, (t, p) in enumerate(zip(TEXTS, ["en", "de", None, "en", "en", "de", "", "en", "en", "de", "en", "fr", "en", "en"]))]
    docs = base + [(20, TEXTS[4], "de"), (4, TEXTS[4], "en"), (4, TEXTS[4], "en"), (None, TEXTS[4], "en"), (None, "lonely", "en"),
                   (2, "other text", "en"), (21, "", "fr"), (-5, TEXTS[7], "de")]
    labels = [(0, 1, 0), (4, 1, 1), (4, 0, 0), (8, None, 1), (9, 0, None), (None, 1, 1), (99, 1, 1)]
    d = spark.createDataFrame([(*x, "c", "d", 1) for x in docs], "doc_id bigint, text string, lang string, step string, fails string, n int")
    y = spark.createDataFrame([(*x, "z") for x in labels], "doc_id bigint, quality int, toxic int, text string")
    got = {(r.part, r.filter_order, r.step): list(r)[3:] for r in fa.audit_filters(d, y).collect()}
    assert got == replay(docs, labels)
    assert fa.audit_filters(d.limit(0), y).count() == 0
    assert fa.audit_filters(d, y.limit(0)).where("good_lost + toxic_lost > 0").count() == 0
