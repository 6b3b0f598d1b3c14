"""Queries against brute force on the small tables."""

import math
import re
import zlib
from collections import Counter

import pytest

from flowlens.llm import queries as Q

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def test_language_held_out(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = [r for r in Q.op2(spark, SF).collect() if r.held_out and lang[r.doc_id]]
    assert rows and sum(r.lang_pred == lang[r.doc_id] for r in rows) >= 0.95 * len(rows)


def test_pii_base(spark, texts):
    kinds = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
             "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def luhn(d):
        return sum((2 * x - 9 if x > 4 else 2 * x) if i % 2 else x for i, x in enumerate(map(int, reversed(d)))) % 10 == 0

    for r in Q.op5(spark, SF).collect():
        want = Counter()
        for k, p in kinds.items():
            for m in re.finditer(p, texts[r.doc_id]):
                d = re.sub("[^0-9]", "", m.group())
                want[k] += {"email": True, "ip": all(int(x) < 256 for x in m.group().split(".")) if k == "ip" else 0,
                            "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[k]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(want[k] for k in kinds)


def test_quality_base(spark, texts):
    for r in Q.op8(spark, SF).collect():
        w = WORD.findall(texts[r.doc_id])
        runs = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        covered = {j for i in range(len(w) - 4) if runs[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
        lines = [x for x in texts[r.doc_id].split("\n") if WORD.search(x)]
        assert (r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(lines) - len(set(lines)), len(covered))


def test_scores_base_and_perplexity(spark, texts):
    words = {i: WORD.findall(lower(t)) + [None] for i, t in texts.items()}
    c = Counter(w for i, x in words.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in x)
    n, v = sum(c.values()), len(c)
    rows = Q.op9(spark, SF).collect()
    for r in rows:
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words[r.doc_id]), rel_tol=1e-9)
        assert r.train_tokens == n and r.n_known == sum(c[w] > 0 for w in words[r.doc_id])
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_mixing_meets_targets(spark):
    rows = Q.op3(spark, SF).collect()
    mass = {d: sum(r.n_tokens * r[f"p_{d}"] for r in rows) for d in ("clean", "low", "toxic")}
    got = {d: sum(r.rate * r.n_tokens * r[f"p_{d}"] for r in rows) for d in mass}
    for d, w in (("clean", 0.94), ("low", 0.05), ("toxic", 0.01)):
        goal = mass["clean"] / 0.94 * w
        assert abs(got[d] - goal) < 1e-3 * mass["clean"]
        assert math.isclose(rows[0][f"goal_{d}"], goal, rel_tol=1e-9) and math.isclose(rows[0][f"reached_{d}"], got[d], rel_tol=1e-6)
    assert all(r.rate >= 0 for r in rows)


def test_pipeline_runs(spark):
    rows = Q.pipeline(spark, SF)
    assert rows.count() > 0 and rows.where("not decodes").count() == 0
