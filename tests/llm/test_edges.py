"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

from flowlens.llm import hpylm, langid, mixing, partenum, pii, pstable, quality, subword, urlrules, warc

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, cls string, rule string"


@pytest.fixture(scope="module")
def docs(spark):
    base = "the quick brown fox jumps over the lazy dog and then runs far away from here"
    rows = [
        (1, base, "en", "s", 1, "x", "y"),
        (1, base, "en", "s", 1, "x", "y"),
        (2, base + " again", "en", None, None, None, None),
        (3, None, None, None, None, None, None),
        (4, "", "en", "s", 0, "x", "y"),
        (None, "mail me at a.b@c.org or +1 (555) 010-0199 now", "en", "s", 1, "x", "y"),
        (5, "word " * 20000, "en", "s", 1, "x", "y"),
        (6, "a" * 30000 + " 10.0.0.1 300.1.1.1 card 4111 1111 1111 1111", "de", "s", 1, "x", "y"),
        (7, " \t\n ▁ \U0001d11e é", "fr", "s", 1, "x", "y"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 0), (6, 1, 1), (None, 1, 0), (99, None, None)], "doc_id bigint, quality int, toxic int")


def runs(docs, labels):
    return {
        "quality": lambda d: quality.quality_verdicts(d, labels),
        "filter": lambda d: quality.filter_quality(d, labels),
        "langid": langid.identify,
        "mixing": lambda d: mixing.mixing_rates(d, labels),
        "partenum": partenum.jaccard_classes,
        "pii": pii.find_spans,
        "redact": pii.redact,
        "hpylm": hpylm.score_documents,
        "subword": lambda d: subword.sample_segmentations(d, MODEL),
    }


@pytest.mark.parametrize("name", ["quality", "langid", "mixing", "partenum", "pii", "redact", "hpylm"])
def test_a_row_per_document(docs, labels, name):
    assert runs(docs, labels)[name](docs).count() == docs.count()


@pytest.mark.parametrize("name", ["quality", "filter", "langid", "mixing", "partenum", "pii", "redact", "hpylm", "subword"])
def test_empty_table(docs, labels, name):
    assert runs(docs, labels)[name](docs.limit(0)).count() == 0


def test_quality(docs, labels):
    r = {x.doc_id: x for x in quality.quality_verdicts(docs, labels).collect()}
    assert r[3].n_words == 0 and r[3].base_failed and not r[3].kept
    assert r[5].n_repeat_words == 20000 and r[5].base_failed
    assert quality.filter_quality(docs, labels).columns == docs.columns
    # the exact bound: 0 of n false rejections certify alpha only when (1 - alpha)^n <= level
    assert quality.pick_cutoffs([("en", "upper", len(quality.GRID), 2000, 0), ("en", "upper", 3, 0, 50)])
    assert not quality.pick_cutoffs([("en", "upper", len(quality.GRID), 200, 0), ("en", "upper", 3, 0, 50)])


def test_quality_joint_risk():
    # each score's cutoff rejects other good documents, 0.6 % each: 3 % of the stratum by any of the five
    n, last = 10_000, len(quality.GRID)
    hist = [x for s in quality.SCORES for x in (("en", s, last, n - 60, 0), ("en", s, 0, 60, 50))]
    assert not quality.pick_cutoffs(hist)
    hist = [x for s in quality.SCORES for x in (("en", s, last, n - 5, 0), ("en", s, 0, 5, 50))]
    assert len(quality.pick_cutoffs(hist)) == 5


def test_langid(docs):
    r = {x.doc_id: x for x in langid.identify(docs).collect()}
    assert r[3].lang_pred == "und" and r[4].lang_pred == "und" and 0 <= r[5].score <= 1


def test_partenum(docs):
    r = [tuple(x) for x in partenum.jaccard_classes(docs, 3, 80, 100).collect()]
    by = {x[0]: x for x in r}
    assert by[1][2] == 1 and by[2][2] == 1 and by[3][1:] == (0, 3) and by[5][1] == 1
    kept = partenum.keep_one(docs, 3, 80, 100)
    assert kept.columns == docs.columns
    assert sorted(x.doc_id or 0 for x in kept.collect()) == [0, 1, 3, 4, 5, 6, 7]


def test_pii(docs):
    r = {x.doc_id: x for x in pii.find_spans(docs).select("doc_id", pii.spans_text(F.col("base")).alias("b")).collect()}
    assert r[None].b == "email:11:20,phone:24:41"
    assert r[6].b == "ip:30001:30009,card:30025:30044"
    assert r[3].b == ""
    out = {x.doc_id: x.text for x in pii.redact(docs).collect()}
    assert out[None] == "mail me at <email> or <phone> now" and out[3] is None and out[4] == ""


def test_mixing_keeps_columns(docs, labels):
    assert mixing.mix(docs, labels).columns == docs.columns


def test_mixing_scarce_domain(spark):
    # two low and one toxic document of 400: far less than 5 % and 1 % of the mix
    def word(i):
        return "bad" if i in (7, 8) else "vile" if i == 9 else "fine"

    docs = spark.createDataFrame([(i, f"{word(i)} {word(i)} text {i % 5}") for i in range(400)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(word(i) != "bad"), int(word(i) == "vile")) for i in range(400)], "doc_id bigint, quality int, toxic int")
    rows = mixing.mixing_rates(docs, labels).collect()
    mass = {d: sum(r.n_tokens * r[f"p_{d}"] for r in rows) for d in mixing.DOMAINS}
    got = {d: sum(r.rate * r.n_tokens * r[f"p_{d}"] for r in rows) for d in mass}
    for d, w in mixing.TARGETS.items():
        assert abs(got[d] - mass["clean"] / 0.94 * w) < 0.002 * mass["clean"]
    assert max(r.copies for r in rows) > 1
    totals = {r.domain: r for r in mixing.mixing_totals(docs, labels).collect()}
    assert all(abs(totals[d].reached - got[d]) < 1e-6 * mass["clean"] and abs(totals[d].own - mass[d]) < 1e-6 * mass["clean"] for d in got)
    # repeats bounded: a smaller mix of the same weights
    members = spark.createDataFrame([(r.n_tokens, [r.p_clean, r.p_low, r.p_toxic]) for r in rows], "_p3_n bigint, _p3_p array<double>")
    r = mixing.fit_rates(members, max_epochs=1.0)
    assert all(r.goal[d] <= 1.0001 * r.own[d] for d in r.goal) and abs(r.goal["low"] / sum(r.goal.values()) - 0.05) < 1e-9


def test_scores(docs):
    r = {x.doc_id: x for x in hpylm.score_documents(docs).collect()}
    assert r[3].n_tokens == 1 and r[5].n_tokens == 20001 and r[5].score > r[5].base_score


def test_subword(docs):
    rows = subword.sample_segmentations(docs, MODEL, k=3).collect()
    assert all(x.decodes and x.log_inclusion <= 0 for x in rows)
    for doc in {x.doc_id for x in rows} - {1}:
        own = [x for x in rows if x.doc_id == doc]
        assert len({tuple(x.ids) for x in own}) == len(own)
        assert [x.perturbed for x in own] == sorted((x.perturbed for x in own), reverse=True)
    assert [len(x.ids) for x in rows if x.doc_id == 3] == [0]
    # a row's samples do not depend on its neighbours
    alone = subword.sample_segmentations(docs.where("doc_id = 7"), MODEL, k=3).collect()
    assert sorted(tuple(x.ids) for x in alone) == sorted(tuple(x.ids) for x in rows if x.doc_id == 7)
    text = {x.doc_id: x.text for x in docs.collect()}
    df = subword.decode(subword.sample_segmentations(docs, MODEL), MODEL)
    assert all(x.decoded == (text[x.doc_id] or "") for x in df.collect())


def test_warc(spark):
    pages = spark.createDataFrame(
        [(1, "http://a.b/\n", "x" * 5000), (2, None, "x" * 5000), (3, "u", None), (4, "u", "short"), (5, "u", "short"), (None, "u", "x" * 5000),
         (6, "u", "\r\n\r\nWARC/1.1\r\n0\r\n\r\n" * 300)], "page_id bigint, url string, html string")
    r = {x.page_id: x for x in warc.archive_round_trip(pages, 700).collect()}
    assert len(r) == 7 and all(x.ok for x in r.values())
    assert r[2].refers_to == 1 and r[2].payload_bytes == 5000 and r[None].record_type == "response"
    assert r[3].payload_bytes == 0 and r[4].record_type == r[5].record_type == "response"
    assert warc.archive_round_trip(pages.limit(0)).count() == 0
    assert warc.dechunk(b"3\r\nabc\r\n0\r\n\r\n") == (b"abc", True) and not warc.dechunk(b"5\r\nabc")[1]


def test_urls(spark):
    urls = spark.createDataFrame([(1, "http://a.com/x"), (2, None), (3, "no scheme"), (4, "https://b.A.com/p/q?z"), (5, "x://com")], "page_id bigint, url string")
    rules = spark.createDataFrame([("com", "/", "allow"), ("a.com", "/p/", "block"), (None, "/", "block")], "host string, path string, action string")
    r = {x.page_id: x for x in urlrules.match_rules(urls, rules).collect()}
    assert r[1].rule == "com/" and r[4].rule == "a.com/p/" and r[4].verdict == "block"
    assert r[2].host == "" and r[3].rule is None and r[5].rule is None
    assert urlrules.match_rules(urls, rules.limit(0)).where("rule is not null").count() == 0


def test_vectors(spark):
    v = [1.0, 0.0, 0.5]
    rows = [(1, v, 0), (2, v, 1), (2, [2.0, 0.0, 1.0], 1), (3, None, 0), (4, [0.0] * 3, 0), (5, [1.0, None, 0.0], 0), (6, [float("nan")] * 3, 0), (7, [1.0, 0.0], 0)]
    r = pstable.near_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")).collect()
    by = {}
    for x in r:
        by.setdefault(x.vec_id, []).append((x.n_links, x.component_id, x.kept))
    assert by[1] == [(2, 1, True)] and by[2] == [(2, 1, False)] * 2
    assert all(by[i] == [(0, i, True)] for i in (3, 4, 5, 6, 7))
