"""Operator 3: mixing to target weights with soft domain membership, in DataFrame functions only.

The labelled table gives each labelled document a domain (``toxic``, else ``low`` quality, else
``clean``). A logistic regression with L1 penalty on hashed word presence, fitted on at most about
``FIT_ROWS`` labelled documents (chosen by a hash of the id), gives every document posteriors p
over the domains.

Rates r >= 0 of the documents are then fitted so that the expected tokens of each domain,
S_d = sum r n p_d, match the targets T_d: projected gradient on 1/2 sum (S_d - T_d)^2 / M_d from
r = 1, where M_d are the tokens at rate 1. A step moves a document against p and is cut off at 0:
r <- max(0, r - p . g). Two gradients g are known after a pass: the plain one, (S_d - T_d) / M_d with M_d over the
documents with r > 0, and the one scaled by the Gram matrix sum n p p' of those documents, which meets the targets at
once unless further rates reach 0. The next pass tries both at the lengths of ``TRIES``, all in one aggregate, and keeps
the one that leaves the least. The fit ends when the targets are met, or when the objective hardly falls any more: the
targets are then out of reach and the rates are the least-squares ones. A pass is one aggregate with a few numbers per domain; every ``CUT_PASSES`` passes the rates are written
to the shared folder as a column, so no plan grows with the passes and nothing is lost with an executor.

``targets`` are weights of domains; the ``anchor`` domain keeps its tokens (one epoch) and so fixes
the size of the mix. A scarce domain is repeated as often as its weight asks; ``max_epochs`` bounds the
repeats by scaling the whole mix down to the scarcest domain, so the weights hold then too. Copies of
a document are floor(r + u) with u from a hash of its id. Every row tells the goal and the reached tokens of each domain;
a fit that misses its goals warns as well.

Defined results: a null or empty text has no tokens and the model's intercept as posteriors; with
fewer than two labelled domains the posteriors are uniform; a domain but the anchor that is out of reach (its share of the targets is above the
posterior that any document with tokens has for it, so no rates at all can give that share) is left out of the fit, which then
matches the others; its goal and what it reached are told all the same; repeated
rows get equal rates and copies; a null id draws the u of an empty id; an empty table gives an
empty result; extra columns pass through ``mix`` untouched (helper columns start with ``_p3_``).
"""

from __future__ import annotations

import math
import warnings
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import cut

DOMAINS = ["clean", "low", "toxic"]
TARGETS = {"clean": 0.94, "low": 0.05, "toxic": 0.01}
SLOTS = 1 << 14
FIT_ROWS = 20_000
REGULARISATION = 3e-4
FIT_ITERATIONS = 60
CUT_PASSES = 6
MAX_PASSES = 200
#: (scaled or plain gradient, length) of the steps a pass tries
TRIES = [(0, 1.0), (0, 0.5), (0, 0.2), (1, 1.0), (1, 4.0)]
#: the fit has settled when this many passes in a row each take less than this share off the objective
SETTLED = (4, 1e-3)
TOLERANCE = 1e-4


def _words(text: Column) -> Column:
    """Words of the lower-cased text; none of a null or blank one."""
    parts = F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[\x20\x09-\x0D]+", -1)
    return F.filter(parts, lambda w: w != "")


class Classifier:
    """Logistic regression on hashed word presence; ``model`` is None when nothing was labelled."""

    def __init__(self, model=None):
        self.tf = HashingTF(inputCol="_p3_w", outputCol="_p3_f", numFeatures=SLOTS, binary=True)
        self.model = model

    def posteriors(self, df: DataFrame, text: Column) -> DataFrame:
        """df + ``_p3_n`` tokens and ``_p3_p`` (array of posteriors in the order of DOMAINS)."""
        df = df.withColumn("_p3_w", _words(text)).withColumn("_p3_n", F.size("_p3_w").cast("bigint"))
        if self.model is None:
            return df.withColumn("_p3_p", F.array(*[F.lit(1.0 / len(DOMAINS))] * len(DOMAINS))).drop("_p3_w")
        df = self.model.transform(self.tf.transform(df)).withColumn("_p3_a", vector_to_array("_p3_v"))
        # classes above the largest labelled one have probability 0
        p = F.array(*[F.coalesce(F.get("_p3_a", F.lit(d)), F.lit(0.0)) for d in range(len(DOMAINS))])
        return df.withColumn("_p3_p", p).drop("_p3_w", "_p3_f", "_p3_v", "_p3_a")


def fit_classifier(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Classifier:
    """Fitted on the labelled documents whose id hash falls into the share that gives ``fit_rows``."""
    domain = F.when(F.col("toxic") == 1, 2.0).when(F.col("quality") == 0, 1.0).when(F.col("quality") == 1, 0.0)
    lab = labels.select("doc_id", domain.alias("_p3_y")).where("_p3_y is not null and doc_id is not null")
    part = min(1.0, fit_rows / max(1, lab.count()))
    lab = lab.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.lit(int(part * (1 << 20))))
    out = Classifier()
    rows = out.tf.transform(docs.join(lab, "doc_id").select("_p3_y", _words(F.col("text")).alias("_p3_w")))
    rows = cut(rows.select("_p3_y", "_p3_f"))
    if rows.select("_p3_y").distinct().count() < 2:
        return out
    lr = LogisticRegression(
        featuresCol="_p3_f", labelCol="_p3_y", probabilityCol="_p3_v", rawPredictionCol="", predictionCol="",
        family="multinomial", elasticNetParam=1.0, regParam=REGULARISATION, maxIter=FIT_ITERATIONS, standardization=False)
    out.model = lr.fit(rows)
    return out


def _step(rate: Column, gradient: list[float]) -> Column:
    along = sum((F.get(F.col("_p3_p"), F.lit(d)) * F.lit(float(x)) for d, x in enumerate(gradient)), F.lit(0.0))
    return F.greatest(F.lit(0.0), rate - along)


@dataclass
class Rates:
    members: DataFrame  # with ``_p3_r``
    steps: list[list[float]]  # the gradient of each pass
    own: dict[str, float]
    goal: dict[str, float]
    reached: dict[str, float]

    def column(self) -> Column:
        """The rate as an expression of the posteriors and all steps, for tables without ``_p3_r``."""
        start = F.struct(F.lit(1.0).alias("r"))
        steps = F.array(*[F.array(*[F.lit(float(x)) for x in s]) for s in self.steps]) if self.steps else None
        if steps is None:
            return F.lit(1.0)

        def after(acc: Column, s: Column) -> Column:
            along = sum((F.get(F.col("_p3_p"), F.lit(d)) * F.get(s, F.lit(d)) for d in range(len(DOMAINS))), F.lit(0.0))
            return F.struct(F.greatest(F.lit(0.0), acc["r"] - along).alias("r"))

        return F.aggregate(steps, start, after)["r"]


def reachable(mass: list[float], goal: list[float], purest: list[float], anchor: int) -> list[int]:
    """The domains to fit: the anchor, and those whose share of a mix that meets the goals is within the largest posterior
    of a document, which bounds the share that any nonnegative rates can give. The domains left out hold at most their
    own largest posteriors of such a mix."""
    usable = [d for d, m in enumerate(mass) if m > 0]
    while True:
        whole = math.fsum(goal[d] for d in usable)
        rest = 1.0 - math.fsum(x for d, x in enumerate(purest) if d not in usable)
        out = [d for d in usable if d != anchor and goal[d] * rest > purest[d] * whole * (1 + TOLERANCE)]
        if not out:
            return usable
        worst = max(out, key=lambda d: goal[d] / purest[d])
        usable = [d for d in usable if d != worst]


def fit_rates(members: DataFrame, targets: dict[str, float] | None = None, anchor: str = "clean",
              max_epochs: float | None = None, passes: int = MAX_PASSES, tolerance: float = TOLERANCE) -> Rates:
    """members: rows with ``_p3_n`` and ``_p3_p``; any other columns stay with them."""
    targets = TARGETS if targets is None else targets
    each = range(len(DOMAINS))
    keep = [c for c in members.columns if c != "_p3_r"]
    rates = Rates(members.withColumn("_p3_r", F.lit(1.0)), [], {}, {}, {})

    def pass_over(frame: DataFrame, gradients: list[list[float]]) -> list[tuple[list[float], list[list[float]]]]:
        """After each of the steps: tokens per domain, and the Gram matrix of the documents with a rate above 0."""
        k, out = len(DOMAINS), []
        pairs = [(d, e) for d in each for e in range(d, k)]
        p, n = [F.get(F.col("_p3_p"), F.lit(d)) for d in each], F.col("_p3_n")
        total = lambda x: F.coalesce(F.sum(x), F.lit(0.0))
        tried = frame.select("_p3_n", "_p3_p", *[_step(F.col("_p3_r"), g).alias(f"_p3_r{i}") for i, g in enumerate(gradients)])
        cols = []
        for i in range(len(gradients)):
            r = F.col(f"_p3_r{i}")
            cols += [total(r * n * p[d]) for d in each] + [total(F.when(r > 0, n * p[d] * p[e])) for d, e in pairs]
        row = [float(x) for x in tried.agg(*cols).first()]
        for i in range(len(gradients)):
            part = row[i * (k + len(pairs)) : (i + 1) * (k + len(pairs))]
            gram = [[0.0] * k for _ in each]
            for (d, e), x in zip(pairs, part[k:]):
                gram[d][e] = gram[e][d] = x
            out.append((part[:k], gram))
        return out

    now, gram = pass_over(rates.members, [[0.0] * len(DOMAINS)])[0]
    mass = now
    purest = [x or 0.0 for x in rates.members.where("_p3_n > 0").agg(*[F.max(F.get(F.col("_p3_p"), F.lit(d))) for d in each]).first()]
    base = mass[DOMAINS.index(anchor)]
    if base <= 0 or targets.get(anchor, 0) <= 0:
        return rates
    goal = [base / targets[anchor] * targets.get(d, 0.0) for d in DOMAINS]
    if max_epochs is not None:
        part = min([1.0] + [max_epochs * m / g for m, g in zip(mass, goal) if m > 0 and g > 0])
        goal = [g * part for g in goal]
    usable = reachable(mass, goal, purest, DOMAINS.index(anchor))
    missed = lambda s: max(abs(s[d] - goal[d]) for d in usable) > tolerance * math.fsum(goal)
    loss = lambda s: math.fsum((s[d] - goal[d]) ** 2 / mass[d] for d in usable)

    def gradients() -> list[list[float]]:
        """The steps to try."""
        off = [now[d] - goal[d] for d in usable]
        scaled = np.linalg.lstsq(np.array([[gram[d][e] for e in usable] for d in usable]), np.array(off), rcond=1e-12)[0]
        kinds = [[0.0] * len(DOMAINS) for _ in range(2)]
        for k, d in enumerate(usable):
            live = math.fsum(gram[d])
            kinds[0][d], kinds[1][d] = float(scaled[k]), off[k] / (live if live > 0 else mass[d])
        return [[x * length for x in kinds[kind]] for kind, length in TRIES]

    frame, since, slow = rates.members, 0, 0
    for _ in range(passes):
        if not missed(now) or slow >= SETTLED[0]:
            break
        steps = gradients()
        after = pass_over(frame, steps)
        best = min(range(len(steps)), key=lambda i: loss(after[i][0]))
        if loss(after[best][0]) >= loss(now):
            break
        slow = slow + 1 if loss(after[best][0]) > (1 - SETTLED[1]) * loss(now) else 0
        now, gram = after[best]
        frame, since = frame.withColumn("_p3_r", _step(F.col("_p3_r"), steps[best])), since + 1
        rates.steps.append(steps[best])
        if since == CUT_PASSES:
            frame, since = cut(frame.select(*keep, "_p3_r")), 0
    rates.members = frame
    rates.own, rates.goal, rates.reached = (dict(zip(DOMAINS, x)) for x in (mass, goal, now))
    if missed(now) or any(goal[d] > 0 for d in each if d not in usable):
        warnings.warn(f"mixing misses its targets: goal {rates.goal}, reached {rates.reached}", stacklevel=2)
    return rates


def copies(rate: Column, id_col: str = "doc_id", seed: int = 3) -> Column:
    """floor(rate + u): the expected number of copies is the rate."""
    u = F.pmod(F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    return F.floor(rate + u).cast("int")


def mixing_rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """One row per document: doc_id, n_tokens, a posterior per domain, rate, copies, and the goal and the reached
    tokens of each domain (null where nothing could be fitted)."""
    model = fit_classifier(docs, labels)
    rates = fit_rates(cut(model.posteriors(docs.select("doc_id", "text"), F.col("text")).drop("text")), targets)
    out = rates.members.withColumn("rate", F.col("_p3_r"))
    told = [F.lit(of.get(d)).cast("double").alias(f"{what}_{d}") for what, of in (("goal", rates.goal), ("reached", rates.reached)) for d in DOMAINS]
    return out.select("doc_id", F.col("_p3_n").alias("n_tokens"),
                      *[F.get(F.col("_p3_p"), F.lit(i)).alias(f"p_{d}") for i, d in enumerate(DOMAINS)],
                      "rate", copies(F.col("rate")).alias("copies"), *told)


def mixing_totals(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """One row per domain: its tokens, its goal and the expected tokens that the rates reach."""
    model = fit_classifier(docs, labels)
    r = fit_rates(cut(model.posteriors(docs.select("text"), F.col("text")).drop("text")), targets)
    rows = [(d, r.own[d], r.goal[d], r.reached[d]) for d in DOMAINS if d in r.goal]
    return docs.sparkSession.createDataFrame(rows, "domain string, own double, goal double, reached double")


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, copy_col: str | None = None) -> DataFrame:
    """The mixed corpus: every document as often as its copies, with the columns it came with and, if named, the
    number of the copy from 0. Posteriors are computed again beside the text, which is cheaper than joining them to it."""
    model = fit_classifier(docs, labels)
    members = cut(model.posteriors(docs.select("text"), F.col("text")).drop("text"))
    rate = fit_rates(members, targets).column()
    # the row number keeps the optimizer from pushing the count below and so evaluating the model per reference
    d = model.posteriors(docs, F.col("text")).withColumn("_p3_b", F.monotonically_increasing_id())
    d = d.withColumn("_p3_c", copies(rate) + F.pmod("_p3_b", F.lit(1)).cast("int")).where("_p3_c > 0")
    d = d.withColumn("_p3_k", F.explode(F.sequence(F.lit(0), F.col("_p3_c") - 1)))
    number = [F.col("_p3_k").alias(copy_col)] if copy_col else []
    return d.select(*[F.col(f"`{c}`") for c in docs.columns if c != copy_col], *number)
