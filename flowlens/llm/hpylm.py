"""Operator 9: document scores under a hierarchical Pitman-Yor language model.

Restaurants: one per context, the context being the word before (an end before a text's first word); all context
restaurants share one parent, the root, whose base is uniform over the V training words and one place for all others.
A context restaurant's tables are the root's customers. Seating is sampled by Gibbs sweeps: each sweep seats the
customers of every (context, word) anew by the Chinese restaurant process, given the parent's predictive probabilities
and the table totals of the sweep before (a parallel, blocked sampler). The predictive probabilities of the sweeps
after the first ``BURN_IN`` are averaged; a text's score is the sum of their logarithms.

Work is dealt by word: every task holds all counts of its words (all contexts), so counts,
seating and probabilities of a word need no other task. What is shared are the totals per
context: after each sweep a task sends those of its contexts to the contexts' home partitions, which add them up and send
back what was asked for, in the order it was asked for (small numbers, one byte each). A task replays its sweeps from
these answers (its random numbers are seeded), so no seating is stored between the passes and a lost task is only run
again; the tokens are shuffled once and the passes read the same shuffle files.
Tokens travel packed: per block of texts and target task, the block's distinct words and contexts and plain
arrays of (context, text) for each occurrence. Words that make up more than 1/``HOT`` of the
tokens (at most ``HOT`` words, found first) are dealt by word and context; their numbers in the root, and their totals as contexts,
are vectors of that length that are summed in a tree. (context, word) pairs above 1/``HOT`` (at most ``HOT``, too) are dealt by block
instead, and their counts are seated on the driver and broadcast.

A customer count of more than ``EXACT`` at one pair draws its later tables by blocks that grow by an
eighth with a Poisson number of new tables (their chance hardly changes inside a block).

Defined results: a null text is empty and has one token, its end; repeated rows count and are scored
each; a row without an id is in fold 0; without training rows all words are unknown (train_tokens
0); an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm import textbytes as tb
from flowlens.llm.common import cut
from flowlens.llm.langid import fold

HOT = 1024
SWEEPS = 3
BURN_IN = 1
EXACT = 64
LEAF = (0.75, 0.5)  # discount, strength
ROOT = (0.7, 1.0)
MIN_PARTS = 64
FLUSH_TOKENS = 2_000_000
SEED = 9
END = np.uint64(0x0123456789ABCDEF)
_U = np.uint64


def tokens(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word hash, context, text) of every token of the texts, an end after each text's words; the context is the hash
    of the word before, an end at a text's start."""
    low = tb.LOWER[data]
    starts, ends, row = tb.words(low, offs)
    h = tb.span_hash(tb.hash_prefix(low), starts, ends)
    n = len(offs) - 1
    count = np.bincount(row, minlength=n)
    at = np.arange(len(h)) + row  # an end before each later text
    out = np.full(len(h) + n, END, dtype=np.uint64)
    out[at] = h
    doc = np.repeat(np.arange(n), count + 1)
    return out, np.r_[END, out[:-1]], doc


def pair_hash(ctx: np.ndarray, word: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return tb.splitmix(tb.splitmix(ctx ^ _U(31)) + word)


def _find(sorted_: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Place of each x in the sorted distinct values, -1 when it is not there."""
    if not len(sorted_):
        return np.full(len(x), -1, dtype=np.int64)
    at = np.minimum(np.searchsorted(sorted_, x), len(sorted_) - 1)
    return np.where(sorted_[at] == x, at, -1)


FREQUENT = "pair boolean, ctx bigint, word bigint, n bigint"


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and pairs above 1/HOT of a block, and all tokens as word 0."""
    for b in batches:
        for _, _, data, offs in tb.blocks(b.column("text")):
            w, ctx, _ = tokens(data, offs)
            h, n = np.unique(w, return_counts=True)
            often = n * HOT >= len(w)
            some = (_find(h[often], w) >= 0) & (_find(h[often], ctx) >= 0)  # of a frequent pair both are frequent
            w2, ctx = w[some], ctx[some]
            _, first, n2 = np.unique(pair_hash(ctx, w2), return_index=True, return_counts=True)
            first, n2 = first[n2 * HOT >= len(w)], n2[n2 * HOT >= len(w)]
            k = int(often.sum()) + 1
            cols = [np.r_[np.zeros(k, bool), np.ones(len(first), bool)], np.r_[np.zeros(k, _U), ctx[first]].view(np.int64),
                    np.r_[h[often], _U(0), w2[first]].view(np.int64), np.r_[n[often], len(w), n2]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["pair", "ctx", "word", "n"])


class Hot(NamedTuple):
    """Frequent words (sorted) and frequent pairs (sorted by their hash; places of context and word in ``words``)."""

    words: np.ndarray
    pairs: np.ndarray
    ctx: np.ndarray
    word: np.ndarray


def hot_words(docs: DataFrame) -> Hot:
    """At most HOT words and HOT pairs, every word and pair above 2/HOT of all tokens among them."""
    sums = docs.select("text").mapInArrow(_frequent, FREQUENT).groupBy("pair", "ctx", "word").agg(F.sum("n").alias("n"))
    sums = cut(sums)
    total = sums.where("word = 0 AND NOT pair").agg(F.sum("n")).first()[0] or 0
    rows = sums.where(F.col("pair") | (F.col("word") != 0)).where(F.col("n") * HOT >= total).collect()
    hashes = lambda x: np.array(x, dtype=np.int64).view(np.uint64)
    words = np.unique(hashes([r.word for r in rows if not r.pair]))
    ctx, word = hashes([r.ctx for r in rows if r.pair]), hashes([r.word for r in rows if r.pair])
    order = np.argsort(pair_hash(ctx, word))
    ctx, word = ctx[order], word[order]
    return Hot(words, pair_hash(ctx, word), _find(words, ctx), _find(words, word))


def _index(idx: np.ndarray, of: np.ndarray) -> bytes:
    return idx.astype(np.uint16 if len(of) <= 65536 else np.uint32).tobytes()


def _indexed(data: bytes, of: np.ndarray) -> np.ndarray:
    return of[np.frombuffer(data, np.uint16 if len(of) <= 65536 else np.uint32)]


def _narrow(x: np.ndarray) -> bytes:
    """Counts, one byte each; those of 255 and more follow in full."""
    x = x.astype(np.int64)
    return np.minimum(x, 255).astype(np.uint8).tobytes() + x[x >= 255].tobytes()


def _wide(data: bytes, n: int) -> np.ndarray:
    out = np.frombuffer(data, np.uint8, n).astype(np.int64)
    out[out == 255] = np.frombuffer(data, np.int64, -1, n)
    return out


class _Packer:
    """Collects the tokens of a partition's texts and packs them by target task."""

    def __init__(self, hot: Hot, parts: int):
        self.hot, self.parts = hot, parts
        self.task = TaskContext.get().partitionId()
        self.rows = 0
        self.block = 0
        self.reset()

    def reset(self):
        self.w, self.c, self.d, self.rid, self.ids, self.null, self.train = [], [], [], [], [], [], []
        self.docs = self.size = 0

    def add(self, h, ctx, doc, ids, null, train):
        n = len(ids)
        self.w.append(h)
        self.c.append(ctx)
        self.d.append(doc + self.docs)
        self.rid.append((np.int64(self.task) << 40) + self.rows + np.arange(n))
        self.ids.append(ids)
        self.null.append(null)
        self.train.append(train)
        self.docs += n
        self.rows += n
        self.size += len(h)

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.docs:
            return
        w, ctx, doc = np.concatenate(self.w), np.concatenate(self.c), np.concatenate(self.d)
        rid, train = np.concatenate(self.rid), np.concatenate(self.train)
        own = (self.task * 7919 + self.block) % self.parts
        to = (w % _U(self.parts)).astype(np.int64)
        often = np.flatnonzero(_find(self.hot.words, w) >= 0)
        pair = pair_hash(ctx[often], w[often])
        to[often] = np.where(_find(self.hot.pairs, pair) >= 0, own, (pair % _U(self.parts)).astype(np.int64))
        order = np.lexsort((w, to))
        w, ctx, doc, to = w[order], ctx[order], doc[order].astype(np.uint32), to[order]
        edge = np.flatnonzero(np.r_[True, to[1:] != to[:-1]])
        out = []
        for lo, hi in zip(edge, np.r_[edge[1:], len(to)]):
            x = w[lo:hi]
            new = np.flatnonzero(np.r_[True, x[1:] != x[:-1]])
            used, idx = np.unique(doc[lo:hi], return_inverse=True)
            before, cidx = np.unique(ctx[lo:hi], return_inverse=True)
            times = np.diff(np.r_[new, len(x)]).astype(np.uint32)
            out.append((int(to[lo]), x[new].tobytes(), times.tobytes(), before.tobytes(), _index(cidx, before), _index(idx, used),
                        rid[used].tobytes(), np.packbits(train[used]).tobytes(), b""))
        n_tokens = np.bincount(np.concatenate(self.d), minlength=self.docs).astype(np.int64)
        head = np.stack([rid, np.concatenate(self.ids), np.concatenate(self.null).astype(np.int64), n_tokens])
        out.append((own, b"", b"", b"", b"", b"", b"", b"", head.tobytes()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([o[0] for o in out], pa.int32()), *[pa.array([o[i] for o in out], pa.binary()) for i in range(1, 9)]],
            names=["part", "words", "times", "contexts", "ctx", "doc", "rid", "train", "head"])
        self.block += 1
        self.reset()


def _pack(hot, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = _Packer(hot.value, parts)
        for b in batches:
            ids = b.column("doc_id")
            for lo, hi, data, offs in tb.blocks(b.column("text")):
                some = ids.slice(lo, hi - lo)
                p.add(*tokens(data, offs), np.asarray(some.fill_null(0)), np.asarray(some.is_null()),
                      np.asarray(b.column("train").slice(lo, hi - lo)))
                if p.size > FLUSH_TOKENS or p.docs > 60_000:
                    yield from p.flush()
        yield from p.flush()

    return run


class _Part:
    """All occurrences of a task's words, and the answers of the contexts' home partitions so far."""

    def __init__(self, packets, hot: Hot, parts: int):
        words, times, ctx, train, rid = [], [], [], [], []
        self.heads = []
        answers: dict[int, dict[int, tuple]] = {}
        for _, packet in packets:
            if packet[0] == ANSWER:
                _, step, home, t, c = packet
                answers.setdefault(step, {})[home] = (t, c)
                continue
            w, n, before, c, d, r, t, head = packet
            if len(head):
                self.heads.append(np.frombuffer(head, np.int64).reshape(4, -1))
                continue
            r = np.frombuffer(r, np.int64)
            t = np.unpackbits(np.frombuffer(t, np.uint8))[: len(r)].astype(bool)
            words.append(np.repeat(np.frombuffer(w, np.uint64), np.frombuffer(n, np.uint32)))
            ctx.append(_indexed(c, np.frombuffer(before, np.uint64)))
            train.append(_indexed(d, t))
            rid.append(_indexed(d, r))
        cat = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
        self.train, self.rid = cat(train, bool), cat(rid, np.int64)
        self.words, row = np.unique(cat(words, np.uint64), return_inverse=True)
        self.ctx, before = np.unique(cat(ctx, np.uint64), return_inverse=True)
        self.hot_word, self.hot_ctx = _find(hot.words, self.words), _find(hot.words, self.ctx)
        # distinct pairs, and the pair of each occurrence
        key, self.pair = np.unique(row * max(1, len(self.ctx)) + before, return_inverse=True)
        self.pair_word, self.pair_ctx = np.divmod(key, max(1, len(self.ctx)))
        self.crowd = np.full(len(key), -1, dtype=np.int64)
        some = np.flatnonzero(self.hot_word[self.pair_word] >= 0)
        self.crowd[some] = _find(hot.pairs, pair_hash(self.ctx[self.pair_ctx[some]], self.words[self.pair_word[some]]))
        self.count = np.bincount(self.pair[self.train], minlength=len(key))
        # rare contexts by home partition, in the order in which the homes are asked
        rare = np.flatnonzero(self.hot_ctx < 0)
        home = (self.ctx[rare] % _U(parts)).astype(np.int64)
        order = np.argsort(home, kind="stable")
        self.asked = {int(home[x[0]]): rare[x] for x in np.split(order, np.flatnonzero(np.diff(home[order])) + 1) if len(x)}
        self.answers = {}  # by sweep; none for a task without rare contexts
        self.ctx_count = np.zeros(len(self.ctx), dtype=np.int64)
        for step in answers:
            tables = np.zeros(len(self.ctx), dtype=np.int64)
            for q, (t, c) in answers[step].items():
                at = self.asked[q]
                tables[at] = _wide(t, len(at))
                if step == 0:
                    self.ctx_count[at] = _wide(c, len(at))
            self.answers[step] = tables

    def tables(self, step: int, g: dict) -> np.ndarray:
        """Table totals of this task's contexts after a sweep."""
        own = self.answers.get(step, self.ctx_count)
        return np.where(self.hot_ctx >= 0, g["ctx_tables"][self.hot_ctx], own) if len(g["ctx_tables"]) else own

    def customers(self, g: dict) -> np.ndarray:
        return np.where(self.hot_ctx >= 0, g["ctx_counts"][self.hot_ctx], self.ctx_count) if len(g["ctx_counts"]) else self.ctx_count

    def seating(self, number: int) -> _Seating:
        own = np.flatnonzero((self.crowd < 0) & (self.count > 0))
        return _Seating(number, self.pair_word[own], self.pair_ctx[own], self.count[own], self.hot_word)

    def questions(self, t: np.ndarray, s: _Seating, first: bool):
        """(home, asked contexts, their tables and customers here) for every home partition."""
        tables = np.bincount(s.ctx, weights=t, minlength=len(self.ctx))
        counts = np.bincount(s.ctx, weights=s.count, minlength=len(self.ctx))
        for q, at in self.asked.items():
            yield q, (self.ctx[at].tobytes() if first else b"", _narrow(tables[at]), _narrow(counts[at]) if first else b"")


def _new_tables(rng, a: np.ndarray, d: float, c: np.ndarray) -> np.ndarray:
    """Tables after c customers have been seated one by one; a = weight of a new table over all."""
    t = np.minimum(c, 1).astype(np.float64)
    live = np.flatnonzero(c > 1)
    j = 1
    while len(live) and j < EXACT:
        w = a[live]
        t[live] += rng.random(len(live)) * (w + j - d * t[live]) < w
        j += 1
        live = live[c[live] > j]
    j = float(j)
    while len(live):
        k = np.minimum(np.ceil(j * 1.125), c[live])
        w = a[live]
        mean = w * np.log((w + k - d * t[live]) / (w + j - d * t[live]))
        t[live] += np.minimum(rng.poisson(mean), k - j)
        live = live[c[live] > k]
        j = float(np.ceil(j * 1.125))
    return t


class _Seating:
    """Sweeps over the (word, context) counts of some words, given the totals of earlier sweeps.

    ``hot`` holds a word's place among the frequent words (-1: none); what the root has of these is known to the driver only.
    """

    def __init__(self, number: int, word: np.ndarray, ctx: np.ndarray, count: np.ndarray, hot: np.ndarray):
        self.number, self.word, self.ctx, self.count, self.hot = number, word, ctx, count, hot
        self.cold = hot < 0
        self.total = self.by_word(count)

    def by_word(self, x: np.ndarray) -> np.ndarray:
        return np.bincount(self.word, weights=x, minlength=len(self.hot))

    def start(self):
        t = np.ones(len(self.word))
        customers = self.by_word(t)
        return t, customers, ((customers > 0) & self.cold).astype(float)

    def of_root(self, own: np.ndarray, hot: np.ndarray) -> np.ndarray:
        """A number of the root per word: this task's own, or the driver's where the word is frequent."""
        return np.where(self.cold, own, hot[self.hot]) if len(hot) else own

    def parent(self, state, g) -> np.ndarray:
        """The root's predictive probability of each word."""
        d, theta = ROOT
        customers, tables = self.of_root(state[1], g["hot_customers"]), self.of_root(state[2], g["hot_tables"])
        return (np.maximum(0.0, customers - d * tables) + (theta + d * g["root_tables"]) / (g["V"] + 1)) / (theta + g["customers"])

    def sweep(self, state, g, ctx_tables: np.ndarray, r: int):
        rng = np.random.default_rng([SEED, self.number + 1, r])
        d, theta = LEAF
        a = (theta + d * ctx_tables[self.ctx]) * self.parent(state, g)[self.word]
        t = _new_tables(rng, a, d, self.count)
        customers = self.by_word(t)
        return t, customers, _root_tables(rng, g, np.where(self.cold, customers, 0))

    def totals(self, state, hot_ctx: np.ndarray, n_hot: int) -> dict:
        """What the driver adds up; ``hot_ctx`` is a context's place among the frequent words (-1: none)."""
        t, customers, tables = state
        w, c = self.hot[self.word], hot_ctx[self.ctx]
        add = lambda at, x: np.bincount(at[at >= 0], weights=x[at >= 0], minlength=n_hot)
        return {"customers": float(customers.sum()), "root_tables": float(tables.sum()), "hot_customers": add(w, t), "ctx_tables": add(c, t)}

    def run(self, history: list[dict], ctx_tables: list[np.ndarray]) -> list:
        """States 0 to len(history): sweep r uses the totals after sweep r - 1."""
        states = [self.start()]
        for r, (g, x) in enumerate(zip(history, ctx_tables)):
            states.append(self.sweep(states[-1], g, x, r + 1))
        return states

    def predictive(self, states, history, ctx_tables, ctx_counts, pair_word, pair_ctx, own) -> np.ndarray:
        """Averaged probability of the pairs (word < 0 is an unknown word); ``own`` is a pair's place in the seating (-1: none)."""
        d, theta = LEAF
        d0, theta0 = ROOT
        out = np.zeros(len(pair_word))
        used = range(BURN_IN + 1, len(states))
        known, seen = pair_word >= 0, own >= 0
        for r in used:
            g, state = history[r], states[r]
            p0 = np.full(len(pair_word), (theta0 + d0 * g["root_tables"]) / (g["V"] + 1) / (theta0 + g["customers"]))
            p0[known] = self.parent(state, g)[pair_word[known]]
            mine = np.zeros(len(pair_word))
            mine[seen] = np.maximum(0.0, self.count[own[seen]] - d * state[0][own[seen]])
            out += (mine + (theta + d * ctx_tables[r][pair_ctx]) * p0) / (theta + ctx_counts[pair_ctx])
        return out / len(used)


def _root_tables(rng, g: dict, customers: np.ndarray) -> np.ndarray:
    d, theta = ROOT
    return _new_tables(rng, np.full(len(customers), (theta + d * g["root_tables"]) / (g["V"] + 1)), d, customers)


def _merge(a: dict, b: dict) -> dict:
    return {k: a[k] + b[k] for k in a}


#: marks of the records that travel beside the tokens' packets
ANSWER, TOTALS = "answer", "totals"


def _same(part: int) -> int:
    return part


def _answer(step: int):
    """mapPartitionsWithIndex body of a home partition: adds up its contexts and answers every task that asked."""

    def run(home: int, records):
        asked, got = {}, {}
        for _, (kind, src, ids, t, c) in records:
            if kind == 0:
                asked[src] = (np.frombuffer(ids, np.uint64), c)
            if kind == step:
                got[src] = t
        order = sorted(asked)
        if not order:
            return
        ids, inv = np.unique(np.concatenate([asked[s][0] for s in order]), return_inverse=True)
        size = [len(asked[s][0]) for s in order]

        def added(parts: list[bytes]) -> list[bytes]:
            x = np.concatenate([_wide(p, n) for p, n in zip(parts, size)])
            total = np.bincount(inv, weights=x, minlength=len(ids)).astype(np.int64)[inv]
            return [_narrow(p) for p in np.split(total, np.cumsum(size)[:-1])]

        tables = added([got[s] for s in order])
        counts = added([asked[s][1] for s in order]) if step == 0 else [b""] * len(order)
        for s, t, c in zip(order, tables, counts):
            yield s, (ANSWER, step, home, t, c)

    return run


RESULT = "rid bigint, doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double"


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed result arrays -> rows."""
    names = [x.split()[0] for x in RESULT.split(", ")]
    for b in batches:
        for i in range(b.num_rows):
            head = np.frombuffer(b.column("head")[i].as_buffer(), np.int64)
            if len(head):
                rid, ids, null, n = head.reshape(4, -1)
                zero = np.zeros(len(rid))
                cols = [pa.array(rid), pa.array(ids, mask=null.astype(bool)), pa.array(n), pa.array(zero.astype(np.int64)), pa.array(zero), pa.array(zero)]
            else:
                rid = np.frombuffer(b.column("rid")[i].as_buffer(), np.int64)
                x = np.frombuffer(b.column("sums")[i].as_buffer(), np.float64).reshape(3, -1)
                cols = [pa.array(rid), pa.nulls(len(rid), pa.int64()), pa.array(np.zeros(len(rid), np.int64)),
                        pa.array(x[0].astype(np.int64)), pa.array(x[1]), pa.array(x[2])]
            yield pa.RecordBatch.from_arrays(cols, names=names)


def score_documents(docs: DataFrame, folds: int = 7, held: int = 2, sweeps: int = SWEEPS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score); learns from the texts
    whose fold is not ``held``."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    d = d.select("doc_id", (fold(F.col("doc_id"), folds) != held).alias("train"), "text")
    hot_list = hot_words(d)
    hot = sc.broadcast(hot_list)
    n_hot = len(hot_list.words)
    parts = max(MIN_PARTS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    packed = d.mapInArrow(_pack(hot, parts), "part int, words binary, times binary, contexts binary, ctx binary, doc binary, rid binary, train binary, head binary")
    # one shuffle, read by all passes; the answers to the tasks are dealt in the same way and read beside it
    dealt = packed.rdd.map(lambda r: (r[0], tuple(bytes(x) for x in r[1:]))).partitionBy(parts, _same)
    parts = dealt.getNumPartitions()

    def ask(step: int, past):
        """mapPartitionsWithIndex body: questions of a sweep to the homes, and the task's totals for the driver."""

        def run(i, it):
            p = _Part(it, hot.value, parts)
            s = p.seating(i)
            g = past.value if past else []
            state = s.run(g, [p.tables(r, x) for r, x in enumerate(g)])[-1]
            totals = s.totals(state, p.hot_ctx, n_hot)
            if step == 0:
                cold = s.cold & (s.total > 0)
                at = p.hot_ctx[s.ctx]
                crowd = p.crowd >= 0
                totals |= {"N": float(s.count.sum()), "V": int(cold.sum()),
                           "hot_total": np.bincount(s.hot[~s.cold], weights=s.total[~s.cold], minlength=n_hot),
                           "ctx_counts": np.bincount(at[at >= 0], weights=s.count[at >= 0], minlength=n_hot),
                           "crowd": np.bincount(p.crowd[crowd], weights=p.count[crowd], minlength=len(hot.value.pairs))}
            yield i, (TOTALS, totals)
            for home, (ids, t, c) in p.questions(state[0], s, step == 0):
                yield home, (step, i, ids, t, c)

        return run

    def pass_(step: int, past=None) -> dict:
        """One pass over the tokens: sends the questions, keeps the answers for later passes, gives the summed totals."""
        asked = read().mapPartitionsWithIndex(ask(step, past)).partitionBy(parts, _same)
        got = asked.filter(lambda x: x[1][0] == TOTALS).map(lambda x: x[1][1]).treeReduce(_merge)
        questions.append(asked)
        both = asked if step == 0 else sc.union([questions[0], asked])
        answers.append(both.mapPartitionsWithIndex(lambda i, it: _answer(step)(i, (x for x in it if x[1][0] != TOTALS))).partitionBy(parts, _same))
        return got

    def read():
        return sc.union([dealt, *answers]) if answers else dealt

    questions, answers = [], []
    first = pass_(0)
    there = np.flatnonzero(first["crowd"] > 0)
    crowd = _Seating(-1, hot_list.word[there], hot_list.ctx[there], first["crowd"][there].astype(np.int64), np.arange(n_hot))
    places = np.arange(n_hot)
    hot_total = first["hot_total"] + crowd.total
    fixed = {"N": int(first["N"] + crowd.count.sum()), "V": first["V"] + int((hot_total > 0).sum()), "hot_total": hot_total,
             "ctx_counts": first["ctx_counts"] + np.bincount(crowd.ctx, weights=crowd.count, minlength=n_hot)}

    def whole(got: dict, state, r: int) -> dict:
        """Totals after a sweep: the tasks', the frequent pairs' and the frequent words' tables in the root."""
        g = fixed | _merge({k: got[k] for k in ("customers", "root_tables", "hot_customers", "ctx_tables")}, crowd.totals(state, places, n_hot))
        rng = np.random.default_rng([SEED, parts + 1, r])
        tables = _root_tables(rng, history[-1], g["hot_customers"]) if history else (g["hot_customers"] > 0).astype(float)
        return g | {"hot_tables": tables, "root_tables": g["root_tables"] + float(tables.sum())}

    history: list[dict] = []
    history.append(whole(first, crowd.start(), 0))
    for r in range(1, sweeps + 1):
        got = pass_(r, sc.broadcast(list(history)))
        history.append(whole(got, crowd.run(history, [g["ctx_tables"] for g in history])[-1], r))
    states = crowd.run(history[:-1], [g["ctx_tables"] for g in history[:-1]])
    at = np.full(len(hot_list.pairs), -1)
    at[there] = np.arange(len(there))
    crowd_prob = crowd.predictive(states, history, [g["ctx_tables"] for g in history], fixed["ctx_counts"],
                                  np.where(hot_total[hot_list.word] > 0, hot_list.word, -1), hot_list.ctx, at)
    model = sc.broadcast((history, crowd_prob))

    def score(i, it):
        past, crowd_p = model.value
        g = past[0]
        n, v = g["N"], g["V"]
        p = _Part(it, hot.value, parts)
        for h in p.heads:
            yield h.tobytes(), b"", b""
        # one sum per text of everything that this task holds of it
        rid, doc = np.unique(p.rid, return_inverse=True)
        s = p.seating(i)
        ctx_tables = [p.tables(r, x) for r, x in enumerate(past)]
        states = s.run(past[:-1], ctx_tables)
        total = s.of_root(s.total, g["hot_total"])[p.pair_word]
        own = np.full(len(p.crowd), -1, dtype=np.int64)
        own[(p.crowd < 0) & (p.count > 0)] = np.arange(len(s.word))
        prob = s.predictive(states, past, ctx_tables, p.customers(g), np.where(total > 0, p.pair_word, -1), p.pair_ctx, own)
        prob[p.crowd >= 0] = crowd_p[p.crowd[p.crowd >= 0]]
        sums = np.stack([np.bincount(doc, weights=x.astype(float)[p.pair], minlength=len(rid))
                         for x in (total > 0, np.log10((total + 1) / (n + (v + 1))), np.log10(prob))])
        for lo in range(0, len(rid), 200_000):
            s = slice(lo, lo + 200_000)
            yield b"", rid[s].tobytes(), np.ascontiguousarray(sums[:, s]).tobytes()

    blobs = spark.createDataFrame(
        read().mapPartitionsWithIndex(score), "head binary, rid binary, sums binary", verifySchema=False)
    rows = blobs.mapInArrow(_unpack, RESULT)
    total = rows.groupBy("rid").agg(
        F.max("doc_id").alias("doc_id"), *[F.sum(x).alias(x) for x in ("n_tokens", "n_known", "base_score", "score")])
    return total.select(
        "doc_id", (fold(F.col("doc_id"), folds) == held).alias("held_out"), "n_tokens", "n_known",
        F.lit(fixed["N"]).cast("bigint").alias("train_tokens"), "base_score", "score")
