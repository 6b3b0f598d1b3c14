"""Operator 10: subword sampling without replacement by Gumbel top-k over the piece lattice.

A text becomes its pieces' lattice (a space is U+2581, one in front; a character without a piece falls
back to its UTF-8 bytes). The vocabulary is a public model file; that model's scores are merge ranks, so
a piece of rank r has the Zipf log probability -log(r + 2.7) up to a constant, and a byte the one
after the last rank. Backward log sums over the lattice give each edge's probability given its
node, so paths are drawn exactly in proportion to the product of their pieces' weights.

The search is A* on perturbed log probabilities, top down: the root's Gumbel is the best path's
value; at each node of a path the other edges together carry one Gumbel, located at the log mass
that leaves the path there and bounded by the node's own value. Popping the largest of these gives
the next path: it branches off at that node by an edge in proportion to mass and runs on freely.
The first k values popped are the k largest of the perturbed log probabilities of all
segmentations, so the k paths are distinct and sampled without replacement; with the (k+1)-th value
kappa, a path of log probability phi was included with probability 1 - exp(-exp(phi - kappa)),
given as a logarithm. All random numbers are hashes of (row key, path, word, position): a row's
samples depend on its key, text, seed and k alone. The key is the id and, where a copy column is given, the
number of the copy, so the copies of a mixed document get samples of their own.

Pieces never hold a U+2581 after another character, so the lattice falls apart at words; equal words
of a block share their lattice. Everything is vectorised over blocks of texts.

Defined results: a null or empty text has one segmentation without pieces (log probability 0);
a text with fewer than k segmentations has all of them; repeated rows with one key and text get equal
samples; a null id is the key of an empty id; texts are handled whole and a long one is a block
of its own; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm import textbytes as tb

SAMPLES = 2
SEED = 17
SPACE = 0x2581
RAW_SPACE = 0x110000  # a U+2581 of the text itself: no piece has it
BLOCK = 1 << 17
_U = np.uint64
_MUL = _U(0x9E3779B97F4A7C15 | 1)
NONE, PREFIX, BYTES = -3, -1, -2
#: a uniform has 53 bits, so a Gumbel is at most 38 above its location
REACH = 38.0
MARGIN = 120.0


@dataclass
class Vocabulary:
    """Pieces of a model as arrays: ids, weights, bytes, and a hash table of all prefixes."""

    weight: np.ndarray  # log weight by id
    piece_bytes: np.ndarray
    piece_start: np.ndarray  # by id, one more
    keys: np.ndarray
    vals: np.ndarray
    shift: int
    longest: int

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        worst = max(-sp.get_score(i) for i in range(n) if sp.get_score(i) > -1e8)
        weight = np.full(n, -np.inf)
        data, table = [], {}
        for i in range(n):
            text = sp.id_to_piece(i)
            if sp.is_byte(i):
                weight[i] = -np.log(worst + 256 + 2.7)
                data.append(bytes([int(text[3:5], 16)]))
                continue
            if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                data.append(b"")
                continue
            weight[i] = -np.log(min(-sp.get_score(i), worst) + 2.7)
            data.append(text.replace(chr(SPACE), " ").encode())
            if chr(SPACE) in text.lstrip(chr(SPACE)):
                continue  # would cross words
            h = 0
            for j, c in enumerate(text):
                h = (h * int(_MUL) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
                if j + 1 == len(text):
                    table[h] = i
                else:
                    table.setdefault(h, PREFIX)
        longest = max(len(sp.id_to_piece(i)) for i in range(n) if not sp.is_byte(i))
        weight -= np.log(np.exp(weight[np.isfinite(weight)]).sum())
        bits = int(np.ceil(np.log2(len(table) * 4)))
        keys, vals = np.zeros(1 << bits, dtype=np.uint64), np.full(1 << bits, NONE, dtype=np.int32)
        want = np.array(list(table), dtype=np.uint64)
        ids = np.array(list(table.values()), dtype=np.int32)
        slot = (tb.splitmix(want) >> _U(64 - bits)).astype(np.int64)
        for k, v, s in zip(want, ids, slot):
            while vals[s] != NONE:
                s = (s + 1) % len(keys)
            keys[s], vals[s] = k, v
        start = np.r_[0, np.cumsum([len(x) for x in data])]
        return cls(weight, np.frombuffer(b"".join(data), dtype=np.uint8), start, keys, vals, 64 - bits, longest)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Id of each hash, PREFIX for a prefix of pieces, NONE for neither."""
        slot = (tb.splitmix(h) >> _U(self.shift)).astype(np.int64)
        out = self.vals[slot]
        miss = np.flatnonzero((out != NONE) & (self.keys[slot] != h))
        while len(miss):
            slot[miss] = (slot[miss] + 1) % len(self.keys)
            out[miss] = self.vals[slot[miss]]
            miss = miss[(out[miss] != NONE) & (self.keys[slot[miss]] != h[miss])]
        return out


def _uniform(*parts) -> np.ndarray:
    """Uniforms in (0, 1) from hashes of whole numbers."""
    with np.errstate(over="ignore"):
        h = parts[0]
        for p in parts[1:]:
            h = tb.splitmix(h * _MUL + p)
        return ((h >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53


class _Lattice:
    """The lattices of a block's distinct words: probabilities of edges given their node.

    Words are ranked by falling length and nodes are numbered by the characters that remain (r) and
    then by rank: node = base[r] + rank. The nodes with r left are one slice, and so are their
    successors by any edge length, so the backward sums run over slices of plain arrays. Sums
    are kept in proportion only (rescaled now and then), which is all that edge probabilities need.
    """

    def __init__(self, voc: Vocabulary, sym: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        size = ends - starts
        n = len(size)
        order = np.argsort(-size, kind="stable")
        self.rank = np.empty(n, dtype=np.int64)
        self.rank[order] = np.arange(n)
        self.size = size
        top = int(size.max(initial=0))
        count = np.searchsorted(-size[order], -np.arange(1, top + 1), side="right")
        total = int(size.sum())
        self.base = np.r_[total, 0, np.cumsum(count)]  # base[0]: the ends
        first = np.r_[0, np.cumsum(size)]
        flat = sym[np.arange(total) - np.repeat(first[:-1] - starts, size)]
        left = np.repeat(first[1:], size) - np.arange(total)
        node = self.base[left] + np.repeat(self.rank, size)
        self.sym = np.empty(total, dtype=flat.dtype)
        self.sym[node] = flat
        self.left = np.repeat(np.arange(1, top + 1), count)
        live, h = np.arange(total), np.zeros(total, dtype=np.uint64)
        flat = flat.astype(np.uint64) + _U(1)
        found = []
        with np.errstate(over="ignore"):
            for j in range(voc.longest):
                ok = left[live] > j
                live, h = live[ok], h[ok]
                if not len(live):
                    break
                h = h * _MUL + flat[live + j]
                got = voc.find(h)
                hit = got >= 0
                found.append((node[live[hit]], got[hit]))
                more = got != NONE
                live, h = live[more], h[more]
        while len(found) > 1 and not len(found[-1][0]):
            found.pop()
        longest = max(1, len(found))  # no wider than the longest piece that occurs
        self.p = np.zeros((longest, total))
        self.id = np.full((longest, total), NONE, dtype=np.int32)
        plain = np.exp(voc.weight)
        for j, (at, got) in enumerate(found):
            self.id[j, at] = got
            self.p[j, at] = plain[got]
        lone = np.flatnonzero(self.id[0] < 0)  # no piece for the character: its bytes
        cp = self.sym[lone]
        cp = np.where(cp == RAW_SPACE, SPACE, cp)
        self.id[0, lone] = BYTES
        self.p[0, lone] = plain[3:259].max() ** (1.0 + (cp > 0x7F) + (cp > 0x7FF) + (cp > 0xFFFF))
        self.cdf = np.ones((longest, total), dtype=np.float32)
        beta = np.ones(total + n)
        for r in range(1, top + 1):
            k, lo = int(count[r - 1]), int(self.base[r])
            acc = np.zeros(k)
            m = min(r, longest)
            c = np.empty((m, k))
            for j in range(m):
                x = self.p[j, lo : lo + k]
                to = int(self.base[r - 1 - j])
                x *= beta[to : to + k]
                acc += x
                c[j] = acc
            self.p[:m, lo : lo + k] /= acc
            c /= acc
            c[c > 0.9999998] = 1  # rounding must leave no gap above the last possible edge
            self.cdf[:m, lo : lo + k] = c
            beta[lo : lo + k] = acc
            if r % 8 == 0:
                for j in range(min(r, longest) + 1):
                    to = int(self.base[r - j])
                    beta[to : to + k] /= acc


def _choose(lat: _Lattice, node: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Edge (length - 1) from each node by inverse distribution function."""
    e = np.zeros(len(node), dtype=np.int64)
    live = np.arange(len(node))
    for column in lat.cdf[:-1]:
        live = live[column[node[live]] < u[live]]
        if not len(live):
            break
        e[live] += 1
    return e


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """All indices of the ranges [start, start + count)."""
    off = np.r_[0, np.cumsum(count)]
    return np.arange(off[-1]) + np.repeat(start - off[:-1], count)


class _Paths:
    """Steps of one path per text, all texts of a block: arrays sorted by text and step."""

    def __init__(self, token, pos, edge, phi, rest, lost, doc, start):
        self.token, self.pos, self.edge, self.phi, self.rest, self.doc = token, pos, edge, phi, rest, doc
        self.lost, self.start = lost, start  # lost: bound of the log masses of nodes left out


def _walk(lat, seg, left, key, path, first_edge):
    """Run each word (its lattice ``seg``) from the node with ``left`` characters to its end.
    ``first_edge``: a given first edge or -1."""
    n = len(seg)
    steps = []
    live, rank = np.arange(n), lat.rank[seg]
    with np.errstate(over="ignore"):
        key = key + _U(path) * _U(0xC2B2AE3D27D4EB4F)
        while len(live):
            pos = lat.base[left] + rank
            h = tb.splitmix(key + left.astype(np.uint64) * _MUL)
            e = _choose(lat, pos, ((h >> _U(40)).astype(np.float32) + np.float32(0.5)) * np.float32(2.0**-24))
            if first_edge is not None:
                e = np.where(first_edge >= 0, first_edge, e)
                first_edge = None
            steps.append((live, pos, e))
            left = left - e - 1
            go = np.flatnonzero(left)
            live, left, key, rank = live[go], left[go], key[go], rank[go]
    if not steps:
        z = np.zeros(0, dtype=np.int64)
        return z, z, z
    count = np.zeros(n, dtype=np.int64)
    for live, _, _ in steps:
        count[live] += 1
    at = np.r_[0, np.cumsum(count)]  # by word, steps in their order
    out_pos, out_edge = np.empty(at[-1], dtype=np.int64), np.empty(at[-1], dtype=np.int64)
    for t, (live, where, e) in enumerate(steps):
        to = at[live] + t
        out_pos[to], out_edge[to] = where, e
    return np.repeat(np.arange(n), count), out_pos, out_edge


def _bounded(phi: np.ndarray, top: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel at location phi given that it is at most top."""
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        out = phi - np.log(np.exp(phi - top) - np.log(u))
    return np.where(np.isneginf(phi), -np.inf, np.minimum(out, top))


def _cumulated(logp: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Log probability of the path before each step, summed text by text."""
    c = np.r_[0.0, np.cumsum(logp)]
    start = np.searchsorted(doc, np.arange(n_docs))
    return c[:-1] - c[start][doc]


class _TooNarrow(Exception):
    """A node that was left out might have carried one of the values."""


def sample_block(voc: Vocabulary, data: bytes, offs: np.ndarray, key: np.ndarray, k: int, seed: int) -> list:
    """All of ``_sample``. Nodes whose log mass is ``MARGIN`` below their path's start cannot win
    unless the values found fall that low, which is checked; then all nodes are looked at."""
    try:
        return list(_sample(voc, data, offs, key, k, seed, MARGIN))
    except _TooNarrow:
        return list(_sample(voc, data, offs, key, k, seed, np.inf))


def _sample(voc: Vocabulary, data: bytes, offs: np.ndarray, key: np.ndarray, k: int, seed: int, margin: float):
    """Yields (path number, per-text validity, log probability, value, ids, offsets of texts in ids); and
    at the end kappa per text as (None, kappa)."""
    n_docs = len(offs) - 1
    text = data.decode("utf-8")
    raw = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    lead = (np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80
    chars = np.r_[0, np.cumsum(lead)][offs]  # texts' starts in characters
    size = np.diff(chars)
    has = size > 0
    doc_of = np.repeat(np.arange(n_docs), size)
    shift = np.cumsum(has)  # one space in front of each text that isn't empty
    sym = np.full(len(raw) + int(has.sum()), SPACE, dtype=np.uint32)
    sym[np.arange(len(raw)) + shift[doc_of]] = np.where(raw == 32, SPACE, np.where(raw == SPACE, RAW_SPACE, raw))
    begin = chars[:-1] + shift - has  # of texts in sym
    length = size + has
    # words: from a space after another character to the next
    sdoc = np.repeat(np.arange(n_docs), length)
    space = sym == SPACE
    start = space & ~np.r_[False, space[:-1]]
    start[begin[has]] = True
    starts = np.flatnonzero(start)
    ends = np.r_[starts[1:], len(sym)] if len(starts) else starts
    tdoc = sdoc[starts]
    p, inv = tb._powers(len(sym) + 1)
    with np.errstate(over="ignore"):
        pre = np.r_[_U(0), np.cumsum(tb.splitmix(sym.astype(np.uint64) + _U(5)) * p[: len(sym)], dtype=np.uint64)]
        wh = tb.splitmix((pre[ends] - pre[starts]) * inv[starts] + (ends - starts).astype(np.uint64))
    _, one, tok_seg = np.unique(wh, return_index=True, return_inverse=True)
    lat = _Lattice(voc, sym, starts[one], ends[one])
    tok_start = np.searchsorted(tdoc, np.arange(n_docs + 1))
    word_no = (np.arange(len(tdoc)) - tok_start[tdoc])
    tkey = _mixed(key, seed)[tdoc] if len(tdoc) else np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        wkey = tb.splitmix(tkey + word_no.astype(np.uint64) * _U(0xD1342543DE82EF95))
        dkey = _mixed(key, seed + 1)

    def finish(path_no, token, pos, edge, doc, fresh_from, top):
        lp = np.log(lat.p[edge, pos])
        phi = _cumulated(lp, doc, n_docs)
        at = np.searchsorted(doc, np.arange(n_docs + 1))
        total = np.bincount(doc, weights=lp, minlength=n_docs).astype(float)  # whole numbers when empty
        rest = np.full(len(doc), -np.inf)  # nodes before the branch belong to earlier paths
        floor = np.full(n_docs, -np.inf)
        some = at[:-1] + fresh_from < at[1:]
        floor[some] = phi[(at[:-1] + fresh_from)[some]] - margin
        step = np.arange(len(doc)) - at[:-1][doc]
        fresh = step >= fresh_from[doc]
        near = phi >= floor[doc]
        keep = np.flatnonzero(fresh & near)
        lost = np.where(np.bincount(doc[fresh & ~near], minlength=n_docs) > 0, floor, -np.inf)
        out = -np.expm1(lp[keep])
        with np.errstate(divide="ignore"):
            loc = phi[keep] + np.where(out > 1e-12, np.log(out), -np.inf)
        rest[keep] = _bounded(loc, top[doc[keep]], _uniform(dkey[doc[keep]], _U(1000 + path_no), step[keep].astype(np.uint64)))
        return _Paths(token, pos, edge, phi, rest, lost, doc, at), total

    top = -np.log(-np.log(_uniform(dkey, _U(77))))
    idx, pos, edge = _walk(lat, tok_seg, lat.size[tok_seg], wkey, 0, None) if len(tdoc) else (np.zeros(0, dtype=np.int64),) * 3
    path, total = finish(0, idx, pos, edge, tdoc[idx], np.zeros(n_docs, dtype=np.int64), top)
    paths, used = [path], {}
    valid = np.ones(n_docs, dtype=bool)
    yield 0, valid, total, top, *_ids(voc, lat, path, n_docs)
    for i in range(1, k + 1):
        best = np.full((len(paths), n_docs), -np.inf)
        for j, q in enumerate(paths):
            some = np.diff(q.start) > 0
            if len(q.rest):
                best[j, some] = np.maximum.reduceat(q.rest, q.start[:-1][some])
        value, owner = best.max(axis=0), best.argmax(axis=0)
        if (value < np.max([q.lost for q in paths], axis=0) + REACH).any():
            raise _TooNarrow
        if i == k:
            yield None, value
            return
        valid = np.isfinite(value)
        if not valid.any():
            yield i, valid, np.zeros(n_docs), value, np.zeros(0, np.int32), np.zeros(n_docs + 1, np.int64)
            continue
        parts = []
        fresh = np.zeros(n_docs, dtype=np.int64)
        for j, q in enumerate(paths):
            docs = np.flatnonzero(valid & (owner == j))
            if not len(docs):
                continue
            hit = np.flatnonzero(q.rest == value[q.doc])
            hit = hit[np.isin(q.doc[hit], docs)]
            node = hit[np.r_[True, q.doc[hit][1:] != q.doc[hit][:-1]]]  # one per text
            out = np.zeros((len(node), len(lat.p)), dtype=bool)
            out[np.arange(len(node)), q.edge[node]] = True
            for r, x in enumerate(node.tolist()):
                for e in used.get((j, x), ()):
                    out[r, e] = True
            mass = np.where(out, 0.0, lat.p[:, q.pos[node]].T)
            c = np.cumsum(mass, axis=1)
            u = _uniform(dkey[docs], _U(5000 + i), _U(j) + np.zeros(len(docs), np.uint64))
            e = np.minimum((c <= (u * c[:, -1])[:, None]).sum(axis=1), c.shape[1] - 1)
            for x, y in zip(node.tolist(), e.tolist()):
                used.setdefault((j, x), []).append(y)
            left = np.maximum(0.0, c[:, -1] - mass[np.arange(len(node)), e])
            with np.errstate(divide="ignore"):
                loc = q.phi[node] + np.where(left > 1e-12, np.log(left), -np.inf)
            q.rest[node] = _bounded(loc, value[docs], _uniform(dkey[docs], _U(9000 + i), _U(j) + np.zeros(len(docs), np.uint64)))
            before = node - q.start[docs]
            fresh[docs] = before + 1
            parts.append((docs, j, node, before, e))
        docs = np.concatenate([x[0] for x in parts])
        order = np.argsort(docs)
        docs = docs[order]
        owner_d = np.concatenate([np.full(len(x[0]), x[1]) for x in parts])[order]
        node, before, e = (np.concatenate([x[c] for x in parts])[order] for c in (2, 3, 4))
        base = np.r_[0, np.cumsum([len(q.pos) for q in paths])]
        flat = {c: np.concatenate([getattr(q, c) for q in paths]) for c in ("token", "pos", "edge")}
        g = base[owner_d]
        start = np.array([paths[o].start[d] for o, d in zip(owner_d.tolist(), docs.tolist())])
        pre = _ranges(g + start, before)
        # the branching word from its node by the new edge, later words from their start
        tok = flat["token"][g + node]
        later = _ranges(tok, tok_start[docs + 1] - tok)
        head = np.zeros(len(later), dtype=bool)
        head[np.r_[0, np.cumsum(tok_start[docs + 1] - tok)][:-1]] = True
        left0 = lat.size[tok_seg[later]]
        left0[head] = lat.left[flat["pos"][g + node]]
        given = np.full(len(later), -1)
        given[head] = e
        idx, pos, edge = _walk(lat, tok_seg[later], left0, wkey[later], i, given)
        ndoc = np.r_[np.repeat(docs, before), tdoc[later[idx]]]
        token = np.r_[flat["token"][pre], later[idx]]
        pos, edge = np.r_[flat["pos"][pre], pos], np.r_[flat["edge"][pre], edge]
        order = np.argsort(ndoc, kind="stable")
        path, total = finish(i, token[order], pos[order], edge[order], ndoc[order], fresh, value)
        paths.append(path)
        yield i, valid, total, value, *_ids(voc, lat, path, n_docs)


def _mixed(key: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return tb.splitmix(key + _U(seed) * _MUL)


def _ids(voc: Vocabulary, lat: _Lattice, path: _Paths, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all texts and each text's offset in them."""
    ids = lat.id[path.edge, path.pos]
    lone = np.flatnonzero(ids == BYTES)
    doc = path.doc
    if len(lone):
        cp = lat.sym[path.pos[lone]]
        raw = [chr(SPACE if c == RAW_SPACE else c).encode() for c in cp.tolist()]
        count = np.ones(len(ids), dtype=np.int64)
        count[lone] = [len(x) for x in raw]
        at = np.r_[0, np.cumsum(count)]
        out = np.repeat(ids, count)
        fill = _ranges(at[lone], count[lone])
        out[fill] = 3 + np.frombuffer(b"".join(raw), dtype=np.uint8).astype(np.int32)
        ids, doc = out, np.repeat(doc, count)
    return ids, np.searchsorted(doc, np.arange(n_docs + 1))


def decode_bytes(voc: Vocabulary, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of the pieces joined (spaces as spaces) and the offset of each piece in them."""
    n = voc.piece_start[ids + 1] - voc.piece_start[ids]
    return voc.piece_bytes[_ranges(voc.piece_start[ids], n)], np.r_[0, np.cumsum(n)]


def _equal_texts(voc, data, offs, ids, ptr) -> np.ndarray:
    """Whether each text's pieces decode to the text (the first space is not the text's own)."""
    out, at = decode_bytes(voc, ids)
    n = np.diff(offs)
    got = np.diff(at[ptr])
    same = got == n + (n > 0)
    good = np.flatnonzero(same & (n > 0))
    x = out[_ranges(at[ptr[:-1]][good] + 1, n[good])]
    y = np.frombuffer(data, dtype=np.uint8)[_ranges(offs[:-1][good], n[good])]
    wrong = np.bincount(np.repeat(good, n[good]), weights=x != y, minlength=len(n)) > 0
    return same & ~wrong


SCHEMA = "doc_id bigint, sample int, n_pieces bigint, log_prob double, perturbed double, log_inclusion double, decodes boolean, ids array<int>"


def _run(shared, k: int, seed: int, copies: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = shared.value
        for b in batches:
            for lo, hi, raw, offs in tb.blocks(b.column("text"), BLOCK):
                data = raw.tobytes()
                key = np.asarray(b.column("key").slice(lo, hi - lo)).view(np.uint64)
                ids_col = b.column("doc_id").slice(lo, hi - lo)
                copy_col = b.column("copy").slice(lo, hi - lo)
                found = sample_block(voc, data, offs, key, k, seed)
                kappa = found[-1][1]
                for number, valid, total, value, ids, ptr in found[:-1]:
                    pick = np.flatnonzero(valid)
                    ok = _equal_texts(voc, data, offs, ids, ptr)
                    with np.errstate(over="ignore", divide="ignore"):
                        gap = total - kappa
                        score = np.where(gap < -30, gap, np.log(-np.expm1(-np.exp(np.minimum(gap, 700)))))
                    n = np.diff(ptr)[pick]
                    flat = ids[_ranges(ptr[:-1][pick], n)]
                    yield pa.RecordBatch.from_arrays(
                        [ids_col.take(pa.array(pick)), pa.array(np.full(len(pick), number, np.int32)), pa.array(n), pa.array(total[pick]),
                         pa.array(value[pick]), pa.array(np.minimum(score[pick], 0.0)), pa.array(ok[pick]),
                         pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)].astype(np.int32)), pa.array(flat.astype(np.int32))),
                         *([copy_col.take(pa.array(pick))] if copies else [])],
                        names=[x.split()[0] for x in SCHEMA.split(", ")] + ["copy"] * copies)

    return run


def sample_segmentations(docs: DataFrame, model_path: str, k: int = SAMPLES, seed: int = SEED,
                         id_col: str = "doc_id", text_col: str = "text", copy_col: str | None = None) -> DataFrame:
    """Up to k rows per document, best perturbed value first: see SCHEMA, and ``copy`` where a copy column is given
    (copy 0 has the samples of a table without copies). The vocabulary (its size is the model file's) is read once
    on the driver and broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model_path))
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    copy = F.coalesce(F.col(copy_col).cast("int"), F.lit(0)) if copy_col else F.lit(0)
    key = F.when(copy == 0, F.xxhash64(ident)).otherwise(F.xxhash64(ident, copy))
    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), key.alias("key"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                    copy.alias("copy"))
    if copy_col is None:
        return d.mapInArrow(_run(shared, k, seed, False), SCHEMA)
    return d.mapInArrow(_run(shared, k, seed, True), SCHEMA + ", copy int")


def decode(encoded: DataFrame, model_path: str, ids_col: str = "ids") -> DataFrame:
    """encoded + ``decoded``: the text of the piece ids (bytes that are no UTF-8 become U+FFFD)."""
    shared = encoded.sparkSession.sparkContext.broadcast(Vocabulary.load(model_path))

    @F.arrow_udf("string")
    def text(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        voc = shared.value
        for lists in it:
            out = []
            for x in lists:
                ids = np.asarray(x.values) if x.is_valid else None
                if ids is None:
                    out.append(None)
                    continue
                s = decode_bytes(voc, ids.astype(np.int64))[0].tobytes().decode("utf-8", "replace")
                out.append(s.removeprefix(" "))
            yield pa.array(out, pa.string())

    return encoded.withColumn("decoded", text(F.col(ids_col)))
