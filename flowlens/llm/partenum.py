"""Operator 4: exact n-gram Jaccard join by PartEnum signatures (Arasu, Ganti, Kaushik, VLDB 2006).

A text's set holds its distinct n-word shingles. Set sizes are cut into bands whose ends differ
by the similarity; linked sets stand in the same or in neighbouring bands. For band i, sets of
bands i-1 and i that are similar enough differ in at most k shingles. The shingle domain is hashed
into first-level partitions and each of these into second-level parts; a signature is the hash
of what a set has in all but ``drop`` of the parts of one partition. With k // (drop+1) + 1 + e
partitions two such sets agree on a signature in e + 1 partitions at least. A set with empty
subsets in at most e partitions leaves the empty ones out, any other emits them too: the join
stays exact.

All sets sign by single partitions (drop 0). A group of one signature with at most LARGE sets
gives its pairs. The members of larger groups (they share a frequent passage, or are near copies
of each other) sign again on the part of the domain that is rare among them: equal non-empty
subsets then hold a rare shingle, so these groups are small by construction. Sets with too little
rare content (near copies of a text with very many copies) form families, connected by the large
groups they share, which are compared block by block; such a comparison gives out a spanning
forest of its links, never its pairs. Candidates are verified exactly on the sets, so no link
between different components is lost and the components are exact. Equal sets are one class
from the start.

Signatures travel packed, one row of arrays per block of texts and target partition. Shuffles and tables that are done
with are deleted between the steps.

Defined results: null or empty texts and texts without a word have the empty set and link with
nothing (a class of their own); repeated rows belong to one class; a row without an id belongs
to a class but never names it; an empty table gives an empty result; other columns are not read.
Sets are told apart by a 64-bit hash of their shingles' 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb, exp, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm import textbytes as tb
from flowlens.llm.common import connected_components, cut, release

_U = np.uint64
#: bits of the fixed-size candidate filter (it only saves work; an exact join follows)
FILTER_BITS = 1 << 22
#: slots in which shingles of large groups are counted (a bitmap of them is broadcast)
SLOTS = 1 << 24
#: slots of a piece of the domain whose counts travel as one row
SLOT_PIECE = 1 << 18
#: a signature group of more sets is large: its members sign again
LARGE = 16
#: most ids that are broadcast to the documents
BROADCAST_IDS = 200_000
#: least bits of a set's odd sketch
SKETCH = 1024
#: sets of a block when a family is compared block by block
BLOCK = 512


@dataclass(frozen=True)
class Scheme:
    """One PartEnum instance family: ``drop`` second-level parts of ``parts`` may differ in a
    first-level partition; ``spare`` gives extra first-level partitions for (k, lowest size)."""

    seed: int
    parts: int = 1
    drop: int = 0
    spare: str = "few"

    def partitions(self, k: int, low: int) -> tuple[int, int]:
        """(first-level partitions, how many of them may be spoiled by empty subsets)."""
        need = k // (self.drop + 1) + 1
        if self.spare == "many":
            return need + k + 2, k + 2
        e = 0
        while e <= k + 2:
            n = need + e
            filled = low / n * (self.parts - self.drop) / self.parts
            mean = n * min(1.0, comb(self.parts, self.drop) * exp(-filled))
            if mean < 2e-3 or mean + 2 * sqrt(mean) + 1 <= e:
                break
            e += 1
        return need + e, e


WEAK = Scheme(seed=1)
RARE = Scheme(seed=2, spare="many")


def bands(num: int, den: int, largest: int) -> list[tuple[int, int, int, int]]:
    """(lowest size, highest size, k, lowest size of the band before) up to ``largest``."""
    out = []
    lo = 1
    while lo <= largest or not out:
        hi = max(lo, lo * den // num)
        out.append((lo, hi, 2 * hi * (den - num) // (den + num), out[-1][0] if out else 1))
        lo = hi + 1
    return out


def set_hash(sh: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """64-bit hash of each row's set (order-free sum of mixed elements, then mixed with the size)."""
    with np.errstate(over="ignore"):
        c = np.r_[_U(0), np.cumsum(tb.splitmix(sh ^ _U(0x51ED2701)), dtype=np.uint64)]
        return tb.splitmix((c[ptr[1:]] - c[ptr[:-1]]) + np.diff(ptr).astype(np.uint64) * _U(0x2545F4914F6CDD1D))


def signatures(sh: np.ndarray, ptr: np.ndarray, num: int, den: int, scheme: Scheme, size: np.ndarray | None = None,
               empties: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signatures, row of each, rows with too many empty subsets) of the sets given in rows.

    ``size`` are the sizes of the whole sets where ``sh`` holds a part of the domain only.
    """
    held = np.diff(ptr)
    size = held if size is None else size
    top = int(size.max(initial=0))
    bound = bands(num, den, 4 + top * den * den // (num * num))
    highs = np.array([b[1] for b in bound])
    shape = np.array([scheme.partitions(k, before) for _, _, k, before in bound])
    k_of = np.array([b[2] for b in bound])
    own = np.searchsorted(highs, size)
    picks = list(combinations(range(scheme.parts), scheme.parts - scheme.drop))
    choose = np.zeros((scheme.parts, len(picks)), dtype=np.uint64)
    for j, p in enumerate(picks):
        choose[list(p), j] = 1
    elem_row = np.repeat(np.arange(len(size)), held)
    sigs, rows, over = [], [], np.zeros(len(size), dtype=bool)
    for step in (0, 1):  # a set signs for its own band and, for its larger partners, for the next one
        band = np.minimum(own + step, len(bound) - 1)
        ok = (size > 0) & (k_of[band] > 0)  # with k = 0 only equal sets link, and they are one class
        parts, spare = shape[band, 0] * ok, shape[band, 1]
        seed = tb.splitmix(band.astype(np.uint64) + _U(1000 * scheme.seed))
        keep = ok[elem_row]
        er = elem_row[keep]
        mixed = tb.splitmix(sh[keep] ^ seed[er])
        part = ((mixed >> _U(33)) % parts[er].astype(np.uint64)).astype(np.int64)
        base = np.r_[0, np.cumsum(parts)]
        slot = (base[er] + part) * scheme.parts + ((mixed & _U(0xFFFFFF)) % _U(scheme.parts)).astype(np.int64)
        order = np.argsort(slot, kind="stable")
        slot, val = slot[order], tb.splitmix(mixed[order] ^ _U(0xABCDEF12345))
        total = int(base[-1])
        acc = np.zeros(total * scheme.parts, dtype=np.uint64)
        some = np.zeros(total * scheme.parts, dtype=np.uint64)
        if len(slot):
            at = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
            acc[slot[at]] = np.add.reduceat(val, at)
            some[slot[at]] = 1
        with np.errstate(over="ignore"):
            acc = acc.reshape(total, scheme.parts) @ choose
            filled = (some.reshape(total, scheme.parts) @ choose) > 0
            owner = np.repeat(np.arange(len(size)), parts)
            spoiled = np.bincount(owner[~filled.all(axis=1)], minlength=len(size)) > spare
            over |= spoiled & ok
            index = (np.arange(total) - base[owner]).astype(np.uint64)
            tag = tb.splitmix(index * _U(0x9E37) + seed[owner])[:, None] + np.arange(len(picks), dtype=np.uint64) * _U(0x517CC1B727220A95)
            sig = tb.splitmix(acc + tag)
        emit = filled | (spoiled[owner][:, None] if empties else False)
        sigs.append(sig[emit])
        rows.append(np.broadcast_to(owner[:, None], emit.shape)[emit])
    return np.concatenate(sigs), np.concatenate(rows), over


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _classes(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offs in tb.blocks(b.column("text")):
                sh, ptr = tb.shingle_sets(tb.LOWER[data], offs, n)
                size = np.diff(ptr)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(lo, hi - lo), pa.array(size.astype(np.int64)),
                     pa.array(set_hash(sh, ptr).view(np.int64), mask=size == 0)],
                    names=["doc_id", "n_shingles", "cls"],
                )

    return run


PACKET = "part int, cls binary, size binary, sig binary, idx binary, over binary"


def _short(sig: np.ndarray) -> bytes:
    """The upper 48 bits of signatures (two that agree in them just meet as candidates)."""
    return (sig >> _U(32)).astype(np.uint32).tobytes() + ((sig >> _U(16)) & _U(0xFFFF)).astype(np.uint16).tobytes()


def _long(data) -> np.ndarray:
    n = len(data) // 6
    high, low = np.frombuffer(data, np.uint32, n), np.frombuffer(data, np.uint16, n, 4 * n)
    return (high.astype(np.uint64) << _U(32)) | (low.astype(np.uint64) << _U(16))


def _packets(sig: np.ndarray, cls: np.ndarray, size: np.ndarray, row: np.ndarray, parts: int,
             over: np.ndarray | None = None) -> pa.RecordBatch:
    """Signatures packed by the partition they go to: one row per partition with plain arrays.
    ``over`` are classes that one of the rows just hands through."""
    to = ((sig >> _U(16)) % _U(parts)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    sig, row, to = sig[order], row[order].astype(np.uint32), to[order]
    cut_at = np.flatnonzero(np.r_[True, to[1:] != to[:-1]]) if len(to) else np.zeros(0, dtype=np.int64)
    out = []
    for lo, hi in zip(cut_at, np.r_[cut_at[1:], len(to)]):
        used, idx = np.unique(row[lo:hi], return_inverse=True)
        small = np.uint16 if len(used) < 65536 else np.uint32
        out.append((int(to[lo]), cls[used].tobytes(), size[used].astype(np.uint32).tobytes(), _short(sig[lo:hi]), idx.astype(small).tobytes(), b""))
    if over is not None and len(over):
        out.append((int(over[0] % _U(parts)), b"", b"", b"", b"", over.tobytes()))
    return pa.RecordBatch.from_arrays(
        [pa.array([o[0] for o in out], pa.int32()), *[pa.array([o[i] for o in out], pa.binary()) for i in range(1, 6)]],
        names=["part", "cls", "size", "sig", "idx", "over"])


def _sign_texts(n: int, num: int, den: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()  # classes of this partition: copies sign once
        for b in batches:
            for _, _, data, offs in tb.blocks(b.column("text"), 2 * tb.BLOCK_BYTES):
                sh, ptr = tb.shingle_sets(tb.LOWER[data], offs, n)
                size, cls = np.diff(ptr), set_hash(sh, ptr)
                new = np.array([bool(k) and not (c in seen or seen.add(c)) for k, c in zip(size.tolist(), cls.tolist())], dtype=bool)
                if new.any():
                    sh, size, cls = sh[np.repeat(new, size)], size[new], cls[new]
                    sig, row, _ = signatures(sh, np.r_[0, np.cumsum(size)], num, den, WEAK)
                    yield _packets(sig, cls, size, row, parts)

    return run


def _sign_sets(num: int, den: int, parts: int, frequent):
    """Sets of large groups: sign on the rare part of the domain (any fixed part of the domain
    keeps the pigeonhole argument); sets with too little of it are handed through as ``over``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = frequent.value
        for b in batches:
            if not b.num_rows:
                continue
            items = [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in b.column("items")]
            cls = np.asarray(b.column("cls")).view(np.uint64)
            for lo in range(0, len(items), 256):
                part = items[lo : lo + 256]
                size = np.array([len(x) for x in part])
                sh, c = np.concatenate(part), cls[lo : lo + 256]
                ptr = np.r_[0, np.cumsum(size)]
                slot = (sh % _U(SLOTS)).astype(np.int64)
                rare = ((often[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1) == 0
                rptr = np.r_[0, np.cumsum(rare)][ptr]
                sig, row, over = signatures(sh[rare], rptr, num, den, RARE, size, empties=False)
                yield _packets(sig, c, size, row, parts, c[over])

    return run


def _groups(num: int, den: int):
    """All packets of a partition -> rows (sig, a, b): the pairs of small groups that can link by
    their sizes (sig null), each member a of a large group (b its group's smallest class), and
    classes handed through (only a)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sig, cls, size, over = [], [], [], []
        for b in batches:
            for i in range(b.num_rows):
                over.append(np.frombuffer(b.column("over")[i].as_buffer(), np.int64))
                if not len(b.column("sig")[i].as_buffer()):
                    continue
                c, k, s, x = (b.column(j)[i].as_buffer() for j in range(1, 5))
                c, k, s = np.frombuffer(c, np.int64), np.frombuffer(k, np.uint32), _long(s)
                x = np.frombuffer(x, np.uint16 if len(x) == 2 * len(s) else np.uint32)
                sig.append(s)
                cls.append(c[x])
                size.append(k[x])
        names = ["sig", "a", "b"]
        over = np.concatenate(over) if over else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(over), pa.int64()), pa.array(over), pa.nulls(len(over), pa.int64())], names=names)
        if not sig:
            return
        sig, cls, size = np.concatenate(sig), np.concatenate(cls), np.concatenate(size)
        order = np.argsort(sig, kind="stable")
        sig = sig[order]
        same = sig[1:] == sig[:-1]
        more = np.r_[same, False] | np.r_[False, same]
        order, sig = order[more], sig[more]
        order = order[np.lexsort((cls[order], sig))]
        cls, size, sig = cls[order], size[order], np.sort(sig)
        if len(sig):
            new = np.r_[True, (sig[1:] != sig[:-1]) | (cls[1:] != cls[:-1])]
            sig, cls, size = sig[new], cls[new], size[new].astype(np.int64)
        first = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]]) if len(sig) else np.zeros(0, dtype=np.int64)
        length = np.diff(np.r_[first, len(sig)])
        small = np.repeat(length <= LARGE, length)
        found = np.zeros((0, 2), dtype=np.int64)
        s_sig, s_cls, s_size = sig[small], cls[small], size[small]
        for gap in range(1, LARGE):
            if gap >= len(s_sig):
                break
            hit = np.flatnonzero(s_sig[gap:] == s_sig[:-gap])
            x, y = s_size[hit], s_size[hit + gap]
            hit = hit[(x * den >= y * num) & (y * den >= x * num)]
            found = np.unique(np.r_[found, np.c_[s_cls[hit], s_cls[hit + gap]]], axis=0)
        big = ~small
        pivot = np.repeat(cls[first] if len(first) else cls[:0], length)[big]
        k = len(found)
        for lo in range(0, max(1, k), 100_000):
            part = found[lo : lo + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(part), pa.int64()), pa.array(np.ascontiguousarray(part[:, 0])), pa.array(np.ascontiguousarray(part[:, 1]))],
                names=names)
        for lo in range(0, int(big.sum()), 100_000):
            at = slice(lo, lo + 100_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(sig[big][at].view(np.int64)), pa.array(cls[big][at]), pa.array(pivot[at])], names=names)

    return run


def _forest(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Of links between local numbers, those that join two trees."""
    parent: dict = {}

    def root(i):
        while parent.setdefault(i, i) != i:
            parent[i] = i = parent[parent[i]]
        return i

    keep = []
    for k, (i, j) in enumerate(zip(x.tolist(), y.tolist())):
        i, j = root(i), root(j)
        if i != j:
            parent[i] = j
            keep.append(k)
    return np.array(keep, dtype=np.int64)


def _block_links(num: int, den: int):
    """Two blocks of one family (or one block with itself): a spanning forest of their links.
    Common shingles are counted by one matrix product over the shingles that both blocks hold."""

    def run(group: pa.Table) -> pa.Table:
        block = np.asarray(group["block"])
        cls = np.asarray(group["cls"])
        items = [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in group["items"].combine_chunks()]
        left = np.flatnonzero(block == block.min())
        right = left if block.min() == block.max() else np.flatnonzero(block == block.max())
        size = np.array([len(x) for x in items])
        hold = [np.concatenate([items[i] for i in side]) for side in (left, right)]
        domain = np.intersect1d(*hold)
        if left is right:
            u, c = np.unique(hold[0], return_counts=True)
            domain = u[c > 1]
        found = [np.zeros(0, np.int64)] * 2
        if len(domain):
            both = np.zeros((len(left), len(right)), dtype=np.float32)
            for lo in range(0, len(domain), 8192):
                part = domain[lo : lo + 8192]
                mats = []
                for side, flat in zip((left, right), hold):
                    m = np.zeros((len(side), len(part)), dtype=np.float32)
                    at = np.minimum(np.searchsorted(part, flat), len(part) - 1)
                    hit = part[at] == flat
                    m[np.repeat(np.arange(len(side)), size[side])[hit], at[hit]] = 1
                    mats.append(m)
                both += mats[0] @ mats[1].T
            both = both.astype(np.int64)
            ok = den * both >= num * (size[left][:, None] + size[right][None, :] - both)
            x, y = np.nonzero(ok)
            x, y = left[x], right[y]
            x, y = x[x != y], y[x != y]
            keep = _forest(x, y)
            found = [x[keep], y[keep]]
        return pa.table({"a": pa.array(cls[found[0]]), "b": pa.array(cls[found[1]])})

    return run


def family_links(sets: DataFrame, family: DataFrame, num: int, den: int) -> DataFrame:
    """Links that keep the components of all pairs inside each family (cls, family).

    A family is cut into blocks of about BLOCK sets and each pair of blocks is one task's small
    group: all pairs are looked at, none but forest links are given out.
    """
    many = cut(family.groupBy("family").agg(F.count(F.lit(1)).alias("size")).where("size > 1"))
    member = family.join(many, "family").withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    member = member.withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    spread = member.select(
        "cls", "family", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    spread = spread.select("cls", "block", "family", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    used = sets.select("cls", "items").join(_small(cut(member.select("cls"))), "cls", "left_semi")
    rows = used.join(spread, "cls")
    return cut(
        rows.select("family", "i", "j", "block", "cls", "items").groupBy("family", "i", "j")
        .applyInArrow(_block_links(num, den), "a bigint, b bigint")
    )


def _slot_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each slot of the shingle domain occurs in this partition's sets, packed: one row of plain arrays per piece of
    the domain. Counts end at LARGE + 1, all that the sum is asked for, so a partition holds one byte per slot."""
    total = np.zeros(SLOTS, dtype=np.uint8)
    for b in batches:
        items = [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in b.column("items")]
        if items:
            slot, count = np.unique((np.concatenate(items) % _U(SLOTS)).astype(np.int32), return_counts=True)
            total[slot] = np.minimum(count + total[slot], LARGE + 1)
    for piece, part in enumerate(total.reshape(-1, SLOT_PIECE)):
        at = np.flatnonzero(part)
        if len(at):
            yield pa.RecordBatch.from_arrays(
                [pa.array([piece], pa.int32()), pa.array([at.astype(np.uint32).tobytes()], pa.binary()), pa.array([part[at].tobytes()], pa.binary())],
                names=["piece", "slots", "counts"])


def _often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All packed counts of some pieces -> a bitmap per piece of the slots that occur more than LARGE times."""
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for piece, slots, counts in zip(b.column("piece").to_pylist(), b.column("slots"), b.column("counts")):
            at, count = np.frombuffer(slots.as_buffer(), np.uint32), np.frombuffer(counts.as_buffer(), np.uint8)
            sums = total.setdefault(piece, np.zeros(SLOT_PIECE, dtype=np.uint8))
            sums[at] = np.minimum(sums[at] + count, LARGE + 1)  # at most 2 * (LARGE + 1) before the minimum
    for piece, sums in total.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([piece], pa.int32()), pa.array([np.packbits(sums > LARGE, bitorder="little").tobytes()], pa.binary())],
            names=["piece", "bits"])


def frequent_slots(sets: DataFrame) -> np.ndarray:
    """Bitmap of the slots that more than LARGE of the sets' shingles fall into; the driver gets SLOTS / 8 bytes at most."""
    packed = sets.select("items").mapInArrow(_slot_counts, "piece int, slots binary, counts binary")
    out = np.zeros(SLOTS // 8, dtype=np.uint8)
    for r in packed.repartition("piece").mapInArrow(_often, "piece int, bits binary").collect():
        lo = r.piece * SLOT_PIECE // 8
        out[lo : lo + SLOT_PIECE // 8] = np.frombuffer(r.bits, dtype=np.uint8)
    return out


def _sketches(sh: np.ndarray, ptr: np.ndarray) -> list[bytes]:
    """Odd sketches: every element toggles one bit. Two sets differ in at least as many elements as their sketches
    differ in bits. A sketch has SKETCH bits, or the power of two that holds a larger set's size (else it would be full)."""
    size = np.diff(ptr)
    width = SKETCH << np.maximum(0, np.ceil(np.log2(np.maximum(size, 1) / SKETCH))).astype(np.int64)
    base = np.r_[0, np.cumsum(width)]
    row = np.repeat(np.arange(len(size)), size)
    bit = (tb.splitmix(sh ^ _U(0x0DD)) & (width[row] - 1).astype(np.uint64)).astype(np.int64)
    odd = np.packbits((np.bincount(base[row] + bit, minlength=int(base[-1])) & 1).astype(np.uint8), bitorder="little")
    return [odd[lo:hi].tobytes() for lo, hi in zip(base[:-1] // 8, base[1:] // 8)]


def _folded(sketch: np.ndarray, width: int) -> np.ndarray:
    """Sketches (one per row) as they are at a smaller power of two of bytes: bits that fall together toggle each other."""
    while sketch.shape[1] > width:
        half = sketch.shape[1] // 2
        sketch = sketch[:, :half] ^ sketch[:, half:]
    return sketch


def _may_link(num: int, den: int):
    """Drops pairs whose sketches differ in more bits than similar sets of their sizes can in elements."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x, y = b.column("a_sketch").to_pylist(), b.column("b_sketch").to_pylist()
            long_ = np.array([(len(i), len(j)) for i, j in zip(x, y)])
            bits = np.zeros(b.num_rows, dtype=np.int64)
            for shape in np.unique(long_, axis=0):
                at = np.flatnonzero((long_ == shape).all(axis=1))
                left, right = (_folded(np.frombuffer(b"".join(side[i] for i in at), np.uint8).reshape(len(at), -1), int(shape.min()))
                               for side in (x, y))
                bits[at] = np.bitwise_count(left ^ right).sum(axis=1, dtype=np.int64)
            size = np.asarray(b.column("a_n")) + np.asarray(b.column("b_n"))
            pick = pa.array(np.flatnonzero(bits * (den + num) <= (den - num) * size))
            yield pa.RecordBatch.from_arrays([b.column("a").take(pick), b.column("b").take(pick)], names=["a", "b"])

    return run


def _candidates(n: int, wanted_bits, whole: bool):
    """(cls, n, sketch, items) of the sets whose slot is marked; items only with ``whole``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = wanted_bits.value
        seen: set = set()
        for b in batches:
            for _, _, data, offs in tb.blocks(b.column("text")):
                sh, ptr = tb.shingle_sets(tb.LOWER[data], offs, n)
                size, cls = np.diff(ptr), set_hash(sh, ptr)
                slot = (cls % _U(FILTER_BITS)).astype(np.int64)
                ok = (size > 0) & ((wanted[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1).astype(bool)
                pick = [i for i in np.flatnonzero(ok).tolist() if not (int(cls[i]) in seen or seen.add(int(cls[i])))]
                if not pick:
                    continue
                toggled = None if whole else _sketches(sh, ptr)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cls[pick].view(np.int64)), pa.array(size[pick].astype(np.int64)),
                     pa.array([None if whole else toggled[i] for i in pick], pa.binary()),
                     pa.array([sh[ptr[i] : ptr[i + 1]].tobytes() if whole else None for i in pick], pa.binary())],
                    names=["cls", "n", "sketch", "items"])

    return run


def _verify(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a, c = b.column("a_items"), b.column("b_items")
            keep = np.zeros(b.num_rows, dtype=bool)
            for i in range(b.num_rows):
                x = np.frombuffer(a[i].as_buffer(), dtype=np.uint64)
                y = np.frombuffer(c[i].as_buffer(), dtype=np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                keep[i] = den * both >= num * (len(x) + len(y) - both)
            pick = pa.array(np.flatnonzero(keep))
            yield pa.RecordBatch.from_arrays([b.column("a").take(pick), b.column("b").take(pick)], names=["a", "b"])

    return run


def _bitmap(slots: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of ``bits`` bits from a column ``slot`` of slot numbers below ``bits``. Spark sets the bits, in pieces of
    4 KB; the driver gets the pieces, bits / 8 bytes at most however many slots are named."""
    at = F.col("slot") + 1  # Spark numbers bits from 1
    pieces = slots.groupBy(F.bitmap_bucket_number(at).alias("piece")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    out = np.zeros(bits // 8, dtype=np.uint8)
    for r in pieces.collect():
        lo = (r.piece - 1) * len(r.bits)
        out[lo : lo + len(r.bits)] = np.frombuffer(r.bits, dtype=np.uint8)
    return out


def _sketch_near(short: DataFrame, pairs: DataFrame, num: int, den: int) -> DataFrame:
    """The (a, b) class pairs that their sketches let pass."""
    near = pairs.join(short.select(*[F.col(c).alias(d) for c, d in (("cls", "b"), ("n", "b_n"), ("sketch", "b_sketch"))]), "b").join(
        short.select(*[F.col(c).alias(d) for c, d in (("cls", "a"), ("n", "a_n"), ("sketch", "a_sketch"))]), "a")
    return release(cut(near.select("a", "b", "a_n", "b_n", "a_sketch", "b_sketch").mapInArrow(_may_link(num, den), "a bigint, b bigint")))


def _links(sets: DataFrame, pairs: DataFrame, num: int, den: int) -> DataFrame:
    """Of (a, b) class pairs those whose sets are similar enough."""
    ids = cut(pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct())
    used = sets.select("cls", "items").join(_small(ids), "cls", "left_semi")
    one = pairs.join(used.select(F.col("cls").alias("b"), F.col("items").alias("b_items")), "b")
    two = one.join(used.select(F.col("cls").alias("a"), F.col("items").alias("a_items")), "a")
    return release(cut(two.select("a", "b", "a_items", "b_items").mapInArrow(_verify(num, den), "a bigint, b bigint")))


def jaccard_classes(docs: DataFrame, n: int = 3, num: int = 90, den: int = 100,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) per row; two texts link when den*|A and B| >= num*|A or B|."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    texts = docs.select("text")
    found = "sig bigint, a bigint, b bigint"

    def grouped(packets: DataFrame) -> DataFrame:
        return release(cut(packets.repartitionById(parts, F.col("part")).mapInArrow(_groups(num, den), found)))

    rows = cut(docs.mapInArrow(_classes(n), "doc_id bigint, n_shingles bigint, cls bigint"))
    weak = grouped(texts.mapInArrow(_sign_texts(n, num, den, parts), PACKET))
    pairs = cut(weak.where("sig is null").select("a", "b").distinct())
    large = cut(weak.where("sig is not null").select(F.col("a").alias("cls")).distinct())

    def candidates(ids: DataFrame, whole: bool) -> DataFrame:
        """Of the sets named by ids (and few others: a filter of fixed size saves most the way)."""
        slot = F.col("cls").bitwiseAND(F.lit(FILTER_BITS - 1))
        wanted = sc.broadcast(_bitmap(ids.select(slot.alias("slot")), FILTER_BITS))
        some = texts.mapInArrow(_candidates(n, wanted, whole), "cls bigint, n bigint, sketch binary, items binary")
        return release(cut(some.dropDuplicates(["cls"])))

    def members(of: DataFrame) -> DataFrame:
        return of.select(F.explode(F.array("a", "b")).alias("cls"))

    # sketches of all candidates, then the sets of those that are left
    short = candidates(members(pairs).unionByName(large), False)
    pairs = _sketch_near(short, pairs, num, den)
    sets = candidates(members(pairs).unionByName(large), True)

    # members of large groups: sign again on the shingles that are rare among them
    crowd = sets.select("cls", "items").join(_small(large), "cls", "left_semi")
    frequent = sc.broadcast(frequent_slots(crowd))
    again = grouped(crowd.mapInArrow(_sign_sets(num, den, parts, frequent), PACKET))

    rare = _sketch_near(short, cut(again.where("b is not null").select("a", "b").distinct()), num, den)
    del short
    links = _links(sets, cut(pairs.unionByName(rare).distinct()), num, den)
    del pairs, rare

    # sets with hardly any rare content: those that share a large group form families
    over = cut(again.where("b is null").select(F.col("a").alias("cls")).distinct())
    dense = cut(weak.where("sig is not null").select("sig", F.col("a").alias("cls")).join(over, "cls", "left_semi"))
    lead = cut(dense.groupBy("sig").agg(F.min("cls").alias("lead")))
    touch = dense.join(lead, "sig").select(F.col("lead").alias("u"), F.col("cls").alias("v"))
    family = connected_components(touch).withColumnsRenamed({"node": "cls", "component": "family"})
    del again, weak, dense, crowd
    links = links.unionByName(family_links(sets, cut(family), num, den))
    del sets, over, touch
    release(docs)
    comp = cut(connected_components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))))
    named = cut(rows.join(comp.withColumnRenamed("node", "cls"), "cls", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "cls").alias("cls")))
    least = cut(named.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("least")))
    return named.join(least, "cls", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def keep_one(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The documents with one row left of each class (its smallest doc_id; of rows that repeat
    that id, one). Texts without a word and rows without an id are kept: they link with nothing.
    """
    cls = jaccard_classes(docs, n, num, den)
    drop = _small(cut(cls.where("doc_id <> component_id").select("doc_id").distinct()))
    twice = cut(cls.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("doc_id"))
    kept = docs.join(drop, "doc_id", "left_anti")
    if twice.isEmpty():
        return kept.select(*docs.columns)
    few = _small(twice)
    again = kept.join(few, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.join(few, "doc_id", "left_anti").unionByName(again).select(*docs.columns)


def _small(ids: DataFrame) -> DataFrame:
    """A table of ids, to be broadcast when its count allows it (else Spark joins by shuffle)."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
