"""Operator 11: removal of byte strings that occur twice, by suffix buckets and difference-cover ranks.

``LENGTH``-byte strings that start at two places of the table (in one text or two) are found exactly, and every byte they
cover goes. The suffixes of all texts, each compared over its first ``LENGTH`` bytes, are sorted one bucket at a time:

1. Buckets. A suffix belongs to the bucket of its anchor, the ``WIDTH``-byte string of least hash within
   its first ``LENGTH`` bytes (the leftmost on a tie). Equal suffixes have equal anchors at equal distances, and
   neighbouring suffixes mostly share one, so a run of suffixes is one row: the anchor's hash, the place, and a 128-bit
   hash of all bytes the run spans. One aggregate drops the buckets with a single place, which is nearly all of
   clean text; a run whose bytes occur again elsewhere is repeated as a whole and needs no sorting.
2. Long ties. What is left are runs that share an anchor and differ near it. Their bytes are fetched, one copy of each
   distinct run, and split by the strings that all their suffixes have in common, again and again while a bucket is
   above ``BUCKET_RUNS``, so none is too large for a task, whatever the text.
3. Within a task the buckets are sorted a few megabytes at a time. Suffixes are first told apart by their first and
   last bytes. The ties, equal over that many bytes, are resolved by ranks: the positions whose residue modulo ``PERIOD``
   lies in a difference cover are ranked beforehand by ``4 * PERIOD`` bytes (by doubling, as position + PERIOD is in
   the sample too), and any two suffixes reach such a pair of sample positions after the same 0 to
   PERIOD - 1 bytes. A three-way quicksort over these ranks leaves the groups of equal suffixes, whose ends are compared
   byte by byte.

Only hashes and places are shuffled at first, then the texts that hold ties, and at last the texts with their spans.
Copies of a whole text are found by their digest; they enter the aggregates as one place.

Defined results: a null text is empty; texts under ``LENGTH`` bytes keep all; repeated rows are copies of each other
(each loses all its bytes when long enough); null doc_ids are fine; an empty table gives no rows. Columns other than
doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm import textbytes as tb
from flowlens.llm.common import cut

LENGTH = 400
WIDTH = 128
REACH = LENGTH - WIDTH + 1

#: starts of suffixes that one block of a scan holds; a longer text is scanned in overlapping pieces
SCAN_BYTES = 1 << 18
#: most runs of a bucket that a task sorts; larger ones are split first
BUCKET_RUNS = 4096
#: bytes of runs that are sorted together
SORT_BYTES = 1 << 21
#: suffixes of a run are split into spans of so many distances from the anchor, level by level
LEVELS = [137, 35, 9, 1]

#: A perfect difference set, every difference modulo 73 is one of two of its elements
PERIOD = 73
COVER = [1, 2, 4, 8, 16, 32, 37, 55, 64]

_U = np.uint64
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _shifts() -> np.ndarray:
    """[r, s]: least d such that r + d and s + d both lie in the cover (modulo PERIOD)."""
    inside = np.zeros(PERIOD, dtype=bool)
    inside[[c % PERIOD for c in COVER]] = True
    out = np.full((PERIOD, PERIOD), -1, dtype=np.int64)
    r, s = np.indices(out.shape)
    for d in reversed(range(PERIOD)):
        out[inside[(r + d) % PERIOD] & inside[(s + d) % PERIOD]] = d
    return out


SHIFT = _shifts()
IN_COVER = SHIFT.diagonal() == 0


class _Hasher:
    """Polynomial hashes of spans of one block under two bases."""

    powers: list[tuple[np.ndarray, np.ndarray]] = []

    def __init__(self, data: np.ndarray) -> None:
        size = SCAN_BYTES + 2 * LENGTH + 1
        if not self.powers:
            for b in _BASES:
                self.powers.append(tuple(
                    np.cumprod(np.r_[_U(1), np.full(size, _U(x), dtype=np.uint64)], dtype=np.uint64) for x in (b, pow(b, -1, 1 << 64))))
        coded = tb._BYTE[data]
        self.prefix = []
        for p, _ in self.powers:
            out = np.zeros(len(data) + 1, dtype=np.uint64)
            np.cumsum(coded * p[: len(data)], out=out[1:])
            self.prefix.append(out)

    def spans(self, k: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        f, inv = self.prefix[k], self.powers[k][1]
        return tb.splitmix((f[ends] - f[starts]) * inv[starts] + (ends - starts).astype(np.uint64))

    def each(self, width: int) -> np.ndarray:
        f, inv = self.prefix[0], self.powers[0][1]
        n = len(f) - width
        return tb.splitmix((f[width:] - f[:n]) * inv[:n] + _U(width))


def _least(key: np.ndarray, reach: int) -> np.ndarray:
    """Minimum of each ``reach`` consecutive values, by running minima from block borders."""
    n = len(key) - reach + 1
    padded = np.full(-(-len(key) // reach) * reach, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(key)] = key
    square = padded.reshape(-1, reach)
    ahead = np.minimum.accumulate(square, axis=1).ravel()
    back = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[reach - 1 : reach - 1 + n])


def runs(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of suffixes with one anchor in a block of texts: (text, anchor, first start, last start, name, hash 1, hash 2).

    Positions are those of the block. A suffix is a start with ``LENGTH`` bytes left in its text.
    """
    none = np.zeros(0, dtype=np.int64)
    if len(data) < LENGTH:
        return none, none, none, none, none, none, none
    with np.errstate(over="ignore"):
        h = _Hasher(data)
        each = h.each(WIDTH)
        low = _U((1 << 24) - 1)
        anchor = (_least((each & ~low) | np.arange(len(each), dtype=np.uint64), REACH) & low).astype(np.int64)
        row = np.repeat(np.arange(len(offs) - 1), np.diff(offs))[: len(anchor)]
        start = np.flatnonzero(np.arange(len(anchor)) + LENGTH <= offs[row + 1])
        anchor, row = anchor[start], row[start]
        if not len(start):
            return none, none, none, none, none, none, none
        begin = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])])
        lo, hi, at = start[begin], start[np.r_[begin[1:] - 1, len(start) - 1]], anchor[begin]
        return row[begin], at, lo, hi, each[at].view(np.int64), h.spans(0, lo, hi + LENGTH).view(np.int64), h.spans(1, lo, hi + LENGTH).view(np.int64)


def _pieces(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(row, base, bytes, offsets) of blocks of texts, long ones in pieces that overlap by LENGTH - 1 bytes."""
    for lo, hi, data, offs in tb.blocks(texts, SCAN_BYTES):
        if len(data) <= SCAN_BYTES:
            yield np.arange(lo, hi), np.zeros(hi - lo, dtype=np.int64), data, offs
            continue
        for base in range(0, max(1, len(data) - LENGTH + 1), SCAN_BYTES):  # one long text
            part = data[base : base + SCAN_BYTES + LENGTH - 1]
            yield np.array([lo]), np.array([base]), part, np.array([0, len(part)])


SCAN = "name bigint, s1 bigint, s2 bigint, tid binary, place bigint"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow body: (tid, text) -> a row per run; place = anchor * 2**18 + (anchor - first) * 2**9 + (anchor - last)."""
    for b in batches:
        tid = b.column(0)
        for rows, base, data, offs in _pieces(b.column(1)):
            row, at, lo, hi, name, s1, s2 = runs(data, offs)
            if len(row):
                place = ((at - offs[row] + base[row]) << 18) | ((at - lo) << 9) | (at - hi)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(name), pa.array(s1), pa.array(s2), tid.take(pa.array(rows[row])), pa.array(place)],
                    names=["name", "s1", "s2", "tid", "place"])


RUN = "tid binary, p bigint, a int, b int, again boolean, bytes binary"


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow body: (tid, text, [(place, again)]) -> the bytes of the runs asked for."""
    for b in batches:
        for tid, text, places in zip(*(c.to_pylist() for c in b.columns)):
            data = text.encode()
            p = [x["place"] >> 18 for x in places]
            back = [(x["place"] >> 9) & 511 for x in places]
            near = [x["place"] & 511 for x in places]
            for k in range(0, len(p), 4096):
                s = slice(k, k + 4096)
                cut_out = [data[q - y : q - x + LENGTH] for q, x, y in zip(p[s], near[s], back[s])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([tid] * len(cut_out), pa.binary()), pa.array(p[s], pa.int64()), pa.array(near[s], pa.int32()),
                     pa.array(back[s], pa.int32()), pa.array([x["again"] for x in places[s]]), pa.array(cut_out, pa.binary())],
                    names=["tid", "p", "a", "b", "again", "bytes"])


def _dense(*columns: np.ndarray) -> np.ndarray:
    """Rank of each row among the distinct rows, in order."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), dtype=bool)
    for c in columns:
        s = c[order]
        new[1:] |= s[1:] != s[:-1]
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.cumsum(new)
    return out


def cover_ranks(eight: np.ndarray, n: int) -> np.ndarray:
    """Rank of the sample positions of a text of n bytes by 4 * PERIOD bytes (-1 elsewhere).

    ``eight`` holds the eight bytes from each position as a big-endian number; the text is followed by enough zeros.
    """
    at = np.flatnonzero(IN_COVER[np.arange(n + 4 * PERIOD) % PERIOD])
    rank = np.full(n + 8 * PERIOD, -1, dtype=np.int64)
    r = np.zeros(len(at), dtype=np.int64)
    for k in range(0, PERIOD, 8):
        w = eight[at + k]
        r = _dense(r, w >> _U(8 * (k + 8 - PERIOD)) if k + 8 > PERIOD else w)
    for step in (PERIOD, 2 * PERIOD):
        rank[at] = r
        r = _dense(r, rank[at + step])
    rank[at] = r
    return rank


def equal_suffixes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Class of each start: two starts have one class when the LENGTH bytes from them are equal."""
    padded = np.r_[data, np.zeros(16 * PERIOD, dtype=np.uint8)]
    eight = np.ndarray(shape=(len(padded) - 8,), dtype=">u8", buffer=padded, strides=(1,)).astype(np.uint64)
    rank = cover_ranks(eight, len(data))
    head = np.arange(0, PERIOD + 7, 8)[: -(-PERIOD // 8)]
    tail = np.r_[np.arange(4 * PERIOD, LENGTH - 8, 8), LENGTH - 8]

    def mixed(offsets: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = np.zeros(len(starts), dtype=np.uint64)
            for o in offsets:
                h = tb.splitmix(h ^ eight[starts + o]) * _U(_BASES[0]) + _U(1)
        return h

    group = _dense(mixed(head), mixed(tail))
    result = np.arange(len(starts))
    open_ = np.arange(len(starts))
    while len(open_):
        order = np.argsort(group[open_], kind="stable")
        open_ = open_[order]
        g = group[open_]
        first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
        size = np.diff(np.r_[first, len(g)])
        lead = np.repeat(open_[first + size // 2], size)
        alone = np.repeat(size == 1, size)
        open_, lead, g = open_[~alone], lead[~alone], g[~alone]
        if not len(open_):
            break
        i, j = starts[open_], starts[lead]
        d = SHIFT[i % PERIOD, j % PERIOD]
        side = np.sign(rank[i + d] - rank[j + d])
        equal = side == 0
        for o in np.r_[head, tail]:  # hashes have put them together, bytes decide
            equal[equal] = eight[i[equal] + o] == eight[j[equal] + o]
        result[open_[equal]] = lead[equal]
        group[open_] = _dense(g, np.where(equal, 0, np.where(side == 0, 2, side)))
        open_ = open_[~equal]
    return result


SPAN = "tid binary, lo bigint, hi bigint"


def _sort_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow body: runs (key, tid, p, a, b, again, bytes) sorted by (key, tid, p) -> spans of repeated suffixes."""
    held: list[tuple] = []
    size = 0
    before = None

    def sort() -> pa.RecordBatch | None:
        data = np.frombuffer(b"".join(r[6] for r in held), dtype=np.uint8)
        n = np.array([len(r[6]) for r in held])
        base = np.cumsum(n) - n
        count = n - LENGTH + 1
        run = np.repeat(np.arange(len(held)), count)
        starts = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + base[run]
        cls = equal_suffixes(data, starts)
        again = np.bincount(cls, minlength=len(cls))[cls] > 1
        again &= ~np.array([r[5] for r in held])[run]  # those are removed as a whole already
        hit = np.flatnonzero(again)
        if not len(hit):
            return None
        new = np.flatnonzero(np.r_[True, (np.diff(hit) > 1) | (np.diff(run[hit]) > 0)])
        lo, hi = hit[new], hit[np.r_[new[1:] - 1, len(hit) - 1]]
        owner = run[lo]
        shift = np.array([held[o][2] - held[o][4] for o in owner]) - base[owner]
        return pa.RecordBatch.from_arrays(
            [pa.array([held[o][1] for o in owner], pa.binary()), pa.array(starts[lo] + shift), pa.array(starts[hi] + shift + LENGTH)],
            names=["tid", "lo", "hi"])

    for b in batches:
        for r in zip(*(c.to_pylist() for c in b.columns)):
            if r[:3] == before:  # the same row of documents twice
                continue
            if held and r[0] != held[-1][0] and size > SORT_BYTES:
                out = sort()
                held, size = [], 0
                if out is not None:
                    yield out
            before = r[:3]
            held.append(r)
            size += len(r[6])
    if held:
        out = sort()
        if out is not None:
            yield out


def _tied_spans(runs_: DataFrame) -> DataFrame | None:
    """Spans of repeated suffixes within runs that share an anchor."""
    found = None
    level = runs_
    for size in LEVELS:
        spans = [(k, min(k + size, REACH) - 1) for k in range(0, REACH, size)]
        pick = F.explode(F.filter(F.array(*[F.struct(F.lit(u).alias("u"), F.lit(w).alias("w")) for u, w in spans]),
                                  lambda s: (s["u"] <= F.col("b")) & (s["w"] >= F.col("a"))))
        part = level.withColumn("s", pick)
        core = F.expr("substring(bytes, b - s.u + 1, 400 - (s.w - s.u))".replace("400", str(LENGTH)))
        part = part.select(
            F.unhex(F.substring(F.sha2(F.concat(F.col("s.u").cast("string").cast("binary"), core), 256), 1, 32)).alias("key"), "tid", "p",
            F.greatest("a", "s.u").alias("a"), F.least("b", "s.w").alias("b"), "again",
            F.expr(f"substring(bytes, b - least(b, s.w) + 1, least(b, s.w) - greatest(a, s.u) + {LENGTH})").alias("bytes"))
        sizes = part.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        part = part.join(sizes, "key")
        if size == 1:
            one = part.select("tid", "p", "b", "key", "again").distinct()
            n = one.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
            small = one.where("NOT again").join(n, "key").select("tid", (F.col("p") - F.col("b")).alias("lo"), (F.col("p") - F.col("b") + LENGTH).alias("hi"))
            return small if found is None else found.unionByName(small)
        columns = ["key", "tid", "p", "a", "b", "again", "bytes"]
        small = part.where(F.col("n") <= BUCKET_RUNS).select(columns).repartition("key").sortWithinPartitions("key", "tid", "p")
        spans_ = small.mapInArrow(_sort_buckets, SPAN)
        found = spans_ if found is None else found.unionByName(spans_)
        level = cut(part.where(F.col("n") > BUCKET_RUNS).select(columns[1:]))
        if level.isEmpty():
            return found
    return found


def repeated_spans(texts: DataFrame) -> DataFrame:
    """(tid, whole, spans) of distinct texts from (doc_id, tid, text): whole when other rows hold the same text, spans of
    strings that also start elsewhere, as found, unmerged. Texts without either are left out."""
    long_ = texts.where(F.octet_length("text") >= LENGTH)
    scan = long_.select("tid", "text").mapInArrow(_scan, SCAN)
    where = F.xxhash64("tid", "place")
    shared = scan.groupBy("name").agg(F.min(where).alias("x"), F.max(where).alias("y")).where("x < y").select("name")
    # an exchange of its own on both sides of the join, so that a hot anchor's places are split over tasks
    shared = shared.coalesce(max(2, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    # copies of a text are one place; the new key leaves the join free to split a hot anchor
    hits = cut(scan.join(shared, "name").groupBy("tid", "place").agg(*[F.first(c).alias(c) for c in ("name", "s1", "s2")]))
    kinds = cut(hits.groupBy("name", "s1", "s2").agg(F.count(F.lit(1)).alias("n"), F.first(F.struct("tid", "place")).alias("one")))
    reach = lambda x: (F.shiftright("place", 18) - F.shiftright("place", x).bitwiseAND(F.lit(511)))
    full = hits.join(kinds.where("n > 1").select("name", "s1", "s2"), ["name", "s1", "s2"]).select(
        "tid", reach(9).alias("lo"), (reach(0) + LENGTH).alias("hi"))
    tied = kinds.groupBy("name").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("name")
    asked = kinds.join(tied, "name").select("one.tid", F.struct(F.col("one.place").alias("place"), (F.col("n") > 1).alias("again")).alias("x"))
    asked = asked.groupBy("tid").agg(F.collect_list("x").alias("places"))  # of one text
    copies = long_.groupBy("tid").agg(F.count(F.lit(1)).alias("rows"), F.min("doc_id").alias("first"))
    asked = asked.join(copies, "tid").select(F.col("tid").alias("t"), "places", "first")
    fetched = long_.join(asked, (F.col("tid") == F.col("t")) & F.col("doc_id").eqNullSafe(F.col("first"))).select("tid", "text", "places")
    ties = _tied_spans(cut(fetched.mapInArrow(_fetch, RUN)))
    spans = full.unionByName(ties).groupBy("tid").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    return spans.join(copies.where("rows > 1").select("tid", F.lit(True).alias("whole")), "tid", "full")


RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"


def _strip(keep: bool):
    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for doc_id, text, whole, spans in zip(*(c.to_pylist() for c in b.columns)):
                data = text.encode()
                merged: list[list[int]] = []
                if whole:
                    merged = [[0, len(data)]]
                else:
                    for lo, hi in sorted((s["lo"], s["hi"]) for s in spans or ()):
                        if merged and lo <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], hi)
                        else:
                            merged.append([lo, hi])
                edges = [0, *(x for m in merged for x in m), len(data)]
                left = b"".join(data[x:y] for x, y in zip(edges[::2], edges[1::2]))
                out.append((doc_id, len(data), len(data) - len(left), len(merged), hashlib.sha256(left).hexdigest(), left if keep else None))
            cols = list(zip(*out)) if out else [[]] * 6
            types = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return body


def strip_repeats(docs: DataFrame, keep: bool = True) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, the bytes kept."""
    text = F.coalesce("text", F.lit(""))
    texts = docs.select("doc_id", F.unhex(F.substring(F.sha2(text, 256), 1, 32)).alias("tid"), text.alias("text"))
    found = repeated_spans(texts)
    out = texts.join(found, "tid", "left").select("doc_id", "text", "whole", "spans").mapInArrow(_strip(keep), RESULT)
    return out if keep else out.drop("kept")
