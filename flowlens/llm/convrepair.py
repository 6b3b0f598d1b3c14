"""Operator 13: cheapest repair of a conversation's structure, by a persistent audit DP.

``repair`` finds for every conversation the cheapest edits after which the first letters of its roles read
``(s?(ua)+)?``: Keep 0, Rerole to user or assistant 3, Delete 4 (the only choice for blank and duplicate rows),
Insert an empty user or assistant turn 3; a truncated row that stays adds 3. The audit is the sequence of the edits'
initials; among the cheapest the ASCII-least one wins.

The DP walks the rows with one partial audit per state of that pattern. Audits share their prefixes as linked nodes
(``Edits``): a node holds its parent, its letter, ancestors at powers of two and the rolling hash of the whole
prefix. Nodes are found by that hash, and a hit counts only if parent and letter agree, so equal prefixes
are one node and a collision of hashes cannot pass. A tie is settled by a search for the longest common prefix over the
ancestors. Two audits over the same rows and of the same cost are never prefixes of each other (the letters fix the cost,
and every letter that consumes no row costs 3), so the least prefix per state stays the least in every continuation,
and the DP may be cut anywhere.

On Spark rows are range-partitioned by (conv_id, turn, role, text), so one conversation with a third of all rows lies
on many tasks. A conversation that a task holds whole in at most ``BLOCK_ROWS`` rows is solved there. Of the others
each block of rows becomes a table from entry to exit state (cost and audit), the tables of a
conversation are chained in one pass, and every block then repairs its own rows. Only the chain (some rows per 512 turns) and
the final hash, which is sequential, see a conversation in one task, and both read it as a stream.

Defined results: null conv_ids are one conversation; a null role or text is one space; null turns come first and do
not count for gaps; rows of the same turn stand in the order of role, then text, and repeated rows are duplicates of the
first; a role with another first letter, or none, can only be rerolled or deleted; an empty table gives no
rows. Columns other than conv_id, turn, role and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import cut

BLOCK_ROWS = 512
BLOCK_BYTES = 1 << 18

SPACE = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: states: 0 nothing yet, 1 after the system turn, 2 after a user turn, 3 after an assistant turn
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
TURN = {0: 2, 1: 2, 2: 3, 3: 2}
NAME = {2: "user", 3: "assistant"}
ACCEPT = (0, 3)
#: no state that costs this much more than another can still win: an insertion or two and a deletion reach any other
SLACK = INSERT * 2 + DELETE
LEGAL = {"su", "ua", "au"}


class Edits:
    """Audits as nodes of a shared trie; node 0 is the empty audit."""

    MOD, BASE = (1 << 61) - 1, 1_000_003

    def __init__(self) -> None:
        self.parent, self.letter, self.hash, self.depth = [0], [""], [0], [0]
        self.up: list[list[int]] = [[]]
        self.found: dict[int, list[int]] = {}

    def then(self, node: int, letter: str) -> int:
        h = (self.hash[node] * self.BASE + ord(letter)) % self.MOD
        for n in self.found.get(h, ()):
            if self.parent[n] == node and self.letter[n] == letter:
                return n
        n = len(self.parent)
        ups, k = [node], 0
        while len(self.up[ups[k]]) > k:
            ups.append(self.up[ups[k]][k])
            k += 1
        for column, value in ((self.parent, node), (self.letter, letter), (self.hash, h), (self.depth, self.depth[node] + 1), (self.up, ups)):
            column.append(value)
        self.found.setdefault(h, []).append(n)
        return n

    def _lift(self, node: int, steps: int) -> int:
        while steps:
            k = min(steps.bit_length() - 1, len(self.up[node]) - 1)
            node, steps = self.up[node][k], steps - (1 << k)
        return node

    def less(self, a: int, b: int) -> bool:
        """Whether audit a comes before audit b."""
        m = min(self.depth[a], self.depth[b])
        x, y = self._lift(a, self.depth[a] - m), self._lift(b, self.depth[b] - m)
        if x == y:
            return self.depth[a] < self.depth[b]
        for k in range(len(self.up[x]) - 1, -1, -1):
            if k < len(self.up[x]):
                p, q = self.up[x][k], self.up[y][k]
                if self.hash[p] != self.hash[q] or p != q:  # the second only after a collision
                    x, y = p, q
        return self.letter[x] < self.letter[y]

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.letter[node])
            node = self.parent[node]
        return "".join(reversed(out))


def _offer(edits: Edits, states: dict, state: int, cost: int, node: int) -> bool:
    old = states.get(state)
    if old is None or cost < old[0] or (cost == old[0] and old[1] != node and edits.less(node, old[1])):
        states[state] = (cost, node)
        return True
    return False


def _inserted(edits: Edits, states: dict) -> dict:
    """The states after any insertions."""
    states = dict(states)
    moved = True
    while moved:
        moved = False
        for q in list(states):
            cost, node = states[q]
            moved |= _offer(edits, states, TURN[q], cost + INSERT, edits.then(node, "I"))
    return states


def _walk(edits: Edits, states: dict, shape: str) -> dict:
    """The states after the rows of ``shape``: a letter of s, u, a, x (another role), upper case when truncated, - when
    the row must go."""
    for c in shape:
        after: dict = {}
        for q, (cost, node) in _inserted(edits, states).items():
            _offer(edits, after, q, cost + DELETE, edits.then(node, "D"))
            if c == "-":
                continue
            base = cost + (TRUNCATED if c.isupper() else 0)
            to = NEXT.get((q, c.lower()))
            if to is not None:
                _offer(edits, after, to, base + KEEP, edits.then(node, "K"))
            _offer(edits, after, TURN[q], base + REROLE, edits.then(node, "R"))
        best = min(cost for cost, _ in after.values())
        states = {q: v for q, v in after.items() if v[0] <= best + SLACK}
    return states


@lru_cache(maxsize=4096)
def solve(shape: str) -> tuple[int, str]:
    """(cost, audit) of a whole conversation."""
    edits = Edits()
    end = _inserted(edits, _walk(edits, {0: (0, 0)}, shape))
    best = None
    for q in ACCEPT:
        if q in end and (best is None or end[q][0] < best[0] or (end[q][0] == best[0] and edits.less(end[q][1], best[1]))):
            best = end[q]
    return best[0], edits.text(best[1])


@lru_cache(maxsize=512)
def transfer(shape: str) -> list[tuple[int, int, int, str]]:
    """(entry, exit, cost, audit) of a block for every pair of states it can link."""
    out = []
    for entry in range(4):
        edits = Edits()
        out += [(entry, q, cost, edits.text(node)) for q, (cost, node) in _walk(edits, {entry: (0, 0)}, shape).items()]
    return out


def apply_audit(audit: str, entry: int, roles: list[str], texts: list[str]) -> tuple[list[str], list[str]]:
    """The repaired roles and texts of rows that begin in state ``entry``."""
    q, i, out = entry, 0, ([], [])
    for e in audit:
        if e in "KR":
            q = NEXT[q, roles[i][:1]] if e == "K" else TURN[q]
            out[0].append(roles[i] if e == "K" else NAME[q])
            out[1].append(texts[i])
        elif e == "I":
            q = TURN[q]
            out[0].append(NAME[q])
            out[1].append("")
        i += e != "I"
    return out


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: the contract's damage; a dropped row stays with 0 copies."""
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    d = F.pmod(F.crc32(F.concat(one("conv_id"), F.lit(":"), one("turn"))), F.lit(20))
    return conversations.select(
        "conv_id", "turn",
        F.when(d == 0, "").when(d == 4, "user").otherwise(one("role")).alias("role"),
        F.when(d.isin(0, 1), "").when(d == 2, F.regexp_replace(one("text"), "[.!?]", "")).otherwise(one("text")).alias("text"),
        F.when(d == 0, 0).when(d == 3, 2).otherwise(1).cast("bigint").alias("copies"))


def as_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies of undamaged rows."""
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    return conversations.select("conv_id", "turn", one("role"), one("text"), F.lit(1).cast("bigint").alias("copies"))


STATS = ["blank", "duplicate", "truncated", "illegal", "turns"]
PIECE = (
    "conv_id bigint, part bigint, seq bigint, whole boolean, "
    + ", ".join(f"{c} bigint" for c in STATS)
    + ", first_turn bigint, last_turn bigint, first_role string, last_role string, cost bigint, audit string, sha string, "
    "links array<struct<a: int, b: int, cost: bigint, audit: string>>, roles array<string>, texts array<string>"
)
NAMES = [c.split()[0] for c in PIECE.replace("array<struct<a: int, b: int, cost: bigint, audit: string>>", "x").split(", ")]
PIECE_ARROW = pa.schema([
    *[(c, pa.int64()) for c in ("conv_id", "part", "seq")], ("whole", pa.bool_()), *[(c, pa.int64()) for c in STATS],
    ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("first_role", pa.string()), ("last_role", pa.string()),
    ("cost", pa.int64()), ("audit", pa.string()), ("sha", pa.string()),
    ("links", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))),
    ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))])


def _sha(roles: list[str], texts: list[str]) -> str:
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in zip(roles, texts)).encode()).hexdigest()


class _Block:
    """Rows of one conversation that stand together, with their faults counted."""

    def __init__(self, conv: int | None, seq: int) -> None:
        self.conv, self.seq, self.shape, self.roles, self.texts, self.bytes = conv, seq, [], [], [], 0
        self.n = dict.fromkeys(STATS, 0)
        self.first_turn = self.last_turn = None

    def add(self, turn: int | None, role: str, text: str, again: bool) -> None:
        body = text.strip(SPACE)
        if not body:
            fault = "blank"
        elif again:
            fault = "duplicate"
        else:
            fault = "" if body[-1] in ".!?" else "truncated"
        if fault:
            self.n[fault] += 1
        first = role[:1]
        if self.roles and self.roles[-1][:1] + first not in LEGAL:
            self.n["illegal"] += 1
        if turn is not None and turn != self.last_turn:
            self.n["turns"] += 1
            self.last_turn = turn
            if self.first_turn is None:
                self.first_turn = turn
        gone = fault in ("blank", "duplicate")
        kind = first if first and first in "sua" else "x"
        self.shape.append("-" if gone else kind.upper() if fault else kind)
        self.roles.append(role)
        self.texts.append("" if gone else text)  # what is deleted is not carried on
        self.bytes += 0 if gone else len(text)

    def row(self, part: int, whole: bool, keep: bool) -> tuple:
        shape = "".join(self.shape)
        ends = (self.roles[0], self.roles[-1]) if self.roles else (None, None)
        head = (self.conv, part, self.seq, whole, *self.n.values(), self.first_turn, self.last_turn, *ends)
        if not whole:
            links = [dict(zip(("a", "b", "cost", "audit"), x)) for x in transfer(shape)]
            return (*head, None, None, None, links, self.roles, self.texts)
        cost, audit = solve(shape)
        fixed = apply_audit(audit, 0, self.roles, self.texts)
        return (*head, cost, audit, _sha(*fixed), None, *(fixed if keep else (None, None)))


def _blocks(keep: bool):
    """mapInArrow body over sorted rows: whole conversations solved, the others as blocks."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        out: list[tuple] = []
        size = 0
        current: _Block | None = None
        inside = False  # whether the conversation began in this partition for sure

        def batch() -> pa.RecordBatch:
            nonlocal out, size
            cols = [pa.array(list(c), type=f.type) for c, f in zip(zip(*out), PIECE_ARROW)]
            out, size = [], 0
            return pa.RecordBatch.from_arrays(cols, schema=PIECE_ARROW)

        def close(whole: bool) -> None:
            nonlocal size
            out.append(current.row(part, whole, keep))
            size += 64 + (0 if whole and not keep else current.bytes)

        for b in batches:
            for conv, turn, role, text, copies, later in zip(*(c.to_pylist() for c in b.columns)):
                if current is None:
                    current = _Block(conv, 0)
                elif conv != current.conv:
                    close(inside and current.seq == 0)
                    current, inside = _Block(conv, 0), True
                for k in range(copies):
                    if len(current.roles) >= BLOCK_ROWS or current.bytes > BLOCK_BYTES:
                        close(False)
                        current = _Block(conv, current.seq + 1)
                    current.add(turn, role, text, later or k > 0)
                    if size > BLOCK_BYTES or len(out) >= 1000:
                        yield batch()
        if current is not None:
            close(False)
        if out:
            yield batch()

    return body


def chain(blocks: Iterator[tuple[list[dict]]]) -> tuple[int, list[tuple[int, int]]]:
    """(cost, (entry, exit) of each block) of the least audit through the blocks of one conversation."""
    states: dict[int, tuple[int, str]] = {0: (0, "")}  # cost and audit since the prefix that all states share
    back: list[dict[int, int]] = []
    for links in blocks:
        after: dict[int, tuple[int, str, int]] = {}
        for x in links:
            if x["a"] in states:
                cost, audit = states[x["a"]]
                new = (cost + x["cost"], audit + x["audit"], x["a"])
                if x["b"] not in after or new < after[x["b"]]:
                    after[x["b"]] = new
        back.append({q: v[2] for q, v in after.items()})
        best = min(v[0] for v in after.values())
        states = {q: v[:2] for q, v in after.items() if v[0] <= best + SLACK}
        low, high = min(v[1] for v in states.values()), max(v[1] for v in states.values())
        same = next((i for i, (c, d) in enumerate(zip(low, high)) if c != d), min(len(low), len(high)))
        states = {q: (cost, audit[same:]) for q, (cost, audit) in states.items()}
    # insertions after the last row
    ends = []
    for q, (cost, audit) in states.items():
        for k in range(3):
            if q in ACCEPT:
                ends.append((cost + INSERT * k, audit + "I" * k, k))
            q = TURN[q]
    cost, audit, k = min(ends)
    last = next(q for q, v in states.items() if (v[0] + INSERT * k, v[1] + "I" * k) == (cost, audit))
    path, q = [], last
    for b in reversed(back):
        path.append((b[q], q))
        q = b[q]
    return cost, path[::-1]


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow body over blocks sorted by conversation: the way through each block; totals on the last."""
    rows = (r for b in batches for r in b.to_pylist())
    row = next(rows, None)
    while row is not None:
        conv, seen = row["conv_id"], []
        totals = dict.fromkeys(STATS, 0)
        first_turn = last_turn = last_role = None

        def of_conversation():
            nonlocal row, first_turn, last_turn, last_role
            while row is not None and row["conv_id"] == conv:
                for c in STATS:
                    totals[c] += row[c]
                if row["first_role"] is not None:
                    totals["illegal"] += last_role is not None and last_role[:1] + row["first_role"][:1] not in LEGAL
                    last_role = row["last_role"]
                if row["first_turn"] is not None:
                    totals["turns"] -= row["first_turn"] == last_turn
                    first_turn = row["first_turn"] if first_turn is None else first_turn
                    last_turn = row["last_turn"]
                seen.append((row["part"], row["seq"]))
                links = row["links"]
                row = next(rows, None)
                yield links

        cost, path = chain(of_conversation())
        n = len(seen)
        last = [False] * (n - 1) + [True]
        cols = [pa.array([conv] * n, pa.int64()), pa.array([p for p, _ in seen], pa.int64()), pa.array([s for _, s in seen], pa.int64()),
                pa.array([a for a, _ in path], pa.int32()), pa.array([b for _, b in path], pa.int32()), pa.array(last),
                pa.array([cost] * n, pa.int64()), *[pa.array([totals[c]] * n, pa.int64()) for c in STATS],
                pa.array([first_turn] * n, pa.int64()), pa.array([last_turn] * n, pa.int64())]
        yield pa.RecordBatch.from_arrays(cols, names=PATH_NAMES)


PATH = "conv_id bigint, part bigint, seq bigint, entry int, exit int, is_last boolean, cost bigint, " + ", ".join(
    f"{c} bigint" for c in STATS) + ", first_turn bigint, last_turn bigint"
PATH_NAMES = [c.split()[0] for c in PATH.split(", ")]


def _repair_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow body: blocks with their way through -> audit and repaired rows of the block."""
    for b in batches:
        for r in b.to_pylist():
            audit = next(x["audit"] for x in r["links"] if (x["a"], x["b"]) == (r["entry"], r["exit"]))
            if r["is_last"]:
                audit += "I" * {0: 0, 1: 2, 2: 1, 3: 0}[r["exit"]]
            roles, texts = apply_audit(audit, r["entry"], r["roles"], r["texts"])
            cols = [pa.array([r[c]], f.type) for c, f in zip(PATH_NAMES, FIXED_ARROW)]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array([audit]), pa.array([roles], pa.list_(pa.string())), pa.array([texts], pa.list_(pa.string()))],
                schema=FIXED_ARROW)


FIXED = PATH + ", audit string, roles array<string>, texts array<string>"
FIXED_ARROW = pa.schema([
    *[(c, {"entry": pa.int32(), "exit": pa.int32(), "is_last": pa.bool_()}.get(c, pa.int64())) for c in PATH_NAMES],
    ("audit", pa.string()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow body over repaired blocks sorted by conversation: one row per conversation, hashed as a stream."""
    audit: list[str] = []
    sha, empty = hashlib.sha256(), True
    for b in batches:
        for r in b.to_pylist():
            audit.append(r["audit"])
            for role, text in zip(r["roles"], r["texts"]):
                sha.update((("" if empty else "\n") + f"{role}:{text}").encode())
                empty = False
            if r["is_last"]:
                gaps = 0 if r["first_turn"] is None else r["last_turn"] - r["first_turn"] + 1 - r["turns"]
                values = [r["conv_id"], gaps, r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"]]
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array([v], pa.int64()) for v in values], pa.array(["".join(audit)]), pa.array([sha.hexdigest()])], names=RESULT_NAMES)
                audit, sha, empty = [], hashlib.sha256(), True


RESULT = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
RESULT_NAMES = [c.split()[0] for c in RESULT.split(", ")]


def _solve(rows: DataFrame, keep: bool) -> tuple[DataFrame, DataFrame]:
    """(whole conversations, repaired blocks of the others) of rows with copies."""
    keyed = rows.withColumn("h", F.unhex(F.sha2("text", 256)))
    seen = keyed.where("copies > 0").groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("h").alias("k")).agg(
        F.sum("copies").alias("n"), F.max(F.col("turn").isNull()).alias("nulls"), F.min("turn").alias("t"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("h") == F.col("k"))
    joined = keyed.join(seen.where("n > 1"), same, "left")
    later = F.when(F.col("nulls"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("t"))
    # only rows that occur again are summed up; all others move once, to their place
    again = joined.where("n IS NOT NULL").groupBy("conv_id", "turn", "role", "text", later.alias("later")).agg(F.sum("copies").alias("copies"))
    flagged = joined.where("n IS NULL").select("conv_id", "turn", "role", "text", "copies", F.lit(False).alias("later")).unionByName(again)
    keys = ["conv_id", "turn", "role", "text"]
    placed = flagged.repartitionByRange(*keys).sortWithinPartitions(*keys)
    pieces = cut(placed.mapInArrow(_blocks(keep), PIECE))
    open_ = pieces.where("NOT whole")
    order = ["conv_id", "part", "seq"]
    ways = open_.select(*order, *STATS, "first_turn", "last_turn", "first_role", "last_role", "links")
    ways = ways.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(_paths, PATH)
    a, b = open_.select(*order, "links", "roles", "texts").alias("a"), ways.alias("b")
    same = F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("a.part") == F.col("b.part")) & (F.col("a.seq") == F.col("b.seq"))
    joined = a.join(b, same).select("a.links", "a.roles", "a.texts", "b.*")
    return pieces.where("whole"), joined.mapInArrow(_repair_block, FIXED)


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation: faults, cost and audit of the cheapest repair, SHA-256 of the repaired conversation.

    ``rows`` come from ``damage`` or ``as_rows``."""
    whole, fixed = _solve(rows, keep=False)
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0))
    done = whole.select("conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                        F.col("sha").alias("repaired_sha256"))
    blocks = fixed.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    return done.unionByName(blocks.mapInArrow(_digests, RESULT))


def repaired_turns(rows: DataFrame) -> DataFrame:
    """conv_id, block, place, role, text: the repaired rows; (block, place) is their order."""
    whole, fixed = _solve(rows, keep=True)
    cols = ["conv_id", F.struct("part", "seq").alias("block"), F.posexplode(F.arrays_zip("roles", "texts")).alias("place", "t")]
    return whole.select(*cols).unionByName(fixed.select(*cols)).select(
        "conv_id", "block", "place", F.col("t.roles").alias("role"), F.col("t.texts").alias("text"))
