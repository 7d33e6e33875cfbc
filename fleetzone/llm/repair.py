"""Operator 11: repair of conversation structure with an audit of every edit.

Each row of a conversation, in turn order, is kept, given another role or
deleted, and empty turns may be inserted, so that the roles become an optional
system turn followed by (user, assistant) pairs, or nothing.  Blank and
duplicate rows must be deleted.  Of the cheapest edit sequences the one whose
audit (the initials of its edits) is ASCII-least is taken.

The search is a dynamic program over four states (nothing yet, after system,
after user, after assistant).  A state holds its best cost and the last node
of its audit: audits share their prefixes as linked nodes
(:class:`Audits`), and two audits of equal cost are compared by a
longest-common-prefix search over binary-lifting ancestors and rolling hashes,
verified letter by letter.

Two audits of the same rows at the same cost never begin one another (the
longer one would have paid for its insertions), so the best audit of a part
stays best whatever follows it.  A conversation is therefore worked through in
segments of at most ``SEGMENT`` rows, each giving the best way from every entry
state to every exit state, and the segments are chained afterwards: a
conversation with a third of all rows is spread over the tasks like any other.
Rows are dealt by ranges of their order, duplicates are found by grouped
minimums, and only letters (one a row) meet per conversation.

Defined cases: a null role or text is one space, a null turn sorts first, a
null conversation id is a conversation of its own.  Rows of equal turn are
ordered by role and text (roles above 32 characters: by their first 32, then
the text's first 32, then the whole); of equal rows all but one are
duplicates.  An empty table gives empty results; other input columns are
ignored, whatever their names.  A span of turn numbers beyond the largest long
counts as that.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetzone.llm.common import columns, partitions, written

#: Prices of the edits; a truncated row that is not deleted pays ``TRUNCATED`` on top.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Rows of a conversation worked through at once.
SEGMENT = 4096
WHITE = " \t\n\x0b\f\r"
_LONG = 2 ** 63 - 1


class Audits:
    """Edit strings that share their prefixes: a node is a letter after its parent's string.

    Node 0 is the empty string.  ``up[n][k]`` is the ancestor ``2**k`` letters
    above ``n`` and ``hash`` the rolling hash of the whole string.
    """

    BASE, PRIME = 1_000_003, (1 << 61) - 1

    def __init__(self) -> None:
        self.letter, self.depth, self.hash, self.up = [""], [0], [0], [[]]
        self._same = [0]                    # nodes of verified equal strings, as disjoint sets

    def add(self, parent: int, letter: str) -> int:
        up = [parent]
        while len(self.up[up[-1]]) >= len(up):
            up.append(self.up[up[-1]][len(up) - 1])
        node = len(self.letter)
        self.letter.append(letter)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * self.BASE + ord(letter)) % self.PRIME)
        self.up.append(up)
        self._same.append(node)
        return node

    def ancestor(self, node: int, depth: int) -> int:
        """The prefix of ``depth`` letters."""
        while (left := self.depth[node] - depth) > 0:
            node = self.up[node][left.bit_length() - 1]
        return node

    def _set(self, node: int) -> int:
        while self._same[node] != node:
            self._same[node] = node = self._same[self._same[node]]
        return node

    def _difference(self, x: int, y: int) -> tuple[int, int] | None:
        """The shallowest prefixes of two strings of equal length that differ, None if they are equal.

        Walks up to the next prefix known to be shared; strings found equal
        are remembered, so each node is passed once.
        """
        found, passed = None, []
        while (a := self._set(x)) != (b := self._set(y)):
            if self.letter[x] != self.letter[y]:
                found, passed = (x, y), []
            else:
                passed.append((a, b))
            if not self.depth[x]:
                break
            x, y = self.up[x][0], self.up[y][0]
        for a, b in passed:
            self._same[self._set(a)] = self._set(b)
        return found

    def less(self, a: int, b: int) -> bool:
        """Whether the string of ``a`` comes before that of ``b`` in ASCII order."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self.ancestor(a, depth), self.ancestor(b, depth)
        if self.hash[x] != self.hash[y]:
            for k in reversed(range(len(self.up[x]))):
                if k < len(self.up[x]) and self.hash[self.up[x][k]] != self.hash[self.up[y][k]]:
                    x, y = self.up[x][k], self.up[y][k]
            differ = self._difference(self.up[x][0], self.up[y][0]) or (x, y)
        else:
            differ = self._difference(x, y)
        if differ:
            return self.letter[differ[0]] < self.letter[differ[1]]
        return self.depth[a] < self.depth[b]

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(out))


START, SYSTEM, USER, ASSISTANT = range(4)


def _steps(code: str) -> list[list[tuple[int, int, str]]]:
    """Per state the (next state, price, letter) that a row offers.

    ``code`` is d for a row that must go, else the role's initial (s, u, a, or
    x for any other), as a capital where the text is truncated.
    """
    extra = TRUNCATED if code.isupper() else 0
    out = []
    for state in range(4):
        want, to = ("a", ASSISTANT) if state == USER else ("u", USER)
        moves = [(state, DELETE, "D")]
        if code != "d":
            moves.append((to, extra, "K") if code.lower() == want else (to, extra + REROLE, "R"))
            if state == START and code.lower() == "s":
                moves.append((SYSTEM, extra, "K"))
        out.append(moves)
    return out


STEPS = {c: _steps(c) for c in "dsuaxSUAX"}


@lru_cache(4096)
def transfer(codes: str, entry: int) -> tuple[tuple[int, int, str], ...]:
    """The best (exit state, cost, audit) of a run of rows entered in state ``entry``.

    Insertions stand before the rows of the run, never after the last one.
    """
    tree = Audits()
    best: dict[int, tuple[int, int]] = {entry: (0, 0)}

    def offer(to: dict, state: int, cost: int, parent: int, letter: str) -> None:
        held = to.get(state)
        if held and held[0] < cost:
            return
        node = tree.add(parent, letter)
        if not held or cost < held[0] or tree.less(node, held[1]):
            to[state] = (cost, node)

    for code in codes:
        before = dict(best)
        for state in (START, SYSTEM, ASSISTANT):
            if state in best:
                offer(before, USER, best[state][0] + INSERT, best[state][1], "I")
        if USER in before:
            offer(before, ASSISTANT, before[USER][0] + INSERT, before[USER][1], "I")
        best = {}
        for state, (cost, node) in before.items():
            for to, price, letter in STEPS[code][state]:
                offer(best, to, cost + price, node, letter)
    return tuple((state, cost, tree.text(node)) for state, (cost, node) in sorted(best.items()))


# --------------------------------------------------------------------------
# Rows in order, with their faults
# --------------------------------------------------------------------------

def _initial(role: Column) -> Column:
    first = F.left(role, F.lit(1))
    return F.when(first.isin("s", "u", "a"), first).otherwise(F.lit("x"))


def _ordered(turns: DataFrame) -> DataFrame:
    """The rows numbered in order (``id``) by ranges, written: a long conversation spans ranges."""
    src = columns(turns, conv_id="long", turn="long", role="string", text="string")
    src = src.withColumns({c: F.coalesce(c, F.lit(" ")) for c in ("role", "text")})
    src = src.withColumns({"role_head": F.left("role", F.lit(32)), "text_head": F.left("text", F.lit(32))})
    ranged = ["conv_id", "turn", "role_head", "text_head"]
    out = src.repartitionByRange(partitions(turns.sparkSession), *ranged).sortWithinPartitions(*ranged, "role", "text")
    last = F.right(F.rtrim("text", F.lit(WHITE)), F.lit(1))
    return written(out.select(
        F.monotonically_increasing_id().alias("id"), "conv_id", "turn", "role", "text",
        _initial(F.col("role")).alias("initial"),
        F.when(last == "", F.lit(1)).when(~last.isin(".", "!", "?"), F.lit(3)).otherwise(F.lit(0)).alias("fault")),
        "repair-rows")


def _faults(ordered: DataFrame) -> DataFrame:
    """id, conv_id, turn, initial, fault (1 blank, 2 duplicate, 3 truncated, 0 none), in the order of ids.

    A row is the first of its (conversation, role, text) if its id is the
    least: a grouped minimum, combined before the shuffle, joined back by id.
    """
    narrow = ordered.select("id", "conv_id", "turn", "initial", "fault")
    first = ordered.where("fault <> 1").groupBy("conv_id", "role", F.sha2(F.col("text").cast("binary"), 256).alias("digest")) \
        .agg(F.min("id").alias("first"))
    flagged = narrow.join(first, narrow["id"] == first["first"], "left").select(
        "id", narrow["conv_id"], "turn", "initial",
        F.when((F.col("fault") != 1) & F.col("first").isNull(), F.lit(2)).otherwise(F.col("fault")).alias("fault"))
    return flagged.repartitionByRange(partitions(ordered.sparkSession), "id").sortWithinPartitions("id")


_SEGMENT = pa.schema([
    ("conversation", pa.string()), ("id", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()),
    ("truncated", pa.int64()), ("illegal", pa.int64()), ("head", pa.string()), ("tail", pa.string()),
    ("low", pa.int64()), ("high", pa.int64()), ("turns", pa.int64()),
    ("moves", pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])))])
_SEGMENT_DDL = ("conversation string, id long, blank long, duplicate long, truncated long, illegal long, head string, "
                "tail string, low long, high long, turns long, "
                "moves array<struct<entry: int, exit: int, cost: long, audit: string>>")
_LEGAL = [b"su", b"ua", b"au"]


def _rows(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    conv, turn = batch.column("conv_id"), batch.column("turn")
    return {"id": batch.column("id").to_numpy(), "fault": batch.column("fault").to_numpy(),
            "conv": conv.fill_null(0).to_numpy(), "no_conv": conv.is_null().to_numpy(zero_copy_only=False),
            "turn": turn.fill_null(0).to_numpy(), "no_turn": turn.is_null().to_numpy(zero_copy_only=False),
            "initial": np.frombuffer("".join(batch.column("initial").to_pylist()).encode(), np.uint8)}


def _pieces(r: dict[str, np.ndarray], sure: bool) -> list[tuple[int, int, bool]]:
    """(start, end, surely the start of its conversation) of the segments of consecutive rows."""
    follows = np.diff(r["id"]) == 1
    same = (np.diff(r["conv"]) == 0) & (r["no_conv"][1:] == r["no_conv"][:-1])
    starts = np.concatenate(([0], np.flatnonzero(~(follows & same)) + 1))
    known = np.concatenate(([sure], follows[starts[1:] - 1]))
    ends = np.concatenate((starts[1:], [len(r["id"])]))
    return [(at, min(at + SEGMENT, e), bool(k) and at == s)
            for s, e, k in zip(starts.tolist(), ends.tolist(), known) for at in range(s, e, SEGMENT)]


def _describe(r: dict[str, np.ndarray], pieces: list[tuple[int, int, bool]]) -> pa.RecordBatch:
    """One row per segment: counts, the ends that its neighbours need, and its best ways."""
    fault, initial = r["fault"], r["initial"]
    total = {k: np.concatenate(([0], np.cumsum(fault == v))) for k, v in (("blank", 1), ("duplicate", 2), ("truncated", 3))}
    pair = initial[:-1].astype(np.uint16) * 256 + initial[1:]
    wrong = np.concatenate(([0, 0], np.cumsum(~np.isin(pair, [p[0] * 256 + p[1] for p in _LEGAL]))))
    fresh = np.concatenate(([0, 0], np.cumsum((r["turn"][1:] != r["turn"][:-1]) & ~r["no_turn"][1:] & ~r["no_turn"][:-1])))
    code = np.where((fault == 1) | (fault == 2), ord("d"), np.where(fault == 3, initial - 32, initial)).astype(np.uint8)
    out = []
    for s, e, sure in pieces:
        numbered = np.flatnonzero(~r["no_turn"][s:e])
        low, high = (int(r["turn"][s + numbered[0]]), int(r["turn"][e - 1])) if len(numbered) else (None, None)
        codes = code[s:e].tobytes().decode()
        out.append({k: int(v[e] - v[s]) for k, v in total.items()} | {
            "conversation": "null" if r["no_conv"][s] else str(r["conv"][s]), "id": int(r["id"][s]),
            "illegal": int(wrong[e] - wrong[s + 1]), "head": chr(initial[s]), "tail": chr(initial[e - 1]),
            "low": low, "high": high, "turns": int(fresh[e] - fresh[s + 1]) + 1 if len(numbered) else 0,
            "moves": [{"entry": q, "exit": to, "cost": cost, "audit": audit}
                      for q in ([START] if sure else range(4)) for to, cost, audit in transfer(codes, q)]})
    return pa.RecordBatch.from_pylist(out, _SEGMENT)


def _segments(batches):
    """Rows in order of id to segments; the last one of a batch waits for the next batch."""
    held, sure = None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        r = _rows(batch)
        if held is not None:
            r = {k: np.concatenate((held[k], v)) for k, v in r.items()}
        pieces = _pieces(r, sure)
        s, _, sure = pieces.pop()
        held = {k: v[s:] for k, v in r.items()}
        if pieces:
            yield _describe(r, pieces)
    if held is not None:
        yield _describe(held, _pieces(held, sure))


# --------------------------------------------------------------------------
# Segments to conversations
# --------------------------------------------------------------------------

def _path(node) -> list[str]:
    out = []
    while node:
        out.append(node[1])
        node = node[0]
    return out[::-1]


def _before(x, y) -> bool:
    """Whether the audit of chain ``x`` comes before that of ``y``; compared from where they part."""
    a, b = [], []
    while x is not y:
        a.append(x[1])
        b.append(y[1])
        x, y = x[0], y[0]
    return "".join(reversed(a)) < "".join(reversed(b))


def _better(to: dict, state: int, cost: int, node) -> None:
    held = to.get(state)
    if not held or cost < held[0] or (cost == held[0] and _before(node, held[1])):
        to[state] = (cost, node)


def chain(moves: list) -> tuple[int, list[str]]:
    """Least cost and the ASCII-least audit, cut at the segments, of segments in order."""
    best = {START: (0, None)}
    for segment in moves:
        new: dict = {}
        for m in segment:
            if m["entry"] in best:
                cost, node = best[m["entry"]]
                _better(new, m["exit"], cost + m["cost"], (node, m["audit"]))
        best = new
    done: dict = {}
    for state, more in ((START, ""), (ASSISTANT, ""), (USER, "I"), (SYSTEM, "II")):
        if state in best:
            cost, (node, audit) = best[state]
            _better(done, 0, cost + INSERT * len(more), (node, audit + more))
    cost, node = done[0]
    return cost, _path(node)


_DECIDED = ("conversation string, id long, edits string, place long, has_system boolean, first boolean, gaps long, "
            "blank long, duplicate long, truncated long, illegal long, cost long, audit string")


_DECISION = pa.schema([(c.split()[0], {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}[c.split()[1]])
                       for c in _DECIDED.split(", ")])


def _decide(bin_: pa.Table) -> pa.Table:
    """A bin of whole conversations: one row per segment with its edits, the first with the totals."""
    segments = bin_.select(_SEGMENT.names).sort_by([("conversation", "ascending"), ("id", "ascending")]).to_pylist()
    out = []
    for name, part in groupby(segments, lambda r: r["conversation"]):
        rows = list(part)
        cost, audits = chain([r["moves"] for r in rows])
        numbered = [r for r in rows if r["turns"]]
        meet = sum(a["high"] == b["low"] for a, b in zip(numbered, numbered[1:]))
        gaps = numbered[-1]["high"] - numbered[0]["low"] + 1 - sum(r["turns"] for r in numbered) + meet if numbered else 0
        illegal = sum(r["illegal"] for r in rows) + sum((a["tail"] + b["head"]).encode() not in _LEGAL for a, b in zip(rows, rows[1:]))
        totals = {k: sum(r[k] for r in rows) for k in ("blank", "duplicate", "truncated")} | {
            "first": True, "gaps": min(gaps, _LONG), "illegal": illegal, "cost": cost, "audit": "".join(audits)}
        place, has_system = 0, (len(totals["audit"]) - totals["audit"].count("D")) % 2 == 1
        for r, edits in zip(rows, audits):
            out.append({"conversation": name, "id": r["id"], "edits": edits, "place": place, "has_system": has_system}
                       | (totals if r is rows[0] else {"first": False}))
            place += len(edits) - edits.count("D")
    return pa.Table.from_pylist(out, _DECISION)


_EDIT = pa.schema([("conversation", pa.string()), ("place", pa.int64()), ("id", pa.int64()), ("edit", pa.string()),
                   ("new_role", pa.string())])


def _edits(batches):
    """One row per turn of the repaired conversation: the row it comes from and its new role, if any.

    An inserted turn comes from no row; its id is negative, so such turns meet
    nothing in the join and are spread over its tasks.
    """
    for batch in batches:
        edits = batch.column("edits").to_pylist()
        size = np.array([len(e) for e in edits], np.int64)
        letter = np.frombuffer("".join(edits).encode(), np.uint8)
        segment = np.repeat(np.arange(len(edits)), size)
        start = (np.cumsum(size) - size)[segment]
        of = lambda name: batch.column(name).to_numpy(zero_copy_only=False)[segment]

        def within(flags: np.ndarray) -> np.ndarray:
            """Flags up to and with each letter, counted in its segment."""
            total = np.concatenate(([0], np.cumsum(flags)))
            return total[1:] - total[start]

        stays, inserted, kept = (letter != ord("D")), (letter == ord("I")), (letter == ord("K"))
        row = of("id") + within(~inserted) - 1
        place = of("place") + within(stays) - 1
        role = np.where((place - of("has_system")) % 2 == 0, "user", "assistant")
        yield pa.RecordBatch.from_arrays([
            batch.column("conversation").take(pa.array(segment[stays])), pa.array(place[stays]),
            pa.array(np.where(inserted, -1 - row - place, row)[stays]),
            pa.array([chr(x) for x in letter[stays].tolist()], pa.string()),
            pa.array(role[stays], pa.string(), mask=kept[stays])], schema=_EDIT)


@dataclass
class Repaired:
    """``conversations``: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.
    ``turns``: conv_id, place, edit, role, text of the repaired conversations."""

    conversations: DataFrame
    turns: DataFrame


def repair(turns: DataFrame) -> Repaired:
    """Faults, the cheapest repair and the repaired turns of every conversation of ``turns``.

    ``gaps`` counts turn numbers missing between the least and the greatest,
    ``blank``, ``duplicate`` and ``truncated`` the rows by their first fault,
    ``illegal`` adjacent roles other than system-user, user-assistant and
    assistant-user.
    """
    ordered = _ordered(turns)
    segments = _faults(ordered).mapInArrow(_segments, _SEGMENT_DDL)
    bins = 4 * partitions(turns.sparkSession)
    decided = written(segments.groupBy(F.pmod(F.xxhash64("conversation"), F.lit(bins)).alias("bin"))
                      .applyInArrow(_decide, _DECIDED), "repair-edits")
    conv_id = F.when(F.col("conversation") != "null", F.col("conversation")).cast("long").alias("conv_id")
    whole = decided.where("first").select(conv_id, "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    edits = decided.select("conversation", "id", "edits", "place", "has_system").mapInArrow(
        _edits, "conversation string, place long, id long, edit string, new_role string")
    rows = ordered.select(F.col("id").alias("from"), "role", "text")
    joined = edits.join(rows, F.col("id") == F.col("from"), "left").select(
        conv_id, "place", "edit", F.coalesce("new_role", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return Repaired(whole, joined)


# --------------------------------------------------------------------------
# The registered query: damaged conversations, digests of the repair
# --------------------------------------------------------------------------

def damage(turns: DataFrame) -> DataFrame:
    """Rows with faults, chosen by a checksum of conversation and turn (nulls are one space):
    0 drops the row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes it a user's (modulo 20)."""
    src = columns(turns, conv_id="long", turn="long", role="string", text="string")
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    one = F.lit(1)
    times = F.when(F.col("fate") == 0, F.array().cast("array<int>")).when(F.col("fate") == 3, F.array(one, one)).otherwise(F.array(one))
    return src.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), fate.alias("fate")).select(
        "conv_id", "turn", F.when(F.col("fate") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("fate") == 1, F.lit("")).when(F.col("fate") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"), F.explode(times)).drop("col")


def _digest(batches):
    """Digest of the turns of each conversation, streamed over rows sorted by conversation and place."""
    name, sha = None, None
    for batch in batches:
        done = []
        for c, role, text in zip(*(batch.column(k).to_pylist() for k in ("conversation", "role", "text"))):
            if c != name:
                if sha:
                    done.append((name, sha.hexdigest()))
                name, sha = c, hashlib.sha256()
            else:
                sha.update(b"\n")
            sha.update(f"{role}:{text}".encode())
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], pa.string()) for i in (0, 1)], ["conversation", "sha"])
    if sha:
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([sha.hexdigest()])], ["conversation", "sha"])


def digests(original: DataFrame, repaired: Repaired) -> DataFrame:
    """One row per conversation id of ``original``; without rows left: zeros, no audit, the digest of nothing."""
    name = F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))
    n = partitions(original.sparkSession)
    sha = repaired.turns.select(name.alias("conversation"), "place", "role", "text").repartition(n, "conversation") \
        .sortWithinPartitions("conversation", "place").mapInArrow(_digest, "conversation string, sha string")
    ids = columns(original, conv_id="long").distinct().select("conv_id", name.alias("conversation"))
    whole = repaired.conversations.withColumn("conversation", name).drop("conv_id")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return ids.join(whole, "conversation", "left").join(sha, "conversation", "left").select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
