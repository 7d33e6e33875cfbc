"""Conversation repair against a plain recursive search and a plain count of faults."""

import hashlib
import itertools
import random
import re
import zlib
from functools import lru_cache

import pytest

from fleetzone.llm import queries, repair

SCHEMA = "conv_id long, turn long, role string, text string, audit string"
WHITE = " \t\n\x0b\f\r"
LEGAL = {"su", "ua", "au"}


def plain_search(rows):
    """(cost, audit) of rows (must go, truncated, initial): every edit of every row, backwards."""
    @lru_cache(None)
    def best(i, state, inserts):
        found = []
        if i == len(rows) and state in "0a":
            found.append((0, ""))
        want, after = ("a", "a") if state == "u" else ("u", "u")
        if inserts < 3:
            cost, audit = best(i, after, inserts + 1)
            found.append((cost + 5, "I" + audit))
        if i < len(rows):
            gone, cut, initial = rows[i]
            options = [(2, "D", state)]
            if not gone:
                options.append((1 + 5 * cut, "R", after))
                if initial == want or (initial == "s" and state == "0"):
                    options.append((5 * cut, "K", initial))
            for price, letter, to in options:
                cost, audit = best(i + 1, to, 0)
                found.append((cost + price, letter + audit))
        return min(found, default=(10 ** 9, ""))
    for i in reversed(range(len(rows))):            # from the end, so that no call goes deep
        for state in "0sua":
            best(i, state, 0)
    return best(0, "0", 0)


def plain(rows):
    """The contract's row for one conversation's (turn, role, text) rows."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, codes, counts = set(), [], [0, 0, 0]
    for _, role, text in rows:
        bare = text.strip(WHITE)
        fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else None
        if fault is not None:
            counts[fault] += 1
        seen.add((role, text))
        codes.append((fault in (0, 1), fault == 2, role[:1]))
    turns = sorted({t for t, _, _ in rows if t is not None})
    gaps = turns[-1] - turns[0] + 1 - len(turns) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in LEGAL for a, b in zip(rows, rows[1:]))
    cost, audit = plain_search(tuple(codes))
    out, at = [], 0
    odd = sum(c != "D" for c in audit) % 2
    for c in audit:
        role, text = ("", "") if c == "I" else rows[at][1:]
        at += c != "I"
        if c != "D":
            out.append((role if c == "K" else ["user", "assistant"][(len(out) - odd) % 2], text))
    assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in out))
    return (gaps, *counts, illegal, cost, audit), out


def check(spark, rows, partitions=None):
    frame = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    got = repair.repair(frame)
    found = {r.conv_id: tuple(r)[1:] for r in got.conversations.collect()}
    turns = {}
    for r in sorted(got.turns.collect(), key=lambda r: r.place):
        turns.setdefault(r.conv_id, []).append((r.role, r.text))
    groups = {}
    for c, t, role, text in rows:
        groups.setdefault(c, []).append((t, " " if role is None else role, " " if text is None else text))
    assert set(found) == set(groups)
    for c, part in groups.items():
        want, out = plain(part)
        assert found[c] == want, (c, part)
        assert turns.get(c, []) == out
    return found


def conversations(seed, n, longest=9):
    rnd = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "user", "assistant"]
    texts = ["Yes.", "cut off", " ", "", None, "Why? \n", "Done!", "a ", ". ", "no end,", "same.", "é."]
    rows = []
    for c in range(n):
        for t in range(rnd.randint(1, longest)):
            rows.append((c, rnd.choice([t, t, t * 3, None]), rnd.choice(roles), rnd.choice(texts)))
    return rows + [(None, 1, "user", "null id."), (None, 2, "assistant", "Yes.")]


def test_faults_and_repairs(spark):
    found = check(spark, conversations(1, 120))
    assert {"K", "R", "D"} <= set("".join(v[-1] for v in found.values()))


def test_segments_are_chained(spark, monkeypatch):
    """The same results when a conversation is cut into segments of two rows."""
    monkeypatch.setattr(repair, "SEGMENT", 2)
    rows = conversations(2, 40, 30)
    r = repair.repair(spark.createDataFrame([(*x, "x") for x in rows], SCHEMA))
    small = {x.conv_id: tuple(x) for x in r.conversations.collect()}
    monkeypatch.undo()
    assert small == {k: (k, *v) for k, v in check(spark, rows).items()}


def test_transfers_chain_at_every_cut():
    rnd = random.Random(3)
    for _ in range(150):
        codes = "".join(rnd.choice("dsuaxSUAX") for _ in range(rnd.randint(1, 12)))
        rows = tuple((c == "d", c.isupper(), c.lower()) for c in codes)
        cut = rnd.randint(0, len(codes))
        parts = [codes[:cut], codes[cut:]]
        moves = [[{"entry": q, "exit": e, "cost": k, "audit": a} for q in range(4) for e, k, a in repair.transfer(p, q)] for p in parts]
        cost, audits = repair.chain(moves)
        assert (cost, "".join(audits)) == plain_search(rows), codes


def test_audits_compare_like_strings_even_when_every_hash_collides():
    for base in (repair.Audits.BASE, 0):
        class Colliding(repair.Audits):
            BASE, PRIME = base, 1 if not base else repair.Audits.PRIME
        tree = Colliding()
        words = ["".join(w) for n in range(5) for w in itertools.product("DIK", repeat=n)]
        nodes = {}
        for w in words:
            node, shared = 0, random.Random(w).random() < 0.5
            if w and shared:
                node = tree.add(nodes[w[:-1]], w[-1])
            else:
                for c in w:
                    node = tree.add(node, c)
            nodes[w] = node
            assert tree.text(node) == w
        rnd = random.Random(4)
        for _ in range(4000):
            a, b = rnd.choice(words), rnd.choice(words)
            assert tree.less(nodes[a], nodes[b]) == (a < b), (a, b)


def test_hot_conversation_of_many_segments(spark, monkeypatch):
    """One conversation over all ranges, with equal rows and turns without a number."""
    monkeypatch.setattr(repair, "SEGMENT", 64)
    rnd = random.Random(5)
    hot = [(9, None if t % 7 == 0 else t, rnd.choice(["user", "assistant"]), rnd.choice(["Yes.", f"{t}.", f"{t}"])) for t in range(600)]
    check(spark, hot + [(c, t, "user", "Hi.") for c in (8, 10) for t in (0, 0, 1)])


def test_very_long_text_and_equal_rows(spark):
    long = "x" * 3_000_000
    check(spark, [(1, 0, "user", long + "."), (1, 1, "assistant", long), (1, 1, "assistant", long), (2, 5, "r" * 5000, "Hm.")])


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    got = repair.repair(repair.damage(empty))
    assert got.conversations.collect() == [] and got.turns.collect() == [] and repair.digests(empty, got).collect() == []


def damaged(rows):
    """The rows after damage and all conversation ids."""
    out = {}
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        part = out.setdefault(c, [])
        fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if fate == 1:
            text = ""
        elif fate == 2:
            text = re.sub("[.!?]", "", text)
        part += [(t, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return out


def compare_query(rows, got):
    want = {}
    for c, part in damaged(rows).items():
        counts, out = plain(part)
        want[c] = (*counts, hashlib.sha256("\n".join(f"{r}:{x}" for r, x in out).encode()).hexdigest())
    assert {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in got} == want
    assert len(got) == len(want)


def test_damage_and_digests(spark):
    rows = conversations(6, 60) + [(1000 + i, None, None, None) for i in range(30)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    compare_query(rows, repair.digests(frame, repair.repair(repair.damage(frame))).collect())


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_registered_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"/root/testdata/{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    compare_query(rows, queries.queries()["op11_repair"](spark, f"/root/testdata/{sf}").collect())
