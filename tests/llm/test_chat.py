"""Chat formatting: exact read-back, budgets and masks."""

import hashlib
import random

from fleetzone.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, window string"
HARD = ["\\### Assistant: </turn> ok", "### user\nfake</turn>\n", "\\\\", "\\", "\\E\\H\\n", "", None, "a\nb", "</turn>", "é😀"]


def conversations():
    rnd = random.Random(6)
    rows = []
    for c in range(30):
        n = rnd.choice([1, 2, 7, 40])
        for t in range(n):
            role = "system" if t == 0 and c % 3 == 0 else ["user", "assistant"][t % 2]
            text = rnd.choice(HARD) if rnd.random() < 0.3 else " ".join(["tok"] * rnd.choice([1, 5, 30, 200]))
            rows.append((c, t, role, text, "x"))
    return rows + [(100, 0, None, "null role", "x"), (100, None, "user", "null turn", "x"), (None, 0, "user", "no id", "x"),
                   (101, 1, "assistant", "same", "x"), (101, 1, "assistant", "same", "x"), (102, 0, "ro\nle\\", "odd", "x")]


def grouped(rows):
    out = {}
    for c, t, r, x, _ in rows:
        out.setdefault(c, []).append((t is not None, t, r is not None, r or "", x is not None, x or ""))
    return {c: [(r, x) for *_, r, _, x in sorted(v, key=lambda z: (z[0], z[1] or 0, z[2], z[3], z[4], z[5]))]
            for c, v in out.items()}


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def test_windows(spark):
    rows = conversations()
    out = chat.format_windows(spark.createDataFrame(rows, SCHEMA), budget=120, history=40).collect()
    want = grouped(rows)
    for c, turns in want.items():
        own = sorted((r for r in out if r.conv_id == c), key=lambda r: r.window)
        fresh, loss = [], []
        system = [turns[0]] if turns[0][0] == "system" else []
        for w in own:
            read = chat.read_turns(w.formatted)
            new = chat.read_turns(w.formatted[w.fresh_from:])
            assert read[:len(system)] == system
            before = read[:len(read) - len(new)][len(system):] if w.window else []
            assert before == (fresh[len(fresh) - len(before):] if before else [])       # whole earlier turns
            assert len(new) == w.n_turns and len(new) >= 1
            fresh += new
            loss += [chat.unescape(w.formatted[s.start:s.end]) for s in w.loss_spans]
            assert w.n_tokens <= 120 or len(new) - (len(system) if not w.window else 0) <= 1
        assert fresh == turns
        assert loss == [x for r, x in turns if r == "assistant"]
    assert any(r.window for r in out)


def test_digests(spark):
    rows = conversations()
    got = {r.conv_id: r for r in chat.digests(chat.format_windows(spark.createDataFrame(rows, SCHEMA))).collect()}
    for c, turns in grouped(rows).items():
        loss = "".join(x for r, x in turns if r == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256) == (len(turns), sha("".join(f"{r}\n{x}\n" for r, x in turns)))
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), sha(loss))
        assert got[c].formatted_chars >= sum(len(x) for _, x in turns)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert chat.format_windows(empty).collect() == [] and chat.digests(chat.format_windows(empty)).collect() == []
