"""Winnowing against a plain version, its guarantee, and the next-row step."""

import hashlib
import random
import re

from fleetzone.llm import winnow as W

SCHEMA = "text string, doc_id long, fingerprint string"


def texts(seed=1, n=60):
    rnd = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdefgh" for b in ["", "re", "ing", "tion"]]
    out = ["", "a", "a b", "x" * 40, "é ü 漢字漢字漢字漢字漢字", "  \n ", "one two three four five"]
    while len(out) < n:
        out.append(rnd.choice([" ", "\n", "  "]).join(rnd.choices(words, k=rnd.choice([5, 11, 12, 40, 300]))))
    return out


def pieces(t):
    return re.findall(r"[^\x20\x09-\x0D]{1,8}", t)




def selections(entries, n):
    """Every window of WINDOW grams must hold a selected position, selected ones only."""
    at = sorted(p for p, _ in entries)
    grams = max(n - W.GRAM + 1, 1)
    for s in range(max(grams - W.WINDOW + 1, 1)):
        assert any(s <= p < s + W.WINDOW for p in at)
    assert all(0 <= p < grams for p in at)


def test_windows_positions_and_hash_minimum(spark):
    rows = [(t, i, "x") for i, t in enumerate(texts())]
    got = {r.doc_id: [(e.position, e.hash) for e in r.fingerprint]
           for r in W.fingerprints(spark.createDataFrame(rows, SCHEMA)).collect()}
    by_gram = {}
    for t, i, _ in rows:
        p = pieces(t)
        if not p:
            assert got[i] == []
            continue
        selections(got[i], len(p))
        for at, h in got[i]:                          # equal grams, equal hashes
            assert by_gram.setdefault(tuple(p[at:at + W.GRAM]), h) == h
    # With the hashes known, the selections are the rightmost minima of the windows.
    for t, i, _ in rows:
        p = pieces(t)
        grams = [by_gram.get(tuple(p[s:s + W.GRAM])) for s in range(max(len(p) - W.GRAM + 1, 1))] if p else []
        if grams and None not in grams:
            want = set()
            for s in range(max(len(grams) - W.WINDOW + 1, 1)):
                win = grams[s:s + W.WINDOW]
                want.add(s + max(k for k, h in enumerate(win) if h == min(win)))
            assert {q for q, _ in got[i]} == want


def test_shared_passage_gives_a_common_entry(spark):
    rnd = random.Random(3)
    word = lambda: f"w{rnd.randrange(10**6)}"
    rows = []
    for i in range(0, 40, 2):
        passage = [word() for _ in range(W.GRAM + W.WINDOW - 1)]
        for j in (0, 1):
            rows.append((" ".join([word() for _ in range(rnd.randrange(30))] + passage +
                                  [word() for _ in range(rnd.randrange(30))]), i + j, "x"))
    got = {r.doc_id: {e.hash for e in r.fingerprint} for r in W.fingerprints(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[i] & got[i + 1] for i in range(0, 40, 2))


def test_edited_texts(spark):
    rows = [(t, 3 * i + 1, "x") for i, t in enumerate(texts(5))] + [(None, 500, "x"), ("only the null id", None, "y")]
    out = W.edited_fingerprints(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    order = sorted(rows, key=lambda r: -1 if r[1] is None else r[1])
    edited, of = {}, {}
    for k, (t, i, _) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][0] or ""
        m = len(t) // 4
        edited[i] = t[:len(t) - m] + nxt[:m]
        of[i] = nxt
    assert len(out) == len(rows)
    extra = [(x, 10_000 + k, "x") for k, x in enumerate([*edited.values(), *of.values()])]
    fp = {r.doc_id: [(e.position, e.hash) for e in r.fingerprint]
          for r in W.fingerprints(spark.createDataFrame(extra, SCHEMA)).collect()}
    for k, i in enumerate(edited):
        r = next(r for r in out if r.doc_id == i)
        t = next(t for t, j, _ in rows if j == i) or ""
        assert r.n_chars == len(t)
        assert r.edited_sha256 == hashlib.sha256(edited[i].encode()).hexdigest()
        dec = [(2 ** 31 - 1 - (v & (2 ** 31 - 1)), v >> 31) for v in r.edited_fingerprint]
        assert sorted(dec) == sorted(fp[10_000 + k])
        own = {v >> 31 for v in r.fingerprint}

        def like(a, b):
            return 1.0 if not a | b else len(a & b) / len(a | b)

        assert r.near_edited == like(own, {h for _, h in dec})
        assert r.near_next == like(own, {h for _, h in fp[10_000 + len(edited) + k]})


def test_repeats_strings_and_empty_table(spark):
    df = spark.createDataFrame([("a b c d e f g h", 1, "x"), ("a b c d e f g h", 1, "x"), ("z", 2, "x")], SCHEMA)
    out = W.report(df).collect()
    assert len(out) == 3 and len({r.fingerprint for r in out if r.doc_id == 1}) == 1
    assert all(re.fullmatch(r"(\d+:[0-9a-f]+( |$))*", r.fingerprint) for r in out)
    assert W.report(df.limit(0)).collect() == []


def test_plan_has_no_python(spark):
    df = spark.createDataFrame([("a b", 1, "x")], SCHEMA)
    plan = W.report(df)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def rolled(t):
    return [run[i:i + 8] for run in re.findall(r"[^\x20\x09-\x0D]+", t) for i in range(max(len(run) - 7, 1))]


def test_rolled_pieces(spark):
    data = texts() + ["a bcdefghi jklmnopq r", "\U00020000" * 20 + " z", "abcdefghijk " * 30]
    df = spark.createDataFrame([(t, i, "x") for i, t in enumerate(data)], SCHEMA)
    got = {r.doc_id: list(r.parts) for r in df.select("doc_id", W.pieces(df.text, True).alias("parts")).collect()}
    assert got == {i: rolled(t) for i, t in enumerate(data)}


def test_query_finds_unspaced_passages_at_any_offset(spark, tmp_path):
    """A passage without spaces shifted by 1 to 8 characters, through the registered query."""
    from fleetzone.llm import queries
    rnd = random.Random(8)
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 2000)]
    passage = "".join(rnd.choices(letters, k=400))
    rows = [("".join(rnd.choices(letters, k=i)) + passage, i, "x") for i in range(9)]
    spark.createDataFrame(rows, SCHEMA).select("text", "doc_id").write.parquet(str(tmp_path / "documents.parquet"))
    out = {r.doc_id: r for r in queries.op6_fingerprints(spark, str(tmp_path)).collect()}
    hashes = {i: {e.split(":")[1] for e in r.fingerprint.split()} for i, r in out.items()}
    for i in range(1, 9):
        assert len(hashes[0] & hashes[i]) / len(hashes[0] | hashes[i]) > 0.8
        assert out[i - 1].near_next > 0.8


def test_rolled_shared_passage_of_18_characters(spark):
    rnd = random.Random(12)
    run = lambda n: "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=n))
    rows = []
    for i in range(0, 40, 2):
        passage = run(W.PIECE + W.GRAM + W.WINDOW - 2)
        rows += [(run(rnd.randrange(30)) + passage + run(rnd.randrange(30)), i + j, "x") for j in (0, 1)]
    got = {r.doc_id: {e.hash for e in r.fingerprint}
           for r in W.fingerprints(spark.createDataFrame(rows, SCHEMA), rolled=True).collect()}
    assert all(got[i] & got[i + 1] for i in range(0, 40, 2))


def test_rolled_edited_texts(spark):
    """The windows computed once for both texts are those of the whole edited text."""
    rnd = random.Random(2)
    data = texts(7) + ["".join(rnd.choices("abcdefg漢字", k=k)) for k in (7, 8, 9, 17, 30, 31, 32, 33, 90, 400)]
    rows = [(t, i, "x") for i, t in enumerate(data)]
    out = {r.doc_id: r for r in W.edited_fingerprints(spark.createDataFrame(rows, SCHEMA), rolled=True).collect()}
    edited = [t[:len(t) - len(t) // 4] + data[(i + 1) % len(data)][:len(t) // 4] for i, t in enumerate(data)]
    whole = spark.createDataFrame([(t, i, "x") for i, t in enumerate(data + edited)], SCHEMA)
    fp = {r.doc_id: sorted((e.position, e.hash) for e in r.fingerprint) for r in W.fingerprints(whole, rolled=True).collect()}
    decoded = lambda entries: sorted((2 ** 31 - 1 - (v & (2 ** 31 - 1)), v >> 31) for v in entries)
    for i in range(len(data)):
        assert decoded(out[i].fingerprint) == fp[i] and decoded(out[i].edited_fingerprint) == fp[len(data) + i]
