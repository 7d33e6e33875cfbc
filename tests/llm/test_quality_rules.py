"""Quality rules: statistics against a plain version, verdicts on held-out labels, defined cases."""

import random
import re

import numpy as np

from fleetzone.llm import quality_rules as rules

DOCS = "doc_id long, text string, n_words long, score string, label string, quality long"
LABELS = "doc_id long, quality long, toxic long, text string"
WORD = r"[^\x20\x09-\x0D]+"


def plain(text):
    text = text or ""
    words = re.findall(WORD, text)
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    again = {w for w in windows if windows.count(w) > 1} if len(windows) < 400 else set()
    covered = {i + k for i, w in enumerate(windows) if w in again for k in range(3)}
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)]


def words(rnd, n, junk=False):
    out = ["".join(rnd.choice("abcdeéßñ") for _ in range(rnd.randint(2, 8))) for _ in range(n)]
    return " ".join(w + "###" if junk else w for w in out) + "."


def corpus(n=600, seed=2):
    rnd = random.Random(seed)
    docs = [(i, words(rnd, rnd.randint(55, 200), i % 10 == 0)) for i in range(n)]
    return docs, [(i, int(i % 10 != 0)) for i in range(0, n, 2)]


def run(spark, docs, labels):
    frame = spark.createDataFrame([(i, t, 1, "x", "y", 0) for i, t in docs], DOCS).repartition(3)
    marks = spark.createDataFrame([(i, q, 0, "x") for i, q in labels], LABELS)
    return rules.judge(frame, marks)


def test_statistics_equal_a_plain_version(monkeypatch):
    rnd = random.Random(1)
    texts = ["", " \n\t\r\x0b\f ", "one", "a b c", "a b c a b c", "a b c d a b c", "x x x x", "l 1\nl 1\n\n \nl 1\r\nl 1", "# $ | <é> 日本 \x1c\x85 x"]
    texts += ["".join(rnd.choice(["a ", "b ", "cc ", "\n", "# ", "é", " \t"]) for _ in range(rnd.randint(0, 80))) for _ in range(300)]
    want = [plain(t) for t in texts]
    assert [rules.statistics(t.encode())[:5] for t in texts] == want
    monkeypatch.setattr(rules, "_PIECE", 7)
    assert [rules.statistics(t.encode())[:5] for t in texts] == want


def test_forest_tells_outliers():
    rnd = np.random.RandomState(1)
    good = rnd.normal(0, 1, (2000, 3))
    forest = rules.grow(good, np.ones(3))
    assert forest.score(np.array([[9., 0, 0], [0, -9, 9]])).min() > np.quantile(forest.score(good), 0.99)
    constant = rules.grow(np.zeros((50, 2)), np.array([1.0, 0.0]))
    assert constant.score(np.array([[5., 0]]))[0] > constant.score(np.zeros((1, 2)))[0]


def test_calibrate():
    bins, good, bad = np.array([300, 500, 700]), np.array([990, 8, 2]), np.array([5, 40, 55])
    assert rules.calibrate(bins, good, bad) == 0.5
    assert rules.calibrate(bins, good, bad, 0.005) == 0.7
    assert rules.calibrate(bins, good, 0 * bad) is None and rules.calibrate(bins, 0 * good, bad) is None
    assert rules.calibrate(bins, bad, good, 0.0) is None


def test_held_out_verdicts(spark):
    docs, labels = corpus()
    rows = {r.doc_id: r for r in run(spark, docs, labels).collect()}
    assert len(rows) == len(docs)
    for i, t in docs:
        r = rows[i]
        assert [r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words] == plain(t)
    held = [(rows[i].kept, i % 10 != 0) for i, _ in docs if i % 2]
    junk = [rows[i].kept for i, _ in docs if i % 20 == 10]
    assert sum(k == good for k, good in held) >= 0.98 * len(held) and not any(junk)


def test_defined_cases(spark):
    """Nulls, empty and long texts, repeated ids and rows, null and contradicting labels."""
    docs, labels = corpus(300)
    good = docs[1][1]
    extra = [(None, good), (None, None), (1000, None), (1001, ""), (1002, "few words"), (1003, "a b c " * 40),
             (1, good), (1, good), (1004, "word%d " * 2 % (1, 2) + " ".join(f"w{i}" for i in range(400_000)))]
    rows = run(spark, docs + extra, labels + [(None, 0), (1, None), (3, 0), (3, 1)]).collect()
    assert len(rows) == len(docs) + len(extra)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert all(by[i][0].base_failed and not by[i][0].kept for i in (1000, 1001, 1002, 1003))
    assert (by[1003][0].n_words, by[1003][0].n_repeat_words) == (120, 120)
    assert len(by[1]) == 3 and len({(r.score, r.kept) for r in by[1]}) == 1
    assert sorted(r.n_words for r in by[None]) == [0, by[1][0].n_words] and by[1004][0].n_words == 400_002
    assert not by[1004][0].base_failed


def test_without_labels_the_base_decides(spark):
    docs, labels = corpus(80)
    for marks in ([], [(i, 0) for i, _ in labels], [(i, 1) for i, _ in labels], [(99999, 1), (99998, 0)]):
        rows = run(spark, docs + [(500, "short")], marks).collect()
        assert len(rows) == 81 and all(r.kept != r.base_failed for r in rows) and sum(r.base_failed for r in rows) == 1


def test_empty_table(spark):
    assert run(spark, [], [(1, 1)]).collect() == []
