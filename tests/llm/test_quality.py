"""Quality classifier: held-out accuracy on the test table, co-training, edge cases."""

import numpy as np

from fleetzone.llm import quality

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, quality string"


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    truth = {r.doc_id: (r.quality, r.toxic) for r in labels.collect()}
    train = labels.where("doc_id % 3 <> 0")
    got = {r.doc_id: r for r in quality.score_documents(docs, train).collect()}
    assert len(got) == docs.count()
    held = [(got[i], q) for i, (q, _) in truth.items() if i % 3 == 0]
    right = sum((r.quality >= 0.5) == bool(q) for r, q in held)
    assert right / len(held) > 0.95
    clean = [got[i] for i, (q, t) in truth.items() if i % 3 == 0 and q == 1 and t == 0]
    assert sum(r.kept for r in clean) / len(clean) > 0.95


def features(n, seed, flip=0.0):
    """Words tell the label; the source tells it too, for other documents better."""
    rng = np.random.RandomState(seed)
    y = (rng.random_sample(n) < 0.5).astype(float)
    texts = [" ".join(rng.choice(["good", "fine", "nice"] if (v > 0.5) != (rng.random_sample() < flip) else
                                 ["bad", "poor", "junk"], 6)).encode() + b" the of and" for v in y]
    f = quality.features(texts, ["en"] * n, [f"s{int(v)}" if rng.random_sample() < 0.9 else "s2" for v in y], [100] * n)
    return f, y


def test_views_exchange_pseudo_labels():
    labelled, y = features(200, 1)
    pool, truth = features(400, 2)
    model = quality.co_train(labelled, y, pool)
    assert len(model.rounds) == quality.ROUNDS and model.rounds[0][0] > 100
    test, want = features(300, 3)
    assert ((model.probability(test) > 0.5) == want).mean() > 0.97
    again = quality.co_train(labelled, y, pool)
    assert np.allclose(again.probability(test), model.probability(test))


def test_edge_rows(spark):
    rows = [(1, None, None, None, None, "x"), (2, "", "en", "s", 0, "x"), (None, "a b", "en", "s", 3, "x"),
            (3, "w " * 300000, "en", "s", 600000, "x"), (2, "", "en", "s", 0, "x")]
    docs = spark.createDataFrame(rows, SCHEMA)
    for data in ([], [(1, 1, 0), (2, None, 1)], [(1, 1, None), (1, 1, None)]):
        labels = spark.createDataFrame(data, "doc_id long, quality int, toxic int")
        out = quality.score_documents(docs, labels).collect()
        assert len(out) == 5 and all(0 <= r.quality <= 1 and 0 <= r.toxic <= 1 for r in out)
    assert quality.score_documents(docs.limit(0), labels).collect() == []


def test_every_unlabelled_document_takes_part(spark):
    """A round hands over the sure ones of all other rows, far more than any sample of the fit."""
    rng = np.random.RandomState(4)
    rows, truth = [], {}
    for i in range(9000):
        good = bool(rng.random_sample() < 0.5)
        late = i >= 200 and i % 2
        words = ["good", "fine", "nice"] if good else ["bad", "poor", "junk"]
        text = " ".join(rng.choice(words, 6)) + (f" late{good:d}" if late else "")
        rows.append((i, text, "en", f"s{good:d}", 100, "x"))
        truth[i] = int(good)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    labels = spark.createDataFrame([(i, truth[i]) for i in range(200)], "doc_id long, quality int")
    model = quality.fit(docs, labels, ["quality"])["quality"]
    assert [min(r) for r in model.rounds] == [8800] * quality.ROUNDS
    new = quality.features([b"late1", b"late0"], ["en"] * 2, ["s9"] * 2, [100] * 2)
    assert model.content.odds[new.words[0]] > 5 and model.content.odds[new.words[1]] < -5
    spread = quality.co_train(*sample(rows[:200], truth), sample(rows[200:], truth)[0])
    assert np.array_equal(spread.content.odds, model.content.odds) and np.allclose(spread.combine, model.combine)


def sample(rows, truth):
    _, text, lang, source, n_chars, _ = zip(*rows)
    f = quality.features([t.encode() for t in text], list(lang), list(source), list(n_chars))
    return f, np.array([float(truth[r[0]]) for r in rows])
