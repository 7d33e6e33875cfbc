"""Operator 5: quality classification by co-training on two views.

The content view sees a document's words (log-odds of hashed words) and its
shape (shares of symbols, capitals, digits, repeated words).  The metadata
view sees language, source and stated length only.  Each view starts from the
labelled rows, then for some rounds hands the documents it is surest of, with
its label, to the other view's training set.  Views are calibrated on held-out
labelled rows and combined into one probability, which scores all documents.

At most ``FIT_ROWS`` labelled rows, chosen by a hash of the id, are used as
labelled (a documented bound).  The exchange has no bound: every round scores
all other rows in the tasks, and the sure ones enter the other view's log-odds
as sums per (bucket, label), of which a fixed number reaches the driver.  The
few regression weights over the log-odds are fitted on the labelled rows.  A
labelled row outside the sample takes part like an unlabelled one.  A round
and the scoring are one pass over all rows each, without a shuffle of rows.

The same fit runs for any 0/1 label column: :func:`score_documents` gives a
quality and, where labelled, a toxicity probability.

Defined cases: null text is empty, null metadata is a value of its own; a
label of null is unlabelled; with labels of one kind only, or fewer than 20
labelled documents, nothing is fitted and every score is the share of 1 among
them (0.5 without any); repeated rows are scored alike; an empty table gives an empty
result; other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetzone.llm import vectext
from fleetzone.llm.common import columns

BUCKETS = 1 << 18
META = 1 << 12
FIT_ROWS = 5_000
ROUNDS = 3
SURE = 0.97
_CHUNK = 2 << 20

_KIND = np.zeros(256, np.uint8)          # 1 lower or non-ASCII, 2 upper, 3 digit, 4 symbol, 5 line end, 0 space
_KIND[33:127] = 4
_KIND[48:58] = 3
_KIND[65:91] = 2
_KIND[97:123] = 1
_KIND[128:] = 1
_KIND[10] = 5
SHAPE = ["n_words", "symbols", "upper", "digits", "lines", "repeats", "word_bytes", "distinct"]


@dataclass
class Features:
    """Word buckets (ragged) and shape numbers of some documents, and their metadata buckets."""
    words: np.ndarray
    offsets: np.ndarray
    shape: np.ndarray
    meta: np.ndarray

    def take(self, rows: np.ndarray) -> Features:
        size = np.diff(self.offsets)[rows]
        return Features(vectext.gather(self.words, self.offsets[rows], size),
                        np.concatenate(([0], np.cumsum(size))), self.shape[rows], self.meta[rows])


def _meta_buckets(lang: list, source: list, n_chars: list) -> np.ndarray:
    """Hashed metadata values: language, source, both, size class."""
    out = np.empty((len(lang), 4), np.uint64)
    for i, (a, b, c) in enumerate(zip(lang, source, n_chars)):
        size = -1 if c is None else int(c).bit_length()
        for k, v in enumerate((f"l{a}", f"s{b}", f"ls{a} {b}", f"c{size}")):
            h = 1469598103934665603
            for ch in v.encode():
                h = (h ^ ch) * 1099511628211 & 0xFFFFFFFFFFFFFFFF
            out[i, k] = h
    return (vectext.mix(out) & np.uint64(META - 1)).astype(np.int64)


def features(texts: list[bytes], lang: list, source: list, n_chars: list) -> Features:
    """Both views of some documents."""
    words, offsets = vectext.word_hashes(texts)
    n = np.diff(offsets)
    owner = np.repeat(np.arange(len(texts)), n)
    same = np.zeros(len(words))
    same[1:] = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
    kinds = np.zeros((len(texts), 6))
    distinct = np.ones(len(texts))
    for i, t in enumerate(texts):
        kinds[i] = np.bincount(_KIND[np.frombuffer(t, np.uint8)], minlength=6) if t else 0
        if n[i] > 1:
            head = words[offsets[i]:offsets[i + 1]]
            distinct[i] = len(np.unique(head)) / np.sqrt(n[i]) / 10
    ink = np.maximum(kinds[:, 1:5].sum(1), 1)
    shape = np.stack([np.log1p(n) / 5, kinds[:, 4] / ink, kinds[:, 2] / ink, kinds[:, 3] / ink,
                      kinds[:, 5] / np.maximum(n, 1), np.bincount(owner, same, len(texts)) / np.maximum(n, 1),
                      ink / np.maximum(n, 1) / 10, distinct], axis=1)
    return Features((words & np.uint64(BUCKETS - 1)).astype(np.int32), offsets, shape, _meta_buckets(lang, source, n_chars))


def _logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-2, steps: int = 25) -> np.ndarray:
    """Weights (last one the intercept) of a ridge logistic regression, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    ridge = np.full(len(w), l2 * len(x) ** 0.5)
    ridge[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + ridge * w
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _distinct(buckets: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Every document's buckets once, and their offsets."""
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    seen = np.unique(owner * size + buckets)
    return seen % size, np.searchsorted(seen, np.arange(len(offsets)) * size)


def _counts(seen: tuple[np.ndarray, np.ndarray], rows: np.ndarray, y: np.ndarray, size: int) -> np.ndarray:
    """Documents labelled 0 and 1 (rows) with every bucket; the last column counts all of them."""
    n = np.diff(seen[1])[rows]
    buckets = vectext.gather(seen[0], seen[1][rows], n)
    one = y.astype(np.int64)
    out = np.bincount(buckets + np.repeat(one, n) * (size + 1), minlength=2 * (size + 1)).reshape(2, -1)
    out[:, size] = np.bincount(one, minlength=2)
    return out


@dataclass
class View:
    """One view's classifier: log-odds per bucket and a logistic regression over a few numbers."""
    odds: np.ndarray
    weights: np.ndarray = field(default_factory=lambda: np.zeros(1))

    @staticmethod
    def log_odds(counts: np.ndarray) -> np.ndarray:
        """Log-odds of a bucket's presence among documents labelled 1 and 0, smoothed towards 0.

        The two added documents are split by the labels' shares: with many
        more documents of one label, a rare bucket still says little.
        """
        n0, n1 = np.maximum(counts[:, -1], 1).astype(float)
        share = n1 / (n0 + n1)
        return np.log((counts[1, :-1] + 2 * share) / (counts[0, :-1] + 2 * (1 - share))) - np.log(n1 / n0)

    @classmethod
    def fit(cls, f: Features, y: np.ndarray, given: np.ndarray):
        """A view of the labelled documents and of ``given``, the counts of the pseudo-labelled ones."""
        # Log-odds and regression on different halves: a document must not vouch for its own words.
        half = [np.arange(h, len(y), 2) for h in (0, 1)]
        seen = cls.seen(f)
        own = [_counts(seen, rows, y[rows], cls.size) for rows in half]
        parts = [cls(cls.log_odds(own[h] + given)).inputs(f.take(half[1 - h])) for h in (0, 1)]
        weights = _logistic(np.concatenate(parts), y[np.concatenate([half[1], half[0]])])
        return cls(cls.log_odds(own[0] + own[1] + given), weights)

    def score(self, f: Features) -> np.ndarray:
        return np.column_stack([self.inputs(f), np.ones(len(f.shape))]) @ self.weights


class Content(View):
    size = BUCKETS

    @staticmethod
    def seen(f: Features) -> tuple[np.ndarray, np.ndarray]:
        return _distinct(f.words, f.offsets, BUCKETS)

    def inputs(self, f: Features) -> np.ndarray:
        n = np.diff(f.offsets)
        v = self.odds[f.words]
        full = n > 0
        at = f.offsets[:-1][full]
        out = np.zeros((len(n), 5))
        if len(v):
            out[full, 0] = np.maximum.reduceat(v, at)
            out[full, 1] = np.minimum.reduceat(v, at)
            out[full, 2] = np.add.reduceat(v, at) / n[full]
            out[full, 3] = np.log1p(np.add.reduceat((v > 2.5).astype(float), at))
            out[full, 4] = np.log1p(np.add.reduceat((v < -2.5).astype(float), at))
        return np.column_stack([out, f.shape, f.shape ** 2])


class Meta(View):
    size = META

    @staticmethod
    def seen(f: Features) -> tuple[np.ndarray, np.ndarray]:
        return _distinct(f.meta.ravel(), np.arange(len(f.meta) + 1) * f.meta.shape[1], META)

    def inputs(self, f: Features) -> np.ndarray:
        return self.odds[f.meta]


VIEWS = (Content, Meta)
#: Cells of the counts that one label's views hand each other.
CELLS = sum(2 * (v.size + 1) for v in VIEWS)


@dataclass
class Pair:
    """Both views of one label, each with its calibration on held-out labelled rows."""
    views: list
    calibration: list

    def counts(self, f: Features, seen: list, free: np.ndarray) -> np.ndarray:
        """The ``CELLS`` counts that the views gain from each other's sure documents among ``free``."""
        out = []
        for k, view in enumerate(VIEWS):
            giver, w = self.views[1 - k], self.calibration[1 - k]
            p = _sigmoid(np.clip(giver.score(f), -15, 15) * w[0] + w[1])
            rows = np.flatnonzero(free & ((p >= SURE) | (p <= 1 - SURE)))
            out.append(_counts(seen[k], rows, p[rows] > 0.5, view.size).ravel())
        return np.concatenate(out)


@dataclass
class Model:
    """Both fitted views and the weights that combine their calibrated scores."""
    content: Content | None
    meta: Meta | None
    combine: np.ndarray
    share: float
    rounds: list

    def probability(self, f: Features) -> np.ndarray:
        if self.content is None:
            return np.full(len(f.meta), self.share)
        x = np.clip(np.column_stack([self.content.score(f), self.meta.score(f)]), -15, 15)
        return _sigmoid(np.column_stack([x, np.ones(len(x))]) @ self.combine)


class CoTraining:
    """Co-training of one label: labelled rows here, the unlabelled ones as counts of each round."""

    def __init__(self, labelled: Features, y: np.ndarray):
        self.share = float(y.mean()) if len(y) else 0.5
        self.rounds, self.pair = [], None
        if len(y) < 20 or y.min() == y.max():
            return
        held = np.arange(len(y)) % 4 == 3
        self.train, self.y_train = labelled.take(np.flatnonzero(~held)), y[~held]
        self.test, self.y_test = labelled.take(np.flatnonzero(held)), y[held]
        self._fit(np.zeros(CELLS, np.int64))

    def _fit(self, given: np.ndarray) -> list[int]:
        views, sizes, at = [], [], 0
        for view in VIEWS:
            table = given[at:at + 2 * (view.size + 1)].reshape(2, -1)
            at += table.size
            views.append(view.fit(self.train, self.y_train, table))
            sizes.append(int(table[:, -1].sum()))
        self.pair = Pair(views, [_logistic(np.clip(v.score(self.test), -15, 15)[:, None], self.y_test) for v in views])
        return sizes

    def exchange(self, given: np.ndarray) -> None:
        """One round: both views fitted again with what the other one was sure of."""
        to_content, to_meta = self._fit(given)
        self.rounds.append((to_meta, to_content))

    def model(self) -> Model:
        if self.pair is None:
            return Model(None, None, np.zeros(3), self.share, [])
        content, meta = self.pair.views
        x = np.column_stack([content.score(self.test), meta.score(self.test)])
        return Model(content, meta, _logistic(np.clip(x, -15, 15), self.y_test), self.share, self.rounds)


def co_train(labelled: Features, y: np.ndarray, pool: Features, rounds: int = ROUNDS) -> Model:
    """Fits both views by exchanging confident pseudo-labels on the unlabelled ``pool``, all in one place."""
    training = CoTraining(labelled, y)
    seen = [v.seen(pool) for v in VIEWS]
    for _ in range(rounds if training.pair else 0):
        training.exchange(training.pair.counts(pool, seen, np.ones(len(pool.meta), bool)))
    return training.model()


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of about ``_CHUNK`` text bytes (one row at least)."""
    for batch in batches:
        size = np.array([len(t or b"") for t in batch.column(1).cast(pa.binary()).to_pylist()])
        cut = np.cumsum(size) // _CHUNK
        edges = [0, *(np.flatnonzero(np.diff(cut)) + 1).tolist(), batch.num_rows] if len(size) else [0]
        for a, b in zip(edges[:-1], edges[1:]):
            yield batch.slice(a, b - a)


def _of(part: pa.RecordBatch) -> Features:
    texts = [t or b"" for t in part.column(1).cast(pa.binary()).to_pylist()]
    return features(texts, *[part.column(i).to_pylist() for i in (2, 3, 4)])


def _sample_rows(batches):
    """Features of the sampled documents, packed for the driver."""
    for part in _parts(batches):
        f = _of(part)
        packed = [(f.words[a:b].tobytes(), s.tobytes(), m.tobytes()) for a, b, s, m in
                  zip(f.offsets[:-1], f.offsets[1:], f.shape, f.meta)]
        yield pa.RecordBatch.from_arrays(
            [part.column(0), part.column(5)] + [pa.array(list(x), pa.binary()) for x in zip(*packed)],
            names=["doc_id", "label", "words", "shape", "meta"])


def _unpacked(rows: pd.DataFrame) -> Features:
    words = [np.frombuffer(x, np.int32) for x in rows["words"]]
    return Features(np.concatenate(words) if words else np.zeros(0, np.int32),
                    np.concatenate(([0], np.cumsum([len(w) for w in words]))).astype(np.int64),
                    np.stack([np.frombuffer(x) for x in rows["shape"]]) if len(rows) else np.zeros((0, len(SHAPE))),
                    np.stack([np.frombuffer(x, np.int64) for x in rows["meta"]]) if len(rows) else np.zeros((0, 4), np.int64))


_INPUT = {"doc_id": "long", "text": "string", "lang": "string", "source": "string", "n_chars": "long"}


def _gathered(src: DataFrame, pairs: dict[str, Pair], taken: dict[str, pa.Array]) -> dict[str, np.ndarray]:
    """Per label, the counts its views hand each other from all rows of ``src`` but the ``taken`` ids."""
    state = src.sparkSession.sparkContext.broadcast((list(pairs.items()), taken))

    def run(batches):
        models, labelled = state.value
        counts = np.zeros((len(models), CELLS), np.int64)
        for part in _parts(batches):
            f = _of(part)
            seen = [v.seen(f) for v in VIEWS]
            for k, (name, pair) in enumerate(models):
                free = ~pc.is_in(part.column(0), value_set=labelled[name]).to_numpy(zero_copy_only=False)
                counts[k] += pair.counts(f, seen, free)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts.ravel()[at])], names=["cell", "n"])

    cells = src.select(*_INPUT).mapInArrow(run, "cell long, n long") \
        .groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(len(pairs) * CELLS, np.int64)
    counts[cells.column("cell").to_numpy()] = cells.column("n").to_numpy()
    state.unpersist()
    return dict(zip(pairs, counts.reshape(-1, CELLS)))


def fit(docs: DataFrame, labels: DataFrame, names: list[str], fit_rows: int = FIT_ROWS,
        rounds: int = ROUNDS) -> dict[str, Model]:
    """A model per 0/1 label column of ``labels`` (doc_id, ...).

    Takes the ``fit_rows`` labelled documents of smallest id hash; only their
    ids are ranked, their texts become features in the tasks, and the packed
    features reach the driver.  All other documents are the pool of every
    round.
    """
    src = columns(docs, **_INPUT)
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(c).cast("int") for c in names]) \
        .where("doc_id is not null").groupBy("doc_id").agg(*[F.max(c).alias(c) for c in names])
    ids = src.select("doc_id").where("doc_id is not null").distinct()
    code = F.array(*[F.coalesce(c, F.lit(-1)) for c in names])
    chosen = ids.join(labels, "doc_id").orderBy(F.xxhash64("doc_id")).limit(fit_rows) \
        .select("doc_id", code.alias("label"))     # at most fit_rows short rows: bounded, so broadcast
    rows = src.join(F.broadcast(chosen), "doc_id").select(*_INPUT, "label").mapInArrow(
        _sample_rows, "doc_id long, label array<int>, words binary, shape binary, meta binary") \
        .toArrow().to_pandas().drop_duplicates("doc_id").sort_values("doc_id", ignore_index=True)
    label = np.stack(rows["label"].to_numpy()) if len(rows) else np.zeros((0, len(names)), int)
    doc_ids, both = rows["doc_id"].to_numpy(np.int64), _unpacked(rows)
    del rows
    has = {name: np.flatnonzero(label[:, k] >= 0) for k, name in enumerate(names)}
    training = {name: CoTraining(both.take(has[name]), label[has[name], k].astype(float)) for k, name in enumerate(names)}
    del both
    taken = {name: pa.array(doc_ids[has[name]], pa.int64()) for name in names}
    for _ in range(rounds if any(t.pair for t in training.values()) else 0):
        for name, given in _gathered(src, {k: t.pair for k, t in training.items() if t.pair}, taken).items():
            training[name].exchange(given)
    return {name: t.model() for name, t in training.items()}


def score_documents(docs: DataFrame, labels: DataFrame, min_quality: float = 0.5, max_toxic: float = 0.5) -> DataFrame:
    """doc_id, quality, toxic (probabilities) and kept for every row of ``docs``.

    ``kept``: quality at least ``min_quality`` and toxicity at most ``max_toxic``.
    """
    spark = docs.sparkSession
    names = [c for c in ("quality", "toxic") if c in labels.columns]
    models = spark.sparkContext.broadcast(fit(docs, labels, names))

    def run(batches):
        for part in _parts(batches):
            f = _of(part)
            yield pa.RecordBatch.from_arrays([part.column(0)] + [
                pa.array(models.value[c].probability(f)) if c in models.value else pa.nulls(part.num_rows, pa.float64())
                for c in ("quality", "toxic")], names=["doc_id", "quality", "toxic"])

    scored = columns(docs, **_INPUT).mapInArrow(run, "doc_id long, quality double, toxic double")
    keep = F.coalesce(F.col("quality") >= min_quality, F.lit(True)) & F.coalesce(F.col("toxic") <= max_toxic, F.lit(True))
    return scored.withColumn("kept", keep)
