"""Operator 13: quality rules, with an isolation forest over their statistics.

Every text gets rule statistics (counts of words, symbols, repeated lines and
repeated word windows).  Fixed base rules reject short and repetitive texts.
The others are judged by an isolation forest: trees of random splits over the
statistics' ratios; a text that ends on short paths is anomalous.  The forest is
fitted on labelled good texts, its ranges widened by ``MARGIN`` times each
ratio's spread over all labelled texts, so that values no good text has can be
split off.  Repeated lines are counted but are no ratio of the forest: good texts
differ in them more than bad ones do.  The threshold on the score is calibrated on all labelled texts that pass
the base rules: of the thresholds that reject at most ``MAX_FALSE`` of the good
ones, the one that tells good from bad best.

Only the fit is bounded: ``trees * sample`` good rows of smallest id hash reach
the driver as a few numbers each.  Statistics, calibration counts (grouped by
score bin and label) and scores cover all rows.  Texts are read once, row by row
in blocks; a very long text is worked through in pieces cut at white space, and
only its distinct words and one number a word are held.

Defined cases: a null or empty text has no words (all counts 0, fails the base);
every row is judged on its own, repeated ids included; a null id has no label;
of several labels of one id the greatest counts, null labels are none.  Without
labelled good rows there is no forest, without bad ones no threshold: then the
base rules alone decide.  An empty table gives an empty result; other input
columns are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetzone.llm.common import columns, written

MIN_WORDS, MAX_REPEAT = 50, 50
TREES, SAMPLE, MARGIN = 100, 256, 1.0
MAX_FALSE = 0.01
BINS = 1000
_PIECE = 1 << 20

_SPACE, _SYMBOL, _CAPITAL, _MARK, _LATER = range(1, 6)
_KIND = np.zeros(256, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = _SPACE
_KIND[list(b"#*$%&|<>")] = _SYMBOL
_KIND[list(range(65, 91))] = _CAPITAL
_KIND[list(b".,;:!?")] = _MARK
_KIND[128:192] = _LATER                  # the bytes of a character after its first

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals", "n_marks"]
RATIOS = ["word_length", "symbols", "repeat_words", "capitals", "marks"]


def _pieces(text: bytes):
    """A text in pieces of about ``_PIECE`` bytes, cut at white space."""
    at = 0
    while at < len(text):
        stop = min(at + _PIECE, len(text))
        while stop < len(text) and not text[stop:stop + 1].isspace():
            rest = np.flatnonzero(_KIND[np.frombuffer(text, np.uint8, min(_PIECE, len(text) - stop), stop)] == _SPACE)
            stop = stop + int(rest[0]) if len(rest) else min(stop + _PIECE, len(text))
        yield text[at:stop]
        at = stop


def _word_numbers(text: bytes) -> np.ndarray:
    """The words of a text as numbers (the place of each word's first occurrence)."""
    first: dict[bytes, int] = {}
    out, n = [np.zeros(0, np.int64)], 0
    for piece in _pieces(text):
        words = piece.split()
        out.append(np.fromiter(map(first.setdefault, words, range(n, n + len(words))), np.int64, len(words)))
        n += len(words)
    return np.concatenate(out)


def repeated_words(words: np.ndarray) -> int:
    """Words inside a three-word window that occurs twice or more."""
    n = len(words)
    if n < 4:
        return 0
    pair = np.unique(words[:-1] * n + words[1:], return_inverse=True)[1]
    _, window, count = np.unique(pair[:-1] * n + words[2:], return_inverse=True, return_counts=True)
    again = count[window] > 1
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k:n - 2 + k] |= again
    return int(covered.sum())


def statistics(text: bytes) -> list[int]:
    """``COUNTS`` of one text."""
    kinds = np.zeros(6, np.int64)
    for at in range(0, len(text), _PIECE):
        kinds += np.bincount(_KIND[np.frombuffer(text, np.uint8, min(_PIECE, len(text) - at), at)], minlength=6)
    words = _word_numbers(text)
    n_lines, lines = 0, set()
    for line in text.split(b"\n"):
        if line and not line.isspace():
            n_lines += 1
            lines.add(line)
    return [len(words), len(text) - int(kinds[_SPACE] + kinds[_LATER]), int(kinds[_SYMBOL]), n_lines - len(lines),
            repeated_words(words), int(kinds[_CAPITAL]), int(kinds[_MARK])]


def ratios(counts: np.ndarray) -> np.ndarray:
    """``RATIOS`` of rows of ``COUNTS``; none depends on a text's length alone."""
    words, chars, symbols, _, repeat, capitals, marks = counts.astype(float).T
    n, c = np.maximum(words, 1), np.maximum(chars, 1)
    return np.column_stack([chars / n, symbols / c, repeat / n, capitals / c, marks / c])


# --------------------------------------------------------------------------
# The forest
# --------------------------------------------------------------------------

def _usual_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search in a random binary tree of ``n`` rows."""
    n = np.asarray(n, float)
    m = np.maximum(n - 1, 1)
    return np.where(n > 2, 2 * (np.log(m) + 0.5772156649) - 2 * m / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Trees as arrays: split ratio (-1 in a leaf), value, left child (right is the next), path length."""

    ratio: list
    value: list
    child: list
    path: list
    usual: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Anomaly of every row, 0 to 1: half at usual path lengths, near 1 at very short ones."""
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for ratio, value, child, path in zip(self.ratio, self.value, self.child, self.path):
            node = np.zeros(len(x), np.int64)
            while True:
                split = ratio[node]
                inner = split >= 0
                if not inner.any():
                    break
                node = np.where(inner, child[node] + (x[rows, split] >= value[node]), node)
            total += path[node]
        return 2.0 ** (-total / max(len(self.path), 1) / self.usual)


def grow(good: np.ndarray, spread: np.ndarray, trees: int = TREES, sample: int = SAMPLE, seed: int = 13) -> Forest:
    """A forest over rows of ratios; ``spread`` is each ratio's standard deviation over all labelled rows."""
    rnd = np.random.RandomState(seed)
    size = min(sample, len(good))
    deepest = int(np.ceil(np.log2(max(size, 2)))) + 2
    usable = np.flatnonzero(spread > 0)
    forest = Forest([], [], [], [], float(max(_usual_path(size), 1.0)))
    for _ in range(trees):
        rows = good[rnd.choice(len(good), size, replace=False)]
        ratio, value, child, path = [-1], [0.0], [0], [0.0]
        todo = [(0, rows, 0)]
        while todo:
            node, part, depth = todo.pop()
            if len(part) < 2 or depth >= deepest or not len(usable):
                path[node] = depth + float(_usual_path(len(part)))
                continue
            k = int(rnd.choice(usable))
            low, high = part[:, k].min() - MARGIN * spread[k], part[:, k].max() + MARGIN * spread[k]
            ratio[node], value[node], child[node] = k, rnd.uniform(low, high), len(ratio)
            right = part[:, k] >= value[node]
            for half in (part[~right], part[right]):
                todo.append((len(ratio), half, depth + 1))
                for column, empty in ((ratio, -1), (value, 0.0), (child, 0), (path, 0.0)):
                    column.append(empty)
        forest.ratio.append(np.array(ratio))
        forest.value.append(np.array(value))
        forest.child.append(np.array(child))
        forest.path.append(np.array(path))
    return forest


def calibrate(bins: np.ndarray, good: np.ndarray, bad: np.ndarray, max_false: float = MAX_FALSE) -> float | None:
    """Least score to reject, from good and bad rows per score bin; None if nothing is to be rejected."""
    if not good.sum() or not bad.sum():
        return None
    order = np.argsort(bins)[::-1]
    false, true = np.cumsum(good[order]) / good.sum(), np.cumsum(bad[order]) / bad.sum()
    gain = np.where(false <= max_false, true - false, -1.0)
    best = int(np.argmax(gain))
    return float(bins[order][best]) / BINS if gain[best] > 0 else None


# --------------------------------------------------------------------------
# Spark
# --------------------------------------------------------------------------

def _statistics_rows(batches):
    for batch in batches:
        rows = [statistics(t or b"") for t in batch.column(1).cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0)] + [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * len(COUNTS))],
            names=["doc_id", *COUNTS])


def _matrix(batch) -> np.ndarray:
    return np.column_stack([batch.column(c).to_numpy() for c in COUNTS])


def _score_rows(forest: Forest):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(forest.score(ratios(_matrix(batch))))],
                                                 names=[*batch.schema.names, "score"])
    return run


def judge(docs: DataFrame, labels: DataFrame, label: str = "quality", trees: int = TREES, sample: int = SAMPLE,
          max_false: float = MAX_FALSE) -> DataFrame:
    """doc_id, the ``COUNTS``, base_failed, score (anomaly, null without a forest) and kept of every row of ``docs``.

    ``label`` is 1 for good rows and 0 for bad ones.
    """
    kinds = ", ".join(f"{c} long" for c in ["doc_id", *COUNTS])
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    stats = written(columns(docs, doc_id="long", text="string").mapInArrow(_statistics_rows, kinds), "statistics") \
        .withColumn("base_failed", failed)
    known = columns(labels, doc_id="long", **{label: "long"}).where(f"doc_id is not null and `{label}` is not null") \
        .groupBy("doc_id").agg(F.max(label).alias("label"))
    labelled = stats.where(~failed).join(known, "doc_id")
    good = labelled.where("label = 1").orderBy(F.xxhash64("doc_id"), *COUNTS).limit(trees * sample).select(*COUNTS).toArrow()
    if not good.num_rows:
        return stats.select("doc_id", *COUNTS, "base_failed", F.lit(None).cast("double").alias("score"),
                            (~F.col("base_failed")).alias("kept"))
    forest = grow(ratios(_matrix(good)), _spread(labelled), trees, sample)
    scored = written(stats.mapInArrow(_score_rows(forest), f"{kinds}, base_failed boolean, score double"), "scores")
    bins = scored.where("not base_failed").join(known, "doc_id") \
        .groupBy(F.floor(F.col("score") * BINS).alias("bin")).agg(
            F.count(F.when(F.col("label") == 1, 1)).alias("good"), F.count(F.when(F.col("label") == 0, 1)).alias("bad")).toArrow()
    threshold = calibrate(*[bins.column(c).to_numpy() for c in ("bin", "good", "bad")], max_false)
    verdict = F.lit(True) if threshold is None else F.col("score") < threshold
    return scored.withColumn("kept", ~F.col("base_failed") & verdict)


def _spread(labelled: DataFrame) -> np.ndarray:
    """Standard deviation of every ratio over all labelled rows, from sums over the tasks' rows."""
    def run(batches):
        total = np.zeros((3, len(RATIOS)))
        for batch in batches:
            x = ratios(_matrix(batch)) if batch.num_rows else np.zeros((0, len(RATIOS)))
            total += np.stack([np.full(len(RATIOS), len(x)), x.sum(0), (x * x).sum(0)])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(RATIOS)))] + [pa.array(t) for t in total],
                                         names=["ratio", "n", "s", "q"])

    rows = labelled.select(*COUNTS).mapInArrow(run, "ratio long, n double, s double, q double").groupBy("ratio").agg(
        *[F.sum(c).alias(c) for c in ("n", "s", "q")]).orderBy("ratio").collect()
    n, s, q = (np.array([r[c] for r in rows]) for c in ("n", "s", "q"))
    variance = q / np.maximum(n, 1) - (s / np.maximum(n, 1)) ** 2
    return np.sqrt(np.where(variance > 1e-12, variance, 0.0))
