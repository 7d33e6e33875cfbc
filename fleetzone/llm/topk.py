"""Operator 3: exact top-k search by no-random-access aggregation.

A candidate's score is the sum over dimensions of query component times
candidate component.  Every dimension is a list of the candidates sorted by
that component, read from the top for a positive query component and from the
bottom for a negative one.  Reading all lists to the same depth gives each
candidate a lower and an upper bound: the products read so far, plus the
least and the most that its unread components can add.  Reading stops when no
candidate outside the k best lower bounds can still reach them; only the
candidates whose upper bound reaches the k-th lower bound are resolved.

Spark deals the work out as (query block, candidate group) pairs of bounded
size; every pair is searched on its own and returns at most k rows a query,
and a ranked window keeps the k best of a query.  Within a group the k-th
score of the blocks read so far carries over, so later blocks stop earlier.

Components are floor(scale * x) integers.  While no product sum can reach
2**53, 64-bit floats hold every score exactly.  Beyond, the bounds are taken on
scaled components with room for their rounding, and the candidates left are
resolved in whole numbers of any size.  Ties go to the smaller id.  A score
among the k best of its group that does not fit a 64-bit integer is an error.

Defined cases: a vector that is null, empty of components, or holds a null or
non-finite component takes no part, neither as query nor as candidate; fewer
than k candidates are all returned; a query is never its own candidate (all
rows with its id are left out); repeated candidate rows are each returned;
vectors of different lengths are compared only with those of their length; a
null id takes no part; an empty table gives an empty result; other input
columns are ignored, whatever their names.
"""

from __future__ import annotations

import operator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetzone.llm.common import written

QUERY_BLOCK = 512
GROUP_ROWS = 8192
BLOCK_ROWS = 4096
#: Depths of reading, as shares of a list.
DEPTHS = (0.125, 0.25, 0.5)


#: Below this every sum of products is exact in a 64-bit float.
EXACT = 2.0 ** 53
_LONG = 2 ** 63 - 1


def search_block(q: np.ndarray, c: np.ndarray, k: int, floor: np.ndarray, slack: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, candidate) that may be among a query's k best of this block.

    ``floor`` is a score per query that k candidates elsewhere reach already,
    ``slack`` the most that rounding may have changed a bound.
    All queries of the block read the lists to the same depths; a query whose
    outsiders cannot qualify any more leaves the reading.
    """
    n = len(c)
    order = np.argsort(c, axis=0, kind="stable")
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(n)[:, None], axis=0)
    lists = np.take_along_axis(c, order, axis=0)
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    least = up @ lists[0] + down @ lists[-1]           # every component at its worst
    active = np.arange(len(q))
    found_q, found_c = [], []
    for share in (*DEPTHS, 1.0):
        depth = min(n, max(k, int(n * share)))
        top, low = rank >= n - depth, rank < depth     # read from the top / from the bottom
        qu, qd = up[active], down[active]
        read = qu @ (c * top).T + qd @ (c * low).T
        if depth == n:
            lower = upper = read
        else:
            # Unread components lie between the list's far end and its frontier.
            worst_u, worst_d = qu * lists[0], qd * lists[-1]
            best_u, best_d = qu * lists[n - depth], qd * lists[depth - 1]
            lower = read + least[active][:, None] - worst_u @ top.T - worst_d @ low.T
            upper = read + (best_u.sum(1) + best_d.sum(1))[:, None] - best_u @ top.T - best_d @ low.T
        kth = np.partition(lower, n - k, axis=1)[:, n - k] if n > k else np.full(len(active), -np.inf)
        kth = np.maximum(kth, floor[active])
        able = upper >= kth[:, None] - 2 * slack
        done = able.sum(1) <= max(4 * k, n // 64)
        if depth == n:
            done[:] = True
        a, b = np.nonzero(able[done])
        found_q.append(active[done][a])
        found_c.append(b)
        active = active[~done]
        if not len(active):
            break
    return np.concatenate(found_q), np.concatenate(found_c)


def _search(k: int):
    """The k best candidates of every query of one (query block, candidate group) pair."""
    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(rows):
            rows = rows.sort_values("vec_id", ignore_index=True)
            for width in np.unique(queries["v"].map(len)):
                fit = queries[queries["v"].map(len) == width]
                same = rows[rows["v"].map(len) == width]
                if len(same):
                    out.append(_best(fit, same, k))
        if not out:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        return pd.concat(out, ignore_index=True)

    return run


def _unit(x: np.ndarray) -> np.ndarray:
    """Components divided by a power of two that brings the largest to one at most."""
    return np.ldexp(x, -int(np.frexp(np.abs(x).max())[1]))


def _pairs_to_resolve(q: np.ndarray, c: np.ndarray, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs that the bounds leave, and their exact scores."""
    with np.errstate(over="ignore", invalid="ignore"):
        most = float((np.abs(q).max(0) * np.abs(c).max(0)).sum())
    if most < EXACT:
        i, j = search_block(q, c, k, floor)
        parts = [np.einsum("ij,ij->i", q[i[s:s + 65536]], c[j[s:s + 65536]]) for s in range(0, len(i), 65536)]
        return i, j, np.concatenate(parts or [np.zeros(0)]).astype(np.int64).astype(object)
    dims = q.shape[1]
    i, j = search_block(_unit(q), _unit(c), k, np.full(len(q), -np.inf), 16 * dims * dims / EXACT)
    wide_q, wide_c = ([[int(x) for x in row] for row in m] for m in (q, c))
    score = np.empty(len(i), object)
    score[:] = [sum(map(operator.mul, wide_q[a], wide_c[b])) for a, b in zip(i.tolist(), j.tolist())]
    return i, j, score


def _best(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    q = np.floor(np.stack(queries["v"].to_numpy()).astype(float))
    ids = queries["vec_id"].to_numpy()
    floor = np.full(len(q), -np.inf)
    best = pd.DataFrame({"q": [], "vec_id": [], "score": []}, dtype="int64").astype({"score": object})
    for a in range(0, len(rows), BLOCK_ROWS):
        part = rows.iloc[a:a + BLOCK_ROWS]
        c, cid = np.floor(np.stack(part["v"].to_numpy()).astype(float)), part["vec_id"].to_numpy()
        # One place more for each row that is the query itself.
        own = int(pd.Series(cid).value_counts().max())
        i, j, score = _pairs_to_resolve(q, c, min(len(c), k + own), floor)
        keep = ids[i] != cid[j]
        new = pd.DataFrame({"q": i[keep], "vec_id": cid[j[keep]], "score": pd.Series(
            [max(min(x, _LONG + 1), -_LONG - 2) for x in score[keep]], dtype=object)})    # what no long holds stays beyond
        best = pd.concat([best, new]).sort_values(["q", "score", "vec_id"], ascending=[True, False, True])
        best = best[best.groupby("q").cumcount() < k]
        full = best.groupby("q")["score"].agg(["size", "min"])
        full = full[full["size"] == k]
        floor[full.index.to_numpy()] = full["min"].to_numpy(float)
    if any(not -_LONG - 1 <= x <= _LONG for x in best["score"]):
        raise OverflowError("an inner product does not fit a 64-bit integer")
    return pd.DataFrame({"query_id": ids[best["q"].to_numpy()], "vec_id": best["vec_id"].to_numpy(),
                         "score": best["score"].to_numpy(np.int64)})


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, scale: int = 1024) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of every row whose id is divisible by ``every``.

    ``vectors`` has vec_id and embedding (array of numbers).
    """
    src = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                         F.col("embedding").cast("array<double>").alias("x"))
    fine = F.col("vec_id").isNotNull() & (F.size("x") > 0) & ~F.exists(
        "x", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    # Scaled, rounded down where they are used: a long could not hold every component.
    rows = written(src.where(fine).select("vec_id", F.transform("x", lambda e: e * F.lit(float(scale))).alias("v")), "vectors")
    queries = rows.where(F.col("vec_id") % every == 0)
    n_rows, n_queries = rows.count(), queries.count()
    groups, blocks = -(-n_rows // GROUP_ROWS) or 1, -(-n_queries // QUERY_BLOCK) or 1
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.withColumn("qb", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).withColumn("cg", numbers(groups))
    right = rows.withColumn("cg", F.pmod(F.xxhash64("vec_id", "v"), F.lit(groups)).cast("int")).withColumn("qb", numbers(blocks))
    found = left.select("qb", "cg", "vec_id", "v").groupBy("qb", "cg").cogroup(
        right.select("qb", "cg", "vec_id", "v").groupBy("qb", "cg")).applyInPandas(
            _search(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


#: DuckDB twin of the query over ``embeddings``.
ORACLE = """
WITH e AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum([CAST(q.v[i] AS HUGEINT) * c.v[i] for i in range(1, len(q.v) + 1)]) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
"""
