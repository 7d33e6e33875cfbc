"""Operator 1: near-duplicate groups by banded SetSketch registers.

Documents are linked when the Jaccard similarity of their shingle sets
reaches the threshold; groups are the connected components of the links.

1. One pass computes each document's shingle set, its registers
   (:mod:`fleetzone.llm.sketch`), band keys and a 128-bit identity of the set.
   Equal sets collapse to their smallest id before anything is paired.
2. Documents that share a band key form a bucket.  Every member is compared
   with the bucket's smallest id (linear in the bucket): first the joint
   likelihood estimate from the registers, then the full sets.
3. Links give components.  Buckets that still hold more than one component
   are compared inside the bucket, by estimate, in blocks of at most
   ``BLOCK`` rows; each candidate pair is taken in the first band it shares.
   The candidates are verified on full sets next to each other, and only
   links that join two components leave the task.
4. Components of all links, then every document gets its group's smallest id.

No pair list of a group is ever written: step 2 emits one row per member,
step 3 one row per member and bucket with the partners as an array.
With 32 bands of 4 registers a pair at similarity 0.8 shares no band with
probability 5e-8; the estimate's margin (0.18, five standard errors) loses
fewer than 1e-6 of such pairs.

Defined cases: null or wordless text has an empty set and is linked with
nothing; fewer words than the shingle length give one shingle of the whole
sequence; repeated rows share one group; a null id is returned unlinked with
a null component; an empty table gives an empty result; other input columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetzone.llm import sketch, vectext
from fleetzone.llm.common import columns, written

MARGIN = 0.18
BLOCK = 2048
#: Texts hashed together: bounds a task's arrays.
BATCH_BYTES = 2 << 20

_SKETCH = ("doc_id long, n_shingles long, sig1 long, sig2 long, regs binary, keys array<long>")


def _batches(batches: Iterator[pa.RecordBatch], limit: int = BATCH_BYTES) -> Iterator[tuple[list, list]]:
    """(ids, texts as bytes) of a bounded number of text bytes each."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
            t = t or b""
            ids.append(i)
            texts.append(t)
            size += len(t) + 64
            if size >= limit:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    return sketch.distinct_shingles(*vectext.word_hashes(texts), words)


def _sketch_rows(words: int):
    def run(batches):
        for ids, texts in _batches(batches):
            sets = _sets(texts, words)
            regs = sketch.build(sets)
            keys = sketch.band_keys(regs)
            one = [int(vectext.mix(s).sum(dtype=np.uint64).view(np.int64)) if len(s) else 0 for s in sets]
            two = [int(vectext.mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64))
                   if len(s) else 0 for s in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(one, pa.int64()), pa.array(two, pa.int64()),
                 pa.array([r.tobytes() for r in regs], pa.binary()),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * sketch.BANDS, pa.int32()),
                                          pa.array(keys.ravel()))],
                names=["doc_id", "n_shingles", "sig1", "sig2", "regs", "keys"])
    return run


def _set_rows(words: int):
    def run(batches):
        for ids, texts in _batches(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([s.tobytes() for s in _sets(texts, words)], pa.binary())],
                names=["doc_id", "shingles"])
    return run


def _registers(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint16).reshape(-1, sketch.REGISTERS)


def _likely(threshold: float):
    """Keep (doc, partner) pairs whose sizes allow the threshold and whose estimate is near it."""
    def run(frames):
        for f in frames:
            na, nb = f["n_a"].to_numpy(float), f["n_b"].to_numpy(float)
            fits = np.minimum(na, nb) >= threshold * np.maximum(na, nb) - 1e-9
            f = f[fits]
            if len(f):
                est = sketch.estimate(_registers(f["regs_a"]), _registers(f["regs_b"]), na[fits], nb[fits])
                yield f.loc[est >= threshold - MARGIN, ["doc_id", "pivot"]]
    return run


def _runs(gid: np.ndarray) -> list[tuple[int, int]]:
    """(start, stop) of every run of equal values."""
    edges = [0, *(np.flatnonzero(gid[1:] != gid[:-1]) + 1).tolist(), len(gid)]
    return list(zip(edges[:-1], edges[1:]))


def _compare(threshold: float):
    """Candidate partners inside each bucket block of a bin (members of different components)."""
    def block(regs, n, comp, ids, left, right, key):
        keys = sketch.band_keys(regs)
        band = int(np.flatnonzero(keys[0] == key)[0])
        partners, used = {}, np.zeros(len(ids), bool)
        for a in range(len(ids) - 1):
            b = np.arange(a + 1, len(ids))
            ok = (comp[b] != comp[a]) & (np.minimum(n[a], n[b]) >= threshold * np.maximum(n[a], n[b]) - 1e-9)
            ok &= (left[a] & right[b]) | (right[a] & left[b])
            b = b[ok]
            if band and len(b):
                b = b[~(keys[b, :band] == keys[a, :band]).any(axis=1)]
            if len(b):
                same = (regs[b] == regs[a]).mean(axis=1)
                b = b[same >= threshold - MARGIN - 0.1]
            if len(b):
                est = sketch.estimate(np.broadcast_to(regs[a], (len(b), regs.shape[1])), regs[b],
                                      np.full(len(b), n[a]), n[b])
                b = b[est >= threshold - MARGIN]
            if len(b):
                partners[a] = ids[b]
                used[a] = used[b] = True
        return np.flatnonzero(used), partners

    def run(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values(["gid", "doc_id"], ignore_index=True)
        gid, ids, comp, key = (f[c].to_numpy() for c in ("gid", "doc_id", "comp", "key"))
        n, left, right = f["n_shingles"].to_numpy(float), f["left"].to_numpy(), f["right"].to_numpy()
        regs = _registers(f["regs"])
        rows, others, none = [], [], np.zeros(0, np.int64)
        for s, e in _runs(gid):
            at, partners = block(regs[s:e], n[s:e], comp[s:e], ids[s:e], left[s:e], right[s:e], key[s])
            rows.append(at + s)
            others += [partners.get(a, none) for a in at.tolist()]
        at = np.concatenate(rows)
        return pd.DataFrame({"gid": gid[at], "doc_id": ids[at], "comp": comp[at],
                             "others": pd.Series(others, dtype=object)})
    return run


def _verify(percent: int):
    """Exact links among the listed pairs of each group of a bin; one per newly joined pair of components."""
    def group(ids, comp, sets, partners, links):
        place = {d: i for i, d in enumerate(ids.tolist())}
        size = np.array([len(s) for s in sets])
        codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
        start = np.concatenate(([0], np.cumsum(size)[:-1]))
        root = {c: c for c in comp.tolist()}

        def find(c):
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        mark = np.zeros(len(codes) + 1, bool)
        for a, others in enumerate(partners):
            b = np.array([i for i in map(place.__getitem__, others) if find(comp[i]) != find(comp[a])], np.int64)
            if not len(b):
                continue
            own = codes[start[a]:start[a] + size[a]]
            mark[own] = True
            hit = mark[vectext.gather(codes, start[b], size[b])]
            common = np.add.reduceat(hit.astype(np.int64), np.concatenate(([0], np.cumsum(size[b])[:-1])))
            mark[own] = False
            for i in b[100 * common >= percent * (size[a] + size[b] - common)]:
                x, y = find(comp[a]), find(comp[i])
                if x != y:
                    root[max(x, y)] = min(x, y)
                    links.append((int(comp[a]), int(comp[i])))

    def run(f: pd.DataFrame) -> pd.DataFrame:
        # A document may stand twice in a group, with and without partners: the one with comes first.
        f = f.assign(n=-f["others"].map(len)).sort_values(["gid", "doc_id", "n"], ignore_index=True) \
            .drop_duplicates(["gid", "doc_id"], ignore_index=True)
        gid, ids, comp = (f[c].to_numpy() for c in ("gid", "doc_id", "comp"))
        sets = [np.frombuffer(s, np.uint64) for s in f["shingles"]]
        others = f["others"].tolist()
        links = []
        for s, e in _runs(gid):
            group(ids[s:e], comp[s:e], sets[s:e], others[s:e], links)
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")
    return run


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """(node, comp) of the undirected ``links`` (a, b): comp is the smallest node reachable.

    The smallest node of a component has no row of its own.

    Alternates large-star and small-star steps (each a grouped minimum over
    the edges) until the edge set no longer changes; then every node points
    at its smallest.  Each round is written, so lineage stays short.  A hub
    with many neighbours only takes part in grouped minimums and joins that
    can be split.
    """
    def stars(e: DataFrame, large: bool) -> DataFrame:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else \
            e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        j = both.join(least, "a")
        if large:
            out = j.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = j.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    edges = written(links.select("a", "b").where("a <> b").distinct(), label)
    seen = None
    while True:
        edges = written(stars(stars(edges, True), False), label)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("comp"))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text).

    Links pairs with ``100 * intersection >= percent * union`` of their sets
    of distinct ``words``-word shingles.  ``kept`` marks the smallest id of
    each group.
    """
    threshold = percent / 100
    src = columns(docs, doc_id="long", text="string")
    sk = written(src.mapInArrow(_sketch_rows(words), _SKETCH), "sketch")
    classes = written(sk.where("n_shingles > 0 and doc_id is not null").groupBy("sig1", "sig2", "n_shingles")
                      .agg(F.min("doc_id").alias("rep")), "classes")
    reps = sk.join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    rows = reps.select(F.explode("keys").alias("key"), "doc_id")
    pivots = rows.groupBy("key").agg(F.min("doc_id").alias("pivot"), F.count("*").alias("members")).where("members > 1")
    members = written(rows.join(pivots, "key"), "members")
    ids = members.select("doc_id").distinct()
    small = written(reps.select("doc_id", "n_shingles", "regs").join(ids, "doc_id", "left_semi"), "registers")
    sets = written(src.join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id"])
                   .mapInArrow(_set_rows(words), "doc_id long, shingles binary"), "sets")

    # Groups (buckets, pivots with their documents) are worked through in bins of about BLOCK rows.
    bins = members.count() // BLOCK + 1
    bin_of = F.pmod(F.xxhash64("gid"), F.lit(bins)).alias("bin")

    def links_of(groups: DataFrame) -> DataFrame:
        return groups.join(sets, "doc_id").groupBy(bin_of).applyInPandas(_verify(percent), "a long, b long")

    a = small.select("doc_id", F.col("n_shingles").alias("n_a"), F.col("regs").alias("regs_a"))
    b = small.select(F.col("doc_id").alias("pivot"), F.col("n_shingles").alias("n_b"), F.col("regs").alias("regs_b"))
    likely = written(members.where("doc_id <> pivot").select("doc_id", "pivot").distinct()
                     .join(a, "doc_id").join(b, "pivot")
                     .mapInPandas(_likely(threshold), "doc_id long, pivot long"), "likely")
    fan = likely.groupBy("pivot").agg(F.ceil(F.count("*") / BLOCK).alias("salts"))
    salted = likely.join(fan, "pivot").select(
        F.xxhash64("pivot", F.pmod(F.xxhash64("doc_id"), "salts")).alias("gid"), "doc_id", "pivot")
    groups = salted.select("gid", "doc_id", F.col("doc_id").alias("comp"), F.array("pivot").alias("others")).union(
        salted.select("gid", F.col("pivot").alias("doc_id"), F.col("pivot").alias("comp"),
                      F.array().cast("array<long>").alias("others")).distinct())
    first = components(links_of(groups), "first")

    placed = members.join(first.withColumnRenamed("node", "doc_id"), "doc_id", "left") \
        .select("key", "doc_id", F.coalesce("comp", "doc_id").alias("comp"), "members")
    mixed = placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
    rows = placed.join(mixed.select("key"), "key").join(small, "doc_id") \
        .withColumn("blocks", F.ceil(F.col("members") / BLOCK)) \
        .withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks"))) \
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    paired = rows.select(
        F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("gid"), "key", "doc_id",
        "comp", "n_shingles", "regs", (F.col("block") <= F.col("other")).alias("left"),
        (F.col("block") >= F.col("other")).alias("right"))
    candidates = written(paired.groupBy(bin_of).applyInPandas(
        _compare(threshold), "gid long, doc_id long, comp long, others array<long>"), "candidates")
    second = links_of(candidates)
    comps = components(first.select(F.col("node").alias("a"), F.col("comp").alias("b")).union(second), "all")

    labels = classes.join(comps.withColumnRenamed("node", "rep"), "rep", "left") \
        .select("sig1", "sig2", "n_shingles", F.coalesce("comp", "rep").alias("component"))
    return sk.select("doc_id", "n_shingles", "sig1", "sig2") \
        .join(labels, ["sig1", "sig2", "n_shingles"], "left") \
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
                .alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
