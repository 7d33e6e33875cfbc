"""Operator 12: importance resampling towards a target distribution.

Documents are drawn with a chance that grows with how much more likely their
words and word pairs are under a target corpus than under all documents.
Features are hashed: every run of one or two consecutive words, joined by a
space, falls into the bucket ``crc32 mod buckets``.

Texts are worked through in blocks of about ``BLOCK`` bytes.  A block's
distinct words, each between two delimiters, make an Aho-Corasick dictionary
whose entries carry the word's checksum and length; one scan of the block emits
the payloads in order, and the payloads of neighbours compose to the checksum
of their pair (a checksum moves over appended bytes by a linear map, applied
here by the bits of the length).  Words above ``LONGEST`` bytes would blow up the
dictionary; their checksums are taken directly and put back in their place.

Bucket ids of a document (two bytes a feature) are written once; counting and
scoring read them, not the texts.  Counts are sums of at most ``buckets`` rows a
task, so gains of a fixed size reach the driver.  Ranks come from a range
partitioning by score and the running row counts of the ranges.

Defined cases: a null or empty text has no feature (weight 0, not eligible);
every row is a document of its own, repeated ids included; ties go to the
smaller id, null ids last, then by features and weight; a null id draws its
random number from the seed alone; an empty target leaves the gains to the
documents' counts; an empty table gives an empty result; other input columns are
ignored, whatever their names.  Texts of any length are used whole.
"""

from __future__ import annotations

import zlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetzone.llm.common import columns, partitions, written

BUCKETS, PERCENT, MIN_WORDS, SEED = 10_000, 25, 20, 7
BLOCK, LONGEST = 1 << 20, 64

#: Every byte that is no digit, letter or part of a non-ASCII character is a delimiter; A-Z are lower-cased.
_NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_POLYNOMIAL = np.uint32(0xEDB88320)
_BYTE, _EIGHT = np.uint32(255), np.uint32(8)


def _appended_bytes() -> np.ndarray:
    """``t[k][i][b]``: what byte ``i`` of a checksum, valued ``b``, becomes when ``2**k`` zero bytes are appended."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & np.uint32(1), (one >> np.uint32(1)) ^ _POLYNOMIAL, one >> np.uint32(1))
    out = np.empty((32, 4, 256), np.uint32)
    for i in range(4):
        value = np.arange(256, dtype=np.uint32) << np.uint32(8 * i)
        out[0, i] = (value >> _EIGHT) ^ one[value & _BYTE]
    for k in range(1, 32):
        out[k] = _moved(out[k - 1], out[k - 1])
    return out


def _moved(crc: np.ndarray, table: np.ndarray) -> np.ndarray:
    out = table[0][crc & _BYTE]
    for i in range(1, 4):
        out = out ^ table[i][(crc >> np.uint32(8 * i)) & _BYTE]
    return out


_TABLES = _appended_bytes()
_SPACE = np.uint32(zlib.crc32(b" "))


def joined(left: np.ndarray, right: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Checksums of two strings put together, from theirs and the length in bytes of the right one."""
    out = left.copy()
    for k in range(int(length.max(initial=0)).bit_length()):
        rows = np.flatnonzero(length >> k & 1)
        out[rows] = _moved(out[rows], _TABLES[k])
    return out ^ right


def _scan(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Checksum, length and start of every word of a normalised block, in order."""
    space = np.frombuffer(block, np.uint8) == 32
    edge = np.diff(np.concatenate(([True], space, [True])).astype(np.int8))
    start, size = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1) - np.flatnonzero(edge == -1)
    payload = np.empty(len(start), np.int64)
    long = size > LONGEST
    words = [w for w in set(block.split()) if len(w) <= LONGEST]
    if words:
        dictionary = ahocorasick.Automaton()
        for w in words:
            dictionary.add_word(f" {w.decode('latin-1')} ", zlib.crc32(w) << 8 | len(w))
        dictionary.make_automaton()
        found = dictionary.iter(f" {block.decode('latin-1')} ")
        payload[~long] = np.fromiter((p for _, p in found), np.int64, int((~long).sum()))
    for i in np.flatnonzero(long).tolist():
        payload[i] = zlib.crc32(block[start[i]:start[i] + size[i]]) << 8
    return (payload >> 8).astype(np.uint32), size, start


def word_payloads(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Checksums and lengths of the words of all texts, one text after the other, and words per text."""
    crc, length, count, i = [], [], np.zeros(len(texts), np.int64), 0
    while i < len(texts):
        if len(texts[i]) > BLOCK:                       # cut at delimiters
            text, at = texts[i].translate(_NORMAL), 0
            while at < len(text):
                stop = text.find(b" ", at + BLOCK)
                stop = len(text) if stop < 0 else stop
                c, n, _ = _scan(text[at:stop])
                crc.append(c)
                length.append(n)
                count[i] += len(c)
                at = stop
            i += 1
            continue
        j, size = i, 0
        while j < len(texts) and size + len(texts[j]) <= BLOCK:
            size += len(texts[j]) + 1
            j += 1
        j = max(j, i + 1)
        c, n, start = _scan(b" ".join(texts[i:j]).translate(_NORMAL))
        ends = np.cumsum([len(t) + 1 for t in texts[i:j]])
        count[i:j] = np.bincount(np.searchsorted(ends, start, side="right"), minlength=j - i)
        crc.append(c)
        length.append(n)
        i = j
    none = [np.zeros(0, np.int64)]
    return np.concatenate(crc or none).astype(np.uint32), np.concatenate(length or none), count


def buckets(texts: list[bytes], size: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the features of all texts, their number per text, and words per text."""
    crc, length, words = word_payloads(texts)
    ids = np.full((len(crc), 2), -1, np.int64)
    ids[:, 0] = crc % np.uint32(size)
    if len(crc) > 1:
        spaced = joined(crc[:-1], _SPACE, np.ones(len(crc) - 1, np.int64))
        ids[:-1, 1] = joined(spaced, crc[1:], length[1:]) % np.uint32(size)
    last = np.cumsum(words)[words > 0] - 1
    ids[last, 1] = -1                                   # a text's last word begins no pair
    ids = ids.ravel()
    return ids[ids >= 0].astype(np.int32), np.maximum(2 * words - 1, 0), words


# --------------------------------------------------------------------------
# Spark
# --------------------------------------------------------------------------

def _slices(batches):
    """Record batches of (id, text) cut to about a block of text, one row at least."""
    for batch in batches:
        size = np.array([len(t or b"") for t in batch.column(1).cast(pa.binary()).to_pylist()], np.int64)
        cut = np.cumsum(size) // (4 * BLOCK)
        edges = [0, *(np.flatnonzero(np.diff(cut)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def _feature_rows(size: int):
    def run(batches):
        for part in _slices(batches):
            ids, n, words = buckets([t or b"" for t in part.column(1).cast(pa.binary()).to_pylist()], size)
            end = np.cumsum(n)
            packed = [ids[e - k:e].tobytes() for e, k in zip(end.tolist(), n.tolist())]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(words), pa.array(packed, pa.binary())],
                                             names=["doc_id", "n_words", "buckets"])
    return run


def features(texts: DataFrame, id_column: str = "doc_id", size: int = BUCKETS) -> DataFrame:
    """doc_id, n_words and the packed buckets (four bytes a feature) of every row, written."""
    src = columns(texts, **{id_column: "long", "text": "string"})
    return written(src.mapInArrow(_feature_rows(size), "doc_id long, n_words long, buckets binary"), "features")


def bucket_counts(feats: DataFrame, size: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all rows: at most ``size`` rows a task, summed by bucket."""
    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            for x in batch.column("buckets").to_pylist():
                total += np.bincount(np.frombuffer(x, np.int32), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    rows = feats.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(size, np.int64)
    out[[r.bucket for r in rows]] = [r.n for r in rows]
    return out


def gains(target: np.ndarray, source: np.ndarray) -> np.ndarray:
    """Whole thousandths of the log likelihood ratio of every bucket, smoothed by one feature a bucket."""
    t, s, size = target.astype(float), source.astype(float), len(target)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + size) / ((s + 1) * (t.sum() + size)))).astype(np.int64)


def _weights(gain: np.ndarray):
    def run(batches):
        for batch in batches:
            ids = [np.frombuffer(x, np.int32) for x in batch.column("buckets").to_pylist()]
            weight = [int(gain[x].sum()) // len(x) if len(x) else 0 for x in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_words"), pa.array([len(x) for x in ids], pa.int64()),
                 pa.array(weight, pa.int64())], names=["doc_id", "n_words", "n_features", "weight"])
    return run


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Whole thousandths of a Gumbel number fixed by seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.left(digest, F.lit(8)), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0)))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED,
             size: int = BUCKETS, target_id: str = "item_id") -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every row of ``docs``.

    Of the rows with at least ``min_words`` words, ``percent`` of a hundred
    (rounded down) are drawn by highest score and ranked from 1; the rank of
    all others is null.
    """
    feats = features(docs, size=size)
    gain = gains(bucket_counts(features(target, target_id, size), size), bucket_counts(feats, size))
    scored = written(feats.mapInArrow(_weights(gain), "doc_id long, n_words long, n_features long, weight long")
                     .withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "scores")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("weight")]
    eligible = F.col("n_words") >= min_words
    ranked = written(scored.where(eligible).repartitionByRange(partitions(docs.sparkSession), *order)
                     .sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "ranked")
    # The upper bits of ``at`` are the range, the lower 33 the row in it.
    part = F.shiftright("at", 33)
    held = sorted((r.part, r.n) for r in ranked.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    before = np.concatenate(([0], np.cumsum([n for _, n in held], dtype=np.int64))).tolist()
    drawn = percent * before[-1] // 100
    ranges = docs.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(held, before)], "part long, before long")
    rank = F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1) + 1
    names = ["doc_id", "n_words", "n_features", "weight", "score"]
    placed = ranked.withColumn("part", part).join(ranges, "part").select(*names, F.when(rank <= drawn, rank).alias("rank"))
    return placed.unionByName(scored.where(~eligible).select(*names, F.lit(None).cast("long").alias("rank")))


#: CRC-32 in DuckDB: its byte table from the rule, and the checksum of a text's bytes.
CRC_TABLE = """
SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1
         THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS tab"""


def crc_sql(text: str) -> str:
    """The unsigned CRC-32 of a text expression; ``tab`` must be in scope."""
    digits = f"hex(encode({text}))"
    step = "xor(c >> 8, tab[(xor(c, b) & 255) + 1])"
    parts = f"list_transform(range(len({digits}) // 2), lambda i: CAST('0x' || substr({digits}, 2 * i + 1, 2) AS BIGINT))"
    return f"xor(list_reduce({parts}, lambda c, b: {step}, 4294967295), 4294967295)"


#: DuckDB twin of the query over ``documents`` and ``benchmark``.
ORACLE = rf"""
WITH crc AS ({CRC_TABLE}),
words AS (
  SELECT 's' AS side, doc_id, row_number() OVER () AS row, text FROM documents
  UNION ALL SELECT 't', NULL, row_number() OVER (), text FROM benchmark),
w AS (
  SELECT side, doc_id, row, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM words),
f AS (
  SELECT side, row, unnest(ws) AS feature FROM w
  UNION ALL SELECT side, row, unnest([ws[i] || ' ' || ws[i + 1] for i in range(1, len(ws))]) FROM w),
d AS (SELECT feature, CAST({crc_sql('feature')} % 10000 AS BIGINT) AS bucket FROM (SELECT DISTINCT feature FROM f), crc),
n AS (SELECT f.side, f.row, d.bucket, count(*) AS n FROM f JOIN d USING (feature) GROUP BY ALL),
s AS (SELECT bucket, sum(n) FILTER (side = 's') AS s, sum(n) FILTER (side = 't') AS t FROM n GROUP BY bucket),
g AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * ((SELECT coalesce(sum(s), 0) FROM s)::DOUBLE + 10000)
           / ((coalesce(s, 0)::DOUBLE + 1) * ((SELECT coalesce(sum(t), 0) FROM s)::DOUBLE + 10000)))) AS BIGINT) AS gain FROM s),
x AS (SELECT n.row, sum(n.n * g.gain)::BIGINT AS total, sum(n.n)::BIGINT AS n_features FROM n JOIN g USING (bucket)
      WHERE side = 's' GROUP BY n.row),
y AS (
  SELECT w.doc_id, len(w.ws) AS n_words, coalesce(x.n_features, 0) AS n_features,
         CASE WHEN x.n_features IS NULL THEN 0 ELSE (x.total - ((x.total % x.n_features) + x.n_features) % x.n_features) // x.n_features END AS weight,
         CAST('0x' || substr(sha256('7:' || coalesce(CAST(w.doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
  FROM w LEFT JOIN x USING (row) WHERE w.side = 's'),
z AS (SELECT doc_id, n_words, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM y),
r AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS place,
             count(*) FILTER (n_words >= 20) OVER () AS eligible FROM z)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
       CAST(CASE WHEN n_words >= 20 AND place <= 25 * eligible // 100 THEN place END AS BIGINT) AS rank
FROM r
"""
