"""Operator 9: token counts of documents in flat, unindexed token files.

A token file is a run of 16-bit little-endian ids; a document ends with the
end-of-document id, and nothing else says where it starts.  Files are listed
with their lengths only and cut into ranges of ``BLOCK_TOKENS``; each range is a
row that any task can read, so one long file is read by many tasks.  One
vectorised search finds a range's separators.  Documents that lie within a
range are counted there; those that cross its end are stitched by a prefix scan
over the ranges' summaries of four numbers (running count of documents begun,
next separator further on).  No list of separators leaves its range.

Defined cases: an empty file has no documents; two separators in a row are a
document of no tokens; tokens after the last separator are one more document
with ``terminated`` false; an odd number of bytes is an error; a document may
fill whole ranges; no file is too long.  A file must not change while it is read.

:func:`write_token_files` makes such files with Spark's text writer: a row is
a document's bytes, the line separator is the end-of-document id.  A null text
is an empty one, repeated rows are written again, other columns are ignored; an
empty table gives files without documents, or none.  A vocabulary whose ids do
not fit into 16 bits, or hold the end-of-document id, is an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetzone.llm import bpe, vectext
from fleetzone.llm.common import columns, partitions, written

BLOCK_TOKENS = 1 << 20
#: A free id of the vocabulary marks the end of a document.
EOD = 50256
#: Leading tokens that hold the 64-bit document id, 15 bits each.
ID_TOKENS = 5
#: Encoded words that a task keeps before it starts anew.
_SEEN_WORDS = 1 << 20


def _opened(path: str):
    """A file of the input opened for reading at any place, on the worker."""
    if path.startswith("file:") or "://" not in path:
        return pa.OSFile("/" + path.removeprefix("file:").lstrip("/"))
    system, name = pafs.FileSystem.from_uri(path)
    return system.open_input_file(name)


_RANGE = pa.schema([("path", pa.string()), ("block", pa.int64()), ("tokens", pa.int64()), ("ends", pa.list_(pa.int64())),
                    ("starts", pa.list_(pa.int64())), ("heads", pa.list_(pa.list_(pa.int32())))])


def _scan(eod: int, head: int, block: int):
    """Separators and document starts of every range, with the documents' first tokens."""
    def run(batches):
        for batch in batches:
            for path, k, size in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                if size % 2:
                    raise ValueError(f"{path}: an odd number of bytes")
                at, tokens = k * block, size // 2
                # The head of a document that begins at or near the end lies in the next range.
                want = min(block + head, tokens - at) * 2
                with _opened(path) as f:
                    f.seek(2 * at)
                    data = f.read(want)
                if len(data) != want:
                    raise ValueError(f"{path}: shorter than listed")
                data = np.frombuffer(data, "<u2")
                ends = np.flatnonzero(data[:block] == eod)
                starts = np.concatenate(([0], ends + 1)) if k == 0 else ends + 1
                starts = starts[starts + at < tokens]
                heads = [data[s:s + head].astype(np.int32) for s in starts]
                yield pa.RecordBatch.from_pylist([{"path": path, "block": k, "tokens": tokens, "ends": ends + at,
                                                   "starts": starts + at, "heads": heads}], _RANGE)
    return run


def token_ranges(spark: SparkSession, path: str, block: int = BLOCK_TOKENS) -> DataFrame:
    """(path, block, length) for every range of the files under ``path``, spread over the tasks; no file is opened."""
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    last = F.floor((F.col("length") - 1) / (2 * block))
    return files.select("path", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"), "length") \
        .repartition(partitions(spark), "path", "block")


def token_counts(spark: SparkSession, path: str, eod: int = EOD, head: int = 0, block: int = BLOCK_TOKENS) -> DataFrame:
    """One row per document of the token files under ``path``.

    file, ordinal (place in the file), start (first token), n_tokens,
    terminated, head (the first ``head`` tokens of the document).
    """
    found = written(token_ranges(spark, path, block).mapInArrow(
        _scan(eod, head, block), "path string, block long, tokens long, ends array<long>, starts array<long>, "
        "heads array<array<int>>"), "ranges")
    # Prefix scan over the ranges of a file: documents begun before, the next separator after.
    order = Window.partitionBy("path").orderBy("block")
    scan = found.select("path", "block", F.size("starts").alias("n"), F.get("ends", F.lit(0)).alias("first_end")).select(
        F.col("path").alias("p"), F.col("block").alias("b"), (F.sum("n").over(order) - F.col("n")).alias("begun"),
        F.first("first_end", ignorenulls=True).over(order.rowsBetween(1, Window.unboundedFollowing)).alias("next_end"))
    own = found.join(scan, (F.col("path") == F.col("p")) & (F.col("block") == F.col("b")))
    # The i-th start of a range after the first follows its i-th separator, so it ends at the next one.
    skipped = F.when(F.col("block") == 0, 0).otherwise(1)
    docs = own.select("path", "tokens", "begun", "next_end", "ends", skipped.alias("skipped"),
                      F.posexplode(F.arrays_zip("starts", "heads")).alias("i", "x"))
    docs = docs.withColumn("stop", F.coalesce(F.get("ends", F.col("i") + F.col("skipped")), "next_end"))
    return docs.select(F.col("path").alias("file"), (F.col("begun") + F.col("i")).alias("ordinal"),
                       F.col("x.starts").alias("start"),
                       (F.coalesce("stop", "tokens") - F.col("x.starts")).alias("n_tokens"),
                       F.col("stop").isNotNull().alias("terminated"), F.col("x.heads").alias("head"))


def _id_tokens(ids: list) -> np.ndarray:
    """Document ids as ``ID_TOKENS`` tokens each; the last one's top bit marks a null."""
    v = np.array([i or 0 for i in ids], np.int64).view(np.uint64)
    out = np.stack([(v >> np.uint64(15 * k) & np.uint64(0x7FFF)) for k in range(ID_TOKENS)], axis=1).astype("<u2")
    out[[i is None for i in ids], -1] |= 0x4000
    return out


def doc_id_of(head: F.Column) -> F.Column:
    """The document id held by the leading tokens."""
    token = lambda k: F.get(head, F.lit(k)).cast("long")
    value = F.shiftleft(token(4).bitwiseAND(F.lit(0xF)), 60)
    for k in range(4):
        value = value.bitwiseOR(F.shiftleft(token(k), 15 * k))
    return F.when(token(4).bitwiseAND(F.lit(0x4000)) == 0, value)


def _token_rows(path: str, eod: int):
    """A document's bytes in the file: its id tokens and its token ids."""
    def run(batches):
        ranks, seen = bpe.read_ranks(path), {}
        taken = set(ranks.values())
        if eod in taken or max(taken | {eod}) > 0xFFFF:
            raise ValueError(f"{path}: ids must fit into 16 bits and leave {eod} free")
        for ids, texts in bpe.text_blocks(batches, 4 << 20):
            if len(seen) > _SEEN_WORDS:
                seen = {}
            block = bpe.Block(texts)
            for w in block.words:
                if w not in seen:
                    seen[w] = np.array(bpe.merge(w, ranks), "<u2")
            words = [seen[w] for w in block.words]
            size = np.array([len(w) for w in words], np.int64)
            flat = np.concatenate(words) if words else np.zeros(0, "<u2")
            first = np.cumsum(size) - size
            tokens = vectext.gather(flat, first[block.codes], size[block.codes])
            edge = np.concatenate(([0], np.cumsum(size[block.codes])))[np.concatenate(([0], np.cumsum(block.counts)))]
            heads = _id_tokens(ids)
            yield pa.RecordBatch.from_arrays([pa.array(
                [h.tobytes() + tokens[a:b].tobytes() for h, a, b in zip(heads, edge[:-1], edge[1:])],
                pa.binary())], names=["data"])
    return run


def write_token_files(docs: DataFrame, folder: str, vocabulary: str | None = None, eod: int = EOD) -> None:
    """Token files of every row of ``docs`` (doc_id, text), one per input partition."""
    src = columns(docs, doc_id="long", text="string")
    rows = src.mapInArrow(_token_rows(vocabulary or bpe.default_vocabulary(), eod), "data binary")
    mark = int(eod).to_bytes(2, "little").decode("latin-1")
    rows.select(F.col("data").cast("string").alias("value")).write \
        .option("lineSep", mark).option("encoding", "ISO-8859-1").text(folder)
