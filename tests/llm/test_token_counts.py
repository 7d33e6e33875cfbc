"""Token counts in flat files against plain splitting."""

import numpy as np
import pytest

from fleetzone.llm import bpe, token_counts as T
from fleetzone.llm.common import work_folder

def plain(tokens, eod):
    out, start = [], 0
    for i, t in enumerate(tokens):
        if t == eod:
            out.append((start, i - start, True))
            start = i + 1
    if start < len(tokens):
        out.append((start, len(tokens) - start, False))
    return out


@pytest.mark.parametrize("block", [1, 3, 8, 1 << 20])
def test_counts_stitched_over_blocks(spark, tmp_path, block):
    rng = np.random.RandomState(block)
    cases = [[], [9], [9, 9, 9], [1, 2, 3], [1, 9, 2], list(rng.randint(0, 12, 300)), [5] * 40 + [9] + [5] * 3]
    for i, c in enumerate(cases):
        (tmp_path / f"t{i}.bin").write_bytes(np.array(c, "<u2").tobytes())
    got = T.token_counts(spark, str(tmp_path), eod=9, head=2, block=block).collect()
    for i, c in enumerate(cases):
        own = sorted((r for r in got if r.file.endswith(f"/t{i}.bin")), key=lambda r: r.ordinal)
        assert [r.ordinal for r in own] == list(range(len(own)))
        assert [(r.start, r.n_tokens, r.terminated) for r in own] == plain(c, 9)
        assert all(list(r.head) == c[r.start:r.start + 2] for r in own)


def test_written_files_hold_every_document(spark):
    texts = ["", None, "the end", "a" * 5000, "It's <|endoftext|> é\n", "PÄ" * 40] + ["word " * n for n in range(40)]
    ids = [0, 1, 1, -5, 2 ** 62 + 12345, None] + list(range(100, 140))
    docs = spark.createDataFrame([(t, i, 3) for t, i in zip(texts, ids)], "text string, doc_id long, head int").repartition(3)
    folder = work_folder(spark, "tokens")
    T.write_token_files(docs, folder)
    rows = T.token_counts(spark, folder, head=T.ID_TOKENS, block=64)
    got = sorted(((r[0] is None, r[0], r[1]) for r in rows.select(
        T.doc_id_of(rows["head"]), rows["n_tokens"] - T.ID_TOKENS).collect()), key=str)
    want = sorted(((r.doc_id is None, r.doc_id, r.n_tokens) for r in bpe.encode(docs).collect()), key=str)
    assert got == want
    assert all(r.terminated for r in rows.collect())


def test_one_long_file_is_read_by_many_tasks(spark, tmp_path):
    """A file of 400 ranges, some without any separator, others full of them."""
    rng = np.random.RandomState(2)
    tokens = rng.randint(0, 300, 40_000)
    tokens[5_000:6_000], tokens[8_000:8_200] = 1, 9
    (tmp_path / "long file.bin").write_bytes(tokens.astype("<u2").tobytes())
    rows = T.token_counts(spark, str(tmp_path), eod=9, head=3, block=100)
    assert [(r.start, r.n_tokens, r.terminated) for r in sorted(rows.collect(), key=lambda r: r.ordinal)] == plain(list(tokens), 9)
    listed = spark.read.format("binaryFile").load(str(tmp_path)).select("path", "length")
    assert listed.count() == 1 and rows.select("ordinal").distinct().count() == rows.count()
    parts = T.token_ranges(spark, str(tmp_path), 100)
    assert sum(1 for n in parts.rdd.glom().map(len).collect() if n) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_bad_files_and_vocabularies_are_errors(spark, tmp_path):
    (tmp_path / "odd.bin").write_bytes(b"abc")
    with pytest.raises(Exception, match="odd number of bytes"):
        T.token_counts(spark, str(tmp_path)).collect()
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(Exception, match="leave 7 free"):
        T.write_token_files(docs, work_folder(spark, "tokens"), eod=7)


def test_no_documents(spark, tmp_path):
    folder = work_folder(spark, "tokens")
    T.write_token_files(spark.createDataFrame([], "doc_id long, text string"), folder)
    assert T.token_counts(spark, folder, head=T.ID_TOKENS).collect() == []
    (tmp_path / "empty.bin").write_bytes(b"")
    assert T.token_counts(spark, str(tmp_path)).collect() == []
