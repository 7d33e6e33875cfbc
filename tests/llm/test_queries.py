"""Every registered query runs on whole tables and equals its SQL twin where it has one."""

import math
import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

import corpus_pipeline  # noqa: E402
from fleetzone.llm import queries  # noqa: E402
from oracle_check import duck  # noqa: E402

SF = "/root/testdata/sf0.001"
TABLE = {"op2_main_text": "pages", "op3_top_k": None, "op10_chat": None, "op11_repair": None}


def test_names():
    assert [int(q[2:].split("_")[0]) for q in queries.queries()] == list(range(1, 14))
    assert set(queries.oracle_sql()) <= set(queries.queries())


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_one_row_per_input_row(spark, name):
    rows = queries.queries()[name](spark, SF).collect()
    table = TABLE.get(name, "documents")
    if table:
        assert len(rows) == spark.read.parquet(f"{SF}/{table}.parquet").count()
    if name == "op10_chat":
        extra = [r for r in rows if r.conv_id == -7]
        assert len(extra) == 1 and extra[0].n_turns == 2 and extra[0].loss_chars == len(r"\### Assistant: </turn> ok")
        assert len(rows) == 1 + spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id").distinct().count()


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equals_sql(spark, name):
    df = queries.queries()[name](spark, SF)
    con = duck(SF).execute(queries.oracle_sql()[name])
    cols = [d[0] for d in con.description]
    assert sorted(cols) == sorted(df.columns)

    def key(row):
        return tuple(float(f"{v:.9g}") if isinstance(v, float) and not math.isnan(v) else v for v in row)

    assert sorted(map(key, con.fetchall())) == sorted(map(key, df.select(*cols).collect()))


def test_pipeline_equals_the_plain_stages(spark):
    """run() against the stages' decisions applied by hand."""
    from fleetzone.llm import bpe, language, mixing, near_dedup, quality
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    left = {r.doc_id: r for r in docs.collect()}

    def rest():
        return spark.createDataFrame(list(left.values()), docs.schema).repartition(3, "doc_id")

    for decide in (language.identify, lambda d: quality.score_documents(d, labels), near_dedup.near_duplicates):
        left = {r.doc_id: left[r.doc_id] for r in decide(rest()).collect() if r.kept}
    copies = {r.doc_id: r.copies for r in mixing.mix(rest()).collect()}
    tokens = {r.doc_id: (r.n_tokens, list(r.ids)) for r in bpe.encode(rest()).collect()}
    want = sorted((i, *tokens[i]) for i, n in copies.items() for _ in range(n))
    got = sorted((r.doc_id, r.n_tokens, list(r.ids)) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == want and 0 < len(left) < docs.count()


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "quality", "near_dedup", "mixing", "bpe"]
