"""Property tests: exact half-even shares, unpivot row counts."""

from fractions import Fraction

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from fleetzone.functions import na
from fleetzone.operators import reshape


def half_even_2dp(m: int, n: int):
    if n == 0:
        return None
    x = Fraction(m, n) * 100
    q, r = divmod(x.numerator, x.denominator)
    twice = 2 * r
    if twice > x.denominator or (twice == x.denominator and q % 2 == 1):
        q += 1
    return q / 100


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10 ** 9), st.integers(0, 10 ** 9)), min_size=1, max_size=40))
def test_share_equals_exact_half_even(spark, pairs):
    pairs = [(min(a, b), max(a, b)) for a, b in pairs]
    df = spark.createDataFrame(pairs, "m long, n long")
    got = [r.s for r in df.select(na.share("m", "n").alias("s")).collect()]
    assert got == [half_even_2dp(m, n) for m, n in pairs]
    assert all(s is None or 0.0 <= s <= 1.0 for s in got)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(*[st.one_of(st.none(), st.floats(-90, 90)) for _ in range(4)]), min_size=1, max_size=30))
def test_unpivot_count_is_pairs_minus_incomplete(spark, rows):
    data = [(f"h{i}",) + r for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, "k string, a1 double, a2 double, b1 double, b2 double")
    long = reshape.unpivot_positions(df, "k", {"a": ("a1", "a2"), "b": ("b1", "b2")}).na.drop("any")
    incomplete = sum((r[0] is None or r[1] is None) + (r[2] is None or r[3] is None) for r in rows)
    assert long.count() == 2 * len(rows) - incomplete


def test_cluster_conf_scales_partitions():
    from fleetzone.session import cluster_conf
    small, big = cluster_conf(10 * 1024 ** 3), cluster_conf(100 * 1024 ** 4)
    assert int(small["spark.sql.shuffle.partitions"]) == 200
    assert int(big["spark.sql.shuffle.partitions"]) > 100_000
