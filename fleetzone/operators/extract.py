"""Extracts: semi joins, left-join chains, filters on the nullable side."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import passing_tables, write_table

#: Parts in which the widest rows are shuffled for a written table: each is one more scan of what it reads.
PARTS = 4


def keep_ids(df: DataFrame, col: str, ids) -> DataFrame:
    """Keep rows whose ``col`` is one of ``ids``.

    A short literal list becomes an ``IN`` filter (pushed into the scan);
    a DataFrame of ids becomes a left-semi join.  Ids are compared as
    STRING, so ``'QX0001ZZ'`` and ``'1000001'`` sit side by side.
    """
    if isinstance(ids, DataFrame):
        key = ids.columns[0]
        return df.join(ids.select(F.col(key).cast("string").alias("__id")),
                       F.col(col).cast("string") == F.col("__id"), "left_semi")
    return df.where(F.col(col).cast("string").isin([str(i) for i in ids]))


def semi_join(df: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows of ``df`` whose key exists in ``keys`` (``IN (subquery)``).

    This replaces both the ``IN (select distinct ...)`` subquery and the
    "paste the unique keys into the next query" round trip: the key set
    never leaves the cluster.
    """
    cols = [on] if isinstance(on, str) else list(on)
    return df.join(keys.select(*cols), cols, "left_semi")


def left_join_isnull(left: DataFrame, right: DataFrame, on: str, null_col: str) -> DataFrame:
    """Left join, then keep rows where ``right.null_col`` IS NULL.

    Keeps left rows with no right row at all and left rows paired with a
    right row whose ``null_col`` is NULL (one output row per such pair).
    The filter stays above the join: filtering ``right`` first would be
    wrong (it would also keep left rows whose right rows are all non-NULL).
    """
    r = right.select(F.col(on).alias("__rk"), F.col(null_col).alias("__rv"))
    j = left.join(r, left[on] == F.col("__rk"), "left")
    return j.where(F.col("__rv").isNull()).drop("__rk", "__rv")


def drop_all_flagged(left: DataFrame, right: DataFrame, on: str, null_col: str) -> DataFrame:
    """``left_join_isnull`` for use under DISTINCT, without the fan-out.

    Under a DISTINCT that keeps no column of ``right``, "left join then
    ``null_col IS NULL``" keeps a left row iff it has no right row or at
    least one right row with ``null_col`` NULL.  So drop exactly the keys
    whose right rows are all non-NULL: a partial aggregate per key (map-side
    combine) and an anti join, instead of multiplying every left row by its
    number of right rows.
    """
    flagged = (right.groupBy(on)
                    .agg(F.min(F.col(null_col).isNotNull().cast("int")).alias("__all"))
                    .where(F.col("__all") == 1)
                    .select(F.col(on).alias("__rk")))
    return left.join(flagged, left[on] == F.col("__rk"), "left_anti")


def distinct_keys(df: DataFrame, col: str) -> DataFrame:
    """The distinct key set of one column (feeds ``semi_join``)."""
    return df.select(col).distinct()


def left_join_split(left: DataFrame, right: DataFrame, on: str, right_keys: DataFrame | None = None) -> DataFrame:
    """``left LEFT JOIN right USING (on)`` written so a hot key can be split.

    Spark's adaptive skew handling can split either side of an inner join
    but only the left side of a left outer join; when the many-rows side is
    the right one (activities per trip), a key holding a large share of the
    rows would land in a single task.  So the result is built as

        inner join  UNION ALL  (left rows with no right row, right columns NULL)

    where the second part is an anti join against the right side's distinct
    keys (a map-side-combined aggregate, small even for a hot key).
    ``right_keys`` is any frame with the same ``on`` values that is cheaper to
    read than ``right``.
    """
    inner = left.join(right, on, "inner")
    keys = (right if right_keys is None else right_keys).select(on).distinct()
    lonely = left.join(keys, on, "left_anti")
    return inner.unionByName(lonely, allowMissingColumns=True)


def left_chain(tables: list[DataFrame], keys: list[str]) -> DataFrame:
    """``tables[0] LEFT JOIN tables[1] USING (keys[0]) LEFT JOIN ...``, joined from the lowest table up.

    Left joins whose keys are columns of the two neighbours can be grouped
    either way.  From the top, every row that found no match carries a NULL key
    through all lower joins, where the NULLs of all such rows meet in one task.
    From the bottom a table is joined while its keys are its own, and a row
    without a match leaves at its level (``left_join_split``): no NULL stands in
    for a missing match in any join.
    """
    out = tables[-1]
    for table, below, key in reversed(list(zip(tables, tables[1:], keys))):
        out = left_join_split(table, out, key, below)
    return out


def left_join_once(left: DataFrame, right: DataFrame, on: str, left_keys: DataFrame, right_keys: DataFrame) -> DataFrame:
    """``left_join_split`` for wide rows: those of ``left`` are shuffled once, by ``on``.

    Built as ``left INNER JOIN (right UNION ALL one row of NULLs for each key that
    only left has)``: only the narrow keys of both sides are shuffled for the anti
    join, and a hot key can be split on either side.  Left rows without a key match
    nothing and are added as they are.  ``right_keys`` has the ``on`` values of
    ``right``, ``left_keys`` at least those of ``left``.
    """
    lacking = left_keys.select(on).where(F.col(on).isNotNull()).distinct().join(right_keys.select(on).distinct(), on, "left_anti")
    matched = left.join(right.unionByName(lacking, allowMissingColumns=True), on, "inner")
    return matched.unionByName(left.where(F.col(on).isNull()), allowMissingColumns=True)


def part_of(df: DataFrame, key: str, n: int, parts: int) -> DataFrame:
    """Part ``n`` of ``parts`` of the rows, by ``key``: every row, with or without a key, is in one part.

    Not by the hash that shuffles use: the rows of a part go to all tasks.
    """
    return df.where(F.pmod(F.xxhash64(key), F.lit(parts)) == n)


def left_chain_filtered(tables: list[DataFrame], keys: list[str], columns: list[str] | None = None) -> DataFrame:
    """``left_chain`` for a first table that a filter has made smaller and a wide second one, as a written table.

    The first two are joined before the rest, so that only the second table's
    rows of the first are shuffled by the next key, and rows of all tables together
    are never shuffled for the first join.  Rows without a match leave at their
    level, as in ``left_chain``.

    Every level is written before the next one reads it (columns and rows pressed
    by Parquet are a fraction of what their shuffles take), and the last one in
    ``PARTS`` parts: on disk are the shuffles of one level, or of a part, and not those of
    the whole chain.  ``columns`` are those to keep, by default all.
    """
    first, second = tables[:2]
    with passing_tables(first.sparkSession) as folder:
        def write(df, above):
            kept = [c for c in df.columns if columns is None or c in columns or c in above]
            return write_table(df.select(*kept), "chain", folder)

        below = tables[-1]
        for i in range(len(tables) - 2, 1, -1):
            below = write(left_join_once(tables[i], below, keys[i], tables[i], below), keys[:i])
        first = write_table(first, "chain", folder)
        upper = write(first.join(second, keys[0], "inner"), keys[:2])
        lonely = first.join(upper.select(keys[0]).distinct(), keys[0], "left_anti")
        out = []
        for n in range(PARTS):
            mine, under = part_of(upper, keys[1], n, PARTS), part_of(below, keys[1], n, PARTS)
            out.append(left_join_once(mine, under, keys[1], mine, under))
        out.append(lonely.unionByName(out[0].limit(0), allowMissingColumns=True))
        kept = [c for c in out[0].columns if columns is None or c in columns]
        return write_table([part.select(*kept) for part in out], "chain")


def left_join_under(left: DataFrame, right: DataFrame, on: str, owner: str, codes: DataFrame, code: str) -> DataFrame:
    """``left LEFT JOIN right USING (on)`` up to repeated rows, for the rows with an ``owner``, all lying by ``owner``.

    For a wide ``left`` that is joined to its owners next: its rows are shuffled
    once, by ``owner``, and not by ``on`` before.  The narrow ``right`` reaches them
    by way of the pairs (owner, on), as further rows of one shuffle, and is spread
    by a window over both keys, which Spark lets lie by ``owner`` alone (a join on
    both keys would shuffle by both).  The join to the owners and a DISTINCT with
    the owner among its columns then shuffle none of these rows again.  ``codes``
    are left-joined to ``right`` by ``code``, after its shuffle by ``on``.

    Only for use under DISTINCT: a window holds the distinct rows of ``right`` of
    one key, so these must be few (a set's gears, of which there are at most as
    many as gear codes).
    """
    return spread_under(left, owned_rows(left, right, on, owner, codes, code), on, owner)


def owned_rows(left: DataFrame, right: DataFrame, on: str, owner: str, codes: DataFrame, code: str) -> DataFrame:
    """First step of ``left_join_under``: the rows of ``right`` (as ``__one``) by ``owner`` and ``on``."""
    pairs = left.select(owner, on).where(F.col(owner).isNotNull() & F.col(on).isNotNull()).repartition(on).distinct()
    owned = pairs.join(right, on, "inner").join(codes, code, "left")
    added = [c for c in owned.columns if c not in (owner, on)]
    return owned.select(owner, on, F.struct(*added).alias("__one"))


def spread_under(left: DataFrame, owned: DataFrame, on: str, owner: str) -> DataFrame:
    """Second step of ``left_join_under``: the ``owned_rows`` spread over the rows of ``left``, all lying by ``owner``."""
    left = left.where(F.col(owner).isNotNull())
    added = owned.schema["__one"].dataType.names
    rows = left.withColumn("__left", F.lit(True)).unionByName(owned, allowMissingColumns=True).repartition(owner)
    found = rows.withColumn("__all", F.collect_set("__one").over(Window.partitionBy(owner, on)))
    found = found.where("__left").select(*left.columns, F.explode_outer("__all").alias("__one"))
    return found.select(*left.columns, *[F.col("__one")[c].alias(c) for c in added])
