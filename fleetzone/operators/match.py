"""Existence matching: flags by one key, a composite key or either key.

Matching follows data-frame ``%in%`` rules: a missing key matches a
missing key, and the answer is never NULL.  Keys are compared with
null-safe equality column by column (no key strings are built).  Each
flag is a left outer join against the *distinct* key set, so no row is
duplicated; Spark plans it as a shuffle join on the keys (AQE turns it into
a broadcast at run time when the key set is small, and splits skewed
partitions when a key is hot).  Rows with a missing key are spread over
``NULL_SPREAD`` join keys, and the missing key of the set is repeated for each,
so that they never meet in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Join keys that rows with a missing key are spread over.
NULL_SPREAD = 64


def _missing(cols) -> Column:
    out = F.lit(False)
    for c in cols:
        out = out | F.col(c).isNull()
    return out


def _row_salt(missing: Column, columns: list[str]) -> Column:
    """Salt of a row: by its columns where a key is missing, else 0."""
    return F.when(missing, F.pmod(F.hash(*[F.col(c) for c in columns]), F.lit(NULL_SPREAD))).otherwise(F.lit(0))


def _key_salts(missing: Column) -> Column:
    """Salts of a key of the set: all of them where a part is missing, else 0."""
    return F.explode(F.when(missing, F.sequence(F.lit(0), F.lit(NULL_SPREAD - 1))).otherwise(F.array(F.lit(0))))


def _pairs(on) -> list[tuple[str, str]]:
    if isinstance(on, str):
        return [(on, on)]
    return [(p, p) if isinstance(p, str) else tuple(p) for p in on]


def exists_flag(df: DataFrame, keys: DataFrame, on, name: str) -> DataFrame:
    """Add BOOLEAN ``name``: the row's key exists in ``keys``.

    ``on`` is a column name, or a list of names / ``(left, right)`` pairs
    for a composite key.
    """
    pairs = _pairs(on)
    names = [f"__k{i}" for i in range(len(pairs))]
    k = keys.select(*[F.col(r).alias(n) for n, (_, r) in zip(names, pairs)]).distinct()
    k = k.select(*names, _key_salts(_missing(names)).alias("__n"), F.lit(True).alias("__hit"))
    rows = df.withColumn("__p", _row_salt(_missing([left for left, _ in pairs]), df.columns))
    cond = rows["__p"] == k["__n"]
    for (left, _), n in zip(pairs, names):
        cond = cond & rows[left].eqNullSafe(k[n])
    out = rows.join(k, cond, "left")
    return out.select(*[rows[c] for c in df.columns],
                      F.coalesce(F.col("__hit"), F.lit(False)).alias(name))


def tagged_keys(df: DataFrame, keys: dict[str, list[str]], width: int, payload: list[str] = ()) -> DataFrame:
    """Each row once per named key: ``payload``, ``kind`` (the name), ``k0``, ``k1``, ... (the key's parts as
    text; keys shorter than ``width`` end in NULLs) and ``missing`` (a part of the key itself is)."""
    rows = [F.struct(F.lit(kind).alias("kind"), *[
        (F.col(cols[i]) if i < len(cols) else F.lit(None)).cast("string").alias(f"k{i}") for i in range(width)],
        _missing(cols).alias("missing")) for kind, cols in keys.items()]
    return df.select(*payload, F.explode(F.array(*rows)).alias("__x")).select(*payload, "__x.*")


def flags_by_keys(rows: DataFrame, row_keys: dict[str, list[str]],
                  sources: dict[str, tuple[DataFrame, dict[str, list[str]]]]) -> DataFrame:
    """Distinct ``rows`` with a BOOLEAN ``{source}_{kind}`` per source and kind of key: it has the row's key.

    ``row_keys`` names the rows' keys by kind, ``sources`` the frames to look in
    and their keys by kind.  Every source is read once: the keys of all of them
    are one tagged union, aggregated once per key (combined before the shuffle),
    and the rows meet it in one join, not in one join per test.
    """
    width = max(len(cols) for cols in row_keys.values())
    names = ["kind", *[f"k{i}" for i in range(width)]]
    found = reduce(DataFrame.unionByName, [
        tagged_keys(df, keys, width).withColumn("source", F.lit(name)) for name, (df, keys) in sources.items()])
    sets = found.groupBy(*[F.col(n).alias(f"__{n}") for n in names], "missing").agg(
        *[F.max(F.col("source") == name).alias(f"__in_{name}") for name in sources])
    sets = sets.withColumn("__n", _key_salts(F.col("missing"))).drop("missing")
    tagged = tagged_keys(rows, row_keys, width, rows.columns)
    tagged = tagged.withColumn("__p", _row_salt(F.col("missing"), rows.columns)).drop("missing")
    cond = tagged["__p"] == sets["__n"]
    for n in names:
        cond = cond & tagged[n].eqNullSafe(sets[f"__{n}"])
    return tagged.join(sets, cond, "left").groupBy(*rows.columns).agg(*[
        F.max(F.coalesce((F.col("kind") == kind) & F.col(f"__in_{name}"), F.lit(False))).alias(f"{name}_{kind}")
        for name, (_, keys) in sources.items() for kind in keys])


def either_flag(df: DataFrame, keys_a: DataFrame, on_a, keys_b: DataFrame, on_b,
                name: str) -> DataFrame:
    """Flag rows matched by either key.

    Two equi-joins ORed together, never one join on ``a OR b`` (that can
    only run as a nested loop).
    """
    a = exists_flag(df, keys_a, on_a, "__fa")
    b = exists_flag(a, keys_b, on_b, "__fb")
    return b.withColumn(name, F.col("__fa") | F.col("__fb")).drop("__fa", "__fb")


def marker(flag: Column | str, mark: str = "x") -> Column:
    """``"x"`` when the flag is true, NULL otherwise (audit columns)."""
    f = F.col(flag) if isinstance(flag, str) else flag
    return F.when(f, F.lit(mark))


def as_int(flag: Column | str) -> Column:
    f = F.col(flag) if isinstance(flag, str) else flag
    return f.cast("int")


def apply_override(df: DataFrame, overrides: DataFrame, key: str, value: str,
                   out: str) -> DataFrame:
    """``out = overrides.value`` for keys in ``overrides``, else ``df.value``.

    A NULL key gives NULL (the test ``key == k`` is unknown).

    ``overrides(key, new_value)`` is a correction table.  Of several
    corrections of one key the largest value (the newest date) counts, so no
    row is ever repeated.  Spark picks the join by the table's size.
    """
    okey, oval = overrides.columns[:2]
    o = (overrides.where(F.col(okey).isNotNull()).groupBy(F.col(okey).alias("__ok"))
                  .agg(F.max(oval).alias("__ov")))
    j = df.join(o, df[key] == F.col("__ok"), "left")
    return j.select(*[df[c] for c in df.columns],
                    F.when(df[key].isNull(), F.lit(None).cast(df.schema[value].dataType))
                     .when(F.col("__ok").isNotNull(), F.col("__ov").cast(df.schema[value].dataType))
                     .otherwise(df[value]).alias(out))
