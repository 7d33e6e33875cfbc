"""Operator 7: mix sources to target weights by Pareto order sampling.

Every source gets a share of the mix by weight.  A share stops at ``cap``
times the source's own words; the excess goes to the others by weight until
none is above (solved in closed form over the small table of sources).  A
source first takes its certain whole copies, ``floor(target / words)`` of
every document.  The rest is a sample of unequal probabilities: a document's
inclusion probability ``p`` grows with its ``measure`` (the number of binary
digits of its size, so long documents have the better odds, but not in
proportion), scaled inside the source so that the expected words are the rest;
where the scale would lift it above 1 the document is certain.  Each document
draws a uniform number from its id, its random odds are divided by its
inclusion odds ``p / (1 - p)``, and documents are taken in that order while the
sample's words stay nearest to the rest.

The order is never computed over a whole source in one task.  The scale comes
from the words per (source, measure), at most 64 rows a source.  Documents then
fall into ``BINS`` bins of their ranking number; the bins' word sums (combined
before the shuffle) give the one bin where the sample ends, and only that bin's
rows, about 1/BINS of a source, are ordered.  Certain documents are a bin of
their own that is never ordered.  DataFrame functions only.

Defined cases: null text has size 0; a null source is a source of its own and
comes last; a source without words has target 0; repeated rows share one draw
and are each taken or not in a fixed order; an empty table gives an empty
result; other input columns are ignored.  A table of one row per source passes
through one task (``source_targets``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetzone.llm.common import columns, written

BINS = 4096


def word_count(text) -> F.Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` words; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def draw(doc_id) -> F.Column:
    """A uniform number in (0, 1) fixed by the id (52 bits of its MD5)."""
    bits = F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 13), 16, 10)
    return (bits.cast("double") + 0.5) / float(1 << 52)


def source_targets(sources: DataFrame, weights: list[float], share: float, cap: float) -> DataFrame:
    """Adds ``target`` to (source, source_size): capped proportional shares.

    Runs over one row per source.  Sorted by cap over weight, the capped
    sources are a prefix; the level of the others is the largest
    ``(total - caps before) / (weights from here on)``.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = sources.withColumn("weight", w).withColumn("limit", F.col("source_size") * float(cap))
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("source_size").over(everything) * float(share)
    level = (total - (F.sum("limit").over(upto) - F.col("limit"))) / \
        (F.sum("weight").over(everything) - F.sum("weight").over(upto) + F.col("weight"))
    s = s.withColumn("level", level)
    return s.select("source", "source_size",
                    F.least(F.col("limit"), F.max("level").over(everything) * F.col("weight")).alias("target"))


def measure(size) -> F.Column:
    """What a document's inclusion probability is proportional to: the binary digits of its size."""
    return F.length(F.bin(size)).cast("double")


def inclusion_scales(words: DataFrame) -> DataFrame:
    """(s, scale) per source from (source, measure, words, rest).

    The scale makes the expected words, the sum of ``words * min(1, scale *
    measure)``, equal the rest.  The documents above 1 are those of the largest
    measures, so it is the largest of the levels "what the certain ones leave,
    over measure times words of the others".
    """
    down = Window.partitionBy("source").orderBy(F.col("measure").desc())
    onwards = down.rowsBetween(0, Window.unboundedFollowing)
    certain = F.sum("words").over(down.rowsBetween(Window.unboundedPreceding, 0)) - F.col("words")
    others = F.sum(F.col("measure") * F.col("words")).over(onwards)
    level = F.when(others > 0, (F.col("rest") - certain) / others)
    return words.withColumn("level", level).groupBy(F.col("source").alias("s")).agg(F.max("level").alias("scale"))


def _of(rows: DataFrame, plan: DataFrame, how: str = "inner") -> DataFrame:
    """Rows with their source's plan (``s``: the source); null is a source too."""
    return rows.join(plan, F.col("source").eqNullSafe(F.col("s")), how).drop("s")


def mix(docs: DataFrame, weights: list[float] = (5, 2, 1), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken for every row of ``docs``.

    ``weights`` repeat over the sources in code-point order; the mix holds
    ``share`` times all words; ``copies`` says how often a document is taken
    and ``taken`` is that times its size.
    """
    base = written(columns(docs, doc_id="long", text="string", source="string").select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), draw(F.col("doc_id")).alias("u"))
        .withColumn("measure", measure(F.col("size"))), "sizes")
    words = written(base.groupBy("source", "measure").agg(F.sum("size").alias("words")), "words")
    targets = source_targets(words.groupBy("source").agg(F.sum("words").alias("source_size")), list(weights), share, cap)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    targets = targets.withColumn("whole", whole.cast("long")) \
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")).withColumnRenamed("source", "s")
    scales = inclusion_scales(_of(words, targets.select("s", "rest")))
    plan = written(targets.withColumnRenamed("s", "source").join(scales, F.col("source").eqNullSafe(F.col("s")), "left")
                   .drop("s").withColumnRenamed("source", "s"), "plan")
    # Random odds over inclusion odds, as x / (1 + x): the sampling order inside a source.
    p = F.least(F.coalesce("scale", F.lit(0.0)) * F.col("measure"), F.lit(1.0))
    u = F.col("u")
    ranked = _of(base, plan).withColumn("p", p) \
        .withColumn("place", u * (1 - F.col("p")) / (u * (1 - F.col("p")) + (1 - u) * F.col("p"))) \
        .withColumn("bin", F.when(F.col("p") >= 1, F.lit(-1)).otherwise(F.floor(F.col("place") * BINS)).cast("long"))
    # The bin in which the sample ends, and the words of all bins before it.
    bins = ranked.groupBy("source", "bin", "rest").agg(F.sum("size").alias("words"))
    before = F.sum("words").over(Window.partitionBy("source").orderBy("bin")) - F.col("words")
    ends = written(bins.withColumn("before", before).where("before < rest").groupBy(F.col("source").alias("s"))
                   .agg(F.max(F.struct("bin", "before")).alias("last"))
                   .select("s", F.col("last.bin").alias("last_bin"), F.col("last.before").alias("last_before")), "ends")
    rows = _of(ranked, ends, "left")
    edge = Window.partitionBy("source").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    is_closing = F.coalesce((F.col("bin") == F.col("last_bin")) & (F.col("bin") >= 0), F.lit(False))
    closing = rows.where(is_closing) \
        .withColumn("start", F.col("last_before") + F.sum("size").over(edge) - F.col("size")) \
        .withColumn("sampled", (F.col("start") + F.col("size") / 2 < F.col("rest")).cast("long")).drop("start")
    others = rows.where(~is_closing).withColumn("sampled", F.coalesce(
        ((F.col("bin") < F.col("last_bin")) | (F.col("bin") < 0)).cast("long"), F.lit(0).cast("long")))
    return others.unionByName(closing).withColumn("copies", F.col("whole") + F.col("sampled")) \
        .select("doc_id", "source", "size", "source_size", "target", "copies",
                (F.col("copies") * F.col("size")).alias("taken"))


#: DuckDB twin of the query over ``documents``.
ORACLE = r"""
WITH base AS (
  SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS size,
         (CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0 AS u
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM base GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
             source_size * 2.0::DOUBLE AS cap FROM s),
l AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - (sum(cap) OVER o - cap)) / (sum(weight) OVER () - sum(weight) OVER o + weight) AS level
      FROM w WINDOW o AS (ORDER BY cap / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
t AS (SELECT source, source_size, least(cap, max(level) OVER () * weight) AS target FROM l),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
r AS (SELECT *, target - whole * source_size AS rest FROM p),
m AS (SELECT b.*, length(bin(b.size))::DOUBLE AS measure, r.source_size, r.target, r.whole, r.rest
      FROM base b JOIN r ON b.source IS NOT DISTINCT FROM r.source),
c AS (SELECT source, measure, rest, sum(size)::DOUBLE AS words FROM m GROUP BY ALL),
e AS (SELECT a.source, max((a.rest - coalesce((SELECT sum(b.words) FROM c b WHERE b.source IS NOT DISTINCT FROM a.source
             AND b.measure > a.measure), 0)) / nullif((SELECT sum(b.measure * b.words) FROM c b
             WHERE b.source IS NOT DISTINCT FROM a.source AND b.measure <= a.measure), 0)) AS scale
      FROM c a GROUP BY a.source),
p1 AS (SELECT m.*, least(coalesce(e.scale, 0) * m.measure, 1) AS p FROM m JOIN e ON m.source IS NOT DISTINCT FROM e.source),
q AS (SELECT *, u * (1 - p) / (u * (1 - p) + (1 - u) * p) AS place FROM p1),
d AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY place, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS start FROM q)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST((whole + CASE WHEN p >= 1 OR start + size / 2 < rest THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM d
"""
