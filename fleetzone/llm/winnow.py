"""Operator 6: document fingerprints by winnowing (DataFrame functions only).

The text is cut into pieces, its white-space separated words.  With ``rolled``
(the registered query) a run of more than ``PIECE`` characters gives a piece
of ``PIECE`` characters from every position, so a passage without spaces is
found at whatever offset it stands.  Without ``rolled`` such a run is cut
every ``PIECE`` characters from its start: cheaper, but a passage inside a run
is only found at offsets that agree modulo ``PIECE``.  Every ``GRAM`` consecutive pieces get one 32-bit hash, built by
doubling from the pieces' hashes.  Every window of ``WINDOW`` consecutive
grams selects its smallest hash, the rightmost on ties; the fingerprint is
the set of selected (position, hash).  Any ``GRAM + WINDOW - 1`` consecutive
pieces that two texts share give them a common fingerprint entry, and no
selection depends on text outside its window.

A selected entry is one long, ``hash << 31 | (2^31 - 1 - position)``: the
smallest long of a window is the smallest hash and, among equals, the
rightmost position.  Window minima come from log2(WINDOW) element-wise
``least`` passes, so the work per piece does not grow with the window.

Defined cases: null text counts as empty and has an empty fingerprint; fewer
pieces than a gram make one gram of all; fewer grams than a window make one
window; two empty fingerprints have likeness 1; repeated rows have equal
results; a null id sorts first; other input columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetzone.llm.common import columns, partitions

PIECE = 8
GRAM = 4     # a power of two
WINDOW = 8   # a power of two
_MAX = (1 << 31) - 1
_INK = r"[^\x20\x09-\x0D]"
_PATTERN = r"(%s{1,%d})" % (_INK, PIECE)
#: Looks at up to PIECE characters; goes on by one while more than PIECE are left of the run, else to its end.
_ROLLED = r"(?=(%s{1,%d}))(?:%s(?=%s{%d})|%s{1,%d})" % (_INK, PIECE, _INK, _INK, PIECE, _INK, PIECE)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _pattern(rolled: bool) -> Column:
    return F.lit(_ROLLED if rolled else _PATTERN)


def pieces(text: Column, rolled: bool = False) -> Column:
    """The text's words, long ones as pieces from every position (``rolled``) or cut every ``PIECE`` characters."""
    return F.regexp_extract_all(text, _pattern(rolled), F.lit(1))


def n_windows(n: Column) -> Column:
    """Number of windows over ``n`` pieces."""
    return F.when(n <= 0, 0).otherwise(F.greatest(n - (GRAM + WINDOW - 2), F.lit(1)))


def _at(function, step: int):
    """One-argument form: Spark reads the number of a lambda's arguments."""
    return lambda a: function(a, step)


def _doubled(start: Column, size: int, combine) -> Column:
    """Element i becomes the combination of elements i .. i + size - 1."""
    def doubled(a: Column, step: int) -> Column:
        return F.transform(a, lambda x, i: combine(x, F.get(a, i + step)))

    step = 1
    while step < size:
        start = _let(start, _at(doubled, step))
        step *= 2
    return start


def winnow(parts: Column, offset: Column, windows: Column) -> Column:
    """Distinct selections (longs) of the first ``windows`` windows over the pieces ``parts``.

    ``offset`` is added to the positions.
    """
    grams = _doubled(F.transform(parts, lambda x: F.xxhash64(x)), GRAM, F.xxhash64)
    longs = _let(F.slice(grams, 1, F.greatest(F.size(parts) - (GRAM - 1), F.lit(1))), lambda g: F.transform(
        g, lambda x, i: F.shiftleft(x.bitwiseAND(F.lit(0xFFFFFFFF)), 31)
        .bitwiseOR(F.lit(_MAX).cast("long") - (i + offset))))
    mins = F.array_distinct(F.slice(_doubled(longs, WINDOW, F.least), 1, windows))
    return F.when(windows > 0, mins).otherwise(F.array().cast("array<long>"))


def entries(selected: Column) -> Column:
    """Selections as array<struct<position, hash>>."""
    return F.transform(selected, lambda v: F.struct(
        (F.lit(_MAX).cast("long") - v.bitwiseAND(F.lit(_MAX))).alias("position"), F.shiftright(v, 31).alias("hash")))


def as_string(selected: Column) -> Column:
    """Selections as ``position:hash`` pairs joined by one space (hash in hex)."""
    return F.array_join(F.transform(selected, lambda v: F.concat(
        (F.lit(_MAX).cast("long") - v.bitwiseAND(F.lit(_MAX))).cast("string"), F.lit(":"),
        F.lower(F.hex(F.shiftright(v, 31))))), " ")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two fingerprints' hashes; 1 if both are empty."""
    hashes = lambda x: F.array_distinct(F.transform(x, lambda v: F.shiftright(v, 31)))
    return _let(F.struct(hashes(a).alias("a"), hashes(b).alias("b")), lambda s: _let(
        F.size(F.array_intersect(s["a"], s["b"])), lambda c: F.when(
            (F.size(s["a"]) == 0) & (F.size(s["b"]) == 0), F.lit(1.0))
        .otherwise(c / (F.size(s["a"]) + F.size(s["b"]) - c))))


def fingerprints(docs: DataFrame, rolled: bool = False) -> DataFrame:
    """doc_id and ``fingerprint`` (array<struct<position, hash>>) for every row of ``docs``."""
    rows = columns(docs, doc_id="long", text="string").select(
        "doc_id", pieces(F.coalesce("text", F.lit("")), rolled).alias("parts"))
    return rows.select("doc_id", entries(
        winnow(F.col("parts"), F.lit(0), n_windows(F.size("parts")))).alias("fingerprint"))


def with_next(rows: DataFrame, order: str, carry: list[str]) -> DataFrame:
    """Adds ``next_<c>`` for every carried column: the value of the next row by ``order``
    (after the last: the first).

    Rows are dealt into ranges of the order column at its quantiles, one
    shuffle; a range also gets a copy of the next range's first rows, so no
    window ever spans more than a range.
    """
    n = partitions(rows.sparkSession) * 2
    cuts = rows.agg(F.percentile_approx(order, [i / n for i in range(n)], 20 * n)).first()[0] or [0]
    cuts = sorted(set(cuts))
    starts = F.array(*[F.lit(c).cast("long") for c in cuts])
    placed = rows.withColumn("range", F.greatest(F.size(F.filter(starts, lambda c: c <= F.col(order))) - 1, F.lit(0)))
    ahead = F.pmod(F.col("range") - 1, F.lit(len(cuts)))
    dealt = placed.withColumn("copy", F.explode(
        F.when(F.array_contains(starts, F.col(order)), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))) \
        .withColumn("range", F.when(F.col("copy") == 1, ahead).otherwise(F.col("range")))
    w = Window.partitionBy("range").orderBy("copy", order, *carry)
    return dealt.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in carry]).where("copy = 0") \
        .drop("range", "copy")


def _from(parts: str, start: str) -> Column:
    """The pieces from position ``start`` on."""
    return F.slice(parts, F.col(start) + 1, F.size(parts))


def edited_fingerprints(docs: DataFrame, rolled: bool = False) -> DataFrame:
    """Fingerprints of every text and of its edited text, with likenesses.

    The edited text has the last quarter (``floor(n_chars / 4)`` code points)
    replaced by as many of the next document's first ones.  Windows inside
    the kept part are shared by both fingerprints and computed once.
    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint
    (arrays of longs), near_edited and near_next.
    """
    rows = columns(docs, doc_id="long", text="string").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long")).alias("place"))
    rows = rows.withColumn("n_chars", F.char_length("text")).withColumn("parts", pieces(F.col("text"), rolled))
    # Pieces before the last kept one are equal in both texts, and so are the windows over them.
    kept = F.regexp_count(F.expr("left(text, cast(n_chars - floor(n_chars / 4) as int))"), _pattern(rolled)) - 1
    rows = rows.withColumn("shared", F.greatest(kept - (GRAM + WINDOW - 2), F.lit(0)))
    front = F.slice("parts", 1, F.col("shared") + (GRAM + WINDOW - 2))
    rows = rows.select(
        "doc_id", "place", "n_chars", "text", "shared",
        winnow(front, F.lit(0), F.col("shared")).alias("front"),
        winnow(_from("parts", "shared"), F.col("shared"),
               n_windows(F.size("parts")) - F.col("shared")).alias("back"))
    rows = rows.withColumn("selected", F.array_union("front", "back")).drop("back")
    rows = with_next(rows, "place", ["text", "selected"])
    edited = F.expr("concat(left(text, cast(n_chars - floor(n_chars / 4) as int)),"
                    " left(next_text, cast(floor(n_chars / 4) as int)))")
    rows = rows.withColumn("edited", edited).drop("text", "next_text").withColumn("parts", pieces(F.col("edited"), rolled))
    rows = rows.withColumn("changed", F.array_union("front", winnow(
        _from("parts", "shared"), F.col("shared"), n_windows(F.size("parts")) - F.col("shared")))).drop("parts")
    return rows.select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.col("selected").alias("fingerprint"), F.col("changed").alias("edited_fingerprint"),
        likeness(F.col("selected"), F.col("changed")).alias("near_edited"),
        likeness(F.col("selected"), F.col("next_selected")).alias("near_next"))


def report(docs: DataFrame, rolled: bool = False) -> DataFrame:
    """:func:`edited_fingerprints` with the fingerprints as strings."""
    return edited_fingerprints(docs, rolled).withColumn("fingerprint", as_string(F.col("fingerprint"))) \
        .withColumn("edited_fingerprint", as_string(F.col("edited_fingerprint")))
