"""Operator 4: language identification by Bayesian evidence fusion.

Three kinds of evidence are combined for every document:

* text: byte trigrams of the letters, hashed to ``BUCKETS``, with a smoothed
  distribution per language counted over all documents by their declared
  language, and a uniform one for "und" (no known language);
* the declared markup language: how often documents whose text reads as l
  declare d, counted over all documents;
* the address: a prior per host, smoothed towards its domain, that towards
  its suffix, and that towards all documents, from grouped counts.

The text's log-likelihood is tempered to at most ``EVIDENCE`` trigrams, since
neighbouring trigrams are not independent.  The posterior gives the language,
its confidence and whether the document is kept.

Every document weighs at most ``DOC_WEIGHT`` trigrams in its language's
counts, so a few very long texts do not become the language.  Every document is
read under its declared language without its own trigrams, or it would vouch
for itself.  A declared value is taken for a language if two documents or more
declare it and at least half of those read as it (a filler such as "xx" reads as
the languages it covers and drops out).  The rule is the same for every value
and input size.

All counts are sums combined before their shuffle, so a hot host or language
is no hot task; the tables joined back have one row per host or declared
value.  The ``BLOCK`` values declared most are counted first.  The others, of
which bad data may hold thousands, are tested against these a block at a time,
on a written table of their own rows; only those that pass are scored with the
rest.  So the driver and a task hold log-probabilities (128 KB a language) of
``BLOCK`` values, one block more and the passing ones.

Defined cases: text without letters is "und" with confidence 0; a null or
unknown declared language or host adds no evidence of its own kind; repeated
rows are scored alike; a null id is kept as a row; an empty table gives an
empty result; other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetzone.llm import html_main
from fleetzone.llm.common import columns, work_folder, written

BUCKETS = 1 << 14
EVIDENCE = 60.0
#: Documents that must declare a value: alone, a document has no other to be read by.
MIN_ROWS = 2
#: Declared values that are counted and tested at once.
BLOCK = 128
SMOOTHING = 20.0
#: Trigrams that a document weighs at most in its language's counts.
DOC_WEIGHT = 1000.0
UND = "und"
#: Text bytes, and trigrams counted by document, that a task handles at once.
_CHUNK = 1 << 20
_SPAN = 1 << 17

_LETTERS = np.full(256, 32, np.uint8)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[65:91] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)


def trigrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of the letters of all texts, and which text each is of."""
    size = np.array([len(t) + 2 for t in texts], np.int64)
    raw = _LETTERS[np.frombuffer(b"".join(b" " + t + b" " for t in texts), np.uint8)]
    owner = np.repeat(np.arange(len(texts)), size)
    keep = np.ones(len(raw), bool)
    keep[1:] = (raw[1:] != 32) | (raw[:-1] != 32) | (owner[1:] != owner[:-1])
    b, owner = raw[keep].astype(np.uint32), owner[keep]
    if len(b) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    whole = owner[2:] == owner[:-2]
    code = (b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]) * np.uint32(2654435761)
    return (code >> np.uint32(18)).astype(np.int64)[whole], owner[2:][whole]


def _parts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with a bounded number of text bytes (one row at least)."""
    for batch in batches:
        texts = [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]
        a = 0
        while a < len(texts):
            b, size = a, 0
            while b < len(texts) and (b == a or size + len(texts[b]) <= _CHUNK):
                size += len(texts[b])
                b += 1
            yield batch.slice(a, b - a), texts[a:b]
            a = b


def _pieces(text: bytes) -> Iterator[bytes]:
    """A very long text in overlapping pieces, so that every trigram is counted once or nearly so."""
    for a in range(0, max(len(text), 1), _CHUNK):
        yield text[a:a + _CHUNK + 2]


def _count_rows(languages: list[str]):
    """Trigram counts by declared language of one task."""
    place = {x: i for i, x in enumerate(languages)}

    def batch(held: dict[int, np.ndarray]) -> pa.RecordBatch:
        at = {i: np.flatnonzero(row) for i, row in held.items()}
        cells = [a + i * BUCKETS for i, a in at.items()] or [np.zeros(0, np.int64)]
        n = [held[i][a] for i, a in at.items()] or [np.zeros(0, np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(cells)), pa.array(np.concatenate(n))], names=["cell", "n"])

    def run(batches):
        held = {}
        for part, texts in _parts(batches, 0):
            declared = part.column(1).to_pylist()
            by_language = {}
            for t, d in zip(texts, declared):
                if d in place:
                    by_language.setdefault(place[d], []).append(t)
            for language, own in by_language.items():
                if language not in held and len(held) == BLOCK:
                    yield batch(held)
                    held = {}
                pieces = [(p, i) for i, t in enumerate(own) for p in _pieces(t)]
                codes, owner = trigrams([p for p, _ in pieces])
                if len(codes):
                    doc = np.array([i for _, i in pieces])[owner]
                    size = np.bincount(doc, minlength=len(own))
                    weight = np.maximum(np.round(1024 * np.minimum(1, DOC_WEIGHT / np.maximum(size, 1))), 1)
                    held[language] = held.get(language, 0) + np.bincount(
                        codes, weights=weight[doc], minlength=BUCKETS).astype(np.int64)
        yield batch(held)
    return run


def _spans(n: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of documents of up to ``_SPAN`` trigrams, or of one document."""
    a = 0
    while a < len(n):
        b = max(a + 1, a + int(np.searchsorted(np.cumsum(n[a:]), _SPAN, side="right")))
        yield a, b
        a = b


def _hits(codes: np.ndarray, owner: np.ndarray, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, bucket, number) of the different trigrams of documents ``a`` to ``b``."""
    if b == a + 1:
        count = np.bincount(codes, minlength=BUCKETS)
        code = np.flatnonzero(count)
        return np.full(len(code), a), code, count[code]
    at, hits = np.unique(owner * BUCKETS + codes, return_counts=True)
    return at // BUCKETS, at % BUCKETS, hits


def _score_rows(languages: list[str], table: np.ndarray, totals: np.ndarray):
    """Mean log-likelihood per trigram under every language, and the number of trigrams.

    Under its declared language a document is read without its own share of
    the counts, of which ``totals`` are the sums per language.
    """
    place = {x: i for i, x in enumerate(languages)}

    def run(batches):
        for part, texts in _parts(batches, 1):
            pieces = [(p, i) for i, t in enumerate(texts) for p in _pieces(t)]
            codes, owner = trigrams([p for p, _ in pieces])
            owner = np.array([i for _, i in pieces])[owner] if len(owner) else owner
            n = np.bincount(owner, minlength=len(texts))
            sums = np.stack([np.bincount(owner, weights=row[codes], minlength=len(texts)) for row in table], axis=1)
            row = np.array([place.get(d, -1) for d in part.column(2).to_pylist()], np.int64)
            without = np.zeros(len(texts))
            for a, b in _spans(n):
                if row[a:b].max() >= 0:
                    lo, hi = np.searchsorted(owner, [a, b])
                    doc, code, hits = _hits(codes[lo:hi], owner[lo:hi], a, b)
                    doc, code, hits = (x[row[doc] >= 0] for x in (doc, code, hits))
                    weight = np.minimum(1, DOC_WEIGHT / n[doc])
                    total = totals[row[doc]]
                    left = np.maximum(np.exp(table[row[doc], code]) * total - weight * hits, 0.1)
                    without += np.bincount(doc, weights=hits * np.log(left / (total - weight * n[doc])), minlength=len(texts))
            told = np.flatnonzero((row >= 0) & (n > 0))
            sums[told, row[told]] = without[told]
            mean = sums / np.maximum(n, 1)[:, None]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), part.column(3), pa.array(n, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1) * len(table), pa.int32()),
                                          pa.array(mean.ravel()))],
                names=["id", "declared", "host", "n", "fit"])
    return run


_SCORES = "id long, declared string, host string, n long, fit array<double>"
_UNIFORM = np.full((1, BUCKETS), -np.log(BUCKETS))


def _counted(rows: DataFrame, languages: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Log-probabilities per language and bucket, and the sums of counts, from rows of text and declared value."""
    counts = np.zeros((len(languages), BUCKETS))
    if languages:
        cells = rows.select("text", "declared").mapInArrow(_count_rows(languages), "cell long, n long") \
            .groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
        counts.reshape(-1)[cells.column("cell").to_numpy()] = cells.column("n").to_numpy()
    counts = counts / 1024 + 0.1
    totals = counts.sum(axis=1)
    return np.log(counts / totals[:, None]), totals


def _read_as(scored: DataFrame, languages: list[str], rivals: list[int]) -> list[int]:
    """The languages that at least half of the readable documents declaring them read as, against the ``rivals``."""
    place = F.array_position(F.lit(languages), F.col("declared")).cast("int") - 1
    others = F.array_max(F.transform(F.lit(rivals), lambda i: F.when(i != F.col("place"), F.get("fit", i))))
    share = scored.where("n > 0").withColumn("place", place).where("place >= 0").groupBy("place") \
        .agg(F.avg((F.get("fit", F.col("place")) >= others).cast("double")).alias("v"))
    return sorted(r[0] for r in share.where("v >= 0.5").select("place").collect())


def text_model(src: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(values, log-probabilities per value and bucket, sums of counts) from the rows of :func:`identify`.

    The values declared most, and of the others those that their documents
    read as rather than as one of these.
    """
    values = written(src.where("declared is not null").groupBy("declared").count().where(F.col("count") >= MIN_ROWS), "values")
    languages = [r[0] for r in values.orderBy(F.col("count").desc(), "declared").limit(BLOCK).collect()]
    table, totals = _counted(src.where(F.col("declared").isin(languages)), languages)
    main = len(languages)
    others = values.join(src.sparkSession.createDataFrame([(x,) for x in languages], "declared string"), "declared", "left_anti")
    blocks = -(-others.count() // BLOCK) if main == BLOCK else 0
    if blocks:
        others = written(others.select("declared", F.pmod(F.xxhash64("declared"), F.lit(blocks)).alias("block")), "values")
        rows = work_folder(src.sparkSession, "rare")
        src.join(others, "declared").select(*src.columns, "block").write.partitionBy("block").parquet(rows)
        rows = src.sparkSession.read.schema(T.StructType([*src.schema.fields, T.StructField("block", T.LongType())])).parquet(rows)
    for k in range(blocks):
        own = rows.where(F.col("block") == k)
        names = sorted(r[0] for r in others.where(F.col("block") == k).select("declared").collect())
        logs, sums = _counted(own, names)
        both, rivals = [*languages[:main], *names], [*range(main), main + len(names)]
        scored = own.select("id", "text", "declared", "host").mapInArrow(
            _score_rows(both, np.vstack([table[:main], logs, _UNIFORM]), np.concatenate([totals[:main], sums])), _SCORES)
        passing = [i - main for i in _read_as(scored, both, rivals) if i >= main]
        languages += [names[i] for i in passing]
        table, totals = np.vstack([table, logs[passing]]), np.concatenate([totals, sums[passing]])
    return languages, table, totals


def _normal(x: Column) -> Column:
    total = F.aggregate(x, F.lit(0.0), lambda a, v: a + v)
    return F.transform(x, lambda v: v / total)


def _seen(rows: DataFrame, by: list[str], n: int, count: Column) -> DataFrame:
    """Per group, the array ``seen`` of the sums of ``count`` by ``reads`` (0 to n - 1)."""
    cells = rows.groupBy(*by, "reads").agg(count.cast("double").alias("v")) \
        .groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("reads", "v"))).alias("m"))
    return cells.select(*by, F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.coalesce(
        F.try_element_at("m", i), F.lit(0.0))).alias("seen"))


def host_priors(scored: DataFrame, n: int) -> DataFrame:
    """(host, prior): a distribution over the ``n`` languages per host.

    Counts of text decisions by host, rolled up to its domain (last two
    labels), its suffix (last label) and all; each level is smoothed towards
    the one above.
    """
    labels = F.split("host", r"\.")
    hits = scored.where("host is not null").groupBy("host", "reads").agg(F.count("*").alias("hits")) \
        .withColumn("suffix", F.when(F.size(labels) > 1, F.element_at(labels, -1))) \
        .withColumn("domain", F.when(F.size(labels) > 1, F.concat_ws(".", F.slice(labels, -2, 2))))
    smooth = lambda seen, above: _normal(F.zip_with(seen, above, lambda a, b: a + b * SMOOTHING))
    every = {r[0]: r[1] for r in scored.groupBy("reads").count().collect()}
    total = sum(every.values()) + n
    base = F.lit([(every.get(i, 0) + 1.0) / total for i in range(n)])
    suffixes = _seen(hits.where("suffix is not null"), ["suffix"], n, F.sum("hits")) \
        .select("suffix", smooth(F.col("seen"), base).alias("suffix_prior"))
    domains = _seen(hits.where("domain is not null"), ["domain", "suffix"], n, F.sum("hits")).join(suffixes, "suffix") \
        .select("domain", smooth(F.col("seen"), F.col("suffix_prior")).alias("domain_prior"))
    return _seen(hits, ["host", "domain"], n, F.sum("hits")).join(domains, "domain", "left") \
        .select("host", smooth(F.col("seen"), F.coalesce("domain_prior", base)).alias("prior"))


def identify(rows: DataFrame, id_: str = "doc_id", text: str = "text", declared: str | None = "lang",
             host: str | None = "source", min_confidence: float = 0.5) -> DataFrame:
    """The id column, lang, confidence, declared, kept for every row.

    ``host`` names a column with host names (``a.b.example.de``) or any other
    label of origin; ``kept`` is false for "und" and for documents whose best
    language stays under ``min_confidence``.
    """
    column = lambda c: F.col(f"`{c}`").cast("string") if c else F.lit(None).cast("string")
    src = rows.select(F.col(f"`{id_}`").cast("long").alias("id"), column(text).alias("text"),
                      F.lower(F.regexp_extract(column(declared), "^[A-Za-z]+", 0)).alias("declared"),
                      F.lower(column(host)).alias("host")) \
        .withColumn("declared", F.when(F.col("declared") != "", F.col("declared")))
    languages, table, totals = text_model(src)
    reads = F.array_position("fit", F.array_max("fit")).cast("int") - 1
    scored = written(src.select("id", "text", "declared", "host").mapInArrow(
        _score_rows(languages, np.vstack([table, _UNIFORM]), totals), _SCORES), "language")
    valid = _read_as(scored, languages, [*range(len(languages) + 1)])
    fit = F.transform(F.lit([*valid, len(languages)]), lambda i: F.get("fit", i))
    languages = [languages[i] for i in valid]
    n = len(languages) + 1
    scored = scored.withColumn("fit", fit).withColumn("reads", reads)
    readable = scored.where("n > 0")

    # P(declared | language of the text), smoothed.
    by_declared = _seen(readable.where("declared is not null"), ["declared"], n, F.count("*"))
    totals = {r[0]: (r[1], r[2]) for r in by_declared.select(F.posexplode("seen")).groupBy("pos")
              .agg(F.count("*"), F.sum("col")).collect()}
    kinds = totals[0][0] if totals else 1
    per = F.lit([totals[i][1] + 0.5 * kinds if totals else 0.5 for i in range(n)])
    said = by_declared.select("declared", F.zip_with("seen", per, lambda a, b: F.log((a + 0.5) / b)).alias("said"))
    priors = host_priors(readable, n)

    flat, even = F.lit([0.0] * n), F.lit([1.0 / n] * n)
    joined = scored.join(said, "declared", "left").join(priors, "host", "left")
    fused = joined.withColumn("prior", F.coalesce("prior", even)).withColumn("said", F.coalesce("said", flat)) \
        .withColumn("evidence", F.least(F.col("n").cast("double"), F.lit(EVIDENCE)))
    log_post = F.zip_with(F.zip_with("fit", "said", lambda a, b: a * F.col("evidence") + b), "prior", lambda a, b: a + F.log(b))
    fused = fused.withColumn("log_post", log_post).withColumn("best", F.array_max("log_post")) \
        .withColumn("confidence", 1 / F.aggregate("log_post", F.lit(0.0), lambda a, v: a + F.exp(v - F.col("best"))))
    names = F.lit([*languages, UND])
    readable = F.col("n") > 0
    lang = F.when(readable, F.get(names, F.array_position("log_post", F.col("best")).cast("int") - 1)).otherwise(F.lit(UND))
    confidence = F.when(readable, F.col("confidence")).otherwise(F.lit(0.0))
    return fused.select(F.col("id").alias(id_), lang.alias("lang"), confidence.alias("confidence"), "declared",
                        ((lang != UND) & (confidence >= min_confidence)).alias("kept"))


def host_of(url: Column) -> Column:
    """The host of a url in lower case, without user, port and final dot; null if it has none."""
    host = F.regexp_extract(url, r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:\s]+)", 1)
    host = F.lower(F.regexp_replace(host, r"\.+$", ""))
    return F.when(host != "", host)


def markup_language(html: Column) -> Column:
    """The language that the ``html`` element declares (``lang`` or ``xml:lang``), as written; null if none."""
    lang = F.regexp_extract(html, r"(?i)<html(?=\s)[^>]*?\s(?:xml:)?lang\s*=\s*[\x22']?\s*([A-Za-z][A-Za-z0-9_-]*)", 1)
    return F.when(lang != "", lang)


def _main_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, 256):
            part = batch.slice(a, 256)
            texts = [html_main.extract(x) for x in part.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(texts, pa.string())],
                                             names=["page_id", "declared", "host", "text"])


def identify_pages(pages: DataFrame, min_confidence: float = 0.5) -> DataFrame:
    """:func:`identify` for every row of ``pages`` (page_id, url, html).

    The text is the page's main text, the declaration that of its markup and
    the address the host of its url, so every kind of evidence takes part.
    """
    rows = columns(pages, page_id="long", url="string", html="string").select(
        "page_id", markup_language(F.col("html")).alias("declared"), host_of(F.col("url")).alias("host"), "html")
    rows = written(rows.mapInArrow(_main_texts, "page_id long, declared string, host string, text string"), "pages")
    return identify(rows, "page_id", "text", "declared", "host", min_confidence)
