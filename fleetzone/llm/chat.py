"""Operator 10: chat formatting into token-budgeted windows with a loss mask.

Every turn is rendered as ``### role``, a line end, the text, ``</turn>`` and
a line end.  Backslashes and the control strings inside roles and texts are
escaped, so the rendering can be read back exactly (:func:`read_turns`).

A conversation becomes one or more windows of at most ``budget`` tokens.
Prefix sums of turn tokens choose the spans: a window takes its leading
system turn, then whole earlier turns of at most ``history`` tokens, then as
many new turns as fit.  A turn is never cut: one that does not fit an empty
window has a window of its own with the history left out, above the budget.
Loss spans cover the texts of new assistant turns only; turns repeated from
earlier windows are masked, so every target counts once.

Only turn numbers and token counts of a conversation meet in one task (two
integers a turn); texts meet per window, whose size the budget bounds.

Defined cases: null text and null role are empty; a null conversation id is a
conversation of its own; a null turn sorts first; repeated (conversation,
turn) rows are all kept, ordered by role and text; an empty table gives an
empty result; other input columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetzone.llm.common import columns, partitions

HEAD, END = "### ", "</turn>"
BUDGET, HISTORY = 1024, 256
#: Control strings and their escaped forms, the escape character first.
ESCAPES = [("\\", "\\\\"), (HEAD, "\\H"), (END, "\\E")]
_BACK = {"\\": "\\", "H": HEAD, "E": END, "n": "\n"}


def escape(text: Column) -> Column:
    """Control strings inside a text made harmless, reversibly."""
    for raw, safe in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def unescape(text: str) -> str:
    """Inverse of :func:`escape`."""
    return re.sub(r"\\(.)", lambda m: _BACK[m[1]], text, flags=re.S)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted window."""
    out = []
    for part in formatted.split(END + "\n")[:-1]:
        role, _, text = part[len(HEAD):].partition("\n")
        out.append((unescape(role), unescape(text)))
    return out


def _windows_of(size: np.ndarray, system: int, budget: int, history: int) -> list[tuple[int, int, bool]]:
    """(window, turn index, repeated) of one conversation, from the prefix sums of its turns' tokens."""
    n = len(size)
    prefix = np.concatenate(([0], np.cumsum(size)))
    fixed = int(prefix[system])
    rows, at, window = [], 0, 0
    while at < n or window == 0:
        start = max(at, system)
        # Earlier whole turns that fit the history share.
        back = int(np.searchsorted(prefix, prefix[start] - history, side="left")) if window else start
        back = min(max(back, system), start)
        if start < n and fixed + prefix[start + 1] - prefix[back] > budget:
            back = start
        stop = int(np.searchsorted(prefix, prefix[back] + budget - fixed, side="right")) - 1
        stop = min(max(stop, start + 1), n)
        rows += [(window, i, window > 0) for i in range(system)]
        rows += [(window, i, i < start) for i in range(back, stop)]
        at, window = stop, window + 1
    return rows


def _spans(budget: int, history: int):
    """Window membership of the turns of a bin of conversations."""
    def run(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values(["conversation", "turn_no"], ignore_index=True)
        name, size = f["conversation"].to_numpy(), f["tokens"].to_numpy()
        system = f["is_system"].to_numpy().astype(int)
        edges = np.flatnonzero(np.concatenate(([True], name[1:] != name[:-1], [True])))
        at, window, again = [], [], []
        for s, e in zip(edges[:-1].tolist(), edges[1:].tolist()):
            for w, i, r in _windows_of(size[s:e], system[s], budget, history):
                at.append(s + i)
                window.append(w)
                again.append(r)
        return pd.DataFrame({"conversation": name[at], "window": window,
                             "turn_no": f["turn_no"].to_numpy()[at], "repeated": again})
    return run


def format_windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """conv_id, window, n_turns (new ones), n_tokens, formatted, fresh_from, loss_spans.

    ``fresh_from`` is the code point at which the window's new turns start
    (after the repeated system turn and history); ``loss_spans`` are
    (start, end) code points of the targets in ``formatted``.  Tokens are
    counted as words of the rendered turn.
    """
    src = columns(turns, conv_id="long", turn="long", role="string", text="string")
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = src.withColumn("turn_no", F.row_number().over(order)) \
        .withColumn("role", F.coalesce("role", F.lit(""))).withColumn("text", F.coalesce("text", F.lit(""))) \
        .withColumn("conversation", F.coalesce(F.col("conv_id").cast("string"), F.lit("null")))
    head = F.concat(F.lit(HEAD), F.replace(escape(F.col("role")), F.lit("\n"), F.lit("\\n")), F.lit("\n"))
    rows = rows.withColumn("head", head).withColumn("body", escape(F.col("text"))) \
        .withColumn("tokens", (F.regexp_count("body", F.lit(r"\S+")) + 3).cast("long"))
    # Many small conversations share a task: bins of whole conversations, two integers a turn.
    bins = 4 * partitions(turns.sparkSession)
    spans = rows.select("conversation", "turn_no", "tokens",
                        ((F.col("turn_no") == 1) & (F.col("role") == "system")).alias("is_system")) \
        .groupBy(F.pmod(F.xxhash64("conversation"), F.lit(bins)).alias("bin")).applyInPandas(
            _spans(budget, history), "conversation string, window long, turn_no int, repeated boolean")
    placed = spans.join(rows, ["conversation", "turn_no"])
    turn = F.struct("turn_no", "repeated", "tokens", "head", "body",
                    (F.col("role") == "assistant").alias("target"))
    windows = placed.groupBy("conversation", "conv_id", "window").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    length = lambda t: F.char_length(t["head"]) + F.char_length(t["body"]) + len(END) + 1
    # Start of every turn in the window: prefix sums of rendered lengths (a window is small).
    starts = F.transform("turns", lambda t, i: F.aggregate(F.slice("turns", 1, i), F.lit(0), lambda a, x: a + length(x)))
    windows = windows.withColumn("starts", starts)
    loss = F.filter(F.zip_with("turns", "starts", lambda t, s: F.when(
        t["target"] & ~t["repeated"], F.struct(
            (s + F.char_length(t["head"])).alias("start"),
            (s + F.char_length(t["head"]) + F.char_length(t["body"])).alias("end")))), lambda x: x.isNotNull())
    return windows.select(
        "conv_id", "window",
        F.size(F.filter("turns", lambda t: ~t["repeated"])).cast("long").alias("n_turns"),
        F.aggregate("turns", F.lit(0).cast("long"), lambda a, t: a + t["tokens"]).alias("n_tokens"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END + "\n"))), "")
        .alias("formatted"),
        F.aggregate("turns", F.lit(0), lambda a, t: a + F.when(t["repeated"], length(t)).otherwise(0)).alias("fresh_from"),
        loss.alias("loss_spans"))


_READ = "conv_id long, window long, n_turns long, turns string, loss string, chars long"


def _read_back(frames):
    """New turns and loss text of every window, from its formatted string alone."""
    for f in frames:
        turns = [read_turns(t[s:]) for t, s in zip(f["formatted"], f["fresh_from"])]
        yield pd.DataFrame({
            "conv_id": f["conv_id"].astype("Int64"), "window": f["window"], "n_turns": [len(t) for t in turns],
            "turns": ["".join(f"{r}\n{x}\n" for r, x in t) for t in turns],
            "loss": ["".join(unescape(t[s["start"]:s["end"]]) for s in spans)
                     for t, spans in zip(f["formatted"], f["loss_spans"])],
            "chars": f["formatted"].map(len)})


def digests(windows: DataFrame) -> DataFrame:
    """Per conversation, read back from its windows: turn and loss digests and sizes."""
    read = windows.select("conv_id", "window", "formatted", "fresh_from", "loss_spans").mapInPandas(_read_back, _READ)
    per = read.groupBy("conv_id").agg(
        F.sum("n_turns").alias("n_turns"), F.sum("chars").alias("formatted_chars"),
        F.sort_array(F.collect_list(F.struct("window", "turns", "loss"))).alias("w"))
    turns, loss = F.array_join("w.turns", ""), F.array_join("w.loss", "")
    return per.select("conv_id", "n_turns", F.sha2(turns.cast("binary"), 256).alias("turns_sha256"),
                      F.char_length(loss).cast("long").alias("loss_chars"),
                      F.sha2(loss.cast("binary"), 256).alias("loss_sha256"), "formatted_chars")
