"""How far the sources of a language diverge: exact term probabilities per
source, compared with each other source and with the whole language."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetbook.llm.common import few_ids, written

ONE = 1_000_000_000        # probabilities are whole numbers of 1 / ONE
LONG_COUNT = 9_000_000_000  # counts below it times ONE fit in 64 bits
FLUSH_TERMS = 400_000      # entries that a task counts before it hands them on
FLUSH_BYTES = 64 << 20     # and bytes of their keys
WINDOW_BYTES = 1 << 20     # bytes of a text split at once

# a byte that is no ASCII letter and no part of a longer character ends a term
_FOLD = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
_COUNTS = "lang string, source string, term string, n long, df long"
_ARROW = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()),
                    ("n", pa.int64()), ("df", pa.int64())])


def _terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, window by window, each cut after a whole term."""
    lo = 0
    while lo < len(text):
        hi = lo + WINDOW_BYTES
        folded = text[lo:hi].translate(_FOLD)
        while hi < len(text) and folded[-1] != 0x20:  # a term goes on: the window grows to its end
            more = text[hi:hi + WINDOW_BYTES].translate(_FOLD)
            end = more.find(b" ")
            folded += more if end < 0 else more[:end + 1]
            hi += len(more) if end < 0 else end + 1
        yield folded.split()
        lo = hi


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents per (lang, source, term), added up inside the
    task for as long as they stay below the flush bounds."""
    found: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def flush():
        for (lang, source), (n, df) in found.items():
            terms = list(n)
            yield pa.record_batch(
                [pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()),
                 pa.array(terms, pa.binary()).cast(pa.string()), pa.array(list(n.values()), pa.int64()),
                 pa.array([df[t] for t in terms], pa.int64())], schema=_ARROW)
        found.clear()

    size = held = 0
    for batch in batches:
        texts = pc.cast(batch.column(2), pa.binary())
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
            text = text.as_py()
            if not text:
                continue
            n, df = found.setdefault((lang, source), (Counter(), Counter()))
            before, seen = len(n), set()
            for words in _terms(text):
                n.update(words)
                seen.update(words)
            df.update(seen)
            if len(n) > before:
                size += len(n) - before
                held += sum(map(len, seen))
            if size >= FLUSH_TERMS or held >= FLUSH_BYTES:
                yield from flush()
                size = held = 0
    yield from flush()


def _p(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(ONE * (n + 1) / (total + kept)), in whole numbers. Counts whose
    product with ONE leaves 64 bits are divided as decimals."""
    wide = (((n + 1).cast("decimal(20,0)") * F.lit(ONE).cast("decimal(10,0)")).cast("decimal(38,0)"))
    big = F.call_function("div", wide, (total + kept).cast("decimal(20,0)")).cast("long")
    small = F.call_function("div", (n + 1) * F.lit(ONE), total + kept)
    return F.lit(1) + F.when(n < LONG_COUNT, small).otherwise(big)


def _f(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q); p and q are at most ONE + 1, so 64 bits hold it."""
    return F.call_function("div", (p - q) * (p - q), q)


def term_counts(docs: DataFrame, groups: DataFrame, min_docs: int, lang_col: str, source_col: str,
                text_col: str) -> DataFrame:
    """(lang, term, lang_n, by): the terms that at least ``min_docs`` rows of a
    language hold, their occurrences there, and those in each group ``g``
    that holds them. A task adds up its own rows first, and a term's row has
    an entry per source at most."""
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in
                         ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    counts = rows.mapInArrow(_count, _COUNTS).groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("df").alias("df"))
    return (counts.join(groups.select("lang", "source", "g"), ["lang", "source"])
            .groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("df").alias("df"),
                                         F.collect_list(F.struct("g", "n")).alias("by"))
            .where(F.col("df") >= min_docs).select("lang", "term", "lang_n", "by"))


def _parameters(groups: DataFrame, kept: DataFrame) -> DataFrame:
    """Per group: its kept occurrences ``total``, the language's ``lang_total``
    and number of kept terms ``v``, and ``p0`` of a term that it lacks."""
    each = kept.select(F.explode("by").alias("x")).groupBy("x.g").agg(F.sum("x.n").alias("total"))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
    zero = F.lit(0).cast("long")
    return (groups.join(each, "g", "left").join(langs, "lang", "left")
            .select("g", "lang", "source", *(F.coalesce(c, zero).alias(c) for c in ("total", "v", "lang_total")))
            .withColumn("p0", F.when(F.col("v") > 0, _p(zero, F.col("total"), F.col("v")))))


def _of(parameters: DataFrame, mark: str) -> DataFrame:
    return parameters.select(*(F.col(c).alias(f"{c}{mark}") for c in ("g", "total", "v", "p0")))


def pair_divergence(kept: DataFrame, cells: DataFrame, parameters: DataFrame) -> DataFrame:
    """(g, h, value): f summed over all kept terms for every ordered pair of
    groups of a language.

    Most terms miss most sources, so the sum over all terms is taken as if
    both groups lacked every term, corrected per cell (group, count) for the
    terms that one of them holds, and per term for those that both hold; only
    the last looks at pairs, adding them up inside the task that reads the
    term.
    """
    small = few_ids(parameters)
    x, y = _of(small, "_x"), _of(small, "_y")
    both = (kept.select("by", F.explode("by").alias("x")).select("by", "x.g", "x.n")
            .join(x, F.col("g") == F.col("g_x"))
            .select("g_x", "p0_x", _p(F.col("n"), F.col("total_x"), F.col("v_x")).alias("p_x"),
                    F.explode("by").alias("y"))
            .where(F.col("y.g") != F.col("g_x"))
            .join(y, F.col("y.g") == F.col("g_y"))
            .withColumn("p_y", _p(F.col("y.n"), F.col("total_y"), F.col("v_y")))
            .groupBy(F.col("g_x").alias("g"), F.col("g_y").alias("h"))
            .agg(F.sum(_f(F.col("p_x"), F.col("p_y")) - _f(F.col("p_x"), F.col("p0_y"))
                       - _f(F.col("p0_x"), F.col("p_y")) + _f(F.col("p0_x"), F.col("p0_y"))).alias("value")))
    pairs = (small.select("lang", *(F.col(c).alias(f"{c}_x") for c in ("g", "total", "v", "p0")))
             .join(small.select("lang", *(F.col(c).alias(f"{c}_y") for c in ("g", "p0"))), "lang")
             .where("g_x != g_y"))
    neither = pairs.select(F.col("g_x").alias("g"), F.col("g_y").alias("h"),
                           F.when(F.col("v_x") > 0, F.col("v_x") * _f(F.col("p0_x"), F.col("p0_y")))
                           .otherwise(0).alias("value"))
    held = cells.groupBy("g", "n").agg(F.sum("terms").alias("terms"))
    own = F.col("p_x")
    one = (held.join(pairs, F.col("g") == F.col("g_x"))
           .withColumn("p_x", _p(F.col("n"), F.col("total_x"), F.col("v_x")))
           .groupBy("g_x", "g_y").agg(
               F.sum(F.col("terms") * (_f(own, F.col("p0_y")) - _f(F.col("p0_x"), F.col("p0_y")))).alias("as_p"),
               F.sum(F.col("terms") * (_f(F.col("p0_y"), own) - _f(F.col("p0_y"), F.col("p0_x")))).alias("as_q")))
    one = one.select(F.explode(F.array(
        F.struct(F.col("g_x").alias("g"), F.col("g_y").alias("h"), F.col("as_p").alias("value")),
        F.struct(F.col("g_y").alias("g"), F.col("g_x").alias("h"), F.col("as_q").alias("value")))).alias("s")).select("s.*")
    return neither.unionByName(one).unionByName(both).groupBy("g", "h").agg(F.sum("value").alias("value"))


def top_terms(kept: DataFrame, cells: DataFrame, parameters: DataFrame, top: int) -> DataFrame:
    """(g, term, value, rank): each group's ``top`` terms by f against the
    language, among those it holds more often than the language does.

    Terms are grouped in cells of (group count, language count), f is
    evaluated once a cell, cells of equal value are merged, and values are
    ranked by the terms that come before them. Every value has a term at
    least, so no more than ``top`` values of a group matter: each task keeps
    its largest ones before any group is gathered. Only the values that reach
    the first ``top`` ranks are expanded to terms, in UTF-8 order, again with
    no more than ``top`` kept per value and task.
    """
    def valued(df):
        df = df.join(few_ids(parameters.where("v > 0")), "g")
        p, q = _p(F.col("n"), F.col("total"), F.col("v")), _p(F.col("lang_n"), F.col("lang_total"), F.col("v"))
        return (df.withColumn("p", p).withColumn("q", q).where("p > q")
                .withColumn("value", _f(F.col("p"), F.col("q"))))

    by_value = Window.partitionBy("g").orderBy(F.desc("value"))
    values = (valued(cells).groupBy("g", "value").agg(F.sum("terms").alias("terms"))
              .withColumn("nth", F.row_number().over(by_value)).where(F.col("nth") <= top))
    above = by_value.rowsBetween(Window.unboundedPreceding, -1)
    reached = (values.withColumn("above", F.coalesce(F.sum("terms").over(above), F.lit(0)))
               .where(F.col("above") < top).select("g", "value", "above"))
    holders = kept.select("term", "lang_n", F.explode("by").alias("x")).select("term", "lang_n", "x.g", "x.n")
    in_order = Window.partitionBy("g", "value").orderBy("term")
    return (valued(holders).select("g", "value", "term").join(few_ids(reached), ["g", "value"])
            .withColumn("nth", F.row_number().over(in_order)).where(F.col("nth") <= top)
            .withColumn("rank", F.col("above") + F.col("nth")).where(F.col("rank") <= top)
            .select("g", "term", "value", "rank"))


def source_divergence(docs: DataFrame, min_docs: int = 3, top: int = 200, lang_col: str = "lang",
                      source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Audit of every (lang, source) group: part ``pair`` ranks the other
    sources of its language by divergence, part ``term`` its own ``top``
    terms by divergence from the language. Columns lang, source, part, item,
    value, rank; value descending, ties in UTF-8 order of item.

    Terms are runs of ASCII letters and of all characters beyond ASCII, A-Z
    lower-cased. A language keeps the terms that ``min_docs`` of its rows hold
    (each row is a document, so repeated rows and ids count each). With n a
    term's occurrences in a group, N those of all kept terms and V their
    number, p = 1 + floor(10^9 (n + 1) / (N + V)), and f = floor((p - q)^2 / q)
    in whole numbers throughout.

    A null lang, source or text is empty. A group without terms has its
    pairs; where a language keeps no term, pairs are 0 and there are no
    terms. A language of one source has no pairs. An empty table gives no
    rows; a very long text is split window by window; other columns are not
    read.
    """
    groups = few_ids(docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in
                                   ((lang_col, "lang"), (source_col, "source")))).distinct()
                     .withColumn("g", F.monotonically_increasing_id()))
    kept = written(term_counts(docs, groups, min_docs, lang_col, source_col, text_col), "terms")
    parameters = written(_parameters(groups, kept), "groups")
    cells = written(kept.select("lang_n", F.explode("by").alias("x")).groupBy("x.g", "x.n", "lang_n")
                    .agg(F.count(F.lit(1)).alias("terms")), "cells")
    names = parameters.select("g", "lang", "source")
    by_item = Window.partitionBy("g").orderBy(F.desc("value"), "item")
    pair = (pair_divergence(kept, cells, parameters)
            .join(names.select(F.col("g").alias("h"), F.col("source").alias("item")), "h")
            .select("g", F.lit("pair").alias("part"), "item", "value", F.row_number().over(by_item).alias("rank")))
    term = top_terms(kept, cells, parameters, top).select(
        "g", F.lit("term").alias("part"), F.col("term").alias("item"), "value", F.col("rank").cast("int").alias("rank"))
    return pair.unionByName(term).join(names, "g").select("lang", "source", "part", "item", "value", "rank")
