"""Mixing sources to target weights by iterative proportional fitting, with
DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetbook.llm.common import written

DIMS = ("source", "lang", "topic")
ROUNDS = 8       # rakings over all margins
SQL_CAP_ROUNDS = 12  # sharing out what capped cells cannot take, written out in ``mix_sql``
CELLS_A_TASK = 1_000_000

# Topics by the first marker that a text contains, else prose. Fixed values.
TOPIC_MARKERS = (
    ("legal", ("Licensed under", "License, version")),
    ("contact", ("@",)),
    ("config", (" = \"",)),
    ("table", (" | ",)),
)


def topic_of(text: Column) -> Column:
    out = F
    for topic, marks in TOPIC_MARKERS:
        found = F.lit(False)
        for mark in marks:
            found = found | F.contains(text, F.lit(mark))
        out = out.when(found, topic)
    return out.otherwise("prose")


def token_weight(text: Column) -> Column:
    """Tokens as words between ASCII blanks."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _narrow(df: DataFrame, parts: int) -> DataFrame:
    """A table of cells or margins in as few tasks as hold it. In one task
    grouping and joining take no exchange, whatever the cluster's settings."""
    return df.coalesce(parts)


def flattened(cells: DataFrame, dim: str, power: float) -> DataFrame:
    """Target shares of one margin: today's shares raised to ``power`` (below
    1 lifts small values), made to sum to 1."""
    margin = cells.groupBy(dim).agg(F.pow(F.sum("tokens").cast("double"), F.lit(power)).alias("raised"))
    whole = margin.agg(F.sum("raised")).first()[0] or 1.0
    return margin.select(dim, (F.col("raised") / F.lit(whole)).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (dimension columns, tokens) with ``weight``: starting from the
    token shares, each margin in turn is scaled to its target shares, ``rounds``
    times. Each round is written to the shared folder. A value without a
    target gets weight 0; a target without cells is left out.

    Cells and margins are merged, not broadcast: they are far smaller than
    the documents, and a broadcast table a step would gather in the driver.
    """
    dims = list(targets)
    total, n = cells.agg(F.sum("tokens"), F.count(F.lit(1))).first()
    parts = max(1, -(-n // CELLS_A_TASK))
    now = cells.withColumn("weight", F.col("tokens") / F.lit(float(total or 1)))
    for dim, target in targets.items():
        target = _narrow(written(_narrow(target, parts), f"target-{dim}"), parts)
        now = now.join(target.withColumnRenamed("share", f"share_{dim}").hint("merge"), dim, "left")
    now = _narrow(written(now, "targets"), parts)
    for _ in range(rounds):
        for dim in dims:
            margin = now.groupBy(dim).agg(F.sum("weight").alias("whole"))
            scaled = F.col("weight") * F.coalesce(F.col(f"share_{dim}"), F.lit(0.0)) / F.col("whole")
            now = now.join(margin.hint("merge"), dim).withColumn(
                "weight", F.when(F.col("whole") > 0, scaled).otherwise(0.0)).drop("whole")
        now = _narrow(written(now, "raked"), parts)
    return now.drop(*(f"share_{dim}" for dim in dims))


def calibrated(raked: DataFrame, fraction: float) -> DataFrame:
    """Cells with ``probability``: a cell's share of the budget (``fraction``
    of all tokens) over its tokens, at most 1. What capped cells cannot take
    goes to the others in proportion to their weights, until no more cells
    are capped; a round caps one at least, so it ends."""
    total = raked.agg(F.sum("tokens")).first()[0] or 0
    budget, scale, n_capped = fraction * total, None, -1
    while True:
        full = F.lit(False) if scale is None else F.col("weight") * scale >= F.col("tokens")
        capped, free, n = raked.agg(F.sum(F.when(full, F.col("tokens"))), F.sum(F.when(~full, F.col("weight"))),
                                    F.count_if(full)).first()
        if not free or n == n_capped:
            break
        scale, n_capped = max(0.0, budget - (capped or 0)) / free, n
    wanted = F.col("weight") * F.lit(scale or 0.0)
    return raked.withColumn("probability", F.when(wanted >= F.col("tokens"), 1.0).otherwise(wanted / F.col("tokens")))


def draw(id_col: Column, seed: int) -> Column:
    """A number in [0, 1) fixed by the id: a retried task draws the same."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(16 ** 12))


def chances(docs: DataFrame, powers: dict[str, float], fraction: float) -> DataFrame:
    """(source, lang, topic, probability) of every cell of rows as ``_rows``
    gives them."""
    cells = written(docs.where("tokens > 0").groupBy(*DIMS).agg(F.sum("tokens").alias("tokens")), "cells")
    cells = _narrow(cells, max(1, -(-cells.count() // CELLS_A_TASK)))
    raked = rake(cells, {dim: flattened(cells, dim, powers[dim]) for dim in DIMS})
    return written(calibrated(raked, fraction).select(*DIMS, "probability"), "chances")


def _cell(text_col: str, source_col: str, lang_col: str) -> list[Column]:
    return [F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
            F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
            topic_of(F.coalesce(F.col(text_col), F.lit(""))).alias("topic")]


def _rows(docs: DataFrame, id_col: str, text_col: str, source_col: str, lang_col: str) -> DataFrame:
    return written(docs.select(
        F.col(id_col).alias("doc_id"), *_cell(text_col, source_col, lang_col),
        token_weight(F.coalesce(F.col(text_col), F.lit(""))).alias("tokens")), "mix-rows")


def mix(docs: DataFrame, powers: dict[str, float], fraction: float, seed: int = 1,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        lang_col: str = "lang") -> DataFrame:
    """Per row: doc_id, source, lang, topic, tokens, probability and sampled.

    Token weights per (source, lang, topic) cell are raked to the margins that
    ``powers`` gives (see ``flattened``); a document is sampled with its
    cell's calibrated probability, decided by a keyed hash of its id, so the
    sample holds about ``fraction`` of the tokens.

    Rows are counted into cells by a partial aggregate, so a source that holds
    a third of them is one row per task; cells, margins and factors are plain
    tables, joined to the documents as a broadcast only when their files are
    below Spark's threshold, else by a join that AQE can split.

    A null or empty source or language is the value ''. A document without
    words (null or empty text too) has no tokens: probability 1, sampled.
    Rows that repeat an id are drawn alike; a null id is drawn as ''. An empty
    table gives no rows. Other columns are not read.
    """
    rows = _rows(docs, id_col, text_col, source_col, lang_col)
    out = rows.join(chances(rows, powers, fraction), list(DIMS), "left")
    probability = F.when(F.col("tokens") > 0, F.col("probability")).otherwise(1.0)
    return out.select("doc_id", *DIMS, "tokens", probability.alias("probability"),
                      (draw(F.col("doc_id"), seed) < probability).alias("sampled"))


def sampled(docs: DataFrame, powers: dict[str, float], fraction: float, seed: int = 1,
            id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
            lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that ``mix`` samples, with all their columns."""
    cells = chances(_rows(docs, id_col, text_col, source_col, lang_col), powers, fraction)
    worded = F.coalesce(F.col(text_col), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    rows = docs.select(F.struct(*docs.columns).alias("row"), *_cell(text_col, source_col, lang_col),
                       draw(F.col(id_col), seed).alias("drawn"), worded.alias("worded"))
    return (rows.join(cells, list(DIMS), "left")
            .where(~F.col("worded") | (F.col("drawn") < F.col("probability"))).select("row.*"))


def mix_sql(powers: dict[str, float], fraction: float, seed: int) -> str:
    """DuckDB SQL for ``mix`` over documents, with the rounds written out."""
    topic = " ".join(
        f"WHEN {' OR '.join(f"contains(text, '{m}')" for m in marks)} THEN '{t}'" for t, marks in TOPIC_MARKERS)
    steps = [f"""WITH doc AS MATERIALIZED (
    SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
           CASE {topic} ELSE 'prose' END AS topic,
           len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS tokens
    FROM (SELECT * REPLACE (coalesce(text, '') AS text) FROM documents)
), cell AS MATERIALIZED (
    SELECT source, lang, topic, sum(tokens)::BIGINT AS tokens FROM doc WHERE tokens > 0 GROUP BY ALL
), w0 AS MATERIALIZED (SELECT *, tokens / (sum(tokens) OVER ())::DOUBLE AS weight FROM cell)"""]
    for dim in DIMS:
        steps.append(f"""target_{dim} AS MATERIALIZED (
    SELECT {dim}, raised / sum(raised) OVER () AS share
    FROM (SELECT {dim}, pow(sum(tokens)::DOUBLE, {powers[dim]}) AS raised FROM cell GROUP BY {dim})
)""")
    n = 0
    for _ in range(ROUNDS):
        for dim in DIMS:
            n += 1
            steps.append(f"""w{n} AS MATERIALIZED (
    SELECT w.* REPLACE (weight * share / sum(weight) OVER (PARTITION BY w.{dim}) AS weight)
    FROM w{n - 1} w JOIN target_{dim} t ON t.{dim} = w.{dim}
)""")
    steps.append(f"s0 AS MATERIALIZED (SELECT {fraction} * sum(tokens) / sum(weight) AS scale FROM w{n})")
    for i in range(1, SQL_CAP_ROUNDS):
        steps.append(f"""s{i} AS MATERIALIZED (
    SELECT coalesce(greatest(0, {fraction} * sum(tokens) - coalesce(sum(tokens) FILTER (WHERE weight * scale >= tokens), 0))
           / sum(weight) FILTER (WHERE weight * scale < tokens), max(scale)) AS scale
    FROM w{n}, s{i - 1}
)""")
    return ",\n".join(steps) + f""", chance AS (
    SELECT source, lang, topic, least(1.0, weight * scale / tokens) AS probability FROM w{n}, s{SQL_CAP_ROUNDS - 1}
)
SELECT doc_id, d.source, d.lang, d.topic, d.tokens::BIGINT AS tokens, round(coalesce(probability, 1.0), 6) AS probability,
       CAST('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, '')), 1, 12) AS BIGINT) / 281474976710656.0
           < coalesce(probability, 1.0) AS sampled
FROM doc d LEFT JOIN chance c ON c.source = d.source AND c.lang = d.lang AND c.topic = d.topic
"""
