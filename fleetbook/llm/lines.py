"""Removal of lines that many documents share, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetbook.llm.common import ascii_lower, written

BLANK = " \t\n\x0b\x0c\r"  # [\x20\x09-\x0D]


def drop_shared_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Split texts at ``\\n``; a line's key is the line stripped of blanks with
    A-Z lower-cased. Keys of at least ``min_chars`` code points found in at
    least ``min_docs`` documents lose all their lines. Returns the id, ``text``
    (kept lines joined by ``\\n``), ``n_lines`` and ``n_dropped``.

    Keys travel as 128-bit hashes. Each document's distinct keys are exploded
    and counted after a partial aggregate per (key, document), so a line found
    in a third of the documents is one row per task when it is counted. The
    frequent keys are written once, so the join that finds their positions
    reads two plain shuffles and AQE can split a hot key. Texts are shuffled
    once, to meet their dropped positions.

    A null or empty text is one empty line, kept. Rows with a null id count as
    one document; repeated rows count once and are each returned; rows that
    share an id but not the text are cut apart by a hash of the text. Other
    columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    keys = F.transform(F.split(ascii_lower(text), "\n", -1), lambda x: F.btrim(x, F.lit(BLANK)))
    hashes = F.transform(keys, lambda k: F.when(
        F.length(k) >= min_chars,
        F.struct(F.xxhash64(k).alias("h1"), F.xxhash64(F.lit(1), k).alias("h2"))))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("version"), hashes.alias("hashes"))

    def key(column):
        return [F.col(f"{column}.h1").alias("h1"), F.col(f"{column}.h2").alias("h2")]

    found = (rows.select("id", F.explode(F.array_distinct("hashes")).alias("k")).where("k is not null")
             .select("id", *key("k")).distinct())
    frequent = written(found.groupBy("h1", "h2").agg(F.count("*").alias("n"))
                       .where(F.col("n") >= min_docs).select("h1", "h2"), "shared-lines")
    dropped = (rows.select("id", "version", F.posexplode("hashes").alias("pos", "k"))
               .where("k is not null").select("id", "version", "pos", *key("k"))
               .join(frequent, ["h1", "h2"])
               .groupBy(F.col("id").alias("d_id"), F.col("version").alias("d_version"))
               .agg(F.collect_set("pos").alias("gone")))
    lines = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("version"),
                        F.split(text, "\n", -1).alias("lines"))
    both = lines.join(dropped, F.col("id").eqNullSafe(F.col("d_id"))
                      & (F.col("version") == F.col("d_version")), "left")
    stays = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = F.when(F.col("gone").isNull(), F.col("lines")).otherwise(
        F.transform(stays, lambda i: F.col("lines")[i]))
    return both.select(
        F.col("id").alias(id_col), F.array_join(kept, "\n").alias("text"),
        F.size("lines").cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_dropped"))
