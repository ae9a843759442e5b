"""Prefix trie of conversations, built by van Emde Boas recursion."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetbook.llm.common import few_ids, written

ORDER_CHARS = 64  # leading characters by which rows of one turn number are ordered
JOINED_IDS = 4096  # conversation ids that are joined to one text


# ------------------------------------------------------------------- positions

def numbered(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, pos, digest, chars): every turn with its place in its
    conversation (from 0), a digest of role and text, and the text's length.

    Rows are range-partitioned in order, so a conversation may span
    partitions: a task counts from the first row of a conversation that it
    holds, and what earlier tasks hold of the conversation that it begins
    with is added afterwards, a row per task."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
        F.substring(role, 1, ORDER_CHARS).alias("role"), F.substring(text, 1, ORDER_CHARS).alias("head"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.length(text).cast("long").alias("chars"))
    order = ["conv", "turn", "role", "head", "digest"]
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column(0).to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
            sizes = np.diff(np.append(starts, len(conv)))
            pos = np.arange(len(conv)) - np.repeat(starts, sizes)
            if conv[0] == last:
                pos[:sizes[0]] += seen
            last, seen = conv[-1], int(pos[-1]) + 1
            yield pa.record_batch([pa.array([part] * len(conv), pa.int32()), batch.column(0), pa.array(pos, pa.int64()),
                                   batch.column(1), batch.column(2)],
                                  names=["part", "conv", "pos", "digest", "chars"])

    counted = written(
        rows.repartitionByRange(parts, *order, F.monotonically_increasing_id()).sortWithinPartitions(*order)
        .select("conv", "digest", "chars").mapInArrow(
            count, "part int, conv long, pos long, digest binary, chars long"), "turns")
    # only the conversations that a task begins or ends with can go on in another
    ends = counted.groupBy("part").agg(F.min("conv").alias("lo"), F.max("conv").alias("hi"))
    split = (ends.select("part", F.explode(F.array("lo", "hi")).alias("conv")).distinct()
             .join(counted.groupBy("part", "conv").agg(F.count(F.lit(1)).alias("n")), ["part", "conv"]))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = few_ids(split.withColumn("before", F.sum("n").over(earlier)).where(F.col("before") > 0)
                     .select("part", "conv", "before"))
    return counted.join(before, ["part", "conv"], "left").select(
        "conv", (F.col("pos") + F.coalesce("before", F.lit(0))).alias("pos"), "digest", "chars")


def rebuilt(turns: DataFrame, group: int, heads: int) -> tuple[DataFrame, DataFrame]:
    """Conversations with shared openings: conversation c takes the first
    h = crc32(c) % ``heads`` turns of c - c % ``group``, then its own after its
    first h. Returns the turns and (conv, turns), every conversation once."""
    def share(conv):
        return (F.crc32(conv.cast("string").cast("binary")) % heads).cast("long")

    base = F.col("conv") - F.col("conv") % group
    opening = few_ids(turns.where((F.col("conv") % group == 0) & (F.col("pos") < heads - 1)).groupBy("conv").agg(
        F.array_sort(F.collect_list(F.struct("pos", "digest", "chars"))).alias("opening"))
        .withColumnRenamed("conv", "base"))
    each = (turns.withColumn("base", base).withColumn("h", share(F.col("conv")))
            .join(opening, "base", "left")
            .withColumn("taken", F.least(F.col("h"), F.coalesce(F.size("opening"), F.lit(0)))))
    own = each.where(F.col("pos") >= F.col("h")).select(
        "conv", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "digest", "chars")
    first = each.where(F.col("pos") == 0)
    given = first.where(F.col("taken") > 0).select(
        "conv", F.explode(F.slice("opening", F.lit(1), F.col("taken"))).alias("x")).select("conv", "x.*")
    turns = own.unionByName(given)
    lengths = (first.select("conv", F.lit(0).cast("long").alias("n"))
               .unionByName(turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))))
    return turns, lengths.groupBy("conv").agg(F.max("n").alias("turns"))


# ---------------------------------------------------------------------- naming

def _blocks(turns: DataFrame, levels: int) -> DataFrame:
    """(level, conv, lo, a, b, chars): for each level the whole first halves of
    the pieces of 2^(level + 1) turns, as two 64-bit sums (exclusive or) of
    their turns' digests hashed with their places, and the last text's length."""
    level = F.col("level")
    mine = F.filter(F.array(*(F.lit(j) for j in range(levels))),
                    lambda j: F.call_function("getbit", F.col("pos"), j) == 0)
    half = F.call_function("shiftleft", F.lit(1).cast("long"), level)
    rows = (turns.select("conv", "pos", "chars", F.xxhash64("digest", "pos").alias("a"),
                         F.xxhash64(F.lit("second"), "pos", "digest").alias("b"), F.explode(mine).alias("level"))
            .withColumn("lo", F.call_function("shiftleft", F.call_function(
                "shiftright", F.col("pos"), level + 1), level + 1)))
    return (rows.groupBy("level", "conv", "lo").agg(
        F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"), F.count(F.lit(1)).alias("n"),
        F.max(F.when(F.col("pos") == F.col("lo") + half - 1, F.col("chars"))).alias("chars"))
        .where(F.col("n") == half).drop("n"))


def named(turns: DataFrame, first: int, longest: int) -> DataFrame:
    """(conv, depth, name, chars): the name of each conversation's every
    prefix, which is the least conversation that shares it.

    Sequences are cut at half depth, again and again. All pieces of one height
    are cut at once: the first half of a piece under the name of its root
    names the cut, and the halves are the upper trie and the lower forest,
    pieces of half the height. A prefix is named once, at the level of the
    lowest set bit of its depth, so the rounds are the logarithm of the
    longest conversation. ``first`` is the least conversation of all.
    """
    levels = max(1, longest.bit_length())
    blocks = written(_blocks(turns, levels), "blocks")
    done: list[DataFrame] = []
    for level in reversed(range(levels)):
        half = 1 << level
        mine = blocks.where(F.col("level") == level).drop("level")
        roots = mine.where("lo = 0").withColumn("root", F.lit(first).cast("long"))
        if done:
            above = reduce(DataFrame.unionByName, done).where(F.col("depth") % (2 * half) == 0)
            roots = roots.unionByName(mine.where("lo > 0").join(
                above.select("conv", F.col("depth").alias("lo"), F.col("name").alias("root")), ["conv", "lo"]))
        roots = written(roots, "pieces")
        key = ["lo", "root", "a", "b"]
        cut = few_ids(roots.groupBy(*key).agg(F.min("conv").alias("name")))
        done.append(written(roots.join(cut, key).select(
            "conv", (F.col("lo") + half).alias("depth"), "name", "chars"), "names"))
    return reduce(DataFrame.unionByName, done)


# ---------------------------------------------------------------------- totals

def grafted(nodes: DataFrame, paths: DataFrame, longest: int) -> DataFrame:
    """(depth, name, n_leaves, saved): ``leaf`` and ``saved`` summed over the
    subtree of every node below the root.

    The naming in reverse: pieces of one height are joined in pairs, and what
    hangs below a cut prefix is grafted to the nodes on its path in the upper
    half, which the conversation that names it lists. A lower forest adds one
    row per cut, and sums are added up inside the tasks first.
    """
    sums = [nodes.where("depth > 0").select("depth", "name", "parent", "leaf", "saved")]
    for level in range(max(1, longest.bit_length())):
        half = 1 << level
        tops = (F.col("depth") - 1) % (2 * half) == half
        below = few_ids(reduce(DataFrame.unionByName, sums).where(tops).groupBy(
            F.col("parent").alias("conv"), F.floor((F.col("depth") - 2) / half).alias("piece"))
            .agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved")))
        if below.isEmpty():
            continue
        upper = paths.where((F.col("depth") - 1) % (2 * half) < half).select(
            "conv", "depth", "name", "parent", F.floor((F.col("depth") - 1) / half).alias("piece"))
        sums.append(written(upper.join(below, ["conv", "piece"]).groupBy("depth", "name", "parent").agg(
            F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved")), "grafts"))
    return reduce(DataFrame.unionByName, sums).groupBy("depth", "name").agg(
        F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved"))


def ends_digest(ends: DataFrame) -> DataFrame:
    """(depth, name, ends): SHA-256 of each node's conversation ids ``conv`` in
    ascending order, as decimals joined by commas.

    Many conversations may end at one node. They are sorted over all tasks,
    which join runs of them to texts; one task then reads a node's texts, a
    few thousand ids each, and never holds more than one."""
    def join(batches):
        for batch in batches:
            depth, name, conv = (c.to_pylist() for c in batch.columns)
            lo = 0
            for hi in range(1, len(conv) + 1):
                if hi == len(conv) or hi - lo == JOINED_IDS or (depth[hi], name[hi]) != (depth[lo], name[lo]):
                    yield pa.record_batch([pa.array([x], t) for x, t in (
                        (depth[lo], pa.int64()), (name[lo], pa.int64()), (conv[lo], pa.int64()),
                        (",".join(map(str, conv[lo:hi])), pa.string()))], names=["depth", "name", "first", "ids"])
                    lo = hi

    def digest(batches):
        node, state = None, None
        done: list[tuple] = []
        for batch in batches:
            for depth, name, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if (depth, name) == node:
                    state.update(b"," + ids.encode())
                    continue
                if node is not None:
                    done.append((*node, state.hexdigest()))
                node, state = (depth, name), hashlib.sha256(ids.encode())
            if done:
                yield _nodes(done)
                done = []
        if node is not None:
            yield _nodes([(*node, state.hexdigest())])

    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["depth", "name", "conv"]
    runs = (ends.select(*order).repartitionByRange(parts, *order).sortWithinPartitions(*order)
            .mapInArrow(_batched(join), "depth long, name long, first long, ids string"))
    return (runs.repartition("depth", "name").sortWithinPartitions("depth", "name", "first")
            .mapInArrow(digest, "depth long, name long, ends string"))


def _nodes(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.string()))],
                           names=["depth", "name", "ends"])


def _batched(make):
    """The small batches of ``make`` put together, one per batch read."""
    def each(batches):
        for batch in batches:
            if made := list(make([batch])):
                yield from pa.Table.from_batches(made).combine_chunks().to_batches()

    return each


def prefix_trie(conversations: DataFrame, group: int = 100, heads: int = 6, conv_col: str = "conv_id",
                turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The trie of all rebuilt conversations (see ``rebuilt``), a row per node:
    conv_id (least member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.

    Turns are ordered by turn number, null first; rows of one number by role
    and text (their first ``ORDER_CHARS`` characters, then a digest), so
    repeated rows are turns of their own. A null role or text is empty. Rows
    without a conversation id take no part. Conversations left without turns
    are members of the root, which is there unless the table is empty. Turns
    are told apart by SHA-256 and prefixes by 128 bits hashed from that. Other
    columns are not read.
    """
    turns, lengths = rebuilt(written(numbered(conversations, conv_col, turn_col, role_col, text_col), "numbered"),
                             group, heads)
    turns, lengths = written(turns, "rebuilt"), written(lengths, "lengths")
    first, longest = lengths.agg(F.min("conv"), F.max("turns")).first()
    if first is None:
        first, longest = 0, 0
    names = named(turns, first, longest) if longest else lengths.limit(0).select(
        "conv", *(F.lit(0).cast("long").alias(c) for c in ("depth", "name", "chars")))
    root = lengths.select("conv", *(F.lit(x).cast("long").alias(c) for c, x in
                                    (("depth", 0), ("name", first), ("chars", 0))))
    names = names.unionByName(root)
    above = names.select("conv", (F.col("depth") + 1).alias("depth"), F.col("name").alias("parent"))
    paths = written(names.join(above, ["conv", "depth"], "left"), "paths")
    nodes = paths.groupBy("depth", "name").agg(F.min("parent").alias("parent"), F.count(F.lit(1)).alias("n_convs"),
                                               F.max("chars").alias("chars"))
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("name")).agg(
        F.count(F.lit(1)).alias("n_children"))
    zero = F.lit(0).cast("long")
    nodes = written(nodes.join(children, ["depth", "name"], "left").select(
        "depth", "name", "parent", "n_convs", F.coalesce("n_children", zero).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved")), "nodes")
    totals = written(grafted(nodes, paths, longest), "totals")
    leaves, saved = totals.where("depth = 1").agg(F.sum("n_leaves"), F.sum("saved")).first()
    totals = totals.unionByName(nodes.where("depth = 0").select(
        "depth", "name", F.lit(leaves or 1).cast("long").alias("n_leaves"), F.lit(saved or 0).cast("long").alias("saved")))
    ends = ends_digest(paths.select("depth", "name", "conv").join(
        lengths.select("conv", F.col("turns").alias("depth")), ["conv", "depth"]))
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return (nodes.drop("saved", "leaf").join(totals, ["depth", "name"]).join(ends, ["depth", "name"], "left")
            .select(F.col("name").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs",
                    "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
                    F.coalesce("ends", none).alias("ends_sha256")))
