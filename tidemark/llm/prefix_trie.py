"""Prefix trie of conversations: nodes are distinct beginnings, and sums over subtrees are rolled
up in bands of depths.

A beginning is named by 128 bits: its turns' fingerprints, each mixed with its place, added up.
Sums can be run over a conversation in blocks, so a conversation of any length is cut over tasks,
and texts are read once and never shuffled. A node sends its sums only to the ancestors in its own
band of `BAND` depths. The roots of bands then are a tree of their own, `BAND` times less deep,
which is rolled up in the same way; their completed sums go to the band above. So a node is
exploded at most `BAND` times a level, and levels grow with the logarithm of the depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Workspace

BAND = 8
# Turns whose numbers agree but for so many bits are put in order by one task.
BLOCK_BITS = 10
# Members that end at a node travel in runs of ids that agree but for so many bits.
RUN_BITS = 12

KEY = ["x", "y"]
SUMS = ["n_leaves", "saved_tokens"]
LOW = (1 << 32) - 1
RESULT = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
    "ends_sha256",
]


def root_name() -> list[Column]:
    return [F.lit(0).cast("long").alias(c) for c in KEY]


def no_names() -> Column:
    return F.array().cast("array<struct<x:long,y:long>>")


def fingerprints(turns: DataFrame) -> DataFrame:
    """Columns `conv_id`, `turn`, `a`, `b` (128 bits of role and text) and `n_chars`."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.xxhash64(role, text).alias("a"),
        F.xxhash64(F.lit(1), text, role).alias("b"),
        F.length(text).cast("long").alias("n_chars"),
    )


def running(frame: DataFrame, block: Column, order: list, sums: dict[str, Column]) -> DataFrame:
    """`frame` with running sums over each conversation, the row itself included.

    Blocks of a conversation, numbered in its order, are run each for itself; what stands before
    a block is added from the blocks' totals. So no task needs the whole of a conversation.
    """
    frame = frame.withColumn("block", block)
    totals = frame.groupBy("conv_id", "block").agg(
        *(F.sum(c).alias(f"before_{k}") for k, c in sums.items())
    )
    above = Window.partitionBy("conv_id").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carry = totals.select(
        "conv_id", "block", *(F.sum(f"before_{k}").over(above).alias(f"before_{k}") for k in sums)
    ).where(F.col(f"before_{next(iter(sums))}").isNotNull())
    here = Window.partitionBy("conv_id", "block").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    local = frame.withColumns({k: F.sum(c).over(here) for k, c in sums.items()})
    return (
        local.join(carry, ["conv_id", "block"], "left")
        .withColumns({k: F.col(k) + F.coalesce(f"before_{k}", F.lit(0)) for k in sums})
        .drop("block", *(f"before_{k}" for k in sums))
    )


def numbered(turns: DataFrame) -> DataFrame:
    """`turns` as `fingerprints` returns them, with `pos`, the place in the conversation from 0.

    Turns go by `turn`, null first; those that agree in it by their fingerprints.
    """
    block = F.coalesce(F.shiftright("turn", BLOCK_BITS), F.lit(-(1 << 63)))
    order = [F.asc_nulls_first("turn"), "a", "b"]
    placed = running(turns, block, order, {"pos": F.lit(1).cast("long")})
    return placed.withColumn("pos", F.col("pos") - 1)


def rebuilt(ws: Workspace, conversations: DataFrame, block: int = 100, most: int = 6):
    """Every conversation c with the first h turns of conversation c - c % block in place of its
    own first h; h is the unsigned crc32 of c in decimal, modulo `most`.

    Returns the turns (`conv_id`, `pos`, `a`, `b`, `n_chars`) and a row per conversation
    (`conv_id`, `n_turns`), those without turns included.
    """
    turns = ws.save(numbered(ws.save(fingerprints(conversations), "prints")), "numbered")
    heads = (
        turns.where((F.col("conv_id") % block == 0) & (F.col("pos") < most - 1))
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.sort_array(F.collect_list(F.struct("pos", "a", "b", "n_chars"))).alias("head"))
    )
    named = turns.groupBy("conv_id").agg(F.count("*").alias("n")).withColumns(
        {
            "base": F.col("conv_id") - F.col("conv_id") % block,
            "h": F.crc32(F.col("conv_id").cast("string").cast("binary")) % most,
        }
    )
    no_turns = F.array().cast("array<struct<pos:long,a:long,b:long,n_chars:long>>")
    convs = named.join(heads, "base", "left").select(
        "conv_id",
        "n",
        "h",
        F.coalesce(F.slice("head", 1, F.col("h").cast("int")), no_turns).alias("head"),
    )
    convs = ws.save(convs.withColumn("taken", F.size("head").cast("long")), "conversations")
    # Own turns move down where the base conversation has fewer turns than are replaced.
    gap = (F.col("h") - F.col("taken")).alias("gap")
    moved = convs.where("taken < h and n > h").select("conv_id", gap)
    hash_of = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    own = (
        turns.where(F.col("pos") >= hash_of)
        .join(moved, "conv_id", "left")
        .withColumn("pos", F.col("pos") - F.coalesce("gap", F.lit(0)))
        .drop("turn", "gap")
    )
    fresh = convs.select("conv_id", F.inline("head"))
    sizes = convs.select(
        "conv_id", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n_turns")
    )
    return own.unionByName(fresh.select(own.columns)), sizes


def beginnings(turns: DataFrame) -> DataFrame:
    """Columns `conv_id`, `depth`, `x`, `y`, `n_chars`: each conversation's beginnings, named."""
    first, second = F.xxhash64("pos", "a"), F.xxhash64("b", "pos")
    parts = {
        "p": F.shiftrightunsigned(first, 32), "q": first.bitwiseAND(LOW),
        "r": F.shiftrightunsigned(second, 32), "s": second.bitwiseAND(LOW),
    }
    summed = running(turns, F.shiftright("pos", BLOCK_BITS), ["pos"], parts)

    def name(high: str, low: str) -> Column:
        return F.shiftleft(F.col(high).bitwiseAND(LOW), 32).bitwiseOR(F.col(low).bitwiseAND(LOW))

    return summed.select(
        "conv_id",
        (F.col("pos") + 1).alias("depth"),
        name("p", "q").alias("x"),
        name("r", "s").alias("y"),
        "n_chars",
    )


def with_ancestors(rows: DataFrame) -> DataFrame:
    """`rows` with `up`: the names of their strict ancestors in their parent's band, from the top.

    A band's root closes the group of the band above and opens that of its own, so a group has at
    most BAND + 1 rows of one conversation. The root of all is the first ancestor of the first.
    """
    step = F.col("depth")
    group = F.when(
        step % BAND == 0, F.array(F.floor(step / BAND) - 1, F.floor(step / BAND))
    ).otherwise(F.array(F.floor(step / BAND)))
    held = F.struct("depth", "x", "y", "n_chars")
    groups = (
        rows.select("conv_id", F.explode(group).alias("band"), held.alias("row"))
        .groupBy("conv_id", "band")
        .agg(F.sort_array(F.collect_list("row")).alias("row"))
    )
    root = F.array(F.struct(*root_name()))
    names = F.transform("row", lambda r: F.struct(r["x"].alias("x"), r["y"].alias("y")))
    line = F.when(F.col("band") == 0, F.concat(root, names)).otherwise(names)
    spread = groups.select(
        "conv_id", "band", line.alias("line"), F.posexplode("row").alias("at", "row")
    )
    at = F.col("at") + F.when(F.col("band") == 0, 1).otherwise(0)
    return spread.where((F.col("band") == 0) | (F.col("at") > 0)).select(
        "conv_id", "row.*", F.slice("line", 1, at).alias("up")
    )


def _to_ancestors(rows: DataFrame, names: Column) -> DataFrame:
    return rows.select(F.explode(names).alias("up"), *SUMS).select("up.*", *SUMS)


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEY).agg(*(F.sum(c).alias(c) for c in SUMS))


def roll_up(
    ws: Workspace, paths: DataFrame, nodes: DataFrame, deepest: int, level: int = 0
) -> DataFrame:
    """Sums of `n_leaves` and `saved_tokens` over the subtree of each node.

    `nodes` has `x`, `y`, `depth`, `up` and the two sums; `paths` is `beginnings` at this level.
    """
    own = F.array(F.struct(*KEY))
    inside = F.when(F.col("depth") % BAND == 0, own).otherwise(F.concat("up", own))
    part = _summed(_to_ancestors(nodes, inside))
    if deepest < BAND:
        return part
    part = ws.save(part.join(nodes.select(*KEY, "depth", "up"), KEY), f"part-{level}")
    # The roots of bands, as a tree that is BAND times less deep.
    step = F.floor(F.col("depth") / BAND)
    higher = paths.where(F.col("depth") % BAND == 0).withColumn("depth", step)
    lines = with_ancestors(higher).groupBy(*KEY).agg(F.first("up").alias("up"))
    roots = part.where(F.col("depth") % BAND == 0).withColumn("depth", step)
    tree = roots.drop("up").join(lines, KEY, "left").withColumn("up", F.coalesce("up", no_names()))
    tree = ws.save(tree, f"tree-{level}")
    done = ws.save(roll_up(ws, higher, tree, deepest // BAND, level + 1), f"done-{level}")
    below = done.join(part.where(F.col("depth") > 0).select(*KEY, "up"), KEY)
    inner = F.slice("up", 2, BAND)  # the root of the band above has its sum already
    rest = part.where(F.col("depth") % BAND != 0).select(*KEY, *SUMS)
    return _summed(rest.unionByName(_to_ancestors(below, inner))).unionByName(done)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per node of its runs of ids, which come in order; nothing is held but a state."""
    now, state, found = None, None, []
    for batch in batches:
        for x, y, ids in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if (x, y) != now:
                if now is not None:
                    found.append((*now, state.hexdigest()))
                now, state = (x, y), hashlib.sha256(ids.encode())
            else:
                state.update(f",{ids}".encode())
        yield _digest_rows(found)
        found = []
    yield _digest_rows([(*now, state.hexdigest())] if now is not None else [])


def _digest_rows(found: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string()]
    columns = list(zip(*found)) or [[]] * 3
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, kinds)], names=[*KEY, "ends_sha256"]
    )


def end_digests(paths: DataFrame, sizes: DataFrame) -> DataFrame:
    """Digest of the ids that end at each node, ascending. Ids travel in runs of a bounded length;
    a digest is sequential, so one task reads a node's runs, as a stream."""
    last = paths.groupBy("conv_id").agg(*(F.max_by(c, "depth").alias(c) for c in KEY))
    empty = sizes.where("n_turns = 0").select("conv_id", *root_name())
    ids = F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string"))
    runs = (
        last.unionByName(empty)
        .groupBy(*KEY, F.shiftright("conv_id", RUN_BITS).alias("run"))
        .agg(F.concat_ws(",", ids).alias("ids"))
    )
    ordered = runs.repartition(*KEY).sortWithinPartitions(*KEY, "run")
    return ordered.select(*KEY, "ids").mapInArrow(_digests, "x long, y long, ends_sha256 string")


def conversation_trie(conversations: DataFrame, block: int = 100, most: int = 6) -> DataFrame:
    """Nodes of the trie of rebuilt conversations (see `rebuilt`), one row each.

    Columns `conv_id` (smallest member), `depth`, `parent_conv_id` (null for the root), `n_convs`,
    `n_children`, `n_leaves` and `saved_tokens` (over the subtree), and `ends_sha256`.

    A null role or text counts as empty. Turns are ordered by `turn`, null first, and equal ones by
    a fingerprint of role and text; repeated rows are turns of their own. Rows with a null conv_id
    belong to no conversation and make no node. Extra columns are ignored. An empty table has no
    conversation and so no node, not even a root.
    """
    ws = Workspace(conversations.sparkSession, "trie")
    turns, sizes = rebuilt(ws, conversations, block, most)
    paths = ws.save(beginnings(turns), "paths")
    whole = sizes.agg(F.min("conv_id").alias("least"), F.count("*").alias("n")).first()
    if not whole.n:
        spark = conversations.sparkSession
        longs = ", ".join(f"{c} long" for c in RESULT[:-1])
        return spark.createDataFrame([], f"{longs}, ends_sha256 string")
    found = with_ancestors(paths).groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"),
        F.min("depth").alias("depth"),
        F.count("*").alias("n_convs"),
        F.min("n_chars").alias("n_chars"),
        F.first("up").alias("up"),
    )
    top = conversations.sparkSession.range(1).select(
        *root_name(),
        F.lit(whole.least).alias("conv_id"),
        F.lit(0).cast("long").alias("depth"),
        F.lit(whole.n).alias("n_convs"),
        F.lit(0).cast("long").alias("n_chars"),
        no_names().alias("up"),
    )
    nodes = ws.save(found.unionByName(top), "nodes")
    parent = F.get("up", F.size("up") - 1)
    children = (
        nodes.where("depth > 0")
        .groupBy(parent["x"].alias("x"), parent["y"].alias("y"))
        .agg(F.count("*").alias("n_children"))
    )
    nodes = nodes.join(children, KEY, "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0).cast("long"))
    )
    nodes = ws.save(nodes, "families")
    valued = nodes.select(
        *KEY,
        "depth",
        "up",
        F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("n_chars")).alias("saved_tokens"),
    )
    deepest = nodes.agg(F.max("depth")).first()[0]
    totals = roll_up(ws, paths, valued, deepest)
    nodes = nodes.drop("n_chars").join(totals, KEY).join(end_digests(paths, sizes), KEY, "left")
    nodes = nodes.withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest()))
    )
    nodes = ws.save(
        nodes.select(*(c for c in RESULT if c != "parent_conv_id"), *KEY, parent.alias("over")),
        "sums",
    )
    # A first turn's parent is the root, whose id is known; other hot parents are joins that
    # Spark splits.
    owners = nodes.where("depth > 0 and n_children > 0").select(
        F.col("x").alias("px"), F.col("y").alias("py"), F.col("conv_id").alias("parent_conv_id")
    )
    deep = nodes.where("depth > 1").join(
        owners, (F.col("over.x") == F.col("px")) & (F.col("over.y") == F.col("py"))
    )
    shallow = nodes.where("depth <= 1").withColumn(
        "parent_conv_id", F.when(F.col("depth") == 1, F.lit(whole.least))
    )
    return deep.select(*RESULT).unionByName(shallow.select(*RESULT))
