"""Mixing sources to target weights as a min-cost flow over membership patterns.

A document may belong to several sources. Documents are aggregated by the set of their sources;
each pattern offers its words once, twice and three times at rising cost, each source asks for its
target, and the cheapest flow says how many words each pattern gives to each source. Documents
are then selected in a seeded order until their pattern's words are taken.

Scale. Only pattern sums reach the driver, at most MAX_PATTERNS rows; the flow falls apart into
the connected parts of patterns and sources. Where every document has one source, patterns do not
overlap and a source's flow is its target, so more sources than that are settled as tables. What
remains is a limit of MAX_PATTERNS patterns, and sources, where an array names them. The seeded order is found by bucket sums: all but
one bucket per pattern are taken or left whole, and only that one is put in order.
"""

from __future__ import annotations

import heapq
import json
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Workspace, maybe_broadcast

REPEATS = 3  # most copies of a document
COSTS = (1, 2, 4)  # of a word's first, second and third copy
WEIGHTS = (5, 2, 1)
MAX_PATTERNS = 100_000
BUCKETS = 12  # bits of the hash that name a bucket, at least

WORD_COUNT = "size(regexp_extract_all(coalesce(text, ''), '([^ \\\\t\\\\n\\\\x0B\\\\f\\\\r]+)', 1))"


def targets(sizes: dict, weights: dict, budget: float) -> dict:
    """Shares of a budget by weight, none above REPEATS times its size; excess is shared again."""
    out: dict = {}
    active = set(sizes)
    while active:
        left = budget - sum(out.values())
        total = sum(weights[s] for s in active)
        share = {s: left * weights[s] / total for s in active}
        over = [s for s in active if share[s] > REPEATS * sizes[s]]
        if not over:
            return out | share
        out |= {s: float(REPEATS * sizes[s]) for s in over}
        active -= set(over)
    return out


def min_cost_flow(supply: dict[str, tuple[int, list]], demand: dict) -> dict[str, int]:
    """Words that each pattern gives in all, where supply maps it to (words, sources).

    Successive shortest paths with potentials. Parts that share no source are solved apart.
    """
    given = dict.fromkeys(supply, 0)
    by_source: dict = {}
    for name, (_, sources) in supply.items():
        for s in sources:
            by_source.setdefault(s, []).append(name)
    seen: set = set()
    for start in supply:
        if start in seen:
            continue
        part, todo = [], [start]
        seen.add(start)
        while todo:
            name = todo.pop()
            part.append(name)
            for s in supply[name][1]:
                for other in by_source[s]:
                    if other not in seen:
                        seen.add(other)
                        todo.append(other)
        given |= _solve({name: supply[name] for name in part}, demand)
    return given


def _solve(supply: dict, demand: dict) -> dict[str, int]:
    nodes: dict = {"from": 0, "to": 1}
    edges: list[list[int]] = []  # to, room, cost; the reverse of edge e is e ^ 1
    out: list[list[int]] = [[], []]

    def node(key) -> int:
        if key not in nodes:
            nodes[key] = len(out)
            out.append([])
        return nodes[key]

    def connect(a: int, b: int, room: int, cost: int) -> int:
        out[a].append(len(edges))
        edges.append([b, room, cost])
        out[b].append(len(edges))
        edges.append([a, 0, -cost])
        return len(edges) - 2

    layers: dict[str, list[int]] = {}
    for name, (words, sources) in supply.items():
        at = node(("pattern", name))
        layers[name] = [connect(0, at, words, cost) for cost in COSTS]
        for s in sources:
            connect(at, node(("source", s)), REPEATS * words, 0)
    for s in {s for _, sources in supply.values() for s in sources}:
        connect(node(("source", s)), 1, int(demand[s]), 0)
    potential = [0] * len(out)
    while True:
        far = [None] * len(out)
        by = [-1] * len(out)
        queue = [(0, 0)]
        far[0] = 0
        while queue:
            d, a = heapq.heappop(queue)
            if d > far[a]:
                continue
            for e in out[a]:
                b, room, cost = edges[e]
                if room > 0:
                    reach = d + cost + potential[a] - potential[b]
                    if far[b] is None or reach < far[b]:
                        far[b], by[b] = reach, e
                        heapq.heappush(queue, (reach, b))
        if far[1] is None:
            break
        potential = [p + (f if f is not None else far[1]) for p, f in zip(potential, far)]
        room, at = None, 1
        while at:
            e = by[at]
            room = edges[e][1] if room is None else min(room, edges[e][1])
            at = edges[e ^ 1][0]
        at = 1
        while at:
            e = by[at]
            edges[e][1] -= room
            edges[e ^ 1][1] += room
            at = edges[e ^ 1][0]
    return {name: sum(edges[e ^ 1][1] for e in found) for name, found in layers.items()}


def _in_tables(ws: Workspace, sized: DataFrame, weights: dict | None) -> DataFrame:
    """What `targets` and the flow give where each pattern is one source, at any number of them:
    `pattern`, `named`, `source_size`, `target` and the words `given`, one row per source."""
    spark = sized.sparkSession
    found = sized.groupBy("pattern", F.col("source").alias("named")).agg(
        F.sum("size").alias("source_size")
    )
    if weights is None:
        # The rank of a source: its place in its task after the rows of the tasks before.
        ranked = found.orderBy(F.col("named").asc_nulls_last())
        ranked = ws.save(ranked.withColumn("at", F.monotonically_increasing_id()), "ranked")
        task = F.shiftright("at", 33)
        rows = ranked.groupBy(task.alias("task")).count().orderBy("task").collect()
        before, low = {}, 0
        for r in rows:
            before[r.task], low = low, low + r["count"]
        start = spark.createDataFrame(list(before.items()), "task long, low long")
        rank = F.col("low") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
        turns = F.array(*map(F.lit, WEIGHTS))
        found = ranked.join(F.broadcast(start), task == F.col("task")).withColumn(
            "weight", F.get(turns, (rank % len(WEIGHTS)).cast("int"))
        )
    else:
        held = [(s, float(w)) for s, w in weights.items()]
        held = spark.createDataFrame(held, "key string, weight double")
        found = found.join(held, F.col("named").eqNullSafe(F.col("key")), "left")
    found = found.select("pattern", "named", "source_size", "weight", F.lit(False).alias("over"))
    found = ws.save(found, "weighed")
    lost = found.where("weight is null").first()
    if lost is not None:
        raise KeyError(lost.named)
    # A source that is over its most stays so, as what is left to a weight only grows.
    budget = float(found.agg(F.sum("source_size")).first()[0])
    most = (F.col("source_size") * REPEATS).cast("double")
    over, turn = F.col("over"), 0
    while True:
        turn += 1
        now = found.agg(
            F.sum(F.when(over, most).otherwise(0.0)),
            F.sum(F.when(~over, F.col("weight")).otherwise(0)),
            F.sum(over.cast("long")),
        ).first()
        left, total = budget - now[0], float(now[1])
        share = F.lit(left) * F.col("weight") / F.lit(total or 1.0)
        beyond = over | (share > most)
        following = found.agg(F.sum(beyond.cast("long"))).first()[0]
        if following == now[2]:
            break
        # Settled by table, so that the expression does not grow with the rounds.
        found = ws.save(found.withColumn("over", beyond), f"over-{turn}")
    target = F.when(over, most).otherwise(share)
    return found.select(
        "pattern", "named", "source_size", target.alias("target"),
        F.least(F.rint(target).cast("long"), F.col("source_size") * REPEATS).alias("given"),
    )


def draw_order(seed: int):
    """The order in which documents are drawn: by id, those without one by their texts. A null
    leaves a hash as it is."""
    anonymous = F.when(F.col("doc_id").isNull(), F.xxhash64("text"))
    return F.xxhash64(F.col("doc_id").cast("long"), anonymous, F.lit(seed))


def mix_sources(
    docs: DataFrame,
    sources: str | None = None,
    weights: dict | None = None,
    seed: int = 1,
    ws: Workspace | None = None,
) -> DataFrame:
    """A mix of documents: columns `doc_id`, `size`, `source_size`, `target`, `taken`.

    `sources` names an array column with the sources of a document; without it the column
    `source` is the only one. `weights` maps sources to weights; by default they weigh 5, 2 and 1
    in turn by code point order, null last. Sources share the words of all documents, none above
    three times its own. `size` is a document's words; `taken` is its size times the copies the
    mix holds, 0 to 3. `source_size` and `target` are those of its first source.

    A source's words come within half a document of its target. One row per input row; a null
    text has size 0; a null source is a source; a document of no source is not taken. Equal
    doc_ids are ordered by size, and reruns agree. An empty table gives an empty result. Without
    `sources` any number of sources will do; with it, more than MAX_PATTERNS membership patterns
    or sources raise a ValueError.
    """
    spark = docs.sparkSession
    ws = ws or Workspace(spark, "mix")
    members = F.col(sources) if sources else F.array("source")
    members = F.array_sort(F.array_distinct(members.cast("array<string>")))
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.expr(WORD_COUNT).cast("long").alias("size"),
        F.to_json(members).alias("pattern"),
        members[0].alias("source"),
        draw_order(seed).alias("order"),
    )
    sized = ws.save(sized, "sized")
    # About as many buckets as one bucket has rows, so that neither outgrows a task.
    bits = max(BUCKETS, math.ceil(math.log2(sized.count() + 1) / 2))
    sized = sized.withColumn("bucket", F.shiftrightunsigned("order", 64 - bits).cast("int"))

    sums = sized.groupBy("pattern").agg(F.sum("size").alias("words")).limit(MAX_PATTERNS + 1)
    held = sums.collect()
    if len(held) > MAX_PATTERNS and not sources:
        whole = ws.save(_in_tables(ws, sized, weights), "whole")
        words = F.col("source_size")
        plan = whole.select(
            "pattern",
            words.alias("words"),
            F.when(words > 0, F.expr("given div source_size")).otherwise(0).alias("copies"),
            F.when(words > 0, F.expr("given % source_size")).otherwise(0).alias("rest"),
        )
        aim = whole.select("named", "source_size", "target")
        bytes_ = whole.agg(F.sum(F.octet_length("pattern") + 64)).first()[0]
    else:
        supply = {r.pattern: (r.words, json.loads(r.pattern)) for r in held if r.pattern is not None}
        sizes: dict = {}
        for words, names in supply.values():
            for s in names:
                sizes[s] = sizes.get(s, 0) + words
        if len(supply) > MAX_PATTERNS or len(sizes) > MAX_PATTERNS:
            raise ValueError(f"more than {MAX_PATTERNS} membership patterns or sources")
        ranked = sorted(sizes, key=lambda s: (s is None, s or ""))
        if weights is None:
            weights = {s: WEIGHTS[i % len(WEIGHTS)] for i, s in enumerate(ranked)}
        total = sum(words for words, _ in supply.values())
        aims = targets(sizes, weights, float(total))
        given = min_cost_flow(supply, {s: round(aims[s]) for s in aims})

        plan = spark.createDataFrame(
            [(p, words, given[p] // words if words else 0, given[p] % words if words else 0)
             for p, (words, _) in supply.items()],
            "pattern string, words long, copies long, rest long",
        )
        aim = spark.createDataFrame(
            [(s, sizes[s], aims[s]) for s in ranked],
            "named string, source_size long, target double",
        )
        bytes_ = sum(64 + len(p.encode()) for p in supply)
    plan, aim = maybe_broadcast(plan, bytes_), maybe_broadcast(aim, bytes_)
    # The bucket in which a pattern's last words are taken, and the words before it.
    buckets = sized.groupBy("pattern", "bucket").agg(F.sum("size").alias("n")).join(plan, "pattern")
    upto = F.sum("n").over(
        Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    )
    edge = (
        buckets.withColumn("upto", upto)
        .where("upto - n <= rest and rest < upto")
        .groupBy("pattern")
        .agg(F.min("bucket").alias("edge"), F.min_by(F.expr("upto - n"), "bucket").alias("before"))
    )
    placed = sized.join(plan, "pattern", "left").join(
        maybe_broadcast(edge, bytes_), "pattern", "left"
    )
    placed = placed.withColumn("cut", F.col("bucket") == F.col("edge"))
    inside = placed.where("cut")
    order = Window.partitionBy("pattern").orderBy("order", "doc_id", "size")
    before = F.col("before") + F.sum("size").over(
        order.rowsBetween(Window.unboundedPreceding, 0)
    ) - F.col("size")
    inside = inside.withColumn("extra", (2 * before + F.col("size") <= 2 * F.col("rest")).cast("int"))
    outside = placed.where("not coalesce(cut, false)").withColumn(
        "extra", F.coalesce((F.col("bucket") < F.col("edge")).cast("int"), F.lit(0))
    )
    both = inside.unionByName(outside)
    return both.join(aim, F.col("source").eqNullSafe(F.col("named")), "left").select(
        "doc_id",
        "size",
        F.coalesce("source_size", F.lit(0)).alias("source_size"),
        F.coalesce("target", F.lit(0.0)).alias("target"),
        F.coalesce(
            F.col("size") * F.least(F.col("copies") + F.col("extra"), F.lit(REPEATS)), F.lit(0)
        ).alias("taken"),
    )
