"""The prefix trie of conversations, rolled up by centroid decomposition.

A node is the first d turns of some conversations, known by the smallest of them and d. Its parent edges
make a tree as deep as the longest conversation, so totals of subtrees are not taken level by level:

    split       a component's centroid is the deepest node that holds over half of its weight; taking it
                out leaves components of half the weight at most, and all components are split at once
    aggregate   the total of the component's nodes at and below the centroid, one sum by component
    add         that total to every node on the way from the centroid to the component's top

A node's weight in its component starts as the turns of its members from there on, a plain sum, and goes
down along the same ways. A total comes to a node once from each component cut off below it, so when all
components are single nodes, what was added to a node and its own value are its subtree's total.
Components of more than PIECE are split by Spark, a round for all of them; smaller ones are finished
in a task each, by the same steps.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from filingmill.llm.common import ship, stored

HEAD = 9  # a conversation takes fewer turns than this from another
GROUP = 5
BLOCK = 4096  # turns of a conversation hashed by one window
PIECE = 50_000  # weight of a component that a task finishes
IDS = 20_000  # conversations named in one piece of text


def turns(conversations: DataFrame) -> DataFrame:
    """conv, place (from 1), x, y (hashes of role and text), bytes: the turns in order.

    Turns are in order of `turn`, null first; of equal ones, of role and text. Null role or text is empty.
    Rows without a conversation take no part; repeated rows are turns each. The rows are dealt by ranges
    of that order, and what a range has of a conversation is counted on, so a conversation of any length
    is no task's alone."""
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")),
    )
    ranges = rows.repartitionByRange("conv", F.asc("turn"), "role", F.substring("text", 1, 64))
    ordered = ranges.sortWithinPartitions("conv", F.asc("turn"), "role", "text").select(
        "conv",
        F.monotonically_increasing_id().alias("row"),
        F.xxhash64(F.lit(1), "role", "text").alias("x"),
        F.xxhash64(F.lit(2), "text", "role").alias("y"),
        F.octet_length("text").cast("long").alias("bytes"),
    )
    ordered = stored(ordered.withColumn("range", F.shiftright("row", 33)), "turns")
    counted = ordered.groupBy("conv", "range").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    earlier = F.sum("n").over(Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    counted = counted.withColumn("before", F.coalesce(earlier, F.lit(0)))
    return ordered.join(counted, ["conv", "range"]).select("conv", (F.col("row") - F.col("first") + F.col("before") + 1).alias("place"), "x", "y", "bytes")


def rebuilt(own: DataFrame) -> DataFrame:
    """conv, depth, size, x, y, bytes: the turns of the rebuilt conversations, and one row of depth 0 for each.

    Of conversation c the first h turns of c - c % 5 (all if it has fewer, none if there is none), then
    its own turns after its first h; h is the unsigned crc32 of its decimal number modulo 9."""
    sizes = own.groupBy("conv").agg(F.count("*").alias("n"))
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % HEAD
    convs = sizes.withColumns({"base": F.col("conv") - F.col("conv") % GROUP, "h": h})
    convs = convs.join(sizes.select(F.col("conv").alias("base"), F.col("n").alias("base_n")), "base", "left")
    convs = convs.withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))))
    convs = stored(convs.withColumn("size", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).select("conv", "base", "h", "taken", "size"), "rebuilt")
    heads = own.filter((F.col("conv") % GROUP == 0) & (F.col("place") < HEAD)).withColumnRenamed("conv", "base")
    heads = heads.join(convs, "base").filter("place <= taken").select("conv", F.col("place").alias("depth"), "size", "x", "y", "bytes")
    rest = own.join(convs, "conv").filter("place > h").select("conv", (F.col("taken") + F.col("place") - F.col("h")).alias("depth"), "size", "x", "y", "bytes")
    zero = F.lit(0).cast("long")
    roots = convs.select("conv", zero.alias("depth"), "size", zero.alias("x"), zero.alias("y"), zero.alias("bytes"))
    return heads.unionByName(rest).unionByName(roots)


def prefixes(rows: DataFrame) -> DataFrame:
    """The rows with px, py: hashes of all turns up to this one, and the same of those before it as qx, qy.

    A turn's hashes are mixed with its depth and added up by exclusive or, block by block, so that no
    window holds a whole conversation of any length. Two of 64 bits tell sequences apart."""
    rows = rows.withColumns({c: F.when(F.col("depth") > 0, F.xxhash64("depth", c)).otherwise(F.lit(0)) for c in "xy"})
    rows = rows.withColumn("block", F.expr(f"depth div {BLOCK}"))
    inside = Window.partitionBy("conv", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    blocks = rows.groupBy("conv", "block").agg(F.bit_xor("x").alias("bx"), F.bit_xor("y").alias("by"))
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("conv", "block", *(F.bit_xor(f"b{c}").over(earlier).alias(f"b{c}") for c in "xy")).filter("block > 0")
    found = rows.select("*", *(F.bit_xor(c).over(inside).alias(f"p{c}") for c in "xy")).join(blocks, ["conv", "block"], "left")
    found = found.withColumns({f"p{c}": F.col(f"p{c}").bitwiseXOR(F.coalesce(f"b{c}", F.lit(0))) for c in "xy"})
    found = found.withColumns({f"q{c}": F.col(f"p{c}").bitwiseXOR(F.col(c)) for c in "xy"})
    return found.select("conv", "depth", "size", "bytes", "px", "py", "qx", "qy")


def trie(conversations: DataFrame, piece: int = PIECE) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of each node.

    Order, nulls and repeated rows as in `turns`, conversations as in `rebuilt`. All conversations, also
    those without a turn, are members of the root. A childless node counts itself as leaf of its subtree.
    An empty table has no nodes, as nothing would name the root. Other columns are not read."""
    ship(conversations.sparkSession)
    rows = stored(prefixes(rebuilt(turns(conversations))), "prefixes")
    nodes = rows.groupBy("px", "py", "depth").agg(
        F.min("conv").alias("node"),
        F.count("*").alias("n_convs"),
        F.sum(F.col("size") - F.col("depth") + 1).alias("weight"),
        F.max("bytes").alias("bytes"),
        F.max("qx").alias("qx"),  # all members have the same
        F.max("qy").alias("qy"),
    )
    nodes = stored(nodes, "nodes")
    parents = nodes.select(F.col("px").alias("qx"), F.col("py").alias("qy"), (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"))
    nodes = stored(nodes.join(parents, ["qx", "qy", "depth"], "left").drop("qx", "qy"), "nodes")
    children = nodes.filter("depth > 0").groupBy(F.col("parent").alias("node"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, ["node", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = nodes.join(ends(rows), ["px", "py", "depth"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)))
    nodes = stored(nodes, "nodes")

    ways = rows.join(nodes.select("px", "py", "depth", "node", "parent"), ["px", "py", "depth"]).select("conv", "depth", "node", "parent")
    leaf = (F.col("n_children") == 0).cast("long")
    values = nodes.select("node", "depth", "parent", "weight", leaf.alias("leaves"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    totals = rollup(values, ways, piece)
    return nodes.join(totals, ["node", "depth"]).select(
        F.col("node").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), "ends_sha256",
    )


def ends(rows: DataFrame) -> DataFrame:
    """px, py, depth, ends_sha256 of nodes at which conversations end: the digest of their numbers.

    The numbers are put together in pieces by ranges, so that a node where a third of all conversations
    end is many tasks' work but for the digest, which is taken piece by piece."""
    key = ["px", "py", "depth"]
    ending = rows.filter("depth = size").select(*key, "conv")
    ordered = ending.repartitionByRange(*key, "conv").sortWithinPartitions(*key, "conv")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, some, out = None, [], []
        for batch in batches:
            for *node, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if some and (node != at or len(some) == IDS):
                    out.append((*at, some[0], ",".join(map(str, some))))
                    some = []
                at = node
                some.append(conv)
            if out:
                yield _batch(out, [*key, "first", "text"], pa.string())
                out = []
        if some:
            yield _batch([(*at, some[0], ",".join(map(str, some)))], [*key, "first", "text"], pa.string())

    pieces = ordered.mapInArrow(join, "px long, py long, depth long, first long, text string")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, out = None, None, []
        for batch in batches:
            for *node, _, text in zip(*(c.to_pylist() for c in batch.columns)):
                if node == at:
                    state.update(b"," + text.encode())
                    continue
                if at:
                    out.append((*at, state.hexdigest()))
                at, state = node, hashlib.sha256(text.encode())
            if out:
                yield _batch(out, [*key, "ends_sha256"], pa.string())
                out = []
        if at:
            yield _batch([(*at, state.hexdigest())], [*key, "ends_sha256"], pa.string())

    dealt = pieces.repartition(*key).sortWithinPartitions(*key, "first")
    return dealt.mapInArrow(digest, "px long, py long, depth long, ends_sha256 string")


def _batch(rows: list[tuple], names: list[str], last: pa.DataType = pa.int64()) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(c, last if i == len(names) - 1 else pa.int64()) for i, c in enumerate(columns)], names)


def rollup(nodes: DataFrame, ways: DataFrame, piece: int = PIECE) -> DataFrame:
    """node, depth, leaves, saved: the totals of both values over every node's subtree.

    Of nodes with node, depth, parent, weight, leaves and saved, and the ways of conversations: conv, depth,
    node and parent at that depth. A node's name is a conversation below it. Each round halves the weight
    of the components that are too large for a task, and is written to the shared folder."""
    none = F.lit(0).cast("long")  # no other component's top has depth 0
    state = nodes.withColumns({"top": none, "top_depth": none, "more_leaves": none, "more_saved": none})
    state = stored(state, "state")  # else the planner sees that all tops are equal, and makes no join by them
    large, done = _sorted_out(state, piece)
    if large is not None:
        ways = stored(ways, "ways")
    small = [done]
    finished = []
    while large is not None:
        step = stored(_round(large, ways), "round")
        finished.append(step.filter("finished").select("node", "depth", F.col("more_leaves").alias("leaves"), F.col("more_saved").alias("saved")))
        large, done = _sorted_out(step.filter("not finished").drop("finished"), piece)
        small.append(done)
    out = _finish(small[0])
    for part in [*map(_finish, small[1:]), *finished]:
        out = out.unionByName(part)
    return out


def _sorted_out(state: DataFrame, piece: int) -> tuple[DataFrame | None, DataFrame]:
    """Nodes of components above the size of a piece, None if there are none, and the others."""
    heavy = state.groupBy("top", "top_depth").agg(F.max("weight").alias("total")).filter(F.col("total") > piece)
    heavy = stored(heavy, "heavy")  # a row for each `piece` of the weight at most
    if heavy.isEmpty():
        return None, state
    key = ["top", "top_depth"]
    return state.join(heavy, key), state.join(heavy, key, "left_anti")


def _round(large: DataFrame, ways: DataFrame) -> DataFrame:
    """Splits every component at its centroid, which is finished."""
    key = ["top", "top_depth"]
    at = F.struct("weight", "node", "depth")
    centroids = large.filter("2 * weight > total").groupBy(*key).agg(F.min(at).alias("c"))
    centroids = stored(centroids.select(*key, F.col("c.node").alias("c"), F.col("c.depth").alias("c_depth"), F.col("c.weight").alias("c_weight")), "centroids")
    known = large.join(centroids, key)
    # On the way of a node's conversation, the edge below the centroid's depth tells whether it comes from the
    # centroid, and which of its children stands above the node.
    turn = ways.select(F.col("conv").alias("node"), F.col("depth").alias("turn"), F.col("node").alias("child"), F.col("parent").alias("above"))
    deep = known.filter("depth > c_depth").withColumn("turn", F.col("c_depth") + 1).join(turn, ["node", "turn"])
    deep = deep.withColumn("below", F.col("above") == F.col("c")).drop("turn", "above")
    level = known.filter("depth <= c_depth").withColumns({"child": F.lit(None).cast("long"), "below": F.expr("node = c and depth = c_depth")})
    split = stored(deep.unionByName(level), "split")
    totals = split.filter("below").groupBy(*key).agg(F.sum("leaves").alias("t_leaves"), F.sum("saved").alias("t_saved"))
    to_top = ways.select(F.col("conv").alias("c"), "depth", "node").join(centroids, "c").filter("depth < c_depth and depth >= top_depth")
    to_top = to_top.select("node", "depth", F.lit(True).alias("on_way"))
    step = split.join(totals, key).join(to_top, ["node", "depth"], "left")
    finished = F.expr("node = c and depth = c_depth")
    gets = F.coalesce("on_way", F.lit(False)) | finished
    moves = F.col("below") & ~finished
    return step.select(
        "node", "depth", "parent", "leaves", "saved",
        F.when(F.col("on_way"), F.col("weight") - F.col("c_weight")).otherwise(F.col("weight")).alias("weight"),
        F.when(moves, F.col("child")).otherwise(F.col("top")).alias("top"),
        F.when(moves, F.col("c_depth") + 1).otherwise(F.col("top_depth")).alias("top_depth"),
        *(F.when(gets, F.col(f"more_{v}") + F.col(f"t_{v}")).otherwise(F.col(f"more_{v}")).alias(f"more_{v}") for v in ("leaves", "saved")),
        finished.alias("finished"),
    )


def _finish(small: DataFrame) -> DataFrame:
    """The totals of components that a task can hold, one at a time."""
    key = ["top", "top_depth"]
    columns = ["node", "depth", "parent", "weight", "leaves", "saved", "more_leaves", "more_saved"]
    ordered = small.select(*key, *columns).repartition(*key).sortWithinPartitions(*key, "depth")
    names = ["node", "depth", "leaves", "saved"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, component = None, []
        for batch in batches:
            out: list[tuple] = []
            for top, top_depth, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if (top, top_depth) != at and component:
                    out += split_up(component)
                    component = []
                at = (top, top_depth)
                component.append(row)
            if out:
                yield _batch(out, names)
        if component:
            yield _batch(split_up(component), names)

    return ordered.mapInArrow(run, "node long, depth long, leaves long, saved long")


def split_up(component: list[list]) -> list[tuple[int, int, int, int]]:
    """node, depth and both totals of a component's nodes, given by columns and in order of depth."""
    place = {(row[0], row[1]): i for i, row in enumerate(component)}
    weight = [row[3] for row in component]
    children: list[list[int]] = [[] for _ in component]
    for i, row in enumerate(component[1:], 1):
        children[place[row[2], row[1] - 1]].append(i)
    totals = [[row[6], row[7]] for row in component]
    tops = [0]
    while tops:
        top = centroid = tops.pop()
        way = []
        while children[centroid]:
            heaviest = max(children[centroid], key=weight.__getitem__)
            if 2 * weight[heaviest] <= weight[top]:
                break
            way.append(centroid)
            centroid = heaviest
        leaves = saved = 0
        below = [centroid]
        while below:
            i = below.pop()
            leaves += component[i][4]
            saved += component[i][5]
            below += children[i]
        cut_off = weight[centroid]
        for i in [*way, centroid]:
            totals[i][0] += leaves
            totals[i][1] += saved
            weight[i] -= cut_off
        if way:
            children[way[-1]].remove(centroid)
            tops.append(top)
        tops += children[centroid]
        children[centroid] = []
    return [(row[0], row[1], *total) for row, total in zip(component, totals)]
