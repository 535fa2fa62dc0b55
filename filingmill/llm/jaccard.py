"""N-gram Jaccard join by vertical partitioning.

N-grams have one global order, that of their hashes. Texts go on only if they share enough of the front of
their order with any others, and if few enough of their n-grams stand in no other text. The order is
cut into fragments; the n-grams of a text that fall into a fragment are a segment. Two sets of
similarity t differ in at most (m + n) (1 - t) / (1 + t) n-grams, so with one fragment more than that,
they have an equal segment in one of them at least: segments are shuffled as one hash each, and texts
that share some are a group. For the pairs that a group leaves to be compared, overlaps are counted in
each fragment separately and summed per pair.

Equal sets are one node from the start. Within a group that shares a segment, texts are compared with
its most central one first; those that this leaves in different components are compared with each
other only if enough of what they differ in from it is the same (`remaining`). So a group of thousands
of near copies costs its members and what some of them have changed alike, and no link is lost.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from xxhash import xxh3_64_intdigest

from filingmill.llm.common import discard, map_texts, stored, text_rows
from filingmill.llm.components import components

WORDS = 3
PERCENT = 90  # of the union, that the intersection has at least
CLASS_RATIO = 1.5  # of the set sizes that share a number of fragments
SURPLUS = 5  # percent of a set's n-grams that similar texts share at the front of the order
FRAGMENTS = 8  # in which the overlaps of a pair are counted
CUTS = 2  # rounds that drop nodes with too few keys; only the number of candidates depends on it
SMALL = 1_000_000  # keys, of 8 bytes each, up to which they are sent to every executor

_MULTIPLIERS = (2 * np.arange(1, 65, dtype=np.uint64) + 1) * np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers; different ones stay different (the finish of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Hashes, in order and each once, of the text's runs of so many words; of all its words, if fewer.

    Words are what stands between ASCII white space, in lower case as to A-Z: bytes do both."""
    found = text.encode().lower().split()
    hashes = np.fromiter(map(xxh3_64_intdigest, found), np.uint64, len(found))
    n = min(words, len(hashes))
    if not n:
        return hashes
    starts = len(hashes) - n + 1
    total = np.full(starts, n, np.uint64)
    for i in range(n):
        total += hashes[i : i + starts] * _MULTIPLIERS[i]
    return np.unique(_mixed(total))


def difference(total: int | Column, percent: int) -> int | Column:
    """The most n-grams by which sets of `total` elements together may differ (to be rounded down)."""
    return total * (100 - percent) / (100 + percent)


def class_bounds(most: int = 1 << 40) -> np.ndarray:
    bounds = [1]
    while bounds[-1] < most:
        bounds.append(max(bounds[-1] + 1, int(bounds[-1] * CLASS_RATIO)))
    return np.array(bounds)


_BOUNDS = class_bounds()


def spare(fragments: int) -> int:
    """Empty segments that a set may have among so many without its empty ones being needed."""
    return fragments // 6 + 2


def least_shared(n: int, percent: int = PERCENT) -> int:
    """How many of its keys a set of n n-grams shares with any that is similar but not equal."""
    size_class = int(np.searchsorted(_BOUNDS, n, side="right"))
    return 1 + (int(difference(2 * int(_BOUNDS[size_class] - 1), percent)) + 1) // 6


def segment_keys(grams: np.ndarray, percent: int = PERCENT) -> list[int]:
    """A hash of each segment that is needed, for the class of the set's size and for the classes of
    larger sets similar to it. Sets that are similar share `least_shared` of them, unless they must be
    equal.

    If a set and its like differ in d n-grams at most, then of any d + e + s segments, e of them empty,
    s are equal and not empty; so no more are made. More than one is asked for, as texts that have no
    more in common than a passage often share one. Only sets with more empty ones than is usual also
    give those, as only pairs of such sets need them.
    """
    n = len(grams)
    own, above = np.searchsorted(_BOUNDS, [n, n * 100 // percent], side="right")
    differ = int(difference(n + n * 100 // percent, percent))
    if not differ:
        return []
    keys: list[int] = []
    for size_class in range(int(own), int(above) + 1):
        # Fragments are those of the class; how many of them are needed, the set's size says.
        most = int(difference(2 * int(_BOUNDS[size_class] - 1), percent)) + 1
        fragments = most + spare(most) + most // 6
        needed = min(differ + 1 + spare(most) + most // 6, fragments)
        place = ((grams >> np.uint64(32)) * np.uint64(fragments)) >> np.uint64(32)
        starts = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        sums = np.zeros(fragments, np.uint64)
        sums[place[starts]] = np.add.reduceat(_mixed(grams), starts)
        names = np.arange(fragments, dtype=np.uint64) * _MULTIPLIERS[40] + _MULTIPLIERS[41:42] * np.uint64(size_class)
        full = np.zeros(fragments, bool)
        full[place[starts]] = True
        hashes = _mixed(sums + names)[:needed].view(np.int64)
        given = full[:needed] if needed - full[:needed].sum() <= spare(most) else slice(None)
        keys += hashes[given].tolist()
    return keys


def prefix(grams: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The first n-grams of the global order, of which sets that are similar but not equal share
    `least_of_prefix` at least.

    Of a set of n, similar ones have n * percent / 100 n-grams at least. What is left out of the order's
    front beyond the others, and SURPLUS of n more, therefore shares that surplus. Only texts that have as
    many in common with any others go on."""
    n = len(grams)
    if not int(difference(n + n * 100 // percent, percent)):
        return grams[:0]
    return grams[: n - -(-n * percent // 100) + -(-n * SURPLUS // 100)]


def least_of_prefix(n: int, percent: int = PERCENT) -> int:
    """The smallest set that is similar has percent of n, and its surplus is the smaller one."""
    return -(-(-(-n * percent // 100)) * SURPLUS // 100)


def _signature(grams: np.ndarray) -> int | None:
    """One number for the set: sums of hashes do not depend on how the set was come by."""
    return int(np.array([_mixed(grams + _MULTIPLIERS[50]).sum() + np.uint64(len(grams))]).view(np.int64)[0]) if len(grams) else None


def sets(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n, node (a number of the set; null if empty), its n-grams at the front of the order as keys,
    and how many of them it shares at least with a similar set."""

    def start():
        def work(keys, texts):
            grams = [shingles(t, words) for t in texts]
            return {
                "doc_id": keys,
                "n": [len(g) for g in grams],
                "node": [_signature(g) for g in grams],
                "keys": [prefix(g, percent).view(np.int64) for g in grams],
                "least": [least_of_prefix(len(g), percent) for g in grams],
            }

        return work

    return map_texts(text_rows(docs, key, text), "doc_id long, n long, node long, keys array<long>, least long", start)


def shared_keys(found: DataFrame) -> DataFrame:
    """key, node of the keys that more than one node has, of nodes with enough of them.

    The first and last node of each key are found by an aggregation that combines copies before the
    shuffle; the join with the keys that have two is split where one is hot."""
    rows = found.select("node", F.explode("keys").alias("key"))
    ends = rows.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last"))
    # Stored by itself, so that the disk never holds this shuffle and that of the join.
    keys = stored(ends.filter("first <> last").select("key"), "keys")
    shared = stored(rows.join(keys, "key").select("key", "node").distinct(), "shared")
    least = found.groupBy("node").agg(F.min("least").alias("least"))
    enough = shared.groupBy("node").agg(F.count("*").alias("n")).join(least, "node").filter("n >= least")
    found = stored(shared.join(enough.select("node"), "node", "left_semi"), "shared")
    discard(keys, shared)
    return found


def small_or_not(frame: DataFrame) -> DataFrame:
    """Keys to join with: sent to every executor if their counted number is small, else shuffled."""
    return F.broadcast(frame) if frame.count() <= SMALL else frame


def grams_of(
    docs: DataFrame, found: DataFrame, nodes: DataFrame, words: int, key: str, text: str, percent: int = PERCENT
) -> DataFrame:
    """node, fragment, grams: all FRAGMENTS segments of each node, empty ones too, from one document each.
    Beside the first of them stand the keys of the node's segments by size class, and how many of them it
    shares at least with a similar one."""
    chosen = stored(
        found.join(nodes, "node").filter("doc_id is not null").groupBy("node").agg(F.min("doc_id").alias("id")), "chosen"
    )
    texts = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    rows = texts.join(small_or_not(chosen.select("id").distinct()), "id")

    def start():
        def work(keys, texts):
            out = {"id": [], "node": [], "fragment": [], "grams": [], "keys": [], "least": []}
            for k, t in zip(keys, texts):
                grams = shingles(t, words)
                node = _signature(grams)
                cuts = np.searchsorted(grams >> np.uint64(61), np.arange(FRAGMENTS + 1)).tolist()
                for fragment, (i, j) in enumerate(zip(cuts, cuts[1:])):
                    out["id"].append(k)
                    out["node"].append(node)
                    out["fragment"].append(fragment)
                    out["grams"].append(grams[i:j].view(np.int64))
                    out["keys"].append(None if fragment else segment_keys(grams, percent))
                    out["least"].append(None if fragment else least_shared(len(grams), percent))
            return out

        return work

    schema = "id long, node long, fragment int, grams array<long>, keys array<long>, least long"
    found = map_texts(text_rows(rows, "id", "text"), schema, start)
    # An id may stand in the table twice, with the same or another text.
    if not texts.groupBy("id").count().filter("count > 1").isEmpty():
        found = found.join(chosen, ["id", "node"], "left_semi").dropDuplicates(["node", "fragment"])
    return found.drop("id")


def own_grams(segments: DataFrame) -> DataFrame:
    """node, own: how many n-grams of the node no other one has."""
    rows = segments.select("node", F.explode("grams").alias("gram"))
    single = rows.groupBy("gram").agg(F.min("node").alias("node"), F.count("*").alias("n")).filter("n = 1")
    return single.groupBy("node").agg(F.count("*").alias("own"))


def possible(n: str, own: str, m: str, other: str, percent: int) -> Column:
    """Whether sets of n and m n-grams, `own` and `other` of them nobody else's, can be similar: what
    one has for itself the other lacks, and sizes say how much more the other then has for itself."""
    n_, own_, m_, other_ = (F.col(c) for c in (n, own, m, other))
    least = F.greatest(own_ + other_, 2 * own_ - n_ + m_, 2 * other_ - m_ + n_, F.abs(n_ - m_))
    return least * (100 + percent) <= (n_ + m_) * (100 - percent)


def overlaps(pairs: DataFrame, segments: DataFrame) -> DataFrame:
    """a, b, overlap of the pairs that share an n-gram: a row for each fragment, with no more of either
    set than its segment there, has a part of the overlap, and the parts are summed by pair."""
    left = segments.select(F.col("node").alias("a"), "fragment", F.col("grams").alias("of_a"))
    right = segments.select(F.col("node").alias("b"), "fragment", F.col("grams").alias("of_b"))
    part = F.size(F.array_intersect("of_a", "of_b"))
    # So that few pairs do not have all segments of theirs shuffled twice.
    parts = left.join(small_or_not(pairs), "a").join(right, ["b", "fragment"]).select("a", "b", part.alias("part"))
    return parts.filter("part > 0").groupBy("a", "b").agg(F.sum("part").alias("overlap"))


def similar(pairs: DataFrame, segments: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Of pairs a, b those that are similar: overlaps are counted in each fragment and summed by pair."""
    ends = [pairs.select(F.col(c).alias("node")).distinct() for c in ("a", "b")]
    nodes = stored(ends[0].unionByName(ends[1]).distinct(), "nodes")
    used = segments.join(small_or_not(nodes), "node", "left_semi")
    size_a = sizes.select(F.col("node").alias("a"), F.col("n").alias("n_a"))
    size_b = sizes.select(F.col("node").alias("b"), F.col("n").alias("n_b"))
    both = overlaps(pairs, used).join(size_a, "a").join(size_b, "b")
    return both.filter(100 * F.col("overlap") >= percent * (F.col("n_a") + F.col("n_b") - F.col("overlap"))).select("a", "b")


def links(
    docs: DataFrame, found: DataFrame, words: int = WORDS, percent: int = PERCENT, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """a, b: links between nodes, enough of them that components are those of all links. The stored sets
    are not needed afterwards and are deleted, as their keys are the largest part of all that is stored."""
    shared = shared_keys(found.filter("node is not null and doc_id is not null"))
    nodes = stored(shared.select("node").distinct(), "nodes")
    ids = stored(found.select("doc_id", "node"), "ids")
    discard(shared, found)
    segments = stored(grams_of(docs, ids, nodes, words, key, text, percent), "segments")
    sizes = segments.groupBy("node").agg(F.sum(F.size("grams")).alias("n"))
    sizes = sizes.join(own_grams(segments), "node", "left").select("node", "n", F.coalesce("own", F.lit(0)).alias("own"))
    sizes = stored(sizes, "sizes")
    # Even the smallest set allowed next to it may lack only so much of what is a node's own.
    smallest = F.ceil(F.col("n") * percent / 100)
    near = 2 * F.col("own") - F.col("n") + smallest
    able = stored(sizes.filter(F.greatest("own", near) * (100 + percent) <= 2 * F.col("n") * (100 - percent)), "able")
    keyed = segments.filter("fragment = 0").join(able.select("node"), "node", "left_semi")
    able = able.join(keyed.select("node", "least"), "node")
    shared = shared_keys(keyed.select("node", "keys", "least"))
    members = stored(shared.join(able, "node"), "members")
    discard(shared)
    segments = segments.select("node", "fragment", "grams")

    # The most central member has least for itself.
    lead = members.groupBy("key").agg(F.min(F.struct("own", "node", "n")).alias("lead"))
    lead = stored(lead.select("key", F.col("lead.node").alias("b"), F.col("lead.own").alias("own_b"), F.col("lead.n").alias("n_b")), "lead")
    pairs = members.join(lead, "key").filter(F.col("node") != F.col("b"))
    pairs = stored(pairs.filter(possible("n", "own", "n_b", "own_b", percent)).select(F.col("node").alias("a"), "b").distinct(), "pairs")
    linked = stored(similar(pairs, segments, sizes, percent), "links")

    rest = remaining(members, lead, components(linked), segments, sizes, percent)
    done = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    rest = stored(rest.join(done, ["a", "b"], "left_anti"), "pairs")
    return linked.unionByName(similar(rest, segments, sizes, percent))


def remaining(
    members: DataFrame, lead: DataFrame, known: DataFrame, segments: DataFrame, sizes: DataFrame, percent: int
) -> DataFrame:
    """a, b: pairs with a common key that may be similar and are not yet in one component.

    In a group of near copies nearly all n-grams are common, so what tells its members apart is what they
    differ in from the group's lead, D. The n-grams that a and b do not share are those of one of D(a) and
    D(b), so a and b are similar only if D(a) and D(b) have at least

        (|D(a)| + |D(b)| - difference(n_a + n_b)) / 2

    n-grams in common. With what each D may share in order of rarity in the group, the first of these stands
    so early in both that as many can follow. `a` is outside the lead's component, so |D(a)| is above what similar sets
    differ in, and b must share about half of its own D: only the rarer half of D(b) is looked up. What
    the lead alone has or lacks is in every D and stands last. Members meet only at what few others have.

    The stored members and leads are deleted as soon as they are read for the last time."""
    with_component = members.select("key", "node", "least").join(known, "node", "left")
    # What is read more than once is stored, so that no shuffle is made twice; only keys and components travel.
    rows = stored(with_component.withColumn("component", F.coalesce("component", "node")), "rows")
    discard(members)
    for _ in range(CUTS):
        # Only keys with two components can be shared with another one, and of these a similar node shares
        # `least`; nodes that have fewer, such as those with a common passage, leave their keys to the others.
        parts = rows.groupBy("key").agg(F.min("component").alias("first"), F.max("component").alias("last"))
        met = stored(rows.join(parts.filter("first <> last").select("key"), "key", "left_semi"), "met")
        discard(rows)
        enough = met.groupBy("node").agg(F.count("*").alias("keys"), F.min("least").alias("least")).filter("keys >= least")
        rows = stored(met.join(enough.select("node"), "node", "left_semi"), "rows")
        discard(met)
    # A similar pair has `least` keys in common, so one of a node's leads has an even share of them.
    met = rows.join(lead.select("key", "b"), "key").groupBy("node", "component", "least", "b").agg(F.count("*").alias("keys"))
    of_node = Window.partitionBy("node")  # a row for each of its leads, of which it has no more than keys
    met = met.withColumn("leads", F.count("*").over(of_node)).filter("keys * leads >= least and node <> b").drop("keys", "leads", "least")
    of_lead = known.select(F.col("node").alias("b"), F.col("component").alias("lead_component"))
    met = met.join(of_lead, "b", "left").withColumn("outside", F.col("component") != F.coalesce("lead_component", "b"))
    # Pairs of a node and a lead have numbers, which need fewer bytes in a shuffle than two hashes.
    met = stored(met.drop("lead_component").withColumn("pair", F.monotonically_increasing_id()), "met")
    discard(rows, lead)
    # A group of which all others are in the lead's component has nothing to compare.
    compared = stored(met.join(met.filter("outside").select("b").distinct(), "b", "left_semi"), "compared")
    discard(met)

    ends = [compared.select(F.col(c).alias("node")).distinct() for c in ("node", "b")]
    nodes = stored(ends[0].unionByName(ends[1]).distinct(), "nodes")
    used = segments.join(small_or_not(nodes), "node", "left_semi")
    left = used.select("node", "fragment", F.col("grams").alias("of_node"))
    right = used.select(F.col("node").alias("b"), "fragment", F.col("grams").alias("of_b"))
    apart = F.array_union(F.array_except("of_node", "of_b"), F.array_except("of_b", "of_node"))
    differ = left.join(small_or_not(compared), "node").join(right, ["b", "fragment"])
    differ = differ.select("pair", "b", "component", "outside", F.explode(apart).alias("gram"))
    # A hash says where nodes meet, the lead and the n-gram; were two equal, some pairs more would be compared.
    differ = stored(differ.select("pair", "component", "outside", F.xxhash64("b", "gram").alias("at")), "differ")
    # A pair can share only what someone outside and another component differ in: the rest cannot be met, and
    # `after` counts what can.
    often = differ.groupBy("at").agg(
        F.count("*").alias("often"), F.min("component").alias("first"), F.max("component").alias("last"),
        F.max("outside").alias("outer"),
    )
    often = often.filter("outer and first <> last").select("at", "often")
    common = differ.select("pair", "at").join(often, "at")
    from_last = Window.partitionBy("pair").orderBy(F.desc("often"), "at")
    common = common.withColumn("after", F.row_number().over(from_last) - 1).drop("often")  # n-grams of D that follow
    # What is known of a pair joins where the rows already lie by pair.
    size = differ.groupBy("pair").agg(F.count("*").alias("d"))
    common = stored(common.join(compared.join(sizes, "node").join(size, "pair"), "pair").drop("pair", "b"), "common")
    discard(differ)

    share = (100 - percent) / (100 + percent)
    names = ["node", "n", "own", "component", "d", "after"]
    is_late = F.col("after") + 1 >= F.ceil(F.col("d") * (1 - share) / 2 - 1e-6)
    late = common.filter(is_late)
    # Both of two nodes outside meet late in their D; only those in the lead's component meet more of `a`.
    inner = late.filter(~F.col("outside")).select("at").distinct()
    meeting = late.filter("outside").unionByName(common.filter(F.col("outside") & ~is_late).join(inner, "at", "left_semi"))
    a = meeting.select("at", *(F.col(c).alias(f"{c}_a") for c in names))
    b = late.select("at", "outside", *(F.col(c).alias(f"{c}_b") for c in names))
    needed = (F.col("d_a") + F.col("d_b") - difference(F.col("n_a") + F.col("n_b"), percent)) / 2
    pairs = a.join(b, "at").filter(
        (F.col("component_a") != F.col("component_b"))
        & (~F.col("outside") | (F.col("node_a") < F.col("node_b")))
        & (F.least("after_a", "after_b") + 1 >= needed - 1e-6)
        & possible("n_a", "own_a", "n_b", "own_b", percent)
    )
    found = stored(pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct(), "pairs")
    discard(compared, nodes, common)
    return found


def similarity_join(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id: the size of every document's set, and the smallest doc_id that
    links reach, its own included.

    Documents are linked if the intersection of their sets has `percent` of the union's size. A text
    without words, or null, has no shingles and links with nothing; a row without doc_id has no
    component. Equal rows stay rows; rows that share a doc_id share its links. Sets are compared by 64-bit
    hashes: two n-grams that differ are taken for one with a chance of 1 in 2^64. An empty table gives no
    rows; other columns are ignored."""
    with_keys = stored(sets(docs, words, percent, key, text), "sets")
    found = stored(with_keys.select("doc_id", "n", "node"), "found")
    joined = components(links(docs, with_keys, words, percent, key, text))
    ids = found.filter("doc_id is not null").select("doc_id", "node").distinct()
    # A document is linked with all of its node, and nodes of a component with each other.
    groups = ids.filter("node is not null").join(joined, "node", "left").withColumn(
        "node", F.coalesce("component", "node")
    )
    least = groups.groupBy("node").agg(F.min("doc_id").alias("component_id"))
    by_id = groups.join(least, "node").groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    rows = found.select("doc_id", F.col("n").alias("n_shingles"))
    return rows.join(by_id, "doc_id", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))


def first_of_groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of a table without near duplicates: of each component the document with the smallest key.

    Rows without a key stay. Rows that share the key that stays are one if they are equal in key and
    text."""
    joined = similarity_join(docs, words, percent, key, text)
    kept = stored(joined.filter("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("rows")), "kept")
    first = docs.join(small_or_not(kept.select(F.col("doc_id").alias(key))), key, "left_semi")
    if not kept.filter("rows > 1").isEmpty():
        first = first.dropDuplicates([key, text])
    return first.unionByName(docs.filter(F.col(key).isNull())).select(docs.columns)
