"""Classes of near copies among signature sets: a prefix-filtered Jaccard join that never pairs a whole group.

Signatures have one global order, rare ones first. Sets whose Jaccard index reaches a bound share a signature
among their first few, the shorter one among fewer, and their lengths lie in the same part or in neighbouring ones:
these signatures and length parts are the cells. A signature that only one set has comes first of all and makes no cell, so that most sets of
dissimilar texts are in none. Small cells are compared pair by pair. In a large cell all members are compared with a few
hubs, which links groups of near copies; members that are still apart are filed anew by one more signature
each, which similar sets share too, so that the cells get smaller. A pair is refused within its cell where a sketch
of bits proves that its sets differ in too many signatures; every other candidate is judged by its whole sets.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import written
from .components import component_roots

LEAST = 0.8
# Cells with up to this many members outside of their largest component are compared pair by pair; others with so many
# hubs a round.
SMALL = 16
HUBS = 4
# Rounds of a cell with hubs only; in the later of LEVELS rounds its members are also filed anew by one more signature
# each. What is still apart in the last round is compared pair by pair.
HUB_ROUNDS = 2
LEVELS = 5
# Signatures that a thousandth of all sets hold, by a sample of about so many sets (by a hash), come last in the order
# without being counted; so many at most. This changes the speed only.
SAMPLE_SETS = 20_000
FREQUENT = 4_000
# Longs of a sketch, which holds the parity of a set's signatures by 64 bits each.
WORDS = 4
EPSILON = 1e-9


def length_part(size: Column, least: float) -> Column:
    """The number of the part that holds sets of this length. Sets that are alike by `least` or more
    lie in the same part or in neighbouring ones."""
    return F.when(size == 0, -2).otherwise(F.floor(F.log(size.cast("double")) / math.log(1 / least) + EPSILON))


def _frequent(sets: DataFrame, total: int) -> list[int]:
    every = max(1, total // SAMPLE_SETS)
    chosen = sets.filter(F.pmod(F.xxhash64("rid"), F.lit(every)) == 0)
    counted = chosen.select(F.explode("sig").alias("x")).groupBy("x").agg(F.count("*").alias("n"))
    many = counted.filter(F.col("n") > max(10, total // every // 1000))
    return [r["x"] for r in many.orderBy(F.desc("n"), "x").limit(FREQUENT).collect()]


def _candidates(sets: DataFrame, least: float) -> DataFrame:
    """(rid, n, prefix, short_prefix, alone, tail, sketch): the sets that can be alike with another one. The first `prefix`
    signatures of the order decide, with a longer set the first `short_prefix`; `alone` counts those that no other set has, `tail` holds the others in order."""
    sized = sets.withColumn("n", F.size("sig")).filter(F.col("n") >= least / (1 - least) - EPSILON)
    frequent = _frequent(sized, sized.count())

    def known(x):
        return x.isin(frequent) if frequent else F.lit(False)

    # One shuffle serves the counts and the join: both use the same columns of the same rows, the counts `rid` by a
    # condition that always holds.
    dealt = sized.select("rid", F.explode(F.filter("sig", lambda x: ~known(x))).alias("x")).repartition("x")
    counts = dealt.groupBy("x").agg(F.count("*").alias("df"), F.min("rid").alias("first")) \
        .filter("df > 1 and first is not null").select("x", "df")
    shared = dealt.join(counts, "x").groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("df", "x"))).alias("held"))

    def first(share):  # how many first signatures hold one of those shared with a set, if that share is
        return (F.col("n") - F.ceil(F.col("n") * F.lit(share) - EPSILON) + 1).cast("int")

    sizes = sized.select("rid", "n", first(least).alias("prefix"), first(2 * least / (1 + least)).alias("short_prefix"),
                         F.filter("sig", known).alias("often"))
    held = F.coalesce(F.transform("held", lambda h: h["x"]), F.array().cast("array<bigint>"))
    able = sizes.join(shared, "rid", "left").withColumn("tail", F.concat(held, "often")) \
        .withColumn("alone", F.col("n") - F.size("tail")).filter("prefix > alone")
    return written(able.select("rid", "n", "prefix", "short_prefix", "alone", "tail", _sketch().alias("sketch")), "spot-sets")


def _sketch() -> Column:
    """The length of a set, how many of its signatures are alone, and the parities of the others by their last bits."""
    def word(w):
        def bit(x):
            return F.when(F.shiftright(x, 6).bitwiseAND(F.lit(WORDS - 1)) == w,
                          F.call_function("shiftleft", F.lit(1).cast("long"), x.bitwiseAND(F.lit(63)).cast("int"))
                          ).otherwise(F.lit(0).cast("long"))
        return F.aggregate("tail", F.lit(0).cast("long"), lambda bits, x: bits.bitwiseXOR(bit(x)))

    return F.struct("n", "alone", *[word(w).alias(f"bits_{w}") for w in range(WORDS)])


def _may_be_alike(a: str, b: str, least: float) -> Column:
    """False only where two sketches prove an index below `least`: signatures that are alone, and unequal parities, are
    in one of the sets only."""
    n_a, n_b = F.col(f"{a}.n"), F.col(f"{b}.n")
    differing = F.col(f"{a}.alone") + F.col(f"{b}.alone")
    for w in range(WORDS):
        differing += F.bit_count(F.col(f"{a}.bits_{w}").bitwiseXOR(F.col(f"{b}.bits_{w}")))
    return (F.least(n_a, n_b) >= F.greatest(n_a, n_b) * F.lit(least) - EPSILON) & (
        differing <= (n_a + n_b) * F.lit((1 - least) / (1 + least)) + EPSILON)


def _refiled(members: DataFrame, sets: DataFrame, level: int) -> DataFrame:
    """Members filed by one more signature behind the one at `pos` (from 1). Similar sets share as many signatures as
    the level's number, and one more, among their first ones plus the level's number."""
    reach = F.when(F.col("longer"), F.col("prefix")).otherwise(F.col("short_prefix")) + level
    with_set = members.join(sets.select("rid", "tail", "prefix", "short_prefix", "alone"), "rid")
    following = F.slice("tail", F.col("pos") - F.col("alone") + 1, F.greatest(reach - F.col("pos"), F.lit(0)))
    return with_set.select("key", "rid", "longer", "pos", "sketch", F.posexplode(following).alias("i", "x")).select(
        F.xxhash64("key", "x").alias("key"), "rid", "longer", (F.col("pos") + 1 + F.col("i")).cast("int").alias("pos"), "sketch")


def _filed(sets: DataFrame, least: float) -> DataFrame:
    """(key, rid, longer, pos, sketch): every set by its first signatures and length part, as the longer one of a pair, and, by
    fewer of them, as the shorter one in its own and in the next part: more must be shared with a longer set."""
    first = sets.select("rid", "n", "alone", "short_prefix", "sketch", F.posexplode(
        F.slice("tail", F.lit(1), F.col("prefix") - F.col("alone"))).alias("i", "x")) \
        .withColumn("pos", F.col("alone") + F.col("i") + 1)
    part = length_part(F.col("n"), least)

    def place(part, longer):
        return F.struct(part.alias("part"), F.lit(longer).alias("longer"))

    as_shorter = F.when(F.col("pos") <= F.col("short_prefix"), F.array(place(part, False), place(part + 1, False)))
    places = F.concat(F.array(place(part, True)), F.coalesce(as_shorter, F.array().cast("array<struct<part:bigint,longer:boolean>>")))
    return first.select("rid", "pos", "x", "sketch", F.explode(places).alias("at")).select(
        F.xxhash64("x", "at.part").alias("key"), "rid", "at.longer", F.col("pos").cast("int").alias("pos"), "sketch")


def _alike(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose sets have an index of `least` or more. Signatures that are alone are in no intersection."""
    both = F.size(F.array_intersect("tail_a", "tail_b"))
    full = pairs.join(sets.select(F.col("rid").alias("a"), F.col("n").alias("n_a"), F.col("tail").alias("tail_a")), "a") \
        .join(sets.select(F.col("rid").alias("b"), F.col("n").alias("n_b"), F.col("tail").alias("tail_b")), "b")
    return full.filter(both >= (F.col("n_a") + F.col("n_b") - both) * F.lit(least) - EPSILON).select("a", "b")


def _open(members: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Members of the cells in which a longer and a shorter one may be apart, with their root, the cell's most frequent
    root, and how many members have another one."""
    rooted = members.withColumn("root", F.col("rid")) if roots is None else members.join(
        roots.withColumnRenamed("node", "rid"), "rid", "left").withColumn("root", F.coalesce("root", "rid"))
    shares = rooted.groupBy("key", "root").agg(F.count("*").alias("n"), F.count_if("longer").alias("longer"))
    keys = shares.groupBy("key").agg(
        F.max(F.struct("n", "root")).alias("most"), F.sum("n").alias("n"), F.sum("longer").alias("longer"), F.count("*").alias("roots"))
    keys = keys.filter("roots > 1 and longer > 0 and longer < n").select(
        "key", F.col("most.root").alias("main"), (F.col("n") - F.col("most.n")).alias("others"))
    return written(rooted.join(keys, "key"), "spot-cells")


def _pairs(cells: DataFrame, least: float) -> DataFrame:
    """Each member outside of its cell's most frequent component with all members of other components."""
    other = cells.select("key", F.col("rid").alias("b"), F.col("root").alias("root_b"), F.col("longer").alias("longer_b"),
                         F.col("sketch").alias("sketch_b"))
    return cells.filter("root != main").join(other, "key").filter("root != root_b and longer != longer_b").filter(
        _may_be_alike("sketch", "sketch_b", least)).select(F.least("rid", "b").alias("a"), F.greatest("rid", "b").alias("b"))


def _with_hubs(cells: DataFrame, hubs: DataFrame, least: float) -> DataFrame:
    hub = hubs.select("key", F.col("rid").alias("b"), F.col("root").alias("root_b"), F.col("sketch").alias("sketch_b"))
    return cells.join(hub, "key").filter("root != root_b").filter(_may_be_alike("sketch", "sketch_b", least)).select(
        F.least("rid", "b").alias("a"), F.greatest("rid", "b").alias("b"))


def similar_roots(sets: DataFrame, least: float = LEAST) -> DataFrame:
    """(node, root) as in `component_roots`, over the numbers `rid` of different sets: sets are linked whose Jaccard
    index is `least` or more. `sets` has rid and sig, a sorted array of longs without repeats.

    Sets too small to be alike without being equal are in no link.
    """
    sets = _candidates(sets, least)
    members = _filed(sets, least)
    shared = members.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1").select("key")
    members = written(members.join(shared, "key", "left_semi"), "spot-members")
    links, roots = None, None
    for level in range(1, LEVELS + 1):
        cells = _open(members, roots)
        if cells.isEmpty():
            break
        large = cells.filter(F.col("others") > SMALL) if level < LEVELS else cells.limit(0)
        place = F.row_number().over(_by_hash(level))
        hubs = written(large.withColumn("i", place).filter(F.col("i") <= HUBS).drop("i"), "spot-hubs")
        small = cells.filter(F.col("others") <= SMALL) if level < LEVELS else cells
        pairs = _pairs(small, least).unionByName(_with_hubs(large, hubs, least)).distinct()
        found = written(_alike(written(pairs, "spot-pairs"), sets, least), "spot-links")
        links = found if links is None else links.unionByName(found)
        roots = component_roots(links)
        links = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
        if level < LEVELS:
            members = large.select("key", "rid", "longer", "pos", "sketch")
            if level > HUB_ROUNDS:
                members = written(_refiled(_open(members, roots).select(*members.columns), sets, level - HUB_ROUNDS), "spot-members")
    return roots if roots is not None else component_roots(sets.select(F.col("rid").alias("a"), F.col("rid").alias("b")).limit(0))


def _by_hash(level: int):
    return Window.partitionBy("key").orderBy(F.xxhash64("rid", F.lit(level)), "rid")


def spot_classes(rows: DataFrame, least: float = LEAST) -> DataFrame:
    """(fingerprint, class_id): per fingerprint the smallest doc_id of its class; see `similar_roots`. `rows` has doc_id,
    row_no, fingerprint, a name of the signature set, and `own`, the set. A class of only null ids has a null id."""
    groups = written(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least_id"), F.min("row_no").alias("rid")),
                     "spot-groups")
    sets = rows.select(F.col("row_no").alias("rid"), F.col("own").alias("sig")).join(groups.select("rid"), "rid", "left_semi")
    roots = similar_roots(sets, least)
    named = written(groups.select("fingerprint", "least_id", "rid").join(
        roots.withColumnRenamed("node", "rid"), "rid", "left").withColumn("root", F.coalesce("root", "rid")), "spot-named")
    least_ids = named.groupBy("root").agg(F.min("least_id").alias("class_id"))
    return named.join(least_ids, "root").select("fingerprint", "class_id")
