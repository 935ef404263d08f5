"""Merkle manifest of a table: levels stored as parent-linked node rows, climbed by a recursive query.

The rows of a group, in order, are the leaves of a binary hash tree; the groups' roots, in order, are the leaves
of one more. Node rows are stored for every STEP-th level: each names its ancestor STEP levels above and
holds the siblings on the way there, so that no row and no task ever holds more than one small subtree. A claim (a
hash that is said to be a leaf's) is proved by a Spark SQL recursion that ascends from row to parent row, appends
the siblings and folds the claimed hash with them until no parent is left.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import numbered, prepare, written

STEP = 9  # levels between stored node rows: a subtree has 2 ** STEP members at most
TOP = -1  # the number of the tree over the groups' roots
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def row_hash(*values: Column) -> Column:
    """SHA-256 (hex) of the values one after the other: `-` for null, else UTF-8 byte count, `:`, value."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(
        F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


@dataclass
class Manifest:
    """`leaves`: row_no, the order column, leaf, tree, pos and carried columns; digests are stored as bytes. Node rows, the `lowest` (of leaves)
    and the `inner` ones: tree, round, pos, digest, n (nodes of the tree in that round), up (siblings to the
    parent: digest, left), parent_tree, parent_round, parent_pos."""

    leaves: DataFrame
    lowest: DataFrame
    inner: DataFrame
    root: str | None

    def subroots(self) -> DataFrame:
        """(tree, subroot): the root of every group's tree."""
        return self.lowest.unionByName(self.inner).filter((F.col("tree") != TOP) & (F.col("n") == 1)).select(
            "tree", _hex(F.col("digest")).alias("subroot"))


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _pairs(level: Column) -> Column:
    """The level above: each two neighbours hashed together, a last one alone."""
    halves = F.sequence(F.lit(0), F.floor((F.size(level) + 1) / 2).cast("int") - 1)
    return F.transform(halves, lambda i: F.sha2(F.concat(
        F.get(level, 2 * i), F.coalesce(F.get(level, 2 * i + 1), F.lit(""))), 256))


def _subtrees(nodes: DataFrame, round_no: int, step: int, last: bool) -> DataFrame:
    """Node rows of one round, from (tree, pos, digest, n): the members of each subtree of 2 ** step
    nodes, with their siblings up to its top, and the top's digest."""
    blocks = nodes.groupBy("tree", F.shiftright("pos", step).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "digest"))).alias("members"), F.max("n").alias("n"))
    # A tree of one subtree ends where one node is left; others go on through all levels.
    depth = F.when(F.col("n") > 1 << step, step).otherwise(
        F.when(F.col("n") > 1, F.length(F.bin(F.col("n") - 1))).otherwise(0))
    rows = blocks.withColumn("depth", depth).withColumn("l0", F.transform("members", lambda m: _hex(m["digest"])))
    for j in range(step):
        rows = rows.withColumn(f"l{j + 1}", _pairs(F.col(f"l{j}")))
    rows = rows.withColumn("top", F.get(F.array(*[F.get(f"l{j}", F.lit(0)) for j in range(step + 1)]), F.col("depth")))

    def siblings(i: Column) -> Column:
        levels = [F.struct(F.unhex(F.get(f"l{j}", F.shiftright(i, j).bitwiseXOR(F.lit(1)))).alias("digest"),
                           (F.shiftright(i, j) % 2 == 1).alias("left")) for j in range(step)]
        return F.slice(F.array(*levels), F.lit(1), F.col("depth"))

    rows = rows.select("*", F.posexplode("l0").alias("i", "digest"))
    grows, nothing = F.col("n") > 1, F.lit(None)
    finished = nothing if last else F.lit(TOP)
    return rows.select(
        "tree", F.lit(round_no).alias("round"), (F.shiftleft("block", step) + F.col("i")).alias("pos"),
        F.unhex("digest").alias("digest"), "n",
        siblings(F.col("i")).alias("up"), F.when(grows, F.col("tree")).otherwise(finished).cast("long").alias("parent_tree"),
        F.when(grows, F.lit(round_no + 1)).otherwise(nothing if last else F.lit(0)).cast("int").alias("parent_round"),
        F.when(grows, F.col("block")).otherwise(nothing if last else F.col("tree")).alias("parent_pos"),
        F.when(grows & (F.col("i") == 0), F.unhex("top")).alias("parent_digest"))


def _grow(leaves: DataFrame, step: int, last: bool) -> list[DataFrame]:
    """Node rows, one written table per round, until every tree has one node."""
    out, now = [], leaves
    while True:
        rows = written(_subtrees(now, len(out), step, last), "merkle-nodes")
        out.append(rows)
        now = rows.filter("parent_digest is not null").select(
            "tree", F.col("parent_pos").alias("pos"), F.col("parent_digest").alias("digest"),
            F.greatest(F.ceil(F.col("n") / (1 << step)), F.lit(1)).alias("n"))
        if now.isEmpty():
            return out


def build_manifest(docs: DataFrame, group: str = "lang", order: str = "doc_id", fields: tuple = FIELDS,
                   step: int = STEP, carried: dict[str, Column] | None = None) -> Manifest:
    """The trees over the rows of `docs`, hashed from `fields`.

    Groups are in the order of their values, nulls first, strings bytewise; a group's rows in the order of `order`
    (nulls first), those of equal value by their hash. Whole texts are hashed. Repeated rows are leaves of
    their own. `carried` columns of the rows go along with the leaves. An empty table has no root. Other
    columns are ignored.
    """
    prepare(docs.sparkSession)
    carried = carried or {}
    base = written(docs.select(
        F.monotonically_increasing_id().alias("row_no"), F.col(group).alias("group"), F.col(order).alias("order"),
        F.unhex(row_hash(*map(F.col, fields))).alias("leaf"), *[c.alias(name) for name, c in carried.items()]), "merkle-leaves")
    groups = base.groupBy("group").agg(F.count("*").alias("n")).withColumn("all", F.lit(0))
    trees = written(numbered(groups, "all", ["group"], "merkle-groups").select(
        F.col("group").alias("_tree_of"), F.col("pos").alias("tree"), "n"), "merkle-trees")
    placed = numbered(base, "group", ["order", "leaf", "row_no"], "merkle-order")
    leaves = written(placed.join(trees, placed["group"].eqNullSafe(trees["_tree_of"])).select(
        "row_no", F.col("order").alias(order), "leaf", "tree", "pos", "n", *carried), "merkle-places")
    nodes = _grow(leaves.select("tree", "pos", F.col("leaf").alias("digest"), "n"), step, last=False)
    ended = [r.filter("n = 1").select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("pos"), "digest")
             for r in nodes]
    tops = ended[0]
    for more in ended[1:]:
        tops = tops.unionByName(more)
    top = _grow(tops.withColumn("n", F.lit(trees.count())), step, last=True)
    upper = nodes[1:] + top
    inner = upper[0]
    for more in upper[1:]:
        inner = inner.unionByName(more)
    root = top[-1].filter("n = 1").select("digest").first()
    return Manifest(leaves, nodes[0].drop("parent_digest"), inner.drop("parent_digest"),
                    bytes(root["digest"]).hex() if root else None)


# One step: to the parent row, its siblings appended, the claimed hash folded with them as hex texts.
_STEP = """
  SELECT c.row_no, n.parent_tree AS tree, n.parent_round AS round, n.parent_pos AS pos,
    aggregate(n.up, c.folded, (h, s) -> unhex(sha2(lower(hex(
      CASE WHEN s.left THEN concat(s.digest, h) ELSE concat(h, coalesce(s.digest, X'')) END)), 256))) AS folded,
    concat(c.siblings, unhex(array_join(transform(n.up, s -> hex(s.digest)), ''))) AS siblings
  FROM {claims} c JOIN {nodes} n ON n.tree = c.tree AND n.round = c.round AND n.pos = c.pos"""
_CLIMB = f"""
WITH RECURSIVE climb AS ({_STEP.format(claims="{claims}", nodes="{lowest}")}
  UNION ALL {_STEP.format(claims="climb", nodes="{inner}")})
SELECT row_no, lower(hex(folded)) AS folded, lower(hex(siblings)) AS siblings FROM climb WHERE tree IS NULL
"""


def climb(manifest: Manifest, claims: DataFrame) -> DataFrame:
    """(row_no, folded, siblings) for each of `claims` (row_no, tree, pos, claimed as bytes): the root that the claimed
    leaf hash comes to, and the digests of its siblings from the leaf to the root, one after the other, in hex."""
    spark = prepare(claims.sparkSession)
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")  # a step has as many rows as there are claims
    views = {"claims": claims.select("row_no", "tree", F.lit(0).alias("round"), "pos", F.col("claimed").alias("folded"),
                                     F.lit(b"").alias("siblings")), "lowest": manifest.lowest, "inner": manifest.inner}
    return spark.sql(_CLIMB, **views)


def verify_documents(docs: DataFrame, step: int = STEP) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: every row's proof against a copy of the
    table in which some rows were changed (those whose id has a CRC-32 that 7 divides: n_chars + 1).

    A row with null n_chars or a null id stays as it is. See `build_manifest` for nulls, ties and repeated
    rows. An empty table gives no rows; extra columns are ignored.
    """
    changed = F.crc32(F.col("doc_id").cast("long").cast("string")) % 7 == 0
    other = row_hash(*[F.col(f) + 1 if f == "n_chars" else F.col(f) for f in FIELDS])
    manifest = build_manifest(docs, step=step, carried={
        "other": F.when(changed & F.col("n_chars").isNotNull(), F.unhex(other))})
    rows = manifest.leaves
    climbed = climb(manifest, rows.select("row_no", "tree", "pos", F.coalesce("other", "leaf").alias("claimed"))) \
        .select("row_no", F.sha2("siblings", 256).alias("proof"), "folded")
    root = F.lit(manifest.root).cast("string")
    return rows.join(climbed, "row_no").join(manifest.subroots(), "tree").select(
        F.col("doc_id").cast("long").alias("doc_id"), _hex(F.col("leaf")).alias("leaf"), "subroot",
        root.alias("root"), F.col("proof").alias("proof_sha256"), F.col("folded").alias("folded_root"),
        (F.col("folded") == root).alias("verified"))
