"""Merkle manifest of a table: subtrees by source, a tree over their roots, and a proof for every leaf by pointer jumping.

Leaves of a source ascend by doc_id and are numbered in ranges of (source, doc_id), so that neither a large source nor a
repeated doc_id meets in one task. Sixteen consecutive nodes, a *run*, become one node of the next level. From the first level on
every node holds a pointer to an ancestor and a segment: the siblings on its way there. A self-join hands every node the
pointer and the segment of the node it points at, which doubles the distance; after log2(height) joins all point at the root.
The leaves of a run share its segment: it is worked out once for sixteen leaves and meets them in one row.

All work is DataFrame expressions. What reaches the driver: the largest number of leaves of a source, the number of sources, the root.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import materialize, slots

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
RUN = 16
SEGMENT = "array<struct<left:string,right:string,up:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_of(**replaced: Column) -> Column:
    """Digest of a row's fields, each its UTF-8 byte count, a colon and its value, or a dash where it is null."""
    parts = []
    for name in FIELDS:
        value = replaced.get(name, F.col(name)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return digest(*parts)


def numbered(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """A written table of ``df`` with ``_part``, its range in the order of ``keys``, and ``_at``, its place there.

    Rows equal in all keys are dealt by their place in the input, so they need not share a range either.
    """
    parts = 2 * slots(df.sparkSession)
    dealt = df.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(parts, *keys, "_row")
    at = F.monotonically_increasing_id()
    placed = dealt.sortWithinPartitions(*keys, "_row").drop("_row").withColumn("_at", at)
    return materialize(placed, name).withColumn("_part", F.shiftright("_at", 33))


def bases(rows: DataFrame, group: str) -> DataFrame:
    """For each (group, range): what to add to ``_at`` to get the row's number in its group, and the rows of the group as ``n``."""
    shares = rows.groupBy(group, "_part").agg(F.min("_at").alias("_least"), F.count("*").alias("_share"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    add = F.coalesce(F.sum("_share").over(before), F.lit(0)) - F.col("_least")
    return shares.select(group, "_part", add.alias("_add"), F.sum("_share").over(whole).alias("n"))


def node(tree: Column, level: int, pos: Column) -> Column:
    return F.concat_ws(":", tree, F.lit(level), pos)


def siblings(run: Column, i: Column) -> tuple[Column, Column]:
    """Digests left and right of the member ``i`` of a run, each as one text."""
    left = F.concat_ws("", F.slice(run, F.lit(1), i))
    return left, F.concat_ws("", F.slice(run, i + 2, F.lit(RUN)))


def climb(nodes: DataFrame, level: int, most: int, name: str) -> tuple[DataFrame, DataFrame]:
    """All levels above ``nodes`` (tree, pos, id, digest, h: levels below it, n: nodes of the tree on this level), at most ``most`` of a tree.

    Returns the links of all nodes but the last of each tree (id, h, ptr, seg of one step) and these last ones (tree, id, h, digest).
    """
    links, tops = [], []
    while True:
        tops.append(nodes.where("n = 1").select("tree", "id", "h", "digest"))
        if most <= 1:
            break
        level += 1
        members = F.sort_array(F.collect_list(F.struct("pos", "id", "h", "digest")))
        runs = nodes.where("n > 1").withColumn("up", F.floor(F.col("pos") / RUN))
        runs = runs.groupBy("tree", "up").agg(members.alias("run"), (F.max("h") + 1).alias("h"), F.first("n").alias("n"))
        runs = runs.withColumns({"digests": F.col("run.digest"), "id": node(F.col("tree"), level, F.col("up"))})
        runs = materialize(runs.withColumn("digest", F.sha2(F.concat_ws("", "digests"), 256)), f"{name}-{level}")
        left, right = siblings(F.col("digests"), F.col("i"))
        step = F.array(F.struct(left.alias("left"), right.alias("right"), F.col("digest").alias("up")))
        each = runs.select(F.posexplode("run").alias("i", "member"), "digests", "digest", F.col("id").alias("ptr"))
        links.append(each.select("member.id", "member.h", "ptr", step.cast(SEGMENT).alias("seg")))
        nodes = runs.select("tree", F.col("up").alias("pos"), "id", "h", "digest", F.ceil(F.col("n") / RUN).alias("n"))
        most = -(-most // RUN)
    top = reduce(DataFrame.unionAll, tops)
    if links:
        return reduce(DataFrame.unionAll, links), top
    none = top.select("id", "h", F.col("id").alias("ptr"), F.array().cast(SEGMENT).alias("seg")).where("false")
    return none, top


def jump(links: DataFrame, root: str | None, height: int) -> DataFrame:
    """Segments of all nodes up to the node ``root``: (id, seg). ``links`` (id, h, ptr, seg) go one step.

    A pointer is null once the root is reached, so no join meets there. After a distance of d steps up to 16^d nodes point
    at one of height d or more; such a node is then repeated under enough salts to bring that down to 16^3, at most four for
    each shuffle partition. There are about 16^(d - 1) times fewer such nodes than pointers, so the copies stay few.
    """
    most = 4 * slots(links.sparkSession)
    ways = links.withColumn("ptr", F.when(F.col("ptr") != F.lit(root), F.col("ptr")))
    distance = 1
    while distance < height:
        ways = materialize(ways, f"ways-{distance}")
        salts = min(RUN ** max(0, distance - 3), most)
        copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt")
        there = ways.where(F.col("h") >= distance)
        there = there.select(F.col("id").alias("ptr"), F.col("ptr").alias("_ptr"), F.col("seg").alias("_seg"), copies)
        # Nodes that have arrived have no pointer to join on; they keep out of the join instead of meeting at null.
        here = ways.where("ptr IS NOT NULL").withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int"))
        on_way = here.join(there, ["ptr", "_salt"])
        on_way = on_way.select("id", "h", F.col("_ptr").alias("ptr"), F.concat("seg", "_seg").alias("seg"))
        ways = ways.where("ptr IS NULL").unionAll(on_way)
        distance *= 2
    return ways.select("id", "seg")


def levels(n: int) -> int:
    """Levels above ``n`` nodes."""
    found = 0
    while n > 1:
        n, found = -(-n // RUN), found + 1
    return found


def folded(start: Column, seg: Column) -> Column:
    """Root recomputed from a digest and the siblings on its way."""
    return F.aggregate(seg, start, lambda at, step: F.sha2(F.concat(step["left"], at, step["right"]), 256))


def manifest(docs: DataFrame, changed: dict[str, Column] | None = None) -> DataFrame:
    """Proof and verification of every row of ``docs`` (doc_id, source, lang, n_chars, text; other columns are ignored).

    Columns: doc_id, source, leaf, subroot, root, proof (siblings from the leaf to the root as structs left, right, up), changed_leaf (the
    leaf with the columns of ``changed`` in place of the row's own), folded_root (from it and the proof), verified (equals root).

    A null field counts as a dash; null sources form a source of their own, before all others; null doc_ids come first.
    Rows of one doc_id are ordered by their leaves, equal rows in any order, as their leaves are equal. An empty table gives no rows.
    """
    # A source is compared by its bytes; the mark keeps the null one apart from the empty one.
    key = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    leaves = docs.select(
        key.alias("_key"), "doc_id", F.col("source").cast("string").alias("source"), leaf_of().alias("leaf"), leaf_of(**(changed or {})).alias("changed_leaf")
    )
    # Written first: finding the ranges would read and digest all texts once more.
    leaves = numbered(materialize(leaves, "digests"), ["_key", "doc_id", "leaf"], "leaves")
    base = materialize(bases(leaves, "_key"), "bases")

    sources = base.groupBy("_key").agg(F.first("n").alias("n")).withColumn("_one", F.lit(0))
    sources = numbered(sources, ["_one", "_key"], "sources")
    place = bases(sources, "_one").withColumnsRenamed({"_one": "_one_", "_part": "_part_", "n": "n_trees"})
    ranked = sources.join(place, sources["_part"] == place["_part_"])
    trees = materialize(ranked.select("_key", "n", (F.col("_at") + F.col("_add")).alias("tree"), "n_trees"), "trees")
    sizes = trees.agg(F.max("n").alias("most"), F.max("n_trees").alias("trees")).first()
    most, n_trees = sizes["most"] or 0, sizes["trees"] or 0

    base = base.drop("n").join(trees, "_key")
    placed = leaves.join(base, ["_key", "_part"]).withColumn("pos", F.col("_at") + F.col("_add"))
    placed = placed.withColumn("up", F.floor(F.col("pos") / RUN))
    members = F.sort_array(F.collect_list(F.struct("pos", "doc_id", "leaf", "changed_leaf")))
    runs = placed.groupBy("tree", "up").agg(members.alias("run"), F.first("source").alias("source"), F.first("n").alias("n"))
    runs = runs.withColumns({"digests": F.col("run.leaf"), "id": node(F.col("tree"), 1, F.col("up"))})
    # A lone leaf is its source's root and is not hashed again.
    own = F.when(F.col("n") == 1, F.col("digests")[0]).otherwise(F.sha2(F.concat_ws("", "digests"), 256))
    runs = materialize(runs.withColumn("digest", own), "runs")

    flat = F.lit(0).alias("h")
    nodes = runs.select("tree", F.col("up").alias("pos"), "id", flat, "digest", F.ceil(F.col("n") / RUN).alias("n"))
    links, tops = climb(nodes, 1, -(-most // RUN), "nodes")
    subroots = tops.select(F.lit(-1).cast("long").alias("tree"), F.col("tree").alias("pos"), "id", "h", "digest", F.lit(n_trees).cast("long").alias("n"))
    above, top = climb(subroots, 1, n_trees, "subroots")
    root = top.first()  # at most one row; none for an empty table
    ways = jump(links.unionAll(above), root and root["id"], levels(-(-most // RUN)) + levels(n_trees))

    arrived = runs.join(ways, "id", "left").withColumn("seg", F.coalesce("seg", F.array().cast(SEGMENT)))
    # The levels of a source's tree above the run: 16, 16^2... runs need one more each.
    rise = F.ceil(F.col("n") / RUN)
    deep = sum((F.when(rise > RUN**i, 1).otherwise(0) for i in range(levels(-(-most // RUN)))), F.lit(0))
    arrived = arrived.withColumn("subroot", F.when(deep == 0, F.col("digest")).otherwise(F.col("seg")[deep - 1]["up"]))
    each = arrived.select(F.posexplode("run").alias("i", "member"), "source", "digests", "digest", "n", "seg", "subroot")
    each = each.withColumn("root", F.lit(root and root["digest"]).cast("string"))
    left, right = siblings(F.col("digests"), F.col("i"))
    first = F.array(F.struct(left.alias("left"), right.alias("right"), F.col("digest").alias("up"))).cast(SEGMENT)
    proof = F.when(F.col("n") == 1, F.col("seg")).otherwise(F.concat(first, "seg"))
    each = each.select("member.doc_id", "source", "member.leaf", "subroot", "root", proof.alias("proof"), "member.changed_leaf")
    each = each.withColumn("folded_root", folded(F.col("changed_leaf"), F.col("proof")))
    return each.withColumn("verified", F.col("folded_root") == F.col("root"))


def siblings_text(proof: str = "proof") -> Column:
    """All sibling digests of a proof, from the leaf to the root, as one text."""
    return F.concat_ws("", F.transform(proof, lambda step: F.concat(step["left"], step["right"])))
