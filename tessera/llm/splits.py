"""Splits that keep related records together.

Groups are the components of a graph of ties. Each round every component picks its lightest edge to another one
(Borůvka); the picked edges go to the spanning forest, written to the shared folder, and components contract along them. The
roots are then stratified by the size band of their group and dealt systematically to the splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import cut, shuffle_partitions

#: A group of more than this share of all rows is placed by itself, largest first: at most 1 / LARGE groups.
LARGE = 0.005


def _jump(parents: DataFrame) -> DataFrame:
    """Every component's root: pointers are doubled until none moves."""
    while True:
        up = parents.select(F.col("comp").alias("parent"), F.col("parent").alias("above"))
        parents = cut(parents.join(up, "parent").select("comp", F.col("above").alias("parent"), (F.col("above") != F.col("parent")).alias("moved")))
        if parents.where("moved").isEmpty():
            return parents.select("comp", "parent")


def spanning_forest(edges: DataFrame, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Labels ``node, root`` (the smallest node of the component) and the forest ``u, v`` of a graph with edges ``u, v``.

    Edges have no direction; loops and edges with a null end tie nothing, but a loop's node is labelled; repeated edges count
    once. An empty table gives two empty ones. path: the forest is kept there as a Parquet table, whose rounds are appended as they are found.
    """
    known = edges.where("u IS NOT NULL AND v IS NOT NULL").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    known = cut(known)
    labels = cut(known.select(F.explode(F.array("u", "v")).alias("node")).distinct().select("node", F.col("node").alias("comp")))
    # a hash as weight makes weights differ and paths of picked edges short; u, v settle equal hashes
    left = cut(known.where("u <> v").select(F.col("u").alias("cu"), F.col("v").alias("cv"), F.struct(F.xxhash64("u", "v").alias("w"), "u", "v").alias("edge")))
    forests: list[DataFrame] = []
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("cv").alias("cu"), F.col("cu").alias("cv"), "edge"))
        picked = cut(both.groupBy("cu").agg(F.min(F.struct("edge", "cv")).alias("best")).select(F.col("cu").alias("comp"), F.col("best.cv").alias("parent"), F.col("best.edge.u").alias("u"), F.col("best.edge.v").alias("v")))
        forests.append(picked.select("u", "v").distinct())
        if path:
            forests[-1].write.mode("append" if len(forests) > 1 else "overwrite").parquet(path)
        # two components that picked the same edge point at each other: the smaller one becomes a root
        back = picked.select(F.col("comp").alias("parent"), F.col("parent").alias("above"))
        rooted = picked.join(back, "parent").select("comp", F.when((F.col("above") == F.col("comp")) & (F.col("comp") < F.col("parent")), F.col("comp")).otherwise(F.col("parent")).alias("parent"))
        roots = _jump(cut(rooted))
        labels = cut(labels.join(roots, "comp", "left").select("node", F.coalesce("parent", "comp").alias("comp")))
        end = lambda c: roots.select(F.col("comp").alias(c), F.col("parent").alias(f"r{c}"))
        moved = left.join(end("cu"), "cu").join(end("cv"), "cv").where("rcu <> rcv")
        left = cut(moved.groupBy(F.least("rcu", "rcv").alias("cu"), F.greatest("rcu", "rcv").alias("cv")).agg(F.min("edge").alias("edge")))
    forest = forests[0] if forests else known.limit(0)
    for part in forests[1:]:
        forest = forest.unionByName(part)
    if path:
        if not forests:
            forest.write.mode("overwrite").parquet(path)
        forest = edges.sparkSession.read.parquet(path)
    smallest = labels.groupBy("comp").agg(F.min("node").alias("root"))
    return labels.join(smallest, "comp").select("node", "root"), forest


def _choose(x: Column, shares: list[tuple[str, float]]) -> Column:
    """The split whose part of [0, 1) holds x."""
    total = sum(s for _, s in shares)
    out, upper = None, 0.0
    for name, share in shares[:-1]:
        upper += share / total
        out = F.when(x < upper, F.lit(name)) if out is None else out.when(x < upper, F.lit(name))
    return F.lit(shares[-1][0]) if out is None else out.otherwise(F.lit(shares[-1][0]))


def deal(groups: DataFrame, targets: list[tuple[str, float]], large: float = LARGE) -> DataFrame:
    """``group, split`` for ``group, size``: whole groups to splits, so that the sums of sizes come close to the target shares.

    Groups of more than ``large`` of the total go one by one to the split that lacks most. The others are numbered in the order
    of a hash within bands of size (powers of two) and dealt by a sequence that fills every part of [0, 1) evenly, against what the
    splits still lack. Shares are taken relative to their sum; an empty table gives an empty one.
    """
    spark = groups.sparkSession
    total = groups.agg(F.sum("size")).first()[0] or 0
    scale = sum(s for _, s in targets)
    lack = {name: share / scale * total for name, share in targets}
    big = groups.where(F.col("size") > large * total).orderBy(F.desc("size"), "group").collect()  # fewer than 1 / large rows
    placed = []
    for group, size in ((r["group"], r["size"]) for r in big):
        name = max(lack, key=lambda k: (lack[k], k))
        lack[name] -= size
        placed.append((group, name))
    rest = [(name, max(0.0, left)) for name, left in lack.items()]
    if not sum(x for _, x in rest):
        rest = targets
    band = F.floor(F.log2(F.greatest(F.col("size"), F.lit(1)))).cast("int").alias("band")
    small = groups.where(F.col("size") <= large * total).select("group", band, F.xxhash64("group", F.lit("deal")).alias("turn"))
    ranged = cut(small.repartitionByRange(shuffle_partitions(spark), "band", "turn").withColumn("part", F.spark_partition_id()))
    # places within a band over all partitions: places within the partition and the counts of those before
    counts = ranged.groupBy("band", "part").agg(F.count("*").alias("n")).collect()  # partitions times bands
    before, seen = [], {}
    for r in sorted(counts, key=lambda r: (r["band"], r["part"])):
        before.append((r["band"], r["part"], seen.get(r["band"], 0)))
        seen[r["band"]] = seen.get(r["band"], 0) + r["n"]
    if not before:
        dealt = groups.limit(0).select("group", F.lit("").alias("split"))
    else:
        offsets = F.broadcast(spark.createDataFrame(before, "band int, part int, before long"))
        place = F.row_number().over(Window.partitionBy("band", "part").orderBy("turn", "group"))
        x = (F.col("place") + F.col("before") - 0.5) * F.lit(0.6180339887498949) + F.col("band") * F.lit(0.7548776662466927)
        dealt = ranged.withColumn("place", place).join(offsets, ["band", "part"]).select("group", _choose(x - F.floor(x), rest).alias("split"))
    if not placed:
        return dealt
    kind = groups.schema["group"].dataType.simpleString()
    return dealt.unionByName(spark.createDataFrame(placed, f"group {kind}, split string"))


def grouped_splits(rows: DataFrame, key: str, ties: DataFrame, targets: list[tuple[str, float]], forest: str | None = None) -> DataFrame:
    """``rows`` with ``group_key`` and ``split``: rows whose integer ``key`` is the same or tied by an edge ``u, v`` of ``ties``, directly or through others, get one split.

    forest: where the spanning forest is kept, so that later rows can be tied to it. A row with a null key is a group of its own. Repeated rows stay. Columns of ``rows`` named ``group_key`` or ``split`` are replaced;
    an empty table gives an empty one.
    """
    labels = cut(spanning_forest(ties.select(F.col("u").cast("bigint"), F.col("v").cast("bigint")), forest)[0].withColumnsRenamed({"node": "_key", "root": "_root"}))
    # rows without a key are numbered below zero, each its own group
    marked = cut(rows.drop("group_key", "split").withColumn("_key", F.col(key).cast("bigint")).withColumn("_alone", F.monotonically_increasing_id()))
    own = F.when(F.col("_key").isNull(), F.concat(F.lit("alone "), F.col("_alone").cast("string"))).otherwise(F.coalesce("_root", "_key").cast("string"))
    found = marked.join(labels, "_key", "left").withColumn("group_key", own).drop("_key", "_alone", "_root")
    sizes = cut(found.groupBy(F.col("group_key").alias("group")).agg(F.count("*").alias("size")))
    return found.join(deal(sizes, targets).withColumnRenamed("group", "group_key"), "group_key")
