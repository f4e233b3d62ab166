"""Near-duplicate vectors by NN-descent, with links counted exactly over balls.

1. Equal vectors become one node. Nodes that fall into one cell of random hyperplanes are gathered into balls (a pivot, the
   nodes within a small angle): all members of a ball link with each other, so a dense group of any size is a few balls and
   its pairs are never enumerated. Rounds with other hyperplanes gather pivots again; a cell over `UNIT` is split.
2. NN-descent over the pivots: neighbour lists start from cells of further hyperplanes; each round joins the neighbours of
   every node with each other (and with its reverse neighbours) and keeps the best of each list. Lists whose last entry is
   still within the threshold are saturated: they double, up to `WIDEST`, and rounds go on around them. Pivots saturated beyond that leave the lists:
   their balls' members are compared with all vectors, in blocks, which give counts and the links that join balls.
3. An audit compares a fixed number of vectors, and of balls' pivots, with all vectors, in blocks. Recall is the mean share
   of each vector's links that was found, and counts once more for links outside the vector's own ball, so dense groups
   cannot hide lost pairs. Below the target the number of cells doubles and a further round runs; with
   `MOST_TREES` and the target not reached, the query fails.
4. Threshold edges between balls: whole balls that must link count by their sizes, balls that cannot link are dropped,
   and only members near the border between two balls are compared, exactly, in double precision.

Defined results: null, zero, empty and non-finite vectors, and vectors with null components, link with nothing and are
components of their own; vectors of different lengths don't link; repeated rows are separate vectors (they link with each
other); an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexforge.llm.common import drop, new_path, store
from lexforge.llm.components import components

COSINE = 0.9
UNIT = 1024
LIST = 8
#: Lists that are full at this length give way to the exact comparison.
WIDEST = 128
MOST_TREES = 512
#: Vectors compared with all others in one scan of them.
BLOCK = 4096
AUDIT = 256
RECALL = 0.98
#: Angles within this distance of a bound are compared exactly.
EDGE = 1e-6
#: The audit leaves out pairs this close to the threshold, where sums in another order may differ.
ROUND = 1e-12
PAIR = "u long, v long, cos double"


def _matrix(column) -> np.ndarray:
    return np.array(column.tolist(), np.float64)


def angle(cos: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cos, -1.0, 1.0))


def planes(dim: int, bits: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((bits, dim))


def cells(nodes: DataFrame, bits: int, seeds: list[int]) -> DataFrame:
    """nodes: node, x (unit vectors) and more. Adds tree and cell: the signs of random projections, one row per tree."""
    names = nodes.columns
    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema) + ", tree int, cell long"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for dim, rows in frame.groupby(frame["x"].map(len)) if len(frame) else []:
                x = _matrix(rows["x"])
                for t, seed in enumerate(seeds):
                    sign = (x @ planes(dim, bits, seed).T > 0).astype(np.int64)
                    cell = (sign << np.arange(bits)).sum(1) * 4096 + dim % 4096
                    yield rows[names].assign(tree=np.int32(t), cell=cell)

    return nodes.mapInPandas(run, shape)


def _units(rows: DataFrame) -> DataFrame:
    """Adds unit: the cell, split by a hash of the node where it holds more than UNIT nodes."""
    many, _ = store(rows.groupBy("tree", "cell").agg(F.count("*").alias("many")).where(F.col("many") > UNIT), "near-cells")
    out = rows.join(many, ["tree", "cell"], "left")
    part = F.when(F.col("many").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("node", "tree"), F.ceil(F.col("many") / UNIT)))
    return out.withColumn("unit", F.xxhash64("tree", "cell", part)).drop("many", "tree", "cell")


def _by_unit(rows: DataFrame, solve, shape: str) -> DataFrame:
    """Apply solve(frame) to every unit; units are bounded, tasks stream over the units dealt to them."""
    return rows.groupBy("unit").applyInPandas(solve, shape)


def gather_balls(balls: DataFrame, bits: int, seed: int, most: float) -> tuple[DataFrame, DataFrame]:
    """balls: node (pivot), x, radius. One gathering round: (balls that stay, moves: node, pivot)."""

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node", ignore_index=True)
        x, radius, into = _matrix(rows["x"]), rows["radius"].to_numpy().copy(), np.arange(len(rows))
        far = angle(x @ x.T)
        free = np.ones(len(rows), bool)
        for i in range(len(rows)):
            if free[i]:
                take = free & (far[i] + rows["radius"].to_numpy() + EDGE <= most)
                take[: i + 1] = False
                free[take] = False
                into[take] = i
                radius[i] = max(radius[i], (far[i] + rows["radius"].to_numpy())[take].max(initial=0.0) + EDGE * take.any())
        return rows.assign(radius=radius, pivot=rows["node"].to_numpy()[into])[["node", "x", "radius", "pivot"]]

    done, _ = store(_by_unit(_units(cells(balls, bits, [seed])), solve, "node long, x array<double>, radius double, pivot long"), "near-balls")
    return done.where("node = pivot").drop("pivot"), done.where("node <> pivot").select("node", "pivot")


def start_lists(nodes: DataFrame, bits: int, seeds: list[int], size: int) -> DataFrame:
    """u, v, cos: the best neighbours of each node within its cells."""

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        x, node = _matrix(rows["x"]), rows["node"].to_numpy()
        k = min(size, len(rows) - 1)
        if k < 1:
            return pd.DataFrame({"u": [], "v": [], "cos": []}, dtype="int64").astype({"cos": "float64"})
        cos = x @ x.T
        np.fill_diagonal(cos, -2)
        best = np.argpartition(-cos, k - 1, axis=1)[:, :k]
        at = np.repeat(np.arange(len(rows)), k)
        return pd.DataFrame({"u": node[at], "v": node[best.ravel()], "cos": cos[at, best.ravel()]})

    return _by_unit(_units(cells(nodes.select("node", "x"), bits, seeds)), solve, PAIR)


def keep_best(pairs: DataFrame, sizes: DataFrame | None, size: int) -> DataFrame:
    """The best `size` neighbours of each node (ties: smaller node first); sizes (u, size) enlarges some lists."""
    pairs = pairs.dropDuplicates(["u", "v"])
    ranked = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("u").orderBy(F.col("cos").desc(), "v")))
    if sizes is None:
        return ranked.where(F.col("rank") <= size).drop("rank")
    return ranked.join(sizes, "u", "left").where(F.col("rank") <= F.coalesce("size", F.lit(size))).select("u", "v", "cos")


def descend(lists: DataFrame, nodes: DataFrame, size: int, active: DataFrame | None = None) -> DataFrame:
    """One NN-descent round: pairs found among the neighbours (and reverse neighbours) of each node, the lists included.

    A node's reverse neighbours are the best `size` of those that list it, so a popular node gathers no unbounded group.
    active (unit): the nodes whose neighbours are joined, where only some lists can have changed.
    """
    back = keep_best(lists.select(F.col("v").alias("u"), F.col("u").alias("v"), "cos"), None, size)
    near = lists.unionByName(back).select(F.col("u").alias("unit"), F.col("v").alias("node"))
    near = near.union(lists.select("u", F.col("u").alias("node")))
    if active is not None:
        near = near.join(active, "unit", "left_semi")
    near = near.distinct().join(nodes.select("node", "x"), "node")

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        x, node = _matrix(rows["x"]), rows["node"].to_numpy()
        k = min(size, len(rows) - 1)
        if k < 1:
            return pd.DataFrame({"u": [], "v": [], "cos": []}, dtype="int64").astype({"cos": "float64"})
        cos = x @ x.T
        np.fill_diagonal(cos, -2)
        best = np.argpartition(-cos, k - 1, axis=1)[:, :k]
        at = np.repeat(np.arange(len(rows)), k)
        return pd.DataFrame({"u": node[at], "v": node[best.ravel()], "cos": cos[at, best.ravel()]})

    return lists.unionByName(_by_unit(near, solve, PAIR))


def near_links(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", cosine: float = COSINE, size: int = LIST, trees: int = 4, rounds: int = 1, target: float = RECALL) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of vectors."""
    spark = vectors.sparkSession
    limit = math.acos(cosine)
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(column).cast("array<double>").alias("raw"))
    ok = F.coalesce(F.size("raw") > 0, F.lit(False)) & ~F.exists("raw", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    norm = F.sqrt(F.aggregate("raw", F.lit(0.0), lambda s, c: s + c * c))
    rows = rows.withColumn("ok", F.coalesce(ok, F.lit(False))).withColumn("norm", F.when(F.col("ok"), norm))
    rows = rows.withColumn("x", F.when(F.col("norm") > 0, F.transform("raw", lambda c: c / F.col("norm"))))
    rows, rows_path = store(rows.select("id", "x", F.xxhash64("x").alias("h")), "near-vectors")
    same = rows.where("x IS NOT NULL").groupBy("h", "x").agg(F.min("id").alias("node"), F.count("*").alias("copies"))
    nodes, _ = store(same.select("node", "x", "h", "copies"), "near-nodes")
    total = nodes.count()
    bits = lambda n: max(1, min(40, math.ceil(math.log2(max(n, 2) / 192))))

    # 1. Balls.
    most = limit / 4
    balls = nodes.select("node", "x", F.lit(0.0).alias("radius"))
    member = nodes.select("node", F.col("node").alias("pivot"))
    left = total
    for turn in range(3):
        balls, moves = gather_balls(balls, bits(left), 1000 + turn, most)
        step = moves.select(F.col("node").alias("pivot"), F.col("pivot").alias("to"))
        member, _ = store(member.join(step, "pivot", "left").select("node", F.coalesce("to", "pivot").alias("pivot")), "near-members")
        now = balls.count()
        if now > 0.98 * left:
            left = now
            break
        left = now
    full = nodes.join(member, "node")
    weight = full.groupBy("pivot").agg(F.sum("copies").alias("weight"), F.min("node").alias("least"))
    balls, _ = store(balls.join(weight, balls.node == weight.pivot).select(balls.node, "x", "radius", "weight", "least"), "near-pivots")

    # 2. Neighbour lists, 3. audit.
    reach = math.cos(min(limit + 2 * most + EDGE, math.pi))  # pivots of balls that could hold linked members
    lists, lists_path = store(keep_best(start_lists(balls, bits(left), list(range(trees)), size), None, size), "near-lists")
    sizes, more, wide, active = None, trees, size, None
    while True:
        for _ in range(rounds):
            step, path = store(keep_best(descend(lists, balls, wide, active), sizes, size), "near-lists")
            drop(lists_path)
            lists, lists_path = step, path
        worst = lists.groupBy("u").agg(F.min("cos").alias("worst"), F.count("*").alias("held"))
        bound = F.lit(size) if sizes is None else F.coalesce("size", F.lit(size))
        worst = worst if sizes is None else worst.join(sizes, "u", "left")
        full_lists, _ = store(worst.where((F.col("worst") >= reach) & (F.col("held") >= bound)).select("u", (2 * bound).alias("size")), "near-saturated")
        grow = full_lists.where(F.col("size") <= WIDEST)
        if not grow.isEmpty():
            kept = grow if sizes is None else grow.unionByName(sizes.join(grow.select("u"), "u", "left_anti"))
            sizes, _ = store(kept, "near-sizes")
            wide = sizes.agg(F.max("size")).first()[0]
            # Only the enlarged lists can take further entries: their nodes' neighbours are where these are found.
            around = lists.join(grow.select("u"), "u", "left_semi").select(F.col("v").alias("unit"))
            active, _ = store(around.union(grow.select("u")).distinct(), "near-active")
            continue
        edges = lists.where(F.col("cos") >= reach)
        exact = None
        if not full_lists.isEmpty():
            heavy = full_lists.select("u")
            edges = edges.join(heavy, "u", "left_anti").join(heavy.withColumnRenamed("u", "v"), "v", "left_anti").select("u", "v", "cos")
            exact = exact_links(nodes, member, heavy.withColumnRenamed("u", "pivot"), cosine)
        result, parts = _count_links(rows, nodes, member, balls, edges, limit, cosine, exact)
        found = audit(rows, result, cosine)
        if found >= target:
            break
        drop(*parts)
        if more >= MOST_TREES:
            raise RuntimeError(f"recall {found:.4f} of {target} with {more} trees")
        for at in range(more, 2 * more, 8):
            extra = start_lists(balls, bits(left), list(range(at, min(at + 8, 2 * more))), size)
            step, path = store(keep_best(lists.unionByName(extra), sizes, size), "near-lists")
            drop(lists_path)
            lists, lists_path = step, path
        more *= 2
        active = None
    return result.select(F.col("id").alias(key), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def exact_links(nodes: DataFrame, member: DataFrame, heavy: DataFrame, cosine: float) -> tuple[DataFrame, DataFrame, DataFrame, list[str]]:
    """The links of all members of the balls in heavy (pivot), by comparison with every vector.

    counts: node, n (copies linked: of any vector for members, itself included; of members for other vectors); joins: u, v,
    pivots of balls with a link, enough to connect all that are linked; heavy; the stored paths. Pairs are never written: a
    task gives a row per vector, and per block a forest of its links.
    """
    spark = nodes.sparkSession
    full = nodes.join(member, "node").join(heavy.withColumn("heavy", F.lit(True)), "pivot", "left")
    full, full_path = store(full.select("node", "pivot", "x", "copies", F.coalesce("heavy", F.lit(False)).alias("heavy")), "near-full")
    blocks = math.ceil(full.where("heavy").count() / BLOCK)
    path = new_path(spark, "near-exact")
    for i in range(blocks):
        block = full.where("heavy").where(F.pmod(F.xxhash64("node"), F.lit(blocks)) == i).drop("heavy").collect()
        shared = spark.sparkContext.broadcast([(r.node, r.pivot, np.array(r.x), r.copies) for r in block])

        def run(frames: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            rows = shared.value
            node, pivot, copies = (np.array([r[k] for r in rows], np.int64) for k in (0, 1, 3))
            total, group, counts, joins = np.zeros(len(rows), np.int64), np.arange(len(rows)), [], set()
            by_dim = {dim: np.array([k for k, r in enumerate(rows) if len(r[2]) == dim]) for dim in {len(r[2]) for r in rows}}
            for frame in frames:
                for at in range(0, len(frame), 512):
                    part = frame.iloc[at : at + 512]
                    for dim, some in part.groupby(part["x"].map(len)):
                        own = by_dim.get(dim)
                        if own is None:
                            continue
                        link = _matrix(some["x"]) @ np.stack([rows[k][2] for k in own]).T >= cosine
                        total[own] += some["copies"].to_numpy() @ link
                        other = ~some["heavy"].to_numpy() & link.any(1)
                        counts += zip(some["node"].to_numpy()[other], (link[other] @ copies[own]))
                        for p, hit in zip(some["pivot"].to_numpy(), link):
                            if hit.any():
                                labels = np.unique(group[own[hit]])
                                group[np.isin(group, labels)] = labels[0]
                                joins |= {(int(p), int(pivot[k])) for k in labels}
            seen = total > 0
            counts += zip(node[seen], total[seen])
            yield pd.DataFrame([(n, k, -1, -1) for n, k in counts] + [(-1, 0, u, v) for u, v in joins], columns=["node", "n", "u", "v"], dtype="int64")

        full.mapInPandas(run, "node long, n long, u long, v long").write.mode("append").parquet(path)
        shared.unpersist()
    drop(full_path)
    found = spark.read.schema("node long, n long, u long, v long").parquet(path)
    return found.where("u = -1").groupBy("node").agg(F.sum("n").alias("n")), found.where("u <> -1 AND u <> v").select("u", "v").distinct(), heavy, [path]


def _count_links(rows: DataFrame, nodes: DataFrame, member: DataFrame, balls: DataFrame, edges: DataFrame, limit: float, cosine: float, exact: tuple | None = None) -> tuple[DataFrame, list[str]]:
    """Exact counts over the candidate pairs of balls; id, x, n_links, component_id, own (links within the ball), lead (is a pivot)."""
    both = edges.select("u", "v", "cos").union(edges.select("v", "u", "cos")).dropDuplicates(["u", "v"])
    p, q = (balls.select(F.col("node").alias(k), F.col("radius").alias(f"r_{k}"), F.col("weight").alias(f"w_{k}")) for k in "uv")
    pairs = both.join(p, "u").join(q, "v").withColumn("far", F.acos(F.least(F.col("cos"), F.lit(1.0))))
    spread = F.col("r_u") + F.col("r_v")
    whole = F.col("far") + spread + EDGE <= limit
    pairs, pairs_path = store(pairs.where(F.col("far") - spread - EDGE <= limit).withColumn("whole", whole), "near-pairs")
    base = pairs.where("whole").groupBy("u").agg(F.sum("w_v").alias("base"))

    # Balls at the border: members of u against members of v.
    full = nodes.join(member, "node")
    border = pairs.where("NOT whole").select("u", "v")
    a = full.select(F.col("pivot").alias("u"), F.col("node").alias("a"), F.col("x").alias("xa"))
    b = full.select(F.col("pivot").alias("v"), F.col("node").alias("b"), F.col("x").alias("xb"), F.col("copies").alias("cb"))
    pivot = balls.select(F.col("node").alias("v"), F.col("x").alias("xv"), "radius", "weight")
    dot = lambda s, t: F.aggregate(F.zip_with(s, t, lambda m, n: m * n), F.lit(0.0), lambda acc, z: acc + z)
    to = border.join(a, "u").join(pivot, "v").withColumn("far", F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot("xa", "xv")))))
    to = to.where(F.col("far") - F.col("radius") - EDGE <= limit).withColumn("all", F.col("far") + F.col("radius") + EDGE <= limit)
    sure = to.where("all").select("u", "v", "a", F.col("weight").alias("n"))
    close = to.where("NOT all").select("u", "v", "a", "xa").join(b, "v").where(dot("xa", "xb") >= cosine).select("u", "v", "a", F.col("cb").alias("n"))
    partial, partial_path = store(sure.unionByName(close).groupBy("u", "v", "a").agg(F.sum("n").alias("n")), "near-border")
    own = partial.groupBy("a").agg(F.sum("n").alias("extra"))

    links = pairs.where("whole").select("u", "v").unionByName(partial.select("u", "v"))
    labels, labels_path = components(links if exact is None else links.unionByName(exact[1]))
    of = balls.select("node", "weight", "least").join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = of.groupBy("root").agg(F.min("least").alias("component"))
    of = of.join(least, "root").join(base.withColumnRenamed("u", "node"), "node", "left").select(F.col("node").alias("pivot"), "component", (F.col("weight") - 1).alias("own"), (F.col("weight") - 1 + F.coalesce("base", F.lit(0))).alias("sure"))
    of = nodes.join(member, "node").join(of, "pivot").join(own.withColumnRenamed("a", "node"), "node", "left")
    links = F.col("sure") + F.coalesce("extra", F.lit(0))
    if exact is not None:
        of = of.join(exact[0], "node", "left").join(exact[2].withColumn("heavy", F.lit(True)), "pivot", "left")
        links = F.when(F.col("heavy"), F.col("n") - 1).otherwise(links + F.coalesce("n", F.lit(0)))
    of = of.select(F.col("h").alias("oh"), F.col("x").alias("ox"), "component", "own", F.when(F.col("node") == F.col("pivot"), F.col("node")).alias("lead"), links.alias("links"))
    out = rows.join(of, (rows.h == of.oh) & (rows.x == of.ox), "left")
    out = out.select("id", "x", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "id").alias("component_id"), "own", F.col("id").eqNullSafe(F.col("lead")).alias("lead"))
    done, path = store(out, "near-result")
    drop(pairs_path, partial_path, labels_path, *([] if exact is None else exact[3]))
    return done, [path]


def audit(rows: DataFrame, result: DataFrame, cosine: float, queries: int = AUDIT) -> float:
    """Recall: the links found for a fixed number of vectors (lowest hashes) against all their links, counted in blocks.

    The least of three means over vectors: of all links, of links outside the own ball, and of the latter for vectors that
    are drawn as pivots, one a ball, so a ball counts once whatever its size.
    """
    draw = lambda of: of.orderBy(F.xxhash64("id"), "id").limit(queries).select("id", "x", "n_links", "own").collect()
    known = result.where("x IS NOT NULL")
    some, leads = draw(known), draw(known.where("lead"))
    asked = some + leads
    if not asked:
        return 1.0
    shared = rows.sparkSession.sparkContext.broadcast([np.array(r.x) for r in asked])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(len(shared.value), np.int64)
        for frame in frames:
            x = frame["x"]
            for dim, part in x.groupby(x.map(len)) if len(x) else []:
                at = [i for i, q in enumerate(shared.value) if len(q) == dim]
                if at:
                    counts[at] += (np.stack([shared.value[i] for i in at]) @ _matrix(part).T >= cosine + ROUND).sum(1)
        yield pd.DataFrame({"i": np.arange(len(counts)), "n": counts})

    sums = rows.where("x IS NOT NULL").select("x").mapInPandas(run, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect()
    true = {r.i: r.n - 1 for r in sums}

    def mean(of: range, outside: bool) -> float:
        pairs = [(asked[i].n_links - outside * asked[i].own, true[i] - outside * asked[i].own) for i in of]
        return float(np.mean([min(1.0, found / links) for found, links in pairs if links > 0] or [1.0]))

    return min(mean(range(len(some)), False), mean(range(len(some)), True), mean(range(len(some), len(asked)), True))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_links(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
