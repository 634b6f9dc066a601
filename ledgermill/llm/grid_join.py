"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors with cosine >= c lie within epsilon = sqrt(2 - 2c). The vectors are turned onto their principal axes and
sorted by grid cells on the leading ones. Intervals of the sequence are joined recursively, level by level, and a pair
of intervals whose bounding boxes are more than epsilon apart is skipped with everything in it; inside a task the
recursion goes on to small blocks. What is left is compared in double precision.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.common import in_batches, written
from ledgermill.llm.components import components, forest
from ledgermill.llm.vectors import blocks, matrix, sound

COSINE = 0.9
AXES = 8           # leading principal dimensions that order and bound
INTERVAL = 4096    # vectors that one side of a task holds
LEAF = 512         # rows compared at once inside a task
FAN = 4            # intervals that one of the next level spans
TILE = 16          # intervals on each side of a task, at most
TILE_BYTES = 32 << 20  # vectors on each side of a task, at most (one interval at least)


def units(vectors: DataFrame, **names: str) -> DataFrame:
    """``vec_id, v, ok``: sound vectors scaled to length 1 in double precision; zero vectors are not ok."""
    rows = sound(vectors, zero=False, **names)
    top = F.array_max(F.transform("v", F.abs))  # scaling first keeps squares of tiny and huge components finite
    scaled = F.transform("v", lambda x: x / top)
    length = F.sqrt(F.aggregate("s", F.lit(0.0), lambda a, x: a + x * x))
    return (rows.withColumn("s", F.when(F.col("ok"), scaled))
            .select("vec_id", F.when(F.col("ok"), F.transform("s", lambda x: x / length)).alias("v"), "ok"))


def principal_axes(classes: DataFrame, axes: int = AXES) -> dict[int, np.ndarray]:
    """For each vector width, orthonormal leading axes by the second moments of all rows.

    Tasks add up moments; one matrix of width x width per task and width reaches the driver.
    """
    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for _, data in blocks(batches, INTERVAL):
            w = data.shape[1]
            sums[w] = sums.get(w, 0) + data.T @ data
        for w, m in sums.items():
            yield pa.RecordBatch.from_pydict({
                "w": pa.array(np.full(w * w, w), pa.int32()), "i": pa.array(np.arange(w * w), pa.int32()),
                "x": pa.array(m.ravel())})

    added = (classes.select("vec_id", "v").mapInArrow(moments, "w int, i int, x double")
             .groupBy("w", "i").agg(F.sum("x").alias("x")).toPandas())
    turned = {}
    for w, part in added.groupby("w"):
        m = part.sort_values("i").x.to_numpy().reshape(w, w)
        turned[int(w)] = np.ascontiguousarray(np.linalg.eigh((m + m.T) / 2)[1][:, ::-1][:, :axes])
    return turned


def _in_grid_order(classes: DataFrame, turned: dict[int, np.ndarray], epsilon: float, axes: int) -> DataFrame:
    """The classes with their grid cells, range-partitioned and sorted by them."""
    def cells(batch: pa.RecordBatch) -> pa.RecordBatch:
        v = batch.column("v")
        widths = np.diff(v.offsets.to_numpy())
        out = np.zeros((batch.num_rows, axes), np.int64)
        for w in np.unique(widths).tolist():
            rows = np.flatnonzero(widths == w)
            p = matrix(v.take(pa.array(rows))) @ turned[w]
            out[rows, :p.shape[1]] = np.floor(p / epsilon)
        return pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("copies"), v, pa.array(widths, pa.int32()),
             pa.FixedSizeListArray.from_arrays(pa.array(out.ravel()), axes).cast(pa.list_(pa.int64()))],
            ["vec_id", "copies", "v", "w", "cell"])

    celled = classes.select("vec_id", "copies", "v").mapInArrow(
        in_batches(cells), "vec_id long, copies long, v array<double>, w int, cell array<long>")
    # a cell may hold a third of all rows: the hash splits it between ranges
    key = ["w", "cell", F.xxhash64("vec_id")]
    return celled.repartitionByRange(*key).sortWithinPartitions(*key)


def _intervals(ordered: DataFrame, turned: dict[int, np.ndarray], size: int, axes: int) -> DataFrame:
    """Intervals of the sequence: number, ids and vectors as bytes, and the bounding box on the leading axes."""
    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        base = TaskContext.get().partitionId() << 20
        for k, ((ids, copies), data) in enumerate(blocks(rows, size, ("vec_id", "copies"))):
            p = np.zeros((len(ids), axes))
            p[:, :min(axes, data.shape[1])] = data @ turned[data.shape[1]]
            yield pa.RecordBatch.from_pydict({
                "place": pa.array([base + k], pa.int64()), "w": pa.array([data.shape[1]], pa.int32()),
                "ids": pa.array([ids.astype("<i8").tobytes()], pa.binary()),
                "copies": pa.array([copies.astype("<i8").tobytes()], pa.binary()),
                "data": pa.array([data.astype("<f8").tobytes()], pa.binary()),
                "low": pa.array([p.min(0).tolist()], pa.list_(pa.float64())),
                "high": pa.array([p.max(0).tolist()], pa.list_(pa.float64()))})
    return ordered.select("vec_id", "copies", "v").mapInArrow(
        cut, "place long, w int, ids binary, copies binary, data binary, low array<double>, high array<double>")


def _near(epsilon: float) -> str:
    """SQL: the boxes (low, high) and (low2, high2) of vectors of one width come within epsilon."""
    gap = ("aggregate(zip_with(zip_with(low, high2, (x, y) -> x - y), zip_with(low2, high, (x, y) -> x - y), "
           "(x, y) -> greatest(x, y, 0D)), 0D, (s, x) -> s + x * x)")
    return f"w = w2 AND {gap} <= {epsilon ** 2 + 1e-9!r}D"


def interval_pairs(boxes: DataFrame, epsilon: float, fan: int = FAN) -> DataFrame:
    """``a, b`` (a <= b): pairs of intervals that may hold links, found by descending a tree of ever longer ones.

    ``boxes`` has ``n`` (0, 1, ... in sequence order), ``w``, ``low`` and ``high``. A pair of inner nodes that are too
    far apart ends there. Every level is an equality join on node numbers.
    """
    def at(level: int) -> DataFrame:
        node = F.floor(F.col("n") / fan ** level)
        lows = [F.min(F.col("low")[i]) for i in range(AXES)]
        highs = [F.max(F.col("high")[i]) for i in range(AXES)]
        # a node over two widths takes either: it must not be skipped
        return boxes.groupBy(node.alias("n")).agg(
            F.when(F.min("w") == F.max("w"), F.min("w")).alias("w"), F.array(*lows).alias("low"),
            F.array(*highs).alias("high"))

    count, level = boxes.count(), 0
    while fan ** level < count:
        level += 1
    pairs = boxes.sparkSession.range(1).select(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
    near = _near(epsilon).replace("w = w2", "(w = w2 OR w IS NULL OR w2 IS NULL)")
    while level > 0:
        level -= 1
        nodes = written(at(level), f"nodes-{level}")
        kids = F.sequence(F.lit(0), F.lit(fan - 1))
        down = (pairs.withColumn("i", F.explode(kids)).withColumn("j", F.explode(kids))
                .select((F.col("a") * fan + F.col("i")).alias("a"), (F.col("b") * fan + F.col("j")).alias("b"))
                .where("a <= b"))
        left = nodes.withColumnRenamed("n", "a")
        right = nodes.select(F.col("n").alias("b"), *[F.col(c).alias(f"{c}2") for c in ("w", "low", "high")])
        pairs = written(down.join(left, "a").join(right, "b").where(near).select("a", "b"), f"pairs-{level}")
    return pairs


def _join(table: pa.Table, turned: dict[int, np.ndarray], cosine: float, epsilon: float, leaf: int) -> pa.Table:
    """Links between two intervals (or within one): per vector their number, and the links shortened to a forest."""
    sides = [{c: table.column(c)[i].as_py() for c in ("n", "ids", "copies", "data")} for i in range(table.num_rows)]
    sides.sort(key=lambda s: s["n"])
    ids = [np.frombuffer(s["ids"], "<i8") for s in sides]
    copies = [np.frombuffer(s["copies"], "<i8") for s in sides]
    data = [np.frombuffer(s["data"], "<f8").reshape(len(i), -1) for s, i in zip(sides, ids, strict=True)]
    same = len(sides) == 1
    if same:
        ids, copies, data = ids * 2, copies * 2, data * 2
    boxes = []
    for x in data:
        p = x @ turned[x.shape[1]]
        cuts = range(0, len(x), leaf)
        boxes.append([(c, p[c:c + leaf].min(0), p[c:c + leaf].max(0)) for c in cuts])
    counts = [np.zeros(len(i), np.int64) for i in ids]
    trees: tuple[np.ndarray, np.ndarray] = (np.empty(0, np.int64), np.empty(0, np.int64))
    for a, low, high in boxes[0]:
        for b, low2, high2 in boxes[1]:
            if same and b < a:
                continue
            gap = np.maximum(np.maximum(low - high2, low2 - high), 0)
            if gap @ gap > epsilon ** 2 + 1e-9:
                continue
            # candidates by matrix product, decided by one fixed order of summation
            i, j = np.nonzero(data[0][a:a + leaf] @ data[1][b:b + leaf].T >= cosine - 1e-9)
            i, j = i + a, j + b
            if same:
                i, j = i[i < j], j[i < j]
            for k in range(0, len(i), 20_000):
                x, y = i[k:k + 20_000], j[k:k + 20_000]
                ok = np.einsum("ij,ij->i", data[0][x], data[1][y]) >= cosine
                x, y = x[ok], y[ok]
                np.add.at(counts[0], x, copies[1][y])
                np.add.at(counts[0 if same else 1], y, copies[0][x])
                trees = forest(np.concatenate([trees[0], ids[0][x]]), np.concatenate([trees[1], ids[1][y]]))
    parts = [(ids[0], counts[0])] if same else list(zip(ids, counts, strict=True))
    seen = [(i[c > 0], c[c > 0]) for i, c in parts]
    node = np.concatenate([*[i for i, _ in seen], trees[0]])
    links = np.concatenate([*[c for _, c in seen], np.zeros(len(trees[0]), np.int64)])
    root = np.concatenate([*[i for i, _ in seen], trees[1]])
    return pa.table({"node": pa.array(node, pa.int64()), "links": pa.array(links, pa.int64()),
                     "root": pa.array(root, pa.int64())})


def _tile(intervals: DataFrame, lanes: int) -> int:
    """Intervals on each side of a tile: as many as its bytes allow, but with two tiles for each of ``lanes`` tasks."""
    n, largest = intervals.agg(F.count(F.lit(1)), F.max(F.octet_length("data"))).first()
    tile = max(1, min(TILE, TILE_BYTES // max(1, largest or 0)))
    while tile > 1 and (k := -(-n // tile)) * (k + 1) < 4 * lanes:
        tile -= 1
    return tile


def _join_tile(table: pa.Table, turned: dict[int, np.ndarray], cosine: float, epsilon: float, leaf: int) -> pa.Table:
    """Links of all pairs of intervals that a tile has to compare, added up per vector."""
    at = {n: i for i, n in enumerate(table.column("n").to_pylist())}
    sides = table.select(["n", "ids", "copies", "data"])
    nodes, links, trees = np.empty(0, np.int64), np.empty(0, np.int64), (np.empty(0, np.int64), np.empty(0, np.int64))
    for pair in table.column("todo")[0].as_py():
        met = _join(sides.take(sorted({at[pair["a"]], at[pair["b"]]})), turned, cosine, epsilon, leaf)
        node, n, root = (met.column(c).to_numpy() for c in ("node", "links", "root"))
        nodes, back = np.unique(np.concatenate([nodes, node[n > 0]]), return_inverse=True)
        links = np.bincount(back, np.concatenate([links, n[n > 0]]), len(nodes)).astype(np.int64)
        edge = node != root
        trees = forest(np.concatenate([trees[0], node[edge]]), np.concatenate([trees[1], root[edge]]))
    return pa.table({"node": pa.array(np.concatenate([nodes, trees[0]]), pa.int64()),
                     "links": pa.array(np.concatenate([links, np.zeros(len(trees[0]), np.int64)]), pa.int64()),
                     "root": pa.array(np.concatenate([nodes, trees[1]]), pa.int64())})


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, interval: int = INTERVAL, leaf: int = LEAF,
                    **names: str) -> DataFrame:
    """``vec_id, n_links, component_id, kept``, one row per input row.

    Vectors that are null, empty, zero or hold null or non-finite components have no links and are their own
    component; so do vectors of another width among each other. Equal vectors are joined once as a class, whose
    members all link with each other and share the class's links. Tasks send counts and forests of links, never the
    links themselves; a task compares the pairs of one tile of intervals, whose sides are bounded in bytes. A row without id links with nothing; rows that share an id count as one node, and each shows
    the links of all of them.
    """
    epsilon = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    rows = written(units(vectors, **names), "units")
    good = rows.where("ok").withColumn("code", F.xxhash64("v"))
    grouped = good.groupBy("code", "v").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies"))
    classes = written(grouped, "classes")
    turned = principal_axes(classes)
    cut = written(_intervals(_in_grid_order(classes, turned, epsilon, AXES), turned, interval, AXES), "intervals")
    order = written(cut.select("place", (F.row_number().over(Window.orderBy("place")) - 1).cast("long").alias("n")),
                    "order")
    intervals = cut.join(order, "place")
    boxes = written(intervals.select("n", "w", "low", "high"), "boxes")
    pairs = interval_pairs(boxes, epsilon)
    # an interval travels once per tile of pairs, not once per pair; a tile has tile * tile pairs at most
    tile = _tile(cut, vectors.sparkSession.sparkContext.defaultParallelism)
    dealt = pairs.select(F.floor(F.col("a") / tile).alias("p"), F.floor(F.col("b") / tile).alias("q"), "a", "b")
    todo = dealt.groupBy("p", "q").agg(F.collect_list(F.struct("a", "b")).alias("todo"))
    sides = todo.select("p", "q", "todo", F.explode(F.array_distinct(F.flatten(F.transform(
        "todo", lambda x: F.array(x["a"], x["b"]))))).alias("n"))
    met = sides.join(intervals.select("n", "ids", "copies", "data"), "n").groupBy("p", "q").applyInArrow(
        lambda t: _join_tile(t, turned, cosine, epsilon, leaf), "node long, links long, root long")
    met = written(met, "met")
    return _per_vector(rows, classes, met)


def _per_vector(rows: DataFrame, classes: DataFrame, met: DataFrame) -> DataFrame:
    """Counts of links weighted by copies, components, and one row for each input row."""
    roots = components(met.where("node != root").select("node", "root"), "node", "root")
    sums = met.where("links > 0").groupBy("node").agg(F.sum("links").alias("links"))
    per_class = (classes.select(F.col("vec_id").alias("node"), "code", "v", "copies")
                 .join(sums, "node", "left").join(roots, "node", "left")
                 .select("code", "v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                         F.coalesce("root", "node").alias("component_id")))
    good = rows.where("ok").withColumn("code", F.xxhash64("v")).select("vec_id", "code", "v")
    found = good.join(per_class, ["code", "v"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("NOT ok").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                        F.col("vec_id").alias("component_id"))
    return found.unionByName(alone).select(
        "vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
