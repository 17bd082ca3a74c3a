"""Exact nearest neighbours: leaves of a tree of boxes, joined by key and measured in NumPy."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from namesieve.operators.ranking import shuffle_key
from namesieve.plans.storage import written

DIGITS = 9  # distances that agree to this digit are ties
SLACK = 1e-8

#: Points of a leaf that are aimed at, the most leaves, and the points that place the cuts between them, for each leaf.
LEAF_POINTS, MOST_LEAVES, SAMPLE_POINTS = 512, 4096, 8
#: Queries of a leaf in one task, and distances measured at a time.
TILE_QUERIES, TILE_CELLS = 1 << 14, 1 << 20

#: A tree of cuts: for each inner node the slot, the value, and the nodes below and above it; leaves are -1 - number.
Tree = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def cuts(sample: np.ndarray, leaves: int) -> Tree:
    """Cuts that deal ``sample`` into about ``leaves`` leaves: halves along the widest slot, between two different values."""
    nodes: list[list[float]] = []
    found = 0

    def cut(rows: np.ndarray, wanted: int) -> int:
        nonlocal found
        spread = rows.max(axis=0) - rows.min(axis=0) if wanted > 1 and len(rows) > 1 else np.zeros(1)
        slot = int(spread.argmax())
        if not spread[slot] > 0:
            found += 1
            return -found
        values = np.unique(rows[:, slot])
        middle = min(max(int(np.searchsorted(values, np.median(rows[:, slot]))), 1), len(values) - 1)
        here, value = len(nodes), values[middle]
        nodes.append([slot, value, 0, 0])
        above = rows[:, slot] >= value
        share = min(max(round(wanted * float(above.mean())), 1), wanted - 1)
        nodes[here][2] = cut(rows[~above], wanted - share)
        nodes[here][3] = cut(rows[above], share)
        return here

    cut(sample, leaves)
    slot, value, low, high = (np.array([n[k] for n in nodes]) for k in range(4))
    return slot.astype(np.int64), value.astype(float), low.astype(np.int64), high.astype(np.int64)


def leaf_of(rows: np.ndarray, tree: Tree) -> np.ndarray:
    """Number of the leaf of each row."""
    slot, value, low, high = tree
    at = np.full(len(rows), 0 if len(slot) else -1, dtype=np.int64)
    inner = np.flatnonzero(at >= 0)
    while len(inner):
        node = at[inner]
        at[inner] = np.where(rows[inner, slot[node]] >= value[node], high[node], low[node])
        inner = inner[at[inner] >= 0]
    return -1 - at


def _matrix(vectors: pa.Array | pa.ChunkedArray, size: int) -> np.ndarray:
    flat = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    return np.asarray(flat.flatten(), dtype=float).reshape(len(flat), size)


def _placed(rows: DataFrame, tree: Tree, size: int) -> DataFrame:
    """``rows`` with the ``leaf`` of their ``vector``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = leaf_of(_matrix(batch.column("vector"), size), tree)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf.astype(np.int32))], names=[*batch.schema.names, "leaf"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("leaf", T.IntegerType())]))


def _squares(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Squared distances of all pairs of rows, added up slot by slot."""
    total = np.zeros((len(left), len(right)))
    for slot in range(left.shape[1]):
        gap = left[:, slot, None] - right[None, :, slot]
        gap *= gap
        total += gap
    return total


def _to_boxes(rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances of rows to boxes."""
    total = np.zeros((len(rows), len(low)))
    for slot in range(rows.shape[1]):
        at = rows[:, slot, None]
        gap = np.maximum(np.maximum(low[None, :, slot] - at, at - high[None, :, slot]), 0)
        gap *= gap
        total += gap
    return total


def _nearest(queries: np.ndarray, points: np.ndarray, members: np.ndarray, rank: np.ndarray, k: int, bound: np.ndarray):
    """Pairs that can be among the k nearest: query, member, distance; and each query's bound for its k-th neighbour.

    ``members``: the point of each member, ascending; ``rank``: its place in the order of ids.
    """
    held = np.bincount(members, minlength=len(points))
    first = np.cumsum(held) - held
    found, bound = [], bound.copy()
    step = max(1, TILE_CELLS // max(1, len(points)))
    for i in range(0, len(queries), step):
        away = np.sqrt(_squares(queries[i : i + step], points))
        own = bound[i : i + step]
        if len(points) >= k:
            np.minimum(own, np.partition(away, k - 1, axis=1)[:, k - 1] + SLACK, out=own)
        elif held.sum() >= k:
            np.minimum(own, away.max(axis=1, initial=0) + SLACK, out=own)
        query, point = np.nonzero(away <= own[:, None])
        distance, n = away[query, point], held[point]
        member = np.arange(int(n.sum())) + np.repeat(first[point] - (np.cumsum(n) - n), n)
        query, distance = np.repeat(query, n), np.repeat(distance, n)
        # Of equal distances only the k smallest ids can count; the others are no more than slack and bound let through.
        order = np.lexsort((rank[member], distance, query))
        query, distance, member = query[order], distance[order], member[order]
        new = np.r_[True, (query[1:] != query[:-1]) | (distance[1:] != distance[:-1])][: len(query)]
        start = np.flatnonzero(new)
        kept = np.arange(len(query)) - start[np.cumsum(new) - 1] < k if len(query) else np.zeros(0, dtype=bool)
        found.append((query[kept] + i, member[kept], distance[kept]))
    query, member, distance = (np.concatenate(x) for x in zip(*found))
    return query, member, distance, bound


def neighbours(train: DataFrame, queries: DataFrame, k: int, cells: int | None = None, seed: int = 42) -> DataFrame:
    """The k training rows nearest to each query: ``query_id, distance, id, label, rank``; ties by id.

    Input: ``train(id, label, vector)`` and ``queries(query_id, vector)`` with arrays of doubles of one length.

    Equal training vectors are one point with their k smallest ids, which is all that any query can need. A tree of cuts deals
    points and queries into ``cells`` leaves; a bounded sample places the cuts, whose place changes only the speed. The box
    of a leaf is the exact range of all of its points. A query is measured against its own leaf, which bounds its k-th
    neighbour, and then against each leaf whose box is no farther than that. Queries of a leaf are dealt to several tasks
    where there are many; a task holds one leaf's points. Nothing is approximated.
    """
    per_point = (
        train.selectExpr("id", "label", "vector", "row_number() OVER (PARTITION BY vector ORDER BY id) AS _copy")
        .where(f"_copy <= {k}")
        .groupBy("vector")
        .agg(F.expr("array_sort(collect_list(struct(id, label))) AS members"))  # at most k entries
    )
    per_point = written(per_point, "training-points")
    shape = per_point.agg(F.expr("count(*) AS n"), F.expr("max(size(vector)) AS size")).first()
    size = shape["size"] or 0
    types = {f.name: f.dataType for f in train.schema.fields} | {"query_id": queries.schema["query_id"].dataType}
    found = [T.StructField("query_id", types["query_id"]), T.StructField("distance", T.DoubleType()), T.StructField("id", types["id"])]
    found.append(T.StructField("label", types["label"]))
    if not shape["n"]:
        return train.sparkSession.createDataFrame([], T.StructType([*found, T.StructField("rank", T.IntegerType())]))
    leaves = min(MOST_LEAVES, max(1, math.ceil(shape["n"] / LEAF_POINTS))) if cells is None else cells
    # At most 32,768 vectors unless more cells are asked for.
    sample = per_point.orderBy(shuffle_key(seed, F.col("vector")), "vector").limit(SAMPLE_POINTS * leaves).select("vector").toArrow()
    tree = cuts(_matrix(sample["vector"], size), leaves)
    points = written(_placed(per_point, tree, size), "placed-points")

    def box(part: pa.Table) -> pa.Table:
        rows = _matrix(part["vector"], size)
        ends = [pa.array([x.tolist()], pa.list_(pa.float64())) for x in (rows.min(axis=0), rows.max(axis=0))]
        return pa.table([part["leaf"][:1], *ends], names=["leaf", "low", "high"])

    boxes = points.select("leaf", "vector").groupBy("leaf").applyInArrow(box, "leaf int, low array<double>, high array<double>").toArrow()
    box_leaf = np.asarray(boxes["leaf"])
    low, high = (_matrix(boxes[c], size) for c in ("low", "high"))

    def dealt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """``rows`` with the part of their leaf, and the points once for each part."""
        parts = written(rows.groupBy("leaf").agg(F.expr(f"CAST(ceil(count(*) / {TILE_QUERIES}) AS INT) AS parts")), "leaf-parts")  # a row per leaf
        each = rows.join(F.broadcast(parts), "leaf").withColumn("part", F.expr("CAST(pmod(xxhash64(query_id), parts) AS INT)")).drop("parts")
        return each, points.join(F.broadcast(parts), "leaf").selectExpr("*", "explode(sequence(0, parts - 1)) AS part").drop("parts")

    asks = [T.StructField("query", T.ArrayType(T.DoubleType())), T.StructField("leaf", T.IntegerType()), T.StructField("bound", T.DoubleType())]
    result = T.StructType([*found, *asks])

    def measured(asked: pa.Table, held: pa.Table, ask: bool) -> pa.Table:
        """Neighbours among the points of a leaf and, if ``ask``, a row for each other leaf that can have nearer ones."""
        kinds = asked.schema.field("query_id").type
        members = held["members"].combine_chunks() if held.num_rows else pa.array([], held.schema.field("members").type)
        entries = members.flatten()
        ids = entries.field("id") if len(entries) else pa.array([], entries.type.field("id").type)
        labels = entries.field("label") if len(entries) else pa.array([], entries.type.field("label").type)
        rank = np.empty(len(ids), dtype=np.int64)
        rank[np.asarray(pc.sort_indices(ids, null_placement="at_start"))] = np.arange(len(ids))
        owner = np.asarray(pc.list_parent_indices(members))
        rows, bound = _matrix(asked["query"], size), np.asarray(asked["bound"], dtype=float)
        if not asked.num_rows:
            query = member = np.zeros(0, dtype=np.int64)
            distance = np.zeros(0)
        else:
            query, member, distance, bound = _nearest(rows, _matrix(held["vector"], size), owner, rank, k, bound)
        n = len(query)
        query_id, vector = asked["query_id"].combine_chunks(), asked["query"].combine_chunks()
        if not asked.num_rows:
            query_id, vector = pa.array([], kinds), pa.array([], pa.list_(pa.float64()))
        out = [
            [query_id.take(pa.array(query)), pa.array(distance), ids.take(pa.array(member)), labels.take(pa.array(member))],
            [pa.nulls(n, vector.type), pa.nulls(n, pa.int32()), pa.nulls(n, pa.float64())],
        ]
        tables = [pa.table(out[0] + out[1], names=result.names)]
        if ask and asked.num_rows:
            here = asked["leaf"][0].as_py()
            near = np.flatnonzero((_box_gaps(rows, low, high) <= bound.max() ** 2) & (box_leaf != here))
            step = max(1, TILE_CELLS // max(1, len(near)))
            for i in range(0, len(rows), step):
                who, which = np.nonzero(np.sqrt(_to_boxes(rows[i : i + step], low[near], high[near])) <= bound[i : i + step, None])
                who, m = pa.array(who + i), len(who)
                empty = [pa.nulls(m, pa.float64()), pa.nulls(m, ids.type), pa.nulls(m, labels.type)]
                wanted = [vector.take(who), pa.array(box_leaf[near][which].astype(np.int32)), pa.array(bound).take(who)]
                tables.append(pa.table([query_id.take(who), *empty, *wanted], names=result.names))
        return pa.concat_tables(tables)

    def joined(rows: DataFrame, ask: bool) -> DataFrame:
        each, held = dealt(rows)
        return each.groupBy("leaf", "part").cogroup(held.groupBy("leaf", "part")).applyInArrow(lambda q, p: measured(q, p, ask), result)

    asked = queries.where("query_id IS NOT NULL").select("query_id", "vector")
    asked = _placed(asked, tree, size).selectExpr("query_id", "vector AS query", "leaf", "CAST('Infinity' AS DOUBLE) AS bound")
    first = written(joined(written(asked, "placed-queries"), True), "own-leaves")
    again = joined(first.where("leaf IS NOT NULL").select("query_id", "query", "leaf", "bound"), False)
    found = first.where("leaf IS NULL").unionByName(again).selectExpr("query_id", f"round(distance, {DIGITS}) AS distance", "id", "label")
    return found.selectExpr("*", "row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank").where(f"rank <= {k}")


def _box_gaps(rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances between the box of ``rows`` and other boxes."""
    gap = np.maximum(np.maximum(low - rows.max(axis=0), rows.min(axis=0) - high), 0)
    return (gap * gap).sum(axis=1)


def vote(found: DataFrame) -> DataFrame:
    """Share of positive neighbours per query, and the majority class."""
    share = found.groupBy("query_id").agg(F.expr("avg(CAST(label AS DOUBLE)) AS y_score"))
    return share.selectExpr("query_id", "y_score", "CAST(y_score > 0.5 AS INT) AS y_pred")
