"""Near-duplicate vectors by an epsilon grid order join.

Vectors of a label are turned to their principal axes and sorted by the cells, of edge
epsilon, of the leading coordinates. Runs of the sorted sequence are blocks. Two blocks
are joined only if their boxes in the leading coordinates come within epsilon; a joined
pair is cut in halves again and again, and every pair of intervals whose boxes are farther
apart is skipped, down to small intervals that are compared by a matrix product. Equal
vectors are one from the start. A task returns counts per vector and the links of a
spanning forest, never all pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.components import connected_components
from kindred.llm.vectors import matrix, packed, usable
from kindred.operators.skew import join_per_key
from kindred.session import materialise

#: Vectors of a block and of the intervals that are compared at once.
BLOCK, LEAF = 1024, 64
#: Leading coordinates that order the sequence, and those that bound boxes.
ORDER_AXES, BOX_AXES = 4, 12


def _unit(vectors: np.ndarray) -> np.ndarray:
    # scaled first, so that neither very small nor very large components lose the norm
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors**2).sum(axis=1, keepdims=True))


def _axes(rows: DataFrame) -> dict[int, np.ndarray]:
    """Per dimension the principal axes, leading first; sums come from every vector."""

    def task(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column(0).to_numpy()
            for dim in np.unique(dims).tolist():
                units = _unit(matrix(batch.filter(pa.array(dims == dim)).column(1), dim))
                own = np.concatenate([[len(units)], units.sum(axis=0), (units.T @ units).ravel()])
                sums[dim] = sums.get(dim, 0) + own
        yield pa.record_batch({
            "dim": pa.array(list(sums), pa.int32()),
            "sums": pa.array([own.tolist() for own in sums.values()], pa.list_(pa.float64())),
        })

    totals: dict[int, np.ndarray] = {}
    # one row per task and dimension
    for row in rows.select("dim", "packed").mapInArrow(task, "dim int, sums array<double>").collect():
        totals[row["dim"]] = totals.get(row["dim"], 0) + np.array(row["sums"])
    axes = {}
    for dim, sums in totals.items():
        count, mean = sums[0], sums[1 : dim + 1] / sums[0]
        spread = sums[dim + 1 :].reshape(dim, dim) / count - np.outer(mean, mean)
        axes[dim] = np.linalg.eigh(spread)[1][:, ::-1][:, :BOX_AXES]
    return axes


def _boxes(points: np.ndarray) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
    """Lowest and highest coordinates of every interval that halving can reach."""
    boxes = {}

    def visit(a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        if b - a <= LEAF:
            box = points[a:b].min(axis=0), points[a:b].max(axis=0)
        else:
            left, right = visit(a, (a + b) // 2), visit((a + b) // 2, b)
            box = np.minimum(left[0], right[0]), np.maximum(left[1], right[1])
        boxes[a, b] = box
        return box

    if len(points):
        visit(0, len(points))
    return boxes


class _Forest:
    """Union-find over the vectors of a pair of blocks."""

    def __init__(self, size: int):
        self.parent = np.arange(size)

    def roots(self, nodes: np.ndarray) -> np.ndarray:
        found = self.parent[nodes]
        while True:
            above = self.parent[found]
            if (above == found).all():
                self.parent[nodes] = found
                return found
            found = above

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            roots_a, roots_b = self.roots(a), self.roots(b)
            apart = roots_a != roots_b
            if not apart.any():
                return
            low = np.minimum(roots_a[apart], roots_b[apart])
            np.minimum.at(self.parent, np.maximum(roots_a[apart], roots_b[apart]), low)


def join_blocks(
    left: np.ndarray, right: np.ndarray | None, axes: np.ndarray, least: float,
    left_weight: np.ndarray, right_weight: np.ndarray | None,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights linked to each vector and its root, over ``left`` and then ``right``.

    ``right`` None joins ``left`` with itself; a vector is not linked to itself then.
    """
    own = right is None
    a_boxes = _boxes(left @ axes)
    shift = 0 if own else len(left)
    b_vectors, b_weight = (left, left_weight) if own else (right, right_weight)
    b_boxes = a_boxes if own else _boxes(right @ axes)
    size = len(left) + (0 if own else len(right))
    linked, forest = np.zeros(size, np.int64), _Forest(size)
    limit = 2 - 2 * least + 1e-9
    stack = [((0, len(left)), (0, len(b_vectors)))] if len(left) and len(b_vectors) else []
    while stack:
        a, b = stack.pop()
        if own and a[0] > b[0]:
            continue  # the mirror image
        (low_a, high_a), (low_b, high_b) = a_boxes[a], b_boxes[b]
        gap = np.maximum(0, np.maximum(low_a - high_b, low_b - high_a))
        if (gap**2).sum() > limit:
            continue
        size_a, size_b = a[1] - a[0], b[1] - b[0]
        if size_a <= LEAF and size_b <= LEAF:
            good = left[a[0] : a[1]] @ b_vectors[b[0] : b[1]].T >= least
            same = own and a == b
            if same:
                np.fill_diagonal(good, False)
            at, to = np.nonzero(good)
            if len(at):
                linked[a[0] : a[1]] += good @ b_weight[b[0] : b[1]]
                if not same:
                    linked[shift + b[0] : shift + b[1]] += good.T @ left_weight[a[0] : a[1]]
                forest.join(at + a[0], to + b[0] + shift)
            continue
        halves = []
        for span, size_of in ((a, size_a), (b, size_b)):
            middle = (span[0] + span[1]) // 2
            halves.append([span] if size_of <= LEAF else [(span[0], middle), (middle, span[1])])
        stack += [(x, y) for x in halves[0] for y in halves[1]]
    return linked, forest.roots(np.arange(size))


def near_duplicates(
    vectors: DataFrame, least: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``id, n_links, component_id, kept`` of every row of ``vectors``.

    Two rows link when their labels are equal and not null, their vectors have one length
    and their cosine in double precision is at least ``least``. Vectors that are null,
    empty, zero or not finite link with nothing. ``n_links`` counts the other rows that a
    row links with, equal vectors among them; the component is the smallest id reachable;
    ``kept`` is true for it. Repeated rows stay and link with each other. A row whose id
    is null takes part, and its ``kept`` is false where its component has an id. Other
    columns are ignored; an empty table gives an empty result.
    """
    named = vectors.select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).alias("label"), vector_col
    )
    rows = materialise(packed(named.where("label IS NOT NULL"), "vec_id", vector_col, "label"))
    axes = _axes(rows)
    # equal vectors of a label are one from here on; the hash keeps the long key out of joins
    rows = rows.withColumn("vector_id", F.xxhash64("label", "packed"))
    distinct = rows.groupBy("label", "dim", "vector_id").agg(
        F.count("*").alias("weight"), F.min("vec_id").alias("least_id"), F.first("packed").alias("packed")
    )
    limit = np.sqrt(max(2 - 2 * least, 1e-12))

    def ordered(batches):
        for batch in batches:
            dims = batch.column(0).to_numpy()
            cells = np.zeros((len(dims), ORDER_AXES), np.int64)
            for dim in np.unique(dims).tolist():
                units = _unit(matrix(batch.column(1).filter(pa.array(dims == dim)), dim))
                places = np.floor(units @ axes[dim][:, :ORDER_AXES] / limit).astype(np.int64)
                cells[dims == dim, : places.shape[1]] = places
            yield pa.record_batch({
                **{f"c{i}": pa.array(cells[:, i]) for i in range(ORDER_AXES)},
                **{name: batch.column(name) for name in batch.schema.names},
            })

    label_kind = vectors.schema[label_col].dataType.simpleString()
    columns = ["dim", "packed", "label", "vector_id", "weight"]
    types = ["int", "binary", label_kind, "bigint", "bigint"]
    cells = ", ".join(f"c{i} bigint" for i in range(ORDER_AXES))
    fields = ", ".join(f"{n} {t}" for n, t in zip(columns, types, strict=True))
    distinct = materialise(distinct)
    sequence = materialise(distinct.select(*columns).mapInArrow(ordered, f"{cells}, {fields}"))
    order = ["label", "dim", *(f"c{i}" for i in range(ORDER_AXES)), "vector_id"]

    def cut(batches):
        """Runs of the sorted sequence as rows; a run ends with its label or when it is full."""
        held: list = []
        size = 0

        def flush():
            nonlocal held, size
            table = pa.Table.from_batches(held)
            held, size = [], 0
            dim = table["dim"][0].as_py()
            points = _unit(matrix(table["packed"], dim)) @ axes[dim]
            low, high = points.min(axis=0), points.max(axis=0)
            return pa.record_batch({
                "label": table["label"].slice(0, 1).combine_chunks(), "dim": pa.array([dim], pa.int32()),
                "block": table["vector_id"].slice(0, 1).combine_chunks(),
                "low": pa.array([low.tolist()], pa.list_(pa.float64())),
                "high": pa.array([high.tolist()], pa.list_(pa.float64())),
                **{
                    name: pa.array([table[name].to_numpy().astype("<i8").tobytes()], pa.binary())
                    for name in ("vector_id", "weight")
                },
                "packed": pa.array([b"".join(table["packed"].to_pylist())], pa.binary()),
            })

        for batch in batches:
            keys = list(zip(batch.column("label").to_pylist(), batch.column("dim").to_pylist(), strict=True))
            start = 0
            for at in range(1, len(keys) + 1):
                ends = at == len(keys) or keys[at] != keys[start]
                if ends or at - start + size >= BLOCK:
                    if held and (held[0].column("label")[0].as_py(), held[0].column("dim")[0].as_py()) != keys[start]:
                        yield flush()
                    held.append(batch.slice(start, at - start))
                    size += at - start
                    start = at
                    if size >= BLOCK:
                        yield flush()
        if held:
            yield flush()

    blocks = materialise(
        sequence.repartitionByRange(*order).sortWithinPartitions(*order).select(*columns).mapInArrow(
            cut,
            f"label {label_kind}, dim int, block bigint, low array<double>, high array<double>,"
            " vector_id binary, weight binary, packed binary",
        )
    )
    found = _joined(blocks, axes, least, limit)
    # per distinct vector: links to others, and the forest's links
    counted = found.groupBy("vector_id").agg(F.sum("linked").alias("linked"))
    classes = connected_components(
        found.select(F.col("vector_id").alias("a"), F.col("root").alias("b"))
    ).withColumnRenamed("node", "vector_id")
    per_vector = (
        distinct.select("vector_id", "least_id", "weight")
        .join(counted, "vector_id", "left").join(classes, "vector_id", "left")
        .withColumn("class", F.coalesce("component", "vector_id"))
    )
    smallest = per_vector.groupBy("class").agg(F.min("least_id").alias("component_id"))
    per_vector = join_per_key(per_vector, smallest, ["class"]).select(
        "vector_id", "component_id",
        (F.coalesce("linked", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
    )
    linked = join_per_key(rows.select("vec_id", "vector_id"), per_vector, ["vector_id"]).select(
        "vec_id", "n_links", "component_id"
    )
    # the other rows: without label or usable vector
    alone = named.where(F.col("label").isNull() | ~usable(vector_col)).select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(alone).select(
        F.col("vec_id").alias(id_col), "n_links", "component_id",
        F.coalesce(F.col("vec_id").eqNullSafe(F.col("component_id")), F.lit(False)).alias("kept"),
    )


def _joined(blocks: DataFrame, axes: dict, least: float, limit: float) -> DataFrame:
    """``vector_id, linked, root`` from all pairs of near blocks."""
    boxes = blocks.select("label", "dim", "block", "low", "high")

    def cell(value):
        return F.floor(value / limit).cast("bigint")

    # blocks meet in the cells of the first axis that the one's box, widened, shares
    ours = boxes.withColumn("cell", F.explode(F.sequence(
        cell(F.col("low")[0] - limit), cell(F.col("high")[0] + limit)
    )))
    theirs = boxes.select(
        "label", "dim", F.col("block").alias("other"), F.col("low").alias("other_low"),
        F.col("high").alias("other_high"),
        F.explode(F.sequence(cell(F.col("low")[0]), cell(F.col("high")[0]))).alias("cell"),
    )
    gaps = F.zip_with(
        F.zip_with("low", "other_high", lambda a, b: a - b),
        F.zip_with("other_low", "high", lambda a, b: a - b),
        lambda x, y: F.greatest(x, y, F.lit(0.0)),
    )
    distance = F.aggregate(gaps, F.lit(0.0), lambda total, gap: total + gap * gap)
    pairs = materialise(
        ours.join(theirs, ["label", "dim", "cell"]).where("block <= other")
        .where(distance <= limit**2 + 1e-9)
        .select(F.col("block").alias("a"), F.col("other").alias("b")).distinct()
    )
    sides = pairs.select("a", "b", F.col("a").alias("block")).unionByName(
        pairs.where("a <> b").select("a", "b", F.col("b").alias("block"))
    )
    data = blocks.select("block", "dim", "vector_id", "weight", "packed")

    def run(table: pa.Table) -> pa.Table:
        sides = sorted(range(table.num_rows), key=lambda at: table["block"][at].as_py())
        dim = table["dim"][0].as_py()
        units, weights, ids = [], [], []
        for at in sides:
            units.append(_unit(np.frombuffer(table["packed"][at].as_py(), "<f8").reshape(-1, dim)))
            weights.append(np.frombuffer(table["weight"][at].as_py(), "<i8"))
            ids.append(np.frombuffer(table["vector_id"][at].as_py(), "<i8"))
        second = (units[1], weights[1]) if len(units) > 1 else (None, None)
        linked, roots = join_blocks(units[0], second[0], axes[dim], least, weights[0], second[1])
        all_ids = np.concatenate(ids)
        keep = np.flatnonzero(linked > 0)
        return pa.table({
            "vector_id": all_ids[keep], "linked": linked[keep], "root": all_ids[roots[keep]],
        })

    return materialise(
        join_per_key(sides, data, ["block"]).groupBy("a", "b").applyInArrow(
            run, "vector_id bigint, linked bigint, root bigint"
        )
    )
