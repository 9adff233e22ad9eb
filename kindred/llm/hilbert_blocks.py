"""Hard negatives from Hilbert-ordered candidate blocks with zone maps.

Vectors are quantised to integers and ordered along a Hilbert curve through the axes of
largest variance, label by label. Consecutive rows form blocks; a block is one row of a
Parquet table and carries a zone map, the least and the greatest value of every dimension.
Interval arithmetic on a zone map bounds the inner products that an anchor can have in the
block, so the zone maps alone tell which blocks an anchor has to read:

* for its positives, blocks of its label that can reach the score of the fifth best row of
  its own block;
* for its negatives, blocks of other labels whose bounds meet one of its windows.

Anchors work in tiles and blocks in slices. A task holds one tile and one slice and returns
only the best rows of each anchor, so no pair of rows is ever shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.slices import with_small_batches
from kindred.operators.numbering import number_rows
from kindred.session import materialise


@dataclass(frozen=True)
class Settings:
    """What is searched, and the sizes of the pieces; the sizes change no result."""

    scale: int = 256
    positives: int = 5
    negatives: int = 10
    low_percent: int = 30
    high_percent: int = 90
    block_rows: int = 512
    slice_blocks: int = 8
    tile_rows: int = 1024
    curve_axes: int = 8
    curve_bits: int = 4


_RAW = "id bigint, label bigint, anchor boolean, dim int, q binary"
_BLOCK = (
    "block bigint, label bigint, dim int, ids binary, q binary, low binary, high binary,"
    " anchors binary, fifths binary"
)


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Positions of grid ``cells`` (rows of axis numbers below ``2**bits``) on the Hilbert curve.

    Gray-code form of the curve, all rows at once: undo the rotations from the highest bit
    down, then decode the Gray code and interleave the axes' bits. The product of axes and
    bits must stay below 64.
    """
    axes = [cells[:, axis].astype(np.int64) for axis in range(cells.shape[1])]
    top = 1 << (bits - 1)
    level = top
    while level > 1:
        below = level - 1
        for axis in range(len(axes)):
            inside = (axes[axis] & level) != 0
            swapped = (axes[0] ^ axes[axis]) & below
            first = np.where(inside, axes[0] ^ below, axes[0] ^ swapped)
            if axis:
                axes[axis] = np.where(inside, axes[axis], axes[axis] ^ swapped)
            axes[0] = first
        level >>= 1
    for axis in range(1, len(axes)):
        axes[axis] ^= axes[axis - 1]
    flip = np.zeros(len(cells), np.int64)
    level = top
    while level > 1:
        flip = np.where(axes[-1] & level, flip ^ (level - 1), flip)
        level >>= 1
    place = np.zeros(len(cells), np.int64)
    for bit in range(bits - 1, -1, -1):
        for axis in axes:
            place = (place << 1) | (((axis ^ flip) >> bit) & 1)
    return place


def _pack(values: np.ndarray) -> bytes:
    """Integers as little-endian 16-bit numbers where they fit, else 64-bit ones."""
    small = not values.size or (values.min() >= -32768 and values.max() <= 32767)
    return values.astype("<i2" if small else "<i8").tobytes()


def _unpack(data: bytes, count: int) -> np.ndarray:
    return np.frombuffer(data, "<i2" if len(data) == 2 * count else "<i8").astype(np.int64)


def _rows(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """Packed vectors as rows."""
    return np.array([_unpack(data, dim) for data in column.to_pylist()], np.int64).reshape(len(column), dim)


def inner_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact integer inner products of all rows of ``left`` with all rows of ``right``."""
    most = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * left.shape[1]
    if most < 2.0**52:
        return np.rint(left.astype(np.float64) @ right.T.astype(np.float64)).astype(np.int64)
    return left @ right.T  # sums wrap at 64 bits, but a result fits them


def product_bounds(
    anchors: np.ndarray, low: np.ndarray, high: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each anchor with any vector of each box."""
    up, down = np.maximum(anchors, 0).astype(np.float64), np.minimum(anchors, 0).astype(np.float64)
    low, high = low.astype(np.float64), high.astype(np.float64)
    least, greatest = up @ low.T + down @ high.T, up @ high.T + down @ low.T
    # beyond 2**53 a double's rounding must not close a block
    slack = 1e-12 * (np.abs(anchors).astype(np.float64) @ np.maximum(np.abs(low), np.abs(high)).T)
    return least - slack, greatest + slack


def quantised(
    vectors: DataFrame, anchors: Column, id_col: str, vector_col: str, label_col: str, scale: int
) -> DataFrame:
    """``id, label, anchor, dim, q``: usable rows with ``floor(scale * x)`` of every component."""
    finite = F.forall(
        vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))
    )
    usable = (
        F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull()
        & finite
    )
    rows = vectors.where(usable).select(
        F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"),
        F.col(vector_col).cast("array<double>").alias("v"),
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(3)
            edges = column.offsets.to_numpy().tolist()
            values = np.floor(column.values.to_numpy(zero_copy_only=False) * scale)
            kept, packed = [], []
            for row, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                mine = values[a:b]
                if mine @ mine < 2.0**62:
                    kept.append(row)
                    packed.append(_pack(mine.astype(np.int64)))
            dims = np.diff(edges).astype(np.int32)[kept]
            chosen = batch.select([0, 1, 2]).take(pa.array(kept, pa.int64()))
            yield pa.record_batch(
                [*chosen.columns, pa.array(dims), pa.array(packed, pa.binary())],
                names=["id", "label", "anchor", "dim", "q"],
            )

    return with_small_batches(rows).mapInArrow(task, _RAW)


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims).tolist():
        yield dim, batch.filter(pa.array(dims == dim))


def curve_axes(raw: DataFrame, most: int) -> dict[int, list[tuple[int, float, float]]]:
    """Per vector length, the axes of largest variance with their mean and deviation.

    Sums are formed in the tasks and added in Spark; one row per axis reaches the driver.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, part in _by_dim(batch):
                rows = _rows(part.column("q"), dim).astype(np.float64)
                found = np.array([np.full(dim, len(rows)), rows.sum(axis=0), (rows * rows).sum(axis=0)])
                sums[dim] = sums.get(dim, 0) + found
        for dim, (count, total, square) in sums.items():
            yield pa.record_batch({
                "dim": pa.array([dim] * dim, pa.int32()), "axis": pa.array(range(dim), pa.int32()),
                "count": pa.array(count), "total": pa.array(total), "square": pa.array(square),
            })

    parts = raw.mapInArrow(task, "dim int, axis int, count double, total double, square double")
    rows = parts.groupBy("dim", "axis").agg(
        *(F.sum(name).alias(name) for name in ("count", "total", "square"))
    )
    found: dict[int, list[tuple[int, float, float]]] = {}
    for row in rows.collect():
        mean = row["total"] / row["count"]
        spread = max(row["square"] / row["count"] - mean * mean, 0.0) ** 0.5
        found.setdefault(row["dim"], []).append((row["axis"], mean, spread))
    return {
        dim: sorted(axes, key=lambda axis: (-axis[2], axis[0]))[:most] for dim, axes in found.items()
    }


def _with_curve(
    raw: DataFrame, axes: dict[int, list[tuple[int, float, float]]], bits: int
) -> DataFrame:
    """``raw`` with ``curve``, the row's place on the Hilbert curve of its vector length."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = np.zeros(batch.num_rows, np.int64)
            dims = batch.column("dim").to_numpy()
            for dim, part in _by_dim(batch):
                if dim:
                    which, mean, spread = map(np.array, zip(*axes[dim], strict=True))
                    rows = _rows(part.column("q"), dim)[:, which]
                    # two deviations to either side of the mean fill the grid
                    cells = (rows - mean) / np.where(spread > 0, 4 * spread, 1.0) + 0.5
                    cells = np.clip((cells * (1 << bits)).astype(np.int64), 0, (1 << bits) - 1)
                    places[dims == dim] = hilbert_index(cells, bits)
            yield batch.append_column("curve", pa.array(places))

    return raw.mapInArrow(task, f"{_RAW}, curve bigint")


def candidate_blocks(raw: DataFrame, settings: Settings) -> DataFrame:
    """One row per block: ids, vectors, zone map, its anchors and their fifth best scores here.

    Rows are range partitioned on (length, label, curve, id), so a label of any size spreads
    over tasks. Equal rows stand side by side and count once.
    """
    placed = _with_curve(raw, curve_axes(raw, settings.curve_axes), settings.curve_bits)
    order = ["dim", "label", "curve", "id", "q"]
    dealt = placed.repartitionByRange(*order).sortWithinPartitions(*order)

    def block(number: int, rows: list[tuple]) -> pa.RecordBatch:
        dim, label = rows[0][3], rows[0][1]
        ids = np.array([row[0] for row in rows], "<i8")
        vectors = np.array([_unpack(row[4], dim) for row in rows], np.int64).reshape(len(rows), dim)
        anchors = np.flatnonzero([row[2] for row in rows]).astype("<i4")
        scores = inner_products(vectors[anchors], vectors)
        scores[ids[anchors][:, None] == ids[None, :]] = np.iinfo(np.int64).min
        fifths = np.full(len(anchors), np.iinfo(np.int64).min)
        if len(rows) >= settings.positives and len(anchors):
            fifths = np.partition(scores, -settings.positives, axis=1)[:, -settings.positives]
        return pa.record_batch({
            "block": pa.array([number], pa.int64()), "label": pa.array([label], pa.int64()),
            "dim": pa.array([dim], pa.int32()), "ids": [ids.tobytes()], "q": [_pack(vectors)],
            "low": [vectors.min(axis=0).astype("<i8").tobytes()],
            "high": [vectors.max(axis=0).astype("<i8").tobytes()],
            "anchors": [anchors.tobytes()], "fifths": [fifths.astype("<i8").tobytes()],
        })

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 32
        rows: list[tuple] = []
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if rows and row == rows[-1]:
                    continue
                if rows and (len(rows) == settings.block_rows or row[1] != rows[0][1] or row[3] != rows[0][3]):
                    yield block(number, rows)
                    number, rows = number + 1, []
                rows.append(row)
        if rows:
            yield block(number, rows)

    return materialise(dealt.select("id", "label", "anchor", "dim", "q").mapInArrow(task, _BLOCK))


def _anchor_rows(blocks: DataFrame, settings: Settings) -> DataFrame:
    """``tile, id, label, dim, q, fifth``: one row per anchor id, in tiles along the curve."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                which, dim = np.frombuffer(row["anchors"], "<i4"), row["dim"]
                ids = np.frombuffer(row["ids"], "<i8")
                vectors = _unpack(row["q"], len(ids) * dim).reshape(len(ids), dim)
                yield pa.record_batch({
                    "id": pa.array(ids[which]), "label": pa.array([row["label"]] * len(which), pa.int64()),
                    "block": pa.array([row["block"]] * len(which), pa.int64()),
                    "dim": pa.array([dim] * len(which), pa.int32()),
                    "q": pa.array([_pack(vectors[at]) for at in which.tolist()], pa.binary()),
                    "fifth": pa.array(np.frombuffer(row["fifths"], "<i8")),
                })

    kept = blocks.where(F.octet_length("anchors") > 0).select("block", "label", "dim", "ids", "q",
                                                              "anchors", "fifths")
    found = kept.mapInArrow(task, "id bigint, label bigint, block bigint, dim int, q binary, fifth bigint")
    # of several rows under an anchor's id, the one of the smallest label, then vector
    first = F.row_number().over(Window.partitionBy("id").orderBy("label", "q", "block"))
    found = found.withColumn("_first", first).where("_first = 1").drop("_first")
    order = [F.col(name) for name in ("dim", "label", "block", "id")]
    numbered = number_rows(found, order, (), "_row")
    return materialise(
        numbered.withColumn("tile", F.floor((F.col("_row") - 1) / settings.tile_rows)).drop("_row", "block")
    )


def _matrix_of(blocks: pa.Table, column: str, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(blocks.column(column).to_pylist()), "<i8").reshape(len(blocks), dim)


def _wanted(tile: pa.Table, blocks: pa.Table, dim: int) -> np.ndarray:
    """Which anchors (rows) must read which blocks (columns), by the zone maps alone."""
    anchors = _rows(tile.column("q"), dim)
    least, greatest = product_bounds(
        anchors, _matrix_of(blocks, "low", dim), _matrix_of(blocks, "high", dim)
    )
    same = tile.column("label").to_numpy()[:, None] == blocks.column("label").to_numpy()[None, :]
    if "windows" not in tile.column_names:
        return same & (greatest >= tile.column("fifth").to_numpy()[:, None])
    wanted = np.zeros(same.shape, bool)
    for at, windows in enumerate(tile.column("windows").to_pylist()):
        for window in windows:
            if window["low"] <= window["high"]:
                wanted[at] |= (greatest[at] >= window["low"]) & (least[at] <= window["high"])
    return wanted & ~same


def _choice(_key: tuple, tile: pa.Table, zones: pa.Table) -> pa.Table:
    """The blocks that some anchor of the tile must read."""
    chosen = []
    if tile.num_rows and zones.num_rows:
        dim = tile.column("dim")[0].as_py()
        needed = _wanted(tile, zones, dim).any(axis=0)
        chosen = zones.column("block").to_numpy()[needed]
    return pa.table({
        "tile": pa.array([_key[1].as_py()] * len(chosen), pa.int64()),
        "block": pa.array(chosen, pa.int64()),
    })


def _scored(tile: pa.Table, blocks: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per anchor of the tile that reads any of the blocks: its row, ids and scores, best first."""
    dim = tile.column("dim")[0].as_py()
    ids = [np.frombuffer(data, "<i8") for data in blocks.column("ids").to_pylist()]
    wanted = _wanted(tile, blocks, dim)
    reading = np.flatnonzero(wanted.any(axis=1))
    if not len(reading):
        return
    vectors = np.concatenate([
        _unpack(data, len(mine) * dim).reshape(len(mine), dim)
        for data, mine in zip(blocks.column("q").to_pylist(), ids, strict=True)
    ])
    owner = np.repeat(np.arange(len(ids)), [len(mine) for mine in ids])
    by_id = np.argsort(np.concatenate(ids), kind="stable")
    every, vectors, owner = np.concatenate(ids)[by_id], vectors[by_id], owner[by_id]
    anchors, own = _rows(tile.column("q"), dim), tile.column("id").to_numpy()
    for start in range(0, len(reading), 64):
        some = reading[start : start + 64]
        scores = inner_products(anchors[some], vectors)
        for row, at in enumerate(some.tolist()):
            open_rows = np.flatnonzero(wanted[at][owner] & (every != own[at]))
            mine = scores[row][open_rows]
            order = np.argsort(-mine, kind="stable")
            yield at, every[open_rows][order], mine[order]


def _search(
    anchors: DataFrame, blocks: DataFrame, slices: int, reader, schema: str
) -> DataFrame:
    """Let zone maps choose blocks per tile, then apply ``reader`` to every (tile, slice).

    Vectors of another length never meet: the length is part of every key.
    """
    spread = F.pmod(F.xxhash64("block"), F.lit(slices)).cast("int")
    zones = blocks.select("block", "label", "dim", "low", "high").withColumn("slice", spread)
    # a zone map goes to every tile, an anchor to every slice of zone maps
    last = anchors.agg(F.max("tile")).first()[0] or 0
    every = F.sequence(F.lit(0).cast("bigint"), F.lit(last).cast("bigint"))
    zones = zones.withColumn("tile", F.explode(every))
    near = anchors.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    keys = ["dim", "tile", "slice"]
    chosen = (
        near.groupBy(*keys).cogroup(zones.groupBy(*keys))
        .applyInArrow(_choice, "tile bigint, block bigint")
    )
    chosen = materialise(chosen.withColumn("slice", spread))
    opened = blocks.drop("anchors", "fifths").join(chosen, "block")
    readers = anchors.join(chosen.select("tile", F.col("slice").alias("slice")).distinct(), "tile")
    return readers.groupBy(*keys).cogroup(opened.groupBy(*keys)).applyInArrow(reader, schema)


def _best(rows: DataFrame, group: list[str], id_col: str, score: str, most: int) -> DataFrame:
    """The first ``most`` rows of a group by falling score, then rising id, with their ``rank``."""
    order = Window.partitionBy(*group).orderBy(F.desc(score), id_col)
    return rows.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= most)


def hard_negatives(
    vectors: DataFrame, anchors: Column, settings: Settings | None = None,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """Hard negatives of every anchor and each of its positives.

    ``anchors`` tells the anchor rows. Components become ``floor(scale * x)``; a score is the
    integer inner product with the anchor. An anchor's positives are the best other rows of
    its label. Of the rows with another label whose score lies between ``low_percent`` and
    ``high_percent`` of the positive's score, both included, the best are returned as
    ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``; ties go to
    the smaller id. The result is exact: a zone map closes only blocks without such a row.

    Rows with a null id, label or vector, or a null or non-finite component, take no part,
    nor do vectors so long that a score would not fit 64 bits (quantised squared length of
    2**62 and more). Zero and empty vectors take part. Vectors of different lengths are never
    compared. Equal rows count once; rows that share an id but differ count each, but an
    anchor meets no row of its own id, and of several rows under an anchor's id the one with
    the smallest label, then vector, is the anchor. Other columns are ignored. An empty
    table, or one without anchors, gives an empty result.
    """
    settings = settings or Settings()
    raw = materialise(quantised(vectors, anchors, id_col, vector_col, label_col, settings.scale))
    blocks = candidate_blocks(raw, settings)
    queries = _anchor_rows(blocks, settings)
    slices = max(1, -(-blocks.count() // settings.slice_blocks))

    def positives(_key: tuple, tile: pa.Table, opened: pa.Table) -> pa.Table:
        found = []
        for at, ids, scores in _scored(tile, opened) if opened.num_rows and tile.num_rows else ():
            anchor = tile.column("id")[at].as_py()
            best = zip(ids[: settings.positives].tolist(), scores[: settings.positives].tolist(), strict=True)
            found += [(anchor, id_, score) for id_, score in best]
        columns = list(zip(*found, strict=True)) or [(), (), ()]
        names = ("anchor_id", "positive_id", "positive_score")
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)})

    near = _search(queries, blocks, slices, positives,
                   "anchor_id bigint, positive_id bigint, positive_score bigint")
    near = _best(near, ["anchor_id"], "positive_id", "positive_score", settings.positives)
    # integer bounds of the window; a decimal holds a hundredfold 64-bit score
    share = F.col("positive_score").cast("decimal(20,0)")
    low, high = share * settings.low_percent / 100, share * settings.high_percent / 100
    windows = near.groupBy(F.col("anchor_id").alias("id")).agg(
        F.collect_list(F.struct(
            "positive_id", "positive_score", F.ceil(low).cast("bigint").alias("low"),
            F.floor(high).cast("bigint").alias("high"),
        )).alias("windows")
    )
    asking = materialise(queries.drop("fifth").join(windows, "id"))

    def negatives(_key: tuple, tile: pa.Table, opened: pa.Table) -> pa.Table:
        found = []
        asked = tile.column("windows").to_pylist()
        for at, ids, scores in _scored(tile, opened) if opened.num_rows and tile.num_rows else ():
            anchor = tile.column("id")[at].as_py()
            for window in asked[at]:  # of a negative positive score nothing is in the window
                start, stop = np.searchsorted(-scores, [-window["high"], -window["low"] + 1]).tolist()
                stop = min(stop, start + settings.negatives)
                found += [
                    (anchor, window["positive_id"], id_, window["positive_score"], score)
                    for id_, score in zip(
                        ids[start:stop].tolist(), scores[start:stop].tolist(), strict=True
                    )
                ]
        columns = list(zip(*found, strict=True)) or [()] * 5
        names = ("anchor_id", "positive_id", "negative_id", "positive_score", "negative_score")
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)})

    far = _search(asking, blocks, slices, negatives,
                  "anchor_id bigint, positive_id bigint, negative_id bigint, positive_score bigint,"
                  " negative_score bigint")
    best = _best(far, ["anchor_id", "positive_id", "positive_score"], "negative_id", "negative_score",
                 settings.negatives)
    return best.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                       "negative_score")
