"""Vectors dealt into cells around pivots, so that what cannot be near need never meet.

A cell holds the vectors that are nearest to its pivot. The distance to the pivot bounds the distance between any two
vectors (triangle inequality) and the inner product with any query (Cauchy-Schwarz), so that whole cells can be left
out, without loss. Cells of many rows are cut into tiles by a hash; a tile and what visits it meet in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ragset.sources.shared import written

#: Rows of a tile, about; pivots at most, which every task holds; slack for rounding in distances; numbers of a block of a matrix product.
SIZE, PIVOTS, SLACK, BLOCK = 4096, 1024, 1e-9, 1 << 21
#: Rows of a tile where every tile meets nearly every other: what is shuffled falls as tiles grow.
WIDE = 32768


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A column of equally long vectors as rows of a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), float).reshape(len(column), -1)


def stretches(x: np.ndarray, others: int) -> Iterator[tuple[int, np.ndarray]]:
    """(start, rows) of stretches of x whose products with so many other rows make about BLOCK numbers."""
    step = max(1, BLOCK // max(1, others))
    for start in range(0, len(x), step):
        yield start, x[start : start + step]


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, (x * x).sum(1)[:, None] + (y * y).sum(1)[None] - 2 * (x @ y.T)))


@dataclass
class Cells:
    """rows (id, v, cell, tile); for each cell its pivot, radius (largest distance to the pivot), largest norm, rows, first tile and tiles."""

    rows: DataFrame
    pivot: np.ndarray
    radius: np.ndarray
    norm: np.ndarray
    n: np.ndarray
    first: np.ndarray
    tiles: np.ndarray


def cells(vectors: DataFrame, size: int = SIZE) -> Cells:
    """vectors (id, v) in cells. Rows without a vector take no part. What reaches the driver: at most PIVOTS vectors, about, and a row a cell."""
    vectors = vectors.where("v is not null").select("id", "v")
    n = vectors.count()
    most = max(1, min(PIVOTS, -(-2 * n // size)))
    if n <= size:
        rows = vectors.select("id", "v", F.lit(0).alias("cell"), F.lit(0).alias("tile"))
        return Cells(rows, np.zeros((1, 1)), np.full(1, np.inf), np.full(1, np.inf), np.array([n]), np.zeros(1, int), np.ones(1, int))
    part = F.pmod(F.xxhash64("id", F.lit("pivot")), F.lit(1 << 30)) / (1 << 30)
    chosen = sorted((r["id"], r["v"]) for r in vectors.where(part < min(1.0, most / n)).collect())
    pivot = np.unique(np.array([v for _, v in chosen] or [vectors.first()["v"]], float), axis=0)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column("v"))
                d = distances(x, pivot)
                cell = d.argmin(axis=1)
                cols = [batch.column("id"), batch.column("v"), pa.array(cell, pa.int32()), pa.array(d[np.arange(len(cell)), cell]), pa.array(np.sqrt((x * x).sum(1)))]
                yield pa.RecordBatch.from_arrays(cols, ["id", "v", "cell", "far", "norm"])

    near = written(vectors.mapInArrow(nearest, "id long, v array<double>, cell int, far double, norm double"))
    stats = {r["cell"]: r for r in near.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("far"), F.max("norm").alias("norm")).collect()}
    of = lambda c: np.array([stats[i][c] if i in stats else 0 for i in range(len(pivot))])
    count = of("n")
    tiles = -(-count // size)
    first = np.cumsum(tiles) - tiles
    place = F.create_map(*(F.lit(int(x)) for i in range(len(pivot)) for x in (i, first[i])))
    many = F.create_map(*(F.lit(int(x)) for i in range(len(pivot)) for x in (i, max(1, tiles[i]))))
    rows = near.withColumn("tile", (place[F.col("cell")] + F.pmod(F.xxhash64("id"), many[F.col("cell")].cast("long"))).cast("int")).select("id", "v", "cell", "tile")
    return Cells(rows, pivot, of("far"), of("norm"), count, first, tiles)


def pairs_within(vectors: DataFrame, reach: float, size: int = SIZE) -> DataFrame:
    """dealt() of rows (id, v) in cells of their own."""
    return dealt(cells(vectors, size), reach)


def dealt(c: Cells, reach: float) -> DataFrame:
    """(x, y, side, id, v, …): the rows of cells, with what other columns they have, dealt to pairs of tiles x <= y, such that any two rows at a distance of reach or less meet once.

    Rows of side 0 belong to tile x and visit tile y, whose rows are those of side 1. In a pair of a tile with itself
    every row is there on both sides.
    """
    pivot, limit, several = c.pivot, c.radius + reach + SLACK, len(c.tiles) > 1
    tile_cell = np.repeat(np.arange(len(c.tiles)), c.tiles)
    # whether a row of the first cell may visit the second
    meets = distances(pivot, pivot) <= c.radius[:, None] + limit[None] if several else np.ones((1, 1), bool)
    np.fill_diagonal(meets, True)  # a pivot's distance to itself is 0 but for rounding, which a root makes large
    rows = c.rows.select("id", "v", "cell", "tile", *(k for k in c.rows.columns if k not in ("id", "v", "cell", "tile")))
    kept = [f.name for f in rows.schema if f.name not in ("cell", "tile")]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                cell, tile = (np.asarray(batch.column(k)) for k in ("cell", "tile"))
                near = distances(matrix(batch.column("v")), pivot) <= limit[None] if several else np.ones((batch.num_rows, 1), bool)
                near[np.arange(len(cell)), cell] = True
                visits, hosts = np.nonzero(near[:, tile_cell]), np.nonzero(meets[:, cell][tile_cell].T)
                for side, (row, other) in enumerate((visits, hosts)):
                    x, y = (tile[row], other) if side == 0 else (other, tile[row])
                    once = np.flatnonzero(x <= y)
                    for k in np.array_split(once, -(-len(once) // 8192) or 1):
                        own = pa.array(row[k])
                        yield pa.RecordBatch.from_arrays([pa.array(x[k], pa.int32()), pa.array(y[k], pa.int32()), pa.array(np.full(len(k), side), pa.int32()), *(batch.column(n).take(own) for n in kept)], ["x", "y", "side", *kept])

    return rows.mapInArrow(deal, ", ".join(["x int, y int, side int", *(f"{n} {rows.schema[n].dataType.simpleString()}" for n in kept)]))


def met(rows: DataFrame) -> DataFrame:
    """rows (tile, tiles, …) dealt to pairs of tiles x <= y of their group: on side 0 where x is the row's tile, on side 1 where y is."""
    at = lambda x, y, side: F.struct(x.cast("int").alias("x"), y.cast("int").alias("y"), side.alias("side"))
    own = F.col("tile")
    places = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda i: at(F.least(i, own), F.greatest(i, own), F.when(i >= own, 0).otherwise(1)))
    return rows.select("*", F.explode(F.concat(places, F.array(at(own, own, F.lit(1))))).alias("p")).select(*rows.columns, "p.*").drop("tile", "tiles")


def sides(t: pa.Table) -> tuple[pa.Table, pa.Table]:
    side = np.asarray(t.column("side"))
    return t.filter(pa.array(side == 0)), t.filter(pa.array(side == 1))
