"""Flow over elevation rasters.

Directions are expressions over neighbours.  Filling pits and accumulating along flow paths depend on the whole of a
drainage: tiles are solved by themselves, each with the state that its neighbours' border cells had in the round before,
until no tile changes.  A raster of one tile takes one round, others as many as a flow path crosses borders of tiles.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.operators.fill import nearest_fill
from gridloom.operators.focal import along_col, along_row
from gridloom.operators.graph import checkpointed
from gridloom.schema import COL, KEY, RASTER, ROW
from gridloom.ship import ship

#: Row and column steps of the codes 1 to 8, counter-clockwise from east (fixed values).
STEPS = ((0, 1), (-1, 1), (-1, 0), (-1, -1), (0, -1), (1, -1), (1, 0), (1, 1))


def neighbours(value: str) -> list[Column]:
    """The values of the neighbours 1 to 8, by two windows; with_rows() makes the columns that they use."""
    row = {-1: "__up", 0: value, 1: "__down"}
    return [(F.lag if dc < 0 else F.lead)(row[dr], 1).over(along_row()) if dc else F.col(row[dr]) for dr, dc in STEPS]


def with_rows(df: DataFrame, value: str) -> DataFrame:
    return df.withColumn("__up", F.lag(value).over(along_col())).withColumn("__down", F.lead(value).over(along_col()))


def d8(df: DataFrame, value: str, spacing: float = 10.0) -> DataFrame:
    """direction (1 to 8, 0 where nothing lies lower) and slope (drop over distance) to the steepest neighbour; ties go to the smaller code."""
    own = with_rows(df.select(*KEY, F.col(value).alias("z")), "z")
    drops = [F.struct(((F.col("z") - n) / (spacing * (math.sqrt(2) if dr and dc else 1.0))).alias("drop"), F.lit(-k).alias("back")) for k, ((dr, dc), n) in enumerate(zip(STEPS, neighbours("z"), strict=True), 1)]
    best = F.array_max(F.filter(F.array(*drops), lambda x: x["drop"].isNotNull()))
    found = own.withColumn("__best", best)
    lower = F.coalesce(F.col("__best.drop") > 0, F.lit(False))
    known = F.col("z").isNotNull()
    return found.select(*KEY, F.when(known, F.when(lower, -F.col("__best.back")).otherwise(0)).cast("int").alias("direction"), F.when(known, F.when(lower, F.col("__best.drop")).otherwise(0.0)).alias("slope"))


def dinf(df: DataFrame, value: str, spacing: float = 10.0) -> DataFrame:
    """angle (radians counter-clockwise from east, NULL where nothing lies lower) and slope of the steepest of eight triangular facets."""
    own = with_rows(df.select(*KEY, F.col(value).cast("double").alias("z")), "z")
    z, n = F.col("z"), neighbours("z")
    facets = []
    for straight, diagonal, turn, base in ((0, 1, 1, 0), (2, 1, -1, 1), (2, 3, 1, 1), (4, 3, -1, 2), (4, 5, 1, 2), (6, 5, -1, 3), (6, 7, 1, 3), (0, 7, -1, 4)):
        s1, s2 = (z - n[straight]) / spacing, (n[straight] - n[diagonal]) / spacing
        r, s = F.atan2(s2, s1), F.sqrt(s1 * s1 + s2 * s2)
        corner = (z - n[diagonal]) / (spacing * math.sqrt(2))
        angle = F.when(r < 0, 0.0).when(r > math.pi / 4, math.pi / 4).otherwise(r)
        slope = F.when(r < 0, s1).when(r > math.pi / 4, corner).otherwise(s)
        facets.append(F.struct(slope.alias("slope"), F.pmod(turn * angle + base * math.pi / 2, F.lit(2 * math.pi)).alias("angle")))
    best = F.array_max(F.filter(F.array(*facets), lambda x: x["slope"].isNotNull()))
    found = own.withColumn("__best", best)
    falls = F.coalesce(F.col("__best.slope") > 0, F.lit(False))
    return found.select(*KEY, F.when(falls, F.col("__best.angle")).alias("angle"), F.when(z.isNotNull(), F.when(falls, F.col("__best.slope")).otherwise(0.0)).alias("slope"))


def streams(df: DataFrame, area: str, least: int = 350) -> DataFrame:
    """stream 1 where so many cells drain through, else 0."""
    return df.select(*KEY, F.when(F.col(area) >= least, 1).otherwise(0).alias("stream"))


#: Side of a tile.
TILE = 2048
Arrays = dict[str, np.ndarray]
#: Of the values and the state of a tile with a ring of one cell around it (NaN beyond the raster), the new state, ring and all.
Kernel = Callable[[Arrays, Arrays], Arrays]


def by_tiles(df: DataFrame, values: list[str], state: dict[str, float], kernel: Kernel, tile: int = TILE) -> DataFrame:
    """The state that kernel reaches on every raster, in cell form; state: names and initial values.  What stays NaN is NULL."""
    types = {k: df.schema[k].dataType.simpleString() for k in KEY}
    names = list(state)

    def run(cells: pd.DataFrame) -> pd.DataFrame:
        r, c = cells[ROW].to_numpy(), cells[COL].to_numpy()
        top, left = int(cells["tr"].iloc[0]) * tile - 1, int(cells["tc"].iloc[0]) * tile - 1
        own = (r > top) & (r <= top + tile) & (c > left) & (c <= left + tile)
        if not own.any():  # cells that only border on a tile beyond the raster
            return cells[own][[*KEY, *values, *names]].assign(__changed=False)
        shape = (int(r[own].max()) - top + 2, int(c[own].max()) - left + 2)

        def arrays(wanted: list[str]) -> Arrays:
            out = {v: np.full(shape, np.nan) for v in wanted}
            for v in wanted:
                out[v][r - top, c - left] = cells[v].to_numpy(float)
            return out

        old = arrays(names)
        new = kernel(arrays(values), {n: x.copy() for n, x in old.items()})
        at = (r[own] - top, c[own] - left)
        same = np.all([(new[n][at] == old[n][at]) | (np.isnan(new[n][at]) & np.isnan(old[n][at])) for n in names], axis=0)
        return cells[own][[*KEY, *values]].assign(**{n: new[n][at] for n in names}, __changed=~same)

    ship(df.sparkSession)
    schema = ", ".join([f"{k} {t}" for k, t in types.items()] + [f"{v} double" for v in [*values, *names]] + ["__changed boolean"])
    tiles = lambda at: F.array_distinct(F.array(*[F.floor((F.col(at) + k) / tile) for k in (-1, 0, 1)]))
    now = df.select(*KEY, *[F.col(v).cast("double").alias(v) for v in values], *[F.lit(float(x)).alias(n) for n, x in state.items()])
    size = df.agg(F.max(ROW), F.max(COL)).first()
    single = size[0] is None or max(size) < tile
    while True:
        sent = now.withColumn("tr", F.explode(tiles(ROW))).withColumn("tc", F.explode(tiles(COL))).filter("tr >= 0 and tc >= 0") if not single else now.withColumn("tr", F.lit(0)).withColumn("tc", F.lit(0))
        solved = sent.groupBy(RASTER, "tr", "tc").applyInPandas(run, schema)
        if single:
            return solved.select(*KEY, *names)
        solved = checkpointed(solved)
        if solved.filter("__changed").isEmpty():
            return solved.select(*KEY, *names)
        now = solved.drop("__changed")


def own_cells(shape: tuple[int, int]) -> np.ndarray:
    """Which cells of a tile aren't of its ring."""
    out = np.zeros(shape, bool)
    out[1:-1, 1:-1] = True
    return out


def filled_pits(z: np.ndarray, level: np.ndarray, step: float = 0.0) -> np.ndarray:
    """The least surface at or above z, given that of the ring, from which every cell has a path to the ring, the raster's edge or a missing cell that never ascends, or with a step that descends by it at least; infinite where none is known yet."""
    h, w = z.shape
    own = own_cells(z.shape) & ~np.isnan(z)
    edge = np.zeros(z.shape, bool)
    edge[1:-1, 1:-1] = np.any([np.isnan(z[1 + a : h - 1 + a, 1 + b : w - 1 + b]) for a, b in STEPS], axis=0)
    out, done = np.where(own, np.inf, level), ~own
    queue = [(float(level[r, c]), int(r), int(c)) for r, c in np.argwhere(~own & np.isfinite(level) & ~np.isnan(z))]
    for r, c in np.argwhere(own & edge):
        out[r, c], done[r, c] = z[r, c], True
        queue.append((float(z[r, c]), int(r), int(c)))
    heapq.heapify(queue)
    while queue:
        height, r, c = heapq.heappop(queue)
        for a, b in STEPS:
            y, x = r + a, c + b
            if 0 <= y < h and 0 <= x < w and not done[y, x]:
                done[y, x] = True
                out[y, x] = max(z[y, x], height + step)
                heapq.heappush(queue, (float(out[y, x]), y, x))
    return out


def pit_fill(df: DataFrame, value: str, step: float = 0.0, tile: int = TILE) -> DataFrame:
    """filled: the surface without pits; with a step, flats drain too."""

    def kernel(a: Arrays, state: Arrays) -> Arrays:
        return {"filled": np.where(np.isnan(a[value]), np.nan, filled_pits(a[value], state["filled"], step))}

    known = df.select(*KEY, F.col(value).cast("double").alias(value))
    out = by_tiles(known, [value], {"filled": math.inf}, kernel, tile)
    return out.select(*KEY, F.when(F.col("filled") != math.inf, F.col("filled")).alias("filled"))


class Flow:
    """Where the cells of a raster drain to, by flat index: up to two receivers each, -1 if none, and the parts that they get."""

    def __init__(self, to: np.ndarray, part: np.ndarray) -> None:
        self.to, self.part = to, np.where(to >= 0, part, 0.0)

    def without_targets(self, cells: np.ndarray) -> Flow:
        """The flow but for what goes into some cells."""
        return Flow(np.where((self.to >= 0) & cells.ravel()[self.to], -1, self.to), self.part)

    def levels(self) -> list[np.ndarray]:
        """Cells in groups, each after all that drain to it; cells on cycles are left out."""
        valid = self.to >= 0
        inflows = np.bincount(self.to[valid], minlength=len(self.to))
        out, now = [], np.flatnonzero(inflows == 0)
        while len(now):
            out.append(now)
            targets, counts = np.unique(self.to[now][valid[now]], return_counts=True)
            inflows[targets] -= counts
            now = targets[inflows[targets] == 0]
        return out


def flow_d8(direction: np.ndarray) -> Flow:
    """Each cell drains to the neighbour that its code names."""
    known = ~np.isnan(direction)
    code = np.where(known, direction, 0).astype(int)
    return _flow(known, [(code - 1, np.ones(direction.shape), code > 0)])


def flow_dinf(angle: np.ndarray, known: np.ndarray) -> Flow:
    """Each cell drains to the two neighbours that bracket its angle, in proportion to their nearness to it."""
    turn = np.where(np.isnan(angle), 0.0, angle) / (math.pi / 4)
    low = np.floor(turn)
    high_part = turn - low
    falls = ~np.isnan(angle)
    return _flow(known, [(low.astype(int) % 8, 1 - high_part, falls & (1 - high_part > 1e-12)), ((low.astype(int) + 1) % 8, high_part, falls & (high_part > 1e-12))])


def _flow(known: np.ndarray, ways: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Flow:
    h, w = known.shape
    steps = np.array(STEPS)
    r, c = np.indices(known.shape)
    to, part = [], []
    for k, share, falls in ways:
        y, x = r + steps[k, 0], c + steps[k, 1]
        inside = falls & (y >= 0) & (y < h) & (x >= 0) & (x < w)
        inside[inside] = known[y[inside], x[inside]]
        to.append(np.where(inside, y * w + x, -1).ravel())
        part.append(share.ravel())
    return Flow(np.stack(to, axis=1), np.stack(part, axis=1))


def accumulated(flow: Flow, known: np.ndarray, area: np.ndarray, tainted: np.ndarray) -> Arrays:
    """Cells that drain through each, itself included, and whether flow from beyond the measured area may come in; given both for the ring."""
    h, w = known.shape
    own = own_cells(known.shape)
    near_gap = np.zeros(known.shape, bool)
    near_gap[1:-1, 1:-1] = ~np.all([known[1 + a : h - 1 + a, 1 + b : w - 1 + b] for a, b in STEPS], axis=0)
    area = np.where(own, known, np.nan_to_num(area)).ravel().astype(float)
    taint = np.where(own, near_gap, np.nan_to_num(tainted) > 0).ravel()
    flow = flow.without_targets(~own)
    for cells in flow.levels():
        for k in range(flow.to.shape[1]):
            to = flow.to[cells, k]
            on = to >= 0
            np.add.at(area, to[on], flow.part[cells, k][on] * area[cells][on])
            np.logical_or.at(taint, to[on], taint[cells][on])
    return {"area": np.where(known, area.reshape(h, w), np.nan), "tainted": taint.reshape(h, w).astype(float)}


def _areas(df: DataFrame, values: list[str], flow: Callable[[Arrays], tuple[Flow, np.ndarray]], edge_contamination: bool, tile: int) -> DataFrame:
    def kernel(a: Arrays, state: Arrays) -> Arrays:
        way, known = flow(a)
        return accumulated(way, known, state["area"], state["tainted"])

    out = by_tiles(df, values, {"area": 0.0, "tainted": 0.0}, kernel, tile)
    return out.select(*KEY, F.when(F.col("tainted") == 0, F.col("area")).alias("area")) if edge_contamination else out.select(*KEY, "area")


def d8_area(df: DataFrame, direction: str = "direction", edge_contamination: bool = True, tile: int = TILE) -> DataFrame:
    """area: the number of cells that drain through each, itself included; NULL where flow from beyond the measured area may come in."""
    return _areas(df, [direction], lambda a: (flow_d8(a[direction]), ~np.isnan(a[direction])), edge_contamination, tile)


def dinf_area(df: DataFrame, angle: str = "angle", measured: str = "slope", spacing: float = 10.0, edge_contamination: bool = True, tile: int = TILE) -> DataFrame:
    """sca: contributing area over cell size; a cell without inflow has the cell size."""

    def flow(a: Arrays) -> tuple[Flow, np.ndarray]:
        known = ~np.isnan(a[measured])
        return flow_dinf(a[angle], known), known

    return _areas(df, [angle, measured], flow, edge_contamination, tile).select(*KEY, (F.col("area") * spacing).alias("sca"))


def distances_down(df: DataFrame, value: str, angle: str, stream: str, spacing: float = 10.0, tile: int = TILE) -> DataFrame:
    """dd_s, dd_h, dd_v: flow-weighted mean surface, horizontal and vertical distance along all paths down to a stream; NULL without one."""
    names = ["dd_s", "dd_h", "dd_v"]

    def kernel(a: Arrays, state: Arrays) -> Arrays:
        z, known = a[value], ~np.isnan(a[value])
        h, w = z.shape
        own = own_cells(z.shape).ravel()
        flow = flow_dinf(np.where(own.reshape(h, w), a[angle], np.nan), known)
        at_stream = (a[stream] == 1).ravel() & own
        flat, found = z.ravel(), np.where(own, np.nan, np.stack([state[n].ravel() for n in names]))
        found[:, at_stream] = 0.0
        for cells in reversed(flow.levels()):
            cells = cells[own[cells] & ~at_stream[cells]]
            total, weight = np.zeros((3, len(cells))), np.zeros(len(cells))
            for k in range(flow.to.shape[1]):
                to = flow.to[cells, k]
                on = (to >= 0) & ~np.isnan(found[0, to])
                i, j, part = cells[on], to[on], flow.part[cells, k][on]
                length = spacing * np.where((i // w != j // w) & (i % w != j % w), math.sqrt(2), 1.0)
                drop = flat[i] - flat[j]
                total[:, on] += part * (found[:, j] + np.stack([np.hypot(length, drop), length, drop]))
                weight[on] += part
            reached = weight > 0
            found[:, cells[reached]] = total[:, reached] / weight[reached]
        return {n: found[k].reshape(h, w) for k, n in enumerate(names)}

    return by_tiles(df, [value, angle, stream], dict.fromkeys(names, math.nan), kernel, tile)


def fixed_distances(df: DataFrame) -> DataFrame:
    """Missing distances, missing together, take those of the nearest measured cell."""
    return nearest_fill(df, "dd_s", also=("dd_h", "dd_v"))
