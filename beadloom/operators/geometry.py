"""Plane geometry: polygons and polylines as small parameters, points as tables."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def validated(df: DataFrame, *columns: str) -> DataFrame:
    """df; an error at a null or a value that isn't finite."""
    fine = F.lit(True)
    for c in columns:
        fine = fine & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) & (F.abs(F.col(c)) < float("inf"))
    return df.filter(F.when(fine, True).otherwise(F.raise_error(F.lit("coordinates must be finite"))).cast("boolean"))


def polygon_area(df: DataFrame, key: str, order: str, x: str = "x", y: str = "y") -> DataFrame:
    """(key, area) of each key's polygon, whose vertices come in the given order."""
    w = Window.partitionBy(key).orderBy(order)
    everything = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    nxt = lambda c: F.coalesce(F.lead(c).over(w), F.first(c).over(everything))
    cross = F.col(x) * nxt(y) - nxt(x) * F.col(y)
    return df.select(key, cross.alias("_c")).groupBy(key).agg((F.abs(F.sum("_c")) / 2).alias("area"))


def in_polygon(x: Column, y: Column, vertices: list[tuple[float, float]]) -> Column:
    """Whether a point is strictly inside; on the boundary it isn't. Null coordinates give null."""
    inside, on = F.lit(0), F.lit(False)
    for (ax, ay), (bx, by) in zip(vertices, vertices[1:] + vertices[:1], strict=True):
        cross = (bx - ax) * (y - ay) - (by - ay) * (x - ax)
        on = on | ((cross == 0) & x.between(min(ax, bx), max(ax, bx)) & y.between(min(ay, by), max(ay, by)))
        if ay != by:
            hit = ((F.lit(float(ay)) > y) != (F.lit(float(by)) > y)) & (x < F.lit(float(bx - ax)) * (y - ay) / (by - ay) + ax)
            inside = inside + hit.cast("int")
    return F.when(x.isNotNull() & y.isNotNull(), (inside % 2 == 1) & ~on)


def projection(a: tuple, b: tuple, x: Column, y: Column) -> Column:
    """Where the foot of a point lies on the line from a (0) to b (1)."""
    dx, dy = b[0] - a[0], b[1] - a[1]
    return ((x - a[0]) * dx + (y - a[1]) * dy) / (dx * dx + dy * dy)


def side(a: tuple, b: tuple, x: Column, y: Column) -> Column:
    """1 left of the line from a to b, -1 right, 0 on it."""
    return F.signum((b[0] - a[0]) * (y - a[1]) - (b[1] - a[1]) * (x - a[0]))


def line_distance(a: tuple, b: tuple, x: Column, y: Column) -> Column:
    return F.abs((b[0] - a[0]) * (y - a[1]) - (b[1] - a[1]) * (x - a[0])) / float(np.hypot(b[0] - a[0], b[1] - a[1]))


def polar(x: Column, y: Column, cx: float, cy: float) -> dict[str, Column]:
    return {"r": F.hypot(x - cx, y - cy), "theta": F.atan2(y - cy, x - cx)}


def path_lengths(df: DataFrame, key: str, order: str, x: str = "x", y: str = "y") -> DataFrame:
    """df with seg and cum: distance from the vertex before (0 for the first), and along the path so far."""
    w = Window.partitionBy(key).orderBy(order)
    seg = F.coalesce(F.hypot(F.col(x) - F.lag(x).over(w), F.col(y) - F.lag(y).over(w)), F.lit(0.0))
    return df.withColumn("seg", seg).withColumn("cum", F.sum("seg").over(w.rowsBetween(Window.unboundedPreceding, 0)))


def at_distances(df: DataFrame, wanted: DataFrame, key: str, order: str) -> DataFrame:
    """(key, d, x, y): the points of each key's polyline at the distances d of wanted (key, d) along it."""
    w = Window.partitionBy(key).orderBy(order)
    cum = path_lengths(df, key, order)
    legs = cum.select(F.col(key).alias("_k"), F.col("x").alias("x0"), F.col("y").alias("y0"), F.col("cum").alias("c0"), *(F.lead(c).over(w).alias(n) for c, n in (("x", "x1"), ("y", "y1"), ("cum", "c1"))), F.row_number().over(w).alias("_i")).filter("c1 > c0")
    hit = wanted.join(legs, (F.col(key) == F.col("_k")) & F.col("d").between(F.col("c0"), F.col("c1")))
    t = (F.col("d") - F.col("c0")) / (F.col("c1") - F.col("c0"))
    lerp = F.struct((F.col("x0") + t * (F.col("x1") - F.col("x0"))).alias("x"), (F.col("y0") + t * (F.col("y1") - F.col("y0"))).alias("y"))
    return hit.groupBy(key, "d").agg(F.min_by(lerp, "_i").alias("p")).select(key, "d", "p.x", "p.y")


def resampled(line: np.ndarray, n: int) -> np.ndarray:
    """n points at equal distances along a polyline."""
    cum = np.concatenate([[0], np.cumsum(np.hypot(*np.diff(line, axis=0).T))])
    d = np.linspace(0, cum[-1], n)
    return np.column_stack([np.interp(d, cum, line[:, k]) for k in (0, 1)])


def smooth(guides: np.ndarray, per_leg: int = 20) -> np.ndarray:
    """A smooth polyline through guide points (centripetal-free Catmull-Rom)."""
    p = np.vstack([2 * guides[0] - guides[1], guides, 2 * guides[-1] - guides[-2]])
    t = np.linspace(0, 1, per_leg, endpoint=False)[:, None]
    legs = [0.5 * (2 * b + (c - a) * t + (2 * a - 5 * b + 4 * c - d) * t**2 + (3 * b - a - 3 * c + d) * t**3) for a, b, c, d in zip(p, p[1:], p[2:], p[3:])]
    return np.vstack([*legs, guides[-1:]])


def along_line(df: DataFrame, line: list[tuple[float, float]], points: int = 1000) -> DataFrame:
    """df (x, y) with d (signed distance from the polyline, left positive) and r (place along it, 0 to 1)."""
    v = resampled(np.asarray(line, float), points)
    cum = np.concatenate([[0], np.cumsum(np.hypot(*np.diff(v, axis=0).T))])
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields if f.name not in ("d", "r"))

    def run(parts):
        a, ab = v[:-1], np.diff(v, axis=0)
        for p in parts:
            out = np.empty((len(p), 2))
            xy = p[["x", "y"]].to_numpy(float)
            for k in range(0, len(p), 2000):
                ap = xy[k : k + 2000, None, :] - a
                t = np.clip((ap * ab).sum(2) / np.maximum((ab * ab).sum(1), 1e-300), 0, 1)
                gap = ap - t[:, :, None] * ab
                dist = np.hypot(gap[:, :, 0], gap[:, :, 1])
                leg = dist.argmin(axis=1)
                row = np.arange(len(leg))
                cross = ab[leg, 0] * ap[row, leg, 1] - ab[leg, 1] * ap[row, leg, 0]
                out[k : k + 2000, 0] = np.where(cross < 0, -1, 1) * dist[row, leg]
                out[k : k + 2000, 1] = (cum[leg] + t[row, leg] * (cum[leg + 1] - cum[leg])) / cum[-1]
            yield p.drop(columns=[c for c in ("d", "r") if c in p]).assign(d=out[:, 0], r=out[:, 1])

    return df.mapInPandas(run, f"{schema}, d double, r double")


def grid_between(splines: list[np.ndarray], ni: int, nr: int) -> pd.DataFrame:
    """A grid (x, y, i, r): nr places along each of ni curves, evenly between the given splines in order."""
    lines = np.stack([resampled(np.asarray(s, float), nr) for s in splines])
    at = np.linspace(0, len(lines) - 1, ni)
    low = np.minimum(at.astype(int), len(lines) - 2)
    t = (at - low)[:, None, None]
    xy = lines[low] * (1 - t) + lines[low + 1] * t
    i, r = np.meshgrid(np.linspace(0, 1, ni), np.linspace(0, 1, nr), indexing="ij")
    return pd.DataFrame({"x": xy[:, :, 0].ravel(), "y": xy[:, :, 1].ravel(), "i": i.ravel(), "r": r.ravel()})


def grid_greedy(a: np.ndarray, b: np.ndarray, ni: int, nr: int) -> pd.DataFrame:
    """A grid between two splines whose rungs join near points: from both beginnings, the side moves on that keeps the rung shorter."""
    a, b = resampled(np.asarray(a, float), 10 * nr), resampled(np.asarray(b, float), 10 * nr)
    i = j = 0
    rungs = [(0, 0)]
    while i < len(a) - 1 or j < len(b) - 1:
        options = [(p, q) for p, q in ((i + 1, j), (i, j + 1), (i + 1, j + 1)) if p < len(a) and q < len(b)]
        i, j = min(options, key=lambda o: float(np.hypot(*(a[o[0]] - b[o[1]]))))
        rungs.append((i, j))
    pick = np.asarray(rungs)[np.linspace(0, len(rungs) - 1, nr).round().astype(int)]
    t = np.linspace(0, 1, ni)[:, None, None]
    xy = a[pick[:, 0]] * (1 - t) + b[pick[:, 1]] * t
    gi, gr = np.meshgrid(np.linspace(0, 1, ni), np.linspace(0, 1, nr), indexing="ij")
    return pd.DataFrame({"x": xy[:, :, 0].ravel(), "y": xy[:, :, 1].ravel(), "i": gi.ravel(), "r": gr.ravel()})


def joined_grids(first: pd.DataFrame, second: pd.DataFrame) -> pd.DataFrame:
    """Two grids that share a curve (the first's last, the second's first) as one, with i scaled anew."""
    n, m = first["i"].nunique(), second["i"].nunique()
    a, b = first.copy(), second[second["i"] > second["i"].min()].copy()
    a["i"], b["i"] = a["i"] * (n - 1) / (n + m - 2), (n - 1 + b["i"] * (m - 1)) / (n + m - 2)
    return pd.concat([a, b], ignore_index=True)


def _square(grid: pd.DataFrame) -> np.ndarray:
    g = grid.sort_values(["i", "r"], kind="stable")
    ni, nr = g["i"].nunique(), g["r"].nunique()
    if len(g) != ni * nr or not g[["x", "y", "i", "r"]].apply(np.isfinite).all().all():
        raise ValueError("a grid has every pair of i and r once, and finite coordinates")
    return g[["x", "y"]].to_numpy(float).reshape(ni, nr, 2)


def grid_perimeter(grid: pd.DataFrame) -> np.ndarray:
    g = _square(grid)
    return np.vstack([g[0], g[1:, -1], g[-1, -2::-1], g[-2:0:-1, 0]])


def grid_width(grid: pd.DataFrame) -> float:
    """Mean distance between the first and the last curve, at equal places along them."""
    g = _square(grid)
    return float(np.hypot(*(g[-1] - g[0]).T).mean())


def grid_lines(grid: pd.DataFrame) -> list[np.ndarray]:
    g = _square(grid)
    return [*g, *g.transpose(1, 0, 2)]


def _border(grid: pd.DataFrame) -> np.ndarray:
    """(x, y, i, r) of the vertices around a grid; corners come twice, once for each side."""
    g = grid.assign(i=_ranked(grid["i"]), r=_ranked(grid["r"]))
    sides = [("i", 1, "r", True), ("r", 1, "i", False), ("i", 0, "r", False), ("r", 0, "i", True)]
    return np.vstack([g[g[on] == end].sort_values(by, ascending=up)[["x", "y", "i", "r"]].to_numpy(float) for on, end, by, up in sides])


def _ranked(v: pd.Series) -> pd.Series:
    return (v - v.min()) / (v.max() - v.min())


def _within(x: np.ndarray, y: np.ndarray, shape: np.ndarray) -> np.ndarray:
    """Whether points lie strictly inside a closed polygon."""
    inside, on = np.zeros(len(x), bool), np.zeros(len(x), bool)
    for (ax, ay), (bx, by) in zip(shape, np.roll(shape, -1, axis=0), strict=True):
        cross = (bx - ax) * (y - ay) - (by - ay) * (x - ax)
        on |= (cross == 0) & (x >= min(ax, bx)) & (x <= max(ax, bx)) & (y >= min(ay, by)) & (y <= max(ay, by))
        if ay != by:
            inside ^= ((ay > y) != (by > y)) & (x < (bx - ax) * (y - ay) / (by - ay) + ax)
    return inside & ~on


def _cells(x: np.ndarray, y: np.ndarray, g: np.ndarray) -> np.ndarray:
    """For points inside a grid the number of the cell that holds each, the first of several; the nearest by its middle where none does."""
    quads = np.stack([g[:-1, :-1], g[1:, :-1], g[1:, 1:], g[:-1, 1:]], axis=2).reshape(-1, 4, 2)
    out = np.empty(len(x), np.int64)
    for k in range(0, len(x), step := max(1, (1 << 20) // len(quads))):
        px, py = x[k : k + step, None], y[k : k + step, None]
        inside, on = np.zeros((px.size, len(quads)), bool), np.zeros((px.size, len(quads)), bool)
        for c in range(4):
            (ax, ay), (bx, by) = quads[:, c].T, quads[:, (c + 1) % 4].T
            cross = (bx - ax) * (py - ay) - (by - ay) * (px - ax)
            on |= (cross == 0) & (px >= np.minimum(ax, bx)) & (px <= np.maximum(ax, bx)) & (py >= np.minimum(ay, by)) & (py <= np.maximum(ay, by))
            with np.errstate(divide="ignore", invalid="ignore"):
                inside ^= ((ay > py) != (by > py)) & (px < (bx - ax) * (py - ay) / (by - ay) + ax)
        held = inside | on
        middle = quads.mean(axis=1)
        near = ((middle[:, 0] - px) ** 2 + (middle[:, 1] - py) ** 2).argmin(axis=1)
        out[k : k + step] = np.where(held.any(axis=1), held.argmax(axis=1), near)
    return out


def _gap(x: np.ndarray, y: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distance of each point from the line through its a and b."""
    d = b - a
    return np.abs(d[:, 0] * (y - a[:, 1]) - d[:, 1] * (x - a[:, 0])) / np.hypot(d[:, 0], d[:, 1])


def grid_places(x: np.ndarray, y: np.ndarray, grid: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(i, r) of points. Inside, by the distances to the opposite sides of the cell that holds a point, along the lines of
    its sides; on the border or outside, i by the distance to the nearest vertex of the border in widths of the grid, r by
    the foot on the line of the two nearest ones. Both must lie on the same one of the outer curves, else an error.
    """
    g, border = _square(grid), _border(grid)
    places = [np.sort(grid[c].unique()).astype(float) for c in ("i", "r")]
    i, r = np.empty(len(x)), np.empty(len(x))
    inside = _within(x, y, border[:, :2][np.append(True, (np.diff(border[:, :2], axis=0) != 0).any(axis=1))])
    if inside.any():
        px, py = x[inside], y[inside]
        cell = _cells(px, py, g)
        ci, cr = cell // (g.shape[1] - 1), cell % (g.shape[1] - 1)
        a, b, c, d = g[ci, cr], g[ci + 1, cr], g[ci, cr + 1], g[ci + 1, cr + 1]
        for out, v, k, (low, high) in ((r, places[1], cr, (_gap(px, py, a, b), _gap(px, py, c, d))), (i, places[0], ci, (_gap(px, py, a, c), _gap(px, py, b, d)))):
            out[inside] = (v[k] * high + v[k + 1] * low) / (low + high)
    out = np.flatnonzero(~inside)
    width = grid_width(grid)
    for k in range(0, len(out), step := max(1, (1 << 20) // len(border))):
        at = out[k : k + step]
        gap = np.hypot(x[at, None] - border[:, 0], y[at, None] - border[:, 1])
        near = np.argsort(gap, axis=1, kind="stable")[:, :2]
        first, second = border[near[:, 0]], border[near[:, 1]]
        if not (np.isin(first[:, 2], (0, 1)) & (first[:, 2] == second[:, 2])).all():
            raise ValueError("a point outside is nearest to neither the first nor the last curve; make the grid longer")
        d1, d2 = np.take_along_axis(gap, near, 1).T
        i[at] = np.where(first[:, 2] == 0, -d1 / width, 1 + d1 / width)
        leg = second[:, :2] - first[:, :2]
        with np.errstate(divide="ignore", invalid="ignore"):
            p = np.clip(((x[at] - first[:, 0]) * leg[:, 0] + (y[at] - first[:, 1]) * leg[:, 1]) / (leg * leg).sum(axis=1), 0, 1)
        r[at] = np.where(d1 == d2, (first[:, 3] + second[:, 3]) / 2, first[:, 3] * (1 - p) + second[:, 3] * p)
    return i, r


def to_grid(df: DataFrame, grid: pd.DataFrame) -> DataFrame:
    """df (x, y) with i and r by grid_places(), a batch at a time. The grid is a small parameter. Coordinates are finite."""
    _square(grid)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields if f.name not in ("i", "r"))

    def run(parts):
        for p in parts:
            i, r = grid_places(p["x"].to_numpy(float), p["y"].to_numpy(float), grid)
            yield p.drop(columns=[c for c in ("i", "r") if c in p]).assign(i=i, r=r)

    return validated(df, "x", "y").mapInPandas(run, f"{schema}, i double, r double")
