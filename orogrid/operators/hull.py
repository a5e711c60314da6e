"""Computational geometry on boundary points: hulls, footprints, triangulated gaps.

Spark first shrinks a mask to the outer pixels of each row and column; the geometry of those few
points runs in one numpy function for each raster, and the pixels are tested by Spark again.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orogrid.operators import grid


def outline_points(df: DataFrame, flag: Column) -> DataFrame:
    """(rid, r, c): the first and last set pixel of each row and column, at most four for each row and column."""
    on = df.where(F.coalesce(flag, F.lit(False)))
    by_row = on.groupBy("rid", "r").agg(F.min("c").alias("a"), F.max("c").alias("b"))
    by_col = on.groupBy("rid", "c").agg(F.min("r").alias("a"), F.max("r").alias("b"))
    rows = by_row.select("rid", "r", F.explode(F.array("a", "b")).alias("c"))
    cols = by_col.select("rid", F.explode(F.array("a", "b")).alias("r"), "c")
    return rows.union(cols).distinct()


def convex_ring(points: np.ndarray) -> np.ndarray:
    """Corners of the convex hull, counter-clockwise from the least point (monotone chain)."""
    pts = np.unique(points, axis=0)
    if len(pts) < 3:
        return pts

    def half(order) -> list:
        chain: list = []
        for p in order:
            while len(chain) > 1 and (chain[-1][0] - chain[-2][0]) * (p[1] - chain[-2][1]) - (chain[-1][1] - chain[-2][1]) * (p[0] - chain[-2][0]) <= 0:
                chain.pop()
            chain.append(tuple(p))
        return chain

    low, up = half(pts), half(pts[::-1])
    return np.array(low[:-1] + up[:-1])


def triangulate(points: np.ndarray) -> np.ndarray:
    """Delaunay triangles (rows of three point numbers) by incremental insertion; a tiny fixed jitter settles co-circular points.

    Points come in order of their first coordinate. The triangles whose circle holds the next point hang together, so they are
    reached from the last ones made, over shared sides: time grows about as the number of points."""
    pts = np.asarray(points, float)
    n = len(pts)
    if n < 3:
        return np.zeros((0, 3), int)
    rng = np.random.default_rng(7)
    p = pts + rng.uniform(-1e-4, 1e-4, pts.shape)
    mid, size = p.mean(0), max(np.ptp(p, axis=0).max(), 1.0) * 50
    order = np.lexsort((p[:, 1], p[:, 0])).tolist()
    at = np.vstack([p, mid + [-2 * size, -size], mid + [2 * size, -size], mid + [0, 2 * size]]).tolist()
    tri: list[tuple[int, int, int] | None] = []
    circles: list[tuple[float, float, float]] = []
    beside: list[list[int]] = []  # the triangle over the side that faces each corner, -1 for none
    free: list[int] = []

    def make(t: tuple[int, int, int], near: list[int]) -> int:
        (ax, ay), (bx, by), (cx, cy) = at[t[0]], at[t[1]], at[t[2]]
        d = 2 * (ax * (by - cy) + bx * (cy - ay) + cx * (ay - by)) or 1e-300
        sa, sb, sc = ax * ax + ay * ay, bx * bx + by * by, cx * cx + cy * cy
        ux = (sa * (by - cy) + sb * (cy - ay) + sc * (ay - by)) / d
        uy = (sa * (cx - bx) + sb * (ax - cx) + sc * (bx - ax)) / d
        circle = (ux, uy, (ax - ux) * (ax - ux) + (ay - uy) * (ay - uy))
        if free:
            k = free.pop()
            tri[k], circles[k], beside[k] = t, circle, near
            return k
        tri.append(t)
        circles.append(circle)
        beside.append(near)
        return len(tri) - 1

    def holds(k: int, x: float, y: float) -> bool:
        ux, uy, r = circles[k]
        return (x - ux) * (x - ux) + (y - uy) * (y - uy) < r

    def turn(a: int, b: int, x: float, y: float) -> float:
        (ax, ay), (bx, by) = at[a], at[b]
        return (bx - ax) * (y - ay) - (by - ay) * (x - ax)

    def find(k: int, x: float, y: float) -> int:
        """A triangle whose circle holds the point, on the way to it from triangle k."""
        for _ in range(len(tri) + 1):
            if holds(k, x, y):
                return k
            t = tri[k]
            for j in range(3):
                a, b = t[j - 2], t[j - 1]
                if beside[k][j] >= 0 and turn(a, b, x, y) * turn(a, b, *at[t[j]]) < 0:
                    k = beside[k][j]
                    break
            else:
                break
        return next((k for k, t in enumerate(tri) if t is not None and holds(k, x, y)), -1)

    last = make((n, n + 1, n + 2), [-1, -1, -1])
    for i in order:
        x, y = at[i]
        start = find(last, x, y)
        if start < 0:
            continue
        bad, todo, rim = {start}, [start], []
        while todo:
            k = todo.pop()
            t = tri[k]
            for j in range(3):
                o = beside[k][j]
                if o in bad:
                    continue
                if o >= 0 and holds(o, x, y):
                    bad.add(o)
                    todo.append(o)
                else:
                    a, b = t[j - 2], t[j - 1]
                    rim.append((min(a, b), max(a, b), o, k))
        new, open_ = [], {}
        for a, b, o, k in rim:
            m = make((a, b, i), [-1, -1, o])
            new.append(m)
            if o >= 0:
                beside[o][beside[o].index(k)] = m
            for corner, j in ((a, 1), (b, 0)):  # the side of this corner and the new point
                if corner in open_:
                    m2, j2 = open_.pop(corner)
                    beside[m][j], beside[m2][j2] = m2, m
                else:
                    open_[corner] = (m, j)
        for k in bad:
            tri[k] = None
        free.extend(bad)
        last = new[-1]
    return np.array([t for t in tri if t is not None and max(t) < n], int).reshape(-1, 3)


def concave_triangles(points: np.ndarray, tri: np.ndarray, concavity: float = 0.5) -> np.ndarray:
    """Triangles left when the hull is worn away from outside.

    A triangle's alpha is its longest edge. Each triangle is worth the least, over ways in from outside,
    of the greatest alpha on the way; a share `concavity` of the distinct worths above the least alpha
    that joins all points sets the cutoff, and triangles above it that the outside reaches go."""
    if len(tri) == 0 or concavity <= 0:
        return tri
    edge = lambda a, b: np.hypot(*(points[tri[:, a]] - points[tri[:, b]]).T)
    alpha = np.maximum(np.maximum(edge(0, 1), edge(1, 2)), edge(2, 0))
    sides: dict[tuple[int, int], list[int]] = {}
    for k, t in enumerate(tri):
        for a, b in ((0, 1), (1, 2), (2, 0)):
            sides.setdefault((min(t[a], t[b]), max(t[a], t[b])), []).append(k)
    from heapq import heappop, heappush

    # from outside: a triangle can only be worn away once one of its neighbours or the outside was
    worth = np.full(len(tri), -np.inf)
    heap = [(-alpha[ks[0]], ks[0]) for ks in sides.values() if len(ks) == 1]
    from heapq import heapify

    heapify(heap)
    done = np.zeros(len(tri), bool)
    beside: list[list[int]] = [[] for _ in tri]
    for ks in sides.values():
        if len(ks) == 2:
            beside[ks[0]].append(ks[1])
            beside[ks[1]].append(ks[0])
    while heap:
        w, k = heappop(heap)
        if done[k]:
            continue
        done[k], worth[k] = True, -w
        for j in beside[k]:
            if not done[j]:
                heappush(heap, (-min(-w, alpha[j]), j))
    least = float(np.sort(alpha)[: max(1, len(alpha) // 2)].max())
    levels = np.unique(worth[worth > least])
    if not len(levels):
        return tri
    cutoff = levels[-int(np.ceil(len(levels) * concavity))]
    return tri[worth < cutoff]


def decimate(ring: np.ndarray, tolerance: float = 1.0, least: int = 3) -> np.ndarray:
    """The ring without vertices whose squared offset from the line of their neighbours is least, while that and what was given
    up before stays under the tolerance."""
    pts = [np.asarray(p, float) for p in (ring[:-1] if len(ring) > 1 and (ring[0] == ring[-1]).all() else ring)]
    kept = [0.0] * len(pts)

    def offset(i: int) -> float:
        a, b, c = pts[i - 1], pts[i], pts[(i + 1) % len(pts)]
        d = c - a
        length = (d * d).sum()
        return float(((b - a) ** 2).sum()) if length == 0 else float((d[0] * (b - a)[1] - d[1] * (b - a)[0]) ** 2 / length)

    while len(pts) > least:
        cost = [offset(i) + kept[i] for i in range(len(pts))]
        i = int(np.argmin(cost))
        if cost[i] >= tolerance:
            break
        gone = offset(i)
        kept[i - 1] += gone
        kept[(i + 1) % len(pts)] += gone
        del pts[i], kept[i]
    return np.array(pts + pts[:1])


def convex_hull(df: DataFrame, flag: Column, offset: bool = False, tolerance: float = 1e-9) -> DataFrame:
    """(rid, hull): corner pixels of the convex hull as an array of (r, c), from the outline points.

    offset: pixels count with their side middles, so the hull contains whole sides."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pts = pdf[["r", "c"]].to_numpy(float)
        if offset:
            pts = np.vstack([pts + d for d in ([-0.5, 0], [0.5, 0], [0, -0.5], [0, 0.5])])
        ring = convex_ring(pts)
        return pd.DataFrame({"rid": [pdf["rid"].iloc[0]], "hull": [[{"r": float(a), "c": float(b)} for a, b in ring]]})

    kind = df.schema["rid"].dataType.simpleString()
    return outline_points(df, flag).groupBy("rid").applyInPandas(run, f"rid {kind}, hull array<struct<r:double,c:double>>")


def hull_image(df: DataFrame, flag: Column, offset: bool = False, out: str = "inside") -> DataFrame:
    """df with a flag for pixels within the convex hull: on one side of each of its edges, tested in Spark."""
    rings = convex_hull(df, flag, offset)
    n = F.size("hull")

    def right(k: Column) -> Column:
        a, b = F.get("hull", k), F.get("hull", (k + 1) % n)
        return (b["r"] - a["r"]) * (F.col("c") - a["c"]) - (b["c"] - a["c"]) * (F.col("r") - a["r"]) >= -1e-9

    ok = F.when(n >= 3, F.forall(F.sequence(F.lit(0), n - 1), right)).otherwise(F.coalesce(flag, F.lit(False)))
    return df.join(rings, "rid", "left").withColumn(out, F.coalesce(ok, F.lit(False))).drop("hull")


def concave_hull_image(df: DataFrame, flag: str, concavity: float = 0.5, out: str = "inside") -> DataFrame:
    """df with a flag for pixels in the concave hull of the flag's outline points.

    Points on a lattice are co-circular, so triangulations differ in detail; the hull contains the set
    pixels' outline points and lies within the convex hull. Rows of pixels inside each triangle are
    made as runs, so the raster is never held by one task."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pts = pdf[["r", "c"]].to_numpy(float)
        tri = concave_triangles(pts, triangulate(pts), concavity)
        rows = []
        for q in pts[tri].tolist():
            for r in range(math.ceil(min(x for x, _ in q)), math.floor(max(x for x, _ in q)) + 1):
                xs = []
                for a, b in ((0, 1), (1, 2), (2, 0)):
                    (r1, c1), (r2, c2) = q[a], q[b]
                    if r1 == r2:
                        if r1 == r:
                            xs += [c1, c2]
                    elif min(r1, r2) <= r <= max(r1, r2):
                        xs.append(c1 + (r - r1) * (c2 - c1) / (r2 - r1))
                if xs:
                    rows.append((r, math.ceil(min(xs) - 1e-9), math.floor(max(xs) + 1e-9)))
        out_ = pd.DataFrame(rows, columns=["r", "a", "b"])
        out_.insert(0, "rid", pdf["rid"].iloc[0])
        return out_[out_.a <= out_.b]

    kind = df.schema["rid"].dataType.simpleString()
    runs = outline_points(df, F.col(flag)).groupBy("rid").applyInPandas(run, f"rid {kind}, r int, a int, b int")
    inside = runs.distinct().select("rid", "r", F.explode(F.sequence("a", "b")).alias("c")).distinct().withColumn("_covered", F.lit(True))
    return df.join(inside, list(grid.KEY), "left").withColumn(out, F.coalesce("_covered", F.lit(False)) | F.coalesce(F.col(flag), F.lit(False))).drop("_covered")


def footprint(df: DataFrame, flag: Column, x0: float = 0.0, y0: float = 0.0, dx: float = 1.0, dy: float = -1.0, tolerance: float = 1.0) -> DataFrame:
    """(rid, ring): simplified convex outline of the data in world coordinates, closed."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ring = convex_ring(pdf[["r", "c"]].to_numpy(float))
        ring = decimate(ring, tolerance) if len(ring) >= 3 else ring
        return pd.DataFrame({"rid": [pdf["rid"].iloc[0]], "ring": [[{"x": x0 + b * dx, "y": y0 + a * dy} for a, b in ring]]})

    kind = df.schema["rid"].dataType.simpleString()
    return outline_points(df, flag).groupBy("rid").applyInPandas(run, f"rid {kind}, ring array<struct<x:double,y:double>>")


def decimate_rings(rings: DataFrame, key: str, column: str, tolerance: float = 1.0) -> DataFrame:
    """rings with each ring (array of x, y) simplified; independent rings, in Arrow batches."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [decimate(np.array([[p["x"], p["y"]] for p in ring]), tolerance) for ring in pdf[column]]
            yield pd.DataFrame({key: pdf[key], column: [[{"x": float(a), "y": float(b)} for a, b in r] for r in out]})

    kind = rings.schema[key].dataType.simpleString()
    return rings.select(key, column).mapInPandas(run, f"{key} {kind}, {column} array<struct<x:double,y:double>>")


def fill_gaps(df: DataFrame) -> DataFrame:
    """(rid, r, c, a, outer) of a thinned class grid (a: 0 gap, 1, 2): gaps linear between the boundary pixels of 1 and 2 within
    their triangles, elsewhere (outer) as the nearest pixel. The grid is a hundredth of the raster."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        r0, c0 = pdf.r.min(), pdf.c.min()
        a = np.zeros((pdf.r.max() - r0 + 1, pdf.c.max() - c0 + 1))
        a[pdf.r - r0, pdf.c - c0] = pdf.a
        on = a != 0
        padded = np.pad(on, 1)
        edge = on & ~(padded[:-2, 1:-1] & padded[2:, 1:-1] & padded[1:-1, :-2] & padded[1:-1, 2:])
        pts = np.argwhere(edge).astype(float)
        known = on.copy()
        if len(pts):
            for t in triangulate(pts):
                q, v = pts[t], a[tuple(pts[t].astype(int).T)]
                lo, hi = q.min(0).astype(int), q.max(0).astype(int)
                rr, cc = np.mgrid[lo[0] : hi[0] + 1, lo[1] : hi[1] + 1]
                d = (q[1, 1] - q[2, 1]) * (q[0, 0] - q[2, 0]) + (q[2, 0] - q[1, 0]) * (q[0, 1] - q[2, 1])
                if abs(d) < 1e-12:
                    continue
                u = ((q[1, 1] - q[2, 1]) * (rr - q[2, 0]) + (q[2, 0] - q[1, 0]) * (cc - q[2, 1])) / d
                w = ((q[2, 1] - q[0, 1]) * (rr - q[2, 0]) + (q[0, 0] - q[2, 0]) * (cc - q[2, 1])) / d
                x = 1 - u - w
                hit = (u >= -1e-9) & (w >= -1e-9) & (x >= -1e-9) & ~on[rr, cc]
                a[rr[hit], cc[hit]] = (u * v[0] + w * v[1] + x * v[2])[hit]
                known[rr[hit], cc[hit]] = True
        outer = ~known
        if known.any() and outer.any():
            src = np.argwhere(known)
            for r, c in np.argwhere(outer):
                k = np.argmin((src[:, 0] - r) ** 2 + (src[:, 1] - c) ** 2)
                a[r, c] = a[tuple(src[k])]
        rr, cc = np.indices(a.shape)
        return pd.DataFrame({"rid": pdf["rid"].iloc[0], "r": (rr + r0).ravel().astype("int32"), "c": (cc + c0).ravel().astype("int32"), "a": a.ravel(), "outer": outer.ravel()})

    kind = df.schema["rid"].dataType.simpleString()
    return df.select(*grid.KEY, F.col("a").cast("double")).groupBy("rid").applyInPandas(run, f"rid {kind}, r int, c int, a double, outer boolean")
