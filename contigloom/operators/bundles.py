"""Greedy bundling of edge distances. Each group is one contig pair's edges; ties have a total order."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contigloom.operators.grouped import map_groups
from contigloom.runtime import ship

ENDS = ["c1", "o1", "c2", "o2"]


def _keys(df: DataFrame, cols: list[str]) -> str:
    kinds = dict(df.dtypes)
    return ", ".join(f"`{c}` {kinds[c]}" for c in cols)


def _whole(x: float) -> int:
    """The nearest whole number, halves up; what the last digits of a sum of floats say does not count."""
    return math.floor(round(float(x), 6) + 0.5)


def bundle_pairs(pairs: DataFrame, n_sd: int = 6, by: list[str] | None = None) -> DataFrame:
    """Bundles around medians: while edges are left, those within n_sd deviations of the median edge form a bundle with their inverse-variance
    mean and deviation (rounded, at least 1).

    pairs: the keys, dist, std. Result: the keys, bundle (from 1, in the order they are formed), dist, std, size.
    """
    by = by or ENDS

    def run(keys: tuple, rows: dict) -> list[tuple]:
        d, s, out = rows["dist"].astype(float), rows["std"].astype(float), []
        while len(d):
            mid = len(d) // 2
            reach = n_sd * s[mid]
            inside = (d >= d[mid] - reach) & (d <= d[mid] + reach)
            w = 1 / s[inside] ** 2
            out.append((*keys, len(out) + 1, int(np.floor((d[inside] * w).sum() / w.sum() + 0.5)), max(1, int(1 / np.sqrt(w.sum()) + 0.5)), int(inside.sum())))
            d, s = d[~inside], s[~inside]
        return out

    rows = pairs.filter(F.col("dist").isNotNull() & (F.col("std") > 0)).select(*by, "dist", "std")
    return map_groups(rows, by, ["dist", "std"], run, f"{_keys(pairs, by)}, bundle int, dist long, std long, size long")


def bundle_long(pairs: DataFrame, n_sd: int = 6, by: list[str] | None = None, orientation: str = "ori") -> DataFrame:
    """Best long-read bundle of each contig pair: distances in descending order join the first bundle of their orientation whose seed distance s has them
    within n_sd * (0.1 * |s| + 50), else seed one; the bundle of the most reads wins (ties: smaller orientation, then the earlier).

    Result: the keys, orientation, dist (mean, truncated), std (int(0.1 * |mean| + 50)), support.
    """
    by = by or ["c1", "c2"]

    def run(keys: tuple, rows: dict) -> list[tuple]:
        bundles: dict[str, list[list[float]]] = {}
        for d, o in sorted(zip(rows["dist"].astype(float).tolist(), rows[orientation].tolist()), key=lambda x: (-x[0], x[1])):
            for b in bundles.setdefault(o, []):
                if abs(d - b[0]) <= n_sd * (abs(b[0]) * 0.1 + 50):
                    b[1] += d
                    b[2] += 1
                    break
            else:
                bundles[o].append([d, d, 1])
        n, o, i = max(((b[2], o, i) for o, bs in bundles.items() for i, b in enumerate(bs)), key=lambda x: (x[0], [-ord(ch) for ch in x[1]], -x[2]))
        mean = bundles[o][i][1] / n
        return [(*keys, o, int(mean), int(abs(mean) * 0.1 + 50), int(n))]

    rows = pairs.filter(F.col("dist").isNotNull() & F.col(orientation).isNotNull()).select(*by, orientation, "dist")
    return map_groups(rows, by, ["dist"], run, f"{_keys(pairs, by)}, `{orientation}` string, dist long, std long, support long")


def library_strata(libs: DataFrame, mean: str = "mean", t1: int = 1000, t2: int = 10_000) -> DataFrame:
    """libs with stratum: 0 below t1, 1 below t2, and one of its own, by ascending mean, for each larger library."""
    large = F.row_number().over(Window.partitionBy(F.col(mean) >= t2).orderBy(mean, *[c for c in libs.columns if c != mean]))
    return libs.withColumn("stratum", F.when(F.col(mean) < t1, 0).when(F.col(mean) < t2, 1).otherwise(large + 1))


def super_bundles(edges: DataFrame, n_sd: int = 6, min_size: int = 5, ploidy: int = 1, by: list[str] | None = None, repeat: str | None = None) -> DataFrame:
    """Bundles of all libraries of a stratum: seeded by the edge of the largest deviation, taking those strictly within n_sd of it; accepted with more
    than half of the pair's reads (or an end in a repeat) and min_size reads, above ploidy 1 only with all of them.

    edges: the keys, dist, std, size [, repeat]. Result: the keys, dist, std, size, members. Size-weighted inverse-variance means.
    """
    by = by or ENDS

    def run(keys: tuple, rows: dict) -> list[tuple]:
        d, s, n = (rows[c].astype(float) for c in ("dist", "std", "size"))
        free = bool(rows[repeat][0]) if repeat else False
        total, out = n.sum(), []
        while len(d):
            reach = n_sd * s[-1]
            inside = (d > d[-1] - reach) & (d < d[-1] + reach)
            inside[-1] = True
            size = n[inside].sum()
            if size >= min_size and (free or (size > total / 2 and (ploidy == 1 or size == total))):
                w = 1 / s[inside] ** 2  # the size cancels from weight and variance
                out.append((*keys, _whole((d[inside] * w).sum() / w.sum()), max(1, int(1 / np.sqrt(w.sum()) + 0.5)), int(size), int(inside.sum())))
            d, s, n = d[~inside], s[~inside], n[~inside]
        return out

    rows = edges.select(*by, "dist", "std", "size", *([repeat] if repeat else []))
    return map_groups(rows, by, ["std", "dist", "size"], run, f"{_keys(edges, by)}, dist long, std long, size long, members long")


def gap_table(lib_mean: float, lib_std: float, contig: int, read: int, longest: int, normal: bool = True) -> np.ndarray:
    """Mean estimated gap for each true gap of 0 to longest: pairs that span a gap between two contigs come from the library's distribution
    cut to inserts that fit, weighted by the places they can lie at (a flat distribution unless normal)."""
    inserts = np.arange(max(1, int(lib_mean - 6 * lib_std)), int(lib_mean + 6 * lib_std) + 1)
    p = np.exp(-0.5 * ((inserts - lib_mean) / lib_std) ** 2) if normal else np.ones(len(inserts))
    out = np.empty(longest + 1)
    for gap in range(longest + 1):
        room = inserts - gap - 2 * read + 1
        places = np.clip(np.minimum(room, 2 * contig - room), 0, contig) * (room > 0)
        w = p * places
        out[gap] = gap + lib_mean - (inserts * w).sum() / w.sum() if w.sum() > 0 else np.nan
    return out


def correct_gap(edges: DataFrame, lib_mean: float, lib_std: float, read: int, lengths: list[int], longest: int | None = None) -> DataFrame:
    """edges (dist, min_len) with real_gap: the true gap whose expected estimate is nearest to dist, by binary search in the table of the contig length step
    (ties averaged); tables of a fixed number of steps travel with the task."""
    ship(edges.sparkSession)
    longest = longest or int(lib_mean + 3 * lib_std)
    steps = np.array(sorted(lengths))
    tables = {int(x): gap_table(lib_mean, lib_std, int(x), read, longest) for x in steps}

    for x, t in tables.items():
        tables[x] = np.maximum.accumulate(t[~np.isnan(t)])

    def found(d: np.ndarray, t: np.ndarray) -> np.ndarray:
        if not len(t):
            return d.astype(np.int64)
        lo, hi = np.searchsorted(t, d, "left"), np.searchsorted(t, d, "right")
        below, above = np.clip(lo - 1, 0, len(t) - 1), np.clip(lo, 0, len(t) - 1)
        near = np.where(np.abs(t[below] - d) <= np.abs(t[above] - d), below, above)
        return np.where(hi > lo, ((lo + hi - 1) / 2 + 0.5).astype(np.int64), near)

    def look(batches):
        for pdf in batches:
            d, step = pdf["dist"].to_numpy(float), np.minimum(np.searchsorted(steps, pdf["min_len"].to_numpy(float)), len(steps) - 1)
            out = np.zeros(len(pdf), np.int64)
            for i in np.unique(step).tolist():
                out[step == i] = found(d[step == i], tables[int(steps[i])])
            yield pdf.assign(real_gap=out)

    return edges.mapInPandas(look, f"{_keys(edges, edges.columns)}, real_gap long")
