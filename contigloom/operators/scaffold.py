"""Scaffold ordering, gap sizes and contraction.

One subgraph of contigs and edges is one task: the search is a best-first form of the bounded search over signed orders. Its budget is a number of states, so results do
not depend on a clock; a subgraph over the budget is retried with its weakest edges left out.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contigloom.operators.grouped import map_groups, numbered
from contigloom.runtime import ship


def discordant(order: list[tuple], lengths: dict, edges: list[tuple], k: int, n_sd: int) -> int:
    """Number of edges that an ordered list of (contig, orientation) does not satisfy: both ends in the order with the edge's orientations (or the order and both
    orientations reversed), and no more sequence between them than distance + n_sd deviations + k."""
    place, at, sign = {}, 0, {}
    for i, (c, o) in enumerate(order):
        place[c], sign[c] = (i, at, at + lengths[c]), o
        at += lengths[c] - k
    return sum(not _satisfied(e, place, sign, k, n_sd) for e in edges)


def _satisfied(e: tuple, place: dict, sign: dict, k: int, n_sd: int) -> bool:
    c1, o1, c2, o2, d, s = e
    if c1 not in place or c2 not in place:
        return False
    if place[c1][0] > place[c2][0]:
        c1, o1, c2, o2 = c2, "-" if o2 == "+" else "+", c1, "-" if o1 == "+" else "+"
    return sign[c1] == o1 and sign[c2] == o2 and place[c2][1] - place[c1][2] - k <= d + n_sd * s


def solve_order(contigs: list, lengths: dict, edges: list[tuple], k: int = 60, n_sd: int = 6, budget: int = 100_000) -> tuple[list[list[tuple]], int, bool]:
    """(scaffolds, discordant edges, exact): signed orders of the contigs with the fewest discordant edges.

    States are partial orders extended to the right; an edge is judged when its second end is placed. The queue goes by discordant edges, then by more contigs placed, then
    by the order itself. States with the same placed set and the same live end (contigs that still have open edges, with their places) are visited once.
    Stretches that no satisfied edge joins are scaffolds of their own.
    """
    by_contig = defaultdict(list)
    for e in edges:
        by_contig[e[0]].append(e)
        by_contig[e[2]].append(e)
    names = sorted(contigs)
    heap, seen, n_states, serial = [(0, -0, 0, (), 0)], set(), 0, 0
    while heap:
        cost, _, _, order, end = heapq.heappop(heap)
        if len(order) == len(names):
            return _split(order, lengths, edges, k, n_sd), cost, True
        placed = {c for c, _, _ in order}
        live = tuple((c, o, end - a) for c, o, a in order if any((e[2] if e[0] == c else e[0]) not in placed for e in by_contig[c]))
        key = (frozenset(placed), live)
        if key in seen:
            continue
        seen.add(key)
        n_states += 1
        if n_states > budget:
            return [], -1, False
        at = {c: (i, a, a + lengths[c]) for i, (c, o, a) in enumerate(order)}
        sign = {c: o for c, o, _ in order}
        reach: dict = {}
        for c in placed:
            for e in by_contig[c]:
                x = e[2] if e[0] == c else e[0]
                if x not in placed:
                    middle = abs(e[4] + (lengths[c] + lengths[x]) / 2)  # between the two contigs' middles
                    reach[x] = min(reach.get(x, middle), middle)
        near = sorted(reach, key=lambda x: (reach[x], x)) or sorted((c for c in names if c not in placed), key=lambda x: (len(by_contig[x]), x))
        for c in near:
            for o in "+-":
                at[c], sign[c] = (len(order), end, end + lengths[c]), o
                more = sum(not _satisfied(e, at, sign, k, n_sd) for e in by_contig[c] if (e[2] if e[0] == c else e[0]) in placed)
                serial += 1
                heapq.heappush(heap, (cost + more, -(len(order) + 1), serial, (*order, (c, o, end)), end + lengths[c] - k))
                del at[c], sign[c]
    return [], 0, True


def _split(order: tuple, lengths: dict, edges: list[tuple], k: int, n_sd: int) -> list[list[tuple]]:
    place = {c: (i, a, a + lengths[c]) for i, (c, o, a) in enumerate(order)}
    sign = {c: o for c, o, _ in order}
    bridge = [0] * len(order)
    for e in edges:
        if _satisfied(e, place, sign, k, n_sd):
            i, j = sorted((place[e[0]][0], place[e[2]][0]))
            for x in range(i, j):
                bridge[x] += 1
    out: list[list[tuple]] = [[]]
    for i, (c, o, _) in enumerate(order):
        out[-1].append((c, o))
        if i + 1 < len(order) and not bridge[i]:
            out.append([])
    return out


def nonnegative(m: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The x >= 0 that makes x.m.x / 2 - b.x least, m being positive semidefinite: the set of positive components grows by the steepest one and shrinks
    where a step would leave the positive side, so it ends at the exact solution."""
    x, free = np.zeros(len(b)), np.zeros(len(b), bool)
    scale = max(1.0, float(np.abs(b).max(initial=0)))
    for _ in range(10 * len(b) + 10):
        slope = np.where(free, -np.inf, b - m @ x)
        if not len(b) or slope.max() <= 1e-10 * scale:
            break
        free[slope.argmax()] = True
        while True:
            s = np.zeros(len(b))
            s[free] = np.linalg.lstsq(m[np.ix_(free, free)], b[free], rcond=None)[0]
            bad = free & (s <= 1e-14)
            if not bad.any():
                break
            with np.errstate(divide="ignore", invalid="ignore"):
                step = np.where(bad, x / (x - s), np.inf)
            x = x + min(1.0, float(np.nan_to_num(step[bad], nan=0.0).min())) * (s - x)
            free &= x > 1e-14
            x[~free] = 0
        x = s
    return x


def gap_qp(lengths: list[int], edges: list[tuple[int, int, float, float]], k: int = 60, n_sd: int = 6) -> np.ndarray:
    """Gap sizes of a chain by a convex quadratic program: each edge (i, j, d, s) wants the gaps from i to j plus the contigs between to be d, weighted by
    1 / s, with gaps of at least -k and spans of at most d + n_sd * s. Solved exactly by way of its dual.

    Limits that not even the least gaps meet cannot hold and are left out; those that are left always hold together. Gaps that no edge spans are 0.
    """
    n = len(lengths) - 1
    if n <= 0 or not edges:
        return np.zeros(max(n, 0))
    a, want, weight, limit = np.zeros((len(edges), n)), [], [], []
    for row, (i, j, d, s) in zip(a, edges):
        row[i:j] = 1
        mid = sum(lengths[i + 1 : j])
        want.append(d - mid)
        weight.append(1 / max(s, 1.0))
        limit.append(d + n_sd * s - mid)
    b, w, top = np.array(want, float), np.array(weight), np.array(limit, float)
    h = (a * (w**2)[:, None]).T @ a
    h += 1e-9 * max(1e-12, float(h.diagonal().max())) * np.eye(n)
    free = np.linalg.solve(h, a.T @ (w**2 * b))
    possible = a.sum(1) * -float(k) <= top
    c, e = np.vstack([np.eye(n), -a[possible]]), np.concatenate([np.full(n, -float(k)), -top[possible]])
    if (c @ free >= e - 1e-9).all():
        return free
    inverse = np.linalg.solve(h, c.T)
    push = nonnegative(c @ inverse, e - c @ free)
    g, tight = free + inverse @ push, push > 0
    # the same with the limits that hold as equations, without the rounding of the badly conditioned inverse
    start = np.linalg.lstsq(c[tight], e[tight], rcond=None)[0]
    _, size, turn = np.linalg.svd(c[tight])
    inner = turn[int((size > 1e-9).sum()) :].T
    near = start + inner @ np.linalg.lstsq(np.vstack([(a * w[:, None]) @ inner, 1e-6 * inner]), np.concatenate([w * (b - a @ start), -1e-6 * start]), rcond=None)[0] if inner.shape[1] else start
    return near if np.abs(near - g).max() < 1e-2 and (c @ near >= e - 1e-6).all() else g


def order_scaffolds(edges: DataFrame, contigs: DataFrame, subgraph: str = "subgraph", id: str = "id", length: str = "length", k: int = 60, n_sd: int = 6, budget: int = 100_000, step: int = 5) -> DataFrame:
    """subgraph, scaffold, pos, contig, ori, length, gap of every contig of every subgraph.

    edges: subgraph, c1, o1, c2, o2, dist, std, support. A subgraph over the budget is searched again without its edges of support below the least plus step, and so on.
    The first contig of an order is the smaller of its two ends' names (orders and their reverses are the same). gap: to the next contig, null for the last.
    """
    ship(edges.sparkSession)
    kind = dict(contigs.dtypes)[id]
    sub = dict(edges.dtypes)[subgraph]
    members = edges.select(F.col(subgraph).alias("_sub"), F.explode(F.array("c1", "c2")).alias(id)).distinct().join(contigs.select(id, F.col(length).cast("long").alias("_len")), id)

    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        columns = ["subgraph", "scaffold", "pos", "contig", "ori", "length", "gap"]
        lengths = dict(zip(right[id].tolist(), right["_len"].tolist()))
        rows = [t for t in left.sort_values(["c1", "c2", "o1", "o2", "dist"], kind="stable").itertuples() if t.c1 in lengths and t.c2 in lengths and t.c1 != t.c2]
        least = min((t.support for t in rows), default=0)
        while True:
            e = [(t.c1, t.o1, t.c2, t.o2, float(t.dist), float(t.std)) for t in rows if t.support >= least]
            found, _, exact = solve_order(list(lengths), lengths, e, k, n_sd, budget)
            if exact or not e:
                break
            least += step
        if not found and lengths:
            found = [[(c, "+")] for c in sorted(lengths)]
        out = []
        for order in found:
            if order[0][0] > order[-1][0] or (len(order) == 1 and order[0][1] == "-"):
                order = [(c, "-" if o == "+" else "+") for c, o in reversed(order)]
            place = {c: i for i, (c, _) in enumerate(order)}
            inner = [(*sorted((place[x[0]], place[x[2]])), x[4], x[5]) for x in e if x[0] in place and x[2] in place]
            gaps = [*np.floor(gap_qp([lengths[c] for c, _ in order], inner, k, n_sd) + 0.5).astype(int).tolist(), None]
            out += [(key[0], order[0][0], i + 1, c, o, lengths[c], gaps[i]) for i, (c, o) in enumerate(order)]
        return pd.DataFrame(out, columns=columns).astype({"gap": "Int64"})

    return edges.groupBy(subgraph).cogroup(members.groupBy("_sub")).applyInPandas(run, f"subgraph {sub}, scaffold {kind}, pos int, contig {kind}, ori string, length long, gap long")


def gap_sizes(scaffolds: DataFrame, edges: DataFrame, scaffold: str = "scaffold", k: int = 60, n_sd: int = 6) -> DataFrame:
    """scaffold, pos and gap (to the next child) of given scaffolds (scaffold, pos, contig, length), from the edges (c1, c2, dist, std) between their members.

    Only scaffolds with such an edge are solved; the gaps of the others are 0.
    """
    kind = dict(scaffolds.dtypes)[scaffold]
    s1, s2 = (scaffolds.select(F.col("contig").alias(f"c{i}"), F.col(scaffold).alias("scaffold"), F.col("pos").alias(f"p{i}")) for i in (1, 2))
    inner = edges.join(s1, "c1").join(s2, ["c2", "scaffold"]).filter("p1 <> p2").select("scaffold", "p1", "p2", F.col("dist").cast("double").alias("dist"), F.col("std").cast("double").alias("std"))

    def run(keys: tuple, rows: dict) -> list[tuple]:
        child = np.isnan(rows["p2"].astype(float))
        pos, lengths = rows["p1"][child].astype(int), rows["size"][child].astype(int).tolist()
        at = {p: i for i, p in enumerate(pos.tolist())}
        es = [(*sorted((at[int(a)], at[int(b)])), d, s) for a, b, d, s in zip(*(rows[c][~child].tolist() for c in ("p1", "p2", "dist", "std")))]
        return [(*keys, p, g) for p, g in zip(pos.tolist(), gap_qp(lengths, sorted(es), k, n_sd).round(3).tolist())]

    rows = scaffolds.select(F.col(scaffold).alias("scaffold"), F.col("pos").cast("int").alias("p1"), F.col("length").cast("long").alias("size"))
    bound = inner.select(F.col("scaffold").alias("_s")).distinct()
    rows, free = rows.join(bound, F.col("scaffold") == F.col("_s"), "left_semi"), rows.join(bound, F.col("scaffold") == F.col("_s"), "left_anti")
    last = F.max("p1").over(Window.partitionBy("scaffold"))
    zero = free.withColumn("_last", last).filter("p1 < _last").select("scaffold", F.col("p1").alias("pos"), F.lit(0.0).alias("gap"))
    both = rows.unionByName(inner.select("scaffold", F.col("p1").cast("int").alias("p1"), F.col("p2").cast("int").alias("p2"), "dist", "std"), allowMissingColumns=True)
    return map_groups(both, ["scaffold"], ["p1", "p2"], run, f"scaffold {kind}, pos int, gap double").unionByName(zero)


def contract(edges: DataFrame, scaffolds: DataFrame) -> DataFrame:
    """edges between scaffolds: each end is moved from its contig to the scaffold's end it points at; inner edges are left out.

    scaffolds: scaffold, pos, contig, ori, length, gap. The distance loses what lies between the contig and that end of its scaffold.
    """
    w = Window.partitionBy("scaffold").orderBy("pos")
    size = F.col("length") + F.coalesce("gap", F.lit(0))
    before = F.coalesce(F.sum(size).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum(size).over(Window.partitionBy("scaffold"))
    place = scaffolds.withColumns({"_before": before, "_after": total - before - F.col("length")}).select("contig", "scaffold", "ori", "_before", "_after")
    e = edges
    for i in (1, 2):
        e = e.join(place.select(F.col("contig").alias(f"c{i}"), F.col("scaffold").alias(f"s{i}"), F.col("ori").alias(f"w{i}"), F.col("_before").alias(f"b{i}"), F.col("_after").alias(f"a{i}")), f"c{i}")
    o = [F.when(F.col(f"w{i}") == "+", F.col(f"o{i}")).otherwise(F.when(F.col(f"o{i}") == "+", "-").otherwise("+")) for i in (1, 2)]
    e = e.filter("s1 <> s2").withColumns({"o1": o[0], "o2": o[1]})
    left = F.when(F.col("o1") == "+", F.col("a1")).otherwise(F.col("b1"))
    right = F.when(F.col("o2") == "+", F.col("b2")).otherwise(F.col("a2"))
    return e.select(F.col("s1").alias("c1"), "o1", F.col("s2").alias("c2"), "o2", (F.col("dist") - left - right).cast("long").alias("dist"), "std", "support")


def adjacent_repeat_correction(edges: DataFrame, ends: DataFrame) -> DataFrame:
    """edges whose two facing end contigs are the same repeat in the same orientation get that repeat's length added to their distance.

    ends: scaffold, side ('l' or 'r'), contig, ori, length, repeat.
    """
    a, b = (ends.filter("repeat").select(F.col("scaffold").alias(f"c{i}"), F.col("side").alias(f"_d{i}"), F.col("contig").alias(f"_e{i}"), F.col("ori").alias(f"_w{i}"), F.col("length").alias(f"_l{i}")) for i in (1, 2))
    d1, d2 = F.when(F.col("o1") == "+", "r").otherwise("l"), F.when(F.col("o2") == "+", "l").otherwise("r")
    e = edges.withColumns({"_d1": d1, "_d2": d2}).join(a, ["c1", "_d1"], "left").join(b, ["c2", "_d2"], "left")
    seen = [F.when(F.col(f"o{i}") == "+", F.col(f"_w{i}")).otherwise(F.when(F.col(f"_w{i}") == "+", "-").otherwise("+")) for i in (1, 2)]
    same = (F.col("_e1") == F.col("_e2")) & (seen[0] == seen[1])
    return e.withColumn("dist", F.col("dist") + F.when(same, F.col("_l1")).otherwise(0)).select(edges.columns)


def satisfied_repeat_edges(edges: DataFrame, placed: DataFrame, k: int = 60, n_sd: int = 6) -> DataFrame:
    """edges with satisfied: some pair of places of their contigs (repeats have several) fits orientation, order and distance.

    placed: scaffold, contig, ori, start (0-based), length.
    """
    what = ["c1", "c2", "o1", "o2", "dist", "std"]  # a number given to each edge would not be the same on both sides of the join below
    a, b = (placed.select("scaffold", F.col("contig").alias(f"c{i}"), F.col("ori").alias(f"w{i}"), F.col("start").alias(f"s{i}"), F.col("length").alias(f"l{i}")) for i in (1, 2))
    j = edges.select(*what).join(a, "c1").join(b, ["c2", "scaffold"])
    far = F.col("dist") + n_sd * F.col("std") + k
    onward = (F.col("w1") == F.col("o1")) & (F.col("w2") == F.col("o2")) & (F.col("s1") < F.col("s2")) & (F.col("s2") - F.col("s1") - F.col("l1") <= far)
    back = (F.col("w1") != F.col("o1")) & (F.col("w2") != F.col("o2")) & (F.col("s2") < F.col("s1")) & (F.col("s1") - F.col("s2") - F.col("l2") <= far)
    good = j.filter(onward | back).select(*what).distinct().withColumn("satisfied", F.lit(True))
    return edges.join(good, what, "left").select(*edges.columns, F.coalesce("satisfied", F.lit(False)).alias("satisfied"))


def scaffold_sequences(scaffolds: DataFrame, seqs: DataFrame, min_gap: int = 10, fillings: DataFrame | None = None) -> DataFrame:
    """scaffold and seq: children in order, reverse-complemented where '-', with max(gap, min_gap) N between them, or a filling (scaffold, pos, filling) that is not empty."""
    from contigloom.functions.sequence import reverse_complement

    j = scaffolds.join(seqs.select(F.col("id").alias("contig"), "seq"), "contig")
    if fillings is not None:
        j = j.join(fillings.select("scaffold", "pos", F.nullif(F.col("filling"), F.lit("")).alias("_filling")), ["scaffold", "pos"], "left")
    else:
        j = j.withColumn("_filling", F.lit(None).cast("string"))
    text = F.when(F.col("ori") == "-", reverse_complement(F.col("seq"), "upper")).otherwise(F.upper("seq"))
    last = F.lead("pos").over(Window.partitionBy("scaffold").orderBy("pos")).isNull()
    piece = F.concat(text, F.when(last, "").otherwise(F.coalesce(F.upper("_filling"), F.repeat(F.lit("N"), F.greatest(F.coalesce("gap", F.lit(0)), F.lit(min_gap)).cast("int")))))
    parts = j.withColumn("_piece", piece).groupBy("scaffold").agg(F.array_sort(F.collect_list(F.struct("pos", "_piece"))).alias("p"))
    return parts.select("scaffold", F.array_join(F.transform("p", lambda x: x["_piece"]), "").alias("seq"))


def sorted_scaffolds(scaffolds: DataFrame, scaffold: str = "scaffold") -> DataFrame:
    """scaffold, number (1 for the longest), length and n: total of lengths and gaps; equal lengths go by name."""
    sums = scaffolds.groupBy(scaffold).agg(F.sum(F.col("length") + F.coalesce("gap", F.lit(0))).cast("long").alias("length"), F.count("*").alias("n"))
    return numbered(sums, [F.col("length").desc(), scaffold]).withColumn("number", F.col("number").cast("int"))


def fillable(scaffolds: DataFrame, scaffold: str = "scaffold", min_len: int = 499) -> DataFrame:
    """scaffold, n and total_len of scaffolds with gaps to fill: more than one contig, longer than min_len."""
    sums = scaffolds.groupBy(scaffold).agg(F.count("*").alias("n"), F.sum("length").cast("long").alias("total_len"))
    return sums.filter((F.col("n") > 1) & (F.col("total_len") > min_len))
