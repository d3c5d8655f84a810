"""Merge trees of contig graphs, their model-based cut, and reference-guided super-clusters. Trees are built per connected component."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contigloom.operators.graph import connected_components
from contigloom.operators.grouped import numbered
from contigloom.runtime import keep, ship


def with_component(edges: DataFrame, c1: str = "c1", c2: str = "c2") -> DataFrame:
    """edges with the component of their ends."""
    found = connected_components(edges.select(F.col(c1).alias("a"), F.col(c2).alias("b")))
    return edges.join(found.select(F.col("vertex").alias(c1), "component"), c1)


def merge_order(c1: np.ndarray, c2: np.ndarray, weight: np.ndarray) -> list[tuple[int, int, float, int]]:
    """Single-linkage merges (left, right, weight, size) of vertices 0..n-1; node i of the list has the number n + i. Edges go by weight, then ends."""
    n = int(max(c1.max(initial=-1), c2.max(initial=-1))) + 1
    parent, node, size = list(range(n)), list(range(n)), [1] * n
    out = []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for e in np.lexsort((c2, c1, weight)):
        a, b = root(int(c1[e])), root(int(c2[e]))
        if a != b:
            out.append((node[a], node[b], float(weight[e]), size[a] + size[b]))
            parent[b] = a
            node[a], size[a] = n + len(out) - 1, size[a] + size[b]
    return out


def single_linkage_tree(edges: DataFrame, weight: str = "weight", c1: str = "c1", c2: str = "c2") -> DataFrame:
    """component, merge, left, right, weight, size of every merge of each component's single-linkage tree.

    left and right are the smallest contigs of the two sides. Components come from the distributed loop; the tree of one component is sequential by
    nature and is built by one task from its edges alone.
    """
    ship(edges.sparkSession)
    rows = with_component(edges.select(F.col(c1).alias("c1"), F.col(c2).alias("c2"), F.col(weight).cast("double").alias("w")))
    kind = dict(rows.dtypes)["c1"]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        names = np.unique(np.concatenate([pdf["c1"], pdf["c2"]]))
        a, b = np.searchsorted(names, pdf["c1"]), np.searchsorted(names, pdf["c2"])
        first = list(range(len(names)))
        out = []
        for i, (x, y, w, size) in enumerate(merge_order(np.minimum(a, b), np.maximum(a, b), pdf["w"].to_numpy())):
            lo, hi = sorted((first[x], first[y]))
            first.append(lo)
            out.append((pdf["component"].iloc[0], i + 1, names[lo], names[hi], w, size))
        return pd.DataFrame(out, columns=["component", "merge", "left", "right", "weight", "size"])

    return rows.groupBy("component").applyInPandas(run, f"component {kind}, merge int, left {kind}, right {kind}, weight double, size int")


def log_nb(k: np.ndarray, mean: float, r: float) -> np.ndarray:
    k = np.floor(k + 0.5)
    lg = np.vectorize(math.lgamma, otypes=[float])
    return r * math.log(r / (r + mean)) + lg(r + k) + k * math.log(mean / (r + mean)) - lg(k + 1) - math.lgamma(r)


def log_poisson(k: np.ndarray, mean: float, r: float) -> np.ndarray:
    mean = math.floor(mean + 0.5)
    return k * math.log(mean) - mean - np.vectorize(math.lgamma, otypes=[float])(k + 1) if mean > 0 else np.where(k > 0, -np.inf, 0.0)


MODELS = {"negative_binomial": log_nb, "poisson": log_poisson}


def cut(merges: list[tuple[int, int, float, int]], counts: list[np.ndarray], lengths: np.ndarray, win: int, r: float, penalty_n: float, model: str = "negative_binomial") -> np.ndarray:
    """Cluster number of each leaf: a node is one cluster if its model score is not below the best of its sides together.

    counts[leaf]: (samples, windows). Score: log-likelihood of all windows under the node's mean arrival rate in each sample, less half the samples
    times ln(penalty_n).
    """
    n, samples = len(counts), counts[0].shape[0]
    logpf = MODELS[model]
    # of each node: its length and, by sample, the distinct window counts and how often they stand; a node of a merge has those of its sides added
    size = [float(x) for x in lengths]
    seen = [[np.unique(c, return_counts=True) for c in leaf] for leaf in counts]

    def score(node: int) -> float:
        total = -0.5 * samples * math.log(max(penalty_n, 1.0))
        for distinct, times in seen[node]:
            mean = float((distinct * times).sum()) / size[node] * win
            if mean > 0:
                total += float((logpf(distinct.astype(float), mean, r) * times).sum())
        return total

    def added(one: tuple, two: tuple) -> tuple:
        distinct, at = np.unique(np.concatenate([one[0], two[0]]), return_inverse=True)
        return distinct, np.bincount(at, np.concatenate([one[1], two[1]]))

    best, whole = [score(i) for i in range(n)], [True] * n
    for i, (a, b, _, _) in enumerate(merges):
        size.append(size[a] + size[b])
        seen.append([added(x, y) for x, y in zip(seen[a], seen[b])])
        seen[a] = seen[b] = []  # read no more
        joint, apart = score(n + i), best[a] + best[b]
        whole.append(joint >= apart)
        best.append(max(joint, apart))
    out, number = np.full(n, -1), 0
    below = {x for a, b, _, _ in merges for x in (a, b)}
    stack = sorted((x for x in range(n + len(merges)) if x not in below), reverse=True)
    while stack:
        x = stack.pop()
        if whole[x]:
            below_x = [x]
            while below_x:
                y = below_x.pop()
                if y < n:
                    out[y] = number
                else:
                    below_x += merges[y - n][:2]
            number += 1
        else:
            stack += [merges[x - n][1], merges[x - n][0]]
    return out


def cut_tree(edges: DataFrame, windows: DataFrame, win: int, r: float, penalty_n: float, weight: str = "weight", model: str = "negative_binomial") -> DataFrame:
    """contig, component and cluster (its smallest contig): the single-linkage trees of edges (c1, c2, weight) cut by model score.

    windows: contig, sample, counts (array), length (modified). Contigs without edges are clusters of their own.
    """
    ship(edges.sparkSession)
    e = with_component(edges.select("c1", "c2", F.col(weight).cast("double").alias("w")))
    kind = dict(e.dtypes)["c1"]
    members = e.select(F.col("component"), F.explode(F.array("c1", "c2")).alias("contig")).distinct()
    w = windows.select("contig", "sample", "counts", "length")
    data = w.join(members, "contig").select("contig", "sample", "counts", "length", F.col("component").alias("_component"))

    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        columns = ["contig", "component", "cluster"]
        if not len(right):
            return pd.DataFrame([], columns=columns)
        names = np.unique(right["contig"])
        samples = sorted(right["sample"].unique())
        table = {(c, s): np.asarray(v, float) for c, s, v in zip(right["contig"], right["sample"], right["counts"])}
        counts = [np.stack([table[c, s] for s in samples]) for c in names]
        lengths = right.groupby("contig")["length"].first().loc[names].to_numpy(float)
        known = left[left["c1"].isin(names) & left["c2"].isin(names)]
        a, b = np.searchsorted(names, known["c1"]), np.searchsorted(names, known["c2"])
        merges = merge_order(np.minimum(a, b), np.maximum(a, b), known["w"].to_numpy()) if len(known) else []
        n = int(max(a.max(initial=-1), b.max(initial=-1))) + 1
        shift = len(names) - n  # merge_order numbers nodes after the last vertex that an edge names
        merges = [tuple(x + shift if x >= n else x for x in m[:2]) + m[2:] for m in merges]
        label = cut(merges, counts, lengths, win, r, penalty_n, model)
        first = {k: names[label == k].min() for k in set(label.tolist())}
        return pd.DataFrame({"contig": names, "component": key[0], "cluster": [first[k] for k in label.tolist()]})

    solved = e.groupBy("component").cogroup(data.groupBy("_component")).applyInPandas(run, f"contig {kind}, component {kind}, cluster {kind}")
    lone = w.select("contig").distinct().join(members.select("contig"), "contig", "left_anti")
    return solved.union(lone.select("contig", F.col("contig").alias("component"), F.col("contig").alias("cluster")))


def search_r(edges: DataFrame, windows: DataFrame, win: int, r_lo: float, r_hi: float, penalty_n: float, steps: int = 10, max_len: int = 6_000_000, tol: float = 0.01) -> tuple[float, DataFrame]:
    """The first r of a grid from r_lo to r_hi whose clusters are sound, and the clusters: r above 1, outliers below tol of all length and of the worst cluster, no cluster
    above max_len; the last r if none is. Coverage of a contig: mean window count over win."""
    from contigloom.operators.coverage import outlier_fraction

    cover = keep(windows.groupBy("contig").agg(F.first("length").alias("length"), F.avg(F.aggregate("counts", F.lit(0.0), lambda a, x: a + x) / F.greatest(F.size("counts"), F.lit(1)) / win).alias("coverage")), "coverage")
    for i in range(steps + 1):
        r = r_lo + (r_hi - r_lo) * i / steps
        clusters = keep(cut_tree(edges, windows, win, max(r, 1e-6), penalty_n), "clusters")
        o = outlier_fraction(clusters.join(cover, "contig"), "cluster", "length", "coverage")
        s = o.agg(F.sum("outlier_len").alias("out"), F.sum("total_len").alias("all"), F.max("total_len").alias("longest"), F.max(F.when(F.col("counted"), F.col("fraction"))).alias("worst")).first()
        if r > 1 and (s["out"] or 0) < tol * (s["all"] or 1) and (s["longest"] or 0) < max_len and (s["worst"] or 0.0) < tol:
            break
    return r, clusters


def super_clusters(edges: DataFrame, references: DataFrame, weight: str = "weight") -> DataFrame:
    """cluster and super_cluster (smallest member): clusters (c1, c2, weight) merged greedily by weight, while the merged side's references stay non-empty.

    references: cluster, refs (array). A merge keeps the references both sides share. The order is weight, c1, c2; one component is one task.
    """
    ship(edges.sparkSession)
    e = with_component(edges.select("c1", "c2", F.col(weight).cast("double").alias("w")))
    kind = dict(e.dtypes)["c1"]
    members = e.select("component", F.explode(F.array("c1", "c2")).alias("cluster")).distinct()
    data = references.join(members, "cluster").select(F.col("component").alias("_component"), "cluster", "refs")

    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        refs = {c: set(r if r is not None else ()) for c, r in zip(right["cluster"], right["refs"])}
        for c in (*left["c1"], *left["c2"]):
            refs.setdefault(c, set())
        top = {c: c for c in refs}

        def root(x):
            while top[x] != x:
                x = top[x]
            return x

        for row in left.sort_values(["w", "c1", "c2"], kind="stable").itertuples():
            a, b = sorted((root(row.c1), root(row.c2)))
            if a != b and (both := refs[a] & refs[b]):
                top[b], refs[a] = a, both
        return pd.DataFrame([(c, root(c)) for c in sorted(refs)], columns=["cluster", "super_cluster"])

    solved = e.groupBy("component").cogroup(data.groupBy("_component")).applyInPandas(run, f"cluster {kind}, super_cluster {kind}")
    lone = references.select("cluster").distinct().join(members.select("cluster"), "cluster", "left_anti")
    return solved.union(lone.select("cluster", F.col("cluster").alias("super_cluster")))


def single_linkage_cut(distances: DataFrame, threshold: float = 0.05, a: str = "a", b: str = "b", dist: str = "dist", inclusive: bool = False) -> DataFrame:
    """vertex and component of single-linkage clusters cut at a threshold: components over the pairs below it."""
    near = F.col(dist) <= threshold if inclusive else F.col(dist) < threshold
    lone = distances.select(F.explode(F.array(a, b)).alias("vertex")).distinct()
    found = connected_components(distances.filter(near).select(F.col(a).alias("a"), F.col(b).alias("b")))
    return lone.join(found, "vertex", "left").select("vertex", F.coalesce("component", "vertex").alias("component"))


def tree_roots(nodes: DataFrame, id: str = "id", left: str = "left", right: str = "right") -> DataFrame:
    """Nodes of a stored tree that are no other node's son."""
    sons = nodes.select(F.explode(F.array(left, right)).alias(id)).filter(F.col(id).isNotNull())
    return nodes.join(sons, id, "left_anti")


def relabel(members: DataFrame, supers: DataFrame, cluster: str = "cluster") -> DataFrame:
    """members with the super-cluster of their cluster, or the cluster itself."""
    return members.join(supers.select(F.col("cluster").alias(cluster), "super_cluster"), cluster, "left").withColumn("super_cluster", F.coalesce("super_cluster", cluster))


def dense_ids(df: DataFrame, by: str, name: str = "number") -> DataFrame:
    """df with dense numbers of the distinct values of by, in their order (numbered over the distinct values, not over the rows)."""
    numbers = numbered(df.select(by).distinct(), [by], name)
    return df.join(numbers, by)


def border_subgraphs(edges: DataFrame, contigs: DataFrame, id: str = "id", length: str = "length", bound: int = 10_000) -> DataFrame:
    """edges with subgraph: components in which contigs longer than bound do not pass from one end to the other.

    A long contig is two vertices, one for each end; an edge leaves c1 at its right end for o1 '+', else at the left, and reaches c2 the other way round.
    """
    size = contigs.select(F.col(id).cast("string").alias("c"), (F.col(length) > bound).alias("long"))
    e = edges.withColumns({"_a": F.col("c1").cast("string"), "_b": F.col("c2").cast("string")})
    e = e.join(size.select(F.col("c").alias("_a"), F.col("long").alias("_la")), "_a").join(size.select(F.col("c").alias("_b"), F.col("long").alias("_lb")), "_b")
    a = F.when(F.col("_la"), F.concat("_a", F.when(F.col("o1") == "+", ":r").otherwise(":l"))).otherwise(F.col("_a"))
    b = F.when(F.col("_lb"), F.concat("_b", F.when(F.col("o2") == "+", ":l").otherwise(":r"))).otherwise(F.col("_b"))
    e = e.withColumns({"_va": a, "_vb": b})
    found = connected_components(e.select(F.col("_va").alias("a"), F.col("_vb").alias("b")))
    return e.join(found.select(F.col("vertex").alias("_va"), F.col("component").alias("subgraph")), "_va").select(*edges.columns, "subgraph")
