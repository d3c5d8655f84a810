"""Contig-pair edges: construction, codes, filters and bundles.

An edge row is c1, o1, c2, o2 (orientations '+' or '-'), dist, std, support.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed values: (library, lowest and highest distance) of the long-read strata.
DISTANCE_BUCKETS = ((0, -200, 300), (1, 300, 1000), (2, 1000, 2000), (3, 2000, 5000), (4, 5000, 15_000), (5, 15_000, 40_000))


def flip(o: Column) -> Column:
    return F.when(o == "+", "-").when(o == "-", "+")


def orientation_of(code: Column) -> Column:
    """'+' for BE, '-' for EB."""
    return F.when(code == "BE", "+").when(code == "EB", "-")


def canonical_edges(edges: DataFrame) -> DataFrame:
    """Edges with c1 <= c2: swapped edges have their ends exchanged and orientations flipped."""
    swap = F.col("c1") > F.col("c2")
    o1, o2 = F.when(swap, flip(F.col("o2"))).otherwise(F.col("o1")), F.when(swap, flip(F.col("o1"))).otherwise(F.col("o2"))
    return edges.withColumns({"c1": F.least("c1", "c2"), "c2": F.greatest("c1", "c2"), "o1": o1, "o2": o2})


def edge_id(a: Column, b: Column) -> Column:
    """Names in order, joined by '-vs-'."""
    return F.concat_ws("-vs-", F.least(a, b), F.greatest(a, b))


def gap_distance(re1: Column, rs2: Column, cs2: Column, cl1: Column, ce1: Column, stretch: float = 0.09) -> Column:
    """Distance of two contigs on a read: the stretched read gap less both contigs' unaligned ends; truncated toward zero."""
    gap = rs2 - re1
    return (gap + F.abs(gap) * stretch).cast("int") - cs2 - (cl1 - ce1)


def distance_std(d: Column) -> Column:
    return (F.abs(d) * 0.1 + 50).cast("int")


def distance_bucket(d: Column, strict: bool = False) -> Column:
    """Stratum of a distance, in [low, high); strict leaves the lower bounds out too. Null outside."""
    out = F.lit(None).cast("int")
    for lib, low, high in DISTANCE_BUCKETS:
        inside = (d > low if strict or lib == 0 else d >= low) & (d < high)
        out = F.when(inside, F.lit(lib)).otherwise(out)
    return out


def validate_edges(edges: DataFrame, contigs: DataFrame, id: str = "id", k: int = 60, min_support: int = 2, n_sd: int = 6) -> DataFrame:
    """edges with skip_code: 0 for valid edges, else 1 (an unknown end) + 3 (support) + 5 (distance); 7 for an edge of a contig with itself.

    A distance is possible if it is not negative or dist + n_sd * std + k is positive.
    """
    ends = contigs.select(F.col(id).alias("_id")).distinct()
    known1, known2 = (ends.withColumnRenamed("_id", f"_k{i}") for i in (1, 2))
    e = edges.join(known1, F.col("c1") == F.col("_k1"), "left").join(known2, F.col("c2") == F.col("_k2"), "left")
    unknown = F.col("_k1").isNull() | F.col("_k2").isNull()
    weak = F.col("support") < min_support
    far = ~((F.col("dist") >= 0) | (F.col("dist") + n_sd * F.col("std") + k > 0))
    code = F.when(unknown, 1).otherwise(0) + F.when(weak, 3).otherwise(0) + F.when(far, 5).otherwise(0)
    return e.withColumn("skip_code", F.when((code == 0) & (F.col("c1") == F.col("c2")), 7).otherwise(code)).drop("_k1", "_k2")


def intra_cluster_edges(edges: DataFrame, clusters: DataFrame, id: str = "contig", cluster: str = "cluster") -> DataFrame:
    """Edges whose ends lie in one cluster."""
    a, b = (clusters.select(F.col(id).alias(f"c{i}"), F.col(cluster).alias(f"_cl{i}")) for i in (1, 2))
    return edges.join(a, "c1").join(b, "c2").filter("_cl1 = _cl2").withColumnRenamed("_cl1", "cluster").drop("_cl2")


def scaffold_edges(edges: DataFrame, contigs: DataFrame, lib_mean: float, lib_std: float, id: str = "id", threshold: int = 5, k: int = 60, n_sd: int = 6, small: str = "small", repeat: str = "repeat") -> DataFrame:
    """Edges fit for scaffolding: support, a possible and not too long distance, no small end and not two repeats."""
    a, b = (contigs.select(F.col(id).alias(f"c{i}"), F.col(small).alias(f"_s{i}"), F.col(repeat).alias(f"_r{i}")) for i in (1, 2))
    e = edges.withColumn("std", F.when(F.col("std") == 0, 1).otherwise(F.col("std"))).join(a, "c1").join(b, "c2")
    sd = n_sd * F.col("std")
    ok = (F.col("support") >= threshold) & (F.col("dist") + sd + k - 1 >= 0) & (F.col("dist") - sd <= lib_mean + n_sd * lib_std) & ~F.col("_s1") & ~F.col("_s2") & ~(F.col("_r1") & F.col("_r2"))
    return e.filter(ok).drop("_s1", "_s2", "_r1", "_r2")


def read_pair_edges(alignments: DataFrame, read: str, order: str, vertex: str, keep_cols: list[str] | None = None) -> DataFrame:
    """All pairs of alignments on one read, the first before the second by order, on different contigs, as canonical pairs: read, c1, c2.

    An equi-join on the read; adaptive execution splits reads with very many alignments.
    """
    extra = keep_cols or []
    a = alignments.select(F.col(read).alias("read"), F.col(order).alias("_o1"), F.col(vertex).alias("_v1"), *(F.col(c).alias(f"{c}_1") for c in extra))
    b = alignments.select(F.col(read).alias("read"), F.col(order).alias("_o2"), F.col(vertex).alias("_v2"), *(F.col(c).alias(f"{c}_2") for c in extra))
    pairs = a.join(b, "read").filter((F.col("_o1") < F.col("_o2")) & (F.col("_v1") != F.col("_v2")))
    return pairs.withColumns({"c1": F.least("_v1", "_v2"), "c2": F.greatest("_v1", "_v2")}).drop("_v1", "_v2", "_o1", "_o2")


def pair_support(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("c1", "c2").agg(F.count("*").alias("support"))


def pair_edges(pairs: DataFrame, mean: Column, read_length: Column) -> DataFrame:
    """Read pairs on two contigs (c1, p1, s1, l1, c2, p2, s2, l2: contig, 0-based start, strand, contig length, and library orientation lib)
    as edges: orientations and distance, the library mean less what the two contigs hold.

    The four orientations of a library say on which strands mates of one fragment lie: in (+-), out (-+), forward1 and forward2 (++).
    """
    turn1 = F.col("lib").isin("out", "forward2")
    turn2 = F.col("lib").isin("in", "forward2")
    o1 = F.when(turn1, flip(F.col("s1"))).otherwise(F.col("s1"))
    o2 = F.when(turn2, flip(F.col("s2"))).otherwise(F.col("s2"))
    used1 = F.when(o1 == "+", F.col("l1") - F.col("p1")).otherwise(F.col("p1") + read_length)
    used2 = F.when(o2 == "+", F.col("p2") + read_length).otherwise(F.col("l2") - F.col("p2"))
    return canonical_edges(pairs.withColumns({"o1": o1, "o2": o2, "dist": (mean - used1 - used2).cast("int")}))


def filter_edge_ratio(edges: DataFrame, cov: DataFrame, by: str = "lib", id: str = "id", coverage: str = "coverage", n_sd: float = 1.5, eps: float = 1e-4) -> DataFrame:
    """edges with ratio = ln(support / (least coverage of the ends + eps)) and keep: ratio above median - n_sd * deviation of its library, support above 1.

    Median and population deviation are over edges of support above 1; a library without such an edge keeps nothing.
    """
    a, b = (cov.select(F.col(id).alias(f"c{i}"), F.col(coverage).alias(f"_v{i}")) for i in (1, 2))
    e = edges.join(a, "c1").join(b, "c2").withColumn("ratio", F.log(F.col("support") / (F.least("_v1", "_v2") + eps))).drop("_v1", "_v2")
    s = e.filter("support > 1").groupBy(by).agg(F.median("ratio").alias("_m"), F.stddev_pop("ratio").alias("_s"))
    return e.join(s, by, "left").withColumn("keep", F.coalesce((F.col("ratio") > F.col("_m") - n_sd * F.col("_s")) & (F.col("support") > 1), F.lit(False))).drop("_m", "_s")


def cluster_repeats(cov: DataFrame, clusters: DataFrame, id: str = "contig", cluster: str = "cluster", coverage: str = "coverage", factor: float = 1.5) -> DataFrame:
    """Contigs covered more than factor times their cluster's median: contig, cluster, coverage, median."""
    c = clusters.select(id, cluster).join(cov.select(id, coverage), id)
    m = c.groupBy(cluster).agg(F.median(coverage).alias("median"))
    return c.join(m, cluster).filter(F.col(coverage) > factor * F.col("median"))


def filter_cluster_repeats(edges: DataFrame, cov: DataFrame, clusters: DataFrame, id: str = "contig", cluster: str = "cluster", coverage: str = "coverage", factor: float = 1.5) -> DataFrame:
    """Edges between clustered contigs, none of them a repeat of its cluster."""
    fine = clusters.select(id).distinct().join(cluster_repeats(cov, clusters, id, cluster, coverage, factor).select(id), id, "left_anti")
    return edges.join(fine.withColumnRenamed(id, "c1"), "c1", "left_semi").join(fine.withColumnRenamed(id, "c2"), "c2", "left_semi")


def flag_repeats(contigs: DataFrame, length: str = "length", coverage: str = "coverage", ploidy: int = 1, haploid: float | None = None) -> DataFrame:
    """contigs with repeat: covered more than haploid * (ploidy + 0.5); the haploid coverage is the length-weighted mean over ploidy unless given."""
    if haploid is not None:
        return contigs.withColumn("repeat", F.col(coverage) > haploid * (ploidy + 0.5))
    mean = contigs.agg((F.sum(F.col(coverage) * F.col(length)) / F.sum(length) / ploidy).alias("_haploid"))
    return contigs.crossJoin(F.broadcast(mean)).withColumn("repeat", F.col(coverage) > F.col("_haploid") * (ploidy + 0.5)).drop("_haploid")


def unpaired_ploidy(edges: DataFrame, contigs: DataFrame, haploid: float, ploidy: int, id: str = "id", coverage: str = "coverage") -> DataFrame:
    """Edges of contigs with equal copy numbers; above ploidy 2 also of coverages within half a haploid coverage."""
    a, b = (contigs.select(F.col(id).alias(f"c{i}"), F.col(coverage).alias(f"_v{i}")) for i in (1, 2))
    e = edges.join(a, "c1").join(b, "c2")
    copies = [F.round(F.col(f"_v{i}") / haploid) for i in (1, 2)]
    near = F.abs(F.col("_v1") - F.col("_v2")) <= 0.5 * haploid if ploidy > 2 else F.lit(True)
    return e.filter((copies[0] == copies[1]) & near).drop("_v1", "_v2")


def alignment_class(cs: Column, ce: Column, cl: Column, rs: Column, re: Column, rl: Column, frac: float = 0.9, overlap: int = 200) -> Column:
    """contig-contained, read-contained, contig-at-start, contig-at-end or partial-match; the first that fits."""
    span_c, span_r = ce - cs, re - rs
    return (
        F.when((span_c >= frac * cl) | (span_c >= cl - overlap), "contig-contained")
        .when((span_r >= frac * rl) | (span_r >= rl - overlap), "read-contained")
        .when((rs <= overlap) & (cl - ce <= overlap), "contig-at-start")
        .when((rl - re <= overlap) & (cs <= overlap), "contig-at-end")
        .otherwise("partial-match")
    )


def alignment_gate(cl: Column, cs: Column, ce: Column, rs: Column, re: Column, min_contig: int = 500, min_gap: int = 100, mapped: float = 0.8, min_span: int = 400) -> Column:
    """use, gap-fill (short contigs above min_gap mapped well) or drop."""
    return F.when(cl < min_contig, F.when((cl > min_gap) & (ce - cs >= mapped * cl), "gap-fill").otherwise("drop")).when(re - rs < min_span, "drop").otherwise("use")


def relative_rate_distance(edges: DataFrame, rates: DataFrame, id: str = "id", rate: str = "rate", sample: str = "sample") -> DataFrame:
    """edges (c1, c2) with weight: the largest over samples of (hi - lo) / hi of the ends' rates; 0 / 0 counts as 0."""
    a, b = (rates.select(F.col(id).alias(f"c{i}"), sample, F.col(rate).alias(f"_r{i}")) for i in (1, 2))
    e = edges.select("c1", "c2").join(a, "c1").join(b, ["c2", sample])
    hi = F.greatest("_r1", "_r2")
    return e.groupBy("c1", "c2").agg(F.max(F.when(hi == 0, 0.0).otherwise(F.try_divide(hi - F.least("_r1", "_r2"), hi))).alias("weight"))


def average_rate_distance(edges: DataFrame, rates: DataFrame, id: str = "id", rate: str = "rate", sample: str = "sample") -> DataFrame:
    """As relative_rate_distance, with the mean over samples in which an end has a rate above 0."""
    a, b = (rates.select(F.col(id).alias(f"c{i}"), sample, F.col(rate).alias(f"_r{i}")) for i in (1, 2))
    e = edges.select("c1", "c2").join(a, "c1").join(b, ["c2", sample])
    hi = F.greatest("_r1", "_r2")
    w = F.when(hi > 0, (hi - F.least("_r1", "_r2")) / hi)
    return e.groupBy("c1", "c2").agg(F.coalesce(F.try_divide(F.sum(w), F.count_if(hi > 0)), F.lit(0.0)).alias("weight"))


def adjacent_pairs(scaffolds: DataFrame, edges: DataFrame, scaffold: str, order: list, contig: str) -> DataFrame:
    """Neighbours in a scaffold joined to their edge in either direction: scaffold, a, b and the edge's columns (null without)."""
    w = Window.partitionBy(scaffold).orderBy(*order)
    pairs = scaffolds.select(scaffold, F.col(contig).alias("a"), F.lead(contig).over(w).alias("b")).filter("b is not null")
    return pairs.withColumns({"c1": F.least("a", "b"), "c2": F.greatest("a", "b")}).join(edges, ["c1", "c2"], "left")


def circular(scaffolds: DataFrame, edges: DataFrame, scaffold: str, pos: str, contig: str, ori: str, length: str, min_len: int = 1000, min_support: int = 2) -> DataFrame:
    """Scaffolds whose last contig has an edge back to their first: total length above min_len, support of at least min_support, the ends' orientations as in the scaffold."""
    ends = scaffolds.groupBy(scaffold).agg(
        F.sum(length).alias("total_len"), F.count("*").alias("n"), *(f(F.struct(F.col(contig).alias("c"), F.col(ori).alias("o")), pos).alias(name) for f, name in ((F.min_by, "first"), (F.max_by, "last"))))
    ends = ends.filter((F.col("total_len") > min_len) & (F.col("first.c") != F.col("last.c")))
    # from the last contig to the first, read in the edge's canonical direction
    wanted = ends.select(scaffold, "total_len", F.col("last.c").alias("c1"), F.col("last.o").alias("o1"), F.col("first.c").alias("c2"), F.col("first.o").alias("o2"))
    return canonical_edges(wanted).join(canonical_edges(edges).filter(F.col("support") >= min_support), ["c1", "o1", "c2", "o2"])


def conflicting_edges(edges: DataFrame, lengths: DataFrame, id: str = "id", length: str = "length", k: int = 60, n_sd: int = 6) -> DataFrame:
    """Pairs of edges at one end of a contig whose far contigs would overlap by more than 2 k even at extreme distances: id1, id2, contig, o.

    edges: id, c1, o1, c2, o2, dist, std. Each edge is seen from both ends; the join is on (contig, end).
    """
    rev = edges.select("id", F.col("c2").alias("c1"), flip(F.col("o2")).alias("o1"), F.col("c1").alias("c2"), "dist", "std")
    seen = edges.select("id", "c1", "o1", "c2", "dist", "std").union(rev).join(lengths.select(F.col(id).alias("c2"), F.col(length).alias("len")), "c2")
    a, b = (seen.select(F.col("id").alias(f"id{i}"), F.col("c1").alias("contig"), F.col("o1").alias("o"), F.col("len").alias(f"len{i}"), F.col("dist").alias(f"d{i}"), F.col("std").alias(f"s{i}"), F.col("c2").alias(f"far{i}")) for i in (1, 2))
    p = a.join(b, ["contig", "o"]).filter("id1 < id2 and far1 <> far2")

    def overlap(dx: Column, lx: Column, dy: Column, ly: Column) -> Column:
        return F.least(dx + lx, dy + ly) - F.greatest(dx, dy)

    far1 = overlap(F.col("d1") + n_sd * F.col("s1"), F.col("len1"), F.col("d2") - n_sd * F.col("s2"), F.col("len2"))
    far2 = overlap(F.col("d1") - n_sd * F.col("s1"), F.col("len1"), F.col("d2") + n_sd * F.col("s2"), F.col("len2"))
    return p.filter((far1 > 2 * k) & (far2 > 2 * k)).select("id1", "id2", "contig", "o")


def reference_supported(pairs: DataFrame, coords: DataFrame, dist: str = "dist", std: str = "std", n_sd: int = 3, max_pct: float = 150.0, ref_len: int | None = None) -> DataFrame:
    """Edges whose distance agrees with the contigs' places on a reference: pairs (c1, c2, dist, std) and coords (contig, ref, s, e, pct).

    Contigs mapped to a reference with more than max_pct percent in total are repeats there and support nothing. With ref_len the distance may also
    run round a circular reference.
    """
    fine = coords.join(coords.groupBy("contig", "ref").agg(F.sum("pct").alias("_pct")).filter(F.col("_pct") <= max_pct), ["contig", "ref"])
    a, b = (fine.select(F.col("contig").alias(f"c{i}"), "ref", F.col("s").alias(f"s{i}"), F.col("e").alias(f"e{i}")) for i in (1, 2))
    j = pairs.join(a, "c1").join(b, ["c2", "ref"])
    gap = F.greatest("s1", "s2") - F.least("e1", "e2")
    near = F.abs(gap - F.col(dist)) <= n_sd * F.col(std)
    if ref_len:
        near = near | (F.abs(F.least("s1", "s2") + ref_len - F.greatest("e1", "e2") - F.col(dist)) <= n_sd * F.col(std))
    return j.filter(near).select(*pairs.columns, "ref").distinct()


def extract_species_edges(edges: DataFrame, members: DataFrame, id: str = "contig", coverage: str = "coverage", lo: float = 0.0, hi: float = 1000.0) -> DataFrame:
    """Edges between members covered within (lo, hi): of support 2 or more, or of support 1 where the edge is marked as rescued; with their distance stratum."""
    fine = members.filter((F.col(coverage) > lo) & (F.col(coverage) < hi)).select(id).distinct()
    e = edges.join(fine.withColumnRenamed(id, "c1"), "c1", "left_semi").join(fine.withColumnRenamed(id, "c2"), "c2", "left_semi")
    ok = F.when(F.col("rescued"), F.col("support") == 1).otherwise(F.col("support") >= 2) if "rescued" in edges.columns else F.col("support") >= 2
    return e.filter(ok).withColumn("stratum", distance_bucket(F.col("dist")))


def cross_cluster_short_edges(edges: DataFrame, clusters: DataFrame, id: str = "contig", cluster: str = "cluster", most: int = 500, min_support: int = 5) -> DataFrame:
    """Well supported short edges (|dist| <= most) between different clusters: the edge's columns, cluster1, cluster2 and pair, both clusters in order."""
    a, b = (clusters.select(F.col(id).alias(f"c{i}"), F.col(cluster).alias(f"cluster{i}")) for i in (1, 2))
    e = edges.join(a, "c1").join(b, "c2").filter("cluster1 <> cluster2").filter((F.abs("dist") <= most) & (F.col("support") >= min_support))
    return e.withColumn("pair", edge_id(F.col("cluster1"), F.col("cluster2")))


def dynamic_min_contig(means: list[float], default: int = 500, most: int = 2000) -> int:
    """Least contig length for libraries of these mean distances: twice the smallest mean where that is between the default and most, else the default."""
    twice = 2 * min(means, default=0)
    return int(twice) if default < twice < most else default
