"""Goldens, properties and brute force for the assembly operators."""

import itertools
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from contigloom.functions import probability as pr
from contigloom.functions import sequence as sq
from contigloom.operators import bundles, coverage, edges, gaps, graph, intervals, scaffold, stats, strain, tables, trees


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_nx_on_a_known_assembly(spark):
    lengths = [5306673, 600000 - 1, 120000, 99999, 500, 500, 80]
    total, run = sum(lengths), 0
    df = spark.createDataFrame([(x,) for x in lengths], "length long")
    r = stats.nx_lx(df).first()
    assert (r["n"], r["total"], r["longest"], r["n50"], r["l50"]) == (7, total, 5306673, 5306673, 1)
    for i, x in enumerate(sorted(lengths, reverse=True)):
        run += x
        if run >= total * 0.9:
            assert (r["n90"], r["l90"]) == (x, i + 1)
            break
    s = stats.assembly_stats(df).first()
    assert (s["n_100k"], s["n_500k"], s["n_1m"], s["n50"]) == (3, 2, 1, 5306673)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(1, 9), min_size=1, max_size=30))
def test_nx_with_ties(spark, lengths):
    df = spark.createDataFrame([(x,) for x in lengths], "length long")
    down = sorted(lengths, reverse=True)
    for strict in (False, True):
        r = stats.nx_lx(df, strict=strict).first()
        for p in (50, 90):
            run = 0
            for i, x in enumerate(down):
                run += x
                if run > sum(lengths) * (p / 100.0) if strict else run >= sum(lengths) * (p / 100.0):
                    assert (r[f"n{p}"], r[f"l{p}"]) == (x, i + 1)
                    break


def test_sketch_distance_goldens(spark):
    for shared, want in ((9, 0.191731), (14, 0.170926), (8, 0.197292), (15, 0.167688)):
        q = spark.createDataFrame([("q", i) for i in range(shared)], "id string, h long")
        assert round(gaps.sketch_distances(q, q.withColumn("id", F.lit("r"))).first()["dist"], 6) == want


def test_log_gamma_and_models(spark):
    xs = [0.05, 0.3, 1.0, 2.5, 7.0, 80.0, 1e4, 1e6]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in xs], "x double").select(pr.log_gamma(F.col("x"))).collect()]
    assert all(abs(g - math.lgamma(x)) < 1e-12 * max(1, abs(math.lgamma(x))) + 1e-12 for g, x in zip(got, xs))
    total = spark.range(400).select(F.exp(pr.nb_logpmf(F.col("id").cast("double"), F.lit(12.0), F.lit(3.0))).alias("p")).agg(F.sum("p")).first()[0]
    assert total == pytest.approx(1, abs=1e-6)
    assert trees.log_nb(np.array([3.0]), 12.0, 3.0)[0] == pytest.approx(spark.range(1).select(pr.nb_logpmf(F.lit(3.0), F.lit(12.0), F.lit(3.0))).first()[0])


@settings(max_examples=10, deadline=None)
@given(st.text(alphabet="ACGTNacgtnRYKM", max_size=20))
def test_reverse_complement_is_an_involution(spark, seq):
    df = spark.createDataFrame([(seq,)], "s string")
    assert df.select(sq.reverse_complement(sq.reverse_complement(F.col("s")))).first()[0] == seq


def test_sequence_functions(spark):
    df = spark.createDataFrame([("ACGTxNNnA", "db/Genus_sp__ref.1.fa", "5S10M2D3I4N1=6X")], "s string, p string, c string")
    r = df.select(sq.reverse_complement(F.col("s"), "upper"), sq.reverse_complement(F.col("s"), "strict"), sq.count_n(F.col("s")), sq.split_at_n(F.col("s")), sq.species_of(F.col("p")), sq.reference_of(F.col("p")), sq.bin_of(F.col("p")), sq.cigar_reference_length(F.col("c")), sq.trim_n(F.lit("NNAnCNN")),
        sq.human_bases(F.lit(1500)), sq.mask_lower(F.lit("ACgtA")), sq.longest_common_substring_length(F.lit("xabcdy"), F.lit("zabcq"))).first()
    assert tuple(r) == ("TNNNNACGT", None, 3, ["ACGTx", "A"], "Genus_sp", "ref.1.fa", "Genus_sp__ref.1", 23, "AnC", "1.50 Kb", "ACxxA", 3)


def test_edge_codes(spark):
    c = spark.createDataFrame([(x,) for x in "abc"], "id string")
    e = spark.createDataFrame([("a", "b", 10, 5, 2), ("a", "x", 10, 5, 2), ("a", "b", 10, 5, 1), ("a", "x", 10, 5, 1), ("a", "b", -900, 5, 2), ("a", "x", -900, 5, 2), ("a", "b", -900, 5, 1), ("a", "x", -900, 5, 1), ("a", "a", 1, 5, 2)], "c1 string, c2 string, dist int, std int, support int")
    assert sorted(r["skip_code"] for r in edges.validate_edges(e, c).collect()) == [0, 1, 3, 4, 5, 6, 7, 8, 9]


def test_distance_buckets_at_their_bounds(spark):
    d = spark.createDataFrame([(x,) for x in (-200, -199, 299, 300, 1000, 2000, 5000, 15000, 39999, 40000)], "d int")
    assert [r[0] for r in d.select(edges.distance_bucket(F.col("d"))).collect()] == [None, 0, 0, 1, 2, 3, 4, 5, 5, None]
    assert [r[0] for r in d.select(edges.distance_bucket(F.col("d"), strict=True)).collect()] == [None, 0, 0, None, None, None, None, None, 5, None]


def test_alignment_classes(spark):
    cases = [(0, 900, 1000, 5, 905, 3000), (100, 500, 1000, 0, 900, 1000), (700, 990, 1000, 10, 300, 3000), (10, 300, 1000, 2700, 2990, 3000), (300, 600, 1000, 500, 800, 3000), (0, 800, 1000, 500, 1300, 3000)]
    df = spark.createDataFrame(cases, "cs int, ce int, cl int, rs int, re int, rl int")
    c = [F.col(x) for x in ("cs", "ce", "cl", "rs", "re", "rl")]
    assert [r[0] for r in df.select(edges.alignment_class(*c)).collect()] == ["contig-contained", "read-contained", "contig-at-start", "contig-at-end", "partial-match", "contig-contained"]


def test_canonical_edges_twice_is_once(spark):
    e = spark.createDataFrame([("b", "+", "a", "-", 1), ("a", "-", "b", "+", 2)], "c1 string, o1 string, c2 string, o2 string, dist int")
    once = edges.canonical_edges(e)
    assert rows(once.select(e.columns)) == rows(edges.canonical_edges(once).select(e.columns)) == [("a", "+", "b", "-", 1), ("a", "-", "b", "+", 2)]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=30))
def test_components_partition_the_vertices(spark, pairs):
    got = dict(map(tuple, graph.connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()))
    top = {v: v for p in pairs for v in p}
    for _ in top:
        for a, b in pairs:
            top[a] = top[b] = min(top[a], top[b])
    assert got == top


def test_components_of_a_long_path_and_nulls(spark):
    e = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).union(spark.createDataFrame([(None, 5), (900, 900)], "a long, b long"))
    got = dict(map(tuple, graph.connected_components(e).collect()))
    assert {got[i] for i in range(301)} == {0} and got[900] == 900


def greedy_bundles(values):
    values, out = sorted(values), []
    while values:
        d, s = values[len(values) // 2]
        inside = [v for v in values if d - 6 * s <= v[0] <= d + 6 * s]
        q = sum(1 / x[1] ** 2 for x in inside)
        out.append((math.floor(sum(x[0] / x[1] ** 2 for x in inside) / q + 0.5), max(1, int(q**-0.5 + 0.5)), len(inside)))
        values = [v for v in values if v not in inside]
    return sorted(out)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(-50, 900), st.integers(1, 12)), min_size=1, max_size=25))
def test_bundles_partition_the_pairs(spark, values):
    df = spark.createDataFrame([("a", "+", "b", "+", d, s) for d, s in values], "c1 string, o1 string, c2 string, o2 string, dist long, std long")
    got = sorted((r["dist"], r["std"], r["size"]) for r in bundles.bundle_pairs(df).collect())
    assert got == greedy_bundles(values) and sum(g[2] for g in got) == len(values)


def test_long_bundles(spark):
    df = spark.createDataFrame([("a", "b", "+:+", d) for d in (1000, 950, 900, -50)] + [("a", "b", "+:-", d) for d in (5000, 5100)], "c1 string, c2 string, ori string, dist long")
    assert rows(bundles.bundle_long(df)) == [("a", "b", "+:+", 950, 145, 3)]


def test_super_bundles_need_more_than_half(spark):
    schema = "c1 string, o1 string, c2 string, o2 string, dist long, std long, size long"
    df = spark.createDataFrame([("a", "+", "b", "+", 100, 10, 6), ("a", "+", "b", "+", 110, 20, 3), ("a", "+", "b", "+", 900, 5, 4), ("c", "+", "d", "+", 0, 10, 5), ("c", "+", "d", "+", 900, 10, 5)], schema)
    got = bundles.super_bundles(df).collect()
    assert [(r["c1"], r["size"], r["members"]) for r in got] == [("a", 9, 2)]


def test_gap_correction_inverts_its_table(spark):
    table = bundles.gap_table(400.0, 40.0, 1000, 50, 300)
    df = spark.createDataFrame([(float(table[g]), 1000) for g in (0, 50, 120)], "dist double, min_len long")
    assert all(abs(r["real_gap"] - g) <= 1 for r, g in zip(bundles.correct_gap(df, 400.0, 40.0, 50, [500, 1000], 300).collect(), (0, 50, 120)))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 12)), min_size=1, max_size=15))
def test_interval_operators_against_sets(spark, spans):
    df = spark.createDataFrame([(1, s, s + n, i) for i, (s, n) in enumerate(spans)], "ref int, s int, e int, id int")
    covered = {x for s, n in spans for x in range(s, s + n + 1)}
    assert intervals.union_length(df, "ref", "s", "e").first()["covered"] == len(covered)
    depth = {}
    for r in intervals.depth_profile(df, "ref", "s", "e").collect():
        for x in range(r["pos"], r["until"] or r["pos"]):
            depth[x] = r["depth"]
    assert {x for x, d in depth.items() if d} == covered and all(d == sum(s <= x <= s + n for s, n in spans) for x, d in depth.items())
    inside = {(i, j) for (i, (a, m)), (j, (b, n)) in itertools.permutations(enumerate(spans), 2) if a <= b and b + n <= a + m and ((a, m) != (b, n) or i < j)}
    assert {(r["outer"], r["inner"]) for r in intervals.containment_pairs(df, "ref", "s", "e", "id", 7).collect()} == inside


def test_overlap_resolution(spark):
    a = spark.createDataFrame([(1, 0, 100, 1.0), (1, 50, 160, 2.0), (1, 140, 300, 1.5), (1, 400, 500, 0.1), (2, 0, 10, 1.0)], "r int, s int, e int, x double")
    got = intervals.overlap_resolution(a, "r", "s", "e", "x", ["s"], overlap=10)
    assert sorted((r["r"], r["s"]) for r in got.filter("kept").collect()) == [(1, 50), (1, 400), (2, 0)]
    flagged = intervals.overlap_resolution(a, "r", "s", "e", "x", ["s"], overlap=10, flag=True).filter("kept").collect()
    assert sorted((r["r"], r["s"], r["conflict"]) for r in flagged) == [(1, 0, True), (1, 400, False), (2, 0, False)]


def test_merge_tree_is_single_linkage(spark):
    e = spark.createDataFrame([(1, 2, 0.5), (2, 3, 0.1), (4, 5, 0.2), (1, 3, 0.9), (3, 4, 0.7)], "c1 long, c2 long, weight double")
    got = [(r["left"], r["right"], r["weight"], r["size"]) for r in sorted(trees.single_linkage_tree(e).collect(), key=lambda r: r["merge"])]
    assert got == [(2, 3, 0.1, 2), (4, 5, 0.2, 2), (1, 2, 0.5, 3), (1, 4, 0.7, 5)]


def test_cut_is_never_worse_than_all_or_nothing():
    rng = np.random.default_rng(0)
    for _ in range(10):
        n = 6
        counts = [rng.poisson(rng.choice([4, 40]), (1, 8)).astype(float) for _ in range(n)]
        lengths = np.full(n, 8 * 340.0)
        a, b = zip(*itertools.combinations(range(n), 2))
        w = np.array([abs(counts[i].mean() - counts[j].mean()) for i, j in zip(a, b)])
        merges = trees.merge_order(np.array(a), np.array(b), w)
        label = trees.cut(merges, counts, lengths, 340, 20.0, 100.0)

        def score(groups):
            total = 0.0
            for g in groups:
                mean = sum(counts[i].sum() for i in g) / lengths[list(g)].sum() * 340
                total += sum(trees.log_nb(counts[i][0], mean, 20.0).sum() for i in g) - 0.5 * math.log(100.0) if mean else -0.5 * math.log(100.0)
            return total

        mine = score([[i for i in range(n) if label[i] == k] for k in set(label.tolist())])
        assert mine >= score([range(n)]) - 1e-9 and mine >= score([[i] for i in range(n)]) - 1e-9


def test_cut_tree_separates_coverages(spark):
    e = spark.createDataFrame([("a", "b", 0.01), ("b", "c", 0.9), ("c", "d", 0.02)], "c1 string, c2 string, weight double")
    w = spark.createDataFrame([("a", 0, [10] * 20, 6800), ("b", 0, [11] * 20, 6800), ("c", 0, [100] * 20, 6800), ("d", 0, [103] * 20, 6800), ("z", 0, [7] * 5, 1700)], "contig string, sample int, counts array<int>, length int")
    got = {r["contig"]: r["cluster"] for r in trees.cut_tree(e, w, 340, 50.0, 100.0).collect()}
    assert got == {"a": "a", "b": "a", "c": "c", "d": "c", "z": "z"}
    assert trees.search_r(e, w, 340, 2.0, 50.0, 100.0, steps=2)[0] > 1


def test_super_clusters_keep_a_common_reference(spark):
    e = spark.createDataFrame([(1, 2, 0.1), (2, 3, 0.2), (3, 4, 0.3)], "c1 long, c2 long, weight double")
    refs = spark.createDataFrame([(1, ["x"]), (2, ["x", "y"]), (3, ["y"]), (4, ["y"])], "cluster long, refs array<string>")
    assert dict(map(tuple, trees.super_clusters(e, refs).collect())) == {1: 1, 2: 1, 3: 3, 4: 3}


def fewest(contigs, lengths, es, k=10, n_sd=6):
    return min(scaffold.discordant(list(zip(p, o)), lengths, es, k, n_sd) for p in itertools.permutations(contigs) for o in itertools.product("+-", repeat=len(contigs)))


def test_scaffold_search_against_all_orders():
    rng = np.random.default_rng(1)
    for _ in range(12):
        n = int(rng.integers(2, 5))
        contigs, lengths = list(range(n)), {i: int(rng.integers(50, 200)) for i in range(n)}
        es = [(a, "+-"[rng.integers(2)], b, "+-"[rng.integers(2)], float(rng.integers(-10, 150)), 5.0) for a, b in itertools.combinations(contigs, 2) if rng.random() < 0.8]
        orders, cost, exact = scaffold.solve_order(contigs, lengths, es, 10)
        assert exact and cost == fewest(contigs, lengths, es)
        assert sorted(c for o in orders for c, _ in o) == contigs


def test_ordered_scaffolds(spark):
    e = spark.createDataFrame([(0, "a", "+", "b", "-", 20, 5, 9), (0, "c", "+", "b", "+", 40, 5, 9)], "subgraph int, c1 string, o1 string, c2 string, o2 string, dist int, std int, support int")
    c = spark.createDataFrame([("a", 1000), ("b", 800), ("c", 900)], "id string, length int")
    got = [(r["contig"], r["ori"], r["gap"]) for r in sorted(scaffold.order_scaffolds(e, c).collect(), key=lambda r: r["pos"])]
    assert got == [("a", "+", 20), ("b", "-", 40), ("c", "-", None)]


def test_gap_qp():
    assert np.allclose(scaffold.gap_qp([100, 100, 100], [(0, 1, 30, 5), (1, 2, 50, 5), (0, 2, 180, 5)]), [30, 50], atol=1e-3)
    assert scaffold.gap_qp([100, 100], [(0, 1, -500, 5)])[0] == pytest.approx(-60)
    both = scaffold.gap_qp([100, 100], [(0, 1, 0, 10), (0, 1, 100, 20)])
    assert both[0] <= 60.5


def test_contraction_and_sequences(spark):
    s = spark.createDataFrame([("S", 1, "a", "+", 100, 10), ("S", 2, "b", "-", 50, None), ("T", 1, "c", "+", 70, None)], "scaffold string, pos int, contig string, ori string, length int, gap int")
    e = spark.createDataFrame([("a", "+", "c", "+", 200, 5, 3), ("a", "+", "b", "-", 10, 5, 3)], "c1 string, o1 string, c2 string, o2 string, dist int, std int, support int")
    assert rows(scaffold.contract(e, s)) == [("S", "+", "T", "+", 140, 5, 3)]
    seqs = spark.createDataFrame([("a", "AAC"), ("b", "GGT"), ("c", "TT")], "id string, seq string")
    assert rows(scaffold.scaffold_sequences(s, seqs)) == [("S", "AAC" + "N" * 10 + "ACC"), ("T", "TT")]


def test_strain_peeling_finds_two_strains(spark):
    rng = np.random.default_rng(5)
    data = [("sp", i, 340 * 400, rng.negative_binomial(20, 20 / (20 + m), 400).tolist()) for i, m in enumerate([100] * 6 + [20] * 6)]
    df = spark.createDataFrame(data, "species string, contig int, length int, counts array<int>")
    got = {r["contig"]: r["strain"] for r in strain.peel_strains(df, 340, 20.0).collect()}
    assert {got[i] for i in range(6)} == {1} and {got[i] for i in range(6, 12)} == {2}
    assert strain.nb_quantile(0.5, 10.0, 1e9) == 10


def test_tiers_and_novelty(spark):
    b = spark.createDataFrame([("a", 90.0, 5.0), ("b", 89.9, 5.0), ("c", 50.0, 10.0), ("d", 50.0, 10.1)], "bin string, completeness double, contamination double")
    assert [r["tier"] for r in tables.quality_tier(b).orderBy("bin").collect()] == ["HIGH", "MEDIUM", "MEDIUM", "LOW"]
    m = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "mag string")
    t = spark.createDataFrame([("a", 0.01), ("b", 0.2), ("c", 0.2)], "mag string, dist double")
    n = spark.createDataFrame([("b", 0.03), ("c", 0.3)], "mag string, dist double")
    assert dict((r["mag"], r["status"]) for r in tables.novelty(m, t, n).collect()) == {"a": "KNOWN", "b": "SEEN", "c": "NOVEL", "d": "NO_REF"}


def test_dispersion_needs_more_variance_than_mean(spark):
    w = spark.createDataFrame([("a", n) for n in (1, 9, 1, 9)] + [("b", 5)] * 4, "id string, n int")
    m = coverage.contig_moments(w, ["id"]).withColumn("length", F.lit(20_000))
    assert [(r["id"], round(r["r"], 6)) for r in coverage.moment_dispersion(m).collect()] == [("a", round(25 / 11, 6))]
    assert [x[0] for x in spark.createDataFrame([([1, 4, 9],), ([1, 4, 9, 2],)], "c array<int>").select(coverage.integer_median("c")).collect()] == [4, 3]


def test_gap_sequences_and_trimming(spark):
    g = spark.createDataFrame([("e", "r", 2, 6, False), ("f", "r", 2, 6, True), ("g", "r", 6, 2, False)], "edge string, read string, start int, end int, reverse boolean")
    r = spark.createDataFrame([("r", "AACGTTGG")], "name string, seq string")
    assert rows(gaps.gap_sequences(g, r)) == [("e", "r", None, "CGTT"), ("f", "r", None, "AACG"), ("g", "r", 4, "")]
    s = spark.createDataFrame([("x", "TTGATACC" + "A" * 20 + "GGTATCGG")], "id string, seq string")
    assert s.select(gaps.trim_pattern(F.col("seq"), "GATACC", 12)).first()[0] == "A" * 20
    assert [x["seq"] for x in gaps.break_at_n(spark.createDataFrame([("x", "NNACNGTNNNCC")], "id string, seq string"), 3).collect()] == ["ACNGT", "CC"]
    c = spark.createDataFrame([("s", "AAAAAAAAAA")], "scaffold string, seq string")
    t = spark.createDataFrame([("s", 2, 4, "CCC"), ("s", 4, 6, "GGG")], "scaffold string, start int, end int, tile string")
    assert intervals.splice_tiles(c, t).first()["seq"] == "AACCCGGAAA"


def test_common_subsequences(spark):
    assert sq.common_subsequence("xaybzc", "abqc") == "abc" and sq.common_subsequence("abc", "") == ""
    df = spark.createDataFrame([("g", "abcde"), ("g", "aXce"), ("g", "zace"), ("h", "q")], "g string, t string")
    assert rows(sq.common_subsequences(df, "g", "t")) == [("g", "ace"), ("h", "q")]


def test_groups_across_batches(spark):
    from contigloom.operators.grouped import map_groups, numbered

    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.range(300).select((F.col("id") % 11 + F.floor(F.col("id") / 250)).alias("k"), F.col("id").alias("v"))
        got = map_groups(df, ["k"], ["v"], lambda k, c: [(int(k[0]), len(c["v"]), int(c["v"].sum()), bool((np.diff(c["v"]) > 0).all()))], "k long, n long, s long, sorted boolean")
        want = df.groupBy("k").agg(F.count("*"), F.sum("v"), F.lit(True))
        assert rows(got) == rows(want)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    n = numbered(spark.range(1000).select((F.col("id") * 7 % 1000).alias("x")), [F.col("x").desc()])
    assert n.filter(F.col("number") != 1000 - F.col("x")).count() == 0 and n.count() == 1000


def test_gap_sizes_of_scaffolds(spark):
    s = spark.createDataFrame([("S", 1, "a", 100), ("S", 2, "b", 100), ("S", 3, "c", 100), ("T", 1, "d", 50), ("T", 2, "e", 50), ("U", 1, "f", 9)], "scaffold string, pos int, contig string, length int")
    e = spark.createDataFrame([("a", "b", 30, 5), ("c", "b", 50, 5), ("a", "d", 5, 5)], "c1 string, c2 string, dist int, std int")
    assert [(a, b, round(c, 2)) for a, b, c in rows(scaffold.gap_sizes(s, e))] == [("S", 1, 30.0), ("S", 2, 50.0), ("T", 1, 0.0)]
