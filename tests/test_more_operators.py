"""Small cases for the operators that no catalogue query runs."""

import pytest
from pyspark.sql import functions as F

from contigloom.operators import coverage, edges, gaps, intervals, scaffold, stats, strain, tables, trees
from contigloom.plans import workflow


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def make(spark):
    return lambda data, schema: spark.createDataFrame(data, schema)


def test_pair_edges(make):
    p = make([("in", "a", 900, "+", 1000, "b", 50, "-", 800), ("out", "b", 100, "-", 800, "a", 10, "+", 1000)], "lib string, c1 string, p1 int, s1 string, l1 int, c2 string, p2 int, s2 string, l2 int")
    got = {r["lib"]: (r["c1"], r["o1"], r["c2"], r["o2"], r["dist"]) for r in edges.pair_edges(p, F.lit(400), F.lit(100)).collect()}
    assert got["in"] == ("a", "+", "b", "+", 150)
    assert got["out"] == ("a", "-", "b", "-", -410)


def test_scaffold_edges_and_ploidy(make):
    e = make([("a", "+", "b", "+", 10, 0, 6), ("a", "+", "c", "+", 10, 5, 6), ("a", "+", "b", "+", 9000, 5, 6), ("b", "+", "d", "+", 10, 5, 6)], "c1 string, o1 string, c2 string, o2 string, dist int, std int, support int")
    c = make([("a", False, True, 10.0), ("b", False, False, 21.0), ("c", True, False, 10.0), ("d", False, False, 19.0)], "id string, small boolean, repeat boolean, coverage double")
    assert sorted((r["c1"], r["c2"], r["dist"], r["std"]) for r in edges.scaffold_edges(e, c, 300.0, 30.0).collect()) == [("a", "b", 10, 1), ("b", "d", 10, 5)]
    assert sorted({(r["c1"], r["c2"]) for r in edges.unpaired_ploidy(e, c, 10.0, 3).collect()}) == [("a", "c"), ("b", "d")]


def test_tiling(make):
    a = make([("s", 0, 99, "c", 1, 100), ("s", 100, 199, "c", 101, 200), ("s", 300, 350, "d", 60, 10), ("s", 400, 420, "c", 1, 20)], "sc string, s int, e int, contig string, cs int, ce int")
    m = intervals.merge_consecutive(a, "sc", ["s"], "contig", "s", "e", "cs", "ce")
    assert sorted((r["contig"], r["start"], r["end"], r["mapped"], r["n"]) for r in m.collect()) == [("c", 0, 199, 200, 2), ("c", 400, 420, 20, 1), ("d", 300, 350, 51, 1)]
    c = make([("c", 210), ("d", 55)], "contig string, length int")
    t = intervals.tile_gaps(intervals.tile(m, c, "contig"), "sc")
    assert sorted((r["contig"], r["gap"]) for r in t.collect()) == [("c", None), ("d", 100)]
    assert rows(gaps.valid_tiles(m).select("contig")) == [("d",)]


def test_gap_coordinates_on_a_read(make):
    r = make([("e", (0, 0, 80), (0, 5, 90), (0, 100, 180), (0, 300, 385), 100, 95)], "edge string, c1 struct<o:int,s:int,e:int>, c2 struct<o:int,s:int,e:int>, r1 struct<o:int,s:int,e:int>, r2 struct<o:int,s:int,e:int>, len1 int, len2 int")
    g = gaps.gap_coordinates(r).first()
    assert (g["start"], g["end"], g["reverse"]) == (200, 295, False)
    f = make([("e", "r2", 1, 2), ("e", "r1", 1, 2)], "edge string, read string, start int, end int")
    assert gaps.first_read_per_edge(f).first()["read"] == "r1"


def test_repeats_between_scaffolds(make):
    e = make([("S", "+", "T", "+", 10, 5, 3), ("S", "+", "U", "+", 10, 5, 3)], "c1 string, o1 string, c2 string, o2 string, dist int, std int, support int")
    ends = make([("S", "r", "x", "+", 50, True), ("T", "l", "x", "+", 50, True), ("U", "l", "x", "-", 50, True)], "scaffold string, side string, contig string, ori string, length int, repeat boolean")
    assert sorted((r["c2"], r["dist"]) for r in scaffold.adjacent_repeat_correction(e, ends).collect()) == [("T", 60), ("U", 10)]
    placed = make([("s", "a", "+", 0, 100), ("s", "r", "+", 200, 50), ("t", "r", "-", 0, 50), ("t", "b", "+", 500, 90)], "scaffold string, contig string, ori string, start int, length int")
    e = make([("a", "+", "r", "+", 60, 5), ("a", "+", "r", "-", 60, 5), ("b", "-", "r", "+", 300, 5)], "c1 string, o1 string, c2 string, o2 string, dist int, std int")
    assert [r["satisfied"] for r in scaffold.satisfied_repeat_edges(e, placed).orderBy("c1", "o2").collect()] == [True, False, False]


def test_patterns_kmers_and_sketches(make):
    c = make([("a", "NNACGTACGTNN"), ("b", "TTTT"), ("c", "GTAA")], "id string, seq string")
    p = make([("b", "xxACCTxx", "q"), ("c", "AGGTq", "q"), ("a", "q", "q")], "contig string, seq1 string, seq2 string")
    assert rows(gaps.drop_patterned(c, p, "ACCT").select("id", "seq")) == [("a", "ACGTACGT")]
    k = make([("a", "ACGTT"), ("b", "GTTCC"), ("c", "AA")], "id string, seq string")
    assert rows(gaps.end_kmer_links(k, 3).select("a", "b")) == [("a", "b")]
    s = make([("x", "ACGTACGTTTACGGACATTGCAACGT" * 4), ("y", "ACGTACGTTTACGGACATTGCAACGT" * 4)], "id string, seq string")
    sk = gaps.sketches(s, 7, 10)
    d = {(r["query"], r["ref"]): r["dist"] for r in gaps.sketch_distances(sk, sk, 7, 10).collect()}
    assert d["x", "y"] == pytest.approx(0) and gaps.minimizer_capacity(s, 7).first()["capacity"] > 0
    known, unknown = gaps.names_by_accession(make([("A1",), ("A2",)], "accession string"), make([("A1", 7)], "accession string, taxid int"))
    assert known.first()["taxid"] == 7 and unknown.first()["accession"] == "A2"


def test_strain_helpers(make):
    e = make([("a", "b"), ("b", "c"), ("a", "d"), ("c", "e")], "c1 string, c2 string")
    s = make([("a", 1, 50.0), ("b", 1, 55.0), ("c", 0, 20.0), ("d", 0, 90.0), ("e", 0, 10.0)], "contig string, strain int, coverage double")
    assert sorted((r["c1"], r["c2"], r["strain"], r["rescued"]) for r in strain.strain_edges(e, s).collect()) == [("a", "b", 1, False), ("b", "c", 1, True)]
    assert rows(strain.residual_pool(s.select("contig"), s)) == [("c",), ("d",), ("e",)]
    c = make([("a", 1, 900_000), ("b", 1, 200_000), ("c", 2, 2_000_000), ("d", 3, 2_600_000)], "contig string, cluster int, length long")
    refs = make([(1, "sp"), (9, "x")], "cluster int, species string")
    assert rows(strain.strain_candidates(c, refs).select("species", "total_len")) == [("cluster_3", 2_600_000), ("sp", 1_100_000)]
    m = make([("a", 5.0), ("b", 10.0), ("c", 99.0)], "contig string, median double")
    assert rows(strain.coverage_interval(m, 10.0, 1e6).select("contig")) == [("a",), ("b",)]


def test_tables(make):
    sc = make([("S", "a"), ("S", "b"), ("T", "c")], "scaffold string, contig string")
    mass = make([("a", 100, 1000.0, 100.0), ("b", 300, 600.0, 0.0), ("c", 50, 50.0, 50.0)], "contig string, size long, short_mass double, long_mass double")
    cl = make([("a", 1), ("b", 1)], "contig string, cluster int")
    sp = make([(1, "x", "ref")], "cluster int, species string, reference string")
    assert rows(tables.contig_table(sc, mass, cl, sp)) == [("S", 400, 4.0, 0.25, 1, "x", "ref"), ("T", 50, 1.0, 1.0, None, None, None)]
    g = make([("S", 10.0, 1.0), ("S", 1.0, 99.0), ("T", 2.0, 1.0)], "scaffold string, coverage double, subtract double")
    o = make([("S", 11.0), ("T", 9.0)], "scaffold string, coverage double")
    assert rows(tables.repeat_scaffolds(g, o).select("scaffold")) == [("S",)]
    q = make([("c", 10, "ACG", "ACT", "IJ!"), ("c", 11, "CG", "CG", "KI")], "contig string, start int, seq string, ref string, qual string")
    assert sorted((r["pos"], r["quality"]) for r in tables.per_base_quality(q, "contig", "start", "seq", "ref", "qual").collect()) == [(10, 40.0), (11, 41.5), (12, 40.0)]
    r = make([("r1", "a"), ("r1", "a"), ("r2", "a"), ("r2", "b")], "read string, contig string")
    assert rows(tables.sequence_mappings_once(r, "read", "contig")) == [("r1", "a"), ("r1", "a")]
    assert rows(tables.lookup_default(make([("a",), ("z",)], "k string"), make([("a", 5)], "k string, v int"), "k", "v", 3_500_000)) == [("a", 5), ("z", 3_500_000)]
    v = make([("a", 1), ("b", 2)], "ref string, votes long")
    assert rows(tables.merge_votes(v, v, ["ref"])) == [("a", 2), ("b", 4)]
    d = make([("q", "p/one__x", 0.1), ("q", "p/mixed_sp__y", 0.05)], "query string, ref string, dist double")
    assert tables.first_hit(d, "query", "ref", "dist", "mixed").first()["ref"] == "p/one__x"
    c = tables.common_references(make([(["x", "y"], ["y", "z"]), (["x"], ["z"])], "a array<string>, b array<string>"), "a", "b").collect()
    assert [(r["common"], r["any_common"]) for r in c] == [(["y"], True), ([], False)]


def test_coverage_and_statistics(make):
    assert make([([1, 2, 3, 30],)], "c array<int>").select(coverage.window_outliers(F.col("c"))).first()[0] == [1, 2, 3]
    assert rows(stats.running_position(make([("a", 10.0, 1), ("a", 40.0, 2)], "c string, d double, step int"), ["c"], "d", "step")) == [("a", 20.0, 10.0)]
    assert rows(stats.unseen(make([("a",), ("b",)], "s string"), make([("a",)], "s string"), "s")) == [("b",)]
    s = {r["kind"]: r["n"] for r in stats.sequence_stats(make([("A" * 600 + "NN" + "C" * 500,), ("G" * 499,)], "seq string")).collect()}
    assert s == {"scaffold": 1, "contig": 2}
    t = trees.tree_roots(make([(1, 2, 3), (2, None, None), (3, None, None), (4, None, None)], "id int, left int, right int"))
    assert rows(t.select("id")) == [(1,), (4,)]
    assert rows(trees.dense_ids(make([("b",), ("a",), ("b",)], "c string"), "c")) == [("a", 1), ("b", 2), ("b", 2)]


def test_utilities(spark, make, tmp_path):
    d = make([("m1", "r", 0.01), ("m2", "r", 0.4)], "query string, ref string, dist double")
    m = make([("m1",), ("m2",), ("m3",)], "query string")
    between = make([("m2", "m3", 0.02), ("m1", "m2", 0.5)], "a string, b string, dist double")
    assert rows(workflow.novel_species(d, m, between)) == [("m2", 0.4, "m2"), ("m3", 1.0, "m2")]
    for name, pct in (("s.txt", 30), ("l.txt", 20)):
        (tmp_path / name).write_text(f"{pct}\t1\t1\tS\t1\t  A b\n 5\t1\t1\tS\t2\t  C\n0.01\t1\t1\tS\t3\t D\n")
    both, r = workflow.read_concordance(spark, str(tmp_path / "s.txt"), str(tmp_path / "l.txt"))
    assert rows(both) == [("A_b", 30.0, 20.0), ("C", 5.0, 5.0)] and r.first()["r"] == pytest.approx(1)
    (tmp_path / "g").mkdir()
    (tmp_path / "g" / "G1.fa").write_text(">a\nACGT\n>b\nAC\n")
    (tmp_path / "tax.tsv").write_text("G1\td__B;s__X y\n")
    cat = workflow.build_catalog(spark, str(tmp_path / "g"), str(tmp_path / "tax.tsv")).first()
    assert (cat["n_seq"], cat["length"], cat["species"], cat["directory"]) == (2, 6, "X_y", 1)
    c = make([("S", 1, "a", "+", 900), ("S", 2, "b", "+", 900)], "scaffold string, pos int, contig string, ori string, length int")
    e = make([("b", "+", "a", "+", 10, 5, 3)], "c1 string, o1 string, c2 string, o2 string, dist int, std int, support int")
    assert workflow.circular_sequences(c, e).count() == 1


def test_scaffold_order_query_has_the_workflow_budget(spark, sf_dir, monkeypatch):
    import inspect

    from contigloom.plans import catalog

    own, seen = inspect.signature(scaffold.order_scaffolds), []
    monkeypatch.setattr(scaffold, "order_scaffolds", lambda *a, **b: seen.append(own.bind(*a, **b)))
    catalog.QUERIES["scaffold_order"](spark, sf_dir)
    seen[0].apply_defaults()
    assert seen[0].arguments["budget"] == own.parameters["budget"].default == 100_000
    assert next(f.default for f in workflow.Options.__dataclass_fields__.values() if f.name == "budget") == 100_000


def test_components_in_one_task_and_by_rounds(spark):
    import numpy as np

    from contigloom.operators import graph

    rng = np.random.default_rng(8)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(500 + i, 501 + i) for i in range(60)] + [(7, None), (3, 3)]
    for rows, kind in ((pairs, "long"), ([tuple(None if x is None else f"v{x}" for x in p) for p in pairs], "string")):
        e = spark.createDataFrame(rows, f"a {kind}, b {kind}")
        one, many = (sorted(map(tuple, graph.connected_components(e, local_arcs=n).collect())) for n in (1 << 20, 0))
        assert one == many and len({v for v, _ in one}) == len(one)
    assert graph.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_gap_sequences_of_small_files_are_not_broadcast(spark, tmp_path):
    spark.range(50).write.parquet(str(tmp_path / "keys"))
    keys = spark.read.parquet(str(tmp_path / "keys"))
    reads = keys.select(F.col("id").alias("name"), F.repeat(F.lit("ACGT"), F.lit(300)).alias("seq"))  # longer than the planner takes them for
    g = keys.select(F.col("id").alias("edge"), F.col("id").alias("read"), F.lit(1).alias("start"), F.lit(5).alias("end"), F.lit(False).alias("reverse"))
    out = gaps.gap_sequences(g, reads)
    assert {r["seq"] for r in out.collect()} == {"CGTA"} and out.count() == 50
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()


def test_satisfied_edges_of_a_table_whose_rows_change_their_order(spark):
    placed = spark.createDataFrame([(1, c, "+", c * 10, 10) for c in range(40)], "scaffold long, contig long, ori string, start int, length int")

    def shuffled(batches):  # as after an exchange, whose rows come in another order each time
        import random

        for b in batches:
            yield b.take(random.sample(range(b.num_rows), b.num_rows))

    e = spark.range(39).coalesce(1).mapInArrow(shuffled, "id long").selectExpr("id AS c1", "id + 1 AS c2", "'+' AS o1", "if(id % 3 = 0, '+', '-') AS o2", "0 AS dist", "5 AS std", "1 AS support")
    out = scaffold.satisfied_repeat_edges(e, placed)
    got = {r["c1"]: r["satisfied"] for r in out.collect()}
    assert got == {k: k % 3 == 0 for k in range(39)} and out.columns == [*e.columns, "satisfied"]
    twice = spark.createDataFrame([(0, 1, "+", "+", 0, 5)] * 2 + [(0, 1, "+", "-", 0, 5), (0, 1, "+", "+", None, 5), (None, 1, "+", "+", 0, 5)], "c1 long, c2 long, o1 string, o2 string, dist int, std int")
    assert sorted(r["satisfied"] for r in scaffold.satisfied_repeat_edges(twice, placed).collect()) == [False] * 3 + [True] * 2
