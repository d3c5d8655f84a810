"""Queries of operators over the driver's tables that neither the main catalogue nor the files cover, each with its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contigloom.functions import sequence as sq
from contigloom.operators import coverage as cv
from contigloom.operators import edges as ed
from contigloom.operators import gaps, intervals, scaffold, stats, strain, tables, trees
from contigloom.operators import bundles
from contigloom.plans import tables as t
from contigloom.plans.files import CONTIGS, _contigs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
FOLDS: dict[str, str] = {}


def query(oracle: str, fold: bool = False):
    def register(f):
        QUERIES[f.__name__] = f
        (FOLDS if fold else ORACLES)[f.__name__] = oracle
        return f

    return register


FLIP = "CASE {0} WHEN '+' THEN '-' ELSE '+' END"
PAIRS = """p AS (SELECT l_partkey AS c1, CAST(l_quantity AS INT) AS p1, CASE WHEN l_returnflag = 'R' THEN '-' ELSE '+' END AS s1, 400 AS l1, l_suppkey AS c2, l_linenumber * 10 AS p2, CASE WHEN l_linestatus = 'O' THEN '-' ELSE '+' END AS s2, 300 AS l2,
  CASE l_linenumber % 4 WHEN 0 THEN 'in' WHEN 1 THEN 'out' WHEN 2 THEN 'forward1' ELSE 'forward2' END AS lib FROM lineitem)"""


@query(f"""WITH {PAIRS}, o AS (SELECT *, CASE WHEN lib IN ('out', 'forward2') THEN {FLIP.format('s1')} ELSE s1 END AS o1, CASE WHEN lib IN ('in', 'forward2') THEN {FLIP.format('s2')} ELSE s2 END AS o2 FROM p),
d AS (SELECT *, 500 - CASE WHEN o1 = '+' THEN l1 - p1 ELSE p1 + 100 END - CASE WHEN o2 = '+' THEN p2 + 100 ELSE l2 - p2 END AS dist FROM o)
SELECT least(c1, c2) AS c1, greatest(c1, c2) AS c2, CASE WHEN c1 > c2 THEN {FLIP.format('o2')} ELSE o1 END AS o1, CASE WHEN c1 > c2 THEN {FLIP.format('o1')} ELSE o2 END AS o2, dist, lib, least(c1::VARCHAR, c2::VARCHAR) || '-vs-' || greatest(c1::VARCHAR, c2::VARCHAR) AS id,
  CASE WHEN (CASE WHEN c1 > c2 THEN {FLIP.format('o2')} ELSE o1 END) = '+' THEN 'BE' ELSE 'EB' END AS code FROM d""")
def mate_edges(spark, sf):
    """Mates on two contigs as edges, for the four orientations of a library."""
    li = t.table(spark, sf, "lineitem")
    lib = F.element_at(F.array(*map(F.lit, ("in", "out", "forward1", "forward2"))), (F.col("l_linenumber") % 4 + 1).cast("int"))
    p = li.select(F.col("l_partkey").alias("c1"), F.col("l_quantity").cast("int").alias("p1"), F.when(F.col("l_returnflag") == "R", "-").otherwise("+").alias("s1"), F.lit(400).alias("l1"), F.col("l_suppkey").alias("c2"), (F.col("l_linenumber") * 10).alias("p2"), F.when(F.col("l_linestatus") == "O", "-").otherwise("+").alias("s2"), F.lit(300).alias("l2"), lib.alias("lib"))
    e = ed.pair_edges(p, F.lit(500), F.lit(100)).select("c1", "c2", "o1", "o2", "dist", "lib", ed.edge_id(F.col("c1").cast("string"), F.col("c2").cast("string")).alias("id"))
    code = F.when(F.col("o1") == "+", "BE").otherwise("EB")
    return e.withColumn("code", code).filter(ed.orientation_of(F.col("code")) == F.col("o1"))


@query("""SELECT o_orderkey AS id, CASE WHEN n > 1e9 THEN printf('%.2f Gb', n / 1e9) WHEN n > 1e6 THEN printf('%.2f Mb', n / 1e6) WHEN n > 1e3 THEN printf('%.2f Kb', n / 1e3) ELSE printf('%d bp', CAST(n AS BIGINT)) END AS size
FROM (SELECT o_orderkey, CAST(CASE o_orderkey % 4 WHEN 0 THEN o_orderkey % 1001 WHEN 1 THEN o_orderkey * 1024 WHEN 2 THEN o_orderkey * 1048576 ELSE 1000 END AS DOUBLE) AS n FROM orders)""")
def human_units(spark, sf):
    k = F.col("o_orderkey")
    n = F.when(k % 4 == 0, k % 1001).when(k % 4 == 1, k * 1024).when(k % 4 == 2, k * 1048576).otherwise(1000)
    return t.table(spark, sf, "orders").select(k.alias("id"), sq.human_bases(n.cast("double")).alias("size"))


@query(f"""WITH {t.EDGES}, x AS (SELECT c1, c2, o1, o2, dist, CASE WHEN support % 3 = 0 THEN 1 ELSE CAST(support % 3 AS INT) END AS std, support FROM edges)
SELECT c1, c2, o1, o2, dist, std, support FROM x WHERE support >= 2 AND dist + 6 * std + 20 - 1 >= 0 AND dist - 6 * std <= 10 + 6 * 2 AND c1 % 7 <> 0 AND c2 % 7 <> 0 AND NOT (c1 % 5 = 0 AND c2 % 5 = 0)""")
def scaffold_edge_filter(spark, sf):
    """Edges fit for scaffolding."""
    e = t.edges(spark, sf).withColumn("std", (F.col("support") % 3).cast("int"))
    contigs = t.parts(spark, sf).select("id", (F.col("id") % 7 == 0).alias("small"), (F.col("id") % 5 == 0).alias("repeat"))
    return ed.scaffold_edges(e, contigs, 10.0, 2.0, threshold=2, k=20).select("c1", "c2", "o1", "o2", "dist", "std", "support")


@query(f"""WITH {CONTIGS}, g AS (SELECT l_orderkey AS edge, l_partkey AS read, l_linenumber AS n, l_linenumber % 2 = 0 AS rev, CAST(trunc(l_quantity) AS INT) AS q FROM lineitem),
c AS (SELECT edge, read, rev, 30 + q AS a, 40 + q + n * 4 - 20 AS b FROM g), j AS (SELECT c.*, seq FROM c JOIN contigs ON key = read)
SELECT edge, read, a AS "start", b AS "end", rev AS reverse, CASE WHEN b < a THEN a - b END AS overlap, CASE WHEN b < a THEN '' WHEN rev THEN reverse(translate(substr(seq, a + 1, b - a), 'ACGT', 'TGCA')) ELSE substr(seq, a + 1, b - a) END AS seq FROM j""")
def gaps_on_reads(spark, sf):
    """Gaps between two contigs on a read, from both alignments, and what the read holds there."""
    li = t.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("edge"), F.col("l_partkey").alias("read"), F.col("l_linenumber").alias("n"), F.col("l_quantity").cast("int").alias("q"))
    struct = lambda s, e: F.struct(F.lit(0).alias("o"), s.alias("s"), e.alias("e"))
    near, far = struct(F.lit(0), 20 + F.col("q")), struct(60 + F.col("q") + F.col("n") * 4 - 35, 90 + F.col("q") + F.col("n") * 4)
    even = F.col("n") % 2 == 0
    on_contig = (struct(F.lit(0), F.lit(390)), struct(F.lit(5), F.lit(60)))
    rows = li.select("edge", "read", F.when(even, far).otherwise(near).alias("r1"), F.when(even, near).otherwise(far).alias("r2"), F.when(even, on_contig[1]).otherwise(on_contig[0]).alias("c1"), F.when(even, on_contig[0]).otherwise(on_contig[1]).alias("c2"), F.lit(400).alias("len1"), F.lit(400).alias("len2"))
    g = gaps.gap_coordinates(rows).select("edge", "read", "start", "end", "reverse")
    seqs = gaps.gap_sequences(g.withColumn("edge", F.struct("edge", "start", "end", "reverse")), _contigs(spark, sf).select(F.col("key").alias("name"), "seq"))
    return seqs.select("edge.edge", "read", "edge.start", "edge.end", "edge.reverse", "overlap", "seq")


@query("""WITH d AS (SELECT s_nationkey AS query, n_name || '/' || s_name AS ref, s_suppkey % 17 / 100.0 AS dist FROM supplier JOIN nation ON (s_suppkey * 7) % 25 = n_nationkey WHERE NOT contains(n_name || '/' || s_name, 'NATION_1'))
SELECT query, ref, dist::DOUBLE AS dist FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY dist, ref) AS rn FROM d) WHERE rn = 1""")
def first_hit_without(spark, sf):
    """The nearest reference of each query, those with a token left out."""
    d = t.table(spark, sf, "supplier").join(t.table(spark, sf, "nation"), (F.col("s_suppkey") * 7) % 25 == F.col("n_nationkey"))
    d = d.select(F.col("s_nationkey").alias("query"), F.concat_ws("/", "n_name", "s_name").alias("ref"), (F.col("s_suppkey") % 17 / 100.0).alias("dist"))
    return tables.first_hit(d, "query", "ref", "dist", skip="NATION_1")


TILES = """a AS (SELECT l_suppkey AS scaffold, l_orderkey % 400 * 100 + l_linenumber AS s, l_partkey % 5 AS contig, l_linenumber * 100 AS cs, l_linenumber * 100 + CASE WHEN l_returnflag = 'R' THEN -50 ELSE 50 END AS ce, l_orderkey AS k FROM lineitem),
m AS (SELECT *, lag(contig) OVER w AS pc, lag(cs) OVER w AS ps, lag(ce) OVER w AS pe FROM a WINDOW w AS (PARTITION BY scaffold ORDER BY s, k, cs, contig, ce)),
n AS (SELECT *, sum(CASE WHEN coalesce(pc = contig AND sign(pe - ps) = sign(ce - cs) AND (cs - ps) * sign(ce - cs) > 0, false) THEN 0 ELSE 1 END) OVER (PARTITION BY scaffold ORDER BY s, k, cs, contig, ce ROWS UNBOUNDED PRECEDING) AS run FROM m),
r AS (SELECT scaffold, contig, run, min(s) AS "start", max(s + 49) AS "end", min(least(cs, ce)) AS cstart, max(greatest(cs, ce)) AS cend, sum(abs(ce - cs) + 1) AS mapped, count(*) AS n FROM n GROUP BY 1, 2, 3)"""


def _runs(spark, sf):
    li = t.table(spark, sf, "lineitem")
    a = li.select(F.col("l_suppkey").alias("scaffold"), (F.col("l_orderkey") % 400 * 100 + F.col("l_linenumber")).alias("s"), (F.col("l_partkey") % 5).alias("contig"), (F.col("l_linenumber") * 100).alias("cs"), F.col("l_orderkey").alias("k"), (F.col("l_linenumber") * 100 + F.when(F.col("l_returnflag") == "R", -50).otherwise(50)).alias("ce"))
    return intervals.merge_consecutive(a.withColumn("e", F.col("s") + 49), "scaffold", ["s", "k", "cs", "contig", "ce"], "contig", "s", "e", "cs", "ce")


@query(f"""WITH {TILES} SELECT scaffold, contig, CAST(run AS BIGINT) AS run, "start", "end", cstart, cend, CAST(mapped AS BIGINT) AS mapped, n FROM r""")
def consecutive_alignments(spark, sf):
    """Consecutive alignments of one contig in one direction as one."""
    return _runs(spark, sf)


@query(f"""WITH {TILES}, f AS (SELECT * FROM r WHERE (CASE WHEN n > 1 THEN 0.97 ELSE 0.5 END >= 0.95 OR contig = scaffold % 5) AND mapped >= 0.9 * (40 + contig * 5))
SELECT scaffold, contig, "start", "end", CAST(mapped AS BIGINT) AS mapped, "start" - lag("end") OVER (PARTITION BY scaffold ORDER BY "start", "end") - 1 AS gap FROM f""")
def tiling(spark, sf):
    """Runs fit for tiling, and the gaps between them."""
    runs = _runs(spark, sf).withColumns({"identity": F.when(F.col("n") > 1, 0.97).otherwise(0.5), "own": F.col("contig") == F.col("scaffold") % 5})
    contigs = spark.range(5).select(F.col("id").alias("contig"), (40 + F.col("id") * 5).alias("length"))
    tiles = intervals.tile(runs, contigs, "contig", identity="identity", own="own")
    return intervals.tile_gaps(tiles, "scaffold").select("scaffold", "contig", "start", "end", "mapped", "gap")


@query("""WITH g AS (SELECT l_suppkey AS scaffold, avg(l_quantity) AS gap_cov FROM lineitem WHERE l_quantity * 1.5 >= l_linenumber * 10 GROUP BY 1), o AS (SELECT s_suppkey AS scaffold, CAST(20 + s_suppkey % 30 AS DOUBLE) AS coverage FROM supplier)
SELECT scaffold, coverage, round(gap_cov, 6) AS gap_cov FROM o JOIN g USING (scaffold) WHERE gap_cov > 0.8 * coverage""")
def repeat_like_scaffolds(spark, sf):
    """Scaffolds whose gaps are covered like themselves."""
    g = t.table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("scaffold"), F.col("l_quantity").alias("coverage"), (F.col("l_linenumber") * 10).alias("subtract"))
    own = t.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("scaffold"), (20 + F.col("s_suppkey") % 30).cast("double").alias("coverage"))
    return tables.repeat_scaffolds(g, own).withColumn("gap_cov", F.round("gap_cov", 6))


@query("""WITH m AS (SELECT l_partkey AS id, list(CAST(l_quantity AS INT) ORDER BY l_quantity) AS q, median(l_quantity) AS med FROM lineitem GROUP BY 1)
SELECT id, array_to_string(list_filter(q, lambda x: x < 1.5 * med), ',') AS kept, med FROM m""")
def window_outliers(spark, sf):
    """Window counts below a multiple of their contig's median."""
    m = t.table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("id")).agg(F.sort_array(F.collect_list(F.col("l_quantity").cast("int"))).alias("q"), F.median("l_quantity").alias("med"))
    return m.select("id", F.array_join(F.transform(cv.window_outliers(F.col("q"), 1.5), lambda x: x.cast("string")), ",").alias("kept"), "med")


@query(f"""WITH m AS (SELECT l_partkey AS id, median(l_quantity) AS median FROM lineitem GROUP BY 1) SELECT id, median FROM m WHERE median > {strain.interval(25.0, 40.0)[0]} AND median < {strain.interval(25.0, 40.0)[1]}""")
def strain_interval(spark, sf):
    """Contigs whose median count lies inside a strain's interval."""
    m = t.table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("id")).agg(F.median("l_quantity").alias("median"))
    return strain.coverage_interval(m, 25.0, 40.0)


@query(f"""WITH {t.EDGES}, {t.PARTS} SELECT c1, c2, support FROM edges JOIN parts a ON a.id = c1 JOIN parts b ON b.id = c2 WHERE round(a.coverage / 20) = round(b.coverage / 20) AND abs(a.coverage - b.coverage) <= 10""")
def paired_ploidy(spark, sf):
    """Edges of contigs with equal copy numbers."""
    return ed.unpaired_ploidy(t.edges(spark, sf).select("c1", "c2", "support"), t.parts(spark, sf), 20.0, 3)


@query(f"""WITH {CONTIGS}, m AS (SELECT key, CASE WHEN key % 2 = 0 THEN lower(seq) ELSE seq END AS s FROM contigs)
SELECT key, regexp_replace(s, '[a-z]', 'x', 'g') AS masked, lower(s) AS low, repeat('N', CAST(key % 5 AS INT)) AS ns, upper(substr(s, 3, 4)) AS part, instr(s, 'AC') AS first_ac, length(s) AS n, replace(s, 'AC', '-') AS cut, translate(s, 'ACGTacgt', 'TGCAtgca') AS other,
  abs(key - 100) AS away, round(ln(key + 1), 6) AS ln, round(pow(key, 0.5), 6) AS root, round(exp(-key / 100.0::DOUBLE), 6) AS decay, least(key, 50) AS lo, greatest(key, 50) AS hi, key BETWEEN 10 AND 20 AS inside, printf('%.2f', key / 7.0::DOUBLE) AS text, regexp_matches(key::VARCHAR, '^[0-9.]*$') AS number, (key & 4) <> 0 AS bit, 1000 - key AS turned FROM m""")
def scalar_functions(spark, sf):
    """Masks, substrings, searches, translation, arithmetic, formats, tests and bits."""
    s = F.when(F.col("key") % 2 == 0, F.lower("seq")).otherwise(F.col("seq"))
    k = F.col("key")
    return _contigs(spark, sf).withColumn("s", s).select("key", sq.mask_lower(F.col("s")).alias("masked"), F.lower("s").alias("low"), F.repeat(F.lit("N"), (k % 5).cast("int")).alias("ns"), F.upper(F.substring("s", 3, 4)).alias("part"), F.instr("s", "AC").alias("first_ac"), F.length("s").alias("n"),
        F.replace("s", F.lit("AC"), F.lit("-")).alias("cut"), F.translate("s", "ACGTacgt", "TGCAtgca").alias("other"), F.abs(k - 100).alias("away"), F.round(F.log(k + 1), 6).alias("ln"), F.round(F.pow(k, F.lit(0.5)), 6).alias("root"), F.round(F.exp(-k / 100.0), 6).alias("decay"), F.least(k, F.lit(50)).alias("lo"), F.greatest(k, F.lit(50)).alias("hi"),
        k.between(10, 20).alias("inside"), F.format_string("%.2f", k / 7.0).alias("text"), sq.is_number(k.cast("string")).alias("number"), (k.bitwiseAND(4) != 0).alias("bit"), (1000 - k).alias("turned"))


@query("""WITH p AS (SELECT p_partkey AS id, regexp_split_to_array('/db/' || p_brand || '/' || p_name || '.fa', '/') AS parts, [p_size, p_partkey % 10, 7] AS x, map {'a': p_size, 'b': p_partkey % 3} AS m FROM part)
SELECT id, parts[-1] AS base, array_to_string(parts[1:len(parts) - 1], '/') AS dir, regexp_replace(parts[-1], '\\.fa$', '.fq') AS renamed, list_sum(list_filter(x, lambda v: v > 5))::BIGINT AS total, list_contains(x, 7) AS has, len(list_append(x, 1))::INT AS n, m['a'] AS a, coalesce(m['c'], -1) AS c, regexp_extract(parts[3], '([0-9]+)', 1) AS digits FROM p""")
def collections_and_paths(spark, sf):
    """Paths, arrays and maps."""
    p = t.table(spark, sf, "part")
    path = F.concat(F.lit("/db/"), F.col("p_brand"), F.lit("/"), F.col("p_name"), F.lit(".fa"))
    x = F.array(F.col("p_size").cast("long"), (F.col("p_partkey") % 10).cast("long"), F.lit(7).cast("long"))
    m = F.create_map(F.lit("a"), F.col("p_size").cast("long"), F.lit("b"), (F.col("p_partkey") % 3).cast("long"))
    p = p.select(F.col("p_partkey").alias("id"), path.alias("path"), x.alias("x"), m.alias("m"))
    base = sq.basename(F.col("path"))
    folder = F.expr("substring(path, 1, length(path) - length(substring_index(path, '/', -1)) - 1)")
    return p.select("id", base.alias("base"), folder.alias("dir"), F.regexp_replace(base, r"\.fa$", ".fq").alias("renamed"), F.aggregate(F.filter("x", lambda v: v > 5), F.lit(0).cast("long"), lambda s, v: s + v).alias("total"), F.array_contains("x", 7).alias("has"), F.size(F.array_append("x", F.lit(1).cast("long"))).alias("n"), F.try_element_at("m", F.lit("a")).alias("a"), F.coalesce(F.try_element_at("m", F.lit("c")), F.lit(-1)).alias("c"), F.regexp_extract("path", r"/db/[^/0-9]*([0-9]+)", 1).alias("digits"))


@query(f"""WITH {CONTIGS}, c AS (SELECT key AS id, 'NN' || seq || 'N' AS seq FROM contigs), h AS (SELECT l_partkey AS id, contains(a, 'GGTCA') OR contains(a, 'TGACC') OR contains(b, 'GGTCA') OR contains(b, 'TGACC') AS hit FROM (SELECT l_partkey, substr(md5(l_orderkey::VARCHAR), 1, 8) AS x, translate(substr(md5(l_orderkey::VARCHAR), 1, 8), '0123456789abcdef', 'ACGTACGTACGTACGT') AS a, translate(substr(md5(l_suppkey::VARCHAR), 1, 4), '0123456789abcdef', 'ACGTACGTACGTACGT') AS b FROM lineitem))
SELECT id, trim(seq, 'N') AS seq FROM c WHERE id NOT IN (SELECT id FROM h WHERE hit) AND length(trim(seq, 'N')) >= 100""")
def patterned_contigs(spark, sf):
    """Contigs that no read pair with a pattern hits, Ns trimmed."""
    letters = lambda c, n: F.translate(F.substring(F.md5(F.col(c).cast("string").cast("binary")), 1, n), "0123456789abcdef", "ACGTACGTACGTACGT")
    c = _contigs(spark, sf).select(F.col("key").alias("id"), F.concat(F.lit("NN"), F.col("seq"), F.lit("N")).alias("seq"))
    pairs = t.table(spark, sf, "lineitem").select(F.col("l_partkey").alias("contig"), letters("l_orderkey", 8).alias("seq1"), letters("l_suppkey", 4).alias("seq2"))
    return gaps.drop_patterned(c, pairs, "GGTCA", 100)


@query(f"""WITH {CONTIGS}, e AS (SELECT key, left(seq, 5) AS head, right(seq, 5) AS tail FROM contigs) SELECT a.key AS a, b.key AS b, a.tail AS kmer FROM e a JOIN e b ON a.tail = b.head AND a.key <> b.key""")
def kmer_links(spark, sf):
    """Contigs whose last k-mer is another's first."""
    return gaps.end_kmer_links(_contigs(spark, sf).select(F.col("key").alias("id"), "seq"), 5)


@query("""SELECT s_suppkey AS id, s_nationkey AS accession, n_name AS name, coalesce(n_regionkey, -1)::INT AS region, n_name IS NULL AS missing FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) ON s_nationkey = n_nationkey""")
def catalog_lookup(spark, sf):
    """Accessions with their catalog row, those the catalog lacks, and a default."""
    cat = t.table(spark, sf, "nation").select(F.col("n_nationkey").alias("accession"), F.col("n_name").alias("name"), F.when(F.col("n_regionkey") != 2, F.col("n_regionkey")).alias("region")).filter("region is not null")
    acc = t.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("accession"))
    known, lacking = gaps.names_by_accession(acc, cat.select("accession", "name"))
    both = known.withColumn("missing", F.lit(False)).unionByName(lacking.withColumn("missing", F.lit(True)), allowMissingColumns=True)
    return tables.lookup_default(both, cat, "accession", "region", -1).select("id", "accession", "name", "region", "missing")


@query("""SELECT p_partkey AS id FROM part WHERE p_brand IN (SELECT DISTINCT p_brand FROM part WHERE p_size IN (SELECT s_suppkey FROM supplier))""")
def contigs_of_species(spark, sf):
    """Contigs of all clusters that share a scaffold's species: two semi joins."""
    p = t.table(spark, sf, "part").select("p_partkey", "p_brand", "p_size")
    s = t.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("p_size"))
    return p.join(p.join(s, "p_size", "left_semi").select("p_brand"), "p_brand", "left_semi").select(F.col("p_partkey").alias("id"))


@query("""WITH d AS (SELECT text FROM documents), s AS (SELECT length(text) AS n FROM d WHERE length(text) >= 300), p AS (SELECT length(c) AS n FROM (SELECT unnest(regexp_split_to_array(text, '[Nn]+')) AS c FROM d) WHERE length(c) >= 40),
a AS (SELECT 'scaffold' AS kind, n FROM s UNION ALL SELECT 'contig', n FROM p), r AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY n DESC) AS rn, sum(n) OVER (PARTITION BY kind ORDER BY n DESC ROWS UNBOUNDED PRECEDING) AS cum, sum(n) OVER (PARTITION BY kind) AS tot FROM a)
SELECT kind, count(*)::BIGINT AS n, max(tot)::BIGINT AS total, max(n) AS longest, max(n) FILTER (cum >= tot * 0.5) AS n50, min(rn) FILTER (cum >= tot * 0.5)::BIGINT AS l50, max(n) FILTER (cum >= tot * 0.9) AS n90, min(rn) FILTER (cum >= tot * 0.9)::BIGINT AS l90 FROM r GROUP BY 1""")
def contigs_in_scaffolds(spark, sf):
    """Figures of scaffolds and of the pieces between their runs of N."""
    return stats.sequence_stats(t.table(spark, sf, "documents").select(F.col("text").alias("seq")), min_contig=40, min_scaffold=300)


@query("""SELECT l_orderkey AS id, round(sum(l_quantity / l_linenumber) / sum(1.0 / l_linenumber), 6)::DOUBLE AS position, min(l_quantity) AS least FROM lineitem GROUP BY 1""")
def running_positions(spark, sf):
    """Positions as means weighted by one over the steps."""
    li = t.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id"), "l_quantity", "l_linenumber")
    return stats.running_position(li, ["id"], "l_quantity", "l_linenumber").withColumn("position", F.round("position", 6))


@query(f"""WITH {CONTIGS}, x AS (SELECT key % 20 AS contig, key % 5 AS start, substr(seq, 1, 20) AS s, CASE WHEN key % 3 = 0 THEN substr(seq, 2, 20) ELSE substr(seq, 1, 20) END AS r, repeat(chr(40 + CAST(key % 30 AS INT)), 20) AS q FROM contigs WHERE n > 1),
y AS (SELECT contig, start + i AS pos, substr(s, CAST(i + 1 AS INT), 1) AS a, substr(r, CAST(i + 1 AS INT), 1) AS b, ord(substr(q, CAST(i + 1 AS INT), 1)) - 33 AS v FROM x, (SELECT unnest(range(20)) AS i))
SELECT contig, pos, round(avg(v), 6) AS quality FROM y WHERE a = b GROUP BY 1, 2""")
def base_quality(spark, sf):
    """Mean quality of aligned bases that match, by position."""
    k = F.col("key")
    x = _contigs(spark, sf).filter("n > 1").select((k % 20).alias("contig"), (k % 5).alias("start"), F.substring("seq", 1, 20).alias("s"), F.when(k % 3 == 0, F.substring("seq", 2, 20)).otherwise(F.substring("seq", 1, 20)).alias("r"), F.repeat(F.char(40 + k % 30), F.lit(20)).alias("q"))
    return tables.per_base_quality(x, "contig", "start", "s", "r", "q").withColumn("quality", F.round("quality", 6))


@query("""WITH o AS (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) = 1) SELECT l_orderkey AS read, l_suppkey AS contig, l_linenumber AS n FROM lineitem WHERE l_orderkey IN (SELECT l_orderkey FROM o)""")
def mapped_once(spark, sf):
    """Reads that map to exactly one contig."""
    return tables.sequence_mappings_once(t.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("read"), F.col("l_suppkey").alias("contig"), F.col("l_linenumber").alias("n")), "read", "contig")


@query("""SELECT p_partkey AS id, p_brand AS cluster, dense_rank() OVER (ORDER BY p_brand) AS number, 'strain_' || dense_rank() OVER (ORDER BY p_brand) || '_contig' || p_partkey AS name FROM part""")
def dense_cluster_ids(spark, sf):
    """Dense cluster numbers and the names made with them."""
    p = trees.dense_ids(t.table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("cluster")), "cluster")
    return p.withColumn("name", F.concat(F.lit("strain_"), F.col("number").cast("string"), F.lit("_contig"), F.col("id").cast("string")))


@query("""WITH l AS (SELECT s_suppkey AS lib, CAST(s_suppkey * 317 % 20000 AS INT) AS mean FROM supplier), r AS (SELECT *, row_number() OVER (PARTITION BY mean >= 10000 ORDER BY mean, lib) AS rn FROM l)
SELECT lib, mean, CAST(CASE WHEN mean < 1000 THEN 0 WHEN mean < 10000 THEN 1 ELSE rn + 1 END AS INT) AS stratum FROM r""")
def library_strata(spark, sf):
    """Strata of libraries by their mean distance."""
    return bundles.library_strata(t.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("lib"), (F.col("s_suppkey") * 317 % 20000).cast("int").alias("mean")))


@query("""SELECT p_brand AS cluster, p_partkey AS id, p_size * 100 AS length, CAST(rn AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_partkey) AS rn FROM part) WHERE rn <= 5""")
def longest_of_cluster(spark, sf):
    """The five longest contigs of each cluster."""
    p = t.parts(spark, sf).select("cluster", "id", "length")
    return stats.top_within(p, ["cluster"], [F.col("length").desc(), F.col("id")], 5)


@query("""WITH a AS (SELECT l_returnflag AS f, l_suppkey AS ref, count(*) AS votes FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1, 2 UNION ALL SELECT l_returnflag, l_suppkey, count(*) FROM lineitem WHERE l_linestatus <> 'O' GROUP BY 1, 2) SELECT f, ref, CAST(sum(votes) AS BIGINT) AS votes FROM a GROUP BY 1, 2""")
def merged_votes(spark, sf):
    """Votes of two tables added up."""
    li = t.table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("f"), F.col("l_suppkey").alias("ref"), (F.col("l_linestatus") == "O").alias("o"))
    a, b = (li.filter(F.col("o") == x).groupBy("f", "ref").agg(F.count("*").alias("votes")) for x in (True, False))
    return tables.merge_votes(a, b, ["f", "ref"])


@query("""SELECT p_partkey AS contig, p_size AS size FROM part WHERE p_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size % 3 > 0)""")
def residual_contigs(spark, sf):
    """Contigs that no strain took."""
    p = t.table(spark, sf, "part").select(F.col("p_partkey").alias("contig"), F.col("p_size").alias("size"))
    return strain.residual_pool(p, p.select("contig", (F.col("size") % 3).alias("strain")))


STRAINS = "st AS (SELECT p_partkey AS contig, CAST(p_size % 3 AS INT) AS strain, p_retailprice AS coverage FROM part)"


@query(f"""WITH {t.EDGES}, {STRAINS}, x AS (SELECT c1, c2, support, a.strain AS s1, b.strain AS s2, a.coverage AS v1, b.coverage AS v2 FROM edges JOIN st a ON a.contig = c1 JOIN st b ON b.contig = c2)
SELECT c1, c2, support, greatest(s1, s2) AS strain, s1 <> s2 AS rescued FROM x WHERE (s1 = s2 AND s1 > 0) OR (s1 > 0 AND s2 = 0 AND v2 < v1) OR (s2 > 0 AND s1 = 0 AND v1 < v2)""")
def strain_edges(spark, sf):
    """Edges inside one strain, and those rescued from contigs of lower coverage."""
    s = t.table(spark, sf, "part").select(F.col("p_partkey").alias("contig"), (F.col("p_size") % 3).cast("int").alias("strain"), F.col("p_retailprice").alias("coverage"))
    return strain.strain_edges(t.edges(spark, sf).select("c1", "c2", "support"), s)


@query("""WITH j AS (SELECT p_partkey, p_size * 100 AS length, p_brand, CASE WHEN p_size > 4 THEN 'S_' || p_size % 5 END AS species FROM part), s AS (SELECT coalesce(species, 'cluster_' || p_brand) AS species, species IS NULL AS free, CAST(sum(length) AS BIGINT) AS total_len, count(*) AS n FROM j GROUP BY 1, 2)
SELECT species, total_len, n FROM s WHERE total_len > CASE WHEN free THEN 500 ELSE 60000 END""")
def strain_candidates(spark, sf):
    """Species with contigs enough for a strain analysis; clusters without a reference by their own."""
    p = t.table(spark, sf, "part").select(F.col("p_partkey").alias("contig"), (F.col("p_size") * 100).alias("length"), F.struct("p_brand", "p_size").alias("cluster"), "p_brand")
    refs = p.select("cluster").distinct().filter("cluster.p_size > 4").withColumn("species", F.concat(F.lit("S_"), (F.col("cluster.p_size") % 5).cast("string")))
    named = p.join(refs, "cluster", "left").select("contig", "length", F.when(F.col("species").isNull(), F.col("p_brand")).otherwise(F.concat_ws("|", "p_brand", F.col("cluster.p_size").cast("string"))).alias("cluster"), "species")
    return strain.strain_candidates(named.select("contig", "length", "cluster"), named.select("cluster", "species").filter("species is not null").distinct(), min_len=60_000, min_len_no_ref=500)


@query("""SELECT l_orderkey AS scaffold, l_partkey AS contig, l_linenumber AS n FROM lineitem WHERE (l_orderkey, l_partkey) IN (SELECT l_orderkey, l_partkey FROM lineitem GROUP BY 1, 2 HAVING count(*) = 1)""")
def valid_tiles(spark, sf):
    """Tiles of contigs that are mapped once on a scaffold; contigs mapped again are repeats there."""
    li = t.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("scaffold"), F.struct("l_orderkey", "l_partkey").alias("contig"), F.col("l_linenumber").alias("n"))
    return gaps.valid_tiles(li).select("scaffold", "contig.l_partkey", "n").withColumnRenamed("l_partkey", "contig")


@query(f"""WITH {CONTIGS}, s AS (SELECT s_suppkey AS scaffold, repeat('ACGT', 30) AS seq FROM supplier), l AS (SELECT DISTINCT s_suppkey AS scaffold, k * 30 AS "start", k * 30 + 9 AS "end", repeat(CASE k WHEN 0 THEN 'x' WHEN 1 THEN 'y' ELSE 'z' END, 10) AS tile FROM supplier, (SELECT unnest(range(3)) AS k) WHERE (s_suppkey + k) % 4 <> 0)
SELECT s.scaffold, substr(seq, 1, 0) || coalesce(max(tile) FILTER ("start" = 0), substr(seq, 1, 10)) || substr(seq, 11, 20) || coalesce(max(tile) FILTER ("start" = 30), substr(seq, 31, 10)) || substr(seq, 41, 20) || coalesce(max(tile) FILTER ("start" = 60), substr(seq, 61, 10)) || substr(seq, 71) AS seq
FROM s LEFT JOIN l USING (scaffold) GROUP BY s.scaffold, seq""")
def spliced_tiles(spark, sf):
    """Tiles laid over a consensus."""
    s = t.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("scaffold"))
    k = s.withColumn("k", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))).filter((F.col("scaffold") + F.col("k")) % 4 != 0)
    tiles = k.select("scaffold", (F.col("k") * 30).alias("start"), (F.col("k") * 30 + 9).alias("end"), F.repeat(F.when(F.col("k") == 0, "x").when(F.col("k") == 1, "y").otherwise("z"), F.lit(10)).alias("tile"))
    return intervals.splice_tiles(s.withColumn("seq", F.repeat(F.lit("ACGT"), F.lit(30))), tiles)


CHAIN = """h AS (SELECT p_partkey AS contig, p_partkey // 3 AS scaffold, CAST(p_partkey % 3 + 1 AS INT) AS pos, CASE WHEN p_size % 2 = 0 THEN '+' ELSE '-' END AS ori, p_size AS length, CASE WHEN p_partkey % 3 = 2 THEN 0 ELSE 5 END AS gap FROM part),
pl AS (SELECT *, coalesce(sum(length + gap) OVER (PARTITION BY scaffold ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bef, sum(length + gap) OVER (PARTITION BY scaffold) AS tot FROM h)"""


def _chain(spark, sf):
    k = F.col("p_partkey")
    return t.table(spark, sf, "part").select(k.alias("contig"), F.floor(k / 3).cast("long").alias("scaffold"), (k % 3 + 1).cast("int").alias("pos"), F.when(F.col("p_size") % 2 == 0, "+").otherwise("-").alias("ori"), F.col("p_size").alias("length"), F.when(k % 3 == 2, 0).otherwise(5).alias("gap"))


@query(f"""WITH {t.EDGES}, {CHAIN}, x AS (SELECT a.scaffold AS c1, b.scaffold AS c2, CASE WHEN a.ori = '+' THEN o1 ELSE {FLIP.format('o1')} END AS o1, CASE WHEN b.ori = '+' THEN o2 ELSE {FLIP.format('o2')} END AS o2, dist, std, support, a.bef AS b1, a.tot - a.bef - a.length AS a1, b.bef AS b2, b.tot - b.bef - b.length AS a2
  FROM edges JOIN pl a ON a.contig = c1 JOIN pl b ON b.contig = c2 WHERE a.scaffold <> b.scaffold)
SELECT c1, o1, c2, o2, CAST(dist - CASE WHEN o1 = '+' THEN a1 ELSE b1 END - CASE WHEN o2 = '+' THEN b2 ELSE a2 END AS BIGINT) AS dist, std, support FROM x""")
def contracted_edges(spark, sf):
    """Edges between scaffolds that have become one contig each."""
    return scaffold.contract(t.edges(spark, sf), _chain(spark, sf))


@query(f"""WITH {t.EDGES}, {CHAIN}, j AS (SELECT c1, c2, o1, o2, bool_or((a.ori = o1 AND b.ori = o2 AND a.bef < b.bef AND b.bef - a.bef - a.length <= dist + 6 * std + 60) OR (a.ori <> o1 AND b.ori <> o2 AND b.bef < a.bef AND a.bef - b.bef - b.length <= dist + 6 * std + 60)) AS ok
  FROM edges JOIN pl a ON a.contig = c1 JOIN pl b ON b.contig = c2 AND a.scaffold = b.scaffold GROUP BY 1, 2, 3, 4) SELECT e.c1, e.c2, coalesce(ok, false) AS satisfied FROM edges e LEFT JOIN j ON j.c1 = e.c1 AND j.c2 = e.c2""")
def satisfied_edges(spark, sf):
    """Edges that the places of their contigs fit."""
    placed = intervals.scaffold_coordinates(_chain(spark, sf), "scaffold", ["pos"], "length", "gap").select("scaffold", "contig", "ori", "start", "length")
    return scaffold.satisfied_repeat_edges(t.edges(spark, sf), placed).select("c1", "c2", "satisfied")


@query(f"""WITH {t.EDGES}, en AS (SELECT p_partkey AS scaffold, CASE WHEN s = 'l' THEN p_size % 4 ELSE p_size % 3 END AS contig, s AS side, CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS ori, p_size AS length FROM part, (VALUES ('l'), ('r')) v(s) WHERE p_size % 2 = 0),
x AS (SELECT e.*, a.contig AS e1, b.contig AS e2, CASE WHEN o1 = '+' THEN a.ori ELSE {FLIP.format('a.ori')} END AS w1, CASE WHEN o2 = '+' THEN b.ori ELSE {FLIP.format('b.ori')} END AS w2, a.length AS l1
  FROM edges e LEFT JOIN en a ON a.scaffold = c1 AND a.side = CASE WHEN o1 = '+' THEN 'r' ELSE 'l' END LEFT JOIN en b ON b.scaffold = c2 AND b.side = CASE WHEN o2 = '+' THEN 'l' ELSE 'r' END)
SELECT c1, c2, o1, o2, CAST(dist + CASE WHEN e1 = e2 AND w1 = w2 THEN l1 ELSE 0 END AS BIGINT) AS dist, support FROM x""")
def adjacent_repeats(spark, sf):
    """Distances of edges between two copies of one repeat."""
    p = t.table(spark, sf, "part")
    side = F.explode(F.array(F.lit("l"), F.lit("r")))
    ends = p.select(F.col("p_partkey").alias("scaffold"), side.alias("side"), "p_size", (F.col("p_partkey") % 2 == 0).alias("even")).select("scaffold", "side", F.when(F.col("side") == "l", F.col("p_size") % 4).otherwise(F.col("p_size") % 3).alias("contig"), F.when(F.col("even"), "+").otherwise("-").alias("ori"), F.col("p_size").alias("length"), (F.col("p_size") % 2 == 0).alias("repeat"))
    e = t.edges(spark, sf).select("c1", "c2", "o1", "o2", F.col("dist").cast("long").alias("dist"), "support")
    return scaffold.adjacent_repeat_correction(e, ends)


@query("""WITH h AS (SELECT p_partkey AS id, CASE p_partkey % 4 WHEN 0 THEN 'x|kraken:taxid|' || p_size || '|y' WHEN 1 THEN p_size::VARCHAR WHEN 2 THEN 'NC_' || p_partkey ELSE 'other' END AS header, CASE WHEN p_partkey % 4 = 2 THEN p_partkey + 1000 END AS known FROM part)
SELECT id, CASE id % 4 WHEN 0 THEN regexp_extract(header, 'taxid\\|([0-9]+)', 1) WHEN 1 THEN header WHEN 2 THEN known::VARCHAR END AS taxid FROM h""")
def header_taxids(spark, sf):
    """Taxonomy ids of headers: a token, a number, or the accession's."""
    k, n = F.col("p_partkey"), F.col("p_size").cast("string")
    header = F.when(k % 4 == 0, F.concat(F.lit("x|kraken:taxid|"), n, F.lit("|y"))).when(k % 4 == 1, n).when(k % 4 == 2, F.concat(F.lit("NC_"), k.cast("string"))).otherwise("other")
    return t.table(spark, sf, "part").select(k.alias("id"), sq.seqid_taxid(header, F.when(k % 4 == 2, k + 1000)).alias("taxid"))


@query("""SELECT l_orderkey AS scaffold, count(*) AS n, CAST(sum(CAST(trunc(l_quantity) AS INT)) AS BIGINT) AS total_len FROM lineitem GROUP BY 1 HAVING count(*) > 1 AND sum(CAST(trunc(l_quantity) AS INT)) > 99""")
def fillable_scaffolds(spark, sf):
    """Scaffolds with gaps to fill."""
    return scaffold.fillable(t.children(spark, sf), min_len=99)


@query("""SELECT doc_id, source FROM documents WHERE text IS NULL OR NOT (contains(text, 'the') OR contains(text, 'und'))""")
def without_words(spark, sf):
    """Rows whose text holds none of some words."""
    return tables.without_any(t.table(spark, sf, "documents"), "text", ["the", "und"]).select("doc_id", "source")


@query("""WITH RECURSIVE d AS (SELECT source, doc_id, n_chars, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents WHERE source IS NOT NULL),
f(source, rn, doc_id, file, held, n) AS (SELECT source, rn, doc_id, 0::BIGINT, CASE WHEN n_chars > 20000 THEN 0 ELSE n_chars END, 1 FROM d WHERE rn = 1
  UNION ALL SELECT d.source, d.rn, d.doc_id, f.file + CASE WHEN f.held = 0 THEN 1 ELSE 0 END, CASE WHEN f.held + d.n_chars > 20000 THEN 0 ELSE f.held + d.n_chars END, 1 FROM f JOIN d ON d.source = f.source AND d.rn = f.rn + 1)
SELECT source, doc_id, file FROM f""", fold=True)
def packed_files(spark, sf):
    """Files that are closed once they have passed a size, then begin at zero."""
    d = t.table(spark, sf, "documents").select("source", "doc_id", "n_chars")
    return tables.packed_files(d, ["source"], ["doc_id"], "n_chars", 20_000).select("source", "doc_id", "file")


@query("""WITH w AS (SELECT l_partkey AS id, l_returnflag AS sample, avg(l_quantity) AS mean, var_pop(l_quantity) AS variance FROM lineitem GROUP BY 1, 2), d AS (SELECT *, mean * mean / (variance - mean) AS r FROM w WHERE variance > mean AND mean > 0)
SELECT sample, round(sum(mean ** 4) / sum(mean * mean * variance - mean ** 3), 6) AS r, round(min(r), 6) AS min_r FROM d GROUP BY 1""")
def sample_dispersion(spark, sf):
    """Dispersion of every sample, untrimmed, and its least value."""
    w = t.table(spark, sf, "lineitem").select(F.col("l_partkey").alias("id"), F.col("l_returnflag").alias("sample"), F.col("l_quantity").alias("n"), F.lit(20_000).alias("length"))
    m = cv.moment_dispersion(cv.contig_moments(w, ["id", "sample", "length"]))
    return cv.trimmed_dispersion(m, ["sample"], "id", trim=0.0).select("sample", F.round("r", 6).alias("r"), F.round("min_r", 6).alias("min_r"))


@query("""WITH o AS (SELECT l_orderkey AS scaffold, list(l_partkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS x FROM lineitem GROUP BY 1) SELECT scaffold, array_to_string(x, ',') AS contigs, x[1] AS first, x[-1] AS last FROM o""")
def ordered_children(spark, sf):
    """Children of a scaffold as a list, in order."""
    o = t.children(spark, sf).groupBy("scaffold").agg(F.array_sort(F.collect_list(F.struct(*t.ORDER))).alias("x"))
    return o.select("scaffold", F.array_join(F.transform("x", lambda v: v["contig"].cast("string")), ",").alias("contigs"), F.element_at("x", 1)["contig"].alias("first"), F.element_at("x", -1)["contig"].alias("last"))
