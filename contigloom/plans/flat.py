"""Queries that SQL can express, each with its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contigloom.functions import probability as pr
from contigloom.functions import sequence as sq
from contigloom.operators import coverage as cv
from contigloom.operators import edges as ed
from contigloom.operators import graph, intervals, stats, tables, trees
from contigloom.plans import tables as t

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return register


def _nx(source: str, length: str, by: str, strict: bool = False, x: tuple[int, ...] = (50, 90)) -> str:
    """CTE nx: per group the figures of nx_lx."""
    op = ">" if strict else ">="
    part = f"PARTITION BY {by} " if by else ""
    first = f"{by}, " if by else ""
    cols = ", ".join(f"max({length}) FILTER (cum {op} tot * {p / 100}::DOUBLE) AS n{p}, min(rn) FILTER (cum {op} tot * {p / 100}::DOUBLE)::BIGINT AS l{p}" for p in x)
    return f"""run AS (SELECT *, row_number() OVER ({part}ORDER BY {length} DESC) AS rn, sum({length}) OVER ({part}ORDER BY {length} DESC ROWS UNBOUNDED PRECEDING) AS cum, sum({length}) OVER ({part}) AS tot FROM {source} WHERE {length} IS NOT NULL),
nx AS (SELECT {first}count(*)::BIGINT AS n, max(tot)::BIGINT AS total, max({length}) AS longest, {cols} FROM run{f' GROUP BY {by}' if by else ''})"""


@query(f"WITH {_nx('documents', 'n_chars', 'lang')} SELECT * FROM nx")
def nx_lx_by_lang(spark, sf):
    return stats.nx_lx(t.table(spark, sf, "documents"), "n_chars", ["lang"])


@query(f"""WITH d AS (SELECT n_chars * 100 AS length FROM documents), {_nx('d', 'length', '', x=(50,))}
SELECT n, total, longest, n50, n_100k, n_500k, n_1m FROM nx, (SELECT count(*) FILTER (length >= 100000) AS n_100k, count(*) FILTER (length >= 500000) AS n_500k, count(*) FILTER (length >= 1000000) AS n_1m FROM d)""")
def assembly_stats(spark, sf):
    return stats.assembly_stats(t.table(spark, sf, "documents").select((F.col("n_chars") * 100).alias("length")))


@query(f"WITH {_nx('documents', 'n_chars', 'source', True, (50,))} SELECT source, n, total, longest, n50, l50 FROM nx")
def n50_strict(spark, sf):
    return stats.nx_lx(t.table(spark, sf, "documents"), "n_chars", ["source"], x=(50,), strict=True)


@query("""WITH d AS (SELECT n_chars AS length, length(text) - length(translate(text, 'Nn', '')) AS k FROM documents), c(at_least) AS (VALUES (0), (100), (500), (1000), (10000), (100000), (1000000))
SELECT at_least, count(length)::BIGINT AS n, coalesce(sum(length), 0)::BIGINT AS bases, coalesce(sum(k), 0)::BIGINT AS n_bases FROM c LEFT JOIN d ON length >= at_least GROUP BY 1""")
def size_classes(spark, sf):
    return stats.size_classes(t.table(spark, sf, "documents").select("n_chars", sq.count_n(F.col("text")).alias("k")), "n_chars", "k")


@query(f"WITH {t.PARTS} SELECT cluster, round(sum(coverage * length) / sum(length), 2) AS coverage FROM parts GROUP BY 1")
def weighted_coverage(spark, sf):
    return stats.weighted_coverage(t.parts(spark, sf), ["cluster"], "coverage", "length")


@query(f"""WITH {t.PARTS}, g AS (SELECT id, length, greatest((length - 160) // 340, 0) AS num_windows FROM parts), h AS (SELECT *, length - num_windows * 340 AS rest FROM g)
SELECT id, length, num_windows::INT AS num_windows, (rest // 2)::INT AS left_edge, (length - 1 - (rest - rest // 2))::INT AS right_edge, (length - 1 - (rest - rest // 2) - rest // 2 + 1)::INT AS modified_length FROM h""")
def window_geometry(spark, sf):
    return cv.window_geometry(t.parts(spark, sf).select("id", "length"))


def _windows(spark, sf, sample=True):
    hits = t.hits(spark, sf)
    contigs = hits.select("id").distinct().withColumns(cv.geometry_columns(F.lit(t.SPAN), 86_400, 3600))
    return cv.window_counts(hits, contigs, 86_400, sample="sample" if sample else None)


WINDOWS = f"""{t.HITS}, geo AS (SELECT 30 AS nw, ({t.SPAN} - 30 * 86400) // 2 AS le),
grid AS (SELECT i.id, s.sample, w.win FROM (SELECT DISTINCT id FROM hits) i, (SELECT DISTINCT sample FROM hits) s, (SELECT unnest(range(0, 30))::INT AS win) w),
counted AS (SELECT id, sample, CAST(floor((pos - le) / 86400.0) AS INT) AS win, count(*) AS n FROM hits, geo GROUP BY 1, 2, 3),
windows AS (SELECT g.id, g.sample, g.win, coalesce(n, 0)::BIGINT AS n FROM grid g LEFT JOIN counted c ON g.id = c.id AND g.sample = c.sample AND g.win = c.win)"""


@query(f"WITH {WINDOWS} SELECT * FROM windows")
def window_counts(spark, sf):
    return _windows(spark, sf)


MOMENTS = f"""{WINDOWS}, moments AS (SELECT id, sample, sum(n)::BIGINT AS sum_count, count(*) AS windows, avg(n) AS mean, var_pop(n) AS variance FROM windows GROUP BY 1, 2)"""


@query(f"WITH {MOMENTS} SELECT id, sample, sum_count, windows, round(mean, 6) AS mean, round(variance, 6) AS variance, round(sum_count / (windows * 86400.0), 9) AS coverage FROM moments")
def window_moments(spark, sf):
    m = cv.contig_moments(_windows(spark, sf), ["id", "sample"])
    return m.select("id", "sample", "sum_count", "windows", F.round("mean", 6).alias("mean"), F.round("variance", 6).alias("variance"), F.round(F.col("sum_count") / (F.col("windows") * 86_400.0), 9).alias("coverage"))


@query(f"""WITH {WINDOWS}, l AS (SELECT id, list_sort(list(n)) AS v FROM windows GROUP BY 1), m AS (SELECT id, CASE WHEN len(v) % 2 = 1 THEN v[len(v) // 2 + 1] ELSE (v[len(v) // 2] + v[len(v) // 2 + 1]) // 2 END::BIGINT AS median FROM l)
SELECT m.id, median, round(r.rate, 9) AS rate FROM m JOIN (SELECT id, sum(n) / (count(*) * 86400.0) AS rate FROM windows GROUP BY 1) r ON m.id = r.id""")
def median_arrival_intdiv(spark, sf):
    w = _windows(spark, sf)
    medians = w.groupBy("id").agg(cv.integer_median(F.collect_list("n")).cast("long").alias("median"))  # windows per contig are bounded by its length
    rates = cv.arrival_rate(w.withColumn("size", F.lit(86_400.0)), ["id"], "n", "size")
    return medians.join(rates, "id").select("id", "median", F.round("rate", 9).alias("rate"))


@query(f"WITH {MOMENTS} SELECT id, sample, round(mean * mean / (variance - mean), 6) AS r FROM moments WHERE variance > mean AND mean > 0")
def nb_dispersion(spark, sf):
    m = cv.contig_moments(_windows(spark, sf), ["id", "sample"]).withColumn("length", F.lit(t.SPAN))
    return cv.moment_dispersion(m).select("id", "sample", F.round("r", 6).alias("r"))


@query(f"""WITH {MOMENTS}, d AS (SELECT *, mean * mean / (variance - mean) AS r FROM moments WHERE variance > mean AND mean > 0),
k AS (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY r, id) AS rn, count(*) OVER (PARTITION BY sample) AS cnt FROM d)
SELECT sample, round(sum(mean ** 4) / sum(mean * mean * variance - mean ** 3), 4) AS r, round(min(r), 4) AS min_r FROM k WHERE rn > floor(cnt * 0.1::DOUBLE) AND rn <= cnt - floor(cnt * 0.1::DOUBLE) GROUP BY 1""")
def nb_dispersion_trimmed(spark, sf):
    m = cv.contig_moments(_windows(spark, sf), ["id", "sample"]).withColumn("length", F.lit(t.SPAN))
    d = cv.trimmed_dispersion(cv.moment_dispersion(m), ["sample"], "id")
    return d.select("sample", F.round("r", 4).alias("r"), F.round("min_r", 4).alias("min_r"))


@query(f"""WITH {WINDOWS}, x AS (SELECT id, unnest([n::DOUBLE, n * sqrt(2.0), n / sqrt(2.0)]) AS v FROM windows) SELECT id, round(avg(v), 6) AS mean, round(var_pop(v), 6) AS variance FROM x GROUP BY 1""")
def dispersed_variance(spark, sf):
    d = cv.dispersed_variance(_windows(spark, sf), ["id"])
    return d.select("id", F.round("mean", 6).alias("mean"), F.round("variance", 6).alias("variance"))


@query("""SELECT p_partkey AS id, round(5 * ln(5 / (5 + m)) + lgamma(5 + k) + k * ln(m / (5 + m)) - lgamma(k + 1) - lgamma(5), 6) AS logp FROM (SELECT p_partkey, p_size::DOUBLE AS k, p_retailprice / 100 AS m FROM part)""")
def nb_logpmf(spark, sf):
    p = t.table(spark, sf, "part")
    return p.select(F.col("p_partkey").alias("id"), F.round(pr.nb_logpmf(F.col("p_size").cast("double"), F.col("p_retailprice") / 100, F.lit(5.0)), 6).alias("logp"))


@query("""SELECT p_partkey AS id, round(k * ln(m) - m - lgamma(k + 1), 6) AS logp FROM (SELECT p_partkey, p_size::DOUBLE AS k, round(p_retailprice / 100) AS m FROM part)""")
def poisson_logpmf(spark, sf):
    p = t.table(spark, sf, "part")
    return p.select(F.col("p_partkey").alias("id"), F.round(pr.poisson_logpmf(F.col("p_size").cast("double"), F.col("p_retailprice") / 100), 6).alias("logp"))


@query("""WITH o AS (SELECT l_returnflag, l_extendedprice AS v, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) - 1 AS i, count(*) OVER (PARTITION BY l_returnflag) AS c FROM lineitem),
q AS (SELECT l_returnflag, max(v) FILTER (i = floor(c * 0.25::DOUBLE)) AS q1, max(v) FILTER (i = floor(c * 0.75::DOUBLE)) AS q3 FROM o GROUP BY 1)
SELECT o.l_returnflag, round(q1, 4) AS q1, round(q3, 4) AS q3, count(*) AS n, round(avg(v), 3) AS mean, round(stddev_pop(v), 3) AS std FROM o JOIN q ON o.l_returnflag = q.l_returnflag WHERE v BETWEEN q1 - 0.2 * (q3 - q1) AND q3 + 0.2 * (q3 - q1) GROUP BY 1, 2, 3""")
def iqr_trimmed_stats(spark, sf):
    s = stats.iqr_stats(t.table(spark, sf, "lineitem"), "l_extendedprice", ["l_returnflag"], 0.2)
    return s.select("l_returnflag", F.round("q1", 4).alias("q1"), F.round("q3", 4).alias("q3"), "n", F.round("mean", 3).alias("mean"), F.round("std", 3).alias("std"))


@query("SELECT l_linestatus, l_quantity, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY l_linestatus), 9) AS p FROM lineitem GROUP BY 1, 2")
def distance_distribution(spark, sf):
    d = stats.distribution(t.table(spark, sf, "lineitem"), ["l_linestatus"], "l_quantity")
    return d.withColumn("p", F.round("p", 9))


@query(f"WITH {t.EDGES} SELECT c1, c2, c1 || '-vs-' || c2 AS edge, support FROM edges WHERE support >= 2")
def read_pair_edges(spark, sf):
    lines = t.table(spark, sf, "lineitem")
    e = ed.pair_support(ed.read_pair_edges(lines, "l_orderkey", "l_linenumber", "l_partkey")).filter("support >= 2")
    # ids in numeric order here, so the name keeps that order
    return e.select("c1", "c2", F.concat_ws("-vs-", "c1", "c2").alias("edge"), "support")


CODES = f"""{t.EDGES}, known AS (SELECT p_partkey AS id FROM part WHERE p_size > 5),
coded AS (SELECT e.*, CASE WHEN a.id IS NULL OR b.id IS NULL THEN 1 ELSE 0 END + CASE WHEN support < 2 THEN 3 ELSE 0 END + CASE WHEN dist >= 0 OR dist + 6 * std + 2 > 0 THEN 0 ELSE 5 END AS skip_code
  FROM edges e LEFT JOIN known a ON c1 = a.id LEFT JOIN known b ON c2 = b.id)"""


def _coded(spark, sf):
    known = t.parts(spark, sf).filter("length > 500")
    return ed.validate_edges(t.edges(spark, sf), known, k=2)


@query(f"WITH {CODES} SELECT c1, c2, dist, std, support, skip_code::INT AS skip_code FROM coded")
def edge_validity_codes(spark, sf):
    return _coded(spark, sf).select("c1", "c2", "dist", "std", "support", "skip_code")


@query(f"WITH {CODES} SELECT skip_code::INT AS skip_code, count(*) AS n, sum(support)::BIGINT AS support FROM coded WHERE skip_code <> 0 GROUP BY 1")
def rejected_rows_split(spark, sf):
    rejected = _coded(spark, sf).filter("skip_code <> 0")
    return rejected.groupBy("skip_code").agg(F.count("*").alias("n"), F.sum("support").alias("support"))


@query("""WITH d AS (SELECT l_orderkey, l_linenumber, CAST(trunc(l_extendedprice / 2 - 200) AS INT) AS d FROM lineitem)
SELECT CASE WHEN d > -200 AND d < 300 THEN 0 WHEN d >= 300 AND d < 1000 THEN 1 WHEN d >= 1000 AND d < 2000 THEN 2 WHEN d >= 2000 AND d < 5000 THEN 3 WHEN d >= 5000 AND d < 15000 THEN 4 WHEN d >= 15000 AND d < 40000 THEN 5 END AS bucket,
count(*) AS n, sum(CAST(trunc(abs(d) * 0.1::DOUBLE + 50) AS INT))::BIGINT AS std, sum(CAST(trunc(d + abs(d) * 0.09::DOUBLE) AS INT) - 3)::BIGINT AS gap FROM d GROUP BY 1""")
def edge_distance_buckets(spark, sf):
    d = t.table(spark, sf, "lineitem").select((F.col("l_extendedprice") / 2 - 200).cast("int").alias("d"))
    gap = ed.gap_distance(F.lit(0), F.col("d"), F.lit(1), F.lit(5), F.lit(3))
    return d.groupBy(ed.distance_bucket(F.col("d")).alias("bucket")).agg(F.count("*").alias("n"), F.sum(ed.distance_std(F.col("d"))).alias("std"), F.sum(gap).alias("gap"))


@query(f"""WITH {t.EDGES}, r AS (SELECT c1, c2, (c1 + c2) % 3 AS lib, support, ln(support / (least(a.p_retailprice, b.p_retailprice) + 0.0001)) AS ratio FROM edges JOIN part a ON c1 = a.p_partkey JOIN part b ON c2 = b.p_partkey),
s AS (SELECT lib, median(ratio) AS m, stddev_pop(ratio) AS sd FROM r WHERE support > 1 GROUP BY 1)
SELECT r.lib, c1, c2, support, round(ratio, 6) AS ratio, coalesce(ratio > m - 1.5 * sd AND support > 1, false) AS keep FROM r LEFT JOIN s ON r.lib = s.lib""")
def edge_ratio_filter(spark, sf):
    e = t.edges(spark, sf).withColumn("lib", (F.col("c1") + F.col("c2")) % 3)
    out = ed.filter_edge_ratio(e, t.parts(spark, sf))
    return out.select("lib", "c1", "c2", "support", F.round("ratio", 6).alias("ratio"), "keep")


@query("""SELECT l_suppkey, round(sum(l_quantity / (v * v)) / sum(1 / (v * v)), 6) AS mean, round(1 / sqrt(sum(1 / (v * v))), 6) AS std, count(*) AS n FROM (SELECT l_suppkey, l_quantity, (l_linenumber + 1)::DOUBLE AS v FROM lineitem) GROUP BY 1""")
def inverse_variance_bundle(spark, sf):
    d = stats.inverse_variance(t.table(spark, sf, "lineitem").withColumn("v", F.col("l_linenumber") + 1.0), ["l_suppkey"], "l_quantity", "v")
    return d.select("l_suppkey", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "n")


@query(f"""WITH {t.PARTS}, m AS (SELECT cluster, median(coverage) AS median FROM parts GROUP BY 1)
SELECT id, parts.cluster, coverage, round(median, 6) AS median FROM parts JOIN m ON parts.cluster = m.cluster WHERE coverage > 1.005 * median""")
def repeat_contigs_cluster(spark, sf):
    p = t.parts(spark, sf)
    return ed.cluster_repeats(p.select("id", "coverage"), p.select("id", "cluster"), "id", factor=1.005).select("id", "cluster", "coverage", F.round("median", 6).alias("median"))


@query(f"WITH {t.PARTS}, h AS (SELECT sum(coverage * length) / sum(length) / 2 AS h FROM parts) SELECT id, coverage > h * 2.5 AS repeat FROM parts, h")
def repeat_contigs_global(spark, sf):
    return ed.flag_repeats(t.parts(spark, sf), ploidy=2).select("id", "repeat")


RATES = "rates AS (SELECT p.p_partkey AS id, s.sample, coalesce(q, 0)::DOUBLE AS rate FROM part p CROSS JOIN (SELECT DISTINCT l_returnflag AS sample FROM lineitem) s LEFT JOIN (SELECT l_partkey, l_returnflag, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2) x ON x.l_partkey = p.p_partkey AND x.l_returnflag = s.sample)"


def _rates(spark, sf):
    li = t.table(spark, sf, "lineitem")
    q = li.groupBy(F.col("l_partkey").alias("id"), F.col("l_returnflag").alias("sample")).agg(F.sum("l_quantity").alias("q"))
    grid = t.parts(spark, sf).select("id").crossJoin(F.broadcast(li.select(F.col("l_returnflag").alias("sample")).distinct()))  # a handful of samples
    return grid.join(q, ["id", "sample"], "left").select("id", "sample", F.coalesce("q", F.lit(0.0)).alias("rate"))


@query(f"""WITH {t.EDGES}, {RATES}, w AS (SELECT c1, c2, greatest(a.rate, b.rate) AS hi, least(a.rate, b.rate) AS lo FROM edges JOIN rates a ON c1 = a.id JOIN rates b ON c2 = b.id AND a.sample = b.sample WHERE support >= 2)
SELECT c1, c2, round(max(CASE WHEN hi = 0 THEN 0 ELSE (hi - lo) / hi END), 6) AS weight FROM w GROUP BY 1, 2""")
def relative_rate_distance(spark, sf):
    return ed.relative_rate_distance(t.edges(spark, sf, 2), _rates(spark, sf)).withColumn("weight", F.round("weight", 6))


@query(f"""WITH {t.EDGES}, {RATES}, w AS (SELECT c1, c2, greatest(a.rate, b.rate) AS hi, least(a.rate, b.rate) AS lo FROM edges JOIN rates a ON c1 = a.id JOIN rates b ON c2 = b.id AND a.sample = b.sample WHERE support >= 2)
SELECT c1, c2, round(coalesce(sum(CASE WHEN hi > 0 THEN (hi - lo) / hi END) / count(*) FILTER (hi > 0), 0), 6) AS weight FROM w GROUP BY 1, 2""")
def average_rate_distance(spark, sf):
    return ed.average_rate_distance(t.edges(spark, sf, 2), _rates(spark, sf)).withColumn("weight", F.round("weight", 6))


COMPONENTS = """arcs AS (SELECT {a} AS u, {b} AS v FROM {edges} UNION SELECT {b}, {a} FROM {edges}), lab(u, label) AS (SELECT DISTINCT u, u FROM arcs UNION SELECT b.v, l.label FROM lab l JOIN arcs b ON b.u = l.u WHERE l.label < b.v)"""


@query("WITH RECURSIVE " + t.EDGES + ", strong AS (SELECT c1, c2 FROM edges WHERE support >= 3), " + COMPONENTS.format(a="c1", b="c2", edges="strong") + " SELECT u AS vertex, min(label) AS component FROM lab GROUP BY 1")
def connected_components(spark, sf):
    return graph.connected_components(t.edges(spark, sf, 3), "c1", "c2")


@query("WITH RECURSIVE " + t.DISTANCES + ", near AS (SELECT a, b FROM dists WHERE dist < 0.3), " + COMPONENTS.format(a="a", b="b", edges="near") + """
SELECT x.vertex, coalesce(c, x.vertex) AS component FROM (SELECT DISTINCT a AS vertex FROM dists UNION SELECT DISTINCT b FROM dists) x LEFT JOIN (SELECT u, min(label) AS c FROM lab GROUP BY 1) y ON x.vertex = y.u""")
def single_linkage_cut(spark, sf):
    return trees.single_linkage_cut(t.vector_distances(spark, sf), 0.3)


@query(f"""WITH {t.DISTANCES}, d AS (SELECT a AS query, b AS ref, dist FROM dists UNION ALL SELECT b, a, dist FROM dists)
SELECT query, ref, dist, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY dist, ref) AS rank FROM d) WHERE rank <= 5""")
def top5_references(spark, sf):
    d = t.vector_distances(spark, sf)
    both = d.select(F.col("a").alias("query"), F.col("b").alias("ref"), "dist").union(d.select("b", "a", "dist"))
    return tables.top_references(both)


@query(f"""WITH {t.DISTANCES}, d AS (SELECT b AS query, a AS ref, dist FROM dists WHERE dist < 0.9), q AS (SELECT vec_id AS query FROM embeddings),
h AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY dist, ref) AS rn FROM d) WHERE rn = 1)
SELECT q.query, coalesce(CAST(ref AS VARCHAR), 'UNKNOWN') AS ref, coalesce(dist, 1) AS dist, coalesce(dist, 1) < 0.5 AS near FROM q LEFT JOIN h ON q.query = h.query""")
def best_hit(spark, sf):
    d = t.vector_distances(spark, sf).filter("dist < 0.9").select(F.col("b").alias("query"), F.col("a").alias("ref"), "dist")
    q = t.table(spark, sf, "embeddings").select(F.col("vec_id").alias("query"))
    hit = d.groupBy("query").agg(F.min_by(F.struct(F.col("ref").cast("string").alias("ref"), "dist"), F.struct("dist", "ref")).alias("h")).select("query", "h.ref", "h.dist")
    return tables.best_hit(hit, q, cutoff=0.5)


@query("""WITH r AS (SELECT DISTINCT p_brand AS c, p_type AS ref FROM part) SELECT x.c AS a, y.c AS b, count(*) AS shared FROM r x JOIN r y ON x.ref = y.ref AND x.c < y.c GROUP BY 1, 2""")
def shared_reference_pairs(spark, sf):
    return tables.shared_reference_pairs(t.table(spark, sf, "part").select(F.col("p_brand").alias("cluster"), F.col("p_type").alias("ref")))


@query("""SELECT s_suppkey AS contig, s_nationkey AS cluster, coalesce(CASE WHEN n_regionkey < 3 THEN n_regionkey * 1000 END, s_nationkey)::INT AS super_cluster FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""")
def label_propagation(spark, sf):
    supers = t.table(spark, sf, "nation").select(F.col("n_nationkey").alias("cluster"), F.when(F.col("n_regionkey") < 3, F.col("n_regionkey") * 1000).alias("super_cluster"))
    members = t.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("contig"), F.col("s_nationkey").alias("cluster"))
    return trees.relabel(members, supers).select("contig", "cluster", "super_cluster")


ABUNDANCE = """p AS (SELECT source AS name, coalesce(lang IN ('en', 'de'), false) AS side, 100.0 * sum(n_chars) / sum(sum(n_chars)) OVER (PARTITION BY coalesce(lang IN ('en', 'de'), false)) AS pct FROM documents GROUP BY 1, 2),
x AS (SELECT name, pct FROM p WHERE side AND pct > 4.5), y AS (SELECT name, pct FROM p WHERE NOT side AND pct > 4.5),
j AS (SELECT coalesce(x.name, y.name) AS name, coalesce(x.pct, 0)::DOUBLE AS a_pct, coalesce(y.pct, 0)::DOUBLE AS b_pct FROM x FULL JOIN y ON x.name = y.name)"""


def _abundance(spark, sf):
    side = F.coalesce(F.col("lang").isin("en", "de"), F.lit(False)).alias("side")
    p = t.table(spark, sf, "documents").groupBy(F.col("source").alias("name"), side).agg(F.sum("n_chars").alias("k"))
    p = p.withColumn("pct", 100.0 * F.col("k") / F.sum("k").over(Window.partitionBy("side")))
    return tables.concordance(p.filter("side"), p.filter(~F.col("side")), min_pct=4.5)


@query(f"WITH {ABUNDANCE} SELECT name, round(a_pct, 6) AS a_pct, round(b_pct, 6) AS b_pct FROM j")
def abundance_full_outer(spark, sf):
    return _abundance(spark, sf).select("name", F.round("a_pct", 6).alias("a_pct"), F.round("b_pct", 6).alias("b_pct"))


@query(f"WITH {ABUNDANCE} SELECT round(corr(a_pct, b_pct), 6) AS r, count(*) AS n FROM j")
def abundance_correlation(spark, sf):
    return tables.correlation(_abundance(spark, sf)).select(F.round("r", 6).alias("r"), "n")


BINS = "bins AS (SELECT s_suppkey AS bin, (s_acctbal + 1000) / 110 AS completeness, (s_suppkey % 13)::DOUBLE AS contamination FROM supplier)"
TIERS = f"{BINS}, tiers AS (SELECT bin, CASE WHEN completeness >= 90 AND contamination <= 5 THEN 'HIGH' WHEN completeness >= 50 AND contamination <= 10 THEN 'MEDIUM' ELSE 'LOW' END AS tier FROM bins)"


def _tiers(spark, sf):
    bins = t.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("bin"), ((F.col("s_acctbal") + 1000) / 110).alias("completeness"), (F.col("s_suppkey") % 13).cast("double").alias("contamination"))
    return tables.quality_tier(bins).select("bin", "tier")


@query(f"WITH {TIERS} SELECT * FROM tiers")
def quality_tiers(spark, sf):
    return _tiers(spark, sf)


@query(f"""WITH {TIERS}, m AS (SELECT bin AS mag, tier FROM tiers WHERE tier <> 'LOW'), {t.DISTANCES},
h AS (SELECT b % 97 AS mag, min(dist) FILTER (a % 2 = 0) AS tax_dist, min(dist) FILTER (a % 2 = 1) AS novel_dist FROM dists GROUP BY 1)
SELECT m.mag, tier, tax_dist, novel_dist, CASE WHEN tax_dist IS NULL AND novel_dist IS NULL THEN 'NO_REF' WHEN tax_dist <= 0.2 THEN 'KNOWN' WHEN novel_dist <= 0.2 THEN 'SEEN' ELSE 'NOVEL' END AS status FROM m LEFT JOIN h ON m.mag = h.mag""")
def novelty_status(spark, sf):
    mags = _tiers(spark, sf).filter("tier <> 'LOW'").withColumnRenamed("bin", "mag")
    d = t.vector_distances(spark, sf).withColumn("mag", F.col("b") % 97)
    return tables.novelty(mags, d.filter("a % 2 = 0"), d.filter("a % 2 = 1"), cutoff=0.2).select("mag", "tier", "tax_dist", "novel_dist", "status")


@query("""WITH d AS (SELECT x.n_nationkey AS a, y.n_nationkey AS b, (x.n_nationkey * 7 + y.n_nationkey) / 1000.0 AS dist FROM nation x JOIN nation y ON x.n_regionkey = y.n_regionkey AND x.n_nationkey < y.n_nationkey),
k AS (SELECT a AS k FROM d UNION SELECT b FROM d)
SELECT x.k AS a, y.k AS b, (CASE WHEN x.k = y.k THEN 0 ELSE coalesce(dist, 1) END)::DOUBLE AS dist FROM k x CROSS JOIN k y LEFT JOIN d ON d.a = x.k AND d.b = y.k""")
def matrix_completion(spark, sf):
    n = t.table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    d = n.withColumnRenamed("n_nationkey", "a").join(n.withColumnRenamed("n_nationkey", "b"), "n_regionkey").filter("a < b").select("a", "b", ((F.col("a") * 7 + F.col("b")) / 1000.0).alias("dist"))
    return tables.complete_matrix(d)


@query(f"""WITH {t.CHILDREN}, {t.EDGES}, n AS (SELECT scaffold, contig AS a, lead(contig) OVER (PARTITION BY scaffold ORDER BY line, contig, supp, price) AS b FROM children)
SELECT scaffold, a, b, support, dist FROM n LEFT JOIN edges ON c1 = least(a, b) AND c2 = greatest(a, b) WHERE b IS NOT NULL""")
def adjacent_pairs(spark, sf):
    return ed.adjacent_pairs(t.children(spark, sf), t.edges(spark, sf), "scaffold", t.ORDER, "contig").select("scaffold", "a", "b", "support", "dist")


@query(f"""WITH {t.CHILDREN}, {t.EDGES}, o AS (SELECT *, row_number() OVER (PARTITION BY scaffold ORDER BY line, contig, supp, price) AS pos FROM children),
z AS (SELECT scaffold, sum(length)::BIGINT AS total_len, arg_max(contig, pos) AS c1, arg_max(ori, pos) AS o1, arg_min(contig, pos) AS c2, arg_min(ori, pos) AS o2 FROM o GROUP BY 1),
f AS (SELECT scaffold, total_len, least(c1, c2) AS c1, greatest(c1, c2) AS c2, CASE WHEN c1 > c2 THEN CASE o2 WHEN '+' THEN '-' ELSE '+' END ELSE o1 END AS o1, CASE WHEN c1 > c2 THEN CASE o1 WHEN '+' THEN '-' ELSE '+' END ELSE o2 END AS o2 FROM z WHERE total_len > 30 AND c1 <> c2)
SELECT scaffold, total_len, f.c1, f.o1, f.c2, f.o2, support FROM f JOIN edges e ON f.c1 = e.c1 AND f.c2 = e.c2 AND f.o1 = e.o1 AND f.o2 = e.o2 WHERE support >= 1""")
def circular_candidates(spark, sf):
    c = t.children(spark, sf).withColumn("pos", F.row_number().over(Window.partitionBy("scaffold").orderBy(*t.ORDER)))
    return ed.circular(c, t.edges(spark, sf), "scaffold", "pos", "contig", "ori", "length", min_len=30, min_support=1).select("scaffold", "total_len", "c1", "o1", "c2", "o2", "support")


@query(f"WITH {t.SPANS}, {t.ISLANDS.format(step=2)} SELECT ref, island::BIGINT AS island, \"start\", \"end\", n FROM islands WHERE \"end\" - \"start\" + 1 >= 20")
def interval_islands(spark, sf):
    return intervals.interval_islands(t.spans(spark, sf), "ref", "s", "e", step=2, min_len=20)


@query(f"WITH {t.SPANS}, {t.ISLANDS.format(step=0)} SELECT ref, sum(\"end\" - \"start\" + 1)::BIGINT AS covered FROM islands GROUP BY 1")
def interval_union_length(spark, sf):
    return intervals.union_length(t.spans(spark, sf), "ref", "s", "e")


@query(f"""WITH {t.SPANS}, ev AS (SELECT ref, s AS pos, 1 AS d FROM spans UNION ALL SELECT ref, e + 1, -1 FROM spans), g AS (SELECT ref, pos, sum(d) AS d FROM ev GROUP BY 1, 2)
SELECT ref, pos, sum(d) OVER (PARTITION BY ref ORDER BY pos)::BIGINT AS depth, lead(pos) OVER (PARTITION BY ref ORDER BY pos) AS until FROM g""")
def depth_profile(spark, sf):
    return intervals.depth_profile(t.spans(spark, sf), "ref", "s", "e")


@query(f"""WITH {t.SPANS}, {t.ISLANDS.format(step=3)}, b AS (SELECT ref, CASE WHEN "start" < 3 THEN 0 ELSE "start" END AS "start", CASE WHEN 2999 - "end" < 3 THEN 2999 ELSE "end" END AS "end" FROM islands)
SELECT ref, "start", "end", row_number() OVER (PARTITION BY ref ORDER BY "start")::INT AS piece FROM b""")
def break_zero_depth(spark, sf):
    s = t.spans(spark, sf)
    return intervals.break_zero_depth(s, s.select("ref").distinct().withColumn("length", F.lit(3000)), "ref", "s", "e", min_zero=3)


@query(f"""WITH {t.SPANS}, u AS (SELECT ref, s, e, id, row_number() OVER (PARTITION BY id ORDER BY ref, s, price) AS rn FROM spans), v AS (SELECT ref, s, e, id * 100 + rn AS id FROM u)
SELECT x.ref, count(*) AS pairs, count(DISTINCT y.id) AS inner_n FROM v x JOIN v y ON x.ref = y.ref AND x.s <= y.s AND y.e <= x.e AND x.id <> y.id WHERE x.s < y.s OR y.e < x.e OR x.id < y.id GROUP BY 1""")
def containment_pairs(spark, sf):
    s = t.spans(spark, sf).withColumn("id", F.col("id") * 100 + F.row_number().over(Window.partitionBy("id").orderBy("ref", "s", "price")))
    return intervals.containment_pairs(s, "ref", "s", "e", "id", 50).groupBy("ref").agg(F.count("*").alias("pairs"), F.count_distinct("inner").alias("inner_n"))


@query(f"""WITH {t.EDGES}, e AS (SELECT c1 * 100000 + c2 AS id, * FROM edges WHERE support >= 2), {t.PARTS},
s AS (SELECT id, c1 AS c, o1 AS o, c2 AS far, dist, std FROM e UNION ALL SELECT id, c2, CASE o2 WHEN '+' THEN '-' ELSE '+' END, c1, dist, std FROM e), l AS (SELECT s.*, p.length AS len FROM s JOIN parts p ON p.id = s.far)
SELECT x.id AS id1, y.id AS id2, x.c AS contig, x.o FROM l x JOIN l y ON x.c = y.c AND x.o = y.o AND x.id < y.id AND x.far <> y.far
WHERE least(x.dist + 6 * x.std + x.len, y.dist - 6 * y.std + y.len) - greatest(x.dist + 6 * x.std, y.dist - 6 * y.std) > 600 AND least(x.dist - 6 * x.std + x.len, y.dist + 6 * y.std + y.len) - greatest(x.dist - 6 * x.std, y.dist + 6 * y.std) > 600""")
def conflicting_pairs(spark, sf):
    e = t.edges(spark, sf, 2).withColumn("id", F.col("c1") * 100_000 + F.col("c2"))
    return ed.conflicting_edges(e, t.parts(spark, sf), k=300)


COORDS = "coords AS (SELECT l_partkey AS contig, l_suppkey AS ref, CAST(datediff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) AS INT) AS s, CAST(datediff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) AS INT) + CAST(l_quantity AS INT) AS e, 40.0 AS pct FROM lineitem)"


@query(f"""WITH {t.EDGES}, {COORDS}, r AS (SELECT contig, ref FROM coords GROUP BY 1, 2 HAVING sum(pct) <= 150), f AS (SELECT c.* FROM coords c JOIN r ON c.contig = r.contig AND c.ref = r.ref)
SELECT DISTINCT c1, c2, dist, std, support, x.ref FROM edges JOIN f x ON c1 = x.contig JOIN f y ON c2 = y.contig AND x.ref = y.ref
WHERE support >= 2 AND (abs(greatest(x.s, y.s) - least(x.e, y.e) - dist) <= 3 * std OR abs(least(x.s, y.s) + 2600 - greatest(x.e, y.e) - dist) <= 3 * std)""")
def band_supported_pairs(spark, sf):
    day = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1992-01-01").cast("date"))
    c = t.table(spark, sf, "lineitem").select(F.col("l_partkey").alias("contig"), F.col("l_suppkey").alias("ref"), day.alias("s"), (day + F.col("l_quantity").cast("int")).alias("e"), F.lit(40.0).alias("pct"))
    return ed.reference_supported(t.edges(spark, sf, 2).select("c1", "c2", "dist", "std", "support"), c, ref_len=2600)


@query("""WITH f AS (SELECT l_partkey, l_quantity, row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_linenumber, l_suppkey, l_extendedprice) AS rn FROM lineitem)
SELECT l_partkey, (p_size * 100)::INT AS length, round(sum(l_quantity) / (p_size * 100), 6) AS coverage FROM f JOIN part ON l_partkey = p_partkey WHERE rn = 1 GROUP BY 1, 2, p_size""")
def first_per_read_coverage(spark, sf):
    a = t.table(spark, sf, "lineitem").join(t.parts(spark, sf).select(F.col("id").alias("l_partkey"), "length"), "l_partkey").withColumn("zero", F.lit(0.0))
    return cv.long_read_coverage(a, "l_orderkey", "l_partkey", ["l_linenumber", "l_suppkey", "l_extendedprice"], "zero", "l_quantity", "length").withColumn("coverage", F.round("coverage", 6))


@query("""WITH a AS (SELECT l_orderkey, l_linenumber, (l_extendedprice % 700)::INT AS cs, (l_extendedprice % 700)::INT + l_quantity::INT * 20 AS ce, 100 * p_size AS cl, l_linenumber * 100 AS rs, l_linenumber * 100 + l_quantity::INT * 20 AS re, 1500 AS rl FROM (SELECT *, floor(l_extendedprice) AS x FROM lineitem) JOIN part ON l_partkey = p_partkey),
b AS (SELECT l_orderkey, l_linenumber, (floor(x) % 700)::INT AS cs, (floor(x) % 700)::INT + q * 20 AS ce, cl, rs, re, rl FROM (SELECT l_orderkey, l_linenumber, l_extendedprice AS x, l_quantity::INT AS q, 100 * p_size AS cl, l_linenumber * 100 AS rs, l_linenumber * 100 + l_quantity::INT * 20 AS re, 1500 AS rl FROM lineitem JOIN part ON l_partkey = p_partkey))
SELECT CASE WHEN ce - cs >= 0.9 * cl OR ce - cs >= cl - 200 THEN 'contig-contained' WHEN re - rs >= 0.9 * rl OR re - rs >= rl - 200 THEN 'read-contained' WHEN rs <= 200 AND cl - ce <= 200 THEN 'contig-at-start' WHEN rl - re <= 200 AND cs <= 200 THEN 'contig-at-end' ELSE 'partial-match' END AS class,
CASE WHEN cl < 500 THEN CASE WHEN cl > 100 AND ce - cs >= 0.8 * cl THEN 'gap-fill' ELSE 'drop' END WHEN re - rs < 400 THEN 'drop' ELSE 'use' END AS gate, count(*) AS n FROM b GROUP BY 1, 2""")
def alignment_classes(spark, sf):
    j = t.table(spark, sf, "lineitem").join(t.parts(spark, sf).select(F.col("id").alias("l_partkey"), F.col("length").alias("cl")), "l_partkey")
    cs, span, rs = (F.floor("l_extendedprice") % 700).cast("int"), F.col("l_quantity").cast("int") * 20, F.col("l_linenumber") * 100
    a = j.select("cl", cs.alias("cs"), (cs + span).alias("ce"), rs.alias("rs"), (rs + span).alias("re"), F.lit(1500).alias("rl"))
    c = F.col
    return a.groupBy(ed.alignment_class(c("cs"), c("ce"), c("cl"), c("rs"), c("re"), c("rl")).alias("class"), ed.alignment_gate(c("cl"), c("cs"), c("ce"), c("rs"), c("re")).alias("gate")).agg(F.count("*").alias("n"))


@query(f"""WITH {t.PARTS}, m AS (SELECT cluster, sum(coverage * length) / sum(length) AS mc FROM parts GROUP BY 1)
SELECT parts.cluster, sum(length)::BIGINT AS total_len, round(max(mc), 6) AS mean_cov, coalesce(sum(length) FILTER (coverage > mc * 1.2 OR coverage < mc / 1.2), 0)::BIGINT AS outlier_len, round(coalesce(sum(length) FILTER (coverage > mc * 1.2 OR coverage < mc / 1.2), 0) / (sum(length) + 1), 6) AS fraction, sum(length) >= 200000 AS counted
FROM parts JOIN m ON parts.cluster = m.cluster GROUP BY 1""")
def outlier_fraction(spark, sf):
    return cv.outlier_fraction(t.parts(spark, sf), "cluster", "length", "coverage", 1.2).withColumns({"mean_cov": F.round("mean_cov", 6), "fraction": F.round("fraction", 6)})


@query("""WITH d AS (SELECT doc_id, translate(upper(regexp_replace(text, '[^a-zA-Z]', '', 'g')), 'EIOPQFJLXZ', 'ACGTNACGTN') AS seq FROM documents)
SELECT doc_id, seq, reverse(translate(seq, 'ACGTUMRWSYKVHDBN', 'TGCAAKYWSRMBDHVN')) AS rc, reverse(translate(regexp_replace(seq, '[^ACGT]', 'N', 'g'), 'ACGT', 'TGCA')) AS rc_upper FROM d""")
def reverse_complement(spark, sf):
    seq = F.translate(F.upper(F.regexp_replace("text", "[^a-zA-Z]", "")), "EIOPQFJLXZ", "ACGTNACGTN")
    d = t.table(spark, sf, "documents").select("doc_id", seq.alias("seq"))
    return d.select("doc_id", "seq", sq.reverse_complement(F.col("seq")).alias("rc"), sq.reverse_complement(F.col("seq"), "upper").alias("rc_upper"))


@query("""WITH p AS (SELECT doc_id, unnest(regexp_split_to_array(text, '[Nn]+')) AS c FROM documents), q AS (SELECT doc_id, count(*) FILTER (c <> '') AS pieces, max(length(c)) AS longest FROM p GROUP BY 1)
SELECT d.doc_id, length(text) - length(translate(text, 'Nn', '')) AS n_bases, length(translate(text, 'Nn', '')) AS bases, pieces, longest FROM documents d JOIN q ON d.doc_id = q.doc_id""")
def n_runs(spark, sf):
    d = t.table(spark, sf, "documents")
    pieces = sq.split_at_n(F.col("text"))
    return d.select("doc_id", sq.count_n(F.col("text")).cast("long").alias("n_bases"), F.length(sq.strip_n(F.col("text"))).cast("long").alias("bases"), F.size(pieces).cast("long").alias("pieces"), F.array_max(F.transform(pieces, F.length)).cast("long").alias("longest"))


@query("""WITH c AS (SELECT p_partkey AS id, (p_size % 7) || 'S' || p_size || 'M' || (p_size % 5 + 1) || 'D' || (p_size % 3 + 1) || 'I10M' AS cigar FROM part)
SELECT id, cigar, list_sum(list_transform(regexp_extract_all(cigar, '(\\d+)[MDN=X]', 1), lambda x: x::INT))::BIGINT AS ref_len FROM c""")
def cigar_length(spark, sf):
    s = F.col("p_size")
    cigar = F.concat((s % 7).cast("string"), F.lit("S"), s.cast("string"), F.lit("M"), (s % 5 + 1).cast("string"), F.lit("D"), (s % 3 + 1).cast("string"), F.lit("I10M"))
    return t.table(spark, sf, "part").select(F.col("p_partkey").alias("id"), cigar.alias("cigar")).withColumn("ref_len", sq.cigar_reference_length(F.col("cigar")).cast("long"))


@query("""WITH s AS (SELECT item_id, lower(text) AS s FROM benchmark), k AS (SELECT substr(s, i::BIGINT, 8) AS kmer FROM s, unnest(range(1, length(s) - 6)) AS u(i)) SELECT kmer, count(*) AS n FROM k GROUP BY 1""")
def kmer_counts(spark, sf):
    k = t.table(spark, sf, "benchmark").select(F.explode(sq.kmers(F.lower("text"), 8)).alias("kmer"))
    return k.groupBy("kmer").agg(F.count("*").alias("n"))


@query("""WITH s AS (SELECT item_id, lower(text) AS s FROM benchmark), k AS (SELECT DISTINCT item_id, md5(substr(s, i::BIGINT, 5)) AS h FROM s, unnest(range(1, length(s) - 3)) AS u(i)),
m AS (SELECT item_id, h FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY h) AS rn FROM k) WHERE rn <= 50),
p AS (SELECT x.item_id AS a, y.item_id AS b, count(*) AS shared FROM m x JOIN m y ON x.h = y.h AND x.item_id < y.item_id GROUP BY 1, 2)
SELECT a, b, shared, round(-1.0 / 5 * ln(2 * (shared / 50.0) / (1 + shared / 50.0)), 6) AS dist FROM p""")
def minhash_distance(spark, sf):
    k = t.table(spark, sf, "benchmark").select("item_id", F.explode(F.array_distinct(sq.kmers(F.lower("text"), 5))).alias("kmer")).select("item_id", F.md5(F.col("kmer").cast("binary")).alias("h"))
    m = stats.top_within(k, ["item_id"], [F.col("h")], 50)
    p = m.select(F.col("item_id").alias("a"), "h").join(m.select(F.col("item_id").alias("b"), "h"), "h").filter("a < b").groupBy("a", "b").agg(F.count("*").alias("shared"))
    j = F.col("shared") / 50.0
    return p.withColumn("dist", F.round(-1.0 / 5 * F.log(2 * j / (1 + j)), 6))


@query("""WITH p AS (SELECT page_id, replace(split_part(url, '?', 1), '/en/', '/en__') || '.fa' AS path FROM pages), b AS (SELECT *, split_part(path, '/', -1) AS base FROM p)
SELECT page_id, split_part(base, '__', 1) AS species, CASE WHEN contains(base, '__') THEN split_part(base, '__', 2) END AS reference, regexp_replace(base, '\\.[^.]*$', '') AS bin FROM b""")
def species_from_path(spark, sf):
    path = F.concat(F.replace(F.substring_index("url", "?", 1), F.lit("/en/"), F.lit("/en__")), F.lit(".fa"))
    p = t.table(spark, sf, "pages").select("page_id", path.alias("path"))
    return p.select("page_id", sq.species_of(F.col("path")).alias("species"), sq.reference_of(F.col("path")).alias("reference"), sq.bin_of(F.col("path")).alias("bin"))


@query("""SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS header FROM conversations""")
def header_forward_fill(spark, sf):
    c = t.table(spark, sf, "conversations").withColumn("header", F.when(F.col("role") == "user", F.col("turn")))
    return intervals.forward_fill(c, ["conv_id"], ["turn", "role", "text"], "header").select("conv_id", "turn", "header")


@query(f"""WITH {WINDOWS}, s AS (SELECT id, win, sum(n)::BIGINT AS n FROM windows GROUP BY 1, 2), m AS (SELECT *, max(n) OVER (PARTITION BY id ORDER BY win ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING) AS top, max(n) OVER (PARTITION BY id ORDER BY win ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS before FROM s)
SELECT id, win, n FROM m WHERE n = top AND (before IS NULL OR before < n) AND win >= 5 AND win < 25""")
def local_modes(spark, sf):
    s = _windows(spark, sf, sample=False)
    return cv.local_modes(s, ["id"], "win", "n")


@query(f"""WITH {t.CHILDREN}, n AS (SELECT *, (price % 7)::INT AS gap0, CAST(floor(price) AS BIGINT) % 7 AS gap FROM children),
s AS (SELECT scaffold, contig, line, length, gap, coalesce(sum(length + gap) OVER (PARTITION BY scaffold ORDER BY line DESC, contig DESC, supp DESC, price DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM n),
z AS (SELECT scaffold, sum(length + gap) AS len FROM s GROUP BY 1), r AS (SELECT scaffold, len::BIGINT AS len, row_number() OVER (ORDER BY len DESC, scaffold)::INT AS number FROM z)
SELECT s.scaffold, s.contig, s.line, s.start, r.number, r.len FROM s JOIN r ON s.scaffold = r.scaffold""")
def scaffold_coordinates(spark, sf):
    from contigloom.operators import scaffold

    c = t.children(spark, sf).withColumn("gap", F.floor("price") % 7)
    s = intervals.scaffold_coordinates(c, "scaffold", t.ORDER, "length", "gap", reverse=True)
    n = scaffold.sorted_scaffolds(c).select("scaffold", "number", F.col("length").alias("len"))
    return s.join(n, "scaffold").select("scaffold", "contig", "line", F.col("start").cast("long").alias("start"), "number", "len")


@query("""WITH n AS (SELECT p_partkey AS id, floor((row_number() OVER (ORDER BY p_partkey) - 1) / 400)::BIGINT + 1 AS directory FROM part), r AS (SELECT p_partkey AS id, coalesce(sum(p_size) OVER (PARTITION BY p_brand ORDER BY p_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS rn FROM part)
SELECT n.id, directory, greatest(floor(before / 500), floor((rn - 1) / 30))::BIGINT AS file FROM n JOIN r ON n.id = r.id""")
def dense_directories(spark, sf):
    p = t.table(spark, sf, "part").select(F.col("p_partkey").alias("id"), "p_brand", "p_size")
    d = tables.directories(p.select("id"), ["id"], 400)
    f = tables.size_bounded_files(p, ["p_brand"], ["id"], "p_size", 500, 30)
    return d.join(f.select("id", "file"), "id")


@query("""SELECT o_orderkey, o_orderstatus FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R') AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 45)""")
def anti_semi_contigs(spark, sf):
    o, li = t.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), t.table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return o.join(li.filter("l_returnflag = 'R'").select("o_orderkey"), "o_orderkey", "left_semi").join(li.filter("l_quantity > 45").select("o_orderkey"), "o_orderkey", "left_anti")


@query(f"""WITH {t.CHILDREN}, {t.PARTS}, j AS (SELECT c.scaffold, p.length AS size, p.length * p.coverage AS sm, p.length * c.length AS lm, b.k AS cluster FROM children c JOIN parts p ON c.contig = p.id LEFT JOIN (SELECT p_partkey, p_size AS k FROM part WHERE p_size <= 40) b ON b.p_partkey = c.contig),
g AS (SELECT scaffold, sum(size)::BIGINT AS length, round(sum(sm) / sum(size), 6) AS short_read_cov, round(sum(lm) / sum(size), 6) AS long_read_cov, min(cluster) AS cluster FROM j GROUP BY 1)
SELECT scaffold, length, short_read_cov, long_read_cov, cluster, n_name AS species, 'ref' || n_regionkey AS reference FROM g LEFT JOIN nation ON n_nationkey = cluster""")
def final_contig_table(spark, sf):
    c = t.children(spark, sf)
    p = t.parts(spark, sf).select(F.col("id").alias("contig"), F.col("length").alias("size"), "coverage")
    mass = c.join(p, "contig").select("scaffold", "contig", "size", (F.col("size") * F.col("coverage")).alias("short_mass"), (F.col("size") * F.col("length")).alias("long_mass"))
    clusters = t.table(spark, sf, "part").filter("p_size <= 40").select(F.col("p_partkey").alias("contig"), F.col("p_size").alias("cluster"))
    species = t.table(spark, sf, "nation").select(F.col("n_nationkey").alias("cluster"), F.col("n_name").alias("species"), F.concat(F.lit("ref"), F.col("n_regionkey").cast("string")).alias("reference"))
    j = mass.join(clusters, "contig", "left")
    g = j.groupBy("scaffold").agg(F.sum("size").cast("long").alias("length"), F.round(F.sum("short_mass") / F.sum("size"), 6).alias("short_read_cov"), F.round(F.sum("long_mass") / F.sum("size"), 6).alias("long_read_cov"), F.min("cluster").alias("cluster"))
    return g.join(species, "cluster", "left").select("scaffold", "length", "short_read_cov", "long_read_cov", "cluster", "species", "reference")


@query(f"""WITH c AS (SELECT d.source AS cluster, n_chars AS length, CASE WHEN toxic IS NULL THEN NULL ELSE n_chars % 50 END AS sc, quality AS lc FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE n_chars >= 500),
{_nx('c', 'length', 'cluster')}, v AS (SELECT cluster, round(sum(coalesce(sc, 0) * length) / sum(length), 2) AS short_read_cov, round(sum(coalesce(lc, 0) * length) / sum(length), 2) AS long_read_cov FROM c GROUP BY 1),
b AS (SELECT source AS cluster, lang AS species, row_number() OVER (PARTITION BY source ORDER BY count(*) DESC, lang) AS rn, count(*) AS k FROM documents GROUP BY 1, 2)
SELECT nx.*, short_read_cov, long_read_cov, species, round(1 - 1.0 / k, 6) AS similarity FROM nx JOIN v ON nx.cluster = v.cluster LEFT JOIN b ON b.cluster = nx.cluster AND rn = 1""")
def final_cluster_table(spark, sf):
    d, labels = t.table(spark, sf, "documents"), t.table(spark, sf, "labels").select("doc_id", "quality", "toxic")
    c = d.select("doc_id", F.col("source").alias("cluster"), F.col("n_chars").alias("length")).join(labels, "doc_id", "left")
    c = c.withColumns({"sc": F.when(F.col("toxic").isNotNull(), F.col("length") % 50), "lc": F.col("quality")})
    langs = d.groupBy(F.col("source").alias("cluster"), F.col("lang").alias("species")).agg(F.count("*").alias("k"))
    best = stats.top_within(langs, ["cluster"], [F.col("k").desc(), F.col("species")], 1).select("cluster", "species", (1.0 / F.col("k")).alias("dist"))
    return tables.cluster_table(c, "cluster", "length", "sc", "lc", best)


@query("""SELECT p_brand AS cluster, p_type AS ref, count(*) AS votes, row_number() OVER (PARTITION BY p_brand ORDER BY count(*) DESC, p_type) = 1 AS first FROM part GROUP BY 1, 2""")
def reference_votes(spark, sf):
    return tables.votes(t.table(spark, sf, "part").select(F.col("p_brand").alias("cluster"), F.col("p_type").alias("ref")), ["cluster"], "ref")


@query("""WITH c AS (SELECT o_orderpriority AS g, o_orderstatus AS v, count(*) AS n FROM orders GROUP BY 1, 2) SELECT g, v, n FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY n DESC, v) AS rn FROM c) WHERE rn = 1""")
def majority_orientation(spark, sf):
    return stats.majority(t.table(spark, sf, "orders").select(F.col("o_orderpriority").alias("g"), F.col("o_orderstatus").alias("v")), ["g"], "v")


@query(f"""WITH {t.PARTS}, {t.EDGES}, k AS (SELECT id, cluster FROM parts) SELECT c1, c2, support, a.cluster FROM edges JOIN k a ON c1 = a.id JOIN k b ON c2 = b.id WHERE a.cluster = b.cluster""")
def intra_cluster_edges(spark, sf):
    p = t.parts(spark, sf)
    return ed.intra_cluster_edges(t.edges(spark, sf), p.select("id", "cluster"), "id").select("c1", "c2", "support", "cluster")


@query(f"""WITH {t.PARTS}, {t.EDGES}, m AS (SELECT cluster, median(coverage) AS median FROM parts GROUP BY 1), f AS (SELECT id FROM parts JOIN m ON parts.cluster = m.cluster WHERE NOT coverage > 1.005 * median)
SELECT c1, c2, support, CASE WHEN dist > -200 AND dist < 300 THEN 0 END AS stratum FROM edges WHERE support >= 2 AND c1 IN (SELECT id FROM f) AND c2 IN (SELECT id FROM f)""")
def species_edges(spark, sf):
    p = t.parts(spark, sf)
    e = ed.filter_cluster_repeats(t.edges(spark, sf), p.select("id", "coverage"), p.select("id", "cluster"), "id", factor=1.005)
    return ed.extract_species_edges(e, p.select("id", "coverage"), "id", hi=1e9).select("c1", "c2", "support", "stratum")


@query("SELECT user_id AS id, date_trunc('day', ts) AS start, count(*) AS n FROM events GROUP BY 1, 2")
def tumbling_counts(spark, sf):
    from contigloom.streaming.coverage import windowed_counts

    e = t.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp_ltz"))
    return windowed_counts(e.withColumnRenamed("user_id", "id"), "id", "ts", "1 day").withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("""SELECT o_orderpriority AS lib, printf('%.2f', count(*) / 1e6) AS m_reads, printf('%.2f', sum(o_totalprice) / 1e9) AS gbp, printf('%.2f', avg(o_totalprice) / 1e3) AS kbp FROM orders GROUP BY 1""")
def read_library_totals(spark, sf):
    return stats.read_library_totals(t.table(spark, sf, "orders").withColumnRenamed("o_orderpriority", "lib"), ["lib"], "o_totalprice")


@query("""SELECT p_partkey AS id, p_name, levenshtein(p_brand, p_type)::INT AS edits FROM part""")
def edit_distance(spark, sf):
    return t.table(spark, sf, "part").select(F.col("p_partkey").alias("id"), "p_name", F.levenshtein("p_brand", "p_type").alias("edits"))


@query("""WITH l AS (SELECT DISTINCT 'd__root;p__' || r_name || ';s__' || n_name AS lineage FROM nation JOIN region ON n_regionkey = r_regionkey),
p AS (SELECT DISTINCT array_to_string((string_split(lineage, ';'))[1:d], ';') AS path, (string_split(lineage, ';'))[d] AS name, d AS depth FROM l, unnest([1, 2, 3]) AS u(d)),
i AS (SELECT *, row_number() OVER (ORDER BY depth, path) + 1 AS id FROM p)
SELECT i.id::INT AS id, coalesce(u.id, 1)::INT AS parent, i.name, i.depth::INT AS depth FROM i LEFT JOIN i u ON u.path = array_to_string((string_split(i.path, ';'))[1:i.depth - 1], ';') AND u.depth = i.depth - 1""")
def taxonomy_nodes(spark, sf):
    n = t.table(spark, sf, "nation").join(t.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return tables.lineage_nodes(n.select(F.concat(F.lit("d__root;p__"), "r_name", F.lit(";s__"), "n_name").alias("lineage")))
