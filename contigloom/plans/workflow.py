"""The assembly workflow and its utilities as functions over tables; see also ``python -m contigloom``."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contigloom.functions.sequence import bin_of, reverse_complement, species_of
from contigloom.operators import coverage as cv
from contigloom.operators import bundles, gaps, intervals, scaffold, stats, strain, tables, trees
from contigloom.operators import edges as ed
from contigloom.sources import readers
from contigloom.sources.writers import Stages, stats_lines, write_fasta, write_table


@dataclass
class Options:
    """Options that shape results, with their defaults."""

    kmer: int = 60
    edge: int = 80
    window: int = 340
    min_contig: int = 500
    min_support: int = 2
    max_cluster: int = 6_000_000
    dispersion: float | None = None
    scaffold_support: int = 5
    n_sd: int = 6
    budget: int = 100_000
    read_size: int = 100
    edge_ratio: float = 1.5
    sketch_k: int = 21
    sketch_size: int = 1000
    reference_cutoff: float = 0.05
    strain_length: int = 1_000_000


def cluster_contigs(contigs: DataFrame, hits: DataFrame, edges: DataFrame, o: Options | None = None) -> DataFrame:
    """contig, component and cluster by coverage: windowed counts, valid edges weighted by rate differences, merge trees cut by model score.

    contigs: id, length; hits: id, pos, sample; edges: c1, o1, c2, o2, dist, std, support. The dispersion is estimated where none is given.
    """
    o = o or Options()
    c = cv.window_geometry(contigs.filter(F.col("length") >= o.min_contig), win=o.window, edge=o.edge)
    w = cv.window_counts(hits, c, o.window, sample="sample")
    good = ed.validate_edges(edges, c, k=o.kmer, min_support=o.min_support).filter("skip_code = 0").select("c1", "c2").distinct()
    rates = cv.contig_moments(w, ["id", "sample"]).join(c.select("id", "modified_length", "length"), "id")
    weights = ed.relative_rate_distance(good, rates.withColumn("rate", F.col("sum_count") / F.col("modified_length")))
    if (r := o.dispersion) is None:
        fitted = cv.trimmed_dispersion(cv.moment_dispersion(rates).withColumn("all", F.lit(1)), ["all"], "id").first()
        r = fitted["r"] if fitted else 50.0
    size = contigs.agg(F.sum("length")).first()[0] or 0
    arrays = w.groupBy("id", "sample").agg(F.array_sort(F.collect_list(F.struct("win", "n"))).alias("w"))  # windows of one contig
    arrays = arrays.join(c.select("id", "modified_length"), "id").select(F.col("id").alias("contig"), "sample", F.transform("w", lambda x: x["n"]).alias("counts"), F.col("modified_length").alias("length"))
    return trees.cut_tree(weights, arrays, o.window, r, max(size / o.window, 1.0))


def scaffold_contigs(contigs: DataFrame, edges: DataFrame, clusters: DataFrame, o: Options | None = None) -> DataFrame:
    """Ordered scaffolds within clusters: subgraph, scaffold, pos, contig, ori, length, gap."""
    o = o or Options()
    inner = ed.intra_cluster_edges(edges, clusters).filter(F.col("support") >= o.scaffold_support).drop("cluster")
    graph = trees.border_subgraphs(inner, contigs)
    return scaffold.order_scaffolds(graph, contigs, k=o.kmer, n_sd=o.n_sd, budget=o.budget)


def read_pairs(alignments: DataFrame, min_contig: int = 500) -> DataFrame:
    """Pairs of alignments on one long read, the first before the second: rn, c1, o1, c2, o2, dist and, for gap filling, the alignments as structs a1, a2.

    Alignments that are too short or match neither a contig's end nor a whole contig or read are left out, as are those that lose against a better one at the same place.
    """
    c = [F.col(x) for x in ("cs", "ce", "cl", "rs", "re", "rl")]
    fine = alignments.filter((ed.alignment_gate(F.col("cl"), F.col("cs"), F.col("ce"), F.col("rs"), F.col("re"), min_contig) == "use") & (ed.alignment_class(*c) != "partial-match"))
    kept = intervals.overlap_resolution(fine, "rn", "rs", "re", "score", ["rs", "re", "cn"]).filter("kept")
    kept = kept.select("rn", F.row_number().over(Window.partitionBy("rn").orderBy("rs", "re", "cn")).alias("i"), F.col("cn").alias("c"), F.when(F.col("ro") == F.col("co"), "+").otherwise("-").alias("o"), F.struct("cs", "ce", "cl", "rs", "re").alias("a"))
    one, two = (kept.select("rn", *(F.col(x).alias(f"{x}{k}") for x in "icoa")) for k in (1, 2))
    pairs = one.join(two, "rn").filter("i1 < i2 and c1 <> c2")
    dist = ed.gap_distance(F.col("a1.re"), F.col("a2.rs"), F.col("a2.cs"), F.col("a1.cl"), F.col("a1.ce"))
    return pairs.select("rn", "c1", "o1", "c2", "o2", dist.alias("dist"), "a1", "a2")


def long_read_edges(pairs: DataFrame) -> DataFrame:
    """Edge rows of read_pairs(): the best bundle of distances and orientations of each contig pair."""
    e = ed.canonical_edges(pairs.select("c1", "o1", "c2", "o2", "dist")).withColumn("ori", F.concat_ws(":", "o1", "o2"))
    best = bundles.bundle_long(e)
    return best.select("c1", F.substring_index("ori", ":", 1).alias("o1"), "c2", F.substring_index("ori", ":", -1).alias("o2"), F.col("dist").cast("int").alias("dist"), F.col("std").cast("int").alias("std"), F.col("support").cast("int").alias("support"))


def joined_edges(short: DataFrame, long: DataFrame | None, cov: DataFrame, o: Options) -> DataFrame:
    """Edges of all libraries, the better supported of equal ends, without those of outlying support for their contigs' coverage. cov: id, coverage."""
    both = ed.canonical_edges(short if long is None else short.unionByName(long))
    one = F.row_number().over(Window.partitionBy("c1", "o1", "c2", "o2").orderBy(F.col("support").desc(), "std", "dist"))
    both = both.withColumn("_n", one).filter("_n = 1").drop("_n").withColumn("lib", F.coalesce(ed.distance_bucket(F.col("dist")), F.lit(-1)))
    return ed.filter_edge_ratio(both, cov, n_sd=o.edge_ratio).filter("keep").drop("keep", "ratio", "lib")


def without_conflicts(edges: DataFrame, contigs: DataFrame, o: Options) -> DataFrame:
    """Edges without the less supported of every two that send one contig end to overlapping places."""
    e = edges.withColumn("id", F.concat_ws("|", "c1", "o1", "c2", "o2"))
    pairs = ed.conflicting_edges(e, contigs, k=o.kmer, n_sd=o.n_sd)
    a, b = (e.select(F.col("id").alias(f"id{i}"), F.col("support").alias(f"n{i}")) for i in (1, 2))
    worse = pairs.join(a, "id1").join(b, "id2").select(F.when(F.col("n1") < F.col("n2"), F.col("id1")).otherwise(F.col("id2")).alias("id")).distinct()
    return e.join(worse, "id", "left_anti").drop("id")


def reference_clusters(contigs: DataFrame, clusters: DataFrame, edges: DataFrame, genomes: DataFrame, cov: DataFrame, o: Options) -> tuple[DataFrame, DataFrame]:
    """(contig, cluster after merging, references of clusters): clusters that an edge joins are merged greedily, those of like coverage first, as long as they share a near reference.

    genomes: ref, seq; the distances are estimated from sketches. References of a merged cluster: cluster, ref, dist, species of its nearest.
    """
    own = contigs.join(clusters.select(F.col("contig").alias("id"), "cluster"), "id")
    queries = gaps.sketches(own, o.sketch_k, o.sketch_size, "cluster")
    refs = gaps.sketches(genomes, o.sketch_k, o.sketch_size, "ref")
    near = gaps.sketch_distances(queries.withColumnRenamed("cluster", "id"), refs.withColumnRenamed("ref", "id"), o.sketch_k, o.sketch_size).filter(F.col("dist") <= o.reference_cutoff)
    top = tables.top_references(near)
    lists = top.groupBy(F.col("query").alias("cluster")).agg(F.sort_array(F.collect_list("ref")).alias("refs"))
    mean = own.join(cov, "id").groupBy("cluster").agg((F.sum(F.col("coverage") * F.col("length")) / F.sum("length")).alias("cov"))
    a, b = (clusters.select(F.col("contig").alias(f"c{i}"), F.col("cluster").alias(f"k{i}")) for i in (1, 2))
    m1, m2 = (mean.select(F.col("cluster").alias(f"k{i}"), F.col("cov").alias(f"v{i}")) for i in (1, 2))
    e = edges.join(a, "c1").join(b, "c2").filter("k1 <> k2").join(m1, "k1").join(m2, "k2")
    e = e.groupBy(F.least("k1", "k2").alias("c1"), F.greatest("k1", "k2").alias("c2")).agg(F.min(F.abs(F.col("v1") - F.col("v2"))).alias("weight"))
    supers = trees.super_clusters(e, lists)
    merged = trees.relabel(clusters.select("contig", "cluster"), supers)
    names = merged.select("cluster", "super_cluster").distinct()
    best = near.join(names.withColumnRenamed("cluster", "query"), "query").groupBy(F.col("super_cluster").alias("cluster")).agg(F.min_by(F.struct("ref", "dist"), F.struct("dist", "ref")).alias("x"))
    best = best.select("cluster", "x.ref", "x.dist", species_of(F.col("x.ref")).alias("species"))
    return merged.select("contig", F.col("super_cluster").alias("cluster")), best


def strain_clusters(clusters: DataFrame, best: DataFrame, contigs: DataFrame, windows: DataFrame, o: Options) -> DataFrame:
    """contig, cluster, strain: clusters of species with contigs enough are parted into strains by the modes of their coverage; what no strain takes stays in a pool of its own (strain 0).

    windows: contig, length, counts.
    """
    rows = clusters.join(contigs.select(F.col("id").alias("contig"), "length"), "contig")
    found = strain.strain_candidates(rows, best, min_len=o.strain_length, min_len_no_ref=2 * o.strain_length + o.strain_length // 2)
    named = rows.join(best.select("cluster", "species"), "cluster", "left").withColumn("species", F.coalesce("species", F.concat(F.lit("cluster_"), F.col("cluster").cast("string"))))
    todo = named.join(found.select("species"), "species", "left_semi")
    peeled = strain.peel_strains(todo.join(windows.select("contig", "counts"), "contig"), o.window, o.dispersion or 50.0)
    return named.join(peeled.select("contig", "strain"), "contig", "left").select("contig", "cluster", F.coalesce("strain", F.lit(1)).alias("strain"))


def gap_fillings(scaffolds: DataFrame, pairs: DataFrame, reads: DataFrame) -> DataFrame:
    """scaffold, pos, filling: what one long read has between a child and the next one, in the scaffold's direction; empty where they overlap.

    pairs: read_pairs(); reads: name, seq.
    """
    place = lambda a: (F.struct(F.lit(0).alias("o"), F.col(f"{a}.cs").alias("s"), F.col(f"{a}.ce").alias("e")), F.struct(F.lit(0).alias("o"), F.col(f"{a}.rs").alias("s"), F.col(f"{a}.re").alias("e")))
    (k1, r1), (k2, r2) = place("a1"), place("a2")
    swap = F.col("c1") > F.col("c2")
    rows = pairs.select(F.col("rn").alias("read"), F.struct("c1", "o1", "c2", "o2").alias("own"), swap.alias("swap"), F.col("a1.cl").alias("len1"), F.col("a2.cl").alias("len2"), k1.alias("c1"), k2.alias("c2"), r1.alias("r1"), r2.alias("r2"))
    g = gaps.gap_coordinates(rows)
    ends = ed.canonical_edges(g.select("*", *(F.col(f"own.{x}").alias(f"e_{x}") for x in ("c1", "o1", "c2", "o2"))).drop("c1", "c2").withColumnsRenamed({f"e_{x}": x for x in ("c1", "o1", "c2", "o2")}))
    one = gaps.first_read_per_edge(ends.select(F.concat_ws("|", "c1", "o1", "c2", "o2").alias("edge"), "read", "start", "end", F.col("swap").alias("reverse")))
    found = gaps.gap_sequences(one, reads).select("edge", F.col("seq").alias("filling"))
    w = Window.partitionBy("scaffold").orderBy("pos")
    nxt = scaffolds.select("scaffold", "pos", F.col("contig").alias("c1"), F.col("ori").alias("o1"), F.lead("contig").over(w).alias("c2"), F.lead("ori").over(w).alias("o2")).filter("c2 is not null").withColumn("turned", swap)
    keyed = ed.canonical_edges(nxt).withColumn("edge", F.concat_ws("|", "c1", "o1", "c2", "o2")).join(found, "edge")
    return keyed.select("scaffold", "pos", F.when(F.col("turned"), reverse_complement(F.col("filling"))).otherwise(F.col("filling")).alias("filling"))


def info_tables(scaffolds: DataFrame, contigs: DataFrame, moments: DataFrame, long_cov: DataFrame | None, clusters: DataFrame, best: DataFrame | None, o: Options) -> tuple[DataFrame, DataFrame]:
    """(contig table, cluster table) of an assembly. moments: id, sum_count; long_cov: cn, coverage; clusters: contig, cluster, strain."""
    mass = contigs.select(F.col("id").alias("contig"), F.col("length").alias("size")).join(moments.groupBy(F.col("id").alias("contig")).agg((F.sum("sum_count") * o.read_size).cast("double").alias("short_mass")), "contig", "left")
    if long_cov is not None:
        mass = mass.join(long_cov.select(F.col("cn").alias("contig"), F.col("coverage").alias("_long")), "contig", "left")
    else:
        mass = mass.withColumn("_long", F.lit(0.0))
    mass = mass.select("contig", "size", F.coalesce("short_mass", F.lit(0.0)).alias("short_mass"), (F.coalesce("_long", F.lit(0.0)) * F.col("size")).alias("long_mass"))
    kind = dict(clusters.dtypes)["cluster"]
    if best is None:
        best = clusters.sparkSession.createDataFrame([], f"cluster {kind}, ref string, dist double, species string")
    species = best.select("cluster", "species", F.col("ref").alias("reference"))
    table = tables.contig_table(scaffolds.select("scaffold", "contig"), mass, clusters.select("contig", "cluster"), species)
    strains = scaffolds.join(clusters, "contig").groupBy("scaffold").agg(F.count_distinct(F.when(F.col("strain") > 0, F.col("strain"))).alias("strains"))
    rows = mass.join(clusters.select("contig", "cluster"), "contig").select("cluster", F.col("size").alias("length"), (F.col("short_mass") / F.col("size")).alias("short"), (F.col("long_mass") / F.col("size")).alias("long"))
    return table.join(strains, "scaffold", "left"), tables.cluster_table(rows, "cluster", "length", "short", "long", best, o.min_contig)


def assemble(spark: SparkSession, contig_file: str, sam_file: str, edge_file: str, out_dir: str, o: Options | None = None, long_alignments: str | None = None, long_kind: str = "paf", long_reads: str | None = None, genomes: str | None = None) -> dict[str, DataFrame]:
    """Clusters, scaffolds, sequences and tables of an assembly, as resumable stages below out_dir.

    From a contig FASTA, a SAM file and an edge file; with alignments of long reads also their edges and coverage; with the reads themselves (FASTA or FASTQ)
    what they have in the gaps; with reference genomes (FASTA files, named species__reference) clusters merged by shared references, and strains.
    The sequences and tables are written as files too: contigs.fasta, contig_info, cluster_info, assembly.stats.
    """
    o = o or Options()
    run = Stages(spark, out_dir)
    contigs = run.run("contigs", lambda: readers.read_fasta(spark, contig_file, o.min_contig).select("id", "length", "seq"))
    sizes = contigs.select("id", "length")
    hits = run.run("hits", lambda: readers.sam_hits(readers.read_sam(spark, sam_file)).withColumn("sample", F.lit(0)).select("id", "pos", "sample"))
    shape = cv.window_geometry(sizes, win=o.window, edge=o.edge)
    windows = run.run("windows", lambda: cv.window_counts(hits, shape, o.window, sample="sample"))
    moments = run.run("moments", lambda: cv.contig_moments(windows, ["id"]).join(sizes, "id").withColumn("coverage", F.col("sum_count") * float(o.read_size) / F.col("length")))
    long = pairs = long_cov = None
    if long_alignments:
        aln = run.run("long_alignments", lambda: readers.read_long_alignments(spark, long_alignments, long_kind))
        pairs = run.run("read_pairs", lambda: read_pairs(aln, o.min_contig))
        long = run.run("long_edges", lambda: long_read_edges(pairs))
        long_cov = run.run("long_coverage", lambda: cv.long_read_coverage(aln, "rn", "cn", ["rs", "re", "cs"], "rs", "re", "cl"))
    edges = run.run("edges", lambda: without_conflicts(joined_edges(readers.read_edges(spark, edge_file), long, moments.select("id", "coverage"), o), sizes, o))
    clusters = run.run("clusters", lambda: cluster_contigs(sizes, hits, edges, o))
    best, members = None, clusters.select("contig", "cluster").withColumn("strain", F.lit(1))
    if genomes:
        refs = readers.read_fasta(spark, genomes).select(bin_of(F.col("file")).alias("ref"), "seq")
        merged = run.run("merged_clusters", lambda: reference_clusters(contigs, clusters, edges, refs, moments.select("id", "coverage"), o)[0])
        best = run.run("references", lambda: reference_clusters(contigs, clusters, edges, refs, moments.select("id", "coverage"), o)[1])
        arrays = windows.groupBy(F.col("id").alias("contig")).agg(F.transform(F.array_sort(F.collect_list(F.struct("win", "n"))), lambda x: x["n"]).alias("counts"))
        members = run.run("strains", lambda: strain_clusters(merged, best, sizes, arrays, o))
    groups = members.withColumn("cluster", F.concat_ws(".", F.col("cluster").cast("string"), F.col("strain").cast("string"))).select("contig", "cluster")
    scaffolds = run.run("scaffolds", lambda: scaffold_contigs(sizes, edges, groups, o))
    filling = None
    if pairs is not None and long_reads:
        read = readers.read_fastq if readers.sniff_reads(spark, long_reads) == "fastq" else readers.read_fasta
        named = read(spark, long_reads)
        named = named.select(F.col("name" if "name" in named.columns else "id").alias("name"), "seq")
        filling = run.run("fillings", lambda: gap_fillings(scaffolds, pairs, named))
    sequences = run.run("sequences", lambda: scaffold.scaffold_sequences(scaffolds, contigs, fillings=filling))
    summary = run.run("summary", lambda: stats.assembly_stats(scaffold.sorted_scaffolds(scaffolds)))
    contig_info, cluster_info = info_tables(scaffolds, contigs, moments, long_cov, members, best, o)
    contig_info, cluster_info = run.run("contig_info", lambda: contig_info), run.run("cluster_info", lambda: cluster_info)
    if run.stale:
        write_fasta(sequences, f"{run.folder}/contigs.fasta", id="scaffold")
        write_table(contig_info, f"{run.folder}/contig_info.tsv")
        write_table(cluster_info, f"{run.folder}/cluster_info.tsv")
        stats_lines(summary).write.mode("overwrite").text(f"{run.folder}/assembly.stats")
    return {"contigs": contigs, "edges": edges, "clusters": clusters, "members": members, "scaffolds": scaffolds, "sequences": sequences, "summary": summary, "contig_info": contig_info, "cluster_info": cluster_info, "timings": run.timings()}


def evaluate_bins(spark: SparkSession, table: str) -> DataFrame:
    """Quality tiers of a bin evaluation table."""
    return tables.quality_tier(readers.read_bin_evaluation(spark, table))


def read_concordance(spark: SparkSession, short_report: str, long_report: str, rank: str = "S", min_pct: float = 0.1) -> tuple[DataFrame, DataFrame]:
    """(abundances in both profiles, their correlation)."""
    a, b = (tables.abundance(readers.read_kraken_report(spark, p), rank, min_pct) for p in (short_report, long_report))
    both = tables.concordance(a, b, min_pct=min_pct)
    return both, tables.correlation(both)


def novel_species(distances: DataFrame, mags: DataFrame, between: DataFrame, cutoff: float = 0.05, cluster_threshold: float = 0.05) -> DataFrame:
    """mags without a near reference, with their clusters among one another: mag, dist, component.

    distances: query, ref, dist; mags: query; between: a, b, dist of the mags themselves.
    """
    novel = tables.best_hit(distances, mags, cutoff=cutoff).filter(~F.col("near"))
    groups = trees.single_linkage_cut(between, cluster_threshold)
    return novel.join(groups.withColumnRenamed("vertex", "query"), "query", "left").select(F.col("query").alias("mag"), "dist", F.coalesce("component", "query").alias("component"))


def circular_sequences(scaffolds: DataFrame, edges: DataFrame) -> DataFrame:
    return ed.circular(scaffolds, edges, "scaffold", "pos", "contig", "ori", "length")


def build_catalog(spark: SparkSession, genomes: str, taxonomy: str | None = None) -> DataFrame:
    """Genome catalog (path, n_seq, length, directory) and, with a taxonomy, each genome's species."""
    from contigloom.functions.sequence import bin_of

    cat = tables.directories(readers.genome_catalog(spark, genomes), ["path"])
    if taxonomy is None:
        return cat
    names = readers.read_taxonomy(spark, taxonomy, prefix=0).select(F.col("genome").alias("_genome"), "species")
    return cat.join(names, bin_of(F.col("path")) == F.col("_genome"), "left").drop("_genome")
