"""Annotations and final tables: best hits, shared references, tiers, novelty, concordance, contig and cluster tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contigloom.operators.grouped import map_groups, numbered
from contigloom.operators.stats import nx_lx, top_within, unseen


def top_references(dist: DataFrame, query: str = "query", ref: str = "ref", d: str = "dist", k: int = 5, ignore: DataFrame | None = None) -> DataFrame:
    """The k nearest references of each query with their rank; ties go by reference. Species in ignore (species) are left out."""
    if ignore is not None:
        dist = dist.join(ignore, "species", "left_anti")
    return top_within(dist, [query], [F.col(d), F.col(ref)], k)


def best_hit(dist: DataFrame, queries: DataFrame, query: str = "query", ref: str = "ref", d: str = "dist", cutoff: float = 0.05, unknown: str = "UNKNOWN") -> DataFrame:
    """query, ref, dist and near (below the cutoff) for every query: its nearest reference, or unknown at distance 1 without a hit."""
    best = dist.groupBy(query).agg(F.min_by(F.struct(F.col(ref), F.col(d)), F.struct(F.col(d), F.col(ref))).alias("h"))
    out = queries.select(query).distinct().join(best, query, "left")
    ref_out, dist_out = F.coalesce("h." + ref, F.lit(unknown)), F.coalesce("h." + d, F.lit(1.0))
    return out.select(query, ref_out.alias("ref"), dist_out.alias("dist"), (dist_out < cutoff).alias("near"))


def first_hit(dist: DataFrame, query: str, ref: str, d: str, skip: str | None = None) -> DataFrame:
    """The nearest reference of each query, those whose path contains skip left out."""
    rows = dist.filter(~F.contains(F.col(ref), F.lit(skip))) if skip else dist
    return top_within(rows, [query], [F.col(d), F.col(ref)], 1).drop("rank")


def shared_reference_pairs(refs: DataFrame, cluster: str = "cluster", ref: str = "ref") -> DataFrame:
    """a, b, shared: pairs of clusters and their number of common references.

    A join on the reference; a reference of very many clusters makes many pairs, so its clusters should be selected first.
    """
    r = refs.select(cluster, ref).distinct()
    x, y = r.select(F.col(cluster).alias("a"), ref), r.select(F.col(cluster).alias("b"), ref)
    return x.join(y, ref).filter("a < b").groupBy("a", "b").agg(F.count("*").alias("shared"))


def common_references(sets: DataFrame, a: str, b: str) -> DataFrame:
    """sets with the references that two array columns share, and whether there are any."""
    return sets.withColumns({"common": F.array_sort(F.array_intersect(a, b)), "any_common": F.arrays_overlap(a, b)})


def votes(rows: DataFrame, by: list[str], ref: str) -> DataFrame:
    """Number of votes for each reference of each group, and whether it is the first (most votes, then name)."""
    counts = rows.groupBy(*by, ref).agg(F.count("*").alias("votes"))
    return counts.withColumn("first", F.row_number().over(Window.partitionBy(*by).orderBy(F.col("votes").desc(), ref)) == 1)


def merge_votes(a: DataFrame, b: DataFrame, by: list[str], n: str = "votes") -> DataFrame:
    """Votes of two tables added up."""
    return a.unionByName(b).groupBy(*by).agg(F.sum(n).alias(n))


def quality_tier(bins: DataFrame, completeness: str = "completeness", contamination: str = "contamination", high: tuple = (90, 5), medium: tuple = (50, 10)) -> DataFrame:
    """bins with tier HIGH, MEDIUM or LOW."""
    c, x = F.col(completeness), F.col(contamination)
    return bins.withColumn("tier", F.when((c >= high[0]) & (x <= high[1]), "HIGH").when((c >= medium[0]) & (x <= medium[1]), "MEDIUM").otherwise("LOW"))


def novelty(mags: DataFrame, hits_tax: DataFrame, hits_novel: DataFrame, clusters: DataFrame | None = None, mag: str = "mag", cutoff: float = 0.05) -> DataFrame:
    """mags with their nearest distances in both databases and status: KNOWN (near in the taxonomy), SEEN (near among novel genomes), NOVEL, or NO_REF without any hit.

    hits: mag, ref, dist (the best of each mag); clusters: mag, cluster.
    """
    t, n = (h.groupBy(mag).agg(F.min("dist").alias(name)) for h, name in ((hits_tax, "tax_dist"), (hits_novel, "novel_dist")))
    out = mags.join(t, mag, "left").join(n, mag, "left")
    status = F.when(F.col("tax_dist").isNull() & F.col("novel_dist").isNull(), "NO_REF").when(F.col("tax_dist") <= cutoff, "KNOWN").when(F.col("novel_dist") <= cutoff, "SEEN").otherwise("NOVEL")
    out = out.withColumn("status", status)
    return out.join(clusters, mag, "left") if clusters is not None else out


def concordance(a: DataFrame, b: DataFrame, key: str = "name", pct: str = "pct", min_pct: float = 0.1) -> DataFrame:
    """name, a_pct, b_pct: abundances above min_pct in either profile, 0 where a profile lacks the name."""
    x = a.filter(F.col(pct) > min_pct).select(key, F.col(pct).alias("a_pct"))
    y = b.filter(F.col(pct) > min_pct).select(key, F.col(pct).alias("b_pct"))
    return x.join(y, key, "full_outer").select(key, F.coalesce("a_pct", F.lit(0.0)).alias("a_pct"), F.coalesce("b_pct", F.lit(0.0)).alias("b_pct"))


def correlation(pairs: DataFrame, x: str = "a_pct", y: str = "b_pct") -> DataFrame:
    """Pearson correlation and number of rows, in one row."""
    return pairs.agg(F.corr(x, y).alias("r"), F.count("*").alias("n"))


def abundance(report: DataFrame, rank: str = "S", min_pct: float = 0.1) -> DataFrame:
    """Rows of a report at one rank above a share, names trimmed and without spaces."""
    return report.filter((F.col("rank") == rank) & (F.col("pct") > min_pct)).select(F.regexp_replace(F.trim("name"), " ", "_").alias("name"), "pct")


def complete_matrix(dist: DataFrame, a: str = "a", b: str = "b", d: str = "dist", fill: float = 1.0) -> DataFrame:
    """Distance of every pair of keys, fill where none is given. The result is square in the number of keys, as asked for."""
    keys = dist.select(F.explode(F.array(a, b)).alias("k")).distinct()
    full = keys.select(F.col("k").alias(a)).crossJoin(keys.select(F.col("k").alias(b)))
    known = dist.groupBy(a, b).agg(F.min(d).alias(d))
    return full.join(known, [a, b], "left").select(a, b, F.when(F.col(a) == F.col(b), F.lit(0.0)).otherwise(F.coalesce(d, F.lit(fill))).alias(d))


def lookup_default(df: DataFrame, catalog: DataFrame, key: str, value: str, default) -> DataFrame:
    """df with a catalog value, default where the catalog lacks the key."""
    return df.join(catalog.select(key, value), key, "left").withColumn(value, F.coalesce(value, F.lit(default)))


def cluster_table(contigs: DataFrame, cluster: str, length: str, short_cov: str, long_cov: str, best_hits: DataFrame | None = None, min_len: int = 500) -> DataFrame:
    """One row per cluster of contigs of at least min_len: coverages weighted by length, size, number, longest, N50, L50, N90, L90, and species and similarity of the best hit."""
    c = contigs.filter(F.col(length) >= min_len)
    cov = c.groupBy(cluster).agg(*(F.round(F.sum(F.coalesce(v, F.lit(0.0)) * F.col(length)) / F.sum(length), 2).alias(name) for v, name in ((short_cov, "short_read_cov"), (long_cov, "long_read_cov"))))
    out = cov.join(nx_lx(c, length, [cluster]), cluster)
    if best_hits is not None:
        out = out.join(best_hits.select(cluster, "species", F.round(1 - F.col("dist"), 6).alias("similarity")), cluster, "left")
    return out


def contig_table(scaffolds: DataFrame, mass: DataFrame, clusters: DataFrame, species: DataFrame) -> DataFrame:
    """One row per scaffold: length, coverages from the summed masses of its contigs (two decimals), and the cluster and species of its contigs (null without).

    scaffolds: scaffold, contig; mass: contig, size, short_mass, long_mass; clusters: contig, cluster; species: cluster, species, reference.
    """
    j = scaffolds.join(mass, "contig").join(clusters, "contig", "left")
    g = j.groupBy("scaffold").agg(F.sum("size").cast("long").alias("length"), *(F.round(F.sum(m) / F.sum("size"), 2).alias(n) for m, n in (("short_mass", "short_read_cov"), ("long_mass", "long_read_cov"))), F.min("cluster").alias("cluster"))
    return g.join(species, "cluster", "left").select("scaffold", "length", "short_read_cov", "long_read_cov", "cluster", "species", "reference")


def repeat_scaffolds(gap_contigs: DataFrame, own: DataFrame, share: float = 0.8, skip: float = 1.5) -> DataFrame:
    """Scaffolds that look like repeats: the coverage of the contigs in their gaps exceeds share of their own.

    gap_contigs: scaffold, coverage, subtract; those whose coverage times skip is below subtract are left out. own: scaffold, coverage.
    """
    g = gap_contigs.filter(F.col("coverage") * skip >= F.col("subtract")).groupBy("scaffold").agg(F.avg("coverage").alias("gap_cov"))
    return own.join(g, "scaffold").filter(F.col("gap_cov") > share * F.col("coverage"))


def sequence_mappings_once(rows: DataFrame, read: str, contig: str) -> DataFrame:
    """Rows of reads that map to exactly one contig."""
    one = rows.groupBy(read).agg(F.count_distinct(contig).alias("_n")).filter("_n = 1").select(read)
    return rows.join(one, read, "left_semi")


def lineage_nodes(lineages: DataFrame, lineage: str = "lineage") -> DataFrame:
    """Taxonomy nodes of ';'-joined lineages: id (dense, by depth and name; 1 is the root), parent, name, depth."""
    parts = F.split(lineage, ";")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.struct(F.array_join(F.slice(parts, F.lit(1), i), ";").alias("path"), F.get(parts, i - 1).alias("name"), i.alias("depth")))
    nodes = lineages.select(F.explode(prefixes).alias("n")).select("n.*").distinct()
    ids = numbered(nodes, ["depth", "path"], "id").withColumn("id", (F.col("id") + 1).cast("int"))
    up = ids.select(F.col("path").alias("_up"), F.col("id").alias("parent"))
    head = F.expr("substring_index(path, ';', depth - 1)")
    return ids.withColumn("_up", head).join(up, "_up", "left").select("id", F.coalesce("parent", F.lit(1)).alias("parent"), "name", "depth")


def directories(df: DataFrame, order: list, per_dir: int = 4000) -> DataFrame:
    """df with directory: rows in order, per_dir to each.

    Rows need a total order.
    """
    return numbered(df, order, "_number").withColumn("directory", (F.floor((F.col("_number") - 1) / per_dir) + 1).cast("long")).drop("_number")


def size_bounded_files(df: DataFrame, by: list[str], order: list, size: str, cap: int, most: int = 300_000) -> DataFrame:
    """df with file: a new one whenever the running size passes the cap or most records; inside the groups of by."""
    w = Window.partitionBy(*by).orderBy(*order)
    before = F.coalesce(F.sum(size).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return df.withColumn("file", F.greatest(F.floor(before / cap), F.floor((F.row_number().over(w) - 1) / most)).cast("long"))


def packed_files(df: DataFrame, by: list[str], order: list[str], size: str, cap: int, most: int = 300_000) -> DataFrame:
    """df with file: rows in order are added to a file until its size has passed the cap or it has most rows; then the next begins at zero. Inside the groups of by,
    each of which one task walks through; a null size counts as 0."""
    kinds = dict(df.dtypes)
    names = df.columns

    def run(keys: tuple, rows: dict) -> list[tuple]:
        out, held, n, file = [], 0, 0, 0
        for x in rows[size].tolist():
            out.append(file)
            held, n = held + (0 if x is None or x != x else x), n + 1
            if held > cap or n >= most:
                held, n, file = 0, 0, file + 1
        return list(zip(*(rows[c].tolist() for c in names), out))

    return map_groups(df, by, order, run, ", ".join(f"`{c}` {kinds[c]}" for c in names) + ", file long")


def without_any(df: DataFrame, column: str, words: list[str]) -> DataFrame:
    """Rows whose text holds none of the words; null texts hold none."""
    hit = F.lit(False)
    for w in words:
        hit = hit | F.contains(F.col(column), F.lit(w))
    return df.filter(~F.coalesce(hit, F.lit(False)))


def read_statistics(spark: SparkSession, libraries: list[tuple[str, str]], path: str) -> DataFrame:
    """sample, n_reads, bases and mean length of FASTQ libraries (sample, file), kept as a Parquet table: only samples that it lacks are read and appended."""
    from contigloom.sources.readers import read_fastq

    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    exists = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)
    config = spark.createDataFrame(libraries, "sample string, file string").dropDuplicates(["sample"])
    for r in unseen(config, spark.read.parquet(path), "sample").collect() if exists else config.collect():  # a row for each library
        sums = read_fastq(spark, r["file"]).agg(F.count("*").alias("n_reads"), F.sum("length").cast("long").alias("bases"), F.avg("length").alias("mean"))
        sums.select(F.lit(r["sample"]).alias("sample"), "*").write.mode("append").parquet(path)
    return spark.read.parquet(path)


def per_base_quality(rows: DataFrame, contig: str, start: str, seq: str, ref: str, qual: str) -> DataFrame:
    """contig, pos, quality: mean quality of the aligned bases that match the reference (seq, ref and qual are aligned texts of one length, phred+33)."""
    at = rows.select(contig, start, F.posexplode(F.split(seq, "")).alias("i", "s"), ref, qual)
    at = at.filter((F.col("s") != "") & (F.col("s") == F.substring(F.col(ref), F.col("i") + 1, F.lit(1))))
    return at.groupBy(contig, (F.col(start) + F.col("i")).alias("pos")).agg(F.avg(F.ascii(F.substring(F.col(qual), F.col("i") + 1, F.lit(1))) - 33).alias("quality"))
