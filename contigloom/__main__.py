"""Command line: assemble, bin-evaluation, read-concordance, novel-species, circular-sequence, build-db."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="contigloom")
    sub = p.add_subparsers(dest="command", required=True)
    a = sub.add_parser("assemble", help="clusters and scaffolds from contigs, alignments and edges")
    a.add_argument("--contigs", required=True)
    a.add_argument("--sam", required=True)
    a.add_argument("--edges", required=True)
    a.add_argument("--out", required=True)
    a.add_argument("--config", help="'KEY value' file with option names of the workflow")
    a.add_argument("--long-alignments", help="alignments of long reads to the contigs")
    a.add_argument("--long-kind", default="paf", choices=["paf", "m1", "mhap"])
    a.add_argument("--long-reads", help="the long reads, to fill gaps")
    a.add_argument("--genomes", help="reference genomes, files named species__reference")
    b = sub.add_parser("bin-evaluation", help="quality tiers")
    b.add_argument("table")
    c = sub.add_parser("read-concordance", help="abundances of two profiles and their correlation")
    c.add_argument("short")
    c.add_argument("long")
    c.add_argument("--rank", default="S", choices=["S", "G"])
    c.add_argument("--threshold", type=float, default=0.1)
    n = sub.add_parser("novel-species", help="bins without a near reference, and their clusters")
    n.add_argument("distances", help="sketch distances of the bins to references")
    n.add_argument("between", help="sketch distances of the bins among one another")
    n.add_argument("--cutoff", type=float, default=0.05)
    z = sub.add_parser("circular-sequence", help="scaffolds whose ends are joined by an edge")
    z.add_argument("scaffolds")
    z.add_argument("edges")
    d = sub.add_parser("build-db", help="genome catalog")
    d.add_argument("genomes")
    d.add_argument("--taxonomy")
    args = p.parse_args(argv)
    spark = SparkSession.builder.appName("contigloom").getOrCreate()

    from contigloom.plans import workflow
    from contigloom.sources.readers import read_config

    if args.command == "assemble":
        o = workflow.Options()
        if args.config:
            for k, v in read_config(open(args.config).read()).items():
                if hasattr(o, k.lower()):
                    setattr(o, k.lower(), float(v) if k.lower() in ("dispersion", "edge_ratio", "reference_cutoff") else int(v))
        workflow.assemble(spark, args.contigs, args.sam, args.edges, args.out, o, args.long_alignments, args.long_kind, args.long_reads, args.genomes)["summary"].show()
    elif args.command == "bin-evaluation":
        workflow.evaluate_bins(spark, args.table).show(truncate=False)
    elif args.command == "read-concordance":
        for df in workflow.read_concordance(spark, args.short, args.long, args.rank, args.threshold):
            df.show(truncate=False)
    elif args.command == "novel-species":
        from pyspark.sql import functions as F

        from contigloom.sources.readers import read_sketch_distances

        own = read_sketch_distances(spark, args.distances).select("query", "ref", "dist")
        between = read_sketch_distances(spark, args.between).select(F.col("ref").alias("a"), F.col("query").alias("b"), "dist")
        mags = own.select("query").union(between.select(F.explode(F.array("a", "b")))).distinct()
        workflow.novel_species(own, mags, between.filter("a < b"), args.cutoff, args.cutoff).show(truncate=False)
    elif args.command == "circular-sequence":
        from contigloom.sources.readers import read_edges, read_scaffolds

        workflow.circular_sequences(read_scaffolds(spark, args.scaffolds), read_edges(spark, args.edges)).show(truncate=False)
    else:
        workflow.build_catalog(spark, args.genomes, args.taxonomy).show(truncate=False)


if __name__ == "__main__":
    main()
