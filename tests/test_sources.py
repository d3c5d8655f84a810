"""Readers and writers on small files, the stage registry and the workflow."""

import gzip

from pyspark.sql import functions as F

from contigloom.plans import workflow
from contigloom.sources import readers, writers
from contigloom.streaming.coverage import session_counts, windowed_counts


def put(tmp_path, name, text):
    p = tmp_path / name
    (p.write_bytes(gzip.compress(text.encode())) if name.endswith("gz") else p.write_text(text))
    return str(p)


def test_fasta(spark, tmp_path):
    text = ">NODE_1_length_8_cov_3.5 more >text\nACGT\nACGT\n>two\n\n>three\nAC\n"
    for name in ("a.fa", "a.fa.gz"):
        p = put(tmp_path, name, text)
        got = {r["id"]: (r["seq"], r["length"]) for r in readers.read_fasta(spark, p).collect()}
        assert got == {"NODE_1_length_8_cov_3.5": ("ACGTACGT", 8), "two": ("", 0), "three": ("AC", 2)}
    assert readers.sniff_fasta(spark, p) == "velvet" and readers.sniff_reads(spark, p) == "fasta"
    assert readers.read_fasta(spark, p, 5, "velvet").first()["coverage"] == 3.5
    assert readers.header_lengths(readers.read_fasta(spark, p, 5)).first()["length"] == 8
    assert readers.assembly_size(readers.read_fasta(spark, p)).first()["total"] == 10


def test_fastq_counts_the_last_record(spark, tmp_path):
    p = put(tmp_path, "r.fastq", "".join(f"@r{i} x\nACG{'T' * i}\n+\n@II{'I' * i}\n" for i in range(7)))
    got = sorted((r["name"], r["length"], r["qual"][0]) for r in readers.read_fastq(spark, p).collect())
    assert got == [(f"r{i}", 3 + i, "@") for i in range(7)]


def test_numbered_lines_over_many_splits(spark, tmp_path):
    p = put(tmp_path, "n.txt", "".join(f"line {i}\n" for i in range(20_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = readers.numbered_lines(spark, p)
        assert df.filter(F.concat(F.lit("line "), F.col("line").cast("string")) != F.col("value")).count() == 0 and df.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_sam(spark, tmp_path):
    line = lambda q, flag, rname, pos: "\t".join([q, str(flag), rname, str(pos), "60", "4M", "*", "0", "0", "ACGT", "IIII"])
    p = put(tmp_path, "a.sam", "\n".join(["@SQ\tSN:c\tLN:9", line("x/1", 0, "c", 5), line("x/2", 16, "d", 3), line("y/1", 16, "c", 5), line("z/1", 80, "c", 2), line("w/1", 4, "*", 0)]) + "\n")
    sam = readers.read_sam(spark, p)
    assert readers.sniff_mapping(spark, p) == "sam"
    assert sorted((r["qname"], r["pos"]) for r in readers.sam_hits(sam).collect()) == [("x/1", 4), ("y/1", 7), ("z/1", 4)]
    assert sorted((r["qname"], r["pos"]) for r in readers.sam_hits(sam, strict=True).collect()) == [("x/1", 4), ("y/1", 7), ("z/1", 1)]
    pair = readers.mate_pairs(readers.sam_to_bowtie(sam)).collect()
    assert [(r["stem"], r["contig1"], r["contig2"], r["ori2"]) for r in pair] == [("x", "c", "d", "-")]


def test_long_alignments(spark, tmp_path):
    p = put(tmp_path, "a.paf", "r1\t100\t10\t60\t-\tc1\t500\t20\t70\t45\t50\t60\n")
    r = readers.read_long_alignments(spark, p).first()
    assert (r["rn"], r["cn"], r["co"], r["cs"], r["ce"], r["cl"], r["rs"], r["re"], r["rl"], r["score"]) == ("r1", "c1", 1, 430, 480, 500, 10, 60, 100, 0.9)


def test_tables(spark, tmp_path):
    edges = readers.read_edges(spark, put(tmp_path, "e.tsv", "a\t+\tb\t-\t10\t0\t3\nbad\tline\n"), whole_rows=True).collect()
    assert [tuple(e) for e in edges] == [("a", "+", "b", "-", 10, 0, 3)]
    known = spark.createDataFrame([("a",), ("b",)], "id string")
    e = readers.read_scaffold_edges(spark, put(tmp_path, "h.tsv", "First\tO\tSecond\tO\tD\tS\tN\na\t+\tb\t-\t10\t0\t3\na\t+\tz\t-\t10\t2\t3\n"), known).collect()
    assert [(x["c1"], x["c2"], x["std"]) for x in e] == [("a", "b", 1)]
    d = readers.read_sketch_distances(spark, put(tmp_path, "m.dist", "r.fa\tq.fa\t0.19\t1e-5\t9/1000\n")).first()
    assert (d["shared"], d["total"]) == (9, 1000)
    k = readers.read_kraken_report(spark, put(tmp_path, "k.txt", " 12.5\t10\t5\tS\t562\t    Some species\n")).first()
    assert (k["pct"], k["name"]) == (12.5, "Some_species")
    w = readers.read_windowed_coverage(spark, put(tmp_path, "w.cov", "1 500 80 340\nc1\t1000\t80\t919\t2\n7\n3 4\nc2\t600\t1\t2\t1\n5\n5\n")).orderBy("id").collect()
    assert [(r["id"], r["sum_count"], r["counts"], r["sample"]) for r in w] == [("c1", 7, [3, 4], 0), ("c2", 5, [5], 0)]
    s = readers.read_scaffolds(spark, put(tmp_path, "s.scaf", ">s1\tlength: 9\tcov: 2\na\tBE\t5\t10\nb\tEB\t4\t0\n>s2\tlength: 3\tcov: 1\nc\tBE\t3\t0\n")).collect()
    assert sorted((r["scaffold"], r["pos"], r["contig"], r["ori"], r["gap"]) for r in s) == [("s1", 1, "a", "+", 10), ("s1", 2, "b", "-", 0), ("s2", 1, "c", "+", 0)]
    refs = readers.read_ranked_references(spark, put(tmp_path, "sp.dat", ">1\nx\ny\n>2\nz\n")).orderBy("cluster").collect()
    assert [(r["cluster"], r["refs"]) for r in refs] == [("1", ["x", "y"]), ("2", ["z"])]
    c = readers.read_coords(spark, put(tmp_path, "c.coords", "h\nh\nh\nh\n1\t9\t2\t8\t9\t7\t98.5\t100\t50\tref\tqry\n")).first()
    assert (c["s1"], c["idy"], c["cov_r"], c["name_r"], c["name_q"]) == (1, 98.5, None, "ref", "qry")
    b = readers.read_bin_evaluation(spark, put(tmp_path, "b.txt", "-----\n  Bin Id      Marker lineage   Completeness   Contamination   Strain\n-----\n  bin1        k__Bacteria (UID)     95.10         1.20        0.00\n-----\n")).collect()
    assert [tuple(r) for r in b] == [("bin1", 95.1, 1.2)]
    t = readers.read_taxonomy(spark, put(tmp_path, "t.tsv.gz", "RS_G1\td__B;g__X;s__X y\n")).first()
    assert (t["genome"], t["species"]) == ("G1", "X_y")
    lib = readers.read_library_stats(spark, put(tmp_path, "lib.txt", "Mean length of the library is: 342\nStandard deviation of the library is: 21\nOrientation of paired-reads is: in\n")).first()
    assert tuple(lib) == (342, 21, "in")
    assert readers.read_config("A 1 # x\n[LIB]\nm=2\n[LIB]\nm = 3\n") == {"A": "1", "LIB.1.m": "2", "LIB.2.m": "3"}
    p = readers.read_provenance(spark, put(tmp_path, "p.dat", "a\t+\tb\t-\tr1;r2\tCOORD_CONTIG_1:0_1_2;1_3_4\tCOORD_CONTIG_2:0_5_6;0_7_8\tCOORD_CONTIG_1_ON_READ:0_1_9;0_2_9\tCOORD_CONTIG_2_ON_READ:0_1_3;0_2_4\tCONTIG_FOR_GAPFILLING:x,y;\n")).first()
    assert [(x["read"], x["c1"]["s"], x["gap"]) for x in p["reads"]] == [("r1", 1, ["x", "y"]), ("r2", 3, [])]


def test_writers_and_stages(spark, tmp_path):
    seqs = spark.createDataFrame([("a", "ACGT", "1", 2.5), ("b", "GG", None, None)], "id string, seq string, cluster string, cov double")
    writers.write_fasta(seqs, str(tmp_path / "out"), cov="cov")
    assert {r["descr"]: r["seq"] for r in readers.read_fasta(spark, str(tmp_path / "out")).collect()} == {"a cov_2.5": "ACGT", "b cov_NA": "GG"}
    writers.write_fasta_by(seqs, str(tmp_path / "by"), "cluster")
    assert sorted(p.name for p in (tmp_path / "by").iterdir() if p.is_dir()) == ["cluster=1", "cluster=unclustered"]
    made = []
    for _ in range(2):
        run = writers.Stages(spark, (tmp_path / "stages").as_uri())
        assert run.run("one", lambda: made.append(1) or seqs).count() == 2
    assert made == [1]


def test_workflow(spark, tmp_path):
    rng = __import__("numpy").random.default_rng(0)
    base = "".join(rng.choice(list("ACGT"), 12_000))
    contigs = "".join(f">c{i}\n{base[i * 2000:(i + 1) * 2000]}\n" for i in range(6))
    sam = "".join("\t".join([f"r{i}_{j}/1", "0", f"c{i}", str(int(p)), "60", "4M", "*", "0", "0", "ACGT", "IIII"]) + "\n" for i in range(6) for j, p in enumerate(rng.integers(1, 1990, 200 if i < 4 else 30)))
    edges = "".join(f"c{i}\t+\tc{i + 1}\t+\t{10 * i}\t5\t9\n" for i in range(5))
    got = workflow.assemble(spark, put(tmp_path, "c.fa", contigs), put(tmp_path, "a.sam", sam), put(tmp_path, "e.tsv", edges), (tmp_path / "asm").as_uri(), workflow.Options(dispersion=20.0))
    clusters = {r["contig"]: r["cluster"] for r in got["clusters"].collect()}
    assert len({clusters[f"c{i}"] for i in range(4)}) == 1 and clusters["c4"] != clusters["c0"]
    order = [r["contig"] for r in sorted(got["scaffolds"].filter("scaffold = 'c0'").collect(), key=lambda r: r["pos"])]
    assert order == ["c0", "c1", "c2", "c3"] and got["summary"].first()["n"] == 2


def test_streaming_equals_batch(spark, tmp_path):
    rows = spark.createDataFrame([(1, "2024-01-01 00:00:01"), (1, "2024-01-01 00:00:50"), (1, "2024-01-01 00:03:00"), (2, "2024-01-01 00:00:10")], "id int, t string").select("id", F.to_timestamp("t").alias("ts"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = windowed_counts(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), "id", "ts", "1 minute")
    q = stream.writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    q.awaitTermination(60)
    assert sorted(map(tuple, spark.table("counts").collect())) == sorted(map(tuple, windowed_counts(rows, "id", "ts", "1 minute").collect()))
    assert sorted((r["id"], r["n"]) for r in session_counts(rows, "id", "ts", "1 minute").collect()) == [(1, 1), (1, 2), (2, 1)]


def test_scratch_is_released(spark):
    from pathlib import Path

    from contigloom import runtime

    df = runtime.keep(spark.range(5), "test")
    folder = Path(df._kept_path.removeprefix("file://"))
    assert df.count() == 5 and folder.exists() and spark.sparkContext.applicationId in str(folder)
    runtime.drop(df)
    assert not folder.exists()
    runtime.keep(spark.range(5), "test")
    runtime.release(spark)
    assert not folder.parent.exists()


def test_mates_of_reads_that_share_a_name(spark, tmp_path):
    line = lambda q, flag, rname, pos: "\t".join([q, str(flag), rname, str(pos), "60", "4M", "*", "0", "0", "ACGT", "IIII"])
    blocks = [
        [("x/1", 0, "a", 1), ("x/2", 0, "b", 2), ("x/1", 0, "c", 3), ("x/2", 16, "d", 4)],  # two reads, one name
        [("y/1", 0, "a", 5), ("y/2", 4, "*", 0), ("y/1", 0, "b", 6), ("y/2", 0, "c", 7)],  # the first one's mate is not mapped
        [("z/1", 4, "*", 0), ("z/2", 0, "a", 8), ("z/1", 0, "b", 9), ("z/2", 0, "c", 10)],
        [("w/2", 0, "a", 11), ("w/1", 0, "b", 12), ("w/2", 0, "c", 13), ("w/1", 0, "d", 14)],  # mate 2 first
        [("v/1", 0, "a", 15)],
        [("u/1", 0, "a", 16), ("u/2", 0, "b", 17)],
        [("v/2", 0, "b", 18)],  # far from its mate
        [("x/1", 0, "e", 19), ("x/2", 0, "f", 20), ("t/1", 0, "a", 21)],
    ]
    p = put(tmp_path, "a.sam", "@HD\tVN:1.6\n" + "".join(line(*x) + "\n" for b in blocks for x in b))
    pair = readers.mate_pairs(readers.sam_to_bowtie(readers.read_sam(spark, p, lines=True)))
    got = sorted((r["stem"], r["contig1"], r["pos1"], r["contig2"], r["pos2"]) for r in pair.collect())
    assert got == [("u", "a", 15, "b", 16), ("v", "a", 14, "b", 17), ("w", "b", 11, "a", 10), ("w", "d", 13, "c", 12), ("x", "a", 0, "b", 1), ("x", "c", 2, "d", 3), ("x", "e", 18, "f", 19), ("y", "b", 5, "c", 6), ("z", "b", 8, "c", 9)]
    assert pair.columns == ["stem", "ori1", "contig1", "pos1", "seq1", "ori2", "contig2", "pos2", "seq2"]


def test_sam_mates_of_equal_names_match_sql(spark, tmp_path):
    import duckdb

    from contigloom.plans import files

    keys = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_returnflag string, l_linestatus string, l_quantity double, l_extendedprice double"
    rows = [(1, 2, 30, 4, "R", "O", 18.0, 100.25), (1, 2, 31, 5, "N", "F", 33.0, 100.75), (1, 2, 32, 6, "N", "F", 7.0, 100.5), (1, 3, 30, 4, "R", "F", 9.0, 100.5)]
    spark.createDataFrame(rows, keys).coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    want = duckdb.sql(files.ORACLES["sam_mates"].replace("FROM lineitem", f"FROM '{tmp_path}/lineitem.parquet/*.parquet'")).fetchall()
    assert sorted(map(tuple, files.QUERIES["sam_mates"](spark, str(tmp_path)).select("stem", "ori1", "contig1", "pos1", "ori2", "contig2", "pos2").collect())) == sorted(want)
