"""The whole workflow on a made-up genome: long reads, references, gap filling, tables; and the commands."""

import numpy as np
import pytest

from contigloom import __main__ as command
from contigloom.functions.sequence import IUPAC_FROM, IUPAC_TO
from contigloom.plans import workflow


def rc(s):
    return s.translate(str.maketrans(IUPAC_FROM, IUPAC_TO))[::-1]


@pytest.fixture(scope="module")
def made(tmp_path_factory):
    """A genome of 12,000 bases: six contigs of 1,900 with gaps of 100 between, the third one the other way round; reads over every gap."""
    d = tmp_path_factory.mktemp("made")
    rng = np.random.default_rng(3)
    base = "".join(rng.choice(list("ACGT"), 12_000))
    span = [(2000 * i, 2000 * i + 1900) for i in range(6)]
    turned = [i == 2 for i in range(6)]
    put = lambda name, text: (d / name).write_text(text) and str(d / name)
    files = {"base": base, "dir": d}
    files["contigs"] = put("c.fa", "".join(f">c{i}\n{rc(base[a:b]) if t else base[a:b]}\n" for i, ((a, b), t) in enumerate(zip(span, turned))))
    files["sam"] = put("a.sam", "".join("\t".join([f"r{i}_{j}/1", "0", f"c{i}", str(int(p)), "60", "4M", "*", "0", "0", "ACGT", "IIII"]) + "\n" for i in range(6) for j, p in enumerate(rng.integers(1, 1890, 200))))
    files["edges"] = put("e.tsv", "c0\t+\tc1\t+\t100\t10\t9\n")
    reads, paf = "", ""
    for i in range(1, 6):
        for n in range(6):
            a, b = 2000 * (i - 1) + 20 * n, 2000 * i + 1880 - 20 * n
            name, back = f"l{i}_{n}", n % 2 == 1
            text = base[a:b]
            reads += f">{name}\n{rc(text) if back else text}\n"
            for k in (i - 1, i):
                lo, hi = max(a, span[k][0]), min(b, span[k][1])
                rs, re = lo - a, hi - a
                cs, ce = lo - span[k][0], hi - span[k][0]
                if back:
                    rs, re = len(text) - re, len(text) - rs
                if turned[k]:
                    cs, ce = 1900 - ce, 1900 - cs
                strand = "-" if back != turned[k] else "+"
                paf += "\t".join(map(str, [name, len(text), rs, re, strand, f"c{k}", 1900, cs, ce, hi - lo, hi - lo, 60])) + "\n"
    files["reads"], files["paf"] = put("l.fa", reads), put("l.paf", paf)
    (d / "genomes").mkdir()
    (d / "genomes" / "Some_species__R1.fa").write_text(f">g\n{base}\n")
    (d / "genomes" / "Other_species__R2.fa").write_text(">g\n" + "".join(rng.choice(list("ACGT"), 12_000)) + "\n")
    files["genomes"] = str(d / "genomes")
    return files


def test_long_reads_references_and_gaps(spark, made):
    o = workflow.Options(dispersion=20.0, sketch_size=200, reference_cutoff=0.3, strain_length=5_000)
    out = workflow.assemble(spark, made["contigs"], made["sam"], made["edges"], (made["dir"] / "asm").as_uri(), o, made["paf"], "paf", made["reads"], made["genomes"])
    seqs = [r["seq"] for r in out["sequences"].collect()]
    whole = max(seqs, key=len)
    inner = made["base"][:11_900]
    assert whole in (inner, rc(inner))  # six contigs in order, gaps filled from the reads
    order = [r["contig"] for r in sorted(out["scaffolds"].collect(), key=lambda r: r["pos"])]
    assert order in ([f"c{i}" for i in range(6)], [f"c{i}" for i in range(5, -1, -1)])
    info = out["contig_info"].first()
    assert info["species"] == "Some_species" and info["length"] == 6 * 1900 and info["long_read_cov"] > 1 and info["reference"] == "Some_species__R1"
    cluster = out["cluster_info"].first()
    assert cluster["n"] == 6 and cluster["species"] == "Some_species" and out["summary"].first()["n"] == 1
    assert {r["stage"] for r in out["timings"].collect()} >= {"contigs", "long_edges", "merged_clusters", "strains", "fillings", "contig_info"}
    assert (made["dir"] / "asm" / "contigs.fasta" / "_SUCCESS").exists() and (made["dir"] / "asm" / "assembly.stats" / "_SUCCESS").exists()
    n = out["timings"].count()
    again = workflow.assemble(spark, made["contigs"], made["sam"], made["edges"], (made["dir"] / "asm").as_uri(), o, made["paf"], "paf", made["reads"], made["genomes"])
    assert again["timings"].count() == n


def test_conflicting_edges_leave_the_better_supported(spark):
    rows = [("a", "+", "b", "+", 10, 1, 9), ("a", "+", "c", "+", 12, 1, 3), ("b", "+", "d", "+", 10, 1, 2)]
    e = spark.createDataFrame(rows, "c1 string, o1 string, c2 string, o2 string, dist int, std int, support int")
    sizes = spark.createDataFrame([(x, 2000) for x in "abcd"], "id string, length int")
    assert sorted((r["c1"], r["c2"]) for r in workflow.without_conflicts(e, sizes, workflow.Options()).collect()) == [("a", "b"), ("b", "d")]


def test_commands(spark, made, capsys):
    d = made["dir"]
    (d / "d.dist").write_text("r.fa\tb1\t0.20\t0\t9/1000\nr.fa\tb2\t0.01\t0\t900/1000\n")
    (d / "m.dist").write_text("b1\tb3\t0.02\t0\t700/1000\nb1\tb2\t0.30\t0\t7/1000\n")
    command.main(["novel-species", str(d / "d.dist"), str(d / "m.dist")])
    text = capsys.readouterr().out
    assert "b1" in text and "b3" in text and "|b2 " not in text
    (d / "s.scaf").write_text(">s1\tlength: 3000\tcov: 1\na\tBE\t1500\t0\nb\tBE\t1500\t0\n")
    (d / "z.tsv").write_text("b\t+\ta\t+\t5\t1\t4\n")
    command.main(["circular-sequence", str(d / "s.scaf"), str(d / "z.tsv")])
    assert "s1" in capsys.readouterr().out
