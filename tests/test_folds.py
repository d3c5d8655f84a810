"""Sequential folds against recursive SQL, operators that no table query covers, and the binary and external paths."""

import struct
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from contigloom.operators import edges, external, gaps, scaffold, tables
from contigloom.plans import catalog
from contigloom.sources import bam, readers, writers

from test_catalog import TABLES, plain


@pytest.mark.parametrize("name", sorted(catalog.FOLD_ORACLES))
def test_fold_matches_sql(spark, sf_dir, name):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    cur = c.execute(catalog.FOLD_ORACLES[name])
    names = [x[0] for x in cur.description]
    df = catalog.QUERIES[name](spark, sf_dir)
    assert sorted(names) == sorted(df.columns)
    assert sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=str) == sorted((tuple(map(plain, r)) for r in cur.fetchall()), key=str)


def block(data: bytes) -> bytes:
    c = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = c.compress(data) + c.flush()
    return struct.pack("<4BI2BH2BHH", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))


def record(name, flag, ref, pos, ops, seq, qual, next_ref=-1):
    codes = [bam._BASES.index(x) for x in seq] + [0] * (len(seq) % 2)
    packed = bytes(codes[i] << 4 | codes[i + 1] for i in range(0, len(codes), 2))
    body = struct.pack("<iiBBHHHiiii", ref, pos, len(name) + 1, 60, 0, len(ops), flag, len(seq), next_ref, -1, 0) + name.encode() + b"\0"
    body += struct.pack(f"<{len(ops)}I", *(n << 4 | bam._OPS.index(o) for n, o in ops)) + packed + (bytes(ord(q) - 33 for q in qual) if qual else b"\xff" * len(seq))
    return struct.pack("<i", len(body)) + body


def test_binary_alignments_read_as_text_does(spark, tmp_path):
    head = b"BAM\x01" + struct.pack("<i", 4) + b"@HD\n" + struct.pack("<i", 2) + b"".join(struct.pack("<i", 3) + n + b"\0" + struct.pack("<i", 500) for n in (b"c1", b"c2"))
    rows = [record(f"r{i}/1", 16 * (i % 2), i % 2, i, [(4 + i % 3, "M"), (1, "I")], "ACGTN"[: 5 - i % 2], "IIIII"[: 5 - i % 2] if i % 5 else None, i % 2) for i in range(300)]
    rows.append(record("u/1", 4, -1, -1, [], "ACG", "III"))
    data = head + b"".join(rows)
    files = []
    for k, size in enumerate((97, 60_000)):  # records that run over many blocks, and many in one
        p = tmp_path / f"{k}.bam"
        p.write_bytes(b"".join(block(data[i : i + size]) for i in range(0, len(data), size)) + block(b""))
        files.append(str(p))
    got = bam.read_bam(spark, files, rows=64).collect()
    assert len(got) == 602
    r = next(r for r in got if r["qname"] == "r3/1")
    assert tuple(r)[:9] == ("r3/1", 16, "c2", 4, 60, "4M1I", "=", 0, 0) and r["seq"] == "ACGT" and r["qual"] == "IIII"
    u = next(r for r in got if r["qname"] == "u/1")
    assert (u["rname"], u["cigar"], u["rnext"], u["pos"]) == ("*", "*", "*", 0)
    assert next(r for r in got if r["qname"] == "r0/1")["qual"] == "*"
    hits = readers.sam_hits(bam.read_bam(spark, files[:1]))
    assert hits.count() == 300


def test_external_programs(spark):
    items = spark.createDataFrame([(1, "b\na\n"), (2, None)], "id int, text string")
    got = {r["id"]: (r["status"], r["out"]) for r in external.run_for_each(items, "id", ["sort"], stdin="text").collect()}
    assert got == {1: (0, "a\nb\n"), 2: (0, "")}
    assert external.run_for_each(items.limit(1), "id", ["sh", "-c", "exit {id}"]).first()["status"] == 1
    assert external.run_for_each(items.limit(1), "id", ["sleep", "9"], seconds=1).first()["status"] == -1


def test_kmer_side_files(spark, tmp_path):
    (tmp_path / "LastGraph").write_text("10\t20\t61\t1\n")
    (tmp_path / "asm.preGraphBasic").write_text("VERTEX 5 K 47\n")
    assert readers.kmer_size(spark, str(tmp_path / "contigs.fa"), "velvet") == 61
    assert readers.kmer_size(spark, str(tmp_path / "asm.contig"), "soap") == 47
    assert readers.kmer_size(spark, str(tmp_path / "other.contig"), "soap") is None and readers.kmer_size(spark, str(tmp_path / "contigs.fa"), "plain") is None


def test_headers_are_filled_over_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(readers, "FILL_LINES", 7)
    p = tmp_path / "s.scaf"
    p.write_text("".join(f">s{i}\tlength: 1\tcov: 1\n" + "".join(f"c{i}_{k}\tBE\t5\t1\n" for k in range(i * 5 % 23)) for i in range(30)))
    got = readers.read_scaffolds(spark, str(p)).collect()
    assert all(r["contig"] == f"{r['scaffold'].replace('s', 'c')}_{r['pos'] - 1}" for r in got) and len(got) == sum(i * 5 % 23 for i in range(30))


def test_small_filters(spark):
    assert [edges.dynamic_min_contig(x) for x in ([], [200.0], [300.0, 400.0], [5000.0], [1000.0])] == [500, 500, 600, 500, 500]
    d = spark.createDataFrame([("a", "partial-match"), ("b", "small-alignment"), ("c", None), ("d", "x overlapped y")], "id string, status string")
    assert sorted(r["id"] for r in tables.without_any(d, "status", ["small-alignment", "overlapped"]).collect()) == ["a", "c"]
    s = spark.createDataFrame([("s1", 300), ("s1", 300), ("s2", 900), ("s3", 100), ("s3", 399)], "scaffold string, length int")
    assert sorted((r["scaffold"], r["n"], r["total_len"]) for r in scaffold.fillable(s).collect()) == [("s1", 2, 600)]
    files = tables.packed_files(spark.createDataFrame([("x", i, 4) for i in range(7)] + [("y", 0, 50), ("y", 1, None)], "g string, i int, n int"), ["g"], ["i"], "n", 7)
    assert sorted((r["g"], r["i"], r["file"]) for r in files.collect()) == [("x", 0, 0), ("x", 1, 0), ("x", 2, 1), ("x", 3, 1), ("x", 4, 2), ("x", 5, 2), ("x", 6, 3), ("y", 0, 0), ("y", 1, 1)]


def test_sharded_distances_equal_one_join(spark):
    rows = [(i, "".join("ACGT"[(i * k * k + k) % 4] for k in range(200))) for i in range(12)]
    sk = gaps.sketches(spark.createDataFrame(rows, "id int, seq string"), k=9, size=50)
    one = gaps.sketch_distances(sk, sk, 9, 50)
    assert sorted(map(tuple, gaps.sharded_sketch_distances(sk, sk, 3, 9, 50).collect())) == sorted(map(tuple, one.collect()))


def test_header_lines_begin_every_file(spark, tmp_path):
    lines = spark.range(100).repartition(5).select(F.col("id").cast("string").alias("value"))
    writers.with_header(lines, "top").write.text(str(tmp_path / "h"))
    got = readers.numbered_lines(spark, str(tmp_path / "h")).filter("value = 'top'").collect()
    assert len(got) == 5 and {r["line"] for r in got} == {0}


@pytest.mark.parametrize("seed", range(12))
def test_gap_sizes_against_a_grid(seed):
    import numpy as np

    rng = np.random.default_rng(seed)
    lengths = [100, 80, 120, 90][: 3 + seed % 2]
    n = len(lengths) - 1
    edges_ = []
    for _ in range(int(rng.integers(1, 6))):
        i, j = sorted(rng.choice(n + 1, 2, replace=False).tolist())
        edges_.append((i, j, float(rng.integers(-150, 250)), float(rng.integers(1, 25))))
    k, n_sd = 20, 2

    def cost(g):
        return sum((((g[..., i:j]).sum(-1) + sum(lengths[i + 1 : j]) - d) / max(s, 1.0)) ** 2 for i, j, d, s in edges_)

    got = scaffold.gap_qp(lengths, edges_, k, n_sd)
    axes = np.meshgrid(*[np.arange(-k, 260, 4 if n == 3 else 1)] * n, indexing="ij")
    grid = np.stack(axes, -1).reshape(-1, n).astype(float)
    holds = [(i, j, d + n_sd * s - sum(lengths[i + 1 : j])) for i, j, d, s in edges_ if (j - i) * -k <= d + n_sd * s - sum(lengths[i + 1 : j])]
    fine = np.all([grid[:, i:j].sum(1) <= top for i, j, top in holds], axis=0) if holds else np.ones(len(grid), bool)
    assert (got >= -k - 1e-6).all() and all(got[i:j].sum() <= top + 1e-6 for i, j, top in holds)
    assert cost(got[None])[0] <= cost(grid[fine]).min() + 1e-3


@pytest.mark.parametrize("seed", range(6))
def test_tree_cut_against_all_cuts(seed):
    import math

    import numpy as np

    from contigloom.operators import trees

    rng = np.random.default_rng(seed)
    n = 6
    counts = [rng.poisson(rng.choice([5, 40]), (2, 7)) for _ in range(n)]
    lengths = np.full(n, 7 * 340.0)
    pairs = [(int(a), int(b), float(rng.random())) for a in range(n) for b in range(a)]
    merges = trees.merge_order(*(np.array(x) for x in zip(*pairs)))
    got = trees.cut(merges, counts, lengths, 340, 10.0, 50.0)
    leaves = [{i} for i in range(n)]
    for a, b, _, _ in merges:
        leaves.append(leaves[a] | leaves[b])

    def score(own):
        total = -0.5 * 2 * math.log(50.0)
        for s in range(2):
            values = np.concatenate([counts[i][s] for i in sorted(own)])
            mean = values.sum() / lengths[sorted(own)].sum() * 340
            total += float(trees.log_nb(values.astype(float), mean, 10.0).sum()) if mean > 0 else 0.0
        return total

    def cuts(node):
        yield [node]
        if node >= n:
            a, b, _, _ = merges[node - n]
            yield from ([*x, *y] for x in cuts(a) for y in cuts(b))

    best = max(sum(score(leaves[x]) for x in c) for c in cuts(len(leaves) - 1))
    found = sum(score({i for i in range(n) if got[i] == g}) for g in set(got.tolist()))
    assert found == pytest.approx(best)
