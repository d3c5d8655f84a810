"""Token counts and files, licenses, toxicity, decontamination, near-dedup on small tables of awkward rows."""

import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from contigloom.llm import decontam, licenses, near_dedup, token_counts, token_files, toxicity
from contigloom.runtime import scratch

public_tokenizers = pytest.importorskip("public_tokenizers")
WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")

LONG = " ".join(f"word{i % 97} of{i % 13}" for i in range(30_000))
TEXTS = [
    (1, "Released under the MIT License. the mit  license!"),
    (2, None),
    (3, ""),
    (4, "naïve Éclair <|endoftext|> x<|endoftext|>y  \n\n tabs\tand   spaces  "),
    (5, LONG),
    (6, "Released under the MIT License. the mit  license!"),
    (6, "GNU General Public License, Apache License; general public LICENSE"),
    (None, "no id here, it's 12 o'clock"),
    (8, "a" * 70_000),
    (9, "\x01 odd \x01bytes\x01 ΣΑΣ İstanbul x́ ..., A.B"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if k % 2 else None, "s", k, 1.5, "x") for k, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, labels string").repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def test_token_counts_match_the_library(docs, empty):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(BYTES)
    got = sorted(map(tuple, token_counts.count_tokens(docs, BYTES, piece_chars=1000, batch_bytes=5000).collect()), key=str)
    want = sorted(((i, len((t or "").encode()), n := len(model.encode(t or "", add_special_tokens=False).ids), n > 1024) for i, t in TEXTS), key=str)
    assert got == want
    assert token_counts.count_tokens(empty, BYTES).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8"), max_size=200), st.integers(1, 40))
def test_pieces_keep_the_token_count(text, size):
    encode = token_counts.load_encoder(BYTES)
    assert sum(encode(token_counts.safe_pieces(text, size))) == encode([text])[0]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aAbé\x01 .,'s1<|endoftx>\ńΣ"), max_size=60), max_size=5))
def test_chunk_encoder_is_exact(texts):
    from tokenizers import Tokenizer

    model, own = Tokenizer.from_file(WORDS), token_files.encoder_for(WORDS, "<u2", False)
    for t, b in zip(texts, own.encode([t.encode() for t in texts])):
        assert np.frombuffer(b, "<u2").tolist() == model.encode(t, add_special_tokens=False).ids


def test_token_files_round_trip(spark, docs, empty):
    from tokenizers import Tokenizer

    model, folder = Tokenizer.from_file(WORDS), scratch(spark, "test-tokens")
    manifest = token_files.write_token_files(docs, folder, WORDS, seq_len=16, batch_seqs=3)
    rows = sorted(token_files.read_digests(manifest).collect(), key=lambda r: r["start"])
    start = 0
    order = sorted(TEXTS, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))
    assert len(rows) == len(order)
    for r, (i, t) in zip(rows, order):
        ids = model.encode(t or "", add_special_tokens=False).ids + [2]
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    for f, n in manifest.groupBy("file").sum("n_tokens").collect():
        file = token_files.TokenFile(f)
        sequences = -(-n // 16)
        assert all(file.sequence(i).base is not None and len(file.sequence(i)) == 16 for i in range(sequences))
        assert sum(int(file.mask(i).sum()) for i in range(sequences)) == n
    assert token_files.read_digests(token_files.write_token_files(empty, scratch(spark, "none"), WORDS)).count() == 0


def test_licenses_against_plain_search(docs, empty):
    rx, table = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), str.maketrans(licenses.UPPER, licenses.LOWER)
    want = []
    for i, t in TEXTS:
        w = rx.findall((t or "").translate(table))
        at, found = [], set()
        for phrase, label in licenses.BASE.items():
            p = phrase.split()
            for k in range(len(w) - len(p) + 1):
                if w[k : k + len(p)] == p:
                    at.append(k)
                    found.add(label)
        want.append((i, len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(found))))
    got = [tuple(r)[:6] for r in licenses.license_labels(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert licenses.license_labels(empty).count() == 0


def test_license_passage_with_an_edit(spark):
    passage = next(p for p, label in licenses.TEMPLATES.items() if label == "mit-text").split()
    text = " ".join(["intro"] * 40 + passage[:12] + ["really", "very"] + passage[12:] + ["outro"] * 40)
    d = spark.createDataFrame([(1, text), (2, " ".join(passage[:9])), (3, " ".join(reversed(passage)))], "doc_id long, text string")
    labels = {r["doc_id"]: r["labels"] for r in licenses.license_labels(d).collect()}
    assert labels == {1: "mit-text", 2: "", 3: ""}


def test_license_plan_is_native(docs):
    assert "Python" not in licenses.license_labels(docs)._jdf.queryExecution().toString() and "Arrow" not in licenses.license_labels(docs)._jdf.queryExecution().toString()


def test_license_query_matches_its_sql(spark, sf_dir):
    import duckdb

    from contigloom.llm import queries

    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    cur = c.execute(licenses.ORACLE)
    names = [x[0] for x in cur.description]
    want = sorted(cur.fetchall(), key=str)
    got = sorted((tuple(r[n] for n in names) for r in queries.op1_license_scan(spark, sf_dir).collect()), key=str)
    assert got == want


def test_toxicity_on_held_out_rows(spark, sf_dir):
    from contigloom.llm import queries

    out = queries.op3_toxicity(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = out.join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 30 and np.mean([r["predicted"] == r["toxic"] for r in rows]) > 0.93
    positive, negative = ([r["score"] for r in rows if r["toxic"] == y] for y in (1, 0))
    assert np.mean([p > n for p in positive for n in negative]) > 0.95
    assert out.count() == spark.read.parquet("/root/testdata/sf0.01/documents.parquet").count()


def test_toxicity_edges(spark, docs, empty):
    labels = spark.createDataFrame([(1, 1), (1, 1), (3, 0), (None, 1), (4, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    rows = toxicity.score_texts(docs, model).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.score_texts(empty, toxicity.train(empty, labels.limit(0))).count() == 0
    assert toxicity.reject(docs, toxicity.constant_model()).count() == len(TEXTS)
    assert toxicity.reject(docs, model).columns == docs.columns


def test_pooling_in_blocks_equals_one_pass():
    rng = np.random.default_rng(1)
    model = toxicity.Model(rng.normal(size=(64, 4)), {w: rng.normal(size=(w, 4, 3)) for w in toxicity.WIDTHS}, np.zeros(9), np.ones(9), 0.0)
    scorer = toxicity.Scorer(model)
    words = [f"w{i}".encode() for i in rng.integers(0, 500, 9001)]
    scorer._add(list(set(words)))
    r = [model.responses([w])[0] for w in words]
    zero = np.zeros(len(r[0]))
    full = np.array([zero, zero, *r, zero, zero])
    n, col, want = len(full) - 2, 0, []
    for w in toxicity.WIDTHS:
        want.append(sum(full[k : k + n, col + k * 3 : col + (k + 1) * 3] for k in range(w)).max(0))
        col += 3 * w
    assert np.allclose(scorer.pooled(words), np.concatenate(want), atol=1e-5)


def edits(a: bytes, b: bytes) -> int:
    row = [0] * (len(b) + 1)  # a may start anywhere in b
    for x in a:
        new = [row[0] + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 5), st.randoms(use_true_random=False))
def test_decontamination_against_full_alignment(n_edits, rng):
    base = "".join(rng.choice("abcdefgh ") for _ in range(130))
    item = " ".join(base.split())
    text = list(item)
    for _ in range(n_edits):
        k = rng.randrange(len(text))
        text[k : k + 1] = rng.choice([[], ["z"], [text[k], "y"]])
    doc = "prefix words go here " + "".join(text) + " and a suffix follows it"
    index = decontam.Index([7], [item.encode()])
    got = index.matches([b"", doc.encode(), b"nothing of the kind"])
    normal = decontam.normal(doc.encode())
    w, k, _, starts = index.windows[0]
    met = [s for s in starts if edits(index.items[0][s : s + w].tobytes(), normal) <= k]
    assert [(d, i, n) for d, i, n, *_ in got] == ([(1, 0, len(met))] if met else [])


def test_decontamination_rows(spark, docs, empty):
    item = "The quick brown fox jumps over the lazy dog while seventeen purple elephants recite the alphabet backwards near a quiet lake in spring."
    bench = spark.createDataFrame([(1, item), (2, item), (3, None), (4, "tiny"), (5, "Another item that nobody copied, which is long enough to count as an item of its own, I think.")], "item_id long, text string")
    extra = spark.createDataFrame([(50, "x " * 400 + item.upper().replace("quick", "quack") + " y" * 400), (51, "the quick brown fox jumps over")], "doc_id long, text string")
    d = docs.select("doc_id", "text").union(extra)
    for size in (4 << 20, 10):
        got = sorted((r["doc_id"], r["item_id"]) for r in decontam.contaminated(d, bench, block_bytes=size).collect())
        assert got == [(50, 1), (50, 2)]
        assert decontam.decontaminate(d, bench, block_bytes=size).count() == len(TEXTS) + 1
    assert decontam.contaminated(empty, bench).count() == 0
    assert decontam.contaminated(d, bench.limit(0)).count() == 0


def components(rows):
    sets = defaultdict(set)
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] |= set(zip(*(w[k:] for k in range(5)))) if len(w) >= 5 else ({tuple(w)} if w else set())
    top = {i: i for i in sets}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                top[y] = x
    return {i: root(i) for i in ids}


def test_near_duplicates_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    rows, n = [], 0
    for g in range(12):
        base = [f"w{x}" for x in rng.integers(0, 400, 120)]
        for _ in range(int(rng.integers(1, 25))):
            w = list(base)
            for _ in range(int(rng.integers(0, 9))):
                w[int(rng.integers(len(w)))] = f"v{rng.integers(1000)}"
            rows.append((int((n * 7919) % 1009), " ".join(w)))
            n += 1
    rows += [(2000, "one two"), (2001, "One  two"), (2002, ""), (2003, None), (2004, "\n "), (2005, "one two three")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    want = components(rows)
    for block in (512, 8):
        got = {r["doc_id"]: r for r in near_dedup.near_duplicates(d, block_rows=block).collect()}
        assert {i: r["component_id"] for i, r in got.items()} == want
        assert all(r["kept"] == (i == want[i]) for i, r in got.items())
    assert got[2002]["n_shingles"] == got[2003]["n_shingles"] == 0 and got[2000]["n_shingles"] == 1
    assert sorted(r["doc_id"] for r in near_dedup.one_of_each(d).collect()) == sorted(i for i in want if want[i] == i)


def test_near_duplicates_edges(spark, docs, empty):
    got = near_dedup.near_duplicates(docs).collect()
    assert len(got) == len(TEXTS)
    by = defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
    assert {r["component_id"] for r in by[6]} == {1, 6}
    assert sorted(r["doc_id"] for r in near_dedup.one_of_each(docs).collect()) == [1, 2, 3, 4, 5, 6, 8, 9]
    assert not by[None][0]["kept"] and by[None][0]["component_id"] is None
    assert near_dedup.near_duplicates(empty).count() == 0


def test_registers_estimate_and_merge():
    rng = np.random.default_rng(9)
    for share in (0.3, 0.6, 0.9):
        n = 3000
        both = rng.integers(0, 1 << 63, int(n * share), dtype=np.uint64)
        a, b = (np.unique(np.concatenate([both, rng.integers(0, 1 << 63, n - len(both), dtype=np.uint64)])) for _ in "ab")
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        ra, rb, rab = near_dedup.registers([a, b, np.union1d(a, b)])
        assert (np.maximum(ra, rb) == rab).all()
        j = near_dedup.joint_estimate(ra[None], rb[None], np.array([float(len(a))]), np.array([float(len(b))]))[0]
        assert abs(j - true) < 0.16


def test_the_stage_drops_near_copies_from_eighty_hundredths(spark):
    import corpus_pipeline

    rows, like = [], []
    for g in range(40):
        base = [f"g{g}w{k}" for k in range(104 + g)]
        n = len(base) - 4
        both = next(b for b in range(n) if 100 * b >= 80 * (2 * n - b))
        rows += [(2 * g, " ".join(base)), (2 * g + 1, " ".join(base[: both + 4] + [f"x{g}y{k}" for k in range(n - both)]))]
        like.append(both / (2 * n - both))
    assert all(0.8 <= x < 0.85 for x in like)
    d = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, d, "").collect()) == [2 * g for g in range(40)]
    assert near_dedup.one_of_each(d).count() == 80
    assert near_dedup.band_rows(0.85) == 5 and near_dedup.band_rows(0.8) == 4
