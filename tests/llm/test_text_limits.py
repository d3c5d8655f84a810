"""Decontamination at every length against full alignment, memory on repetitive texts, table bounds, chunk hashing and rolled files."""

import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from contigloom.llm import chunks, decontam, near_dedup, token_files, toxicity
from contigloom.runtime import scratch

public_tokenizers = pytest.importorskip("public_tokenizers")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def edits(a: bytes, b: bytes) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        new = [row[0] + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def changed(rng, text: str, n: int) -> str:
    out = list(text)
    for _ in range(n):
        k = rng.randrange(len(out)) if out else 0
        out[k : k + 1] = rng.choice([[], ["z"], [out[k] if out else "q", "y"]])
    return "".join(out)


@pytest.mark.parametrize("seed", range(4))
def test_items_of_every_length_are_met_as_full_alignment_says(seed):
    rng = random.Random(seed)
    met = 0
    for n in [*range(1, 70), *range(70, 201, 9)]:
        item = " ".join("".join(rng.choice("abcdefghij ") for _ in range(n)).split())
        if not item:
            continue
        w = min(64, len(item))
        k = int(0.07 * w)
        doc = rng.choice(["", "some words go before "]) + changed(rng, item, rng.randint(0, k + 1) if len(item) <= 64 else rng.randint(0, 9)) + rng.choice(["", " and an end"])
        text = decontam.normal(doc.encode())
        if len(item) < 10:
            want = [(1, 0, 1)] if b" " + item.encode() + b" " in b" " + text + b" " else []
        else:
            n_met = sum(edits(item.encode()[s : s + w], text) <= k for s in range(len(item) - w + 1))
            want = [(1, 0, n_met)] if n_met else []
        assert [x[:3] for x in decontam.Index([5], [item.encode()]).matches([b"another text", doc.encode()])] == want
        met += bool(want)
    assert met > 30


@pytest.mark.parametrize("length", [15, 16, 17, 18, 19, 29, 43, 57])
def test_spread_substitutions_within_the_budget_are_found(length):
    rng = random.Random(length)
    k = int(0.07 * length)
    for _ in range(30):
        item = "".join(rng.choice("abcdefghij") for _ in range(length))
        text = list(item)
        for i in range(k):
            text[(2 * i + 1) * length // (2 * k)] = "z"
        assert decontam.Index([1], [item.encode()]).matches([("start " + "".join(text) + " end").encode()])


def test_a_verbatim_window_at_any_place_is_found():
    rng = random.Random(5)
    item = "".join(rng.choice("abcdefghij klmnop") for _ in range(300)).strip()
    item = " ".join(item.split())
    for s in range(0, len(item) - 64, 7):
        assert decontam.Index([1], [item.encode()]).matches([("q" * 50 + item[s : s + 64].strip() + "q" * 50).encode()]) or item[s] == " " or item[s + 63] == " "


def test_repetitive_texts_take_bounded_memory():
    index = decontam.Index([1, 2], [b"ab" * 600, b"no such words in the text at all, none of them"])
    tracemalloc.start()
    got = index.matches([b"ab" * 20_000])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [g[:4] for g in got] == [(0, 0, 1200 - 63, 0)] and peak < 300 << 20


def test_hits_in_small_slices_give_the_same(monkeypatch):
    rng = random.Random(3)
    items = [" ".join("".join(rng.choice("abcd ") for _ in range(150)).split()).encode() for _ in range(8)]
    docs = [changed(rng, items[i % 8].decode(), 4).encode() * (1 + i % 3) for i in range(20)]
    want = decontam.Index(list(range(8)), items).matches(docs)
    monkeypatch.setattr(decontam, "HITS", 50)
    monkeypatch.setattr(decontam, "UNITS", 7)
    monkeypatch.setattr(decontam, "SLICE", 256)
    assert [x[:4] for x in sorted(decontam.Index(list(range(8)), items).matches(docs))] == [x[:4] for x in sorted(want)] and len(want) >= 20


def test_chunk_hashes_do_not_depend_on_their_place():
    texts = [b"one two", b"", b"  two\tone\n", b"x" * (chunks.BLOCK + 5) + b" one", b"\xc3\xa9 two"]
    raw, start, end, first = chunks.chunks(texts)
    words = [raw[s:e] for s, e in zip(start, end)]
    assert words == [w for t in texts for w in t.split()] and np.diff(first).tolist() == [len(t.split()) for t in texts]
    for which in (0, 1):
        h = dict(zip(words, chunks.hashes(raw, start, end, which).tolist()))
        assert [h[w] for w in words] == chunks.hashes(raw, start, end, which).tolist() and len(set(h.values())) == len(h)


def test_the_chunk_table_is_of_a_fixed_size_and_exact_when_full():
    from tokenizers import Tokenizer

    model, own = Tokenizer.from_file(WORDS), token_files.ChunkEncoder(WORDS, "<u2", slots=64)
    size = own.first.nbytes + own.ids.nbytes
    rng = np.random.default_rng(1)
    texts = [" ".join(f"{['w', 'longer', '\x01', 'é'][int(x) % 4]}{x}" for x in rng.integers(0, 500, 80)) for _ in range(60)]
    for _ in range(2):
        for t, b in zip(texts, own.encode([t.encode() for t in texts])):
            assert np.frombuffer(b, "<u2").tolist() == model.encode(t, add_special_tokens=False).ids
    assert own.first.nbytes + own.ids.nbytes == size and own.encode([]) == [] and own.encode([b"", b" "]) == [b"", b""]


def test_token_files_roll(spark):
    docs = spark.createDataFrame([(i, f"document number {i} has some words") for i in range(200)], "doc_id long, text string").coalesce(1)
    one, many = (token_files.write_token_files(docs, scratch(spark, "rolled"), WORDS, seq_len=8, batch_seqs=2, file_ids=n) for n in (1 << 26, 100))
    assert many.select("file").distinct().count() > 5
    rows = [sorted(map(tuple, token_files.read_digests(m).select("doc_id", "start", "n_tokens", "ids_crc32").collect())) for m in (one, many)]
    assert rows[0] == rows[1]


def test_the_encoder_is_chosen_by_the_model_s_description():
    assert token_files.drops_white_space(WORDS) and not token_files.drops_white_space(public_tokenizers.path("byte_bpe_50k.json"))


def test_word_responses_are_held_in_a_bounded_table():
    rng = np.random.default_rng(2)
    model = toxicity.Model(rng.normal(size=(64, 4)), {w: rng.normal(size=(w, 4, 3)) for w in toxicity.WIDTHS}, rng.normal(size=9), rng.normal(size=9), 0.1)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 3000, int(rng.integers(0, 400)))).encode() for _ in range(60)]
    small, large = toxicity.Scorer(model, 500), toxicity.Scorer(model, 50_000)
    small.STEP = 37
    assert np.allclose([float(small([t])[0]) for t in texts], large(texts), atol=1e-6)
    assert len(small.table) < 1000


def test_training_is_work_and_every_labelled_row_counts(spark):
    """The trained classifier is better than its start, and long texts are in its sample."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = docs.join(labels, "doc_id").selectExpr("text", "toxic", "crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 held").collect()
    fit, held = ([r for r in rows if r["held"] == h] for h in (False, True))
    y = np.array([r["toxic"] for r in held])
    good = []
    for epochs in (0, 6):
        model = toxicity.fit([(r["text"] or "").encode() for r in fit], np.array([r["toxic"] for r in fit]), epochs=epochs)
        s = toxicity.Scorer(model)([(r["text"] or "").encode() for r in held])
        good.append(((s >= 0.5) == y).mean())
    assert good[1] > max(good[0], (y == 0).mean())
    picked = toxicity.fit_sample(docs, labels, "doc_id", "toxic", 4000).join(docs, "doc_id")
    assert picked.filter("length(text) > 20000").count() == toxicity.learnable(labels, "doc_id", "toxic").filter("pmod(xxhash64(13, doc_id), 10) != 0").join(docs, "doc_id").filter("length(text) > 20000").count()


def test_thresholds_come_from_all_rows_that_the_fit_left_out(spark):
    rng = np.random.default_rng(7)
    rows = [(i, " ".join(["awful"] * (i % 4 == 0) * 3 + [f"w{x}" for x in rng.integers(0, 40, 20)]), ["en", "xx", None][i % 3]) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(2000)], "doc_id long, toxic int")
    plain = toxicity.train(docs, labels, most_rows=200)
    scored = toxicity.with_scores(docs, plain)
    model = toxicity.calibrated(plain, scored, labels)
    assert set(model.thresholds) == {"en", "xx"} and all(0 < t < 1 for t in model.thresholds.values())
    for out in (toxicity.reject(docs, model), toxicity.reject(docs, plain, labels)):
        assert {r["doc_id"] for r in out.select("doc_id").collect()} == {i for i in range(2000) if i % 4}
    assert toxicity.calibrated(plain, scored.drop("lang"), labels).thresholds == {}


def test_one_of_rows_that_share_a_key_stays_by_its_text(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, long), (2, long), (2, "another text of its own with words enough"), (3, "third text of its own with words enough"), (3, long)]
    out = near_dedup.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, out.collect())) == [(1, long), (2, rows[2][1]), (3, rows[3][1])]


def test_slices_cover_a_batch():
    b = pa.RecordBatch.from_arrays([pa.array(["a" * n if n else None for n in (3, 0, 900, 2, 2, 5000, 1)])], names=["t"])
    parts = list(chunks.slices(b, 0, 3, 1000))
    assert [x for p in parts for x in p.column(0).to_pylist()] == b.column(0).to_pylist() and max(p.num_rows for p in parts) <= 3
    assert zlib.crc32(b"") == 0 and list(chunks.slices(b.slice(0, 0), 0)) == []


def test_whole_documents_of_the_mix(spark):
    """Whole copies only, each source within a document of its target, the budget met as nearly, served in the order of finish times, keys that are null or repeat told apart."""
    from contigloom.llm import fair_mix

    rng = np.random.default_rng(6)
    rows = [(None if i % 50 == 0 else i // 2, " ".join(f"w{x}" for x in rng.integers(0, 90, int(rng.integers(0, 60)))) or None, ["a", "b", None, "c"][min(3, i % 7)]) for i in range(500)]
    rows += [rows[3], rows[3]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = [tuple(r) for r in fair_mix.mixed_documents(docs, whole=True).collect()]
    assert set(out) <= set(rows) and all(t for _, t, _ in out)
    goal, sequence = fair_mix.mix(fair_mix.sized(docs), whole=True)
    target = {r["source"]: r["target"] for r in goal.collect()}
    served = sequence.collect()
    assert [r["finish"] for r in served] == sorted(r["finish"] for r in served)
    total = {s: sum(r["taken"] for r in served if r["source"] == s) for s in target}
    assert all(abs(total[s] - target[s]) <= 60 for s in target) and abs(sum(total.values()) - sum(target.values())) <= 60
    words = {s: sum(len(t.split()) for _, t, x in out if x == s) for s in target}
    assert words == total
    assert max(out.count(r) / rows.count(r) for r in set(out)) <= 3


def test_chunks_parted_at_punctuation_are_exact():
    own = token_files.ChunkEncoder(WORDS, "<u2")
    assert own.fine
    rng = random.Random(2)
    pieces = ["a", "A", "H", "̱", "T̈", "İ", "İ", "'", "'s", "'S", "n't", "'RE", ".", ",", "***", "-", "(", "é", "É", " ", "  ", "\n", "1", "23", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "ß", "ǅ", "ﬁ", "Σ", " ", " ", "x", "Zebra", "\x01", "_", "@", "K", "´", "`"]
    for _ in range(4000):
        t = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 9))).encode()
        assert own._encode([t])[0] == own.library(t).tobytes()


def test_stages_keep_columns_named_like_their_own(spark, tmp_path):
    import corpus_pipeline

    names = ["_mix_key", "_Mix_taken", "_gone_doc", "_score", "_same", "_key", "_source", "kept", "finish", "copy", "order", "block", "known", "bin", "_text"]
    rows = [(i, " ".join(f"w{(i * 7 + k) % 90}" for k in range(40)), "en", f"s{i % 3}", 5) for i in range(60)]
    docs = spark.createDataFrame([(*r, *[f"{n}{r[0]}" for n in names]) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names))
    spark.createDataFrame([(i, 0, i % 2) for i in range(50)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "no such passage in any of the documents here, at all")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    d = docs
    for name, stage in corpus_pipeline.STAGES[:4]:
        d = stage(spark, d, str(tmp_path))
        d.write.parquet(str(tmp_path / name))
        d = spark.read.parquet(str(tmp_path / name))
        assert d.columns == docs.columns
        assert all(r["_mix_key"] == f"_mix_key{r['doc_id']}" and r["known"] == f"known{r['doc_id']}" for r in d.collect())


def test_texts_without_plain_spaces_are_cut_safely():
    from contigloom.llm import token_counts

    encode = token_counts.load_encoder(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(9)
    pieces = ["漢字", "。", "，", "かな", "abc", "12", "_", "²", "\t", "\xa0", "　", " ", "\r\n", "  ", " ", "'s", "…", "！", "\x1c", "​", "'", "é"]
    for _ in range(1500):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 30)))
        cut = token_counts.safe_pieces(text, rng.randint(1, 6))
        assert "".join(cut) == text and sum(encode(cut)) == encode([text])[0], text
    assert len(token_counts.safe_pieces("漢字かな。" * 400, 100)) > 10


def test_counts_by_pieces_are_those_of_the_library():
    from contigloom.llm import token_counts

    path = public_tokenizers.path("byte_bpe_50k.json")
    encode = token_counts.load_encoder(path)
    assert token_counts.counter_for(path) is not None and token_counts.counter_for(WORDS) is None
    counter = token_counts.PieceCounter(path, "<|endoftext|>", slots=128)
    size = counter.first.nbytes
    rng = random.Random(4)
    pieces = ["word", "The", " ", "  ", "\n", "\n\n", "\t", "\xa0", "　", " ", "\x85", " ", "é", "漢", "。", "'s", "'", "12", "...", "<|endoftext|>", "<|", "x" * 40, "\x1c", "‍", "🙂", "\r\n", ", "]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 14))) for _ in range(6000)] + ["", "a" * 3000 + " b" * 700]
    assert counter.lengths([t.encode() for t in texts], 50).tolist() == encode(texts)
    assert counter.first.nbytes == size and counter.lengths([]).tolist() == []
