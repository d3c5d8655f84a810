"""Sharding, mixing, top-k, main text and the pipeline on small tables of awkward rows."""

import zlib

import numpy as np
import pytest

from contigloom.llm import fair_mix, kd_shards, voronoi_knn, wrappers

DOCS = "doc_id long, text string, lang string, source string, n_chars long, shard int, size string"


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(600):
        source = None if i % 17 == 0 else "hot" if i % 3 == 0 else f"s{i % 5}"
        text = None if i == 5 else "" if i == 6 else "copy of one text again and again" if i % 4 == 1 else " ".join(f"w{x}" for x in rng.integers(0, 99, int(rng.integers(1, 60))))
        rows.append((None if i == 7 else i, text, ["en", "de", None][i % 3], source, i, 1, "x"))
    rows += [rows[10], rows[10]]
    return spark.createDataFrame(rows, DOCS).repartition(4)


def test_shards(spark, docs):
    rows = docs.collect()
    out = kd_shards.kd_shards(docs, shards=7).collect()
    assert len(out) == len(rows)
    want = sorted(((r["doc_id"], len((r["text"] or "").encode()) + 16, zlib.crc32((r["text"] or "").encode())) for r in rows), key=str)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in out), key=str) == want
    total = {s: sum(r["size"] for r in out if r["shard"] == s) for s in range(7)}
    mean = sum(total.values()) / 7
    assert all(abs(x - mean) < 0.1 * mean for x in total.values())
    for s in range(7):
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(sum(r["shard"] == s for r in out)))
    assert {r["law"] for r in out} == {"bytes"} and {r["grown_shard"] for r in out} == {None}
    assert kd_shards.kd_shards(docs.limit(0), shards=3).count() == 0
    assert {r["shard"] for r in kd_shards.kd_shards(docs.limit(2), shards=40).collect()} <= set(range(40))
    parts = {r["shard"] for r in kd_shards.kd_shards(docs, target_bytes=int(mean)).collect()}
    assert parts == set(range(7)) or parts == set(range(8))


def test_small_groups_of_copies_stay_together(spark):
    rows = [(i, f"text {i // 3} " + "x" * (i // 3 % 50), "en", f"s{i % 4}") for i in range(3000)]
    out = kd_shards.kd_shards(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), shards=5).collect()
    where = {}
    for r in out:
        where.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert all(len(s) == 1 for s in where.values())


def fair_targets(size: dict) -> dict:
    names = sorted(size, key=lambda s: (s is None, s or ""))
    w = {s: fair_mix.WEIGHTS[i % 3] for i, s in enumerate(names)}
    out, free = {}, set(names)
    while free:
        rest = sum(size.values()) - sum(out.values())
        share = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * size[s] + 1e-9}
        if not over:
            return out | share
        out |= {s: 3.0 * size[s] for s in over}
        free -= over
    return out


def test_mix(spark, docs):
    rows = docs.collect()
    got = fair_mix.mixed_sizes(docs).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in rows}
    size = {}
    for r in rows:
        size[r["source"]] = size.get(r["source"], 0) + len((r["text"] or "").encode().split())
    want = fair_targets(size)
    taken = dict.fromkeys(size, 0)
    for r in got:
        src = by_id[r["doc_id"]]["source"]
        assert r["size"] == len((by_id[r["doc_id"]]["text"] or "").encode().split()) and r["source_size"] == size[src]
        assert r["target"] == pytest.approx(want[src]) and 0 <= r["taken"] <= 3 * r["size"]
        taken[src] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 1 for s in size)
    again = fair_mix.mixed_sizes(docs).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert fair_mix.mixed_sizes(docs.limit(0)).count() == 0


def test_mix_sequence_is_fair_at_every_point(spark, docs):
    goal, sequence = fair_mix.mix(fair_mix.sized(docs))
    target = {r["source"]: r["target"] for r in goal.collect()}
    seen, last = dict.fromkeys(target, 0), 0.0
    for r in sequence.collect():
        assert r["finish"] >= last
        last = r["finish"]
        if last <= 1:  # all copies that end before it have been served
            seen[r["source"]] += r["taken"]
            assert all(seen[s] <= last * target[s] + 1e-6 for s in seen)


def test_mixed_documents_hold_the_taken_words(spark, docs):
    unique = docs.filter("doc_id is not null").dropDuplicates(["doc_id"])
    taken = {r["doc_id"]: r["taken"] for r in fair_mix.mixed_sizes(unique).collect()}
    out = fair_mix.mixed_documents(unique)
    assert out.columns == unique.columns
    words = {}
    for r in out.collect():
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(r["text"].split())
        assert r["n_chars"] == len(r["text"])
    assert words == {i: n for i, n in taken.items() if n}


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=8) * (1 + i % 3)]) for i in range(700)]
    rows += [(1000 + i, [0.5] * 8) for i in range(300)]
    rows += [(3000, None), (3050, [1.0, None] * 4), (3100, [float("nan")] * 8), (3150, [float("inf")] * 8), (None, [1.0] * 8), (3200, [1.0] * 6), (3201, [])]
    got = voronoi_knn.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), lambda c: c % 50 == 0).collect()
    good = [(i, np.floor(256 * np.array((v + [0.0] * 8)[:8], np.float32).astype(float)).astype(np.int64)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all()]
    want = []
    for q, x in good:
        if q % 50 == 0:
            best = sorted((-int(x @ y), i) for i, y in good if i != q)[:5]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_top_k_edges(spark):
    schema = "vec_id long, embedding array<float>"
    assert voronoi_knn.top_k(spark.createDataFrame([], schema), lambda c: c % 50 == 0).count() == 0
    got = voronoi_knn.top_k(spark.createDataFrame([(0, [1.0]), (1, [2.0]), (1, [2.0])], schema), lambda c: c % 50 == 0).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 1, 131072), (0, 2, 1, 131072)]
    assert voronoi_knn.top_k(spark.createDataFrame([(0, [1.0])], schema), lambda c: c % 50 == 0).count() == 0
    huge = np.array([[2**40, 1]], np.int64)
    assert voronoi_knn.products(huge >> 10, huge >> 10)[0, 0] == 2**60


def page(body, i=0):
    return f"<!DOCTYPE html><html><head><title>T{i}</title><style>p{{}}</style><script>var a='</p>';</script></head><body><nav><ul><li><a href='/'>Home</a></li><li>More {i}</li></ul></nav>{body}<footer>&copy; site</footer></body></html>"


def test_article_pages(spark):
    rows = [(i, f"http://a.example.com/{i}", page(f"<div class='ad'>Buy {i}</div><article><h1>Title {i}</h1><p>One&amp;two <b>bo</b>ld {i}<p>Three<br>four&nbsp;five</p><ul><li>x</li><li>y</li></ul><section class='comments'><p>nice {i}</p></section></article>", i)) for i in range(6)]
    rows += [(6, None, None), (7, "http://a.example.com/e", ""), (8, "no url", "plain text only"), (9, "http://a.example.com/c", "<html><body><article><p>cut off here <b")]
    out = {r["page_id"]: r for r in wrappers.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(6):
        assert out[i]["text"] == f"Title {i} One&two bold {i} Three four five x y"
        assert out[i]["n_chars"] == len(out[i]["text"]) and out[i]["url"] == f"http://a.example.com/{i}"
    assert out[6]["text"] == out[7]["text"] == "" and out[8]["text"] == "plain text only" and out[9]["text"] == "cut off here"
    assert wrappers.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_wrapper_without_article_element():
    pages = [page(f"<div id='c'><p>{('Long text of story %d. ' % i) * 10}</p><p>{('Second part %d. ' % i) * 9}</p></div><div class='notice'><p>cookies</p></div><div><span>Same tagline</span></div>", i) for i in range(5)]
    import json

    w = json.loads(wrappers.infer(pages))
    text = wrappers.extract(pages[0], w)
    assert text.startswith("Long text of story 0.") and text.endswith("Second part 0.") and "cookies" not in text and "tagline" not in text


def test_every_layout_of_a_host_gives_its_text(spark):
    layouts = [
        lambda i: f"<article><h1>Title {i}</h1><p>Story {i} of the first kind</p></article>",
        lambda i: f"<div class='content'><h1>Title {i}</h1><p>Story {i} of the second kind</p></div>",
        lambda i: f"<div class='x'><h1>Title {i}</h1><p>Story {i} of the third kind</p></div>",
    ]
    name = ["first", "second", "third"]
    for url in ("http://b.example.com/{}", None):
        rows = [(i, url and url.format(i), page(layouts[i % 20 % 3 if i % 20 < 3 else 0](i), i)) for i in range(120)]
        out = {r["page_id"]: r["text"] for r in wrappers.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
        assert out == {i: f"Title {i} Story {i} of the {name[i % 20 if i % 20 < 3 else 0]} kind" for i in range(120)}


def test_copies_of_one_article_keep_their_text(spark):
    copy = lambda i: page(f"<div class='content'><h1>One heading</h1><p>The only paragraph of an article that is copied many times.</p></div><p>seen {i}</p>", i)
    counted = lambda i: page(f"<div class='content'><h1>One heading</h1><p>The only paragraph of an article that is copied many times.</p><div>read {i} times</div></div>", i)
    single = lambda i: page("<div class='content'><p>A body of one block</p></div>", i)
    text = "One heading The only paragraph of an article that is copied many times."
    rows = [(i, f"http://{h}.example.com/{i}", f(i)) for h, f in (("c", copy), ("d", counted), ("e", single)) for i in range(20)]
    out = [(r["url"][7], r["page_id"], r["text"]) for r in wrappers.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()]
    assert sorted(out) == sorted((h, i, {"c": text, "d": f"{text} read {i} times", "e": "A body of one block"}[h]) for h in "cde" for i in range(20))


def test_fixed_texts_of_a_site_are_left_out():
    import json

    pages = [page(f"<div class='content'><h2>Our daily</h2><p>{f'Story {i} has words of its own, w{i}. ' * 4}</p></div>", i) for i in range(5)]
    assert "Our daily" not in wrappers.extract(pages[0], json.loads(wrappers.infer(pages)))
    assert "Our daily" in wrappers.extract(pages[0], json.loads(wrappers.infer(pages[:1] * 5)))


def test_short_parts_of_an_article_stay(spark):
    body = lambda i: (
        f"<div class='tagline'>Tag {i}</div><div class='x'><h1>Title {i}</h1><p>{'Long text. ' * 40}{i}</p><ul><li>item {i}</li></ul><blockquote><p>quote {i}</p></blockquote>"
        f"<table><tr><td>cell {i}</td></tr></table><section><p>part {i}</p></section><p>End {i}</p><ol><li>last {i}</li></ol></div>"
    )
    rows = [(i, url.format(i), page(body(i), i)) for i in range(20) for url in ("http://f.example.com/{}", "http://h{}.example.com/")]
    for r in wrappers.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect():
        i = r["page_id"]
        assert r["text"] == f"Title {i} {'Long text. ' * 40}{i} item {i} quote {i} cell {i} part {i} End {i} last {i}"


def test_wrapper_items():
    lines = lambda n, extra: [("a", "h1", f"t{n}"), *[("a", "p", f"x{n}{k}") for k in range(n)], *([("a", "aside", "opt")] if extra else [])]
    w = wrappers.fold(lines(3, True))
    for n, extra in ((1, False), (4, True), (2, False)):
        w = wrappers.generalise(w, wrappers.fold(lines(n, extra)))
    kinds = {b: x for x in w for b in x[2]}
    assert kinds["p"][0] == "*" and kinds["h1"][0] == "1" and kinds["h1"][2]["h1"] is None
    assert kinds["aside"][0] == "?" and kinds["aside"][2]["aside"] == "opt"


def test_pipeline(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_dedup", "decontamination", "mixing", "token_files"]
    from contigloom.runtime import keep

    d, counts = docs, []
    for name, stage in corpus_pipeline.STAGES:
        d = keep(stage(spark, d, sf), name)
        counts.append(d.count())
        if name != "token_files":
            assert d.columns == docs.columns
    assert docs.count() > counts[0] >= counts[1] >= counts[2] > 0 and counts[3] == counts[4]
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf).collect())) == sorted(map(tuple, d.collect()))


def test_stages_take_awkward_tables(spark, tmp_path):
    """Nulls everywhere, empty and long texts, repeated rows, an empty table, and columns named like the stages' own."""
    import corpus_pipeline

    names = ["score", "kept", "row", "taken", "size", "component_id", "_label", "_text", "key", "start", "part"]
    base = [(1, "plain words of a first text that is long enough to count here", "en", "a", 3), (1, "plain words of a first text that is long enough to count here", "en", "a", 3), (2, None, None, None, None), (3, "", "fr", None, 0), (None, "text without an id " * 3, "en", "b", 1), (4, "word " * 50_000, "xx", "a", 5), (5, "ünï çödé\x00 text <|endoftext|> " * 5, None, "b", None)]
    docs = spark.createDataFrame([(*r, *[None if i % 2 else "x"] * len(names)) for i, r in enumerate(base)], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names))
    spark.createDataFrame([(1, 0, 0), (4, None, 1), (None, 1, None)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, None), (2, "")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for start in (docs, docs.limit(0)):
        d = start
        for name, stage in corpus_pipeline.STAGES:
            d = stage(spark, d, str(tmp_path))
            path = str(tmp_path / f"{name}-{start is docs}")
            d.write.parquet(path)
            d = spark.read.parquet(path)
            if name != "token_files":
                assert d.columns == docs.columns
            if name == "near_dedup" and start is docs:
                assert sorted(r["doc_id"] for r in d.collect()) == [1, 2, 3, 4, 5]
        assert d.columns[:4] == ["doc_id", "start", "n_tokens", "ids_crc32"]
