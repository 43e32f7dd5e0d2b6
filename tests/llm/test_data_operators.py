"""Neighbours, HTML, WARC, token files and packing: brute force and exact round trips."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from tests.conftest import DATA

from strandline.llm import ann, html, huffman, packing, tokenfile, tokens, warc

WORDS = ["the", "a,", "Bc", "é.", "1", "23", "don't", "!", "...", "İ", "Σς", "日本", "😀", "x\ny", "\n", " ", "\t", "<|endoftext|>", "<|startoftext|>", "a.\nB", "word###", "%%%", "\x1c", " "]


def tokenizer(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.vocabulary(name))


@pytest.mark.parametrize("name", [packing.VOCABULARY, tokenfile.VOCABULARY])
def test_chunked_ids_are_the_librarys(name, monkeypatch):
    monkeypatch.setattr(tokens, "KEPT", 40)
    rng = random.Random(7)
    texts = [None, "", " ", "  a", "a  "] + [" ".join(rng.choices(WORDS, k=rng.randint(0, 9))) for _ in range(1500)]
    enc = tokens.ChunkEncoder(name)
    want = tokenizer(name).encode_batch([t or "" for t in texts], add_special_tokens=False)
    for at in range(0, len(texts), 100):
        for raw, e, t in zip(enc.encode(texts[at : at + 100]), want[at : at + 100], texts[at : at + 100]):
            assert np.frombuffer(raw, enc.dtype).tolist() == e.ids, t


def test_packing_partitions_every_document(spark):
    texts = [None, "", "one two", "many words here " * 900, "é 😀"] * 2
    rows = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len({r["sequence_id"] for r in rows}) == len(rows)
    t = tokenizer(packing.VOCABULARY)
    for i, text in enumerate(texts):
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        own = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["start"])
        assert [x for r in own for x in np.frombuffer(r["ids"], "<u4").tolist()] == ids
        assert all(r["length"] & (r["length"] - 1) == 0 and r["length"] <= 1024 and r["offset"] == 0 and r["doc_tokens"] == len(ids) for r in own)
    assert packing.pieces(2048 + 5) == [(0, 1024), (1024, 1024), (2048, 4), (2052, 1)] and packing.pieces(0) == []


@pytest.mark.parametrize("n,v", [(0, 1), (1, 1), (10, 3), (257, 100), (50000, 30000), (1000, 1)])
def test_huffman_round_trip(n, v):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n) - 1, v - 1) if v > 1 else np.zeros(n, int)
    lengths = huffman.code_lengths(np.bincount(ids, minlength=v))
    assert lengths.max(initial=0) <= huffman.limit_for(max(1, int((lengths > 0).sum()))) and sum(2.0 ** -int(x) for x in lengths if x) <= 1
    code = huffman.Code(lengths)
    bits, checkpoints = code.encode(ids)
    assert (code.decode(bits, checkpoints, n) == ids).all()


def test_huffman_is_optimal_and_limited():
    import heapq

    counts = np.random.default_rng(1).integers(1, 1000, 60)
    heap, cost = counts.tolist(), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        s = heapq.heappop(heap) + heapq.heappop(heap)
        cost += s
        heapq.heappush(heap, s)
    assert (huffman.code_lengths(counts).astype(int) * counts).sum() == cost
    assert huffman.code_lengths(2 ** np.arange(40), 16).max() == 16


def test_token_files_round_trip(spark, monkeypatch):
    monkeypatch.setattr(tokenfile, "BLOCK", 700)
    monkeypatch.setattr(tokenfile, "FILE_IDS", 2500)
    rng = random.Random(3)
    rows = [(i * 3, " ".join(rng.choices(["the", "thing", "of", "x1"], k=rng.choice([0, 3, 40, 900])))) for i in range(40)] + [(7, None), (8, ""), (None, "null id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    index = tokenfile.write_token_files(df)
    got = sorted(tokenfile.read_token_files(spark, index).collect(), key=lambda r: r["start"])
    t, at = tokenizer(tokenfile.VOCABULARY), 0
    for (i, text), r in zip(sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0)), got):
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        assert (r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4").tolist()) == (i, at, ids)
        at += len(ids)
    assert len(got) == len(rows) and index.count() > 1
    assert tokenfile.read_token_files(spark, tokenfile.write_token_files(df.limit(0))).count() == 0


def test_warc_round_trip(spark):
    big, rows = "<p>" + "x" * 200 + "</p>", []
    rows = [(5, "http://a/", big), (2, "http://b/\nX: y", big), (9, None, big), (1, "u", "tiny"), (3, "u", "tiny"), (4, "u", None), (None, "n", "é" * 80), (6, "n", "é" * 80)]
    index = warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3))
    got = {r["id"]: r for r in warc.read_records(spark, index).collect()}
    assert len(got) == len(rows) and all(r["payload_ok"] for r in got.values())
    for i, _, h in rows:
        data = (h or "").encode()
        assert (got[i]["payload_bytes"], got[i]["payload_digest"]) == (len(data), hashlib.sha256(data).hexdigest())
        if got[i]["record_type"] == "response":
            assert got[i]["payload"] == data
    assert {i: (r["record_type"], r["refers_to"]) for i, r in got.items() if r["record_type"] == "revisit"} == {5: ("revisit", 2), 9: ("revisit", 2)}
    one = warc.read_records(spark, index.where("id = 9")).collect()
    assert len(one) == 1 and one[0]["id"] == 9
    stored = index.where("id = 2").first()
    with open(stored["file"].removeprefix("file://"), "rb") as f:
        f.seek(stored["offset"])
        headers, payload = warc.parse(zlib.decompress(f.read(stored["length"]), 31))
    assert headers["WARC-Type"] == "response" and payload == big.encode()


def test_html_main_text():
    words = "plain words that fill the paragraph with some length to it "
    page = f"""<html><head><title>T</title><style>p{{}}</style></head><body><header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav>
    <div class="cookie-notice">{words}</div><article><h1>Head&amp;line</h1><p>{words * 3}<p>Short.<ul><li>one<li>two</ul><script>x("</p>")</script><form>{words}</form></article>
    <aside>{words}</aside><section id="comments"><p>{words * 5}</p></section><footer>foot</footer></body></html>"""
    assert html.main_text(page) == " ".join(f"Head&line {words * 3} Short. one two".split())
    soup = f"""<div><div id="top"><a href=a>A</a> <a href=b>B</a></div><div><div><p>{words * 3}</p><p>Ok.</p><p>{words * 2}</p></div></div><div class="site-footer">end</div></div>"""
    assert html.main_text(soup) == " ".join(f"{words * 3} Ok. {words * 2}".split())
    assert [html.main_text(x) for x in (None, "", "<html></html>", "<script>a</script>", "text &lt;b&gt;")] == ["", "", "", "", "text <b>"]


@pytest.mark.parametrize("page", ["<" * 3000, "<div>" * 5000 + "x", "</p>" * 3000 + "y", '<a href="' * 500, "<!-- never closed", "<p a='>'>b</p><i>c"])
def test_html_never_fails(page):
    assert isinstance(html.main_text(page), str)


WORDY = "plain words that fill the paragraph with some length to it and then a little more of the same "
MENU = "".join(f"<a href=/{w}>{w} page</a> " for w in ("first", "second", "third", "fourth", "fifth", "sixth"))
#: Pages without an article element, whose names say nothing.
NEUTRAL = [
    f"<body><div class=x1>{MENU}</div><div class=x2><h2>Heading of it all</h2><p>{WORDY * 3}</p><p>{WORDY * 2}</p><p>Ok.</p></div><div class=x3><span>12</span> <span>pages</span> <span>of</span> <span>40</span></div></body>",
    f"<table><tr><td>{MENU}<td><p>{WORDY * 2}<p>Short.<p>{WORDY * 4}<td>{MENU}</table>",
    f"<div><ul><li>{MENU}<li>{MENU}</ul></div><section><div><p>{WORDY}</p><p>{WORDY * 5}</p></div></section><div><i>Print</i> <i>Save</i> <b>12</b> <i>Top</i></div>",
]


def test_html_densities_decide(monkeypatch):
    want = [f"Heading of it all {WORDY * 3} {WORDY * 2} Ok.", f"{WORDY * 2} Short. {WORDY * 4}", f"{WORDY} {WORDY * 5}"]
    assert [html.main_text(p) for p in NEUTRAL] == [" ".join(w.split()) for w in want]
    usual = html.Page.densities

    def flat(page):
        density, sums, chars, links = usual(page)
        return [0.0] * len(density), [0.0] * len(sums), chars, links

    monkeypatch.setattr(html.Page, "densities", flat)
    assert all(html.main_text(p) != " ".join(w.split()) for p, w in zip(NEUTRAL, want))


@pytest.mark.parametrize("around", [
    '<div title="the hidden cost">{}</div>', '<section data-hidden="false" data-role="navigation">{}</section>', '<div class="social-science">{}</div>', "<div alt='id=footer class=ad'>{}</div>",
    '<div class="content has-sidebar">{}</div>', "<div><object>{}</object></div>", "<div><noscript>{}</noscript></div>",
])
def test_html_keeps_what_only_looks_like_boilerplate(around):
    body = f"<p>{WORDY * 3}</p><p>with <math><mi>x</mi></math> in it, {WORDY * 2}</p>"
    page = f"<body><div>{MENU}</div>{around.format(body)}<div class='site-footer'>{WORDY}</div><div id=cookieNotice>{WORDY * 9}</div></body>"
    assert html.main_text(page) == " ".join(f"{WORDY * 3} with x in it, {WORDY * 2}".split())


def test_html_time_is_linear_in_odd_tags():
    import time

    for unit in ("<div>x", "</i>", "</p>", "<b><p>", "<li><div>", "<a href=x><i>", "<td></b>"):
        spent = []
        for n in (4000, 32000):
            began = time.process_time()
            html.main_text("<i>" + unit * n + "y")
            spent.append(time.process_time() - began)
        assert spent[1] < 24 * max(spent[0], 0.02), (unit, spent)


def test_html_rows(spark):
    rows = [(1, None, "u"), (1, None, "u"), (2, "", "u"), (3, f"<p>{WORDY}</p>", None), (3, f"<p>{WORDY}</p>", None)]
    df = spark.createDataFrame(rows, "page_id long, html string, url string").selectExpr("page_id", "html", "url", "'own' as n_chars", "'h' as `__html2`")
    got = sorted((r["page_id"], r["text"], r["n_chars"]) for r in html.extract(df).collect())
    text = WORDY.strip()
    assert got == [(1, "", 0), (1, "", 0), (2, "", 0), (3, text, len(text)), (3, text, len(text))] and html.extract(df.limit(0)).count() == 0


def test_html_query_shape(spark):
    out = html.extract(spark.read.parquet(f"{DATA}/pages.parquet").withColumnRenamed("url", "text"), keep=["page_id", "text"])
    assert out.columns == ["page_id", "text", "n_chars"] and all(r["n_chars"] == len(r["text"]) for r in out.collect())


def brute(ids, x, q, top):
    d = np.sqrt(((x - x[q]) ** 2).sum(1))
    d[q] = np.inf
    order = np.lexsort((ids, d))[:top]
    return ids[order].tolist(), d[order]


def test_neighbours_small_tables_are_exact(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 8)).astype(np.float32)
    x[50:120] = x[50]
    rows = [(int(i), v.tolist()) for i, v in enumerate(x)]
    bad = [(1000, None), (1100, [0.0] * 8), (1200, [1.0] * 7), (1300, [float("nan")] + [1.0] * 7), (1400, [None] + [1.0] * 7), (1500, [])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>")
    got: dict = {}
    for r in ann.NeighbourGraph.build(df).search(queries="id % 100 = 0 or id = 60").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["id"], r["score"]))
    assert set(got) == {0, 60, 100, 200}
    for q, found in got.items():
        ids, d = brute(np.arange(300), x.astype(np.float64), q, 10)
        found.sort()
        assert [f[0] for f in found] == list(range(1, 11)) and [f[1] for f in found] == ids and np.allclose([f[2] for f in found], d)


def test_neighbours_recall(spark, monkeypatch):
    monkeypatch.setattr(ann, "PIVOTS", 32)
    monkeypatch.setattr(ann, "BEAM", 128)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 24))
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found: dict = {}
    for r in ann.NeighbourGraph.build(df).search(queries="id % 200 = 0").collect():
        found.setdefault(r["query_id"], set()).add(r["id"])
    recall = np.mean([len(found[q] & set(brute(np.arange(4000), x, q, 10)[0])) / 10 for q in found])
    assert len(found) == 20 and recall >= 0.9


def test_neighbours_in_far_clusters(spark, monkeypatch):
    """More clusters than start points, each larger than a list: all ten neighbours are found, and every node is reached from any other."""
    monkeypatch.setattr(ann, "PIVOTS", 8)
    monkeypatch.setattr(ann, "BEAM", 128)
    rng = np.random.default_rng(5)
    x = np.repeat(rng.normal(size=(100, 12)) * 100, 25, axis=0) + rng.normal(size=(2500, 12)) * 0.01
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    built = ann.NeighbourGraph.build(df)
    found: dict = {}
    for r in built.search(queries="id % 50 = 0").collect():
        found.setdefault(r["query_id"], set()).add(r["id"])
    assert len(found) == 50
    assert np.mean([len(found[q] & set(brute(np.arange(2500), x, q, 10)[0])) / 10 for q in found]) >= 0.99
    ahead = {r["node"]: r["nbrs"] for r in built.graph.collect()}
    seen, todo = {1234}, [1234]
    while todo:
        new = set(ahead[todo.pop()]) - seen
        seen |= new
        todo += new
    assert len(seen) == 2500


def test_neighbours_rounds_take_few_shuffles(spark, monkeypatch):
    """At many partitions a shuffle's tasks are what a round costs; components that all are start points get no lists of their own."""
    monkeypatch.setattr(ann, "PIVOTS", 8)
    plans: dict = {}
    write = ann.materialize

    def seen(df, name, *more):
        plans.setdefault(name, []).append(df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning"))
        return write(df, name, *more)

    monkeypatch.setattr(ann, "materialize", seen)
    rng = np.random.default_rng(8)
    x = np.repeat(rng.normal(size=(3, 6)) * 100, 60, axis=0) + rng.normal(size=(180, 6)) * 0.01
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found: dict = {}
    for r in ann.NeighbourGraph.build(df).search(queries="id % 20 = 0").collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["id"]))
    assert all([i for _, i in sorted(found[q])] == brute(np.arange(180), x, q, 10)[0] for q in range(0, 180, 20))
    assert len(plans["links"]) == 1 and max(plans["edges"]) <= 4 and max(plans["beams"]) <= 3, plans


def test_tree_spans_at_least_length():
    x = np.random.default_rng(9).normal(size=(40, 3))
    edges = ann._tree([(100 + i, v.tobytes()) for i, v in enumerate(x)], np.dtype("<f8"), 3)
    d = ((x[:, None] - x[None]) ** 2).sum(2)
    group, least = list(range(40)), 0.0
    for i, j in sorted(((i, j) for i in range(40) for j in range(i)), key=lambda e: d[e]):
        if group[i] != group[j]:
            group, least = [group[i] if g == group[j] else g for g in group], least + d[i, j]
    assert len(edges) == 78 and {(b, a) for a, b, _ in edges} == {(a, b) for a, b, _ in edges}
    assert np.isclose(sum(d[a - 100, b - 100] for a, b, _ in edges), 2 * least)


def test_neighbours_few_or_no_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<double>")
    assert sorted((r["rank"], r["id"]) for r in ann.NeighbourGraph.build(df).search(queries="id = 0").collect()) == [(1, 2), (2, 1)]
    assert ann.NeighbourGraph.build(df.limit(0)).search().count() == 0
