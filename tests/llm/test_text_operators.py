"""Language id, SimHash, decontamination, PII and quality against plain versions."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from tests.conftest import DATA
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from strandline.llm import decontaminate, langid, neardup, pii, quality, simhash


def frame(spark, texts, **more):
    rows = [(i, t, *[v[i] for v in more.values()]) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string" + "".join(f", {k} string" for k in more))


# --- SimHash


def plain_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = ([" ".join(words)] if words else []) if len(words) < 3 else [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, codes):
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for i, a in zip(ids, codes):
            for j, b in zip(ids, codes):
                if bin(a ^ b).count("1") <= 2 and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


def test_simhash_groups_match_brute_force(spark):
    texts = ["A b c d e", "a B c d e", "", None, "one", "x y", "É é É", "tab\tsep\nwords\x0bhere", "a b c d e f", " nbsp stays"] + [f"w{i} common words in all of them {i % 3}" for i in range(20)]
    got = {r["doc_id"]: r for r in simhash.group_documents(frame(spark, texts)).collect()}
    codes = [plain_fingerprint(t) for t in texts]
    assert [got[i]["fingerprint"] for i in range(len(texts))] == [f"{c:016x}" for c in codes]
    label = plain_components(list(range(len(texts))), codes)
    assert {i: got[i]["component_id"] for i in label} == label


@settings(max_examples=25, deadline=None)
@given(st.integers(1, 400), st.integers(1, 12), st.integers(0, 6), st.integers(0, 2**32))
def test_index_links_equal_all_pairs(n, centres, flips, seed):
    rng = np.random.default_rng(seed)
    codes = rng.integers(0, 2**63, centres, dtype=np.uint64)[rng.integers(0, centres, n)]
    for _ in range(flips):
        codes = codes ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64))
    codes = np.unique(codes)
    a, b = simhash.index_links(codes)
    want, got = simhash._Union(len(codes)), simhash._Union(len(codes))
    i, j = np.nonzero(np.bitwise_count(codes[:, None] ^ codes[None]) <= 2)
    want.join(i, j)
    got.join(np.searchsorted(codes, a), np.searchsorted(codes, b))
    assert (want.p == got.p).all()


def test_oversize_nodes_are_split_without_loss(spark, monkeypatch):
    monkeypatch.setattr(simhash, "NODE_LIMIT", 8)
    rng = random.Random(3)
    base = [rng.getrandbits(63) for _ in range(4)]
    codes = sorted({base[i % 4] ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)) for i in range(160)})
    links = simhash.links(spark.createDataFrame([(c,) for c in codes], "fp long")).collect()
    want, got = simhash._Union(len(codes)), simhash._Union(len(codes))
    x = np.array(codes, np.uint64)
    i, j = np.nonzero(np.bitwise_count(x[:, None] ^ x[None]) <= 2)
    want.join(i, j)
    place = {c: k for k, c in enumerate(codes)}
    got.join(np.array([place[r["a"]] for r in links], int), np.array([place[r["b"]] for r in links], int))
    assert (want.p == got.p).all()


def kept_by_brute_force(rows):
    """Ids of the first rows of the sets that Jaccard similarities of five-word shingles of 0.8 or more connect."""
    sets, root = [], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for _, t in rows:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))})
    for i, a in enumerate(sets):
        for j in range(i):
            if len(a & sets[j]) >= 0.8 * len(a | sets[j]):
                root[max(find(i), find(j))] = min(find(i), find(j))
    least: dict = {}
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min(least.get(find(k), (i is None, i or 0)), (i is None, i or 0))
    return sorted(least.values())


def planted(rng, vocabulary, n):
    """Texts with exact copies and copies with a few words changed, between 0.6 and 1 similar."""
    out = []
    for _ in range(n):
        words = rng.choices(vocabulary, k=rng.randint(1, 300))
        out.append(" ".join(words))
        for _ in range(rng.choice([0, 0, 1, 4])):
            copy = list(words)
            for _ in range(rng.randint(0, 1 + len(words) // 60)):
                copy[rng.randrange(len(copy))] = "changed"
            out.append(" ".join(copy).upper())
    rng.shuffle(out)
    return [(i, t) for i, t in enumerate(out)]


def test_keep_one_keeps_one_of_each_group(spark):
    df = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (2, "a b c d"), (None, "x y z w"), (None, "x y z w"), (3, None), (4, ""), (5, "q r s t u v")], "doc_id long, text string").repartition(3)
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in neardup.keep_one(df).collect()) == [(0, "x y z w"), (1, "a b c d"), (3, ""), (5, "q r s t u v")]
    assert neardup.keep_one(df.limit(0)).count() == 0


def test_keep_one_matches_brute_force_however_rows_are_dealt(spark, tmp_path):
    rows = planted(random.Random(11), [f"w{i}" for i in range(900)], 120)
    want = [i for _, i in kept_by_brute_force(rows)]
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "doc_id as __row", "'x' as node", "text as __text").repartition(3).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    half = docs.where("doc_id % 2 = 0").unionByName(docs.where("doc_id % 2 = 1"))
    named = docs.drop("__row").withColumnRenamed("node", "split")
    for some in (docs.drop("__row"), named.repartition(5, "doc_id"), named.orderBy(F.desc("doc_id")), half.drop("__row"), named.where("doc_id >= 0")):
        got = neardup.keep_one(some)
        assert got.columns == some.columns
        ids = sorted(r["doc_id"] for r in got.collect())
        assert set(want) <= set(ids) and len(ids) <= 1.02 * len(want)
        assert {r["doc_id"]: r["text"] for r in got.collect()} == {i: t for i, t in rows if i in set(ids)}
    got = neardup.keep_one(named)
    before = sorted(r["doc_id"] for r in got.collect())
    usual = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        assert sorted(r["doc_id"] for r in got.collect()) == before
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", usual)


def test_keep_one_in_a_large_group_of_near_copies(spark, monkeypatch):
    """A group of more fingerprints than a window holds is still one group."""
    monkeypatch.setattr(neardup, "WINDOW", 64)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(600):
        copy = list(words)
        copy[rng.randrange(200)] = f"x{i}"
        rows.append((i, " ".join(copy)))
    rows += [(1000 + i, " ".join(rng.choices(words, k=50))) for i in range(100)]
    got = sorted(r["doc_id"] for r in neardup.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [0, *range(1000, 1100)]


def test_keep_one_loses_no_link_between_unlike_neighbours(spark):
    """Versions of one text of which many candidate pairs fail the check, and pairs no mask or forest brings up."""
    rng = random.Random(3)
    rows = []
    for text in range(3):
        words = [f"t{text}w{i}" for i in range(120)]
        for _ in range(150):
            copy = list(words)
            for _ in range(rng.randint(2, 3)):
                copy[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(copy)))
    rows += planted(random.Random(12), [f"w{i}" for i in range(900)], 60)
    rows = [(k, t) for k, (_, t) in enumerate(rows)]
    want = [i for _, i in kept_by_brute_force(rows)]
    assert sorted(r["doc_id"] for r in neardup.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()) == want


def test_keep_one_finds_what_the_masks_do_not_bring_up(spark, monkeypatch):
    monkeypatch.setattr(neardup, "masks", lambda count, bits=None: [[2**64 - 1] * neardup.WORDS])
    rows = planted(random.Random(13), [f"w{i}" for i in range(900)], 60)
    got = neardup.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r["doc_id"] for r in got) == [i for _, i in kept_by_brute_force(rows)]


def test_keep_one_compares_sets_whatever_is_repeated(spark):
    """A text that is mostly one repeated phrase is no copy of another such text, but of the same set said once."""
    phrase, a, b = "one two three four five", " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(1, f"{phrase} " * 2000 + a), (2, f"{phrase} " * 2000 + b), (3, f"{phrase} " * 2 + a)]
    assert kept_by_brute_force(rows) == [(False, 1), (False, 2)]
    assert sorted(r["doc_id"] for r in neardup.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()) == [1, 2]


def test_near_copies_share_a_shingle_of_their_prefixes():
    rng = np.random.default_rng(4)
    for n in (1, 2, 4, 5, 9, 10, 57, 300):
        for _ in range(30):
            pool = np.unique(rng.integers(0, 2**63, 3 * n + 4).astype(np.uint64))
            x = np.sort(rng.permutation(pool)[:n])
            drop = rng.integers(0, n // 5 + 1)
            y = np.sort(np.concatenate([rng.permutation(x)[drop:], np.setdiff1d(pool, x)[: max(0, (n - drop) * 5 // 4 - n)]]))
            if len(np.intersect1d(x, y)) < 0.8 * len(np.union1d(x, y)):
                continue
            known = np.sort(rng.permutation(pool)[: len(pool) // 2])
            counts = rng.integers(3, 9, len(known))
            assert len(np.intersect1d(neardup.prefix(x, known, counts), neardup.prefix(y, known, counts)))


def test_bucket_counts_bound_what_two_sets_share():
    rng = np.random.default_rng(8)
    pool = rng.integers(0, 2**63, 200_000).astype(np.uint64) * np.uint64(2)
    for n, m in ((0, 5), (3, 9), (300, 330), (4000, 5000), (120_000, 150_000)):
        x, y = np.unique(rng.choice(pool, n)), np.unique(rng.choice(pool, m))
        most = neardup.most_shared(neardup.bucket_counts(x)[None], neardup.bucket_counts(y)[None])[0]
        assert len(np.intersect1d(x, y)) <= most


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_shared_shingles_give_every_pair_that_fits(size):
    """Groups of a few and of many rows, cut anywhere by batches."""
    rng = np.random.default_rng(6)
    token = np.sort(np.append(rng.integers(0, 40, 150), np.full(60, 17)))
    node = np.arange(len(token))
    root, n = node // 3, rng.integers(8, 12, len(token)).astype(np.int32)
    after = (n - 1 - rng.integers(0, 3, len(token))).astype(np.int32)
    table = pa.RecordBatch.from_arrays([pa.array(c) for c in (token, node, root, n, after)], names=["token", "node", "root", "n", "after"])
    cuts = [table.slice(k, size) for k in range(0, len(token), size)]
    got = {(a, b) for batch in neardup._share(iter(cuts)) for a, b in zip(*(c.to_pylist() for c in batch.columns))}
    least = lambda i, j: 0.8 / 1.8 * (n[i] + n[j]) - 1e-9
    want = {(i, j) for i in node.tolist() for j in range(i + 1, len(node)) if token[i] == token[j] and root[i] != root[j] and min(n[i], n[j], after[i] + 1, after[j] + 1) >= least(i, j)}
    assert got == want


def test_spanning_forest_keeps_what_any_distance_connects():
    rng = np.random.default_rng(2)
    n = 60
    i, j = np.triu_indices(n, 1)
    pick = rng.random(len(i)) < 0.1
    i, j, d = i[pick], j[pick], rng.integers(0, 20, pick.sum())
    a, b = neardup.spanning(i, j, d, n)
    by = {(x, y): z for x, y, z in zip(i.tolist(), j.tolist(), d.tolist())}
    tree = np.array([by[x, y] for x, y in zip(a.tolist(), b.tolist())])
    assert len(a) < n
    for level in range(20):
        want, got = simhash._Union(n), simhash._Union(n)
        want.join(i[d <= level], j[d <= level])
        got.join(a[tree <= level], b[tree <= level])
        assert (want.p == got.p).all()


def test_simhash_empty_table(spark):
    assert simhash.group_documents(frame(spark, []).select("doc_id", "text")).count() == 0


# --- decontamination

VOCAB = [f"word{i}" for i in range(400)]


def edit(words, k, rng):
    words = list(words)
    for _ in range(k):
        p, o = rng.randrange(len(words)), rng.random()
        if o < 0.34:
            words[p] = rng.choice(VOCAB) + "x"
        elif o < 0.67:
            del words[p]
        else:
            words.insert(p, rng.choice(VOCAB))
    return words


def plain_edits(item, words):
    d = [0] * (len(words) + 1)
    for i, w in enumerate(item, 1):
        prev, d[0] = d[0], i
        for j, x in enumerate(words, 1):
            prev, d[j] = d[j], min(prev + (w != x), d[j] + 1, d[j - 1] + 1)
    return min(d)


@pytest.mark.parametrize("sieve", [True, False])
def test_decontamination_matches_brute_force(sieve):
    rng = random.Random(1)
    items = [(i, " ".join(rng.choices(VOCAB, k=n))) for i, n in enumerate((3, 5, 6, 13, 20, 35, 57))]
    index = decontaminate.ItemIndex(items, sieve=sieve)
    texts = [None, ""]
    for k in range(0, 14):
        for _, t in items:
            texts.append(" ".join(rng.choices(VOCAB, k=20) + edit(t.split(), k, rng) + rng.choices(VOCAB, k=20)) if len(t.split()) > k else "short one")
    got = {(a, i): e for a, i, _, e in index.matches(texts)}
    want = {}
    for a, t in enumerate(texts):
        words = decontaminate.words_of(t)
        for i, item in items:
            ws = decontaminate.words_of(item)
            if len(ws) >= decontaminate.LEAST_WORDS and (e := plain_edits(ws, words)) <= decontaminate.allowed_edits(len(ws)):
                want[a, i] = e
    assert set(got) <= set(want) and all(got[k] >= want[k] for k in got)
    assert len(got) >= 0.99 * len(want)


def test_decontamination_at_the_edit_limit():
    """Items with as many edits as are allowed: buckets find nearly all, and let few unrelated windows through."""
    rng = random.Random(6)
    items = [(i, " ".join(rng.choices(VOCAB, k=rng.randint(6, 80)))) for i in range(150)]
    texts = [" ".join(rng.choices(VOCAB, k=30) + edit(t.split(), decontaminate.allowed_edits(len(t.split())), rng) + rng.choices(VOCAB, k=30)) for _, t in items]
    for sieve in (True, False):
        index = decontaminate.ItemIndex(items, sieve=sieve)
        got = {(a, i) for a, i, _, _ in index.matches(texts)}
        want = {(a, i) for a, (i, t) in enumerate(items) if plain_edits(t.split(), texts[a].split()) <= decontaminate.allowed_edits(len(t.split()))}
        assert len(got & want) >= 0.97 * len(want)
    doc, item, _ = index.candidates(*index.numbered([decontaminate.words_of(t) for t in texts]))
    apart = {(a, b) for a, b in zip(doc.tolist(), item.tolist()) if a != b}
    assert len(apart) < 0.03 * len(items) ** 2


def test_without_buckets_nothing_longer_is_found(monkeypatch):
    item = "the quick brown fox jumps over the lazy dog"
    assert decontaminate.ItemIndex([(1, item)]).matches([item])
    monkeypatch.setattr(decontaminate.LengthClass, "candidates", lambda self, words: np.zeros((2, 0), np.int64))
    assert not decontaminate.ItemIndex([(1, item)]).matches([item])


def test_decontamination_of_one_very_long_item():
    rng = random.Random(8)
    long = rng.choices(VOCAB, k=3000)
    index = decontaminate.ItemIndex([(0, " ".join(long)), *((i, f"a{i} b c d{i} e f g") for i in range(1, 2000))])
    found = {(a, i) for a, i, _, _ in index.matches(["x " + " ".join(edit(long, 200, rng)), "a7 b c d7 e f g"])}
    assert {(0, 0), (1, 7)} <= found


@pytest.mark.parametrize("kind", ["int", "string", "long"])
def test_decontamination_ids_of_any_type(spark, kind):
    text = "pack my box with five dozen liquor jugs"
    docs = spark.createDataFrame([(1, text), (None, text), (2, "x")], "item_id long, text string").selectExpr(f"cast(item_id as {kind}) as item_id", "text", "'own' as edits", "1 as text2")
    items = spark.createDataFrame([(7, text)], "item_id long, text string").selectExpr(f"cast(item_id as {kind}) as item_id", "text")
    got = decontaminate.contaminated(docs, items, id_col="item_id")
    assert got.columns == ["doc_item_id", "item_id", "item_words", "edits", "similarity"]
    assert sorted((r[0] is None, str(r[0]), str(r[1])) for r in got.collect()) == [(False, "1", "7"), (True, "None", "7")]
    assert decontaminate.drop_contaminated(docs, items).columns == docs.columns


def test_decontamination_blocks_and_stage(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 2)
    items = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog"), (2, None), (3, "pack my box with five dozen liquor jugs"), (4, ""), (5, "how vexingly quick daft zebras jump today")], "item_id long, text string")
    docs = frame(spark, ["intro The quick, brown fox jumps over the lazy dog. end", "nothing here", None, "How vexingly quick daft zebras jump today!"], text2=["a", "b", "c", "d"])
    rows = sorted((r["doc_id"], r["item_id"], r["edits"]) for r in decontaminate.contaminated(docs, items).collect())
    assert rows == [(0, 1, 0), (3, 5, 0)]
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2]
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0


def test_decontamination_of_short_unspaced_and_unnamed_items(spark):
    items = spark.createDataFrame(
        [(1, "Zanzibar"), (2, "blue whale"), (3, "one two three"), (4, "我们的问题是这个城市有多少人口"), (5, "ประเทศไทยมีกี่จังหวัด"), (None, "the quick brown fox jumps over the lazy dog"), (6, "blue whale"), (7, "a b c d")],
        "item_id long, text string",
    )
    texts = ["in zanzibar,", "Blue Whale", "whale blue", "zero one two three", "one two and three", "前文：我们的问题是，这个城市有多少人口？后文", "我们的城市", "ดูประเทศไทยมีกี่จังหวัดครับ", "So the quick brown fox jumps over the lazy dog.", "", None, "x a b c d", "blue", "whale"]
    docs = frame(spark, texts)
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, items).collect()}
    assert got == {(0, 1), (1, 2), (1, 6), (3, 3), (5, 4), (7, 5), (8, None), (11, 7)}
    assert sorted(r["doc_id"] for r in decontaminate.drop_contaminated(docs, items).collect()) == [2, 4, 6, 9, 10, 12, 13]


# --- PII

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(v if i % 2 == 0 else (v * 2 - 9 if v > 4 else v * 2) for i, v in enumerate(map(int, reversed(digits)))) % 10 == 0


def plain_spans(text):
    out, n = [], {}
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        n[kind] = 0
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")) or kind == "card" and not (14 <= len(d) <= 19 and luhn(d)) or kind == "phone" and not 10 <= len(d) <= 15:
                continue
            n[kind] += 1
            out.append((m.start(), rank, m.end(), kind))
    return n, hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out)).encode()).hexdigest()


def test_pii_base_spans_match_brute_force(spark):
    rng = random.Random(2)
    parts = ["a@b.c", "_x@y.z", "1.2.3.4", "256.1.1.1", ".", " ", "-", "+", "(0", "+1 (017) 555-7713", "4111 1111 1111 1111", "4111-1111-1111-1112", "é", "😀", "1", "22", "\n", "a", "@", "..", "+49 30 123456789"]
    texts = [None, "", "1" * 3000 + "a@" + "b" * 3000, "a" * 20000] + ["".join(rng.choices(parts, k=rng.randint(1, 14))) for _ in range(600)]
    for r in pii.find_spans(frame(spark, texts)).collect():
        n, digest = plain_spans(texts[r["doc_id"]] or "")
        assert ([r[f"n_{k}"] for k in PATTERNS], r["base_sha256"]) == (list(n.values()), digest), texts[r["doc_id"]]


def test_pii_adds_spans_and_masks(spark):
    texts = ['x token = "9b0b3c6a43eb78aa99cbd7049c572391524f37a8" y', "write to a.b@c.de now, or 4111 1111 1111 1111", "plain some-words-joined-by-hyphens-2024", None, "no 4111 1111 1111 1112 card", "ip 10.0.0.1 and page 1234567"] * 5
    df = frame(spark, texts, spans=["own"] * 30)
    model = pii.SpanModel.fit(df)
    got = {r["doc_id"]: r["spans"] for r in pii.find_spans(df, model=model).collect()}
    assert got[0] == "secret:11:51" and got[1] == "email:9:17,card:26:45" and got[2] == got[3] == got[4] == "" and got[5] == "ip:3:11"
    masked = {r["doc_id"]: (r["text"], r["spans"]) for r in pii.mask(df, model=model).collect()}
    assert masked[0] == ('x token = "[SECRET]" y', "own") and masked[1][0] == "write to [EMAIL] now, or [CARD]" and masked[3][0] is None and masked[4][0] == texts[4]
    empty = df.limit(0)
    assert pii.find_spans(empty).count() == pii.mask(empty).count() == 0


def test_masks_replace_overlapping_spans_once(spark):
    texts = ["+1 4111 1111 1111 1111 x", "a@b.co" * 7, " ".join(["a@b.co 1.2.3.4"] * 300) + "😀", "é" * 50 + " 1.2.3.4 " + "😀" * 9]
    df = frame(spark, texts)
    model = pii.SpanModel({}, {}, [])
    spans = {r["doc_id"]: r["spans"] for r in pii.find_spans(df, model=model).collect()}
    for r in pii.mask(df, model=model).collect():
        out, at = [], 0
        for span in filter(None, spans[r["doc_id"]].split(",")):
            kind, start, end = span.split(":")
            if int(start) >= at:
                out += [texts[r["doc_id"]][at : int(start)], f"[{kind.upper()}]"]
            at = max(at, int(end))
        assert r["text"] == "".join(out) + texts[r["doc_id"]][at:]


def test_pii_of_very_many_matches(spark):
    import time

    model = pii.SpanModel({}, {}, [])
    for n in (1000, 50_000):
        df = spark.createDataFrame([(1, " ".join(f"u{i}@mail.example" for i in range(n)))], "doc_id long, text string")
        began = time.time()
        assert pii.find_spans(df, model=model).first()["n_email"] == n and len(pii.mask(df, model=model).first()["text"]) == 8 * n - 1
        assert time.time() - began < 60


def test_em_learns_reliabilities():
    rng = random.Random(4)
    patterns: dict = {}
    for _ in range(4000):
        truth = rng.random() < 0.4
        votes = tuple((1 if truth == (rng.random() < p) else -1) if rng.random() < 0.8 else 0 for p in (0.95, 0.85, 0.75, 0.6))
        patterns["number", *votes] = patterns.get(("number", *votes), 0) + 1
    _, rates, shares = pii.learn_reliabilities(patterns)
    assert abs(rates[0][0] - 0.95) < 0.06 and abs(rates[0][1] - 0.05) < 0.06 and rates[3][0] < rates[0][0] and abs(shares["number"] - 0.4) < 0.05


def test_em_finds_planted_reliabilities_in_text(spark):
    """Numbers in texts, spans or not, on which gazetteer, context and shape vote as often as planted."""
    rng, texts, planted_ = random.Random(9), [], {True: [0.9, 0.8, 0.95], False: [0.1, 0.05, 0.2]}
    for _ in range(4000):
        gaz, ctx, shape = (rng.random() < p for p in planted_[rng.random() < 0.4])
        head, few = ("0049", "049") if gaz else ("7700", "70")
        digits = head + ("".join(rng.sample("123568", 6)) + "123" if shape else "".join(rng.choices(few, k=9)))
        texts.append(f"so {'call' if ctx else 'then'} {digits} it is")
    _, gazetteer, context, shape = pii.SpanModel.fit(frame(spark, texts)).reliabilities
    for got, yes, no in zip((gazetteer, context, shape), planted_[True], planted_[False]):
        assert abs(got[0] - yes) < 0.07 and abs(got[1] - no) < 0.07


# --- language id


def test_language_id_held_out_accuracy_and_edges(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == docs.count() and held
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)
    odd = docs.selectExpr("doc_id", "text", "lang").limit(60).unionByName(spark.createDataFrame([(10_000_001, None, None), (10_000_002, "12 .. 34", "en"), (None, "the thing is that", None)], "doc_id long, text string, lang string"))
    got = {r["doc_id"]: r for r in langid.identify(odd).collect()}
    assert got[10_000_001]["lang_pred"] == got[10_000_002]["lang_pred"] == "und" and got[10_000_002]["rejected"] and got[None]["lang_pred"] != "und"
    kept = langid.keep_identified(odd)
    assert kept.columns == odd.columns and not {10_000_001, 10_000_002} & {r["doc_id"] for r in kept.collect()}


def test_language_id_rejects_a_third_of_rows_and_a_single_long_one(spark):
    """Rows of a language nobody labels don't move the limits, whatever their share; a rare length has its language's limit."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where("lang is not null and n_chars between 100 and 4000").select("doc_id", "text", "lang")
    n = docs.count()
    rng = random.Random(3)
    words = ["".join(rng.choices("qxzjwkvyh", k=rng.randint(3, 9))) for _ in range(300)]
    foreign = [(2_000_000 + i, " ".join(rng.choices(words, k=rng.randint(30, 300))), None) for i in range(n // 2)]
    foreign.append((3_000_000, " ".join(rng.choices(words, k=60_000)), None))
    got = {r["doc_id"]: r["rejected"] for r in langid.identify(docs.unionByName(spark.createDataFrame(foreign, "doc_id long, text string, lang string"))).collect()}
    assert got[3_000_000] and all(got[i] for i, _, _ in foreign)
    assert sum(v for k, v in got.items() if k < 2_000_000) <= 0.02 * n


def test_language_stage_leaves_columns_of_result_names_alone(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").selectExpr("doc_id", "text", "lang", "'mine' as score", "doc_id as rejected", "'own' as lang_pred", "1 as xent", "2 as margin", "3 as n_letters", "4 as `a b`")
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert len(rows) > 100 and all((r["score"], r["rejected"], r["lang_pred"], r["xent"], r["margin"], r["n_letters"]) == ("mine", r["doc_id"], "own", 1, 2, 3) for r in rows)
    assert langid.keep_identified(docs.limit(0)).count() == 0


def test_language_counts_do_not_depend_on_the_order_of_rows(monkeypatch):
    """n-grams that share a slot are told apart by rule, not by which word came last."""
    monkeypatch.setattr(langid, "HASH_BITS", 8)
    rng = random.Random(4)
    texts = [" ".join("".join(rng.choices("abcdefghij", k=rng.randint(1, 7))) for _ in range(30)) for _ in range(300)]

    def counted(rows):
        found = langid._count_batches(iter([pa.RecordBatch.from_arrays([pa.array(rows), pa.array(["en"] * len(rows))], names=["text", "lang"])]))
        return sorted(tuple(r.values()) for b in found for r in b.to_pylist())

    whole = counted(texts)
    assert counted(texts[::-1]) == whole
    monkeypatch.setattr(langid, "WORDS_KEPT", 500)
    assert counted(texts) == whole


def test_language_workers_stay_small_whatever_the_words(spark, tmp_path):
    """Two workers share an executor with Spark's heap: neither counting nor scoring may hold a batch's words at once."""
    import tracemalloc

    rng = random.Random(6)
    texts = [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=10)) for _ in range(100)) for _ in range(4000)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(["en"] * len(texts))], names=["text", "lang"])
    model = langid.LanguageIdentifier.fit(spark.createDataFrame([("a plain text", "en")], "text string, lang string"))
    scorer = langid._Scorer(model.uri)
    tracemalloc.start()
    try:
        for _ in langid._count_batches(iter([batch])):
            pass
        counting = tracemalloc.get_traced_memory()[1]
        tracemalloc.reset_peak()
        for part in langid._pieces([batch], 0):
            scorer.documents(part.column(0).to_pylist())
        scoring = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert counting < 150e6 and scoring < 60e6, (counting, scoring)


def test_language_pieces_are_whole_and_bounded():
    texts = ["x" * n for n in (0, 400_000, 200_000, 1_200_000, 5)] + [None] * 600
    found = [b.column(0).to_pylist() for b in langid._pieces([pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])], 0)]
    assert [t for part in found for t in part] == texts
    assert all(len(part) == 1 or len(part) <= langid.ROWS_AT_ONCE and sum(len(t or "") for t in part) <= langid.BYTES_AT_ONCE for part in found)


def test_language_id_without_anything_to_learn(spark):
    df = spark.createDataFrame([(1, "text", None), (2, None, "en")], "doc_id long, text string, lang string")
    assert [r["lang_pred"] for r in langid.identify(df).collect()] == ["und", "und"]


# --- quality


def plain_kneser_ney(counts, wanted):
    """Interpolated modified Kneser-Ney by dictionaries."""
    tables = {quality.ORDER: dict(counts)}
    for k in range(quality.ORDER - 1, 0, -1):
        tables[k] = {}
        for g in tables[k + 1]:
            tables[k][g[1:]] = tables[k].get(g[1:], 0) + 1
    disc = {}
    for k, t in tables.items():
        n = [sum(v == i for v in t.values()) for i in (1, 2, 3, 4)]
        disc[k] = quality.discounts(*n)

    def p(g):
        k = len(g)
        below = 1 / quality.ALPHABET if k == 1 else p(g[1:])
        same = {x: v for x, v in tables[k].items() if x[:-1] == g[:-1]}
        if not same:
            return below
        total, off = sum(same.values()), lambda v: disc[k][min(v, 3) - 1]
        own = (same[g] - off(same[g])) / total if g in same else 0.0
        return own + sum(map(off, same.values())) / total * below

    return {g: p(g) for g in wanted}


def test_kneser_ney_joins_match_dictionaries(spark):
    words = {"the": 9, "then": 3, "than": 2, "hat": 4, "that": 6, "tea": 1, "eat": 2, "ten": 1}
    counts: dict = {}
    for w, n in words.items():
        for g in quality.grams(w):
            counts[g] = counts.get(g, 0) + n
    wanted = sorted({g for w in ("the", "thing", "hate", "zzz") for g in quality.grams(w)})
    model = quality.KneserNey.from_counts(spark.createDataFrame(list(counts.items()), "gram string, n long"))
    got = {r["gram"]: r["p"] for r in model.probabilities(spark.createDataFrame([(g,) for g in wanted], "gram string")).collect()}
    want = plain_kneser_ney(counts, wanted)
    assert got.keys() == want.keys() and all(abs(got[g] - want[g]) < 1e-12 for g in want)


def test_quality_parts_junk_from_trusted_text(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    docs = docs.unionByName(spark.createDataFrame([(10**9, None, "en", "s", 0), (10**9 + 1, "  ", None, "s", 2)], docs.schema))
    rows = {r["doc_id"]: r for r in quality.decide(quality.score(docs, labels)).collect()}
    assert len(rows) == docs.count() and not rows[10**9]["keep"] and rows[10**9]["perplexity"] is None
    good = [rows[r["doc_id"]]["keep"] for r in labels.where("quality = 1").collect()]
    bad = [rows[r["doc_id"]]["keep"] for r in labels.where("quality = 0").collect()]
    assert sum(good) > 0.97 * len(good) and (not bad or sum(bad) < 0.6 * len(bad))


@pytest.mark.parametrize("n,want", [(4, 0), (5, 0), (6, 1), (35, 7)])
def test_allowed_edits(n, want):
    assert decontaminate.allowed_edits(n) == want
