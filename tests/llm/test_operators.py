"""The operators against brute force on small tables: ordinary rows, nulls, empty and long texts, ties, repeats, no rows."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import bpe, extraction, licenses, minhash, packing, pii, quality, sharding, topk, vectors
from tidemark.llm.common import prepare, read
from tidemark.llm.components import components
from tidemark.llm.queries import QUERIES

PATH = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, id string, h int, row string, size string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    """Odd documents, with columns named like the operators' own."""
    prepare(spark)
    base = " ".join(f"word{i}" for i in range(60))
    rows = [
        (1, base), (2, base), (3, base.replace("word7 ", "other ")), (4, None), (5, ""), (6, " \t\n"), (7, "two words"),
        (8, "TWO  words"), (9, "a " * 3000 + "b"), (9, "a " * 3000 + "b"), (None, base), (10, "x" * 200_000), (11, " " * 150_000 + "é"),
        (12, "mail jo.doe@mail.example.com, +1 (216) 555-1810 and 4012888888881881, 10.0.0.1"),
    ]
    return spark.createDataFrame([(i, t, "x", 1, "y", "z", 0) for i, t in rows], SCHEMA)


def _empty(spark, docs):
    return spark.createDataFrame([], docs.schema)


def _shingles(text, width=4):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if len(words) < width:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def _components(rows, linked):
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if linked(rows[i], rows[j]):
                parent[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    return [min((x for x in groups[find(i)] if x is not None), default=None) for i in range(len(rows))]


@pytest.mark.parametrize("which", ["odd", "table"])
def test_minhash_forest(spark, docs, which):
    docs = docs if which == "odd" else read(spark, PATH, "documents")
    rows = [(r.doc_id, r.text, _shingles(r.text)) for r in docs.collect()]

    def linked(a, b):
        both = len(a[2] & b[2])
        return both > 0 and 100 * both >= 80 * (len(a[2]) + len(b[2]) - both)

    expected = Counter(
        (i, len(s), c, i is not None and i == c) for (i, _, s), c in zip(rows, _components(rows, linked), strict=True)
    )
    assert Counter(map(tuple, minhash.near_duplicates(docs).collect())) == expected


def test_minhash_large_group(spark, monkeypatch):
    """Regions beyond a block and beyond the limit of a level give the same links."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(60):
        own = list(words)
        for at in rng.integers(0, 300, int(rng.integers(0, 9))):
            own[at] = f"x{i}"
        rows.append((i, " ".join(own)))
    docs = prepare(spark).createDataFrame(rows, "doc_id long, text string")
    sets = [(i, t, _shingles(t)) for i, t in rows]
    expected = _components(sets, lambda a, b: 100 * len(a[2] & b[2]) >= 80 * len(a[2] | b[2]))
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()}
    assert [got[i] for i in range(60)] == expected


def test_minhash_links_into_a_large_group(spark, monkeypatch):
    """Documents whose only links, at 0.8, lead into a group beyond the limit of a level are found as in a small one."""
    monkeypatch.setattr(minhash, "BLOCK", 16)
    monkeypatch.setattr(minhash, "REGION", 16)
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join([*words, f"y{i}"])) for i in range(40)]
    for i in range(40, 240):
        own = list(words)
        for at in 8 + 36 * np.arange(8) + rng.integers(0, 30, 8):
            own[at] = f"x{i}"
        rows.append((i, " ".join(own)))
    docs = prepare(spark).createDataFrame(rows, "doc_id long, text string")
    assert {r.component_id for r in minhash.near_duplicates(docs).collect()} == {0}


def test_one_row_of_each_component(spark):
    """Rows with null ids, repeated rows, and one id with several texts."""
    import corpus_pipeline

    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    rows = [(None, a, "p"), (None, a, "q"), (1, b, "p"), (1, b, "p"), (2, c, "p"), (0, c, "p"), (2, d, "p"), (None, b, "p")]
    rows += [(0, f"{b} more", "p"), (5, None, "p"), (6, " ", "p"), (6, " ", "p"), (None, "alone", "p")]
    docs = prepare(spark).createDataFrame(rows, "doc_id long, text string, row string")
    kept = Counter((r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, PATH).collect())
    assert kept == Counter({(None, a): 1, (0, f"{b} more"): 1, (0, c): 1, (2, d): 1, (5, None): 1, (6, " "): 2, (None, "alone"): 1})


def test_byte_bpe(spark, docs):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    enc = bpe.encoding(path, public_tokenizers.PATTERN)
    for r in bpe.encode_decode(docs, path, public_tokenizers.PATTERN).collect():
        assert bytes(r.decoded).decode() in {x.text or "" for x in docs.where(F.col("doc_id").eqNullSafe(r.doc_id)).collect()}
    for text in ("a b1.c's  d\n\n é", "ab1 " * 900, " " * 3000 + "x", "日本語 テスト!" * 100):
        assert bpe.encode(enc, text, 64).tolist() == enc.encode_ordinary(text)
    assert isinstance(enc, tiktoken.Encoding)


def test_packing(spark, docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    fast = {"ranks": public_tokenizers.path("byte_bpe_50k.tiktoken"), "pattern": public_tokenizers.PATTERN}
    for table, extra in ((docs.where("doc_id <> 10"), {}), (read(spark, PATH, "documents"), fast)):
        pieces = packing.pack(table, path, **extra).collect()
        used = Counter()
        for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
            assert p.offset == used[p.sequence_id]
            used[p.sequence_id] += p.length
        assert max(used.values()) <= 1024
        padding = sum(0 if n & (n - 1) == 0 else 1024 - n for n in used.values())
        assert padding <= 0.001 * sum(used.values())
        whole = Counter()
        for r in table.collect():
            ids = np.array([*tok.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
            for p in {p for p in pieces if p.doc_id == r.doc_id and p.doc_tokens == len(ids)}:
                assert zlib.crc32(ids[p.start : p.start + p.length].tobytes()) == p.ids_crc32
            whole[r.doc_id] += len(ids)
        got = Counter()
        for p in pieces:
            got[p.doc_id] += p.length
        assert got == whole
    assert packing.tokenize("a<|endoftext|>b", path, *fast.values()).tolist() == [64, 50256, 65]


def test_cutting_stock_bound():
    counts = {700: 90, 324: 50, 200: 120, 100: 33}
    plan = packing.cutting_stock(counts, 1024)
    made = Counter()
    for pattern, amount in plan:
        assert sum(x * n for x, n in pattern.items()) <= 1024
        for x, n in pattern.items():
            made[x] += n * amount
    assert all(math.isclose(made[x], n, abs_tol=1e-6) for x, n in counts.items())
    # 90 sequences hold the 700s; beside them fit all of 324 and 40 of 200; the other 80 of 200 fill 16
    assert math.isclose(sum(a for _, a in plan), 106, rel_tol=0.002)


def test_sharding(spark, docs):
    for table in (docs, read(spark, PATH, "documents")):
        rows = sharding.shard_by_bytes(table, shards=5).collect()
        sizes = Counter((r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in table.collect())
        assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == sizes
        for s in {r.shard for r in rows}:
            assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
        load, top = Counter(), max(r.size for r in rows)
        for r in rows:
            load[r.shard] += r.size
        assert max(load.values()) <= sum(load.values()) / 5 + top + 1


def test_licenses(spark, docs):
    notice = licenses.TEMPLATES["gpl-3.0"]
    known = licenses.Templates.of(licenses.TEMPLATES)
    assert licenses.matches(f"Text before. {notice} Text after.", known, 0.8) == {"gpl-3.0": 1.0}
    assert licenses.matches(notice.replace("version 3", "release nine"), known, 0.8) == {}
    expected = {}
    rows = read(spark, PATH, "documents").collect()
    for r in rows:
        words = licenses.words_of(r.text or "")
        own = {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
        names = []
        for name, text in licenses.TEMPLATES.items():
            w = licenses.words_of(text)
            mine = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}
            if len(mine & own) >= 0.8 * len(mine):
                names.append(name)
        expected[r.doc_id] = sorted(names)
    got = {r.doc_id: r.licenses for r in licenses.scan(read(spark, PATH, "documents")).collect()}
    assert got == expected and any(got.values())
    assert licenses.scan(docs).count() == docs.count()


def test_personal_data(spark, docs):
    found = {r.doc_id: r for r in pii.find(docs).collect()}
    text = docs.where("doc_id = 12").first().text
    spans = [(s["kind"], text[s["start"] : s["end"]]) for s in found[12]["base"]]
    assert spans == [
        ("email", "jo.doe@mail.example.com"), ("ip", "10.0.0.1"), ("card", "4012888888881881"), ("phone", "+1 (216) 555-1810"),
    ]
    assert found[4]["base"] == [] and found[1]["spans"] == []
    clean = {r.doc_id: r for r in pii.redact(docs).collect()}
    assert clean[12].text == "mail [EMAIL], [PHONE] and [CARD], [IP]" and clean[12].n_chars == len(clean[12].text)
    assert clean[4].text is None and clean[1].text == docs.where("doc_id = 1").first().text


def test_field_carries_labels_to_repeats():
    field = pii.Field(np.zeros((pii.WIDTH, 5)), np.zeros((5, 5)), 5.0 * np.eye(5))
    text = "card 4012888888881881 then 99-4012888888881881 end 77"
    base = pii.base_spans(text)
    assert base["card"] == [(5, 21)]
    assert [text[s:e] for s, e in pii.added_spans(text, base, field)["card"]] == ["99-4012888888881881"]


def test_field_is_fitted_on_whole_distinct_texts(spark):
    """Personal data beyond any cut counts, and copies of a text count once."""
    plain = [f"{'nothing here ' * 6000} 7 mail jo{i}.doe@mail{i}.example.com, bo{i}@x{i}.org or 10.0.{i}.1" for i in range(6)]
    docs = prepare(spark).createDataFrame([(t,) for t in [*plain, None, "", "no data"]], "text string")
    field = pii.fit(docs)
    token = field.unary[pii._features("al.poe@mail9.example.net")].sum(axis=0)
    assert token.argmax() == 1
    copies = spark.range(3000).selectExpr("'room 12 of 40' AS text")
    once, often = (pii.fit(docs.union(x)) for x in (copies.limit(1), copies))
    assert np.allclose(once.unary, often.unary) and np.allclose(once.chain, often.chain) and np.allclose(once.skip, often.skip)


def test_quality(spark, docs):
    table, labels = read(spark, PATH, "documents"), read(spark, PATH, "labels")
    chosen = quality.select(table, labels)
    kept = {r.doc_id for r in chosen.collect()}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    good = [i in kept for i in truth if truth[i] == 1]
    bad = [i in kept for i in truth if truth[i] == 0]
    assert chosen.columns == table.columns and sum(good) >= 0.97 * len(good) and sum(bad) <= 0.1 * len(bad)
    assert quality.select(table.limit(0), labels).count() == 0
    none = spark.createDataFrame([], labels.schema)
    assert {r.doc_id for r in quality.select(docs, none).collect()} == {r.doc_id for r in docs.collect()} - {4, 5, 6}


def test_resampling(spark, docs):
    """Share, junk, odd rows and names: what is drawn is the k highest keys."""
    table, labels = read(spark, PATH, "documents"), read(spark, PATH, "labels")
    rows = quality.resample(table, labels, share=0.5).collect()
    keys = sorted((r.draw_key for r in rows if r.log_weight > -math.inf), reverse=True)
    assert {r.doc_id for r in rows if r.kept} == {r.doc_id for r in rows if r.draw_key >= keys[len(keys) // 2 - 1]}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    drawn = [truth[r.doc_id] for r in rows if r.kept and r.doc_id in truth]
    assert sum(1 - x for x in drawn) <= 0.02 * len(drawn)
    by_weight = sorted((r for r in rows if r.log_weight > -math.inf), key=lambda r: -r.log_weight)
    assert not all(r.kept for r in by_weight[: len(keys) // 2])  # the noise decides too
    odd = quality.resample(docs, spark.createDataFrame([], labels.schema), share=1.0).collect()
    assert {r.doc_id for r in odd if not r.kept} == {4, 5, 6} and len(odd) == docs.count()
    assert quality.resample(_empty(spark, docs), labels).count() == 0
    assert not [r for r in quality.resample(docs, labels, share=0.0).collect() if r.kept]


def test_draw_follows_the_weights(spark):
    """How often a row is drawn over several seeds is as in a plain simulation of the sampling."""
    weights = np.repeat([2.0, 1.0, 0.0, -1.0, -9.0], 80)
    weighed = prepare(spark).createDataFrame([(i, str(i), float(w)) for i, w in enumerate(weights)], "doc_id long, text string, log_weight double")
    seen, seeds = np.zeros(len(weights)), 12
    for seed in range(seeds):
        kept = [r.doc_id for r in quality.draw(weighed, 0.4, seed).where("kept").collect()]
        assert len(kept) == 160
        seen[kept] += 1
    rng, plain = np.random.default_rng(3), np.zeros(len(weights))
    for _ in range(300):
        share = np.exp(weights) / np.exp(weights).sum()
        plain[rng.choice(len(weights), 160, replace=False, p=share)] += 1
    ours, theirs = (x.reshape(5, 80).mean(axis=1) / n for x, n in ((seen, seeds), (plain, 300)))
    assert np.abs(ours - theirs).max() < 0.06 and ours[4] < 0.01


def test_main_text(spark):
    page = (
        "<html><head><title>t</title><style>p{}</style><script>var x='</p><article>no</article>';</script></head><body>"
        "<nav><ul><li><a href='/a'>menu</a></ul></nav><div class='ad'>buy</div><article><h1>A &amp; B</h1>"
        "<p><b>one\n two<br>three<p>four <i>five</i></p><div class='comments'>nice!</div></article><footer>f</footer>"
    )
    other = "<body><p>shared words that every page of this host has at its top</p><p>only here stands the text number {}</p>"
    rows = [(1, "http://h.org/1", page), (2, "http://h.org/2", None), (3, "http://h.org/3", ""), (None, None, page), (1, "http://h.org/1", page)]
    rows += [(i, f"http://g.org/{i}", other.format("one two three".split()[i - 10])) for i in (10, 11, 12)]
    pages = prepare(spark).createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, row string")
    got = Counter((r.page_id, r.text) for r in extraction.main_text(pages).collect())
    article = "A & B\none two three\nfour five"
    assert got[(1, article)] == 2 and got[(None, article)] == 1 and got[(2, "")] == 1 and got[(3, "")] == 1
    assert got[(10, "one")] == 1 and got[(12, "three")] == 1
    assert extraction.main_text(pages.limit(0)).count() == 0


def test_main_text_of_copies_under_several_urls(spark):
    """Equal and nearly equal html keeps its text; short paragraphs that pages share stay; common menus go."""
    own = [" ".join(f"{x}{i}" for i in range(40)) for x in "abcd"]
    page = f"<body><p>{own[0]}</p><p>Yes.</p><p>{own[1]}</p>"
    rows = [(1, "http://e.org/p", page), (2, "http://e.org/p?utm_source=x", page), (3, "http://e.org/p#top", page)]
    rows += [(i, f"http://n.org/{i}", f"<body><p>{own[2]} {own[3]} only{i}</p>") for i in (4, 5, 6)]
    menu = "".join(f"<div>entry{i}</div>" for i in range(14))
    rows += [(i, f"http://m.org/{i}", f"<body>{menu}<p>{own[i - 7]}</p><p>Yes.</p><p>end of {i}</p>") for i in (7, 8, 9)]
    pages = prepare(spark).createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in extraction.main_text(pages).collect()}
    assert {got[i] for i in (1, 2, 3)} == {f"{own[0]}\nYes.\n{own[1]}"}
    assert all(got[i] == f"{own[2]} {own[3]} only{i}" for i in (4, 5, 6))
    assert all(got[i] == f"{own[i - 7]}\nYes.\nend of {i}" for i in (7, 8, 9))


def test_main_text_by_suffix_array(spark, monkeypatch):
    """The array holds every suffix outside articles in order; what its neighbours share is what all pairs share."""
    monkeypatch.setattr(extraction, "OUT_ROWS", 7)
    rng, depth = random.Random(5), extraction.DEPTH
    runs = [[rng.choice("a b c é z".split()) + str(rng.randrange(9)) for _ in range(n)] for n in (11, 12, 13, 30)]
    bodies = []
    for i in range(24):
        parts = [rng.choice(runs) if rng.random() < 0.6 else [f"own{i}x{j}" for j in range(rng.randrange(3, 9))] for _ in range(6)]
        bodies.append([w for p in parts for w in p])
    pages = [(i, f"http://h{i % 2}.org/{i}", f"<body><p>{' '.join(b)}</p>" + ("<article>own</article>" if i % 5 == 0 else "")) for i, b in enumerate(bodies)]
    pages += [(99, pages[1][1], pages[1][2]), (100, "http://all.org/", f"<nav>{' '.join(bodies[0])}</nav><article>own</article>")]
    frame = prepare(spark).createDataFrame(pages, "page_id long, url string, html string")

    keyed = frame.selectExpr("page_id AS content", "regexp_extract(url, '//([^/]*)', 1) AS host", "html")
    ranges = [[(r.host, r.suffix) for r in part] for part in extraction.suffix_array(extraction._suffixes(keyed)).rdd.glom().collect()]
    held = {i: bodies[i] for i in range(24)} | {99: bodies[1], 100: bodies[0]}
    hosts = {r[0]: r[1].split("/")[2] for r in pages}
    windows = {i: [" ".join(w[k : k + depth]) for k in range(len(w) - depth + 1)] for i, w in held.items()}
    expected = sorted(((hosts[i], x) for i, xs in windows.items() for x in xs), key=lambda r: (r[0].encode(), r[1].encode()))
    assert [r for part in ranges for r in part] == expected

    contents = {(hosts[i], x): {j for j in windows if j != 99 and hosts[j] == hosts[i] and x in windows[j]} for i in windows for x in windows[i]}
    for r in extraction.main_text(frame).collect():
        i = r.page_id
        gone = {k + d for k, x in enumerate(windows[i]) if len(contents[hosts[i], x]) >= extraction.CONTENTS for d in range(depth)}
        left = [w for k, w in enumerate(held[i]) if k not in gone]
        whole = len(gone) > extraction.NEARLY * len(held[i])
        assert r.text == ("own" if i == 100 or i < 24 and i % 5 == 0 else " ".join(held[i] if whole else left))


def _vectors(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(40, 8))
    rows = [(i, [float(x) for x in v.astype(np.float32)]) for i, v in enumerate([*base, *(base[:15] + 0.05 * rng.normal(size=(15, 8)))])]
    rows += [(60, rows[0][1]), (61, rows[0][1]), (62, None), (63, [0.0] * 8), (64, [1.0, None]), (65, [float("nan")] * 8), (None, rows[1][1]), (66, [1.0]), (67, [])]
    return prepare(spark).createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, key string"), rows


def _fine(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def test_top_k(spark):
    table, rows = _vectors(spark)
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and _fine(v)]
    expected = []
    for q, v in whole:
        if q % 10 == 0:
            best = sorted(((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in whole if i != q and len(w) == len(v)))[:10]
            expected += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    assert sorted(map(tuple, topk.exact_top_k(table, "id % 10 = 0").collect())) == sorted(expected)
    assert topk.exact_top_k(table.limit(0), "id % 10 = 0").count() == 0


def test_near_vectors(spark):
    table, rows = _vectors(spark)

    def linked(a, b):
        if not (_fine(a[1]) and _fine(b[1]) and len(a[1]) == len(b[1]) and any(a[1]) and any(b[1])):
            return False
        x, y = np.array(a[1]), np.array(b[1])
        return x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.95

    found = Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in vectors.near_vectors(table).collect())
    links = [sum(linked(a, b) for j, b in enumerate(rows) if i != j) for i, a in enumerate(rows)]
    groups = _components(rows, linked)
    expected = Counter((i, n, c, i is not None and i == c) for (i, _), n, c in zip(rows, links, groups, strict=True))
    missed = sum((expected - found).values())
    assert sum(links) > 20 and missed <= 0.1 * len(rows) and all(n <= max(links) for _, n, _, _ in found)


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 140)] + [(5, 5), (200, 201), (200, 201)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(31), 0), **dict.fromkeys(range(100, 140), 100), 200: 200, 201: 200}


def test_empty_tables(spark, docs):
    none = _empty(spark, docs)
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert minhash.near_duplicates(none).count() == 0
    assert packing.pack(none, path).count() == 0
    assert sharding.shard_by_bytes(none).count() == 0
    assert pii.find(none).count() == 0
    assert licenses.scan(none).count() == 0


def test_digest_columns(spark):
    enc = bpe.encoding(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    texts = {r.doc_id: r.text or "" for r in read(spark, PATH, "documents").collect()}
    for r in QUERIES["op4_byte_bpe"](spark, PATH).collect():
        ids = enc.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_pipeline(spark):
    import corpus_pipeline

    docs = read(spark, PATH, "documents")
    rows = corpus_pipeline.run(spark, PATH).collect()
    truth = {r.doc_id: r.quality for r in read(spark, PATH, "labels").collect()}
    out = {r.doc_id for r in rows}
    assert not [i for i in out if truth.get(i) == 0][3:] and len(out) <= docs.count()
    kept = corpus_pipeline.near_duplicates(spark, docs, PATH)
    assert kept.columns == docs.columns and kept.count() < docs.count()


def test_top_k_of_very_large_components(spark):
    """Components whose products leave 64 bits: ranked exactly up to 2**61, equal beyond."""
    prepare(spark)
    vectors = [
        [1e18, 1.0], [1e30, -1e30], [-1e18, 2.0], [1e6, 1e6], [3e6, -1e6], [1e15, 0.5], [1e308, 1e308], [0.0, 0.0], [1e6, 999999.0],
        [-1e308, 1e3], [2e4, 2e4], [1.5e5, -7.0],
    ]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    edge, most = 1 << 62, 1 << 61
    whole = [[min(max(math.floor(max(min(1024.0 * x, float(edge)), -float(edge))), -edge), edge) for x in v] for v in vectors]
    expected = set()
    for q in range(0, 12, 2):
        scores = [(-min(max(sum(a * b for a, b in zip(whole[q], v, strict=True)), -most), most), i) for i, v in enumerate(whole) if i != q]
        expected |= {(q, rank + 1, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:4])}
    got = topk.exact_top_k(rows, "id % 2 = 0", k=4)
    assert {tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()} == expected


def test_tokens_with_a_sign_are_found_in_one_pass():
    import random
    import time

    draw = random.Random(8)
    for _ in range(3000):
        text = "".join(draw.choice("ab1@ \n\u00a0é") for _ in range(draw.randint(0, 30)))
        assert [m.span() for m in pii._TOKEN.finditer(text)] == [m.span() for m in re.finditer(r"\S*[0-9@]\S*", text)]
    start = time.perf_counter()
    assert len(list(pii._TOKEN.finditer("x" * 200_000 + " 1"))) == 1
    assert time.perf_counter() - start < 2


def _main(page):
    found = extraction.blocks(page)
    return [text for place, text in found if place == (2 if any(p == 2 for p, _ in found) else 1)]


@pytest.mark.parametrize("page, text", [
    ("<html><head><title>t</title><body><article><p>a</p></article>", ["a"]),
    ("<html><head><title>t</title><article><p>a</article>", ["a"]),
    ("<head><title>t</title><b>a</b> b<p>c", ["a b", "c"]),
    ("<article><p class='notice'>x<p>real</p></article>", ["real"]),
    ("<article><p class=ad>x<div>real</div>", ["real"]),
    ("<article><ul><li class=promo>x<li>real<ul><li>inner</ul><li>last</ul>", ["real", "inner", "last"]),
    ("<article><dl><dt>a<dd class='ad'>x<dt>b<dd>c</dl>", ["a", "b", "c"]),
    ("<article><table><tr><td class=ad>x<td>a<tr class=ad><td>x<tr><td>b<table><tr><td>c</table></table>", ["a", "b", "c"]),
    ("<article><a href=x\">a</a> <a title='1 > 2'>b</a> <i data-x = \"<p>\">c</i></article>", ["a b c"]),
    ("<article>1 < 2 and a<b>c</b></article>", ["1 < 2 and ac"]),
    ("<article>a</article><footer>x</article></footer><scripted>b</scripted>", ["a"]),
])
def test_blocks_of_markup_with_tags_left_out(page, text):
    assert _main(page) == text


@pytest.mark.parametrize("page", [
    "<a " * 50_000, "<!" * 50_000, "<a x=\"" * 50_000, "<a x='" * 50_000 + "y", "<script>" * 50_000, "</b>" * 20_000 + "<div>" * 20_000,
    "<div>" * 20_000 + "<b>x</b>" * 20_000, "<div>" * 20_000 + "</p>" * 20_000, "<ul><li>" * 10_000 + "<p>x" * 20_000, "<p class=ad>x" * 20_000,
])
def test_long_markup_takes_linear_time(page):
    begun = time.monotonic()
    extraction.blocks(page)
    assert time.monotonic() - begun < 2
