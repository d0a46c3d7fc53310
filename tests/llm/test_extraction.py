"""Repeats in articles: the suffix arrays of pieces and of the host against a search of all pairs."""

import random

import pytest

from tidemark.llm import extraction
from tidemark.llm.common import prepare

DEPTH, CONTENTS, NEARLY = extraction.DEPTH, extraction.CONTENTS, extraction.NEARLY


def _expected(pages):
    """The text of every page with an article, by comparing all runs of words of all contents of its host."""
    held = {}
    for _, url, page in pages:
        found = [text for place, text in extraction.blocks(page or "") if place == 2]
        words = [w for text in found for w in text.split()]
        if found:
            held.setdefault(url.split("/")[2], {})[page] = (found, words, [tuple(words[i : i + DEPTH]) for i in range(len(words) - DEPTH + 1)])
    texts = {}
    for i, url, page in pages:
        others = held.get(url.split("/")[2], {})
        if page not in others:
            continue
        found, words, runs = others[page]
        stands = {r: sum(r in x[2] for x in others.values()) for r in set(runs)}
        gone = {k + d for k, r in enumerate(runs) if stands[r] >= CONTENTS and 2 * stands[r] > len(others) for d in range(DEPTH)}
        at, cut = 0, set()
        for text in found:  # a block goes whole, or a span of it that is long enough
            span = set(range(at, at + len(text.split())))
            for k in span & gone:
                first, end = (next(x for x in range(k, at - 2 if step < 0 else max(span) + 2, step) if x not in span & gone) for step in (-1, 1))
                if span <= gone or end - first - 1 >= DEPTH:
                    cut.add(k)
            at += len(span)
        if len(cut) > NEARLY * len(words):
            cut = set()
        at, kept = 0, []
        for text in found:
            kept.append(" ".join(w for k, w in enumerate(text.split(), at) if k not in cut))
            at += len(text.split())
        texts.setdefault(i, set()).add("\n".join(x for x in kept if x))
    return texts


@pytest.mark.parametrize("piece, piece_pages", [(4 << 20, 8), (2000, 3), (1, 1)])
def test_repeats_in_articles(spark, monkeypatch, piece, piece_pages):
    """Runs on most contents with an article go, whole, one or few contents a piece; others stay."""
    monkeypatch.setattr(extraction, "PIECE", piece)
    monkeypatch.setattr(extraction, "PIECE_PAGES", piece_pages)
    rng, pages = random.Random(11), []
    for host, count in enumerate((40, 9, 4, 3, 2, 1)):
        runs = [([f"r{host}{k}w{rng.randrange(5)}é" for _ in range(n)], share) for k, (n, share) in enumerate([(11, 0.9), (12, 0.8), (13, 0.55), (30, 0.45), (20, 0.2)])]
        for i in range(count):
            parts = [run for run, share in runs if rng.random() < share] + [[f"own{host}x{i}x{j}x{k}" for k in range(rng.randrange(1, 20))] for j in range(3)]
            rng.shuffle(parts)
            tag = "main" if i % 4 == 1 else "article"
            body = "".join(f"<p>{' '.join(p)}</p>" if rng.random() < 0.7 else " ".join(p) + " " for p in parts)
            pages.append((len(pages), f"http://h{host}.org/{i}", f"<nav>{' '.join(runs[4][0])}</nav><{tag}>{body}</{tag}><footer>f{i}</footer>"))
    pages += [(1000 + i, f"{url}?copy", page) for i, url, page in pages if i % 3 == 0]
    pages += [(2000, "http://h0.org/", None), (2001, "http://h1.org/", "<p>open"), (2002, "http://h1.org/", "<article></article>"), (5, pages[7][1], pages[7][2])]
    got = {}
    for r in extraction.main_text(prepare(spark).createDataFrame(pages, "page_id long, url string, html string")).collect():
        got.setdefault(r.page_id, set()).add(r.text)
    expected = _expected(pages)
    assert {i: x for i, x in got.items() if i in expected} == expected
    assert (got[2000], got[2001], got[2002]) == ({""}, {"open"}, {""})


def test_notices_quotations_and_copies_in_articles(spark):
    notice = "Sign up here to get the news of our town by mail each day"
    quoted = "In the beginning there were words and all the others came to quote them"
    rows = [(i, f"http://n.org/{i}", f"<article><h1>Title {i}</h1><p>own{i} text</p><p>{notice}</p><p>end{i}</p></article>") for i in range(5)]
    rows += [(i, f"http://q.org/{i}", f"<article><p>own{i} text</p>{f'<p>{quoted}</p>' if i < 14 else ''}</article>") for i in range(10, 18)]
    rows += [(i, f"http://q.org/copy{i}", rows[5][2]) for i in range(18, 25)]  # one content, however often
    rows += [(i, f"http://c.org/{i}", f"<article><p>{notice} {quoted} {notice}</p><p>only{i}</p></article>") for i in range(30, 34)]
    rows += [(i, f"http://p.org/{i}", f"<article><p>own{i} text</p><p>{notice}</p></article>") for i in (40, 41)]
    rows += [(i, f"http://o.org/{i}", f"<article><p>own{i}</p><p>{notice}</p></article>") for i in (50, 51, 52)] + [(53, "http://o.org/", f"<p>{notice}</p><p>own</p>")]
    got = {r.page_id: r.text for r in extraction.main_text(prepare(spark).createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Title {i}\nown{i} text\nend{i}" for i in range(5))
    assert all(got[i] == f"own{i} text\n{quoted}" for i in range(10, 14)) and all(got[i] == f"own{i} text" for i in range(14, 18))
    assert all(got[i] == got[10] for i in range(18, 25))
    assert all(got[i] == f"{notice} {quoted} {notice}\nonly{i}" for i in range(30, 34))
    assert all(got[i] == f"own{i} text\n{notice}" for i in (40, 41))
    assert all(got[i] == f"own{i}" for i in (50, 51, 52)) and got[53] == f"{notice}\nown"


def test_the_array_of_a_piece_names_what_most_texts_hold():
    rng = random.Random(1)
    for _ in range(200):
        pool = [" ".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 30))) for _ in range(4)]
        texts = [" ".join(rng.choice(pool) if rng.random() < 0.6 else rng.choice("xyz") for _ in range(rng.randrange(6))) for _ in range(rng.randrange(1, 9))]
        runs = [{tuple(text.split()[i : i + DEPTH]) for i in range(len(text.split()) - DEPTH + 1)} for text in texts]
        most = [extraction._digest(r) for r in set().union(*runs) if 2 * sum(r in x for x in runs) > len(texts)]
        assert sorted(extraction._shared(texts)) == sorted(most)
