"""Resampling by gains against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from tokenizers import Regex
from tokenizers.pre_tokenizers import Split

from tidemark.llm import gains
from tidemark.llm.common import prepare

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _features(text, longest):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    return len(words), [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def _brute(docs, target, setup):
    def bucket(f):
        return zlib.crc32(f.encode()) % setup.buckets

    made = [(i, *_features(t, setup.longest)) for i, t in docs]
    s = Counter(bucket(f) for _, _, fs in made for f in fs)
    t = Counter(bucket(f) for text in target for f in _features(text, setup.longest)[1])
    all_s, all_t = sum(s.values()) + setup.buckets, sum(t.values()) + setup.buckets

    def gain(b):
        return math.floor(1000 * math.log(float(t[b] + 1) * float(all_s) / (float(s[b] + 1) * float(all_t))))

    rows = []
    for i, n, fs in made:
        weight = sum(gain(bucket(f)) for f in fs)
        h = int(hashlib.sha256(f"{setup.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, n, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in rows if r[1] >= setup.least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    rank = {id(r): k + 1 for k, r in enumerate(able[: setup.percent * len(able) // 100])}
    return Counter((r[0], r[2], r[3], r[4], rank.get(id(r))) for r in rows)


@pytest.fixture(scope="module")
def rows():
    words = ["alpha", "BETA", "gamma9", "délta", "ÉPSILON", "zeta-eta", "x", "漢字"]
    made = [(i, " ".join(words[(i * k + k * k) % 8] for k in range(i % 45))) for i in range(300)]
    made += [(300, None), (301, ""), (302, " \t\x00-"), (303, "word " * 40_000), (304, "y" * 150_000), (None, "alpha beta " * 15)]
    made += [(305, "alpha " * 30)] * 40  # equal rows, which tie
    return made


def _frame(spark, rows):
    prepare(spark)
    return spark.createDataFrame(
        [(i, t, "x", 1, [2], 3, 4) for i, t in rows],
        "doc_id long, text string, id string, score int, buckets array<int>, rank int, n_words int",
    )


@pytest.mark.parametrize("setup", [gains.Setup(), gains.Setup(longest=3, buckets=97, least=5, percent=35, seed=7)])
def test_rows_equal_brute_force(spark, rows, setup):
    target = ["alpha beta gamma9 alpha", None, "", "ÉPSILON délta x x x"]
    wanted = spark.createDataFrame([(t, "q") for t in target], "text string, bucket string")
    got = gains.resample(_frame(spark, rows), wanted, setup)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(tuple(r) for r in got.collect()) == _brute(rows, target, setup)


def test_pieces_of_a_long_text_make_the_same_features(monkeypatch):
    text = "one two-three  FOUR " * 50 + "five" * 30 + " six"
    setup = gains.Setup(longest=4, buckets=1000)
    splitter = Split(Regex(f"{gains.GAP}+"), "removed")
    monkeypatch.setattr(gains, "SPAN", 7)
    n, at, counts = gains.histogram(text, splitter, setup, {})
    words, features = _features(text, 4)
    expected = Counter(zlib.crc32(f.encode()) % 1000 for f in features)
    assert n == words and dict(zip(at.tolist(), counts.tolist(), strict=True)) == dict(expected)


def test_offsets_are_those_of_the_words():
    splitter = Split(Regex(f"{gains.GAP}+"), "removed")
    text = "ab, çd  9e\n漢字x"
    assert [(w, text[a:b]) for w, (a, b) in splitter.pre_tokenize_str(text)] == [(w, w) for w in WORD.findall(text)]


def test_empty_tables(spark, rows):
    wanted = spark.createDataFrame([("alpha",)], "text string")
    assert gains.resample(_frame(spark, rows).limit(0), wanted).count() == 0
    got = gains.resample(_frame(spark, rows), wanted.limit(0))
    assert Counter(tuple(r) for r in got.collect()) == _brute(rows, [], gains.Setup())


def test_draw_follows_the_weights(spark):
    """Over many seeds the first drawn document is chosen in proportion to the exponential of its weight."""
    from pyspark.sql import functions as F

    weight = {0: 0, 1: 700, 2: 1400}
    first = Counter()
    frame = spark.createDataFrame(list(weight.items()), "id long, weight long")
    seeds = 3000
    scores = frame.select("id", F.explode(F.sequence(F.lit(0), F.lit(seeds - 1))).alias("seed"), "weight")
    key = F.concat(F.col("seed").cast("string"), F.lit(":"), F.col("id").cast("string"))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    for r in scores.groupBy("seed").agg(F.max_by("id", F.col("weight") + noise).alias("id")).collect():
        first[r["id"]] += 1
    # the column made by the operator is the same one
    one = {r["id"]: r["n"] for r in frame.select("id", gains.noise("id", 5).alias("n")).collect()}
    assert one == {r["id"]: r["n"] for r in scores.where("seed = 5").select("id", noise.alias("n")).collect()}
    total = sum(math.exp(w / 1000) for w in weight.values())
    for i, w in weight.items():
        assert abs(first[i] / seeds - math.exp(w / 1000) / total) < 0.03
