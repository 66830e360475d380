"""Phrase mining against counting everything."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from feedloom.llm.collocations import BITS, Phrases, _bitmap, closing_counts, collocations, cut_score, frequent_phrases, hashed_counts, mine_hashes, words_of

PIECE, WORD = re.compile("[.,;:!?\n-\r]"), re.compile("[^ \t]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows, longest):
    f = defaultdict(Counter)
    for lang, text in rows:
        for piece in PIECE.split((text or "").translate(LOWER)):
            words = WORD.findall(piece)
            for k in range(1, longest + 1):
                f["und" if lang is None else lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return f


def expected(rows, least, longest=5, covered=100, top=2000):
    out = []
    for lang, f in counted(rows, longest).items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        often = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        kept = []
        for p, a in often.items():
            if any(100 * c >= covered * a and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))) for q, c in often.items()):
                continue
            score, _, left, right = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1)]
    return sorted(out)


ODD = [
    ("en", "The cat sat. The CAT sat! the cat\tsat; the cat: sat"),
    ("en", None),
    (None, "the cat sat " * 30),
    (None, ""),
    ("en", "a a a a a a a a\x0ba a a a\x0ca a\ra\na a a"),
    ("en", "x\x1cy x\x1cy x\x00 y\x85z \xa0 \xa0 é É é É"),
    ("de", "größe MASS größe mass, größe mass" + "\t \t größe mass" * 20),
    ("日", "中 文 中 文 中 文 中 文 。中 文"),
    ("", "no name no name no name"),
    ("en", "a A a"),
]


def corpus(seed):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(30)]
    rows = list(ODD)
    for i in range(120):
        text = " ".join(draw.choices(words, [1 / (k + 1) for k in range(30)], k=40)) + draw.choice(". ! , \n".split(" ")) + "one two three four five six"
        rows.append((draw.choice(["en", "de", None]), text))
    rows += [("en", "rare bird of prey sings " * 25)] * 2  # frequent in two documents alone
    rows += [("de", "Same words in every copy, same words")] * 40
    return rows


@pytest.mark.parametrize("sample", [0.0, 0.05, 0.5, 1.0])
def test_any_sample_gives_the_same(spark, sample):
    rows = corpus(4)
    docs = spark.createDataFrame([(b, a, 1) for a, b in rows], "text string, lang string, n int").repartition(4)
    got = collocations(docs, least=12, sample=sample)
    assert sorted(map(tuple, got.collect())) == expected(rows, 12)


def test_limits(spark):
    rows = corpus(5)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = collocations(docs, least=5, longest=3, covered=90, top=7)
    assert sorted(map(tuple, got.collect())) == expected(rows, 5, 3, 90, 7)


def test_closing_pass_finds_what_no_sample_proposed(spark):
    """Proposals without the words of a phrase: its parts of every length come from the closing pass."""
    rows = [("en", "one two three four five six. " * 30 + "a b. " * 50 + "one b a two. " * 12)]
    texts = spark.createDataFrame(rows, "lang string, text string")
    share = spark.sparkContext.broadcast
    proposals = [np.zeros((1 << BITS) // 8, np.uint8), mine_hashes(spark.sql("select 'en' lang, repeat('a b. three four.', 60) text"), 10, 5)]
    for bitmap in proposals:
        proposed = Phrases(share(bitmap))
        first = hashed_counts(texts, proposed, None, 5).where("n >= 30")
        sizes = {r.key & 7 for r in first.collect()}
        assert sizes == ({1, 2} if bitmap.any() else {1})  # neither "one two" nor any phrase of three words
        found = closing_counts(texts, Phrases(share(_bitmap(first))), proposed, 5).where("n >= 30").collect()
        assert {(tuple(r.phrase.split(" ")), r.n) for r in found if r.words} == {(p, c) for p, c in counted(rows, 5)["en"].items() if c >= 30}
        assert len(found) == len({(r.phrase, r.words) for r in found})


def test_empty_table(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert collocations(empty).collect() == []
    assert frequent_phrases(empty).where("words > 0").count() == 0


def test_words():
    for _, text in ODD:
        want = [w.encode() for piece in PIECE.split((text or "").translate(LOWER)) for w in [*WORD.findall(piece), "A"]]
        assert [*words_of(text), b"A"] == want


def test_long_text(spark):
    text = "alpha beta gamma. " * 700_000
    docs = spark.createDataFrame([("en", text)], "lang string, text string")
    (row,) = collocations(docs).collect()
    assert (row.phrase, row.a, row.n, row.score) == ("alpha beta gamma", 700_000, 2_100_000, 3000)


def test_score_past_64_bits(spark):
    cases = [(10**15, 10**17, 10**15, 10**15), (3, 10**17 + 1, 7, 11), (10**14 + 7, 10**16 + 3, 10**14 + 9, 10**14 + 11)]
    rows = spark.createDataFrame(cases, "a long, n long, l long, r long").select("*", cut_score("a", "n", "l", "r").alias("s"))
    assert {tuple(r) for r in rows.collect()} == {(a, n, x, y, 1000 * a * n // (x * y)) for a, n, x, y in cases}
