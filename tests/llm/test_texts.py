"""Line dedup, repeats, near copies, PII and quality rules against plain Python, with odd rows."""

import hashlib
import itertools
import math
import random
import re
import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from feedloom.llm import quality
from feedloom.llm.common import BLANKS
from feedloom.llm.components import connect
from feedloom.llm.jaccard import bands, jaccard_components, shingle_set, sketches
from feedloom.llm.lines import drop_repeated_lines
from feedloom.llm.pii import KINDS, base_spans, find_pii, redact_pii, span_text
from feedloom.llm.quality import BUCKETS, MILLION, PRIOR, SMOOTHING, _likely, ngram_model, quality_rules, rated, rule_counts, with_buckets, with_runs
from feedloom.llm.repeats import remove_repeats

ODD = [None, "", " ", "\n\n", "é" * 500, "a" * 3000, "x y " * 900, "\x1c\x85  ", "日本語 テキスト\n" * 40]


def frame(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string")


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def words_text(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


# line dedup


def lines_expected(rows):
    blanks = "\t\n\x0b\x0c\r "

    def key(line):
        stripped = line.strip(blanks)
        return stripped.encode().lower() if len(stripped) >= 40 else None

    held = {}
    for i, text in rows:
        for k in {key(x) for x in (text or "").split("\n")} - {None}:
            held.setdefault(k, set()).add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if (k := key(x)) is None or len(held[k]) < 5 or max(held[k]) == i]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out)


def test_lines(spark):
    rng = random.Random(1)
    common = ["Shared Line " + "é" * 30, "shared line two " + "b" * 40, "short"]
    rows = [(i, "\n".join(rng.choice([*common, common[0].upper(), f"  {common[1]}\t", f"own {i} " + "c" * 50]) for _ in range(6))) for i in range(40)]
    rows += [(100 + i, t) for i, t in enumerate(ODD)] + [rows[3]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"n_lines": F.lit("old"), "key": F.lit(1)})
    got = drop_repeated_lines(docs)
    assert got.columns == ["doc_id", "text", "key", "n_lines", "n_dropped"]
    found = sorted((r.doc_id, r.text or "", r.n_lines, r.n_dropped) for r in got.collect())
    assert found == lines_expected(rows)
    assert drop_repeated_lines(empty(spark)).collect() == []


def test_lines_of_repeated_documents(spark):
    """A line counts once for an id, however many rows the id has."""
    line = "a line that several documents hold " + "x" * 20
    rows = [(1, line), (1, line + "\nown"), (2, line), (2, line), (3, line)]
    assert lines_expected(rows) == sorted((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in drop_repeated_lines(frame(spark, [t for _, t in rows], [i for i, _ in rows])).collect())
    more = [*rows, (4, line), (5, line), (5, "other\n" + line)]
    got = sorted((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in drop_repeated_lines(frame(spark, [t for _, t in more], [i for i, _ in more])).collect())
    assert got == lines_expected(more) and got[0] == (1, "", 1, 1)


# repeats


def repeats_expected(texts, length):
    seen = Counter()
    for t in texts:
        raw = (t or "").encode()
        seen.update(raw[i : i + length] for i in range(len(raw) - length + 1))
    out = []
    for t in texts:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if seen[raw[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = [(k, len(list(g))) for k, g in itertools.groupby(gone)]
        out.append((sum(gone), sum(k for k, _ in spans), bytes(b for b, g in zip(raw, gone, strict=True) if not g)))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repeats(spark, seed):
    rng = random.Random(seed)
    passages = [words_text(rng, rng.randrange(4, 40)) for _ in range(6)]
    texts = [" ".join(rng.choice([*passages, words_text(rng, 12), "ab" * 40, "é" * 30]) for _ in range(rng.randrange(1, 8))) for _ in range(40)]
    texts += [texts[0], texts[1][7:], texts[2][:-9], *ODD]
    got = {r.doc_id: r for r in remove_repeats(frame(spark, texts).withColumns({"hash": F.lit(1), "spans": F.lit(2)}), length=60, gram=24).collect()}
    for i, (removed, spans, kept) in enumerate(repeats_expected(texts, 60)):
        r = got[i]
        assert (r.n_removed, len(r.spans), bytes(r.kept), r.n_bytes) == (removed, spans, kept, len((texts[i] or "").encode())), i


def test_repeats_large_groups(spark, monkeypatch):
    from feedloom.llm import repeats

    monkeypatch.setattr(repeats, "GROUP", 2)
    rng = random.Random(4)
    core = words_text(rng, 30)
    texts = [words_text(rng, 3) + core + words_text(rng, 3) for _ in range(30)]
    got = {r.doc_id: r for r in remove_repeats(frame(spark, texts), length=60, gram=24).collect()}
    for i, (removed, _, kept) in enumerate(repeats_expected(texts, 60)):
        assert (got[i].n_removed, bytes(got[i].kept)) == (removed, kept)


def test_repeats_odd_tables(spark):
    assert remove_repeats(empty(spark)).collect() == []
    rows = remove_repeats(frame(spark, ["z" * 450, "z" * 450, None], [None, 5, 5])).collect()
    assert sorted((r.n_removed, bytes(r.kept)) for r in rows) == [(0, b""), (450, b""), (450, b"")]


def test_collision_fallback():
    import numpy as np

    from feedloom.llm.suffixes import PrefixHashes, repeated

    data = np.frombuffer(b"abcabcabxabc", np.uint8)
    hashes = PrefixHashes(data)
    hashes.equal = lambda a, b, length: np.ones(len(a), bool)  # everything collides
    places = np.arange(10)
    assert repeated(hashes, places, np.zeros(10, np.int64), 3).tolist() == [0, 1, 2, 3, 4, 5, 9]


# near copies


def components_expected(rows, size, percent):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            parent[root(i)] = root(j)
    names = {}
    for i, (d, _) in enumerate(rows):
        names[root(i)] = min(names.get(root(i), d), d)
    return sorted((d, len(s), names[root(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True)))


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80)])
def test_components(spark, size, percent):
    rng = random.Random(size)
    texts = []
    for _ in range(12):
        words = words_text(rng, rng.choice([2, 4, 12, 40, 150, 400])).split()
        texts.append(" ".join(words))
        for _ in range(rng.randrange(5)):  # chains of copies, each with a few words more changed
            for _ in range(max(1, len(words) // rng.choice([25, 60, 90]))):
                words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
            texts.append(" ".join(words).upper())
    texts += [*ODD, texts[0], texts[5]]
    rows = list(enumerate(texts))
    got = jaccard_components(frame(spark, texts).withColumn("label", F.lit(0)), size=size, percent=percent).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == components_expected(rows, size, percent)


def test_components_of_odd_ids(spark):
    """Ids whose hash falls on the filter's ends, and several texts of one id."""
    rng = random.Random(7)
    a, b, c = (words_text(rng, 120, 10**6) for _ in range(3))
    got = jaccard_components(frame(spark, [a, a + " more", b], [5, 25317696, 60270852]), size=3, percent=90).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(5, 5), (25317696, 5), (60270852, 60270852)}
    rows = [(1, a), (1, b), (2, a + " x"), (3, b + " x"), (4, c), (4, None), (7, c + " x"), (9, None), (9, "")]
    got = jaccard_components(frame(spark, [t for _, t in rows], [i for i, _ in rows]), size=3, percent=90).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == [
        (1, 118, 1), (1, 118, 1), (2, 119, 1), (3, 119, 1), (4, 0, 4), (4, 118, 4), (7, 119, 4), (9, 0, 9), (9, 0, 9)
    ]


def test_components_in_blocks(spark, monkeypatch):
    from feedloom.llm import jaccard

    monkeypatch.setattr(jaccard, "BLOCK", 3)
    rng = random.Random(9)
    base = words_text(rng, 120, 10**6).split()
    texts = []
    for i in range(24):
        copy = list(base)
        for _ in range(rng.choice([0, 1, 2, 4])):
            copy[rng.randrange(120)] = f"x{i}{rng.randrange(99)}"
        texts.append(" ".join(copy))
    got = jaccard_components(frame(spark, texts), size=3, percent=90).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == components_expected(list(enumerate(texts)), 3, 90)


def test_components_odd_tables(spark):
    assert jaccard_components(empty(spark)).collect() == []
    rows = jaccard_components(frame(spark, ["a b c d e f", "a b c d e f", None, "a b c d e f"], [7, None, 3, 7])).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in rows) == [(-1, -1), (3, 3), (7, 7), (7, 7)]


@pytest.mark.parametrize("percent", [80, 90])
def test_linked_sets_meet(percent):
    """Any two sets at the threshold share a join key, unless the band's sets are equal."""
    rng = random.Random(percent)
    for _ in range(300):
        n = rng.choice([5, 9, 12, 20, 45, 130, 700])
        pool = [f"k{rng.randrange(10**9)}" for _ in range(2 * n)]
        a = pool[:n]
        change = int(n * (100 - percent) / (100 + percent))
        b = a[change:] + pool[n : n + change]
        sets = [shingle_set(" ".join(x), 1) for x in (a, b)]
        same = len(set(sets[0].tolist()) & set(sets[1].tolist()))
        if 100 * same < percent * (len(sets[0]) + len(sets[1]) - same) or change == 0:
            continue
        keys = [set(itertools.chain.from_iterable(k.tolist() for _, k, _ in sketches(s, percent))) for s in sets]
        assert keys[0] & keys[1]
    assert all(bands(n, percent) for n in range(1, 300))


def test_connect(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(60)]
    got = {r.node: r.label for r in connect(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def root(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    assert got == {x: root(x) for a, b in edges if a != b for x in (a, b)}
    assert connect(spark.createDataFrame([], "a long, b long")).collect() == []


# personal data

FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def spans_expected(text):
    out = []
    for number, (kind, form) in enumerate(FORMS.items()):
        for m in re.finditer(form, text or ""):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card":
                doubled = [d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
                if not 14 <= len(digits) <= 19 or sum(doubled) % 10:
                    continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), number, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(s for _, _, s in sorted(out))


def test_base_spans(spark):
    rng = random.Random(5)
    texts = [*ODD, "a@b.c_d@e.f x@y z@@q.w", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.0004", "é4111 1111 1111 1111 4111-1111-1111-1111  41111111111111111"]
    texts += ["ü+1 (017) 555-7713 +12345678901234567", "a" * 20_000 + "@" + "b.c" * 5000, "+1" + "(" * 9000, "7" * 20_000, "1." * 20_000]
    texts += ["".join(rng.choice("ab@.1 2-+(9)é_\n4") for _ in range(rng.randrange(1, 60))) for _ in range(200)]
    texts += ["".join(rng.choice("0123456789 -.+") for _ in range(rng.randrange(10, 60))) for _ in range(200)]
    got = {r.doc_id: r.s for r in base_spans(frame(spark, texts)).select("doc_id", span_text(F.col("base")).alias("s")).collect()}
    assert [got[i] for i in range(len(texts))] == [spans_expected(t) for t in texts]


def test_many_matches_in_one_text(spark):
    """Tens of thousands of addresses: places and cuts take time in proportion."""
    import time

    text = " ".join(f"user{i}@mail.example.com tel +1 (017) 555-{i:04d}" if i % 7 else "é plain words 4111111111111111" for i in range(20_000))
    start = time.monotonic()
    (row,) = base_spans(frame(spark, [text])).select(span_text(F.col("base")).alias("s")).collect()
    assert row.s == spans_expected(text) and row.s.count(":") > 60_000
    (row,) = redact_pii(frame(spark, [text])).collect()
    assert "@" not in row.text and row.text.startswith("é plain words [card] [email] tel [phone]") and row.text.count("[email]") == 20_000 - 2858
    assert time.monotonic() - start < 60


def test_redacted_cover(spark):
    """Spans that overlap or touch, in more than one block of spans, against a cover by code points."""
    rng = random.Random(9)
    pieces = ["+1 (017) 555-7713", "4111 1111 1111 1111", "+4111 1111 1111 1111", "1.2.3.4", "a@b.cd", "+1.2.3.4.5.6.7.8.9.10.11", " ", "é", "x"]
    texts = ["".join(rng.choice(pieces) for _ in range(n)) for n in (0, 5, 30, 900)]
    spans = {r.doc_id: r.spans for r in find_pii(frame(spark, texts)).collect()}
    got = {r.doc_id: r.text for r in redact_pii(frame(spark, texts)).collect()}
    for i, text in enumerate(texts):
        out, at = [], 0
        for x in sorted(spans[i], key=lambda x: (x.start, x.kind)):
            if x.start >= at:
                out.append(text[at : x.start] + f"[{KINDS[x.kind]}]")
            at = max(at, x.stop)
        assert got[i] == "".join(out) + text[at:]


def test_contexts_discover(spark):
    known = [f"please mail to user{i}@mail{i}.example.com now" for i in range(8)]
    new = ["please mail to someone@localhost now", "the year 123456789 was"]
    got = find_pii(frame(spark, [*known, *new, None, "", "x"]).withColumns({"spans": F.lit(1), "item": F.lit(2)})).collect()
    spans = {r.doc_id: [(KINDS[x.kind], x.start, x.stop) for x in r.spans] for r in got}
    assert spans[8] == [("email", 15, 32)] and not spans[9] and not spans[10] and not spans[12]
    assert all(spans[i][0][1] == 15 for i in range(8)) and "item" in got[0].asDict()
    assert find_pii(empty(spark)).collect() == []


def test_redact(spark):
    texts = ["é a.b@c.de +1 (017) 555-7713.", "none", None, "1.2.3.4 1.2.3.4"]
    got = {r.doc_id: r.text for r in redact_pii(frame(spark, texts)).collect()}
    assert got == {0: "é [email] [phone].", 1: "none", 2: None, 3: "[ip] [ip]"}


# quality rules


def counts_expected(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed


def test_rule_counts(spark):
    rng = random.Random(6)
    texts = [*ODD, *(rng.choice([" ", "\n"]).join(words_text(rng, rng.randrange(0, 90), rng.choice([3, 30, 900])).split(" ")) for _ in range(80)), "# | a < b\n# | a < b"]
    got = rule_counts(frame(spark, texts).withColumn("n_words", F.lit("old"))).collect()
    found = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got}
    assert [found[i] for i in range(len(texts))] == [counts_expected(t) for t in texts]


def test_quality_ratio(spark):
    rng = random.Random(8)
    clean = [words_text(rng, 80, 5000) for _ in range(30)]
    junk = [" ".join(w.upper() + "$$$" for w in words_text(rng, 80, 5000).split()) for _ in range(10)]
    docs = frame(spark, [*clean, *junk, None, clean[0]], [*range(41), 0]).withColumn("kept", F.lit("old"))
    trusted = spark.createDataFrame([(i,) for i in range(0, 30, 2)] + [(None,)], "doc_id long")
    got = quality_rules(docs, trusted).collect()
    assert len(got) == 42 and {r.doc_id for r in got if r.kept} == set(range(30))
    assert rated(empty(spark), trusted).collect() == []
    assert sorted(quality_rules(frame(spark, clean[:2], [None, 1]), trusted).columns)[:2] == ["base_failed", "doc_id"]


def test_quality_ratio_sees_words(spark):
    """Bad documents with the word shapes of the good ones, but other words; then the same words in another order."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    good, bad, names = ([word() for _ in range(200)] for _ in range(3))
    text = lambda words: " ".join(rng.choice(words) for _ in range(120))
    phrases = lambda step: " ".join(f"{names[i]} {names[(i + step) % 200]}" for i in rng.choices(range(0, 200, 2), k=60))
    trusted = spark.createDataFrame([(i,) for i in range(0, 60, 2)], "doc_id long")
    for texts in ([text(good) for _ in range(60)] + [text(bad) for _ in range(60)], [phrases(1) for _ in range(60)] + [phrases(101) for _ in range(60)]):
        got = {r.doc_id: r.kept for r in quality_rules(frame(spark, texts), trusted).collect()}
        assert sum(got[i] for i in range(60)) >= 58 and not any(got[i] for i in range(60, 120))


def test_runs_of_buckets(spark):
    """A text's buckets are counted in its row; pairs of shapes are those of all neighbours, with the blanks between."""
    rng = random.Random(5)
    docs = frame(spark, [*ODD, "", None, " one", "a  B\t9\n", *(words_text(rng, n, 30) for n in (1, 2, 3, 80, 81))])
    shapes = lambda text: re.sub(r"\d+", "9", re.sub(r"[A-Z]+", "A", re.sub(r"[a-z]+", "a", text)))
    runs = {r.doc_id: r["__runs"] for r in with_runs(docs, "text").collect()}
    for r in with_buckets(docs, "text").collect():
        assert sorted(map(tuple, runs[r.doc_id])) == sorted(Counter(r["__buckets"]).items())
        if (r.text or "").isascii():
            words = re.findall(r"[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", shapes(r.text or "").strip(BLANKS))
            found = ["".join(words[i : i + 3]) for i in range(0, len(words) - 2, 2)]
            wanted = spark.createDataFrame([(x,) for x in found], "x string").select((F.pmod(F.xxhash64("x"), F.lit(BUCKETS)) + 2 * BUCKETS).alias("b"))
            assert Counter(b for b in r["__buckets"] if b >= 2 * BUCKETS) == Counter(x.b for x in wanted.collect())


def test_threshold_of_repeated_trusted_rows(spark):
    """All rows of a trusted id count as its own, and only such rows are grouped by bucket."""
    rng = random.Random(12)
    texts, ids = [words_text(rng, 60, 400) for _ in range(24)], [*range(20), 0, 0, 3, None]
    docs = frame(spark, texts, ids)
    trusted = [0, 2, 3, 5, 8, 30]
    weights, threshold = ngram_model(docs, spark.createDataFrame([(i,) for i in trusted], "doc_id long"))
    own, raw, good = {i: Counter() for i in trusted}, Counter(), Counter()
    for r in with_buckets(docs, "text").collect():
        raw.update(r["__buckets"])
        if r.doc_id in own:
            good.update(r["__buckets"])
            own[r.doc_id].update(r["__buckets"])
    n, t = raw.total() + SMOOTHING * quality.KINDS * BUCKETS, good.total()
    share = [(raw[b] + SMOOTHING) / n for b in range(quality.KINDS * BUCKETS)]
    assert weights == [round(MILLION * math.log((good[b] + PRIOR * s) / (t + PRIOR) / s)) if raw[b] else 0 for b, s in enumerate(share)]
    rest = {i: round(MILLION * math.log(t - c.total() + PRIOR)) for i, c in own.items() if c}
    sums = {i: sum(k * round(MILLION * math.log((good[b] - k + PRIOR * share[b]) / share[b])) for b, k in own[i].items()) for i in rest}
    ratings = [int(sums[i] / own[i].total()) - rest[i] for i in rest]
    assert abs(threshold - min(0, (statistics.mean(ratings) - 3 * statistics.stdev(ratings)) / MILLION)) < 3e-6


def test_texts_are_hashed_once(spark, monkeypatch):
    """The model and the rating read the buckets that were written; the text is written beside them only where it is wanted."""
    rng, hashed, written = random.Random(13), [], []
    plain, write = quality.with_buckets, quality.settle
    monkeypatch.setattr(quality, "with_buckets", lambda rows, text: hashed.append(text) or plain(rows, text))
    monkeypatch.setattr(quality, "settle", lambda df, name, **options: written.append(df.columns) or write(df, name, **options))
    docs = frame(spark, [words_text(rng, 60, 400) for _ in range(12)])
    trusted = spark.createDataFrame([(i,) for i in range(0, 12, 2)], "doc_id long")
    whole = {r.doc_id: (r.text, r.ratio, r.kept) for r in rated(docs, trusted).collect()}
    assert hashed == ["text"] and len(whole) == 12 and sum("text" in names for names in written) == 1
    written.clear()
    bare = rated(docs, trusted, keep_text=False)
    assert {r.doc_id: (r.ratio, r.kept) for r in bare.collect()} == {i: found[1:] for i, found in whole.items()}
    assert not any("text" in names for names in [bare.columns, *written])


def test_texts_without_trusted_ids_stay_where_they_are(spark):
    """Every row with a trusted id passes the bitmap, of the others only a few; ids of another type all pass."""
    ids = [None, 0, -5, 2**62, *range(1000, 2000)] * 2
    docs = spark.createDataFrame([(i, "t") for i in ids], "doc long, text string")
    trusted = spark.createDataFrame([(i,) for i in (0, -5, 2**62, 7, *range(1000, 1100))], "trusted long")
    marked, likely = _likely(docs, trusted)
    passed = Counter(r.doc for r in marked.where(likely).select("doc").collect())
    wanted = {0, -5, 2**62, *range(1000, 1100)}
    assert all(passed[i] == 2 for i in wanted) and len(passed) <= len(wanted) + 5
    assert marked.where(~likely).count() == len(ids) - sum(passed.values())
    same, every = _likely(docs, trusted.select(F.col("trusted").cast("decimal(20,0)")))
    assert same.where(every).count() == len(ids)


def test_hash_of_kept_text():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")
