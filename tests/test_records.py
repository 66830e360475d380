"""Files cut into pieces in many splits, against readers of whole files."""

import csv
import io
import random
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from feedloom.operators import quality as Q
from feedloom.session import JAPANESE, allow_japanese
from feedloom.sources import catalogues as C
from feedloom.sources import feeds as S
from feedloom.sources import records as R


@contextmanager
def splits_of(spark, size):
    """Files are read in splits of so many bytes."""
    settings = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "1"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def put(path, text, encoding="cp932"):
    path.write_bytes(text.encode(encoding) if isinstance(text, str) else text)
    return str(path)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


WILD = ['"', '"', '""', ",", ",", "\n", "\n", "ab", "c", " ", "～", "\\"]
TAME = ['x,"y\nz",w\n', "1,2,3\n", '"a""b\n\n",,\n', 'q"r,s,t\n', "\n", '"k,\n,",l,m\n', "short\n", "a,b,c,d\n"]


@pytest.mark.parametrize("seed", range(8))
def test_records_are_those_of_whole_files(spark, tmp_path, seed):
    """Any mess of quotes, commas and line ends, in splits of a few bytes."""
    allow_japanese(spark)
    draw = random.Random(seed)
    text = "a,b,c\n" + "".join(draw.choices(WILD if seed % 2 else TAME, k=150))
    if seed % 4 > 1:
        text = text.replace("\n", "\r\n")
    path = put(tmp_path / "f.csv", text)
    options = {"escape": '"', "columnNameOfCorruptRecord": "_raw"}
    schema = "a string, b string, c string, _raw string"
    whole = spark.read.options(multiLine=True, encoding=JAPANESE, **options).schema(schema).csv(path)
    want = sorted(str((r.a, r.b, r.c, r._raw is None)) for r in whole.collect())
    with splits_of(spark, 64):
        assert spark.read.text(path).rdd.getNumPartitions() > 3
        found = R.csv_records(spark, path, JAPANESE)
        got = found.where("record <> ''").select(F.from_csv("record", schema, options).alias("s")).select("s.*").collect()
        assert sorted(str((r.a, r.b, r.c, r._raw is None)) for r in got) == want
        numbered = found.orderBy("number").collect()
    assert [r.number for r in numbered] == list(range(1, len(numbered) + 1))
    # with the line ends between them the raw records make the file again
    end = "\r\n" if seed % 4 > 1 else "\n"
    assert end.join(r.raw for r in numbered) in (text, text.removesuffix(end))


def test_several_files_and_header(spark, tmp_path):
    """Headers behind blank lines, a byte order mark, quoted line ends in the header, names of their own, several files."""
    header = '"na\nme",値,"c"'
    put(tmp_path / "a.csv", f'﻿\n{header}\n1,"x\ny",3\n\n4,5\n', "utf-8")
    put(tmp_path / "b b.csv", f'﻿{header}\n6,7,8,9\n"6",,"{"long " * 50}\n"\n', "utf-8")
    with splits_of(spark, 16):
        scan = S.scan_feed(spark, str(tmp_path), encoding="UTF-8", with_source=True, header=["na\nme", "値", "c"])
        want = [("1", "x\ny", "3", None, 3, 3), ("4", "5", "", "4,5", 2, 5), ("6", "7", "8", "6,7,8,9", 4, 2), ("6", "", "long " * 50 + "\n", None, 3, 3)]
        assert rows(scan.drop("file_name")) == sorted(want, key=str)
        assert {r.file_name for r in scan.select("file_name").collect()} == {"a.csv", "b%20b.csv"}
        assert rows(S.scan_feed(spark, str(tmp_path), encoding="UTF-8", multi_line=None, header=["na\nme", "値", "c"])) == sorted((w[:3] for w in want), key=str)
        put(tmp_path / "c.csv", "other,b,c\n1,2,3\n", "utf-8")
        with pytest.raises(Exception, match="another header in .*c.csv"):
            S.scan_feed(spark, str(tmp_path), encoding="UTF-8", with_source=True, header=["na\nme", "値", "c"]).collect()


def test_reading_is_chosen(spark, tmp_path):
    assert S.reading(spark, put(tmp_path / "a.csv", "a\n1\r\n")) == "lines"
    assert S.reading(spark, put(tmp_path / "b.csv", 'a\n"1\n2"\n')) == "records"
    assert S.reading(spark, put(tmp_path / "c.csv", "a\n \n")) == "records"
    assert S.reading(spark, put(tmp_path / "d.csv", 'a\n"1\n\r2"\n')) == "whole"


def test_large_feed_is_read_in_parts(spark, tmp_path):
    """One file with quoted line ends: many tasks, the rows of the multi-line read."""
    lines = [[str(i), f"￥{i:,}", f"～①\n{i}"] for i in range(2000)]
    text = io.StringIO()
    csv.writer(text, lineterminator="\r\n").writerows([["a", "売上金額", "b"], *lines])
    path = put(tmp_path / "f.csv", text.getvalue())
    want = rows(S.scan_feed(spark, path))
    with splits_of(spark, 4096):
        scan = S.scan_feed(spark, path, multi_line=None)
        assert R.file_lines(spark, path).rdd.getNumPartitions() > 8
        assert rows(scan) == want and len(want) == 2000
        assert "Scan text" in scan._jdf.queryExecution().toString()


def test_open_quote_to_the_end(spark, tmp_path):
    path = put(tmp_path / "f.csv", "a,b\n1,2\n" + '3,"never closed\n' + "more, text\n" * 40)
    want = [tuple(v.removesuffix("\n") for v in row) for row in rows(S.scan_feed(spark, path))]  # the file's last line end is not kept
    with splits_of(spark, 32):
        assert rows(S.scan_feed(spark, path, multi_line=None)) == want and len(want) == 2


def test_profile_in_parts(spark, tmp_path):
    text = "".join(TAME * 40)
    path = put(tmp_path / "p.csv", text)
    read = list(csv.reader(io.StringIO(text)))
    with splits_of(spark, 50):
        assert tuple(Q.profile_csv(spark, path).first()) == (len(read), max(map(len, read)))
        assert "wholetext" not in str(Q.profile_csv(spark, path)._jdf.queryExecution()).lower()


def test_catalogue_in_parts(spark, tmp_path):
    """The last entry of a name wins by file and record, however the files are split."""
    draw = random.Random(2)
    lines = [(f"g{draw.randrange(3)}", f"n{draw.randrange(5)}", "css", f'v{i}\n"q"') for i in range(200)]
    for name, part in (("a", lines[:120]), ("b", lines[120:])):
        text = io.StringIO()
        csv.writer(text).writerows([C.CATALOGUE_COLUMNS, *part])
        put(tmp_path / f"{name}.csv", text.getvalue().replace("\r\n", "\n"))
    with splits_of(spark, 100):
        got = rows(C.scan_selectors(spark, str(tmp_path), defaults=False))
    assert got == sorted({line[:2]: line for line in lines}.values(), key=str)


def test_sections_in_parts(spark, tmp_path):
    """Sections of several files, numbered in their file, whatever the splits; lines before the first one go."""
    texts = {}
    for name, count, end in (("a.md", 30, "\n"), ("b.md", 7, "\r\n"), ("none.md", 0, "\n")):
        parts = [f"## {i}. s{i}{end}--url{end}https://h/{name}/{i}{end}--操作手順{end}1. step {i}{end}{end}" for i in range(1, count + 1)]
        texts[name] = f"preface{end}--url{end}no{end}" + "".join(parts)
        put(tmp_path / name, texts[name], "utf-8")
    whole = spark.createDataFrame(list(texts.items()), "file_name string, content string")
    want = rows(C.instruction_sections(whole, "content", "file_name"))
    with splits_of(spark, 40):
        got = rows(C.scan_instructions(spark, str(tmp_path)))
    assert got == want and len(got) == 37


def test_states_against_a_loop():
    draw = np.random.default_rng(1)
    for size in (0, 1, 2, 50):
        for first in (False, True):
            out, into = draw.random(size) < 0.3, draw.random(size) < 0.7
            state, before = first, []
            for a, b in zip(out, into, strict=True):
                before.append(state)
                state = bool(b if state else a)
            got, last = R.states(out, into, first)
            assert got.tolist() == before and last == state


@pytest.mark.parametrize(
    "line, opens, stays",
    [
        ("a,b", False, True),
        ('"a', True, False),
        ('a"b', False, False),
        ('"a""', True, False),
        ('"a"",b', True, False),
        ('","', False, True),
        ('x" y,"z', True, True),
        ('"a"b"c,"d', True, True),
        (' "a', False, False),
    ],
)
def test_quotes_of_a_line(line, opens, stays):
    """What is open after a line; a quote inside an unquoted field and junk behind a closing quote are text."""
    got = R.CSV_RECORDS.moves(pa.array([line.encode(), b""]))
    assert (bool(got[0][0]), bool(got[1][0])) == (opens, stays)
    assert (bool(got[0][1]), bool(got[1][1])) == (False, True)
