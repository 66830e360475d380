"""Token files against the tokenizers library, one document at a time."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest

from feedloom.llm.tokenfiles import PIECE, TokenFile, _Ids, read_sequences, read_token_documents, write_token_files

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None,
    "",
    " \t\n",
    "one <|endoftext|> two<|startoftext|>x <|ENDOFTEXT|>",
    "It's  THE\x0bcafé ́mark \x1c\x1d a\x85b c d 　e",
    "İstanbul ΣΑΣ ﬁn 12345 6²7 ... !!! 's 't we'll",
    "日本語の文章 \U0001f600\U0001f468‍\U0001f469",
    "x" * 5000 + " " + "yz " * 4000,
    "\x00\x01 nul",
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def stream(rows, library):
    """Documents in order as (id, start, size, checksum), and all ids."""
    found, ids = [], []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        new = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        found.append((doc, len(ids), len(new), zlib.crc32(np.array(new, "<u4").tobytes())))
        ids += new
    return found, ids


def read(manifest):
    return sorted((tuple(r) for r in read_token_documents(manifest).collect()), key=lambda r: r[1])


@pytest.mark.parametrize("length", [8, 1024])
def test_documents_and_sequences(spark, library, length):
    letters = random.Random(3)
    texts = [*ODD, *("".join(letters.choices("abcDE '.,é́̈ \n\t9中\x1f\xa0", k=80)) for _ in range(300))]
    rows = [(i * 7 - 100, text) for i, text in enumerate(texts)]
    docs = spark.createDataFrame([(b, a, 0, "x") for a, b in rows], "text string, doc_id long, start int, file string").repartition(5)
    manifest = write_token_files(docs, PATH, length=length)
    want, ids = stream(rows, library)
    assert read(manifest) == want
    files = manifest.orderBy("first_token").collect()
    assert sum(f.n_tokens for f in files) == len(ids) and sum(f.n_documents for f in files) == len(rows)
    got = read_sequences(manifest, spark.range(-2, 10_000).selectExpr("id as sequence").union(spark.sql("select null union all select 0L"))).orderBy("sequence").collect()
    assert [r.sequence for r in got] == list(range(sum(f.n_sequences for f in files)))
    assert all(len(r.ids) == len(r["mask"]) == length for r in got)
    assert [i for r in got for i, m in zip(r.ids, r["mask"], strict=True) if m] == ids


def test_repeated_ids_nulls_and_several_files(spark, library):
    rows = [(None, "b a"), (None, None), (5, "same"), (5, "same"), (5, None), *((i, f"w{i} " * 40) for i in range(6, 40))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    manifest = write_token_files(docs, PATH, length=16, file_sequences=4)
    assert manifest.count() > 10 and manifest.agg({'n_sequences': 'max'}).first()[0] < 12
    got = read(manifest)
    want, ids = stream(rows, library)
    assert sorted((r[0] or 0, r[2], r[3]) for r in got) == sorted((r[0] or 0, r[2], r[3]) for r in want)
    assert [r[0] for r in got] == [r[0] for r in want]
    assert [r[1] for r in got] == [sum(x[2] for x in got[:i]) for i in range(len(got))]
    assert read_sequences(manifest, spark.sql("select 3 as sequence")).count() == 1


def test_empty_table(spark):
    manifest = write_token_files(spark.createDataFrame([], "doc_id long, text string"), PATH)
    assert manifest.count() == 0 and read(manifest) == []
    assert read_sequences(manifest, spark.sql("select 0 as sequence")).count() == 0


def test_sequences_are_views_of_the_mapped_file(spark):
    docs = spark.createDataFrame([(i, "some words of a text " * 500) for i in range(200)], "doc_id long, text string")
    file = write_token_files(docs, PATH, length=64).first().file
    before = pa.total_allocated_bytes()
    stored = TokenFile(file)
    sequences = [stored.sequence(i) for i in range(0, 2000, 3)]
    assert pa.total_allocated_bytes() - before < 10_000
    assert all(len(ids) == 64 and not ids.flags.owndata and not ids.flags.writeable for ids, _ in sequences)
    step = sequences[1][0].__array_interface__["data"][0] - sequences[0][0].__array_interface__["data"][0]
    assert step == 3 * 64 * 2  # neighbours lie side by side in the file, two bytes an id
    assert all(len(m) == 64 and m.true_count == 64 for _, m in sequences)


def test_length_is_whole_bytes_of_mask(spark):
    with pytest.raises(ValueError, match="multiple of 8"):
        write_token_files(spark.createDataFrame([], "doc_id long, text string"), PATH, length=100)


def test_pieces_are_cut_as_bytes(library):
    """In one pass, letters of two bytes too; the ids are the library's, also where the tokenizer is asked for a few words at a time."""
    signs = [chr(i) for i in range(0x100) if not chr(i).isspace()] + ["\u0142", "\u4e2d", "\u0301"]
    rng = random.Random(4)
    texts = [*signs, *(f"a{x}.," for x in signs), *("".join(rng.choice([*"abcXYZ\xe9\xc9.,!", *signs]) for _ in range(rng.randrange(1, 9))) for _ in range(2000))]
    pieces = [t.encode() for t in texts]
    cut = PIECE.findall(b"".join(piece + b"\n" for piece in pieces))
    assert [b"".join(parts) for parts in cut] == pieces
    plain = re.compile("([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([.,;:!?]*)")
    assert all((word.decode(), behind.decode()) == (m.groups() if (m := plain.fullmatch(t)) else ("", "")) for t, (word, behind, _) in zip(texts, cut, strict=True))
    ids = _Ids(PATH)
    got = [np.frombuffer(x, ids.kind).tolist() for x in ids.encode([*pieces, " ".join(texts).encode()])]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in [*texts, " ".join(texts)]]
