"""Phrases whose words keep company, mined as by Toivonen.

A sample proposes the phrases that are frequent there at a lowered count. One pass over all texts counts them together with
their negative border: phrases that are not proposed, though both phrases of one word less in them are. It sums counts by hash, which
is little to shuffle. Phrases of the border that turn out frequent are failures: longer ones may have been missed. A closing pass
counts by words, exactly, what the first one found frequent, and with it all that failures open, at every length, so that nothing
stays open. The result depends neither on the sample nor on hashes.

Phrases travel between passes as bitmaps of hashes of fixed size. A bit shared by chance only makes a pass count a few phrases more.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import map_batches, settle

LONGEST = 5  # words of a phrase
LEAST = 100  # occurrences of a phrase
SAMPLE = 0.1
BITS = 27  # the bitmap has 2 ** BITS bits
BYTES_AT_ONCE = 2_000_000  # of texts that are counted together
TOP = 2000

# lower case, every sign that ends a piece as a newline, tab as a blank; a capital letter is then free to mark the end of a piece
_FROM = bytes(range(ord("A"), ord("Z") + 1)) + b".,;:!?\x0a\x0b\x0c\x0d\x09"
_TO = bytes(range(ord("a"), ord("z") + 1)) + b"\n" * 10 + b" "
PLAIN = bytes.maketrans(_FROM, _TO)
END = b"A"

COUNTS = "lang string, phrase string, words int, n long"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    """The words of a text's pieces, with a mark after each piece."""
    # blanks and tabs part words, all else of white space ends a piece; splitting knows no other white space in bytes
    return (text or "").encode().translate(PLAIN).replace(b"\n", b" A ").split()


def word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode() + b"\0" + word)


def _join_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The hash of a phrase from that of all its words but the last, and of the last."""
    return ((left ^ (left >> np.uint64(29))) * _MIX) ^ ((right << np.uint64(7)) + (right >> np.uint64(11)))


def _bit(keys: np.ndarray) -> np.ndarray:
    """The place in the bitmap; a key's last three bits are the number of words and take no part."""
    return ((keys >> np.uint64(3)) * _MIX >> np.uint64(64 - BITS)).astype(np.int64)


@dataclass
class Phrases:
    """A set of phrases as a bitmap that all tasks share."""

    shared: object

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = _bit(hashes)
        return ((self.shared.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool)


class _Chunk:
    """Words of one language, counted together."""

    def __init__(self, lang: str, words: list[bytes]):
        coded = pa.array(words, pa.binary()).dictionary_encode()
        self.lang, self.names = lang, coded.dictionary
        self.ids = coded.indices.to_numpy().astype(np.int64)
        names = self.names.to_pylist()
        self.hashes = np.array([word_hash(lang, w) for w in names], np.uint64)
        self.is_word = np.array([w != END for w in names], bool)
        self.number = np.bincount(self.ids, minlength=len(names))
        self.number[~self.is_word] = 0

    def counts(self, upon: Phrases | None, before: Phrases | None, longest: int, closing: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """``(words, first places, hashes, counts)`` of phrases of two words and more.

        A phrase is looked at if both its parts of one word less are in ``upon``; those that ``before`` let count are passed over. When
        ``closing``, a phrase that ``before`` let count is counted if it is in ``upon`` itself, any other at once, and
        what is counted opens longer ones.
        """
        if upon is None:
            return
        inside = self.is_word[self.ids]
        on = upon.has(self.hashes)[self.ids] & inside
        old = before.has(self.hashes)[self.ids] & inside if before else np.zeros(len(self.ids), bool)
        number, hashes = self.ids, self.hashes[self.ids]
        for size in range(2, longest + 1):
            both = on & np.append(on[1:], False)
            let = old & np.append(old[1:], False)
            at = np.flatnonzero(both)
            if not len(at):
                return
            keys = number[at] * len(self.names) + self.ids[at + size - 1]
            _, place, which, found = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
            begin = at[place]
            own = _join_hash(hashes[begin], self.hashes[self.ids[begin + size - 1]])
            fresh, known = ~let[begin], upon.has(own)
            counted = fresh | known if closing else fresh
            yield size, begin[counted], own[counted], found[counted]
            grown_on, grown_old, grown_number, grown_hash = (np.zeros(len(self.ids), t) for t in (bool, bool, np.int64, np.uint64))
            grown_on[at] = (counted if closing else known)[which]
            grown_old[at] = (before.has(own) & ~fresh)[which] if before else False
            grown_number[at], grown_hash[at] = which, own[which]
            on, old, number, hashes = grown_on, grown_old, grown_number, grown_hash

    def phrases(self, begin: np.ndarray, size: int) -> pa.Array:
        parts = [self.names.take(pa.array(self.ids[begin + i])) for i in range(size)]
        return (pc.binary_join_element_wise(*parts, pa.scalar(b" ")) if size > 1 else parts[0]).cast(pa.string())


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Chunk]:
    """The words of a partition, some megabytes at a time and by language."""
    waiting: dict[str, list[bytes]] = {}
    size = 0
    for part in (batch.slice(i, 200) for batch in batches for i in range(0, batch.num_rows, 200)):
        for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
            words = waiting.setdefault(lang, [])
            words += words_of(text)
            words.append(END)
            size += len(text or "")
            if size >= BYTES_AT_ONCE:
                yield from (_Chunk(name, found) for name, found in waiting.items())
                waiting, size = {}, 0
    yield from (_Chunk(name, found) for name, found in waiting.items())


def hashed_counts(texts: DataFrame, upon: Phrases | None, before: Phrases | None, longest: int) -> DataFrame:
    """``(key, n)`` of the phrases of ``(lang, text)`` that ``upon`` lets count and ``before`` did not, with all words if there is no ``before``.

    The key is the hash of language and words, its last three bits the number of words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            single = np.flatnonzero(chunk.number)
            words = [] if before else [(1, single, chunk.hashes[single], chunk.number[single])]
            for size, _, hashes, found in chain(words, chunk.counts(upon, before, longest, False)):
                keys = (hashes >> np.uint64(3) << np.uint64(3) | np.uint64(size)).view(np.int64)
                for i in range(0, len(keys), 50_000):
                    yield pa.RecordBatch.from_arrays([pa.array(keys[i : i + 50_000]), pa.array(found[i : i + 50_000])], ["key", "n"])

    return texts.select("lang", "text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def closing_counts(texts: DataFrame, frequent: Phrases, proposed: Phrases, longest: int) -> DataFrame:
    """``(lang, phrase, words, n)`` of all phrases that may be frequent, by their words; ``words`` 0: all words of a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            single = np.flatnonzero((chunk.number > 0) & frequent.has(chunk.hashes))
            order = np.full(len(chunk.names), -1)
            order[chunk.ids[::-1]] = np.arange(len(chunk.ids))[::-1]
            words = (1, order[single], chunk.hashes[single], chunk.number[single])
            yield _rows(chunk.lang, pa.array([""]), 0, chunk.number.sum(keepdims=True))
            for size, begin, _, found in chain([words], chunk.counts(frequent, proposed, longest, True)):
                for i in range(0, len(begin), 20_000):
                    yield _rows(chunk.lang, chunk.phrases(begin[i : i + 20_000], size), size, found[i : i + 20_000])

    return texts.select("lang", "text").mapInArrow(run, COUNTS).groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n"))


def _rows(lang: str, phrases: pa.Array, size: int, found: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([lang] * len(phrases)), phrases, pa.array(np.full(len(phrases), size, np.int32)), pa.array(found)]
    return pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "words", "n"])


def _bitmap(keys: DataFrame) -> np.ndarray:
    """The bitmap of the keys. It is put together from blocks, so at most its own size comes to the driver."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        # places count from 1, as the bitmap functions have it
        return pa.RecordBatch.from_arrays([pa.array(_bit(batch.column(0).to_numpy().view(np.uint64)) + 1)], ["at"])

    blocks = (
        map_batches(keys.select("key"), run, "at long")
        .groupBy(F.bitmap_bucket_number("at").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    )
    bitmap = np.zeros((1 << BITS) // 8, np.uint8)
    for r in blocks.toLocalIterator():
        begin = (r["bucket"] - 1) * 4096
        bitmap[begin : begin + 4096] |= np.frombuffer(r["bits"], np.uint8)
    return bitmap


def mine_hashes(texts: DataFrame, least: int, longest: int) -> np.ndarray:
    """The bitmap of all phrases of ``(lang, text)`` with at least so many occurrences, or a few more: a pass for each length."""
    context = texts.sparkSession.sparkContext
    bitmap, upon, before = np.zeros((1 << BITS) // 8, np.uint8), None, None
    for size in range(1, longest + 1):
        found = settle(hashed_counts(texts, upon, before if size > 2 else None, size).where(F.col("n") >= least), "phrase-hashes")
        grown = bitmap | _bitmap(found)
        if (grown == bitmap).all():
            break
        before, upon, bitmap = upon, Phrases(context.broadcast(grown)), grown
    return bitmap


def frequent_phrases(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, longest: int = LONGEST, sample: float = SAMPLE, seed: int = 1) -> DataFrame:
    """``(lang, phrase, words, n)``: every phrase of 1 to ``longest`` words with at least ``least`` occurrences in its language.

    Words are parted by blanks and tabs, pieces by ``.,;:!?`` and line ends; A-Z is lower-cased; phrases lie within a piece, and
    occurrences may overlap. ``longest`` is at most 7. The row with ``words`` 0 and an empty phrase holds the number of all words. ``sample`` is
    the share of rows that proposes phrases, at a count lowered by its spread; it affects the work, not the result. Null languages are ``und``.
    """
    if not 1 <= longest <= 7:
        raise ValueError("phrases have 1 to 7 words")
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text")).where("text is not null")
    context = docs.sparkSession.sparkContext
    expected = least * sample
    drawn = settle(texts.sample(False, sample, seed), "phrase-sample")
    proposed = Phrases(context.broadcast(mine_hashes(drawn, max(2, ceil(expected - sqrt(expected))), longest)))
    found = settle(hashed_counts(texts, proposed, None, longest).where(F.col("n") >= least), "phrase-hashes")
    frequent = Phrases(context.broadcast(_bitmap(found)))
    return closing_counts(texts, frequent, proposed, longest).where((F.col("words") == 0) | (F.col("n") >= least))


def _part(first: int | Column, size: Column) -> Column:
    return F.array_join(F.slice("w", first, size), " ")


def _first(rows: DataFrame, limit: int) -> DataFrame:
    """Of every partition each language's best rows, so that no language is sorted as a whole."""

    def best(kept: list[dict]) -> list[dict]:
        return sorted(kept, key=lambda r: (-r["score"], -r["a"], r["phrase"].encode()))[:limit]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, list[dict]] = {}
        schema = None
        for batch in batches:
            schema = batch.schema
            for r in batch.to_pylist():
                own = kept.setdefault(r["lang"], [])
                own.append(r)
                if len(own) >= 4 * limit:
                    kept[r["lang"]] = best(own)
        for own in kept.values():
            yield pa.RecordBatch.from_pylist(best(own), schema)

    return rows.mapInArrow(run, rows.schema)


def cut_score(a: str, n: str, left: str, right: str) -> Column:
    """``floor(1000 * a * n / (l * r))`` of four columns of longs up to 10 ** 15, without rounding: products have up to 38 digits."""
    long = lambda c: f"cast({c} as decimal(18, 0))"
    return F.expr(f"cast(cast(1000 * {a} as decimal(19, 0)) * {long(n)} div ({long(left)} * {long(right)}) as long)")


def collocations(
    docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, longest: int = LONGEST, sample: float = SAMPLE, covered: int = 100, top: int = TOP
) -> DataFrame:
    """Each language's best phrases: ``lang, rank, phrase, a, l, r, n, score``.

    ``a`` is the phrase's count, ``n`` that of all words, ``l`` and ``r`` those of its parts at the cut with the least score
    ``floor(1000 * a * n / (l * r))``, the first such cut; the arithmetic is exact. A phrase goes if its words lie in a longer frequent
    phrase that occurs ``covered`` % as often or more. The rest are ranked by score, count and phrase, and the first ``top`` are given.

    Null and empty texts have no words; a null language is ``und``; repeated rows count as often as they stand there; a language without
    a frequent phrase of two words has no row, and an empty table gives an empty one. Other columns are not read.
    """
    # cut with its counts: written, since the parts are joined twice
    counts = settle(frequent_phrases(docs, lang, text, least, longest, sample), "phrases")
    total = counts.where("words = 0").select("lang", F.col("n").alias("all_words"))
    parts = counts.where("words > 0").select(F.col("lang").alias("in"), F.col("phrase").alias("part"), F.col("n").alias("part_n"))
    long = counts.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    size = F.col("words") - F.col("cut")
    cuts = long.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "lang", "phrase", "a", "cut", _part(1, F.col("cut")).alias("left"), _part(F.col("cut") + 1, size).alias("right")
    )

    def with_count(rows: DataFrame, side: str, name: str) -> DataFrame:
        found = rows.join(parts, (F.col("lang") == F.col("in")) & (F.col(side) == F.col("part")))
        return found.withColumnRenamed("part_n", name).drop("in", "part", side)

    rated = with_count(with_count(cuts, "left", "l"), "right", "r").join(total, "lang")
    least_cut = rated.select("lang", "phrase", "a", F.struct(cut_score("a", "all_words", "l", "r").alias("score"), "cut", "l", "r", F.col("all_words").alias("n")).alias("at"))
    scored = least_cut.groupBy("lang", "phrase", "a").agg(F.min("at").alias("at")).select("lang", "phrase", "a", "at.l", "at.r", "at.n", "at.score")

    spans = F.expr("flatten(transform(sequence(2, words - 1), k -> transform(sequence(1, words - k + 1), i -> array_join(slice(w, i, k), ' '))))")
    inner = long.where("words > 2").select("lang", F.explode(spans).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(inner, ["lang", "phrase"], "left").where(F.expr(f"longer is null or 100 * longer < {int(covered)} * a")).drop("longer")

    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = _first(kept, top).withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
