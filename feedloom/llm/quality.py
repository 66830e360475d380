"""Quality rules: counts per text, and a hashed n-gram likelihood ratio between a trusted and the raw corpus.

Everything here is built-in Spark functions.
"""

from __future__ import annotations

from math import log, sqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import BLANKS, settle

PAIR = r"[^\x20\x09-\x0D]++[\x20\x09-\x0D]++[^\x20\x09-\x0D]++"
FIRST_WORD = r"^[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
KINDS = 3  # of n-grams: words, pairs of words, pairs of word shapes
BUCKETS = 1 << 14  # hash buckets of each kind; the model has KINDS times as many numbers
SMOOTHING = 0.5  # added to every bucket of the raw counts
PRIOR = 1000  # n-grams with the raw shares that are added to the trusted counts
RULES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
MILLION = 1_000_000
# of the table of buckets: sorted numbers are written as their differences, which are small
PACKED = {"parquet.writer.version": "PARQUET_2_0", "parquet.enable.dictionary#__buckets.list.element": "false", "parquet.block.size": str(32 << 20), "compression": "zstd"}
FILTER_BITS = 25  # of the bitmap that passes over documents whose id is not trusted
DEVIATIONS = 3  # a text of the target is rarely rated further below the mean of the trusted documents


def words_of(text: Column) -> Column:
    # cutting at one fixed character takes less time than at a pattern
    for blank in BLANKS.replace(" ", ""):
        text = F.replace(text, F.lit(blank), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def shapes_of(text: Column) -> Column:
    """The text with each run of capitals, other letters or digits as one ``A``, ``a`` or ``9``; marks count as letters."""
    # the longest runs first, which leaves little for the other passes; no character is of two kinds
    for pattern, mark in ((r"[a-z[^\x00-\x7f\p{Lu}\p{N}\p{P}\p{S}\p{Z}]]++", "a"), (r"[A-Z\p{Lu}]++", "A"), (r"[0-9\p{N}]++", "9")):
        text = F.regexp_replace(text, pattern, mark)
    return text


def rule_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed``.

    Words in three-word windows that occur twice are found by sorting the hashes of a text's windows inside its row:
    nothing is shuffled. A null text counts as empty.
    """
    kept = docs.drop(*RULES)
    value = F.coalesce(F.col(text), F.lit(""))
    size = lambda c: F.char_length(c).cast("long")
    lines = F.filter(F.split(value, "\n"), lambda line: F.ltrim(line, F.lit(BLANKS)) != "")
    # translating a text takes several times as long as joining its words or passing over all but the symbols
    counted = kept.select(*kept.columns, words_of(value).alias("__words"), lines.alias("__lines")).select(
        *kept.columns,
        "__words",
        F.size("__words").cast("long").alias("n_words"),
        size(F.array_join("__words", "")).alias("word_chars"),
        size(F.regexp_replace(value, f"[^{SYMBOLS}]++", "")).alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
    )
    word = lambda i: F.get("__words", i)
    starts = F.when(F.size("__words") > 2, F.sequence(F.lit(0), F.size("__words") - 3)).otherwise(F.array().cast("array<int>"))
    hashed = counted.withColumn("__hashes", F.transform(starts, lambda i: F.xxhash64(word(i), word(i + 1), word(i + 2))))
    # the hash itself is compared; the position only tells where it was
    numbered = F.transform("__hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    has_repeat = F.size(F.array_distinct("__hashes")) < F.size("__hashes")
    ordered = hashed.withColumn("__sorted", F.when(has_repeat, F.sort_array(numbered)).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    at = lambda j: F.get(F.col("__sorted"), j).getField("h")
    again = F.filter("__sorted", lambda x, j: x.getField("h").eqNullSafe(at(j - 1)) | x.getField("h").eqNullSafe(at(j + 1)))
    repeats = ordered.withColumn("__again", F.transform(again, lambda x: x.getField("i")))
    covered = F.flatten(F.transform("__again", lambda i: F.array(i, i + 1, i + 2)))
    return repeats.withColumn("n_repeat_words", F.size(F.array_distinct(covered)).cast("long")).select(
        *kept.columns,
        *RULES[:-1],
        ((F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))).alias("base_failed"),
    )


def with_buckets(rows: DataFrame, text: str) -> DataFrame:
    """The rows with ``__buckets``: the hash buckets of a text's words, of its words with the next one, and of its pairs of word shapes.

    They are sorted. Words are lower-cased; the last one's neighbour is the text's end. Each kind has ``BUCKETS`` buckets of its own.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    bucket = lambda kind, *gram: F.xxhash64(*gram).bitwiseAND(BUCKETS - 1) + kind * BUCKETS
    # the words are a column of their own, so that a look at a neighbour does not split the text again
    split = rows.select("*", words_of(F.lower(value)).alias("__lower"), shapes_of(value).alias("__shapes"))
    words = F.transform("__lower", lambda word: bucket(0, word))
    pairs = F.transform("__lower", lambda word, i: bucket(1, word, F.get("__lower", i + 1)))
    # every other pair of shapes from the first word on, and from the second: faster than a look ahead at each word
    found = lambda shapes: F.regexp_extract_all(shapes, F.lit(PAIR), F.lit(0))
    shapes = (F.transform(found(x), lambda pair: bucket(2, pair)) for x in (F.col("__shapes"), F.regexp_replace("__shapes", FIRST_WORD, "")))
    # all numbers become integers at once: a cast of each would be evaluated word by word
    buckets = F.sort_array(F.concat(words, pairs, *shapes).cast("array<int>"))
    return split.select(*rows.columns, buckets.alias("__buckets"))


def with_runs(rows: DataFrame, text: str) -> DataFrame:
    """The rows with ``__runs``: the distinct buckets of ``with_buckets`` and how often each occurs in the text, counted inside the row."""
    return _runs(with_buckets(rows, text))


def _runs(rows: DataFrame) -> DataFrame:
    kept = [c for c in rows.columns if c != "__buckets"]
    after = F.when(F.size("__buckets") > 0, F.sequence(F.lit(1), F.size("__buckets"))).otherwise(F.array().cast("array<int>"))
    ends = F.filter(after, lambda i: ~F.get("__buckets", i).eqNullSafe(F.get("__buckets", i - 1)))
    n = lambda end, k: (end - F.coalesce(F.get("__ends", k - 1), F.lit(0))).alias("n")
    runs = F.transform("__ends", lambda end, k: F.struct(F.get("__buckets", end - 1).alias("bucket"), n(end, k)))
    return rows.select("*", ends.alias("__ends")).select(*kept, runs.alias("__runs"))


def _likely(docs: DataFrame, trusted: DataFrame) -> tuple[DataFrame, Column]:
    """The documents, and a condition that holds for all with a trusted id and for a few others.

    A bitmap of hashed ids tells them apart where they are read. It has ``2 ** FILTER_BITS`` bits at any size, 4 MB, so it may be
    broadcast; the more ids, the more others pass.
    """
    if docs.schema["doc"].dataType != trusted.schema["trusted"].dataType:  # equal values may then have unlike hashes
        return docs, F.lit(True)
    place = lambda column: F.pmod(F.xxhash64(column), F.lit(1 << FILTER_BITS)) + 1  # noqa: E731  # from 1, as the bitmap functions count
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(place("trusted"))).alias("__bits")
    bitmap = settle(trusted.groupBy(F.bitmap_bucket_number(place("trusted")).alias("__bucket")).agg(bits), "trusted-bitmap")
    marked = docs.select("*", F.bitmap_bucket_number(place("doc")).alias("__bucket"), F.bitmap_bit_position(place("doc")).cast("int").alias("__at"))
    byte = F.conv(F.hex(F.expr("substring(__bits, __at div 8 + 1, 1)")), 16, 10).cast("int")
    return marked.join(F.broadcast(bitmap), "__bucket", "left"), F.coalesce(F.getbit(byte, F.col("__at") % 8) == 1, F.lit(False))


def ngram_model(docs: DataFrame, trusted_ids: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[list[int], float]:
    """``(weights, threshold)``: by bucket the log ratio, in millionths, of its share in the trusted rows to its share in all rows.

    The threshold is 0, below which the raw corpus explains a text better than the target. Where the trusted rows are few,
    also a text of the target has n-grams that they lack: every trusted document is therefore rated by the others (its own
    counts taken away), and the threshold is ``DEVIATIONS`` standard deviations below the mean if that is less than 0.
    Documents with fewer than ``MIN_WORDS`` words fail by the base rules and have no say.
    """
    return _model(settle(with_buckets(docs.select(doc_id, text), text).drop(text), "buckets", **PACKED), trusted_ids, doc_id)


def _model(hashed: DataFrame, trusted_ids: DataFrame, doc_id: str) -> tuple[list[int], float]:
    """``ngram_model`` of a written table with the buckets of all rows, which it reads twice.

    All n-grams of all rows are counted with partial results. Only rows whose id may be trusted meet the trusted ids, see
    ``_likely``, and are written, as they are needed twice. The others are counted where they are read. There are ``KINDS * BUCKETS`` numbers at any size.
    """
    trusted = settle(trusted_ids.toDF("trusted").where("trusted is not null").distinct(), "trusted-ids")
    narrow, likely = _likely(hashed.select(F.col(doc_id).alias("doc"), "__buckets"), trusted)
    # merged by document, so that the rows of one lie together
    near = narrow.where(likely).select("doc", "__buckets").join(trusted.hint("merge"), F.col("doc") == F.col("trusted"), "left")
    rows = F.count(F.lit(1)).over(Window.partitionBy("doc")).alias("rows")
    met = settle(near.select("doc", "__buckets", F.col("trusted").isNotNull().alias("t"), rows), "met", **PACKED)
    far = narrow.where(~likely).select(F.lit(False).alias("t"), "__buckets")
    counted = (
        far.unionByName(met.select("t", "__buckets"))
        .select("t", F.explode("__buckets").alias("bucket"))
        .groupBy("bucket")
        .agg(F.count_if("t").alias("trusted"), F.count(F.lit(1)).alias("raw"))
    )
    counts = settle(counted, "ngram-counts")
    found = counts.collect()
    total_t, total_r = sum(r["trusted"] for r in found), sum(r["raw"] for r in found)
    weights = [0] * (KINDS * BUCKETS)
    for r in found:
        raw = (r["raw"] + SMOOTHING) / (total_r + SMOOTHING * KINDS * BUCKETS)
        weights[r["bucket"]] = round(MILLION * log((r["trusted"] + PRIOR * raw) / (total_t + PRIOR) / raw))
    # one row for each trusted document and bucket, less its own count; sums of whole numbers do not depend on an order
    # written, as inline would filter by the runs first, and so compute them again
    told = settle(_runs(met.where("t")), "ngram-runs").select("doc", "rows", F.inline("__runs"))
    # only the rows of an id that has several are grouped: a hash table of all ids and buckets would fill the memory
    several = told.where("rows > 1").groupBy("doc", "bucket").agg(F.sum("n").alias("n"))
    own = told.where("rows = 1").select("doc", "bucket", F.col("n").cast("long").alias("n")).unionByName(several)
    share = (F.col("raw") + SMOOTHING) / (total_r + SMOOTHING * KINDS * BUCKETS)
    weight = MILLION * F.log((F.col("trusted") - F.col("n") + PRIOR * share) / share)
    # halves away from 0, as round does, which makes a decimal number of each double
    whole = F.when(F.col("weight") < 0, F.ceil(F.col("weight") - 0.5)).otherwise(F.floor(F.col("weight") + 0.5))
    rest = F.round(MILLION * F.log(total_t - F.col("size") + PRIOR)).cast("long")
    ratings = (
        own.join(F.broadcast(counts), "bucket")
        .select("doc", "n", weight.alias("weight"))
        .groupBy("doc")
        .agg(F.sum("n").alias("size"), F.sum(F.col("n") * whole).alias("sum"))
        .where(F.col("size") >= KINDS * MIN_WORDS - 1)
        .select((F.expr("sum div size") - rest).cast("decimal(18, 0)").alias("ratio"))
    )
    number, total, squares = ratings.agg(F.count("ratio"), F.sum("ratio"), F.sum(F.col("ratio") * F.col("ratio"))).first()
    if not number:
        return weights, 0.0
    total, squares = int(total), int(squares)
    spread = sqrt((number * squares - total * total) / (number * max(number - 1, 1)))
    return weights, min(0.0, round((total / number - DEVIATIONS * spread) / MILLION, 6))


def ratio(buckets: str, weights: list[int]) -> Column:
    """The mean weight of a text's n-grams; 0 for a text without any. Sums of whole numbers do not depend on an order."""
    table = F.split(F.lit(",".join(map(str, weights))), ",").cast("array<bigint>")  # folded into one constant
    total = F.aggregate(buckets, F.lit(0).cast("long"), lambda s, b: s + F.get(table, b))
    return F.when(F.size(buckets) == 0, 0.0).otherwise(total / F.size(buckets) / MILLION)


def rated(
    docs: DataFrame, trusted_ids: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float | None = None, keep_text: bool = True
) -> DataFrame:
    """``quality_rules``, not yet written: a filter on it would compute the ratio twice.

    Every text is split and hashed once: its counts and buckets are written, for the model and for the rating. Without
    ``keep_text`` the text is not written beside them.
    """
    hashed = with_buckets(rule_counts(docs.drop("ratio", "kept"), text), text)
    hashed = settle(hashed if keep_text else hashed.drop(text), "buckets", **PACKED)
    weights, least = _model(hashed, trusted_ids, doc_id)
    counted = hashed.withColumn("ratio", ratio("__buckets", weights)).drop("__buckets")
    return counted.withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= (least if threshold is None else threshold)))


def quality_rules(
    docs: DataFrame, trusted_ids: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float | None = None
) -> DataFrame:
    """The documents with the rule counts, ``ratio`` and ``kept``: whether they pass the base rules and the ratio.

    ``trusted_ids`` has one column, the ids of the target corpus. The target's n-grams are counted against those of all
    documents; a document whose mean log ratio is below ``threshold`` is rejected; without one, ``ngram_model`` takes it
    from the trusted documents. Rows keep all their columns; those named like a new one are replaced.

    Null and empty texts have no words and fail the base rules. Repeated rows are judged alike. With no trusted rows
    every ratio is 0. Null ids are judged like others. An empty table gives an empty table.
    """
    return settle(rated(docs, trusted_ids, doc_id, text, threshold), "rated")
