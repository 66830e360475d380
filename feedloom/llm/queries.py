"""One thin query per corpus operator: it applies the operator to its whole table and derives the digests."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.archive import audit, laid_out, numbered, warc_record
from feedloom.llm.classifier import fit, in_fold, quality_scores
from feedloom.llm.collocations import collocations
from feedloom.llm.common import settle, table
from feedloom.llm.jaccard import jaccard_components
from feedloom.llm.lines import drop_repeated_lines
from feedloom.llm.manifest import dataset_manifest, leaf_hash, verify
from feedloom.llm.neighbours import nearest
from feedloom.llm.packing import pack_documents
from feedloom.llm.pii import KINDS, find_pii, span_text
from feedloom.llm.quality import rated
from feedloom.llm.repeats import remove_repeats
from feedloom.llm.tokenfiles import read_token_documents, write_token_files
from feedloom.llm.tokens import bpe_decode, bpe_encode

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(run):
        QUERIES[run.__name__] = run
        if sql:
            SQL[run.__name__] = sql
        return run

    return add


@query(
    r"""
    WITH lines AS (
      SELECT doc_id, i, l, translate(trim(l, E' \t\n\x0b\x0c\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
      FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), E'\n')) AS l,
                   unnest(range(len(string_split(coalesce(text, ''), E'\n')))) AS i FROM documents)),
    common AS (
      SELECT key, max(doc_id) AS last FROM lines WHERE length(key) >= 40
      GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
    marked AS (
      SELECT doc_id, i, l, common.key IS NOT NULL AND doc_id <> common.last AS gone
      FROM lines LEFT JOIN common ON common.key = lines.key)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
           sha256(coalesce(string_agg(l, E'\n' ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
    FROM marked GROUP BY doc_id"""
)
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query(
    r"""
    WITH RECURSIVE words AS (
      SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
    sets AS (
      SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
               ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM words),
    items AS (SELECT doc_id, len(s) AS n, hash(unnest(s)) AS h FROM sets),
    spread AS (SELECT h FROM items GROUP BY h HAVING count(*) > 1),
    pairs AS (
      SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b USING (h)
      WHERE a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n) AND h IN (SELECT h FROM spread)
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
    links AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
    reach AS (SELECT a AS doc_id, a AS c FROM links UNION SELECT b, c FROM reach JOIN links ON links.a = reach.doc_id)
    SELECT s.doc_id, len(s.s) AS n_shingles, coalesce(min(r.c), s.doc_id) AS component_id
    FROM sets s LEFT JOIN reach r ON r.doc_id = s.doc_id GROUP BY s.doc_id, s.s"""
)
def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), size=3, percent=90)


@query(
    r"""
    WITH bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    windows AS (
      SELECT doc_id, i, md5_number(substr(h, CAST(2 * i + 1 AS BIGINT), 800)) AS k
      FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 399)) AS i FROM bytes)),
    often AS (SELECT k FROM windows GROUP BY k HAVING count(*) > 1),
    starts AS (SELECT doc_id, i FROM windows WHERE k IN (SELECT k FROM often)),
    marked AS (
      SELECT *, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 400, true) AS fresh FROM starts),
    runs AS (
      SELECT doc_id, min(i) AS a, max(i) + 400 AS b
      FROM (SELECT *, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY i) AS r FROM marked) GROUP BY doc_id, r),
    gaps AS (
      SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM runs),
    cut AS (
      SELECT doc_id, count(*) AS n_spans, sum(b - a)::BIGINT AS n_removed, max(b) AS last,
             string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept
      FROM gaps JOIN bytes USING (doc_id) GROUP BY doc_id)
    SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
           sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
    FROM bytes LEFT JOIN cut USING (doc_id)"""
)
def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of the documents that are labelled good."""
    return table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")


@query()
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = rated(table(spark, sf_dir, "documents").select("doc_id", "text"), trusted_ids(spark, sf_dir), keep_text=False)
    return verdicts.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio")


@query()
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counted = lambda i: F.size(F.filter("base", lambda x: x["kind"] == i)).cast("long")
    counts = [counted(i).alias(f"n_{kind}") for i, kind in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(span_text(F.col("base")), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))


@query()
def op2_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe_encode(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary, public_tokenizers.PATTERN)
    # written, so that encoding and decoding run in turn: their Python workers share the executors' memory
    decoded = bpe_decode(settle(encoded.drop("text"), "token-ids"), vocabulary, public_tokenizers.PATTERN)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, with_ids=False, added_tokens=True)


@query()
def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def damaged_record(page_id: Column, record: Column) -> Column:
    """What a failing disk makes of some records: one character overwritten, the second half lost, or all of it."""
    size = F.char_length(record)
    return (
        F.when(page_id % 307 == 11, None)
        .when(page_id % 211 == 5, F.substr(record, F.lit(1), F.floor(size / 2).cast("int")))
        .when(page_id % 101 == 7, F.concat(F.substr(record, F.lit(1), F.lit(199)), F.lit("\x00"), F.substr(record, F.lit(201))))
        .otherwise(record)
    )


@query(
    r"""
    WITH records AS (
      SELECT page_id, row_number() OVER (ORDER BY page_id NULLS FIRST, url, html) - 1 AS number,
             'WARC/1.0' || E'\r\n' || 'WARC-Type: response' || E'\r\n' || 'WARC-Record-ID: <urn:record:' || coalesce(page_id::VARCHAR, '') || '>'
             || E'\r\n' || 'WARC-Target-URI: ' || coalesce(url, '') || E'\r\n' || 'Content-Type: text/html' || E'\r\n' || 'Content-Length: '
             || strlen(coalesce(html, ''))::VARCHAR || E'\r\n\r\n' || coalesce(html, '') || E'\r\n\r\n' AS record FROM pages),
    both_sides AS (
      SELECT 'l' AS side, number, record FROM records
      UNION ALL
      SELECT 'r', number, CASE WHEN page_id % 211 = 5 THEN left(record, length(record) // 2)
                               WHEN page_id % 101 = 7 THEN left(record, 199) || chr(0) || substr(record, 201) ELSE record END
      FROM records WHERE coalesce(page_id % 307 <> 11, true)),
    leaf AS (
      SELECT side, number // 256 AS volume, number, strlen(record) AS length, sha256(record) AS digest,
             (coalesce(sum(strlen(record)) OVER (PARTITION BY side, number // 256 ORDER BY number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS off
      FROM both_sides),
    low AS (
      SELECT side, volume, (number % 256) // 16 AS node, min(off) AS a, max(off + length) AS b,
             sha256(min(off) || ':' || max(off + length) || ':' || string_agg(sha256(concat_ws(':', number, off, length, digest, 1)), ',' ORDER BY number)) AS h
      FROM leaf GROUP BY ALL),
    roots AS (
      SELECT side, volume, sha256(min(a) || ':' || max(b) || ':' || string_agg(h, ',' ORDER BY node)) AS h FROM low GROUP BY ALL),
    bad AS (
      SELECT l.volume, string_agg(l.number || ':' || l.off || ':' || CASE WHEN r.number IS NULL THEN 'missing'
               WHEN l.digest <> r.digest THEN 'changed' ELSE 'moved' END, ',' ORDER BY l.number) AS damaged
      FROM (FROM leaf WHERE side = 'l') l LEFT JOIN (FROM leaf WHERE side = 'r') r ON r.number = l.number
      WHERE r.number IS NULL OR l.digest <> r.digest OR l.off <> r.off GROUP BY l.volume)
    SELECT s.volume, count(*) AS n_records, sum(s.length)::BIGINT AS n_bytes, any_value(x.h) AS root, any_value(y.h) AS replica_root,
           coalesce(any_value(x.h) = any_value(y.h), false) AS intact, coalesce(any_value(bad.damaged), '') AS damaged
    FROM leaf s JOIN roots x ON x.side = 'l' AND x.volume = s.volume LEFT JOIN roots y ON y.side = 'r' AND y.volume = s.volume
    LEFT JOIN bad ON bad.volume = s.volume WHERE s.side = 'l' GROUP BY s.volume"""
)
def op6_warc_merkle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = numbered(table(spark, sf_dir, "pages").select("page_id", "url", "html"), ["page_id", "url", "html"])
    record = warc_record(F.col("page_id"), F.col("url"), F.col("html"))
    good = laid_out(pages.select("number", record.cast("binary").alias("record")))
    replica = laid_out(pages.select("number", damaged_record(F.col("page_id"), record).cast("binary").alias("record")).where("record is not null"))
    return audit(good, replica)


@query()
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    space = fit(docs, table(spark, sf_dir, "labels").where(~in_fold(F.col("doc_id"))))
    scored = quality_scores(docs, space)
    return scored.select("doc_id", in_fold(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query()
def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    manifest = write_token_files(docs, public_tokenizers.path("word_bpe_49k.json"))
    return read_token_documents(manifest, docs.schema["doc_id"].dataType.simpleString())


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@query(
    r"""
    WITH RECURSIVE docs AS (
      SELECT *, coalesce('=' || source, '') AS tree,
             (4294967295 - list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
               lambda a, c: list_reduce([xor(a, c)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0],
                 lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))) AS crc FROM documents),
    both_texts AS (SELECT *, CASE WHEN crc % 5 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS now FROM docs),
    leaves AS (
      SELECT doc_id, tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf, sha256(head || coalesce(strlen(now) || ':' || now, '-')) AS claim
      FROM (SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head FROM both_texts)),
    placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves),
    nodes AS (
      SELECT tree, 0 AS level, i, leaf AS h FROM placed
      UNION ALL
      SELECT tree, level + 1, i // 16, sha256(string_agg(h, '' ORDER BY i))
      FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM nodes) WHERE n > 1 GROUP BY tree, level, i // 16),
    heights AS (SELECT tree, max(level) AS height FROM nodes GROUP BY tree),
    subroots AS (SELECT tree, height, h, row_number() OVER (ORDER BY tree) - 1 AS i FROM nodes JOIN heights USING (tree) WHERE level = height),
    tops AS (
      SELECT 0 AS level, i, h FROM subroots
      UNION ALL
      SELECT level + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)) FROM (SELECT *, count(*) OVER () AS n FROM tops) WHERE n > 1 GROUP BY level, i // 16),
    root AS (SELECT h AS root FROM tops ORDER BY level DESC LIMIT 1),
    up AS (SELECT max(level) AS height FROM tops),
    steps AS (
      SELECT p.doc_id, p.i AS leaf_at, p.tree, n.level, string_agg(n.h, '' ORDER BY n.i) FILTER (n.i < (p.i >> (4 * n.level))) AS l,
             string_agg(n.h, '' ORDER BY n.i) FILTER (n.i > (p.i >> (4 * n.level))) AS r
      FROM placed p JOIN heights USING (tree)
      JOIN nodes n ON n.tree = p.tree AND n.level < height AND n.i // 16 = (p.i >> (4 * n.level + 4)) GROUP BY ALL),
    top_steps AS (
      SELECT s.tree, s.height + t.level AS level, string_agg(t.h, '' ORDER BY t.i) FILTER (t.i < (s.i >> (4 * t.level))) AS l,
             string_agg(t.h, '' ORDER BY t.i) FILTER (t.i > (s.i >> (4 * t.level))) AS r
      FROM subroots s, up JOIN tops t ON t.level < up.height AND t.i // 16 = (s.i >> (4 * t.level + 4)) GROUP BY ALL),
    path AS (
      SELECT doc_id, leaf_at, tree, level, coalesce(l, '') AS l, coalesce(r, '') AS r FROM steps
      UNION ALL
      SELECT p.doc_id, p.i, p.tree, t.level, coalesce(l, ''), coalesce(r, '') FROM placed p JOIN top_steps t USING (tree)),
    fold AS (
      SELECT tree, i, 0 AS level, claim AS h FROM placed
      UNION ALL
      SELECT f.tree, f.i, f.level + 1, sha256(l || h || r) FROM fold f JOIN path ON path.tree = f.tree AND path.leaf_at = f.i AND path.level = f.level),
    proofs AS (SELECT tree, leaf_at, sha256(string_agg(l || r, '' ORDER BY level)) AS proof FROM path GROUP BY ALL)
    SELECT p.doc_id, p.leaf, s.h AS subroot, root.root, coalesce(proof, sha256('')) AS proof_sha256, f.h AS folded_root, f.h = root.root AS verified
    FROM placed p JOIN subroots s USING (tree) CROSS JOIN root CROSS JOIN up
    JOIN fold f ON f.tree = p.tree AND f.i = p.i AND f.level = s.height + up.height
    LEFT JOIN proofs ON proofs.tree = p.tree AND proofs.leaf_at = p.i"""
)
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = lambda text: [*map(F.col, ("doc_id", "source", "lang", "n_chars")), text]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    leaf = leaf_hash(*fields(F.col("text")))
    claim = F.when(tampered, leaf_hash(*fields(lower_ascii(F.col("text"))))).otherwise(leaf)
    rows = settle(table(spark, sf_dir, "documents").select("doc_id", "source", leaf.alias("leaf"), claim.alias("claimed")), "manifest-rows")
    found = verify(dataset_manifest(rows, "source", ["doc_id"]), "claimed")
    return found.select("doc_id", F.lower(F.hex("leaf")).alias("leaf"), "subroot", "root", "proof_sha256", "folded_root", "verified")


@query(
    r"""
    WITH pieces AS (
      SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
    words AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
    phrases AS (
      SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS phrase
      FROM words, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k),
    f AS (SELECT lang, k, phrase, count(*) AS c FROM phrases GROUP BY ALL),
    totals AS (SELECT lang, sum(c)::HUGEINT AS n FROM f WHERE k = 1 GROUP BY lang),
    often AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND c >= 100),
    cuts AS (
      SELECT lang, phrase, c, cut, array_to_string(w[1 : cut], ' ') AS a_part, array_to_string(w[cut + 1 :], ' ') AS b_part
      FROM (SELECT *, unnest(range(1, k)) AS cut FROM often)),
    scored AS (
      SELECT cuts.lang, cuts.phrase, cuts.c AS a, cut, x.c AS l, y.c AS r, n, 1000::HUGEINT * cuts.c * n // (x.c::HUGEINT * y.c) AS score
      FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = a_part JOIN f y ON y.lang = cuts.lang AND y.phrase = b_part JOIN totals ON totals.lang = cuts.lang),
    best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
    inner_parts AS (
      SELECT lang, array_to_string(w[i : i + size - 1], ' ') AS phrase, max(c) AS longer
      FROM (SELECT *, unnest(range(1, k - size + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS size FROM often)) GROUP BY ALL),
    kept AS (SELECT best.* FROM best LEFT JOIN inner_parts USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
    FROM kept QUALIFY rank <= 2000"""
)
def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("lang", "text"))
