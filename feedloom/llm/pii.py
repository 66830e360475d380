"""Personal data: fixed forms with exact places, and further identifiers found from the contexts of the known ones.

Everything here is built-in Spark functions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import BLANKS, settle

KINDS = ("email", "ip", "card", "phone")  # in this order where spans start together

# The forms. Quantifiers are possessive and matches start where a run starts: this finds what the plain forms find, in
# linear time and without deep recursion.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
# A token with a digit or an at sign, from a token's start.
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
TRIM_LEFT, TRIM_RIGHT = "^[\"'(\\[<{]++", "[.,;:!?\"')\\]>}]++$"

MIN_DIGITS = 6  # of an identifier without an at sign
CONTEXT_CHARS = 120  # a context is two words; only so many characters before a token are searched for them
ROUNDS = 3
MIN_SEEDS = 3  # distinct known identifiers that a context must have had
MIN_CONFIDENCE = 0.8

BLOCK = 256  # array entries that are gathered at once

_PLACE = "struct<start:int,stop:int,hit:string,before:string>"
_ITEM = "struct<start:int,found:int,stop:int,item:string,kind:int,before:string>"


def scanned(items: Column, start: Column, step: Callable[[Column, Column], Column], emit: Callable[[Column, Column], Column], kind: str) -> Column:
    """What ``emit`` makes of each item and the state before it; nulls go. ``step`` gives the state after an item.

    Arrays can only grow by being copied, so items are taken ``BLOCK`` at a time: the state at each block's begin first, then
    the blocks, each by itself.
    """
    last = F.floor((F.size(items) - 1) / BLOCK).cast("int")
    cut = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(items, i * BLOCK + 1, F.lit(BLOCK)))
    after = lambda block, state: F.aggregate(block, state, step)

    def grow(states: Column, block: Column) -> Column:
        return F.concat(states, F.array(after(block, F.element_at(states, -1))))

    def inner(block: Column, state: Column) -> Column:
        begin = F.struct(state.alias("at"), F.array().cast(f"array<{kind}>").alias("out"))
        more = lambda s, x: F.struct(step(s["at"], x).alias("at"), F.concat(s["out"], F.array(emit(s["at"], x))).alias("out"))
        return F.aggregate(block, begin, more, lambda s: F.array_compact(s["out"]))

    def whole(blocks: Column) -> Column:
        states = F.aggregate(blocks, F.array(start), grow)
        return F.flatten(F.transform(F.arrays_zip(blocks.alias("block"), states.alias("state")), lambda z: F.when(z["block"].isNotNull(), inner(z["block"], z["state"])).otherwise(F.array())))

    return F.when(F.size(items) > 0, _bound(cut, whole)).otherwise(F.array().cast(f"array<{kind}>"))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate a value once and use it many times."""
    return F.element_at(F.transform(F.array(value), use), 1)


def located(text: Column, pattern: str) -> Column:
    """The matches with their places in code points and the text since the match before.

    The text between the matches gives their places: its pieces and the matches alternate.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.zip_with(hits, F.split(text, pattern, -1), lambda hit, gap: F.struct(hit.alias("hit"), gap.alias("gap")))
    length = lambda c: F.coalesce(F.char_length(c), F.lit(0))

    def place(at: Column, part: Column) -> Column:
        begin = at + length(part["gap"])
        stop = begin + length(part["hit"])
        found = F.struct(begin.alias("start"), stop.alias("stop"), part["hit"].alias("hit"), F.right(part["gap"], F.lit(CONTEXT_CHARS)).alias("before"))
        return F.when(part["hit"].isNotNull(), found)

    found = _bound(parts, lambda p: scanned(p, F.lit(0), lambda at, x: at + length(x["gap"]) + length(x["hit"]), place, _PLACE))
    return F.when(F.regexp_like(text, F.lit(pattern)), found).otherwise(F.array().cast(f"array<{_PLACE}>"))


def luhn(digits: Column) -> Column:
    back = F.reverse(digits)
    digit = lambda i: F.substr(back, i, F.lit(1))
    value = lambda i: F.when(i % 2 == 0, F.translate(digit(i), "0123456789", "0246813579")).otherwise(digit(i)).cast("int")
    return F.aggregate(F.sequence(F.lit(1), F.char_length(back)), F.lit(0), lambda total, i: total + value(i)) % 10 == 0


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]++", "")


def _between(count: Column, low: int, high: int) -> Column:
    return (count >= low) & (count <= high)


_VALID: dict[str, Callable[[Column], Column]] = {
    "email": lambda hit: F.lit(True),
    "ip": lambda hit: F.regexp_like(hit, F.lit(rf"^{OCTET}(?:\.{OCTET}){{3}}$")),
    "card": lambda hit: F.when(_between(F.char_length(_digits(hit)), 14, 19), luhn(_digits(hit))).otherwise(False),
    "phone": lambda hit: _between(F.char_length(_digits(hit)), 10, 15),
}


def base_spans(docs: DataFrame, text: str = "text", name: str = "base") -> DataFrame:
    """The documents with an array of the fixed forms: ``kind`` (its number), ``start``, ``stop``, ``hit``, ``before``.

    Ordered by start, then kind. Places count code points, the stop is exclusive. A null text counts as empty.
    """
    value = F.coalesce(F.col(text), F.lit(""))

    def of(number: int, kind: str) -> Column:
        valid = F.filter(located(value, PATTERNS[kind]), lambda x: _VALID[kind](x["hit"]))
        fields = {"start": "start", "kind": None, "stop": "stop", "hit": "hit", "before": "before"}
        return F.transform(valid, lambda x: F.struct(*((x[f] if f else F.lit(number)).alias(n) for n, f in fields.items())))

    each = [of(number, kind) for number, kind in enumerate(KINDS)]
    return docs.withColumn(name, F.sort_array(F.concat(*each)))


def _contexts(before: Column) -> Column:
    """The one and the two words before a place, lower-cased and marked; none at the start of a text."""
    words = F.filter(F.split(F.translate(F.lower(before), BLANKS, " " * len(BLANKS)), " +"), lambda w: w != "")
    one, two = F.element_at(words, -1), F.concat_ws(" ", F.slice(words, -2, 2))
    return F.when(F.size(words) == 0, F.array().cast("array<string>")).when(F.size(words) == 1, F.array(F.concat(F.lit("1 "), one))).otherwise(
        F.array(F.concat(F.lit("1 "), one), F.concat(F.lit("2 "), two))
    )


def _occurrences(found: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``(doc, row, start, stop, item, kind, contexts)``: known identifiers, and tokens like identifiers (kind null)."""
    value = F.coalesce(F.col(text), F.lit(""))
    field = lambda start, found, stop, item, kind, before: F.struct(
        start.alias("start"), F.lit(found).alias("found"), stop.alias("stop"), item.alias("item"), kind.cast("int").alias("kind"), before.alias("before")
    )
    known = F.transform("base", lambda x: field(x["start"], 0, x["stop"], x["hit"], x["kind"], x["before"]))
    trimmed = lambda hit: F.regexp_replace(F.regexp_replace(hit, TRIM_LEFT, ""), TRIM_RIGHT, "")
    lead = lambda hit: F.char_length(hit) - F.char_length(F.regexp_replace(hit, TRIM_LEFT, ""))

    def token(x: Column) -> Column:
        start, item = x["start"] + lead(x["hit"]), trimmed(x["hit"])
        return field(start, 1, start + F.char_length(item), item, F.lit(None), x["before"])

    like = F.filter(F.transform(located(value, TOKEN), token), lambda x: (F.char_length(_digits(x["item"])) >= MIN_DIGITS) | F.contains(x["item"], F.lit("@")))
    rows = found.select(F.col(doc_id).alias("doc"), F.xxhash64(text).alias("row"), F.explode(_apart(F.concat(known, like))).alias("x"))
    return rows.select("doc", "row", "x.start", "x.stop", "x.item", "x.kind", _contexts(F.col("x.before")).alias("contexts"))


def _apart(items: Column) -> Column:
    """The items without found tokens that overlap a known form: one pass in order of places, one backwards."""
    unknown = lambda x: x["found"] == 1
    behind = lambda rows: scanned(
        rows, F.lit(0), lambda at, x: F.when(unknown(x), at).otherwise(F.greatest(at, x["stop"])), lambda at, x: F.when(~unknown(x) | (at <= x["start"]), x), _ITEM
    )
    ahead = lambda rows: scanned(
        rows, F.lit(2**31 - 1), lambda at, x: F.when(unknown(x), at).otherwise(F.least(at, x["start"])), lambda at, x: F.when(~unknown(x) | (at >= x["stop"]), x), _ITEM
    )
    return _bound(F.sort_array(items), lambda rows: _bound(F.reverse(behind(rows)), ahead))


def discovered(occurrences: DataFrame) -> DataFrame:
    """``(item, kind)``: unknown identifiers whose contexts are those of known ones.

    Contexts and items form a graph. A context's confidence for a kind is the share of its items' confidence, known items
    having 1; an unknown item's confidence is the mean of its contexts that ``MIN_SEEDS`` known items or more have had.
    Some rounds of this; an item is found when it reaches ``MIN_CONFIDENCE``. Every step is a join and a
    partial aggregate over pre-counted edges, so a common context is not a hot group.
    """
    edges = settle(
        occurrences.select("item", F.explode("contexts").alias("context")).groupBy("item", "context").agg(F.count(F.lit(1)).alias("n")), "pii-edges"
    )
    known = settle(occurrences.where("kind is not null").groupBy("item").agg(F.min("kind").alias("kind")), "pii-known")
    totals = edges.groupBy("context").agg(F.sum("n").alias("total"))
    seeds = (
        edges.join(known, "item").groupBy("context", "kind").agg(F.count(F.lit(1)).alias("seeds")).where(F.col("seeds") >= MIN_SEEDS)
    )
    ready = settle(seeds.join(totals, "context").select("context", "kind", "total"), "pii-contexts")
    open_edges = settle(edges.join(known, "item", "left_anti").join(ready.select("context").distinct(), "context", "left_semi"), "pii-open")
    sure = known.withColumn("confidence", F.lit(1.0))
    belief = sure
    for _ in range(ROUNDS):
        contexts = (
            edges.join(belief, "item")
            .groupBy("context", "kind")
            .agg(F.sum(F.col("n") * F.col("confidence")).alias("sum"))
            .join(ready, ["context", "kind"])
            .select("context", "kind", (F.col("sum") / F.col("total")).alias("share"))
        )
        weight = open_edges.groupBy("item").agg(F.sum("n").alias("all"))
        guesses = (
            open_edges.join(contexts, "context")
            .groupBy("item", "kind")
            .agg(F.sum(F.col("n") * F.col("share")).alias("sum"))
            .join(weight, "item")
            .select("item", "kind", F.round(F.col("sum") / F.col("all"), 9).alias("confidence"))
        )
        guesses = settle(guesses, "pii-guesses")
        belief = sure.unionByName(guesses)
    best = guesses.where(F.col("confidence") >= MIN_CONFIDENCE).groupBy("item").agg(F.max(F.struct("confidence", (-F.col("kind")).alias("k"))).alias("m"))
    return best.select("item", (-F.col("m.k")).alias("kind"))


def find_pii(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with ``base`` and ``spans``: arrays of ``(start, kind, stop)`` in code points, stop exclusive.

    ``base`` holds the fixed forms (see ``PATTERNS``), leftmost and not overlapping within a kind; ``spans`` also the
    identifiers discovered by context, under the kind whose contexts they have. Both are ordered by start, then kind (its
    number in ``KINDS``). Columns of ``docs`` named like these two are replaced.

    Null and empty texts have empty arrays. Repeated rows and null ids are treated like others. An empty table gives an
    empty table.
    """
    kept = docs.drop("base", "spans")
    found = base_spans(kept, text)
    occurrences = settle(_occurrences(found, doc_id, text), "pii-places")
    new = discovered(occurrences)
    more = (
        occurrences.where("kind is null")
        .drop("kind")
        .join(new, "item")
        .groupBy(F.col("doc").alias("__doc"), F.col("row").alias("__row"))
        .agg(F.collect_set(F.struct("start", "kind", "stop")).alias("__more"))
    )
    plain = F.transform("base", lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["stop"].alias("stop")))
    joined = found.withColumn("base", plain).join(
        settle(more, "pii-found"), F.col(doc_id).eqNullSafe(F.col("__doc")) & F.xxhash64(text).eqNullSafe(F.col("__row")), "left"
    )
    both = F.concat("base", F.coalesce("__more", F.array().cast("array<struct<start:int,kind:int,stop:int>>")))
    return joined.select(*kept.columns, "base", F.sort_array(both).alias("spans"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    name = lambda k: F.element_at(F.array(*map(F.lit, KINDS)), k + 1)
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", name(x["kind"]), x["start"].cast("string"), x["stop"].cast("string"))), ",")


def redact_pii(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, with every span replaced by its kind in square brackets; overlapping spans become one."""
    found = find_pii(docs, doc_id, text)
    value = F.col(text)
    name = lambda k: F.element_at(F.array(*map(F.lit, KINDS)), k + 1)
    # the text is cut once for each block of spans, so that no piece is looked for from the text's begin
    span = "struct<start:int,kind:int,stop:int,after:int>"
    known = F.transform("spans", lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["stop"].alias("stop"), F.lit(0).alias("after")))
    apart = scanned(
        known,
        F.lit(0),
        lambda at, x: F.greatest(at, x["stop"]),
        lambda at, x: F.when((x["start"] >= at) | (x["stop"] > at), F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["stop"].alias("stop"), at.alias("after"))),
        span,
    )

    def cleaned(spans: Column) -> Column:
        last = F.floor((F.size(spans) - 1) / BLOCK).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(spans, i * BLOCK + 1, F.lit(BLOCK)))

        def of_block(block: Column) -> Column:
            begin, end = F.element_at(block, 1)["after"], F.element_at(block, -1)["stop"]

            def pieces(part: Column) -> Column:
                # a span that begins inside the one before it only carries that one's cover on
                gap = lambda x: F.substr(part, x["after"] - begin + 1, F.greatest(x["start"] - x["after"], F.lit(0)))
                mark = lambda x: F.when(x["start"] >= x["after"], F.concat(F.lit("["), name(x["kind"]), F.lit("]"))).otherwise("")
                return F.array_join(F.transform(block, lambda x: F.concat(gap(x), mark(x))), "")

            return _bound(F.substr(value, begin + 1, end - begin), pieces)

        return F.concat(F.array_join(F.transform(blocks, of_block), ""), F.substr(value, F.element_at(spans, -1)["stop"] + 1))

    return found.withColumn(text, F.when(F.size("spans") > 0, _bound(apart, cleaned)).otherwise(value)).select(docs.columns)
