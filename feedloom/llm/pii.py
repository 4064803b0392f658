"""Personal data: base patterns, and bootstrapped contextual extraction on top.

Base spans (email, ip, card, phone) are the seeds. The two words before a seed are a lexical pattern of its
kind. A pattern's confidence for a kind is the share of all its occurrences in the corpus, whatever follows,
that are followed by an identifier of that kind, where an unknown identifier counts with its score.
An identifier's score is the chance that one of its patterns is right: 1 - product of (1 - confidence). Both
are computed in turn over the graph of patterns and instances. Unknown tokens with a digit or an ``@`` that
score at least ``ACCEPT`` become spans of that kind, with all their occurrences in confident patterns.

Everything is column expressions: matches and the text between them come from ``regexp_extract_all`` and
``split``, positions from a running sum of their lengths. One pass cuts a text into pieces that end in tokens with a digit
or an ``@``; the patterns run over those ends alone, each once. They are possessive and do not restart inside a run, so
long texts cost one pass.

Defined cases: a null text counts as empty. Repeated rows and repeated or null ids give a row each. An empty
table gives an empty result. ``redacted`` keeps all other columns.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import LOWER, UPPER, ascii_lower
from feedloom.llm.url_filter import filter_bits
from feedloom.session import pinned

KINDS = ["email", "ip", "card", "phone"]
# A match starts where no character of its first class stands before, or where the last match ended.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "other": r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+",
}
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+", "other": None}
OTHER = "other"
BYTE_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
# A pattern needs so many different seeds; context reaches so many characters.
SUPPORT = 3
CONTEXT = 80
# Every match lies in tokens with a digit or an ``@`` and what joins them in a phone or card. A piece runs from the one before
# to the last of such tokens that follow each other; the next one begins more than CONTEXT characters behind it.
PIECE = rf"\G[^0-9@]*+[0-9@]\S*+(?:[\x20().-]*+[^0-9@]{{0,{CONTEXT}}}+[^\s0-9@]*+[0-9@]\S*+)*+"
# A piece from its first such token.
TOKENS = r"(?s)^(?:[^\s0-9@]*+\s++)*+(.*+)"
ROUNDS = 3
ACCEPT = 0.6
FILTER_BITS = 1 << 23
SPACES = "\t\n\x0b\x0c\r"


def pieces_of(text: Column) -> Column:
    """The text up to its last digit or ``@`` in pieces; null without any, which one quick look tells."""
    return F.when(text.rlike("[0-9@]"), F.regexp_extract_all(text, F.lit(PIECE), F.lit(0)))


def found_in(text: Column, kind: str) -> Column:
    """Matches of one kind in order."""
    found = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
    if NEEDS[kind]:
        found = F.when(F.instr(text, NEEDS[kind]) > 0, found).otherwise(F.array().cast("array<string>"))
    return found


def hits(found: Column, between: Column, kind: str) -> Column:
    """Matches of one kind: number, length of the text between, match, and the words before it."""
    rows = F.arrays_zip(found.alias("value"), F.slice(between, 1, F.size(found)).alias("gap"))
    return F.transform(rows, lambda x, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("number"), F.length(x["gap"]).alias("gap"), x["value"].alias("value"),
        F.right(x["gap"], F.lit(CONTEXT)).alias("left"),
    ))


def is_valid(kind: Column, value: Column) -> Column:
    """The checks behind the patterns; a match that fails is dropped."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    return (
        F.when(kind == "ip", value.rlike(rf"^{BYTE_PART}(?:\.{BYTE_PART}){{3}}$"))
        .when(kind == "card", F.length(digits).between(16, 19) & F.call_function("luhn_check", digits))
        .when(kind == "phone", F.length(digits).between(8, 15))
        .otherwise(True)
    )


def slot_of(left: Column) -> Column:
    """Key of the two words right before a position; null with fewer."""
    words = ascii_lower(F.regexp_extract(left, r"(?:^|\s)(\S+\s+\S+\s+)$", 1))
    pair = F.regexp_replace(F.trim(F.regexp_replace(words, r"\s+", " ")), r"\s+$", "")
    return F.when(words != "", F.xxhash64(F.split_part(pair, F.lit(" "), F.lit(1)), F.split_part(pair, F.lit(" "), F.lit(2))))


def occurrences(rows: DataFrame) -> DataFrame:
    """All matches with start and end; a row without any keeps one line with null kind.

    ``rows`` has the document's key columns and ``text``. The patterns see the end of a piece alone: its tokens and
    ``CONTEXT`` characters before the first. Every step is a column of its own, so that no pattern runs twice.
    """
    keys = [c for c in rows.columns if c != "text"]
    pieces = rows.select(*keys, pieces_of(F.coalesce("text", F.lit(""))).alias("pieces"))
    pieces = pieces.select(*keys, F.posexplode_outer("pieces").alias("piece", "whole"))
    pieces = pieces.withColumn("tokens", F.length(F.regexp_extract("whole", TOKENS, 1)))
    pieces = pieces.select(*keys, "piece", F.length("whole").alias("size"), F.right("whole", F.col("tokens") + CONTEXT).alias("near"))
    found = pieces.select("*", *[found_in(F.col("near"), k).alias(f"found_{k}") for k in PATTERNS])
    found = found.select("*", *[F.when(F.size(f"found_{k}") > 0, F.split("near", PATTERNS[k], -1)).otherwise(
        F.array().cast("array<string>")).alias(f"between_{k}") for k in PATTERNS])
    every = F.concat(*[hits(F.col(f"found_{k}"), F.col(f"between_{k}"), k) for k in PATTERNS])
    found = found.select(*keys, "piece", "size", F.length("near").alias("near"), F.explode_outer(every).alias("hit"))
    found = found.select(*keys, "piece", "size", "near", "hit.*").withColumn("slot", slot_of(F.col("left"))).drop("left")
    # Ends inside a piece, and where pieces end: each has an unknown token, whose first one brings its size.
    order = Window.partitionBy(*keys, "piece", "kind").orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    inside = F.sum(F.col("gap") + F.length("value")).over(order)
    to_here = Window.partitionBy(*keys).orderBy("piece").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    until = F.sum(F.when((F.col("kind") == OTHER) & (F.col("number") == 0), F.col("size"))).over(to_here)
    found = found.withColumn("inside", inside).withColumn("until", until)
    end = F.col("until") - F.col("near") + F.col("inside")
    found = found.withColumn("end", end).withColumn("start", end - F.length("value"))
    found = found.filter(F.col("kind").isNull() | is_valid(F.col("kind"), F.col("value")))
    return found.select(*keys, "kind", "value", "end", "start", "slot")


def with_unknown(found: DataFrame, keys: list[str]) -> DataFrame:
    """Drop unknown tokens that touch a base span."""
    base = F.col("kind") != OTHER
    by_start = Window.partitionBy(*keys).orderBy("start", "end")
    reach = F.max(F.when(base, F.col("end"))).over(by_start.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    ahead = F.min(F.when(base, F.col("start"))).over(by_start.rangeBetween(Window.currentRow, Window.unboundedFollowing))
    touched = (F.coalesce(reach, F.lit(0)) > F.col("start")) | (F.coalesce(ahead, F.col("end")) < F.col("end"))
    return found.withColumn("touched", touched).filter(F.col("kind").isNull() | base | ~F.col("touched")).drop("touched")


def slot_places(slot: Column, bits: int) -> list[Column]:
    """Bit positions of a slot: parts of the key, which is a hash already. ``bits`` is a power of two."""
    return [F.shiftrightunsigned(slot, n).bitwiseAND(F.lit(bits - 1)) for n in (0, 21, 42)]


def slot_filter(slots: DataFrame, bits: int) -> DataFrame:
    """One row: the bits of all slots as an array of ``bits / 64`` longs."""
    at = slots.select(F.explode(F.array(*slot_places(F.col("slot"), bits))).alias("at"))
    set_bits = at.select(F.expr("at div 64").alias("word"), F.expr("shiftleft(1L, cast(at % 64 as int))").alias("bits"))
    empty = slots.sparkSession.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    full = set_bits.unionByName(empty).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    return full.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda x: x["bits"]).alias("filter"))


def may_be_slot(filter_row: DataFrame, slot: Column, bits: int) -> Column:
    """Whether all bits of a slot are set."""
    words = filter_row.scalar()

    def test(at: Column) -> Column:
        word = F.get(words, F.shiftrightunsigned(at, 6).cast("int"))
        return F.call_function("shiftrightunsigned", word, at.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1

    return reduce(lambda a, b: a & b, [test(at) for at in slot_places(slot, bits)])


def word_pairs(texts: DataFrame) -> DataFrame:
    """Key of every two words side by side, split at white space, in ASCII lower case."""
    plain = F.translate("text", UPPER + SPACES, LOWER + " " * len(SPACES))
    words = texts.filter("text is not null").select(F.array_remove(F.split(plain, " "), "").alias("w"))
    pairs = words.select(F.inline(F.arrays_zip(F.col("w").alias("a"), F.expr("slice(w, 2, greatest(size(w) - 1, 0))").alias("b"))))
    return pairs.filter("b is not null").select(F.xxhash64("a", "b").alias("slot"))


def slot_counts(texts: DataFrame, slots: DataFrame) -> DataFrame:
    """How often each slot's two words stand side by side in the corpus.

    A filter of bits drops nearly all other word pairs ahead of the join.
    """
    bits = filter_bits(slots.count(), FILTER_BITS)
    known = pinned(slot_filter(slots, bits), "slotbits")
    pairs = word_pairs(texts).filter(may_be_slot(known, F.col("slot"), bits))
    # Written first, so the join meets one row per slot and not one per occurrence.
    counted = pinned(pairs.groupBy("slot").agg(F.count(F.lit(1)).alias("total")), "slotcounts")
    return counted.join(slots, "slot", "left_semi")


def discovered(found: DataFrame, texts: DataFrame) -> DataFrame:
    """(value, slot, kind) of unknown identifiers found by confident patterns."""
    seeds = found.filter((F.col("kind") != OTHER) & F.col("slot").isNotNull())
    support = seeds.groupBy("kind", "slot").agg(F.countDistinct("value").alias("different"))
    support = pinned(support.filter(F.col("different") >= SUPPORT).select("kind", "slot"), "support")
    slots = pinned(support.select("slot").distinct(), "slots")
    totals = pinned(slot_counts(texts, slots), "totals")
    # The graph: how often a value stands in a slot, and whether it is a seed of the kind.
    known = seeds.groupBy("kind", "slot").agg(F.count(F.lit(1)).alias("sure")).join(support, ["kind", "slot"], "left_semi")
    patterns = pinned(known.join(totals, "slot"), "patterns")
    unknown = found.filter((F.col("kind") == OTHER) & F.col("slot").isNotNull())
    edges = pinned(unknown.groupBy("value", "slot").agg(F.count(F.lit(1)).alias("times")).join(slots, "slot", "left_semi"), "edges")
    confidence = patterns.select("kind", "slot", (F.col("sure") / F.col("total")).alias("p"))
    scores = None
    for _ in range(ROUNDS):
        doubt = F.sum(F.log1p(-F.least("p", F.lit(0.999))))
        scores = pinned(edges.join(confidence, "slot").groupBy("value", "kind").agg((1 - F.exp(doubt)).alias("score")), "scores")
        likely = edges.join(scores, "value").groupBy("kind", "slot").agg(F.sum(F.col("times") * F.col("score")).alias("more"))
        confidence = pinned(patterns.join(likely, ["kind", "slot"], "left").select(
            "kind", "slot", F.least(F.lit(1.0), (F.col("sure") + F.coalesce("more", F.lit(0.0))) / F.col("total")).alias("p")), "confidence")
    best = scores.groupBy("value").agg(F.max_by("kind", F.struct("score", "kind")).alias("kind"), F.max("score").alias("score"))
    good = best.filter(F.col("score") >= ACCEPT).select("value", "kind")
    return edges.join(good, "value").join(confidence.filter(F.col("p") >= ACCEPT), ["kind", "slot"]).select("value", "slot", "kind")


def all_spans(rows: DataFrame) -> DataFrame:
    """Base and discovered spans: the key columns, kind, start, end, base; rows without any keep one line."""
    keys = [c for c in rows.columns if c != "text"]
    found = pinned(with_unknown(occurrences(rows), keys), "spans")
    new = pinned(discovered(found, rows.select("text")), "discovered")
    base = found.filter(F.col("kind").isNull() | (F.col("kind") != OTHER)).withColumn("base", F.lit(True))
    more = found.filter(F.col("kind") == OTHER).drop("kind").join(new, ["value", "slot"]).withColumn("base", F.lit(False))
    # A row whose only matches are unknown tokens still needs its line.
    bare = found.filter(F.col("kind") == OTHER).select(*keys).distinct()
    lines = [base.select(*keys, "kind", "start", "end", "base"), more.select(*keys, "kind", "start", "end", "base"),
             bare.select(*keys, *(F.lit(None).cast(t).alias(c) for c, t in (("kind", "string"), ("start", "long"), ("end", "long"), ("base", "boolean"))))]
    return reduce(DataFrame.unionByName, lines)


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` by kind as listed, then start."""
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def find(docs: DataFrame) -> DataFrame:
    """Per document: base counts, digest of the base spans, and all spans."""
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text")
    spans = all_spans(rows).withColumn("rank", F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")))
    one = F.struct("rank", "start", "end", "kind")
    own = spans.groupBy("uid", "doc_id").agg(
        *[F.count_if(F.col("base") & (F.col("kind") == k)).alias(f"n_{k}") for k in KINDS],
        F.collect_list(F.when(F.col("base") & F.col("kind").isNotNull(), one)).alias("base"),
        F.collect_list(F.when(F.col("kind").isNotNull(), one)).alias("every"),
    )
    return own.select("doc_id", *[f"n_{k}" for k in KINDS],
                      F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"), spans_text(F.col("every")).alias("spans"))


def redacted(docs: DataFrame) -> DataFrame:
    """The documents, all columns, with every span replaced by its kind in brackets and ``n_chars`` brought up to date.

    Overlapping spans become one mark, that of the first.
    """
    number = F.xxhash64(F.coalesce("text", F.lit("")))
    rows = docs.select(number.alias("row"), "text").withColumn("part", F.monotonically_increasing_id())
    spans = all_spans(rows).filter(F.col("kind").isNotNull())
    # Rows of one text have the same spans.
    spans = spans.groupBy("row", "start").agg(F.max(F.struct("end", "kind")).alias("x")).select("row", "start", "x.end", "x.kind")
    reach = F.max("end").over(Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    opens = spans.withColumn("opens", F.when(F.coalesce(reach, F.lit(0)) > F.col("start"), 0).otherwise(1))
    run = F.sum("opens").over(Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, 0))
    merged = opens.withColumn("run", run).groupBy("row", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("kind", "start").alias("kind"))
    marks = merged.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end", "kind"))).alias("marks"))
    joined = docs.select(F.struct("*").alias("doc"), number.alias("row")).join(marks, "row", "left")
    text = F.col("doc.text")
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform("marks", lambda m: m["end"]))
    kept = F.transform("marks", lambda m, i: F.concat(
        F.substring(text, (F.get(ends, i) + 1).cast("int"), (m["start"] - F.get(ends, i)).cast("int")),
        F.lit("["), F.upper(m["kind"]), F.lit("]")))
    tail = F.substring(text, (F.element_at(ends, -1) + 1).cast("int"), F.length(text))
    joined = joined.withColumn("clean", F.when(F.col("marks").isNotNull(), F.concat(F.array_join(kept, ""), tail)))
    new = [F.coalesce("clean", "doc.text").alias(c) if c == "text"
           else F.when(F.col("clean").isNotNull(), F.length("clean").cast(docs.schema[c].dataType)).otherwise(F.col("doc.n_chars")).alias(c) if c == "n_chars"
           else F.col(f"doc.`{c}`") for c in docs.columns]
    return joined.select(*new)
