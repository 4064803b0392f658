"""URL filter: path rules first, then exact set membership by a cascade of Bloom filters.

The cascade knows the complete universe of keys. Level 1 holds the listed keys; level 2 holds
the unlisted keys that level 1 lets through; level 3 the listed keys that level 2 lets through;
and so on until nothing is let through wrongly. A key is listed if the first level that
rejects it is an even one. Rows are judged by bit tests alone, without a join.

Defined cases: a null url, or one without ``://``, has empty host and path. Repeated rows are each
judged. An empty table gives an empty result; an empty list blocks nothing. Other columns
of the pages are left out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import ascii_lower
from feedloom.session import pinned

BITS_PER_KEY = 12
HASHES = 5
# Bits of one filter at most (8 MB). Larger lists are split into shards by key hash.
SHARD_BITS = 1 << 26

# Fixed values: (verdict, host, path) of the path rules.
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://`` in lower case, and the path up to ``?`` or ``#``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: list[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest fitting rule as text and its verdict, both null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        rule = F.when(fits, F.lit(rule_host + rule_path)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def positions(key: Column, level: int, bits: int) -> list[Column]:
    """Bit positions of a key in the filter of one level."""
    one = F.pmod(F.xxhash64(F.lit(2 * level), key), F.lit(bits))
    two = F.pmod(F.xxhash64(F.lit(2 * level + 1), key), F.lit(bits))
    return [F.pmod(one + F.lit(i) * two, F.lit(bits)) for i in range(HASHES)]


def bloom(keys: DataFrame, level: int, bits: int) -> DataFrame:
    """One row: the filter of the column ``key`` as an array of ``bits / 64`` longs."""
    at = keys.select(F.explode(F.array(*positions(F.col("key"), level, bits))).alias("at"))
    words = at.groupBy(F.expr("at div 64").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("bits")
    )
    empty = keys.sparkSession.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    full = words.unionByName(empty).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    rows = F.array_sort(F.collect_list(F.struct("word", "bits")))
    return full.agg(F.transform(rows, lambda x: x["bits"]).alias("filter"))


def passes(filter_row: DataFrame, key: Column, level: int, bits: int) -> Column:
    """Whether the filter of a level lets a key through."""
    words = filter_row.scalar()

    def test(at: Column) -> Column:
        word = F.get(words, (F.floor(at / 64)).cast("int"))
        return F.expr("1L").bitwiseAND(F.call_function("shiftrightunsigned", word, (at % 64).cast("int"))) == 1

    return reduce(lambda a, b: a & b, [test(at) for at in positions(key, level, bits)])


def filter_bits(keys: int, shard_bits: int) -> int:
    """A power of two near ``BITS_PER_KEY`` bits a key, within the bound."""
    return min(shard_bits, 1 << max(10, (max(keys, 1) * BITS_PER_KEY - 1).bit_length()))


def cascade(universe: DataFrame, shard_bits: int = SHARD_BITS) -> list[tuple[DataFrame, int]]:
    """Filters of all levels over ``key`` and ``listed``; each level ends as a small written table."""
    universe = pinned(universe, "urlkeys")
    inside, outside = universe.filter("listed").select("key"), universe.filter("not listed").select("key")
    levels: list[tuple[DataFrame, int]] = []
    count = inside.count()
    while count:
        level = len(levels)
        bits = filter_bits(count, shard_bits)
        levels.append((pinned(bloom(inside, level, bits), "bloom"), bits))
        wrong = outside.filter(passes(levels[-1][0], F.col("key"), level, bits))
        inside, outside = pinned(wrong, "passed"), inside
        count = inside.count()
    return levels


def listed(levels: list[tuple[DataFrame, int]], key: Column) -> Column:
    """Exact membership for every key of the universe the cascade was built on."""
    found = F.lit(len(levels) % 2 == 1)
    for level in reversed(range(len(levels))):
        through = passes(levels[level][0], key, level, levels[level][1])
        found = F.when(through, found).otherwise(F.lit(level % 2 == 1))
    return found


def mark_listed(rows: DataFrame, keys: DataFrame, shard_bits: int = SHARD_BITS) -> DataFrame:
    """Add the boolean ``listed`` to ``rows`` (column ``key``) from ``keys`` (``key``, ``listed``).

    ``keys`` has every distinct key of ``rows``. A list too long for one filter is split by
    key hash; each shard then has its own cascade and its own pass over the rows.
    """
    total = keys.filter("listed").count()
    shards = -(-total * BITS_PER_KEY // shard_bits) or 1
    if shards == 1:
        return rows.withColumn("listed", listed(cascade(keys, shard_bits), F.col("key")))
    parts = []
    for shard in range(shards):
        def own(df: DataFrame, shard: int = shard) -> DataFrame:
            return df.filter(F.pmod(F.xxhash64(F.lit("shard"), F.col("key")), F.lit(shards)) == shard)

        levels = cascade(own(keys), 2 * shard_bits)
        parts.append(pinned(own(rows).withColumn("listed", listed(levels, F.col("key"))), "judged"))
    return reduce(DataFrame.unionByName, parts)


def judge_pages(pages: DataFrame, is_listed: Column | None = None, shard_bits: int = SHARD_BITS) -> DataFrame:
    """Verdict per page: the longest path rule, else block for listed addresses.

    The key is the address without query, host and path. By default an address is listed when
    a label of its host, or a part of one behind a hyphen, starts with ``spam``; ``is_listed`` may be any expression over
    ``host`` and ``path``.
    """
    if is_listed is None:
        is_listed = F.col("host").rlike("(^|[.-])spam")
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("key", F.concat("host", "path"))
    keys = rows.select("key", "host", "path").groupBy("key").agg(F.max(is_listed).alias("listed"))
    judged = mark_listed(rows, keys, shard_bits)
    rule, verdict = rule_for(F.col("host"), F.col("path"))
    other = F.when(F.col("listed"), "block").otherwise("allow")
    return judged.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, other).alias("verdict"))
