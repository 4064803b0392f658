"""Line deduplication by winnowing over line hashes.

Every line gets a hash of its form with single spaces. A window starts at each line and takes lines until it
has ``min_words`` words, and another ends at each line and takes lines above it likewise; the smallest hash in a
window is its fingerprint. Two places that share a run of at least ``min_words`` words hold equal windows there,
so they select the same fingerprints: the match is guaranteed. Fingerprints met at one place alone end the
search; at the others the windows that also stand at an earlier place are joined. Each line of a shared run lies
in the window that starts the run or in one that ends at the line, both inside the run, so the union of these
windows is the whole run, to both ends; all its places but the first are deleted.

So a line is deleted if and only if it lies in a run of lines of ``min_words`` words that stands earlier too, in an
earlier document (smaller id) or above in the same one.

Defined cases: a null text has no lines and stays null. Blank lines count for nothing and stay. A null id
sorts behind all others. Rows equal in id and text are one document: each copy gets the same result. An
empty table gives an empty result. Other columns are kept by ``without_repeats``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.session import pinned

MIN_WORDS = 50
DOC = ["doc_id", "text_key"]


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def line_marks(text: Column) -> Column:
    """Two hashes and the number of words of every line."""
    spaces = r"\x20*[\x09\x0B-\x0D][\x20\x09\x0B-\x0D]*|\x20{2,}"
    clean = F.transform(F.split(text, "\n"), lambda x: F.trim(F.regexp_replace(x, spaces, " ")))
    return F.transform(clean, lambda x: F.struct(
        F.xxhash64(x).alias("hash"), F.xxhash64(F.lit(1), x).alias("check"),
        F.when(x == "", 0).otherwise(F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1).alias("words"),
    ))


def windows(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Windows of ``min_words`` words: first and last line, fingerprint with its place, and content key.

    One starts at each line and takes the fewest lines after it; one ends at each line and takes the fewest
    before it. Those that end at a line and also start as one of the others are given once.
    """
    rows = docs.filter("text is not null").select("doc_id", text_key(F.col("text")).alias("text_key"), line_marks(F.col("text")).alias("lines"))
    rows = rows.filter(F.aggregate("lines", F.lit(0), lambda total, x: total + x["words"]) >= min_words).dropDuplicates(DOC)
    lines = rows.select(*DOC, F.posexplode("lines").alias("line", "mark")).filter("mark.words > 0")
    lines = lines.select(*DOC, "line", "mark.hash", "mark.check", "mark.words")
    above = Window.partitionBy(*DOC).orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*DOC)
    lines = lines.withColumn("before", F.coalesce(F.sum("words").over(above), F.lit(0)))
    lines = lines.withColumn("total", F.sum("words").over(whole)).withColumn("upto", F.col("before") + F.col("words"))
    ahead = Window.partitionBy(*DOC).orderBy("before").rangeBetween(Window.currentRow, min_words - 1)
    back = Window.partitionBy(*DOC).orderBy("upto").rangeBetween(1 - min_words, Window.currentRow)

    def window(span) -> Column:
        return F.struct(
            F.min("line").over(span).alias("line"), F.max("line").over(span).alias("last"),
            F.min(F.struct("hash", "line")).over(span).alias("mark"),
            F.collect_list(F.struct("hash", "check")).over(span).alias("run"),
        )

    found = lines.select(
        *DOC, (F.col("total") - F.col("before") >= min_words).alias("starts"), window(ahead).alias("ahead"),
        # Without its last line it has the words already, so no window that starts at a line equals it.
        (F.col("before") - F.min("before").over(back) >= min_words).alias("ends"), window(back).alias("back"),
    )
    both = F.array(F.when(F.col("starts"), F.col("ahead")), F.when(F.col("ends"), F.col("back")))
    found = found.select(*DOC, F.explode(F.array_compact(both)).alias("w"))
    return found.select(
        *DOC, "w.line", "w.last", F.col("w.mark.hash").alias("fingerprint"), F.col("w.mark.line").alias("at"),
        F.xxhash64("w.run").alias("run_key"), F.xxhash64(F.lit(1), F.col("w.run")).alias("run_check"),
    )


def place(line: str) -> Column:
    """Order of places: documents by id, then lines."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key", F.col(line).alias("line"))


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Per document with repeats: the runs of lines (first, last) to delete, in order."""
    found = pinned(windows(docs, min_words), "windows")
    marks = found.groupBy("fingerprint").agg(F.min(place("at")).alias("low"), F.max(place("at")).alias("high"))
    shared = marks.filter("low != high").select("fingerprint")
    met = pinned(found.join(shared, "fingerprint", "left_semi"), "met")
    origins = met.groupBy("run_key", "run_check").agg(F.min(place("line")).alias("origin"), F.count(F.lit(1)).alias("n"))
    later = met.join(origins.filter("n > 1"), ["run_key", "run_check"]).filter(place("line") != F.col("origin"))
    order = Window.partitionBy(*DOC).orderBy("line")
    reach = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    steps = later.select(*DOC, "line", "last", F.when(F.col("line") <= reach + 1, 0).otherwise(1).alias("opens"))
    steps = steps.withColumn("run", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    runs = steps.groupBy(*DOC, "run").agg(F.min("line").alias("first"), F.max("last").alias("last"))
    return runs.groupBy(*DOC).agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("runs"))


def left_lines(text: Column, runs: Column) -> Column:
    """Lines of a text outside the runs."""
    lines = F.split(text, "\n")
    starts = F.concat(F.array(F.lit(0)), F.transform(runs, lambda r: r["last"] + 1))
    ends = F.concat(F.transform(runs, lambda r: r["first"]), F.array(F.size(lines)))
    pairs = F.arrays_zip(starts.alias("s"), ends.alias("e"))
    return F.flatten(F.transform(pairs, lambda p: F.slice(lines, p["s"] + 1, F.greatest(p["e"] - p["s"], F.lit(0)))))


def with_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows as struct ``doc`` with their ``runs``, null where nothing repeats."""
    runs = repeated_runs(docs.select("doc_id", "text"), min_words).select(
        F.col("doc_id").alias("run_id"), F.col("text_key").alias("run_text"), "runs")
    rows = docs.select(F.struct("*").alias("doc"))
    same = F.col("doc.doc_id").eqNullSafe(F.col("run_id")) & (text_key(F.col("doc.text")) == F.col("run_text"))
    return rows.join(runs, same, "left").select("doc", "runs")


def line_report(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Per document: lines, deleted lines, and SHA-256 of the text that is left (null text counts as empty)."""
    text = F.coalesce("doc.text", F.lit(""))
    deleted = F.aggregate("runs", F.lit(0), lambda total, r: total + r["last"] - r["first"] + 1)
    left = F.when(F.col("runs").isNull(), text).otherwise(F.array_join(left_lines(text, F.col("runs")), "\n"))
    return with_runs(docs.select("doc_id", "text"), min_words).select(
        "doc.doc_id", F.size(F.split(text, "\n")).cast("long").alias("n_lines"),
        F.coalesce(deleted, F.lit(0)).cast("long").alias("n_deleted"), F.sha2(left, 256).alias("left_sha256"),
    )


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents, all columns, with repeated runs deleted and ``n_chars`` brought up to date.

    A document that keeps no word goes: all it had stands in earlier ones.
    """
    left = F.when(F.col("runs").isNotNull(), F.array_join(left_lines(F.col("doc.text"), F.col("runs")), "\n"))
    rows = with_runs(docs, min_words).withColumn("left", left)
    rows = rows.filter("runs is null or left rlike '[^ \\\\t-\\\\r]'")
    new = [F.coalesce("left", "doc.text").alias(c) if c == "text"
           else F.when(F.col("left").isNotNull(), F.length("left").cast(docs.schema[c].dataType)).otherwise(F.col("doc.n_chars")).alias(c) if c == "n_chars"
           else F.col(f"doc.`{c}`") for c in docs.columns]
    return rows.select(*new)
