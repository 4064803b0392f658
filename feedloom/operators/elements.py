"""Elements of HTML pages as rows, each up to its own closing tag.

Comments, scripts and styles go first. A page is then cut before every tag; the tags become rows, all of a page in one
task, and a running depth per tag name pairs each opening tag with its closing one: among the tags of one name and
depth, openings and closings take turns. Names and attribute names are read in any case, values in either
quotes or none.

Defined cases: an element that is never closed runs to the end of its page; a closing tag without an opening one
counts for nothing; void elements hold nothing; a NULL page has no elements. ``key`` is unique per page.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame, Window, functions as F

# Elements without content.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")

_MASKED = r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\z)|<[!?][^>]*>"
_TAG = r"""(?s)^<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)>"""
_REFERENCE = r"(?s)^&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);(.*)$"
_SPACE = r"[\s\p{Z}]+"


def decoded(text: Column) -> Column:
    """Character references as their characters, each once; unknown ones stay."""
    names = F.create_map(*[F.lit(x) for name, code in sorted(name2codepoint.items()) for x in (name, chr(code))])

    def one(part: Column) -> Column:
        name, rest = F.regexp_extract(part, _REFERENCE, 1), F.regexp_extract(part, _REFERENCE, 2)
        digits = F.when(name.rlike("^#[xX]"), F.conv(F.substring(name, 3, 9), 16, 10)).otherwise(F.substring(name, 2, 9))
        code = digits.cast("bigint")
        known = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        char = F.when(known, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        value = F.when(name.startswith("#"), char).otherwise(names[name])
        return F.when(value.isNotNull(), F.concat(value, rest)).otherwise(part)

    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(F.split(text, "(?=&)"), one), "")).otherwise(text)


def attribute(attributes: Column, name: str) -> Column:
    """Value of one attribute of a tag; NULL without it."""
    pattern = rf"""(?is)(?:^|[\s"'/]){name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    value = F.concat(*[F.regexp_extract(attributes, pattern, k) for k in (1, 2, 3)])
    return F.when(attributes.rlike(pattern), decoded(value))


def tags(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, position, name, step, attributes, text) of every tag, with the text behind it.

    ``step`` is 1 for an opening tag, -1 for a closing one and 0 for a void one. A page's tags share a task.
    """
    cut = F.split(F.regexp_replace(F.col(html), _MASKED, ""), "(?=</?[a-zA-Z])")
    rows = pages.select(F.col(key), cut.alias("_pieces")).repartition(F.col(key)).select(key, F.posexplode("_pieces").alias("position", "piece"))
    name = F.lower(F.regexp_extract("piece", _TAG, 2))
    attributes = F.regexp_extract("piece", _TAG, 3)
    is_tag = F.col("piece").rlike(_TAG)
    step = F.when(~is_tag | name.isin(*VOID), 0).when(F.regexp_extract("piece", _TAG, 1) == "/", -1)
    return rows.select(
        key, "position", F.when(is_tag, name).otherwise("").alias("name"),
        step.when(attributes.rlike(r"(?:^|\s)/$"), 0).otherwise(1).alias("step"), attributes.alias("attributes"),
        F.when(is_tag, F.regexp_replace("piece", _TAG, "")).otherwise(F.col("piece")).alias("text"),
    )


def elements(found: DataFrame, key: str = "page_id") -> DataFrame:
    """(key, name, attributes, start, stop) of every element of ``tags``; what it holds stands in start <= position < stop."""
    order = Window.partitionBy(key, "name").orderBy("position")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = found.where("name <> ''").withColumn("_sum", F.sum("step").over(so_far))
    # A stray closing tag takes the sum below zero; from there on it counts from that floor.
    rows = rows.withColumn("_floor", F.least(F.lit(0), F.min("_sum").over(so_far)))
    level = F.when(F.col("step") > 0, F.col("_sum") - F.col("_floor")).otherwise(F.col("_sum") + 1 - F.lag("_floor", 1, 0).over(order))
    paired = rows.where("step <> 0").withColumn("_level", level).where("_level > 0")
    turn = Window.partitionBy(key, "name", "_level").orderBy("position")
    paired = paired.withColumns({"_next": F.lead("position").over(turn), "_next_step": F.lead("step").over(turn)})
    end = F.lit(2**31 - 1)
    opened = paired.where("step > 0").select(
        key, "name", "attributes", F.col("position").alias("start"), F.when(F.col("_next_step") < 0, F.col("_next")).otherwise(end).alias("stop"))
    void = rows.where("step = 0").select(key, "name", "attributes", F.col("position").alias("start"), F.col("position").alias("stop"))
    return opened.unionByName(void)


def has_class(wanted: str | None) -> Column:
    """Whether an element has a class among its own, or several exactly as written."""
    if wanted is None:
        return F.lit(True)
    value = F.coalesce(attribute(F.col("attributes"), "class"), F.lit(""))
    return value == wanted if " " in wanted else F.array_contains(F.split(value, r"\s+"), wanted)


def texts(selected: DataFrame, found: DataFrame, key: str = "page_id") -> DataFrame:
    """The selected elements with their ``text``: pieces stripped and joined, references decoded, NULL if empty."""
    pieces = found.select(F.col(key).alias("_key"), "position", F.regexp_replace("text", f"^{_SPACE}|{_SPACE}$", "").alias("_text")).where("_text <> ''")
    inside = (F.col(key) == F.col("_key")) & (F.col("position") >= F.col("start")) & (F.col("position") < F.col("stop"))
    own = [c for c in selected.columns if c not in (key, "start")]
    joined = selected.join(pieces, inside, "left").groupBy(key, "start").agg(
        *[F.first(c).alias(c) for c in own], F.array_sort(F.collect_list(F.struct("position", "_text"))).alias("_parts"))
    text = decoded(F.array_join(F.transform("_parts", lambda p: F.when(p["position"].isNotNull(), p["_text"])), ""))
    return joined.withColumn("text", F.nullif(text, F.lit(""))).drop("_parts")


def select(
    pages: DataFrame, name: str, css_class: str | None = None, key: str = "page_id", html: str = "html",
    attributes: tuple[str, ...] = (),
) -> DataFrame:
    """(key, start, stop, text, and the named attributes) of every element of a name and class, in page order."""
    found = tags(pages, key, html)
    wanted = elements(found, key).where((F.col("name") == name) & has_class(css_class))
    wanted = wanted.withColumns({a: attribute(F.col("attributes"), a) for a in attributes}).drop("attributes", "name")
    return texts(wanted, found, key)


def within(inner: DataFrame, outer: DataFrame, key: str = "page_id") -> DataFrame:
    """Elements of ``inner`` inside an element of ``outer``, with the outer one's start as ``outer``."""
    places = outer.select(F.col(key).alias("_key"), F.col("start").alias("outer"), F.col("stop").alias("_stop"))
    inside = (F.col(key) == F.col("_key")) & (F.col("start") > F.col("outer")) & (F.col("start") < F.col("_stop"))
    return inner.join(places, inside).drop("_key", "_stop")
