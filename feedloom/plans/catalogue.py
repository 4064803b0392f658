"""Venue catalogue from listing pages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from feedloom.functions import html, numeric, temporal
from feedloom.operators import elements
from feedloom.operators.quality import contains_ci
from feedloom.operators.running import numbered
from feedloom.session import pinned


@dataclass(frozen=True)
class Selectors:
    """Where a listing page keeps its fields. The class names of the known listing."""

    container: str = "WineRow_wine-info__title-container__vJsPS"
    region: str = (
        "WineGeneral_--country__s8DLd WineGeneral_--region__MU4gI WineRow_wine-info__region__HL8R7"
    )
    appellation: str = "WineGeneral_--appellation__WaeFi WineRow_wine-info__appellation__CoF7Z"
    score: str = "WineGeneral_--score__5wRg8"
    name_tag: str = "h5"
    brand_tag: str = "h6"


def listing_rows(pages: DataFrame, page_key: str = "page_id", selectors: Selectors = Selectors()) -> DataFrame:
    """One row per titled entry. Each entry's fields come from its own part of the page."""
    entries = pages.select(
        page_key, F.posexplode(html.sections("html", "div", selectors.container)).alias("position", "entry")
    )

    def field(tag: str, css_class: str | None = None) -> Column:
        return html.node_text(html.first_block("entry", tag, css_class))

    return entries.select(
        page_key,
        "position",
        field(selectors.name_tag).alias("name"),
        field(selectors.brand_tag).alias("brand"),
        field("div", selectors.region).alias("region"),
        field("div", selectors.appellation).alias("appellation"),
        field("div", selectors.score).alias("score"),
    ).where("name IS NOT NULL")


def listing_elements(
    pages: DataFrame, container: tuple[str, str | None], fields: dict[str, tuple[str, str | None, str | None]],
    page_key: str = "page_id",
) -> DataFrame:
    """One row per container element with its position on the page; a field is the first element of a tag and class
    inside it: its text, or the named attribute. Containers without any of the fields stay, with NULLs.
    """
    found = pinned(elements.tags(pages, page_key), "tags")
    every = elements.elements(found, page_key)

    def chosen(tag: str, css_class: str | None) -> DataFrame:
        return every.where((F.col("name") == tag) & elements.has_class(css_class))

    outer = chosen(*container).select(page_key, "start", "stop")
    rows = outer.withColumn("position", F.row_number().over(Window.partitionBy(page_key).orderBy("start")) - 1)
    for name, (tag, css_class, attribute) in fields.items():
        inner = elements.within(chosen(tag, css_class), outer, page_key).drop("name")
        first = inner.groupBy(page_key, "outer").agg(F.min_by(F.struct("start", "stop", "attributes"), "start").alias("e"))
        first = first.select(page_key, "outer", "e.*")
        if attribute is None:
            value = elements.texts(first.drop("attributes"), found, page_key).withColumnRenamed("text", name)
        else:
            value = first.withColumn(name, elements.attribute(F.col("attributes"), attribute))
        value = value.select(page_key, F.col("outer").alias("start"), name)
        rows = rows.join(value, [page_key, "start"], "left")
    return rows.drop("start", "stop")


def venue_catalogue(
    pages: DataFrame, opening: Column, open_hours: Column, place: str | None = None,
    page_key: str = "page_id", pages_per_slice: int = 1024, selectors: Selectors = Selectors(),
) -> DataFrame:
    """Catalogue rows numbered from 1, missing scores filled, closing time derived, one place kept.

    ``opening`` and ``open_hours`` are columns over page key, position and the entry's fields.
    """
    rows = numbered(
        listing_rows(pages, page_key, selectors),
        [page_key, "position"],
        [F.floor(F.col(page_key) / pages_per_slice)],
        "Restaurant ID",
    )
    key = F.concat_ws("/", F.col(page_key).cast("string"), F.col("position").cast("string"))
    table = rows.select(
        "Restaurant ID",
        F.col("name").alias("Wine Name"),
        F.col("brand").alias("Company Name"),
        F.col("region").alias("Location"),
        F.col("appellation").alias("Appellation"),
        numeric.imputed_score(numeric.safe_double("score"), key).cast("string").alias("Tasting Score"),
        opening.alias("Opening Time"),
        temporal.closing_time(opening, open_hours).alias("Closing Time"),
    )
    return table if place is None else contains_ci(table, "Location", place)
