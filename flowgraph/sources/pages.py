"""Stored listing pages: links, crawl rules, and what is still to fetch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgraph.operators.joins import missing_from

# --- fixed values -----------------------------------------------------------------------------
SKIPPED_LINKS = ["../", "SUCCESS", "_SUCCESS"]
FILE_PREFIX = "part-"
FILE_FOLDER = "parquet"
OTHER_FORMAT = "csv"
# Comments and scripts hold no links.
NOT_MARKUP = r"(?is)<!--.*?-->|<script\b.*?</script>"
ANCHOR = r"(?is)<a(?:\s[^>]*)?>"
HREF = r"""(?is)\shref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""


def links(pages: DataFrame) -> DataFrame:
    """One row per anchor of the whole page: (page_id, url, href); no href is an empty link."""
    markup = F.regexp_replace("html", NOT_MARKUP, " ")
    anchors = pages.select(
        "page_id", "url", F.explode(F.regexp_extract_all(markup, F.lit(ANCHOR), F.lit(0))).alias("anchor")
    )
    raw = F.regexp_extract("anchor", HREF, 1)
    bare = F.regexp_replace(raw, r"""^["']|["']$""", "")
    return anchors.select("page_id", "url", F.replace(bare, F.lit("&amp;"), F.lit("&")).alias("href"))


def crawl_frontier(pages: DataFrame) -> DataFrame:
    """Every anchor with its kind: ``skip``, ``dir``, ``file`` or ``other``, and the full url."""
    href = F.col("href")
    kind = (
        F.when(href.isin(SKIPPED_LINKS) | href.contains("?"), "skip")
        .when(href.endswith("/") & F.lower(href).contains(OTHER_FORMAT), "skip")
        .when(href.endswith("/"), "dir")
        .when(href.startswith(FILE_PREFIX) & F.lower("url").contains(FILE_FOLDER), "file")
        .otherwise("other")
    )
    return links(pages).select("page_id", "url", "href", kind.alias("kind"), F.concat("url", "href").alias("full_url"))


def new_only(frontier: DataFrame, existing: DataFrame, key: str = "full_url") -> DataFrame:
    """Targets not fetched yet, each once."""
    return missing_from(frontier.select(key, "kind").distinct(), existing, key)
