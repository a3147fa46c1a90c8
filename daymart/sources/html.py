"""Fields out of landed web pages, by patterns and row by row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymart.functions.dates import parse_stamp
from daymart.functions.text import normalise_name

# Where a news page keeps its items and their fields.
NEWS_ITEM = r"""(?s)<article[^>]*class="(?:[^"]*\s)?stocknewsitem(?:\s[^"]*)?"[^>]*>(.*?)</article>"""
NEWS_FIELDS = {
    "published": r"""(?s)<div[^>]*class="(?:[^"]*\s)?publisheddate(?:\s[^"]*)?"[^>]*>(.*?)</div>""",
    "title": r"""(?s)<div[^>]*class="(?:[^"]*\s)?title(?:\s[^"]*)?"[^>]*>(.*?)</div>""",
    "description": r"""(?s)<div[^>]*class="(?:[^"]*\s)?description(?:\s[^"]*)?"[^>]*>(.*?)</div>""",
    "source": r"""(?s)<img[^>]*alt="([^"]*)\"""",
}

# Up to the next closing tag, in runs instead of by single characters.
TABLE_ROW = r"(?s)<tr[^>]*>((?:[^<]+|<(?!/tr>))*+)</tr>"
ROW_CELL = r"(?s)<t[dh][^>]*>(.*?)</t[dh]>"


def all_matches(html: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(html, F.lit(pattern), F.lit(group))


def plain(fragment: Column) -> Column:
    """Text of a fragment: tags dropped, the common entities decoded.  Most fragments have neither and are only looked through."""
    bare = F.when(F.contains(fragment, F.lit("<")), F.regexp_replace(fragment, r"<[^>]*>", "")).otherwise(fragment)
    text = bare
    for entity, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(sign))
    return F.when(F.contains(fragment, F.lit("&")), text).otherwise(bare)


def items(
    pages: DataFrame, html: str, item: str, fields: Mapping[str, str], keep: Sequence[str] = (), group: int = 0
) -> DataFrame:
    """One row per match of ``item``, one column per field pattern (its first group)."""
    matches = F.posexplode_outer(all_matches(F.col(html), item, group))
    found = pages.select(*keep, matches.alias("item_no", "_item")).where("_item is not null")
    return found.select(*keep, "item_no", *[F.regexp_extract("_item", p, 1).alias(n) for n, p in fields.items()])


def news_items(pages: DataFrame, html: str, ticker: str, url: str) -> DataFrame:
    """News pages -> ``p_date, ticker, title, source, description, url``; filter on ``p_date``
    for the items of one run date; an item whose date cannot be read has none.  ``item_no`` is its place on the page."""
    rows = items(pages, html, NEWS_ITEM, NEWS_FIELDS, keep=(ticker, url), group=0)
    stamp = parse_stamp(F.trim(plain(F.col("published"))))
    return rows.select(
        "item_no",
        F.to_date(stamp).alias("p_date"),
        F.col(ticker).alias("ticker"),
        plain(F.col("title")).alias("title"),
        F.col("source"),
        plain(F.col("description")).alias("description"),
        F.col(url).alias("url"),
    )


def key_values(html: Column) -> Column:
    """All two-column table rows of a page as ``array<struct<name, value>>``."""
    rows = F.transform(all_matches(html, TABLE_ROW), lambda r: all_matches(r, ROW_CELL))
    pairs = F.filter(rows, lambda cells: F.size(cells) == 2)
    return F.transform(
        pairs,
        lambda cells: F.struct(
            normalise_name(F.trim(plain(cells[0]))).alias("name"), F.trim(plain(cells[1])).alias("value")
        ),
    )


def first_values(pairs: Column, names: Sequence[str]) -> Column:
    """The first value under each name, as an array in the order of the names; ``wide`` makes columns of it.

    A column of its own, so that the pairs are looked through once for a page.  Dozens of look-ups side by side would make a
    generated method too large for the JVM to compile.
    """
    page = F.array(F.struct(pairs["name"].alias("names"), pairs["value"].alias("values")))
    wanted = F.array(*[F.lit(name) for name in names])
    found = F.transform(
        page,
        lambda p: F.transform(wanted, lambda name: F.get(p["values"], F.array_position(p["names"], name).cast("int") - 1)),
    )
    return F.get(found, F.lit(0))


def wide(values: Column, names: Sequence[str]) -> list[Column]:
    """One column per name from the column of ``first_values``.  Both the pairs and the wide row belong
    to one page, so no shuffle is needed to turn one into the other."""
    return [F.get(values, F.lit(i)).alias(name) for i, name in enumerate(names)]
