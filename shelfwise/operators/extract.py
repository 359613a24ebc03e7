"""Field extraction from stored pages and label blocks.

The reference fetches pages over HTTP and walks a DOM per row. Here the
pages are a table ``(page_id, url, html)`` and every field is a built-in
regex/array expression evaluated inside the scan's tasks (codegen, no Python
per row). Label blocks ``(title_id, pos, text)`` - one row per
``Label: value`` block of a detail page, in page order - are folded into one
record per title by a single ``groupBy`` with ordered ``min_by``/``max_by``
aggregates: one shuffle, combined map-side.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import parse
from shelfwise.functions.text import html_text, let, strip_ws

# --- fixed values that must equal the reference's -----------------------
# Crawl 1: text after a label (first block containing it) and digits-only fields.
TEXT_LABELS = {"media_type": "Type:", "studio": "Studios:", "premiered": "Premiered:",
               "duration": "Duration:", "status": "Status:", "rating": "Rating:"}
DIGIT_LABELS = {"episodes": "Episodes:", "popularity": "Popularity:", "members": "Members:",
                "favorites": "Favorites:"}
# Crawl 2: exact block keys (last one wins) and the words that merge into genres.
KV_KEYS = {"media_type": "Type", "studio": "Studios", "premiered": "Premiered", "episodes": "Episodes",
           "status": "Status", "duration": "Duration", "rating": "Rating", "favorites": "Favorites",
           "ranking": "Ranked", "members": "Members", "popularity": "Popularity"}
GENRE_WORDS = ("Genre", "Genres", "Demographic", "Theme")
HASH_PREFIXED = ("ranking", "popularity")          # '#12' → '12'
COMMA_INT_FIELDS = ("episodes", "ranking", "popularity", "favorites", "members")
MISSING_TEXT = "N/A"
# -------------------------------------------------------------------------

#: Attributes of an opening tag, quoted values whole (a ``>`` in one does not end the tag).
_ATTRS = r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+"


def _needs(cls: str | None, attrs: dict[str, str] | None) -> str:
    """Look-aheads into an opening tag: every class name in ``cls``, attributes equal to ``attrs``."""
    need = "".join(rf"(?=[^>]*\sclass\s*=\s*(?:\"(?:[^\"]*\s)?{re.escape(name)}[\s\"]|'(?:[^']*\s)?{re.escape(name)}[\s']|{re.escape(name)}[\s>]))"
                   for name in (cls or "").split())
    return need + "".join(rf"(?=[^>]*\s{re.escape(name)}\s*=\s*(?:\"{re.escape(value)}\"|'{re.escape(value)}'))"
                          for name, value in (attrs or {}).items())


def open_tag_pattern(tag: str, cls: str | None = None, attrs: dict[str, str] | None = None) -> str:
    """Pattern of the opening tag of a ``<tag>`` element whose class list holds every name in ``cls``
    (blank-separated) and whose attributes equal ``attrs``, in any order and with either kind of quotes."""
    return rf"(?s)<{tag}(?=[\s>]){_needs(cls, attrs)}[^>]*>"


def element_pattern(tag: str, cls: str | None = None, attrs: dict[str, str] | None = None) -> str:
    """Pattern of such an element; group 1 is its content, up to the first ``</tag>`` (for elements that hold
    none of their like)."""
    return rf"{open_tag_pattern(tag, cls, attrs)}(.*?)</{tag}\s*>"


def _tag_pattern(tag: str) -> str:
    """Pattern of the opening and closing tags of ``<tag>`` elements."""
    return rf"(?s)<{tag}(?=[\s>]){_ATTRS}>|</{tag}\s*>"


def _depths(tags: Column) -> Column:
    """How many of the elements are open after each tag."""
    step = F.transform(tags, lambda t: F.when(t.startswith("</"), F.lit(-1)).otherwise(F.lit(1)))
    none = F.array().cast("array<int>")
    return F.aggregate(step, none, lambda acc, x: F.concat(acc, F.array(x + F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)))))


def _content(tags: Column, texts: Column, depths: Column, i: Column) -> Column:
    """What stands between the i-th tag (from 1), an opening one, and the tag that closes it, or the end."""
    rest = F.array_position(F.slice(depths, i + 1, F.size(depths)), F.element_at(depths, i) - 1)
    n = F.when(rest > 0, rest.cast("int")).otherwise(F.size(tags) - i + 1)       # texts inside
    inner = F.zip_with(F.slice(texts, i + 1, n), F.slice(tags, i + 1, F.greatest(n - 1, F.lit(0))),
                       lambda t, g: F.concat(t, F.coalesce(g, F.lit(""))))
    return F.array_join(inner, "")


def _deep(col: Column, tags: Column, tag: str, cls: str | None, attrs: dict[str, str] | None) -> Column:
    """Contents of the elements of a text in which elements may stand inside their like."""
    wanted = open_tag_pattern(tag, cls, attrs)
    places = F.filter(F.sequence(F.lit(1), F.size(tags)), lambda i: F.element_at(tags, i).rlike(wanted))
    return let(F.struct(F.split(col, _tag_pattern(tag), -1).alias("texts"), _depths(tags).alias("depths")),
               lambda x: F.transform(places, lambda i: _content(tags, x["texts"], x["depths"], i)))


def _by_tags(col: Column, tag: str, deep: Callable[[Column], Column], flat: Column) -> Column:
    """``deep`` of the tags where an opening one follows another or ends the text, else ``flat``."""
    def choose(tags: Column) -> Column:
        kinds = F.array_join(F.transform(tags, lambda t: F.when(t.startswith("</"), F.lit("c")).otherwise(F.lit("o"))), "")
        return F.when(kinds.rlike("oo|o$"), deep(tags)).otherwise(flat)

    return let(F.regexp_extract_all(col, F.lit(_tag_pattern(tag)), 0), choose)


def elements(c: Column | str, tag: str, cls: str | None = None, attrs: dict[str, str] | None = None) -> Column:
    """The contents of all ``<tag>`` elements (of class ``cls``, with attributes ``attrs``) in the order of their
    opening tags, each up to the tag that closes it: elements of the same name inside it belong to it, and are elements
    of their own where they match. Texts in which no element stands inside its like are read by one pattern."""
    col = F.col(c) if isinstance(c, str) else c
    flat = F.regexp_extract_all(col, F.lit(element_pattern(tag, cls, attrs)), 1)
    return _by_tags(col, tag, lambda tags: _deep(col, tags, tag, cls, attrs), flat)


def attribute(opening: Column, name: str) -> Column:
    """Value of an attribute of an opening tag, in either quotes or none; NULL if it has none of that name."""
    pattern = rf"(?si)\s{re.escape(name)}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
    parts = [F.regexp_extract(opening, pattern, g) for g in (1, 2, 3)]
    return F.when(opening.rlike(pattern), F.concat(*parts))


def rows_of_page(pages: DataFrame, tag: str = "li", cls: str | None = None, attrs: dict[str, str] | None = None,
                 id_col: str = "page_id") -> DataFrame:
    """One row per repeated block of a listing page: (page_id, pos, block)."""
    return pages.select(id_col, F.posexplode(elements("html", tag, cls, attrs)).alias("pos", "block"))


def _links(c: Column, cls: str | None = None) -> Column:
    """Link targets of a text in order, of ``<a>`` elements of class ``cls`` that have one."""
    opening = F.regexp_extract_all(c, F.lit(rf"(?s)<a(?=[\s>]){_needs(cls, None)}{_ATTRS}>"), 0)
    return F.filter(F.transform(opening, lambda t: attribute(t, "href")), lambda h: h.isNotNull())


def links_of_page(pages: DataFrame, id_col: str = "page_id", cls: str | None = None) -> DataFrame:
    """Every link target of a page (of class ``cls``), in page order: (page_id, pos, href)."""
    return pages.select(id_col, F.posexplode(_links(F.col("html"), cls)).alias("pos", "href"))


def listing_links(pages: DataFrame, tag: str = "li", id_col: str = "page_id", row_cls: str | None = None,
                  link_cls: str | None = None) -> DataFrame:
    """X1 + X2 (second crawler's rule): the link of each listing row, in page
    order; the first row without a link ends that page (links already taken
    stay). Evaluated on the page's own row with array functions - no shuffle:
    (page_id, pos, href)."""
    hrefs = F.transform(elements("html", tag, row_cls), lambda b: F.try_element_at(_links(b, link_cls), F.lit(1)))
    stop = F.array_position(F.transform(hrefs, lambda h: h.isNull()), F.lit(True))   # 1-based, 0 = none
    kept = F.when(stop == 0, hrefs).otherwise(F.slice(hrefs, 1, stop - 1))
    return pages.select(id_col, F.posexplode(kept).alias("pos", "href"))


def first_text(c: Column | str, tag: str, missing: str | None = None, cls: str | None = None,
               attrs: dict[str, str] | None = None) -> Column:
    """Visible text of the first ``<tag>`` element (of class ``cls``, with
    attributes ``attrs``), trimmed; no element or empty text → ``missing``
    (crawl 1 uses 'N/A', crawl 2 NULL)."""
    col = F.col(c) if isinstance(c, str) else c
    first = _by_tags(col, tag, lambda tags: F.try_element_at(_deep(col, tags, tag, cls, attrs), F.lit(1)),
                     F.regexp_extract(col, element_pattern(tag, cls, attrs), 1))
    out = F.nullif(html_text(first), F.lit(""))
    return F.coalesce(out, F.lit(missing)) if missing is not None else out


def joined_matches(c: Column | str, tag: str = "a", sep: str = ", ", cls: str | None = None,
                   attrs: dict[str, str] | None = None) -> Column:
    """The texts of every such element, joined by ', ' in page order."""
    return F.array_join(F.transform(elements(c, tag, cls, attrs), lambda x: html_text(x)), sep)


def page_fields(pages: DataFrame, id_col: str = "page_id") -> DataFrame:
    """X3 + X4 over a table of pages."""
    return pages.select(
        id_col,
        first_text("html", "h1").alias("heading"),
        first_text("html", "title", MISSING_TEXT).alias("title"),
        joined_matches("html").alias("link_texts"),
    )


# --- label blocks --------------------------------------------------------

def _first_with(label: str) -> Column:
    """The text of the first block (page order) that contains ``label``."""
    has = F.col("text").contains(label)
    return F.min_by(F.when(has, F.col("text")), F.when(has, F.col("pos")))


def label_fields(blocks: DataFrame, text: dict[str, str] = TEXT_LABELS, digits: dict[str, str] = DIGIT_LABELS,
                 key: str = "title_id") -> DataFrame:
    """X5 + X6 + X11 by one aggregate: per title, the text after each ``text``
    label and the digits of each ``digits`` label (with ``<field>_int``)."""
    aggs = [F.coalesce(strip_ws(F.substring_index(_first_with(label), label, -1)), F.lit(MISSING_TEXT)).alias(out)
            for out, label in text.items()]
    aggs += [F.coalesce(parse.digits_only(_first_with(label)), F.lit(MISSING_TEXT)).alias(out)
             for out, label in digits.items()]
    return blocks.groupBy(key).agg(*aggs).withColumns({f"{c}_int": parse.int_digits(F.col(c)) for c in digits})


def text_after_label(blocks: DataFrame, labels: dict[str, str] = TEXT_LABELS, key: str = "title_id") -> DataFrame:
    """Per title and label, the text after the label's last occurrence in
    the first block (page order) that contains it, stripped; 'N/A' if none."""
    return label_fields(blocks, labels, {}, key)


def digits_after_label(blocks: DataFrame, labels: dict[str, str] = DIGIT_LABELS, key: str = "title_id") -> DataFrame:
    """Per title and label, the digits of the first block containing the
    label ('N/A' if none), and X11 applied to them (``<field>_int``)."""
    return label_fields(blocks, {}, labels, key)


def kv_blocks(blocks: DataFrame, key: str = "title_id") -> DataFrame:
    """X7 (first half): blocks split on ':'; fewer than two parts → skipped;
    key = part 0, value = part 1 only, both stripped."""
    parts = F.split(F.col("text"), ":")
    return (blocks.filter(F.size(parts) >= 2)
            .select(key, "pos", strip_ws(F.get(parts, 0)).alias("key"), strip_ws(F.get(parts, 1)).alias("value")))


def _is_genre_key(k: Column, words: Sequence[str] = GENRE_WORDS) -> Column:
    cond = k.contains(words[0])
    for w in words[1:]:
        cond = cond | k.contains(w)
    return cond


def pivot_blocks(kv: DataFrame, key: str = "title_id") -> DataFrame:
    """X7 + X8 + X9: one record per title. A repeated key keeps its last
    value (page order); every key containing a genre word is joined into
    ``genres`` with ', ' in page order; '#' is dropped from ranked/popularity.
    Blocks of no title (NULL id) belong to no record and are left out, so the
    list gathered per record is bounded by one page."""
    aggs = []
    for out, k in KV_KEYS.items():
        hit = F.col("key") == k
        aggs.append(F.max_by(F.when(hit, F.col("value")), F.when(hit, F.col("pos"))).alias(out))
    # Genre-like blocks of one page (bounded by the page), folded in page
    # order the way the reference accumulates them: an empty accumulator is
    # replaced by the next value, a non-empty one gets ', ' + value.
    gpairs = F.collect_list(F.when(_is_genre_key(F.col("key")), F.struct("pos", "value")))
    values = F.transform(F.array_sort(gpairs), lambda s: s["value"])
    genres = F.aggregate(values, F.lit(None).cast("string"),
                         lambda acc, x: F.when(acc.isNull() | (acc == ""), x)
                         .otherwise(F.concat(acc, F.lit(", "), x)))
    aggs.append(genres.alias("genres"))
    rec = kv.filter(F.col(key).isNotNull()).groupBy(key).agg(*aggs)
    return rec.withColumns({c: parse.drop_first_char(F.col(c)) for c in HASH_PREFIXED})


def convert_counts(rec: DataFrame, fields: Sequence[str] = COMMA_INT_FIELDS) -> DataFrame:
    """X10 on the crawl-2 record: '1,234' → 1234, 'Unknown'/junk → NULL."""
    return rec.withColumns({c: parse.int_with_commas(F.col(c)) for c in fields})
