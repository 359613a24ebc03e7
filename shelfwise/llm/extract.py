"""Main text of web pages by equivalence-class template deduction.

Tokens of a page are its elements by path (``html/body/div.ad``) and its blocks of words by path. A token's
occurrence vector is its number of occurrences in each page of the host; tokens with the same vector form an
equivalence class. A class that occurs in at least half of the host's pages is valid if its elements stand inside elements
of valid classes: so classes nest, from the class of the root down, into the host's template. Words belong to the
template if they share the class of a template element, in (nearly) all pages and in no article element: such a line says the same wherever it
stands, so it is a header, a notice or the like and goes, whatever its element is called. Slots are the places
between template elements; the main slot is that of the template's main element, or of an article element with most
of its text; without one, the innermost slot that holds nearly all text. A page's text is what differs in its main slot,
without the parts that are no article (menus, forms, adverts, comments and so on).

Vectors are compared through an order-free 64-bit digest, so a host's pages never meet in one task, however
many there are: what is gathered per host is one row a path.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import slices, stored
from shelfwise.llm.urlfilter import split_url

SLICE_BYTES = 4 << 20
#: Share of a slot's text that a slot in it must hold to be taken instead.
NEARLY = 0.95
#: Share of a host's pages, and pages, that words of the template must stand in.
REPEATED, LEAST_PAGES = 0.9, 3
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|</?[a-zA-Z](?:"[^"]*"|'[^']*'|[^>"'])*(?:>|\Z)|</?[a-zA-Z][^>]*(?:>|\Z)""", re.S)
NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
ARTICLE = re.compile(r"/article[./\n]")
CUES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
#: Elements by what they do (fixed values): their text is no article; it is raw; they hold others; they are
#: empty; they end a block.
NO_ARTICLE = frozenset("nav header footer aside form script style noscript template button select textarea iframe "
                       "svg canvas object dialog menu head title".split())
RAW = frozenset("script style textarea title noscript iframe".split())
CONTAINERS = NO_ARTICLE | frozenset("html body article main section div ul ol dl table figure details center".split())
VOID = frozenset("br hr img input meta link area base col embed source track wbr".split())
BLOCKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote tr td th caption figcaption address hr "
                                "tbody thead tfoot summary option fieldset legend".split())
LISTS = frozenset("ul ol dl table figure details".split())
#: Words of a class, id or role that mark a part as no article.
NO_ARTICLE_WORDS = frozenset("ad ads advert adverts advertisement sponsor sponsored promo banner sidebar comment comments "
                             "disqus reply replies notice notices cookie cookies consent alert nav navbar navigation menu "
                             "breadcrumb breadcrumbs footer header masthead related share sharing social subscribe newsletter "
                             "widget popup modal".split())
#: Those that can mark a part longer than the article; elements that are the page or its article whatever they are called.
COMMENT_WORDS = frozenset("comment comments disqus reply replies".split())
WHOLE = frozenset("html body main article".split())
#: Elements that end an open block of a kind without its closing tag (fixed values).
_ROWS, _HEADS = frozenset("tr tbody thead tfoot".split()), frozenset("h1 h2 h3 h4 h5 h6".split())
ENDS = {"p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": _ROWS, "td": _ROWS | {"td", "th"},
        "th": _ROWS | {"td", "th"}, "option": {"option"}} | {k: _ROWS - {"tr"} for k in _ROWS - {"tr"}} | {k: _HEADS for k in _HEADS}


def _part(tag: str, name: str) -> tuple[str, set[str]]:
    """Path component of an opening tag, and its words that mark it as no article."""
    cues = [" ".join(m[1:]) for m in CUES.findall(tag)]
    marks = {w for c in cues for w in re.split(r"[^a-z0-9]+", c.lower()) if w}
    return ".".join([name, *sorted(marks)]), set() if name in WHOLE else marks & NO_ARTICLE_WORDS


def _spared(marked: list[set[str]], found: list[tuple]) -> set[int]:
    """Marked elements that hold most of a page's text, so that their words say nothing of it: more than half (with
    a word for comments nine tenths), and nearly all that stands in an article or main element."""
    if not marked:
        return set()
    total, named, size, own = 0, 0, [0] * len(marked), [0] * len(marked)
    for _, within, in_named, words in found:
        if within is not None:
            total, named = total + len(words), named + in_named * len(words)
            for k in within:
                size[k] += len(words)
                own[k] += in_named * len(words)
    return {k for k, words in enumerate(marked) if 2 * size[k] > total and 10 * (named - own[k]) <= size[k]
            and (not words & COMMENT_WORDS or 10 * size[k] >= 9 * total)}


def parse(page: str | None) -> tuple[dict[str, int], list[tuple[str, bool, str]]]:
    """Occurrences of each element path, and the text blocks in order as (path, part of the article, text)."""
    page = page or ""
    # name, path, marked elements around (None: in an element that is no article), in an article or main element; of
    # a marked block that is no container, how many of its name are open in it, else 0
    stack: list[list] = [["", "", (), False, 0]]
    counts, out, text, at, marked = {"": 1}, [], [], 0, []

    def end_block() -> None:
        if text:
            words = " ".join(html.unescape("".join(text)).split())
            if words:
                out.append((*stack[-1][1:4], words))
            text.clear()

    for m in TOKEN.finditer(page):
        if m.start() < at:
            continue
        text.append(page[at:m.start()])
        at, tag = m.end(), m[0]
        if tag[1] in "!?":
            continue
        name = NAME.match(tag)[1].lower()
        if name in BLOCKS:
            end_block()
        elif name == "br":
            text.append(" ")
        if tag[1] == "/":
            if name in CONTAINERS:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == name:
                        del stack[k:]
                        break
            elif stack[-1][4]:
                for k in range(len(stack) - 1, 0, -1):
                    if not stack[k][4]:
                        break
                    if stack[k][0] == name:
                        stack[k][4] -= 1
                        del stack[k + (stack[k][4] > 0):]
                        break
            continue
        if name not in BLOCKS:
            continue
        while stack[-1][4] and name in ENDS.get(stack[-1][0], ()):
            stack.pop()
        _, path, within, named, _ = stack[-1]
        if name in CONTAINERS:
            part, words = _part(tag, name)
            path = f"{path}/{part}"
            counts[path] = counts.get(path, 0) + 1
            if name in RAW:
                close = re.compile(rf"</{name}\s*>", re.I).search(page, at)
                at = close.end() if close else len(page)
            elif not tag.endswith("/>"):
                if name in NO_ARTICLE:
                    within = None
                elif words and within is not None:
                    within = (*within, len(marked))
                    marked.append(words)
                stack.append([name, path, within, named or name in ("article", "main"), 0])
        elif name not in VOID and within is not None:
            words = _part(tag, name)[1] if "=" in tag else set()
            if words:
                stack.append([name, path, (*within, len(marked)), named, 1])
                marked.append(words)
            else:
                for k in range(len(stack) - 1, 0, -1):
                    if not stack[k][4]:
                        break
                    if stack[k][0] == name:
                        stack[k][4] += 1
                        break
    text.append(page[at:])
    end_block()
    spared = _spared(marked, out)
    return counts, [(path, within is not None and spared.issuperset(within), words) for path, within, _, words in out]


def _inside(chars: dict[str, int]) -> dict[str, int]:
    """Characters in each path and all paths beneath it, from those directly in each."""
    out = dict(chars)
    for p in sorted(chars, key=lambda p: -p.count("/")):
        if p:
            above = p.rpartition("/")[0]
            out[above] = out.get(above, 0) + out[p]
    return out


def words_token(path: str, words: str) -> str:
    """Token of a block of words: its path and a 64-bit hash."""
    from xxhash import xxh64_hexdigest

    return f"{path}\n{xxh64_hexdigest(words.encode(errors='surrogatepass'))}"


def _tokens(pages: DataFrame) -> DataFrame:
    """Per host and token (element or words, by path), partly summed: pages, digest of the occurrence vector, article
    characters directly in the path or words, and, for elements, with those beneath them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest as xxh

        for b in slices(batches, "html", SLICE_BYTES):
            found: dict = {}
            for i, host, page in zip(*(b.column(k).to_pylist() for k in range(3))):
                counts, text = parse(page)
                size: dict[str, int] = {}
                for path, good, words in text:
                    if good:
                        size[path] = size.get(path, 0) + len(words)
                inside = _inside({path: size.get(path, 0) for path in counts})
                for path, good, words in text:
                    if good:
                        token = words_token(path, words)
                        counts[token] = counts.get(token, 0) + 1
                        size[token] = size.get(token, 0) + len(words)
                for path, n in counts.items():
                    row = found.setdefault((host, path), [0, 0, 0, 0])
                    row[0] += 1
                    row[1] ^= xxh(f"{i}:{n}")
                    row[2] += size.get(path, 0)
                    row[3] += inside.get(path, 0)
            rows = [(*k, n, d - (1 << 64) if d >> 63 else d, c, a) for k, (n, d, c, a) in found.items()]
            yield pa.record_batch([pa.array(list(c), t) for c, t in zip(
                zip(*rows), (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()))],
                names=["host", "path", "n", "digest", "chars", "inside"])

    return pages.mapInArrow(run, "host string, path string, n long, digest long, chars long, inside long")


def main_slot(paths: list[dict]) -> tuple[list[str], str]:
    """Template paths of a host, and the path of its main slot, from rows (path, n, digest, chars) and, where the
    rows leave out paths, inside: characters in the path and all beneath it."""
    pages = next((r["n"] for r in paths if r["path"] == ""), 0)
    classes: dict = {}
    for r in paths:
        classes.setdefault((r["n"], r["digest"]), []).append(r)
    valid: set[str] = {""}
    order = sorted(classes.values(), key=lambda c: (min(r["path"].count("/") for r in c), c[0]["path"]))
    for members in order:
        if 2 * members[0]["n"] >= pages:
            inside = {r["path"] for r in members}
            valid |= {p for p in inside if p == "" or p.rpartition("/")[0] in valid | inside}
    good = {p for p in valid if all(_good(c) for c in p.split("/")[1:])}
    inside = _inside({r["path"]: r["chars"] for r in paths if r["path"] in good})
    inside |= {r["path"]: r["inside"] for r in paths if "inside" in r}
    most = lambda some: max(some, key=lambda p: (inside[p], p), default=None)
    named = {k: most(p for p in good if p.rpartition("/")[2].split(".")[0] == k) for k in ("article", "main")}
    main = named["main"]
    if main is None:
        within: dict[str, list[str]] = {}
        for p in good - {""}:
            within.setdefault(p.rpartition("/")[0], []).append(p)
        main = ""
        while (child := most(within.get(main, []))) is not None and 0 < inside[child]:
            # beside a list or table stands what it is about: all text must be in it
            share = 1 if child.rpartition("/")[2].split(".")[0] in LISTS else NEARLY
            if inside[child] < share * inside[main]:
                break
            main = child
    if named["article"] is not None and 2 * inside[named["article"]] > inside[main]:
        main = named["article"]
    return sorted(valid), main


def template_words(rows: list[dict], valid: list[str]) -> list[str]:
    """Tokens of the words that belong to a host's template, from rows of its tokens and its template paths: those in
    the class of a template element and in nearly all pages, but not in an article element. None, if they make up most of the host's
    text: then its pages are copies of each other, and the words are no template's."""
    root = next((r for r in rows if r["path"] == ""), None)
    if root is None or root["n"] < LEAST_PAGES:
        return []
    known = set(valid)
    classes = {(r["n"], r["digest"]) for r in rows if r["path"] in known}
    found = [r for r in rows if "\n" in r["path"] and r["n"] >= REPEATED * root["n"] and (r["n"], r["digest"]) in classes
             and not ARTICLE.search(r["path"])]
    return [r["path"] for r in found] if 2 * sum(r["chars"] for r in found) <= root["inside"] else []


def _good(part: str) -> bool:
    return part.split(".")[0] not in NO_ARTICLE  # what words mark is known for each page: it adds no characters


def templates(pages: DataFrame) -> DataFrame:
    """``(host, main, words)`` from ``(page, host, html)``. Only tokens in at least half of a host's pages are
    gathered: no more than twice an average page has."""
    sums = _tokens(pages).groupBy("host", "path").agg(F.sum("n").alias("n"), F.bit_xor("digest").alias("digest"),
                                                     F.sum("chars").alias("chars"), F.sum("inside").alias("inside"))
    sums = stored(sums, "page-tokens")
    size = sums.filter("path = ''").select("host", F.col("n").alias("pages"))
    often = sums.join(size, "host").filter("2 * n >= pages")
    rows = often.groupBy("host").agg(F.collect_list(F.struct("path", "n", "digest", "chars", "inside")).alias("paths"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tokens = b.column(1).to_pylist()
            found = [main_slot([r for r in t if "\n" not in r["path"]]) for t in tokens]
            yield pa.record_batch([b.column(0), pa.array([m for _, m in found], pa.string()),
                                   pa.array([template_words(t, v) for t, (v, _) in zip(tokens, found)], pa.list_(pa.string()))],
                                  names=["host", "main", "words"])

    return stored(rows.mapInArrow(run, "host string, main string, words array<string>"), "page-templates")


def article(page: str | None, main: str | None, repeated: list[str] | None = None) -> str:
    """The page's text in the slot ``main``; if it has no such part, in its own best slot. Words whose token is in
    ``repeated`` are the template's and go."""
    counts, text = parse(page)
    if repeated:
        drop = set(repeated)
        text = [t for t in text if words_token(t[0], t[2]) not in drop]
    if main is None or main not in counts:
        own = {}
        for path, good, words in text:
            if good:
                own[path] = own.get(path, 0) + len(words)
        main = main_slot([{"path": p, "n": 1, "digest": 0, "chars": own.get(p, 0)} for p in counts])[1]
    return "\n".join(w for path, good, w in text if good and (path == main or path.startswith(f"{main}/")))


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)``, one row per row of ``pages`` (page_id, url, html).

    Character references are decoded, white space inside a block becomes one space, blocks are joined by
    a newline in page order. A null html is empty and gives an empty text; a null url belongs to the host
    ``''``; words that are a host's template go from every page of it; very long pages are read whole; repeated rows and null ids each keep their row; an empty table gives
    an empty result; other columns are ignored.
    """
    rows = pages.select(F.col("page_id").cast("long"), "url", split_url()[0], "html")
    found = templates(rows.select(F.xxhash64("page_id", "url").alias("page"), "host", "html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "html", SLICE_BYTES):
            texts = [article(*x) for x in zip(*(b.column(k).to_pylist() for k in (2, 3, 4)))]
            yield pa.record_batch([b.column(0), b.column(1), pa.array(texts, pa.string()),
                                   pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    told = rows.join(found, "host", "left").select("page_id", "url", "html", "main", "words")
    return told.mapInArrow(run, "page_id long, url string, text string, n_chars long")
