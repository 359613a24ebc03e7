"""Text column expressions: HTML fragments, whitespace, list text, tokens."""

from __future__ import annotations

import functools
import glob
import os
import zipfile
from collections.abc import Callable
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word token: a run of two or more letters, digits or underscores (Unicode
# classes, so accented words stay whole in both Spark and the oracle).
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"
TAG_PATTERN = r"<[^>]*>"
ENTITY_PATTERN = r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Python ``str.strip()`` for ASCII whitespace (tabs/newlines too)."""
    return F.regexp_replace(_c(c), r"^\s+|\s+$", "")


def _entity_text(e: Column) -> Column:
    """The character of one entity (``&name;``, ``&#N;``, ``&#xN;``); an unknown
    name stays as it is, a number that is no character gives U+FFFD."""
    body = F.substring(e, 2, 64)
    digits = F.regexp_extract(e, r"^&#[xX]?0*([0-9a-fA-F]*);$", 1)
    point = F.when(F.length(digits) <= 8, F.when(body.rlike("^#[xX]"), F.conv(digits, 16, 10)).otherwise(digits)
                   .try_cast("bigint"))
    valid = point.between(1, 0x10FFFF) & ~point.between(0xD800, 0xDFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")
    named = F.create_map(*[F.lit(x) for n, p in [*name2codepoint.items(), ("apos", 39)] for x in (n, chr(p))])
    return (F.when(~body.startswith("#"), F.coalesce(F.try_element_at(named, F.regexp_extract(e, "^&(.*);$", 1)), e))
            .when(valid, char).otherwise(F.lit("\ufffd")))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _decoded(t: Column) -> Column:
    found = F.transform(F.regexp_extract_all(t, F.lit(ENTITY_PATTERN), 0), lambda e: let(e, _entity_text))
    between = F.split(t, ENTITY_PATTERN, -1)
    joined = F.array_join(F.zip_with(between, found, lambda b, e: F.concat(b, F.coalesce(e, F.lit("")))), "")
    return F.when(t.contains("&"), joined).otherwise(t)


def decode_entities(c) -> Column:
    """Character references decoded in one pass from left to right, so that what
    one of them decodes to is not read as another (``&amp;lt;`` gives ``&lt;``)."""
    return let(_c(c), _decoded)


def html_text(c) -> Column:
    """Visible text of an HTML fragment: tags removed, character references
    decoded, edges stripped (no-break spaces too)."""
    t = decode_entities(F.regexp_replace(_c(c), TAG_PATTERN, ""))
    return F.regexp_replace(t, r"^[\s\u00a0]+|[\s\u00a0]+$", "")


def normalise_list_text(c) -> Column:
    """Lower-case, every ',' becomes a space; NULL becomes ''."""
    return F.coalesce(F.translate(F.lower(_c(c)), ",", " "), F.lit(""))


def tokens(c) -> Column:
    """Lower-cased word tokens of a text, in order (array<string>)."""
    return F.regexp_extract_all(F.lower(_c(c)), F.lit(TOKEN_PATTERN), 0)


@functools.lru_cache(maxsize=None)
def default_stop_words(language: str = "english") -> tuple[str, ...]:
    """Spark ML's default stop-word list for ``language``.

    Read from the spark-mllib jar that ships with PySpark (the same file
    ``StopWordsRemover.loadDefaultStopWords`` reads) so it is available
    without a running JVM, e.g. to render the oracle SQL.
    """
    import pyspark

    jars = glob.glob(os.path.join(os.path.dirname(pyspark.__file__), "jars", "spark-mllib_*.jar"))
    for jar in jars:
        with zipfile.ZipFile(jar) as z:
            name = f"org/apache/spark/ml/feature/stopwords/{language}.txt"
            if name in z.namelist():
                return tuple(w for w in z.read(name).decode("utf-8").split() if w)
    from pyspark.ml.feature import StopWordsRemover  # needs a live JVM

    return tuple(StopWordsRemover.loadDefaultStopWords(language))
