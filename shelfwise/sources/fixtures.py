"""Derived fixture views over the driver's parquet tables.

The driver tables carry no dirty title data, so the raw wide title table is
derived from ``part`` by one SQL text that runs unchanged in Spark and DuckDB
(the oracle). Every dirty case the cleaning rules name is present: NULL and
blank names, sentinel studios and premieres, six duration shapes, rating
comments, NULL scores/episodes. The SQL uses ``{part}``/``{titles_raw}``
placeholders: Spark binds DataFrames through ``spark.sql(text, **frames)``,
the oracle substitutes view names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfwise.sources.tables import spread_rows

TITLES_RAW_SQL = """
SELECT p_partkey AS title_id,
  CASE WHEN p_partkey % 97 = 0 THEN NULL WHEN p_partkey % 89 = 0 THEN '   ' ELSE p_name || ' ' || CAST(p_partkey AS STRING) END AS title_name,
  CASE WHEN p_partkey % 53 = 0 THEN NULL WHEN p_partkey % 59 = 0 THEN '' ELSE replace(p_name, ' ', ', ') || ', ' || p_type END AS genres,
  CASE p_partkey % 11 WHEN 0 THEN 'None found, add some' WHEN 1 THEN NULL WHEN 2 THEN '  ' || p_brand || '  ' ELSE p_brand || ', Brand#' || CAST(1 + (p_partkey * 7) % 25 AS STRING) END AS studio,
  CASE p_partkey % 13 WHEN 0 THEN NULL WHEN 1 THEN '?' ELSE CASE p_partkey % 4 WHEN 0 THEN 'Winter' WHEN 1 THEN 'Spring' WHEN 2 THEN 'Summer' ELSE 'Fall' END || ' ' || CAST(1970 + p_size AS STRING) END AS premiered,
  CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE p_size END AS episodes,
  CASE p_partkey % 9 WHEN 0 THEN 'Unknown' WHEN 1 THEN CAST(1 + p_size % 2 AS STRING) || ' hr. ' || CAST(p_size AS STRING) || ' min.'
    WHEN 2 THEN CAST(p_size AS STRING) || ' min. per ep.' WHEN 3 THEN CAST(p_size AS STRING) || ' min.' WHEN 4 THEN CAST(1 + p_size % 3 AS STRING) || ' hr.'
    WHEN 5 THEN CAST(p_size AS STRING) || ' sec. per ep.' WHEN 6 THEN '1 hr. ' || CAST(p_size AS STRING) || ' min. per ep.' WHEN 7 THEN NULL ELSE '24 min. per ep.' END AS duration,
  CASE p_partkey % 8 WHEN 0 THEN 'G - All Ages' WHEN 1 THEN 'PG - Children' WHEN 2 THEN 'PG-13 - Teens 13 or older' WHEN 3 THEN 'R - 17+ (violence & profanity)' WHEN 4 THEN 'R+ - Mild' WHEN 5 THEN 'Rx - Other' WHEN 6 THEN 'None' ELSE 'N/A' END AS rating,
  CASE p_size % 3 WHEN 0 THEN 'TV' WHEN 1 THEN 'Movie' ELSE 'OVA' END AS media_type,
  CASE p_partkey % 3 WHEN 0 THEN 'Finished Airing' WHEN 1 THEN 'Currently Airing' ELSE 'Not yet aired' END AS status,
  CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE CAST(p_partkey % 1001 AS DOUBLE) / 100 END AS score,
  CAST(p_partkey + 1 AS INT) AS ranking, CAST((p_partkey * 37) % 2003 AS INT) AS popularity,
  CAST(p_partkey * 13 AS INT) AS members, CAST(p_partkey % 500 AS INT) AS favorites,
  p_name || ' synopsis, part ' || CAST(p_partkey AS STRING) AS synopsis
FROM {part}
"""

# Raw table with exact duplicate copies (the input of de-duplication).
TITLES_DUP_SQL = """
SELECT * FROM {titles_raw}
UNION ALL SELECT * FROM {titles_raw} WHERE title_id % 50 = 0
"""

# Raw table with seeded constraint violations.
TITLES_BAD_SQL = """
SELECT title_id, title_name, genres, studio, premiered, episodes, duration, rating, media_type, status,
  CASE WHEN title_id % 101 = 0 THEN 11.0 ELSE score END AS score,
  CASE WHEN title_id % 103 = 0 THEN 0 ELSE ranking END AS ranking,
  popularity, members,
  CASE WHEN title_id % 107 = 0 THEN -1 ELSE favorites END AS favorites,
  synopsis
FROM {titles_raw}
"""

# Stored vs arriving rows (incremental insert-if-absent): even ids are stored,
# odd ids arrive, ids divisible by 10 are in both.
TITLES_STORED_SQL = "SELECT * FROM {titles_raw} WHERE title_id % 2 = 0"
# The arriving batch also re-sends the names of odd ids divisible by 3 under a
# later id (first arrival must win).
TITLES_ARRIVING_SQL = """
SELECT * FROM {titles_raw} WHERE title_id % 2 = 1 OR title_id % 10 = 0
UNION ALL
SELECT title_id + 1000000 AS title_id, title_name, genres, studio, premiered, episodes, duration, rating,
  media_type, status, score, ranking, popularity, members, favorites, synopsis
FROM {titles_raw} WHERE title_id % 2 = 1 AND title_id % 3 = 0
"""

# Changed and new rows that arrive as a micro-batch of updates: other episodes, some without a duration.
TITLES_UPDATES_SQL = """
SELECT title_id, title_name, genres, studio, CASE WHEN title_id % 4 = 0 THEN NULL ELSE premiered END AS premiered,
  episodes + 1 AS episodes, CASE WHEN title_id % 2 = 0 THEN NULL ELSE duration END AS duration,
  rating, media_type, status, score, ranking, popularity, members, favorites, synopsis
FROM {titles_raw} WHERE title_id % 43 = 0
UNION ALL
SELECT title_id + 100000 AS title_id, title_name, genres, studio, premiered, episodes,
  duration, rating, media_type, status, score, ranking, popularity, members, favorites, synopsis
FROM {titles_raw} WHERE title_id % 47 = 0
"""

# First load of a star that grows: the even titles, some with genres that the second load replaces.
CLEAN_FIRST_SQL = """
SELECT title_id, title_name, CASE WHEN title_id % 14 = 0 THEN 'Retired ' || CAST(title_id % 5 AS STRING) ELSE genres END AS genres,
  studio, CASE WHEN title_id % 28 = 0 THEN 'Winter 1901' ELSE premiered END AS premiered, episodes, duration, rating, media_type,
  status, score, CASE WHEN title_id % 14 = 0 THEN ranking + 1 ELSE ranking END AS ranking, popularity, members, favorites,
  synopsis, duration_min
FROM {clean} WHERE title_id % 2 = 0
"""
# Second load: the odd titles and the changed ones.
CLEAN_SECOND_SQL = "SELECT * FROM {clean} WHERE title_id % 2 = 1 OR title_id % 14 = 0"

# Changed copy for the differential snapshot.
TITLES_CHANGED_SQL = """
SELECT title_id, title_name, genres, studio, premiered,
  CASE WHEN title_id % 43 = 0 THEN episodes + 1 ELSE episodes END AS episodes,
  duration, rating, media_type, status, score, ranking, popularity, members, favorites, synopsis
FROM {titles_raw} WHERE title_id % 41 <> 0
UNION ALL
SELECT title_id + 100000 AS title_id, title_name, genres, studio, premiered, episodes,
  duration, rating, media_type, status, score, ranking, popularity, members, favorites, synopsis
FROM {titles_raw} WHERE title_id % 47 = 0
"""

# Label blocks of a detail page in page order: (text, which titles have it).
_BLOCKS = (
    ("'Type: ' || media_type", None),
    ("'Episodes: ' || coalesce(CAST(episodes AS STRING), 'Unknown')", None),
    ("'Studios: ' || studio", None),
    ("'Premiered: ' || premiered", None),
    ("'Duration: ' || duration", None),
    ("'Genres: ' || genres", None),
    ("'Theme: ' || media_type", "title_id % 5 = 0"),
    ("'Ranked: #' || CAST(ranking AS STRING)", None),
    ("'Popularity: #' || CAST(popularity AS STRING)", None),
    ("'Members: ' || CASE WHEN members >= 1000 THEN CAST(CAST(floor(members / 1000) AS BIGINT) AS STRING) || ',' "
     "|| lpad(CAST(members % 1000 AS STRING), 3, '0') ELSE CAST(members AS STRING) END", None),
    ("'Favorites: ' || CAST(favorites AS STRING)", None),
    ("'Status: ' || status", None),
    ("'Rating: ' || rating", None),
    ("'Type: Special'", "title_id % 31 = 0"),
    ("'Source: a: b: c'", "title_id % 7 = 0"),
    ("'no colon here'", "title_id % 10 = 0"),
)
INFO_BLOCKS_SQL = "SELECT title_id, pos, text FROM (\n  " + "\n  UNION ALL ".join(
    f"SELECT title_id, {i} AS pos, {text} AS text FROM {{titles_raw}}" + (f" WHERE {where}" if where else "")
    for i, (text, where) in enumerate(_BLOCKS, 1)) + ") b\nWHERE text IS NOT NULL"


def _element(open_tag: str, text: str, close_tag: str) -> str:
    """SQL of one element, its text escaped; '' where the text is NULL."""
    escaped = f"replace(replace({text}, '&', '&amp;'), '>', '&gt;')"
    return f"coalesce('{open_tag}' || {escaped} || '{close_tag}', '')"


# The same titles as whole detail pages: one html text a title, with character
# references, decoy elements of other classes, and elements missing where the value is NULL.
DETAIL_PAGES_SQL = "SELECT title_id AS page_id, '<html><h1 class=\"other\">no</h1>' || " + " || ".join([
    "coalesce('<h1 class=\"h1 title-name\">' || replace(title_name, ' ', '&#32;') "
    "|| '&#039;s &#x27;caf&eacute;&#x27;&nbsp;</h1>', '')",
    _element('<div data-n=\"1\" class=\"fl score-label\">', "CAST(score AS STRING)", "</div>"),
    _element('<span class=\"top-anime-rank-text rank1\">', "CAST(ranking AS STRING)", "</span>"),
    _element('<span itemprop=\"genre\">', "genres", "</span><span>x</span>"),
    "'<span class=\"a\" itemprop=\"genre\">Extra</span>'",
    _element('<p>ad</p><p itemprop=\"description\">', "synopsis", "</p>"),
    *[_element('<div class=\"spaceit_pad\"> <b>', f"CASE WHEN {where or 'TRUE'} THEN {text} END", "</b> </div>")
      for text, where in _BLOCKS]]) + " || '</html>' AS html FROM {titles_raw}"

# One listing page a title: three rows, the second without a link on every third page.
LISTING_PAGES_SQL = """
SELECT title_id AS page_id, '<ul><li><a href="/t/' || CAST(title_id AS STRING) || '">x</a></li><li>'
  || CASE WHEN title_id % 3 = 0 THEN 'no link' ELSE '<a class="c" href="/t/b">y</a>' END
  || '</li><li><a href="/t/c">z</a></li></ul>' AS html
FROM {titles_raw}
"""

# Genre lists with names over the length limit.
TITLES_LONG_SQL = """
SELECT title_id, CASE WHEN title_id % 9 = 0 THEN repeat('long ', 60) || CAST(title_id AS STRING) ELSE studio END AS name
FROM {titles_raw}
"""

# Pages with elements inside elements of the same name, links in all kinds of quotes and decoys.
NESTED_PAGES_SQL = """
SELECT title_id AS page_id, '<html><div id="w"><div class="spaceit_pad"><div>Type: <b>' || media_type || '</b></div> of '
  || CAST(title_id AS STRING) || '</div><div class="x spaceit_pad">Status: ' || status
  || '<div class="spaceit_pad">Rank: <div>' || CAST(ranking AS STRING) || '</div></div> end</div></div><div>out</div>'
  || '<ul><li><a data-href="/no" class="hover t" href=&apos;/t/' || CAST(title_id AS STRING) || '&apos;>x</a><ul><li><i>inner</i>'
  || CASE WHEN title_id % 2 = 0 THEN '<a href="/i">i</a>' ELSE '' END || '</li></ul></li><li><a class="other" href="/o">y</a>'
  || '<a class="hover" href=/u/' || CAST(title_id AS STRING) || '>z</a></li></ul></html>' AS html
FROM {titles_raw}
""".replace("&apos;", "''")

#: Titles that one task of the cleaning takes, far less work each than a page.
CLEANED_PER_TASK = 100_000

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                 "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (parquet, pushdown and pruning by Catalyst)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def titles_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(TITLES_RAW_SQL, part=table(spark, sf_dir, "part"))


def _over_titles(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    return spark.sql(text, titles_raw=titles_raw(spark, sf_dir))


def titles_with_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the cleaning reads; it parses and groups wide rows, so the parts are spread first here too."""
    parts = spread_rows(table(spark, sf_dir, "part"), CLEANED_PER_TASK)
    return spark.sql(TITLES_DUP_SQL, titles_raw=spark.sql(TITLES_RAW_SQL, part=parts))


def titles_with_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _over_titles(spark, sf_dir, TITLES_BAD_SQL)


def titles_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _over_titles(spark, sf_dir, TITLES_STORED_SQL)


def titles_arriving(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _over_titles(spark, sf_dir, TITLES_ARRIVING_SQL)


def titles_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _over_titles(spark, sf_dir, TITLES_CHANGED_SQL)


def titles_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _over_titles(spark, sf_dir, TITLES_UPDATES_SQL)


def info_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _over_titles(spark, sf_dir, INFO_BLOCKS_SQL)


def _pages_of_titles(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Pages are built and read by costly expressions: the parts, few bytes each and so in few splits, are spread first."""
    return spark.sql(text, titles_raw=spark.sql(TITLES_RAW_SQL, part=spread_rows(table(spark, sf_dir, "part"))))


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages_of_titles(spark, sf_dir, LISTING_PAGES_SQL)


def long_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _over_titles(spark, sf_dir, TITLES_LONG_SQL)


def nested_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages_of_titles(spark, sf_dir, NESTED_PAGES_SQL)


def detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages_of_titles(spark, sf_dir, DETAIL_PAGES_SQL)


def oracle_view(text: str, **names: str) -> str:
    """Render a fixture SQL text for the oracle (DuckDB view names)."""
    defaults = {"part": "part", "titles_raw": "titles_raw"}
    defaults.update(names)
    return text.format(**defaults)


def oracle_with(body: str, *ctes: tuple[str, str]) -> str:
    """``WITH titles_raw AS (...) , ... <body>`` for the oracle."""
    parts = [("titles_raw", oracle_view(TITLES_RAW_SQL))] + list(ctes)
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in parts) + "\n" + body
