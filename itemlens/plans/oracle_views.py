"""SQL twins of :mod:`itemlens.plans.views` for the DuckDB oracle.

Each adapter is a named CTE. :func:`with_views` prepends the CTEs a query needs, in dependency order, so every oracle
query is one self-contained SQL string over the registered source views.
"""

from __future__ import annotations

from itemlens.plans import views as V

def _raw_items(dirty: bool) -> str:
    """``v_items`` as text; without dirt no row is changed."""
    m = (lambda mod: f"item_id % {mod} = 0") if dirty else (lambda mod: "FALSE")
    return f"""SELECT
    CASE WHEN {m(V.BAD_ID_MOD)} THEN 'x' || CAST(item_id AS VARCHAR) ELSE CAST(item_id AS VARCHAR) END AS id,
    CASE WHEN {m(V.NULL_TITLE_MOD)} THEN NULL ELSE title END AS title,
    CASE WHEN {m(V.BAD_BUDGET_MOD)} THEN 'bad' ELSE CAST(budget AS VARCHAR) END AS budget,
    CAST(revenue AS VARCHAR) AS revenue,
    CAST(vote_average AS VARCHAR) AS vote_average,
    CAST(vote_count AS VARCHAR) AS vote_count,
    CAST(popularity AS VARCHAR) AS popularity,
    CASE WHEN {m(V.NULL_RUNTIME_MOD)} THEN NULL ELSE CAST(runtime AS VARCHAR) END AS runtime,
    CASE WHEN {m(V.BAD_DATE_MOD)} THEN 'n/a' ELSE CAST(release_date AS VARCHAR) END AS release_date,
    CASE WHEN {m(V.BAD_GENRES_MOD)} THEN 'garbage'
         WHEN {m(V.EMPTY_GENRES_MOD)} THEN '[]'
         ELSE '[{{"id": ' || CAST(item_id % 6 AS VARCHAR) || ', "name": "' || category
              || '"}}, {{"id": 100, "name": "' || split_part(title, ' ', 1) || '"}}]' END AS genres,
    CASE WHEN item_id % 4 = 0 THEN category || '|' || split_part(title, ' ', 1)
         WHEN item_id % 4 = 1 THEN category || ', ' || split_part(title, ' ', 1)
         WHEN item_id % 4 = 2 THEN '[''' || category || ''', ''' || split_part(title, ' ', 1) || ''']'
         ELSE category END AS genre_tags,
    CASE WHEN {m(V.NULL_LANGUAGE_MOD)} THEN NULL ELSE language END AS original_language
  FROM v_items"""


def _clean_items(raw: str) -> str:
    return f"""SELECT * FROM (
    SELECT id, title,
           TRY_CAST(budget AS DOUBLE) AS budget, TRY_CAST(revenue AS DOUBLE) AS revenue,
           TRY_CAST(vote_average AS DOUBLE) AS vote_average, TRY_CAST(vote_count AS INTEGER) AS vote_count,
           TRY_CAST(popularity AS DOUBLE) AS popularity, TRY_CAST(runtime AS DOUBLE) AS runtime,
           CAST(year(try_strptime(release_date, '%Y-%m-%d')) AS INTEGER) AS release_year,
           CASE WHEN json_valid(genres) THEN json_extract_string(genres, '$[*].name')
                ELSE CAST([] AS VARCHAR[]) END AS genres_list,
           genre_tags, original_language
    FROM {raw}) t
  WHERE budget IS NOT NULL AND revenue IS NOT NULL AND vote_average IS NOT NULL AND title IS NOT NULL
    AND revenue > 1000 AND budget > 1000 AND vote_count > 10"""


_CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "v_ratings": (
        (),
        """SELECT o.o_custkey AS user_id, l.l_partkey AS item_id, avg(l.l_quantity) / 10 AS rating
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  GROUP BY o.o_custkey, l.l_partkey""",
    ),
    "v_sales": (
        (),
        """SELECT l_partkey AS item_id,
         CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS BIGINT)))
              AS DOUBLE) AS revenue,
         count(*) AS vote_count,
         avg(l_quantity) / 5 AS vote_average,
         CAST(sum(CAST(round(l_tax * 100) AS BIGINT)) AS DOUBLE) AS popularity
  FROM lineitem GROUP BY l_partkey""",
    ),
    "v_items": (
        ("v_sales",),
        """SELECT s.item_id, p.p_name AS title, CAST(round(p.p_retailprice * 100) AS BIGINT) * p.p_size / 2 AS budget,
         s.revenue, s.vote_count, s.vote_average, CAST(p.p_size * 4 AS DOUBLE) AS runtime,
         p.p_brand AS language, p.p_type AS category,
         make_date(CAST(1980 + p.p_partkey % 40 AS INTEGER), CAST(1 + p.p_partkey % 12 AS INTEGER),
                   CAST(1 + p.p_partkey % 28 AS INTEGER)) AS release_date,
         s.popularity
  FROM part p JOIN v_sales s ON p.p_partkey = s.item_id""",
    ),
    "v_raw_items": (("v_items",), _raw_items(True)),
    "v_text_items": (("v_items",), _raw_items(False)),
    "v_links": (
        (),
        f"""SELECT p_partkey AS movie_id, p_partkey * 7 + 3 AS tmdb_id, 'tt' || lpad(CAST(p_partkey AS VARCHAR), 7, '0') AS imdb_id
  FROM part UNION ALL
  SELECT -p_partkey, NULL, 'tt' || lpad(CAST(p_partkey AS VARCHAR), 7, '0') FROM part WHERE p_partkey % {V.NULL_TMDB_MOD} = 0""",
    ),
    "v_titles": (("v_items",), "SELECT item_id * 7 + 3 AS tmdb_id, title FROM v_items"),
    "v_partial_titles": (
        ("v_items",),
        f"SELECT item_id * 7 + 3 AS tmdb_id, title FROM v_items WHERE item_id % {V.UNTITLED_MOD} <> 0",
    ),
    "v_raw_ratings": (
        ("v_ratings",),
        f"""SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(item_id AS VARCHAR) AS item_id,
         CASE WHEN (user_id * 31 + item_id) % {V.BAD_RATING_MOD} = 0 THEN 'n/a' ELSE CAST(rating AS VARCHAR) END AS rating
  FROM v_ratings""",
    ),
    "v_clean_items": (("v_raw_items",), _clean_items("v_raw_items")),
    "v_whole_items": (("v_text_items",), _clean_items("v_text_items")),
    "v_analysis": (
        ("v_whole_items",),
        f"""SELECT * FROM v_whole_items WHERE vote_count > {V.EDA_MIN_VOTES}""",
    ),
    "v_doc_labels": (
        (),
        """SELECT d.doc_id, d.lang, d.n_chars, l.quality, l.toxic
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
    ),
}


def _order(names: tuple[str, ...]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for dep in _CTES[n][0]:
            visit(dep)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def with_views(sql: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with the adapter CTEs ``names`` (and their dependencies) and then ``extra`` CTEs, in order."""
    parts = [f"{n} AS (\n  {_CTES[n][1]}\n)" for n in _order(names)]
    for n, body in (extra or {}).items():
        parts.append(f"{n} AS (\n  {body}\n)")
    if not parts:
        return sql
    return "WITH " + ",\n".join(parts) + "\n" + sql
