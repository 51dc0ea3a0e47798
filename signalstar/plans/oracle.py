"""The same questions as plain SQL over the same tables, written independently of the
Spark plans (joins and range conditions where the plans use windows)."""

from __future__ import annotations

from signalstar.functions.text import STOPWORDS
from signalstar.sources.reference_rows import ENTITY_INFO, REGION_CODES, REGION_PLACES


def week(day: str) -> str:
    return f"({day} - CAST(dayofweek({day}) AS INTEGER))"


def key(day: str) -> str:
    return f"CAST(strftime({day}, '%Y%m%d') AS INTEGER)"


def day_of(number: str) -> str:
    return f"CAST(strptime(CAST({number} AS VARCHAR), '%Y%m%d') AS DATE)"


def rnd(value: str, digits: int = 2) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(38,8)), {digits}) AS DOUBLE)"


def grow(current: str, baseline: str) -> str:
    return f"100.0 * ({current} - {baseline}) / nullif({baseline}, 0)"


ORDER_DAY = "CAST(o_orderdate AS DATE)"
EVENT_DAY = "CAST(ts AS DATE)"
TITLE = "upper(left({0}, 1)) || lower(substr({0}, 2))"

STAR = f"""
WITH placed AS (
  SELECT c_custkey, c_mktsegment AS entity_id, n_regionkey AS customer_region
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
d_entities AS (
  SELECT c_mktsegment AS entity_id, {TITLE.format("c_mktsegment")} AS entity_name,
         'buys ' || lower(c_mktsegment) AS primary_usage, CAST(NULL AS VARCHAR) AS price_range,
         avg(c_acctbal) > 4500 AS approved
  FROM customer GROUP BY c_mktsegment),
d_regions AS (
  SELECT r_regionkey AS region_id, r_name AS region_name, 1000 * count(*) AS population
  FROM region JOIN placed ON customer_region = r_regionkey GROUP BY ALL),
d_sources AS (
  SELECT CAST(source_id AS INTEGER) AS source_id, source_name,
         CAST(reliability AS INTEGER) AS reliability
  FROM (VALUES (1, 'Search trends', 7), (2, 'Page views', 6), (3, 'Bulletins', 9))
       AS v(source_id, source_name, reliability)),
d_weeks AS (
  SELECT CAST(unnest(generate_series(
    CAST((SELECT min({week(ORDER_DAY)}) FROM orders) AS TIMESTAMP),
    CAST((SELECT max({ORDER_DAY}) FROM orders) AS TIMESTAMP), INTERVAL 7 DAY)) AS DATE) AS date),
d_dates AS (
  SELECT {key("date")} AS date_id, date, CAST(month(date) AS INTEGER) AS month,
         CAST(quarter(date) AS INTEGER) AS quarter, CAST(year(date) AS INTEGER) AS year
  FROM d_weeks),
f_interest AS (
  SELECT {key(week(ORDER_DAY))} AS date_id, {week(ORDER_DAY)} AS date, entity_id,
         CASE WHEN o_orderpriority NOT IN ('4-NOT SPECIFIED', '5-LOW') THEN customer_region END
           AS region_id,
         CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 WHEN 'P' THEN 3 END AS INTEGER)
           AS source_id,
         o_totalprice AS interest_score
  FROM orders JOIN placed ON o_custkey = c_custkey),
named AS (
  SELECT f.*, entity_name, source_name
  FROM f_interest f JOIN d_entities USING (entity_id) JOIN d_sources USING (source_id)),
first_source AS (SELECT * FROM named WHERE source_name = 'Search trends'),
event_rows AS (
  SELECT entity_id, {week(EVENT_DAY)} AS event_date,
         CASE WHEN event_type <> 'error' THEN customer_region END AS region_id,
         event_type AS category, user_id, props, event_id, ts, value
  FROM events JOIN placed ON user_id = c_custkey),
f_events AS (
  SELECT event_date, count(*) AS related_article_count,
         count(DISTINCT user_id) AS source_count, category,
         arg_min(props, event_id) FILTER (WHERE props IS NOT NULL) AS title, region_id, entity_id
  FROM event_rows GROUP BY entity_id, event_date, region_id, category)
"""


def on_star(sql: str) -> str:
    return STAR + sql


def growth(rows: str, keys: str = "", label: str = "growth_pct", bounds: str | None = None) -> str:
    """Mean score of the last against the first 90 days, each period aggregated by itself."""
    bounds = bounds or rows
    first = f"date - (SELECT min(date) FROM {bounds}) < 90"
    last = f"(SELECT max(date) FROM {bounds}) - date < 90"
    by = f"GROUP BY {keys}" if keys else ""
    names = f"{keys}, " if keys else ""
    joined = f"early FULL JOIN late USING ({keys})" if keys else "early, late"
    return f"""
SELECT {names}{rnd("before_mean")} AS baseline_avg, {rnd("now_mean")} AS current_avg,
       {rnd(grow("now_mean", "before_mean"))} AS {label}
FROM (WITH early AS (SELECT {names}avg(interest_score) AS before_mean FROM {rows} WHERE {first} {by}),
           late AS (SELECT {names}avg(interest_score) AS now_mean FROM {rows}
                    WHERE {last} AND NOT {first} {by})
      SELECT * FROM {joined})"""


def year_over_year(whole: str) -> str:
    """The newest year's mean after the one before it, if that is the calendar year before."""
    return f"""
, yearly AS (
  SELECT year(date) AS y, avg(interest_score) AS m FROM first_source GROUP BY y HAVING {whole}),
steps AS (
  SELECT y, m, CASE WHEN lag(y) OVER in_order = y - 1 THEN lag(m) OVER in_order END AS earlier
  FROM yearly WINDOW in_order AS (ORDER BY y))
SELECT CAST(max(y) AS INTEGER) AS current_year, CAST(max(y) - 1 AS INTEGER) AS prior_year,
       {rnd("arg_max(m, y)")} AS current_year_avg,
       {rnd("first(earlier ORDER BY y DESC)")} AS prior_year_avg,
       {rnd(grow("arg_max(m, y)", "first(earlier ORDER BY y DESC)"))} AS yoy_growth_pct
FROM steps"""


REGIONAL = """
, regional AS (
  SELECT f.*, region_name, population FROM f_interest f JOIN d_regions USING (region_id))
"""

ENTITY_GROWTH = growth("first_source", "entity_name")

TABLES = ["entities", "regions", "sources", "dates", "interest", "events"]
CTES = {
    "entities": "d_entities", "regions": "d_regions", "sources": "d_sources",
    "dates": "d_dates", "interest": "f_interest", "events": "f_events",
}
COLUMNS = {
    "entities": ["entity_id", "entity_name", "primary_usage", "price_range", "approved"],
    "regions": ["region_id", "region_name", "population"],
    "sources": ["source_id", "source_name", "reliability"],
    "dates": ["date_id", "date", "month", "quarter", "year"],
    "interest": ["date_id", "entity_id", "region_id", "source_id", "interest_score"],
    "events": ["event_date", "related_article_count", "source_count", "category", "title",
               "region_id", "entity_id"],
}


def union_all(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


ROW_COUNTS = union_all(
    [f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {CTES[t]}" for t in TABLES]
)
NULL_PROFILE = union_all(
    [
        f"SELECT '{t}' AS table_name, '{c}' AS column_name,"
        f" count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM {CTES[t]}"
        for t in TABLES
        for c in COLUMNS[t]
    ]
)


def check(table: str, name: str, column: str, cte: str, bad: str) -> str:
    return f"""
SELECT '{table}' AS table_name, '{name}' AS check_name, '{column}' AS column_name,
       count(*) FILTER (WHERE {bad}) AS n_bad,
       CAST(min({column}) FILTER (WHERE {bad}) AS VARCHAR) AS sample
FROM {cte}"""


def count_check(table: str, name: str, column: str, cte: str, counted: str, expected: int) -> str:
    n = f"count(*) FILTER (WHERE {counted})"
    return f"""
SELECT '{table}', '{name}', '{column}', abs({n} - {expected}),
       CASE WHEN {n} <> {expected} THEN CAST({n} AS VARCHAR) END
FROM {cte}"""


def orphan_check(table: str, column: str, cte: str, parents: str) -> str:
    return f"""
SELECT '{table}', 'foreign_key', '{column}', count(*), CAST(min(v) AS VARCHAR)
FROM (SELECT DISTINCT {column} AS v FROM {cte}
      WHERE {column} IS NOT NULL AND {column} NOT IN ({parents}))"""


EVENT_WEEKS = f"""SELECT unnest(generate_series(
    CAST((SELECT min({week(EVENT_DAY)}) FROM events) AS TIMESTAMP),
    CAST((SELECT max({EVENT_DAY}) FROM events) AS TIMESTAMP), INTERVAL 7 DAY))"""

DQ_REPORT = union_all(
    [
        *[check("interest", "no_nulls", c, "f_interest", f"{c} IS NULL")
          for c in ("date_id", "entity_id", "region_id", "interest_score")],
        check("interest", "date_bounds", "date_id", "f_interest",
              "date NOT BETWEEN DATE '1995-01-08' AND DATE '2000-12-31'"),
        check("interest", "valid_ids", "source_id", "f_interest", "source_id NOT IN (1, 2)"),
        check("interest", "within", "interest_score", "f_interest",
              "interest_score NOT BETWEEN 2000 AND 480000"),
        count_check("interest", "regional_row_count", "region_id", "f_interest",
                    "region_id IS NOT NULL", 1000),
        orphan_check("interest", "entity_id", "f_interest", "SELECT entity_id FROM d_entities"),
        orphan_check("interest", "region_id", "f_interest",
                     "SELECT region_id FROM d_regions WHERE population > 300000"),
        orphan_check("interest", "date_id", "f_interest",
                     f"SELECT {key('CAST(w AS DATE)')} FROM ({EVENT_WEEKS} AS w)"),
        check("events", "no_nulls", "event_date", "f_events", "event_date IS NULL"),
        check("events", "no_nulls", "title", "f_events", "title IS NULL"),
        check("events", "at_least", "related_article_count", "f_events",
              "related_article_count < 12"),
        check("events", "not_above", "source_count", "f_events",
              "source_count > related_article_count"),
        count_check("customer", "row_count", "*", "customer", "true", 1000),
        """
SELECT 'customer', 'unique', 'c_nationkey', count(*), min(CAST(c_nationkey AS VARCHAR))
FROM (SELECT c_nationkey FROM customer GROUP BY c_nationkey HAVING count(*) > 1)""",
    ]
)

FACT_ROWS = """
SELECT {k}, {n}, coalesce(i.n, 0) AS interest_rows, coalesce(e.n, 0) AS event_rows
FROM {dim}
LEFT JOIN (SELECT {k}, count(*) AS n FROM f_interest WHERE {k} IS NOT NULL GROUP BY {k}) i USING ({k})
LEFT JOIN (SELECT {k}, count(*) AS n FROM f_events WHERE {k} IS NOT NULL GROUP BY {k}) e USING ({k})
"""

DESCRIBED = ["c_nationkey", "c_mktsegment", "c_acctbal"]
# Numbers are described by the text Spark gives them; these columns print alike here.
DESCRIBE = union_all(
    [
        f"""
SELECT '{c}' AS column_name, CAST((SELECT count({c}) FROM customer) AS BIGINT) AS n_values,
       CAST((SELECT count(DISTINCT {c}) FROM customer) AS BIGINT) AS n_unique, v AS top, n AS freq
FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM customer WHERE {c} IS NOT NULL
      GROUP BY ALL ORDER BY n DESC, v LIMIT 1)"""
        for c in DESCRIBED
    ]
)

WIDE = ["doc_id", "text", "lang", "source", "n_chars"]
DESCRIBE_WIDE = union_all(
    [
        f"""
SELECT '{c}' AS column_name, CAST((SELECT count({c}) FROM documents) AS BIGINT) AS n_values,
       CAST((SELECT count(DISTINCT {c}) FROM documents) AS BIGINT) AS n_unique, v AS top, n AS freq
FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM documents WHERE {c} IS NOT NULL
      GROUP BY ALL ORDER BY n DESC, v LIMIT 1)"""
        for c in WIDE
    ]
)
FREQUENT = union_all(
    [
        f"""
SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n,
       CAST((SELECT count({c}) FROM documents) AS BIGINT) AS n_values
FROM documents WHERE {c} IS NOT NULL GROUP BY ALL HAVING count(*) >= 0.01 * n_values"""
        for c in WIDE
    ]
)
PROBLEM = """
SELECT problem, count(*) AS n_rows, count(*) FILTER (WHERE problem IS NULL) AS n_stamps,
       count(props) FILTER (WHERE problem IS NULL OR problem = 'stamp') AS n_titles
FROM (SELECT props, CASE WHEN event_id % 97 = 0 THEN 'body' WHEN event_id % 89 = 0 THEN 'record'
                         WHEN event_id % 83 = 0 THEN 'uids' WHEN event_id % 79 = 0 THEN 'stamp' END AS problem
      FROM event_rows)
GROUP BY problem"""


def _listed(rows: list[tuple]) -> str:
    def literal(v) -> str:
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)

    return ", ".join("(" + ", ".join(map(literal, r)) + ")" for r in rows)


PLACE_ROWS = f"""
WITH places(number, code, place) AS (VALUES {_listed([(i, *p) for i, p in enumerate(REGION_PLACES)])}),
regions(region_id, code) AS (VALUES {_listed([(i, c) for i, (_, c) in enumerate(REGION_CODES, 1)])}),
yearly AS (
  SELECT c_nationkey % {len(REGION_PLACES) + 1} AS number, year(o_orderdate) AS year, count(*) AS people
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL),
newest AS (SELECT number, max(year) AS year, arg_max(people, year) AS population FROM yearly GROUP BY number)
SELECT code, place, CAST(region_id AS INTEGER) AS region_id, CAST(population AS BIGINT) AS population,
       CAST(year AS VARCHAR) AS year
FROM places LEFT JOIN regions USING (code) LEFT JOIN newest USING (number)"""
AUTHORED_ENTITIES = f"""
WITH authored(number, entity_id, entity_name, approved, usage_length) AS (
  VALUES {_listed([(i, i + 1, n, ok, len(usage)) for i, (n, usage, ok) in enumerate(ENTITY_INFO)])}),
counted AS (
  SELECT user_id % {len(ENTITY_INFO) + 1} AS number, count(*) AS n_rows,
         count(*) FILTER (WHERE value > 0) AS n_positive
  FROM events GROUP BY ALL)
SELECT CAST(entity_id AS INTEGER) AS entity_id, entity_name, approved, CAST(usage_length AS INTEGER) AS usage_length,
       coalesce(n_rows, 0) AS n_rows, coalesce(n_positive, 0) AS n_positive
FROM authored FULL JOIN counted USING (number)"""

BY_SOURCE = """
, by_source AS (
  SELECT date, entity_name,
         avg(interest_score) FILTER (WHERE source_name = 'Search trends') AS a,
         avg(interest_score) FILTER (WHERE source_name = 'Page views') AS b,
         avg(interest_score) FILTER (WHERE source_name = 'Bulletins') AS c
  FROM named GROUP BY date, entity_name)
"""

AGREEMENT = """
, signals AS (
  SELECT entity_id, 'interest:' || source_id AS signal, date, interest_score AS score, 90 AS days
  FROM f_interest
  UNION ALL
  SELECT entity_id, 'events:' || category, event_date, NULL, 14 FROM f_events),
limits AS (SELECT signal, min(date) AS lo, max(date) AS hi FROM signals GROUP BY signal),
periods AS (
  SELECT s.*, CASE WHEN date < lo + days THEN 'before' WHEN date > hi - days THEN 'after' END AS p
  FROM signals s JOIN limits USING (signal)),
levels AS (
  SELECT entity_id, signal,
    CASE WHEN signal LIKE 'interest:%' THEN avg(score) FILTER (WHERE p = 'before')
         ELSE count(*) FILTER (WHERE p = 'before') END AS before,
    CASE WHEN signal LIKE 'interest:%' THEN avg(score) FILTER (WHERE p = 'after')
         ELSE count(*) FILTER (WHERE p = 'after') END AS after
  FROM periods GROUP BY entity_id, signal)
SELECT entity_name, count(*) AS n_sources, count(*) FILTER (WHERE after > before) AS n_rising,
       count(*) FILTER (WHERE after > before) >= 3 AS corroborated
FROM levels JOIN d_entities USING (entity_id) GROUP BY entity_name
"""

LIFT = f"""
, weekly AS (
  SELECT entity_id, date, avg(interest_score) AS score FROM first_source GROUP BY ALL),
urgent AS (
  SELECT entity_id, {week(ORDER_DAY)} AS date, count(*) AS n
  FROM orders JOIN placed ON o_custkey = c_custkey
  WHERE o_orderpriority = '1-URGENT' GROUP BY ALL),
marks AS (
  SELECT entity_id, date FROM urgent
  JOIN (SELECT entity_id, quantile_cont(n, 0.95) AS q FROM urgent GROUP BY entity_id)
    USING (entity_id)
  WHERE n >= q),
spots AS (SELECT entity_id, date FROM marks UNION SELECT entity_id, date FROM weekly),
around AS (
  SELECT p.entity_id, p.date, avg(w.score) FILTER (WHERE w.date < p.date) AS pre,
         avg(w.score) FILTER (WHERE w.date >= p.date) AS post
  FROM spots p LEFT JOIN weekly w
    ON w.entity_id = p.entity_id AND w.date >= p.date - 28 AND w.date < p.date + 28
  GROUP BY ALL),
quiet AS (
  SELECT entity_id, date FROM weekly w
  WHERE NOT EXISTS (SELECT 1 FROM marks m WHERE m.entity_id = w.entity_id
                    AND m.date >= w.date - 28 AND m.date < w.date + 28)),
control AS (
  SELECT m.entity_id, m.date, max(q.date) AS control_week
  FROM marks m LEFT JOIN quiet q ON q.entity_id = m.entity_id AND q.date <= m.date - 56
  GROUP BY ALL),
lifted AS (
  SELECT c.entity_id, c.date AS event_date, control_week, e.pre, e.post,
         {grow("e.post", "e.pre")} AS lift, {grow("b.post", "b.pre")} AS base
  FROM control c
  JOIN around e ON e.entity_id = c.entity_id AND e.date = c.date
  LEFT JOIN around b ON b.entity_id = c.entity_id AND b.date = c.control_week),
level AS (
  SELECT entity_id, avg(score) + 2 * stddev_samp(score) AS lim FROM weekly GROUP BY entity_id),
spikes AS (
  SELECT w.entity_id, w.date,
         EXISTS (SELECT 1 FROM lifted l WHERE l.entity_id = w.entity_id
                 AND l.event_date BETWEEN w.date - 28 AND w.date AND l.lift - l.base > 0) AS hit
  FROM weekly w JOIN level USING (entity_id) WHERE w.score >= lim)
"""
ATTRIBUTION = f"""count(*) AS total_spikes, count(*) FILTER (WHERE hit) AS attributed_spikes,
  {rnd("100.0 * count(*) FILTER (WHERE hit) / nullif(count(*), 0)")} AS attribution_rate_pct
FROM spikes"""

PERCENT_TEXT_VALUE = """CASE WHEN {0} % 7 <= 1 THEN 0.0 WHEN {0} % 7 <= 3 THEN 0.5
  ELSE CAST({0} AS DOUBLE) END"""

NATIONAL = """
, national AS (
  SELECT entity_id, date, date_id, CASE WHEN avg(interest_score) < 180000 THEN 0.5
         ELSE CAST(floor(avg(interest_score) / 5000.0) AS DOUBLE) END AS interest_score
  FROM f_interest GROUP BY ALL)
"""
SNAPSHOTS = f"""
, counted AS (
  SELECT entity_id, region_id, CASE WHEN date_id < 19980101 THEN 'baseline' ELSE 'current' END AS w,
         count(*) % 100 AS n
  FROM f_interest WHERE region_id IS NOT NULL GROUP BY ALL),
snapshots AS (
  SELECT entity_id, region_id, region_name, w,
         CASE w WHEN 'baseline' THEN DATE '2023-01-01' ELSE DATE '2026-05-10' END AS date,
         {PERCENT_TEXT_VALUE.format("n")} AS interest_score
  FROM counted JOIN d_regions USING (region_id))
"""

THOUSANDS = "CAST(floor(o_totalprice / 1000.0) AS BIGINT)"


PAGEVIEWS = f"""
, totals AS (
  SELECT entity_id, event_date, CAST(sum(CAST(floor(value) AS BIGINT)) AS DOUBLE) AS t
  FROM event_rows GROUP BY ALL),
peaks AS (SELECT entity_id, max(t) AS peak FROM totals GROUP BY entity_id),
pageviews AS (
  SELECT entity_id, event_date, {key("event_date")} AS date_id,
         CASE WHEN peak > 0 THEN t / peak * 100.0 ELSE 0.0 END AS score
  FROM totals JOIN peaks USING (entity_id))
"""


def rolled(
    where: str, publisher: str, category: str, times: int, title: str = "arg_min(props, event_id)"
) -> str:
    return f"""
SELECT event_date, CAST({times} * count(*) AS BIGINT) AS related_article_count,
       count(DISTINCT {publisher}) AS source_count, '{category}' AS category,
       {title} AS title, CAST(NULL AS INTEGER) AS region_id, entity_id
FROM event_rows {where} GROUP BY entity_id, event_date"""


# The star read from files: entities by number, sources 1 (trends) and 4 (page views).
RAW = NATIONAL + SNAPSHOTS + PAGEVIEWS + f"""
, numbers AS (
  SELECT entity_id, entity_name, CAST(rank() OVER (ORDER BY entity_name) AS INTEGER) AS number
  FROM d_entities),
raw_interest AS (
  SELECT date_id, date, number AS entity_id, entity_name, region_id, source_id, interest_score
  FROM (SELECT entity_id, date, date_id, CAST(NULL AS INTEGER) AS region_id, 1 AS source_id,
               interest_score FROM national
        UNION ALL SELECT entity_id, date, {key("date")}, region_id, 1, interest_score FROM snapshots
        UNION ALL SELECT entity_id, event_date, date_id, NULL, 4, score FROM pageviews)
  JOIN numbers USING (entity_id)),
raw_trends AS (SELECT * FROM raw_interest WHERE source_id = 1),
raw_events AS (
  SELECT e.* REPLACE (number AS entity_id)
  FROM ({rolled("", "user_id", "News/Media", 2, "min(props)")}
        UNION ALL {rolled("", "category", "Clinical research", 1, "min(props)")}) e
  JOIN numbers ON numbers.entity_id = e.entity_id)
"""
PROJECT_WEEKS = f"""SELECT {key("CAST(w AS DATE)")} FROM (SELECT unnest(generate_series(
    TIMESTAMP '2023-01-01', TIMESTAMP '2026-12-31', INTERVAL 7 DAY)) AS w)"""
PROJECT_DATES = "NOT BETWEEN DATE '2023-01-01' AND DATE '2026-12-31'"
RAW_INTEREST_REPORT = union_all(
    [
        *[check("interest", "no_nulls", c, "raw_interest", f"{c} IS NULL")
          for c in ("date_id", "entity_id", "source_id", "interest_score")],
        check("interest", "date_bounds", "date_id", "raw_interest", f"date {PROJECT_DATES}"),
        check("interest", "within", "interest_score", "raw_interest",
              "interest_score NOT BETWEEN 0 AND 100"),
        orphan_check("interest", "date_id", "raw_interest", PROJECT_WEEKS),
        orphan_check("interest", "entity_id", "raw_interest", "SELECT number FROM numbers"),
        orphan_check("interest", "region_id", "raw_interest", "SELECT region_id FROM d_regions"),
        orphan_check("interest", "source_id", "raw_interest", "SELECT unnest(range(1, 6))"),
    ]
)
RAW_EVENT_REPORT = union_all(
    [
        *[check("events", "no_nulls", c, "raw_events", f"{c} IS NULL")
          for c in ("event_date", "related_article_count", "source_count", "category", "title",
                    "entity_id")],
        check("events", "date_bounds", "event_date", "raw_events", f"event_date {PROJECT_DATES}"),
        *[check("events", "at_least", c, "raw_events", f"{c} < 1")
          for c in ("related_article_count", "source_count")],
        check("events", "not_above", "source_count", "raw_events",
              "source_count > related_article_count"),
        orphan_check("events", "entity_id", "raw_events", "SELECT number FROM numbers"),
        orphan_check("events", "region_id", "raw_events", "SELECT region_id FROM d_regions"),
    ]
)
SHEET = """
SELECT 'N' || n_nationkey AS ons_code, n_name AS region_name,
       nullif(count(*) FILTER (WHERE year(o_orderdate) = newest), 0) AS population,
       CAST(any_value(newest) AS VARCHAR) AS year
FROM (SELECT *, max(year(o_orderdate)) OVER () AS newest FROM orders) AS orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_nationkey, n_name"""


TOP_WORDS = f"""
WITH pieces AS (
  SELECT source, doc_id, regexp_split_to_array(lower(text), '[^A-Za-z]+') AS a FROM documents),
words AS (
  SELECT source, doc_id, unnest(a) AS word, unnest(range(len(a))) AS i FROM pieces),
counted AS (
  SELECT source, word, count(*) AS n, min(doc_id * 100000000 + i) AS seen
  FROM words
  WHERE length(word) >= 4 AND word NOT IN ({", ".join(f"'{w}'" for w in STOPWORDS)})
    AND word <> regexp_replace(source, '[^a-z]', '', 'g')
  GROUP BY source, word),
ranked AS (
  SELECT source, word, n,
         CAST(row_number() OVER (PARTITION BY source ORDER BY n DESC, seen) AS INTEGER) AS rank
  FROM counted)
SELECT * FROM ranked WHERE rank <= 15
"""

SCORE_DISTRIBUTION = f"""
SELECT source_name, count(*) AS n, min(interest_score) AS min_score,
       {rnd("quantile_cont(interest_score, 0.25)")} AS p25,
       {rnd("quantile_cont(interest_score, 0.5)")} AS median,
       {rnd("avg(interest_score)")} AS mean_score,
       {rnd("quantile_cont(interest_score, 0.75)")} AS p75,
       max(interest_score) AS max_score, {rnd("stddev(interest_score)")} AS stddev_score
FROM named GROUP BY source_name"""

PIVOT_TYPES = ["click", "error", "purchase", "signup", "view"]

SQL: dict[str, str] = {
    "dq_row_counts": on_star(ROW_COUNTS),
    "dq_null_region": on_star(
        union_all(
            [
                f"SELECT '{t}' AS table_name, count(*) FILTER (WHERE region_id IS NULL)"
                f" AS null_region_id, count(*) AS total_rows FROM {CTES[t]}"
                for t in ("interest", "events")
            ]
        )
    ),
    "dq_null_rate_by_source": on_star(f"""
SELECT source_name, count(*) AS total_rows,
       count(*) FILTER (WHERE region_id IS NULL) AS null_region_rows,
       {rnd("100.0 * count(*) FILTER (WHERE region_id IS NULL) / count(*)")} AS pct_null_region_id
FROM named GROUP BY source_name"""),
    "dq_dup_interest": on_star("""
SELECT date_id, entity_id, region_id, source_id, count(*) AS n FROM f_interest
GROUP BY ALL HAVING count(*) > 1"""),
    "dq_dup_events": on_star("""
SELECT event_date, entity_id, category, title, count(*) AS n FROM f_events
GROUP BY ALL HAVING count(*) > 1"""),
    "dq_score_range": on_star(f"""
SELECT source_name, min(interest_score) AS min_score, max(interest_score) AS max_score,
       {rnd("avg(interest_score)")} AS avg_score, {rnd("stddev(interest_score)")} AS stddev_score
FROM named GROUP BY source_name"""),
    "dq_null_profile": on_star(NULL_PROFILE),
    "dq_report": on_star(DQ_REPORT),
    "dq_unreadable": on_star(NATIONAL + """
SELECT 'news' AS table_name, 'no_nulls' AS check_name, 'pos' AS column_name,
       count(*) FILTER (WHERE event_id % 97 = 0) AS n_bad, CAST(NULL AS VARCHAR) AS sample
FROM event_rows
UNION ALL SELECT 'publications', 'no_nulls', 'stamp',
       count(*) FILTER (WHERE event_id % 89 = 0), NULL FROM event_rows
UNION ALL SELECT 'publications', 'unreadable_stamp', 'stamp',
       count(*) FILTER (WHERE event_id % 83 = 0 AND event_id % 89 <> 0),
       min('about ' || strftime(ts, '%Y/%m/%d %H:%M'))
         FILTER (WHERE event_id % 83 = 0 AND event_id % 89 <> 0) FROM event_rows
UNION ALL SELECT 'national', 'no_nulls', 'date',
       count(*) FILTER (WHERE dayofyear(date) % 13 = 0), NULL FROM national
UNION ALL SELECT 'pageviews', 'no_nulls', 'date', count(*) FILTER (WHERE hour(ts) = 7), NULL FROM event_rows
UNION ALL SELECT 'population', 'no_nulls', 'region_name',
       count(DISTINCT n_nationkey) FILTER (WHERE n_name LIKE 'I%'), NULL
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""),
    "dq_fk_offenders": """
SELECT DISTINCT o_custkey AS value FROM orders
WHERE o_custkey NOT IN (SELECT s_suppkey FROM supplier) ORDER BY 1 LIMIT 10""",
    "dq_missing_authored": on_star("SELECT entity_name FROM d_entities WHERE price_range IS NULL"),
    "dq_source_cap": """
SELECT user_id, count(*) AS n FROM events GROUP BY user_id HAVING count(*) >= 60""",
    "prof_entities": on_star("SELECT * FROM d_entities"),
    "prof_regions": on_star("SELECT * FROM d_regions"),
    "prof_sources": """
SELECT o_orderstatus AS source_id, 'status ' || o_orderstatus AS source_name,
       CAST(floor(avg(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1.0 ELSE 0 END)
                  * 1000) AS INTEGER) AS reliability
FROM orders GROUP BY o_orderstatus""",
    "prof_date_range": on_star("""
SELECT min(date) AS earliest_date, max(date) AS latest_date, count(*) AS n_weeks FROM d_dates"""),
    "prof_entity_coverage": on_star(
        FACT_ROWS.format(k="entity_id", n="entity_name", dim="d_entities")
    ),
    "prof_region_coverage": on_star(
        FACT_ROWS.format(k="region_id", n="region_name", dim="d_regions")
    ),
    "prof_describe": DESCRIBE,
    "prof_describe_wide": DESCRIBE_WIDE,
    "prof_frequent_values": FREQUENT,
    "dq_publication_problems": on_star(PROBLEM),
    "src_places": PLACE_ROWS,
    "src_authored_entities": AUTHORED_ENTITIES,
    "prof_describe_entities": on_star("""
, pairs AS (
  UNPIVOT (SELECT primary_usage, coalesce(price_range, '') AS price_range,
                  CAST(approved AS VARCHAR) AS approved FROM d_entities)
  ON primary_usage, price_range, approved INTO NAME column_name VALUE v),
counted AS (SELECT column_name, nullif(v, '') AS v, count(nullif(v, '')) AS n FROM pairs GROUP BY ALL)
SELECT column_name, CAST(sum(n) AS BIGINT) AS n_values, count(v) AS n_unique,
       first(v ORDER BY n DESC, v) AS top, nullif(max(n), 0) AS freq
FROM counted GROUP BY column_name"""),
    "prof_describe_scores": on_star(f"""
SELECT source_name, count(interest_score) AS n_values, {rnd("avg(interest_score)", 4)} AS mean,
       {rnd("stddev(interest_score)", 4)} AS std, min(interest_score) AS min,
       {rnd("quantile_cont(interest_score, 0.25)", 4)} AS p25,
       {rnd("quantile_cont(interest_score, 0.5)", 4)} AS p50,
       {rnd("quantile_cont(interest_score, 0.75)", 4)} AS p75, max(interest_score) AS max
FROM named GROUP BY source_name"""),
    "dist_score_by_source": on_star(SCORE_DISTRIBUTION),
    "dist_score_bracketed": on_star(SCORE_DISTRIBUTION),
    "dist_histogram": on_star("""
SELECT source_name, bucket, (bucket - 1) * 25000.0::DOUBLE AS bucket_low, n FROM (
  SELECT source_name, CAST(least(floor(interest_score / 25000.0) + 1, 20) AS INTEGER) AS bucket,
         count(*) AS n
  FROM named GROUP BY ALL)"""),
    "trend_weekly": on_star(f"""
SELECT date, entity_name, source_name, {rnd("avg(interest_score)")} AS avg_interest_score
FROM named GROUP BY date, entity_name, source_name"""),
    "bi_trend_line": on_star(f"""
SELECT date, entity_name, source_name, {rnd("avg(interest_score)")} AS avg_interest_score
FROM first_source GROUP BY date, entity_name, source_name"""),
    "growth_entity_source": on_star(growth("named", "entity_name, source_name", bounds="d_dates")),
    "regional_detail": on_star(REGIONAL + """
SELECT region_name, entity_name, date, interest_score
FROM regional JOIN d_entities USING (entity_id)"""),
    "regional_growth": on_star(REGIONAL + growth("regional", "region_name, population")),
    "regional_per_million": on_star(REGIONAL + f"""
SELECT region_name, population, {rnd("avg(interest_score)")} AS raw_avg_interest,
       {rnd("avg(interest_score) / (population / 1000000.0)", 4)} AS interest_per_million_pop
FROM regional GROUP BY region_name, population"""),
    "bi_per_million_total": on_star(f"""
SELECT {rnd("(SELECT avg(interest_score) FROM first_source WHERE region_id IS NOT NULL)"
            " / ((SELECT sum(population) FROM d_regions) / 1000000.0)", 4)}
  AS interest_per_million_pop"""),
    "cross_source_weekly": on_star(BY_SOURCE + f"""
SELECT date, entity_name, {rnd("a")} AS first_score, {rnd("b")} AS second_score FROM by_source"""),
    "cross_source_pivot": on_star(BY_SOURCE + f"""
SELECT date, entity_name, {rnd("a")} AS "Search trends", {rnd("b")} AS "Page views",
       {rnd("c")} AS "Bulletins" FROM by_source"""),
    "cross_source_corr": on_star(BY_SOURCE + f"""
SELECT entity_name, count(*) AS n_weeks, count(a + b) AS n_pairs,
       {rnd("covar_pop(a, b) / nullif(sqrt(var_pop(CASE WHEN b IS NOT NULL THEN a END)"
            " * var_pop(CASE WHEN a IS NOT NULL THEN b END)), 0)", 3)} AS correlation
FROM by_source GROUP BY entity_name"""),
    "source_agreement": on_star(AGREEMENT),
    "events_by_category": on_star(
        "SELECT category, count(*) AS n_events FROM f_events GROUP BY category"
    ),
    "events_by_quarter": on_star("""
SELECT CAST(year(event_date) AS INTEGER) AS year, CAST(quarter(event_date) AS INTEGER) AS quarter,
       category, count(*) AS n_events
FROM f_events GROUP BY ALL"""),
    "events_by_entity": on_star("""
SELECT entity_name, count(*) AS n_events FROM f_events JOIN d_entities USING (entity_id)
GROUP BY entity_name"""),
    "events_high_attention": on_star("""
SELECT event_date, entity_name, category, title, related_article_count, source_count
FROM f_events JOIN d_entities USING (entity_id)
QUALIFY related_article_count >= quantile_cont(related_article_count, 0.9) OVER (PARTITION BY category)
     OR source_count >= quantile_cont(source_count, 0.9) OVER (PARTITION BY category)"""),
    "events_quarter_pivot": on_star(f"""
SELECT CAST(date_trunc('quarter', event_date) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE)
         AS quarter_end,
       {", ".join(f"nullif(count(*) FILTER (WHERE category = '{t}'), 0) AS {t}" for t in PIVOT_TYPES)}
FROM f_events GROUP BY ALL"""),
    "events_on_calendar": on_star("""
SELECT CAST(strftime(event_date, '%Y%m%d') AS INTEGER) AS date_id, event_date AS date,
       CAST(quarter(event_date) AS INTEGER) AS quarter, CAST(year(event_date) AS INTEGER) AS year,
       count(*) AS n_events, CAST(sum(related_article_count) AS BIGINT) AS n_articles
FROM f_events GROUP BY event_date"""),
    "bi_events_year_quarter": on_star("""
SELECT 'Q' || quarter(event_date) || ' ' || year(event_date) AS year_quarter, category,
       count(*) AS n_events
FROM f_events GROUP BY ALL"""),
    "bi_top_events": on_star("""
, ranked AS (SELECT *, rank() OVER (ORDER BY related_article_count DESC) AS rank FROM f_events)
SELECT event_date, entity_name, category, title, related_article_count, source_count, rank
FROM ranked JOIN d_entities USING (entity_id) WHERE rank <= 15"""),
    "kpi_overall_growth": on_star(growth("first_source", label="overall_growth_pct")),
    "kpi_overall_growth_national": on_star(
        ", country AS (SELECT * FROM first_source WHERE region_id IS NULL)"
        + growth("country", label="overall_growth_pct")
    ),
    "kpi_yoy_growth": on_star(year_over_year("true")),
    "kpi_yoy_growth_complete": on_star(year_over_year(
        "dayofyear(min(date)) <= 7 AND strftime(max(date), '%m%d') >= '1225'"
    )),
    "kpi_top_entity": on_star(ENTITY_GROWTH),
    "kpi_top_entity_stored": on_star(ENTITY_GROWTH),
    "kpi_top_region": on_star(REGIONAL + growth("regional", "region_name")),
    "kpi_largest_spike": on_star(f"""
SELECT entity_name, max(date) FILTER (WHERE interest_score = top) AS peak_date,
       max(top) AS peak_interest, {rnd("avg(interest_score)")} AS expected_interest,
       {rnd(grow("max(top)", "avg(interest_score)"))} AS spike_pct
FROM first_source
JOIN (SELECT entity_name, max(interest_score) AS top FROM first_source GROUP BY entity_name)
  USING (entity_name)
GROUP BY entity_name"""),
    "kpi_event_lift": on_star(LIFT + f"""
SELECT entity_id, event_date, control_week, {rnd("pre")} AS pre, {rnd("post")} AS post,
       {rnd("lift")} AS search_lift_pct, {rnd("base")} AS baseline_lift_pct,
       {rnd("lift - base")} AS excess_lift_pct
FROM lifted"""),
    "kpi_event_attribution": on_star(LIFT + f"SELECT {ATTRIBUTION}"),
    "kpi_event_attribution_by_entity": on_star(
        LIFT + f"SELECT entity_id, {ATTRIBUTION} GROUP BY entity_id"
    ),
    "kpi_event_lift_daily": f"""
WITH placed AS (SELECT c_custkey, c_mktsegment AS entity_id FROM customer JOIN nation ON c_nationkey = n_nationkey),
days AS (
  SELECT entity_id, {ORDER_DAY} AS date, o_totalprice AS score, o_orderpriority
  FROM orders JOIN placed ON o_custkey = c_custkey),
marks AS (SELECT DISTINCT entity_id, date FROM days WHERE o_orderpriority = '1-URGENT' AND score > 400000),
around AS (
  SELECT m.entity_id, m.date AS event_date, avg(score) FILTER (WHERE d.date < m.date) AS pre,
         avg(score) FILTER (WHERE d.date >= m.date) AS post
  FROM marks m LEFT JOIN days d
    ON d.entity_id = m.entity_id AND d.date >= m.date - 14 AND d.date < m.date + 14
  GROUP BY ALL)
SELECT entity_id, event_date, {rnd("pre")} AS pre, {rnd("post")} AS post,
       {rnd(grow("post", "pre"))} AS search_lift_pct
FROM around""",
    "dist_score_window": on_star(f"""
SELECT source_id, count(interest_score) AS n, {rnd("quantile_cont(interest_score, 0.25)")} AS p25,
       {rnd("quantile_cont(interest_score, 0.5)")} AS median, {rnd("quantile_cont(interest_score, 0.75)")} AS p75
FROM f_interest WHERE date_id BETWEEN 19950101 AND 19961231 GROUP BY source_id"""),
    "kpi_category_share": f"""
WITH counts AS (
  SELECT o_orderpriority AS category, count(*) AS n FROM orders
  WHERE o_orderpriority IS NOT NULL GROUP BY 1)
SELECT category, n, {rnd("100.0 * n / (SELECT count(o_orderpriority) FROM orders)")} AS share_pct,
       rank() OVER (ORDER BY n DESC) AS rank
FROM counts""",
    "bi_peak_rank": on_star(f"""
, peaks AS (
  SELECT entity_name, date, max(interest_score) AS peak FROM first_source GROUP BY ALL),
expected AS (SELECT entity_name, avg(interest_score) AS e FROM first_source GROUP BY entity_name),
ranked AS (
  SELECT *, CAST(rank() OVER (PARTITION BY entity_name ORDER BY peak DESC) AS INTEGER) AS peak_rank
  FROM peaks JOIN expected USING (entity_name))
SELECT entity_name, date, peak AS peak_interest, {rnd("e")} AS expected_interest,
       {rnd(grow("peak", "e"))} AS spike_pct, peak_rank
FROM ranked WHERE peak_rank = 1"""),
    "bi_date_bounds": on_star("""
SELECT 'all' AS scope, min(date) AS min_date, max(date) AS max_date FROM first_source
UNION ALL
SELECT 'regional', min(date), max(date) FROM first_source WHERE region_id IS NOT NULL"""),
    "bi_top_growing": on_star(REGIONAL + f"""
(SELECT 'entity' AS kind, entity_name AS name, growth_pct
 FROM ({growth("first_source", "entity_name")}) ORDER BY growth_pct DESC NULLS LAST, name LIMIT 1)
UNION ALL
(SELECT 'region', region_name AS name, growth_pct
 FROM ({growth("regional", "region_name")}) ORDER BY growth_pct DESC NULLS LAST, name LIMIT 1)"""),
    "cal_weeks": on_star("SELECT * FROM d_dates"),
    "cal_keys": f"""
WITH days AS (SELECT DISTINCT {ORDER_DAY} AS day FROM orders)
SELECT day, {week("day")} AS week, {key(week("day"))} AS date_id, day AS day_again,
       CAST(month(day) AS INTEGER) AS month, CAST(quarter(day) AS INTEGER) AS quarter,
       CAST(year(day) AS INTEGER) AS year,
       'Q' || quarter(day) || ' ' || year(day) AS year_quarter,
       CAST(date_trunc('quarter', day) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS quarter_end
FROM days""",
    "clean_scores": f"""
SELECT o_orderkey, {PERCENT_TEXT_VALUE.format(THOUSANDS)} AS percent_score,
       CASE {THOUSANDS} % 5 WHEN 0 THEN 0.5 WHEN 1 THEN NULL WHEN 2 THEN NULL
            ELSE CAST({THOUSANDS} AS DOUBLE) END AS national_score
FROM orders""",
    "src_national_rows": on_star(NATIONAL + """
SELECT entity_id AS entity_name, date, interest_score FROM national"""),
    "src_regional_rows": on_star(SNAPSHOTS + """
SELECT entity_id AS entity_name, lower(region_name) AS region_name, w AS "window", date,
       interest_score
FROM snapshots"""),
    "src_population": """
SELECT 'N' || n_nationkey AS ons_code, n_name AS region_name, count(*) AS population,
       CAST(year(o_orderdate) AS VARCHAR) AS year
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE n_nationkey < 20
GROUP BY n_nationkey, n_name, year(o_orderdate)
QUALIFY row_number() OVER (PARTITION BY n_nationkey ORDER BY year(o_orderdate) DESC) = 1""",
    "src_population_sheet": SHEET,
    "resolve_unknown_names": """
SELECT DISTINCT ' ' || upper(event_type) AS value FROM events""",
    "text_sentence_case": """
SELECT p_partkey, upper(left(p_name, 1)) || substr(p_name, 2) AS title FROM part""",
    "text_top_words": TOP_WORDS,
    "fact_trends": on_star(NATIONAL + SNAPSHOTS + f"""
SELECT date_id, entity_id, CAST(NULL AS INTEGER) AS region_id, 3 AS source_id, interest_score
FROM national
UNION ALL
SELECT {key("date")}, entity_id, region_id, 3, interest_score FROM snapshots"""),
    "fact_pageviews": on_star(PAGEVIEWS + """
SELECT date_id, entity_id, CAST(NULL AS INTEGER) AS region_id, 2 AS source_id,
       round(score, 6) AS interest_score
FROM pageviews"""),
    "fact_news": on_star(rolled("", "user_id", "News/Media", 2)),
    "fact_publications": on_star(
        rolled("WHERE event_date BETWEEN DATE '2024-01-07' AND DATE '2024-01-27'", "category",
               "Clinical research", 1)
    ),
    "fact_event_rollup": on_star("SELECT * FROM f_events"),
    "raw_kpi_top_entity": on_star(RAW + growth("raw_trends", "entity_name")),
    "raw_interest_report": on_star(RAW + RAW_INTEREST_REPORT),
    "raw_event_report": on_star(RAW + RAW_EVENT_REPORT),
    "raw_events": on_star(RAW + "SELECT * FROM raw_events"),
    "raw_population_sheet": SHEET,
    "load_missing_scores": on_star("""
SELECT source_id, count(*) AS n_rows, count(*) FILTER (WHERE date_id % 7 = 0) AS n_missing,
       CAST(0 AS BIGINT) AS n_nan
FROM f_interest GROUP BY source_id"""),
    "load_star_counts": on_star(f"""
SELECT table_name, row_count, row_count AS observed_rows FROM ({ROW_COUNTS}
UNION ALL SELECT 'interest_csv', count(*) FROM f_interest)"""),
    "load_refused_keeps_star": on_star(f"""
SELECT table_name, row_count, row_count AS loaded_rows, CAST(0 AS BIGINT) AS n_orphans FROM ({ROW_COUNTS})"""),
    "load_incremental_events": on_star("SELECT * FROM f_events"),
    "stream_event_rollup": on_star("""
SELECT entity_id, event_date, region_id, category, related_article_count, title,
       true AS publishers_within_error
FROM f_events"""),
    "stream_pageview_index": on_star(PAGEVIEWS + """
SELECT date_id, entity_id, round(score, 6) AS interest_score FROM pageviews"""),
    "cube_measures": on_star(REGIONAL + f"""
SELECT 'growth' AS measure, entity_name AS name, baseline_avg AS value_1, current_avg AS value_2,
       growth_pct AS value_3
FROM ({ENTITY_GROWTH})
UNION ALL
SELECT 'peak', entity_name, max(interest_score), {rnd("avg(interest_score)")},
       {rnd(grow("max(interest_score)", "avg(interest_score)"))}
FROM first_source GROUP BY entity_name
UNION ALL
SELECT 'per million', region_name, CAST(population AS DOUBLE), {rnd("avg(interest_score)")},
       {rnd("avg(interest_score) / (population / 1000000.0)", 4)}
FROM regional GROUP BY region_name, population"""),
    "rank_all_events": on_star("""
SELECT kind, name, value, rank() OVER (PARTITION BY kind ORDER BY value DESC NULLS LAST) AS rank
FROM (SELECT 'order' AS kind, CAST(o_orderkey AS VARCHAR) AS name, o_totalprice AS value FROM orders
      UNION ALL
      SELECT 'event', concat_ws('|', entity_id, event_date, coalesce(CAST(region_id AS VARCHAR), '-'), category),
             CAST(related_article_count AS DOUBLE)
      FROM f_events)"""),
    "stream_weekly_events": f"""
WITH weekly AS (
  SELECT {week(EVENT_DAY)} AS week, event_type, count(*) AS n_events, round(sum(value), 2) AS total
  FROM events GROUP BY 1, 2)
SELECT *, week <= (SELECT max(week) FROM weekly) - 14 AS closed FROM weekly""",
    "load_rejects_orphans": on_star("""
SELECT t AS table_name, 'foreign_key' AS check_name, 'entity_id' AS column_name,
       CAST(1 AS BIGINT) AS n_bad, min(entity_id) AS sample
FROM (SELECT 'interest' AS t, entity_id FROM f_interest
      UNION ALL SELECT 'events', entity_id FROM f_events)
WHERE entity_id = (SELECT min(entity_id) FROM d_entities) GROUP BY t"""),
}
