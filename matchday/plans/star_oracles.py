"""Independent SQL for the star-schema queries, written for DuckDB.

Deliberately not derived from the DataFrame code: plain joins and windows over the
registered tables. Queries without an entry solve a combinatorial program that SQL
cannot state; the tests compare those with exhaustive search.
"""

from __future__ import annotations

_LINE_SIDES = """
line_sides AS (
  SELECT l.*, c_nationkey AS home_id, s_nationkey AS away_id
  FROM lineitem l LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN supplier ON l_suppkey = s_suppkey)
"""

_SIDES = _LINE_SIDES + """,
sides AS (
  SELECT home_id AS team_id, 1 + 40 * l_discount AS difficulty, 0 AS side, l_shipdate, l_orderkey, l_linenumber,
         l_partkey, l_suppkey FROM line_sides WHERE l_linestatus = 'O'
  UNION ALL
  SELECT away_id, 1 + 40 * l_tax, 1, l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM line_sides WHERE l_linestatus = 'O')
"""

_NATION_DIFFICULTY = _SIDES + """,
nation_difficulty AS (
  SELECT team_id, avg(difficulty) AS avg_upcoming_difficulty, count(difficulty) AS n FROM (
    SELECT *, row_number() OVER (PARTITION BY team_id ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey,
                                 l_suppkey, side, difficulty) AS rn FROM sides)
  WHERE rn <= 3 GROUP BY team_id)
"""

_CUSTOMER_FORM = """
customer_form AS (
  SELECT o_custkey, avg(o_totalprice) AS avg_recent, count(o_totalprice) AS matches_in_window FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
  WHERE rn <= 3 GROUP BY o_custkey)
"""

_CUSTOMER_VALUE = """
customer_value AS (
  SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN total / c_acctbal ELSE 0.0 END AS points_per_million
  FROM customer LEFT JOIN (SELECT o_custkey, sum(o_totalprice) AS total FROM orders GROUP BY o_custkey)
  ON c_custkey = o_custkey)
"""

_CALENDAR = """
calendar AS (
  SELECT id, 'Gameweek ' || id AS name, strftime(min(o_orderdate), '%Y-%m-%d') AS deadline_time, id < 24000 AS finished,
         id % 2 = 0 AS data_checked, id = 24000 AS is_current, id = 24001 AS is_next
  FROM (SELECT CAST(year(o_orderdate) * 12 + month(o_orderdate) AS BIGINT) AS id, o_orderdate FROM orders) GROUP BY id)
"""

_SEGMENT_POSITION = (
    "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'GKP' WHEN 'BUILDING' THEN 'DEF' WHEN 'FURNITURE' THEN 'MID' "
    "WHEN 'HOUSEHOLD' THEN 'FWD' END"
)

_LINEUP = f"""
members AS (
  SELECT c_nationkey, c_custkey, c_acctbal, CAST(c_custkey % 97 AS DOUBLE) AS cost, {_SEGMENT_POSITION} AS position
  FROM customer),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY c_nationkey, position ORDER BY c_acctbal DESC, c_custkey) AS rn
  FROM members WHERE position IS NOT NULL),
formations AS (
  SELECT concat_ws('-', d, m, w) AS formation, x.position, x.needed
  FROM (SELECT * FROM range(3, 6) a(d), range(2, 6) b(m), range(1, 4) c(w) WHERE d + m + w = 10),
  LATERAL (VALUES ('GKP', 1), ('DEF', d), ('MID', m), ('FWD', w)) x(position, needed)),
totals AS (
  SELECT c_nationkey, formation, sum(c_acctbal) AS total
  FROM placed p JOIN formations f ON p.position = f.position AND rn <= needed
  GROUP BY c_nationkey, formation HAVING count(*) = 11),
chosen AS (
  SELECT c_nationkey, formation, total FROM (
    SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY round(total, 6) DESC, formation) AS z FROM totals)
  WHERE z = 1),
starting AS (
  SELECT p.c_custkey FROM placed p JOIN chosen c USING (c_nationkey)
  JOIN formations f ON f.formation = c.formation AND f.position = p.position AND rn <= needed),
marked AS (
  SELECT m.*, m.c_custkey IN (SELECT c_custkey FROM starting) AS is_starter FROM members m)
"""

_LEAGUE = """
teams AS (
  SELECT CAST(n_nationkey AS BIGINT) AS team_id, CAST(n_nationkey + 100 AS BIGINT) AS team_code, n_name AS team_name,
         right(n_name, 3) AS short_name, n_regionkey AS region FROM nation),
players AS (
  SELECT CAST(substr(p_brand, 7) AS BIGINT) AS team_id, p_partkey AS player_id, p_name AS web_name,
         p_type AS first_name, p_brand AS second_name, p_partkey || '.jpg' AS photo,
         CASE WHEN p_type = 'ECONOMY' THEN 'GKP' WHEN p_type IN ('SMALL', 'MEDIUM') THEN 'DEF'
              WHEN p_type IN ('STANDARD', 'LARGE') THEN 'MID' WHEN p_type = 'PROMO' THEN 'FWD' END AS position,
         CAST(p_size + 35 AS DOUBLE) / 10 AS cost_millions, CAST(floor(p_retailprice / 10) AS INTEGER) AS total_points,
         p_retailprice AS form, CAST(p_size AS DOUBLE) AS selected_by_percent,
         CASE WHEN p_size % 10 = 0 THEN 'i' ELSE 'a' END AS status,
         CASE WHEN p_size % 10 = 0 THEN 25 END AS chance_of_playing_next_round, team_name, team_code
  FROM part LEFT JOIN teams ON CAST(substr(p_brand, 7) AS BIGINT) = team_id),
fixtures AS (
  SELECT o_orderkey % 27 AS team_a_id, o_custkey % 25 AS team_h_id, o_orderkey AS fixture_id,
         CAST(year(o_orderdate) * 12 + month(o_orderdate) AS BIGINT) AS gameweek_id,
         CAST(1 + o_custkey % 5 AS INTEGER) AS team_h_difficulty, CAST(1 + o_orderkey % 5 AS INTEGER) AS team_a_difficulty,
         CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey % 4 AS INTEGER) END AS team_h_score,
         CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey % 4 AS INTEGER) END AS team_a_score,
         CASE WHEN o_orderstatus = 'F' THEN true WHEN o_orderstatus = 'O' THEN false END AS finished,
         CASE WHEN o_orderkey % 50 <> 0 THEN o_orderdate END AS kickoff_time
  FROM orders),
matches AS (
  SELECT l_orderkey AS fixture_id, l_partkey AS player_id,
         CAST(year(l_shipdate) * 12 + month(l_shipdate) AS BIGINT) AS gameweek_id, l_suppkey % 25 AS opponent_team_id,
         CASE WHEN l_returnflag = 'R' THEN true WHEN l_returnflag = 'A' THEN false END AS was_home,
         CAST(l_quantity AS INTEGER) AS total_points, CAST(CAST(l_quantity AS INTEGER) * 7 % 91 AS INTEGER) AS minutes,
         CAST(l_linenumber % 3 AS INTEGER) AS goals_scored, CAST(l_linenumber % 2 AS INTEGER) AS assists,
         CAST(l_orderkey % 2 AS INTEGER) AS clean_sheets, CAST(l_orderkey % 4 AS INTEGER) AS goals_conceded,
         CAST(l_partkey % 2 AS INTEGER) AS yellow_cards, CAST(l_partkey % 3 AS INTEGER) AS red_cards,
         CAST(l_suppkey % 4 AS INTEGER) AS bonus, CAST(l_suppkey % 50 AS INTEGER) AS bps,
         abs(l_discount) AS expected_goals, abs(l_tax) AS expected_assists,
         floor(l_extendedprice / 100) / 10 AS cost_at_match_millions
  FROM lineitem)
"""

_GOLD = _LEAGUE + """,
form AS (
  SELECT player_id, avg(total_points) AS avg_points_recent, avg(minutes) AS avg_minutes_recent,
         avg(expected_goals) AS avg_expected_goals_recent, avg(expected_assists) AS avg_expected_assists_recent,
         count(total_points) AS matches_in_window
  FROM (SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY gameweek_id DESC, fixture_id DESC,
                  total_points DESC, minutes DESC, expected_goals DESC, expected_assists DESC) AS rn FROM matches)
  WHERE rn <= 3 GROUP BY player_id),
worth AS (
  SELECT *, CASE WHEN cost_millions > 0 THEN total_points / cost_millions ELSE 0.0 END AS points_per_million
  FROM players),
calendar_rows AS (
  SELECT team_h_id AS team_id, team_h_difficulty AS difficulty, kickoff_time, fixture_id, 0 AS side
  FROM fixtures WHERE NOT finished
  UNION ALL SELECT team_a_id, team_a_difficulty, kickoff_time, fixture_id, 1 FROM fixtures WHERE NOT finished),
difficulty AS (
  SELECT team_id, avg(difficulty) AS avg_upcoming_difficulty, count(difficulty) AS upcoming_fixtures_count FROM (
    SELECT *, row_number() OVER (PARTITION BY team_id ORDER BY kickoff_time NULLS FIRST, fixture_id, side) AS rn
    FROM calendar_rows) WHERE rn <= 3 GROUP BY team_id),
joined AS (
  SELECT w.*, avg_points_recent, avg_upcoming_difficulty FROM worth w
  LEFT JOIN form USING (player_id) LEFT JOIN difficulty USING (team_id)),
extremes AS (
  SELECT min(avg_points_recent) AS a0, max(avg_points_recent) AS a1, min(points_per_million) AS p0,
         max(points_per_million) AS p1 FROM joined),
scores AS (
  SELECT player_id, web_name, first_name, second_name, photo, position, team_id, team_code, cost_millions,
         avg_points_recent, points_per_million, avg_upcoming_difficulty,
         0.4 * coalesce(CASE WHEN a0 IS NULL OR a0 = a1 THEN 0.5 ELSE (avg_points_recent - a0) / (a1 - a0) END, 0)
         + 0.3 * coalesce(CASE WHEN p0 IS NULL OR p0 = p1 THEN 0.5 ELSE (points_per_million - p0) / (p1 - p0) END, 0)
         + 0.3 * (5 - coalesce(avg_upcoming_difficulty, 3)) / 4 AS recommendation_score
  FROM joined, extremes WHERE status = 'a')
"""

_PORTRAIT = "https://resources.premierleague.com/premierleague/photos/players/110x140/p"
_BADGE = "https://resources.premierleague.com/premierleague/badges/50/t"


_PLACE = "CASE position WHEN 'GKP' THEN 1 WHEN 'DEF' THEN 2 WHEN 'MID' THEN 3 WHEN 'FWD' THEN 4 END::BIGINT"


def _dominance(pool: str, same: str, clubs: str) -> str:
    """Candidates kept, by comparing every pair. ``pool`` has id, pos, club, cost, score."""
    return f"""{pool},
    dominators AS (
      SELECT p.id, p.pos, count(DISTINCT q.club) AS clubs, count(*) FILTER (q.club = p.club) AS same
      FROM c p LEFT JOIN c q ON p.pos = q.pos AND q.cost <= p.cost AND q.score >= p.score
        AND (q.score > p.score OR q.cost < p.cost OR q.id < p.id) AND p.id <> q.id
      GROUP BY p.id, p.pos)
    SELECT id FROM dominators WHERE clubs < {clubs} AND same < {same}"""


def _quality(check: str, table: str, count: str) -> str:
    return f"SELECT '{check}' AS \"check\", '{table}' AS \"table\", CAST(({count}) AS BIGINT) AS violations"


def _duplicates(table: str, keys: str) -> str:
    return f"SELECT count(*) FROM (SELECT {keys} FROM {table} GROUP BY {keys} HAVING count(*) > 1)"


def oracle_sql() -> dict[str, str]:
    return {
        "dim_project_cast": """
            SELECT s_suppkey AS team_id, s_name AS team_name, CAST(trunc(s_acctbal) AS INTEGER) AS strength,
                   CAST(s_nationkey AS BIGINT) AS nation_id FROM supplier""",
        "decode_priority": """
            SELECT o_orderkey, TRY_CAST(left(o_orderpriority, 1) AS INTEGER) AS code,
                   CASE left(o_orderpriority, 1) WHEN '1' THEN 'urgent' WHEN '2' THEN 'high' WHEN '3' THEN 'medium'
                        WHEN '4' THEN 'open' END AS label FROM orders""",
        "cast_report": """
            SELECT 'o_orderpriority' AS "column", count(*) AS violations FROM orders WHERE o_orderpriority IS NOT NULL
            UNION ALL SELECT 'o_orderstatus', count(*) FROM orders WHERE lower(o_orderstatus) NOT IN
                   ('t', 'true', 'y', 'yes', '1', 'f', 'false', 'n', 'no', '0')
            UNION ALL SELECT 'o_totalprice', 0""",
        "raw_payload": """
            SELECT c_custkey, CAST(to_json({'c_custkey': c_custkey, 'c_name': c_name, 'c_nationkey': c_nationkey,
                   'c_acctbal': c_acctbal, 'c_mktsegment': nullif(c_mktsegment, 'MACHINERY')}) AS VARCHAR) AS raw_payload
            FROM customer""",
        "json_fields": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
        "document_records": """
            SELECT o_custkey AS customer_id, 0 AS pos, o_orderkey AS id, o_orderpriority AS name,
                   o_orderstatus = 'F' AS finished, o_orderstatus = 'P' AS is_current FROM orders
            UNION ALL SELECT o_custkey, 1, o_orderkey + 1, NULL, NULL, NULL FROM orders""",
        "quarantined_records": """
            WITH o AS (SELECT o_orderkey AS k, '{"id":' || o_orderkey || ',"name":"' || o_orderpriority || '"}' AS rec FROM orders)
            SELECT k AS order_id, NULL::BIGINT AS pos, 'not a JSON document' AS reason, '{"events":[' || rec AS raw_payload
            FROM o WHERE k % 11 = 0
            UNION ALL SELECT k, NULL, 'no array of records', '{"other":[]}' FROM o WHERE k % 11 = 1
            UNION ALL SELECT k, 1, 'record does not fit the schema', '{"id":"x' || k || '"}' FROM o WHERE k % 11 > 1 AND k % 3 = 0
            UNION ALL SELECT k, 1, 'null record', NULL FROM o WHERE k % 11 > 1 AND k % 3 = 1""",
        "accepted_records": """
            SELECT o_orderkey AS order_id, 0::BIGINT AS pos, o_orderkey AS id, o_orderpriority AS name, NULL::BOOLEAN AS finished
            FROM orders WHERE o_orderkey % 11 > 1""",
        "array_records": """
            SELECT o_custkey % 4 AS part, row_number() OVER (PARTITION BY o_custkey % 4 ORDER BY o_orderkey) - 1 AS pos,
                   o_orderkey AS id, '},{"' || o_orderpriority AS name, o_orderkey % 3 AS n FROM orders""",
        "observed_types": """
            WITH e AS (SELECT props::JSON AS j FROM events), n AS (SELECT count(*) AS n FROM orders)
            SELECT 'events' AS source, '' AS path, 'object' AS type, count(*) AS n FROM e WHERE json_type(j) = 'OBJECT'
            UNION ALL SELECT 'events', k, t, count(*) FROM (
              SELECT k, CASE json_type(j -> k) WHEN 'UBIGINT' THEN 'bigint' WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double'
                        WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' ELSE lower(json_type(j -> k)) END AS t
              FROM (SELECT j, unnest(json_keys(j)) AS k FROM e)) GROUP BY k, t
            UNION ALL SELECT 'orders', x.path, x.type, n FROM n, LATERAL (VALUES ('', 'object'), ('id', 'bigint'), ('total', 'double'),
              ('none', 'null'), ('tags', 'array'), ('tags.[]', 'string'), ('tags.[]', 'null'), ('inner', 'object')) x(path, type)
            UNION ALL SELECT 'orders', 'mixed', CASE WHEN o_orderkey % 2 = 0 THEN 'bigint' ELSE 'string' END AS t, count(*)
            FROM orders GROUP BY t
            UNION ALL SELECT 'orders', 'inner.done', CASE WHEN o_orderstatus = 'F' THEN 'boolean' ELSE 'null' END AS t, count(*)
            FROM orders GROUP BY t""",
        "display_fields": f"""
            SELECT c_custkey, nullif(c_mktsegment, 'MACHINERY') || ' ' || c_name AS full_name,
                   CASE WHEN c_custkey % 7 <> 0 THEN '{_PORTRAIT}' || c_custkey || '.png' END AS portrait_url,
                   CASE WHEN c_nationkey <> 0 THEN '{_BADGE}' || c_nationkey || '.png' END AS badge_url,
                   printf('%.1fM', c_acctbal) AS cost FROM customer""",
        "left_join_dim": """
            SELECT c_nationkey + 1000 * (c_custkey % 2) AS c_nationkey, c_custkey, n_name AS team_name FROM customer
            LEFT JOIN nation ON c_nationkey + 1000 * (c_custkey % 2) = n_nationkey""",
        "role_dims": f"""
            WITH {_LINE_SIDES}
            SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, h.n_name AS home_name, a.n_name AS away_name
            FROM line_sides LEFT JOIN nation h ON home_id = h.n_nationkey LEFT JOIN nation a ON away_id = a.n_nationkey""",
        "fact_enriched": """
            SELECT o_orderkey, c_nationkey AS team_id, c_mktsegment AS position,
                   CASE WHEN o_orderstatus = 'F' THEN n_regionkey + 1 ELSE n_nationkey % 5 + 1 END AS difficulty
            FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""",
        "latest_state": """
            SELECT user_id, event_id, value FROM (
              SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
              FROM events WHERE event_type = 'purchase') WHERE rn = 1""",
        "last_value": """
            SELECT o_custkey, o_orderkey AS last_order, o_totalprice AS last_price FROM (
              SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
              FROM orders) WHERE rn = 1""",
        "current_or_next": """
            SELECT o_custkey, o_orderkey, o_orderstatus FROM (
              SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus <> 'P', o_orderdate, o_orderkey)
                AS rn FROM orders WHERE o_orderstatus IN ('P', 'O')) WHERE rn = 1""",
        "gameweek_gate": f"""
            WITH {_CALENDAR} SELECT id, name, data_checked FROM calendar WHERE finished ORDER BY id DESC LIMIT 1""",
        "gameweek_current": f"""
            WITH {_CALENDAR} SELECT deadline_time, finished, id AS gameweek_id, name FROM calendar WHERE is_current""",
        "gameweek_upcoming": f"""
            WITH {_CALENDAR} SELECT deadline_time, finished, id AS gameweek_id, name FROM calendar WHERE is_next""",
        "rolling_series": """
            SELECT o_custkey, o_orderkey, round(avg(o_totalprice) OVER w, 6) AS avg_recent,
                   count(o_totalprice) OVER w AS matches_in_window FROM orders
            WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                         ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
        "rolling_series_skewed": """
            SELECT series, count(*) AS n, CAST(sum(s) AS BIGINT) AS total, CAST(min(s) AS BIGINT) AS lowest,
                   CAST(max(s) AS BIGINT) AS highest, CAST(sum(f) AS BIGINT) AS frames FROM (
              SELECT series, sum(l_quantity) OVER w AS s, count(l_quantity) OVER w AS f
              FROM (SELECT CASE WHEN l_partkey % 3 <> 0 THEN l_partkey ELSE -1 END AS series, * FROM lineitem)
              WINDOW w AS (PARTITION BY series ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey,
                           l_quantity ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)) GROUP BY series""",
        "form_last3": f"""
            WITH {_CUSTOMER_FORM}
            SELECT o_custkey, round(avg_recent, 6) AS avg_recent, matches_in_window FROM customer_form""",
        "next3_difficulty": f"""
            WITH {_NATION_DIFFICULTY}
            SELECT team_id, round(avg_upcoming_difficulty, 6) AS avg_upcoming_difficulty, n FROM nation_difficulty""",
        "sides_unpivot": f"""
            WITH {_SIDES} SELECT team_id, side, count(*) AS n, round(sum(difficulty), 3) AS difficulty
            FROM sides GROUP BY team_id, side""",
        "sides_union": """
            SELECT c_nationkey AS team_id, 'customer' AS side, count(*) AS n FROM customer GROUP BY c_nationkey
            UNION ALL SELECT s_nationkey, 'supplier', count(*) FROM supplier GROUP BY s_nationkey""",
        "value_ratio": f"""
            WITH {_CUSTOMER_VALUE}
            SELECT c_custkey, round(points_per_million, 4) AS points_per_million FROM customer_value""",
        "minmax_norm": """
            WITH m AS (SELECT min(l_quantity) AS q0, max(l_quantity) AS q1, min(l_extendedprice) AS p0,
                              max(l_extendedprice) AS p1 FROM lineitem)
            SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round((l_quantity - q0) / (q1 - q0), 6) AS quantity_norm,
                   round((l_extendedprice - p0) / (p1 - p0), 6) AS price_norm FROM lineitem, m""",
        "minmax_constant": """
            WITH m AS (SELECT min(p_size) AS s0, max(p_size) AS s1 FROM part WHERE p_size > 10)
            SELECT p_partkey, CAST(0.5 AS DOUBLE) AS same_norm, CAST(0.5 AS DOUBLE) AS nothing_norm,
                   round(CASE WHEN p_size > 10 THEN CAST(p_size - s0 AS DOUBLE) / (s1 - s0) END, 6) AS partly_norm
            FROM part, m""",
        "minmax_by_group": """
            SELECT p_partkey, round(CASE WHEN lo = hi THEN 0.5 ELSE (p_retailprice - lo) / (hi - lo) END, 6) AS price_norm
            FROM part JOIN (SELECT p_brand, min(p_retailprice) AS lo, max(p_retailprice) AS hi FROM part GROUP BY p_brand)
            USING (p_brand)""",
        "favourability": """
            SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round((5 - coalesce(
              CASE WHEN l_returnflag <> 'N' THEN 1 + CAST(floor(abs(l_discount) * 40) AS BIGINT) % 5 END, 3)) / 4, 6)
              AS favourability FROM lineitem""",
        "weighted_score": """
            SELECT p_partkey, round(CAST(p_size AS DOUBLE) / 50 * 0.4 + CASE WHEN p_size > 10 THEN 0.5 ELSE 0 END * 0.3, 6)
              AS score FROM part""",
        "recommendation": f"""
            WITH {_NATION_DIFFICULTY}, {_CUSTOMER_FORM}, {_CUSTOMER_VALUE},
            base AS (
              SELECT c_custkey, c_acctbal, avg_recent, points_per_million AS ppm,
                     (5 - coalesce(avg_upcoming_difficulty, 3)) / 4 AS fav
              FROM customer JOIN customer_value USING (c_custkey) LEFT JOIN customer_form ON c_custkey = o_custkey
              LEFT JOIN nation_difficulty ON team_id = c_nationkey),
            m AS (SELECT min(avg_recent) AS a0, max(avg_recent) AS a1, min(ppm) AS p0, max(ppm) AS p1 FROM base)
            SELECT c_custkey, round(
                0.4 * coalesce(CASE WHEN a0 IS NULL OR a0 = a1 THEN 0.5 ELSE (avg_recent - a0) / (a1 - a0) END, 0)
              + 0.3 * coalesce(CASE WHEN p0 IS NULL OR p0 = p1 THEN 0.5 ELSE (ppm - p0) / (p1 - p0) END, 0)
              + 0.3 * coalesce(fav, 0), 6) AS recommendation_score FROM base, m WHERE c_acctbal >= 0""",
        "top10": "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10",
        "customer_places": """
            SELECT c_custkey, c_acctbal, row_number() OVER (ORDER BY c_acctbal DESC NULLS LAST, c_custkey) AS place
            FROM customer""",
        "line_places": """
            SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, row_number() OVER (
              ORDER BY l_quantity DESC NULLS LAST, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice)
              AS place FROM lineitem""",
        "top20_per_segment": """
            SELECT c_mktsegment, place, c_custkey, c_acctbal FROM (
              SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS place
              FROM customer) WHERE place <= 20""",
        "ranked_segments": """
            SELECT o_orderstatus, o_orderpriority, o_orderkey FROM (
              SELECT *, row_number() OVER (PARTITION BY o_orderstatus, o_orderpriority
                ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""",
        "table_counts": "\nUNION ALL ".join(
            f"SELECT '{name}' AS \"table\", count(*) AS n FROM {name}"
            for name in ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
                         "labels conversations").split()
        ),
        "dq_duplicates": """
            SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber
            HAVING count(*) > 1""",
        "dq_orphans": """
            SELECT k AS c_nationkey, count(*) AS n
            FROM (SELECT c_nationkey + 1000 * (c_custkey % 2) AS k FROM customer)
            WHERE k IS NOT NULL AND k NOT IN (SELECT n_nationkey FROM nation) GROUP BY k""",
        "dq_ranges": """
            SELECT 'quantity' AS "check", 'lineitem' AS "table", count(*) AS violations FROM lineitem
            WHERE l_quantity < 5 OR l_quantity > 45 OR l_quantity IS NULL
            UNION ALL SELECT 'discount', 'lineitem', count(*) FROM lineitem
            WHERE l_discount < 0.02 OR l_discount > 0.08 OR l_discount IS NULL
            UNION ALL SELECT 'flag', 'lineitem', count(*) FROM lineitem WHERE l_returnflag = 'N'""",
        "dominance_prune": _dominance("""
            WITH c AS (
              SELECT p_partkey AS id, p_type AS pos, p_brand AS club, CAST(round(p_retailprice * 10) AS BIGINT) AS cost,
                     sum(l_quantity) AS score FROM part JOIN lineitem ON p_partkey = l_partkey GROUP BY 1, 2, 3, 4)""",
            "3", "7"),
        "best_lineup": f"WITH {_LINEUP} SELECT c_nationkey, formation, round(total, 2) AS total FROM chosen",
        "lineup_starters": f"WITH {_LINEUP} SELECT c_nationkey, c_custkey, is_starter FROM marked",
        "lineup_totals": f"""
            WITH {_LINEUP} SELECT c_nationkey, round(sum(cost), 2) AS total_cost,
              round(sum(c_acctbal) FILTER (is_starter), 2) AS total_score,
              round(sum(cost) FILTER (is_starter), 2) AS starters_cost,
              count(*) FILTER (is_starter) AS starters, count(c_custkey) AS players FROM marked GROUP BY c_nationkey""",
        "lineup_cards": f"""
            WITH {_LINEUP} SELECT c_nationkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY {_PLACE}, m.c_acctbal DESC, c_custkey)
              AS place, c_custkey, c_name AS web_name, position, {_PLACE} AS position_order,
              '{_PORTRAIT}' || c_custkey || '.png' AS portrait_url, '{_BADGE}' || (c_nationkey + 100) || '.png' AS badge_url,
              printf('%.1fM', cost) AS cost, m.c_acctbal AS recommendation_score
            FROM marked m JOIN (SELECT c_custkey, c_name FROM customer) USING (c_custkey) WHERE is_starter""",
        "squad_places": f"""
            WITH {_LINEUP} SELECT c_nationkey, c_custkey, is_starter, row_number() OVER (
              PARTITION BY c_nationkey ORDER BY is_starter DESC, {_PLACE} NULLS LAST, c_acctbal DESC, c_custkey) AS place FROM marked""",
        "squad_summary": f"""
            WITH {_LINEUP}, s AS (
              SELECT c_nationkey, position, CASE WHEN grouping(position) = 0 THEN 'position' WHEN grouping(c_nationkey) = 0 THEN 'squad'
                       ELSE 'all' END AS level, count(*) AS players, count(*) FILTER (is_starter) AS starters,
                CAST(sum(CAST(cost AS DECIMAL(28,6))) AS DOUBLE) AS total_cost,
                CAST(sum(CAST(cost AS DECIMAL(28,6))) FILTER (is_starter) AS DOUBLE) AS starters_cost,
                CAST(sum(CAST(c_acctbal AS DECIMAL(28,6))) FILTER (is_starter) AS DOUBLE) AS starters_score
              FROM marked GROUP BY GROUPING SETS ((c_nationkey, position), (c_nationkey), ()))
            SELECT *, printf('%.1fM / 100.0M', total_cost) AS total_cost_text, printf('%.1fM / 100.0M', starters_cost) AS starters_cost_text,
              printf('%.3f', starters_score) AS starters_score_text FROM s""",
        "given_lineups": f"""
            WITH {_GOLD},
            members AS (SELECT player_id % 40 AS squad, player_id, position, round(recommendation_score, 6) AS score FROM scores),
            placed AS (SELECT *, row_number() OVER (PARTITION BY squad, position ORDER BY score DESC, player_id) AS rn FROM members
                       WHERE position IS NOT NULL),
            formations AS (
              SELECT concat_ws('-', d, m, w) AS formation, x.position, x.needed
              FROM (SELECT * FROM range(3, 6) a(d), range(2, 6) b(m), range(1, 4) c(w) WHERE d + m + w = 10),
              LATERAL (VALUES ('GKP', 1), ('DEF', d), ('MID', m), ('FWD', w)) x(position, needed)),
            totals AS (SELECT squad, formation, sum(score) AS total FROM placed p JOIN formations f ON p.position = f.position AND rn <= needed
                       GROUP BY squad, formation HAVING count(*) = 11),
            chosen AS (SELECT squad, formation FROM (
              SELECT *, row_number() OVER (PARTITION BY squad ORDER BY round(total, 6) DESC, formation) AS z FROM totals) WHERE z = 1),
            starting AS (SELECT p.player_id FROM placed p JOIN chosen c USING (squad)
                         JOIN formations f ON f.formation = c.formation AND f.position = p.position AND rn <= needed)
            SELECT squad, player_id, position, player_id IN (SELECT player_id FROM starting) AS is_starter, score AS recommendation_score
            FROM members""",
        "squad_check": """
            WITH p AS (SELECT p_size AS squad, p_brand, p_type, p_retailprice / 100 AS price FROM part),
            s AS (
              SELECT squad, count(*) AS n, CAST(sum(CAST(price AS DECIMAL(28,6))) AS DOUBLE) AS cost, count(*) FILTER (p_type = 'ECONOMY') AS g,
                     count(*) FILTER (p_type = 'SMALL') AS d, count(*) FILTER (p_type = 'STANDARD') AS m,
                     count(*) FILTER (p_type = 'PROMO') AS f FROM p GROUP BY squad),
            k AS (SELECT squad, max(n) AS club FROM (SELECT squad, p_brand, count(*) AS n FROM p GROUP BY squad, p_brand)
                  GROUP BY squad)
            SELECT squad, x.rule, CAST(x.actual AS DOUBLE) AS actual, CAST(x.allowed AS DOUBLE) AS allowed, x.violated
            FROM s JOIN k USING (squad), LATERAL (VALUES
              ('squad_size', n, 15, n <> 15), ('budget', cost, 100, cost > 100), ('club_limit', club, 3, club > 3),
              ('position_GKP', g, 2, g <> 2), ('position_DEF', d, 5, d <> 5), ('position_MID', m, 5, m <> 5),
              ('position_FWD', f, 3, f <> 3)) x(rule, actual, allowed, violated)""",
        "prune_league": "SELECT id AS player_id FROM (" + _dominance(f"""
            WITH {_GOLD},
            c AS (SELECT player_id AS id, position AS pos, team_id AS club,
                         CAST(round(cost_millions * 10) AS BIGINT) AS cost, recommendation_score AS score FROM scores)""",
            "CASE pos WHEN 'GKP' THEN 2 ELSE 3 END",
            "CASE pos WHEN 'GKP' THEN 6 WHEN 'FWD' THEN 7 ELSE 9 END") + ")",
        "silver_teams": f"""
            WITH {_LEAGUE} SELECT team_id, team_code, team_name, short_name,
              CAST(1000 + 10 * region AS INTEGER) AS strength_overall_home,
              CAST(1001 + 10 * region AS INTEGER) AS strength_overall_away,
              CAST(1002 + 10 * region AS INTEGER) AS strength_attack_home,
              CAST(1003 + 10 * region AS INTEGER) AS strength_attack_away,
              CAST(1004 + 10 * region AS INTEGER) AS strength_defence_home,
              CAST(1005 + 10 * region AS INTEGER) AS strength_defence_away FROM teams""",
        "silver_players": f"WITH {_LEAGUE} SELECT * FROM players",
        "silver_fixtures": f"""
            WITH {_LEAGUE} SELECT f.* REPLACE (CAST(epoch(kickoff_time) AS BIGINT) AS kickoff_time),
              h.team_name AS team_h_name, a.team_name AS team_a_name FROM fixtures f
            LEFT JOIN teams h ON team_h_id = h.team_id LEFT JOIN teams a ON team_a_id = a.team_id""",
        "silver_stats": f"""
            WITH {_LEAGUE} SELECT m.*, web_name, position, team_id,
              CASE WHEN was_home THEN team_h_difficulty ELSE team_a_difficulty END AS difficulty FROM matches m
            LEFT JOIN players USING (player_id) LEFT JOIN fixtures f ON m.fixture_id = f.fixture_id""",
        "silver_quality": f"WITH {_LEAGUE} " + " UNION ALL ".join([
            _quality("unique(player_id,fixture_id)", "player_gameweek_stats", _duplicates("matches", "player_id, fixture_id")),
            _quality("unique(team_id)", "teams", _duplicates("teams", "team_id")),
            _quality("unique(player_id)", "players", _duplicates("players", "player_id")),
            _quality("unique(fixture_id)", "fixtures", _duplicates("fixtures", "fixture_id")),
            _quality("orphan(team_id)", "players",
                     "SELECT count(*) FROM players WHERE team_id NOT IN (SELECT team_id FROM teams)"),
            _quality("orphan(team_h_id)", "fixtures",
                     "SELECT count(*) FROM fixtures WHERE team_h_id NOT IN (SELECT team_id FROM teams)"),
            _quality("orphan(team_a_id)", "fixtures",
                     "SELECT count(*) FROM fixtures WHERE team_a_id NOT IN (SELECT team_id FROM teams)"),
            _quality("range(element_type)", "players_snapshot", "SELECT count(*) FROM players WHERE position IS NULL"),
            _quality("range(team_h_difficulty)", "fixtures",
                     "SELECT count(*) FROM fixtures WHERE team_h_difficulty NOT BETWEEN 1 AND 5"),
            _quality("range(team_a_difficulty)", "fixtures",
                     "SELECT count(*) FROM fixtures WHERE team_a_difficulty NOT BETWEEN 1 AND 5"),
        ]),
        "gold_form": f"""
            WITH {_GOLD} SELECT player_id, round(avg_points_recent, 6) AS avg_points_recent,
              round(avg_minutes_recent, 6) AS avg_minutes_recent,
              round(avg_expected_goals_recent, 6) AS avg_expected_goals_recent,
              round(avg_expected_assists_recent, 6) AS avg_expected_assists_recent, matches_in_window FROM form""",
        "gold_value": f"""
            WITH {_GOLD} SELECT player_id, web_name, position, team_name, cost_millions, total_points,
              selected_by_percent, round(points_per_million, 6) AS points_per_million FROM worth""",
        "gold_difficulty": f"""
            WITH {_GOLD} SELECT team_id, round(avg_upcoming_difficulty, 6) AS avg_upcoming_difficulty,
              upcoming_fixtures_count FROM difficulty""",
        "gold_scores": f"""
            WITH {_GOLD} SELECT * REPLACE (round(avg_points_recent, 6) AS avg_points_recent,
              round(points_per_million, 6) AS points_per_million,
              round(avg_upcoming_difficulty, 6) AS avg_upcoming_difficulty,
              round(recommendation_score, 6) AS recommendation_score) FROM scores""",
        "gold_quality": f"WITH {_GOLD} " + _quality(
            "range(recommendation_score)", "player_recommendation_scores",
            "SELECT count(*) FROM scores WHERE recommendation_score NOT BETWEEN 0 AND 1"),
        "report_rankings": f"""
            WITH {_GOLD}, listed AS (
              SELECT *, row_number() OVER (PARTITION BY position ORDER BY round(recommendation_score, 6) DESC, player_id)
                AS place FROM scores WHERE position IS NOT NULL)
            SELECT player_id, position, CAST(CASE position WHEN 'GKP' THEN 1 WHEN 'DEF' THEN 2 WHEN 'MID' THEN 3 ELSE 4 END
                AS BIGINT) AS position_order, place, first_name || ' ' || second_name AS full_name,
              '{_PORTRAIT}' || player_id || '.png' AS portrait_url, '{_BADGE}' || team_code || '.png' AS badge_url,
              printf('%.1fM', cost_millions) AS cost, printf('%.1f', avg_points_recent) AS form,
              printf('%.2f', points_per_million) AS points_per_million, printf('%.1f/5', avg_upcoming_difficulty) AS calendar,
              printf('%.3f', round(recommendation_score, 6)) AS score FROM listed WHERE place <= 20""",
        "report_top10": f"""
            WITH {_GOLD} SELECT player_id, web_name, round(recommendation_score, 6) AS recommendation_score
            FROM scores ORDER BY round(recommendation_score, 6) DESC, player_id LIMIT 10""",
        "report_gameweek": f"WITH {_CALENDAR} SELECT max(name) AS name FROM calendar WHERE is_current",
    }
