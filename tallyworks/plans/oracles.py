"""The same queries as plain SQL over the same tables, for comparison."""

from __future__ import annotations

_CARD_POINTS = """
    SELECT customer_id,
           CAST(SUM(CASE WHEN short AND maxed THEN 3 WHEN short OR maxed THEN 1 ELSE 0 END) AS BIGINT) AS points
    FROM (SELECT l_suppkey AS customer_id,
                 ROUND(l_quantity * (1 - 5 * l_discount), 4) < l_quantity * CAST(0.7 AS DOUBLE) AS short,
                 l_quantity = 50 AND ROUND(l_quantity * (1 - 5 * l_discount), 4) < l_quantity AS maxed
          FROM lineitem)
    GROUP BY customer_id
    HAVING SUM(CASE WHEN short OR maxed THEN 1 ELSE 0 END) > 0
"""

_LATE = """
    SELECT o_custkey AS customer_id,
           CAST(SUM(CASE WHEN l_shipdate > o_orderdate THEN 1 ELSE 0 END) AS BIGINT) AS late_payments
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    GROUP BY o_custkey
    HAVING SUM(CASE WHEN l_shipdate > o_orderdate THEN 1 ELSE 0 END) >= 3
"""

_GAPS = """
    SELECT customer_id,
           CAST(31 - COUNT(*) AS BIGINT) AS missed,
           CAST(GREATEST(MAX(day - before - 1), 31 - MAX(day)) AS BIGINT) AS longest_gap
    FROM (SELECT customer_id, day, COALESCE(LAG(day) OVER (PARTITION BY customer_id ORDER BY day), 0) AS before
          FROM (SELECT DISTINCT user_id AS customer_id, EXTRACT(day FROM ts) AS day
                FROM events WHERE event_type = 'purchase'))
    GROUP BY customer_id
"""

_GAP_DEFAULTERS = f"SELECT * FROM ({_GAPS}) WHERE missed >= 20 OR longest_gap >= 8"

_KILLS = """
    SELECT event_id, ts, event_type AS game_id, user_id AS player_id, user_id % 10 AS team_id,
           k % 3 AS used_weapon,
           (CASE WHEN k BETWEEN 10 AND 20 THEN 4 WHEN k BETWEEN 21 AND 30 THEN 3
                 WHEN k BETWEEN 31 AND 40 THEN 2 WHEN k > 40 THEN 1 ELSE 0 END)
           + (CASE WHEN diff > 6 THEN 3 WHEN diff BETWEEN 3 AND 6 THEN 2 ELSE 1 END)
           + (CASE WHEN user_id % 7 <> event_id % 5 THEN 3 ELSE 0 END) AS points
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
                 user_id % 10 - event_id % 10 AS diff
          FROM events)
"""


def _sessions(source: str, keys: str, gap: str, value: str, name: str) -> str:
    """Session means: a new session where the gap to the row before is ``gap`` or more."""
    return f"""
    SELECT {keys}, MIN(ts) AS session_start, MAX(ts) + {gap} AS session_end,
           CAST(SUM({value}) AS DOUBLE) / COUNT(*) AS {name}, COUNT(*) AS n
    FROM (SELECT *, SUM(starts) OVER (PARTITION BY {keys} ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session_no
          FROM (SELECT *, CASE WHEN ts - LAG(ts) OVER (PARTITION BY {keys} ORDER BY ts) < {gap}
                               THEN 0 ELSE 1 END AS starts
                FROM ({source})))
    GROUP BY {keys}, session_no
    """


_TUMBLING = """
    SELECT event_type,
           TIME_BUCKET(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01') AS window_start,
           TIME_BUCKET(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01') + INTERVAL 1 HOUR AS window_end,
           CAST(SUM(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS total,
           COUNT(*) AS n
    FROM events GROUP BY 1, 2, 3
"""

_SESSION = _sessions("SELECT * FROM events", "user_id", "INTERVAL 6 HOURS", "CAST(value AS DECIMAL(18, 2))", "mean")

_DISCARDING = """
    SELECT user_id, (position - 1) // 5 AS pane, COUNT(*) AS n,
           CAST(SUM(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS total
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id) AS position FROM events)
    GROUP BY 1, 2 HAVING COUNT(*) = 5
"""

_ACCUMULATING = """
    SELECT user_id, position // 2 - 1 AS pane, position AS n, CAST(running AS DOUBLE) AS total
    FROM (SELECT user_id,
                 ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id) AS position,
                 SUM(CAST(value AS DECIMAL(18, 2)))
                     OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS running
          FROM events)
    WHERE position % 2 = 0
"""

_SCORES = """
    SELECT kind, id, score
    FROM (SELECT kind, id, ROW_NUMBER() OVER (PARTITION BY kind, id ORDER BY event_id) AS score
          FROM (SELECT 'player' AS kind, CAST(user_id AS VARCHAR) AS id, event_id FROM events
                UNION ALL
                SELECT 'team', CAST(user_id % 10 AS VARCHAR), event_id FROM events))
    WHERE score % 2 = 0
"""

_MESSAGES = """
    SELECT 'Send number: ' || event_id AS value, CASE WHEN event_id % 2 = 0 THEN 'True' ELSE 'False' END AS even
    FROM events
"""

_CENTS = "SELECT user_id, event_type, CAST(ROUND(value * 100) AS BIGINT) AS cents FROM events"

_SALES = """
    SELECT CAST(user_id AS VARCHAR) AS store_id, event_id, ts,
           (CAST(ROUND(value * 100) AS BIGINT) - event_id % 100) * (event_id % 7 + 1) AS profit
    FROM events WHERE event_type IN ('click', 'view')
"""

_STORE_PANES = f"""
    SELECT store_id, pane, COUNT(*) AS n, CAST(SUM(profit) AS BIGINT) AS total
    FROM (SELECT *, (ROW_NUMBER() OVER (PARTITION BY store_id ORDER BY event_id) - 1) // 5 AS pane FROM ({_SALES}))
    GROUP BY store_id, pane HAVING COUNT(*) = 5
"""

_STORE_WINDOWS = f"""
    SELECT store_id, TIME_BUCKET(INTERVAL 20 SECONDS, ts, TIMESTAMP '1970-01-01') AS window_start,
           TIME_BUCKET(INTERVAL 20 SECONDS, ts, TIMESTAMP '1970-01-01') + INTERVAL 20 SECONDS AS window_end,
           CAST(SUM(profit) AS BIGINT) AS profit, COUNT(*) AS n
    FROM ({_SALES}) GROUP BY 1, 2, 3
"""

ORACLES = {
    "attendance_count": """
        SELECT o_custkey, COUNT(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey
    """,
    "sum_per_key": """
        SELECT l_suppkey, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS total
        FROM lineitem GROUP BY l_suppkey
    """,
    "membership_profit": """
        SELECT l_suppkey,
               CAST(SUM(CAST(l_extendedprice AS DECIMAL(18, 2)) * (1 - CAST(l_discount AS DECIMAL(18, 2)))
                        - CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE) AS profit
        FROM lineitem WHERE l_returnflag IN ('A', 'R') AND l_extendedprice IS NOT NULL
        GROUP BY l_suppkey
    """,
    "having_threshold": """
        SELECT o_custkey, o_orderpriority, COUNT(*) AS n FROM orders
        GROUP BY o_custkey, o_orderpriority HAVING COUNT(*) >= 3
    """,
    "length_prefix_filter": """
        SELECT p_partkey, p_name FROM part
        WHERE LENGTH(p_name) BETWEEN 8 AND 10 AND starts_with(p_name, 's')
    """,
    "text_keys": """
        SELECT c_custkey || ', ' || c_name || ' ' || c_mktsegment AS line,
               c_custkey AS key, c_name || ' ' || c_mktsegment AS name
        FROM customer
    """,
    "dirty_dates": """
        SELECT o_orderkey,
               CASE WHEN readable THEN CAST(o_orderdate AS DATE) END AS day,
               CASE WHEN readable THEN EXTRACT(month FROM o_orderdate) END AS month,
               CASE WHEN readable AND o_orderdate > TIMESTAMP '1998-06-15' THEN CAST(1 AS BIGINT)
                    ELSE CAST(0 AS BIGINT) END AS late,
               CASE WHEN readable THEN CAST(date_diff('second', TIMESTAMP '1970-01-01', o_orderdate) AS BIGINT)
                    END AS seconds
        FROM (SELECT *, o_orderkey % 11 <> 0 AS readable FROM orders)
    """,
    "global_mean": """
        SELECT CAST(SUM(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE) / COUNT(l_quantity) AS mean FROM lineitem
    """,
    "mean_per_key": """
        SELECT user_id, event_type, CAST(SUM(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) / COUNT(value) AS mean
        FROM events GROUP BY user_id, event_type
    """,
    "pair_combine": """
        SELECT o_custkey, MIN(o_orderpriority) AS o_orderpriority, COUNT(*) AS n FROM orders GROUP BY o_custkey
    """,
    "distinct_pairs": "SELECT DISTINCT user_id, event_type FROM events",
    "cogroup_full_outer": """
        SELECT COALESCE(c.custkey, e.custkey) AS custkey, CAST(0 AS BIGINT) AS part,
               COALESCE(names, '') AS names, COALESCE(events, '') AS events
        FROM (SELECT c_custkey AS custkey, string_agg(c_name, ',' ORDER BY c_name) AS names
              FROM customer GROUP BY c_custkey) c
        FULL JOIN (SELECT user_id AS custkey, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS events
                   FROM events GROUP BY user_id) e
        ON c.custkey = e.custkey
    """,
    "names_and_places": """
        SELECT COALESCE(c.custkey, o.custkey) AS custkey, COALESCE(cities, '') AS cities, COALESCE(names, '') AS names
        FROM (SELECT c_custkey AS custkey, string_agg(DISTINCT c_mktsegment, ',' ORDER BY c_mktsegment) AS cities
              FROM customer GROUP BY c_custkey) c
        FULL JOIN (SELECT o_custkey AS custkey, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS names
                   FROM orders GROUP BY o_custkey) o
        ON c.custkey = o.custkey
    """,
    "card_defaulters": f"""
        SELECT customer_id, concat_ws(', ', customer_id, COALESCE(CAST(points AS VARCHAR), ''), 'Supplier ' || customer_id) AS line
        FROM (SELECT DISTINCT l_suppkey AS customer_id FROM lineitem) LEFT JOIN ({_CARD_POINTS}) USING (customer_id)
    """,
    "text_round_trip": """
        SELECT o_orderkey, ROUND(o_totalprice, 2) AS price, CAST(epoch(o_orderdate) AS BIGINT) AS seconds
        FROM orders WHERE o_orderkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 5)
    """,
    "cogroup_named": """
        SELECT COALESCE(p.user_id, e.user_id) AS user_id, CAST(0 AS BIGINT) AS part,
               COALESCE(purchases, '') AS purchases, COALESCE(errors, '') AS errors
        FROM (SELECT user_id, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS purchases
              FROM events WHERE event_type = 'purchase' GROUP BY user_id) p
        FULL JOIN (SELECT user_id, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS errors
                   FROM events WHERE event_type = 'error' GROUP BY user_id) e
        ON p.user_id = e.user_id
    """,
    "exclude_anti": """
        SELECT o_custkey AS custkey, MIN(o_orderpriority) AS priority, COUNT(*) AS n
        FROM orders
        WHERE o_orderstatus = 'F'
          AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey BETWEEN 0 AND 4)
        GROUP BY o_custkey HAVING LENGTH(MIN(o_orderpriority)) BETWEEN 3 AND 10
    """,
    "union_all": """
        SELECT 'customer' AS kind, c_name AS name, c_acctbal AS balance FROM customer
        UNION ALL SELECT 'supplier', s_name, s_acctbal FROM supplier
    """,
    "tag_routing": """
        SELECT DISTINCT p_name AS name, 'short' AS tag FROM part WHERE LENGTH(p_name) <= 9
        UNION ALL SELECT DISTINCT p_name, 'long' FROM part WHERE LENGTH(p_name) > 9
        UNION ALL SELECT DISTINCT p_name, 'marked' FROM part WHERE starts_with(p_name, 's')
    """,
    "word_count": """
        SELECT word, COUNT(*) AS n
        FROM (SELECT unnest(regexp_extract_all(text, '[A-Z,a-z]+')) AS word FROM documents)
        GROUP BY word HAVING COUNT(*) > 5
    """,
    "card_points": _CARD_POINTS,
    "sorted_points": f"{_CARD_POINTS} ORDER BY points DESC, customer_id",
    "top_defaulters": f"{_CARD_POINTS} ORDER BY points DESC, customer_id LIMIT 20",
    "late_defaulters": _LATE,
    "missed_periods": _GAPS,
    "missed_period_defaulters": _GAP_DEFAULTERS,
    "combined_defaulters": f"""
        SELECT COALESCE(c.customer_id, l.customer_id) AS customer_id, CAST(0 AS BIGINT) AS part,
               COALESCE(card_defaulter, '') AS card_defaulter, COALESCE(loan_defaulter, '') AS loan_defaulter
        FROM (SELECT customer_id, points || ' fraud_points' AS card_defaulter FROM ({_CARD_POINTS})) c
        FULL JOIN (SELECT customer_id, string_agg(finding, ',' ORDER BY finding) AS loan_defaulter
                   FROM (SELECT customer_id, late_payments || ' late' AS finding FROM ({_LATE})
                         UNION ALL
                         SELECT customer_id,
                                CASE WHEN missed >= 20 THEN missed ELSE longest_gap END || ' missed'
                         FROM ({_GAP_DEFAULTERS}))
                   GROUP BY customer_id) l
        ON c.customer_id = l.customer_id
    """,
    "weapon_points": f"""
        SELECT game_id, player_id, used_weapon, CAST(SUM(points) AS DOUBLE) / COUNT(*) AS mean_points
        FROM ({_KILLS}) GROUP BY game_id, player_id, used_weapon
    """,
    "weapon_sessions": _sessions(
        _KILLS, "game_id, player_id, used_weapon", "INTERVAL 48 HOURS", "points", "mean_points"
    ),
    "stream_weapon_messages": f"""
        SELECT game_id || ',' || player_id || ',' || used_weapon || ': ' || CAST(mean_points AS VARCHAR) AS line
        FROM ({_sessions(_KILLS, "game_id, player_id, used_weapon", "INTERVAL 48 HOURS", "points", "mean_points")})
    """,
    "tumbling_sum": _TUMBLING,
    "session_mean": _SESSION,
    "pane_discarding": _DISCARDING,
    "pane_accumulating": _ACCUMULATING,
    "player_team_score": _SCORES,
    "replay_envelope": _MESSAGES,
    "stream_tumbling": _TUMBLING,
    "stream_session": _SESSION,
    "stream_pane_discarding": _DISCARDING,
    "stream_pane_accumulating": _ACCUMULATING,
    "stream_player_team_score": _SCORES,
    "stream_passthrough": _MESSAGES,
    "own_mean": f"SELECT user_id, CAST(SUM(cents) AS DOUBLE) / COUNT(*) AS mean FROM ({_CENTS}) GROUP BY user_id",
    "own_global_mean": f"SELECT CAST(SUM(cents) AS DOUBLE) / COUNT(*) AS mean FROM ({_CENTS})",
    "own_variance": f"""
        SELECT event_type, CAST(COUNT(*) * SUM(cents * cents) - SUM(cents) * SUM(cents) AS DOUBLE)
               / CAST(COUNT(*) * (COUNT(*) - 1) AS DOUBLE) AS variance
        FROM ({_CENTS}) GROUP BY event_type
    """,
    "stream_landed_profit": f"""
        SELECT store_id, window_start, window_start + INTERVAL 20 SECONDS AS window_end,
               CAST(SUM(profit) AS BIGINT) AS profit, COUNT(*) AS n
        FROM (SELECT *, TIMESTAMP '2024-01-01' + INTERVAL 20 SECONDS * (event_id % 4 * 15 // 20) AS window_start FROM ({_SALES}))
        GROUP BY store_id, window_start
    """,
    "missed_minutes": """
        SELECT user_id AS customer_id, 44640 - COUNT(*) AS missed, GREATEST(MAX(gap), 44640 - MAX(minute)) AS longest_gap
        FROM (SELECT user_id, minute, minute - LAG(minute, 1, 0) OVER (PARTITION BY user_id ORDER BY minute) - 1 AS gap
              FROM (SELECT DISTINCT user_id, date_diff('minute', TIMESTAMP '2024-01-01', ts) + 1 AS minute FROM events)
              WHERE minute BETWEEN 1 AND 44640)
        GROUP BY user_id
    """,
    "exclude_long_list": """
        SELECT o_orderkey, o_custkey FROM orders
        WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
    """,
    "store_pane_profit": _STORE_PANES,
    "store_window_profit": _STORE_WINDOWS,
    "stream_store_windows": _STORE_WINDOWS,
    "stream_store_pane_messages": f"SELECT '(''' || store_id || ''', ' || total || ')' AS line FROM ({_STORE_PANES})",
    "stream_score_messages": f"SELECT id || ': ' || score AS line FROM ({_SCORES})",
}
