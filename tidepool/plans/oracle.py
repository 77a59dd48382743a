"""DuckDB SQL equal to each registered query, over the driver's tables.

These are the reference's own query shapes (one-level DISTINCT aggregates,
conditional MAX one-hot, ``LEFT JOIN ... IS NULL``), written for DuckDB so
the Spark plans are checked against an independent engine.
"""

from __future__ import annotations

from tidepool.plans.features import PLAYER_MEASURES, PLAYER_ROLES
from tidepool.plans.onehot import HERO_IDS, SIDE_NAMES
from tidepool.plans.standin import PLAYER_ROWS_SQL, PLAYERS_PER_PART

REF_TS = "TIMESTAMP '2001-08-01 00:00:00'"
REF_DATE = "DATE '2001-08-01'"


def _days(ts: str) -> str:
    return f"date_diff('day', CAST({ts} AS DATE), {REF_DATE})"


def player_features_sql(months: int = 6, measures=PLAYER_MEASURES, table: str = PLAYER_ROWS_SQL) -> str:
    avgs = ",\n    ".join(f"AVG({src}) AS {name}" for name, src in measures)
    roles = ",\n    ".join(
        f"SUM(CASE WHEN lane_role = {r} THEN 1 ELSE 0 END) / NULLIF(COUNT(DISTINCT match_id), 0) AS pctg_lane_role_{r}"
        for r in PLAYER_ROLES
    )
    outs = ["qt_matches", "qt_days_last_match"]
    outs_tail = ["tq_match_month", f"tq_match_month_{months}"] + [n for n, _ in measures] + [
        f"pctg_lane_role_{r}" for r in PLAYER_ROLES
    ]
    sel = [f"COALESCE(t1.{c}, 0) AS {c}" for c in outs]
    sel.append("COALESCE(t2.tq_days_first_match, 0) AS tq_days_first_match")
    sel += [f"COALESCE(t1.{c}, 0) AS {c}" for c in outs_tail]
    sel_s = ",\n  ".join(sel)
    return f"""
WITH pm AS ({table}),
tb_game_stats AS (
  SELECT
    account_id,
    COUNT(DISTINCT match_id) AS qt_matches,
    MIN({_days('td_match')}) AS qt_days_last_match,
    COUNT(DISTINCT match_id) / NULLIF(COUNT(DISTINCT month(td_match)), 0) AS tq_match_month,
    COUNT(DISTINCT match_id) / {months} AS tq_match_month_{months},
    {avgs},
    {roles}
  FROM pm
  WHERE CAST(td_match AS DATE) > CAST({REF_TS} - INTERVAL {months} MONTH AS DATE)
    AND td_match < {REF_TS}
  GROUP BY account_id
),
tb_lifetime AS (
  SELECT account_id, MAX({_days('td_match')}) AS tq_days_first_match
  FROM pm
  GROUP BY 1
)
SELECT
  {REF_DATE} AS dt_ref,
  t1.account_id,
  {sel_s}
FROM tb_game_stats AS t1
LEFT JOIN tb_lifetime AS t2 ON t1.account_id = t2.account_id
"""


def player_lifetime_sql() -> str:
    return f"""
WITH pm AS ({PLAYER_ROWS_SQL})
SELECT account_id, MAX({_days('td_match')}) AS tq_days_first_match
FROM pm GROUP BY 1
"""


def draft_onehot_sql(months: int = 6, table: str = PLAYER_ROWS_SQL) -> str:
    cols = []
    for s_name, flag in zip(SIDE_NAMES, ("true", "false")):
        for i in HERO_IDS:
            cols.append(
                f"MAX(CASE WHEN hero_id = {i} AND is_side_a = {flag} THEN 1 ELSE 0 END) AS {s_name}_hero_{i}"
            )
    body = ",\n  ".join(cols)
    return f"""
WITH pm AS ({table})
SELECT
  match_id,
  MAX(side_a_win) AS radiant_win,
  {body}
FROM pm
WHERE CAST(td_match AS DATE) >= CAST({REF_TS} - INTERVAL {months} MONTH AS DATE)
GROUP BY match_id
"""


def _epoch(ts: str) -> str:
    return f"CAST(epoch({ts}) AS BIGINT)"


def _text(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"


PLAYERS_SQL = f"""
SELECT l.l_orderkey AS match_id,
       CAST(l.l_linenumber AS BIGINT) AS player_slot,
       o.o_custkey AS account_id,
       l.l_partkey % 138 + 1 AS hero_id,
       CAST(l.l_linenumber AS BIGINT) AS lane_role,
       l.l_linestatus = 'O' AS isRadiant,
       o.o_orderstatus = 'F' AS radiant_win,
       CAST(CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS BIGINT) AS win,
       CAST(l.l_quantity AS BIGINT) AS kills,
       l.l_discount AS kills_per_min,
       CAST(l.l_tax AS VARCHAR) AS stuns,
       {_epoch('o.o_orderdate')} AS start_time,
       {_text('o.o_orderdate')} AS td_match
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
"""

# One row per stand-in document: match id and part (see match_documents).
DOCUMENT_KEYS_SQL = f"""
SELECT o_orderkey AS match_id, COALESCE(CAST(FLOOR((line - 1) / {PLAYERS_PER_PART}.0) AS BIGINT), 0) AS part
FROM orders LEFT JOIN (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey) AS line FROM lineitem) ON l_orderkey = o_orderkey
GROUP BY 1, 2
"""

# The stored player table under the names that the feature and draft SQL use.
CHAIN_PLAYERS_SQL = f"""
SELECT p.* EXCLUDE (td_match, start_time), isRadiant AS is_side_a, radiant_win AS side_a_win, CAST(td_match AS TIMESTAMP) AS td_match
FROM ({PLAYERS_SQL}) p
"""
# Measures of that table.
CHAIN_MEASURES = [("avg_win_rate", "win"), ("vl_avg_kill_min", "kills_per_min"), ("vl_avg_kills", "kills")]

# Run as SQL text in both engines.
VIEW_SQL = """
SELECT c.c_mktsegment AS segment, COUNT(*) AS n_orders, COUNT(DISTINCT o.o_custkey) AS n_customers
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
GROUP BY c.c_mktsegment
"""


def streamed_players_sql(split_date: str) -> str:
    """Players after the stream: those of finished matches before the split
    date were sent again with one more kill."""
    again = f"CASE WHEN radiant_win AND td_match < '{split_date}' THEN 1 ELSE 0 END"
    return f"SELECT p.* REPLACE (CAST(kills + {again} AS BIGINT) AS kills) FROM ({PLAYERS_SQL}) p"


ORDERS_EPOCH_SQL = f"SELECT *, {_epoch('o_orderdate')} AS start_time, {_text('o_orderdate')} AS td_start FROM orders"


def upserted_orders_sql(split_date: str) -> str:
    return f"""
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderdate >= TIMESTAMP '{split_date}' OR o_orderstatus = 'F'
            THEN o_totalprice + 1.0 ELSE o_totalprice END AS o_totalprice,
       o_orderdate, o_orderpriority
FROM orders
"""


def all_sql(ref: str, split_date: str, event_split_ts: str, group_size: int, trial_ids: int) -> dict[str, str]:
    assert REF_TS == f"TIMESTAMP '{ref}'", "oracle reference instant out of sync"
    backlog = """
SELECT DISTINCT hist.o_orderkey AS match_id
FROM orders AS hist
LEFT JOIN lineitem AS det ON hist.o_orderkey = det.l_orderkey
WHERE det.l_orderkey IS NULL
"""
    return {
        "player_features": player_features_sql(),
        "player_lifetime": player_lifetime_sql(),
        "draft_onehot": draft_onehot_sql(),
        "backlog_ids": backlog,
        "backlog_batch": backlog,
        "pending_matches": backlog,
        "ingest_modes": ORDERS_EPOCH_SQL,
        "sql_views": VIEW_SQL,
        "bronze_features": player_features_sql(measures=CHAIN_MEASURES, table=CHAIN_PLAYERS_SQL),
        "bronze_draft": draft_onehot_sql(table=CHAIN_PLAYERS_SQL),
        "check_group_size": f"""
WITH pm AS ({PLAYER_ROWS_SQL})
SELECT match_id, COUNT(*) AS n_rows
FROM pm
WHERE account_id IS NOT NULL AND PLAYER_SLOT IS NOT NULL
GROUP BY 1
HAVING COUNT(*) != {group_size}
""",
        "check_uniqueness": "SELECT COUNT(*) AS n_rows, COUNT(DISTINCT l_orderkey) AS n_distinct_keys FROM lineitem",
        "check_players": """
SELECT l_orderkey AS match_id, COUNT(*) AS n_rows
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE o_custkey IS NOT NULL AND l_linenumber IS NOT NULL
GROUP BY 1
HAVING COUNT(*) != 10
""",
        "check_details": f"SELECT COUNT(*) AS n_rows, COUNT(DISTINCT match_id || '-' || part) AS n_distinct_keys FROM ({DOCUMENT_KEYS_SQL})",
        "id_cursor": "SELECT MIN(o_orderkey) AS min_id, MAX(o_orderkey) AS max_id FROM orders",
        "epoch_to_string": f"SELECT o_orderkey, {_epoch('o_orderdate')} AS start_time, "
                           f"{_text('o_orderdate')} AS td_start FROM orders",
        "json_fixed_schema_scan": "SELECT event_id, user_id, event_type, value, "
                                  "CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
        "json_land_roundtrip": "SELECT * FROM orders",
        "explode_players": PLAYERS_SQL,
        "bronze_players": PLAYERS_SQL,
        "flatten_structs": f"""
SELECT k.match_id, k.part,
       c.c_custkey AS league_leagueid, c.c_name AS league_name, c.c_mktsegment AS league_tier,
       CAST(c.c_nationkey AS BIGINT) AS radiant_team_team_id, c.c_acctbal AS radiant_team_rating,
       o.o_custkey AS dire_team_team_id, o.o_totalprice AS dire_team_rating,
       o.o_orderpriority AS picks_1, o.o_orderstatus AS picks_2, c.c_mktsegment AS picks_3, c.c_name AS picks_4,
       CAST(c.c_nationkey AS VARCHAR) AS picks_5
FROM ({DOCUMENT_KEYS_SQL}) k JOIN orders o ON o.o_orderkey = k.match_id LEFT JOIN customer c ON o.o_custkey = c.c_custkey
""",
        "ingest_new": ORDERS_EPOCH_SQL,
        "ingest_backfill": ORDERS_EPOCH_SQL,
        "append_evolving": f"""
SELECT event_id, ts, user_id, event_type, value,
       CASE WHEN ts >= TIMESTAMP '{event_split_ts}' THEN props END AS props
FROM events
""",
        "ledger_append": "SELECT DISTINCT match_id FROM "
                         "(SELECT o_orderkey AS match_id FROM orders UNION ALL SELECT l_orderkey FROM lineitem)",
        "full_load_once": "SELECT * FROM orders",
        "batch_upsert": upserted_orders_sql(split_date),
        "stream_upsert": upserted_orders_sql(split_date),
        "stream_bronze_players": streamed_players_sql(split_date),
        "compact_table": "SELECT * FROM lineitem",
        "text_features": player_features_sql(),
        "text_draft": draft_onehot_sql(),
        "sliding_features": player_features_sql(),
        "lifetime_now": f"SELECT account_id, MAX(date_diff('day', CAST(td_match AS DATE), current_date)) AS tq_days_first_match FROM ({PLAYER_ROWS_SQL}) GROUP BY 1",
        "backlog_top": f"{backlog} ORDER BY 1 LIMIT {trial_ids}",
        "id_cursor_from_files": "SELECT MIN(o_orderkey) AS min_id, MAX(o_orderkey) AS max_id FROM orders",
        "pending_bucketed": backlog,
        "merge_bucketed": upserted_orders_sql(split_date),
        "check_load": f"SELECT COUNT(*) AS n_rows, COUNT(DISTINCT match_id || '-' || part) AS n_distinct_keys FROM ({DOCUMENT_KEYS_SQL})",
        "json_quarantine": """
SELECT CASE WHEN event_type = 'purchase' THEN '{"event_id":' || event_id || ',"user_id":' || user_id ELSE '{"user_id":' || user_id || '}' END AS text,
       CASE WHEN event_type = 'purchase' THEN 'broken' ELSE 'no key' END AS reason
FROM events WHERE event_type IN ('purchase', 'click')
""",
        "compact_small": "SELECT * FROM lineitem",
    }
