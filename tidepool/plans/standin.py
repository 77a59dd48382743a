"""Stand-ins for the game tables, derived from the driver's tables.

``player_rows`` plays the flat player table: one row per line item, the order
being the match and the customer the account. ``match_documents`` plays the
nested match documents: one document per order with its lines as the
``players`` array. Everything here is a plain scan + join whose work grows
with the tables; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.operators.nested import nest_rows
from tidepool.sources.tables import load

# The player table stand-in as (column, SQL expression) pairs over
# ``lineitem l JOIN orders o``. The same text runs in Spark (``selectExpr``)
# and in the DuckDB oracle, so the two sides cannot drift apart. Measures are
# BIGINT like the game's counters, except ``kills_per_min`` (DOUBLE).
PLAYER_COLUMNS = [
    ("match_id", "l.l_orderkey"),
    ("account_id", "o.o_custkey"),
    ("player_slot", "CAST(l.l_linenumber AS BIGINT)"),
    ("lane_role", "CAST(l.l_linenumber AS BIGINT)"),
    ("hero_id", "l.l_partkey % 138 + 1"),
    ("is_side_a", "l.l_linestatus = 'O'"),
    ("side_a_win", "o.o_orderstatus = 'F'"),
    ("win", "CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END"),
    ("kills", "CAST(l.l_quantity AS BIGINT)"),
    ("kills_per_min", "l.l_discount"),
    ("assists", "l.l_partkey"),
    ("camps_stacked", "l.l_suppkey"),
    ("creeps_stacked", "CAST(l.l_linenumber AS BIGINT) * 2"),
    ("deaths", "CAST(l.l_linenumber AS BIGINT) + 1"),
    ("denies", "CASE WHEN l.l_returnflag = 'N' THEN 1 ELSE 0 END"),
    ("firstblood_claimed", "CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END"),
    ("gold_per_min", "CAST(FLOOR(l.l_extendedprice) AS BIGINT)"),
    ("rune_pickups", "CAST(l.l_quantity AS BIGINT) + l.l_linenumber"),
    ("xp_per_min", "CAST(FLOOR(o.o_totalprice) AS BIGINT)"),
    ("kda", "CAST(FLOOR(l.l_extendedprice * l.l_tax) AS BIGINT)"),
    ("neutral_kills", "CAST(FLOOR(l.l_extendedprice * l.l_discount) AS BIGINT)"),
    ("tower_kills", "CAST(FLOOR(l.l_extendedprice * (1 - l.l_discount)) AS BIGINT)"),
    ("observer_kills", "CAST(FLOOR(o.o_totalprice - l.l_extendedprice) AS BIGINT)"),
    ("sentry_kills", "CAST(FLOOR(l.l_extendedprice * l.l_tax * 100) AS BIGINT)"),
    ("td_match", "o.o_orderdate"),
]

PLAYER_ROWS_SQL = (
    "SELECT "
    + ",\n       ".join(f"{expr} AS {name}" for name, expr in PLAYER_COLUMNS)
    + "\nFROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"
)


def player_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat player table stand-in (see ``PLAYER_COLUMNS``)."""
    li = load(spark, sf_dir, "lineitem").alias("l")
    o = load(spark, sf_dir, "orders").alias("o")
    joined = li.join(o, F.col("l.l_orderkey") == F.col("o.o_orderkey"), "inner")
    return joined.selectExpr(*[f"{expr} AS {name}" for name, expr in PLAYER_COLUMNS])


# Fields of one element of ``players`` in the stand-in documents, as SQL
# over ``lineitem`` joined to ``orders``.
PLAYER_FIELDS = [
    ("match_id", "l_orderkey"),
    ("player_slot", "CAST(l_linenumber AS BIGINT)"),
    ("account_id", "o_custkey"),
    ("hero_id", "l_partkey % 138 + 1"),
    ("lane_role", "CAST(l_linenumber AS BIGINT)"),
    ("isRadiant", "l_linestatus = 'O'"),
    ("radiant_win", "o_orderstatus = 'F'"),
    ("win", "CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS BIGINT)"),
    ("kills", "CAST(l_quantity AS BIGINT)"),
    ("kills_per_min", "l_discount"),
    ("stuns", "CAST(l_tax AS STRING)"),
    ("start_time", "unix_timestamp(CAST(o_orderdate AS TIMESTAMP))"),
]


# Players that one document holds at most: a longer match comes in parts.
PLAYERS_PER_PART = 64


def match_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested match documents: order fields, structs from the customer (the
    league, both teams, and one with fields named ``1`` to ``5``) and the
    ``players`` array of the order's lines.

    A document's key is (match_id, part): a match of more than
    PLAYERS_PER_PART lines becomes several documents (see
    :func:`tidepool.operators.nested.nest_rows`), so none is unbounded.
    """
    o = load(spark, sf_dir, "orders")
    c = load(spark, sf_dir, "customer")
    lines = load(spark, sf_dir, "lineitem").join(
        o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"), "inner")
    fields = ", ".join(f"{expr} AS {name}" for name, expr in PLAYER_FIELDS)
    players = lines.selectExpr("l_orderkey AS match_id", f"struct({fields}) AS player")
    nested = nest_rows(players, key="match_id", part="part", item="player", array="players", size=PLAYERS_PER_PART)
    head = o.join(c, o.o_custkey == c.c_custkey, "left").selectExpr(
        "o_orderkey AS match_id",
        "unix_timestamp(CAST(o_orderdate AS TIMESTAMP)) AS start_time",
        "o_orderstatus = 'F' AS radiant_win",
        "o_totalprice AS duration_value",
        "o_orderpriority AS patch_name",
        "struct(c_custkey AS leagueid, c_name AS name, c_mktsegment AS tier) AS league",
        "struct(CAST(c_nationkey AS BIGINT) AS team_id, c_acctbal AS rating) AS radiant_team",
        "struct(o_custkey AS team_id, o_totalprice AS rating) AS dire_team",
        "named_struct('1', o_orderpriority, '2', o_orderstatus, '3', c_mktsegment, '4', c_name, '5', CAST(c_nationkey AS STRING)) AS picks",
    )
    # orders without lines keep a NULL players array, like a document
    # that lacks the key
    return head.join(nested, "match_id", "left").withColumn("part", F.coalesce("part", F.lit(0).cast("bigint")))
