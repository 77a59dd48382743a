"""tidepool: lakehouse jobs for nested match data on Spark.

The public entry points, by stage:

* sources: ``read_table``, ``append_evolving``, ``ledger_append``,
  ``read_ledger``, ``full_load_once``, ``table_exists``, ``create_database``,
  ``replace_table``, ``rows_frame``; ``schema_from_json``, ``schema_to_json``,
  ``read_json_docs``, ``parse_json_column``, ``land_json``; ``ingest``,
  ``ingest_new``, ``ingest_backfill``; ``compact_table``
* operators: ``backlog``, ``backlog_batch``, ``id_cursor``; ``nest_rows``,
  ``explode_items``, ``explode_players``, ``flatten_structs``;
  ``group_size``, ``uniqueness``; ``upsert``, ``SnapshotStore``,
  ``MergeTarget``
* streaming: ``json_stream``, ``stream_upsert``
* plans: ``entity_features``, ``entity_lifetime``, ``entity_first_seen``,
  ``merge_first_seen``, ``one_hot``, ``draft_onehot``, ``load_bronze``,
  ``build_players``, ``check_players``, ``check_details``,
  ``pending_matches``
* session: ``configure``, ``size_for_input``, ``scratch_path``
"""

from tidepool.operators.backlog import backlog, backlog_batch, id_cursor
from tidepool.operators.nested import explode_items, explode_players, flatten_structs, nest_rows
from tidepool.operators.quality import group_size, uniqueness
from tidepool.operators.upsert import MergeTarget, SnapshotStore, upsert
from tidepool.plans.bronze import build_players, check_details, check_players, load_bronze, pending_matches
from tidepool.plans.features import entity_features, entity_first_seen, entity_lifetime, merge_first_seen
from tidepool.plans.onehot import draft_onehot, one_hot
from tidepool.session import configure, scratch_path, size_for_input
from tidepool.sources.ingest import ingest, ingest_backfill, ingest_new
from tidepool.sources.json_docs import land_json, parse_json_column, read_json_docs, schema_from_json, schema_to_json
from tidepool.sources.maintain import compact_table
from tidepool.sources.tables import (
    append_evolving,
    create_database,
    full_load_once,
    ledger_append,
    read_ledger,
    read_table,
    replace_table,
    rows_frame,
    table_exists,
)
from tidepool.streaming.bronze_stream import json_stream, stream_upsert

__all__ = [
    "MergeTarget", "SnapshotStore", "append_evolving", "backlog", "backlog_batch", "build_players",
    "check_details", "check_players", "compact_table", "configure", "create_database", "draft_onehot",
    "entity_features", "entity_first_seen", "entity_lifetime", "explode_items", "explode_players",
    "flatten_structs", "full_load_once", "group_size", "id_cursor", "ingest", "ingest_backfill", "ingest_new",
    "json_stream", "land_json", "ledger_append", "load_bronze", "merge_first_seen", "nest_rows", "one_hot",
    "parse_json_column", "pending_matches", "read_json_docs", "read_ledger", "read_table", "replace_table",
    "rows_frame", "schema_from_json", "schema_to_json", "scratch_path", "size_for_input", "stream_upsert",
    "table_exists", "uniqueness", "upsert",
]
