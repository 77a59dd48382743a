"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame
over the driver's tables (or data Spark derives from them and writes to the
shared scratch folder). Every query runs over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions.time import epoch_to_string
from tidepool.operators.backlog import backlog, backlog_batch, id_cursor, id_cursor_from_files
from tidepool.operators.bucketed import append_bucketed, merge_bucketed, pending_ids
from tidepool.operators.nested import explode_players, flatten_structs
from tidepool.operators.quality import group_size, uniqueness
from tidepool.operators.upsert import SnapshotStore, upsert
from tidepool.plans import oracle
from tidepool.plans.bronze import build_players, check_details, check_players, load_bronze, load_bronze_checked, pending_matches
from tidepool.plans.features import entity_features, entity_first_seen, entity_lifetime, merge_first_seen
from tidepool.plans.onehot import draft_onehot
from tidepool.plans.standin import match_documents, player_rows
from tidepool.plans.state import features_from_state, fold_batch
from tidepool.session import FILE_EXPANSION, configure, path_bytes, scratch_path, size_for_input
from tidepool.sources.ingest import ingest, ingest_backfill, ingest_new, with_start_text
from tidepool.sources.json_docs import (
    land_json,
    match_document_schema,
    read_json_docs,
    schema_from_json,
    schema_to_json,
)
from tidepool.sources.compact_small import compact_small, table_files
from tidepool.sources.maintain import TARGET_FILE_BYTES, compact_table, data_files
from tidepool.sources.quarantine import quarantine
from tidepool.sources.tables import (append_evolving, create_database, ledger_append, load, read_ledger, read_table, register_views,
                                     table_name)
from tidepool.streaming.bronze_stream import stream_upsert

# The reference instant of every dated query: the last order date.
REF = "2001-08-01 00:00:00"
# Split points that divide whole tables into "already stored" and "arriving".
SPLIT_DATE = "2000-01-01 00:00:00"
EVENT_SPLIT_TS = "2024-01-15 00:00:00"
# Ids of the lowest part of the backlog that a trial run takes.
TRIAL_IDS = 10
# Rows expected per match in the group-size check on the stand-in table.
GROUP_SIZE = 4


def _setup(spark: SparkSession, sf_dir: str, *tables: str) -> None:
    """Session settings, and shuffles sized from the bytes of the inputs."""
    configure(spark)
    size_for_input(spark, sum(path_bytes(spark, table_name(sf_dir, t)) for t in tables))


def _start(spark: SparkSession, sf_dir: str) -> DataFrame:
    _setup(spark, sf_dir, "lineitem", "orders")
    return player_rows(spark, sf_dir)


def q_player_features(spark, sf_dir):
    return entity_features(_start(spark, sf_dir), ref=REF)


def q_player_lifetime(spark, sf_dir):
    return entity_lifetime(_start(spark, sf_dir), ref=REF)


def q_draft_onehot(spark, sf_dir):
    return draft_onehot(_start(spark, sf_dir), side="is_side_a", outcome="side_a_win", ref=REF)


def q_check_group_size(spark, sf_dir):
    return group_size(_start(spark, sf_dir), "match_id", GROUP_SIZE, not_null=["account_id", "PLAYER_SLOT"])


def q_check_uniqueness(spark, sf_dir):
    _setup(spark, sf_dir, "lineitem")
    return uniqueness(load(spark, sf_dir, "lineitem"), "l_orderkey")


def q_id_cursor(spark, sf_dir):
    _setup(spark, sf_dir, "orders")
    return id_cursor(load(spark, sf_dir, "orders"), "o_orderkey")


def _listing(spark, sf_dir):
    return load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("match_id"))


def _done(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("match_id"))


def q_backlog_ids(spark, sf_dir):
    _setup(spark, sf_dir, "orders", "lineitem")
    return backlog(_listing(spark, sf_dir), _done(spark, sf_dir))


def q_backlog_batch(spark, sf_dir):
    _setup(spark, sf_dir, "orders", "lineitem")
    return backlog_batch(backlog(_listing(spark, sf_dir), _done(spark, sf_dir)))


def _orders_with_epoch(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    return o.withColumn("start_time", F.unix_timestamp(F.col("o_orderdate").cast("timestamp")))


def q_epoch_to_string(spark, sf_dir):
    _setup(spark, sf_dir, "orders")
    o = _orders_with_epoch(spark, sf_dir)
    return o.select("o_orderkey", "start_time", epoch_to_string("start_time").alias("td_start"))


def q_json_fixed_schema_scan(spark, sf_dir):
    """Events landed as JSON documents whose ``props`` is the raw JSON text,
    scanned back under a fixed schema."""
    _setup(spark, sf_dir, "events")
    ev = load(spark, sf_dir, "events")
    head = F.to_json(F.struct("event_id", "user_id", "event_type", "value"))
    doc = F.concat(F.expr("substring(_h, 1, length(_h) - 1)"), F.lit(',"props":'), F.col("props"), F.lit("}"))
    raw = scratch_path(spark, "events_json")
    ev.select(head.alias("_h"), "props").select(doc.alias("value")).write.text(raw)
    schema = "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE, props STRUCT<k: BIGINT>"
    docs = read_json_docs(spark, raw, schema, key="event_id")
    return docs.select("event_id", "user_id", "event_type", "value", F.col("props.k").alias("k"))


def q_json_land_roundtrip(spark, sf_dir):
    """Orders landed as JSON documents with their schema file, read back."""
    _setup(spark, sf_dir, "orders")
    o = load(spark, sf_dir, "orders")
    raw = scratch_path(spark, "orders_json")
    land_json(o, f"{raw}/docs")
    schema_to_json(o.schema, f"{raw}/_schema/schema.json", spark)
    schema = schema_from_json(f"{raw}/_schema/schema.json", spark)
    return read_json_docs(spark, f"{raw}/docs", schema, key="o_orderkey")


def q_explode_players(spark, sf_dir):
    _setup(spark, sf_dir, "lineitem", "orders", "customer")
    return explode_players(match_documents(spark, sf_dir))


def q_bronze_players(spark, sf_dir):
    """Documents landed as JSON -> full load into a catalog table (once) ->
    player table recreated from it (CTAS)."""
    _setup(spark, sf_dir, "lineitem", "orders", "customer")
    docs = match_documents(spark, sf_dir)
    base = scratch_path(spark, "bronze")
    land_json(docs, f"{base}/raw", compression="gzip")
    db = f"bronze_{uuid.uuid4().hex[:10]}"
    load_bronze(spark, f"{base}/raw", match_document_schema(), db, "match_details", location=f"{base}/db")
    return build_players(spark, db, "match_details", "match_players")


def q_check_players(spark, sf_dir):
    """The player-table check as the job runs it: matches of the exploded
    documents whose players with an account and a slot are not 10."""
    _setup(spark, sf_dir, "lineitem", "orders", "customer")
    return check_players(explode_players(match_documents(spark, sf_dir)))


def q_check_details(spark, sf_dir):
    """The document-table check: documents vs distinct (match id, part)."""
    _setup(spark, sf_dir, "lineitem", "orders", "customer")
    return check_details(match_documents(spark, sf_dir))


def q_flatten_structs(spark, sf_dir):
    """League, both teams and the struct with fields ``1`` to ``5`` of the
    documents as columns (a document per match and part: first parts only
    would be a cut, so every part is there)."""
    _setup(spark, sf_dir, "lineitem", "orders", "customer")
    return flatten_structs(match_documents(spark, sf_dir), ["league", "radiant_team", "dire_team", "picks"], keep=["match_id", "part"])


def _mid_key(df, key):
    row = id_cursor(df, key).first()
    return (row["min_id"] + row["max_id"]) // 2


def q_ingest_new(spark, sf_dir):
    """Target holds ids up to the middle; one run appends every newer row."""
    _setup(spark, sf_dir, "orders")
    src = _orders_with_epoch(spark, sf_dir)
    cut = _mid_key(src, "o_orderkey")
    target = scratch_path(spark, "history_new")
    append_evolving(with_start_text(src.filter(F.col("o_orderkey") <= cut)), target)
    ingest_new(spark, src, target, key="o_orderkey")
    return read_table(spark, target, merge_schema=True)


def q_ingest_backfill(spark, sf_dir):
    """Target holds ids from the middle up; one run backfills all below its min."""
    _setup(spark, sf_dir, "orders")
    src = _orders_with_epoch(spark, sf_dir)
    cut = _mid_key(src, "o_orderkey")
    target = scratch_path(spark, "history_old")
    append_evolving(with_start_text(src.filter(F.col("o_orderkey") >= cut)), target)
    ingest_backfill(spark, src, target, key="o_orderkey")
    return read_table(spark, target, merge_schema=True)


def q_append_evolving(spark, sf_dir):
    """Two appends; the second brings a new column, NULL for older rows."""
    _setup(spark, sf_dir, "events")
    ev = load(spark, sf_dir, "events")
    split = F.lit(EVENT_SPLIT_TS).cast(ev.schema["ts"].dataType)
    path = scratch_path(spark, "events_append")
    append_evolving(ev.filter(F.col("ts") < split).drop("props"), path)
    append_evolving(ev.filter(F.col("ts") >= split), path)
    return read_table(spark, path, merge_schema=True).select(*ev.columns)


def q_ledger_append(spark, sf_dir):
    """Two runs append their processed ids; readers see each id once."""
    _setup(spark, sf_dir, "orders", "lineitem")
    path = scratch_path(spark, "ledger")
    ledger_append(_listing(spark, sf_dir), path)
    ledger_append(_done(spark, sf_dir).distinct(), path)
    return read_ledger(spark, path)


def q_full_load_once(spark, sf_dir):
    """Orders landed as JSON; the first call loads the table, the second is
    a no-op."""
    _setup(spark, sf_dir, "orders")
    o = load(spark, sf_dir, "orders")
    base = scratch_path(spark, "full_load")
    land_json(o, f"{base}/raw")
    db = f"bronze_{uuid.uuid4().hex[:10]}"
    first = load_bronze(spark, f"{base}/raw", o.schema, db, "orders", location=f"{base}/db", key="o_orderkey")
    second = load_bronze(spark, f"{base}/raw", o.schema, db, "orders", location=f"{base}/db", key="o_orderkey")
    if not first or second:
        raise RuntimeError("full load must run once and then be a no-op")
    return spark.table(f"`{db}`.`orders`")


def _order_changes(o: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Old table = orders before the split date; changes = every later
    order (insert) and every finished one (update, price + 1)."""
    split = F.lit(SPLIT_DATE).cast(o.schema["o_orderdate"].dataType)
    old = o.filter(F.col("o_orderdate") < split)
    changed = o.filter((F.col("o_orderdate") >= split) | (F.col("o_orderstatus") == "F"))
    changed = changed.withColumn("o_totalprice", F.col("o_totalprice") + F.lit(1.0))
    return old, changed


def q_batch_upsert(spark, sf_dir):
    _setup(spark, sf_dir, "orders")
    old, changed = _order_changes(load(spark, sf_dir, "orders"))
    return upsert(old, changed, key="o_orderkey")


def q_stream_upsert(spark, sf_dir):
    """Changes arrive as JSON files in two landings, each drained by a run of
    the stream on one checkpoint; every micro-batch rewrites the buckets of
    its keys only."""
    _setup(spark, sf_dir, "orders")
    o = load(spark, sf_dir, "orders")
    old, changed = _order_changes(o)
    base = scratch_path(spark, "stream")
    store = SnapshotStore(spark, f"{base}/table", expected_bytes=path_bytes(spark, table_name(sf_dir, "orders")))
    store.write(old, "o_orderkey")
    late = F.col("o_orderdate") >= F.lit(SPLIT_DATE).cast(o.schema["o_orderdate"].dataType)
    for landing in (changed.filter(~late), changed.filter(late)):
        land_json(landing, f"{base}/incoming", mode="append")
        stream_upsert(spark, f"{base}/incoming", o.schema, store, f"{base}/_checkpoint", key="o_orderkey")
    return store.read()


def q_stream_bronze_players(spark, sf_dir):
    """The bronze path on nested documents: matches before the split date
    are the loaded table; finished ones of them are sent again with changed
    content (duration and every player's kills + 1) and later ones arrive
    new, in two landings of JSON files. Each is streamed under the packaged
    document schema and upserted by (match id, part); the player table is
    exploded from the result."""
    _setup(spark, sf_dir, "lineitem", "orders", "customer")
    base = scratch_path(spark, "stream_docs")
    # the documents are used three times: nest them once
    key = F.concat_ws("-", "match_id", "part")
    match_documents(spark, sf_dir).withColumn("doc_key", key).write.parquet(f"{base}/documents")
    docs = spark.read.parquet(f"{base}/documents")
    new = F.col("start_time") >= F.unix_timestamp(F.lit(SPLIT_DATE).cast("timestamp"))
    store = SnapshotStore(spark, f"{base}/details", expected_bytes=path_bytes(spark, f"{base}/documents"))
    store.write(docs.filter(~new), "doc_key")
    sent_again = docs.filter(~new & F.col("radiant_win")).withColumns({
        "duration_value": F.col("duration_value") + 1,
        "players": F.transform("players", lambda p: p.withField("kills", p["kills"] + 1)),
    })
    schema = match_document_schema().add("doc_key", "string")
    for landing in (sent_again, docs.filter(new)):
        land_json(landing, f"{base}/raw", mode="append", compression="gzip")
        stream_upsert(spark, f"{base}/raw", schema, store, f"{base}/_checkpoint", key="doc_key")
    return explode_players(store.read())


def q_compact_table(spark, sf_dir):
    """Line items written as many small files, compacted into few."""
    _setup(spark, sf_dir, "lineitem")
    li = load(spark, sf_dir, "lineitem")
    base = scratch_path(spark, "compact")
    # small files without a shuffle: each writer task rolls a new file now and
    # then, sized from the input so that the number of files does not grow with it
    rows = max(1_000, li.count() // 48)
    li.write.option("maxRecordsPerFile", rows).parquet(f"{base}/small")
    files = compact_table(spark, f"{base}/small", f"{base}/compacted")
    if files >= data_files(spark, f"{base}/small"):
        raise RuntimeError("compaction left as many files as there were")
    return spark.read.parquet(f"{base}/compacted")


def _player_table(spark, sf_dir) -> DataFrame:
    """The real chain up to the stored player table: documents landed as
    JSON, full load, players with the start as text and timestamp, in month
    folders."""
    _setup(spark, sf_dir, "lineitem", "orders", "customer")
    base = scratch_path(spark, "chain")
    land_json(match_documents(spark, sf_dir), f"{base}/raw", compression="gzip")
    db = f"chain_{uuid.uuid4().hex[:10]}"
    load_bronze(spark, f"{base}/raw", match_document_schema(), db, "match_details", location=f"{base}/db")
    return build_players(spark, db, "match_details", "match_players", ts_col="ts_match", day_col="mo_match", period="month")


def q_bronze_features(spark, sf_dir):
    """Player features from the stored player table: the window reads its
    months' folders only, the lifetime comes from a first-seen table kept up
    to date from the rows after the split date."""
    players = _player_table(spark, sf_dir)
    split = F.lit(SPLIT_DATE).cast("timestamp")
    seen = entity_first_seen(players.filter(F.col("ts_match") < split), ts="ts_match")
    seen = merge_first_seen(seen, players.filter(F.col("ts_match") >= split), ts="ts_match")
    return entity_features(players, ts="ts_match", measures=oracle.CHAIN_MEASURES, ref=REF, day_col="mo_match", period="month", first_seen=seen)


def q_bronze_draft(spark, sf_dir):
    """The draft matrix from the stored player table, months pruned."""
    return draft_onehot(_player_table(spark, sf_dir), side="isRadiant", ts="ts_match", ref=REF, day_col="mo_match", period="month")


def q_pending_matches(spark, sf_dir):
    """The backlog as the job runs it: a stored listing table against the
    ledger of processed ids; the ids found are then fetched and entered, after
    which nothing is pending. Returns the ids that were."""
    _setup(spark, sf_dir, "orders", "lineitem")
    base = scratch_path(spark, "pending")
    append_evolving(_listing(spark, sf_dir), f"{base}/history")
    ledger_append(_done(spark, sf_dir).distinct(), f"{base}/ledger")
    pending_matches(spark, f"{base}/history", f"{base}/ledger").write.parquet(f"{base}/batch")
    batch = spark.read.parquet(f"{base}/batch")
    ledger_append(batch, f"{base}/ledger")
    if pending_matches(spark, f"{base}/history", f"{base}/ledger").limit(1).count():
        raise RuntimeError("ids stay pending after they were entered")
    return batch


def q_ingest_modes(spark, sf_dir):
    """Target holds the ids around the middle; a run in mode ``new`` and one in
    mode ``history`` complete it."""
    _setup(spark, sf_dir, "orders")
    src = _orders_with_epoch(spark, sf_dir)
    mid = _mid_key(src, "o_orderkey")
    target = scratch_path(spark, "history_modes")
    append_evolving(with_start_text(src.filter(F.col("o_orderkey").between(mid // 2, mid))), target)
    for mode in ("new", "history"):
        ingest(spark, src, target, mode=mode, key="o_orderkey")
    return read_table(spark, target, merge_schema=True)


def q_sql_views(spark, sf_dir):
    """Tables registered as temporary views and queried as SQL text."""
    _setup(spark, sf_dir, "orders", "customer")
    register_views(spark, sf_dir, "orders", "customer")
    return spark.sql(oracle.VIEW_SQL)


def _text_players(spark, sf_dir) -> DataFrame:
    """A stored player table as the reference shapes it: the start as text only."""
    path = scratch_path(spark, "text_players")
    rows = _start(spark, sf_dir)
    # sorted by start, as a table that grows by the day is: row groups hold spans of time
    rows.withColumn("td_match", F.date_format("td_match", "yyyy-MM-dd HH:mm:ss")).sortWithinPartitions("td_match").write.parquet(path)
    return spark.read.parquet(path)


def q_text_features(spark, sf_dir):
    """Player features from a table whose start time is text: the window's
    bounds reach the scan as text, the parsed value is checked again."""
    return entity_features(_text_players(spark, sf_dir), ref=REF)


def q_text_draft(spark, sf_dir):
    """The draft matrix from the same table (start closed, no end)."""
    return draft_onehot(_text_players(spark, sf_dir), side="is_side_a", outcome="side_a_win", ref=REF)


def q_sliding_features(spark, sf_dir):
    """Player features from monthly partial aggregates, kept in two batches (the
    rows before and after the split date), and the rows of the window's edge months."""
    rows = _start(spark, sf_dir)
    base = scratch_path(spark, "sliding")
    month = F.trunc(F.col("td_match").cast("date"), "month")
    rows.withColumn("mo_match", month).hint("rebalance", "mo_match").write.partitionBy("mo_match").parquet(f"{base}/players")
    players = spark.read.parquet(f"{base}/players")
    old = F.col("td_match") < F.lit(SPLIT_DATE).cast(rows.schema["td_match"].dataType)
    fold_batch(players.filter(old), f"{base}/state", "history")
    fold_batch(players.filter(~old), f"{base}/state", "daily")
    return features_from_state(spark, f"{base}/state", players, ref=REF, month_col="mo_match")


def q_lifetime_now(spark, sf_dir):
    """Lifetimes up to the day on which the job runs."""
    return entity_lifetime(_start(spark, sf_dir))


def q_backlog_top(spark, sf_dir):
    """The lowest ids of the backlog, as a trial run takes them."""
    _setup(spark, sf_dir, "orders", "lineitem")
    return backlog_batch(backlog(_listing(spark, sf_dir), _done(spark, sf_dir)), TRIAL_IDS)


def q_id_cursor_from_files(spark, sf_dir):
    """Least and greatest id from the statistics in the files' footers."""
    configure(spark)
    return id_cursor_from_files(spark, table_name(sf_dir, "orders"), "o_orderkey")


def q_pending_bucketed(spark, sf_dir):
    """The backlog of a listing against its ledger, both stored in buckets of
    the id: processed ids are appended bucketed, the anti join shuffles neither table."""
    _setup(spark, sf_dir, "orders", "lineitem")
    base, db = scratch_path(spark, "ledger"), f"ledger_{uuid.uuid4().hex[:10]}"
    create_database(spark, db, base)
    size = path_bytes(spark, table_name(sf_dir, "lineitem")) * FILE_EXPANSION
    append_bucketed(_listing(spark, sf_dir), db, "listing", "match_id", size)
    half = F.col("match_id") % 2 == 0
    for ids in (_done(spark, sf_dir).distinct().filter(half), _done(spark, sf_dir).distinct().filter(~half)):
        append_bucketed(ids, db, "ledger", "match_id", size)
    return pending_ids(spark, db, "listing", "ledger")


def q_merge_bucketed(spark, sf_dir):
    """Changed orders upserted into a table in buckets of its key: its rows
    are joined and written where they lie, the batch alone is shuffled."""
    _setup(spark, sf_dir, "orders")
    old, changed = _order_changes(load(spark, sf_dir, "orders"))
    base, db = scratch_path(spark, "merge"), f"merge_{uuid.uuid4().hex[:10]}"
    create_database(spark, db, base)
    size = path_bytes(spark, table_name(sf_dir, "orders")) * FILE_EXPANSION
    merge_bucketed(old, db, "orders", "o_orderkey", expected_bytes=size)
    return merge_bucketed(changed, db, "orders", "o_orderkey")


def q_check_load(spark, sf_dir):
    """Documents vs distinct document keys, counted by the load's own run."""
    _setup(spark, sf_dir, "lineitem", "orders", "customer")
    base = scratch_path(spark, "check_load")
    land_json(match_documents(spark, sf_dir), f"{base}/raw", compression="gzip")
    db = f"check_{uuid.uuid4().hex[:10]}"
    return load_bronze_checked(spark, f"{base}/raw", match_document_schema(), db, "match_details", location=f"{base}/db")


def q_json_quarantine(spark, sf_dir):
    """Events landed as JSON documents: purchases arrive cut off, clicks without
    their id. The scan drops both; the quarantine table holds their texts."""
    _setup(spark, sf_dir, "events")
    base = scratch_path(spark, "quarantine")
    doc = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"user_id":'), F.col("user_id").cast("string"), F.lit("}"))
    keyless = F.concat(F.lit('{"user_id":'), F.col("user_id").cast("string"), F.lit("}"))
    kind = F.col("event_type")
    cut = F.expr("substring(_doc, 1, length(_doc) - 1)")
    load(spark, sf_dir, "events").withColumn("_doc", doc).select(
        F.when(kind == "purchase", cut).when(kind == "click", keyless).otherwise(F.col("_doc")).alias("value")).write.text(f"{base}/raw")
    schema = spark.createDataFrame([], "event_id BIGINT, user_id BIGINT").schema
    counts = quarantine(spark, f"{base}/raw", schema, f"{base}/quarantine", "first", key="event_id")
    kept = spark.read.parquet(f"{base}/quarantine").select("text", "reason")
    if sum(counts.values()) != kept.count():
        raise RuntimeError("the quarantine table does not hold what its write counted")
    return kept


def q_compact_small(spark, sf_dir):
    """Line items written as large and small files; only the small ones are
    rewritten, in place."""
    _setup(spark, sf_dir, "lineitem")
    li = load(spark, sf_dir, "lineitem")
    path = scratch_path(spark, "compact_small")
    li.filter(F.col("l_returnflag") != "R").write.parquet(path)
    large = table_files(spark, path)
    rows = max(1_000, li.count() // max(48, 8 * len(large)))
    li.filter(F.col("l_returnflag") == "R").write.mode("append").option("maxRecordsPerFile", rows).parquet(path)
    # as large as a large file, which a split of the scan bounds: a target that
    # is a share of the table would let one task read ever more of it
    small = [size for name, size in table_files(spark, path).items() if name not in large]
    target = max(1, min(TARGET_FILE_BYTES, max([*large.values(), 3 * max(small)])))
    taken, written = compact_small(spark, path, target)
    if taken <= written:
        raise RuntimeError("compaction left as many small files as there were")
    return spark.read.parquet(path)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "player_features": q_player_features,
    "player_lifetime": q_player_lifetime,
    "draft_onehot": q_draft_onehot,
    "backlog_ids": q_backlog_ids,
    "backlog_batch": q_backlog_batch,
    "check_group_size": q_check_group_size,
    "check_uniqueness": q_check_uniqueness,
    "check_players": q_check_players,
    "check_details": q_check_details,
    "id_cursor": q_id_cursor,
    "epoch_to_string": q_epoch_to_string,
    "json_fixed_schema_scan": q_json_fixed_schema_scan,
    "json_land_roundtrip": q_json_land_roundtrip,
    "explode_players": q_explode_players,
    "bronze_players": q_bronze_players,
    "flatten_structs": q_flatten_structs,
    "ingest_new": q_ingest_new,
    "ingest_backfill": q_ingest_backfill,
    "append_evolving": q_append_evolving,
    "ledger_append": q_ledger_append,
    "full_load_once": q_full_load_once,
    "batch_upsert": q_batch_upsert,
    "stream_upsert": q_stream_upsert,
    "stream_bronze_players": q_stream_bronze_players,
    "compact_table": q_compact_table,
    "bronze_features": q_bronze_features,
    "bronze_draft": q_bronze_draft,
    "pending_matches": q_pending_matches,
    "ingest_modes": q_ingest_modes,
    "sql_views": q_sql_views,
    "text_features": q_text_features,
    "text_draft": q_text_draft,
    "sliding_features": q_sliding_features,
    "lifetime_now": q_lifetime_now,
    "backlog_top": q_backlog_top,
    "id_cursor_from_files": q_id_cursor_from_files,
    "pending_bucketed": q_pending_bucketed,
    "merge_bucketed": q_merge_bucketed,
    "check_load": q_check_load,
    "json_quarantine": q_json_quarantine,
    "compact_small": q_compact_small,
}

ORACLE: dict[str, str] = oracle.all_sql(
    ref=REF, split_date=SPLIT_DATE, event_split_ts=EVENT_SPLIT_TS, group_size=GROUP_SIZE, trial_ids=TRIAL_IDS
)
