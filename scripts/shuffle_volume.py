"""Measure shuffle bytes/records of our plans against Spark's plan of the SQL
form, from Spark's event log (no UI, no server).

    python scripts/shuffle_volume.py [--sf-dir DIR]

Runs, in one session with the event log written to a fresh scratch folder:
the feature table (ours vs the DISTINCT SQL) and the one-hot matrix (ours vs
conditional MAX), each into the ``noop`` sink, then sums the shuffle write
metrics of every task per job group.
"""

from __future__ import annotations

import argparse
import glob
import io
import json
import os
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

def read_events(folder: str):
    import zstandard

    for path in sorted(glob.glob(os.path.join(folder, "*", "events_*")) + glob.glob(os.path.join(folder, "*.*"))):
        if os.path.isdir(path):
            continue
        with open(path, "rb") as fh:
            stream = zstandard.ZstdDecompressor().stream_reader(fh) if path.endswith(".zstd") else fh
            for line in io.TextIOWrapper(stream, encoding="utf-8"):
                yield json.loads(line)


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    args = ap.parse_args()
    folder = tempfile.mkdtemp(prefix="tidepool-eventlog-")

    from pyspark.sql import SparkSession

    from tidepool.plans import oracle
    from tidepool.plans.features import entity_features
    from tidepool.plans.onehot import draft_onehot
    from tidepool.plans.standin import player_rows
    from tidepool.session import configure

    spark = (
        SparkSession.builder.master("local[8]").appName("tidepool-shuffle")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", folder)
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    pm = player_rows(spark, args.sf_dir)
    pm.createOrReplaceTempView("pm_shuffle")
    # the checked SQL, with DuckDB's date difference said in Spark's words
    features_sql = oracle.player_features_sql(table="SELECT * FROM pm_shuffle").replace("date_diff('day',", "date_diff(DAY,")
    onehot_sql = oracle.draft_onehot_sql()
    onehot_sql = onehot_sql[onehot_sql.index("SELECT\n  match_id"):].replace("FROM pm", "FROM pm_shuffle").replace(
        "CAST(TIMESTAMP '2001-08-01 00:00:00' - INTERVAL 6 MONTH AS DATE)", "add_months(DATE '2001-08-01', -6)")
    runs = {
        "features_sql_distinct": lambda: spark.sql(features_sql),
        "features_tidepool": lambda: entity_features(pm, ref="2001-08-01 00:00:00"),
        "onehot_sql_condmax": lambda: spark.sql(onehot_sql),
        "onehot_tidepool": lambda: draft_onehot(pm, side="is_side_a", outcome="side_a_win", ref="2001-08-01 00:00:00"),
    }
    for name, build in runs.items():
        spark.sparkContext.setJobGroup(name, name)
        build().write.format("noop").mode("overwrite").save()
    spark.stop()

    stage_group, volume = {}, {}
    for e in read_events(folder):
        if e["Event"] == "SparkListenerJobStart":
            group = (e.get("Properties") or {}).get("spark.jobGroup.id")
            for sid in e["Stage IDs"]:
                stage_group[sid] = group
        elif e["Event"] == "SparkListenerTaskEnd":
            w = ((e.get("Task Metrics") or {}).get("Shuffle Write Metrics")) or {}
            group = stage_group.get(e["Stage ID"])
            b, r = volume.get(group, (0, 0))
            volume[group] = (b + w.get("Shuffle Bytes Written", 0), r + w.get("Shuffle Records Written", 0))
    print(json.dumps({k: {"shuffle_mb": round(b / 1e6, 3), "records": r}
                      for k, (b, r) in volume.items() if k in runs}))


if __name__ == "__main__":
    main()
