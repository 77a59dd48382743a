import __spark_entry__ as entry


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "qt_matches" in df.columns and len(df.columns) == 28


def test_every_query_has_oracle_or_is_listed(spark):
    qs, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(qs) >= 23


def test_entry_without_the_optional_part():
    """Without the training-data operators every other query still registers."""
    import os
    import subprocess
    import sys

    code = ("import sys; sys.modules['tidepool.llm'] = None; import __spark_entry__ as e; "
            "names = set(e.queries()); assert 'player_features' in names and 'pipeline' not in names and set(e.oracle_sql()) <= names")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
