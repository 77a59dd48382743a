import re

from llm_data import EDGE_TEXTS, SMALL, documents, empty
from tidepool.llm import licenses
from tidepool.llm.queries import QUERIES

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    ws = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places, labels = [], set()
    for t in licenses.BASE:
        p = t.text.split()
        places += [(i, t.label) for i in range(len(ws) - len(p) + 1) if ws[i : i + len(p)] == p]
    for t in (*licenses.BASE, *licenses.MORE):
        marks = licenses.places(t)
        if any(all(i + q >= 0 and ws[i + q : i + q + len(p)] == p for q, p in marks) for i in range(-30, len(ws))):
            labels.add(t.label)
    starts = [i for i, _ in places]
    return (len(ws), len(starts), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({x for _, x in places})), ",".join(sorted(labels)))


def check(spark, texts):
    got = {r["doc_id"]: r for r in licenses.license_report(documents(spark, texts)).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"]) == brute(t), t
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"])


def test_against_brute_force(spark):
    check(spark, EDGE_TEXTS + [
        "CC BY cc by-sa 4.0 CC BY", "by cc", "K license all rights reserved ALL  RIGHTS-RESERVED",  # a Kelvin sign
        "İ Licensed under the Apache License, Version 2.0. Released under the MIT License.", "apache license version 2",
        "License version 2 0 apache license version 2 0 cc", "GNU General Public License, version 3", "general public\nlicense",
        "all rights reserve", "all rights reserved" * 3, "license " * 3000, "cc by " * 2000,
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "Redistribution and use in source and binary forms, without modification, are permitted"])


def test_rare_words_do_not_change_labels(spark):
    # the same text among documents in which other words are rare
    text = "This work is licensed under the GNU General Public License, version 3. All rights reserved."
    alone = licenses.license_report(documents(spark, [text])).first()
    crowd = licenses.license_report(documents(spark, [text] + ["gnu general license version"] * 50)).filter("doc_id = 0").first()
    assert alone["labels"] == crowd["labels"] == "gpl,gpl-3.0,reserved"


def test_repeats_empty_table_and_clashing_columns(spark):
    twice = documents(spark, ["cc by"]).unionAll(documents(spark, ["cc by"]))
    assert [r["labels"] for r in licenses.license_report(twice).collect()] == ["cc-by", "cc-by"]
    assert licenses.license_report(empty(spark)).collect() == []
    odd = documents(spark, ["cc by"]).selectExpr("*", "1 AS _words", "2 AS matches", "3 AS n_words", "4 AS _row", "5 AS _text")
    row = licenses.scan(odd).first()
    assert row["n_words"] == 2 and row["_words"] == 1 and row["_row"] == 4 and row["matches"][0]["label"] == "cc-by"


def test_no_python_in_the_plan(spark):
    df = licenses.license_report(documents(spark, ["cc by"]))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString().replace("PythonRDD", "")


def test_query_covers_the_table(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in QUERIES["op1_licenses"](spark, SMALL).collect()}
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        assert (got[i]["n_words"], got[i]["n_base"], got[i]["first_word"], got[i]["last_word"], got[i]["base_labels"], got[i]["labels"]) == brute(t)
