"""Licence scan by a positional rare-token index (native).

Licence templates are short word sequences with mandatory key phrases at
fixed relative positions. Of each template's mandatory words, the ANCHORS
with the highest IDF over the documents form the index: word -> postings
(template, position in the template). A document's occurrences of index words
are looked up; an occurrence at i of a word with posting (t, q) votes for
template t to start at i - q. A start counts if every posting of t agrees
with it (the postings intersect by relative position) and all mandatory
phrases stand at their places. The whole scan of a document is one row of
array expressions: no shuffle, no join, no Python.

Which words are rare only decides how much is looked up: every mandatory word
is verified in any case, so the labels do not depend on the IDF.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased,
counted from 0. Defined cases: null, empty or wordless texts give 0 words, no
label, null places and score 0; repeated rows are scanned each for
themselves; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import json
import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import rows_of, whole_text

#: Index words of each template.
ANCHORS = 2
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Template(NamedTuple):
    label: str
    text: str
    #: mandatory phrases of the text; empty: the whole text
    phrases: tuple[str, ...] = ()


#: Phrases whose places are counted.
BASE = (
    Template("cc-by", "cc by"),
    Template("gpl", "general public license"),
    Template("reserved", "all rights reserved"),
)

#: Further licences; what stands outside the mandatory phrases only raises the score.
MORE = (
    Template("agpl", "gnu affero general public license"),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template("apache-2.0", "apache license version 2 0 january 2004", ("apache license version 2 0",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             ("redistribution and use in source and binary forms", "are permitted")),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-nd", "licensed under cc by nd 4 0", ("cc by nd",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc-by", "creative commons attribution 4 0 international license", ("creative commons attribution",)),
    Template("cc0", "cc0 1 0 universal", ("cc0 1 0",)),
    Template("epl", "eclipse public license"),
    Template("gpl-2.0", "gnu general public license version 2", ("gnu general public license version 2",)),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose",
             ("permission to use copy modify and", "distribute this software for any purpose")),
    Template("lgpl", "gnu lesser general public license"),
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
             ("permission is hereby granted free of charge", "to any person obtaining a copy")),
    Template("mpl-2.0", "mozilla public license version 2 0", ("mozilla public license",)),
    Template("proprietary", "proprietary and confidential"),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             ("free and unencumbered software", "public domain")),
)


def places(template: Template) -> list[tuple[int, list[str]]]:
    """The mandatory phrases with their positions in the template."""
    words, out = template.text.split(), []
    for phrase in template.phrases or (template.text,):
        p = phrase.split()
        out.append((next(q for q in range(len(words)) if words[q : q + len(p)] == p), p))
    return out


def lower_words(text: Column) -> Column:
    """Words of the text under full lower-casing.

    Lower-casing never turns a word character into a separator or back, so
    number and places of the words are right; a few non-ASCII characters may
    become ASCII, so a match here still needs the exact words.
    """
    return F.array_remove(F.split(F.lower(text), SEPARATORS), "")


def exact_words(text: Column) -> Column:
    """Words of the text with A-Z, and only those, lower-cased."""
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), SEPARATORS), "")


def inverse_frequencies(df: DataFrame, vocabulary: list[str], text_col: str = "text") -> dict[str, float]:
    """IDF of the vocabulary's words over all rows; what reaches the driver is
    one count for each word of the templates."""
    found = F.array_distinct(F.filter(lower_words(whole_text(text_col)), lambda w: w.isin(*vocabulary)))
    counts = df.select(F.explode(F.concat(found, F.array(F.lit("")))).alias("w")).groupBy("w").count()
    df_of = {r["w"]: r["count"] for r in counts.collect()}
    rows = df_of.get("", 0)
    return {w: math.log((rows + 1) / (df_of.get(w, 0) + 1)) + 1 for w in vocabulary}


def _literal(value, ddl: str) -> Column:
    return F.from_json(F.lit(json.dumps(value)), ddl)


def scan(df: DataFrame, text_col: str = "text", base: tuple[Template, ...] = BASE, more: tuple[Template, ...] = MORE) -> DataFrame:
    """``df`` plus n_words, matches (template number, label, base, first word,
    weight matched) and the words' places of every verified match."""
    templates = [*base, *more]
    marks = [places(t) for t in templates]
    idf = inverse_frequencies(df, sorted({w for t in templates for w in t.text.split()}), text_col)

    index: dict[str, list[dict]] = {}
    rows = []
    for t, (template, mark) in enumerate(zip(templates, marks)):
        words = template.text.split()
        must = sorted({(q + k, w) for q, p in mark for k, w in enumerate(p)}, key=lambda x: (-idf[x[1]], x[0]))
        for q, w in must[:ANCHORS]:
            index.setdefault(w, []).append({"t": t, "q": q})
        need = sum(idf[w] for w in words)
        rows.append({
            "label": template.label, "base": t < len(base), "total": need,
            "first": min(q for q, _ in mark), "last": max(q + len(p) for q, p in mark),
            "rare": [{"q": q, "w": w} for q, w in must[:ANCHORS]],
            "phrases": [{"q": q, "w": p} for q, p in mark],
            "words": [{"q": q, "w": w, "idf": idf[w]} for q, w in enumerate(words)],
        })
    postings = F.from_json(F.lit(json.dumps(index)), "map<string,array<struct<t:bigint,q:bigint>>>")
    table = _literal(rows, "array<struct<label:string,base:boolean,total:double,first:int,last:int,rare:array<struct<q:int,w:string>>,"
                           "phrases:array<struct<q:int,w:array<string>>>,words:array<struct<q:int,w:string,idf:double>>>>")
    rare = sorted(index)

    text = F.col("_text")
    seen = rows_of(df, _text=whole_text(text_col)).withColumn("_lower", lower_words(text))
    seen = seen.withColumn("n_words", F.size("_lower").cast("long")).withColumn(
        "_words", F.when(F.exists("_lower", lambda w: w.isin(*rare)), exact_words(text)))

    def votes(w: Column, i: Column) -> Column:
        # template and start in one long: a start can be as low as minus the template's length
        return F.transform(postings[w], lambda p: p["t"] * F.lit(1 << 32) + (i.cast("long") - p["q"] + F.lit(1 << 20)))

    hits = F.filter(F.transform("_words", lambda w, i: F.when(w.isin(*rare), F.struct(w.alias("w"), i.alias("i")))), lambda h: h.isNotNull())
    codes = F.array_distinct(F.flatten(F.transform(hits, lambda h: votes(h["w"], h["i"]))))

    def start_of(code: Column) -> Column:
        return F.struct(F.shiftright(code, 32).cast("int").alias("t"),
                        (code.bitwiseAND(F.lit((1 << 32) - 1)) - F.lit(1 << 20)).cast("int").alias("s"))

    words = F.col("_words")
    at = lambda k: F.when(k >= 0, F.get(words, k))

    def verified(x: Column) -> Column:
        t, s = table[x["t"]], x["s"]
        inside = (s + t["first"] >= 0) & (s + t["last"] <= F.size(words))
        agree = F.forall(t["rare"], lambda r: at(s + r["q"]) == r["w"])
        said = F.forall(t["phrases"], lambda p: F.slice(words, s + p["q"] + 1, F.size(p["w"])) == p["w"])
        return F.when(inside, F.when(F.coalesce(agree, F.lit(False)), said).otherwise(False)).otherwise(False)

    def told(x: Column) -> Column:
        t, s = table[x["t"]], x["s"]
        weight = F.aggregate(t["words"], F.lit(0.0), lambda a, w: a + F.when(at(s + w["q"]) == w["w"], w["idf"]).otherwise(0.0))
        return F.struct(t["label"].alias("label"), t["base"].alias("base"), (s + t["first"]).cast("long").alias("word"),
                        F.least(F.lit(1.0), weight / t["total"]).alias("score"))

    found = seen.withColumn("_starts", F.transform(codes, start_of)).withColumn(
        "matches", F.coalesce(F.transform(F.filter("_starts", verified), told), F.array().cast("array<struct<label:string,base:boolean,word:bigint,score:double>>")))
    kept = [F.col("_row")[c].alias(c) for c in df.columns if c.lower() not in ("n_words", "matches")]
    return found.select(*kept, "n_words", "matches")


def license_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: words, places of base phrases, and the labels found."""
    m = scan(df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text").drop("text")
    based = F.filter("matches", lambda x: x["base"])
    m = m.withColumn("_places", F.transform(based, lambda x: x["word"]))
    names = lambda a: F.array_join(F.array_sort(F.array_distinct(F.transform(a, lambda x: x["label"]))), ",")
    return m.select(
        "doc_id", "n_words", F.size("_places").cast("long").alias("n_base"), F.array_min("_places").alias("first_word"),
        F.array_max("_places").alias("last_word"), names(based).alias("base_labels"), names(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda x: x["score"])), F.lit(0.0)).alias("score"))
