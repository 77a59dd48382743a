"""Quality rules by distribution divergence (native).

Each document gets two histograms: character classes (lower-case and other
characters, upper-case letters, digits, sentence marks, symbols, white space,
bytes beyond ASCII) and common words (the function words below, and all other
words). Both are compared with the reference of the document's language -- the
sum of the histograms of all documents of that language that pass the base
rule -- by the Jensen-Shannon distance (base 2, between 0 and 1). A document fails if a
distance exceeds its threshold; a histogram of too few characters or words
says nothing and is not judged (minimum-length guards). A language whose
reference has too few words cannot speak for itself: its documents are compared
with the reference of all languages, and of the characters only those classes
count that mean the same in every script (digits, sentence marks, symbols, the rest).

Texts are read once: the counts go to a slim table in the shared folder, the
references are sums over it, one row for each language. Sums are
pre-aggregated per task, so a language with a third of all rows is no hot
key, and the join back is on a table of one row per language.

Base measures take words ``[^\\x20\\x09-\\x0D]+``: word_chars, n_symbols,
n_dup_lines, n_repeat_words. Windows of eight words are compared by a 64-bit
hash within their own text.

Defined cases: a null, empty or blank text has no words and fails the base
rule; a null language is a language of its own, and one of few or only failing rows has no reference of its own; repeated rows are judged each
for themselves; an empty table gives an empty table; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import whole_text, written

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: Guards: below these, a histogram is not judged.
MIN_CHARS_JUDGED = 200
MIN_WORDS_JUDGED = 80
#: Least words of a language's own reference.
MIN_REFERENCE_WORDS = 2000
#: Thresholds of the Jensen-Shannon distances.
MAX_CHAR_DISTANCE = 0.33
MAX_WORD_DISTANCE = 0.55
BLANKS = "[\\x20\\x09-\\x0D]+"

#: Common function words of four languages, one bin each.
COMMON_WORDS = {
    "en": "the of and to in a is that for it was on with as be by at this are from",
    "de": "der die und das in den von zu mit sich auf für ist im dem nicht ein eine als auch",
    "fr": "de la le et les des en un du une que est pour qui dans sur par au pas plus",
    "es": "de la que el en y a los se del las un por con una su para es al lo",
}
WORDS = list(dict.fromkeys(w for line in COMMON_WORDS.values() for w in line.split()))
#: One code per bin, so that counting a bin is counting a character.
CODES = [chr(0x4E00 + i) for i in range(len(WORDS))]
CHAR_CLASSES = ("other", "upper", "digit", "mark", "symbol", "blank", "beyond_ascii")


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANKS), "")


def with_repeated_words(d: DataFrame, hashes: str, out: str) -> DataFrame:
    """Number of words inside windows whose hash occurs at least twice.

    Sorted (hash, position) pairs bring equal windows together; the union of
    the repeated windows is the sum of the steps between them, each at most a
    window long. Most texts repeat nothing and skip all of it. Each array is
    a column of its own: inside a lambda it would be built for every element.
    """
    repeats = F.size(F.array_distinct(hashes)) < F.size(hashes)
    d = d.withColumn("_pairs", F.when(repeats, F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda p, k: F.get("_pairs", k)["h"] == p["h"]
    twice = F.filter(F.transform("_pairs", lambda p, k: F.when(same(p, k - 1) | same(p, k + 1), p["i"])), lambda i: i.isNotNull())
    d = d.withColumn("_starts", F.sort_array(twice))
    steps = F.transform("_starts", lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get("_starts", k + 1) - i, F.lit(WINDOW))))
    total = F.aggregate(steps, F.lit(0).cast("long"), lambda a, b: a + b)
    return d.withColumn(out, F.coalesce(total, F.lit(0).cast("long"))).drop("_pairs", "_starts")


def measured(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``df`` plus the base measures and the two histograms (text still there)."""
    text = whole_text(text_col)
    d = df.withColumn("_words", words_of(text))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    d = d.withColumn("_lines", lines).withColumn("_h", F.transform("_words", lambda w: F.xxhash64(w)))
    for step in (1, 2, 4):  # windows of 2, 4, 8 words; what runs over the end is cut off
        h = F.col("_h")
        d = d.withColumn("_h", F.when(F.size("_words") >= WINDOW, F.zip_with(
            F.slice(h, 1, F.size(h) - step), F.slice(h, step + 1, F.size(h)), lambda a, b: F.xxhash64(a, b)))
            .otherwise(F.array().cast("array<long>")))
    d = with_repeated_words(d, "_h", "n_repeat_words")
    chars = F.length(text).cast("long")
    d = d.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_upper": F.regexp_count(text, F.lit("\\p{Lu}")).cast("long"),
        "_digit": F.regexp_count(text, F.lit("[0-9]")).cast("long"),
        "_mark": F.regexp_count(text, F.lit("[.,;:!?'\"()\\-]")).cast("long"),
        "_beyond": (F.octet_length(text) - F.length(text)).cast("long"),
        "_chars": chars,
    })
    blank = F.col("_chars") - F.col("word_chars")
    rest = F.greatest(F.lit(0).cast("long"), F.col("word_chars") - F.col("_upper") - F.col("_digit") - F.col("_mark") - F.col("n_symbols"))
    code = F.from_json(F.lit("{" + ",".join(f'"{w}":"{c}"' for w, c in zip(WORDS, CODES)) + "}"), "map<string,string>")
    common = F.filter(F.transform("_words", lambda w: F.lower(w)), lambda w: w.isin(*WORDS))
    d = d.withColumn("_coded", F.array_join(F.transform(common, lambda w: code[w]), ""))
    count = lambda c: (F.length("_coded") - F.length(F.replace(F.col("_coded"), F.lit(c), F.lit("")))).cast("long")
    return d.withColumns({
        "_char_hist": F.array(rest, "_upper", "_digit", "_mark", "n_symbols", blank, "_beyond"),
        "_word_hist": F.array(*[count(c) for c in CODES], F.col("n_words") - F.length("_coded")),
    })


def shares(hist: Column, total: Column) -> Column:
    """A histogram as shares of its total (zeros if it is empty)."""
    return F.transform(hist, lambda x: F.when(total > 0, x / total).otherwise(0.0))


def with_total(d: DataFrame, hist: str, out: str) -> DataFrame:
    """Plus the sum of a histogram, as a column: in a lambda it would be
    summed for every element."""
    return d.withColumn(out, F.aggregate(hist, F.lit(0.0), lambda a, b: a + b))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two arrays of shares."""
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    terms = F.zip_with(p, q, lambda a, b: (part(a, (a + b) / 2) + part(b, (a + b) / 2)) / 2)
    return F.sqrt(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.aggregate(terms, F.lit(0.0), lambda s, x: s + x))))


def any_script(hist: Column) -> Column:
    """A character histogram with only those classes that every script shares."""
    zero = F.lit(0).cast("long")
    return F.array(hist[0] + hist[1] + hist[5], zero, hist[2], hist[3], hist[4], zero, zero)


def failed_base() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def references(slim: DataFrame) -> DataFrame:
    """One row per language: shares of the summed histograms of its rows that
    pass the base rule, or of all languages' if these have too few words."""
    zero = F.lit(0).cast("long")
    sizes = (("_char_hist", len(CHAR_CLASSES)), ("_word_hist", len(WORDS) + 1))
    sums = lambda cond: [
        F.array(*[F.coalesce(F.sum(F.when(cond, F.col(name)[i])), zero) for i in range(n)]).alias(f"{name}_ref") for name, n in sizes]
    # one row of fixed length comes to the driver
    whole = slim.agg(*sums(~failed_base())).first()
    everyone = [F.array(*[F.lit(x).cast("long") for x in whole[f"{name}_ref"]]) for name, _ in sizes]
    got = slim.groupBy("_lang").agg(*sums(~failed_base()))
    got = with_total(got, "_word_hist_ref", "_w").withColumn("_few", F.col("_w") < MIN_REFERENCE_WORDS)
    got = got.withColumns({
        "_char_hist_ref": F.when(F.col("_few"), any_script(everyone[0])).otherwise(F.col("_char_hist_ref")),
        "_word_hist_ref": F.when(F.col("_few"), everyone[1]).otherwise(F.col("_word_hist_ref")),
    })
    got = with_total(with_total(got, "_char_hist_ref", "_c"), "_word_hist_ref", "_w")
    return got.select(F.col("_lang").alias("_ref_lang"), "_few", shares(F.col("_char_hist_ref"), F.col("_c")).alias("_char_ref"),
                      shares(F.col("_word_hist_ref"), F.col("_w")).alias("_word_ref"))


def quality_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                   max_char: float = MAX_CHAR_DISTANCE, max_word: float = MAX_WORD_DISTANCE) -> DataFrame:
    """Per row: the base measures, both distances and the verdicts."""
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("_lang"))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    slim = written(measured(rows).select("doc_id", "_lang", *base, "_chars", "_char_hist", "_word_hist"), "quality")
    refs = references(slim)
    d = slim.join(refs, F.col("_lang").eqNullSafe(F.col("_ref_lang")))
    d = d.withColumn("_char_hist", F.when(F.col("_few"), any_script(F.col("_char_hist"))).otherwise(F.col("_char_hist")))
    d = with_total(with_total(d, "_char_hist", "_c"), "_word_hist", "_w")
    d = d.withColumns({"_char_share": shares(F.col("_char_hist"), F.col("_c")), "_word_share": shares(F.col("_word_hist"), F.col("_w"))})
    d = d.withColumns({
        "char_distance": js_distance(F.col("_char_share"), F.col("_char_ref")),
        "word_distance": js_distance(F.col("_word_share"), F.col("_word_ref")),
    })
    failed = failed_base()
    diverges = ((F.col("_chars") >= MIN_CHARS_JUDGED) & (F.col("char_distance") > max_char)) | (
        (F.col("n_words") >= MIN_WORDS_JUDGED) & (F.col("word_distance") > max_word))
    return d.select("doc_id", *base, failed.alias("base_failed"), (~failed & ~diverges).alias("kept"), "char_distance", "word_distance")
