"""Personal data in texts: patterns propose, checksums confirm, context adjusts.

Regular expressions propose the spans of each kind. A validator confirms them:
number ranges for addresses, the Luhn sum for card numbers, the remainder
modulo 97 for account numbers (IBAN), digit counts for phone numbers. A kind has
a score of its own; context words that stand close before or after the span (in the
text between it and the neighbouring matches, at most NEAR characters off) raise it. The base kinds (email, ip, card, phone) are reported whatever
their score. The method's own kinds are reported if the score reaches KEEP: an
IBAN is sure by its checksum, a short card number (Luhn, 13 to 15 digits), a
social security number and a passport number only next to a word that says so.

Everything is a row of built-in array expressions: no shuffle, no Python, a
task holds the texts of its own batch. A pattern is only tried on texts that hold a
character it cannot do without. The patterns start at the first character of
a run and use possessive quantifiers, so that they find the leftmost matches
without rescanning a run and without recursion on very long ones. Places come from the pieces
between matches; their running sums go over blocks of pieces, so that
a text of very many matches does not cost their square.

Defined cases: a null text is empty; empty texts, and texts without matches, have
zero counts, an empty list of spans, and the hash of the empty string; a match
that fails its validator is dropped and not tried again in parts;
spans of different kinds may overlap; repeated rows each get their own row; null ids stay;
other columns of any name do not matter; an empty table gives an empty table.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import rows_of, whole_text


class Kind(NamedTuple):
    """A kind of personal data: its pattern, the characters without which
    there is no match, its score, and the words near it that raise that."""

    name: str
    pattern: str
    needs: str
    score: float
    words: tuple[str, ...] = ()
    base: bool = False


#: Start of a run: where the last match ended, or not after a character of the run.
_FIRST = r"(?:\G|(?<!{0})){0}"
_MAIL = "[A-Za-z0-9._%+-]"

# The base patterns, and the method's own kinds.
KINDS = (
    Kind("email", _FIRST.format(_MAIL) + r"++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.9, ("mail", "contact"), True),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", "[0-9]\\.[0-9]", 0.6, ("ip", "address", "host", "server"), True),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", "[0-9][\\x20-]?[0-9]", 0.8, ("card", "visa", "credit", "payment"), True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "\\+[0-9]", 0.6, ("phone", "tel", "call", "mobile", "fax"), True),
    Kind("iban", r"(?<![A-Za-z0-9_])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9_])", "[A-Z]{2}[0-9]{2}", 0.8, ("iban", "account", "bank", "konto", "compte")),
    Kind("passport", r"(?<![A-Za-z0-9_])[A-Z]{1,2}[0-9]{6,8}(?![A-Za-z0-9_])", "[A-Z][0-9]", 0.3, ("passport", "reisepass", "passeport", "pasaporte")),
    Kind("shortcard", r"[0-9](?:[\x20-]?[0-9])++", "[0-9][\\x20-]?[0-9]", 0.3, ("card", "amex", "american express", "credit", "diners")),
    Kind("ssn", r"(?<![A-Za-z0-9_])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9_])", "[0-9]-[0-9]", 0.3, ("ssn", "social security")),
)
#: What a context word adds, how far (characters) it may stand off, and the least score.
CONTEXT, NEAR, KEEP = 0.4, 40, 0.6
#: Matches of a block at least.
BLOCK = 32
_SPANS = "array<struct<kind:string,at:bigint,to:bigint,score:double>>"


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn sum."""
    n = F.length(number)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(number, n - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def mod97(text: Column) -> Column:
    """Whether letters and digits, the first four moved to the end, leave 1
    modulo 97 (letters count as 10 to 35)."""
    turned = F.concat(F.substring(text, F.lit(5), F.length(text)), F.substring(text, 1, 4))

    def add(rest: Column, i: Column) -> Column:
        code = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(code >= 65, rest * 100 + (code - 55)).otherwise(rest * 10 + (code - 48)) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


def confirmed(kind: str, match: Column) -> Column:
    """The validator of a kind."""
    if kind == "ip":
        # a part of more than three digits after its leading zeros is over 255
        small = lambda p: F.length(F.regexp_replace(p, "^0+", "")) <= 3
        value = lambda p: F.substring(F.concat(F.lit("000"), p), -3, 3).cast("int") <= 255
        return F.forall(F.split(match, "\\."), lambda p: small(p) & value(p))
    n = F.length(digits(match))
    if kind == "card":
        return F.when(n.between(16, 19), luhn(digits(match))).otherwise(False)
    if kind == "shortcard":
        return F.when(n.between(13, 15), luhn(digits(match))).otherwise(False)
    if kind == "phone":
        return n.between(8, 15)
    if kind == "iban":
        return mod97(F.regexp_replace(match, "\x20", ""))
    return F.lit(True)


def proposed(text: Column, kind: Kind) -> Column:
    """The matches of a pattern, and the pieces of the text between them."""
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    may = text.contains(kind.needs) if len(kind.needs) == 1 else F.col("_digit") & text.rlike(kind.needs)
    return F.when(may, F.struct(found.alias("found"), F.split(text, kind.pattern, -1).alias("between")))


def lengths(hits: Column) -> Column:
    """Code points of each match and of the piece before it."""
    n = F.size(hits["found"])
    return F.when(n > 0, F.zip_with(F.slice(hits["between"], F.lit(1), n), hits["found"], lambda b, m: F.struct(
        F.length(b).cast("long").alias("gap"), F.length(m).cast("long").alias("size"))))


def total(steps: Column) -> Column:
    return F.aggregate(steps, F.lit(0).cast("long"), lambda x, s: x + s["gap"] + s["size"])


def width(steps: Column) -> Column:
    """Steps of a block: the root of their number, so that neither the blocks
    nor the steps of a block grow with a text's matches as their square."""
    return F.greatest(F.lit(BLOCK), F.ceil(F.sqrt(F.size(steps)))).cast("int")


def blocks_of(steps: Column) -> Column:
    """The steps in blocks."""
    w = width(steps)
    return F.when(F.size(steps) > 0, F.transform(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / w).cast("int")), lambda b: F.slice(steps, b * w + 1, w)))


def starts_of(sums: Column) -> Column:
    """The sum of all blocks before each block."""
    return F.transform(sums, lambda _, i: F.aggregate(F.slice(sums, F.lit(1), i), F.lit(0).cast("long"), lambda x, s: x + s))


def spans_of(kind: Kind, hits: Column, steps: Column, blocks: Column, starts: Column) -> Column:
    """The confirmed spans of a kind with their scores."""
    found, between, w = hits["found"], hits["between"], width(steps)
    good = F.filter(F.transform(found, lambda m, i: F.when(confirmed(kind.name, m), i)), lambda i: i.isNotNull())

    def placed(i: Column) -> Column:
        block = F.floor(i / w).cast("int")
        before = F.get(starts, block) + total(F.slice(F.get(blocks, block), F.lit(1), i % w))
        step = F.get(steps, i)
        near = F.lower(F.concat_ws(" ", F.right(F.get(between, i), F.lit(NEAR)), F.left(F.get(between, i + 1), F.lit(NEAR))))
        said = near.rlike("(?<![a-z])(?:" + "|".join(kind.words) + ")")
        return F.struct(F.lit(kind.name).alias("kind"), (before + step["gap"]).alias("at"), (before + step["gap"] + step["size"]).alias("to"),
                        F.least(F.lit(1.0), F.lit(kind.score) + F.when(said, F.lit(CONTEXT)).otherwise(F.lit(0.0))).alias("score"))

    out = F.transform(good, placed)
    if not kind.base:
        out = F.filter(out, lambda s: s["score"] >= KEEP)
    return F.coalesce(F.when(F.size(found) > 0, out), F.from_json(F.lit("[]"), _SPANS))


def with_spans(df: DataFrame, text_col: str = "text", kinds: tuple[Kind, ...] = KINDS, out: str = "pii") -> DataFrame:
    """``df`` plus the array of spans (kind, at, to, score) by kind as listed,
    then start; code points from 0, the end exclusive."""
    # every step is a column of its own: inside a lambda it would be made anew for each element
    at = rows_of(df, _text=whole_text(text_col)).withColumn("_digit", F.col("_text").rlike("[0-9]"))
    at = at.select("*", *[proposed(F.col("_text"), k).alias(f"_{k.name}") for k in kinds])
    at = at.select("*", *[lengths(F.col(f"_{k.name}")).alias(f"_{k.name}_steps") for k in kinds])
    at = at.select("*", *[blocks_of(F.col(f"_{k.name}_steps")).alias(f"_{k.name}_blocks") for k in kinds])
    at = at.select("*", *[F.transform(f"_{k.name}_blocks", total).alias(f"_{k.name}_sums") for k in kinds])
    at = at.select("*", *[starts_of(F.col(f"_{k.name}_sums")).alias(f"_{k.name}_starts") for k in kinds])
    spans = F.concat(*[spans_of(k, *[F.col(f"_{k.name}{x}") for x in ("", "_steps", "_blocks", "_starts")]) for k in kinds])
    kept = [F.col("_row")[c].alias(c) for c in df.columns if c.lower() != out.lower()]
    return at.select("_row", spans.alias("_spans")).select(*kept, F.col("_spans").alias(out))


def pii_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: counts of the base kinds, their digest, and all spans."""
    slim = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    found = with_spans(slim).drop("text")
    base = [k.name for k in KINDS if k.base]
    told = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["at"], s["to"])), ",")
    count = lambda k: F.size(F.filter("pii", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(
        "doc_id", *[count(k) for k in base], F.sha2(told(F.filter("pii", lambda s: s["kind"].isin(*base))), 256).alias("base_sha256"),
        told(F.col("pii")).alias("spans"), F.coalesce(F.array_max(F.transform("pii", lambda s: s["score"])), F.lit(0.0)).alias("score"))
