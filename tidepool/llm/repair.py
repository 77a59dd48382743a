"""Repair of conversation structure by dynamic programming over runs of rows.

A conversation is legal if its role initials read ``(s?(ua)+)?``. Rows may be
kept, given another role, deleted, or inserted, each at its price; the operator
finds the cheapest edits, of these the ASCII-least list of their initials.

Each row is a symbol: its role's initial and whether it is cut off, or that it
must go (blank or duplicate). Equal consecutive symbols are one run. A symbol
is a min-plus matrix over the four places in the pattern (nothing yet, after s,
after u, after a); a run of n rows advances the costs through the binary powers
of its matrix, which are kept, and the choices are unrolled from the costs that
are left, by halves, each kept too.

Scale and skew. Rows are merged with their exact copies before they are
shuffled, then dealt out by ranges of (conversation, turn, role, text digest),
so that a conversation of any size is spread over many tasks; the first
appearance of each (role, text) travels as a marker row that sorts right before
it. A conversation that lies inside one partition is finished there. The first
and last one of each partition, and any of more than CHUNK_ROWS rows or CHUNK_CHARS characters, go on as
chunks: their runs (not their texts) meet in one group, since the edits of a
conversation are one string of one result row; chunks are repaired where they
lie; the repaired rows are hashed in order, a chunk at a time (SHA-256 of a
string is a chain, so one conversation's chunks pass through one task, which
holds one of them). Every step is a written table in the shared folder.

Defined cases: a null role or text is one space; a null id is a conversation of
its own; null turns come first; rows of one turn are taken by role, then by the SHA-256
of the text; a role whose initial is none of s, u, a can only be given
another role or go; an empty text is blank; a conversation without rows has
zeros, no edits and the hash of the empty string; columns other than the four
named do not matter; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.llm.common import written

#: Prices of the edits; CUT is added for a row that is cut off and stays.
DELETE, INSERT, REROLE, CUT = 3, 2, 2, 1
#: Rows, and characters of texts, after which a conversation goes on in another chunk.
CHUNK_ROWS, CHUNK_CHARS = 4096, 16_000

FAR = 1 << 60
#: Places in the pattern: 0 nothing yet, 1 after s, 2 after u, 3 after a.
PLACES = range(4)
#: The place after an inserted or re-roled row, and that row's role.
NEXT, ROLE = (2, 2, 3, 2), ("user", "user", "assistant", "user")
#: Where a kept row leads: (place, initial) -> place.
KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
LEGAL = {"su", "ua", "au"}
GONE = "-"
BLANKS = "[^\\x20\\x09-\\x0D]"


def symbol(role: str, cut: bool) -> str:
    """One character: the role's initial ('o' if the pattern has none such), in
    capitals if the row is cut off."""
    first = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return first.upper() if cut else first


def choices(sym: str, place: int) -> list[tuple[str, int, int]]:
    """(initial, price, next place) of what a row allows, ASCII-least first."""
    out = [("D", DELETE, place)]
    if sym != GONE:
        extra = CUT if sym.isupper() else 0
        if (place, sym.lower()) in KEPT:
            out.append(("K", extra, KEPT[place, sym.lower()]))
        out.append(("R", REROLE + extra, NEXT[place]))
    return out


def times(a: tuple, b: tuple) -> tuple:
    """Min-plus product of two matrices (tuples of rows)."""
    return tuple(tuple(min(min(a[i][k] + b[k][j] for k in PLACES), FAR) for j in PLACES) for i in PLACES)


def advance(m: tuple, after: tuple) -> tuple:
    """Costs before what ``m`` stands for, from the costs after it."""
    return tuple(min(min(m[i][k] + after[k] for k in PLACES), FAR) for i in PLACES)


def _inserts() -> tuple:
    """Cheapest inserts from each place to each other."""
    one = tuple(tuple(0 if i == j else INSERT if NEXT[i] == j else FAR for j in PLACES) for i in PLACES)
    return times(times(one, one), one)


INSERTS = _inserts()
#: Costs at the end: inserts up to a place where the pattern may end.
END = advance(INSERTS, (0, FAR, FAR, 0))


@lru_cache(maxsize=None)
def power(sym: str, bit: int) -> tuple:
    """The matrix of 2**bit rows of a symbol, inserts before each included."""
    if bit:
        return times(power(sym, bit - 1), power(sym, bit - 1))
    row = [[FAR] * 4 for _ in PLACES]
    for i in PLACES:
        for _, price, j in choices(sym, i):
            row[i][j] = min(row[i][j], price)
    return times(INSERTS, tuple(map(tuple, row)))


def before_run(sym: str, n: int, after: tuple) -> tuple:
    """Costs before a run of n rows."""
    bit = 0
    while n:
        if n & 1:
            after = advance(power(sym, bit), after)
        n, bit = n >> 1, bit + 1
    return after


def level(costs: tuple) -> tuple:
    """Costs less their minimum: choices depend on differences only."""
    low = min(costs)
    return tuple(c if c >= FAR else c - low for c in costs)


@lru_cache(maxsize=1 << 16)
def one_row(sym: str, place: int, after: tuple) -> tuple[str, int]:
    """The edits of one row (and inserts before it), and the place after."""
    here, out = advance(power(sym, 0), after), ""
    while True:
        left = here[place]
        delete, *rest = choices(sym, place)
        if delete[1] + after[delete[2]] == left:
            return out + "D", place
        if INSERT + here[NEXT[place]] == left:
            out, place = out + "I", NEXT[place]
            continue
        for initial, price, to in rest:
            if price + after[to] == left:
                return out + initial, to
        raise AssertionError("no choice has the least cost")


def _unroll(sym: str, n: int, place: int, after: tuple) -> tuple[str, int]:
    if n == 1:
        return one_row(sym, place, after)
    half = n // 2
    unroll = kept_unroll if n <= CHUNK_ROWS else _unroll
    first, place = unroll(sym, half, place, level(before_run(sym, n - half, after)))
    second, place = unroll(sym, n - half, place, after)
    return first + second, place


kept_unroll = lru_cache(maxsize=1 << 12)(_unroll)


def ending(place: int) -> str:
    """Inserts after the last row."""
    out = ""
    while END[place]:
        out, place = out + "I", NEXT[place]
    return out


def solve(runs: list[tuple[str, int]]) -> tuple[int, list[tuple[str, int]]]:
    """The least cost of a conversation, and for each of its runs (symbol,
    rows) the edits and the place before it; the last entry is the end."""
    after = [END]
    for sym, n in reversed(runs):
        after.append(before_run(sym, n, after[-1]))
    cost, place, out = after[-1][0], 0, []
    for (sym, n), left in zip(runs, after[-2::-1]):
        edits, to = _unroll(sym, n, place, level(left))
        out.append((edits, place))
        place = to
    return cost, [*out, (ending(place), place)]


def repaired(edits: str, place: int, rows: Iterator[tuple[str, str]]) -> list[str]:
    """The lines ``role:text`` that the edits leave; ``rows`` has the rows that
    need not go, in order (the edits of the others are left out of ``edits``)."""
    out = []
    for e in edits:
        if e == "I":
            out.append(ROLE[place] + ":")
            place = NEXT[place]
            continue
        role, text = next(rows)
        if e == "K":
            out.append(f"{role}:{text}")
            place = KEPT[place, role[0]]
        elif e == "R":
            out.append(f"{ROLE[place]}:{text}")
            place = NEXT[place]
    return out


def kept_edits(edits: str, runs: list[tuple[str, int]]) -> str:
    """``edits`` without those of rows that must go."""
    if all(sym != GONE for sym, _ in runs):
        return edits
    out, at = [], 0
    for sym, n in runs:
        while n:
            if edits[at] != "I":
                n -= 1
            if edits[at] == "I" or sym != GONE:
                out.append(edits[at])
            at += 1
    return "".join(out) + edits[at:]


class Part:
    """Rows of a conversation that follow each other: a chunk, or all of it."""

    def __init__(self):
        self.runs: list[list] = []
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.size = 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.first = self.last = None

    def add(self, turn, role: str, text: str, copies: int, is_first: bool, blank: bool, cut: bool) -> None:
        if self.first is None:
            self.first = role[:1]
        elif self.last + role[:1] not in LEGAL:
            self.illegal += 1
        self.illegal += copies - 1
        self.last = role[:1]
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.high
            self.high = turn
        good = 0
        if blank:
            self.blank += copies
        else:
            good = 1 if is_first else 0
            self.duplicate += copies - good
            self.truncated += good * cut
        if good:
            self.run(symbol(role, cut), 1)
            self.roles.append(role)
            self.texts.append(text)
            self.size += len(text)
        if copies > good:
            self.run(GONE, copies - good)

    def run(self, sym: str, n: int) -> None:
        if self.runs and self.runs[-1][0] == sym:
            self.runs[-1][1] += n
        else:
            self.runs.append([sym, n])

    def full(self) -> bool:
        return len(self.runs) >= CHUNK_ROWS or self.size >= CHUNK_CHARS or len(self.texts) >= CHUNK_ROWS

    def finished(self) -> dict:
        """The result of a conversation that this part holds whole."""
        runs = [(s, n) for s, n in self.runs]
        cost, found = solve(runs)
        edits = "".join(e for e, _ in found)
        lines = repaired(kept_edits(edits, runs), 0, zip(self.roles, self.texts))
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return {"gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated,
                "illegal": self.illegal, "cost": cost, "audit": edits, "lines": "\n".join(lines)}

    def chunk(self) -> dict:
        return {"symbols": "".join(s for s, _ in self.runs), "rows": [n for _, n in self.runs], "roles": self.roles, "texts": self.texts,
                "c_blank": self.blank, "c_duplicate": self.duplicate, "c_truncated": self.truncated, "c_illegal": self.illegal,
                "turns": self.turns, "low": self.low, "high": self.high, "first": self.first, "last": self.last}


_LONG, _TEXT = T.LongType(), T.StringType()
STATS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_RESULT = [*[T.StructField(n, _LONG) for n in STATS], T.StructField("audit", _TEXT), T.StructField("repaired_sha256", _TEXT)]
_CHUNK = [T.StructField("symbols", _TEXT), T.StructField("rows", T.ArrayType(_LONG)), T.StructField("roles", T.ArrayType(_TEXT)),
          T.StructField("texts", T.ArrayType(_TEXT)), *[T.StructField(n, _LONG) for n in ("c_blank", "c_duplicate", "c_truncated", "c_illegal", "turns", "low", "high")],
          T.StructField("first", _TEXT), T.StructField("last", _TEXT)]


def _worked(schema: T.StructType):
    """The pass over sorted partitions: finished conversations and chunks."""
    names = schema.names

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None
        number = TaskContext.get().partitionId()
        out: list[dict] = []
        state = {"id": None, "part": None, "chunks": 0, "first": True, "n": 0}

        def close(last: bool) -> None:
            part = state["part"]
            if part is None:
                return
            head = {"conv_id": state["id"], "part": number}
            if state["chunks"] or state["first"] or last:
                out.append({**head, "chunk": state["n"], **part.chunk()})
                state["n"] += 1
            else:
                done = part.finished()
                done["repaired_sha256"] = hashlib.sha256(done.pop("lines").encode()).hexdigest()
                out.append({**head, **done})
            state["first"] = False

        def ready() -> pa.RecordBatch:
            arrays = [pa.array([r.get(n) for r in out], kind.field(n).type) for n in names]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, names)

        marked = False
        for batch in batches:
            if kind is None:
                kind = pa.schema([("conv_id", batch.schema.field("conv_id").type), ("part", pa.int32()), ("chunk", pa.int32()), *[
                    (f.name, {_TEXT: pa.string(), _LONG: pa.int64()}.get(f.dataType) or pa.list_(pa.string() if f.dataType.elementType == _TEXT else pa.int64()))
                    for f in schema.fields[3:]]])
            cols = [batch.column(n).to_pylist() for n in ("conv_id", "turn", "role", "text", "copies", "marker", "blank", "cut")]
            for conv, turn, role, text, copies, marker, blank, cut in zip(*cols):
                if state["part"] is None or conv != state["id"]:
                    close(last=False)
                    state.update(id=conv, part=Part(), chunks=0)
                if marker:
                    marked = True
                    continue
                part = state["part"]
                if copies:
                    if part.full():
                        out.append({"conv_id": conv, "part": number, "chunk": state["n"], **part.chunk()})
                        state["part"] = part = Part()
                        state["n"] += 1
                        state["chunks"] += 1
                    part.add(turn, role, text, copies, marked, blank, cut)
                marked = False
            if out:
                yield ready()
        close(last=True)
        if out:
            yield ready()

    return work


def _joined(group: pd.DataFrame) -> pd.DataFrame:
    """The chunks of one conversation, without texts: its counts and cost, and
    the edits of each chunk with the place before it."""
    group = group.sort_values(["part", "chunk"])
    runs, cuts = [], [0]
    for symbols, rows in zip(group["symbols"], group["rows"]):
        runs += list(zip(symbols, map(int, rows)))
        cuts.append(len(runs))
    cost, found = solve(runs)
    illegal, turns, last, high, low = int(group["c_illegal"].sum()), 0, None, None, None
    for first, end, lo, hi, n in zip(group["first"], group["last"], group["low"], group["high"], group["turns"]):
        if not pd.isna(first):
            if last is not None and last + first not in LEGAL:
                illegal += 1
            last = end
        if not pd.isna(lo):
            turns += int(n) - (high is not None and int(lo) == high)
            low = int(lo) if low is None else low
            high = int(hi)
    stats = {"gaps": 0 if low is None else high - low + 1 - turns, "blank": int(group["c_blank"].sum()), "duplicate": int(group["c_duplicate"].sum()),
             "truncated": int(group["c_truncated"].sum()), "illegal": illegal, "cost": cost}
    out = group[["part", "chunk"]].copy()
    out["edits"] = ["".join(e for e, _ in found[a:b]) for a, b in zip(cuts, cuts[1:])]
    out["place"] = [found[a][1] for a in cuts[:-1]]
    out["ending"] = ""
    out.iloc[-1, out.columns.get_loc("ending")] = found[-1][0]
    out["is_last"] = [False] * (len(out) - 1) + [True]
    return out.assign(**stats)


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks in order of conversation and place: their edits joined, their
    repaired lines hashed one after the other."""
    key, digest, any_line, edits = None, hashlib.sha256(), False, []
    for batch in batches:
        names = ["conv_id", *STATS, "audit", "repaired_sha256"]
        out: list[list] = [[] for _ in names]
        for i in range(batch.num_rows):
            # one chunk's texts at a time
            row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
            if key is None:
                key, digest, any_line, edits = row["conv_id"], hashlib.sha256(), False, []
            runs = list(zip(row["symbols"], row["rows"]))
            whole = row["edits"] + row["ending"]
            lines = repaired(kept_edits(row["edits"], runs) + row["ending"], row["place"], zip(row["roles"], row["texts"]))
            if lines:
                digest.update((("\n" if any_line else "") + "\n".join(lines)).encode())
                any_line = True
            edits.append(whole)
            if row["is_last"]:
                for column, value in zip(out, [row["conv_id"], *[row[n] for n in STATS], "".join(edits), digest.hexdigest()]):
                    column.append(value)
                key, digest, any_line, edits = None, hashlib.sha256(), False, []
        kinds = [batch.schema.field("conv_id").type, *[pa.int64()] * len(STATS), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)


def repair(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", copies_col: str | None = None) -> DataFrame:
    """One row per conversation: its faults, the cheapest edits, and the hash of
    the repaired rows. ``copies_col``: how often a row stands there (0: its
    conversation is listed, the row is not)."""
    copies = F.lit(1) if copies_col is None else F.col(f"`{copies_col}`")
    rows = df.select(F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"), F.coalesce(F.col(f"`{role_col}`"), F.lit(" ")).alias("role"),
                     F.coalesce(F.col(f"`{text_col}`"), F.lit(" ")).alias("text"), copies.cast("long").alias("copies"))
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    rows = written(rows.withColumn("digest", F.unhex(F.sha2("text", 256))), "turns")
    early = F.min(F.struct(F.col("turn").isNotNull().alias("is_set"), F.col("turn").alias("turn")))
    firsts = rows.where(F.col("copies") > 0).groupBy("conv_id", "role", "digest").agg(early.alias("at"))
    firsts = firsts.select("conv_id", F.col("at.turn").alias("turn"), "role", F.lit("").alias("text"), F.lit(0).cast("long").alias("copies"), "digest", F.lit(True).alias("marker"))
    both = rows.withColumn("marker", F.lit(False)).unionByName(firsts)
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    dealt = both.repartitionByRange(*order).sortWithinPartitions(*order, F.col("marker").desc())
    dealt = dealt.select("conv_id", "turn", "role", "text", "copies", "marker", (~F.col("text").rlike(BLANKS)).alias("blank"),
                         (~F.col("text").rlike("[.!?][\\x20\\x09-\\x0D]*\\z")).alias("cut"))
    id_field = T.StructField("conv_id", df.schema[conv_col].dataType)
    schema = T.StructType([id_field, T.StructField("part", T.IntegerType()), T.StructField("chunk", T.IntegerType()), *_RESULT, *_CHUNK])
    worked = written(dealt.mapInArrow(_worked(schema), schema), "repaired")
    done = worked.where(F.col("chunk").isNull()).select("conv_id", *[f.name for f in _RESULT])

    chunks = worked.where(F.col("chunk").isNotNull()).drop(*[f.name for f in _RESULT])
    edited = T.StructType([*schema.fields[1:3], T.StructField("edits", _TEXT), T.StructField("place", T.IntegerType()), T.StructField("ending", _TEXT),
                           T.StructField("is_last", T.BooleanType()), *[T.StructField(n, _LONG) for n in STATS]])
    # as text: a column of numbers and nulls would lose digits on the way
    slim = chunks.drop("roles", "texts").withColumns({c: F.col(c).cast("string") for c in ("low", "high")})
    edits = slim.groupBy("conv_id").applyInPandas(_joined, edited)
    placed = chunks.select("conv_id", "part", "chunk", "symbols", "rows", "roles", "texts").join(edits, ["part", "chunk"])
    chain = placed.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "part", "chunk")
    return done.unionByName(chain.mapInArrow(_chained, T.StructType([id_field, *_RESULT])))


def damaged(df: DataFrame) -> DataFrame:
    """The rows of ``conversations`` with the faults that their key calls for;
    ``_copies`` is 0 for a row that is dropped, 2 for one that is repeated."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    case = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    text, role = said("text"), said("role")
    return df.select(
        "conv_id", "turn", F.when(case == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(case <= 1, F.lit("")).when(case == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(case == 0, 0).when(case == 3, 2).otherwise(1).alias("_copies"))


def repair_report(df: DataFrame) -> DataFrame:
    """Per original conversation: faults after the damage, edits and hash."""
    return repair(damaged(df), copies_col="_copies")
