"""Near-duplicate documents by b-bit MinHash.

A document's set holds the 64-bit hashes of its distinct shingles of SHINGLE
words. MINIMA minimum hashes of the set serve twice: groups of ROWS full
minima make the BANDS bands that bring candidates together, and the lowest
BITS bits of each minimum, packed, make the signature that estimates a pair's
similarity by counting equal lanes, corrected for chance collisions. Pairs
whose estimate could still mean a link are confirmed on the full sets.

Documents are linked if 100 * |A and B| >= percent * |A or B|; the result is
the connected component of each document. ``percent`` is PERCENT unless the
caller names another one. At the limit of 0.85 a pair shares no band with a
chance of 8e-7, at 0.80 with 7e-5; it falls below the estimate's margin (four
standard deviations at the limit) with 3e-5.

Scale and skew. Equal sets become one class before anything is compared, so
exact copies cost one row each. Bands are worked off in ROUNDS; after each
round the components found so far are merged, and later rounds look only at
buckets that still hold different components. A bucket of more than one block
first compares all its rows with about PIVOTS of them, and the components found
are merged: a large group of near copies is one component by then. Inside a bucket, the members
outside its largest component are then compared with all members, in blocks of
at most about BLOCK_ROWS rows or BLOCK_SHINGLES shingles a side: no group meets in one task, no pairs are emitted but a
spanning forest of confirmed links, and nothing is capped. A bucket of unlike rows (same band, no link) still
costs the square of its rows in blocks. Components are
labelled by joins with pointer jumping; every step is a written table in the
shared checkpoint folder, so a lost executor costs its own tasks. The driver
sees counts only.

Defined cases: words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; null, empty and
wordless texts have an empty set and are linked with nothing; a text of fewer
than SHINGLE words is one shingle; rows that share an id are one document,
linked with all that any of their texts is linked with; rows with a null id
are linked with nothing; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.llm.common import bounded_batches, rows_of, whole_text, with_struct, written

SHINGLE = 5
PERCENT = 85
BANDS, ROWS = 24, 5
MINIMA = BANDS * ROWS
BITS = 4
#: Bands of each round: the first finds most links, the rest what is left.
ROUNDS = ((0, 2), (2, 8), (8, BANDS))
#: Rows, and shingles, of one side of a block at most (about: rows are dealt by hash).
BLOCK_ROWS = 1024
BLOCK_SHINGLES = 500_000
#: Rows (about) of a bucket of several parts that all its rows are compared with first.
PIVOTS = 16
#: Rows whose estimates are made at once.
ESTIMATED = 128
#: Shingles that are hashed at once.
CHUNK = 2048


def _keys(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit numbers of a linear congruence."""
    x, out = seed, []
    for _ in range(n):
        x = (x * 6364136223846793005 + 1442695040888963407) % 2**64
        out.append(x | 1)
    return np.array(out, np.uint64)


MULTIPLY, ADD = _keys(MINIMA, 12345), _keys(MINIMA, 67890)
BYTE = _keys(256, 424242)
BYTE[ord("A") : ord("Z") + 1] = BYTE[ord("a") : ord("z") + 1]
BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
BASE = 0x5851F42D4C957F2D
INVERSE = pow(BASE, -1, 2**64)


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every bit of the input moves every bit of the result."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_tables: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2^64, at least n of them."""
    if not _tables or len(_tables[0]) < n:
        size = max(n, 1 << 16)
        _tables[:] = [_powers(BASE, size), _powers(INVERSE, size)]
    return _tables[0], _tables[1]


def word_hashes(text: str) -> np.ndarray:
    """One 64-bit hash per word, from differences of a running polynomial."""
    raw = np.frombuffer(text.encode(), np.uint8)
    if not len(raw):
        return np.empty(0, np.uint64)
    blank = np.concatenate(([True], BLANK[raw], [True]))
    edge = np.flatnonzero(blank[1:] != blank[:-1])
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.empty(0, np.uint64)
    up, down = powers(len(raw))
    run = np.concatenate((np.zeros(1, np.uint64), np.cumsum(BYTE[raw] * up[: len(raw)], dtype=np.uint64)))
    return mixed((run[end] - run[start]) * down[start] + (end - start).astype(np.uint64))


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct shingle hashes of a whole text."""
    w = word_hashes(text or "")
    if not len(w):
        return w
    k = min(SHINGLE, len(w))
    h = np.full(len(w) - k + 1, k, np.uint64)
    for i in range(k):
        h = mixed((h ^ w[i : len(w) - k + 1 + i]) * np.uint64(BASE))
    return np.unique(h)


def minima(s: np.ndarray) -> np.ndarray:
    low = np.full(MINIMA, 2**64 - 1, np.uint64)
    for i in range(0, len(s), CHUNK):
        np.minimum(low, (s[i : i + CHUNK, None] * MULTIPLY + ADD).min(axis=0), out=low)
    return low


def packed(low: np.ndarray) -> np.ndarray:
    """The low BITS bits of the (mixed) minima in 64-bit words."""
    lanes = 64 // BITS
    bits = mixed(low) & np.uint64((1 << BITS) - 1)
    bits = np.concatenate((bits, np.zeros(-len(bits) % lanes, np.uint64))).reshape(-1, lanes)
    return np.bitwise_or.reduce(bits << (np.arange(lanes, dtype=np.uint64) * np.uint64(BITS)), axis=1)


def bands(low: np.ndarray) -> np.ndarray:
    h = np.arange(BANDS, dtype=np.uint64)
    for r in range(ROWS):
        h = mixed((h ^ low[r::ROWS]) * np.uint64(BASE))
    return h


def estimates(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity of every row of ``a`` with every row of ``b`` (signatures):
    the share of equal lanes, corrected for those that are equal by chance."""
    differ = np.zeros((len(a), len(b)), np.int64)
    one = np.uint64(sum(1 << i for i in range(0, 64, BITS)))
    for k in range(a.shape[1]):
        x = a[:, k, None] ^ b[None, :, k]
        y = x
        for i in range(1, BITS):
            y = y | (x >> np.uint64(i))
        differ += np.bitwise_count(y & one)
    chance = 2.0**-BITS
    return ((MINIMA - differ) / MINIMA - chance) / (1 - chance)


def _pair_estimates(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The estimate of each row of ``a`` with the same row of ``b``, for sorting."""
    x = a ^ b
    y = x
    for i in range(1, BITS):
        y = y | (x >> np.uint64(i))
    return -np.bitwise_count(y & np.uint64(sum(1 << i for i in range(0, 64, BITS)))).sum(axis=1, dtype=np.int64)


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def digest(s: np.ndarray) -> bytes:
    """128 bits that name a set: two sums over its members, each finalized."""
    parts = np.stack([mixed(s).sum(), mixed(s * np.uint64(BASE) + np.uint64(1)).sum()])
    return mixed(parts + np.uint64(len(s))).tobytes()


def margin(percent: int) -> float:
    """Four standard deviations of the estimate at the limit."""
    chance = 2.0**-BITS
    equal = percent / 100 + (1 - percent / 100) * chance
    return 4 * (equal * (1 - equal) / MINIMA) ** 0.5 / (1 - chance)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


SIGNED = ("n_shingles", "digest", "packed", "bands")


@F.pandas_udf(_struct(n_shingles=T.LongType(), digest=T.BinaryType(), packed=T.BinaryType(), bands=T.BinaryType()))
def _signed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for text in batch:
            s = shingles(text)
            low = minima(s) if len(s) else None
            out.append((len(s), digest(s), packed(low).tobytes(), bands(low).tobytes()) if len(s) else (0, b"", b"", b""))
        yield pd.DataFrame(out, columns=list(SIGNED))


@F.pandas_udf(_struct(set_digest=T.BinaryType(), set=T.BinaryType()))
def _set(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sets = [shingles(t) for t in batch]
        yield pd.DataFrame({"set_digest": [digest(s) if len(s) else b"" for s in sets], "set": [s.tobytes() for s in sets]})


def block_links(group: pd.DataFrame, percent: int = PERCENT) -> pd.DataFrame:
    """Confirmed links (component, component) between the two sides of one
    block of a bucket: a spanning forest over its components."""
    left, right = group[group["side"] == 0], group[group["side"] == 1]
    out: list[tuple[int, int]] = []
    if len(left) and len(right):
        words = lambda col: np.stack([np.frombuffer(x, np.uint64) for x in col])
        lb, rb = words(left["bands"]), words(right["bands"])
        ln, rn = left["n_shingles"].to_numpy(), right["n_shingles"].to_numpy()
        lc, rc = left["comp"].to_numpy(), right["comp"].to_numpy()
        lp, rp = words(left["packed"]), words(right["packed"])
        # two rows outside the main component meet twice: one meeting counts
        lk, rk = words(left["digest"])[:, 0], words(right["digest"])[:, 0]
        once = (rc == right["main"].to_numpy())[None, :]
        found, least = [], percent / 100 - margin(percent)
        for k in range(0, len(left), ESTIMATED):
            part = slice(k, k + ESTIMATED)
            small, large = np.minimum(ln[part, None], rn[None, :]), np.maximum(ln[part, None], rn[None, :])
            may = (lc[part, None] != rc[None, :]) & (100 * small >= percent * large) & (once | (lk[part, None] <= rk[None, :]))
            at, to = np.nonzero(may & (estimates(lp[part], rp) >= least))
            found.append((at + k, to))
        i, j = (np.concatenate(x) for x in zip(*found))
        # each pair is tested in the first band that it shares
        band = int(group["band"].iloc[0])
        first = np.concatenate([(lb[i[k : k + 100_000]] == rb[j[k : k + 100_000]]).argmax(axis=1) for k in range(0, len(i), 100_000)] or [np.empty(0, int)])
        i, j = i[first == band], j[first == band]
        likeness = np.concatenate([_pair_estimates(lp[i[k : k + 100_000]], rp[j[k : k + 100_000]]) for k in range(0, len(i), 100_000)] or [np.empty(0)])
        order = np.argsort(-likeness, kind="stable")
        top: dict[int, int] = {}

        def root(c: int) -> int:
            while top.get(c, c) != c:
                top[c] = c = top.get(top[c], top[c])
            return c

        ls, rs = [np.frombuffer(x, np.uint64) for x in left["set"]], [np.frombuffer(x, np.uint64) for x in right["set"]]
        for k in order:
            a, b = root(int(lc[i[k]])), root(int(rc[j[k]]))
            if a == b:
                continue
            x, y = ls[i[k]], rs[j[k]]
            both = common(x, y)
            if 100 * both >= percent * (len(x) + len(y) - both):
                top[max(a, b)] = min(a, b)
                out.append((a, b))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def components(links: DataFrame) -> DataFrame:
    """(node, label): for every node of the links (a, b) the smallest node that
    it can reach. Neighbours' smallest labels and pointer jumps by turns, each
    a written table, until nothing changes."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = written(both.where(F.col("a") != F.col("b")).distinct(), "edges")
    labels = written(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        far = edges.join(labels.select(F.col("node").alias("b"), F.col("label").alias("l")), "b").groupBy(F.col("a").alias("node")).agg(F.min("l").alias("l"))
        near = labels.join(far, "node").select("node", F.col("label").alias("old"), F.least("label", "l").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        now = written(near.join(jump, "label").select("node", "old", F.least("label", "next").alias("label")), "labels")
        if now.where(F.col("old") != F.col("label")).limit(1).count() == 0:
            return now.select("node", "label")
        labels = now.select("node", "label")


def merged(classes: DataFrame, links: DataFrame) -> DataFrame:
    """``classes`` with the components that the links join (one row per class)."""
    names = components(links).where(F.col("node") != F.col("label"))
    out = classes.join(names, classes["comp"] == names["node"], "left")
    cols = [F.coalesce("label", "comp").alias("comp") if c == "comp" else F.col(c) for c in classes.columns]
    return written(out.select(*cols), "classes")


def _open_buckets(members: DataFrame) -> DataFrame:
    """The buckets that hold more than one component: their rows, their largest
    component, and the parts that all rows and those outside it are cut into."""
    per = members.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("size")).groupBy("bucket").agg(
        F.max(F.struct("n", "comp", "size")).alias("most"), F.sum("n").alias("n"), F.sum("size").alias("size"), F.count(F.lit(1)).alias("comps"))

    def parts(rows, size):
        return F.greatest(F.lit(1), F.ceil(rows / F.lit(BLOCK_ROWS)), F.ceil(size / F.lit(BLOCK_SHINGLES))).cast("int")

    return written(per.where(F.col("comps") > 1).select(
        "bucket", "n", F.col("most.comp").alias("main"), parts(F.col("n"), F.col("size")).alias("all"),
        parts(F.col("n") - F.col("most.n"), F.col("size") - F.col("most.size")).alias("other")), "open")


def _part(n: str) -> Column:
    return F.pmod(F.xxhash64("digest"), F.col(n)).cast("int")


def _each(n: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(n) - 1))


def _compared(left: DataFrame, right: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links found in the blocks (bucket, i, j) of the two sides."""
    keep = ["bucket", "band", "i", "j", "side", "digest", "comp", "main"]
    sides = left.withColumn("side", F.lit(0)).select(*keep).unionByName(right.withColumn("side", F.lit(1)).select(*keep))
    return sides.join(sets, "digest").groupBy("bucket", "i", "j").applyInPandas(lambda group: block_links(group, percent), "a long, b long")


def _pivot_links(members: DataFrame, hot: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of about PIVOTS rows of each hot bucket with all its rows. A group of
    near copies becomes one component by work that grows with its rows, not with
    their square; what the pivots do not link is left to the blocks."""
    rows = members.join(hot, "bucket").withColumn("i", F.lit(0))
    pivots = rows.where(F.pmod(F.xxhash64("digest", F.lit(PIVOTS)), F.col("n")) < PIVOTS)
    # as if every row were in the main component: each meeting counts
    return _compared(pivots.withColumn("j", _each("all")), rows.withColumn("j", _part("all")).withColumn("main", F.col("comp")), sets, percent)


def _bucket_links(members: DataFrame, open_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of the rows outside a bucket's largest component with all its rows."""
    rows = members.join(open_, "bucket")
    left = rows.where(F.col("comp") != F.col("main")).withColumn("i", _part("other")).withColumn("j", _each("all"))
    right = rows.withColumn("j", _part("all")).withColumn("i", _each("other"))
    return _compared(left, right, sets, percent)


def with_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    signed, comps = _linked(docs, id_col, text_col, percent, one_id=True)
    linkable = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    named = signed.join(comps, "digest", "left")
    return named.select("doc_id", "n_shingles", F.when(linkable, F.col("comp")).otherwise(F.col("doc_id")).alias("component_id"))


def _linked(docs: DataFrame, id_col: str, text_col: str, percent: int, one_id: bool) -> tuple[DataFrame, DataFrame]:
    """The signed rows (doc_id, n_shingles, digest ...) and the component of each
    class of equal sets (digest, comp). With ``one_id`` a component is its
    smallest id and rows that share an id are one document; else a component has
    a number of its own and rows are linked by their texts alone."""
    bounded_batches(docs)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    signed = written(with_struct(rows, _signed(F.col("text")), SIGNED).drop("text"), "signed")
    linkable = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    real = signed.where(linkable)
    # equal sets are one class
    first = [F.first(c).alias(c) for c in ("n_shingles", "bands", "packed")]
    label = F.min("doc_id") if one_id else F.first(F.xxhash64("digest"))
    classes = written(real.groupBy("digest").agg(label.alias("comp"), F.min("doc_id").alias("doc_id"), *first), "classes")

    # the bands that a class shares with another class
    band = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.xxhash64(k, F.substring("bands", k * 8 + 1, 8)))
    every = classes.select("digest", "n_shingles", F.posexplode(band).alias("band", "bucket"))
    shared = every.groupBy("bucket").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > 1).select("bucket")
    members = written(every.join(shared, "bucket"), "members")
    near = members.select("digest").distinct()
    # their full sets, from one text of each class
    wanted = classes.join(near, "digest").select("doc_id", "digest", "n_shingles", "bands", "packed")
    # nondeterministic in name only: else the filter, and with it the sets of
    # all documents, would be computed below the join
    set_of = _set.asNondeterministic()
    found = with_struct(rows.join(wanted, "doc_id"), set_of(F.col("text")), ("set_digest", "set")).where(F.col("digest") == F.col("set_digest"))
    sets = written(found.select("digest", "n_shingles", "bands", "packed", "set").dropDuplicates(["digest"]), "sets")

    comps = classes.select("digest", "comp")
    # rows that share an id are one document
    same_id = real.join(comps, "digest").groupBy("doc_id").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).where(
        F.col("a") != F.col("b")).select("a", "b") if one_id else None
    for k, (lo, hi) in enumerate(ROUNDS):
        here = members.where((F.col("band") >= lo) & (F.col("band") < hi))
        now = here.join(comps, "digest")
        open_ = _open_buckets(now)
        hot = open_.where(F.col("all") > 1)
        if hot.limit(1).count():
            links = written(_pivot_links(now, hot, sets, percent), "pivots")
            if links.limit(1).count():
                comps = merged(comps, links)
                now = here.join(comps, "digest")
                open_ = _open_buckets(now)
        links = _bucket_links(now, open_, sets, percent)
        links = written(links.union(same_id) if k == 0 and one_id else links, "links")
        if links.limit(1).count():
            comps = merged(comps, links)
    return signed, comps


def dedup_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """Per row: set size, component and whether it is the one that stays."""
    return with_components(docs, id_col, text_col, percent).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component: one of its smallest id. Rows are
    linked by their texts alone, so unlike texts under one id all stay. Rows with a
    null id, and texts without words, are linked with nothing and stay."""
    signed, comps = _linked(docs, id_col, text_col, percent, one_id=False)
    linkable = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    best = signed.where(linkable).join(comps, "digest").groupBy("comp").agg(F.min(F.struct("doc_id", "digest")).alias("best"))
    winners = written(best.select("best.doc_id", "best.digest"), "winners")
    again = signed.where(F.col("doc_id").isNotNull()).groupBy("doc_id").count().where(F.col("count") > 1).select("doc_id")
    again = written(again, "again")
    lost = signed.where(linkable).select("doc_id", "digest").join(winners, ["doc_id", "digest"], "left_anti").select("doc_id")
    if not again.limit(1).count():
        return _without(docs, lost, id_col)
    # ids with several rows: each row's set decides, one row of a winning set stays
    single = _without(docs, lost.union(again).distinct(), id_col)
    several = rows_of(docs, _id=F.col(f"`{id_col}`").cast("long"), _text=whole_text(text_col)).join(again.withColumnRenamed("doc_id", "_id"), "_id", "left_semi")
    found = with_struct(several, _set.asNondeterministic()(F.col("_text")), ("set_digest", "set")).drop("_text", "set")
    found = written(found, "several")
    wordless = found.where(F.length("set_digest") == 0).select("_row")
    won = found.join(winners, (F.col("_id") == winners["doc_id"]) & (F.col("set_digest") == winners["digest"]), "left_semi")
    one = won.groupBy("_id", "set_digest").agg(F.first("_row").alias("_row")).select("_row")
    return single.unionByName(wordless.unionByName(one).select("_row.*"))


def _without(docs: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    gone = ids.select(F.col("doc_id").alias("_id"))
    return rows_of(docs, _id=F.col(f"`{id_col}`").cast("long")).join(gone, "_id", "left_anti").select("_row.*")
