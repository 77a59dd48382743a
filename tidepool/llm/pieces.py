"""SentencePiece BPE encoding by suffix-array matching, and decoding.

The distinct pre-tokens of a batch of texts (cut before each run of spaces;
no piece crosses such a cut) are concatenated, and a suffix array over the
concatenation, as deep as the longest piece, is built. Every piece of the
vocabulary is binary-searched in it; its range lists all its occurrences,
which are the edges of the batch's lattice. The edges are sorted by position
and relaxed: at each end position, the edge is kept whose piece may follow the
piece kept at the edge's start.

For a unigram vocabulary, relaxing would add up scores. A BPE vocabulary has
no such sum: its segmentation is what merging by rank gives. But it has the
same shape: a sequence of pieces is the BPE segmentation if and only if every
adjacent pair in it is one that merging would leave as it is, and each prefix
of a text has exactly one such sequence. So the relaxation tests the pair
(piece kept at the start, piece of the edge) by undoing, from the latest, the
merges on either side of the border and looking for an earlier merge across
it. The results equal the library's, which the tests check.

Texts are worked off in chunks of CHUNK_CHARS; a worker remembers at most
CACHE_ENTRIES pre-tokens. Nothing is shuffled.

Defined cases: a null or empty text has no ids and decodes to ''; characters
outside the vocabulary become byte pieces; the vocabulary's own space mark
inside a text reads back as a space (round_trip is false); bytes that are no
UTF-8 decode to U+FFFD; repeated rows are encoded each for themselves; an
empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.llm.common import bounded_batches, whole_text, with_struct
from tidepool.llm.token_counts import LONGEST_CACHED, MARK, MODEL, model_bytes, pre_tokens

CHUNK_CHARS = 3_000_000
CACHE_ENTRIES = 500_000
#: Characters that are indexed at once (one pre-token at least).
INDEX_CHARS = 400_000
#: Characters per sort key: 16 bits each.
PER_KEY = 4
HASH = np.uint64(0x9E3779B97F4A7C15)


class Vocabulary:
    """Pieces in the order in which merging makes them.

    Numbers inside: single characters first, then the longer pieces by
    descending score (merge rank). ``left`` and ``right`` are the two parts
    that the last merge of a piece joins (itself for a character).
    """

    def __init__(self, model: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        byte = {int(names[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        if len(byte) < 256:
            raise ValueError("the vocabulary has no byte pieces")
        score = {i: sp.get_score(i) for i in plain}
        if any(MARK in names[i].lstrip(MARK) or (names[i][:2] == 2 * MARK and names[i].strip(MARK)) for i in plain):
            raise ValueError("a piece holds a space after another character, or two before one")
        # runs of space marks have one rank in common, below all others
        self.runs = {len(names[i]): i for i in plain if not names[i].strip(MARK)}
        plain = [i for i in plain if names[i].strip(MARK) or names[i] == MARK]
        if any(score[i] >= score[k] for n, i in self.runs.items() if n > 1 for k in plain if names[k] != MARK):
            raise ValueError("runs of spaces must rank below all other pieces")
        longer = sorted((i for i in plain if len(names[i]) > 1), key=lambda i: -score[i])
        if any(score[a] == score[b] for a, b in zip(longer, longer[1:])):
            raise ValueError("two pieces have the same rank")
        order = [i for i in plain if len(names[i]) == 1] + longer
        self.chars = len(order) - len(longer)
        self.names = [names[i] for i in order]
        self.ids = np.array(order, np.int32)
        self.byte_ids = np.array([byte[b] for b in range(256)], np.int32)
        self.number = {p: k for k, p in enumerate(self.names)}
        self.length = np.array([len(p) for p in self.names], np.int64)
        self.depth = int(self.length.max())
        self.left, self.right, joins, whole = self._splits()
        self.usable = whole
        self._table(joins)
        #: character -> code from 1; 0 ends a pre-token, the last code is for all others
        self.alphabet = {c: k for k, c in enumerate(sorted({c for p in self.names for c in p}), 1)}
        self.other = len(self.alphabet) + 1
        self.code = np.full(0x110000, self.other, np.uint16)
        for c, k in self.alphabet.items():
            self.code[ord(c)] = k
        text = [names[i].replace(MARK, " ").encode() for i in range(n)]
        for b, i in byte.items():
            text[i] = bytes([b])
        for i in range(n):
            if sp.is_control(i):
                text[i] = b""
            elif sp.is_unknown(i):
                text[i] = " ⁇ ".encode()
        self.bytes = text

    def _splits(self):
        """Parts of each piece, all joins (a, b) -> piece, and which pieces
        merging can make from their characters."""
        left, right = np.arange(len(self.names)), np.arange(len(self.names))
        whole = np.ones(len(self.names), bool)
        joins: dict[tuple[int, int], int] = {}
        number = self.number
        for k, p in enumerate(self.names):
            for i in range(1, len(p)):
                a, b = number.get(p[:i]), number.get(p[i:])
                if a is not None and b is not None:
                    joins[a, b] = k
        for k in range(self.chars, len(self.names)):
            parts = [number.get(c, -1) for c in self.names[k]]
            while len(parts) > 2 or (len(parts) == 2 and joins.get((parts[0], parts[1])) != k):
                best = min(((joins[x, y], i) for i, (x, y) in enumerate(zip(parts, parts[1:])) if (x, y) in joins), default=None)
                if best is None or best[0] > k:
                    break
                parts[best[1] : best[1] + 2] = [best[0]]
                if len(parts) == 1:
                    break
            if len(parts) == 2 and joins.get((parts[0], parts[1])) == k:
                left[k], right[k] = parts
            else:
                whole[k] = False
        return left, right, joins, whole

    def run(self, n: int) -> list[int]:
        """The pieces of n space marks: of equal ranks the leftmost merge comes
        first, until no two neighbours make a piece."""
        parts, i = [1] * n, 0
        while i + 1 < len(parts):
            if parts[i] + parts[i + 1] in self.runs:
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
                i = max(0, i - 1)
            else:
                i += 1
        return [self.runs[k] for k in parts]

    def _table(self, joins: dict[tuple[int, int], int]) -> None:
        """The joins in a table of short buckets for lookups of whole arrays."""
        self.size = len(self.names)
        key = np.array([a * self.size + b for a, b in joins], np.int64)
        value = np.array(list(joins.values()), np.int64)
        self.shift = np.uint64(64 - max(4, int(len(key) * 2).bit_length()))
        slot = self._slot(key)
        order = np.argsort(slot, kind="stable")
        within = np.arange(len(key)) - np.searchsorted(slot[order], slot[order])
        self.keys = np.full((1 << int(64 - self.shift), int(within.max(initial=0)) + 1), -1, np.int64)
        self.made = np.full(self.keys.shape, self.size, np.int64)
        self.keys[slot[order], within], self.made[slot[order], within] = key[order], value[order]

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * HASH) >> self.shift).astype(np.int64)

    def joined(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece that a and b merge to (``size`` if none)."""
        key = a * self.size + b
        slot = self._slot(key)
        out = np.full(len(key), self.size, np.int64)
        for k in range(self.keys.shape[1]):
            hit = self.keys[slot, k] == key
            out[hit] = self.made[slot[hit], k]
        return out

    def stays(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging leaves each adjacent pair of pieces as it is."""
        ok = np.ones(len(a), bool)
        at = np.arange(len(a))
        a, b = a.copy(), b.copy()
        limit = np.full(len(a), self.size, np.int64)
        while len(at):
            merges = self.joined(a, b) < limit
            ok[at[merges]] = False
            # undo the later merge (of equal ones the right one); if that side
            # is a character, the other; if both are, nothing crossed the border
            one_a, one_b = self.left[a] == a, self.left[b] == b
            undo_a = np.where(one_b, True, ~one_a & (a > b))
            go = ~merges & ~(one_a & one_b)
            limit = np.where(undo_a, a, b + 1)
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
            at, a, b, limit = at[go], a[go], b[go], limit[go]
        return ok


def suffix_array(keys: np.ndarray) -> np.ndarray:
    """Start positions in the order of their suffixes (rows of ``keys``), by
    doubling: ranks of the first PER_KEY characters, then of twice as many."""
    rank, order = _ranks(keys[0])
    reach, depth = PER_KEY, PER_KEY * len(keys)
    while reach < depth:
        ahead = np.concatenate((rank[reach:], np.zeros(min(reach, len(rank)), np.int64)))[: len(rank)]
        rank, order = _ranks(rank * np.int64(len(rank) + 1) + ahead)
        reach *= 2
    return order


def _ranks(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dense ranks from 1, and the order, of an array of numbers."""
    order = np.argsort(key)
    sorted_ = key[order]
    rank = np.empty(len(key), np.int64)
    rank[order] = np.cumsum(np.concatenate(([True], sorted_[1:] != sorted_[:-1])))
    return rank, order


def sort_keys(codes: np.ndarray, depth: int) -> np.ndarray:
    """For each position the next ``depth`` codes, PER_KEY to a 64-bit number."""
    n = len(codes)
    rows = -(-depth // PER_KEY)
    long = np.concatenate((codes, np.zeros(rows * PER_KEY, codes.dtype))).astype(np.uint64)
    out = np.zeros((rows, n), np.uint64)
    for r in range(rows):
        for i in range(PER_KEY):
            out[r] = (out[r] << np.uint64(16)) | long[r * PER_KEY + i : r * PER_KEY + i + n]
    return out


def search(ordered: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Binary search of many rows at once: for each column of ``wanted``, how
    many columns of ``ordered`` are smaller."""
    lo, hi = np.zeros(wanted.shape[1], np.int64), np.full(wanted.shape[1], ordered.shape[1], np.int64)
    while (lo < hi).any():
        mid = (lo + hi) // 2
        at = np.minimum(mid, ordered.shape[1] - 1)
        less, tie = np.zeros(len(lo), bool), np.ones(len(lo), bool)
        for r in range(len(ordered)):
            x = ordered[r, at]
            less |= tie & (x < wanted[r])
            tie &= x == wanted[r]
        open_ = lo < hi
        lo, hi = np.where(open_ & less, mid + 1, lo), np.where(open_ & ~less, mid, hi)
    return lo


class Encoder:
    """Encodes batches of pre-tokens; remembers the last ones."""

    def __init__(self, vocabulary: Vocabulary, entries: int = CACHE_ENTRIES):
        self.v, self.room, self.new, self.old = vocabulary, max(1, entries // 2), {}, {}
        v = vocabulary
        usable = np.flatnonzero(v.usable)
        codes = np.zeros((len(usable), v.depth), np.uint16)
        for r, k in enumerate(usable):
            codes[r, : v.length[k]] = [v.alphabet[c] for c in v.names[k]]
        self.numbers = usable
        self.low = self._piece_keys(codes)
        past = np.arange(v.depth)[None, :] >= v.length[usable][:, None]
        self.high = self._piece_keys(np.where(past, np.uint16(0xFFFF), codes))

    def _piece_keys(self, codes: np.ndarray) -> np.ndarray:
        rows = -(-self.v.depth // PER_KEY)
        wide = np.zeros((len(codes), rows * PER_KEY), np.uint64)
        wide[:, : codes.shape[1]] = codes
        out = np.zeros((rows, len(codes)), np.uint64)
        for i in range(PER_KEY):
            out = (out << np.uint64(16)) | wide[:, i::PER_KEY].T
        return out

    def edges(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, piece) of every occurrence of every piece in the batch."""
        keys = sort_keys(codes, self.v.depth)
        order = suffix_array(keys)
        ordered = keys[:, order]
        lo, hi = search(ordered, self.low), search(ordered, self.high)
        n = np.maximum(0, hi - lo)
        within = np.arange(n.sum()) - np.repeat(np.concatenate(([0], np.cumsum(n)[:-1])), n)
        return order[np.repeat(lo, n) + within], np.repeat(self.numbers, n)

    def pre_tokens(self, words: list[str]) -> list[bytes]:
        """Ids (as int32) of pre-tokens. Each gets the space mark in front that
        the library puts there; further spaces before it join the run of marks
        that is left when the word has taken what it can."""
        v = self.v
        bare = [w.lstrip(" ") for w in words]
        out = self.words(bare)
        lone = np.array([v.runs[1]], np.int32).tobytes()
        for k, (w, b) in enumerate(zip(words, bare)):
            marks = 1 + len(w) - len(b)
            if marks > 1:
                free = out[k][:4] == lone
                run = np.array(v.run(marks if free else marks - 1), np.int32).tobytes()
                out[k] = run + (out[k][4:] if free else out[k])
        return out

    def words(self, words: list[str]) -> list[bytes]:
        """Ids (as int32) of words without spaces, each with a space mark in
        front; INDEX_CHARS characters are indexed at a time."""
        out: list[bytes] = []
        held, n = [], 0
        for w in words:
            if held and n + len(w) > INDEX_CHARS:
                out += self._index(held)
                held, n = [], 0
            held.append(w)
            n += len(w) + 2
        return out + self._index(held) if held else out

    def _index(self, words: list[str]) -> list[bytes]:
        v = self.v
        text = "".join(f"{MARK}{w}\0" for w in words)
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        size = np.array([len(w) for w in words], np.int64) + 2
        begin = np.concatenate(([0], np.cumsum(size)[:-1]))
        stop = begin + size - 1  # of the closing mark
        codes = v.code[points]
        codes[stop] = 0
        start, piece = self.edges(codes)
        # characters outside the vocabulary are edges of their own
        strange = np.flatnonzero(codes == v.other)
        start, piece = np.concatenate((start, strange)), np.concatenate((piece, np.full(len(strange), v.size)))
        length = np.append(v.length, 1)[piece]
        inside = (np.arange(len(codes)) - np.repeat(begin, size))[start]
        # by end position inside the pre-token, longer edges first
        step = (inside + length) * (v.depth + 1) + (v.depth - length)
        order = np.argsort(step.astype(np.uint16) if step.max(initial=0) < 1 << 16 else step, kind="stable")
        start, piece, first, step = start[order], piece[order], inside[order] == 0, step[order]
        end = start + length[order]
        last = np.full(len(codes) + 1, -1, np.int64)
        cuts = np.flatnonzero(np.concatenate(([True], step[1:] != step[:-1], [True]))) if len(step) else np.zeros(1, int)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            free = np.flatnonzero(last[end[a:b]] < 0) + a
            s, e, t, good = start[free], end[free], piece[free], first[free].copy()
            before = last[s]
            good |= (before == v.size) | ((t == v.size) & (before >= 0))
            ask = np.flatnonzero(~good & (before >= 0))
            if len(ask):
                good[ask] = v.stays(before[ask], t[ask])
            last[e[good]] = t[good]
        return self._backtrack(points, begin, stop, last)

    def _backtrack(self, points: np.ndarray, begin: np.ndarray, stop: np.ndarray, last: np.ndarray) -> list[bytes]:
        v = self.v
        at, who = stop.copy(), np.arange(len(stop))
        rows, found, places = [], [], []
        while len(who):
            t = last[at]
            if (t < 0).any():
                raise AssertionError("a prefix without a segmentation")
            at = at - np.where(t == v.size, 1, v.length[np.minimum(t, v.size - 1)])
            rows.append(who)
            found.append(t)
            places.append(at)
            go = at > begin[who]
            at, who = at[go], who[go]
        if not rows:
            return []
        row, piece, place = np.concatenate(rows), np.concatenate(found), np.concatenate(places)
        order = np.lexsort((place, row))
        row, piece, place = row[order], piece[order], place[order]
        raw = np.where(piece < v.size, v.ids[np.minimum(piece, v.size - 1)], -1).astype(np.int32)
        cut = np.searchsorted(row, np.arange(len(stop) + 1))
        data = raw.tobytes()
        out = [data[4 * a : 4 * b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
        for w in np.unique(row[piece == v.size]).tolist():
            a, b = cut[w], cut[w + 1]
            ids: list[int] = []
            for k, p in zip(raw[a:b].tolist(), place[a:b].tolist()):
                ids += [k] if k >= 0 else v.byte_ids[list(chr(points[p]).encode())].tolist()
            out[w] = np.array(ids, np.int32).tobytes()
        return out

    def texts(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The ids of each whole text, in chunks of CHUNK_CHARS."""
        held: list[list[str]] = []
        n = 0
        for text in texts:
            held.append(pre_tokens(text) if text else [])
            n += len(text or "")
            if n >= CHUNK_CHARS:
                yield from self._chunk(held)
                held, n = [], 0
        yield from self._chunk(held)

    def _chunk(self, held: list[list[str]]) -> Iterator[np.ndarray]:
        known: dict[str, bytes] = {}
        missing = []
        for w in set().union(*held):
            ids = self.new.get(w) or self.old.get(w)
            if ids is None:
                missing.append(w)
            else:
                known[w] = ids
        if len(self.new) >= self.room:
            self.old, self.new = self.new, {}
        known.update(zip(missing, self.pre_tokens(missing)))
        self.new.update((w, known[w]) for w in missing if len(w) <= LONGEST_CACHED)
        for words in held:
            yield np.frombuffer(b"".join([known[w] for w in words]), np.int32)


def decode(ids: Iterable[int], vocabulary: Vocabulary) -> str:
    """The text of a sequence of ids: pieces and bytes joined, space marks
    read as spaces, without the one that encoding puts in front."""
    raw = b"".join(map(vocabulary.bytes.__getitem__, ids))
    return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


_worker: dict[int, Encoder] = {}
FIELDS = ("ids", "decoded")


def with_pieces(df: DataFrame, text_col: str = "text", model: str = MODEL, decoded: bool = True) -> DataFrame:
    """``df`` plus the ids of each whole text and the text that they decode to."""
    bounded_batches(df)
    shared = df.sparkSession.sparkContext.broadcast(Vocabulary(model_bytes(model)))

    @F.arrow_udf(T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]))
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocabulary = shared.value
        encoder = _worker.get(id(vocabulary))
        if encoder is None:
            _worker.clear()
            encoder = _worker[id(vocabulary)] = Encoder(vocabulary)
        for batch in batches:
            got = list(encoder.texts(batch.to_pylist()))
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in got]))).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(got) if got else np.empty(0, np.int32)))
            back = pa.array([decode(x.tolist(), vocabulary) for x in got] if decoded else [None] * len(got), pa.string())
            yield pa.StructArray.from_arrays([ids, back], list(FIELDS))

    return with_struct(df, encode(whole_text(text_col)), FIELDS)


def piece_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL) -> DataFrame:
    """Per row: id, number of pieces, the ids, and whether they read back as
    the whole text."""
    slim = df.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    done = with_pieces(slim, "text", model)
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", (F.col("decoded") == F.col("text")).alias("round_trip"))
