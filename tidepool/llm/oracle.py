"""DuckDB SQL of the operators that SQL can express, over the driver's views.

Each is written from the operator's definition, not from its plan: phrases and
shingles are compared in full, without indexes, signatures or seeds.
"""

from __future__ import annotations

from tidepool.llm import decontaminate, licenses, pii, quality, sharding

LOWERED = f"translate(coalesce(text, ''), '{licenses.UPPER}', '{licenses.LOWER}')"


def _list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def licenses_sql() -> str:
    templates = [*licenses.BASE, *licenses.MORE]
    vocabulary = sorted({w for t in templates for w in t.text.split()})
    parts = []
    for k, t in enumerate(templates):
        marks, words = licenses.places(t), t.text.split()
        first, last = min(q for q, _ in marks), max(q + len(p) for q, p in marks)
        said = " AND ".join(f"ws[s + {q + 1}:s + {q + len(p)}] = {_list(p)}" for q, p in marks)
        weight = " + ".join(f"CASE WHEN s + {q} >= 0 AND s + {q} < len(ws) AND ws[s + {q + 1}] = '{w}' THEN idf['{w}'] ELSE 0 END" for q, w in enumerate(words))
        total = " + ".join(f"idf['{w}']" for w in words)
        parts.append(f"SELECT rid, '{t.label}' AS label, {k < len(licenses.BASE)} AS base, s + {first} AS word, least(1.0, ({weight}) / ({total})) AS score "
                     f"FROM (SELECT rid, ws, idf, unnest(range({-first}, len(ws) - {last - 1})) AS s FROM near) WHERE {said}")
    return f"""
WITH w AS (
  SELECT row_number() OVER () AS rid, doc_id,
         list_filter(regexp_split_to_array({LOWERED}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS ws FROM documents),
freq AS (SELECT v, count(*) AS n FROM (SELECT DISTINCT rid, unnest(list_filter(ws, lambda x: list_contains({_list(vocabulary)}, x))) AS v FROM w) GROUP BY v),
weights AS (
  SELECT map_from_entries(list((x.v, ln(((SELECT count(*) FROM w) + 1) / (coalesce(freq.n, 0) + 1)) + 1))) AS idf
  FROM (SELECT unnest({_list(vocabulary)}) AS v) x LEFT JOIN freq USING (v)),
near AS (SELECT rid, ws, idf FROM w, weights WHERE list_has_any(ws, {_list(vocabulary)})),
m AS ({" UNION ALL ".join(parts)})
SELECT w.doc_id, len(w.ws) AS n_words, count(*) FILTER (m.base) AS n_base,
       min(m.word) FILTER (m.base) AS first_word, max(m.word) FILTER (m.base) AS last_word,
       coalesce(string_agg(DISTINCT m.label, ',' ORDER BY m.label) FILTER (m.base), '') AS base_labels,
       coalesce(string_agg(DISTINCT m.label, ',' ORDER BY m.label), '') AS labels,
       coalesce(max(m.score), 0.0)::DOUBLE AS score
FROM w LEFT JOIN m USING (rid) GROUP BY w.rid, w.doc_id, w.ws
"""


def decontamination_sql() -> str:
    word = f"regexp_extract_all(regexp_replace(lower(coalesce(text, '')), '([{decontaminate.CJK}])', ' \\1 ', 'g'), '[\\p{{L}}\\p{{N}}_]+')"
    w = f"least({decontaminate.WINDOW}, n)"
    least = f"CASE WHEN n < {decontaminate.MIN_TOKENS} THEN n ELSE ceil({decontaminate.AGREE} * {w}) END"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {word} AS ws FROM documents),
i AS (SELECT row_number() OVER () AS iid, item_id, {word} AS ws FROM benchmark),
dw AS (SELECT rid, unnest(ws) AS word, unnest(range(len(ws))) AS p FROM d),
iw AS (SELECT iid, len(ws) AS n, unnest(ws) AS word, unnest(range(len(ws))) AS q FROM i),
diagonal AS (
  SELECT rid, iid, n, p - q AS diag, list(q) AS same FROM dw JOIN iw USING (word) GROUP BY ALL HAVING count(*) >= {least}),
placed AS (
  SELECT rid, iid, n, diag, s, len(list_filter(same, lambda x: x >= s AND x < s + {w})) AS agree
  FROM (SELECT *, unnest(range(n - {w} + 1)) AS s FROM diagonal)),
best AS (
  SELECT rid, iid, diag + s AS start, s AS item_start, {w} AS tokens, agree FROM placed JOIN d USING (rid)
  WHERE agree >= {least} AND diag + s >= 0 AND diag + s + {w} <= len(d.ws)
  QUALIFY row_number() OVER (PARTITION BY rid, iid ORDER BY agree DESC, diag + s, s) = 1)
SELECT d.doc_id, i.item_id, start, item_start, tokens, agree FROM best JOIN d USING (rid) JOIN i USING (iid)
"""


def quality_sql() -> str:
    words = "list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
    bins = ", ".join(f"len(list_filter(lows, lambda x: x = '{w}'))" for w in quality.WORDS)
    n_word, n_char = len(quality.WORDS) + 1, len(quality.CHAR_CLASSES)

    def shares(hist: str) -> str:
        return f"list_transform({hist}, lambda x: CASE WHEN list_sum({hist}) > 0 THEN x / list_sum({hist})::DOUBLE ELSE 0.0 END)"

    def distance(p: str, q: str, n: int) -> str:
        part = lambda x, y: f"CASE WHEN {x}[k] > 0 THEN {x}[k] * log2({x}[k] / (({x}[k] + {y}[k]) / 2)) ELSE 0.0 END"
        return f"sqrt(greatest(0.0, least(1.0, list_sum(list_transform(range(1, {n + 1}), lambda k: ({part(p, q)} + {part(q, p)}) / 2)))))"

    def sums(hist: str, n: int) -> str:
        return "[" + ", ".join(f"coalesce(sum({hist}[{k}]) FILTER (NOT base_failed), 0)::BIGINT" for k in range(1, n + 1)) + "]"

    def any_script(hist: str) -> str:
        return f"[{hist}[1] + {hist}[2] + {hist}[6], 0, {hist}[3], {hist}[4], {hist}[5], 0, 0]"

    return f"""
WITH a AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t FROM documents),
b AS (SELECT *, {words} AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM a),
c AS (SELECT *, list_transform(ws, lambda x: lower(x)) AS lows, list_transform(range(1, len(ws) - {quality.WINDOW - 2}), lambda k: array_to_string(ws[k:k + {quality.WINDOW - 1}], ' ')) AS grams FROM b),
g AS (SELECT rid, unnest(grams) AS gram, unnest(range(len(grams))) AS k FROM c),
twice AS (SELECT rid, gram FROM g GROUP BY rid, gram HAVING count(*) > 1),
covered AS (SELECT rid, count(DISTINCT k + j) AS n FROM (SELECT g.rid, g.k, unnest(range({quality.WINDOW})) AS j FROM g JOIN twice USING (rid, gram)) GROUP BY rid),
counts AS (
  SELECT c.rid, doc_id, lang, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: len(x))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(covered.n, 0) AS n_repeat_words, len(t) AS chars, len(regexp_extract_all(t, '\\p{{Lu}}')) AS uppers,
         len(regexp_extract_all(t, '[0-9]')) AS digits, len(regexp_extract_all(t, '[.,;:!?''"()\\-]')) AS marks, strlen(t) - len(t) AS beyond, lows
  FROM c LEFT JOIN covered USING (rid)),
hist AS (
  SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed,
         [greatest(0, word_chars - uppers - digits - marks - n_symbols), uppers, digits, marks, n_symbols, chars - word_chars, beyond] AS ch,
         list_append([{bins}], n_words - len(list_filter(lows, lambda x: list_contains({_list(quality.WORDS)}, x)))) AS wh
  FROM counts),
sums AS (SELECT lang, {sums('ch', n_char)} AS cs, {sums('wh', n_word)} AS wsum FROM hist GROUP BY lang),
everyone AS (SELECT {sums('ch', n_char)} AS ca, {sums('wh', n_word)} AS wa FROM hist),
refs AS (SELECT lang, list_sum(wsum) < {quality.MIN_REFERENCE_WORDS} AS few, CASE WHEN few THEN {any_script('ca')} ELSE cs END AS cref,
                CASE WHEN few THEN wa ELSE wsum END AS wref FROM sums, everyone),
judged AS (SELECT h.* EXCLUDE (ch), CASE WHEN few THEN {any_script('h.ch')} ELSE h.ch END AS ch, cref, wref
           FROM hist h JOIN refs s ON h.lang IS NOT DISTINCT FROM s.lang),
p AS (SELECT *, {shares('ch')} AS cp, {shares('wh')} AS wp, {shares('cref')} AS cq, {shares('wref')} AS wq FROM judged),
r AS (SELECT *, {distance('cp', 'cq', n_char)} AS char_distance, {distance('wp', 'wq', n_word)} AS word_distance FROM p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (chars >= {quality.MIN_CHARS_JUDGED} AND char_distance > {quality.MAX_CHAR_DISTANCE})
       AND NOT (n_words >= {quality.MIN_WORDS_JUDGED} AND word_distance > {quality.MAX_WORD_DISTANCE}) AS kept, char_distance, word_distance
FROM r
"""


def near_dedup_sql() -> str:
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array({LOWERED}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                                 ELSE list_transform(range(1, len(ws) - 3), lambda k: array_to_string(ws[k:k + 4], ' ')) END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM pair JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT a AS node, b AS other FROM edge UNION SELECT r.node, e.b FROM reach r JOIN edge e ON e.a = r.other),
comp AS (SELECT node, least(node, min(other)) AS c FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(comp.c, d.doc_id) AS component_id, d.doc_id = coalesce(comp.c, d.doc_id) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN comp ON comp.node = d.doc_id
"""


def crc32_sql(lists: str) -> str:
    """CRC-32 of the half-bytes in ``lists`` (low half of each byte first), by
    the sixteen remainders of the polynomial."""
    table = []
    for c in range(16):
        for _ in range(4):
            c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
        table.append(c)
    return f"xor(list_reduce(list_prepend({sharding.MASK32}, {lists}), lambda c, x: xor(c >> 4, {table}[(xor(c, x) & 15) + 1])), {sharding.MASK32})"


def sharding_sql(shards: int = 40) -> str:
    once = "SELECT * FROM walk WHERE step = 0 OR x >= n"
    for r, key in enumerate(sharding.round_keys(sharding.SEED)):
        left, right = ("small", "large") if r % 2 == 0 else ("large", "small")
        once = f"SELECT *, ((x & ((1::BIGINT << {right}) - 1)) * {0x2C1B3C6D} + {key}) & {0x7FFFFFFF} AS y FROM ({once})"
        once = (f"SELECT * EXCLUDE (y) REPLACE (((x & ((1::BIGINT << {right}) - 1)) << {left}) | "
                f"xor(x >> {right}, (((y * {0x297A2D39} + (y >> 15)) & {0x7FFFFFFF}) >> 3) & ((1::BIGINT << {left}) - 1)) AS x) FROM ({once})")
    return f"""
WITH RECURSIVE a AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
half AS (SELECT rid, unnest(string_split(hex(encode(t)), '')) AS h, unnest(range(2 * strlen(t))) AS k FROM a WHERE t <> ''),
lists AS (SELECT rid, list(instr('123456789ABCDEF', h)::BIGINT ORDER BY k // 2, k % 2 DESC) AS nibbles FROM half GROUP BY rid),
sums AS (SELECT rid, {crc32_sql('nibbles')} AS crc FROM lists),
d AS (
  SELECT doc_id, (strlen(t) + {sharding.ROW_BYTES})::BIGINT AS size, coalesce(crc, 0)::BIGINT AS text_crc32, count(*) OVER () AS n,
         row_number() OVER (ORDER BY doc_id NULLS FIRST, coalesce(crc, 0), strlen(t)) - 1 AS row_number
  FROM a LEFT JOIN sums USING (rid)),
walk AS (
  SELECT row_number, row_number AS x, n, greatest(2, length(bin(n - 1))) // 2 AS small,
         greatest(2, length(bin(n - 1))) - greatest(2, length(bin(n - 1))) // 2 AS large, 0 AS step FROM d
  UNION ALL SELECT * REPLACE (step + 1 AS step) FROM ({once}))
SELECT doc_id, size, text_crc32, 'rows' AS law, (x % {shards})::INTEGER AS shard, (x // {shards})::BIGINT AS slot,
       NULL::INTEGER AS grown_shard, row_number
FROM d JOIN (SELECT row_number, x FROM walk WHERE step > 0 AND x < n) USING (row_number)
"""


def pii_sql() -> str:
    """Plain patterns (this engine's words end at \\b), places by sums over all
    pieces before a match."""
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]", "iban": r"\b[A-Z]{2}[0-9]{2}(\x20?[A-Z0-9]){11,30}\b",
        "passport": r"\b[A-Z]{1,2}[0-9]{6,8}\b", "shortcard": r"[0-9]([\x20-]?[0-9])+", "ssn": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b"}
    luhn = ("list_sum(list_transform(range(length(d)), lambda i: CASE WHEN i % 2 = 0 THEN d[length(d) - i]::INT "
            "WHEN d[length(d) - i]::INT > 4 THEN 2 * d[length(d) - i]::INT - 9 ELSE 2 * d[length(d) - i]::INT END)) % 10 = 0")
    turned = "regexp_replace(m, ' ', '', 'g')"
    spelled = (f"string_split(array_to_string(list_transform(string_split(substr({turned}, 5) || substr({turned}, 1, 4), ''), "
               "lambda c: CASE WHEN c >= 'A' THEN (ascii(c) - 55)::VARCHAR ELSE c END), ''), '')")
    rule = {
        "email": "true", "ip": "list_max(list_transform(string_split(m, '.'), lambda p: CASE WHEN length(ltrim(p, '0')) > 3 THEN 256 ELSE right('000' || p, 3)::INT END)) <= 255",
        "card": f"length(d) BETWEEN 16 AND 19 AND {luhn}", "phone": "length(d) BETWEEN 8 AND 15",
        "iban": f"list_reduce(list_transform({spelled}, lambda c: c::INT), lambda a, c: (a * 10 + c) % 97) = 1",
        "passport": "true", "shortcard": f"length(d) BETWEEN 13 AND 15 AND {luhn}", "ssn": "true"}
    parts = []
    for n, k in enumerate(pii.KINDS):
        words = "|".join(k.words)
        parts.append(f"""
  SELECT rid, {n} AS k, '{k.name}' AS kind, {k.base} AS base, pos, pos + length(m) AS upto, least(1.0, {k.score} + CASE WHEN said THEN {pii.CONTEXT} ELSE 0 END) AS score
  FROM (SELECT rid, m, d, list_sum(list_transform(range(i + 1), lambda j: length(b[j + 1]))) + coalesce(list_sum(list_transform(range(i), lambda j: length(f[j + 1]))), 0) AS pos,
               regexp_matches(lower(right(b[i + 1], {pii.NEAR}) || ' ' || left(b[i + 2], {pii.NEAR})), '(^|[^a-z])({words})') AS said
        FROM (SELECT rid, f, b, i, f[i + 1] AS m, regexp_replace(f[i + 1], '[^0-9]', '', 'g') AS d
              FROM (SELECT rid, f, b, unnest(range(len(f))) AS i
                    FROM (SELECT rid, regexp_extract_all(t, '{plain[k.name]}', 0) AS f, regexp_split_to_array(t, '{plain[k.name]}') AS b FROM t))))
  WHERE ({rule[k.name]}) AND ({k.base} OR {k.score} + CASE WHEN said THEN {pii.CONTEXT} ELSE 0 END >= {pii.KEEP})""")
    counts = ", ".join(f"count(*) FILTER (kind = '{k.name}') AS n_{k.name}" for k in pii.KINDS if k.base)
    line = "kind || ':' || pos || ':' || upto"
    return f"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
s AS ({" UNION ALL ".join(parts)})
SELECT doc_id, {counts}, sha256(coalesce(string_agg({line}, ',' ORDER BY k, pos) FILTER (base), '')) AS base_sha256,
       coalesce(string_agg({line}, ',' ORDER BY k, pos), '') AS spans, coalesce(max(score), 0)::DOUBLE AS score
FROM t LEFT JOIN s USING (rid) GROUP BY rid, doc_id
"""


def all_sql() -> dict[str, str]:
    return {
        "op1_licenses": licenses_sql(),
        "op4_decontamination": decontamination_sql(),
        "op5_quality": quality_sql(),
        "op7_near_dedup": near_dedup_sql(),
        "op10_sharding": sharding_sql(),
        "op13_pii": pii_sql(),
    }
