"""DuckDB SQL for the operators that SQL can express, over the same tables."""

from __future__ import annotations

from .mixing import BLOCK_ROWS, OTHER_WEIGHT, WEIGHTS

SHARDS = 24
#: Words are runs of anything but these.
BLANKS = r"[ \t\n\x0B\f\r]+"


def _crc_table() -> str:
    entries = []
    for n in range(256):
        for _ in range(8):
            n = (n >> 1) ^ (0xEDB88320 if n & 1 else 0)
        entries.append(n)
    return "[" + ", ".join(map(str, entries)) + "]::BIGINT[]"


def _number(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 13) AS BIGINT)"


def sharding() -> str:
    key = "coalesce(CAST(doc_id AS VARCHAR), 'text:' || md5(coalesce(text, '')))"
    score = f"1.0 / -ln(({_number("key || ':' || shard")} + 0.5) / 4503599627370496.0)"
    return f"""WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS body, {key} AS key FROM documents
),
scores AS (
  SELECT row, shard, {score} AS score FROM docs, (SELECT unnest(range({SHARDS + 1})) AS shard) s
),
won AS (
  SELECT row, arg_max(shard, struct_pack(score, shard)) FILTER (WHERE shard < {SHARDS}) AS shard,
         max(score) FILTER (WHERE shard < {SHARDS}) AS best, max(score) FILTER (WHERE shard = {SHARDS}) AS more
  FROM scores GROUP BY row
),
bytes AS (
  SELECT row, list_transform(range(1, 2 * strlen(body), 2), lambda i: CAST('0x' || substr(hex(encode(body)), i, 2) AS BIGINT)) AS b FROM docs
),
tab AS MATERIALIZED (SELECT {_crc_table()} AS t),
crc AS (
  SELECT row, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), b),
         lambda c, x: xor(c >> 8, t[CAST(xor(c, x) & 255 AS INTEGER) + 1])), 4294967295) AS crc FROM bytes, tab
)
SELECT doc_id, CAST(strlen(body) + 8 AS BIGINT) AS size, crc AS text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY {_number("key")}, doc_id NULLS FIRST, strlen(body), crc) - 1 AS slot,
       CAST(CASE WHEN more > best THEN {SHARDS} ELSE shard END AS INTEGER) AS grown_shard
FROM docs JOIN won USING (row) JOIN crc USING (row)"""


def near_duplicates() -> str:
    lower = f"translate(text, '{'ABCDEFGHIJKLMNOPQRSTUVWXYZ'}', '{'abcdefghijklmnopqrstuvwxyz'}')"
    return f"""WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array({lower}, '{BLANKS}'), lambda w: w <> '') AS w FROM documents WHERE text IS NOT NULL
),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: list_aggregate(w[i:i + 4], 'string_agg', ' '))
                                      WHEN len(w) > 0 THEN [list_aggregate(w, 'string_agg', ' ')] ELSE [] END) AS s FROM words
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * shared.n >= 75 * (x.n + y.n - shared.n)
),
pairs AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT reached.doc_id, pairs.b FROM reached JOIN pairs ON pairs.a = reached.other
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) r LEFT JOIN sizes USING (doc_id)"""


def chat() -> str:
    def escaped(text: str) -> str:
        return rf"regexp_replace({text}, '<(\\*)\|', '<\\\1|', 'g')"

    line = escaped(r"replace(replace(role, '\', '\\'), chr(10), '\n')")
    return f"""WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('<|im_start|>') + length({line}) + 1 + length({escaped('text')}) + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id"""


def mixing() -> str:
    parts = [*WEIGHTS.values(), OTHER_WEIGHT]
    period, n = sum(parts), len(parts)
    stream = "CASE source " + " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(WEIGHTS)) + f" ELSE {n - 1} END"
    return f"""WITH RECURSIVE weights AS MATERIALIZED (SELECT {parts}::BIGINT[] AS p),
schedule AS (
  -- Of the blocks whose release has come, the one with the earliest deadline; each slot has exactly one.
  SELECT -1 AS slot, list_transform(range({n}), lambda i: CAST(0 AS BIGINT)) AS before, -1 AS stream, list_transform(range({n}), lambda i: CAST(0 AS BIGINT)) AS had
  UNION ALL
  SELECT slot + 1, had, pick, list_transform(range(1, {n + 1}), lambda i: had[i] + CASE WHEN i = pick + 1 THEN 1 ELSE 0 END)
  FROM (
    SELECT slot, had, CAST(list_min(list_transform(list_filter(range(1, {n + 1}), lambda i: had[i] * {period} // p[i] <= slot + 1),
           lambda i: ((had[i] + 1) * {period} + p[i] - 1) // p[i] * 100000 + i)) % 100000 - 1 AS INTEGER) AS pick
    FROM schedule, weights WHERE slot + 1 < {period}
  ) s
),
turns AS (SELECT slot, stream, before[stream + 1] AS turn FROM schedule WHERE slot >= 0),
docs AS (
  SELECT doc_id, source, {stream} AS stream,
         row_number() OVER (PARTITION BY {stream} ORDER BY {_number("coalesce(CAST(doc_id AS VARCHAR), 'null')")}, doc_id NULLS FIRST) - 1 AS i
  FROM documents
),
placed AS (
  SELECT doc_id, source, docs.stream, i, i // {BLOCK_ROWS} AS block, i // {BLOCK_ROWS} // p[docs.stream + 1] * {period} + slot AS slot
  FROM docs, weights, turns WHERE turns.stream = docs.stream AND turns.turn = (i // {BLOCK_ROWS}) % p[docs.stream + 1]
)
SELECT doc_id, source, CAST(stream AS INTEGER) AS stream, block, CAST(slot AS BIGINT) AS slot, row_number() OVER (ORDER BY slot, i) - 1 AS position
FROM placed"""


#: Constants of the quality rules, written out here so that a wrong value shows: counts of each ratio, slack.
FENCED = {
    "symbol_ratio": ("n_symbols", "n_words", 0.10), "mark_ratio": ("n_marks", "n_words", 0.15), "upper_ratio": ("n_upper", "word_chars", 0.10),
    "dup_line_ratio": ("n_dup_lines", "n_lines", 0.50), "repeat_ratio": ("n_repeat_words", "n_words", 0.40), "word_length": ("word_chars", "n_words", 3.0),
}


def rules() -> str:
    base = "(n_words < 50 OR 100 * n_repeat_words > 50 * n_words)"
    chars = {"n_symbols": r"[#*$%&|<>]", "n_marks": r"[!?;:=\\/{}\[\]()_^~+\"''@`]", "n_upper": "[A-Z]"}
    counted = ", ".join(f"length(regexp_replace(body, '{p}', 'xx', 'g')) - length(body) AS {c}" for c, p in chars.items())
    ratios = ", ".join(f"CASE WHEN {b} > 0 THEN CAST({a} AS DOUBLE) / {b} ELSE 0.0 END AS {r}" for r, (a, b, _) in FENCED.items())

    def level(keys: str, suffix: str) -> str:
        def q(r: str, p: float) -> str:
            return f"(quantile_disc({r}, {p}) FILTER (WHERE NOT base_failed))"

        fences = ", ".join(
            f"{q(r, 0.25)} + {slack} + 8.0 * ({q(r, 0.25)} - {q(r, 0.05)}) AS {r}{suffix}, "
            f"{q(r, 0.5)} + 6.0 * {slack} + 4.0 * ({q(r, 0.75)} - {q(r, 0.25)}) AS {r}_loose{suffix}"
            for r, (_, _, slack) in FENCED.items()
        )
        return f"SELECT {keys + ', ' if keys else ''}count(*) FILTER (WHERE NOT base_failed) AS n{suffix}, {fences} FROM rated {'GROUP BY ' + keys if keys else ''}"

    def limit(r: str) -> str:
        def wide(x: str) -> str:
            return f"CASE WHEN n1 >= 50 THEN {x}1 ELSE {x}2 END"

        loose = f"CASE WHEN sources >= 3 THEN {r}_middle ELSE {wide(r + '_loose')} END"
        return f"coalesce(least(CASE WHEN n0 >= 50 THEN {r}0 ELSE {wide(r)} END, {loose}), 'inf'::DOUBLE)"

    reason = "CASE WHEN base_failed THEN 'base' " + " ".join(f"WHEN {r} > {limit(r)} THEN '{r}'" for r in FENCED) + " END"
    return f"""WITH docs AS (SELECT doc_id, coalesce(lang, '\x01') AS lang, coalesce(source, '\x01') AS source, coalesce(text, '') AS body FROM documents),
words AS (SELECT doc_id, list_filter(regexp_split_to_array(body, '{BLANKS}'), lambda w: w <> '') AS w FROM docs),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS times
  FROM (SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words) x) y
),
marked AS (
  SELECT doc_id, count(*) AS n_repeat_words FROM (SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) FROM windows WHERE times > 1) x GROUP BY doc_id
),
lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(body, chr(10))) AS line FROM docs) x WHERE regexp_matches(line, '[^ \\t\\n\\x0B\\f\\r]') GROUP BY doc_id
),
counts AS (
  SELECT doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         {counted}, coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM docs JOIN words USING (doc_id) LEFT JOIN marked USING (doc_id) LEFT JOIN lines USING (doc_id)
),
rated AS (SELECT *, {base} AS base_failed, {ratios} FROM counts),
own AS ({level('lang, source', '0')}), wide AS ({level('lang', '1')}), every AS ({level('', '2')}),
middle AS (SELECT lang, count(*) AS sources, {", ".join(f"quantile_disc({r}_loose0, 0.5) AS {r}_middle" for r in FENCED)} FROM own WHERE n0 >= 50 GROUP BY lang),
judged AS (SELECT rated.*, {reason} AS reason FROM rated JOIN own USING (lang, source) JOIN wide USING (lang) LEFT JOIN middle USING (lang), every)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, reason IS NULL AS kept, reason FROM judged"""


def resampling() -> str:
    upper = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    found = f"regexp_extract_all(coalesce({upper}, ''), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""WITH tab AS MATERIALIZED (SELECT {_crc_table()} AS t),
texts AS (
  SELECT row_number() OVER () AS row, doc_id, {found} AS w FROM documents
  UNION ALL SELECT NULL, NULL, {found} FROM benchmark
),
used AS (SELECT row, unnest(w) AS word FROM texts),
bytes AS (
  SELECT word, list_transform(range(1, 2 * strlen(word), 2), lambda i: CAST('0x' || substr(hex(encode(word)), i, 2) AS BIGINT)) AS b
  FROM (SELECT DISTINCT word FROM used) d
),
buckets AS (
  SELECT word, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), b),
         lambda c, x: xor(c >> 8, t[CAST(xor(c, x) & 255 AS INTEGER) + 1])), 4294967295) % 10000 AS bucket FROM bytes, tab
),
cells AS (SELECT row, bucket, count(*) AS n FROM used JOIN buckets USING (word) GROUP BY ALL),
totals AS (
  SELECT CAST(coalesce(sum(n) FILTER (WHERE row IS NOT NULL), 0) AS DOUBLE) AS s_all, CAST(coalesce(sum(n) FILTER (WHERE row IS NULL), 0) AS DOUBLE) AS t_all
  FROM cells
),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000)))) AS BIGINT) AS gain
  FROM (SELECT bucket, CAST(coalesce(sum(n) FILTER (WHERE row IS NOT NULL), 0) AS DOUBLE) AS s, CAST(coalesce(sum(n) FILTER (WHERE row IS NULL), 0) AS DOUBLE) AS t
        FROM cells GROUP BY bucket) b, totals
),
weights AS (SELECT row, CAST(sum(n * gain) AS BIGINT) AS weight FROM cells JOIN gains USING (bucket) WHERE row IS NOT NULL GROUP BY row),
noise AS (
  SELECT row, doc_id, len(w) AS n_features, coalesce(weight, 0) AS weight,
         CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 8) AS BIGINT) AS h
  FROM texts LEFT JOIN weights USING (row) WHERE row IS NOT NULL
),
scores AS (
  SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM noise
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id, n_features) AS place,
         count(*) OVER (PARTITION BY n_features >= 20) AS n FROM scores
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank FROM ranked"""


def repairs() -> str:
    return f"""WITH RECURSIVE tab AS MATERIALIZED (SELECT {_crc_table()} AS t),
named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations
),
faulty AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, 2 * strlen(name), 2),
         lambda i: CAST('0x' || substr(hex(encode(name)), i, 2) AS BIGINT))), lambda c, x: xor(c >> 8, t[CAST(xor(c, x) & 255 AS INTEGER) + 1])), 4294967295) % 20 AS f
  FROM named, tab
),
damaged AS (
  SELECT conv_id, turn, CASE f WHEN 4 THEN 'user' ELSE role END AS role, CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE f WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM faulty
),
keyed AS (
  SELECT *, md5(strlen(role) || ':' || role || strlen(text) || ':' || text) AS same,
         md5(coalesce(length(CAST(conv_id AS VARCHAR)) || ':' || conv_id, 'null') || coalesce(length(CAST(turn AS VARCHAR)) || ':' || turn, 'null') || '32:' || upper(same)) AS key
  FROM damaged
),
sorted AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, key, copy) AS i FROM keyed),
marked AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^ \\t\\n\\x0B\\f\\r]') THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN NOT regexp_matches(text, '[.!?][ \\t\\n\\x0B\\f\\r]*$') THEN 'truncated' ELSE '' END AS fault,
         lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS earlier
  FROM sorted
),
counted AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
         count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE i > 1 AND substr(earlier, 1, 1) || substr(role, 1, 1) NOT IN ('su', 'ua', 'au')) AS illegal
  FROM marked GROUP BY conv_id
),
follows(a, b, role) AS (VALUES ('', 's', NULL), ('', 'u', 'user'), ('s', 'u', 'user'), ('u', 'a', 'assistant'), ('a', 'u', 'user')),
inserts AS (
  SELECT DISTINCT a, a AS b, '' AS letters, 0 AS cost, []::VARCHAR[] AS lines FROM (SELECT a FROM follows UNION ALL SELECT b FROM follows)
  UNION ALL SELECT a, b, 'I', 5, [role || ':'] FROM follows WHERE role IS NOT NULL
  UNION ALL SELECT x.a, y.b, 'II', 10, [x.role || ':', y.role || ':'] FROM follows x JOIN follows y ON x.b = y.a WHERE x.role IS NOT NULL
),
edits AS (
  SELECT conv_id, i, x.a, x.b, 'D' AS letter, 2 AS cost, []::VARCHAR[] AS lines FROM marked, (SELECT DISTINCT b AS a, b FROM inserts) x
  UNION ALL SELECT conv_id, i, a, b, 'K', CASE fault WHEN 'truncated' THEN 5 ELSE 0 END, [marked.role || ':' || text]
            FROM marked JOIN follows ON substr(marked.role, 1, 1) = b WHERE fault NOT IN ('blank', 'duplicate')
  UNION ALL SELECT conv_id, i, a, b, 'R', CASE fault WHEN 'truncated' THEN 6 ELSE 1 END, [follows.role || ':' || text]
            FROM marked JOIN follows ON follows.role IS NOT NULL WHERE fault NOT IN ('blank', 'duplicate')
),
steps AS (
  SELECT conv_id, i, x.a, y.b, min(struct_pack(cost := x.cost + y.cost, letters := x.letters || y.letter, lines := x.lines || y.lines)) AS s
  FROM inserts x JOIN edits y ON x.b = y.a GROUP BY ALL
),
best AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, '' AS st, 0 AS cost, '' AS audit, []::VARCHAR[] AS lines FROM counted
  UNION ALL
  SELECT conv_id, i, b, w.cost, w.audit, w.lines FROM (
    SELECT steps.conv_id, steps.i, steps.b, min(struct_pack(cost := best.cost + s.cost, audit := best.audit || s.letters, lines := best.lines || s.lines)) AS w
    FROM best JOIN steps ON best.conv_id IS NOT DISTINCT FROM steps.conv_id AND steps.i = best.i + 1 AND steps.a = best.st GROUP BY ALL
  ) x
),
ended AS (
  SELECT best.conv_id, min(struct_pack(cost := best.cost + x.cost, audit := best.audit || x.letters, lines := best.lines || x.lines)) AS w
  FROM best JOIN counted ON best.conv_id IS NOT DISTINCT FROM counted.conv_id AND i = n
  JOIN inserts x ON x.a = st AND (x.b = 'a' OR x.b = '') GROUP BY ALL
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(coalesce(w.cost, 0) AS BIGINT) AS cost, coalesce(w.audit, '') AS audit,
       sha256(coalesce(array_to_string(w.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id"""


ORACLE_SQL = {
    "op3_rendezvous_sharding": sharding(),
    "op5_minhash_near_dedup": near_duplicates(),
    "op7_prefix_tree_chat": chat(),
    "op8_pfair_mixing": mixing(),
    "op9_quality_rules": rules(),
    "op11_importance_resampling": resampling(),
    "op12_hirschberg_repair": repairs(),
}
