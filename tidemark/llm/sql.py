"""DuckDB SQL for the queries that SQL can express; the others are tested against plain versions.

LM scores, trees and ordinal regression are trained, BPE merging and MinHash
retrieval are loops, and SimHash needs a hash that DuckDB does not have.
"""

from __future__ import annotations

from tidemark.llm import (
    chat_format,
    credentials,
    decontamination,
    fill_middle,
    merkle,
    mixing,
    quality,
)

_WORD = r"[^\x20\x09-\x0D]+"
_WORD_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _either_case(pattern: str) -> str:
    """The keywords of the assignment pattern with both cases spelled out."""
    words = pattern.removeprefix("(?i)")
    begin, _, rest = words.partition(")")
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in begin) + ")" + rest


def _spans(kind: str, pattern: str, keep: str, group: str = "m") -> str:
    """Finds of one pattern as rows of rid, start, end and kind."""
    p = _quoted(pattern)
    second = f"regexp_extract_all(t, {p}, 2)" if group == "v" else "m"
    return f"""
    SELECT rid, s AS "start", s + length(x) AS "end", {kind} AS kind FROM (
      SELECT rid, unnest(m) AS x, unnest(v) AS value,
             unnest(list_transform(range(1, len(m) + 1), lambda i:
               CAST(list_sum(list_transform(g[1:i], lambda y: length(y)))
               + coalesce(list_sum(list_transform(m[1:i-1], lambda y: length(y))), 0) AS BIGINT))) AS s
      FROM (SELECT rid, m, {second} AS v, string_split_regex(t, {p}) AS g
            FROM (SELECT rid, t, regexp_extract_all(t, {p}) AS m FROM d) WHERE len(m) > 0)
    ) WHERE {keep}"""


_TOKEN_KIND = f"""CASE
      WHEN regexp_matches(x, '{credentials.IDENTIFIER}') AND regexp_matches(x, '[0-9]') AND regexp_matches(x, '[A-Z]')
        THEN 3
      WHEN regexp_matches(x, '[a-z]')
           AND (regexp_matches(x, '[0-9]') OR regexp_matches(x, '[A-Z]') AND length(x) >= {credentials._LETTERS})
        OR regexp_matches(x, '{credentials.UUID}') THEN 4 END"""

_ROLES = "[1, 0, 1, 0, 1, 2]"

OP1 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
p AS (
  {_spans("0", _either_case(credentials.ASSIGN), "length(value) >= 6", "v")}
  UNION ALL {_spans("1", credentials.ACCESS, "true")}
  UNION ALL {_spans("2", credentials.HEX, "true")}
  UNION ALL {_spans(_TOKEN_KIND, credentials.TOKEN, "kind IS NOT NULL")}
  UNION ALL {_spans("5", credentials.ENDPOINT, "true")}
),
k AS (
  SELECT * FROM p WHERE kind < 3
  UNION ALL
  SELECT * FROM p WHERE kind >= 3
    AND NOT EXISTS (SELECT 1 FROM p q WHERE q.rid = p.rid AND (q.kind < 3 OR q.kind = 5 AND p.kind < 5)
      AND abs(q."start" - p."start") <= {credentials.SCOPE} AND q."start" < p."end" AND p."start" < q."end")
    AND EXISTS (SELECT 1 FROM p q WHERE q.rid = p.rid
      AND ({_ROLES})[q.kind + 1] <> ({_ROLES})[p.kind + 1] AND abs(q."start" - p."start") <= {credentials.SCOPE}
      AND NOT (q."start" < p."end" AND p."start" < q."end"))
),
w AS (
  SELECT rid, kind, "start", ({credentials.KINDS})[kind + 1] || ':' || "start" || ':' || "end" AS span FROM k
),
g AS (
  SELECT rid, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
         count(*) FILTER (kind = 2) AS n_hex,
         string_agg(span, ',' ORDER BY "start", kind) FILTER (kind < 3) AS base,
         string_agg(span, ',' ORDER BY "start", kind) AS spans
  FROM w GROUP BY rid
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (rid)"""


def _windows(table: str) -> str:
    return f"regexp_extract_all({_LOWER.format(table)}, '{_WORD_WORD}')"


OP2 = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, {_windows("coalesce(text, '')")} AS w FROM documents
),
b AS (
  SELECT item_id, w, least(len(w), {decontamination.WIDTH}) AS n
  FROM (SELECT item_id, {_windows("text")} AS w FROM benchmark WHERE text IS NOT NULL) WHERE len(w) > 0
),
bw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS key
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM b)
),
dw AS (
  SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS key
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d JOIN (SELECT DISTINCT n FROM bw) s ON len(w) >= n)
),
h AS (SELECT rid, n, i, CAST(item_id AS VARCHAR) AS item FROM dw JOIN bw USING (n, key)),
c AS (SELECT rid, count(DISTINCT place) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS place FROM h) GROUP BY rid),
g AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT rid, item FROM h WHERE item IS NOT NULL) GROUP BY rid
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (rid) LEFT JOIN g USING (rid)"""


OP3 = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS BIGINT) AS size,
         CAST('0x' || substr(md5('{mixing.SEED}|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS shuffle
  FROM documents
),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) AS source_no,
         ({list(mixing.WEIGHTS)})[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)}] AS weight
  FROM d GROUP BY source
),
-- Sources by how soon they are full; the level once the first k are full.
f AS (
  SELECT *, {mixing.REPEAT} * source_size AS most,
         row_number() OVER (ORDER BY source_size / weight, source_no) AS k FROM s
),
l AS (
  SELECT k, most, weight,
         (CAST((SELECT sum(source_size) FROM s) AS BIGINT)
           - coalesce(CAST(sum(most) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0))
         / CAST(sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS level
  FROM f
),
v AS (SELECT level FROM l WHERE weight * level <= most ORDER BY k LIMIT 1),
t AS (
  SELECT source, source_no, source_size, CAST(least(weight * level, CAST(most AS DOUBLE)) AS DOUBLE) AS target
  FROM f, v
),
q AS (
  SELECT rid, doc_id, size, shuffle, source_no, source_size, target,
         sum(size) OVER (PARTITION BY source_no ORDER BY shuffle, size, rid ROWS UNBOUNDED PRECEDING) AS done
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
),
c AS (
  SELECT rid, size, ((p - 1) * source_size + done) / target AS finish, source_no, shuffle, p
  FROM q, range(1, {mixing.REPEAT + 1}) AS r(p) WHERE size > 0
),
o AS (
  SELECT rid, sum(size) OVER (ORDER BY finish, source_no, shuffle, size, rid, p ROWS UNBOUNDED PRECEDING) AS run FROM c
),
n AS (
  SELECT rid, count(*) AS copies FROM o WHERE run <= (SELECT sum(source_size) FROM s) GROUP BY rid
)
SELECT doc_id, size, source_size, target, CAST(coalesce(copies, 0) * size AS BIGINT) AS taken
FROM q LEFT JOIN n USING (rid)"""


_MEASURES = [*quality.STEPS, quality.LENGTH]


def _quantiles(measure: str) -> str:
    at = ", ".join(f"list_sort(list({measure}))[CAST(ceil({q} * count(*)) AS BIGINT)]" for q in quality.QUANTILES)
    return f"[{at}] AS {measure}"


def _drawn(own: str, wider: str) -> str:
    """Quantiles of one table drawn towards those of a wider one."""
    return ", ".join(
        f"list_transform(range(1, {len(quality.QUANTILES) + 1}), lambda i: ({own}.{m}[i] * {own}.n"
        f" + {wider}.{m}[i] * {quality.PRIOR}) / ({own}.n + {quality.PRIOR})) AS {m}"
        for m in _MEASURES
    )


def _bodies() -> str:
    """One table per quantile: how far the body of each ratio reaches by then."""
    made, last = [], "b1"
    firsts = ", ".join(f"{m}[2] AS end_{m}" for m in quality.STEPS)
    made.append(f"b1 AS (SELECT *, {firsts} FROM g)")
    for i in range(3, len(quality.QUANTILES) + 1):
        ends = ", ".join(
            f"CASE WHEN {m}[{i}] <= end_{m} * {quality.REACH} + {step} THEN {m}[{i}] ELSE end_{m} END AS end_{m}"
            for m, step in quality.STEPS.items()
        )
        made.append(f"b{i - 1} AS (SELECT * REPLACE ({ends}) FROM {last})")
        last = f"b{i - 1}"
    bounds = ", ".join(f"end_{m} * {quality.REACH} + {step} AS max_{m}" for m, step in quality.STEPS.items())
    q = quality.LENGTH
    made.append(
        f"""f AS (
  SELECT lang, source, {bounds}, {q}[1] - ({q}[2] - {q}[1]) * {quality.SPREAD} AS min_{q},
         {q}[8] + ({q}[8] - {q}[2]) * {quality.SPREAD} AS max_{q}
  FROM {last}
)"""
    )
    return ",\n".join(made)


OP7 = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, t, regexp_extract_all(t, '{_WORD}') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines
  FROM (SELECT *, coalesce(text, '') AS t FROM documents)
),
x AS (SELECT rid, i, array_to_string(w[i:i + 2], ' ') AS key
      FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
r AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, key) AS n FROM x),
c AS (SELECT rid, count(DISTINCT place) AS n_repeat_words
      FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS place FROM r WHERE n > 1) GROUP BY rid),
m AS (
  SELECT doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
         length(array_to_string(w, '')) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words,
         length(t) - length(replace(t, '!', '')) AS shouts, len(lines) AS n_lines
  FROM d LEFT JOIN c USING (rid)
),
a AS (
  SELECT *, coalesce(n_symbols / nullif(word_chars, 0), 0) AS symbol_ratio,
         coalesce(shouts / nullif(n_words, 0), 0) AS shout_ratio,
         coalesce(n_dup_lines / nullif(n_lines, 0), 0) AS dup_line_ratio,
         coalesce(n_repeat_words / nullif(n_words, 0), 0) AS repeat_ratio,
         coalesce(word_chars / nullif(n_words, 0), 0) AS mean_length,
         n_words < {quality.MIN_WORDS} OR n_repeat_words * 100 > n_words * {quality.MAX_REPEAT_PERCENT} AS base_failed
  FROM m
),
qs AS (
  SELECT lang, source, count(*) AS n, {", ".join(map(_quantiles, _MEASURES))}
  FROM a WHERE NOT base_failed GROUP BY lang, source
),
ql AS (SELECT lang, count(*) AS n, {", ".join(map(_quantiles, _MEASURES))} FROM a WHERE NOT base_failed GROUP BY lang),
qc AS (SELECT count(*) AS n, {", ".join(map(_quantiles, _MEASURES))} FROM a WHERE NOT base_failed),
l AS (SELECT ql.lang, {_drawn("ql", "qc")} FROM ql CROSS JOIN qc),
g AS (
  SELECT qs.lang, qs.source, {_drawn("qs", "l")} FROM qs JOIN l ON qs.lang IS NOT DISTINCT FROM l.lang
),
{_bodies()}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       coalesce(NOT base_failed AND {" AND ".join(f"{k} <= max_{k}" for k in _MEASURES)}
                AND {quality.LENGTH} >= min_{quality.LENGTH}, false) AS kept
FROM a LEFT JOIN f ON a.lang IS NOT DISTINCT FROM f.lang AND a.source IS NOT DISTINCT FROM f.source"""


def _head(group: int) -> str:
    return f"CAST('0x' || substr(x, {8 * group + 1}, 8) AS BIGINT)"


_SHA_KEY = f"sha256('{fill_middle.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), ''))"
_MARKED = " AND ".join(f"NOT contains(t, '{m}')" for m in ("<P>", "<S>", "<M>"))

OP11 = f"""
WITH d AS (
  SELECT doc_id, t, x, len(u) AS n, u
  FROM (SELECT doc_id, coalesce(text, '') AS t, {_SHA_KEY} AS x,
               regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
        FROM documents)
),
c AS (
  SELECT doc_id, t, n, u,
         least({_head(0)} % (n + 1), {_head(1)} % (n + 1)) AS a,
         greatest({_head(0)} % (n + 1), {_head(1)} % (n + 1)) AS b,
         CASE WHEN t <> '' AND {_MARKED} AND {_head(2)} % 100 < {fill_middle.FIM_PERCENT}
              THEN CASE WHEN {_head(3)} % 100 < {fill_middle.SPM_PERCENT} THEN 'spm' ELSE 'psm' END
              ELSE 'plain' END AS form
  FROM d
),
p AS (
  SELECT doc_id, t, n, form, coalesce(array_to_string(u[1:a], ''), '') AS prefix,
         coalesce(array_to_string(u[a + 1:b], ''), '') AS middle,
         coalesce(array_to_string(u[b + 1:n], ''), '') AS suffix
  FROM c
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN t ELSE prefix || middle || suffix END) AS restored_sha256
FROM p"""


def _escape(text: str) -> str:
    return f"regexp_replace({text}, {_quoted(chat_format.CONTROL)}, '\\1\\\\\\2\\3', 'g')"


_MARK = (
    "CASE role "
    + " ".join(f"WHEN '{role}' THEN '{mark}'" for role, mark in chat_format.MARKS.items())
    + f" ELSE '{chat_format.ROLE_MARK}' || "
    + _escape("replace(replace(role, '\\', '\\\\'), chr(10), '\\n')")
    + " || chr(10) END"
)

OP12 = f"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
),
g AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn, role, t) AS turns,
         coalesce(string_agg(t, '' ORDER BY turn, t) FILTER (role = '{chat_format.LOSS_ROLE}'), '') AS loss,
         '{chat_format.BEGIN}' || string_agg({_MARK} || {_escape("t")} || '{chat_format.END}', '') AS formatted
  FROM r GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       length(formatted) AS formatted_chars
FROM g"""


# So many levels are written out: enough for 16 ** 6 documents of a source and 16 ** 3 sources.
_ROW_LEVELS, _SOURCE_LEVELS = 6, 3


def _up(table: str, levels: int) -> str:
    """Tables <table>1, <table>2, ... of the nodes (g, i, h) over those of <table>0; single ones stay."""
    made = []
    for k in range(levels):
        made.append(
            f"""{table}{k + 1} AS (
  SELECT g, i // {merkle.FAN_OUT} AS i,
         CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE any_value(h) END AS h
  FROM (SELECT g, i, h, count(*) OVER (PARTITION BY g) AS n FROM {table}{k})
  GROUP BY g, i // {merkle.FAN_OUT}
)"""
        )
    return ",\n".join(made)


def _siblings(table: str, level: int) -> str:
    """Those before and after each node of a level; null for a single node."""
    window = f"OVER (PARTITION BY g, i // {merkle.FAN_OUT} ORDER BY i ROWS BETWEEN"
    return f"""{table}{level}s AS (
  SELECT g, i, CASE WHEN n > 1 THEN coalesce(b, '') END AS b, CASE WHEN n > 1 THEN coalesce(a, '') END AS a
  FROM (SELECT g, i, count(*) OVER (PARTITION BY g) AS n,
               string_agg(h, '') {window} UNBOUNDED PRECEDING AND 1 PRECEDING) AS b,
               string_agg(h, '') {window} 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS a
        FROM {table}{level})
)"""


def _fold(begin: str, table: str, levels: int, group: str, index: str) -> tuple[str, list[str]]:
    """Proofs and folds of ``begin`` (with proof and node) through all levels of a table."""
    made, last = [], begin
    for k in range(levels):
        name = f"{begin}_{table}{k}"
        made.append(
            f"""{name} AS (
  SELECT {last}.* REPLACE (proof || coalesce(s.b || s.a, '') AS proof,
         CASE WHEN s.b IS NULL THEN node ELSE sha256(s.b || node || s.a) END AS node)
  FROM {last} JOIN {table}{k}s s ON s.g = {group} AND s.i = {index} // {merkle.FAN_OUT**k}
)"""
        )
        last = name
    return last, made


def _leaf(text: str) -> str:
    values = [f"CAST({c} AS VARCHAR)" for c in ("doc_id", "source", "lang", "n_chars")] + [text]
    return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"


# An unsigned crc32, bit by bit: an exclusive-or with each byte, then eight shifts.
_CRC = """xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(range(1, length(k) + 1),
      lambda p: [CAST(ascii(substr(k, p, 1)) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"""

_FOLDED, _FOLDS = _fold("l", "r", _ROW_LEVELS, "l_g", "l_i")
_ROOTED, _ROOTS = _fold(_FOLDED, "s", _SOURCE_LEVELS, "0", "(l_g - 1)")

OP13 = f"""
WITH d AS (
  SELECT doc_id, {_leaf("text")} AS leaf, {_leaf(_LOWER.format("text"))} AS lowered,
         dense_rank() OVER (ORDER BY source NULLS FIRST) AS g, CAST(doc_id AS VARCHAR) AS k
  FROM documents
),
e AS (
  SELECT doc_id, leaf, g, CASE WHEN k IS NOT NULL AND {_CRC} % 5 = 0 THEN lowered ELSE leaf END AS seen,
         row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i
  FROM d
),
r0 AS (SELECT g, i, leaf AS h FROM e),
{_up("r", _ROW_LEVELS)},
s0 AS (SELECT 0 AS g, g - 1 AS i, h FROM r{_ROW_LEVELS}),
{_up("s", _SOURCE_LEVELS)},
{", ".join(_siblings("r", k) for k in range(_ROW_LEVELS))},
{", ".join(_siblings("s", k) for k in range(_SOURCE_LEVELS))},
l AS (SELECT doc_id, leaf, g AS l_g, i AS l_i, '' AS proof, seen AS node FROM e),
{", ".join(_FOLDS + _ROOTS)}
SELECT doc_id, leaf, r{_ROW_LEVELS}.h AS subroot, top.h AS root, sha256(proof) AS proof_sha256,
       node AS folded_root, node = top.h AS verified
FROM {_ROOTED} JOIN r{_ROW_LEVELS} ON r{_ROW_LEVELS}.g = l_g CROSS JOIN s{_SOURCE_LEVELS} top"""

SQL = {
    "op1_secrets": OP1,
    "op2_decontamination": OP2,
    "op3_mixing": OP3,
    "op7_quality": OP7,
    "op11_fill_middle": OP11,
    "op12_chat_format": OP12,
    "op13_merkle": OP13,
}
