"""DuckDB SQL for the queries of this package that SQL can express.

Plain formulations over whole tables, independent of how the operators work: windows are
compared as text, ranks are global, and checksums go byte by byte.
"""

from __future__ import annotations

from . import adaptive_quality as q
from . import markov_secrets as m
from .tree_mix import Mix

OP4 = f"""
WITH w AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents),
starts AS (
  SELECT rid, i, array_to_string(words[i:i + {q.WINDOW - 1}], ' ') AS win
  FROM (SELECT rid, words, unnest(range(1, len(words) - {q.WINDOW - 2})) AS i FROM w WHERE len(words) >= {q.WINDOW})),
twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS n FROM starts) WHERE n > 1),
covered AS (
  SELECT rid, sum(n) AS n_repeat FROM (
    SELECT rid, least({q.WINDOW}, lead(i, 1, i + {q.WINDOW}) OVER (PARTITION BY rid ORDER BY i) - i) AS n FROM twice)
  GROUP BY rid),
lines AS (
  SELECT rid, list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM w),
counts AS (
  SELECT w.rid, doc_id, lang, source, len(words)::BIGINT AS n_words,
         coalesce(length(array_to_string(words, '')), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(body, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         len(regexp_extract_all(body, '\\p{{Lu}}'))::BIGINT AS n_capitals,
         len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat, 0)::BIGINT AS n_repeat_words
  FROM w JOIN lines USING (rid) LEFT JOIN covered USING (rid)),
ratios AS (
  {" UNION ALL ".join(
    f"SELECT rid, lang, source, '{x.name}' AS measure, {x.slack} AS slack, {str(x.low_side).lower()} AS low_side, "
    f"CASE WHEN {x.whole} > 0 THEN {x.part} * {x.scale} // {x.whole} ELSE 0 END AS v FROM counts" for x in q.MEASURES)}),
tops AS (
  SELECT *, v // unit * unit + unit - 1 AS top
  FROM (SELECT *, (1::BIGINT << greatest(length(bin(v)) - 7, 0)::INT) AS unit FROM ratios)),
ranked AS (
  SELECT *, count(*) OVER own AS n_own, count(*) OVER lng AS n_lng, count(*) OVER glb AS n_glb,
         count(*) OVER (own ORDER BY top) AS u_own, count(*) OVER (lng ORDER BY top) AS u_lng,
         count(*) OVER (glb ORDER BY top) AS u_glb
  FROM tops
  WINDOW own AS (PARTITION BY lang, source, measure), lng AS (PARTITION BY lang, measure),
         glb AS (PARTITION BY measure)),
own AS (SELECT lang, source, measure, any_value(slack) AS slack, any_value(low_side) AS low_side, max(n_own) AS n,
               min(top) FILTER (u_own * 4 >= n_own) AS q1, min(top) FILTER (u_own * 4 >= n_own * 3) AS q3
        FROM ranked GROUP BY ALL),
lng AS (SELECT lang, measure, max(n_lng) AS n, min(top) FILTER (u_lng * 4 >= n_lng) AS q1,
               min(top) FILTER (u_lng * 4 >= n_lng * 3) AS q3 FROM ranked GROUP BY ALL),
glb AS (SELECT measure, min(top) FILTER (u_glb * 4 >= n_glb) AS q1,
               min(top) FILTER (u_glb * 4 >= n_glb * 3) AS q3 FROM ranked GROUP BY ALL),
picked AS (
  SELECT own.lang, own.source, own.measure, slack, low_side,
         CASE WHEN own.n >= 200 THEN own.q1 WHEN lng.n >= 200 THEN lng.q1 ELSE glb.q1 END AS q1,
         CASE WHEN own.n >= 200 THEN own.q3 WHEN lng.n >= 200 THEN lng.q3 ELSE glb.q3 END AS q3
  FROM own JOIN lng ON own.lang IS NOT DISTINCT FROM lng.lang AND own.measure = lng.measure
           JOIN glb ON own.measure = glb.measure),
outside AS (
  SELECT rid, bool_or(v > q3 + 3 * (q3 - q1) + p.slack
                      OR (p.low_side AND v < q1 - 3 * (q3 - q1) - p.slack)) AS bad
  FROM ratios r JOIN picked p ON r.lang IS NOT DISTINCT FROM p.lang AND r.source IS NOT DISTINCT FROM p.source
                              AND r.measure = p.measure
  GROUP BY rid),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed
           FROM counts JOIN outside USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT bad AS kept
FROM judged
"""

OP5 = """
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, _:
           CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256))::BIGINT AS i)),
docs AS (
  SELECT row_number() OVER () AS rid, doc_id, encode(coalesce(text, '')) AS bytes FROM documents),
sums AS (
  SELECT rid, doc_id, octet_length(bytes) + 1 AS size,
         xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(
               regexp_extract_all(hex(bytes), '..'), lambda h: ('0x' || h)::BIGINT)),
             lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM docs, crc_table),
jump AS (
  SELECT rid, n, (CASE WHEN coalesce(doc_id, 0) < 0 THEN doc_id::HUGEINT + 18446744073709551616
                       ELSE coalesce(doc_id, 0)::HUGEINT END) AS k, -1::BIGINT AS b, 0::BIGINT AS j
  FROM docs, (SELECT unnest([8, 9]) AS n)
  UNION ALL
  SELECT rid, n, k2, j, floor((j + 1)::DOUBLE * (2147483648.0::DOUBLE / ((k2 >> 33) + 1)::DOUBLE))::BIGINT
  FROM (SELECT *, (k * 2862933555777941757 + 1) % 18446744073709551616 AS k2 FROM jump WHERE j < n)),
place AS (SELECT rid, max(b) FILTER (n = 8) AS shard, max(b) FILTER (n = 9) AS grown_shard FROM jump GROUP BY rid)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'key' AS law, shard::INT AS shard,
       (row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1)::BIGINT AS slot,
       grown_shard::INT AS grown_shard
FROM sums JOIN place USING (rid)
"""

_CRC_TABLE = """crc_table AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, _:
           CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256))::BIGINT AS i))"""


def op12(fields: tuple[str, ...], levels: int = 9, group_levels: int = 4) -> str:
    """Manifest of up to 8**levels rows a language and 8**group_levels languages: all trees
    level by level, then each leaf's siblings by its rank."""
    def encoded(text: str) -> str:
        parts = [text if f == "text" else f"{f}::VARCHAR" for f in fields]
        return " || ".join(f"CASE WHEN {x} IS NULL THEN '-' ELSE octet_length(encode({x})) || ':' || {x} END" for x in parts)

    def tree(name: str, by: str, base: str, depth: int) -> str:
        out = [f"{name}0 AS ({base})"]
        for k in range(depth):
            out.append(f"""{name}{k + 1} AS (
  SELECT {by}, i // 8 AS i, any_value((n + 7) // 8) AS n, list(h ORDER BY i) AS kids,
         CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h
  FROM {name}{k} GROUP BY {by}, i // 8)""")
        return ", ".join(out)

    def climb(source: str, name: str, by: str, rank: str, depth: int) -> str:
        """Adds the siblings and the folded digest level by level, from ``rank`` on."""
        for k in range(depth):
            at = f"({rank} // {8 ** k})"
            left = f"array_to_string(t{k}.kids[1:{at} % 8], '')"
            right = f"array_to_string(t{k}.kids[{at} % 8 + 2:], '')"
            source = f"""(SELECT d.* EXCLUDE (proof, f),
  CASE WHEN len(t{k}.kids) > 1 OR below{k}.n > 1 THEN d.proof || {left} || {right} ELSE d.proof END AS proof,
  CASE WHEN below{k}.n > 1 THEN sha256({left} || d.f || {right}) ELSE d.f END AS f
  FROM {source} d JOIN {name}{k + 1} t{k} ON t{k}.{by} IS NOT DISTINCT FROM d.{by} AND t{k}.i = {at} // 8
  JOIN {name}{k} below{k} ON below{k}.{by} IS NOT DISTINCT FROM d.{by} AND below{k}.i = {at})"""
        return source

    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    crc = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(
               regexp_extract_all(hex(encode(doc_id::VARCHAR)), '..'), lambda x: ('0x' || x)::BIGINT)),
             lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"""
    return f"""
WITH {_CRC_TABLE},
docs AS (SELECT doc_id, lang, sha256({encoded("text")}) AS h, coalesce({crc} % 3 = 0, false) AS hit,
                sha256({encoded(low)}) AS changed
         FROM documents, crc_table),
ordered AS (SELECT doc_id, lang, h, CASE WHEN hit THEN changed ELSE h END AS f,
                   row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS i,
                   count(*) OVER (PARTITION BY lang) AS n FROM docs),
{tree("l", "lang", "SELECT lang, i, n, h, NULL::VARCHAR[] AS kids FROM ordered", levels)},
subroots AS (SELECT true AS every, lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i,
                    count(*) OVER () AS n FROM l{levels}),
{tree("g", "every", "SELECT every, i, n, h, NULL::VARCHAR[] AS kids FROM subroots", group_levels)},
inside AS (SELECT * FROM {climb("(SELECT doc_id, lang, h AS leaf, i, f, '' AS proof FROM ordered)", "l", "lang", "d.i", levels)}),
placed AS (SELECT inside.*, s.every, s.i AS place, s.h AS subroot
           FROM inside JOIN subroots s ON inside.lang IS NOT DISTINCT FROM s.lang),
whole AS (SELECT * FROM {climb("placed", "g", "every", "d.place", group_levels)})
SELECT doc_id, leaf, subroot, (SELECT h FROM g{group_levels}) AS root, sha256(proof) AS proof_sha256,
       f AS folded_root, f = (SELECT h FROM g{group_levels}) AS verified
FROM whole
"""


OP6 = """
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
items AS (
  SELECT coalesce(item_id::VARCHAR, 'null') AS item, regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM benchmark),
wins AS (
  SELECT DISTINCT item, k, array_to_string(words[i:i + k - 1], ' ') AS win
  FROM (SELECT item, words, least(10, len(words)) AS k, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS i
        FROM items WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT k FROM wins),
grams AS (
  SELECT rid, k, i, array_to_string(words[i:i + k - 1], ' ') AS win
  FROM (SELECT rid, k, words, unnest(range(1, len(words) - k + 2)) AS i
        FROM docs JOIN sizes ON len(words) >= k)),
found AS (SELECT rid, i, grams.k, item FROM grams JOIN wins ON grams.win = wins.win AND grams.k = wins.k),
hit AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (
          SELECT DISTINCT rid, unnest(range(i, i + k)) AS p FROM found) GROUP BY rid),
ids AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
        FROM (SELECT DISTINCT rid, item FROM found) GROUP BY rid)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (rid) LEFT JOIN ids USING (rid)
"""


def _spans(kind: int, pattern: str) -> str:
    """Matches of a pattern with their starts, from the pieces between them."""
    p = pattern.replace("'", "''")
    return f"""
  SELECT rid, {kind} AS kind, hit, sum(length(piece) + length(hit)) OVER (PARTITION BY rid ORDER BY no) - length(hit) AS s
  FROM (SELECT rid, unnest(hits) AS hit, unnest(pieces[1:len(hits)]) AS piece, unnest(range(len(hits))) AS no
        FROM (SELECT rid, regexp_extract_all(body, '{p}') AS hits, regexp_split_to_array(body, '{p}') AS pieces
              FROM docs WHERE regexp_matches(body, '{p}')))"""


_CELL = "CASE WHEN ascii(c) < 128 THEN ascii(c) ELSE 0 END"

OP7 = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS body FROM documents),
found AS ({" UNION ALL ".join(_spans(k, p) for k, p in enumerate((m.ASSIGN, m.ACCESS, m.HEX, m.CANDIDATE)))}),
value AS (
  SELECT rid, kind, s, s + length(hit) AS e, CASE WHEN kind = 0
           THEN regexp_extract(hit, '{m.ASSIGN.replace("'", "''")}', 2) ELSE hit END AS v FROM found),
base AS (SELECT * FROM value WHERE length(v) >= [{m.ASSIGN_MIN}, {m.ACCESS_MIN}, {m.HEX_MIN}, 1000000000][kind + 1]),
apart AS (
  SELECT * FROM value c WHERE kind = 3 AND NOT EXISTS (
    SELECT 1 FROM base b WHERE b.rid = c.rid AND b.s < c.e AND c.s < b.e)),
samples AS (SELECT true AS random, v FROM base UNION ALL SELECT false, v FROM apart),
chars AS (SELECT random, no, unnest(string_split(v, '')) AS c, unnest(range(length(v))) AS pos
          FROM (SELECT *, row_number() OVER () AS no FROM samples WHERE length(v) > 1)),
pairs AS (SELECT random, lag(x) OVER (PARTITION BY no ORDER BY pos) AS a, x AS b
          FROM (SELECT random, no, pos, {_CELL} AS x FROM chars)),
counts AS (SELECT a, b, count(*) FILTER (random) AS r, count(*) FILTER (NOT random) AS o
           FROM pairs WHERE a IS NOT NULL GROUP BY a, b),
grid AS (SELECT a, b, coalesce(r, 0) AS r, coalesce(o, 0) AS o, sum(coalesce(r, 0)) OVER (PARTITION BY a) AS tr,
                sum(coalesce(o, 0)) OVER (PARTITION BY a) AS t_o
         FROM (SELECT unnest(range(128)) AS a) CROSS JOIN (SELECT unnest(range(128)) AS b) LEFT JOIN counts USING (a, b)),
ratio AS (
  SELECT a, b, CASE WHEN (SELECT sum(r) > 0 AND sum(o) > 0 FROM counts) THEN
           round({m._SCALE} * ((ln(r + 0.5) - ln(tr + 64.0)) - (ln(o + 0.5) - ln(t_o + 64.0)))) ELSE 0 END AS lr FROM grid),
scored AS (
  SELECT rid, s, e, sum(lr) AS score
  FROM (SELECT rid, s, e, lag(x) OVER (PARTITION BY rid, s ORDER BY pos) AS a, x AS b
        FROM (SELECT rid, s, e, pos, {_CELL} AS x
              FROM (SELECT rid, s, e, unnest(string_split(v, '')) AS c, unnest(range(length(v))) AS pos FROM apart)))
       JOIN ratio USING (a, b) GROUP BY rid, s, e),
secret AS (SELECT * FROM scored WHERE score >= {m.Scan().min_total} AND score >= (e - s - 1) * {m.Scan().min_per_pair}),
spans AS (SELECT rid, kind, s::BIGINT AS s, e::BIGINT AS e FROM base UNION ALL SELECT rid, 3, s::BIGINT, e::BIGINT FROM secret),
named AS (SELECT *, {list(m.KINDS)}[kind + 1] || ':' || s || ':' || e AS name FROM spans),
per_doc AS (
  SELECT rid, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
         count(*) FILTER (kind = 2) AS n_hex, string_agg(name, ',' ORDER BY s, kind) AS spans,
         string_agg(name, ',' ORDER BY s, kind) FILTER (kind < 3) AS base
  FROM named GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
       coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN per_doc USING (rid)
"""


def op8(mix: Mix, domain: str) -> str:
    """``domain``: SQL for a document's domain. The budget must be a share of all tokens."""
    weights = ", ".join(f"('{k}', {v})" for k, v in sorted(mix.weights.items()))

    def name(c: str) -> str:
        return f"coalesce(replace({c}, '/', '//'), '')"

    def level(i: int) -> str:
        """Shares of the nodes of level i within their parents' budgets."""
        parent = "(SELECT '' AS path, budget FROM total)" if i == 1 else f"share{i - 1}"
        return f"""
node{i} AS (
  SELECT p{i} AS path, any_value(p{i - 1}) AS parent, sum(capacity)::HUGEINT AS c,
         coalesce(any_value(w), {mix.default_weight})::HUGEINT AS w
  FROM leaves LEFT JOIN weights ON weights.path = p{i} GROUP BY p{i}),
fill{i} AS (
  SELECT *, greatest(budget - coalesce(sum(c) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0) AS room,
         sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_later
  FROM (SELECT n.*, p.budget::HUGEINT AS budget FROM node{i} n JOIN {parent} p ON n.parent = p.path
        WHERE n.c > 0 AND n.w > 0)
  WINDOW o AS (PARTITION BY parent ORDER BY c::DOUBLE / w::DOUBLE, path)),
open{i} AS (
  SELECT *, max(room) FILTER (NOT is_full) OVER (PARTITION BY parent) AS rest,
         sum(w) FILTER (NOT is_full) OVER (PARTITION BY parent) AS w_open,
         coalesce(sum(w) FILTER (NOT is_full) OVER (PARTITION BY parent ORDER BY c::DOUBLE / w::DOUBLE, path), 0) AS w_upto
  FROM (SELECT *, room * w >= c * w_later AS is_full FROM fill{i})),
share{i} AS (
  SELECT path, CASE WHEN is_full THEN c
                    ELSE rest::HUGEINT * w_upto::HUGEINT // w_open::HUGEINT
                         - rest::HUGEINT * (w_upto - w)::HUGEINT // w_open::HUGEINT END AS budget
  FROM open{i})"""

    return f"""
WITH weights(path, w) AS (VALUES {weights}),
docs AS (
  SELECT doc_id, {domain} AS domain, lang, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS tokens FROM documents),
named AS (
  SELECT *, '' AS p0, {name("domain")} AS p1, {name("domain")} || '/' || {name("lang")} AS p2,
         {name("domain")} || '/' || {name("lang")} || '/' || {name("source")} AS p3 FROM docs),
leaves AS (
  SELECT p0, p1, p2, p3, sum(tokens) AS available, CASE WHEN
         {" AND ".join(f"coalesce((SELECT w FROM weights WHERE path = p{i}), 1) > 0" for i in (1, 2, 3))}
         THEN sum(tokens) * {mix.max_epochs} ELSE 0 END AS capacity
  FROM named GROUP BY p0, p1, p2, p3),
total AS (SELECT sum(available) * {mix.budget_percent} // 100 AS budget FROM leaves),
{level(1)}, {level(2)}, {level(3)},
plan AS (
  SELECT p3, available, coalesce(budget, 0)::BIGINT AS budget,
         CASE WHEN available > 0 THEN coalesce(budget, 0) // available ELSE 0 END::BIGINT AS epochs
  FROM leaves LEFT JOIN share3 ON path = p3),
placed AS (
  SELECT n.*, plan.budget, plan.epochs, plan.budget - plan.epochs * plan.available AS rest,
         ('0x' || substr(md5('{mix.seed}:' || plan.epochs || ':' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS place
  FROM named n JOIN plan USING (p3)),
summed AS (SELECT *, sum(tokens) OVER (PARTITION BY p3 ORDER BY place) AS upto FROM placed)
SELECT doc_id, domain, lang, source, tokens, budget AS leaf_budget,
       epochs + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END AS copies
FROM summed
"""
