"""DuckDB SQL with the same results as the queries, where SQL can say it at the size of the checks.

Not here: token counts, encodings and scores (no SQL), and byte repeats (too slow); tests hold those against
brute force, the tokenizer library and held-out labels.
"""

from __future__ import annotations

from .decontamination import SUBSTITUTIONS, WINDOW
from .periodic_runs import Runs
from .quality_rules import Rules
from .secret_scans import RULES
from .url_filters import ALIAS_HOST, CANONICAL, REFRESH, SMALL, TRACKING, UPPER
from .vector_codes import Coding

GAP = r"[\x20\x09-\x0D]+"
LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def words(text: str) -> str:
    return f"list_filter(string_split_regex(coalesce({text}, ''), '{GAP}'), lambda w: w <> '')"


OP1 = f"""
WITH RECURSIVE texts AS (SELECT doc_id, {words(LOWER)} AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: list_slice(w, i, i + 2)))
         WHEN len(w) > 0 THEN [w] ELSE [] END AS s FROM texts),
tokens AS (SELECT doc_id, len(s) AS n, hash(unnest(s)) AS t FROM sets),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, a.n AS n, b.n AS m, count(*) AS common FROM tokens a JOIN tokens b
           ON a.t = b.t AND a.doc_id <> b.doc_id AND 10 * a.n >= 9 * b.n AND 10 * b.n >= 9 * a.n GROUP BY ALL),
links AS (SELECT x, y FROM shared WHERE 100 * common >= 90 * (n + m - common)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM sets UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, (SELECT min(y) FROM reach WHERE reach.x = doc_id) AS component_id,
       (SELECT count(*) FROM links WHERE links.x = doc_id) AS n_links
FROM sets
"""

OP3 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS digest FROM pages),
f AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS size, digest, min(page_id) OVER (PARTITION BY digest) AS least FROM p)
SELECT page_id, size AS payload_bytes, digest AS payload_digest,
       CASE WHEN size >= 100 AND page_id <> least THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN size >= 100 AND page_id <> least THEN least END AS refers_to
FROM f
"""


def _spans(place: int) -> str:
    rule = RULES[place]
    pattern = rule.pattern.replace("'", "''")
    total = "list_sum(list_transform(list_slice({0}, 1, {1}), lambda x: length(x)))"
    start = f"coalesce({total.format('gaps', 'i')}, 0) + coalesce({total.format('hits', 'i - 1')}, 0)"
    return f"""
SELECT rid, {place} AS place, '{rule.kind}' AS kind, CAST({start} AS BIGINT) AS a, CAST({start} + length(hits[i]) AS BIGINT) AS b
FROM (SELECT rid, string_split_regex(text, '{pattern}') AS gaps, regexp_extract_all(text, '{pattern}', 0) AS hits,
             regexp_extract_all(text, '{pattern}', {rule.group}) AS parts FROM d), unnest(range(1, len(hits) + 1)) t(i)
WHERE length(parts[i]) >= {rule.least}"""


OP4 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
found AS ({" UNION ALL ".join(map(_spans, range(len(RULES))))}),
listed AS (SELECT rid, string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, place) AS spans,
  {", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in RULES)} FROM found GROUP BY rid)
SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in RULES)},
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans, sha256(text) AS blob
FROM d LEFT JOIN listed USING (rid)
"""

OP6 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {words('text')} AS w FROM documents),
each AS (SELECT rid, i, w[i] AS word, CASE WHEN i + 34 <= len(w) THEN list_slice(w, i, i + 34) END AS g
         FROM d, unnest(range(1, len(w) + 1)) t(i)),
starts AS (SELECT rid, i, word, CASE WHEN g IS NOT NULL AND count(*) OVER (PARTITION BY g) > 1 THEN 1 ELSE 0 END AS hit FROM each),
gone AS (SELECT rid, i, word, max(hit) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone FROM starts),
kept AS (SELECT rid, sum(gone) AS n, string_agg(word, ' ' ORDER BY i) FILTER (gone = 0) AS line FROM gone GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(line, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""


def _covered(name: str, column: str, length: int) -> str:
    """(rid, i, hit): whether a word lies in a gram of its text that the text has more than once."""
    return f"""
{name}_starts AS (SELECT rid, i, CASE WHEN g IS NOT NULL AND count(*) OVER (PARTITION BY rid, g) > 1 THEN 1 ELSE 0 END AS hit
  FROM (SELECT rid, i, CASE WHEN i + {length - 1} <= len({column}) THEN list_slice({column}, i, i + {length - 1}) END AS g
        FROM d, unnest(range(1, len({column}) + 1)) t(i))),
{name} AS (SELECT rid, sum(hit) AS words, sum(hit * length(w[i])) AS chars FROM (
  SELECT rid, i, max(hit) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN {length - 1} PRECEDING AND CURRENT ROW) AS hit
  FROM {name}_starts) JOIN d USING (rid) GROUP BY rid)"""


def _op7(rules: Rules) -> str:
    shares = ", ".join(_covered(f"g{n}", "low", n) for n in rules.ngram_share)
    joins = " ".join(f"LEFT JOIN g{n} USING (rid)" for n in rules.ngram_share)
    values = ", ".join(f"coalesce(g{n}.chars, 0) / greatest(word_chars, 1) AS share_{n}" for n in rules.ngram_share)
    fits = " AND ".join(f"share_{n} <= {limit}" for n, limit in rules.ngram_share.items())
    names = ", ".join(f"share_{n}" for n in rules.ngram_share)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, {words('text')} AS w, {words(LOWER)} AS low FROM documents),
lines AS (SELECT rid, line, length(regexp_replace(line, '{GAP}', '', 'g')) AS chars, count(*) OVER (PARTITION BY rid, line) AS times
  FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
line AS (SELECT rid, count(*) - count(DISTINCT line) AS dup, sum(CASE WHEN times > 1 THEN chars ELSE 0 END) AS chars FROM lines GROUP BY rid),
{_covered('base', 'w', rules.base_length)}, {shares},
sized AS (SELECT *, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars FROM d),
made AS (SELECT doc_id, n_words, word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
  coalesce(dup, 0) AS n_dup_lines, coalesce(base.words, 0) AS n_repeat_words, {values},
  coalesce(line.chars, 0) / greatest(word_chars, 1) AS share_lines
  FROM sized LEFT JOIN line USING (rid) LEFT JOIN base USING (rid) {joins}),
judged AS (SELECT *, n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.base_percent} * n_words AS base_failed FROM made)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND {fits} AND share_lines <= {rules.line_share} AS kept, {names}, share_lines
FROM judged
"""


OP9 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {words('lower(text)')} AS w FROM documents),
b AS (SELECT row_number() OVER () AS bid, item_id, {words('lower(text)')} AS v FROM benchmark),
dw AS (SELECT rid, i, w[i] AS word FROM d, unnest(range(1, len(w) + 1)) t(i)),
bw AS (SELECT bid, j, len(v) AS n, v[j] AS word FROM b, unnest(range(1, len(v) + 1)) t(j)),
met AS (SELECT rid, bid, i - j AS shift, n, list(j) AS js FROM dw JOIN bw USING (word) GROUP BY ALL
        HAVING count(*) >= least(n, {WINDOW}) - {SUBSTITUTIONS} * least(n, {WINDOW}) // {WINDOW}),
good AS (SELECT rid, bid, shift, n, len(js) AS equal FROM met WHERE n < {WINDOW} OR len(list_filter(range(1, n - {WINDOW} + 2),
  lambda k: len(list_filter(js, lambda j: j >= k AND j < k + {WINDOW})) >= {WINDOW - SUBSTITUTIONS})) > 0),
best AS (SELECT doc_id, item_id, shift, equal, n FROM good JOIN d USING (rid) JOIN b USING (bid)
         QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY equal DESC, shift) = 1)
SELECT doc_id, item_id, CAST(shift AS INTEGER) AS start, CAST(equal AS INTEGER) AS n_equal, CAST(n AS INTEGER) AS n_item FROM best
"""


def _plain(url: str) -> str:
    """The form that all spellings of an address share."""
    rest = rf"regexp_replace(regexp_replace({url}, '(?s)^.*?://', ''), '(?s)#.*\z', '')"
    host = f"translate(regexp_extract({rest}, '^[^/?]*'), '{UPPER}', '{SMALL}')"
    host = rf"(CASE WHEN regexp_matches({host}, '{ALIAS_HOST}[^.]+\.[^.]') THEN regexp_replace({host}, '{ALIAS_HOST}', '') ELSE {host} END)"
    asked = rf"list_sort(list_filter(string_split(regexp_extract({rest}, '(?s)^[^?]*\?(.*)', 1), '&'), lambda q: q <> '' AND NOT regexp_matches(q, '{TRACKING}')))"
    return rf"""CASE WHEN instr({url}, '://') > 0 THEN regexp_replace({host}, ':(80|443)\z', '')
  || regexp_replace(regexp_extract({rest}, '^[^/?]*([^?]*)', 1), '/\z', '')
  || CASE WHEN len({asked}) > 0 THEN '?' || array_to_string({asked}, '&') ELSE '' END END"""


def _quoted(pattern: str) -> str:
    return pattern.replace("'", "''")


OP11 = rf"""
WITH RECURSIVE p AS MATERIALIZED (SELECT row_number() OVER () AS rid, page_id, url, html, {_plain('url')} AS node,
  CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS MATERIALIZED (SELECT *, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), '{UPPER}', '{SMALL}') AS host,
  regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM p),
rules(rule, h, t, v) AS (VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
  ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
judged AS MATERIALIZED (SELECT rid, arg_max(rule, length(rule)) AS rule, arg_max(v, length(rule)) AS v
  FROM u JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, t) GROUP BY rid),
found AS (SELECT node AS a, url, replace(unnest(list_concat({", ".join(f"regexp_extract_all(html, '{_quoted(x)}', 1)" for x in (*CANONICAL, REFRESH))})), '&amp;', '&') AS link
  FROM u WHERE url IS NOT NULL),
target AS (SELECT a, CASE WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN link WHEN starts_with(link, '//') THEN 'https:' || link
  WHEN starts_with(link, '/') THEN regexp_extract(url, '(?s)^.*?://[^/?#]*') || link END AS link FROM found),
edges AS MATERIALIZED (SELECT a, b FROM (SELECT a, {_plain('link')} AS b FROM target) WHERE a IS NOT NULL AND b IS NOT NULL),
two AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach AS (SELECT DISTINCT node AS x, node AS y FROM u WHERE node IS NOT NULL UNION SELECT reach.x, two.b FROM reach JOIN two ON reach.y = two.a),
classes AS (SELECT x, min(y) AS class FROM reach GROUP BY x),
said AS (SELECT class, max(CASE WHEN v = 'allow' THEN 1 ELSE 0 END) AS allowed FROM u JOIN judged USING (rid) JOIN classes ON x = node GROUP BY class)
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN allowed = 0 THEN 'block' ELSE 'allow' END) AS verdict
FROM u LEFT JOIN judged USING (rid) LEFT JOIN classes ON x = node LEFT JOIN said USING (class)
"""


def _op12(coding: Coding) -> str:
    """Rounds as one table each: a(n) is what round n assigns, c(n) the codebooks behind it."""
    parts, entries, rounds = coding.parts, coding.entries, coding.rounds
    away = "list_sum(list_transform(list_zip(p.part, c.part), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"

    def assigned(n: int, book: str) -> str:
        return f"""
a{n} AS MATERIALIZED (SELECT rid, pos, part, CAST(least % {entries} AS INTEGER) AS entry, least // {entries} AS far FROM
  (SELECT rid, p.pos, any_value(p.part) AS part, min(CAST({away} AS BIGINT) * {entries} + c.entry) AS least FROM p JOIN {book} c USING (pos) GROUP BY rid, p.pos)),"""

    def moved(n: int) -> str:
        return f"""
c{n} AS MATERIALIZED (SELECT c.pos, c.entry, coalesce(m.part, c.part) AS part FROM c{n - 1} c LEFT JOIN (SELECT pos, entry, list(mean ORDER BY k) AS part FROM
  (SELECT pos, entry, k, CAST(floor(sum(part[k]) / count(*)) AS BIGINT) AS mean FROM a{n}, unnest(range(1, len(part) + 1)) t(k) GROUP BY pos, entry, k)
  GROUP BY pos, entry) m ON c.pos = m.pos AND c.entry = m.entry),"""

    return f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda x: CAST(floor({coding.scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT rid, pos, x[pos * len(x) // {parts} + 1 : (pos + 1) * len(x) // {parts}] AS part FROM v, unnest(range({parts})) t(pos)),
c0 AS MATERIALIZED (SELECT pos, entry, x[pos * len(x) // {parts} + 1 : (pos + 1) * len(x) // {parts}] AS part FROM
  (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS entry, min(x) AS x FROM v GROUP BY vec_id ORDER BY vec_id LIMIT {entries}), unnest(range({parts})) t(pos)),
{"".join(assigned(n, f"c{n - 1}") + moved(n) for n in range(1, rounds + 1))}{assigned(rounds + 1, f"c{rounds}")}
book AS (SELECT sha256(string_agg(array_to_string(part, ','), ',' ORDER BY pos, entry)) AS codebooks_sha256 FROM c{rounds}),
code AS (SELECT rid, string_agg(format('{{:02x}}', entry), '' ORDER BY pos) AS code, CAST(sum(far) AS BIGINT) AS error FROM a{rounds + 1} GROUP BY rid)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM v JOIN code USING (rid), book
"""


def _op13(rules: Runs) -> str:
    """Equal grams q words apart, joined to stretches; the shortest equal stretch of a run has `gram` words."""
    gram = min(max(rules.least - q, (rules.powers - 1) * q) for q in range(1, rules.least))
    return f"""
WITH RECURSIVE step(n, k, c) AS (SELECT range, 0, range FROM range(256) UNION ALL
  SELECT n, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM step WHERE k < 8),
crc_table AS MATERIALIZED (SELECT n AS slot, c AS v FROM step WHERE k = 8),
d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, CAST(doc_id AS VARCHAR) AS name, {words('text')} AS w FROM documents),
crc(rid, name, k, c) AS (SELECT rid, name, 0, 4294967295 FROM d WHERE name IS NOT NULL UNION ALL
  SELECT rid, name, k + 1, xor(c >> 8, v) FROM crc JOIN crc_table ON slot = xor(c, ascii(substr(name, k + 1, 1))) & 255 WHERE k < length(name)),
h AS (SELECT rid, xor(c, 4294967295) AS h FROM crc WHERE k = length(name)),
sized AS (SELECT rid, doc_id, w, len(w) AS n, h, h // 10 AS g FROM d LEFT JOIN h USING (rid)),
tail AS (SELECT *, g % n AS a, 1 + (n - g % n) // (3 + g % 8) AS p FROM sized),
t AS MATERIALIZED (SELECT rid, doc_id, CASE WHEN h % 10 = 0 AND n > 0
  THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END) ELSE w END AS w FROM tail),
each AS MATERIALIZED (SELECT rid, len(w) AS n, i, w[i + 1] AS word, CASE WHEN i + {gram} <= len(w) THEN list_slice(w, i + 1, i + {gram}) END AS gram
  FROM t, unnest(range(len(w))) s(i)),
met AS (SELECT x.rid, y.i - x.i AS q, x.i FROM each x JOIN each y ON x.rid = y.rid AND x.gram = y.gram AND x.i < y.i AND {rules.powers} * (y.i - x.i) <= x.n),
stretch AS (SELECT rid, q, min(i) AS start, max(i) + {gram} + q - min(i) AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS island FROM met) GROUP BY rid, q, island),
runs AS MATERIALIZED (SELECT rid, start, length, min(q) AS period FROM stretch WHERE length >= {rules.least} AND length >= {rules.powers} * q GROUP BY rid, start, length),
listed AS (SELECT rid, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
  arg_min({{'start': start, 'length': length, 'period': period}}, (-length, start, period)) AS top FROM runs GROUP BY rid),
edge AS (SELECT rid, i, sum(change) AS change FROM (SELECT rid, start + period AS i, 1 AS change FROM runs UNION ALL SELECT rid, start + length, -1 FROM runs) GROUP BY rid, i),
gone AS (SELECT rid, i, word, sum(coalesce(change, 0)) OVER (PARTITION BY rid ORDER BY i) AS depth FROM each LEFT JOIN edge USING (rid, i)),
kept AS (SELECT rid, string_agg(word, ' ' ORDER BY i) AS line FROM gone WHERE depth = 0 GROUP BY rid)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, top.start AS start, top.length AS length, top.period AS period,
  1000 * top.length // top.period AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(line, '')) AS collapsed_sha256
FROM t LEFT JOIN listed USING (rid) LEFT JOIN kept USING (rid)
"""


ORACLES = {
    "op1_ngram_jaccard_join": OP1, "op3_warc_salvage": OP3, "op4_secret_scans": OP4, "op6_substring_dedup": OP6,
    "op7_quality_rules": _op7(Rules()), "op9_decontamination": OP9,
    "op11_url_filters": OP11, "op12_vector_codes": _op12(Coding()), "op13_periodic_runs": _op13(Runs()),
}
