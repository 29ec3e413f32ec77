"""DuckDB texts of the queries that SQL can express, over the whole tables."""
from __future__ import annotations

from paylake.llm.quality import RULES, STOP_WORDS, SYMBOLS

_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)
_BOUNDS = " AND ".join([f"{r.metric} >= {r.low}" for r in RULES if r.low is not None]
                       + [f"{r.metric} <= {r.high}" for r in RULES if r.high is not None])


def quality_metrics(table: str = "documents") -> str:
    """One row per row of ``table`` (columns of documents) with counts, base_failed and kept."""
    return f"""
    SELECT *, NOT base_failed AND {_BOUNDS} AS kept FROM (
      SELECT m.*, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
             CASE WHEN n_words > 0 THEN word_chars::DOUBLE / n_words ELSE 0.0 END AS mean_word_chars,
             CASE WHEN word_chars > 0 THEN n_symbols::DOUBLE / word_chars ELSE 0.0 END AS symbol_ratio,
             CASE WHEN n_words > 0 THEN n_stop::DOUBLE / n_words ELSE 0.0 END AS stop_word_ratio,
             CASE WHEN n_lines > 0 THEN n_dup_lines::DOUBLE / n_lines ELSE 0.0 END AS dup_line_ratio,
             CASE WHEN n_lines > 0 THEN n_bullet::DOUBLE / n_lines ELSE 0.0 END AS bullet_line_ratio,
             CASE WHEN n_lines > 0 THEN n_ellipsis::DOUBLE / n_lines ELSE 0.0 END AS ellipsis_line_ratio,
             CASE WHEN n_words > 0 THEN n_repeat_words::DOUBLE / n_words ELSE 0.0 END AS repeat_word_ratio
      FROM (
        SELECT b.*, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
               len(regexp_extract_all(t, '[{SYMBOLS}]'))::BIGINT AS n_symbols,
               (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls) AS n_lines,
               coalesce(r.n, 0)::BIGINT AS n_repeat_words,
               len([x FOR x IN ws IF x IN ({_STOP})]) AS n_stop,
               len([x FOR x IN ls IF regexp_matches(ltrim(x), '^(?:[-*•]|\\d+[.)])\\s')]) AS n_bullet,
               len([x FOR x IN ls IF regexp_matches(rtrim(x), '(?:\\.\\.\\.|…)$')]) AS n_ellipsis
        FROM base b LEFT JOIN repeated r USING (rid)) m)"""


QUALITY_CTES = r"""
base AS (
  SELECT *, [x FOR x IN regexp_split_to_array(t, '[\x20\x09-\x0D]+') IF x <> ''] AS ws,
         [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS ls
  FROM (SELECT *, coalesce(text, '') AS t, row_number() OVER () AS rid FROM documents)),
windows AS (
  SELECT rid, i, array_to_string(ws[i:i + 7], chr(1)) AS k
  FROM (SELECT rid, ws, unnest(range(1, greatest(len(ws) - 6, 1))) AS i FROM base)),
repeated AS (
  SELECT rid, count(DISTINCT j) AS n FROM (
    SELECT rid, unnest(range(i, i + 8)) AS j FROM (
      SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS c FROM windows) WHERE c > 1)
  GROUP BY rid)"""

QUALITY = f"""WITH {QUALITY_CTES}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept
FROM ({quality_metrics()})"""


def mix_rows(table: str = "documents") -> str:
    """One row per row of ``table`` with size, source_size, target, copies and tilt."""
    return rf"""
    SELECT *, CASE WHEN size > 0
        THEN greatest(floor((target - (before + size / 2.0)) / source_size) + 1, 0)::BIGINT ELSE 0 END AS copies
    FROM (
      SELECT d.*, t.source_size, t.target, t.tilt,
             coalesce(sum(size) OVER (PARTITION BY d.s ORDER BY d.h, d.doc_id, d.size
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
      FROM mix_sized d JOIN mix_targets t ON d.s = t.s)"""


MIX_CTES = r"""
mix_sized AS (
  SELECT *, len([x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''])::BIGINT AS size,
         coalesce('0' || source, '1') AS s, md5(doc_id::VARCHAR) AS h FROM {table}),
mix_ranked AS (
  SELECT s, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY s) AS r FROM mix_sized GROUP BY s),
mix_caps AS (
  SELECT *, (ARRAY[5.0, 2.0, 1.0])[(r - 1) % 3 + 1]::DOUBLE AS w, (ARRAY[0.5, 0.0, -0.5])[(r - 1) % 3 + 1]::DOUBLE AS tilt,
         3.0::DOUBLE * source_size AS cap, (sum(source_size) OVER ())::DOUBLE AS everything FROM mix_ranked),
mix_levels AS (
  SELECT *, (everything - coalesce(sum(cap) OVER (ORDER BY cap / w, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY cap / w, r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
         row_number() OVER (ORDER BY cap / w, r) AS n FROM mix_caps),
mix_targets AS (
  SELECT s, source_size, tilt, CASE WHEN fill IS NULL THEN cap ELSE least(cap, fill * w) END AS target
  FROM (SELECT *, first_value(CASE WHEN level <= cap / w THEN level END IGNORE NULLS)
                  OVER (ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS fill FROM mix_levels))"""

_SHARE = "((before + size / 2.0) / target)"
MIX = f"""WITH {MIX_CTES.replace("{table}", "documents")}
SELECT doc_id, size, source_size, target, size * copies AS taken, copies,
       CASE WHEN copies > 0 THEN CASE WHEN tilt = 0 THEN {_SHARE}
            ELSE (1 + tilt - sqrt(greatest((1 + tilt) * (1 + tilt) - 4 * tilt * {_SHARE}, 0.0))) / (2 * tilt) END END
         AS first_time
FROM ({mix_rows()})"""


def _license_values(short: bool) -> str:
    from paylake.llm.licenses import SHORT_TEMPLATES, TEMPLATES, templates
    quoted = lambda ws: "[" + ", ".join(f"'{w}'" for w in ws) + "]"
    return ", ".join(f"('{t.name}', {t.window}, {quoted(t.words)})" for t in templates((*TEMPLATES, *SHORT_TEMPLATES)) if t.short == short)


# every window and template with a shingle in common, so it also tells what the bands must retrieve;
# templates below a shingle's length as runs of their words
LICENSES = rf"""WITH t(license, w, ws) AS (VALUES {_license_values(False)}),
brief(license, n, ws) AS (VALUES {_license_values(True)}),
ts AS (SELECT DISTINCT license, w, s FROM (
  SELECT license, w, unnest([array_to_string(ws[i:i + 4], ' ') FOR i IN range(1, len(ws) - 3)]) AS s FROM t)),
sizes AS (SELECT license, count(*) AS n FROM ts GROUP BY license),
d AS (SELECT row_number() OVER () AS rid, doc_id,
        [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), '{"ABCDEFGHIJKLMNOPQRSTUVWXYZ"}', '{"abcdefghijklmnopqrstuvwxyz"}'),
                                          '[^\p{{L}}\p{{N}}]+') IF x <> ''] AS ws FROM documents),
s AS (SELECT rid, doc_id, p, array_to_string(ws[p:p + 4], ' ') AS s
      FROM (SELECT rid, doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1))) AS p FROM d)),
hits AS (
  SELECT rid, doc_id, license, s, unnest(range(
           greatest(0, ceil((p - w + 4) / (w / 2.0)))::BIGINT, floor((p - 1) / (w / 2.0))::BIGINT + 1)) * (w // 2) AS start
  FROM s JOIN ts USING (s)),
found AS (
  SELECT rid, doc_id, license, start, count(DISTINCT s)::DOUBLE / any_value(n) AS c
  FROM hits JOIN sizes USING (license) GROUP BY rid, doc_id, license, start HAVING c >= 0.8
  UNION ALL SELECT rid, doc_id, license, p - 1, 1.0
  FROM (SELECT d.rid, d.doc_id, license, n, b.ws AS want, d.ws AS ws, unnest(range(1, len(d.ws) - n + 2)) AS p
        FROM d, brief b WHERE list_has_all(d.ws, b.ws)) WHERE ws[p:p + n - 1] = want)
SELECT doc_id, license, max(c) AS containment, arg_max(start, (c, -start))::INTEGER AS start_word, count(*)::BIGINT AS n_windows
FROM found GROUP BY rid, doc_id, license"""


REPEATS = r"""WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS ws FROM documents),
windows AS (
  SELECT rid, i, md5(array_to_string(ws[i:i + 34], ' ')) AS k
  FROM (SELECT rid, ws, unnest(range(1, greatest(len(ws) - 33, 1))) AS i FROM d)),
gone AS (
  SELECT DISTINCT rid, unnest(range(i, i + 35)) AS j
  FROM (SELECT rid, i, count(*) OVER (PARTITION BY k) AS c FROM windows) WHERE c > 1),
removed AS (SELECT rid, count(*) AS n FROM gone GROUP BY rid),
kept AS (
  SELECT rid, string_agg(word, ' ' ORDER BY j) AS line
  FROM (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS j FROM d) ANTI JOIN gone USING (rid, j) GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(line, '')) AS kept_sha256
FROM d LEFT JOIN removed USING (rid) LEFT JOIN kept USING (rid)"""


DIVERGENCE = r"""WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
w AS (SELECT rid, lang, source, unnest(ts) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT rid) >= 30),
langs AS (SELECT lang, sum(n) AS total, count(*) AS v FROM kept GROUP BY lang),
seen AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
groups AS (
  SELECT lang, source, coalesce(any_value(s.total), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN
       (SELECT lang, source, sum(n) AS total FROM seen GROUP BY lang, source) s USING (lang, source) GROUP BY lang, source),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(s.n, 0) AS n,
         (1 + 1000000000::HUGEINT * (coalesce(s.n, 0) + 5) // (g.total + 5 * l.v)::HUGEINT)::BIGINT AS p,
         (1 + 1000000000::HUGEINT * (k.n + 5) // (l.total + 5 * l.v)::HUGEINT)::BIGINT AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN seen s
    ON s.lang = g.lang AND s.source = g.source AND s.term = k.term),
dist AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
         FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
ranked AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN dist ON dist.lang = a.lang AND dist.source = a.source AND dist.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM ranked QUALIFY part = 'pair' OR rank <= 50"""


# every equal pair of six words proposes a period: a run has such a pair at each of its places
RUNS = r"""WITH steps AS (
  SELECT list(list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0],
              lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY x) AS t
  FROM (SELECT unnest(range(256))::BIGINT AS x)),
d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS ws,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
               regexp_extract_all(coalesce(doc_id::VARCHAR, ''), '.'), lambda c: ascii(c)::BIGINT)),
             lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM documents, steps),
planned AS (
  SELECT *, len(ws) AS n, CASE WHEN h % 10 = 0 AND len(ws) > 0 THEN (h // 10) % len(ws) END AS a, h // 10 AS g FROM d),
edited AS (
  SELECT rid, doc_id, n, CASE WHEN a IS NULL THEN ws
    ELSE [ws[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END] FOR i IN range(n)] END AS ws FROM planned),
six AS (
  SELECT rid, i, md5(array_to_string(ws[i + 1:i + 6], ' ')) AS k
  FROM (SELECT rid, ws, unnest(range(greatest(n - 5, 0))) AS i FROM edited)),
twice AS (SELECT *, count(*) OVER (PARTITION BY rid, k) AS c FROM six QUALIFY c > 1),
equal AS (SELECT x.rid, x.i, y.i - x.i AS q FROM twice x JOIN twice y ON x.rid = y.rid AND x.k = y.k AND x.i < y.i),
found AS (
  SELECT rid, min(i) AS s, count(*) + 5 + q AS m, q FROM (
    SELECT *, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS island FROM equal)
  GROUP BY rid, q, island HAVING count(*) + 5 + q >= greatest(12, 2 * q)),
runs AS (SELECT rid, s, m, min(q) AS q FROM found GROUP BY rid, s, m),
report AS (
  SELECT rid, count(*) AS n_runs, arg_max({'s': s, 'm': m, 'q': q}, (m, -s, -q)) AS best,
         string_agg(s || ',' || m || ',' || q || chr(10), '' ORDER BY s, q) AS line FROM runs GROUP BY rid),
gone AS (SELECT DISTINCT rid, unnest(range(s + q, s + m)) AS i FROM runs),
kept AS (
  SELECT rid, string_agg(word, ' ' ORDER BY i) AS line
  FROM (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS i FROM edited) ANTI JOIN gone USING (rid, i) GROUP BY rid)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.s::BIGINT AS start, best.m::BIGINT AS length,
       best.q::BIGINT AS period, (1000 * best.m // best.q)::BIGINT AS exponent_milli,
       sha256(coalesce(r.line, '')) AS runs_sha256, sha256(coalesce(k.line, '')) AS collapsed_sha256
FROM edited LEFT JOIN report r USING (rid) LEFT JOIN kept k USING (rid)"""
