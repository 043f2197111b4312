"""DuckDB SQL for the rows of the queries that SQL can express.

Rows with one doc_id stay apart (``row_number``), as in the operators."""

from __future__ import annotations

from shipcast.llm import decontaminate, quality_rules, sharding, spelling, url_filters

_UPPER, _LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"

#: CRC32 of a text's bytes: a table from the polynomial, folded over the list of bytes.
_CRC_STEP = "CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END"
OP1 = f"""
WITH RECURSIVE crc(b, c, k) AS (SELECT range::BIGINT, range::BIGINT, 0 FROM range(256) UNION ALL SELECT b, {_CRC_STEP}, k + 1 FROM crc WHERE k < 8),
code AS (SELECT list(c ORDER BY b) AS code FROM crc WHERE k = 8),
d AS (SELECT doc_id, source, coalesce(text, '') AS text, md5('{sharding.SEED}|' || doc_id) AS key FROM documents),
byte AS (SELECT doc_id, source, key, list_transform(range(octet_length(encode(text))), lambda i: ('0x' || substr(hex(encode(text)), 2 * i + 1, 2))::BIGINT) AS bytes FROM d),
sized AS (SELECT doc_id, source, key, len(bytes) + 1 AS size, xor(list_reduce(bytes, lambda c, b: xor(c // 256, code[xor(c, b) % 256 + 1]), 4294967295::BIGINT), 4294967295) AS text_crc32 FROM byte, code),
placed AS (SELECT *, (row_number() OVER (PARTITION BY source ORDER BY key, doc_id) - 0.5::DOUBLE) / count(*) OVER (PARTITION BY source) AS place FROM sized),
ranked AS (SELECT *, row_number() OVER (ORDER BY place, source NULLS FIRST, key, doc_id) - 1 AS i, count(*) OVER () AS n FROM placed)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'rows' AS law, (i * 16 // n)::INTEGER AS shard, (i - (15 + (i * 16 // n) * n) // 16)::BIGINT AS slot,
       NULL::INTEGER AS grown_shard, source FROM ranked"""

OP2 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
line AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d),
dup AS (SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines FROM line WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
three AS (SELECT rid, p, words[p:p + 2] AS w FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS p FROM d)),
again AS (SELECT rid, unnest(ps) AS p FROM (SELECT rid, list(p) AS ps FROM three GROUP BY rid, w HAVING count(*) > 1)),
again_words AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([p, p + 1, p + 2]) AS p FROM again) GROUP BY rid),
long AS (SELECT rid, p, array_to_string(words[p:p + {quality_rules.MIN_WORDS - 1}], ' ') AS w
         FROM (SELECT rid, words, unnest(range(1, len(words) - {quality_rules.MIN_WORDS - 2})) AS p FROM d)),
pair AS (SELECT a.rid, a.p, b.p AS q, a.p - row_number() OVER (PARTITION BY a.rid, b.p - a.p ORDER BY a.p) AS island
         FROM long a JOIN long b ON a.rid = b.rid AND a.w = b.w AND a.p < b.p),
alike AS (SELECT rid, p, q, count(*) OVER (PARTITION BY rid, q - p, island ORDER BY p DESC) + {quality_rules.MIN_WORDS - 1} AS n,
                 p = min(p) OVER (PARTITION BY rid, q - p, island) AS whole FROM pair),
maximal AS (SELECT rid, count(DISTINCT md5(array_to_string(words[p:p + n - 1], ' '))) AS n FROM (SELECT rid, p, n FROM alike WHERE whole GROUP BY ALL) JOIN d USING (rid) GROUP BY rid),
longest AS (SELECT rid, p, max(n) AS n FROM (SELECT rid, p, n FROM alike UNION ALL SELECT rid, q, n FROM alike) GROUP BY rid, p),
start AS (SELECT rid, count(*) AS n FROM (SELECT rid, p, n, lag(p) OVER w AS p0, lag(n) OVER w AS n0 FROM longest WINDOW w AS (PARTITION BY rid ORDER BY p))
          WHERE p0 IS NULL OR p0 <> p - 1 OR n0 <> n + 1 GROUP BY rid),
inside AS (SELECT rid, sum(least({quality_rules.MIN_WORDS}, coalesce(next - p, {quality_rules.MIN_WORDS}))) AS n_covered, max(n) AS longest_repeat
           FROM (SELECT rid, p, n, lead(p) OVER (PARTITION BY rid ORDER BY p) AS next FROM longest) GROUP BY rid),
m AS (SELECT doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
             coalesce(again_words.n, 0)::BIGINT AS n_repeat_words, coalesce(n_covered, 0)::BIGINT AS n_covered, coalesce(longest_repeat, 0)::BIGINT AS longest_repeat,
             coalesce(start.n, 0)::BIGINT AS n_repeats, coalesce(maximal.n, 0)::BIGINT AS n_maximal
      FROM d LEFT JOIN dup USING (rid) LEFT JOIN again_words USING (rid) LEFT JOIN inside USING (rid) LEFT JOIN start USING (rid) LEFT JOIN maximal USING (rid)),
f AS (SELECT *, n_words < {quality_rules.MIN_N_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND n_covered <= {quality_rules.MAX_COVERED} * n_words AND longest_repeat <= {quality_rules.MAX_LONGEST} AS kept FROM f"""

_P = url_filters.Params()
_RULES = ", ".join(f"('{said}', '{rule}', '{rule.partition('/')[0]}', '/{rule.partition('/')[2]}')" for said, rule in url_filters.RULES)
_LONG = ", ".join(f"'{s}'" for s in url_filters.LONG_SUFFIXES)


def _rho(level: str) -> str:
    """Correlation within a level (n, bad, m), as in ``url_filters``."""
    spread, weight = "m * (1 - m)", f"(SELECT {_P.guess[1]} * whole * (1 - whole) FROM total)"
    over, room = f"coalesce(sum(n * (bad / n - m) * (bad / n - m) - {spread}), 0)", f"coalesce(sum({spread} * (n - 1)), 0)"
    return f"(SELECT least(greatest(({over} + {_P.guess[0]} * any_value(w)) / ({room} + any_value(w)), {_P.rho[0]}), {_P.rho[1]}) FROM {level}, (SELECT {weight} AS w))"


def _post(level: str) -> str:
    """a and b of the posterior of a level's rows (k: its prior's weight)."""
    return f"(SELECT *, bad + k * m AS a, n - bad + k * (1 - m) AS b FROM (SELECT *, 1 / (1 - (1 - {_rho(level)}) * (1 - 1 / (sure + 1))) - 1 AS k FROM {level}))"


OP3 = f"""
WITH RECURSIVE own AS (SELECT row_number() OVER () AS rid, page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), {_UPPER}, {_LOWER}), '') AS host,
                    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
marked AS (SELECT doc_id AS page_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels WHERE quality IS NOT NULL OR toxic IS NOT NULL GROUP BY doc_id),
named AS (SELECT host, bad, string_split(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '.') AS part FROM own JOIN marked USING (page_id) WHERE host <> ''),
hosts AS (SELECT host, part, array_to_string(part[-2:], '.') IN ({_LONG}) AS two, count(*)::DOUBLE AS n, sum(bad)::DOUBLE AS bad FROM named GROUP BY host, part),
hosted AS (SELECT host, n, bad, array_to_string(CASE WHEN ip THEN part WHEN two THEN part[-3:] ELSE part[-2:] END, '.') AS domain,
                  CASE WHEN ip THEN 'ip' ELSE array_to_string(CASE WHEN two THEN part[-2:] ELSE part[-1:] END, '.') END AS suffix
           FROM (SELECT *, regexp_full_match(array_to_string(part, '.'), '[0-9]{{1,3}}([.][0-9]{{1,3}}){{3}}|\\[.*\\]') AS ip FROM hosts)),
total AS (SELECT (coalesce(sum(bad), 0) + 1) / (coalesce(sum(n), 0) + 2) AS whole, coalesce(sum(n), 0) + 2 AS all_n FROM hosted),
top AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, (SELECT whole FROM total) AS m, (SELECT all_n FROM total) AS sure FROM hosted GROUP BY suffix),
top_mean AS (SELECT suffix, a / (a + b) AS m, a + b AS sure FROM {_post("top")}),
middle AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad, any_value(m) AS m, any_value(sure) AS sure FROM hosted JOIN top_mean USING (suffix) GROUP BY domain, suffix),
middle_mean AS (SELECT domain, a / (a + b) AS m, a + b AS sure FROM {_post("middle")}),
low AS (SELECT host, n, bad, m, sure FROM hosted JOIN middle_mean USING (domain)),
post AS (SELECT host, bad, a * least(1, {url_filters.MOST} / (a + b)) AS a, b * least(1, {url_filters.MOST} / (a + b)) AS b FROM {_post("low")}),
side AS (SELECT host, bad, {_P.limit} >= (a + 1) / (a + b + 2) AS swap, CASE WHEN swap THEN b ELSE a END AS p, CASE WHEN swap THEN a ELSE b END AS q, CASE WHEN swap THEN 1 - {_P.limit} ELSE {_P.limit} END AS x FROM post),
cf AS (SELECT *, 0 AS j, 1.0::DOUBLE AS c, 1 / (1 - (p + q) * x / (p + 1)) AS d, 1 / (1 - (p + q) * x / (p + 1)) AS h FROM side
  UNION ALL SELECT host, bad, swap, p, q, x, j + 1, 1 + t / c, 1 / (1 + t * d), h * (1 + t / c) / (1 + t * d) FROM (
    SELECT *, CASE WHEN j % 2 = 0 THEN (j // 2 + 1) * (q - (j // 2 + 1)) * x / ((p + j + 1) * (p + j + 2)) ELSE -(p + j // 2 + 1) * (p + q + j // 2 + 1) * x / ((p + j + 1) * (p + j + 2)) END AS t
    FROM cf WHERE j < {2 * url_filters.STEPS})),
blocked AS (SELECT host FROM (SELECT host, bad, swap, exp(lgamma(p + q) - lgamma(p) - lgamma(q) + p * ln(x) + q * ln(1 - x)) / p * h AS v FROM cf WHERE j = {2 * url_filters.STEPS})
            WHERE bad > 0 AND CASE WHEN swap THEN 1 - v ELSE v END <= {_P.alpha}),
rules(said, rule, own_host, own_path) AS (VALUES {_RULES}),
fits AS (SELECT rid, arg_max(rule, length(rule)) AS rule, arg_max(said, length(rule)) AS said
         FROM own JOIN rules ON (host = own_host OR ends_with(host, '.' || own_host)) AND starts_with(path, own_path) GROUP BY rid)
SELECT page_id, host, path, rule, coalesce(said, CASE WHEN host IN (SELECT host FROM blocked) THEN 'block' ELSE 'allow' END) AS verdict FROM own LEFT JOIN fits USING (rid)"""

OP4 = f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
line AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM split),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {_UPPER}, {_LOWER}) AS key FROM line),
held AS (SELECT key, min(doc_id) AS keeper FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (SELECT k.*, h.key IS NOT NULL AND k.doc_id <> h.keeper AS gone FROM keyed k LEFT JOIN held h USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""


def _words(text: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), {_UPPER}, {_LOWER}), '{decontaminate.WORD}')"


OP6 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_words("text")} AS words FROM documents),
item AS (SELECT coalesce(item_id::VARCHAR, '') AS name, {_words("text")} AS words FROM benchmark),
sized AS (SELECT name, words, least(len(words), {decontaminate.WINDOW}) AS size FROM item WHERE len(words) > 0),
win AS (SELECT DISTINCT name, size, array_to_string(words[p:p + size - 1], ' ') AS w FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS p FROM sized)),
own AS (SELECT rid, p, size, array_to_string(words[p:p + size - 1], ' ') AS w
        FROM (SELECT rid, words, size, unnest(range(1, len(words) - size + 2)) AS p FROM d, (SELECT DISTINCT size FROM win))),
hit AS (SELECT rid, p, size, name FROM own JOIN win USING (size, w)),
n AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(p, p + size)) AS p FROM hit) GROUP BY rid),
found AS (SELECT rid, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names FROM (SELECT DISTINCT rid, name FROM hit) GROUP BY rid)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated FROM d LEFT JOIN n USING (rid) LEFT JOIN found USING (rid)"""


def _crc(text: str) -> str:
    """CRC32 of a text, with the table ``code`` of OP1."""
    octets = f"list_transform(range(octet_length(encode({text}))), lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), lambda c, b: xor(c // 256, code[xor(c, b) % 256 + 1])), 4294967295)"


_CODE = f"""crc(b, c, k) AS (SELECT range::BIGINT, range::BIGINT, 0 FROM range(256) UNION ALL SELECT b, {_CRC_STEP}, k + 1 FROM crc WHERE k < 8),
code AS (SELECT list(c ORDER BY b) AS code FROM crc WHERE k = 8)"""

OP11 = f"""
WITH RECURSIVE {_CODE},
run AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), {_UPPER}, {_LOWER}), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
own AS (SELECT run, coalesce(doc_id::VARCHAR, '') || ':' || run AS name, count(*) AS n FROM run GROUP BY ALL),
hashed AS (SELECT run, n, {_crc("name")} AS h FROM own, code),
word AS (SELECT CASE WHEN h % {spelling.CUT_OUT_OF} = 0 THEN left(run, (h % length(run))::INTEGER) || substr(run, (h % length(run))::INTEGER + 2) ELSE run END AS word, n FROM hashed),
w AS (SELECT word, sum(n)::BIGINT AS n FROM word WHERE length(word) >= {spelling.MIN_CHARS} GROUP BY word HAVING sum(n) >= {spelling.MIN_COUNT}),
spot AS (SELECT word, unnest(range(1, length(word) + 1)) AS p FROM w),
short AS (SELECT DISTINCT word, left(word, p - 1) || substr(word, p + 1) AS v FROM spot),
holed AS (SELECT word, left(word, p - 1) || '*' || substr(word, p + 1) AS v FROM spot),
pair AS (SELECT s.word AS a, s.v AS b FROM short s JOIN w ON w.word = s.v UNION ALL SELECT s.v, s.word FROM short s JOIN w ON w.word = s.v
         UNION ALL SELECT x.word, y.word FROM holed x JOIN holed y ON x.v = y.v AND x.word <> y.word),
near AS (SELECT a AS word, count(*) AS n_near, first(b ORDER BY w.n DESC, b) AS best, max(w.n) AS best_n FROM pair JOIN w ON w.word = b GROUP BY a),
formed AS (SELECT word, CASE WHEN best_n >= 2 * n THEN best END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * n THEN best_n END AS form_n FROM w LEFT JOIN near USING (word)),
way(word, root) AS (SELECT word, word FROM formed UNION ALL SELECT way.word, f.form FROM way JOIN formed f ON f.word = way.root WHERE f.form IS NOT NULL),
last AS (SELECT way.word, way.root FROM way JOIN formed f ON f.word = way.root WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN last USING (word)"""

_INSERTS = "VALUES (0, '', '', 0), (1, '', '', 1), (2, '', '', 2), (3, '', '', 3), (0, 'I', 'u', 2), (1, 'I', 'u', 2), (3, 'I', 'u', 2), (2, 'I', 'a', 3), (0, 'II', 'ua', 3), (1, 'II', 'ua', 3), (2, 'II', 'au', 2)"
_NEXT = "CASE {role} WHEN 's' THEN CASE WHEN mid = 0 THEN 1 END WHEN 'u' THEN CASE WHEN mid <> 2 THEN 2 END WHEN 'a' THEN CASE WHEN mid = 2 THEN 3 END END"
_PUT = "replace(replace(put, 'u', 'user:' || chr(10)), 'a', 'assistant:' || chr(10))"

#: States of the role grammar: 0 nothing read, 1 a system turn, 2 a user turn without answer, 3 whole pairs.
OP12 = f"""
WITH RECURSIVE {_CODE},
base AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
hit AS (SELECT *, {_crc("name")} % 20 AS k FROM base, code),
harmed AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role, CASE WHEN k = 1 THEN '' WHEN k = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                  unnest(CASE WHEN k = 3 THEN [0, 1] ELSE [0] END) AS copy FROM hit WHERE k <> 0),
r AS (SELECT conv_id, turn, role, text, left(role, 1) AS initial, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) > 1 AS seen, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM harmed),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, seen) AS i FROM r),
f AS (SELECT *, CASE WHEN bare = '' THEN 1 WHEN seen THEN 2 WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM o),
c AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (WHERE fault = 1) AS blank, count(*) FILTER (WHERE fault = 2) AS duplicate,
             count(*) FILTER (WHERE fault = 3) AS truncated, count(*) FILTER (WHERE before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM f GROUP BY conv_id),
put(state, ins, put, mid) AS ({_INSERTS}),
path(conv_id, i, state, best) AS (
  SELECT conv_id, 0::BIGINT, 0, {{'cost': 0::BIGINT, 'audit': '', 'said': ''}} FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i, x.state, min(x.best) FROM (
    SELECT p.conv_id, f.i, unnest([
        {{'state': mid, 'best': {{'cost': best.cost + 5 * length(ins) + 2, 'audit': best.audit || ins || 'D', 'said': best.said || {_PUT}}}}},
        {{'state': CASE WHEN fault NOT IN (1, 2) THEN {_NEXT.format(role="initial")} END,
          'best': {{'cost': best.cost + 5 * length(ins) + CASE WHEN fault = 3 THEN 5 ELSE 0 END, 'audit': best.audit || ins || 'K', 'said': best.said || {_PUT} || role || ':' || text || chr(10)}}}},
        {{'state': CASE WHEN fault NOT IN (1, 2) AND initial <> CASE WHEN mid = 2 THEN 'a' ELSE 'u' END THEN CASE WHEN mid = 2 THEN 3 ELSE 2 END END,
          'best': {{'cost': best.cost + 5 * length(ins) + CASE WHEN fault = 3 THEN 6 ELSE 1 END, 'audit': best.audit || ins || 'R',
                   'said': best.said || {_PUT} || CASE WHEN mid = 2 THEN 'assistant:' ELSE 'user:' END || text || chr(10)}}}}]) AS x
    FROM path p JOIN f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i + 1 JOIN put ON put.state = p.state) WHERE x.state IS NOT NULL GROUP BY conv_id, i, x.state),
ended AS (SELECT p.conv_id, p.i, min({{'cost': best.cost + 5 * length(ins), 'audit': best.audit || ins, 'said': best.said || {_PUT}}}) AS best FROM path p JOIN put ON put.state = p.state WHERE mid IN (0, 3) GROUP BY ALL)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       best.cost AS cost, best.audit AS audit, sha256(left(best.said, greatest(length(best.said) - 1, 0))) AS repaired_sha256
FROM ended e LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM e.conv_id WHERE e.i = coalesce(n, 0)"""

OP13 = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, length(coalesce(text, '')) AS size, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS bare FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY bare) AS group_size, row_number() OVER w = 1 AS kept, sha256(bare) AS text_sha256
FROM d WINDOW w AS (PARTITION BY bare ORDER BY size DESC, doc_id NULLS LAST, rid)"""

#: XXH64 with its components (op5) and the models are not said in SQL.
ORACLE: dict[str, str] = {"op1_sharding": OP1, "op2_quality_rules": OP2, "op3_url_filters": OP3, "op4_line_dedup": OP4, "op6_decontamination": OP6,
                          "op11_spelling": OP11, "op12_conversations": OP12, "op13_exact_dedup": OP13}
