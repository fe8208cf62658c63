"""SQL that states the results of this subpackage's queries, where SQL can."""

import math

from .quality_rules import GAMMA, ZERO
from .url_filter import TWO_LABEL_SUFFIXES


def _shrunk(name: str, counts: str, level: str, parent: str, up: str) -> str:
    """Common table expressions: `name` (level's columns, mean, upper) of counts (level, up, n, k) under parent (up, mean)."""
    return f"""{name}_m AS (SELECT c.*, p.mean AS m FROM {counts} c JOIN {parent} p USING ({up})),
{name}_v AS (SELECT sum(n)::DOUBLE AS n, sum(power(k - n * m, 2) / n) AS ss, sum(m * (1 - m)) AS noise, sum(n * m * (1 - m)) / sum(n) AS v FROM {name}_m WHERE n > 0),
{name}_s AS (SELECT CASE WHEN ss / n - noise / n > 0 THEN least(greatest(v / (ss / n - noise / n) - 1, 2.0), 1000.0) ELSE 1000.0 END AS s FROM {name}_v),
{name}_ab AS (SELECT {name}_m.*, m * s + k AS a, (1 - m) * s + n - k AS b FROM {name}_m, {name}_s),
{name} AS (SELECT {level}, a / (a + b) AS mean, a / (a + b) + 1.645 * sqrt(a / (a + b) * (1 - a / (a + b)) / (a + b + 1)) AS upper FROM {name}_ab)"""


URL_FILTERS = f"""WITH seen AS (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
outcome AS (SELECT doc_id, min(CASE WHEN quality = 1 AND toxic = 0 THEN 1 ELSE 0 END) AS good FROM labels
  WHERE doc_id IS NOT NULL AND (quality = 1 AND toxic = 0) IS NOT NULL GROUP BY doc_id),
counted AS (SELECT host, count(good) AS n, coalesce(sum(good), 0) AS k FROM seen LEFT JOIN outcome ON page_id = doc_id GROUP BY host),
named AS (SELECT *, regexp_replace(host, '\\.?(:[0-9]*)?$', '') AS name FROM counted),
labelled AS (SELECT *, regexp_extract(name, '[^.]*$') AS one, regexp_extract(name, '(?:[^.]*\\.)?[^.]*$') AS two, regexp_extract(name, '(?:[^.]*\\.){{0,2}}[^.]*$') AS three, regexp_matches(name, '^([0-9.]+|\\[.*\\])$') AS ip FROM named),
sorted AS (SELECT *, list_contains({list(TWO_LABEL_SUFFIXES)}, two) AS pair FROM labelled),
hosts AS (SELECT host, n, k, CASE WHEN ip THEN name WHEN pair THEN three ELSE two END AS domain, CASE WHEN ip THEN 'ip' WHEN pair THEN two ELSE one END AS suffix, 1 AS root FROM sorted),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY domain, suffix),
suffixes AS (SELECT suffix, 1 AS root, sum(n) AS n, sum(k) AS k FROM domains GROUP BY suffix),
top AS (SELECT root, (sum(k) + 1) / (sum(n) + 2) AS mean FROM suffixes GROUP BY root),
{_shrunk("by_suffix", "suffixes", "suffix", "top", "root")},
{_shrunk("by_domain", "domains", "domain", "by_suffix", "suffix")},
{_shrunk("by_host", "hosts", "host", "by_domain", "domain")},
ruled AS (SELECT page_id, host, path, upper, CASE
  WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
  WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
  WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
  WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
  WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM seen LEFT JOIN by_host USING (host))
SELECT page_id, host, path, rule, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' WHEN upper < 0.5 THEN 'block' ELSE 'allow' END AS verdict FROM ruled"""


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

#: Documents with ids that are unique and not null, as all tables of this kind have.
JACCARD_JOIN = f"""WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
link AS (SELECT a.doc_id AS a, b.doc_id AS b FROM g a JOIN g b ON a.g = b.g AND a.doc_id < b.doc_id JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id GROUP BY 1, 2, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
e AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id WHERE r.c < e.b)
SELECT doc_id, coalesce(n, 0) AS n_shingles, c AS component_id FROM (SELECT doc_id, min(c) AS c FROM r GROUP BY 1) LEFT JOIN n USING (doc_id)"""

#: (measure, least distance of quartiles, whether low values fail), as quality_rules has them.
_RULES = "(VALUES ('symbol_share', 0.01, false), ('repeat_share', 0.05, false), ('dup_line_share', 0.1, false), ('word_length', 0.5, true)) v(measure, least, low)"
_BORDER = f"CASE WHEN {{0}} = {ZERO} THEN 0.0::DOUBLE ELSE pow({GAMMA!r}::DOUBLE, ({{0}} - {{1}})::DOUBLE) END"
_LOW, _HIGH = _BORDER.format("q1", 1), _BORDER.format("q3", 0)


def _fences(name: str, keys: str) -> str:
    """(keys, measure, n, lo, hi) of each group with bins (keys, measure, bin, n)."""
    by = f"{keys}, measure" if keys else "measure"
    return f"""{name}_r AS (SELECT *, sum(n) OVER (PARTITION BY {by}) AS total, sum(n) OVER (PARTITION BY {by} ORDER BY bin) AS upto FROM (SELECT {by}, bin, count(*) AS n FROM bins GROUP BY ALL)),
{name}_q AS (SELECT {by}, min(bin) FILTER (upto >= 0.25 * total) AS q1, min(bin) FILTER (upto >= 0.75 * total) AS q3, any_value(total) AS rows FROM {name}_r GROUP BY ALL),
{name} AS (SELECT {by}, rows, CASE WHEN low THEN {_LOW} - 3.0 * greatest({_HIGH} - {_LOW}, least::DOUBLE) ELSE '-inf'::DOUBLE END AS lo, {_HIGH} + 3.0 * greatest({_HIGH} - {_LOW}, least::DOUBLE) AS hi FROM {name}_q JOIN {_RULES} USING (measure))"""


QUALITY_RULES = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t, {_WORDS.format("coalesce(text, '')")} AS w, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM documents),
spots AS (SELECT r, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) AS g FROM d WHERE len(w) > 2),
twice AS (SELECT r, i FROM spots QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) o(k) GROUP BY 1),
c AS (SELECT d.r, doc_id, lang, source, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars, (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines FROM d LEFT JOIN rep ON rep.r = d.r),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c),
m AS (SELECT r, lang, source, unnest(['symbol_share', 'repeat_share', 'dup_line_share', 'word_length']) AS measure, unnest([coalesce(n_symbols::DOUBLE / nullif(word_chars, 0), 0), coalesce(n_repeat_words::DOUBLE / nullif(n_words, 0), 0), coalesce(n_dup_lines::DOUBLE / nullif(n_lines, 0), 0), coalesce(word_chars::DOUBLE / nullif(n_words, 0), 0)]) AS x FROM f WHERE NOT base_failed),
bins AS (SELECT lang, source, measure, CASE WHEN x > 0 THEN ceil(ln(x) / {math.log(GAMMA)!r}::DOUBLE)::BIGINT ELSE {ZERO} END AS bin FROM m),
{_fences("s", "lang, source")},
{_fences("l", "lang")},
{_fences("a", "")},
bad AS (SELECT DISTINCT r FROM m JOIN s ON s.lang IS NOT DISTINCT FROM m.lang AND s.source IS NOT DISTINCT FROM m.source AND s.measure = m.measure JOIN l ON l.lang IS NOT DISTINCT FROM m.lang AND l.measure = m.measure JOIN a ON a.measure = m.measure
 WHERE NOT CASE WHEN s.rows >= 100 THEN x BETWEEN s.lo AND s.hi WHEN l.rows >= 100 THEN x BETWEEN l.lo AND l.hi ELSE x BETWEEN a.lo AND a.hi END)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND bad.r IS NULL AS kept FROM f LEFT JOIN bad USING (r)"""

#: (id, f): the features of a table, a row each.
_FEATURES = r"""SELECT {id} AS id, w, unnest(CASE WHEN len(w) = 0 THEN [] ELSE list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]), list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END) AS f
  FROM (SELECT {id}, list_filter(regexp_split_to_array({text}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM {table})"""
#: CRC-32 by its definition, byte by byte, of each distinct feature.
IMPORTANCE_RESAMPLING = f"""WITH RECURSIVE crc_step(i, b, c) AS (SELECT 0, range, range::UBIGINT FROM range(256) UNION ALL SELECT i + 1, b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END FROM crc_step WHERE i < 8),
crc_table AS MATERIALIZED (SELECT list(c ORDER BY b) AS t FROM crc_step WHERE i = 8),
of_docs AS MATERIALIZED ({_FEATURES.format(id="doc_id", text=_LOWER, table="documents")}),
of_target AS MATERIALIZED ({_FEATURES.format(id="item_id", text=_LOWER, table="benchmark")}),
per_doc AS (SELECT doc_id, len(list_filter(regexp_split_to_array({_LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS n_words FROM documents),
hashed AS MATERIALIZED (SELECT f, xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(0, octet_length(encode(f))), lambda i: ('0x' || substr(hex(encode(f)), 2 * i + 1, 2))::UBIGINT)), lambda a, x: xor(a >> 8, t[((xor(a, x) & 255) + 1)::BIGINT])), 4294967295::UBIGINT) % 10000 AS bucket
  FROM (SELECT f FROM of_docs UNION SELECT f FROM of_target), crc_table),
s AS (SELECT bucket, count(*) AS n FROM of_docs JOIN hashed USING (f) GROUP BY 1),
t AS (SELECT bucket, count(*) AS n FROM of_target JOIN hashed USING (f) GROUP BY 1),
gain AS (SELECT range AS bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)::DOUBLE / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM range(10000) LEFT JOIN s ON s.bucket = range LEFT JOIN t ON t.bucket = range),
sums AS (SELECT id, count(*) AS n_features, sum(gain)::BIGINT AS weight FROM of_docs JOIN hashed USING (f) JOIN gain USING (bucket) GROUP BY 1),
scored AS (SELECT doc_id, n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || doc_id), 1, 8))::UBIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM per_doc LEFT JOIN sums ON id = doc_id),
drawn AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 5 * (SELECT count(*) FROM drawn) // 100 THEN rank END AS rank FROM scored LEFT JOIN drawn USING (doc_id)"""

FILL_IN_MIDDLE = """WITH h AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n, list_transform(range(4), lambda i: ('0x' || substr(sha256('1:' || doc_id), 8 * i + 1, 8))::BIGINT) AS h FROM documents),
c AS (SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain' WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, substring(t, 1, a) AS pre, substring(t, a + 1, b - a) AS mid, substring(t, b + 1) AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(pre || mid || suf) AS restored_sha256 FROM p"""

SQL = {"op11_importance_resampling": IMPORTANCE_RESAMPLING, "op12_fill_in_middle": FILL_IN_MIDDLE, "op1_ngram_jaccard_join": JACCARD_JOIN, "op5_quality_rules": QUALITY_RULES, "op6_url_filters": URL_FILTERS}
