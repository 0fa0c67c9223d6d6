"""SQL counterparts of the operators that SQL can express."""

from __future__ import annotations

from levygrid.llm.licenses import TEMPLATES

_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"

_QUALITY = rf"""
WITH d AS MATERIALIZED (
    SELECT doc_id, coalesce(source, '<none>') AS source, coalesce(text, '') AS text,
           {_WORDS.format(text="coalesce(text, '')")} AS w
    FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(w) - 3)) AS i, w FROM d WHERE len(w) >= 5),
g AS MATERIALIZED (SELECT doc_id, i, w[i:i+4] AS g FROM p),
twice AS (SELECT doc_id, g FROM g GROUP BY doc_id, g HAVING count(*) > 1),
cover AS (SELECT DISTINCT doc_id, unnest([i, i+1, i+2, i+3, i+4]) AS k FROM g JOIN twice USING (doc_id, g)),
rep AS (SELECT doc_id, count(*) AS n_repeat_words FROM cover GROUP BY doc_id),
m AS MATERIALIZED (
    SELECT d.doc_id, source, len(w)::BIGINT AS n_words,
           length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
           (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
           coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(l) AS n_lines
    FROM (SELECT *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d) d
    LEFT JOIN rep USING (doc_id)),
f AS MATERIALIZED (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base,
           100 * n_symbols > 10 * n_words AS symbols, n_dup_lines >= 3 AND 100 * n_dup_lines > 30 * n_lines AS lines,
           word_chars < 3 * n_words OR word_chars > 10 * n_words AS size
    FROM m),
h AS (
    SELECT source, count(*) AS n, count_if(base) AS base, count_if(symbols) AS symbols,
           count_if(lines) AS lines, count_if(size) AS size,
           count_if(base OR symbols OR lines OR size) AS broken
    FROM f GROUP BY source),
r AS (SELECT source, n, unnest([
        {{'rule': 'base', 'k': base}}, {{'rule': 'symbols', 'k': symbols}}, {{'rule': 'lines', 'k': lines}},
        {{'rule': 'size', 'k': size}}, {{'rule': 'broken', 'k': broken}}], recursive := true) FROM h),
prior AS (SELECT rule, avg(k / n) AS mean, var_pop(k / n) AS spread FROM r GROUP BY rule),
strength AS (
    SELECT rule, mean, greatest(1.0, CASE WHEN spread > 0 THEN mean * (1 - mean) / spread - 1 ELSE 1e6 END) AS s
    FROM prior),
v AS (SELECT source, rule, (k + mean * s) / (n + s) AS rate FROM r JOIN strength USING (rule)),
verdict AS (
    SELECT source, bool_or(rule = 'base' AND rate >= 0.02) AS base_on,
           bool_or(rule = 'symbols' AND rate >= 0.02) AS symbols_on,
           bool_or(rule = 'lines' AND rate >= 0.02) AS lines_on,
           bool_or(rule = 'size' AND rate >= 0.02) AS size_on,
           bool_or(rule = 'broken' AND rate >= 0.9) AS blocked
    FROM v GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base AS base_failed,
       NOT (base OR blocked OR (symbols AND symbols_on) OR (lines AND lines_on) OR (size AND size_on)) AS kept
FROM f JOIN verdict USING (source)
"""

_MIXING = rf"""
WITH d AS MATERIALIZED (
    SELECT doc_id, source, len({_WORDS.format(text="coalesce(text, '')")})::BIGINT AS size,
           md5('42/' || coalesce(CAST(doc_id AS VARCHAR), '')) AS draw FROM documents),
s AS (
    SELECT source, sum(size)::HUGEINT AS source_size,
           [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::HUGEINT AS weight
    FROM d GROUP BY source),
o AS (
    SELECT *, coalesce(sum(2 * source_size) OVER before, 0)::HUGEINT AS closed,
           sum(weight) OVER onward AS open, sum(source_size) OVER () AS total
    FROM s
    WINDOW before AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
           onward AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
c AS (SELECT *, weight * (3 * total - 2 * closed)::HUGEINT > 4 * source_size * open::HUGEINT AS capped FROM o),
u AS (
    SELECT coalesce(sum(CASE WHEN capped THEN 2 * source_size END), 0)::HUGEINT AS words,
           sum(CASE WHEN NOT capped THEN weight END)::HUGEINT AS open, any_value(total)::HUGEINT AS total FROM c),
t AS (
    SELECT source, source_size::BIGINT AS source_size,
           CASE WHEN capped THEN (2 * source_size)::DOUBLE
                ELSE (weight * (3 * u.total - 2 * u.words))::DOUBLE / (2 * u.open)::DOUBLE END AS target
    FROM c, u),
e AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM t),
r AS (
    SELECT doc_id, size, source_size, target, epochs, floor(target)::BIGINT - epochs * source_size AS rest,
           coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY draw
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
    FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
       (epochs * size + least(size, greatest(0, rest - before)))::BIGINT AS taken
FROM r
"""


_VALUES = ", ".join("({}, '{}', '{}')".format(i, a, b.replace("'", "''")) for i, (a, b) in enumerate(TEMPLATES))
_NORMAL = "string_split(trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g')), ' ')"

_LICENSES = rf"""
WITH t AS (SELECT tid, license_id, {_NORMAL.format("body")} AS w FROM (VALUES {_VALUES}) AS v(tid, license_id, body)),
tb AS MATERIALIZED (
    SELECT tid, license_id, len(w) - 1 AS n, w[i] || ' ' || w[i+1] AS g, count(*) AS c
    FROM (SELECT *, unnest(range(1, len(w))) AS i FROM t) GROUP BY ALL),
p AS (
    SELECT doc_id, unnest(list_distinct(list_concat(
        string_split(x, chr(10)), string_split_regex(x, '\n[ \t\r]*\n'), [x]))) AS passage
    FROM (SELECT DISTINCT doc_id, coalesce(text, '') AS x FROM documents)),
q AS MATERIALIZED (
    SELECT DISTINCT doc_id, array_to_string(w, ' ') AS passage, w
    FROM (SELECT doc_id, {_NORMAL.format("passage")} AS w FROM p)
    WHERE len(w) BETWEEN 2 AND (SELECT 2 * max(n) FROM tb)),
qb AS (
    SELECT doc_id, passage, len(w) - 1 AS n, w[i] || ' ' || w[i+1] AS g, count(*) AS c
    FROM (SELECT *, unnest(range(1, len(w))) AS i FROM q) GROUP BY ALL),
d AS (
    SELECT qb.doc_id, passage, license_id,
           2 * sum(least(qb.c, tb.c))::BIGINT / (any_value(qb.n) + any_value(tb.n)) AS dice
    FROM qb JOIN tb USING (g) GROUP BY qb.doc_id, passage, license_id, tid),
b AS (
    SELECT doc_id, passage, license_id, dice FROM d WHERE 100 * dice >= 80
    QUALIFY row_number() OVER (PARTITION BY doc_id, passage ORDER BY dice DESC, license_id) = 1)
SELECT doc_id, license_id, max(dice) AS dice, count(*) AS n_passages FROM b GROUP BY doc_id, license_id
"""

_QUOTES = r"""
WITH RECURSIVE m AS MATERIALIZED (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS n,
           string_split_regex(coalesce(text, ''), '\r?\n') AS ls FROM conversations),
l AS MATERIALIZED (
    SELECT conv_id, n, i, len(prefix) - len(replace(prefix, '>', '')) AS level, body,
           trim(regexp_replace(lower(body), '[ \t\n\x0B\f\r]+', ' ', 'g')) AS norm
    FROM (SELECT conv_id, n, i, regexp_extract(ls[i], '^([ \t]*>)+') AS prefix,
                 regexp_replace(ls[i], '^([ \t]*>)+ ?', '') AS body
          FROM (SELECT conv_id, n, ls, unnest(range(1, len(ls) + 1)) AS i FROM m))),
s AS (
    SELECT *, CASE WHEN lag(level) OVER w IS DISTINCT FROM level THEN 1 ELSE 0 END AS fresh
    FROM l WHERE norm <> '' WINDOW w AS (PARTITION BY conv_id, n ORDER BY i)),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY conv_id, n ORDER BY i) AS run FROM s),
u AS MATERIALIZED (
    SELECT conv_id, n, level, norm AS unit FROM g
    UNION
    SELECT conv_id, n, level, string_agg(norm, ' ' ORDER BY i) FROM g GROUP BY conv_id, n, level, run),
o AS (SELECT conv_id, unit, min(n) AS origin FROM u WHERE level = 0 GROUP BY conv_id, unit),
k AS (
    SELECT u.conv_id, u.n, level, CASE WHEN origin < u.n THEN origin END AS origin
    FROM u LEFT JOIN o ON u.unit = o.unit AND u.conv_id IS NOT DISTINCT FROM o.conv_id WHERE level > 0),
a AS (
    SELECT conv_id, n, count(*) AS quotes, count(origin) AS matched, max(level)::INTEGER AS levels,
           min(CASE WHEN origin IS NOT NULL THEN {'level': level, 'o': -origin} END) AS nearest
    FROM k GROUP BY conv_id, n),
v AS MATERIALIZED (
    SELECT m.conv_id, m.n, turn, role, text, coalesce(-nearest.o, CASE WHEN m.n > 1 THEN m.n - 1 END) AS reply_to,
           coalesce(quotes, 0) AS quotes, coalesce(matched, 0) AS matched, coalesce(levels, 0) AS levels
    FROM m LEFT JOIN a ON m.n = a.n AND m.conv_id IS NOT DISTINCT FROM a.conv_id),
h AS (
    SELECT conv_id, n, 0::BIGINT AS depth FROM v WHERE reply_to IS NULL
    UNION ALL
    SELECT v.conv_id, v.n, depth + 1 FROM v JOIN h ON v.reply_to = h.n AND v.conv_id IS NOT DISTINCT FROM h.conv_id),
e AS (
    SELECT *, coalesce(lead(level) OVER (PARTITION BY conv_id, n ORDER BY i), 0) AS next FROM l),
x AS (
    SELECT conv_id, n, trim(regexp_replace(string_agg(body, chr(10) ORDER BY i),
        '^[ \t\n\x0B\f\r]+|[ \t\n\x0B\f\r]+$', '', 'g')) AS own
    FROM e WHERE level = 0 AND NOT (next > 0 AND regexp_matches(body,
        '(?i)^[ \t\n\x0B\f\r]*(?:on\b.*\bwrote|.*\bwrote|.*\bwrites)[ \t\n\x0B\f\r]*:[ \t\n\x0B\f\r]*$'))
    GROUP BY conv_id, n)
SELECT v.conv_id, v.n AS position, turn, role, CASE WHEN text IS NOT NULL THEN coalesce(own, '') END AS text,
       reply_to, depth, levels AS quote_levels, quotes, matched
FROM v JOIN h ON v.n = h.n AND v.conv_id IS NOT DISTINCT FROM h.conv_id
LEFT JOIN x ON v.n = x.n AND v.conv_id IS NOT DISTINCT FROM x.conv_id
"""


_TERMS = (
    r"regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)

_LEXICAL = f"""
WITH d AS MATERIALIZED (
    SELECT row_number() OVER () AS r, doc_id, {_TERMS.format(text="coalesce(text, '')")} AS w FROM documents),
c AS (SELECT count(*)::BIGINT AS docs, sum(len(w))::BIGINT AS total FROM d WHERE len(w) > 0),
i AS MATERIALIZED (
    SELECT q, item_id, term, count(*)::BIGINT AS k
    FROM (SELECT q, item_id, unnest(w) AS term FROM (
        SELECT row_number() OVER () AS q, item_id, {_TERMS.format(text="coalesce(text, '')")} AS w FROM benchmark))
    GROUP BY q, item_id, term),
f AS MATERIALIZED (
    SELECT r, doc_id, n, term, count(*)::BIGINT AS tf
    FROM (SELECT r, doc_id, len(w)::BIGINT AS n, unnest(w) AS term FROM d)
    WHERE term IN (SELECT term FROM i) GROUP BY r, doc_id, n, term),
s AS (
    SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
    FROM f, c GROUP BY term, docs),
p AS (
    SELECT q, item_id, r, doc_id,
           sum(k * weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // total))))::BIGINT AS score
    FROM f JOIN s USING (term) JOIN i USING (term), c GROUP BY q, item_id, r, doc_id),
o AS (
    SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
    FROM p WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_license_scan": _LICENSES,
        "op3_quality_rules": _QUALITY,
        "op9_source_mixing": _MIXING,
        "op10_quotation_linking": _QUOTES,
        "op12_lexical_search": _LEXICAL,
    }
