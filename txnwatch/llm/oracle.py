"""DuckDB SQL of the operators that SQL can express, written from their definitions and not from the Spark plans."""

from __future__ import annotations

from txnwatch.llm import chat, quality
from txnwatch.llm.secret_scan import LOWER, UPPER

SPACE = r"[\x20\x09-\x0D]+"


def words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{SPACE}'), lambda x: x <> '')"


def jaccard() -> str:
    return f"""WITH RECURSIVE d AS (SELECT doc_id, {words(f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')")} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
             WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (SELECT doc_id, doc_id AS root FROM documents UNION SELECT links.b, reach.root FROM reach JOIN links ON links.a = reach.doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least_root AS component_id
FROM (SELECT doc_id, min(root) AS least_root FROM reach GROUP BY doc_id) LEFT JOIN n USING (doc_id)"""


def quality_rules() -> str:
    rules, p = quality.RULES, quality.ALPHA
    tries = ", ".join(f"('{r}', {k}, {quality.at(r, k)})" for r in rules for k in range(quality.STEPS))
    top = " ".join(f"WHEN '{r}' THEN {t}" for r, (t, _, _) in rules.items())
    bottom = " ".join(f"WHEN '{r}' THEN {b}" for r, (_, b, _) in rules.items())
    beyond = f"(100 * (CASE rule {top} END) > percent * (CASE rule {bottom} END))"
    return f"""WITH t AS (SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, {words('t')} AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM t),
win AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' '))) AS g FROM w
        WHERE len(w) >= 8),
again AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (SELECT doc_id, sum(least(8, coalesce(nxt - i, 8))) AS n FROM (
              SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM again) GROUP BY doc_id),
m AS (SELECT doc_id, stratum, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(regexp_extract_all(t, '[!?]')) AS n_marks,
             len(regexp_extract_all(t, '[A-Z]')) AS n_upper, len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
             coalesce(covered.n, 0) AS n_repeat_words
      FROM w LEFT JOIN covered USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m),
good AS (SELECT doc_id, min(quality) AS good FROM labels WHERE quality IN (0, 1) GROUP BY doc_id),
tries(rule, step, percent) AS (VALUES {tries}),
marked AS (SELECT b.*, good FROM b JOIN good USING (doc_id)),
used AS (SELECT stratum, rule FROM marked CROSS JOIN tries WHERE good = 0 AND step = {quality.STEPS - 1} GROUP BY ALL
         HAVING 100 * count(*) FILTER (WHERE {beyond}) >= {quality.USEFUL} * count(*)),
tried AS (SELECT doc_id, stratum, good, step, bool_or({beyond}) AS broken
          FROM marked JOIN used USING (stratum) JOIN tries USING (rule) GROUP BY ALL),
seen AS (SELECT stratum, step, sum(good) AS n, sum(1 - good) AS bad, count(*) FILTER (WHERE good = 1 AND broken) AS k,
                count(*) FILTER (WHERE good = 0 AND broken) AS caught FROM tried GROUP BY ALL),
tested AS (SELECT *, CASE WHEN k >= n * {p} THEN 1.0 ELSE list_sum(list_transform(range(0, CAST(k + 1 AS BIGINT)), lambda i:
                     exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({p}) + (n - i) * ln(1 - {p})))) END
                     <= CAST({quality.DELTA} AS DOUBLE) / (SELECT count(DISTINCT stratum) FROM marked) AS holds
           FROM seen WHERE n > 0),
ok AS (SELECT *, caught / bad - k / n AS gain FROM tested QUALIFY bool_and(holds) OVER (PARTITION BY stratum ORDER BY step)),
best AS (SELECT stratum, step FROM ok WHERE caught > 0 AND gain > 0
         QUALIFY row_number() OVER (PARTITION BY stratum ORDER BY gain DESC, step) = 1),
cut AS (SELECT stratum, rule, percent FROM best JOIN used USING (stratum) JOIN tries USING (rule, step)),
dropped AS (SELECT DISTINCT doc_id FROM b JOIN cut USING (stratum) WHERE {beyond})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM dropped) AS kept
FROM b"""


def chat_windows() -> str:
    """Windows by their definition: spans per conversation, then for each window the earlier turns that its history may hold."""
    control = r"(\\*(?:</?s>|\[/?INST\]|<</?SYS>>|\[/?ROLE\]))"
    esc = lambda x: f"length(regexp_replace({x}, '{control}', '\\\\\\1', 'g'))"
    h, budget = chat.HISTORY, chat.BUDGET
    return f"""WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (SELECT *, len(regexp_extract_all(text, '\\w+|[^\\w\\s]')) + {chat.OVERHEAD} AS size,
        CASE role WHEN 'system' THEN 18 WHEN 'user' THEN 16 WHEN 'assistant' THEN 10 ELSE 22 + {esc('role')} END + {esc('text')} AS chars FROM c),
o AS (SELECT *, row_number() OVER w AS o, sum(size) OVER w - size AS p FROM t
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)),
sys AS (SELECT conv_id, size AS s_size, chars AS s_chars FROM o WHERE o = 1 AND role = 'system'),
b AS (SELECT o.*, coalesce(s_size, 0) AS s_size, coalesce(s_chars, 0) AS s_chars, greatest({budget - h} - coalesce(s_size, 0), {h}) AS room
      FROM o LEFT JOIN sys USING (conv_id) WHERE NOT (o.o = 1 AND o.role = 'system')),
k AS (SELECT *, CAST(p // room AS BIGINT) AS bucket FROM b),
span AS (SELECT *, 2 * bucket + CASE WHEN count(*) OVER g > 1 AND sum(size) OVER g > room AND p = max(p) OVER g THEN 1 ELSE 0 END AS win
         FROM k WINDOW g AS (PARTITION BY conv_id, bucket)),
wins AS (SELECT conv_id, win, min(p) AS start, sum(chars) AS chars, any_value(s_chars) AS s_chars FROM span GROUP BY ALL),
hist AS (SELECT w.conv_id, w.win, sum(s.chars) AS chars FROM wins w JOIN span s ON s.conv_id = w.conv_id AND s.p < w.start AND w.start - s.p <= {h}
         GROUP BY ALL),
made AS (SELECT conv_id, sum(wins.chars + wins.s_chars + coalesce(hist.chars, 0)) AS chars, count(*) AS n
         FROM wins LEFT JOIN hist USING (conv_id, win) GROUP BY conv_id),
conv AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY o) AS said,
           coalesce(string_agg(text, '' ORDER BY o) FILTER (WHERE role = 'assistant'), '') AS loss, max(chars) FILTER (WHERE o = 1) AS first_chars
         FROM o GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(coalesce(made.chars, first_chars) AS BIGINT) AS formatted_chars, coalesce(made.n, 1) AS n_windows
FROM conv LEFT JOIN made USING (conv_id)"""


def line_dedup() -> str:
    return f"""WITH l AS (SELECT doc_id, generate_subscripts(l, 1) AS i, unnest(l) AS line
              FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
k AS (SELECT *, translate(regexp_replace(regexp_replace(line, '^{SPACE}', ''), '{SPACE}$', ''), '{UPPER}', '{LOWER}') AS key FROM l),
many AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(many.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE many.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN many USING (key) GROUP BY doc_id"""


def filter_audit() -> str:
    letters = "VALUES ('A'), ('B'), ('C'), ('D'), ('E')"
    return f"""WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, {words('t')} AS w, min(doc_id) OVER (PARTITION BY t) AS first FROM t),
y AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id),
d AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
        (CASE WHEN len(w) < 100 THEN 'A' ELSE '' END) || (CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END) ||
        (CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t) THEN 'C' ELSE '' END) ||
        (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END) || (CASE WHEN doc_id > first THEN 'E' ELSE '' END) AS fails
      FROM w LEFT JOIN y USING (doc_id)),
g AS (SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM d GROUP BY ALL),
f(x) AS ({letters}),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS x, substr(filter_order, 1, step - 1) AS earlier FROM o, range(1, 6) r(step)),
e AS (SELECT g.*, s.*, contains(fails, x) AS hit, fails <> '' AND regexp_matches(earlier, '[' || fails || 'Z]') AS gone FROM g, s),
r AS (SELECT part, filter_order, step, x, coalesce(sum(n) FILTER (WHERE NOT hit AND NOT gone), 0) AS kept,
        coalesce(sum(n) FILTER (WHERE hit AND NOT gone), 0) AS removed, coalesce(sum(n) FILTER (WHERE hit AND gone), 0) AS redundant,
        coalesce(sum(n) FILTER (WHERE fails = x), 0) AS unique_fails, coalesce(sum(good) FILTER (WHERE hit AND NOT gone), 0) AS good_lost,
        coalesce(sum(toxic) FILTER (WHERE hit AND NOT gone), 0) AS toxic_lost
      FROM e GROUP BY part, filter_order, step, x)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM r"""


def ranked_search() -> str:
    term = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    terms = f"unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{term}'))"
    return f"""WITH p AS (SELECT doc_id, t, count(*) AS tf FROM (SELECT doc_id, {terms} AS t FROM documents) GROUP BY ALL),
d AS (SELECT doc_id, sum(tf) AS n FROM p GROUP BY doc_id),
z AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS len FROM d),
q AS (SELECT DISTINCT item_id, t FROM (SELECT item_id, {terms} AS t FROM benchmark)),
w AS (SELECT t, CAST(floor(1000 * ln((2 * docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM p, z
      WHERE t IN (SELECT t FROM q) GROUP BY t, docs),
s AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * CAST(n AS BIGINT) * docs) // len)))) AS BIGINT) AS score
      FROM q JOIN w USING (t) JOIN p USING (t) JOIN d USING (doc_id), z GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER r AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0
WINDOW r AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY row_number() OVER r <= 50"""


ORACLE: dict[str, str] = {
    "op1_chat_windows": chat_windows(),
    "op3_quality_rules": quality_rules(),
    "op7_jaccard_join": jaccard(),
    "op11_ranked_search": ranked_search(),
    "op12_filter_audit": filter_audit(),
    "op13_line_dedup": line_dedup(),
}
