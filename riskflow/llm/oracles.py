"""Reference SQL of the check queries that SQL can express, for DuckDB over views named like the tables."""

from __future__ import annotations

import string

from riskflow.llm import collocations, quality, secrets

_BLANKS = "(' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
_WORD = r"[^\x20\x09-\x0D]+"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _letters(column: str) -> str:
    return f"length(regexp_replace({column}, '[\\x20\\x09-\\x0D]+', '', 'g'))"


def line_quality() -> str:
    boiler = " OR ".join(f"contains(lower(body), {_text(p)})" for p in quality.BOILERPLATE)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
b AS (SELECT doc_id, t, regexp_extract_all(t, '{_WORD}') AS words FROM d),
w AS (SELECT doc_id, unnest(words) AS w1, generate_subscripts(words, 1) AS i FROM b),
follow AS (SELECT doc_id, i, w1, lead(w1) OVER o AS w2, lead(w1, 2) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
counted AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w1, w2, w3) AS n FROM follow WHERE w3 IS NOT NULL),
covered AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM counted, (VALUES (0), (1), (2)) AS p(j) WHERE counted.n > 1 GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
bodies AS (SELECT doc_id, line, trim(line, {_BLANKS}) AS body FROM l),
judged AS (SELECT doc_id, line, body, len(regexp_extract_all(body, '{_WORD}')) AS n FROM bodies),
marked AS (SELECT *, length(body) - length(translate(body, {_text(quality.SEPARATORS)}, '')) AS marks,
    len(string_split_regex(ltrim(regexp_replace(body, {_text(quality.PAIRED)}, '_', 'g'), {_text(quality.LEADING)} || {_BLANKS}),
      {_text(quality.SEPARATOR_RUN)})) AS items,
    len(regexp_extract_all(translate(body, {_text(quality.SEPARATORS)}, {_text(" " * len(quality.SEPARATORS))}), '{_WORD}')) AS parts
  FROM judged),
faulty AS (SELECT *, body <> '' AND ((marks >= {quality.MENU_MARKS} AND items > {quality.MENU_MARKS} AND parts <= {quality.ITEM_WORDS} * items)
    OR regexp_matches(body, {_text(quality.MENU_WORDS)}) OR (n < 40 AND ({boiler}))
    OR (n < {quality.WRAPPED_WORDS} AND NOT regexp_matches(body, {_text(quality.ENDINGS)}))) AS fault FROM marked),
lines AS (SELECT doc_id, count(*) FILTER (body <> '') AS n_lines,
    count(*) FILTER (body <> '') - count(DISTINCT line) FILTER (body <> '') AS n_dup_lines,
    count(*) FILTER (fault) AS n_removed_lines, coalesce(sum({_letters('line')}) FILTER (fault), 0) AS lost
  FROM faulty GROUP BY doc_id),
base AS (SELECT b.doc_id, len(words) AS n_words, {_letters('t')} AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, n_dup_lines,
    coalesce(covered.n, 0) AS n_repeat_words, n_lines, n_removed_lines, lost
  FROM b JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
failed AS (SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 100 * lost <= {quality.MOST_LOST} * word_chars AS kept, n_lines, n_removed_lines
FROM failed"""


def secret_spans() -> str:
    rules = "\nUNION ALL ".join(
        f"""SELECT doc_id, '{r.kind}' AS kind, {i} AS rule, {r.shortest} AS shortest,
  unnest(list_zip(string_split_regex(t, {_text(r.pattern)})[:-2], regexp_extract_all(t, {_text(r.pattern)}, 0),
    regexp_extract_all(t, {_text(r.pattern)}, {r.group}), regexp_extract_all(t, {_text(r.pattern)}, {r.span}))) AS piece,
  generate_subscripts(regexp_extract_all(t, {_text(r.pattern)}, 0), 1) AS place FROM d"""
        for i, r in enumerate(secrets.RULES)
    )
    base = ", ".join(f"'{r.kind}'" for r in secrets.BASE_RULES)
    joined = lambda where: f"coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rule){where}, '')"
    counts = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in secrets.BASE_RULES)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
pieces AS ({rules}),
ends AS (SELECT doc_id, kind, rule, shortest, length(piece[4]) AS n, length(piece[3]) AS part,
    sum(length(piece[1]) + length(piece[2])) OVER (PARTITION BY doc_id, rule ORDER BY place) AS e FROM pieces),
spans AS (SELECT doc_id, kind, rule, e - n AS s, e FROM ends WHERE part >= shortest)
SELECT doc_id, {counts}, sha256({joined(f" FILTER (kind IN ({base}))")}) AS base_sha256, {joined("")} AS spans
FROM d LEFT JOIN spans USING (doc_id) GROUP BY doc_id"""


def phrase_scores() -> str:
    low = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    c = collocations
    return f"""
WITH pieces AS (SELECT row_number() OVER () AS piece, lang, piece_text FROM (
    SELECT coalesce(lang, '{c.NO_LANG}') AS lang, unnest(string_split_regex({low}, '[.,;:!?\x0A-\x0D]')) AS piece_text FROM documents)),
spelt AS (SELECT piece, lang, regexp_extract_all(piece_text, '[^\x20\x09]+') AS words FROM pieces),
w AS (SELECT piece, lang, unnest(words) AS w1, generate_subscripts(words, 1) AS i FROM spelt),
follow AS (SELECT lang, w1, lead(w1) OVER o AS w2, lead(w1, 2) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY piece ORDER BY i)),
f1 AS (SELECT lang, w1, count(*)::HUGEINT AS f FROM follow GROUP BY ALL),
f2 AS (SELECT lang, w1, w2, count(*)::HUGEINT AS f FROM follow WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= {c.SUPPORT}),
f3 AS (SELECT lang, w1, w2, w3, count(*)::HUGEINT AS f FROM follow WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= {c.SUPPORT}),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY lang),
cuts AS (
  SELECT f2.lang, f2.w1 || ' ' || f2.w2 AS phrase, 1 AS k, f2.f AS a, x.f AS l, y.f AS r
  FROM f2 JOIN f1 x ON x.lang = f2.lang AND x.w1 = f2.w1 JOIN f1 y ON y.lang = f2.lang AND y.w1 = f2.w2
  WHERE NOT EXISTS (SELECT 1 FROM f3 WHERE f3.lang = f2.lang AND f3.w1 = f2.w1 AND f3.w2 = f2.w2 AND 100 * f3.f >= {c.COVERED} * f2.f)
    AND NOT EXISTS (SELECT 1 FROM f3 WHERE f3.lang = f2.lang AND f3.w2 = f2.w1 AND f3.w3 = f2.w2 AND 100 * f3.f >= {c.COVERED} * f2.f)
  UNION ALL
  SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, 1, f3.f, x.f, y.f
  FROM f3 JOIN f1 x ON x.lang = f3.lang AND x.w1 = f3.w1 JOIN f2 y ON y.lang = f3.lang AND y.w1 = f3.w2 AND y.w2 = f3.w3
  UNION ALL
  SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, 2, f3.f, x.f, y.f
  FROM f3 JOIN f2 x ON x.lang = f3.lang AND x.w1 = f3.w1 AND x.w2 = f3.w2 JOIN f1 y ON y.lang = f3.lang AND y.w1 = f3.w3),
scored AS (SELECT *, 1000000 * a * a // (l * r) AS score FROM cuts),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN n USING (lang) WHERE rank <= {c.TOP}"""


ORACLES = {"op11_collocations": phrase_scores(), "op4_secrets": secret_spans(), "op6_line_quality": line_quality()}
