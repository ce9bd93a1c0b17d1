"""DuckDB SQL for the queries of this subpackage that SQL can express.

The others (models, tokenizers, alignment, spans) are tested against brute
force in ``tests/llm``.
"""

from __future__ import annotations

from .quality_rules import BLEND, LENGTH_WORDS, LOW, MAX_REPEAT_PERCENT, MID, MIN_WORDS, RATES, WINDOW

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _quality() -> str:
    rate = {
        "symbol_rate": "n_symbols / nullif(n_words, 0)",
        "dup_line_rate": "n_dup_lines / nullif(n_lines, 0)",
        "repeat_rate": "n_repeat_words / nullif(n_words, 0)",
        "word_length": f"CASE WHEN n_words >= {LENGTH_WORDS} THEN word_chars / n_words END",
    }
    levels = {"own": ["lang", "source"], "lang": ["lang"], "everything": []}
    ctes, bounds, inside = [], [], []
    for level, keys in levels.items():
        stats = ", ".join(f"count({c}) AS n_{c}, quantile_disc({c}, {LOW}) AS lo_{c}, quantile_disc({c}, {MID}) AS mid_{c}" for c in rate)
        by = f"GROUP BY {', '.join(keys)}" if keys else ""
        ctes.append(f"{level} AS (SELECT {', '.join([*keys, stats])} FROM passed {by})")
    for c, (reach, floor, below) in RATES.items():
        drawn = lambda of, v, parent, c=c: f"CASE WHEN {of}.n_{c} > 0 THEN ({of}.n_{c}::DOUBLE * {of}.n_{c}::DOUBLE * {of}.{v}_{c} + {BLEND**2}::DOUBLE * ({parent})) / ({of}.n_{c}::DOUBLE * {of}.n_{c}::DOUBLE + {BLEND**2}::DOUBLE) ELSE {parent} END"
        pick = lambda v, c=c: drawn("own", v, drawn("lang", v, f"everything.{v}_{c}"))
        bounds.append(f"{pick('mid')} AS mid_{c}, {reach} * greatest(({pick('mid')}) - ({pick('lo')}), {floor}) AS spread_{c}")
        low = f" AND {c} >= mid_{c} - spread_{c}" if below else ""
        inside.append(f"coalesce({c} <= mid_{c} + spread_{c}{low}, true)")
    return f"""
WITH words AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, {_WORDS} AS w,
                      list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines,
                      row_number() OVER () AS rid FROM documents),
windows AS (SELECT rid, i, array_to_string(list_slice(w, i, i + {WINDOW - 1}), ' ') AS g
            FROM (SELECT rid, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM words WHERE len(w) >= {WINDOW})),
again AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM windows) WHERE c > 1),
inside AS (SELECT rid, count(DISTINCT i + k) AS n FROM again, range(0, {WINDOW}) AS r(k) GROUP BY rid),
base AS (SELECT words.rid, doc_id, lang, source, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
                len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(lines) AS n_lines,
                len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(inside.n, 0) AS n_repeat_words
         FROM words LEFT JOIN inside ON inside.rid = words.rid),
rates AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
                 {', '.join(f'{e} AS {c}' for c, e in rate.items())} FROM base),
passed AS (SELECT * FROM rates WHERE NOT base_failed),
{', '.join(ctes)},
bounds AS (SELECT own.lang, own.source, {', '.join(bounds)}
           FROM own JOIN lang ON own.lang IS NOT DISTINCT FROM lang.lang CROSS JOIN everything)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, base_failed, NOT base_failed AND {' AND '.join(inside)} AS kept
FROM rates LEFT JOIN bounds ON rates.lang IS NOT DISTINCT FROM bounds.lang AND rates.source IS NOT DISTINCT FROM bounds.source
"""


_CHATS = r"""
WITH rows_ AS (SELECT conv_id, turn, role, text FROM conversations
               UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
               UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
said AS (SELECT conv_id, turn, role AS r, text AS t, coalesce(role, '') AS role, coalesce(text, '') AS text FROM rows_)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST)) AS loss_sha256,
       sum(24 + length(regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\\\1|', 'g'))
              + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')))::BIGINT AS formatted_chars
FROM said GROUP BY conv_id
"""

_NEAR = f"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                 '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 2), ' ') AS g
             FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (SELECT a.doc_id AS a, b.doc_id AS b
          FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id
          JOIN sizes sa ON sa.doc_id = a.doc_id JOIN sizes sb ON sb.doc_id = b.doc_id
          WHERE 100 * least(sa.n, sb.n) >= 85 * greatest(sa.n, sb.n)
          GROUP BY a.doc_id, b.doc_id, sa.n, sb.n HAVING 100 * count(*) >= 85 * (sa.n + sb.n - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS c FROM sizes UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.c),
least_ AS (SELECT a, min(c) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, coalesce(l.component_id, d.doc_id) AS component_id, d.doc_id = coalesce(l.component_id, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN least_ l ON l.a = d.doc_id
"""

ORACLE: dict[str, str] = {
    "op1_quality_rules": _quality(),
    "op9_chat_formatting": _CHATS,
    "op10_minhash_near_dedup": _NEAR,
}
