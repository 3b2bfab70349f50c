"""DuckDB statements that compute whole results of registered queries from the same tables."""

from __future__ import annotations

from .shard_oracle import CRC_TABLE, OP11, crc32

# Words of a text as the contracts define them; a null text has none.
_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

OP2 = rf"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
windows AS (
  SELECT doc_id, i, w[i:i + 4] AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM split WHERE len(w) >= 5)),
repeated AS (
  SELECT doc_id, i FROM windows
  QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + d) AS n
  FROM repeated CROSS JOIN (SELECT unnest(range(0, 5)) AS d) GROUP BY doc_id),
measured AS (
  SELECT s.doc_id, len(w)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words, len(l)::BIGINT AS n_lines
  FROM split s LEFT JOIN covered c ON s.doc_id = c.doc_id),
bits AS (
  SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END)
          + (CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END)
          + (CASE WHEN n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 25 * n_words) THEN 4 ELSE 0 END)
          + (CASE WHEN n_words > 0 AND 10 * n_symbols > n_words THEN 8 ELSE 0 END)
          + (CASE WHEN 100 * n_dup_lines > 30 * n_lines THEN 16 ELSE 0 END) AS f
  FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (f & 3) <> 0 AS base_failed, f = 0 AS kept, f::BIGINT AS failed_bits
FROM bits
"""

OP3 = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, array_to_string(w, ' ') AS s FROM split WHERE len(w) BETWEEN 1 AND 3
  UNION
  SELECT doc_id, array_to_string(w[i:i + 3], ' ')
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 2)) AS i FROM split WHERE len(w) >= 4)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * c >= 80 * (p.n + q.n - c)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT DISTINCT doc_id, doc_id AS r FROM documents
  UNION
  SELECT reach.doc_id, both_ways.y FROM reach JOIN both_ways ON both_ways.x = reach.r)
SELECT d.doc_id, coalesce(any_value(z.n), 0)::BIGINT AS n_shingles, min(r) AS component_id, min(r) = d.doc_id AS kept
FROM documents d JOIN reach ON reach.doc_id = d.doc_id LEFT JOIN sizes z ON z.doc_id = d.doc_id
GROUP BY d.doc_id
"""

_CONTROL = r"(\\|<</SYS>>|\[/INST\]|<<SYS>>|\[INST\]|</s>|<s>|<\||\|>)"

OP5 = rf"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
joined AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
         coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '') AS loss,
         sum(23 + length(regexp_replace(role, '{_CONTROL}', '\1x', 'g'))
             + length(regexp_replace(text, '{_CONTROL}', '\1x', 'g'))
             + (length(role || chr(10) || text) - length(replace(role || chr(10) || text, '<|>', ''))) // 3) AS formatted
  FROM rows GROUP BY conv_id)
SELECT conv_id, n_turns::BIGINT AS n_turns, sha256(said) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
       sha256(loss) AS loss_sha256, formatted::BIGINT AS formatted_chars
FROM joined
"""

OP8 = rf"""
WITH split AS (SELECT doc_id, {_WORDS} AS w FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM split WHERE len(w) >= 50)),
later AS (SELECT doc_id, i FROM windows QUALIFY min(doc_id) OVER (PARTITION BY win) < doc_id),
removed AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM later),
gone AS (SELECT doc_id, list(i) AS l, count(*) AS n FROM removed GROUP BY doc_id),
kept AS (
  SELECT s.doc_id, string_agg(x, ' ' ORDER BY k) AS t
  FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS k FROM split) s
  LEFT JOIN removed r ON r.doc_id = s.doc_id AND r.i = s.k
  WHERE r.i IS NULL GROUP BY s.doc_id)
SELECT s.doc_id, len(w)::BIGINT AS n_words, coalesce(g.n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM split s LEFT JOIN gone g ON g.doc_id = s.doc_id LEFT JOIN kept k ON k.doc_id = s.doc_id
"""


def _share(parent: str, node: str) -> str:
    """Budgets of the children in `nodes_<node>`, filled in the order in which they run out."""
    by = f"PARTITION BY {parent}" if parent else ""
    keep = f"{parent}, {node}" if parent else node
    return f"""
run_{node} AS (
  SELECT *, sum(room) OVER ({by} ORDER BY room::DOUBLE / weight, {node} ROWS UNBOUNDED PRECEDING) AS cr,
         sum(weight) OVER ({by} ORDER BY room::DOUBLE / weight, {node} ROWS UNBOUNDED PRECEDING) AS cw,
         sum(weight) OVER ({by}) AS aw
  FROM nodes_{node} WHERE weight > 0),
full_{node} AS (SELECT *, cr * weight + room * (aw - cw) <= budget::HUGEINT * weight AS is_full FROM run_{node}),
rest_{node} AS (
  SELECT *, sum(CASE WHEN is_full THEN room ELSE 0 END) OVER ({by}) AS used,
         sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ({by}) AS open
  FROM full_{node}),
given_{node} AS (
  SELECT {keep}, CASE WHEN is_full THEN room ELSE ((budget - used) * weight) // nullif(open, 0) END AS budget
  FROM rest_{node})"""


OP9 = rf"""
WITH counted AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         CASE WHEN source IS NULL THEN 'other' WHEN right(source, 1) IN ('0', '1') THEN 'bulk'
              WHEN right(source, 1) IN ('2', '3', '4', '5') THEN 'web' ELSE 'curated' END AS domain,
         len({_WORDS})::BIGINT AS n_tokens
  FROM documents),
leaves AS (SELECT domain, lang, source, sum(n_tokens) AS supply, sum(n_tokens) * 3 AS room FROM counted GROUP BY ALL),
nodes_domain AS (
  SELECT domain, sum(room) AS room, (SELECT sum(supply) FROM leaves) * 600000 // 1000000 AS budget,
         CASE domain WHEN 'bulk' THEN 20 WHEN 'web' THEN 45 WHEN 'curated' THEN 35 ELSE 1 END AS weight
  FROM leaves GROUP BY domain),
{_share("", "domain").strip()},
nodes_lang AS (
  SELECT l.domain, l.lang, any_value(g.budget) AS budget, sum(l.room) AS room,
         CASE WHEN l.domain = 'other' THEN 1
              ELSE CASE l.lang WHEN 'en' THEN 40 WHEN 'de' THEN 25 WHEN 'fr' THEN 20 WHEN 'es' THEN 15 ELSE 1 END
         END AS weight
  FROM leaves l JOIN given_domain g ON l.domain = g.domain GROUP BY l.domain, l.lang),
{_share("domain", "lang").strip()},
nodes_source AS (
  SELECT l.domain, l.lang, l.source, l.room, g.budget, 1 AS weight
  FROM leaves l JOIN given_lang g ON l.domain = g.domain AND l.lang = g.lang),
{_share("domain, lang", "source").strip()},
planned AS (
  SELECT l.domain, l.lang, l.source, CASE WHEN supply > 0 THEN budget // supply ELSE 0 END AS passes,
         CASE WHEN supply > 0 THEN budget % supply ELSE 0 END AS rest
  FROM leaves l JOIN given_source g ON l.domain = g.domain AND l.lang = g.lang AND l.source = g.source),
placed AS (
  SELECT c.*, p.passes, p.rest,
         sum(n_tokens) OVER (PARTITION BY c.domain, c.lang, c.source
           ORDER BY md5('17:' || p.passes::BIGINT || ':' || doc_id), doc_id ROWS UNBOUNDED PRECEDING) AS sofar
  FROM counted c JOIN planned p ON c.domain = p.domain AND c.lang = p.lang AND c.source = p.source),
timed AS (
  SELECT *, passes + CASE WHEN rest > 0 AND sofar <= rest THEN 1 ELSE 0 END AS times FROM placed)
SELECT doc_id, domain, lang, source, n_tokens, unnest(range(0, times::BIGINT))::INTEGER AS epoch
FROM timed WHERE times > 0
"""

OP12 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
  FROM documents),
worded AS (
  SELECT lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
placed AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
sized AS (SELECT lang, w[i:i + s - 1] AS g FROM placed, (SELECT unnest(range(1, 6)) AS s) WHERE i + s - 1 <= len(w)),
counted AS (SELECT lang, g, count(*)::BIGINT AS f FROM sized GROUP BY lang, g),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE len(g) = 1 GROUP BY lang),
phrases AS (SELECT lang, g, f AS a FROM counted WHERE len(g) >= 2 AND f >= 100),
inside AS (
  SELECT p.lang, p.g[i:i + s - 1] AS g, p.a
  FROM phrases p, (SELECT unnest(range(2, 5)) AS s), (SELECT unnest(range(1, 5)) AS i)
  WHERE s < len(p.g) AND i + s - 1 <= len(p.g)),
kept AS (
  SELECT * FROM phrases p WHERE NOT EXISTS (
    SELECT 1 FROM inside x WHERE x.lang = p.lang AND x.g = p.g AND 100 * x.a >= 100 * p.a)),
cuts AS (
  SELECT p.lang, p.g, p.a, k, x.f AS l, y.f AS r, n,
         (1000::HUGEINT * p.a * n) // (x.f::HUGEINT * y.f) AS score
  FROM kept p JOIN (SELECT unnest(range(1, 5)) AS k) ON k < len(p.g)
  JOIN counted x ON x.lang = p.lang AND x.g = p.g[1:k]
  JOIN counted y ON y.lang = p.lang AND y.g = p.g[k + 1:]
  JOIN totals t ON t.lang = p.lang),
lowest AS (
  SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, k) AS place, array_to_string(g, ' ') AS phrase FROM cuts),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest WHERE place = 1)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""

OP13 = rf"""
WITH RECURSIVE {CRC_TABLE},
found AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]{{7,}}')),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
coded AS (
  SELECT run, {crc32("k", "digits")} AS code FROM (SELECT run, k, hex(k) AS digits FROM (SELECT run, doc_id || ':' || run AS k FROM found)), crc_table),
slipped AS (
  SELECT CASE WHEN code % 31 = 0 THEN run[:code % length(run)] || run[code % length(run) + 2:] ELSE run END AS word FROM coded),
vocabulary AS (
  SELECT word, count(*)::BIGINT AS n FROM slipped WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2),
dropped AS (
  SELECT word, i, word[:i - 1] || word[i + 1:] AS short FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM vocabulary)),
pairs AS (
  SELECT DISTINCT a.word AS x, b.word AS y FROM dropped a JOIN dropped b ON a.short = b.short AND a.i = b.i AND a.word < b.word
  UNION
  SELECT DISTINCT a.word, v.word FROM dropped a JOIN vocabulary v ON a.short = v.word),
both_ways AS (SELECT x, y FROM pairs UNION SELECT y, x FROM pairs),
near AS (
  SELECT x AS word, y, v.n AS near_n, count(*) OVER (PARTITION BY x) AS n_near,
         row_number() OVER (PARTITION BY x ORDER BY v.n DESC, y) AS place
  FROM both_ways JOIN vocabulary v ON v.word = y),
forms AS (
  SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN near_n >= 10 * v.n THEN y END AS form,
         CASE WHEN near_n >= 10 * v.n THEN near_n END AS form_n
  FROM vocabulary v LEFT JOIN near ON near.word = v.word AND place = 1),
follow AS (
  SELECT word, word AS root FROM forms
  UNION ALL
  SELECT follow.word, form FROM follow JOIN forms ON follow.root = forms.word WHERE form IS NOT NULL)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n
FROM forms f JOIN follow r ON r.word = f.word JOIN forms last ON last.word = r.root AND last.form IS NULL
"""

ORACLES: dict[str, str] = {
    "op2_quality_ledger": OP2,
    "op3_minhash_bbit": OP3,
    "op5_chat_parts": OP5,
    "op8_super_kmers": OP8,
    "op9_hierarchical_mix": OP9,
    "op11_feistel_shards": OP11,
    "op12_debruijn_phrases": OP12,
    "op13_spelling_trie": OP13,
}
