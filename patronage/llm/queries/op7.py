"""All conversations in reply order, quotes linked and left out."""

from patronage.llm import chat
from patronage.llm.queries import table

NAME = "op7_chat_formatting"
SQL = r"""
WITH RECURSIVE messages AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
quoting AS (
    SELECT DISTINCT conv_id FROM messages WHERE conv_id IS NOT NULL AND regexp_matches(text, '(?m)^[ \t]*>')),
texts AS (SELECT DISTINCT conv_id, turn, text FROM messages WHERE turn IS NOT NULL AND conv_id IN (FROM quoting)),
raws AS (
    SELECT conv_id, turn, text, string_split_regex(text, '\r?\n') AS parts,
        unnest(range(1, len(string_split_regex(text, '\r?\n')) + 1)) AS line FROM texts),
lines AS (
    SELECT conv_id, turn, text, line,
        length(regexp_replace(regexp_extract(parts[line], '^[ \t]*((?:>[ \t]*)+)', 1), '[^>]', '', 'g')) AS level,
        lower(trim(regexp_replace(regexp_replace(parts[line], '^[ \t]*((?:>[ \t]*)+)', ''), '\s+', ' ', 'g'))) AS words
    FROM raws),
flags AS (
    SELECT *, coalesce((level, words = '') <> lag((level, words = '')) OVER w, true)::INT AS begins
    FROM lines WINDOW w AS (PARTITION BY conv_id, turn, text ORDER BY line)),
runs AS (SELECT *, sum(begins) OVER (PARTITION BY conv_id, turn, text ORDER BY line) AS passage FROM flags),
kept AS (SELECT * FROM runs WHERE words <> ''),
passages AS (
    SELECT conv_id, turn, text, passage, level, string_agg(words, ' ' ORDER BY line) AS whole
    FROM kept GROUP BY ALL),
units AS (
    SELECT conv_id, turn, level, whole AS unit FROM passages UNION SELECT conv_id, turn, level, words FROM kept),
sources AS (
    SELECT q.conv_id, q.turn, q.unit, max(o.turn) AS source
    FROM (SELECT DISTINCT conv_id, turn, unit FROM units WHERE level > 0) q
    JOIN units o ON o.level = 0 AND o.conv_id = q.conv_id AND o.unit = q.unit AND o.turn < q.turn GROUP BY ALL),
votes AS (
    SELECT k.conv_id, k.turn, k.text, k.passage, k.level, coalesce(w.source, l.source) AS source,
        sum(length(words)) AS letters
    FROM kept k JOIN passages p USING (conv_id, turn, text, passage, level)
    LEFT JOIN sources w ON w.conv_id = k.conv_id AND w.turn = k.turn AND w.unit = p.whole
    LEFT JOIN sources l ON l.conv_id = k.conv_id AND l.turn = k.turn AND l.unit = k.words
    WHERE k.level > 0 GROUP BY ALL),
best AS (
    SELECT conv_id, turn, text, passage, level, sum(letters) AS letters,
        max_by(source, (source IS NOT NULL, letters, source)) AS source
    FROM votes GROUP BY conv_id, turn, text, passage, level),
levels AS (
    SELECT conv_id, turn, level, source, sum(letters) AS letters, count(*) AS n FROM best GROUP BY ALL),
replies AS (
    SELECT conv_id, turn, max_by(source, (-level, letters, source)) FILTER (source IS NOT NULL) AS reply_to,
        sum(n)::BIGINT AS n_quotes, coalesce(sum(n) FILTER (source IS NOT NULL), 0)::BIGINT AS n_linked
    FROM levels GROUP BY conv_id, turn),
back AS (
    SELECT conv_id, turn, reply_to AS thread FROM replies WHERE reply_to IS NOT NULL
    UNION
    SELECT b.conv_id, b.turn, r.reply_to FROM back b
    JOIN replies r ON r.conv_id = b.conv_id AND r.turn = b.thread WHERE r.reply_to IS NOT NULL),
threads AS (SELECT conv_id, turn, min(thread) AS thread FROM back GROUP BY conv_id, turn),
bodies AS (
    SELECT conv_id, turn, role, CASE WHEN regexp_matches(text, '(?m)^[ \t]*>') THEN
        regexp_replace(array_to_string(list_filter(string_split_regex(text, '\r?\n'),
            lambda x, i: NOT regexp_matches(x, '^[ \t]*>') AND NOT (regexp_matches(x, '^On .+ wrote:[ \t]*$')
                AND coalesce(regexp_matches(string_split_regex(text, '\r?\n')[i + 1], '^[ \t]*>'), false))), chr(10)),
            '^\s+|\s+$', '', 'g') ELSE text END AS body
    FROM messages)
SELECT b.conv_id, b.turn, role, body, reply_to, coalesce(thread, b.turn) AS thread,
    coalesce(n_quotes, 0) AS n_quotes, coalesce(n_linked, 0) AS n_linked,
    row_number() OVER (PARTITION BY b.conv_id ORDER BY coalesce(thread, b.turn) NULLS FIRST, b.turn NULLS FIRST,
        role NULLS FIRST, body NULLS FIRST) - 1 AS position,
    '<|im_start|>' || coalesce(role, '') || chr(10) || body || '<|im_end|>' || chr(10) AS formatted
FROM bodies b LEFT JOIN replies r ON r.conv_id = b.conv_id AND r.turn = b.turn
LEFT JOIN threads t ON t.conv_id = b.conv_id AND t.turn = b.turn
"""


def query(spark, sf_dir):
    return chat.conversations(table(spark, sf_dir, "conversations"))
