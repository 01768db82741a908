"""DuckDB SQL for the queries of this package that SQL can express."""

ORACLES = {
    "op1_mixing": r"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         coalesce(('0x' || md5(doc_id::VARCHAR)[1:15])::BIGINT, 0) AS hash
  FROM documents),
sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source IS NULL, source COLLATE "binary") - 1) % 3]::DOUBLE AS weight
  FROM docs GROUP BY source),
levels AS (SELECT *, source_size * 2.0::DOUBLE AS most, source_size * 2.0::DOUBLE / weight AS level FROM sizes),
shares AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(most) OVER below, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER below, 0)) AS share
  FROM levels WINDOW below AS (ORDER BY level, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, least(most, coalesce(weight * max(share) FILTER (share <= level) OVER (), most)) AS target
  FROM shares),
passes AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS repeats FROM targets),
ordered AS (
  SELECT d.doc_id, d.size, p.source_size, target, repeats, target - repeats * p.source_size AS rest,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY hash, d.size, d.doc_id ROWS UNBOUNDED PRECEDING) AS upto
  FROM docs d JOIN passes p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       (size * (repeats + CASE WHEN repeats < 2 AND (upto <= rest OR upto - size < rest AND 2 * (rest - upto + size) >= size)
                               THEN 1 ELSE 0 END))::BIGINT AS taken
FROM ordered
""",
    "op4_exact_dedup": r"""
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY content ORDER BY points DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY content) AS group_size,
       row_number() OVER (PARTITION BY content ORDER BY points DESC, doc_id) = 1 AS kept,
       sha256(content) AS text_sha256
FROM (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
  FROM documents)
""",
    "op5_chat_formatting": r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
pieces AS (
  SELECT *, length('<|im_start|>' || url_encode(role) || chr(10) || regexp_replace(text, '<(\\*)[|]', '<\1\\|', 'g') || '<|im_end|>' || chr(10)) AS chars
  FROM turns),
heads AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS upto FROM pieces)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       coalesce(sum(upto - 1) FILTER (role = 'assistant'), 0)::BIGINT AS formatted_chars,
       count(*) FILTER (role = 'assistant') AS n_examples
FROM heads GROUP BY conv_id
""",
    "op11_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, row_number() OVER () AS r, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
owned AS (
  SELECT *, length(key) >= 10 AND doc_id > min(doc_id) OVER (PARTITION BY key) AS gone FROM keyed)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM owned GROUP BY doc_id
""",
    "op12_resampling": r"""
WITH crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
         lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps),
spoken AS (
  SELECT 'd' AS side, row_number() OVER () AS r, doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
  UNION ALL
  SELECT 't', row_number() OVER (), NULL, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')
  FROM benchmark),
runs AS (
  SELECT side, r, feature, count(*) AS times
  FROM (SELECT side, r, unnest(words || list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS feature
        FROM spoken)
  GROUP BY ALL),
hashed AS (
  SELECT feature, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
           list_transform(range(1, strlen(feature) + 1), lambda i: ('0x' || hex(feature)[2 * i - 1:2 * i])::BIGINT)),
           lambda c, b: xor(c >> 8, steps[1 + (xor(c, b) & 255)]))) % 10000 AS bucket
  FROM (SELECT DISTINCT feature FROM runs), crc),
sums AS (
  SELECT bucket, coalesce(sum(times) FILTER (side = 'd'), 0)::DOUBLE AS s, coalesce(sum(times) FILTER (side = 't'), 0)::DOUBLE AS t
  FROM runs JOIN hashed USING (feature) GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000))))::BIGINT AS gain
  FROM sums),
weighed AS (
  SELECT r, sum(times)::BIGINT AS n_features, floor(sum(times * gain) / sum(times))::BIGINT AS weight
  FROM runs JOIN hashed USING (feature) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY r),
scored AS (
  SELECT doc_id, len(words) >= 20 AS enough, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('7:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM spoken LEFT JOIN weighed USING (r) WHERE side = 'd'),
ranked AS (SELECT *, row_number() OVER (PARTITION BY enough ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY enough) AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN enough AND place <= 25 * n // 100 THEN place END AS rank FROM ranked
""",
    "op13_infill": r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units,
         sha256('7:' || doc_id) AS digest
  FROM documents),
drawn AS (
  SELECT *, len(units) AS n, ('0x' || digest[1:8])::BIGINT AS h1, ('0x' || digest[9:16])::BIGINT AS h2,
         ('0x' || digest[17:24])::BIGINT AS h3, ('0x' || digest[25:32])::BIGINT AS h4
  FROM cut),
parts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100
              THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
texts AS (
  SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
         array_to_string(units[b + 1:], '') AS suffix
  FROM parts)
SELECT doc_id, n, form,
       CASE WHEN form != 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form != 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM texts
""",
}
