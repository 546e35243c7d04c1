"""Registered queries of the operators and their SQL twins."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import exact, extraction, mixing, ngram_lm, passages, pieces, simhash, spelling, toxicity, turns, urls, vectors, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark, sf_dir):
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_url_filter(spark, sf_dir):
    return urls.judge(_table(spark, sf_dir, "pages"))


def op3_substring_dedup(spark, sf_dir):
    return passages.near_passages(_table(spark, sf_dir, "documents"))


def op4_embedding_dedup(spark, sf_dir):
    return vectors.near_vectors(_table(spark, sf_dir, "embeddings"))


def op5_toxicity(spark, sf_dir):
    return toxicity.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_warc_audit(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages")
    return warc.audit_pages(pages, warc.damaged_copy(pages))


def op7_ngram_lm(spark, sf_dir):
    return ngram_lm.score_documents(_table(spark, sf_dir, "documents"))


def op8_sentencepiece(spark, sf_dir):
    return pieces.encode_documents(_table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark, sf_dir):
    return exact.exact_groups(_table(spark, sf_dir, "documents"))


def op10_mixing(spark, sf_dir):
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op11_html_extraction(spark, sf_dir):
    return extraction.extract(_table(spark, sf_dir, "pages"))


def op12_spelling(spark, sf_dir):
    return spelling.variants(_table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark, sf_dir):
    return turns.repaired(turns.damaged(_table(spark, sf_dir, "conversations")))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_url_filter": op2_url_filter,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_warc_audit": op6_warc_audit,
    "op7_ngram_lm": op7_ngram_lm,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_mixing": op10_mixing,
    "op11_html_extraction": op11_html_extraction,
    "op12_spelling": op12_spelling,
    "op13_conversation_repair": op13_conversation_repair,
}

# crc32 (reflected polynomial EDB88320) of UTF-8 texts, for the twins: the table from its rule, then one step per byte
_CRC = r"""crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce([i::UBIGINT] || list_transform(range(8), lambda k: 0::UBIGINT),
         lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END)) AS t)"""


def _crc(text: str) -> str:
    """SQL for the crc32 of ``text``; ``crc_table`` must be in the FROM clause."""
    octets = f"list_transform(range(strlen({text})), lambda i: ('0x' || substr(hex(encode({text})), 2 * i::INT + 1, 2))::UBIGINT)"
    return f"xor(list_reduce([4294967295::UBIGINT] || {octets}, lambda c, b: xor(c >> 8, t[xor(c & 255, b)::INT + 1])), 4294967295::UBIGINT)"


def _step(x: str, cost: str, letter: str) -> str:
    """SQL that adds an edit to a path, a text of nine digits of cost and its letters; null stays null."""
    return f"(lpad((substr({x}, 1, 9)::BIGINT + {cost})::VARCHAR, 9, '0') || substr({x}, 10) || {letter})"


def _match(x: str, initial: str) -> str:
    return _step(x, f"CASE WHEN e = '{initial}' THEN 0 ELSE 3 END + late", f"CASE WHEN e = '{initial}' THEN 'K' ELSE 'R' END")


SQL = {
    "op2_url_filter": r"""
WITH p AS (SELECT page_id, coalesce(url, '') AS url,
                  translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                  regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
     r AS (SELECT *, CASE
             WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
             WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
             WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
             WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
             WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule,
             translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM p),
     h AS (SELECT *,
             len(list_filter(['porn','porno','xxx','hentai','camgirls','milf','escorts','viagra','cialis','warez','torrent','casino'],
                 lambda t: regexp_matches(low, '(^|[^a-z0-9])' || t || '($|[^a-z0-9])')))::INTEGER AS strict_hits,
             len(list_filter(['adult','sex','nude','naked','erotic','dating','bet','betting','poker','slots','pills','crack','keygen','loan'],
                 lambda t: regexp_matches(low, '(^|[^a-z0-9])' || t || '($|[^a-z0-9])')))::INTEGER AS soft_hits FROM r)
SELECT page_id, host, path, rule,
       CASE rule WHEN 'org/' THEN 'allow' WHEN 'com/fr/' THEN 'allow' WHEN 'example.org/es/' THEN 'block'
                 WHEN 'example.org/en/1' THEN 'block' WHEN 'com/de/' THEN 'block'
                 ELSE CASE WHEN strict_hits >= 1 OR soft_hits >= 2 THEN 'block' ELSE 'allow' END END AS verdict,
       strict_hits, soft_hits FROM h""",
    "op6_warc_audit": r"""
WITH r AS (SELECT page_id, page_id // 4096 AS archive, coalesce(url, '') AS url, coalesce(html, '') AS body FROM pages),
     d AS (SELECT page_id, archive, url, CASE page_id % 97 WHEN 3 THEN '~' || substr(body, 2) WHEN 5 THEN left(body, greatest(length(body) - 1, 0)) ELSE body END AS body
           FROM r WHERE page_id % 97 <> 7),
     both_ AS (SELECT 1 AS side, * FROM r UNION ALL SELECT 2, * FROM d),
     w AS (SELECT side, page_id, archive, 'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url
                  || chr(13) || chr(10) || 'Content-Length: ' || strlen(body) || chr(13) || chr(10) || chr(13) || chr(10)
                  || body || chr(13) || chr(10) || chr(13) || chr(10) AS record FROM both_),
     h AS (SELECT side, page_id, archive, strlen(record)::BIGINT AS length, sha256(record) AS digest FROM w),
     o AS (SELECT *, row_number() OVER v AS ordinal, (sum(length) OVER v - length)::BIGINT AS start
           FROM h WINDOW v AS (PARTITION BY side, archive ORDER BY page_id, digest ROWS UNBOUNDED PRECEDING))
SELECT a.page_id, a.archive, a.ordinal, a.start, a.length, a.digest,
       CASE WHEN b.page_id IS NULL THEN 'missing' WHEN a.length <> b.length THEN 'resized' WHEN a.digest <> b.digest THEN 'altered'
            WHEN a.start <> b.start OR a.ordinal <> b.ordinal THEN 'moved' ELSE 'ok' END AS status
FROM o a LEFT JOIN o b ON b.side = 2 AND b.page_id = a.page_id WHERE a.side = 1""",
    "op9_exact_dedup": r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS cp,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
     r AS (SELECT *, first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS pos,
                  count(*) OVER (PARTITION BY norm) AS group_size
           FROM d WINDOW w AS (PARTITION BY norm ORDER BY cp DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size, pos = 1 AS kept, sha256(norm) AS text_sha256 FROM r""",
    # what these pages say themselves: the blocks of the article element
    "op11_html_extraction": r"""
WITH a AS (SELECT page_id, url, string_split_regex(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1), '</?(?:p|h1)>') AS parts FROM pages),
     t AS (SELECT page_id, url, list_transform(parts, lambda x: trim(regexp_replace(regexp_replace(replace(regexp_replace(x, '<[^>]*>', ' ', 'g'),
                  '&quot;', '"'), '&amp;?', '&', 'g'), '[\x09-\x0D\x20]+', ' ', 'g'))) AS blocks FROM a)
SELECT page_id, url, array_to_string(list_filter(blocks, lambda x: x <> ''), chr(10)) AS text,
       length(array_to_string(list_filter(blocks, lambda x: x <> ''), chr(10)))::BIGINT AS n_chars FROM t""",
    "op12_spelling": rf"""
WITH RECURSIVE {_CRC},
     r AS (SELECT coalesce(doc_id::VARCHAR, '') AS id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]{{7,}}')),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
     h AS (SELECT run, c, {_crc("(id || ':' || run)")} AS h FROM (SELECT id, run, count(*) AS c FROM r GROUP BY ALL), crc_table),
     w AS (SELECT word, sum(c)::BIGINT AS n FROM (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
                  ELSE run END AS word, c FROM h) GROUP BY word HAVING length(word) >= 7 AND sum(c) >= 2),
     d AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut
           FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM w)),
     p AS (SELECT x.word AS a, y.word AS b, y.n FROM d x JOIN d y ON x.cut = y.cut AND x.i = y.i AND x.word <> y.word
           UNION SELECT d.word, w.word, w.n FROM d JOIN w ON d.cut = w.word
           UNION SELECT w.word, d.word, d.n FROM d JOIN w ON d.cut = w.word),
     g AS (SELECT a, count(*) AS n_near, list({{'m': -n, 'b': b}} ORDER BY -n, b)[1] AS best FROM p GROUP BY a),
     f AS (SELECT word, CASE WHEN -best.m >= 10 * n THEN best.b END AS form, n, coalesce(n_near, 0)::BIGINT AS n_near,
                  CASE WHEN -best.m >= 10 * n THEN -best.m END::BIGINT AS form_n FROM w LEFT JOIN g ON a = word),
     s AS (SELECT word, word AS root FROM f UNION ALL SELECT s.word, f.form FROM s JOIN f ON f.word = s.root WHERE f.form IS NOT NULL)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN (SELECT s.word, s.root FROM s JOIN f ON f.word = s.root AND f.form IS NULL) e ON e.word = f.word""",
    # the least path to each end of the text written so far: nothing (x0), s (xs), ..u (xu), ..a (xa); turn after turn
    "op13_conversation_repair": rf"""
WITH RECURSIVE {_CRC},
     c AS MATERIALIZED (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                  {_crc("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS k FROM conversations, crc_table),
     d AS (SELECT conv_id, turn, CASE k WHEN 4 THEN 'user' ELSE role END AS role,
                  CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                  unnest(CASE k WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM c WHERE k <> 0),
     o AS (SELECT *, left(role, 1) AS e, right(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'), 1) AS tail,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i FROM d),
     f AS MATERIALIZED (SELECT *, CASE WHEN tail = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                          WHEN tail NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
                  coalesce(lag(e) OVER (PARTITION BY conv_id ORDER BY i) || e NOT IN ('su', 'ua', 'au'), false) AS illegal FROM o),
     g AS MATERIALIZED (SELECT conv_id, i, e, fault IN ('blank', 'duplicate') AS forced, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS late FROM f),
     p AS (SELECT conv_id, 0::BIGINT AS i, '000000000' AS x0, NULL::VARCHAR AS xs, '000000003I' AS xu, '000000006II' AS xa FROM (SELECT DISTINCT conv_id FROM c)
           UNION ALL
           SELECT conv_id, i, y0, ys, zu, least(ya, {_step("zu", "3", "'I'")}) FROM (
             SELECT conv_id, i, y0, ys, ya, least(yu, {_step("y0", "3", "'I'")}, {_step("ys", "3", "'I'")}, {_step("ya", "3", "'I'")}) AS zu FROM (
               SELECT p.conv_id, g.i, {_step("x0", "4", "'D'")} AS y0,
                      least({_step("xs", "4", "'D'")}, CASE WHEN e = 's' AND NOT forced THEN {_step("x0", "late", "'K'")} END) AS ys,
                      least({_step("xu", "4", "'D'")}, CASE WHEN NOT forced THEN least({_match("x0", "u")}, {_match("xs", "u")}, {_match("xa", "u")}) END) AS yu,
                      least({_step("xa", "4", "'D'")}, CASE WHEN NOT forced THEN {_match("xu", "a")} END) AS ya
               FROM p JOIN g ON g.conv_id IS NOT DISTINCT FROM p.conv_id AND g.i = p.i + 1))),
     b AS MATERIALIZED (SELECT conv_id, substr(best, 1, 9)::BIGINT AS cost, substr(best, 10) AS audit
           FROM (SELECT conv_id, least(arg_max(x0, i), arg_max(xa, i)) AS best FROM p GROUP BY conv_id)),
     l AS (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS pos FROM b),
     m AS (SELECT conv_id, pos, audit[pos] AS step, length(replace(left(audit, pos), 'I', '')) AS i, length(replace(left(audit, pos), 'D', '')) AS nth FROM l),
     w AS (SELECT m.conv_id, pos, step, nth, role, text, e, max(CASE WHEN nth = 1 AND step = 'K' AND e = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY m.conv_id) AS lead
           FROM m LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM m.conv_id AND f.i = m.i WHERE step <> 'D'),
     t AS (SELECT conv_id, string_agg(CASE WHEN step = 'K' THEN role WHEN (nth - lead) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':'
                  || CASE WHEN step = 'I' THEN '' ELSE text END, chr(10) ORDER BY pos) AS whole FROM w GROUP BY conv_id),
     a AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count_if(fault = 'blank')::BIGINT AS blank,
                  count_if(fault = 'duplicate')::BIGINT AS duplicate, count_if(fault = 'truncated')::BIGINT AS truncated, count_if(illegal)::BIGINT AS illegal
           FROM f GROUP BY conv_id)
SELECT b.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, cost, audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM b LEFT JOIN a ON a.conv_id IS NOT DISTINCT FROM b.conv_id LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM b.conv_id""",
}
