"""DuckDB SQL that gives the rows of the queries, written independently of them."""

from __future__ import annotations

from corpusmill.plans.steps import JUDGE_PROMPT, LABEL_PROMPT
from corpusmill.queries import KEY_TERMS, WORDS

# RE2 knows ASCII white space only, so that the class is spelled out.
WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
EMAIL = r"\b[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}\b"
PHONE = r"(?:(?:\+?\d{1,3}[-.\s]?)?(?:\(?\d{2,4}\)?[-.\s]?)?\d{3,4}[-.\s]?\d{4})"


def _clean(column: str) -> str:
    return f"trim(regexp_replace(regexp_replace(coalesce({column}, ''), '<[^>]+>', ' ', 'g'), '{WS}+', ' ', 'g'))"


def _mask(text: str) -> str:
    return f"regexp_replace(regexp_replace({text}, '{EMAIL}', '[MASKED_EMAIL]', 'g'), '{PHONE}', '[MASKED_PHONE]', 'g')"


def _sentences(column: str) -> str:
    spaced = f"trim(regexp_replace(coalesce({column}, ''), '{WS}+', ' ', 'g'))"
    marked = f"regexp_replace({spaced}, '([。！？!?；;.]) ', '\\1' || chr(1), 'g')"
    return f"list_filter(string_split({marked}, chr(1)), lambda x: x <> '')"


def _strip(text: str) -> str:
    return f"regexp_replace(regexp_replace({text}, '^{WS}+', ''), '{WS}+$', '')"


def _list(words: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _any(text: str, words: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains({text}, '{w}')" for w in words) + ")"


DOCS = f"docs AS (SELECT doc_id, source, {_clean('text')} AS text FROM documents)"
MASKED = f"{DOCS}, masked AS (SELECT doc_id, {_mask('text')} AS text FROM docs)"

NEAR = f"""
WITH {DOCS},
texts AS (SELECT min(doc_id) AS id, lower(text) AS text FROM docs GROUP BY 2),
g AS (SELECT id, text[i:i + 2] AS gram FROM (SELECT id, text, unnest(range(1, len(text) - 1)) AS i FROM texts WHERE len(text) >= 3) GROUP BY ALL),
n AS (SELECT id, count(*) AS n FROM g GROUP BY 1),
c AS (SELECT a.id AS id_a, b.id AS id_b, count(*) AS inter FROM g a JOIN g b ON a.gram = b.gram AND a.id < b.id
      JOIN n x ON x.id = a.id JOIN n y ON y.id = b.id WHERE 5 * least(x.n, y.n) > 4 * greatest(x.n, y.n) GROUP BY 1, 2),
near AS (SELECT id_a, id_b, inter / (x.n + y.n - inter) AS jaccard FROM c JOIN n x ON x.id = id_a JOIN n y ON y.id = id_b
         WHERE 5 * inter > 4 * (x.n + y.n - inter))
"""

CHUNKS = f"""
WITH RECURSIVE src AS (SELECT doc_id::VARCHAR AS doc_id, coalesce(text, '') AS text, {_sentences('text')} AS s FROM documents),
fold AS (
  SELECT doc_id, s, 1 AS i, 0 AS chunk, 1 AS n, len(s[1]) AS chars FROM src WHERE len(s) > 0
  UNION ALL
  SELECT doc_id, s, i + 1, CASE WHEN full_up THEN chunk + 1 ELSE chunk END, CASE WHEN full_up THEN 1 ELSE n + 1 END,
         CASE WHEN full_up THEN len(s[i + 1]) ELSE chars + len(s[i + 1]) END
  FROM (SELECT *, n >= 6 OR chars + len(s[i + 1]) > 700 AS full_up FROM fold WHERE i < len(s))),
bodies AS (
  SELECT doc_id, chunk, string_agg(s[i], ' ' ORDER BY i) AS body FROM fold GROUP BY 1, 2
  UNION ALL SELECT doc_id, 0, text FROM src WHERE len(s) = 0)
"""

_FOCUS = "CASE " + " ".join(
    f"WHEN contains(text, '{t}') THEN coalesce(nullif({_strip(f'''text[strpos(text, '{t}') + {len(t)}:]''')}, ''), text)" for t in WORDS.contrast
) + " ELSE text END"
SENTIMENT = f"""
sent AS (SELECT doc_id, CASE WHEN neg > pos THEN 'negative' WHEN pos > neg THEN 'positive' ELSE 'neutral' END AS inferred FROM (
  SELECT doc_id, len(list_filter({_list(WORDS.negative)}, lambda w: contains(focus, w))) AS neg,
         len(list_filter({_list(WORDS.positive)}, lambda w: contains(focus, w))) AS pos
  FROM (SELECT doc_id, {_FOCUS} AS focus FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents))))
"""


ENTITIES = f"""
ent AS (SELECT doc_id, list_filter(l, lambda x, i: list_position(l, x) = i)[1:8] AS found FROM (
  SELECT doc_id, list_concat(list_filter({_list(WORDS.entities)}, lambda w: contains(text, w)),
                             list_filter({_list(WORDS.entity_patterns)}, lambda w: contains(text, w)),
                             regexp_extract_all(text, '{WORDS.entity_regex}')) AS l
  FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)))
"""

OUTPUTS = """
outs AS (SELECT doc_id, text, CASE doc_id % 8
  WHEN 0 THEN 'Answer: {"sentiment": "' || said || '", "entities": ["a", " b ", "a", ""], "reason": "good"} ok'
  WHEN 1 THEN '{"sentiment": "' || said || '", "entities": ["1","2","3","4","1","2","3","4","5"], "reason": "bad"}'
  WHEN 2 THEN '{"sentiment": "happy", "entities": "text", "reason": null}'
  WHEN 3 THEN '{"sentiment": "' || said || '", "entities": [], "reason": ""}'
  WHEN 4 THEN '{"sentiment": "positive", "entities": ['
  WHEN 5 THEN '["positive"]'
  WHEN 6 THEN ''
  ELSE '{"sentiment": "negative"}' END AS output
  FROM (SELECT documents.doc_id, text, CASE quality WHEN 1 THEN 'positive' WHEN 0 THEN 'NEGATIVE' ELSE 'neutral' END AS said
        FROM documents LEFT JOIN labels USING (doc_id))),
body AS (SELECT doc_id, regexp_extract(output, '(?s)\\{.*\\}') AS j FROM outs),
good AS (SELECT doc_id, j, json_valid(j) AND json_type(CASE WHEN json_valid(j) THEN j ELSE 'null' END) = 'OBJECT' AS ok FROM body),
raw AS (SELECT doc_id, ok, CASE WHEN ok THEN j ELSE '{}' END AS j FROM good),
parsed AS (SELECT doc_id,
  CASE WHEN lower(json_extract_string(j, '$.sentiment')) IN ('positive', 'negative') THEN lower(json_extract_string(j, '$.sentiment')) ELSE 'neutral' END AS sentiment,
  CASE WHEN json_type(j, '$.entities') = 'ARRAY' THEN CAST(json_extract(j, '$.entities') AS VARCHAR[])[1:8] ELSE CAST([] AS VARCHAR[]) END AS entities,
  CASE WHEN NOT ok THEN 'parse_fallback' WHEN NOT json_exists(j, '$.reason') THEN '' ELSE coalesce(json_extract_string(j, '$.reason'), 'None') END AS reason
  FROM raw)
"""


def _json(items: str) -> str:
    return f"""'[' || array_to_string(list_transform({items}, lambda x: '"' || x || '"'), ',') || ']'"""


LABELED = f"""
WITH {OUTPUTS}, {SENTIMENT}, {ENTITIES},
a AS (SELECT p.doc_id, p.sentiment AS said, inferred, p.reason AS r0, list_filter(l, lambda x, i: list_position(l, x) = i)[1:8] AS own, found
      FROM (SELECT *, list_filter(list_transform(entities, lambda x: trim(x)), lambda x: x <> '') AS l FROM parsed) p
      JOIN sent USING (doc_id) JOIN ent USING (doc_id)),
b AS (SELECT *, said = 'neutral' AND inferred <> 'neutral' AS fill, said <> 'neutral' AND inferred <> 'neutral' AND said <> inferred AS contrary, len(own) = 0 AS none FROM a),
c AS (SELECT *, CASE WHEN fill OR contrary THEN inferred ELSE said END AS sentiment, CASE WHEN none THEN found ELSE own END AS entities,
      CASE WHEN fill AND r0 IN ('', 'parse_fallback') THEN 'rule_sentiment_override' ELSE r0 END AS r1 FROM b),
d AS (SELECT *, CASE WHEN none AND r1 IN ('', 'parse_fallback') THEN 'rule_entities_fill' ELSE r1 END AS r2 FROM c),
e AS (SELECT *, (sentiment = 'positive' AND {_any('r2', WORDS.negative_reason)} AND NOT {_any('r2', WORDS.positive_reason)})
             OR (sentiment = 'negative' AND {_any('r2', WORDS.positive_reason)} AND NOT {_any('r2', WORDS.negative_reason)}) AS clash FROM d),
labeled AS (SELECT doc_id, sentiment, {_json('entities')} AS entities_json,
  CASE WHEN clash THEN 'reason_rewrite_for_sentiment_consistency' WHEN r2 = '' THEN 'model_output' ELSE r2 END AS label_reason,
  coalesce(nullif(concat_ws('|', CASE WHEN fill THEN 'rule_sentiment_override' END, CASE WHEN contrary THEN 'rule_sentiment_conflict_override' END,
    CASE WHEN none THEN 'rule_entities_fill' END, CASE WHEN clash THEN 'reason_rewrite' END), ''), 'model_output') AS postprocess_tag FROM e)
"""

JUDGED = """
WITH src AS (SELECT l.doc_id, (d.n_chars % 8)::INT AS task, quality * 4 + toxic AS hall, n_chars, l.doc_id % 5 AS shape FROM labels l JOIN documents d USING (doc_id)),
judged AS (SELECT doc_id,
  CASE WHEN shape IN (2, 4) THEN 1 ELSE greatest(1, least(5, task)) END::INT AS task_completion,
  CASE WHEN shape IN (2, 4) THEN 1 ELSE greatest(1, least(5, hall)) END::INT AS hallucination,
  CASE WHEN shape IN (2, 4) THEN 1.0 ELSE greatest(1.0::DOUBLE, least(5.0::DOUBLE, CASE WHEN shape = 0 THEN (n_chars % 70) / 10 ELSE (task + hall) / 2 END)) END::DOUBLE AS overall,
  CASE shape WHEN 0 THEN 'r' WHEN 1 THEN '' WHEN 3 THEN 'x' ELSE 'parse_failed' END AS reason FROM src)
"""

TURNS = "turns AS (SELECT conv_id, turn, role, sha256(text) AS content_hash FROM conversations)"

SQL = {
    "clean_text": f"SELECT doc_id, {_clean('text')} AS text FROM documents",
    "clean_pages": f"SELECT page_id, {_clean('html')} AS text FROM pages",
    "mask_pii": f"WITH {MASKED} SELECT doc_id, text FROM masked",
    "clean_mask_hash": f"WITH {MASKED} SELECT doc_id, sha256(text) AS content_hash FROM masked",
    "exact_dedup": f"WITH {MASKED} SELECT min(doc_id) AS doc_id, sha256(text) AS content_hash FROM masked GROUP BY 2",
    "incremental_anti_join": f"""
        WITH {DOCS}, h AS (SELECT doc_id, source, sha256(text) AS content_hash FROM docs)
        SELECT min(doc_id) AS doc_id, content_hash FROM h a
        WHERE NOT EXISTS (SELECT 1 FROM h b WHERE b.source = 'src0' AND b.content_hash = a.content_hash) GROUP BY 2""",
    "near_dup_pairs": f"{NEAR} SELECT id_a, id_b, jaccard FROM near",
    "near_dup_survivors": f"""{NEAR} SELECT doc_id FROM docs d
        WHERE NOT EXISTS (SELECT 1 FROM near WHERE id_b = doc_id)
          AND (len(text) < 3 OR NOT EXISTS (SELECT 1 FROM docs e WHERE lower(e.text) = lower(d.text) AND e.doc_id < d.doc_id))""",
    # Two batches leave what one leaves.
    "near_dup_batches": f"""{NEAR} SELECT doc_id FROM docs d
        WHERE NOT EXISTS (SELECT 1 FROM near WHERE id_b = doc_id)
          AND (len(text) < 3 OR NOT EXISTS (SELECT 1 FROM docs e WHERE lower(e.text) = lower(d.text) AND e.doc_id < d.doc_id))""",
    "latest_per_key": "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) = 1",
    "latest_turn": "SELECT conv_id, turn, role FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC NULLS LAST, text) = 1",
    "nonblank_filter": "SELECT role, count(*) AS n FROM conversations WHERE len(trim(text)) > 0 GROUP BY 1",
    "required_fields": "SELECT source, count(*) AS n FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL AND source IS NOT NULL GROUP BY 1",
    "max_watermark": "SELECT max(o_orderdate) AS watermark FROM orders",
    "map_watermark": "SELECT max(regexp_replace(ts::VARCHAR, '0+$', '')) AS watermark FROM events",
    "incremental_window": "SELECT event_id, event_type FROM events WHERE ts > (SELECT max(ts) FROM events WHERE event_type = 'error')",
    "new_data_gate": "SELECT max(ts) > (SELECT max(ts) FROM events WHERE event_type = 'purchase') AS has_new FROM events",
    "event_date_partition": "SELECT CASE WHEN event_type = 'error' THEN 'unknown' ELSE strftime(ts, '%Y-%m-%d') END AS event_date, count(*) AS n FROM events GROUP BY 1",
    "json_parse_required": "SELECT json_extract_string(props, '$.k') AS k, count(*) AS n FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL GROUP BY 1",
    "bronze_round_trip": "SELECT doc_id::VARCHAR AS doc_id, lang, sha256(text) AS content_hash FROM documents WHERE lang <> 'de' AND text IS NOT NULL AND doc_id IS NOT NULL",
    "reject_count": "SELECT count(*) AS lines, count_if(lang = 'de' OR lang IS NULL OR doc_id IS NULL) AS rejected FROM documents",
    "keep_bad_rows": "SELECT CASE WHEN role <> 'system' THEN role END AS role, count(*) AS n FROM conversations GROUP BY 1",
    "prompt_fallback": "SELECT conv_id, turn, len(text)::INT AS n_chars FROM conversations",
    "field_coalesce": """SELECT page_id::VARCHAR AS doc_id, CASE WHEN url LIKE 'https%' THEN url ELSE 'Untitled' END AS title,
        'unknown' AS timestamp, 'unknown' AS event_date, md5(coalesce(html, '')) AS text_md5 FROM pages""",
    "null_coalesce": """SELECT CASE WHEN turn > 0 THEN conv_id::VARCHAR ELSE 'unknown_doc_id' END AS doc_id,
        CASE WHEN role = 'system' THEN 0 ELSE len(text) END::INT AS n_chars FROM conversations""",
    "sentence_split": f"""SELECT doc_id, (i - 1)::INT AS i, md5(s[i]) AS sentence_md5
        FROM (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i FROM (SELECT doc_id, {_sentences('text')} AS s FROM documents))""",
    "chunk_documents": f"""{CHUNKS} SELECT md5(doc_id || '::' || chunk || '::unknown') AS chunk_id, doc_id AS original_doc_id,
        md5('Title: Untitled' || chr(10) || 'Timestamp: unknown' || chr(10) || 'DocumentID: ' || doc_id || chr(10) || chr(10) || body) AS chunk_md5,
        chunk::INT AS chunk_index, (count(*) OVER (PARTITION BY doc_id))::INT AS chunk_count FROM bodies""",
    "chunk_counts": f"""WITH RECURSIVE {MASKED},
        src AS (SELECT min(doc_id) AS doc_id, sha256(text) AS content_hash, any_value({_sentences('text')}) AS s FROM masked GROUP BY 2),
        fold AS (
          SELECT doc_id, s, 1 AS i, 1 AS chunk, 1 AS n, len(s[1]) AS chars FROM src WHERE len(s) > 0
          UNION ALL
          SELECT doc_id, s, i + 1, CASE WHEN full_up THEN chunk + 1 ELSE chunk END, CASE WHEN full_up THEN 1 ELSE n + 1 END,
                 CASE WHEN full_up THEN len(s[i + 1]) ELSE chars + len(s[i + 1]) END
          FROM (SELECT *, n >= 6 OR chars + len(s[i + 1]) > 700 AS full_up FROM fold WHERE i < len(s)))
        SELECT src.doc_id, content_hash, coalesce(max(chunk), 1)::INT AS n_chunks FROM src LEFT JOIN fold USING (doc_id) GROUP BY 1, 2""",
    "chunk_ids": "SELECT conv_id, turn, md5(conv_id || '::' || turn || '::' || coalesce(role, 'unknown')) AS chunk_id FROM conversations",
    "sentiment_rule": f"WITH {SENTIMENT} SELECT doc_id, inferred AS sentiment FROM sent",
    "sentiment_distribution": """SELECT CASE WHEN text LIKE '%trash%' OR text LIKE '%idiot%' OR text LIKE '%clown%' THEN 'negative'
        WHEN text LIKE '%with%' OR text LIKE '%avec%' OR text LIKE '%para%' THEN 'positive' ELSE 'neutral' END AS sentiment, count(*) AS n FROM documents GROUP BY 1""",
    "entity_extract": f"WITH {ENTITIES} SELECT doc_id, {_json('found')} AS entities_json FROM ent",
    "item_dedup": f"""SELECT doc_id, len(u)::INT AS n, md5(array_to_string(u, '|')) AS items_md5 FROM (
        SELECT doc_id, list_filter(l, lambda x, i: list_position(l, x) = i) AS u FROM (
          SELECT doc_id, list_filter(list_transform(string_split(text, '.'), lambda x: {_strip('x')}), lambda x: x <> '') AS l FROM documents))""",
    "label_parse": f"WITH {OUTPUTS} SELECT doc_id, sentiment, {_json('entities')} AS entities_json, reason FROM parsed",
    "label_normalize": f"{LABELED} SELECT * FROM labeled",
    "topic_label_parse": """SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN lang ELSE 'general' END AS label,
        CASE doc_id % 4 WHEN 0 THEN greatest(0.0::DOUBLE, least(1.0::DOUBLE, round((doc_id % 100) / 40 - 0.5, 3))) WHEN 2 THEN 0.25 ELSE 0.5 END::DOUBLE AS confidence FROM documents""",
    "judge_parse": f"{JUDGED} SELECT * FROM judged",
    "label_prompts": f"WITH {DOCS} SELECT doc_id, md5('{LABEL_PROMPT}' || text) AS prompt_md5 FROM docs",
    "judge_prompts": f"""{LABELED} SELECT doc_id, md5('{JUDGE_PROMPT}' || concat_ws(chr(10), coalesce(text, ''), sentiment, entities_json, label_reason)) AS prompt_md5
        FROM labeled JOIN documents USING (doc_id)""",
    "embedder_inputs": "SELECT doc_id, md5(text[1:1536]) AS input_md5 FROM documents",
    "embedding_rows": """SELECT vec_id, CASE WHEN label <> 0 THEN len(embedding) ELSE 0 END::INT AS dims, coalesce(label::VARCHAR, '') AS label,
        vec_id::VARCHAR AS vec_id_text FROM embeddings""",
    "quality_report": f"""{JUDGED} SELECT count(*) AS sample_count, avg(task_completion) AS task_completion_avg, avg(hallucination) AS hallucination_avg,
        avg(overall) AS overall_avg, stddev_pop(overall) AS overall_std, avg(overall) >= 3.5 AS pass, 3.5::DOUBLE AS threshold,
        count_if(overall < 3.5) AS below_threshold_count, least(count_if(overall < 3.5), 10) AS listed_count FROM judged""",
    "worst_k": f"{JUDGED} SELECT doc_id, round(overall, 2) AS overall FROM judged WHERE overall < 3.5 ORDER BY 2, 1 LIMIT 10",
    "below_threshold": f"{JUDGED} SELECT doc_id, overall FROM judged WHERE overall < 3.5",
    "integrity_metrics": f"""{LABELED} SELECT
        count_if((sentiment = 'positive' AND {_any('label_reason', WORDS.negative_reason)} AND NOT {_any('label_reason', WORDS.positive_reason)})
              OR (sentiment = 'negative' AND {_any('label_reason', WORDS.positive_reason)} AND NOT {_any('label_reason', WORDS.negative_reason)})) / count(*) AS reason_sentiment_conflict_rate,
        count_if(entities_json IN ('', '[]', '[ ]', 'null', 'None')) / count(*) AS empty_entities_rate,
        count_if({_any('text', KEY_TERMS)} AND NOT ({' OR '.join(f"(contains(text, '{w}') AND contains(entities_json, '{w}'))" for w in KEY_TERMS)})) / count(*) AS entity_coverage_miss_rate,
        count_if(postprocess_tag NOT IN ('', 'model_output')) / count(*) AS postprocess_hit_rate FROM labeled JOIN documents USING (doc_id)""",
    "seeded_sample": "SELECT doc_id, lang FROM documents ORDER BY md5(doc_id || '::42'), doc_id LIMIT 100",
    "latency_summary": """SELECT event_type, count(value) AS n, median(value) AS p50,
        count_if(event_type = 'error' AND (lower(props) LIKE '%oom%' OR lower(props) LIKE '%out of memory%')) AS oom_count,
        count_if(event_type = 'error' AND props IS NOT NULL) AS timeout_count, count(*) / 120.0::DOUBLE AS qps,
        CASE WHEN count(value) >= 10 THEN list_sort(list(value))[greatest(0, floor(count(value) * 0.99)::INT - 1) + 1] END AS p99 FROM events GROUP BY 1""",
    "l2_normalized": """SELECT vec_id, (i - 1)::INT AS i, round(e[i] / greatest(sqrt(list_sum(list_transform(e, lambda x: x * x))), 1e-9), 6) AS x
        FROM (SELECT vec_id, e, unnest(range(1, len(e) + 1)) AS i FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings))""",
    "cosine_topk": """WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v, sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS n FROM embeddings),
        s AS (SELECT q.vec_id AS query, e.vec_id, round(CASE WHEN q.n * e.n > 0 THEN list_inner_product(q.v, e.v) / (q.n * e.n) ELSE 0 END, 9) AS similarity
              FROM e q, e WHERE q.vec_id % 50 = 0)
        SELECT query, (row_number() OVER (PARTITION BY query ORDER BY similarity DESC, vec_id))::INT AS rank, vec_id, similarity FROM s
        QUALIFY rank <= 10""",
    "idempotent_append_3key": f"""WITH {TURNS} SELECT DISTINCT ON (conv_id, turn, content_hash) conv_id, turn, role, content_hash FROM turns t
        WHERE NOT EXISTS (SELECT 1 FROM turns s WHERE s.role = 'system' AND s.conv_id = t.conv_id AND s.turn = t.turn AND s.content_hash = t.content_hash)
        ORDER BY conv_id, turn, content_hash, role NULLS LAST""",
    "idempotent_append_2key": """SELECT conv_id, turn, min(role) AS role FROM conversations t
        WHERE NOT EXISTS (SELECT 1 FROM conversations s WHERE s.role = 'user' AND s.conv_id = t.conv_id AND s.turn = t.turn) GROUP BY 1, 2""",
    "idempotent_append_1key": """SELECT doc_id, min(lang) AS lang FROM documents t
        WHERE NOT EXISTS (SELECT 1 FROM documents s WHERE s.lang = 'fr' AND s.doc_id = t.doc_id) GROUP BY 1""",
    "latest_events_stream": """SELECT user_id, max(ts) AS ts FROM events GROUP BY 1
        HAVING epoch_ms(max(ts)) <= epoch_ms((SELECT max(ts) FROM events)) - 86400000""",
    "delivered_rows": "SELECT count_if(doc_id % 10 <> 7) AS sent, count_if(doc_id % 10 = 7) AS dropped FROM documents",
    "line_numbers": "SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS line FROM documents",
    "stream_events": "SELECT event_type, count(*) AS n, max(event_id) AS last_id FROM events GROUP BY 1",
}
