"""The registered queries as SQL over the same tables, written independently of the Spark plans."""

from __future__ import annotations

from alertflow.operators.extraction import REQUEST_TEMPLATE
from alertflow.plans import settings as st


def _list(words: tuple[str, ...]) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _tokens(text: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({text}), '[^a-z0-9]+'), lambda t: t <> '')"


def _first(words: tuple[str, ...]) -> str:
    return f"coalesce(list_filter(tokens, lambda t: t IN ({_list(words)}))[1], 'None')"


_FEED = f"""
feed AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, source AS keyword, lang AS location, text,
         TIMESTAMP '{st.FEED_START:%Y-%m-%d %H:%M:%S}'
           + to_seconds(doc_id * {st.FEED_STEP_SECONDS}) AS kafka_timestamp,
         {_tokens("text")} AS tokens
  FROM documents
)"""

_PAGE_PARTS = """
parts AS (SELECT page_id, regexp_split_to_array(html, '<[^>]*>') AS texts FROM pages),
numbered AS (SELECT page_id, unnest(texts) AS text, generate_subscripts(texts, 1) - 1 AS pos FROM parts)"""

_BLANK = r"regexp_full_match(text, '[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]*')"


def _scored(source: str) -> str:
    """Scores of the rows of ``source``, which has a ``tokens`` column."""
    return f"""
logit AS (
  SELECT *, {st.SCORER.weight} * len(list_filter(tokens, lambda t: t IN ({_list(st.LEXICON)})))
            + {st.SCORER.bias} AS z
  FROM {source}
),
scored AS (
  SELECT *, CASE WHEN {_BLANK} THEN 0 WHEN z > 0 THEN 1 ELSE 0 END AS prediction,
         CASE WHEN {_BLANK} THEN 0.0::DOUBLE ELSE round(1 / (1 + exp(-abs(z::DOUBLE))), 4) END AS confidence
  FROM logit
)"""


_SEGMENTS = f"""{_PAGE_PARTS},
segments AS (
  SELECT page_id || '-' || pos AS id, text, {_tokens("text")} AS tokens FROM numbered
)"""

_ALERTS = f"""{_FEED}, {_scored("feed")},
alerts AS (
  SELECT id, text, {_first(st.TYPES)} AS disaster, {_first(st.PLACES)} AS location,
         confidence, kafka_timestamp
  FROM scored WHERE prediction = 1
)"""


def _timed(source: str) -> str:
    return f"""
timed AS (
  SELECT *, date_trunc('minute', kafka_timestamp) + INTERVAL 1 MINUTE AS processing_timestamp
  FROM {source}
)"""


_KEY = """sha256(
  coalesce(length(id) || ':' || id, '-') || ';'
  || length(strftime(kafka_timestamp, '%Y-%m-%d %H:%M:%S')) || ':' || strftime(kafka_timestamp, '%Y-%m-%d %H:%M:%S')
  || ';' || coalesce(length(text) || ':' || text, '-') || ';')"""

_STORED = f"""{_ALERTS}, {_timed("alerts")},
stored AS (
  SELECT {_KEY} AS row_key, id AS tweet_id, text, disaster AS disaster_type, location,
         CAST(CAST(confidence AS DECIMAL(5,4)) AS DOUBLE) AS confidence, kafka_timestamp, processing_timestamp
  FROM timed
)"""

_CANDIDATES = f"""{_FEED},
candidates AS (
  SELECT id, text, keyword AS disaster, string_split(text, chr(10))[1] AS location,
         length(text) / 1000.0::DOUBLE AS confidence, kafka_timestamp
  FROM feed
), {_timed("candidates")},
ruled AS (
  SELECT *, list_filter([
    CASE WHEN text IS NULL THEN 'text_missing' END,
    CASE WHEN length(id) > 50 THEN 'tweet_id_too_long' END,
    CASE WHEN length(disaster) > 100 THEN 'disaster_type_too_long' END,
    CASE WHEN length(location) > 200 THEN 'location_too_long' END,
    CASE WHEN abs(confidence) >= 9.99995 THEN 'confidence_out_of_range' END
  ], lambda r: r IS NOT NULL) AS rules
  FROM timed
)"""

_WINDOWED = """
windowed AS (
  SELECT time_bucket(INTERVAL 1 HOUR, {time}) AS window_start, {kind} AS type,
         count(*) AS n, CAST(sum(CAST({measure} AS DECIMAL(18,4))) AS DOUBLE) AS total
  FROM {source} GROUP BY ALL
),
windows AS (
  SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, type, n, total, total / n AS mean
  FROM windowed
)"""

_EVENT_WINDOWS = _WINDOWED.format(time="ts", kind="event_type", measure="value", source="events")

_before, _after = REQUEST_TEMPLATE.split("{text}")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_SORTED = f"""
sorted AS (
  SELECT *, CASE WHEN contains(text, chr(10)) THEN 'undecodable' WHEN text = '' THEN 'empty'
                 WHEN contains(text, '@') THEN 'prediction_failed' WHEN prediction = 1 THEN 'alert'
                 WHEN {_BLANK} THEN 'blank' ELSE 'quiet' END AS kind
  FROM scored
)"""

_ask_before, _ask_after = st.REQUEST.split("{text}")
_REQUESTS = f"""
requests AS (
  SELECT id, text, {_quoted(_ask_before)} || text || {_quoted(_ask_after)} AS request,
         sha256({_quoted(_ask_before)} || text || {_quoted(_ask_after)}) AS request_key
  FROM segments WHERE text <> ''
)"""

_PHRASES = """
said AS (
  SELECT id, n, unnest(list_transform(range(1, len(tokens) - n + 2), lambda i: array_to_string(tokens[i:i + n - 1], ' '))) AS term,
         unnest(range(1, len(tokens) - n + 2)) AS pos
  FROM feed, (SELECT unnest([1, 2, 3]) AS n) WHERE len(tokens) >= n
),
found AS (
  SELECT id, kind, arg_min(term, pos * 10 - n) AS term FROM said JOIN listed USING (term) GROUP BY id, kind
)
SELECT feed.id, coalesce(l.term, 'None') AS location, coalesce(d.term, 'None') AS disaster
FROM feed LEFT JOIN found l ON l.id = feed.id AND l.kind = 'location'
  LEFT JOIN found d ON d.id = feed.id AND d.kind = 'disaster'"""

_MESSAGE_JSON = (
    "CAST(to_json(struct_pack(id := id, keyword := keyword, location := location, text := text)) AS VARCHAR)"
)

_ALERT_COLUMNS = "id, text, disaster, location, confidence, kafka_timestamp"

SQL: dict[str, str] = {
    # Sources
    "csv_source": f"WITH {_FEED} SELECT id, keyword, location, text FROM feed",
    "csv_split": f"WITH {_FEED} SELECT id, keyword, location, text FROM feed",
    "kafka_envelope": f"WITH {_FEED} SELECT {_MESSAGE_JSON} AS value, kafka_timestamp AS timestamp FROM feed",
    "feed_items": f"""
        WITH {_FEED}, lines AS (
          SELECT id, strftime(kafka_timestamp, '%Y-%m-%d') AS published_date,
                 unnest(string_split(text, chr(10))) AS abstract
          FROM feed
        )
        SELECT id, substring(abstract, 1, 50) AS title, published_date, abstract FROM lines""",
    # Message encode and decode
    "encode_messages": f"""
        WITH {_FEED}, encoded AS (SELECT id, {_MESSAGE_JSON} AS message FROM feed)
        SELECT id, CAST(strlen(message) AS INTEGER) AS n_bytes, message FROM encoded""",
    "parse_messages": f"WITH {_FEED} SELECT id, keyword, location, text, kafka_timestamp FROM feed",
    "parse_messages_explicit": f"""
        WITH {_FEED} SELECT id, keyword, location, text, kafka_timestamp FROM feed WHERE text <> ''""",
    "decode_extraction": f"""
        WITH {_FEED}, found AS (
          SELECT id, text, {_first(st.PLACES)} AS l, {_first(st.TYPES)} AS d FROM feed
        )
        SELECT id,
               CASE WHEN d <> 'None' THEN '{{"location":"' || l || '","disaster":"' || d || '"}}' ELSE text END
                 AS response,
               CASE WHEN d <> 'None' THEN l END AS location,
               CASE WHEN d <> 'None' THEN d END AS disaster
        FROM found""",
    "pack_scores": f"""
        WITH {_SEGMENTS}, {_scored("segments")}
        SELECT id, text,
               CASE WHEN {_BLANK} THEN '0,0.0' ELSE prediction || ',' || printf('%.4f', confidence) END
                 AS prediction_result
        FROM scored""",
    "unpack_scores": f"WITH {_FEED}, {_scored('feed')} SELECT id, prediction, confidence FROM scored",
    # Projections and filters
    "nonempty_text": f"WITH {_SEGMENTS} SELECT id, text FROM segments WHERE text <> ''",
    "positives": f"""
        WITH {_FEED}, {_scored("feed")}
        SELECT id, text, kafka_timestamp, prediction, confidence FROM scored WHERE prediction = 1""",
    "alerts": f"WITH {_ALERTS} SELECT {_ALERT_COLUMNS} FROM alerts",
    "storage_rows": f"""
        WITH {_CANDIDATES}
        SELECT {_KEY} AS row_key, id AS tweet_id, text, disaster AS disaster_type, location,
               CAST(CAST(confidence AS DECIMAL(5,4)) AS DOUBLE) AS confidence,
               kafka_timestamp, processing_timestamp
        FROM ruled WHERE len(rules) = 0""",
    "quarantine_rows": f"""
        WITH {_CANDIDATES}
        SELECT {_ALERT_COLUMNS}, processing_timestamp, array_to_string(rules, ',') AS reason
        FROM ruled WHERE len(rules) > 0""",
    "processed_rows": f"""
        WITH {_FEED}, {_scored("feed")}
        SELECT id, keyword, location, text, prediction, printf('%.4f', confidence) AS confidence,
               CASE prediction WHEN 1 THEN 'DISASTER' ELSE 'NOT_DISASTER' END AS disaster_label,
               strftime(kafka_timestamp, '%Y-%m-%d %H:%M:%S') AS timestamp
        FROM scored""",
    "preview_ellipsis": f"""
        WITH {_SEGMENTS}
        SELECT id, CASE WHEN length(text) > 60 THEN left(text, 60) || '...' ELSE text END AS text_preview
        FROM segments""",
    "surrogate_id": f"WITH {_FEED} SELECT {_KEY} AS row_key, id, kafka_timestamp FROM feed",
    # Scoring and extraction
    "score_text": f"WITH {_FEED}, {_scored('feed')} SELECT id, prediction, confidence FROM scored",
    "score_with_model": f"""
        WITH {_FEED}, {_scored("feed")} SELECT id, prediction, confidence, true AS ok FROM scored""",
    "blank_guard": f"""
        WITH {_SEGMENTS}, {_scored("segments")}
        SELECT id, {_BLANK} AS blank, prediction, confidence FROM scored""",
    "normalize_text": f"WITH {_FEED} SELECT id, array_to_string(tokens, ' ') AS normalized FROM feed",
    "truncate_tokens": f"""
        WITH {_FEED}
        SELECT id, CAST(len(tokens) AS INTEGER) AS n_tokens, array_to_string(tokens[1:512], ' ') AS kept,
               len(tokens) > 512 AS was_truncated
        FROM feed""",
    "extract_fields": f"""
        WITH {_FEED} SELECT id, {_first(st.PLACES)} AS location, {_first(st.TYPES)} AS disaster FROM feed""",
    "extract_with_table": f"""
        WITH {_FEED},
        bench AS (SELECT unnest({_tokens("text")}) AS term FROM benchmark),
        terms AS (
          SELECT DISTINCT term, length(term) >= {st.TYPE_LENGTH} AS is_type
          FROM bench
        ),
        words AS (SELECT id, unnest(tokens) AS term, generate_subscripts(tokens, 1) AS pos FROM feed),
        found AS (
          SELECT id, arg_min(term, pos) FILTER (WHERE NOT is_type) AS location,
                 arg_min(term, pos) FILTER (WHERE is_type) AS disaster
          FROM words JOIN terms USING (term) GROUP BY id
        )
        SELECT feed.id, coalesce(found.location, 'None') AS location, coalesce(disaster, 'None') AS disaster
        FROM feed LEFT JOIN found USING (id)""",
    "extract_phrase_lists": f"""
        WITH {_FEED},
        listed AS (
          SELECT unnest([{_list(st.PHRASE_PLACES)}]) AS term, 'location' AS kind
          UNION ALL SELECT unnest([{_list(st.PHRASE_TYPES)}]), 'disaster'
        ), {_PHRASES}""",
    "extract_phrases": f"""
        WITH {_FEED},
        bench AS (SELECT {_tokens("text")} AS t FROM benchmark),
        runs AS (
          SELECT n, unnest(list_transform(range(1, len(t) - n + 2), lambda i: array_to_string(t[i:i + n - 1], ' '))) AS term
          FROM bench, (SELECT unnest([1, 2, 3]) AS n) WHERE len(t) >= n
        ),
        listed AS (
          SELECT DISTINCT term, CASE WHEN n = 2 THEN 'location' ELSE 'disaster' END AS kind
          FROM runs WHERE n > 1 OR length(term) >= {st.TYPE_LENGTH}
        ), {_PHRASES}""",
    "score_with_table": f"""
        WITH {_FEED},
        terms AS (SELECT DISTINCT unnest({_tokens("text")}) AS term FROM benchmark),
        words AS (SELECT id, unnest(tokens) AS term FROM feed),
        hits AS (SELECT id, count(*) AS n FROM words JOIN terms USING (term) GROUP BY id),
        logits AS (
          SELECT feed.id, {_BLANK} AS blank,
                 coalesce(n, 0) * CAST({st.TABLE_WEIGHT} AS DOUBLE) + CAST({st.TABLE_BIAS} AS DOUBLE) AS z
          FROM feed LEFT JOIN hits USING (id)
        )
        SELECT id, CASE WHEN z > 0 AND NOT blank THEN 1 ELSE 0 END AS prediction,
               CASE WHEN blank THEN 0.0::DOUBLE ELSE round(1 / (1 + exp(-abs(z))), 4) END AS confidence, true AS ok
        FROM logits""",
    "extract_with_model": f"WITH {_ALERTS} SELECT id, location, disaster FROM alerts",
    "enrich_location": """
        SELECT c_custkey AS id, n_name || ', ' || r_name AS location
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "build_requests": f"""
        WITH {_FEED}, {_scored("feed")}
        SELECT id, {_quoted(_before)} || text || {_quoted(_after)} AS request FROM scored WHERE prediction = 1""",
    "request_table": f"""
        WITH {_SEGMENTS}, {_REQUESTS} SELECT DISTINCT request_key, request FROM requests""",
    "attach_answers": f"""
        WITH {_SEGMENTS}, {_REQUESTS},
        told AS (SELECT *, request_key[1] AS digit, regexp_extract(request, '[^ ]*$') AS word FROM requests)
        SELECT id, text,
               CASE WHEN digit IN ('0', '1', '2') THEN NULL WHEN digit = '3' THEN 'aside'
                    WHEN digit = '4' AND word > 'aside' THEN 'aside' ELSE word END AS location,
               CASE WHEN digit IN ('0', '1', '2', '3') OR (digit = '4' AND word > 'aside') THEN NULL ELSE digit END AS disaster,
               CASE WHEN digit IN ('0', '1') THEN 'unanswered' WHEN digit = '2' THEN 'malformed'
                    WHEN digit = '4' THEN 'repeated' ELSE 'answered' END AS answer_state
        FROM told""",
    "failed_rows": f"""
        WITH {_FEED}
        SELECT CASE WHEN contains(text, chr(10)) THEN 'undecodable' ELSE 'prediction_failed' END AS reason,
               CASE WHEN NOT contains(text, chr(10)) THEN id END AS id, text AS payload, kafka_timestamp
        FROM feed WHERE contains(text, chr(10)) OR contains(text, '@')""",
    "routed_rows": f"""
        WITH {_FEED}, {_scored("feed")}, {_SORTED}
        SELECT kind, CASE WHEN kind IN ('alert', 'prediction_failed') THEN id END AS id,
               CASE WHEN kind = 'alert' THEN {_first(st.TYPES)} END AS disaster,
               CASE WHEN kind = 'alert' THEN {_first(st.PLACES)} END AS location,
               CASE WHEN kind = 'alert' THEN confidence END AS confidence,
               CASE WHEN kind IN ('undecodable', 'prediction_failed') THEN text END AS payload, count(*) AS n
        FROM sorted GROUP BY ALL""",
    "running_totals": f"""
        WITH {_FEED}, {_scored("feed")}, {_SORTED}
        SELECT count(*) FILTER (WHERE kind NOT IN ('undecodable', 'empty')) AS n_rows,
               count(*) FILTER (WHERE kind = 'blank') AS n_blank, count(*) FILTER (WHERE kind = 'alert') AS n_positive,
               count(*) FILTER (WHERE kind = 'prediction_failed') AS n_failed, count(*) FILTER (WHERE kind = 'empty') AS n_empty,
               count(*) FILTER (WHERE kind = 'undecodable') AS n_undecodable
        FROM sorted""",
    # Counts
    "positive_count": f"""
        WITH {_FEED}, {_scored("feed")} SELECT count(*) AS n_positive FROM scored WHERE prediction = 1""",
    "batch_metrics": f"""
        WITH {_SEGMENTS}, {_scored("segments")}
        SELECT count(*) AS n_rows, count(*) FILTER (WHERE {_BLANK}) AS n_blank,
               count(*) FILTER (WHERE prediction = 1) AS n_positive, CAST(0 AS BIGINT) AS n_failed
        FROM scored""",
    # Stores and the reports over them
    "store_roundtrip": f"WITH {_STORED} SELECT * FROM stored",
    "document_roundtrip": f"""
        WITH {_ALERTS}, {_timed("alerts")} SELECT {_ALERT_COLUMNS}, processing_timestamp FROM timed""",
    "document_roundtrip_zoned": f"""
        WITH {_ALERTS}, {_timed("alerts")} SELECT {_ALERT_COLUMNS}, processing_timestamp FROM timed""",
    "latest_predictions": f"""
        WITH {_STORED}
        SELECT tweet_id, disaster_type, location, confidence, left(text, 50) AS text_preview, processing_timestamp
        FROM stored ORDER BY processing_timestamp DESC, tweet_id DESC LIMIT {st.REPORT_ROWS}""",
    "latest_documents": f"""
        WITH {_ALERTS}, {_timed("alerts")}
        SELECT id, disaster, location, printf('%.3f', confidence) AS confidence,
               left(text, 50) || '...' AS text,
               strftime(processing_timestamp, '%Y-%m-%d %H:%M:%S') AS timestamp
        FROM timed ORDER BY processing_timestamp DESC, id DESC LIMIT {st.REPORT_ROWS}""",
    "by_type": f"WITH {_STORED} SELECT * FROM stored WHERE disaster_type = '{st.ONE_TYPE}'",
    "by_location": f"WITH {_STORED} SELECT * FROM stored WHERE location = '{st.ONE_PLACE}'",
    "confident": f"WITH {_STORED} SELECT * FROM stored WHERE confidence >= 0.95",
    "clustered_store": f"""
        WITH {_STORED}
        SELECT *, 'type' AS asked FROM stored WHERE disaster_type = '{st.ONE_TYPE}'
        UNION ALL SELECT *, 'place' FROM stored WHERE location = '{st.ONE_PLACE}'
        UNION ALL SELECT *, 'confident' FROM stored WHERE confidence >= 0.95""",
    "top_confidence": f"""
        WITH {_STORED}
        SELECT tweet_id, disaster_type, location, confidence, left(text, 50) AS text_preview, kafka_timestamp
        FROM stored ORDER BY confidence DESC, kafka_timestamp DESC, tweet_id DESC LIMIT {st.REPORT_ROWS}""",
    "time_range": f"""
        WITH {_STORED}
        SELECT * FROM stored
        WHERE kafka_timestamp >= TIMESTAMP '{st.RANGE[0]}' AND kafka_timestamp < TIMESTAMP '{st.RANGE[1]}'
        ORDER BY kafka_timestamp DESC, tweet_id DESC, row_key DESC""",
    "type_by_window": f"WITH {_EVENT_WINDOWS} SELECT * FROM windows",
    "alert_type_by_window": f"""
        WITH {_STORED},
        {_WINDOWED.format(time="kafka_timestamp", kind="disaster_type", measure="confidence", source="stored")}
        SELECT * FROM windows""",
    # Streams
    "stream_json_roundtrip": f"WITH {_FEED} SELECT id, keyword, location, text, kafka_timestamp FROM feed",
    "stream_alerts": f"WITH {_ALERTS} SELECT {_ALERT_COLUMNS} FROM alerts",
    "stream_fan_out": f"""
        WITH {_ALERTS}
        SELECT id, disaster, location, 'json' AS sink FROM alerts
        UNION ALL SELECT id, disaster, location, 'stored' FROM alerts""",
    "type_by_window_stream": f"WITH {_EVENT_WINDOWS} SELECT * FROM windows",
    "replayed_store": f"WITH {_STORED} SELECT * FROM stored",
    "replayed_stream": f"WITH {_STORED} SELECT * FROM stored",
}

_HALF = "len(embedding) // 2"
SQL["softmax_scores"] = f"""
    WITH sums AS (
      SELECT vec_id,
             list_sum(list_transform(embedding[1:{_HALF}], lambda v: v::DOUBLE)) AS a,
             list_sum(list_transform(embedding[{_HALF} + 1:], lambda v: v::DOUBLE)) AS b
      FROM embeddings
    )
    SELECT vec_id, round(1 / (1 + exp(b - a)), 4) AS p_negative, round(1 / (1 + exp(a - b)), 4) AS p_positive
    FROM sums"""
SQL["embedding_head"] = f"""
    WITH sums AS (
      SELECT vec_id,
             list_sum(list_transform(embedding[1:{_HALF}], lambda v: v::DOUBLE)) AS a,
             list_sum(list_transform(embedding[{_HALF} + 1:], lambda v: v::DOUBLE)) AS b
      FROM embeddings
    )
    SELECT vec_id, CASE WHEN a >= b THEN 0 ELSE 1 END AS prediction,
           round(1 / (1 + exp(-abs(a - b))), 4) AS confidence
    FROM sums"""
