"""For each registered query, SQL that DuckDB answers from the same tables."""

from __future__ import annotations

from keyfold.plans.fixtures import BEHAVIOR_COLUMNS, log_sql

_LOG = f"""WITH log AS ({log_sql(BEHAVIOR_COLUMNS)}),
typed AS (SELECT *, CASE WHEN json_valid(value) THEN json_type(value) END AS kind FROM log),
offered AS (SELECT *, CASE WHEN kind = 'OBJECT' THEN value END AS object FROM typed),
objects AS (SELECT * FROM typed WHERE kind = 'OBJECT'),
docs AS (SELECT *, value ->> '$.id' AS id FROM objects WHERE (value ->> '$.id') <> '')"""

_FIELDS = f"""{_LOG},
fields AS (
  SELECT id, pos, field, json_extract(value, '$."' || field || '"') AS token,
         json_extract_string(value, '$."' || field || '"') AS val
  FROM (SELECT id, pos, value, unnest(json_keys(value)) AS field FROM docs)
)"""

_INT = "coalesce(trunc(try_cast(nullif({0}, '') AS double)), 0)"

_SIGNALS = f"""{_LOG},
signals AS (
  SELECT part, pos, value ->> '$.data_source' AS data_source,
         cast({_INT.format("value ->> '$.is_last_batch'")} AS integer) AS is_last_batch,
         value ->> '$.tag_id' AS tag_id, value ->> '$.batch_id' AS batch_id,
         'tag_system_operate' AS operate_source, cast(0 AS integer) AS task_status,
         value ->> '$.id' AS id, json_extract(value, '$.is_last_batch') AS flag
  FROM objects
  WHERE (value ->> '$.data_source') = 'tag_operate_queue'
    AND {_INT.format("value ->> '$.is_last_batch'")} = 1
)"""

_PAYLOAD = """'{"id":"' || id || '","data_source":"tag_operate_queue","is_last_batch":' || flag::varchar
  || ',"tag_id":"' || tag_id || '","batch_id":"' || batch_id
  || '","operate_source":"tag_system_operate","task_status":0}'"""

_PROFILES = f"""{_LOG},
profiles AS (
  SELECT (value ->> '$.app_id') || '|' || (value ->> '$.user_id') AS id,
         value ->> '$.app_id' AS app_id, value ->> '$.user_id' AS user_id,
         value ->> '$.nick_name' AS nick_name, value ->> '$.real_name' AS real_name,
         cast({_INT.format("value ->> '$.user_created_at'")} AS bigint) AS user_created_at,
         cast({_INT.format("value ->> '$.user_from'")} AS integer) AS user_from,
         value ->> '$.user_identity' AS user_identity, value ->> '$.phone' AS phone,
         value ->> '$.collection_phone' AS collection_phone, pos
  FROM objects
  WHERE (value ->> '$.data_source') <> '' AND (value ->> '$.app_id') <> '' AND (value ->> '$.user_id') <> ''
)"""

_PROFILE_COLUMNS = (
    "id, app_id, user_id, nick_name, real_name, user_created_at, user_from, user_identity, phone, collection_phone"
)

_LEDGER = f"""WITH log AS ({log_sql(BEHAVIOR_COLUMNS)}),
ledger AS (
  SELECT cast(floor(pos / 1000) AS bigint) AS batch_id, topic, part, max(pos) + 1 AS until_pos, max(ts) AS updated_at
  FROM log GROUP BY 1, 2, 3
),
latest AS (SELECT topic, part, max(until_pos) AS until_pos FROM ledger GROUP BY 1, 2)"""

_SOURCES = """string_agg('"' || field || '":' || token::varchar, ',' ORDER BY field)"""


def _newest(columns: str, where: str = "", partition: str = "id, field") -> str:
    return (
        f"SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {partition} ORDER BY pos DESC) AS rn "
        f"FROM fields {where}) WHERE rn = 1"
    )


# `object` is the value where it is one JSON object, so that no JSON function sees anything else.
_DOCUMENT_REASON = """CASE WHEN value IS NULL OR value = '' THEN 'empty'
     WHEN object IS NULL THEN 'malformed'
     WHEN (object ->> '$.id') IS NULL THEN 'id_missing_or_null'
     WHEN (object ->> '$.id') = '' THEN 'id_empty' END"""


def _audit(table: str, text: str) -> str:
    return f"""SELECT '{table}' AS topic, {text} AS value,
  CASE WHEN json_valid({text}) AND json_type({text}) = 'OBJECT' THEN {text} END AS object FROM {table}"""


_WIDE = ["nick_name", "phone", "user_from", "tag_id", "batch_id"]

_STREAM_TOKENS = _newest("id, field, token::varchar AS token")

ORACLES: dict[str, str] = {
    "documents_valid": f"{_LOG} SELECT id, part, pos, value FROM docs",
    "rejects": f"""{_LOG},
readable AS (
  SELECT *, CASE WHEN value IS NULL OR value = '' THEN 'empty' WHEN object IS NULL THEN 'malformed' END AS unreadable
  FROM offered
),
found AS (
  SELECT 'document' AS branch, {_DOCUMENT_REASON} AS reason FROM offered
  UNION ALL SELECT 'signal', unreadable FROM readable
  UNION ALL SELECT 'profile', CASE WHEN unreadable IS NOT NULL THEN unreadable
    WHEN coalesce(object ->> '$.data_source', '') = '' THEN 'data_source_missing'
    WHEN coalesce(object ->> '$.app_id', '') = '' THEN 'app_id_missing'
    WHEN coalesce(object ->> '$.user_id', '') = '' THEN 'user_id_missing' END FROM readable
)
SELECT branch, reason, count(*) AS n FROM found WHERE reason IS NOT NULL GROUP BY 1, 2""",
    "text_audit": f"""WITH texts AS (
  {_audit("documents", "text")} UNION ALL {_audit("pages", "html")} UNION ALL {_audit("conversations", "text")}
  UNION ALL {_audit("benchmark", "text")} UNION ALL {_audit("events", "props")}
)
SELECT topic, coalesce({_DOCUMENT_REASON}, 'document') AS reason, count(*) AS n FROM texts GROUP BY 1, 2""",
    "signals": f"""{_SIGNALS} SELECT part, pos, data_source, is_last_batch, tag_id, batch_id, operate_source,
  task_status FROM signals""",
    "queue_newest_first": f"""{_SIGNALS} SELECT 'tags:task:queue' AS queue_name,
  row_number() OVER (ORDER BY pos DESC) AS place, {_PAYLOAD} AS payload, part, pos FROM signals""",
    "queue_burst": f"""{_SIGNALS} SELECT 'tags:task:queue' AS queue_name,
  row_number() OVER (ORDER BY pos % 3 = 0, part DESC, pos DESC) AS place, {_PAYLOAD} AS payload, part, pos FROM signals""",
    "user_profiles": f"{_PROFILES} SELECT {_PROFILE_COLUMNS}, pos FROM profiles",
    "profile_sources": f"""{_PROFILES} SELECT id,
  '{{"id":"' || id || '","app_id":"' || app_id || '","user_id":"' || user_id || '"'
  || coalesce(',"nick_name":"' || nick_name || '"', '')
  || ',"user_created_at":' || user_created_at || ',"user_from":' || user_from
  || coalesce(',"phone":"' || phone || '"', '') || '}}' AS source, pos FROM profiles""",
    "profile_upsert": f"""{_PROFILES} SELECT id, arg_max(app_id, pos) AS app_id, arg_max(user_id, pos) AS user_id,
  arg_max(nick_name, pos) AS nick_name, arg_max(real_name, pos) AS real_name,
  arg_max(user_created_at, pos) AS user_created_at, arg_max(user_from, pos) AS user_from,
  arg_max(user_identity, pos) AS user_identity, arg_max(phone, pos) AS phone,
  arg_max(collection_phone, pos) AS collection_phone FROM profiles GROUP BY id""",
    "keep_last": f"""{_LOG} SELECT id, value, part, pos FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY pos DESC) AS rn FROM docs) WHERE rn = 1""",
    "conversation_last_turn": """SELECT cast(conv_id AS varchar) AS id, turn AS pos, role, text FROM (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn FROM conversations) WHERE rn = 1""",
    "field_merge": f"{_FIELDS} {_newest('id, field, val')}",
    "field_merge_ignore_null": f"{_FIELDS} {_newest('id, field, val', 'WHERE val IS NOT NULL')}",
    "document_sources": f"""{_FIELDS} SELECT id, '{{' || {_SOURCES} || '}}' AS source
FROM ({_newest('id, field, token')}) GROUP BY id""",
    "bulk_written": f"""{_FIELDS} SELECT id, '{{' || {_SOURCES} || '}}' AS source
FROM ({_newest('id, field, token')}) GROUP BY id""",
    "exact_numbers": f"""WITH newest AS (
  SELECT 'u' || cast(user_id AS varchar) AS id, cast(max(event_id) AS varchar) AS e FROM events GROUP BY 1
), told AS (
  SELECT id, e || '.500' AS amount, e || '123456789012345678901234567890123456789' AS big, e || 'e400' AS far, e FROM newest
)
SELECT id, field, CASE field WHEN 'amount' THEN amount WHEN 'big' THEN big WHEN 'far' THEN far ELSE id END AS val,
  '{{"amount":' || amount || ',"big":' || big || ',"far":' || far || ',"id":"' || id || '","w":{{"v":[' || e || '.0]}}}}' AS source
FROM told, (SELECT unnest(['id', 'amount', 'big', 'far']) AS field)""",
    "document_state": f"""{_FIELDS}, merged AS ({_newest('id, field, val')})
SELECT id, {', '.join(f"max(CASE WHEN field = '{name}' THEN val END) AS {name}" for name in _WIDE)}
FROM merged GROUP BY id""",
    "corpus_state": """SELECT 'd' || cast(doc_id AS varchar) AS id, text, lang, source,
  cast(n_chars AS varchar) AS n_chars FROM documents""",
    "nested_merge": """WITH seen_in AS (
  SELECT 'u' || cast(user_id AS varchar) AS id, event_id AS e, event_type AS kind FROM events
),
resets AS (SELECT id, max(e) AS e FROM seen_in WHERE e % 5 = 0 GROUP BY id),
alive AS (
  SELECT i.id, i.kind, i.e FROM seen_in i LEFT JOIN resets r ON r.id = i.id
  WHERE i.e % 5 <> 0 AND i.e > coalesce(r.e, -1)
),
leaves AS (SELECT id, kind, 'k' || cast(e % 3 AS varchar) AS k, max(e) AS e FROM alive GROUP BY 1, 2, 3),
kinds AS (
  SELECT id, kind, '"' || kind || '":{"at":' || max(e) || ',"n":{'
    || string_agg('"' || k || '":[' || e || ']', ',' ORDER BY k) || '}}' AS member
  FROM leaves GROUP BY id, kind
),
seen AS (SELECT id, '{' || string_agg(member, ',' ORDER BY kind) || '}' AS token FROM kinds GROUP BY id)
SELECT u.id, '{"id":"' || u.id || '","seen":' || coalesce(s.token, cast(r.e AS varchar)) || '}' AS source
FROM (SELECT DISTINCT id FROM seen_in) u LEFT JOIN seen s ON s.id = u.id LEFT JOIN resets r ON r.id = u.id""",
    "offset_ledger": f"""WITH log AS ({log_sql(BEHAVIOR_COLUMNS)})
SELECT 'app:g1:' || topic || ':' || cast(part AS varchar) AS key, cast(max(pos) + 1 AS varchar) AS value
FROM log GROUP BY topic, part""",
    "ledger_load": f"{_LEDGER} SELECT part, until_pos FROM latest",
    "ledger_live": f"""{_LEDGER} SELECT topic, part, until_pos, batch_id FROM ledger
WHERE updated_at > timestamp '2024-01-23 12:00:00'""",
    "start_positions": f"""{_LEDGER} SELECT cast(p.part AS integer) AS part, coalesce(l.until_pos, -1) AS start_pos
FROM (SELECT unnest(range((SELECT max(part) + 3 FROM log))) AS part) p LEFT JOIN latest l ON l.part = p.part""",
    "point_get": f"""{_FIELDS} SELECT * FROM ({_newest('id, field, token::varchar AS token')})
WHERE id = 'u5' AND field IN ('nick_name', 'phone')""",
    "multi_get": f"""{_FIELDS} SELECT id, '{{' || {_SOURCES} || '}}' AS source
FROM ({_newest('id, field, token')})
WHERE id IN (SELECT 'u' || cast(user_id AS varchar) FROM events WHERE event_type = 'error') GROUP BY id""",
    "key_glob": f"""{_LEDGER} SELECT 'app:g1:' || topic || ':' || cast(part AS varchar) AS key,
  cast(until_pos AS varchar) AS value FROM latest WHERE part IN (1, 3)""",
    "batch_metrics": f"""{_LOG} SELECT cast(floor(pos / 1000) AS bigint) AS batch_id, count(*) AS messages,
  cast(coalesce(sum(strlen(value)), 0) AS bigint) AS bytes,
  count(*) FILTER (WHERE {_DOCUMENT_REASON} IS NULL) AS documents,
  count(*) FILTER (WHERE (object ->> '$.data_source') = 'tag_operate_queue'
    AND (object ->> '$.is_last_batch') = '1') AS signals,
  count(*) FILTER (WHERE {_DOCUMENT_REASON} IS NOT NULL) AS rejected
FROM offered GROUP BY 1""",
    "stream_field_merge": f"{_FIELDS} {_STREAM_TOKENS}",
    "stream_queue": f"""{_SIGNALS} SELECT 'tags:task:queue' AS queue_name, {_PAYLOAD} AS payload, part, pos
FROM signals""",
    "stream_profiles": f"""{_PROFILES}, newest AS (
  SELECT id, arg_max(app_id, pos) AS app_id, arg_max(user_id, pos) AS user_id, arg_max(nick_name, pos) AS nick_name,
    arg_max(user_created_at, pos) AS user_created_at, arg_max(user_from, pos) AS user_from,
    arg_max(phone, pos) AS phone FROM profiles GROUP BY id
)
SELECT id, '{{"app_id":"' || app_id || '","id":"' || id || '"' || coalesce(',"nick_name":"' || nick_name || '"', '')
  || coalesce(',"phone":"' || phone || '"', '') || ',"user_created_at":' || user_created_at
  || ',"user_from":' || user_from || ',"user_id":"' || user_id || '"}}' AS source FROM newest""",
}
ORACLES["store_snapshot"] = ORACLES["document_sources"]
ORACLES["bulk_nested"] = ORACLES["nested_merge"]
ORACLES["stream_new_checkpoint"] = ORACLES["stream_field_merge"]
ORACLES["store_levels"] = ORACLES["document_sources"]
ORACLES["stream_commit"] = ORACLES["stream_field_merge"]
ORACLES["stream_from_positions"] = ORACLES["stream_queue"]
ORACLES["stream_no_replays"] = ORACLES["stream_queue"]
ORACLES["multi_get_store"] = ORACLES["multi_get"]
# a batch takes the next third of the positions of every partition; what it reached is the end of each or the cap
ORACLES["stream_progress"] = f"""WITH log AS ({log_sql(BEHAVIOR_COLUMNS)}),
cap AS (SELECT greatest(1, max(pos) // 3) AS n FROM log),
ends AS (SELECT part, max(pos) + 1 AS until_pos FROM log GROUP BY part),
batches AS (SELECT unnest(range((SELECT max(pos) // n + 1 FROM log, cap GROUP BY n))) AS batch_id),
counts AS (SELECT pos // n AS batch_id, count(*) AS messages FROM log, cap GROUP BY 1)
SELECT cast(b.batch_id AS bigint) AS batch_id, cast(coalesce(any_value(c.messages), 0) AS bigint) AS messages,
  '{{' || string_agg('"' || part || '": ' || least(until_pos, (b.batch_id + 1) * n), ', ' ORDER BY cast(part AS varchar)) || '}}' AS reached
FROM batches b LEFT JOIN counts c ON c.batch_id = b.batch_id, ends, cap GROUP BY b.batch_id"""
