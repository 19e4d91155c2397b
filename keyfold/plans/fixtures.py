"""Message logs that both engines derive from the given tables.

The expressions are plain SQL that Spark and DuckDB read alike, down to the bytes of ``value``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from keyfold.sources.message_log import spread

TOPIC = "behaviors"

_TAG_MESSAGE = """'{"id":"u' || cast(user_id as string) || '","data_source":"tag_operate_queue","is_last_batch":'
  || CASE event_id % 3 WHEN 0 THEN '1' WHEN 1 THEN '"1"' ELSE '0' END
  || ',"tag_id":' || cast(user_id % 7 as string)
  || ',"batch_id":"' || cast(cast(floor(event_id / 100) as bigint) as string) || '"}'"""

_USER_MESSAGE = """'{"id":"u' || cast(user_id as string) || '","data_source":"user_queue","app_id":'
  || CASE WHEN event_id % 11 = 0 THEN '""' ELSE '"app' || cast(user_id % 5 as string) || '"' END
  || ',"user_id":"' || cast(user_id as string) || '"'
  || CASE WHEN event_id % 2 = 0 THEN ',"nick_name":"n' || cast(event_id as string) || '"' ELSE '' END
  || CASE event_id % 5 WHEN 3 THEN ',"phone":null'
       WHEN 4 THEN ',"phone":"' || cast(event_id as string) || '"' ELSE '' END
  || CASE event_id % 3 WHEN 0 THEN ',"user_created_at":' || cast(event_id as string)
       WHEN 1 THEN ',"user_created_at":"' || cast(event_id as string) || '"' ELSE '' END
  || CASE WHEN event_id % 7 < 5 THEN ',"user_from":' || cast(event_id % 7 as string) ELSE '' END
  || '}'"""

# Every kind of message: junk, incomplete ones, tag messages and user messages.
BEHAVIOR_VALUE = f"""CASE event_id % 20
  WHEN 0 THEN '{{"id":"u' || cast(user_id as string)
  WHEN 1 THEN ''
  WHEN 2 THEN cast(null as string)
  WHEN 3 THEN '[{{"id":"u' || cast(user_id as string) || '"}}]'
  WHEN 4 THEN '{{"user_id":"' || cast(user_id as string) || '"}}'
  WHEN 5 THEN '{{"id":""}}'
  WHEN 6 THEN '{{"id":null}}'
  WHEN 7 THEN '{{"id":' || cast(user_id as string) || ',"k":1}}'
  ELSE CASE WHEN event_type IN ('purchase', 'signup') THEN {_TAG_MESSAGE} ELSE {_USER_MESSAGE} END
END"""

# Nested messages: an object per event type, replaced as a whole by every fifth event.
NESTED_VALUE = """CASE WHEN event_id % 5 = 0
  THEN '{"id":"u' || cast(user_id as string) || '","seen":' || cast(event_id as string) || '}'
  ELSE '{"id":"u' || cast(user_id as string) || '","seen":{"' || event_type || '":{"at":'
    || cast(event_id as string) || ',"n":{"k' || cast(event_id % 3 as string) || '":[' || cast(event_id as string)
    || ']}}}}'
END"""


# Numbers that neither a double nor a decimal of 38 digits holds as they are written.
NUMBER_VALUE = """'{"id":"u' || cast(user_id as string) || '","amount":' || cast(event_id as string) || '.500,"big":'
  || cast(event_id as string) || '123456789012345678901234567890123456789,"far":' || cast(event_id as string)
  || 'e400,"w":{"v":[' || cast(event_id as string) || '.0]}}'"""


def _columns(value: str, ts: str = "cast(ts as timestamp)") -> list[str]:
    return [
        f"'{TOPIC}' AS topic",
        "cast(user_id % 4 as int) AS part",
        "event_id AS pos",
        f"{ts} AS ts",
        f"{value} AS value",
    ]


BEHAVIOR_COLUMNS = _columns(BEHAVIOR_VALUE)
NESTED_COLUMNS = _columns(NESTED_VALUE)
NUMBER_COLUMNS = _columns(NUMBER_VALUE)
# A burst: all in one minute, a third without a time.
BURST_COLUMNS = _columns(
    BEHAVIOR_VALUE, "CASE WHEN event_id % 3 <> 0 THEN cast('2024-01-01 00:00:00' as timestamp) END"
)


def log_sql(columns: list[str]) -> str:
    """The log as a DuckDB query on ``events``."""
    return f"SELECT {', '.join(columns)} FROM events"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def message_log(spark: SparkSession, sf_dir: str, columns: list[str] = BEHAVIOR_COLUMNS) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    return spread(events, spark.sparkContext.defaultParallelism, "event_id", ranges=True).selectExpr(*columns)
