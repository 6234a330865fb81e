"""The same results in plain SQL over the given tables."""

from __future__ import annotations

from workload import inputs


def _select(columns: dict[str, str], source: str) -> str:
    return f"SELECT {', '.join(inputs.select_list(columns))} FROM {source}"


REGISTRY = f"registry AS ({_select(inputs.REGISTRY_COLUMNS, 'events')})"
TOPIC_REGISTRY = (
    "newest AS (SELECT event_type, max(event_id) AS ordinal FROM events GROUP BY event_type), "
    f"registry AS ({_select(inputs.TOPIC_REGISTRY_COLUMNS, 'newest')})"
)
SCHEMAS = f"versions AS ({_select(inputs.SCHEMA_COLUMNS, 'events')})"

_STREAMABLE = """SELECT * FROM registry WHERE is_active AND length(event_key) > 0
    AND length(topic_list) > 0 AND length(bucket_id) > 0 AND length(partition_columns) > 0"""
_TABLEABLE = """SELECT * FROM registry WHERE is_active AND event_key IS NOT NULL
    AND complete_schema IS NOT NULL AND is_transactional IS NOT NULL"""
_BAD = f"complete_schema IN ('{inputs.MALFORMED_SCHEMA}', '{inputs.RECURSIVE_SCHEMA}')"
_IDENTITY = "event_key, topic_list, bucket_id, partition_columns"
_BUCKETED = "bucket_id IN ('p0Event', 'nonP0Event')"


def _unbracketed(column: str) -> str:
    return rf"regexp_replace(trim({column}), '^\[|\]$', '', 'g')"


_ITEMS = (
    f"list_filter(list_transform(string_split({_unbracketed('partition_columns')}, ','), "
    "lambda item: trim(item)), lambda item: length(item) > 0)"
)
_JOINED = f"array_to_string({_ITEMS}, '|')"

# One row per event: the last entry whose schema is usable.
# Its flag, like that of its stream, is the newest complete entry's.
FLAGS = f"""flags AS (SELECT event_key, arg_max(is_transactional, ordinal) AS is_transactional
    FROM ({_TABLEABLE}) GROUP BY event_key)"""
DEFINITIONS = f"""{REGISTRY}, {FLAGS}, definitions AS (
    SELECT event_key, split_part(event_key, '_', 1) AS event_type, flags.is_transactional,
        partition_columns
    FROM (SELECT event_key, partition_columns FROM ({_TABLEABLE} AND NOT {_BAD})
        QUALIFY row_number() OVER (PARTITION BY event_key ORDER BY ordinal DESC) = 1)
    JOIN flags USING (event_key))"""
STREAMS = f"""streams AS (SELECT wanted.*, flags.is_transactional FROM (
    SELECT {_IDENTITY} FROM ({_STREAMABLE}) WHERE {_BUCKETED}
    QUALIFY row_number() OVER (PARTITION BY event_key ORDER BY ordinal DESC) = 1) wanted
    LEFT JOIN flags USING (event_key))"""


def _path(flag: str) -> str:
    return f"""CASE WHEN {flag} IS NULL THEN '/base/' WHEN {flag} THEN '/base/Txn/'
        ELSE '/base/NonTxn/' END || event_key"""


_VALUES = ", ".join(
    f"('{event_type}', {n}, '{name}', '{kind}')"
    for event_type, columns in inputs.TABLE_COLUMNS.items()
    for n, (name, kind) in enumerate(columns)
)
COLUMNS = f"columns_of(event_type, ordinal, column_name, data_type) AS (VALUES {_VALUES})"


def _ddl(quoted: bool) -> str:
    if quoted:
        column = r"""'`' || column_name || '` ' || regexp_replace(data_type, '(\w+): ', '`\1`: ', 'g')"""
        table = "'`main`.`' || namespace || '`.`' || event_key || '`'"
        parts = f"'`' || array_to_string({_ITEMS}, '`, `') || '`'"
    else:
        column = "column_name || ' ' || data_type"
        table = "event_key"
        parts = f"array_to_string({_ITEMS}, ', ')"
    return f"""WITH {DEFINITIONS}, {COLUMNS}, lists AS (
        SELECT event_type, string_agg({column}, ', ' ORDER BY ordinal) AS list
        FROM columns_of GROUP BY event_type),
    named AS (SELECT *, CASE WHEN is_transactional THEN 'Txn' ELSE 'NonTxn' END AS namespace
        FROM definitions JOIN lists USING (event_type))
    SELECT event_key, namespace,
        'CREATE TABLE IF NOT EXISTS ' || {table} || ' (' || list || ') USING DELTA'
        || CASE WHEN len({_ITEMS}) > 0 THEN ' PARTITIONED BY (' || {parts} || ')' ELSE '' END
        || ' LOCATION ''/base/' || namespace || '/' || event_key || '''' AS statement
    FROM named"""


_VALUE = "CASE WHEN event_id % 10 <> 0 THEN value END AS value"
_PARTS = """CAST(strftime(ts, '%Y') AS INTEGER) AS "dpYear",
    CAST(strftime(ts, '%m') AS INTEGER) AS "dpMonth",
    CAST(strftime(ts, '%d') AS INTEGER) AS "dpDay" """
_TEXT_PARTS = """strftime(ts, '%Y') AS "dpYear", strftime(ts, '%m') AS "dpMonth",
    strftime(ts, '%d') AS "dpDay" """
_ALL_ROWS = f"SELECT event_id, user_id, {_VALUE}, {_PARTS} FROM events"
_DECODED = f"SELECT event_id, user_id, {_VALUE}, {_TEXT_PARTS} FROM events"


def _damaged(parts: str) -> str:
    names = ("event_id", "user_id", "value", "dpYear", "dpMonth", "dpDay")
    whole = ", ".join(
        f'CASE WHEN broken THEN NULL ELSE "{name}" END AS "{name}"' for name in names
    )
    return f"""SELECT {whole} FROM (SELECT user_id, {_VALUE}, {parts}, event_id,
        event_id % 12 IN (1, 4, 7, 10) AS broken FROM events)"""


_TABLE_PARTITIONS = f"CASE WHEN len({_ITEMS}) > 0 THEN array_to_string({_ITEMS}, ', ') END"
_DEFINITIONS_SIDE = "CASE WHEN is_transactional THEN 'Txn' ELSE 'NonTxn' END"
_CREATED = f"""WITH {TOPIC_REGISTRY} SELECT event_key, is_transactional,
    CASE WHEN event_key = 'error' THEN 'failure' ELSE 'success' END AS status
    FROM registry WHERE event_key <> 'view'"""
_STARTS = f"""WITH {TOPIC_REGISTRY} SELECT CAST(row_number() OVER (
        ORDER BY CASE bucket_id WHEN 'p0Event' THEN 0 ELSE 1 END, event_key) - 1 AS INTEGER)
        AS position, event_key, bucket_id, event_key <> 'view' AS streamed
    FROM registry WHERE {_BUCKETED}"""

_MERGED_ROWS = f"""SELECT event_id, user_id,
    CASE WHEN event_id % 2 = 1 AND event_id % 10 <> 0 THEN value END AS value, {_PARTS}
    FROM events"""


def _planned(n: int) -> str:
    """What streams by the registry without every n-th entry, and its schema."""
    return f"""SELECT s.*, a.schema FROM (WITH events AS (SELECT * FROM kept WHERE event_id % {n} <> 0),
        {REGISTRY}, {FLAGS}, {STREAMS} SELECT event_key, {_unbracketed('topic_list')} AS topics, bucket_id,
        is_transactional, coalesce({_JOINED}, '') AS parts FROM streams) s LEFT JOIN (WITH events AS (FROM kept), {SCHEMAS}
        SELECT subject, arg_max(schema, version) AS schema FROM versions GROUP BY subject) a
        ON len(list_distinct(list_transform(string_split(s.topics, ','), lambda t: trim(t)))) = 1
        AND subject = trim(string_split(s.topics, ',')[1]) || '-value'"""


ORACLES = {
    "src_stream_read": f"""SELECT event_type AS topic, '{inputs.HEADER}' AS header, event_id
        FROM events""",
    "reg_scan": f"WITH {REGISTRY} SELECT * FROM registry",
    "reg_topics": f"""WITH {REGISTRY} SELECT ordinal, {_unbracketed('topic_list')} AS topics
        FROM registry""",
    "schema_latest": f"""WITH {SCHEMAS} SELECT subject, version, schema FROM versions
        QUALIFY row_number() OVER (PARTITION BY subject ORDER BY version DESC) = 1""",
    "proj_strip_header": "SELECT '{' AS first_char, event_id FROM events",
    "proj_decode": f"SELECT event_id, user_id, {_VALUE} FROM events",
    "proj_decode_permissive": _damaged(_TEXT_PARTS),
    "proj_flatten": _DECODED,
    "proj_date_parts": f"""SELECT event_id, user_id, {_VALUE},
        CAST(strftime(ts, '%Y') AS INTEGER) AS "dpYear",
        CAST(NULL AS INTEGER) AS "dpMonth",
        CASE WHEN event_id % 5 <> 2 THEN CAST(strftime(ts, '%d') AS INTEGER) END AS "dpDay",
        CAST(event_id % 24 AS INTEGER) AS "dpHour" FROM events""",
    "reg_active": f"WITH {REGISTRY} SELECT ordinal, event_key FROM registry WHERE is_active",
    "reg_streamable": f"WITH {REGISTRY} SELECT ordinal, {_IDENTITY} FROM ({_STREAMABLE})",
    "reg_streamable_unpartitioned": f"""WITH {REGISTRY} SELECT ordinal, {_IDENTITY} FROM registry
        WHERE is_active AND length(event_key) > 0 AND length(topic_list) > 0
        AND length(bucket_id) > 0""",
    "reg_tableable": f"""WITH {REGISTRY} SELECT ordinal, event_key, is_transactional,
        partition_columns FROM ({_TABLEABLE})""",
    "reg_buckets": f"""WITH {REGISTRY} SELECT ordinal, event_key, bucket_id
        FROM ({_STREAMABLE}) WHERE {_BUCKETED}""",
    "reg_txn": f"WITH {REGISTRY} SELECT DISTINCT event_key FROM registry WHERE is_transactional",
    "reg_nontxn": f"""WITH {REGISTRY} SELECT DISTINCT event_key FROM registry
        WHERE is_transactional = false""",
    "reg_distinct": f"WITH {REGISTRY} SELECT DISTINCT {_IDENTITY} FROM ({_STREAMABLE})",
    "reg_last_wins": f"""WITH {REGISTRY} SELECT * FROM registry
        QUALIFY row_number() OVER (PARTITION BY event_key ORDER BY ordinal DESC) = 1""",
    "reg_priority": f"""WITH {REGISTRY} SELECT DISTINCT {_IDENTITY},
        CASE bucket_id WHEN 'p0Event' THEN 0 ELSE 1 END AS priority
        FROM ({_STREAMABLE}) WHERE {_BUCKETED} ORDER BY priority, event_key""",
    "reg_bucket_members": f"""WITH {REGISTRY} SELECT DISTINCT bucket_id, event_key
        FROM ({_STREAMABLE}) WHERE {_BUCKETED}""",
    "reg_partition_cols": f"""WITH {REGISTRY} SELECT ordinal,
        coalesce({_JOINED}, '') AS stream_partitions,
        CASE WHEN len({_ITEMS}) > 0 THEN {_JOINED} END AS table_partitions FROM registry""",
    # A list of topics has a schema if all its subjects have the same one; 'audit' is not registered.
    "reg_stream_plan": f"""WITH {REGISTRY}, {SCHEMAS}, {FLAGS}, {STREAMS}, latest AS (
        SELECT subject, arg_max(schema, version) AS schema FROM versions GROUP BY subject),
        topics AS (SELECT event_key, trim(unnest(string_split({_unbracketed('topic_list')}, ','))) || '-value' AS subject
        FROM streams), agreed AS (SELECT event_key, CASE WHEN count(schema) = count(*)
        AND min(schema) = max(schema) THEN min(schema) END AS schema
        FROM topics LEFT JOIN latest USING (subject) GROUP BY event_key)
        SELECT event_key, {_unbracketed('topic_list')} AS topics, bucket_id, partition_columns,
        is_transactional, CASE bucket_id WHEN 'p0Event' THEN 0 ELSE 1 END AS priority,
        {_JOINED} AS stream_partitions, schema
        FROM streams JOIN agreed USING (event_key)""",
    # Lists of two topics have no schema, unless both are the same topic.
    "reg_reconcile": f"""WITH kept AS (SELECT * FROM events), a AS ({_planned(3)}), b AS ({_planned(4)}),
        found AS (SELECT event_key, CASE WHEN a.event_key IS NULL THEN 'start' WHEN b.event_key IS NULL THEN 'stop'
            WHEN b.schema IS NOT NULL AND (a.topics, a.bucket_id, a.is_transactional, a.parts, a.schema)
            IS DISTINCT FROM (b.topics, b.bucket_id, b.is_transactional, b.parts, b.schema) THEN 'restart' END AS action
        FROM a FULL JOIN b USING (event_key))
        SELECT event_key, action FROM found WHERE action IS NOT NULL""",
    # 0: as it is, 1: without a field, 2: with a default for it, 3: a narrower number, 4: malformed.
    "schema_compat": """SELECT subject, version, previous, CASE WHEN kind = 4 THEN 'INVALID' WHEN before IS NULL THEN 'NEW'
        WHEN before = 4 THEN 'UNKNOWN' WHEN kind = before THEN 'FULL' WHEN before = 3 THEN 'BACKWARD' WHEN kind = 3 THEN 'FORWARD'
        WHEN kind = 0 AND before = 1 THEN 'FORWARD' WHEN kind = 1 AND before = 0 THEN 'BACKWARD' ELSE 'FULL' END AS code
        FROM (SELECT event_type || '-value' AS subject, CAST(event_id AS INTEGER) AS version, event_id % 5 AS kind,
            CAST(lag(event_id) OVER w AS INTEGER) AS previous, lag(event_id % 5) OVER w AS before
        FROM events WINDOW w AS (PARTITION BY event_type ORDER BY event_id))""",
    "schema_columns": f"""WITH {DEFINITIONS}, {COLUMNS}
        SELECT event_key, ordinal, column_name, data_type
        FROM definitions JOIN columns_of USING (event_type)""",
    "schema_rejects": f"""WITH {REGISTRY} SELECT ordinal, event_key,
        CASE complete_schema WHEN '{inputs.MALFORMED_SCHEMA}' THEN 'MALFORMED_JSON'
        ELSE 'RECURSIVE_RECORD' END AS code FROM ({_TABLEABLE} AND {_BAD})""",
    "tbl_split": f"""WITH {DEFINITIONS}, {COLUMNS} SELECT {_DEFINITIONS_SIDE} AS side, event_key,
        {_TABLE_PARTITIONS} AS partitions, n AS columns FROM definitions
        JOIN (SELECT event_type, count(*) AS n FROM columns_of GROUP BY event_type)
        USING (event_type)""",
    "tbl_side": f"""WITH {DEFINITIONS} SELECT event_key, {_TABLE_PARTITIONS} AS partitions
        FROM definitions WHERE NOT is_transactional""",
    "tbl_counts": f"""WITH {DEFINITIONS} SELECT is_transactional, count(*) AS definitions
        FROM definitions GROUP BY is_transactional""",
    "tbl_ddl": _ddl(quoted=True),
    "tbl_ddl_plain": _ddl(quoted=False),
    # 1: a column or nested field is missing, 2: the first column has another type, 3: both.
    "tbl_alter": f"""WITH {DEFINITIONS}, drift(event_type, added, refused) AS (VALUES
        ('click', '`visible` boolean', 'page: binary to string'),
        ('error', '`origin`.`frames` Array<long>', 'code: binary to integer'),
        ('purchase', '`attrs` Map<string,long>', 'at: binary to timestamp'),
        ('signup', '`dpHour` integer', 'plan: binary to string'))
        SELECT event_key, CASE WHEN kind % 2 = 1 THEN 'ALTER TABLE `main`.`' || {_DEFINITIONS_SIDE} || '`.`' || event_key
            || '` ADD COLUMNS (' || added || ')' END AS statement, CASE WHEN kind >= 2 THEN refused ELSE '' END AS refused
        FROM (SELECT *, CAST(split_part(event_key, '_', 2) AS BIGINT) % 4 AS kind FROM definitions JOIN drift USING (event_type))
        WHERE kind > 0""",
    "tbl_create": _CREATED,
    "tbl_outcomes": f"""SELECT is_transactional, status, count(*) AS tables FROM ({_CREATED})
        GROUP BY is_transactional, status""",
    "flow_event_append": _ALL_ROWS,
    "flow_permissive_append": _damaged(_PARTS),
    "flow_quarantine": f"""SELECT false AS quarantined, NULL AS topic, CAST(NULL AS BIGINT) AS octets, *
        FROM ({_ALL_ROWS} WHERE event_id % 12 NOT IN (1, 4, 7, 10))
        UNION ALL SELECT true, event_type, CASE event_id % 12 WHEN 4 THEN 3 WHEN 7 THEN 5 WHEN 10 THEN {5 + len(inputs.GARBAGE)} END,
        NULL, NULL, NULL, NULL, NULL, NULL FROM events WHERE event_id % 12 IN (1, 4, 7, 10)""",
    # Records of the first version have the default of the field that it lacks, whatever their bodies say.
    "flow_schema_ids": f"""SELECT event_type AS event_key, {", ".join(
        f'CASE WHEN event_id % 10 <> 3 THEN "{name}" END AS "{name}"'
        for name in ("user_id", "value", "dpYear", "dpMonth", "dpDay", "event_id"))} FROM (SELECT event_id, event_type, user_id,
        CASE WHEN event_id % 2 = 0 THEN {inputs.DEFAULT_VALUE} ELSE value END AS value, {_PARTS}
        FROM (SELECT * REPLACE ({_VALUE}) FROM events) WHERE event_type <> 'error')""",
    "flow_restart": _ALL_ROWS,
    "flow_relayout": _ALL_ROWS,
    "flow_schema_merge": _MERGED_ROWS,
    "flow_fanout": f"""SELECT event_type AS event_key, event_id, user_id, {_VALUE}, {_PARTS}
        FROM events WHERE event_type IN ('click', 'purchase', 'signup')""",
    "flow_multiplex": f"""SELECT event_type AS event_key, event_id, user_id, {_VALUE}, {_PARTS}
        FROM events WHERE event_type IN ('click', 'purchase', 'signup')""",
    "flow_fanout_status": _STARTS,
    "sink_optimized_write": f"""SELECT "dpYear", "dpMonth", "dpDay", count(*) AS rows,
        CAST(1 AS BIGINT) AS files FROM ({_ALL_ROWS}) GROUP BY ALL""",
    "sink_compact": f"""SELECT "dpYear", "dpMonth", "dpDay", count(*) AS rows,
        CAST(1 AS BIGINT) AS files, true AS fewer, CAST(sum(event_id) AS BIGINT) AS event_ids,
        CAST(sum(user_id) AS BIGINT) AS user_ids, count(value) AS filled, min(value) AS least,
        max(value) AS most FROM ({_ALL_ROWS}) GROUP BY ALL""",
    "sink_compact_merged": _MERGED_ROWS,
    "sink_published": f"""SELECT 'publication 1' AS stage, * FROM ({_ALL_ROWS} WHERE event_id % 2 = 0)
        UNION ALL SELECT * FROM (VALUES ('late rows'), ('publication 2')) AS s(stage) CROSS JOIN ({_ALL_ROWS})""",
    "sink_compression": f"""SELECT "dpYear", "dpMonth", "dpDay", 'zstd' AS codec, count(*) AS rows
        FROM ({_ALL_ROWS}) GROUP BY ALL""",
    "flow_query_names": f"""SELECT event_key,
        CASE WHEN streamed THEN 'Stream-' || event_key END AS query_name FROM ({_STARTS})""",
    "reg_paths": f"""WITH {DEFINITIONS}, {STREAMS},
        s AS (SELECT event_key, {_path('is_transactional')} AS stream_path, coalesce({_JOINED}, '') AS stream_partitions FROM streams),
        t AS (SELECT event_key, {_path('is_transactional')} AS table_path,
            CASE WHEN len({_ITEMS}) > 0 THEN {_JOINED} END AS table_partitions FROM definitions)
        SELECT event_key, stream_path, stream_partitions, table_path, table_partitions
        FROM s FULL JOIN t USING (event_key)""",
    # Rank 3: for both sides, 2: for the table, 1: for the stream; the newest of the highest rank decides.
    # The flag is that of the newest entry with a usable schema, if there is one.
    "reg_resolved": f"""WITH {REGISTRY}, {COLUMNS}, ranked AS (SELECT *, split_part(event_key, '_', 1) AS event_type,
        CASE WHEN event_key IS NOT NULL AND complete_schema IS NOT NULL AND is_transactional IS NOT NULL
            AND NOT {_BAD} THEN 2 ELSE 0 END AS tabled,
        CASE WHEN length(event_key) > 0 AND length(topic_list) > 0 AND length(partition_columns) > 0
            AND {_BUCKETED} THEN 1 ELSE 0 END AS streamed FROM registry WHERE is_active),
        winners AS (SELECT * REPLACE (coalesce(arg_max(is_transactional, ordinal) FILTER (tabled = 2)
                OVER (PARTITION BY event_key), is_transactional) AS is_transactional)
            FROM ranked WHERE tabled + streamed > 0
            QUALIFY row_number() OVER (PARTITION BY event_key ORDER BY tabled + streamed DESC, ordinal DESC) = 1),
        sources AS (SELECT * FROM ranked WHERE streamed = 1
            QUALIFY row_number() OVER (PARTITION BY event_key ORDER BY tabled DESC, ordinal DESC) = 1),
        counts AS (SELECT event_type, count(*) AS columns FROM columns_of GROUP BY event_type),
        found AS (SELECT w.event_key, s.ordinal AS source, s.topics, s.bucket_id,
            CASE WHEN s.ordinal IS NOT NULL THEN path END AS stream_path,
            CASE WHEN s.ordinal IS NOT NULL THEN coalesce(parts, '') END AS stream_partitions,
            CASE WHEN w.tabled > 0 THEN w.ordinal END AS described_by, CASE WHEN w.tabled > 0 THEN path END AS table_path,
            CASE WHEN w.tabled > 0 AND parts <> '' THEN parts END AS table_partitions,
            CASE WHEN w.tabled > 0 THEN c.columns END AS columns
        FROM (SELECT *, {_path('is_transactional')} AS path, {_JOINED} AS parts FROM winners) w
        LEFT JOIN (SELECT event_key, ordinal, bucket_id, {_unbracketed('topic_list')} AS topics FROM sources) s
            USING (event_key) LEFT JOIN counts c USING (event_type))
        SELECT *, stream_path = table_path AND stream_partitions = coalesce(table_partitions, '') AS agreed FROM found""",
    "schema_type_rejects": f"""WITH types AS ({_select(inputs.TYPE_COLUMNS, 'events')})
        SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'integer' WHEN 1 THEN 'Array<long>' END AS ddl,
        CASE event_id % 6 WHEN 2 THEN 'INVALID_TYPE' WHEN 3 THEN 'MALFORMED_JSON'
            WHEN 4 THEN 'INVALID_TYPE' END AS code FROM types""",
}
