"""DuckDB SQL for the queries, over the driver's views."""

from __future__ import annotations

from checks.fixtures import CAMPAIGNS, LISTS, MESSAGES, SENDER, SUBSCRIBERS, TRAFFIC
from checks.queries import BATCH, CHUNK, HOUR, RUN_TIME, SLICE_LIMIT, SLICE_START


def _select(rules):
    return ", ".join(f"{rule} AS {name}" for name, rule in rules.items())


def _quoted(text):
    return "'" + text.replace("'", "''") + "'"


def _trim(cell):
    return f"trim({cell}, concat(' ', chr(10), chr(13), chr(9), chr(11), chr(0)))"


def _valid(cell):
    return f"regexp_matches({_trim(cell)}, '^255[0-9]{{9}}$')"


def _type(name):
    low = f"lower({name})"
    return f"""CASE WHEN contains({low}, 'p02') OR contains({low}, '921465') THEN 'p02'
        WHEN contains({low}, 'ivr') THEN 'ivr' WHEN contains({low}, 'sms') THEN 'sms' END"""


def _message(kind):
    whens = " ".join(f"WHEN {_quoted(k)} THEN {_quoted(v)}" for k, v in MESSAGES.items())
    return f"CASE {kind} {whens} END"


def _enc(text):
    return f"replace(replace(url_encode({text}), '%20', '+'), '~', '%7E')"


def _hms(s):
    return f"printf('%02d:%02d:%02d', (({s}) // 3600) % 24, (({s}) // 60) % 60, ({s}) % 60)"


def _rate(n, width, unit_seconds):
    return f"""CASE WHEN {width} > 0
        THEN CAST((CAST({n} AS HUGEINT) * {20_000 * unit_seconds} + {width}) // (2 * {width}) AS BIGINT) ELSE 0 END"""


def _between(start, end):
    return f"(epoch_us({end}) - epoch_us({start}) + 5000) // 10000"


SUBS = f"subs AS (SELECT {_select(SUBSCRIBERS)} FROM customer)"

VALID = f"""{SUBS}, valid AS (
    SELECT file_name, row_key, {_trim("msisdn_raw")} AS msisdn FROM subs WHERE {_valid("msisdn_raw")}),
numbered AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY file_name ORDER BY row_key) - 1 AS BIGINT) AS pos,
        count(*) OVER (PARTITION BY file_name) AS file_rows FROM valid)"""


def _batches(source, chunk, batch):
    return f"""plan AS (
    SELECT *, pos // {chunk} + 1 AS chunk_no, pos % {chunk} AS chunk_pos, (pos % {chunk}) // {batch} AS batch_no,
        CAST([6016, 6017, 6018][(pos % {chunk}) % 3 + 1] AS INTEGER) AS port FROM {source})"""


PLAN = f"{VALID}, {_batches('numbered', CHUNK, BATCH)}"


def _traffic(files):
    return f"""traffic AS (
    SELECT 'traffic_' || CAST(user_id % {files} AS VARCHAR) || '.csv' AS file_name, {_select(TRAFFIC)} FROM events)"""


def _issued(files):
    return f"""{_traffic(files)}, placed AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY file_name ORDER BY row_key) - 1 AS BIGINT) AS pos FROM traffic),
{_batches('placed', 5000, 11)}"""


LAST = """last AS (
    SELECT file_name, chunk_no, batch_no, msisdn, arg_max(transport_errno, pos) AS transport_errno,
        count(*) AS issued FROM plan GROUP BY ALL)"""

SPAN = """span AS (
    SELECT file_name, min(ts) AS start_ts, max(ts) AS end_ts, %s AS duration_x100
    FROM traffic GROUP BY file_name)""" % _between("min(ts)", "max(ts)")

COUNTS = """counts AS (SELECT file_name, count(*) FILTER (transport_errno = 0) AS sent,
        count(*) FILTER (transport_errno <> 0) AS failed FROM traffic GROUP BY file_name)"""

LIST_ROWS = f"""size AS (SELECT {LISTS["list_rows"]} AS list_rows FROM customer),
numbers AS (SELECT DISTINCT {LISTS["list_no"].format(list_rows="list_rows")} AS list_no FROM customer, size),
parts AS (SELECT list_no, {LISTS["marker"]} AS marker, {LISTS["ext"]} AS ext, {LISTS["list_state"]} AS list_state FROM numbers),
lists AS (
    SELECT list_no, {LISTS["list_name"]} AS file_name, ext, list_state, {_type(LISTS["list_name"])} AS file_type,
        row_number() OVER (ORDER BY list_no) AS file_ordinal FROM parts),
list_rows AS (
    SELECT l.file_ordinal, l.list_no, l.file_name, l.ext, l.file_type, s.row_key, s.msisdn_raw, coalesce(s.age_raw, '') AS age_raw,
        CAST(row_number() OVER (PARTITION BY l.file_name ORDER BY s.row_key) - 1 AS BIGINT) AS row_pos
    FROM lists l JOIN (SELECT subs.*, CAST(floor(row_key / list_rows) AS BIGINT) AS list_no FROM subs, size) s
        ON s.list_no = l.list_no
    WHERE l.list_state IN ('plain', 'swapped'))"""

LIST_TABLES = f"{SUBS}, {LIST_ROWS}"

VALID_LISTS = f"""picked AS (
    SELECT file_ordinal, list_no, file_name, file_type, {_trim("msisdn_raw")} AS msisdn,
        CAST(row_number() OVER (PARTITION BY file_name ORDER BY row_key) - 1 AS BIGINT) AS pos
    FROM list_rows WHERE {_valid("msisdn_raw")}),
{_batches("picked", CHUNK, BATCH)}"""

LIST_CAMPAIGNS = f"""campaigns AS (
    SELECT file_name, unnest(CASE WHEN list_no % 3 = 0 THEN ['all', 'again', 'third'] ELSE ['all'] END) AS campaign
    FROM lists)"""

CAMPAIGN_VALUES = ", ".join("(" + ", ".join(_quoted(v) for v in row) + ")" for row in CAMPAIGNS)

NUMERIC = r"'^[ \t\n\r\x0B\f]*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?[ \t\n\r\x0B\f]*$'"

CAMPAIGN_ROWS = f"""SELECT {_trim("msisdn_raw")} AS msisdn, '0' AS status, TIMESTAMP '{RUN_TIME}' AS created_at,
    CAST(NULL AS TIMESTAMP) AS updated_at, CAST(NULL AS TIMESTAMP) AS deleted_at
    FROM subs WHERE {_trim("msisdn_raw")} <> ''"""

ORACLE = {
    "csv_scan": f"""WITH {SUBS} SELECT msisdn_raw, nullif(age_raw, '') AS age_raw, CAST(row_key AS VARCHAR) AS row_key_raw
        FROM subs""",
    "resolve_column": f"""WITH {LIST_TABLES} SELECT file_ordinal, file_name,
        CAST(CASE list_state WHEN 'plain' THEN 0 WHEN 'swapped' THEN 1 END AS INTEGER) AS key_index,
        CAST(CASE list_state WHEN 'plain' THEN 1 WHEN 'swapped' THEN 0 WHEN 'no_key_column' THEN 1 END AS INTEGER)
            AS age_index
        FROM lists WHERE list_state <> 'missing'""",
    "csv_scan_first_column": "SELECT props AS cell FROM events",
    "multi_file_scan": f"""WITH {LIST_TABLES}
        SELECT file_ordinal, file_name, row_pos AS pos, msisdn_raw, age_raw FROM list_rows""",
    "discover_files": f"""WITH {LIST_TABLES} SELECT row_number() OVER (ORDER BY file_name) AS file_ordinal, file_name,
        file_type FROM lists WHERE list_state NOT IN ('missing', 'unopenable') AND lower(ext) = 'csv' AND file_type IS NOT NULL""",
    "file_status": f"""WITH {LIST_TABLES} SELECT file_ordinal, file_name, CASE WHEN file_type IS NULL THEN 'unsupported_type'
        WHEN list_state IN ('plain', 'swapped') THEN 'ok' ELSE list_state END AS status FROM lists""",
    "files_union": f"""WITH {LIST_TABLES}
        SELECT {_trim("msisdn_raw")} AS msisdn FROM list_rows WHERE {_valid("msisdn_raw")}""",
    "file_ordinals": f"""WITH {LIST_TABLES} SELECT file_name, file_ordinal, (SELECT count(*) FROM lists) AS files
        FROM lists WHERE list_state IN ('plain', 'swapped')""",
    "file_count": f"""WITH {LIST_TABLES} SELECT
        (SELECT count(*) FROM lists WHERE list_state NOT IN ('missing', 'unopenable') AND lower(ext) = 'csv') AS listed,
        (SELECT count(DISTINCT file_name) FROM list_rows) AS with_rows""",
    "text_scan": "SELECT unnest(string_split(text, chr(10))) AS line FROM documents",
    "csv_sink": """SELECT CAST(event_id AS VARCHAR) AS "ID", props AS "PROPS", ' ' || event_type || ', ' AS "NOTE"
        FROM events""",
    "text_sink": "SELECT replace(unnest(string_split(html, chr(10))), '\"', '') AS line FROM pages",
    "text_sink_by_file": """WITH lines AS (SELECT page_id, string_split(html, chr(10)) AS lines FROM pages), placed AS (
        SELECT page_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM lines)
        SELECT CAST(row_number() OVER (ORDER BY page_id, place) - 1 AS BIGINT) AS line_no, replace(line, '"', '') AS line
        FROM placed""",
    "table_load": f"""WITH {SUBS}, loaded AS ({CAMPAIGN_ROWS})
        SELECT * FROM loaded, (SELECT unnest(['7', '007']) AS load_id)""",
    "table_append": f"WITH {SUBS} {CAMPAIGN_ROWS}",
    "written_count": f"""WITH {SUBS} SELECT row_key % 2 AS part, count(*) AS written FROM subs
        WHERE {_trim("msisdn_raw")} <> '' GROUP BY ALL""",
    "sms_outbox": f"""WITH {PLAN}, typed AS (SELECT *, {_type("file_name")} AS file_type FROM plan),
        bound AS (SELECT *, {_message("file_type")} AS message FROM typed WHERE file_type IS NOT NULL)
        SELECT file_name, msisdn, pos, chunk_no, chunk_pos, batch_no, port, '{SENDER}' AS sender, message, 31 AS dlr_mask,
        'from={SENDER}&to=' || msisdn || '&text=' || {_enc("message")} || '&dlr-mask=31' AS request_query FROM bound""",
    "voice_outbox": f"""WITH {VALID} SELECT file_name, msisdn, pos, pos // 50 AS batch_no, pos // 50 * 3 AS earliest_start_s,
        'msisdn=' || msisdn || '&account=77&MaxRetries=3&RetryTime=1&WaitTime=1' AS request_query FROM numbered""",
    "msisdn_rejects": f"""WITH {SUBS} SELECT file_name, row_key, msisdn_raw, 'invalid_msisdn' AS reason FROM subs
        WHERE NOT {_valid("msisdn_raw")}""",
    "clean_msisdn": f"WITH {SUBS} SELECT row_key, {_trim('msisdn_raw')} AS msisdn FROM subs",
    "valid_msisdns": f"WITH {VALID} SELECT file_name, row_key, msisdn FROM valid",
    "validity_counts": f"""WITH {SUBS} SELECT file_name, count(*) AS read, count(*) FILTER ({_valid("msisdn_raw")}) AS valid,
        count(*) FILTER (NOT {_valid("msisdn_raw")}) AS rejected FROM subs GROUP BY file_name""",
    "nonempty_msisdns": f"""WITH {SUBS} SELECT row_key, {_trim("msisdn_raw")} AS msisdn FROM subs
        WHERE {_trim("msisdn_raw")} <> ''""",
    "campaign_rows": f"WITH {SUBS} {CAMPAIGN_ROWS}",
    "age_segments": f"""WITH {SUBS}, seg AS (SELECT row_key,
        coalesce(regexp_matches(age_raw, {NUMERIC}) AND try_cast(trim(age_raw) AS DOUBLE) >= 35, false) AS older FROM subs)
        SELECT row_key, CASE WHEN older THEN 'o35' ELSE 'u35' END AS segment,
        CASE WHEN older THEN 'Care for joints' ELSE 'Care for muscles' END AS message FROM seg""",
    "numeric_strings": f"""WITH {SUBS} SELECT row_key, coalesce(regexp_matches(age_raw, {NUMERIC}), false) AS is_numeric,
        CASE WHEN regexp_matches(age_raw, {NUMERIC}) THEN try_cast(trim(age_raw) AS DOUBLE) END AS number FROM subs""",
    "file_types": f"WITH {SUBS} SELECT row_key, file_name, {_type('file_name')} AS file_type FROM subs",
    "supported_files": f"""WITH {LIST_TABLES} SELECT file_name AS list_name, file_type FROM lists
        WHERE file_type IS NOT NULL""",
    "csv_files_only": f"WITH {LIST_TABLES} SELECT file_name AS list_name FROM lists WHERE lower(ext) = 'csv'",
    "path_parts": r"""SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS base_name,
        regexp_extract(regexp_extract(url, '([^/]*)$', 1), '\.([^.]*)$', 1) AS extension FROM pages""",
    "strip_quotes": "SELECT page_id, replace(html, '\"', '') AS html FROM pages",
    "url_encode_form": f"SELECT doc_id, {_enc('text')} AS encoded FROM documents",
    "request_query": f"""SELECT page_id, 'from=CARE+LINE&to=255' || lpad(CAST(page_id AS VARCHAR), 9, '0') || '&text=' ||
        {_enc("url")} || '&dlr-mask=31' AS request_query FROM pages""",
    "voice_request": f"""WITH {_traffic(1)} SELECT row_key,
        'msisdn=' || msisdn || '&account=77&MaxRetries=3&RetryTime=1&WaitTime=1' AS request_query FROM traffic""",
    "local_time": """SELECT event_id, strftime(ts + INTERVAL 3 HOUR, '%Y-%m-%d %H:%M:%S') AS local_ts FROM events""",
    "duration_hms": f"SELECT event_id, {_hms('(event_id * 37) % 200000')} AS duration FROM events",
    "message_by_type": f"""WITH {SUBS}, typed AS (SELECT row_key, {_type("file_name")} AS file_type FROM subs)
        SELECT row_key, file_type, {_message("file_type")} AS message FROM typed WHERE file_type IS NOT NULL""",
    "known_types": f"""WITH {LIST_TABLES} SELECT file_name AS list_name, coalesce(file_type IN ('ivr', 'sms'), false) AS known
        FROM lists""",
    "campaign_binding": f"""WITH {SUBS}, campaigns(campaign, file_name, message, sender) AS (VALUES {CAMPAIGN_VALUES})
        SELECT row_key, file_name, campaign, message, sender FROM subs JOIN campaigns USING (file_name)""",
    "row_positions": f"WITH {VALID} SELECT file_name, row_key, pos, file_rows FROM numbered",
    "file_positions": f"""WITH {VALID} SELECT row_key, msisdn,
        CAST(row_number() OVER (ORDER BY row_key) - 1 AS BIGINT) AS list_pos FROM valid""",
    "chunk_plan": f"WITH {PLAN} SELECT file_name, msisdn, pos, chunk_no, chunk_pos, batch_no, port FROM plan",
    "batch_plan": f"WITH {_issued(1)} SELECT row_key, pos, chunk_no, chunk_pos, batch_no FROM plan",
    "port_plan": f"WITH {_issued(3)} SELECT file_name, row_key, port FROM plan",
    "throttle_schedule": f"""WITH {VALID} SELECT file_name, pos, pos // 50 AS batch_no, pos // 50 * 3 AS earliest_start_s
        FROM numbered""",
    "final_chunks": f"""WITH {PLAN} SELECT file_name, pos, chunk_no,
        count(*) OVER (PARTITION BY file_name, chunk_no) < {CHUNK} AS in_final_chunk FROM plan""",
    "chunk_sizes": f"WITH {PLAN} SELECT file_name, chunk_no, count(*) AS chunk_rows FROM plan GROUP BY ALL",
    "row_slice": f"""WITH {_issued(1)} SELECT pos, msisdn AS "MSISDN", CAST(transport_errno AS VARCHAR) AS "ERRNO",
        CAST(row_key AS VARCHAR) AS "ROW_KEY" FROM plan WHERE pos >= {SLICE_START} AND pos < {SLICE_START + SLICE_LIMIT}""",
    "ordered_slice": f"""WITH {_issued(1)} SELECT pos - {SLICE_START} AS list_pos, msisdn AS msisdn_raw,
        CAST(row_key AS VARCHAR) AS row_key_raw FROM plan WHERE pos >= {SLICE_START} AND pos < {SLICE_START + SLICE_LIMIT}""",
    "stream_folder_plan": f"""WITH {LIST_TABLES}, picked AS (
        SELECT file_name, file_type, {_trim("msisdn_raw")} AS msisdn, CAST(row_number() OVER
            (PARTITION BY file_name ORDER BY row_key) - 1 AS BIGINT) AS pos
        FROM list_rows WHERE lower(ext) = 'csv' AND file_type IS NOT NULL AND {_valid("msisdn_raw")}),
        {_batches("picked", CHUNK, BATCH)}
        SELECT file_name, msisdn, pos, chunk_no, batch_no, port, {_message("file_type")} AS message FROM plan""",
    "stream_rejects": f"""WITH {LIST_TABLES} SELECT file_name, msisdn_raw, 'invalid_msisdn' AS reason FROM list_rows
        WHERE lower(ext) = 'csv' AND file_type IS NOT NULL AND NOT {_valid("msisdn_raw")}""",
    "plan_and_rejects": f"""WITH {LIST_TABLES}, counted AS (
        SELECT file_name, count(*) FILTER ({_valid("msisdn_raw")}) AS planned,
            count(*) FILTER (NOT {_valid("msisdn_raw")}) AS rejected FROM list_rows GROUP BY file_name)
        SELECT file_name, planned, planned AS positions, rejected FROM counted""",
    "typed_paths_plan": f"""WITH {LIST_TABLES}, {VALID_LISTS}
        SELECT file_ordinal, file_name, msisdn, pos, chunk_no, batch_no, port, {_message("file_type")} AS message
        FROM plan WHERE file_type IS NOT NULL""",
    "campaigns_plan": f"""WITH {LIST_TABLES}, {VALID_LISTS}, {LIST_CAMPAIGNS}
        SELECT campaign, file_ordinal, file_name, msisdn, pos, chunk_no, batch_no, 'Hello from ' || campaign AS message,
            '{SENDER}' AS sender FROM plan JOIN campaigns USING (file_name)""",
    "quoted_lines_plan": f"""WITH {VALID} SELECT msisdn,
        CAST(row_number() OVER (ORDER BY row_key) - 1 AS BIGINT) AS list_pos FROM valid""",
    "campaign_totals": f"""WITH {LIST_TABLES}, {VALID_LISTS}, {LIST_CAMPAIGNS}, last AS (
            SELECT file_ordinal, file_name, chunk_no, batch_no, msisdn, arg_max(pos % 4 = 0, pos) AS failed, count(*) AS n
            FROM plan GROUP BY ALL),
        totals AS (SELECT file_ordinal, file_name, CAST(sum(n) AS BIGINT) AS issued, count(*) AS counted,
            count(*) FILTER (NOT failed) AS sent, count(*) FILTER (failed) AS failed FROM last GROUP BY ALL)
        SELECT campaign, CAST(file_ordinal + copy * (SELECT count(*) FROM lists) AS BIGINT) AS file_ordinal, file_name,
            issued, counted, sent, failed
        FROM totals JOIN campaigns USING (file_name), (SELECT unnest([0, 1, 2]) AS copy)""",
    "outcome_counts": f"""WITH {_traffic(3)}, {COUNTS} SELECT * FROM counts""",
    "batch_distinct": f"""WITH {_issued(1)} SELECT file_name, chunk_no, batch_no, count(*) AS issued,
        count(DISTINCT msisdn) AS counted FROM plan GROUP BY ALL""",
    "batch_last_outcome": f"WITH {_issued(1)}, {LAST} SELECT * FROM last",
    "totals_rollup": f"""WITH {_issued(3)}, {LAST}, {SPAN}, totals AS (
        SELECT file_name, CAST(sum(issued) AS BIGINT) AS issued, count(*) AS counted,
            count(*) FILTER (transport_errno = 0) AS sent, count(*) FILTER (transport_errno <> 0) AS failed
        FROM last GROUP BY file_name), both_levels AS (
        SELECT file_name, CAST(0 AS BIGINT) AS level, issued, counted, sent, failed, duration_x100
            FROM totals JOIN span USING (file_name)
        UNION ALL SELECT NULL, CAST(1 AS BIGINT), CAST(sum(issued) AS BIGINT), CAST(sum(counted) AS BIGINT),
            CAST(sum(sent) AS BIGINT), CAST(sum(failed) AS BIGINT), {_between("min(start_ts)", "max(end_ts)")}
            FROM totals JOIN span USING (file_name))
        SELECT *, {_rate("sent", "duration_x100", HOUR)} AS rate_x100 FROM both_levels""",
    "run_totals": f"""WITH {_issued(3)}, {LAST}, {SPAN}, totals AS (
        SELECT run, CAST(CASE file_name WHEN 'traffic_2.csv' THEN 1 ELSE 0 END AS BIGINT) AS batch_id, file_name,
            CAST(sum(issued) AS BIGINT) AS issued, count(*) AS counted, count(*) FILTER (transport_errno = 0) AS sent,
            count(*) FILTER (transport_errno <> 0) AS failed
        FROM last, (SELECT unnest(['first', 'second']) AS run) GROUP BY ALL), all_levels AS (
        SELECT run, batch_id, file_name, CAST(0 AS BIGINT) AS level, issued, counted, sent, failed, duration_x100
            FROM totals JOIN span USING (file_name)
        UNION ALL SELECT run, NULL, NULL, CAST(CASE WHEN run IS NULL THEN 3 ELSE 1 END AS BIGINT), CAST(sum(issued) AS BIGINT),
            CAST(sum(counted) AS BIGINT), CAST(sum(sent) AS BIGINT), CAST(sum(failed) AS BIGINT),
            {_between("min(start_ts)", "max(end_ts)")}
            FROM totals JOIN span USING (file_name) GROUP BY ROLLUP (run))
        SELECT *, {_rate("sent", "duration_x100", HOUR)} AS rate_x100 FROM all_levels""",
    "voice_totals": f"""WITH {_traffic(3)}, {SPAN}, placed AS (SELECT *,
            (row_number() OVER (PARTITION BY file_name ORDER BY row_key) - 1) // 50 AS batch_no FROM traffic),
        last AS (SELECT file_name, batch_no, msisdn, arg_max(transport_errno, row_key) AS errno, count(*) AS n
            FROM placed GROUP BY ALL),
        totals AS (SELECT file_name, CAST(sum(n) AS BIGINT) AS processed, count(*) FILTER (errno = 0) AS success,
            count(*) FILTER (errno <> 0) AS failed FROM last GROUP BY file_name)
        SELECT totals.*, duration_x100, {_rate("processed", "duration_x100", HOUR)} AS rate_x100
            FROM totals JOIN span USING (file_name)""",
    "run_span": f"""WITH {_traffic(3)}, {SPAN} SELECT file_name,
        strftime(start_ts + INTERVAL 3 HOUR, '%Y-%m-%d %H:%M:%S') AS started,
        strftime(end_ts + INTERVAL 3 HOUR, '%Y-%m-%d %H:%M:%S') AS ended, duration_x100,
        {_hms("duration_x100 // 100")} AS duration FROM span""",
    "send_rate": f"""WITH {_traffic(3)}, {COUNTS}, {SPAN} SELECT counts.*, duration_x100,
        {_rate("sent", "duration_x100", HOUR)} AS rate_x100 FROM counts JOIN span USING (file_name)""",
    "send_rate_floor1": f"""WITH traffic AS (SELECT 'traffic_' || strftime(ts, '%Y%m%d%H%M') || '.csv' AS file_name,
        {_select(TRAFFIC)} FROM events), {COUNTS}, {SPAN} SELECT counts.*, duration_x100,
        {_rate("sent", "greatest(duration_x100, 100)", 1)} AS rate_x100 FROM counts JOIN span USING (file_name)""",
}
