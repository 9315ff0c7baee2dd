"""The queries again as SQL over the supplied tables.

Answers are worked out from the source columns, never by reading the documents
that the Spark side builds, so the two share no step.
"""

from __future__ import annotations

CORPUS = """
corpus AS (
    SELECT *, row_number() OVER (PARTITION BY cust ORDER BY label, file_path) AS seq FROM (
    SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey ELSE o_orderkey - o_orderkey % 5000 END AS label,
           o_custkey AS cust, 'cust-' || o_custkey AS contract_id,
           'all/customer/' || o_custkey || '/' || o_orderkey || '.json' AS file_path,
           o_orderstatus AS st, o_orderpriority AS pr, (1 + o_orderkey % 3) || '.0.0' AS version,
           o_orderstatus <> 'F' AS amount_null, o_orderstatus <> 'P' AS has_placed,
           CASE WHEN o_orderpriority < '3' THEN 'string' ELSE 'integer' END AS pr_type,
           o_orderkey % 5 = 0 AS has_flag,
           CASE WHEN o_orderkey % 7 = 0 THEN 'Data Team' ELSE 'Team ' || o_orderpriority END AS owner,
           CASE WHEN o_orderkey % 7 = 0 THEN 5000 ELSE 1000 * (1 + o_orderkey % 5) END AS latency,
           CASE WHEN o_orderkey % 23 = 0 THEN 'cut_short'
                WHEN o_orderkey % 17 = 0 THEN 'no_columns_key'
                WHEN o_orderkey % 19 = 0 THEN 'amount_is_int'
                WHEN o_orderkey % 29 = 0 THEN 'id_twice'
                WHEN o_orderkey % 31 = 0 THEN 'blank_name'
                WHEN o_orderkey % 37 = 0 THEN 'numeric_version'
                WHEN o_orderkey % 41 = 0 THEN 'null_description'
                ELSE 'clean' END AS defect
    FROM orders)
),
judged AS (
    SELECT *,
           defect NOT IN ('cut_short', 'no_columns_key', 'amount_is_int', 'numeric_version') AS is_valid,
           defect = 'clean' AS is_built,
           3 + has_placed::INT + has_flag::INT AS n_columns
    FROM corpus
),
built AS (
    SELECT *, concat_ws('|', amount_null, has_placed, pr_type, has_flag, owner, latency) AS def FROM judged WHERE is_built
),
cols AS (
    SELECT contract_id, seq, label, file_path, version, 0 AS ordinal, 'id' AS name, 'string' AS data_type, false AS nullable FROM built
    UNION ALL SELECT contract_id, seq, label, file_path, version, 1, 'amount', 'number', amount_null FROM built
    UNION ALL SELECT contract_id, seq, label, file_path, version, 2, 'placed_on', 'timestamp', true FROM built WHERE has_placed
    UNION ALL SELECT contract_id, seq, label, file_path, version, 2 + has_placed::INT, 'priority', pr_type, true FROM built
    UNION ALL SELECT contract_id, seq, label, file_path, version, 3 + has_placed::INT, 'flag', 'boolean', false FROM built WHERE has_flag
),
acols AS (
    SELECT *, CASE data_type WHEN 'number' THEN 'double' WHEN 'integer' THEN 'int' WHEN 'boolean' THEN 'boolean' ELSE 'string' END AS avro
    FROM cols
),
hist AS MATERIALIZED (
    SELECT *, lag(seq) OVER w AS prev_seq, lag(label) OVER w AS prev_label, lag(version) OVER w AS prev_version, lag(def) OVER w AS prev_def,
           row_number() OVER w AS n
    FROM built WINDOW w AS (PARTITION BY contract_id ORDER BY seq)
),
numbered AS (
    SELECT *, (prev_def IS NULL OR prev_def <> def) AS changed,
           (sum((prev_def IS NULL OR prev_def <> def)::INT) OVER (PARTITION BY contract_id ORDER BY seq))::BIGINT AS registry_version
    FROM hist
)
"""

# One document per part, each breaking another rule; twelve kinds, the rest is sound.
ODD = """
odd AS (
    SELECT *, CASE kind WHEN 0 THEN 'not_object' WHEN 1 THEN 'columns_not_list' WHEN 2 THEN 'column_not_object at column 0'
                        WHEN 3 THEN 'column_missing_name at column 0'
                        WHEN 4 THEN 'column_missing_data_type at column 0: id; invalid_data_type at column 0: id'
                        WHEN 5 THEN 'blank_column_name at column 0' WHEN 6 THEN 'blank_contract_id; blank_description' WHEN 7 THEN 'no_columns'
                        WHEN 8 THEN 'missing_field: contract_id; missing_field: name; missing_field: description'
                        WHEN 10 THEN 'unreadable: metadata.sla_max_latency_ms' WHEN 11 THEN 'unreadable: metadata' END AS reason
    FROM (SELECT p_partkey % 20 AS kind, p_partkey % 25 = 0 AS skipped,
                 'current/part/' || p_partkey || CASE WHEN p_partkey % 25 = 0 THEN '.txt' ELSE '.json' END AS file_path,
                 CASE WHEN p_partkey % 2 = 0 THEN 'Part-' ELSE 'part_' END || (p_partkey // 2) AS contract_id FROM part)
)
"""

# What a reader with the columns of version `r` cannot fill from data written under `w`.
OFFENCES = """
neighbours AS (SELECT contract_id, seq, prev_seq FROM hist WHERE prev_seq IS NOT NULL),
earlier AS (
    SELECT v.contract_id, v.seq, u.seq AS old_seq FROM built v JOIN built u ON u.contract_id = v.contract_id AND u.seq < v.seq
),
forward AS (
    SELECT p.contract_id, p.seq, p.old_seq, r.name,
           CASE WHEN w.name IS NULL THEN 'no_default' ELSE 'type' END AS reason
    FROM earlier p
    JOIN acols r ON r.contract_id = p.contract_id AND r.seq = p.old_seq
    LEFT JOIN acols w ON w.contract_id = p.contract_id AND w.seq = p.seq AND w.name = r.name
    WHERE CASE WHEN w.name IS NULL THEN NOT r.nullable
               ELSE NOT ((w.avro = r.avro OR (w.avro = 'int' AND r.avro = 'double')) AND (r.nullable OR NOT w.nullable)) END
),
backward AS (
    SELECT p.contract_id, p.seq, p.old_seq, r.name,
           CASE WHEN w.name IS NULL THEN 'no_default' ELSE 'type' END AS reason
    FROM earlier p
    JOIN acols r ON r.contract_id = p.contract_id AND r.seq = p.seq
    LEFT JOIN acols w ON w.contract_id = p.contract_id AND w.seq = p.old_seq AND w.name = r.name
    WHERE CASE WHEN w.name IS NULL THEN NOT r.nullable
               ELSE NOT ((w.avro = r.avro OR (w.avro = 'int' AND r.avro = 'double')) AND (r.nullable OR NOT w.nullable)) END
)
"""


def _compat(found: str) -> str:
    return f"""
WITH {CORPUS}, {OFFENCES},
found AS ({found}),
listed AS (
    SELECT contract_id, seq, string_agg(name || ':' || reason, ',' ORDER BY name, reason) AS offending
    FROM (SELECT DISTINCT contract_id, seq, name, reason FROM found) GROUP BY ALL
)
SELECT b.contract_id, b.label AS seq, b.file_path, b.version, l.offending IS NULL AS compatible, coalesce(l.offending, '') AS offending
FROM built b LEFT JOIN listed l USING (contract_id, seq)
"""


def _neighbour(side: str) -> str:
    return f"SELECT f.* FROM {side} f JOIN neighbours n ON n.contract_id = f.contract_id AND n.seq = f.seq AND n.prev_seq = f.old_seq"


CLASSIFIED = """
    SELECT contract_id, seq, coalesce(n.name, o.name) AS column_name,
           CASE WHEN n.name IS NULL THEN 'removed'
                WHEN o.name IS NULL AND n.nullable THEN 'added_optional'
                WHEN o.name IS NULL THEN 'added_required'
                WHEN o.{type} <> n.{type} THEN 'type_modified'
                WHEN o.nullable <> n.nullable THEN 'nullable_changed'
                ELSE 'same' END AS kind,
           o.{type} AS old_type, n.{type} AS new_type, o.nullable AS old_nullable, n.nullable AS new_nullable,
           coalesce(o.nullable <> n.nullable, false) AS nullable_changed
    FROM (SELECT c.* FROM acols c JOIN hist h USING (contract_id, seq) WHERE h.prev_seq IS NOT NULL) n
    FULL JOIN (SELECT h.contract_id, h.seq, c.name, c.data_type, c.avro, c.nullable
               FROM hist h JOIN acols c ON c.contract_id = h.contract_id AND c.seq = h.prev_seq) o
    USING (contract_id, seq, name)
"""

# Versions taken in order, each held against the ones accepted before it.
FOLD = """
barred AS MATERIALIZED (SELECT contract_id, seq, list(DISTINCT old_seq) AS olds FROM {side} GROUP BY ALL),
fold(contract_id, n, seq, accepted, def, action, registry_version) AS (
    SELECT contract_id, n, seq, [seq], def, 'create', 1::BIGINT FROM hist WHERE n = 1
    UNION ALL
    SELECT contract_id, n, seq,
           CASE WHEN action = 'new_version' THEN list_append(accepted, seq) ELSE accepted END,
           CASE WHEN action = 'new_version' THEN def ELSE old_def END,
           action,
           registry_version + (action = 'new_version')::BIGINT
    FROM (
        SELECT h.contract_id, h.n, h.seq, f.accepted, h.def, f.def AS old_def, f.registry_version,
               CASE WHEN h.def = f.def THEN 'unchanged'
                    WHEN {clash} THEN 'rejected'
                    ELSE 'new_version' END AS action
        FROM fold f JOIN hist h ON h.contract_id = f.contract_id AND h.n = f.n + 1
        LEFT JOIN barred b ON b.contract_id = h.contract_id AND b.seq = h.seq
    )
)
"""
FOLD_FORWARD_ALL = FOLD.format(side="forward", clash="list_has_any(f.accepted, coalesce(b.olds, []))")
FOLD_BACKWARD = FOLD.format(side="backward", clash="list_contains(coalesce(b.olds, []), f.accepted[-1])")

TABLES = """
newest AS (SELECT contract_id, max(seq) AS seq, arg_max(cust, seq) AS cust FROM built GROUP BY contract_id),
oldest AS (SELECT contract_id, min(seq) AS seq, arg_min(cust, seq) AS cust FROM built GROUP BY contract_id),
tcols AS (SELECT *, CASE WHEN data_type IN ('boolean', 'timestamp') THEN data_type ELSE 'string' END AS type FROM cols),
wanted AS (SELECT c.* FROM tcols c JOIN newest USING (contract_id, seq)),
existing AS (
    SELECT c.*, CASE WHEN o.cust % 5 <> 0 THEN c.version END AS old_version
    FROM tcols c JOIN oldest o USING (contract_id, seq) WHERE o.cust % 3 <> 0
),
compared AS (
    SELECT contract_id, count(*) FILTER (e.name IS NULL) AS added, count(*) FILTER (w.name IS NULL) AS removed,
           count(*) FILTER (w.type <> e.type) AS type_changes, count(w.name) AS columns_count,
           max(w.version) AS version, max(e.old_version) AS old_version, count(e.name) > 0 AS there
    FROM wanted w FULL JOIN existing e USING (contract_id, name) GROUP BY contract_id
),
table_plan AS (
    SELECT contract_id, replace(lower(contract_id), '-', '_') AS table_name,
           CASE WHEN NOT there THEN 'created'
                WHEN old_version IS NULL THEN 'foreign_table'
                WHEN added > 0 OR removed > 0 OR old_version <> version THEN 'updated'
                ELSE 'unchanged' END AS action,
           CASE WHEN there THEN added ELSE 0 END AS added, removed, type_changes, columns_count
    FROM compared
)
"""

RUN = f"""
WITH RECURSIVE {CORPUS}, {OFFENCES}, {FOLD_FORWARD_ALL}, {TABLES},
validation AS (SELECT contract_id, file_path, CASE WHEN is_built THEN 'built' ELSE 'failed' END AS build_status FROM judged WHERE is_valid),
schemas AS (
    SELECT b.contract_id, b.file_path, CASE WHEN f.action = 'rejected' THEN 'failed' ELSE 'registered' END AS schema_status, f.registry_version
    FROM built b JOIN fold f USING (contract_id, seq)
    UNION ALL SELECT contract_id, file_path, 'failed', NULL FROM judged WHERE is_valid AND NOT is_built
),
tables_ AS (
    SELECT t.contract_id, b.file_path, CASE t.action WHEN 'foreign_table' THEN 'failed' WHEN 'unchanged' THEN t.action ELSE 'planned_' || t.action END AS table_status, t.columns_count
    FROM table_plan t JOIN newest n USING (contract_id) JOIN built b USING (contract_id, seq)
    UNION ALL SELECT contract_id, file_path, 'failed', NULL FROM judged WHERE is_valid AND NOT is_built
)
"""

ORDERS_DIRTY = """
dirty AS (
    SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN o_custkey END AS o_custkey,
           CASE WHEN o_orderkey % 13 = 0 THEN 'n/a' ELSE o_totalprice::VARCHAR END AS o_totalprice,
           CASE WHEN o_orderkey % 7 = 0 THEN '1998-13-45' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS o_orderdate,
           o_orderstatus, o_orderpriority,
           o_orderkey % 11 = 0 AS no_customer, o_orderkey % 13 = 0 AS no_price, o_orderkey % 7 = 0 AS no_date,
           CASE WHEN o_orderkey % 13 <> 0 THEN o_totalprice END AS price,
           CASE WHEN o_orderkey % 7 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day
    FROM orders
)
"""
REASONS = """
    concat_ws(',', CASE WHEN no_customer THEN 'o_custkey:null_in_required' END,
                   CASE WHEN no_price THEN 'o_totalprice:uncastable' END,
                   CASE WHEN no_date THEN 'o_orderdate:uncastable' END)
"""


def _counts(contract_id: str, table: str, rules: list[tuple[str, str, str]]) -> str:
    lines = " UNION ALL ".join(
        f"SELECT '{column}' AS column_name, '{code}' AS code, count(*) AS rows, count(*) FILTER ({bad}) AS bad FROM {table}"
        for column, code, bad in rules
    )
    return f"SELECT '{contract_id}' AS contract_id, *, round(bad / rows, 6) AS ratio FROM ({lines})"


ORDERS_RULES = [
    ("o_orderkey", "null_in_required", "o_orderkey IS NULL"),
    ("o_orderkey", "uncastable", "false"),
    ("o_custkey", "null_in_required", "o_orderkey % 11 = 0"),
    ("o_custkey", "uncastable", "false"),
    ("o_totalprice", "null_in_required", "o_totalprice IS NULL"),
    ("o_totalprice", "uncastable", "o_orderkey % 13 = 0"),
    ("o_orderdate", "null_in_required", "o_orderdate IS NULL"),
    ("o_orderdate", "uncastable", "o_orderkey % 7 = 0"),
    ("o_orderstatus", "null_in_required", "o_orderstatus IS NULL"),
    ("o_orderstatus", "uncastable", "false"),
    ("o_orderpriority", "uncastable", "false"),
]
LINEITEM_RULES = [
    ("l_orderkey", "null_in_required", "l_orderkey IS NULL"),
    ("l_orderkey", "uncastable", "false"),
    ("l_partkey", "null_in_required", "l_partkey % 10 = 0"),
    ("l_partkey", "uncastable", "false"),
    ("l_quantity", "null_in_required", "l_quantity IS NULL"),
    ("l_quantity", "uncastable", "l_orderkey % 13 = 0"),
    ("l_discount", "null_in_required", "l_discount IS NULL"),
    ("l_discount", "uncastable", "false"),
    ("l_returnflag", "null_in_required", "l_returnflag = 'R'"),
    ("l_returnflag", "uncastable", "false"),
    ("l_shipdate", "null_in_required", "l_shipdate IS NULL"),
    ("l_shipdate", "uncastable", "false"),
    ("l_receiptdate", "missing_column", "true"),
]
EVENTS_RULES = [
    ("event_id", "null_in_required", "event_id IS NULL"),
    ("event_id", "uncastable", "false"),
    ("ts", "null_in_required", "ts IS NULL"),
    ("ts", "uncastable", "false"),
    ("user_id", "null_in_required", "event_id % 13 = 0"),
    ("user_id", "uncastable", "false"),
    ("event_type", "null_in_required", "event_type IS NULL"),
    ("event_type", "uncastable", "false"),
    ("value", "uncastable", "event_id % 17 = 0"),
    ("props", "uncastable", "false"),
]


def _inferred(name: str, columns: list[tuple[str, str, str]]) -> str:
    """(column, type, SQL for a row whose value is null) per column."""
    return " UNION ALL ".join(
        f"SELECT '{name}-v1' AS contract_id, '{name}' AS name, {i} AS ordinal, '{column}' AS column_name, "
        f"'{data_type}' AS data_type, count(*) FILTER ({is_null}) > 0 AS nullable FROM {name}"
        for i, (column, data_type, is_null) in enumerate(columns)
    )


def _conforms(contract_id: str, table: str, columns: list[tuple[str, str | None, str | None, str, str | None]]) -> str:
    """(column, declared, actual, status, SQL for an unreadable value) per column."""

    def text(value: str | None) -> str:
        return "NULL::VARCHAR" if value is None else f"'{value}'"

    return " UNION ALL ".join(
        f"SELECT '{contract_id}' AS contract_id, count(*) AS rows, '{column}' AS column_name, {text(declared)} AS declared, "
        f"{text(actual)} AS actual, '{status}' AS status, "
        + (f"count(*) FILTER ({bad})" if bad else "NULL::BIGINT")
        + f" AS unreadable FROM {table}"
        for column, declared, actual, status, bad in columns
    )


LATENCY = """
late AS (SELECT event_type, event_id % 12000 AS ms FROM events),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ms) AS rn, count(*) OVER (PARTITION BY event_type) AS total FROM late
)
"""

ORACLE: dict[str, str] = {
    "contract_files": f"""
        WITH {CORPUS}
        SELECT 'domain=' || (cust % 16) AS domain, CASE WHEN is_valid THEN 'valid' ELSE 'invalid' END AS validate_status,
               CASE WHEN is_built THEN 'built' WHEN is_valid THEN 'failed' END AS build_status, count(*) AS files
        FROM judged GROUP BY ALL""",
    "contract_parse_status": f"""
        WITH {CORPUS} SELECT file_path, CASE WHEN defect = 'cut_short' THEN 'invalid_json' ELSE 'ok' END AS parse_status FROM corpus""",
    "contract_structure_errors": f"""
        WITH {CORPUS}, found AS (
            SELECT 'invalid_json' AS code, NULL::INTEGER AS idx, NULL::VARCHAR AS column_name, NULL::VARCHAR AS detail FROM corpus WHERE defect = 'cut_short'
            UNION ALL SELECT 'missing_field', NULL, NULL, 'columns' FROM corpus WHERE defect = 'no_columns_key'
            UNION ALL SELECT 'no_columns', NULL, NULL, NULL FROM corpus WHERE defect = 'no_columns_key'
            UNION ALL SELECT 'invalid_data_type', 1, 'amount', 'int' FROM corpus WHERE defect = 'amount_is_int'
            UNION ALL SELECT 'version_not_string', NULL, NULL, '2' FROM corpus WHERE defect = 'numeric_version')
        SELECT code, idx, column_name, detail, count(*) AS errors FROM found GROUP BY ALL""",
    "contract_built": f"""
        WITH {CORPUS}
        SELECT file_path, contract_id, CASE WHEN defect = 'blank_name' THEN '   ' ELSE 'Customer ' || cust END AS name,
               'Orders of customer ' || cust AS description, version, n_columns + (defect = 'id_twice')::INT AS n_columns,
               owner AS data_owner, 'data-team@company.com' AS data_owner_email, 'Data Engineering' AS data_steward,
               'data-engineering@company.com' AS data_steward_email, 99.95::DOUBLE AS sla_uptime_percentage,
               latency::BIGINT AS sla_max_latency_ms
        FROM judged WHERE is_valid AND defect <> 'null_description'""",
    "contract_model_errors": f"""
        WITH {CORPUS}
        SELECT file_path, 'blank_name' AS code, NULL::INTEGER AS idx, NULL::VARCHAR AS column_name FROM judged WHERE defect = 'blank_name'
        UNION ALL SELECT file_path, 'duplicate_column_name', n_columns, 'id' FROM judged WHERE defect = 'id_twice'""",
    "contract_status": f"""
        WITH {CORPUS}
        SELECT file_path, CASE WHEN is_valid THEN 'valid' ELSE 'invalid' END AS validate_status,
               CASE WHEN is_built THEN 'built' WHEN is_valid THEN 'failed' END AS build_status,
               CASE defect WHEN 'cut_short' THEN 'invalid_json'
                           WHEN 'no_columns_key' THEN 'missing_field: columns; no_columns'
                           WHEN 'amount_is_int' THEN 'invalid_data_type at column 1: amount int'
                           WHEN 'id_twice' THEN 'duplicate_column_name at column ' || n_columns || ': id'
                           WHEN 'blank_name' THEN 'blank_name'
                           WHEN 'numeric_version' THEN 'version_not_string: 2'
                           WHEN 'null_description' THEN 'unreadable: description' END AS reason
        FROM judged""",
    "contract_columns": f"WITH {CORPUS} SELECT contract_id, version, label AS seq, file_path, ordinal, name, data_type, nullable FROM cols",
    "type_map": f"""
        WITH {CORPUS}
        SELECT data_type, avro,
               CASE data_type WHEN 'integer' THEN 'bigint' WHEN 'number' THEN 'double' ELSE data_type END AS declared,
               CASE WHEN data_type IN ('boolean', 'timestamp') THEN data_type ELSE 'string' END AS provisioned,
               CASE avro WHEN 'int' THEN 'integer' WHEN 'double' THEN 'number' ELSE avro END AS from_avro,
               CASE WHEN data_type = 'integer' THEN NULL WHEN data_type = 'number' THEN 'double' ELSE data_type END AS from_declared,
               count(*) AS columns
        FROM acols GROUP BY ALL""",
    "avro_fields": f"""
        WITH {CORPUS}
        SELECT file_path, ordinal, name, CASE WHEN nullable THEN '["null","' || avro || '"]' ELSE avro END AS type, nullable AS null_default
        FROM acols""",
    "avro_roundtrip": f"""
        WITH {CORPUS}
        SELECT contract_id, file_path, ordinal, name, CASE WHEN data_type = 'timestamp' THEN 'string' ELSE data_type END AS data_type, nullable
        FROM cols""",
    "doc_metadata": f"""
        WITH {CORPUS}
        SELECT file_path, owner AS data_owner, 'data-team@company.com' AS data_owner_email, 'Data Engineering' AS data_steward,
               'data-engineering@company.com' AS data_steward_email, 99.95::DOUBLE AS sla_uptime_percentage, latency::BIGINT AS sla_max_latency_ms
        FROM built""",
    "tag_roundtrip": f"""
        WITH {CORPUS}
        SELECT file_path, 9 AS n_tags, owner AS data_owner, 'data-team@company.com' AS data_owner_email, 'Data Engineering' AS data_steward,
               'data-engineering@company.com' AS data_steward_email, 99.95::DOUBLE AS sla_uptime_percentage, latency::BIGINT AS sla_max_latency_ms,
               version AS contract_version, 'airflow-dag' AS managed_by, 'data-contract' AS source
        FROM built""",
    "version_history": f"""
        WITH {CORPUS} SELECT contract_id, label AS seq, file_path, version, changed, registry_version, prev_label AS prev_seq, prev_version FROM numbered""",
    "version_diff": f"""
        WITH {CORPUS}, d AS ({CLASSIFIED.format(type="data_type")})
        SELECT d.* EXCLUDE (seq), h.label AS seq, h.file_path, h.prev_label AS prev_seq FROM d JOIN hist h USING (contract_id, seq)""",
    "version_diff_first_last": f"""
        WITH {CORPUS}, ends AS (SELECT contract_id, min(seq) AS a, max(seq) AS z FROM built GROUP BY contract_id),
        o AS (SELECT c.* FROM cols c JOIN ends e ON c.contract_id = e.contract_id AND c.seq = e.a),
        n AS (SELECT c.* FROM cols c JOIN ends e ON c.contract_id = e.contract_id AND c.seq = e.z)
        SELECT contract_id, name AS column_name,
               CASE WHEN n.data_type IS NULL THEN 'removed'
                    WHEN o.data_type IS NULL AND n.nullable THEN 'added_optional'
                    WHEN o.data_type IS NULL THEN 'added_required'
                    WHEN o.data_type <> n.data_type THEN 'type_modified'
                    WHEN o.nullable <> n.nullable THEN 'nullable_changed' ELSE 'same' END AS kind,
               o.data_type AS old_type, n.data_type AS new_type, o.nullable AS old_nullable, n.nullable AS new_nullable,
               coalesce(o.nullable <> n.nullable, false) AS nullable_changed
        FROM o FULL JOIN n USING (contract_id, name)""",
    "version_diff_avro": f"""
        WITH {CORPUS}, d AS ({CLASSIFIED.format(type="avro")})
        SELECT column_name, kind, old_type, new_type, count(*) AS n FROM d GROUP BY ALL""",
    "version_diff_summary": f"""
        WITH {CORPUS}, d AS ({CLASSIFIED.format(type="data_type")}),
        t AS (SELECT *, CASE WHEN kind LIKE 'added%' THEN 'Added column: ' || column_name || ' (' || new_type || ')'
                             WHEN kind = 'type_modified' THEN 'Modified column type: ' || column_name || ' (' || old_type || ' → ' || new_type || ')' END AS change,
                        CASE WHEN kind = 'removed' THEN 'Removed column: ' || column_name || ' (data will be lost)'
                             WHEN kind = 'type_modified' THEN 'Modified column type: ' || column_name || ' (' || old_type || ' → ' || new_type || ')' END AS warning
              FROM d)
        SELECT contract_id, label AS seq, file_path, coalesce(string_agg(change, '; ' ORDER BY change), '') AS changes,
               coalesce(string_agg(warning, '; ' ORDER BY warning), '') AS warnings,
               count(*) FILTER (kind = 'added_required') AS added_required, count(*) FILTER (kind = 'added_optional') AS added_optional,
               count(*) FILTER (kind = 'added_defaulted') AS added_defaulted, count(*) FILTER (kind = 'removed') AS removed,
               count(*) FILTER (kind = 'type_modified') AS type_modified, count(*) FILTER (kind = 'nullable_changed') AS nullable_changed,
               count(*) FILTER (kind = 'same') AS same
        FROM t JOIN (SELECT contract_id, seq, label, file_path FROM hist) USING (contract_id, seq) GROUP BY contract_id, seq, label, file_path""",
    "compat_disabled": _compat("SELECT * FROM forward WHERE false"),
    "compat_forward": _compat(_neighbour("forward")),
    "compat_backward": _compat(_neighbour("backward")),
    "compat_both": _compat(f"{_neighbour('forward')} UNION ALL {_neighbour('backward')}"),
    "compat_forward_all": _compat("SELECT * FROM forward"),
    "version_conflicts": f"""
        WITH {CORPUS}
        SELECT 'version_redefined' AS kind, contract_id AS key, version, count(DISTINCT def) AS distinct_items
        FROM built GROUP BY contract_id, version HAVING count(DISTINCT def) > 1
        UNION ALL SELECT 'id_in_several_files', contract_id, NULL, count(DISTINCT file_path)
        FROM built GROUP BY contract_id HAVING count(DISTINCT file_path) > 1
        UNION ALL SELECT 'table_name_collision', replace(lower(contract_id), '-', '_'), NULL, count(DISTINCT contract_id)
        FROM built GROUP BY replace(lower(contract_id), '-', '_') HAVING count(DISTINCT contract_id) > 1""",
    "registry_latest": f"""
        WITH {CORPUS}, last AS (SELECT * FROM numbered WHERE changed QUALIFY row_number() OVER (PARTITION BY contract_id ORDER BY seq DESC) = 1)
        SELECT contract_id AS schema_name, registry_version AS latest_version, registry_version + 1 AS next_version, 'AVAILABLE' AS status,
               'AVRO' AS data_format, 'FORWARD_ALL' AS compatibility, owner AS data_owner, 'data-team@company.com' AS data_owner_email,
               'Data Engineering' AS data_steward, 'data-engineering@company.com' AS data_steward_email, 99.95::DOUBLE AS sla_uptime_percentage,
               latency::BIGINT AS sla_max_latency_ms, version AS contract_version, 'airflow-dag' AS managed_by, 'data-contract' AS source,
               n_columns AS n_fields
        FROM last""",
    "registration_history": f"""
        WITH RECURSIVE {CORPUS}, {OFFENCES}, {FOLD_FORWARD_ALL}
        SELECT f.contract_id, b.label AS seq, b.file_path, f.action, f.registry_version FROM fold f JOIN built b USING (contract_id, seq)""",
    "registration_history_backward": f"""
        WITH RECURSIVE {CORPUS}, {OFFENCES}, {FOLD_BACKWARD}
        SELECT f.contract_id, b.label AS seq, b.file_path, f.action, f.registry_version FROM fold f JOIN built b USING (contract_id, seq)""",
    "registry_after_loads": f"""
        WITH {CORPUS}
        SELECT contract_id, registry_version, label AS seq, file_path,
               CASE WHEN label <= (SELECT max(label) / 2 FROM built) THEN '1-first' ELSE '2-second' END AS load_id
        FROM numbered WHERE changed""",
    "list_schemas": f"""
        WITH {CORPUS} SELECT contract_id AS schema_name, max(registry_version) AS latest_version FROM numbered GROUP BY contract_id""",
    "get_schema": f"""
        WITH {CORPUS}, last AS (SELECT * FROM numbered WHERE changed QUALIFY row_number() OVER (PARTITION BY contract_id ORDER BY seq DESC) = 1)
        SELECT contract_id AS schema_name, registry_version AS latest_version, registry_version + 1 AS next_version, 'AVAILABLE' AS status, n_columns
        FROM last WHERE contract_id IN ((SELECT min(contract_id) FROM last), (SELECT max(contract_id) FROM last))""",
    "table_plan": f"WITH {CORPUS}, {TABLES} SELECT * FROM table_plan",
    "evolved_table": f"""
        WITH {ORDERS_DIRTY}
        SELECT o_orderkey, day AS o_orderdate, price AS o_totalprice, NULL::VARCHAR AS o_clerk, '2.0.0' AS table_version
        FROM dirty WHERE NOT (no_customer OR no_price OR no_date)""",
    "evolved_columns": f"""
        WITH {ORDERS_DIRTY}
        SELECT NULL::VARCHAR AS o_note, price AS o_totalprice, o_orderkey, NULL::BIGINT AS o_rank, '3.0.0' AS table_version, 0 AS files_written
        FROM dirty WHERE NOT (no_customer OR no_price OR no_date)""",
    "infer_contract": " UNION ALL ".join(
        [
            _inferred(
                "orders",
                [
                    ("o_orderkey", "integer", "o_orderkey IS NULL"),
                    ("o_custkey", "integer", "o_orderkey % 11 = 0"),
                    ("o_totalprice", "string", "o_totalprice IS NULL"),
                    ("o_orderdate", "string", "o_orderdate IS NULL"),
                    ("o_orderstatus", "string", "o_orderstatus IS NULL"),
                    ("o_orderpriority", "string", "o_orderpriority IS NULL"),
                ],
            ),
            _inferred(
                "lineitem",
                [
                    ("l_orderkey", "integer", "l_orderkey IS NULL"),
                    ("l_partkey", "integer", "l_partkey % 10 = 0"),
                    ("l_quantity", "string", "l_quantity IS NULL"),
                    ("l_discount", "number", "l_discount IS NULL"),
                    ("l_returnflag", "string", "l_returnflag = 'R'"),
                    ("l_shipdate", "timestamp", "l_shipdate IS NULL"),
                    ("l_linestatus", "string", "l_linestatus IS NULL"),
                    ("l_tax", "number", "l_tax IS NULL"),
                ],
            ),
            _inferred(
                "events",
                [
                    ("event_id", "integer", "event_id IS NULL"),
                    ("ts", "timestamp", "ts IS NULL"),
                    ("user_id", "integer", "event_id % 13 = 0"),
                    ("event_type", "string", "event_type IS NULL"),
                    ("value", "string", "value IS NULL"),
                    ("props", "string", "props IS NULL"),
                ],
            ),
            _inferred(
                "embeddings",
                [
                    ("vec_id", "integer", "vec_id IS NULL"),
                    ("embedding", "array", "embedding IS NULL"),
                    ("label", "integer", "label IS NULL"),
                ],
            ),
        ]
    ),
    "conformance": _conforms(
        "orders-v1",
        "orders",
        [
            ("o_orderkey", "integer", "integer", "ok", None),
            ("o_custkey", "integer", "integer", "ok", None),
            ("o_totalprice", "number", "string", "type_mismatch", "o_orderkey % 13 = 0"),
            ("o_orderdate", "date", "string", "type_mismatch", "o_orderkey % 7 = 0"),
            ("o_orderstatus", "string", "string", "ok", None),
            ("o_orderpriority", "string", "string", "ok", None),
        ],
    )
    + " UNION ALL "
    + _conforms(
        "lineitem-v1",
        "lineitem",
        [
            ("l_orderkey", "integer", "integer", "ok", None),
            ("l_partkey", "integer", "integer", "ok", None),
            ("l_quantity", "number", "string", "type_mismatch", "l_orderkey % 13 = 0"),
            ("l_discount", "number", "number", "ok", None),
            ("l_returnflag", "string", "string", "ok", None),
            ("l_shipdate", "date", "timestamp", "type_mismatch", "l_shipdate IS NOT NULL AND l_shipdate::DATE IS NULL"),
            ("l_comment", "string", None, "missing_optional", None),
            ("l_receiptdate", "date", None, "missing_required", None),
            ("l_linestatus", None, "string", "extra", None),
            ("l_tax", None, "number", "extra", None),
        ],
    ),
    "conform_orders": f"""
        WITH {ORDERS_DIRTY}
        SELECT o_orderkey, o_custkey, price AS o_totalprice, day AS o_orderdate, o_orderstatus, o_orderpriority FROM dirty""",
    "violations_orders": f"""
        WITH {ORDERS_DIRTY}
        SELECT o_orderkey, 'o_custkey' AS column_name, 'null_in_required' AS code, NULL::VARCHAR AS value FROM dirty WHERE no_customer
        UNION ALL SELECT o_orderkey, 'o_totalprice', 'uncastable', 'n/a' FROM dirty WHERE no_price
        UNION ALL SELECT o_orderkey, 'o_orderdate', 'uncastable', '1998-13-45' FROM dirty WHERE no_date""",
    "violation_counts_orders": _counts("orders-v1", "orders", ORDERS_RULES),
    "violation_counts_lineitem": _counts("lineitem-v1", "lineitem", LINEITEM_RULES),
    "quarantine_orders": f"""
        WITH {ORDERS_DIRTY}
        SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderstatus, o_orderpriority, {REASONS} AS reasons
        FROM dirty WHERE no_customer OR no_price OR no_date""",
    "valid_orders": f"""
        WITH {ORDERS_DIRTY}
        SELECT o_orderkey, o_custkey, price AS o_totalprice, day AS o_orderdate, o_orderstatus, o_orderpriority
        FROM dirty WHERE NOT (no_customer OR no_price OR no_date)""",
    "parse_event_props": """
        WITH p AS (
            SELECT event_id, CASE WHEN event_id % 9 = 0 THEN left(props, length(props) - 1)
                                  WHEN event_id % 10 = 1 THEN '{"k": "many"}' ELSE props END AS text,
                   event_id % 9 = 0 OR event_id % 10 = 1 AS bad, regexp_extract(props, '\\d+')::BIGINT AS n, event_id % 9 = 0 AS cut
            FROM events)
        SELECT event_id, CASE WHEN NOT bad THEN n END AS k, NULL::VARCHAR AS note, CASE WHEN bad THEN text END AS corrupt FROM p""",
    "union_versions": """
        SELECT o_orderkey, o_custkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderstatus,
               CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS o_orderpriority
        FROM orders""",
    "sla_latency_events": f"""
        WITH {LATENCY}
        SELECT event_type, count(*) AS rows, count(*) FILTER (ms > 5000) AS late, round(count(*) FILTER (ms > 5000) / count(*), 6) AS late_ratio,
               min(ms) FILTER (rn >= ceil(total * 0.5)) AS p50, min(ms) FILTER (rn >= ceil(total * 0.99)) AS p99, max(ms) AS max_ms,
               count(*) FILTER (ms > 5000) = 0 AS met
        FROM ranked GROUP BY event_type""",
    "sla_uptime_events": """
        WITH b AS (SELECT DISTINCT epoch(ts)::BIGINT AS s, floor(epoch(ts) / 300)::BIGINT AS bucket FROM events),
        c AS (SELECT max(bucket) - min(bucket) + 1 AS expected, count(DISTINCT bucket) AS live FROM b)
        SELECT expected, live, round(live * 100 / expected, 4) AS uptime_pct, round(live * 100 / expected, 4) >= 99.0 AS met FROM c""",
    "sla_uptime_by_type": """
        WITH b AS (SELECT event_type, floor(epoch(ts) / 3600)::BIGINT AS bucket FROM events),
        c AS (SELECT event_type, max(bucket) - min(bucket) + 1 AS expected, count(DISTINCT bucket) AS live FROM b GROUP BY event_type)
        SELECT event_type, expected, live, round(live * 100 / expected, 4) AS uptime_pct, round(live * 100 / expected, 4) >= 99.0 AS met FROM c""",
    "owner_rollup": f"""
        WITH {CORPUS}, {ORDERS_DIRTY},
        counts AS (
            SELECT 'cust-' || o.o_custkey AS contract_id, count(*) AS rows, sum(no_customer::INT + no_price::INT + no_date::INT) AS bad
            FROM orders o JOIN dirty USING (o_orderkey) GROUP BY ALL),
        owners AS (SELECT contract_id, arg_max(owner, seq) AS owner FROM built GROUP BY contract_id),
        lines AS (SELECT owner, 'Data Engineering' AS steward, contract_id, rows, bad FROM counts JOIN owners USING (contract_id)
                  UNION ALL SELECT '(unknown)', '(unknown)', contract_id, rows, bad FROM counts ANTI JOIN owners USING (contract_id))
        SELECT owner, steward, contract_id, count(*) AS contracts, sum(rows)::BIGINT AS rows, sum(bad)::BIGINT AS bad
        FROM lines GROUP BY GROUPING SETS ((owner, steward, contract_id), (owner, steward), ())""",
    "results_by_contract": f"""
        {RUN},
        v AS (SELECT contract_id, max(file_path) AS validated_file, arg_max(build_status, file_path) AS build_status FROM validation GROUP BY contract_id),
        s AS (SELECT DISTINCT ON (contract_id) contract_id, schema_status, registry_version FROM schemas ORDER BY contract_id, file_path DESC),
        t AS (SELECT DISTINCT ON (contract_id) contract_id, table_status, columns_count FROM tables_ ORDER BY contract_id, file_path DESC)
        SELECT * FROM v FULL JOIN s USING (contract_id) FULL JOIN t USING (contract_id)""",
    "run_summary": f"""
        {RUN},
        n AS (
            SELECT (SELECT count(*) FROM judged) AS total_files,
                   (SELECT count(DISTINCT contract_id) FROM judged WHERE is_valid) AS total_contracts,
                   (SELECT count(*) FROM validation) AS validation_passed,
                   (SELECT count(*) FROM schemas WHERE schema_status = 'registered') AS schema_registered,
                   0::BIGINT AS schema_planned,
                   (SELECT count(*) FROM schemas WHERE schema_status = 'failed') AS schema_failed,
                   (SELECT count(*) FROM tables_ WHERE table_status LIKE 'planned%') AS tables_planned,
                   (SELECT count(*) FROM tables_ WHERE table_status = 'created') AS tables_created,
                   (SELECT count(*) FROM tables_ WHERE table_status = 'updated') AS tables_updated,
                   (SELECT count(*) FROM tables_ WHERE table_status = 'unchanged') AS tables_unchanged,
                   (SELECT count(*) FROM tables_ WHERE table_status = 'failed') AS tables_failed)
        SELECT *, validation_passed = total_files AND schema_failed = 0 AND tables_failed + tables_planned = 0 AND total_contracts > 0 AS ready,
               concat_ws('; ', CASE WHEN validation_passed <> total_files THEN 'fix validation errors' END,
                               CASE WHEN schema_failed > 0 THEN 'fix schema registration' END,
                               CASE WHEN tables_failed > 0 THEN 'fix table creation' END,
                               CASE WHEN tables_planned > 0 THEN 'apply what is planned' END) AS actions
        FROM n""",
    "status_counts": f"""
        WITH {CORPUS}
        SELECT count(*) AS total, count(*) FILTER (is_built) AS passed, count(*) FILTER (NOT is_built) AS failed, 0::BIGINT AS skipped,
               count(*) FILTER (NOT is_built) = 0 AS ok
        FROM judged""",
    "stream_contracts": f"""
        WITH RECURSIVE {CORPUS}, {OFFENCES}, {FOLD_FORWARD_ALL}
        SELECT f.contract_id, b.label AS seq, b.file_path, f.registry_version, b.version FROM fold f JOIN built b USING (contract_id, seq)
        WHERE f.action IN ('create', 'new_version')""",
    "stream_split": f"""
        WITH {ORDERS_DIRTY}
        SELECT o_orderkey, CASE WHEN no_customer OR no_price OR no_date THEN 'quarantine' ELSE 'valid' END AS went, {REASONS} AS reasons FROM dirty""",
    "stream_violation_counts": "WITH closed AS (SELECT *, date_trunc('day', ts) AS w FROM events) "
    + " UNION ALL ".join(
        f"SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, '{column}' AS column_name, '{code}' AS code, count(*) AS rows, "
        f"count(*) FILTER ({bad}) AS bad FROM closed GROUP BY w"
        for column, code, bad in EVENTS_RULES
    ),
    "stream_sla": """
        WITH e AS (SELECT event_type, event_id % 12000 AS ms, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') AS w FROM events)
        SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS rows, count(*) FILTER (ms > 5000) AS late,
               max(ms) AS max_ms, count(*) FILTER (ms > 5000) = 0 AS met
        FROM e GROUP BY w, event_type""",
    "stream_contract_files": f"""
        WITH {CORPUS} SELECT contract_id, count(DISTINCT def) AS definitions FROM built GROUP BY contract_id""",
    "odd_structure_errors": f"""
        WITH {ODD}, found AS (
            SELECT file_path, 'not_object' AS code, NULL::INTEGER AS idx, NULL::VARCHAR AS column_name, NULL::VARCHAR AS detail FROM odd WHERE kind = 0
            UNION ALL SELECT file_path, 'columns_not_list', NULL, NULL, NULL FROM odd WHERE kind = 1
            UNION ALL SELECT file_path, 'column_not_object', 0, NULL, NULL FROM odd WHERE kind = 2
            UNION ALL SELECT file_path, 'column_missing_name', 0, NULL, NULL FROM odd WHERE kind = 3
            UNION ALL SELECT file_path, 'column_missing_data_type', 0, 'id', NULL FROM odd WHERE kind = 4
            UNION ALL SELECT file_path, 'invalid_data_type', 0, 'id', NULL FROM odd WHERE kind = 4
            UNION ALL SELECT file_path, 'no_columns', NULL, NULL, NULL FROM odd WHERE kind = 7
            UNION ALL SELECT file_path, 'missing_field', NULL, NULL, f FROM odd, (VALUES ('contract_id'), ('name'), ('description')) v(f) WHERE kind = 8)
        SELECT * FROM found""",
    "odd_built": f"""
        WITH {ODD}
        SELECT file_path, CASE WHEN kind IN (5, 6, 10, 11) THEN 'failed' ELSE 'built' END AS build_status, reason,
               CASE WHEN kind NOT IN (5, 6, 10, 11) THEN true END AS nullable,
               CASE WHEN kind NOT IN (5, 6, 10, 11) THEN CASE WHEN kind = 9 THEN 'O' ELSE 'Data Team' END END AS data_owner,
               CASE WHEN kind NOT IN (5, 6, 10, 11) THEN CASE WHEN kind = 9 THEN 99.5 ELSE 99.95 END::DOUBLE END AS uptime,
               CASE WHEN kind NOT IN (5, 6, 10, 11) THEN CASE WHEN kind = 9 THEN 250 ELSE 5000 END::BIGINT END AS latency
        FROM odd WHERE kind NOT IN (0, 1, 2, 3, 4, 7, 8)""",
    "odd_conflicts": f"""
        WITH {ODD}
        SELECT 'table_name_collision' AS kind, replace(lower(contract_id), '-', '_') AS key, NULL::VARCHAR AS version, count(DISTINCT contract_id) AS distinct_items
        FROM odd WHERE kind = 9 OR kind > 11 GROUP BY 2 HAVING count(DISTINCT contract_id) > 1""",
    "export_results": f"""
        WITH {ODD}
        SELECT file_path AS file, CASE WHEN skipped THEN 'SKIPPED' WHEN kind = 9 OR kind > 11 THEN 'PASSED' ELSE 'FAILED' END AS status,
               CASE WHEN NOT skipped THEN CASE WHEN kind IN (0, 8) THEN 'unknown' ELSE 'N' END END AS contract_name,
               CASE WHEN skipped THEN 'Not a JSON file' ELSE reason END AS reason
        FROM odd""",
}
ORACLE["written_split_orders"] = f"""
    SELECT v.*, s.* FROM ({ORACLE['violation_counts_orders']}) v, (
        WITH {ORDERS_DIRTY}
        SELECT count(*) FILTER (NOT (no_customer OR no_price OR no_date)) AS valid_rows,
               count(*) FILTER (no_customer OR no_price OR no_date) AS quarantine_rows FROM dirty) s"""
# Events land in three runs; a window is closed once the latest event of an earlier run is a day past its end.
ORACLE["stream_violation_counts_late"] = """
    WITH runs AS (SELECT event_id % 3 AS run, max(ts) AS latest FROM events GROUP BY 1),
    marks AS (SELECT r.run, (SELECT max(latest) FROM runs e WHERE e.run < r.run) - INTERVAL 1 DAY AS mark FROM runs r),
    closed AS (
        SELECT e.*, date_trunc('day', ts) AS w, coalesce(date_trunc('day', ts) + INTERVAL 1 DAY <= m.mark, false) AS behind
        FROM events e JOIN marks m ON m.run = event_id % 3),
    last AS (SELECT max(ts) - INTERVAL 1 DAY AS mark FROM events)""" + " UNION ALL ".join(
    f"""
    SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, '{column}' AS column_name, '{code}' AS code, count(*) AS rows, count(*) FILTER ({bad}) AS bad,
           count(*) FILTER (behind) AS behind_rows, count(*) FILTER (behind AND ({bad})) AS behind_bad, w + INTERVAL 1 DAY <= (SELECT mark FROM last) AS closed
    FROM closed GROUP BY w"""
    for column, code, bad in EVENTS_RULES
)
ORACLE["stream_sla_percentiles"] = """
    SELECT strftime(time_bucket(INTERVAL 5 DAY, ts, TIMESTAMP '1970-01-01'), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS rows,
           true AS p50_near, true AS p99_near
    FROM events GROUP BY ALL"""
# The order in which documents land does not show.
ORACLE["stream_contracts_any_order"] = ORACLE["stream_contracts"]
ORACLE["failed_files"] = f"SELECT file_path AS file, reason FROM ({ORACLE['contract_status']}) WHERE build_status IS DISTINCT FROM 'built'"


def _registration(side: str, clash: str) -> str:
    """All versions but the newest are registered; the newest of each contract is the candidate."""
    return f"""
WITH {CORPUS}, {OFFENCES},
even AS (
    SELECT *, lag(def) OVER (PARTITION BY contract_id ORDER BY seq) AS even_prev FROM built
    WHERE seq < (SELECT max(b.seq) FROM built b WHERE b.contract_id = built.contract_id)
),
registered AS (
    SELECT *, (count(*) OVER (PARTITION BY contract_id ORDER BY seq))::BIGINT AS registry_version,
           row_number() OVER (PARTITION BY contract_id ORDER BY seq DESC) AS back
    FROM even WHERE even_prev IS DISTINCT FROM def
),
candidate AS (SELECT * FROM built QUALIFY row_number() OVER (PARTITION BY contract_id ORDER BY seq DESC) = 1),
against AS (SELECT c.contract_id, c.seq, r.seq AS old_seq FROM candidate c JOIN registered r USING (contract_id) {clash}),
offences AS (
    SELECT a.contract_id, r.name, CASE WHEN w.name IS NULL THEN 'no_default' ELSE 'type' END AS reason
    FROM against a
    JOIN acols r ON r.contract_id = a.contract_id AND r.seq = a.{"old_seq" if side == "forward" else "seq"}
    LEFT JOIN acols w ON w.contract_id = a.contract_id AND w.seq = a.{"seq" if side == "forward" else "old_seq"} AND w.name = r.name
    WHERE CASE WHEN w.name IS NULL THEN NOT r.nullable
               ELSE NOT ((w.avro = r.avro OR (w.avro = 'int' AND r.avro = 'double')) AND (r.nullable OR NOT w.nullable)) END
),
listed AS (
    SELECT contract_id, string_agg(name || ':' || reason, ',' ORDER BY name, reason) AS offending
    FROM (SELECT DISTINCT * FROM offences) GROUP BY contract_id
),
planned AS (
    SELECT c.contract_id, c.label AS seq, c.file_path, r.registry_version AS current, l.offending,
           CASE WHEN r.contract_id IS NULL THEN 'create' WHEN r.def = c.def THEN 'unchanged'
                WHEN l.offending IS NULL THEN 'new_version' ELSE 'rejected' END AS action
    FROM candidate c LEFT JOIN registered r ON r.contract_id = c.contract_id AND r.back = 1
    LEFT JOIN listed l ON l.contract_id = c.contract_id
)
SELECT contract_id, seq, file_path, action, coalesce(current, 0) + (action IN ('create', 'new_version'))::BIGINT AS registry_version,
       CASE WHEN action = 'rejected' THEN offending ELSE '' END AS offending
FROM planned
"""


ORACLE["registration_plan"] = _registration("forward", "")
ORACLE["registration_plan_backward"] = _registration("backward", "WHERE r.back = 1")


def _inferred(counted: str) -> str:
    """``counted``: per key, the type, the texts that hold it, those in which it is null, all objects and what is no object."""
    return f"""
        SELECT 'inferred-v1' AS contract_id, 'Inferred' AS name, column_name, data_type, nulls > 0 OR seen < objects AS nullable, seen, objects, unread
        FROM ({counted}) WHERE seen > 0"""


def _inferred_keys(keys: dict[str, tuple[str, str, str]], source: str, objects: str, unread: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{key}' AS column_name, {data_type} AS data_type, count(*) FILTER ({objects} AND {seen}) AS seen,
                   count(*) FILTER ({objects} AND {null}) AS nulls, count(*) FILTER ({objects}) AS objects, count(*) FILTER ({unread}) AS unread
            FROM {source}"""
        for key, (data_type, seen, null) in keys.items()
    )


ORACLE["inferred_json_events"] = _inferred(
    _inferred_keys(
        {"k": ("CASE WHEN count(*) FILTER (event_id % 9 <> 0 AND event_id % 10 = 1) > 0 THEN 'string' ELSE 'integer' END", "true", "false")},
        "(SELECT * FROM events WHERE props IS NOT NULL)",
        "event_id % 9 <> 0",
        "event_id % 9 = 0",
    )
)
ORACLE["inferred_json_orders"] = _inferred(
    _inferred_keys(
        {
            name: (f"'{data_type}'", f"{name} IS NOT NULL", "false")
            for name, data_type in (
                ("o_orderkey", "integer"),
                ("o_custkey", "integer"),
                ("o_orderstatus", "string"),
                ("o_totalprice", "number"),
                ("o_orderdate", "timestamp"),
                ("o_orderpriority", "string"),
            )
        },
        "orders",
        "true",
        "false",
    )
)
ORACLE["inferred_json_corpus"] = f"WITH {CORPUS} " + _inferred(
    _inferred_keys(
        {
            "contract_id": ("'string'", "true", "false"),
            "name": ("'string'", "true", "false"),
            "description": ("'string'", "true", "defect = 'null_description'"),
            "version": ("'string'", "true", "false"),
            "columns": ("'array'", "defect <> 'no_columns_key'", "false"),
            "metadata": ("'object'", "k % 7 <> 0", "false"),
        },
        "corpus",
        "defect <> 'cut_short'",
        "defect = 'cut_short'",
    )
)
ORACLE["changed_files"] = f"""
    WITH {ODD}, status AS (
        SELECT file_path, CASE WHEN kind IN (0, 1, 2, 3, 4, 7, 8) THEN 'invalid' ELSE 'valid' END AS validate_status,
               regexp_extract(file_path, '(\\d+)\\.', 1)::BIGINT AS k
        FROM odd)
    SELECT 0 AS scan, validate_status, count(*) AS files FROM status GROUP BY 2
    UNION ALL SELECT 2, validate_status, count(*) FROM status WHERE k % 7 = 0 GROUP BY 2"""
ORACLE["applied_tables"] = """
    WITH t AS (SELECT s_suppkey AS k, s_suppkey % 2 = 0 AS second FROM supplier),
    c AS (
        SELECT k, second, 'id' AS name, 'bigint' AS type FROM t
        UNION ALL SELECT k, second, 'balance', CASE WHEN k % 4 = 0 THEN 'string' ELSE 'double' END FROM t
        UNION ALL SELECT k, second, 'nation', 'string' FROM t WHERE second)
    SELECT 'supp_' || k AS table_name, name, type, 'Supp-' || k AS contract_id, CASE WHEN second THEN '2.0.0' ELSE '1.0.0' END AS version, true AS noted
    FROM c"""
