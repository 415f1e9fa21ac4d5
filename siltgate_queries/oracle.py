"""SQL twins of the registered queries, written the classical way (windows, cascades of
CASE, plain joins) so that they do not share the library's approach."""

from __future__ import annotations

EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
REJECTED_AT = "'2024-01-31T00:00:00+00:00'"
RUN_1, RUN_2 = "20240131T000000Z-00000001", "20240201T000000Z-00000002"
CLOCK_1 = "TIMESTAMP '2024-01-31 00:00:00'"
CLOCK_2 = "TIMESTAMP '2024-02-01 00:00:00'"
ALLOWED = ("pending", "paid", "shipped", "cancelled", "refunded")
ALLOWED_SQL = ", ".join(f"'{s}'" for s in ALLOWED)
ALLOWED_JSON = "[" + ",".join(f'"{s}"' for s in ALLOWED) + "]"
ALLOWED_TEXT = "[" + ", ".join(ALLOWED) + "]"

# ------------------------------------------------------------------ common tables

STEPS = {
    "bronze_customers": (
        (),
        """
        SELECT c_custkey AS customer_id,
               CASE WHEN c_custkey % 41 = 0 THEN NULL WHEN c_custkey % 43 = 0 THEN '  '
                    ELSE c_name END AS name,
               CASE WHEN c_custkey % 29 = 0 THEN NULL
                    WHEN c_custkey % 31 = 0 THEN 'not-an-email'
                    ELSE 'c' || CAST(c_custkey AS VARCHAR) || '@example.com' END AS email,
               CASE WHEN c_custkey % 23 = 0 THEN '' ELSE n_name END AS country,
               c_custkey % 1000 AS signup_seq,
               CASE WHEN c_custkey % 2 = 0 THEN 'crm' ELSE 'web' END AS raw_source,
               u.seq AS seq
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN (VALUES (0), (1)) AS u(seq) ON u.seq = 0 OR c_custkey % 37 = 0
        """,
    ),
    "judged_customers": (
        ("bronze_customers",),
        f"""
        SELECT *, CASE
            WHEN row_number() OVER (PARTITION BY customer_id ORDER BY seq) > 1
                THEN 'duplicate_customer_id'
            WHEN email IS NULL OR trim(email) = '' OR NOT regexp_matches(email, '{EMAIL}')
                THEN 'invalid_or_blank_email'
            WHEN name IS NULL OR trim(name) = '' THEN 'blank_name' END AS reason
        FROM bronze_customers
        """,
    ),
    "silver_customers": (
        ("judged_customers",),
        """
        SELECT customer_id, name, email,
               CASE WHEN country IS NULL OR trim(country) = '' THEN 'UNKNOWN'
                    ELSE country END AS country,
               signup_seq
        FROM judged_customers WHERE reason IS NULL
        """,
    ),
    "bronze_orders": (
        (),
        """
        SELECT o_orderkey AS order_id,
               CASE WHEN o_orderkey % 61 = 0 THEN NULL
                    WHEN o_orderkey % 67 = 0 THEN o_custkey + 1000000000
                    ELSE o_custkey END AS customer_id,
               o_orderdate AS order_date,
               CASE WHEN o_orderkey % 47 = 0 THEN NULL
                    WHEN o_orderkey % 59 = 0 THEN -o_totalprice
                    ELSE o_totalprice END AS amount,
               CASE WHEN o_orderkey % 3 = 0 THEN 'USD' ELSE 'EUR' END AS currency,
               CASE WHEN o_orderkey % 53 = 0 THEN 'UNKNOWN'
                    WHEN o_orderstatus = 'F' THEN 'paid'
                    WHEN o_orderstatus = 'O' THEN 'pending'
                    ELSE 'shipped' END AS status,
               o_orderdate + INTERVAL 1 DAY AS ingested_at,
               u.seq AS seq
        FROM orders JOIN (VALUES (0), (1)) AS u(seq) ON u.seq = 0 OR o_orderkey % 71 = 0
        """,
    ),
    "judged_orders": (
        ("bronze_orders", "silver_customers"),
        f"""
        SELECT o.*, CASE
            WHEN row_number() OVER (PARTITION BY order_id ORDER BY seq) > 1
                THEN 'duplicate_order_id'
            WHEN amount IS NULL OR amount <= 0 THEN 'non_positive_or_null_amount'
            WHEN status IS NULL OR status NOT IN ({ALLOWED_SQL}) THEN 'invalid_status'
            WHEN customer_id IS NULL THEN 'blank_customer_id'
            WHEN customer_id NOT IN (SELECT customer_id FROM silver_customers)
                THEN 'orphan_customer_id' END AS reason
        FROM bronze_orders o
        """,
    ),
    "silver_orders": (
        ("judged_orders",),
        """
        SELECT order_id, customer_id, order_date, amount, currency, status
        FROM judged_orders WHERE reason IS NULL
        """,
    ),
    "bronze_movements": (
        (),
        """
        SELECT event_id AS doc_id, CAST(year(ts) AS INTEGER) AS doc_year, 1 AS doc_line,
               'M' || CAST(user_id % 20 AS VARCHAR) AS material,
               'P' || CAST(user_id % 4 AS VARCHAR) AS plant,
               CASE WHEN event_id % 89 <> 0 THEN CAST(user_id * 100
                    + date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS VARCHAR)
                    END AS batch_id,
               event_type AS code,
               CASE WHEN event_id % 83 = 0 THEN -value ELSE value END AS qty,
               CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 2 = 0 THEN 'KG'
                    ELSE 'EA' END AS unit,
               CASE WHEN event_id % 73 <> 0 AND event_id % 79 <> 0 THEN ts END AS entry_ts,
               CASE WHEN event_id % 79 <> 0 THEN CAST(ts AS DATE) END AS posting_date,
               CASE WHEN event_type = 'signup'
                    THEN 'V' || CAST(user_id % 10 AS VARCHAR) END AS vendor,
               CASE WHEN event_type = 'purchase'
                    THEN 'C' || CAST(user_id AS VARCHAR) END AS customer,
               u.seq AS seq
        FROM events JOIN (VALUES (0), (1)) AS u(seq) ON u.seq = 0 OR event_id % 97 = 0
        """,
    ),
    "stage_dim": (
        (),
        """
        SELECT * FROM (VALUES ('signup', 1), ('view', 2), ('click', 3), ('purchase', 4))
            AS d(stage, stage_order)
        """,
    ),
    "judged_movements": (
        ("bronze_movements", "stage_dim"),
        """
        SELECT m.*, d.stage AS stage,
               coalesce(entry_ts, CAST(posting_date AS TIMESTAMP)) AS event_ts,
               CASE
                   WHEN row_number() OVER (PARTITION BY doc_id, doc_year, doc_line
                                           ORDER BY seq) > 1
                       THEN 'duplicate_movement_key'
                   WHEN material IS NULL OR trim(material) = '' OR batch_id IS NULL
                        OR trim(batch_id) = '' OR code IS NULL OR trim(code) = ''
                        OR plant IS NULL OR trim(plant) = '' THEN 'missing_required_field'
                   WHEN d.stage IS NULL THEN 'unmapped_code'
                   WHEN qty IS NULL OR qty < 0 THEN 'invalid_quantity'
                   WHEN coalesce(entry_ts, CAST(posting_date AS TIMESTAMP)) IS NULL
                       THEN 'invalid_timestamp' END AS reason
        FROM bronze_movements m LEFT JOIN stage_dim d ON m.code = d.stage
        """,
    ),
    "silver_movements": (
        ("judged_movements",),
        "SELECT * EXCLUDE (reason) FROM judged_movements WHERE reason IS NULL",
    ),
    "stage_events": (
        ("silver_movements", "stage_dim"),
        """
        SELECT batch_id, s.stage AS stage,
               first(plant ORDER BY event_ts, doc_id) FILTER (WHERE plant IS NOT NULL) AS plant,
               first(material ORDER BY event_ts, doc_id)
                   FILTER (WHERE material IS NOT NULL) AS material,
               first(unit ORDER BY event_ts, doc_id) FILTER (WHERE unit IS NOT NULL) AS uom,
               first(vendor ORDER BY event_ts, doc_id) FILTER (WHERE vendor IS NOT NULL) AS vendor,
               first(customer ORDER BY event_ts, doc_id)
                   FILTER (WHERE customer IS NOT NULL) AS customer,
               min(event_ts) AS start_ts, max(event_ts) AS end_ts,
               count(*) AS line_count,
               CAST(sum(CAST(qty AS DECIMAL(28, 6))) AS DOUBLE) AS total_quantity,
               max(d.stage_order) AS stage_order
        FROM silver_movements s JOIN stage_dim d ON s.stage = d.stage
        GROUP BY batch_id, s.stage
        """,
    ),
    "stage_times": (
        ("stage_events",),
        """
        SELECT batch_id, material, plant, stage, stage_order, start_ts, end_ts,
               {days:start_ts,end_ts} AS stage_lead_time_days, line_count
        FROM stage_events
        """,
    ),
    "d2d": (
        ("stage_events",),
        """
        SELECT a.batch_id AS batch_id, a.material AS material, a.plant AS plant,
               a.stage AS from_stage, z.stage AS to_stage,
               a.end_ts AS from_end_ts, z.start_ts AS to_start_ts,
               greatest({days:a.end_ts,z.start_ts}, 0e0) AS d2d_lead_time_days
        FROM stage_events a JOIN stage_events z
          ON a.batch_id = z.batch_id AND z.stage_order = a.stage_order + 1
        """,
    ),
    "e2e": (
        ("stage_events",),
        """
        SELECT a.batch_id AS batch_id, a.material AS material, a.plant AS plant,
               a.start_ts AS lifecycle_start, z.end_ts AS lifecycle_end,
               {days:a.start_ts,z.end_ts} AS e2e_lead_time_days,
               n.stages_present AS stages_present
        FROM stage_events a
        JOIN stage_events z ON a.batch_id = z.batch_id
        JOIN (SELECT batch_id, count(DISTINCT stage) AS stages_present
              FROM stage_events GROUP BY batch_id) n ON a.batch_id = n.batch_id
        WHERE a.stage = 'signup' AND z.stage = 'purchase'
        """,
    ),
}


def _days(start: str, end: str) -> str:
    """Whole seconds apart, to hundredths of a day rounded half up, in integers."""
    seconds = (
        f"(CAST(floor(epoch_us({end}) / 1000000) AS BIGINT)"
        f" - CAST(floor(epoch_us({start}) / 1000000) AS BIGINT))"
    )
    return f"(sign({seconds}) * ((abs({seconds}) + 432) // 864) / 100e0)"


def _expand(sql: str) -> str:
    while "{days:" in sql:
        head, rest = sql.split("{days:", 1)
        args, tail = rest.split("}", 1)
        sql = head + _days(*args.split(",")) + tail
    return sql


def with_steps(body: str, *needed: str) -> str:
    """The query with the common tables it needs, in dependency order."""
    order: list[str] = []

    def visit(name: str) -> None:
        for parent in STEPS[name][0]:
            visit(parent)
        if name not in order:
            order.append(name)

    for name in needed:
        visit(name)
    if not order:
        return body.strip()
    tables = ",\n".join(f"{n} AS ({_expand(STEPS[n][1]).strip()})" for n in order)
    return f"WITH {tables}\n{body.strip()}"


# ------------------------------------------------------------------- check rows


def tenth(part: str, total: str) -> str:
    """Percentage with one decimal, as text, from whole numbers."""
    t = f"((2000 * ({part}) + greatest({total}, 1)) // (2 * greatest({total}, 1)))"
    return f"(CAST({t} // 10 AS VARCHAR) || '.' || CAST({t} % 10 AS VARCHAR))"


def pct2(part: str, total: str) -> str:
    t = f"((20000 * ({part}) + greatest({total}, 1)) // (2 * greatest({total}, 1)))"
    return f"CAST({t} / 100e0 AS VARCHAR)"


def verdict(condition: str, otherwise: str = "FAIL") -> str:
    return f"CASE WHEN {condition} THEN 'PASS' ELSE '{otherwise}' END"


def row(table: str | None, no: int, name: str, status: str, message: str, metrics: str) -> str:
    lead = f"'{table}' AS table_name, " if table else ""
    return (
        f"SELECT {lead}{no} AS check_no, '{name}' AS check_name, {status} AS status, "
        f"{message} AS message, {metrics} AS metrics_json"
    )


def recon_of(table: str, counts: str) -> str:
    """Over ``counts``, a query of one row: b, s, q and br rows of bronze, silver, quarantine
    and quarantine without a reason."""
    return (
        row(
            table, 1, "quarantine_reconciliation", verdict("s + q = b AND br = 0"),
            "'Bronze=' || b || ', Silver=' || s || ', Quarantine=' || q || ', accounted='"
            " || (s + q) || ', blank_reasons=' || br",
            "'{\"bronze_count\":' || b || ',\"silver_count\":' || s || ',\"quarantine_count\":'"
            " || q || ',\"accounted\":' || (s + q) || ',\"blank_rejection_reasons\":' || br || '}'",
        )
        + f" FROM ({counts})"
    )


def recon(table: str, judged: str) -> str:
    return recon_of(
        table,
        f"SELECT count(*) AS b, count(*) FILTER (reason IS NULL) AS s,"
        f" count(*) FILTER (reason IS NOT NULL) AS q,"
        f" count(*) FILTER (reason IS NOT NULL AND trim(reason) = '') AS br FROM {judged}",
    )


def damaged(table: str, kept: str, unexplained: str) -> str:
    """The reconciliation of orders whose silver rows fulfil ``kept`` too, and of whose
    rejections those with ``unexplained`` have no reason."""
    return recon_of(
        table,
        f"SELECT count(*) AS b, count(*) FILTER (reason IS NULL AND {kept}) AS s,"
        f" count(*) FILTER (reason IS NOT NULL) AS q,"
        f" count(*) FILTER (reason IS NOT NULL AND {unexplained}) AS br FROM judged_orders",
    )


def movement_recon(no: int, table: str, kept: str = "true", held: str = "true") -> str:
    """``kept`` and ``held`` say which rows are left in silver and in quarantine."""
    return (
        row(
            table, no, "movement_quarantine_reconciliation", verdict("s + q = b"),
            "'Bronze=' || b || ', Silver=' || s || ', Quarantine=' || q",
            "'{\"bronze\":' || b || ',\"silver\":' || s || ',\"quarantine\":' || q || '}'",
        )
        + f" FROM (SELECT count(*) AS b, count(*) FILTER (reason IS NULL AND {kept}) AS s,"
        f" count(*) FILTER (reason IS NOT NULL AND {held}) AS q FROM judged_movements)"
    )


def delta(table: str, judged: str, limit: float, warn: float, fail: float) -> str:
    pct = "(CASE WHEN b = 0 THEN 0e0 ELSE CAST(d AS DOUBLE) / b * 100e0 END)"
    status = (
        f"CASE WHEN {pct} >= {fail} OR {pct} > {limit} THEN 'FAIL'"
        f" WHEN {pct} >= {warn} THEN 'WARN' ELSE 'PASS' END"
    )
    return (
        row(
            table, 1, "row_count_delta", status,
            f"'Bronze=' || b || ', Silver=' || s || ', dropped=' || d || ' (' || "
            f"{tenth('d', 'b')} || '%)'",
            f"'{{\"bronze_count\":' || b || ',\"silver_count\":' || s || ',\"dropped\":' || d"
            f" || ',\"drop_pct\":' || {pct2('d', 'b')} || ',\"max_drop_pct\":{limit}}}'",
        )
        + f" FROM (SELECT b, s, greatest(b - s, 0) AS d FROM (SELECT count(*) AS b,"
        f" count(*) FILTER (reason IS NULL) AS s FROM {judged}))"
    )


def null_rate(
    source: str, column: str, layer: str, limit: float, no: int, table: str | None = None
) -> str:
    return (
        row(
            table, no, f"null_pct_{layer}_{column}",
            verdict(f"CAST(n AS DOUBLE) / greatest(t, 1) * 100e0 <= {limit}"),
            f"'{layer}.{column}: ' || n || '/' || greatest(t, 1) || ' null/blank (' || "
            f"{tenth('n', 't')} || '%), limit={limit}%'",
            f"'{{\"layer\":\"{layer}\",\"column\":\"{column}\",\"nulls\":' || n || ',\"total\":'"
            f" || greatest(t, 1) || ',\"null_pct\":' || {pct2('n', 't')}"
            f" || ',\"limit_pct\":{limit}}}'",
        )
        + f" FROM (SELECT count(*) AS t, count(*) FILTER ({column} IS NULL OR"
        f" trim(CAST({column} AS VARCHAR)) = '') AS n FROM {source})"
    )


def absent(name: str, column: str, layer: str, no: int, table: str | None = None) -> str:
    return row(
        table, no, name, "'FAIL'", f"'Column ''{column}'' not found in {layer}'",
        f"'{{\"column\":\"{column}\",\"layer\":\"{layer}\"}}'",
    )


def unique(source: str, column: str, layer: str, no: int, table: str | None) -> str:
    return (
        row(
            table, no, f"unique_{layer}_{column}", verdict("t = d"),
            f"'{layer}.{column}: ' || (t - d) || ' duplicate value(s)'",
            f"'{{\"layer\":\"{layer}\",\"column\":\"{column}\",\"total\":' || t ||"
            f" ',\"distinct\":' || d || ',\"duplicates\":' || (t - d) || '}}'",
        )
        + f" FROM (SELECT (SELECT count(*) FROM {source}) AS t,"
        f" (SELECT count(*) FROM (SELECT DISTINCT {column} FROM {source})) AS d)"
    )


def emails(source: str, layer: str, no: int, table: str | None = None) -> str:
    return (
        row(
            table, no, f"email_format_{layer}", verdict("n = 0"),
            f"'{layer}: ' || n || ' invalid email(s)'",
            f"'{{\"invalid_emails\":' || n || ',\"layer\":\"{layer}\"}}'",
        )
        + f" FROM (SELECT count(*) FILTER (email IS NULL OR NOT regexp_matches(email,"
        f" '{EMAIL}')) AS n FROM {source})"
    )


def amounts(source: str, column: str, layer: str, no: int, table: str | None = None) -> str:
    return (
        row(
            table, no, f"amount_positive_{layer}", verdict("n = 0"),
            f"'{layer}: ' || n || ' non-positive/null amount(s)'",
            f"'{{\"bad_amounts\":' || n || ',\"layer\":\"{layer}\"}}'",
        )
        + f" FROM (SELECT count(*) FILTER ({column} IS NULL OR {column} <= 0) AS n FROM {source})"
    )


def statuses(source: str, layer: str, no: int, table: str | None = None) -> str:
    return (
        row(
            table, no, f"allowed_values_{layer}_status", verdict("n = 0"),
            f"'{layer}.status: ' || n || ' value(s) outside {ALLOWED_TEXT}'",
            f"'{{\"bad_values\":' || n || ',\"allowed\":{ALLOWED_JSON},\"layer\":\"{layer}\","
            f"\"column\":\"status\"}}'",
        )
        + f" FROM (SELECT count(*) FILTER (status IS NULL OR status NOT IN ({ALLOWED_SQL})) AS n"
        f" FROM {source})"
    )


def references(
    child: str, column: str, parent: str, parent_column: str, layer: str, table: str,
    what: str = "order(s) with missing customer",
) -> str:
    return (
        row(
            table, 1, f"referential_integrity_{layer}", verdict("n = 0"),
            f"'{layer}: ' || n || ' {what}'",
            f"'{{\"orphan_orders\":' || n || ',\"layer\":\"{layer}\"}}'",
        )
        + f" FROM (SELECT count(*) AS n FROM {child} c WHERE NOT EXISTS (SELECT 1 FROM {parent} p"
        f" WHERE p.{parent_column} = c.{column}))"
    )


def drift(
    table: str, bronze: list[str], silver: list[str], expected: list[str], source: str,
    message: str, status: str,
) -> str:
    """The schemas are known here, so the verdict is stated and only the rows counted."""
    def listed(names: list[str]) -> str:
        return "[" + ",".join(f'"{n}"' for n in sorted(names)) + "]"

    dropped = [c for c in bronze if c not in silver]
    planned = [c for c in expected if c not in silver]
    return (
        row(
            table, 1, "schema_drift", f"'{status}'", f"'{message}'",
            f"'{{\"bronze_columns\":{listed(bronze)},\"silver_columns\":{listed(silver)},"
            f"\"dropped_columns\":{listed(dropped)},\"added_columns\":[],"
            f"\"expected_dropped\":{listed(planned)},\"rows\":' || n || '}}'",
        )
        + f" FROM (SELECT count(*) AS n FROM {source})"
    )


def stage_null(column: str, no: int, table: str | None = None) -> str:
    return (
        row(
            table, no, f"null_pct_stage_{column}", verdict("n = 0"),
            f"'stage_events.{column}: ' || n || '/' || greatest(t, 1) || ' (' || "
            f"{tenth('n', 't')} || '%)'",
            "'{}'",
        )
        + f" FROM (SELECT count(*) AS t, count(*) FILTER ({column} IS NULL OR"
        f" trim(CAST({column} AS VARCHAR)) = '') AS n FROM stage_events)"
    )


def bad_stage(no: int, stages: str, table: str | None = None) -> str:
    return (
        row(table, no, "allowed_stages", verdict("n = 0"), "'invalid stage rows: ' || n", "'{}'")
        + f" FROM (SELECT count(*) AS n FROM stage_events WHERE stage NOT IN ({stages}))"
    )


def unique_pair(no: int, table: str | None = None) -> str:
    return (
        row(
            table, no, "unique_batch_stage", verdict("n = 0"),
            "'duplicate batch+stage: ' || n", "'{}'",
        )
        + " FROM (SELECT (SELECT count(*) FROM stage_events) - (SELECT count(*) FROM"
        " (SELECT DISTINCT batch_id, stage FROM stage_events)) AS n)"
    )


def non_negative(no: int, table: str | None = None) -> str:
    return (
        row(
            table, no, "non_negative_lead_times", verdict("n = 0"),
            "'negative lead-time rows: ' || n", "'{}'",
        )
        + " FROM (SELECT (SELECT count(*) FROM stage_times WHERE stage_lead_time_days < 0)"
        " + (SELECT count(*) FROM d2d WHERE d2d_lead_time_days < 0)"
        " + (SELECT count(*) FROM e2e WHERE e2e_lead_time_days < 0) AS n)"
    )


def breach(no: int, kind: str, target: float, what: str, table: str | None = None) -> str:
    return (
        row(
            table, no, f"{kind}_target_breach", verdict("n = 0", "WARN"),
            f"n || ' {what} above {kind.upper()} target {target}d'",
            "'{\"over_target\":' || n || '}'",
        )
        + f" FROM (SELECT count(*) AS n FROM {kind} WHERE {kind}_lead_time_days > {target})"
    )


def union(*parts: str) -> str:
    return "\nUNION ALL\n".join(parts)


SHOP_CHECKS = union(
    recon("customers", "judged_customers"),
    drift(
        "customers",
        ["customer_id", "name", "email", "country", "signup_seq", "raw_source", "seq"],
        ["customer_id", "name", "email", "country", "signup_seq"],
        ["customer_id", "name", "email", "country", "signup_seq", "raw_source", "seq"],
        "bronze_customers",
        "columns dropped bronze to silver: [raw_source, seq]", "PASS",
    ).replace(",\"rows\":' || n || '}'", "}'").replace(" 1 AS check_no", " 2 AS check_no"),
    null_rate("silver_customers", "email", "silver", 0.0, 3, "customers"),
    null_rate("silver_customers", "name", "silver", 0.0, 4, "customers"),
    null_rate("silver_customers", "country", "silver", 0.0, 5, "customers"),
    unique("silver_customers", "customer_id", "silver", 6, "customers"),
    unique("silver_customers", "email", "silver", 7, "customers"),
    emails("silver_customers", "silver", 8, "customers"),
    recon("orders", "judged_orders"),
    drift(
        "orders",
        ["order_id", "customer_id", "order_date", "amount", "currency", "status",
         "ingested_at", "seq"],
        ["order_id", "customer_id", "order_date", "amount", "currency", "status"],
        ["order_id", "customer_id", "order_date", "amount", "currency", "status",
         "ingested_at", "seq"],
        "bronze_orders",
        "columns dropped bronze to silver: [ingested_at, seq]", "PASS",
    ).replace(",\"rows\":' || n || '}'", "}'").replace(" 1 AS check_no", " 2 AS check_no"),
    null_rate("silver_orders", "order_id", "silver", 0.0, 3, "orders"),
    null_rate("silver_orders", "customer_id", "silver", 0.0, 4, "orders"),
    null_rate("silver_orders", "amount", "silver", 0.0, 5, "orders"),
    null_rate("silver_orders", "status", "silver", 0.0, 6, "orders"),
    unique("silver_orders", "order_id", "silver", 7, "orders"),
    amounts("silver_orders", "amount", "silver", 8, "orders"),
    statuses("silver_orders", "silver", 9, "orders"),
    references("silver_orders", "customer_id", "silver_customers", "customer_id", "silver",
               "_cross_"),
)
SHOP_STEPS = ("judged_customers", "silver_customers", "judged_orders", "silver_orders")

RAW_CHECKS = union(
    null_rate("bronze_customers", "email", "bronze", 0.0, 1, "customers"),
    null_rate("bronze_customers", "name", "bronze", 0.0, 2, "customers"),
    null_rate("bronze_customers", "country", "bronze", 0.0, 3, "customers"),
    unique("bronze_customers", "customer_id", "bronze", 4, "customers"),
    unique("bronze_customers", "email", "bronze", 5, "customers"),
    emails("bronze_customers", "bronze", 6, "customers"),
    null_rate("bronze_orders", "order_id", "bronze", 0.0, 1, "orders"),
    null_rate("bronze_orders", "customer_id", "bronze", 0.0, 2, "orders"),
    null_rate("bronze_orders", "amount", "bronze", 0.0, 3, "orders"),
    null_rate("bronze_orders", "status", "bronze", 0.0, 4, "orders"),
    unique("bronze_orders", "order_id", "bronze", 5, "orders"),
    amounts("bronze_orders", "amount", "bronze", 6, "orders"),
    statuses("bronze_orders", "bronze", 7, "orders"),
    references("bronze_orders", "customer_id", "bronze_customers", "customer_id", "bronze",
               "_cross_"),
)
RAW_STEPS = ("bronze_customers", "bronze_orders")

LEAD_TIME_CHECKS = union(
    movement_recon(1, "lead_time"),
    stage_null("batch_id", 2, "lead_time"),
    stage_null("stage", 3, "lead_time"),
    stage_null("start_ts", 4, "lead_time"),
    stage_null("end_ts", 5, "lead_time"),
    bad_stage(6, "'signup', 'view', 'click', 'purchase'", "lead_time"),
    unique_pair(7, "lead_time"),
    non_negative(8, "lead_time"),
    breach(9, "e2e", 0.5, "batch(es)", "lead_time"),
    breach(10, "d2d", 0.25, "handoff(s)", "lead_time"),
)
LEAD_TIME_STEPS = ("judged_movements", "stage_events", "stage_times", "d2d", "e2e")

OVERALL = (
    "CASE WHEN count(*) FILTER (status = 'FAIL') OVER () > 0 THEN 'FAIL'"
    " WHEN count(*) FILTER (status = 'WARN') OVER () > 0 THEN 'WARN' ELSE 'PASS' END"
)


def results(body: str, run_id: str = RUN_1, clock: str = CLOCK_1) -> str:
    return (
        f"SELECT '{run_id}' AS run_id, table_name, check_name, status, message, metrics_json,"
        f" {OVERALL} AS overall_status, {clock} AS checked_at FROM ({body})"
    )


# Urgency and advice by check family, as the library states them.
ADVICE_ROWS = {
    "null_pct": (4, "Quarantine rows with blank required fields."),
    "unique": (3, "Deduplicate on the key before the silver write."),
    "email_format": (5, "Quarantine malformed addresses."),
    "amount_positive": (6, "Keep only amounts above zero."),
    "allowed_values": (7, "Map or quarantine values outside the allowed set."),
    "referential_integrity": (8, "Quarantine rows whose parent is missing."),
}


def _advice(field: int) -> str:
    cases = " ".join(
        f"WHEN check_name LIKE '{family}%' THEN "
        + (str(values[field]) if field == 0 else f"'{values[field]}'")
        for family, values in ADVICE_ROWS.items()
    )
    return f"CASE {cases} END"


FINDINGS = (
    f"SELECT '{RUN_1}' AS run_id, table_name, check_name, status, message,"
    f" {_advice(0)} AS urgency, {_advice(1)} AS advice"
    f" FROM ({RAW_CHECKS}) WHERE status <> 'PASS'"
)

STATUS_OF_TABLE = (
    "CASE WHEN count(*) FILTER (status = 'FAIL') > 0 THEN 'FAIL'"
    " WHEN count(*) FILTER (status = 'WARN') > 0 THEN 'WARN' ELSE 'PASS' END"
)


def mean_2(column: str) -> str:
    """Average of two-decimal values, rounded half up, from whole hundredths."""
    total = f"CAST(sum(CAST(round({column} * 100) AS BIGINT)) AS BIGINT)"
    n = f"count({column})"
    return f"CAST(sign({total}) * ((2 * abs({total}) + {n}) // (2 * {n})) / 100e0 AS DOUBLE)"


def _escaped(column: str) -> str:
    return f"replace(replace({column}, '\\', '\\\\'), '\"', '\\\"')"


SNAPSHOT = f"""
, checks AS ({RAW_CHECKS}),
per_table AS (
    SELECT table_name, {STATUS_OF_TABLE} AS table_status,
           string_agg('{{"name":"' || check_name || '","status":"' || status
               || '","message":"' || {_escaped('message')} || '","metrics":"'
               || {_escaped('metrics_json')} || '"}}', ',' ORDER BY check_no) AS checks_json
    FROM checks GROUP BY table_name),
whole AS (
    SELECT (SELECT {STATUS_OF_TABLE} FROM checks) AS overall_status,
           string_agg('{{"table":"' || table_name || '","overall_status":"' || table_status
               || '","checks":[' || checks_json || ']}}', ',' ORDER BY table_name) AS tables_json
    FROM per_table)
SELECT '{RUN_1}' AS run_id,
       '{{"overall_status":"' || overall_status || '","tables":[' || tables_json || ']}}'
           AS report_json,
       overall_status, {CLOCK_1} AS created_at
FROM whole
"""

def narrative(run_id: str, clock: str) -> str:
    return f"""
, checks AS ({RAW_CHECKS}),
lines AS (
    SELECT table_name, {_advice(0)} AS urgency,
           '- **' || status || '** `' || table_name || '.' || check_name || '`: ' || message
               || ' - ' || {_advice(1)} AS line
    FROM checks WHERE status <> 'PASS'),
tables AS (
    SELECT '- `' || table_name || '`: ' || {STATUS_OF_TABLE} AS line FROM checks
    GROUP BY table_name)
SELECT '{run_id}' AS run_id, 'offline' AS agent_mode,
       '## Summary' || chr(10) || chr(10) || 'Overall status: **'
           || (SELECT {STATUS_OF_TABLE} FROM checks) || '**' || chr(10) || chr(10)
           || '## Tables' || chr(10) || chr(10)
           || (SELECT string_agg(line, chr(10) ORDER BY line) FROM tables) || chr(10) || chr(10)
           || '## Findings' || chr(10) || chr(10)
           || coalesce((SELECT string_agg(line, chr(10) ORDER BY table_name, urgency, line)
                        FROM lines), 'None.') || chr(10) AS analysis_md,
       (SELECT {STATUS_OF_TABLE} FROM checks) AS overall_status,
       {clock} AS created_at
"""


CUSTOMER_COLUMNS = "customer_id, name, email, country, signup_seq, raw_source, seq"
ORDER_COLUMNS = (
    "order_id, customer_id, order_date, amount, currency, status, ingested_at, seq"
)
MOVEMENT_COLUMNS = (
    "doc_id, doc_year, doc_line, material, plant, batch_id, code, qty, unit, entry_ts,"
    " strftime(posting_date, '%Y-%m-%d') AS posting_date, vendor, customer, seq"
)
ALL_QUARANTINES = f"""
    SELECT 'customers' AS table_name, customer_id, CAST(NULL AS BIGINT) AS order_id,
           CAST(NULL AS BIGINT) AS doc_id, seq, reason AS rejection_reason,
           {REJECTED_AT} AS rejected_at
    FROM judged_customers WHERE reason IS NOT NULL
    UNION ALL
    SELECT 'orders', customer_id, order_id, NULL, seq, reason, {REJECTED_AT}
    FROM judged_orders WHERE reason IS NOT NULL
    UNION ALL
    SELECT 'movements', NULL, NULL, doc_id, seq, reason, {REJECTED_AT}
    FROM judged_movements WHERE reason IS NOT NULL
"""


def _summary(table: str, judged: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, count(*) AS bronze,"
        f" count(*) FILTER (reason IS NULL) AS silver,"
        f" count(*) FILTER (reason IS NOT NULL) AS quarantine FROM {judged}"
    )


ORDER_DRIFT = {
    "bronze": ["order_id", "customer_id", "order_date", "amount", "currency", "status",
               "ingested_at", "seq"],
    "silver": ["order_id", "customer_id", "order_date", "amount", "currency", "status"],
}

KPIS = f"""
        (SELECT {mean_2('e2e_lead_time_days')} FROM e2e) AS avg_e2e_days,
               (SELECT {mean_2('d2d_lead_time_days')} FROM d2d) AS avg_d2d_days,
               (SELECT '{{' || string_agg('"' || stage || '":' || CAST(avg_days AS VARCHAR), ','
                                          ORDER BY stage) || '}}'
                FROM (SELECT stage, {mean_2('stage_lead_time_days')} AS avg_days
                      FROM stage_times GROUP BY stage)) AS avg_stage_days_by_stage,
               (SELECT count(*) FROM e2e) AS batches_with_e2e,
               (SELECT count(*) FROM d2d) AS d2d_handoffs,
               4 AS stage_count_expected
"""

ORDER_DRIFT_PASSED = "columns dropped bronze to silver: [ingested_at, seq]"


def order_drift(table: str) -> str:
    both = ORDER_DRIFT["bronze"], ORDER_DRIFT["silver"], ORDER_DRIFT["bronze"]
    told = drift(table, *both, "bronze_orders", ORDER_DRIFT_PASSED, "PASS")
    return told.replace(",\"rows\":' || n || '}'", "}'").replace(" 1 AS check_no", " 2 AS check_no")


def skipped(table: str, absent: str) -> str:
    return row(
        table, 1, "referential_integrity_silver", "'PASS'",
        f"'Skipped referential checks (no {absent} table)'", "'{}'",
    )


ORACLE: dict[str, str] = {
    "dedup_first_seen": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (
                PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity,
                         l_discount, l_tax, l_returnflag, l_linestatus) AS rn
            FROM lineitem)
        WHERE rn = 1
    """.strip(),
    "code_to_stage_map": with_steps(
        "SELECT event_id, event_type, stage, stage_order"
        " FROM events LEFT JOIN stage_dim ON event_type = stage",
        "stage_dim",
    ),
    "dedup_by_arrival": """
        SELECT event_id, user_id, event_type, value FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS rn
            FROM events)
        WHERE rn = 1
    """.strip(),
    "code_to_stage_table": with_steps(
        "SELECT event_id, event_type, stage, stage_order"
        " FROM events LEFT JOIN stage_dim ON event_type = stage",
        "stage_dim",
    ),
    "silver_movements_by_codes": with_steps(
        f"SELECT {MOVEMENT_COLUMNS}, stage, event_ts FROM silver_movements", "silver_movements"
    ),
    "event_ts_fallback": with_steps(
        "SELECT doc_id, seq, coalesce(entry_ts, CAST(posting_date AS TIMESTAMP)) AS event_ts"
        " FROM bronze_movements",
        "bronze_movements",
    ),
    "silver_customers": with_steps("SELECT * FROM silver_customers", "silver_customers"),
    "quarantine_customers": with_steps(
        f"SELECT {CUSTOMER_COLUMNS}, reason AS rejection_reason, {REJECTED_AT} AS rejected_at"
        " FROM judged_customers WHERE reason IS NOT NULL",
        "judged_customers",
    ),
    "silver_orders": with_steps("SELECT * FROM silver_orders", "silver_orders"),
    "quarantine_orders": with_steps(
        f"SELECT {ORDER_COLUMNS}, reason AS rejection_reason, {REJECTED_AT} AS rejected_at"
        " FROM judged_orders WHERE reason IS NOT NULL",
        "judged_orders",
    ),
    "silver_movements": with_steps(
        f"SELECT {MOVEMENT_COLUMNS}, stage, event_ts FROM silver_movements", "silver_movements"
    ),
    "quarantine_movements": with_steps(
        f"SELECT {MOVEMENT_COLUMNS}, reason AS rejection_reason, {REJECTED_AT} AS rejected_at"
        " FROM judged_movements WHERE reason IS NOT NULL",
        "judged_movements",
    ),
    "quarantine_all_tables": with_steps(
        ALL_QUARANTINES, "judged_customers", "judged_orders", "judged_movements"
    ),
    "orphan_orders_anti": with_steps(
        f"SELECT {ORDER_COLUMNS} FROM bronze_orders o WHERE NOT EXISTS (SELECT 1"
        " FROM silver_customers c WHERE c.customer_id = o.customer_id)",
        "bronze_orders", "silver_customers",
    ),
    "valid_orders_semi": with_steps(
        f"SELECT {ORDER_COLUMNS} FROM bronze_orders o WHERE EXISTS (SELECT 1"
        " FROM silver_customers c WHERE c.customer_id = o.customer_id)",
        "bronze_orders", "silver_customers",
    ),
    "quarantine_reason_histogram": with_steps(
        f"SELECT table_name, rejection_reason, count(*) AS n FROM ({ALL_QUARANTINES})"
        " GROUP BY table_name, rejection_reason",
        "judged_customers", "judged_orders", "judged_movements",
    ),
    "layer_summary": with_steps(
        union(
            _summary("customers", "judged_customers"),
            _summary("orders", "judged_orders"),
            _summary("movements", "judged_movements"),
        ),
        "judged_customers", "judged_orders", "judged_movements",
    ),
    "recon_customers": with_steps(recon("customers", "judged_customers"), "judged_customers"),
    "recon_orders": with_steps(recon("orders", "judged_orders"), "judged_orders"),
    "recon_movements": with_steps(movement_recon(1, "movements"), "judged_movements"),
    "recon_stored_movements": with_steps(
        union(
            movement_recon(1, "sound"),
            movement_recon(1, "lost_silver", "doc_id % 7 <> 0"),
            movement_recon(1, "lost_quarantine", "true", "doc_id % 7 <> 0"),
        ),
        "judged_movements",
    ),
    "check_stored_layers": with_steps(
        union(
            damaged("sound", "true", "false"),
            damaged("lost_rows", "order_id % 7 <> 0", "false"),
            damaged("blank_reason", "true", "order_id % 2 = 0"),
            damaged("no_reason", "true", "true"),
            delta("no_quarantine", "judged_orders", 50.0, 5.0, 15.0),
            *[
                order_drift(case)
                for case in ("sound", "lost_rows", "blank_reason", "no_reason", "no_quarantine")
            ],
            skipped("no_parent", "parent"),
            skipped("no_child", "child"),
            references(
                "silver_orders", "customer_id",
                "(SELECT * FROM silver_customers WHERE customer_id % 7 <> 0)", "customer_id",
                "silver", "lost_parents",
            ),
        ),
        "judged_orders", "silver_orders", "silver_customers",
    ),
    "check_row_count_delta": with_steps(
        union(
            delta("customers", "judged_customers", 50.0, 5.0, 15.0),
            delta("orders", "judged_orders", 50.0, 5.0, 15.0),
            delta("movements", "judged_movements", 50.0, 5.0, 60.0),
        ),
        "judged_customers", "judged_orders", "judged_movements",
    ),
    "check_schema_drift": with_steps(
        union(
            drift(
                "customers",
                ["customer_id", "name", "email", "country", "signup_seq", "raw_source", "seq"],
                ["customer_id", "name", "email", "country", "signup_seq"],
                ["customer_id", "name", "email", "country", "signup_seq", "raw_source", "seq"],
                "bronze_customers",
                "columns dropped bronze to silver: [raw_source, seq]", "PASS",
            ),
            drift(
                "orders", ORDER_DRIFT["bronze"], ORDER_DRIFT["silver"],
                ["order_id", "customer_id", "amount", "channel"], "bronze_orders",
                "columns dropped bronze to silver: [ingested_at, seq]; bronze missing expected"
                " columns: [channel]; bronze unexpected columns: [currency, ingested_at,"
                " order_date, seq, status]; unexpected columns dropped: [ingested_at, seq]",
                "FAIL",
            ),
            drift(
                "orders", ORDER_DRIFT["bronze"], ORDER_DRIFT["silver"],
                ["order_id", "customer_id", "amount"], "bronze_orders",
                "columns dropped bronze to silver: [ingested_at, seq]; unexpected columns"
                " dropped: [ingested_at, seq]",
                "FAIL",
            ),
        ),
        "bronze_customers", "bronze_orders",
    ),
    "check_null_pct": with_steps(
        union(
            null_rate("bronze_customers", "email", "bronze", 5.0, 1),
            null_rate("bronze_customers", "name", "bronze", 5.0, 2),
            null_rate("bronze_customers", "country", "bronze", 0.0, 3),
            absent("null_pct_bronze_phone", "phone", "bronze", 4),
            null_rate("silver_customers", "email", "silver", 5.0, 5),
            null_rate("silver_customers", "name", "silver", 5.0, 6),
            null_rate("silver_customers", "country", "silver", 0.0, 7),
            absent("null_pct_silver_phone", "phone", "silver", 8),
        ),
        "bronze_customers", "silver_customers",
    ),
    "check_null_pct_stages": with_steps(
        union(
            stage_null("batch_id", 1), stage_null("stage", 2),
            stage_null("start_ts", 3), stage_null("end_ts", 4),
        ),
        "stage_events",
    ),
    "check_uniqueness": with_steps(
        union(
            unique("bronze_customers", "customer_id", "bronze", 1, "customers"),
            unique("bronze_customers", "email", "bronze", 2, "customers"),
            absent("unique_bronze_phone", "phone", "bronze", 3, "customers"),
            unique("documents", "doc_id", "bronze", 1, "documents"),
            unique("documents", "text", "bronze", 2, "documents"),
            unique("lineitem", "l_orderkey", "bronze", 1, "lineitem"),
        ),
        "bronze_customers",
    ),
    "check_email_format": with_steps(
        emails("bronze_customers", "bronze", 1), "bronze_customers"
    ),
    "check_amount_positive": with_steps(
        union(
            amounts("bronze_orders", "amount", "bronze", 1, "orders"),
            amounts("customer", "c_acctbal", "bronze", 1, "customer"),
        ),
        "bronze_orders",
    ),
    "check_allowed_values": with_steps(statuses("bronze_orders", "bronze", 1), "bronze_orders"),
    "check_referential_integrity": with_steps(
        union(
            references("documents", "doc_id", "labels", "doc_id", "bronze", "documents",
                       "document(s) without a label"),
            references("bronze_orders", "customer_id", "customer", "c_custkey", "bronze",
                       "orders"),
        ),
        "bronze_orders",
    ),
    "dq_metrics_single_pass": with_steps(
        f"""
        SELECT count(*) AS total_rows,
               count(*) FILTER (customer_id IS NULL) AS blank_customer_id,
               count(*) FILTER (amount IS NULL) AS blank_amount,
               count(*) FILTER (amount IS NULL OR amount <= 0) AS bad_amount,
               count(*) FILTER (status IS NULL OR status NOT IN ({ALLOWED_SQL})) AS bad_status
        FROM bronze_orders
        """,
        "bronze_orders",
    ),
    "stage_events": with_steps("SELECT * FROM stage_events", "stage_events"),
    "stages_present": with_steps(
        "SELECT batch_id, count(DISTINCT stage) AS stages_present FROM stage_events"
        " GROUP BY batch_id",
        "stage_events",
    ),
    "stage_lead_times": with_steps("SELECT * FROM stage_times", "stage_times"),
    "d2d_lead_times": with_steps("SELECT * FROM d2d", "d2d"),
    "e2e_lead_times": with_steps("SELECT * FROM e2e", "e2e"),
    "topk_handoffs": with_steps(
        "SELECT * FROM d2d ORDER BY d2d_lead_time_days DESC, batch_id, from_stage LIMIT 20",
        "d2d",
    ),
    "avg_stage_days": with_steps(
        f"SELECT stage, {mean_2('stage_lead_time_days')} AS avg_days FROM stage_times"
        " GROUP BY stage",
        "stage_times",
    ),
    "kpi_summary": with_steps(f"SELECT {KPIS}", "stage_times", "d2d", "e2e"),
    "kpis_from_snapshot": with_steps(
        f"SELECT '{RUN_1}' AS run_id, {KPIS}", "judged_movements", "stage_times", "d2d", "e2e"
    ),
    "check_allowed_stages": with_steps(
        bad_stage(1, "'signup', 'view', 'click'"), "stage_events"
    ),
    "check_unique_batch_stage": with_steps(unique_pair(1), "stage_events"),
    "check_non_negative_lead_times": with_steps(
        non_negative(1), "stage_times", "d2d", "e2e"
    ),
    "check_e2e_target": with_steps(breach(1, "e2e", 0.5, "batch(es)"), "e2e"),
    "check_d2d_target": with_steps(breach(1, "d2d", 0.25, "handoff(s)"), "d2d"),
    "dq_results_table": with_steps(results(SHOP_CHECKS), *SHOP_STEPS),
    "dq_results_lead_time": with_steps(results(LEAD_TIME_CHECKS), *LEAD_TIME_STEPS),
    "overall_status": with_steps(
        f"SELECT {STATUS_OF_TABLE} AS overall_status FROM ({RAW_CHECKS})", *RAW_STEPS
    ),
    "failed_checks_by_table": with_steps(
        f"SELECT table_name, {STATUS_OF_TABLE} AS table_status,"
        f" count(*) FILTER (status <> 'PASS') AS failed_checks"
        f" FROM ({RAW_CHECKS}) GROUP BY table_name",
        *RAW_STEPS,
    ),
    "latest_run_results": with_steps(
        f"""
        , runs AS (SELECT '{RUN_1}' AS run_id, * FROM ({RAW_CHECKS})
                   UNION ALL SELECT '{RUN_2}', * FROM ({SHOP_CHECKS}))
        SELECT run_id, table_name, check_name, status, message FROM runs
        WHERE run_id = (SELECT max(run_id) FROM runs)
        ORDER BY table_name, check_name
        """,
        *SHOP_STEPS,
    ),
    "findings_by_table": with_steps(FINDINGS, *RAW_STEPS),
    "history_table_new_columns": with_steps(
        f"""
        SELECT '{RUN_1}' AS run_id, table_name, check_name, status,
               CAST(NULL AS VARCHAR) AS message, CAST(NULL AS VARCHAR) AS metrics_json
        FROM ({RAW_CHECKS})
        UNION ALL
        SELECT '{RUN_2}', table_name, check_name, status, message, metrics_json
        FROM ({RAW_CHECKS})
        """,
        *RAW_STEPS,
    ),
    "report_snapshot_json": with_steps(SNAPSHOT, *RAW_STEPS),
    "findings_from_snapshot": with_steps(FINDINGS, *RAW_STEPS),
    "narrative_report": with_steps(narrative(RUN_1, CLOCK_1), *RAW_STEPS),
    "narrative_history_latest": with_steps(narrative(RUN_2, CLOCK_2), *RAW_STEPS),
    "history_append_latest": with_steps(
        f"SELECT '{RUN_2}' AS run_id, table_name, check_name, status, message, metrics_json"
        f" FROM ({SHOP_CHECKS})",
        *SHOP_STEPS,
    ),
    "scan_csv_escaped": "SELECT doc_id, nullif(text, '') AS text, nullif(lang, '') AS lang FROM documents",
    "layers_by_name": with_steps(
        """
        SELECT country, status, count(*) AS orders, count(DISTINCT customer_id) AS customers
        FROM silver_orders JOIN silver_customers USING (customer_id)
        GROUP BY country, status
        """,
        "silver_orders", "silver_customers",
    ),
    "scan_csv_roundtrip": with_steps(
        "SELECT customer_id, name, email, nullif(country, '') AS country, signup_seq,"
        " raw_source, seq FROM bronze_customers",
        "bronze_customers",
    ),
    "sink_overwrite_roundtrip": with_steps(
        "SELECT order_id, seq, status, amount FROM bronze_orders", "bronze_orders"
    ),
}
