"""The same results in DuckDB SQL, written independently of the operators.

Where an operator avoids a window or a self join for scale, the SQL uses the plain
form, so the two do not share a shortcut.
"""

from __future__ import annotations

from rosterline.schemas import STRIKE_STEPS

STEPS = ", ".join(STRIKE_STEPS)
MIDDLE, NOW = "TIMESTAMP '2024-01-16'", "TIMESTAMP '2024-02-10'"


def _with(body: str, **parts: str) -> str:
    listed = ",\n".join(f"{name} AS ({text})" for name, text in parts.items())
    return f"WITH {listed}\n{body}"


# ---- tables as workforce data ----

EMPLOYEES = "SELECT c_custkey AS emp_id, c_name AS name, c_acctbal AS balance FROM customer"
STRUCK = "SELECT c_custkey AS emp_id FROM customer WHERE c_acctbal < 0"
DATED = (
    "SELECT o_custkey AS emp_id, o_orderpriority AS designation, CAST(o_orderdate AS DATE) AS start_date,"
    " o_totalprice AS salary, o_orderstatus AS load FROM orders"
)
ASSIGNMENTS = (
    "SELECT l_suppkey AS emp_id, l_returnflag AS designation, CAST(l_shipdate AS DATE) AS start_date,"
    " CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) END AS end_date,"
    " l_extendedprice AS salary, l_orderkey AS order_id, l_linenumber AS line_no FROM lineitem"
)
LEAVES = (
    "SELECT user_id AS emp_id, CAST(ts AS DATE) AS date,"
    " CASE WHEN event_type = 'error' THEN 'CANCELLED'"
    " WHEN event_type IN ('click', 'view') THEN 'ACTIVE' ELSE 'PENDING' END AS status,"
    " strftime(ts, '%Y-%m-%d') AS ingest_date, ts AS ingest_timestamp, event_type FROM events"
)
LEAVE_COLUMNS = "emp_id, date, status, ingest_date, ingest_timestamp"
HOLIDAYS = (
    "SELECT CAST(ts AS DATE) AS date FROM events GROUP BY 1"
    " HAVING count(*) FILTER (event_type = 'signup') > count(*) FILTER (event_type = 'purchase') * 1.1"
)
BOOKINGS = (
    "SELECT o_custkey AS emp_id, CAST(o_orderdate AS DATE) AS date,"
    " CASE WHEN o_orderstatus = 'P' THEN 'CANCELLED' ELSE 'ACTIVE' END AS status,"
    " year(o_orderdate) AS year, month(o_orderdate) AS month FROM orders"
)
CLOSED = "SELECT CAST(o_orderdate AS DATE) AS date FROM orders GROUP BY 1 HAVING count(*) % 3 = 0"
QUOTA = (
    "SELECT c_custkey AS emp_id, c_nationkey AS leave_quota, 1998 AS year FROM customer"
    " UNION ALL SELECT c_custkey, c_nationkey + 1, 1999 FROM customer"
)
MESSAGES = (
    "SELECT conv_id, turn, CAST(conv_id AS VARCHAR) AS sender, role AS receiver, text AS message"
    " FROM conversations"
)


def _words(text: str) -> str:
    return rf"unnest(regexp_extract_all(upper({text}), '[\p{{L}}\p{{N}}_]+'))"


WORDS = {
    "marked": f"SELECT DISTINCT {_words('text')} AS word FROM benchmark",
    "vocab": f"SELECT DISTINCT {_words('text')} AS word FROM documents",
    "flagged": (
        "SELECT conv_id, turn, CAST(conv_id AS VARCHAR) AS employee_id"
        f" FROM (SELECT conv_id, turn, {_words('text')} AS word FROM conversations)"
        " GROUP BY conv_id, turn"
        " HAVING bool_or(word IN (SELECT word FROM marked))"
        " AND bool_and(word IN (SELECT word FROM vocab))"
    ),
}
FLAGS = (
    "SELECT CAST(user_id AS VARCHAR) AS employee_id, ts AS start_date FROM events WHERE event_type = 'error'"
)


PEOPLE = (
    "SELECT c_name AS name, c_nationkey + 18 AS age, c_custkey AS emp_id, c_acctbal AS balance FROM customer"
)


def _frame(loads: str) -> str:
    return (
        "SELECT CAST(o_custkey AS VARCHAR) AS emp_id, o_orderpriority AS designation,"
        " CAST(epoch(CAST(o_orderdate AS DATE)) AS DOUBLE) AS start_date, o_totalprice AS salary"
        f" FROM orders WHERE o_orderstatus IN ({loads})"
    )


# ---- timelines ----


def _largest(source: str, keys: str, order: str) -> str:
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn"
        f" FROM {source}) WHERE rn = 1"
    )


def _chain(source: str, ties: str) -> str:
    """Chained intervals with status; the columns of `source` but its end and load."""
    return (
        "SELECT emp_id, designation, start_date, end_date, salary,"
        " CASE WHEN end_date IS NULL THEN 'ACTIVE' ELSE 'INACTIVE' END AS status"
        " FROM (SELECT emp_id, designation, start_date, salary,"
        f" lead(start_date) OVER (PARTITION BY emp_id ORDER BY start_date, {ties}) AS end_date FROM {source})"
    )


def _build(name: str, loads: str, excluded: str = "struck") -> dict[str, str]:
    """CTEs that build the timeline `name` from the orders of some statuses."""
    return {
        "struck": STRUCK,
        f"{name}_rows": (
            f"SELECT * FROM ({DATED}) WHERE load IN ({loads})"
            f" AND emp_id NOT IN (SELECT emp_id FROM {excluded})"
        ),
        f"{name}_best": _largest(f"{name}_rows", "emp_id, start_date", "salary DESC, designation DESC"),
        name: _chain(f"{name}_best", "salary, designation"),
    }


FULL = _build("timeline", "'F', 'O', 'P'")
FIRST, SECOND = _build("first_load", "'F', 'O'"), _build("second_load", "'O', 'P'")
EVERYONE = {
    "nobody": "SELECT c_custkey AS emp_id FROM customer WHERE false",
    **_build("everyone", "'F', 'O', 'P'", "nobody"),
    "closed": (
        "SELECT emp_id, designation, start_date, salary,"
        " CASE WHEN status = 'ACTIVE' AND emp_id IN (SELECT emp_id FROM struck) THEN DATE '2002-01-01'"
        " ELSE end_date END AS end_date,"
        " CASE WHEN emp_id IN (SELECT emp_id FROM struck) THEN 'INACTIVE' ELSE status END AS status"
        " FROM everyone"
    ),
}
OVERLAPPING = {
    "struck": STRUCK,
    "assigned": f"SELECT * FROM ({ASSIGNMENTS}) WHERE emp_id NOT IN (SELECT emp_id FROM struck)",
    "best": _largest("assigned", "emp_id, start_date, end_date", "salary DESC, designation DESC"),
}
NEXT_OF_ASSIGNMENT = (
    "lead(start_date) OVER (PARTITION BY emp_id"
    " ORDER BY start_date, salary, designation, order_id, line_no)"
)
MERGED = {
    **FIRST,
    **SECOND,
    "fresh": (
        "SELECT * FROM second_load n WHERE NOT EXISTS (SELECT 1 FROM first_load e WHERE e.emp_id = n.emp_id"
        " AND e.start_date = n.start_date AND e.salary IS NOT DISTINCT FROM n.salary)"
    ),
    "pool": (
        "SELECT * FROM first_load WHERE emp_id IN (SELECT emp_id FROM fresh)"
        " UNION ALL SELECT * FROM fresh"
    ),
    "chained": _chain("pool", "salary, designation"),
    "rebuilt": _largest("chained", "emp_id, start_date, end_date", "salary DESC, designation DESC"),
}

# The first load with everyone, and who is struck out by the time of the second.
OPEN_FIRST = {
    "nobody": EVERYONE["nobody"],
    **MERGED,
    **_build("first_load", "'F', 'O'", "nobody"),
    "merged_rows": (
        "SELECT emp_id, designation, start_date, end_date, salary, status FROM rebuilt UNION ALL"
        " SELECT emp_id, designation, start_date, end_date, salary, status FROM first_load"
        " WHERE emp_id NOT IN (SELECT emp_id FROM fresh)"
    ),
    "closed": EVERYONE["closed"].replace("FROM everyone", "FROM merged_rows"),
}

# ---- leave ----

LEDGER = {
    **EVERYONE,
    "leaves": LEAVES,
    "holidays": HOLIDAYS,
    "records": (
        f"SELECT {LEAVE_COLUMNS} FROM leaves WHERE event_type IN ('error', 'view', 'purchase')"
        " AND isodow(date) < 6 AND date NOT IN (SELECT date FROM holidays)"
        " AND emp_id IN (SELECT emp_id FROM closed WHERE status = 'ACTIVE')"
        f" UNION ALL SELECT {LEAVE_COLUMNS} FROM leaves WHERE event_type IN ('click', 'signup')"
    ),
    "verdict": (
        "SELECT emp_id, date, CASE WHEN count(*) FILTER (status = 'CANCELLED') >="
        " count(*) FILTER (status = 'ACTIVE') THEN 'CANCELLED' ELSE 'ACTIVE' END AS final_status"
        " FROM records GROUP BY emp_id, date"
    ),
    "kept": (
        "SELECT r.* FROM records r JOIN verdict v ON r.emp_id = v.emp_id AND r.date = v.date"
        " WHERE r.status = v.final_status"
    ),
}
USAGE = {
    "bookings": BOOKINGS,
    "quota": QUOTA,
    "taken": (
        "SELECT emp_id, count(*) AS leaves_taken FROM bookings"
        " WHERE year = 1998 AND month < 7 AND status = 'ACTIVE' GROUP BY emp_id"
    ),
    "usage": (
        "SELECT t.emp_id, leaves_taken, leave_quota,"
        " round(leaves_taken / nullif(leave_quota, 0) * 100, 2) AS leave_percent"
        " FROM taken t LEFT JOIN quota q ON t.emp_id = q.emp_id AND year = 1998"
    ),
    "struck": STRUCK,
    "alerts": "SELECT * FROM usage WHERE leave_percent > 80",
    "fresh_alerts": "SELECT * FROM alerts WHERE emp_id NOT IN (SELECT emp_id FROM struck)",
}


def _spine(first: str, last: str) -> str:
    return (
        f"SELECT CAST(day AS DATE) AS date FROM generate_series({first}, {last}, INTERVAL 1 DAY)"
        " AS days(day) WHERE isodow(day) < 6"
    )


def _upcoming(last_day: str, statuses: str) -> dict[str, str]:
    return {
        "bookings": BOOKINGS,
        "closed": CLOSED,
        "days": (
            f"SELECT date FROM ({_spine("DATE '1998-03-02'", "DATE '1998-09-30'")})"
            " WHERE date NOT IN (SELECT date FROM closed)"
        ),
        "booked": (
            "SELECT emp_id, count(DISTINCT date) AS upcoming_leaves_count,"
            " count(DISTINCT date) / (SELECT count(*) FROM days) * 100 AS leave_percent FROM bookings"
            f" WHERE date IN (SELECT date FROM days) AND date {last_day} DATE '1998-09-30'"
            f" AND status IN ({statuses}) GROUP BY emp_id"
        ),
    }


# ---- strikes ----


def _price(step: int, salary: str = "salary") -> str:
    rate = f"0.{9**step:0{step}d}"
    return f"CAST(round(CAST({salary} AS DECIMAL(22,6)) * CAST({rate} AS DECIMAL({step + 1},{step})), 2) AS DOUBLE)"


def _counts(name: str, at: str, known: str) -> dict[str, str]:
    return {
        "flags": FLAGS,
        name: (
            "SELECT employee_id, count(*) AS strike_count FROM flags"
            f" WHERE start_date >= {at} - INTERVAL 30 DAYS AND {known} GROUP BY employee_id"
        ),
    }


UNSTRUCK = (
    "SELECT CAST(c_custkey AS VARCHAR) AS employee_id, c_acctbal AS salary, "
    + ", ".join(f"CAST(NULL AS DOUBLE) AS {step}" for step in STRIKE_STEPS)
    + ", 0 AS no_of_strikes FROM customer"
)


def _ladder(strikes: str, counts: str, incremental: bool = False) -> str:
    def value(i: int, step: str) -> str:
        if incremental:
            return f"CASE WHEN s.no_of_strikes >= {i} THEN s.{step} ELSE {_price(i, 's.salary')} END"
        return _price(i, "s.salary")

    steps = ", ".join(
        f"CASE WHEN c.strike_count >= {i} THEN {value(i, step)} END AS {step}"
        for i, step in enumerate(STRIKE_STEPS, 1)
    )
    return (
        f"SELECT s.employee_id, s.salary, {steps}, CAST(least(c.strike_count, 10) AS INTEGER) AS no_of_strikes"
        f" FROM {strikes} s JOIN {counts} c ON s.employee_id = c.employee_id"
    )


COUNTED = _counts("counts", NOW, "true")
MID = {
    **_counts("early_counts", MIDDLE, f"start_date < {MIDDLE}"),
    "unstruck": UNSTRUCK,
    "strikes": _ladder("unstruck", "early_counts"),
}
RAISED = {
    **MID,
    **COUNTED,
    "raised": (
        f"SELECT s.employee_id, o.salary, {STEPS}, s.no_of_strikes FROM strikes s JOIN"
        " (SELECT CAST(o_custkey AS VARCHAR) AS employee_id, max(o_totalprice) AS salary FROM orders GROUP BY 1)"
        " o ON s.employee_id = o.employee_id"
    ),
}
CHANGED = {
    **MID,
    **COUNTED,
    "relisted": _ladder("strikes", "counts"),
    "changed": "SELECT * FROM relisted EXCEPT SELECT * FROM strikes",
}
BATCH = {
    **MID,
    "touched": f"SELECT DISTINCT employee_id FROM flags WHERE start_date >= {MIDDLE}",
    "counts": (
        "SELECT employee_id, count(*) AS strike_count FROM flags"
        f" WHERE start_date >= {NOW} - INTERVAL 30 DAYS AND employee_id IN (SELECT employee_id FROM touched)"
        " GROUP BY employee_id"
    ),
    "open_strikes": "SELECT * FROM strikes WHERE no_of_strikes < 10",
    "relisted": _ladder("open_strikes", "counts"),
}
STREAMED = {
    **WORDS,
    "counts": (
        "SELECT employee_id, count(*) AS strike_count FROM flagged"
        " WHERE TIMESTAMP '2023-12-20' + to_days(CAST((conv_id * 7 + turn * 13) % 60 AS INTEGER))"
        f" >= {NOW} - INTERVAL 30 DAYS GROUP BY employee_id"
    ),
    "unstruck": UNSTRUCK,
    "relisted": _ladder("unstruck", "counts"),
}

_DAY = "CAST((conv_id * 7 + turn * 13) % 60 AS INTEGER)"
KEYED = {
    **WORDS,
    "dated": f"SELECT employee_id, turn, {_DAY} AS day, TIMESTAMP '2023-12-20' + to_days({_DAY}) AS sent_at FROM flagged",
    "early": "SELECT * FROM dated WHERE day < 45 AND turn % 3 <> 0",
    # A record that is not in the first run counts unless the clock has passed it.
    "known": (
        "SELECT * FROM early UNION ALL SELECT * FROM dated WHERE (day >= 45 OR turn % 3 = 0)"
        " AND coalesce(sent_at > (SELECT max(sent_at) FROM early) - INTERVAL 2 DAYS, true)"
    ),
    "windowed": (
        "SELECT employee_id, sent_at, count(*) OVER (PARTITION BY employee_id ORDER BY sent_at"
        " RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND CURRENT ROW) AS n FROM known"
    ),
    "counts": (
        "SELECT employee_id, CASE WHEN max(n) >= 10 THEN 10 ELSE count(*) FILTER"
        " (sent_at >= (SELECT max(sent_at) FROM dated) - INTERVAL 32 DAYS) END AS strike_count FROM windowed GROUP BY employee_id"
    ),
    "unstruck": UNSTRUCK,
    "relisted": _ladder("unstruck", "counts"),
}

SYNC = {
    **FULL,
    **MID,
    "current_pay": (
        "SELECT CAST(emp_id AS VARCHAR) AS emp, max(salary) AS pay FROM timeline"
        " WHERE status = 'ACTIVE' GROUP BY emp_id"
    ),
}

TIMELINE_COLUMNS = "emp_id, designation, start_date, end_date, salary, status"

ORACLE = {
    "clean_required": f"SELECT DISTINCT * FROM ({EMPLOYEES}) WHERE balance > 0",
    "stamp_load_date": (
        "SELECT DISTINCT *, '2024' AS year, '05' AS month, '01' AS day"
        f" FROM ({EMPLOYEES}) WHERE balance > 0"
    ),
    "clean_calendar": (
        "SELECT DISTINCT o_orderpriority AS reason, CAST(o_orderdate AS DATE) AS date,"
        " CAST(year(o_orderdate) AS INTEGER) AS year FROM orders"
    ),
    "clean_quota": (
        f"SELECT DISTINCT * FROM ({QUOTA})"
    ),
    "epoch_to_dates": "SELECT event_id, CAST(ts AS DATE) AS day FROM events",
    "dedupe_max": _with(
        "SELECT * FROM best",
        rows=f"SELECT emp_id, start_date, designation, salary FROM ({ASSIGNMENTS})",
        best=_largest("rows", "emp_id, start_date", "salary DESC, designation DESC"),
    ),
    "fill_open_end": _with(
        f"SELECT * REPLACE (coalesce(end_date, {NEXT_OF_ASSIGNMENT}) AS end_date) FROM assigned",
        assigned=ASSIGNMENTS,
    ),
    "chain_intervals": _with(
        f"SELECT * REPLACE ({NEXT_OF_ASSIGNMENT} AS end_date) FROM assigned", assigned=ASSIGNMENTS
    ),
    "interval_status": (
        "SELECT *, CASE WHEN end_date IS NULL THEN 'ACTIVE' ELSE 'INACTIVE' END AS status"
        f" FROM ({ASSIGNMENTS})"
    ),
    "exclude_ids": _with(
        "SELECT emp_id, designation, CAST(epoch(start_date) AS DOUBLE) AS start_date,"
        " CAST(NULL AS DOUBLE) AS end_date, salary FROM dated WHERE emp_id NOT IN (SELECT emp_id FROM struck)",
        dated=DATED,
        struck=STRUCK,
    ),
    "new_rows_only": _with(
        "SELECT emp_id, designation, CAST(epoch(start_date) AS DOUBLE) AS start_date,"
        " CAST(NULL AS DOUBLE) AS end_date, salary FROM dated n WHERE load IN ('O', 'P') AND NOT EXISTS"
        " (SELECT 1 FROM dated e WHERE e.load IN ('F', 'O') AND e.emp_id = n.emp_id"
        " AND e.start_date = n.start_date AND e.salary = n.salary)",
        dated=DATED,
    ),
    "timeline_silver": _with(
        "SELECT emp_id, designation, CAST(make_timestamp(start_s * 1000000) AS DATE) AS start_date,"
        " CAST(make_timestamp(end_s * 1000000) AS DATE) AS end_date, salary,"
        " CASE WHEN end_s IS NULL THEN 'ACTIVE' ELSE 'INACTIVE' END AS status"
        " FROM (SELECT emp_id, designation, salary, start_s,"
        " coalesce(end_s, lead(start_s) OVER (PARTITION BY emp_id ORDER BY start_s)) AS end_s FROM best)",
        raw=(
            "SELECT user_id AS emp_id, event_type AS designation, CAST(floor(epoch(ts)) AS BIGINT) AS start_s,"
            " CASE WHEN event_type = 'signup' THEN CAST(floor(epoch(ts)) AS BIGINT) + 604800 END AS end_s,"
            ' CAST(trunc("value") AS BIGINT) AS salary FROM events'
        ),
        best=_largest(
            "raw", "emp_id, start_s", "salary DESC NULLS LAST, designation DESC, end_s DESC NULLS LAST"
        ),
    ),
    "timeline_build": _with(f"SELECT {TIMELINE_COLUMNS} FROM timeline", **FULL),
    "timeline_build_overlapping": _with(
        "SELECT emp_id, designation, start_date, next_start AS end_date, salary,"
        " CASE WHEN next_start IS NULL THEN 'ACTIVE' ELSE 'INACTIVE' END AS status FROM ("
        "SELECT *, lead(start_date) OVER (PARTITION BY emp_id ORDER BY start_date, salary, designation,"
        " end_date NULLS FIRST) AS next_start FROM best)",
        **OVERLAPPING,
    ),
    "timeline_build_keep_ends": _with(
        "SELECT emp_id, designation, start_date, coalesce(end_date, next_start) AS end_date, salary,"
        " CASE WHEN coalesce(end_date, next_start) IS NULL THEN 'ACTIVE' ELSE 'INACTIVE' END AS status FROM ("
        "SELECT *, lead(start_date) OVER (PARTITION BY emp_id ORDER BY start_date, salary, designation,"
        " end_date NULLS FIRST) AS next_start FROM best)",
        **OVERLAPPING,
    ),
    "timeline_merge": _with(
        f"SELECT {TIMELINE_COLUMNS} FROM rebuilt UNION ALL SELECT {TIMELINE_COLUMNS} FROM first_load"
        " WHERE emp_id NOT IN (SELECT emp_id FROM fresh)",
        **MERGED,
    ),
    "deactivate_ids": _with(f"SELECT {TIMELINE_COLUMNS} FROM closed", **EVERYONE),
    "refresh_touched": _with(f"SELECT {TIMELINE_COLUMNS} FROM closed", **OPEN_FIRST),
    "timeline_inbox": _with(
        f"SELECT {TIMELINE_COLUMNS}, CAST(0 AS BIGINT) AS files_left FROM rebuilt UNION ALL"
        f" SELECT {TIMELINE_COLUMNS}, CAST(0 AS BIGINT) AS files_left FROM first_load"
        " WHERE emp_id NOT IN (SELECT emp_id FROM fresh)",
        **MERGED,
    ),
    "merge_first_non_null": _with(
        "SELECT coalesce(s.emp_id, t.emp_id) AS emp_id, coalesce(s.start_date, t.start_date) AS start_date,"
        " coalesce(s.end_date, t.end_date) AS end_date,"
        " coalesce(nullif(s.designation, '4-NOT SPECIFIED'), t.designation) AS designation,"
        " coalesce(s.salary, t.salary) AS salary, coalesce(s.status, t.status) AS status"
        " FROM second_load s FULL JOIN first_load t ON s.emp_id = t.emp_id AND s.start_date = t.start_date"
        " AND coalesce(s.end_date, DATE '9999-12-31') = coalesce(t.end_date, DATE '9999-12-31')",
        **{**FIRST, **SECOND},
    ),
    "upsert_on_key": _with(
        "SELECT * FROM updates UNION ALL SELECT * FROM target"
        " WHERE emp_id NOT IN (SELECT emp_id FROM updates)",
        target=EMPLOYEES,
        updates="SELECT s_suppkey AS emp_id, s_name AS name, s_acctbal AS balance FROM supplier",
    ),
    "update_listed": _with(
        "SELECT emp_id, designation, start_date, end_date, salary,"
        " CASE WHEN emp_id IN (SELECT s_suppkey FROM supplier) THEN 'INACTIVE' ELSE status END AS status"
        " FROM timeline",
        **FULL,
    ),
    "drop_weekends": f"SELECT {LEAVE_COLUMNS} FROM ({LEAVES}) WHERE isodow(date) < 6",
    "drop_holidays": _with(
        f"SELECT {LEAVE_COLUMNS} FROM ({LEAVES}) WHERE date NOT IN (SELECT date FROM holidays)",
        holidays=HOLIDAYS,
    ),
    "keep_active": _with(
        f"SELECT {LEAVE_COLUMNS} FROM ({LEAVES})"
        " WHERE emp_id IN (SELECT emp_id FROM closed WHERE status = 'ACTIVE')",
        **EVERYONE,
    ),
    "leave_verdict": (
        "SELECT *, CASE WHEN cancelled_count >= active_count THEN 'CANCELLED' ELSE 'ACTIVE' END AS final_status"
        " FROM (SELECT emp_id, date, count(*) FILTER (status = 'CANCELLED') AS cancelled_count,"
        f" count(*) FILTER (status = 'ACTIVE') AS active_count FROM ({LEAVES}) GROUP BY emp_id, date)"
    ),
    "latest_per_key": _with(
        f"SELECT {LEAVE_COLUMNS} FROM newest",
        leaves=LEAVES,
        newest=_largest("leaves", "emp_id, date", "ingest_timestamp DESC, status DESC"),
    ),
    "leave_ledger": _with(
        f"SELECT {LEAVE_COLUMNS}, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month"
        f" FROM ({_largest('kept', 'emp_id, date', 'ingest_timestamp DESC')})",
        **LEDGER,
    ),
    "active_by_group": _with(
        "SELECT designation, count(*) FILTER (status = 'ACTIVE') AS active_employees"
        " FROM timeline GROUP BY designation",
        **FULL,
    ),
    "quota_usage": _with("SELECT * FROM usage", **USAGE),
    "pruned_usage": _with("SELECT * FROM usage", **USAGE),
    "quota_alerts": _with("SELECT * FROM alerts", **USAGE),
    "new_alerts": _with("SELECT * FROM fresh_alerts", **USAGE),
    "alerted_union": _with("SELECT emp_id FROM struck UNION SELECT emp_id FROM fresh_alerts", **USAGE),
    "alert_text": _with(
        "SELECT emp_id, '2024-05-01' AS run_date,"
        " 'Employee ID: ' || emp_id || chr(10) || 'Leave Taken: ' || leaves_taken || chr(10)"
        " || 'Leave Quota: ' || leave_quota || chr(10) || printf('Usage: %.2f%%', leave_percent) || chr(10)"
        " || 'Report Date: 2024-05-01' || chr(10) AS alert FROM fresh_alerts",
        **USAGE,
    ),
    "working_days": (
        "SELECT date FROM ("
        + _spine(
            "(SELECT min(CAST(o_orderdate AS DATE)) FROM orders)", "(SELECT max(CAST(o_orderdate AS DATE)) FROM orders)"
        )
        + f") WHERE date NOT IN (SELECT date FROM ({CLOSED}))"
    ),
    "upcoming_leave_counts": _with("SELECT * FROM booked", **_upcoming("<=", "'ACTIVE'")),
    "upcoming_leave_alerts": _with(
        "SELECT emp_id, upcoming_leaves_count, '1998-03-02' AS run_date FROM booked WHERE leave_percent > 1.5",
        **_upcoming("<", "'ACTIVE', 'CANCELLED'"),
    ),
    "parse_messages": MESSAGES,
    "flag_messages": _with("SELECT * FROM flagged", **WORDS),
    "encode_messages": (
        "SELECT sender, CAST(json_object('sender', sender, 'receiver', receiver, 'message', message) AS VARCHAR)"
        f" AS value FROM ({MESSAGES})"
    ),
    "rolling_flag_count": _with("SELECT * FROM counts", **COUNTED),
    "trailing_flag_count": _with(
        "SELECT employee_id, start_date, count(*) OVER (PARTITION BY employee_id ORDER BY start_date"
        " RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND CURRENT ROW) AS strike_count FROM flags",
        flags=FLAGS,
    ),
    "strike_ladder_full": _with(_ladder("unstruck", "counts"), unstruck=UNSTRUCK, **COUNTED),
    "strike_ladder_incremental": _with(_ladder("raised", "counts", True), **RAISED),
    "drop_capped": _with(
        "SELECT * FROM counts WHERE employee_id NOT IN"
        " (SELECT employee_id FROM strikes WHERE no_of_strikes >= 10)",
        **{**MID, **COUNTED},
    ),
    "changed_rows": _with("SELECT * FROM changed", **CHANGED),
    "sync_salaries": _with(
        "SELECT emp AS employee_id, pay AS salary, "
        + ", ".join(
            f"CASE WHEN no_of_strikes >= {i} THEN {_price(i, 'pay')} END AS {step}"
            for i, step in enumerate(STRIKE_STEPS, 1)
        )
        + ", coalesce(no_of_strikes, 0) AS no_of_strikes FROM current_pay LEFT JOIN strikes"
        " ON emp = employee_id WHERE employee_id IS NULL OR salary IS DISTINCT FROM pay",
        **SYNC,
    ),
    "newly_capped": _with("SELECT employee_id FROM changed WHERE no_of_strikes >= 10", **CHANGED),
    "strike_updates": _with(
        "SELECT * FROM relisted EXCEPT SELECT * FROM raised",
        **RAISED,
        open_strikes="SELECT * FROM raised WHERE no_of_strikes < 10",
        relisted=_ladder("open_strikes", "counts", True),
    ),
    "strike_batch_update": _with("SELECT * FROM relisted EXCEPT SELECT * FROM open_strikes", **BATCH),
    "strike_stream": _with(
        "SELECT * FROM relisted UNION ALL SELECT * FROM unstruck"
        " WHERE employee_id NOT IN (SELECT employee_id FROM relisted)",
        **STREAMED,
    ),
    "strike_keyed_stream": _with(
        "SELECT * FROM relisted UNION ALL SELECT * FROM unstruck"
        " WHERE employee_id NOT IN (SELECT employee_id FROM relisted)",
        **KEYED,
    ),
    "load_csv_once": f"SELECT DISTINCT * FROM ({EMPLOYEES}) WHERE balance > 0",
    "quarantine_employees": (
        "SELECT CASE WHEN emp_id % 7 > 0 THEN emp_id END AS emp_id,"
        " CASE WHEN emp_id % 7 = 0 THEN 'malformed' WHEN age < 20 THEN 'under age' END AS reason,"
        " CASE WHEN emp_id % 7 = 0 THEN name || ',n/a,' || emp_id END AS record"
        f" FROM ({PEOPLE})"
    ),
    "quarantine_messages": (
        "SELECT conv_id, turn, CASE WHEN (turn + conv_id) % 11 > 2 THEN text END AS message,"
        " CASE (turn + conv_id) % 11 WHEN 0 THEN 'malformed' WHEN 1 THEN 'empty' WHEN 2 THEN 'no message' END AS reason"
        " FROM conversations"
    ),
    "csv_with_schema": f"SELECT name, age, emp_id FROM ({PEOPLE})",
    "csv_without_header": (
        "SELECT DISTINCT o_orderpriority AS reason, CAST(o_orderdate AS DATE) AS date,"
        " CAST(year(o_orderdate) AS INTEGER) AS year FROM orders"
    ),
    "csv_strings": (
        "SELECT name, CAST(age AS VARCHAR) AS age, CAST(emp_id AS VARCHAR) AS emp_id,"
        f" CAST(balance AS VARCHAR) AS balance FROM ({PEOPLE})"
    ),
    "csv_append": f"{_frame("'F', 'O'")} UNION ALL {_frame("'O', 'P'")}",
    "word_files": r"SELECT DISTINCT unnest(regexp_extract_all(text, '[\p{L}\p{N}_]+')) AS word FROM benchmark",
    "read_or_default": f"SELECT CAST(emp_id AS VARCHAR) AS employee_id FROM ({STRUCK})",
    "append_partitioned": f"SELECT CAST(emp_id AS INTEGER) AS emp_id, leave_quota, year FROM ({QUOTA})",
    "append_batches": (
        "SELECT o_custkey AS emp_id, o_orderpriority AS designation,"
        " CAST(epoch(CAST(o_orderdate AS DATE)) AS DOUBLE) AS start_date, CAST(NULL AS DOUBLE) AS end_date,"
        " o_totalprice AS salary FROM orders"
    ),
    "overwrite_dates": (
        "SELECT event_id, event_type, strftime(ts, '%Y-%m-%d') AS day FROM events"
        " WHERE day(ts) % 10 % 2 = 1 OR event_type = 'click'"
        " OR CAST(ts AS DATE) NOT IN (SELECT CAST(ts AS DATE) FROM events WHERE event_type = 'click')"
    ),
    "overwrite_table": f"SELECT * FROM ({EMPLOYEES}) WHERE balance > 0",
    "input_files": "SELECT c_custkey, c_nationkey AS nation FROM customer",
    "reload_employees": (
        f"SELECT emp_id, name, age, 2 AS load_day FROM ({PEOPLE})"
        f" UNION ALL SELECT emp_id, name, age, 1 FROM ({PEOPLE}) WHERE balance > 0"
    ),
    "reload_leaves": _with(
        "SELECT emp_id, date, status, '2024-05-01' AS ingest_date, year, month FROM"
        " (SELECT emp_id, date, CASE WHEN count(*) FILTER (status = 'CANCELLED') >="
        " count(*) FILTER (status = 'ACTIVE') THEN 'CANCELLED' ELSE 'ACTIVE' END AS status,"
        " CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month"
        " FROM bookings WHERE isodow(date) < 6 AND date NOT IN (SELECT date FROM closed) AND year(date) < 1998"
        " GROUP BY emp_id, date)",
        bookings=BOOKINGS,
        closed=CLOSED,
    ),
    "merge_headcount": _with(
        "SELECT coalesce(s.designation, t.designation) AS designation,"
        " coalesce(s.active_employees, t.active_employees) AS active_employees FROM ("
        "SELECT designation, count(*) FILTER (status = 'ACTIVE') AS active_employees FROM second_load"
        " WHERE designation <> '1-URGENT' GROUP BY designation) s FULL JOIN ("
        "SELECT designation, count(*) FILTER (status = 'ACTIVE') AS active_employees FROM first_load"
        " GROUP BY designation) t ON s.designation = t.designation",
        **{**FIRST, **SECOND},
    ),
    "empty_input": f"SELECT emp_id, name, age FROM ({PEOPLE})",
    "encoded_and_parsed": f"SELECT sender, receiver, message FROM ({MESSAGES})",
}


def oracle_sql() -> dict[str, str]:
    return ORACLE | {
        "merge_into_target": ORACLE["merge_first_non_null"],
        "reload_leave_votes": ORACLE["reload_leaves"],
    }
