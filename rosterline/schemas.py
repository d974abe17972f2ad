"""Input and state schemas."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, INT, BIGINT, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
DATE, TIMESTAMP = T.DateType(), T.TimestampType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Column names, order and types of the input files and tables.
EMPLOYEE = _struct(name=STRING, age=INT, emp_id=BIGINT)
TIMEFRAME_RAW = _struct(
    emp_id=STRING, designation=STRING, start_date=DOUBLE, end_date=DOUBLE, salary=DOUBLE
)
TIMELINE = _struct(
    emp_id=BIGINT, designation=STRING, start_date=DATE, end_date=DATE, salary=DOUBLE, status=STRING
)
LEAVE_RAW = _struct(emp_id=STRING, date=DATE, status=STRING)
LEAVE_EVENT = _struct(
    emp_id=BIGINT, date=DATE, status=STRING, ingest_date=STRING, ingest_timestamp=TIMESTAMP
)
LEAVE_LEDGER = T.StructType([*LEAVE_EVENT.fields, *_struct(year=INT, month=INT).fields])
# What a load knows of the votes for an employee and day.
_NEWEST_RECORD = _struct(ingest_timestamp=TIMESTAMP, ingest_date=STRING)
LEAVE_VOTES = _struct(
    emp_id=BIGINT,
    date=DATE,
    cancelled_count=BIGINT,
    active_count=BIGINT,
    newest_active=_NEWEST_RECORD,
    newest_cancelled=_NEWEST_RECORD,
)
CALENDAR_RAW = _struct(reason=STRING, date=TIMESTAMP)
CALENDAR = _struct(reason=STRING, date=DATE, year=INT)
QUOTA = _struct(emp_id=INT, leave_quota=INT, year=INT)
ALERTED = _struct(emp_id=BIGINT)
MESSAGE = _struct(sender=STRING, receiver=STRING, message=STRING)
FLAG = _struct(employee_id=STRING, start_date=TIMESTAMP)
STRUCK = _struct(employee_id=STRING)

# The strike ladder has ten steps, each a tenth below the last.
STRIKE_CAP = 10
STEP_RATE = "0.9"
STRIKE_STEPS = [f"strike_{i}" for i in range(1, STRIKE_CAP + 1)]
STRIKES = _struct(
    employee_id=STRING, salary=DOUBLE, **{step: DOUBLE for step in STRIKE_STEPS}, no_of_strikes=INT
)
