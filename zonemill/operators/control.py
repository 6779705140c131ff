"""Control rows: what to load, from where, and how the last load ended."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonemill.functions.columns import col, require
from zonemill.functions.times import today_text
from zonemill.operators.merge import merge_upsert

# Identity and status columns of the control table, and the filters the
# three loads put on it. All comparisons are between strings.
STATUS_KEYS = ["PartitionKey", "RowKey"]
RUN_DATE_COLUMN = "UpdatedDate"
RESULT_COLUMN = "JobExecution"
SECRET_COLUMN = "Password"
LOAD_FILTERS = {
    "raw": {"FlagFilter": "0", "JobStatus": "1"},
    "trusted": {"JobStatus": "1"},
    "refined": {"JobStatus": "2"},
}


def work_list(control: DataFrame, zone: str | None = None, **equals: str) -> DataFrame:
    """Control rows of one load: the filters of ``zone`` and of the call, all as strings."""
    wanted = {**({"Zone": zone, **LOAD_FILTERS.get(zone, {})} if zone else {}), **equals}
    names = require(control, list(wanted), "the control table")
    tests = [col(n).cast("string") == str(v) for n, v in zip(names, wanted.values())]
    return control.filter(reduce(lambda a, b: a & b, tests)) if tests else control


def with_connection(
    work: DataFrame,
    connections: DataFrame,
    keys: Sequence[str],
    pick: str | None = None,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Work list with the connection columns of its system.

    A work row with several connections raises when the result is computed, unless
    ``pick="first"`` takes the first by ``order_by``. Passwords are never carried; keep
    the name of a secret in the table instead.
    """
    if pick not in (None, "first"):
        raise ValueError(f"pick must be None or 'first', not {pick!r}")
    if pick == "first" and not order_by:
        raise ValueError("pick='first' needs an order")
    left_keys = require(work, keys, "the work list")
    right_keys = require(connections, keys, "the connection table")
    carried = [c for c in connections.columns if c not in right_keys and c.lower() != SECRET_COLUMN.lower()]
    values = F.struct(*map(col, carried))
    # All partial aggregates: a system listed many times does not meet in one task.
    first = F.min_by(values, F.struct(*map(col, order_by))) if pick else F.first(values)
    per_key = connections.groupBy(*map(col, right_keys)).agg(first.alias("_c"), F.count(F.lit(1)).alias("_n"))
    joined = work.alias("w").join(
        per_key.alias("k"),
        reduce(lambda a, b: a & b, [col(a, "w") == col(b, "k") for a, b in zip(left_keys, right_keys)]),
        "left",
    )
    several = F.raise_error(F.lit("several connections match one work row"))
    found = col("_c", "k") if pick else F.when(col("_n", "k") > 1, several).otherwise(col("_c", "k"))
    return joined.select("w.*", *[found.getField(c).alias(c) for c in carried])


def status_rows(rows: DataFrame, ok: bool, run_date: str | None = None) -> DataFrame:
    """Status of the given control rows: run date, and 1 for success or 0 for failure."""
    date = F.lit(run_date) if run_date else today_text()
    return rows.select(
        *map(col, require(rows, STATUS_KEYS, "the control rows")),
        date.alias(RUN_DATE_COLUMN),
        F.lit(1 if ok else 0).alias(RESULT_COLUMN),
    )


def record_status(
    control: DataFrame,
    rows: DataFrame,
    ok: bool,
    run_date: str | None = None,
    advance_on_failure: bool = False,
) -> DataFrame:
    """Control table after a load of ``rows``; all columns but the status stay.

    The run date marks from when on the next window delete replaces rows, so a failed
    load leaves it as it was unless ``advance_on_failure`` is set.
    """
    columns = [RESULT_COLUMN] + ([RUN_DATE_COLUMN] if ok or advance_on_failure else [])
    return merge_upsert(control, status_rows(rows, ok, run_date), STATUS_KEYS, columns=columns, audit="none")
