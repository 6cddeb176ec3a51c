"""The order-dependent queries once more, over tables cut into at least 16 runs on two levels, whatever their size."""

from functools import partial

from ticktalk.catalog import order_queries, profile_queries  # noqa: F401
from ticktalk.catalog.registry import ORACLES, QUERIES, query, table
from ticktalk.operators import picks

CUT = {"least_runs": 16, "fan": 4}
NAMES = (
    "asof_nearest", "asof_backward_by_user", "asof_forward_by_user", "gap_change", "rolling_prev4", "forward_fill",
    "forward_fill_by_user", "drop_consecutive", "describe_value", "describe_change", "value_spread_by_type", "change_spread_by_date",
)


def _in_runs(name):
    function = partial(QUERIES[name].__wrapped__, **CUT)
    function.__name__ = f"{name}_in_runs"
    query(ORACLES[name])(function)


for _name in NAMES:
    _in_runs(_name)


@query("SELECT event_id, ts, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 300")
def newest_rows_in_runs(spark, d):
    return picks.newest_rows(table(spark, d, "events").select("event_id", "ts", "value"), 300, ["ts", "event_id"], plain_top=1, **CUT)
