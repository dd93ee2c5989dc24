"""The reconstructed series covers all years of the calendar."""

from gridloom.queries import QUERIES
from gridloom.queries.base import YEARS
from gridloom.queries.series import _regular


def test_reconstruct_has_all_years(spark):
    got = QUERIES["op_R1_reconstruct"](spark, "/root/testdata/sf0.001").select("px", "date").collect()
    days = {d for y in YEARS for d in _regular(y)}
    assert {r["date"] for r in got} == days and len(days) == sum(len(_regular(y)) for y in YEARS)
    assert len(got) == len(set(got)) == len({r["px"] for r in got}) * len(days)
