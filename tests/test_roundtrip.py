"""Property: encoding rows to log contents and decoding them with the same
declared schema gives the rows back (supported types; float text and
timestamp micros round-trip exactly)."""
import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shardlake.operators.decode import decode_logs
from shardlake.operators.encode import encode_rows

SCHEMA = ("b boolean, t tinyint, i int, l bigint, d double, f float, m decimal(12,3), s string, "
          "day date, ts timestamp_ntz, bin binary")

ints = lambda lo, hi: st.one_of(st.none(), st.integers(lo, hi))
row = st.tuples(
    st.one_of(st.none(), st.booleans()),
    ints(-128, 127), ints(-2**31, 2**31 - 1), ints(-2**63, 2**63 - 1),
    st.one_of(st.none(), st.floats(allow_nan=False, width=64)),
    st.one_of(st.none(), st.floats(allow_nan=False, width=32)),
    st.one_of(st.none(), st.decimals(min_value=Decimal("-999999999.999"), max_value=Decimal("999999999.999"),
                                     places=3, allow_nan=False, allow_infinity=False)),
    st.one_of(st.none(), st.text(max_size=20)),
    st.one_of(st.none(), st.dates(min_value=dt.date(1, 1, 1), max_value=dt.date(9999, 12, 31))),
    st.one_of(st.none(), st.datetimes(min_value=dt.datetime(1000, 1, 1), max_value=dt.datetime(9999, 12, 31))),
    st.one_of(st.none(), st.text(max_size=10).map(lambda s: s.encode("utf-8"))),
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(row, min_size=1, max_size=40))
def test_encode_then_decode_is_identity(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, " + SCHEMA)
    rec = encode_rows(df, now_seconds=0)
    back = decode_logs(rec.select("contents", "time", "time_ns"), "id int, " + SCHEMA)
    got = {r["id"]: tuple(r)[1:] for r in back.collect()}
    want = {r["id"]: tuple(r)[1:] for r in df.collect()}
    assert got == want
