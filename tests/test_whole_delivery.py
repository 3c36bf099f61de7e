"""The end-to-end job over deliveries with junk: no row that counts is left out."""

from pyspark.sql import functions as F

from tests.oracle_check import connect
from workloads import queries

FOLDER = "/root/testdata/sf0.001"

#: Trips that end after they start, in the window, with a readable fare, a distance and a borough.
COUNTED = """SELECT count(*), count(*) FILTER (l_orderkey % 47 = 0), count(*) FILTER (s_nationkey = 24)
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey
    WHERE o_orderdate <> l_shipdate AND c_nationkey <> 24
      AND l_orderkey % 41 <> 0 AND l_orderkey % 53 <> 0 AND l_orderkey % 59 <> 0 AND l_orderkey % 61 <> 0
      AND least(o_orderdate, l_shipdate) >= DATE '1995-01-01' AND least(o_orderdate, l_shipdate) < DATE '2002-01-01'"""


def test_trips_of_unknown_vendors_and_to_unknown_zones_count(spark):
    trips, unknown_vendor, unknown_zone = connect(FOLDER).execute(COUNTED).fetchone()
    assert unknown_vendor and unknown_zone
    mart = queries.QUERIES["trips_end_to_end"](spark, FOLDER)
    assert mart.agg(F.sum("total_trips")).first()[0] == trips


def test_mended_deliveries_keep_every_row(spark):
    raw = queries._delivered(spark, FOLDER)
    assert queries._mended(raw).count() == raw.count() == connect(FOLDER).execute("SELECT count(*) FROM lineitem").fetchone()[0]
