"""Results do not depend on the session time zone."""
import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def test_session_time_zone_does_not_change_results(spark):
    names = ["W3_board_health", "P2_conform_lever", "Q2_prune_apply"]
    base = {n: sorted(map(tuple, E.queries()[n](spark, SF).collect())) for n in names}
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        other = {n: sorted(map(tuple, E.queries()[n](spark, SF).collect())) for n in names}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert base == other
