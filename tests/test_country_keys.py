"""A country is looked up among few keys."""
import collections

from rolefeed.functions import geo
from rolefeed.functions import values as V


def test_a_country_is_looked_up_among_few_keys(spark):
    table = geo._lookup_table()
    sizes = collections.Counter(geo._bucket(ord(k[0]), len(k)) for k in table if k)
    assert max(sizes.values()) <= len(table) // 16
    odd = ["", ".", "..", " . ", "no.where", "é", "\U0001f600", "City3", None, *V.NON_COUNTRY]
    tokens = [*table, *(f" .{k.upper()}.. " for k in table), *odd]
    found = spark.createDataFrame([(t,) for t in tokens], "t string").select("t", geo.canon("t").alias("c")).collect()

    def plain(t):
        t = (t or "").strip().lower().strip(".")
        return None if t in V.NON_COUNTRY else table.get(t or None)

    assert [r["c"] for r in found] == [plain(r["t"]) for r in found]
