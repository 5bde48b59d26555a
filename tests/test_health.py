"""W3/W4 against a brute-force fold; gap sequences from FIXTURES D."""
import datetime as dt
import random

from pyspark.sql import functions as F

from rolefeed.operators import health, streaks

T0 = dt.datetime(2024, 1, 1)


def polls_df(spark, seqs, hours_per_step=7):
    rows = []
    for b, seq in seqs.items():
        for i, st in enumerate(seq):
            rows.append((b, "lever", T0 + dt.timedelta(hours=i * hours_per_step), i, st, "h" + str(hash(b) % 2)))
    return spark.createDataFrame(rows, "company_slug string, ats_source string, finished_at timestamp, seq int, status string, host string")


def fold(seq, init=0, retire_after=3):
    fail, written, stamp, retired = init, None, None, None
    for i, st in enumerate(seq):
        if st == "ok":
            fail, written, stamp = 0, 0, i
        elif st == "dead404":
            retired = i
            break
        elif st == "pfail":
            n = fail + 1
            if n >= retire_after:
                retired = i
                break
            fail, written = n, n
    return written, retired, stamp


def test_gap_sequences(spark):
    seqs = {"a": ["pfail"] * 3, "b": ["pfail", "error", "pfail", "pfail"], "c": ["pfail", "ok", "pfail", "pfail"],
            "d": ["dead404"], "e": ["ok", "pfail", "pfail", "ok", "error", "pfail"], "f": ["pfail", "pfail", "pfail", "ok"]}
    got = {r["company_slug"]: r for r in health.board_health(polls_df(spark, seqs)).collect()}
    for b, seq in seqs.items():
        written, retired, stamp = fold(seq)
        r = got[b]
        assert r["fail_count"] == written, b
        assert (r["still_active"] is False) == (retired is not None), b
        exp_stamp = None if stamp is None else T0 + dt.timedelta(hours=stamp * 7)
        assert r["last_polled_at"] == exp_stamp, b


def test_random_against_fold_and_initial_counts(spark):
    rnd = random.Random(7)
    seqs = {f"b{i}": [rnd.choice(["ok", "pfail", "pfail", "error", "dead404" if rnd.random() < 0.05 else "error"]) for _ in range(rnd.randint(1, 40))] for i in range(60)}
    init = {b: rnd.choice([None, 0, 1, 2]) for b in seqs}
    comp = spark.createDataFrame([(b, "lever", init[b], None, None) for b in seqs],
                                 "company_slug string, ats_source string, fail_count int, still_active boolean, last_polled_at timestamp")
    got = {r["company_slug"]: r for r in health.board_health(polls_df(spark, seqs, 1), comp).collect()}
    for b, seq in seqs.items():
        written, retired, _ = fold(seq, init[b] or 0)
        exp_fail = written if written is not None else init[b]
        assert got[b]["fail_count"] == exp_fail, (b, seq, init[b])
        assert (got[b]["still_active"] is False) == (retired is not None), (b, seq)


def test_host_trips_and_running_count(spark):
    seqs = {"x1": ["error"] * 5 + ["ok"] + ["pfail"] * 9 + ["ok"]}
    df = polls_df(spark, seqs, 1).withColumn("host", F.lit("api.lever.co"))
    r = health.host_trips(df, trip_after=8).collect()[0]
    assert r["tripped"] and r["tripped_at"] == T0 + dt.timedelta(hours=13) and r["polls"] == 16
    rc = streaks.running_count(df, ["host"], ["seq"], F.date_trunc("hour", "finished_at") , name="rk").orderBy("seq").collect()
    assert [x["rk"] for x in rc] == list(range(1, 17))


def test_run_summary_counts_a_board_retired_by_a_404_once(spark):
    seqs = {"gone": ["dead404", "ok"], "worn": ["pfail"] * 3, "fine": ["ok"]}
    polls = polls_df(spark, seqs, 1).withColumn("run_id", F.lit("r1")).withColumn("seen", F.lit(2)).withColumn("matched", F.lit(1))
    state = health.board_health(polls)
    (row,) = health.run_summary(polls, retired=health.retired_in(state)).collect()
    assert (row["retired"], row["dead404"], row["persistent_fail"], row["boards_matched"], row["jobs_seen"]) == (2, 1, 3, 2, 4)


def test_retirement_in_a_later_bucket_hides_what_follows(spark):
    seqs = {"b": ["ok", "pfail", "error", "pfail", "pfail", "ok", "ok"]}
    for hours in (0, 1, 30):
        r = health.board_health(polls_df(spark, seqs, hours)).first()
        assert (r["fail_count"], r["still_active"], r["polls_used"]) == (2, False, 5), hours
