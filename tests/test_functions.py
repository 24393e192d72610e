"""Column functions on tiny literal frames (cleaning, access state, features, rounding, calendar)."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from adoptlens.functions.access import access_state, status_note
from adoptlens.functions.calendar import backfill_chunks, local_date, local_hour, month_window, resolve_window
from adoptlens.functions.coerce import day_first_date, lenient_date, lenient_int
from adoptlens.functions.features import feature_class, has_any_tool, tool_array
from adoptlens.functions.numeric import pct, ratio
from adoptlens.functions.text import clean_text, compare_value, like_needle, normalize_email


def test_clean_text_strips_unicode_space_and_blanks(spark):
    df = spark.createDataFrame([("  a  ",), (" b ",), ("   ",), ("",), (None,)], "s string")
    got = [r[0] for r in df.select(clean_text("s")).collect()]
    assert got == ["a", "b", None, None, None]


def test_normalize_email(spark):
    df = spark.createDataFrame([(" User1@Example.COM ",), (" ",)], "s string")
    assert [r[0] for r in df.select(normalize_email("s")).collect()] == ["user1@example.com", None]


def test_access_state_order_and_blanks(spark):
    rows = [("Added",), (" Added ",), ("Revoked - resigned",), ("REVOKED",), ("User Resigned",),
            ("Requested",), ("",), (None,), ("added",)]
    df = spark.createDataFrame(rows, "s string")
    got = [r[0] for r in df.select(access_state("s")).collect()]
    assert got == ["granted", "granted", "revoked", "revoked", "resigned", "pending", "pending", "pending", "pending"]
    assert df.select(access_state("s", has_status_column=False)).distinct().collect()[0][0] == "granted"


def test_status_note(spark):
    df = spark.createDataFrame([(None, "pending"), (None, "revoked"), ("X", "resigned"), (None, "resigned"), (None, None)],
                               "r string, s string")
    got = [r[0] for r in df.select(status_note("r", "s")).collect()]
    assert got == ["Did not request for access", "Revoked", "X", "Resigned", "No access"]


def test_feature_class_priority(spark):
    tools = ["Assistant", "Follow-up", "Word Add-In", "Workflow Builder", "Review Table", "Workflow Review",
             "Playbook", "Thread", "Vault", " assistant follow up ", "Review"]
    df = spark.createDataFrame([(t,) for t in tools], "t string")
    got = [r[0] for r in df.select(feature_class("t")).collect()]
    assert got == ["assistant_threads", "followups", "word_addin", "workflow_runs", "review_table_columns",
                   "workflow_runs", "playbook_runs", "assistant_threads", None, "followups", "review_table_columns"]


def test_tool_array_and_membership(spark):
    df = spark.createDataFrame([("Vault, Vault",), (" , ",), ("",), (None,), ("A,Thread",)], "p string")
    arrs = [r[0] for r in df.select(tool_array("p")).collect()]
    assert arrs == [["Vault", "Vault"], [], [], [], ["A", "Thread"]]
    hits = [r[0] for r in df.select(has_any_tool("p", ["Thread", "Vault"])).collect()]
    assert hits == [True, False, False, None, True]


def test_like_needle():
    assert like_needle("  NaTion_1 ") == "nation_1"
    assert like_needle(r"a\bc\%d") == r"abc\%d"
    assert like_needle(None) == ""


def test_pct_rounds_half_away_from_zero_exactly(spark):
    pairs = [(a, b) for b in range(1, 60) for a in range(0, b + 1)] + [(3, 2000), (1, 16), (0, 0)]
    df = spark.createDataFrame(pairs, "a long, b long")
    got = df.select("a", "b", pct(F.col("a"), F.col("b")).alias("p"), ratio(F.col("a"), F.col("b")).alias("r")).collect()
    for a, b, p, r in got:
        if b == 0:
            assert p == 0.0 and r == 0.0
            continue
        exp = float((Decimal(100 * a) / Decimal(b)).quantize(Decimal("0.1"), rounding=ROUND_HALF_UP))
        exp_r = float((Decimal(a) / Decimal(b)).quantize(Decimal("0.1"), rounding=ROUND_HALF_UP))
        assert p == exp, (a, b, p, exp)
        assert r == exp_r


def test_local_calendar_boundary(spark):
    df = spark.createDataFrame([("2026-03-31 18:29:59",), ("2026-03-31 18:30:00",), ("2026-04-30 18:30:00",)], "t string")
    df = df.select(F.col("t").cast("timestamp_ntz").alias("ts"))
    got = [(r[0], r[1]) for r in df.select(local_date("ts"), local_hour("ts")).collect()]
    assert got == [(dt.date(2026, 3, 31), 23), (dt.date(2026, 4, 1), 0), (dt.date(2026, 5, 1), 0)]


def test_windows_and_backfill(spark):
    assert month_window("2026-12") == (dt.date(2026, 12, 1), dt.date(2027, 1, 1))
    assert resolve_window(day="2026-04-30") == (dt.date(2026, 4, 30), dt.date(2026, 5, 1))
    chunks = backfill_chunks(spark, "2026-01-01", "2026-06-25").orderBy("chunk_start").collect()
    assert len(chunks) == 6
    assert chunks[0]["chunk_end"] == dt.date(2026, 1, 31)
    assert chunks[-1]["chunk_end"] == dt.date(2026, 6, 25)
    assert sum(c["days"] for c in chunks) == (dt.date(2026, 6, 25) - dt.date(2026, 1, 1)).days


def test_coercion(spark):
    df = spark.createDataFrame([("3.7",), (" 12 ",), ("25/12/2025",), ("2025-12-25",), ("",), ("05/06/2025",)], "s string")
    got = df.select(lenient_int("s"), lenient_int("s", 0), lenient_date("s"), day_first_date("s")).collect()
    assert [r[0] for r in got] == [None, 12, None, None, None, None]
    assert [r[1] for r in got] == [0, 12, 0, 0, 0, 0]
    assert got[2][2] == dt.date(2025, 12, 25) and got[3][2] == dt.date(2025, 12, 25)
    assert got[5][2] == dt.date(2025, 5, 6)       # month first by default
    assert got[5][3] == dt.date(2025, 6, 5)       # day first for 'Date Added'
    num = spark.createDataFrame([(3.7,)], "x double")
    assert num.select(lenient_int("x", numeric_input=True)).collect()[0][0] == 3


def test_compare_value(spark):
    df = spark.createDataFrame([(" a ",), ("2024-01-01 00:00:00+00:00",), (None,)], "s string")
    assert [r[0] for r in df.select(compare_value("s")).collect()] == ["a", "2024-01-01 00:00:00", ""]


def test_local_month_window_boundaries(spark):
    from adoptlens.functions.calendar import window_predicate

    times = ["2026-03-31 18:29:59", "2026-03-31 18:30:00", "2026-04-30 18:29:59", "2026-04-30 18:30:00"]
    df = spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast("timestamp_ntz").alias("ts"))
    start, end = month_window("2026-04")
    inside = [str(r[0]) for r in df.filter(window_predicate("ts", start, end)).orderBy("ts").collect()]
    # local April = [2026-03-31 18:30 UTC, 2026-04-30 18:30 UTC)
    assert inside == ["2026-03-31 18:30:00", "2026-04-30 18:29:59"]


def test_search_wildcards_on_literal_frame(spark):
    from adoptlens.operators.filters import Filters

    df = spark.createDataFrame(
        [("a@x", "NATION_1"), ("b@x", "nation 1"), ("c@x", "NATION_10"), ("d@x", "other"), ("e@x", None)],
        "user_email string, location string")
    hits = lambda s: sorted(r[0] for r in Filters(search=s).apply(df, instant_col=None).collect())
    assert hits("  NaTion_1 ") == ["a@x", "b@x", "c@x"]   # '_' matches any one character
    assert hits("nation\\_1") == ["a@x", "c@x"]           # escaped: a literal underscore
    assert hits("") == ["a@x", "b@x", "c@x", "d@x", "e@x"]


def test_event_times_with_offsets_become_utc(spark):
    from adoptlens.functions.calendar import parse_utc_text

    want = {
        "2024-01-01T00:00:00+05:30": "2023-12-31 18:30:00", "2024-01-01T00:00:00-08:00": "2024-01-01 08:00:00",
        "2024-01-01T00:00:00Z": "2024-01-01 00:00:00", "2024-01-01 12:30:15.5+0530": "2024-01-01 07:00:15.5",
        "2024-01-01T00:00:00+00:00": "2024-01-01 00:00:00", "2024-01-01 10:00:00": "2024-01-01 10:00:00",
        "2024-01-01": "2024-01-01 00:00:00", "junk": None, "2024-01-01T05:00+05": "2024-01-01 00:00:00",
    }
    df = spark.createDataFrame([(k,) for k in want], "t string")
    got = {r.t: r.u for r in df.select("t", parse_utc_text("t").cast("string").alias("u")).collect()}
    assert got == want


def test_dates_with_times_single_digits_and_month_names(spark):
    from adoptlens.functions.coerce import day_first_date, lenient_date

    want = {
        "2025-12-25 00:00:00": ("2025-12-25", "2025-12-25"), "2025-12-25T08:00:00": ("2025-12-25", "2025-12-25"),
        "1/5/2025": ("2025-01-05", "2025-05-01"), "25/12/2025": ("2025-12-25", "2025-12-25"),
        "5 Jan 2025": ("2025-01-05", "2025-01-05"), "January 5, 2025": ("2025-01-05", "2025-01-05"),
        "12/25/2025 9:30 PM": ("2025-12-25", None), "3.7": (None, None), "": (None, None),
    }
    df = spark.createDataFrame([(k,) for k in want], "t string")
    rows = df.select("t", lenient_date("t").cast("string").alias("a"), day_first_date("t").cast("string").alias("b")).collect()
    assert {r.t: (r.a, r.b) for r in rows} == want


def test_cluster_sessions_must_name_the_checkpoint_folder():
    from types import SimpleNamespace

    import pytest

    from adoptlens.session import checkpoint_dir

    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://head:7077")
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=context)
    with pytest.raises(ValueError):
        checkpoint_dir(session)
