"""Classification rules: first-match order, defaults, totality."""

from hypothesis import given, settings
from hypothesis import strategies as st

from metroflow.functions import classify as C

ROWS = [
    # severity, header, description -> dashboard rule, page rule
    ("SEVERE", "x", "y", "SEVERE", "SEVERE"),
    (None, "Delays and suspended", "", "MODERATE", "MODERATE"),
    ("UNKNOWN", "Delays and suspended", "", "SEVERE", "MODERATE"),
    ("UNKNOWN", "Station closed", "", "SEVERE", "LOW"),
    ("UNKNOWN", "Notice", "trains run slow", "MODERATE", "LOW"),
    ("UNKNOWN", "Notice", "", "LOW", "LOW"),
    ("severe", "Notice", "", "LOW", "severe"),
    ("", "Emergency", "", "MODERATE", "SEVERE"),
]


def test_severity_rules(spark):
    df = spark.createDataFrame([r[:3] for r in ROWS], "s string, h string, d string")
    got = df.select(C.severity("s", "h", "d").alias("a"), C.severity_page("s", "h").alias("b")).collect()
    assert [(g["a"], g["b"]) for g in got] == [(r[3], r[4]) for r in ROWS]


def test_type_and_effect(spark):
    rows = [("N/A", "Trains skip stops"), (None, "Local trains run express"), ("", "Detour for riders"),
            ("Cause", "Delays"), ("N/A", "Track maintenance"), ("N/A", "Reduced service"),
            ("N/A", "Service suspended")]
    df = spark.createDataFrame(rows, "k string, h string")
    got = [tuple(r) for r in df.select(C.alert_type("k", "h"), C.alert_effect("k", "h")).collect()]
    assert got == [("Service Change", "Skip-Stop"), ("Service Change", "Local to Express"),
                   ("Detour", "Modified Service"), ("Cause", "Cause"), ("Planned Work", "Modified Service"),
                   ("Service Change", "Reduced Service"), ("Suspension", "Suspended")]


def test_status_and_vehicle_text(spark):
    df = spark.createDataFrame([(0, 0, 0, "R1"), (0, 2, 1, "R2"), (1, 3, 2, None), (None, None, 7, "R4")],
                               "sev int, n int, st int, stop string")
    got = [tuple(r) for r in df.select(C.route_status("sev", "n"), C.vehicle_status_text("st", "stop")).collect()]
    assert got == [("good", "Incoming at R1"), ("caution", "Stopped at R2"), ("delay", "In transit to"),
                   ("good", "Unknown R4")]


def test_cut_description(spark):
    df = spark.createDataFrame([("a" * 121,), ("a" * 120,), ("",), (None,)], "d string")
    got = [r[0] for r in df.select(C.cut_description("d")).collect()]
    assert got == ["a" * 120 + "...", "a" * 120, C.DEFAULT_DESCRIPTION, C.DEFAULT_DESCRIPTION]


text = st.one_of(st.none(), st.text(alphabet="adeilmnopsuwy CDELOSUVW", max_size=30))


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(["SEVERE", "LOW", "UNKNOWN", "", "x"])), text, text),
                min_size=1, max_size=20))
def test_classification_is_total(spark, rows):
    df = spark.createDataFrame(rows, "s string, h string, d string")
    out = df.select(C.severity("s", "h", "d").alias("a"), C.severity_page("s", "h").alias("b"),
                    C.alert_type("s", "h").alias("t"), C.alert_effect("s", "h").alias("e")).collect()
    for r in out:
        assert r["a"] in ("SEVERE", "MODERATE", "LOW")
        assert r["t"] is not None and r["e"] is not None
