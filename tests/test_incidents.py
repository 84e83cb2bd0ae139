import math

import pytest

from sparkmon.functions import sensors
from sparkmon.functions.text import guide_action
from sparkmon.operators.incidents import classify, elevated_rows, incidents, top_alerts

NORMAL = {
    "temperature_c": 62.0,
    "vibration_mm_s": 2.8,
    "spindle_load_pct": 68.0,
    "power_kw": 22.0,
    "acoustic_db": 78.0,
}


def test_report_is_grounded_and_consistent(alert, guides):
    report = incidents(alert({}), guides).collect()[0]
    assert report["source"] == report["likely_cause"].replace(" ", "_") + ".md"
    text = {r["name"]: r["text"] for r in guides.collect()}[report["source"].removesuffix(".md")]
    assert report["recommended_action"] in text.replace("\n", " ")
    assert report["severity"] == "critical" and 0 < report["retrieval_score"] <= 1


@pytest.mark.parametrize(
    "prob, expected",
    [(0.62, "watch"), (0.75, "warning"), (0.8, "warning"), (0.9, "critical"), (0.95, "critical")],
)
def test_severity_bands(alert, prob, expected):
    assert classify(alert({"anomaly_prob": prob})).collect()[0]["severity"] == expected


def test_missing_probability_counts_as_zero(alert, guides):
    report = incidents(alert({"anomaly_prob": None}), guides).collect()[0]
    assert report["anomaly_prob"] == 0.0 and report["severity"] == "watch"


def test_overheating_signature(alert, guides):
    hot = {
        "temperature_c": 110.0,
        "spindle_load_pct": 98.0,
        "power_kw": 45.0,
        "vibration_mm_s": 2.5,
        "acoustic_db": 78.0,
    }
    report = incidents(alert(hot), guides).collect()[0]
    assert report["likely_cause"] == "spindle overheat"
    assert report["source"] == "spindle_overheat.md"
    assert report["symptom"] == "temperature c +8.0σ, power kw +4.6σ, spindle load pct +2.5σ"


def test_tied_faults_take_the_first_declared(alert):
    # Temperature and vibration alone score the same for bearing wear and coolant loss.
    tied = NORMAL | {"temperature_c": 74.0, "vibration_mm_s": 4.2}
    # Power alone scores the same for spindle overheat and tool wear.
    power = NORMAL | {"power_kw": 32.0}
    rows = classify(alert(tied, power)).orderBy("event_id").collect()
    assert [r["fault"] for r in rows] == ["bearing_wear", "spindle_overheat"]


def test_tied_sensors_keep_sensor_order(alert):
    tied = NORMAL | {"acoustic_db": 86.0, "power_kw": 32.0, "temperature_c": 74.0}
    rows = elevated_rows(alert(tied)).orderBy("position").collect()
    assert [(r["sensor"], r["z"]) for r in rows] == [
        ("temperature_c", 2.0),
        ("power_kw", 2.0),
        ("acoustic_db", 2.0),
    ]


def test_elevation_uses_the_unrounded_z(alert):
    # z = 0.9983 rounds to 1.0 but is not elevated; z = 1 is.
    below, at = NORMAL | {"temperature_c": 67.99}, NORMAL | {"temperature_c": 68.0}
    rows = elevated_rows(alert(below, at)).collect()
    assert [r["event_id"] for r in rows] == ["1"]


def test_without_elevated_sensor_the_guide_is_retrieved(alert, guides):
    report = incidents(alert(NORMAL), guides).collect()[0]
    assert report["symptom"] == "multiple sensors elevated"
    assert report["likely_cause"] == report["source"].removesuffix(".md").replace("_", " ")
    assert report["retrieval_score"] == 0.0 and report["source"] == "bearing_wear.md"


def test_inconclusive_match_adopts_the_most_similar_guide(alert, guides):
    named = NORMAL | {"machine_type": "Coolant_Chiller"}
    report = incidents(alert(named), guides).collect()[0]
    assert (report["likely_cause"], report["source"]) == ("coolant loss", "coolant_loss.md")
    assert report["retrieval_score"] > 0


def test_missing_guide_falls_back_to_retrieval_but_keeps_the_cause(alert, guides):
    hot = NORMAL | {"temperature_c": 110.0, "spindle_load_pct": 98.0, "power_kw": 45.0}
    report = incidents(alert(hot), guides.filter("name != 'spindle_overheat'")).collect()[0]
    assert report["likely_cause"] == "spindle overheat"
    assert report["source"] != "spindle_overheat.md" and report["recommended_action"]


def test_every_alert_gets_one_report(alert, guides):
    frame = alert(*[{"machine_type": f"Type_{i % 7}", "power_kw": 20.0 + i} for i in range(60)])
    assert incidents(frame, guides).select("event_id").distinct().count() == 60


def test_top_n_are_the_most_probable(alert, guides):
    frame = alert(*[{"anomaly_prob": p} for p in (0.7, 0.99, None, 0.99, 0.8)])
    assert [r["event_id"] for r in top_alerts(frame, 3).collect()] == ["1", "3", "4"]
    assert incidents(frame, guides, top_n=3).count() == 3


def test_nan_and_missing_sensors_are_not_elevated(alert):
    odd = NORMAL | {"temperature_c": math.nan, "power_kw": None}
    assert elevated_rows(alert(odd)).count() == 0


def test_large_z_has_no_exponent(alert):
    row = classify(alert(NORMAL | {"power_kw": 123456789.0 * 5 + 22})).collect()[0]
    assert row["symptom"] == "power kw +123456789.0σ"


def action(spark, text):
    return spark.createDataFrame([(text,)], "text string").select(guide_action("text")).collect()[0][0]


def test_section_extraction(spark):
    text = "# T\n\n## Signs\nx\n\n## RECOMMENDED action (now)\n  Stop it.\nThen go.\t\n\n## End\ny"
    assert action(spark, text) == "Stop it. Then go."


def test_section_fallback_is_the_first_300_characters(spark):
    body = "é" * 400
    assert action(spark, f"\n  {body}  ") == "é" * 300
    assert action(spark, "short ## recommended action") == "short ## recommended action"


def test_query_text_has_one_form_per_set_of_sensors(alert):
    rows = alert(
        NORMAL | {"temperature_c": 70.0, "power_kw": 60.0},
        NORMAL | {"temperature_c": 100.0, "power_kw": 30.0},
    )
    texts = sensors.with_elevation(rows).select(sensors.query_text()).distinct().collect()
    assert [t[0] for t in texts] == ["CNC Mill temperature heat power draw"]
