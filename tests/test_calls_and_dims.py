from __future__ import annotations

import datetime as dt

import pytest

from pyspark.sql import functions as F

from crmfunnel.functions import rules
from crmfunnel.functions.dates import business_date, months_between_starts, seconds_crossed, week_of_month
from crmfunnel.operators.distinct import ratio
from crmfunnel.plans import dims, prep
from crmfunnel.plans.call_fact import build_call_fact


def at(seconds: float) -> dt.datetime:
    return dt.datetime(2025, 4, 1, 9) + dt.timedelta(seconds=seconds)


def event(call_id, body, seconds=0, kind="completed"):
    return {"call_id": call_id, "event_type": kind, "event_data": body, "created_at": at(seconds)}


@pytest.fixture(scope="module")
def calls(tables):
    ok = '{"status1":"Connected","status2":"Connected","duration":"%s"}'
    call = lambda id, s, who="p", user="u", **m: {
        "id": id, "prospect_id": who, "user_id": user, "created_at": at(s), **m}
    raw = tables(
        call=[call("a", 0), call("b", 3), call("c", 9), call("n1", 0, None), call("n2", 4, None),
              call("d1", 0, "q1"), call("d2", 0, "q2"), call("d3", 0, "q3"), call("d4", 0, "q4"), call("e", 0, "q5"),
              call("h1", 3599.5, "q6"), call("h2", 3600.5, "q6"), call("h3", 90000, "q6")],
        call_event=[event("a", '{"status1":" "}'), event("b", ok % 27), event("c", ok % 27),
                    event("d1", '{"duration":"n/a","status1":"x"}'), event("d2", '{"duration":{"s":1}}'),
                    event("d3", "{broken"), event("e", ok % 1), event("e", ok % 99, 5),
                    event("e", ok % 7, 9, "answered"), *[event(f"h{i}", ok % 5) for i in (1, 2, 3)]],
        leads=[{"id": "p", "email_address": "x@internal.example"}],
        user=[{"id": "u", "first_name": "A", "last_name": "B", "email": "A@t.example"}],
        owner_tier=[{"email": "a@T.example", "tier": "B", "status": "Active"}])
    return raw, {r.call_id: r for r in prep.call_detail(raw).collect()}


def test_t17_ghost_calls_count_as_previous(calls):
    rows = calls[1]
    assert [rows[i].Is_Valid_Call for i in "abc"] == [0, 0, 1]
    assert rows["b"].prev_call_created_at == at(0)


def test_previous_call_across_time_buckets(calls):
    rows = calls[1]
    assert rows["h2"].prev_call_created_at == at(3599.5) and rows["h2"].Is_Valid_Call == 0
    assert rows["h3"].prev_call_created_at == at(3600.5) and rows["h3"].Is_Valid_Call == 1


def test_null_prospects_are_one_group(calls):
    assert calls[1]["n2"].prev_call_created_at == at(0)


def test_t19_durations(calls):
    rows = calls[1]
    assert [rows[i].call_duration_sec for i in ("b", "d1", "d2", "d3", "d4")] == [27, None, None, None, None]
    assert rows["e"].call_duration_sec == 99  # latest completed event


def test_call_fact(calls):
    row = build_call_fact(calls[0]).filter("call_id = 'c'").first()
    assert (row.lead_id, row.Is_System_Activity, row.bda_name, row.bda_tier) == ("p", 1, "A B", "B")
    assert len(build_call_fact(calls[0]).columns) == 50


def single(spark, column, value):
    schema = {int: "int", float: "double", str: "string"}.get(type(value), "int")
    df = spark.createDataFrame([(value,)], f"v {schema}")
    return df.select(column(F.col("v"))).first()[0]


def test_p13_star_thresholds(spark):
    got = [single(spark, rules.star_from_score, v) for v in (60, 40, 20, 19, None)]
    assert got == ["FourStar", "ThreeStar", "TwoStar", "OneStar", None]


def test_p14_duration_buckets(spark):
    got = [single(spark, rules.duration_bucket, v) for v in (29, 30, 60, 61, 180, 181, None)]
    assert got == ["<30s", "30-60s", "30-60s", "60-180s", "60-180s", ">180s", None]


def test_source_rules_in_order(spark):
    rows = [("https://GROW.site.example/a", "Direct Grow"), ("yt", "Youtube"), ("IG", "Meta"), ("instagram", "Meta"),
            ("linkedin", "Linkedin"), ("google ads", "Google Ads"), ("webengage", "Email"), ("whatsapp", "Whatsapp"),
            ("google.com", "Organic"), ("site.example", "Direct"), ("flyer", "Others")]
    df = spark.createDataFrame(rows, "s string, want string")
    none = F.lit(None).cast("string")
    got = df.withColumn("got", rules.source_bucket(F.col("s"), none, none, F.lit("x"))).collect()
    assert [r.got for r in got] == [r.want for r in got]
    ig = single(spark, lambda c: rules.source_bucket(c, none, F.lit("WEBSITE_CONV_1"), none), "ig")
    res = single(spark, lambda c: rules.source_bucket(c, F.lit("Organic"), none, none), "site_resource")
    assert (ig, res) == ("Meta - Resources", "Organic Resources")
    old = single(spark, lambda c: rules.source_bucket(c, F.lit("Organic"), none, none, legacy=True), "site_resource")
    assert old == "Site-Resources"


def test_t18_boundaries(spark):
    row = spark.sql("""select timestamp_ntz'2025-01-01 00:00:00.9' a, timestamp_ntz'2025-01-01 00:00:06.1' b,
                       date'2025-01-31' c, date'2025-02-01' d""").select(
        seconds_crossed(F.col("a"), F.col("b")), months_between_starts(F.col("c"), F.col("d"))).first()
    assert tuple(row) == (6, 1)


def test_t20_zero_denominator(spark):
    row = spark.sql("select 1 a, 0 b, cast(null as int) c").select(
        ratio(F.col("a"), F.col("b")), ratio(F.col("a"), F.col("c")), ratio(F.col("c"), F.col("a"))).first()
    assert tuple(row) == (0, 0, 0)


def test_b10_calendar(spark):
    days = {r.calendar_date: r for r in dims.calendar(spark).collect()}
    assert len(days) == 1095
    assert (days[dt.date(2025, 3, 31)].cal_quarter, days[dt.date(2025, 3, 31)].cal_fy) == ("Q1", "FY2025")
    assert (days[dt.date(2025, 4, 1)].cal_quarter, days[dt.date(2025, 4, 1)].cal_fy) == ("Q2", "FY2026")


def test_b11_pointer_of_each_level_wins(tables):
    person = lambda id, role, wf, **p: {
        "id": id, "first_name": id, "last_name": "x", "role": role, "workforce_id": wf, **p}
    raw = tables(user=[person("se", "se", 1, dm=2, rsm=30, ad=40), person("dm", "dm", 2, rsm=3, ad=40),
                       person("r", "rsm", 3, ad=4), person("r2", "rsm", 30), person("a", "ad", 4),
                       person("a2", "ad", 40), person("free", "se", 9)])
    rows = {r.user_id: r for r in dims.user_hierarchy(raw["user"]).collect()}
    assert (rows["se"].dm_id, rows["se"].rsm_id, rows["se"].ad_id) == ("dm", "r", "a")
    assert (rows["dm"].dm_id, rows["dm"].rsm_id, rows["dm"].ad_id) == ("dm", "r", "a")
    assert (rows["r"].dm_id, rows["r"].dm_name, rows["r"].rsm_id, rows["r"].ad_id) == (None, "", "r", "a")
    assert (rows["free"].dm_name, rows["free"].ad_id) == ("", None)


def test_business_date_and_week(spark):
    row = spark.sql("select timestamp_ntz'2025-04-08 10:29:00' a, timestamp_ntz'2025-04-08 10:30:00' b").select(
        business_date(F.col("a")), business_date(F.col("b")), week_of_month(F.col("a"))).first()
    assert tuple(row) == (dt.date(2025, 4, 7), dt.date(2025, 4, 8), 2)


def test_event_fields_tell_texts_in_brackets_from_nested_values(spark):
    bodies = ['{"status1":"[ok]","status2":["ok"],"duration":7}', '{"status1":"{x}","status2":{"a":1}}', "{broken", None, ""]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, body string")
    got = prep.with_event_fields(df, "body").orderBy("i").collect()
    assert [(r.call_duration_sec, r.status1, r.status2) for r in got] == [
        (7, "[ok]", None), (None, "{x}", None), *[(None, None, None)] * 3]


def test_event_payload_is_parsed_once(spark):
    df = prep.with_event_fields(spark.createDataFrame([(1, '{"status1":"ok"}')], "i int, body string"), "body")
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "get_json_object" not in text and text.count("Generate json_tuple") == 1
