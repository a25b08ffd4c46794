"""Hand-made edge rows of the activity fact; test names carry the case ids of FIXTURES.md."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from crmfunnel.plans import audits, measures, reports
from crmfunnel.plans.activity_fact import LEGACY, FactOptions, build_activity_fact
from crmfunnel.plans.dims import user_hierarchy


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


TYPES = [
    {"id": "cap", "activity_code": 23, "display_name": "Download"},
    {"id": "fb", "activity_code": 310, "display_name": "FB Form"},
    {"id": "view", "activity_code": 2, "display_name": "Page"},
    {"id": "tech", "activity_code": 393, "display_name": "Tech demo"},
    {"id": "techdone", "activity_code": 395, "display_name": "Tech demo done"},
    {"id": "junk", "activity_code": 433, "display_name": "zzz"},
    {"id": "call", "activity_code": 777, "display_name": "Priority call"},
]


class World:
    def __init__(self):
        self.rows = {"activity_type": TYPES, "user": [
            {"id": "u1", "first_name": "Ann", "last_name": None, "email": "Ann@x.example", "role": "se", "workforce_id": 1, "dm": 2},
            {"id": "u2", "first_name": "Dee", "last_name": "Em", "email": "dee@x.example", "role": "dm", "workforce_id": 2, "rsm": 3},
            {"id": "u4", "first_name": "Solo", "last_name": "Se", "email": "solo@x.example", "role": "se", "workforce_id": 4},
        ], "owner_tier": [{"email": "DEE@x.example", "tier": "A", "status": "Active"}]}

    def add(self, table, **row):
        self.rows.setdefault(table, []).append(row)

    def lead(self, id, created="2024-06-01T00:00", email=None, **more):
        self.add("leads", id=id, created_on=at(created), email_address=email or f"{id}@mail.example", **more)

    def act(self, id, lead, kind, when, source=None):
        self.add("activity_base", id=id, prospect_id=lead, type_id=kind, created_at=at(when))
        if source:
            self.add("capture_message", id=f"m{id}", activity_id=id, created_at=at(when))
            self.add("capture_metadata", lead_capture_message_id=f"m{id}", source=source, created_at=at(when))

    def sale(self, lead, day, value="100.00", email=None):
        self.add("sales", lead_email=(email or f" {lead}@MAIL.example "), sale_date=dt.datetime.fromisoformat(day),
                 sale_value=Decimal(value), sale_ind_pg="PG")

    def assign(self, id, lead, when, user, **more):
        self.add("assignment_history", id=id, prospect_id=lead, created_at=at(when), selected_user_id=user, **more)


@pytest.fixture(scope="module")
def world(tables):
    w = World()
    w.lead("t1"); w.act("t1a", "t1", "view", "2025-04-10T09:00"); w.act("t1b", "t1", "cap", "2025-04-10T10:00")
    w.sale("t1", "2025-04-20")
    w.lead("t2")
    for m in (1, 2, 3):
        w.act(f"t2{m}", "t2", "cap", f"2025-0{m}-03T09:00")
    w.sale("t2", "2025-02-15", "70.00")
    w.lead("t3"); w.act("t3a", "t3", "cap", "2025-04-10T09:00"); w.sale("t3", "2025-04-10")
    w.act("t4a", "ghost1", "cap", "2025-05-01T09:00"); w.act("t4b", "ghost2", "view", "2025-05-02T09:00")
    w.act("t4c", None, "view", "2025-05-03T09:00"); w.act("t4d", None, "view", "2025-06-03T09:00")
    w.lead("t5"); w.act("t5a", "t5", "fb", "2025-04-01T09:00"); w.act("t5b", "t5", "cap", "2025-04-02T09:00")
    w.lead("t6"); w.act("t6a", "t6", "cap", "2025-04-01T09:00", "googlexvideo")
    w.act("t6b", "t6", "cap", "2025-04-02T09:00", "google_video")
    w.lead("t7"); w.act("t7a", "t7", "view", "2025-04-01T09:00"); w.assign("t7b", "t7", "2025-04-01T10:00", "u1")
    w.lead("t10", "2025-04-05T00:00"); w.act("t10a", "t10", "cap", "2025-03-05T09:00", "linkedin")
    w.lead("t11"); w.assign("t11a", "t11", "2025-04-01T09:00", "u2", priority_score1=Decimal("60.000000"),
                            prospect_star_rank="FourStar", selected_user_rank="FourStar", assignment_type="New")
    w.assign("t11b", "t11", "2025-04-09T09:00", "u1", priority_score1=Decimal("20.000000"))
    w.assign("t11c", "t11", "2025-04-11T09:00", None)
    w.lead("t12"); w.act("t12b", "t12", "cap", "2025-04-01T09:00", "linkedin")
    w.act("t12a", "t12", "cap", "2025-04-01T09:00", "whatsapp")
    w.lead("t13a", email="shared@mail.example"); w.lead("t13b", email="shared@mail.example")
    w.act("t13x", "t13a", "cap", "2025-04-01T09:00"); w.act("t13y", "t13b", "cap", "2025-04-02T09:00")
    w.sale("", "2025-04-20", email="SHARED@mail.example")
    w.lead("t15"); w.add("lead_star", id="t15", latest_star_rank="OneStar")
    w.add("lead_star", id="t15", latest_star_rank="TwoStar")
    w.act("t15a", "t15", "cap", "2025-04-01T09:00"); w.sale("t15", "2025-04-20", "40.00")
    w.lead("t16"); w.act("t16a", "t16", "nowhere", "2025-04-01T09:00"); w.act("t16b", "t16", "junk", "2025-04-01T09:00")
    w.lead("t18"); w.act("t18a", "t18", "cap", "2025-01-31T09:00"); w.sale("t18", "2025-02-01")
    w.lead("t25"); w.add("lead_extension", prospect_id="t25", mx_student_or_working_professional="working professional")
    w.act("t25a", "t25", "view", "2025-04-01T09:00")
    w.lead("t27"); w.act("t27a", "t27", "cap", "2025-04-10T09:00"); w.sale("t27", "2025-04-05")
    w.lead("t28"); w.act("t28a", "t28", "cap", "2025-01-01T09:00", "linkedin")
    w.act("t28b", "t28", "view", "2025-02-01T09:00"); w.act("t28c", "t28", "cap", "2025-03-01T09:00", "whatsapp")
    w.lead("t29"); w.act("t29a", "t29", "cap", "2025-01-05T09:00"); w.act("t29b", "t29", "cap", "2025-02-05T09:00")
    w.sale("t29", "2025-03-05")
    w.lead("d1"); w.act("d1a", "d1", "tech", "2025-07-01T09:00"); w.assign("d1b", "d1", "2025-07-01T08:00", "u4")
    w.lead("d2"); w.act("d2a", "d2", "tech", "2025-07-02T09:00"); w.assign("d2b", "d2", "2025-07-01T08:00", "gone")
    w.lead("d3"); w.act("d3a", "d3", "techdone", "2025-07-02T09:00"); w.assign("d3b", "d3", "2025-07-01T08:00", "u1")
    return tables(**w.rows)


@pytest.fixture(scope="module")
def fact(spark, world):
    df = build_activity_fact(world)
    rows = {}
    for r in df.collect():
        rows.setdefault(r.activity_id, []).append(r)
    return rows


@pytest.fixture(scope="module")
def stored(spark, world, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("fact") / "f")
    build_activity_fact(world).write.partitionBy("activity_month_start").parquet(path)
    return spark.read.parquet(path)


def one(fact, id):
    (row,) = fact[id]
    return row


def test_shape(spark, world, fact):
    df = build_activity_fact(world)
    assert len(df.columns) == 146 and len(set(df.columns)) == 146
    assert len(build_activity_fact(world, LEGACY).columns) == 147


def test_t1_first_row_is_not_a_capture(spark, world, fact):
    assert one(fact, "t1a").sale_value is None and one(fact, "t1b").sale_value is None
    moved = build_activity_fact(world, FactOptions(sale_placement="first_capture_row"))
    values = {r.activity_id: r.sale_value for r in moved.filter("lead_id = 't1'").collect()}
    assert values == {"t1a": None, "t1b": Decimal("100.00")}


def test_t2_value_repeats_per_month(fact, stored):
    assert [one(fact, f"t2{m}").sale_value for m in (1, 2, 3)] == [Decimal("70.00")] * 3
    assert [one(fact, f"t2{m}").Is_Valid_Enroll for m in (1, 2, 3)] == [0, 1, 0]
    report = reports.funnel(stored.filter("lead_id = 't2'"), 2, 2025).first()
    assert report.Total_Sale_Value == Decimal("70.00") and report.Enrolls == 1
    per_month = audits.revenue_per_lead_month(stored.filter("lead_id = 't2'")).collect()
    assert [r.sale for r in per_month] == [Decimal("70.00")]


def test_t3_sale_on_capture_day(fact):
    r = one(fact, "t3a")
    assert (r.SameMonthEnrolls, r.Enroll_Month_Bucket_Capped, r.Is_Valid_Enroll) == ("Leads", "Leads", 1)


def test_t4_leadless_rows_share_a_month_group(fact):
    for id in ("t4a", "t4b", "t4c"):
        r = one(fact, id)
        assert r.lead_id is None and r.has_lead_capture_in_month == 1
        assert r.lead_segment == "Old - Others" and r.source_attribution_final is None
        assert r.Is_System_Activity == 0 and r.Domain_group == "Others / Unknown"
    assert one(fact, "t4d").has_lead_capture_in_month == 0


def test_t5_null_source(fact):
    assert one(fact, "t5a").Source_Bucket == "Meta" and one(fact, "t5b").Source_Bucket == "Email"


def test_t6_underscore_is_a_wildcard(fact):
    assert {one(fact, i).Source_Bucket for i in ("t6a", "t6b")} == {"Youtube"}


def test_t7_missing_last_name(spark, world, fact):
    assert one(fact, "t7a").bda_id == "u1" and one(fact, "t7a").bda_name is None
    names = {r.user_id: r.user_name for r in user_hierarchy(world["user"]).collect()}
    assert names["u1"] == "Ann"
    legacy = build_activity_fact(world, LEGACY).filter("activity_id = 't7a'").first()
    assert legacy.bda_name == "Ann " and legacy.activity_owner_name == " "


def test_t8_unassigned_labels(stored, world):
    users = user_hierarchy(world["user"])
    rows = {r.DM: r for r in reports.demos_by(stored, users, "dm", 7, 2025).collect()}
    assert set(rows) == {"", "(Unassigned)", "Dee Em"}
    assert rows["Dee Em"].Demos_Tech_Completed == 1 and rows[""].Demos_Tech_Scheduled == 1
    merged = {r.DM for r in reports.demos_by(stored, users, "dm", 7, 2025, blank_as_unassigned=True).collect()}
    assert merged == {"(Unassigned)", "Dee Em"}
    total = reports.demos_with_total(stored, users, "bda", 7, 2025).filter("is_total = 1").first()
    assert (total.BDA, total.DM, total.Demos_Tech_Scheduled, total.Demos_Tech_Completed) == ("Total", None, 2, 1)


def test_t10_capture_before_lead_was_created(fact):
    assert one(fact, "t10a").lead_segment == "Old - Others"
    assert one(fact, "t10a").source_attribution_final == "Linkedin"


def test_t11_every_assignment_row_is_flagged(fact, stored):
    assert [one(fact, i).Is_First_Assignment_Per_Month for i in ("t11a", "t11b", "t11c")] == [1, 1, 1]
    r = one(fact, "t11b")
    assert (r.assigned_bda_id, r.latest_bda_id, r.p1_star_rank_at_assign, r.latest_p1_star_rank) == (
        "u2", "u1", "FourStar", "TwoStar")
    assert (r.Is_Star_Match, r.assigned_bda_tier, r.bda_name, r.bda_dm_workforce_id) == (1, "A", "Dee Em", None)
    got = measures.evaluate(stored.filter("lead_id = 't11'"), "activity", ["Leads_Assigned_First"]).first()
    assert got["Leads_Assigned_First"] == 1


def test_t12_ties_fall_to_the_lowest_id(fact):
    assert one(fact, "t12a").first_lead_capture_source_of_month == "Whatsapp"


def test_t13_shared_address(fact):
    assert {one(fact, i).enroll_date for i in ("t13x", "t13y")} == {dt.date(2025, 4, 20)}


def test_t15_star_copies(spark, world, fact):
    copies = fact["t15a"]
    assert sorted(r.lead_star_rank for r in copies) == ["OneStar", "TwoStar"]
    assert sorted(r.sale_value is None for r in copies) == [False, True]
    guarded = build_activity_fact(world, dedupe_stars=True).filter("lead_id = 't15'").collect()
    assert [(r.lead_star_rank, r.sale_value) for r in guarded] == [("TwoStar", Decimal("40.00"))]


def test_t16_unknown_type_and_junk_are_dropped(spark, world, fact):
    assert "t16a" not in fact and "t16b" not in fact
    assert build_activity_fact(world, LEGACY).filter("activity_id = 't16b'").count() == 1


def test_t18_month_lag(fact):
    assert one(fact, "t18a").Enroll_Month_Bucket_Capped == "M+1"


def test_t25_profile_spelling(fact):
    assert (one(fact, "t25a").profile, one(fact, "t25a").Customer_Profile) == (None, "WORKING PROFESSIONAL")


def test_t27_sale_before_capture_in_month(fact):
    assert (one(fact, "t27a").Is_Valid_Enroll, one(fact, "t27a").SameMonthEnrolls) == (1, "Leads")


def test_t28_later_capture_colours_earlier_months(fact):
    assert one(fact, "t28b").source_attribution_final == "Whatsapp"
    assert one(fact, "t28a").source_attribution_final == "Linkedin"


def test_t29_several_buckets_one_lead(fact, stored):
    assert one(fact, "t29a").Enroll_Month_Bucket_Capped == "M+2"
    assert one(fact, "t29b").Enroll_Month_Bucket_Capped == "M+1"
    got = measures.evaluate(stored.filter("lead_id = 't29'"), "activity",
                            ["Enrolls_M1", "Enrolls_M2", "Cumulative_Enrolls_M3"]).first()
    assert tuple(got) == (1, 1, 1)


def test_b12_legacy_switches(spark, world):
    rows = {r.activity_id: r for r in build_activity_fact(world, LEGACY).collect()}
    assert rows["t1a"].sale_value == rows["t1b"].sale_value == Decimal("100.00")
    assert isinstance(rows["t1a"].enroll_date, dt.datetime)
    assert rows["t28b"].lead_segment == "Old – Others"
    assert rows["t11b"].p1_star_rank_at_assign == "4 Star"
    assert rows["t11a"].assignment_source == "Old Lead" and rows["t11c"].assignment_source == "Old Lead"


def test_row_count_equals_stream_after_junk(spark, world, fact):
    from crmfunnel.plans.activity_fact import classified
    from crmfunnel.plans.prep import activity_with_source
    assert classified(activity_with_source(world)).count() + 1 == sum(map(len, fact.values()))  # one star copy


@pytest.mark.parametrize("opt", [FactOptions(), FactOptions(sale_placement="first_capture_row")])
def test_sale_once_where_extension_rows_are_copied(spark, opt):
    from pyspark.sql import functions as F

    from crmfunnel.sources.surrogate import raw_tables
    raw = raw_tables(spark, "/root/testdata/sf0.001")
    copied = raw | {"activity_extension": raw["activity_extension"].unionAll(raw["activity_extension"])}

    def sales(t):
        fact = build_activity_fact(t, opt)
        return fact.filter(F.col("sale_value").isNotNull()).count(), fact.agg(F.sum("sale_value")).first()[0]

    once, twice = sales(raw), sales(copied)
    assert once[0] > 0 and twice == once


def test_fact_is_stored_in_parts_of_whole_months(spark, monkeypatch):
    from crmfunnel.plans import activity_fact as facts
    from crmfunnel.sources import session
    from crmfunnel.sources.surrogate import raw_tables
    from crmfunnel.verify import env as envs

    def shuffle_files():
        disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        files = spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(disk.getAllFiles())
        return {f.getName() for f in files if f.getName().startswith("shuffle_")}

    folder = "/root/testdata/sf0.001/."  # stored apart from what other tests use
    parts = []

    def spy(df, path, partition_by=None, *, append=False):
        write(df, path, partition_by, append=append)
        if path.endswith("/activity_fact"):
            parts.append((append, "Rebalance" in df._jdf.queryExecution().optimizedPlan().toString()))
    write = envs.write_as_is
    monkeypatch.setattr(envs, "write_as_is", spy)
    monkeypatch.setattr(facts, "PART_ROWS", 300)
    settings = {k: spark.conf.get(k, None) for k in session._WRITES}
    e = envs.Env(spark, folder)
    e.staged_leads  # noqa: B018  stores the stream and the leads
    before = shuffle_files()
    fact = e.fact
    assert len(shuffle_files() - before) < 10  # of the count of months, none of the writes
    assert len(parts) > 3 and parts == [(i > 0, False) for i in range(len(parts))]
    assert {k: spark.conf.get(k, None) for k in session._WRITES} == settings
    whole = build_activity_fact(raw_tables(spark, folder))
    stored = fact.select(*whole.columns)
    assert stored.count() == whole.count() > 1000
    assert stored.exceptAll(whole).isEmpty() and whole.exceptAll(stored).isEmpty()


def test_months_of_a_part(spark):
    from crmfunnel.plans.activity_fact import month_runs
    day = lambda m: dt.date(2024, m, 1)
    rows = spark.createDataFrame([(day(m),) for m, n in ((1, 3), (2, 3), (3, 9), (5, 1), (6, 5)) for _ in range(n)], "_month date")
    assert month_runs(rows, 6) == [(day(1), day(2)), (day(3), day(3)), (day(5), day(6))]
    assert month_runs(rows.filter("false"), 6) == []


def test_activities_are_shuffled_once_for_extension_and_messages(spark):
    from crmfunnel.plans.prep import activity_with_source
    from crmfunnel.sources.surrogate import raw_tables
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = activity_with_source(raw_tables(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    # activities and assignments meet after their joins with messages, and aren't shuffled then
    assert plan.index("Union") < plan.index("Exchange")
