"""Endpoint dimensions and URL-attributed costs on small fixtures, and their use by the daily schedule."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fleetlens.operators.dimensions import EndpointDimensions, company_rows, current, endpoint_rows
from fleetlens.plans import registry
from fleetlens.plans.check import compare
from fleetlens.plans.costs import attributed, endpoint_costs
from fleetlens.plans.endpoints import bounded

registry.load_all()
OTHER_DAY = dt.date(2024, 1, 16)
NEW = ["R50c_active_displays_by_heartbeat", "R85c_daily_uptime_full", "R86b_daily_usage_full", "R87b_daily_errors_full",
       "R88b_daily_cost_full", "R89d_app_downtime_causes", "R09b_endpoint_dimensions"]


@pytest.fixture(scope="module")
def dims(spark):
    companies = spark.createDataFrame([(1, "root", "x", None), (2, "net", "edu", 1), (3, "sub", "edu", 2), (4, "two", "edu", 2),
                                       (5, "other", "y", 1)], "companyId long, name string, companyIndustry string, parentId long")
    hierarchy = spark.createDataFrame([(2, [1]), (3, [1, 2]), (4, [1, 2, 5]), (5, [1]), (6, None)], "companyId long, ancestorId array<long>")
    displays = spark.createDataFrame([(10, 3), (11, 4), (12, None), (13, 99)], "displayId long, companyId long")
    versions = spark.createDataFrame([(10, "p 1"), (14, "p 2"), (14, "p 3")], "displayId long, playerVersion string")
    licences = spark.createDataFrame([(10, "Active"), (11, "Suspended"), (15, None)], "displayId long, planSubscriptionStatus string")
    return EndpointDimensions(endpoint_rows(displays, versions, licences),
                              spark.createDataFrame([(7, 5)], "scheduleId long, scheduleCompanyId long"),
                              spark.createDataFrame([(20, "t")], "presentationId long, templateId string"),
                              company_rows(companies, hierarchy, 1))


def test_networks_are_children_of_the_root(dims):
    got = {(r["companyId"], r["parentCompanyName"], r["networkCompanyName"]) for r in dims.companies.collect()}
    assert got == {(1, None, None), (2, "root", "net"), (3, "net", "net"), (4, "net", "net"), (4, "net", "other"), (5, "root", "other")}


def test_company_by_display_or_schedule(spark, dims, tmp_path):
    rows = spark.createDataFrame([(10, "Display", 7, 20), (10, "SharedSchedule", 7, 21), (11, "Display", None, None), (12, "Display", 7, 20),
                                  (13, "Display", 7, 20), (14, "Display", 7, 20), (15, "Display", 7, 20), (None, None, 7, None),
                                  (99, "Display", 1, 1)], "endpointId long, endpointType string, scheduleId long, presentationId long")
    for d in (dims, dims.store(str(tmp_path / "dims"))):
        got = {(r["endpointId"], r["endpointType"], r["companyName"], r["networkCompanyName"], r["playerVersion"], r["licenseStatus"],
                r["templateId"]) for r in d.attach(rows, template=True).collect()}
        assert got == {
            (10, "Display", "sub", "net", "p 1", "Licensed", "t"), (10, "SharedSchedule", "other", "other", "p 1", "Licensed", None),
            (11, "Display", "two", "net", None, "Suspended", None), (11, "Display", "two", "other", None, "Suspended", None),
            (12, "Display", None, None, None, "Unlicensed", "t"), (13, "Display", None, None, None, "Unlicensed", "t"),
            (14, "Display", None, None, "p 2", "Unlicensed", "t"), (14, "Display", None, None, "p 3", "Unlicensed", "t"),
            (15, "Display", None, None, None, "Suspended", "t"), (None, None, "other", "other", None, "Unlicensed", None),
            (99, "Display", None, None, None, "Unlicensed", None)}


def test_only_a_latest_production_row_counts(spark):
    log = spark.createDataFrame([(1, 1, "live"), (1, 2, "test"), (2, 3, "live"), (2, 1, "test"), (None, 9, "live"), (3, None, "live")],
                                "k long, v long, app string")
    assert {r["k"] for r in current(log, "k", "v", F.col("app") == "live").collect()} == {2, None}


def test_definitions_are_broadcast_only_when_few(spark):
    few, many = bounded(spark.range(5), 5), bounded(spark.range(6), 5)
    hinted = lambda df: "broadcast" in df._jdf.queryExecution().logical().toString().lower()
    assert hinted(few) and not hinted(many)


VIEWER = "https%3A%2F%2Fviewer.example.com%2F%3Ftype%3D{}%26id%3D{}"


def test_every_way_to_name_an_endpoint(spark):
    u = "https://s.example.com/o?"
    rows = [
        (u + "endpointId=1&endpointType=Display&scheduleId=5#x", "", 1, {("own", "1", "Display", "5")}),
        (u + "endpointId=1&endpointType=Display", "", 2, set()),
        (u + "parent=" + VIEWER.format("display", 2) + "&y=1", None, 4, {("display", "2", "Display", "")}),
        (u, "https://x/?parent=" + VIEWER.format("display", 3), 8, {("display_referer", "3", "Display", "")}),
        (u + "viewerId=4&env=EMBED&parent=" + VIEWER.format("sharedschedule", 6), "", 16, {("schedule", "4", "Embed", "6")}),
        (u, "https://x/?viewerId=5&viewerEnv=apps_a&parent=" + VIEWER.format("sharedschedule", 7), 32, {("schedule_referer", "5", "InApp", "7")}),
        (u + "displayId=6&GoogleAccessId=a&Signature=b&Expires=1", "", 64, {("signed", "6", "Display", "")}),
        (u + "displayId=7&GoogleAccessId=a&Signature=b&Expires=1", "https://x/?parent=" + VIEWER.format("display", 7), 128,
         {("signed", "7", "Display", ""), ("display_referer", "7", "Display", "")}),
        (u + "parent=" + VIEWER.format("display", "") + "&Signature=", "%zz", 256, {("display", "", "Display", "")}),
        (None, None, 512, set()), ("", "", None, set()),
    ]
    got = attributed(spark.createDataFrame([r[:3] for r in rows], "cs_uri string, cs_referer string, sc_bytes long")).collect()
    by = {}
    for r in got:
        by.setdefault(r["sc_bytes"], set()).add((r["source"], r["endpointId"], r["endpointType"], r["scheduleId"]))
    assert by == {r[2]: r[3] for r in rows if r[3]}


def test_costs_of_all_keys_add_up(spark):
    log = spark.createDataFrame([(1, "Display", 5, "view"), (1, "Display", 5, "error"), (2, "URL", 6, "click"), (3, "Display", None, "view")],
                                "endpointId long, endpointType string, scheduleId long, event_type string")
    u = "https://s.example.com/o?"
    downloads = spark.createDataFrame([
        (u + "endpointId=1&endpointType=Display&scheduleId=5", "", 30), (u + "endpointId=9&endpointType=Display&scheduleId=5", "", 10),
        (u + "displayId=2&GoogleAccessId=a&Signature=b&Expires=1", "", 40), (u, "", 20)], "cs_uri string, cs_referer string, sc_bytes long")
    pools = spark.createDataFrame([(50.0, 7.0)], "totalDownloadCost double, totalStreamInsertCost double")
    got = {(r["endpointId"], r["endpointType"], r["scheduleId"]): (r["direct"], r["legacy"], r["indirect"])
           for r in endpoint_costs(log, downloads, pools).collect()}
    assert got == {("1", "Display", "5"): (15.0, 0.0, 3.0), ("9", "Display", "5"): (5.0, 0.0, 0.0), ("2", "URL", "6"): (0.0, 20.0, 2.0),
                   ("3", "Display", None): (0.0, 0.0, 0.0)}
    # all but the unattributed 20 bytes, and the two inserts of a key with a NULL
    assert sum(a + b for a, b, _ in got.values()) == 40.0 and sum(c for _, _, c in got.values()) == 5.0


@pytest.mark.parametrize("name", NEW)
def test_summaries_follow_the_evaluation_date(spark, duck, sf_dir, name):
    queries, oracles = registry.jobs(OTHER_DAY)
    got = compare(spark, duck, name, queries[name], oracles[name], sf_dir)
    assert got["ok"] and got["rows"], got


def test_sets_of_other_dates_are_bounded(monkeypatch):
    monkeypatch.setattr(registry, "MOST_DATES", 2)
    days = [dt.date(2024, 1, n) for n in (3, 4, 5)]
    for day in days:
        registry.jobs(day)
    assert len(registry._AT) == 2 and days[0] not in registry._AT
    assert Counter(registry.modules(days[2])["tables"].AS_OF for _ in range(3)) == {days[2]: 3}
