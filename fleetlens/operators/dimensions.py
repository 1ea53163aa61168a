"""Endpoint dimensions, composed once per run from the entity change logs.

Four small relations hold what the daily endpoint summaries attach to their rows; each is
keyed by one id, so a summary needs one join per id instead of one per attribute:

* ``endpoints``: displayId -> displayCompanyId, playerVersion, licenseStatus;
* ``schedules``: scheduleId -> scheduleCompanyId;
* ``presentations``: presentationId -> templateId;
* ``companies``: companyId -> its name and industry, its parent and its networks (one row
  for each network that it belongs to).

The company of a row depends on its endpoint type: that of the display, else that of the
schedule.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.operators.latest import latest_by
from fleetlens.operators.nested import expand_hierarchy

#: Columns that ``EndpointDimensions.attach`` adds.
ATTACHED = ["licenseStatus", "playerVersion", "companyId", "companyName", "companyIndustry", "parentCompanyId",
            "parentCompanyName", "networkCompanyId", "networkCompanyName", "networkCompanyIndustry"]


def current(log: DataFrame, key: str, version: str, production: Column | None = None) -> DataFrame:
    """The latest row per ``key`` of a change log, if that row is a production row."""
    rows = latest_by(log, key, version, ties="one")
    return rows if production is None else rows.where(production)


def license_status(plan_status: Column, suspended: str = "Suspended") -> Column:
    """Licensed or Suspended for a licensed display, Unlicensed for one without a licence row.

    A licence row whose plan has no status compares as unknown and reads Suspended, as in the views.
    """
    return F.when(plan_status != suspended, "Licensed").otherwise("Suspended")


def company_rows(companies: DataFrame, hierarchy: DataFrame, root: int | str) -> DataFrame:
    """companyId, companyName, companyIndustry, parent and network columns; one row for each network.

    ``companies``: companyId, name, companyIndustry, parentId (current rows); ``hierarchy``:
    companyId, ancestorId array (current rows).  A network is an ancestor of the company, or
    the company itself, that is a direct child of ``root``.
    """
    c = companies.select("companyId", F.col("name").alias("companyName"), "companyIndustry", "parentId")
    p = companies.select(F.col("companyId").alias("parentCompanyId"), F.col("name").alias("parentCompanyName"))
    pairs = expand_hierarchy(hierarchy, "companyId", "ancestorId").select(
        F.col("company_id").alias("networkCompanyId"), F.col("sub_company_id").alias("companyId"))
    n = companies.where(F.col("parentId") == F.lit(root)).select(
        F.col("companyId").alias("networkCompanyId"), F.col("name").alias("networkCompanyName"),
        F.col("companyIndustry").alias("networkCompanyIndustry"))
    networks = pairs.join(n, "networkCompanyId")
    return (c.join(p, F.col("parentId") == F.col("parentCompanyId"), "left").drop("parentId")
            .join(networks, "companyId", "left"))


def endpoint_rows(displays: DataFrame, versions: DataFrame, licences: DataFrame, suspended: str = "Suspended") -> DataFrame:
    """displayId, displayCompanyId, playerVersion, licenseStatus of every display that any source knows.

    ``displays``: displayId, companyId; ``versions``: displayId, playerVersion (one row for each
    version that the latest configuration names); ``licences``: displayId, planSubscriptionStatus.
    """
    d = displays.select("displayId", F.col("companyId").alias("displayCompanyId"))
    status = licences.select("displayId", license_status(F.col("planSubscriptionStatus"), suspended).alias("licenseStatus"))
    return (d.join(versions, "displayId", "full").join(status, "displayId", "full").where(F.col("displayId").isNotNull())
            .select("displayId", "displayCompanyId", "playerVersion", "licenseStatus"))


@dataclass(frozen=True)
class EndpointDimensions:
    endpoints: DataFrame
    schedules: DataFrame
    presentations: DataFrame
    companies: DataFrame

    def attach(self, rows: DataFrame, template: bool = False) -> DataFrame:
        """``rows`` (endpointId, endpointType, scheduleId; presentationId for ``template``) with ``ATTACHED``.

        Every row stays, whatever it matches; a company of several networks gives a row for each.
        """
        e = self.endpoints.withColumnRenamed("displayId", "endpointId")
        out = rows.join(e, "endpointId", "left").join(self.schedules, "scheduleId", "left")
        if template:
            out = out.join(self.presentations, "presentationId", "left")
        company = F.when(F.col("endpointType") == "Display", F.col("displayCompanyId")).otherwise(F.col("scheduleCompanyId"))
        out = (out.withColumn("companyOfRow", company).drop("displayCompanyId", "scheduleCompanyId")
               .withColumn("licenseStatus", F.coalesce("licenseStatus", F.lit("Unlicensed"))))
        return out.join(self.companies, F.col("companyOfRow") == F.col("companyId"), "left").drop("companyOfRow")

    def store(self, root: str) -> EndpointDimensions:
        """Write the relations under ``root`` and return them read from there, for the jobs of one run."""
        spark: SparkSession = self.endpoints.sparkSession
        out = {}
        for f in fields(self):
            path = f"{root.rstrip('/')}/{f.name}"
            getattr(self, f.name).write.mode("overwrite").parquet(path)
            out[f.name] = spark.read.parquet(path)
        return EndpointDimensions(**out)
