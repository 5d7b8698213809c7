"""Raw record schema, the flattening spec and the bronze schema derived from it."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, BooleanType, DataType, DateType, DoubleType, IntegerType, LongType,
    StringType, StructField, StructType, TimestampType,
)

# --- Fixed values: field names and types of the incoming JSON record ---------
LOCATION = StructType([
    StructField("id", LongType()),
    StructField("name", StringType()),
    StructField("type", StringType()),
    StructField("feature_code", StringType()),
    StructField("admin1_name", StringType()),
    StructField("admin1_code", StringType()),
    StructField("admin2_name", StringType()),
    StructField("continent", StringType()),
    StructField("display_name", StringType()),
    StructField("country_name", StringType()),
])
COMPANY = StructType([
    StructField("id", StringType()),
    StructField("name", StringType()),
    StructField("domain", StringType()),
    StructField("url", StringType()),
    StructField("linkedin_url", StringType()),
    StructField("logo", StringType()),
    StructField("industry", StringType()),
    StructField("industry_id", IntegerType()),
    StructField("country", StringType()),
    StructField("country_code", StringType()),
    StructField("city", StringType()),
    StructField("postal_code", StringType()),
    StructField("employee_count", IntegerType()),
    StructField("employee_count_range", StringType()),
    StructField("founded_year", IntegerType()),
    StructField("annual_revenue_usd", DoubleType()),
    StructField("annual_revenue_usd_readable", StringType()),
    StructField("total_funding_usd", DoubleType()),
    StructField("funding_stage", StringType()),
    StructField("last_funding_round_date", StringType()),
    StructField("last_funding_amount", StringType()),
    StructField("is_recruiting_agency", BooleanType()),
    StructField("publicly_traded_symbol", StringType()),
    StructField("publicly_traded_exchange", StringType()),
    StructField("alexa_ranking", IntegerType()),
    StructField("num_jobs", IntegerType()),
    StructField("num_jobs_last_30_days", IntegerType()),
    StructField("num_technologies", IntegerType()),
    StructField("apollo_id", StringType()),
    StructField("linkedin_id", StringType()),
    StructField("yc_batch", StringType()),
    StructField("technology_slugs", ArrayType(StringType())),
    StructField("company_keywords", ArrayType(StringType())),
    StructField("company_tags", ArrayType(StringType())),
    StructField("possible_domains", ArrayType(StringType())),
    StructField("long_description", StringType()),
])
RECORD = StructType([
    StructField("id", LongType()),
    StructField("job_title", StringType()),
    StructField("normalized_title", StringType()),
    StructField("seniority", StringType()),
    StructField("date_posted", DateType()),
    StructField("discovered_at", TimestampType()),
    StructField("closed_at", TimestampType()),
    StructField("reposted", BooleanType()),
    StructField("date_reposted", DateType()),
    StructField("has_blurred_data", BooleanType()),
    StructField("easy_apply", BooleanType()),
    StructField("employment_statuses", ArrayType(StringType())),
    StructField("url", StringType()),
    StructField("source_url", StringType()),
    StructField("final_url", StringType()),
    StructField("location", StringType()),
    StructField("short_location", StringType()),
    StructField("long_location", StringType()),
    StructField("latitude", DoubleType()),
    StructField("longitude", DoubleType()),
    StructField("postal_code", StringType()),
    StructField("state_code", StringType()),
    StructField("country", StringType()),
    StructField("country_code", StringType()),
    StructField("country_codes", ArrayType(StringType())),
    StructField("countries", ArrayType(StringType())),
    StructField("cities", ArrayType(StringType())),
    StructField("continents", ArrayType(StringType())),
    StructField("remote", BooleanType()),
    StructField("hybrid", BooleanType()),
    StructField("locations", ArrayType(LOCATION)),
    StructField("salary_string", StringType()),
    StructField("salary_currency", StringType()),
    StructField("min_annual_salary", DoubleType()),
    StructField("max_annual_salary", DoubleType()),
    StructField("min_annual_salary_usd", DoubleType()),
    StructField("max_annual_salary_usd", DoubleType()),
    StructField("avg_annual_salary_usd", DoubleType()),
    StructField("technology_slugs", ArrayType(StringType())),
    StructField("keyword_slugs", ArrayType(StringType())),
    StructField("description", StringType()),
    StructField("company", StringType()),
    StructField("company_domain", StringType()),
    StructField("company_object", COMPANY),
])
# Output names that do not follow the prefix rule below.
RENAMED = {
    "id": "job_id",
    "company_object.annual_revenue_usd_readable": "co_annual_revenue_readable",
    "company_object.last_funding_round_date": "co_last_funding_date",
}
# --- End of fixed values ------------------------------------------------------

Spec = list[tuple[str, str, DataType]]


def as_text(kind: DataType) -> DataType:
    """The same nesting with every leaf a string, so that reading loses no value."""
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, as_text(f.dataType)) for f in kind.fields])
    return ArrayType(as_text(kind.elementType)) if isinstance(kind, ArrayType) else StringType()


def flatten_spec(record: StructType = RECORD) -> Spec:
    """``(output name, dotted path, type)`` per leaf.

    The first element of ``locations`` becomes ``loc_*`` and ``company_object``
    becomes ``co_*``; every other field keeps its name.
    """
    spec: Spec = []
    for field in record.fields:
        if field.name == "locations":
            leaves = [(f"loc_{f.name}", f"locations.0.{f.name}", f.dataType)
                      for f in field.dataType.elementType.fields]
        elif field.name == "company_object":
            leaves = [(f"co_{f.name}", f"company_object.{f.name}", f.dataType)
                      for f in field.dataType.fields]
        else:
            leaves = [(field.name, field.name, field.dataType)]
        spec += [(RENAMED.get(path, name), path, kind) for name, path, kind in leaves]
    return spec


AUDIT = [
    StructField("_raw_ingested_at", TimestampType()),
    StructField("_bronze_processed_at", TimestampType()),
    StructField("_source", StringType()),
    # Fingerprint of the whole record, the last tie-break between versions.
    StructField("_row_hash", LongType()),
]
#: Names a posting's text where rows carry a reference instead of the text itself.
TEXT_ID = "text_id"
BRONZE = StructType([StructField(n, t) for n, _, t in flatten_spec()] + AUDIT)
