"""Table schemas and the fixed values that belong to the data model."""

from pyspark.sql.types import (
    BooleanType,
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# Header of the raw feed -> column names used everywhere else.
RAW_COLUMNS = {
    "Complaint ID": "complaint_id",
    "Date received": "date_received",
    "Product": "product_name",
    "Sub-product": "sub_product_name",
    "Issue": "issue_name",
    "Sub-issue": "sub_issue_name",
    "Company": "company_name",
    "Company public response": "company_response",
    "State": "state",
    "ZIP code": "zip_code",
    "Submitted via": "submitted_via",
    "Date sent to company": "date_sent_to_company",
    "Consumer consent provided?": "consumer_consent",
    "Timely response?": "timely_response",
    "Consumer disputed?": "consumer_disputed",
    "Tags": "tags",
    "Consumer complaint narrative": "complaint_narrative",
}

PRODUCTS = StructType([
    StructField("product_id", IntegerType(), False),
    StructField("product_name", StringType()),
    StructField("sub_product_name", StringType()),
])

ISSUES = StructType([
    StructField("issue_id", IntegerType(), False),
    StructField("issue_name", StringType()),
    StructField("sub_issue_name", StringType()),
])

COMPANIES = StructType([
    StructField("company_id", IntegerType(), False),
    StructField("company_name", StringType(), False),
])

# complaint_id is a long: an int has room for 2^31 complaints only, and a
# feed beyond that would lose its ids to NULL without a word.
COMPLAINTS = StructType([
    StructField("complaint_id", LongType(), False),
    StructField("product_id", IntegerType()),
    StructField("issue_id", IntegerType()),
    StructField("company_id", IntegerType()),
    StructField("date_received", DateType()),
    StructField("date_sent_to_company", DateType()),
    StructField("state", StringType()),
    StructField("zip_code", StringType()),
    StructField("submitted_via", StringType()),
    StructField("consumer_consent", StringType()),
    StructField("timely_response", BooleanType()),
    StructField("consumer_disputed", BooleanType()),
    StructField("tags", StringType()),
    StructField("company_response", StringType()),
    StructField("complaint_narrative", StringType()),
])

STAR = {
    "products": PRODUCTS,
    "issues": ISSUES,
    "companies": COMPANIES,
    "complaints": COMPLAINTS,
}

# Declared column widths of the star schema (narrow variant).
LENGTH_LIMITS = {
    "products": {"product_name": 100, "sub_product_name": 150},
    "issues": {"issue_name": 200, "sub_issue_name": 250},
    "companies": {"company_name": 200},
    "complaints": {
        "state": 5,
        "zip_code": 10,
        "submitted_via": 30,
        "consumer_consent": 50,
        "tags": 50,
        "company_response": 100,
    },
}

# The wide variant declares two widths and leaves the rest open.
WIDE_LENGTH_LIMITS = {"complaints": {"state": 50, "zip_code": 20}}


def all_strings(schema: StructType) -> StructType:
    """The same columns, every one a nullable string."""
    return StructType([StructField(f.name, StringType()) for f in schema.fields])
