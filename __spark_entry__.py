"""Registered queries: the flagship, every operator, and their SQL twins."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle_queries  # noqa: E402
from redress import functions as fn  # noqa: E402
from redress.operators import aggregates, audits, joins, names, relational, windows  # noqa: E402
from redress.plans import kpis, layers, silver, star  # noqa: E402
from redress.plans.feed import feed  # noqa: E402
from redress.schema import (  # noqa: E402
    COMPANIES,
    COMPLAINTS,
    LENGTH_LIMITS,
    RAW_COLUMNS,
    WIDE_LENGTH_LIMITS,
)
from redress.sources import readers, records, repair, writers  # noqa: E402
from redress.sources.scratch import new_folder, settle  # noqa: E402

try:
    import corpus_pipeline
    import redress.llm.queries as llm_queries
except ModuleNotFoundError as missing:  # the package of these queries can be left out
    if missing.name not in ("corpus_pipeline", "redress.llm", "redress.llm.queries"):
        raise
    llm_queries = None

SMALL = "/root/testdata/sf0.001"

_stored: dict[tuple, object] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], object]):
    """Build a stored table of this application at most once."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        _stored[key] = build()
    return _stored[key]


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as a stored table."""
    return _once(spark, sf_dir, "bronze", lambda: settle(feed(spark, sf_dir), "bronze", "zstd"))


def dims(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    raw = bronze(spark, sf_dir)
    build = {
        "products": star.build_products,
        "issues": star.build_issues,
        "companies": star.build_companies,
    }
    return {
        name: _once(spark, sf_dir, name, lambda b=b, name=name: settle(b(raw), name))
        for name, b in build.items()
    }


def fact(spark: SparkSession, sf_dir: str, null_safe: bool = True, **options) -> DataFrame:
    return star.build_fact(
        bronze(spark, sf_dir), **dims(spark, sf_dir), null_safe=null_safe, **options
    )


def silver_star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The star with the cleaned and enriched fact, all stored."""
    complaints = _once(
        spark,
        sf_dir,
        "complaints",
        lambda: settle(silver.enrich(silver.clean(fact(spark, sf_dir))), "complaints", "zstd"),
    )
    return {**dims(spark, sf_dir), "complaints": complaints}


def name_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(
        spark, sf_dir, "names", lambda: names.count_names(bronze(spark, sf_dir))
    )


# -- files in the formats the scans have to read --------------------------------


def raw_csv(spark: SparkSession, sf_dir: str) -> str:
    def write():
        path = new_folder(spark, "raw-csv")
        headers = {v: k for k, v in RAW_COLUMNS.items()}
        named = bronze(spark, sf_dir).select(*RAW_COLUMNS.values()).withColumnsRenamed(headers)
        writers.write_csv(named, path)
        return path

    return _once(spark, sf_dir, "raw-csv", write)


def star_csv(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    def write():
        tables = {**dims(spark, sf_dir), "complaints": fact(spark, sf_dir)}
        return writers.export_star(tables, new_folder(spark, "star-csv"))

    return _once(spark, sf_dir, "star-csv", write)


def stored_format(spark: SparkSession, sf_dir: str, fmt: str) -> str:
    """The Parquet or CSV copy of the silver fact."""

    def write():
        complaints = silver_star(spark, sf_dir)["complaints"]
        path = new_folder(spark, f"complaints-{fmt}")
        if fmt == "parquet":
            writers.write_parquet(complaints, path)
        else:
            writers.write_csv(writers.stringify_dates(complaints, layers.DATES), path)
        return path

    return _once(spark, sf_dir, f"format-{fmt}", write)


def stored_formats(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Parquet and CSV copies of the silver fact."""
    return {f: stored_format(spark, sf_dir, f) for f in ("parquet", "csv")}


_KIND = (
    "CASE WHEN complaint_id % 10 = 1 AND complaint_id % 40 = 1 THEN 8 "
    "WHEN complaint_id % 10 = 1 AND complaint_id % 40 = 11 THEN 9 "
    "WHEN complaint_id % 10 = 1 AND complaint_id % 40 = 21 THEN 10 ELSE complaint_id % 10 END"
)


def _malformed_lines(complaints: DataFrame) -> DataFrame:
    """The fact as CSV text, with the defects of a badly exported file.

    By ``_KIND``: 2 unquoted narrative with commas, 3 text after a quoted part and
    quoted parts in a too long row, 4 too short, 5 a fragment of a narrative, 6 a
    key that is no number, 7 a line break in quotes, 8 a stray quote in a row of
    the right length, 9 a date that does not exist, 10 a blank line before a well
    formed row, all others well formed.
    """
    text = F.col("complaint_narrative")

    def quoted(c):
        return F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))

    start = F.to_csv(F.struct(*COMPLAINTS.names[:-1]), writers.CSV_TEXT)
    kind = F.expr(_KIND)
    line = (
        F.when(kind == 2, F.concat_ws(",", start, text))
        .when(
            kind == 3,
            F.concat(start, F.lit(","), quoted(text), F.lit(" "), F.col("state"),
                     F.lit(', more,"' + ' ""or"" less",' + " end")),
        )
        .when(kind == 4, F.concat(F.col("complaint_id"), F.lit(",x")))
        .when(kind == 5, F.concat(F.lit("broken "), text))
        .when(kind == 6, F.concat(F.col("complaint_id"), F.lit(",x9" + "," * 13)))
        .when(
            kind == 7,
            F.concat_ws(",", start, quoted(F.concat(text, F.lit('\nsecond line, "last"')))),
        )
        .when(kind == 8, F.concat(start, F.lit(',"He said "no" to me"')))
        .when(kind == 9, F.concat(F.col("complaint_id"), F.lit(",1,1,1,2024-13-45" + "," * 10)))
        .when(kind == 10, F.concat(F.lit("\n"), F.concat_ws(",", start, quoted(text))))
        .otherwise(F.concat_ws(",", start, quoted(text)))
    )
    return complaints.select(line.alias("value"))


def equality_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(
        spark, sf_dir, "eq-fact", lambda: settle(fact(spark, sf_dir, null_safe=False), "fact")
    )


def malformed_file(spark: SparkSession, sf_dir: str) -> str:
    def write():
        path = new_folder(spark, "malformed")
        writers.write_lines(_malformed_lines(fact(spark, sf_dir)), path)
        return path

    return _once(spark, sf_dir, "malformed", write)


def repaired(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    def load():
        return repair.repair_load(spark, malformed_file(spark, sf_dir), header=False)

    return _once(spark, sf_dir, "repaired", load)


def layer_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    def run():
        return layers.run_layers(spark, raw_csv(spark, sf_dir), new_folder(spark, "layers"))

    return _once(spark, sf_dir, "layers", run)


# -- registered queries -----------------------------------------------------------


def _kpi(build, **options):
    return lambda spark, sf_dir: build(silver_star(spark, sf_dir), **options)


def _complaints(build):
    return lambda spark, sf_dir: build(silver_star(spark, sf_dir)["complaints"])


def _eq_fact(build):
    """Over the stored fact of the equality join, whose keys may be NULL."""

    return lambda spark, sf_dir: build(equality_fact(spark, sf_dir), dims(spark, sf_dir))


def _named(build):
    return lambda spark, sf_dir: build(name_table(spark, sf_dir))


def _fn_name_keys(counted: DataFrame) -> DataFrame:
    name = F.col("company_name")
    return relational.name_guard(counted, "company_name").select(
        name,
        fn.clean_name(name).alias("clean_name"),
        fn.case_key(name).alias("case_key"),
        fn.punct_key(name).alias("punct_key"),
        fn.suffix_key(name).alias("suffix_key"),
        F.length(name).alias("name_length"),
    )


def _fn_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.substring("state", 1, 1)
    timely = F.col("timely_response")
    as_text = F.when(timely == "Yes", "TRUE").when(timely == "No", "x")
    return bronze(spark, sf_dir).select(
        "complaint_id",
        fn.digits(F.col("zip_code")).alias("zip_digits"),
        fn.upper_letters(F.col("complaint_narrative")).alias("capitals"),
        fn.safe_int(F.col("zip_code")).alias("zip_int"),
        fn.is_blank(first).alias("blank_start"),
        fn.blank_to_null(F.trim(first)).alias("start_or_null"),
        fn.true_flag(as_text).alias("is_true"),
        fn.yes_flag(timely).alias("is_yes"),
    )


def _fn_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = fn.parse_date(F.col("date_received"))
    us = F.date_format(d, "MM/dd/yyyy")
    return bronze(spark, sf_dir).select(
        "complaint_id",
        d.alias("parsed"),
        fn.parse_date(us).alias("parsed_us"),
        fn.year_of(d).alias("year"),
        fn.month_key(d).alias("month_key"),
        F.substring(fn.month_key(d), 1, 4).alias("month_key_year"),
        fn.month_start(d).alias("month_start"),
        fn.days_between(d, fn.parse_date(F.col("date_sent_to_company"))).alias("days"),
    )


def _written_lines(spark: SparkSession, sf_dir: str, name: str, line) -> str:
    """The feed's ids in a text file of records made by ``line``, without a header."""

    def write():
        path = new_folder(spark, name)
        writers.write_lines(bronze(spark, sf_dir).select(line.alias("value")), path)
        return path

    return _once(spark, sf_dir, name, write)


_TEXTS = "complaint_id string, a string, b string"


def _stray_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inch marks in unquoted fields, with quoted fields of several lines between them."""
    n = F.col("complaint_id")
    b = F.when(n % 3 == 0, F.concat(F.lit('"first\n\n""second"" '), n, F.lit('"'))).otherwise(
        F.concat(F.lit("x"), n)
    )
    line = F.concat_ws(",", n, F.concat(n % 7, F.lit('" pipe')), b)
    path = _written_lines(spark, sf_dir, "stray-quotes", line)
    return records.read_large_csv(spark, path, StructType.fromDDL(_TEXTS), header=False)


def _blank_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank lines before, after and within records."""
    n = F.col("complaint_id")
    line = F.concat(F.lit("\n"), n, F.lit(',"a\n\nb",'), n % 5, F.lit("\n\n"))
    path = _written_lines(spark, sf_dir, "blank-lines", line)
    return records.read_large_csv(spark, path, StructType.fromDDL(_TEXTS), header=False)


def _all_views(spark: SparkSession, sf_dir: str) -> None:
    star_tables = silver_star(spark, sf_dir)
    writers.register({
        **star_tables, "complaint_tags": silver.explode_tags(star_tables["complaints"])
    })


def _views_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    _all_views(spark, sf_dir)
    own = ["products", "issues", "companies", "complaints", "complaint_tags"]
    return writers.list_views(spark).where(F.col("view_name").isin(own))


def _tags_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    _all_views(spark, sf_dir)
    return spark.sql("SELECT individual_tag, count(*) AS n FROM complaint_tags GROUP BY ALL")


def _storage_holds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of the report: CSV is the larger copy, the smallest entry counts once."""
    report = writers.storage_report(spark, stored_formats(spark, sf_dir))
    least = report.agg(F.min("bytes").alias("b"))
    return report.select(
        "label",
        ((F.col("files") > 0) & (F.col("bytes") > 0)).alias("filled"),
        (F.col("bytes") == least.scalar()).alias("smallest"),
        (F.col("times_smallest") >= 1).alias("at_least_once"),
    )


def _sample_holds(complaints: DataFrame) -> DataFrame:
    """A sample's rows, and how many of them the table has."""
    sample = relational.sample_rows(complaints, 15).select("complaint_id", "zip_code")
    known = complaints.select("complaint_id").distinct().withColumn("known", F.lit(True))
    return sample.join(known, "complaint_id", "left").agg(
        F.count("*").alias("sampled"), F.count("known").alias("found")
    )


def _unknown_keys(f: DataFrame) -> DataFrame:
    """Facts of which some refer to rows that no dimension has."""
    wrong = F.col("complaint_id") % 50 == 11
    return f.withColumns({
        c: F.when(wrong, F.col(c) + 1_000_000).otherwise(F.col(c)).cast("int")
        for c in ("product_id", "issue_id", "company_id")
    })


def _keyed(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {f"{t[:-1] if t != 'companies' else 'company'}_id": tables[t]
            for t in ("products", "issues", "companies")}


def _repeated_companies(tables: dict[str, DataFrame]) -> DataFrame:
    own = tables["companies"]
    again = own.where("company_id % 10 = 0")
    missing = own.where("company_id = 1").withColumn("company_name", F.lit(None).cast("string"))
    return own.union(again).union(missing)


def _declared_lengths(tables: dict[str, DataFrame]) -> DataFrame:
    """Both maps of declared widths over a star in which some values are too long."""
    long_names = {
        "products": "product_name", "issues": "sub_issue_name", "companies": "company_name",
        "complaints": "state",
    }
    keys = {"products": "product_id", "issues": "issue_id", "companies": "company_id",
            "complaints": "complaint_id"}
    planted = {
        t: tables[t].withColumn(
            c, F.when(F.col(keys[t]) % 9 == 1, F.repeat(F.coalesce(c, F.lit("x")), 300)).otherwise(F.col(c))
        )
        for t, c in long_names.items()
    }
    return audits.declared_lengths(planted, LENGTH_LIMITS, keys).unionByName(
        audits.declared_lengths(planted, WIDE_LENGTH_LIMITS, keys)
    )


def _unparsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates, ids and flags of the feed that cannot be read, some planted among US dates."""
    n, d = F.col("complaint_id"), fn.parse_date(F.col("date_received"))
    shown = (
        F.when(n % 70 == 1, F.lit("2024-13-45"))
        .when(n % 70 == 2, F.date_format(d, "MM/dd/yyyy"))
        .when(n % 70 == 3, F.date_format(d, "M/d/yyyy"))
        .when(n % 70 == 4, F.lit("13/1/2024"))
        .otherwise(F.col("date_received"))
    )
    raw = bronze(spark, sf_dir).select(
        shown.alias("date_received"),
        F.when(n % 70 == 5, F.concat(n, F.lit("x"))).otherwise(n.cast("string")).alias("complaint_id"),
        F.col("consumer_disputed"),
    )
    flag = {"consumer_disputed": lambda c: F.when(c.isin("Yes", "No"), c)}
    return audits.unparsed(raw, {
        "date_received": lambda c: fn.parse_date(c, short=True),
        "complaint_id": lambda c: fn.safe_int(c, "bigint"),
        **flag,
    })


def _views(spark: SparkSession, sf_dir: str) -> DataFrame:
    writers.register(silver_star(spark, sf_dir))
    return spark.sql(
        "SELECT product_name, response_band, count(*) AS n "
        "FROM complaints JOIN products USING (product_id) GROUP BY ALL"
    )


def _raw(df: DataFrame) -> DataFrame:
    return relational.canonicalize(df, RAW_COLUMNS)


def _loaded(spark, sf_dir, load, table, schema) -> DataFrame:
    return load(spark, star_csv(spark, sf_dir)[table], schema, new_folder(spark, f"load-{table}"))


def _planted_csv(spark: SparkSession, sf_dir: str) -> str:
    """Ids, a date and a flag of the feed; of seven rows four do not fit that schema."""
    n = F.col("complaint_id").cast("long")
    flag = F.when(F.col("timely_response") == "Yes", "true").otherwise("false")
    line = (
        F.when(n % 7 == 1, F.concat(n, F.lit(",")))  # too short
        .when(n % 7 == 2, F.concat_ws(",", n, "date_received", flag, F.lit("more")))
        .when(n % 7 == 3, F.concat(n, F.lit(",2024-02-30,true")))  # no such day
        .when(n % 7 == 4, F.concat(F.lit("x"), n, F.lit(",2024-02-01,true")))
        .otherwise(F.concat(n, F.lit(","), F.coalesce("date_received", F.lit("")), F.lit(","), flag))
    )

    def write():
        path = new_folder(spark, "planted")
        writers.write_lines(bronze(spark, sf_dir).select(line.alias("value")), path)
        return path

    return _once(spark, sf_dir, "planted", write)


def _planted_load(spark: SparkSession, sf_dir: str) -> writers.Loaded:
    schema = StructType.fromDDL("complaint_id long, received date, flag boolean")

    def load():
        path, out = _planted_csv(spark, sf_dir), new_folder(spark, "load-planted")
        return writers.bulk_load(spark, path, schema, out, header=False)

    return _once(spark, sf_dir, "planted-load", load)


def _load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = _planted_load(spark, sf_dir)
    return spark.range(1).select(
        F.lit(done.loaded).cast("long").alias("loaded"),
        F.lit(done.rejected).cast("long").alias("rejected"),
    )


_LAYOUT = {"by": ["year_received"], "order": ["state", "date_received"]}


def layout(spark: SparkSession, sf_dir: str) -> str:
    """The silver fact by year, sorted; one year written again with another state."""

    def write():
        path = new_folder(spark, "layout")
        complaints = silver_star(spark, sf_dir)["complaints"]
        writers.write_layout(complaints, path, **_LAYOUT)
        year = complaints.where("year_received = 1995").withColumn("state", F.lit("ZZ"))
        writers.write_layout(year, path, **_LAYOUT, replace_all=False)
        return path

    return _once(spark, sf_dir, "layout", write)


def _layout_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A year, a range of days and a state: one folder, and few of its row groups."""
    rows = readers.read_parquet(spark, layout(spark, sf_dir))
    return rows.where(
        "year_received = 1996 AND state = 'HA' AND date_received >= DATE'1996-03-01'"
    ).select("complaint_id", "state", "date_received")


def _damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The check of copies that have all rows, one value in one of them being wrong."""
    complaints = silver_star(spark, sf_dir)["complaints"]
    first = complaints.agg(F.min("complaint_id"))
    wrong = F.when(F.col("complaint_id") == first.scalar(), F.lit("wrong")).otherwise(F.col("state"))
    copy = complaints.withColumn("state", wrong)
    paths = {f: new_folder(spark, f"damaged-{f}") for f in ("parquet", "csv")}
    writers.write_parquet(copy, paths["parquet"])
    writers.write_csv(writers.stringify_dates(copy, layers.DATES), paths["csv"])
    return reduce(
        DataFrame.unionByName, [writers.verify_written(complaints, p, f) for f, p in paths.items()]
    )


def _bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complaints and companies in buckets by company, joined bucket by bucket."""

    def write():
        tables = silver_star(spark, sf_dir)
        buckets, out = joins.bucket_count(tables["complaints"]), []
        for name in ("complaints", "companies"):
            label = f"bucketed_{name}_{abs(hash(sf_dir))}"
            path = new_folder(spark, label)
            out.append(joins.write_bucketed(tables[name], label, "company_id", buckets, path))
        return out

    fact, dim = _once(spark, sf_dir, "bucketed", write)
    return joins.bucketed_join(fact, dim, "company_id").select("complaint_id", "company_name")


def _verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    complaints = silver_star(spark, sf_dir)["complaints"]
    paths = stored_formats(spark, sf_dir)
    return reduce(
        DataFrame.unionByName, [writers.verify_written(complaints, p, f) for f, p in paths.items()]
    )


def _punct_groups(counted: DataFrame):
    return relational.first_groups(names.name_variants(counted, "punct"), "name_key", 25)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """All registered queries: the library's own and, if it is there, those of ``llm``."""
    if llm_queries is None:
        return core_queries()
    return {**core_queries(), **llm_queries.queries(), "pipeline": corpus_pipeline.run}


def core_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    low_floors = ((360, "Critical"), (300, "High"), (80, "Medium"))
    return {
        "q1_top_companies": _kpi(kpis.top_companies),
        "q2_high_volume_products": _kpi(kpis.high_volume_products),
        "q3_above_average_companies": _kpi(kpis.above_average_companies),
        "q4_volume_tiers": _kpi(kpis.volume_tiers),
        "q4_volume_tiers_low_floors": _kpi(kpis.volume_tiers, tiers=low_floors, k=300),
        "q5_top_issues_per_product": _kpi(kpis.top_issues),
        "q6_timeliness_by_channel": _kpi(kpis.timeliness),
        "q7_monthly_ytd": _kpi(kpis.monthly_ytd),
        "q7_monthly_ytd_nonnull": _kpi(kpis.monthly_ytd, drop_null=True),
        "q8_dispute_states": _kpi(kpis.dispute_states),
        "q9_leading_company": _kpi(kpis.leading_company),
        "q10_resolution_snapshot": _kpi(kpis.resolution_snapshot),
        "q11_band_by_product": _kpi(kpis.band_by_product),
        "star_products": lambda s, d: star.build_products(bronze(s, d)),
        "star_issues": lambda s, d: star.build_issues(bronze(s, d)),
        "star_companies": lambda s, d: star.build_companies(bronze(s, d)),
        "star_complaints": lambda s, d: star.build_star(bronze(s, d))["complaints"],
        "star_complaints_eqjoin": lambda s, d: fact(s, d, null_safe=False),
        "star_complaints_salted": lambda s, d: fact(s, d, limit=0),
        "clean_zip_state": _complaints(
            lambda c: silver.clean(c.select(*COMPLAINTS.names)).select(
                "complaint_id", "zip_code", "zip_code_clean", "state", "state_clean",
                "zip_valid", "product_id_safe",
            )
        ),
        "zip_status": _complaints(audits.zip_status),
        "changed_zips": _complaints(lambda c: silver.cleaning_report(c)["changed_zips"]),
        "invalid_zips": _complaints(lambda c: silver.cleaning_report(c)["invalid_zips"]),
        "state_pairs": _complaints(lambda c: silver.cleaning_report(c)["state_pairs"]),
        "enrich_response": _complaints(
            lambda c: silver.enrich(
                c.select("complaint_id", "date_received", "date_sent_to_company")
            )
        ),
        "band_distribution": _complaints(silver.band_distribution),
        "tags_exploded": _complaints(
            lambda c: silver.explode_tags(c).select("complaint_id", "tags", "individual_tag")
        ),
        "tag_counts": _complaints(silver.tag_counts),
        "gold_combined": _kpi(kpis.combined),
        "gold_combined_large": _kpi(kpis.combined, limit=0),
        "join_bucketed": _bucketed,
        "running_total_rows": _complaints(
            lambda f: windows.running_total_of_rows(
                f.select("complaint_id", "year_received", "date_received", "response_days"),
                "response_days", "year_received", "date_received", "days_so_far",
            )
        ),
        "join_one_dimension": _kpi(
            lambda t: joins.star_join(
                t["complaints"].select("complaint_id", "company_id"),
                [(t["companies"], "company_id")],
            ).select("complaint_id", "company_name")
        ),
        "join_one_dimension_salted": _kpi(
            lambda t: joins.star_join(
                t["complaints"].select("complaint_id", "company_id"),
                [(t["companies"], "company_id")],
                limit=0,
            ).select("complaint_id", "company_name")
        ),
        "join_two_dimensions": _kpi(
            lambda t: joins.star_join(
                t["complaints"], [(t["products"], "product_id"), (t["issues"], "issue_id")]
            ).select("complaint_id", "product_name", "issue_name")
        ),
        "join_two_dimensions_eqstar": _eq_fact(
            lambda f, t: joins.star_join(
                f, [(t["products"], "product_id"), (t["issues"], "issue_id")], limit=0
            ).select("complaint_id", "product_name", "issue_name")
        ),
        "row_count": _complaints(aggregates.row_count),
        "count_by_column": _complaints(
            lambda c: aggregates.count_by(c, "submitted_via", "date_received", "dated")
        ),
        "count_by_expression": _complaints(
            lambda c: aggregates.count_by(
                c, F.substring("zip_valid", 1, 2).alias("zip_area"), having=F.col("count") > 10
            )
        ),
        "mean_group_count": _complaints(lambda c: aggregates.mean_group_count(c, "company_id")),
        "max_group_count": _complaints(
            lambda c: aggregates.max_group_count(c, ["product_id", "company_id"])
        ),
        "enforced_schema": lambda s, d: relational.enforce(
            fact(s, d).withColumn("product_id", F.col("zip_code")), COMPLAINTS
        ),
        "sample_rows": _complaints(lambda c: relational.sample_rows(c, 15)),
        "sample_rows_hold": _complaints(_sample_holds),
        "schema_report": _complaints(
            lambda c: relational.schema_report(c.select(*COMPLAINTS.names)).drop("nullable")
        ),
        "sql_over_views": _views,
        "views_listed": _views_listed,
        "tags_view": _tags_view,
        "fn_name_keys": _named(_fn_name_keys),
        "fn_text": _fn_text,
        "fn_dates": _fn_dates,
        "dq_row_counts": _kpi(aggregates.row_counts),
        "dq_future_dates": _complaints(
            lambda c: audits.future_dates(c, "2001-06-30").select("complaint_id", "date_received")
        ),
        "dq_future_dates_today": _complaints(
            lambda c: aggregates.row_count(
                audits.future_dates(
                    c.withColumn(
                        "date_received",
                        F.when(
                            F.col("complaint_id") % 90 == 1, F.add_months("date_received", 1200)
                        ).otherwise(F.col("date_received")),
                    )
                ),
                "future_dates",
            )
        ),
        "dq_future_dates_count": _complaints(
            lambda c: aggregates.row_count(audits.future_dates(c, "2001-06-30"), "future_dates")
        ),
        "dq_blank_names": lambda s, d: audits.blank_names(
            dims(s, d)["products"], "sub_product_name"
        ).select("product_id", "sub_product_name"),
        "dq_illogical_dates": _complaints(
            lambda c: audits.illogical_dates(c).select(
                "complaint_id", "date_received", "date_sent_to_company"
            )
        ),
        "dq_illogical_dates_count": _complaints(
            lambda c: aggregates.row_count(audits.illogical_dates(c), "illogical_dates")
        ),
        "dq_orphans": _eq_fact(
            lambda f, t: joins.orphans(_unknown_keys(f), t["products"], "product_id").select(
                "complaint_id", "product_id"
            )
        ),
        "dq_orphans_salted": _eq_fact(
            lambda f, t: joins.orphans(
                _unknown_keys(f), t["products"], "product_id", limit=0
            ).select("complaint_id", "product_id")
        ),
        "dq_orphans_count": _eq_fact(
            lambda f, t: aggregates.row_count(
                joins.orphans(f, t["products"], "product_id"), "orphan_complaints"
            )
        ),
        "dq_fk": _eq_fact(lambda f, t: audits.fk_violations(_unknown_keys(f), _keyed(t))),
        "dq_pk": _complaints(lambda c: audits.pk_violations(c, "complaint_id")),
        "dq_unique_companies": _kpi(
            lambda t: audits.pk_violations(_repeated_companies(t), "company_name")
        ),
        "dq_declared_lengths": _kpi(_declared_lengths),
        "dq_unparsed": _unparsed,
        "dq_overlength": _complaints(
            lambda c: audits.overlength(c, {"tags": 14, "zip_code": 5, "state": 2}, "complaint_id")
        ),
        "names_case": _named(lambda n: names.name_variants(n, "case")),
        "names_punct": _named(lambda n: names.name_variants(n, "punct")),
        "names_suffix": _named(lambda n: names.name_variants(n, "suffix")),
        "names_punct_first25": _named(lambda n: _punct_groups(n)[0]),
        "names_punct_rest": _named(lambda n: _punct_groups(n)[1]),
        "names_summary": _named(names.variant_summary),
        "scan_raw": lambda s, d: _raw(readers.read_raw(s, raw_csv(s, d))),
        "scan_raw_large_files": lambda s, d: _raw(records.read_large_csv(s, raw_csv(s, d))),
        "scan_raw_stray_quotes": _stray_quotes,
        "scan_raw_blank_lines": _blank_lines,
        "scan_raw_inferred": lambda s, d: _raw(readers.read_raw(s, raw_csv(s, d), infer=True)),
        "scan_table_inferred": lambda s, d: readers.read_table(s, star_csv(s, d)["complaints"]),
        "scan_types_found": lambda s, d: readers.read_inferred(s, star_csv(s, d)["complaints"]),
        "scan_table_fixed": lambda s, d: readers.read_table(
            s, star_csv(s, d)["complaints"], COMPLAINTS
        ),
        "load_dimension": lambda s, d: _loaded(
            s, d, writers.load_dim, "companies", COMPANIES
        ),
        "load_fact": lambda s, d: _loaded(s, d, writers.load_fact, "complaints", COMPLAINTS),
        "load_planted": lambda s, d: _planted_load(s, d).table,
        "load_rejected": lambda s, d: _planted_load(s, d).rejects.select("record"),
        "load_counts": _load_counts,
        "layout_replaced_year": lambda s, d: readers.read_parquet(s, layout(s, d)).select(
            "complaint_id", "state", "date_received", "year_received"
        ),
        "layout_pruned": _layout_query,
        "parquet_roundtrip": lambda s, d: readers.read_parquet(s, stored_format(s, d, "parquet")),
        "csv_roundtrip": lambda s, d: readers.read_table(
            s,
            stored_format(s, d, "csv"),
            writers.stringify_dates(silver_star(s, d)["complaints"], layers.DATES).schema,
        ),
        "verify_written": _verify,
        "verify_damaged": _damaged,
        "storage_report": lambda s, d: writers.storage_report(s, stored_formats(s, d)),
        "storage_report_holds": _storage_holds,
        "repair_good": lambda s, d: repaired(s, d)[0],
        "repair_rejected": lambda s, d: repaired(s, d)[1],
        "repair_counts": lambda s, d: repair.load_counts(*repaired(s, d)),
        "layers_combined": lambda s, d: layer_tables(s, d)["combined"],
        "layers_top_companies": lambda s, d: layer_tables(s, d)["top_companies"],
    }


def entry(spark: SparkSession) -> DataFrame:
    """Companies with the most complaints, from the feed through the star."""
    return queries()["q1_top_companies"](spark, SMALL)


def oracle_sql() -> dict[str, str]:
    if llm_queries is None:
        return oracle_queries.oracle_sql()
    return {**oracle_queries.oracle_sql(), **llm_queries.oracle_sql()}
