"""Whole flows: star, layers, second formulations, and the shape of plans."""

import pathlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
from redress.functions import case_key
from redress.operators import joins
from redress.operators.joins import orphans, star_join
from redress.plans import kpis, silver, star
from redress.plans.feed import COLUMNS_SQL, TERMS, feed
from redress.plans.layers import run_layers
from redress.schema import RAW_COLUMNS
from redress.sources.scratch import SETTING
from redress.sources.writers import register

FOLDER = "/root/testdata/sf0.001"
ROOT = pathlib.Path(registered.__file__).parent


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def raw(spark):
    return registered.bronze(spark, FOLDER)


@pytest.fixture(scope="module")
def tables(spark):
    return registered.silver_star(spark, FOLDER)


def test_null_safe_star_restores_every_row(raw):
    built = star.build_star(raw)
    wide = kpis.combined(built)
    natural = ["complaint_id", *star.PRODUCT_KEYS, *star.ISSUE_KEYS, "company_name", "state"]
    expected = raw.withColumn("company_name", F.upper(F.trim("company_name")))
    assert rows(wide.select(natural)) == rows(expected.select(natural))


def test_equality_star_loses_null_keys_only(raw):
    built = star.build_star(raw, null_safe=False)
    assert built["complaints"].count() == raw.count()
    lost = raw.where("sub_product_name IS NULL OR product_name IS NULL").count()
    assert built["complaints"].where("product_id IS NULL").count() == lost > 0


def test_ids_are_dense(tables):
    for name, key in (("products", "product_id"), ("issues", "issue_id"), ("companies", "company_id")):
        low, high, n, distinct = tables[name].agg(
            F.min(key), F.max(key), F.count(key), F.countDistinct(key)
        ).first()
        assert (low, high, distinct) == (1, n, n)


def test_totals_agree(tables):
    n = tables["complaints"].count()
    bands = silver.band_distribution(tables["complaints"])
    assert bands.agg(F.sum("count")).first()[0] == n
    months = kpis.monthly_ytd(tables).withColumn("year", F.year("month_start"))
    per_year = months.groupBy("year").agg(
        F.sum("monthly_count").alias("n"), F.max("ytd_running_total").alias("ytd")
    )
    assert per_year.where("n <> ytd").count() == 0
    assert per_year.agg(F.sum("n")).first()[0] == n


def test_kpis_against_row_level_joins(spark, tables):
    """The same KPIs, joined row by row first and counted afterwards."""
    register({f"t_{k}": v for k, v in tables.items()})
    wide = """t_complaints c LEFT JOIN t_products p ON c.product_id = p.product_id
              LEFT JOIN t_issues i ON c.issue_id = i.issue_id
              LEFT JOIN t_companies o ON c.company_id = o.company_id"""
    pairs = {
        "SELECT company_name, count(*) n FROM {w} GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10":
            kpis.top_companies(tables),
        "SELECT product_name, count(*) n FROM {w} GROUP BY 1 HAVING n > 900":
            kpis.high_volume_products(tables, 900),
        "SELECT product_name, response_band, count(*) FROM {w} GROUP BY 1, 2":
            kpis.band_by_product(tables),
        "SELECT product_name, company_name, n FROM (SELECT *, max(n) OVER (PARTITION BY "
        "product_name) m FROM (SELECT product_name, company_name, count(*) n FROM {w} "
        "GROUP BY 1, 2)) WHERE n = m": kpis.leading_company(tables).select(
            "product_name", "company_name", "complaints"
        ),
    }
    for sql, df in pairs.items():
        assert rows(spark.sql(sql.format(w=wide))) == rows(df), sql


def test_reports_are_sorted(tables):
    def keys(df, *cols):
        return [tuple(r) for r in df.select(*cols).collect()]

    down = lambda rows: sorted(rows, key=lambda r: (-r[0], *r[1:]))
    for rows_, order in (
        (keys(kpis.top_companies(tables), "total_complaints", "company_name"), down),
        (keys(kpis.high_volume_products(tables, 0), "complaint_count", "product_name"), down),
        (keys(kpis.above_average_companies(tables), "complaint_count", "company_name"), down),
        (keys(kpis.volume_tiers(tables), "total", "company_name"), down),
        (keys(kpis.top_issues(tables), "product_name", "rnk", "issue_name"), sorted),
        (keys(kpis.timeliness(tables), "timely_pct", "submitted_via"), sorted),
        (keys(kpis.monthly_ytd(tables, drop_null=True), "month_start"), sorted),
        (keys(kpis.dispute_states(tables, 100, 20), "dispute_rate_pct", "state"), down),
        (keys(kpis.leading_company(tables), "complaints", "product_name", "company_name"), down),
        (keys(kpis.resolution_snapshot(tables), "total", "product_name", "issue_name"), down),
        (keys(silver.tag_counts(tables["complaints"]), "count"), down),
    ):
        assert rows_ == order(rows_) and rows_


def test_thresholds_are_strict(tables):
    counts = kpis.high_volume_products(tables, 0).collect()
    smallest = min(r.complaint_count for r in counts)
    assert kpis.high_volume_products(tables, smallest).count() == len(counts) - sum(
        r.complaint_count == smallest for r in counts
    )
    assert kpis.dispute_states(tables).count() == 0
    assert kpis.dispute_states(tables, 100, 20).count() > 0


def test_tags(spark):
    df = spark.createDataFrame([(1, "A, B"), (2, None), (3, "")], "complaint_id int, tags string")
    exploded = silver.explode_tags(df).select("complaint_id", "individual_tag")
    assert rows(exploded) == Counter([(1, "A"), (1, "B"), (2, None), (3, "")])


def test_layer_flow(spark, raw, tmp_path):
    source = registered.raw_csv(spark, FOLDER)
    out = str(tmp_path / "lake")
    for _ in range(2):  # a repeated run replaces the tables
        made = run_layers(spark, source, out)
    assert made["bronze"].count() == made["combined"].count() == raw.count()
    assert rows(made["top_companies"]) == rows(kpis.top_companies(registered.silver_star(spark, FOLDER)))
    for name in ("silver/complaints", "silver/products", "gold/combined", "gold/top_companies"):
        parquet = spark.read.parquet(f"{out}/{name}_parquet")
        csv = spark.read.options(header=True, multiLine=True, escape='"').csv(f"{out}/{name}_csv")
        assert csv.count() == parquet.count() and csv.columns == parquet.columns
    assert dict(made["complaints"].dtypes)["date_received"] == "date"
    assert set(made["bronze"].columns) == set(RAW_COLUMNS.values())


def test_layer_flow_leaves_only_its_layers(spark, raw, tmp_path):
    folder = pathlib.Path(spark.conf.get(SETTING)) / "redress" / spark.sparkContext.applicationId
    source = raw.select(*RAW_COLUMNS.values()).withColumnsRenamed({v: k for k, v in RAW_COLUMNS.items()})
    before = set(folder.iterdir())
    made = run_layers(spark, source, str(tmp_path / "lake"), csv=False, limit=0)
    assert set(folder.iterdir()) == before
    assert made["combined"].count() == raw.count()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_dimensions_leave_the_fact_unshuffled(raw, tables):
    dims = {k: tables[k] for k in ("products", "issues", "companies")}
    for df in (star.build_fact(raw, **dims), kpis.combined(tables)):
        text = plan(df)
        assert text.count("BroadcastHashJoin") == 3
        assert "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text


def test_large_dimensions_are_not_broadcast(spark, raw, tables):
    dims = {k: tables[k] for k in ("products", "issues", "companies")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(star.build_fact(raw, **dims, limit=0))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("SortMergeJoin") == 3
    assert "salt" in text


def test_large_joins_read_their_keys_only(spark, tables):
    found = orphans(tables["complaints"], tables["products"], "product_id", limit=0)
    text = plan(found.agg(F.count("*")))
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert scans and all("narrative" not in s and "zip_code" not in s for s in scans)


def test_kpis_count_before_they_join(tables):
    text = plan(kpis.top_companies(tables))
    assert "TakeOrderedAndProject" in text
    scan = next(m for m in re.findall(r"ReadSchema: struct<([^>]*)>", text) if "complaint_id" in m)
    assert set(re.findall(r"(\w+):", scan)) == {"complaint_id", "company_id"}
    join = text.index("Join")
    assert "HashAggregate" in text[join:]  # below the join, on the fact side


def test_no_cross_joins(spark, tables):
    for build in (kpis.above_average_companies, kpis.top_issues, kpis.monthly_ytd):
        text = plan(build(tables))
        assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_row_filters_reach_the_scan(spark, tables):
    joined = star_join(tables["complaints"], [(tables["companies"], "company_id")])
    text = plan(joined.where("year_received = 1999").select("company_name"))
    assert "EqualTo(year_received,1999)" in text


def test_library_stays_distributed():
    banned = re.compile(
        r"localCheckpoint|\.collect\(|toPandas|crossJoin|coalesce\(1\)|\.rdd\.(?!getNumPartitions)|udf"
    )
    for path in (ROOT / "redress").rglob("*.py"):
        if "llm" in path.parts:  # its models have sizes of their own
            continue
        assert not banned.search(path.read_text()), path


def test_case_key_groups_what_the_star_merges(raw):
    """Cleaning in the star merges names that differ in case or outer spaces."""
    keys = raw.select(case_key(F.col("company_name"))).distinct().count()
    assert keys == star.build_companies(raw).count()


def test_terms_of_the_feed_are_worked_out_before_the_lines_are_joined(spark):
    """Once per supplier, part or order, and not once per line."""
    plan = feed(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    last = plan.split("Join", 1)[0]
    for term in ("lower(", "replace(", "chr(", "lpad(", "cast(o_orderdate"):
        assert term not in last and term in plan
    for name, sql, _ in TERMS:
        assert sql in COLUMNS_SQL and name not in COLUMNS_SQL


def test_lines_move_without_the_numbers_their_terms_stand_for(spark):
    plan = feed(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    last = plan.split("Join", 1)[0]
    for number in ("l_tax", "l_discount"):
        assert number not in last and number in plan


def test_lines_of_the_feed_are_shuffled_twice(spark, monkeypatch):
    """However large the tables are: by order and by part, and never by customer."""
    monkeypatch.setattr("redress.plans.feed.fits_broadcast", lambda df: True)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = feed(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    dealt = re.findall(r"Exchange hashpartitioning\((\w+)#", plan)
    assert sorted(dealt) == [
        "c_custkey", "l_orderkey", "l_partkey", "o_custkey", "o_orderkey", "p_partkey"
    ]


def test_a_single_large_dimension_moves_the_rows_once(spark, raw, tables):
    """One join that shuffles, of one scan of the text, in the fact build and in gold."""
    dims = {k: tables[k] for k in ("products", "issues", "companies")}
    *_, limit, largest = sorted(map(joins.measured_bytes, dims.values()))
    assert limit < largest
    builds = (lambda limit: star.build_fact(raw, **dims, limit=limit), lambda limit: kpis.combined(tables, limit))
    for build in builds:
        large, small = build(limit), build(1 << 30)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        try:
            text = plan(build(limit))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert len([x for x in text.splitlines() if "FileScan" in x and "complaint_narrative#" in x]) == 1
        assert text.count("SortMergeJoin") == 1 and "ShuffledHashJoin" not in text and "salt" in text
        assert large.columns == small.columns and rows(large) == rows(small)


def test_suppliers_are_broadcast_without_their_terms(spark, monkeypatch):
    """Where only the terms are too large, lines are not shuffled for them, and rows are the same."""
    folder = "/root/testdata/sf0.001"
    want = rows(feed(spark, folder))
    monkeypatch.setattr("redress.plans.feed.fits_broadcast", lambda df: "_name_lower" not in df.columns)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = feed(spark, folder)
        text = plan(found)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(l_suppkey" not in text
    assert rows(found) == want
