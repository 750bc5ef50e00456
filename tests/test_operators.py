from collections import Counter

import pytest
from pyspark.sql import functions as F

from redress.operators import aggregates, audits, joins, names, relational, windows
from redress.operators.keys import assign_ids, distinct_keys
from redress.schema import COMPLAINTS
from redress.sources.scratch import settle


def as_counter(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key, another third has none."""
    return spark.range(9000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 2000))
        .alias("key"),
    )


@pytest.fixture(scope="module")
def keyed_dim(spark):
    keys = [("hot", 1), (None, 2)] + [(f"k{i}", i + 10) for i in range(0, 1500)]
    return spark.createDataFrame(keys, "name string, dim_id int")


@pytest.mark.parametrize("how", ["inner", "left", "left_anti", "left_semi"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_salted_join_equals_broadcast_join(skewed, keyed_dim, how, null_safe):
    on = [("key", "name")]
    small = joins.dim_join(skewed, keyed_dim, on, how, null_safe)
    large = joins.dim_join(skewed, keyed_dim, on, how, null_safe, limit=0)
    assert small.columns == large.columns
    assert as_counter(small) == as_counter(large)


def test_salted_join_spreads_the_hot_keys(spark, skewed, keyed_dim):
    hot = joins.hot_keys(skewed, ["key"])
    # 8 partitions: a third of the rows is 2 2/3 even shares, in two pieces each
    assert {tuple(r) for r in hot.collect()} == {("hot", 6), (None, 6)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        joined = joins.dim_join(skewed, keyed_dim, [("key", "name")], "left", True, limit=0)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(r[1] for r in sizes) == 9000
    assert max(r[1] for r in sizes) < 2700  # one task would hold at least 3000 unsalted


@pytest.mark.parametrize("extra", [[], ["1 AS same"]])
def test_salted_join_spreads_equal_rows(spark, skewed, extra):
    """Facts of nothing but their keys, so that the rows of a hot key are all alike."""
    fact = settle(skewed.selectExpr("coalesce(key, 'none') AS key", *extra), "alike")
    dim = spark.createDataFrame([("hot", 1), ("none", 2)], "name string, dim_id int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        joined = joins.dim_join(fact, dim, [("key", "name")], limit=0)
        sizes = [r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert "_row" not in joined.columns
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(sizes) == 9000 and max(sizes) < 2700


def test_every_type_is_measured(spark):
    rows = spark.range(100).select(
        "id",
        F.array_repeat(F.col("id"), 1000).alias("numbers"),
        F.create_map(F.lit("k"), F.repeat(F.lit("v"), 500)).alias("m"),
        F.struct(F.repeat(F.lit("w"), 500).alias("s")).alias("t"),
        F.repeat(F.lit("z"), 500).cast("binary").alias("b"),
        F.array(F.lit(None).cast("long"), F.lit(None).cast("long")).alias("nulls"),
    )
    size = joins.measured_bytes(rows)
    assert size >= 100 * (1000 * 8 + 3 * 500 + 16)
    assert joins.measured_bytes(rows.select("b")) >= 100 * 500
    variant = rows.select(F.parse_json(F.to_json(F.struct("numbers"))).alias("v"))
    assert joins.measured_bytes(variant) >= 100 * 1000 * 8


def test_broadcast_needs_a_measured_size(spark, keyed_dim):
    size = joins.measured_bytes(keyed_dim)
    assert size > 1502 * 16
    assert joins.fits_broadcast(keyed_dim, size)
    assert not joins.fits_broadcast(keyed_dim, size - 1)
    assert joins.measured_bytes(keyed_dim.limit(0)) == 0


def test_join_with_itself_derived(skewed):
    """A dimension computed from the fact does not confuse column resolution."""
    dim = skewed.groupBy("key").agg(F.count("*").alias("n"))
    for limit in (joins.BROADCAST_BYTES, 0):
        rows = joins.dim_join(skewed, dim, ["key"], "left", True, limit=limit)
        assert rows.where("n IS NULL").count() == 0 and rows.count() == 9000


def test_star_join_and_denormalize(spark):
    fact = spark.createDataFrame([(1, 1, 1), (2, 9, 1), (3, None, 2)], "id int, a int, b int")
    a = spark.createDataFrame([(1, "one")], "a int, a_name string")
    b = spark.createDataFrame([(1, "x"), (2, "y")], "b int, b_name string")
    for limit in (joins.BROADCAST_BYTES, 0):
        inner = joins.star_join(fact, [(a, "a"), (b, "b")], limit)
        assert [tuple(r) for r in inner.collect()] == [(1, 1, 1, "one", "x")]
        left = joins.denormalize(fact, [(a, "a"), (b, "b")], limit)
        assert as_counter(left.select("id", "a_name", "b_name")) == Counter(
            [(1, "one", "x"), (2, None, "x"), (3, None, "y")]
        )
        assert {r.id for r in joins.orphans(fact, a, "a", limit).collect()} == {2, 3}


def test_ids_equal_a_global_row_number(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        raw = spark.range(5000).select(
            F.when(F.col("id") % 7 != 0, F.concat(F.lit("p"), F.col("id") % 311)).alias("a"),
            F.when(F.col("id") % 5 != 0, F.concat(F.lit("q"), F.col("id") % 13)).alias("b"),
        )
        ids = assign_ids(distinct_keys(raw, ["a", "b"]), ["a", "b"], "n")
        rows = ids.orderBy("n").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    expected = sorted(
        {(r.a, r.b) for r in raw.collect()},
        key=lambda k: tuple((v is not None, v or "") for v in k),
    )
    assert [r.n for r in rows] == list(range(1, len(expected) + 1))
    assert [(r.a, r.b) for r in rows] == expected
    assert ids.select(F.spark_partition_id()).distinct().count() > 1


def test_ids_of_nothing(spark):
    empty = spark.createDataFrame([], "a string")
    assert assign_ids(empty, ["a"], "n").count() == 0


def test_top_per_group_against_brute_force(spark):
    counts = spark.range(600).select(
        F.when(F.col("id") % 10 > 0, F.concat(F.lit("g"), F.col("id") % 3)).alias("grp"),
        F.col("id").alias("item"),
        (F.col("id") * 7919 % 23).alias("n"),
    )
    rows = counts.collect()
    for k in (1, 3, 50):
        expected = Counter()
        for r in rows:
            rank = 1 + sum(o.grp == r.grp and o.n > r.n for o in rows)
            if rank <= k:
                expected[(r.grp, r.item, r.n, rank)] += 1
        top = windows.top_per_group(counts, "grp", "n", k).select("grp", "item", "n", "rnk")
        assert as_counter(top) == expected


def test_running_total_shares_ties(spark):
    df = spark.createDataFrame(
        [("a", 1, 5), ("a", 2, 1), ("a", 2, 2), ("b", 1, 7)], "p string, o int, v int"
    )
    out = windows.running_total(df, "v", "p", "o", "t")
    assert as_counter(out) == Counter(
        [("a", 1, 5, 5), ("a", 2, 1, 8), ("a", 2, 2, 8), ("b", 1, 7, 7)]
    )


def test_counts_rates_and_means(spark):
    df = spark.createDataFrame(
        [("a", 1, True), ("a", None, False), ("a", 2, None), ("b", 3, True), (None, 4, True)],
        "k string, v int, ok boolean",
    )
    assert as_counter(aggregates.count_by(df, "k", "v", "n")) == Counter(
        [("a", 2), ("b", 1), (None, 1)]
    )
    assert aggregates.count_by(df, "k", having=F.col("count") > 2).collect() == [("a", 3)]
    rates = aggregates.rate_by(df, "k", F.col("ok"))
    assert as_counter(rates) == Counter(
        [("a", 3, 1, 33.33), ("b", 1, 1, 100.0), (None, 1, 1, 100.0)]
    )
    assert aggregates.rate_by(df, "k", F.col("ok"), min_n=1, min_pct=33).collect()[0][0] == "a"
    assert aggregates.rate_by(df, "k", F.col("ok"), min_n=1, min_pct=34).count() == 0
    assert aggregates.mean_group_count(df, "k").first()[0] == pytest.approx(5 / 3)
    assert as_counter(aggregates.max_group_count(df, ["k", "ok"])) == Counter(
        [("a", 1), ("b", 1), (None, 1)]
    )
    totals = aggregates.row_counts({"z": df, "a": df.limit(2)})
    assert [tuple(r) for r in totals.collect()] == [("a", 2), ("z", 5)]


def test_relational(spark):
    df = spark.createDataFrame([("1", "x"), ("x", "y")], "complaint_id string, state string")
    wide = df.select("*", *[F.lit(None).cast("string").alias(c) for c in COMPLAINTS.names
                            if c not in df.columns])
    typed = relational.enforce(wide, COMPLAINTS)
    assert typed.columns == COMPLAINTS.names
    assert [f.dataType for f in typed.schema] == [f.dataType for f in COMPLAINTS]
    assert {r.complaint_id for r in typed.collect()} == {1, None}
    report = relational.schema_report(typed).orderBy("position").collect()
    assert [(r.column, r.type) for r in report][:2] == [
        ("complaint_id", "bigint"), ("product_id", "int"),
    ]
    assert relational.canonicalize(df, {"state": "s", "gone": "g"}).columns == ["complaint_id", "s"]
    assert relational.sample_rows(df, 1).count() == 1
    pairs = spark.createDataFrame([("a", "a"), ("a", "b"), (None, "b"), ("a", None)], "p string, q string")
    assert relational.changed_rows(pairs, "p", "q").collect() == [("a", "b")]
    assert relational.top_k(pairs, "q", 2, "p").collect() == [(None, "b"), ("a", "b")]


def test_name_guard(spark):
    values = [("ok",), ("",), (None,), ("x" * 300,), ("x" * 301,)]
    df = spark.createDataFrame(values, "n string")
    assert {len(r.n) for r in relational.name_guard(df, "n").collect()} == {2, 300}


def test_first_groups(spark):
    df = spark.range(100).select((F.col("id") % 40).alias("k"), "id")
    rows, rest = relational.first_groups(df, "k", 25)
    assert {r.k for r in rows.collect()} == set(range(25)) and rest.first()[0] == 15
    rows, rest = relational.first_groups(df, "k", 50)
    assert rows.count() == 100 and rest.first()[0] == 0


NAMES = ["Abc Bank", "ABC BANK ", "abc bank", "A.B.C. Bank", "Abc Bank LLC", "Zed Corp.", "Zed Inc",
         "Corp", "Inc.", "Solo", "", None, "n" * 301]


def test_name_audit(spark):
    raw = spark.createDataFrame([(n,) for n in NAMES for _ in range(2)], "company_name string")
    counted = names.count_names(raw)
    case = names.name_variants(counted, "case").collect()
    assert {(r.name_key, r.variants, r.company_name, r.complaints) for r in case} == {
        ("ABC BANK", 3, n, 2) for n in NAMES[:3]
    }
    punct = names.name_variants(counted, "punct").collect()
    assert {(r.name_key, r.company_name) for r in punct} == {("ABC BANK", n) for n in NAMES[:4]}
    suffix = names.name_variants(counted, "suffix").collect()
    assert {(r.name_key, r.company_name) for r in suffix} == {
        ("ABC BANK", n) for n in NAMES[:5]
    } | {("ZED", "Zed Corp."), ("ZED", "Zed Inc")}
    assert names.variant_summary(counted).first().asDict() == {
        "total_rows": 26, "raw_names": 10, "case_groups": 1, "punct_groups": 1,
        "suffix_groups": 2, "names_after_cleaning": 8, "merged_names": 2,
    }
    nothing = names.variant_summary(names.count_names(raw.limit(0))).first()
    assert list(nothing) == [0] * 7


def test_one_key_with_very_many_variants(spark):
    """All names meet under one key: they come as rows, through either join."""
    df = spark.range(5000).select(
        F.lit("same").alias("key"), F.concat(F.lit("n"), F.col("id")).alias("value")
    )
    groups = aggregates.variant_groups(settle(df, "test"), "key", "value")
    assert groups.count() == 5000 and groups.select("variants").distinct().collect() == [(5000,)]


def test_audits(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, date'2024-01-05', date'2024-01-01', 1, 'abcdef'),"
        "(1, date'2030-01-01', date'2030-01-02', 7, 'ab'), (NULL, NULL, NULL, NULL, NULL)"
        " AS t(complaint_id, date_received, date_sent_to_company, product_id, state)"
    )
    assert audits.future_dates(df, "2029-01-01").count() == 1
    assert audits.future_dates(df, "2030-01-01").count() == 0
    assert audits.illogical_dates(df).count() == 1
    assert as_counter(audits.pk_violations(df, "complaint_id")) == Counter([(1, 2), (None, 1)])
    dim = spark.createDataFrame([(1, " ")], "product_id int, name string")
    assert audits.blank_names(dim, "name").count() == 1
    assert audits.fk_violations(df, {"product_id": dim}).collect() == [("product_id", 7, 1)]
    assert audits.overlength(df, {"state": 5}, "complaint_id").collect() == [(1, "state", 5, 6)]


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    fact = spark.range(5000).select(
        F.col("id"), F.when(F.col("id") % 50 > 0, F.col("id") % 700).alias("key")
    )
    dim = spark.range(600).select(F.col("id").alias("key"), F.concat(F.lit("n"), "id").alias("name"))
    stored = [
        joins.write_bucketed(df, f"bucketed_test_{i}", "key", 4, str(tmp_path / str(i)))
        for i, df in enumerate((fact, dim))
    ]
    for how in ("inner", "left"):
        joined = joins.bucketed_join(*stored, "key", how)
        plan = executed(joined)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        want = fact.join(dim, "key", how).select("key", "id", "name")
        assert Counter(map(tuple, joined.select("key", "id", "name").collect())) == Counter(
            map(tuple, want.collect())
        )
    for i in range(2):
        spark.sql(f"DROP TABLE bucketed_test_{i}")


def test_wide_columns_move_once(spark, tmp_path):
    """Large dimensions are joined to row numbers and keys; the text is shuffled once."""
    path = str(tmp_path / "fact")
    spark.range(3000).select(
        (F.col("id") % 7).alias("a"), F.when(F.col("id") % 3 > 0, F.col("id") % 11).alias("b"),
        F.concat(F.lit("text "), "id").alias("text"),
    ).write.parquet(path)
    fact = spark.read.parquet(path)
    dims = [
        (spark.range(n).select(F.col("id").alias(k), F.concat(F.lit(k), "id").alias(f"name_{k}")), k)
        for k, n in (("a", 7), ("b", 9))
    ]
    for build in (joins.denormalize, joins.star_join):
        large = build(fact, dims, limit=0)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            lines = executed(build(fact, dims, limit=0)).splitlines()
        finally:
            spark.conf.unset("spark.sql.adaptive.enabled")
        scans = [line for line in lines if "FileScan" in line and "text#" in line]
        assert len(scans) == 1  # no other branch reads the text
        assert Counter(map(tuple, large.collect())) == Counter(map(tuple, build(fact, dims).collect()))


@pytest.mark.parametrize("kind", ["one part", "ties", "nulls"])
def test_running_total_of_rows_equals_the_window(spark, kind):
    n = 1_000_000 if kind == "one part" else 20_000
    rows = spark.range(n).select(
        F.lit(1).alias("part") if kind == "one part"
        else F.when(F.col("id") % 3 > 0, F.col("id") % 2).alias("part"),
        F.when(F.col("id") % 5 > 0, F.pmod(F.xxhash64("id"), F.lit(50 if kind == "ties" else n))).alias("at"),
        F.when((F.col("id") % 4 > 0) | F.lit(kind != "nulls"), F.col("id") % 100).alias("value"),
    )
    got = windows.running_total_of_rows(rows, "value", "part", "at", "total")
    want = windows.running_total(rows, "value", "part", "at", "total")

    def digest(df):
        hashed = F.xxhash64(*df.columns, *[F.col(c).isNull() for c in df.columns])
        return df.agg(F.count("*"), F.sum(hashed.cast("decimal(38,0)")), F.bit_xor(hashed)).first()

    assert digest(got.select(want.columns)) == digest(want)
    if kind == "one part":
        # The sums of one part lie in even ranges of the order.
        sums = rows.groupBy("part", "at").agg(F.sum("value")).repartitionByRange(8, "part", "at")
        sizes = [r[1] for r in sums.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 8 and max(sizes) <= 1.5 * sum(sizes) / 8


def test_buckets_grow_with_the_rows(spark):
    assert joins.bucket_count(spark.range(10)) == joins.LEAST_BUCKETS
    assert joins.bucket_count(spark.range(20 * joins.BUCKET_ROWS + 1)) == 21
