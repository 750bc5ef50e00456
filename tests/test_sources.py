import csv
import pathlib
import random
import time
from collections import Counter
from types import SimpleNamespace

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from redress.operators.keys import assign_ids
from redress.schema import COMPLAINTS, PRODUCTS
from redress.sources import readers, records, repair, scratch, writers

TRICKY = [
    (1, 'quote " inside', "two\nlines"),
    (2, "back\\slash", ' leading, comma "and" quote'),
    (3, "", None),
    (4, " spaces ", '""'),
    (5, "a,b", "first\n\nthird \"x\"\nfourth"),
    (6, "plain", "é ü 漢字"),
]


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture
def tricky(spark):
    return spark.createDataFrame(TRICKY, "id int, a string, b string")


def blank_is_null(data):
    return Counter(tuple(None if v == "" else v for v in row) for row in data)


@pytest.mark.parametrize("files", [None, 1, 3])
def test_csv_round_trip(spark, tricky, tmp_path, files):
    path = str(tmp_path / "t")
    writers.write_csv(tricky, path, files)
    assert rows(readers.read_table(spark, path, tricky.schema)) == blank_is_null(TRICKY)
    assert rows(readers.read_table(spark, path)) == blank_is_null(TRICKY)
    text = readers.read_raw(spark, path)
    assert {t for _, t in text.dtypes} == {"string"}
    if files:
        assert len(list((tmp_path / "t").glob("part-*"))) <= files
    writers.write_csv(tricky.limit(1), path)
    assert readers.read_raw(spark, path).count() == 1


@pytest.mark.parametrize("split", [17, 150, 1 << 20])
def test_large_csv_equals_plain_scan(spark, tmp_path, split):
    """Splits that cut fields, quotes and line breaks anywhere change nothing."""
    many = spark.range(25).select(
        F.col("id"),
        F.expr("repeat(concat('say \"', id, '\",\n'), cast(id % 5 as int))").alias("a"),
        F.when(F.col("id") % 3 > 0, F.expr("concat('x', id, '\n\n\"\"')")).alias("b"),
        F.lit("end").alias("c"),
    )
    path = str(tmp_path / "t")
    writers.write_csv(many, path, files=2)
    expected = rows(readers.read_raw(spark, path))
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        large = records.read_large_csv(spark, path)
        assert large.columns == many.columns
        assert rows(large) == expected
        typed = records.read_large_csv(spark, path, many.schema)
        assert rows(typed) == blank_is_null(many.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_large_csv_with_windows_line_ends(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_bytes(b'a,b\r\n1,"x\r\ny"\r\n\r\n2,z\r\n3,last')
    got = rows(records.read_large_csv(spark, str(path)))
    assert got == Counter([("1", "x\r\ny"), ("2", "z"), ("3", "last")])


FIELDS = [
    "x", "", '5" pipe', '"q, 1"', '"two\nlines"', '"say ""x"""', '"a"b', '"\n\n"', '"x ""\n"" y"',
    'say "no"', ' "sp"', '"He said "no" to me"',
]


def generated_files(folder, seed, line_end):
    """Two files of records of three such fields, with blank lines in between."""
    rnd = random.Random(seed)
    for name in ("a", "b"):
        lines = [""] * (seed % 2) + ["a,b,c"]
        for _ in range(rnd.randint(3, 25)):
            lines.append(",".join(rnd.choice(FIELDS) for _ in range(3)))
            lines += [""] * (rnd.random() < 0.15)
        text = line_end.join(lines) + rnd.choice(["", line_end])
        (folder / f"{name}.csv").write_bytes(text.encode())


@pytest.mark.parametrize("split", [17, 150, 1 << 20])
@pytest.mark.parametrize("seed", range(4))
def test_large_csv_of_stray_quotes_equals_plain_scan(spark, tmp_path, split, seed):
    generated_files(tmp_path, seed, "\r\n" if seed == 3 else "\n")
    expected = rows(readers.read_raw(spark, str(tmp_path)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        assert rows(records.read_large_csv(spark, str(tmp_path))) == expected
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("seed", range(4))
def test_fields_equal_those_of_the_csv_module(spark, tmp_path, seed):
    generated_files(tmp_path, seed, "\n")
    expected = Counter()
    for path in tmp_path.glob("*.csv"):
        with open(path, newline="") as file:
            expected.update(tuple(r) for r in list(csv.reader(file))[1:])
    spark.conf.set("spark.sql.files.maxPartitionBytes", 40)
    try:
        found = records.csv_records(spark, str(tmp_path), blank=True)
        fields = found.select(repair.split_fields(F.col("record")).alias("f")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert Counter(tuple(r.f) for r in fields) == expected


def test_one_large_file_is_read_by_several_tasks(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,b\n" + "".join(f'{i},"x\ny"\n' for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 8_000)
    try:
        read = records.read_large_csv(spark, str(path))
        tasks = read.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sum(t[1] for t in tasks) == 5000 and len(tasks) > 5


HEADER = ",".join(COMPLAINTS.names) + "\n"
FILL = "1,2,3,2024-01-02,01/03/2024,CA,12345,Web,,true,,tag,resp"


def test_repair(spark, tmp_path):
    path = tmp_path / "bad.csv"
    lines = [
        f"1,{FILL},plain",
        f'2,{FILL},"quoted, text"',
        f"3,{FILL},un quoted, tail, here",
        "4,x",
        "broken narrative",
        f'5,{FILL},"multi\nline ""esc"" text"',
        f"9x,{FILL},bad id",
        f"6,x1,2,3{FILL[5:]},bad key",
        f'7,{FILL},"one ""a""", then "b, c",,"d"e, end',
        f"8,{FILL},",
        "10" + "," * 14,
        "",
    ]
    lines += [
        f'11,{FILL},"He said "no" to me"',
        f'12,{FILL},5" pipe',
        f'13,{FILL},"a ""b"", c"',
        "14,1,2,3,2024-13-45,,,,,,,,,,bad date",
        "15,1,2,3,,02/30/2024,,,,,,,,,bad date",
        "   ",
        f"16,{FILL}",
        f"17,{FILL},\"first\n\nthird\"",
        f"18,{FILL},,",
        f" 19 ,{FILL},spaces around the id",
        f"20,1,2,x{FILL[5:]},bad key",
        '"21"' + f",{FILL},quoted id",
    ]
    path.write_text(HEADER + "\n".join(lines) + "\n")
    good, rejected = repair.repair_load(spark, str(path))
    assert [(f.name, f.dataType) for f in good.schema] == [
        (f.name, f.dataType) for f in COMPLAINTS
    ]
    assert {r.complaint_id: r.complaint_narrative for r in good.collect()} == {
        1: "plain",
        2: "quoted, text",
        3: "un quoted, tail, here",
        5: 'multi\nline "esc" text',
        7: 'one "a", then "b, c",,de, end',
        8: None,
        10: None,
        11: 'He said no" to me"',
        12: '5" pipe',
        13: 'a "b", c',
        17: "first\n\nthird",
        18: ",",
        19: "spaces around the id",
        21: "quoted id",
    }
    one = {r.complaint_id: r for r in good.collect()}[1]
    assert (str(one.date_received), str(one.date_sent_to_company)) == ("2024-01-02", "2024-01-03")
    assert (one.timely_response, one.consumer_disputed, one.consumer_consent) == (True, None, None)
    assert sorted((r.reason, r.record[:6]) for r in rejected.collect()) == [
        ("date", "14,1,2"), ("date", "15,1,2"), ("fields", "16,1,2"), ("fields", "4,x"),
        ("id", ""), ("id", "   "), ("id", "9x,1,2"), ("id", "broken"), ("key", "20,1,2"),
        ("key", "6,x1,2"),
    ]
    assert repair.load_counts(good, rejected).collect() == [(14, 10)]


def test_repair_of_a_very_long_narrative(spark, tmp_path):
    path = tmp_path / "long.csv"
    text = "word, " * 60_000
    quoted = 'say ""x"", ' * 60_000
    path.write_text(f'{HEADER}1,{FILL},{text}end\n2,{FILL},"{quoted}", end\n')
    good, _ = repair.repair_load(spark, str(path))
    assert {r.complaint_id: r.complaint_narrative for r in good.collect()} == {
        1: text + "end",
        2: quoted.replace('""', '"') + ", end",
    }


def test_bulk_load(spark, tmp_path):
    (tmp_path / "p.csv").write_text("product_id,product_name,sub_product_name\n1,Loan,\n2,Card,x\n")
    stored = writers.load_dim(spark, str(tmp_path / "p.csv"), PRODUCTS, str(tmp_path / "out"))
    assert rows(stored) == Counter([(1, "Loan", None), (2, "Card", "x")])
    again = writers.load_dim(spark, str(tmp_path / "p.csv"), PRODUCTS, str(tmp_path / "out"))
    assert again.count() == 2


def test_export_keeps_column_order(spark, tmp_path):
    products = spark.createDataFrame(
        [("Loan", "x", 1)], "product_name string, sub_product_name string, product_id int"
    )
    paths = writers.export_star({"products": products}, str(tmp_path))
    assert readers.read_raw(spark, paths["products"]).columns == PRODUCTS.names


def test_written_files_are_checked(spark, tricky, tmp_path):
    paths = {f: str(tmp_path / f) for f in ("parquet", "csv")}
    writers.write_parquet(tricky, paths["parquet"])
    writers.write_csv(tricky, paths["csv"])
    for fmt, path in paths.items():
        assert writers.verify_written(tricky, path, fmt).collect() == [(fmt, 6, 6, True)]
        assert writers.verify_written(tricky.limit(2), path, fmt).collect() == [(fmt, 2, 6, False)]
    report = {r.label: r for r in writers.storage_report(spark, paths).collect()}
    for fmt, path in paths.items():
        files = [f for f in pathlib.Path(path).rglob("part-*")]
        assert report[fmt].bytes == sum(f.stat().st_size for f in files)
        assert report[fmt].files == len(files)
    assert min(r.times_smallest for r in report.values()) == 1.0


def test_views(spark, tricky):
    writers.register({"tricky_rows": tricky})
    assert spark.sql("SELECT count(*) FROM tricky_rows").first()[0] == 6
    assert ("tricky_rows",) in [tuple(r) for r in writers.list_views(spark).collect()]
    spark.catalog.dropTempView("tricky_rows")


class Recorder:
    """Stands in for a DataFrame writer: no database is started for a test."""

    def __init__(self):
        self.calls = {}
        self.write = self

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls[name] = args or kwargs
            return self

        return call


def test_jdbc_options():
    df = Recorder()
    writers.write_jdbc(df, "jdbc:x:y", "complaints", connections=4, driver="d")
    assert df.calls["format"] == ("jdbc",) and df.calls["mode"] == ("append",)
    assert df.calls["options"] == {
        "url": "jdbc:x:y", "dbtable": "complaints", "batchsize": "10000",
        "numPartitions": "4", "driver": "d",
    }
    assert "save" in df.calls


def test_spread_only_touches_scans_of_few_tasks(spark, tricky):
    few = readers.spread(tricky.coalesce(1))
    assert few.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(100, numPartitions=50).toDF("id")
    assert readers.spread(many) is many


def test_settled_tables_go_to_the_shared_folder(spark, tricky):
    folder = spark.conf.get(scratch.SETTING)
    stored = scratch.settle(tricky, "t")
    assert all(folder in f for f in stored.inputFiles())
    assert stored.schema == tricky.schema and rows(stored) == rows(tricky)


class Session:
    """The parts of a session that decide about the scratch folder."""

    def __init__(self, master, setting=None):
        self.conf = {scratch.SETTING: setting} if setting else {}
        self.sparkContext = self
        self.master, self.checkpoints = master, None

    def getCheckpointDir(self):
        return self.checkpoints

    def setCheckpointDir(self, folder):
        self.checkpoints = folder


def test_scratch_folder_is_never_machine_local_on_a_cluster():
    with pytest.raises(ValueError, match="shared"):
        scratch.shared_folder(Session("yarn"))
    cluster = Session("yarn", "hdfs:///shared")
    assert scratch.shared_folder(cluster) == cluster.checkpoints == "hdfs:///shared"
    local = Session("local[2]")
    assert scratch.shared_folder(local) == scratch.shared_folder(local) == local.checkpoints


def test_bulk_load_rejects_what_does_not_fit(spark, tmp_path):
    lines = [
        "1,Loan,x", "2,Card", "3,Card,x,y", "four,Card,x", '5,"a\nb",', ",no id,", "6,,",
        "99999999999,too large,", '7,"open', "8,inside the quotes,x",
    ]
    (tmp_path / "p.csv").write_text(",".join(PRODUCTS.names) + "\n" + "\n".join(lines) + "\n")
    done = writers.bulk_load(spark, str(tmp_path / "p.csv"), PRODUCTS, str(tmp_path / "out"))
    assert rows(done.table) == Counter(
        [(1, "Loan", "x"), (5, "a\nb", None), (None, "no id", None), (6, None, None)]
    )
    assert {r.record.strip() for r in done.rejects.collect()} == {
        "2,Card", "3,Card,x,y", "four,Card,x", "99999999999,too large,",
        '7,"open\n8,inside the quotes,x',
    }
    assert (done.loaded, done.rejected) == (4, 5)
    (tmp_path / "e.csv").write_text(",".join(PRODUCTS.names) + "\n")
    none = writers.bulk_load(spark, str(tmp_path / "e.csv"), PRODUCTS, str(tmp_path / "out"))
    assert (none.table.count(), none.rejects.count(), none.loaded, none.rejected) == (0, 0, 0, 0)


def test_every_file_is_a_scan_task(spark, tmp_path):
    """Files whose fields may span lines are not split; each is one task, and rows then spread."""
    n = spark.sparkContext.defaultParallelism
    for i in range(n):
        (tmp_path / f"{i}.csv").write_text("a,b\n" + f'{i},"x\ny"\n' * 500)
    read = readers.read_raw(spark, str(tmp_path))
    assert read.rdd.getNumPartitions() == n
    plan = readers.spread(read)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert readers.spread(readers.read_raw(spark, str(tmp_path / "0.csv"))).rdd.getNumPartitions() == n


def test_layout_prunes_folders_and_pushes_ranges(spark, tmp_path):
    path = str(tmp_path / "t")
    days = spark.range(20_000).select(
        F.col("id"),
        F.when(F.col("id") % 3 > 0, 2020).otherwise(2010 + F.col("id") % 5).cast("int").alias("year"),
        F.concat(F.lit("S"), F.col("id") % 40).alias("state"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 365).cast("int")).alias("day"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # few rows here
    try:
        writers.write_layout(days, path, ["year"], ["state", "day"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    read = readers.read_parquet(spark, path)
    assert rows(read.select(*days.columns)) == rows(days)
    found = read.where("year = 2020 AND state = 'S7' AND day < DATE'2020-03-01'")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "EqualTo(state,S7)" in plan
    assert "LessThan(day,2020-03-01)" in plan
    # The year that holds two thirds of the rows is more than one file, each a range of states.
    files = read.where("year = 2020").groupBy(F.col("_metadata.file_path").alias("f")).agg(
        F.min("state").alias("low"), F.max("state").alias("high"), F.count("*").alias("n")
    ).orderBy("low").collect()
    assert len(files) > 1 and max(f.n for f in files) < 20_000 / 3
    assert all(a.high <= b.low for a, b in zip(files, files[1:], strict=False))
    # One year is written again; the others keep their files.
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    writers.write_layout(
        days.where("year = 2012").withColumn("state", F.lit("new")), path, ["year"],
        ["state", "day"], replace_all=False,
    )
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    kept = {p: t for p, t in before.items() if "year=2012" not in str(p)}
    assert kept == {p: t for p, t in after.items() if "year=2012" not in str(p)}
    again = readers.read_parquet(spark, path)
    assert again.count() == 20_000
    assert again.where("state = 'new'").count() == days.where("year = 2012").count()


def test_fingerprint_tells_tables_apart(spark):
    base = [(1, "a", None), (2, None, "b"), (3, "", "c"), (3, "", "c")]

    def mark(data, **options):
        df = spark.createDataFrame(data, "i int, a string, b string").repartition(3)
        return writers.fingerprint(df, **options).first()

    assert mark(base) == mark(base[::-1])
    for other in (
        base[:3], [*base[:3], (3, "c", "")], [(1, None, "a"), *base[1:]], [(1, "a", "x"), *base[1:]],
        [*base[:2], (3, None, "c"), (3, "", "c")], [base[0], base[0], *base[2:]],
    ):
        assert mark(other) != mark(base)
    assert mark([(3, None, "c")], empty_is_null=True) == mark([(3, "", "c")], empty_is_null=True)
    assert mark([]) == (0, None, None)


def test_a_changed_cell_is_found_in_both_formats(spark, tricky, tmp_path):
    data = [list(r) for r in tricky.collect()]
    text = next(i for i, (_, kind) in enumerate(tricky.dtypes) if kind == "string")
    data[2][text] = "changed"
    wrong = spark.createDataFrame(data, tricky.schema)
    for fmt in ("parquet", "csv"):
        path = str(tmp_path / fmt)
        (writers.write_parquet if fmt == "parquet" else writers.write_csv)(wrong, path)
        assert writers.verify_written(tricky, path, fmt).collect() == [(fmt, 6, 6, False)]


def test_records_of_several_lines_leave_in_few_batches():
    """A batch per record made a scan of such records hundreds of times slower."""
    # Lines without a quote keep the state they begin in; the others turn it.
    lines = ['1,"a', "", 'b",2', "3,c,4", ""] * 1000
    batch = pa.RecordBatch.from_pydict({
        "file": pa.array([7] * len(lines), pa.int64()),
        "split": pa.array([0] * len(lines), pa.int64()),
        "outside_out": pa.array(['"' not in line for line in lines]),
        "inside_out": pa.array(['"' in line for line in lines]),
        "empty": pa.array([line == "" for line in lines]),
        "value": pa.array(lines),
    })
    known = SimpleNamespace(value={(7, 0): (False, True)})
    found = list(records._records(known, False, False)(iter([batch])))
    assert len(found) == 1
    # The first record is the header; blank lines between records are none.
    texts = found[0].column("record").to_pylist()
    assert texts == ["3,c,4", *['1,"a\n\nb",2', "3,c,4"] * 999]
    assert not list(records._records(known, False, True)(iter([batch])))


def test_files_hold_a_bounded_number_of_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(writers, "FILE_ROWS", 10)
    table = spark.range(35).withColumn("text", F.lit("a\nb")).coalesce(1)
    writers.write_csv(table, str(tmp_path / "csv"))
    assert len(list((tmp_path / "csv").glob("*.csv"))) == 4
    assert readers.read_raw(spark, str(tmp_path / "csv")).count() == 35
    writers.write_lines(table.select("text"), str(tmp_path / "text"))
    assert len(list((tmp_path / "text").glob("*.txt"))) == 4


def test_sinks_leave_no_shuffle_files(spark, tmp_path):
    """What was shuffled for a stored table, a sink or ids is deleted when it is written."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return {b for b in str(disk.getAllBlocks().mkString(" ")).split() if b.startswith("shuffle_")}

    def dealt():
        return spark.range(20_000).repartition(7, "id").withColumn("text", F.col("id").cast("string"))

    steps = {
        "settle": lambda: scratch.settle(dealt(), "dealt"),
        "parquet": lambda: writers.write_parquet(dealt(), str(tmp_path / "parquet")),
        "csv": lambda: writers.write_csv(dealt(), str(tmp_path / "csv")),
        "lines": lambda: writers.write_lines(dealt().select("text"), str(tmp_path / "lines")),
        "layout": lambda: writers.write_layout(
            dealt().withColumn("part", F.col("id") % 3), str(tmp_path / "layout"), ["part"], ["id"]
        ),
        "ids": lambda: assign_ids(dealt().select("text"), ["text"], "text_id"),
    }
    for name, step in steps.items():
        before = shuffled()
        step()
        for _ in range(100):
            if not shuffled() - before:
                break
            time.sleep(0.1)
        assert not shuffled() - before, name
