"""Load of a fact CSV with malformed rows.

Narratives in such a file may be unquoted: commas in them make a row too long,
line breaks leave fragments. A row too long is repaired, by joining the
surplus fields to the narrative; fragments are rejected with the reason.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from redress.functions.dates import parse_date
from redress.functions.text import safe_int, true_flag
from redress.operators.relational import enforce
from redress.schema import COMPLAINTS
from redress.sources.readers import CSV, spread
from redress.sources.scratch import settle

_LAST = COMPLAINTS.names[-1]
_FIELDS = len(COMPLAINTS)
#: Fields of a record at most; the parser keeps a place for each.
MAX_FIELDS = 1_000_000
_ONE, _RECORD = "_one", "_record"
_DATES = ("date_received", "date_sent_to_company")
# A quoted part with doubled quotes, and what follows it. A quote that is never
# closed opens a part all the same.
_QUOTED = r'(?s)^"((?:[^"]++|"")*+)(?:"|$)(.*)$'
_SPLIT = r'(?s),((?:"(?:[^"]++|"")*+"[^,]*+|".*+|[^",][^,]*+|))'


def _unquoted(field: Column) -> Column:
    """A field's text: quotes count only where they open the field."""
    inner = F.replace(F.regexp_extract(field, _QUOTED, 1), F.lit('""'), F.lit('"'))
    return F.when(
        F.startswith(field, F.lit('"')), F.concat(inner, F.regexp_extract(field, _QUOTED, 2))
    ).otherwise(field)


def split_fields(record: Column) -> Column:
    """All fields of a record, however many, by one rule of quoting.

    A blank record has no field.
    """
    # A comma in front, so that no match is empty.
    found = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(_SPLIT), F.lit(1))
    return F.when(record == "", F.array().cast("array<string>")).otherwise(
        F.transform(found, _unquoted)
    )


def _records(spark: SparkSession, path: str | list[str], header: bool) -> DataFrame:
    """``record``: the text of every record that is not blank.

    Spark's reader finds the records. A schema of one column makes each record of
    two fields or more a corrupt one, whose text it keeps; a record of one field is
    written again as a quoted file would have it.
    """
    read = (
        spark.read.schema(f"{_ONE} string, {_RECORD} string")
        .options(**CSV, maxColumns=MAX_FIELDS, mode="PERMISSIVE", columnNameOfCorruptRecord=_RECORD)
        .option("header", header)
        .csv(path)
    )
    only = F.coalesce(_ONE, F.lit(""))
    quoted = F.concat(F.lit('"'), F.replace(only, F.lit('"'), F.lit('""')), F.lit('"'))
    alone = F.when(only.rlike('[",\r\n]'), quoted).otherwise(only)
    return read.select(F.coalesce(_RECORD, alone).alias("record"))


def _blank_records(
    spark: SparkSession, path: str | list[str], rows: DataFrame, header: bool
) -> DataFrame:
    """A row for every blank line between records, which Spark's reader passes over.

    They are the lines of the files less those of the records; a header is one line.
    """
    lines = spark.read.text(path).groupBy(F.col("_metadata.file_path")).agg(
        F.count("*").alias("lines"), F.max(F.col("value") != "").alias("filled")
    )
    heads = F.count_if("filled") if header else F.lit(0)
    total = lines.agg(F.coalesce(F.sum("lines"), F.lit(0)) - heads).first()[0]
    blank = total - (rows.agg(F.sum("_lines")).first()[0] or 0)
    return spark.range(blank).select(F.lit("id").alias("reason"), F.lit("").alias("record"))


def repair_load(
    spark: SparkSession, path: str | list[str], header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(good, rejected) rows of a 15-column fact CSV.

    ``good`` has the schema of the fact table; ``rejected`` has the reason
    ('id', 'fields', 'key' or 'date') and the record. Blank lines are records
    without an id. Every record of the files is in one of the two. A file is read by
    one task, so the work spreads over files. Spark parses the fields; only records of
    another length and those with a field that begins with a quote once it is parsed
    (text after a closing quote, or a quote in the text) are split by ``split_fields``.
    The fields are stored, so both results can be used freely. A record holds up to
    ``MAX_FIELDS`` fields; more are an error.
    """
    names = COMPLAINTS.names
    parsed = F.from_csv(
        "record",
        ", ".join(f"{c} string" for c in [*names, _RECORD]),
        {"escape": '"', "columnNameOfCorruptRecord": _RECORD, "maxColumns": str(MAX_FIELDS)},
    )
    fields = spread(_records(spark, path, header)).withColumn("_parsed", parsed)
    odd = F.coalesce(F.col("_parsed")[_RECORD].isNotNull(), F.lit(True))
    for c in names:
        odd |= F.coalesce(F.startswith(F.col("_parsed")[c], F.lit('"')), F.lit(False))
    fields = fields.withColumn("_fields", F.when(odd, split_fields(F.col("record"))))
    own = F.col("_fields")
    tail = F.array_join(F.slice(own, _FIELDS, F.greatest(F.size(own) - _FIELDS + 1, F.lit(0))), ",")
    split = {**{c: F.get(own, i) for i, c in enumerate(names[:-1])},
             _LAST: F.when(F.size(own) >= _FIELDS, tail)}
    named = fields.withColumns({
        c: F.when(own.isNull(), F.col("_parsed")[c]).otherwise(split[c]) for c in names
    })
    bad_key, bad_date = F.lit(False), F.lit(False)
    for c in ("product_id", "issue_id", "company_id"):
        bad_key |= (F.col(c) != "") & safe_int(F.col(c)).isNull()
    for c in _DATES:
        bad_date |= (F.col(c) != "") & parse_date(F.col(c)).isNull()
    reason = (
        F.when(safe_int(F.col("complaint_id"), "bigint").isNull(), "id")
        .when(own.isNotNull() & (F.size(own) < _FIELDS), "fields")
        .when(bad_key, "key")
        .when(bad_date, "date")
    )
    # The text of a record is kept only where it is rejected.
    rows = settle(
        named.withColumn("_reason", reason).select(
            *[F.when(F.col("_reason").isNull(), F.col(c)).alias(c) for c in COMPLAINTS.names],
            "_reason",
            F.when(F.col("_reason").isNotNull(), F.col("record")).alias("record"),
            (F.regexp_count("record", F.lit("\r\n|\r|\n")) + 1).alias("_lines"),
        ),
        "repair",
    )
    texts = [f.name for f in COMPLAINTS if f.dataType.simpleString() == "string"]
    good = rows.where(F.col("_reason").isNull()).withColumns({
        **{c: F.nullif(F.col(c), F.lit("")) for c in texts},
        **{c: parse_date(F.col(c)) for c in _DATES},
        "timely_response": true_flag(F.col("timely_response")),
        "consumer_disputed": true_flag(F.col("consumer_disputed")),
    })
    rejected = rows.where(F.col("_reason").isNotNull()).select(
        F.col("_reason").alias("reason"), "record"
    ).unionByName(_blank_records(spark, path, rows, header))
    return enforce(good, COMPLAINTS), rejected


def load_counts(good: DataFrame, rejected: DataFrame) -> DataFrame:
    """One row: rows loaded and rows skipped."""
    loaded = good.agg(F.count("*").alias("loaded"))
    skipped = rejected.agg(F.count("*").alias("skipped"))
    return loaded.select("loaded", skipped.scalar().alias("skipped"))
