"""A complaint-shaped feed derived from the given order tables.

The test tables hold no complaints. This text runs unchanged in Spark and in
other SQL engines and yields the 17 columns of the raw feed, with the defects
the pipeline has to cope with: NULL key parts, name variants, broken postal
codes, impossible and missing dates.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from redress.operators.joins import fits_broadcast
from redress.sources.readers import spread

TABLES = ("lineitem", "orders", "customer", "part", "supplier", "nation", "region")

COLUMNS_SQL = """
SELECT l_orderkey * 10 + l_linenumber AS complaint_id,
       p_type AS product_name,
       CASE WHEN l_linenumber = 6 THEN NULL ELSE p_brand END AS sub_product_name,
       o_orderpriority AS issue_name,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS sub_issue_name,
       CASE l_linenumber WHEN 1 THEN lower(s_name) WHEN 2 THEN s_name || ' '
            WHEN 3 THEN s_name || ', Inc.' WHEN 4 THEN s_name || ' LLC'
            WHEN 5 THEN replace(s_name, '#', '.#') ELSE s_name END AS company_name,
       CASE WHEN l_linenumber = 7 AND l_tax = 0 THEN NULL
            ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS date_received,
       CAST(CAST(o_orderdate AS DATE) + CAST(l_partkey % 46 - 3 AS INT) AS STRING) AS date_sent_to_company,
       CASE WHEN l_linenumber = 7 THEN ' ' ELSE '' END || chr(65 + n_nationkey) || substr(r_name, 1, 1) AS state,
       CASE WHEN l_partkey % 10 = 0 THEN 'XXX' || substr(lpad(CAST(l_partkey AS STRING), 5, '0'), 1, 3)
            WHEN l_partkey % 10 = 1 THEN lpad(CAST(l_partkey AS STRING), 5, '0') || '-12'
            WHEN l_partkey % 10 = 2 THEN ' ' || lpad(CAST(l_partkey AS STRING), 5, '0')
            WHEN l_partkey % 10 = 3 THEN NULL
            ELSE lpad(CAST(l_partkey AS STRING), 5, '0') END AS zip_code,
       CASE l_linestatus WHEN 'O' THEN 'Web' ELSE c_mktsegment END AS submitted_via,
       CASE WHEN l_linenumber < 4 THEN 'Consent provided' END AS consumer_consent,
       CASE l_returnflag WHEN 'A' THEN 'Yes' WHEN 'R' THEN 'No' END AS timely_response,
       CASE WHEN l_returnflag = 'R' AND n_nationkey % 2 = 0 THEN 'Yes' ELSE 'N/A' END AS consumer_disputed,
       CASE l_linenumber WHEN 2 THEN 'Older American, Servicemember' WHEN 3 THEN 'Older American'
            WHEN 4 THEN 'Servicemember' END AS tags,
       CASE WHEN l_discount > 0.05 THEN 'Company responded' END AS company_response,
       'bought ' || p_name || ', then "returned" it' AS complaint_narrative
"""

FEED_SQL = (
    COLUMNS_SQL
    + """FROM   {lineitem}
JOIN   {orders}   ON l_orderkey  = o_orderkey
JOIN   {customer} ON o_custkey   = c_custkey
JOIN   {part}     ON l_partkey   = p_partkey
JOIN   {supplier} ON l_suppkey   = s_suppkey
JOIN   {nation}   ON s_nationkey = n_nationkey
JOIN   {region}   ON n_regionkey = r_regionkey
"""
)


_ZIP = COLUMNS_SQL[COLUMNS_SQL.index("CASE WHEN l_partkey % 10 = 0"):COLUMNS_SQL.index(" AS zip_code")]
#: Terms of ``COLUMNS_SQL`` over one table, worked out before the joins, once per row of
#: that table: name, term, table. Lines move with their terms in place of the numbers.
TERMS = (
    ("_untaxed", "l_tax = 0", "lineitem"),
    ("_discounted", "l_discount > 0.05", "lineitem"),
    ("_day", "CAST(o_orderdate AS DATE)", "orders"),
    ("_name_lower", "lower(s_name)", "supplier"),
    ("_name_spaced", "s_name || ' '", "supplier"),
    ("_name_inc", "s_name || ', Inc.'", "supplier"),
    ("_name_llc", "s_name || ' LLC'", "supplier"),
    ("_name_dotted", "replace(s_name, '#', '.#')", "supplier"),
    ("_state", "chr(65 + n_nationkey) || substr(r_name, 1, 1)", "supplier"),
    ("_zip", _ZIP, "part"),
)


#: What the joins and ``COLUMNS_SQL`` need of a line besides its terms.
LINE = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus")


def _terms(table: str) -> list[str]:
    """The terms over ``table``; of a part, whose key is that of its lines."""
    return [
        f"{sql.replace('l_partkey', 'p_partkey')} AS {name}" for name, sql, of in TERMS if of == table
    ]


def _named_columns() -> str:
    """``COLUMNS_SQL`` with the names of the terms in their places."""
    out = COLUMNS_SQL
    for name, sql, _ in TERMS:
        out = out.replace(sql, name)
    return out


def feed(spark: SparkSession, folder: str) -> DataFrame:
    """The feed over the Parquet tables in ``folder``, with canonical names.

    The joins of ``FEED_SQL`` in another order: orders meet their customers before the
    lines, so the lines are shuffled twice, by order and by part. Suppliers with their
    nations are broadcast if they are small enough, after they have been measured.
    What depends on the order, part or supplier alone is worked out before the joins; of
    suppliers that fit a broadcast only without their terms, it is worked out after them.
    """
    t = {name: spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet") for name in TABLES}
    lines = spread(t["lineitem"].selectExpr(*LINE, *_terms("lineitem")))
    places = t["nation"].join(F.broadcast(t["region"]), F.expr("n_regionkey = r_regionkey"))
    named = t["supplier"].join(F.broadcast(places), F.expr("s_nationkey = n_nationkey")).select(
        "s_suppkey", "s_name", "n_nationkey", "r_name"
    )
    suppliers, later = named.selectExpr(*named.columns[:-1], *_terms("supplier")), []
    if fits_broadcast(suppliers):
        suppliers = F.broadcast(suppliers)
    elif fits_broadcast(named):
        suppliers, later = F.broadcast(named), _terms("supplier")
    bought = t["orders"].join(t["customer"], F.expr("o_custkey = c_custkey")).selectExpr(
        "o_orderkey", "o_orderstatus", "o_orderpriority", "c_mktsegment", *_terms("orders")
    )
    parts = t["part"].selectExpr("p_partkey", "p_type", "p_brand", "p_name", *_terms("part"))
    joined = (
        lines.join(bought, F.expr("l_orderkey = o_orderkey"))
        .drop("o_orderkey")
        .join(parts, F.expr("l_partkey = p_partkey"))
        .join(suppliers, F.expr("l_suppkey = s_suppkey"))
        .selectExpr("*", *later)
    )
    return spark.sql(_named_columns() + "FROM {joined}", joined=joined)


def feed_query() -> str:
    """The same query over tables of those names, as plain SQL."""
    return FEED_SQL.format(**{t: t for t in TABLES})
