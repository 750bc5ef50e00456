"""Joins of the fact table to its dimensions.

A dimension is broadcast only after its size has been measured. A larger one
is shuffled, with the keys that hold more rows than a task should get salted:
in proportion to their rows, so that no task receives all rows of one key.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    AtomicType,
    BinaryType,
    MapType,
    StringType,
    StructType,
    VariantType,
)

from redress.sources.scratch import freed_shuffles, settle

BROADCAST_BYTES = 64 << 20
ROW = "_row"
BUCKET_ROWS = 500_000  # rows of a bucket, which one task sorts
LEAST_BUCKETS = 8
SALTS_PER_SHARE = 2  # pieces a hot key is cut into per even share of a task

Keys = Sequence[str | tuple[str, str]]


def measured_bytes(df: DataFrame) -> int:
    """In-memory size of the rows of ``df``, from one aggregate over it.

    Text and binary values count their bytes. Arrays, maps, structs and variants count eight
    bytes per character of their JSON form, which has a character at least for every
    value and its separator, so they are not measured too small.
    """
    sizes = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (StringType, BinaryType)):
            sizes.append(F.octet_length(c))
        elif isinstance(f.dataType, (ArrayType, MapType, StructType, VariantType)):
            options = {"ignoreNullFields": "false"}
            sizes.append(8 * F.octet_length(F.to_json(F.struct(c.alias("v")), options)))
        elif not isinstance(f.dataType, AtomicType):
            raise TypeError(f"can't measure {f.name}: {f.dataType.simpleString()}")
    sizes = [F.coalesce(size, F.lit(0)).cast("long") for size in sizes]
    row = reduce(lambda a, b: a + b, sizes, F.lit(16 + 16 * len(df.columns)))
    return df.agg(F.sum(row.cast("long"))).first()[0] or 0


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return measured_bytes(df) <= limit


def _pairs(on: Keys) -> list[tuple[str, str]]:
    return [(k, k) if isinstance(k, str) else tuple(k) for k in on]


def _equal(a: Column, b: Column, null_safe: bool) -> Column:
    return a.eqNullSafe(b) if null_safe else a == b


def dim_join(
    fact: DataFrame,
    dim: DataFrame,
    on: Keys,
    how: str = "left",
    null_safe: bool = False,
    limit: int = BROADCAST_BYTES,
    keys_of: DataFrame | None = None,
    salt: str | None = None,
) -> DataFrame:
    """Join ``fact`` to ``dim`` on equal keys; the dimension's keys are dropped.

    ``on`` lists key columns, or (fact column, dimension column) pairs where
    the names differ. Key columns of the result are those of the fact. Where
    ``fact`` is itself the result of joins, ``keys_of`` names the table its
    keys came from: hot keys are then counted there, with no join repeated.
    ``salt`` names a column of ``fact`` that differs from row to row, by which hot
    keys are spread; see ``numbered`` for what happens without.
    """
    pairs = _pairs(on)
    names = {d: f"_dim_{i}" for i, (_, d) in enumerate(pairs)}
    if how in ("left_anti", "left_semi"):
        dim = dim.select(*names).dropDuplicates()
    dim = dim.withColumnsRenamed(names)
    match = [_equal(fact[f], dim[names[d]], null_safe) for f, d in pairs]
    if fits_broadcast(dim, limit):
        return fact.join(F.broadcast(dim), match, how).drop(*names.values())
    hot = hot_keys(fact if keys_of is None else keys_of, [f for f, _ in pairs])
    own = [(f, names[d]) for f, d in pairs]
    if salt is not None:
        return _salted_join(fact, dim, own, how, null_safe, hot, F.col(salt))
    return _salted_join(numbered(fact), dim, own, how, null_safe, hot, F.col(ROW)).drop(ROW)


def numbered(fact: DataFrame) -> DataFrame:
    """``fact`` with a number per row that a repeated task gives again.

    It is made of the file (a hash of its name) and the row index where ``fact`` is a
    scan of stored rows, so equal rows differ and no other column has to be read. Any
    other plan is stored first.
    """
    number = F.struct(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
    )
    try:
        return fact.withColumn(ROW, number)
    except AnalysisException:
        return settle(fact, "fact").withColumn(ROW, number)


def hot_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored keys with more rows than an even share of a shuffle task, and their salts.

    With p shuffle partitions a key is hot from 1/p of all rows, so no more
    than p exist, and they get at most (SALTS_PER_SHARE + 1) * p salts
    together, however the rows are spread.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n").alias("_total"))
    shares = F.col("_n") * tasks
    salts = F.ceil(shares * SALTS_PER_SHARE / total.scalar()).cast("int")
    return settle(
        counts.where(shares >= total.scalar()).select(
            *[F.col(k).alias(f"_hot_{i}") for i, k in enumerate(keys)], salts.alias("_salts")
        ),
        "hot-keys",
    )


def _salted_join(fact, dim, pairs, how, null_safe, hot, row) -> DataFrame:
    keys = [f for f, _ in pairs]
    hot = F.broadcast(hot)
    hot_names = [f"_hot_{i}" for i in range(len(keys))]

    salted = (
        fact.join(hot, [fact[k].eqNullSafe(hot[h]) for k, h in zip(keys, hot_names)], "left")
        .withColumn(
            "_salt",
            F.when(
                F.col("_salts").isNotNull(),
                F.pmod(F.xxhash64(row), F.col("_salts")).cast("int"),
            ).otherwise(F.lit(0)),
        )
        .drop(*hot_names, "_salts")
    )
    copies = F.sequence(F.lit(0), F.coalesce(F.col("_salts") - 1, F.lit(0)))
    spread_dim = (
        dim.join(hot, [dim[d].eqNullSafe(hot[h]) for (_, d), h in zip(pairs, hot_names)], "left")
        .withColumn("_dim_salt", F.explode(copies))
        .drop(*hot_names, "_salts")
    )
    match = [_equal(salted[f], spread_dim[d], null_safe) for f, d in pairs]
    match.append(salted["_salt"] == spread_dim["_dim_salt"])
    return salted.join(spread_dim, match, how).drop("_salt", "_dim_salt", *[d for _, d in pairs])


def star_join(
    fact: DataFrame, dims: Sequence[tuple[DataFrame, str]], limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Inner join to each (dimension, key)."""
    return _join_all(fact, dims, "inner", limit)


def denormalize(
    fact: DataFrame, dims: Sequence[tuple[DataFrame, str]], limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Left join to each (dimension, key): every fact row stays."""
    return _join_all(fact, dims, "left", limit)


def _join_all(fact, dims, how, limit) -> DataFrame:
    fits = [fits_broadcast(dim, limit) for dim, _ in dims]
    if all(fits):
        return reduce(lambda df, d: dim_join(df, d[0], [d[1]], how, limit=limit), dims, fact)
    columns = [*fact.columns, *[c for dim, key in dims for c in dim.columns if c != key]]
    if fits.count(False) == 1 and len({c.lower() for c in columns}) == len(columns):
        # The wide rows go to the large dimension themselves, once, and then get the others'
        # columns where they are.
        ordered = [d for _, d in sorted(zip(fits, dims, strict=True), key=lambda x: x[0])]
        joined = reduce(
            lambda df, d: dim_join(df, d[0], [d[1]], how, limit=limit, keys_of=fact, salt=ROW),
            ordered,
            numbered(fact),
        )
        return joined.select(*[f"`{c}`" for c in columns])
    # Rows are numbered while they still are a scan. Only numbers and keys go through the
    # salted joins; the wide columns move once, to their own row of what was found.
    rows = numbered(fact)
    keys = list(dict.fromkeys(key for _, key in dims))
    found = reduce(
        lambda df, d: dim_join(df, d[0], [d[1]], how, limit=limit, keys_of=fact, salt=ROW),
        dims,
        rows.select(ROW, *keys),
    )
    return meet_rows(rows, found.drop(*keys)).drop(ROW)


def meet_rows(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` with what was found for their numbers; the wide side is dealt, not sorted."""
    return rows.join(found.hint("shuffle_hash"), ROW)


def lookup_id(
    fact: DataFrame,
    dim: DataFrame,
    keys: Keys,
    null_safe: bool = True,
    limit: int = BROADCAST_BYTES,
    keys_of: DataFrame | None = None,
    salt: str | None = None,
) -> DataFrame:
    """Add the surrogate id of ``dim`` by natural key.

    ``null_safe`` decides whether a NULL key part finds the dimension row that
    has NULL there, or nothing (plain equality).
    """
    return dim_join(fact, dim, keys, "left", null_safe, limit, keys_of, salt)


def orphans(
    fact: DataFrame, dim: DataFrame, key: str, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Fact rows without a partner in ``dim``, those with a NULL key included."""
    return dim_join(fact, dim, [key], "left_anti", limit=limit)


def bucket_count(df: DataFrame) -> int:
    """How many buckets keep the rows of one at some ``BUCKET_ROWS``, however large ``df`` is."""
    return max(LEAST_BUCKETS, -(-df.count() // BUCKET_ROWS))


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str) -> DataFrame:
    """Store ``df`` as a table of ``buckets`` by ``key``, each file sorted by it.

    Tables of as many buckets by the same key join without a shuffle, however often; one
    shuffle is paid here. A bucket is read by one task, so this is for keys none of which
    holds a large share of the rows (surrogate keys of a dimension, ids of a fact); for
    others there is ``star_join``.
    """
    with freed_shuffles(df.sparkSession):
        (
            df.repartition(buckets, key)
            .write.mode("overwrite")
            .bucketBy(buckets, key)
            .sortBy(key)
            .option("path", path)
            .saveAsTable(table)
        )
    return df.sparkSession.table(table)


def bucketed_join(fact: DataFrame, dim: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join two tables of ``write_bucketed`` on their key by merging their buckets."""
    return fact.join(dim.hint("merge"), key, how)
