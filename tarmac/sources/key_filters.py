"""Bloom filters of stored business keys, one per month, kept beside the flights.

A filter is a table with a row for each of its 64-bit words. A key sets BITS_SET bits of one
word, so that telling whether it may be stored takes one look-up, an equi-join by month and
word whose filter side is a few bytes a stored key; Spark broadcasts it while it is small
enough, and beyond that hashes each part of it, so that the asking rows are not sorted. A key that was put in is always told; of others, about one in a hundred is told as
well, and meets the stored keys like before.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.operators.ingest import SORTED_KEY, SOURCE_COLUMNS, first_per_key, insert_flights
from tarmac.operators.quality import BUSINESS_KEY
from tarmac.sources import files, tables

#: Bits of a filter for each key when it is full (it is made for twice the keys), and bits that a key sets.
BITS_PER_KEY, BITS_SET = 16, 4
#: Words up to which Spark is left to choose, which broadcasts some 10 MB: about 9 to 12 bytes a stored word.
WORDS_TO_BROADCAST = 1_000_000
FILTER_SCHEMA = "word BIGINT, bits BIGINT, size BIGINT, keys BIGINT, flight_month STRING"


def words_for(keys: int) -> int:
    return max(1, -(-keys * BITS_PER_KEY // 64))


def _by_month(values: dict[str, int], otherwise: int) -> Column:
    """A number for each month; months are at most twelve per declared year and the default one."""
    if not values:
        return F.lit(otherwise).cast("long")
    known = F.create_map(*[F.lit(x) for pair in sorted(values.items()) for x in pair])
    return F.coalesce(known[F.col("flight_month")], F.lit(otherwise)).cast("long")


def _placed(rows: DataFrame, size: Column) -> DataFrame:
    """Rows with the word and the bits of their business key (_word, _bits).

    NULLs leave the hash as it is, which makes some unlike keys alike and loses none.
    """
    hashed = rows.withColumn("_hash", F.xxhash64(*BUSINESS_KEY))
    places = [f"shiftleft(1L, CAST(shiftrightunsigned(_hash, {6 * i}) & 63 AS INT))" for i in range(BITS_SET)]
    word = F.pmod(F.xxhash64("_hash"), size)
    return hashed.withColumns({"_word": word, "_bits": F.expr(" | ".join(places))}).drop("_hash")


def _put(keys: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """The bits of keys (with flight_month) by month and word; they combine in the map tasks."""
    return _placed(keys.select(*BUSINESS_KEY, "flight_month"), _by_month(sizes, 1)).groupBy(
        "flight_month", F.col("_word").alias("word")).agg(F.expr("bit_or(_bits) AS bits"))


def _counts(keys: DataFrame) -> dict[str, int]:
    return {r["flight_month"]: r["count"] for r in keys.groupBy("flight_month").count().collect()}


def _filter_rows(words: DataFrame, sizes: dict[str, int], keys: dict[str, int]) -> DataFrame:
    return words.select(
        "word", "bits", _by_month(sizes, 1).alias("size"), _by_month(keys, 0).alias("keys"), "flight_month")


def key_filters(keys: DataFrame) -> DataFrame:
    """Filters of rows with a business key and a flight_month: one row per month and word."""
    counts = _counts(keys)
    sizes = {month: words_for(2 * n) for month, n in counts.items()}
    return _filter_rows(_put(keys, sizes), sizes, counts)


def _write(filters: DataFrame, root: str) -> None:
    (
        filters.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("flight_month").parquet(root)
    )


def rebuild_filters(spark: SparkSession, path: str, root: str, months: Sequence[str] | None = None) -> None:
    """Filters of some months of a flights table (None: all), made afresh from its stored keys.

    Call it for the months that were replaced. A filter left from before tells keys that are
    gone, which costs time; keys that were added unseen would be missed, so appends go through
    `append_filtered`, or are followed by this.
    """
    flights = tables.read_flights(spark, path)
    if months is not None:
        flights = flights.filter(F.col("flight_month").isin(*months))
    _write(key_filters(flights.select(*BUSINESS_KEY, "flight_month")), root)
    for month in months or ():
        if flights.filter(F.col("flight_month") == month).isEmpty():
            files.delete(spark, f"{root}/flight_month={month}")


def read_filters(spark: SparkSession, root: str) -> DataFrame:
    if not files.child_names(spark, root):
        return spark.createDataFrame([], FILTER_SCHEMA)
    return spark.read.schema(FILTER_SCHEMA).parquet(root)


def _known(filters: DataFrame) -> dict[str, tuple[int, int]]:
    """Words and keys of each month's filter."""
    return {r["flight_month"]: (r["size"], r["keys"]) for r in filters.select("flight_month", "size", "keys").distinct().collect()}


def with_may_be_stored(rows: DataFrame, filters: DataFrame) -> DataFrame:
    """Add `may_be_stored`: false is certain. Rows need a business key and a flight_month.

    A word that many rows ask for is one row of the filter, so the hashed parts stay even.
    """
    sizes = {month: size for month, (size, _) in _known(filters).items()}
    asked = _placed(rows, _by_month(sizes, 1))
    held = filters.selectExpr("flight_month", "word AS _word", "bits AS _held")
    if sum(sizes.values()) > WORDS_TO_BROADCAST:
        held = held.hint("shuffle_hash")
    return asked.join(held, ["flight_month", "_word"], "left").select(
        *rows.columns, F.expr("coalesce(_held & _bits = _bits, FALSE)").alias("may_be_stored"))


def new_flights_filtered(
    arriving: DataFrame, path: str, root: str, years: Iterable[int], order: Sequence[str] = SOURCE_COLUMNS
) -> DataFrame:
    """The arriving rows whose business key is new to the table, as `tables.new_flights` gives them.

    Only rows that may be stored meet stored keys, and only months and days that such rows have
    are read for them. The rows are staged with their mark, so the filters are asked once.
    """
    spark = arriving.sparkSession
    stage = f"{root.rstrip('/')}_staged"
    filters = read_filters(spark, root)
    rows = with_may_be_stored(tables.with_partition(arriving, tables.check_years(years)), filters)
    # a stored month without a filter may hold any key
    stored_months = {name.split("=", 1)[1] for name in files.child_names(spark, path) if name.startswith("flight_month=")}
    unfiltered = F.col("flight_month").isin(*stored_months.difference(_known(filters)))
    rows = rows.withColumn("may_be_stored", F.col("may_be_stored") | unfiltered)
    tables.publish(rows, stage, "marked")
    rows = tables.read_current(spark, stage, "marked")
    certain = first_per_key(rows.filter("NOT may_be_stored").drop("may_be_stored"), SORTED_KEY, order)
    doubtful = rows.filter("may_be_stored").drop("may_be_stored")
    # at most the days of the declared years, and those without
    days = [r[0] for r in doubtful.select("flight_date").distinct().collect()]
    if not days:
        return certain.drop("flight_month")
    stored = tables.read_flights(spark, path).filter(F.col("flight_month").isin(*tables.months_of(doubtful)))
    if None not in days:
        stored = stored.filter(F.col("flight_date").isin(*days))
    return certain.unionByName(insert_flights(doubtful, stored, order)).drop("flight_month")


def append_filtered(
    arriving: DataFrame, path: str, root: str, years: Iterable[int], order: Sequence[str] = SOURCE_COLUMNS
) -> None:
    """Append the rows whose business key is new, and put their keys into the filters.

    Filters are written before the flights: a call that fails between leaves keys that are told
    although they are not stored, never the reverse. A month with more keys than its filter was
    made for gets a filter of new size from its stored keys.
    """
    spark, years = arriving.sparkSession, list(years)
    stage = f"{root.rstrip('/')}_staged"
    tables.publish(new_flights_filtered(arriving, path, root, years, order), stage, "new")
    new = tables.read_current(spark, stage, "new")
    keys = tables.with_partition(new, years).select(*BUSINESS_KEY, "flight_month")
    added, filters = _counts(keys), read_filters(spark, root)
    if not added:
        return
    known = _known(filters)
    full = [m for m, n in added.items() if m not in known or words_for(known[m][1] + n) > known[m][0]]
    rest = {m: known[m][0] for m in added if m not in full}
    made = filters.limit(0)
    if full:
        both = keys.filter(F.col("flight_month").isin(*full))
        if files.child_names(spark, path):
            stored = tables.read_flights(spark, path).filter(F.col("flight_month").isin(*full))
            both = both.unionByName(stored.select(*BUSINESS_KEY, "flight_month"))
        made = key_filters(both)
    if rest:
        touched = F.col("flight_month").isin(*rest)
        words = filters.filter(touched).select("flight_month", "word", "bits").unionByName(_put(keys.filter(touched), rest))
        words = words.groupBy("flight_month", "word").agg(F.expr("bit_or(bits) AS bits"))
        made = made.unionByName(_filter_rows(words, rest, {m: known[m][1] + added[m] for m in rest}))
    tables.publish(made, stage, "filters")
    _write(tables.read_current(spark, stage, "filters"), root)
    tables.write_flights(new, path, years)
    for name in ("marked", "new", "filters"):
        tables.prune(spark, stage, name, keep=1)
