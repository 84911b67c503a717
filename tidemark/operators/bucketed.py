"""The raw store laid out by (entity, year) buckets: a catalogue table that LAG, upsert and the period marts read in place.

Rows of one entity and year lie in one bucket, sorted by date, so a window, an aggregate or a join by these two columns needs no
shuffle of the table; an entity with many rows spreads over its years. ``rate_part`` (the year as a folder) prunes reads and upserts
to the years that they touch, and each year is switched as a whole, as the months of ``operators.tables`` are. Every bucket holds
codes from the whole range, which minima and maxima cannot tell apart, so files carry Parquet bloom filters of ``currency_code``
where its dictionary outgrows a page: a look-up of one entity skips the row groups without it.

Buckets: at least the session's shuffle partitions (the default), else Spark takes its own number and shuffles; a bucket of a year should be
some hundred megabytes. Rows without a date have no year and cannot be stored (the raw schema forbids them)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.numeric import pct_change
from tidemark.functions.series import with_previous_in_blocks
from tidemark.operators import marts
from tidemark.operators.store import one_per_key
from tidemark.operators.tables import _catalogue, _folders, _switch, ensure_database, fs_path
from tidemark.schema import RAW_COLUMNS, RAW_SCHEMA

PART = ("rate_part",)
BUCKET = ("currency_code", "rate_year")
ORDER = (*BUCKET, "rate_date", "rate_type")
#: distinct codes that the bloom filter of one row group is sized for; more of them only make it let more through
EXPECTED_CODES = 100_000
#: joins by the whole key may use a partitioning by a part of it, here the buckets
_BY_PART_OF_KEY = "spark.sql.requireAllClusterKeysForCoPartition"


def bloom_options(column: str = "currency_code", expected: int = EXPECTED_CODES) -> dict[str, str]:
    """Writer options for a Parquet bloom filter of ``column``."""
    return {f"parquet.bloom.filter.enabled#{column}": "true", f"parquet.bloom.filter.expected.ndv#{column}": str(expected)}


def with_year(df: DataFrame) -> DataFrame:
    """Raw columns with the year as bucket column and as folder."""
    year = F.year("rate_date")
    return df.select(*RAW_COLUMNS, year.alias("rate_year"), year.cast("string").alias("rate_part"))


def buckets_of(spark: SparkSession, table: str) -> int:
    """Number of buckets that the catalogue has for the table."""
    database, name = table.split(".")
    return spark._jsparkSession.sessionState().catalog().externalCatalog().getTable(database, name).bucketSpec().get().numBuckets()


def create(spark: SparkSession, table: str, base: str, buckets: int | None = None) -> None:
    """The empty table ``database.name`` below ``base``, if the catalogue has none."""
    database, name = table.split(".")
    ensure_database(spark, database, base)
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RAW_SCHEMA.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}, rate_year INT, rate_part STRING) USING parquet PARTITIONED BY (rate_part) "
              f"CLUSTERED BY ({', '.join(BUCKET)}) SORTED BY ({', '.join(ORDER)}) INTO {buckets} BUCKETS LOCATION '{base.rstrip('/')}/{name}'")


def _write(spark: SparkSession, table: str, rows: DataFrame, options: dict | None) -> dict[tuple[str], str]:
    """Write ``rows`` in the table's buckets to a new version folder; the folder of each year. Spark writes buckets only into tables, so
    the folder is one of its own for as long as the write lasts."""
    version = f"{_catalogue(spark, table, PART)[0]}/v_{uuid.uuid4().hex}"
    own = f"{table.split('.')[0]}.w_{uuid.uuid4().hex}"
    (rows.write.options(**{**bloom_options(), **(options or {})}).option("path", version)
     .partitionBy(*PART).bucketBy(buckets_of(spark, table), *BUCKET).sortBy(*ORDER).saveAsTable(own))
    spark.sql(f"DROP TABLE {own}")  # external: the files stay
    return {(at.rsplit("=", 1)[1],): at for at in _folders(spark, version) if "=" in at.rsplit("/", 1)[1]}


def load(spark: SparkSession, table: str, rows: DataFrame, base: str, buckets: int | None = None, options: dict | None = None) -> None:
    """Put raw ``rows`` into the table, created if absent; the years that they touch are replaced. The one shuffle puts a bucket
    into one task, so a year has one file a bucket. ``options`` are further options of the Parquet writer."""
    create(spark, table, base, buckets)
    laid = with_year(rows).repartition(buckets_of(spark, table), *BUCKET)
    _switch(spark, table, _write(spark, table, laid, options), PART)


def merged(target: DataFrame, new: DataFrame) -> DataFrame:
    """``target`` with the rows ``new`` (one a key) in the place of those with the same key, by one full join in the target's buckets;
    ``_old`` and ``_new`` tell where a row comes from."""
    key = [*BUCKET, "rate_date", "rate_type"]
    rest = [c for c in (*RAW_COLUMNS, "rate_part") if c not in key]
    t = target.select(*key, F.struct(*rest).alias("_t"))
    n = new.select(*key, F.struct(*rest).alias("_n"))
    joined = t.join(n, key, "full_outer")
    pick = F.coalesce("_n", "_t")
    return joined.select(*[F.col(c) if c in key else pick[c].alias(c) for c in (*RAW_COLUMNS, "rate_year", "rate_part")],
                         F.col("_t").isNotNull().alias("_old"), F.col("_n").isNotNull().alias("_new"))


def upsert(spark: SparkSession, table: str, batch: DataFrame, as_of, seq=None, options: dict | None = None) -> dict:
    """Upsert ``batch`` into the table, rewriting only the years that it touches; returns the inserted and updated keys, counted in
    the pass that writes. Only the batch, one row a key and staged once, is shuffled. A cut-off upsert is completed by running it again;
    one writer at a time; old folders stay for :func:`vacuum`."""
    staged = f"{_catalogue(spark, table, PART)[0]}_staged/{uuid.uuid4().hex}"
    new = with_year(one_per_key(batch, as_of, seq))
    new.write.parquet(staged)
    new = spark.read.schema(new.schema).parquet(staged)
    years = sorted(r["rate_part"] for r in new.select(*PART).distinct().collect())
    counts = {"inserted": 0, "updated": 0}
    if years:
        seen = Observation()
        before = spark.conf.get(_BY_PART_OF_KEY)
        spark.conf.set(_BY_PART_OF_KEY, "false")
        try:
            rows = merged(spark.table(table).filter(F.col("rate_part").isin(years)), new)
            rows = rows.observe(seen, F.count_if(F.col("_new") & ~F.col("_old")).alias("inserted"),
                                F.count_if(F.col("_new") & F.col("_old")).alias("updated")).drop("_old", "_new")
            folders = _write(spark, table, rows, options)
        finally:
            spark.conf.set(_BY_PART_OF_KEY, before)
        counts = dict(seen.get)
        _switch(spark, table, folders, PART)
    fs, p = fs_path(spark, staged)
    fs.delete(p, True)
    return counts


def vacuum(spark: SparkSession, table: str) -> int:
    """Delete the year folders that no partition points at any more; returns how many went. Earlier readers must be done."""
    place, used = _catalogue(spark, table, PART)
    kept = {fs_path(spark, at)[1].toUri().getPath() for at in used.values()}
    gone = 0
    for version in _folders(spark, place):
        for year in _folders(spark, version):
            fs, p = fs_path(spark, year)
            if p.toUri().getPath() not in kept:
                fs.delete(p, True)
                gone += 1
    return gone


# ---- reads in place ----------------------------------------------------------------

def entity(spark: SparkSession, table: str, code: str) -> DataFrame:
    """All rows of one entity."""
    return spark.table(table).filter(F.col("currency_code") == F.lit(code)).select(*RAW_COLUMNS)


def daily_changes(spark: SparkSession, table: str, rate_type: str = "daily") -> DataFrame:
    """The mart of ``marts.daily_changes``; only one row for each entity and year is shuffled."""
    base = spark.table(table).filter(F.col("rate_type") == F.lit(rate_type)).select(*BUCKET, "rate_date", "exchange_rate")
    rows = with_previous_in_blocks(base, ["currency_code"], "rate_year", "rate_date", ["exchange_rate"])
    return rows.select("currency_code", "rate_date", "exchange_rate", F.col("prev_exchange_rate").alias("prev_rate"),
                       (F.col("exchange_rate") - F.col("prev_exchange_rate")).alias("abs_change"),
                       pct_change(F.col("exchange_rate"), F.col("prev_exchange_rate")).alias("pct_change"))


def period_stats(spark: SparkSession, table: str, unit: str, rate_type: str = "daily", volatility_digits: int | None = None) -> DataFrame:
    """The marts of ``marts.period_stats`` by month or quarter, aggregated in place. A week may lie in two years, hence in two
    buckets; use ``marts.period_stats`` for weeks."""
    if unit not in ("month", "quarter"):
        raise ValueError("unit must be month or quarter")
    period = marts.PERIOD_COLUMN[unit]
    stats = (spark.table(table).filter(F.col("rate_type") == F.lit(rate_type))
             .groupBy(*BUCKET, F.trunc("rate_date", unit).alias(period))
             .agg(*marts.period_aggregates(F.col("exchange_rate"), volatility_digits)))
    rows = with_previous_in_blocks(stats, ["currency_code"], "rate_year", period, ["avg_rate"])
    return marts.with_change(rows, [c for c in stats.columns if c != "rate_year"])
