"""Table writes: the partitioned raw store, touched-partition upserts, and versioned mart
tables switched in the catalog so readers never see a half-written mart."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.store import one_per_key
from tidemark.schema import KEY, RAW_COLUMNS, RAW_SCHEMA
from tidemark.session import shares_and_tasks

PART_COLS = ("rate_type", "rate_month")


def with_partition(df: DataFrame) -> DataFrame:
    return df.withColumn("rate_month", F.date_format("rate_date", "yyyy-MM"))


SORT_KEY = ("rate_type", "rate_month", "currency_code", "rate_date")
NO_PART = "__HIVE_DEFAULT_PARTITION__"  # the folder of rows without a type or date


def _named(df: DataFrame, by: tuple) -> DataFrame:
    """``df`` with its partition columns never null, as their folders are named. Spark turns nullable ones into others before the
    write, loses the rows' order by that and sorts a second time."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(NO_PART)) for c in by})


def _laid_out(df: DataFrame, by: tuple, *order: str) -> DataFrame:
    """Rows dealt by their partition columns ``by`` before a partitioned write, and sorted by ``order`` inside them.

    Spark's rebalancing counts what the shuffle wrote: it splits a large month over several tasks and joins small ones, so each task
    writes few, sorted files. Unlike a range partitioner it needs no sample, for which the whole input would be computed once more."""
    return _named(df, by).hint("rebalance", *by).sortWithinPartitions(*by, *order)


def write_raw(df: DataFrame, path: str, mode: str = "overwrite", dealt: bool = False) -> None:
    """Raw store layout: parquet partitioned by rate_type and year-month of rate_date
    (coarse partitions: a month of one type), files sorted by (code, date). Rows that were ``dealt`` by month are written where they lie."""
    rows = with_partition(df.select(*RAW_COLUMNS))
    rows = _named(rows, PART_COLS).sortWithinPartitions(*SORT_KEY) if dealt \
        else _laid_out(rows, PART_COLS, "currency_code", "rate_date")
    rows.write.mode(mode).partitionBy(*PART_COLS).parquet(path)


def fs_path(spark: SparkSession, path: str):
    """Hadoop file system and path object, for any store that Spark reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _folders(spark: SparkSession, path: str) -> list[str]:
    fs, p = fs_path(spark, path)
    return [f.getPath().toString() for f in fs.listStatus(p) if f.isDirectory()] if fs.exists(p) else []


# ---- the raw store as a catalogue table -------------------------------------------

#: Spark's parquet tables have no key or CHECK constraints; the rules stand in the table's properties, ``operators.validate`` keeps rows
#: that break them out, and ``constraint_violations`` reports any.
RAW_RULES = {
    "tidemark.key": "currency_code, rate_date, rate_type",
    "tidemark.check.code_pattern": "currency_code RLIKE '^[A-Z]{3}$'",
    "tidemark.check.rate_positive": "exchange_rate > 0",
    "tidemark.check.rate_type_known": "rate_type IN ('daily', 'monthly')",
}
RAW_COMMENT = "Rates by entity, date and type; one folder a type and month, switched as a whole"


def create_raw(spark: SparkSession, table: str, base: str | None = None) -> None:
    """The empty raw table ``database.name``, if the catalogue has none: columns with their comments, the rules as properties,
    partitions by type and month that the catalogue tracks. Files go below ``base``, or the database's own folder."""
    database, name = table.split(".")
    if base:
        ensure_database(spark, database, base)
    quoted = lambda text: "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
    columns = [f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'} COMMENT {quoted(f.metadata['comment'])}" for f in RAW_SCHEMA.fields]
    columns.append("rate_month STRING COMMENT 'year and month of rate_date'")
    rules = ", ".join(f"{quoted(k)} = {quoted(v)}" for k, v in RAW_RULES.items())
    at = f"LOCATION {quoted(base.rstrip('/') + '/' + name)}" if base else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(columns)}) USING parquet PARTITIONED BY (rate_type, rate_month) {at} "
              f"COMMENT {quoted(RAW_COMMENT)} TBLPROPERTIES ({rules})")


def _catalogue(spark: SparkSession, table: str, by: tuple = PART_COLS):
    """The table's folder and the folder of each partition (by default of each type and month), as the catalogue has them."""
    database, name = table.split(".")
    catalogue = spark._jsparkSession.sessionState().catalog().externalCatalog()
    parts = catalogue.listPartitions(database, name, spark._jvm.scala.Option.empty())
    at = {}
    for k in range(parts.size()):
        spec = parts.apply(k).spec()
        at[tuple(spec.apply(c) for c in by)] = parts.apply(k).location().toString()
    return catalogue.getTable(database, name).location().toString(), at


def _write_version(spark: SparkSession, table: str, write) -> dict[tuple[str, str], str]:
    """``write`` (a function of its path) a new version folder of the table; the folder of each (type, month)."""
    version = f"{_catalogue(spark, table)[0]}/v_{uuid.uuid4().hex}"
    write(version)
    out = {}
    for kind in _folders(spark, version):
        for month in _folders(spark, kind):
            out[kind.rsplit("=", 1)[1], month.rsplit("=", 1)[1]] = month
    return out


def _switch(spark: SparkSession, table: str, folders: dict[tuple, str], by: tuple = PART_COLS) -> None:
    """Point the table's partitions at ``folders``: each month changes as a whole, in one step of the catalogue."""
    known = _catalogue(spark, table, by)[1]
    spec = lambda key: "PARTITION (" + ", ".join(f"{c} = '{v}'" for c, v in zip(by, key)) + ")"
    new = [f"{spec(k)} LOCATION '{at}'" for k, at in folders.items() if k not in known]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD {' '.join(new)}")
    for k in known.keys() & folders.keys():
        spark.sql(f"ALTER TABLE {table} {spec(k)} SET LOCATION '{folders[k]}'")
    spark.sql(f"REFRESH TABLE {table}")


def load_raw(spark: SparkSession, table: str, rows: DataFrame, base: str | None = None, dealt: bool = False) -> None:
    """Put ``rows`` into the raw table, created if absent; months that they touch are replaced. ``dealt``: the rows lie by month already."""
    create_raw(spark, table, base)
    _switch(spark, table, _write_version(spark, table, lambda path: write_raw(rows, path, dealt=dealt)))


#: Rows of a month that one task of an upsert merges, or of a table by months makes.
TASK_ROWS = 250_000


def deal(rows: DataFrame, sizes: list[int], by: tuple) -> DataFrame:
    """``rows`` dealt by their folders' columns ``by`` and a share of the codes (a large month has several), column ``_share``. ``sizes`` are
    the folders' numbers of rows. Windows and groups by ``by``, ``_share`` and the code, and the write of the folders, work where the rows lie."""
    shares, tasks = shares_and_tasks(rows.sparkSession, sizes, TASK_ROWS)
    rows = _named(rows.withColumn("_share", F.pmod(F.hash("currency_code"), F.lit(shares))), by)
    return rows.repartition(tasks, *by, "_share")


def _merged(target: DataFrame, new: DataFrame, sizes: list[int]) -> DataFrame:
    """``target`` with the rows ``new`` (one a key) in the place of those with the same key, laid out for the write; ``_new`` tells where
    a row comes from and ``_met`` whether the other side has its key. ``sizes`` are the months' numbers of rows.

    One shuffle deals both sides by type, month and a share of the codes (a large month has several), and one sort serves the look at
    the rows of a key and the folders of the write. A key with a null meets none."""
    whole = F.lit(True)
    for c in KEY:
        whole = whole & F.col(c).isNotNull()
    columns = [*RAW_COLUMNS, "rate_month"]
    rows = target.select(*columns, F.lit(False).alias("_new")).unionByName(new.select(*columns, F.lit(True).alias("_new")))
    key = Window.partitionBy(*PART_COLS, "_share", "currency_code", "rate_date")
    rows = deal(rows.withColumn("_whole", whole), sizes, PART_COLS).withColumns({"_has_new": F.max("_new").over(key), "_has_old": ~F.min("_new").over(key)})
    met = F.col("_whole") & F.col("_has_new") & F.col("_has_old")
    return rows.select(*columns, "_new", met.alias("_met"))


def upsert_into(spark: SparkSession, table: str, batch: DataFrame, as_of, seq=None, base: str | None = None) -> dict:
    """Upsert ``batch`` into the raw table (created if absent), rewriting only the touched (rate_type, rate_month) partitions;
    returns the inserted and updated keys.

    The batch, one row a key, is staged once; the merge reads it from there, and the keys are counted in the pass that writes. The touched partition list is small (types x
    months of the batch) and prunes the read of the table. The merged months are written to a new version folder, and only then does the
    catalogue switch each of them, so a reader sees every month at all times, old or new as a whole. Should the switch be cut
    off, some months are old still, and the same upsert run again completes it. Old folders stay for :func:`vacuum`. One writer at a time."""
    create_raw(spark, table, base)
    place = _catalogue(spark, table)[0]
    staged = f"{place}_staged/{uuid.uuid4().hex}"
    new = with_partition(one_per_key(batch, as_of, seq))
    new.write.parquet(staged)
    new = spark.read.schema(new.schema).parquet(staged)
    touched = new.groupBy(*PART_COLS).count().collect()
    counts = {"inserted": 0, "updated": 0}
    if touched:
        in_touched = F.lit(False)
        for kind in sorted({r["rate_type"] for r in touched}):
            months = sorted({r["rate_month"] for r in touched if r["rate_type"] == kind})
            in_touched = in_touched | ((F.col("rate_type") == kind) & F.col("rate_month").isin(months))
        target = spark.table(table).filter(in_touched)
        held = {(r["rate_type"], r["rate_month"]): r["count"] for r in target.groupBy(*PART_COLS).count().collect()}
        sizes = [r["count"] + held.get((r["rate_type"], r["rate_month"]), 0) for r in touched]
        seen = Observation()
        rows = _merged(target, new, sizes).observe(seen, F.count_if(F.col("_new") & ~F.col("_met")).alias("inserted"),
                                                   F.count_if(~F.col("_new") & F.col("_met")).alias("updated"))
        rows = rows.filter(F.col("_new") | ~F.col("_met")).drop("_new", "_met")
        folders = _write_version(spark, table, lambda path: rows.write.partitionBy(*PART_COLS).parquet(path))
        counts = dict(seen.get)
        _switch(spark, table, folders)
    fs, p = fs_path(spark, staged)
    fs.delete(p, True)
    return counts


MONTH = ("rate_month",)


def month_sizes(rows: DataFrame) -> list[int]:
    """The numbers of rows of the months in ``rate_month``: a short list, one number a month of the calendar. Of a stored table by months
    they stand in the files' footers."""
    return [r["count"] for r in rows.groupBy("rate_month").count().collect()]


def replace_months(spark: SparkSession, table: str, rows: DataFrame, base: str, months: list[str] | None = None) -> None:
    """Put the months of ``rows`` (column ``rate_month``) into the table ``database.name``, which is created if absent and whose
    partitions are switched as the raw table's are. Of ``months``, those without rows become empty. The rows were dealt by month
    (:func:`deal`) and are written where they lie, sorted by code."""
    database, name = table.split(".")
    ensure_database(spark, database, base)
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY (rate_month) LOCATION '{base.rstrip('/')}/{name}'")
    version = f"{_catalogue(spark, table, MONTH)[0]}/v_{uuid.uuid4().hex}"
    rows.sortWithinPartitions(*MONTH, "currency_code").write.partitionBy(*MONTH).parquet(version)
    written = {(m.rsplit("=", 1)[1],): m for m in _folders(spark, version)}
    _switch(spark, table, written, MONTH)
    known = _catalogue(spark, table, MONTH)[1]
    for m in months or []:
        if (m,) not in written and (m,) in known:
            spark.sql(f"ALTER TABLE {table} DROP PARTITION (rate_month = '{m}')")


def vacuum(spark: SparkSession, table: str) -> int:
    """Delete the folders of the raw table that no partition points at any more, month by month; returns how many went. Readers that
    began before the last upsert must be done."""
    place, used = _catalogue(spark, table)
    kept = {fs_path(spark, at)[1].toUri().getPath() for at in used.values()}
    gone = 0
    for version in _folders(spark, place):
        months = [m for kind in _folders(spark, version) for m in _folders(spark, kind)]
        left = [m for m in months if fs_path(spark, m)[1].toUri().getPath() in kept]
        for m in [version] if not left else [m for m in months if m not in left]:
            fs, p = fs_path(spark, m)
            fs.delete(p, True)
            gone += 1
    return gone


def ensure_database(spark: SparkSession, database: str, base: str) -> None:
    """Create the catalog database if missing, located under ``base`` (the shared folder),
    not under the working directory of the driver."""
    if not spark.catalog.databaseExists(database):
        loc = f"{base.rstrip('/')}/_catalog/{database}.db"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{loc}'")


def publish(spark: SparkSession, df: DataFrame, base: str, name: str, database: str = "marts",
            sort_by: tuple = (), seen: Observation | None = None, dealt: bool = False) -> str:
    """Write ``df`` to a new version folder and point table ``database.name`` at it.

    Readers of the table keep reading the old version until the catalog switch; the old
    folder is left for :func:`retain`. ``sort_by`` lays the files out by key ranges, so a read of one
    entity opens few of them; rows that were ``dealt`` by ranges already are sorted where they lie. ``seen`` observes the rows written.
    The files are packed by zstd, as they are kept and read often. Returns the version path."""
    version = f"{base.rstrip('/')}/{name}/v_{uuid.uuid4().hex}"
    if sort_by:
        if not dealt:
            df = df.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *sort_by)
        df = df.sortWithinPartitions(*sort_by)
    if seen is not None:  # behind the layout, whose range partitioner reads its input once more for a sample
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    df.write.mode("errorifexists").option("compression", "zstd").parquet(version)
    ensure_database(spark, database, base)
    table = f"{database}.{name}"
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{version}'")
        spark.sql(f"REFRESH TABLE {table}")
    else:
        spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{version}'")
    return version


def retain(spark: SparkSession, base: str, name: str, current: str, keep: int = 1) -> int:
    """Delete old versions of a mart but the current one and the ``keep`` latest others; returns how many went."""
    fs, root = fs_path(spark, f"{base.rstrip('/')}/{name}")
    if not fs.exists(root):
        return 0
    others = [f for f in fs.listStatus(root) if f.isDirectory() and f.getPath().getName() != current.rstrip("/").rsplit("/", 1)[-1]]
    others.sort(key=lambda f: (f.getModificationTime(), f.getPath().getName()), reverse=True)
    for f in others[keep:]:
        fs.delete(f.getPath(), True)
    return len(others[keep:])


def write_sample_json(df: DataFrame, path: str, n: int = 10,
                      order=("currency_code", "rate_date", "rate_type")) -> None:
    """First ``n`` rows in key order as one JSON file (a bounded top-n, not a collect)."""
    (df.orderBy(*order).limit(n).coalesce(1)
     .write.mode("overwrite").option("dateFormat", "yyyy-MM-dd").json(path))
