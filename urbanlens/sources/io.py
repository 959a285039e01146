"""Readers and writers (S1-S12): Parquet/CSV scans, sinks, result tables, lineage.

All reads take explicit schemas; all writes are bulk DataFrame writes (no
per-row commits). Nothing here reads the clock: run times are arguments.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlens.sources import schemas as S

# --- fixed values -----------------------------------------------------------
BATCH_FORMAT = "yyyyMMdd"
STAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
RUN_DATE_FORMAT = "yyyy-MM-dd"
JOB_COLLECT, JOB_SPARK, JOB_LOAD = 1, 2, 3
STEP_COLLECT, STEP_SPARK, STEP_LOAD = "collect_posts", "spark_jobs", "load_results"
# ----------------------------------------------------------------------------


# ---- scans ------------------------------------------------------------------

def read_posts(spark: SparkSession, path: str) -> DataFrame:
    """Collected posts from Parquet, checked against the posts schema."""
    df = spark.read.parquet(path)
    need = [f for f in S.POSTS.fields if f.name in ("tweets", "date", "station")]
    S.check_columns(df, S.T.StructType(need), "posts")
    return df


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    """Station CSV (BOM, CRLF, quoted commas) -> (Latitude, Longitude, Station)."""
    df = (spark.read.schema(S.STATIONS_CSV).option("header", True).option("multiLine", True)
          .option("encoding", "UTF-8").csv(path))
    return df.drop("Zone")


def read_listings(spark: SparkSession, path: str) -> DataFrame:
    """S3: listings CSV; empty cells are NULL."""
    return spark.read.schema(S.LISTINGS).option("header", True).option("nullValue", "").csv(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Stored result pages ``(page_no, url, html)`` from Parquet."""
    df = spark.read.parquet(path)
    S.check_columns(df, S.PAGES, "pages")
    return df


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """Lexicon file with lines ``token<TAB>mean<TAB>...`` -> ``(token, valence)``."""
    raw = spark.read.option("sep", "\t").option("quote", "").csv(path)
    return raw.select(F.col("_c0").alias("token"), F.col("_c1").try_cast("double").alias("valence")) \
        .where(F.col("valence").isNotNull())


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """S11 for files: the newest batch folder under ``path``, read whole.

    ``path`` holds one sub-folder per batch (each written with one or more
    part files). The batch whose newest file was modified last wins; ties
    go to the greater folder name. Only that folder's files are then read.
    """
    # the folder's listing names files, not rows: empty batches count, blanks in names stay as they are
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    newest = None
    for folder in fs.listStatus(root) if fs.exists(root) else ():
        if folder.isDirectory():
            times = [f.getModificationTime() for f in fs.listStatus(folder.getPath())
                     if f.isFile() and f.getPath().getName().endswith(".parquet")]
            if times:
                newest = max(newest or (0, ""), (max(times), folder.getPath().toString()))
    if newest is None:
        raise FileNotFoundError(f"no batch under {path}")
    return spark.read.parquet(newest[1])


# ---- sinks --------------------------------------------------------------------

def write_snapshot(df: DataFrame, path: str) -> None:
    """Parquet, overwrite."""
    df.write.mode("overwrite").parquet(path)


def write_listings_csv(df: DataFrame, path: str) -> None:
    """CSV with header, NULL written as empty."""
    (df.write.mode("overwrite").option("header", True).option("nullValue", "")
     .option("emptyValue", "").csv(path))


def ensure_tables(spark: SparkSession, db: str, location: str | None = None) -> None:
    """Create the database and the result tables if missing; each batch is a partition (see :mod:`urbanlens.sources.loads`)."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}{loc}")
    tables = {
        "sentiment": "tweets STRING, date TIMESTAMP, station STRING, sentiment DECIMAL(5,2), batch_nr BIGINT",
        "topics": "date TIMESTAMP, topics STRING, batch_nr BIGINT",
        "listings": """ad_id STRING, link STRING, price DOUBLE, bedrooms INT, bathrooms INT, living_rooms INT,
            address STRING, distance DOUBLE, subway_station STRING, batch_nr BIGINT""",
        "rejected": "origin STRING, row STRING, reasons STRING, batch_nr BIGINT",
        "data_lineage": "timestamp TIMESTAMP, step_airflow STRING, source STRING, destination STRING, batch_nr BIGINT, job_nr INT",
    }
    for name, columns in tables.items():
        part = "batch_nr, job_nr" if name == "data_lineage" else "batch_nr"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {db}.{name} ({columns}) USING parquet PARTITIONED BY ({part})")


def append_table(df: DataFrame, name: str) -> None:
    """Append rows to a table by column name, in one bulk write. Twice is twice: a load that may be repeated is ``loads.load_batch``."""
    target = df.sparkSession.table(name)
    cols = target.columns
    out = df.select(*[F.col(c).cast(target.schema[c].dataType) for c in cols])
    out.write.mode("append").insertInto(name)


# ---- lineage and load-time casts ----------------------------------------------

def batch_number(ts) -> Column:
    """batch number ``yyyyMMdd`` as a number."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(c, BATCH_FORMAT).cast("long")


def stamp(ts) -> Column:
    """timestamp text to the second."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(c, STAMP_FORMAT)


def object_path(bucket, key) -> Column:
    """``s3://<bucket>/<key>``-style path from two columns or strings."""
    b = F.lit(bucket) if isinstance(bucket, str) else bucket
    k = F.lit(key) if isinstance(key, str) else key
    return F.concat(F.lit("s3://"), b, F.lit("/"), k)


def lineage_row(spark: SparkSession, job_nr: int, step: str, source: str, destination: str,
                now: dt.datetime) -> DataFrame:
    """One lineage row for a finished job; ``now`` is passed in."""
    row = (int(now.strftime("%Y%m%d")), job_nr, now.replace(microsecond=0), step, source, destination)
    return spark.createDataFrame([row], S.LINEAGE)


def cast_on_load(scored: DataFrame, decimal_type: str = "decimal(5,2)", strict: bool = False) -> DataFrame:
    """sentiment (number or numeric text) -> decimal, date text -> timestamp.

    What can't be read becomes NULL; with ``strict`` it fails the job instead.
    """
    def read(name: str, kind: str) -> Column:
        c = F.col(name).try_cast(kind)
        if strict:
            bad = F.raise_error(F.concat(F.lit(f"unreadable {name}: "), F.col(name).cast("string")))
            c = F.when(c.isNull() & F.col(name).isNotNull(), bad.cast(kind)).otherwise(c)
        return c.alias(name)

    return scored.select("tweets", read("date", "timestamp"), "station", read("sentiment", decimal_type))


def lineage_for_batches(events: DataFrame, ts_col: str, bucket: str, db: str) -> DataFrame:
    """Lineage rows (jobs 1-3) for every batch day present in ``events``.

    One aggregate per day (the last event time stamps the batch), then three
    rows per day from a literal array; paths are built with F12.
    """
    days = events.groupBy(F.to_date(ts_col).alias("_d")).agg(F.max(ts_col).alias("_t"))
    b = F.date_format("_d", BATCH_FORMAT)
    posts_key = F.concat(F.lit("posts/"), b, F.lit(".parquet"))
    posts_path = object_path(bucket, posts_key)
    outputs = F.concat(object_path(bucket, F.concat(F.lit("sentiment/"), b, F.lit("/"))), F.lit(", "),
                       object_path(bucket, F.concat(F.lit("topics/"), b, F.lit("/"))))
    jobs = F.array(
        F.struct(F.lit(JOB_COLLECT).alias("job_nr"), F.lit(STEP_COLLECT).alias("step"),
                 F.lit("External: posts API").alias("src"), posts_path.alias("dst")),
        F.struct(F.lit(JOB_SPARK).alias("job_nr"), F.lit(STEP_SPARK).alias("step"),
                 posts_path.alias("src"), outputs.alias("dst")),
        F.struct(F.lit(JOB_LOAD).alias("job_nr"), F.lit(STEP_LOAD).alias("step"),
                 outputs.alias("src"), F.lit(f"db: {db}.sentiment, {db}.topics").alias("dst")),
    )
    return days.select(batch_number("_d").alias("batch_nr"), F.date_trunc("second", "_t").alias("timestamp"),
                       F.explode(jobs).alias("j")).select(
        "batch_nr", F.col("j.job_nr").alias("job_nr"), "timestamp",
        F.col("j.step").alias("step_airflow"), F.col("j.src").alias("source"),
        F.col("j.dst").alias("destination"))
