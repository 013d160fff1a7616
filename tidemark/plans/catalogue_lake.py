"""Query catalogue, second part: merges of random, skewed and bucketed keys, compaction,
event-time de-duplication, drift, examples of violations, incremental roll-up, Z-order.

Same rules as ``catalogue``: whole tables, each query with its DuckDB oracle.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import epoch_to_timestamp, normalise_names, path_basename, strip_scheme
from tidemark.operators.drift import drift, profile, read_profiles
from tidemark.operators.enrich import enrich
from tidemark.operators.layout import hash_cluster, preview
from tidemark.operators.merge import merge_insert
from tidemark.operators.quality import unexpected_samples
from tidemark.operators.rollup import rollup_dimension
from tidemark.operators.rollup_state import advance, corrections, rollup_of, signed
from tidemark.operators.zorder import cluster_zorder
from tidemark.plans import catalogue as base
from tidemark.plans.bucketed import compact_bucketed, create_bucketed, merge_insert_bucketed, upsert_bucketed
from tidemark.plans.compaction import compact_lake
from tidemark.plans.runner import run_all, run_batch
from tidemark.plans.tables import append, read_table
from tidemark.schemas import LANDING_SCHEMA
from tidemark.session import profile as session_profile
from tidemark.session import scratch_path
from tidemark.sources.csv import read_csv_inferred, write_csv
from tidemark.sources.files import list_files, read_landing
from tidemark.sources.fixtures import county_rows, table, transactions
from tidemark.sources.synth import write_landing_files
from tidemark.streaming.dedupe import drain_unique

# ---------------------------------------------------------------------------
# merges: random ids, hot keys, repeated keys, buckets
# ---------------------------------------------------------------------------

# a one-to-one scramble of order keys over the whole range, like drawn ids
_SCRAMBLE, _PRIME = 2654435761, 4294967291


def scrambled(key: str) -> Column:
    return F.col(key) * F.lit(_SCRAMBLE).cast("long") % F.lit(_PRIME).cast("long")


def q_merge_random_ids(spark: SparkSession, sf: str) -> DataFrame:
    """The pipeline over ids that do not grow; every batch probes only the batch folders
    whose key index may hold one of its ids."""
    cfg = replace(base._pipeline_setup(spark, sf, ids=scrambled("invoiceid")), key_index_min_rows=0)
    run_all(spark, cfg, clock=base._clock)
    return base._enriched_out(spark, cfg)


SQL_MERGE_RANDOM_IDS = f"""
SELECT t.invoiceid * {_SCRAMBLE} % {_PRIME} AS invoiceid, t.customerid, t.price, t.state, {base._ENRICHED_COLS_SQL}
FROM ({base._TX_SQL}) t LEFT JOIN ({base._DIM_SQL}) d ON t.state = d.state_abbreviation
WHERE year(t.o_orderdate) BETWEEN 1995 AND 1999
"""


def q_merge_insert_skewed(spark: SparkSession, sf: str) -> DataFrame:
    """J2 between two large sides: one key holds a third of the source, another one a third of the target."""
    li = table(spark, sf, "lineitem").select(
        F.when(F.col("l_orderkey") % 3 == 0, -1).otherwise(F.col("l_orderkey")).alias("invoiceid"),
        F.col("l_orderkey").alias("line_of"), "l_linenumber")
    history = base._history(spark, sf).select(
        F.when(F.col("invoiceid") % 3 == 1, -2).otherwise(F.col("invoiceid")).alias("invoiceid"))
    return merge_insert(history, li, "invoiceid", max_bytes=1)  # no side counts as small


SQL_MERGE_INSERT_SKEWED = f"""
WITH src AS (SELECT CASE WHEN l_orderkey % 3 = 0 THEN -1 ELSE l_orderkey END AS invoiceid, l_orderkey AS line_of,
                    l_linenumber FROM lineitem),
target AS (SELECT CASE WHEN o_orderkey % 3 = 1 THEN -2 ELSE o_orderkey END AS invoiceid FROM orders
           WHERE o_orderdate < TIMESTAMP '{base.HISTORY_CUTOFF}')
SELECT * FROM src WHERE invoiceid NOT IN (SELECT invoiceid FROM target)
"""


def q_enrich_skewed(spark: SparkSession, sf: str) -> DataFrame:
    """J1 with a dimension too large to broadcast: a third of the facts have one key, some have none."""
    facts = table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, 7)
                                              .when(F.col("o_orderkey") % 17 != 0, F.col("o_custkey")).alias("customer"))
    dim = table(spark, sf, "customer").select("c_custkey", F.col("c_name").alias("name"),
                                              F.col("c_nationkey").alias("nation"))
    return enrich(facts, dim, "customer", "c_custkey", prefix="Customer_", max_bytes=1)


SQL_ENRICH_SKEWED = """
WITH f AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 7 WHEN o_orderkey % 17 <> 0 THEN o_custkey END AS customer
           FROM orders)
SELECT o_orderkey, customer, c_name AS Customer_name, CAST(c_nationkey AS BIGINT) AS Customer_nation
FROM f LEFT JOIN customer ON customer = c_custkey
"""


def q_merge_insert_deduped(spark: SparkSession, sf: str) -> DataFrame:
    """J2 with one row per new key: of an order's lines the one shipped first."""
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("invoiceid"), "l_linenumber", "l_shipdate")
    return merge_insert(base._history(spark, sf).select("invoiceid"), li, "invoiceid", dedupe_source=True,
                        dedupe_order=["l_shipdate", "l_linenumber"])


SQL_MERGE_INSERT_DEDUPED = f"""
SELECT invoiceid, l_linenumber, l_shipdate FROM (
  SELECT l_orderkey AS invoiceid, l_linenumber, l_shipdate,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber) AS n FROM lineitem)
WHERE n = 1 AND invoiceid NOT IN (SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '{base.HISTORY_CUTOFF}')
"""

BUCKETS = 8


def _returned_totals(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").filter(F.col("l_returnflag") == "R")
    return li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("o_totalprice"))


def q_bucketed_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """R4 on a bucketed table: order totals corrected without shuffling the table."""
    name = base._catalog_name(spark, "totals")
    create_bucketed(spark, name, table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", BUCKETS)
    upsert_bucketed(spark, name, _returned_totals(spark, sf))
    return spark.table(name)


def q_bucketed_insert(spark: SparkSession, sf: str) -> DataFrame:
    """J2 on a bucketed table: two deliveries that overlap, then its files are compacted."""
    name = base._catalog_name(spark, "orders")
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    create_bucketed(spark, name, o.filter("o_orderkey % 3 = 0"), "o_orderkey", BUCKETS)
    merge_insert_bucketed(spark, name, o.filter("o_orderkey % 3 < 2").withColumn("o_totalprice", -F.col("o_totalprice")))
    merge_insert_bucketed(spark, name, o)
    compact_bucketed(spark, name)
    return spark.table(name)


SQL_BUCKETED_INSERT = """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 1 THEN -o_totalprice ELSE o_totalprice END AS o_totalprice FROM orders
"""

# ---------------------------------------------------------------------------
# compaction
# ---------------------------------------------------------------------------


def q_compact_then_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Two batches, all batch folders packed into one per table, two more batches: the
    re-delivered ids are found in the packed folder; a backfill is packed with its batch."""
    cfg = base._pipeline_setup(spark, sf)
    run_batch(spark, cfg, base._clock(0))
    late = transactions(spark, sf).filter(F.year(epoch_to_timestamp("orderdate")) == 2001)
    append(cfg.raw_table(), base.to_raw(late, base._clock(0) + timedelta(minutes=30)), "backfill-2001", cluster="local")
    run_batch(spark, cfg, base._clock(1))
    compact_lake(spark, cfg)
    run_all(spark, cfg, clock=lambda i: base._clock(i + 2))
    return base._enriched_out(spark, cfg)


# ---------------------------------------------------------------------------
# event-time de-duplication (R2)
# ---------------------------------------------------------------------------

DELAY_DAYS = 60
_DELIVERIES = [  # overlapping years; what the first one leaves out comes late with the last one
    "y <= 1996 AND invoiceid % 5 <> 0",
    "y BETWEEN 1996 AND 1998",
    "y >= 1998 OR (y = 1995 AND invoiceid % 5 <= 1)",
]


def q_stream_event_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """R2: three triggers with repeated and late invoices; each is passed on once, late ones never."""
    root = scratch_path(spark, "dedupe")
    tx = transactions(spark, sf).select("invoiceid", epoch_to_timestamp("orderdate").alias("ordered"), "price")
    rows = tx.withColumn("y", F.year("ordered"))
    for i, which in enumerate(_DELIVERIES):
        rows.filter(which).drop("y").write.parquet(f"{root}/landing/delivery={i}")
        drain_unique(spark, f"{root}/landing", tx.schema, f"{root}/out", f"{root}/checkpoint",
                     ["invoiceid"], "ordered", f"{DELAY_DAYS} days")
    out = spark.read.schema(tx.schema).parquet(f"{root}/out")
    return out.withColumn("ordered", F.col("ordered").cast("timestamp_ntz"))


SQL_STREAM_EVENT_DEDUPE = f"""
WITH t AS (SELECT o_orderkey AS invoiceid, o_orderdate AS ordered, o_totalprice AS price, year(o_orderdate) AS y FROM orders),
d1 AS (SELECT * FROM t WHERE {_DELIVERIES[0]}),
d2 AS (SELECT * FROM t WHERE {_DELIVERIES[1]}),
d3 AS (SELECT * FROM t WHERE {_DELIVERIES[2]}),
w2 AS (SELECT max(ordered) - INTERVAL {DELAY_DAYS} DAY AS w FROM d1),
w3 AS (SELECT greatest((SELECT w FROM w2), (SELECT max(ordered) - INTERVAL {DELAY_DAYS} DAY FROM d2)) AS w),
k2 AS (SELECT d2.* FROM d2, w2 WHERE ordered > w AND invoiceid NOT IN (SELECT invoiceid FROM d1)),
k3 AS (SELECT d3.* FROM d3, w3 WHERE ordered > w AND invoiceid NOT IN (SELECT invoiceid FROM d1 UNION SELECT invoiceid FROM k2))
SELECT invoiceid, ordered, price FROM (SELECT * FROM d1 UNION ALL SELECT * FROM k2 UNION ALL SELECT * FROM k3)
"""

# ---------------------------------------------------------------------------
# drift and examples of violations (Q3-Q6)
# ---------------------------------------------------------------------------

DRIFT_LIMIT = 0.2


def q_batch_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Q5/Q6: the orders of each year against all earlier years; prices of 1998 are doubled, its
    even customers are missing, order dates always move on."""
    o = table(spark, sf, "orders").select(
        F.year("o_orderdate").alias("y"), "o_orderkey", F.col("o_custkey").alias("customer"),
        F.when(F.year("o_orderdate") == 1998, F.col("o_totalprice") * 2).otherwise(F.col("o_totalprice")).alias("price"),
        F.unix_timestamp("o_orderdate").alias("ordered"))
    o = o.withColumn("customer", F.when((F.col("y") != 1998) | (F.col("customer") % 2 == 1), F.col("customer")))
    profiles = profile(o, ["customer", "price", "ordered"], F.col("y").cast("string"))
    path = scratch_path(spark, "profiles")
    profiles.write.partitionBy("batch_id").parquet(path)
    kept = read_profiles(spark, path)
    return drift(kept, kept, DRIFT_LIMIT).select("batch_id", "column_name", "rows", "nulls", "before_rows", "drifted")


# exact: the largest gap between the two distribution functions
SQL_BATCH_DRIFT = f"""
WITH o AS (SELECT CAST(year(o_orderdate) AS VARCHAR) AS batch_id, year(o_orderdate) AS y,
                  CASE WHEN year(o_orderdate) <> 1998 OR o_custkey % 2 = 1 THEN o_custkey END AS customer,
                  CASE WHEN year(o_orderdate) = 1998 THEN o_totalprice * 2 ELSE o_totalprice END AS price,
                  epoch(o_orderdate) AS ordered FROM orders),
v AS (SELECT batch_id, 'customer' AS column_name, customer::DOUBLE AS v FROM o
      UNION ALL SELECT batch_id, 'price', price FROM o UNION ALL SELECT batch_id, 'ordered', ordered FROM o),
counts AS (SELECT batch_id, column_name, count(*) AS rows, count(*) - count(v) AS nulls FROM v GROUP BY ALL),
pairs AS (SELECT b.batch_id, v.column_name, v.v, (v.batch_id = b.batch_id)::INT AS own
          FROM (SELECT DISTINCT batch_id FROM v) b JOIN v ON v.batch_id <= b.batch_id AND v.v IS NOT NULL),
cdf AS (SELECT batch_id, column_name, v, sum(own) OVER w AS a, sum(1 - own) OVER w AS b,
               sum(own) OVER g AS na, sum(1 - own) OVER g AS nb
        FROM pairs WINDOW w AS (PARTITION BY batch_id, column_name ORDER BY v RANGE UNBOUNDED PRECEDING),
                          g AS (PARTITION BY batch_id, column_name)),
ks AS (SELECT batch_id, column_name, max(abs(a / na - b / nb)) AS d FROM cdf WHERE na > 0 AND nb > 0 GROUP BY ALL)
SELECT c.batch_id, c.column_name, c.rows, c.nulls, coalesce(d > {DRIFT_LIMIT}, false) AS drifted,
       coalesce((SELECT sum(p.rows) FROM counts p WHERE p.column_name = c.column_name AND p.batch_id < c.batch_id), 0)::BIGINT
         AS before_rows
FROM counts c LEFT JOIN ks USING (batch_id, column_name)
"""

SAMPLES = 4


def q_unexpected_samples(spark: SparkSession, sf: str) -> DataFrame:
    """Q3/Q4: examples of each violated check, out of the one validation scan."""
    found = unexpected_samples(base._order_batch(spark, sf), base.ORDER_SUITE, "invoiceid", SAMPLES)
    return found.select("expectation", "column_name", "unexpected_count",
                        F.array_join(F.transform("examples", lambda x: F.concat_ws("=", x["key"], x["value"])), ";").alias("examples"))


SQL_UNEXPECTED_SAMPLES = f"""
WITH o AS (SELECT CAST(o_orderkey AS VARCHAR) AS k, year(o_orderdate) AS y,
                  ('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 15))::BIGINT AS h FROM orders),
bad AS (SELECT * FROM o WHERE y < 1995 OR y > 2000),
slots AS (SELECT min_by(k || '=' || y, h) AS example, min(h) AS h FROM bad GROUP BY h % {SAMPLES})
SELECT 'expect_column_values_to_not_be_null' AS expectation, 'invoiceid' AS column_name, 0::BIGINT AS unexpected_count,
       '' AS examples
UNION ALL SELECT 'expect_column_values_to_match_regex', 'orderdate_date', 0, ''
UNION ALL SELECT 'expect_column_values_to_be_between', 'orderdate_year', (SELECT count(*) FROM bad),
                 (SELECT coalesce(string_agg(example, ';' ORDER BY h), '') FROM slots)
"""

# ---------------------------------------------------------------------------
# incremental roll-up (A1), Z-order clustering
# ---------------------------------------------------------------------------


def q_incremental_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """A1: county rows come, are corrected and go, in three deltas; the state equals a full roll-up."""
    rows = county_rows(spark, sf)
    whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]))
    rows = rows.withColumn("part", F.pmod(F.crc32(whole.cast("binary")), F.lit(4)))
    path = scratch_path(spark, "rollup")
    plain = lambda d: d.drop("part")
    first = plain(rows.filter("part < 3"))
    advance(spark, path, signed(first, 1), 1)
    advance(spark, path, signed(plain(rows.filter("part = 3")), 1), 2)
    advance(spark, path, signed(plain(rows.filter("part = 3")), 1), 2)  # the same delta again: not applied
    gone = plain(rows.filter("part = 0"))
    old = plain(rows.filter("part = 1"))
    state = advance(spark, path, corrections(old, old).unionByName(signed(gone, -1)), 3)
    state = advance(spark, path, signed(gone, 1), 4)
    return normalise_names(rollup_of(state))


def q_zorder_write(spark: SparkSession, sf: str) -> DataFrame:
    """Lines clustered by month and key together, written and read back."""
    li = table(spark, sf, "lineitem")
    path = scratch_path(spark, "zorder")
    cluster_zorder(li, ["l_shipdate", "l_orderkey"]).write.parquet(path)
    return spark.read.schema(li.schema).parquet(path)


# ---------------------------------------------------------------------------
# sources, sinks and helpers in queries of their own
# ---------------------------------------------------------------------------


def q_ingest_with_cursor(spark: SparkSession, sf: str) -> DataFrame:
    """The pipeline lists only landing folders that may hold new files; one of them gets
    a late file after it was finished."""
    cfg = replace(base._pipeline_setup(spark, sf, move_files=False), folder_cursor=True, suite=(base.NotNull("invoiceid"),))
    late = spark.read.schema(LANDING_SCHEMA).parquet(f"{cfg.landing}/year=1995").drop("part")
    run_all(spark, cfg, clock=base._clock)
    (late.withColumn("invoiceid", -F.col("invoiceid")).write.mode("append").parquet(f"{cfg.landing}/year=1995/part=0"))
    run_all(spark, cfg, clock=lambda i: base._clock(i + 50))
    return base._enriched_out(spark, cfg)


SQL_INGEST_WITH_CURSOR = f"""
SELECT t.invoiceid * s.sign AS invoiceid, t.customerid, t.price, t.state, {base._ENRICHED_COLS_SQL}
FROM ({base._TX_SQL}) t JOIN (VALUES (1), (-1)) s(sign) ON s.sign = 1 OR year(t.o_orderdate) = 1995
LEFT JOIN ({base._DIM_SQL}) d ON t.state = d.state_abbreviation
"""


def q_county_csv_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """County rows as a CSV file, read with inferred types, then rolled up."""
    path = scratch_path(spark, "county_csv")
    write_csv(county_rows(spark, sf), path)
    return normalise_names(rollup_dimension(read_csv_inferred(spark, path), key="State"))


def q_landing_files(spark: SparkSession, sf: str) -> DataFrame:
    """Landing rows written as files, read back with the landing schema."""
    path = scratch_path(spark, "landing_files")
    write_landing_files(transactions(spark, sf), path, 4)
    files = [r["path"] for r in list_files(spark, path).select("path").collect()]
    return read_landing(spark, files).select("invoiceid", "customerid", "price", "state")


SQL_LANDING_FILES = f"SELECT t.invoiceid, t.customerid, t.price, t.state FROM ({base._TX_SQL}) t"


def q_ingest_stamp(spark: SparkSession, sf: str) -> DataFrame:
    """Every raw row carries its batch's stamp; re-delivered rows a later one."""
    cfg = base._pipeline_setup(spark, sf)
    run_all(spark, cfg, clock=base._clock)
    return read_table(spark, cfg.raw_table()).select("invoiceid", F.col("processed_date").cast("timestamp_ntz").alias("processed_date"))


SQL_INGEST_STAMP = """
SELECT o_orderkey AS invoiceid, TIMESTAMP '2024-01-01 00:00:00' + INTERVAL 1 HOUR * ((year(o_orderdate) - 1995) // 2) AS processed_date
FROM orders WHERE year(o_orderdate) BETWEEN 1995 AND 1999
UNION ALL SELECT o_orderkey, TIMESTAMP '2024-01-01 02:00:00' FROM orders WHERE year(o_orderdate) = 1995
"""


def q_path_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Scheme and last part of paths of several forms."""
    n = F.col("n_name")
    forms = F.array(F.concat(F.lit("s3a://bucket/raw/"), n, F.lit(".parquet")), F.concat(F.lit("/data/"), n),
                    F.concat(F.lit("hdfs://host:9000/a/b/"), n, F.lit("/")), n)
    paths = table(spark, sf, "nation").select(F.explode(forms).alias("path"))
    return paths.select("path", strip_scheme("path").alias("bare"), path_basename("path").alias("base"))


SQL_PATH_PARTS = """
WITH p AS (SELECT unnest(['s3a://bucket/raw/' || n_name || '.parquet', '/data/' || n_name, 'hdfs://host:9000/a/b/' || n_name || '/',
                          n_name]) AS path FROM nation)
SELECT path, CASE WHEN contains(path, '://') THEN split_part(path, '://', 2) ELSE path END AS bare,
       string_split(path, '/')[-1] AS base FROM p
"""


def q_hash_cluster(spark: SparkSession, sf: str) -> DataFrame:
    """O1: orders hashed by customer into partitions: each customer lies in one, sorted."""
    o = hash_cluster(table(spark, sf, "orders").select("o_custkey", "o_orderkey"), 16, "o_custkey", "o_orderkey")
    by_customer = hash_cluster(o, 16, "o_custkey").withColumn("part", F.spark_partition_id())
    return by_customer.groupBy("o_custkey").agg(F.count("*").alias("orders"), F.count_distinct("part").cast("long").alias("parts"))


def q_ordered_csv(spark: SparkSession, sf: str) -> DataFrame:
    """A CSV written in key order; its lines, in file order, are numbered."""
    path = scratch_path(spark, "ordered_csv")
    write_csv(table(spark, sf, "customer").select("c_name", "c_custkey"), path, order_by="c_name")
    lines = spark.read.option("header", True).csv(path).select(
        "c_name", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("at"))
    order = Window.partitionBy("file").orderBy("at")
    # in order inside each file, and files in order of their names: no name is below the one before
    steps = lines.withColumn("before", F.lag("c_name").over(order))
    ends = lines.groupBy("file").agg(F.min("c_name").alias("lo"), F.max("c_name").alias("hi"))
    gaps = ends.withColumn("before", F.lag("hi").over(Window.orderBy("file")))  # one row per file
    wrong = steps.filter("c_name < before").select("c_name").unionByName(gaps.filter("lo < before").select(F.col("lo").alias("c_name")))
    return lines.agg(F.count("*").alias("lines"), F.count_distinct("c_name").alias("names")).crossJoin(
        F.broadcast(wrong.agg(F.count("*").alias("out_of_order"))))  # one row each


def q_profiled_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """The roll-up in a session with the runtime profile; the caller's session stays as it is."""
    own = spark.newSession()
    set_to = session_profile(own)
    n = own.conf.get("spark.sql.adaptive.enabled") == "true" and int(set_to["spark.sql.shuffle.partitions"]) >= 24
    return base._dimension(own, sf).agg(F.count("*").alias("states")).select(
        "states", F.lit(own.conf.get("spark.sql.session.timeZone")).alias("zone"), F.lit(n).alias("profiled"))


def q_preview(spark: SparkSession, sf: str) -> DataFrame:
    """The first rows of an ordered frame."""
    return preview(table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey"), 5)


CATALOGUE: dict[str, tuple[base.Query, str | None]] = {
    "merge_random_ids": (q_merge_random_ids, SQL_MERGE_RANDOM_IDS),
    "merge_insert_skewed": (q_merge_insert_skewed, SQL_MERGE_INSERT_SKEWED),
    "enrich_skewed": (q_enrich_skewed, SQL_ENRICH_SKEWED),
    "merge_insert_deduped": (q_merge_insert_deduped, SQL_MERGE_INSERT_DEDUPED),
    "bucketed_upsert": (q_bucketed_upsert, base.SQL_MERGE_UPSERT),
    "bucketed_insert": (q_bucketed_insert, SQL_BUCKETED_INSERT),
    "compact_then_merge": (q_compact_then_merge, base.SQL_BACKFILL),
    "stream_event_dedupe": (q_stream_event_dedupe, SQL_STREAM_EVENT_DEDUPE),
    "batch_drift": (q_batch_drift, SQL_BATCH_DRIFT),
    "unexpected_samples": (q_unexpected_samples, SQL_UNEXPECTED_SAMPLES),
    "incremental_rollup": (q_incremental_rollup, base._DIM_SQL),
    "zorder_write": (q_zorder_write, "SELECT * FROM lineitem"),
    "ingest_with_cursor": (q_ingest_with_cursor, SQL_INGEST_WITH_CURSOR),
    "county_csv_rollup": (q_county_csv_rollup, base._DIM_SQL),
    "landing_files": (q_landing_files, SQL_LANDING_FILES),
    "ingest_stamp": (q_ingest_stamp, SQL_INGEST_STAMP),
    "path_parts": (q_path_parts, SQL_PATH_PARTS),
    "hash_cluster": (q_hash_cluster, "SELECT o_custkey, count(*) AS orders, 1::BIGINT AS parts FROM orders GROUP BY ALL"),
    "ordered_csv": (q_ordered_csv, "SELECT count(*) AS lines, count(DISTINCT c_name) AS names, 0::BIGINT AS out_of_order FROM customer"),
    "profiled_rollup": (q_profiled_rollup, f"SELECT count(*) AS states, 'UTC' AS zone, true AS profiled FROM ({base._DIM_SQL})"),
    "preview": (q_preview, "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5"),
}
