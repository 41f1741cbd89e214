"""One registered query for each operator over the given tables, and the SQL that gives the same rows.

``orders`` stand in for contacts, ``lineitem`` for lab results that reach their patient through a contact, ``customer``
for patients, ``events`` for coded events with values, ``part`` for a code dictionary. These tables have no nulls and no
broken values, so both sides derive them in the same way where an operator is about them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.errors import MissingColumns, SpecError
from eventloom.functions import columns as C
from eventloom.functions import times as T
from eventloom.operators import audit, cohort, labs, lookups, shape, subjects
from eventloom.plans.config import pipeline_from
from eventloom.plans.run import build_dataset, compile_cohort, compile_subjects, event_rows, report_table, run_pipeline, stage_table
from eventloom.plans.spec import DateTimeSpec, EventSpec, FileSpec, FillSpec, LookupSpec, MeltSpec, PipelineSpec, TableSpec
from eventloom.plans.tables import compile_table
from eventloom.sources.readers import read_table
from eventloom.sources.writers import save
from eventloom.streaming.ingest import ingest, ingest_table
from eventloom.work import materialised, shared_folder

side = partial(LookupSpec, drop_source=True)
looked_up = partial(lookups.lookup, drop_source=True)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql.strip()
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


# --- sources and sinks


@query("SELECT o_custkey AS subject_id, o_orderdate AS timestamp, o_orderstatus AS code FROM orders")
def select_rename(spark, d):
    df = read_table(spark, f"{d}/orders.parquet", ["o_custkey", "o_orderdate", "o_orderstatus"])
    return shape.select_rename(df, {"o_custkey": "subject_id", "o_orderdate": "timestamp", "o_orderstatus": "code"})


@query("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer")
def csv_roundtrip(spark, d):
    path = scratch(spark, "csv")
    save(table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment"), path, "csv", sep="|", encoding="ISO-8859-1")
    return read_table(spark, path, ["c_custkey", "c_name", "c_mktsegment"], "asc", sep="|", encoding="ISO-8859-1")


@query("SELECT event_id, event_type FROM events UNION ALL SELECT event_id, event_type FROM events")
def parquet_append(spark, d):
    path, df = scratch(spark, "parquet"), table(spark, d, "events").select("event_id", "event_type")
    save(df, path), save(df, path, mode="append")
    return read_table(spark, path, ["event_id", "event_type"], "parquet")


@query("SELECT CAST(count(*) AS BIGINT) AS written, CAST(0 AS BIGINT) AS skipped FROM events")
def skip_empty(spark, d):
    df = table(spark, d, "events")
    rows = save(df, scratch(spark, "full"), skip_empty=True)
    none = save(df.filter("event_type = 'no such type'"), scratch(spark, "empty"), skip_empty=True)
    return spark.createDataFrame([(rows, none or 0)], "written bigint, skipped bigint")


@query("SELECT least(count(*), 1000) AS n, count(*) > 0 AS known FROM events")
def test_mode_limit(spark, d):
    """A quick look takes any rows, as many as asked for, and every one of them is a row of the table."""
    look = read_table(spark, f"{d}/events.parquet", ["event_id", "event_type"], test_rows=1000)
    found = look.join(table(spark, d, "events").select("event_id", F.col("event_type").alias("kind")), "event_id")
    return found.agg(F.count("*").alias("n"), F.coalesce(F.bool_and(F.col("event_type").eqNullSafe(F.col("kind"))), F.lit(False)).alias("known"))


@query("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name FROM customer")
def gzip_source(spark, d):
    path = scratch(spark, "gzip")
    table(spark, d, "customer").select("c_custkey", "c_name").write.options(header=True, compression="gzip").csv(path)
    return read_table(spark, path, ["c_custkey", "c_name"], "csv")


@query("""SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, 'line one' || chr(10) || 'of "' || p_name || '"' AS note, CASE WHEN p_size % 5 <> 0 THEN p_brand END AS brand FROM part""")
def csv_reader_options(spark, d):
    """Quoted line breaks and quotes, another quote character, and words for missing values."""
    note = F.concat(F.lit('line one\nof "'), F.col("p_name"), F.lit('"'))
    df = table(spark, d, "part").select("p_partkey", note.alias("note"), F.when(F.col("p_size") % 5 != 0, F.col("p_brand")).otherwise(F.lit("NA")).alias("brand"))
    path = scratch(spark, "quoted")
    df.write.options(header=True, sep=";", quote="'", escape="'").csv(path)
    return read_table(spark, path, ["p_partkey", "note", "brand"], "csv", sep=";", quote="'", escape="'", multi_line=True, null_words=["NA"])


@query("SELECT 'c_phone,no_such_column' AS missing, 'c_custkey,c_name' AS available, count(*) AS rows FROM customer")
def required_columns(spark, d):
    """A missing column is named before anything is read, with those that there are."""
    df = table(spark, d, "customer").select("c_custkey", "c_name")
    try:
        shape.require(df, ["c_phone", "c_name", "no_such_column"])
    except MissingColumns as error:
        return df.agg(F.lit(",".join(error.missing)).alias("missing"), F.lit(",".join(error.available)).alias("available"), F.count("*").alias("rows"))


# --- columns


@query(
    """SELECT p_partkey, CAST(p_size AS VARCHAR) AS size, CAST(9007199254740993 + p_partkey AS VARCHAR) AS long_id, CAST(1234567890123456789 - p_partkey AS VARCHAR) AS longest,
       CASE WHEN p_retailprice = floor(p_retailprice) THEN CAST(CAST(p_retailprice AS BIGINT) AS VARCHAR) END AS price, CAST(p_size * 1000 AS VARCHAR) AS exponent, CAST(NULL AS VARCHAR) AS name FROM part"""
)
def strip_zeros(spark, d):
    """Padded numbers, ids of 17 and of 19 digits, prices, numbers with an exponent, and names."""
    key, size = F.col("p_partkey").cast("bigint"), F.col("p_size").cast("string")
    long_id = F.concat(F.lit(" 00"), (F.lit(9007199254740993) + key).cast("string"), F.lit(".00"))
    return table(spark, d, "part").select(
        "p_partkey", C.strip_zeros(F.lpad(size, 6, "0")).alias("size"), C.strip_zeros(long_id).alias("long_id"), C.strip_zeros(F.lit(1234567890123456789) - key).alias("longest"),
        C.strip_zeros(F.col("p_retailprice").cast("string")).alias("price"), C.strip_zeros(F.concat(size, F.lit("e3"))).alias("exponent"), C.strip_zeros(F.col("p_name")).alias("name"),
    )


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'finished' END AS status FROM orders")
def value_map(spark, d):
    return table(spark, d, "orders").select("o_orderkey", C.from_value_map(F.col("o_orderstatus"), {"O": "open", "F": "finished"}).alias("status"))


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') || 'T10:00:00'
       WHEN o_orderkey % 3 = 1 THEN strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00' END AS stamp FROM orders"""
)
def pad_suffix(spark, d):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    text = F.when(F.col("o_orderkey") % 3 == 0, F.concat(day, F.lit("T10:00:00"))).when(F.col("o_orderkey") % 3 == 1, day)
    return table(spark, d, "orders").select("o_orderkey", C.pad_suffix(text, "T00:00:00", ":").alias("stamp"))


@query("SELECT event_id, 'E/' || nullif(event_type, 'view') AS code FROM events")
def code_prefix(spark, d):
    return table(spark, d, "events").select("event_id", C.prefixed(F.nullif(F.col("event_type"), F.lit("view")), "E/").alias("code"))


@query(
    """SELECT event_id, TRY_CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) AS digits, CAST(NULL AS DOUBLE) AS words,
       CAST(NULL AS DOUBLE) AS suffixed, CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) * 100 AS exponent FROM events"""
)
def to_numeric(spark, d):
    digits = F.regexp_extract("props", "[0-9]+", 0)
    return table(spark, d, "events").select(
        "event_id", C.to_number(digits).alias("digits"), C.to_number(F.col("event_type")).alias("words"), C.to_number(F.concat(digits, F.lit("d"))).alias("suffixed"), C.to_number(F.concat(F.lit(" "), digits, F.lit("e2 "))).alias("exponent")
    )


@query("SELECT event_id, coalesce(nullif(event_type, 'click'), props) AS code FROM events")
def fill_from_column(spark, d):
    df = table(spark, d, "events").select("event_id", F.nullif("event_type", F.lit("click")).alias("code"), "props")
    return shape.fill_nulls(df, "code", "props")


@query(
    """SELECT event_id, CASE WHEN event_type <> 'click' THEN event_type WHEN regexp_matches(props, ': ([0-4][0-9]*)\\}')
       THEN regexp_extract(props, ': ([0-4][0-9]*)\\}', 1) END AS code FROM events"""
)
def fill_from_regex(spark, d):
    df = table(spark, d, "events").select("event_id", F.nullif("event_type", F.lit("click")).alias("code"), "props")
    return shape.fill_nulls(df, "code", "props", pattern=r": ([0-4][0-9]*)\}")


@query("SELECT event_id, coalesce(nullif(event_type, 'click'), 'unknown') AS code FROM events")
def fill_literal(spark, d):
    return shape.fill_nulls(table(spark, d, "events").select("event_id", F.nullif("event_type", F.lit("click")).alias("code")), "code", value="unknown")


@query("SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN date_trunc('second', ts) END AS timestamp FROM events")
def combine_datetime(spark, d):
    day, clock = F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "HH:mm:ss")
    clock = F.when(F.col("event_id") % 20 == 0, F.lit("soon")).when(F.col("event_id") % 10 != 0, clock)
    return table(spark, d, "events").select("event_id", T.combine_date_time(day, clock).alias("timestamp"))


@query(
    """SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE date_trunc('day', ts)
       + to_hours(CASE WHEN event_id % 5 = 0 THEN 0 ELSE CAST(hour(ts) AS INTEGER) END) + to_minutes(CAST(minute(ts) AS INTEGER)) END AS timestamp FROM events"""
)
def combine_datetime_parts(spark, d):
    hour = F.when(F.col("event_id") % 7 == 0, F.lit("24")).when(F.col("event_id") % 5 != 0, F.concat(F.hour("ts").cast("string"), F.lit(".7")))
    return table(spark, d, "events").select("event_id", T.combine_parts(F.date_format("ts", "yyyy-MM-dd"), hour, F.minute("ts")).alias("timestamp"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS direct, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S.%f') AS danish FROM events")
def align_timestamps(spark, d):
    df = table(spark, d, "events")
    return df.select("event_id", T.align_time(F.col("ts"), kind=df.schema["ts"].dataType).alias("direct"), T.align_time(F.date_format("ts", "dd/MM/yyyy HH:mm:ss"), ["%d/%m/%Y %H:%M:%S"]).alias("danish"))


# --- lookups


@query("SELECT l_linenumber, l_partkey, o_custkey AS subject_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def lookup_inner(spark, d):
    return looked_up(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), table(spark, d, "orders"), "l_orderkey", "o_orderkey", {"o_custkey": "subject_id"})


@query("SELECT c_custkey, n_name AS nation FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 3 <> 0) n ON c_nationkey = n_nationkey")
def lookup_left(spark, d):
    return looked_up(table(spark, d, "customer").select("c_custkey", "c_nationkey"), table(spark, d, "nation").filter("n_nationkey % 3 <> 0"), "c_nationkey", "n_nationkey", {"n_name": "nation"}, "left")


@query("SELECT o_orderkey, c_name AS name FROM (SELECT * FROM orders WHERE o_custkey % 4 = 0) RIGHT JOIN customer ON o_custkey = c_custkey")
def lookup_right(spark, d):
    return looked_up(table(spark, d, "orders").filter("o_custkey % 4 = 0").select("o_orderkey", "o_custkey"), table(spark, d, "customer"), "o_custkey", "c_custkey", {"c_name": "name"}, "right")


@query(
    """SELECT o_orderkey, o_custkey, c_name AS name FROM (SELECT * FROM orders WHERE o_custkey % 4 = 0)
       FULL JOIN (SELECT * FROM customer WHERE c_custkey % 3 = 0) ON o_custkey = c_custkey"""
)
def lookup_full(spark, d):
    orders = table(spark, d, "orders").filter("o_custkey % 4 = 0").select("o_orderkey", "o_custkey")
    return looked_up(orders, table(spark, d, "customer").filter("c_custkey % 3 = 0"), "o_custkey", "c_custkey", {"c_name": "name"}, "outer", drop_source=False)


@query("SELECT o_orderkey, c_mktsegment AS segment FROM orders JOIN customer ON CAST(o_custkey AS VARCHAR) = CAST(c_custkey AS VARCHAR)")
def lookup_cast_keys(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("contact"))
    return looked_up(orders, table(spark, d, "customer"), "contact", "c_custkey", {"c_mktsegment": "segment"})


@query(
    """SELECT p_partkey, r_name AS region FROM part JOIN (SELECT nullif(r_regionkey, 2) AS k, r_name FROM region) r
       ON CASE WHEN p_size % 5 = 2 THEN NULL ELSE p_size % 5 END IS NOT DISTINCT FROM r.k"""
)
def lookup_null_safe(spark, d):
    part = table(spark, d, "part").select("p_partkey", F.when(F.col("p_size") % 5 != 2, F.col("p_size") % 5).alias("k"))
    region = table(spark, d, "region").select(F.nullif("r_regionkey", F.lit(2)).alias("key"), "r_name")
    return looked_up(part, region, "k", "key", {"r_name": "region"}, null_keys_match=True)


@query("SELECT c_custkey, o_orderdate AS timestamp FROM customer JOIN orders ON c_custkey = o_custkey")
def lookup_fanout(spark, d):
    customer = table(spark, d, "customer").select("c_custkey", F.col("c_custkey").alias("k"))
    return looked_up(customer, table(spark, d, "orders"), "k", "o_custkey", {"o_orderdate": "timestamp"})


@query(
    """WITH l AS (SELECT l_orderkey AS o, l_linenumber, CASE WHEN l_orderkey % 10 = 0 THEN CASE WHEN l_linenumber < 4 THEN (SELECT min(o_orderkey) FROM orders) ELSE l_orderkey END END AS contact FROM lineitem)
       SELECT o, l_linenumber, o_custkey AS person FROM l LEFT JOIN orders ON contact = o_orderkey"""
)
def lookup_salted(spark, d):
    """Nine rows in ten have no contact, and of the rest half have the same."""
    first = table(spark, d, "orders").agg(F.min("o_orderkey")).first()[0]
    contact = F.when(F.col("l_orderkey") % 10 == 0, F.when(F.col("l_linenumber") < 4, F.lit(first)).otherwise(F.col("l_orderkey")))
    df = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o"), "l_linenumber", contact.alias("contact"))
    return looked_up(df, table(spark, d, "orders"), "contact", "o_orderkey", {"o_custkey": "person"}, "left", salts=32)


LAB = {"l_orderkey": "contact_id", "l_partkey": "code", "l_linenumber": "line"}


def lab_spec(d: str, **more) -> TableSpec:
    orders = FileSpec(f"{d}/orders.parquet")
    looks = (
        side(orders, "contact_id", "o_orderkey", {"o_custkey": "person"}),
        side(orders, "contact_id", "o_orderkey", {"o_orderdate": "timestamp"}),
        side(FileSpec(f"{d}/customer.parquet"), "person", "c_custkey", {"c_name": "subject_id"}),
    )
    return TableSpec(FileSpec(f"{d}/lineitem.parquet"), LAB, lookups=looks, **more)


@query("SELECT l_partkey AS code, l_linenumber AS line, o_custkey AS person, o_orderdate AS timestamp FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def lookup_combined(spark, d):
    spec = lab_spec(d)
    return compile_table(spark, TableSpec(spec.file, spec.rename, lookups=spec.lookups[:2], dedupe=False))


@query("SELECT l_linenumber AS line, o_custkey AS person, c_name AS name, o_orderdate AS timestamp FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey")
def lookup_combined_apart(spark, d):
    """Two lookups of one file with another between them, of which only the last drops the key: one join, the key goes at last."""
    orders = FileSpec(f"{d}/orders.parquet")
    looks = (
        LookupSpec(orders, "contact_id", "o_orderkey", {"o_custkey": "person"}),
        LookupSpec(FileSpec(f"{d}/customer.parquet"), "person", "c_custkey", {"c_name": "name"}),
        side(orders, "contact_id", "o_orderkey", {"o_orderdate": "timestamp"}),
    )
    return compile_table(spark, TableSpec(FileSpec(f"{d}/lineitem.parquet"), {"l_orderkey": "contact_id", "l_linenumber": "line"}, lookups=looks, dedupe=False))


@query(
    """SELECT o.o_orderkey AS first, o.o_totalprice AS price, o.o_custkey AS x, p.o_orderstatus AS status
       FROM orders o JOIN orders p ON p.o_orderkey = o.o_custkey"""
)
def lookup_key_rewritten(spark, d):
    """The column by which a file is joined is written anew between two lookups of that file: they stay two joins."""
    orders = FileSpec(f"{d}/orders.parquet")
    looks = (
        LookupSpec(orders, "x", "o_orderkey", {"o_totalprice": "price"}),
        LookupSpec(orders, "first", "o_orderkey", {"o_custkey": "x"}),
        LookupSpec(orders, "x", "o_orderkey", {"o_orderstatus": "status"}),
    )
    raw = table(spark, d, "orders").select(F.col("o_orderkey").alias("first"), F.col("o_orderkey").alias("x"))
    return compile_table(spark, TableSpec(FileSpec("orders"), {"first": "first", "x": "x"}, lookups=looks, dedupe=False), raw=raw)


@query(
    """SELECT l_partkey AS code, l_linenumber AS line, o_orderdate AS timestamp, c_name AS subject_id
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"""
)
def lookup_two_hop(spark, d):
    return compile_table(spark, lab_spec(d, dedupe=False))


@query("SELECT l_orderkey, l_linenumber, p_name AS code FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 10) p ON l_partkey = p_partkey")
def lookup_dictionary(spark, d):
    part = table(spark, d, "part").filter("p_size > 10")
    return looked_up(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), part, "l_partkey", "p_partkey", {"p_name": "code"}, "left", dedupe=True)


# --- subjects and cleaning


@query("SELECT c_name AS source_id, dense_rank() OVER (ORDER BY c_name) + 1 AS subject_id FROM (SELECT DISTINCT c_name FROM customer)")
def subject_ids(spark, d):
    return subjects.subject_ids(table(spark, d, "customer"), "c_name")


@query(
    """WITH f AS (SELECT DISTINCT c_name FROM customer WHERE c_custkey % 3 <> 0), g AS (SELECT DISTINCT c_name FROM customer WHERE c_custkey % 3 = 0 AND c_custkey % 4 <> 0 AND c_name NOT IN (SELECT c_name FROM f)),
       h AS (SELECT DISTINCT c_name FROM customer WHERE c_name NOT IN (SELECT c_name FROM f UNION ALL SELECT c_name FROM g))
       SELECT c_name AS source_id, dense_rank() OVER (ORDER BY c_name) + 1 AS subject_id, 1 AS version FROM f
       UNION ALL SELECT c_name, (SELECT count(*) FROM f) + dense_rank() OVER (ORDER BY c_name) + 1, 2 FROM g
       UNION ALL SELECT c_name, (SELECT count(*) FROM f) + (SELECT count(*) FROM g) + dense_rank() OVER (ORDER BY c_name) + 1, 3 FROM h"""
)
def subject_ids_kept(spark, d):
    """A map over four loads, each with ids of the earlier ones: they keep their numbers, new ones follow; the last has none."""
    customer, path = table(spark, d, "customer"), scratch(spark, "ids")
    for load in ("c_custkey % 3 <> 0", "c_custkey % 4 <> 0", "true", "c_custkey % 2 = 0"):
        out = subjects.extend_id_map(customer.filter(load), "c_name", path)
    return out.select("source_id", "subject_id", "version")


@query(
    """WITH m AS (SELECT c_name, dense_rank() OVER (ORDER BY c_name) + 1 AS id FROM (SELECT DISTINCT c_name FROM customer WHERE c_custkey % 5 <> 0))
       SELECT m.id AS subject_id, o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey JOIN m USING (c_name)"""
)
def map_subjects(spark, d):
    customer = table(spark, d, "customer")
    named = looked_up(table(spark, d, "orders").select("o_orderkey", "o_custkey"), customer, "o_custkey", "c_custkey", {"c_name": "subject_id"})
    return subjects.map_subjects(named, subjects.subject_ids(customer.filter("c_custkey % 5 <> 0"), "c_name")).select("subject_id", "o_orderkey")


@query("SELECT user_id AS subject_id, event_type AS code, ts AS timestamp FROM events WHERE event_type <> 'view' AND event_id % 4 <> 0")
def mandatory_dropna(spark, d):
    timestamp = F.when(F.col("event_id") % 4 != 0, F.col("ts")).alias("timestamp")
    return shape.drop_incomplete(table(spark, d, "events").select(F.col("user_id").alias("subject_id"), F.nullif("event_type", F.lit("view")).alias("code"), timestamp))


@query("SELECT DISTINCT user_id, event_type FROM events")
def dedupe_rows(spark, d):
    return shape.drop_repeats(table(spark, d, "events").select("user_id", "event_type"))


@query("SELECT DISTINCT CAST(o_custkey AS BIGINT) AS subject_id, c_mktsegment AS code FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 0")
def known_patients(spark, d):
    patients = table(spark, d, "customer").select(F.when(F.col("c_acctbal") > 0, F.col("c_custkey")).alias("subject_id"), F.col("c_mktsegment").alias("code"))
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("k"))
    known = labs.whole_subject_ids(subjects.known_patients(patients))
    return shape.drop_repeats(looked_up(orders, known.withColumn("key", F.col("subject_id")), "k", "key", {"subject_id": "subject_id", "code": "code"}))


# --- reshape


MELT = """SELECT o_orderkey, 'IN/' || o_orderstatus AS code, o_orderdate AS timestamp FROM orders
UNION ALL SELECT o_orderkey, 'OUT/' || o_orderstatus, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate + INTERVAL 2 DAY END FROM orders"""


def stays(spark, d):
    out = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderdate") + F.expr("INTERVAL 2 DAYS"))
    return table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("code"), F.col("o_orderdate").alias("timestamp_in"), out.alias("timestamp_out"))


@query(MELT)
def melt_admissions(spark, d):
    return shape.melt(stays(spark, d), {"timestamp_in": "IN/", "timestamp_out": "OUT/"}, "timestamp", "code")


@query(f"""WITH m AS ({MELT}), w AS (SELECT *, 'a' AS x, 'b' AS y FROM m)
SELECT o_orderkey, 'X/' || code AS code, timestamp, x AS value FROM w UNION ALL SELECT o_orderkey, 'Y/' || code, timestamp, y FROM w""")
def melt_chain(spark, d):
    df = stays(spark, d).withColumns({"x": F.lit("a"), "y": F.lit("b")})
    first = {"columns": {"timestamp_in": "IN/", "timestamp_out": "OUT/"}, "into": "timestamp", "prefix_column": "code"}
    return shape.melt_chain(df, [first, {"columns": {"x": "X/", "y": "Y/"}, "into": "value", "prefix_column": "code"}])


@query(
    """SELECT o_custkey AS subject_id, o_orderdate AS timestamp, 'S/' || o_orderstatus AS code FROM orders
       UNION ALL SELECT o_custkey, o_orderdate, 'P/' || o_orderpriority FROM orders"""
)
def unroll_codes(spark, d):
    df = shape.select_rename(table(spark, d, "orders"), {"o_custkey": "subject_id", "o_orderdate": "timestamp", "o_orderkey": "code", "o_orderstatus": "status", "o_orderpriority": "priority"})
    return shape.unroll(df, {"status": "S/", "priority": "P/", "absent": "N/"})


@query("SELECT c_custkey AS id, c_name AS name, CAST(NULL AS VARCHAR) AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, 'S' FROM supplier")
def stack_tables(spark, d):
    customer = shape.select_rename(table(spark, d, "customer"), {"c_custkey": "id", "c_name": "name"})
    supplier = table(spark, d, "supplier").select(F.lit("S").alias("segment"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"))
    return shape.stack(customer, supplier)


# --- labs


def values(spark, d):
    return table(spark, d, "events").select("event_id", F.col("event_type").alias("code"), F.col("value").alias("numeric_value"))


def rounded(stats: DataFrame, names: list[str]) -> DataFrame:
    return stats.select("code", *(F.round(F.col("cuts")[i], 6).alias(n) for i, n in enumerate(names)))


RANGE = "SELECT event_type AS code, round(quantile_cont(value, 0.01), 6) AS p01, round(quantile_cont(value, 0.99), 6) AS p99 FROM events GROUP BY event_type"


@query(RANGE)
def lab_range(spark, d):
    return rounded(labs.fit(values(spark, d), "minmax"), ["p01", "p99"])


@query(RANGE)
def lab_range_sorted(spark, d):
    return rounded(labs.fit(values(spark, d), "minmax", how="sorted"), ["p01", "p99"])


@query("SELECT event_type AS code, true AS p01_near, true AS p99_near FROM events GROUP BY event_type")
def lab_range_approx(spark, d):
    """Approximate cut points: the share of a code's values below each is the asked one, within the error of the accuracy."""
    v, allowed = values(spark, d), 2 / 1000
    stats = labs.fit(v, "minmax", how="approx", accuracy=1000).select("code", F.col("cuts")[0].alias("lo"), F.col("cuts")[1].alias("hi"))
    share = lambda c, p: (F.avg((F.col("numeric_value") < F.col(c)).cast("double")) <= p + allowed) & (F.avg((F.col("numeric_value") <= F.col(c)).cast("double")) >= p - allowed)
    return v.join(stats, "code").groupBy("code").agg(share("lo", 0.01).alias("p01_near"), share("hi", 0.99).alias("p99_near"))


@query("SELECT event_type AS code, count(value) AS n_values, true AS p01_near, true AS p99_near FROM events GROUP BY event_type")
def lab_range_merged(spark, d):
    """Cut points from the saved sketches of two loads: their ranks among all values are the asked ones, within the stated error."""
    v, paths, allowed = values(spark, d), [scratch(spark, "sketches") for _ in range(2)], 0.006
    for part, path in enumerate(paths):
        save(labs.sketches(v.filter(F.col("event_id") % 2 == part)), path)
    stats = labs.fit_sketches(labs.merged_sketches(*map(spark.read.parquet, paths)))
    stats = stats.select("code", "n_values", F.col("cuts")[0].alias("lo"), F.col("cuts")[1].alias("hi"))
    near = lambda c, p: (F.avg((F.col("numeric_value") < F.col(c)).cast("double")) <= p + allowed) & (F.avg((F.col("numeric_value") <= F.col(c)).cast("double")) >= p - allowed)
    return v.join(stats, "code").groupBy("code", "n_values").agg(near("lo", 0.01).alias("p01_near"), near("hi", 0.99).alias("p99_near"))


@query("SELECT event_type AS code, round(quantile_cont(value, 0.25), 6) AS q1, round(quantile_cont(value, 0.5), 6) AS q2, round(quantile_cont(value, 0.75), 6) AS q3 FROM events GROUP BY event_type")
def lab_quartiles(spark, d):
    return rounded(labs.fit(values(spark, d), "category"), ["q1", "q2", "q3"])


@query("SELECT event_type AS code, " + ", ".join(f"round(quantile_cont(value, {i / 5}), 6) AS c{i}" for i in range(1, 6)) + " FROM events GROUP BY event_type")
def lab_cutpoints(spark, d):
    return rounded(labs.fit(values(spark, d), "quantile", 5), [f"c{i}" for i in range(1, 6)])


SCALED = "round_even(greatest(0, least(1, (value - lo) / (hi - lo))), 3)"


@query(
    f"""WITH e AS (SELECT event_id, CASE WHEN event_id % 50 = 0 THEN 'single' WHEN event_id % 11 = 0 THEN NULL ELSE event_type END AS code,
         CASE WHEN event_id % 50 = 0 THEN 7.5 ELSE value END AS value FROM events),
       s AS (SELECT code, quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi FROM e WHERE code IS NOT NULL GROUP BY code)
       SELECT event_id, e.code, CASE WHEN lo < hi THEN {SCALED} END AS numeric_value,
         CASE WHEN lo IS NULL THEN 'N/A' WHEN lo = hi THEN 'UNIQUE' END AS value_label FROM e LEFT JOIN s ON e.code = s.code"""
)
def normalize_minmax(spark, d):
    single = F.col("event_id") % 50 == 0
    df = values(spark, d).select("event_id", F.when(single, F.lit("single")).when(F.col("event_id") % 11 != 0, F.col("code")).alias("code"), F.when(single, F.lit(7.5)).otherwise(F.col("numeric_value")).alias("numeric_value"))
    return labs.normalise(df, "minmax")


def label_sql(cuts: list[float], last: int) -> str:
    cases = " ".join(f"WHEN value <= c{i} THEN 'Q{i + 1}'" for i in range(len(cuts)))
    stats = ", ".join(f"quantile_cont(value, {c}) AS c{i}" for i, c in enumerate(cuts))
    return f"""WITH s AS (SELECT event_type, {stats} FROM events GROUP BY event_type)
SELECT event_id, event_type AS code, CAST(NULL AS DOUBLE) AS numeric_value, CASE {cases} ELSE 'Q{last}' END AS value_label FROM events JOIN s USING (event_type)"""


@query(label_sql([i / 10 for i in range(1, 11)], 10))
def normalize_quantiles(spark, d):
    return labs.normalise(values(spark, d), "quantile", 10)


@query(label_sql([0.25, 0.5, 0.75], 4))
def normalize_quartiles(spark, d):
    return labs.normalise(values(spark, d), "category")


@query(
    f"""WITH e AS (SELECT event_id, event_type AS code, CASE WHEN event_id % 9 <> 0 THEN value END AS value FROM events),
       s AS (SELECT code, quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi FROM e WHERE value IS NOT NULL GROUP BY code)
       SELECT event_id, e.code, CASE WHEN value IS NOT NULL THEN {SCALED} END AS numeric_value,
         CASE WHEN value IS NULL THEN 'Positive' END AS value_label FROM e JOIN s ON e.code = s.code"""
)
def normalize_passthrough(spark, d):
    text = F.when(F.col("event_id") % 9 == 0, F.lit("Positive")).otherwise(F.col("numeric_value").cast("string"))
    return labs.normalise(values(spark, d).withColumn("numeric_value", text), "minmax")


@query(
    f"""WITH s AS (SELECT event_type, quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi FROM events GROUP BY event_type),
       n AS (SELECT event_id, event_type AS code, CAST(CASE WHEN lo < hi THEN {SCALED} END AS VARCHAR) AS numeric_value FROM events JOIN s USING (event_type))
       SELECT * FROM n UNION ALL SELECT * FROM n"""
)
def normalize_written(spark, d):
    """Normalised rows through the CSV sink, overwritten and then appended to; the statistics are saved and used again."""
    path, stats = scratch(spark, "normalised"), scratch(spark, "statistics")
    for mode in ("overwrite", "append"):
        save(labs.normalise(values(spark, d), "minmax", statistics=stats).drop("value_label"), path, "csv", mode)
    return read_table(spark, path, ["event_id", "code", "numeric_value"], "csv").withColumn("event_id", F.col("event_id").cast("bigint"))


@query(
    """WITH e AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'absent' ELSE event_type END AS code, value FROM events),
       s AS (SELECT event_type, quantile_cont(value, 0.5) AS q1 FROM events GROUP BY event_type)
       SELECT event_id, code, CASE WHEN q1 IS NULL THEN 'N/A' WHEN value <= q1 THEN 'Q1' ELSE 'Q2' END AS numeric_value FROM e LEFT JOIN s ON code = event_type"""
)
def normalize_single_column(spark, d):
    """Two quantiles in one text column, and codes that the statistics do not know."""
    df = values(spark, d)
    stats = labs.fit(df, "quantile", 2)
    return labs.apply(df.withColumn("code", F.when(F.col("event_id") % 7 == 0, F.lit("absent")).otherwise(F.col("code"))), stats, "quantile", 2, single_column=True)


@query(
    """SELECT 'another method' AS asked, 'minmax' AS saved, count(DISTINCT event_type) AS codes FROM events
       UNION ALL SELECT 'other points', 'quantile', count(DISTINCT event_type) FROM events UNION ALL SELECT 'the same', 'quantile', count(DISTINCT event_type) FROM events"""
)
def normalize_saved_statistics(spark, d):
    """Saved statistics serve the method and the points that they were fitted for, and no other."""
    df, out = values(spark, d), []
    for asked, saved, n, wanted in (("another method", "minmax", 10, "quantile"), ("other points", "quantile", 4, "quantile"), ("the same", "quantile", 10, "quantile")):
        path = scratch(spark, "statistics")
        labs.save_statistics(labs.fit(df, saved, n), path, saved, n)
        try:
            labs.normalise(df, wanted, 10, statistics=path)
            found = asked == "the same"
        except SpecError:
            found = asked != "the same"
        out.append(spark.read.parquet(path).agg(F.lit(asked).alias("asked"), F.lit(saved).alias("saved"), F.count("*").alias("codes")).filter(F.lit(found)))
    return shape.stack(*out)


@query(
    """SELECT m.method, m.points, count(*) AS rows, count(*) FILTER (m.method <> 'minmax') AS labelled FROM events, (VALUES ('minmax', 2), ('quantile', 4), ('category', 3)) m(method, points) GROUP BY m.method, m.points
       UNION ALL SELECT 'zscore', -1, count(*), 0 FROM events UNION ALL SELECT 'no value', -2, count(*), 0 FROM events"""
)
def normalize_dispatch(spark, d):
    """Every method by its name, an unknown one, and a table that lacks the value column."""
    df, out = values(spark, d), []
    for method, n in (("minmax", 10), ("quantile", 4), ("category", 10), ("zscore", 10), ("no value", 10)):
        given, points = (df.drop("numeric_value"), -2) if method == "no value" else (df, 0)
        try:
            given = labs.normalise(given, "minmax" if method == "no value" else method, n)
            points = len(labs.cut_points(method, n))
        except MissingColumns as error:
            points = points if error.missing == ["numeric_value"] else 0
        except ValueError:
            points = -1
        labelled = F.count("value_label") if points > 0 else F.lit(0).cast("bigint")
        out.append(given.agg(F.lit(method).alias("method"), F.lit(points).alias("points"), F.count("*").alias("rows"), labelled.alias("labelled")))
    return shape.stack(*out)


BUCKET = "(('0x' || substr(md5(CAST({} AS VARCHAR)), 1, 8))::BIGINT / 4294967296.0)"


@query(
    f"""WITH e AS (SELECT event_id, event_type AS code, value, {BUCKET.format("event_id")} AS b FROM events),
       s AS (SELECT code, quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi FROM e WHERE b < 0.8 GROUP BY code)
       SELECT event_id, e.code, CASE WHEN lo < hi THEN {SCALED} END AS numeric_value, CASE WHEN lo IS NULL THEN 'N/A' WHEN lo = hi THEN 'UNIQUE' END AS value_label
       FROM e LEFT JOIN s ON e.code = s.code WHERE b >= 0.8"""
)
def normalize_fit_train(spark, d):
    df, train = values(spark, d), cohort.bucket(F.col("event_id")) < 0.8
    return labs.apply(df.filter(~train), labs.fit(df.filter(train), "minmax"), "minmax")


# --- events and cohort


PATIENT_EVENTS = {"segment": EventSpec(["SEGMENT", "col(c_mktsegment)"]), "nation": EventSpec(["NATION", "col(c_nationkey)"])}
ORDER_EVENTS = {
    "placed": EventSpec(["ORDER", "col(o_orderstatus)"], "col(o_orderdate)", numeric_value="col(o_totalprice)"),
    "priority": EventSpec(["PRIORITY", "col(o_orderpriority)"], "col(o_orderdate)"),
}
VALUE_EVENTS = {"value": EventSpec(["E", "col(event_type)"], "col(ts)", numeric_value="col(value)")}
STATIC_SQL = """SELECT c_custkey AS subject_id, CAST(NULL AS TIMESTAMP) AS time, 'SEGMENT//' || c_mktsegment AS code, CAST(NULL AS {0}) AS numeric_value FROM customer
UNION ALL SELECT c_custkey, NULL, 'NATION//' || CAST(c_nationkey AS VARCHAR), NULL FROM customer"""
MULTI_SQL = """SELECT o_custkey AS subject_id, o_orderdate AS time, 'ORDER//' || o_orderstatus AS code, CAST(o_totalprice AS {0}) AS numeric_value FROM orders
UNION ALL SELECT o_custkey, o_orderdate, 'PRIORITY//' || o_orderpriority, NULL FROM orders"""
NUMERIC_SQL = "SELECT user_id AS subject_id, ts AS time, 'E//' || event_type AS code, CAST(value AS {0}) AS numeric_value FROM events"
COHORT_SQL = f"SELECT DISTINCT * FROM ({STATIC_SQL} UNION ALL {MULTI_SQL} UNION ALL {NUMERIC_SQL})".format("FLOAT")


@query(STATIC_SQL.format("DOUBLE"))
def events_static(spark, d):
    return cohort.events(table(spark, d, "customer"), PATIENT_EVENTS, "c_custkey")


@query(MULTI_SQL.format("DOUBLE"))
def events_multi(spark, d):
    return cohort.events(table(spark, d, "orders"), ORDER_EVENTS, "o_custkey")


@query(NUMERIC_SQL.format("DOUBLE"))
def events_numeric(spark, d):
    return cohort.events(table(spark, d, "events"), VALUE_EVENTS, "user_id")


@query("SELECT user_id AS subject_id, date_trunc('second', ts) AS time, 'E//' || event_type AS code, CAST(NULL AS DOUBLE) AS numeric_value FROM events WHERE event_id % 6 <> 0")
def events_unreadable_time(spark, d):
    """Timed events whose time fits no format are left out; two formats are read."""
    e = F.col("event_id")
    text = F.when(e % 6 == 0, F.lit("2024-13-45 soon")).when(e % 2 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).otherwise(F.date_format("ts", "dd/MM/yyyy HH.mm.ss"))
    df = table(spark, d, "events").select("user_id", "event_type", text.alias("t"))
    return cohort.events(df, {"e": EventSpec(["E", "col(event_type)"], "col(t)", ("%Y-%m-%d %H:%M:%S", "%d/%m/%Y %H.%M.%S"))}, "user_id")


def whole_cohort(spark, d, whole_subjects=False):
    rows = sum(table(spark, d, name).count() * len(specs) for name, specs in (("customer", PATIENT_EVENTS), ("orders", ORDER_EVENTS), ("events", VALUE_EVENTS)))
    return cohort.cohort(events_static(spark, d), events_multi(spark, d), events_numeric(spark, d), rows=rows, whole_subjects=whole_subjects)


@query(COHORT_SQL)
def cohort_events(spark, d):
    return whole_cohort(spark, d)


@query(f"SELECT *, CAST(row_number() OVER (PARTITION BY subject_id ORDER BY time NULLS FIRST, code, numeric_value NULLS FIRST) AS INTEGER) AS position FROM ({COHORT_SQL})")
def cohort_ordered(spark, d):
    return cohort.ordered(whole_cohort(spark, d))


SPLIT_CASE = "CASE WHEN {0} < 0.8 THEN 'train' WHEN {0} < 0.9 THEN 'tuning' ELSE 'held_out' END AS split"


@query(f"SELECT c_custkey AS subject_id, {SPLIT_CASE.format(BUCKET.format('c_custkey'))} FROM customer")
def split_hash(spark, d):
    return cohort.split_subjects(table(spark, d, "customer"), id_column="c_custkey")


@query(
    f"""WITH r AS (SELECT c_custkey, (row_number() OVER (ORDER BY md5(CAST(c_custkey AS VARCHAR)), CAST(c_custkey AS VARCHAR)) - 1) / CAST(count(*) OVER () AS DOUBLE) AS x FROM customer)
       SELECT c_custkey AS subject_id, {SPLIT_CASE.format("x")} FROM r"""
)
def split_exact(spark, d):
    return cohort.split_subjects(table(spark, d, "customer"), id_column="c_custkey", exact=True)


@query(f"SELECT c_custkey AS subject_id, CASE WHEN c_custkey % 10 = 0 THEN 'held_out' ELSE x.split END AS split FROM (SELECT c_custkey, {SPLIT_CASE.format(BUCKET.format('c_custkey'))} FROM customer) x")
def split_override(spark, d):
    customer = table(spark, d, "customer")
    given = customer.filter("c_custkey % 10 = 0").select(F.col("c_custkey").alias("subject_id"), F.lit("held_out").alias("split"))
    return cohort.split_subjects(customer, override=given, id_column="c_custkey")


@query(f"SELECT c_custkey AS subject_id, CASE WHEN c_custkey % 6 = 0 THEN 'tuning' ELSE x.split END AS split FROM (SELECT c_custkey, {SPLIT_CASE.format(BUCKET.format('c_custkey'))} FROM customer) x")
def split_override_repeated(spark, d):
    """Subjects that are named several times for one split, and others that there are not."""
    given = table(spark, d, "orders").filter("o_custkey % 6 = 0").select(F.col("o_custkey").alias("subject_id"), F.lit("tuning").alias("split"))
    more = table(spark, d, "customer").filter("c_custkey % 6 = 0").select(F.col("c_custkey").alias("subject_id"), F.lit("tuning").alias("split"))
    absent = more.select((-1 - F.col("subject_id")).alias("subject_id"), F.lit("train").alias("split"))
    return cohort.split_subjects(table(spark, d, "customer"), override=shape.stack(given, more, absent), id_column="c_custkey")


@query(
    f"""SELECT subject_id, time, code, numeric_value, split
       FROM ({COHORT_SQL}) JOIN (SELECT c_custkey AS subject_id, {SPLIT_CASE.format(BUCKET.format("c_custkey"))} FROM customer) USING (subject_id)"""
)
def cohort_written(spark, d):
    path = scratch(spark, "cohort")
    cohort.write_cohort(whole_cohort(spark, d, whole_subjects=True), split_hash(spark, d), path)
    return cohort.read_cohort(spark, path).select("subject_id", "time", "code", "numeric_value", F.col("split").cast("string").alias("split"))


SIZED = 1500  # events of one file


@query(
    f"""WITH e AS ({COHORT_SQL}), s AS (SELECT c_custkey AS subject_id, {SPLIT_CASE.format(BUCKET.format("c_custkey"))} FROM customer)
       SELECT split, count(*) AS n_events, count(DISTINCT subject_id) AS n_subjects, CAST(count(DISTINCT subject_id) AS BIGINT) AS places, CAST(ceil(count(*) / {SIZED}.0) AS BIGINT) AS files, true AS alike FROM e JOIN s USING (subject_id) GROUP BY split"""
)
def cohort_by_size(spark, d):
    """Files by events: as many as the wanted size asks for, the largest at most twice the smallest, each subject in one."""
    path = scratch(spark, "cohort")
    cohort.write_cohort(whole_cohort(spark, d, whole_subjects=True), split_hash(spark, d), path, rows_per_file=SIZED)
    # the many files are read once
    each = materialised(cohort.read_cohort(spark, path).groupBy("split", F.input_file_name().alias("file"), "subject_id").agg(F.count("*").alias("n")))
    sizes = each.groupBy("split", "file").agg(F.sum("n").alias("n"), F.count("subject_id").alias("subjects"))
    per_split = sizes.groupBy("split").agg(F.sum("n").alias("n_events"), F.sum("subjects").alias("places"), F.count("*").alias("files"), (F.max("n") <= 2 * F.min("n")).alias("alike"))
    people = each.groupBy("split").agg(F.count_distinct("subject_id").alias("n_subjects"))
    return per_split.join(people, "split").select(F.col("split").cast("string").alias("split"), "n_events", "n_subjects", "places", "files", "alike")


@query(SQL["cohort_written"])
def cohort_merged(spark, d):
    """A cohort of two thirds of the events, into which those of later times are merged, with some that it has already."""
    path, whole, splits = scratch(spark, "cohort"), whole_cohort(spark, d, whole_subjects=True), split_hash(spark, d)
    part = F.pmod(F.hash("subject_id", "time", "code"), F.lit(3))
    early = F.col("subject_id") % 10 < 8
    cohort.write_cohort(whole.filter(early & (part < 2)), splits, path, rows_per_file=SIZED)
    cohort.merge_cohort(whole.filter(~early | (part > 0)), splits, path)
    return cohort.read_cohort(spark, path).select("subject_id", "time", "code", "numeric_value", F.col("split").cast("string").alias("split"))


METADATA_SQL = """SELECT code, count(*) AS n_events, count(DISTINCT subject_id) AS n_subjects, count(numeric_value) AS n_values, round(sum(CAST(numeric_value AS DOUBLE)), 2) AS value_sum,
min(CAST(numeric_value AS DOUBLE)) AS value_min, max(CAST(numeric_value AS DOUBLE)) AS value_max FROM ({}) GROUP BY code"""


@query(METADATA_SQL.format(COHORT_SQL))
def code_metadata(spark, d):
    return cohort.code_metadata(whole_cohort(spark, d)).withColumn("value_sum", F.round("value_sum", 2)).drop("value_sum_sq")


WHOLE_METADATA_SQL = METADATA_SQL.replace("AS value_sum,", "AS value_sum, round(sum(CAST(numeric_value AS DOUBLE) * CAST(numeric_value AS DOUBLE)), -3) AS value_sum_sq,")


def rounded_sums(metadata: DataFrame) -> DataFrame:
    return metadata.withColumns({"value_sum": F.round("value_sum", 2), "value_sum_sq": F.round("value_sum_sq", -3)})


@query(WHOLE_METADATA_SQL.format(COHORT_SQL))
def code_metadata_whole(spark, d):
    """All columns, the sum of squares included."""
    return rounded_sums(cohort.code_metadata(whole_cohort(spark, d)))


@query(WHOLE_METADATA_SQL.format(COHORT_SQL))
def code_metadata_merged(spark, d):
    """Metadata of a cohort from the saved states of two loads, whose subjects overlap."""
    whole, paths = whole_cohort(spark, d), [scratch(spark, "states") for _ in range(2)]
    for part, path in enumerate(paths):
        save(cohort.code_states(whole.filter(F.pmod(F.hash("code", "time", "numeric_value"), F.lit(2)) == part)), path)
    return rounded_sums(cohort.metadata_of_states(cohort.merged_states(*map(spark.read.parquet, paths))))


@query(
    f"""WITH c AS ({COHORT_SQL}), s AS (SELECT c_custkey, {SPLIT_CASE.format(BUCKET.format("c_custkey"))} FROM customer)
       SELECT 'synthetic' AS dataset_name, '1.0' AS dataset_version, (SELECT count(*) FROM c) AS n_events, (SELECT count(DISTINCT subject_id) FROM c) AS n_subjects,
         count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'tuning') AS tuning, count(*) FILTER (split = 'held_out') AS held_out FROM s"""
)
def dataset_metadata(spark, d):
    meta = cohort.dataset_metadata(whole_cohort(spark, d), split_hash(spark, d), "synthetic", "1.0")
    return meta.select("dataset_name", "dataset_version", "n_events", "n_subjects", *(F.col("subjects_by_split")[s].alias(s) for s in cohort.SPLITS))


# --- pipelines


PATIENTS = {"c_name": "subject_id", "c_mktsegment": "gender"}
IDS_SQL = "(SELECT c_name, c_custkey, dense_rank() OVER (ORDER BY c_name) + 1 AS id FROM customer)"
TABLE_SQL = f"""SELECT DISTINCT id AS subject_id, 'LAB/' || CAST(l_partkey AS VARCHAR) AS code, o_orderdate AS timestamp, CAST(l_quantity AS DOUBLE) AS numeric_value
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN {IDS_SQL} ON o_custkey = c_custkey"""


def lab_table(d: str) -> TableSpec:
    spec = lab_spec(d)
    return TableSpec(spec.file, {"l_orderkey": "contact_id", "l_partkey": "code", "l_quantity": "numeric_value"}, lookups=spec.lookups, code_prefix="LAB/", numeric=("numeric_value",))


def clinic(d: str) -> PipelineSpec:
    stays_ = TableSpec(
        FileSpec(f"{d}/orders.parquet"),
        {"o_custkey": "person", "o_orderdate": "timestamp", "o_orderstatus": "status", "o_orderpriority": "priority"},
        lookups=(side(FileSpec(f"{d}/customer.parquet"), "person", "c_custkey", {"c_name": "subject_id"}),),
        unroll={"status": "S/", "priority": "P/"},
    )
    broken = TableSpec(FileSpec(f"{d}/orders.parquet"), {"no_such_column": "code"})
    events_ = {
        "subject": {"gender": EventSpec(["GENDER", "col(gender)"])},
        "labs": {"lab": EventSpec("col(code)", "col(timestamp)", numeric_value="col(numeric_value)")},
        "stays": {"stay": EventSpec("col(code)", "col(timestamp)")},
    }
    return PipelineSpec(FileSpec(f"{d}/customer.parquet"), PATIENTS, {"labs": lab_table(d), "stays": stays_, "broken": broken}, events_)


@query(TABLE_SQL)
def pipeline_table(spark, d):
    _, id_map = compile_subjects(spark, clinic(d))
    return compile_table(spark, lab_table(d), id_map).select("subject_id", "code", "timestamp", "numeric_value")


@query(f"SELECT id AS subject_id, 'S/' || c_mktsegment AS code, o_orderdate AS timestamp, n_name AS nation FROM orders JOIN {IDS_SQL} ON o_custkey = c_custkey JOIN customer USING (c_custkey) JOIN nation ON c_nationkey = n_nationkey")
def pipeline_subject_lookup(spark, d):
    """A lookup by subject_id, which stays the raw id until all lookups are done."""
    _, id_map = compile_subjects(spark, clinic(d))
    raw = looked_up(table(spark, d, "orders").select("o_custkey", "o_orderdate"), table(spark, d, "customer"), "o_custkey", "c_custkey", {"c_name": "name"})
    customer = FileSpec(f"{d}/customer.parquet")
    looks = (LookupSpec(customer, "subject_id", "c_name", {"c_mktsegment": "code", "c_nationkey": "home"}), side(FileSpec(f"{d}/nation.parquet"), "home", "n_nationkey", {"n_name": "nation"}))
    spec = TableSpec(FileSpec("orders"), {"name": "subject_id", "o_orderdate": "timestamp"}, lookups=looks, code_prefix="S/", dedupe=False)
    return compile_table(spark, spec, id_map, raw=raw)


@query(
    """WITH p AS (SELECT c_name, c_custkey, dense_rank() OVER (ORDER BY c_name) + 1 AS id FROM customer WHERE c_custkey % 7 = 0)
       SELECT id AS subject_id, 'LAB/' || l_partkey AS code, o_orderdate AS timestamp, CAST(l_quantity AS DOUBLE) AS numeric_value FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN p ON o_custkey = c_custkey"""
)
def pipeline_known_early(spark, d):
    """A seventh of the people is known: the lookup that finds subjects joins these alone."""
    ids = subjects.subject_ids(table(spark, d, "customer").filter("c_custkey % 7 = 0"), "c_name")
    return compile_table(spark, replace(lab_table(d), dedupe=False), ids).select("subject_id", "code", "timestamp", "numeric_value")


@query(f"SELECT id AS subject_id, o_orderstatus AS code, o_orderdate AS timestamp FROM orders JOIN {IDS_SQL} ON o_custkey = c_custkey")
def pipeline_subject_fill(spark, d):
    """Missing subject_ids are filled before ids are mapped."""
    _, id_map = compile_subjects(spark, clinic(d))
    named = looked_up(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus"), table(spark, d, "customer"), "o_custkey", "c_custkey", {"c_name": "name"})
    raw = named.withColumns({"first": F.when(F.col("o_orderkey") % 3 != 0, F.col("name")), "second": F.when(F.col("o_orderkey") % 3 == 0, F.col("name"))})
    spec = TableSpec(FileSpec("orders"), {"first": "subject_id", "second": "other", "o_orderdate": "timestamp", "o_orderstatus": "code"}, fill=(FillSpec("subject_id", "other"),), dedupe=False)
    return compile_table(spark, spec, id_map, raw=raw)


@query(f"""SELECT x.split, count(*) AS n_events, CAST(count(DISTINCT id) AS BIGINT) AS n_subjects FROM (SELECT DISTINCT * FROM (
         SELECT id, NULL AS time, 'GENDER//' || c_mktsegment AS code, CAST(NULL AS FLOAT) AS v FROM {{0}} JOIN customer USING (c_custkey)
         UNION ALL SELECT subject_id, timestamp, code, CAST(numeric_value AS FLOAT) FROM ({{1}})
         UNION ALL SELECT id, o_orderdate, 'S/' || o_orderstatus, NULL FROM orders JOIN {{0}} ON o_custkey = c_custkey
         UNION ALL SELECT id, o_orderdate, 'P/' || o_orderpriority, NULL FROM orders JOIN {{0}} ON o_custkey = c_custkey)) e,
         LATERAL (SELECT {SPLIT_CASE.format(BUCKET.format("e.id"))}) x GROUP BY x.split""".format(IDS_SQL, TABLE_SQL))
def dataset_in_one_call(spark, d):
    """Raw tables to a written cohort with splits and metadata."""
    out = scratch(spark, "dataset")
    build_dataset(spark, clinic(d), out)
    back = cohort.read_cohort(spark, f"{out}/data")
    return back.groupBy(F.col("split").cast("string").alias("split"), "subject_id").agg(F.count("*").alias("n")).groupBy("split").agg(F.sum("n").alias("n_events"), F.count("*").alias("n_subjects"))


@query(
    f"""SELECT 'subject' AS "table", 'written' AS status, count(*) AS rows FROM customer UNION ALL SELECT 'labs', 'written', count(*) FROM ({TABLE_SQL})
       UNION ALL SELECT 'stays', 'written', count(*) FROM (SELECT DISTINCT id, o_orderdate, 'S/' || o_orderstatus FROM orders JOIN {IDS_SQL} ON o_custkey = c_custkey
         UNION ALL SELECT DISTINCT id, o_orderdate, 'P/' || o_orderpriority FROM orders JOIN {IDS_SQL} ON o_custkey = c_custkey)
       UNION ALL SELECT 'broken', 'failed', NULL"""
)
def pipeline_report(spark, d):
    return report_table(spark, run_pipeline(spark, clinic(d), scratch(spark, "clinic"))).drop("message")


LOST = """WITH p AS (SELECT c_name, c_custkey FROM customer WHERE c_custkey % 5 <> 0),
l AS (SELECT l_partkey, l_quantity, o_orderdate, o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
s AS (SELECT o_custkey, o_orderdate, 'S/' || o_orderstatus AS code FROM orders JOIN customer ON o_custkey = c_custkey UNION ALL SELECT o_custkey, o_orderdate, 'P/' || o_orderpriority FROM orders JOIN customer ON o_custkey = c_custkey),
n AS (SELECT 'labs' AS "table", 0 AS place, 'read' AS stage, count(*) AS rows FROM lineitem UNION ALL SELECT 'labs', 1, 'lookups', count(*) FROM l
  UNION ALL SELECT 'labs', 2, 'known', count(*) FROM l JOIN p ON o_custkey = c_custkey UNION ALL SELECT 'labs', 3, 'complete', count(*) FROM l JOIN p ON o_custkey = c_custkey
  UNION ALL SELECT 'labs', 4, 'distinct', count(*) FROM (SELECT DISTINCT l_partkey, l_quantity, o_orderdate, o_custkey FROM l JOIN p ON o_custkey = c_custkey)
  UNION ALL SELECT 'stays', 0, 'read', count(*) FROM orders UNION ALL SELECT 'stays', 1, 'lookups', count(*) FROM orders JOIN customer ON o_custkey = c_custkey UNION ALL SELECT 'stays', 2, 'shaped', count(*) FROM s
  UNION ALL SELECT 'stays', 3, 'known', count(*) FROM s JOIN p ON o_custkey = c_custkey UNION ALL SELECT 'stays', 4, 'complete', count(*) FROM s JOIN p ON o_custkey = c_custkey
  UNION ALL SELECT 'stays', 5, 'distinct', count(*) FROM (SELECT DISTINCT o_custkey, o_orderdate, code FROM s JOIN p ON o_custkey = c_custkey))
SELECT "table", CAST(place AS INTEGER) AS place, stage, rows, lag(rows) OVER (PARTITION BY "table" ORDER BY place) - rows AS lost FROM n"""


@query(LOST)
def pipeline_stage_counts(spark, d):
    """Rows that each stage of each table loses, counted while the tables are written; a fifth of the people is unknown."""
    people = scratch(spark, "people")
    save(table(spark, d, "customer").filter("c_custkey % 5 <> 0"), people)
    spec = replace(clinic(d), patients=FileSpec(people, "parquet"))
    return stage_table(spark, run_pipeline(spark, spec, scratch(spark, "clinic")))


@query(SQL["pipeline_report"])
def pipeline_resumed(spark, d):
    """A second run, of several tables at once, takes over what the first has finished and only tries the broken table again."""
    out = scratch(spark, "clinic")
    run_pipeline(spark, clinic(d), out, at_once=2)
    before = spark.read.parquet(f"{out}/labs").inputFiles()
    reports = run_pipeline(spark, clinic(d), out, at_once=3, resume=True)
    again = before != spark.read.parquet(f"{out}/labs").inputFiles()
    return report_table(spark, [replace(r, status="again") if again else r for r in reports]).drop("message")


CONFIG = {
    "paths": {"raw": "${oc.env:RAW}"},
    "align_timestamps": {"names": ["timestamp"], "format": "%Y-%m-%d %H:%M:%S"},
    "patients_info": {"filename": "${paths.raw}/customer.parquet", "rename_columns": {"c_name": "subject_id"}},
    "tables": {
        "labs": {
            "filename": "${paths.raw}/lineitem.parquet", "rename_columns": {"l_orderkey": "contact_id", "l_partkey": "code", "l_quantity": "numeric_value"}, "code_prefix": "LAB/", "numeric_columns": ["numeric_value"],
            "mappings": [
                {"source_column": "contact_id", "via_file": "${paths.raw}/orders.parquet", "join_on": "o_orderkey", "target_column": "o_custkey", "rename_to": "person"},
                {"source_column": "contact_id", "via_file": "${paths.raw}/orders.parquet", "join_on": "o_orderkey", "target_column": "o_orderdate", "rename_to": "timestamp", "drop_source": True},
                {"source_column": "person", "via_file": "${paths.raw}/customer.parquet", "join_on": "c_custkey", "target_column": "c_name", "rename_to": "subject_id", "drop_source": True},
            ],
        }
    },
}


@query(TABLE_SQL)
def pipeline_configuration(spark, d):
    """A table of a nested configuration, as a YAML file holds it."""
    spec = pipeline_from(CONFIG, env={"RAW": d})
    _, id_map = compile_subjects(spark, spec)
    return compile_table(spark, spec.tables["labs"], id_map).select("subject_id", "code", "timestamp", "numeric_value")


CLINIC_SQL = f"""SELECT id AS subject_id, CAST(NULL AS TIMESTAMP) AS time, 'GENDER//' || c_mktsegment AS code, CAST(NULL AS FLOAT) AS numeric_value FROM {IDS_SQL} JOIN customer USING (c_custkey)
UNION ALL SELECT subject_id, timestamp, code, CAST(numeric_value AS FLOAT) FROM ({TABLE_SQL})
UNION ALL SELECT DISTINCT id, o_orderdate, 'S/' || o_orderstatus, CAST(NULL AS FLOAT) FROM orders JOIN {IDS_SQL} ON o_custkey = c_custkey
UNION ALL SELECT DISTINCT id, o_orderdate, 'P/' || o_orderpriority, CAST(NULL AS FLOAT) FROM orders JOIN {IDS_SQL} ON o_custkey = c_custkey"""


@query(f"SELECT DISTINCT e.subject_id, e.time, e.code, e.numeric_value, x.split FROM ({CLINIC_SQL}) e, LATERAL (SELECT {SPLIT_CASE.format(BUCKET.format('e.subject_id'))}) x")
def dataset_events(spark, d):
    """Every event of the dataset that one call writes, with its split."""
    out = scratch(spark, "dataset")
    build_dataset(spark, clinic(d), out, rows_per_file=5000, at_once=2)
    return cohort.read_cohort(spark, f"{out}/data").select("subject_id", "time", "code", "numeric_value", F.col("split").cast("string").alias("split"))


@query(
    f"""WITH e AS (SELECT DISTINCT e.subject_id, e.time, e.code, e.numeric_value FROM ({CLINIC_SQL}) e), s AS (SELECT x.split FROM {IDS_SQL} i, LATERAL (SELECT {SPLIT_CASE.format(BUCKET.format('i.id'))}) x)
       SELECT code, count(*) AS n_events, count(DISTINCT subject_id) AS n_subjects, (SELECT count(*) FROM e) AS all_events, (SELECT count(DISTINCT subject_id) FROM e) AS all_subjects,
         (SELECT count(*) FROM s WHERE split = 'train') AS train, (SELECT count(*) FROM s WHERE split = 'held_out') AS held_out FROM e GROUP BY code"""
)
def dataset_metadata_files(spark, d):
    """The metadata that one call writes beside the events: of every code, and of the dataset as JSON."""
    out = scratch(spark, "dataset")
    build_dataset(spark, clinic(d), out)
    whole = spark.read.json(f"{out}/metadata/dataset").select(F.col("n_events").alias("all_events"), F.col("n_subjects").alias("all_subjects"), *(F.col("subjects_by_split")[s].alias(s) for s in ("train", "held_out")))
    return spark.read.parquet(f"{out}/metadata/codes").select("code", "n_events", "n_subjects").crossJoin(F.broadcast(whole))


@query(METADATA_SQL.format(CLINIC_SQL))
def pipeline_cohort(spark, d):
    spec = clinic(d)
    people, id_map = compile_subjects(spark, spec)
    # the cohort drops repeats over all tables, so the tables need not
    tables = {"subject": people, **{name: compile_table(spark, replace(spec.tables[name], dedupe=False), id_map) for name in ("labs", "stays")}}
    return cohort.code_metadata(compile_cohort(spec, tables, rows=event_rows(spark, spec))).withColumn("value_sum", F.round("value_sum", 2)).drop("value_sum_sq")


@query(
    """SELECT DISTINCT o_custkey AS subject_id, o_orderkey AS contact, 'A/' || upper(o_orderpriority) AS code, date_trunc('day', o_orderdate) + INTERVAL 9 HOUR AS timestamp FROM orders
       UNION SELECT DISTINCT o_custkey, o_orderkey, 'B/' || upper(o_orderpriority), date_trunc('day', o_orderdate) + INTERVAL 2 DAY FROM orders"""
)
def pipeline_shaping(spark, d):
    raw = table(spark, d, "orders").select(
        "o_custkey", "o_orderkey", F.nullif("o_orderpriority", F.col("o_orderpriority")).alias("priority"), F.upper("o_orderpriority").alias("fill"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.lit("09:00:00").alias("clock"),
        F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 2 DAYS"), "yyyy-MM-dd").alias("end"),
    )
    spec = TableSpec(
        FileSpec("orders"),
        {"o_custkey": "subject_id", "o_orderkey": "contact", "priority": "code", "fill": "fill", "day": "day", "clock": "clock", "end": "out"},
        fill=(FillSpec("code", "fill"),), melt=(MeltSpec({"in": "A/", "out": "B/"}),), pad={"out": {"suffix": " 00:00:00", "unless_contains": ":"}},
    )
    first = compile_table(spark, TableSpec(spec.file, spec.rename, date_times=(DateTimeSpec("in", "day", "clock"),), pad=spec.pad, fill=spec.fill, times=("out",), dedupe=False), raw=raw)
    second = TableSpec(FileSpec("stays"), {c: c for c in first.columns}, melt=spec.melt)
    return compile_table(spark, second, raw=first).select("subject_id", "contact", "code", "timestamp")


# --- audits


@query("SELECT sha256('salt' || c_name) AS c_name, c_mktsegment FROM customer")
def pseudonymise(spark, d):
    return audit.pseudonymise(table(spark, d, "customer").select("c_name", "c_mktsegment"), "c_name", "salt")


@query(
    """WITH c AS (SELECT CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_custkey END AS k FROM orders), p AS (SELECT DISTINCT c_custkey AS p FROM customer WHERE c_custkey % 4 <> 0),
       n AS (SELECT p, count(k) AS n FROM p LEFT JOIN c ON k = p GROUP BY p)
       SELECT CAST((SELECT count(*) FROM c) AS BIGINT) AS child_rows, CAST((SELECT count(*) FROM c WHERE k IS NOT NULL AND k NOT IN (SELECT p FROM p)) AS BIGINT) AS orphan_rows,
         (SELECT count(*) FROM c WHERE k IS NULL) AS null_key_rows, count(*) AS parent_keys, count(*) FILTER (n = 0) AS unused_parent_keys, max(n) AS largest_fan_out FROM n"""
)
def link_coverage(spark, d):
    child = table(spark, d, "orders").select(F.when(F.col("o_orderkey") % 13 != 0, F.col("o_custkey")).alias("k"))
    return audit.link_coverage(child, table(spark, d, "customer").filter("c_custkey % 4 <> 0"), "k", "c_custkey")


@query("SELECT o_custkey AS key, count(*) AS uses FROM orders GROUP BY o_custkey HAVING count(*) > 1")
def link_unique(spark, d):
    return audit.repeated_links(table(spark, d, "orders"), "o_custkey")


@query(
    """WITH t AS (SELECT nullif(event_type, 'click') AS kind, CASE WHEN event_id % 8 = 0 THEN 'INVALID' ELSE CAST(event_id AS VARCHAR) END AS amount,
         CASE WHEN event_id % 20 = 0 THEN 'abcd' ELSE md5(CAST(user_id AS VARCHAR)) END AS person FROM events)
       SELECT 'kind' AS "column", count(*) AS rows, count(*) FILTER (kind IS NULL) AS nulls, CAST(0 AS BIGINT) AS all_null_rows, CAST(NULL AS BIGINT) AS non_numeric, CAST(NULL AS BIGINT) AS truncated FROM t
       UNION ALL SELECT 'amount', count(*), 0, 0, count(*) FILTER (amount = 'INVALID'), NULL FROM t
       UNION ALL SELECT 'person', count(*), 0, 0, NULL, count(*) FILTER (person = 'abcd') FROM t"""
)
def defect_profile(spark, d):
    e = F.col("event_id")
    df = table(spark, d, "events").select(
        F.nullif("event_type", F.lit("click")).alias("kind"), F.when(e % 8 == 0, F.lit("INVALID")).otherwise(e.cast("string")).alias("amount"), F.when(e % 20 == 0, F.lit("abcd")).otherwise(F.md5(F.col("user_id").cast("string"))).alias("person")
    )
    return audit.defect_profile(df, ["kind", "amount", "person"], numeric=["amount"], ids=["person"])


@query("SELECT l_orderkey, l_linenumber, o_orderdate AS ordered, l_shipdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate + INTERVAL 60 DAY")
def time_order(spark, d):
    df = looked_up(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate"), table(spark, d, "orders"), "l_orderkey", "o_orderkey", {"o_orderdate": "ordered"}, drop_source=False)
    late = df.withColumn("limit", F.col("ordered") + F.expr("INTERVAL 60 DAYS"))
    return audit.out_of_order(late, "limit", "l_shipdate").drop("limit")


@query("SELECT o_orderkey, CAST(date_trunc('week', o_orderdate) AS DATE) AS monday FROM orders")
def week_stamp(spark, d):
    day = F.col("o_orderdate").cast("date")
    year = F.year(F.date_add(F.date_sub(day, F.weekday(day)), 3))
    stamp = F.concat(F.lpad((year % 100).cast("string"), 2, "0"), F.lpad(F.weekofyear(day).cast("string"), 2, "0"))
    century = F.floor(year / 100) * 100
    return table(spark, d, "orders").select("o_orderkey", F.when(century == 1900, C.week_start(stamp, 1900)).otherwise(C.week_start(stamp)).alias("monday"))


@query("SELECT p_partkey, CASE WHEN p_size % 9 <> 8 THEN p_size * 7 + p_size % 7 END AS days FROM part")
def gest_age(spark, d):
    size = F.col("p_size")
    text = F.when(size % 9 == 8, F.lit("unknown")).otherwise(F.concat(size.cast("string"), F.lit(" "), (size % 7).cast("string"), F.lit("/7")))
    return table(spark, d, "part").select("p_partkey", C.gestation_days(text).alias("days"))


# --- streaming


@query("SELECT event_id, 'E/' || event_type AS code, value FROM events")
def incremental_ingest(spark, d):
    source, target = scratch(spark, "landing"), scratch(spark, "ingested")
    df = table(spark, d, "events").select("event_id", "event_type", "value")

    def transform(batch: DataFrame) -> DataFrame:
        return batch.select("event_id", C.prefixed(F.col("event_type"), "E/").alias("code"), "value")

    for part in (0, 1):
        save(df.filter(F.col("event_id") % 2 == part), source, mode="append")
        ingest(spark, source, df.schema, transform, target, f"{target}-state").awaitTermination()
    return spark.read.parquet(target).drop("batch")


@query("SELECT DISTINCT user_id AS subject_id, 'E/' || event_type AS code, ts AS timestamp FROM events")
def incremental_ingest_repeats(spark, d):
    """Half of the events lands first, all of them later: through a described table, no written row repeats an earlier one."""
    source, target = scratch(spark, "landing"), scratch(spark, "ingested")
    df = table(spark, d, "events").select("event_id", "user_id", "event_type", "ts")
    spec = TableSpec(FileSpec(source, "parquet"), {"user_id": "subject_id", "event_type": "code", "ts": "timestamp"}, code_prefix="E/")
    for landed in (df.filter("event_id % 2 = 0"), df):
        save(landed, source, mode="append")
        ingest_table(spark, spec, df.schema, target, f"{target}-state", day_of="timestamp").awaitTermination()
    return spark.read.parquet(target).select("subject_id", "code", "timestamp")


def entry(spark: SparkSession, d: str) -> DataFrame:
    """The flagship: lab results through contacts to people, numbered, cleaned, turned into events, counted by code."""
    return pipeline_cohort(spark, d)
