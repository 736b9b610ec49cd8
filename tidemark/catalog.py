"""The registered queries of the synchronisation operators over the driver's tables, each with its DuckDB oracle.

The staged rows are a projection of events: a doi for each user and event type (every third in other case and padded),
the day as indexed time so that ties occur, a content of three values, executions of EXECUTION rows, chunks of CHUNK.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as T
from .operators import canonical, changes, collect, intervals, replay, reports, staging, sync, tree_digest, verify, windows
from .plans.store import Store, settled, shared_dir
from .schema import COUNTERS, PAGE
from .sources.crawl import items as page_items
from .sources.generator import synthetic_rows as generated

EXECUTION, CHUNK = 2500, 250

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None):
    """Registers a query under its function's name; sql is its oracle."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def load(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def day(c) -> object:
    return F.date_format(c, "yyyy-MM-dd")


def stg(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "events")
    key = F.concat(F.lit("10.5555/u"), F.col("user_id").cast("string"), F.lit("/"), "event_type")
    raw = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("  "), F.upper(key), F.lit("\t"))).otherwise(key)
    content = F.get_json_object("props", "$.k").cast("int") % 3
    doi = T.composed_key(raw)
    return e.select(
        (F.col("event_id") + 1).alias("staging_key"), F.concat(F.lit("ex"), F.floor(F.col("event_id") / EXECUTION).cast("string")).alias("execution_id"), (F.col("event_id") % EXECUTION + 1).alias("execution_sequence"),
        doi.alias("doi"), F.date_trunc("DAY", "ts").cast("timestamp_ntz").alias("indexed_at"), content.alias("content"), F.sha2(F.concat_ws("|", doi, content.cast("string")), 256).alias("content_hash"), F.lit(None).cast("bigint").alias("source_error_key"),
    )


STG = f"""
raw AS (SELECT event_id, event_type, value, ts, '10.5555/u' || user_id || '/' || event_type AS k, CAST(json_extract_string(props, '$.k') AS INT) % 3 AS content FROM events),
stg AS (SELECT event_id + 1 AS staging_key, 'ex' || (event_id // {EXECUTION}) AS execution_id, event_id % {EXECUTION} + 1 AS execution_sequence,
  lower(CASE WHEN event_id % 3 = 0 THEN upper(k) ELSE k END) AS doi, date_trunc('day', ts) AS indexed_at, content FROM raw),
st AS (SELECT *, sha256(doi || '|' || content) AS content_hash, ((execution_sequence - 1) // {CHUNK}) + 1 AS chunk FROM stg)"""


def tgt(spark: SparkSession, d: str, staged: DataFrame | None = None) -> DataFrame:
    """Latest row of each doi among every tenth event, ties by the greatest key; staged: the rows of stg(), if they are at hand."""
    rows = (stg(spark, d) if staged is None else staged).where((F.col("staging_key") - 1) % 10 == 0)
    best = rows.groupBy("doi").agg(F.max(F.struct("indexed_at", "staging_key", "content_hash", "content")).alias("b"))
    return best.select(F.col("b.staging_key").cast("string").alias("id"), "doi", F.col("b.content_hash").alias("content_hash"), F.col("b.content").alias("content"), F.col("b.indexed_at").alias("source_indexed_at"), F.lit("old").alias("created_at"), F.lit("old").alias("updated_at"))


TGT = """, tgt AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doi ORDER BY indexed_at DESC, staging_key DESC) AS r FROM st WHERE (staging_key - 1) % 10 = 0) WHERE r = 1)"""

DEC = """, g0 AS (SELECT execution_id, doi, chunk, max(indexed_at) AS mx, count(*) AS n FROM st GROUP BY ALL),
g1 AS (SELECT g0.execution_id, g0.doi, g0.chunk, g0.mx, g0.n, count(*) AS ties, count(DISTINCT content_hash) AS nh, min(content_hash) AS h, min(staging_key) AS winner_key
  FROM g0 JOIN st ON st.execution_id = g0.execution_id AND st.doi = g0.doi AND st.chunk = g0.chunk AND st.indexed_at = g0.mx GROUP BY ALL),
g2 AS (SELECT * FROM g1 UNION ALL SELECT DISTINCT g1.execution_id, g1.doi, 0, tgt.indexed_at, 0, 0, 1, tgt.content_hash, NULL FROM g1 JOIN tgt ON tgt.doi = g1.doi),
g3 AS (SELECT *, max(CASE WHEN nh <= 1 THEN {'a': mx, 'b': -chunk, 'c': h} END) OVER (PARTITION BY execution_id, doi ORDER BY chunk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS was FROM g2),
dec AS (SELECT *, n - ties AS older, CASE WHEN nh > 1 THEN 'GROUP_CONFLICT' WHEN was IS NULL THEN 'INSERTED' WHEN mx < was.a THEN 'SUPERSEDED' WHEN mx = was.a AND h = was.c THEN 'NO_OP' WHEN mx = was.a THEN 'CONFLICT' WHEN h = was.c THEN 'INDEX_ADVANCED' ELSE 'UPDATED' END AS decision FROM g3 WHERE chunk > 0)"""

CHK = """, keys AS (SELECT execution_id, chunk, min(staging_key) AS first_staging_key, max(staging_key) AS last_staging_key FROM st GROUP BY ALL),
chk AS (SELECT k.execution_id, k.chunk AS chunk_sequence, first_staging_key, last_staging_key,
  CAST(sum(CASE WHEN decision = 'INSERTED' THEN 1 ELSE 0 END) AS BIGINT) AS inserted_count,
  CAST(sum(CASE WHEN decision = 'SUPERSEDED' THEN 1 ELSE 0 END + CASE WHEN decision <> 'GROUP_CONFLICT' THEN older ELSE 0 END) AS BIGINT) AS superseded_count,
  CAST(sum(CASE WHEN decision = 'NO_OP' THEN 1 ELSE 0 END + CASE WHEN decision <> 'GROUP_CONFLICT' THEN ties - 1 ELSE 0 END) AS BIGINT) AS no_op_count,
  CAST(sum(CASE WHEN decision = 'CONFLICT' THEN 1 WHEN decision = 'GROUP_CONFLICT' THEN n ELSE 0 END) AS BIGINT) AS conflict_count,
  CAST(sum(CASE WHEN decision = 'INDEX_ADVANCED' THEN 1 ELSE 0 END) AS BIGINT) AS index_advanced_count,
  CAST(sum(CASE WHEN decision = 'UPDATED' THEN 1 ELSE 0 END) AS BIGINT) AS updated_count, CAST(0 AS BIGINT) AS validation_error_count
  FROM keys k JOIN dec ON dec.execution_id = k.execution_id AND dec.chunk = k.chunk GROUP BY ALL)"""

OUT = """, rows_ AS (SELECT st.execution_id, staging_key, st.doi, st.chunk, CASE WHEN decision = 'GROUP_CONFLICT' THEN 'CONFLICT' WHEN staging_key = winner_key THEN decision WHEN indexed_at < mx THEN 'SUPERSEDED' ELSE 'NO_OP' END AS outcome
  FROM st JOIN dec ON dec.execution_id = st.execution_id AND dec.doi = st.doi AND dec.chunk = st.chunk)"""


def decided(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows = stg(spark, d)
    return rows, sync.decisions(rows, tgt(spark, d), CHUNK)


def errs(spark: SparkSession, d: str) -> DataFrame:
    """Errors of all kinds on staged rows of one type or a great value."""
    e, k = load(spark, d, "events").where("event_type = 'error' or value > 80"), F.get_json_object("props", "$.k").cast("int")
    kind = F.when(F.col("event_id") % 3 == 0, "CONFLICT").when(F.col("event_id") % 3 == 1, "VALIDATION").otherwise("PERSISTENCE")
    return e.select(
        F.col("event_id").alias("error_key"), F.concat(F.lit("ex"), F.floor(F.col("event_id") / EXECUTION).cast("string")).alias("execution_id"), (F.col("event_id") + 1).alias("staging_key"), kind.alias("error_type"),
        F.concat(F.lit("C"), (k % 4).cast("string")).alias("error_code"), F.when(F.col("value") > 20, "OPEN").otherwise("RESOLVED").alias("status"), (k % 3).alias("replay_count"), F.lit(None).cast("string").alias("resolved_at"),
    )


ERR = f"""err AS (SELECT event_id AS error_key, 'ex' || (event_id // {EXECUTION}) AS execution_id, event_id + 1 AS staging_key, CASE event_id % 3 WHEN 0 THEN 'CONFLICT' WHEN 1 THEN 'VALIDATION' ELSE 'PERSISTENCE' END AS error_type,
  'C' || (CAST(json_extract_string(props, '$.k') AS INT) % 4) AS error_code, CASE WHEN value > 20 THEN 'OPEN' ELSE 'RESOLVED' END AS status, CAST(json_extract_string(props, '$.k') AS INT) % 3 AS replay_count FROM events WHERE event_type = 'error' OR value > 80)"""


def stg_all(spark: SparkSession, d: str) -> DataFrame:
    """All staged rows as one execution, numbered densely by key over the whole table."""
    rows = stg(spark, d).drop("execution_sequence").withColumn("execution_id", F.lit("all"))
    return staging.dense_sequence(rows, ["staging_key"], settle=settled)


STG_ALL = STG.replace(f"'ex' || (event_id // {EXECUTION}) AS execution_id, event_id % {EXECUTION} + 1 AS", "'all' AS execution_id, row_number() OVER (ORDER BY event_id) AS")


def errs_all(spark: SparkSession, d: str) -> DataFrame:
    """An error on every staged row, its kind and status by the row's values, in the one execution of stg_all()."""
    k = F.get_json_object("props", "$.k").cast("int")
    return load(spark, d, "events").select(
        F.col("event_id").alias("error_key"), F.lit("all").alias("execution_id"), (F.col("event_id") + 1).alias("staging_key"), F.when(k % 3 == 0, "CONFLICT").when(k % 3 == 1, "VALIDATION").otherwise("PERSISTENCE").alias("error_type"),
        F.when(F.col("value") > 20, "OPEN").otherwise("RESOLVED").alias("status"), (k % 3).alias("replay_count"), F.lit(None).cast("string").alias("resolved_at"),
    )


ERR_ALL = "err AS (SELECT event_id AS error_key, 'all' AS execution_id, event_id + 1 AS staging_key, CASE WHEN value > 20 THEN 'OPEN' ELSE 'RESOLVED' END AS status, CAST(json_extract_string(props, '$.k') AS INT) % 3 AS replay_count FROM events)"


# Scans, staging and sequences


@query(f"WITH {STG} SELECT staging_key, doi, content_hash FROM st WHERE execution_id = 'ex1' AND staging_key > {EXECUTION + 100} AND staging_key <= {2 * EXECUTION - 100} ORDER BY staging_key LIMIT 100")
def keyset_page(spark, d):
    return staging.page(stg(spark, d), "ex1", EXECUTION + 100, 2 * EXECUTION - 100, 100).select("staging_key", "doi", "content_hash")


@query(f"WITH {STG} SELECT staging_key, doi FROM st WHERE execution_id = 'ex2' AND content <> 1 AND doi IS NOT NULL")
def partition_scan(spark, d):
    return stg(spark, d).where("execution_id = 'ex2' and content <> 1 and doi is not null").select("staging_key", "doi")


@query(f"WITH {STG} SELECT staging_key, doi FROM st WHERE doi LIKE '%/purchase' AND content <> 1 AND doi IS NOT NULL")
def partition_scan_all(spark, d):
    return stg(spark, d).where("doi like '%/purchase' and content <> 1 and doi is not null").select("staging_key", "doi")


@query("SELECT user_id, event_id, row_number() OVER (ORDER BY user_id, event_id) AS execution_sequence FROM events")
def dense_sequence(spark, d):
    return staging.dense_sequence(load(spark, d, "events").select("user_id", "event_id"), ["user_id", "event_id"], settle=settled)


@query("WITH w AS (SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY ALL) SELECT event_type, day, n, CAST(coalesce(sum(n) OVER (PARTITION BY event_type ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS collected_before FROM w")
def window_prefix_sum(spark, d):
    days = load(spark, d, "events").groupBy("event_type", day("ts").alias("day")).agg(F.count("*").alias("n"))
    return staging.prefix_counts(days, "day", "n", ["event_type"])


@query(f"WITH {STG} SELECT execution_id, execution_sequence, staging_key FROM st WHERE staging_key % 5 <> 0 AND staging_key % 2 = 1")
def idempotent_append(spark, d):
    rows = stg(spark, d).select("execution_id", "execution_sequence", "staging_key")
    old, new = rows.where("staging_key % 2 = 0"), rows.where("staging_key % 5 <> 0")
    return staging.append_missing(new.unionByName(new), old, ["execution_id", "execution_sequence"])


@query(f"WITH {STG} SELECT execution_id, count(*) AS expected_count, max(staging_key) AS upper_bound FROM st GROUP BY ALL")
def freeze_bound(spark, d):
    return staging.frozen(stg(spark, d))


@query(f"WITH {STG} SELECT staging_key, chunk FROM (SELECT staging_key, (row_number() OVER (PARTITION BY execution_id ORDER BY staging_key) - 1) // {CHUNK} + 1 AS chunk FROM st)")
def chunk_assignment(spark, d):
    return stg(spark, d).select("staging_key", sync.chunk_of(F.col("execution_sequence"), CHUNK).alias("chunk"))


# Canonical form


@query("SELECT doc_id, CAST(length(t) AS INT) AS n, sha256(t) AS hash FROM (SELECT doc_id, regexp_replace(regexp_replace('  ' || text || chr(9) || ' ', '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g'), '\\s+', ' ', 'g') AS t FROM documents)")
def canonical_text(spark, d):
    t = T.plain(F.concat(F.lit("  "), "text", F.lit("\t ")))
    return load(spark, d, "documents").select("doc_id", F.length(t).alias("n"), F.sha2(t, 256).alias("hash"))


@query("SELECT doc_id, sha256(to_json({'doi': '10.5555/' || doc_id, 'title': text, 'publisher': NULL::VARCHAR, 'n': n_chars})) AS content_hash FROM documents")
def canonical_json_hash(spark, d):
    s = F.struct(F.concat(F.lit("10.5555/"), F.col("doc_id").cast("string")).alias("doi"), F.col("text").alias("title"), F.lit(None).cast("string").alias("publisher"), F.col("n_chars").alias("n"))
    return load(spark, d, "documents").select("doc_id", F.sha2(F.to_json(s, {"ignoreNullFields": "false"}), 256).alias("content_hash"))


@query("SELECT doc_id, sha256(nfc_normalize(text || 'e' || chr(769) || ' A' || chr(778))) AS hash FROM documents")
def nfc_normalised(spark, d):
    t = F.concat("text", F.lit("é Å"))
    return load(spark, d, "documents").select("doc_id", F.sha2(T.nfc(t), 256).alias("hash"))


@query("SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN strftime(o_orderdate, '%Y') WHEN 2 THEN strftime(o_orderdate, '%Y-%m') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS issued_date, CASE WHEN o_orderkey % 4 > 0 THEN CAST(o_orderkey % 4 AS INT) END AS precision FROM orders")
def partial_date(spark, d):
    o = load(spark, d, "orders")
    every = F.array(F.year("o_orderdate"), F.month("o_orderdate"), F.dayofmonth("o_orderdate"))
    parts = T.date_parts(F.array(F.slice(every, F.lit(1), (F.col("o_orderkey") % 4).cast("int"))))
    return o.select("o_orderkey", T.partial_date(parts).alias("issued_date"), F.when(parts.isNotNull(), F.size(parts)).alias("precision"))


_NORM = "nullif(regexp_replace(regexp_replace({0}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g'), '\\s+', ' ', 'g'), '')"


def records(spark: SparkSession, d: str) -> DataFrame:
    """Source records made of conversations."""
    c = load(spark, d, "conversations")
    person = lambda given, family: F.struct(given.alias("given"), family.alias("family"), F.lit(None).cast("string").alias("ORCID"))
    people = F.array(person(F.col("role"), F.concat(F.lit(" "), F.substring("text", 1, 12))), F.lit(None), person(F.lit("  "), F.col("role")))
    stamp = F.struct(F.lit("2026-08-08T00:00:00Z").alias("date-time"))
    item = F.struct(
        F.concat(F.lit(" 10.5555/C"), F.col("conv_id").cast("string"), F.lit("/"), F.col("turn").cast("string"), F.lit("\n")).alias("DOI"),
        F.array(F.lit(" "), F.when(F.col("turn") % 2 == 1, F.concat(F.lit(" "), "role", F.lit("\t x"))), F.col("text")).alias("title"),
        F.when(F.col("turn") > 0, "  Some   Publisher ").alias("publisher"), F.lit(" Journal-Article").alias("type"),
        F.struct(F.array(F.slice(F.array(F.lit(2026), F.lit(7), F.lit(5)), F.lit(1), (F.col("turn") % 4).cast("int"))).alias("date-parts")).alias("issued"),
        F.lit("https://Example.org/A").alias("URL"), people.alias("author"), stamp.alias("indexed"), stamp.alias("created"),
    )
    return c.select("conv_id", "turn", item.alias("item"))


_RECORD = f"""r AS (SELECT conv_id, turn, lower('10.5555/C' || conv_id || '/' || turn) AS doi, CASE WHEN turn % 2 = 1 THEN role || ' x' ELSE {_NORM.format('text')} END AS title, CASE WHEN turn > 0 THEN 'Some Publisher' END AS publisher,
  CASE turn % 4 WHEN 0 THEN NULL WHEN 1 THEN '2026' WHEN 2 THEN '2026-07' ELSE '2026-07-05' END AS issued_date, CASE WHEN turn % 4 > 0 THEN CAST(turn % 4 AS INT) END AS issued_date_precision,
  [{{'given': role, 'family': {_NORM.format("' ' || substr(text, 1, 12)")}, 'orcid': NULL::VARCHAR}}, {{'given': NULL, 'family': role, 'orcid': NULL}}] AS authors FROM conversations)"""


@query(f"WITH {_RECORD} SELECT conv_id, turn, doi, title, publisher, 'journal-article' AS work_type, issued_date, issued_date_precision, to_json(authors)::VARCHAR AS authors_json, sha256(to_json({{'canonicalVersion': 1, 'doi': doi, 'title': title, 'publisher': publisher, 'type': 'journal-article', 'issuedDate': issued_date, 'issuedDatePrecision': issued_date_precision, 'url': 'https://Example.org/A', 'authors': authors}})) AS content_hash FROM r")
def canonical_records(spark, d):
    return canonical.canonicalize(records(spark, d)).select("conv_id", "turn", "doi", "title", "publisher", "work_type", "issued_date", "issued_date_precision", "authors_json", "content_hash")


@query(f"WITH {_RECORD} SELECT conv_id, turn, title FROM r")
def first_title(spark, d):
    return canonical.canonicalize(records(spark, d)).select("conv_id", "turn", "title")


@query(f"WITH {_RECORD} SELECT conv_id, turn, sha256(to_json(authors)) AS author_hash FROM r")
def author_array(spark, d):
    return canonical.canonicalize(records(spark, d)).select("conv_id", "turn", "author_hash")


@query("SELECT conv_id, page_no, position, '10.1/' || conv_id || '-' || position AS doi FROM (SELECT DISTINCT conv_id FROM conversations) CROSS JOIN (VALUES (1, 0), (1, 1), (2, 0)) AS p(page_no, position)")
def page_explode(spark, d):
    ids = load(spark, d, "conversations").select("conv_id").distinct()
    body = lambda n, dois: F.concat(F.lit('{"status":"ok","extra":[1],"message":{"total-results":3,"items":['), F.concat_ws(",", *[F.concat(F.lit('{"DOI":"10.1/'), F.col("conv_id").cast("string"), F.lit(f'-{k}","more":1}}')) for k in range(dois)]), F.lit("]}}"))
    raw = ids.select("conv_id", F.explode(F.array(F.struct(F.lit(1).alias("page_no"), body(1, 2).alias("page")), F.struct(F.lit(2).alias("page_no"), body(2, 1).alias("page")))).alias("p"))
    paged = raw.select(F.col("conv_id").alias("window_id"), "p.page_no", F.lit(9).alias("accepted"), F.from_json("p.page", PAGE).alias("page"))
    return page_items(paged).select(F.col("window_id").alias("conv_id"), "page_no", "position", F.col("item.DOI").alias("doi"))


# Collection evidence


def page_log(spark: SparkSession, d: str) -> DataFrame:
    """Pages of 50 events in each event type's window; hashes repeat and some bring nothing."""
    e = load(spark, d, "events")
    return e.groupBy(F.col("event_type").alias("window_id"), F.floor(F.col("event_id") / 200).alias("page_no")).agg(F.count("*").alias("items"), F.count_if(F.col("value") > 60).alias("new_rows"), F.floor(F.sum("user_id") / 900).alias("page_hash")).withColumn("total_results", F.col("page_no") + 10)


PAGES = "pages_ AS (SELECT event_type AS window_id, event_id // 200 AS page_no, count(*) AS items, count(*) FILTER (value > 60) AS new_rows, CAST(floor(sum(user_id) / 900) AS BIGINT) AS page_hash, event_id // 200 + 10 AS total_results FROM events GROUP BY ALL)"


@query(f"WITH {PAGES}, s AS (SELECT *, coalesce(items = 50 AND page_hash = lag(page_hash) OVER (PARTITION BY window_id ORDER BY page_no), false) AS repeated FROM pages_), r AS (SELECT *, sum(CASE WHEN repeated THEN 0 ELSE 1 END) OVER (PARTITION BY window_id ORDER BY page_no) AS run FROM s) SELECT window_id, page_no, repeated, CAST(sum(CASE WHEN repeated THEN 1 ELSE 0 END) OVER (PARTITION BY window_id, run ORDER BY page_no) AS BIGINT) AS run_length FROM r")
def page_lag_repeat(spark, d):
    return collect.repeated_pages(page_log(spark, d), 50).select("window_id", "page_no", "repeated", "run_length")


@query(f"WITH {PAGES}, r AS (SELECT *, sum(CASE WHEN new_rows > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY window_id ORDER BY page_no) AS run FROM pages_), i AS (SELECT window_id, page_no, CAST(sum(CASE WHEN new_rows = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY window_id, run ORDER BY page_no) AS BIGINT) AS idle_pages FROM r) SELECT *, idle_pages >= 2 AS failed FROM i")
def zero_new_run(spark, d):
    return collect.idle_runs(page_log(spark, d), 2).select("window_id", "page_no", "idle_pages", "failed")


@query(f"WITH {PAGES} SELECT window_id, min_by(total_results, page_no) AS reported_total, count(*) AS pages, CAST(sum(items) AS BIGINT) AS rows, CAST(sum(new_rows) AS BIGINT) AS new_rows FROM pages_ GROUP BY ALL")
def window_evidence(spark, d):
    return collect.window_evidence(page_log(spark, d))


@query("SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 7000 <= o_custkey * 10 THEN ceil((o_orderkey % 7000) / 1000.0) ELSE (o_custkey * 10) // 1000 + 1 END AS BIGINT) AS bound FROM orders")
def page_bound(spark, d):
    return load(spark, d, "orders").select("o_orderkey", collect.page_bound(F.col("o_orderkey") % 7000, F.col("o_custkey") * 10).alias("bound"))


# Windows and marks


@query("WITH r AS (SELECT o_orderstatus, min(o_orderdate) + INTERVAL 5 HOUR AS a, max(o_orderdate) + INTERVAL 7 HOUR AS b FROM orders GROUP BY ALL), w AS (SELECT o_orderstatus, a, b, unnest(generate_series(date_trunc('day', a), b - INTERVAL 1 MICROSECOND, INTERVAL 1 DAY)) AS dd FROM r) SELECT o_orderstatus, CAST(row_number() OVER (PARTITION BY o_orderstatus ORDER BY dd) - 1 AS INT) AS window_sequence, strftime(greatest(dd, a), '%Y-%m-%d %H:%M') AS window_from, strftime(least(dd + INTERVAL 1 DAY, b), '%Y-%m-%d %H:%M') AS window_until FROM w")
def utc_day_plan(spark, d):
    o = load(spark, d, "orders").withColumn("t", F.col("o_orderdate").cast("timestamp_ntz"))
    r = o.groupBy("o_orderstatus").agg((F.min("t") + F.expr("interval 5 hour")).alias("range_from"), (F.max("t") + F.expr("interval 7 hour")).alias("range_until"))
    at = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm").alias(c)
    return windows.day_plan(r).select("o_orderstatus", "window_sequence", at("window_from"), at("window_until"))


@query("SELECT DISTINCT strftime(ts, '%Y-%m-%d %H') AS day FROM events WHERE strftime(ts, '%Y-%m-%d %H') NOT IN (SELECT strftime(ts, '%Y-%m-%d %H') FROM events WHERE event_type = 'error' AND value > 40)")
def pending_windows(spark, d):
    e = load(spark, d, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd HH"))
    return windows.pending(e.select("day").distinct(), e.where("event_type = 'error' and value > 40"), ["day"])


@query("WITH r AS (SELECT o_orderstatus AS source_name, CASE WHEN o_orderkey % 3 = 0 THEN 'BACKFILL' ELSE 'INCREMENTAL' END AS mode, o_orderkey % 5 > 0 AS reconciled, o_orderkey % 4 AS conflicts, o_orderkey AS until FROM orders), m AS (SELECT o_orderstatus AS source_name, CAST(avg(o_orderkey) AS BIGINT) AS mark FROM orders WHERE o_orderstatus <> 'F' GROUP BY ALL) SELECT source_name, coalesce(max(until), any_value(mark)) AS mark FROM (SELECT coalesce(r.source_name, m.source_name) AS source_name, mark, CASE WHEN mode = 'INCREMENTAL' AND reconciled AND conflicts = 0 AND (mark IS NULL OR until >= mark) THEN until END AS until FROM r FULL JOIN m ON m.source_name = r.source_name) GROUP BY source_name")
def watermark_policy(spark, d):
    o = load(spark, d, "orders")
    results = o.select(F.col("o_orderstatus").alias("source_name"), F.when(F.col("o_orderkey") % 3 == 0, "BACKFILL").otherwise("INCREMENTAL").alias("mode"), (F.col("o_orderkey") % 5 > 0).alias("reconciled"), (F.col("o_orderkey") % 4).alias("conflicts"), F.col("o_orderkey").alias("until"))
    marks = o.where("o_orderstatus <> 'F'").groupBy(F.col("o_orderstatus").alias("source_name")).agg(F.round(F.avg("o_orderkey")).cast("bigint").alias("mark"))
    return windows.advanced(marks, results)


# Synchronisation


@query(f"WITH {STG} SELECT staging_key, doi, strftime(indexed_at, '%Y-%m-%d') AS day, content_hash FROM (SELECT *, row_number() OVER (PARTITION BY execution_id, doi, chunk ORDER BY indexed_at DESC, staging_key) AS r FROM st) WHERE r = 1")
def group_winner(spark, d):
    rows = stg(spark, d)
    won = sync.groups(rows, CHUNK).select(F.col("winner_key").alias("staging_key"))
    return rows.join(won, "staging_key").select("staging_key", "doi", day("indexed_at").alias("day"), "content_hash")


@query(f"WITH {STG}{TGT}{DEC} SELECT execution_id, doi, chunk, ties, n FROM dec WHERE nh > 1")
def group_conflict(spark, d):
    return sync.groups(stg(spark, d), CHUNK).where("split").select("execution_id", "doi", "chunk", "ties", "n")


@query(f"WITH {STG}{TGT}{DEC} SELECT execution_id, doi, chunk, strftime(mx, '%Y-%m-%d') AS day, older, ties, winner_key, decision FROM dec")
def sync_decisions(spark, d):
    return decided(spark, d)[1].select("execution_id", "doi", "chunk", day("latest_at").alias("day"), "older", "ties", "winner_key", "decision")


@query(f"WITH {STG}{TGT}{DEC}{CHK} SELECT * FROM chk")
def sync_chunk_counts(spark, d):
    rows, decisions = decided(spark, d)
    return sync.chunk_results(decisions, rows, CHUNK)


@query(f"WITH {STG}{TGT}{DEC}{OUT} SELECT execution_id, staging_key, outcome FROM rows_")
def row_outcomes(spark, d):
    rows, decisions = decided(spark, d)
    return sync.row_outcomes(decisions, rows, CHUNK).select("execution_id", "staging_key", "outcome")


@query(f"WITH {STG}{TGT}{DEC}{OUT} SELECT execution_id, staging_key, 'CONFLICT' AS error_type, 'SAME_TIMESTAMP_DIFFERENT_CONTENT' AS error_code, 'OPEN' AS status, 0 AS replay_count FROM rows_ WHERE outcome = 'CONFLICT'")
def conflict_errors(spark, d):
    rows, decisions = decided(spark, d)
    return sync.conflict_errors(sync.row_outcomes(decisions, rows, CHUNK))


@query(f"WITH {STG}{TGT}{DEC}{OUT} SELECT staging_key, doi FROM rows_ WHERE outcome = 'SUPERSEDED'")
def late_rows(spark, d):
    rows, decisions = decided(spark, d)
    return sync.row_outcomes(decisions, rows, CHUNK).where("outcome = 'SUPERSEDED'").select("staging_key", "doi")


_FINAL = ", mv AS (SELECT doi, max(mx) AS at, max(CASE WHEN decision <> 'INDEX_ADVANCED' THEN {'a': chunk, 'b': winner_key, 'c': h} END) AS w FROM dec WHERE execution_id = 'ex1' AND decision IN ('INSERTED', 'UPDATED', 'INDEX_ADVANCED') GROUP BY doi)"


@query(f"WITH {STG}{TGT}{DEC}{_FINAL} SELECT coalesce(tgt.doi, mv.doi) AS doi, coalesce(w.c, tgt.content_hash) AS content_hash, CAST(CASE WHEN w IS NOT NULL THEN (SELECT content FROM st WHERE staging_key = w.b) ELSE tgt.content END AS INT) AS content, strftime(coalesce(mv.at, tgt.indexed_at), '%Y-%m-%d') AS day, CASE WHEN tgt.doi IS NULL THEN 'new' ELSE 'old' END AS created_at, CASE WHEN w IS NOT NULL THEN 'new' ELSE 'old' END AS updated_at FROM tgt FULL JOIN mv ON mv.doi = tgt.doi")
def sync_upsert_target(spark, d):
    rows, target = stg(spark, d).where("execution_id = 'ex1'"), tgt(spark, d)
    new = sync.upserted(target, rows, sync.decisions(rows, target, CHUNK), ["content_hash", "content"], F.lit("new"))
    return new.select("doi", "content_hash", "content", day("source_indexed_at").alias("day"), "created_at", "updated_at")


_FINAL_ALL = _FINAL.replace("'ex1'", "'all'")


@query(f"WITH {STG_ALL}{TGT}{DEC}{_FINAL_ALL} SELECT coalesce(tgt.doi, mv.doi) AS doi, coalesce(w.c, tgt.content_hash) AS content_hash, CAST(CASE WHEN w IS NOT NULL THEN (SELECT content FROM st WHERE staging_key = w.b) ELSE tgt.content END AS INT) AS content, strftime(coalesce(mv.at, tgt.indexed_at), '%Y-%m-%d') AS day, CASE WHEN tgt.doi IS NULL THEN 'new' ELSE 'old' END AS created_at, CASE WHEN w IS NOT NULL THEN 'new' ELSE 'old' END AS updated_at FROM tgt FULL JOIN mv ON mv.doi = tgt.doi")
def sync_upsert_all(spark, d):
    """The synchronisation of every staged row as one execution."""
    rows, target = stg_all(spark, d), tgt(spark, d)
    new = sync.upserted(target, rows, sync.decisions(rows, target, CHUNK), ["content_hash", "content"], F.lit("new"))
    return new.select("doi", "content_hash", "content", day("source_indexed_at").alias("day"), "created_at", "updated_at")


# Verification


def broken(spark: SparkSession, d: str) -> DataFrame:
    """Chunk results with a chunk left out, a range too long and a counter too high, each in an execution of its own."""
    c = sync_chunk_counts(spark, d).where("not (execution_id = 'ex1' and chunk_sequence = 3)")
    hit = lambda ex, n: (F.col("execution_id") == ex) & (F.col("chunk_sequence") == n)
    return c.withColumn("last_staging_key", F.col("last_staging_key") + F.when(hit("ex2", 2), 5).otherwise(0)).withColumn("inserted_count", F.col("inserted_count") + F.when(hit("ex3", 4), 1).otherwise(0))


BROKEN = """, br AS (SELECT * REPLACE (last_staging_key + CASE WHEN execution_id = 'ex2' AND chunk_sequence = 2 THEN 5 ELSE 0 END AS last_staging_key, inserted_count + CASE WHEN execution_id = 'ex3' AND chunk_sequence = 4 THEN 1 ELSE 0 END AS inserted_count) FROM chk WHERE NOT (execution_id = 'ex1' AND chunk_sequence = 3)),
cv AS (SELECT *, inserted_count + superseded_count + no_op_count + conflict_count + index_advanced_count + updated_count + validation_error_count AS accounted, lag(last_staging_key, 1, 0) OVER w AS pl, lag(chunk_sequence, 1, 0) OVER w AS ps FROM br WINDOW w AS (PARTITION BY execution_id ORDER BY chunk_sequence)),
ct AS (SELECT cv.execution_id, cv.chunk_sequence, count(st.staging_key) AS c, min(st.staging_key) AS a, max(st.staging_key) AS b FROM cv LEFT JOIN st ON st.execution_id = cv.execution_id AND st.staging_key BETWEEN cv.first_staging_key AND cv.last_staging_key GROUP BY ALL),
bd AS (SELECT execution_id, max(staging_key) AS bound FROM st GROUP BY ALL),
vl AS (SELECT cv.execution_id, cv.chunk_sequence, cv.accounted, CASE WHEN cv.chunk_sequence <> ps + 1 THEN 'gap' WHEN first_staging_key > last_staging_key OR last_staging_key > bound OR first_staging_key <= pl THEN 'order' WHEN c <> accounted OR a IS DISTINCT FROM first_staging_key OR b IS DISTINCT FROM last_staging_key THEN 'content' END AS violation
  FROM cv JOIN ct ON ct.execution_id = cv.execution_id AND ct.chunk_sequence = cv.chunk_sequence JOIN bd ON bd.execution_id = cv.execution_id)"""


@query(f"WITH {STG}{TGT}{DEC}{CHK}{BROKEN} SELECT * FROM vl")
def coverage_check(spark, d):
    return verify.coverage(settled(broken(spark, d)), stg(spark, d), settled).select("execution_id", "chunk_sequence", "accounted", "violation")


@query(f"WITH {STG}{TGT}{DEC}{CHK}{BROKEN}, ff AS (SELECT execution_id, min(chunk_sequence) AS failed_chunk FROM vl WHERE violation IS NOT NULL GROUP BY ALL) SELECT vl.execution_id, failed_chunk, max(CASE WHEN chunk_sequence = failed_chunk THEN violation END) AS violation, CAST(coalesce(sum(CASE WHEN chunk_sequence < failed_chunk THEN accounted END), 0) AS BIGINT) AS accounted_before FROM vl JOIN ff ON ff.execution_id = vl.execution_id GROUP BY ALL")
def coverage_first_failure(spark, d):
    return verify.first_failure(verify.coverage(settled(broken(spark, d)), stg(spark, d), settled))


@query(f"WITH {STG}{TGT}{DEC}{CHK} SELECT {', '.join(f'CAST(coalesce(sum({c}), 0) AS BIGINT) AS {c}' for c in COUNTERS)}, CAST(coalesce(sum({' + '.join(COUNTERS)}), 0) AS BIGINT) AS accounted FROM chk")
def outcome_totals(spark, d):
    return verify.outcome_totals(sync_chunk_counts(spark, d))


@query(f"WITH {STG}{TGT}{DEC}{CHK}, a AS (SELECT execution_id, CAST(sum({' + '.join(COUNTERS)}) AS BIGINT) AS accounted FROM chk GROUP BY ALL) SELECT st.execution_id, count(*) AS eligible, count(DISTINCT doi) AS distinct_dois, count(*) - count(DISTINCT doi) AS duplicates, any_value(accounted) AS accounted FROM st JOIN a ON a.execution_id = st.execution_id GROUP BY ALL")
def accounted_vs_eligible(spark, d):
    done = sync_chunk_counts(spark, d).groupBy("execution_id").agg(F.sum(verify.accounted()).alias("accounted"))
    return verify.eligible(stg(spark, d)).join(done, "execution_id")


@query(f"WITH {ERR} SELECT execution_id, error_type, count(*) AS n FROM err WHERE status = 'OPEN' GROUP BY ALL")
def open_errors_by_type(spark, d):
    return verify.open_errors_by_type(errs(spark, d))


_MISSING = ", ms AS (SELECT execution_id, count(DISTINCT doi) AS missing FROM st WHERE NOT EXISTS (SELECT 1 FROM err WHERE err.execution_id = st.execution_id AND err.staging_key = st.staging_key AND status = 'OPEN') AND NOT EXISTS (SELECT 1 FROM tgt WHERE tgt.doi = st.doi) GROUP BY ALL)"
_WRONG = ", wr AS (SELECT w.execution_id, w.doi, w.staging_key FROM (SELECT *, row_number() OVER (PARTITION BY execution_id, doi ORDER BY indexed_at DESC, staging_key) AS r FROM st WHERE NOT EXISTS (SELECT 1 FROM err WHERE err.execution_id = st.execution_id AND err.staging_key = st.staging_key AND status = 'OPEN')) w JOIN tgt ON tgt.doi = w.doi WHERE w.r = 1 AND (tgt.indexed_at < w.indexed_at OR (tgt.indexed_at = w.indexed_at AND tgt.content_hash <> w.content_hash)))"


@query(f"WITH {STG}{TGT}, {ERR}{_MISSING} SELECT * FROM ms")
def missing_target(spark, d):
    return verify.missing_targets(stg(spark, d), errs(spark, d), tgt(spark, d))


@query(f"WITH {STG}{TGT}, {ERR}{_WRONG} SELECT * FROM wr")
def winner_checksum_mismatch(spark, d):
    return verify.winner_mismatches(stg(spark, d), errs(spark, d), tgt(spark, d))


@query(
    f"WITH {STG}{TGT}{DEC}{CHK}{OUT}, err AS (SELECT execution_id, staging_key, 'OPEN' AS status FROM rows_ WHERE outcome = 'CONFLICT'){_MISSING}{_WRONG}, "
    f"a AS (SELECT execution_id, CAST(sum({' + '.join(COUNTERS)}) AS BIGINT) AS accounted, CAST(sum(conflict_count) AS BIGINT) AS conflicts FROM chk GROUP BY ALL), e AS (SELECT execution_id, count(*) AS eligible, count(DISTINCT doi) AS distinct_dois FROM st GROUP BY ALL), "
    "o AS (SELECT execution_id, count(*) AS open_conflicts FROM err GROUP BY ALL), w AS (SELECT execution_id, count(*) AS mismatches FROM wr GROUP BY ALL), "
    "f AS (SELECT e.execution_id, eligible, distinct_dois, eligible - distinct_dois AS duplicates, accounted, conflicts, CAST(0 AS BIGINT) AS validations, coalesce(open_conflicts, 0) AS open_conflicts, CAST(0 AS BIGINT) AS open_validations, CAST(0 AS BIGINT) AS open_others, coalesce(missing, 0) AS missing, coalesce(mismatches, 0) AS mismatches, eligible + CASE WHEN e.execution_id = 'ex0' THEN 1 ELSE 0 END AS expected FROM e LEFT JOIN a USING (execution_id) LEFT JOIN o USING (execution_id) LEFT JOIN ms USING (execution_id) LEFT JOIN w USING (execution_id)) "
    "SELECT * EXCLUDE (expected), CASE WHEN expected <> eligible OR eligible <> accounted THEN 'counts' WHEN conflicts <> open_conflicts THEN 'error counts' WHEN missing > 0 THEN 'missing targets' WHEN mismatches > 0 THEN 'winner checksum' WHEN conflicts > 0 THEN 'conflicts' END AS reason, CASE WHEN expected <> eligible OR eligible <> accounted OR conflicts <> open_conflicts OR missing > 0 OR mismatches > 0 OR conflicts > 0 THEN 'FAILED' ELSE 'COMPLETED' END AS status FROM f"
)
def verify_verdict(spark, d):
    rows = settled(stg(spark, d))
    target = tgt(spark, d, rows)
    expected = staging.frozen(rows).select("execution_id", (F.col("expected_count") + F.when(F.col("execution_id") == "ex0", 1).otherwise(0)).alias("expected_count"))
    return verdict_of(rows, target, expected)


def verdict_of(rows: DataFrame, target: DataFrame, expected: DataFrame) -> DataFrame:
    """Settled rows synchronised with a target and verified; what more than one step reads is settled."""
    target = settled(target.select("doi", "source_indexed_at", "content_hash"))
    decisions = settled(sync.decisions(rows, target, CHUNK).drop("content_hash", "split"))
    errors = settled(sync.conflict_errors(sync.row_outcomes(sync.in_conflict(decisions), rows, CHUNK)))
    chunks = settled(sync.chunk_results(decisions, rows, CHUNK))
    return verify.verdicts(rows, chunks, errors, target, expected, settle=settled)


@query("SELECT o_orderstatus, strftime(max(o_orderdate), '%Y-%m-%d') AS latest, count(*) AS n FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R') GROUP BY ALL")
def target_semi_max(spark, d):
    o, li = load(spark, d, "orders"), load(spark, d, "lineitem").where("l_returnflag = 'R'")
    return o.join(li, o.o_orderkey == li.l_orderkey, "left_semi").groupBy("o_orderstatus").agg(day(F.max("o_orderdate")).alias("latest"), F.count("*").alias("n"))


@query("SELECT user_id, sha256(string_agg(event_type || ':' || event_id, '|' ORDER BY event_id)) AS digest FROM events GROUP BY ALL")
def ordered_digest(spark, d):
    return reports.ordered_digest(load(spark, d, "events"), ["user_id"], "event_id", F.concat("event_type", F.lit(":"), F.col("event_id").cast("string")))


def digest_sql(columns: list[str]) -> str:
    parts = " || ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in columns)
    return f"CAST('0x' || substr(md5({parts}), 1, 15) AS BIGINT)"


def digested(columns: list[str], rows: str) -> str:
    return f"SELECT count(*) AS n, coalesce(bit_xor(h), 0) AS xor_hash, CAST(coalesce(sum(CAST(h AS HUGEINT)), 0) AS VARCHAR) AS sum_hash FROM (SELECT {digest_sql(columns)} AS h FROM {rows})"


@query(f"WITH {STG} {digested(['staging_key', 'doi', 'content_hash'], 'st')}")
def table_digest(spark, d):
    return reports.table_digest(stg(spark, d), ["staging_key", "doi", "content_hash"])


_SWAPPED = "(SELECT conv_id, CASE WHEN turn % 2 = 0 THEN role END AS a, CASE WHEN turn % 2 = 1 THEN role END AS b FROM conversations)"


@query(f"SELECT 'ab' AS columns, * FROM ({digested(['conv_id', 'a', 'b'], _SWAPPED)}) UNION ALL SELECT 'ba' AS columns, * FROM ({digested(['conv_id', 'b', 'a'], _SWAPPED)})")
def null_safe_digest(spark, d):
    """Nulls in one column or in the other give different digests."""
    c = load(spark, d, "conversations").select("conv_id", F.when(F.col("turn") % 2 == 0, F.col("role")).alias("a"), F.when(F.col("turn") % 2 == 1, F.col("role")).alias("b"))
    of = lambda name, columns: reports.table_digest(c, columns).select(F.lit(name).alias("columns"), "*")
    return of("ab", ["conv_id", "a", "b"]).unionByName(of("ba", ["conv_id", "b", "a"]))


_PAIRED = ["staging_key", "doi", "content_hash", "target_hash", "target_day"]
_PAIRS = "(SELECT st.staging_key, st.doi, st.content_hash, tgt.content_hash AS target_hash, strftime(tgt.indexed_at, '%Y-%m-%d') AS target_day FROM st LEFT JOIN tgt ON tgt.doi = st.doi)"


@query(f"WITH {STG}{TGT} {digested(_PAIRED, _PAIRS)}")
def staging_target_digest(spark, d):
    return reports.paired_digest(stg(spark, d), tgt(spark, d).withColumn("source_indexed_at", day("source_indexed_at")))


@query("SELECT * FROM (VALUES ('again', true), ('changed', false)) AS t(run, unchanged)")
def no_change_proof(spark, d):
    """The target's digest is the same read again, and another after some rows' hashes were changed."""
    target, columns = tgt(spark, d), ["doi", "content_hash", "content"]
    other = changes.updated(target, F.col("doi").endswith("/click"), {"content_hash": F.lit("x")})
    before = reports.table_digest(target, columns)
    one = lambda name, after: reports.unchanged(before, reports.table_digest(after, columns)).select(F.lit(name).alias("run"), "unchanged")
    return one("again", tgt(spark, d)).unionByName(one("changed", other))


# Replay


@query(f"WITH {STG}, {ERR} SELECT row_number() OVER (ORDER BY error_key) AS execution_sequence, error_key AS source_error_key, doi, content_hash, 'rp' AS execution_id FROM err JOIN st ON st.staging_key = err.staging_key AND st.execution_id = err.execution_id WHERE status = 'OPEN' AND err.execution_id = 'ex1'")
def replay_snapshot(spark, d):
    return replay.snapshot(errs(spark, d), stg(spark, d), "ex1", "rp", settled).select("execution_sequence", "source_error_key", "doi", "content_hash", "execution_id")


@query(f"WITH {ERR} SELECT error_key, CASE WHEN status = 'OPEN' AND execution_id = 'ex1' THEN 'RESOLVED' ELSE status END AS status, CASE WHEN status = 'OPEN' AND execution_id = 'ex1' THEN 'now' END AS resolved_at FROM err")
def replay_resolve(spark, d):
    return replay.resolved(errs(spark, d), replay_snapshot(spark, d), True, F.lit("now")).select("error_key", "status", "resolved_at")


@query(f"WITH {ERR} SELECT error_key, CAST(replay_count + CASE WHEN status = 'OPEN' AND execution_id = 'ex1' THEN 1 ELSE 0 END AS INT) AS replay_count FROM err")
def replay_counter(spark, d):
    return replay.counted(errs(spark, d), replay_snapshot(spark, d)).select("error_key", "replay_count")


@query(f"WITH {STG_ALL}, {ERR_ALL} SELECT row_number() OVER (ORDER BY error_key) AS execution_sequence, error_key AS source_error_key, doi, content_hash, 'rp' AS execution_id FROM err JOIN st ON st.staging_key = err.staging_key WHERE status = 'OPEN'")
def replay_snapshot_all(spark, d):
    return replay.snapshot(errs_all(spark, d), stg_all(spark, d), "all", "rp", settled).select("execution_sequence", "source_error_key", "doi", "content_hash", "execution_id")


@query(f"WITH {ERR_ALL} SELECT error_key, 'RESOLVED' AS status, CASE WHEN status = 'OPEN' THEN 'now' END AS resolved_at FROM err")
def replay_resolve_all(spark, d):
    return replay.resolved(errs_all(spark, d), replay_snapshot_all(spark, d), True, F.lit("now")).select("error_key", "status", "resolved_at")


@query(f"WITH {ERR_ALL} SELECT error_key, CAST(replay_count + CASE WHEN status = 'OPEN' THEN 1 ELSE 0 END AS INT) AS replay_count FROM err")
def replay_counter_all(spark, d):
    return replay.counted(errs_all(spark, d), replay_snapshot_all(spark, d)).select("error_key", "replay_count")


# Reports


_EXECUTIONS = ", ec AS (SELECT execution_id, CASE WHEN min(staging_key) % 2 = 1 THEN 'BACKFILL' ELSE 'INCREMENTAL' END AS mode, 'COMPLETED_WITH_ERRORS' AS status, max(indexed_at) AS finished_at FROM st GROUP BY ALL)"


@query(f"WITH {STG}, {ERR}{_EXECUTIONS} SELECT ec.execution_id, count(*) AS open_errors FROM ec JOIN err ON err.execution_id = ec.execution_id AND err.status = 'OPEN' WHERE mode = 'BACKFILL' GROUP BY ec.execution_id, finished_at ORDER BY finished_at DESC, ec.execution_id DESC LIMIT 1")
def replay_target_select(spark, d):
    runs = stg(spark, d).groupBy("execution_id").agg(F.when(F.min("staging_key") % 2 == 1, "BACKFILL").otherwise("INCREMENTAL").alias("mode"), F.lit("COMPLETED_WITH_ERRORS").alias("status"), F.max("indexed_at").alias("finished_at"))
    return reports.latest_replayable(errs(spark, d), runs).select("execution_id", "open_errors")


@query(f"WITH {ERR}, o AS (SELECT execution_id, count(*) FILTER (status = 'OPEN' AND error_type = 'PERSISTENCE') AS n FROM err GROUP BY ALL) SELECT execution_id, CASE WHEN n > 0 AND execution_id <> 'ex1' THEN 'OPEN_ERRORS_REQUIRE_REPLAY' WHEN n > 0 THEN 'OPERATOR_REVIEW' ELSE 'RUN' END AS decision FROM o")
def preflight_decision(spark, d):
    n = errs(spark, d).groupBy("execution_id").agg(F.count_if((F.col("status") == "OPEN") & (F.col("error_type") == "PERSISTENCE")).alias("n"))
    return n.select("execution_id", reports.preflight(F.col("n"), F.col("execution_id") != "ex1").alias("decision"))


@query(f"WITH {ERR}, g AS (SELECT execution_id, CASE WHEN error_type IN ('CONFLICT', 'VALIDATION') THEN error_type ELSE 'OTHER' END AS t, CASE WHEN error_code IN ('C0', 'C1') THEN error_code ELSE 'OTHER' END AS c, count(*) AS n FROM err GROUP BY ALL) SELECT execution_id, '[' || string_agg(to_json({{'type': t, 'code': c, 'count': n}})::VARCHAR, ',' ORDER BY t, c) || ']' AS groups_json, string_agg(t || ':' || c || ':' || n, ',' ORDER BY t, c) AS groups_text FROM g GROUP BY ALL")
def error_groups_json(spark, d):
    return reports.error_groups(errs(spark, d), ["CONFLICT", "VALIDATION"], ["C0", "C1"])


@query("WITH s AS (SELECT user_id, event_type, date_diff('microsecond', min(ts), max(ts)) // 1000 AS ms FROM events GROUP BY ALL) SELECT user_id, max(CASE WHEN event_type = 'click' THEN ms END) AS click_ms, max(CASE WHEN event_type = 'error' THEN ms END) AS error_ms FROM s GROUP BY ALL")
def step_duration_pivot(spark, d):
    steps = load(spark, d, "events").groupBy("user_id", F.col("event_type").alias("step")).agg(F.min("ts").cast("timestamp").alias("started_at"), F.max("ts").cast("timestamp").alias("ended_at"))
    return reports.step_durations(steps, ["click", "error"], "user_id")


@query(f"WITH {ERR} SELECT execution_id, CAST(sum(CASE WHEN status = 'OPEN' THEN 1 ELSE 0 END) AS BIGINT) AS open_count, CAST(sum(CASE WHEN status = 'RESOLVED' THEN 1 ELSE 0 END) AS BIGINT) AS resolved_count FROM err WHERE error_key <= 6000 GROUP BY ALL")
def source_remaining(spark, d):
    return reports.remaining(errs(spark, d), 6000)


@query("SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_end, CAST(300 - 120 AS BIGINT) AS wait_seconds FROM events")
def cooldown_latest(spark, d):
    runs = load(spark, d, "events").select(F.col("ts").cast("timestamp").alias("ended_at"))
    now = F.col("last_end") + F.expr("interval 120 seconds")
    return reports.cooldown(runs, now).select(F.date_format("last_end", "yyyy-MM-dd HH:mm:ss").alias("last_end"), "wait_seconds")


@query("WITH t AS (SELECT user_id, value * 1048576 AS v, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events), f AS (SELECT user_id, count(*) AS samples, min(CASE WHEN r > 4 THEN v END) AS a, min(CASE WHEN r <= 4 THEN v END) AS b FROM t WHERE r <= 8 GROUP BY ALL) SELECT user_id, samples, samples = 8 AND b - a <= greatest(8 * 1024 * 1024, a / 10) AS plateau FROM f WHERE samples = 8")
def heap_trend(spark, d):
    samples = load(spark, d, "events").select("user_id", "event_id", (F.col("value") * 1048576).alias("v"))
    return reports.sample_trend(samples, ["user_id"], "event_id", "v", 8, 4).where("samples = 8").select("user_id", "samples", "plateau")


_GEN = "g AS (SELECT i, '10.5555/benchmark-v1-42-' || i AS doi, 'Synthetic work ' || i AS title, to_timestamp(1600000000 + 42 + i) AT TIME ZONE 'UTC' AS made FROM range(1, 1001) t(i))"


@query(f"""WITH {_GEN} SELECT i AS execution_sequence, doi, title, strftime(made, '%Y-%m-%d') AS issued_date, strftime(made, '%Y-%m-%d %H:%M:%S') AS indexed_at, sha256(doi || '|' || title || '|Open Metadata Benchmark|' || strftime(made, '%Y-%m-%d') || '|[{{"given":"Ada","family":"Benchmark"}}]') AS content_hash FROM g""")
def synthetic_rows(spark, d):
    return generated(spark, 1000, 42).select("execution_sequence", "doi", "title", "issued_date", F.date_format("indexed_at", "yyyy-MM-dd HH:mm:ss").alias("indexed_at"), "content_hash")


@query(f"WITH {STG}{TGT}{DEC}{CHK} SELECT execution_id, CAST(sum(inserted_count) AS BIGINT) = CAST(sum({' + '.join(COUNTERS)}) AS BIGINT) AS initial, CAST(sum(no_op_count) AS BIGINT) = CAST(sum({' + '.join(COUNTERS)}) AS BIGINT) AS no_op FROM chk GROUP BY ALL")
def scenario_semantics(spark, d):
    return sync_chunk_counts(spark, d).groupBy("execution_id").agg((F.sum("inserted_count") == F.sum(verify.accounted())).alias("initial"), (F.sum("no_op_count") == F.sum(verify.accounted())).alias("no_op"))


@query("SELECT count(*) AS owners, CAST(sum(user_id) AS BIGINT) AS total FROM (SELECT DISTINCT user_id FROM events)")
def metrics_owner_sum(spark, d):
    e = load(spark, d, "events").withColumn("owners", F.lit(1).cast("bigint")).withColumn("total", F.col("user_id"))
    return reports.owner_sums(e, "user_id", ["owners", "total"])


@query("SELECT event_type, count(*) AS steps, CAST(sum(user_id) AS BIGINT) AS read_count, bool_or(value > 90) AS any_high FROM events GROUP BY ALL")
def counter_rollup(spark, d):
    e = load(spark, d, "events").withColumn("read_count", F.col("user_id"))
    return reports.rolled_up(e, ["event_type"], ["read_count"], {"any_high": F.col("value") > 90})


@query("SELECT page_id, regexp_replace(url, '[\\s=]', '_', 'g') AS safe FROM pages")
def log_safe(spark, d):
    return load(spark, d, "pages").select("page_id", T.log_safe(F.col("url")).alias("safe"))


@query("SELECT page_id, sha256(replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#39;')) AS escaped FROM pages")
def html_escape(spark, d):
    return load(spark, d, "pages").select("page_id", F.sha2(T.html_escape(F.col("html")), 256).alias("escaped"))


@query("SELECT page_id, url_encode(url) AS encoded FROM pages")
def url_encode(spark, d):
    return load(spark, d, "pages").select("page_id", F.url_encode("url").alias("encoded"))


@query("SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'Not run' ELSE (event_id // 1000) || '.' || lpad((event_id % 1000)::VARCHAR, 3, '0') || ' s (' || event_id || ' ms)' END AS shown, CASE WHEN event_id % 2 = 0 THEN event_id ELSE event_id * 1000 END AS header_ms FROM events")
def duration_text(spark, d):
    n = F.col("event_id").cast("string")
    header = F.when(F.col("event_id") % 2 == 0, F.concat(n, F.lit("ms"))).otherwise(F.concat(n, F.lit("s")))
    return load(spark, d, "events").select("event_id", T.duration_text(F.when(F.col("event_id") % 5 != 0, F.col("event_id"))).alias("shown"), T.header_millis(header).alias("header_ms"))


# Collected runs, summaries and stored changes


@query(f"WITH {PAGES}, w AS (SELECT window_id, min_by(total_results, page_no) AS reported_total, count(*) AS pages, sum(items) AS rows, sum(new_rows) AS new_rows FROM pages_ GROUP BY ALL) SELECT count(*) AS windows, CAST(sum(reported_total) AS BIGINT) AS reported_total, CAST(sum(pages) AS BIGINT) AS pages, CAST(sum(rows) AS BIGINT) AS rows, CAST(sum(new_rows) AS BIGINT) AS new_rows FROM w")
def reported_total(spark, d):
    return collect.reported_total(page_log(spark, d))


_KNOWN = "known AS (SELECT event_type AS window_id, count(*) // 2 AS pages, count(*) AS rows, CASE WHEN event_type = 'click' THEN 'COLLECTED' ELSE 'COLLECTING' END AS status FROM events WHERE event_type <> 'error' GROUP BY ALL)"


@query(f"WITH {PAGES}, {_KNOWN}, now_ AS (SELECT window_id, CAST(sum(items) AS BIGINT) AS r, count(*) AS p, max_by(items, page_no) AS last_ FROM pages_ WHERE page_no >= 2 GROUP BY ALL) SELECT coalesce(k.window_id, n.window_id) AS window_id, greatest(coalesce(k.pages, 0), coalesce(p, 0)) AS pages, greatest(coalesce(k.rows, 0), coalesce(r, 0)) AS rows, CASE WHEN k.status = 'COLLECTED' OR last_ < 50 THEN 'COLLECTED' WHEN p IS NOT NULL THEN 'COLLECTING' ELSE k.status END AS status FROM known k FULL JOIN now_ n ON n.window_id = k.window_id")
def collection_evidence(spark, d):
    e = load(spark, d, "events").where("event_type <> 'error'")
    known = e.groupBy(F.col("event_type").alias("window_id")).agg(F.floor(F.count("*") / 2).cast("bigint").alias("pages"), F.count("*").alias("rows"), F.max(F.when(F.col("event_type") == "click", "COLLECTED").otherwise("COLLECTING")).alias("status"))
    return collect.progress(known, page_log(spark, d).where("page_no >= 2"), 50)


@query("SELECT 'same' AS list, true AS same, CAST(0 AS BIGINT) AS differences UNION ALL SELECT 'turned', false, (SELECT count(*) FROM (SELECT row_number() OVER (ORDER BY o_orderstatus) AS a, row_number() OVER (ORDER BY o_orderstatus DESC) AS b FROM (SELECT DISTINCT o_orderstatus FROM orders)) WHERE a <> b) UNION ALL SELECT 'short', false, CAST(1 AS BIGINT)")
def requested_windows(spark, d):
    """Requested windows are the pending ones only in the same order and number."""
    o = load(spark, d, "orders").select("o_orderstatus").distinct()
    numbered = lambda *order: staging.dense_sequence(o.withColumn("_r", F.negative(F.ascii("o_orderstatus"))), list(order), "n", -1, settled).select("n", "o_orderstatus")
    there = numbered("o_orderstatus")
    one = lambda name, asked: collect.same_in_order(asked, there, "n", ["o_orderstatus"]).select(F.lit(name).alias("list"), "same", "differences")
    return one("same", numbered("o_orderstatus")).unionByName(one("turned", numbered("_r", "o_orderstatus"))).unionByName(one("short", there.where("n > 0")))


@query("SELECT event_type, event_id, user_id, execution_sequence FROM (SELECT event_type, event_id, user_id, row_number() OVER (ORDER BY event_type, event_id) AS execution_sequence FROM events) WHERE execution_sequence <= 700")
def run_wide_limit(spark, d):
    """The limit of a run: rows in the order of windows and keys, over all windows together."""
    return collect.limited(load(spark, d, "events").select("event_type", "event_id", "user_id"), ["event_type", "event_id"], 700, settled)


def runs(spark: SparkSession, d: str) -> DataFrame:
    rows = stg(spark, d).groupBy("execution_id").agg(F.min("staging_key").alias("k"), F.count("*").alias("expected_count"), F.min("indexed_at").alias("started_at"), F.max("indexed_at").alias("finished_at"))
    status = F.when(F.col("execution_id") == "ex0", "COMPLETED").otherwise("COMPLETED_WITH_ERRORS")
    return rows.select("execution_id", F.when(F.col("k") % 2 == 1, "BACKFILL").otherwise("INCREMENTAL").alias("mode"), status.alias("status"), "expected_count", F.ceil(F.col("expected_count") / 100).alias("pages"), "started_at", "finished_at")


RUNS = ", ru AS (SELECT execution_id, CASE WHEN min(staging_key) % 2 = 1 THEN 'BACKFILL' ELSE 'INCREMENTAL' END AS mode, CASE WHEN execution_id = 'ex0' THEN 'COMPLETED' ELSE 'COMPLETED_WITH_ERRORS' END AS status, count(*) AS expected_count, CAST(ceil(count(*) / 100.0) AS BIGINT) AS pages, min(indexed_at) AS started_at, max(indexed_at) AS finished_at FROM st GROUP BY ALL)"
_CASES = {"open": "true", "closed": "false", "elsewhere": "execution_id = 'ex0'"}


def _preflight_sql(case: str, mode: str) -> str:
    none = {"BACKFILL": "CASE WHEN o > 0 AND s IS NULL THEN 'OPERATOR_REVIEW' WHEN o > 0 THEN 'OPEN_ERRORS_REQUIRE_REPLAY' ELSE 'RUN' END", "REPLAY_ERRORS": "CASE WHEN s IS NULL AND o > 0 THEN 'OPERATOR_REVIEW' WHEN s IS NULL THEN 'NO_REPLAY_TARGET' ELSE 'RUN' END"}.get(mode, "'RUN'")
    return f"""SELECT '{case}' AS "case", '{mode}' AS mode, *, CASE decision WHEN 'OPEN_ERRORS_REQUIRE_REPLAY' THEN 'REPLAY_ERRORS' WHEN 'OPERATOR_REVIEW' THEN 'OPERATOR_REVIEW' WHEN 'NO_REPLAY_TARGET' THEN 'BACKFILL' ELSE '{mode}' END AS next_mode FROM (
  SELECT o AS open_errors, replayable AS replayable_errors, s.execution_id AS source_execution_id, coalesce(s.bound, 0) AS error_bound, coalesce(s.selected, 0) AS selected, {none} AS decision FROM (
  SELECT (SELECT count(*) FROM err WHERE status = 'OPEN' AND {_CASES[case]}) AS o, coalesce(CAST(sum(selected) AS BIGINT), 0) AS replayable, max({{'a': started_at, 'execution_id': execution_id, 'bound': bound, 'selected': selected}}) AS s FROM src WHERE {_CASES[case]}))"""


_SOURCES = ", src AS (SELECT ru.execution_id, ru.started_at, max(err.error_key) AS bound, count(*) AS selected FROM err JOIN st ON st.execution_id = err.execution_id AND st.staging_key = err.staging_key JOIN ru ON ru.execution_id = err.execution_id WHERE err.status = 'OPEN' AND ru.mode = 'BACKFILL' AND ru.status = 'COMPLETED_WITH_ERRORS' AND ru.finished_at IS NOT NULL GROUP BY ALL)"


@query(f"WITH {STG}, {ERR}{RUNS}{_SOURCES} {' UNION ALL '.join(_preflight_sql(c, m) for c in _CASES for m in ('BACKFILL', 'REPLAY_ERRORS', 'INCREMENTAL'))}")
def preflight_full(spark, d):
    """All decisions: with open errors, without, and with such as no replay may take."""
    rows, executions, errors = stg(spark, d), runs(spark, d), errs(spark, d)
    out = [reports.preflight_report(errors.where(where), rows, executions, mode).select(F.lit(case).alias("case"), F.lit(mode).alias("mode"), "*") for case, where in _CASES.items() for mode in ("BACKFILL", "REPLAY_ERRORS", "INCREMENTAL")]
    every = out[0]
    for one in out[1:]:
        every = every.unionByName(one)
    return every


def steps(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "events").where("event_type in ('click', 'error') and user_id % 3 > 0")
    step = F.when(F.col("event_type") == "click", "collect").otherwise("sync")
    return e.groupBy(F.concat(F.lit("ex"), F.floor(F.col("event_id") / EXECUTION).cast("string")).alias("execution_id"), step.alias("step")).agg(F.min("ts").cast("timestamp").alias("started_at"), F.max("ts").cast("timestamp").alias("ended_at"))


_STEPS = f", sp AS (SELECT 'ex' || (event_id // {EXECUTION}) AS execution_id, date_diff('microsecond', min(ts) FILTER (event_type = 'click'), max(ts) FILTER (event_type = 'click')) // 1000 AS collect_ms, date_diff('microsecond', min(ts) FILTER (event_type = 'error'), max(ts) FILTER (event_type = 'error')) // 1000 AS sync_ms FROM events WHERE event_type IN ('click', 'error') AND user_id % 3 > 0 GROUP BY ALL)"
_SUMMARY = f"""{RUNS}, ch AS (SELECT execution_id, {', '.join(f'CAST(sum({c}) AS BIGINT) AS {c}' for c in COUNTERS)}, CAST(sum({' + '.join(COUNTERS)}) AS BIGINT) AS accounted FROM chk GROUP BY ALL), sg AS (SELECT execution_id, count(*) AS staged FROM st GROUP BY ALL),
er AS (SELECT execution_id, count(*) FILTER (status = 'OPEN') AS open_errors, count(*) FILTER (status = 'RESOLVED') AS resolved_errors FROM err GROUP BY ALL){_STEPS},
sm AS (SELECT ru.execution_id, mode, status, expected_count, pages, staged, {', '.join(COUNTERS)}, accounted, coalesce(open_errors, 0) AS open_errors, coalesce(resolved_errors, 0) AS resolved_errors, collect_ms, sync_ms FROM ru LEFT JOIN sg USING (execution_id) LEFT JOIN ch USING (execution_id) LEFT JOIN er USING (execution_id) LEFT JOIN sp USING (execution_id))"""


@query(f"WITH {STG}{TGT}{DEC}{CHK}, {ERR}{_SUMMARY} SELECT * FROM sm")
def run_summary(spark, d):
    return reports.run_summary(runs(spark, d).drop("started_at", "finished_at"), stg(spark, d), sync_chunk_counts(spark, d), errs(spark, d), steps(spark, d))


@query(
    f"WITH {STG}{TGT}{DEC}{CHK}, {ERR}{_SUMMARY} SELECT execution_id, concat_ws(',', CASE WHEN status <> 'COMPLETED' THEN 'status' END, CASE WHEN mode = 'BACKFILL' AND expected_count <> {EXECUTION} THEN 'expected' END, CASE WHEN mode = 'BACKFILL' AND staged <> {EXECUTION} THEN 'staged' END, "
    f"CASE WHEN mode = 'BACKFILL' AND accounted <> {EXECUTION} THEN 'accounted' END, CASE WHEN mode = 'BACKFILL' AND pages <> 25 THEN 'pages' END, CASE WHEN mode = 'BACKFILL' AND open_errors > 0 THEN 'open errors' END) AS faults FROM sm"
)
def summary_consistency(spark, d):
    return reports.summary_faults(run_summary(spark, d), EXECUTION, 25).select("execution_id", F.array_join("faults", ",").alias("faults"))


@query(f"WITH {STG}{RUNS}{_STEPS} SELECT ru.execution_id, mode, collect_ms, sync_ms FROM ru LEFT JOIN sp USING (execution_id)")
def execution_steps(spark, d):
    return reports.execution_steps(runs(spark, d).select("execution_id", "mode"), steps(spark, d), ["collect", "sync"])


@query(
    f"WITH {STG}{TGT}, {ERR}, rp AS (SELECT 'rp' || (error_key % 5) AS execution_id, error_key AS source_error_key, st.doi FROM err JOIN st ON st.execution_id = err.execution_id AND st.staging_key = err.staging_key WHERE replay_count = 0), "
    "n AS (SELECT execution_id, count(*) AS staged FROM rp GROUP BY ALL) SELECT rp.execution_id, source_error_key, err.status AS error_status, replay_count, CAST(0 AS BIGINT) AS new_errors, staged, staged AS inserted, CAST(CASE WHEN tgt.doi IS NULL THEN 0 ELSE 1 END AS BIGINT) AS target_rows, "
    "CASE WHEN rp.execution_id = 'rp1' THEN 'FAILED' ELSE 'COMPLETED' END AS replay_status, err.status = 'RESOLVED' AND rp.execution_id <> 'rp1' AND tgt.doi IS NOT NULL AS proven FROM rp JOIN err ON err.error_key = rp.source_error_key JOIN n ON n.execution_id = rp.execution_id LEFT JOIN tgt ON tgt.doi = rp.doi"
)
def replay_before_after(spark, d):
    """What replays have made of the errors that had none before."""
    errors = errs(spark, d)
    first = errors.where("replay_count = 0").join(stg(spark, d).select("execution_id", "staging_key", "doi"), ["execution_id", "staging_key"])
    rows = settled(first.select(F.concat(F.lit("rp"), (F.col("error_key") % 5).cast("string")).alias("execution_id"), F.col("error_key").alias("source_error_key"), "doi"))
    chunks = rows.groupBy("execution_id").agg(F.count("*").alias("inserted_count"))
    executions = rows.select("execution_id").distinct().withColumn("status", F.when(F.col("execution_id") == "rp1", "FAILED").otherwise("COMPLETED"))
    return reports.replay_report(errors, rows, chunks, tgt(spark, d), executions, rows.select("execution_id", "source_error_key"))


@query(f"WITH {ERR} SELECT error_key, CASE WHEN status = 'OPEN' AND error_code <> 'C3' THEN 'RESOLVED' ELSE status END AS status, CASE WHEN error_key % 2 = 0 THEN 'then' WHEN status = 'OPEN' AND error_code <> 'C3' THEN 'now' END AS resolved_at FROM err")
def resolve_other_errors(spark, d):
    """A filtered update: open errors but of one code are resolved; a time that is there stays."""
    had = errs(spark, d).withColumn("resolved_at", F.when(F.col("error_key") % 2 == 0, "then"))
    return changes.resolve_others(had, F.col("error_code") == "C3", F.lit("now")).select("error_key", "status", "resolved_at")


@query(f"WITH {STG}{TGT} SELECT doi, content_hash FROM tgt WHERE doi NOT LIKE '%/click'")
def delete_targets(spark, d):
    return changes.deleted(tgt(spark, d), F.col("doi").like("%/click")).select("doi", "content_hash")


@query("SELECT user_id AS request_id, max('e' || lpad(event_id::VARCHAR, 8, '0')) AS execution_id, max_by(CASE WHEN value > 90 THEN 'COMPLETED_WITH_ERRORS' ELSE 'COMPLETED' END, event_id) AS status FROM events WHERE value > 40 GROUP BY ALL")
def latest_completed(spark, d):
    e = load(spark, d, "events")
    status = F.when(F.col("value") > 90, "COMPLETED_WITH_ERRORS").when(F.col("value") > 40, "COMPLETED").otherwise("FAILED")
    return reports.latest_completed(e.select(F.col("user_id").alias("request_id"), F.concat(F.lit("e"), F.lpad(F.col("event_id").cast("string"), 8, "0")).alias("execution_id"), status.alias("status")))


@query("WITH c AS (SELECT 'nation' AS name, count(*) AS n FROM nation UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'none', 0) SELECT * FROM c UNION ALL SELECT 'total', CAST(sum(n) AS BIGINT) FROM c")
def row_count_check(spark, d):
    return reports.row_counts({"nation": load(spark, d, "nation"), "orders": load(spark, d, "orders"), "none": load(spark, d, "orders").where("false")})


@query("WITH t AS (SELECT user_id, value * 1048576 AS v, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) SELECT user_id, count(*) AS samples, max(v) AS peak FROM t WHERE r <= 64 GROUP BY ALL")
def sample_peaks(spark, d):
    samples = load(spark, d, "events").select("user_id", "event_id", (F.col("value") * 1048576).alias("v"))
    return reports.sample_trend(samples, ["user_id"], "event_id", "v").select("user_id", "samples", "peak")


@query("SELECT doc_id, sha256(lower(nfc_normalize('10.1/' || doc_id || 'e' || chr(769) || 'X  ' || 'A' || chr(778)))) AS hash FROM documents")
def doi_keys(spark, d):
    raw = F.concat(F.lit("  10.1/"), F.col("doc_id").cast("string"), F.lit("e\u0301X  A\u030a\n"))
    return load(spark, d, "documents").select("doc_id", F.sha2(T.doi_key(raw), 256).alias("hash"))


@query("SELECT event_id, CASE event_id % 6 WHEN 3 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN 4 THEN strftime(ts - INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S') END AS instant FROM events")
def instants(spark, d):
    """Only a date and time with a zone is an instant."""
    at, k = lambda form: F.date_format("ts", form), F.col("event_id") % 6
    full = at("yyyy-MM-dd'T'HH:mm:ss")
    text = F.when(k == 0, at("yyyy-MM-dd")).when(k == 1, at("HH:mm")).when(k == 2, full).when(k == 3, F.concat(full, F.lit("Z"))).when(k == 4, F.concat(full, F.lit("+02:00"))).otherwise("now")
    return load(spark, d, "events").select("event_id", F.date_format(T.instant(text), "yyyy-MM-dd HH:mm:ss").alias("instant"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey ELSE 1 END AS range_from, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey + 5 ELSE o_orderkey + 9 END AS range_until FROM orders")
def incremental_ranges(spark, d):
    o, k = load(spark, d, "orders"), F.col("o_orderkey")
    start, end = windows.incremental_range(F.when(k % 2 == 0, k), F.lit(1).cast("bigint"), F.when(k % 3 == 0, k + 5), k + 9)
    return o.select("o_orderkey", start.alias("range_from"), end.alias("range_until"))


@query("SELECT execution_id, source_error_key, count(*) AS n FROM (SELECT 'ex' || (event_id // 2500) AS execution_id, CASE WHEN event_id % 4 > 0 THEN user_id END AS source_error_key FROM events) WHERE source_error_key IS NOT NULL GROUP BY ALL HAVING count(*) > 1")
def lineage_violations(spark, d):
    e = load(spark, d, "events").select(F.concat(F.lit("ex"), F.floor(F.col("event_id") / EXECUTION).cast("string")).alias("execution_id"), F.when(F.col("event_id") % 4 > 0, F.col("user_id")).alias("source_error_key"))
    return replay.lineage_violations(e)


# Buckets, versions, trees of digests, overlapping ranges


def upserted_store(spark: SparkSession, d: str) -> Store:
    """A store whose table target is, in version 1, what tgt() holds, and in version 2 what one execution of all staged rows leaves."""
    store, rows = Store(spark, f"{shared_dir(spark)}/store-{uuid.uuid4().hex}"), stg_all(spark, d)
    store.commit(upserts={"target": (tgt(spark, d), "doi", None, None)})
    at = store.manifest()
    looked = store.touched("target", rows, "doi", at)
    decided = settled(sync.decisions(rows, store.read("target", at=at, buckets=looked), CHUNK))
    written = store.touched("target", sync.winners(decided), "doi", at)
    new = sync.upserted(store.read("target", at=at, buckets=written), rows, decided, ["content_hash", "content"], F.lit("new"))
    store.commit(upserts={"target": (new, "doi", written, looked)}, base=at)
    return store


@query(ORACLES["sync_upsert_all"])
def bucketed_upsert(spark, d):
    """The upsert of every staged row through a bucketed table; buckets that no row changes are not written."""
    return upserted_store(spark, d).read("target").select("doi", "content_hash", "content", day("source_indexed_at").alias("day"), "created_at", "updated_at")


@query(f"""WITH {STG}{TGT}, after AS ({ORACLES["sync_upsert_all"]}), before AS (SELECT doi, content_hash, content, strftime(indexed_at, '%Y-%m-%d') AS day, 'old' AS created_at, 'old' AS updated_at FROM tgt)
SELECT a.doi, CASE WHEN b.doi IS NULL THEN 'INSERTED' ELSE 'UPDATED' END AS change, a.content_hash, a.content, a.day, a.created_at, a.updated_at FROM after a LEFT JOIN before b ON b.doi = a.doi
WHERE b.doi IS NULL OR (a.content_hash, a.content, a.day, a.created_at, a.updated_at) IS DISTINCT FROM (b.content_hash, b.content, b.day, b.created_at, b.updated_at)""")
def target_changes(spark, d):
    """What two versions of the target don't share, read from the buckets that differ."""
    return upserted_store(spark, d).changes("target", "doi", 1, 2).select("doi", "change", "content_hash", "content", day("source_indexed_at").alias("day"), "created_at", "updated_at")


_TREE_WIDTH, _TREE_FAN = 256, 16
_ROW_TEXT = " || ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("staging_key", "doi", "content_hash"))


def leaves_sql(rows: str, where: str = "") -> str:
    counted = f"SELECT staging_key AS k, sha256({_ROW_TEXT}) AS h, count(*) AS c FROM {rows} {where} GROUP BY ALL"
    return f"SELECT k // {_TREE_WIDTH} AS node, CAST(sum(c) AS BIGINT) AS n, sha256(string_agg(h || 'x' || c, ',' ORDER BY k, h)) AS digest FROM ({counted}) GROUP BY ALL"


_UP = "CAST(sum(n) AS BIGINT) AS n, sha256(string_agg(digest, ',' ORDER BY node)) AS digest"


@query(f"""WITH {STG}, l0 AS ({leaves_sql("st")}), l1 AS (SELECT node // {_TREE_FAN} AS node, {_UP} FROM l0 GROUP BY 1), l2 AS (SELECT node // {_TREE_FAN} AS node, {_UP} FROM l1 GROUP BY 1), l3 AS (SELECT 0 AS node, {_UP} FROM l2 GROUP BY 1)
SELECT 0 AS level, * FROM l0 UNION ALL SELECT 1, * FROM l1 UNION ALL SELECT 2, * FROM l2 UNION ALL SELECT 3, * FROM l3""")
def digest_tree(spark, d):
    """Every node of the digest tree over all staged rows in the order of their keys."""
    return tree_digest.tree(stg(spark, d), "staging_key", ["staging_key", "doi", "content_hash"], _TREE_WIDTH, _TREE_FAN, 3)


@query(f"""WITH {STG}, a AS ({leaves_sql("st")}), b AS ({leaves_sql("st", "WHERE NOT (doi LIKE '%7/purchase' AND content = 2)")})
SELECT coalesce(a.node, b.node) * {_TREE_WIDTH} AS first_key, coalesce(a.node, b.node) * {_TREE_WIDTH} + {_TREE_WIDTH - 1} AS last_key, coalesce(a.n, 0) AS n_before, coalesce(b.n, 0) AS n_after
FROM a FULL JOIN b ON a.node = b.node WHERE a.digest IS DISTINCT FROM b.digest""")
def digest_differences(spark, d):
    """The key ranges in which staged rows differ once some rows are gone."""
    rows = stg(spark, d)
    return tree_digest.differing_ranges(rows, rows.where("not (doi like '%7/purchase' and content = 2)"), "staging_key", ["staging_key", "doi", "content_hash"], _TREE_WIDTH)


@query("""WITH r AS (SELECT l_suppkey, l_orderkey, l_linenumber, epoch_us(l_shipdate) AS f, epoch_us(l_shipdate) + CAST(l_quantity AS BIGINT) * 3600000000 AS t FROM lineitem),
h AS (SELECT r.l_suppkey, f, t, count(*) AS rows_in_range, min(p.us) AS least, max(p.us) AS most FROM (SELECT DISTINCT l_suppkey, f, t FROM r) r JOIN (SELECT l_suppkey, epoch_us(l_shipdate) AS us FROM lineitem) p ON p.l_suppkey = r.l_suppkey AND p.us BETWEEN f AND t GROUP BY ALL)
SELECT r.l_orderkey, r.l_linenumber, r.l_suppkey, r.f AS first_us, r.t AS last_us, coalesce(rows_in_range, 0) AS rows_in_range, least, most FROM r LEFT JOIN h ON h.l_suppkey = r.l_suppkey AND h.f = r.f AND h.t = r.t""")
def range_contents(spark, d):
    """For every line, how many of its supplier's lines ship within as many hours from its own as it has pieces: overlapping ranges of all lengths."""
    own = load(spark, d, "lineitem").withColumn("us", F.unix_micros(F.col("l_shipdate").cast("timestamp")))
    ranges = own.select("l_orderkey", "l_linenumber", "l_suppkey", F.col("us").alias("first_us"), (F.col("us") + F.col("l_quantity").cast("bigint") * 3_600_000_000).alias("last_us"))
    return intervals.range_contents(ranges, "first_us", "last_us", own, "us", ["l_suppkey"])


# Verification of one large execution


def broken_all(spark: SparkSession, d: str, rows: DataFrame) -> DataFrame:
    """The chunk results of one execution of all staged rows, with a chunk left out, one that ends too late and one that counts a row too many."""
    c = sync.chunk_results(settled(sync.decisions(rows, tgt(spark, d), CHUNK)), rows, CHUNK).where("chunk_sequence <> 3")
    n = F.col("chunk_sequence")
    return c.withColumn("last_staging_key", F.col("last_staging_key") + F.when(n == 2, 5).otherwise(0)).withColumn("inserted_count", F.col("inserted_count") + F.when(n == 4, 1).otherwise(0))


BROKEN_ALL = BROKEN.replace("execution_id = 'ex2' AND ", "").replace("execution_id = 'ex3' AND ", "").replace("execution_id = 'ex1' AND ", "")


@query(f"WITH {STG_ALL}{TGT}{DEC}{CHK}{BROKEN_ALL} SELECT * FROM vl")
def coverage_check_all(spark, d):
    rows = settled(stg_all(spark, d))
    return verify.coverage(settled(broken_all(spark, d, rows)), rows, settled).select("execution_id", "chunk_sequence", "accounted", "violation")


@query(ORACLES["coverage_first_failure"].replace(STG, STG_ALL).replace(BROKEN, BROKEN_ALL))
def coverage_first_failure_all(spark, d):
    rows = settled(stg_all(spark, d))
    return verify.first_failure(verify.coverage(settled(broken_all(spark, d, rows)), rows, settled))


@query(ORACLES["verify_verdict"].replace(STG, STG_ALL))
def verify_verdict_all(spark, d):
    """The verdict on one execution that holds every staged row."""
    rows = settled(stg_all(spark, d))
    return verdict_of(rows, tgt(spark, d), staging.frozen(rows).select("execution_id", "expected_count"))
