"""What is written and read back: checks, the study's CSV files, saved documents, cut bodies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from rollcall.operators import decode, totals, verdict
from rollcall.plans import bindings as b, study
from rollcall.plans.catalog import query
from rollcall.plans.queries_ingest import _block_table
from rollcall.session import fresh_path, materialise
from rollcall.sources import csvfiles, jsondocs, tables


@query("append_checks", """SELECT CAST(o_orderkey AS VARCHAR) AS agent_id,
    CASE WHEN o_orderkey % 2 = 0 THEN 'first' ELSE 'second' END AS written
    FROM orders""")
def append_checks(spark, sf_dir):
    """Checks appended twice: the first row of a run and agent stays."""
    path, schema = fresh_path(spark, "checks"), "agent_id string, written string, run_id bigint"
    rows = b.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("agent_id"), F.lit("first").alias("written"),
        F.lit(1).cast("bigint").alias("run_id"))
    tables.append_checks(rows.where("agent_id % 2 = 0"), path, schema)
    tables.append_checks(rows.withColumn("written", F.lit("second")), path, schema)
    return spark.read.schema(schema).parquet(path).select("agent_id", "written")


_FILES = {"registered": csvfiles.REGISTERED_COLUMNS, "resolved": csvfiles.RESOLVED_COLUMNS,
          "monthly": csvfiles.MONTHLY_COLUMNS, "liveness": csvfiles.LIVENESS_COLUMNS}
_COUNTS = {"registered": "SELECT count(*) FROM events WHERE event_type = 'signup'",
           "resolved": "SELECT count(*) FROM events WHERE event_type = 'signup'",
           "monthly": "SELECT count(DISTINCT strftime(o_orderdate, '%Y-%m')) FROM orders",
           "liveness": "SELECT count(*) FROM orders"}


@query("study_files", " UNION ALL ".join(
    f"SELECT '{name}' AS file, '{','.join(columns)}' AS header, ({_COUNTS[name]}) AS \"rows\""
    for name, columns in _FILES.items()))
def study_files(spark, sf_dir):
    """The study's four files, each written in two goes and read back: header and rows."""
    raw = b.log_table(spark, sf_dir)
    rows = study.with_times(decode.study_registrations(raw), _block_table(raw))
    # Each log is taken for an agent of its own, as agents register more than once here.
    rows = materialise(rows.withColumn("agent_id", F.col("tx_hash")), "registrations")
    answers = rows.where("log_index % 7 <> 0").select("agent_id", F.lit("https://x").alias("uri"))
    targets = materialise(b.probe_targets(spark, sf_dir).where("pass = 1"), "targets")
    checked = verdict.grade_study(
        targets.select("run_id", "agent_id", "pass", "uri", F.lit("").alias("owner"),
                       F.lit("agent_uri_current").alias("uri_source"), "checked_at"),
        b.fetches(targets), b.endpoint_probes(targets))
    frames = {
        "registered": study.with_current_uris(rows, answers),
        "resolved": study.resolve(rows, answers),
        "monthly": totals.monthly(b.order_checks(spark, sf_dir), F.col("registered_at")),
        "liveness": checked}
    found = []
    for name, columns in _FILES.items():
        path = fresh_path(spark, name)
        frame = materialise(frames[name].select(*columns), name)
        half = F.pmod(F.xxhash64(columns[0]), F.lit(2)) == 0
        csvfiles.write_table(frame.where(half), path, columns)
        csvfiles.write_table(frame.where(~half), path, columns, append=True)
        back = csvfiles.read_table(spark, path)
        found.append(back.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("file"), F.lit(",".join(back.columns)).alias("header"), "rows"))
    return reduce(lambda a, c: a.unionByName(c), found)


@query("saved_document", """SELECT c_nationkey AS nation, count(*) AS agents
    FROM customer GROUP BY 1""")
def saved_document(spark, sf_dir):
    """A published document is written, and read again with its nested fields as columns."""
    entry = F.struct(F.col("c_nationkey").alias("nation"), F.col("agents"))
    body = F.struct(F.lit("x").alias("generated_at"), F.sort_array(F.collect_list(entry))
                    .alias("nations"))
    counts = b.table(spark, sf_dir, "customer").groupBy("c_nationkey") \
        .agg(F.count(F.lit(1)).alias("agents"))
    path = fresh_path(spark, "documents")
    jsondocs.write_documents(counts.agg(F.to_json(body).alias("json"))
                             .withColumn("name", F.lit("summary.json")), path)
    saved = jsondocs.read_saved(spark, f"{path}/name=summary.json")
    return saved.select(F.inline("nations")).select("nation", "agents")


CAP = 60


@query("capped_documents", f"""WITH cases AS (SELECT {b.CASE_COLUMNS} FROM orders)
    SELECT CAST(k AS VARCHAR) AS agent_id, CASE WHEN d = 0 OR strlen({b.BODY}) > {CAP}
        THEN 'not_json' WHEN d = 1 THEN 'json_not_object' END AS category
    FROM cases WHERE u >= 5 AND q >= 5""")
def capped_documents(spark, sf_dir):
    """Documents are cut at a size; what is cut is no longer JSON."""
    targets = materialise(b.probe_targets(spark, sf_dir).where("pass = 1 AND u >= 5 AND q >= 5"),
                          "targets")
    outcomes = verdict.fetch_outcomes(targets, b.fetches(targets), max_bytes=CAP)
    return outcomes.select("agent_id", F.col("analysis.json_category").alias("category"))
