"""Statistics, metric series and message streams over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanvec.operators import aggregates, rows, series
from spanvec.plans.base import query, r6, table
from spanvec.streaming import messages, metrics



def failed():
    return F.col("event_type") == "error"


@query(
    "collection_stats",
    """SELECT label, count(*) AS row_count, CAST(grouping(label) AS INT) AS is_total
    FROM embeddings GROUP BY ROLLUP (label)""",
)
def collection_stats(spark, sf):
    return aggregates.collection_stats(table(spark, sf, "embeddings"), "label")


CATALOG = """cat AS (SELECT source AS name, 'texts of ' || source AS description, string_agg(DISTINCT lang, ',' ORDER BY lang) AS tags
    FROM documents GROUP BY source UNION ALL SELECT 'empty', 'no texts', '')"""
COUNTS = "cnt AS (SELECT source, count(*) AS n FROM documents GROUP BY source)"


def _catalog(spark, sf):
    langs = F.array_join(F.array_sort(F.collect_set("lang")), ",").alias("tags")
    named = table(spark, sf, "documents").groupBy(F.col("source").alias("name")).agg(langs)
    described = named.select("name", F.concat(F.lit("texts of "), "name").alias("description"), "tags")
    none = spark.range(1).select(F.lit("empty").alias("name"), F.lit("no texts").alias("description"), F.lit("").alias("tags"))
    return described.unionByName(none)


@query(
    "list_partitions",
    f"""WITH {CATALOG}, {COUNTS} SELECT name, description, tags, coalesce(n, 0) AS num_entities
    FROM cat LEFT JOIN cnt ON cat.name = cnt.source""",
)
def list_partitions(spark, sf):
    return aggregates.list_partitions(_catalog(spark, sf), table(spark, sf, "documents"), "source")


@query(
    "partition_stats",
    f"""WITH {CATALOG}, {COUNTS} SELECT name, description, tags, coalesce(n, 0) AS num_entities, false AS is_loaded
    FROM cat LEFT JOIN cnt ON cat.name = cnt.source WHERE name = 'src3'""",
)
def partition_stats(spark, sf):
    return aggregates.partition_stats(_catalog(spark, sf), table(spark, sf, "documents"), "source", "src3")


MEASURES = """count(*) AS query_count, count(*) FILTER (WHERE event_type = 'error') AS error_count,
    round(avg(value), 6) + 0.0 AS avg_latency,
    round(100.0 * count(*) FILTER (WHERE event_type = 'error') / count(*), 6) + 0.0 AS error_rate"""


def _measures(df):
    return df.withColumns({"avg_latency": r6("avg_latency"), "error_rate": r6("error_rate")})


@query("metric_summary", f"SELECT CAST(ts AS DATE) AS day, {MEASURES} FROM events GROUP BY 1")
def metric_summary(spark, sf):
    events = table(spark, sf, "events")
    day = F.to_date("ts").alias("day")
    return _measures(aggregates.metric_summary(events, [day], F.col("value"), failed()))


@query(
    "error_rate",
    """SELECT user_id, round(100.0 * count(*) FILTER (WHERE event_type = 'error') / count(*), 6) + 0.0 AS rate
    FROM events GROUP BY user_id""",
)
def error_rate(spark, sf):
    rate = aggregates.error_rate(failed())
    return table(spark, sf, "events").groupBy("user_id").agg(r6(rate).alias("rate"))


@query(
    "profile_summary",
    """SELECT event_type, count(*) AS calls, round(avg(value), 6) + 0.0 AS mean_duration, max(value) AS max_duration,
    round(max(value) - min(value), 6) + 0.0 AS duration_spread FROM events GROUP BY event_type""",
)
def profile_summary(spark, sf):
    out = aggregates.profile_summary(table(spark, sf, "events"), "event_type", "value")
    return out.withColumns({"mean_duration": r6("mean_duration"), "duration_spread": r6("duration_spread")})


LATEST = """latest AS (SELECT event_type, ts, event_id, value FROM (SELECT *, row_number() OVER
    (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1)"""


def _latest(spark, sf):
    return series.latest_per_type(
        table(spark, sf, "events"), "event_type", "ts", "event_id", ["event_id", "value"]
    )


@query("latest_per_type", f"WITH {LATEST} SELECT event_type, ts, event_id, value FROM latest")
def latest_per_type(spark, sf):
    return _latest(spark, sf)


@query(
    "last_n_history",
    """SELECT event_type, event_id, ts, CAST(r AS INT) AS rank FROM (SELECT *, row_number() OVER
    (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r <= 100""",
)
def last_n_history(spark, sf):
    out = series.last_n(table(spark, sf, "events"), "event_type", "ts", "event_id", 100)
    return out.select("event_type", "event_id", "ts", "rank")


THRESHOLDS = {"click": 5.0, "error": 0.5, "purchase": 20.0, "view": 1.0, "signup": 1000.0}


@query(
    "alert_rules",
    f"""WITH {LATEST}, rule(metric, threshold) AS (VALUES
    {", ".join(f"('{m}', {t}::DOUBLE)" for m, t in THRESHOLDS.items())})
    SELECT metric, value, threshold, 'Alert: ' || metric || ' exceeded threshold (' || value || ' > ' || threshold || ')'
    AS message FROM latest JOIN rule ON metric = event_type WHERE value > threshold""",
)
def alert_rules(spark, sf):
    latest = _latest(spark, sf).withColumnRenamed("event_type", "metric")
    return series.alert_rules(latest, THRESHOLDS)


@query(
    "metric_retention",
    "SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 7 DAY",
)
def metric_retention(spark, sf):
    now = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    return series.metric_retention(table(spark, sf, "events"), "ts", now, "7 days").select("event_id", "ts")


@query(
    "metric_stream",
    f"""SELECT time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '1970-01-01') AS window_start,
    time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '1970-01-01') + INTERVAL 1 DAY AS window_end,
    {MEASURES} FROM events GROUP BY 1, 2""",
)
def metric_stream(spark, sf):
    return _measures(metrics.metric_stream(table(spark, sf, "events"), "ts", "1 day", "value", failed()))


# --- message streams, on a static frame -------------------------------------------------


def message_texts(spark, sf):
    """The embeddings as messages of 16 vectors, the last one without metadata."""
    e = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"), "label")
    chunks = rows.gather_batches(e, 16, "vec_id", "vec_id", "v", "label")
    entry = lambda s: F.create_map(
        F.lit("id"), s["vec_id"].cast("string"), F.lit("label"), s["label"].cast("string")
    )
    return chunks.select(
        "batch",
        F.transform("items", lambda s: s["v"]).alias("vectors"),
        # Metadata of all but the last item: a vector beyond them has none.
        F.transform(F.slice("items", F.lit(1), F.size("items") - 1), entry).alias("metadata"),
    )


MESSAGE_ROWS = """m AS (SELECT vec_id, label, embedding, CAST(floor((row_number() OVER (ORDER BY vec_id) - 1) / 16) AS BIGINT) AS batch,
    CAST((row_number() OVER (ORDER BY vec_id) - 1) % 16 AS INT) AS pos FROM embeddings)"""


@query(
    "stream_parse",
    f"""WITH {MESSAGE_ROWS} SELECT batch, CAST(count(*) AS INT) AS vectors, CAST(count(*) - 1 AS INT) AS metadata,
    'insert' AS operation, 'default' AS collection FROM m GROUP BY batch""",
)
def stream_parse(spark, sf):
    texts = message_texts(spark, sf).select("batch", F.to_json(F.struct("vectors", "metadata")).alias("value"))
    broken = texts.select("batch", F.concat(F.lit("no message "), "value").alias("value"))
    read = messages.stream_parse(texts.unionByName(broken))
    return read.withColumns({"vectors": F.size("vectors"), "metadata": F.size("metadata")})


@query(
    "stream_explode",
    f"""WITH {MESSAGE_ROWS}, l AS (SELECT batch, max(pos) AS last FROM m GROUP BY batch)
    SELECT batch, pos, CASE WHEN pos < last THEN CAST(vec_id AS VARCHAR) END AS id,
    CASE WHEN pos < last THEN CAST(label AS VARCHAR) END AS label,
    round(list_sum(CAST(embedding AS DOUBLE[])), 6) + 0.0 AS total FROM m JOIN l USING (batch)""",
)
def stream_explode(spark, sf):
    texts = message_texts(spark, sf).select("batch", F.to_json(F.struct("vectors", "metadata")).alias("value"))
    out = messages.stream_explode(messages.stream_parse(texts))
    total = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x)
    return out.select(
        "batch",
        "pos",
        F.col("metadata")["id"].alias("id"),
        F.col("metadata")["label"].alias("label"),
        r6(total).alias("total"),
    )


@query(
    "stream_rejects",
    """SELECT doc_id, CASE WHEN lang = 'en' THEN 'malformed message' ELSE 'unknown operation' END AS reason
    FROM documents""",
)
def stream_rejects(spark, sf):
    body = F.to_json(F.struct(F.array(F.array(F.lit(1.0))).alias("vectors"), F.col("lang").alias("operation")))
    docs = table(spark, sf, "documents")
    texts = docs.select("doc_id", F.when(F.col("lang") == "en", F.col("text")).otherwise(body).alias("value"))
    return messages.stream_rejects(texts).select("doc_id", "reason")


@query(
    "stream_apply_ops",
    """WITH ops AS (SELECT vec_id AS id, 1 AS seq, 'update' AS operation, -label AS label FROM embeddings WHERE label IN (5, 6)
      UNION ALL SELECT vec_id, 2, 'delete', NULL FROM embeddings WHERE label IN (3, 6)
      UNION ALL SELECT doc_id, 3, 'insert', quality + 100 FROM labels),
    last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS r FROM ops) WHERE r = 1)
    SELECT coalesce(l.id, e.vec_id) AS id, CASE WHEN l.id IS NULL THEN e.label ELSE l.label END AS label
    FROM embeddings e FULL OUTER JOIN last l ON e.vec_id = l.id WHERE coalesce(l.operation, '') <> 'delete'""",
)
def stream_apply_ops(spark, sf):
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "label")

    def ops(df, seq, operation, label):
        return df.select(
            "id", F.lit(seq).alias("seq"), F.lit(operation).alias("operation"), label.cast("int").alias("label")
        )

    changes = (
        ops(e.where("label IN (5, 6)"), 1, "update", -F.col("label"))
        .unionByName(ops(e.where("label IN (3, 6)"), 2, "delete", F.lit(None)))
        .unionByName(
            ops(
                table(spark, sf, "labels").withColumnRenamed("doc_id", "id"),
                3,
                "insert",
                F.col("quality") + 100,
            )
        )
    )
    last = messages.latest_operations(changes, "id", "seq")
    return messages.apply_operations(e, last, "id", ["label"])
