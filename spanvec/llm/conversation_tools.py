"""Tool calls that Spark derives from the turns of ``conversations``.

A user's turn becomes a call of one of three tools, by the length of its text; the
turn after it, if it is the assistant's, its result. The call needs the result of a
turn half as far into the conversation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanvec.llm.tool_calls import Param

_AFTER = Param("array", required=False)
SCHEMAS = {
    "search": {"query": Param("string", least=1), "limit": Param("integer", least=1, most=300), "after": _AFTER},
    "lookup": {"key": Param("string", least=20), "strict": Param("boolean"), "after": _AFTER},
    "summarise": {"text": Param("string"), "words": Param("integer", most=200), "after": _AFTER},
}


def calls_and_results(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    turn, size = F.col("turn"), F.length("text").cast("bigint")
    name = lambda t: F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), t.cast("bigint").cast("string"))
    step = F.floor(turn / 2)
    before = F.floor((step - 1) / 2) * 2 + F.pmod(turn, F.lit(2))
    after = F.when(step > 0, F.array(F.concat(F.lit("$result:"), name(before)))).otherwise(F.array().cast("array<string>")).alias("after")
    text = F.coalesce("text", F.lit(""))
    kind = F.pmod(F.coalesce(size, F.lit(0)), F.lit(3))
    arguments = (
        F.when(kind == 0, F.to_json(F.struct(text.alias("query"), size.alias("limit"), after)))
        .when(kind == 1, F.to_json(F.struct((size > 100).alias("strict"), text.alias("key"), after)))
        .otherwise(F.to_json(F.struct(size.alias("words"), after, text.alias("text"))))
    )
    tool = F.when(kind == 0, "search").when(kind == 1, "lookup").otherwise("summarise")
    calls = conversations.where("role = 'user'").select("conv_id", name(turn).alias("call_id"), "turn", tool.alias("name"), arguments.alias("arguments"))
    results = conversations.where("role = 'assistant'").select("conv_id", name(turn - 1).alias("call_id"), "turn", F.col("text").alias("content"))
    return calls, results


ORACLE = """
WITH RECURSIVE u AS (
 SELECT conv_id, turn, text, length(text) AS n, length(text) % 3 AS k, turn // 2 AS step,
  (turn // 2 - 1) // 2 * 2 + turn % 2 AS before, 'c' || conv_id || '-' || turn AS call_id
 FROM conversations WHERE role = 'user'),
a AS (SELECT conv_id, turn + 0 AS turn, 'c' || conv_id || '-' || (turn - 1) AS call_id, text FROM conversations WHERE role = 'assistant'),
p AS (SELECT u.*, CASE WHEN step > 0 THEN 'c' || conv_id || '-' || before END AS need FROM u),
q AS (SELECT p.*, EXISTS (SELECT 1 FROM u WHERE u.conv_id = p.conv_id AND u.call_id = p.need) AS known FROM p),
l(conv_id, call_id, level) AS (
 SELECT conv_id, call_id, 0 FROM q WHERE NOT known
 UNION ALL SELECT q.conv_id, q.call_id, l.level + 1 FROM q JOIN l ON q.known AND q.conv_id = l.conv_id AND q.need = l.call_id),
j AS (SELECT q.*, l.level,
  CASE k WHEN 0 THEN 'search' WHEN 1 THEN 'lookup' ELSE 'summarise' END AS name,
  CASE WHEN k = 0 THEN CASE WHEN n < 1 THEN 'limit: below 1' WHEN n > 300 THEN 'limit: above 300' END
       WHEN k = 1 THEN CASE WHEN n < 20 THEN 'key: below 20' END
       ELSE CASE WHEN n > 200 THEN 'words: above 200' END END AS error,
  '{"after":' || CASE WHEN need IS NULL THEN '[]' ELSE '["$result:' || need || '"]' END ||
  CASE k WHEN 0 THEN ',"limit":' || n || ',"query":' || to_json(text)
         WHEN 1 THEN ',"key":' || to_json(text) || ',"strict":' || CASE WHEN n > 100 THEN 'true' ELSE 'false' END
         ELSE ',"text":' || to_json(text) || ',"words":' || n END || '}' AS args
 FROM q JOIN l USING (conv_id, call_id))
SELECT coalesce(j.conv_id, a.conv_id) AS conv_id, coalesce(j.call_id, a.call_id) AS call_id,
 CASE WHEN j.call_id IS NULL THEN 'result without call' WHEN a.call_id IS NULL THEN 'call without result' ELSE 'linked' END AS status,
 CAST(j.call_id IS NOT NULL AS BIGINT) AS n_calls, CAST(a.call_id IS NOT NULL AS BIGINT) AS n_results, CAST(j.level AS INTEGER) AS level,
 CAST(CASE WHEN j.need IS NOT NULL AND NOT j.known THEN 1 ELSE 0 END AS BIGINT) AS n_unknown_needs, j.error,
 CASE WHEN j.call_id IS NOT NULL THEN '{"arguments":' || j.args || ',"id":"' || j.call_id || '","name":"' || j.name || '"}' END AS call_json,
 CASE WHEN a.call_id IS NOT NULL THEN '{"content":' || to_json(a.text) || ',"tool_call_id":"' || a.call_id || '"}' END AS result_json
FROM j FULL JOIN a ON j.conv_id = a.conv_id AND j.call_id = a.call_id
"""
