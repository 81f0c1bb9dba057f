"""Tool-call linking with DataFrame and SQL functions only.

Calls and results of a conversation are joined by identifier.  Calls are put
in an order in which each stands after the calls it depends on: its rank is
the pair (latest turn among itself and all it depends on, number of steps it
had to move behind a call of that turn), found by passing ranks along the
dependencies until none changes.  Dependencies on earlier turns change
nothing, so the rounds are as many as the longest chain of dependencies on
later turns.  Arguments are checked against the tools' schemas, and each call
becomes one canonical JSON text (sorted keys, no white space).

Tables: calls (conv_id, turn, call_id, name, arguments: JSON text, after:
ids it depends on), results (conv_id, turn, call_id, content), schemas (name,
parameter, kind: a type name of ``KINDS``, required).

Status of a call: ``linked``, ``unanswered``, or ``cycle`` if it depends on
itself or on such a call, which leaves it without a rank; a result without a call is ``orphan``; calls without an identifier are
``no id``.  Edge cases: repeated rows count once; of several calls or results
with one id the earliest is used and their number reported; arguments that
are null, not JSON, not an object or have a key twice are ``malformed``;
dependencies on unknown ids are reported and otherwise ignored; null or empty
contents stay as they are; empty tables give an empty result; extra columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.llm.common import stored

KINDS = {"string": "STRING", "integer": "BIGINT", "number": "BIGINT|DECIMAL.*|DOUBLE|FLOAT", "boolean": "BOOLEAN",
         "object": "OBJECT.*", "array": "ARRAY.*"}
KEY = ["conv_id", "call_id"]


def _kind_pattern() -> Column:
    pattern = F.lit(None).cast("string")
    for kind, types in KINDS.items():
        pattern = F.when(F.col("kind") == kind, F.lit(f"^({types})$")).otherwise(pattern)
    return pattern


def _earliest(rows: DataFrame, columns: list[str], count: str) -> DataFrame:
    """The earliest row of each id, and how many different rows have it."""
    rows = rows.where(F.col("conv_id").isNotNull() & F.col("call_id").isNotNull())
    best = rows.groupBy(*KEY).agg(F.min(F.struct(*columns)).alias("r"), F.countDistinct(F.xxhash64(*columns)).alias(count))
    return best.select(*KEY, *(F.col(f"r.{c}").alias(c) for c in columns), count)


def _settle(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``nodes`` (conv_id, call_id, rank, size, cyclic) with final ranks and flags; ``edges`` are (conv_id, call_id, dep, steps).

    In each round an edge takes the rank of its dependency along if at most
    one edge leaves that, and then jumps to where this edge leads (or ends if
    there is none), so a chain halves.  An edge back to its own call, or of as
    many steps as the conversation has calls, lies on or leads to a cycle; so
    does every edge that is left when none can move.
    """
    while not edges.isEmpty():
        out = edges.groupBy(*KEY).agg(F.count("*").alias("degree"), F.max(F.struct("dep", "steps")).alias("next"))
        ahead = nodes.join(out, KEY, "left").select(
            "conv_id", F.col("call_id").alias("dep"), F.col("rank").alias("of"), F.col("cyclic").alias("stuck"),
            F.coalesce("degree", F.lit(0)).alias("degree"), "next")
        sizes = nodes.select(*KEY, "size")
        met = edges.join(ahead, ["conv_id", "dep"]).join(sizes, KEY)
        free = F.col("degree") <= 1
        target = F.when(F.col("degree") == 1, F.col("next.dep")).when(F.col("degree") > 1, F.col("dep"))
        steps = F.when(F.col("degree") == 1, F.col("steps") + F.col("next.steps")).otherwise(F.col("steps"))
        met = met.select(*KEY, F.when(free, F.struct(F.col("of.turn").alias("turn"), (F.col("of.steps") + F.col("steps")).alias("steps"))
                                      ).alias("least"), target.alias("dep"), steps.alias("steps"), "size", "stuck", free.alias("moved"))
        closed = F.col("stuck") | F.coalesce(F.col("dep") == F.col("call_id"), F.lit(False)) | (F.col("steps") >= F.col("size"))
        met = stored(met.withColumn("closed", closed), "call-steps")
        if met.where("moved OR closed").isEmpty():
            met = met.withColumn("closed", F.lit(True))
        found = met.groupBy(*KEY).agg(F.max("least").alias("least"), F.max("closed").alias("closed"))
        after = nodes.join(found, KEY, "left")
        higher = F.coalesce(F.col("least") > F.col("rank"), F.lit(False))
        nodes = stored(after.select(*KEY, F.when(higher, F.col("least")).otherwise(F.col("rank")).alias("rank"), "size",
                                    (F.col("cyclic") | F.coalesce("closed", F.lit(False))).alias("cyclic")), "call-ranks")
        edges = (met.where("dep is not null").groupBy(*KEY, "dep").agg(F.max("steps").alias("steps"))
                 .join(nodes.where("cyclic").select(*KEY), KEY, "left_anti"))
    return nodes


def ranks(calls: DataFrame, edges: DataFrame) -> DataFrame:
    """conv_id, call_id, rank (turn, steps), cyclic; ``edges`` are (conv_id, call_id, dep) of known calls.

    Only calls between the first call that waits for a later turn (or its own)
    and the latest turn waited for can move or lie on a cycle.  Calls after
    them keep their place, and matter only if they depend on a cycle.
    """
    at = F.coalesce(F.col("turn").cast("long"), F.lit(-(1 << 63)))
    own = calls.select(*KEY, F.struct("turn", F.lit(0).alias("steps")).alias("rank"), at.alias("at"))
    pairs = edges.join(own.select(*KEY, "at"), KEY).join(
        own.select("conv_id", F.col("call_id").alias("dep"), F.col("at").alias("dep_at")), ["conv_id", "dep"])
    span = pairs.where("dep_at >= at").groupBy("conv_id").agg(F.min("at").alias("low"), F.max("dep_at").alias("high"))
    sizes = calls.groupBy("conv_id").agg(F.count("*").alias("size"))
    nodes = stored(own.join(sizes, "conv_id").select(*KEY, "rank", "size", F.lit(False).alias("cyclic")), "call-ranks")
    pairs = stored(pairs.join(span, "conv_id").where("at >= low").select(
        *KEY, "dep", F.lit(1).alias("steps"), (F.col("at") > F.col("high")).alias("after"), (F.col("dep_at") < F.col("low")).alias("before")),
        "call-edges")
    nodes = _settle(nodes, pairs.where("NOT after AND NOT before").drop("after", "before"))
    rings = nodes.where("cyclic").select("conv_id").distinct()
    late = pairs.where("after AND NOT before").join(rings, "conv_id", "left_semi").drop("after", "before")
    return _settle(nodes, late).select(*KEY, F.when(~F.col("cyclic"), F.col("rank")).alias("rank"), "cyclic")


def argument_errors(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """conv_id, call_id, errors: sorted texts, none for arguments that fit their schema."""
    schemas = schemas.select("name", "parameter", "kind", "required").distinct()
    parsed = calls.select(*KEY, "name", F.try_parse_json("arguments").alias("v"))
    is_object = F.coalesce(F.schema_of_variant("v").startswith("OBJECT"), F.lit(False))
    broken = parsed.where(~is_object).select(*KEY, F.lit("malformed").alias("error"))
    fit = parsed.where(is_object)
    tools = schemas.select("name").distinct().withColumn("known", F.lit(True))
    strange = fit.join(tools, "name", "left").where("known is null").select(*KEY, F.lit("unknown tool").alias("error"))
    given = calls.sparkSession.sql(
        "SELECT conv_id, call_id, name, key AS parameter, schema_of_variant(value) AS type FROM {fit}, LATERAL variant_explode(v)",
        fit=fit)
    checked = given.join(tools, "name").join(schemas, ["name", "parameter"], "left")
    wrong = checked.select(*KEY, F.when(F.col("kind").isNull(), F.concat(F.lit("unexpected "), "parameter")).when(
        ~F.regexp_like("type", _kind_pattern()), F.concat(F.lit("type of "), "parameter")).alias("error")).where("error is not null")
    needed = fit.join(schemas.where("required"), "name").select(*KEY, "parameter")
    missing = needed.join(given.select(*KEY, "parameter"), [*KEY, "parameter"], "left_anti").select(
        *KEY, F.concat(F.lit("missing "), "parameter").alias("error"))
    found = broken.union(strange).union(wrong).union(missing)
    return found.groupBy(*KEY).agg(F.array_sort(F.collect_set("error")).alias("errors"))


def link(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per call id (and per result without a call): links, order, errors, canonical record."""
    c = stored(_earliest(calls, ["turn", "name", "arguments", "after"], "n_calls"), "calls")
    r = _earliest(results, ["turn", "content"], "n_results").withColumnRenamed("turn", "result_turn")
    wanted = c.select(*KEY, F.explode("after").alias("dep")).where("dep is not null").distinct()
    ids = c.select("conv_id", F.col("call_id").alias("dep"))
    edges = stored(wanted.join(ids, ["conv_id", "dep"]), "call-edges")
    unknown = wanted.join(ids, ["conv_id", "dep"], "left_anti").groupBy(*KEY).agg(
        F.array_sort(F.collect_set(F.concat(F.lit("unknown dependency "), "dep"))).alias("unknown"))
    joined = (c.join(r, KEY, "full").join(ranks(c, edges), KEY, "left").join(argument_errors(c, schemas), KEY, "left")
              .join(unknown, KEY, "left"))
    status = (F.when(F.col("n_calls").isNull(), "orphan").when(F.col("cyclic"), "cycle")
              .when(F.col("n_results").isNull(), "unanswered").otherwise("linked"))
    none = F.array().cast("array<string>")
    errors = F.array_sort(F.concat(F.coalesce("errors", none), F.coalesce("unknown", none)))
    record = F.to_json(F.struct(F.try_parse_json("arguments").alias("arguments"), "call_id", "name",
                                F.col("content").alias("result")), {"ignoreNullFields": "false"})
    linked = joined.select(
        *KEY, "turn", "result_turn", "name", status.alias("status"), F.col("rank.turn").alias("order_turn"),
        F.col("rank.steps").alias("order_steps"), F.array_join(errors, ", ").alias("errors"),
        F.coalesce("n_calls", F.lit(0)).alias("n_calls"), F.coalesce("n_results", F.lit(0)).alias("n_results"),
        record.alias("record"))
    empty = F.lit(None)
    lost = calls.where(F.col("conv_id").isNull() | F.col("call_id").isNull()).select(
        *KEY, "turn", empty.cast(linked.schema["result_turn"].dataType).alias("result_turn"), "name", F.lit("no id").alias("status"),
        empty.cast(linked.schema["order_turn"].dataType).alias("order_turn"), empty.cast("int").alias("order_steps"),
        F.lit("").alias("errors"), F.lit(1).cast("long").alias("n_calls"), F.lit(0).cast("long").alias("n_results"),
        empty.cast("string").alias("record")).distinct()
    return linked.union(lost)


# conversations as calls -------------------------------------------------------

SCHEMAS = (("search", "query", "string", True), ("search", "limit", "integer", True), ("search", "exact", "boolean", False),
           ("summarise", "query", "string", True), ("summarise", "limit", "integer", False),
           ("translate", "query", "string", True), ("translate", "limit", "integer", True))


def schema_table(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{name}', '{parameter}', '{kind}', {str(required).lower()})" for name, parameter, kind, required in SCHEMAS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(name, parameter, kind, required)")


def from_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of plain conversations: each user turn calls a tool, the assistant's next turn answers.

    The identifier is a digest of conversation and turn.  A call depends on
    the user turn before it; every eleventh waits for the one after it
    instead.  Some arguments break their schema, as model output does.
    """
    spark = turns.sparkSession
    ident = "md5(concat(conv_id, ':', {}))"
    forward = "pmod(conv_id + {}, 11) = 0"
    calls = spark.sql(f"""
        SELECT conv_id, turn, {ident.format('turn')} AS call_id,
               element_at(array('search', 'summarise', 'translate'), CAST(pmod(conv_id + turn, 3) + 1 AS INT)) AS name,
               CASE WHEN pmod(conv_id * 31 + turn, 29) = 0 THEN text
                    WHEN pmod(conv_id * 31 + turn, 19) = 0 THEN to_json(struct(char_length(text) % 20 AS limit))
                    WHEN pmod(conv_id * 31 + turn, 17) = 0 THEN to_json(struct(text AS query, 'many' AS limit))
                    ELSE to_json(struct(text AS query, char_length(text) % 20 AS limit)) END AS arguments,
               CASE WHEN {forward.format('turn')} THEN array({ident.format('turn + 2')})
                    WHEN {forward.format('turn - 2')} THEN array({ident.format('turn - 4')})
                    ELSE array({ident.format('turn - 2')}) END AS after
        FROM {{turns}} WHERE role = 'user'""", turns=turns)
    results = spark.sql(f"""SELECT conv_id, turn, {ident.format('turn - 1')} AS call_id, text AS content
                            FROM {{turns}} WHERE role = 'assistant'""", turns=turns)
    known = calls.select("conv_id", F.col("call_id").alias("dep"))
    linked = calls.select(*KEY, F.explode("after").alias("dep")).join(known, ["conv_id", "dep"]).groupBy(*KEY).agg(
        F.collect_set("dep").alias("after"))
    return calls.drop("after").join(linked, KEY, "left").select(*KEY, "turn", "name", "arguments", "after"), results


ORACLE = """
WITH RECURSIVE u AS (SELECT conv_id, turn, text, md5(conv_id || ':' || turn) AS call_id,
        ['search', 'summarise', 'translate'][(conv_id + turn) % 3 + 1] AS name, (conv_id * 31 + turn) AS k,
        CASE WHEN (conv_id + turn) % 11 = 0 THEN turn + 2 WHEN (conv_id + turn + 9) % 11 = 0 THEN turn - 4 ELSE turn - 2 END AS dep
    FROM conversations WHERE role = 'user'),
a AS (SELECT conv_id, turn, md5(conv_id || ':' || (turn - 1)) AS call_id, text FROM conversations WHERE role = 'assistant'),
e AS (SELECT u.conv_id, u.turn, u.dep FROM u JOIN u v ON u.conv_id = v.conv_id AND u.dep = v.turn),
reach(conv_id, turn, node, steps) AS (
    SELECT conv_id, turn, turn, 0 FROM u
    UNION ALL SELECT r.conv_id, r.turn, e.dep, r.steps + 1 FROM reach r JOIN e ON r.conv_id = e.conv_id AND r.node = e.turn),
latest AS (SELECT conv_id, turn, max(node) AS order_turn FROM reach GROUP BY ALL),
ranked AS (SELECT l.conv_id, l.turn, l.order_turn, max(r.steps) AS order_steps
           FROM latest l JOIN reach r ON l.conv_id = r.conv_id AND l.turn = r.turn
           JOIN latest m ON m.conv_id = r.conv_id AND m.turn = r.node AND m.order_turn = l.order_turn GROUP BY ALL),
c AS (SELECT u.*, CASE WHEN k % 29 = 0 THEN 'malformed' WHEN k % 19 = 0 THEN 'missing query'
                       WHEN k % 17 = 0 THEN 'type of limit' ELSE '' END AS errors,
             CASE WHEN k % 29 = 0 THEN 'null' WHEN k % 19 = 0 THEN '{"limit":' || (length(text) % 20) || '}'
                  WHEN k % 17 = 0 THEN '{"limit":"many","query":' || to_json(text) || '}'
                  ELSE '{"limit":' || (length(text) % 20) || ',"query":' || to_json(text) || '}' END AS arguments FROM u)
SELECT coalesce(c.conv_id, a.conv_id) AS conv_id, coalesce(c.call_id, a.call_id) AS call_id, c.turn, a.turn AS result_turn, c.name,
       CASE WHEN c.call_id IS NULL THEN 'orphan' WHEN a.call_id IS NULL THEN 'unanswered' ELSE 'linked' END AS status,
       r.order_turn, CAST(r.order_steps AS INTEGER) AS order_steps, coalesce(c.errors, '') AS errors,
       CAST(c.call_id IS NOT NULL AS BIGINT) AS n_calls, CAST(a.call_id IS NOT NULL AS BIGINT) AS n_results,
       '{"arguments":' || coalesce(c.arguments, 'null') || ',"call_id":"' || coalesce(c.call_id, a.call_id) || '","name":'
         || coalesce('"' || c.name || '"', 'null') || ',"result":' || coalesce(to_json(a.text), 'null') || '}' AS record
FROM c FULL JOIN a ON c.conv_id = a.conv_id AND c.call_id = a.call_id
LEFT JOIN ranked r ON r.conv_id = c.conv_id AND r.turn = c.turn
"""
