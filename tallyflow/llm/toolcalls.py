"""Linking of tool calls with their results in conversations.

Calls and results are joined by identifier, arguments are checked against the
tools' schemas, calls are put into an order in which each comes after the calls
it takes results from, and every call is written as canonical JSON: keys sorted,
no blanks, characters as themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: The key by which an argument takes another call's result: `{"$from": "<call id>"}`.
REFERENCE = "$from"
_PARSED = "key long, canonical string, fields map<string,string>, refs array<string>, broken boolean"


def canonical(value) -> str:
    import json

    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def json_type(value) -> str:
    """The type of a parsed JSON value, in JSON Schema's words."""
    if isinstance(value, dict) and set(value) == {REFERENCE}:
        return "reference"
    for kinds, name in (
        (bool, "boolean"), (int, "integer"), (float, "number"), (str, "string"), (list, "array"), (dict, "object"),
    ):
        if isinstance(value, kinds):
            return name
    return "null"


def references(value) -> set[str]:
    """All call ids that a parsed value takes results from, at any depth."""
    found, open_ = set(), [value]
    while open_:
        one = open_.pop()
        if isinstance(one, dict):
            if json_type(one) == "reference" and isinstance(one[REFERENCE], str):
                found.add(one[REFERENCE])
            open_ += one.values()
        elif isinstance(one, list):
            open_ += one
    return found


def _no_constant(text: str):
    raise ValueError(f"{text} is not JSON")


def _finite(text: str) -> float:
    value = float(text)
    if value in (float("inf"), float("-inf")):
        raise ValueError(f"{text} is beyond what canonical JSON can write")
    return value


def _parse(batches: Iterator) -> Iterator:
    import json

    import pyarrow as pa

    for batch in common.partial_rows(batches, 2000):
        rows = []
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            try:
                value = json.loads(text or "{}", parse_constant=_no_constant, parse_float=_finite)
                if not isinstance(value, dict):
                    raise ValueError("arguments are an object")
                one = (key, canonical(value), [(k, json_type(v)) for k, v in value.items()], sorted(references(value)), False)
                one[1].encode()
            except (ValueError, RecursionError):
                one = (key, "null", [], [], True)
            rows.append(one)
        kinds = [pa.int64(), pa.string(), pa.map_(pa.string(), pa.string()), pa.list_(pa.string()), pa.bool_()]
        columns = list(zip(*rows)) or [[]] * 5
        names = ["key", "canonical", "fields", "refs", "broken"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def levels(edges: DataFrame) -> DataFrame:
    """`key`, `level` for every `key` of `edges` (`key` comes after `before`); a level of null: in or behind a circle.

    Each round settles the calls whose forerunners are all settled, one above the
    highest of them.  A key that is nobody's follower has level 0 and no row.
    There are as many rounds as the longest chain has calls.
    """
    left = common.stored(edges.select("key", "before").distinct(), "edges")
    settled = None
    level = 1
    while True:
        followers = left.select("key").distinct()
        waits = left.join(followers.withColumnRenamed("key", "before"), "before", "left_semi").select("key").distinct()
        free = common.stored(followers.join(waits, "key", "left_anti").select("key", F.lit(level).alias("level")), "level")
        if free.isEmpty():
            break
        settled = free if settled is None else settled.unionByName(free)
        left = common.stored(left.join(free.select("key"), "key", "left_anti"), "edges")
        level += 1
    stuck = left.select("key").distinct().withColumn("level", F.lit(None).cast("int"))
    return stuck if settled is None else settled.unionByName(stuck)


def link(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per call, with its place, checked arguments, result and canonical JSON.

    `calls`: `conv_id`, `turn`, `call_id`, `name`, `arguments` (JSON text);
    `results`: `conv_id`, `turn`, `call_id`, `content`; `schemas`: `tool`,
    `field`, `type`, `required`, one row per field.

    Columns: `conv_id`, `turn`, `call_id`, `name`, `level`, `position` (from 0 in
    the conversation, by turn, level and id), `arguments` (canonical),
    `problems`, `result_turn`, `result`, `record` (canonical JSON).

    An id belongs to the first call that has it (by turn, then name and
    arguments); the others, exact repeats included, have the problem `repeated
    id` and no result.  Of several results a call gets the first by turn and
    text.  A result must not come before its call; results without a call are
    in `orphans`.  Problems: `no id`, `repeated id`, `broken arguments`, `unknown
    tool`, `missing F`, `wrong type of F`, `unknown field F`, `unknown reference
    R` (also to a later turn), `circular reference`, `no result`.  References to
    calls of earlier turns hold by the order of turns; those inside a turn give
    the levels.  A number that no double holds (`1e999`) breaks its arguments.  An empty argument text is an empty object; a null conversation
    or id links nothing.  An empty table of calls gives no rows.
    """
    calls = common.stored(
        calls.select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.col("turn").cast("long").alias("turn"),
            F.col("call_id").cast("string").alias("call_id"),
            F.col("name").cast("string").alias("name"),
            F.col("arguments").cast("string").alias("text"),
        ).withColumn("key", F.monotonically_increasing_id()),
        "calls",
    )
    parsed = calls.select("key", "text").mapInArrow(_parse, _PARSED)
    rows = common.stored(calls.join(parsed, "key").drop("text"), "parsed")
    known = rows.where("conv_id is not null and call_id is not null")
    owners = known.groupBy("conv_id", "call_id").agg(
        F.min(F.struct("turn", "name", "canonical", "key")).alias("o")
    ).select("conv_id", "call_id", F.col("o.key").alias("owner"), F.col("o.turn").alias("owner_turn"))
    owners = common.stored(owners, "owners")

    # Arguments against the schema of their tool: one row per tool, however many fields.
    tools = schemas.where("tool is not null and field is not null").groupBy("tool").agg(
        F.collect_set(F.struct("field", "type", F.coalesce("required", F.lit(False)).alias("required"))).alias("schema")
    )
    checked = rows.select("key", "name", "fields", "broken").join(tools, F.col("name") == F.col("tool"), "left")
    fits = (
        "f.type is null or fields[f.field] = f.type or fields[f.field] = 'reference'"
        " or f.type = 'number' and fields[f.field] = 'integer'"
    )
    faults = F.expr(
        "case when broken then array('broken arguments') when tool is null then array('unknown tool') else concat("
        "transform(filter(schema, f -> f.required and not map_contains_key(fields, f.field)), f -> concat('missing ', f.field)),"
        f"transform(filter(schema, f -> map_contains_key(fields, f.field) and not ({fits})), f -> concat('wrong type of ', f.field)),"
        "transform(filter(map_keys(fields), k -> not exists(schema, f -> f.field = k)), k -> concat('unknown field ', k))) end"
    )
    checked = checked.select("key", F.array_sort(faults).alias("faults"))

    # References: inside a turn they order calls, to earlier turns they hold anyway.
    refs = known.select("key", "conv_id", "turn", F.explode("refs").alias("ref")).join(
        owners.withColumnRenamed("call_id", "ref"), ["conv_id", "ref"], "left"
    )
    refs = common.stored(refs.withColumn("lost", F.expr("owner is null or coalesce(owner_turn > turn, false)")), "refs")
    lost = refs.where("lost").groupBy("key").agg(F.array_sort(F.collect_set(F.concat(F.lit("unknown reference "), "ref"))).alias("lost"))
    level = levels(refs.where("not lost and owner_turn <=> turn").select("key", F.col("owner").alias("before")))

    # Hash join of results and calls by identifier.
    answers = results.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("result_turn"),
        F.col("call_id").cast("string").alias("call_id"),
        F.col("content").cast("string").alias("result"),
    )
    answers = answers.join(owners, ["conv_id", "call_id"]).where("result_turn is null or owner_turn is null or result_turn >= owner_turn")
    answers = answers.groupBy(F.col("owner").alias("key")).agg(
        F.min(F.struct(F.col("result_turn").isNull().alias("n"), "result_turn", "result")).alias("a")
    ).select("key", F.col("a.result_turn").alias("result_turn"), F.col("a.result").alias("result"), F.lit(True).alias("answered"))

    found = (
        rows.select("key", "conv_id", "turn", "call_id", "name", "canonical")
        .join(owners.select(F.col("owner").alias("key"), F.lit(True).alias("owns")), "key", "left")
        .join(checked, "key", "left")
        .join(lost, "key", "left")
        .join(level.select("key", "level", F.lit(True).alias("follows")), "key", "left")
        .join(answers, "key", "left")
    )
    circular = F.col("follows").isNotNull() & F.col("level").isNull()
    own = F.when(F.col("call_id").isNull() | F.col("conv_id").isNull(), F.array(F.lit("no id"))).when(
        F.col("owns").isNull(), F.array(F.lit("repeated id"))
    )
    none = F.array().cast("array<string>")
    problems = F.concat(
        F.coalesce(own, none),
        F.coalesce("faults", none),
        F.coalesce("lost", none),
        F.when(circular, F.array(F.lit("circular reference"))).otherwise(none),
        F.when(own.isNull() & F.col("answered").isNull(), F.array(F.lit("no result"))).otherwise(none),
    )
    found = found.select(
        "key", "conv_id", "turn", "call_id", "name",
        F.when(~circular, F.coalesce("level", F.lit(0))).alias("level"),
        F.col("canonical").alias("arguments"), problems.alias("problems"), "result_turn", "result",
    ).withColumn("_last", F.coalesce("level", F.lit((1 << 31) - 1)))
    placed = common.dense_positions(common.stored(found, "linked"), ["conv_id"], ["turn", "_last", "call_id", "key"], "position")
    return placed.select(
        "conv_id", "turn", "call_id", "name", "level", "position", "arguments", "problems", "result_turn", "result",
        record().alias("record"),
    )


def record():
    """The canonical JSON of a linked call; the keys are in order, and strings are escaped as JSON."""
    text = lambda c: f"coalesce(regexp_replace(to_json(struct({c} as x)), '^\\\\{{\"x\":|\\\\}}$', ''), 'null')"
    quoted = lambda c: f"if({c} is null, 'null', {text(c)})"
    return F.expr(
        "concat('{\"arguments\":', arguments, ',\"id\":', " + quoted("call_id") + ", ',\"name\":', " + quoted("name")
        + ", ',\"result\":', " + quoted("result") + ", ',\"turn\":', coalesce(cast(turn as string), 'null'), '}')"
    )


def orphans(calls: DataFrame, results: DataFrame) -> DataFrame:
    """The rows of `results` for whose id the conversation has no call."""
    conv, call = common.unused(results, "_conv"), common.unused(results, "_call")
    made = calls.select(F.col("conv_id").alias(conv), F.col("call_id").alias(call)).distinct()
    return results.join(made, (F.col("conv_id") == F.col(conv)) & (F.col("call_id") == F.col(call)), "left_anti")
