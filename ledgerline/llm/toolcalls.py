"""Chat formatting of tool calls: linked to their results, validated, in topological order, as canonical JSON."""

from __future__ import annotations

import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.arrays import arrow_schema
from ledgerline.llm.store import stored

_BLOCK = re.compile(r"<tool_(call|result)>(.*?)</tool_\1>", re.S)
_KINDS = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


def canonical_json(value) -> str:
    """Sorted keys, no spaces, whole floats as integers, characters unescaped; raises ValueError for NaN and infinity."""

    def plain(x):
        if isinstance(x, dict):
            return {str(k): plain(v) for k, v in x.items()}
        if isinstance(x, list):
            return [plain(v) for v in x]
        return int(x) if isinstance(x, float) and x.is_integer() else x

    return json.dumps(plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def _parsed(text: str | None):
    """(value, fault) of JSON text: nesting beyond Python's limit, numbers of thousands of digits and lone surrogates are faults."""
    if text is None:
        return None, "$: no JSON"
    try:
        value = json.loads(text)
        canonical_json(value).encode()
    except UnicodeEncodeError:
        return None, "$: not Unicode"
    except RecursionError:
        return None, "$: nested too deeply"
    except ValueError as error:
        return None, "$: no JSON" if isinstance(error, json.JSONDecodeError) else "$: not a JSON number"
    return value, None


def _is(kind: str, value) -> bool:
    number = isinstance(value, (int, float)) and not isinstance(value, bool)
    if kind == "integer":
        return number and (isinstance(value, int) or value.is_integer())
    return number if kind == "number" else isinstance(value, _KINDS[kind])


def fault(value, schema: dict, at: str = "$") -> str | None:
    """The first place where a value breaks a JSON schema (type or list of types, enum, required, properties,
    additionalProperties, items, minLength, maxLength, minimum, maximum), or None."""
    kind = schema.get("type", [])
    kinds = [kind] if isinstance(kind, str) else kind
    number = _is("number", value)
    if kinds and not any(_is(k, value) for k in kinds):
        return f"{at}: not of type {' or '.join(kinds)}"
    if "enum" in schema and value not in schema["enum"]:
        return f"{at}: not in enum"
    size = len(value) if isinstance(value, str) else None
    if size is not None and not schema.get("minLength", 0) <= size <= schema.get("maxLength", size):
        return f"{at}: length {size}"
    if number and not schema.get("minimum", value) <= value <= schema.get("maximum", value):
        return f"{at}: out of range"
    if isinstance(value, dict):
        own = schema.get("properties", {})
        for name in schema.get("required", []):
            if name not in value:
                return f"{at}.{name}: missing"
        for name in sorted(value):
            if name in own:
                if bad := fault(value[name], own[name], f"{at}.{name}"):
                    return bad
            elif schema.get("additionalProperties") is False:
                return f"{at}.{name}: unknown"
    if isinstance(value, list) and "items" in schema:
        for k, x in enumerate(value):
            if bad := fault(x, schema["items"], f"{at}[{k}]"):
                return bad
    return None


def _text(value) -> str | None:
    """A string that can be encoded, else None."""
    try:
        return value if isinstance(value, str) and value.encode() is not None else None
    except UnicodeEncodeError:
        return None


def _written(block: dict, name: str) -> str | None:
    """A member as ASCII JSON; NULL where it is missing or nested beyond what can be written."""
    try:
        return json.dumps(block[name]) if name in block else None
    except (RecursionError, ValueError):
        return None


def blocks(messages: DataFrame) -> DataFrame:
    """Calls and results written in messages (conv_id, turn, text) as <tool_call>{...}</tool_call> and <tool_result>{...}
    </tool_result>: (conv_id, kind, call_id, position, name, arguments, depends_on, content). position is turn * 2**20 and the
    block's number. A block that is no JSON object with a string id, or whose id, arguments or content cannot be written as
    canonical JSON (lone surrogates, NaN, very deep nesting), keeps what can be written: null in the place of the rest. Null
    texts have no block."""
    schema = "conv_id long, kind string, call_id string, position long, name string, arguments string, depends_on array<string>, content string"
    kinds = arrow_schema(schema)

    def run(batches):
        for batch in batches:
            rows = []
            for conv, turn, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                for k, m in enumerate(_BLOCK.finditer(text or "")):
                    try:
                        x = json.loads(m[2])
                    except (ValueError, RecursionError):
                        x = None
                    x = x if isinstance(x, dict) and _text(x.get("id")) is not None else {}
                    after = x.get("depends_on")
                    rows.append(
                        {
                            "conv_id": conv, "kind": m[1], "call_id": x.get("id"), "position": (turn or 0) * (1 << 20) + k,
                            "name": _text(x.get("name")),
                            "arguments": _written(x, "arguments"),
                            "depends_on": [d for d in after if _text(d) is not None] if isinstance(after, list) else [],
                            "content": _written(x, "content"),
                        }
                    )
            yield pa.RecordBatch.from_pylist(rows, kinds)

    return messages.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def ordered(calls: DataFrame) -> DataFrame:
    """calls (conv_id, call_id, position, depends_on) with order_at and order_step: sorted by these, then by position, every call
    follows all calls of its conversation that it depends on. Calls on a cycle get order_step -1.

    Transcript order is kept where it can be: order_at is the largest position among a call and everything that it depends on,
    so it only differs for calls written before one of their dependencies, and for what depends on these. Only such calls are
    iterated over; the rounds follow their longest chain, not the conversation. Calls with the same order_at are peeled by
    dependency. Dependencies on unknown or null ids are ignored.
    """
    keys = ["conv_id", "call_id"]
    base = calls.select(*keys, "position", F.explode("depends_on").alias("dep_id")).join(
        calls.select("conv_id", F.col("call_id").alias("dep_id"), F.col("position").alias("dep_position")), ["conv_id", "dep_id"]
    )
    edges = stored(base.distinct(), "dependencies")
    moved = stored(
        edges.where("dep_position >= position").groupBy(*keys).agg(F.max("dep_position").alias("at")), "moved"
    )
    grown = moved
    while not grown.isEmpty():
        own = moved.withColumnRenamed("at", "own_at")
        dep = grown.select("conv_id", F.col("call_id").alias("dep_id"), F.col("at").alias("dep_at"))
        further = edges.join(dep, ["conv_id", "dep_id"]).groupBy(*keys, "position").agg(F.max("dep_at").alias("at"))
        grown = stored(
            further.join(own, keys, "left").where("at > coalesce(own_at, position)").select(*keys, "at"), "moved"
        )
        both = moved.unionByName(grown).groupBy(*keys).agg(F.max("at").alias("at"))
        moved = stored(both, "moved") if not grown.isEmpty() else moved
    placed = calls.join(moved, keys, "left").withColumn("order_at", F.coalesce("at", "position")).drop("at")
    if moved.isEmpty():
        return placed.withColumn("order_step", F.lit(0))
    own = moved.select(*keys, F.col("at").alias("own_at"))
    dep = moved.select("conv_id", F.col("call_id").alias("dep_id"), F.col("at").alias("dep_at"))
    ties = edges.join(own, keys, "left").join(dep, ["conv_id", "dep_id"], "left")
    left = stored(ties.where("coalesce(own_at, position) = coalesce(dep_at, dep_position)").select(*keys, "dep_id"), "ties")
    nodes = stored(left.select(*keys).union(left.select("conv_id", "dep_id")).distinct(), "nodes")
    steps, turn = None, 0
    while True:
        ready = stored(nodes.join(left, keys, "left_anti").withColumn("order_step", F.lit(turn)), "ready")
        if ready.isEmpty():
            break
        steps, turn = ready if steps is None else steps.unionByName(ready), turn + 1
        nodes = stored(nodes.join(ready, keys, "left_anti"), "nodes")
        left = stored(left.join(ready.select("conv_id", F.col("call_id").alias("dep_id")), ["conv_id", "dep_id"], "left_anti"), "ties")
    stuck = nodes.withColumn("order_step", F.lit(-1))
    steps = stuck if steps is None else steps.unionByName(stuck)
    return placed.join(stored(steps, "steps"), keys, "left").withColumn("order_step", F.coalesce("order_step", F.lit(0)))


def linked_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per call identifier, and one per result or call that found no place: (conv_id, call_id, position, order_at,
    order_step, status, record).

    calls: (conv_id, call_id, position, name, arguments JSON, depends_on); results: (conv_id, call_id, position, content JSON).
    Both are joined by conversation and identifier, so a long conversation is spread over tasks. Of calls that repeat an
    identifier the first by position, then name, arguments and dependencies, counts, and so for results by position and content;
    the others are rows with the status repeated call or repeated result (equal ones once), and a result without a call has the
    status no call. Rows with a null conversation, identifier or position cannot be linked or ordered and are left out.
    status of a call: ok, no result, invalid: place (arguments against schemas[name], an unknown tool, or JSON that cannot be
    read or written), or cycle. record is the canonical JSON of arguments, id, name, result and status, without values that are
    missing or cannot be written.
    """
    keys, no_ids = ["conv_id", "call_id"], F.array().cast("array<string>")
    whole = "conv_id is not null and call_id is not null and position is not null"
    said = calls.where(whole).select(*keys, F.struct("position", "name", "arguments", F.coalesce("depends_on", no_ids).alias("depends_on")).alias("c"))
    heard = results.where(whole).select(*keys, F.struct("position", "content").alias("c"))
    firsts, others = [], []
    for rows, name in ((said, "call"), (heard, "result")):
        found = stored(rows.groupBy(*keys).agg(F.min("c").alias("c"), F.max("c").alias("last")), f"{name}s")
        firsts.append(found.select(*keys, "c.*"))
        # Few identifiers repeat, so only their rows are read again; a frequent one is split by the join.
        again = found.where("c < last").select(*keys, F.col("c").alias("first"))
        others.append(rows.join(again, keys).where("c <> first").drop("first").distinct().select(*keys, "c.*", F.lit(f"repeated {name}").alias("known")))
    first = firsts[1].select(*keys, F.col("position").alias("heard_at"), "content")
    one = firsts[0].withColumn("is_call", F.lit(True))
    rows = ordered(one).join(first, keys, "full_outer")
    late = F.coalesce("position", "heard_at")
    rows = rows.withColumns({"known": F.when(F.col("is_call").isNull(), F.lit("no call")), "position": late, "order_at": F.coalesce("order_at", late)})
    rows = rows.withColumn("order_step", F.coalesce("order_step", F.lit(0)))
    for extra in others:
        rows = rows.unionByName(extra.withColumns({"order_at": F.col("position"), "order_step": F.lit(0)}), allowMissingColumns=True)
    schema = "conv_id long, call_id string, position long, order_at long, order_step int, status string, record string"
    kinds = arrow_schema(schema)

    def judged(r: dict) -> tuple[str, str]:
        arguments, bad = _parsed(r["arguments"])
        result, torn = _parsed(r["content"])
        if r["known"]:
            status = r["known"]
        elif r["order_step"] < 0:
            status = "cycle"
        else:
            if bad is None:
                bad = fault(arguments, schemas[r["name"]]) if r["name"] in schemas else "$: unknown tool"
            if bad is None and r["content"] is not None and torn:
                bad = f"result {torn}"
            status = f"invalid: {bad}" if bad else "ok" if r["content"] is not None else "no result"
        record = {"id": r["call_id"], "name": r["name"], "arguments": arguments, "result": result, "status": status}
        return status, canonical_json({k: v for k, v in record.items() if v is not None})

    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                status, text = judged(r)
                out.append({k: r[k] for k in ("conv_id", "call_id", "position", "order_at", "order_step")} | {"status": status, "record": text})
            yield pa.RecordBatch.from_pylist(out, kinds)

    named = ["call_id", "name", "arguments", "content", "known"]
    return rows.select(F.col("conv_id").cast("long"), "position", "order_at", F.col("order_step").cast("int"), *named).mapInArrow(run, schema)
