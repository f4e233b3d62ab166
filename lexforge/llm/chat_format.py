"""Chat formatting with tool-call linking (DataFrame functions only).

Assistant turns carry calls as `<tool_call>{"id": ..., "name": ..., "arguments": {...}}</tool_call>`; turns of role `tool`
carry one result, `{"tool_call_id": ..., "content": ...}`. Calls and results are joined on (conversation, identifier) by
hash. Arguments are checked against schemas (required names, types, unknown names). Every turn becomes one canonical JSON
object (sorted keys, no white space) with its place in a topological order: a result comes after its call, all else as
given. Sorting by (order_turn, order_step, order_call, turn) gives that order, so no conversation has to be gathered in
one task; `conversations()` does so for those who want one string each.

Defined results: null roles and texts count as empty; text that is no JSON is kept as it is, and its calls are `malformed`;
an identifier used by several calls of one conversation belongs to the first (smallest turn, then place in the turn);
a result without call is an `orphan` and stays in its own place; several results of one call are all linked, in the order
of their turns; a call without result has `n_open` counted; repeated rows stay repeated; rows of one turn with different
texts each have the calls of their own text (an identifier they share is linked to the smallest place, then name); a null conv_id is a conversation;
an empty table gives no rows; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Schemas of the tools the query knows: argument -> type, a trailing ! for required ones.
SCHEMAS = {
    "search": {"query": "string!", "limit": "integer"},
    "calculator": {"expression": "string!"},
    "weather": {"city": "string!", "days": "integer", "metric": "boolean"},
}
CALL = r"(?s)<tool_call>(.*?)</tool_call>"
#: JSON types to the names that schema_of_variant gives (the beginnings of them).
KINDS = {"string": ("STRING",), "integer": ("BIGINT",), "number": ("BIGINT", "DECIMAL", "DOUBLE"), "boolean": ("BOOLEAN",), "object": ("OBJECT",), "array": ("ARRAY",), "null": ("VOID",)}


def canonical(text: Column) -> Column:
    """JSON text with sorted keys and without white space; null where it is no JSON."""
    return F.to_json(F.try_parse_json(text))


def _part(text: Column, path: str) -> Column:
    return F.try_variant_get(F.try_parse_json(text), path, "variant")


def valid_arguments(name: Column, arguments: Column, schemas: dict[str, dict[str, str]]) -> Column:
    """Whether the arguments (JSON text of an object) fit the schema of the tool; false for tools without schema."""
    names = F.coalesce(F.json_object_keys(arguments), F.array().cast("array<string>"))
    out = F.lit(False)
    for tool, fields in sorted(schemas.items()):
        known = list(fields)
        fits = F.forall(names, lambda k: k.isin(known))  # noqa: B023  used at once
        for field, kind in fields.items():
            got = F.schema_of_variant(F.try_variant_get(F.try_parse_json(arguments), f"$.{field}", "variant"))
            right = F.lit(False)
            for start in KINDS[kind.rstrip("!")]:
                right = right | got.startswith(start)
            fits = fits & F.when(F.array_contains(names, field), F.coalesce(right, F.lit(False))).otherwise(not kind.endswith("!"))
        out = F.when(name == tool, fits).otherwise(out)
    is_object = F.coalesce(F.schema_of_variant(F.try_parse_json(arguments)).startswith("OBJECT"), F.lit(False))
    return F.coalesce(is_object & out, F.lit(False))


def calls_of(turns: DataFrame, schemas: dict[str, dict[str, str]]) -> DataFrame:
    """One row per call: conv_id, turn, mark (of the text), place, call_id, name, arguments (canonical), valid, malformed."""
    found = turns.where(F.col("role") == "assistant").select("conv_id", "turn", "mark", F.posexplode(F.regexp_extract_all("text", F.lit(CALL), 1)).alias("place", "raw"))
    known = found.select(
        "conv_id", "turn", "mark", "place", _part(F.col("raw"), "$.id").cast("string").alias("call_id"), _part(F.col("raw"), "$.name").cast("string").alias("name"),
        F.to_json(_part(F.col("raw"), "$.arguments")).alias("arguments"), canonical(F.col("raw")).isNull().alias("malformed"),
    )
    return known.withColumn("valid", valid_arguments(F.col("name"), F.coalesce("arguments", F.lit("null")), schemas))


def formatted(turns: DataFrame, schemas: dict[str, dict[str, str]] = SCHEMAS) -> DataFrame:
    """One row per turn: conv_id, turn, role, the order columns, link, n_calls, n_valid, n_open, message."""
    t = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    t = t.withColumn("mark", F.xxhash64("text"))  # rows of one turn with different texts have their own calls
    tool = t.role == "tool"
    t = t.withColumn("result_id", F.when(tool, _part(F.col("text"), "$.tool_call_id").cast("string")))
    t = t.withColumn("result", F.when(tool, F.to_json(_part(F.col("text"), "$.content"))))

    calls = calls_of(t, schemas)
    first = calls.where("call_id IS NOT NULL").groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", "place", "name")).alias("call"))
    first = first.select(F.col("conv_id").alias("c"), "call_id", "call")
    answered = t.where("result_id IS NOT NULL").select(F.col("conv_id").alias("ac"), F.col("result_id").alias("ai")).distinct()
    # Calls of one turn, in order; an array is bounded by the calls in one text. Repeated rows have equal calls: sets of structs.
    mine = calls.join(answered, calls.conv_id.eqNullSafe(answered.ac) & (calls.call_id == answered.ai), "left").withColumn("open", answered.ai.isNull())
    json = F.concat(F.lit('{"arguments":'), F.coalesce("arguments", F.lit("null")), F.lit(',"id":'), _quoted("call_id"), F.lit(',"name":'), _quoted("name"), F.lit(',"valid":'), F.col("valid").cast("string"), F.lit("}"))
    of_turn = mine.withColumn("json", json).groupBy("conv_id", "turn", "mark").agg(F.sort_array(F.collect_set(F.struct("place", "call_id", "json", "valid", "open", "malformed"))).alias("calls"))
    of_turn = of_turn.select(F.col("conv_id").alias("oc"), F.col("turn").alias("ot"), F.col("mark").alias("om"), "calls")

    out = t.join(first, t.conv_id.eqNullSafe(first.c) & (t.result_id == first.call_id), "left")
    out = out.join(of_turn, out.conv_id.eqNullSafe(of_turn.oc) & out.turn.eqNullSafe(of_turn.ot) & (out.mark == of_turn.om) & (out.role == "assistant"), "left")
    linked = F.col("call").isNotNull()
    none = F.array().cast("array<struct<place:int,call_id:string,json:string,valid:boolean,open:boolean,malformed:boolean>>")
    calls_ = F.coalesce("calls", none)
    plain = F.trim(F.regexp_replace("text", CALL, ""))
    fields = F.concat(
        F.lit('{"content":'), F.when(F.col("role") == "tool", F.coalesce("result", _quoted("text"))).when(F.size(calls_) > 0, _quote(plain)).otherwise(_quoted("text")),
        F.lit(',"role":'), _quoted("role"),
        F.when(linked, F.concat(F.lit(',"tool":'), _quoted("call.name"), F.lit(',"tool_call_id":'), _quoted("result_id"))).otherwise(F.lit("")),
        F.when(F.size(calls_) > 0, F.concat(F.lit(',"tool_calls":['), F.array_join(F.transform(calls_, lambda c: c["json"]), ","), F.lit("]"))).otherwise(F.lit("")), F.lit("}"),
    )
    count = lambda test: F.size(F.filter(calls_, test))
    return out.select(
        "conv_id", "turn", "role",
        F.when(linked, F.greatest("turn", F.col("call.turn"))).otherwise(F.col("turn")).alias("order_turn"),
        F.when(linked & (F.col("call.turn") >= F.col("turn")), 1).otherwise(0).alias("order_step"),
        F.when(linked, F.col("call.place")).otherwise(-1).alias("order_call"),
        F.when(linked, "linked").when(F.col("role") == "tool", "orphan").when(F.size(calls_) > 0, "calls").otherwise("none").alias("link"),
        F.size(calls_).alias("n_calls"), count(lambda c: c["valid"]).alias("n_valid"), count(lambda c: c["open"]).alias("n_open"), count(lambda c: c["malformed"]).alias("n_malformed"), fields.alias("message"),
    )


def _quote(value: Column) -> Column:
    """A JSON string (or null)."""
    array = F.to_json(F.array(value))
    return F.coalesce(F.substring(array, F.lit(2), F.length(array) - 2), F.lit("null"))


def _quoted(name: str) -> Column:
    return _quote(F.col(name))


def conversations(turns: DataFrame, schemas: dict[str, dict[str, str]] = SCHEMAS) -> DataFrame:
    """conv_id, chat: one JSON array per conversation. Gathers each conversation, so use it where conversations are bounded."""
    rows = formatted(turns, schemas).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("order_turn", "order_step", "order_call", "turn", "message"))).alias("m"))
    return rows.select("conv_id", F.concat(F.lit("["), F.array_join(F.transform("m", lambda x: x["message"]), ","), F.lit("]")).alias("chat"))


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formatted(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
