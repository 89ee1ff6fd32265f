"""Chat formatting: tool calls linked to results, ordered, checked and serialised.

Messages ``(conv_id, turn, role, text)`` may carry tool calls and results as JSON:

- a call: ``{"tool_call": {"id": ..., "name": ..., "arguments": {...}}}``; an argument
  value ``{"$result": "<call id>"}`` depends on that call's result;
- a result: ``{"tool_result": {"id": ..., "content": ...}}``.

**Linking** hash-joins calls and results by (conversation, identifier). **Ordering** is
topological over the dependencies, by distributed peeling: a round gives the level of
every call whose dependencies have theirs, so rounds follow the longest chain, not the
number of messages; what no round reaches is on a cycle or behind one. **Validation**
checks the arguments against the tool's schema (required and known names, types,
enumerations, number ranges, text lengths, array items). **Serialisation** writes each
linked call as canonical JSON: names sorted by code point, no spaces, numbers in one
form.

Results are rows, one per call and one per result without a call; no conversation is
gathered into one value or task.

Edge cases: null texts and texts that are no JSON object of these forms are ordinary
messages. A call without identifier or name is ``malformed``, and so is a call or result
nested deeper than ``MAX_DEPTH``, kept as the text it is. Numbers may have any length and
count by value. Half of a surrogate pair, which no UTF-8 text can hold, is written as its
escape. Of several calls (results)
with one identifier in a conversation the first by turn, then by content, counts; others
are ``duplicate``. A result before its call's turn still links and is marked ``early``. A
dependency on an unknown identifier is ``dangling``. Null conversation ids are one
conversation. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator, Mapping
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch

#: Lists and objects within one another up to which a call or result is read; deeper ones
#: are malformed.
MAX_DEPTH = 200

_NUMBER = re.compile(r"(-?)(\d+)(?:\.(\d+))?(?:[eE]([+-]?\d+))?$")
_BRACKETS = re.compile(r'"(?:[^"\\]|\\.)*"?|[\[\]{}]', re.DOTALL)
_FORM = re.compile(r'\s*\{\s*"tool_(?:call|result)"\s*:')
_SURROGATE = re.compile("[\ud800-\udfff]")


def _exact(token: str) -> tuple[str, str, int]:
    """``(sign, digits, exponent)`` of a JSON number, digits without zeros at either end."""
    sign, whole, part, power = _NUMBER.match(token).groups()
    part = part or ""
    digits = (whole + part).lstrip("0")
    short = digits.rstrip("0")
    # An exponent of more digits than any size can have is as good as its sign.
    power = max(-(10**18), min(10**18, int(power[:20]))) if power else 0
    return (sign, short, power - len(part) + len(digits) - len(short)) if short else ("", "", 0)


class Number:
    """A JSON number, of any length: equal values have one ``text``."""

    def __init__(self, token: str):
        self.key = sign, digits, power = _exact(token)
        point = len(digits) + power
        if not digits:
            self.text = "0"
        elif 0 < point <= 21:
            self.text = sign + (digits + "0" * power if power >= 0 else f"{digits[:point]}.{digits[point:]}")
        elif -6 < point <= 0:
            self.text = f"{sign}0.{'0' * -point}{digits}"
        else:
            self.text = f"{sign}{digits[0]}{'.' + digits[1:] if len(digits) > 1 else ''}e{point - 1:+d}"

    @property
    def integral(self) -> bool:
        return self.key[2] >= 0

    def compare(self, other: float) -> int:
        """-1, 0 or 1 against a bound of a schema, exactly."""
        if math.isinf(other):
            return -1 if other > 0 else 1
        a, b = self.key, _exact(format(Decimal(other), "f") if isinstance(other, float) else str(other))
        if a == b:
            return 0

        def order(k: tuple[str, str, int]) -> tuple:
            # By sign, then place of the first digit, then digits.
            return (0, 0, "") if not k[1] else (1, len(k[1]) + k[2], k[1])

        side = lambda k: 0 if not k[1] else -1 if k[0] else 1
        if side(a) != side(b):
            return -1 if side(a) < side(b) else 1
        less = order(a) < order(b)
        return (-1 if less else 1) * side(a)


_TYPES = {
    "string": lambda v: isinstance(v, str),
    "integer": lambda v: isinstance(v, Number) and v.integral,
    "number": lambda v: isinstance(v, Number),
    "boolean": lambda v: isinstance(v, bool),
    "null": lambda v: v is None,
    "array": lambda v: isinstance(v, list),
    "object": lambda v: isinstance(v, dict),
}


def read_json(text: str):
    """The value of a JSON text, numbers as :class:`Number`; ValueError if it is none or nested
    deeper than ``MAX_DEPTH``. ``NaN`` and infinities are null."""
    depth = 0
    if text.count("[") + text.count("{") > MAX_DEPTH:
        for m in _BRACKETS.finditer(text):
            depth += {"[": 1, "{": 1, "]": -1, "}": -1}.get(m.group()[0], 0)
            if depth > MAX_DEPTH:
                raise ValueError("nested too deep")
    return json.loads(text, parse_int=Number, parse_float=Number, parse_constant=lambda _: None)


def plain_text(text: str) -> str:
    """``text`` as UTF-8 can hold it: half a surrogate pair as its escape."""
    return _SURROGATE.sub(lambda m: f"\\u{ord(m.group()):04x}", text)


def canonical_json(value) -> str:
    """One text for equal values: names sorted by code point, no spaces, numbers by value
    (whole ones up to 21 digits without a point or exponent), half a surrogate pair as its escape."""
    if isinstance(value, Number):
        return value.text
    if isinstance(value, dict):
        return "{" + ",".join(f"{canonical_json(k)}:{canonical_json(value[k])}" for k in sorted(value)) + "}"
    if isinstance(value, list):
        return "[" + ",".join([canonical_json(x) for x in value]) + "]"
    if isinstance(value, float) and not math.isfinite(value):
        return "null"
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return Number(repr(value)).text
    return plain_text(json.dumps(value, ensure_ascii=False))


def _of_python(value):
    """A value of a schema with its numbers as :class:`Number`."""
    return read_json(json.dumps(value))


def schema_errors(value, schema: Mapping, path: str = "$") -> list[str]:
    """What in ``value`` (of :func:`read_json`) breaks ``schema`` (a subset of JSON Schema);
    references to results stand for any value."""
    if isinstance(value, dict) and set(value) == {"$result"}:
        return []
    errors = []
    kinds = schema.get("type")
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_TYPES[k](value) for k in kinds):
        return [f"{path}: not {' or '.join(kinds)}"]
    if "enum" in schema and canonical_json(value) not in {canonical_json(_of_python(x)) for x in schema["enum"]}:
        errors.append(f"{path}: not one of the values")
    if isinstance(value, Number):
        if value.compare(schema.get("minimum", -math.inf)) < 0 or value.compare(schema.get("maximum", math.inf)) > 0:
            errors.append(f"{path}: out of range")
    if isinstance(value, str) and not schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", math.inf):
        errors.append(f"{path}: length")
    if isinstance(value, dict):
        props = schema.get("properties", {})
        errors += [f"{path}.{k}: missing" for k in sorted(schema.get("required", ())) if k not in value]
        for k in sorted(value):
            if k in props:
                errors += schema_errors(value[k], props[k], f"{path}.{k}")
            elif schema.get("additionalProperties") is False:
                errors.append(f"{path}.{k}: unknown")
    if isinstance(value, list) and "items" in schema:
        for i, x in enumerate(value):
            errors += schema_errors(x, schema["items"], f"{path}[{i}]")
    return errors


def _references(value) -> set[str]:
    if isinstance(value, dict):
        if set(value) == {"$result"}:
            to = value["$result"]
            return {plain_text(to) if isinstance(to, str) else canonical_json(to)}
        return set().union(*[_references(v) for v in value.values()])
    if isinstance(value, list):
        return set().union(*[_references(v) for v in value])
    return set()


def _parse(tools: Mapping[str, Mapping]):
    """(conv_id, turn, kind, id, name, body, refs, errors) of messages that carry a call
    or a result."""
    names = ["conv_id", "turn", "kind", "id", "name", "body", "refs", "errors"]
    types = [pa.int64(), pa.int64(), *[pa.string()] * 4, *[pa.list_(pa.string())] * 2]

    def one(text: str) -> tuple | None:
        try:
            value = read_json(text)
        except ValueError:
            # A call or result that cannot be read is kept, as the text it is.
            deep = _FORM.match(text) and text.count("[") + text.count("{") > MAX_DEPTH
            return ("malformed", None, None, canonical_json(text), [], ["nested too deep"]) if deep else None
        if not isinstance(value, dict) or len(value) != 1:
            return None
        if isinstance(call := value.get("tool_call"), dict):
            ident, name, args = call.get("id"), call.get("name"), call.get("arguments", {})
            if not isinstance(ident, str) or not isinstance(name, str):
                return "malformed", None, None, canonical_json(call), [], ["malformed call"]
            errors = schema_errors(args, tools[name]) if name in tools else ["unknown tool"]
            errors = [plain_text(x) for x in errors]
            return "call", plain_text(ident), plain_text(name), canonical_json(args), sorted(_references(args)), errors
        if isinstance(result := value.get("tool_result"), dict):
            ident = result.get("id")
            if not isinstance(ident, str):
                return "malformed", None, None, canonical_json(result), [], ["malformed result"]
            return "result", plain_text(ident), None, canonical_json(result.get("content")), [], []
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv, turn, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                # Only such texts can be one of the forms; the rest is not parsed.
                if text and '"tool_' in text and (got := one(text)):
                    rows.append((conv, turn, *got))
            cols = list(zip(*rows)) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    return run


_PARSED = (
    "conv_id long, turn long, kind string, id string, name string, body string, refs array<string>, errors array<string>"
)


def _levels(calls: DataFrame, work) -> DataFrame:
    """``(conv_id, id, level)``: 0 without dependencies, else one more than the highest of
    them. Calls on or behind a cycle, or with a dangling dependency, have none."""
    edges = work.table(
        calls.select("conv_id", "id", F.explode("refs").alias("dep")).distinct(), "edges"
    )
    done = work.table(
        calls.where(F.size("refs") == 0).select("conv_id", "id", F.lit(0).alias("level")), "level"
    )
    fresh, level = done, 0
    while True:
        level += 1
        # An edge whose dependency has its level is settled; a call with no open edge
        # left gets the next level, as its last dependency came in the round before.
        settled = edges.join(
            fresh.select(F.col("conv_id").alias("c"), F.col("id").alias("d")),
            F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("dep") == F.col("d")),
            "left",
        )
        open_ = work.table(settled.where("d is null").select("conv_id", "id", "dep"), "open")
        touched = settled.where("d is not null").select("conv_id", "id").distinct()
        blocked = open_.select(F.col("conv_id").alias("c"), F.col("id").alias("i")).distinct()
        ready = touched.join(
            blocked, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("id") == F.col("i")), "left_anti"
        )
        fresh = work.table(ready.select("conv_id", "id", F.lit(level).alias("level")), "level")
        if fresh.isEmpty():
            return done
        done = done.union(fresh)
        edges = open_


def link_tool_calls(messages: DataFrame, tools: Mapping[str, Mapping]) -> DataFrame:
    """One row per call, and per result that has no call:

    ``(conv_id, id, status, turn, result_turn, level, valid, errors, json)``. ``status``:
    ``linked``, ``early``, ``unanswered``, ``dangling``, ``cyclic``, ``duplicate``,
    ``malformed`` or ``orphan`` (a result without call). ``json`` is canonical.
    ``level`` orders calls topologically; ties go by turn, then identifier."""
    spark = messages.sparkSession
    with scratch(spark, "chat") as work:
        rows = messages.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("text"))
        parsed = work.table(rows.mapInArrow(_parse(dict(tools)), _PARSED), "parsed")
        rank = F.row_number().over(
            Window.partitionBy("conv_id", "kind", "id").orderBy(F.col("turn").asc_nulls_last(), "body", "name")
        )
        good = work.table(parsed.where("kind <> 'malformed'").withColumn("n", rank), "good")
        calls = good.where("kind = 'call' and n = 1")
        results = good.where("kind = 'result' and n = 1").select(
            F.col("conv_id").alias("rc"), F.col("id").alias("ri"), F.col("turn").alias("result_turn"),
            F.col("body").alias("content"),
        )
        same = F.col("conv_id").eqNullSafe(F.col("rc")) & (F.col("id") == F.col("ri"))
        levels = _levels(calls, work).select(F.col("conv_id").alias("lc"), F.col("id").alias("li"), "level")
        known = calls.select(F.col("conv_id").alias("kc"), F.col("id").alias("ki"))
        missing = (
            calls.select("conv_id", "id", F.explode("refs").alias("dep"))
            .join(known, F.col("conv_id").eqNullSafe(F.col("kc")) & (F.col("dep") == F.col("ki")), "left_anti")
            .select(F.col("conv_id").alias("mc"), F.col("id").alias("mi"))
            .distinct()
        )
        linked = (
            calls.join(results, same, "left")
            .join(levels, F.col("conv_id").eqNullSafe(F.col("lc")) & (F.col("id") == F.col("li")), "left")
            .join(missing, F.col("conv_id").eqNullSafe(F.col("mc")) & (F.col("id") == F.col("mi")), "left")
        )
        status = (
            F.when(F.col("mi").isNotNull(), "dangling")
            .when(F.col("level").isNull(), "cyclic")
            .when(F.col("ri").isNull(), "unanswered")
            .when(F.col("result_turn") < F.col("turn"), "early")
            .otherwise("linked")
        )
        # Bodies are canonical JSON already; names come in code-point order.
        quoted = lambda c: F.regexp_extract(F.to_json(F.struct(F.col(c).alias("v"))), r'(?s)^\{"v":(.*)\}$', 1)
        body = F.concat(
            F.lit('{"arguments":'), F.col("body"), F.lit(',"id":'), quoted("id"), F.lit(',"name":'), quoted("name"),
            F.lit(',"result":'), F.coalesce("content", F.lit("null")), F.lit("}"),
        )
        nothing = F.array().cast("array<string>")
        columns = ["conv_id", "id", "status", "turn", "result_turn", "level", "valid", "errors", "json"]
        out = linked.withColumns({"status": status, "valid": F.size("errors") == 0, "json": body}).select(*columns)
        none = {"result_turn": F.lit(None).cast("long"), "level": F.lit(None).cast("int")}
        called = calls.select(F.col("conv_id").alias("cc"), F.col("id").alias("ci"))
        orphans = (
            good.where("kind = 'result' and n = 1")
            .join(called, F.col("conv_id").eqNullSafe(F.col("cc")) & (F.col("id") == F.col("ci")), "left_anti")
            .withColumns(
                {
                    "status": F.lit("orphan"), **none, "result_turn": F.col("turn"), "turn": F.lit(None).cast("long"),
                    "valid": F.lit(False), "errors": nothing, "json": F.col("body"),
                }
            )
        )
        spare = good.where("n > 1").withColumns(
            {"status": F.lit("duplicate"), **none, "valid": F.lit(False), "json": F.col("body")}
        )
        bad = parsed.where("kind = 'malformed'").withColumns(
            {"status": F.lit("malformed"), **none, "valid": F.lit(False), "json": F.col("body")}
        )
        return out.union(orphans.select(*columns)).union(spare.select(*columns)).union(bad.select(*columns))


# ---------------------------------------------------------------- a corpus without calls

#: Schema of the tool that ``as_tool_messages`` calls.
ANSWER_TOOL = {
    "type": "object",
    "properties": {
        "question": {"type": "string", "minLength": 1},
        "words": {"type": "integer", "minimum": 1, "maximum": 100},
        "context": {"type": ["object", "null"]},
    },
    "required": ["question", "words"],
    "additionalProperties": False,
}


def as_tool_messages(messages: DataFrame) -> DataFrame:
    """Plain conversations as tool messages, so that they can be linked: a user's turn
    becomes a call of the tool ``answer`` (identifier: its turn), an assistant's turn the
    result of the call one turn before, other roles stay ordinary messages. The ``k``-th
    pair of turns depends on pair ``k // 2``, so chains are short in long conversations."""
    pair = F.floor(F.col("turn") / 2).cast("long")
    parent = F.floor(pair / 2).cast("long")
    # The user's turn of a pair has the parity of the conversation's own user turns.
    odd = F.col("turn") % 2
    before = (parent * 2 + odd).cast("string")
    context = F.when(pair > parent, F.struct(F.concat(F.lit("call-"), before).alias("$result")))
    words = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))
    ident = lambda t: F.concat(F.lit("call-"), t.cast("string"))
    call = F.struct(
        F.struct(
            ident(F.col("turn")).alias("id"),
            F.lit("answer").alias("name"),
            F.struct(F.coalesce("text", F.lit("")).alias("question"), words.alias("words"), context.alias("context")).alias("arguments"),
        ).alias("tool_call")
    )
    result = F.struct(
        F.struct(ident(F.col("turn") - 1).alias("id"), F.coalesce("text", F.lit("")).alias("content")).alias("tool_result")
    )
    text = (
        F.when(F.col("role") == "user", F.to_json(call))
        .when(F.col("role") == "assistant", F.to_json(result))
        .otherwise(F.col("text"))
    )
    return messages.select("conv_id", "turn", "role", text.alias("text"))
