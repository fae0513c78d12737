"""Chat formatting with tool-call linking.

Assistant turns hold calls as <tool_call>{"id", "name", "arguments"}</tool_call>;
turns of role "tool" hold {"tool_call_id", "content"}. Calls and results meet by
a hash join on conversation and identifier. Within a conversation the messages
are put in topological order (a result follows its call, a call follows the
calls that its arguments name as {"$ref": id}), arguments are checked against
the tool's schema, and the whole is serialised as canonical JSON.
"""

from __future__ import annotations

import heapq
import json
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import as_batch, by_arrow

_CALL = re.compile(r"<tool_call>(.*?)</tool_call>", re.S)
#: Levels of arrays and objects that a call or result may have.
DEPTH = 100
_KINDS = {"string": str, "boolean": bool, "object": dict, "array": list, "null": type(None)}


def canonical(value) -> str:  # noqa: ANN001
    """JSON with sorted keys and without spaces, UTF-8 kept; whole floats are written as integers.

    ValueError for what JSON or UTF-8 can't hold, non-finite numbers and lone surrogates, and for more than DEPTH levels.
    """
    if _deep(value):
        raise ValueError("nested too deeply")

    def plain(x):  # noqa: ANN001, ANN202
        if isinstance(x, float):
            if not math.isfinite(x):
                raise ValueError("a number isn't finite")
            return int(x) if x.is_integer() and abs(x) < 1 << 53 else x
        if isinstance(x, dict):
            return {k: plain(v) for k, v in x.items()}
        return [plain(v) for v in x] if isinstance(x, list) else x

    out = json.dumps(plain(value), ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    out.encode()  # UnicodeEncodeError is a ValueError
    return out


def _deep(value) -> bool:  # noqa: ANN001
    """Whether a value has more than DEPTH levels."""
    layer = [value]
    for _ in range(DEPTH):
        layer = [v for x in layer if isinstance(x, dict | list) for v in (x.values() if isinstance(x, dict) else x)]
    return any(isinstance(x, dict | list) for x in layer)


def parsed(text: str):  # noqa: ANN201
    """The JSON value that a text holds, if canonical() can write it; else None."""
    try:
        value = json.loads(text)
        canonical(value)
    except (ValueError, RecursionError):
        return None
    return value


def identifier(value) -> str | None:  # noqa: ANN001
    """An identifier as a string: other values by their canonical JSON, null is none."""
    return value if value is None or isinstance(value, str) else canonical(value)


def violations(value, schema: dict, at: str = "$") -> list[str]:  # noqa: ANN001
    """What is wrong with a value under a JSON schema of type, enum, required, properties, additionalProperties, items, minimum and maximum."""
    out = []
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    number = isinstance(value, int | float) and not isinstance(value, bool)
    fits = {"number": True, "integer": isinstance(value, int) or value.is_integer()} if number else {}
    if isinstance(value, dict) and set(value) == {"$ref"}:
        return []  # another call's result, not known yet
    if kinds and not any(fits.get(k, k in _KINDS and isinstance(value, _KINDS[k])) for k in kinds):
        return [f"{at}: not of type {' or '.join(kinds)}"]
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{at}: not one of the allowed values")
    if number and value < schema.get("minimum", -math.inf):
        out.append(f"{at}: under the minimum")
    if number and value > schema.get("maximum", math.inf):
        out.append(f"{at}: over the maximum")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        for k, v in value.items():
            if k in known:
                out += violations(v, known[k], f"{at}.{k}")
            elif schema.get("additionalProperties", True) is False:
                out.append(f"{at}.{k}: not allowed")
    if isinstance(value, list) and "items" in schema:
        for i, v in enumerate(value):
            out += violations(v, schema["items"], f"{at}[{i}]")
    return out


def _references(value) -> Iterator[str]:  # noqa: ANN001
    if isinstance(value, dict):
        if set(value) == {"$ref"}:
            yield identifier(value["$ref"])
        for v in value.values():
            yield from _references(v)
    elif isinstance(value, list):
        for v in value:
            yield from _references(v)


def _calls(text: str) -> tuple[str, list[dict]]:
    """The text without its calls, and the calls; what isn't a JSON object with a name, or can't be written again, stays text."""
    found = []

    def take(m: re.Match) -> str:
        call = parsed(m[1])
        if not isinstance(call, dict) or not isinstance(call.get("name"), str):
            return m[0]
        found.append({"id": identifier(call.get("id")), "name": call["name"], "arguments": call.get("arguments", {})})
        return ""

    return _CALL.sub(take, text), found


def ordered(messages: list[dict]) -> list[int]:
    """A topological order of messages with "id" and "after" (ids): the earliest that is free comes first; of a cycle, when nothing is free, its earliest."""
    where: dict[str, int] = {}
    for i, m in enumerate(messages):
        for x in m.get("ids", ()):
            where.setdefault(x, i)
    waits = [{where[x] for x in m.get("after", ()) if x in where and where[x] != i} for i, m in enumerate(messages)]
    follow: dict[int, list[int]] = {}
    for i, w in enumerate(waits):
        for j in w:
            follow.setdefault(j, []).append(i)
    free = [i for i, w in enumerate(waits) if not w]
    heapq.heapify(free)
    out, done = [], set()
    rest = iter(range(len(messages)))
    while len(out) < len(messages):
        if not free:  # a cycle: its earliest message goes first
            free.append(next(i for i in rest if i not in done))
        i = heapq.heappop(free)
        if i in done:
            continue
        done.add(i)
        out.append(i)
        for j in follow.get(i, ()):
            waits[j].discard(i)
            if not waits[j] and j not in done:
                heapq.heappush(free, j)
    return out


def _formatted(turns: list[dict], links: dict[str, tuple[int, str]], schemas: dict[str, dict]) -> dict:
    messages, calls, problems, linked = [], 0, [], 0
    for t in turns:
        role, text = t["role"] or "", t["text"] or ""
        if role == "tool" and t["call_id"] is not None:
            known = links.get(t["call_id"])
            linked += known is not None
            if known is None:
                problems.append(f"{t['call_id']}: result without a call")
            messages.append({"out": {"role": role, "content": t["content"], "tool_call_id": t["call_id"]} | ({"name": known[1]} if known else {}), "after": [t["call_id"]] if known else []})
            continue
        content, found = _calls(text) if role == "assistant" else (text, [])
        message = {"role": role, "content": content}
        if found:
            message["tool_calls"] = found
        for c in found:
            calls += 1
            if c["name"] not in schemas:
                if schemas:
                    problems.append(f"{c['id']}: unknown tool {c['name']}")
            else:
                problems += [f"{c['id']}: {x}" for x in violations(c["arguments"], schemas[c["name"]])]
        messages.append({"out": message, "ids": [c["id"] for c in found if c["id"] is not None], "after": [r for c in found for r in _references(c["arguments"])]})
    return {"text": canonical([messages[i]["out"] for i in ordered(messages)]), "n_calls": calls, "n_linked": linked, "problems": problems}


def format_chats(conversations: DataFrame, schemas: dict[str, dict] | None = None, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, n_turns, n_calls, n_linked, problems array<string>, text): each conversation as canonical JSON.

    Turns are in order of turn, then role and text, nulls first; repeated rows
    repeat. Null roles and texts count as empty. A repeated call identifier belongs to its
    earliest turn. Identifiers of conversations keep their type, numbers or texts. Turns with a null conversation form one; an empty table gives no rows. Calls and results that
    aren't JSON, hold a number that isn't finite, a lone surrogate or more than DEPTH levels stay plain text.
    Without schemas nothing is checked. Conversations are one row each by contract, so a task holds a whole one, however
    long its turns. Other columns are not read.
    """
    known, kind = schemas or {}, conversations.schema[id_col].dataType.simpleString()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            call_ids, names, result_ids, contents = [], [], [], []
            for role, text in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                found = _calls(text)[1] if role == "assistant" and text and "<tool_call>" in text else []
                call_ids.append([c["id"] for c in found if c["id"] is not None])
                names.append([c["name"] for c in found if c["id"] is not None])
                result = parsed(text) if role == "tool" and text else None
                result = result if isinstance(result, dict) and result.get("tool_call_id") is not None else None
                result_ids.append(identifier(result["tool_call_id"]) if result else None)
                content = result.get("content", "") if result else None
                contents.append(content if content is None or isinstance(content, str) else canonical(content))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(call_ids, pa.list_(pa.string())), pa.array(names, pa.list_(pa.string())), pa.array(result_ids, pa.string()), pa.array(contents, pa.string())], names=["conv", "turn", "role", "text", "ids", "names", "call_id", "content"])

    rows = conversations.select(F.col(id_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    turns = by_arrow(rows, split, f"conv {kind}, turn long, role string, text string, ids array<string>, names array<string>, call_id string, content string")
    calls = turns.where("size(ids) > 0").select("conv", "turn", F.explode(F.arrays_zip("ids", "names")).alias("c")).groupBy("conv", F.col("c.ids").alias("call_id")).agg(F.min(F.struct("turn", "c.names")).alias("call"))
    results = turns.where("call_id is not null").select("conv", "call_id").distinct()
    both = results.join(calls, results.conv.eqNullSafe(calls.conv) & (results.call_id == calls.call_id)).select(results.conv, results.call_id, F.col("call.turn").alias("at"), F.col("call.names").alias("name"))
    links = both.groupBy("conv").agg(F.collect_list(F.struct("call_id", "at", "name")).alias("links"))
    gathered = turns.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", "call_id", "content"))).alias("turns"))
    whole = gathered.join(links.withColumnRenamed("conv", "link_conv"), F.col("conv").eqNullSafe(F.col("link_conv")), "left").select("conv", "turns", "links")

    def serialise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [_formatted(turns, {x["call_id"]: (x["at"], x["name"]) for x in links or ()}, known) for turns, links in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield as_batch({
                "conv_id": batch.column(0),
                "n_turns": pa.array([len(t) for t in batch.column(1).to_pylist()], pa.int64()),
                "n_calls": pa.array([x["n_calls"] for x in out], pa.int64()),
                "n_linked": pa.array([x["n_linked"] for x in out], pa.int64()),
                "problems": pa.array([x["problems"] for x in out], pa.list_(pa.string())),
                "text": pa.array([x["text"] for x in out], pa.string()),
            })

    return by_arrow(whole, serialise, f"conv_id {kind}, n_turns long, n_calls long, n_linked long, problems array<string>, text string")
