"""Draft-07 schemas over VARIANT records; every violation is a row.

All keywords of a schema are evaluated in one pass over the records, in Arrow batches: references may lead
back to themselves to any depth, which no fixed set of columns can follow.
"""

from __future__ import annotations

import datetime as dt
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

_TYPES = {"string": str, "boolean": bool, "array": list, "object": dict, "null": type(None)}
URI = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*:\S+")


def schema_kind(record: Column) -> Column:
    """Which schema a record falls under, by the field it has."""
    has = lambda f: F.try_variant_get(record, f"$.{f}", "variant").isNotNull()
    return F.when(has("order_number"), "order").when(has("article_number"), "article").when(has("question"), "question")


def _is(value, name: str) -> bool:
    if name in ("integer", "number"):
        number = isinstance(value, (int, float)) and not isinstance(value, bool)
        return number and (name == "number" or float(value).is_integer())
    return isinstance(value, _TYPES[name])


def _is_date(text: str) -> bool:
    try:
        return len(text) == 10 and bool(dt.date.fromisoformat(text))
    except ValueError:
        return False


class Rules:
    """A schema and what its keywords say about a value."""

    def __init__(self, schema: dict):
        self.schema = schema
        self.target = lru_cache(None)(self._target)

    def _target(self, ref: str) -> dict:
        at = self.schema
        for part in ref.lstrip("#/").split("/"):
            at = at[part] if part else at
        return at

    def errors(self, value, schema: dict | None = None, path: str = "$") -> Iterator[tuple[str, str]]:
        """(path, message) of every violation; elements of arrays have ``[]`` in their paths."""
        todo = [(value, self.schema if schema is None else schema, path)]
        while todo:
            v, s, at = todo.pop()
            while "$ref" in s:
                s = self.target(s["$ref"])
            yield from ((at, message) for message in self._broken(v, s))
            if isinstance(v, dict):
                todo += [(v[k], sub, f"{at}.{k}") for k, sub in s.get("properties", {}).items() if k in v]
            if isinstance(v, list) and isinstance(s.get("items"), dict):
                todo += [(x, s["items"], f"{at}[]") for x in v]

    @staticmethod
    def _broken(v, s: dict) -> Iterator[str]:
        if "type" in s:
            kinds = [s["type"]] if isinstance(s["type"], str) else s["type"]
            if not any(_is(v, k) for k in kinds):
                yield f"is not of type {'/'.join(kinds)}"
        if "enum" in s and not any(v == e and type(v) is type(e) for e in s["enum"]):
            yield "is not one of the allowed values"
        if "const" in s and not (v == s["const"] and type(v) is type(s["const"])):
            yield "is not the constant"
        if isinstance(v, str):
            if "pattern" in s and not re.search(s["pattern"], v):
                yield "does not match its pattern"
            if s.get("format") == "date" and not _is_date(v):
                yield "is not a date"
            if s.get("format") == "uri" and not URI.fullmatch(v):
                yield "is not a URI"
        if "minimum" in s and _is(v, "number") and v < s["minimum"]:
            yield "is below its minimum"
        if isinstance(v, list) and len(v) < s.get("minItems", 0):
            yield "has too few items"
        if isinstance(v, dict):
            yield from (f"lacks {name}" for name in s.get("required", []) if name not in v)
            if s.get("additionalProperties") is False and (extra := sorted(set(v) - set(s.get("properties", {})))):
                yield f"has unknown fields {','.join(extra)}"


def errors(records: DataFrame, schema: dict, key: list[str], record: str = "record") -> DataFrame:
    """(key…, path, message) of every violation; null records have none."""
    text = json.dumps(schema)
    made: dict[str, Rules] = {}
    types = ", ".join(f"`{k}` {records.schema[k].dataType.simpleString()}" for k in key)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = made.get("r") or made.setdefault("r", Rules(json.loads(text)))
        for batch in batches:
            at, paths, messages = [], [], []
            for i, value in enumerate(batch.column(len(key)).to_pylist()):
                for path, message in rules.errors(json.loads(value)):
                    at.append(i)
                    paths.append(path)
                    messages.append(message)
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(pa.array(at, pa.int64())) for k in range(len(key))), pa.array(paths, pa.string()), pa.array(messages, pa.string())], [*key, "path", "message"])

    rows = records.where(F.col(record).isNotNull()).select(*key, F.to_json(record).alias("_json"))
    return rows.mapInArrow(work, f"{types}, path string, message string")


def counts(found: DataFrame, kind: str = "message") -> DataFrame:
    """(kind, n): how often each kind of problem occurs."""
    return found.groupBy(F.col(kind).alias("kind")).agg(F.count("*").alias("n"))
