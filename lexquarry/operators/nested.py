"""Deeply nested JSON records to related flat tables.

Records arrive as JSON text and are read as VARIANT values. One merged schema is inferred over all of
them: a table of field patterns (``$.sections[].content``) with the kinds of values seen there, made by
partial aggregates and kept distributed; a field inside itself (``subsections[].subsections[]``) is one
pattern. The schema names the child tables: every pattern that holds an array of objects in any record, and
the declared ones. It also says which fields lead there, so that a lone object or a text in such a place is read as what the
schema has there. Objects are then opened level by level: their fields are joined with the schema, what
holds no object drops out, arrays are exploded into rows of their child table. Arrays of mixed values,
into which the schema does not see, are opened as well. Every row keeps the surrogate key of its parent, which is the path inside its record,
and its ordinal in the array. How deep records nest shows as they are opened.

Defined results for uneven input:

* a payload that is null, blank or not JSON, or whose root is no object or array: no rows;
* a leading byte order mark is ignored;
* an array of records: record ``i`` has the path ``$[i]``; elements that are no objects are skipped;
* a field that is missing or null, or has a scalar: no rows;
* a lone object in place of an array: element 0;
* an array or object delivered as JSON inside a string: as if delivered directly;
* null and scalar elements give no rows but keep their index;
* repeated payloads give rows under each ``record_id``;
* extra input columns are dropped, whatever their names are.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lexquarry.session import cut

BOM = "﻿"
LIST = "array<variant>"
OBJECT = "map<string,variant>"

#: Declared child tables by the pattern of their array; other arrays of objects are named after their field.
TABLES = {
    "$.sections[]": "section", "$.sections[].subsections[]": "subsection", "$.subsections[]": "subsection", "$.metadata.amendments[]": "amendment",
    "$.metadata.footnotes[]": "footnote", "$.metadata.heading_footnotes[]": "heading_footnote", "$.metadata.legal_status.changes[]": "status_change",
}
#: Levels opened in one plan, and the largest schema that is handed to every task.
STEPS, BROADCAST_ROWS = 4, 50_000


def _get(v: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(v, path, kind)


def _is_object(v: Column) -> Column:
    return _get(v, "$", OBJECT).isNotNull()


def _container(v: Column) -> Column:
    """The elements of an array or of a lone object; null for anything else."""
    return F.coalesce(_get(v, "$", LIST), F.when(_is_object(v), F.array(v)))


def _parsed(v: Column) -> Column:
    """What the JSON text in a string value holds; null if it holds none."""
    return F.try_parse_json(F.ltrim(F.regexp_replace(_get(v, "$", "string"), f"^{BOM}", "")))


def records(df: DataFrame, key: str = "record_id", payload: str = "payload") -> DataFrame:
    """(key, record_path, record): one row per record object."""
    text = F.regexp_replace(F.col(payload), f"^{BOM}", "")
    root = df.select(F.col(key), F.try_parse_json(text).alias("root")).where("root IS NOT NULL")
    many = _get(F.col("root"), "$", LIST)
    return (
        root.withColumn("many", many.isNotNull()).withColumn("items", F.coalesce(many, F.array("root")))
        .select(key, "many", F.posexplode("items").alias("i", "record"))
        .where(_is_object(F.col("record")))
        .select(key, F.when(F.col("many"), F.concat(F.lit("$["), "i", F.lit("]"))).otherwise("$").alias("record_path"), "record")
    )


def _parts(text: str) -> Iterator[tuple[str, str]]:
    """(name, type) of the fields between the angle brackets of an object's type."""
    depth, start, quoted, name = 0, 0, False, None
    for i, c in enumerate(text):
        if c == "`":
            quoted = not quoted
        elif quoted:
            continue
        elif c == "<":
            depth += 1
        elif c == ">":
            depth -= 1
        elif c == ":" and depth == 0 and name is None:
            name, start = text[start:i].strip().strip("`"), i + 1
        elif c == "," and depth == 0 and name is not None:
            yield name, text[start:i].strip()
            name, start = None, i + 1
    if name is not None:
        yield name, text[start:].strip()


def patterns_of(shape: str) -> Iterator[tuple[str, str]]:
    """(pattern, kind) of all fields of a value's type as Spark prints it; kinds are ``array``, ``object`` and scalar types."""
    todo = [("$", shape)]
    while todo:
        at, kind = todo.pop()
        if kind.startswith("OBJECT<"):
            yield at, "object"
            todo += [(collapsed(f"{at}.{name}"), t) for name, t in _parts(kind[7:-1])]
        elif kind.startswith("ARRAY<"):
            inner = kind[6:-1]
            if inner.startswith("OBJECT<") or inner == "VARIANT":
                yield f"{at}[]", "array"
            todo.append((f"{at}[]", inner))
        elif kind not in ("VOID", "OBJECT", "ARRAY", "VARIANT"):
            yield at, kind.lower()


def collapsed(pattern: str) -> str:
    """A pattern in which a field inside itself is written once."""
    *before, above, last = ["", *pattern.rsplit(".", 2)] if pattern.count(".") > 1 else ["", "", pattern]
    return ".".join([*filter(None, before), last]) if above == f"{last}[]" else pattern


def schema(recs: DataFrame, column: str = "record") -> DataFrame:
    """(pattern, kind, n_records): the merged schema of all records, one row per field pattern and kind."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(p, k, n) for shape, n in zip(batch.column("shape").to_pylist(), batch.column("n").to_pylist()) for p, k in set(patterns_of(shape))]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.int64())], ["pattern", "kind", "n"])

    shapes = recs.groupBy(F.schema_of_variant(column).alias("shape")).agg(F.count("*").alias("n"))
    return shapes.mapInArrow(split, "pattern string, kind string, n long").groupBy("pattern", "kind").agg(F.sum("n").alias("n_records"))


def ways(merged: DataFrame) -> DataFrame:
    """(pattern, kind): which field patterns are arrays that become tables (kind is the table), and which objects lead to one (kind is null)."""
    spark = merged.sparkSession
    declared = spark.createDataFrame(list(TABLES.items()), "pattern string, kind string")
    found = merged.where("kind = 'array'").select("pattern").distinct().join(declared.select("pattern"), "pattern", "left_anti")
    named = found.select("pattern", F.regexp_extract("pattern", r"([^.]+)\[\]$", 1).alias("kind"))
    arrays = declared.unionByName(named)
    steps = F.split(F.regexp_replace("pattern", r"\[\]$", ""), r"\.", -1)
    above = F.transform(F.sequence(F.lit(1), F.size(steps) - 1), lambda i: F.array_join(F.slice(steps, F.lit(1), i), "."))
    leading = arrays.select(F.explode(above).alias("pattern")).where("pattern <> '$' AND NOT pattern LIKE '%[]'").distinct().select("pattern", F.lit(None).cast("string").alias("kind"))
    return arrays.select(F.regexp_replace("pattern", r"\[\]$", "").alias("pattern"), "kind").unionByName(leading.join(arrays.select(F.regexp_replace("pattern", r"\[\]$", "").alias("pattern")), "pattern", "left_anti"))


def nodes(df: DataFrame, key: str = "record_id", payload: str = "payload") -> DataFrame:
    """(key, record_path, kind, pattern, level, node_path, parent_path, ord, node): one row per object of a child table.

    ``level`` counts the arrays around an object, itself included.
    """
    recs = cut(records(df, key, payload))
    leads = cut(ways(schema(recs)))
    # The schema has a row per array field; a schema of more than BROADCAST_ROWS is joined by exchange.
    leads = F.broadcast(leads) if leads.count() <= BROADCAST_ROWS else leads
    null = F.lit(None)
    level = recs.select(
        key, "record_path", null.cast("string").alias("kind"), F.lit("$").alias("pattern"), F.col("record_path").alias("path"), F.col("record_path").alias("parent_path"),
        F.lit(0).alias("level"), null.cast("int").alias("ord"), F.col("record").alias("node"), F.lit(True).alias("open"),
    )
    done = None
    while True:
        for _ in range(STEPS):
            level = _opened(level, leads, key)
        level = cut(level)
        part = level.where("NOT open AND kind IS NOT NULL").select(key, "record_path", "kind", "pattern", "level", F.col("path").alias("node_path"), "parent_path", "ord", "node")
        done = part if done is None else done.unionByName(part)
        level = level.where("open")
        if level.isEmpty():
            return done


def _opened(level: DataFrame, leads: DataFrame, key: str) -> DataFrame:
    """Replace each open row with itself, done, and the objects in its fields, open; rows that are done stay."""
    base = [key, "record_path"]
    itself = F.array(F.struct(F.lit(None).cast("string").alias("key"), F.col("node").alias("value")))
    entries = F.map_entries(_get(F.col("node"), "$", OBJECT))
    rows = level.withColumn("f", F.explode(F.when(F.col("open"), F.concat(itself, entries)).otherwise(itself))).withColumn("name", F.col("f.key"))
    rows = rows.withColumn("value", F.col("f.value")).withColumn("at", F.when(F.col("name").isNotNull(), _collapsed(F.col("pattern"), F.col("name"))))
    rows = rows.join(leads.select(F.col("pattern").alias("at"), F.col("kind").alias("table"), F.lit(True).alias("known")), "at", "left")
    # A container inside a string counts where the schema has one; each value is opened once.
    own = F.col("name").isNull()
    held = F.when(own | _is_object(F.col("value")) | _get(F.col("value"), "$", LIST).isNotNull(), F.col("value")).when(F.col("known"), _parsed(F.col("value")))
    rows = rows.withColumn("value", held).where(own | F.col("value").isNotNull())
    mixed = F.exists(_get(F.col("value"), "$", LIST), _is_object)
    rows = rows.withColumn("table", F.when(~own, F.coalesce("table", F.when(F.col("known").isNull() & mixed, F.regexp_extract("at", r"([^.]+)$", 1)))))
    objects = lambda items: F.filter(F.transform(items, lambda v, i: F.struct(i.alias("ord"), v.alias("node"))), lambda x: _is_object(x["node"]))
    alone = F.array(F.struct(F.lit(None).cast("int").alias("ord"), F.col("value").alias("node")))
    kids = F.when(own, F.array(F.struct("ord", "node"))).when(F.col("table").isNotNull(), objects(_container(F.col("value")))).when(_is_object(F.col("value")), alone)
    rows = rows.withColumn("x", F.explode(kids))
    array = F.col("table").isNotNull()
    place = F.concat("path", F.lit("."), "name", F.when(array, F.concat(F.lit("["), "x.ord", F.lit("]"))).otherwise(""))
    return rows.select(
        *base, F.when(own, F.col("kind")).otherwise(F.col("table")).alias("kind"), F.when(own, F.col("pattern")).when(array, F.concat("at", F.lit("[]"))).otherwise(F.col("at")).alias("pattern"),
        F.when(own, F.col("path")).otherwise(place).alias("path"),
        F.when(own | F.col("kind").isNull(), F.col("parent_path")).otherwise(F.col("path")).alias("parent_path"),
        F.when(own | ~array, F.col("level")).otherwise(F.col("level") + 1).alias("level"), "x.ord", "x.node", (~own).alias("open"),
    )


def _collapsed(pattern: Column, name: Column) -> Column:
    """The pattern of a field; inside an array of the same name it is that array's."""
    own = F.concat(F.lit("."), name, F.lit("[]"))
    return F.when(F.endswith(pattern, own), F.left(pattern, F.char_length(pattern) - 2)).otherwise(F.concat(pattern, F.lit("."), name))


def declared(all_nodes: DataFrame) -> DataFrame:
    """The rows of the declared tables, each with its nearest declared parent."""
    return all_nodes.where(F.col("pattern").isin(*TABLES))


#: Typed columns of the child tables: kind -> {column: (field, type)}.
COLUMNS: dict[str, dict[str, tuple[str, str]]] = {
    "section": {"section_number": ("section_number", "string"), "title": ("title", "string"), "content": ("content", "string")},
    "subsection": {"label": ("label", "string"), "content": ("content", "string")},
    "amendment": {"law": ("law", "string"), "law_date": ("date", "date"), "description": ("description", "string")},
    "footnote": {"note_number": ("number", "int"), "note_text": ("text", "string")},
    "heading_footnote": {"heading": ("heading", "string"), "note_number": ("number", "int"), "note_text": ("text", "string")},
    "status_change": {"effect": ("effect", "string"), "part_affected": ("part", "string"), "changed_by": ("by", "string"), "footnote": ("footnote", "int")},
}


def inferred_table(all_nodes: DataFrame, merged: DataFrame, kind: str, key: str = "record_id", most: int = 1000) -> DataFrame:
    """The flat table of any kind, with a column for every scalar field that the merged schema has for it.

    Column names come from the schema; a table has at most ``most`` of them. Fields of more than one
    scalar type are text; a name that is one of the link columns gets ``_`` behind it.
    """
    patterns = all_nodes.where(F.col("kind") == kind).select("pattern").distinct()
    fields = merged.where("kind NOT IN ('array', 'object')").withColumn("of", F.regexp_extract("pattern", r"^(.*)[.]([^.]+)$", 1)).withColumn("name", F.regexp_extract("pattern", r"([^.]+)$", 1))
    fields = fields.join(patterns.select(F.col("pattern").alias("of")), "of").where("NOT name LIKE '%[]'").groupBy("name").agg(F.collect_set("kind").alias("kinds")).orderBy("name").limit(most).collect()
    links = (key, "record_path", "node_path", "parent_path", "ord", "level")
    typed = [_get(F.col("node"), f"$['{r.name}']", r.kinds[0] if len(r.kinds) == 1 else "string").alias(f"{r.name}_" if r.name in links else r.name) for r in fields]
    return all_nodes.where(F.col("kind") == kind).select(*links, *typed)


def child_table(all_nodes: DataFrame, kind: str, key: str = "record_id") -> DataFrame:
    """The flat table of one declared kind: key, own and parent path, ordinal, level and typed columns."""
    typed = [_get(F.col("node"), f"$.{name}", t).alias(c) for c, (name, t) in COLUMNS[kind].items()]
    return declared(all_nodes).where(F.col("kind") == kind).select(key, "record_path", "node_path", "parent_path", "ord", "level", *typed)


def record_table(df: DataFrame, key: str = "record_id", payload: str = "payload") -> DataFrame:
    """The flat table of the records themselves."""
    get = lambda path, t: _get(F.col("record"), f"$.{path}", t)
    return records(df, key, payload).select(
        key, "record_path",
        F.when(get("article_number", "string").isNotNull(), "article").when(get("order_number", "string").isNotNull(), "order").otherwise("unknown").alias("record_kind"),
        get("order_number", "string").alias("order_number"), get("article_number", "int").alias("article_number"),
        get("title", "string").alias("title"), get("book", "string").alias("book"), get("title_name", "string").alias("title_name"),
        get("content", "string").alias("content"), get("metadata.legal_status.status", "string").alias("legal_status"),
    )
