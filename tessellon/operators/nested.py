"""Deeply nested JSON records to related flat tables, by shared inlining.

The schema is a graph of elements. An element gets a table of its own if it repeats, is reached from
more than one parent, or is recursive; every other element is inlined in the row of its nearest ancestor
with a table. Every row has an identifier within its record (the path of fields and positions that leads to
it), and names its parent by it; rows of a child table also carry their parent's position and their own.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessellon.session import Scratch


@dataclass(frozen=True)
class Edge:
    """``parent`` holds ``child`` under the field ``name``; ``kind`` is what a row of the child is called."""

    parent: str
    name: str
    child: str
    repeated: bool = False
    kind: str = ""
    json_text: bool = False  # a string in place of the array holds it as JSON text


@dataclass
class SchemaGraph:
    root: str
    edges: list[Edge] = field(default_factory=list)

    def parents(self, child: str) -> list[Edge]:
        return [e for e in self.edges if e.child == child]

    def children(self, parent: str) -> list[Edge]:
        return [e for e in self.edges if e.parent == parent]

    def elements(self) -> list[str]:
        return list(dict.fromkeys([self.root, *[x for e in self.edges for x in (e.parent, e.child)]]))

    def recursive(self) -> set[str]:
        """Elements that can hold themselves."""
        reach = {x: {e.child for e in self.children(x)} for x in self.elements()}
        for k in reach:
            for i in reach:
                if k in reach[i]:
                    reach[i] |= reach[k]
        return {x for x in reach if x in reach[x]}

    def tables(self) -> list[str]:
        """The root and all repeated, shared or recursive elements, parents first."""
        own = {self.root, *self.recursive(), *(e.child for e in self.edges if e.repeated)}
        own |= {x for x in self.elements() if len({e.parent for e in self.parents(x)}) > 1}
        return [x for x in self.elements() if x in own]

    def inlined(self, element: str) -> list[tuple[str, str]]:
        """(JSON path, column) of all leaves inlined in a table's row."""
        found, own = [], set(self.tables())

        def walk(at: str, path: str, column: str) -> None:
            for e in self.children(at):
                if e.child not in own:
                    p, c = f"{path}.{e.name}", f"{column}_{e.name}" if column else e.name
                    if self.children(e.child):
                        walk(e.child, p, c)
                    else:
                        found.append((p, c))

        walk(element, "$", "")
        return found


def parsed(spark: SparkSession, json: str) -> Column:
    """A text column as a variant, null where it is not JSON. Of the values of a repeated key the last holds."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")  # else an object with a repeated key counts as invalid
    return F.try_parse_json(json)


def _kind(v: Column) -> Column:
    """OBJECT, ARRAY, STRING, ...; VOID for JSON null."""
    s = F.schema_of_variant(v)
    return F.when(s.startswith("ARRAY"), "ARRAY").when(s.startswith("OBJECT"), "OBJECT").otherwise(s)


def as_list(v: Column) -> Column:
    """The elements of a variant as an array of variants. A single value or object stands for an array of
    one; null and a missing field give null."""
    kind = F.schema_of_variant(v)
    return F.when(kind.startswith("ARRAY"), F.try_variant_get(v, "$", "array<variant>")).when(kind != "VOID", F.array(v))


def opened(v: Column) -> Column:
    """A string as the JSON it holds; text that is not JSON, and all other values, stay as they are."""
    return F.when(F.schema_of_variant(v) == "STRING", F.coalesce(F.try_parse_json(F.try_variant_get(v, "$", "string")), v)).otherwise(v)


#: Levels of a recursive graph between two looks at the data.
STEP = 16
_ROW = "struct<id: string, parent_id: string, element: string, parent_kind: string, parent_pos: int, pos: int, kind: string, v: variant, open: boolean>"


def _row_of(e: Edge, element: str):
    def row(v: Column, i: Column) -> Column:
        return F.struct(
            F.concat(F.col("x.id"), F.lit(f"/{e.name}/"), i.cast("string")).alias("id"), F.col("x.id").alias("parent_id"), F.lit(e.child).alias("element"), F.lit(element).alias("parent_kind"), F.col("x.pos").alias("parent_pos"), i.alias("pos"), F.lit(e.kind or e.child).alias("kind"), v.alias("v"), F.lit(True).alias("open")
        )

    return row


def shred_rows(df: DataFrame, key: str, json: str, graph: SchemaGraph) -> DataFrame:
    """_key and x (id, parent_id, element, parent_kind, parent_pos, pos, kind, v): the rows of all tables, records included, in one pass.

    Each record is parsed once; a level of the graph unfolds the rows of the level before beside themselves.
    """
    record = F.struct(F.lit("").alias("id"), F.lit(None).cast("string").alias("parent_id"), F.lit(graph.root).alias("element"), F.lit(None).cast("string").alias("parent_kind"), F.lit(-1).alias("parent_pos"), F.lit(-1).alias("pos"), F.lit(graph.root).alias("kind"), parsed(df.sparkSession, json).alias("v"), F.lit(True).alias("open"))
    rows = df.select(F.col(key).alias("_key"), record.alias("x")).where("x.v IS NOT NULL")
    holders = {x for x in graph.tables() if _held(graph, x)}
    at, scratch = {graph.root}, Scratch(df.sparkSession, "shred") if graph.recursive() else None
    for level in itertools.count(1):
        held = [(element, e) for element in sorted(at & holders) for e in _held(graph, element)]
        if not held:
            break
        # one projection a step, so that no variant is taken apart twice
        mine = lambda element: F.col("x.open") & (F.col("x.element") == element)
        names = [f"_e{i}" for i in range(len(held))]
        rows = rows.select("_key", "x", *[F.when(mine(element), F.try_variant_get("x.v", f"$.{e.name}", "variant")).alias(n) for n, (element, e) in zip(names, held)])
        rows = rows.select("_key", "x", *[(opened(F.col(n)) if e.json_text else F.col(n)).alias(n) for n, (_, e) in zip(names, held)])
        rows = rows.select("_key", "x", *[as_list(F.col(n)).alias(n) for n in names])
        lists = [F.coalesce(F.filter(F.transform(n, _row_of(e, element)), lambda r: F.schema_of_variant(r["v"]) != "VOID"), F.array().cast(f"array<{_ROW}>")) for n, (element, e) in zip(names, held)]
        itself = F.array(F.col("x").withField("open", F.lit(False)).cast(_ROW))
        rows = rows.select("_key", F.explode(F.concat(itself, *lists)).alias("x"))
        at = {e.child for _, e in held}
        if scratch and level % STEP == 0:  # the data say how deep a recursive element goes
            rows = scratch.write(rows, f"level_{level}")
            if rows.where(F.col("x.open") & F.col("x.element").isin(*holders)).isEmpty():
                break
    return rows


def shred(df: DataFrame, key: str, json: str, graph: SchemaGraph, scratch: Scratch | None = None) -> dict[str, DataFrame]:
    """One table per element of ``graph.tables()``.

    The root's table: the key and the inlined leaves as text. Every other table, and the root's if records can hold
    records: the key, ``row_id`` (path within the record, '' for the record itself), ``parent_id`` (the parent's row_id),
    ``parent_kind`` (element that holds the row), ``parent_pos`` (place of the parent among its own siblings, -1 for
    the record), ``pos`` (place in the array, nulls counted), ``kind``, ``value`` (text, of a scalar) and the
    inlined leaves. Null gives no row. Rows whose JSON is null or invalid give none; columns other than the
    two are ignored, so clashing names do no harm. Recursive elements are followed as deep as they go.

    With ``scratch`` the records are parsed once and all tables read from the rows written, a folder per element;
    without it each table that is read parses them anew.
    """
    rows, out = shred_rows(df, key, json, graph), {}
    if scratch is not None:
        wanted = ["id", "parent_id", "element", "parent_kind", "parent_pos", "pos", "kind", "v"]
        rows = scratch.write(rows.select("_key", *[F.col(f"x.{c}").alias(c) for c in wanted]), "rows", by="element")
        rows = rows.select("_key", "element", F.struct(*wanted).alias("x"))
    else:
        rows = rows.withColumn("element", F.col("x.element"))
    for element in graph.tables():
        leaves = [F.try_variant_get("x.v", p, "string").alias(c) for p, c in graph.inlined(element)]
        mine = rows.where(F.col("element") == element)
        if element == graph.root and element not in graph.recursive():
            out[element] = mine.select(F.col("_key").alias(key), *leaves)
        else:
            value = F.when(~F.schema_of_variant("x.v").startswith("OBJECT"), F.try_variant_get("x.v", "$", "string")).alias("value")
            out[element] = mine.select(F.col("_key").alias(key), F.col("x.id").alias("row_id"), "x.parent_id", "x.parent_kind", "x.parent_pos", "x.pos", "x.kind", value, *leaves)
    return out


def _held(graph: SchemaGraph, element: str) -> list[Edge]:
    """Edges to the children of ``element`` that have tables; inlined objects are passed through."""
    own, found = set(graph.tables()), []
    for e in graph.children(element):
        if e.child in own:
            found.append(e)
        else:
            found += [Edge(element, f"{e.name}.{x.name}", x.child, x.repeated, x.kind, x.json_text) for x in _held(graph, e.child)]
    return found


#: The compendium record in its current and its legacy shape.
COMPENDIUM = SchemaGraph(
    "record",
    [
        Edge("record", "ic", "ic", kind="ic"),
        Edge("record", "preferred_name", "preferred_name"),
        Edge("record", "id", "legacy_id"),
        Edge("legacy_id", "identifier", "legacy_identifier"),
        Edge("legacy_id", "label", "legacy_label"),
        Edge("record", "type", "type", True, "record_type"),
        Edge("record", "taxa", "taxon", True, "record_taxon"),
        Edge("record", "descriptions", "description", True, "record_description"),
        Edge("record", "identifiers", "identifier", True, "identifier", json_text=True),
        Edge("record", "equivalent_identifiers", "identifier", True, "identifier", json_text=True),
        Edge("identifier", "i", "i"),
        Edge("identifier", "identifier", "identifier_name"),
        Edge("identifier", "l", "l"),
        Edge("identifier", "label", "label"),
        Edge("identifier", "d", "description", True, "description"),
        Edge("identifier", "t", "taxon", True, "taxon"),
    ],
)
