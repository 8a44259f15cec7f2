"""Deeply nested, varying records -> flat child tables that keep record, parent and place.

Structural-variant tables. A payload is read once into a tree, and a bottom-up tree automaton runs over it: each node's state follows from
the states of its children (scalar kinds at the leaves, the set of the elements' states for an array, keys with their states for an object), so equal
shapes have equal states, and a node that says nothing (null, blank, without entries) is in the state ``empty``. The states are final for one *subtype* each or for none:
``SUBTYPES`` says which keys an object of a subtype has, and an object is of the subtype it shares most keys with. Child rows are routed by that to typed subtype tables
(``route``, one folder each; ``typed`` reads one), all of which keep the supertype keys ``kind, rec_id, field, parent_path, path, pos``; a node in a state that is final for
no subtype goes nowhere, only its place counts.

Where other records have an array, a single value or object is that array with one element. Which places those are
is learned from all payloads in a first pass (``array_places``) and added to the declared ones.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIELDS = {"advisory": ("affected_versions", "mitigations"), "packet": ("recommended_patterns", "tasks_by_role")}
MARKS = {
    "advisory": {"advisory_id", "affected_versions", "mitigations", "products", "title", "vendor"},
    "packet": {"issue_id", "recommended_patterns", "tasks_by_role", "reasoning", "citations"},
}
#: Places that the record types declare as arrays. ``*`` is the key of a map, ``[]`` an element.
DECLARED = {
    "affected_versions", "mitigations", "products", "affected_versions[].builds", "mitigations[].steps", "recommended_patterns",
    "recommended_patterns[].side_effects", "tasks_by_role.*", "tasks_by_role[].tasks", "tasks_by_role.*[].depends_on", "tasks_by_role[].tasks[].depends_on",
}
#: Typed columns of the objects of each subtype; arrays in them are child rows of their own.
SUBTYPES = {
    "version": {"version": "string", "fixed_in": "string"}, "mitigation": {"action": "string", "source_tier": "string"}, "step": {"role": "string", "details": "string"},
    "pattern": {"pattern_id": "string", "priority_order": "int", "why_selected": "string", "friction_level": "string"}, "role_tasks": {"role": "string", "tasks": "string"}, "task": {"task": "string", "due_days": "int"},
}
SCALARS = {"text": "string", "number": "double", "boolean": "boolean"}
OTHER = ("object", "array")
SCHEMA = "kind string, rec_id long, field string, parent_path string, path string, pos int, subtype string, variant string, state string, value string"


def read_record(text: object, kind: str) -> dict | None:
    """The record in a payload: without byte order mark, code fence, prose around it, string encoding or envelope objects.

    Null, blank, cut or otherwise invalid payloads give None.
    """
    marks = MARKS[kind]

    def parse(t: str) -> object:
        t = t.strip().lstrip("﻿").strip()
        starts = [i for i in (t.find("{"), t.find("[")) if i >= 0]
        if t.startswith('"'):
            starts.append(0)
        if not starts:
            return None
        try:
            return json.JSONDecoder().raw_decode(t, min(starts))[0]
        except (ValueError, RecursionError):
            return None

    def locate(o: object, depth: int) -> dict | None:
        if depth > 6:
            return None
        if isinstance(o, str):
            return locate(parse(o), depth + 1) if o.lstrip("﻿ \t\r\n")[:1] in tuple('{["`') or "{" in o[:200] else None
        if isinstance(o, dict):
            if marks & o.keys():
                return o
            inner = o.values()
        elif isinstance(o, list):
            inner = o
        else:
            return None
        return next((r for v in inner if (r := locate(v, depth + 1)) is not None), None)

    return locate(parse(text), 0) if isinstance(text, str) else None


class Node(NamedTuple):
    """A value with its state and, for arrays and objects, its children's nodes."""

    value: object
    state: str
    kids: dict[str, Node] | list[Node] | None = None


class Automaton:
    """Bottom-up: ``read`` gives every node of a tree its state in one pass; ``final`` the subtype that a state stands for."""

    def __init__(self) -> None:
        self._known: dict[tuple, str] = {}
        self.final: dict[str, str | None] = {"empty": None} | {k: k for k in SCALARS}

    def read(self, o: object) -> Node:
        if isinstance(o, dict):
            kids = {k: self.read(v) for k, v in o.items()}
            return Node(o, self._state(("object", *sorted((k, n.state) for k, n in kids.items()))) if o else "empty", kids)
        if isinstance(o, list):
            items = [self.read(v) for v in o]
            return Node(o, self._state(("array", *sorted({n.state for n in items}))) if o else "empty", items)
        if isinstance(o, str):
            return Node(o, "text" if o.strip() else "empty")
        return Node(o, "empty" if o is None else "boolean" if isinstance(o, bool) else "number")

    def _state(self, rule: tuple) -> str:
        """Transition: the state of a node whose kind and children's states are ``rule``."""
        if rule not in self._known:
            state = self._known[rule] = f"{rule[0]}-{hashlib.blake2b(repr(rule).encode(), digest_size=5).hexdigest()}"
            keys = {k for k, _ in rule[1:]} if rule[0] == "object" else set()
            shared, name = max(((len(keys & t.keys()) / len(t), name) for name, t in SUBTYPES.items()), default=(0, ""))
            self.final[state] = name if shared else rule[0]
        return self._known[rule]

    @staticmethod
    def variant(o: object) -> str:
        if isinstance(o, dict):
            return f"object({','.join(sorted(o))})"
        if isinstance(o, list):
            return "array"
        return "null" if o is None else "boolean" if isinstance(o, bool) else "text" if isinstance(o, str) else "number"


def _is_role_map(o: dict) -> bool:
    return not ({"role", "tasks"} & o.keys())


def _place(place: str, key: str) -> str:
    """Place of ``key``: roles and parameters are keys of maps, and what is inside products is as outside."""
    return f"{place}.*" if place == "tasks_by_role" or place.endswith(".parameters") else f"{place}.{key}" if place else key


def _roots(record: dict, kind: str) -> Iterator[tuple[str, str, object]]:
    """(field, path, tree) of each field of the record, and of its products with the products' own path."""
    for f in FIELDS[kind]:
        if f in record:
            yield f, f, record[f]
    products = record.get("products") if kind == "advisory" else None
    for i, p in enumerate(products if isinstance(products, list) else [products]):
        if isinstance(p, dict):
            for f in FIELDS[kind]:
                if f in p:
                    yield f, f"products[{i}].{f}", p[f]


def places_of(record: dict, kind: str) -> dict[str, bool]:
    """The places of this record, and whether they are arrays."""
    seen: dict[str, bool] = {}

    def walk(o: object, place: str) -> None:
        seen[place] = seen.get(place, False) or isinstance(o, list)
        if isinstance(o, list):
            for v in o:
                if isinstance(v, (list, dict)):
                    walk(v, place + "[]")
        elif isinstance(o, dict):
            for k, v in o.items():
                walk(v, _place(place, k))

    for f, _, tree in _roots(record, kind):
        walk(tree, f)
    seen.pop("tasks_by_role", None)
    return seen


def children(record: dict, kind: str, arrays: set[str], automaton: Automaton) -> Iterator[tuple]:
    """(field, parent_path, path, pos, subtype, variant, state, value) of each child in a state that is final for a subtype."""

    def row(f: str, parent: str, path: str, pos: int | None, n: Node, name: str) -> tuple:
        return f, parent, path, pos, name, automaton.variant(n.value), n.state, n.value if isinstance(n.value, str) else json.dumps(n.value, ensure_ascii=False)

    def walk(f: str, n: Node, place: str, path: str, parent: str) -> Iterator[tuple]:
        role_map = place == "tasks_by_role" and isinstance(n.value, dict) and _is_role_map(n.value)
        if isinstance(n.value, list) or (place in arrays or place == "tasks_by_role") and not role_map:
            for i, v in enumerate(n.kids if isinstance(n.value, list) else [n]):
                here = f"{path}[{i}]"
                if (name := automaton.final[v.state]) is not None:
                    yield row(f, parent, here, i, v, name)
                yield from inside(f, v, place + "[]", here, here)
        else:
            yield from inside(f, n, place, path, parent)

    def inside(f: str, n: Node, place: str, path: str, parent: str) -> Iterator[tuple]:
        if isinstance(n.value, list):
            yield from walk(f, n, place, path, parent)
        elif isinstance(n.value, dict):
            entries = f == "recommended_patterns" and place.endswith("].parameters")
            for k, v in n.kids.items():
                if entries and (name := automaton.final[v.state]) is not None:
                    yield row(f, parent, f"{path}.{k}", None, v, name)
                yield from walk(f, v, _place(place, k), f"{path}.{k}", parent)

    for f, path, tree in _roots(record, kind):
        head, dot, _ = path.rpartition(".")
        yield from walk(f, automaton.read(tree), f, path, head if dot else "")


def array_places(df: DataFrame, kind: str) -> set[str]:
    """Places at which a payload of ``df`` has an array, with the declared ones.

    A place that only one payload has is no place where *others* have an array, so what is collected are keys that records share,
    with keys of maps replaced by ``*``: as many as the record types have fields, also if keys are made per record.
    """

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, list[int]] = {}
        for pdf in batches:
            for p in pdf["payload"]:
                if (r := read_record(p, kind)) is not None:
                    for place, array in places_of(r, kind).items():
                        x = seen.setdefault(place, [0, 0])
                        x[0] += 1
                        x[1] += array
        yield pd.DataFrame([(k, *v) for k, v in seen.items()], columns=["place", "n", "arrays"]).astype({"place": object, "n": "int64", "arrays": "int64"})

    counted = df.select("payload").where("payload is not null").mapInPandas(scan, "place string, n long, arrays long")
    places = counted.groupBy("place").agg(F.sum("n").alias("n"), F.sum("arrays").alias("arrays")).where("n > 1 and arrays > 0 and arrays < n")
    return DECLARED | {r["place"] for r in places.select("place").collect()}


def child_rows(df: DataFrame, key: str, kind: str) -> DataFrame:
    """Flat child rows (``SCHEMA``) of a table with a unique ``key`` and a JSON ``payload``; other columns are ignored.

    Each row of the table counts by itself, also repeated ones. An empty table gives an empty result.
    """
    arrays = array_places(df, kind)

    def flatten(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = Automaton()
        for pdf in batches:
            rows = [(kind, k, *c) for k, p in zip(pdf["k"], pdf["payload"], strict=True) if (r := read_record(p, kind)) is not None for c in children(r, kind, arrays, automaton)]
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])
            yield out.astype({"pos": "Int32"})

    return df.select(F.col(key).cast("long").alias("k"), "payload").where("payload is not null").mapInPandas(flatten, SCHEMA)


def flat_tables(advisories: DataFrame, packets: DataFrame) -> DataFrame:
    """The supertype table: the child rows of both record types."""
    return child_rows(advisories, "rec_id", "advisory").unionByName(child_rows(packets, "packet_id", "packet"))


def route(rows: DataFrame, folder: str) -> str:
    """Writes child rows to one table per subtype under ``folder``: each row goes where the state of its node leads."""
    rows.write.mode("overwrite").partitionBy("subtype").parquet(folder)
    return folder


def typed(spark: SparkSession, folder: str, subtype: str) -> DataFrame:
    """The table of one subtype: supertype keys, parent link and typed columns (``value`` for scalars and shapes without a type)."""
    rows = spark.read.schema(SCHEMA).parquet(folder).where(F.col("subtype") == subtype)
    keys = ["kind", "rec_id", "field", "parent_path", "path", "pos"]
    if subtype in SUBTYPES:
        # Objects that are one subtype by some of their keys may hold more: what has no column stays readable in value.
        columns = F.from_json("value", ", ".join(f"`{k}` {t}" for k, t in SUBTYPES[subtype].items()))
        return rows.select(*keys, columns.alias("v"), "value").select(*keys, "v.*", "value")
    kind = SCALARS.get(subtype, "string")
    return rows.select(*keys, F.col("value").try_cast(kind).alias("value"))


def supertype(spark: SparkSession, folder: str) -> DataFrame:
    """``(kind, rec_id, parent_path, path, subtype)`` of all rows, as the union of the subtype tables."""
    parts = [typed(spark, folder, name).select("kind", "rec_id", "parent_path", "path", F.lit(name).alias("subtype")) for name in (*SUBTYPES, *SCALARS, *OTHER)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
