"""Nested records to related flat tables by Merkle subtree identities.

Every JSON object of a record gets an identity: the hash of its canonical form, built
bottom-up from the identities of its children. Identical objects share one row of the
object store; every occurrence keeps a row in the bridge, which names the record, figure,
panel and item by position, the field and place below its parent, and node and parent by
identity. Boxes and files that are no objects are values with an identity and a row of their
own in the store. The record's own row has no parent. From the store, records can be put
together again; the flat tables are the bridge joined with the store.

One pass over the payload column inside Arrow batches gives both. A task drops its own
repeats of an object; only the store is shuffled, for the repeats of different tasks.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator, Mapping

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.operators.partitioning import spread
from folioforge.session import materialize

BRIDGE_SCHEMA = (
    "record_id bigint, child string, figure_no int, panel_no int, item_no int, "
    "field string, ordinal int, node_id string, parent_id string"
)
#: What a bridge row stands for, beside the record itself and any other object.
CHILDREN = ("figure", "figure_file", "panel", "panel_bbox", "panel_file")
#: Rows held before a batch is handed on, and identities a task remembers to drop its own repeats.
FLUSH_ROWS, SEEN_MOST = 20_000, 200_000
COORDINATES = ("x1", "y1", "x2", "y2")


_LONG = re.compile(r"\d{4000}")
_encode = json.JSONEncoder(ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode
_encode_ascii = json.JSONEncoder(sort_keys=True, separators=(",", ":")).encode


def _refuse(token: str) -> None:
    raise ValueError(f"{token} is not JSON")


def parse(payload: str | None) -> object | None:
    """The value of a payload that is valid JSON as a whole, else None.

    NaN and Infinity are not JSON; text after the document makes it invalid; a document
    nested deeper than the parser's stack (thousands of levels) counts as invalid. Whole
    numbers of thousands of digits are read as floating ones.
    """
    if payload is None:
        return None
    try:
        return json.loads(payload, parse_constant=_refuse)
    except ValueError:
        try:
            return json.loads(payload, parse_constant=_refuse, parse_int=float) if _LONG.search(payload) else None
        except (ValueError, RecursionError):
            return None
    except RecursionError:
        return None


def manuscript(doc: object) -> dict | None:
    """The shallowest object that has figures, whatever envelope stands around it."""
    level = [doc]
    while level:
        objects = [x for x in level if isinstance(x, dict)]
        for x in objects:
            if "figures" in x:
                return x
        level = [v for x in objects for v in x.values() if isinstance(v, dict)]
    return None


def children(value: object) -> list[tuple[int, object]]:
    """(position, child) of an array, or of a single child that stands without its array."""
    if value is None:
        return []
    items = value if isinstance(value, list) else [value]
    return [(i, x) for i, x in enumerate(items, 1) if x is not None]


def number(x: object) -> float | None:
    if isinstance(x, bool):
        return None
    if isinstance(x, str):
        try:
            x = float(x) if "_" not in x else None
        except ValueError:
            return None
    if isinstance(x, (int, float)):
        try:
            f = float(x)
        except OverflowError:
            return None
        return f if f - f == 0 else None
    return None


def box(value: object) -> list[float] | None:
    """The four coordinates of a box written as array, object or text, if all four are there."""
    if isinstance(value, str):
        value = value.strip().strip("[]()").replace(";", ",").split(",")
    elif isinstance(value, dict):
        value = [value.get(k) for k in COORDINATES]
    if not isinstance(value, list) or len(value) != 4:
        return None
    found = [number(x) for x in value]
    return None if None in found else found


class Merkle:
    """Identities of one document's objects, each computed once, bottom-up.

    The body of an object is JSON with its keys in order, in which each child object stands as
    {"@": identity}, so equal subtrees have equal bodies in any key order and no other object
    ever stands inside a body. `store` has the body of every object by identity.
    """

    def __init__(self, doc: object) -> None:
        self.store: dict[str, str] = {}
        self.node: dict[int, str] = {}  # by place in memory, which the document keeps alive
        self._plain: dict[int, object] = {}
        self.root = self.add(doc)

    def add(self, value: object) -> str:
        """The identity of a value of the document, which is stored under it."""
        if id(value) in self.node and isinstance(value, dict):
            return self.node[id(value)]
        order, stack = [], [value]
        while stack:  # parents before children, whatever the depth
            v = stack.pop()
            inner = v.values() if isinstance(v, dict) else v if isinstance(v, list) else ()
            if isinstance(v, (dict, list)):
                order.append(v)
                stack.extend(x for x in inner if isinstance(x, (dict, list)) and id(x) not in self._plain)
        plain = self._plain
        for v in reversed(order):
            if isinstance(v, list):
                plain[id(v)] = [plain[id(x)] if isinstance(x, (dict, list)) else x for x in v]
            else:
                self.node[id(v)] = node = self._keep({k: plain[id(x)] if isinstance(x, (dict, list)) else x for k, x in v.items()})
                plain[id(v)] = {"@": node}
        if isinstance(value, dict):
            return self.node[id(value)]
        return self._keep(plain[id(value)] if isinstance(value, list) else value)

    def _keep(self, plain: object) -> str:
        body = _encode(plain)
        try:
            raw = body.encode()
        except UnicodeEncodeError:  # half a surrogate pair, written as an escape
            body = _encode_ascii(plain)
            raw = body.encode()
        node = hashlib.blake2b(raw, digest_size=16).hexdigest()
        self.store[node] = body
        return node


def rebuild(node: str, bodies: Mapping[str, str]) -> object:
    """The value of an identity, put together from the store."""
    def whole(x: object) -> object:
        return rebuild(x["@"], bodies) if isinstance(x, dict) else [whole(y) for y in x] if isinstance(x, list) else x

    value = json.loads(bodies[node])
    return {k: whole(x) for k, x in value.items()} if isinstance(value, dict) else whole(value)


def occurrences(record_id: int, doc: object, merkle: Merkle, only: tuple[str, ...] | None = None) -> Iterator[tuple]:
    """The bridge rows of a document, parents before children; only the kinds named, if any are."""
    wanted = lambda child: not only or child in only
    if wanted("record"):
        yield (record_id, "record", 0, 0, 0, None, 0, merkle.root, None)
    top = manuscript(doc)
    node = merkle.node
    # object or array, kind of its object, positions, identity of the object that holds it
    stack = [(doc, "record", 0, 0, merkle.root)] if isinstance(doc, (dict, list)) else []
    while stack:
        value, kind, f, p, me = stack.pop()
        for field, x in value.items() if isinstance(value, dict) else (("", value),):
            if x is None or not isinstance(x, (dict, list, str)):
                continue
            own = "figure" if value is top and field == "figures" else "panel" if kind == "figure" and field == "panels" else None
            files = kind in ("figure", "panel") and field == "sd_files"
            if kind == "panel" and field == "panel_bbox" and box(x) is not None:
                if wanted("panel_bbox"):
                    yield (record_id, "panel_bbox", f, p, 0, field, 1, merkle.add(x), me)
                if isinstance(x, dict):
                    stack.append((x, "panel_bbox", f, p, node[id(x)]))
                continue
            if isinstance(x, str) and not files:
                continue
            for k, item in children(x):
                if isinstance(item, dict):
                    child = own or "object"
                    at = (k, 0) if own == "figure" else (f, k) if own == "panel" else (f, p)
                    here = node[id(item)]
                    if wanted(child):
                        yield (record_id, child, *at, 0, field, k, here, me)
                    stack.append((item, child, *at, here))
                elif files and isinstance(item, str) and item.strip() and wanted(f"{kind}_file"):
                    yield (record_id, f"{kind}_file", f, p, k, field, k, merkle.add(item), me)
                elif isinstance(item, list):
                    for j, y in enumerate(_objects_within(item), 1):
                        if wanted("object"):
                            yield (record_id, "object", f, p, 0, field, j, node[id(y)], me)
                        stack.append((y, "object", f, p, node[id(y)]))


def _objects_within(value: list) -> list[dict]:
    """The objects of an array of arrays, in order, at any depth of arrays."""
    out, stack = [], list(reversed(value))
    while stack:
        v = stack.pop()
        if isinstance(v, dict):
            out.append(v)
        elif isinstance(v, list):
            stack.extend(reversed(v))
    return out


def _schema(ddl: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    return pa.schema([(n, kinds[t]) for n, t in (x.split() for x in ddl.split(", "))])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)


def _walk(batches: Iterator[pa.RecordBatch], only: tuple[str, ...] | None, bodies: bool) -> Iterator[pa.RecordBatch]:
    schema = _schema(BRIDGE_SCHEMA + (", body string" if bodies else ""))
    rows: list[tuple] = []
    seen: set[tuple[str, str]] = set()
    for batch in batches:
        for record_id, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            doc = parse(payload)
            if doc is None and (payload is None or payload.strip() != "null"):
                continue
            merkle = Merkle(doc)
            found = occurrences(record_id, doc, merkle, only)
            if not bodies:
                rows.extend(found)
            else:
                for r in found:
                    fresh = (r[1], r[7]) not in seen
                    if fresh:
                        seen.add((r[1], r[7]))
                    rows.append((*r, merkle.store[r[7]] if fresh else None))
                if len(seen) > SEEN_MOST:
                    seen.clear()
            if len(rows) >= FLUSH_ROWS:
                yield _batch(rows, schema)
                rows = []
    if rows:
        yield _batch(rows, schema)


def decompose(df: DataFrame, id_col: str = "record_id", payload: str = "payload", only: tuple[str, ...] | None = None, bodies: bool = True) -> DataFrame:
    """The bridge, with the body of each object where a task first met it under that kind.

    Null payloads and payloads that are not valid JSON as a whole give no row. A null element
    gives none but keeps its position; a single child without its array has position 1;
    children of another type than expected (a number where a panel is due, a blank file
    name) give no figure, panel, box or file and keep their position; objects among them are
    plain objects. Objects of arrays of arrays are numbered through. Repeated records count
    each for themselves. Other columns of df are never read. An empty table gives an empty
    table.
    """
    rows = spread(df.select(F.col(id_col).cast("bigint").alias("id"), F.col(payload).alias("payload")))
    return rows.mapInArrow(lambda it: _walk(it, only, bodies), BRIDGE_SCHEMA + (", body string" if bodies else ""))


def bridge(df: DataFrame, id_col: str = "record_id", payload: str = "payload", only: tuple[str, ...] | None = None) -> DataFrame:
    """One row per occurrence of a record, object, box or file, tied to its parent."""
    return decompose(df, id_col, payload, only, bodies=False)


def store(parts: DataFrame) -> DataFrame:
    """(node_id, body) of every distinct object of a decomposition, once."""
    return parts.where("body IS NOT NULL").groupBy("node_id").agg(F.first("body").alias("body"))


def flat(df: DataFrame, *kinds: str, id_col: str = "record_id", payload: str = "payload") -> DataFrame:
    """The bridge rows of some kinds with the bodies of their nodes, joined on the identity.

    The payloads are parsed once, and only the kinds asked for are shuffled.
    """
    parts = materialize(decompose(df, id_col, payload, kinds))
    return parts.drop("body").join(store(parts), "node_id")


def restore(parts: DataFrame) -> DataFrame:
    """(record_id, payload): each record put together again from bridge and store, in canonical
    form. A task holds the objects of one record at a time, no more than its payload."""

    def together(rows: pd.DataFrame) -> pd.DataFrame:
        bodies = dict(zip(rows["node_id"], rows["body"]))
        root = rows.loc[rows["child"] == "record", "node_id"].iloc[0]
        return pd.DataFrame({"record_id": [rows["record_id"].iloc[0]], "payload": [_encode_ascii(rebuild(root, bodies))]})

    each = parts.select("record_id", "child", "node_id").distinct().join(store(parts), "node_id")
    return each.groupBy("record_id").applyInPandas(together, "record_id bigint, payload string")


# Fields of a body as columns.


def text_field(name: str) -> Column:
    return F.get_json_object("body", f"$.{name}")


def number_of(text: Column) -> Column:
    """A finite number, written as number or text; null for anything else."""
    x = text.try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def coordinates() -> list[Column]:
    """The four coordinates of a box body: an array, an object or a text."""
    written = F.get_json_object(F.concat(F.lit('{"b":'), F.col("body"), F.lit("}")), "$.b")
    listed = F.when(F.col("body").startswith("{"), F.array(*[text_field(c) for c in COORDINATES])).otherwise(F.split(F.regexp_replace(written, r"[\[\]()\"\s]", ""), "[,;]"))
    return [number_of(F.get(listed, F.lit(k))).alias(c) for k, c in enumerate(COORDINATES)]
