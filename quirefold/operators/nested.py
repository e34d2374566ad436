"""Deeply nested records as related flat tables (shared inlining).

The schema is read as a graph of struct types. A struct that occurs once below its parent is inlined into the parent's
table. What is repeated gets a table of its own, whose rows point to the parent's row: arrays of structs, of
scalars (column `value`) and of arrays, maps (column `<field>_key`), and structs whose arrays run in parallel and so
are the columns of one repeated element. A struct type shared by several places gets one table for all of
them, whose `slot` names the place; what is repeated inside it points to that row. Spark's types can't be
recursive, so no table points to itself. Catalyst does the flattening (`posexplode`), so that only the columns asked
for are read.

Null and empty arrays and maps give no child rows; null elements are no rows but count as positions; repeated records
count once; extra columns stay on the root table. A column with the name of one of its table's keys gets the table's
name as a prefix.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirefold.sources.loose_json import loads

#: The parallel arrays of a page, and how each is typed.
WORD_INTS = ("level", "page_num", "block_num", "par_num", "line_num", "word_num", "left", "top", "width", "height")
WORD_FIELDS = (*WORD_INTS, "conf", "text")
STAGES = ("render_raw", "canonical", "render_full")
STAGE_TYPE = T.StructType(
    [T.StructField(n, T.StringType() if n in ("stage", "dtype", "dpi_source") else T.IntegerType())
     for n in ("stage", "width_px", "height_px", "channels", "dtype", "dpi_x", "dpi_y", "dpi_source")]
)


@dataclass
class Node:
    """A table to be: its path from the parent's row, how it repeats (`one`, `array`, `map`, `parallel`, `shared`), its
    inlined columns, its children."""

    name: str
    path: tuple[str, ...] = ()
    how: str = "one"
    #: The elements are no structs and stand in the column `value`.
    bare: bool = False
    columns: list[tuple[str, tuple[str, ...]]] = field(default_factory=list)
    children: list[Node] = field(default_factory=list)
    #: Shared structs: the places (slots) they occur at, each a path.
    slots: list[tuple[str, ...]] = field(default_factory=list)
    #: Parallel arrays: their fields.
    fields: list[T.StructField] = field(default_factory=list)


def schema_graph(schema: T.StructType, root: str = "root", parallel: Iterable[str] = ()) -> Node:
    """The tables that shared inlining gives for a schema. parallel: dotted paths of structs whose arrays are parallel."""
    uses: dict[str, int] = {}
    zipped = {tuple(p.split(".")) for p in parallel}

    def count(t: T.DataType, field_: bool = False) -> None:
        if isinstance(t, T.StructType):
            if field_:
                uses[t.simpleString()] = uses.get(t.simpleString(), 0) + 1
            for f in t.fields:
                count(f.dataType, True)
        elif isinstance(t, T.ArrayType):
            count(t.elementType)
        elif isinstance(t, T.MapType):
            count(t.valueType)

    count(schema)

    def build(t: T.DataType, node: Node, whole: tuple[str, ...]) -> Node:
        """Fills a node from its rows' type; whole: the path from the root."""
        shared: dict = {}
        node.bare = not isinstance(t, T.StructType)

        def repeated(d: T.DataType, how: str, at: tuple[str, ...], fields: Iterable[T.StructField] = ()) -> None:
            node.children.append(build(d, Node("_".join((node.name, *at)), at, how, fields=list(fields)), whole + at))

        def walk(s: T.StructType, at: tuple[str, ...]) -> None:
            for f in s.fields:
                p, d = (*at, f.name), f.dataType
                if isinstance(d, T.StructType) and whole + p in zipped:
                    repeated(T.StructType([T.StructField(x.name, x.dataType.elementType) for x in d.fields]), "parallel", p, d.fields)
                elif isinstance(d, T.StructType) and uses[d.simpleString()] > 1:
                    shared.setdefault(d.simpleString(), (d, []))[1].append(p)
                elif isinstance(d, T.StructType):
                    walk(d, p)
                elif isinstance(d, T.ArrayType):
                    repeated(d.elementType, "array", p)
                elif isinstance(d, T.MapType):
                    repeated(d.valueType, "map", p)
                else:
                    node.columns.append(("_".join(p), p))

        walk(T.StructType([T.StructField("value", t)]) if node.bare else t, ())
        for i, (d, places) in enumerate(shared.values()):
            node.children.append(build(d, Node(f"{node.name}_shared{i}", (), "shared", slots=places), whole))
        return node

    return build(schema, Node(root), ())


def shred(df: DataFrame, key: str, root: str = "root", only: Iterable[str] | None = None, parallel: Iterable[str] = ()) -> dict[str, DataFrame]:
    """The tables of df by name: the root's, and one of each repeated or shared element.

    A child's row holds the root's `key`, and the `<field>_pos` (maps: `<field>_key`) or `slot` of each element on
    the way down, which together point to the parent's row. `only` names the tables wanted."""
    graph, out = schema_graph(df.schema, root, parallel), {}
    wanted = None if only is None else set(only)

    def ref(base: str | None, path: tuple[str, ...]):
        return F.col(".".join(f"`{p}`" for p in ((base,) if base else ()) + path))

    def free(name: str, taken: list[str], table: str) -> str:
        while name in taken:
            name = f"{table}_{name}"
        return name

    def walk(node: Node, rows: DataFrame, base: str | None, keys: list[str]) -> None:
        if wanted is None or node.name in wanted:
            own = [ref(base, p).alias(free(n, keys, node.name)) for n, p in node.columns if base or (n,) != p or n != key]
            out[node.name] = rows.select(*keys, *own)
        for c in node.children:
            if wanted is not None and not any(w == c.name or w.startswith(c.name + "_") for w in wanted):
                continue
            if c.how == "shared":
                name = free("slot", keys, c.name)
                slot = F.explode(F.array(*[F.struct(F.lit("_".join(p)).alias("slot"), ref(base, p).alias("v")) for p in c.slots]))
                x = rows.select(*keys, slot.alias("__s")).select(*keys, F.col("__s.slot").alias(name), F.col("__s.v").alias("__e"))
            elif c.how == "map":
                name = free(f"{c.path[-1]}_key", keys, c.name)
                x = rows.select(*keys, F.explode(ref(base, c.path)).alias(name, "__e"))
            else:
                name = free(f"{c.path[-1]}_pos", keys, c.name)
                # a parallel array that is missing counts as empty, shorter ones are filled with nulls
                items = ref(base, c.path) if c.how == "array" else F.arrays_zip(*[F.coalesce(ref(base, (*c.path, f.name)), F.array().cast(f.dataType)).alias(f.name) for f in c.fields])
                x = rows.select(*keys, F.posexplode(items).alias(name, "__e"))
            x = x.filter("__e is not null")
            if c.bare:
                x = x.withColumn("__e", F.struct(F.col("__e").alias("value")))
            walk(c, x, "__e", [*keys, name])

    walk(graph, df, None, [key])
    return out


# ---- raw OCR records -------------------------------------------------------------------------------


def _number(x, whole: bool):
    try:
        return int(x) if whole else float(x)
    except (TypeError, ValueError, OverflowError):
        return None


def _array(values: list, kind: pa.DataType) -> pa.Array:
    """Lists as an Arrow array; only where a value doesn't fit its type are all converted one by one."""
    try:
        return pa.array(values, kind)
    except (pa.ArrowInvalid, pa.ArrowTypeError, TypeError, OverflowError):
        item = kind.value_type
        if pa.types.is_string(item):
            one = lambda x: None if x is None else x if isinstance(x, str) else str(x)
        else:
            one = lambda x: _number(x, pa.types.is_integer(item))
        return pa.array([None if v is None else [one(x) for x in v] for v in values], kind)


def pages_of(record) -> Iterator[tuple[str, object, dict]]:
    """(parent as written, page_Id, page) of each page of a parsed record in any of its variants."""
    if isinstance(record, dict) and ("page_dict" in record or "conf" in record and "text" in record):
        record = [record]
    if isinstance(record, dict):
        for k, page in record.items():
            if isinstance(page, dict):
                yield k, page.get("page_Id"), page
    elif isinstance(record, list):
        for page in record:
            if isinstance(page, dict):
                number = page.get("page_Id")
                if number is None:
                    number = page.get("page_num")
                if isinstance(number, list):
                    number = next((x for x in number if x is not None), None)
                if number is None:
                    inner = (page.get("page_dict") or {}).get("page_num")
                    number = next((x for x in inner if x is not None), None) if isinstance(inner, list) else inner
                yield None if number is None else str(number), page.get("page_Id"), page


def read_pages(df: DataFrame, key: str = "rec_id", text: str = "raw_json", fields: Iterable[str] = WORD_FIELDS, meta: bool = True) -> DataFrame:
    """Each record as one typed value: key, and `pages`, an array of structs of `page_key`, `page_id`, `page_dict` (the named
    parallel arrays) and `image_meta`. A record that is null, cut off or beyond repair has null pages."""
    fields = tuple(fields)
    kinds = {f: pa.list_(pa.string() if f == "text" else pa.float64() if f == "conf" else pa.int32()) for f in fields}
    stage = pa.struct([(f.name, pa.string() if isinstance(f.dataType, T.StringType) else pa.int32()) for f in STAGE_TYPE])
    whole = {f.name for f in STAGE_TYPE if isinstance(f.dataType, T.IntegerType)}
    words = T.StructType([T.StructField(f, T.ArrayType(T.StringType() if f == "text" else T.DoubleType() if f == "conf" else T.IntegerType())) for f in fields])
    page = T.StructType([T.StructField("page_key", T.StringType()), T.StructField("page_id", T.IntegerType())])
    page = page.add("page_dict", words) if fields else page
    page = page.add("image_meta", T.StructType([T.StructField(s, STAGE_TYPE) for s in STAGES])) if meta else page
    schema = T.StructType([T.StructField(key, T.LongType()), T.StructField("pages", T.ArrayType(page))])
    pages_a_batch = 256

    def clean(m):
        if not isinstance(m, dict):
            return None
        return {s: {n: (_number(v, True) if n in whole else None if v is None else str(v)) for n in STAGE_TYPE.names for v in [m[s].get(n)]}
                if isinstance(m.get(s), dict) else None for s in STAGES}

    def emit(ids, ends, names, numbers, lists, metas) -> pa.RecordBatch:
        parts = {"page_key": pa.array(names, pa.string()), "page_id": pa.array(numbers, pa.int32())}
        if fields:
            parts["page_dict"] = pa.StructArray.from_arrays([_array(lists[f], kinds[f]) for f in fields], list(fields))
        if meta:
            parts["image_meta"] = pa.array(metas, pa.struct([(s, stage) for s in STAGES]))
        starts = [0, *[e for e, _ in ends]]
        offsets = pa.array([a if ok else None for a, (_, ok) in zip(starts, ends)] + [starts[-1]], pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(list(parts.values()), list(parts)))], names=[key, "pages"])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, ends, names, numbers, metas, lists = [], [], [], [], [], {f: [] for f in fields}
        for b in batches:
            for k, raw in zip(b.column(0).to_pylist(), b.column(1)):
                record = loads(raw.as_py())
                for parent, number, one in pages_of(record):
                    arrays = one.get("page_dict") if isinstance(one.get("page_dict"), dict) else one
                    names.append(parent)
                    numbers.append(_number(number, True))
                    for f in fields:
                        v = arrays.get(f)
                        lists[f].append(v if isinstance(v, list) else None)
                    if meta:
                        metas.append(clean(one.get("image_meta")))
                ids.append(k)
                ends.append((len(names), record is not None))
                if len(names) >= pages_a_batch:
                    yield emit(ids, ends, names, numbers, lists, metas)
                    ids, ends, names, numbers, metas, lists = [], [], [], [], [], {f: [] for f in fields}
        if ids:
            yield emit(ids, ends, names, numbers, lists, metas)

    return df.select(F.col(key).cast("long").alias(key), text).mapInArrow(parse, schema)


#: The tables of a raw OCR record and the names of their keys.
_TABLES = {"pages": "record_pages", "words": "record_pages_page_dict", "stages": "record_pages_shared0"}


def _record_table(records: DataFrame, which: str, key: str) -> DataFrame:
    name = _TABLES[which]
    return shred(records.select(key, "pages"), key, "record", [name], ["pages.page_dict"])[name].withColumnRenamed("pages_pos", "page_pos")


def pages_of_records(records: DataFrame, key: str = "rec_id") -> DataFrame:
    """One row per page of the records of `read_pages`: key, page_pos, page_key, page_id."""
    return _record_table(records, "pages", key)


def words_of(records: DataFrame, key: str = "rec_id") -> DataFrame:
    """One row per position of a page's parallel arrays (`word_pos`), pointing to its page; with the page's key as written."""
    x = records.select(key, F.posexplode("pages").alias("page_pos", "page"))
    x = shred(x.select(F.struct(key, "page_pos", "page.page_key").alias("page_ref"), F.col("page.page_dict").alias("page_dict")), "page_ref", "page", ["page_page_dict"], ["page_dict"])["page_page_dict"]
    names = [c for c in x.columns if c not in ("page_ref", "page_dict_pos")]
    return x.select(F.col(f"page_ref.{key}").alias(key), F.col("page_ref.page_key").alias("page_key"), F.col("page_ref.page_pos").alias("page_pos"), F.col("page_dict_pos").alias("word_pos"), *names)


def stages_of(records: DataFrame, key: str = "rec_id") -> DataFrame:
    """The shared element of a page's image metadata: one row per stage that is there, pointing to its page."""
    return _record_table(records, "stages", key).withColumn("slot", F.regexp_replace("slot", "^image_meta_", ""))


def once(df: DataFrame, key: str) -> DataFrame:
    """Repeated rows count once: rows of one key are copies of one another, and one of them is kept.
    Rows without a key have nothing their parts could point to and are left out."""
    return df.filter(F.col(key).isNotNull()).dropDuplicates([key])
