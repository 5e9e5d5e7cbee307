"""Spec-driven projection of parsed documents into flat, typed tables.

Every table is a narrow plan over the parsed lines (project, or generate + project), so nothing is shuffled
between the scan and the write.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.plans.paths import Node, split_path
from logweir.plans.spec import ColumnSpec, SchemaSpec, SpecError, TableSpec
from logweir.sources.lines import document, is_document

# --- fixed values -----------------------------------------------------------------------------------
SOURCE_FILENAME = "__source_filename__"
# ----------------------------------------------------------------------------------------------------
MAX_EPOCH_SECONDS = 253402300799  # end of year 9999
CARRIED = ("data_date",)  # columns of the line frame that every table keeps


@dataclass(frozen=True)
class RowContext:
    """What a column expression may look at: the document, the list element, its position, the file."""

    doc: Node
    file_path: Column
    element: Node | TypedElement | None = None
    position: Column | None = None
    json_limit: int | None = None  # longer texts of JSON columns become NULL

    def get(self, path: str, data_type: str = "string") -> Column:
        """A value of the whole document, for derived columns."""
        return self.doc.get(path, data_type)


DeriveFunction = Callable[[RowContext], Column]
BUILT_IN_METRICS: dict[str, DeriveFunction] = {SOURCE_FILENAME: lambda row: row.file_path}


def _place(column: ColumnSpec, table: TableSpec, row: RowContext) -> tuple[Node, list[str]]:
    """Where a column's value is: a node and the steps from it."""
    keys = split_path(column.log_key)
    if column.is_foreign:
        return row.doc, keys
    if row.element is not None:
        return row.element, keys
    return row.doc, split_path(table.src) + keys


def _is_position(column: ColumnSpec, row: RowContext) -> bool:
    return row.element is not None and column.log_key == "index" and not column.is_foreign


def _read_type(column: ColumnSpec) -> str:
    """The type in which a column's value is read from a document, together with others."""
    if column.is_json or isinstance(column.data_type, T.IntegralType):
        return "variant"
    if isinstance(column.data_type, T.TimestampType):
        return "bigint"
    return "double" if isinstance(column.data_type, T.DoubleType) else "string"


def _typed(node: Node, keys: list[str], column: ColumnSpec) -> Column:
    data_type = column.data_type
    if isinstance(data_type, T.TimestampType):
        epoch = node.get(keys, "bigint")
        limit = MAX_EPOCH_SECONDS * (1 if column.scales_epoch_seconds else 1000)
        epoch = F.when(epoch.between(-limit, limit), epoch)  # one wild number must not stop the job
        return F.timestamp_seconds(epoch) if column.scales_epoch_seconds else F.timestamp_millis(epoch)
    if isinstance(data_type, (T.StringType, T.DoubleType)):
        return node.get(keys, data_type.simpleString())
    # Through text, as a delimited load would: '5.7' is not an integer and becomes NULL, not 5.
    text = node.get(keys, "string").try_cast(data_type)
    if isinstance(data_type, T.IntegralType) and isinstance(node, ReadDocument):
        # A variant's cast is set up anew for each value. The JSON text of a number is what the cast gives; what else has
        # no number in its JSON text (quoted text, say) is cast.
        return F.coalesce(F.to_json(node.get(keys, "variant")).try_cast(data_type), text)
    return text


def column_value(column: ColumnSpec, table: TableSpec, row: RowContext, metrics: dict[str, DeriveFunction]) -> Column:
    """The expression of one output column."""
    if column.is_noop:
        return F.lit(None).cast(column.data_type)
    if column.is_derived:
        if column.out_name not in metrics:
            raise SpecError(f"no function for derived column {column.out_name}")
        return metrics[column.out_name](row).try_cast(column.data_type)
    if _is_position(column, row):
        return row.position.try_cast(column.data_type)
    node, keys = _place(column, table, row)
    if column.is_json:
        text = F.coalesce(F.to_json(node.get(keys, "variant")), F.lit("null"))
        return text if row.json_limit is None else F.when(F.length(text) <= row.json_limit, text)
    value = _typed(node, keys, column)
    if row.element is not None and keys == ["value"] and not column.is_foreign:
        # an element that is no object is itself the value
        whole = F.when(node.get([], "map<string,variant>").isNull(), _typed(node, [], column))
        value = F.coalesce(value, whole)
    return value


def list_elements(doc: Node, table: TableSpec) -> Column:
    """The elements of a list source; NULL when there is no list."""
    return doc.get(split_path(table.src), "array<variant>")


def _required(table: TableSpec) -> list[ColumnSpec]:
    return [c for c in table.columns if c.is_mandatory and not (c.is_derived or c.is_noop)]


def missing_keys(table: TableSpec, doc: Node, taken: Column | None = None) -> list[tuple[str, Column]]:
    """(what, predicate) per mandatory column: the document lacks the key for some row of the table.

    ``taken``: the elements of a list table, where they have been taken out already.
    """
    row = RowContext(doc, F.lit(None))
    checks = []
    for column in _required(table):
        what = f"{table.src}: {column.log_key}" if table.src and not column.is_foreign else column.log_key
        if table.src_type == "dict":
            node, keys = _place(column, table, row)
            checks.append((what, node.is_absent(keys)))
            continue
        if column.log_key == "index" and not column.is_foreign:
            continue
        if table.src_type == "list":
            elements = list_elements(doc, table) if taken is None else taken
        else:
            elements = F.map_values(doc.get(split_path(table.src), "map<string,variant>"))
        if column.is_foreign:
            absent = (F.size(elements) > 0) & doc.is_absent(split_path(column.log_key))
        else:
            keys = split_path(column.log_key)
            absent = F.exists(elements, lambda e: Node(e).is_absent(keys))
        checks.append((what, F.coalesce(absent, F.lit(False))))
    return checks


def _any(predicates) -> Column:
    return reduce(lambda a, b: a | b, predicates, F.lit(False))


def is_incomplete(spec: SchemaSpec, doc: Node) -> Column:
    """Some mandatory key of some table is missing."""
    return _any(p for t in spec.tables.values() for _, p in missing_keys(t, doc))


def _checked_lists(docs: DataFrame, spec: SchemaSpec) -> tuple[DataFrame, dict[str, Column]]:
    """The lists whose elements are both checked for mandatory keys and unnested, taken out of the document once.

    The one-element generator keeps the optimizer from taking them out again in each place.
    """
    looked_at = {
        name: t for name, t in spec.tables.items()
        if t.src_type == "list" and any(c.is_foreign or c.log_key != "index" for c in _required(t))
    }
    if not looked_at:
        return docs, {}
    columns = {name: f"_elements_{n}" for n, name in enumerate(looked_at)}
    lists = F.struct(*[list_elements(document(F.col("doc")), t).alias(columns[name]) for name, t in looked_at.items()])
    return docs.select("*", F.inline(F.array(lists))), {name: F.col(c) for name, c in columns.items()}


def _accepted(docs: DataFrame, spec: SchemaSpec, on_error: str) -> tuple[DataFrame, dict[str, Column]]:
    """The documents that yield rows, and the lists that were taken out of them on the way."""
    doc = F.col("doc")
    docs, lists = _checked_lists(docs.where(is_document(doc)), spec)
    checks = [(f"{n}: {what}", p) for n, t in spec.tables.items() for what, p in missing_keys(t, document(doc), lists.get(n))]
    if on_error == "quarantine":
        return (docs.where(~_any(p for _, p in checks)) if checks else docs), lists
    if on_error != "fail":
        raise ValueError(f"on_error must be 'quarantine' or 'fail', not {on_error!r}")
    for what, predicate in checks:
        stop = F.raise_error(F.lit(f"required key missing: {what}")).cast("boolean")
        docs = docs.where(F.when(predicate, stop).otherwise(F.lit(True)))
    for name, table in spec.tables.items():
        if table.src_type == "list":
            stop = F.raise_error(F.lit(f"table {name}: {table.src} is not a list")).cast("boolean")
            elements = lists.get(name, list_elements(document(doc), table))
            docs = docs.where(F.when(elements.isNull(), stop).otherwise(F.lit(True)))
    return docs, lists


def extract_tables(docs: DataFrame, spec: SchemaSpec, metrics: dict[str, DeriveFunction] | None = None,
                   on_error: str = "quarantine", json_limit: int | None = None) -> dict[str, DataFrame]:
    """One lazy DataFrame per table of the spec.

    ``docs`` comes from ``parse_lines``. A document that lacks a mandatory key of any table yields no rows and
    shows up in ``error_rows`` (``on_error="quarantine"``), or stops the job (``"fail"``). A list source that
    is absent or null yields no rows; ``"fail"`` stops there too. ``metrics`` maps names of derived columns to
    functions of a ``RowContext``. With a ``json_limit`` the text of a JSON column that is longer becomes NULL; see
    ``checks.over_limit`` for how many.
    """
    accepted, lists = _accepted(docs, spec, on_error)
    return {name: _rows(accepted, table, metrics, json_limit, lists.get(name)) for name, table in spec.tables.items()}


def extract_table(docs: DataFrame, table: TableSpec, metrics: dict[str, DeriveFunction] | None = None,
                  on_error: str = "quarantine", json_limit: int | None = None) -> DataFrame:
    """``extract_tables`` for a spec of one table."""
    return extract_tables(docs, SchemaSpec({"table": table}), metrics, on_error, json_limit)["table"]


def _file_path(docs: DataFrame) -> Column:
    return F.col("file_path") if "file_path" in docs.columns else F.lit(None).cast("string")


def _foreign(table: TableSpec) -> list[ColumnSpec]:
    return [c for c in table.columns if c.is_foreign and not (c.is_derived or c.is_noop)]


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _element_types(table: TableSpec) -> dict[str, str] | None:
    """The types in which a table's columns take the keys of an element; None if an element is needed as it is."""
    types = {}
    for c in table.columns:
        if c.is_derived:
            return None
        if c.is_noop or c.is_foreign or c.log_key == "index":
            continue
        keys = split_path(c.log_key)
        if c.is_json or len(keys) != 1 or keys == ["value"]:
            return None
        timed = isinstance(c.data_type, T.TimestampType)
        kind = "bigint" if timed else "double" if isinstance(c.data_type, T.DoubleType) else "string"
        if types.setdefault(keys[0], kind) != kind:
            return None
    return types if types and len({k.lower() for k in types}) == len(types) else None


@dataclass(frozen=True)
class TypedElement:
    """An element of which only some keys were taken, each in its type: read in one go, without a variant of its own."""

    fields: Column

    def get(self, keys, data_type: str) -> Column:
        return self.fields[keys[0]]


@dataclass(frozen=True)
class ReadDocument(Node):
    """A document of which some values were read in one go; other places are read by path, as in any document.

    ``read``: steps -> (type, column). A value read as a variant can be had in any type.
    """

    read: dict[tuple[str, ...], tuple[str, Column]] = field(default_factory=dict)

    def get(self, path, data_type: str = "string") -> Column:
        keys = split_path(path) if path is None or isinstance(path, str) else list(path)
        kind, value = self.read.get(tuple(keys), (None, None))
        if kind == data_type:
            return value
        return F.try_variant_get(value, "$", data_type) if kind == "variant" else super().get(keys, data_type)

    def is_absent(self, keys) -> Column:
        """What was read is there; only where nothing was read, null and absent are told apart."""
        absent = super().is_absent(keys)
        kind, value = self.read.get(tuple(keys), (None, None))
        return absent if kind is None else F.when(value.isNull(), absent).otherwise(F.lit(False))


def _element_kind(table: TableSpec) -> str:
    """The type in which the elements of an unnested table are read."""
    checked = any(not c.is_foreign and c.log_key != "index" for c in _required(table))
    types = None if checked else _element_types(table)
    return f"struct<{','.join(f'{_quoted(k)}:{t}' for k, t in types.items())}>" if types else "variant"


def _source_kind(table: TableSpec) -> str:
    return f"{'array<' if table.src_type == 'list' else 'map<string,'}{_element_kind(table)}>"


def _wanted(tables: list[TableSpec]) -> dict[tuple[str, ...], str]:
    """Steps -> type of all values and lists that the tables take from a document."""
    row, wanted = RowContext(Node(F.lit(None)), F.lit(None)), {}
    for table in tables:
        places = [] if table.src_type == "dict" else [(split_path(table.src), _source_kind(table))]
        for c in table.columns if table.src_type == "dict" else _foreign(table):
            if not (c.is_derived or c.is_noop):
                places.append((_place(c, table, row)[1], _read_type(c)))
        for keys, kind in places:
            row.doc.path(keys)  # a key that can't be addressed is an error of the spec
            wanted[tuple(keys)] = kind if wanted.get(tuple(keys), kind) == kind else "variant"
    return wanted


def _together(wanted: dict[tuple[str, ...], str]) -> dict[tuple[str, ...], str]:
    """What one struct can hold: no place that others lie within, no keys that differ in case only."""
    within = {keys[:n] for keys in wanted for n in range(len(keys))}
    spelled = {}
    for keys in wanted:
        for n in range(1, len(keys) + 1):
            spelled.setdefault(tuple(k.lower() for k in keys[:n]), set()).add(keys[:n])
    return {
        keys: kind for keys, kind in wanted.items()
        if keys not in within and all(len(spelled[tuple(k.lower() for k in keys[:n])]) == 1 for n in range(1, len(keys) + 1))
    }


def _struct_of(wanted: dict[tuple[str, ...], str]) -> str:
    """The struct type that holds the places, nested as they are."""
    inner = {}
    for keys, kind in wanted.items():
        inner.setdefault(keys[0], {})[keys[1:]] = kind
    return f"struct<{','.join(f'{_quoted(k)}:{v[()] if () in v else _struct_of(v)}' for k, v in inner.items())}>"


def _read_together(docs: DataFrame, tables: list[TableSpec]) -> tuple[DataFrame, ReadDocument]:
    """All values and lists of the tables, taken from a document by one walk; lists that have no place in it, by their path.

    Walks by path cost more than the parse: each compares keys anew and makes a variant or a cast of its own. The
    one-element generator keeps the optimizer from reading again in each place.
    """
    doc = document(F.col("doc"))
    wanted = _wanted(tables)
    together = _together(wanted)
    sources = {tuple(split_path(t.src)) for t in tables if t.src_type != "dict"}
    apart = {keys: f"_list_{n}" for n, keys in enumerate(k for k in wanted if k in sources and k not in together)}
    columns = [doc.get([], _struct_of(together)).alias("_read")] if together else []
    columns += [doc.get(list(keys), wanted[keys]).alias(name) for keys, name in apart.items()]
    if not columns:
        return docs, ReadDocument(doc.variant, doc.base)
    read = {keys: (wanted[keys], F.col(name)) for keys, name in apart.items()}
    for keys, kind in together.items():
        read[keys] = kind, reduce(lambda place, key: place.getField(key), keys, F.col("_read"))
    return docs.select("*", F.inline(F.array(F.struct(*columns)))), ReadDocument(doc.variant, doc.base, read)


def _rows(docs: DataFrame, table: TableSpec, metrics: dict[str, DeriveFunction] | None, json_limit: int | None,
          elements: Column | None) -> DataFrame:
    metrics = {**BUILT_IN_METRICS, **(metrics or {})}
    carried = [F.col(c) for c in CARRIED if c in docs.columns]
    doc = document(F.col("doc"))
    row = RowContext(doc, _file_path(docs), json_limit=json_limit)
    if table.src_type == "dict":
        return docs.select(*[column_value(c, table, row, metrics).alias(c.out_name) for c in table.columns], *carried)
    # Foreign values are taken once per document, before it is unnested; unless a derived column looks at the
    # whole document, the elements then travel without it.
    docs, hoisted = _hoist_foreign(docs, [table], row, metrics)
    types = _element_types(table) if elements is None else None
    kind = f"struct<{','.join(f'{_quoted(k)}:{t}' for k, t in types.items())}>" if types else "variant"
    if table.src_type == "list":
        unnested = F.posexplode(doc.get(split_path(table.src), f"array<{kind}>") if elements is None else elements)
    else:
        unnested = F.explode(doc.get(split_path(table.src), f"map<string,{kind}>"))
    docs = docs.select("*", unnested.alias("_position", "_element"))
    element = TypedElement(F.col("_element")) if types else Node(F.col("_element"))
    row = RowContext(doc, row.file_path, element, F.col("_position"), json_limit)
    return docs.select(
        *[
            (F.col(hoisted[0, c.out_name]) if (0, c.out_name) in hoisted else column_value(c, table, row, metrics))
            .alias(c.out_name)
            for c in table.columns
        ],
        *carried,
    )


def _value_key(column: ColumnSpec, table: TableSpec, row: RowContext) -> tuple:
    """Columns of a document with equal keys have equal values."""
    return tuple(_place(column, table, row)[1]), column.data_type, column.is_json, column.scales_epoch_seconds


def _hoist_foreign(docs: DataFrame, tables: list[TableSpec], row: RowContext, metrics: dict[str, DeriveFunction]):
    """Take the foreign values of unnested tables once per document; (frame, (n-th table, column) -> name).

    A value that several tables take in one type is taken for all of them, tables of whole documents included. The
    one-element generator keeps the optimizer from moving the values back to where they are used.
    """
    names, values, taken = {}, [], {}
    for n, table in enumerate(tables):
        for c in _foreign(table) if table.src_type != "dict" else ():
            place = _value_key(c, table, row)
            if place not in taken:
                taken[place] = f"_foreign_{n}_{len(values)}"
                values.append(column_value(c, table, row, metrics).alias(taken[place]))
            names[n, c.out_name] = taken[place]
    for n, table in enumerate(tables):
        for c in table.columns if table.src_type == "dict" else ():
            if not (c.is_derived or c.is_noop) and _value_key(c, table, row) in taken:
                names[n, c.out_name] = taken[_value_key(c, table, row)]
    return (docs.select("*", F.inline(F.array(F.struct(*values)))) if values else docs), names


REJECTED = -1  # the tag of a document that yields no rows


def tagged_rows(docs: DataFrame, spec: SchemaSpec, metrics: dict[str, DeriveFunction] | None = None):
    """All rows of all tables in one pass over the documents.

    Returns a frame with one row per output row and per rejected document, and a function that gives the column
    expressions of the n-th table on it, valid where ``_tag`` is n. What the tables need is read from a document once.
    Two generators make the rows: one row per table, then one row per position in that table's source. Both compile
    into the scan's stage, which lambda functions over arrays would not.
    """
    metrics = {**BUILT_IN_METRICS, **(metrics or {})}
    tables = list(spec.tables.values())
    docs, doc = _read_together(docs, tables)
    whole = RowContext(doc, _file_path(docs))
    docs, hoisted = _hoist_foreign(docs, tables, whole, metrics)
    sources = {n: doc.get(split_path(t.src), _source_kind(t)) for n, t in enumerate(tables) if t.src_type != "dict"}

    lists = {n: source for n, source in sources.items() if tables[n].src_type == "list"}
    incomplete = _any(p for n, t in enumerate(tables) for _, p in missing_keys(t, doc, lists.get(n)))
    accepted = is_document(F.col("doc")) & ~incomplete
    tags = F.when(accepted, F.array(*[F.lit(n) for n in range(len(tables))])).otherwise(F.array(F.lit(REJECTED)))
    per_table = docs.select("*", F.explode(tags).alias("_tag"))

    count = F.lit(1)  # one row, for dict tables and rejected documents
    for n, source in sources.items():
        count = F.when(F.col("_tag") == n, F.size(source)).otherwise(count)
    positions = F.when(count > 0, F.sequence(F.lit(0), count - 1))
    rows = per_table.select("*", F.explode(positions).alias("_position"))

    def columns_of(n: int) -> list[Column]:
        table, row, position = tables[n], whole, F.col("_position")
        if table.src_type != "dict":
            values, key = sources[n], position
            if table.src_type == "sparse_list":
                values, key = F.map_values(values), F.get(F.map_keys(values), position)
            element = F.get(values, position)
            row = RowContext(doc, whole.file_path, Node(element) if _element_kind(table) == "variant" else TypedElement(element), key)
        return [
            F.col(hoisted[n, c.out_name]) if (n, c.out_name) in hoisted else column_value(c, table, row, metrics)
            for c in table.columns
        ]

    return rows, columns_of
