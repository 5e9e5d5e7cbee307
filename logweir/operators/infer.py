"""Guess a table spec from sample documents.

One pass over the lines, whatever their depth: each document is taken apart by a generator per level, and what lies
deeper than these inside its row, level by level until no dict is left. Each task keeps one entry per (path, type): the longest rendering seen.
Only those entries are shuffled, so the volume follows the number of distinct paths, not of documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.plans.paths import split_path
from logweir.plans.spec import SchemaSpec, TableSpec, new_table
from logweir.session import stored
from logweir.sources.lines import document, is_document, parse_lines


class TypeMismatch(ValueError):
    """One path holds values that no column type covers."""


class TypeUnknown(ValueError):
    """A value type that has no column type."""


@dataclass(frozen=True)
class InferOptions:
    """Where to look: source path and kind, depth (-1 is unlimited), paths to leave out, to keep whole, and
    absolute paths to copy into the table."""

    source: str = ""
    source_type: str = "dict"
    depth: int = -1
    exclude: tuple[str, ...] = ()
    prune: tuple[str, ...] = ()
    foreign: tuple[str, ...] = ()


# --- fixed values -----------------------------------------------------------------------------------
NUMBER_RANK = {"int": 1, "long": 2, "float": 3}
WIDE_VARCHAR = 65535
PLAIN = r"\A[ !#-\[\]-~]*+\z"  # texts that JSON in ASCII holds as they are
LEVELS = 3  # taken apart by generators; what lies deeper, inside its row
# ----------------------------------------------------------------------------------------------------


def _map(value: Column) -> Column:
    """The entries of a dict; NULL for anything else."""
    return F.try_variant_get(value, "$", "map<string,variant>")


def _kind(text: Column) -> Column:
    """int, long (beyond 64 bits), float, str, bool, list, dict or null, by a value's JSON text."""
    first, kind = F.left(text, F.lit(1)), F
    for mark, name in {'"': "str", "{": "dict", "[": "list", "t": "bool", "f": "bool", "n": "null"}.items():
        kind = kind.when(first == mark, name)
    return kind.when(text.contains(".") | text.contains("E"), "float").when(text.try_cast("bigint").isNull(), "long").otherwise("int")


def _rendered_length(text: Column, kind: Column) -> Column:
    """Length of JSON text in ASCII: escapes for other characters, a space behind each comma and colon outside of texts.

    A number with an exponent is written like 1e+22.
    """
    mantissa, exponent = (F.get(F.split(text, "E"), F.lit(n)) for n in (0, 1))
    with_exponent = F.length(F.regexp_replace(mantissa, r"\.0$", "")) + 2 + F.greatest(F.lit(2), F.length(F.replace(exponent, F.lit("-"))))
    plain = (F.length(text) == F.octet_length(text)) & ~text.contains("\x7f")
    escaped = F.when(plain, F.length(text)).otherwise(
        F.length(text) + 5 * F.regexp_count(text, F.lit(r"[^\x00-\x7E]")) + 6 * F.regexp_count(text, F.lit(r"[\x{10000}-\x{10FFFF}]")))
    bare = F.regexp_replace(text, r'"[^"\\]*+(?:\\.[^"\\]*+)*+"', "")
    nested = escaped + F.regexp_count(bare, F.lit("[,:]"))
    return F.when((kind == "float") & text.contains("E"), with_exponent).when(kind.isin("list", "dict"), nested).otherwise(escaped).cast("bigint")


def _sources(docs: DataFrame, options: InferOptions) -> DataFrame:
    """The objects that would be rows, one variant each, without those that are null; with the documents' ``most`` levels."""
    doc, keys = document(F.col("doc")), split_path(options.source)
    if options.source_type == "list":
        objects = docs.select(F.explode(doc.get(keys, "array<variant>")).alias("value"), "most")
    elif options.source_type == "sparse_list":
        objects = docs.select(F.explode(F.map_values(doc.get(keys, "map<string,variant>"))).alias("value"), "most")
    else:
        objects = docs.select(doc.get(keys, "variant").alias("value"), "most")
    return objects.where(F.col("value").isNotNull() & ~F.is_variant_null("value"))


def _level(rows: DataFrame, options: InferOptions) -> DataFrame:
    """One level of the dicts that are not ``done`` taken apart by a generator, which compiles into the scan's stage."""
    done = F.col("done") | F.col("path").isin(*options.prune) if options.prune else F.col("done")
    rows = rows.select("path", "value", done.alias("done"), "most")
    rows = rows.select("*", F.explode_outer(F.when(~F.col("done"), _map(F.col("value")))).alias("_key", "_below"))
    itself = F.col("_key").isNull()
    rows = rows.where(~itself | F.col("done") | _map(F.col("value")).isNull())  # an empty dict has no entries
    below = F.call_function("ltrim", F.lit("."), F.concat("path", F.lit("."), "_key"))
    rows = rows.select(F.when(itself, F.col("path")).otherwise(below).alias("path"),
                       F.when(itself, F.col("value")).otherwise(F.col("_below")).alias("value"), itself.alias("done"), "most")
    return rows.where(~F.col("path").isin(*options.exclude)) if options.exclude else rows


def _deeper(rows: DataFrame, options: InferOptions) -> DataFrame:
    """The dicts that are left below LEVELS, taken apart inside their row to the depth wanted, or until none is left.

    ``most`` bounds an object's levels; once it has no dict left, the remaining rounds return what there is.
    """
    def one(e: Column) -> Column:
        done = e["done"] | e["path"].isin(*options.prune) if options.prune else e["done"]
        itself = F.array(F.struct(e["path"].alias("path"), e["value"].alias("value"), F.lit(True).alias("done")))
        below = F.transform(F.map_entries(_map(e["value"])), lambda m: F.struct(
            F.call_function("ltrim", F.lit("."), F.concat(e["path"], F.lit("."), m["key"])).alias("path"), m["value"].alias("value"), F.lit(False).alias("done")))
        return F.when(done, itself).otherwise(F.coalesce(below, itself))

    def level(held: Column, _: Column) -> Column:
        below = F.flatten(F.transform(held["at"], one))
        if options.exclude:
            below = F.filter(below, lambda e: ~e["path"].isin(*options.exclude))
        return F.when(held["open"], F.struct(below.alias("at"), F.exists(held["at"], lambda e: ~e["done"]).alias("open"))).otherwise(held)

    itself = F.array(F.struct("path", "value", "done"))
    levels = (F.col("most") if options.depth < 0 else F.least("most", F.lit(options.depth))) - LEVELS
    rounds = F.when(levels > 0, F.sequence(F.lit(1), levels)).otherwise(F.array().cast("array<int>"))
    apart = F.aggregate(rounds, F.struct(itself.alias("at"), F.lit(True).alias("open")), level)["at"]
    left = ~F.col("done") & (levels > 0) & _map(F.col("value")).isNotNull()
    return rows.select(F.explode(F.when(left, apart).otherwise(itself)).alias("e")).select("e.path", "e.value")


def _apart(objects: DataFrame, options: InferOptions) -> DataFrame:
    """(path, value) of everything that would be a column: dicts taken apart to the depth wanted, or until none is left."""
    rows = objects.select(F.lit("").alias("path"), "value", F.lit(False).alias("done"), "most")
    for _ in range(LEVELS if options.depth < 0 else min(options.depth, LEVELS)):
        rows = _level(rows, options)
    if not 0 <= options.depth <= LEVELS:
        rows = _deeper(rows, options)
    # What is no dict, or is not to be taken apart, is itself the value.
    return rows.select(F.when(F.col("path") == "", "value").otherwise(F.col("path")).alias("path"), "value")


def _summary(rows: DataFrame, foreign: bool, lengths: bool) -> DataFrame:
    """(path, kind, max_len, is_foreign) of each value.

    Writing JSON text costs a generator of its own per text and key in it, so it is left to numbers and what must be measured.
    """
    value, listed, keyed = F.col("value"), "array<boolean>", "struct<a:boolean>"  # any list, any dict: NULL for what is neither
    known = (F.when(F.try_variant_get(value, "$", listed).isNotNull(), "list").when(F.try_variant_get(value, "$", keyed).isNotNull(), "dict")
             .when(F.schema_of_variant(value) == "STRING", "str"))
    rows = rows.select("path", "value", known.alias("known"))
    if not lengths:
        kind = F.coalesce("known", _kind(F.col("text")))
        texts = rows.select("path", "known", F.when(F.col("known").isNull(), F.to_json("value")).alias("text"))
        return texts.select("path", kind.alias("kind"), F.lit(None).cast("bigint").alias("max_len"), F.lit(foreign).alias("is_foreign"))
    plain = F.try_variant_get(value, "$", "string")
    rows = rows.select("path", "value", "known", F.when((F.col("known") == "str") & plain.rlike(PLAIN), F.length(plain) + 2).alias("size"))
    texts = rows.select("path", "known", "size", F.when(F.col("size").isNull(), F.to_json("value")).alias("text"))
    kinds = texts.select("path", "text", "size", F.coalesce("known", _kind(F.col("text"))).alias("kind"))
    size = F.coalesce(F.col("size").cast("bigint"), _rendered_length(F.col("text"), F.col("kind")))
    return kinds.select("path", "kind", size.alias("max_len"), F.lit(foreign).alias("is_foreign"))


def leaf_summary(lines: DataFrame, options: InferOptions = InferOptions(), value: str = "value",
                 on_error: str = "fail", lengths: bool = True) -> DataFrame:
    """(path, kind, max_len, is_foreign), one row per path and kind seen, over JSON lines; computed at once and stored.

    ``lengths=False`` measures nothing: ``max_len`` is NULL, and no text is written of lists, dicts and strings.
    A line that is no JSON stops the job, or is left out with ``on_error="skip"``.
    """
    if options.source_type not in ("dict", "list", "sparse_list"):
        raise ValueError(f"unsupported source type {options.source_type!r}")
    docs = parse_lines(lines.select(F.col(value).alias("value")))
    # A document has no more levels than brackets that open a dict, and one more round finds that none is left.
    most = (F.length("value") - F.length(F.replace("value", F.lit("{"))) + 1).alias("most")
    if on_error == "skip":
        docs = docs.where(is_document(F.col("doc"))).select("doc", most)
    else:
        stop = F.raise_error(F.concat(F.lit("no JSON document: "), F.left("value", F.lit(200)))).cast("variant")
        docs = docs.select(F.when(is_document(F.col("doc")), F.col("doc")).otherwise(stop).alias("doc"), most)
    found = _summary(_apart(_sources(docs, options), options), False, lengths)
    if options.foreign:
        doc = document(F.col("doc"))
        values = F.explode(F.array(*[F.struct(F.lit(p).alias("path"), doc.get(split_path(p), "variant").alias("value")) for p in options.foreign]))
        rows = docs.select(values.alias("at")).select("at.*").where(F.col("value").isNotNull() & ~F.is_variant_null("value"))
        found = found.unionByName(_summary(rows, True, lengths))
    return stored(found.groupBy("path", "kind").agg(F.max("max_len").alias("max_len"), F.bool_or("is_foreign").alias("is_foreign")), "leaves")


def fold_types(summary: DataFrame) -> DataFrame:
    """One row per path: its merged type, longest rendering and whether it is foreign.

    int, long and float widen; anything merges with null; every other mix has the type ``mismatch``.
    """
    merged = summary.groupBy("path").agg(
        F.collect_set(F.when(F.col("kind") != "null", F.col("kind"))).alias("kinds"),  # at most seven kinds
        F.max("max_len").alias("max_len"),
        F.bool_or("is_foreign").alias("is_foreign"),
    )
    numbers = F.array(*[F.lit(k) for k in NUMBER_RANK])
    only_numbers = F.size(F.array_except("kinds", numbers)) == 0
    widest = F.lit(None).cast("string")
    for kind in NUMBER_RANK:
        widest = F.when(F.array_contains("kinds", kind), F.lit(kind)).otherwise(widest)
    merged_type = (
        F.when(F.size("kinds") == 0, F.lit("null"))
        .when(F.size("kinds") == 1, F.element_at("kinds", 1))
        .when(only_numbers, widest)
        .otherwise(F.lit("mismatch"))
    )
    return merged.select(
        "path", merged_type.alias("type"), "max_len",
        merged_type.isin("dict", "list").alias("is_json"), "is_foreign",
        F.array_join(F.array_sort("kinds"), ",").alias("kinds"),
    )


def sql_attr_of(kind: str, max_len: int | None) -> str | None:
    """The column attribute of a merged type; None for a path that only ever held null."""
    if kind == "null":
        return None
    if kind == "str":
        return f"varchar({max_len})"
    if kind in ("dict", "list"):
        return f"varchar({WIDE_VARCHAR})"
    if kind == "int" and max_len is not None and max_len <= 9:
        return "int2" if max_len <= 4 else "int4"
    fixed = {"int": "int8", "long": "int8", "float": "float8", "bool": "bool"}
    if kind not in fixed:
        raise TypeUnknown(f"no column type for {kind}")
    return fixed[kind]


def infer_table(lines: DataFrame, options: InferOptions = InferOptions(), sortkeys=(), flatten: bool = True,
                add_source_filename: bool = False, value: str = "value", on_error: str = "fail") -> TableSpec:
    """A table spec for sample lines. The folded paths, one per column, come to the driver one by one.

    A dict keyed by data makes a column per key; ``wide_dicts`` finds such dicts, to prune, exclude or unnest them.
    """
    paths = fold_types(leaf_summary(lines, options, value, on_error)).toLocalIterator()
    return build_table(paths, options.source, options.source_type, sortkeys, flatten, add_source_filename)


def wide_dicts(summary: DataFrame, more_than: int) -> DataFrame:
    """(path, n_keys) of dicts with more than so many keys over all documents: keyed by data, most likely."""
    steps = F.split("path", r"\.")
    parents = summary.select("path", F.explode(F.transform(F.sequence(F.lit(0), F.size(steps) - 1), lambda n: F.struct(
        F.array_join(F.slice(steps, 1, n), ".").alias("parent"), F.element_at(steps, n + 1).alias("key")))).alias("at"))
    keys = parents.select(F.col("at.parent").alias("path"), F.col("at.key").alias("key")).distinct()
    return keys.groupBy("path").agg(F.count("*").alias("n_keys")).where(F.col("n_keys") > more_than)


def build_table(paths, src: str = "", src_type: str = "dict", sortkeys=(), flatten: bool = True,
                add_source_filename: bool = False) -> TableSpec:
    """Columns in path order, foreign ones first; ``paths`` are rows with path, type, max_len, is_json,
    is_foreign and optionally is_mandatory."""
    table = new_table(src, src_type, sortkeys, add_source_filename)
    rows = [r if isinstance(r, dict) else r.asDict() for r in paths]
    for row in sorted(rows, key=lambda r: (not r["is_foreign"], r["path"])):
        if row["type"] == "mismatch":
            raise TypeMismatch(f"{row['path']!r} holds values of types {row.get('kinds')}")
        attr = sql_attr_of(row["type"], row["max_len"])
        if attr is None:
            continue
        if row.get("is_mandatory"):
            attr += " not null"
        name = row["path"].replace(".", "_") if flatten else row["path"]
        table = table.add_column(name, attr, row["path"], row["is_json"], row["is_foreign"])
    return table


def table_of_struct(struct: T.StructType, src: str = "", src_type: str = "dict", depth: int = -1,
                    exclude: tuple[str, ...] = (), flatten: bool = True,
                    add_source_filename: bool = False) -> TableSpec:
    """A table spec from a declared type instead of samples.

    Nullable fields are optional, others ``not null``; arrays and maps are JSON columns, structs are walked
    to ``depth`` and what lies deeper is left out.
    """
    kinds = {
        T.StringType: "str", T.VarcharType: "str", T.CharType: "str", T.BooleanType: "bool",
        T.ByteType: "int", T.ShortType: "int", T.IntegerType: "int", T.LongType: "long",
        T.FloatType: "float", T.DoubleType: "float", T.ArrayType: "list", T.MapType: "dict",
    }
    rows: list[dict] = []

    def walk(fields, path: str, left: int, optional: bool) -> None:
        if left == 0:
            return
        for f in fields:
            key = f"{path}.{f.name}".lstrip(".")
            if key in exclude:
                continue
            if isinstance(f.dataType, T.StructType):
                walk(f.dataType.fields, key, left - 1, optional or f.nullable)
                continue
            kind = kinds.get(type(f.dataType))
            if kind is None:
                raise TypeUnknown(f"no column type for {f.dataType.simpleString()}")
            width = getattr(f.dataType, "length", None) or (f.metadata or {}).get("max_len", WIDE_VARCHAR)
            rows.append({
                "path": key, "type": kind, "max_len": width, "is_json": kind in ("list", "dict"),
                "is_foreign": False, "is_mandatory": not (optional or f.nullable),
            })

    walk(struct.fields, "", depth, False)
    return build_table(rows, src, src_type, (), flatten, add_source_filename)


def merge_table(spec: SchemaSpec, name: str, table: TableSpec) -> SchemaSpec:
    """The spec with the table added or replaced, one version up."""
    if name in spec.tables:
        spec = spec.remove_table(name)
    spec = spec.add_table(name, table)
    return SchemaSpec(spec.tables, spec.version + 1)
