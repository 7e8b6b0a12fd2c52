"""JSON held in text columns: parse, navigate, build, flatten and update."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scalars import ColumnOrName, bound, col


def parse(c: ColumnOrName) -> Column:
    """Variant value of JSON text; NULL when the text is not valid JSON."""
    return F.try_parse_json(col(c))


def field(c: ColumnOrName, key: str, kind: str = "string") -> Column:
    """A top-level key of JSON text; NULL for invalid JSON or a missing key."""
    return F.try_variant_get(parse(c), f"$['{key}']", kind)


def is_object(c: ColumnOrName) -> Column:
    return F.coalesce(F.schema_of_variant(parse(c)).startswith("OBJECT"), F.lit(False))


# Fixed value: a fenced block that may hold a JSON object.
FENCED_OBJECT = r"(?is)```(?:json)?\s*(\{.*?\})\s*```"


def json_part(c: ColumnOrName) -> Column:
    """The JSON a model answer carries: the text itself when it is valid JSON, else the first
    fenced block that is, else NULL."""
    text = col(c)
    blocks = F.regexp_extract_all(text, F.lit(FENCED_OBJECT), F.lit(1))
    return F.when(parse(text).isNotNull(), text).otherwise(F.get(F.filter(blocks, lambda b: parse(b).isNotNull()), 0))


def result_or_text(c: ColumnOrName) -> Column:
    """``json_part``, with the raw text as the fallback."""
    return F.coalesce(json_part(c), col(c))


def task_array(c: ColumnOrName, element: T.DataType) -> Column:
    """Stage output as an array of ``element``: an object that holds ``tasks`` gives that list,
    an array stays, a single object is wrapped."""
    one = element.simpleString()

    def read(v: Column) -> Column:
        single = F.try_variant_get(v, "$", one)
        return F.coalesce(
            F.try_variant_get(v, "$.tasks", f"array<{one}>"), F.try_variant_get(v, "$", f"array<{one}>"),
            F.when(single.isNotNull(), F.array(single)),
        )

    return bound(parse(c), read)


def discover_schema(df: DataFrame, column: str) -> T.DataType:
    """Schema of the JSON in a column, found by one distributed pass over it.

    Runs a job; only the merged schema text reaches the driver. Pass an explicit schema to
    the flatten functions to avoid the pass.
    """
    text = df.select(F.schema_of_variant_agg(parse(column)).alias("s")).first()["s"]
    # only the type names change: a key of that name is followed by a colon or stands in backticks
    ddl = re.sub(r"`(?:[^`]|``)*`|\bOBJECT(?=<)", lambda m: m[0] if m[0][0] == "`" else "STRUCT", text)
    return T.DataType.fromDDL(ddl)


def _case_clash(dtype: T.DataType) -> bool:
    """Whether some object has keys that differ in case only."""
    if isinstance(dtype, T.StructType):
        names = [f.name.lower() for f in dtype.fields]
        return len(set(names)) < len(names) or any(_case_clash(f.dataType) for f in dtype.fields)
    return isinstance(dtype, T.ArrayType) and _case_clash(dtype.elementType)


class _Path:
    """A place in a variant value, read with the exact case of its keys."""

    def __init__(self, root: Column, path: str = "$"):
        self.root, self.path = root, path

    def __getitem__(self, name: str) -> _Path:
        quoted = name.replace("\\", "\\\\").replace("'", "\\'")
        return _Path(self.root, f"{self.path}['{quoted}']")

    def at(self, i: int) -> _Path:
        return _Path(self.root, f"{self.path}[{i}]")

    def read(self, dtype: T.DataType) -> Column:
        # what holds keys that differ in case only stays a variant
        return F.try_variant_get(self.root, self.path, "variant" if _case_clash(dtype) else dtype.simpleString())


def _at(value: Column | _Path, i: int):
    return value.at(i) if isinstance(value, _Path) else F.get(value, i)


def _leaves(dtype: T.DataType, value: Column, name: str, sep: str, depth: int, sizes: dict | None):
    if depth > 0 and isinstance(dtype, T.StructType):
        for f in dtype.fields:
            yield from _leaves(f.dataType, value[f.name], f"{name}{sep}{f.name}" if name else f.name, sep,
                               depth - 1, sizes)
    elif depth > 0 and sizes is not None and isinstance(dtype, T.ArrayType):
        for i in range(sizes.get(name, 0)):
            yield from _leaves(dtype.elementType, _at(value, i), f"{name}{sep}{i}", sep, depth - 1, sizes)
    else:
        yield name, dtype, value


def _array_sizes(df: DataFrame, dtype: T.DataType, value: Column, name: str, sep: str, depth: int) -> dict:
    """Longest length of every array below ``dtype``: one aggregation per nesting level."""
    sizes: dict[str, int] = {}
    while todo := list(_open_arrays(dtype, value, name, sep, depth, sizes)):
        arrays = [v.read(T.ArrayType(T.VariantType())) if isinstance(v, _Path) else v for _, v in todo]
        row = df.agg(*[F.max(F.size(v)).alias(f"m{i}") for i, v in enumerate(arrays)]).first()
        sizes.update({n: max(row[f"m{i}"] or 0, 0) for i, (n, _) in enumerate(todo)})
    return sizes


def _open_arrays(dtype, value, name, sep, depth, sizes):
    if depth <= 0:
        return
    if isinstance(dtype, T.StructType):
        for f in dtype.fields:
            yield from _open_arrays(f.dataType, value[f.name], f"{name}{sep}{f.name}" if name else f.name,
                                    sep, depth - 1, sizes)
    elif isinstance(dtype, T.ArrayType):
        if name not in sizes:
            yield name, value
        else:
            for i in range(sizes[name]):
                yield from _open_arrays(dtype.elementType, _at(value, i), f"{name}{sep}{i}", sep,
                                        depth - 1, sizes)


def flatten(
    df: DataFrame,
    column: str,
    schema: T.DataType | str | None = None,
    prefix: bool = True,
    sep: str = "_",
    max_depth: int = 10,
    null_as_empty: bool = True,
    flatten_arrays: bool = False,
    array_sizes: dict[str, int] | None = None,
) -> DataFrame:
    """Add one column per leaf of the JSON in ``column``.

    Names are the path joined by ``sep``, after the column name when ``prefix``. Arrays stay
    one column unless ``flatten_arrays``, which gives one column per index up to the longest
    array seen (or up to ``array_sizes``, which saves the pass that finds it). With
    ``null_as_empty`` a missing text leaf is ``''``. Nothing is lost where names clash, with an
    existing column or with each other, in any case: the later one gets a number, ``name_2`` and
    so on. A column without any valid JSON adds no column.
    """
    if isinstance(schema, str):
        schema = T.DataType.fromDDL(schema)
    source = df.schema[column].dataType
    parsed = df
    if isinstance(source, T.StringType):
        schema = schema or discover_schema(df, column)
        if not isinstance(schema, (T.StructType, T.ArrayType)):
            return df
        # a column of its own, or every leaf would parse the text again
        if _case_clash(schema):
            parsed, value = df.withColumn("_parsed", parse(column)), _Path(F.col("_parsed"))
        else:
            parsed, value = df.withColumn("_parsed", F.from_json(col(column), schema)), F.col("_parsed")
    else:
        schema, value = source, col(column)
    name = column if prefix else ""
    sizes = None
    if flatten_arrays:
        sizes = dict(array_sizes) if array_sizes else _array_sizes(parsed, schema, value, name, sep, max_depth)
    new, used = {}, {c.lower() for c in df.columns}
    for leaf, dtype, expr in _leaves(schema, value, name, sep, max_depth, sizes):
        if isinstance(expr, _Path):
            expr = expr.read(dtype)
        if null_as_empty and isinstance(dtype, T.StringType):
            expr = F.coalesce(expr, F.lit(""))
        free, number = leaf, 1
        while free.lower() in used:
            number += 1
            free = f"{leaf}{sep}{number}"
        used.add(free.lower())
        new[free] = expr
    return parsed.withColumns(new).drop("_parsed")


def with_image_descriptions(pages: ColumnOrName, descriptions: ColumnOrName) -> Column:
    """Rewrite an array of page structs: ``description`` on every image, ``markdown_alt`` on
    every page, all other fields kept. ``descriptions`` maps image id to text."""
    from .text import alt_text, describe_images

    def page(p: Column, texts: Column) -> Column:
        images = F.transform(
            p["images"], lambda im: im.withField("description", F.element_at(texts, im["id"]))
        )
        known = F.transform(
            F.filter(p["images"], lambda im: F.map_contains_key(texts, im["id"])),
            lambda im: F.struct(im["id"].alias("id"), alt_text(F.element_at(texts, im["id"])).alias("alt")),
        )
        return p.withField("images", images).withField("markdown_alt", describe_images(p["markdown"], known))

    return bound(col(descriptions), lambda texts: F.transform(col(pages), lambda p: page(p, texts)))


def binding_rows(df: DataFrame, column: str, names: list[str]) -> DataFrame:
    """Result-set JSON (``results.bindings`` of ``{name: {value}}``) to one row per binding,
    ``''`` for a name a binding lacks."""
    cell = T.StructType([T.StructField("value", T.StringType())])
    binding = T.StructType([T.StructField(n, cell) for n in names])
    schema = T.StructType([
        T.StructField("results", T.StructType([T.StructField("bindings", T.ArrayType(binding))]))
    ])
    others = [c for c in df.columns if c != column]
    exploded = df.select(*map(col, others), F.explode(F.from_json(col(column), schema)["results"]["bindings"]).alias("_b"))
    return exploded.select(*map(col, others), *[F.coalesce(F.col("_b")[n]["value"], F.lit("")).alias(n) for n in names])
