"""Null, type and JSON coercions as column builders."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The texts read as true and as false.
TRUE_TEXTS = ("true", "t", "1", "yes", "y")
FALSE_TEXTS = ("false", "f", "0", "no", "n")

# Code points counted as surrounding white space.
WHITESPACE = "".join(
    map(
        chr,
        [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680]
        + list(range(0x2000, 0x200B))
        + [0x202F, 0x205F, 0x3000],
    )
)


def strip(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITESPACE))


def text_or(col: Column, default: str = "") -> Column:
    """the text of a value, or a default when it is null."""
    return F.coalesce(col.cast("string"), F.lit(default))


def blank_to_null(col: Column) -> Column:
    """F9"""
    return F.nullif(col, F.lit(""))


# Typed coercions are SQL texts: they are used for dozens of columns at once, and the
# same rule can then stand in a select list.


def int_sql(v: str) -> str:
    """integer of a JSON value; texts must hold an integer, numbers must be whole."""
    number = f"try_variant_get({v}, '$', 'double')"
    return f"""CASE
      WHEN schema_of_variant({v}) = 'BIGINT' THEN try_variant_get({v}, '$', 'bigint')
      WHEN schema_of_variant({v}) = 'STRING' THEN try_cast(try_variant_get({v}, '$', 'string') AS BIGINT)
      WHEN schema_of_variant({v}) = 'BOOLEAN' THEN CAST(try_variant_get({v}, '$', 'boolean') AS BIGINT)
      WHEN schema_of_variant({v}) RLIKE '^(DECIMAL|DOUBLE|FLOAT)' AND {number} = floor({number})
        THEN try_cast({number} AS BIGINT) END"""


def bool_sql(v: str) -> str:
    """boolean of a JSON value; whole-number tokens count as `!= 0`."""
    text = f"lower(regexp_replace(try_variant_get({v}, '$', 'string'), '(?U)^\\\\s+|\\\\s+$', ''))"
    texts = [", ".join(f"'{t}'" for t in group) for group in (TRUE_TEXTS, FALSE_TEXTS)]
    return f"""CASE
      WHEN schema_of_variant({v}) = 'BOOLEAN' THEN try_variant_get({v}, '$', 'boolean')
      WHEN schema_of_variant({v}) = 'BIGINT' THEN try_variant_get({v}, '$', 'bigint') <> 0
      WHEN schema_of_variant({v}) = 'STRING' AND {text} IN ({texts[0]}) THEN true
      WHEN schema_of_variant({v}) = 'STRING' AND {text} IN ({texts[1]}) THEN false END"""


def text_int_sql(text: str, json: str, path: str) -> str:
    """F2 from the text of a value; its JSON type is looked up only for texts that are no
    integer (`3.0`, `true`), at `path` (such as `a.b`) of the JSON text."""
    return f"coalesce(try_cast({text} AS BIGINT), CASE WHEN {text} IS NOT NULL THEN {int_sql(typed_at(json, path))} END)"


def text_bool_sql(text: str, json: str, path: str) -> str:
    """F3 from the text of a value; the common texts mean the same whatever their JSON type."""
    return f"""CASE WHEN {text} IS NULL THEN NULL WHEN {text} = 'true' THEN true WHEN {text} = 'false' THEN false
      ELSE {bool_sql(typed_at(json, path))} END"""


def typed_at(json: str, path: str) -> str:
    *outer, leaf = path.split(".")
    ddl = f"{leaf} VARIANT"
    if outer:
        ddl = f"{outer[0]} STRUCT<{leaf}: VARIANT>"
    return f"from_json({json}, '{ddl}').{path}"


def int_of(path: str) -> Column:
    return F.expr(int_sql(path))


def bool_of(path: str) -> Column:
    return F.expr(bool_sql(path))


def variant_at(json_path: str, key: str) -> str:
    """The value under a top-level key of a JSON text column, keeping its JSON type."""
    return f"from_json({json_path}, '{key} VARIANT').{key}"


def json_int(json_path: str, key: str) -> Column:
    """integer under a key; null when the object is null."""
    return int_of(variant_at(json_path, key))


def json_bool(json_path: str, key: str) -> Column:
    return bool_of(variant_at(json_path, key))


def json_field(json_text: Column, key: str) -> Column:
    """text under a key; null when missing, JSON null or not an object."""
    return F.from_json(json_text, f"`{key}` STRING").getField(key)


def json_has_key(json_text: Column, key: str) -> Column:
    """true also for a key whose value is null."""
    return F.coalesce(F.array_contains(F.json_object_keys(json_text), key), F.lit(False))


def json_items(json_text: Column) -> Column:
    """elements of a JSON array as JSON texts; empty for anything else."""
    items = F.from_json(json_text, "array<string>")
    return F.coalesce(F.when(F.ltrim(json_text).startswith("["), items), F.array().cast("array<string>"))


def json_pairs(json_text: Column) -> Column:
    """F8: entries of a JSON object as (key, JSON text) structs."""
    return F.map_entries(F.from_json(json_text, "map<string,string>"))


def json_text(json_text_col: Column) -> Column:
    """compact JSON text in source key order."""
    return F.get_json_object(json_text_col, "$")


def list_sql(fast: str, raw: str, item_type: str, key: str | None = None) -> str:
    """A list read together with its payload.

    Arrays that mix objects with other values come out of the payload as null in one go;
    only those are read again, element by element, from `raw` (or its `key`).
    """
    if key is None:
        there, array = f"startswith({raw}, '[')", raw
    else:
        there, array = f"contains({raw}, '\"{key}\":[')", f"from_json({raw}, '{key} STRING').{key}"
    each = f"transform(from_json({array}, 'array<string>'), item -> from_json(item, '{item_type}'))"
    return f"CASE WHEN {fast} IS NOT NULL THEN {fast} WHEN {there} THEN {each} END"


def listing_sql(items: str, sep: str = ";") -> str:
    """A4/P10: joined non-blank texts, null when there are none.

    Nulls are skipped by the join and blanks are removed, so a blank result means an
    empty list.
    """
    return f"nullif(array_join(array_remove({items}, ''), {quote_sql(sep)}), '')"


def join_all_sql(items: str, sep: str = ";") -> str:
    """Joined texts that keep blanks and read nulls as blanks."""
    return f"CASE WHEN size({items}) > 0 THEN array_join({items}, {quote_sql(sep)}, '') END"


def quote_sql(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def non_blank(items: Column) -> Column:
    return F.filter(items, lambda v: v != "")


def join_list(items: Column, sep: str = ";") -> Column:
    """A4 for a column."""
    return F.when(F.size(items) > 0, F.array_join(items, sep))


def json_string(text: Column) -> Column:
    """A text as a quoted JSON string."""
    wrapped = F.to_json(F.struct(text.alias("k")))
    return F.substr(wrapped, F.lit(6), F.length(wrapped) - 6)


def json_object(pairs: list[tuple[str, Column]]) -> Column:
    """Object text from (key, JSON text) pairs; pairs with a null text are left out."""
    fields = [F.when(text.isNotNull(), F.concat(F.lit(f'"{key}":'), text)) for key, text in pairs]
    return F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}"))
