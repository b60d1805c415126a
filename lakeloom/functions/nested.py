"""Nested lists and their JSON text form.

The lists are parsed as VARIANT: list items may be of any type, and only
objects with a usable ``name`` count. VARIANT never leaves these expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeloom.functions.common import as_column, let

# From the opening bracket to the closing one, with nothing but white space around.
LIST_PATTERN = r"(?s)\A[ \t\r\n]*\[.*\][ \t\r\n]*\z"


def _type(v: Column) -> Column:
    return F.schema_of_variant(v)


def json_objects(c: Column | str) -> Column:
    """(name, job) of the objects of a JSON list; NULL when the text is no JSON list.

    A transient column of these lets several results share one parse. A list of
    objects takes the schema-bound parser, which skips all other fields; what
    that one gives up on (mixed lists, mostly) is parsed as a whole.
    """
    c = as_column(c)
    bound = F.from_json(c, "array<struct<name variant, job variant>>", {"allowSingleQuotes": "false"})
    quick = F.filter(bound, lambda v: v.isNotNull())
    items = F.try_variant_get(F.try_parse_json(c), "$", "array<variant>")
    whole = F.transform(F.filter(items, lambda v: _type(v).startswith("OBJECT")), lambda v: F.struct(
        F.try_variant_get(v, "$.name", "variant").alias("name"), F.try_variant_get(v, "$.job", "variant").alias("job")))
    return F.when(c.rlike(LIST_PATTERN), F.coalesce(quick, whole))


def _is_empty_value(v: Column) -> Column:
    """Missing, null, empty, false or zero."""
    return F.coalesce(
        F.to_json(v).isin("null", '""', "false", "[]", "{}") | (F.try_variant_get(v, "$", "double") == 0),
        F.to_json(v).isin("null", '""', "false", "[]", "{}"),
        F.lit(True))


def _name(v: Column) -> Column:
    """(used, text) of the name of one object; a used name without text is not a text."""
    return let(v["name"], lambda n: let(
        F.when(_type(n) == "STRING", F.variant_get(n, "$", "string")),
        lambda text: F.struct(F.coalesce(text != "", ~_is_empty_value(n)).alias("used"), text.alias("text"))))


def _joined_names(objects: Column, unique: bool) -> Column:
    def join(used: Column) -> Column:
        text = F.transform(used, lambda n: n["text"])
        joined = F.array_join(F.array_distinct(text) if unique else text, ", ")
        # A used name that is no text makes the whole cell unusable.
        return F.when(F.exists(used, lambda n: n["text"].isNull()), "").otherwise(joined)

    used = F.filter(F.transform(objects, _name), lambda n: n["used"])
    return F.coalesce(let(used, join), F.lit(""))


def object_names(objects: Column | str) -> Column:
    """X11 on parsed objects: their names, comma-joined; '' for NULL."""
    return _joined_names(as_column(objects), unique=False)


def object_names_by_role(objects: Column | str, jobs: Sequence[str]) -> Column:
    """X12+D3 on parsed objects: distinct names, in list order, of those whose job is one of ``jobs``."""
    def member(v: Column) -> Column:
        return let(v["job"], lambda job: F.struct(
            F.coalesce(F.when(_type(job) == "STRING", F.variant_get(job, "$", "string").isin(*jobs)),
                       F.lit(False)).alias("wanted"),
            # A job that is itself a list or an object makes the whole cell unusable.
            F.coalesce(_type(job).rlike("^(OBJECT|ARRAY)"), F.lit(False)).alias("nested"), v.alias("object")))

    def join(members: Column) -> Column:
        wanted = F.transform(F.filter(members, lambda m: m["wanted"]), lambda m: m["object"])
        return F.when(F.exists(members, lambda m: m["nested"]), "").otherwise(_joined_names(wanted, unique=True))

    return F.coalesce(let(F.transform(as_column(objects), member), join), F.lit(""))


def json_names(c: Column | str) -> Column:
    """X11: names of the objects in a JSON list, comma-joined; anything else is ''."""
    return object_names(json_objects(c))


def json_names_by_role(c: Column | str, jobs: Sequence[str]) -> Column:
    """X12+D3: distinct names, in list order, of the objects whose job is one of ``jobs``."""
    return object_names_by_role(json_objects(c), jobs)


def json_scalar(c: Column | str, path: str, kind: str) -> Column:
    """One typed value at ``path`` of a JSON text, NULL when absent or of another type."""
    return F.try_variant_get(F.try_parse_json(as_column(c)), path, kind)


def first_n(c: Column | str, n: int) -> Column:
    """the first ``n`` items of a list; a NULL list is empty."""
    return F.slice(F.coalesce(as_column(c), F.array()), 1, n)


def as_json(c: Column | str) -> Column:
    """JSON text of a list, ``[]`` for NULL."""
    return F.coalesce(F.to_json(as_column(c)), F.lit("[]"))


def objects_json(c: Column | str) -> Column:
    """JSON text of a list whose objects are JSON texts themselves, ``[]`` for NULL."""
    return F.coalesce(F.concat(F.lit("["), F.array_join(as_column(c), ",", "null"), F.lit("]")), F.lit("[]"))


def first_text(*candidates: Column | str) -> Column:
    """The first text that is neither NULL nor empty, else ''."""
    return F.coalesce(*[F.nullif(as_column(c), F.lit("")) for c in candidates], F.lit(""))
