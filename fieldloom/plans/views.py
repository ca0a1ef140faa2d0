"""Text views of a coordinate (owner, field): what is searched."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldloom.functions.text import or_else

VIEWS = ("coordinate", "signature", "semantic", "sdl")
LEGACY = {"typename": "coordinate", "field_paths": "signature"}


def parse_views(names: str) -> list[str]:
    """Comma-separated view names, once each in order; legacy names are mapped, unknown ones refused."""
    out = []
    for name in (x.strip().lower() for x in names.split(",")):
        if name:
            view = LEGACY.get(name, name)
            if view not in VIEWS:
                raise ValueError(f"unknown view {name!r}; one of {', '.join(VIEWS)}")
            if view not in out:
                out.append(view)
    return out or ["semantic"]


def coordinate(owner: Column, field: Column) -> Column:
    return F.btrim(F.concat_ws(".", owner, field), F.lit("."))


def arguments(args: Column | None) -> Column:
    return F.lit("") if args is None else F.array_join(F.transform(args, lambda a: F.concat(a["name"], F.lit(": "), a["type_name"])), ", ")


def _bracketed(args: Column | None) -> Column:
    return F.lit("") if args is None else F.when(F.size(args) > 0, F.concat(F.lit("("), arguments(args), F.lit(")"))).otherwise("")


def signature(owner: Column, field: Column, returns: Column, args: Column | None = None) -> Column:
    return F.concat(owner, F.lit("."), field, _bracketed(args), F.lit(": "), returns)


def sdl(owner: Column, field: Column, returns: Column, args: Column | None = None) -> Column:
    return F.concat(F.lit("type "), owner, F.lit(" {\n  "), field, _bracketed(args), F.lit(": "), returns, F.lit("\n}"))


# fixed values: the wording of the semantic view
SEMANTIC = "GraphQL field %s.%s. Owner type: %s. Returns: %s. Arguments: names %s; types %s. Field description: %s Owner description: %s Aliases: %s."
NONE, UNDESCRIBED = "none", "No description provided."


def semantic(owner: Column, field: Column, returns: Column, description: Column, owner_description: Column, args: Column | None = None) -> Column:
    part = lambda key: F.lit(NONE) if args is None else or_else(F.array_join(F.transform(args, lambda a: a[key]), ", "), F.lit(NONE))
    said = lambda c: or_else(F.trim(c), F.lit(UNDESCRIBED))
    known = F.array_sort(F.array_distinct(F.filter(F.array(F.replace(field, F.lit("_"), F.lit(" ")), F.lower(field)), lambda x: x != "")))
    return F.format_string(SEMANTIC, owner, field, owner, returns, part("name"), part("type_name"), said(description), said(owner_description), F.array_join(known, ", "))


def keywords(*parts: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.filter(F.transform(F.array(*parts), lambda x: F.lower(x)), lambda x: x.isNotNull() & (x != "")))), " | ")


def positive_texts(columns: dict[str, Column], names: list[str]) -> Column:
    """The texts of the views asked for, in order, without blank ones. columns: view -> its text."""
    return F.filter(F.array(*(F.trim(F.coalesce(columns[parse_views(n)[0]], F.lit(""))) for n in names)), lambda x: x != "")
