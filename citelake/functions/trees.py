"""Navigation in JSON trees held as variants."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def node(v: Column, path: str) -> Column:
    """The subtree at ``path``, NULL when missing."""
    return F.try_variant_get(v, f"$.{path}", "variant")


def leaf(v: Column, path: str) -> Column:
    """The scalar at ``path`` as text, NULL when missing."""
    return F.try_variant_get(v, f"$.{path}", "string")


def shape(v: Column, ddl: str) -> Column:
    """Many paths in one pass: ``v`` as a struct, NULL where a part is missing or
    of another kind. A field of type variant keeps its subtree as it is.
    """
    return F.try_variant_get(v, "$", ddl)


def held_once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def one_or_many(v: Column) -> Column:
    """A group that is an array when it repeats and a bare value when it does not;
    an empty array when it is missing.
    """
    def members_of(v: Column) -> Column:
        single = F.when(v.isNotNull() & ~F.is_variant_null(v), F.array(v))
        none = F.array().cast("array<variant>")
        return F.coalesce(F.try_variant_get(v, "$", "array<variant>"), single, none)

    return held_once(v, members_of)


def members(v: Column, path: str) -> Column:
    """All members of the group at ``path``."""
    return one_or_many(node(v, path))


def _with_held(v: Column, kind: str, use: Callable[[Column, Column], Column]) -> Column:
    """``use(v, held)``, where ``held`` is ``v`` as a map or an array, NULL if it is neither."""
    return held_once(v, lambda v: held_once(F.try_variant_get(v, "$", kind), lambda held: use(v, held)))


def changed(v: Column, name: str, change: Callable[[Column], Column]) -> Column:
    """Object ``v`` with ``change`` applied to its member ``name``; as it is without such a member."""
    def use(v: Column, held: Column) -> Column:
        new = F.transform_values(held, lambda k, x: F.when(k == name, change(x)).otherwise(x))
        return F.when(F.map_contains_key(held, name), F.to_variant_object(new)).otherwise(v)

    return _with_held(v, "map<string,variant>", use)


def with_member(v: Column, name: str, default: str = "{}") -> Column:
    """Object ``v`` with member ``name``: the JSON ``default`` if it has none, be it null; anything else as it is."""
    def use(v: Column, held: Column) -> Column:
        more = F.map_concat(held, F.create_map(F.lit(name), F.parse_json(F.lit(default))))
        return F.when(held.isNotNull() & ~F.map_contains_key(held, name), F.to_variant_object(more)).otherwise(v)

    return _with_held(v, "map<string,variant>", use)


def changed_members(
    v: Column, change: Callable[[Column, Column], Column], in_list: Callable[[Column], Column] = lambda x: x
) -> Column:
    """``change(member, place)`` for the members of an array, each after ``in_list``, or for a bare value with place 0."""
    def use(v: Column, held: Column) -> Column:
        each = F.to_variant_object(F.transform(held, lambda x, i: change(in_list(x), i)))
        return F.when(held.isNotNull(), each).otherwise(change(v, F.lit(0)))

    return _with_held(v, "array<variant>", use)


def with_texts(v: Column, texts: dict[str, Column]) -> Column:
    """Object ``v`` with these texts as members; a NULL text leaves ``v`` as it was there."""
    pairs = F.filter(
        F.array(*[F.struct(F.lit(k).alias("key"), t.alias("value")) for k, t in texts.items()]),
        lambda p: p["value"].isNotNull(),
    )

    def use(v: Column, held: Column) -> Column:
        def merged(pairs: Column) -> Column:
            names = F.transform(pairs, lambda p: p["key"])
            new = F.map_from_entries(F.transform(pairs, lambda p: F.struct(p["key"], p["value"].cast("variant"))))
            kept = held_once(names, lambda names: F.map_filter(held, lambda k, x: ~F.array_contains(names, k)))
            return F.to_variant_object(F.map_concat(kept, new))

        return F.when(held.isNotNull(), held_once(pairs, merged)).otherwise(v)

    return _with_held(v, "map<string,variant>", use)


def shaped_members(v: Column, ddl: str) -> Column:
    """The members of group ``v``, each as a struct."""
    return F.transform(one_or_many(v), lambda m: shape(m, ddl))
