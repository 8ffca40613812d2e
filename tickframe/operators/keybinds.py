"""Key bindings as map columns: direction, precedence, patches, inversion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def looks_semantic(name: Column, vocabulary: list[str]) -> Column:
    """An action's name rather than a key's: known, or with two underscores at least."""
    return name.isin(vocabulary) | (F.length(name) - F.length(F.replace(name, F.lit("_"), F.lit(""))) >= 2)


def semantic_to_literal(binding: Column, vocabulary: list[str]) -> Column:
    """map<string, array<string>> from actions to keys, turned round if all its values are actions."""
    values = F.flatten(F.map_values(binding))
    inverted = (F.size(binding) > 0) & F.forall(values, lambda x: looks_semantic(x, vocabulary))
    keys = F.map_keys(binding)
    turned = F.map_from_entries(F.transform(F.array_distinct(values), lambda s: F.struct(s, F.filter(keys, lambda k: F.array_contains(F.element_at(binding, k), s)))))
    return F.when(inverted, turned).otherwise(binding)


def resolved(from_file: Column, usable: Column, builtin: Column) -> Column:
    """The recording's own binding if it is usable, else the game's built-in one, else an empty one."""
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<array<string>>"))
    return F.coalesce(F.when(usable & (F.size(from_file) > 0), from_file), builtin, none)


def patched(binding: Column, patch: Column) -> Column:
    """binding with the entries of patch, which win."""
    kept = F.filter(F.map_entries(binding), lambda e: ~F.array_contains(F.map_keys(patch), e.key))
    return F.map_from_entries(F.concat(kept, F.map_entries(patch)))


def uncovered(seen: Column, binding: Column) -> Column:
    """Keys that were seen and that no entry of binding (keys to actions) has."""
    return F.array_sort(F.array_except(seen, F.map_keys(binding)))


def covering(binding: Column, seen: Column) -> Column:
    """binding (keys to actions) with an empty entry for each key that was seen and that it lacks."""
    more = F.transform(uncovered(seen, binding), lambda k: F.struct(k.alias("key"), F.array().cast("array<string>").alias("value")))
    return F.map_from_entries(F.concat(F.map_entries(binding), more))


def inverted(bindings: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """keys, literal, semantics: from rows (keys, place, semantic, literal) in the order of place, once each; literals only seen have none."""
    rows = bindings.select(*keys, "literal", F.struct("place", "semantic").alias("s")).unionByName(seen.select(*keys, "literal"), allowMissingColumns=True)
    ordered = F.transform(F.array_sort(F.collect_set("s")), lambda s: s.semantic)
    return rows.groupBy(*keys, "literal").agg(F.array_distinct(ordered).alias("semantics"))
