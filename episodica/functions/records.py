"""Nested records: paths, repacking, renaming, merging, leaves, tagged arrays.

A record is a struct of structs. Its schema is worked on by the driver, by paths such as
a/b/c; rows are rebuilt by one projection. A struct that is null is read as a struct of nulls.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def leaf_paths(schema: T.StructType, prefix: str = "") -> dict[str, T.DataType]:
    """Leaf fields of nested structs by their paths."""
    out: dict[str, T.DataType] = {}
    for f in schema.fields:
        path = f"{prefix}/{f.name}" if prefix else f.name
        out |= leaf_paths(f.dataType, path) if isinstance(f.dataType, T.StructType) else {path: f.dataType}
    return out


def at_path(path: str) -> Column:
    return F.col(".".join(f"`{p}`" for p in path.split("/")))


def leaves(df: DataFrame, root: str | None = None) -> dict[str, Column]:
    """The leaf columns of a table, or of one struct column of it, by their paths."""
    if root is None:
        return {p: at_path(p) for p in leaf_paths(df.schema)}
    kind = df.schema[root].dataType
    if not isinstance(kind, T.StructType):
        raise TypeError(f"{root} is not a record")
    return {p: at_path(f"{root}/{p}") for p in leaf_paths(kind)}


def nested(paths: Mapping[str, Column]) -> dict[str, Column]:
    """Columns of structs from leaves by path, in order of first appearance; a path that is a leaf and a branch is an error."""
    _checked(paths)
    groups: dict[str, dict[str, Column] | Column] = {}
    for path, column in paths.items():
        head, _, rest = path.partition("/")
        if rest:
            groups.setdefault(head, {})[rest] = column  # type: ignore[index]
        else:
            groups[head] = column
    built = {}
    for head, inner in groups.items():
        built[head] = F.struct(*(c.alias(k) for k, c in nested(inner).items())) if isinstance(inner, dict) else inner
    return built


def _checked(paths: Iterable[str]) -> None:
    known = set(paths)
    for path in known:
        branch = path
        while "/" in branch:
            branch = branch.rpartition("/")[0]
            if branch in known:
                raise ValueError(f"{branch} is a leaf, and a branch of {path}")


def record(paths: Mapping[str, Column]) -> Column:
    """One struct column from leaves by path."""
    return F.struct(*(c.alias(k) for k, c in nested(paths).items()))


def renamed_paths(paths: Iterable[str], patterns: Mapping[str, str | None]) -> dict[str, str]:
    """Old path -> new path: by the first pattern that matches all of a path, with back-references; None deletes, no match keeps.

    Two paths that become one, and a leaf that becomes a branch of another, are errors.
    """
    rules = [(re.compile(pattern), to) for pattern, to in patterns.items()]
    out: dict[str, str] = {}
    for path in paths:
        match = next(((m, to) for rule, to in rules if (m := rule.fullmatch(path))), None)
        to = path if match is None else None if match[1] is None else match[0].expand(match[1])
        if to is not None:
            if to in out.values():
                raise ValueError(f"two paths become {to}")
            out[path] = to
    _checked(out.values())
    return out


def rename(df: DataFrame, patterns: Mapping[str, str | None]) -> DataFrame:
    """A table whose nested fields are moved, renamed or deleted by patterns on their paths."""
    own = leaves(df)
    columns = nested({to: own[path] for path, to in renamed_paths(own, patterns).items()})
    return df.select(*(c.alias(k) for k, c in columns.items()))


def combine(left: Mapping[str, Column], right: Mapping[str, Column], f: Callable[[Column, Column], Column], strict: bool = False) -> dict[str, Column]:
    """f of the leaves that both have; leaves of the left one alone stay, those of the right one alone are an error if strict."""
    if strict and (unknown := sorted(set(right) - set(left))):
        raise ValueError(f"unknown paths {unknown}")
    return {path: f(c, right[path]) if path in right else c for path, c in left.items()}


def update(left: Mapping[str, Column], right: Mapping[str, Column]) -> dict[str, Column]:
    """The leaves of both, the right one's where both have one; a leaf gives way to a branch of the right one, and a branch to a leaf."""
    clash = lambda path: any(path.startswith(f"{r}/") or r.startswith(f"{path}/") for r in right)
    return {p: right.get(p, c) for p, c in left.items() if not clash(p)} | {p: c for p, c in right.items() if p not in left}


def repack(df: DataFrame, structure: Mapping) -> DataFrame:
    """A record rebuilt: nested mappings of names to paths become structs; a path that is not there is an error."""
    known = leaf_paths(df.schema)

    def build(v: object) -> Column:
        if isinstance(v, Mapping):
            return F.struct(*(build(x).alias(k) for k, x in v.items()))
        if v not in known and not any(k.startswith(f"{v}/") for k in known):
            raise KeyError(v)
        return at_path(str(v))

    return df.select(*(build(v).alias(k) for k, v in structure.items()))


def flat(df: DataFrame) -> DataFrame:
    """Every leaf as a column named by its path."""
    return df.select(*(at_path(p).alias(p) for p in leaf_paths(df.schema)))


def map_leaves(df: DataFrame, by_type: Mapping[type, Callable[[Column], Column]]) -> DataFrame:
    """Columns changed by the function for their type; a type without one is an error."""
    out = []
    for f in df.schema.fields:
        if type(f.dataType) not in by_type:
            raise TypeError(f"no function for {f.dataType.simpleString()}")
        out.append(by_type[type(f.dataType)](F.col(f"`{f.name}`")).alias(f.name))
    return df.select(*out)


def pairs(df: DataFrame, *keys: str) -> DataFrame:
    """keys, path and value (as text): a row for each leaf."""
    leaves = flat(df)
    entries = F.array(*(F.struct(F.lit(p).alias("path"), F.col(f"`{p}`").cast("string").alias("value")) for p in leaves.columns if p not in keys))
    return leaves.select(*keys, F.inline(entries))


def pack_array(data: Column, dtype: str, shape: tuple[int, ...]) -> Column:
    """Bytes of an array with its type and shape; object, void and complex types are refused."""
    if dtype[:1] not in "fiub":
        raise ValueError(f"unsupported type {dtype}")
    return F.struct(F.base64(data).alias("data"), F.lit(dtype).alias("dtype"), F.array(*map(F.lit, shape)).alias("shape"))


def unpack_array(packed: Column) -> Column:
    return F.unbase64(packed["data"])


