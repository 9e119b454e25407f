"""Identifier rules: stream ids, target schema, table and column names."""

from __future__ import annotations

import itertools
import re

# Separator for flattened paths and the identifier length limit.
SEPARATOR = "__"
IDENTIFIER_LIMIT = 63

# camelCase -> snake_case rewrite rules, applied in this order.
INFLECT_RULES = [
    (r"([A-Z]+)_([A-Z][a-z])", r"\1__\2"),
    (r"([a-z0-9])_([A-Z])", r"\1__\2"),
    (r"([A-Z]+)([A-Z][a-z])", r"\1_\2"),
    (r"([a-z0-9])([A-Z])", r"\1_\2"),
]


class TargetSchemaNotFound(ValueError):
    pass


def inflect(name: str) -> str:
    for pattern, repl in INFLECT_RULES:
        name = re.sub(pattern, repl, name)
    return name.replace("-", "_").lower()


def initials(segment: str) -> str:
    """Short form of a path segment: its capitals, with the first character of
    every word counted as one, if there are at least two; else three characters."""
    opens = {m.end() - 1 for m in re.finditer(r"(?:^|[_\-\s])[^_\-\s]", segment)}
    capitals = "".join(filter(str.isupper, "".join(c.upper() if i in opens else c for i, c in enumerate(segment))))
    return capitals if len(capitals) > 1 else segment[:3]


def join_path(parts: list[str], limit: int | None = IDENTIFIER_LIMIT) -> str:
    """The path with the fewest leading segments shortened (never the last) that
    stays below the limit; if none does, the shortest one cut to the limit."""
    short = [initials(p) for p in parts]
    spelt = [SEPARATOR.join(short[:k] + list(parts[k:])) for k in range(len(parts))]
    if limit is None:
        return spelt[0]
    return next((name for name in spelt if len(name) < limit), spelt[-1][:limit])


def unique_names(names: list[str], limit: int | None = IDENTIFIER_LIMIT) -> list[str]:
    """The names in order, each one already taken replaced by its first free
    numbered form (`__1`, `__2`, ...) within the limit."""
    taken: dict[str, None] = {}
    for name in names:
        marks = (f"{SEPARATOR}{n}" for n in itertools.count(1))
        numbered = (name[:None if limit is None else limit - len(mark)] + mark for mark in marks)
        taken[next(form for form in itertools.chain([name], numbered) if form not in taken)] = None
    return list(taken)


# A stream id is [[catalog-]schema-]table: at most this many leading parts name the place.
PLACE_PARTS = 2


def split_stream(stream: str) -> tuple[str | None, str | None, str]:
    """stream id -> (catalog, schema segment, table segment)."""
    parts = stream.split("-")
    cut = min(PLACE_PARTS, len(parts) - 1)
    catalog, schema = [None] * (PLACE_PARTS - cut) + parts[:cut]
    return catalog, schema, "_".join(parts[cut:])


def table_name(raw: str) -> str:
    return re.sub(r"[.\-]", "_", raw).lower()


def target_schema(schema_segment: str | None, default: str | None, mapping: dict) -> str:
    mapped = (mapping or {}).get(schema_segment) or {}
    found = mapped.get("target_schema") or default
    if not found:
        raise TargetSchemaNotFound(f"stream segment {schema_segment!r} has no entry in schema_mapping "
                                   "and there is no default_target_schema")
    return found
