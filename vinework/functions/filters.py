"""Dictionary filters over document metadata, compiled to one Column.

``metadata`` is a JSON text column or a ``map<string,string>`` holding JSON
scalars. All comparisons follow SQL's three-valued logic, so a missing key or
a JSON null drops the row, also for ``$ne`` and ``$nin``.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: deepest nesting of $and / $or that is accepted.
MAX_DEPTH = 10
NUMERIC = "decimal(38,12)"
# Beginnings of the two messages.
TOO_DEEP = "Filter nesting exceeds maximum depth of"
UNKNOWN_OPERATOR = "Unsupported filter operator"


def as_text(value: Any) -> str:
    """Filter value as it reads in JSON text: booleans are true / false."""
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (dict, list)):
        return json.dumps(value)
    return str(value)


class MetadataFilter:
    """Compiles filter dictionaries against one metadata column.

    ``promoted`` maps a metadata key to a typed column that holds the same
    value. Such keys are compared on the typed column, which reaches the
    Parquet reader as a pushed filter and needs no JSON parsing; presence and
    text patterns are still judged on the bag, so promotion changes no answer.
    Conditions on promoted keys stay conjuncts of their own; all others of one
    filter share a single parse of the text.
    Keys beside ``$and`` or ``$or`` are ignored; ``strict=True`` raises instead.
    ``on_bad='null'`` drops non-numeric values in numeric comparisons, where
    the default raises.
    """

    def __init__(
        self,
        metadata: Column | str = "metadata",
        *,
        is_map: bool = False,
        promoted: Mapping[str, Column | str] | None = None,
        strict: bool = False,
        on_bad: str = "error",
    ) -> None:
        column = F.col(metadata) if isinstance(metadata, str) else metadata
        self.is_map = is_map
        self.bag = column if is_map else F.from_json(column, "map<string,string>")
        self.promoted = {k: F.col(c) if isinstance(c, str) else c for k, c in (promoted or {}).items()}
        self.strict = strict
        if on_bad not in ("error", "null"):
            raise ValueError("on_bad must be 'error' or 'null'")
        self.on_bad = on_bad

    def compile(self, spec: Mapping[str, Any] | None) -> Column | None:
        """Column for ``spec``, or None when there is nothing to filter."""
        if not spec:
            return None
        parsed = [part for part in self._parts(spec, 0) if self._reads(*part)]
        typed = [self._all_of(*part, self.bag) for part in self._parts(spec, 0) if not self._reads(*part)]
        if not self.is_map and sum(self._reads(*part) for part in parsed) > 1:
            # The element of the array is computed once, whatever the number of conditions on it.
            judge = lambda bag: _fold([self._all_of(*part, bag) for part in parsed], lambda a, b: a & b)
            return _fold([*typed, F.exists(F.array(self.bag), judge)], lambda a, b: a & b)
        return _fold([*typed, *(self._all_of(*part, self.bag) for part in parsed)], lambda a, b: a & b)

    def _parts(self, spec: Mapping[str, Any], depth: int) -> list[tuple[Mapping[str, Any], int]]:
        """The conjuncts of a filter with their depths."""
        if depth > MAX_DEPTH or not spec:
            return [(spec, depth)]
        if "$and" in spec and spec["$and"] and not (self.strict and len(spec) > 1):
            return [part for sub in spec["$and"] for part in self._parts(sub, depth + 1)]
        if "$and" in spec or "$or" in spec:
            return [(spec, depth)]
        return [({key: wanted}, depth) for key, wanted in spec.items()]

    def _reads(self, spec: Mapping[str, Any], depth: int) -> int:
        """Number of conditions that read the bag itself."""
        if depth > MAX_DEPTH:
            return 0
        for logic in ("$and", "$or"):
            if logic in spec:
                return sum(self._reads(sub, depth + 1) for sub in spec[logic])
        found = 0
        for key, wanted in spec.items():
            for op in wanted if isinstance(wanted, Mapping) else ("$eq",):
                found += key not in self.promoted or op in ("$exists", "$like", "$ilike")
        return found

    def _all_of(self, spec: Mapping[str, Any], depth: int, bag: Column) -> Column:
        if depth > MAX_DEPTH:
            raise ValueError(f"{TOO_DEEP} {MAX_DEPTH}.")
        for logic in ("$and", "$or"):
            if logic in spec:
                return self._logic(logic, spec, depth, bag)
        if not spec:
            raise ValueError("empty filter inside a filter")
        terms: list[Column] = []
        for key, wanted in spec.items():
            if isinstance(wanted, Mapping):
                if not wanted:
                    raise ValueError(f"no operator given for {key!r}")
                terms += [self._compare(key, op, value, bag) for op, value in wanted.items()]
            else:
                terms.append(self._compare(key, "$eq", wanted, bag))
        return _fold(terms, lambda a, b: a & b)

    def _logic(self, logic: str, spec: Mapping[str, Any], depth: int, bag: Column) -> Column:
        if self.strict and len(spec) > 1:
            raise ValueError(f"keys beside {logic} would be ignored; put them inside it")
        branches = [self._all_of(sub, depth + 1, bag) for sub in spec[logic]]
        if not branches:
            raise ValueError(f"{logic} needs at least one filter")
        return _fold(branches, (lambda a, b: a & b) if logic == "$and" else (lambda a, b: a | b))

    def _compare(self, key: str, op: str, value: Any, bag: Column) -> Column:
        typed = self.promoted.get(key)
        if op == "$exists":
            present = F.coalesce(F.map_contains_key(bag, F.lit(key)), F.lit(False))
            return present if value else ~present
        text = F.try_element_at(bag, F.lit(key)) if typed is None else typed.cast("string")
        if op in ("$eq", "$ne"):
            same = text == as_text(value) if typed is None else typed == F.lit(value)
            return same if op == "$eq" else ~same
        if op in ("$in", "$nin"):
            # A null left side must stay null, also against an empty list.
            if not value:
                found = F.when(text.isNotNull(), F.lit(False))
            elif typed is None:
                found = text.isin([as_text(v) for v in value])
            else:
                found = typed.isin(list(value))
            return found if op == "$in" else ~found
        if op in ("$like", "$ilike"):
            written = F.try_element_at(bag, F.lit(key))
            return written.like(as_text(value)) if op == "$like" else written.ilike(as_text(value))
        if op not in ("$lt", "$lte", "$gt", "$gte", "$between"):
            raise ValueError(f"{UNKNOWN_OPERATOR}: {op!r}")
        if typed is not None:
            number, bound = typed, F.lit
        else:
            number = text.cast(NUMERIC) if self.on_bad == "error" else text.try_cast(NUMERIC)
            bound = _decimal
        if op == "$between":
            low, high = value
            return number.between(bound(low), bound(high))
        if op == "$lt":
            return number < bound(value)
        if op == "$lte":
            return number <= bound(value)
        if op == "$gt":
            return number > bound(value)
        return number >= bound(value)


def _decimal(value: Any) -> Column:
    return F.lit(as_text(value)).cast(NUMERIC)


def _fold(terms: Sequence[Column], combine) -> Column:
    result = terms[0]
    for term in terms[1:]:
        result = combine(result, term)
    return result


def metadata_filter(spec: Mapping[str, Any] | None, metadata: Column | str = "metadata", **options: Any) -> Column | None:
    """Shorthand for ``MetadataFilter(metadata, **options).compile(spec)``."""
    return MetadataFilter(metadata, **options).compile(spec)


def equals_all(values: Mapping[str, Any]) -> Column | None:
    """Typed equality on every key of an inline property map."""
    terms = [F.col(f"`{name}`") == F.lit(value) for name, value in values.items()]
    return _fold(terms, lambda a, b: a & b) if terms else None


def text_equals_all(values: Mapping[str, Any]) -> Column | None:
    """Start filter of a traversal: property text equals value text."""
    terms = [F.col(f"`{name}`").cast("string") == as_text(value) for name, value in values.items()]
    return _fold(terms, lambda a, b: a & b) if terms else None


def label_allowed(label: Column, include: Sequence[str] = (), exclude: Sequence[str] = ()) -> Column:
    """Whitelist first, then blacklist; an empty list restricts nothing."""
    keep = F.lit(True)
    if include:
        keep = keep & label.isin(list(include))
    if exclude:
        keep = keep & ~label.isin(list(exclude))
    return keep
