"""Joins of a silver specification and key completeness checks."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Join types of a specification -> Spark join types.
JOIN_TYPES = {
    "JOIN": "inner", "INNER JOIN": "inner",
    "LEFT JOIN": "left", "LEFT OUTER JOIN": "left",
    "RIGHT JOIN": "right", "RIGHT OUTER JOIN": "right",
    "FULL JOIN": "full", "FULL OUTER JOIN": "full",
    "LEFT SEMI JOIN": "left_semi", "LEFT ANTI JOIN": "left_anti",
}


def join_type(text: str | None) -> str:
    name = " ".join((text or "INNER JOIN").upper().split())
    if name == "CROSS JOIN":
        raise ValueError("CROSS JOIN pairs every row with every row; give join conditions")
    if name not in JOIN_TYPES:
        raise ValueError(f"Sources cannot be joined by {name!r}")
    return JOIN_TYPES[name]


def equal_pairs(conditions: Sequence[Mapping[str, str]] | None) -> list[tuple[str, str]]:
    """The conditions that have both sides; a source without any would pair all rows."""
    sides = ([str(c.get(side) or "").strip() for side in ("lh", "rh")] for c in conditions or ())
    complete = [(left, right) for left, right in sides if left and right]
    if complete:
        return complete
    raise ValueError("A join needs a condition with both sides, lh and rh")


def _left_to_right(right: DataFrame, alias: str, pairs: Sequence[tuple[str, str]]) -> list[tuple[str, str]]:
    """The pairs with the expression over the right frame second, as it may come first."""
    def of_right(expression: str) -> bool:
        return expression in right.columns or bool(
            re.search(rf"(?<![\w.`]){re.escape(alias)}\.", expression, re.IGNORECASE))

    return [(b, a) if of_right(a) and not of_right(b) else (a, b) for a, b in pairs]


def join_on(left: DataFrame, right: DataFrame, alias: str, pairs: Sequence[tuple[str, str]],
            how: str) -> list[DataFrame]:
    """Join two aliased frames on ``lh = rh`` pairs. The result is the union of the list.

    AQE splits a hot key of an inner, left or right join. It cannot split a full join, so
    that is a left join and, apart from it, the right rows without a match. Both parts keep
    the aliases, so later expressions resolve in each of them.
    """
    on = F.expr(" AND ".join(f"({a}) = ({b})" for a, b in pairs))
    if how != "full":
        return [left.join(right, on, how)]
    # The left keys are reduced to distinct values before the anti join: a hot key is
    # combined on the map side.
    sides = _left_to_right(right, alias, pairs)
    known = left.select(*(F.expr(a).alias(f"_k{i}") for i, (a, _) in enumerate(sides))).distinct()
    same = F.expr(" AND ".join(f"({b}) = _k{i}" for i, (_, b) in enumerate(sides)))
    alone = right.join(known, same, "left_anti")
    return [left.join(right, on, "left"), left.filter(F.lit(False)).join(alone, on, "right")]


def missing_keys(requested: DataFrame, returned: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct requested keys that were not returned."""
    have = returned.select(*keys).distinct()
    return requested.select(*keys).distinct().join(have, list(keys), "left_anti")


def require_complete(requested: DataFrame, returned: DataFrame, keys: Sequence[str]) -> None:
    missing = missing_keys(requested, returned, keys)
    sample = missing.orderBy(*keys).limit(10).collect()
    if sample:
        listed = ", ".join(":".join(str(v) for v in row) for row in sample)
        raise ValueError(f"{missing.count()} requested key(s) were not returned: {listed}")
