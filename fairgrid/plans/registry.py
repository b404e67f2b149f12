"""All registered queries of the price-fairness engine, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE_SQL: dict[str, str] = {}


def exact_rounding(sql: str) -> str:
    """``round(x, n)`` of doubles as half-up rounding of a nine-digit decimal, as ``half_up`` does it."""
    out, at = "", 0
    while (start := sql.find("round(", at)) >= 0:
        depth, comma, i = 1, 0, start + 6
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[i], 0)
            comma = i if sql[i] == "," and depth == 1 else comma
            i += 1
        out += f"{sql[at:start]}cast(round(cast({exact_rounding(sql[start + 6 : comma])} as decimal(38, 9)), {sql[comma + 1 : i - 1].strip()}) as double)"
        at = i
    return out + sql[at:]


def query(sql: str | None = None, name: str | None = None) -> Callable:
    """Register a query under its function's name."""

    def add(f: Callable) -> Callable:
        QUERIES[name or f.__name__] = f
        if sql:
            ORACLE_SQL[name or f.__name__] = exact_rounding(sql)
        return f

    return add


from . import aggregates, joins, models, relational, scalars, storage, windows  # noqa: E402, F401
