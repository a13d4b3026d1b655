"""Penalized logistic regression as SQL: Newton steps in a recursive query."""

from __future__ import annotations

from collections.abc import Sequence

STEPS = 25


def newton_parts(rows: str, features: Sequence[str], label: str, c: float = 1.0, weight: str = "1e0", key: str = "0") -> dict[str, str]:
    """Parts ending in ``fitted(k, beta)``: one fit per ``key``, intercept first.

    ``rows`` is a table with the features, the label and ``weight``. Equal rows are
    added up; each step sums the outer products of the rows, weighted, into the
    normal equations and solves them by elimination, column by column.
    """
    n = len(features) + 1
    x = ", ".join(["1e0", *(f"CAST({f} AS DOUBLE)" for f in features)])

    def cell(i: int, j: int) -> str:
        penalty = f" + {1 / c!r}" if i == j and i > 1 else ""
        return f"h{min(i, j)}_{max(i, j)}{penalty}"

    products = [f"sum(w * p * (1e0 - p) * x[{i}] * x[{j}]) AS h{i}_{j}" for i in range(1, n + 1) for j in range(i, n + 1)]
    slopes = [f"sum(w * (y - p) * x[{i}]) AS g{i}" for i in range(1, n + 1)]
    equations = ", ".join(
        "[" + ", ".join([cell(i, j) for j in range(1, n + 1)] + [f"g{i}" + (f" - beta[{i}] * {1 / c!r}" if i > 1 else "")]) + "]"
        for i in range(1, n + 1)
    )
    k = "CAST(s[1][1] AS INT)"
    eliminate = (
        f"lambda m, s: list_transform(m, lambda line, i: CASE WHEN i = {k} THEN list_transform(line, lambda v: v / m[{k}][{k}]) "
        f"ELSE list_transform(line, lambda v, j: v - line[{k}] * m[{k}][j] / m[{k}][{k}]) END)"
    )
    columns = f"list_transform(range(1, {n + 1}), lambda i: [[CAST(i AS DOUBLE)]])"
    return {
        "fit_rows": f"SELECT k, y, x, sum(w) AS w FROM (SELECT {key} AS k, CAST({label} AS DOUBLE) AS y, [{x}] AS x, {weight} AS w FROM {rows}) q GROUP BY k, y, x",
        "newton": f"SELECT k, 0 AS step, [{', '.join(['0e0'] * n)}] AS beta FROM (SELECT DISTINCT k FROM fit_rows) d\nUNION ALL\n"
        f"SELECT k, step + 1, list_transform(beta, lambda b, i: b + solved[i][{n + 1}]) FROM ("
        f"SELECT k, step, beta, list_reduce(list_concat([[{equations}]], {columns}), {eliminate}) AS solved FROM ("
        f"SELECT k, step, any_value(beta) AS beta, {', '.join(products + slopes)} FROM ("
        "SELECT t.k, t.step, t.beta, y, w, x, 1e0 / (1e0 + exp(-list_dot_product(t.beta, x))) AS p FROM newton t JOIN fit_rows f ON t.k = f.k"
        f") a GROUP BY k, step) b) e WHERE step < {STEPS}",
        "fitted": f"SELECT k, beta FROM newton WHERE step = {STEPS}",
    }
