"""SQL texts of small linear algebra and of the t distribution, for the twins of models."""

from __future__ import annotations


def inverse(name: str, source: str, size: int) -> str:
    """CTE (g, j, m): Gauss-Jordan steps over source(g, a); at j = size + 1 the right half of m is the inverse of a.

    `a` is positive definite, so the diagonal serves as pivot.
    """
    unit = f"list_transform(range(1, {size + 1}), lambda c: CASE WHEN c = r THEN 1e0 ELSE 0e0 END)"
    cell = "CASE WHEN r = j THEN m[j][c] / m[j][j] ELSE m[r][c] - m[r][j] * (m[j][c] / m[j][j]) END"
    return f"""{name} AS (
  SELECT g, 1 AS j, list_transform(range(1, {size + 1}), lambda r: list_concat(a[r], {unit})) AS m FROM {source}
  UNION ALL SELECT g, j + 1, list_transform(range(1, {size + 1}), lambda r:
    list_transform(range(1, {2 * size + 1}), lambda c: {cell})) FROM {name} WHERE j <= {size})"""


def regression(rows: str, features: list[str], label: str, group: str = "0") -> list[str]:
    """CTEs up to fit(g, n, b, b0, v, mx, r2, s2): least squares per group from moments alone."""
    k = len(features)
    square = ", ".join("[" + ", ".join(f"covar_pop({a}, {b})" for b in features) + "]" for a in features)
    return [
        f"moments AS (SELECT {group} AS g, count(*) AS n, [{', '.join(f'avg({f})' for f in features)}] AS mx, avg({label}) AS my, "
        f"[{square}] AS a, [{', '.join(f'covar_pop({f}, {label})' for f in features)}] AS xy, var_pop({label}) AS yy FROM {rows} GROUP BY 1)",
        inverse("solved", "moments", k),
        f"""fit AS (SELECT *, my - list_sum(list_transform(range(1, {k + 1}), lambda i: b[i] * mx[i])) AS b0,
              list_sum(list_transform(range(1, {k + 1}), lambda i: b[i] * xy[i])) / yy AS r2,
              (yy - list_sum(list_transform(range(1, {k + 1}), lambda i: b[i] * xy[i]))) * n / (n - {k + 1}) AS s2
            FROM (SELECT *, list_transform(range(1, {k + 1}), lambda r: list_sum(list_transform(range(1, {k + 1}), lambda c: v[r][c] * xy[c]))) AS b
              FROM (SELECT g, n, mx, my, xy, yy, list_transform(m, lambda r: r[{k + 1}:]) AS v FROM solved JOIN moments USING (g) WHERE j = {k + 1})))""",
    ]


def predicted(features: list[str], fit: str = "fit") -> str:
    return " + ".join([f"{fit}.b0", *[f"{fit}.b[{i + 1}] * {f}" for i, f in enumerate(features)]])


def two_sided_p(t: str, freedom: str) -> str:
    """1 - I(1/2, freedom/2) by its power series; meant for more than 100 degrees of freedom."""
    y = f"greatest(({t}) * ({t}) / ({freedom} + ({t}) * ({t})), 1e-300)"
    b = f"({freedom} / 2e0)"
    terms = f"list_sum(list_transform(range(0, 3000), lambda i: exp(lgamma(0.5e0 + {b} + i) - lgamma(0.5e0 + {b}) - lgamma(1.5e0 + i) + lgamma(1.5e0) + i * ln({y}))))"
    front = f"exp(0.5e0 * ln({y}) + {b} * ln(1 - {y}) + lgamma(0.5e0 + {b}) - lgamma(0.5e0) - lgamma({b})) / 0.5e0"
    return f"CASE WHEN ({t}) * ({t}) > 200 THEN 0e0 ELSE greatest(0e0, 1 - {front} * {terms}) END"
