"""SQL twin of the grouped ridge logistic regression: Newton steps as unrolled CTEs."""

from __future__ import annotations

from collections.abc import Sequence


def irls_ctes(name: str, source: str, xs: Sequence[str], y: str, ridge: float = 1.0, rounds: int = 14,
              group: str = "0") -> str:
    """CTEs that end in ``name`` (grp, n, b0, b1, ...); ``source`` is a FROM item."""
    p = len(xs) + 1
    m = lambda i, j: f"m{min(i, j)}_{max(i, j)}"                                          # noqa: E731
    out = [f"{name}_x AS MATERIALIZED (SELECT {group} AS grp, CAST({y} AS DOUBLE) AS y, CAST(1 AS DOUBLE) AS x0, "
           + ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0) AS x{i}" for i, c in enumerate(xs, 1)) + f" FROM {source} WHERE {y} IS NOT NULL)",
           f"{name}_s0 AS MATERIALIZED (SELECT grp, count(*) AS n, " + ", ".join(f"CAST(0 AS DOUBLE) AS b{i}" for i in range(p))
           + f" FROM {name}_x GROUP BY grp HAVING min(y) < max(y))"]
    eta = " + ".join(f"b{i} * x{i}" for i in range(p))
    for r in range(1, rounds + 1):
        sums = [f"sum(w * x{i} * x{j})" + (f" + {ridge}" if i == j and i else "") + f" AS {m(i, j)}"
                for i in range(p) for j in range(i, p)]
        sums += [f"sum(x{i} * (w * eta + y - mu)) AS v{i}" for i in range(p)]
        last = f"{name}_e{r}_0"
        out.append(f"{last} AS MATERIALIZED (SELECT grp, n, {', '.join(sums)} FROM (SELECT *, mu * (1 - mu) AS w FROM ("
                   f"SELECT *, 1 / (1 + exp(-eta)) AS mu FROM (SELECT d.*, s.n, {eta} AS eta FROM {name}_x AS d "
                   f"JOIN {name}_s{r - 1} AS s ON d.grp = s.grp) AS q1) AS q2) AS q3 GROUP BY grp, n)")
        for k in range(p - 1):                                   # elimination, one pivot a CTE
            cols = []
            for i in range(p):
                for j in range(i, p):
                    cols.append(f"{m(i, j)} - {m(k, i)} * {m(k, j)} / {m(k, k)} AS {m(i, j)}" if i > k else m(i, j))
                cols.append(f"v{i} - {m(k, i)} * v{k} / {m(k, k)} AS v{i}" if i > k else f"v{i}")
            out.append(f"{name}_e{r}_{k + 1} AS MATERIALIZED (SELECT grp, n, {', '.join(cols)} FROM {last})")
            last = f"{name}_e{r}_{k + 1}"
        for k in range(p - 1, -1, -1):                           # and back
            keep = [m(i, j) for i in range(k) for j in range(i, p)] + [f"v{i}" for i in range(k)] + [f"b{i}" for i in range(k + 1, p)]
            rest = "".join(f" - {m(k, j)} * b{j}" for j in range(k + 1, p))
            this = f"{name}_s{r}" if k == 0 else f"{name}_c{r}_{k}"
            out.append(f"{this} AS MATERIALIZED (SELECT grp, n, {', '.join([*keep, f'(v{k}{rest}) / {m(k, k)} AS b{k}'])} FROM {last})")
            last = this
    out.append(f"{name} AS MATERIALIZED (SELECT grp, n, {', '.join(f'b{i}' for i in range(p))} FROM {name}_s{rounds})")
    return ",\n".join(out)


def logistic_sql(coefficients: Sequence[str], xs: Sequence[str]) -> str:
    z = coefficients[0] + "".join(f" + {b} * {x}" for b, x in zip(coefficients[1:], xs))
    return f"(1 / (1 + exp(-({z}))))"
