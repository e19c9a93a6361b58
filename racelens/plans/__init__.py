"""Query registry and oracle SQL.

``all_queries()`` returns every registered builder; ``all_oracle_sql()`` the
DuckDB SQL text per key (keys without SQL get the weaker rows-only check).
"""


def all_queries():
    from racelens.plans import queries, queries_io, queries_train  # noqa: F401  (registration)
    return queries.REGISTRY


def positive_zero_rounds(sql: str) -> str:
    """Wrap every ``round(...)`` as ``(round(...) + 0.0)``: DuckDB rounds a
    tiny negative number to -0.0 while Spark returns 0.0."""
    out, i, low = [], 0, sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0 or (j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k = 0, j + 5
        while k < len(sql):
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        inner = positive_zero_rounds(sql[j + 6:k])
        out.append(sql[i:j] + "(round(" + inner + ") + 0.0)")
        i = k + 1


def all_oracle_sql():
    import importlib
    base = importlib.import_module("racelens.plans.oracle")
    importlib.import_module("racelens.plans.oracle_io")
    importlib.import_module("racelens.plans.oracle_train")
    return {k: positive_zero_rounds(v) for k, v in base.ORACLE.items()}
