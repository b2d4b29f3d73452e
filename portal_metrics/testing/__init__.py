"""Oracle SQL twins of the registered queries (DuckDB dialect)."""


def _cast_count_if(sql: str) -> str:
    """Wrap every COUNT_IF(...) in CAST(... AS BIGINT): DuckDB returns
    HUGEINT for it, Spark's count_if is a bigint."""
    out, i, token = [], 0, "COUNT_IF("
    while True:
        j = sql.find(token, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + len(token) - 1
        while True:
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        inner = _cast_count_if(sql[j + len(token):k])
        out.append(sql[i:j] + "CAST(COUNT_IF(" + inner + ") AS BIGINT)")
        i = k + 1


def all_sql() -> dict[str, str]:
    from . import oracle_measures, oracle_more, oracle_sql
    out: dict[str, str] = {}
    for mod in (oracle_sql, oracle_measures, oracle_more):
        out.update(mod.SQL)
    return {k: _cast_count_if(v) for k, v in out.items()}
