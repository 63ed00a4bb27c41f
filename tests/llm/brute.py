"""Plain single-process versions of the operators, for small tables."""

import duckdb


def table(sf, name, columns="*"):
    return duckdb.sql(f"SELECT {columns} FROM read_parquet('{sf}/{name}.parquet')").fetchall()


def classes(nodes, links):
    """The smallest member of each node's component."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
