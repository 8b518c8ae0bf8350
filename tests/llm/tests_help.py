"""Rows of SQL beside those of Spark."""

from tidemark.compare import register_tables


def same(con, sf, sql, rows) -> bool:
    register_tables(con, sf)
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    return sorted(found.fetchall()) == sorted(tuple(r[n] for n in names) for r in rows)
