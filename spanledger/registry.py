"""Every query of the library by name, with its SQL."""

from spanledger.queries import books, catalog, decided, decisions, forms, ranges, reports, shapes, streams, texts, whole

MODULES = (texts, catalog, reports, forms, decisions, decided, ranges, shapes, books, whole, streams)
QUERIES: dict = {k: v for m in MODULES for k, v in m.QUERIES.items()}
SQL: dict = {k: v for m in MODULES for k, v in m.SQL.items()}
