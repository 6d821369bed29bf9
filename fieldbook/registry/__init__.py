"""Registered queries: the warehouse operators run on the driver tables.

The driver tables are TPC-H-like; ``standins`` maps them onto the domain
shapes (documents, lines, catalogs, weighings).  Each registered query is a
Spark plan built from the library plus an independent SQL oracle.
"""


def load_all() -> None:
    """Import every query module (registration happens at import)."""
    import importlib
    for m in ("work", "harvest", "movement", "ingest", "model", "checks", "streams", "marts", "entities"):
        importlib.import_module(f"fieldbook.registry.{m}")
