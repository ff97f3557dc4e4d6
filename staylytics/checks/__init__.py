"""Named queries over the input tables, each with its DuckDB counterpart where SQL can express it."""

from importlib import import_module

MODULES = [
    "cleaning", "warehouse", "marts", "features", "ordering", "functions", "insights", "reviews", "retrieval",
    "monitoring", "models", "streams", "sources", "jobs",
]


def load_all() -> None:
    for name in MODULES:
        import_module(f"staylytics.checks.{name}")
