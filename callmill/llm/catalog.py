"""The subpackage's queries by name, and their SQL."""

from __future__ import annotations

from importlib import import_module

#: Query -> module of this subpackage that defines a function of the query's name.
MODULES: dict[str, str] = {
    "p9_found": "sentences",
    "p1_found": "boilerplate",
    "p6_found": "neardup",
    "p6_classes": "neardup",
    "p3_found": "names",
    "p4_found": "canonical",
    "p2_found": "splitting",
    "p7_ids": "encoding",
    "p8_containers": "packing",
    "p8_limited": "packing",
}


def queries() -> dict:
    def at(name: str, module: str):
        return lambda spark, sf_dir: getattr(import_module(f"callmill.llm.{module}"), name)(spark, sf_dir)

    return {name: at(name, module) for name, module in MODULES.items()}


def oracle_sql() -> dict[str, str]:
    """SQL for what SQL can say in full; the others are tested against brute force, round trips and held-out pages."""
    from callmill.llm import neardup, splitting

    return {"p2_found": splitting.P2_SQL, "p6_found": neardup.P6_SQL}
