"""Queries of the training-data operators, ``op<N>_<name>``, and their SQL where SQL can state them."""

from __future__ import annotations

from importlib import import_module

MODULES = (
    "simhash",
    "topk",
    "chat",
    "substrings",
    "training_order",
    "quality",
    "packing",
    "personal_data",
    "languages",
    "byte_pairs",
    "lines",
    "fill_in_middle",
    "spelling",
)


def _gather(name: str) -> dict:
    found: dict = {}
    for module in MODULES:
        found.update(getattr(import_module(f"shoptally.llm.{module}"), name, {}))
    return found


def queries() -> dict:
    return _gather("QUERIES")


def oracles() -> dict:
    return _gather("ORACLES")
