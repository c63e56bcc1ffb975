"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

MODULES = ("exact_dedup", "byte_bpe", "language_id", "quality", "media", "warc", "near_dedup", "url_filter", "mixing", "pii")


def llm_queries() -> dict[str, Callable]:
    return {k: f for m in MODULES for k, f in import_module(f".{m}", __package__).QUERIES.items()}


def llm_oracles() -> dict[str, str]:
    return {k: f for m in MODULES for k, f in import_module(f".{m}", __package__).ORACLES.items()}
