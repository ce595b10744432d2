"""The queries of this subpackage: those of every module whose name begins with ``q_``."""

from __future__ import annotations

import importlib
import pkgutil

import quillsieve.llm

QUERIES: dict = {}
for _module in pkgutil.iter_modules(quillsieve.llm.__path__):
    if _module.name.startswith("q_"):
        QUERIES |= importlib.import_module(f"quillsieve.llm.{_module.name}").QUERIES
