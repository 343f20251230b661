"""One query per corpus operator over whole tables, with SQL where SQL can say the same."""

from __future__ import annotations

from importlib import import_module

from .register import QUERIES, SQL

for _name in ("q_dedup", "q_mixing", "q_tokens", "q_langid", "q_topk", "q_substring", "q_near", "q_html", "q_quality", "q_audit", "q_whitening", "q_neighbours"):
    import_module(f"{__package__}.{_name}")

__all__ = ["QUERIES", "SQL"]
