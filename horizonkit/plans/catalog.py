"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator ID of the inventory, each with an oracle SQL string where the
operator is SQL-expressible. Every query reads the given tables (or data
Spark derives from them) in full.
"""

from __future__ import annotations

from . import q_core, q_eval, q_features, q_io, q_models, q_prep, q_stats  # noqa: F401
from .registry import QUERIES, SQL  # noqa: F401
