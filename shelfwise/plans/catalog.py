"""All registered queries (imports the per-area modules for their side effect).

Every query reads the driver's test tables, or data Spark derives from them,
and runs over whole tables.  See ``plans/model.py`` for the role mapping.
"""

from __future__ import annotations

from .registry import REGISTRY, SQL  # noqa: F401
from . import q_sales, q_clean, q_history, q_variance, q_dq, q_ghg, q_facts, q_recon, q_semantic, q_kpi2, q_io, q_dims, q_controls, q_staging2, q_more, q_extra, q_quarterly, q_layers, q_measures2, q_reference  # noqa: F401
