"""tessera — matrix and small-network work on Spark tables.

Matrices live as *cell tables* (one row per coordinate, columns ``c0..c{n-1}``
and ``value``) or as *packed rows* (one row per record with an array column).
Every operator is a Spark job built from joins, grouped aggregates, windows,
projections and Arrow-batched numpy code inside tasks.
"""

from tessera.core import Cells
from tessera.session import build_session, checkpoint_dir

__all__ = ["Cells", "build_session", "checkpoint_dir"]
