"""Named query plans over the given tables (one module per operator family)."""

from .registry import ORACLE, QUERIES  # noqa: F401


def load_all() -> None:
    """Import every plan module so its queries register themselves."""
    from . import (cost, evaluation, explain, models, monitoring, quality, queue, risk, splits,  # noqa: F401
                   io, streaming, velocity)
