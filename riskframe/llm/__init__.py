"""Training-data operators: corpus operators and their registered queries.

Nothing else in the library imports this subpackage; ``__spark_entry__`` adds its
queries when it is present.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from .op1_license import op1_license
    from .op2_neardup import op2_neardup
    from .op3_bpe import op3_bpe
    from .op4_lm import op4_lm
    from .op5_pii import op5_pii
    from .op6_quality_model import op6_quality_model
    from .op7_decontam import op7_decontam
    from .op8_quality import op8_quality
    from .op9_html import op9_html
    from .op10_url import op10_url
    from .op11_variants import op11_variants
    from .op12_search import op12_search
    from .op13_packing import op13_packing

    return {f.__name__: f for f in (op1_license, op2_neardup, op3_bpe, op4_lm, op5_pii, op6_quality_model, op7_decontam,
                                    op8_quality, op9_html, op10_url, op11_variants, op12_search, op13_packing)}


def oracle_sql() -> dict[str, str]:
    from . import op10_url, op12_search

    return {"op10_url": op10_url.ORACLE, "op12_search": op12_search.ORACLE}
