"""stagewise: product lifecycle and sentiment analytics on Spark.

Raw catalogue, order, review and inventory data become one product-by-month
fact table (``monthly_metrics``) with lifecycle stage, risk and opportunity
scores, and a set of summary tables derived from it.

Main entry points::

    from stagewise import build_session, run_from_raw, monthly_metrics, build_marts
"""

from .operators.marts import build_marts
from .operators.monthly import monthly_metrics
from .plans.pipeline import run_from_raw, run_from_tables, run_pipeline
from .session import CLUSTER_CONF, build_session

__version__ = "0.1.0"

__all__ = [
    "CLUSTER_CONF", "build_marts", "build_session", "monthly_metrics", "run_from_raw", "run_from_tables",
    "run_pipeline",
]
