"""Sales-tax readiness of payment and storefront data, on Spark."""

from salestax_spark.plans.job import Inputs, run
from salestax_spark.session import build_session

__all__ = ["Inputs", "build_session", "run"]
