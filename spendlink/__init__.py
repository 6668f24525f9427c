"""Record linkage and enrichment of purchase items on Spark."""

from spendlink.operators.match import SCORERS, best_matches
from spendlink.plans.price import Settings
from spendlink.plans.run import Job, Tables, run

__all__ = ["SCORERS", "best_matches", "Settings", "Job", "Tables", "run"]
