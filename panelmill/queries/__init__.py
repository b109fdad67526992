from panelmill.queries import features, ingest, evaluate, modelling, streams  # noqa: F401
from panelmill.queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
