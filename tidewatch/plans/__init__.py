"""Named query plans (Spark) and their SQL oracles (DuckDB)."""

from . import q_dash, q_events, q_marts, q_merge, q_misc, q_payloads, q_quality, q_scoring, q_sentiment, q_windows  # noqa: F401,E501  (registers queries)
from .registry import REGISTRY, Inputs, normalise, oracle, run

__all__ = ["REGISTRY", "Inputs", "normalise", "oracle", "run"]
