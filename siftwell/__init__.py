"""siftwell: batch retrieval over tables of queries, stored vectors and web pages, on Spark."""

from siftwell.config import RetrievalConfig
from siftwell.plans.engine import RetrievalEngine
from siftwell.session import build_session

__all__ = ["RetrievalConfig", "RetrievalEngine", "build_session"]
