"""Marketplace analytics as lazy Spark DataFrame functions."""

from bazaarlens.functions import StatusLabels
from bazaarlens.operators import *  # noqa: F403
from bazaarlens.operators import __all__ as _operators

__all__ = ["StatusLabels", *_operators]
