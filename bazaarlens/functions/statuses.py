"""Price competitiveness labels and their order of preference."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class StatusLabels:
    """How a table spells "we are cheaper", "same price" and "we are dearer"."""

    cheaper: str = "OWN < REF"
    equal: str = "OWN = REF"
    dearer: str = "OWN > REF"


def status_rank(status: Column, labels: StatusLabels = StatusLabels()) -> Column:
    """1 cheaper, 2 equal, 3 dearer, 4 for any other label or null."""
    return (
        F.when(status == labels.cheaper, 1)
        .when(status == labels.equal, 2)
        .when(status == labels.dearer, 3)
        .otherwise(4)
    )
