"""Best price status per product model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions.statuses import StatusLabels, status_rank
from bazaarlens.operators.hot import HotKeys, hot_keys, with_key_values
from bazaarlens.operators.pricing import PricingColumns


def status_priorities(
    pricing: DataFrame,
    columns: PricingColumns = PricingColumns(),
    labels: StatusLabels = StatusLabels(),
    hot: HotKeys | None = None,
) -> DataFrame:
    """Each row's (item, model, status) with its rank and the best rank of its model.

    The region plays no part: a model is judged across all regions. The best rank comes
    from a window, for hot models from an aggregation; which these are is found by a pass
    over the rows, when this is called, unless ``hot`` tells.
    """
    key = [columns.item, columns.model]
    rows = pricing.select(
        *key,
        columns.status,
        status_rank(F.col(columns.status), labels).alias("new_cpt_status"),
    )
    if hot is None:
        hot = hot_keys(pricing, key)
    return with_key_values(rows, key, {"priority": F.min("new_cpt_status")}, hot)


def priority_status(
    pricing: DataFrame,
    columns: PricingColumns = PricingColumns(),
    labels: StatusLabels = StatusLabels(),
    hot: HotKeys | None = None,
) -> DataFrame:
    """The rows that hold their model's best status; ties all stay."""
    return (
        status_priorities(pricing, columns, labels, hot)
        .where(F.col("new_cpt_status") == F.col("priority"))
        .select(columns.item, columns.model, columns.status)
    )
