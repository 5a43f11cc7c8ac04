"""Regional scorecard: order coverage, net price competitiveness and item counts.

Each operator aggregates the pricing table once. ``platform`` is a lookup with the
platform's own order total per region; a region listed twice there yields two rows.
Ratios are text with six decimals, or doubles with ``as_text=False``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions.numbers import fixed_text, ratio
from bazaarlens.functions.statuses import StatusLabels
from bazaarlens.operators.pricing import PricingColumns

_DIGITS = 6


def order_coverage(
    pricing: DataFrame,
    platform: DataFrame,
    columns: PricingColumns = PricingColumns(),
    as_text: bool = True,
) -> DataFrame:
    """Our orders divided by the platform's, per region."""
    totals = pricing.groupBy(columns.region).agg(_units(columns))
    return _with_platform(totals, platform, columns).select(
        columns.region, _coverage(columns, as_text)
    )


def item_count_by_region(
    pricing: DataFrame, columns: PricingColumns = PricingColumns()
) -> DataFrame:
    """Rows with an item id, per region. Rows, not distinct items."""
    return pricing.groupBy(columns.region).agg(_item_rows(columns))


def status_count_by_region(
    pricing: DataFrame, columns: PricingColumns = PricingColumns()
) -> DataFrame:
    """Rows with a model id, per region and status."""
    return pricing.groupBy(columns.region, columns.status).agg(
        F.count(columns.model).alias("number_of_models")
    )


def net_competitiveness(
    pricing: DataFrame,
    columns: PricingColumns = PricingColumns(),
    labels: StatusLabels = StatusLabels(),
    as_text: bool = True,
) -> DataFrame:
    """(Cheaper models - dearer models) / all models, per region.

    Null where a region lacks one of the two statuses altogether, and for the null
    region.
    """
    totals = pricing.groupBy(columns.region).agg(*_model_counts(columns, labels))
    return totals.select(columns.region, _net(columns, as_text))


def regional_scorecard(
    pricing: DataFrame,
    platform: DataFrame,
    columns: PricingColumns = PricingColumns(),
    labels: StatusLabels = StatusLabels(),
    as_text: bool = True,
) -> DataFrame:
    """The three measures side by side, from one aggregation by region.

    The null region keeps its row, with every measure null.
    """
    totals = pricing.groupBy(columns.region).agg(
        _units(columns), _item_rows(columns), *_model_counts(columns, labels)
    )
    return _with_platform(totals, platform, columns).select(
        columns.region,
        _coverage(columns, as_text),
        _net(columns, as_text),
        _known_region(columns, F.col("number_of_item_by_region")).alias(
            "number_of_item_by_region"
        ),
    )


def _units(columns: PricingColumns) -> Column:
    return F.sum(columns.units).alias("sum_units")


def _item_rows(columns: PricingColumns) -> Column:
    return F.count(columns.item).alias("number_of_item_by_region")


def _model_counts(columns: PricingColumns, labels: StatusLabels) -> list[Column]:
    # A sum, not a count: null when no row has the status, 0 when such rows have no model.
    has_model = F.col(columns.model).isNotNull().cast("bigint")
    status = F.col(columns.status)
    return [
        F.count(columns.model).alias("models"),
        F.sum(F.when(status == labels.cheaper, has_model)).alias("cheaper_models"),
        F.sum(F.when(status == labels.dearer, has_model)).alias("dearer_models"),
    ]


def _known_region(columns: PricingColumns, value: Column) -> Column:
    return F.when(F.col(columns.region).isNotNull(), value)


def _with_platform(
    totals: DataFrame, platform: DataFrame, columns: PricingColumns
) -> DataFrame:
    # After the aggregation, and already partitioned by region: one row per region
    # meets the lookup, so no hint is needed and no region can be hot.
    lookup = platform.select(columns.region, columns.platform_order)
    return totals.join(lookup, columns.region, "left")


def _coverage(columns: PricingColumns, as_text: bool) -> Column:
    value = ratio(F.col("sum_units"), F.col(columns.platform_order))
    return _shown(value, as_text).alias("order_coverage_by_region")


def _net(columns: PricingColumns, as_text: bool) -> Column:
    margin = F.col("cheaper_models") - F.col("dearer_models")
    value = _known_region(columns, ratio(margin, F.col("models")))
    return _shown(value, as_text).alias("net_competitiveness")


def _shown(value: Column, as_text: bool) -> Column:
    return fixed_text(value, _DIGITS) if as_text else value
