from bazaarlens.operators.bitmaps import bitmap_distinct
from bazaarlens.operators.category import (
    categorised_orders,
    category_contribution,
    category_rates,
)
from bazaarlens.operators.first_purchase import (
    first_purchase_daily,
    first_purchase_daily_filled,
)
from bazaarlens.operators.hot import HotKeys, hot_keys, with_key_values
from bazaarlens.operators.joins import join_groups, join_lookup
from bazaarlens.operators.keys import (
    distinct_count,
    duplicate_keys,
    key_multiplicity,
    preview,
    row_counts,
    rows_with_key,
)
from bazaarlens.operators.pricing import PricingColumns
from bazaarlens.operators.priority import priority_status, status_priorities
from bazaarlens.operators.scorecard import (
    item_count_by_region,
    net_competitiveness,
    order_coverage,
    regional_scorecard,
    status_count_by_region,
)
from bazaarlens.operators.top_models import (
    top30_item_count,
    top30_model_flag,
    top30_ranked_models,
)

__all__ = [
    "HotKeys",
    "PricingColumns",
    "bitmap_distinct",
    "categorised_orders",
    "category_contribution",
    "category_rates",
    "distinct_count",
    "duplicate_keys",
    "first_purchase_daily",
    "first_purchase_daily_filled",
    "hot_keys",
    "item_count_by_region",
    "join_groups",
    "join_lookup",
    "key_multiplicity",
    "net_competitiveness",
    "order_coverage",
    "preview",
    "priority_status",
    "regional_scorecard",
    "row_counts",
    "rows_with_key",
    "status_count_by_region",
    "status_priorities",
    "top30_item_count",
    "top30_model_flag",
    "top30_ranked_models",
    "with_key_values",
]
