"""Declared schemas of the marketplace CSV files, so that reading needs no inference.

``_c0`` is the unnamed index column such files carry. Ids exceed 32 bits.
"""

from __future__ import annotations

FIRST_PURCHASE = "_c0 BIGINT, buyer_id BIGINT, first_purchase_time TIMESTAMP"
ORDER_ITEM = "_c0 BIGINT, buyer_id BIGINT, create_datetime TIMESTAMP, cluster STRING"
ORDER_ITEMS = "_c0 BIGINT, order_id BIGINT, item_id BIGINT, create_timestamp TIMESTAMP"
ITEM_CATEGORY = "_c0 BIGINT, item_id BIGINT, cluster STRING"
PRICING = (
    "_c0 BIGINT, region STRING, item_id BIGINT, model_id BIGINT, status STRING, units BIGINT"
)
PLATFORM = "_c0 BIGINT, region STRING, platform_order BIGINT"
