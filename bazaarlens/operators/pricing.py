"""Column names of the pricing and platform tables, shared by their operators."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class PricingColumns:
    """Where a pricing table keeps what the operators need."""

    region: str = "region"
    item: str = "item_id"
    model: str = "model_id"
    units: str = "units"
    status: str = "status"
    platform_order: str = "platform_order"

    @property
    def model_key(self) -> list[str]:
        return [self.region, self.item, self.model]
