"""Business parameters in one frozen object.

The defaults are the reference application's values; every operator takes
the value it needs as an argument so nothing is hard-coded inside functions.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from decimal import Decimal


@dataclass(frozen=True)
class RetailParams:
    # Fixed values that must equal the reference application's defaults.
    high_value_threshold: Decimal = Decimal("500.00")  # revenue >= threshold
    sales_alert_threshold: Decimal = Decimal("1000.00")  # daily revenue < threshold
    spike_factor: Decimal = Decimal("2.0")  # window qty > mean qty * factor
    watermark_delay: str = "5 minutes"
    window_duration: str = "1 minute"
    max_bytes_per_trigger: int = 1 << 30  # stream input of one micro-batch
    top_k_products: int = 10
    top_k_products_with_attrs: int = 5

    # Cleaning rule: a row is valid when price > price_floor and
    # quantity > quantity_floor (the reference uses 0 for both).
    price_floor: Decimal = Decimal("0")
    quantity_floor: int = 0

    def with_(self, **changes) -> "RetailParams":
        return replace(self, **changes)
