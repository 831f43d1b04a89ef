"""Parameters of the operators, as small dataclasses.

The defaults are the settings the reference fixes in its code and its
configuration files (service level, costs, thresholds, weights).
"""

from __future__ import annotations

from dataclasses import dataclass, field


# Fixed values (must equal the reference for right results).
@dataclass(frozen=True)
class PolicyParams:
    z_service: float = 1.65           # 95% service level
    setup_cost: float = 50.0          # fixed ordering cost
    holding_rate: float = 0.2         # 20% of unit cost
    days_per_month: float = 30.0
    days_per_year: float = 365.0
    class_a_share: float = 0.2        # rank <= 0.2 * N  -> A
    class_b_share: float = 0.5        # rank <= 0.5 * N  -> B
    overstock_factor: float = 2.0
    growth_up: float = 0.1
    growth_down: float = -0.1
    w_stockout: float = 40.0
    w_growth: float = 20.0
    w_revenue: float = 25.0
    w_reliability: float = 15.0
    low_stock_units: float = 5.0


# Fixed values (must equal the reference for right results).
@dataclass(frozen=True)
class DeliveryParams:
    on_time_max_delay: int = 0        # on time: delay <= 0
    early_below: int = -1             # early:   delay < -1
    late_above: int = 1               # late:    delay > 1


# Fixed values (must equal the reference for right results).
@dataclass(frozen=True)
class CycleParams:
    low_stock_ratio: float = 0.2          # stock / min <= 0.2 -> low stock
    high_severity_ratio: float = 0.1      # ratio < 0.1 -> high severity alert
    high_value_amount: float = 5000.0     # order total above -> high value alert
    negotiation_min_total: float = 1000.0
    negotiation_target: float = 0.95      # target price = unit price * 0.95
    savings_share: float = 0.05           # savings potential = 5% of totals
    auto_approve_below: float = 1000.0
    delivery_days: int = 7
    negotiation_valid_days: int = 30
    w_reliability: float = 0.4
    w_price: float = 0.3
    w_lead: float = 0.2
    w_quality: float = 0.1
    price_score: float = 1.0
    quality_score: float = 0.85
    lead_days_scale: float = 30.0
    stockout_risk_high: float = 0.7
    urgent_stockout_risk: float = 0.8
    proxy_low_risk: float = 0.1
    alert_advice_above: int = 5
    order_advice_above: int = 10
    min_supplier_reliability: float = 0.7
    min_negotiation_value: float = 500.0
    bulk_order_threshold: float = 10000.0
    emergency_share: float = 0.05
    demand_increase_alert: float = 0.3
    supplier_decline_alert: float = 0.1
    delay_alert_days: int = 2
    default_supplier: str = "DEFAULT"
    tier_scores: dict = field(default_factory=lambda: {
        "Economy": 0.9, "Standard": 0.7, "Premium": 0.5})
    tier_default: float = 0.6


# Four tasks and their targets and metrics.
TASKS = {
    "demand_forecast": ("qty_mean", "rmse"),
    "stockout_risk": ("stockout_frequency", "mae"),
    "delivery_performance": ("delivery_reliability", "r2"),
    "procurement_priority": ("priority_score", "rmse"),
}
