"""The ten reports, each a function of named tables and parameters that returns a lazy DataFrame."""

from calloom.plans.agent_performance import agent_performance
from calloom.plans.call_performance import call_performance
from calloom.plans.capacity_plan import capacity_plan
from calloom.plans.crm import crm_events, crm_report
from calloom.plans.demand_forecast import demand_forecast
from calloom.plans.market_fit import market_fit
from calloom.plans.materialise import materialise
from calloom.plans.shared import Reports, shared_reports
from calloom.plans.shops import blocker_alert, shop_dimension
from calloom.plans.workforce_days import workforce_days

__all__ = [
    "Reports", "agent_performance", "blocker_alert", "call_performance", "capacity_plan", "crm_events", "crm_report",
    "demand_forecast", "market_fit", "materialise", "shared_reports", "shop_dimension", "workforce_days",
]
