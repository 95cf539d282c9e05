from clickpath.plans.daily import daily_refresh
from clickpath.plans.full import full_refresh

__all__ = ["daily_refresh", "full_refresh"]
