"""Column functions: dialect helpers, business rules and the public macros."""

from bankmart.functions.columns import *  # noqa: F401,F403
from bankmart.functions.macros import (days_since, delinquency_bucket,  # noqa: F401
                                       months_since, safe_divide, surrogate_key,
                                       utilization_risk)
