"""Daily panel analytics and next-day forecasting on Spark."""

from panelcast.spec import Delta, Lag, PanelSpec, Roles, Rolling, Target

__all__ = ["Delta", "Lag", "PanelSpec", "Roles", "Rolling", "Target"]
