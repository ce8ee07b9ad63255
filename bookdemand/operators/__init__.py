"""DataFrame → DataFrame operators."""

from bookdemand.operators.join import join_rooms
from bookdemand.operators.ranking import top_n_per_group
from bookdemand.operators.requests import demand_by_room, filter_requests, priority_score, top_demand

__all__ = [
    "filter_requests", "demand_by_room", "join_rooms", "priority_score",
    "top_demand", "top_n_per_group",
]
