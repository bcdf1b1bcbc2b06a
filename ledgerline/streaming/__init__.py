"""Windowed demand (batch and stream), spike detection, stream runner."""

from ledgerline.streaming.demand import demand_spikes, windowed_demand
from ledgerline.streaming.runner import StreamResult, run_demand_stream

__all__ = ["demand_spikes", "windowed_demand", "StreamResult", "run_demand_stream"]
