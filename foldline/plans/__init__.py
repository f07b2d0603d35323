"""Composed plans: W1 transform, W2 flow, L3 printing."""

from .flow import FlowResult, finish_flows, flow, land_source, print_file, print_rows
from .transform import transform, transform_frame

__all__ = ["FlowResult", "finish_flows", "flow", "land_source", "print_file", "print_rows", "transform", "transform_frame"]
