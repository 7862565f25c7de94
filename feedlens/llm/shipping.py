"""This package on the executors, for the tasks that run its functions."""

from __future__ import annotations

from feedlens.shipping import ship_package

__all__ = ["ship_package"]
