"""Keyed fixed-width record analytics as DataFrame operators."""

from keyloom.layout import Field, KeySpec, Layout, Segment

__all__ = ["Field", "KeySpec", "Layout", "Segment"]
