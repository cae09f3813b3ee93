"""The library's distributed union-find, under the name that this package uses."""

from ..operators.components import connected_components

__all__ = ["connected_components"]
