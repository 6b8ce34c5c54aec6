"""Imports every family so that its queries register."""

from . import addresses, files, messages, patterns, places, search, text  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
