"""Readers and writers (A1-A10)."""
from tessera.sources.io import *  # noqa: F401,F403
