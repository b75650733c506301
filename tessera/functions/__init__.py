"""Column-level building blocks shared by the operators."""
from tessera.functions.stable import stable_hash, stable_u01, stable_normal  # noqa: F401
