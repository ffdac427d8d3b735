"""Column-level helpers; every function returns a native Spark Column (no Python UDFs)."""

from quarry.functions.scalar import *  # noqa: F401,F403
