"""Column-level scalar functions."""
from roamkit.functions.scalars import *  # noqa: F401,F403
