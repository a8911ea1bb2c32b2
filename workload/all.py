"""Every registered query; importing the modules registers them."""

from workload import (  # noqa: F401
    aggregates, checks, cleaning, connectors, intake, privacy,
)
from workload.registry import ORACLE, QUERIES  # noqa: F401
