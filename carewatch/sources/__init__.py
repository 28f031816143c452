"""Readers, sinks and the dataset catalog."""

from .catalog import Catalog, table, test_catalog  # noqa: F401
from .readers import *  # noqa: F401,F403
from .sinks import *  # noqa: F401,F403
