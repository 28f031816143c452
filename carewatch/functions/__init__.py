"""Column builders and row predicates."""

from . import calendar, constants, expr, predicates  # noqa: F401
from .calendar import *  # noqa: F401,F403
from .expr import *  # noqa: F401,F403
from .predicates import *  # noqa: F401,F403
