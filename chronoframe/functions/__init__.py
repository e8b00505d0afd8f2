"""Column-expression builders (no actions, no UDFs)."""

from chronoframe.functions.calendar import *  # noqa: F401,F403
from chronoframe.functions.rules import *  # noqa: F401,F403
from chronoframe.functions.scalar import *  # noqa: F401,F403
