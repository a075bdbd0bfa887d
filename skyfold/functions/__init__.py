from skyfold.functions.expr import *  # noqa: F401,F403
from skyfold.functions.taxonomy import *  # noqa: F401,F403
