from .readers import *  # noqa: F401,F403
from .writers import *  # noqa: F401,F403
