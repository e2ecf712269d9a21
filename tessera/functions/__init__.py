"""Column -> Column helpers (no Python UDFs): text rules, JSON response handling, ids."""

from tessera.functions.text import *  # noqa: F401,F403
from tessera.functions.jsontext import *  # noqa: F401,F403
