"""Column expressions shared by the operators."""

from chalkline.functions.exprs import *  # noqa: F401,F403
