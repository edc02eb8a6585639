"""Column helpers: every function returns a JVM-side ``Column`` expression
(no Python UDFs), so it stays inside whole-stage codegen."""

from mercato.functions.columns import *  # noqa: F401,F403
