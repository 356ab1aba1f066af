"""Column-expression builders (JVM-side, codegen friendly)."""

from citypulse.functions.scalar import *  # noqa: F401,F403
