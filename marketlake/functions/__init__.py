"""Column expressions (JVM-side, codegen-friendly). Nothing here touches Python per row."""

from marketlake.functions.expressions import *  # noqa: F401,F403
