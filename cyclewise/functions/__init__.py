"""Column expressions (JVM-side, codegen-friendly)."""
from cyclewise.functions.risk import clamp_rul, recommendation, risk_level

__all__ = ["risk_level", "clamp_rul", "recommendation"]
