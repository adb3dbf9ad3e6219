"""Order-insensitive comparison of two result sets (column names sorted,
floats rounded), used by the oracle tests and scripts/oracle_check.py."""

from __future__ import annotations

import math


def norm(v, digits: int = 6):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v + 0.0 if digits is None else round(v, digits) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(norm(x, digits) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x, digits)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return tuple(sorted((k, norm(x, digits)) for k, x in v.asDict().items()))
    if type(v).__name__ == "Decimal":
        return round(float(v), digits) + 0.0
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return v


def canonical(cols, rows, digits: int = 6):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i], digits) for i in order) for r in rows), key=repr)


def same_result(scols, srows, ocols, orows, digits: int = 6):
    """(ok, message)."""
    if sorted(scols) != sorted(ocols):
        return False, f"columns differ: {sorted(scols)} vs {sorted(ocols)}"
    if len(srows) != len(orows):
        return False, f"row count {len(srows)} vs {len(orows)}"
    a, b = canonical(scols, srows, digits), canonical(ocols, orows, digits)
    if a != b:
        sa, sb = set(map(repr, a)), set(map(repr, b))
        return False, f"values differ; spark-only {list(sa - sb)[:2]} oracle-only {list(sb - sa)[:2]}"
    return True, ""
