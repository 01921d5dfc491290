"""Order-insensitive comparison of a Spark result with an oracle result."""

from __future__ import annotations

import math


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 4)
    if hasattr(v, "isoformat"):
        s = str(v)
        return s[:19] if s[19:26].strip(".0") == "" else s
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def canonical(cols, rows):
    """Columns sorted by name; rows normalized and sorted."""
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=lambda t: tuple((x is None, str(x)) for x in t))
    return [cols[i] for i in order], out


def diff(scols, srows, dcols, drows) -> str | None:
    """None when equal, else a short description of the first difference."""
    sc, sr = canonical(scols, srows)
    dc, dr = canonical(dcols, drows)
    if sc != dc:
        return f"columns differ: spark {sc} oracle {dc}"
    if len(sr) != len(dr):
        return f"rows differ: spark {len(sr)} oracle {len(dr)}"
    for x, y in zip(sr, dr):
        if x != y:
            return f"values differ: spark {x} oracle {y}"
    return None
