"""Plans as text."""

from __future__ import annotations

import contextlib
import io


def plan_of(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()
