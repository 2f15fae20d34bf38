"""Physical-plan checks used by tests and the bench report."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The ``explain`` text of ``df`` (captured, not printed)."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def has_node(df: DataFrame, name: str) -> bool:
    return name in plan_text(df)


def python_udf_free(df: DataFrame) -> bool:
    text = plan_text(df)
    return not any(n in text for n in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF"))
