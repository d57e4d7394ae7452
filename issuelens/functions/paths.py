"""Path specs -> VARIANT JSON paths, and typed extraction (N9 core, F16, F17).

A path is a sequence of steps as the reference writes them: names, or 1-based integer
positions (``("content", 1, "content", 1, "text")``).  They compile to Spark's 0-based
variant path syntax (``$.content[0].content[0].text``).  ``try_variant_get`` yields NULL
for an absent key, a JSON null, an out-of-range index and a scalar where an object was
expected, which is exactly the "missing -> NA" contract of the reference's safe hoist.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Step = str | int
_PLAIN = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def as_steps(path: Step | Sequence[Step]) -> tuple[Step, ...]:
    if isinstance(path, (str, int)):
        return (path,)
    return tuple(path)


def variant_path(path: Step | Sequence[Step]) -> str:
    """``("a", 1, "b c")`` -> ``$.a[0]['b c']``."""
    out = "$"
    for step in as_steps(path):
        if isinstance(step, bool):
            raise TypeError("boolean path step")
        if isinstance(step, int):
            if step < 1:
                raise ValueError(f"path positions are 1-based, got {step}")
            out += f"[{step - 1}]"
        elif _PLAIN.match(step):
            out += f".{step}"
        else:
            if "'" in step:
                raise ValueError(f"quote in path step {step!r}")
            out += f"['{step}']"
    return out
