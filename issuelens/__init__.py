"""issuelens: issue-tracker page analytics as Spark jobs.

Landed pages of nested issue JSON are scanned once, parsed into VARIANT, and turned
into flat report tables with DataFrame expressions (paths, higher-order functions,
windows, pivots).  The one real analytic is the time every issue spent in each status.
"""

from issuelens.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
