"""sluice: a Spark-native loader that turns ordered logs of change messages
(SCHEMA / RECORD / BATCH / STATE / ACTIVATE_VERSION) into maintained tables.

Every step is a DataFrame job: parse once to VARIANT, shape to typed columns,
keep the latest row per key, merge with one keyed join, publish a snapshot and
a ledger entry together.
"""

from sluice.options import LoadOptions
from sluice.session import build_session, configure, shared_dir

__all__ = ["LoadOptions", "build_session", "configure", "shared_dir"]
