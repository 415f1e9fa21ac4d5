"""siltgate: rule-driven quarantine, data-quality gates and lead times on Spark.

The package is split by what a caller does with it:

* ``functions``  - column expressions (blank tests, numbers, timestamps, durations)
* ``sources``    - scans, sinks, layer names, staging of intermediate tables
* ``operators``  - DataFrame operators (dedup, classify, lookups, checks, process)
* ``plans``      - the two concrete table sets and their end-to-end runs
"""

from siltgate.context import RunContext
from siltgate.contracts import CheckSpec, Intake, Lookup, Rule, StageModel

__all__ = ["CheckSpec", "Intake", "Lookup", "Rule", "RunContext", "StageModel"]
