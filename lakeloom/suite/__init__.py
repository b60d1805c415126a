"""The registered checks: every operator on the generated tables, with its SQL twin.

``CASES`` maps a name to (run, sql): ``run(spark, sf_dir)`` returns a DataFrame
and ``sql`` is the same question in plain SQL, or None where SQL cannot say it.
"""

from __future__ import annotations

from lakeloom.suite import flows, models, rows, values

CASES = {**rows.CASES, **values.CASES, **models.CASES, **flows.CASES}
