"""Independent DuckDB statements that state what each registered query must return."""

from __future__ import annotations

from duck_oracle.ride import RIDE
from duck_oracle.workforce import WORKFORCE

STATEMENTS: dict[str, str] = {**RIDE, **WORKFORCE}
