"""Column expressions (all JVM-side, no Python UDFs)."""

from riskspark.functions.parse import (  # noqa: F401
    default_flag, emp_length_years, month_year, term_months,
)
from riskspark.functions.features import interaction_columns, safe_div  # noqa: F401
from riskspark.functions.bands import decision, psi_band, risk_band  # noqa: F401
