"""Column expressions: pure ``Column -> Column`` helpers, all JVM-side."""

from portolan.functions.columns import (
    as_col,
    cell_text,
    fixed_mean,
    fixed_sum,
    fixed_units,
    guarded_ratio,
    log_scale,
    missing,
    month_label,
    period_month,
    period_year,
    quarter_label,
    quarter_of,
    text_head,
)

__all__ = [
    "as_col", "cell_text", "fixed_mean", "fixed_sum", "fixed_units",
    "guarded_ratio", "log_scale", "missing", "month_label", "period_month",
    "period_year", "quarter_label", "quarter_of", "text_head",
]
