from outcomekit.functions.expr import (
    clamp_negative, season_of_month, weekday_mon0, safe_div, hash_bucket, hash_unit,
    to_double_round,
)
from outcomekit.functions.quantiles import exact_quantiles
from outcomekit.functions.prefix import running_totals
from outcomekit.functions.dist import t_two_sided_p, student_t_sf

__all__ = ["clamp_negative", "season_of_month", "weekday_mon0", "safe_div", "hash_bucket",
           "hash_unit", "to_double_round", "exact_quantiles", "running_totals",
           "t_two_sided_p", "student_t_sf"]
