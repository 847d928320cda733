from retentia.functions.dates import month_diff, month_index, month_start, parse_date
from retentia.functions.numeric import money_avg, money_sum, pct, round_doubles, round_half_up, safe_div

__all__ = ["money_avg", "money_sum", "month_diff", "month_index", "month_start", "parse_date", "pct", "round_doubles", "round_half_up",
           "safe_div"]
