from .timecols import (add_seconds, add_steps, day_of, epoch_seconds, epoch_us, floor_ts, season,
                       step_seconds, steps_between)
from .exprs import (all_not_null, any_null, mae, mape, metric_aggs, n_scored, nan_to_null, point_loss,
                    rmse, round_doubles, safe_div, smape)

__all__ = [
    "add_seconds", "add_steps", "day_of", "epoch_seconds", "epoch_us", "floor_ts", "season", "step_seconds",
    "steps_between", "all_not_null", "any_null", "mae", "mape", "metric_aggs", "n_scored", "nan_to_null",
    "point_loss", "rmse", "round_doubles", "safe_div", "smape",
]
