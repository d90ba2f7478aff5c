"""Declared schemas of tables that are read back."""

QA = "question STRING, answer STRING"
PREDICTIONS = (
    "gt_ret_1y STRING, gt_vol_1y STRING, pred_ret_1y STRING, pred_vol_1y STRING"
)
FOLD_METRICS = "fold INT, metric STRING, value DOUBLE"
