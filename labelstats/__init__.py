"""Profiling and classification of labelled numeric tables on Spark DataFrames."""

from labelstats.operators.correlation import correlation
from labelstats.operators.frequency import kth_value, mode_by_class, top_value, value_counts
from labelstats.operators.keyed import (
    keyed_mean,
    keyed_sum,
    keyed_sum_long,
    keyed_sum_wide,
    row_extreme,
)
from labelstats.operators.labels import index_labels, label_numbers
from labelstats.operators.metrics import (
    accuracy,
    compare_models,
    confusion,
    confusion_long,
    error_rate,
    misclassified,
    misclassified_counts,
    sensitivity_specificity,
)
from labelstats.operators.models import (
    decision_tree,
    linear_svc,
    mlp,
    mlp_sweep,
    score,
    score_models,
)
from labelstats.operators.prepare import (
    Prepared,
    fit_preparation,
    hash_split,
    prep_stages,
    prepare,
    random_split,
    with_split,
)
from labelstats.operators.quality import PLACEHOLDERS, missing_counts
from labelstats.operators.quantiles import (
    RANK_ERROR,
    boxplot_stats,
    median_approx_by_class,
    median_by_class,
    quantiles_by_class,
)
from labelstats.operators.shape import (
    columns_to_left,
    drop_columns,
    filter_class,
    first_rows,
    numeric_features,
    to_long,
    to_wide,
    union_frames,
)
from labelstats.operators.split import exact_split
from labelstats.operators.states import merge_states, summary_of_state, summary_state
from labelstats.operators.summary import (
    class_counts,
    class_stat,
    class_summary,
    row_count,
    table_min_max,
    table_summary,
)
from labelstats.sources.readers import (
    CheckedRows,
    labelled_schema,
    read_csv,
    read_csv_checked,
    read_table,
)

__all__ = [
    "CheckedRows",
    "RANK_ERROR",
    "PLACEHOLDERS",
    "Prepared",
    "accuracy",
    "boxplot_stats",
    "class_counts",
    "class_stat",
    "class_summary",
    "columns_to_left",
    "compare_models",
    "confusion",
    "confusion_long",
    "correlation",
    "decision_tree",
    "drop_columns",
    "error_rate",
    "exact_split",
    "filter_class",
    "first_rows",
    "fit_preparation",
    "hash_split",
    "index_labels",
    "keyed_mean",
    "keyed_sum",
    "keyed_sum_long",
    "keyed_sum_wide",
    "kth_value",
    "label_numbers",
    "labelled_schema",
    "linear_svc",
    "median_approx_by_class",
    "median_by_class",
    "merge_states",
    "misclassified",
    "misclassified_counts",
    "missing_counts",
    "mlp",
    "mlp_sweep",
    "mode_by_class",
    "numeric_features",
    "prep_stages",
    "prepare",
    "quantiles_by_class",
    "random_split",
    "read_csv",
    "read_csv_checked",
    "read_table",
    "row_count",
    "row_extreme",
    "score",
    "score_models",
    "sensitivity_specificity",
    "summary_of_state",
    "summary_state",
    "table_min_max",
    "table_summary",
    "to_long",
    "to_wide",
    "top_value",
    "union_frames",
    "value_counts",
    "with_split",
]
