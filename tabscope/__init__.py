"""Exploratory analysis of tables as Spark jobs.

Every operator takes DataFrames and returns a lazy, tidy DataFrame. Requests
are checked against the schema before anything runs; an invalid one raises
``AnalysisError``.
"""

from tabscope.errors import AnalysisError
from tabscope.functions.columns import non_numeric_columns, numeric_columns, select_numeric
from tabscope.functions.filters import where_dates, where_values
from tabscope.functions.names import name_similarity, normalized_name
from tabscope.functions.periods import add_period_column, period_label, period_start
from tabscope.operators.changes import change_highlights, compare_years, overall_change, percentage_change
from tabscope.operators.charts import box_plot, create_multi_dataset_visualization, create_visualization, histogram, visible_line
from tabscope.operators.correlation import constant_columns, correlation_analysis, correlation_extremes
from tabscope.operators.findings import findings
from tabscope.operators.groupby import best_and_worst_group, compare_two_groups, group_ranking, groupby_analysis
from tabscope.operators.joins import execute_join, inspect_join_viability, key_counts
from tabscope.operators.missing import missing_totals, missing_values
from tabscope.operators.outliers import outlier_analysis, outlier_examples
from tabscope.operators.profile import candidate_group_columns, dataset_info, potential_identifiers, sample_values
from tabscope.operators.relationships import discover_relationships, schema_graph, score_key_pair, value_overlap
from tabscope.operators.statistics import statistics
from tabscope.operators.timeseries import pivot_series, series_summary, time_analysis
from tabscope.sources.csv import column_types, infer_types, load_dataset, preview, shape
from tabscope.sources.dates import convert_date_columns, date_columns, detect_date_columns
from tabscope.sources.manifest import changed_files, file_manifest

__all__ = [name for name in dir() if not name.startswith("_") and name not in ("errors", "functions", "operators", "sources")]
