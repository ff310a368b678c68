"""Tabular machine learning as Spark jobs: load, split, fit, predict, evaluate."""

import sys

from pyspark import cloudpickle

from plumbline.operators.evaluate import (
    accuracy,
    cluster_sizes,
    dataset_profile,
    num_classes,
    num_classes_max,
    pair_with_truth,
    utilization_summary,
)
from plumbline.operators.forest import ForestModel, fit_random_forest
from plumbline.operators.kmeans import CentroidModel, fit_kmeans, lloyd
from plumbline.operators.knn import KnnModel, fit_knn
from plumbline.operators.labels import encode_first_seen
from plumbline.operators.nearest import nearest_neighbors
from plumbline.operators.order import cap_rows, with_row_id
from plumbline.operators.split import Split, split_by_key
from plumbline.plans.jobs import forest_job, kmeans_job, knn_job, sweep
from plumbline.session import build_session, shared_folder, written_table
from plumbline.sources.labelled_csv import load_labelled_csv
from plumbline.sources.report_csv import read_report, report_summary, write_report
from plumbline.streaming.scoring import score_stream
from plumbline.streaming.utilization import merge_run_parts, utilization_runs, utilization_stream

# The functions that run inside tasks travel with the job, so executors do not
# need this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = [
    "CentroidModel",
    "ForestModel",
    "KnnModel",
    "Split",
    "accuracy",
    "build_session",
    "cap_rows",
    "cluster_sizes",
    "dataset_profile",
    "encode_first_seen",
    "fit_kmeans",
    "fit_knn",
    "fit_random_forest",
    "forest_job",
    "kmeans_job",
    "knn_job",
    "lloyd",
    "load_labelled_csv",
    "merge_run_parts",
    "nearest_neighbors",
    "num_classes",
    "num_classes_max",
    "pair_with_truth",
    "read_report",
    "report_summary",
    "score_stream",
    "shared_folder",
    "split_by_key",
    "sweep",
    "utilization_runs",
    "utilization_stream",
    "utilization_summary",
    "with_row_id",
    "write_report",
    "written_table",
]
