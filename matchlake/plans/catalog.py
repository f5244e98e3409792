"""All registered queries (importing the plan modules fills the registry)."""

from matchlake.plans import q_calibration, q_cluster, q_features, q_knn, q_metrics, q_ml, q_models, q_stream_io, q_text  # noqa: F401
from matchlake.plans.registry import QUERIES, SQL  # noqa: F401
