"""End-to-end jobs built from the operators."""

from croptide.plans.indices import assemble_inputs, compute_index_store
from croptide.plans.observations import load_observations
from croptide.plans.regional import process_regions_daily, regional_features
from croptide.plans.weekly import (
    belt_series,
    predictor_methods,
    predictor_run,
    weekly_predictors,
)

__all__ = ["assemble_inputs", "belt_series", "compute_index_store",
           "load_observations", "predictor_methods", "predictor_run", "process_regions_daily",
           "regional_features", "weekly_predictors"]
