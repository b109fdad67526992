from panelmill.models.boosting import Forest, Spec, bin_rows, fit_forests, score_forests
from panelmill.models.linear import add_direction, fit_logistic, fit_ridge
from panelmill.models.trees import candidate_grid, feature_importance, fit_candidates

__all__ = [
    "Forest", "Spec", "add_direction", "bin_rows", "candidate_grid", "feature_importance", "fit_candidates", "fit_forests", "fit_logistic",
    "fit_ridge", "score_forests",
]
