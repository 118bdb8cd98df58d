"""tonality: review sentiment analytics on Spark.

The user-facing functions, by the names of the operations they replace:
"""

from tonality.operators.encode import encode, pad
from tonality.operators.evaluate import accuracy_f1, log_loss, roc_auc
from tonality.operators.metrics import request_log, request_metrics
from tonality.operators.select import best_run
from tonality.operators.split import holdout_split, shuffled
from tonality.operators.train import train_logistic_grid as train_grid
from tonality.operators.train import train_neural
from tonality.operators.vocab import fit_vocabulary, fit_vocabulary_by
from tonality.plans.features import preprocess, tokenize
from tonality.plans.serving import score_titles
from tonality.plans.training import best_model, train_and_log, train_from_text_dirs
from tonality.sources.text_files import load_labelled_dirs, load_reviews

__all__ = [
    "load_reviews", "load_labelled_dirs", "tokenize", "fit_vocabulary", "fit_vocabulary_by", "encode",
    "pad", "preprocess", "holdout_split", "shuffled", "train_grid", "train_neural", "train_and_log",
    "train_from_text_dirs", "best_run", "best_model", "accuracy_f1", "roc_auc", "log_loss",
    "score_titles", "request_log", "request_metrics",
]
