"""Batch title scoring (M6): many requested titles in one job.

requests -> resolve (J2, K3, P3) -> reviews of resolved titles (J3, P4) ->
words -> ids with the training vocabulary (or one refitted per title, M7) ->
fixed length -> model scores (M4, M5) -> mean per title (A2) -> verdict (P5).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame

from tonality.operators.score import requested_reviews, resolve_titles, title_verdicts
from tonality.operators.search import TitleIndex, search_titles
from tonality.plans.features import preprocess, preprocess_by_group
from tonality.session import shared_dir
from tonality.sources.stages import read_stage, write_stage

Scorer = Callable[[DataFrame], DataFrame]


def score_titles(requests: DataFrame, catalogue: DataFrame, reviews: DataFrame,
                 scorer: Scorer, vocab: DataFrame | None = None, max_words: int = 10000,
                 max_len: int = 100, vocab_scope: str = "training", average: str = "vote",
                 threshold: float = 0.5, index: TitleIndex | None = None) -> DataFrame:
    """``(request, title, n_reviews, score, sentiment, status)``.

    With an ``index`` of the catalogue a request finds the first title that contains it
    (``operators/search``), else the title that equals it.

    ``reviews`` is ``(title, doc_id, review)``; ``scorer`` adds ``prediction``
    and ``probability`` to a ``(doc_id, title, features)`` frame.
    ``vocab_scope='training'`` encodes with ``vocab`` (the training ids);
    ``'per_title'`` refits one vocabulary per title as the reference's
    serving code does.  ``average='vote'`` averages hard predictions,
    ``'mean_prob'`` the class-1 probabilities.
    """
    # One row per request; used twice (filter and verdict), so written once to the
    # shared folder, which also tells Catalyst its size.
    spark = requests.sparkSession
    found = resolve_titles(requests, catalogue) if index is None else search_titles(requests, index)
    path = write_stage(found, shared_dir(spark, "requests", uuid.uuid4().hex))
    resolved = read_stage(spark, path)
    wanted = requested_reviews(resolved, reviews)
    if vocab_scope == "training":
        if vocab is None:
            raise ValueError("vocab_scope='training' needs the training vocabulary")
        feats, _ = preprocess(wanted, text_col="review", key_col="doc_id", carry=["title"],
                              max_words=max_words, max_len=max_len, vocab=vocab)
    elif vocab_scope == "per_title":
        feats, _ = preprocess_by_group(wanted, "title", text_col="review", key_col="doc_id",
                                       max_words=max_words, max_len=max_len)
    else:
        raise ValueError("vocab_scope must be 'training' or 'per_title'")
    scored = scorer(feats)
    value = {"vote": "prediction", "mean_prob": "probability"}[average]
    return title_verdicts(resolved, scored, value_col=value, threshold=threshold)
