"""The registered queries: a Spark plan and (where SQL can say it) a DuckDB oracle.

Every query reads the given tables in full; floats are rounded to 6 places
and arrays are emitted as space-separated text so the oracle comparison is
exact.  ``QUERIES[name] = (spark_fn, sql_or_None)``.

Inputs the reference gets from elsewhere are derived from the tables, so each
query's work grows with them: reviews are ``documents`` joined to ``labels``;
scores for the metric queries are ``(n_chars % 1000) / 1000``; the linear
scorer uses pinned dyadic weights; title requests are spellings of every
catalogue title plus one unknown title each; runs are one per (language,
title) slice; the request log is ``events`` read through ``request_log``.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonality.functions.text import ids_text, ml_tokens, remove_stop_words, join_tokens
from tonality.operators import split as split_ops
from tonality.operators.encode import encode
from tonality.operators.reviews import with_label, union_reviews
from tonality.operators.vocab import fit_vocabulary, word_counts
from tonality.plans import oracle as O
from tonality.plans.features import preprocess, tokenize
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array

from tonality.operators.evaluate import accuracy_f1, log_loss, metric_errors, roc_auc
from tonality.operators.score import model_scores
from tonality.operators.train import (LOGISTIC_GRID, NEURAL_GRID, LogisticConfig, evaluate_text_classifier, fit_logistic,
                                      fit_text_classifier, train_neural_grid)
from tonality.plans.training import best_model, build_features, train_and_log
from tonality.sources.stages import load_model, save_model
from tonality.operators.metrics import counter_deltas, gauges, metrics_long, request_log, request_totals, resample
from tonality.streaming.metrics import file_stream, latest_windows, single_file_glob, start_metrics_stream
from tonality.streaming.scoring import freeze_vocabulary, start_scoring_stream, start_title_stream
from tonality.operators.score import linear_scores, resolve_titles
from tonality.operators.select import best_run
from tonality.operators.vocab import fit_vocabulary_by
from tonality.operators.weights import idf_weights, tfidf_weights
from tonality.plans.serving import score_titles
from tonality.session import shared_dir
from tonality.sources.runs import log_runs, search_experiments, search_runs
from tonality.sources.stages import new_stage_root, read_features, read_raw, read_stage, write_features, write_raw
from tonality.sources.text_files import flatten_reviews, load_reviews
from tonality.sources.tables import labelled_reviews, table, text_table, title_catalogue, title_reviews

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, tuple[QueryFn, str | None]] = {}

MAX_WORDS = 10000   # reference default vocabulary size
MAX_LEN = 100       # reference default sequence length


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = (fn, sql)
        return fn
    return deco


# --- S2 U1 P2 -----------------------------------------------------------------
@register("reviews_union", f"""
SELECT doc_id, value, 1 AS label FROM ({O.REVIEWS}) WHERE label = 1
UNION ALL
SELECT doc_id, value, 0 AS label FROM ({O.REVIEWS}) WHERE label = 0
""")
def q_reviews_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    reviews = labelled_reviews(spark, sf_dir)
    pos = with_label(reviews.where(F.col("label") == 1).select("doc_id", "value"), 1)
    neg = with_label(reviews.where(F.col("label") == 0).select("doc_id", "value"), 0)
    return union_reviews(pos, neg)


# --- K1 -------------------------------------------------------------------------
@register("shuffle_key", f"""
SELECT doc_id, label, md5(CAST(doc_id AS VARCHAR) || ':42') AS shuffle_key
FROM ({O.REVIEWS}) ORDER BY shuffle_key
""")
def q_shuffle_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    reviews = labelled_reviews(spark, sf_dir).select("doc_id", "label")
    return split_ops.shuffled(reviews, "doc_id", seed=42)


# --- T1 -------------------------------------------------------------------------
@register("tokens", f"""
SELECT doc_id, pos, token FROM (
  SELECT doc_id, unnest(toks) AS token, generate_subscripts(toks, 1) - 1 AS pos
  FROM (SELECT doc_id, {O.ml_tokens('text')} AS toks FROM documents))
WHERE token <> ''
""")
def q_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = text_table(spark, sf_dir).select("doc_id", ml_tokens(F.col("text")).alias("toks"))
    # outer + null filter: a plain posexplode lets Catalyst push a tokenising
    # size() filter below the input spreading (see operators/vocab.word_counts)
    return (docs.select("doc_id", F.posexplode_outer("toks").alias("pos", "token"))
            .where(F.col("token").isNotNull() & (F.col("token") != ""))
            .select("doc_id", F.col("pos").cast("bigint").alias("pos"), "token"))


# --- T2 T4 ----------------------------------------------------------------------
@register("stopwords_removed", f"""
SELECT doc_id, array_to_string({O.drop_stop_words(O.ml_tokens('text'))}, ' ') AS filtered_text
FROM documents
""")
def q_stopwords_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = text_table(spark, sf_dir)
    return docs.select("doc_id", join_tokens(remove_stop_words(ml_tokens(F.col("text")))).alias("filtered_text"))


# --- T5 A1 ----------------------------------------------------------------------
@register("word_counts", f"""
WITH {O.words_ctes("SELECT doc_id, text AS value FROM documents", "doc_id")}
SELECT word, count(*) AS n FROM (SELECT unnest(words) AS word FROM w) GROUP BY word
""")
def q_word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = text_table(spark, sf_dir).select("doc_id", F.col("text").alias("value"))
    return word_counts(tokenize(docs, keep=["doc_id"])).select("word", "n")


# --- K2 -------------------------------------------------------------------------
@register("vocabulary_topk", f"""
WITH {O.words_ctes(O.REVIEWS)},
{O.vocab_ctes(MAX_WORDS)}
SELECT word, n, id FROM vocab
""")
def q_vocabulary_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = tokenize(labelled_reviews(spark, sf_dir))
    return fit_vocabulary(words, MAX_WORDS)


# --- J1 T6 ----------------------------------------------------------------------
@register("encoded_sequences", f"""
WITH {O.words_ctes(O.REVIEWS)},
{O.vocab_ctes(MAX_WORDS)},
{O.encode_ctes()}
SELECT doc_id, label, CAST(len(seq) AS INTEGER) AS n_ids, {O.ids_text('seq')} AS seq FROM enc
""")
def q_encoded_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = tokenize(labelled_reviews(spark, sf_dir))
    vocab = fit_vocabulary(words, MAX_WORDS)
    seqs = encode(words, vocab, keys=["doc_id", "label"], num_words=MAX_WORDS)
    return seqs.select("doc_id", "label", F.size("seq").alias("n_ids"), ids_text("seq").alias("seq"))


# --- T1-T7 J1 K2 (flagship) -----------------------------------------------------
PADDED_SQL = f"""
{O.padded_ctes(MAX_WORDS, MAX_LEN)}
SELECT doc_id, label, {O.ids_text('features')} AS features FROM feat
"""


@register("padded_sequences", PADDED_SQL)
def q_padded_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    feats, _ = preprocess(labelled_reviews(spark, sf_dir), max_words=MAX_WORDS, max_len=MAX_LEN)
    return feats.select("doc_id", "label", ids_text("features").alias("features"))


# --- M1 -------------------------------------------------------------------------
@register("holdout_split_exact", f"""
SELECT doc_id, label, CASE WHEN row_number() OVER (ORDER BY md5(CAST(doc_id AS VARCHAR) || ':42') DESC)
  <= ceil(0.2 * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split FROM ({O.REVIEWS})
""")
def q_holdout_split_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: exactly a fifth of the reviews, rounded up, is held out."""
    reviews = labelled_reviews(spark, sf_dir).select("doc_id", "label")
    return split_ops.holdout_split_exact(reviews, "doc_id", test_size=0.2, seed=42)


@register("holdout_split", f"""
SELECT doc_id, label, CASE WHEN {O.split_bucket('doc_id')} < 800000 THEN 'train' ELSE 'test' END AS split
FROM ({O.REVIEWS})
""")
def q_holdout_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    reviews = labelled_reviews(spark, sf_dir).select("doc_id", "label")
    return split_ops.holdout_split(reviews, "doc_id", test_size=0.2, seed=42)


# --- T9 -------------------------------------------------------------------------
@register("idf_weights", f"""
WITH docs AS (SELECT doc_id, list_filter({O.drop_stop_words(O.ml_tokens('value'))}, lambda w: w <> '') AS toks
              FROM ({O.REVIEWS})),
m AS (SELECT count(*) AS m FROM docs),
dfs AS (SELECT word, count(*) AS df FROM (SELECT DISTINCT doc_id, word FROM
        (SELECT doc_id, unnest(toks) AS word FROM docs)) GROUP BY word)
SELECT word, df, round(ln((m + 1.0) / (df + 1.0)), 6) AS idf FROM dfs, m
""")
def q_idf_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    reviews = labelled_reviews(spark, sf_dir)
    words = reviews.select("doc_id", F.filter(remove_stop_words(ml_tokens(F.col("value"))),
                                              lambda w: w != "").alias("words"))
    w = idf_weights(words)
    return w.select("word", "df", F.round("idf", 6).alias("idf"))


# --- A3 A5 / A4 / M9 over a score derived from the data -------------------------
def scored_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled reviews with ``score = (n_chars % 1000) / 1000``, a hard
    prediction (score above 0.5), the hold-out split and the slice keys."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang", F.col("source").alias("title"))
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    score = (F.col("n_chars") % 1000) / F.lit(1000.0)
    j = docs.join(labels, "doc_id").withColumn("score", score)
    j = j.withColumn("prediction", F.when(F.col("score") > 0.5, F.lit(1)).otherwise(F.lit(0)))
    return split_ops.holdout_split(j, "doc_id", 0.2, 42)


SCORED_SQL = f"""SELECT d.doc_id, d.lang, d.source AS title, l.quality AS label,
  (d.n_chars % 1000) / 1000.0::DOUBLE AS score,
  CASE WHEN (d.n_chars % 1000) / 1000.0::DOUBLE > 0.5 THEN 1 ELSE 0 END AS prediction,
  CASE WHEN {O.split_bucket('d.doc_id')} < 800000 THEN 'train' ELSE 'test' END AS split
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""


@register("accuracy_f1", f"""
WITH s AS ({SCORED_SQL}),
c AS (SELECT split, count(*) AS n,
  CAST(sum(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
  CAST(sum(CASE WHEN label = 0 AND prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
  CAST(sum(CASE WHEN label = 1 AND prediction = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
  CAST(sum(CASE WHEN label = 0 AND prediction = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn
  FROM s GROUP BY split)
SELECT split, n, tp, fp, fn, tn, round((tp + tn) / n, 6) AS accuracy,
  round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2.0 * tp / (2 * tp + fp + fn) END, 6) AS f1_score
FROM c
""")
def q_accuracy_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = accuracy_f1(scored_reviews(spark, sf_dir), by=["split"])
    return m.withColumn("accuracy", F.round("accuracy", 6)).withColumn("f1_score", F.round("f1_score", 6))


@register("roc_auc", f"""
WITH s AS ({SCORED_SQL}),
g AS (SELECT split, score, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos,
      sum(CASE WHEN label = 0 THEN 1 ELSE 0 END) AS neg FROM s GROUP BY split, score),
c AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY split ORDER BY score
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)
SELECT split, CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg,
  round(sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)), 6) AS roc_auc
FROM c GROUP BY split
""")
def q_roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = roc_auc(scored_reviews(spark, sf_dir), score_col="score", by=["split"])
    return r.withColumn("roc_auc", F.round("roc_auc", 6))


@register("log_loss", f"""
WITH s AS ({SCORED_SQL})
SELECT split, round(-avg(label * ln(least(greatest(score, 1e-7), 1 - 1e-7))
  + (1 - label) * ln(1 - least(greatest(score, 1e-7), 1 - 1e-7))), 6) AS log_loss, count(*) AS n
FROM s GROUP BY split
""")
def q_log_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = log_loss(scored_reviews(spark, sf_dir), prob_col="score", by=["split"])
    return r.withColumn("log_loss", F.round("log_loss", 6))


# --- M4 M5 with pinned weights ---------------------------------------------------
# Fixed query parameters: dyadic weights so every dot product is exact.
PINNED_COEF = [((j % 5) - 2) / 2.0 ** 20 for j in range(MAX_LEN)]
PINNED_INTERCEPT = 1.0 / 64
PINNED_SQL_W = "[" + ", ".join(repr(x) for x in PINNED_COEF) + "]::DOUBLE[]"


def pinned_scorer(df: DataFrame) -> DataFrame:
    return linear_scores(df, PINNED_COEF, PINNED_INTERCEPT)


def _margin_sql(features: str) -> str:
    return f"({PINNED_INTERCEPT!r} + list_dot_product(CAST({features} AS DOUBLE[]), {PINNED_SQL_W}))"


@register("linear_score", f"""
{O.padded_ctes(MAX_WORDS, MAX_LEN)},
sc AS (SELECT doc_id, label, {_margin_sql('features')} AS margin FROM feat)
SELECT doc_id, label, round(margin, 6) AS margin, round(1.0 / (1.0 + exp(-margin)), 6) AS probability,
  CASE WHEN margin > 0 THEN 1 ELSE 0 END AS prediction FROM sc
""")
def q_linear_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    feats, _ = preprocess(labelled_reviews(spark, sf_dir), max_words=MAX_WORDS, max_len=MAX_LEN)
    s = pinned_scorer(feats)
    return s.select("doc_id", "label", F.round("margin", 6).alias("margin"),
                    F.round("probability", 6).alias("probability"), "prediction")


# --- J2 K3 P3 ------------------------------------------------------------------
def title_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests derived from the catalogue: an upper-case and a punctuated
    spelling of every title (both resolve) and one unknown title each."""
    cat = title_catalogue(spark, sf_dir)
    return union_reviews(cat.select(F.upper("title").alias("request")),
                         cat.select(F.concat("title", F.lit("!")).alias("request")),
                         cat.select(F.concat(F.lit("no such "), "title").alias("request")))


_NORM = r"'[^\p{L}\p{N}]'"


def _resolve_ctes(catalogue: str, requests: str, on: str = "rk.k = ck.k") -> str:
    return f"""cat AS ({catalogue}),
req AS (SELECT DISTINCT request FROM ({requests})),
rk AS (SELECT request, regexp_replace(lower(request), {_NORM}, '', 'g') AS k FROM req),
ck AS (SELECT * FROM (SELECT title, regexp_replace(lower(title), {_NORM}, '', 'g') AS k FROM cat) WHERE k <> ''),
hit AS (SELECT rk.request, ck.title, row_number() OVER (PARTITION BY rk.request
        ORDER BY CASE WHEN ck.title = rk.request THEN 0 ELSE 1 END, length(ck.title), ck.title) AS rn
        FROM rk LEFT JOIN ck ON {on}),
res AS (SELECT request, title, CASE WHEN title IS NULL THEN 'invalid_title' ELSE 'ok' END AS status
        FROM hit WHERE rn = 1)"""


RESOLVE_CTES = _resolve_ctes("SELECT DISTINCT source AS title FROM documents",
                             "SELECT upper(title) AS request FROM cat UNION ALL SELECT title || '!' FROM cat "
                             "UNION ALL SELECT 'no such ' || title FROM cat")


@register("title_resolution", f"""
WITH {RESOLVE_CTES}
SELECT request, title, status FROM res
""")
def q_title_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve_titles(title_requests(spark, sf_dir), title_catalogue(spark, sf_dir))


@register("title_resolution_spellings", f"""
WITH {_resolve_ctes("SELECT DISTINCT source AS title FROM documents UNION SELECT upper(source) FROM documents "
                    "UNION SELECT upper(source) || '-' FROM documents",
                    "SELECT title AS request FROM cat UNION ALL SELECT title || '?' FROM cat "
                    "UNION ALL SELECT ' ' || lower(title) FROM cat")}
SELECT request, title, status FROM res
""")
def q_title_resolution_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 where the catalogue holds several spellings of a title: the exact one wins."""
    own = title_catalogue(spark, sf_dir)
    catalogue = union_reviews(own, own.select(F.upper("title").alias("title")),
                              own.select(F.concat(F.upper("title"), F.lit("-")).alias("title"))).distinct()
    requests = union_reviews(catalogue.select(F.col("title").alias("request")),
                             catalogue.select(F.concat("title", F.lit("?")).alias("request")),
                             catalogue.select(F.concat(F.lit(" "), F.lower("title")).alias("request")))
    return resolve_titles(requests, catalogue)


# --- J3 P4 A2 P5 (M6 with the pinned scorer) ------------------------------------
def title_sentiment_sql(resolve_ctes: str) -> str:
    """Verdicts of the requests that ``resolve_ctes`` names, pinned scorer and training vocabulary."""
    return f"""
WITH {resolve_ctes},
{O.words_ctes(O.REVIEWS)},
{O.vocab_ctes(MAX_WORDS)},
{O.words_ctes("SELECT d.doc_id, d.source AS title, coalesce(d.text, '') AS value FROM documents d "
              "WHERE d.source IN (SELECT title FROM res WHERE status = 'ok')", "doc_id, title", p="r")},
{O.tok_cte("r")},
{O.encode_ctes("doc_id, title", p="r", vocab="vocab")},
rsc AS (SELECT doc_id, title, {_margin_sql(O.pad('seq', MAX_LEN))} AS margin FROM renc),
pt AS (SELECT title, count(*) AS n_reviews, avg(CASE WHEN margin > 0 THEN 1.0 ELSE 0.0 END) AS score
       FROM rsc GROUP BY title)
SELECT res.request, res.title, coalesce(pt.n_reviews, 0) AS n_reviews, round(pt.score, 6) AS score,
  CASE WHEN pt.n_reviews IS NULL THEN NULL WHEN pt.score >= 0.5 THEN 'Positive' ELSE 'Negative' END AS sentiment,
  CASE WHEN res.status <> 'ok' THEN res.status WHEN pt.n_reviews IS NULL THEN 'no_reviews' ELSE 'ok' END AS status
FROM res LEFT JOIN pt ON res.title = pt.title
"""


@register("title_sentiment", title_sentiment_sql(RESOLVE_CTES))
def q_title_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = fit_vocabulary(tokenize(labelled_reviews(spark, sf_dir)), MAX_WORDS)
    out = score_titles(title_requests(spark, sf_dir), title_catalogue(spark, sf_dir),
                       title_reviews(spark, sf_dir), pinned_scorer, vocab=vocab,
                       max_words=MAX_WORDS, max_len=MAX_LEN)
    return out.withColumn("score", F.round("score", 6))


# --- M7 ----------------------------------------------------------------------------
@register("title_vocabulary", f"""
WITH {O.words_ctes("SELECT doc_id, source AS title, text AS value FROM documents", "doc_id, title")},
{O.vocab_ctes(MAX_WORDS, by="title")}
SELECT title, word, n, id FROM vocab
""")
def q_title_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    reviews = title_reviews(spark, sf_dir)
    words = tokenize(reviews, text_col="review", keep=["doc_id", "title"])
    return fit_vocabulary_by(words, "title", MAX_WORDS)


TOP_WORDS = 200   # fewer than a title's words: most go by the threshold


@register("title_vocabulary_top", f"""
WITH {O.words_ctes("SELECT doc_id, source AS title, text AS value FROM documents", "doc_id, title")},
{O.vocab_ctes(TOP_WORDS, by="title")}
SELECT title, word, n, id FROM vocab
""")
def q_title_vocabulary_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = tokenize(title_reviews(spark, sf_dir), text_col="review", keep=["doc_id", "title"])
    return fit_vocabulary_by(words, "title", TOP_WORDS)


# --- M1 + K2: vocabulary fitted on the train rows only ---------------------------
@register("padded_sequences_train_vocab", f"""
WITH {O.words_ctes(O.REVIEWS)},
tw AS (SELECT * FROM w WHERE {O.split_bucket('doc_id')} < 800000),
{O.vocab_ctes(MAX_WORDS, p="t")},
{O.tok_cte()},
{O.encode_ctes(vocab="tvocab")}
SELECT doc_id, label, {O.ids_text(O.pad('seq', MAX_LEN))} AS features FROM enc
""")
def q_padded_sequences_train_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    feats, _ = preprocess(labelled_reviews(spark, sf_dir), max_words=MAX_WORDS, max_len=MAX_LEN, fit_on="train")
    return feats.select("doc_id", "label", ids_text("features").alias("features"))


# --- M6 with M7: vocabulary refitted per title at scoring ------------------------
@register("title_sentiment_per_title", f"""
WITH {RESOLVE_CTES},
{O.words_ctes("SELECT d.doc_id, d.source AS title, coalesce(d.text, '') AS value FROM documents d "
              "WHERE d.source IN (SELECT title FROM res WHERE status = 'ok')", "doc_id, title", p="r")},
{O.vocab_ctes(MAX_WORDS, p="r", by="title")},
{O.encode_ctes("doc_id, title", p="r", by="title")},
rsc AS (SELECT doc_id, title, {_margin_sql(O.pad('seq', MAX_LEN))} AS margin FROM renc),
pt AS (SELECT title, count(*) AS n_reviews, avg(CASE WHEN margin > 0 THEN 1.0 ELSE 0.0 END) AS score
       FROM rsc GROUP BY title)
SELECT res.request, res.title, coalesce(pt.n_reviews, 0) AS n_reviews, round(pt.score, 6) AS score,
  CASE WHEN pt.n_reviews IS NULL THEN NULL WHEN pt.score >= 0.5 THEN 'Positive' ELSE 'Negative' END AS sentiment,
  CASE WHEN res.status <> 'ok' THEN res.status WHEN pt.n_reviews IS NULL THEN 'no_reviews' ELSE 'ok' END AS status
FROM res LEFT JOIN pt ON res.title = pt.title
""")
def q_title_sentiment_per_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = score_titles(title_requests(spark, sf_dir), title_catalogue(spark, sf_dir),
                       title_reviews(spark, sf_dir), pinned_scorer, vocab_scope="per_title",
                       max_words=MAX_WORDS, max_len=MAX_LEN)
    return out.withColumn("score", F.round("score", 6))


# --- M6 averaging class-1 probabilities instead of votes ---------------------------
@register("title_sentiment_mean_prob", f"""
WITH {RESOLVE_CTES},
{O.words_ctes(O.REVIEWS)},
{O.vocab_ctes(MAX_WORDS)},
{O.words_ctes("SELECT d.doc_id, d.source AS title, coalesce(d.text, '') AS value FROM documents d "
              "WHERE d.source IN (SELECT title FROM res WHERE status = 'ok')", "doc_id, title", p="r")},
{O.tok_cte("r")},
{O.encode_ctes("doc_id, title", p="r", vocab="vocab")},
rsc AS (SELECT doc_id, title, {_margin_sql(O.pad('seq', MAX_LEN))} AS margin FROM renc),
pt AS (SELECT title, count(*) AS n_reviews, avg(1.0 / (1.0 + exp(-margin))) AS score FROM rsc GROUP BY title)
SELECT res.request, res.title, coalesce(pt.n_reviews, 0) AS n_reviews, round(pt.score, 6) AS score,
  CASE WHEN pt.n_reviews IS NULL THEN NULL WHEN pt.score >= 0.5 THEN 'Positive' ELSE 'Negative' END AS sentiment,
  CASE WHEN res.status <> 'ok' THEN res.status WHEN pt.n_reviews IS NULL THEN 'no_reviews' ELSE 'ok' END AS status
FROM res LEFT JOIN pt ON res.title = pt.title
""")
def q_title_sentiment_mean_prob(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = fit_vocabulary(tokenize(labelled_reviews(spark, sf_dir)), MAX_WORDS)
    out = score_titles(title_requests(spark, sf_dir), title_catalogue(spark, sf_dir),
                       title_reviews(spark, sf_dir), pinned_scorer, vocab=vocab,
                       max_words=MAX_WORDS, max_len=MAX_LEN, average="mean_prob")
    return out.withColumn("score", F.round("score", 6))


# --- A6 over runs derived from the data ----------------------------------------
def slice_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per (language, title) slice: its accuracy under the score rule,
    the newest document id as the run's start, the slice size as a param."""
    s = scored_reviews(spark, sf_dir)
    hit = F.when(F.col("prediction") == F.col("label"), F.lit(1.0)).otherwise(F.lit(0.0))
    return s.groupBy("lang", "title").agg(
        F.avg(hit).alias("accuracy"), F.max("doc_id").alias("start_ts"), F.count(F.lit(1)).alias("n")
    ).select(F.col("lang").alias("experiment"), F.concat_ws("/", "lang", "title").alias("run_id"),
             "accuracy", "start_ts",
             F.create_map(F.lit("lang"), F.col("lang"), F.lit("n"), F.col("n").cast("string")).alias("params"))


SLICE_RUNS_SQL = f"""SELECT lang AS experiment, lang || '/' || title AS run_id,
  avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END) AS accuracy, max(doc_id) AS start_ts, count(*) AS n
  FROM ({SCORED_SQL}) GROUP BY lang, title"""


@register("best_run", f"""
WITH runs AS ({SLICE_RUNS_SQL})
SELECT experiment, run_id, round(accuracy, 6) AS accuracy, CAST(start_ts AS BIGINT) AS start_ts FROM runs
WHERE accuracy IS NOT NULL AND NOT isnan(accuracy)
QUALIFY row_number() OVER (PARTITION BY experiment ORDER BY accuracy DESC, start_ts DESC, run_id) = 1
""")
def q_best_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = best_run(slice_runs(spark, sf_dir), by=["experiment"])
    return b.select("experiment", "run_id", F.round("accuracy", 6).alias("accuracy"),
                    F.col("start_ts").cast("bigint").alias("start_ts"))


# --- S7 S8 S9 ----------------------------------------------------------------------
@register("run_log_roundtrip", f"""
WITH runs AS ({SLICE_RUNS_SQL})
SELECT CAST(CAST(('0x' || substr(sha256(experiment), 1, 15)) AS BIGINT) AS VARCHAR) AS experiment_id,
  experiment, run_id, round(accuracy, 6) AS accuracy, CAST(start_ts AS BIGINT) AS start_ts,
  CAST(n AS VARCHAR) AS n, 'active' AS lifecycle_stage
FROM runs
""")
def q_run_log_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "tracking", uuid.uuid4().hex)
    log_runs(slice_runs(spark, sf_dir), root=root)
    log_runs(slice_runs(spark, sf_dir), root=root)     # a repeated call adds nothing
    runs = search_runs(spark, root=root)
    exps = search_experiments(spark, root=root).select("experiment_id", "lifecycle_stage")
    return runs.join(exps, "experiment_id").select(
        "experiment_id", "experiment", "run_id", F.round("accuracy", 6).alias("accuracy"),
        F.col("start_ts").cast("bigint").alias("start_ts"), F.col("params")["n"].alias("n"),
        "lifecycle_stage")


# --- S5 S6 -------------------------------------------------------------------------
@register("stage_roundtrip", PADDED_SQL)
def q_stage_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_stage_root(spark)
    write_raw(labelled_reviews(spark, sf_dir), root)
    feats, _ = preprocess(read_raw(spark, root), max_words=MAX_WORDS, max_len=MAX_LEN)
    write_features(feats, root)
    return read_features(spark, root).select("doc_id", "label", ids_text("features").alias("features"))


# --- request log (A7-A9, R2-R6) ---------------------------------------------------
LOG_SQL = """SELECT event_id, user_id AS instance, event_type AS handler, epoch_us(ts) AS start_us,
  (CAST(round(value * 1e6) AS BIGINT)) / 1e6 AS run_time_s,
  abs(value * 1048576 - json_extract(props, '$.k')::DOUBLE * 1048576) / 1024.0 AS memory_kib,
  json_extract(props, '$.k')::DOUBLE AS cpu_percent,
  event_id * 1500 AS net_bytes_sent,
  event_id * 900 + CAST(json_extract(props, '$.k')::DOUBLE AS BIGINT) AS net_bytes_recv
FROM events"""


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return request_log(table(spark, sf_dir, "events"))


def _latest_sql(v: str) -> str:
    return f"arg_max({v}, {{'a': start_us, 'b': event_id}})"


@register("request_totals", f"""
SELECT handler, count(*) AS requests_total, round(sum(run_time_s), 6) AS duration_sum_s,
  CAST(sum(CASE WHEN run_time_s <= 0.1 THEN 1 ELSE 0 END) AS BIGINT) AS le_0_1,
  CAST(sum(CASE WHEN run_time_s <= 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS le_0_5,
  CAST(sum(CASE WHEN run_time_s <= 1.0 THEN 1 ELSE 0 END) AS BIGINT) AS le_1,
  count(*) AS le_inf
FROM ({LOG_SQL}) GROUP BY handler
""")
def q_request_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = request_totals(_log(spark, sf_dir))
    return t.withColumn("duration_sum_s", F.round("duration_sum_s", 6))


@register("request_gauges", f"""
SELECT instance, count(*) AS requests, round({_latest_sql('run_time_s')}, 6) AS run_time_s,
  round({_latest_sql('memory_kib')}, 6) AS memory_kib, round({_latest_sql('cpu_percent')}, 6) AS cpu_percent,
  {_latest_sql('net_bytes_sent')} AS net_bytes_sent, {_latest_sql('net_bytes_recv')} AS net_bytes_recv,
  max(start_us) AS last_start_us
FROM ({LOG_SQL}) GROUP BY instance
""")
def q_request_gauges(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = gauges(_log(spark, sf_dir))
    for c in ("run_time_s", "memory_kib", "cpu_percent"):
        g = g.withColumn(c, F.round(c, 6))
    return g


@register("counter_deltas", f"""
SELECT instance, start_us, event_id,
  net_bytes_sent - lag(net_bytes_sent) OVER w AS net_bytes_sent_delta,
  net_bytes_recv - lag(net_bytes_recv) OVER w AS net_bytes_recv_delta
FROM ({LOG_SQL}) WINDOW w AS (PARTITION BY instance ORDER BY start_us, event_id)
""")
def q_counter_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counter_deltas(_log(spark, sf_dir))


RESAMPLE_INTERVAL = "1 hour"   # the scrape interval (10 s) makes one-row windows on this data
RESAMPLED_SQL = f"""
SELECT (start_us // 3600000000) * 3600 AS window_start_s, handler, count(*) AS requests,
  round({_latest_sql('run_time_s')}, 6) AS run_time_s, round({_latest_sql('cpu_percent')}, 6) AS cpu_percent,
  round({_latest_sql('memory_kib')}, 6) AS memory_kib
FROM ({LOG_SQL}) GROUP BY window_start_s, handler
"""


def _round_gauges(df: DataFrame) -> DataFrame:
    for c in ("run_time_s", "cpu_percent", "memory_kib"):
        df = df.withColumn(c, F.round(c, 6))
    return df


@register("metrics_resampled", RESAMPLED_SQL)
def q_metrics_resampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _log(spark, sf_dir).withWatermark("event_time", "10 minutes")
    return _round_gauges(resample(log, RESAMPLE_INTERVAL))


SCRAPE_INTERVAL = "10 seconds"   # the service's scrape interval


@register("metrics_resampled_10s", RESAMPLED_SQL.replace("3600000000) * 3600", "10000000) * 10"))
def q_metrics_resampled_10s(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _log(spark, sf_dir).withWatermark("event_time", "10 minutes")
    return _round_gauges(resample(log, SCRAPE_INTERVAL))


@register("metrics_long", f"""
UNPIVOT (SELECT window_start_s, handler, CAST(requests AS DOUBLE) AS requests, run_time_s, cpu_percent, memory_kib
         FROM ({RESAMPLED_SQL}))
ON requests, run_time_s, cpu_percent, memory_kib INTO NAME metric VALUE value
""")
def q_metrics_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = q_metrics_resampled(spark, sf_dir)
    return metrics_long(wide, ["window_start_s", "handler"], ["requests", "run_time_s", "cpu_percent", "memory_kib"])


# --- streams (R1, R5, R7) ---------------------------------------------------------
@register("metrics_stream", RESAMPLED_SQL)
def q_metrics_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = single_file_glob(posixpath.join(sf_dir, "events.parquet"))
    q, out = start_metrics_stream(spark, src, interval=RESAMPLE_INTERVAL, mode="update",
                                  schema=table(spark, sf_dir, "events").schema)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return _round_gauges(latest_windows(spark, out).select(*WINDOW_COLUMNS))


WINDOW_COLUMNS = ("window_start_s", "handler", "requests", "run_time_s", "cpu_percent", "memory_kib")


@register("metrics_stream_append", f"""
SELECT * FROM ({RESAMPLED_SQL})
WHERE (window_start_s + 3600) * 1000000 <= (SELECT max(epoch_us(ts)) FROM events) - 600000000
""")
def q_metrics_stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the windows that the watermark (10 minutes) has closed are written, once."""
    src = single_file_glob(posixpath.join(sf_dir, "events.parquet"))
    q, out = start_metrics_stream(spark, src, interval=RESAMPLE_INTERVAL, mode="append",
                                  schema=table(spark, sf_dir, "events").schema)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return _round_gauges(spark.read.parquet(out).select(*WINDOW_COLUMNS))


@register("stream_scoring", QUERIES["linear_score"][1])
def q_stream_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = freeze_vocabulary(fit_vocabulary(tokenize(labelled_reviews(spark, sf_dir)), MAX_WORDS))
    docs_path = posixpath.join(sf_dir, "documents.parquet")
    docs = file_stream(spark, single_file_glob(docs_path), spark.read.parquet(docs_path).schema)
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    reviews = docs.select("doc_id", F.col("text").alias("value")).join(labels, "doc_id")
    q, out = start_scoring_stream(spark, reviews, vocab, pinned_scorer, max_words=MAX_WORDS, max_len=MAX_LEN,
                                  columns=("doc_id", "label", "margin", "probability", "prediction"))
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    s = spark.read.parquet(out)
    return s.select("doc_id", "label", F.round("margin", 6).alias("margin"),
                    F.round("probability", 6).alias("probability"), "prediction")


# --- S1 S2 --------------------------------------------------------------------------
@register("text_lines", f"""
SELECT label, line AS value, count(*) AS n, count(*) AS n_keys
FROM (SELECT label, unnest(string_split_regex(value, '\\r\\n|\\r|\\n')) AS line FROM ({O.REVIEWS}))
GROUP BY label, line
""")
def q_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews written as text files under a folder a class, loaded class by class and united."""
    root = shared_dir(spark, "text", uuid.uuid4().hex)
    reviews = labelled_reviews(spark, sf_dir)
    loaded = []
    for name, label in (("very good", 1), ("not+so good", 0)):
        path = posixpath.join(root, name)
        reviews.where(F.col("label") == label).select("value").write.text(path)
        loaded.append(load_reviews(spark, path, label))
    return union_reviews(*loaded).groupBy("label", "value").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("n_keys"))


# --- S3 P4 --------------------------------------------------------------------------
TURNS_A_RECORD = 64


@register("nested_flatten", """
SELECT conv_id, turn, coalesce(text, '') AS review FROM conversations
""")
def q_nested_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations nested as records of up to 64 turns, flattened again."""
    turns = table(spark, sf_dir, "conversations").withColumn("page", F.floor(F.col("turn") / TURNS_A_RECORD))
    nested = turns.groupBy("conv_id", "page").agg(
        F.sort_array(F.collect_list(F.struct("turn", F.col("text").alias("content")))).alias("reviews"))
    keyed = nested.withColumn("title", F.struct("conv_id", F.transform("reviews", lambda r: r["turn"]).alias("turns")))
    flat = flatten_reviews(keyed)
    return flat.select("title.conv_id", F.get("title.turns", F.col("review_id")).alias("turn"), "review")


# --- learners: SQL states what must hold of the fitted models -------------------------
HELD_OUT_SQL = f"""n AS (SELECT CAST(sum(CASE WHEN b < 800000 THEN 1 ELSE 0 END) AS BIGINT) AS n_train,
    CAST(sum(CASE WHEN b < 800000 THEN 0 ELSE 1 END) AS BIGINT) AS n_test,
    CAST(sum(CASE WHEN b < 800000 THEN 0 ELSE label END) AS BIGINT) AS n_pos
  FROM (SELECT {O.split_bucket('doc_id')} AS b, label FROM ({O.REVIEWS})))"""


LOGGED = ("accuracy", "f1_score", "roc_auc")     # the metrics of a logged run


def _errors(runs: DataFrame, predictions_path: str, metrics=LOGGED) -> DataFrame:
    """Logged metrics less those recomputed from the exported predictions, to nine places, with the hold-out's sizes."""
    found = metric_errors(runs, read_stage(runs.sparkSession, predictions_path), metrics)
    return found.select("run_id", F.col("n").alias("n_test"), "n_pos",
                        *[F.round(f"{m}_error", 9).alias(f"{m}_error") for m in metrics])


ERRORS_SQL = ", ".join(f"CAST(0 AS DOUBLE) AS {m}_error" for m in LOGGED)


@register("logistic_grid", f"""
WITH {HELD_OUT_SQL},
grid AS (SELECT * FROM (VALUES {", ".join(f"('{c.penalty}', '{c.C!r}', '{c.max_iter}')" for c in LOGISTIC_GRID)})
         AS t(penalty, C, max_iter))
SELECT penalty, C, max_iter, n_train, n_test, n_pos, {ERRORS_SQL} FROM grid, n
""")
def q_logistic_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 12-config grid, logged and read back; each logged metric against the exported predictions."""
    feats, _ = build_features(spark, labelled_reviews(spark, sf_dir), MAX_WORDS, MAX_LEN)
    root = shared_dir(spark, "tracking", uuid.uuid4().hex)
    exported = posixpath.join(root, "predictions")
    runs = train_and_log(spark, feats, root=root, parallelism=4, predictions_path=exported)
    n = split_ops.train_rows(feats, "doc_id", 0.2, 42).agg(F.count(F.lit(1)).alias("n_train"))
    return runs.select("run_id", "params").join(_errors(runs, exported), "run_id").join(F.broadcast(n)).select(
        F.col("params")["penalty"].alias("penalty"), F.col("params")["C"].alias("C"),
        F.col("params")["max_iter"].alias("max_iter"), "n_train", "n_test", "n_pos", *[f"{m}_error" for m in LOGGED])


_CLOSED = "SELECT CAST(d.n_chars % 2 AS INTEGER) AS x, l.quality AS y FROM documents d JOIN labels l ON d.doc_id = l.doc_id"


@register("logistic_closed_form", f"""
WITH c AS (SELECT x, sum(y) AS pos, sum(1 - y) AS neg FROM ({_CLOSED}) GROUP BY x),
o AS (SELECT max(CASE WHEN x = 0 THEN ln(pos / neg) END) AS o0, max(CASE WHEN x = 1 THEN ln(pos / neg) END) AS o1 FROM c)
SELECT round(o0, 2) AS intercept, round(o1 - o0, 2) AS coefficient FROM o
""")
def q_logistic_closed_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With one 0/1 feature and no penalty the fit is the log-odds of the two groups."""
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.col("n_chars") % 2).cast("int").alias("x"))
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    train = docs.join(labels, "doc_id").select("label", F.array("x").alias("features"))
    model = fit_logistic(train, LogisticConfig("none", 1.0, "newton-cg", 300))
    return spark.range(1).select(F.round(F.lit(float(model.intercept)), 2).alias("intercept"),
                                 F.round(F.lit(float(model.coefficients[0])), 2).alias("coefficient"))


@register("model_roundtrip", f"SELECT doc_id, label, true AS same_prediction FROM ({O.REVIEWS})")
def q_model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit one config, predict every labelled review before saving and after loading the model."""
    feats, _ = preprocess(labelled_reviews(spark, sf_dir), max_words=MAX_WORDS, max_len=MAX_LEN)
    shared_dir(spark)
    feats = feats.checkpoint(eager=True)   # fitted on and scored: computed once
    train = split_ops.train_rows(feats, "doc_id", 0.2, 42)
    model = PipelineModel(stages=[fit_logistic(train, LOGISTIC_GRID[2])])
    path = save_model(model, shared_dir(spark, "models", uuid.uuid4().hex))
    before = model_scores(feats, model.stages[0]).select("doc_id", "label", "prediction", "probability")
    after = model_scores(feats, load_model(path).stages[0]).select(
        "doc_id", F.col("prediction").alias("p2"), F.col("probability").alias("q2"))
    return before.join(after, "doc_id").select(
        "doc_id", "label", ((F.col("prediction") == F.col("p2")) & (F.col("probability") == F.col("q2"))).alias("same_prediction"))


@register("title_sentiment_model", f"""
WITH {RESOLVE_CTES},
pt AS (SELECT source AS title, count(*) AS n_reviews FROM documents GROUP BY source)
SELECT res.request, res.title, coalesce(pt.n_reviews, 0) AS n_reviews, res.status,
  true AS score_is_the_mean, true AS verdict_follows FROM res LEFT JOIN pt ON res.title = pt.title
""")
def q_title_sentiment_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6 with a fitted model: train, log, load the best run, score titles; the means are
    recomputed from the exported predictions."""
    reviews = labelled_reviews(spark, sf_dir)
    vocab = freeze_vocabulary(fit_vocabulary(tokenize(reviews), MAX_WORDS))
    feats, _ = preprocess(reviews, max_words=MAX_WORDS, max_len=MAX_LEN, vocab=vocab)
    root = shared_dir(spark, "tracking", uuid.uuid4().hex)
    train_and_log(spark, feats, "titles", LOGISTIC_GRID[:2], root)
    _, model = best_model(spark, "titles", root)
    exported = shared_dir(spark, "predictions", uuid.uuid4().hex)

    def scorer(df: DataFrame) -> DataFrame:
        model_scores(df, model.stages[0]).select("doc_id", "title", "prediction").write.parquet(exported)
        return spark.read.parquet(exported)

    out = score_titles(title_requests(spark, sf_dir), title_catalogue(spark, sf_dir), title_reviews(spark, sf_dir),
                       scorer, vocab=vocab, max_words=MAX_WORDS, max_len=MAX_LEN)
    again = spark.read.parquet(exported).groupBy("title").agg(
        (F.sum("prediction") / F.count(F.lit(1))).alias("mean"))
    same = F.coalesce(F.abs(F.col("score") - F.col("mean")) < 1e-9, F.col("score").isNull() & F.col("mean").isNull())
    verdict = F.when(F.col("mean") >= 0.5, "Positive").when(F.col("mean") < 0.5, "Negative")
    return out.join(again, "title", "left").select("request", "title", "n_reviews", "status", same.alias("score_is_the_mean"),
                                                   F.col("sentiment").eqNullSafe(verdict).alias("verdict_follows"))


@register("title_request_stream", QUERIES["title_sentiment"][1])
def q_title_request_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title requests arrive as a stream and are answered with verdicts."""
    source = shared_dir(spark, "arriving", uuid.uuid4().hex)
    title_requests(spark, sf_dir).write.parquet(source)
    vocab = freeze_vocabulary(fit_vocabulary(tokenize(labelled_reviews(spark, sf_dir)), MAX_WORDS))
    arriving = file_stream(spark, source, "request string")
    q, out = start_title_stream(spark, arriving, title_catalogue(spark, sf_dir), title_reviews(spark, sf_dir), pinned_scorer,
                                vocab=vocab, max_words=MAX_WORDS, max_len=MAX_LEN)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return spark.read.parquet(out).drop("batch").withColumn("score", F.round("score", 6))


def _tfidf_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    reviews = labelled_reviews(spark, sf_dir)
    words = reviews.select("doc_id", "label", F.filter(remove_stop_words(ml_tokens(F.col("value"))),
                                                       lambda w: w != "").alias("words"))
    return split_ops.holdout_split(words, "doc_id", 0.2, 42)


@register("tfidf_weights", f"""
WITH docs AS (SELECT doc_id, list_filter({O.drop_stop_words(O.ml_tokens('value'))}, lambda w: w <> '') AS toks
              FROM ({O.REVIEWS})),
m AS (SELECT count(*) AS m FROM docs),
tf AS (SELECT doc_id, word, count(*) AS tf FROM (SELECT doc_id, unnest(toks) AS word FROM docs) GROUP BY doc_id, word),
dfs AS (SELECT word, count(*) AS df FROM tf GROUP BY word)
SELECT doc_id, word, tf, round(tf * ln((m + 1.0) / (df + 1.0)), 6) AS tfidf FROM tf JOIN dfs USING (word), m
""")
def q_tfidf_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weight of every word in every document."""
    return tfidf_weights(_tfidf_words(spark, sf_dir)).withColumn("tfidf", F.round("tfidf", 6))


LEARNER_SQL = f"""
WITH {HELD_OUT_SQL}
SELECT '{{kind}}' AS run_id, n_test, n_pos, {ERRORS_SQL},
  true AS better_than_nothing FROM n
"""
LEARNER_FEATURES = 1 << 15    # hashed terms of the few thousand labelled documents


def _learner(spark: SparkSession, sf_dir: str, kind: str, run_id: str) -> DataFrame:
    """Hold-out sizes, the metrics less those recomputed from the exported predictions, and whether the training loss is
    below that of the model that always answers 0 (log loss ln 2, hinge loss 1)."""
    words = _tfidf_words(spark, sf_dir)
    train, test = words.where(F.col("split") == "train"), words.where(F.col("split") == "test")
    model = fit_text_classifier(train, kind, fit_partitions=2, num_features=LEARNER_FEATURES)
    exported = shared_dir(spark, "predictions", uuid.uuid4().hex)
    held = _errors(evaluate_text_classifier(model, test, run_id, exported), exported)
    margin = F.get(vector_to_array("rawPrediction"), 1) * (F.col("label") * 2 - 1)
    loss = F.greatest(F.lit(0.0), 1 - margin) if kind == "svm" else F.log1p(F.exp(-margin))
    trained = model.transform(train).agg((F.avg(loss) < (1.0 if kind == "svm" else 0.6931)).alias("better_than_nothing"))
    return held.join(F.broadcast(trained))


@register("tfidf_logistic", LEARNER_SQL.format(kind="tfidf_logistic"))
def q_tfidf_logistic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T9 + M2: hashed TF-IDF -> logistic regression."""
    return _learner(spark, sf_dir, "logistic", "tfidf_logistic")


@register("linear_svm", LEARNER_SQL.format(kind="linear_svm"))
def q_linear_svm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T9 + M10: hashed TF-IDF -> linear SVM."""
    return _learner(spark, sf_dir, "svm", "linear_svm")


@register("neural_grid", f"""
WITH {HELD_OUT_SQL}
SELECT embedding_dim, lstm_units, n_test, n_pos, {ERRORS_SQL}, CAST(0 AS DOUBLE) AS log_loss_error
FROM (VALUES {", ".join(f"('{c.embedding_dim}', '{c.lstm_units}')" for c in NEURAL_GRID)}) AS t(embedding_dim, lstm_units), n
""")
def q_neural_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8 + M9: the 8 neural configs re-aimed as Word2Vec + perceptron; each metric against the exported predictions."""
    reviews = labelled_reviews(spark, sf_dir)
    words = tokenize(reviews)
    vocab = fit_vocabulary(words, max(c.max_words for c in NEURAL_GRID))
    split = split_ops.holdout_split(words, "doc_id", 0.2, 42)
    exported = shared_dir(spark, "predictions", uuid.uuid4().hex)
    runs = train_neural_grid(split.where(F.col("split") == "train"), split.where(F.col("split") == "test"), vocab,
                             parallelism=4, fit_partitions=2, predictions_path=exported)
    return runs.select("run_id", "params").join(_errors(runs, exported, (*LOGGED, "log_loss")), "run_id").select(
        F.col("params")["embedding_dim"].alias("embedding_dim"), F.col("params")["lstm_units"].alias("lstm_units"),
        "n_test", "n_pos", *[f"{m}_error" for m in (*LOGGED, "log_loss")])


def queries() -> dict[str, QueryFn]:
    return {k: v[0] for k, v in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in QUERIES.items() if v[1] is not None}


from tonality.plans import request_queries, title_queries  # noqa: E402,F401  (they register more queries)
