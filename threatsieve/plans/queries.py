"""The registered queries: every one is a function of a session and a data directory."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threatsieve.functions.stamps import DAY, READABLE, SECOND, province, stamp
from threatsieve.functions.tokens import token_text
from threatsieve.functions.url import lexical_features, url_parts, with_default_scheme
from threatsieve.operators import daily, filters, fusion, lists, report, scoring, token_bayes, training
from threatsieve.operators.weights import weigh, weigh_where
from threatsieve.plans import fixtures as fx
from threatsieve.plans import streams
from threatsieve.session import shared_folder
from threatsieve.sinks.text import verdict_lines
from threatsieve.sources import lines as src

_MODELS: dict[tuple[str, str], scoring.Models] = {}


def models_for(spark: SparkSession, sf_dir: str) -> scoring.Models:
    """Both models, once per application and data set.

    The trees are fitted on rows labelled by a rule, so that SQL can state their verdicts; naive Bayes, as tables
    in the shared folder, on the noisy rows, as SQL can state its probabilities. Equal rows are counted first and
    written, so that both fits go over distinct URLs and the hits are worked out once.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MODELS:
        folder = f"{shared_folder(spark)}/models-{uuid.uuid4().hex}"
        weigh(fx.labelled(fx.hits(spark, sf_dir)), "url", "label").write.parquet(f"{folder}/labelled")
        counted = spark.read.parquet(f"{folder}/labelled")
        _MODELS[key] = scoring.Models(
            training.fit_gbdt(fx.ruled(counted)), token_bayes.fit(counted, f"{folder}/bayes")
        )
    return _MODELS[key]


def hit_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.hit_lines(fx.hits(spark, sf_dir))


def _plain(df: DataFrame) -> DataFrame:
    """Decimals in types that read alike everywhere; the counts as text, exact at any size."""
    types = {"prob_GBDT": "double", "copies": "string"}
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items() if c in df.columns})


def extract_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = src.extract_field(fx.hit_lines(fx.hits(spark, sf_dir)), fx.URL_INDEX)
    return rows.select("event_id", "url")


def bad_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.bad_records(fx.hit_lines(fx.hits(spark, sf_dir)), fx.URL_INDEX)


def suffix_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.download_suffix(fx.hits(spark, sf_dir)).select("event_id", "url")


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.hits(spark, sf_dir).select("event_id", with_default_scheme(F.col("url")).alias("url"))
    found = url_parts(rows, "url")
    empty = {"scheme": F.lit(""), "host": F.lit(""), "port_number": F.lit(-1)}
    shown = [F.when(F.col("parses"), F.col(c)).otherwise(e).alias(c) for c, e in empty.items()]
    return found.select("event_id", "url", "parses", *shown)


def lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_features(fx.hits(spark, sf_dir), keep=["event_id"])


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_text(fx.hits(spark, sf_dir), keep=["event_id"])


def _labelled_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.labelled(fx.hits(spark, sf_dir)).select("url", "label")
    return src.labelled_union(rows.where("label = 1"), rows.where("label = 0"))


def train_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.lexical_training(_labelled_sets(spark, sf_dir))


def train_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.token_training(_labelled_sets(spark, sf_dir))


def _downloads(hits: DataFrame) -> DataFrame:
    return weigh_where(hits, filters.is_download(F.col("url")))


def bayes_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scoring.bayes_verdicts(_downloads(fx.hits(spark, sf_dir)), models_for(spark, sf_dir).bayes)
    return rows.withColumn("prob_Bayes", F.round("prob_Bayes", 6))


def bayes_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tables of the model; the priors as weights of the empty token."""
    model = models_for(spark, sf_dir).bayes
    priors = model.classes.select(F.lit("").alias("token"), "label", F.col("log_prior").alias("log_weight"))
    return model.long().unionByName(priors).withColumn("log_weight", F.round("log_weight", 6))


def gbdt_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = fx.hits(spark, sf_dir)
    return _plain(scoring.gbdt_verdicts(_downloads(hits), models_for(spark, sf_dir).gbdt))


def score_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fx.hit_lines(fx.hits(spark, sf_dir))
    rows = _plain(scoring.score_lines(lines, fx.URL_INDEX, models_for(spark, sf_dir)))
    return rows.withColumn("prob_Bayes", F.round("prob_Bayes", 6))


def _verdict_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = fx.verdicts(fx.hits(spark, sf_dir))
    gbdt = fusion.flagged(rows, "gbdt_pred").select("batch", F.col("gbdt_url").alias("url_GBDT"))
    bayes = fusion.flagged(rows, "bayes_pred").select(
        "batch", F.col("bayes_url").alias("url_Bayes"), F.col("bayes_prob").alias("prob_Bayes")
    )
    return gbdt, bayes


def fusion_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(fusion.fusion_join(*_verdict_sides(spark, sf_dir), within=["batch"]))


def fusion_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(fusion.fusion_normalized(*_verdict_sides(spark, sf_dir), within=["batch"]))


def verdict_line_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    fused = fusion.fusion_join(*_verdict_sides(spark, sf_dir), within=["batch"])
    return _plain(verdict_lines(fused))


def dedup_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.dedup_urls(fx.result_lines(fx.hits(spark, sf_dir)))


def _listed(hits: DataFrame) -> DataFrame:
    return lists.list_union(fx.white(hits), fx.black(hits))


def list_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listed(fx.hits(spark, sf_dir))


def exclude_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = fx.hits(spark, sf_dir)
    return lists.exclude_listed(report.dedup_urls(fx.result_lines(hits)), _listed(hits))


def stream_whitelist(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = fx.hits(spark, sf_dir)
    urls = fusion.meeting_counts(hits.select("url")).where("download").drop("download")
    listed = fx.white(hits).select(with_default_scheme(F.col("url")).alias("url"))
    return lists.flag_listed(urls, listed).where("NOT listed").drop("listed")


def package_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.package_suffix(src.first_field(fx.result_lines(fx.hits(spark, sf_dir)))).distinct()


def funnel_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = fx.hits(spark, sf_dir)
    return report.funnel_counts(report.flagged_urls(fx.result_lines(hits), _listed(hits)))


def daily_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.verdicts(fx.hits(spark, sf_dir))
    kept = rows.withColumn("kept", filters.is_download(F.col("bayes_url")))
    return daily.verdict_stats(kept).withColumn("output_count", F.col("output_count").cast("string"))


def _report_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = fx.hits(spark, sf_dir)
    return report.result_urls(report.flagged_urls(fx.result_lines(hits), _listed(hits)))


def report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.report_rows(_report_urls(spark, sf_dir), fx.REPORT_LIMIT)


def report_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.report_json(_report_urls(spark, sf_dir), fx.REPORT_LIMIT, fx.REPORT_TIME)


def date_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    return fx.hits(spark, sf_dir).select(
        "event_id",
        stamp(ts, DAY).alias("day"),
        stamp(ts, SECOND).alias("second"),
        stamp(ts, READABLE).alias("readable"),
    )


def province_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.hits(spark, sf_dir).select("event_id", province(F.col("url")).alias("area"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "hit_lines": hit_lines,
    "extract_field": extract_field,
    "bad_records": bad_records,
    "suffix_filter": suffix_filter,
    "url_parts": parts,
    "lexical_features": lexical,
    "token_text": tokens,
    "train_lexical": train_lexical,
    "train_tokens": train_tokens,
    "bayes_model": bayes_model,
    "bayes_score": bayes_score,
    "gbdt_score": gbdt_score,
    "score_lines": score_lines,
    "fusion_join": fusion_join,
    "fusion_normalized": fusion_normalized,
    "verdict_lines": verdict_line_rows,
    "dedup_urls": dedup_urls,
    "list_union": list_union,
    "exclude_listed": exclude_listed,
    "stream_whitelist": stream_whitelist,
    "package_urls": package_urls,
    "funnel_counts": funnel_counts,
    "daily_stats": daily_stats,
    "stream_daily_stats": streams.stream_daily_stats,
    "stream_unique_urls": streams.stream_unique_urls,
    "date_stamps": date_stamps,
    "province_codes": province_codes,
    "report_rows": report_rows,
    "report_json": report_json,
}
