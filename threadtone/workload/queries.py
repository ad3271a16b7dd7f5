"""The registered queries: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadtone import schemas
from threadtone.constants import SAMPLE_FRACTION
from threadtone.functions import sampling, scalars, text
from threadtone.functions.sql import register_functions
from threadtone.operators import report
from threadtone.operators.coefficients import probabilities
from threadtone.operators.evaluation import area_under_roc
from threadtone.operators.joins import (
    both_probabilities,
    dealt,
    labelled_comments,
    with_flags,
)
from threadtone.operators.share import (
    flags_of,
    share,
    share_by_submission,
    share_by_target,
    unfolded,
)
from threadtone.operators.vocabulary import (
    fit_vocabulary,
    most_frequent,
    term_statistics,
    vector_terms,
)
from threadtone.plans import publishing, scoring
from threadtone.plans.cleaning import clean_bodies
from threadtone.plans.training import with_binary_labels
from threadtone.session import fresh_path
from threadtone.sources.materialize import fingerprint, materialize
from threadtone.sources.readers import accepted, checked_json, read_csv, read_json, rejected_by_file
from threadtone.sources.writers import write_csv_file, write_csv_table, write_then_read
from threadtone.workload import standins as given

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _register(query: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        # Days are cut in the session time zone.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return query(spark, folder.rstrip("/"))

    _QUERIES[query.__name__] = run
    return query


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


_BALANCE = {"Positive": "balance_pos", "Negative": "balance_neg"}


# --- scans, sinks ------------------------------------------------------------


@_register
def scan_project(spark, folder):
    return given.table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), F.col("lang").alias("language"), "n_chars"
    )


@_register
def csv_string_roundtrip(spark, folder):
    path = fresh_path(spark, "labeled")
    source = given.labeled(spark, folder)
    write_csv_table(source, path)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in source.columns])
    return read_csv(spark, path, schema)


@_register
def csv_columns_by_name(spark, folder):
    path = fresh_path(spark, "labeled")
    source = given.labeled(spark, folder)
    names = source.columns
    write_csv_table(source.select(F.lit("x").alias("note"), *reversed(names)), path)
    schema = T.StructType([T.StructField(c, T.LongType()) for c in names])
    return read_csv(spark, path, schema)


@_register
def json_numbers_in_any_form(spark, folder):
    path = fresh_path(spark, "comments")
    given.metadata(spark, folder).select(
        F.col("id").cast("string"),
        F.col("created_utc").cast("string"),
        F.col("score").cast("decimal(20,1)"),
    ).write.json(path)
    return read_json(spark, path, schemas.COMMENTS).select("id", "created_utc", "score")


@_register
def json_bz2_roundtrip(spark, folder):
    path = fresh_path(spark, "comments")
    given.bodies(spark, folder).select(
        F.col("id").cast("string"), "body"
    ).write.option("compression", "bzip2").json(path)
    return read_json(spark, path, schemas.COMMENTS).select("id", "body")


@_register
def json_quarantine(spark, folder):
    """Lines of which two in five are broken: the good rows, and counts of the others."""
    path = fresh_path(spark, "comments")
    line = F.to_json(F.struct(F.col("event_id").cast("string").alias("id"), F.col("user_id").alias("score")))
    kind = F.col("event_id") % 5
    given.table(spark, folder, "events").select(
        F.when(kind == 0, F.substring(line, F.lit(1), F.length(line) - 1))
        .when(kind == 1, F.concat(F.lit("no json "), line))
        .otherwise(line),
        (F.col("event_id") % 3).alias("part"),
    ).toDF("value", "part").write.partitionBy("part").text(path)
    checked = write_then_read(checked_json(spark, path, schemas.SUBMISSIONS), fresh_path(spark, "checked"))
    part = F.regexp_extract("file", "/part=([0-9]+)/", 1).cast("bigint").alias("part")
    lost = rejected_by_file(checked).groupBy(part).agg(F.sum("records").alias("n"))
    nothing = F.lit(None).cast("string").alias("id")
    return accepted(checked).select(F.lit(None).cast("bigint").alias("part"), "id", F.col("score").alias("n")).unionAll(
        lost.select("part", nothing, "n")
    )


@_register
def body_file_cleaning(spark, folder):
    path = fresh_path(spark, "bodies")
    given.page_posts(spark, folder).select("body").write.option(
        "compression", "bzip2"
    ).json(path)
    return clean_bodies(spark, path)


@_register
def materialize_reuse(spark, folder):
    application = spark.sparkContext.applicationId
    key = fingerprint(spark, [f"{folder}/documents.parquet"], {"by": application})

    def build():
        return given.table(spark, folder, "documents").select(
            "doc_id", "lang", "n_chars"
        )

    materialize(spark, "documents", build, key)
    return materialize(spark, "documents", build, key)


@_register
def published_files(spark, folder):
    home = fresh_path(spark, "published")
    rows = write_then_read(given.sentiment(spark, folder), fresh_path(spark, "sentiment"))
    paths = publishing.publish(
        rows,
        given.TARGET_NAMES,
        home,
        given.PLACES,
        unprefixed="balance",
    )
    parts = []
    for path in paths:
        target = next(
            (t for t in given.TARGET_NAMES if f"/{t}_" in path[len(home):]), "balance"
        )
        file = path.rsplit("/", 1)[1].removeprefix(f"{target}_")
        names = next(n for f, *n in publishing.FILES.values() if f == file)
        kinds = (T.StringType(), T.DoubleType(), T.DoubleType())
        schema = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)])
        parts.append(
            read_csv(spark, path, schema)
            .toDF("key", "Positive", "Negative")
            .select(F.lit(target).alias("target"), F.lit(file).alias("file"), "*")
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


# --- joins, labels, filters --------------------------------------------------


@_register
def labeled_join(spark, folder):
    return labelled_comments(
        given.labeled(spark, folder),
        given.bodies(spark, folder),
        [t.label for t in given.TARGETS],
    )


@_register
def label_binarize(spark, folder):
    return with_binary_labels(given.labeled(spark, folder), given.TARGETS)


@_register
def submission_key_join(spark, folder):
    return given.sightings(spark, folder)


@_register
def sentiment_join(spark, folder):
    return given.sentiment(spark, folder)


@_register
def unseen_filter(spark, folder):
    kind, url = F.col("page_id") % 5, F.col("url")
    body = (
        F.when(kind == 0, F.concat(F.lit("&gt; "), url))
        .when(kind == 1, F.concat(url, F.lit(" of course /s")))
        .when(kind == 2, F.concat(F.lit("a &gt; b "), F.lower("url")))
        .otherwise(url)
    )
    pages = given.table(spark, folder, "pages").select(
        F.col("page_id").alias("id"), body.alias("body")
    )
    return pages.where(scalars.is_fresh_comment(F.col("body")))


@_register
def state_membership(spark, folder):
    events = given.metadata(spark, folder)
    return events.where(scalars.in_states(F.col("author_flair_text"), given.PLACES))


# --- samples, splits ---------------------------------------------------------


@_register
def hash_sample(spark, folder):
    documents = given.table(spark, folder, "documents").select("doc_id", "n_chars")
    return sampling.hash_sample(documents, "doc_id", SAMPLE_FRACTION, given.SEED)


@_register
def hash_split(spark, folder):
    documents = given.table(spark, folder, "documents").select("doc_id", "n_chars")
    return sampling.hash_parts(documents, "doc_id", (0.5, 0.5), given.SEED)


@_register
def stratified_folds(spark, folder):
    """The fold of every labelled comment, dealt out within each value of a label."""
    labels = given.table(spark, folder, "labels").select(
        F.col("doc_id").alias("id"), F.col("toxic").alias("label")
    )
    dealt = sampling.stratified_folds(labels, "id", ["label"], 5, given.SEED)
    return labels.join(dealt, "id").select("id", "label", F.col("fold_label").alias("fold"))


@_register
def bernoulli_sample(spark, folder):
    documents = given.table(spark, folder, "documents").select("doc_id", "n_chars")
    return sampling.bernoulli_sample(documents, SAMPLE_FRACTION, given.SEED)


@_register
def random_split(spark, folder):
    documents = given.table(spark, folder, "documents").select("doc_id", "n_chars")
    first, second = sampling.random_split(documents, (0.5, 0.5), given.SEED)
    # Which row falls where is random; that each falls into one part is not.
    return first.unionAll(second)


# --- text --------------------------------------------------------------------


@_register
def text_parsed(spark, folder):
    return text.with_parsed(given.spread_bodies(spark, folder)).select("id", "parsed")


@_register
def text_unigrams(spark, folder):
    return text.with_parsed(given.spread_bodies(spark, folder)).select("id", "unigrams")


@_register
def text_bigrams(spark, folder):
    return text.with_parsed(given.spread_bodies(spark, folder)).select("id", "bigrams")


@_register
def text_trigrams(spark, folder):
    return text.with_parsed(given.spread_bodies(spark, folder)).select("id", "trigrams")


@_register
def text_grams(spark, folder):
    return text.with_grams(given.spread_bodies(spark, folder)).select(
        "id", F.array_join("grams", " ").alias("grams")
    )


@_register
def text_linked_pages(spark, folder):
    return text.with_parsed(given.page_posts(spark, folder)).drop("body")


@_register
def text_with_removed_links(spark, folder):
    cleaned = text.without_links(F.col("body"))
    return given.page_posts(spark, folder).select("id", cleaned.alias("body"))


@_register
def sql_functions(spark, folder):
    register_functions(spark, given.PLACES)
    given.page_posts(spark, folder).createOrReplaceTempView("tt_posts")
    return spark.sql(
        "SELECT id, array_join(sanitize(body), ' ') AS grams, "
        "cutoff(concat('t3_', id)) AS link, "
        "validstate(concat('NATION_', id)) AS valid, "
        "getProbability(array(1 - id / 200D, id / 200D)) > 0.2 AS above "
        "FROM tt_posts"
    )


def _sql_views(spark, folder):
    register_functions(spark, given.PLACES)
    given.metadata(spark, folder).createOrReplaceTempView("tt_comments")
    given.submissions(spark, folder).createOrReplaceTempView("tt_submissions")
    given.label_flags(spark, folder).createOrReplaceTempView("tt_flags")


_SQL_SENTIMENT = (
    "FROM tt_comments |> JOIN tt_flags USING (id) "
    "|> LEFT SEMI JOIN tt_submissions s ON s.id = cutoff(link_id) "
)


@_register
def sql_share_by_day(spark, folder):
    _sql_views(spark, folder)
    return spark.sql(
        _SQL_SENTIMENT + "|> AGGREGATE avg(balance_pos) AS pos_avg_day, "
        "avg(balance_neg) AS neg_avg_day "
        "GROUP BY string(date(timestamp_seconds(created_utc))) AS date"
    )


@_register
def sql_share_by_state(spark, folder):
    _sql_views(spark, folder)
    return spark.sql(
        _SQL_SENTIMENT + "|> WHERE validstate(author_flair_text) = 1 "
        "|> AGGREGATE avg(balance_pos) AS Positive, avg(balance_neg) AS Negative "
        "GROUP BY author_flair_text AS state"
    )


# --- vocabulary --------------------------------------------------------------


def _labelled_grams(spark, folder):
    joined = labelled_comments(
        given.labeled(spark, folder), given.bodies(spark, folder), []
    )
    return text.with_grams(dealt(joined))


@_register
def vocab_doc_freq(spark, folder):
    return term_statistics(_labelled_grams(spark, folder))


@_register
def vocab_most_frequent(spark, folder):
    return most_frequent(term_statistics(_labelled_grams(spark, folder)), 1000)


@_register
def vector_vocabulary_terms(spark, folder):
    model = fit_vocabulary(_labelled_grams(spark, folder))
    vectors = model.transform(text.with_grams(given.spread_bodies(spark, folder)))
    return vector_terms(vectors, model, ["id"])


# --- shares ------------------------------------------------------------------


@_register
def share_by_link(spark, folder):
    return share_by_submission(
        given.flagged(spark, folder),
        given.submissions(spark, folder),
        {"pos_avg": "balance_pos", "neg_avg": "balance_neg"},
    )


def _by_day(spark, folder):
    return share(
        given.sentiment(spark, folder),
        scalars.local_date(F.col("timestamp")).alias("date"),
        {"pos_avg_day": "balance_pos", "neg_avg_day": "balance_neg"},
    )


@_register
def share_by_day(spark, folder):
    return _by_day(spark, folder).withColumn("date", F.col("date").cast("string"))


def _by_state(spark, folder):
    return share(
        given.sentiment(spark, folder),
        "state",
        _BALANCE,
        scalars.in_states(F.col("state"), given.PLACES),
    )


@_register
def share_by_state(spark, folder):
    return _by_state(spark, folder)


def _by_score(spark, folder, column, name):
    return share(
        given.sentiment(spark, folder),
        F.col(column).alias(name),
        _BALANCE,
        scalars.in_states(F.col("state"), given.PLACES),
    )


@_register
def share_by_comment_score(spark, folder):
    return _by_score(spark, folder, "c_score", "comment_score")


@_register
def share_by_submission_score(spark, folder):
    return _by_score(spark, folder, "s_score", "submission_score")


def _target_table(spark, folder, name):
    sentiment = given.sentiment(spark, folder)
    return publishing.share_tables(sentiment, given.TARGET_NAMES, given.PLACES)[name]


@_register
def share_by_target_day(spark, folder):
    return _target_table(spark, folder, "day").withColumn(
        "date", F.col("date").cast("string")
    )


@_register
def share_by_target_link(spark, folder):
    wide = share_by_submission(
        given.flagged(spark, folder),
        given.submissions(spark, folder),
        flags_of(given.TARGET_NAMES),
    )
    return unfolded(wide, "link_id", given.TARGET_NAMES)


@_register
def share_by_target_state(spark, folder):
    return _target_table(spark, folder, "state")


@_register
def share_by_target_comment_score(spark, folder):
    return _target_table(spark, folder, "comment_score")


@_register
def share_by_target_submission_score(spark, folder):
    return _target_table(spark, folder, "submission_score")


# --- reports -----------------------------------------------------------------


def _reread(shares, key, schema):
    """The published form of a share table, as the reports read it."""
    path = f"{fresh_path(shares.sparkSession, key)}.csv"
    write_csv_file(shares, path, [key])
    return read_csv(shares.sparkSession, path, schema)


@_register
def timeseries_report(spark, folder):
    daily = _reread(_by_day(spark, folder), "date", schemas.TIME_DATA)
    series = report.time_series(daily, given.DROPPED_DAY)
    return series.withColumn("date", F.col("date").cast("string"))


@_register
def state_extremes(spark, folder):
    return report.extremes(_by_state(spark, folder), "state", ("Positive", "Negative"))


def _scale(spark, folder, build):
    shares = _reread(_by_state(spark, folder), "state", schemas.STATE_DATA)
    places = given.table(spark, folder, "nation").select(F.col("n_name").alias("state"))
    places = places.where(scalars.in_states(F.col("state"), given.PLACES))
    scaled = build(shares, places, given.OFF_MAP, missing="null")
    return scaled.withColumns(
        {c: F.round(c, 9) for c in scaled.columns if c != "state"}
    )


@_register
def state_scale_pos(spark, folder):
    return _scale(spark, folder, report.positive_scale)


@_register
def state_scale_neg(spark, folder):
    return _scale(spark, folder, report.negative_scale)


@_register
def state_scale_diff(spark, folder):
    return _scale(spark, folder, report.difference_scale)


@_register
def score_curve_submission(spark, folder):
    shares = _by_score(spark, folder, "s_score", "submission_score")
    reread = _reread(shares, "submission_score", schemas.SUBMISSION_SCORE)
    return report.score_curve(reread, "submission_score")


@_register
def score_curve_comment(spark, folder):
    shares = _by_score(spark, folder, "c_score", "comment_score")
    reread = _reread(shares, "comment_score", schemas.COMMENT_SCORE)
    return report.score_curve(reread, "comment_score")


# --- models ------------------------------------------------------------------


@_register
def probability_threshold(spark, folder):
    probability = F.col("user_id") / F.lit(200.0)
    vectors = given.table(spark, folder, "events").select(
        "event_id",
        array_to_vector(F.array(1 - probability, probability)).alias("probability"),
    )
    value = scalars.class1_probability(F.col("probability"))
    return vectors.select(
        "event_id",
        scalars.flag(value, 0.2).alias("pos"),
        scalars.flag(value, 0.25).alias("neg"),
    )


@_register
def stored_outputs_join(spark, folder):
    events = given.table(spark, folder, "events")
    positive = events.select(F.col("event_id").alias("id"), F.col("value").alias("p"))
    negative = events.select(F.col("event_id").alias("id"), F.col("user_id").alias("p"))
    return both_probabilities(positive, negative, "p")


@_register
def label_score_auc(spark, folder):
    """How well a sighting's score tells the labels apart, flag by flag."""
    rows = given.flagged(spark, folder)
    flags = F.array(*(F.struct(F.lit(f).alias("flag"), F.col(f).alias("label")) for f in given.FLAGS))
    return area_under_roc(rows.select("score", F.inline(flags)), "score", "label", ["flag"])


@_register
def coefficient_scores(spark, folder):
    """All documents scored by a table of weights, which the labels' term counts give."""
    grams = _labelled_grams(spark, folder).join(given.label_flags(spark, folder), F.col("Input_id") == F.col("id"))
    terms = grams.select("quality_pos", "toxic_pos", F.explode(F.array_distinct("grams")).alias("term"))
    seen = terms.groupBy("term").agg(
        F.count("*").alias("n"), F.sum("quality_pos").alias("q"), F.sum("toxic_pos").alias("t")
    ).where("n >= 20")

    def weight(flag, count):
        odds = F.round(F.log((F.col(count) + 1) / (F.col("n") - F.col(count) + 1)) / 200, 6)
        return F.struct(F.lit(flag).alias("flag"), odds.alias("weight"))

    weights = seen.select("term", F.inline(F.array(weight("quality", "q"), weight("toxic", "t"))))
    base = spark.sql("SELECT flag, CAST(NULL AS STRING) AS term, -0.5D AS weight FROM VALUES ('quality'), ('toxic') AS v(flag)")
    table = write_then_read(weights.unionByName(base), fresh_path(spark, "weights"))
    texts = text.with_grams(given.spread_bodies(spark, folder))
    found = probabilities(texts, table, ["quality", "toxic"])
    return found.select("id", *(F.round(f, 6).alias(f) for f in ("quality", "toxic")))


@_register
def model_cv_auc(spark, folder):
    return given.metrics(spark, folder).select("target", "flag", "cv_auc")


@_register
def model_holdout_auc(spark, folder):
    return given.metrics(spark, folder).select("target", "flag", "holdout_auc")


def _scored(spark, folder, bundle):
    unseen = scoring.unseen_comments(
        given.spread_bodies(spark, folder), SAMPLE_FRACTION, given.SEED
    )
    return scoring.score(unseen, bundle)


def _model_flags(spark, folder):
    bundle = given.bundle(spark, folder)
    return scoring.flags(_scored(spark, folder, bundle), bundle)


@_register
def model_flags_agree(spark, folder):
    """Whether each flag is what the stored model's probability and the limit say."""
    bundle = given.bundle(spark, folder)
    scored = _scored(spark, folder, bundle)
    kept = {f"p_{name}": F.col(f"{name}_prob") for name in given.FLAGS}
    flagged = scoring.flags(scored.withColumns(kept), bundle)
    limits = {
        f"{t.name}_{kind}": limit
        for t in given.TARGETS
        for kind, limit in (("pos", t.positive_threshold), ("neg", t.negative_threshold))
    }
    agree = [
        (
            F.col(name)
            == (vector_to_array(f"p_{name}")[1].cast("float") > F.lit(limit)).cast("int")
        ).alias(name)
        for name, limit in limits.items()
    ]
    return flagged.select("id", *agree)


@_register
def model_auc_in_range(spark, folder):
    """The models' areas under ROC, as whether they can be ones."""
    metrics = given.metrics(spark, folder)
    fits = F.col("cv_auc").between(0, 1) & F.col("holdout_auc").between(0, 1)
    return metrics.select("target", "flag", fits.alias("in_range"))


@_register
def scored_sentiment(spark, folder):
    """The rows that the whole scoring path gives, without the flags a model decides."""
    unseen = scoring.unseen_comments(
        given.comments(spark, folder), SAMPLE_FRACTION, given.SEED
    )
    rows = scoring.sentiment(
        unseen, given.submissions(spark, folder), given.bundle(spark, folder)
    )
    flags = sum(F.col(name).isin(0, 1).cast("int") for name in given.FLAGS)
    return rows.select(
        "timestamp", "c_score", "s_score", "link_id", "state", "comment_id",
        (flags == len(given.FLAGS)).alias("flagged"),
    )


@_register
def model_flags(spark, folder):
    return _model_flags(spark, folder)


@_register
def scored_share_by_day(spark, folder):
    flags = _model_flags(spark, folder)
    sentiment = with_flags(given.sightings(spark, folder), flags)
    day = scalars.local_date(F.col("timestamp"))
    shares = share_by_target(sentiment, day, "date", given.TARGET_NAMES)
    return shares.withColumn("date", F.col("date").cast("string"))
