"""The registered queries: every operator over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewell.functions import hashing, numeric, text as text_fn
from ratewell.operators import blend, bootstrap, encode, encoders, evaluate, features, histogram_trees, joins, pooling
from ratewell.operators import ridge, ridge_sparse, split, stats
from ratewell.operators import text as text_op
from ratewell.operators import word_vectors as words
from ratewell.plans import feature_job, training
from ratewell.schemas import KEY_PREFIXES, MAX_TOKENS
from ratewell.session import scratch_path
from ratewell.sources import bucketed, embeddings, files, increments, rank_summaries, sketches, tables
from ratewell.sources import reviews as source

Query = Callable[[SparkSession, str], DataFrame]

N_VAL = 500
N_TRAIN = 20_000
HASH_DIM = 32
SUBMISSION_WEIGHT = 0.7
TEST_SEED = 7
# Rows from which a key counts as hot in the queries of that path; the real bound is far larger.
HOT_ROWS = 30


def _rounded(frame: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Equal up to summation order; adding 0.0 turns -0.0 into 0.0."""
    return frame.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in columns})


def _elements(frame: DataFrame, array: str, digits: int, *keep: str) -> DataFrame:
    exploded = frame.select(*keep, F.posexplode(array).alias("pos", "value"))
    return _rounded(exploded.withColumn("value", F.col("value").cast("double")), digits, "value")


def _logs(prefixes: dict[str, str] = KEY_PREFIXES) -> list[str]:
    return [f"{p}_log_cnt" for p in prefixes.values()]


# Scans, sources, sinks


def scan_csv_reviews(spark, folder):
    rows = source.reviews(spark, folder)
    path = scratch_path(spark, "reviews.csv")
    files.write_reviews_csv(rows, path)
    return files.read_reviews_csv(spark, path, rows.schema)


def scan_csv_texts(spark, folder):
    rows = source.text_reviews(spark, folder)
    path = scratch_path(spark, "texts.csv")
    files.write_reviews_csv(rows, path)
    return files.read_reviews_csv(spark, path, rows.schema)


def scan_csv_inferred(spark, folder):
    path = scratch_path(spark, "reviews.csv")
    files.write_reviews_csv(source.reviews(spark, folder), path)
    return files.read_reviews_csv(spark, path, schema=None).select(
        "id", F.col("user_id").cast("bigint"), "rating", "votes", "purchased"
    )


def scan_pruned(spark, folder):
    rows = source.reviews(spark, folder)
    csv, parquet = scratch_path(spark, "reviews.csv"), scratch_path(spark, "reviews.parquet")
    files.write_reviews_csv(rows, csv)
    return files.convert_reviews(spark, csv, parquet, rows.schema).select("id", "rating", "purchased", "votes")


def write_stats_parquet(spark, folder):
    """The written statistics of all keys, read back."""
    out = scratch_path(spark, "stats")
    feature_job.build_lookup_tables(source.reviews(spark, folder), out)
    read, _ = feature_job.load_lookup_tables(spark, out)
    result = None
    for key, table in read.items():
        columns = ["rating_sum", "rating_count", "rating_mean"]
        part = table.select(F.lit(key).alias("key_name"), F.col(key).alias("key"), *columns)
        result = part if result is None else result.unionByName(part)
    return result


def _read_stats(key: str) -> Query:
    def query(spark, folder):
        """The statistics of one key, loaded as a lookup table."""
        out = scratch_path(spark, "stats")
        feature_job.build_lookup_tables(source.reviews(spark, folder), out)
        loaded, _ = feature_job.load_lookup_tables(spark, out)
        return feature_job.lookups(loaded)[key]

    return query


def global_avg_artifact(spark, folder):
    out = scratch_path(spark, "prior")
    tables.write_prior(stats.global_mean(source.reviews(spark, folder)), out)
    return tables.read_table(spark, out, tables.PRIOR_TABLE)


def embedding_store(spark, folder):
    """Two updates: the titled texts first, then all texts. Each id is stored once."""
    path = scratch_path(spark, "embeddings")
    texts = source.text_reviews(spark, folder).select("id", "comment", text_fn.review_text().alias("text"))

    def encoded(rows: DataFrame) -> DataFrame:
        return encoders.hashed_embeddings(rows, HASH_DIM)

    embeddings.update_store(texts.filter(F.col("comment").isNotNull()), path, encoded)
    store = embeddings.update_store(texts, path, encoded)
    total = F.aggregate(F.col("embedding").cast("array<double>"), F.lit(0.0), lambda acc, x: acc + x)
    stored = store.groupBy("id").agg(
        F.count(F.lit(1)).alias("copies"),
        F.max(F.size("embedding")).cast("bigint").alias("width"),
        F.max(total).alias("total"),
        F.max(F.col("embedding")[0].cast("double")).alias("first"),
    )
    return _rounded(stored, 6, "total", "first")


def write_submission(spark, folder):
    path = scratch_path(spark, "submission.csv")
    files.write_submission(_blended(spark, folder), path)
    return files.read_submission(spark, path, "string")


def write_metrics(spark, folder):
    path = scratch_path(spark, "metrics.json")
    pairs = _pairs(spark, folder).join(source.reviews(spark, folder).select("id", "rating"), "id")
    score = pairs.agg(evaluate.rmse_of("rating_a", "rating").alias("rmse")).scalar()
    files.write_metrics(files.metrics_frame(_blended(spark, folder), score), path)
    read = files.read_metrics(spark, path).select("best_val_rmse", "prediction_stats.*")
    return _rounded(read, 6, "best_val_rmse", "mean")


# Projections and scalar functions


def concat_review_text(spark, folder):
    return source.text_reviews(spark, folder).select("id", text_fn.review_text().alias("text"))


def text_length(spark, folder):
    texts = concat_review_text(spark, folder)
    return texts.select("id", text_fn.text_length().cast("bigint").alias("text_len"))


def log_count(spark, folder):
    counted = stats.group_stats(source.reviews(spark, folder), "user_id")
    logged = counted.select("user_id", "rating_count", numeric.log_count("rating_count").alias("log_count"))
    return _rounded(logged, 9, "log_count")


def votes_log1p_clipped(spark, folder):
    rows = source.reviews(spark, folder).select("id", numeric.votes_log().alias("votes_log"))
    return _rounded(rows, 9, "votes_log")


def purchased_flag(spark, folder):
    return source.reviews(spark, folder).select("id", numeric.purchased_flag().alias("purchased"))


def votes_fill(spark, folder):
    return source.reviews(spark, folder).select("id", numeric.votes_filled().alias("votes"))


def fill_prior(spark, folder):
    """The rating of purchased items, and the prior elsewhere."""
    rows = source.reviews(spark, folder)
    known = F.when(F.col("purchased"), F.col("rating").cast("double"))
    return rows.select("id", numeric.fill_prior(known, stats.prior_of(rows)).alias("rating"))


def clip_rating(spark, folder):
    """A raw score below, inside and above the bounds, and null."""
    rows = source.reviews(spark, folder)
    return rows.select("id", numeric.clip_rating(F.col("rating") + 0.5 * F.col("votes")).alias("rating"))


def conditional_prior(spark, folder):
    rows = source.reviews(spark, folder)
    counted = stats.group_stats(rows, "prod_id")
    prior = stats.prior_of(rows)
    return counted.select(
        "prod_id", numeric.conditional_prior(F.col("rating_mean"), "rating_count", prior).alias("prod_avg")
    )


def _train_features(spark, folder, **options):
    encoded = encode.loo_all_keys(source.reviews(spark, folder))
    return encode.numeric_features(encoded, **options)


def standardize(spark, folder):
    """All eight numeric features; val rows are scaled by training moments."""
    scaled = training.feature_table(source.reviews(spark, folder), keep=("id",))
    return _rounded(scaled, 6, *features.NUMERIC_COLUMNS)


def standardize_unbounded(spark, folder):
    """Only the log counts, purchased and log votes; averages stay on the rating scale."""
    encoded = _train_features(spark, folder, log_votes=True)
    rows = tables.write_table(encoded, scratch_path(spark, "features"), "raw.parquet")
    fitted = features.moments(rows, features.UNBOUNDED_COLUMNS)
    scaled = features.standardize(rows, features.UNBOUNDED_COLUMNS, fitted, epsilon=None)
    return _rounded(scaled, 6, *features.NUMERIC_COLUMNS)


def assemble_features(spark, folder):
    """Eight features in stats-first order; ``f0`` to ``f7`` are the elements of the array."""
    rows = _train_features(spark, folder, log_votes=True)
    array = rows.select("id", features.feature_array(features.STATS_FIRST_COLUMNS).alias("f"))
    names = [f"f{i}" for i in range(len(features.STATS_FIRST_COLUMNS))]
    return _rounded(array.select("id", *[F.col("f")[i].alias(n) for i, n in enumerate(names)]), 9, *names)


def assemble_embedding(spark, folder):
    """Embedding first, then the numeric columns."""
    rows = source.embedded(spark, folder)
    return _elements(
        rows.select("id", features.feature_array(("label", "mask"), "embedding").alias("f")), "f", 6, "id"
    )


def feature_subset(spark, folder):
    """Width and sum of each ablation's array, with the product text's hashed embedding."""
    rows = encode.numeric_features(
        encode.loo_all_keys(source.reviews(spark, folder)), keep=("id", "parent_prod_id")
    )
    vectors = encoders.hashed_embeddings(source.product_texts(spark, folder), HASH_DIM)
    joined = joins.lookup_join(rows, vectors.withColumnRenamed("id", "parent_prod_id"), "parent_prod_id")
    subsets = features.FEATURE_SUBSETS
    arrays = joined.select("id", *[features.feature_subset(n).alias(n) for n in subsets])
    total = {
        f"{n}_sum": F.aggregate(n, F.lit(0.0), lambda acc, x: acc + x) for n in subsets
    }
    width = {f"{n}_width": F.size(n).cast("bigint") for n in subsets}
    summed = arrays.withColumns({**total, **width}).drop(*subsets)
    return _rounded(summed, 5, *total)


# Aggregations


def global_avg(spark, folder):
    return stats.global_mean(source.reviews(spark, folder))


def _group_stats(key: str) -> Query:
    return lambda spark, folder: stats.group_stats(source.reviews(spark, folder), key)


def _group_avg_count(key: str, prefix: str) -> Query:
    return lambda spark, folder: stats.group_mean_count(source.reviews(spark, folder), key, prefix)


def text_length_profile(spark, folder):
    profile = text_op.text_length_profile(concat_review_text(spark, folder))
    return profile.select(
        "avg_text_len",
        F.col("min_text_len").cast("bigint").alias("min_text_len"),
        F.col("max_text_len").cast("bigint").alias("max_text_len"),
    )


def token_coverage(spark, folder):
    return _rounded(
        text_op.token_coverage(concat_review_text(spark, folder)), 9, "share_within", "p95_words"
    )


def rating_distribution(spark, folder):
    return _rounded(evaluate.rating_distribution(source.reviews(spark, folder)), 9, "percent")


def entity_summary(spark, folder):
    return evaluate.entity_summary(source.reviews(spark, folder))


def row_counts(spark, folder):
    rows = split.fraction_split(source.reviews(spark, folder).select("id"))
    train, val = (rows.filter(F.col("split") == name) for name in ("train", "val"))
    return evaluate.row_counts(train=train, val=val)


def prediction_stats(spark, folder):
    return _rounded(evaluate.prediction_stats(_blended(spark, folder)), 6, "mean", "std")


def rmse(spark, folder):
    encoded = encode.loo_encode(_narrow(spark, folder), "user_id", prefix="user")
    return _rounded(evaluate.rmse(encoded, "user_loo_avg"), 9, "rmse")


def prediction_corr(spark, folder):
    return _rounded(blend.prediction_corr(_pairs(spark, folder)), 6, "correlation")


def masked_mean_pool(spark, folder):
    pooled = pooling.masked_mean_pool(source.embedded(spark, folder), "label")
    return _elements(pooled, "pooled", 6, "label")


# Leave-one-out encoding


def _narrow(spark, folder):
    return source.reviews(spark, folder).select("id", *KEY_PREFIXES, "rating")


def _loo(key: str, prefix: str, encoder=encode.loo_encode, **options) -> Query:
    def query(spark, folder):
        encoded = encoder(_narrow(spark, folder), key, prefix=prefix, **options)
        columns = [f"{prefix}_loo_avg", f"{prefix}_cnt", f"{prefix}_log_cnt"]
        return _rounded(encoded.select("id", *columns), 9, f"{prefix}_log_cnt")

    return query


def _group_mean_encode(key: str) -> Query:
    def query(spark, folder):
        encoded = stats.group_mean_encode(source.reviews(spark, folder), key)
        return _rounded(encoded, 9, f"{key}_log_count")

    return query


def loo_all_keys(spark, folder):
    rows = _train_features(spark, folder)
    return _rounded(rows, 9, *_logs())


def loo_all_keys_window(spark, folder):
    encoded = encode.loo_all_keys(source.reviews(spark, folder), encoder=encode.loo_encode_window)
    return _rounded(encode.numeric_features(encoded), 9, *_logs())


def _train_and_test(spark, folder):
    """The two sides of the split."""
    rows = split.fraction_split(_narrow(spark, folder))
    return (rows.filter(F.col("split") == n).drop("split") for n in ("train", "val"))


def _feature_job(spark, folder):
    """The whole feature job through written tables; test rows are the val side of the split."""
    rows = split.fraction_split(source.reviews(spark, folder))
    train, test = (rows.filter(F.col("split") == n).drop("split") for n in ("train", "val"))
    return feature_job.run_feature_job(train, test.drop("rating"), scratch_path(spark, "features"))


def _key_columns(average: str) -> list[str]:
    return [f"{p}_{c}" for p in KEY_PREFIXES.values() for c in (average, "cnt", "log_cnt")]


def feature_job_train(spark, folder):
    return _rounded(_feature_job(spark, folder)["train"].select("id", *_key_columns("loo_avg")), 9, *_logs())


def feature_job_test(spark, folder):
    return _rounded(_feature_job(spark, folder)["test"].select("id", *_key_columns("avg")), 9, *_logs())


def feature_job_lookups(spark, folder):
    """The distinct lookup rows that the test side uses, of all keys."""
    written = _feature_job(spark, folder)
    result = None
    for key, p in KEY_PREFIXES.items():
        part = written[f"test_{p}_stats"].select(
            F.lit(key).alias("key_name"), F.col(key).alias("key"), F.col(f"{p}_avg").alias("avg"), F.col(f"{p}_cnt").alias("cnt")
        )
        result = part if result is None else result.unionByName(part)
    return result


# Joins


def lookup_join_stats(spark, folder):
    """Val rows encoded by the statistics of training rows; many products are unseen."""
    rows = split.fraction_split(_narrow(spark, folder))
    train, val = (rows.filter(F.col("split") == n).drop("split") for n in ("train", "val"))
    totals, prior = feature_job.build_lookup_tables(train, scratch_path(spark, "stats"))
    applied = encode.apply_all_stats(val.drop("rating"), feature_job.lookups(totals), prior)
    columns = [f"{p}_{c}" for p in KEY_PREFIXES.values() for c in ("avg", "cnt", "log_cnt")]
    return _rounded(applied.select("id", *columns), 9, *_logs())


def _buckets(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def lookup_join_bucketed(spark, folder):
    """The same encoding of val rows, with each key's statistics stored by that key."""
    train, val = _train_and_test(spark, folder)
    out = scratch_path(spark, "stats")
    totals, prior = feature_job.build_lookup_tables(train, out)
    stored = {
        key: bucketed.write_bucketed(table, f"{out}/by_{key}", key, _buckets(spark))
        for key, table in feature_job.lookups(totals).items()
    }
    applied = encode.apply_all_stats(val.drop("rating"), stored, prior)
    return _rounded(applied.select("id", *_key_columns("avg")), 9, *_logs())


# The rating that the corrected reviews had, and have.
WRONG, RIGHT = 3, 2


def _purchases(spark, folder, work: str):
    """The reviews with whether the item was purchased, written once for all loads and their readers."""
    rows = source.reviews(spark, folder).select("id", *KEY_PREFIXES, "rating", "purchased")
    return tables.write_table(rows, work, "reviews")


def _store(spark, reviews, work: str) -> str:
    """A store of three loads by whether the item was purchased, the first two compacted before the third
    comes, and a load that corrects every rating of ``WRONG``."""
    rows = tables.write_table(reviews.drop("purchased").join(reviews.select("id", "purchased"), "id"), work, "rows")
    first, store = scratch_path(spark, "store"), scratch_path(spark, "store")
    keys = tuple(KEY_PREFIXES)
    increments.create_store(spark, first)
    increments.add_load(rows.where("purchased"), first, "purchased", keys)
    increments.add_load(rows.where("NOT purchased"), first, "not-purchased", keys)
    increments.compact(spark, first, store)
    increments.add_load(rows.where("purchased IS NULL"), store, "unknown", keys)
    wrong = rows.where(F.col("rating") == WRONG)
    gone, come = wrong.withColumn("sign", F.lit(-1)), wrong.withColumns({"rating": F.lit(RIGHT), "sign": F.lit(1)})
    increments.add_load(gone.unionByName(come), store, "corrections", keys, sign="sign")
    tables.drop_table(spark, work, "rows")
    tables.drop_table(spark, first, "loads")
    return store


def incremental_totals(spark, folder):
    """The totals of every key and of all rows after those loads."""
    work = scratch_path(spark, "reviews")
    store = _store(spark, _purchases(spark, folder, work), work)
    tables.drop_table(spark, work, "reviews")
    return increments.current_totals(spark, store)


def incremental_loo(spark, folder):
    """Leave-one-out columns of the corrected reviews from the store's totals."""
    work, out = scratch_path(spark, "reviews"), scratch_path(spark, "totals")
    reviews = _purchases(spark, folder, work)
    store = _store(spark, reviews, work)
    increments.write_current(spark, store, out)
    tables.drop_table(spark, store, "loads")
    totals, prior = stats.read_totals(spark, out, tuple(KEY_PREFIXES))
    rating = F.when(F.col("rating") == WRONG, RIGHT).otherwise(F.col("rating"))
    rows = reviews.drop("purchased").withColumn("rating", rating)
    encoded = encode.loo_all_keys(rows, prior=prior, totals=totals, folder=work, earlier="reviews")
    return _rounded(encoded.select("id", *_key_columns("loo_avg")), 9, *_logs())


def _lookup_join_hot(key: str, prefix: str) -> Query:
    def query(spark, folder):
        """Val rows encoded by one key, where keys with few rows count as hot already."""
        train, val = _train_and_test(spark, folder)
        lookup = stats.group_mean_count(train, key, prefix)
        applied = encode.apply_stats(val, lookup, key, prefix, stats.prior_of(train), min_rows=HOT_ROWS)
        return _rounded(applied.select("id", f"{prefix}_avg", f"{prefix}_cnt", f"{prefix}_log_cnt"), 9, f"{prefix}_log_cnt")

    return query


def _map_encode(key: str, prefix: str) -> Query:
    def query(spark, folder):
        train, val = _train_and_test(spark, folder)
        mean = stats.group_mean_rated(train, key, prefix)
        mapped = encode.apply_stats(val, mean, key, prefix, stats.prior_of(train))
        return _rounded(mapped.select("id", f"{prefix}_avg", f"{prefix}_log_cnt"), 9, f"{prefix}_log_cnt")

    return query


def join_embeddings(spark, folder):
    """Every text, with its vector where there is one; no text is lost."""
    vectors = source.embedded(spark, folder).select("id", "embedding")
    joined = joins.join_matched(concat_review_text(spark, folder), vectors)
    total = F.aggregate(F.col("embedding").cast("array<double>"), F.lit(0.0), lambda acc, x: acc + x)
    widths = F.size("embedding").cast("bigint").alias("width")
    lengths = F.length("text").cast("bigint").alias("text_len")
    return _rounded(joined.select("id", "matched", lengths, widths, total.alias("total")), 5, "total")


def embedding_alignment(spark, folder):
    return joins.alignment(source.text_reviews(spark, folder), source.embedded(spark, folder))


def _predictions(spark, folder, key: str, rows: DataFrame | None = None):
    """The leave-one-out predictions of one key; ``rows`` are the reviews where those are written already."""
    encoded = encode.loo_encode(_narrow(spark, folder) if rows is None else rows, key, prefix="key")
    return encoded.select("id", numeric.clip_rating("key_loo_avg").alias("rating"))


def _pairs(spark, folder):
    return blend.join_predictions(
        _predictions(spark, folder, "user_id"), _predictions(spark, folder, "parent_prod_id")
    )


def _blended(spark, folder):
    return blend.blend_predictions(_pairs(spark, folder), SUBMISSION_WEIGHT)


def join_predictions(spark, folder):
    return _pairs(spark, folder)


def product_metadata_join(spark, folder):
    joined = joins.product_metadata_join(source.reviews(spark, folder), source.products(spark, folder))
    return joined.select("id", "parent_prod_id", "rating", "main_category", "price")


# Splits, sampling, distinct


def holdout_split(spark, folder):
    return split.holdout_split(source.reviews(spark, folder).select("id"), N_VAL)


def fraction_split(spark, folder):
    return split.fraction_split(source.reviews(spark, folder).select("id"))


def subset_sample(spark, folder):
    """Validation block, then at most ``N_TRAIN`` training rows."""
    rows = split.holdout_split(source.reviews(spark, folder).select("id"), N_VAL, N_TRAIN)
    return rows.filter(F.col("split") == "train")


def _distinct_lookup(key: str, prefix: str) -> Query:
    def query(spark, folder):
        train, val = _train_and_test(spark, folder)
        lookup = stats.group_mean_count(train, key, prefix)
        applied = encode.apply_stats(val, lookup, key, prefix, stats.prior_of(train))
        return encode.distinct_lookup(applied, key, prefix)

    return query


def best_by_rmse(spark, folder):
    return _rounded(evaluate.best_by_rmse(_baselines(spark, folder), "predictor"), 9, "rmse")


# Text and encoding


def tokenize_truncate_pad(spark, folder):
    """All words are counted; the arrays hold the first 192, which is the operator's contract."""
    tokens = text_op.tokenize_truncate_pad(concat_review_text(spark, folder))
    return tokens.select(
        "id",
        F.col("n_tokens").cast("bigint").alias("n_tokens"),
        F.size("tokens").cast("bigint").alias("width"),
        F.aggregate("attention_mask", F.lit(0), lambda acc, x: acc + x).cast("bigint").alias("mask_sum"),
        F.md5(F.array_join("tokens", " ")).alias("tokens_md5"),
    )


def vocabulary(spark, folder):
    return text_op.vocabulary(concat_review_text(spark, folder))


def encode_token_ids(spark, folder):
    texts = concat_review_text(spark, folder)
    vocab = text_op.vocabulary(texts, min_count=2)
    written = tables.write_table(vocab, scratch_path(spark, "vocabulary"), "vocabulary.parquet")
    return _id_digests(text_op.encode_token_ids(texts, written, max_len=MAX_TOKENS))


def encode_token_ids_whole(spark, folder):
    """The ids of all words of every text."""
    texts = concat_review_text(spark, folder)
    vocab = text_op.vocabulary(texts, min_count=2)
    written = tables.write_table(vocab, scratch_path(spark, "vocabulary"), "vocabulary.parquet")
    return _id_digests(text_op.encode_token_ids(texts, written))


def _id_digests(ids):
    """Per text, one without words included, the number of ids and of real ones, and a sum over all ids."""
    weighted = F.aggregate(
        F.transform("input_ids", lambda x, i: (i + 1) * x), F.lit(0).cast("bigint"), lambda acc, x: acc + x
    )
    return ids.select(
        "id",
        F.size("input_ids").cast("bigint").alias("width"),
        F.aggregate("attention_mask", F.lit(0), lambda acc, x: acc + x).cast("bigint").alias("mask_sum"),
        weighted.alias("weighted_ids"),
    )


def encode_batches(spark, folder):
    texts = concat_review_text(spark, folder)
    return _elements(
        encoders.encode_batches(texts, encoders.hashing_encoder(HASH_DIM)), "embedding", 6, "id"
    )


def hashed_embeddings(spark, folder):
    """The same vectors as ``encode_batches``, by built-in functions."""
    vectors = encoders.hashed_embeddings(concat_review_text(spark, folder), HASH_DIM)
    return _elements(vectors, "embedding", 6, "id")


def encode_tfidf(spark, folder):
    vectors = encoders.tfidf_embeddings(concat_review_text(spark, folder))
    return _elements(vectors, "embedding", 5, "id")


VECTOR_DIM = 8


def cooccurrence_information(spark, folder):
    """Counts and information of all pairs of neighbouring words of all texts."""
    return _rounded(words.positive_information(words.cooccurrences(concat_review_text(spark, folder))), 9, "weight")


def word_vector_step(spark, folder):
    """One product of the information matrix with the starting block."""
    matrix = words.positive_information(words.cooccurrences(concat_review_text(spark, folder)))
    start = tables.write_table(words.starting_block(matrix, VECTOR_DIM), scratch_path(spark, "block"), "start")
    block = words.multiplied(matrix, start, VECTOR_DIM)
    values = F.array(*[F.col(f"v{j}") for j in range(VECTOR_DIM)]).alias("values")
    return _elements(block.select("word", values), "values", 6, "word")


def word_vectors(spark, folder):
    """The shape of the trained vectors: each word once, and its vector's length."""
    vectors = words.word_vectors(concat_review_text(spark, folder), VECTOR_DIM)
    length = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x * x))
    return _rounded(vectors.select("word", F.size("embedding").cast("bigint").alias("width"), length.alias("length")), 5, "length")


def encode_word_vectors(spark, folder):
    """Every text as the mean of its words' trained vectors."""
    texts = concat_review_text(spark, folder)
    vectors = words.word_vectors(texts, VECTOR_DIM)
    return _elements(words.text_vectors(texts, vectors, VECTOR_DIM), "embedding", 4, "id")


# Models, evaluation, blending


def _raw_rows(spark, folder):
    """The two raw numeric columns as features, with the 80/20 split."""
    rows = split.fraction_split(source.reviews(spark, folder))
    raw = rows.select(
        "id", "rating", "split", numeric.purchased_flag().alias("purchased"), numeric.votes_filled().alias("votes")
    )
    return raw.withColumn("features", features.feature_array(features.RAW_COLUMNS))


def _embedded_rows(spark, folder):
    rows = split.fraction_split(source.embedded(spark, folder))
    return rows.withColumn("features", features.feature_array((), "embedding"))


def _coefficients(spark, coefficients, intercept) -> DataFrame:
    values = [(i, float(v)) for i, v in enumerate([intercept, *coefficients])]
    return _rounded(spark.createDataFrame(values, "pos int, value double"), 6, "value")


def gram_matrix(spark, folder):
    return _elements(ridge.gram(_embedded_rows(spark, folder)), "values", 4, "split", "i")


def ridge_fit(spark, folder):
    model = ridge.ridge_fit(_raw_rows(spark, folder), alpha=1.0)
    return _coefficients(spark, model.coefficients, model.intercept)


def ridge_fit_mllib(spark, folder):
    model = ridge.ridge_fit_mllib(_raw_rows(spark, folder), alpha=1.0)
    return _coefficients(spark, model.coefficients, model.intercept)


def ridge_fit_embeddings(spark, folder):
    model = ridge.ridge_fit(_embedded_rows(spark, folder), alpha=1.0)
    return _coefficients(spark, model.coefficients, model.intercept)


def ridge_alpha_grid(spark, folder):
    return _rounded(ridge.ridge_alpha_grid(_raw_rows(spark, folder)).scores, 9, "rmse")


def ridge_alpha_grid_embeddings(spark, folder):
    return _rounded(ridge.ridge_alpha_grid(_embedded_rows(spark, folder)).scores, 6, "rmse")


def ridge_leave_one_out(spark, folder):
    """Each penalty's error on all rows, every row predicted by the model without it."""
    return _rounded(ridge.ridge_leave_one_out(_raw_rows(spark, folder)).scores, 9, "rmse")


def predict_clip(spark, folder):
    """Score all rows by the best penalty, refitted on all rows."""
    rows = _raw_rows(spark, folder)
    scored = ridge.predict(rows, ridge.ridge_alpha_grid(rows).best)
    return _rounded(scored.select("id", F.col("prediction").alias("rating")), 6, "rating")


def gbt_single_tree(spark, folder):
    """Validation error of one tree of depth 1 on the two raw columns, whose few values give exact splits."""
    scores = training.gbt_scores(_raw_rows(spark, folder).drop("features"), "raw", trees=1, depth=1)
    return _rounded(scores, 6, "rmse")


def _submission(spark, folder):
    """The whole training job; a fifth of the reviews, by another seed, are the test rows."""
    rows = split.fraction_split(source.reviews(spark, folder), seed=TEST_SEED)
    train, test = (rows.filter(F.col("split") == n).drop("split") for n in ("train", "val"))
    vectors = encoders.hashed_embeddings(source.product_texts(spark, folder), HASH_DIM)
    vectors = vectors.withColumnRenamed("id", "parent_prod_id")
    folder = scratch_path(spark, "submission")
    return training.run_submission(train, test.drop("rating"), vectors, HASH_DIM, folder, "parent_prod_id")


def submission_job(spark, folder):
    return _rounded(_submission(spark, folder)["predictions"], 5, "rating")


def submission_metrics(spark, folder):
    metrics = _submission(spark, folder)["metrics"].select("best_val_rmse", "train_rmse", "prediction_stats.*")
    return _rounded(metrics, 5, "best_val_rmse", "train_rmse", "min", "max", "mean")


def gbt_stats_baseline(spark, folder):
    table = training.feature_table(source.reviews(spark, folder))
    return _rounded(training.gbt_scores(table), 4, "rmse")


FOREST_TREES, FOREST_DEPTH = 3, 2


def _forest(spark, folder):
    """Boosted trees on the eight features, encoded by the train part, and the rows of both parts."""
    out = scratch_path(spark, "forest")
    train, val = training.encoded_splits(source.reviews(spark, folder), out)
    # Logs differ in their last digit from engine to engine, and bins shouldn't.
    train, val = (tables.write_table(_rounded(rows, 9, *_logs()), out, name) for rows, name in ((train, "train"), (val, "val")))
    return histogram_trees.fit_forest(train, features.NUMERIC_COLUMNS, trees=FOREST_TREES, depth=FOREST_DEPTH), train, val


def gbt_histogram(spark, folder):
    """Predictions of the val rows by three boosted trees of depth 2."""
    forest, _, val = _forest(spark, folder)
    scored = histogram_trees.forest_predict(val, forest)
    return _rounded(scored.select("id", F.col("prediction").alias("rating")), 6, "rating")


def gbt_histogram_trees(spark, folder):
    forest, _, _ = _forest(spark, folder)
    return histogram_trees.forest_table(spark, forest)


def _baselines(spark, folder):
    """``(predictor, rmse)``: the prior and each key's leave-one-out mean as predictors."""
    rows = _narrow(spark, folder)
    encoded = encode.loo_all_keys(rows)
    predictors = {"prior": stats.prior_of(rows), **{p: F.col(f"{p}_loo_avg") for p in KEY_PREFIXES.values()}}
    entries = [
        F.struct(F.lit(name).alias("predictor"), evaluate.rmse_of(value).alias("rmse"))
        for name, value in predictors.items()
    ]
    return encoded.agg(F.array(*entries).alias("scores")).select(F.inline("scores"))


def loo_baseline_rmse(spark, folder):
    return _rounded(_baselines(spark, folder), 9, "rmse")


def blend_weight_sweep(spark, folder):
    return _rounded(blend.blend_weight_sweep(_pairs(spark, folder)), 6, "min", "max", "mean")


def weighted_blend(spark, folder):
    """An even blend of the two prediction sets."""
    return _rounded(blend.blend_predictions(_pairs(spark, folder), 0.5), 9, "rating")


def blend_final(spark, folder):
    return _rounded(_blended(spark, folder), 9, "rating")


def ablation_table(spark, folder):
    """Ridge on every feature subset, with the product text's hashed embedding, and one shallow tree."""
    rows = source.reviews(spark, folder)
    table = training.feature_table(rows, keep=("id", "parent_prod_id", "rating"))
    vectors = encoders.hashed_embeddings(source.product_texts(spark, folder), HASH_DIM)
    joined = training.with_embeddings(
        table, vectors.withColumnRenamed("id", "parent_prod_id"), HASH_DIM, "parent_prod_id"
    )
    return _rounded(training.ablation_table(joined, tree_subsets=("raw",), trees=1, depth=1), 6, "rmse")


# Stored summaries


PARTS = 3


def _parts(rows):
    """Rows by part, as three loads would bring them."""
    return [(f"part-{k}", rows.where(hashing.split_bucket("id", TEST_SEED) % PARTS == k)) for k in range(PARTS)]


def distinct_sketches(spark, folder):
    """Per key of the reviews, for each part and for all: rows, exact distinct values, and whether the
    stored sketches, united, come within their bound."""
    rows, store = _narrow(spark, folder), scratch_path(spark, "sketches")
    keys = tuple(KEY_PREFIXES)
    for name, part in _parts(rows):
        sketches.add_part(part, store, name, keys)
    united = sketches.distinct_counts(spark, store).withColumn("part_name", F.lit("all"))
    estimates = sketches.part_counts(spark, store).unionByName(united)
    number = F.concat(F.lit("part-"), (hashing.split_bucket("id", TEST_SEED) % PARTS).cast("string"))
    values = F.inline(F.array(*[F.struct(F.lit(k).alias("key_name"), F.col(k).alias("key")) for k in keys]))
    pairs = rows.select(F.explode(F.array(number, F.lit("all"))).alias("part_name"), *keys).select("part_name", values)
    counted = pairs.distinct().groupBy("part_name", "key_name").agg(F.count(F.lit(1)).alias("exact_count"))
    off = F.abs(F.col("distinct_count") - F.col("exact_count"))
    within = off <= F.col("exact_count") * sketches.ERROR_BOUND
    compared = estimates.join(counted, ["part_name", "key_name"])
    return compared.select("part_name", "key_name", "row_count", "exact_count", within.alias("within_bound"))


QUANTILE_SHARES = (0.0, 0.01, 0.25, 0.5, 0.75, 0.95, 1.0)


def quantile_summaries(spark, folder):
    """Quantiles of text lengths in characters and words and of the reviews' times, from stored
    summaries of three parts each: how many rows there are, the exact quantile, and whether the
    stored one's rank is within the bound."""
    texts = concat_review_text(spark, folder)
    words_of = F.size(text_fn.word_tokens("text"))
    measures = {
        "characters": texts.select("id", F.length("text").alias("x")),
        "words": texts.select("id", words_of.alias("x")),
        "time": source.reviews(spark, folder).select("id", F.col("time").alias("x")),
    }
    result = None
    for name, rows in measures.items():
        store = scratch_path(spark, "rank-summaries")
        for part_name, part in _parts(rows):
            rank_summaries.add_part(part, store, part_name, "x", error=0.01, block_values=1000, fan=4)
        found = rank_summaries.quantiles(spark, store, QUANTILE_SHARES)
        counted = rows.groupBy(F.col("x").cast("double").alias("x")).agg(F.count(F.lit(1)).alias("n"))
        target = F.greatest(F.lit(1), F.ceil(F.col("share") * F.col("n_rows")))
        # The few quantiles travel as one array beside each distinct value.
        asked = found.agg(F.collect_list(F.struct("share", "n_rows", "slack", "value"))).scalar()
        against = counted.select("x", "n", F.inline(asked)).groupBy("share", "n_rows", "slack").agg(
            F.sum(F.when(F.col("x") <= F.col("value"), F.col("n"))).alias("upto"),
            F.coalesce(F.sum(F.when(F.col("x") < F.col("value"), F.col("n"))), F.lit(0)).alias("below"),
        )
        within = (F.col("upto") >= target) & (F.col("below") < target + F.col("slack"))
        within = within & (F.col("slack") <= 0.01 * F.col("n_rows") * (1 + 1e-9))
        part = against.select(F.lit(name).alias("measure"), "share", "n_rows", within.alias("within_bound"))
        result = part if result is None else result.unionByName(part)
    return result


# Models at scale, comparisons


def _prediction_sets(spark, folder):
    """The leave-one-out predictions of every key, and the rating. The reviews, each set and the result are
    written, so that no more than one step's shuffles are there at a time."""
    out = scratch_path(spark, "prediction-sets")
    rows = tables.write_table(_narrow(spark, folder), out, "reviews")
    sets = {p: tables.write_table(_predictions(spark, folder, k, rows), out, p) for k, p in KEY_PREFIXES.items()}
    joined = blend.join_prediction_sets(sets)
    return tables.write_table(joined.join(rows.select("id", "rating"), "id"), out, "joined")


def blend_simplex(spark, folder):
    """The best weights of the three keys' predictions, and the blend's error."""
    found = blend.simplex_blend(_prediction_sets(spark, folder), list(KEY_PREFIXES.values()))
    rows = [(name, weight, found.rmse) for name, weight in found.weights.items()]
    return _rounded(spark.createDataFrame(rows, "predictor string, weight double, rmse double"), 6, "weight", "rmse")


def blend_simplex_predictions(spark, folder):
    rows = _prediction_sets(spark, folder)
    found = blend.simplex_blend(rows, list(KEY_PREFIXES.values()))
    return _rounded(blend.blend_sets(rows, found.weights), 5, "rating")


REPLICATES = 40


def _baseline_replicates(spark, folder):
    rows = _narrow(spark, folder)
    predictors = {"prior": stats.prior_of(rows), **{p: F.col(f"{p}_loo_avg") for p in KEY_PREFIXES.values()}}
    return bootstrap.replicate_sums(encode.loo_all_keys(rows), predictors, REPLICATES)


def bootstrap_sums(spark, folder):
    """Weights and squared errors of the four baselines in each of forty replicates of the reviews."""
    return _rounded(_baseline_replicates(spark, folder), 3, "squared")


def bootstrap_intervals(spark, folder):
    """How far each baseline's error is above that of the prior, with its interval."""
    sums = tables.write_table(_baseline_replicates(spark, folder), scratch_path(spark, "replicates"), "sums")
    found = bootstrap.difference_intervals(sums, "prior")
    return _rounded(found, 8, "rmse", "difference", "low", "high")


def ablation_intervals(spark, folder):
    """Ridge on the subsets without embedding: how far each is above all numeric features."""
    table = training.feature_table(source.reviews(spark, folder), keep=("id", "rating"))
    subsets = ("raw", "stats", "stats_raw")
    found = training.ablation_intervals(table, subsets, against="stats_raw", replicates=REPLICATES)
    return _rounded(found, 6, "rmse", "difference", "low", "high")


def encode_tfidf_slots(spark, folder):
    """The sparse vector of every text in 2^18 slots."""
    vectors = encoders.tfidf_slots(concat_review_text(spark, folder))
    entries = vectors.select("id", F.inline(F.arrays_zip("slots", "values")).alias("slot", "value"))
    return _rounded(entries, 6, "value")


def ridge_tfidf(spark, folder):
    """Every penalty's error of reviews predicted from their product's text in 2^18 slots."""
    texts = encoders.tfidf_slots(source.product_texts(spark, folder)).withColumnRenamed("id", "parent_prod_id")
    rows = split.fraction_split(source.reviews(spark, folder)).select("id", "parent_prod_id", "rating", "split")
    rows = tables.write_table(joins.lookup_join(rows, texts, "parent_prod_id"), scratch_path(spark, "sparse"), "rows")
    models = ridge_sparse.fit_sparse(rows.where("split = 'train'"), 1 << 18)
    scored = ridge_sparse.score_sparse(rows.where("split = 'val'"), models)
    entries = [
        F.struct(F.lit(m.alpha).alias("alpha"), evaluate.rmse_of(F.col("scores")[i]).alias("rmse"))
        for i, m in enumerate(models)
    ]
    return _rounded(scored.agg(F.array(*entries).alias("grid")).select(F.inline("grid")), 6, "rmse")


QUERIES: dict[str, Query] = {
    "scan_csv_reviews": scan_csv_reviews,
    "scan_csv_texts": scan_csv_texts,
    "scan_csv_inferred": scan_csv_inferred,
    "scan_pruned": scan_pruned,
    "write_stats_parquet": write_stats_parquet,
    "read_stats_parquet": _read_stats("prod_id"),
    "read_stats_parquet_user": _read_stats("user_id"),
    "read_stats_parquet_parent": _read_stats("parent_prod_id"),
    "global_avg_artifact": global_avg_artifact,
    "embedding_store": embedding_store,
    "write_submission": write_submission,
    "write_metrics": write_metrics,
    "concat_review_text": concat_review_text,
    "text_length": text_length,
    "log_count": log_count,
    "votes_log1p_clipped": votes_log1p_clipped,
    "purchased_flag": purchased_flag,
    "votes_fill": votes_fill,
    "fill_prior": fill_prior,
    "clip_rating": clip_rating,
    "conditional_prior": conditional_prior,
    "standardize": standardize,
    "standardize_unbounded": standardize_unbounded,
    "assemble_features": assemble_features,
    "assemble_embedding": assemble_embedding,
    "feature_subset": feature_subset,
    "global_avg": global_avg,
    **{f"group_stats_{p}": _group_stats(k) for k, p in KEY_PREFIXES.items()},
    **{f"group_avg_count_{p}": _group_avg_count(k, p) for k, p in KEY_PREFIXES.items()},
    "text_length_profile": text_length_profile,
    "token_coverage": token_coverage,
    "rating_distribution": rating_distribution,
    "entity_summary": entity_summary,
    "row_counts": row_counts,
    "prediction_stats": prediction_stats,
    "rmse": rmse,
    "prediction_corr": prediction_corr,
    "masked_mean_pool": masked_mean_pool,
    **{f"loo_encode_{p}": _loo(k, p) for k, p in KEY_PREFIXES.items()},
    "loo_encode_hot": _loo("user_id", "user", min_rows=HOT_ROWS),
    "loo_encode_window_hot": _loo("user_id", "user", encode.loo_encode_window, min_rows=HOT_ROWS),
    "loo_encode_window": _loo("user_id", "user", encode.loo_encode_window),
    "loo_full_frame": _loo("parent_prod_id", "parent", encode.loo_encode_window, full_frame=True),
    **{f"group_mean_encode_{p}": _group_mean_encode(k) for k, p in KEY_PREFIXES.items()},
    "loo_all_keys": loo_all_keys,
    "loo_all_keys_window": loo_all_keys_window,
    "feature_job": feature_job_train,
    "feature_job_test": feature_job_test,
    "feature_job_lookups": feature_job_lookups,
    "lookup_join_stats": lookup_join_stats,
    "lookup_join_bucketed": lookup_join_bucketed,
    "incremental_totals": incremental_totals,
    "incremental_loo": incremental_loo,
    "lookup_join_hot": _lookup_join_hot("user_id", "user"),
    "map_encode": _map_encode("prod_id", "prod"),
    "map_encode_user": _map_encode("user_id", "user"),
    "map_encode_parent": _map_encode("parent_prod_id", "parent"),
    "join_embeddings": join_embeddings,
    "embedding_alignment": embedding_alignment,
    "join_predictions": join_predictions,
    "product_metadata_join": product_metadata_join,
    "holdout_split": holdout_split,
    "fraction_split": fraction_split,
    "subset_sample": subset_sample,
    "distinct_lookup": _distinct_lookup("prod_id", "prod"),
    "distinct_lookup_user": _distinct_lookup("user_id", "user"),
    "distinct_lookup_parent": _distinct_lookup("parent_prod_id", "parent"),
    "best_by_rmse": best_by_rmse,
    "tokenize_truncate_pad": tokenize_truncate_pad,
    "vocabulary": vocabulary,
    "encode_token_ids": encode_token_ids,
    "encode_token_ids_whole": encode_token_ids_whole,
    "encode_batches": encode_batches,
    "hashed_embeddings": hashed_embeddings,
    "encode_tfidf": encode_tfidf,
    "cooccurrence_information": cooccurrence_information,
    "word_vector_step": word_vector_step,
    "word_vectors": word_vectors,
    "encode_word_vectors": encode_word_vectors,
    "gram_matrix": gram_matrix,
    "ridge_fit": ridge_fit,
    "ridge_fit_mllib": ridge_fit_mllib,
    "ridge_fit_embeddings": ridge_fit_embeddings,
    "ridge_alpha_grid": ridge_alpha_grid,
    "ridge_alpha_grid_embeddings": ridge_alpha_grid_embeddings,
    "ridge_leave_one_out": ridge_leave_one_out,
    "predict_clip": predict_clip,
    "gbt_single_tree": gbt_single_tree,
    "gbt_histogram": gbt_histogram,
    "gbt_histogram_trees": gbt_histogram_trees,
    "gbt_stats_baseline": gbt_stats_baseline,
    "submission_job": submission_job,
    "submission_metrics": submission_metrics,
    "loo_baseline_rmse": loo_baseline_rmse,
    "blend_weight_sweep": blend_weight_sweep,
    "weighted_blend": weighted_blend,
    "blend_final": blend_final,
    "ablation_table": ablation_table,
    "distinct_sketches": distinct_sketches,
    "quantile_summaries": quantile_summaries,
    "blend_simplex": blend_simplex,
    "blend_simplex_predictions": blend_simplex_predictions,
    "bootstrap_sums": bootstrap_sums,
    "bootstrap_intervals": bootstrap_intervals,
    "ablation_intervals": ablation_intervals,
    "encode_tfidf_slots": encode_tfidf_slots,
    "ridge_tfidf": ridge_tfidf,
}
