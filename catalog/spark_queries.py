"""The Spark form of every query: ``name -> function(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import views as v
from msgloom.config import MESSAGE_KEYWORDS, PipelineConfig
from msgloom.functions import identity, text, vectors
from msgloom.functions import time as clock
from msgloom.functions import tokens as tk
from msgloom.operators import cooccurrence, embeddings, filters, incremental, labels, lexicon, metrics, sentence, sequences, signlearn, statistics, tfidf, tokenize, wordvec
from msgloom.plans import features as plans
from msgloom.plans import training
from msgloom.sources import features as feature_files
from msgloom.sources import messages as message_files
from msgloom.sources import vocabulary as vocab_files
from msgloom.staging import Staging

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
AES_KEY, AES_IV = b"0123456789abcdef", b"fedcba9876543210"


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six places, for comparing results of different engines."""
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def as_of() -> Column:
    return F.lit(v.AS_OF).cast("timestamp")


# --- filter and de-duplication ------------------------------------------------------------


def _filtered(spark: SparkSession, sf: str, **options) -> DataFrame:
    kept = filters.filter_messages(v.messages(spark, sf), v.SETTING, **options)
    return kept.select("id", "ord", "sign", F.md5("message").alias("digest"))


@query
def filter_messages(spark, sf):
    return _filtered(spark, sf)


@query
def filter_messages_strict(spark, sf):
    return _filtered(spark, sf, keep_verification=False, strict_compat=True)


@query
def filter_messages_no_verification(spark, sf):
    return _filtered(spark, sf, keep_verification=False)


@query
def filter_messages_off(spark, sf):
    return filters.filter_messages(v.messages(spark, sf), None).select("id", "ord", "sign", F.md5("message").alias("digest"))


@query
def message_counts(spark, sf):
    raw = v.messages(spark, sf)
    return filters.message_counts(raw, filters.filter_messages(raw, v.SETTING))


@query
def dedup_messages(spark, sf):
    rows = v.table(spark, sf, "documents").select(F.col("lang").alias("id"), F.col("text").alias("message"), F.col("doc_id").alias("row_no"))
    unique = filters.drop_duplicate_rows(rows)
    return unique.select("id", F.md5("message").alias("digest"), "row_no")


# --- row level ----------------------------------------------------------------------------


@query
def message_measures(spark, sf):
    m = F.col("message")
    return v.messages(spark, sf).select(
        "row_no",
        text.message_length(m).alias("message_length"),
        text.word_count(m).alias("word_count"),
        text.digit_count(m).alias("digit_count"),
        text.punctuation_count(m).alias("punctuation_count"),
        text.amount_count(m).alias("amount_count"),
        text.amount_count(m, escaped_dollar=True).alias("dollar_amount_count"),
        text.slash_count(m).alias("slash_count"),
        text.url_count(m).alias("url_count"),
        *[text.keyword_count(m, words).alias(f"{name}_count") for name, words in v.KEYWORDS.items()],
    )


@query
def message_predicates(spark, sf):
    m = F.col("message")
    return v.messages(spark, sf).select(
        "row_no",
        text.matches_any(m, v.SETTING["keep_keywords"]).cast("int").alias("keep"),
        text.matches_any(m, v.SETTING["keywords_to_remove"]).cast("int").alias("remove"),
        text.is_verification(m).cast("int").alias("verification"),
    )


@query
def time_parts(spark, sf):
    ts = F.col("ts")
    return v.ordered_headers(spark, sf).select(
        "ord",
        clock.hour(ts).alias("hour"),
        clock.day_of_week(ts).alias("day_of_week"),
        clock.is_weekend(ts).alias("is_weekend"),
        clock.is_work_time(ts).alias("is_work_time"),
        clock.is_night(ts).alias("is_night"),
    )


@query
def time_parse(spark, sf):
    """Times written in five ways, one of them unreadable, and read back."""
    ts = F.col("ts")
    kind = F.col("event_id") % 5
    written = (
        F.when(kind == 0, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(kind == 1, F.date_format(ts, "yyyy/M/d H:mm:ss"))
        .when(kind == 2, F.date_format(ts, "yyyyMMdd"))
        .when(kind == 3, F.date_format(ts, "M/d/yyyy H:mm"))
        .otherwise(F.concat(F.lit("at "), F.date_format(ts, "HH:mm")))
    )
    rows = v.table(spark, sf, "events").select("event_id", written.alias("written"))
    parsed = clock.parse_time(F.col("written"))
    return rows.select("event_id", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss").alias("parsed"))


@query
def decrypt_ids(spark, sf):
    iv = F.lit(bytearray(AES_IV))
    sealed = F.aes_encrypt(F.col("id"), F.lit(bytearray(AES_KEY)), F.lit("CBC"), F.lit("PKCS"), iv)
    stripped = F.base64(F.expr("substring(sealed, 17)"))
    rows = v.ordered_headers(spark, sf).select("ord", sealed.alias("sealed")).select("ord", stripped.alias("enc_id"))
    return identity.decrypt_id(rows, "enc_id", AES_KEY, AES_IV).select("ord", "id")


@query
def phone_codes(spark, sf):
    ids = v.ordered_headers(spark, sf).select("id").distinct()
    return ids.select("id", identity.area_code(F.col("id")).alias("area_code"), identity.carrier_code(F.col("id")).alias("carrier_code"))


# --- statistics per user ------------------------------------------------------------------


@query
def time_features(spark, sf):
    return rounded(statistics.time_features(v.ordered_headers(spark, sf)))


@query
def content_features(spark, sf):
    return rounded(statistics.content_features(v.ordered_messages(spark, sf), MESSAGE_KEYWORDS))


@query
def keyword_features(spark, sf):
    features = statistics.content_features(v.ordered_messages(spark, sf), v.KEYWORDS)
    return rounded(features.select("id", *[c for c in features.columns if "keyword" in c]))


@query
def sign_diversity(spark, sf):
    return rounded(statistics.sign_features(v.ordered_headers(spark, sf)))


@query
def dominant_sign(spark, sf):
    """The same figures where one signature of each user dominates."""
    rows = v.ordered_headers(spark, sf).withColumn("sign", F.when(F.col("ord") % 3 == 0, F.lit("【hot】")).otherwise(F.col("sign")))
    return rounded(statistics.sign_features(rows).select("id", "unique_signs", "dominant_sign_ratio"))


@query
def carrier_stats(spark, sf):
    return statistics.carrier_statistics(v.ordered_messages(spark, sf))


@query
def area_features(spark, sf):
    return statistics.area_features(v.ordered_messages(spark, sf), Staging(spark))


@query
def message_distribution(spark, sf):
    return rounded(statistics.distribution_features(v.ordered_messages(spark, sf), as_of()))


@query
def all_statistics(spark, sf):
    rows = v.ordered_messages(spark, sf)
    return rounded(statistics.all_statistics(rows, v.KEYWORDS, "cn", as_of(), Staging(spark)))


# --- sequences ----------------------------------------------------------------------------


@query
def sign_vocab(spark, sf):
    return sequences.fit_sign_vocabulary(v.ordered_headers(spark, sf), Staging(spark))


def _daily_headers(spark: SparkSession, sf: str) -> DataFrame:
    """Times cut to the day, so that many rows of a user tie."""
    return v.ordered_headers(spark, sf).withColumn("ts", F.date_trunc("day", "ts"))


def _slots(sequence: DataFrame) -> DataFrame:
    return sequence.select("id", F.posexplode("sign_id_seq").alias("pos", "sign_id"))


@query
def sign_sequences_train(spark, sf):
    rows = _daily_headers(spark, sf)
    vocabulary = sequences.fit_sign_vocabulary(rows, Staging(spark))
    return _slots(sequences.sign_sequences(rows, vocabulary, 50, is_train=True))


@query
def sign_sequences_infer(spark, sf):
    """The vocabulary knows only the signatures of views and clicks."""
    rows = _daily_headers(spark, sf)
    seen = rows.where(F.col("sign").contains("view") | F.col("sign").contains("click"))
    vocabulary = sequences.fit_sign_vocabulary(seen, Staging(spark))
    return _slots(sequences.sign_sequences(rows, vocabulary, 20, is_train=False, oov_id=1))


@query
def sign_vocab_round_trip(spark, sf):
    """Ids by first appearance, exported as JSON and as Parquet and read back."""
    staging = Staging(spark)
    vocabulary = sequences.fit_sign_vocabulary(v.ordered_headers(spark, sf), staging)
    vocab_files.write_vocabulary_json(vocabulary, f"{staging.path}/signs.json")
    vocab_files.write_vocabulary(vocabulary, f"{staging.path}/signs")
    table = vocab_files.read_vocabulary(spark, f"{staging.path}/signs")
    return vocab_files.read_vocabulary_json(spark, f"{staging.path}/signs.json").intersect(table)


# --- vectors ------------------------------------------------------------------------------


def _pooled(pooling: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        pooled = embeddings.pool_embeddings(v.message_vectors(spark, sf), pooling)
        return rounded(pooled.select("id", F.posexplode("embedding").alias("pos", "value")))

    return run


for _name in ("mean", "max", "min", "sum"):
    QUERIES[f"pool_{_name}"] = _pooled(_name)


@query
def tokens(spark, sf):
    rows = tokenize.tokenize(v.ordered_messages(spark, sf), clean=False)
    return rows.select("ord", F.size("tokens").alias("n"), F.md5(F.array_join("tokens", " ")).alias("digest"))


@query
def token_filter(spark, sf):
    rows = tokenize.tokenize(v.ordered_messages(spark, sf), v.STOPWORDS, lower=True)
    return rows.select("ord", F.size("tokens").alias("n"), F.md5(F.array_join("tokens", " ")).alias("digest"))


@query
def stopword_anti_join(spark, sf):
    """The stopwords as a table: all words of the benchmark texts."""
    benchmark = v.table(spark, sf, "benchmark").select(F.explode(tk.segment(F.lower("text"))).alias("word"))
    rows = tokenize.tokenize(v.source_texts(spark, sf), benchmark.distinct(), lower=True)
    return rows.select("ord", F.size("tokens").alias("n"), F.md5(F.array_join("tokens", " ")).alias("digest"))


@query
def user_text(spark, sf):
    return tokenize.user_text(v.ordered_messages(spark, sf), F.md5("message").alias("digest"))


def _source_tokens(spark: SparkSession, sf: str, staging: Staging) -> DataFrame:
    """Written once, as inner and crossing n-grams both read it."""
    rows = staging.write(tokenize.tokenize(v.source_texts(spark, sf), v.STOPWORDS, lower=True), "tokens")
    staging.release()  # the texts as they were dealt
    return rows


@query
def ngram_counts(spark, sf):
    return tfidf.term_statistics(_source_tokens(spark, sf, Staging(spark)), (1, 2))


@query
def trigram_counts(spark, sf):
    return tfidf.term_statistics(_source_tokens(spark, sf, Staging(spark)), (3, 3))


def _fitted_tfidf(spark: SparkSession, sf: str) -> tuple[DataFrame, tfidf.TfIdfModel]:
    staging = Staging(spark)
    rows = _source_tokens(spark, sf, staging)
    return rows, tfidf.fit_tfidf(rows, staging, 300, (1, 2), 2, 0.95)


@query
def tfidf_vocab(spark, sf):
    return rounded(_fitted_tfidf(spark, sf)[1].vocabulary)


@query
def tfidf_weights(spark, sf):
    return rounded(tfidf.tfidf_weights(*_fitted_tfidf(spark, sf)))


@query
def tfidf_vectors(spark, sf):
    found = tfidf.tfidf_vectors(*_fitted_tfidf(spark, sf))
    return rounded(found.select("id", F.posexplode("static_vec").alias("idx", "w")))


@query
def w2v_user_vector(spark, sf):
    """Averaging with given vectors for all tokens that occur at least twice, the default of the fit."""
    rows = tokenize.tokenize(v.source_texts(spark, sf))
    frequent = rows.select(F.explode("tokens").alias("word")).groupBy("word").count().where("count >= 2")
    coordinates = F.array(*[v.md5_number(F.col("word"), 1 + 8 * i) % 1000 / F.lit(1000.0) for i in range(4)])
    known = frequent.select("word", vectors.as_vector(coordinates).alias("v"))
    users = wordvec.user_word_vectors(rows, wordvec.WordVectors(known, 4))
    return rounded(users.select("id", F.posexplode("static_vec").alias("pos", "value")))


@query
def w2v_fit(spark, sf):
    """The words that were learned, and the length of their vectors, at the published settings."""
    rows = tokenize.tokenize(v.source_texts(spark, sf))
    words = wordvec.WordVectors.of(wordvec.fit_word2vec(rows), Staging(spark))
    return words.table.select("word", F.size(vectors.as_array(F.col("v"))).alias("size"))


@query
def encoder_means(spark, sf):
    """Frequency-weighted means of given vectors per message, which the encoder takes the common component from."""
    staging = Staging(spark)
    rows = staging.write(tokenize.tokenize(v.source_texts(spark, sf)), "tokens")
    staging.release()  # the texts as they were dealt
    words = cooccurrence.frequent_words(rows, 2)
    coordinates = F.array(*[v.md5_number(F.col("word"), 1 + 8 * i) % 1000 / F.lit(1000.0) for i in range(4)])
    known = wordvec.WordVectors(staging.write(words.select("word", vectors.as_vector(coordinates).alias("v")), "known"), 4)
    means = sentence.mean_vectors(rows, sentence.weighted_words(rows, known, staging))
    return rounded(means.select("ord", F.posexplode("v").alias("pos", "value")))


@query
def lexicon_scores(spark, sf):
    """Every substring of up to four Chinese characters with its count, cohesion, entropy and log probability."""
    counts = Staging(spark).write(lexicon.substring_counts(v.messages(spark, sf)), "substrings")
    found = rounded(lexicon.substring_scores(counts))
    return found.select("gram", "length", "n", *((F.col(c) + 0.0).alias(c) for c in ("cohesion", "entropy", "logp")))  # no negative zeros


@query
def lexicon_tokens(spark, sf):
    """Messages cut along the best paths through a lexicon learned from them."""
    staging = Staging(spark)
    rows = staging.write(v.ordered_messages(spark, sf), "messages")
    words = lexicon.fit_lexicon(rows, staging, min_entropy=0.0)
    tokens = lexicon.segment_messages(rows, words, staging)
    return tokens.select("ord", F.size("tokens").alias("n"), F.md5(F.array_join("tokens", " ")).alias("digest"))


@query
def cooccurrence_words(spark, sf):
    """Every word that occurs twice, with its contexts: how many, their weight and their positive log ratios."""
    staging = Staging(spark)
    rows = staging.write(tokenize.tokenize(v.source_texts(spark, sf)), "tokens")
    words = cooccurrence.numbered(cooccurrence.frequent_words(rows, 2), staging)
    pairs = staging.write(cooccurrence.cooccurrences(rows, words), "pairs")
    ratios = cooccurrence.log_ratios(pairs, staging=staging).groupBy("word").agg(F.count("*").alias("positive"), F.sum("value").alias("ratios"))
    weights = pairs.groupBy("word").agg(F.count("*").alias("contexts"), F.sum("weight").alias("weight"))
    return rounded(cooccurrence.named(weights.join(ratios, "word", "left").fillna(0), words, "word"))


@query
def svd_reconstruction(spark, sf):
    """Log ratios of frequent words, put together again from 300 singular vectors; exact while there are no more words than that."""
    staging = Staging(spark)
    rows = staging.write(tokenize.tokenize(v.source_texts(spark, sf)), "tokens")
    words = cooccurrence.numbered(cooccurrence.frequent_words(rows, 150), staging)
    pairs = staging.write(cooccurrence.cooccurrences(rows, words), "pairs")
    entries = staging.write(cooccurrence.log_ratios(pairs, staging=staging), "ratios")
    found, values = cooccurrence.leading_vectors(entries, 300, staging)
    put = cooccurrence.reconstructed(entries, found, values).withColumn("value", F.round("value", 4))
    return cooccurrence.named(put, words, "word", "context")


@query
def embed_messages(spark, sf):
    """Length and norm of the hashed vectors: one if there is a token, else zero."""
    embedded = embeddings.embed_messages(v.source_texts(spark, sf), "hashing", size=64)
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda total, x: total + x * x))
    return rounded(embedded.select("ord", F.size("embedding").alias("size"), norm.alias("norm")))


def _letter_counts(language):
    letters = "abcdefghijklmnopqrstuvwxyz"

    def encode(texts):
        return np.array([[t.lower().count(c) for c in letters] for t in texts], dtype="float32")

    return encode


@query
def embed_messages_encoder(spark, sf):
    """The encoder seam: a registered Python encoder over Arrow batches (letter counts)."""
    embeddings.register_encoder("letter-counts", _letter_counts)
    embedded = embeddings.embed_messages(v.source_texts(spark, sf), "letter-counts")
    return embedded.select("ord", F.posexplode(F.col("embedding").cast("array<double>")).alias("pos", "value"))


# --- labels, split, evaluation ------------------------------------------------------------


@query
def label_join(spark, sf):
    rows = v.ordered_headers(spark, sf)
    return rounded(labels.join_labels(statistics.sign_features(rows), rows))


@query
def label_fanout(spark, sf):
    rows = v.ordered_headers(spark, sf)
    return rounded(labels.join_labels(statistics.sign_features(rows), rows, fan_out=True))


@query
def split_users(spark, sf):
    users = v.ordered_headers(spark, sf).select("id").distinct()
    fit_rows, held_out = labels.split_users(users)
    return fit_rows.withColumn("held_out", F.lit(0)).unionByName(held_out.withColumn("held_out", F.lit(1)))


@query
def confusion_metrics(spark, sf):
    return rounded(metrics.confusion_metrics(v.scores(spark, sf)))


@query
def roc_auc(spark, sf):
    return rounded(metrics.roc_auc(v.scores(spark, sf)))


@query
def ks_stat(spark, sf):
    return rounded(metrics.ks_statistic(v.scores(spark, sf)))


# --- batch by batch ------------------------------------------------------------------------


@query
def incremental_statistics(spark, sf):
    """All statistics, kept up over three batches of the messages, the second of which is committed twice."""
    staging = Staging(spark)
    rows = staging.write(v.ordered_messages(spark, sf), "messages")
    store = incremental.IncrementalStatistics(spark, f"{staging.path}/statistics", v.KEYWORDS)
    for name, batch in (("a", 0), ("b", 1), ("b", 1), ("c", 2)):
        store.commit(name, rows.where(F.pmod("ord", F.lit(3)) == batch), staging)
    return rounded(store.statistics(staging, as_of()))


@query
def distinct_over_batches(spark, sf):
    """Distinct rows of three batches, taken one after the other."""
    staging = Staging(spark)
    rows = v.table(spark, sf, "documents").select(F.col("lang").alias("id"), F.col("text").alias("message"), F.col("doc_id").alias("row_no"))
    third = rows.agg(F.max("row_no")).first()[0] // 3 + 1
    index = incremental.DistinctRows(spark, f"{staging.path}/distinct")
    taken = [index.take(str(i), rows.where(F.expr(f"row_no div {third}") == i), staging) for i in range(3)]
    unique = taken[0].unionByName(taken[1]).unionByName(taken[2])
    return unique.select("id", F.md5("message").alias("digest"), "row_no")


# --- files and whole plans ----------------------------------------------------------------


@query
def csv_round_trip(spark, sf):
    """Whole messages, line feeds and quotes included, written as CSV and read back."""
    path = f"{Staging(spark).path}/raw"
    documents = v.table(spark, sf, "documents")
    raw = documents.select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("text").alias("message"),
        F.col("source").alias("sign"),
        F.lit("2024-01-01").alias("datetime"),
    )
    raw.write.option("header", True).option("escape", '"').option("quoteAll", True).csv(path)
    back = message_files.read_messages_csv(spark, path)
    return back.select("id", F.md5("message").alias("digest"), "sign", "datetime")


def _long(features: DataFrame) -> DataFrame:
    """Every feature of every user as a row of its own."""
    single = [c for c, t in features.dtypes if c != "id" and not t.startswith("array")]
    arrays = [c for c, t in features.dtypes if t.startswith("array")]
    value = lambda x: x.cast("double").alias("value")

    def slots(name: str) -> Column:
        return F.transform(name, lambda x, i: F.struct(F.lit(name).alias("name"), i.alias("pos"), value(x)))

    parts = F.flatten(
        F.array(
            F.array(*[F.struct(F.lit(c).alias("name"), F.lit(0).alias("pos"), value(F.col(c))) for c in single]),
            *map(slots, arrays),
        )
    )
    return rounded(features.select("id", F.inline(parts)))


@query
def feature_join(spark, sf):
    """Two pooled vectors joined with statistics, sequences and labels: one row per user, every value shown."""
    staging = Staging(spark)
    rows = staging.write(v.ordered_messages(spark, sf), "messages")
    vectors_of = staging.write(v.message_vectors(spark, sf), "vectors")
    pooled = embeddings.pool_embeddings(vectors_of, "mean")
    static = embeddings.pool_embeddings(vectors_of, "max").withColumnRenamed("embedding", "static_vec")
    stats = statistics.all_statistics(rows, v.KEYWORDS, "cn", as_of(), staging)
    vocabulary = sequences.fit_sign_vocabulary(rows, staging)
    sequence = sequences.sign_sequences(rows, vocabulary, 50)
    return _long(labels.join_labels(plans.assemble(static, stats, sequence, pooled, 50), rows))


def bench_config(static_vec: str) -> PipelineConfig:
    return PipelineConfig(
        filter_setting=v.SETTING,
        keywords=v.KEYWORDS,
        stopwords=tuple(v.STOPWORDS),
        static_vec=static_vec,
        word2vec={"vector_size": 32, "window": 5, "min_count": 2, "epochs": 1},
        as_of=v.AS_OF,
    )


@query
def user_features_tfidf(spark, sf):
    """Raw labelled messages to feature rows: the filter, all statistics, TF-IDF, pooled message vectors of a
    registered encoder, sequences and labels, every value a row."""
    embeddings.register_encoder("letter-counts", _letter_counts)
    config = bench_config("tf-idf")
    config.dynamic_vec = "letter-counts"
    return _long(plans.preprocess(v.messages(spark, sf), config, Staging(spark))[1])


@query
def user_features_word2vec(spark, sf):
    """Trained on the labelled messages, applied to the same messages without labels."""
    raw, config, staging = v.messages(spark, sf), bench_config("word2vec"), Staging(spark)
    models, _ = plans.preprocess(raw, config, staging)
    found = plans.preprocess(raw.drop("label"), config, staging, models)[1]
    sizes = [F.size(c).alias(f"{c}_size") for c in ("static_vec", "embedding", "sign_id_seq")]
    return rounded(found.select("id", *sizes, "message_count", "hour_mean", "message_length_mean"))


@query
def features_csv_round_trip(spark, sf):
    """Feature rows as flat CSV and back."""
    staging = Staging(spark)
    rows = v.ordered_headers(spark, sf)
    vocabulary = sequences.fit_sign_vocabulary(rows, staging)
    features = statistics.sign_features(rows).join(sequences.sign_sequences(rows, vocabulary, 50), "id")
    feature_files.write_features_csv(features, f"{staging.path}/flat", {"sign_id_seq": 50})
    back = feature_files.read_features_csv(spark, f"{staging.path}/flat")
    counts = [F.col(c).cast("bigint").alias(c) for c in ("unique_signs", "total_messages")]
    return rounded(
        back.select("id", *counts, "sign_diversity_ratio", "dominant_sign_ratio", F.posexplode("sign_id_seq").alias("pos", "sign_id"))
    )


def _sign_features(spark: SparkSession, sf: str) -> tuple[DataFrame, sequences.SignEmbedding]:
    staging = Staging(spark)
    rows = v.ordered_headers(spark, sf)
    vocabulary = sequences.fit_sign_vocabulary(rows, staging)
    stats = statistics.user_statistics(rows.where(F.col("ts").isNotNull()), (statistics.TIME, statistics.SIGN))
    joined = stats.join(sequences.sign_sequences(rows, vocabulary, 50), "id")
    features = staging.write(labels.join_labels(joined, rows), "features")
    return features, sequences.fit_sign_embedding(features, staging, size=8)


@query
def sign_embedding(spark, sf):
    """Users with a pooled signature vector, and its length."""
    features, signs = _sign_features(spark, sf)
    return sequences.embed_sequences(features, signs).select("id", F.size("sign_vec").alias("size"))


@query
def sign_gradient(spark, sf):
    """How the loss of a given unit on given signature vectors changes with each signature."""
    staging = Staging(spark)
    rows = v.ordered_headers(spark, sf)
    vocabulary = sequences.fit_sign_vocabulary(rows, staging)
    features = labels.join_labels(sequences.sign_sequences(rows, vocabulary, 50), rows)
    slots = staging.write(signlearn.user_slots(features), "slots")
    name = F.concat(F.lit("sign "), F.col("sign_id").cast("string"))
    given = F.array(*[v.md5_number(name, 1 + 8 * i) % 1000 / F.lit(1000.0) for i in range(4)])
    table = slots.where("sign_id is not null").select("sign_id").distinct().select("sign_id", given.alias("v"))
    judged = signlearn.errors(slots, table, signlearn.Unit(np.array([0.5, -0.25, 0.75, 1.0]), 0.1))
    return signlearn.sign_gradients(slots, judged).select("sign_id", F.round("g", 9).alias("g"))


@query
def train_score(spark, sf):
    """Trained on labelled messages with every feature family, saved, loaded, and applied to the messages without
    their labels: a score between 0 and 1 for every user."""
    raw, config, staging = v.messages(spark, sf), bench_config("tf-idf"), Staging(spark)
    out = f"{staging.path}-outcome"
    outcome = training.train(raw, config, staging, sign_vector_size=8, rounds=2, iterations=10)
    outcome.save(spark, out)
    staging.drop()  # scoring has the saved files only
    loaded = training.Outcome.load(spark, out)
    scores = training.predict(raw.drop("label"), loaded, config, Staging(spark))
    return scores.select("id", F.col("score").between(0, 1).alias("valid"))
