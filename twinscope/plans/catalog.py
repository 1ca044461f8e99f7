"""The registered queries: one per operator, over whole tables and whole texts."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinscope.functions import text
from twinscope.operators import corpus, evaluate, features, joins, prepare, profile, resume, sampling, tfidf
from twinscope.operators.lemma import ENDINGS, lemma_table, lemmatise
from twinscope.plans import bayes, forest, models, nets, scoring
from twinscope.sources import pairs as io
from twinscope.sources import tables
from twinscope.sources.scratch import ensure_checkpoint_dir, scratch_path, written
from twinscope.streaming import scoring as stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SEED = 99
DIM = 64
Q1, Q2 = "question1", "question2"
# Every contraction and symbol that the replacement rules know.
REPLACEMENT_PROBE = (
    " i'm sure it's $5,000,000 or 7,000 won't cannot can't don't you’re 5 % off"
    " she's what's he's they've bob′s ₹100 €200 we'll a/b (c) snake_case"
)
# Frequent short words of the texts' four languages.
STOP_WORDS = ["the", "and", "of", "to", "in", "is", "der", "die", "und", "la", "le", "et", "que", "de", "el", "los"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def r6(c: Column | str) -> Column:
    """Rounded to six places (huge values as they are), NaN as -1."""
    c = F.col(c) if isinstance(c, str) else c
    c = c.cast("double")
    return (
        F.when(F.isnan(c), F.lit(-1.0))
        .when(F.abs(c) >= 1e9, c)
        .otherwise(F.floor(c * 1e6 + 0.5).cast("double") / 1e6)
    )


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: r6(c) for c in columns})


def doc_texts(spark: SparkSession, d: str) -> DataFrame:
    return tables.text_table(spark, d, "documents").select("doc_id", "text")


def lemmas(spark: SparkSession, d: str) -> DataFrame:
    return tables.kept_table(spark, d, "lemmas", ["documents"], lambda: lemma_table(tables.lexicon(spark, d)))


def cleaned_docs(spark: SparkSession, d: str) -> DataFrame:
    """``(key, text)``: every document cleaned and lemmatised once, however many pairs and queries it is in."""

    def build() -> DataFrame:
        return lemmatise(tables.normalised_documents(spark, d), "key", ["text"], lemmas(spark, d), ENDINGS)

    return tables.kept_table(spark, d, "cleaned-documents", ["documents"], build)


def cleaned_messages(spark: SparkSession, d: str) -> DataFrame:
    """``(key, text)`` of every message, as ``cleaned_docs``."""

    def build() -> DataFrame:
        messages = tables.messages(spark, d).where(F.col("text").isNotNull()).select("key", text.normalise(F.col("text")).alias("text"))
        return lemmatise(messages, "key", ["text"], lemmas(spark, d), ENDINGS)

    return tables.kept_table(spark, d, "cleaned-messages", ["documents", "conversations"], build)


def clean_docs(spark: SparkSession, d: str) -> DataFrame:
    return tables.with_texts(tables.document_links(spark, d), cleaned_docs(spark, d))


def clean_turns(spark: SparkSession, d: str) -> DataFrame:
    return tables.with_texts(tables.turn_links(spark, d), cleaned_messages(spark, d))


def clean_next(spark: SparkSession, d: str, drop_nulls: bool = True) -> DataFrame:
    """Batch work drops pairs with a missing text; scoring keeps it as empty."""
    how = "inner" if drop_nulls else "left"
    pairs = tables.with_open_texts(tables.open_links(spark, d), cleaned_messages(spark, d), how)
    return pairs if drop_nulls else pairs.na.fill("", [Q1, Q2])


def without_text(df: DataFrame) -> DataFrame:
    return df.select("id", "qid1", "qid2", "is_duplicate")


#: The features that are no whole numbers.
REAL_FEATURES = ["word_share", *features.bags.DISTANCES, "q1_readability_score", "q2_readability_score"]


# --- sources and sinks ------------------------------------------------------------


@query
def scan_pairs_csv(spark, d):
    path = scratch_path(spark, "pairs-csv")
    io.write_pairs_csv(tables.open_pairs(spark, d).select(*io.PAIR_SCHEMA.names), path)
    return io.read_pairs_csv(spark, path)


@query
def feature_store_roundtrip(spark, d):
    path = scratch_path(spark, "features")
    full = features.pair_features(clean_turns(spark, d), Q1, Q2)
    io.write_features(full.select("id", "is_duplicate", *features.FEATURES), path)
    return rounded(io.read_features(spark, path), *REAL_FEATURES)


@query
def scan_word_vectors(spark, d):
    path = scratch_path(spark, "vectors")
    store = tables.table(spark, d, "embeddings").select(
        F.concat(F.lit("w"), F.col("vec_id").cast("string")).alias("word"), F.col("embedding").alias("vector")
    )
    io.write_word_vectors(store, path)
    total = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x)
    return io.read_word_vectors(spark, path).select(
        "word",
        F.size("vector").cast("long").alias("dim"),
        r6(F.col("vector")[0]).alias("first_value"),
        r6(total).alias("total"),
    )


@query
def word_vector_count(spark, d):
    path = scratch_path(spark, "vectors")
    store = tables.table(spark, d, "embeddings").select(
        F.concat(F.lit("w"), F.col("vec_id").cast("string")).alias("word"), F.col("embedding").alias("vector")
    )
    io.write_word_vectors(store, path)
    return io.read_word_vectors(spark, path).agg(F.count(F.lit(1)).alias("n_vectors"))


# --- profiling --------------------------------------------------------------------


@query
def profile_row_count(spark, d):
    return profile.row_count(tables.document_links(spark, d))


@query
def profile_head(spark, d):
    first = profile.head(tables.document_links(spark, d), "id")
    return tables.with_texts(first, tables.documents_by_key(spark, d))


@query
def profile_info(spark, d):
    return profile.info(tables.open_pairs(spark, d))


@query
def null_question_rows(spark, d):
    return profile.null_rows(tables.open_pairs(spark, d), [Q1, Q2])


@query
def qid_lookup(spark, d):
    return profile.key_lookup(tables.open_pairs(spark, d), 4, ["qid1", "qid2"])


@query
def drop_null_pairs(spark, d):
    return without_text(profile.drop_null_rows(tables.open_pairs(spark, d), [Q1, Q2]))


@query
def null_check_after_drop(spark, d):
    kept = profile.drop_null_rows(tables.open_pairs(spark, d), [Q1, Q2])
    return profile.row_count(profile.null_rows(kept, [Q1, Q2]))


@query
def identical_pairs(spark, d):
    return without_text(profile.identical_pairs(tables.document_pairs(spark, d), Q1, Q2))


@query
def repeated_pairs(spark, d):
    return profile.repeated_pairs(tables.document_links(spark, d), "qid1", "qid2")


@query
def mirrored_pairs(spark, d):
    return profile.mirrored_pairs(tables.document_links(spark, d), "id", "qid1", "qid2")


@query
def distinct_qids(spark, d):
    return profile.distinct_counts(tables.document_links(spark, d), ["qid1", "qid2"])


@query
def distinct_qids_sketched(spark, d):
    """Estimated distinct counts from sketches saved by batch and merged."""
    path = scratch_path(spark, "sketches")
    links = tables.document_links(spark, d)
    for k in range(4):
        batch = links.where(F.pmod(F.col("id"), F.lit(4)) == k)
        profile.distinct_sketches(batch, ["qid1", "qid2"]).write.parquet(f"{path}/batch={k}")
    return profile.sketched_counts(profile.merged_sketches(spark.read.parquet(path)))


@query
def label_counts(spark, d):
    return profile.label_counts(tables.document_links(spark, d), "is_duplicate", "id")


@query
def question_length_stats(spark, d):
    return rounded(profile.length_stats(tables.document_pairs(spark, d), [Q1, Q2]), "mean_words", "median_words")


@query
def class_balance(spark, d):
    return rounded(profile.class_balance(tables.document_links(spark, d), "is_duplicate"), "pct_duplicate", "pct_not_duplicate")


@query
def balanced_sample(spark, d):
    pairs = tables.document_links(spark, d)
    return sampling.sample_per_class(pairs, "is_duplicate", "id", {0: 100, 1: 100}, SEED)


@query
def stratified_sample(spark, d):
    pairs = tables.document_links(spark, d)
    return sampling.sample_per_class(pairs, "is_duplicate", "id", {0: 70, 1: 140}, SEED)


@query
def fraction_sample(spark, d):
    return without_text(sampling.fraction_sample(tables.document_links(spark, d), 0.01, SEED))


@query
def hash_fraction_sample(spark, d):
    return without_text(sampling.hash_fraction_sample(tables.document_links(spark, d), "id", 1, SEED))


@query
def drop_incomplete_features(spark, d):
    kept_empty = clean_next(spark, d, drop_nulls=False)
    full = features.with_distances(kept_empty, Q1, Q2).select("id", "cosine_distance", "cityblock_distance")
    return rounded(profile.drop_incomplete(full), "cosine_distance", "cityblock_distance")


@query
def feature_matrix(spark, d):
    out = profile.project(turn_features(spark, d), ["id", "is_duplicate", *features.FEATURES])
    return rounded(out, *REAL_FEATURES)


@query
def label_preview(spark, d):
    first = profile.label_preview(tables.document_links(spark, d), "is_duplicate", 1, "id")
    return tables.with_texts(first, tables.documents_by_key(spark, d))


@query
def label_values(spark, d):
    return profile.label_values(tables.document_links(spark, d), "is_duplicate")


# --- text normalisation -----------------------------------------------------------


@query
def norm_lower(spark, d):
    return doc_texts(spark, d).select("doc_id", F.lower("text").alias("text"))


@query
def norm_replace(spark, d):
    probed = F.concat(F.lower("text"), F.lit(REPLACEMENT_PROBE))
    return doc_texts(spark, d).select("doc_id", text.replace_words(probed).alias("text"))


@query
def norm_punct(spark, d):
    return doc_texts(spark, d).select("doc_id", text.strip_punctuation("text").alias("text"))


@query
def norm_lemma(spark, d):
    docs = doc_texts(spark, d).select("doc_id", text.normalise("text").alias("text"))
    return lemmatise(docs, "doc_id", ["text"], lemmas(spark, d), ENDINGS)


@query
def clean_pairs(spark, d):
    out = clean_turns(spark, d)
    return out.select("id", Q1, Q2)


@query
def norm_stopwords(spark, d):
    return doc_texts(spark, d).select(
        "doc_id", text.remove_stop_words(text.normalise("text"), STOP_WORDS).alias("text")
    )


@query
def word_sequence(spark, d):
    words = text.word_sequence("text")
    return doc_texts(spark, d).select("doc_id", F.array_join(words, " ").alias("words"), F.size(words).cast("long").alias("n"))


# --- pair features ----------------------------------------------------------------


def _overlap(name: str) -> None:
    def run(spark, d):
        out = features.with_word_overlap(clean_docs(spark, d), Q1, Q2)
        value = r6(name) if name == "word_share" else F.col(name)
        return out.select("id", value.alias(name))

    QUERIES[f"feat_{name.removesuffix('_q1_q2')}"] = run


for _name in ("words_diff_q1_q2", "word_common", "word_total", "word_share"):
    _overlap(_name)


@query
def feat_pair_vectors(spark, d):
    out = features.with_vectors(clean_docs(spark, d), Q1, Q2)
    return out.select("id", F.array_join("vec1", " ").alias("vec1"), F.array_join("vec2", " ").alias("vec2"))


def _distance(name: str) -> None:
    def run(spark, d):
        return features.with_distances(clean_docs(spark, d), Q1, Q2).select("id", r6(name).alias(name))

    QUERIES[f"feat_{name.removesuffix('_distance')}"] = run


for _name in ("cosine", "cityblock", "jaccard", "canberra", "euclidean", "braycurtis"):
    _distance(f"{_name}_distance")


@query
def feat_minkowski(spark, d):
    out = features.with_minkowski(clean_docs(spark, d), Q1, Q2, 3.0)
    return out.select("id", r6("minkowski_distance").alias("minkowski_distance"))


def _fuzzy(key: str, column: str) -> None:
    def run(spark, d):
        return features.fuzzy.with_fuzzy_scores(clean_next(spark, d), Q1, Q2, [column]).select("id", column)

    QUERIES[key] = run


for _key, _name in {
    "feat_qratio": "fuzz_qratio",
    "feat_wratio": "fuzz_WRatio",
    "feat_partial_ratio": "fuzz_partial_ratio",
    "feat_partial_token_set": "fuzz_partial_token_set_ratio",
    "feat_partial_token_sort": "fuzz_partial_token_sort_ratio",
    "feat_token_set": "fuzz_token_set_ratio",
    "feat_token_sort": "fuzz_token_sort_ratio",
}.items():
    _fuzzy(_key, _name)


@query
def feat_bigrams(spark, d):
    return features.with_ngrams(clean_docs(spark, d), Q1, Q2, 2, "common_bigrams").select("id", "common_bigrams")


@query
def feat_trigrams(spark, d):
    return features.with_ngrams(clean_docs(spark, d), Q1, Q2, 3, "common_trigrams").select("id", "common_trigrams")


@query
def feat_readability(spark, d):
    out = features.with_readability(clean_docs(spark, d), Q1, Q2)
    return rounded(out.select("id", "q1_readability_score", "q2_readability_score"), "q1_readability_score", "q2_readability_score")


@query
def tfidf_cosine(spark, d):
    return rounded(features.with_tfidf_cosine(clean_docs(spark, d), Q1, Q2).select("id", "tfidf_cosine"), "tfidf_cosine")


@query
def corpus_tfidf_cosine(spark, d):
    """Cosine of two documents' TF-IDF vectors over the whole corpus."""
    vectors = written(tfidf.sparse_vectors(cleaned_docs(spark, d), "key", "text"), "vectors")
    cosines = tfidf.pair_cosines(tables.document_links(spark, d), vectors, "key", "id", "qid1", "qid2")
    return rounded(cosines, "cosine")


@query
def pair_features(spark, d):
    """Full cleaning and all row-local features of adjacent messages."""
    cleaned = clean_next(spark, d)
    out = features.pair_features(cleaned, Q1, Q2).select("id", "is_duplicate", *features.FEATURES)
    return rounded(out, *REAL_FEATURES)


@query
def pair_features_documents(spark, d):
    """The same features on whole documents; too many characters for the SQL check."""
    out = features.pair_features(clean_docs(spark, d), Q1, Q2).select("id", "is_duplicate", *features.FEATURES)
    return rounded(out, *REAL_FEATURES)


# --- questions, words, vectors ----------------------------------------------------


def turn_questions(spark: SparkSession, d: str) -> DataFrame:
    return joins.unique_questions(tables.turn_pairs(spark, d), "id", [("qid1", Q1), ("qid2", Q2)])


def cleaned_questions(spark: SparkSession, d: str) -> DataFrame:
    return joins.unique_questions(clean_turns(spark, d), "id", [("qid1", Q1), ("qid2", Q2)])


def turn_corpus(spark: SparkSession, d: str) -> DataFrame:
    """``(id, doc)``: both cleaned sides of every turn pair."""
    return clean_turns(spark, d).select("id", "is_duplicate", corpus.combined(F.col(Q1), F.col(Q2)).alias("doc"))


def turn_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    return tables.kept_table(
        spark, d, "vocabulary", ["documents", "conversations"], lambda: corpus.vocabulary_index(turn_corpus(spark, d), "id", "doc")
    )


def word_vectors(spark: SparkSession, d: str) -> DataFrame:
    """The most frequent words, in order, take the given vectors."""
    store = tables.table(spark, d, "embeddings").select((F.col("vec_id") + 1).alias("idx"), F.col("embedding").alias("vector"))
    return turn_vocabulary(spark, d).join(store, "idx").select("word", "idx", "freq", "vector")


@query
def unique_questions(spark, d):
    return turn_questions(spark, d)


@query
def in_vocab_tokens(spark, d):
    return joins.in_vocabulary(cleaned_questions(spark, d), "qid", "question", word_vectors(spark, d))


@query
def incremental_questions(spark, d):
    """Questions left to do after those of the pairs from one role were saved."""
    path = scratch_path(spark, "done-questions")
    done = tables.turn_pairs(spark, d).where(F.col("is_duplicate") == 1)
    joins.unique_questions(done, "id", [("qid1", Q1), ("qid2", Q2)]).write.parquet(path)
    return joins.pending(turn_questions(spark, d), spark.read.parquet(path), "qid")


@query
def resumed_questions(spark, d):
    """Words of all questions, done in chunks that are committed one by one; a first run ended
    after two chunks, a second one does the rest."""
    # Every chunk reads the table, so it is written first.
    source = scratch_path(spark, "questions")
    turn_questions(spark, d).write.parquet(source)
    questions = spark.read.parquet(source)
    work = resume.ChunkedWork(spark, scratch_path(spark, "chunks"), questions, "qid", chunks=8)

    def count_words(chunk: DataFrame) -> DataFrame:
        return chunk.select("qid", F.size(text.word_sequence(F.col("question"))).cast("long").alias("n_words"))

    work.run(count_words, at_most=2)
    work.run(count_words)
    return work.results()


@query
def embedding_lookup(spark, d):
    vocabulary = turn_vocabulary(spark, d)
    found = joins.embedding_lookup(vocabulary, word_vectors(spark, d), DIM)
    total = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x)
    return found.select(
        "idx", "word", F.size("vector").cast("long").alias("dim"), r6(F.col("vector")[0]).alias("first_value"), r6(total).alias("total")
    )


def nearest_words(spark: SparkSession, d: str) -> DataFrame:
    vectors = word_vectors(spark, d)
    queries = joins.query_vectors(cleaned_questions(spark, d), "qid", "question", vectors)
    return joins.nearest_word(queries, vectors, "qid")


@query
def nearest_word(spark, d):
    return rounded(nearest_words(spark, d).select("qid", "similarity"), "similarity")


@query
def feat_word2vec_diff(spark, d):
    pairs = tables.turn_links(spark, d).select("id", "qid1", "qid2")
    out = joins.similarity_gap(pairs, nearest_words(spark, d), "qid1", "qid2")
    return rounded(out.select("id", "word_2_vec_diff"), "word_2_vec_diff")


@query
def combined_text(spark, d):
    return turn_corpus(spark, d).select("id", "doc")


@query
def vocabulary_index(spark, d):
    return turn_vocabulary(spark, d)


def encoded_turns(spark: SparkSession, d: str) -> DataFrame:
    return corpus.encode(turn_corpus(spark, d), "id", "doc", turn_vocabulary(spark, d))


@query
def encode_docs(spark, d):
    return encoded_turns(spark, d).select("id", F.array_join("seq", " ").alias("seq"))


@query
def max_doc_length(spark, d):
    return corpus.max_length(turn_corpus(spark, d), "doc")


def padded_turns(spark: SparkSession, d: str) -> tuple[DataFrame, int]:
    length = corpus.max_length(turn_corpus(spark, d), "doc").first()["max_length"]
    return encoded_turns(spark, d).select("id", corpus.padded(F.col("seq"), length).alias("seq")), length


@query
def padded_docs(spark, d):
    padded, _ = padded_turns(spark, d)
    return padded.select("id", F.array_join("seq", " ").alias("seq"), F.size("seq").cast("long").alias("n"))


# --- preparation ------------------------------------------------------------------

OVERLAP = ["words_diff_q1_q2", "word_common", "word_total", "word_share"]


def overlap_table(spark: SparkSession, d: str) -> DataFrame:
    return features.with_word_overlap(clean_docs(spark, d), Q1, Q2).select("id", "is_duplicate", *OVERLAP)


@query
def train_test_split(spark, d):
    return sampling.with_split(tables.document_links(spark, d), "id", SEED).select("id", "split")


@query
def stratified_folds(spark, d):
    pairs = tables.document_links(spark, d)
    return sampling.with_folds(pairs, "is_duplicate", "id", 5, SEED).select("id", "is_duplicate", "fold")


@query
def standardize(spark, d):
    df = sampling.with_split(turn_features(spark, d), "id", SEED)
    fitted = prepare.Standardizer.fit(df.where(F.col("split") == "train"), features.FEATURES)
    return rounded(fitted.transform(df).select("id", *features.FEATURES), *features.FEATURES)


@query
def nan_to_num(spark, d):
    kept_empty = clean_next(spark, d, drop_nulls=False)
    df = features.with_distances(features.with_word_overlap(kept_empty, Q1, Q2), Q1, Q2)
    odd = F.when(F.col("word_common") == 0, F.lit(float("inf"))).otherwise(F.col("word_share"))
    out = df.select("id", F.col("cosine_distance"), odd.alias("above"), (-odd).alias("below"))
    return rounded(prepare.repair(out, ["cosine_distance", "above", "below"]), "cosine_distance", "above", "below")


# --- evaluation of a fixed score --------------------------------------------------


def scored_overlap(spark: SparkSession, d: str) -> DataFrame:
    return overlap_table(spark, d).select(
        "is_duplicate", "word_share", (F.col("word_share") >= 0.25).cast("int").alias("predicted")
    )


@query
def eval_accuracy(spark, d):
    return rounded(evaluate.accuracy(scored_overlap(spark, d), "is_duplicate", "predicted"), "accuracy")


@query
def eval_report(spark, d):
    return rounded(evaluate.report(scored_overlap(spark, d), "is_duplicate", "predicted"), "precision", "recall", "f1")


@query
def eval_confusion(spark, d):
    return evaluate.confusion(scored_overlap(spark, d), "is_duplicate", "predicted")


@query
def eval_rates(spark, d):
    out = evaluate.rates(scored_overlap(spark, d), "is_duplicate", "predicted")
    return rounded(out, *out.columns)


@query
def eval_roc(spark, d):
    return rounded(evaluate.roc_points(scored_overlap(spark, d), "is_duplicate", "word_share"), "threshold", "tpr", "fpr")


@query
def eval_auc(spark, d):
    return rounded(evaluate.auc(scored_overlap(spark, d), "is_duplicate", "word_share"), "auc")


# --- models -----------------------------------------------------------------------

#: Epochs of the nets on features, and of those on words.
EPOCHS, WORD_EPOCHS = 100, 50


def turn_features(spark: SparkSession, d: str) -> DataFrame:
    """The feature table of the turn pairs, written once and read back."""

    def build() -> DataFrame:
        return features.pair_features(clean_turns(spark, d), Q1, Q2).select("id", "is_duplicate", *features.FEATURES)

    return tables.kept_table(spark, d, "turn-features", ["documents", "conversations"], build)


def turn_training(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return models.training_tables(turn_features(spark, d), features.FEATURES, "is_duplicate", "id", SEED)


def _model(name: str, fit: Callable[[DataFrame], object]) -> None:
    def run(spark, d):
        train, test = turn_training(spark, d)
        return models.scored(fit(train), test)

    QUERIES[name] = run


_model("model_logreg", lambda train: models.logistic(train.count()).fit(train))
_model("model_logreg_l1", lambda train: models.fit_penalised(train, l1=True))
_model("model_logreg_l2", lambda train: models.fit_penalised(train, l1=False))
_model("model_linear_svm", models.fit_linear_svm)
_model("model_decision_tree", lambda train: models.decision_tree().fit(train))
_model("model_random_forest", lambda train: forest.fit(train, trees=300))


def turn_shards(spark: SparkSession, d: str, folds: int) -> nets.Shards:
    """Standardised features of the turn pairs for the trainer of nets; the held-out part validates."""
    train, test = turn_training(spark, d)
    data = models.folded(train, folds) if folds else train.withColumn("fold", F.lit(-1))
    parts = data.withColumn("held", F.lit(False)), test.withColumns({"fold": F.lit(-1), "held": F.lit(True)})
    columns = ["id", "label", "features", "fold", "held"]
    return nets.feature_shards(parts[0].select(*columns).unionByName(parts[1].select(*columns)), folds, SEED)


def _net(name: str, hidden: tuple[int, ...]) -> None:
    def run(spark, d):
        shards = turn_shards(spark, d, 0)
        return nets.predictions(shards, nets.fit(shards, nets.Net(hidden, "relu", "adam"), EPOCHS))

    QUERIES[f"model_{name}"] = run


for _name, _hidden in models.NETS.items():
    _net(_name, _hidden)


def _valid(name: str) -> None:
    """One row per held-out pair: the probability is one, and the prediction agrees with it."""

    def run(spark, d):
        p = F.col("probability")
        agrees = F.col("prediction") == (p > 0.5).cast("int")
        return QUERIES[name](spark, d).select("id", (p.between(0, 1) & (agrees | (p == 0.5))).alias("valid"))

    QUERIES[f"{name}_valid"] = run


for _fitted in ("model_logreg", "model_decision_tree", "model_mlp_2"):
    _valid(_fitted)


@query
def model_bernoulli_nb(spark, d):
    """Joint log-probabilities of both classes on the held-out part."""
    train, test = turn_training(spark, d)
    out = models.bernoulli_bayes().fit(train).transform(test)
    raw = models.vector_to_array("rawPrediction")
    return out.select("id", r6(raw[0]).alias("log_joint_0"), r6(raw[1]).alias("log_joint_1"))


@query
def model_bayes_batches(spark, d):
    """Joint log-probabilities as in ``model_bernoulli_nb``, by counts of batches that came one
    after the other; the second came twice and counts once."""
    train, test = turn_training(spark, d)
    store = bayes.CountStore(spark, scratch_path(spark, "bayes"))
    batches = [train.where(F.pmod(F.xxhash64("id"), F.lit(3)) == k) for k in range(3)]
    for number in (0, 1, 1, 2):
        store.add(batches[number], f"part-{number}")
    out = store.score(test)
    return out.select("id", r6("log_joint_0").alias("log_joint_0"), r6("log_joint_1").alias("log_joint_1"))


@query
def cv_mlp(spark, d):
    shards = turn_shards(spark, d, 5)
    fits = nets.fit_all(shards, [nets.Net(hidden, "relu", "adam") for hidden in models.NETS.values()], EPOCHS)
    return nets.cv_table(spark, fits, [EPOCHS], ["hidden"])


@query
def sweep_mlp_iters(spark, d):
    """Epochs by rows of a mini-batch; the shorter runs are stages of the longer ones."""
    shards = turn_shards(spark, d, 5)
    fits = nets.fit_all(shards, [nets.Net(models.NETS["mlp_2"], "relu", "adam", batch=n) for n in (10, 20)], 200)
    return nets.cv_table(spark, fits, [100, 200], ["batch"])


@query
def sweep_mlp_solver(spark, d):
    """Optimiser by activation."""
    shards = turn_shards(spark, d, 5)
    grid = [nets.Net(models.NETS["mlp_2"], a, o) for o in ("rmsprop", "adam", "sgd") for a in ("relu", "tanh")]
    return nets.cv_table(spark, nets.fit_all(shards, grid, EPOCHS), [EPOCHS], ["optimiser", "activation"])


@query
def grid_mlp(spark, d):
    """L2 penalty by epochs, from the weakest penalty to the strongest; each begins where the
    one before ended."""
    shards = turn_shards(spark, d, 5)
    path = nets.penalty_path(nets.Net(models.NETS["mlp_2"], "relu", "sgd"), l2=[0.01, 0.5, 1.0])
    return nets.cv_table(spark, nets.fit_path(shards, path, 100), [50, 100], ["l2"])


@query
def path_mlp_l1(spark, d):
    """L1 penalties of the net of hyperbolic tangents, as ``grid_mlp``."""
    shards = turn_shards(spark, d, 5)
    path = nets.penalty_path(nets.Net(models.NETS["mlp_2"], "tanh", "sgd"), l1=[0.005, 0.01])
    return nets.cv_table(spark, nets.fit_path(shards, path, 100), [100], ["l1"])


@query
def grid_logreg(spark, d):
    train, _ = turn_training(spark, d)
    n = train.count()
    estimator = models.logistic(n)
    grid = models.penalised_grid(estimator, n, [0.5, 1.0, 2.0], [True, False])
    fitted = models.searched(estimator, grid, models.folded(train, 5), 5)
    return models.cv_summary(train, fitted, grid)


@query
def training_history(spark, d):
    """Best accuracy and lowest loss of a net over its epochs, on training and held-out rows."""
    shards = turn_shards(spark, d, 0)
    return nets.best_of_history(spark, nets.fit(shards, nets.Net(models.NETS["mlp_2"], "tanh", "sgd"), EPOCHS))


@query
def model_text_embed(spark, d):
    """Classifiers on word embeddings in text order: none, one and two hidden layers.

    Each row has the model's mean accuracy over five folds of all rows; predictions for the
    test part are by the models fitted on the training part.
    """
    ensure_checkpoint_dir(spark)
    labels = models.folded(tables.turn_links(spark, d).select("id", F.col("is_duplicate").cast("double").alias("label")), 5, SEED)
    rows = encoded_turns(spark, d).join(sampling.with_split(labels, "id", SEED), "id").withColumn("held", F.col("split") == "test")
    shards = nets.word_shards(rows, word_vectors(spark, d), DIM, 5, SEED)
    grid = {"linear": (), "hidden_50": (50,), "hidden_50_25": (50, 25)}
    # The first layers are wide, so the driver holds one net at a time, and of it the states of only
    # so many folds' models as it takes to use all cores.
    together = max(1, spark.sparkContext.defaultParallelism // shards.workers)
    parts = []
    for name, hidden in grid.items():
        net = nets.Net(hidden, "tanh", "adam")
        fitted = nets.fit(shards, net, WORD_EPOCHS, meet=5, split=shards.folds + 1, together=together)
        accuracy = float(fitted.accuracies(WORD_EPOCHS).mean())
        parts.append(nets.predictions(shards, fitted).withColumns({"model": F.lit(name), "cv_accuracy": F.lit(accuracy)}))
    return reduce(DataFrame.unionByName, parts)


@query
def model_roundtrip(spark, d):
    """Predictions before and after saving the scorer."""
    table = turn_features(spark, d)
    model = scoring.fit_scorer(table, "is_duplicate")
    path = scratch_path(spark, "model")
    models.save_model(model, path)
    ready = prepare.repair(table, features.FEATURES)
    before = model.transform(ready).select("id", F.col("prediction").alias("before"))
    after = models.load_model(path).transform(ready).select("id", F.col("prediction").alias("after"))
    return before.join(after, "id").select("id", "before", "after", (F.col("before") == F.col("after")).alias("same"))


@query
def model_roundtrip_same(spark, d):
    return model_roundtrip(spark, d).select("id", "same")


@query
def score_batch(spark, d):
    model = scoring.fit_scorer(turn_features(spark, d), "is_duplicate")
    requests = tables.open_pairs(spark, d).select("id", Q1, Q2)
    return scoring.score_pairs(requests, model, lemmas=lemmas(spark, d))


@query
def score_stream(spark, d):
    """Overlap and distance features of requests that arrive as files."""
    source, sink, state = (scratch_path(spark, n) for n in ("requests", "features", "state"))
    tables.open_pairs(spark, d).select("id", Q1, Q2).write.parquet(source)

    known = lemmas(spark, d)

    def featurise(df: DataFrame) -> DataFrame:
        cleaned = features.clean_pairs(df, Q1, Q2, "id", known, drop_nulls=False)
        full = features.with_distances(features.with_word_overlap(cleaned, Q1, Q2), Q1, Q2)
        return full.select("id", "words_diff_q1_q2", "word_common", "word_total", "word_share", "cosine_distance", "cityblock_distance")

    stream.run_batches(stream.read_requests(spark, source), featurise, sink, state).awaitTermination()
    return rounded(spark.read.parquet(sink).drop("batch"), "word_share", "cosine_distance", "cityblock_distance")


@query
def score_stream_predictions(spark, d):
    """Batch-trained forest applied to a stream of requests."""
    source, sink, state = (scratch_path(spark, n) for n in ("requests", "scores", "state"))
    model = scoring.fit_scorer(turn_features(spark, d), "is_duplicate")
    tables.open_pairs(spark, d).select("id", Q1, Q2).write.parquet(source)
    requests = stream.read_requests(spark, source)
    known = lemmas(spark, d)
    stream.run_batches(requests, lambda df: scoring.score_pairs(df, model, lemmas=known), sink, state).awaitTermination()
    return spark.read.parquet(sink).drop("batch")
