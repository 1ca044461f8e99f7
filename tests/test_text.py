from pyspark.sql import functions as F

from twinscope.functions import text
from twinscope.operators.lemma import ENDINGS, lemma_table, lemmatise


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "t string").select(expr(F.col("t")).alias("r")).first()["r"]


def test_replacement_order(spark):
    cases = {
        "i'm sure it's $5,000,000": "i am sure it is  dollar 5m",
        "7,000 won't cannot can't don't": "7k will not can not can not do not",
        "you’re 5 % off": "you are 5  percent  off",
        "she's what's he's they've bob′s": "she is what is he is they have bob own",
        "₹100 €200 we'll": " rupee 100  euro 200 we will",
        "the apache's rule": "the apache is rule",
    }
    for raw, want in cases.items():
        assert one(spark, raw, text.replace_words) == want


def test_punctuation_is_unicode_aware(spark):
    assert one(spark, "a/b (c) snake_case café ñandú—день!", text.strip_punctuation) == "ab c snake_case café ñandúдень"


def test_normalise_matches_python_split(spark):
    raw = "One two three\x0bfour\t five\n"
    assert one(spark, raw, text.normalise) == " ".join(raw.lower().split())
    assert one(spark, None, text.normalise) == ""
    assert one(spark, "…", text.normalise) == ""


def test_splits(spark):
    assert one(spark, "", text.space_tokens) == [""]
    assert one(spark, "", text.words) == []
    assert one(spark, " a  b ", text.words) == ["a", "b"]
    assert one(spark, "It's a-b_c, D!", text.word_sequence) == ["it's", "a", "b", "c", "d"]


def test_stop_words(spark):
    assert one(spark, "the cat and the hat", lambda c: text.remove_stop_words(c, ["the", "and"])) == "cat hat"


def test_readability(spark):
    assert one(spark, "", text.readability) == 0.0
    # 3 words; make: 1, the: 1 (no vowel left), banana: 3
    got = one(spark, "make the banana", text.readability)
    assert abs(got - (206.835 - 1.015 * 3 - 84.6 * 5 / 3)) < 1e-9


def test_lemmas(spark):
    words = ["dog", "bus", "wolf", "box", "waltz", "church", "dish", "man", "city", "a", "go", "goose"]
    lexicon = spark.createDataFrame([(w,) for w in words], "word string")
    exceptions = spark.createDataFrame([("geese", "goose"), ("men", "man")], "word string, lemma string")
    raw = "dogs buses wolves boxes waltzes churches dishes men cities as geese cats dog"
    df = spark.createDataFrame([(1, raw), (2, ""), (3, "none here")], "id long, t string")
    out = {r["id"]: r["t"] for r in lemmatise(df, "id", ["t"], lemma_table(lexicon, exceptions)).collect()}
    assert out == {1: "dog bus wolf box waltz church dish man city a goose cats dog", 2: "", 3: "none here"}
    plain = {r["word"]: r["lemma"] for r in lemma_table(lexicon).collect()}
    assert plain["men"] == "man" and "geese" not in plain


def test_lemmas_by_ending_are_all_lemmas(spark):
    words = ["glass", "glas", "woman", "women", "knife", "knives", "knif", "boxes", "box", "fly", "flies", "church", "churches", "s", "men"]
    table = lemma_table(spark.createDataFrame([(w,) for w in words], "word string"))
    df = spark.createDataFrame([(1, " ".join(words)), (2, ""), (3, None), (4, "flies flies")], "id long, t string")
    whole, by_ending = (sorted(lemmatise(df, "id", ["t"], table, e).collect()) for e in (None, ENDINGS))
    assert whole == by_ending and by_ending[3]["t"] == "fly fly"
