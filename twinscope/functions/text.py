"""Text normalisation and token splits as Column -> Column functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Literal replacements, applied in this order.
REPLACEMENTS = [
    (",000,000", "m"),
    (",000", "k"),
    ("′", "'"),
    ("’", "'"),
    ("won't", "will not"),
    ("cannot", "can not"),
    ("can't", "can not"),
    ("n't", " not"),
    ("what's", "what is"),
    ("it's", "it is"),
    ("'ve", " have"),
    ("i'm", "i am"),
    ("'re", " are"),
    ("he's", "he is"),
    ("she's", "she is"),
    ("'s", " own"),
    ("%", " percent "),
    ("₹", " rupee "),
    ("$", " dollar "),
    ("€", " euro "),
    ("'ll", " will"),
]

# The characters a word-sequence tokenizer turns into spaces.
SEQUENCE_FILTERS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~\t\n"

# Every character Python's ``str.split()`` treats as white space. Java's ``\s``
# is ASCII only, so the others are spelled out.
_SPACE_CLASS = r"\s\x0b\x1c-\x1f\x85\p{Z}"
WHITESPACE = f"[{_SPACE_CLASS}]+"

# Unicode "not a word character and not white space"; Java's ``\w`` is ASCII only.
PUNCTUATION = rf"[^\p{{L}}\p{{N}}_{_SPACE_CLASS}]+"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fill_empty(c: Column | str) -> Column:
    """Null text becomes the empty string."""
    return F.coalesce(as_column(c), F.lit(""))


def replace_words(c: Column | str) -> Column:
    """Expand contractions and spell out symbols; order matters."""
    return reduce(
        lambda acc, rule: F.replace(acc, F.lit(rule[0]), F.lit(rule[1])),
        REPLACEMENTS,
        as_column(c),
    )


def strip_punctuation(c: Column | str) -> Column:
    return F.regexp_replace(as_column(c), PUNCTUATION, "")


def collapse_spaces(c: Column | str) -> Column:
    """One space between words, none at the ends."""
    return F.trim(F.regexp_replace(as_column(c), WHITESPACE, " "))


def normalise(c: Column | str) -> Column:
    """Lower-case, fill nulls, replace words, strip punctuation, collapse spaces."""
    lowered = F.lower(as_column(c))
    return collapse_spaces(strip_punctuation(replace_words(fill_empty(lowered))))


def words(c: Column | str) -> Column:
    """Split on runs of white space; no empty tokens."""
    return F.array_remove(F.split(as_column(c), WHITESPACE), "")


def space_tokens(c: Column | str) -> Column:
    """Split on every single space; empty tokens stay, so ``""`` has one token."""
    return F.split(as_column(c), " ")


def word_sequence(c: Column | str) -> Column:
    """Lower-case, turn filter characters into spaces, split on spaces."""
    spaced = F.translate(F.lower(as_column(c)), SEQUENCE_FILTERS, " " * len(SEQUENCE_FILTERS))
    return F.array_remove(F.split(spaced, " "), "")


def remove_stop_words(c: Column | str, stop_words: list[str]) -> Column:
    """Drop the listed words (a short list given by the caller)."""
    stop = F.array(*[F.lit(w) for w in stop_words])
    kept = F.filter(words(c), lambda t: ~F.array_contains(stop, t))
    return F.array_join(kept, " ")


def readability(c: Column | str) -> Column:
    """Flesch reading ease of one cleaned text, taken as a single sentence.

    Syllables are vowel groups after one trailing ``e`` is dropped, at least one
    per word. Three passes over the text instead of a lambda per word: all vowel
    groups, plus one for every word that has no vowel left.
    """
    text = as_column(c)
    n_words = F.size(words(text))
    stem = F.regexp_replace(text, rf"e(?=[{_SPACE_CLASS}]|$)", "")
    groups = F.regexp_count(stem, F.lit("[aeiouy]+"))
    voiced = F.regexp_count(stem, F.lit(rf"[aeiouy][^{_SPACE_CLASS}]*"))
    syllables = groups + n_words - voiced
    score = (
        F.lit(206.835)
        - F.lit(1.015) * n_words
        - F.lit(84.6) * (syllables / F.when(n_words > 0, n_words))
    )
    return F.coalesce(score, F.lit(0.0))
