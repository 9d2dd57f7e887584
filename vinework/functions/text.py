"""Tokens, stop words, stems and text ranks."""

from __future__ import annotations

import re
import sys
from dataclasses import dataclass

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# Ship the stemmer with the job, so workers need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# English stop words of the text configuration.
STOP_WORDS = tuple(
    """
    a about above after again against all am an and any are as at be because
    been before being below between both but by can did do does doing don down
    during each few for from further had has have having he her here hers
    herself him himself his how i if in into is it its itself just me more
    most my myself no nor not now of off on once only or other our ours
    ourselves out over own s same she should so some such t than that the
    their theirs them themselves then there these they this those through to
    too under until up very was we were what when where which while who whom
    why will with you your yours yourself yourselves
    """.split()
)

# Fixed values of the proximity rank: weight of a plain term, limit of the sum
# of 1/j^2, and the number of words beyond which two occurrences are unrelated.
TERM_WEIGHT = 0.1
ZETA_2 = 1.64493406685
REACH = 100

# BM25 parameters.
K1, B = 1.2, 0.75

TOKEN = r"([\p{L}\p{N}]+)"


@dataclass(frozen=True)
class TextConfig:
    """How text becomes terms."""

    stop_words: bool = True
    stem: bool = True


ENGLISH = TextConfig()
UNSTEMMED = TextConfig(stem=False)
SIMPLE = TextConfig(stop_words=False, stem=False)


def tokens(text: Column) -> Column:
    """Lower-case letter and digit runs in text order."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), 1)


def marked_terms(text: Column, config: TextConfig = ENGLISH) -> Column:
    """One entry per token, so that an entry's place is its word position.

    Stop words are null when the configuration stems; otherwise they are kept,
    because :func:`is_term` can tell them from the word itself.
    """
    words = tokens(text)
    return stem(words, config.stop_words) if config.stem else words


def is_term(entry: Column, config: TextConfig = ENGLISH) -> Column:
    """Whether an entry of :func:`marked_terms` is to be indexed."""
    if config.stem:
        return entry.isNotNull()
    return ~entry.isin(list(STOP_WORDS)) if config.stop_words else F.lit(True)


def terms(text: Column, config: TextConfig = ENGLISH) -> Column:
    """Terms in text order, with repetitions."""
    entries = marked_terms(text, config)
    if not (config.stem or config.stop_words):
        return entries
    return F.filter(entries, lambda entry: is_term(entry, config))


def matches_all(present: Column, wanted: Column) -> Column:
    """Whether all wanted terms occur; no wanted terms match nothing."""
    return (F.size(wanted) > 0) & (F.size(F.array_except(wanted, present)) == 0)


def bm25(tf: Column, df: Column, length: Column, n_docs: Column, mean_length: Column) -> Column:
    """BM25 share of one term."""
    idf = F.log((n_docs - df + 0.5) / (df + 0.5) + 1.0)
    return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean_length))


def frequency_rank(tf: Column) -> Column:
    """Rank of a one-term query: weighted sum of 1/j^2 over occurrences."""
    total = F.aggregate(F.sequence(F.lit(1), tf.cast("int")), F.lit(0.0), lambda acc, j: acc + F.lit(TERM_WEIGHT) / (j.cast("double") * j))
    return total / ZETA_2


def miss(gap: Column) -> Column:
    """Logarithm of what two occurrences of different terms leave of doubt, by the number of words from one to the other."""
    nearness = 1.0 / (F.exp(gap / 1.5 - 2.0) * 0.05 + 1.005)
    return F.log(1.0 - F.lit(TERM_WEIGHT) * F.sqrt(nearness))


# --- English stemmer (the second Porter algorithm, as text search configurations use it) ---

VOWELS = "aeiouy"

# Words with a stem of their own, and words that end after the first step.
IRREGULAR = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl",
    "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl", "sky": "sky", "news": "news", "howe": "howe",
    "atlas": "atlas", "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
UNCHANGED = frozenset("inning outing canning herring earring proceed exceed succeed".split())
# Beginnings after which the first region starts, double letters, letters before a removed -li.
PREFIXES = ("gener", "commun", "arsen")
DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
BEFORE_LI = "cdeghkmnrt"
# Suffixes of steps 2 to 4 and what replaces them; the longest that a word has counts.
STEP_2 = {
    "tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent", "izer": "ize", "ization": "ize",
    "ational": "ate", "ation": "ate", "ator": "ate", "alism": "al", "aliti": "al", "alli": "al", "fulness": "ful",
    "ousli": "ous", "ousness": "ous", "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble", "ogi": "og",
    "fulli": "ful", "lessli": "less", "li": "",
}
STEP_3 = {
    "tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic", "ical": "ic", "ful": "",
    "ness": "", "ative": "",
}
STEP_4 = dict.fromkeys(
    "al ance ence er ic able ible ant ement ment ent ism ate iti ous ive ize ion".split(), ""
)


def _region(word: str, start: int) -> int:
    """Where the part after the first consonant that follows a vowel begins."""
    found = re.compile("[aeiouy][^aeiouy]").search(word, start)
    return found.end() if found else len(word)


def _short_end(word: str) -> bool:
    """Whether a word ends in a short syllable."""
    if len(word) == 2:
        return word[0] in VOWELS and word[1] not in VOWELS
    return len(word) > 2 and word[-1] not in VOWELS + "wxY" and word[-2] in VOWELS and word[-3] not in VOWELS


def _replaced(word: str, rules: dict[str, str], allowed) -> str:
    """The word with its longest listed suffix replaced, if ``allowed(rest, suffix)``."""
    suffix = next((word[i:] for i in range(len(word)) if word[i:] in rules), None)
    if suffix is None or not allowed(word[: len(word) - len(suffix)], suffix):
        return word
    return word[: len(word) - len(suffix)] + rules[suffix]


def stem_word(word: str) -> str:
    """English stem of a lower-case word; words of other scripts pass through."""
    if len(word) < 3 or not word.isascii() or not word.isalpha():
        return word
    if word in IRREGULAR:
        return IRREGULAR[word]
    # A y that is a consonant is written Y until the end.
    word = re.sub("(?<=[aeiouy])y", "Y", "Y" + word[1:] if word[0] == "y" else word)
    prefix = next((p for p in PREFIXES if word.startswith(p)), None)
    first = len(prefix) if prefix else _region(word, 0)
    second = _region(word, first)
    word = _plural(word)
    if word in UNCHANGED:
        return word
    word = _ending(word, first)
    if len(word) > 2 and word[-1] in "yY" and word[-2] not in VOWELS:
        word = word[:-1] + "i"
    word = _replaced(word, STEP_2, lambda rest, suffix: len(rest) >= first and _fits(rest, suffix))
    word = _replaced(word, STEP_3, lambda rest, suffix: len(rest) >= (second if suffix == "ative" else first))
    word = _replaced(word, STEP_4, lambda rest, suffix: len(rest) >= second and (suffix != "ion" or rest.endswith(("s", "t"))))
    rest = word[:-1]
    if word[-1] == "e" and (len(rest) >= second or (len(rest) >= first and not _short_end(rest))):
        word = rest
    elif word.endswith("ll") and len(rest) >= second:
        word = rest
    return word.lower()


def _fits(rest: str, suffix: str) -> bool:
    if suffix == "ogi":
        return rest.endswith("l")
    return suffix != "li" or rest[-1:] in BEFORE_LI


def _plural(word: str) -> str:
    if word.endswith("sses"):
        return word[:-2]
    if word.endswith(("ied", "ies")):
        return word[:-2] if len(word) > 4 else word[:-1]
    if word.endswith("s") and not word.endswith(("us", "ss")) and any(c in VOWELS for c in word[:-2]):
        return word[:-1]
    return word


def _ending(word: str, first: int) -> str:
    """The word without -ed, -ing and the like, mended where that leaves an odd end."""
    for suffix in ("eedly", "ingly", "edly", "eed", "ing", "ed"):
        if word.endswith(suffix):
            break
    else:
        return word
    rest = word[: len(word) - len(suffix)]
    if suffix in ("eed", "eedly"):
        return rest + "ee" if len(rest) >= first else word
    if not any(c in VOWELS for c in rest):
        return word
    if rest.endswith(("at", "bl", "iz")):
        return rest + "e"
    if rest.endswith(DOUBLES):
        return rest[:-1]
    return rest + "e" if len(rest) <= first and _short_end(rest) else rest


def stem(words: Column, drop_stop_words: bool = True) -> Column:
    """Stem an array of tokens, with null for each stop word.

    Each distinct word of a batch is stemmed once.
    """
    dropped = frozenset(STOP_WORDS) if drop_stop_words else frozenset()

    @F.pandas_udf("array<string>")
    def stems(batch: pd.Series) -> pd.Series:
        known: dict[str, str | None] = dict.fromkeys(dropped)

        def one(word):
            if word not in known:
                known[word] = stem_word(word)
            return known[word]

        return batch.map(lambda row: None if row is None else [one(w) for w in row])

    return stems(words)
