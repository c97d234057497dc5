"""Stemming after M. F. Porter, "An algorithm for suffix stripping", 1980."""

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import as_column

# The suffix tables of the paper, in its order.
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "abli": "able", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous",
    "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive",
    "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
}
STEP_3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "",
    "ness": "",
}
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
    "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)

# The stop words of the classic English analyzer.
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into",
    "is", "it", "no", "not", "of", "on", "or", "such", "that", "the", "their", "then",
    "there", "these", "they", "this", "to", "was", "will", "with",
)

_VOWEL_RUN = re.compile("v+c")


def _shape(word: str) -> str:
    """One letter per character: v for vowel, c for consonant (y by its neighbour)."""
    out = []
    for ch in word:
        vowel = ch in "aeiou" or (ch == "y" and bool(out) and out[-1] == "c")
        out.append("v" if vowel else "c")
    return "".join(out)


def _measure(stem: str) -> int:
    return len(_VOWEL_RUN.findall(_shape(stem)))


def _short_end(stem: str) -> bool:
    """Consonant, vowel, consonant, where the last one is not w, x or y."""
    return _shape(stem).endswith("cvc") and stem[-1] not in "wxy"


def _double_end(stem: str) -> bool:
    return len(stem) > 1 and stem[-1] == stem[-2] and _shape(stem)[-1] == "c"


def _longest(word: str, suffixes) -> str | None:
    return max((s for s in suffixes if word.endswith(s)), key=len, default=None)


@lru_cache(maxsize=1 << 18)
def porter_stem(word: str) -> str:
    if len(word) <= 2:
        return word
    if word.endswith(("sses", "ies")):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]

    if word.endswith("eed"):
        if _measure(word[:-3]) > 0:
            word = word[:-1]
    else:
        suffix = _longest(word, ("ed", "ing"))
        stem = word[: -len(suffix)] if suffix else ""
        if suffix and "v" in _shape(stem):
            if stem.endswith(("at", "bl", "iz")):
                word = stem + "e"
            elif _double_end(stem) and stem[-1] not in "lsz":
                word = stem[:-1]
            elif _measure(stem) == 1 and _short_end(stem):
                word = stem + "e"
            else:
                word = stem

    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"

    for table in (STEP_2, STEP_3):
        suffix = _longest(word, table)
        if suffix and _measure(word[: -len(suffix)]) > 0:
            word = word[: -len(suffix)] + table[suffix]

    suffix = _longest(word, STEP_4)
    if suffix:
        stem = word[: -len(suffix)]
        if _measure(stem) > 1 and (suffix != "ion" or stem.endswith(("s", "t"))):
            word = stem

    if word.endswith("e"):
        stem = word[:-1]
        if _measure(stem) > 1 or (_measure(stem) == 1 and not _short_end(stem)):
            word = stem
    if word.endswith("ll") and _measure(word) > 1:
        word = word[:-1]
    return word


@F.pandas_udf(T.ArrayType(T.StringType()))
def _stem_arrays(tokens: pd.Series) -> pd.Series:
    return tokens.map(lambda words: None if words is None else [porter_stem(w) for w in words])


def stem_tokens(tokens: Column | str) -> Column:
    """Stem every element of a token array.

    Runs where the tokens are, without a shuffle; each Python worker remembers the
    stems of a bounded vocabulary, so a frequent word is worked out once per worker.
    """
    return _stem_arrays(as_column(tokens))


@F.pandas_udf(T.StringType())
def _stem_words(words: pd.Series) -> pd.Series:
    return words.map(lambda word: None if word is None else porter_stem(word))


def stem_words(word: Column | str) -> Column:
    """The stem of each word; meant for tables of distinct words."""
    return _stem_words(as_column(word))


def stem_prefix(stem: str) -> str:
    """What every word of this stem begins with.

    The steps of the paper take suffixes away or change the last letters of what is left,
    never more than two letters of the stem (``bility`` to ``ble``).
    """
    return stem[: max(1, len(stem) - 2)]
