"""English stems by the published Porter2 rules, vectorised over Arrow batches."""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

# Fixed values from the published algorithm.
_VOWELS = "aeiouy"
_DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
_SPECIAL = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl",
    "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl",
    "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas", "cosmos": "cosmos",
    "bias": "bias", "andes": "andes",
}
_KEEP_AFTER_1A = frozenset(
    "inning outing canning herring earring proceed exceed succeed".split()
)
_STEP2 = (
    ("ization", "ize"), ("ational", "ate"), ("fulness", "ful"), ("ousness", "ous"),
    ("iveness", "ive"), ("tional", "tion"), ("biliti", "ble"), ("lessli", "less"),
    ("entli", "ent"), ("ation", "ate"), ("alism", "al"), ("aliti", "al"), ("ousli", "ous"),
    ("iviti", "ive"), ("fulli", "ful"), ("enci", "ence"), ("anci", "ance"), ("abli", "able"),
    ("izer", "ize"), ("ator", "ate"), ("alli", "al"), ("bli", "ble"), ("ogi", "og"), ("li", ""),
)
_STEP3 = (
    ("ational", "ate"), ("tional", "tion"), ("alize", "al"), ("icate", "ic"), ("iciti", "ic"),
    ("ative", ""), ("ical", "ic"), ("ness", ""), ("ful", ""),
)
_STEP4 = (
    "ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism", "ate", "iti", "ous",
    "ive", "ize", "ion", "al", "er", "ic",
)
_LI_BEFORE = "cdeghkmnrt"
_REGION = re.compile(r"[aeiouy][^aeiouy]")
_SHORT_END = re.compile(r"(?:[^aeiouy][aeiouy][^aeiouywxY]|^[aeiouy][^aeiouy])$")


def _regions(word: str) -> tuple[int, int]:
    """Start of R1 and R2."""
    prefix = re.match(r"(?:gener|commun|arsen)", word)
    if prefix:
        r1 = prefix.end()
    else:
        found = _REGION.search(word)
        r1 = found.end() if found else len(word)
    found = _REGION.search(word, r1)
    return r1, found.end() if found else len(word)


def _longest(word: str, suffixes) -> str | None:
    return next((s for s in suffixes if word.endswith(s)), None)


def _plural(word: str) -> str:
    if word.endswith("sses"):
        return word[:-2]
    if word.endswith(("ied", "ies")):
        return word[:-2] if len(word) > 4 else word[:-1]
    if word.endswith(("us", "ss")) or not word.endswith("s"):
        return word
    return word[:-1] if re.search("[aeiouy]", word[:-2]) else word


def _past(word: str, r1: int) -> str:
    suffix = _longest(word, ("eedly", "ingly", "edly", "eed", "ing", "ed"))
    if suffix is None:
        return word
    if suffix in ("eedly", "eed"):
        return word[: -len(suffix)] + "ee" if len(word) - len(suffix) >= r1 else word
    base = word[: -len(suffix)]
    if not re.search("[aeiouy]", base):
        return word
    if base.endswith(("at", "bl", "iz")):
        return base + "e"
    if base.endswith(_DOUBLES):
        return base[:-1]
    if r1 >= len(base) and _SHORT_END.search(base):
        return base + "e"
    return base


@lru_cache(maxsize=100_000)
def stem(word: str) -> str:
    """Stem of one lowercase word."""
    if word in _SPECIAL:
        return _SPECIAL[word]
    if len(word) <= 2:
        return word
    word = word.replace("\u2019", "'").lstrip("'")
    # A consonant y is written Y so that it does not count as a vowel.
    word = re.sub(r"(^|[aeiouy])y", r"\1Y", word)
    r1, r2 = _regions(word)
    for mark in ("'s'", "'s", "'"):
        if word.endswith(mark):
            word = word[: -len(mark)]
            break
    word = _plural(word)
    if word in _KEEP_AFTER_1A:
        return word.lower()
    word = _past(word, r1)
    if len(word) > 2 and word[-1] in "yY" and word[-2] not in _VOWELS:
        word = word[:-1] + "i"

    for suffix, new in _STEP2:
        if word.endswith(suffix):
            at = len(word) - len(suffix)
            allowed = at >= r1
            if suffix == "ogi":
                allowed = allowed and word[at - 1] == "l"
            if suffix == "li":
                allowed = allowed and word[at - 1] in _LI_BEFORE
            word = word[:at] + new if allowed else word
            break
    for suffix, new in _STEP3:
        if word.endswith(suffix):
            at = len(word) - len(suffix)
            if at >= (r2 if suffix == "ative" else r1):
                word = word[:at] + new
            break
    suffix = _longest(word, _STEP4)
    if suffix:
        at = len(word) - len(suffix)
        if at >= r2 and (suffix != "ion" or word[at - 1] in "st"):
            word = word[:at]
    if word.endswith("e"):
        at = len(word) - 1
        if at >= r2 or (at >= r1 and not _SHORT_END.search(word[:at])):
            word = word[:at]
    elif word.endswith("ll") and len(word) - 1 >= r2:
        word = word[:-1]
    return word.lower()


@F.pandas_udf(T.StringType())
def _stem_words(words: pd.Series) -> pd.Series:
    return words.map(stem, na_action="ignore")


@F.pandas_udf(T.ArrayType(T.StringType()))
def _stem_arrays(tokens: pd.Series) -> pd.Series:
    return tokens.map(lambda row: [stem(t) for t in row], na_action="ignore")


def stem_word(word: Column | str) -> Column:
    """Stem of a column of single words."""
    return _stem_words(word)


def stem_tokens(tokens: Column | str) -> Column:
    """Stems of a token array, in place: no shuffle, repeated words served from a small cache."""
    return _stem_arrays(tokens)
