"""Text cleaning, tokens and stop words as JVM-side column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from feedloom.functions.wordlists import BODY_STOP_WORDS, TITLE_STOP_WORDS

# The body-cleaning rules, in order. Rule one is anchored, so it only fires
# on a text that ends like an address, and then replaces all of it.
BODY_RULES = (
    (r"^.+@[^\.].*\.[a-z]{2,}$", "emailaddress"),
    (r"(\\u[0-9A-Fa-f]+)", ""),
    (r"[^\x00-\x7f]+", ""),
    (r"((www\.[^\s]+)|(https?://[^\s]+))", "website"),
    (r"[^a-zA-Z#@]+", " "),
    (r"\s+", " "),
    (r"^\s+|\s+?$", ""),
)

# ASCII punctuation.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Unicode white space and word characters; Java's own \s and \w know ASCII only.
_SPACE = r"\s\p{Z}\x85\x1c-\x1f"
_SPACES = f"[{_SPACE}]+"
_NOT_WORD = rf"[^\p{{L}}\p{{N}}_{_SPACE}]"

# Words a Treebank tokeniser splits in two, marked where they break.
_CONTRACTIONS = r"\b(?:can(?=not\b)|gim(?=me\b)|gon(?=na\b)|got(?=ta\b)|lem(?=me\b)|wan(?=na\b))"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_post(body: Column | str) -> Column:
    """Apply the body rules in order, then lowercase. NULL stays NULL.

    Rule five leaves single spaces as the only white space, so the two rules after it
    come down to a trim, which costs no pattern matching.
    """
    ruled = reduce(lambda c, rule: F.regexp_replace(c, *rule), BODY_RULES[:5], _col(body))
    return F.lower(F.trim(ruled))


def without_words(tokens: Column, words: Sequence[str]) -> Column:
    """Drop the given words from an array of tokens."""
    return F.filter(tokens, lambda t: ~t.isin(*words))


def strip_stop_words(text: Column | str, words: Sequence[str] = BODY_STOP_WORDS) -> Column:
    """Remove stop words from text whose words are separated by spaces."""
    tokens = F.filter(F.split(_col(text), " "), lambda t: t != "")
    return F.array_join(without_words(tokens, words), " ")


def space_tokens(text: Column | str) -> Column:
    """Split on any white space; no empty tokens."""
    return F.filter(F.split(_col(text), _SPACES), lambda t: t != "")


def normalise_title(title: Column | str) -> Column:
    """Lowercase, then keep only Unicode word characters and white space."""
    return F.regexp_replace(F.lower(_col(title)), _NOT_WORD, "")


def title_tokens(normalised: Column | str, words: Sequence[str] = TITLE_STOP_WORDS) -> Column:
    return without_words(space_tokens(normalised), words)


def strip_punctuation(text: Column | str) -> Column:
    """Lowercase and delete ASCII punctuation."""
    return F.translate(F.lower(_col(text)), PUNCTUATION, "")


def word_tokens(text: Column | str) -> Column:
    """Word tokens of punctuation-free text, with the few fused contractions split."""
    return space_tokens(F.regexp_replace(_col(text), _CONTRACTIONS, "$0 "))


def page_url(url: Column | str, number: Column) -> Column:
    """Replace the number after the first ``page/`` of a listing address."""
    return F.regexp_replace(
        _col(url), F.lit(r"^(.*?page/)\d+"), F.concat(F.lit("$1"), number.cast("string"))
    )


def listing_urls(url: Column | str, numbers: Column) -> Column:
    """``page_url`` for every number of an array; the address is taken apart once, not once per number."""
    number = r"^(.*?page/)\d+"
    parts = F.struct(
        F.rlike(_col(url), F.lit(number)).alias("found"),
        F.regexp_extract(_col(url), number, 1).alias("head"),
        F.regexp_replace(_col(url), F.lit(number), F.lit("")).alias("tail"),
    )

    def addresses(p: Column) -> Column:
        numbered = F.transform(numbers, lambda n: F.concat(p["head"], n.cast("string"), p["tail"]))
        return F.when(p["found"], numbered).otherwise(F.transform(numbers, lambda n: p["tail"]))

    # The parts go through an array of one, so that they are worked out once.
    return F.transform(F.array(parts), addresses)[0]


def key_in_bucket(path: Column | str, bucket: str) -> Column:
    """Part of an object path after ``bucket/``."""
    return F.substring_index(_col(path), f"{bucket}/", -1)
