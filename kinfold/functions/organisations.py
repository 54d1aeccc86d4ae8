"""Normalisation, keys and n-grams of organisation names as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.functions.lists import ABBREVIATIONS, STOP_PHRASES
from kinfold.functions.people import ascii_form

#: Punctuation that becomes a space, and the patterns around which names are split.
SPACED = "!@#$%^&*()[]{};:,./<>?\\|`~-=_+"
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
KEEP_RIGHT = ("(?i)as .* by .* of", "(?i)on behalf of", "(?i)as .* by", "(?i)c/o", "(?i)board of regents of")
KEEP_LEFT = ("(?i)also trading as", "(?i)acting by and through")


def let(value: Column, body) -> Column:
    """body(value) with the value planned and computed once, however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def spaced(name: Column, marks: str = SPACED) -> Column:
    return F.translate(name, marks, " " * len(marks))


def expanded(name: Column, abbreviations: dict[str, str] | None = None) -> Column:
    """Each token that is an abbreviation (with , . or space after it) in full; tokens joined by one space."""
    table = F.create_map(*[F.lit(x) for pair in (abbreviations or ABBREVIATIONS).items() for x in pair])
    tokens = F.filter(F.split(name, r"\s+"), lambda t: t != "")
    return F.array_join(F.transform(tokens, lambda t: F.coalesce(F.try_element_at(table, F.lower(F.regexp_replace(t, r"[,.\s]*$", ""))), t)), " ")


def corrected(rows: DataFrame, token: str, words: DataFrame, threshold: int = 2, least: int = 7) -> DataFrame:
    """Adds `corrected`: the first word of `words` (position, word) within the distance, unless an equal one comes first.

    Only distinct tokens are compared, with words of a length that can be near enough: the pairs meet on
    the length, so that no token is compared with the whole list.
    """
    distinct = rows.select(F.col(token).alias("_t")).distinct().filter(F.length("_t") >= least)
    near = distinct.withColumn("_n", F.explode(F.sequence(F.length("_t") - threshold, F.length("_t") + threshold)))
    pairs = near.join(words.select("position", "word", F.length("word").alias("_n")), "_n")
    hits = pairs.filter(F.levenshtein(F.lower("_t"), F.lower("word"), threshold) >= 0)
    best = hits.groupBy("_t").agg(F.min_by("word", "position").alias("_w"))
    return rows.join(best, F.col(token) == F.col("_t"), "left").withColumn("corrected", F.coalesce("_w", token)).drop("_t", "_w")


def without_phrases(name: Column, phrases: tuple[str, ...] = STOP_PHRASES) -> Column:
    """Takes the phrases out one after the other: their order matters. Only those that a name holds are tried as patterns."""
    if not phrases:
        return F.trim(name)
    table = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(r"\b" + re.escape(p) + r"\b").alias("r")) for p in phrases])

    def out(name: Column) -> Column:
        held = F.filter(table, lambda x: F.contains(name, x["p"]))
        return F.aggregate(held, F.trim(name), lambda acc, x: F.trim(F.regexp_replace(acc, x["r"], F.lit(" "))))

    return let(name, out)


def squeezed(name: Column) -> Column:
    return F.regexp_replace(name, r"(\s){2,}", "$1")


def normalized(name: Column, phrases: tuple[str, ...] = STOP_PHRASES) -> Column:
    """Marks to spaces, abbreviations in full, phrases out, lower case, what isn't ASCII to a space."""
    out = without_phrases(F.lower(expanded(spaced(name))), phrases)  # phrases with capitals never match
    return F.regexp_replace(squeezed(out), r"[^\x00-\x7F]", " ")


def split_name(name: Column) -> Column:
    """The part after (or before) a phrase of agency, if the phrase occurs once."""

    def choose(name: Column) -> Column:
        out = name
        for side, patterns in ((0, KEEP_LEFT), (1, KEEP_RIGHT)):
            for pattern in reversed(patterns):
                parts = F.split(name, pattern, -1)
                out = F.when(F.size(parts) == 2, F.get(parts, F.lit(side))).otherwise(out)
        return out

    return let(name, choose)


def clean(name: Column) -> Column:
    out = F.regexp_replace(name, r"\([^)]*\)", "")
    out = F.replace(F.replace(out, F.lit('"'), F.lit("")), F.lit("&"), F.lit(" and "))
    return F.trim(F.regexp_replace(spaced(out, PUNCTUATION), " +", " "))


def stripped(name: Column) -> Column:
    """Without punctuation at both ends."""
    return F.btrim(name, F.lit(PUNCTUATION))


def acronyms(name: Column) -> Column:
    """What stands in parentheses as letters, dots and hyphens only."""
    return F.transform(F.regexp_extract_all(name, F.lit(r"(?i)\([A-Z.-]*\)"), F.lit(0)), lambda x: F.translate(x, "()", ""))


def without_words(name: Column, words: tuple[str, ...]) -> Column:
    return F.array_join(F.filter(F.split(name, " "), lambda t: ~t.isin(*words)) if words else F.split(name, " "), " ")


def relaxed_key(name: Column, uuid: Column, words: tuple[str, ...] = ()) -> Column:
    """A key without spaces from the cleaned name; else the name, else the uuid."""

    def key(cleaned: Column) -> Column:
        low = F.lower(cleaned)
        kept = without_words(low, words)
        kept = F.when(F.length(kept) <= 2, low).otherwise(kept)
        return F.coalesce(*[F.nullif(x, F.lit("")) for x in (F.translate(kept, " ", ""), kept, low, cleaned)])

    return F.coalesce(let(clean(split_name(name)), key), F.nullif(name, F.lit("")), uuid)


def key_and_canopies(name: Column, uuid: Column, phrases: tuple[str, ...] = STOP_PHRASES) -> tuple[Column, Column]:
    """The roll-up key, and the blocks: first four letters of each token of three or more, acronyms of the normalised name, else the key."""

    def both(plain: Column) -> Column:
        return let(clean(plain), lambda cleaned: keys(plain, cleaned))

    def keys(plain: Column, cleaned: Column) -> Column:
        key = F.coalesce(F.nullif(F.translate(cleaned, " ", ""), F.lit("")), F.nullif(cleaned, F.lit("")), F.nullif(name, F.lit("")), uuid)
        heads = F.filter(F.transform(F.split(cleaned, " "), lambda t: F.substring(t, 1, 4)), lambda t: F.length(t) >= 3)
        blocks = F.concat(heads, F.filter(F.transform(acronyms(plain), F.lower), lambda t: t != ""))
        return F.struct(key.alias("key"), F.when(F.size(blocks) > 0, blocks).otherwise(F.array(key)).alias("blocks"))

    out = let(split_name(normalized(name, phrases)), both)
    return out["key"], out["blocks"]


def simple(name: Column) -> Column:
    """Base letters, lower case, single spaces, trimmed."""
    return F.trim(F.regexp_replace(F.lower(ascii_form(name)), r"\s+", " "))


def word_grams(text: Column, low: int = 2, high: int = 10, whole: tuple[str, ...] = ()) -> Column:
    """Character n-grams inside word bounds, each word padded by a space; a word shorter than n counts once."""

    def of(word: Column) -> Column:
        padded = F.concat(F.lit(" "), word, F.lit(" "))
        size = F.length(padded)
        sizes = F.sequence(F.lit(low), F.greatest(F.least(F.lit(high), size), F.lit(low)))
        grams = F.flatten(F.transform(sizes, lambda n: F.transform(F.sequence(F.lit(1), F.greatest(size - n + 1, F.lit(1))), lambda i: F.substr(padded, i, n))))
        return F.when(word.isin(*whole), F.array(word)).otherwise(grams) if whole else grams

    return F.flatten(F.transform(F.filter(F.split(text, r"\s+"), lambda w: w != ""), of))
