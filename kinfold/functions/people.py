"""Parts of person names as column expressions; a missing part is null."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinfold.functions.lists import SUFFIXES


@cache
def _accents() -> tuple[str, str]:
    """Every character whose canonical decomposition holds one ASCII character, and that character."""
    pairs = []
    for c in range(0x80, 0x30000):
        base = unicodedata.normalize("NFD", chr(c)).encode("ascii", "ignore").decode()
        if len(base) == 1:
            pairs.append((chr(c), base))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def ascii_form(name: Column) -> Column:
    """Base letters of accented ones; what has no ASCII form goes."""
    plain = F.regexp_replace(F.translate(name, *_accents()), r"[^\x00-\x7F]", "")
    return F.when(name.rlike(r"[^\x00-\x7F]"), plain).otherwise(name)


def normalized(name: Column) -> Column:
    return F.lower(ascii_form(F.translate(name, '"', "")))


def is_initial(token: Column) -> Column:
    return token.rlike(r"^(?s)(.|.\.|.-.)$")


def _nonempty(x: Column) -> Column:
    return F.nullif(x, F.lit(""))


def letters(name: Column, n: int) -> Column:
    """The first n letters of a normalised name, trimmed if n > 1: the blocking prefix."""
    head = F.substring(normalized(name), 1, n)
    present = F.length(normalized(name)) > 0
    return F.when(present, F.trim(head) if n > 1 else head)


def initials(name: Column, n: int = 1) -> Column:
    """First n characters; of a hyphenated name those of the first two parts, null if either is empty."""
    own = normalized(name)
    parts = F.split(own, "-", -1)
    cut = lambda x: F.trim(F.substring(x, 1, n)) if n > 1 else F.substring(x, 1, n)
    a, b = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    double = F.when((F.length(a) > 0) & (F.length(b) > 0), F.concat(cut(a), F.lit("-"), cut(b)))
    return F.when(F.contains(own, F.lit("-")), double).otherwise(F.when(F.length(own) > 0, cut(own)))


def _token(name: Column, i: int) -> Column:
    return F.get(F.split(F.translate(normalized(name), "-", " "), " ", -1), F.lit(i))


def first_name(name: Column) -> Column:
    token = _nonempty(_token(name, 0))
    return F.when(~is_initial(token), token)


def middle_name(name: Column) -> Column:
    token = _nonempty(_token(name, 1))
    return F.when(~is_initial(token), token)


def middle_initial(name: Column) -> Column:
    return F.substring(_nonempty(_token(name, 1)), 1, 1)


def suffixes(name: Column) -> Column:
    """Sorted suffixes among the tokens between spaces and between commas."""
    own = normalized(name)
    tokens = F.concat(F.split(own, " ", -1), F.split(own, ",", -1))
    known = F.array(*[F.lit(s) for s in SUFFIXES])
    return F.array_sort(F.array_intersect(F.transform(tokens, F.trim), known))


def last_name(name: Column) -> Column:
    return _nonempty(F.get(F.split(normalized(name), ",", -1), F.lit(0)))


def person_key(first: Column, last: Column, uuid: Column, n: int = 2) -> Column:
    """fl:<first letters>_ln:<last name without spaces and hyphens>; the uuid stands for a missing part."""
    head = F.coalesce(_nonempty(letters(first, n)), uuid)
    tail = F.coalesce(_nonempty(F.translate(last_name(last), " -", "")), uuid)
    return F.concat(F.lit("fl:"), head, F.lit("_ln:"), tail)


def unquoted(x: Column) -> Column:
    return F.translate(x, '"', "")


def mention_id(patent: Column, document: Column, sequence: Column) -> Column:
    """<patent>-<sequence>, or pg-<document>-<sequence> where there is no patent; null without either."""
    own = unquoted(patent)
    return F.when(own.isNotNull(), F.concat(own, F.lit("-"), sequence.cast("string"))).otherwise(F.concat(F.lit("pg-"), document, F.lit("-"), sequence.cast("string")))


def record_id(patent: Column, document: Column) -> Column:
    return F.coalesce(_nonempty(unquoted(patent)), F.concat(F.lit("pg-"), document))


def display_name(organization: Column, first: Column, last: Column, uuid: Column) -> Column:
    person = F.concat(F.lit("fn:"), F.coalesce(_nonempty(first), uuid), F.lit("_ln:"), F.coalesce(_nonempty(last), uuid))
    return F.coalesce(_nonempty(unquoted(organization)), person)


def pretty(*columns: Column) -> Column:
    return F.concat_ws("\t", *[unquoted(c.cast("string")) for c in columns])
