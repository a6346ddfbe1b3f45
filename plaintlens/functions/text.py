"""Text cleaning and normalisation as native column expressions (no Python workers).

The rules are defined on Unicode text, while ``\\w``, ``\\d`` and ``\\s`` are ASCII-only in Java
unless asked otherwise, so the patterns ask for it or name the classes.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from zlib import crc32

from pyspark.sql import Column
from pyspark.sql import functions as F

from plaintlens import constants as K
from plaintlens.functions.bind import let

# With (?U) ``\s`` and ``\S`` are Unicode white space and its complement, except that the four
# separators \x1c-\x1f count as white space only by the rule followed here.
WS = r"[\s\x1c-\x1f]"
NOT_WS = r"[\S&&[^\x1c-\x1f]]"
_WORD = r"[\p{L}\p{N}_]"
_END = rf"(?!{_WORD})"

# Each pattern begins with something that fails fast on ordinary letters; the look-behind that
# stands for a Unicode word boundary comes only after the first characters have matched.
URLS = rf"(?U)[hw](?:ttp|ww){NOT_WS}+"
_GAP = r"[-.\s\x1c-\x1f]?"
PHONE_SHORT = rf"(?U)\p{{Nd}}(?<!{_WORD}\p{{Nd}})\p{{Nd}}{{2}}{_GAP}\p{{Nd}}{{4}}{_END}"
PHONE_LONG = (
    rf"(?U)\p{{Nd}}(?<!{_WORD}\p{{Nd}})\p{{Nd}}{{2}}{_GAP}\p{{Nd}}{{3}}{_GAP}\p{{Nd}}{{4}}{_END}"
)
ACCOUNT_IDS = rf"[a-z]{{2}}\p{{Nd}}(?<!{_WORD}[a-z]{{2}}\p{{Nd}})\p{{Nd}}{{9,}}{_END}"
REDACTIONS = "x{2,}"
TAGS = r"<[^\n]*?>"
PUNCTUATION = r"(?U)[[^a-z \n]&&[^\p{L}\p{N}_\s\x1c-\x1f]]"
WS_RUNS = rf"(?U){WS}+"


def strip(c: Column) -> Column:
    """Remove Unicode white space from both ends."""
    return F.trim(c, F.lit(K.WHITESPACE))


def is_blank(c: Column) -> Column:
    """True for null or white-space-only text; stops at the first other character."""
    return F.coalesce(~c.rlike(f"(?U){NOT_WS}"), F.lit(True))


def word_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(f"(?U){NOT_WS}+"))


def excerpt(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


def contains_pattern(c: Column, pattern: str) -> Column:
    """Case-insensitive regex search; null text counts as no match."""
    return F.coalesce(c.rlike(f"(?iU){pattern}"), F.lit(False))


def has_opener(c: Column) -> Column:
    return contains_pattern(c, K.OPENER_SEARCH)


# How every opener pattern can begin. Other texts, nearly all of them, skip the pattern chain.
_MAY_OPEN = (
    r"(?U)^\s*(?:i\s*(?:'m|am)\s+writing|i\s+(?:would\s+like|am\s+filing)"
    r"|this\s+letter\s+is|to\s+whom\s+it)"
).replace(r"\s", WS)


def _one_round(text: Column) -> Column:
    for pattern in K.OPENER_PATTERNS:
        text = F.regexp_replace(text, "(?iU)" + pattern.replace(r"\s", WS), "")
    return text


def _without_openers(text: Column) -> Column:
    """Each round is run only on texts that may still open that way; most stop before the first."""
    for _ in range(K.OPENER_PASSES):
        text = let(text, lambda t: F.when(t.rlike(_MAY_OPEN), _one_round(t)).otherwise(t))
    return text


def strip_openers(c: Column) -> Column:
    """Remove stock opening phrases from lower-cased text, up to three stacked rounds."""
    return strip(_without_openers(F.coalesce(c, F.lit(""))))


def clean_noise(c: Column, phone_order: str = "short_first") -> Column:
    """Lower-case, drop openers, URLs, phone numbers, ids, redactions, tags and punctuation.

    The 7-digit phone rule runs first by default, as in the rules being matched; it leaves the
    first group of ``555-123-4567``. ``phone_order="long_first"`` removes such numbers whole.
    """
    phones = [PHONE_SHORT, PHONE_LONG]
    if phone_order == "long_first":
        phones.reverse()
    text = _without_openers(F.lower(c))
    for pattern in [URLS, *phones, ACCOUNT_IDS, REDACTIONS, TAGS, PUNCTUATION]:
        text = F.regexp_replace(text, pattern, "")
    text = F.trim(F.regexp_replace(text, WS_RUNS, " "))
    empty = is_blank(c) | c.rlike(r"^(?i:nan)\z")
    return F.when(empty, F.lit("")).otherwise(text)


def tokenize(c: Column) -> Column:
    """Words of cleaned text. Fused pairs ("cannot") come apart in :func:`normalize`."""
    return F.filter(F.split(c, " "), lambda t: t != "")


def drop_stop_words(tokens: Column, stop_words: Iterable[str] = K.STOP_WORDS) -> Column:
    words = list(stop_words)
    return F.filter(tokens, lambda t: ~t.isin(words))


def seed_lexicon() -> list[tuple[str, str, str]]:
    """(surface, pos, lemma) rows of the built-in seed."""
    rows = []
    for line in K.SEED_LEXICON_TEXT.strip().splitlines():
        head, forms = line.split(":")
        pos, lemma = head.split()
        rows.extend((form, pos, lemma) for form in forms.split())
    return rows


def _lookup(lexicon: Mapping[str, str], buckets: int) -> Column:
    """Literal lookup table as an array of small maps, picked by the word's hash.

    A map lookup is a linear scan in Spark, so one large literal map would make every token pay
    for the whole lexicon.
    """
    slots: list[dict[str, str]] = [{} for _ in range(buckets)]
    for surface, lemma in lexicon.items():
        slots[crc32(surface.encode()) % buckets][surface] = lemma
    # one literal, folded into a constant by the optimizer
    return F.from_json(F.lit(json.dumps(slots)), "array<map<string,string>>")


def _replace_from(table: Column, buckets: int):
    def replaced(token: Column) -> Column:
        slot = F.get(table, F.pmod(F.crc32(token), F.lit(buckets)).cast("int"))
        return F.coalesce(F.try_element_at(slot, token), token)

    return replaced


def _final_lemmas(lexicon: Iterable[tuple[str, str, str]] | None) -> dict[str, str]:
    """surface -> lemma after the verb entry and then the noun entry of the result."""
    rows = list(seed_lexicon() if lexicon is None else lexicon)
    verbs = {surface: lemma for surface, pos, lemma in rows if pos == "v"}
    nouns = {surface: lemma for surface, pos, lemma in rows if pos == "n"}
    return {w: nouns.get(verbs.get(w, w), verbs.get(w, w)) for w in {**verbs, **nouns}}


def _replace_all(tokens: Column, words: Mapping[str, str]) -> Column:
    buckets = max(64, len(words) // 4)
    return F.transform(tokens, _replace_from(_lookup(words, buckets), buckets))


def lemmatize(tokens: Column, lexicon: Iterable[tuple[str, str, str]] | None = None) -> Column:
    """Replace each token by its verb lemma, then by its noun lemma, where the lexicon has one.

    ``lexicon`` is a bounded list of (surface, pos, lemma) held as a literal in the plan. For a
    lexicon kept as a table use :func:`plaintlens.operators.normalize.normalize_with_table`.
    """
    return _replace_all(tokens, _final_lemmas(lexicon))


def fused_words(lemmas: Mapping[str, str]) -> tuple[dict[str, str], list[str]]:
    """Fused pairs as what normalisation leaves of them, and those it removes whole."""
    left, gone = {}, []
    for pair in K.SPLIT_WORDS:
        parts = [lemmas.get(p, p) for p in pair.split("|") if p not in K.STOP_WORDS]
        if parts:
            left[pair.replace("|", "")] = " ".join(parts)
        else:
            gone.append(pair.replace("|", ""))
    return left, gone


def normalize(c: Column, lexicon: Iterable[tuple[str, str, str]] | None = None) -> Column:
    """Tokenize, drop stop words, lemmatize, join with single spaces.

    Two passes over the tokens: one drops empty tokens and stop words, one replaces words.
    """
    lemmas = _final_lemmas(lexicon)
    fused, gone = fused_words(lemmas)
    kept = drop_stop_words(F.split(c, " "), ["", *K.STOP_WORDS, *gone])
    return F.array_join(_replace_all(kept, {**lemmas, **fused}), " ")


def clean_text(c: Column, lexicon: Iterable[tuple[str, str, str]] | None = None) -> Column:
    """The full cleaning: noise removal followed by normalisation."""
    return normalize(clean_noise(c), lexicon)
