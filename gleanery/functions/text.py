"""Text expressions: tokens, letters, headers, item lists and the default stop words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token patterns of the regex tokenizer.
WORD_PATTERN = r"[a-z_\-]{6,24}"
NUMBER_PATTERN = r"-?[0-9]+(?:[.,][0-9]+)?"
MIN_TOKEN_LENGTH = 3

# Default English stop words ("ours " carries its trailing blank).
STOP_WORDS = [
    "###", "a", "about", "above", "after", "again", "against", "all", "am", "an", "and", "any",
    "are", "aren't", "arent", "as", "at", "be", "because", "been", "before", "being", "below",
    "between", "both", "but", "by", "can", "can't", "cannot", "cant", "could", "couldn't",
    "couldnt", "did", "didn't", "didnt", "do", "does", "doesn't", "doesnt", "doing", "don't",
    "dont", "down", "during", "each", "few", "for", "from", "further", "had", "hadn't", "hadnt",
    "has", "hasn't", "hasnt", "have", "haven't", "havent", "having", "he", "he'd", "he'll",
    "he's", "her", "here", "here's", "heres", "hers", "herself", "hes", "him", "himself", "his",
    "how", "how's", "hows", "i", "i'd", "i'll", "i'm", "i've", "if", "im", "in", "into", "is",
    "isn't", "isnt", "it", "it's", "its", "itself", "let's", "lets", "me", "more", "most",
    "mustn't", "mustnt", "my", "myself", "no", "nor", "not", "of", "off", "on", "once", "only",
    "or", "other", "ought", "our", "ours ", "ourselves", "out", "over", "own", "return", "same",
    "shan't", "shant", "she", "she'd", "she'll", "she's", "shes", "should", "shouldn't",
    "shouldnt", "so", "some", "such", "than", "that", "that's", "thats", "the", "their",
    "theirs", "them", "themselves", "then", "there", "there's", "theres", "these", "they",
    "they'd", "they'll", "they're", "they've", "theyll", "theyre", "theyve", "this", "those",
    "through", "to", "too", "under", "until", "up", "very", "was", "wasn't", "wasnt", "we",
    "we'd", "we'll", "we're", "we've", "were", "weren't", "werent", "what", "what's", "whats",
    "when", "when's", "whens", "where", "where's", "wheres", "which", "while", "who", "who's",
    "whom", "whos", "why", "why's", "whys", "with", "won't", "wont", "would", "wouldn't",
    "wouldnt", "you", "you'd", "you'll", "you're", "you've", "youd", "youll", "your", "youre",
    "yours", "yourself", "yourselves", "youve",
]


_BLANK = r" \t\n\r\f"
# A whole blank-delimited token that is a word or a number; one scan over the text.
_REGEX_TOKEN = rf"(?<![^{_BLANK}])(?:{WORD_PATTERN}|{NUMBER_PATTERN})(?![^{_BLANK}])"
# Letters that stand alone: no digit or inner punctuation mark joins them to a longer run.
_ALNUM = r"[\p{L}\p{N}]"
_JOIN = "[-_.'’@]"
_SURFACE_TOKEN = (
    rf"(?<!{_ALNUM})(?<!{_ALNUM}{_JOIN})\p{{L}}++(?!{_ALNUM})(?!{_JOIN}{_ALNUM})"
)
_CLITIC = rf"(n['’]t|['’](s|re|ve|ll|d|m))(?!{_ALNUM})"


def pattern_tokens(text: Column) -> Column:
    """Lower-cased words of 6-24 letters and numbers of 3+ characters."""
    found = F.regexp_extract_all(F.lower(text), F.lit(_REGEX_TOKEN), F.lit(0))
    kept = F.filter(found, lambda t: F.length(t) >= MIN_TOKEN_LENGTH)
    return F.coalesce(kept, F.array().cast("array<string>"))


def surface_tokens(text: Column) -> Column:
    """Lower-cased letters-only tokens before lemmas are looked up.

    Clitics are cut off (``don't`` gives ``do``); tokens with digits or inner
    punctuation (``l3``, ``x-ray``) do not survive the letters-only test.
    """
    bare = F.regexp_replace(F.lower(text), _CLITIC, "")
    found = F.regexp_extract_all(bare, F.lit(_SURFACE_TOKEN), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def without_words(tokens: Column, words: list[str]) -> Column:
    return F.filter(tokens, lambda t: ~t.isin(words)) if words else tokens


def blank_split(text: Column) -> Column:
    return F.split(F.lower(text), rf"[{_BLANK}]+")


def letters_only(value: Column) -> Column:
    return value.rlike(r"^\p{L}*$")


def sentences(text: Column) -> Column:
    """Pieces between sentence marks followed by blanks; empty pieces dropped."""
    pieces = F.split(text, rf"[.!?]+([{_BLANK}]+|$)")
    return F.filter(pieces, lambda s: F.trim(s) != "")


def split_items(value: Column) -> Column:
    return F.transform(F.split(value, ","), lambda item: F.trim(item))


def header_attribute(header: Column, name: str) -> Column:
    """Value of ``name="..."``; empty when the attribute is missing."""
    return F.regexp_extract(header, rf'(?:^|[ \t]){name}="([^"]*)"', 1)
