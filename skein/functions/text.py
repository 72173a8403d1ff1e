"""Text cleaning as native Column expressions (no UDF).

Java regex classes are ASCII by default, so every class that must behave like
Python's Unicode ``re`` is spelled out with explicit Unicode properties.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skein.operators.rows import as_col

# ---- fixed values: character classes equal to Python's str-pattern classes ----
# \s  : ASCII whitespace, U+001C..U+001F, U+0085 and the Unicode separators.
WS_CLASS = r"\t\n\x{0B}\f\r\x{1C}-\x{1F}\x{85}\p{Z}"
WS = f"[{WS_CLASS}]"
# \w  : letters, numbers and underscore;  \W is its complement.
WORD_CLASS = r"\p{L}\p{N}_"
NON_WORD = f"[^{WORD_CLASS}]"
# \d  : decimal digits.
DIGIT = r"\p{Nd}"
# e-mail and IPv4 patterns of the labelled-text cleaner (Java spelling: the
# literal '-' is escaped; '(?d)' makes '$' match only at the end or before a
# final '\n', as Python's '$' does).
EMAIL = r"[a-zA-Z0-9\-_.]+@[a-zA-Z0-9\-_.]+"
IPV4_AS_CODED = r"(?d)((25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)(\.|$)){4}"
IPV4_STRICT = r"\b((25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)\.){3}(25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)\b"
# token rule of the TF-IDF featurizer: runs of two or more word characters.
TERM = f"[{WORD_CLASS}]{{2,}}"
DELETED = "[deleted]"
# -------------------------------------------------------------------------------


def trim_whitespace(c) -> Column:
    """strip(), then every whitespace run becomes one space (H1)."""
    return F.trim(F.regexp_replace(as_col(c), f"{WS}+", " "))


def keep_alnum(c) -> Column:
    """Every run of non-word characters becomes one space; '_' survives (H2)."""
    return F.regexp_replace(as_col(c), f"{NON_WORD}+", " ")


def strip_digits(c) -> Column:
    """Every run of digits becomes one space (H3)."""
    return F.regexp_replace(as_col(c), f"{DIGIT}+", " ")


def to_lower(c) -> Column:
    return F.lower(as_col(c))


def tokenize(c) -> Column:
    """Whitespace split with no empty tokens; '' gives [] (H5)."""
    return F.filter(F.split(as_col(c), f"{WS}+"), lambda t: t != F.lit(""))


def chars(c) -> Column:
    """Code points of a string, as Python iterates them (for character vocabularies)."""
    return F.filter(F.split(as_col(c), ""), lambda t: t != F.lit(""))


def text_length(c) -> Column:
    """Length in code points for strings, element count for token arrays (H8)."""
    return F.length(as_col(c))


def token_count(c) -> Column:
    return F.size(as_col(c))


def strip_emails(c) -> Column:
    return F.regexp_replace(as_col(c), EMAIL, "")


def strip_ips(c, strict: bool = False) -> Column:
    """Remove IPv4 addresses. As coded, each octet is followed by '.' or the end,
    so an address followed by a space in mid-sentence stays."""
    return F.regexp_replace(as_col(c), IPV4_STRICT if strict else IPV4_AS_CODED, "")


def remove_specials(c) -> Column:
    """Delete (not replace) every character that is neither word nor whitespace."""
    return F.regexp_replace(as_col(c), f"[^{WORD_CLASS}{WS_CLASS}]", "")


def remove_digits(c) -> Column:
    """Delete every digit."""
    return F.regexp_replace(as_col(c), DIGIT, "")


def preprocess_text(c, strip_specials=False, strip_digits_=False, trim=False,
                    lower=False, tokenize_=False) -> Column:
    """The explorer's text steps in their fixed order, whatever order flags come in (H6):
    specials -> digits -> whitespace -> lower -> tokenize.

    Two exact shortcuts keep the regex work down: with both strip steps, one
    alternation replaces every maximal non-word run and every maximal digit run
    by a space, as the two passes do; after whitespace is collapsed and trimmed,
    tokens are a split on the single space (no regex, no empty tokens except
    for the empty string)."""
    out = as_col(c)
    if strip_specials and strip_digits_:
        out = F.regexp_replace(out, f"{NON_WORD}+|{DIGIT}+", " ")
    elif strip_specials:
        out = keep_alnum(out)
    elif strip_digits_:
        out = strip_digits(out)
    if trim:
        out = trim_whitespace(out)
    if lower:
        out = to_lower(out)
    if tokenize_:
        if trim:
            # array_remove drops the single '' that split('') gives; the text
            # expression is referenced once, so it is evaluated once
            out = F.array_remove(F.split(out, " "), "")
        else:
            out = tokenize(out)
    return out


def clean_labelled(c) -> Column:
    """Labelled-sentence cleaner: lower -> e-mails -> IPs -> specials -> digits (F1).

    The last two steps delete characters one by one (a special character, then
    a digit), so one pass deleting either gives the same text."""
    no_ips = strip_ips(strip_emails(to_lower(c)))
    return F.regexp_replace(no_ips, f"[^{WORD_CLASS}{WS_CLASS}]|{DIGIT}", "")


def terms(c) -> Column:
    """Lower-cased runs of >= 2 word characters (TF-IDF token rule)."""
    return F.regexp_extract_all(F.lower(as_col(c)), F.lit(TERM), 0)


def _gram_of(tokens: Column, n: int):
    return lambda i: F.array_join(F.slice(tokens, i + 1, n), " ")


# two adjacent space-separated tokens, captured at every token start
BIGRAM = r"(?:^| )(?=(\S+ \S+))"


def word_ngrams(tokens, n_max: int = 2) -> Column:
    """All 1..n_max word n-grams of a token array, joined with one space, in order.

    Bigrams come from one regex pass over the space-joined tokens (tokens never
    contain whitespace); longer n-grams use array slices."""
    tokens = as_col(tokens)
    grams = [tokens]
    if n_max >= 2:
        grams.append(F.regexp_extract_all(F.array_join(tokens, " "), F.lit(BIGRAM), 1))
    for n in range(3, n_max + 1):
        # sequence(0, -1) would count down; arrays shorter than n give no n-gram
        grams.append(F.when(F.size(tokens) >= n,
                            F.transform(F.sequence(F.lit(0), F.size(tokens) - n), _gram_of(tokens, n)))
                     .otherwise(F.array().cast("array<string>")))
    return F.flatten(F.array(*grams))
