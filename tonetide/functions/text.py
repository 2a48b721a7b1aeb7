"""Text cleaning as column expressions; null in, null out.

The rules are defined over Python's Unicode character classes. Java's ``\\w``, ``\\s``
and ``.`` cover other characters, so every class is spelled out here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tonetide.constants import PUNCTUATION_TOKENS

# --- fixed values: character classes and patterns ----------------------------
WORD = r"\p{L}\p{N}_"
NOT_SPACE = r"[^\s\x0b\x1c-\x1f\x85\p{Z}]"
# A link's tail ends at its last word character. (?d): only \n ends a line.
LINK = (
    rf"(?d)\[.*\]\(https?://{NOT_SPACE}*[{WORD}]"
    rf"|www\.(?:[{WORD}] +\.)++{NOT_SPACE}*\)"
)
MENTION = r"/[ru]/[a-zA-Z0-9_-]+"
WORD_TOKEN = rf"[{WORD}']+"
TOKEN = rf"{WORD_TOKEN}|[.,!?;:]"
# Everything but letters, digits and .,!?;:-' of ASCII. Listed as single characters and two
# ranges rather than negated: Java matches this form about four times faster.
STRAY = r"[\x00-\x20\"#$%&()*+/<=>@\[\\\]^_`{|}~\x7f-\x{10FFFF}]+"
# The same, for use on joined tokens: the joining space stays.
STRAY_IN_TOKENS = r"[_\x{80}-\x{10FFFF}]+"


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_ws(c: Column | str) -> Column:
    """Each tab and each newline becomes one space."""
    c = _column(c)
    return F.replace(F.replace(c, F.lit("\t"), F.lit(" ")), F.lit("\n"), F.lit(" "))


def strip_links(c: Column | str) -> Column:
    """Remove markdown links (greedy: from the first bracket to the last link)."""
    c = _column(c)
    # The literals are a precondition of any match; most texts skip the regex.
    may_match = c.contains("](http") | c.contains("www.")
    return F.when(may_match, F.regexp_replace(c, LINK, "")).otherwise(c)


def strip_mentions(c: Column | str) -> Column:
    """Remove ``/r/name`` and ``/u/name``."""
    c = _column(c)
    may_match = c.contains("/r/") | c.contains("/u/")
    return F.when(may_match, F.regexp_replace(c, MENTION, "")).otherwise(c)


def prepare(c: Column | str) -> Column:
    """The three whole-text steps that come before tokenizing."""
    return strip_mentions(strip_links(normalize_ws(c)))


def tokenize(c: Column | str) -> Column:
    """Words and single punctuation marks, in order."""
    return F.regexp_extract_all(_column(c), F.lit(TOKEN), F.lit(0))


def words(c: Column | str) -> Column:
    """Like ``tokenize`` without the punctuation marks."""
    return F.regexp_extract_all(_column(c), F.lit(WORD_TOKEN), F.lit(0))


def clean_tokens(tokens: Column | str) -> Column:
    """Drop stray characters inside each token; a token may end up empty and stays."""
    return F.transform(_column(tokens), lambda t: F.regexp_replace(t, STRAY, ""))


def lower_tokens(tokens: Column | str) -> Column:
    return F.transform(_column(tokens), F.lower)


def drop_punctuation(tokens: Column | str) -> Column:
    """Drop tokens that are nothing but one punctuation mark."""
    return F.filter(_column(tokens), lambda t: ~t.isin(*PUNCTUATION_TOKENS))


def join_tokens(tokens: Column | str) -> Column:
    return F.array_join(_column(tokens), " ")


def clean_joined(tokens: Column | str) -> Column:
    """``clean_tokens`` + ``lower_tokens`` + ``join_tokens`` for tokens made by ``tokenize``.

    Such tokens hold no spaces, so one regex over the joined text cleans them all.
    """
    return F.lower(F.regexp_replace(join_tokens(tokens), STRAY_IN_TOKENS, ""))


def split_joined(joined: Column | str, tokens: Column | str) -> Column:
    """Undo ``join_tokens``, keeping empty tokens; ``tokens`` tells none from one empty."""
    none = F.array().cast("array<string>")
    return F.when(F.size(_column(tokens)) == 0, none).otherwise(F.split(_column(joined), " "))
