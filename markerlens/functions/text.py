"""Column -> Column text functions (FN-4 … FN-14, FN-20 … FN-22, FN-31, FN-32).

All are built-in Spark expressions, so they stay inside whole-stage codegen. The regular
expressions are written so that Java regex (Spark) and RE2 (the DuckDB oracle) agree:
no ``\\b``, no ``(?U)``; Unicode classes are spelled with ``\\p{..}``.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# The whitespace set of Python's ``str.split()`` / ``str.strip()`` —
# tab, line feed, vertical tab, form feed, carriage return, space, the four
# separator controls 0x1C-0x1F, next-line 0x85 and every Unicode separator (Zs, Zl, Zp).
WS = r"[\t\n\x{0B}\f\r \x{1C}-\x{1F}\x{85}\p{Z}]"
NON_WS = r"[^\t\n\x{0B}\f\r \x{1C}-\x{1F}\x{85}\p{Z}]"
# A word character as Python's Unicode ``\w``: letters, numbers, underscore.
WORD = r"[\p{L}\p{N}_]"
ALPHA_TOKEN = "[a-z]+"
WORD_TOKEN = WORD + "+"
# Index tokens of the search field: words, dots allowed inside (``e.g``, ``1.5``).
SEARCH_TOKEN = WORD + r"+(\." + "?" + WORD + "+)*"
# Sentence boundary: a run of terminal punctuation.
SENTENCE_END = "[.!?]+"
# The tag vocabulary, in display order.
TAGS = ("all_caps", "exclamation_marks", "hedging", "adjectives", "unk")
def _accent_table() -> tuple[str, str]:
    """Letters whose Unicode NFD form is one base letter and combining marks, their base letters, and
    last the combining marks themselves: ``translate`` drops what has no counterpart."""
    pairs = []
    for code in range(0xC0, 0x2000):
        base, *marks = unicodedata.normalize("NFD", chr(code))
        if marks and base.isalpha() and all(unicodedata.combining(m) for m in marks):
            pairs.append((chr(code), base))
    marks = "".join(map(chr, range(0x300, 0x370)))
    return "".join(c for c, _ in pairs) + marks, "".join(b for _, b in pairs)


ACCENTED, UNACCENTED = _accent_table()


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Python ``str.strip()``: removes every whitespace character at both ends (FN-4 helper)."""
    return F.regexp_replace(_col(c), f"^{WS}+|{WS}+$", "")


def clean_key(c) -> Column:
    """FN-4 normalised dedup key: lowercase, whitespace runs to one blank, stripped."""
    return strip_ws(F.regexp_replace(F.lower(_col(c)), f"{WS}+", " "))


def is_blank(c) -> Column:
    """True when null or only whitespace (FLT-2 negated)."""
    return _col(c).isNull() | ~_col(c).rlike(NON_WS)


def before_url(c) -> Column:
    """FN-5 text before the first URL, stripped."""
    return strip_ws(F.split(_col(c), r"https?://|www\.").getItem(0))


def char_length(c) -> Column:
    """FN-6 length in code points."""
    return F.length(_col(c))


def whitespace_token_count(c) -> Column:
    """FN-7 number of whitespace-separated tokens; 0 for blank text (as Python's ``split``)."""
    return F.coalesce(F.regexp_count(_col(c), F.lit(NON_WS + "+")), F.lit(0))


def alpha_tokens(c) -> Column:
    """FN-8 lowercase ``[a-z]+`` tokens."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(ALPHA_TOKEN), 0)


def word_tokens(c) -> Column:
    """FN-9 lowercase Unicode word tokens."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(WORD_TOKEN), 0)


def search_tokens(c) -> Column:
    """SRCH-2 analyser: lowercase word tokens with inner dots, stop words kept."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(SEARCH_TOKEN), 0)


def remove_stopwords(tokens, stops) -> Column:
    """FN-10 drop tokens found in ``stops`` (a Python sequence of words).

    ``isin`` over many literals is planned as a hash-set lookup (InSet), one probe per token.
    """
    stop_list = list(dict.fromkeys(stops))
    return F.filter(_col(tokens), lambda t: ~t.isin(stop_list))


def ngrams(tokens, n: int) -> Column:
    """FN-11 consecutive n-grams joined by a blank; empty when fewer than n tokens.

    Built from n shifted slices zipped together, so the token array is read n times per row
    (never once per element inside a lambda, which would be quadratic).
    """
    t = _col(tokens)
    k = F.greatest(F.size(t) - n + 1, F.lit(0))
    if n == 1:
        return t
    if n == 2:
        return F.zip_with(F.slice(t, 1, k), F.slice(t, 2, k), lambda a, b: F.concat_ws(" ", a, b))
    zipped = F.arrays_zip(*[F.slice(t, j + 1, k).alias(f"g{j}") for j in range(n)])
    return F.transform(zipped, lambda s: F.concat_ws(" ", *[s[f"g{j}"] for j in range(n)]))


def sentence_count(c) -> Column:
    """FN-12 sentences: pieces between runs of ``. ! ?`` that hold a letter or digit."""
    pieces = F.split(_col(c), SENTENCE_END)
    return F.size(F.filter(pieces, lambda s: s.rlike(r"[\p{L}\p{N}]")))


# Social-text placeholder rules, applied in this order (URL first, number last).
# Each pair is (pattern, placeholder word).
SOCIAL_RULES = (
    (r"(https?://|www\.)[^\s]+", "URL"),
    (r"@[\p{L}\p{M}\p{N}_]+", "MENTION"),
    (r"#[\p{L}\p{M}\p{N}_]+", "HASHTAG"),
    (r"(:|;|=)-?(\)|\(|D|P|p|O|o|\|)", "SMILEY"),
    (r"[\x{1F300}-\x{1FAFF}\x{2600}-\x{27BF}]", "EMOJI"),
    (r"[+-]?\d+([.,]\d+)*", "NUMBER"),
)


def social_placeholders(c) -> Column:
    """FN-13 mention, URL, hashtag, smiley, emoji and number replaced by placeholder words."""
    out = _col(c)
    for pattern, word in SOCIAL_RULES:
        out = F.regexp_replace(out, pattern, word)
    return out


def squeeze_elongation(c) -> Column:
    """FN-14 runs of one repeated character cut to three."""
    return F.regexp_replace(_col(c), r"(.)\1{3,}", "$1$1$1")


def fold_accents(c) -> Column:
    """FN-32 accent folding: letters to their base letters, combining marks dropped. Ligatures stay."""
    return F.translate(_col(c), ACCENTED, UNACCENTED)


def preview(c, n: int = 120) -> Column:
    """FN-31 first ``n`` characters."""
    return F.substring(_col(c), 1, n)


def spans_key(spans) -> Column:
    """FN-20 canonical string of a span set: spans sorted (text, start, end), as JSON, so that no
    text can be taken for a separator."""
    s = F.array_sort(F.transform(_col(spans), lambda x: F.struct(x["text"].alias("text"), x["start"].alias("start"),
                                                                 x["end"].alias("end"))))
    return F.to_json(s)


def present(spans) -> Column:
    """FN-21 presence: non-null, non-empty span list."""
    return F.coalesce(F.size(_col(spans)) > 0, F.lit(False))
