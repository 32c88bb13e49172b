"""SQL spellings (DuckDB dialect) of the text functions, for the oracle queries.

They use the same pattern constants as ``markerlens.functions.text``, so the two engines run
the same regular expressions.
"""

from __future__ import annotations

from markerlens.functions import text as T
from markerlens.functions.lexicons import ENGLISH_STOPWORDS


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def str_list(items) -> str:
    return "[" + ", ".join(q(i) for i in items) + "]"


STOPS = str_list(ENGLISH_STOPWORDS)


def strip_ws(x: str) -> str:
    return f"regexp_replace({x}, {q('^' + T.WS + '+|' + T.WS + '+$')}, '', 'g')"


def clean_key(x: str) -> str:
    return strip_ws(f"regexp_replace(lower({x}), {q(T.WS + '+')}, ' ', 'g')")


def not_blank(x: str) -> str:
    return f"({x} IS NOT NULL AND regexp_matches({x}, {q(T.NON_WS)}))"


def ws_count(x: str) -> str:
    return f"len(regexp_extract_all({x}, {q(T.NON_WS + '+')}))"


def alpha_tokens(x: str) -> str:
    return f"regexp_extract_all(lower({x}), {q(T.ALPHA_TOKEN)})"


def word_tokens(x: str) -> str:
    return f"regexp_extract_all(lower({x}), {q(T.WORD_TOKEN)})"


def search_tokens(x: str) -> str:
    return f"regexp_extract_all(lower({x}), {q(T.SEARCH_TOKEN)})"


def no_stops(tokens: str) -> str:
    return f"list_filter({tokens}, lambda t: NOT list_contains({STOPS}, t))"


def sentence_count(x: str) -> str:
    return (f"len(list_filter(regexp_split_to_array({x}, {q(T.SENTENCE_END)}), "
            f"lambda s: regexp_matches(s, {q('[\\p{L}\\p{N}]')})))")


def bigrams(tokens: str) -> str:
    return f"list_transform(range(1, len({tokens})), lambda i: {tokens}[i] || ' ' || {tokens}[i + 1])"


def fold_accents(x: str) -> str:
    return f"translate({x}, {q(T.ACCENTED)}, {q(T.UNACCENTED)})"


def before_url(x: str) -> str:
    return strip_ws(f"regexp_split_to_array({x}, {q('https?://|www\\.')})[1]")
