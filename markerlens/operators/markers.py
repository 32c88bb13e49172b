"""Rule-based marker extraction (MRK-1…6) and the span operators built on it (FN-15, FN-18,
FN-30, AGG-22, AGG-23).

The fixed rules are whole-token regular expressions (lookarounds keep a match to a maximal
ASCII letter run); only the matches are exploded, and ``split`` by the same expression gives
the gaps, so a running sum over the matches of one text yields the character offsets.
Word lists of any size are matched by ``lexicon_match``. Output is the flat span shape
``(doc_id, feature, text, start, end)``, which can join the annotation tables as one more
annotator.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from markerlens.functions.lexicons import ADJECTIVE_SUFFIXES
from markerlens.functions.text import TAGS
from markerlens.operators.lexicon_match import lexicon_spans
from markerlens.operators.spans import laid_out, non_overlapping

PIECE = "[a-zA-Z]+|!+|[^a-zA-Z!]+"
ADJECTIVE = "^[a-zA-Z]+(" + "|".join(ADJECTIVE_SUFFIXES) + ")$"

# Largest lexicon / acronym table broadcast by row count; larger ones go through a shuffle join.
MAX_BROADCAST_ROWS = 1_000_000


def sized_join(big: DataFrame, small: DataFrame, on, how: str = "inner",
               max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Join with ``small`` broadcast when its row count is under ``max_rows`` (checked), else a
    regular shuffle join."""
    n = small.limit(max_rows + 1).count()
    side = F.broadcast(small) if n <= max_rows else small
    return big.join(side, on, how)


# Whole-token forms of the word rules (Java regex; a token is a maximal ASCII letter run).
CAPS_RUN = "(?=[A-Z]{2})(?<![a-zA-Z])[A-Z]{2,}+(?![a-zA-Z])"
# A whole letter run, then a look back at its ending: no run is tried letter by letter.
ADJECTIVE_RUN = "(?<![a-zA-Z])[a-zA-Z]++(?<=[a-zA-Z](?i:" + "|".join(ADJECTIVE_SUFFIXES) + "))"
EXCLAMATION_RUN = "!+"


def regex_spans(df: DataFrame, pattern: str, feature: str, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """(doc, feature, text, start, end) of every match of ``pattern``, exploding the matches only.

    ``split`` by the same pattern gives the gaps between matches, so the end of match i is the length of gaps 0..i
    and matches 0..i, summed inside the row (``laid_out``): no text passes an exchange.
    """
    m = F.regexp_extract_all(F.col(text), F.lit(pattern), 0)
    gaps = F.transform(F.split(F.col(text), pattern), lambda g: F.length(g))
    return laid_out(df, doc, {"m": m, "gap": gaps}, "m").select(doc, F.lit(feature).alias("feature"), F.col("m").alias("text"),
                                           (F.col("_end") - F.length("m")).cast("int").alias("start"), F.col("_end").alias("end"))


def marker_spans(df: DataFrame, lexicon: DataFrame, text: str = "text", doc: str = "doc_id",
                 acronyms: DataFrame | None = None, profanity: DataFrame | None = None,
                 hedge_match: str = "exact") -> DataFrame:
    """MRK-1…5 spans ``(doc, feature, text, start, end)``.

    lexicon: (category, term) hedge terms, words or phrases, matched whole or by root
    (``hedge_match='root'``); acronyms: (term) upper-case words that are not all-caps markers;
    profanity: (term) words or phrases for ``unk``. Lists may have any size (``lexicon_match``).
    """
    caps = regex_spans(df, CAPS_RUN, "all_caps", text, doc)
    if acronyms is not None:
        caps = sized_join(caps, acronyms.select(F.col("term").alias("text")).distinct(), "text", "left_anti")
    parts = [regex_spans(df, EXCLAMATION_RUN, "exclamation_marks", text, doc), caps.select(
        doc, "feature", "text", "start", "end"), regex_spans(df, ADJECTIVE_RUN, "adjectives", text, doc),
        lexicon_spans(df, lexicon, "hedging", hedge_match, text, doc)]
    if profanity is not None:
        parts.append(lexicon_spans(df, profanity, "unk", "exact", text, doc))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def marker_counts(docs: DataFrame, spans: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts per document and feature as five columns, plus MRK-6 density (count / length)."""
    counts = (spans.groupBy(doc).pivot("feature", list(TAGS)).agg(F.count(F.lit(1))))
    base = docs.select(doc, F.length(text).alias("n_chars")).join(counts, doc, "left")
    cols = [doc, "n_chars"]
    for t in TAGS:
        c = F.coalesce(F.col(t), F.lit(0)).cast("long")
        cols += [c.alias(f"n_{t}"),
                 F.when(F.col("n_chars") > 0, c / F.col("n_chars")).otherwise(F.lit(0.0)).alias(f"density_{t}")]
    return base.select(*cols)


def marker_flags(counts: DataFrame, doc: str = "doc_id") -> DataFrame:
    """FN-15 five 0/1 flags and FN-18 the present tags in fixed tag order."""
    flags = [(F.col(f"n_{t}") > 0).cast("int").alias(f"{t}_bin") for t in TAGS]
    present = F.filter(F.array(*[F.when(F.col(f"n_{t}") > 0, F.lit(t)) for t in TAGS]), lambda x: x.isNotNull())
    return counts.select(doc, *flags, present.alias("tags"))


def tag_distribution(flags: DataFrame, tags: Sequence[str] = TAGS) -> DataFrame:
    """AGG-22 number of documents carrying each tag, zero-filled, and AGG-23 share of maximum."""
    per_tag = flags.select(F.explode("tags").alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("n"))
    all_tags = flags.sparkSession.createDataFrame([(t, i) for i, t in enumerate(tags)], "tag string, tag_order int")
    # all_tags has len(tags) rows: broadcast is bounded by the tag vocabulary.
    dist = F.broadcast(all_tags).join(per_tag, "tag", "left").select(
        "tag", "tag_order", F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"))
    w = Window.partitionBy()  # over the tag table only (one row per tag)
    return dist.withColumn("share_of_max", F.col("n") / F.greatest(F.max("n").over(w), F.lit(1)) * 100)


def resolve_spans(spans: DataFrame, doc: str = "doc_id", tag: str = "feature") -> DataFrame:
    """FN-30 the spans (doc, start, end, tags) that stay when overlapping ones go (``spans.non_overlapping``)."""
    return non_overlapping(spans, doc, tag)
