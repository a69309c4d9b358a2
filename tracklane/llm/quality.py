"""Quality rules with risk-controlled thresholds.

A document has fixed measures, a base rule, and a junk share between 0 and 1. How large a
junk share may be is not guessed: labelled documents say how often each of a falling row
of cutoffs would reject a good one. In each stratum (language) the cutoffs are tested in
that order with the exact binomial tail, and testing stops at the first that is not
certified (fixed-sequence testing). The strata share the error rate evenly (Bonferroni).
With probability ``1 - error_rate`` no stratum loses more than ``max_false_rejection`` of
its good documents to its cutoff. A stratum with too few labels rejects none by it.

The cutoffs are fixed in advance and the labels serve for testing only, so all of them
are holdout. Only built-in functions are used.

Defined cases: a null text has no words and fails the base rule; null is a stratum of
its own; labels without quality and labels of unknown documents do not count; a document
with repeated labels counts once for each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracklane.session import settle

#: White space between words, and the symbols that are counted.
SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
CUTOFFS = tuple(round(0.95 - 0.05 * k, 2) for k in range(18))
#: Strata that are sent to every task; a larger table of strata is joined by shuffle.
BROADCAST_STRATA = 10_000


def _bind(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _words(text: Column) -> Column:
    bare = F.btrim(text, F.lit(SPACE))
    return F.when(F.length(bare) > 0, F.split(bare, r"[\x20\x09-\x0D]+")).otherwise(
        F.array().cast("array<string>")
    )


def _repeated_words(words: Column) -> Column:
    """Words that lie in a window of five found at least twice in the text."""

    def covered(places: Column) -> Column:
        # windows that begin less than five words apart overlap
        return F.aggregate(
            places,
            F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
            lambda s, p: F.struct(
                (s["n"] + F.least(F.lit(WINDOW), p - s["last"])).alias("n"), p.alias("last")
            ),
            lambda s: s["n"],
        )

    def places(windows: Column) -> Column:
        marked = F.sort_array(
            F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i")))
        )

        def pick(rows: Column) -> Column:
            alike = F.filter(
                rows,
                lambda r, i: (
                    F.when(i > 0, F.get(rows, i - 1)["w"] == r["w"]).otherwise(F.lit(False))
                    | F.coalesce(F.get(rows, i + 1)["w"] == r["w"], F.lit(False))
                ),
            )
            return F.sort_array(F.transform(alike, lambda r: r["i"]))

        return _bind(marked, pick)

    def count(windows: Column) -> Column:
        # most texts repeat no window; only the others are sorted
        return F.when(
            F.size(F.array_distinct(windows)) < F.size(windows), covered(places(windows))
        ).otherwise(F.lit(0))

    def windows(numbers: Column) -> Column:
        return F.transform(
            F.slice(numbers, F.lit(1), F.size(numbers) - (WINDOW - 1)),
            lambda n, i: F.xxhash64(n, *[F.get(numbers, i + k) for k in range(1, WINDOW)]),
        )

    numbers = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(
        F.size(words) > WINDOW,
        _bind(numbers, lambda n: _bind(windows(n), count)),
    ).otherwise(F.lit(0))


def _count_of(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def measures(text: Column) -> dict[str, Column]:
    """Measures of a text that is not null, in one pass over its row."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    n_words = F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))
    return {
        "n_words": n_words.cast("long"),
        "word_chars": F.length(F.translate(text, SPACE, "")).cast("long"),
        "n_symbols": _count_of(text, SYMBOLS).cast("long"),
        "n_capitals": _count_of(text, CAPITALS).cast("long"),
        "n_shouts": _count_of(text, "!").cast("long"),
        "n_dup_lines": _bind(
            lines, lambda x: F.size(x) - F.size(F.array_distinct(x))
        ).cast("long"),
        "n_repeat_words": _bind(_words(text), _repeated_words).cast("long"),
    }


def junk_share() -> Column:
    """From the measures: the largest of symbols per word, exclamation marks per word and
    the share of capitals among characters; at most 1."""
    per_word = F.greatest(F.lit(1), F.col("n_words"))
    return F.least(
        F.lit(1.0),
        F.greatest(
            F.col("n_symbols") / per_word,
            F.col("n_shouts") / per_word,
            F.col("n_capitals") / F.greatest(F.lit(1), F.col("word_chars")),
        ),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """Exact P(X <= k) of a binomial(n, p) for k below its mean, else 1.

    The terms follow from each other; logarithms keep them from vanishing.
    """
    first = n * F.log1p(F.lit(-p))
    odds = F.log(F.lit(p)) - F.log1p(F.lit(-p))
    total = F.aggregate(
        F.sequence(F.lit(1).cast("long"), F.greatest(k, F.lit(1))),
        F.struct(first.alias("term"), F.exp(first).alias("sum")),
        lambda s, j: _bind(
            s["term"] + odds + F.log((n - j + 1).cast("double")) - F.log(j.cast("double")),
            lambda t: F.struct(t.alias("term"), (s["sum"] + F.exp(t)).alias("sum")),
        ),
        lambda s: s["sum"],
    )
    return F.when(k >= n * p, F.lit(1.0)).when(k <= 0, F.exp(first)).otherwise(total)


def certified_cutoffs(
    scored: DataFrame,
    labels: DataFrame,
    stratum: str = "stratum",
    max_false_rejection: float = 0.01,
    error_rate: float = 0.05,
    cutoffs: Sequence[float] = CUTOFFS,
    id_col: str = "doc_id",
    quality_col: str = "quality",
) -> DataFrame:
    """stratum, cutoff: the lowest certified cutoff of each stratum that has one.

    ``scored`` has the id, the stratum and ``junk`` of documents that pass the base rule.
    """
    good = labels.where(F.col(quality_col) == 1).select(F.col(id_col).alias("label_id"))
    tested = (
        scored.join(good, F.col(id_col) == F.col("label_id"))
        .groupBy(F.col(stratum).alias("stratum"))
        .agg(
            F.count("*").alias("n"),
            *[F.count_if(F.col("junk") > c).alias(f"over_{i}") for i, c in enumerate(cutoffs)],
        )
    )
    rows = tested.select(
        "stratum",
        "n",
        F.count("*").over(Window.partitionBy()).alias("strata"),
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(i).alias("step"), F.lit(float(c)).alias("cutoff"),
                             F.col(f"over_{i}").alias("rejected"))
                    for i, c in enumerate(cutoffs)
                ]
            )
        ),
    )
    tail = binomial_tail(F.col("n"), F.col("rejected"), max_false_rejection)
    in_order = Window.partitionBy("stratum").orderBy("step")
    return (
        rows.withColumn("passed", tail * F.col("strata") <= error_rate)
        .withColumn("all_passed", F.min("passed").over(in_order))
        .where("all_passed")
        .groupBy("stratum")
        .agg(F.min("cutoff").alias("cutoff"))
    )


def _judged(scored: DataFrame, cutoffs: DataFrame) -> DataFrame:
    cutoffs = settle(cutoffs)
    if cutoffs.count() <= BROADCAST_STRATA:
        cutoffs = F.broadcast(cutoffs)
    at = scored["stratum"].eqNullSafe(cutoffs["stratum"])
    return scored.join(cutoffs, at, "left").select(
        *[scored[c] for c in scored.columns],
        (~F.col("base_failed") & ~F.coalesce(F.col("junk") > F.col("cutoff"), F.lit(False)))
        .alias("kept"),
    )


def _scored(docs: DataFrame, carry: dict[str, Column], text_col: str, stratum_col: str):
    names = measures(F.lit(None).cast("string"))
    rows = docs.select(
        *[c.alias(name) for name, c in carry.items()],
        F.col(stratum_col).alias("stratum"),
        F.coalesce(F.col(text_col), F.lit("")).alias("__text"),
    )
    found = measures(F.col("__text"))
    rows = rows.select(
        *carry, "stratum", *[found[name].alias(name) for name in names]
    )
    return rows.withColumn("base_failed", base_failed()).withColumn("junk", junk_share())


def judge(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    stratum_col: str = "lang",
    max_false_rejection: float = 0.01,
    error_rate: float = 0.05,
) -> DataFrame:
    """Per document: doc_id, stratum, the measures, base_failed, junk and kept."""
    scored = settle(_scored(docs, {"doc_id": F.col(id_col)}, text_col, stratum_col))
    good = labels.select(F.col(id_col).alias("doc_id"), "quality")
    cutoffs = certified_cutoffs(
        scored.where("not base_failed"), good, "stratum", max_false_rejection, error_rate
    )
    return _judged(scored, cutoffs)


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    stratum_col: str = "lang",
    max_false_rejection: float = 0.01,
    error_rate: float = 0.05,
) -> DataFrame:
    """The rows of documents that are kept, whole and with all columns."""
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    scored = _scored(
        docs, {"doc_id": F.col(id_col), "carry": row}, text_col, stratum_col
    )
    cutoffs = certified_cutoffs(
        scored.where("not base_failed").select("doc_id", "stratum", "junk"),
        labels.select(F.col(id_col).alias("doc_id"), "quality"),
        "stratum", max_false_rejection, error_rate,
    )
    kept = _judged(scored, cutoffs).where("kept")
    return kept.select(*[F.col(f"carry.c{i}").alias(c) for i, c in enumerate(docs.columns)])
