"""Quality rules: one projection of ratios per text, judged by a table of thresholds.

Every measure is made of built-in functions, so the whole table is one narrow pass over
the documents without a shuffle. NULL counts as an empty text. A text without words has
every ratio 0 and fails by its length.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import BLANKS, fresh, let, word_list

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the", "and", "of", "to", "a", "in", "is", "that", "was", "it", "for", "on", "with", "as", "this", "by", "be", "are", "at", "from",
    "de", "la", "le", "et", "en", "des", "les", "un", "du", "une", "est", "pour", "que", "qui", "dans", "au", "par", "pas", "sur", "avec",
    "der", "die", "und", "von", "den", "zu", "das", "mit", "sich", "nicht", "auf", "ist", "im", "eine", "ein", "dem", "für", "er", "sie", "ich",
    "el", "las", "los", "y", "se", "del", "con", "por", "una", "no", "para", "al", "su", "es", "lo", "como", "más", "o", "pero", "sus",
)
SYMBOLS = "[#*$%&|<>]"


@dataclass(frozen=True)
class Threshold:
    """A ratio of two measures and the range in which a text passes."""

    name: str
    measure: str
    per: str
    least: float = 0.0
    most: float = float("inf")


# The production table. Limits are wide, so that ordinary prose passes.
THRESHOLDS = (
    Threshold("word_length", "word_chars", "n_words", 2.0, 15.0),
    Threshold("symbol_ratio", "n_symbols", "n_words", most=0.3),
    Threshold("stop_word_ratio", "n_stop_words", "n_words", least=0.01),
    Threshold("duplicate_line_ratio", "n_dup_lines", "n_lines", most=0.3),
)
LEAST_WORDS = 50
MOST_REPEAT_PERCENT = 50


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, b: a + b)


# Low bits of a packed value that hold a window's place.
_PLACE_BITS = 20


def _candidates(hashes: Column) -> Column:
    """Places of the windows that may have a twin: equal in the leading bits of the hash.

    Sorting plain numbers is several times cheaper than sorting (hash, place) pairs, and
    few windows are left for that. A text of more windows than places fit is taken whole.
    """
    packed = F.transform(hashes, lambda h, i: F.shiftleft(F.shiftright(h, _PLACE_BITS), _PLACE_BITS).bitwiseOR(i.cast("long")))
    same = lambda a, b: F.shiftright(a.bitwiseXOR(b), _PLACE_BITS) == 0
    twins = let(F.sort_array(packed), lambda p: F.filter(p, lambda e, j: same(F.get(p, j - 1), e) | same(F.get(p, j + 1), e)))
    places = F.transform(twins, lambda e: e.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).cast("int"))
    return F.when(F.size(hashes) > 1 << _PLACE_BITS, F.transform(hashes, lambda h, i: i)).otherwise(places)


def _covered(hashes: Column) -> Column:
    """Words inside three-word windows that occur twice or more, from the windows' hashes."""

    def by_place(ranked: Column) -> Column:
        twins = F.filter(ranked, lambda e, j: (F.get(ranked, j - 1)["h"] == e["h"]) | (F.get(ranked, j + 1)["h"] == e["h"]))
        places = F.sort_array(F.transform(twins, lambda e: e["i"]))
        return let(places, lambda p: _sum(F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3))).cast("long"))))

    ranked = F.sort_array(F.transform(_candidates(hashes), lambda i: F.struct(F.get(hashes, i).alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(let(ranked, by_place))


def _windows(words: Column) -> Column:
    """One hash for every three neighbouring words."""
    hashes = F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    return F.slice(hashes, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0)))


def _of_words(words: Column) -> Column:
    return F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.size(F.filter(words, lambda w: F.lower(w).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
        let(_windows(words), _covered).alias("n_repeat_words"),
    )


def _of_lines(lines: Column) -> Column:
    n = F.size(lines)
    return F.struct(n.cast("long").alias("n_lines"), (n - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"))


def measures(text: Column) -> Column:
    """All measures of a text as one struct of structs: words, lines, n_symbols."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    symbols = F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))
    return F.struct(let(word_list(text), _of_words).alias("words"), let(lines, _of_lines).alias("lines"), symbols.cast("long").alias("n_symbols"))


def passes(table: tuple[Threshold, ...], measured) -> Column:
    """All thresholds as one condition. ``measured`` gives a measure by name."""
    verdict = F.lit(True)
    for t in table:
        share = F.when(measured(t.per) > 0, measured(t.measure) / measured(t.per)).otherwise(F.lit(0.0))
        verdict = verdict & (share >= t.least)
        if t.most != float("inf"):
            verdict = verdict & (share <= t.most)
    return verdict


def judge(docs: DataFrame, text: str = "text", table: tuple[Threshold, ...] = THRESHOLDS, into: str = "quality") -> DataFrame:
    """``docs`` with one struct column ``into``: the measures, base_failed and kept.

    base_failed: fewer than 50 words, or over half of the words in repeated three-word
    windows. kept: neither that nor outside any threshold.
    """
    held = fresh("measured", docs)
    measured = docs.withColumn(held, measures(F.col(f"`{text}`")))
    measured = measured.withColumn(held, F.expr(f"struct({held}.words.*, {held}.lines.*, {held}.n_symbols)"))
    of = lambda name: F.col(f"{held}.{name}")
    failed = (of("n_words") < LEAST_WORDS) | (100 * of("n_repeat_words") > MOST_REPEAT_PERCENT * of("n_words"))
    verdict = F.struct(F.expr(f"{held}.*"), failed.alias("base_failed"), (~failed & passes(table, of)).alias("kept"))
    return measured.withColumn(into, verdict).drop(held)


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", table: tuple[Threshold, ...] = THRESHOLDS) -> DataFrame:
    """One row per document with its measures and verdict."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    shown = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_stop_words", "n_lines")
    return judge(rows, "text", table).select("doc_id", *[f"quality.{c}" for c in shown])


def keep_good(docs: DataFrame, text: str = "text", table: tuple[Threshold, ...] = THRESHOLDS) -> DataFrame:
    """The rows whose text passes, with their columns unchanged."""
    into = fresh("quality", docs)
    return judge(docs, text, table, into).where(F.col(f"{into}.kept")).drop(into)
