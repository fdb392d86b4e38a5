"""Quality rules: one threshold table compiled into one Spark projection.

``quality_rules`` adds, per document, the base counts and the verdict; nothing
leaves the JVM, there is no shuffle and no user function. Each rule of
``RULES`` is a ratio of counts with a lowest and a highest allowed value; a
document is kept if the base test passes and every ratio is in range.

Defined cases: a null or empty text has no words, so it fails the base test. A
ratio whose denominator is 0 is 0. Repeated rows are judged one by one; an
empty table gives an empty table; extra columns pass through untouched, and a
column of the input named like a result is replaced.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nimbusmart.llm.tables import SPACES, fresh, words

# The symbols that are counted, and the most frequent function
# words of the four languages.
SYMBOLS = "[#*$%&|<>]"
SPACE = r"[ \t\n\x0B\f\r]"
STOP_WORDS = {
    "en": "the of and to in is that for it with be by as this was are on at from or a an",
    "de": "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er",
    "fr": "de la le et les des en un du une que est pour qui dans par sur au avec ce",
    "es": "de la que el en y a los se del las un por con una su para es al lo como",
}
# As written inside a sentence, at its start and in capitals.
STOP_FORMS = sorted({f for ws in STOP_WORDS.values() for w in ws.split() for f in (w, w.capitalize(), w.upper())})

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50


@dataclass(frozen=True)
class Rule:
    """``lowest <= numerator / denominator <= highest`` over the counts of a text."""

    name: str
    numerator: str
    denominator: str
    lowest: float = 0.0
    highest: float = float("inf")


# Bounds follow the usual web-text heuristics; ordinary prose is far inside.
RULES = (
    Rule("mean_word_length", "word_chars", "n_words", 3.0, 10.0),
    Rule("symbols_per_word", "n_symbols", "n_words", 0.0, 0.1),
    Rule("exclamations_per_word", "n_exclamations", "n_words", 0.0, 0.3),
    Rule("stop_word_share", "n_stop_words", "n_words", 0.06, 1.0),
    Rule("duplicate_line_share", "n_dup_lines", "n_lines", 0.0, 0.6),
    Rule("ellipsis_line_share", "n_ellipsis_lines", "n_lines", 0.0, 0.3),
    Rule("bullet_line_share", "n_bullet_lines", "n_lines", 0.0, 0.9),
)

BASE_COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _count(a: Column, keep: Callable[[Column], Column]) -> Column:
    return F.size(F.filter(a, keep))


def _characters(text: Column, klass: str) -> Column:
    """How many characters of a class the text has."""
    return F.regexp_count(text, F.lit(klass))


def _covered(positions: Column) -> Column:
    """Words in the union of the 3-word windows that start at sorted positions."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    step = lambda acc, i: F.struct(
        (i + 3).alias("end"), (acc["n"] + i + 3 - F.greatest(acc["end"], i)).alias("n")
    )
    return F.aggregate(positions, start, step, lambda acc: acc["n"])


# Up to so many different repeated windows they are looked up one by one.
FEW = 16


def _repeated_words(w: Column) -> Column:
    """Words covered by 3-word windows that occur at least twice in the text.

    Windows are compared by their 64-bit hash. Sorting the hashes shows which
    repeat. A few of them are looked up in text order; if there are many, the
    windows are sorted with their positions, so even a very long text costs
    n log n. Both ways give the same count.
    """
    window = F.transform(
        F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))),
        lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)),
    )

    def looked_up(g: Column, repeated: Column) -> Column:
        at = F.transform(g, lambda h, i: F.when(F.array_contains(repeated, h), i))
        return _covered(F.array_compact(at))

    def sorted_out(g: Column) -> Column:
        pairs = F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def positions(s: Column) -> Column:
            again = F.filter(
                s, lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"])
            )
            return F.sort_array(F.transform(again, lambda x: x["i"]))

        return _let(pairs, lambda s: _covered(positions(s)))

    def of(g: Column) -> Column:
        repeated = _let(F.sort_array(g), lambda s: F.filter(s, lambda h, k: h == F.get(s, k - 1)))
        return _let(
            repeated,
            lambda r: F.when(F.size(r) == 0, F.lit(0))
            .when(F.size(r) <= FEW, looked_up(g, r))
            .otherwise(sorted_out(g)),
        )

    return _let(window, of)


def _counts(text: Column) -> Column:
    """All counts of one text as a struct."""
    body = F.coalesce(text, F.lit(""))

    def of(w: Column, lines: Column) -> Column:
        has_word = lambda x: F.btrim(x, F.lit(SPACES)) != ""
        full = F.filter(lines, has_word)
        counts = {
            "n_words": F.size(w),
            "word_chars": F.length(body) - _characters(body, SPACE),
            "n_symbols": _characters(body, SYMBOLS),
            "n_repeat_words": _repeated_words(w),
            "n_exclamations": F.length(body) - F.length(F.replace(body, F.lit("!"), F.lit(""))),
            "n_stop_words": _count(w, lambda x: x.isin(STOP_FORMS)),
            "n_lines": F.size(full),
            "n_dup_lines": _let(full, lambda f: F.size(f) - F.size(F.array_distinct(f))),
            "n_ellipsis_lines": _count(full, lambda x: x.endswith("...") | x.endswith("…")),
            "n_bullet_lines": _count(full, lambda x: x.startswith("- ") | x.startswith("* ") | x.startswith("• ")),
        }
        return F.struct(*[c.cast("long").alias(k) for k, c in counts.items()])

    return _let(words(text), lambda w: _let(F.split(body, "\n"), lambda lines: of(w, lines)))


def _verdict(c: Column, rules: tuple[Rule, ...]) -> Column:
    ok = F.lit(True)
    for r in rules:
        ratio = F.when(c[r.denominator] == 0, F.lit(0.0)).otherwise(c[r.numerator] / c[r.denominator])
        ok = ok & (ratio >= F.lit(r.lowest)) & (ratio <= F.lit(r.highest))
    return ok


def _base_failed(c: Column) -> Column:
    return (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEATED_PERCENT * c["n_words"])


def quality_rules(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with the base counts, ``base_failed`` and ``kept``."""
    (name,) = fresh(docs, "__counts")
    c = F.col(name)
    counted = docs.withColumn(name, _counts(docs[text]))
    results = {k: c[k] for k in BASE_COLUMNS} | {"base_failed": _base_failed(c), "kept": ~_base_failed(c) & _verdict(c, rules)}
    return counted.withColumns(results).drop(name)


def quality_verdict(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Whether a text is kept, as one expression."""
    return _let(_counts(text), lambda c: ~_base_failed(c) & _verdict(c, rules))
