"""Quality rules as a short-circuit cascade.

Each rule's cost and selectivity are estimated on a sample, then rules run in the order of rejections
per cost: a text that an early rule rejects never meets the later ones. Whether a text is kept does not
depend on the order, only the work does (and ``failed``, the first rule that rejected it).

Only built-in functions are used, and nothing is shuffled. A null text has no words. An empty table gives
an empty result (the rules then stay in the order given). Repeated rows are each judged alike. Columns of
``docs`` named as those added are replaced.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.llm.sharding import let
from kindred.session import materialize

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
#: About how many rows the estimates of cost and selectivity use.
SAMPLE_ROWS = 2_000


class Rule(NamedTuple):
    """``rejects`` is true for a text to drop; it takes measures by name."""

    name: str
    rejects: Callable[[Mapping[str, Column]], Column]


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def _repeat_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more in the text.

    Windows are sorted with their places, so that equal ones are neighbours.
    """

    def covered(words: Column) -> Column:
        n = F.size(words)
        windows = F.arrays_zip(
            F.slice(words, F.lit(1), n - 2).alias("a"), F.slice(words, F.lit(2), n - 2).alias("b"),
            F.slice(words, F.lit(3), n - 2).alias("c"), F.sequence(F.lit(0), n - 3).alias("at"),
        )
        return let(F.sort_array(windows), lambda ordered: let(_twins(ordered), _spread))

    return F.when(F.size(words) < 4, F.lit(0)).otherwise(let(words, covered)).cast("long")


def _twins(ordered: Column) -> Column:
    """The places of windows with an equal neighbour, ascending."""
    none = F.array().cast("array<int>")
    same = lambda x, y: (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])
    pairs = F.zip_with(
        F.slice(ordered, F.lit(1), F.size(ordered) - 1),
        F.slice(ordered, F.lit(2), F.size(ordered) - 1),
        lambda x, y: F.when(same(x, y), F.array(x["at"], y["at"])).otherwise(none),
    )
    return F.sort_array(F.array_distinct(F.flatten(pairs)))


def _spread(places: Column) -> Column:
    """Words that windows of three at these places cover."""
    gaps = F.zip_with(
        F.slice(places, F.lit(1), F.size(places) - 1),
        F.slice(places, F.lit(2), F.size(places) - 1),
        lambda here, after: F.least(after - here, F.lit(3)),
    )
    return F.when(F.size(places) == 0, F.lit(0)).otherwise(F.aggregate(gaps, F.lit(3), lambda total, gap: total + gap))


def _word_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def measures(text: Column, words_of: Column | None = None) -> dict[str, Column]:
    """The measures that rules use, each from the text."""
    text = F.coalesce(text, F.lit(""))
    parts = words(text) if words_of is None else words_of
    return {
        "n_words": F.size(parts).cast("long"),
        "word_chars": F.length(F.regexp_replace(text, SPACE, "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
        "n_lines": F.size(_word_lines(text)).cast("long"),
        "n_dup_lines": let(_word_lines(text), lambda lines: F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": _repeat_words(parts),
        "n_shouts": F.regexp_count(text, F.lit("!")).cast("long"),
    }


#: Limits of the rules: shares are of words, lines or characters in words.
RULES = [
    Rule("few words", lambda m: m["n_words"] < 50),
    Rule("repeated words", lambda m: 100 * m["n_repeat_words"] > 50 * m["n_words"]),
    Rule("symbols", lambda m: 10 * m["n_symbols"] > 3 * m["n_words"]),
    Rule("long words", lambda m: m["word_chars"] > 40 * m["n_words"]),
    Rule("single letters", lambda m: 10 * m["word_chars"] < 15 * m["n_words"]),
    Rule("repeated lines", lambda m: 100 * m["n_dup_lines"] > 60 * m["n_lines"]),
    Rule("shouting", lambda m: m["n_shouts"] > m["n_words"]),
]
#: The first two, which every verdict includes.
BASE_RULES = RULES[:2]


class Estimate(NamedTuple):
    name: str
    seconds: float
    rejected: float


def estimates(docs: DataFrame, rules: list[Rule], text: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[Estimate]:
    """Cost (seconds over the sample) and share of rejections of each rule alone.

    The sample is written once, so that each rule's time is that of the rule. Its rows are drawn from
    the whole table at the rate that gives about ``sample_rows``.
    """
    total = docs.count()
    rate = min(1.0, sample_rows / max(total, 1))
    sample = materialize(docs.select(docs[text].alias("_text")).sample(rate, seed=11), "rule-sample")
    found = []
    for rule in rules:
        start = time.perf_counter()
        rejects = F.avg(rule.rejects(measures(F.col("_text"))).cast("double"))
        share = sample.agg(rejects.alias("share")).first()["share"]
        found.append(Estimate(rule.name, time.perf_counter() - start, share or 0.0))
    return found


def ordered_rules(rules: list[Rule], found: list[Estimate]) -> list[Rule]:
    """Most rejections per second first; the order given among equals."""
    worth = {e.name: e.rejected / max(e.seconds, 1e-9) for e in found}
    return sorted(rules, key=lambda rule: -worth[rule.name])


def first_failed(rules: list[Rule], known: Mapping[str, Column]) -> Column:
    """The name of the first rule that rejects, else null; later rules are not worked out."""
    cascade = F.lit(None).cast("string")
    for rule in reversed(rules):
        cascade = F.when(rule.rejects(known), F.lit(rule.name)).otherwise(cascade)
    return cascade


def _cascade(rules: list[Rule], text: Column) -> Column:
    """The first rule that rejects a text, whose words are split once for all rules."""
    return let(words(text), lambda parts: first_failed(rules, measures(text, parts)))


def judge(docs: DataFrame, rules: list[Rule] | None = None, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with ``failed`` (the first rule that rejects, in the cascade's order) and ``kept``."""
    rules = RULES if rules is None else rules
    order = ordered_rules(rules, estimates(docs, rules, text, sample_rows))
    others = [docs[name] for name in docs.columns if name not in ("failed", "kept")]
    judged = docs.select(*others, _cascade(order, docs[text]).alias("failed"))
    return judged.withColumn("kept", F.col("failed").isNull())


def passing(docs: DataFrame, rules: list[Rule] | None = None, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, as they are."""
    rules = RULES if rules is None else rules
    order = ordered_rules(rules, estimates(docs, rules, text, sample_rows))
    return docs.filter(_cascade(order, docs[text]).isNull())


def judge_with_measures(docs: DataFrame, keep: list[str], rules: list[Rule] | None = None, text: str = "text",
                        sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``keep``, every measure, ``failed`` and ``kept``: the cascade over measures that are wanted anyway.

    Kept columns named as one of those added are replaced.
    """
    rules = RULES if rules is None else rules
    order = ordered_rules(rules, estimates(docs, rules, text, sample_rows))
    given = F.struct(*[docs[name].alias(name) for name in keep]) if keep else F.lit(None)
    split = docs.select(given.alias("given"), docs[text].alias("text"), words(docs[text]).alias("words"))
    known = measures(F.col("text"), F.col("words"))
    measured = split.select("given", F.struct(*[value.alias(name) for name, value in known.items()]).alias("m"))
    judged = measured.withColumn("failed", first_failed(order, {name: F.col("m")[name] for name in known}))
    others = [F.col("given")[name].alias(name) for name in keep if name not in (*known, "failed", "kept")]
    return judged.select(*others, "m.*", "failed", F.col("failed").isNull().alias("kept"))
