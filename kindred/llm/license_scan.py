"""License scan: ordered signature rules behind a keyword prefilter.

A text is read once by an automaton of the rules' keywords; only rules whose keyword is there run their
pattern. Of overlapping detections, one that lies inside another of higher priority (or of the same
priority and longer, or equal and earlier in the rules) is suppressed. Being inside is transitive, so it
does not matter whether the outer one is itself suppressed.

A scan maps rows and shuffles nothing; a task holds one block of texts. Defined cases: a null text is
empty and an empty text has no detection; repeated rows are each scanned; an empty table gives an empty
result. Other columns are neither read nor returned.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from functools import cache
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.license_rules import EDGE, GAP, Signature, signatures
from kindred.llm.texts import LETTERS, LOWER, map_blocks, text_bytes, words_of

#: Phrases whose words stand next to each other, with the label that each always gives.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


class Detection(NamedTuple):
    start: int
    end: int
    rule: int


@cache
def _rules() -> tuple[list[Signature], ahocorasick.Automaton, re.Pattern, dict[bytes, str]]:
    rules = signatures()
    by_keyword: dict[bytes, list[int]] = {}
    for i, rule in enumerate(rules):
        for word in rule.keywords:
            by_keyword.setdefault(word, []).append(i)
    automaton = ahocorasick.Automaton()
    for word, used_by in by_keyword.items():
        automaton.add_word(word.decode("latin-1"), tuple(used_by))
    automaton.make_automaton()
    phrases = b"|".join(phrase.encode().replace(b" ", GAP) for phrase in BASE_PHRASES)
    base = re.compile(rb"(?<![" + EDGE + rb"])(?:" + phrases + rb")(?![" + EDGE + rb"])")
    first_words = {phrase.split(" ")[0].encode(): label for phrase, label in BASE_PHRASES.items()}
    return rules, automaton, base, first_words


def detect(text: bytes) -> list[Detection]:
    """All places where a rule's pattern matches a lower-cased text."""
    rules, automaton, _, _ = _rules()
    wanted = {i for _, used_by in automaton.iter(text.decode("latin-1")) for i in used_by}
    return [Detection(m.start(), m.end(), i) for i in sorted(wanted) for m in rules[i].pattern.finditer(text)]


def resolve(found: list[Detection]) -> list[Detection]:
    """What is left once contained detections are suppressed, by place."""
    rules = _rules()[0]
    levels: dict[int, dict[tuple[int, int], Detection]] = {}
    for d in found:
        same = levels.setdefault(rules[d.rule].priority, {})
        known = same.get((d.start, d.end))
        if known is None or d.rule < known.rule:
            same[d.start, d.end] = d
    kept, above = [], []  # above: of each higher level, its starts and the furthest end up to each
    for priority in sorted(levels, reverse=True):
        starts, reach, furthest = [], [], -1
        for d in sorted(levels[priority].values(), key=lambda d: (d.start, -d.end)):
            inside = furthest >= d.end
            for other_starts, other_reach in above:
                at = bisect_right(other_starts, d.start)
                inside = inside or (at > 0 and other_reach[at - 1] >= d.end)
            if not inside:
                kept.append(d)
            furthest = max(furthest, d.end)
            starts.append(d.start)
            reach.append(furthest)
        above.append((starts, reach))
    return sorted(kept)


def _scan_block(block: pa.RecordBatch) -> list[pa.Array]:
    rules, _, base, first_words = _rules()
    texts = block.column("_text")
    data, edges = text_bytes(texts)
    raw = LOWER[data].tobytes()
    words = words_of(texts, LETTERS)
    counts, firsts, lasts, base_labels, labels, scores, details = [], [], [], [], [], [], []
    for i in range(len(texts)):
        text = raw[edges[i] : edges[i + 1]]
        places = [(m.start(), first_words[re.match(rb"[a-z]+", m[0])[0]]) for m in base.finditer(text)]
        counts.append(len(places))
        if places:
            at = np.searchsorted(words.starts, [edges[i] + places[0][0], edges[i] + places[-1][0]]) - words.first[i]
        firsts.append(int(at[0]) if places else None)
        lasts.append(int(at[1]) if places else None)
        always = {label for _, label in places}
        kept = resolve(detect(text))
        base_labels.append(",".join(sorted(always)))
        labels.append(",".join(sorted(always | {rules[d.rule].label for d in kept})))
        scores.append(max((rules[d.rule].confidence for d in kept), default=0.0))
        details.append([(d.start, d.end, rules[d.rule].label, rules[d.rule].family) for d in kept])
    n_words = np.diff(words.first)
    detail_type = pa.list_(
        pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("family", pa.string())])
    )
    keys = ("start", "end", "label", "family")
    return [
        pa.array(n_words, pa.int64()), pa.array(counts, pa.int64()), pa.array(firsts, pa.int64()),
        pa.array(lasts, pa.int64()), pa.array(base_labels, pa.string()), pa.array(labels, pa.string()),
        pa.array(scores, pa.float64()),
        pa.array([[dict(zip(keys, d)) for d in row] for row in details], detail_type),
    ]


_FIELDS = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, "
    "score double, detections array<struct<start: bigint, end: bigint, label: string, family: string>>"
)


def scan(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` and for each row: words, base places (number, first and last word), labels, the best
    rule's confidence as ``score`` and the ``detections`` left (byte spans of the text)."""
    return map_blocks(docs, keep, text, _FIELDS, _scan_block)


def detections(scanned: DataFrame, key: str) -> DataFrame:
    """One row per detection of a scan."""
    return scanned.select(key, F.inline("detections"))
