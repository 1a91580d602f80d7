"""Suffix stemming as one SQL expression over a token array: no shuffle, no Python per token."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from verdex.functions.stem_rules import STEPS, Rule


def quoted(word: str) -> str:
    return "'" + word.replace("\\", "\\\\").replace("'", "\\'") + "'"


def step_sql(word: str, rules: Sequence[Rule]) -> str:
    """The word after the first rule of the step that applies, or the word itself.

    Rules are grouped by the last letter of their suffix, so a word is tried only against rules
    it can match; rules of different groups exclude each other, so the order is kept.
    """
    by_letter: dict[str, list[str]] = {}
    for rule in rules:
        size = len(rule.suffix)
        fits = f"endswith({word}, {quoted(rule.suffix)}) AND length({word}) >= {size + rule.min_stem}"
        if rule.exceptions:
            fits += f" AND {word} NOT IN ({', '.join(map(quoted, rule.exceptions))})"
        cut = f"left({word}, length({word}) - {size})"
        value = f"concat({cut}, {quoted(rule.replacement)})" if rule.replacement else cut
        by_letter.setdefault(rule.suffix[-1], []).append(f"WHEN {fits} THEN {value}")
    groups = (
        f"WHEN endswith({word}, {quoted(letter)}) THEN CASE {' '.join(tried)} ELSE {word} END"
        for letter, tried in by_letter.items()
    )
    return f"CASE {' '.join(groups)} ELSE {word} END" if by_letter else word


def stem_words(words: str, steps: Mapping[str, Sequence[Rule]] = STEPS) -> Column:
    """Stem every word of the array column `words` (a column name or SQL expression).

    Each step is a `transform` of its own, so a word's intermediate form is computed once however
    many rules look at it.
    """
    sql = words
    for name, ending in (("plural", "s"), ("feminine", "a"), ("augmentative", ""), ("adverb", "")):
        step = step_sql("w", steps[name])
        if ending:
            step = f"CASE WHEN endswith(w, {quoted(ending)}) THEN {step} ELSE w END"
        sql = f"transform({sql}, w -> {step})"
    sql = f"transform({sql}, w -> struct(w AS w, {step_sql('w', steps['noun'])} AS v))"
    verb = f"CASE WHEN t.v <> t.w THEN t.v ELSE {step_sql('t.w', steps['verb'])} END"
    sql = f"transform({sql}, t -> struct(t.w AS w, {verb} AS v))"
    sql = f"transform({sql}, t -> CASE WHEN t.v <> t.w THEN t.v ELSE {step_sql('t.w', steps['vowel'])} END)"
    return F.expr(sql)
