"""Plain restatements of the operators, as brute force to test against."""

from __future__ import annotations

import math
import re

from verdex.functions.stem_rules import STEPS


def paragraphs(text: str, least: int = 300) -> list[str]:
    sentences = [s.strip() for s in re.sub(r"\s+", " ", text).split(".")]
    out, current = [], ""
    for sentence in filter(None, sentences):
        current = f"{current}. {sentence}" if current else sentence
        if len(current) >= least:
            out.append(current + ".")
            current = ""
    return out + ([current + "."] if current else [])


def term_paragraphs(docs, terms):
    seen, out = set(), []
    for doc, text in docs:
        for pos, p in enumerate(paragraphs(text)):
            found = [t for t in terms if t.lower() in p.lower()]
            if found and (doc, p[:100]) not in seen:
                seen.add((doc, p[:100]))
                out.append((doc, pos, found, p))
    return out


def tokens(text: str) -> list[str]:
    return re.sub(r"[^a-zA-Zà-úÀ-Ú\s]", "", text.lower()).split()


def stem(word: str) -> str:
    def step(w, name):
        for r in STEPS[name]:
            if w.endswith(r.suffix) and len(w) >= len(r.suffix) + r.min_stem and w not in r.exceptions:
                return w[: -len(r.suffix)] + r.replacement
        return w

    if word.endswith("s"):
        word = step(word, "plural")
    if word.endswith("a"):
        word = step(word, "feminine")
    word = step(step(word, "augmentative"), "adverb")
    for name in ("noun", "verb", "vowel"):
        after = step(word, name)
        if after != word:
            return after
    return word


def grams(words: list[str]) -> list[str]:
    words = re.findall(r"(?u)\b\w\w+\b", " ".join(words))
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def tfidf(docs: list[list[str]], max_df=0.95, size=1500):
    n = len(docs)
    total, df = {}, {}
    for d in docs:
        for g in d:
            total[g] = total.get(g, 0) + 1
        for g in set(d):
            df[g] = df.get(g, 0) + 1
    kept = sorted((g for g in total if df[g] <= max_df * n), key=lambda g: (-total[g], g.encode()))[:size]
    idf = {g: math.log((1 + n) / (1 + df[g])) + 1 for g in kept}
    out = []
    for d in docs:
        w = {g: d.count(g) * idf[g] for g in set(d) if g in idf}
        norm = math.sqrt(sum(x * x for x in w.values())) or 1.0
        out.append({g: x / norm for g, x in w.items()})
    return out


def ranks(values):
    return [sum(v < x for v in values) + (sum(v == x for v in values) + 1) / 2 for x in values]
