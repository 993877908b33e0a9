"""License scans: an exact set-similarity join of windows of words against license templates.

A block is so many consecutive words of a text as the template has, and a quarter more (``SLACK``) for marks of comments
between wrapped lines; lines don't matter. It meets a template if it holds at least ``threshold`` of the template's distinct words,
those that stand in any text (``COMMON``) left out, which for up to twelve words means all. Words are ordered by
how many lines of the whole corpus hold them, rarest first. A block that holds ``o = ceil(threshold * |T|)`` of a template's words
must hold one of the first ``|T| - o + 1`` of them (prefix filter), the text must have o of its words within reach of that
one (length filter), and o of them must be no rarer than it, as blocks with a rarer one are found there (positional filter).
What passes is verified window by window, so nothing is missed.

Beside it each place is counted where a base phrase's words stand consecutively.

Templates and phrases are parameters in code, hence of bounded size; only they and their words' counts are sent
to tasks. Texts stay where they are: two scans, and the only shuffle is of one count per template word and task.

Nulls and edges: a null text is empty (no words, no labels, score 0); a very long text is scanned whole, its words' places in
arrays of its length; words that are equally frequent are ordered by their bytes, which changes no result; a null doc_id is passed on; repeated rows
give repeated rows; an empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm._session import table
from shelfmark.llm._text import ALNUM, LOWER, pieces, spans, word_hashes

#: The base phrases.
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

#: Notices by which licenses are usually granted.
TEMPLATES = (
    ("agpl-3", "licensed under the GNU Affero General Public License version 3"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("apache-2", "Apache License 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("gpl-2", "licensed under the GNU General Public License version 2"),
    ("gpl-3", "licensed under the GNU General Public License version 3"),
    ("lgpl-3", "licensed under the GNU Lesser General Public License version 3"),
    ("mit", "Released under the MIT License"),
    ("mit", "MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("mpl-2", "subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)
THRESHOLD = 0.92
#: A block has this share of the template's words more, and one at least.
SLACK = 0.25
#: Words of templates that any text holds.
COMMON = ("a", "and", "any", "by", "in", "into", "is", "of", "or", "the", "this", "to", "with")

SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def _words(text: str) -> list[bytes]:
    raw = text.encode().translate(LOWER)
    return [raw[a:b] for a, b in zip(*spans(raw, ALNUM), strict=True)]


def _content(text: str) -> frozenset[bytes]:
    return frozenset(_words(text)) - {w.encode() for w in COMMON}


def _width(text: str) -> int:
    n = len(_words(text))
    return n + max(1, math.floor(SLACK * n))


def _hash(words: Sequence[bytes]) -> np.ndarray:
    raw = b" ".join(words)
    return word_hashes(raw, *spans(raw, ALNUM))


def _blocks(buf: bytes, starts: np.ndarray) -> np.ndarray:
    """The line of each word. A newline also parts the texts of a piece."""
    return np.searchsorted(np.flatnonzero(np.frombuffer(buf, np.uint8) == 10), starts)


def word_block_counts(docs: DataFrame, words: Sequence[bytes]) -> dict[bytes, int]:
    """In how many blocks of all texts each of these words stands (sums over tasks; one row for each word)."""
    order = np.argsort(hashes := _hash(words))
    known = hashes[order]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(words), np.int64)
        for batch in batches:
            for _, buf, _ in pieces(batch.column(0).to_pylist()):
                starts, ends = spans(buf, ALNUM)
                found, at = _known(word_hashes(buf, starts, ends), known)
                pair = np.unique(_blocks(buf, starts[found]) * len(words) + at)
                total += np.bincount(pair % len(words), minlength=len(words))
        yield pa.RecordBatch.from_arrays([pa.array(order.astype(np.int32)), pa.array(total)], names=["w", "n"])

    rows = docs.select("text").mapInArrow(count, "w int, n long").groupBy("w").agg(F.sum("n").alias("n")).collect()
    return {w: 0 for w in words} | {words[r.w]: r.n for r in rows}


def _known(hashes: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the hashes that are known, and where among the known (sorted) ones."""
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    found = np.flatnonzero(known[at] == hashes)
    return found, at[found]


def scan_licenses(
    docs: DataFrame,
    templates: Iterable[tuple[str, str]] = TEMPLATES,
    phrases: Iterable[tuple[str, str]] = PHRASES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """A row for each document: see SCHEMA. score is the largest share of a template's words in one block among
    the matches (1 where a base phrase stands, 0 without any)."""
    sets = [(label, content, _width(text)) for label, text in templates if (content := _content(text))]
    words = sorted(set().union(*(s for _, s, _ in sets)))
    counts = word_block_counts(docs, words) if words else {}
    ranked = sorted(words, key=lambda w: (counts[w], w))
    rank = {w: i for i, w in enumerate(ranked)}
    needs = [max(1, math.ceil(threshold * len(s) - 1e-9)) for _, s, _ in sets]
    ordered = [sorted(rank[w] for w in s) for _, s, _ in sets]
    #: rank of a prefix word -> templates
    posts: dict[int, list[int]] = {}
    for t, ranks in enumerate(ordered):
        for r in ranks[: len(ranks) - needs[t] + 1]:
            posts.setdefault(r, []).append(t)
    hashes = _hash(ranked) if ranked else np.empty(0, np.uint64)
    by_hash = np.argsort(hashes)
    known, is_prefix = hashes[by_hash], np.isin(by_hash, list(posts))
    members = [np.isin(np.arange(len(ranked)), x) for x in ordered]
    phrase_hashes = [(label, _hash(_words(text))) for label, text in phrases]

    def widest(ranks: np.ndarray, t: int, rarest: int) -> int:
        """The most of a template's words, none rarer than a given one, in a block of these words (ranks; -1 for any other word)."""
        mine = np.flatnonzero((ranks >= rarest) & members[t][ranks])
        if len(np.unique(ranks[mine])) < needs[t]:
            return 0
        last, best = {}, 0
        for i in mine.tolist():
            last[int(ranks[i])] = i
            best = max(best, sum(j > i - sets[t][2] for j in last.values()))
        return best

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            n = len(texts)
            n_words, n_base = np.zeros(n, np.int64), np.zeros(n, np.int64)
            low, high = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
            base, more, score = [set() for _ in range(n)], [set() for _ in range(n)], np.zeros(n)
            for first, buf, begins in pieces(texts):
                starts, ends = spans(buf, ALNUM)
                found = word_hashes(buf, starts, ends)
                edge = np.searchsorted(starts, [*begins, len(buf) + 1])
                n_words[first : first + len(begins)] = np.diff(edge)
                for label, phrase in phrase_hashes:
                    last = len(found) - len(phrase) + 1
                    hit = np.flatnonzero(found[: max(0, last)] == phrase[0])
                    for j in range(1, len(phrase)):
                        hit = hit[found[hit + j] == phrase[j]]
                    doc = np.searchsorted(edge, hit, "right") - 1
                    inside = hit + len(phrase) <= edge[np.minimum(doc + 1, len(edge) - 1)]
                    for i, d in zip(hit[inside].tolist(), doc[inside].tolist(), strict=True):
                        k, at = first + d, i - int(edge[d])
                        n_base[k] += 1
                        low[k] = at if low[k] < 0 else min(low[k], at)
                        high[k] = max(high[k], at)
                        base[k].add(label)
                        score[k] = 1.0
                if len(known):
                    at = np.minimum(np.searchsorted(known, found), len(known) - 1)
                    ranks = np.where(known[at] == found, by_hash[at], -1)
                    doc = np.searchsorted(edge, np.arange(len(found)), "right") - 1
                    for i in np.flatnonzero((ranks >= 0) & is_prefix[at]).tolist():
                        d = int(doc[i])
                        for t in posts[int(ranks[i])]:
                            a, b = max(int(edge[d]), i - sets[t][2] + 1), min(int(edge[d + 1]), i + sets[t][2])
                            if (shared := widest(ranks[a:b], t, int(ranks[i]))) >= needs[t]:
                                more[first + d].add(sets[t][0])
                                score[first + d] = max(score[first + d], shared / len(sets[t][1]))
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(n_words),
                    pa.array(n_base),
                    pa.array(low, mask=low < 0),
                    pa.array(high, mask=high < 0),
                    pa.array([",".join(sorted(x)) for x in base]),
                    pa.array([",".join(sorted(x | y)) for x, y in zip(base, more, strict=True)]),
                    pa.array(score),
                ],
                names=[x.split()[0] for x in SCHEMA.split(", ")],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scan, SCHEMA)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def _values(rows: Iterable[tuple]) -> str:
    return ", ".join("(" + ", ".join(str(x) if isinstance(x, int) else "'" + x + "'" for x in r) + ")" for r in rows)


def oracle() -> str:
    sets = [(i, label, sorted(w.decode() for w in _content(text)), _width(text)) for i, (label, text) in enumerate(TEMPLATES)]
    words = _values((i, label, w, len(s), max(1, math.ceil(THRESHOLD * len(s) - 1e-9)), width) for i, label, s, width in sets for w in s)
    phrases = _values((label, f" {text} ", text.count(" ") + 1) for label, text in PHRASES)
    return rf"""
WITH template(t, label, w, size, need, width) AS (VALUES {words}),
phrase(label, p, k) AS (VALUES {phrases}),
doc AS (SELECT row_number() OVER () AS r, doc_id,
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
listed AS (SELECT r, doc_id, text, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM doc),
placed AS (SELECT r, unnest(range(len(ws))) AS i, ws FROM listed),
base AS (SELECT r, i, label FROM placed, phrase
  WHERE ws[i + 1] = split_part(p, ' ', 2) AND ' ' || array_to_string(ws[i + 1:i + k], ' ') || ' ' = p),
held AS (SELECT r, i, template.* FROM (SELECT r, i, ws[i + 1] AS w FROM placed) JOIN template USING (w)),
met AS (SELECT a.r, a.label, count(DISTINCT b.w) / any_value(a.size)::DOUBLE AS share FROM held a JOIN held b ON a.r = b.r AND a.t = b.t AND b.i <= a.i AND b.i > a.i - a.width
  GROUP BY a.r, a.t, a.i, a.label HAVING count(DISTINCT b.w) >= any_value(a.need)),
found AS (SELECT r, label, 1.0::DOUBLE AS share FROM base UNION ALL SELECT r, label, share FROM met)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, lo::BIGINT AS first_word, hi::BIGINT AS last_word,
  coalesce(bl, '') AS base_labels, coalesce(al, '') AS labels, coalesce(s, 0.0)::DOUBLE AS score
FROM listed
LEFT JOIN (SELECT r, count(*) AS n, min(i) AS lo, max(i) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS bl FROM base GROUP BY r) USING (r)
LEFT JOIN (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS al, max(share) AS s FROM found GROUP BY r) USING (r)
"""
