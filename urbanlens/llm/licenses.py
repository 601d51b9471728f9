"""License scan with a positional rare-token index (operator 8).

Templates (license sentences) and phrases are word sequences. The index maps every word of
theirs to its places (template, position). The document frequencies of all license words
are counted over the whole corpus. A place of a text matches a template if the IDF weight of
the template's words that stand there is at least ``MIN_SHARE`` of all, and its mandatory key
phrase stands whole.

A text is tested for a template only if it has all words of the key. Of the template's words
that it has, the rarest are looked up, as many as it takes that no place can match by the
others and one of these alone. Their postings are intersected by relative position: a place
where two of them agree is a candidate and is verified. So no match is lost. Where the
template is too short for that, one word is enough. A phrase is a template that has to stand
whole: the postings of all its words are intersected, so every place is found.

Words are runs of other characters than ASCII ones outside a-z and 0-9, after A-Z are
lower-cased; positions count words from 0.

Defined cases: a null or empty text has no words (first and last word null, empty
labels, score 0); repeated rows give equal results and count as rows in the document
frequencies; a null id is kept; equal IDF is ordered by the word (which doesn't change the result); an empty table gives
an empty result; other columns are ignored. Texts are read whole.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanlens.llm.common import texts

#: Fixed values of the contract: phrase and label.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    key: str  # mandatory phrase, part of the text


#: License sentences of this library: label, words, mandatory key phrase.
TEMPLATES = (
    Template("mit", "released under the mit license", "mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
             "permission is hereby granted"),
    Template("mit", "the software is provided as is without warranty of any kind express or implied",
             "the software is provided as is without warranty of any kind"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee "
             "is hereby granted", "permission to use copy modify and"),
    Template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2"),
    Template("gpl-3", "gnu general public license version 3", "gnu general public license version 3"),
    Template("gpl-2", "gnu general public license version 2", "gnu general public license version 2"),
    Template("gpl-3", "gnu general public license v3", "gnu general public license v3"),
    Template("gpl-2", "gnu general public license v2", "gnu general public license v2"),
    Template("lgpl", "gnu lesser general public license", "lesser general public license"),
    Template("agpl", "gnu affero general public license", "affero general public license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             "redistribution and use"),
    Template("bsd", "redistributions of source code must retain the above copyright notice",
             "redistributions of source code must retain"),
    Template("mpl-2.0", "subject to the terms of the mozilla public license version 2 0", "mozilla public license"),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             "free and unencumbered software"),
    Template("bsl-1.0", "distributed under the boost software license version 1 0", "boost software license"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("cc0", "dedicated to the public domain under cc0 1 0", "cc0 1 0"),
    *(Template(label, f"spdx license identifier {name}", f"spdx license identifier {name}") for label, name in (
        ("mit", "mit"), ("isc", "isc"), ("apache-2.0", "apache 2 0"), ("gpl-2", "gpl 2 0"), ("gpl-3", "gpl 3 0"),
        ("lgpl", "lgpl"), ("agpl", "agpl"), ("bsd", "bsd 2 clause"), ("bsd", "bsd 3 clause"), ("mpl-2.0", "mpl 2 0"),
        ("unlicense", "unlicense"), ("bsl-1.0", "bsl 1 0"), ("cc0", "cc0 1 0"))),
)
MIN_SHARE = 0.6

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_LOWER = bytes(range(256)).translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))


def words(text: str | None) -> list[bytes]:
    return _WORD.findall((text or "").encode("utf-8", "surrogatepass").translate(_LOWER))


@dataclass
class Entry:
    """A template or phrase with the weights of its words."""

    label: str
    words: list[bytes]
    weights: list[float]
    key_at: int
    key: list[bytes]
    phrase: bool

    def share(self, found: list[bytes], start: int) -> float:
        """The share of the weight that stands at its place; 0 without the key phrase."""
        at = start + self.key_at
        if at < 0 or found[at:at + len(self.key)] != self.key:
            return 0.0
        skipped = max(0, -start)
        here = found[max(0, start):start + len(self.words)]
        same = [a == b for a, b in zip(self.words[skipped:], here)]
        if not skipped and len(same) == len(self.words) and all(same):
            return 1.0
        return min(1.0, sum(x for x, eq in zip(self.weights[skipped:], same) if eq) / sum(self.weights))


class Index:
    """Places of all license words by template; ``idf`` of every license word."""

    def __init__(self, templates: tuple[Template, ...], phrases, idf: dict[bytes, float]):
        self.entries: list[Entry] = []
        self.postings: list[dict[bytes, list[int]]] = []  # template -> word -> positions
        for label, text, key, phrase in (*((t.label, t.text, t.key, False) for t in templates), *((b, p, p, True) for p, b in phrases)):
            own, key_words = words(text), words(key)
            at = next(i for i in range(len(own)) if own[i:i + len(key_words)] == key_words)
            self.entries.append(Entry(label, own, [idf.get(w, 0.0) + 1e-6 for w in own], at, key_words, phrase))
            places: dict[bytes, list[int]] = defaultdict(list)
            for i, w in enumerate(own):
                places[w].append(i)
            self.postings.append(dict(places))
        self.vocabulary = frozenset(w for e in self.entries for w in e.words)

    def candidates(self, n: int, at: dict[bytes, list[int]]) -> Iterator[int]:
        """Starts of template ``n`` at which the postings of the text's rarest words agree."""
        entry, postings = self.entries[n], self.postings[n]
        weight = {w: entry.weights[i[0]] for w, i in postings.items() if w in at}
        rest = sum(weight[w] * len(postings[w]) for w in weight)
        least, heaviest, need = (MIN_SHARE - 1e-9) * sum(entry.weights), 0.0, 2
        looked = []
        for w in sorted(weight, key=lambda w: (-weight[w], w)):
            if not entry.phrase and rest + heaviest < least:
                break
            looked.append(w)
            rest -= weight[w] * len(postings[w])
            heaviest = max(heaviest, weight[w])
        else:
            need = 2 if rest + heaviest < least else 1
        if entry.phrase:
            need = len(entry.words)
        votes: dict[int, int] = defaultdict(int)
        for w in looked:
            for i in postings[w]:
                for p in at[w]:
                    votes[p - i] += 1
        return (start for start, n in votes.items() if n >= need)

    def scan(self, text: str | None) -> dict:
        found = words(text)
        at: dict[bytes, list[int]] = defaultdict(list)
        for p, w in enumerate(found):
            if w in self.vocabulary:
                at[w].append(p)
        starts, base, labels, best = [], set(), set(), 0.0
        for n, entry in enumerate(self.entries):
            if not all(w in at for w in entry.key):
                continue
            for start in self.candidates(n, at):
                share = entry.share(found, start)
                if entry.phrase and share:
                    starts.append(start)
                    base.add(entry.label)
                if share >= MIN_SHARE:
                    labels.add(entry.label)
                    best = max(best, share)
        return {"n_words": len(found), "n_base": len(starts), "first_word": min(starts, default=None),
                "last_word": max(starts, default=None), "base_labels": ",".join(sorted(base)),
                "labels": ",".join(sorted(labels)), "score": best}


def _frequencies(vocabulary: frozenset[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, docs = dict.fromkeys(sorted(vocabulary), 0), 0
        for batch in batches:
            docs += batch.num_rows
            for text in batch.column(0):
                for w in vocabulary.intersection(words(text.as_py())):
                    counts[w] += 1
        names = ["", *(w.decode() for w in counts)]
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array([docs, *counts.values()], pa.int64())], names=["word", "n"])
    return run


_SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
           "labels string, score double")
_TYPES = {"n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(),
          "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64()}


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  templates: tuple[Template, ...] = TEMPLATES, phrases=PHRASES) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``."""
    rows = texts(docs, id_col, text_col)
    vocabulary = frozenset(w for t in (*(t.text for t in templates), *(p for p, _ in phrases)) for w in words(t))
    # a row for each license word and partition, summed before they meet
    counted = (rows.select("text").mapInArrow(_frequencies(vocabulary), "word string, n long")
               .groupBy("word").agg(F.sum("n").alias("n")).collect())
    n = {r["word"]: r["n"] for r in counted}
    total = n.pop("", 0)
    index = Index(templates, phrases, {w.encode(): math.log((total + 1) / (c + 1)) for w, c in n.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [index.scan(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([r[c] for r in out], t) for c, t in _TYPES.items())], names=["doc_id", *_TYPES])

    return rows.mapInArrow(run, _SCHEMA)
