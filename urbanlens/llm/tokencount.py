"""Unigram token counts by dynamic programming shared along a trie (operator 10).

A text's pre-tokens are its runs of other than white space, each with the word mark in
front. A pre-token's tokens are the segmentation into vocabulary pieces of the highest
total log-probability (the fewest tokens if several); a character outside the
vocabulary becomes its UTF-8 bytes. The forward score of a prefix depends on the prefix
alone, so a partition's distinct pre-tokens are walked as a trie, in sorted order: the
scores of the path to the word before are kept, and only the part below the common
prefix is computed. The count at each terminal is kept in a bounded table.

The vocabulary is a public one; pieces are ranked in its order and rank r has the
log-probability -ln(r + 10) (Zipf's law), bytes that of the last rank.

Memory per task: one slice of texts with its distinct pre-tokens, one path, the table.

Defined cases: a null or empty text, or one of white space, has no tokens; repeated rows
give equal counts; a null id is kept; an empty table gives an empty result; other
columns are ignored. Texts are counted whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame

from urbanlens.llm.common import texts

MARK = "▁"
SLICE_CHARS = 4 << 20
TABLE = 500_000


def piece_scores(model_path: str) -> tuple[dict[str, float], float]:
    """piece -> log-probability, and that of a byte."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    usual = [i for i in range(model.get_piece_size())
             if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    scores = {model.id_to_piece(i): -math.log(r + 10) for r, i in enumerate(usual)}
    return scores, -math.log(len(usual) + 10)


class Counter:
    def __init__(self, scores: dict[str, float], byte: float):
        self.scores, self.byte = scores, byte
        # endings of pieces: no longer piece can end here if this is not one of them
        self.endings = {p[i:] for p in scores for i in range(len(p))}
        self.table: dict[str, int] = {}

    def learn(self, words: list[str]) -> None:
        """Counts of the distinct words, which must be sorted."""
        best, count, before = [0.0], [0], ""
        for word in words:
            marked = MARK + word
            shared = len(commonprefix((marked, before)))
            del best[shared + 1:], count[shared + 1:]
            for end in range(shared + 1, len(marked) + 1):
                n = len(marked[end - 1].encode("utf-8", "surrogatepass"))
                score, tokens = best[end - 1] + n * self.byte, count[end - 1] + n
                if (own := self.scores.get(marked[end - 1])) is not None:
                    score, tokens = best[end - 1] + own, count[end - 1] + 1
                start = end - 2
                while start >= 0 and marked[start:end] in self.endings:
                    if (own := self.scores.get(marked[start:end])) is not None:
                        s, t = best[start] + own, count[start] + 1
                        if s > score or (s == score and t < tokens):
                            score, tokens = s, t
                    start -= 1
                best.append(score)
                count.append(tokens)
            before = marked
            self.table[word] = count[-1]

    def counts(self, split: list[list[str]]) -> list[int]:
        new = set().union(*split)
        if len(self.table) + len(new) > TABLE:
            self.table.clear()
        self.learn(sorted(w for w in new if w not in self.table))
        at = self.table.__getitem__
        return [sum(map(at, words)) for words in split]


def _slices(column) -> Iterator[list[str]]:
    out, size = [], 0
    for value in column:
        text = value.as_py() or ""
        out.append(text)
        size += len(text)
        if size >= SLICE_CHARS:
            yield out
            out, size = [], 0
    if out:
        yield out


def _count(model_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(*piece_scores(model_path))
        for batch in batches:
            n_words, n_tokens = [], []
            for part in _slices(batch.column(1)):
                split = [t.split() for t in part]
                n_words += map(len, split)
                n_tokens += counter.counts(split)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64())],
                names=["doc_id", "n_pretokens", "n_tokens"])
    return run


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_pretokens, n_tokens``, one row per document, without a shuffle."""
    return texts(docs, id_col, text_col).mapInArrow(_count(model_path), "doc_id long, n_pretokens long, n_tokens long")
