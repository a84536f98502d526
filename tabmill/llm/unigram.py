"""Token counts of a unigram tokenizer, without its tokens.

An Aho-Corasick automaton lists the vocabulary pieces that end at each character; dynamic programming keeps the best score and the
number of pieces up to there. Ties are settled the tokenizer's way: of equally good pieces that end at one place the
longest wins, and a character is unknown only if no piece is that character alone. Nothing is traced back.
"""

from __future__ import annotations

import math
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame

from tabmill.llm.common import per_text

BLANK = "▁"        # stands for a space, and begins each word
UNKNOWN = 10.0          # by which an unknown character scores below the least piece
KNOWN = 1_000_000       # words of which a worker remembers the count

Vocabulary = tuple[tuple[str, float], ...]


class Counter:
    """Piece counts by word. ``fallback`` says that unknown characters become a piece per byte."""

    def __init__(self, vocabulary: Vocabulary, fallback: bool):
        self.pieces = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.pieces.add_word(piece, (len(piece) - 1, score))
        self.pieces.make_automaton()
        self.alone = {piece for piece, _ in vocabulary if len(piece) == 1}
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN
        self.fallback = fallback
        self.known: dict[str, int] = {}

    def word(self, word: str) -> int:
        """Best path through one word, from its first character on."""
        if not self.alone.issuperset(word):
            return self.word_with_unknown(word)
        score, count = [0.0], [0]
        score += [-math.inf] * len(word)
        count += [0] * len(word)
        for end, (back, own) in self.pieces.iter(word):  # by end, longest first
            start = end - back
            total = own + score[start]
            if total > score[end + 1]:
                score[end + 1], count[end + 1] = total, count[start] + 1
        return count[-1]

    def word_with_unknown(self, word: str) -> int:
        n = len(word)
        score, count, open_ = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        ends = self.pieces.iter(word)
        piece = next(ends, None)
        for done in range(n):
            best, pieces = -math.inf, 0
            while piece is not None and piece[0] == done:  # longest first
                back, own = piece[1]
                total = own + score[done - back]
                if total > best:
                    best, pieces = total, count[done - back] + 1
                piece = next(ends, None)
            unknown = word[done] not in self.alone and self.unknown + score[done] > best
            if unknown:
                best = self.unknown + score[done]
                # neighbours that are unknown are one piece, or as many as they have bytes
                pieces = count[done] + (len(word[done].encode("utf-8", "surrogatepass")) if self.fallback else not open_[done])
            score[done + 1], count[done + 1], open_[done + 1] = best, int(pieces), unknown
        return count[n]

    def text(self, text: str | None) -> int:
        """Pieces of a text, words apart: a word begins at each space, and the text begins one."""
        if not text:
            return 0
        text = text.replace(" ", BLANK)
        words = text.split(BLANK)
        if text[0] == BLANK:
            del words[0]
        known, total = self.known, 0
        if len(known) >= KNOWN:
            known.clear()
        for word in words:
            n = known.get(word)
            if n is None:
                n = known[word] = self.word(BLANK + word)
            total += n
        return total


@lru_cache(maxsize=2)
def counter(vocabulary: Vocabulary, fallback: bool) -> Counter:
    """One per worker: what it has learned of words serves later tasks."""
    return Counter(vocabulary, fallback)


def token_counts(docs: DataFrame, vocabulary: Vocabulary, fallback: bool = True) -> DataFrame:
    """``doc_id, n_chars, n_tokens`` of every whole text under a unigram vocabulary of (piece, score).

    A null or empty text has no tokens. Repeated rows give equal rows, an empty table none; other columns are not read. A very
    long word takes time in proportion to its length.
    """
    given = docs.sparkSession.sparkContext.broadcast(vocabulary)  # a vocabulary: bounded whatever the rows

    def count(doc_id: int | None, text: str | None) -> tuple:
        return doc_id, len(text or ""), counter(given.value, fallback).text(text)

    return per_text(docs, count, "doc_id long, n_chars long, n_tokens long")
