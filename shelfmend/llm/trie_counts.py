"""Token counts under a unigram model, by dynamic programming over a trie of the distinct words.

The model gives every vocabulary piece a score; the tokens of a word are its segmentation with the highest sum
of scores (fewest tokens among equal sums). The best sum for a prefix depends on the prefix alone, so words
that begin alike share the work: it is done once for each trie node, and a word's node stores its token count.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, texts

_MOST_NODES, _LONGEST_STORED, _CHARACTERS = 2_000_000, 64, 0x110000


class UnigramTrie:
    """``scores`` by piece. A character without a piece of its own becomes its UTF-8 bytes, one token each, at ``byte_score``."""

    def __init__(self, scores: dict[str, float], word_start: str = "", byte_score: float = -20.0):
        self.scores, self.word_start, self.byte_score = scores, word_start, byte_score
        self.longest = max(map(len, scores), default=0)
        self.clear()

    def clear(self) -> None:
        # nodes are numbered, 0 is the root; for each the best score and fewest tokens of its prefix
        self.child: dict[int, int] = {}  # node * number of characters + character -> node
        self.best, self.tokens = array("d", [0.0]), array("i", [0])
        self.counts: dict[bytes, int] = {}

    @property
    def nodes(self) -> int:
        return len(self.tokens) - 1

    def _forward(self, word: str, end: int, best: list[tuple[float, int]]) -> tuple[float, int]:
        """Best score and tokens of ``word[:end]``, given those of its last ``longest`` shorter prefixes, shortest first."""
        best_score, fewest = -math.inf, 0
        for back, (before, tokens) in enumerate(reversed(best), 1):
            score = self.scores.get(word[end - back : end])
            if score is not None:
                score += before
                if score > best_score or (score == best_score and tokens + 1 < fewest):
                    best_score, fewest = score, tokens + 1
        if word[end - 1] not in self.scores:
            n = len(word[end - 1].encode())
            before, tokens = best[-1]
            if before + n * self.byte_score > best_score:
                best_score, fewest = before + n * self.byte_score, tokens + n
        return best_score, fewest

    def insert(self, word: str) -> int:
        """Walk to the word's node, add those that are missing, and return its token count."""
        child, node, path = self.child, 0, [0]
        for end, c in enumerate(word, 1):
            step = node * _CHARACTERS + ord(c)
            node = child.get(step)
            if node is None:
                best, tokens = self._forward(word, end, [(self.best[n], self.tokens[n]) for n in path[-self.longest :]])
                node = child[step] = len(self.tokens)
                self.best.append(best)
                self.tokens.append(tokens)
            path.append(node)
        return self.tokens[node]

    def count(self, word: bytes) -> int:
        """Token count of one word; what a prefix gave before is not computed again."""
        text = self.word_start + word.decode()
        if self.nodes > _MOST_NODES:
            self.clear()
        if len(text) > _LONGEST_STORED:  # a long word shares little; only a window of its prefixes is held
            path = [(0.0, 0)]
            for end in range(1, len(text) + 1):
                path.append(self._forward(text, end, path))
                if len(path) > self.longest:
                    del path[0]
            return path[-1][1]
        found = self.counts[word] = self.insert(text)
        return found

    def total(self, words: list[bytes]) -> int:
        found = list(map(self.counts.get, words))
        if None in found:
            found = [self.count(w) if n is None else n for w, n in zip(words, found, strict=True)]
        return sum(found)


def zipf_scores(pieces: list[str]) -> dict[str, float]:
    """Log-probabilities (up to a constant) of pieces listed from frequent to rare, by Zipf's law."""
    return {p: -math.log(rank) for rank, p in enumerate(pieces, 2)}


@lru_cache(maxsize=2)
def trie(model_path: str) -> UnigramTrie:
    """A worker's trie over the pieces of a sentencepiece file; its first ids are control and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    plain = [i for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return UnigramTrie(zipf_scores([model.id_to_piece(i) for i in plain]), word_start="▁")


def count_tokens(docs: DataFrame, model_path: str | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, ``n_words`` and ``n_tokens`` of every whole text; a null or blank text has 0 of both.

    Every row gives one row, repeated and null keys included; other columns are not read. No shuffle: each task
    keeps a trie of bounded size, and clearing it costs time but changes no count.
    """
    path = model_path or public_tokenizers.path("piece_bpe_32k.model")
    arrow_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = trie(path)
        for batch in batches:
            words = [t.split() for t in texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(w) for w in words], pa.int64()), pa.array([counts.total(w) for w in words], pa.int64())],
                names=[key, "n_words", "n_tokens"],
            )

    rows = docs.select(F.col(key).cast("long").alias(key), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"{key} long, n_words long, n_tokens long")
