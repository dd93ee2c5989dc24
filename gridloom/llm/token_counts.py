"""Token counts under a unigram model, by dynamic programming that pre-tokens share in a trie.

A pre-token is a run without white space, with the mark U+2581 before it.  Its
segmentation is the one with the highest sum of piece scores, of equal ones that
with fewer pieces.  The best score of a prefix does not depend on what follows,
so distinct pre-tokens are inserted into a trie and every node, a shared prefix,
is computed once; the count at a terminal node is the pre-token's.

Scores are read from a table of pieces and log-probabilities (``.vocab`` or
``.tsv``), as unigram tokenizers come with.  For a public vocabulary without
such scores they are log-probabilities by rank (Zipf); no tokenizer is trained.
A character outside the vocabulary costs one piece for each of its bytes.

The trie belongs to a Python worker and starts anew at ``NODES`` nodes, which
changes no result.  Pre-tokens beyond ``LONG`` characters are computed without it.

Defined results: a null or empty text has no tokens; repeated rows are counted
each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
NODES, LONG, BATCH = 1_500_000, 48, 512

_tries: dict[str, Trie] = {}


def scores_of(path: str) -> dict[str, float]:
    """Pieces with their scores: a table ``piece<tab>score`` as it is (controls and bytes, in angle brackets, left out), or the pieces of a
    sentencepiece vocabulary (its bytes and controls left out) with log(1 / rank), normalised."""
    if path.endswith((".vocab", ".tsv")):
        with open(path, encoding="utf-8") as lines:
            rows = (line.rstrip("\n").split("\t") for line in lines if line.strip("\n"))
            return {piece: float(score) for piece, score in rows if not (piece.startswith("<") and piece.endswith(">") and len(piece) > 2)}
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
    total = math.log(sum(1 / r for r in range(1, len(pieces) + 1)))
    return {p: -math.log(r) - total for r, p in enumerate(pieces, 1)}


class Trie:
    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.longest = max(map(len, scores))
        self.byte = min(scores.values()) - 2.0
        self.clear()

    def clear(self) -> None:
        self.child: list[dict[str, int]] = [{}]
        self.best, self.pieces = [0.0], [0]
        self.terminal: dict[str, int] = {}

    def _step(self, token: str, d: int, best: list[float], pieces: list[int]) -> tuple[float, int]:
        """Best score and pieces of the first ``d`` characters, from those of all shorter prefixes."""
        n = len(token[d - 1].encode("utf-8", "surrogatepass"))
        top, count = best[d - 1] + n * self.byte, pieces[d - 1] + n
        get = self.scores.get
        for s in range(max(0, d - self.longest), d):
            x = get(token[s:d])
            if x is not None and ((x := x + best[s]) > top or (x == top and pieces[s] + 1 < count)):
                top, count = x, pieces[s] + 1
        return top, count

    def alone(self, token: str) -> int:
        best, pieces = [0.0], [0]
        for d in range(1, len(token) + 1):
            x, n = self._step(token, d, best, pieces)
            best.append(x)
            pieces.append(n)
        return pieces[-1]

    def insert(self, token: str) -> int:
        """Walk down the prefixes that are known, add the others, and give the count at the end."""
        node, d = 0, 0
        best, pieces = [0.0], [0]
        child = self.child
        for c in token:
            following = child[node].get(c)
            if following is None:
                break
            node = following
            d += 1
            best.append(self.best[node])
            pieces.append(self.pieces[node])
        for d in range(d + 1, len(token) + 1):
            x, n = self._step(token, d, best, pieces)
            best.append(x)
            pieces.append(n)
            child[node][token[d - 1]] = node = len(child)
            child.append({})
            self.best.append(x)
            self.pieces.append(n)
        return pieces[-1]

    def count(self, word: str) -> int:
        known = self.terminal.get(word)
        if known is None:
            if len(word) > LONG:
                return self.alone(MARK + word)
            if len(self.child) > NODES:
                self.clear()
            known = self.terminal[word] = self.insert(MARK + word)
        return known


def trie(path: str) -> Trie:
    """The trie of this Python worker for a vocabulary file."""
    if path not in _tries:
        _tries[path] = Trie(scores_of(path))
    return _tries[path]


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_pretokens, n_tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = trie(vocabulary)
        for batch in batches:
            for part in (batch.slice(i, BATCH) for i in range(0, batch.num_rows, BATCH)):
                words, tokens = [], []
                for text in part.column("text"):
                    w = (text.as_py() or "").split()
                    words.append(len(w))
                    tokens.append(sum(map(t.count, w)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], ["doc_id", "n_pretokens", "n_tokens"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_pretokens long, n_tokens long")
