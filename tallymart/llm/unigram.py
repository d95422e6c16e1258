"""Token counts by count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton enumerates every vocabulary piece that ends at each
character; dynamic programming carries only the best score and the number of
pieces up to there, no back pointers.  The rules are those of the unigram
tokenizer: a path's score is the sum of its pieces' scores; of equal scores at
one place the piece that starts earliest stays; a character that is no piece
by itself may be unknown, at the least score minus 10, and counts as its UTF-8
bytes (byte fallback).

Spaces are written as ``▁`` and the text gets one in front.  Pieces have it
only in front or consist of it, so no piece crosses from a non-space to a
space: each run of spaces with the word behind it is an independent unit, and
every distinct unit is counted once per worker while it stays in a bounded
table.

Defined results: a NULL or empty text has 0 tokens and score 0; repeated rows
are counted each; other columns pass through.
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.common import fresh, ship_package

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
#: Bytes of distinct units a worker remembers before it starts afresh, and
#: those of an entry besides its characters.
TABLE_BYTES, OVERHEAD = 192 << 20, 250
_SLICE = 128

_models: dict[str, "Unigram"] = {}


class Unigram:
    """A vocabulary of (piece, score)."""

    def __init__(self, pieces: list[tuple[str, float]]):
        for p, _ in pieces:
            if SPACE in p[1:] and p.strip(SPACE):
                raise ValueError(f"piece {p!r} crosses a space")
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for p, s in pieces:
            self.automaton.add_word(p, (len(p), s))
        if pieces:
            self.automaton.make_automaton()
        self.single = {p for p, _ in pieces if len(p) == 1}
        self.tokens: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.held = 0

    @classmethod
    def load(cls, path: str) -> "Unigram":
        """The ordinary pieces of a sentencepiece model file, read once per
        worker; control and byte pieces never match a text."""
        if path not in _models:
            from sentencepiece import SentencePieceProcessor

            sp = SentencePieceProcessor(model_file=path)
            ordinary = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_byte(i) or sp.is_unknown(i) or sp.is_unused(i))]
            _models[path] = cls([(sp.id_to_piece(i), sp.get_score(i)) for i in ordinary])
        return _models[path]

    def unit(self, text: str) -> tuple[int, float]:
        """(tokens, score) of the best path through ``text``."""
        best = [0.0] * (len(text) + 1)
        tokens = [0] * (len(text) + 1)
        done = 0  # places up to here are final, unknown characters included
        low = float("-inf")
        single, unknown = self.single, self.unknown
        found, count = low, 0
        for end, (length, score) in self.automaton.iter(text) if len(self.automaton) else ():
            if end != done:
                for i in range(done, end):
                    best[i + 1], tokens[i + 1] = self._close(text[i], best[i], tokens[i], found, count)
                    found = low
                done = end
            start = end + 1 - length
            total = best[start] + score
            if total > found:  # the longest comes first
                found, count = total, tokens[start] + 1
        for i in range(done, len(text)):
            best[i + 1], tokens[i + 1] = self._close(text[i], best[i], tokens[i], found, count)
            found = low
        return tokens[-1], best[-1]

    def _close(self, char: str, before: float, tokens: int, found: float, count: int) -> tuple[float, int]:
        if char not in self.single and before + self.unknown > found:
            return before + self.unknown, tokens + len(char.encode())
        return found, count

    def units(self, text: str) -> list[str]:
        text = text.replace(SPACE, " ")  # the sign itself stands for a space
        if "  " in text or text[0] == " " or text[-1] == " ":
            return _UNITS(SPACE + text.replace(" ", SPACE))
        return [SPACE + u for u in text.split(" ")]

    def count(self, text: str) -> tuple[int, float]:
        """(tokens, score) of a whole text."""
        if not text:
            return 0, 0.0
        units = self.units(text)
        tokens, scores = self.tokens, self.scores
        if new := set(units).difference(tokens):
            if self.held > TABLE_BYTES:
                tokens.clear()
                scores.clear()
                new, self.held = set(units), 0
            self.held += OVERHEAD * len(new) + sum(map(len, new))
            for u in new:
                tokens[u], scores[u] = self.unit(u)
        return sum(map(tokens.__getitem__, units)), sum(map(scores.__getitem__, units))


_UNITS = re.compile(f"{SPACE}+[^{SPACE}]*").findall


def counted(text: Column, path: str) -> Column:
    """Struct (n_tokens, score) of a whole text."""

    @F.arrow_udf("struct<n_tokens:bigint,score:double>")
    def run(texts: pa.Array) -> pa.Array:
        model = Unigram.load(path)
        found = []
        for at in range(0, len(texts), _SLICE):
            found += [model.count(t or "") for t in texts.slice(at, _SLICE).to_pylist()]
        tokens, scores = zip(*found) if found else ((), ())
        return pa.StructArray.from_arrays(
            [pa.array(tokens, pa.int64()), pa.array(scores, pa.float64())], names=["n_tokens", "score"]
        )

    return run(text.cast("string"))


def count_tokens(docs: DataFrame, path: str, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Every row (columns ``keep``, default all) followed by ``n_tokens`` and
    ``score``.  Names the input uses already get underscores."""
    ship_package(docs.sparkSession)
    kept = list(docs.columns if keep is None else keep)
    out = docs.select(F.struct(*kept).alias("row"), counted(F.col(text_col), path).alias("c"))
    added = [F.col("c")[c].alias(fresh(kept, c)) for c in ("n_tokens", "score")]
    return out.select(*[F.col("row")[c].alias(c) for c in kept], *added)
