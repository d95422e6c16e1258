import random

import public_tokenizers as P
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import models

from awkward import docs, empty, rows
from tallymart.llm import unigram

PATH = P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def oracle():
    sp = SentencePieceProcessor(model_file=PATH)
    pieces = [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())]
    lattice = models.Unigram(vocab=pieces, unk_id=0, byte_fallback=True)
    return lambda text: len(lattice.tokenize("▁" + text.replace(" ", "▁"))) if text else 0


def test_random_texts_equal_the_library(oracle):
    model, rng = unigram.Unigram.load(PATH), random.Random(3)
    parts = ["a", "b", "the", " ", "  ", "\n", "é", "日", "😀", "▁", "ing", "1", ".", "\t", "Ω", "́", "tion", "xq", "   "]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.choice([0, 1, 3, 8, 25])))
        assert model.count(text)[0] == oracle(text), text


def exhaustive(pieces, unknown, text):
    """Best (score, tokens) over all segmentations; of equal scores at a
    place, the piece that starts earliest."""
    best = {0: (0.0, 0)}
    singles = {p for p in pieces if len(p) == 1}
    for end in range(1, len(text) + 1):
        for start in range(end):
            piece = text[start:end]
            if piece in pieces:
                step = (best[start][0] + pieces[piece], best[start][1] + 1)
            elif end - start == 1 and piece not in singles:
                step = (best[start][0] + unknown, best[start][1] + len(piece.encode()))
            else:
                continue
            if end not in best or step[0] > best[end][0]:
                best[end] = step
    return best[len(text)]


def test_ties_keep_the_earliest_start():
    pieces = {"▁": -1.0, "a": -1.0, "b": -1.0, "ab": -2.0, "aa": -2.0, "▁a": -2.0, "aba": -3.0, "bab": -2.5}
    model, rng = unigram.Unigram(list(pieces.items())), random.Random(5)
    for _ in range(500):
        text = "".join(rng.choice("aabbcé ") for _ in range(rng.randint(1, 14)))
        units = [exhaustive(pieces, model.unknown, u) for u in model.units(text)]
        assert model.count(text) == (sum(n for _, n in units), sum(s for s, _ in units)), text


def test_pieces_across_spaces_are_refused():
    with pytest.raises(ValueError):
        unigram.Unigram([("a▁b", -1.0)])


def test_awkward_rows(spark, oracle):
    frame = docs(spark).withColumnRenamed("fp", "score")
    out = unigram.count_tokens(frame, PATH)
    assert out.columns == [*frame.columns, "n_tokens", "score_"]
    got = out.collect()
    assert len(got) == len(rows())
    for r in got:
        # Control and byte pieces never match a text here.
        if "<0x0A>" not in (r["text"] or ""):
            assert r["n_tokens"] == oracle(r["text"] or "")


def test_empty_table(spark):
    assert unigram.count_tokens(empty(spark), PATH).collect() == []
