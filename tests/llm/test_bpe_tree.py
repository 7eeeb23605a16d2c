"""The tree encoder does its joins on ordinary text, not on long matches only."""

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from fixtures import texts  # noqa: F401

from wattledger.llm import bpe_codec

VOCABULARY = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture
def encoder():
    return bpe_codec.TextEncoder(*VOCABULARY)


def test_matches_of_the_documents_are_joined(texts, encoder, monkeypatch):
    seams = []
    ask = bpe_codec.TreeEncoder.seam
    monkeypatch.setattr(
        bpe_codec.TreeEncoder, "seam", lambda tree, a, b: seams.append((a, b)) or ask(tree, a, b)
    )
    plain = tiktoken.Encoding(
        "own", pat_str=VOCABULARY[1], mergeable_ranks=encoder.tree.ranks, special_tokens={}
    )
    for _, text in texts:
        ids = np.frombuffer(encoder.encode(text or ""), "<u4").tolist()
        assert ids == plain.encode_ordinary(text or "")
    assert len(seams) > len(texts)
    # Some seams change, so windows are widened, too.
    assert any(ask(encoder.tree, a, b) != [a, b] for a, b in seams)


@pytest.mark.parametrize("kept", [1, 3])
def test_kept_encodings_may_be_few(texts, encoder, monkeypatch, kept):
    whole = [encoder.encode(text or "") for _, text in texts[:60]]
    for name in ("KEPT_SEAMS", "KEPT_PARTS", "KEPT_MATCHES"):
        monkeypatch.setattr(bpe_codec, name, kept)
    few = bpe_codec.TextEncoder(*VOCABULARY)
    assert [few.encode(text or "") for _, text in texts[:60]] == whole


def test_parts_are_joined_in_order():
    for count in (0, 1, 2, 15, 16, 17, 256, 257, 5000):
        parts = [str(k).encode() for k in range(count)]
        assert bpe_codec.joined_up(parts) == b"".join(parts)


def test_long_texts_are_matched_in_parts(encoder, monkeypatch):
    text = "some words, and 12 numbers\n" * 400
    whole = encoder.encode(text)
    monkeypatch.setattr(bpe_codec, "LISTED_CHARS", 100)
    assert encoder.encode(text) == whole and encoder.decode(whole) == text.encode()
