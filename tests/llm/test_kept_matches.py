"""The packing encoder keeps a bounded number of matches, the frequent ones among them."""

import public_tokenizers

from wattledger.llm import packing


def test_kept_matches_are_few_and_frequent_ones_stay(monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    text = " ".join(f"the a{k} of" for k in range(300))
    whole = packing.PieceIds(path, public_tokenizers.PATTERN).encode_whole(text)
    assert packing.KEPT_MATCHES * 200 <= 50_000_000
    monkeypatch.setattr(packing, "KEPT_MATCHES", 20)
    few = packing.PieceIds(path, public_tokenizers.PATTERN)
    assert few.encode_whole(text) == whole
    assert len(few) <= 20 and {" the", " of"} <= set(few)
    monkeypatch.setattr(packing, "KEPT_MATCHES", 1)
    assert packing.PieceIds(path, public_tokenizers.PATTERN).encode_whole(text) == whole


def test_ascii_texts_are_cut_by_the_same_pattern():
    import random

    import regex

    plain = packing.ascii_matcher(public_tokenizers.PATTERN)
    whole = regex.compile(public_tokenizers.PATTERN)
    rng = random.Random(7)
    for _ in range(200):
        text = "".join(rng.choices([chr(k) for k in range(128)] + list("  'stre09\n"), k=200))
        assert plain.findall(text) == whole.findall(text)
    assert packing.ascii_matcher(r"[^\s\p{L}]\p{N}+").pattern == r"[^\sa-zA-Z][0-9]+"
    assert packing.ascii_matcher(r"\p{Lu}+") is None
