"""What workers keep between tasks."""

import public_tokenizers

from wattledger.llm import bpe_codec, packing, workers


def test_other_operators_caches_are_forgotten():
    vocabulary = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    own = bpe_codec.text_encoder(*vocabulary)
    tokenizer = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    other = packing.piece_ids(*tokenizer)
    workers.forget_others(bpe_codec.__name__)
    assert bpe_codec.text_encoder(*vocabulary) is own
    assert packing.piece_ids(*tokenizer) is not other
