"""Bounds of the token store: what an access reads, and what a task keeps."""

import numpy as np
import pyarrow as pa
import pytest

from tallyrow.llm import tokenstore


@pytest.mark.parametrize("n", [4_096, 262_144])
def test_an_access_reads_one_block_a_level(n):
    """All other blocks may hold anything: the slot is the same."""
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
    levels, sizes, ranks = tokenstore.build_hash(keys)
    expected = tokenstore.slots(keys, levels, sizes, ranks)
    size, touched = tokenstore._BITS // 8, []
    for i in rng.integers(0, len(keys), 50):
        junk = rng.integers(0, 256, len(levels), dtype=np.uint8)
        first, blocks = 0, []
        for level, bits in enumerate(sizes.tolist()):
            block = (first + int(tokenstore._mix(keys[i : i + 1], level)[0] % np.uint64(bits))) // tokenstore._BITS
            blocks.append(block)
            junk[block * size : (block + 1) * size] = np.frombuffer(levels, np.uint8)[block * size : (block + 1) * size]
            if tokenstore.slots(keys[i : i + 1], junk.tobytes(), sizes, ranks)[0] == expected[i]:
                break
            first += bits
        assert tokenstore.slots(keys[i : i + 1], junk.tobytes(), sizes, ranks)[0] == expected[i]
        touched.append(len(blocks))
    assert np.mean(touched) < 2.5 and max(touched) <= len(sizes)


def test_kept_words_are_bounded(monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(tokenstore, "CACHE_BYTES", 300_000)
    monkeypatch.setattr(tokenstore, "BLOCK_BYTES", 5_000)
    enc = tokenstore.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = [" ".join(f"word{i}x{k}" for k in range(60)) for i in range(200)] + ["one word" * 3]
    largest = 0
    for text, ids in zip(texts, enc.encode(pa.array(texts))):
        assert np.frombuffer(ids, enc.dtype).tolist() == enc.full.encode(text, add_special_tokens=False).ids
        largest = max(largest, sum(len(w) + len(b) + tokenstore.ENTRY_BYTES for w, b in enc.words.items()))
    assert 0 < largest <= tokenstore.CACHE_BYTES and enc.held <= tokenstore.CACHE_BYTES
    enc.forget()
    assert not enc.words


def test_words_met_again_stay_when_the_cache_is_full(monkeypatch):
    """A frequent word is encoded once, however often words met once fill the cache."""
    import public_tokenizers

    monkeypatch.setattr(tokenstore, "CACHE_BYTES", 100_000)
    monkeypatch.setattr(tokenstore, "BLOCK_BYTES", 3_000)
    enc = tokenstore.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    learned, plain = [], enc._learn
    monkeypatch.setattr(enc, "_learn", lambda words: learned.extend(words) or plain(words))
    texts = ["the frequent Words, été " + " ".join(f"w{i}x{k}" for k in range(200)) for i in range(20)]
    for text, ids in zip(texts, enc.encode(pa.array(texts))):
        assert np.frombuffer(ids, enc.dtype).tolist() == enc.full.encode(text, add_special_tokens=False).ids
    assert learned.count("w0x0") == learned.count("w19x7") == 1
    assert [learned.count(w) for w in ("the", "frequent", "Words,", "été")] == [1, 1, 1, 1]
