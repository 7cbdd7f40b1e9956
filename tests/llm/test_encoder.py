"""Words reach the library side by side, and parts seen again stay known."""

import random

import pyarrow as pa
import pytest

from hazlake.llm.tokens import Encoder, tokenizer_path

NAMES = ["byte_bpe_50k.json", "word_bpe_49k.json"]


class Heard:
    """A library that keeps the texts it is given."""

    def __init__(self, library):
        self.library, self.texts = library, []

    def encode_batch_fast(self, texts, **options):
        self.texts += texts
        return self.library.encode_batch_fast(texts, **options)


def heard(name, **options):
    encoder = Encoder(tokenizer_path(name), **options)
    library, encoder.library = encoder.library, Heard(encoder.library)
    return encoder, library, encoder.library.texts


def check(encoder, library, texts):
    ids, offsets = encoder.encode(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == library.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", NAMES)
def test_words_follow_each_other_without_marks(name):
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdeßéÀÑЖжδΣ中", k=rng.randint(1, 12))) for _ in range(2000)]
    encoder, library, texts = heard(name)
    check(encoder, library, [" " + " ".join(words), "\n" + "\n".join(words)])
    assert texts and not any("<|" in t for t in texts)


@pytest.mark.parametrize("name", NAMES)
def test_words_that_do_not_show_their_end(name):
    rng = random.Random(5)
    alphabet = ["a", "B", "İ", "ı", "é", "ẖ", "̈́", "x ", "　", "ﬁ", "ǆ", "ŉ", "ΐ", "½", "²", "ª", "'s", "क्", "가", "가"]
    words = ["".join(rng.choices(alphabet, k=rng.randint(1, 6))) for _ in range(3000)]
    encoder, library, _ = heard(name)
    check(encoder, library, [" ".join(words), "\n\t" + " ".join(words[::-1]), " İ", None, " ŉ" * 70])


@pytest.mark.parametrize("name", NAMES)
def test_parts_seen_again_stay_known(name):
    often = [f"{a}{b}x" for a in "abcdefgh" for b in "abcdefgh"]
    encoder, library, texts = heard(name, cache_parts=100)
    check(encoder, library, [" " + " ".join(often)] * 2)
    for at in range(40):
        rare = ["y" + "".join(chr(97 + int(c)) for c in str(1000 + 10 * at + i)) for i in range(10)]
        check(encoder, library, [" " + " ".join(often + rare)])
        assert len(encoder.new.slots) <= 100 + len(often) + 10
    assert sum(t.count(" aax") for t in texts) == 1
