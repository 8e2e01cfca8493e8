"""Word-end vocabulary ids against the tokenizers library on odd random texts, many at once."""
import random

import numpy as np
from tokenizers import Tokenizer

from tessera.llm import packing


def test_random_texts_in_batches():
    whole, ids_of = Tokenizer.from_file(packing.public_path()), packing.word_ids(packing.public_path())
    rng = random.Random(8)
    alphabet = [*"abcdE'STREvmld\t\n\r \x1c\x1f\x00\x7f\x85\xa0 éÉßøȺȾİıſǅ日本😀́ﬁ²½٣0123<|>!?.-", "<|endoftext|>", "'re", " 'll",
                "'VE", "<|", " ", "  "]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(30))) for _ in range(5000)]
    got = [x for i in range(0, 5000, 50) for x in ids_of([t.encode() for t in texts[i:i + 50]])]
    assert got == [np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_every_plain_character():
    whole, ids_of = Tokenizer.from_file(packing.public_path()), packing.word_ids(packing.public_path())
    texts = [f"a{chr(c)}b {chr(c)} x{chr(c)}" for c in range(0x300)]
    assert ids_of([t.encode() for t in texts]) == \
        [np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_store_turns_over(monkeypatch):
    """Ids do not depend on what the store still holds."""
    ids_of = packing.word_ids(packing.public_path())
    texts = [f"word{k} and w{k % 7}x's" .encode() for k in range(2000)]
    want = ids_of(texts)
    monkeypatch.setattr(ids_of.words, "most", 300)
    assert [x for i in range(0, 2000, 40) for x in ids_of(texts[i:i + 40])] == want
    assert len(ids_of.words.known) <= 300


def test_bytes_outside_utf8_and_long_words():
    whole, ids_of = Tokenizer.from_file(packing.public_path()), packing.word_ids(packing.public_path())
    texts = [b"ok \xff\xfe bad \xc3", ("ab" * 3000 + " " + "x" * 5000).encode(), b""]
    want = [np.array(whole.encode(t.decode("utf-8", "replace"), add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert ids_of(texts) == want
