import random

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from postloom.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def encoder():
    return bpe.encoder(bpe.vocabulary(PATH))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


TEXTS = [
    "Don't they'll I've x's' s' 's", "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|><|endoftext|><|endoftext|>", " \t\n ",
    "\x1c\x1d x\x1ey", "ΑΣ ΣΑΣ İstanbul ß ẞ", "e\u0301 \u1100\u1161 \u0301x", "½ Ⅷ ² 一二 10 ٣", "a_b__c !!! ?!", "a\u00a0b\u2003c\u3000d\x85e",
    "\U0001f600\u200d\U0001f600", "x" * 5000, "ha" * 4000, "the" * 3000, "\ufeffx \u200b", "\x00 a\x00b",
]


def test_ids_and_text_equal_the_library(encoder, library):
    decoder = bpe.Decoder(encoder)
    for text, ids in zip(TEXTS, encoder.encode_texts(TEXTS)):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want, repr(text[:40])
        assert b"".join(decoder.library(ids)).decode() == library.decode(want, skip_special_tokens=False)


def test_random_letters_equal_the_library(encoder, library):
    rng = random.Random(5)
    texts = ["".join(rng.choice("abehinorst'") for _ in range(rng.choice([3, 50, 3000]))) for _ in range(40)]
    texts += ["".join(rng.choices([*map(chr, range(32, 1500))], k=200)) for _ in range(100)]
    for text, ids in zip(texts, encoder.encode_texts(texts)):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_long_words_are_emitted_before_their_end(encoder):
    first = next(encoder.stream(b"birthday" * 2000))
    assert 0 < len(first) <= 4 * bpe.WINDOW
    assert b"".join(encoder.stream(b"birthday" * 2000)) == encoder.encode_pieces(["birthday" * 2000])["birthday" * 2000]


def test_lookahead_is_the_longest_chain():
    # After "ab" comes "c" or not: c + d keeps b from c, so that a + b happens.
    assert bpe.lookahead([("c", "d"), ("b", "c"), ("a", "b")]) == 3
    assert bpe.lookahead([("a", "b")]) == 1
    with pytest.raises(ValueError):
        bpe.lookahead([("ab", "c"), ("a", "b")])


def test_incremental_text(encoder, monkeypatch):
    monkeypatch.setattr(bpe.Decoder, "BLOCK", 1)
    ids = encoder.encode_texts(["grüße \U0001f600 ok"])[0]
    assert "".join(bpe.Decoder(encoder).text(ids)) == "grüße \U0001f600 ok "


def test_memo_starts_anew(encoder, monkeypatch, library):
    monkeypatch.setattr(bpe, "MEMO_WORDS", 8)
    small = bpe.Encoder(bpe.vocabulary(PATH))
    texts = ["a b c d e f g h i j k l m n o p", "q r s", "a z"]
    assert [i.tolist() for i in small.encode_texts(texts)] == [library.encode(t).ids for t in texts]


@pytest.mark.parametrize("blank", ["\t", "\n", "\r\n", " "])
def test_one_text_of_more_new_words_than_the_memo_holds(monkeypatch, library, blank):
    monkeypatch.setattr(bpe, "MEMO_WORDS", 8)
    small = bpe.Encoder(bpe.vocabulary(PATH))
    small.encode_texts(["k1 k2 k3 k4 k5"])
    texts = [blank.join(f"w{i}" for i in range(50)), None, blank.join(f"{i}" for i in range(9)) + blank]
    assert [i.tolist() for i in small.encode_texts(texts)] == [library.encode(t or "").ids for t in texts]


def test_memo_holds_words_of_any_number_of_tokens():
    memo, many = bpe.Memo(), (1 << 24) + 3
    memo.add(np.array([7, 9, 11], np.uint64), np.arange(many + 3, dtype=np.int32), np.array([2, many, 1]))
    ids, counts = memo.tokens(memo.find(np.array([11, 9, 7], np.uint64)))
    assert counts.tolist() == [1, many, 2]
    assert ids[:3].tolist() == [many + 2, 2, 3] and ids[-3:].tolist() == [many + 1, 0, 1]


def test_rows(documents):
    rows = [(1, "Hi there"), (2, None), (3, ""), (None, "Hi there"), (1, "Hi there")]
    got = bpe.encode(documents(rows), PATH).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.decoded) for r in got) == sorted(
        [("1", 2, "hi</w> there</w>"), ("2", 0, ""), ("3", 0, ""), ("None", 2, "hi</w> there</w>"), ("1", 2, "hi</w> there</w>")]
    )
    assert {bytes(r.ids) for r in got if r.n_tokens} == {np.array(Tokenizer.from_file(PATH).encode("hi there").ids, "<u4").tobytes()}
    assert bpe.encode(documents(rows[:0] or [(0, "")]).limit(0), PATH).count() == 0


def test_texts_without_blanks_leave_the_memo_small(monkeypatch, library):
    """The memo holds a bounded number of tokens whatever comes; ids stay the library's."""
    monkeypatch.setattr(bpe, "MEMO_WORDS", 400)
    rng = random.Random(8)
    small = bpe.Encoder(bpe.vocabulary(PATH))
    word = lambda n: "".join(rng.choices("abcdefghij+/ÄÖ中文", k=n))
    for _ in range(40):
        texts = [word(rng.choice([3, 20, 31, 33, 700])) for _ in range(5)] + ["a bc " + word(40) + " bc", " ".join(word(12) for _ in range(300))]
        texts.append(f"{texts[0]} {texts[0]} x")
        got = [i.tolist() for i in small.encode_texts(texts)]
        assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert small.memo.held <= 400 and small.memo.used <= bpe.memo_tokens()
        assert len(small.memo.ids) <= 2 * max(bpe.memo_tokens(), 1 << 16)


def test_state_machine_gives_the_text_back(documents, encoder):
    text = "grüße  an 一二\tok, don't" + "é" * 3000
    row = bpe.encode(documents([(1, text)]), PATH).collect()[0]
    assert row.text.replace(" ", "") == "".join(text.lower().split())
