import array
import random

from eventide.llm.common import WordEncoder, vocabulary_path

PATH = vocabulary_path("word_bpe_49k.json")


def whole(encoder, text):
    return array.array("I", encoder.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


def test_words_with_marks_equal_the_whole_tokenizer():
    encoder, rng = WordEncoder(PATH), random.Random(1)
    letters = ["a", "b", "Z", "é", "É", "ß", "ñ", "Ö", "ÿ", "Ÿ", "÷", "×", "ﬁ"]
    marks = [*"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", "<|endoftext|>", "1", "9", "'s"]
    for _ in range(20_000):
        word = "".join(rng.choices(letters, k=rng.randint(0, 6)) + rng.choices(marks, k=rng.randint(0, 4))
                       + rng.choices(["", "a", "É"]))
        if word:
            assert encoder.encode(word) == whole(encoder, word)


def test_letters_with_marks_need_no_whole_tokenizer_and_words_in_use_stay():
    encoder, calls = WordEncoder(PATH, limit=50), []
    real, plain = encoder._ids, encoder._plain
    encoder._ids = lambda word: (calls.append(word), real(word))[1]
    encoder._plain = lambda low: (calls.append(low), plain(low))[1]
    text = "Hello%%% hello!! HELLO### Élan&&& élan$$$"
    want = encoder.encode(text)
    assert want == whole(encoder, text) and set(calls) == {b"hello", "élan".encode(), "%%%", "!!", "###", "&&&", "$$$"}
    for i in range(40):  # each round fills less than a generation
        encoder.encode(" ".join(f"w{'abcdefghij'[i % 10]}{'abcd'[i // 10]}{x}" for x in "klmnopqrst"))
        calls.clear()
        assert encoder.encode(text) == want and not calls
    assert len(encoder) <= 50 and len(encoder.older) <= 50
