import re

from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from eventide.llm.common import WORD_PATTERN, vocabulary_path, word_encoder, words

PATH = vocabulary_path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def ids(text):
    raw = word_encoder(PATH).encode(text)
    return [int.from_bytes(raw[i:i + 4], "little") for i in range(0, len(raw), 4)]


@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=60))
@settings(max_examples=300, deadline=None)
def test_word_encoder_equals_the_tokenizer_on_whole_texts(text):
    assert ids(text) == TOKENIZER.encode(text, add_special_tokens=False).ids


@given(st.text(alphabet="abÉéßZ.,'!0 \n\t\x0b\x1c\x85 ", max_size=40))
@settings(max_examples=300, deadline=None)
def test_words_and_encoder_on_mixed_characters(text):
    assert [w.decode() for w in words(text)] == re.findall(WORD_PATTERN, text)
    assert ids(text) == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_encoder_forgets_but_stays_right():
    from eventide.llm.common import WordEncoder
    small = WordEncoder(PATH, limit=3)
    text = "The quick, brown fox. the quick BROWN fox jumps over over the dog " * 3
    assert small.encode(text) == word_encoder(PATH).encode(text)
    assert words(None) == [] and word_encoder(PATH).encode(None) == b""
