"""Token ids of the cached pieces against the whole-text results of the library."""

import random

import public_tokenizers
import tokenizers

from basketry.llm.tokens import WordCache

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_pieces_give_the_ids_of_whole_texts():
    library = tokenizers.Tokenizer.from_file(PATH)
    cache = WordCache(PATH)
    rng = random.Random(8)
    letters = "aIsx\u0130\u0131\u00c5\u212bA\u030a\u00df\u1e9e\u0149\u01c5\u03a3\u03c3\u0307\u0301\u4e2d\u0645\u0e01 \u00a0\n\t.,'!_-19\u00b2\u0664\ud55c\u1112\u1161"
    texts = ["AVC\u0130\u0130. son", "\u0130. \u0130, i\u0307.", "a1. b2, 3.", "", "It's, they'll."]
    texts += ["".join(rng.choices(letters, k=rng.randint(1, 25))) for _ in range(20_000)]
    texts += ["".join(chr(c) for c in rng.choices(range(0x20, 0x3000), k=12)) + "." for _ in range(5_000)]
    for at in range(0, len(texts), 500):
        part = texts[at : at + 500]
        ids, counts = cache.encode(part)
        ends = counts.cumsum()
        for text, a, b in zip(part, ends - counts, ends, strict=True):
            assert ids[a:b].tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_a_word_is_learned_once_whatever_stands_beside_it():
    cache = WordCache(PATH)
    marks = ["", ";", ":", "!", "?)", '"', ".", ",", "-", "'s", "...", "\t", "\r\n", "7", "#%"]
    texts = [f"{a}{word}{b}" for word in ("word", "Word", "café") for a in ("", "(", '"', "3") for b in marks if word != "café" or not a]
    ids, counts = cache.encode(texts)
    assert len(cache) <= 20
    library = tokenizers.Tokenizer.from_file(PATH)
    ends = counts.cumsum()
    for text, a, b in zip(texts, ends - counts, ends, strict=True):
        assert ids[a:b].tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_cuts_beside_apostrophes_bars_and_marks_give_the_ids_of_whole_texts():
    library = tokenizers.Tokenizer.from_file(PATH)
    cache = WordCache(PATH)
    rng = random.Random(9)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "'s", "'LL", "\u00e9.", "\u0130.", "T\u0308", "<\u0338", "1", "word", "Word"]
    parts += list("aTE'\"|<>-.!=19 \t\r\n\x0b\x1c\u0301\u4e2d\u00fc\u00d7\u0149")
    texts = ["", " \n", *("".join(rng.choices(parts, k=rng.randint(1, 9))) for _ in range(20_000))]
    for at in range(0, len(texts), 20):  # every other part is free of special tokens
        part = [t if at % 40 else t.replace("<|", "") for t in texts[at : at + 20]]
        ids, counts = cache.encode(part)
        ends = counts.cumsum()
        for text, a, b in zip(part, ends - counts, ends, strict=True):
            assert ids[a:b].tolist() == library.encode(text, add_special_tokens=False).ids, text
