import random

import public_tokenizers
import pytest

from canopy.llm.token_count import byte_level_splice, count_tokens, encode_chunk, load_json, spliced_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


def whole(text):
    return load_json(PATH).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(30))
def test_spliced_equals_whole(seed):
    rng = random.Random(seed)
    parts = ["a", "the", " ", "  ", "\n\n", "\t", "é", "漢字", "'", "'re", "'r", "123", "!?", "<|endoftext|>", "<|endof", " ", "😀", "x" * 40]
    text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 600)))
    margin = byte_level_splice(PATH)[0]
    for chunk, overlap in ((40, 30), (64, 8), (200, 50)):
        tokens, chunks, _ = spliced_tokens(text.encode(), lambda t: encode_chunk(PATH, t), margin, chunk, overlap)
        assert [i for i, _ in tokens] == whole(text)
        assert [p for _, p in tokens] == sorted(p for _, p in tokens)


def test_one_endless_word_widens_to_the_whole_text():
    text = "b" * 5000
    tokens, chunks, widened = spliced_tokens(text.encode(), lambda t: encode_chunk(PATH, t), 13, 300, 20)
    assert [i for i, _ in tokens] == whole(text) and chunks > 1 and widened > 0


def test_nulls_empty_long_ties_and_clashing_columns(docs):
    long = "many words here, " * 9000
    df = docs([(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "x"), (4, long)])
    df = df.selectExpr("*", "1 as n_tokens", "2 as n_bytes")
    got = sorted(tuple(r)[:5] for r in count_tokens(df, PATH).collect() if r.doc_id is not None)
    assert got[:4] == [(1, 0, 0, False, 1), (2, 0, 0, False, 1), (3, 3, 2, False, 1), (3, 3, 2, False, 1)]
    assert got[4][:4] == (4, len(long), len(whole(long)), True) and got[4][4] > 1
    assert count_tokens(docs([]), PATH).collect() == []


def test_other_tokenizer_files(docs):
    import sentencepiece
    from tokenizers import Tokenizer

    text = "Some Text, with 3 words.  <|endoftext|> é"
    word, piece = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
    assert count_tokens(docs([(1, text)]), word).first().n_tokens == len(Tokenizer.from_file(word).encode(text, add_special_tokens=False).ids)
    assert count_tokens(docs([(1, text)]), piece).first().n_tokens == len(sentencepiece.SentencePieceProcessor(model_file=piece).encode(text))
