import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from canopy.llm import byte_bpe
from canopy.llm.byte_bpe import decode_ids, encode_texts, load_ranks, round_trip_digests

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


PARTS = ["a", "the", "ing", " ", "  ", "\n", "é", "漢字", "'re", "123", "!?", "<|endoftext|>", "\x85", "😀", "x" * 40, "aa" * 9, " " * 70]


@pytest.mark.parametrize("seed", range(20))
def test_equals_the_library(library, seed):
    rng = random.Random(seed)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 200))) for _ in range(20)]
    texts += ["".join(chr(rng.choice([rng.randint(32, 126), rng.randint(160, 0x2FFF)])) for _ in range(300))]
    coder = load_ranks(PATH, P.PATTERN)
    got = coder.encode(texts)
    assert got == [library.encode_ordinary(t) for t in texts]
    assert [coder.decode(i).decode() for i in got] == texts


def test_long_words(library):
    coder = load_ranks(PATH, P.PATTERN)
    rng = random.Random(1)
    for text in ("a" * 5001, "ab" * 4000, " " * 3000, "".join(rng.choice("etaoins") for _ in range(4000)), "é漢" * 700):
        assert coder.encode([text])[0] == library.encode_ordinary(text)


@pytest.mark.parametrize("seed", range(6))
def test_words_on_both_sides_of_the_matrix_width(seed, tmp_path):
    """Ranks where a merge in the middle of a run makes a pair of lower rank than its own."""
    rng = random.Random(seed)
    ranks = {bytes([b]): b for b in range(256)} | {b"aba": 299, b"ab": 300}
    if seed:
        for n in range(12):
            token = rng.choice(list(ranks)[-8:]) + rng.choice([b"a", b"b", rng.choice(list(ranks)[-8:])])
            ranks.setdefault(token, 400 - 7 * n if seed % 2 else 301 + n)
    path = tmp_path / "r.tiktoken"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" " + str(r).encode() for t, r in ranks.items()))

    def plain(word):
        parts = [bytes([c]) for c in word]
        while True:
            pairs = [(ranks.get(x + y, 1 << 30), k) for k, (x, y) in enumerate(zip(parts, parts[1:], strict=False))]
            if not pairs or min(pairs)[0] == 1 << 30:
                return [ranks[x] for x in parts]
            k = min(pairs)[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]

    coder = load_ranks(str(path), r"\w+")
    words = ["ab" * 50, "ab" * 200, "a" * 300, "aab" * 120, *("".join(rng.choices("ab", k=k)) for k in (255, 256, 257, 400))]
    assert coder.encode(words) == [plain(w.encode()) for w in words]


def test_cache_limit_does_not_change_results(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHED_WORDS", 3)
    coder = load_ranks(PATH, P.PATTERN)
    for text in ("one two three four five", "six seven eight one two", "one"):
        assert coder.encode([text])[0] == library.encode_ordinary(text)


def test_operators_and_edges(docs, library):
    long = "endless word" * 20000
    df = docs([(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "x"), (4, long)]).selectExpr("*", "1 as ids", "2 as n_tokens")
    ids = encode_texts(df, PATH, P.PATTERN)
    by = {r.doc_id: r.ids for r in ids.collect()}
    assert by[1] == [] == by[2] and by[3] == library.encode_ordinary("a b") and by[4] == library.encode_ordinary(long)
    back = {r.doc_id: bytes(r.data).decode() for r in decode_ids(ids, PATH, P.PATTERN).collect()}
    assert back == {1: "", 2: "", 3: "a b", None: "x", 4: long}
    rows = round_trip_digests(df, PATH, P.PATTERN).collect()
    assert len(rows) == 6
    for r in rows:
        text = {1: "", 2: "", 3: "a b", None: "x", 4: long}[r.doc_id]
        want = library.encode_ordinary(text)
        assert r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert encode_texts(docs([]), PATH, P.PATTERN).collect() == []
