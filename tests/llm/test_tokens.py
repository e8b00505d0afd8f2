"""Operators 2 and 7 against the tokenizer libraries."""

import hashlib
import random

import pytest
from conftest_llm import docs, empty, rows_of, texts  # noqa: F401

public_tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
tokenizers = pytest.importorskip("tokenizers")
import numpy as np  # noqa: E402
import regex  # noqa: E402

from chronoframe.llm import byte_bpe, token_counts  # noqa: E402

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PARTS = ["a", "aa", "B", "é", "é", "漢", "𝔘", "1", "22", " ", "  ", "\n\n", "'s", "'LL", "ing", "TION", "==", "\x00", "Σ", "İ", "<|endoftext|>", "<|", "\u0085", "½", "👍🏽"]


@pytest.fixture(scope="module")
def encoder():
    return byte_bpe.PieceEncoder(byte_bpe.read_ranks(RANKS))


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})


def fuzz(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def test_encode_and_decode(docs, texts, reference):
    got = rows_of(byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    expected = []
    for i, t in texts:
        ids = reference.encode_ordinary(t or "")
        expected.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(expected, key=repr)


def test_decode_gives_the_bytes_back(docs):
    out = byte_bpe.decode(byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS)
    assert all(bytes(r["decoded"]) == (r["text"] or "").encode() for r in out.select("text", "decoded").collect())


def test_every_prefix_has_its_own_last_token(encoder, reference):
    piece = " internationalisation"
    last = encoder.table.table(piece.encode())
    for n in range(1, len(piece) + 1):
        ids = reference.encode_ordinary(piece[:n])
        assert encoder.table.read(piece.encode(), last, n) == ids and last[n] == ids[-1]


def test_append_and_edit_equal_encoding_anew(encoder, reference):
    table, pattern = encoder.table, regex.compile(public_tokenizers.PATTERN)
    rng = random.Random(8)
    for _ in range(300):
        piece = "".join(rng.choice("aehinorst") for _ in range(rng.randint(1, 40))).encode()
        last = table.table(piece)
        a = rng.randint(0, len(piece))
        b = rng.randint(a, len(piece))
        new = "".join(rng.choice("aehinorst") for _ in range(rng.randint(0, 4))).encode()
        edited, out = table.edit(piece, last[:], a, b, new)
        assert out == table.table(edited)
        more = piece + b"ing"
        assert table.table(more, last[:]) == table.table(more)
    for text in fuzz(150):
        own = byte_bpe.EditableText(encoder, pattern, text)
        for _ in range(4):
            a = rng.randint(0, len(own.text))
            b = min(len(own.text), a + rng.randint(0, 5))
            own.replace(a, b, rng.choice(PARTS + [""]))
            assert own.ids() == reference.encode_ordinary(own.text)
        own.append("ll done")
        assert own.ids() == reference.encode_ordinary(own.text)


def test_fuzz_bytes(encoder, reference):
    pattern = regex.compile(public_tokenizers.PATTERN)
    for s in fuzz(1500):
        assert [i for p in pattern.findall(s) for i in encoder.ids(p.encode())] == reference.encode_ordinary(s)


def test_counts(docs, texts):
    library = tokenizers.Tokenizer.from_file(WORDS)
    got = rows_of(token_counts.token_counts(docs, WORDS, limit=300), "doc_id", "n_bytes", "n_tokens", "over_limit")
    expected = []
    for i, t in texts:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        expected.append((i, len((t or "").encode()), n, n > 300))
    assert got == sorted(expected, key=repr)


def test_fuzz_counts_and_budgets():
    library = tokenizers.Tokenizer.from_file(WORDS)
    counter = token_counts.Counter(token_counts.read_vocabulary(WORDS))
    count = lambda s: len(library.encode(s, add_special_tokens=False).ids)
    for s in fuzz(800, 4):
        assert counter.count(s) == count(s)
    for word in ("internationalisation", "größenwahn", "aaaaabbbb", "x"):
        assert counter.words.prefix(word) == [0] + [count(word[:k]) for k in range(1, len(word) + 1)]
    text = "the unbelievable internationalisation of everything"
    for budget in range(12):
        end = counter.fits(text, budget)
        assert count(text[:end]) <= budget
        assert end == len(text) or count(text[:end + 1]) > budget or text[end:end + 1] == " " or end == 0


def test_empty_tables(empty):
    assert byte_bpe.encode(empty, RANKS, public_tokenizers.PATTERN).collect() == []
    assert token_counts.token_counts(empty, WORDS).collect() == []


def test_a_worker_gives_memory_back_when_its_operator_changes(monkeypatch):
    """Pipeline, byte_bpe: what the operator before has left is handed to the system before tables are built, and only then."""
    from chronoframe.llm import memories

    back = []
    monkeypatch.setattr(memories, "give_back", lambda: back.append(dict(memories._held)))
    memories._held.clear()
    assert [memories.held(k, lambda k=k: [k]) for k in ("a", "a", "b")] == [["a"], ["a"], ["b"]]
    assert back == [{}, {}] and memories._held == {"b": ["b"]}
    memories.release()
    assert len(back) == 3 and memories._held == {}


def test_memory_is_given_back_where_the_system_can():
    from chronoframe.llm import memories

    assert memories.give_back() is None
