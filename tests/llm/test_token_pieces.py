"""Budgets and prefix counts in texts without white space."""

import numpy as np
import pytest
from llm_helpers import odd_documents

from strata.llm import token_counts

PARTS = ["s", "'", "l", "r", "e", "S", "K", "é", "é", "中", "文字", "，", "1", "²", "!", "<|endoftext|>", "<|", "|>", "endof",
         "the", " ", "　", "‍", "🙂", "각", "ᄀ", "ᅡ", "̈́", "Å", ";", "ﬁ", "İ", "Σ", "क़", "\x1c"]


def test_prefixes_by_pieces_equal_the_library(rng):
    c = token_counts.Counter(token_counts.vocabulary())
    c.long, c.run = 0, 4
    for _ in range(400):
        some = rng.sample(PARTS, rng.choice([3, 6, len(PARTS)]))
        word = "".join(rng.choice(some) for _ in range(rng.randint(1, 40)))
        want = [0, *c.encoded([word[:j] for j in range(1, len(word) + 1)])]
        pieces = c.pieces(word.encode())
        assert b"".join(pieces).decode() == word and c.within_long(word).tolist() == want
        ends = np.cumsum([len(p.decode()) for p in pieces])
        assert np.cumsum(c.of(pieces)).tolist() == [want[i] for i in ends]


@pytest.mark.parametrize("alphabet", ["中文字之一", "ABCDEFabcdefghijk0123456789+/", "the，。ab中文", "=-"])
def test_budget_in_a_long_word(rng, alphabet):
    c = token_counts.Counter(token_counts.vocabulary())
    text = "".join(rng.choice(alphabet) for _ in range(100_000))
    pieces = c.pieces(text.encode())
    ends, tokens = np.cumsum([len(p) for p in pieces]), np.cumsum(c.of(pieces))
    assert tokens[-1] == c.encoded([text])[0]
    for budget in (7, 2_000):
        raw = text.encode()[:token_counts.longest_prefix(text.encode(), ends, tokens, budget, c)]
        assert c.encoded([raw.decode()])[0] <= budget
        assert all(c.encoded([text[:len(raw.decode()) + k]])[0] > budget for k in range(1, 8))
        assert token_counts.prefix_count(text.encode(), ends, tokens, len(raw), c) == c.encoded([raw.decode()])[0]


def test_truncated_without_spaces(spark, rng):
    c = token_counts.Counter(token_counts.vocabulary())
    texts = ["".join(rng.choice("中文，字ab12'+") for _ in range(n)) for n in (100_000, 500, 40, 0)]
    df = odd_documents(spark, [(i, t + " end\n", "a") for i, t in enumerate(texts)])
    counts = token_counts.token_counts(df, at_words=True)
    for r in counts.collect():
        assert r.prefix_tokens[-1] == r.n_tokens and r.word_ends[-1] == r.n_bytes - 1
    for r in token_counts.truncated(df, counts, 100).collect():
        text = texts[r.doc_id] + " end\n"
        assert text.startswith(r.text) and c.encoded([r.text])[0] <= 100
        assert all(n > 100 for n in c.encoded([text[:j] for j in range(len(r.text) + 1, min(len(text), 400) + 1)]))
